"""Lines repeated across the documents of one source, found and removed.

Texts are read as sequences of line identifiers. Distributed PrefixSpan counts
in how many documents of a source a sequence occurs: first single lines, then
each frequent sequence is extended by every line that follows it in a text,
level by level, over the database projected onto frequent lines, until no
sequence is frequent. Lines that always stand together are one item of the
database, so a notice of many lines is grown in one step. Occurrences of the
lines of frequent sequences, single lines included, are deleted from the texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import count

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmill.plans.runtime import materialize

MIN_CHARS = 20
MIN_DOCS = 8

_DIGITS = re.compile(r"\d+")


def normal_line(line: str) -> str:
    """Trimmed, white space runs as one space, digit runs as one 0, lower case."""
    return _DIGITS.sub("0", " ".join(line.split())).lower()


def counted_lines(text: str, min_chars: int = MIN_CHARS) -> list[tuple[int, str]]:
    """Numbers (from 1) and normal forms of the lines that may count: outside fences, long enough, with a letter."""
    found, fence = [], None
    for number, line in enumerate(text.split("\n"), 1):
        head = line.strip()[:3]
        if fence is not None:
            if head == fence:
                fence = None
            continue
        if head == "```" or head == "~~~":
            fence = head
            continue
        if len(line) < min_chars:
            continue
        normal = normal_line(line)
        if len(normal) >= min_chars and any(map(str.isalpha, normal)):
            found.append((number, normal))
    return found


def line_table(sections: DataFrame) -> DataFrame:
    """``(id, source, doc, line_no, h1, h2)`` of every countable line; ``h1, h2`` identify its normal form (128 bits).

    Rows with null text give none. A null source is a source of its own; a null
    doc is no document, so its lines count for none but are found if others are.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, numbers, low, high = [], [], [], []
            for row, text in enumerate(batch.column(3).to_pylist()):
                if text:
                    for number, normal in counted_lines(text):
                        value = xxhash.xxh3_128_intdigest(normal.encode("utf-8", "surrogatepass"))
                        index.append(row)
                        numbers.append(number)
                        low.append((value & 0xFFFFFFFFFFFFFFFF) - (1 << 63))
                        high.append((value >> 64) - (1 << 63))
            taken = [batch.column(i).take(pa.array(index, pa.int32())) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*taken, pa.array(numbers, pa.int32()), pa.array(low, pa.int64()), pa.array(high, pa.int64())], names=["id", "source", "doc", "line_no", "h1", "h2"])

    return sections.select("id", "source", "doc", "text").mapInArrow(read, "id string, source string, doc string, line_no int, h1 bigint, h2 bigint")


def _frequent(items: DataFrame, keys: list[str], min_docs: int) -> DataFrame:
    """Groups of ``keys`` with at least ``min_docs`` distinct documents.

    Two plain aggregations: distinct (keys, doc) with partial aggregation, then
    a count; a line on every page of a huge source is spread by its documents.
    """
    return items.groupBy(*keys, "doc").agg(F.lit(1).alias("one")).groupBy(*keys).agg(F.count("doc").alias("n_docs")).filter(F.col("n_docs") >= min_docs)


def frequent_lines(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """First level of the search: the rows of ``lines`` that are frequent in their source.

    The result ``(id, source, doc, line_no, h1, h2)`` is the database projected
    onto frequent lines; nothing else can be part of a frequent sequence.
    """
    single = _frequent(lines, ["source", "h1", "h2"], min_docs)
    a, b = lines.alias("a"), single.alias("b")
    return a.join(b, F.expr("a.h1 = b.h1 AND a.h2 = b.h2 AND a.source <=> b.source"), "left_semi").select("id", "source", "doc", "line_no", "h1", "h2")


_TEXT = ["source", "doc", "t1", "t2"]


def sequence_database(projected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items of the texts and the lines of each item, from the rows of :func:`frequent_lines`.

    The first table is ``(source, doc, t1, t2, line_no, i1, i2)``: ``t1, t2``
    name the text, ``i1, i2`` the item, whose lines begin at ``line_no``. Where
    a line is always followed by one and the same line, and that one always
    preceded by it, the two are one item: every text that holds a sequence with
    one of them also holds it with both, so no other support is lost. The second
    table is ``(source, i1, i2, lines)`` with the hashes of the lines in order.
    """
    text = {"t1": F.xxhash64("source", "doc", "id"), "t2": F.xxhash64(F.lit(7), "source", "doc", "id")}
    rows = projected.withColumns(text).select(*_TEXT, "line_no", "h1", "h2").distinct()
    order = Window.partitionBy("t1", "t2").orderBy("line_no", "h1", "h2")
    line = F.struct("h1", "h2")
    rows = rows.select("*", F.lag(line).over(order).alias("before"), F.lead(line).over(order).alias("after"))
    sides = {
        side: (F.count(side) == F.count(F.lit(1))) & (F.min(F.struct(side)) == F.max(F.struct(side))) for side in ("before", "after")
    }
    lines = rows.groupBy("source", "h1", "h2").agg(*(F.when(alone, F.min(side)).alias(side) for side, alone in sides.items()))
    leads = lines.filter("after IS NOT NULL").select("source", F.struct("h1", "h2").alias("before"), F.col("after.h1").alias("h1"), F.col("after.h2").alias("h2"))
    follows = lines.filter("before IS NOT NULL").select("source", "before", "h1", "h2").alias("f")
    same = F.expr("f.h1 = l.h1 AND f.h2 = l.h2 AND f.before = l.before AND f.source <=> l.source")
    inner = follows.join(leads.alias("l"), same, "left_semi").alias("i")
    marked = rows.alias("r").join(inner, F.expr("r.h1 = i.h1 AND r.h2 = i.h2 AND r.source <=> i.source"), "left").select("r.*", F.col("i.h1").isNull().alias("first"))
    begin = F.last(F.when(F.col("first"), F.struct("line_no", "h1", "h2")), ignorenulls=True).over(order)
    whole = materialize(marked.select(*_TEXT, "line_no", line.alias("line"), begin.alias("b"), F.row_number().over(order).alias("k")), "items")
    items = whole.filter("line_no = b.line_no AND line.h1 = b.h1 AND line.h2 = b.h2").select(*_TEXT, "line_no", F.col("b.h1").alias("i1"), F.col("b.h2").alias("i2"))
    # One text shows the lines of an item.
    shown = whole.groupBy("source", F.col("b.h1").alias("i1"), F.col("b.h2").alias("i2")).agg(F.min(F.struct("t1", "t2", "b.line_no")).alias("at")).alias("s")
    hit = F.expr("w.b.h1 = s.i1 AND w.b.h2 = s.i2 AND w.source <=> s.source AND w.t1 = s.at.t1 AND w.t2 = s.at.t2 AND w.b.line_no = s.at.line_no")
    parts = whole.alias("w").join(shown, hit).groupBy("s.source", "s.i1", "s.i2").agg(F.array_sort(F.collect_list(F.struct("w.k", "w.line"))).alias("lines"))
    return items, parts.select("source", "i1", "i2", F.transform("lines", lambda x: x["line"]).alias("lines"))


class FrequentSequences:
    """PrefixSpan over the rows of :func:`frequent_lines`.

    Finds all sequences of items (see :func:`sequence_database`) in texts of at
    least ``min_docs`` documents of a source. Other lines may stand between two
    items. Neither length nor distance is bounded, so the result grows with the
    number of subsequences that are frequent.

    A text appears once per sequence, where the sequence ends earliest, and is
    joined to its later items to extend it; occurrences carry two hashes of
    their sequence. Each level of frequent occurrences is written to the shared
    folder, so lineage does not grow with the length.
    """

    _KEY = ["source", "p1", "p2", "i1", "i2"]

    def __init__(self, projected: DataFrame, min_docs: int = MIN_DOCS):
        self.projected, self.min_docs = projected, min_docs
        items, self.lines = sequence_database(projected)
        later = items.select("t1", "t2", F.col("line_no").alias("next"), "i1", "i2")
        # An item is as frequent as its first line: the first level is frequent as it is.
        level = items.groupBy(*_TEXT, "i1", "i2").agg(F.min("line_no").alias("at")).withColumns({"p1": F.lit(0).cast("bigint"), "p2": F.lit(0).cast("bigint")})
        self.levels = [level]
        for length in count(2):
            begun = level.select(*_TEXT, "at", *(c.alias(n) for n, c in zip(("p1", "p2"), self._names())))
            grown = begun.join(later, ["t1", "t2"]).filter("next > at").groupBy(*_TEXT, "p1", "p2", "i1", "i2").agg(F.min("next").alias("at"))
            same = F.expr("g.p1 = c.p1 AND g.p2 = c.p2 AND g.i1 = c.i1 AND g.i2 = c.i2 AND g.source <=> c.source")
            level = materialize(grown.alias("g").join(_frequent(grown, self._KEY, min_docs).alias("c"), same, "left_semi"), f"sequences-{length}")
            if level.isEmpty():
                break
            self.levels.append(level)

    @staticmethod
    def _names() -> tuple[Column, Column]:
        """Hashes of the sequence that ends with an item."""
        return F.xxhash64("p1", "i1", "i2"), F.xxhash64("p2", "i2", "i1")

    def all_lines(self) -> DataFrame:
        """Distinct lines ``(source, h1, h2)`` of all sequences."""
        used = reduce(DataFrame.unionByName, (level.select("source", "i1", "i2").distinct() for level in self.levels)).distinct()
        l, u = self.lines.alias("l"), used.alias("u")
        joined = l.join(u, F.expr("l.i1 = u.i1 AND l.i2 = u.i2 AND l.source <=> u.source"), "left_semi")
        return joined.select("source", F.explode("lines").alias("l")).select("source", "l.h1", "l.h2").distinct()

    def occurrences(self) -> DataFrame:
        """Distinct ``(id, line_no)`` where a line of one of the sequences stands."""
        a, b = self.projected.alias("a"), self.all_lines().alias("b")
        return a.join(b, F.expr("a.h1 = b.h1 AND a.h2 = b.h2 AND a.source <=> b.source"), "left_semi").select("id", "line_no").distinct()

    def table(self) -> DataFrame:
        """``(source, lines, length, n_docs)``: hashes of the lines in order, number of items, number of documents."""
        known, results = None, []
        for length, level in enumerate(self.levels, 1):
            c, n = _frequent(level, self._KEY, self.min_docs).alias("c"), self.lines.alias("n")
            grown = c.join(n, F.expr("c.i1 = n.i1 AND c.i2 = n.i2 AND c.source <=> n.source")).select("c.*", "n.lines")
            if known is not None:
                before = F.expr("g.p1 = k.s1 AND g.p2 = k.s2 AND g.source <=> k.source")
                grown = grown.alias("g").join(known.alias("k"), before).select("g.source", "g.p1", "g.p2", "g.i1", "g.i2", "g.n_docs", F.concat("k.lines", "g.lines").alias("lines"))
            s1, s2 = self._names()
            known = materialize(grown.select("source", s1.alias("s1"), s2.alias("s2"), "lines", F.lit(length).alias("length"), "n_docs"), f"named-{length}")
            results.append(known.select("source", "lines", "length", "n_docs"))
        return reduce(DataFrame.unionByName, results)


def described(sequences: DataFrame, projected: DataFrame, sections: DataFrame) -> DataFrame:
    """``(source, seq, length, n_lines, n_docs)``: sequences with their lines as text, joined by line feeds."""
    shown = projected.groupBy("source", "h1", "h2").agg(F.min(F.struct("id", "line_no")).alias("at")).select("source", "h1", "h2", "at.*")
    texts = sections.join(shown.select("id").distinct(), "id", "left_semi").select("id", "source", "text").dropDuplicates(["id", "source"])
    found = shown.alias("s").join(texts.alias("t"), F.expr("s.id = t.id AND s.source <=> t.source"))
    plain = F.udf(normal_line, "string", useArrow=True)
    names = found.select("s.source", F.struct("s.h1", "s.h2").alias("l"), plain(F.get(F.split("t.text", "\n"), F.col("s.line_no") - 1)).alias("line"))
    key = F.xxhash64("source", "lines").alias("key")
    each = sequences.select("source", "lines", "length", "n_docs", key, F.posexplode("lines").alias("k", "l")).alias("e")
    joined = each.join(names.alias("n"), F.expr("e.l = n.l AND e.source <=> n.source"))
    return joined.groupBy("e.source", "e.key", "e.length", "e.n_docs").agg(F.array_sort(F.collect_list(F.struct("e.k", "n.line"))).alias("parts")).select(
        "source", F.array_join(F.transform("parts", lambda x: x["line"]), "\n").alias("seq"), "length", F.size("parts").alias("n_lines"), "n_docs"
    )


def found_lines(sections: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Distinct ``(id, line_no)`` of repeated lines: those of the frequent sequences of their source."""
    # Written once: reading texts line by line costs more than the table of hashes, which is used twice.
    projected = materialize(frequent_lines(materialize(line_table(sections), "lines"), min_docs), "frequent-lines")
    return FrequentSequences(projected, min_docs).occurrences()


def remove_lines(sections: DataFrame, found: DataFrame) -> DataFrame:
    """Every row of ``sections`` (``id, text``, others kept) with its repeated lines taken out.

    ``clean_text`` is the text without them, ``n_removed`` their number. Rows
    without repeated lines keep their text; null text stays null.
    """
    marks = found.groupBy("id").agg(F.collect_set("line_no").alias("__drop"))
    kept = [c for c in sections.columns if c not in ("clean_text", "n_removed")]
    base = sections.select(*kept, F.col("id").alias("__key"))
    joined = base.join(marks.withColumnRenamed("id", "__key"), "__key", "left")
    parts = F.split("text", "\n")
    # A set difference of line numbers, so that long texts with many such lines take linear time; the split text
    # is bound to a variable, or it would be split again for every line.
    left = F.array_except(F.sequence(F.lit(1), F.size(parts)), F.col("__drop"))
    bound = F.array(F.struct(parts.alias("lines"), left.alias("left")))
    rest = F.get(F.transform(bound, lambda x: F.array_join(F.transform(x["left"], lambda k: F.get(x["lines"], k - 1)), "\n")), F.lit(0))
    text = F.when(F.col("__drop").isNull(), F.col("text")).otherwise(rest)
    return joined.select(*kept, text.alias("clean_text"), F.coalesce(F.size("__drop"), F.lit(0)).alias("n_removed"))
