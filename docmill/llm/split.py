"""Cutting oversized items at topic boundaries, with overlap.

A text is read as a row of sentences and lines. Neighbouring blocks of words
are compared at every gap (lexical cohesion); a valley of that similarity marks
a change of topic. Each piece ends at the deepest valley of the window that the
size limit allows, and the next piece starts ``overlap`` characters earlier.
Only where a single sentence is too long the cut goes to white space, and only
where there is none between any two characters. Joining the pieces without
their overlaps gives the text back exactly.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.llm.tokens import DEFAULT_VOCABULARY, read_vocabulary, worker_measure

#: Limit and overlap for sections, in code points.
SECTION_LIMIT = 2400
SECTION_OVERLAP = 200
#: Words on either side of a gap that are compared.
BLOCK_WORDS = 60
#: A piece is at least this share of the limit where a valley allows it.
LEAST_FILL = 0.5

_WORD = re.compile(r"\w+")
#: Ends of units: after a sentence end with white space, after a line end, after CJK stops.
_UNIT_END = re.compile(r"(?<=[.!?…])[\"'”’)\]]*\s+|\n\s*|(?<=[。！？；])")
_SPACE = re.compile(r"\s+")


def unit_ends(text: str) -> list[int]:
    """Ends of the sentences and lines of ``text``; the last is its length. Fenced code breaks at lines only."""
    ends, fence_at = [], []
    if "```" in text or "~~~" in text:
        open_at = None
        for m in re.finditer(r"^[ \t]*(`{3,}|~{3,})", text, re.M):
            if open_at is None:
                open_at = (m.start(), m[1][0])
            elif open_at[1] == m[1][0]:
                fence_at.append((open_at[0], m.end()))
                open_at = None
    k = 0
    for m in _UNIT_END.finditer(text):
        end = m.end()
        while k < len(fence_at) and fence_at[k][1] < end:
            k += 1
        if k < len(fence_at) and fence_at[k][0] < m.start() and "\n" not in m[0]:
            continue
        if 0 < end < len(text) and (not ends or end > ends[-1]):
            ends.append(end)
    return [*ends, len(text)]


def valley_depths(text: str, ends: list[int], block: int = BLOCK_WORDS) -> list[float]:
    """Depth of the cohesion valley at each inner end (paragraph ends count a little deeper).

    Word windows slide along the gaps, so the work is linear in the text.
    """
    words: list[str] = []
    gap_at = []
    start = 0
    for end in ends:
        words += _WORD.findall(text[start:end].lower())
        gap_at.append(len(words))
        start = end
    left: Counter = Counter()
    right: Counter = Counter()
    dot = left_sq = right_sq = 0

    def change(side: Counter, other: Counter, word: str, by: int) -> tuple[int, int]:
        old = side[word]
        side[word] = old + by
        return other[word] * by, (old + by) ** 2 - old**2

    similarity = []
    left_lo = left_hi = right_hi = 0
    for at in gap_at[:-1]:
        while right_hi < min(len(words), at + block):
            d, s = change(right, left, words[right_hi], 1)
            dot, right_sq, right_hi = dot + d, right_sq + s, right_hi + 1
        while left_hi < at:
            d, s = change(right, left, words[left_hi], -1)
            dot, right_sq = dot + d, right_sq + s
            d, s = change(left, right, words[left_hi], 1)
            dot, left_sq, left_hi = dot + d, left_sq + s, left_hi + 1
        while left_lo < at - block:
            d, s = change(left, right, words[left_lo], -1)
            dot, left_sq, left_lo = dot + d, left_sq + s, left_lo + 1
        similarity.append(dot / math.sqrt(left_sq * right_sq) if left_sq and right_sq else 0.0)
    n = len(similarity)
    rise_left, rise_right = similarity[:], similarity[:]
    for k in range(1, n):  # climb to the peak on either side
        if similarity[k - 1] >= similarity[k]:
            rise_left[k] = rise_left[k - 1]
    for k in range(n - 2, -1, -1):
        if similarity[k + 1] >= similarity[k]:
            rise_right[k] = rise_right[k + 1]
    depths = []
    for k, s in enumerate(similarity):
        bonus = 0.05 if text.endswith("\n\n", 0, ends[k]) else 0.0
        depths.append(rise_left[k] + rise_right[k] - 2 * s + bonus)
    return depths


def cut_points(text: str, limit: int, overlap: int, fits: Callable[[int, int], bool] | None = None) -> list[tuple[int, int]]:
    """Spans ``[start, end)`` of the pieces of ``text``; each after the first starts ``overlap`` before the previous end.

    ``fits(start, end)`` tells whether a span keeps the limit where the limit
    is not a number of characters; a span of at most ``limit`` characters is
    then only a proposal that is shortened until it fits.
    """
    if limit <= 0 or not 0 <= overlap < limit:
        raise ValueError("need limit > 0 and 0 <= overlap < limit")
    size = len(text)
    if size <= limit and (fits is None or fits(0, size)):
        return [(0, size)] if size else []
    ends = unit_ends(text)
    depths = valley_depths(text, ends)
    spans, start, first, shared = [], 0, 0, 0
    while True:
        far = min(size, start + limit)
        while fits is not None and not fits(start, far) and far - start > 1:
            far = start + max(1, (far - start) * 9 // 10)
        if far >= size:
            spans.append((start, size))
            return spans
        least = max(start + shared + 1, start + int((far - start) * LEAST_FILL))
        while first < len(ends) and ends[first] <= start + shared:
            first += 1
        k, best, best_depth, nearest = first, None, -1.0, None
        while k < len(depths) and ends[k] <= far:
            nearest = ends[k]
            if ends[k] >= least and depths[k] >= best_depth:
                best, best_depth = ends[k], depths[k]
            k += 1
        cut = best or nearest
        if cut is None:
            for m in _SPACE.finditer(text, start + shared + 1, far):
                cut = m.end()
        cut = cut or far
        spans.append((start, cut))
        shared = min(overlap, cut - start - 1)
        start = cut - shared


def _pieces(kind: str, key: str, text: str, limit: int, overlap: int, fits=None) -> list[tuple]:
    spans = cut_points(text, limit, overlap, fits)
    before = 0
    rows = []
    for number, (start, end) in enumerate(spans):
        rows.append((kind, key, number, len(spans), start, end, max(0, before - start), text[start:end]))
        before = end
    return rows


PIECE_SCHEMA = "kind string, id string, piece_no int, n_pieces int, start int, `end` int, overlap int, text string"
_PIECE_TYPES = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
_PIECE_NAMES = ["kind", "id", "piece_no", "n_pieces", "start", "end", "overlap", "text"]


def split_items(items: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Pieces of the items that are larger than their limit.

    ``items`` has ``kind, id, text, size, overlap, unit`` (unit 'characters' or
    'tokens'); other columns are ignored. Items within the limit, with null or
    empty text, or with a null or non-positive size, give no rows; a null
    overlap is 0 and an overlap of the limit or more is the limit less 1.
    Repeated rows give repeated pieces. Token limits are measured with
    ``vocabulary`` (a rank file); without one such items give no rows.
    The filter on size runs in the JVM before any text goes to Python.
    """
    units = ["characters"] if vocabulary is None else ["characters", "tokens"]
    long = F.when(F.col("unit") == "characters", F.length("text") > F.col("size")).otherwise(F.octet_length("text") > F.col("size"))
    todo = items.filter(F.col("unit").isin(units) & (F.col("size") > 0) & long).select(
        "kind", "id", "text", F.col("size").cast("int").alias("size"), F.greatest(F.lit(0), F.coalesce(F.least("overlap", F.col("size") - 1), F.lit(0))).cast("int").alias("overlap"), "unit"
    )
    shared = items.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary)) if vocabulary else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = worker_measure(shared.value) if shared else None
        for batch in batches:
            rows = []
            for kind, key, text, size, overlap, unit in zip(*(c.to_pylist() for c in batch.columns)):
                if unit == "characters":
                    rows += _pieces(kind, key, text, size, overlap)
                elif (total := measure.count(text)) > size:
                    # Overlap and proposal go by this text's own characters per token.
                    ratio = len(text) / total
                    proposal = max(1, int(size * ratio * 1.1))
                    fits = lambda a, b, text=text, size=size: measure.count(text[a:b]) <= size
                    rows += _pieces(kind, key, text, proposal, min(int(overlap * ratio), proposal - 1), fits)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PIECE_TYPES)], names=_PIECE_NAMES)

    return todo.mapInArrow(cut, PIECE_SCHEMA)


def sized_items(spark: SparkSession, sf_dir: str, limit: int = SECTION_LIMIT, overlap: int = SECTION_OVERLAP) -> DataFrame:
    """All chunks with their own limits and all sections with the given one."""
    chunks = spark.read.parquet(f"{sf_dir}/chunks.parquet")
    conf = F.col("metadata.configuration")
    unit: Column = F.split_part(conf["budget"], F.lit(":"), F.lit(1))
    parsed = spark.read.parquet(f"{sf_dir}/parsed.parquet")
    return chunks.select(F.lit("chunk").alias("kind"), "id", "text", conf["size"].alias("size"), conf["overlap"].alias("overlap"), unit.alias("unit")).unionByName(
        parsed.select(F.lit("section").alias("kind"), "id", "text", F.lit(limit).alias("size"), F.lit(overlap).alias("overlap"), F.lit("characters").alias("unit"))
    )


def found_oversized(items: DataFrame) -> DataFrame:
    """Distinct ``(kind, id)`` of the items that were cut, limits in characters."""
    return split_items(items).filter("n_pieces > 1").select("kind", "id").distinct()


def split_corpus(spark: SparkSession, sf_dir: str, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """Pieces of every oversized chunk and section; a row delivered again gives its pieces once."""
    return split_items(sized_items(spark, sf_dir), vocabulary).dropDuplicates(["kind", "id", "piece_no", "start", "end"])
