"""Token counts under an existing tokenizer and token budgets per slice.

Counting is linear in the text. Each piece of the tokenizer's split pattern is
read through a trie of the vocabulary whose nodes carry a failure link and the
tokens emitted when that link is taken, so longest-match tokens come out in one
pass without backing up. For a longest-match vocabulary that is the answer. The
public vocabularies at hand are byte-level BPE, whose tokens differ from the
longest match in some pieces; a sequence of tokens is the BPE encoding exactly
if every neighbouring pair survives the merges on its own, so the longest match
is accepted where all its pairs survive and otherwise the one sequence with
that property is found by a left-to-right search over the same trie. Counts
equal the tokenizer's own.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmill.functions.text import primary_language, url_host

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: A vocabulary file is broadcast, so its size is bounded.
MAX_VOCABULARY_BYTES = 64 << 20
#: Pieces remembered by a worker; beyond it the memory starts anew.
MEMO_PIECES = 400_000
#: Pieces of more bytes are counted block by block of the search, never remembered.
MEMO_PIECE_BYTES = 64

# The split pattern published with the byte-level vocabularies.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The same pattern for texts of ASCII characters only.
_ASCII_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"""
# Longest-match and exact counts travel in one integer.
_SHIFT = 32


def read_vocabulary(path: str) -> bytes:
    """The bytes of a rank file ("base64 rank" per line); its size is checked."""
    if os.path.getsize(path) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path}: a vocabulary of more than {MAX_VOCABULARY_BYTES} bytes is not broadcast")
    with open(path, "rb") as stream:
        return stream.read()


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line.strip())}


class TokenCounter(dict):
    """Maps a piece to ``longest << 32 | exact``; missing pieces are computed.

    ``exact`` is the BPE count, ``longest`` the greedy longest-match count.
    """

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError("every single byte must be a token of the vocabulary")
        self.ranks = ranks
        self.pairs: dict[int, bool] = {}
        self._build()

    def _build(self) -> None:
        child: dict[int, int] = {}
        token: list[int] = [-1]
        for text, rank in self.ranks.items():
            node = 0
            for byte in text:
                key = node << 8 | byte
                following = child.get(key)
                if following is None:
                    following = len(token)
                    child[key] = following
                    token.append(-1)
                node = following
            token[node] = rank
        fail = [0] * len(token)
        emit: list[tuple[int, ...]] = [()] * len(token)
        edges: list[list[tuple[int, int]]] = [[] for _ in token]
        for key, following in child.items():
            edges[key >> 8].append((key & 255, following))
        level = [0]
        while level:
            below = []
            for node in level:
                for byte, following in edges[node]:
                    below.append(following)
                    if token[following] >= 0:
                        emit[following] = (token[following],)
                        continue
                    state, out = fail[node], emit[node]
                    while (state << 8 | byte) not in child:
                        out += emit[state]
                        state = fail[state]
                    fail[following] = child[state << 8 | byte]
                    emit[following] = out
            level = below
        self.child, self.fail, self.emit, self.token = child, fail, emit, token
        self.spelling = {rank: text for text, rank in self.ranks.items()}

    def longest_match(self, data: bytes) -> list[int]:
        """Greedy longest-match tokens, in one pass."""
        child, fail, emit = self.child, self.fail, self.emit
        out: list[int] = []
        node = 0
        for byte in data:
            following = child.get(node << 8 | byte)
            while following is None:
                out += emit[node]
                node = fail[node]
                following = child.get(node << 8 | byte)
            node = following
        while node:
            out += emit[node]
            node = fail[node]
        return out

    def merged(self, data: bytes) -> list[int]:
        """Tokens by the merges themselves; only used for pairs of tokens."""
        ranks = self.ranks
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def stable(self, left: int, right: int) -> bool:
        """Whether the merges keep ``left`` and ``right`` apart when they stand side by side."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MEMO_PIECES:
                self.pairs.clear()
            known = self.merged(self.spelling[left] + self.spelling[right]) == [left, right]
            self.pairs[key] = known
        return known

    def exact(self, data: bytes, greedy: list[int] | None = None) -> list[int]:
        """The BPE encoding of one piece, in time linear in its length; ``greedy`` may bring its longest match."""
        greedy = self.longest_match(data) if greedy is None else greedy
        stable = self.stable
        if all(stable(a, b) for a, b in zip(greedy, greedy[1:])):
            return greedy
        child, token = self.child, self.token
        size = len(data)
        last = [-1] * (size + 1)
        for start in range(size):
            before = last[start]
            if start and before < 0:
                continue
            node = 0
            for end in range(start, size):
                node = child.get(node << 8 | data[end])
                if node is None:
                    break
                rank = token[node]
                if rank >= 0 and last[end + 1] < 0 and (not start or stable(before, rank)):
                    last[end + 1] = rank
        out, end = [], size
        while end:
            out.append(last[end])
            end -= len(self.spelling[last[end]])
        return out[::-1]

    def __missing__(self, piece: str) -> int:
        data = piece.encode("utf-8", "replace")
        greedy = self.longest_match(data)
        packed = len(greedy) << _SHIFT | len(self.exact(data, greedy))
        if len(data) <= MEMO_PIECE_BYTES:
            if len(self) >= MEMO_PIECES:
                self.clear()
            self[piece] = packed
        return packed


class TextMeasure:
    """Splits texts and counts their tokens; one per worker process."""

    def __init__(self, vocabulary: bytes):
        import regex

        self.counter = TokenCounter(parse_ranks(vocabulary))
        self.ascii = re.compile(_ASCII_PATTERN)
        self.unicode = regex.compile(SPLIT_PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))

    def packed(self, text: str) -> int:
        pieces = (self.ascii if text.isascii() else self.unicode).findall(text)
        return sum(map(self.counter.__getitem__, pieces))

    def count(self, text: str) -> int:
        """Exact number of tokens."""
        return self.packed(text) & ((1 << _SHIFT) - 1)

    def token_ends(self, text: str) -> list[int]:
        """For each token its end as a count of characters, where a token ends
        between characters; a token that ends inside a character ends after it."""
        ends, done = [], 0
        for piece in (self.ascii if text.isascii() else self.unicode).findall(text):
            data = piece.encode("utf-8", "replace")
            at = 0
            for rank in self.counter.exact(data):
                at += len(self.counter.spelling[rank])
                if len(data) == len(piece):
                    ends.append(done + at)
                else:
                    whole = at
                    while whole < len(data) and data[whole] & 0xC0 == 0x80:
                        whole += 1
                    ends.append(done + len(data[:whole].decode("utf-8", "replace")))
            done += len(piece)
        return ends


_MEASURES: dict[int, TextMeasure] = {}


def worker_measure(vocabulary: bytes) -> TextMeasure:
    """The measure of this worker process, made once per vocabulary."""
    key = hash(vocabulary)
    if key not in _MEASURES:
        _MEASURES.clear()
        _MEASURES[key] = TextMeasure(vocabulary)
    return _MEASURES[key]


def with_token_counts(df: DataFrame, text: str = "text", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """``df`` without column ``text``, with ``n_chars``, ``n_tokens`` and ``n_longest_match``.

    Null and empty texts have 0 of each. ``n_tokens`` is the tokenizer's own
    count, ``n_longest_match`` that of the greedy longest match. Columns of
    those names in ``df`` are replaced.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(read_vocabulary(vocabulary))
    made = ["n_chars", "n_tokens", "n_longest_match"]
    kept = [c for c in df.columns if c not in {text, *made}]
    source = df.select(*kept, F.col(text).alias("__text"))
    schema = T.StructType([*source.schema.fields[:-1], *(T.StructField(m, T.LongType()) for m in made)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = worker_measure(shared.value)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            packed = np.fromiter((measure.packed(t) if t else 0 for t in texts), np.int64, len(texts))
            chars = np.fromiter((len(t) if t else 0 for t in texts), np.int64, len(texts))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array(chars), pa.array(packed & ((1 << _SHIFT) - 1)), pa.array(packed >> _SHIFT)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *made])

    return source.mapInArrow(count, schema)


def token_budget(slices: DataFrame, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """Totals per ``dataset, source, lang, domain``.

    ``slices`` has ``dataset, id, text, source, lang, url``; other columns are
    ignored. Language tags are reduced to their primary subtag (``und`` if
    absent), the domain is the host of the url (``(none)`` if absent), a null
    source is ``(none)``. ``n_rows`` and ``n_tokens_rows`` count every row;
    ``n_texts``, ``n_chars``, ``n_tokens`` and ``n_longest_match`` count each
    distinct ``(dataset, id, source, lang, domain)`` once, so that rows
    delivered again do not add to the budget (a row without id counts by its
    own). An empty table gives no rows.
    """
    keys = ["dataset", "source", "lang", "domain"]
    named = slices.select(
        "dataset",
        F.coalesce("source", F.lit("(none)")).alias("source"),
        primary_language(F.col("lang")).alias("lang"),
        F.coalesce(url_host(F.col("url")), F.lit("(none)")).alias("domain"),
        F.when(F.col("id").isNull(), F.concat_ws(":", F.spark_partition_id(), F.monotonically_increasing_id())).alias("__row"),
        F.xxhash64("id", F.lit(1)).alias("__id"),
        F.xxhash64("id", F.lit(2)).alias("__id2"),
        "text",
    )
    counted = with_token_counts(named, "text", vocabulary)
    texts = counted.groupBy(*keys, "__id", "__id2", "__row").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("n_tokens").alias("all_tokens"),
        F.max("n_chars").alias("chars"),
        F.max("n_tokens").alias("tokens"),
        F.max("n_longest_match").alias("longest"),
    )
    return texts.groupBy(*keys).agg(
        F.sum("rows").alias("n_rows"),
        F.sum("all_tokens").alias("n_tokens_rows"),
        F.count(F.lit(1)).alias("n_texts"),
        F.sum("chars").alias("n_chars"),
        F.sum("tokens").alias("n_tokens"),
        F.sum("longest").alias("n_longest_match"),
    )


def corpus_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of ``chunks`` and ``parsed`` in the shape :func:`token_budget` takes."""
    parts = []
    for name, source in (("chunks", F.col("metadata.source")), ("parsed", F.col("source"))):
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        parts.append(table.select(F.lit(name).alias("dataset"), "id", "text", source.alias("source"), "lang", F.col("metadata.url").alias("url")))
    return parts[0].unionByName(parts[1])
