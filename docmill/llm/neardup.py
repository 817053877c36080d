"""Near-duplicate texts by b-bit MinHash.

Texts become sets of word shingles. Minima of ``bands * rows`` hash functions
give band keys, which bring similar texts together, and their lowest bits are
packed into a small signature. Candidates of the bands are kept if the
similarity estimated from equal bits, corrected for the bits that agree by
chance, is near the threshold; what is kept is checked on the shingles
themselves. Texts with equal shingle sets form one class that is hashed once,
so copies of a text, however many, do not multiply the work.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.llm.components import connected_components
from docmill.plans.runtime import materialize, tasks_for

#: The operator's own setting; queries may state another.
SHINGLE_WORDS = 5
THRESHOLD = 0.8
MIN_WORDS = 30
BANDS = 64
ROWS = 5
BITS = 2
#: Standard errors of the estimate that a candidate may lie under the threshold.
MARGIN = 4.0
#: Members of a band bucket above which its pairs are estimated before they are output.
HOT_BUCKET = 100
#: Members of such a bucket that are compared with as many others in one piece.
HOT_BLOCK = 2048
#: Pairs of band keys and classes that a task packs at a time.
PACKED_PAIRS = 2_000_000
_BITS_PER_LONG = 64 // BITS
_MEMO_WORDS = 300_000

_WORD = re.compile(r"\w+")
_ONE = np.uint64(1)


class ShingleHasher:
    """Shingle sets as 64-bit hashes, and their MinHash signatures."""

    def __init__(self, words: int, min_words: int, bands: int = BANDS, rows: int = ROWS, seed: int = 977):
        self.words, self.min_words, self.bands, self.rows = words, min_words, bands, rows
        rng = np.random.default_rng(seed)
        size = bands * rows
        self.factor = rng.integers(0, 1 << 32, size, dtype=np.uint32) | np.uint32(1)
        self.shift = rng.integers(0, 1 << 32, size, dtype=np.uint32)
        self.mixers = rng.integers(0, 1 << 63, rows, dtype=np.uint64) << _ONE | _ONE
        self.offsets = rng.integers(0, 1 << 63, bands, dtype=np.uint64)
        self.memo: dict[str, int] = {}

    def shingles(self, text: str | None) -> np.ndarray | None:
        """Distinct shingle hashes in order, or None for a text of too few words."""
        found = _WORD.findall(text.lower()) if text else []
        if len(found) < max(self.min_words, self.words):
            return None
        memo = self.memo
        if len(memo) > _MEMO_WORDS:
            memo.clear()
        for word in found:
            if word not in memo:
                memo[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        codes = np.fromiter(map(memo.__getitem__, found), np.uint64, len(found))
        n = len(codes) - self.words + 1
        mixed = np.zeros(n, np.uint64)
        for k in range(self.words):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + n]
            mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed)

    def set_key(self, shingles: np.ndarray) -> tuple[int, int]:
        value = xxhash.xxh3_128_intdigest(shingles.tobytes())
        return (value & 0xFFFFFFFFFFFFFFFF) - (1 << 63), (value >> 64) - (1 << 63)

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        low = np.full(self.bands * self.rows, np.uint32(0xFFFFFFFF))
        for start in range(0, len(x), 512):
            np.minimum(low, (x[start : start + 512, None] * self.factor + self.shift).min(axis=0), out=low)
        return low

    def band_keys(self, minima: np.ndarray) -> np.ndarray:
        keys = (minima.reshape(self.bands, self.rows).astype(np.uint64) * self.mixers).sum(axis=1, dtype=np.uint64) + self.offsets
        keys ^= keys >> np.uint64(31)
        keys *= np.uint64(0x94D049BB133111EB)
        return (keys ^ keys >> np.uint64(30)).view(np.int64)

    def packed_bits(self, minima: np.ndarray) -> np.ndarray:
        """The lowest ``BITS`` bits of each minimum, packed into longs."""
        low = (minima & np.uint32((1 << BITS) - 1)).astype(np.uint64)
        size = -(-len(low) // _BITS_PER_LONG) * _BITS_PER_LONG
        low = np.pad(low, (0, size - len(low))).reshape(-1, _BITS_PER_LONG)
        shifts = np.arange(_BITS_PER_LONG, dtype=np.uint64) * np.uint64(BITS)
        return np.bitwise_or.reduce(low << shifts, axis=1).view(np.int64)


def estimated_similarity(a: Column, b: Column, size: int) -> Column:
    """Similarity from two packed signatures: the share of equal minima, less those whose bits agree by chance."""
    differing = F.zip_with(a, b, lambda x, y: F.bit_count((x.bitwiseXOR(y).bitwiseOR(F.shiftrightunsigned(x.bitwiseXOR(y), 1))).bitwiseAND(F.lit(0x5555555555555555))))
    unequal = F.aggregate(differing, F.lit(0), lambda s, n: s + n)
    chance = 1.0 / (1 << BITS)
    return (F.lit(1.0) - unequal / F.lit(float(size)) - chance) / (1 - chance)


def signatures(texts: DataFrame, hasher: ShingleHasher) -> DataFrame:
    """``(id, k1, k2, bands, bits)`` of every text with enough words; equal ``k1, k2`` mean equal shingle sets."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, k1, k2, bands, bits = [], [], [], [], []
            known: dict[tuple[int, int], tuple] = {}
            for row, text in enumerate(batch.column(1).to_pylist()):
                shingles = hasher.shingles(text)
                if shingles is None:
                    continue
                key = hasher.set_key(shingles)
                if key not in known:
                    minima = hasher.minima(shingles)
                    known[key] = hasher.band_keys(minima), hasher.packed_bits(minima)
                index.append(row)
                k1.append(key[0])
                k2.append(key[1])
                bands.append(known[key][0])
                bits.append(known[key][1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(index, pa.int32())), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))],
                names=["id", "k1", "k2", "bands", "bits"],
            )

    return texts.select("id", "text").mapInArrow(sign, "id string, k1 bigint, k2 bigint, bands array<bigint>, bits array<bigint>")


#: Kinds of packed values: (key, class) pairs, pairs of large buckets, keys of large buckets.
_PAIRS, _LARGE, _KEYS = range(3)


def _sorted_pairs(pairs: np.ndarray) -> np.ndarray:
    """Distinct rows in order."""
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    return pairs[np.r_[True, (pairs[1:] != pairs[:-1]).any(axis=1)]] if len(pairs) else pairs


def _bucket_blobs(keyed: DataFrame, parts: int, hot: int) -> DataFrame:
    """``(part, kind, blob)``: (key, class) pairs of ``(keys array<bigint>, k1)`` packed per target partition.

    Packing in Python keeps a shuffled pair at 16 bytes. A bucket of which a
    task alone holds more than ``hot`` members is large: its members are spread
    over all partitions, and only its key goes to the partition of the bucket.
    So that partition gets at most ``hot`` members of it from each packing of
    ``PACKED_PAIRS`` pairs, however many it has.
    """

    def deal(part: np.ndarray, values: np.ndarray, kind: int) -> pa.RecordBatch:
        order = np.argsort(part, kind="stable")
        part, values = part[order].astype(np.int32), values[order]
        starts = np.r_[np.nonzero(np.r_[True, part[1:] != part[:-1]])[0], len(part)] if len(part) else np.zeros(1, int)
        blobs = [values[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])]
        return pa.RecordBatch.from_arrays([pa.array(part[starts[:-1]]), pa.array([kind] * len(blobs), pa.int32()), pa.array(blobs, pa.binary())], names=["part", "kind", "blob"])

    def packed(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        pairs = _sorted_pairs(np.concatenate(held))
        starts = np.nonzero(np.r_[True, pairs[1:, 0] != pairs[:-1, 0]])[0]
        sizes = np.diff(np.r_[starts, len(pairs)])
        large = np.repeat(sizes > hot, sizes)
        place = lambda values: (values.view(np.uint64) % np.uint64(parts)).astype(np.int32)
        yield deal(place(pairs[~large, 0].copy()), pairs[~large], _PAIRS)
        if large.any():
            yield deal(place(pairs[large, 1].copy()), pairs[large], _LARGE)
            keys = pairs[starts[sizes > hot], 0]
            yield deal(place(keys), keys, _KEYS)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            lists = batch.column(0)
            keys = lists.flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(batch.column(1).to_numpy(), lists.value_lengths().to_numpy(zero_copy_only=False))
            held.append(np.stack([keys, owner], axis=1))
            size += len(keys)
            if size > PACKED_PAIRS:
                yield from packed(held)
                held, size = [], 0
        if size:
            yield from packed(held)

    return keyed.select("keys", "k1").mapInArrow(pack, "part int, kind int, blob binary")


def _bucket_pairs(blobs: DataFrame, parts: int, hot: int) -> DataFrame:
    """``(a, b, hot_key)``: pairs of classes that share a key (``a < b``).

    Buckets of more than ``hot`` members give, instead of pairs, one row
    ``(member, null, key)`` each, to be compared by the caller.
    """

    def members(pairs: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 1].copy()), pa.nulls(len(pairs), pa.int64()), pa.array(pairs[:, 0].copy())], names=["a", "b", "hot_key"])

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        known: list[np.ndarray] = []
        for batch in batches:
            for part, kind, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == _LARGE:
                    yield members(np.frombuffer(blob, np.int64).reshape(-1, 2))
                elif kind == _KEYS:
                    known.append(np.frombuffer(blob, np.int64))
                else:
                    held.setdefault(part, []).append(blob)
        large_keys = np.unique(np.concatenate(known)) if known else np.zeros(0, np.int64)
        for part in list(held):
            pairs = _sorted_pairs(np.frombuffer(b"".join(held.pop(part)), np.int64).reshape(-1, 2))
            starts = np.nonzero(np.r_[True, pairs[1:, 0] != pairs[:-1, 0]])[0]
            sizes = np.diff(np.r_[starts, len(pairs)])
            large = (sizes > hot) | np.isin(pairs[starts, 0], large_keys)
            if large.any():
                yield members(pairs[np.repeat(large, sizes)])
            starts, sizes = starts[~large], sizes[~large]
            for size in np.unique(sizes[sizes > 1]):
                inside = pairs[starts[sizes == size][:, None] + np.arange(size)][:, :, 1]
                for first in range(size - 1):  # one output batch per first member keeps memory small
                    left = np.repeat(inside[:, first], size - 1 - first)
                    right = inside[:, first + 1 :].ravel()
                    yield pa.RecordBatch.from_arrays([pa.array(left), pa.array(right), pa.nulls(len(left), pa.int64())], names=["a", "b", "hot_key"])

    return blobs.repartitionById(parts, "part").mapInArrow(match, "a bigint, b bigint, hot_key bigint")


_CLASS_PAIR = ["a1", "a2", "b1", "b2"]


def _hot_pairs(hot: DataFrame, bits: DataFrame, size: int, least: float, block: int = HOT_BLOCK) -> DataFrame:
    """``(a1, a2, b1, b2)``: pairs of members ``(k1, hot_key)`` of one bucket whose estimated similarity is at least ``least``.

    A bucket is compared whole, in pairs of blocks that are spread over tasks.
    """
    hot = hot.distinct()
    blocks = hot.groupBy("hot_key").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    sized = hot.join(bits, "k1").join(blocks, "hot_key").withColumn("own", F.pmod(F.xxhash64("k1"), "blocks"))
    # A member meets its own block and every other: once as the lower and once as the higher of the two.
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")
    sent = sized.select("hot_key", "own", "k1", "k2", "bits", other).select("hot_key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "k1", "k2", "bits")
    chance = 1.0 / (1 << BITS)

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        k1, k2, own = (table[name].to_numpy() for name in ("k1", "k2", "own"))
        packed = table["bits"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(k1), -1).view(np.uint64)
        low, high = key[1].as_py(), key[2].as_py()
        left, right = np.nonzero(own == low)[0], np.nonzero(own == high)[0]
        found = [np.zeros((0, 2), np.int64)]
        for start in range(0, len(left), 256):
            rows = left[start : start + 256]
            unequal = np.zeros((len(rows), len(right)), np.int32)
            for word in packed.T:
                x = word[rows, None] ^ word[None, right]
                unequal += np.bitwise_count((x | x >> _ONE) & np.uint64(0x5555555555555555))
            near = (1.0 - unequal / float(size) - chance) / (1 - chance) >= least
            if low == high:
                near &= rows[:, None] < right[None, :]
            i, j = np.nonzero(near)
            found.append(np.stack([rows[i], right[j]], axis=1))
        one, two = np.concatenate(found).T
        # The smaller class first.
        swap = (k1[one] > k1[two]) | (k1[one] == k1[two]) & (k2[one] > k2[two])
        one, two = np.where(swap, two, one), np.where(swap, one, two)
        return pa.table(dict(zip(_CLASS_PAIR, map(pa.array, (k1[one], k2[one], k1[two], k2[two])))))

    return sent.groupBy("hot_key", "low", "high").applyInArrow(compare, ", ".join(f"{c} bigint" for c in _CLASS_PAIR))


def near_pairs(classes: DataFrame, size: int, least: float, hot_bucket: int = HOT_BUCKET, bands: int = BANDS) -> DataFrame:
    """Distinct pairs ``(a1, a2, b1, b2)`` of classes ``(k1, k2, bands, bits)`` that share a band and are similar by the estimate.

    The estimate is made on the joined pairs, or, in a bucket above
    ``hot_bucket`` members, before pairs are output; both give the same. Pairs
    of a band name a class by half of its key; where two classes share it, both
    come back from the join and are told apart by their signatures.
    """
    parts = tasks_for(classes.count() * bands, 1_500_000, least=12)
    blobs = _bucket_blobs(classes.select(F.col("bands").alias("keys"), "k1"), parts, hot_bucket)
    found = materialize(_bucket_pairs(blobs, parts, hot_bucket), "band-pairs")
    bits = classes.groupBy("k1", "k2").agg(F.any_value("bits").alias("bits"))
    one, two = (bits.select(F.col("k1").alias(n), F.col("k1").alias(f"{n}1"), F.col("k2").alias(f"{n}2"), F.col("bits").alias(f"bits_{n}")) for n in "ab")
    joined = found.filter("b IS NOT NULL").select("a", "b").distinct().join(one, "a").join(two, "b")
    pairs = joined.filter(estimated_similarity(F.col("bits_a"), F.col("bits_b"), size) >= least).select(*_CLASS_PAIR)
    hot = found.filter("hot_key IS NOT NULL").select(F.col("a").alias("k1"), "hot_key")
    if not hot.isEmpty():
        pairs = pairs.unionByName(_hot_pairs(hot, bits, size, least)).distinct()
    return pairs


class NearDuplicates:
    """Members of the classes of equal shingle sets, and verified pairs of classes.

    ``texts`` has ``id, text``; other columns are ignored. Null ids, null texts
    and texts of fewer than ``min_words`` words take no part. A repeated row
    counts once.
    """

    def __init__(self, texts: DataFrame, words: int = SHINGLE_WORDS, threshold: float = THRESHOLD, min_words: int = MIN_WORDS, bands: int = BANDS, rows: int = ROWS, hot_bucket: int = HOT_BUCKET):
        self.hasher = ShingleHasher(words, min_words, bands, rows)
        self.threshold = threshold
        self.texts = texts.filter(F.col("id").isNotNull()).select(F.col("id").cast("string").alias("id"), "text")
        self.signed = materialize(signatures(self.texts, self.hasher), "signatures")
        self.members = self.signed.select("k1", "k2", "id").distinct()
        self.pairs = materialize(self._verified(self._near(hot_bucket)), "similar-pairs")

    def _near(self, hot_bucket: int) -> DataFrame:
        """Candidates whose estimate lies within the margin of the threshold."""
        size = self.hasher.bands * self.hasher.rows
        chance = 1.0 / (1 << BITS)
        agree = self.threshold + (1 - self.threshold) * chance
        least = self.threshold - MARGIN * (agree * (1 - agree) / size) ** 0.5 / (1 - chance)
        return materialize(near_pairs(self.signed.select("k1", "k2", "bands", "bits"), size, least, hot_bucket, self.hasher.bands), "near-pairs")

    def _verified(self, near: DataFrame) -> DataFrame:
        """``(id_a, id_b, similarity)``, in representatives (smallest ids) of the classes: candidates at or above the threshold, by their shingles."""
        involved = near.select(F.col("a1").alias("k1"), F.col("a2").alias("k2")).union(near.select("b1", "b2")).distinct()
        reps = self.signed.join(involved, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.min("id").alias("id"))
        # An id that was delivered with several texts may bring one of another class, which the keys tell.
        texts = reps.join(self.texts, "id").dropDuplicates(["k1", "k2", "text"])
        hasher, threshold = self.hasher, self.threshold

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            memo: dict[str, tuple] = {}

            def sets(text: str, key: tuple[int, int]) -> np.ndarray | None:
                if text not in memo:
                    if len(memo) > 2000:
                        memo.clear()
                    shingles = hasher.shingles(text)
                    memo[text] = shingles, None if shingles is None else hasher.set_key(shingles)
                shingles, own = memo[text]
                return shingles if own == key else None

            for batch in batches:
                kept = []
                for a1, a2, b1, b2, id_a, id_b, text_a, text_b in zip(*(c.to_pylist() for c in batch.columns)):
                    one, two = sets(text_a, (a1, a2)), sets(text_b, (b1, b2))
                    if one is None or two is None:
                        continue
                    common = len(np.intersect1d(one, two, assume_unique=True))
                    # As a quotient of whole numbers, so that a similarity equal to the threshold counts.
                    similarity = common / (len(one) + len(two) - common)
                    if similarity >= threshold:
                        kept.append((a1, a2, b1, b2, id_a, id_b, similarity))
                if kept:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*kept)], names=[*_CLASS_PAIR, "id_a", "id_b", "similarity"])

        one, two = (texts.select(F.col("k1").alias(f"{n}1"), F.col("k2").alias(f"{n}2"), F.col("id").alias(f"id_{n}"), F.col("text").alias(f"text_{n}")) for n in "ab")
        pairs = near.join(one, ["a1", "a2"]).join(two, ["b1", "b2"]).select(*_CLASS_PAIR, "id_a", "id_b", "text_a", "text_b")
        return pairs.mapInArrow(compare, ", ".join(f"{c} bigint" for c in _CLASS_PAIR) + ", id_a string, id_b string, similarity double").distinct()

    def id_pairs(self) -> DataFrame:
        """Distinct ``(id_a, id_b)``, ``id_a < id_b``: members of similar classes and of one class."""
        m = self.members
        shared = m.join(m.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("k1", "k2"), ["k1", "k2"], "left_semi")
        same = shared.withColumnRenamed("id", "x").join(shared.withColumnRenamed("id", "y"), ["k1", "k2"]).select("x", "y")
        one, two = (m.select(F.col("k1").alias(f"{n}1"), F.col("k2").alias(f"{n}2"), F.col("id").alias(as_)) for n, as_ in (("a", "x"), ("b", "y")))
        across = self.pairs.select(*_CLASS_PAIR).join(one, ["a1", "a2"]).join(two, ["b1", "b2"]).select("x", "y")
        # A class holds one id once; only the pairs within a class come in both directions.
        either = same.filter("x < y").unionByName(across.filter("x != y"))
        return either.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()

    def groups(self) -> DataFrame:
        """``(id, group_id, n_links, n_copies)``: one row per text that took part.

        ``group_id`` is the smallest id of the connected group, ``n_links`` the
        number of similar classes of other texts, ``n_copies`` the number of
        ids with the same shingles. An id with several texts counts with the
        one of the smallest group.
        """
        components = connected_components(self.pairs, "id_a", "id_b").withColumnRenamed("node", "rep")
        copies = self.members.groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n_copies"))
        ends = F.explode(F.array(F.struct(F.col("a1").alias("k1"), F.col("a2").alias("k2")), F.struct(F.col("b1").alias("k1"), F.col("b2").alias("k2")))).alias("k")
        links = self.pairs.select(ends).groupBy("k.k1", "k.k2").agg(F.count(F.lit(1)).alias("n_links"))
        classes = copies.join(components, "rep", "left").join(links, ["k1", "k2"], "left").select(
            "k1", "k2", F.coalesce("component", "rep").alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies"
        )
        rows = self.members.join(classes, ["k1", "k2"]).groupBy("id").agg(F.min(F.struct("group_id", "n_links", "n_copies")).alias("r"))
        return rows.select("id", "r.*")
