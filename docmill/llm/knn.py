"""The k most similar vectors for every vector, by cross-polytope hashing.

A vector is rotated by ``H D3 H D2 H D1`` (fast Hadamard transforms and random
signs) and hashed to the nearest signed axis; a table joins the axes of two or
more rotations to one bucket. Every distinct vector is indexed once per table
and looks into its own bucket and the next likely ones (multiprobe). Candidates
are ranked by their exact cosine inside the bucket, so the shuffle carries
vectors to buckets and nothing quadratic leaves a task. Buckets above a size are
compared whole, in pairs of blocks that are spread over tasks; a vector that
meets fewer than k others is compared with all.

Vectors and results travel packed, one binary value per batch and target
partition, and a vector goes to a partition once, however many of its buckets
are there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docmill.plans.runtime import materialize, tasks_for

TABLES = 8
PROBES = 4
#: Indexed vectors of a bucket that are compared with each other in one piece.
BUCKET_ROWS = 8192
#: Vectors that share a bucket on average at most; above it a table takes one more rotation.
FILL = 2048
#: Such buckets, whose numbers every task holds.
MAX_LARGE = 1_000_000
DIGITS = 9
#: Up to this width the three transforms of a rotation are composed once, and a rotation is one matrix product.
COMPOSED_WIDTH = 512


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform along the last axis (a power of two long), not normalised."""
    n = x.shape[-1]
    step = 1
    while step < n:
        y = x.reshape(*x.shape[:-1], n // (2 * step), 2, step)
        x = np.stack([y[..., 0, :] + y[..., 1, :], y[..., 0, :] - y[..., 1, :]], axis=-2).reshape(x.shape)
        step *= 2
    return x


class CrossPolytope:
    """Signed-axis hashes of unit vectors; the same seed gives the same hashes everywhere."""

    def __init__(self, dim: int, functions: int, seed: int = 20260101):
        self.width = 1 << max(0, dim - 1).bit_length()
        rng = np.random.default_rng(seed)
        self.signs = rng.choice(np.array([-1.0, 1.0]), size=(functions, 3, self.width))

        self.composed: dict[int, np.ndarray] = {}

    def rotate(self, unit: np.ndarray, function: int) -> np.ndarray:
        if self.width > COMPOSED_WIDTH:
            x = np.zeros((len(unit), self.width))
            x[:, : unit.shape[1]] = unit
            return self._transform(x, function)
        if function not in self.composed:
            self.composed[function] = self._transform(np.eye(self.width), function)
        return unit @ self.composed[function][: unit.shape[1]]

    def _transform(self, x: np.ndarray, function: int) -> np.ndarray:
        for signs in self.signs[function]:
            x = hadamard(x * signs)
        return x / self.width**1.5

    def keys(self, unit: np.ndarray, first: int, count: int, probes: int) -> np.ndarray:
        """Buckets of ``count`` functions from ``first`` on, the likeliest first: shape (n, probes)."""
        tops = min(4, self.width)
        code, loss = np.zeros((len(unit), 1), np.int64), np.zeros((len(unit), 1))
        for f in range(first, first + count):
            y = self.rotate(unit, f)
            size = np.abs(y)
            axes = np.argpartition(size, self.width - tops, axis=1)[:, self.width - tops :]
            best = np.take_along_axis(size, axes, 1)
            order = np.argsort(-best, axis=1, kind="stable")
            axes, best = np.take_along_axis(axes, order, 1), np.take_along_axis(best, order, 1)
            signed = axes * 2 + (np.take_along_axis(y, axes, 1) < 0)
            code = (code[:, :, None] * (2 * self.width) + signed[:, None, :]).reshape(len(unit), -1)
            loss = (loss[:, :, None] + ((best[:, :1] - best) ** 2)[:, None, :]).reshape(len(unit), -1)
        order = np.argsort(loss, axis=1, kind="stable")[:, :probes]
        return np.take_along_axis(code, order, 1)


def usable(vector: str, dim: int):
    """Condition: ``dim`` values, none null or non-finite, not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return v.isNotNull() & (F.size(v) == dim) & finite & F.exists(v, lambda x: x != 0)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def functions_for(rows: int, width: int, least: int = 2) -> int:
    """Rotations per table, so that ``FILL`` vectors share a bucket on average at most."""
    functions = least
    while rows > FILL * (2 * width) ** functions:
        functions += 1
    return functions


def _hashed(vectors: DataFrame, dim: int, tables: int, probes: int, functions: int) -> DataFrame:
    """``(rep, vector, slots)``: the buckets of each vector, ``probes`` per table; the first of a table indexes it."""
    hashes = CrossPolytope(dim, tables * functions)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                piece = batch.slice(start, 2048)
                x = _matrix(piece.column("vector"), dim)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                keys = [hashes.keys(x, functions * t, functions, probes) * tables + t for t in range(tables)]
                slots = np.concatenate(keys, axis=1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, slots.size + 1, slots.shape[1], dtype=np.int32)), pa.array(slots.ravel()))
                yield pa.RecordBatch.from_arrays([piece.column("rep"), piece.column("vector"), lists], names=["rep", "vector", "slots"])

    return vectors.select("rep", "vector").mapInArrow(emit, "rep bigint, vector array<float>, slots array<bigint>")


def _slot_sizes(hashed: DataFrame, probes: int) -> DataFrame:
    """``(slot, size)``: number of vectors that each bucket indexes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot, size = np.unique(batch.column(0).flatten().to_numpy()[::probes], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(size)], names=["slot", "size"])

    return hashed.select("slots").mapInArrow(count, "slot bigint, size bigint").groupBy("slot").agg(F.sum("size").alias("size"))


_ENTRY = np.dtype([("slot", "<i8"), ("at", "<i4"), ("home", "?")])
_PAIR = np.dtype([("rep", "<i8"), ("other", "<i8"), ("cosine", "<f8")])


def _cuts(sorted_values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    if not len(sorted_values):
        return np.zeros(1, np.int64)
    return np.r_[0, np.nonzero(sorted_values[1:] != sorted_values[:-1])[0] + 1, len(sorted_values)]


def _pack_entries(hashed: DataFrame, dim: int, tables: int, probes: int, parts: int, left_out: np.ndarray) -> DataFrame:
    """``(part, reps, vectors, entries)``: what a batch sends to a partition; slots ``left_out`` are not sent.

    The partition of a bucket follows from its table and its leading axes, which
    the probes of a vector often share.
    """
    width = 2 * CrossPolytope(dim, 0).width
    spread = np.int64(max(1, -(-parts // (2 * width))))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                piece = batch.slice(start, 2048)
                vectors = piece.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                reps = piece.column("rep").to_numpy()
                slots = piece.column("slots").flatten().to_numpy()
                row = np.repeat(np.arange(len(reps)), tables * probes)
                home = np.arange(len(slots)) % probes == 0
                if len(left_out):
                    stays = left_out[np.minimum(np.searchsorted(left_out, slots), len(left_out) - 1)] != slots
                    slots, row, home = slots[stays], row[stays], home[stays]
                table, code = slots % tables, slots // tables
                lead = (code // width * tables + table) * spread + code % width % spread
                part = (lead.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(parts)
                order = np.lexsort((row, part))
                part, row, slots, home = part[order].astype(np.int32), row[order], slots[order], home[order]
                cuts = _cuts(part)
                out = []
                for a, b in zip(cuts[:-1], cuts[1:]):
                    sent, at = np.unique(row[a:b], return_inverse=True)
                    entries = np.empty(b - a, _ENTRY)
                    entries["slot"], entries["at"], entries["home"] = slots[a:b], at, home[a:b]
                    out.append((part[a], reps[sent].tobytes(), vectors[sent].astype("<f4").tobytes(), entries.tobytes()))
                columns = list(zip(*out)) if out else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], names=["part", "reps", "vectors", "entries"])

    return hashed.select("rep", "vector", "slots").mapInArrow(pack, "part int, reps binary, vectors binary, entries binary")


def _bucket_best(x: np.ndarray, ids: np.ndarray, entries: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Pairs of each entry with the ``k`` nearest indexed vectors of its bucket; small buckets are scored together."""
    entries = entries[np.lexsort((ids[entries["at"]], entries["slot"]))]
    cuts = _cuts(entries["slot"])
    homes = np.add.reduceat(entries["home"].astype(np.int64), cuts[:-1]) if len(entries) else np.zeros(0, np.int64)
    sizes = np.diff(cuts)
    useful = np.nonzero((homes > 0) & (sizes > 1))[0]
    padded = 1 << np.ceil(np.log2(np.maximum(sizes, 2))).astype(np.int64), 1 << np.ceil(np.log2(np.maximum(homes, 2))).astype(np.int64)
    useful = useful[np.lexsort((padded[0][useful], padded[1][useful]))]
    shape = padded[1][useful] << 32 | padded[0][useful]
    runs = _cuts(shape)
    indexed = np.nonzero(entries["home"])[0]
    home_starts = np.searchsorted(indexed, cuts[:-1])
    at = entries["at"]
    for a, b in zip(runs[:-1], runs[1:]):
        asked, data = int(padded[0][useful[a]]), int(padded[1][useful[a]])
        for first in range(a, b, max(1, 2_000_000 // (asked * data))):
            some = useful[first : min(b, first + max(1, 2_000_000 // (asked * data)))]
            for low in range(0, asked, 4096):  # a bucket of many askers is scored in slices
                place = np.arange(low, min(asked, low + 4096))
                q_ok = place < sizes[some, None]
                q = at[np.minimum(cuts[some, None] + place, len(at) - 1)]
                d_ok = np.arange(data) < homes[some, None]
                d = at[indexed[np.minimum(home_starts[some, None] + np.arange(data), len(indexed) - 1)]]
                scores = np.round(np.matmul(x[q], x[d].transpose(0, 2, 1)), DIGITS)
                scores[~d_ok[:, None, :].repeat(len(place), 1) | (ids[q][:, :, None] == ids[d][:, None, :])] = -np.inf
                # Indexed vectors stand in the order of their ids, which a stable sort keeps among equals.
                best = np.argsort(-scores, axis=2, kind="stable")[:, :, :k]
                value = np.take_along_axis(scores, best, 2)
                ok = (value > -np.inf) & q_ok[:, :, None]
                found = np.empty(int(ok.sum()), _PAIR)
                found["rep"] = np.broadcast_to(ids[q][:, :, None], ok.shape)[ok]
                found["other"] = ids[np.take_along_axis(d[:, None, :].repeat(len(place), 1), best, 2)][ok]
                found["cosine"] = value[ok]
                yield found


def _top(pairs: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` best distinct partners of each ``rep``, ties to the smallest.

    A pair that was scored twice has equal cosines but for the last digit, so
    the best ``2 * k`` rows, equal rows counted once, hold what is wanted.
    """
    if not len(pairs):
        return pairs
    reps, rank = pairs["rep"], -np.rint(pairs["cosine"] * 10**DIGITS).astype(np.int64)
    _, local = np.unique(reps, return_inverse=True)
    pairs = pairs[np.lexsort((pairs["other"], local << 32 | rank + 2 * 10**DIGITS))]
    for limit in (2 * k, k):
        reps, others = pairs["rep"], pairs["other"]
        if limit == k:  # the few that are left, in the order of partners
            order = np.lexsort((-pairs["cosine"], others, reps))
            once = np.r_[True, (reps[order][1:] != reps[order][:-1]) | (others[order][1:] != others[order][:-1])]
            pairs = pairs[np.sort(order[once])]
        else:
            pairs = pairs[np.r_[True, (reps[1:] != reps[:-1]) | (others[1:] != others[:-1])]]
        cuts = _cuts(pairs["rep"])
        pairs = pairs[np.arange(len(pairs)) - np.repeat(cuts[:-1], np.diff(cuts)) < limit]
    return pairs


def _ranked(packed: DataFrame, dim: int, k: int, parts: int, merging: int) -> DataFrame:
    """``(rep, other, cosine)``: the best ``k`` of each vector over all of its buckets."""

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reps, vectors, entries, base = [], [], [], 0
        for batch in batches:
            for _, r, v, e in zip(*(c.to_pylist() for c in batch.columns)):
                entry = np.frombuffer(e, _ENTRY).copy()
                entry["at"] += base
                reps.append(np.frombuffer(r, "<i8"))
                vectors.append(np.frombuffer(v, "<f4").reshape(-1, dim))
                entries.append(entry)
                base += len(reps[-1])
        if not entries:
            return
        x = np.concatenate(vectors).astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        held, size = [], 0
        for found in _bucket_best(x, np.concatenate(reps), np.concatenate(entries), k):
            held.append(found)
            size += len(found)
            if size > 1_000_000:
                held = [_top(np.concatenate(held), k)]
                size = len(held[0])
        pairs = _top(np.concatenate(held), k) if held else np.empty(0, _PAIR)
        part = (pairs["rep"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(merging)
        order = np.argsort(part, kind="stable")
        part, pairs = part[order].astype(np.int32), pairs[order]
        cuts = _cuts(part)
        yield pa.RecordBatch.from_arrays([pa.array(part[cuts[:-1]] if len(part) else part), pa.array([pairs[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())], names=["part", "pairs"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.frombuffer(blob, _PAIR) for batch in batches for blob in batch.column(1).to_pylist()]
        if held:
            best = _top(np.concatenate(held), k)
            yield pa.RecordBatch.from_arrays([pa.array(best[name].copy()) for name in _PAIR.names], names=list(_PAIR.names))

    found = packed.repartitionById(parts, "part").mapInArrow(rank, "part int, pairs binary")
    return found.repartitionById(merging, "part").mapInArrow(merge, "rep bigint, other bigint, cosine double")


def _best(scores: np.ndarray, data_ids: np.ndarray, query_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per query the ``k`` highest scores other than itself; ties go to the smallest id."""
    scores = np.where(data_ids[None, :] == query_ids[:, None], -np.inf, scores)
    if scores.shape[1] > k:
        least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        row, col = np.nonzero((scores >= least[:, None]) & (scores > -np.inf))
    else:
        row, col = np.nonzero(scores > -np.inf)
    value = scores[row, col]
    order = np.lexsort((data_ids[col], -value, row))
    row, col, value = row[order], col[order], value[order]
    if not len(row):
        return row, col, value
    first = np.r_[True, row[1:] != row[:-1]]
    rank = np.arange(len(row)) - np.maximum.accumulate(np.where(first, np.arange(len(row)), 0))
    keep = rank < k
    return row[keep], col[keep], value[keep]


def _rank_buckets(entries: DataFrame, keys: list[str], dim: int, k: int, parts: int, apart: bool = False) -> DataFrame:
    """``(rep, other, cosine)``: the best ``k`` of each query within each of its buckets.

    Indexed rows (``home``) are queries too, unless those come ``apart``.
    """

    def one(home: np.ndarray, ids: np.ndarray, x: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        data, data_ids = x[home], ids[home]
        out = []
        if not len(data):
            return out
        if apart:
            x, ids = x[~home], ids[~home]
        for start in range(0, len(x), 512):
            q, q_ids = x[start : start + 512], ids[start : start + 512]
            held: list[tuple[np.ndarray, ...]] = []
            for lo in range(0, len(data), BUCKET_ROWS):
                row, col, value = _best(np.round(q @ data[lo : lo + BUCKET_ROWS].T, DIGITS), data_ids[lo : lo + BUCKET_ROWS], q_ids, k)
                held.append((q_ids[row], data_ids[lo : lo + BUCKET_ROWS][col], value))
            out += held
        return out

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[pa.RecordBatch] = []

        def flush(table: pa.Table) -> Iterator[pa.RecordBatch]:
            marks = [table.column(name).to_numpy() for name in keys]
            change = np.zeros(table.num_rows, bool)
            change[0] = True
            for m in marks:
                change[1:] |= m[1:] != m[:-1]
            starts = np.r_[np.nonzero(change)[0], table.num_rows]
            home = table.column("home").to_numpy()
            ids = table.column("rep").to_numpy()
            x = _matrix(table.column("vector").combine_chunks(), dim)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            found: list[tuple[np.ndarray, ...]] = []
            for a, b in zip(starts[:-1], starts[1:]):
                if b - a > 1:
                    found += one(home[a:b], ids[a:b], x[a:b])
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names=["rep", "other", "cosine"])

        for batch in batches:
            if not batch.num_rows:
                continue
            pending.append(batch)
            if sum(p.num_rows for p in pending) < 4096:
                continue
            table = pa.Table.from_batches(pending)
            # The last bucket may go on in the next batch.
            last = [table.column(name)[table.num_rows - 1].as_py() for name in keys]
            cut = table.num_rows
            tail = np.ones(table.num_rows, bool)
            for name, value in zip(keys, last):
                tail &= table.column(name).to_numpy() == value
            cut = int(np.argmax(tail))
            if cut:
                yield from flush(table.slice(0, cut))
            pending = table.slice(cut).to_batches()
        if pending:
            yield from flush(pa.Table.from_batches(pending))

    sorted_entries = entries.repartition(parts, *keys).sortWithinPartitions(*keys, "rep")
    return sorted_entries.mapInArrow(rank, "rep bigint, other bigint, cosine double")


def nearest_vectors(
    points: DataFrame, k: int = 5, dim: int = 64, tables: int = TABLES, probes: int = PROBES, bucket_rows: int = BUCKET_ROWS, functions: int | None = None
) -> DataFrame:
    """``(vec_id, neighbour, cosine, rank)``: the ``k`` nearest others of each usable vector.

    Cosine in double precision rounded to 9 decimals, ties to the smallest
    ``vec_id``. Unusable vectors (null, wrong length, null or non-finite
    values, all zero) and rows with null ``vec_id`` take no part. Other columns
    are ignored; a repeated ``vec_id`` counts once (its vectors must agree).
    Equal vectors are hashed once, as one class with its ``k + 1`` smallest
    ids, so a vector repeated in most rows costs no more than a rare one. A
    vector that meets fewer than ``k`` other classes in its buckets is compared
    with all, so fewer than ``k`` rows come out only where there are fewer
    others. ``functions`` per table follow from the number of vectors if unset.
    """
    vectors = points.select("vec_id", "vector").filter(F.col("vec_id").isNotNull() & usable("vector", dim)).select("vec_id", F.col("vector").cast("array<float>").alias("vector"))
    vectors = vectors.withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64("vector", F.lit(7))})
    least = Window.partitionBy("h1", "h2").orderBy("vec_id")
    first = vectors.dropDuplicates(["h1", "h2", "vec_id"]).withColumn("n", F.row_number().over(least)).filter(F.col("n") <= k + 1)
    classes = materialize(
        first.groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.array_sort(F.collect_list("vec_id")).alias("ids"), F.first("vector").alias("vector")),
        "vector-classes",
    )
    count = classes.count()
    functions = functions or functions_for(count, CrossPolytope(dim, 0).width)
    hashed = materialize(_hashed(classes, dim, tables, probes, functions), "hashed-vectors")
    parts = tasks_for(count * tables * probes, 60_000, least=12)
    large = _slot_sizes(hashed, probes).filter(F.col("size") > bucket_rows).select("slot").limit(MAX_LARGE + 1).collect()
    if len(large) > MAX_LARGE:
        raise ValueError(f"more than {MAX_LARGE} buckets above {bucket_rows} vectors; use more functions per table")
    left_out = np.sort(np.array([r.slot for r in large], np.int64))
    top = _ranked(_pack_entries(hashed, dim, tables, probes, parts, left_out), dim, k, parts, tasks_for(count, 50_000, least=12))
    if len(large):
        each = hashed.select("rep", "vector", F.posexplode("slots").alias("at", "slot")).withColumn("home", F.col("at") % probes == 0)
        slots = points.sparkSession.createDataFrame([(int(slot),) for slot in left_out], "slot bigint")
        top = _best_rows(top.unionByName(_rank_large(each.join(F.broadcast(slots), "slot"), dim, k, parts, bucket_rows)), k)
    top = materialize(top, "best-candidates")
    some = classes.select("rep").join(top.groupBy("rep").agg(F.count(F.lit(1)).alias("n")), "rep", "left").filter(F.coalesce("n", F.lit(0)) < min(k, count - 1))
    short = materialize(classes.select("rep", "vector").join(some.select("rep"), "rep", "left_semi"), "short-of-candidates")
    if not short.isEmpty():
        top = _best_rows(top.unionByName(_against_all(short, classes, dim, k, count)), k)
    others = classes.select(F.col("rep").alias("other"), "ids")
    found = top.join(others, "other").select("rep", F.explode(F.transform("ids", lambda i: F.struct((-F.col("cosine")).alias("less"), i.alias("id")))).alias("near"))
    own = classes.filter(F.size("ids") > 1).select("rep", F.explode(F.transform("ids", lambda i: F.struct(F.lit(-1.0).alias("less"), i.alias("id")))).alias("near"))
    # At most k classes of k + 1 ids and the own class: a bounded list.
    lists = found.unionByName(own).groupBy("rep").agg(F.slice(F.array_sort(F.collect_list("near")), 1, k + 1).alias("near"))
    members = vectors.select("vec_id", "h1", "h2").distinct().join(classes.select("h1", "h2", "rep"), ["h1", "h2"])
    rows = members.join(lists, "rep").select(
        "vec_id", F.posexplode(F.slice(F.filter("near", lambda x: x["id"] != F.col("vec_id")), 1, k)).alias("rank", "near")
    )
    return rows.select("vec_id", F.col("near.id").alias("neighbour"), (-F.col("near.less")).alias("cosine"), (F.col("rank") + 1).alias("rank"))


def _best_rows(rows: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of the rows ``(rep, other, cosine)`` of each ``rep``, repeats counted once."""
    best = Window.partitionBy("rep").orderBy(F.desc("cosine"), "other")
    # Equal rows share a dense rank; so each task can drop what is beyond k before the shuffle, and repeats go after it.
    return rows.withColumn("n", F.dense_rank().over(best)).filter(F.col("n") <= k).groupBy("rep", "other").agg(F.max("cosine").alias("cosine"))


def _against_all(asked: DataFrame, data: DataFrame, dim: int, k: int, count: int) -> DataFrame:
    """``(rep, other, cosine)``: the best ``k`` of each of the ``asked`` vectors within each block of the ``data``."""
    blocks = tasks_for(count, 20_000)
    block = F.pmod(F.xxhash64("rep"), F.lit(blocks))
    indexed = data.select(block.alias("slot"), F.lit(True).alias("home"), "rep", "vector")
    sent = asked.select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("slot"), F.lit(False).alias("home"), "rep", "vector")
    return _rank_buckets(indexed.unionByName(sent), ["slot"], dim, k, blocks, apart=True)


def _rank_large(entries: DataFrame, dim: int, k: int, parts: int, bucket_rows: int) -> DataFrame:
    """Buckets above ``bucket_rows``: every query is compared with every indexed row, block by block."""
    entries = entries.select("slot", "home", "rep", "vector")
    blocks = entries.groupBy("slot").agg(F.ceil(F.count(F.lit(1)) / bucket_rows).alias("asking"), F.ceil(F.count(F.when(F.col("home"), 1)) / bucket_rows).alias("indexed"))
    sized = entries.join(blocks, "slot")
    # Block pairs (query block, data block): a row goes along its line of queries, an indexed row along its column of data.
    own = lambda count: F.pmod(F.xxhash64("rep"), count)
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(count) - 1))
    queries = sized.select("slot", own("asking").alias("q"), every("indexed").alias("d"), F.lit(False).alias("home"), "rep", "vector")
    data = sized.filter("home").select("slot", every("asking").alias("q"), own("indexed").alias("d"), F.lit(True).alias("home"), "rep", "vector")
    return _rank_buckets(queries.unionByName(data), ["slot", "q", "d"], dim, k, parts, apart=True)


def found_pairs(points: DataFrame, k: int = 5, dim: int = 64) -> DataFrame:
    """Distinct ``(vec_a, vec_b)``, ``vec_a < vec_b``, one of which is among the ``k`` nearest of the other."""
    near = nearest_vectors(points, k, dim)
    return near.select(F.least("vec_id", "neighbour").alias("vec_a"), F.greatest("vec_id", "neighbour").alias("vec_b")).distinct()


def recall_report(points: DataFrame, found: DataFrame, k: int = 5, dim: int = 64, every: int = 50) -> DataFrame:
    """Recall of ``found`` (:func:`nearest_vectors`) against brute force, one row per query.

    Queries are the usable rows whose ``vec_id`` is divisible by ``every``;
    they are compared with all rows, block by block.
    """
    base = points.filter(F.col("vec_id").isNotNull() & usable("vector", dim)).select("vec_id", F.col("vector").cast("array<float>").alias("vector"))
    asked = base.filter(F.col("vec_id") % every == 0)
    queries, data = (df.select(F.col("vec_id").alias("rep"), "vector") for df in (asked, base))
    best = Window.partitionBy("rep").orderBy(F.desc("cosine"), "other")
    truth = _against_all(queries, data, dim, k, base.count()).distinct().withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k)
    hits = found.select(F.col("vec_id").alias("rep"), F.col("neighbour").alias("other"), F.lit(1).alias("hit"))
    return truth.join(hits, ["rep", "other"], "left").groupBy(F.col("rep").alias("vec_id")).agg(F.count(F.lit(1)).alias("n_true"), F.count("hit").alias("n_found"))
