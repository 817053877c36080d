import numpy as np

from docmill.llm.knn import CrossPolytope, found_pairs, functions_for, hadamard, nearest_vectors, recall_report
from tests.llm.data import DATA

SCHEMA = "vec_id bigint, vector array<float>, cosine string"


def brute(rows, k=5):
    good = [(i, np.array(v, dtype=np.float32).astype(np.float64)) for i, v in rows if i is not None and v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    good = sorted({i: v for i, v in good}.items())
    x = np.array([v for _, v in good])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = np.array([i for i, _ in good])
    out = {}
    for n, i in enumerate(ids):
        s = np.round(x @ x[n], 9)
        order = [j for j in np.lexsort((ids, -s)) if j != n][:k]
        out[int(i)] = [int(ids[j]) for j in order]
    return out


def found(df, **options):
    out = {}
    for r in sorted(nearest_vectors(df, **options).collect(), key=lambda r: (r.vec_id, r["rank"])):
        out.setdefault(r.vec_id, []).append(r.neighbour)
    return out


def test_hadamard_is_orthogonal():
    h = hadamard(np.eye(8))
    assert np.allclose(h @ h.T, 8 * np.eye(8))
    hashes = CrossPolytope(5, 2)
    x = np.random.default_rng(0).normal(size=(3, 5))
    assert np.allclose(np.linalg.norm(hashes.rotate(x, 0), axis=1), np.linalg.norm(x, axis=1))
    assert (hashes.keys(x, 0, 2, 3) == CrossPolytope(5, 2).keys(x, 0, 2, 3)).all()
    assert [functions_for(n, 64) for n in (0, 30_000_000, 40_000_000, 4_000_000_000, 5_000_000_000)] == [2, 2, 3, 3, 4]


def test_recall_on_the_table(spark):
    points = spark.read.parquet(f"{DATA.replace('sf0.001', 'sf0.01')}/points.parquet")
    expected = brute([(r.vec_id, r.vector) for r in points.collect()])
    got = found(points)
    hits = sum(len(set(got.get(i, [])) & set(near)) for i, near in expected.items())
    assert hits / sum(map(len, expected.values())) >= 0.99
    pairs = {tuple(r) for r in found_pairs(points).collect()}
    assert all(a < b for a, b in pairs)
    # Large buckets, and more rotations per table: every vector still comes out with five neighbours.
    for options in ({"bucket_rows": 10}, {"functions": 3}):
        other = found(points, **options)
        assert sum(len(set(other.get(i, [])) & set(near)) for i, near in expected.items()) / sum(map(len, expected.values())) >= 0.99
        assert all(len(near) == 5 for near in other.values()) and len(other) == len(expected)
    report = recall_report(points, nearest_vectors(points), every=10).collect()
    assert all(r.n_true == 5 for r in report) and sum(r.n_found for r in report) >= 0.99 * sum(r.n_true for r in report)


def test_copies_ties_and_unusable_rows(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(4, 64)).astype(np.float32)
    rows = []
    for n in range(40):  # a third and more are copies of one vector
        rows.append((n + 1, [float(x) for x in (base[0] if n % 2 else base[1 + n % 3] + rng.normal(size=64).astype(np.float32) * 0.05)]))
    rows += [(50, [float(x) for x in base[0] * 2]), (51, [0.0] * 64), (52, None), (53, [1.0] * 63), (54, [float("nan")] + [1.0] * 63), (55, [None] + [1.0] * 63), (56, []), (None, [1.0] * 64)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    assert found(df) == brute(rows)
    apart = spark.createDataFrame([(n, [float(k == n) * (-1.0) ** n for k in range(64)], "x") for n in range(9)], SCHEMA)
    assert found(apart) == brute([(r.vec_id, r.vector) for r in apart.collect()])  # no two of them share a bucket
    assert nearest_vectors(df.limit(0)).count() == 0
    assert nearest_vectors(df.filter("vec_id = 1")).count() == 0


def test_large_buckets_are_split(spark):
    rng = np.random.default_rng(5)
    center = rng.normal(size=64)
    rows = [(n, [float(x) for x in center + rng.normal(size=64) * (0.02 if n % 3 else 0.3)]) for n in range(300)]
    df = spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA)
    expected = brute(rows)
    got = found(df, bucket_rows=20)
    hits = sum(len(set(got.get(i, [])) & set(near)) for i, near in expected.items())
    assert hits / sum(map(len, expected.values())) >= 0.9


def test_large_buckets_lose_no_neighbour(spark):
    rng = np.random.default_rng(6)
    center = rng.normal(size=64)
    rows = [(n, [float(x) for x in center + rng.normal(size=64) * (0.3 if n % 3 else 2.0)]) for n in range(400)]
    df = spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA)
    assert found(df, bucket_rows=8) == found(df)
