import random
import re
from itertools import combinations

import numpy as np

from docmill.llm.neardup import BITS, NearDuplicates, ShingleHasher
from docmill.llm.components import connected_components
from tests.llm.data import DATA


def brute(rows, words, threshold, least):
    sets = {}
    for key, text in rows:
        w = re.findall(r"\w+", (text or "").lower())
        if key is not None and len(w) >= max(least, words):
            sets[key] = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)}
    return {(a, b) for a, b in combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])}


def test_pairs_of_the_table(spark):
    parsed = spark.read.parquet(f"{DATA.replace('sf0.001', 'sf0.01')}/parsed.parquet")
    expected = brute([(r.id, r.text) for r in parsed.collect()], 3, 0.6, 30)
    for hot in (100, 10, 1):
        assert {tuple(r) for r in NearDuplicates(parsed, 3, 0.6, hot_bucket=hot).id_pairs().collect()} == expected and expected


def edited(rng, n, copies):
    vocabulary = [f"w{i}" for i in range(400)]
    base = [rng.choice(vocabulary) for _ in range(80)]
    rows = []
    for c in range(copies):
        text = list(base)
        text[rng.randrange(80)] = f"edit{n}x{c}"
        rows.append((f"t{n:02d}-{c:03d}", " ".join(text)))
    return rows


def test_defaults_hot_buckets_and_copies(spark):
    rng = random.Random(2)
    rows = [r for n in range(6) for r in edited(rng, n, 4)] + edited(rng, 9, 40)
    rows += [(f"copy{c:02d}", rows[0][1].upper()) for c in range(20)] + [("short", "a b c"), ("null", None), ("empty", ""), (None, rows[0][1]), rows[1], ("long", "word " * 20_000)]
    df = spark.createDataFrame([(a, b, 1) for a, b in rows], "id string, text string, k1 int")
    expected = brute(dict.fromkeys(rows), 5, 0.8, 30)
    for hot in (100, 5):
        found = NearDuplicates(df, hot_bucket=hot)
        assert {tuple(r) for r in found.id_pairs().collect()} == expected
    groups = {r.id: r for r in found.groups().collect()}
    assert groups["copy03"].group_id == "copy00" and groups["copy03"].n_copies == 21
    assert groups["t09-007"].group_id == "t09-000" and groups["long"].n_links == 0
    assert "short" not in groups and NearDuplicates(df.limit(0)).id_pairs().count() == 0
    assert NearDuplicates(df.limit(0)).groups().count() == 0


def test_hot_buckets_lose_no_pair(spark):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(90)]
    rows = [(f"t{c:03d}", " ".join(rng.choice(base) + f"x{c}" if rng.random() < 0.05 else w for w in base)) for c in range(60)]
    df = spark.createDataFrame(rows, "id string, text string")
    pairs = [{tuple(r) for r in NearDuplicates(df, 3, 0.6, bands=8, hot_bucket=hot).id_pairs().collect()} for hot in (100, 1)]
    assert pairs[0] == pairs[1] and pairs[0]


def test_estimate_is_near_the_similarity():
    hasher = ShingleHasher(1, 1)
    rng = np.random.default_rng(1)
    for share in (0.2, 0.6, 0.9):
        a = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
        b = a.copy()
        b[: int(1000 * (1 - share) / (1 + share))] = rng.integers(0, 1 << 63, int(1000 * (1 - share) / (1 + share))).astype(np.uint64)
        low = [hasher.minima(np.unique(x)) & np.uint32((1 << BITS) - 1) for x in (a, b)]
        agree = (low[0] == low[1]).mean()
        truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((agree - 0.25) / 0.75 - truth) < 0.17


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 100), (7, 7), (None, 3), (200, 200)]
    got = {tuple(r) for r in connected_components(spark.createDataFrame(chain, "a bigint, b bigint"), "a", "b").collect()}
    assert got == {(i, 1) for i in range(1, 61)} | {(100, 100), (101, 100)}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").count() == 0
