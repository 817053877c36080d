from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from docmill.llm.mixing import finish_time, mix_documents, mixing_plan, mixture, shares_report
from docmill.llm.packing import sized_documents
from docmill.plans.prefix import running_sum
from tests.llm.data import DATA


def test_finish_time():
    assert finish_time([(0.5, 100), (0.5, 100)], 100) == 100
    assert finish_time([(0.5, 10), (0.5, 100)], 60) == 100
    assert finish_time([(0.5, 10), (0.5, 100)], 500) == 200


def test_running_sum_in_two_levels(spark):
    rows = [("a" if n % 3 else None, n // 10, n, n % 7 or None) for n in range(100)]
    df = spark.createDataFrame(rows, "k string, b bigint, o bigint, v bigint")
    got = {r.o: r.total for r in running_sum(df, ["k"], "b", [F.col("o")], "v", "total").collect()}
    sums = Counter()
    for k, _, o, v in rows:
        sums[k] += v or 0
        assert got[o] == sums[k]


@pytest.mark.parametrize("total", [None, 20_000])
def test_shares(spark, total):
    sized = sized_documents(spark.read.parquet(f"{DATA.replace('sf0.001', 'sf0.01')}/documents.parquet"))
    plan = mixing_plan(sized, spark.read.parquet(f"{DATA}/mix_targets.parquet"), total)
    mixed = mix_documents(sized, plan)
    rows = mixed.collect()
    tokens = {r.doc_id: (r.source, r.n_tokens) for r in sized.collect()}
    seen, used = Counter(), defaultdict(Counter)
    for r in rows:
        assert tokens[r.doc_id] == (r.source, r.n_tokens)
        seen[r.mix, r.doc_id, r["copy"]] += 1
        used[r.mix][r.source] += r.n_tokens
    assert max(seen.values()) == 1
    longest = max(n for _, n in tokens.values())
    for mix, source, share, weight, repeats, passes, available, n_docs, budget, finish in plan:
        assert sum(used[mix].values()) <= budget * 1.000001 and used[mix][source] <= repeats * available
        if total is None and weight:
            assert abs(used[mix][source] - weight * budget) <= 2 * longest
    for mix in used:
        ends = sorted((r.end_offset, r.n_tokens) for r in rows if r.mix == mix)
        assert ends[0][0] == ends[0][1] and all(b[0] - b[1] == a[0] for a, b in zip(ends, ends[1:]))
    report = shares_report(mixed, plan).collect()
    assert len(report) == len(plan)
    for mix in used:
        assert abs(sum(r.actual_share for r in report if r.mix == mix) - 1) < 1e-9


def test_hot_source_and_odd_rows(spark):
    docs = spark.createDataFrame([(n, f"word {n} " * 3, "big" if n < 80 else "small", 1) for n in range(100)] + [(200, None, "big", 1), (201, "x", None, 1)], "doc_id bigint, text string, source string, budget int")
    targets = spark.createDataFrame([("m", "big", 0.5, 1), ("m", "small", 0.5, 3), ("m", "absent", 0.2, 2), ("m", None, 0.1, 1), (None, "big", 1.0, 1), ("n", "small", 1.0, None)], "mix string, source string, target_share double, max_repeats int")
    rows = mixture(docs, targets).collect()
    copies = Counter((r.mix, r.source, r["copy"]) for r in rows)
    assert copies["n", "small", 0] == 20 and not copies["n", "small", 1]
    assert copies["m", "small", 2] in range(17, 21) and not copies["m", "small", 3]
    assert mixture(docs.limit(0), targets).count() == 0 and mixture(docs, targets.limit(0)).count() == 0
