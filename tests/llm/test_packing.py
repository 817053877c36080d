import random
from collections import Counter, defaultdict

from docmill.llm.packing import OpenBins, pack, pack_documents, packing_report, sized_documents
from tests.llm.data import DATA


def test_kernel_against_plain_best_fit():
    rng = random.Random(8)
    for _ in range(60):
        capacity = rng.randint(5, 60)
        n = rng.randint(0, 80)
        sizes = [rng.randint(1, capacity) for _ in range(n)]
        clusters = [rng.randint(0, 25) for _ in range(n)]
        chosen = pack(sizes, ["s"] * n, clusters, capacity)
        bins = []
        for k in sorted(range(n), key=lambda k: -sizes[k]):
            fits = [b for b in bins if b[0] >= sizes[k] and clusters[k] not in b[1]]
            if fits:
                best = min(fits, key=lambda b: b[0])
            else:
                bins.append(best := [capacity, set()])
            best[0] -= sizes[k]
            best[1].add(clusters[k])
        used = defaultdict(list)
        for k, c in enumerate(chosen):
            used[c].append(k)
        for ks in used.values():
            assert sum(sizes[k] for k in ks) <= capacity and len({clusters[k] for k in ks}) == len(ks)
        assert abs(len(used) - len(bins)) <= 1


def test_many_copies_stay_apart_and_fast():
    assert len(set(pack([3] * 5000, ["a"] * 5000, [7] * 5000, 100))) == 5000
    bins = OpenBins(10)
    assert [bins.place(4, 0, -1), bins.place(4, 1, -1), bins.place(4, 0, -1)] == [0, 0, 1]


def test_another_source_is_found_among_many_equal_containers():
    bins = OpenBins(10)
    assert [bins.place(6, source, -1) for source in [0] * 8 + [1]] == list(range(9))
    assert bins.place(4, 0, -1) == 8 and bins.place(4, 1, -1) == 0


def test_table(spark):
    documents = spark.read.parquet(f"{DATA}/documents.parquet")
    capacities = spark.read.parquet(f"{DATA}/capacities.parquet")
    rows = pack_documents(documents, capacities, shard_items=60).collect()
    sized = {r.doc_id: r for r in sized_documents(documents).collect()}
    room = {r.capacity_name: r.capacity_tokens for r in capacities.collect()}
    parts, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        parts[r.capacity_name, r.doc_id].append(r)
        if r.container_id is not None:
            bins[r.capacity_name, r.container_id].append(r)
    assert set(parts) == {(c, d) for c in room for d in sized}
    for (_, doc), ps in parts.items():
        ps.sort(key=lambda r: r.part)
        assert [p.start_token for p in ps[1:]] == [p.end_token for p in ps[:-1]] and ps[0].start_token == 0 and ps[-1].end_token == sized[doc].n_tokens
    for (name, _), items in bins.items():
        assert sum(r.n_tokens for r in items) <= room[name]
        assert len({sized[r.doc_id].cluster for r in items}) == len(items)
    report = {r.capacity_name: r for r in packing_report(pack_documents(documents, capacities), capacities, sized_documents(documents)).collect()}
    assert report["short"].fill > 0.85 and report["medium"].fill > 0.85
    for name, r in report.items():
        shared = sum(n - 1 for (c, _), items in bins.items() if c == name for n in Counter(sized[i.doc_id].source for i in items if sized[i.doc_id].source is not None).values())
        assert r.n_items == sum(len(items) for (c, _), items in bins.items() if c == name) and r.n_conflicts == 0
        # Shards of other sizes make other containers, of about as many neighbours of one source.
        assert abs(r.n_shared - shared) <= 0.2 * r.n_items


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "a", 0), (2, "", None, 0), (None, "x", "a", 0), (3, "one two three four", None, 9), (4, " one two  three four", "b", 9)], "doc_id bigint, text string, source string, n_tokens int")
    capacities = spark.createDataFrame([("c", 3), (None, 5), ("bad", 0), ("none", None)], "capacity_name string, capacity_tokens int")
    rows = pack_documents(docs, capacities).collect()
    assert {r.doc_id for r in rows if r.container_id is None} == {1, 2} and {r.capacity_name for r in rows} == {"c"}
    assert pack_documents(docs.limit(0), capacities).count() == 0 and pack_documents(docs, capacities.limit(0)).count() == 0
