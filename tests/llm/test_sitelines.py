import random
from collections import defaultdict
from itertools import combinations

from docmill.llm.sitelines import FrequentSequences, counted_lines, described, found_lines, frequent_lines, line_table, normal_line, remove_lines
from docmill.plans.runtime import materialize
from tests.llm.data import DATA


def brute(rows, least=8):
    docs = defaultdict(set)
    for id_, source, doc, text in rows:
        for number, normal in counted_lines(text or ""):
            docs[source, normal].add(doc)
    return {(id_, number) for id_, source, doc, text in rows for number, normal in counted_lines(text or "") if len(docs[source, normal]) >= least}


def test_normal_line():
    assert normal_line("\u00a0 A  B\u2028c 1234 x7\r") == "a b c 0 x0"


def test_fences_and_short_lines():
    text = "a line that is long enough\n```c\na line that is long enough\n~~~\n```\n  12345678901234567890 1\nshort\na line that is long enough"
    assert [n for n, _ in counted_lines(text)] == [1, 8]


def test_against_brute_force(spark):
    parsed = spark.read.parquet(f"{DATA.replace('sf0.001', 'sf0.01')}/parsed.parquet")
    expected = brute([(r.id, r.source, r.doc, r.text) for r in parsed.collect()])
    assert {tuple(r) for r in found_lines(parsed).collect()} == expected and expected


def test_sequences_and_removal(spark):
    rows = [(f"s{i}", f"Unique text number {'abcdefghij'[i]} of this page here\nShare this page with your friends\nCopyright {i} by the example project", "web", f"d{i}") for i in range(9)]
    rows += [("other", "Share this page with your friends", "elsewhere", "d0"), ("null", None, None, None), ("empty", "", "web", "d1")]
    df = spark.createDataFrame(rows, "id string, text string, source string, doc string")
    found = found_lines(df)
    assert {tuple(r) for r in found.collect()} == {(f"s{i}", n) for i in range(9) for n in (2, 3)}
    cleaned = {r.id: r for r in remove_lines(df.withColumn("clean_text", df.text), found).collect()}
    assert cleaned["s3"].clean_text == "Unique text number d of this page here" and cleaned["s3"].n_removed == 2
    assert cleaned["null"].clean_text is None and cleaned["empty"].clean_text == "" and cleaned["other"].n_removed == 0
    sequences = FrequentSequences(materialize(frequent_lines(line_table(df)), "lines")).table().collect()
    # The two lines always stand together: one item.
    assert [(r.length, len(r.lines), r.n_docs) for r in sequences] == [(1, 2, 9)]
    assert found_lines(df.limit(0)).count() == 0 and FrequentSequences(materialize(frequent_lines(line_table(df.limit(0))), "lines")).table().count() == 0
    long = spark.createDataFrame([("x", "\n".join(["Share this page with your friends", "y"] * 20_000), "web", "d")], "id string, text string, source string, doc string")
    assert remove_lines(long, long.selectExpr("id", "explode(sequence(1, 40000, 2)) AS line_no")).first().n_removed == 20_000


def mined(spark, rows, least=8):
    df = spark.createDataFrame(rows, "id string, text string, source string, doc string")
    projected = materialize(frequent_lines(line_table(df), least), "lines")
    return {(r.source, tuple(r.seq.split("\n"))): (r.length, r.n_lines, r.n_docs) for r in described(FrequentSequences(projected, least).table(), projected, df).collect()}


def test_a_notice_of_many_lines_is_one_item(spark):
    block = [f"line {c} of the legal notice of this site" for c in "abcdefghijklmnopqrstuvwxyz"]
    rows = [(f"s{i}", "\n".join(block), "web", f"d{i}") for i in range(8)]
    assert mined(spark, rows) == {("web", tuple(block)): (1, 26, 8)}


def within(short, long):
    rest = iter(long)
    return all(line in rest for line in short)


def test_sequences_against_all_subsequences(spark):
    rng = random.Random(8)
    lines = [f"the repeated line number {c} of the site" for c in "abcdefg"]
    rows = []
    for i in range(60):
        taken = [rng.choice(lines) for _ in range(rng.randint(0, 5))]
        at = [k for k, line in enumerate(taken) if line == lines[0]]
        for k in reversed(at):  # two lines that always follow the first one
            taken[k + 1 : k + 1] = ["that line stands always after the first", "and this one after that one"]
        rows.append((f"s{i}", "\n".join(taken), "xy"[i % 2], f"d{rng.randint(0, 15)}"))
    rows.append(("none", "\n".join(lines), "x", None))
    least, docs = 3, defaultdict(set)
    single = defaultdict(set)
    for _, source, doc, text in [(r[0], r[2], r[3], r[1]) for r in rows]:
        for line in text.split("\n"):
            single[source, line].add(doc)
    texts = [(source, doc, [line for line in text.split("\n") if len(single[source, line] - {None}) >= least]) for _, text, source, doc in rows]
    for source, doc, kept in texts:
        for n in range(1, len(kept) + 1):
            for chosen in combinations(kept, n):
                docs[source, chosen].add(doc)
    frequent = {key: len(found - {None}) for key, found in docs.items() if len(found - {None}) >= least and key[1][0]}
    got = mined(spark, rows, least)
    assert len(got) > 20 and max(n for _, n, _ in got.values()) >= 4
    assert all(frequent[key] == n for key, (_, _, n) in got.items())
    # Nothing is lost by items: every frequent sequence lies in one that is listed, with the same support.
    for (source, seq), n in frequent.items():
        assert any(s == source and n == m and within(seq, longer) for (s, longer), (_, _, m) in got.items()), seq
