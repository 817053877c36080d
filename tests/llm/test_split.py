import random

import pytest

from docmill.llm.split import SECTION_LIMIT, cut_points, found_oversized, sized_items, split_corpus, split_items
from docmill.llm.tokens import DEFAULT_VOCABULARY, TextMeasure, read_vocabulary
from tests.llm.data import DATA


def joined(text, spans):
    return "".join(text[(spans[k - 1][1] if k else 0) : end] for k, (_, end) in enumerate(spans))


def test_random_texts_come_back():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("ab c. \n。é") for _ in range(rng.randint(0, 400)))
        limit = rng.randint(1, 60)
        overlap = rng.randint(0, limit - 1)
        spans = cut_points(text, limit, overlap)
        assert joined(text, spans) == text
        assert all(0 < e - s <= limit for s, e in spans)
        for (s0, e0), (s1, _) in zip(spans, spans[1:]):
            assert s1 == e0 - min(overlap, e0 - s0 - 1)


def test_cut_goes_to_the_change_of_topic():
    a = "The mesh is refined near the boundary of the mesh. " * 8
    b = "Cats sleep and cats eat and cats play all day. " * 8
    spans = cut_points(a + b, 500, 0)
    assert len(a) in [e for _, e in spans]


def test_natural_places_and_unbroken_words():
    text = "One sentence here. Another sentence there. " * 30
    for _, end in cut_points(text, 200, 20)[:-1]:
        assert text[:end].endswith(". ")
    assert [e - s for s, e in cut_points("x" * 25, 10, 0)] == [10, 10, 5]
    with pytest.raises(ValueError):
        cut_points("x", 5, 5)


def test_tables(spark):
    pieces = split_corpus(spark, DATA).collect()
    measure = TextMeasure(read_vocabulary(DEFAULT_VOCABULARY))
    items = {(r.kind, r.id): r for r in sized_items(spark, DATA).collect()}
    texts = {}
    for p in sorted(pieces, key=lambda p: (p.kind, p.id, p.piece_no)):
        item = items[p.kind, p.id]
        assert item.text[p.start : p.end] == p.text
        assert len(p.text) <= item["size"] if item.unit == "characters" else measure.count(p.text) <= item["size"]
        texts[p.kind, p.id] = texts.get((p.kind, p.id), "") + p.text[p.overlap :]
    assert all(items[k].text == t for k, t in texts.items())
    expected = {k for k, r in items.items() if r.text and r.unit == "characters" and len(r.text) > r["size"]}
    assert {(r.kind, r.id) for r in found_oversized(sized_items(spark, DATA)).collect()} == expected
    tokens = {k for k, r in items.items() if r.text and r.unit == "tokens" and measure.count(r.text) > r["size"]}
    assert set(texts) == expected | tokens and tokens
    assert SECTION_LIMIT == 2400


def test_odd_rows(spark):
    schema = "kind string, id string, text string, size int, overlap int, unit string, start int"
    rows = [("a", "1", None, 5, 0, "characters", 1), ("a", "2", "", 5, 0, "characters", 1), ("a", "3", "abcdefgh", None, 0, "characters", 1), ("a", "4", "abcdefgh", 0, 0, "characters", 1), ("a", "5", "abcdefgh", 5, None, None, 1), ("a", None, "abcdefgh", 5, 9, "characters", 1)]
    got = split_items(spark.createDataFrame(rows, schema)).collect()
    assert {r.id for r in got} == {None} and all(len(r.text) <= 5 for r in got)
    assert split_items(spark.createDataFrame([], schema)).count() == 0
