import numpy as np

from docmill.llm.toxicity import CATEGORIES, Featurizer, Ftrl, batch_of, fit, found_content, plain_word, score_documents, source_rates, text_scores, training_rows
from tests.llm.data import DATA


def test_disguises_are_undone():
    assert plain_word("j4ck4s$") == "jackass" and plain_word("сrétіn") == "cretin" and plain_word("Ostroooolandais") == "ostrolandais"
    assert plain_word("EldstenIntegrator") == "<id>" and plain_word("snake_case") == "<id>" and plain_word("12") == "<n>" and plain_word("MORON") == "moron"
    f = Featurizer([])
    read = lambda text: [f._token(token)[1] for token in f._tokens(text)]
    assert read("V e l m a r i a n s are i.d.i.o.t and j\u200backass") == ["velmarians", "are", "idiot", "and", "jackass"]
    assert read("你真蠢。x (Stop!) now\nthen") == ["你", "真", "蠢", "", "x", "stop", "", "now", "", "then"]


def test_features_of_many_texts_are_those_of_each():
    f = Featurizer([("bad word", "hate"), ("word", "abuse")])
    texts = ["A bad word. One two three four five!", None, "", "...", "x", "word word", "bad\nword", "y " * 500]
    hashes, starts, owner = f.features(texts)
    assert owner.tolist() == [0, 0, 4, 5, 6, 6, 7]
    ends = [*starts[1:], len(hashes)]
    for k, text in enumerate(texts):
        alone, begins, _ = f.features([text])
        mine = [hashes[a:b].tolist() for a, b, o in zip(starts, ends, owner) if o == k]
        assert mine == [alone[a:b].tolist() for a, b in zip(begins, [*begins[1:], len(alone)])]
    # Words, bigrams, two kinds of skip-grams and trigrams, and two hints: 3 + 2 + 1 + 0 + 1 + 2; 5 + 4 + 3 + 2 + 3.
    assert (ends[0], ends[1] - ends[0]) == (9, 17)


def test_ftrl_is_sparse_and_learns():
    rng = np.random.default_rng(0)
    model = Ftrl()
    for _ in range(600):
        good = rng.random() < 0.5
        index = np.unique(np.r_[rng.integers(10, 4000, 8), 3 if good else 5])
        model.step(batch_of([index]), np.array([[good, 0, 0]], float), np.ones((1, 3)))
    w = model.weights(np.array([3, 5]))
    assert w[0, 0] > 0.3 and w[1, 0] < 0
    assert (model.weights(slice(None)) != 0).sum() < 4000


def test_held_out_documents():
    rng = np.random.default_rng(3)
    insults, calm = ["you are a stupid fool", "shut up you clown"], ["the mesh is refined again", "my stupid typo broke the build", "kill the process first"]

    def document(bad):
        parts = [f"{calm[rng.integers(3)]} {rng.integers(99)}." for _ in range(6)]
        if bad:
            parts.insert(rng.integers(6), insults[rng.integers(2)] + ".")
        return " ".join(parts)

    labels = ["abuse" if k % 4 == 0 else "none" for k in range(300)]
    index, weights, bias = fit([document(b == "abuse") for b in labels], labels, [("fool", "abuse")])
    table = np.zeros((1 << 20, 3), np.float32)
    table[index] = weights
    f = Featurizer([("fool", "abuse")])
    for bad in (True, False) * 20:
        assert (text_scores(f, [document(bad)], table, table.any(axis=1), bias)[0, 0] >= 0.5) == bad


def test_table(spark):
    sf = DATA.replace("sf0.001", "sf0.01")
    read = lambda name: spark.read.parquet(f"{sf}/{name}.parquet")
    scored = score_documents(read("documents"), read("review_labels"), read("flag_terms"))
    assert scored.count() == read("documents").count()
    found = found_content(scored).collect()
    assert {r.category for r in found} <= set(CATEGORIES)
    rates = source_rates(scored).collect()
    assert sum(r.n_docs for r in rates) == 1000 and all(0 <= r.rate_flagged <= 1 for r in rates)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "a", 0.0), (2, "", None, 0.0), (3, "fine words.", "a", 0.0), (3, "fine words.", "a", 0.0), (None, "x", "a", 0.0)], "doc_id bigint, text string, source string, score_hate double")
    labels = spark.createDataFrame([(1, 3, " None "), (2, 3, "ABUSE"), (3, 3, "abuse"), (4, None, "hate"), (5, 9, None), (6, 1, "odd")], "label_id bigint, doc_id bigint, label string")
    terms = spark.createDataFrame([(None, "abuse", 1), ("x y", None, 2), ("bad", "hate", None)], "term string, category string, severity int")
    assert [(r.doc_id, r.label) for r in training_rows(docs, labels).collect()] == [(3, "abuse")]
    rows = score_documents(docs, labels, terms).collect()
    assert len(rows) == 5 and all(r.score_abuse == 0 for r in rows if r.doc_id in (1, 2))
    assert score_documents(docs, labels.limit(0), terms.limit(0)).count() == 5 and score_documents(docs.limit(0), labels, terms).count() == 0
