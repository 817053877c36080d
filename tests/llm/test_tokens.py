import base64
import random

import tiktoken
from pyspark.sql import functions as F

from docmill.llm.tokens import DEFAULT_VOCABULARY, SPLIT_PATTERN, TextMeasure, TokenCounter, corpus_slices, parse_ranks, read_vocabulary, token_budget, with_token_counts
from tests.llm.data import DATA

RANKS = parse_ranks(read_vocabulary(DEFAULT_VOCABULARY))
ENCODING = tiktoken.Encoding("own", pat_str=SPLIT_PATTERN, mergeable_ranks=RANKS, special_tokens={})
MEASURE = TextMeasure(read_vocabulary(DEFAULT_VOCABULARY))


def greedy(vocabulary, data):
    out, at = [], 0
    while at < len(data):
        end = len(data)
        while data[at:end] not in vocabulary:
            end -= 1
        out.append(vocabulary[data[at:end]])
        at = end
    return out


def test_longest_match_equals_greedy_search():
    rng = random.Random(7)
    for _ in range(60):
        words = {bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 7))) for _ in range(25)}
        vocabulary = {w: i for i, w in enumerate([*(bytes([b]) for b in range(256)), *sorted(words)])}
        counter = TokenCounter(vocabulary)
        for _ in range(30):
            data = bytes(rng.choice(b"abcd") for _ in range(rng.randint(0, 30)))
            assert counter.longest_match(data) == greedy(vocabulary, data)


def test_exact_count_equals_the_tokenizer(spark):
    texts = [r[0] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("text").collect() if r[0]]
    texts += [r[0] for r in spark.read.parquet(f"{DATA}/parsed.parquet").select("text").collect() if r[0]]
    texts += ["", " ", "\n\n \t x", "it's we'll  don't", "\x1c a b c", "日本語テキスト 123٣", "a" * 5000, "ab_" * 400, "🧮🧮 é é"]
    for text in texts:
        assert MEASURE.count(text) == len(ENCODING.encode_ordinary(text)), text[:80]


def test_random_unicode():
    rng = random.Random(3)
    alphabet = "abcXYZ019 _-'\n\t.,é漢🧮 ́s t"
    for _ in range(800):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        assert MEASURE.count(text) == len(ENCODING.encode_ordinary(text)), repr(text)
        assert len(MEASURE.token_ends(text)) == MEASURE.count(text)


def test_budget_of_the_tables(spark):
    rows = token_budget(corpus_slices(spark, DATA)).collect()
    texts = {}
    for r in corpus_slices(spark, DATA).collect():
        texts.setdefault((r.dataset, r.id), r.text)
    assert sum(r.n_tokens for r in rows) == sum(len(ENCODING.encode_ordinary(t or "")) for t in texts.values())
    assert {r.lang for r in rows} <= {"en", "de", "fr", "es", "zh", "und"}
    assert sum(r.n_rows for r in rows) == corpus_slices(spark, DATA).count()


def test_nulls_repeats_and_clashing_columns(spark):
    df = spark.createDataFrame(
        [("c", "a", "one two", "s", "EN_us", "https://U@Host.X:80/p", 1), ("c", "a", "one two", "s", "en", "https://host.x/", 2), ("c", None, None, None, None, None, 3), ("c", None, "", None, " ", "nothing", 4)],
        "dataset string, id string, text string, source string, lang string, url string, n_tokens int",
    )
    got = {(r.source, r.lang, r.domain): r.asDict() for r in token_budget(df).collect()}
    assert got["s", "en", "host.x"]["n_rows"] == 2 and got["s", "en", "host.x"]["n_texts"] == 1 and got["s", "en", "host.x"]["n_tokens"] == 2
    assert got["(none)", "und", "(none)"]["n_texts"] == 2 and got["(none)", "und", "(none)"]["n_tokens"] == 0
    assert token_budget(df.limit(0)).count() == 0
    assert with_token_counts(df).filter(F.col("n_tokens") > 0).count() == 2


def test_vocabulary_file_is_base64_ranks():
    assert base64.b64encode(b"a") in read_vocabulary(DEFAULT_VOCABULARY)
