"""Abusive, hateful and sexual content: scores per document, rates per source.

Logistic regression per category over hashed word n-grams and skip-grams of
sentences, fitted by FTRL-proximal: per-coordinate learning rates and L1 keep
few weights, which are broadcast. Labels are given to whole documents of which
mostly one sentence offends, so fitting alternates with choosing the offending
sentences (multiple-instance learning); a document scores as its worst
sentence. Words are first undone of common disguises.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATEGORIES = ("abuse", "hate", "sexual")
#: Labelled documents that are fitted on at most, those with the smallest hash of their id.
MAX_TRAINING_DOCS = 12_000
#: Rows of the table of hint terms, which every task holds.
MAX_TERMS = 5_000
HASH_BITS = 20
EPOCHS = 3
ROUNDS = 3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.25, 0.5
#: Examples per update, factor of a sentence's feature values, rate of the bias.
BATCH, SCALE, BIAS_RATE = 16, 4.0, 0.02
#: Texts whose features are made together.
TEXTS_AT_ONCE = 256
THRESHOLD = 0.5
#: Weight of an offending example against a harmless one.
POSITIVE_WEIGHT = 3.0

# Letters of other scripts that look like Latin ones.
_LOOKALIKES = str.maketrans("аеорсухіјѕһԁɡӏвкмнтαοινυρκτ", "aeopcyxijshdglbkmhtaoivupkt")
# Digits and signs that stand for letters.
_STAND_INS = str.maketrans("013457@$!|", "oieastasil")
_IGNORED = re.compile("[­​-‏⁠-⁤﻿︀-️]")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W\d_][ .\-_*·]){3,}[^\W\d_](?![^\W_])")
_SEPARATORS = re.compile(r"[ .\-_*·]")
_TOKEN = re.compile(r"[㐀-鿿豈-﫿]|[^\W_](?:[\w@$!|*’'-]*[\w@$*])?")
# What ends a sentence, or a token.
_PIECE = re.compile(rf"(?<=[.!?…])[\"'”’)\]]*\s+|\n+|[。！？；]|{_TOKEN.pattern}")
_RUN = re.compile(r"(\w)\1{2,}")
_SALTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64)


def plain_word(token: str) -> str:
    """A token in lower case without accents, disguises undone; identifiers and numbers become one word each."""
    if token.isdigit():
        return "<n>"
    if "_" in token or any(c.isupper() for c in token[1:]) and not token.isupper() and any(c.islower() for c in token):
        inner = token[1:]
        if "_" in token or any(a.islower() and b.isupper() for a, b in zip(token, inner)):
            return "<id>"
    word = token.casefold()
    if not word.isascii():
        letters = word.translate(_LOOKALIKES)
        if letters.isascii() or any("a" <= c <= "z" for c in word):
            word = letters
        word = "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c))
    if not word.isalpha():
        letters = word.translate(_STAND_INS)
        kept = letters.replace("*", "").replace("-", "").replace("'", "").replace("’", "")
        if kept.isalpha() and any(c.isalpha() for c in word):
            word = letters if "-" in word or "*" in word else kept
    return _RUN.sub(r"\1", word)


class Featurizer:
    """Sentences of a text as hashed features."""

    def __init__(self, terms: list[tuple[str, str]], bits: int = HASH_BITS):
        self.mask = np.uint64((1 << bits) - 1)
        self.words: dict[str, int] = {}
        self.plain: dict[str, tuple[int, str]] = {}
        self.terms: dict[tuple[str, ...], set[str]] = {}
        for term, category in terms:
            key = tuple(plain_word(t) for t in _TOKEN.findall(unicodedata.normalize("NFKC", term)))
            if key:
                self.terms.setdefault(key, set()).add(category)
        self.first = np.array([self._code(word) for word in {k[0] for k in self.terms}], np.uint64)
        self.longest = max(map(len, self.terms), default=0)

    def _code(self, word: str) -> int:
        code = self.words.get(word)
        if code is None:
            if len(self.words) > 200_000:
                self.words.clear()
            code = self.words[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) or 1
        return code

    def _token(self, token: str) -> tuple[int, str]:
        """Code and plain word of a token; code 0 where it ends a sentence."""
        if not token[0].isalnum():
            return 0, ""
        word = plain_word(token)
        return self._code(word), word

    def _tokens(self, text: str) -> list[str]:
        """Tokens and sentence ends in order."""
        if not text.isascii():
            text = _IGNORED.sub("", unicodedata.normalize("NFKC", text))
        return _PIECE.findall(_SPACED.sub(lambda m: _SEPARATORS.sub("", m[0]), text))

    def features(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(hashes, starts, text_of)``: features of all sentences of all texts in a row, where each begins and whose it is.

        A feature may occur more than once in a sentence. Sentences without words have none and are left out.
        """
        if len(self.plain) > 200_000:
            self.plain.clear()
        tokens: list[str] = []
        ends = np.zeros(len(texts) + 1, np.int64)
        for k, text in enumerate(texts):
            if text:
                tokens += self._tokens(text)
            tokens.append("\n")
            ends[k + 1] = len(tokens)
        plain = self.plain
        for token in set(tokens).difference(plain):
            plain[token] = self._token(token)
        read = [plain[token] for token in tokens]
        codes = np.fromiter((code for code, _ in read), np.uint64, len(read))
        sentence = np.cumsum(codes == 0)
        text_of = np.repeat(np.arange(len(texts)), np.diff(ends))
        filled = codes != 0
        where = np.nonzero(filled)[0]
        codes, sentence, text_of = codes[filled], sentence[filled], text_of[filled]
        n = len(codes)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        fresh = np.r_[True, sentence[1:] != sentence[:-1]]
        owner = np.cumsum(fresh) - 1
        # One row per word, one column per kind of feature; those that would cross a sentence are left out.
        mixed = np.zeros((n, 5), np.uint64)
        valid = np.zeros((n, 5), bool)
        mixed[:, 0], valid[:, 0] = codes * _SALTS[0], True
        for kind in (1, 2, 3):  # bigrams, then skip-grams over one and two words
            if n > kind:
                mixed[:-kind, kind] = codes[:-kind] * _SALTS[kind] ^ codes[kind:] * _SALTS[0] + _SALTS[kind]
                valid[:-kind, kind] = owner[kind:] == owner[:-kind]
        if n > 2:  # trigrams
            mixed[:-2, 4] = codes[:-2] * _SALTS[4] ^ codes[1:-1] * _SALTS[1] ^ codes[2:] * _SALTS[0]
            valid[:-2, 4] = owner[2:] == owner[:-2]
        counts = np.add.reduceat(valid.sum(axis=1), np.nonzero(fresh)[0])
        mixed = mixed[valid]
        hints = sorted({(int(owner[k]), category) for k, category in self._hinted(read, where, codes, owner)})
        if hints:
            at = np.array([k for k, _ in hints])
            starts = np.r_[0, np.cumsum(counts)[:-1]]
            mixed = np.insert(mixed, starts[at], np.fromiter((self._code(f"<hint {c}>") for _, c in hints), np.uint64, len(hints)) * _SALTS[0])
            counts = counts + np.bincount(at, minlength=len(counts))
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        return (mixed & self.mask).astype(np.int64), np.r_[0, np.cumsum(counts)[:-1]], text_of[fresh]

    def _hinted(self, read: list[tuple[int, str]], where: np.ndarray, codes: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, str]]:
        """``(position of its first word, category)`` of every hint term."""
        for k in np.nonzero(np.isin(codes, self.first))[0].tolist() if len(self.first) else ():
            words = tuple(read[where[j]][1] for j in range(k, min(k + self.longest, len(where))) if owner[j] == owner[k])
            for n in range(1, len(words) + 1):
                for category in self.terms.get(words[:n], ()):
                    yield k, category


class Batch(NamedTuple):
    """A few examples, ready for an update: their features side by side, and the same sorted by feature."""

    index: np.ndarray  # features that occur
    place: np.ndarray  # where each stands in ``index``
    starts: np.ndarray  # first feature of each example
    value: np.ndarray  # value of an example's features
    owner: np.ndarray  # examples in the order of features
    cuts: np.ndarray  # first of each feature in that order


def batch_of(parts: list[np.ndarray]) -> Batch:
    """``parts`` are the features of each example, without repeats."""
    lengths = np.array([len(part) for part in parts])
    flat = np.concatenate(parts)
    order = np.argsort(flat, kind="stable")
    ranked = flat[order]
    fresh = np.r_[True, ranked[1:] != ranked[:-1]]
    place = np.empty(len(flat), np.int32)
    place[order] = np.cumsum(fresh) - 1
    owner = np.repeat(np.arange(len(parts), dtype=np.int32), lengths)[order]
    return Batch(ranked[fresh], place, np.r_[0, np.cumsum(lengths)[:-1]], SCALE / np.sqrt(lengths)[:, None], owner, np.nonzero(fresh)[0])


class Ftrl:
    """FTRL-proximal logistic regression for all categories at once."""

    def __init__(self, size: int = 1 << HASH_BITS):
        self.z = np.zeros((size, len(CATEGORIES)))
        self.n = np.zeros((size, len(CATEGORIES)))
        self.bias = np.full(len(CATEGORIES), -2.0)

    def weights(self, index: np.ndarray | slice) -> np.ndarray:
        return self._solved(self.z[index], self.n[index])

    @staticmethod
    def _solved(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def step(self, batch: Batch, target: np.ndarray, importance: np.ndarray) -> None:
        """One update on a few examples, with targets and importances per category.

        Categories of importance 0 stay as they are.
        """
        n, z = self.n[batch.index], self.z[batch.index]
        w = self._solved(z, n)
        sums = np.add.reduceat(w[batch.place], batch.starts, axis=0)
        error = (1.0 / (1.0 + np.exp(-np.clip(sums * batch.value + self.bias, -30, 30))) - target) * importance
        each = (error * batch.value)[batch.owner]
        g = np.add.reduceat(each, batch.cuts, axis=0)
        # Each example's own squares keep the rates those of single updates.
        square = np.add.reduceat(each * each, batch.cuts, axis=0)
        grown = np.sqrt(n + square)
        self.z[batch.index] = z + g - (grown - np.sqrt(n)) / ALPHA * w
        self.n[batch.index] = n + square
        self.bias -= BIAS_RATE * error.sum(axis=0)


def sentence_scores(index: np.ndarray, starts: np.ndarray, table: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Probability per sentence and category; features are counted once."""
    sums = np.add.reduceat(table[index], starts, axis=0)
    sizes = np.diff(np.r_[starts, len(index)])[:, None]
    return 1.0 / (1.0 + np.exp(-np.clip(sums * SCALE / np.sqrt(sizes) + bias, -30, 30)))


def _once(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each feature once per sentence."""
    owner = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(hashes)]))
    keys = np.sort(owner << HASH_BITS | hashes)
    keys = keys[np.r_[True, keys[1:] != keys[:-1]]]
    owner = keys >> HASH_BITS
    return keys & ((1 << HASH_BITS) - 1), np.searchsorted(owner, np.arange(len(starts)))


def text_scores(featurizer: Featurizer, texts: list[str | None], table: np.ndarray, used: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Score per text and category: that of its worst sentence, 0 without words.

    Sentences without a feature that has a weight (``used``) score the bias
    alone; only the others are looked at feature by feature.
    """
    scores = np.zeros((len(texts), len(CATEGORIES)))
    hashes, starts, text_of = featurizer.features(texts)
    if not len(starts):
        return scores
    each = np.tile(1.0 / (1.0 + np.exp(-np.clip(bias, -30, 30))), (len(starts), 1))
    some = np.logical_or.reduceat(used[hashes], starts)
    if some.any():
        lengths = np.diff(np.r_[starts, len(hashes)])
        kept, counts = hashes[np.repeat(some, lengths)], lengths[some]
        each[some] = sentence_scores(*_once(kept, np.r_[0, np.cumsum(counts)[:-1]]), table, bias)
    first = np.nonzero(np.r_[True, text_of[1:] != text_of[:-1]])[0]
    scores[text_of[first]] = np.maximum.reduceat(each, first, axis=0)
    return scores


def fit(texts: list[str], labels: list[str], terms: list[tuple[str, str]], seed: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(index, weights, bias)`` of the non-zero weights. Labels are categories or 'none'."""
    featurizer = Featurizer(terms)
    blocks, owners = [], []
    for at in range(0, len(texts), TEXTS_AT_ONCE):
        hashes, starts, text_of = featurizer.features(texts[at : at + TEXTS_AT_ONCE])
        if len(starts):
            flat, starts = _once(hashes, starts)
            blocks.append((flat, np.diff(np.r_[starts, len(flat)])))
            owners.append(text_of + at)
    if not blocks:
        return np.zeros(0, np.int64), np.zeros((0, len(CATEGORIES)), np.float32), Ftrl(0).bias
    owner = np.concatenate(owners)
    lengths = np.concatenate([n for _, n in blocks])
    # Features are numbered through, so that tables are as small as what occurs.
    names, flat = np.unique(np.concatenate([f for f, _ in blocks]), return_inverse=True)
    flat = flat.astype(np.int32)
    starts = np.r_[0, np.cumsum(lengths)[:-1]]
    ends = (starts + lengths).tolist()
    examples = len(starts)
    column = np.array([CATEGORIES.index(label) if label in CATEGORIES else -1 for label in labels])[owner]
    target = np.zeros((examples, len(CATEGORIES)))
    importance = np.ones((examples, len(CATEGORIES)))
    hit = column >= 0
    # A document with two kinds of content carries one label: only 'none' speaks for all categories.
    importance[hit] = 0.0
    target[hit, column[hit]] = 1.0
    importance[hit, column[hit]] = 0.3
    rng = np.random.default_rng(seed)
    model = Ftrl(len(names))
    for round_ in range(ROUNDS):
        if round_:
            table = model.weights(slice(None))
            p = sentence_scores(flat, starts, table, model.bias)
            target[:], importance[:] = 0.0, 1.0
            best = np.zeros(len(texts))
            np.maximum.at(best, owner[hit], p[hit, column[hit]])
            own = np.zeros(examples)
            own[hit] = p[hit, column[hit]]
            top = p.argmax(axis=1)
            # Offending: the worst sentence of a labelled document and those nearly as bad. A sentence
            # that another category claims is an example of that one; the rest are harmless.
            chosen = hit & (own >= np.minimum(0.5, best[owner])) & ((top == column) | (own >= best[owner]))
            target[chosen, column[chosen]] = 1.0
            importance[chosen] = 1.0
            importance[chosen, column[chosen]] = POSITIVE_WEIGHT
            other = hit & ~chosen & (p.max(axis=1) >= 0.5)
            target[other, top[other]] = 1.0
            unsure = hit & ~chosen & ~other & (p.max(axis=1) > 0.1)
            importance[unsure] = 0.0
            model = Ftrl(len(names))
        for _ in range(EPOCHS):
            order = rng.permutation(examples)
            for at in range(0, examples, BATCH):
                few = order[at : at + BATCH]
                model.step(batch_of([flat[starts[k] : ends[k]] for k in few.tolist()]), target[few], importance[few])
    table = model.weights(slice(None))
    kept = np.nonzero(table.any(axis=1))[0]
    return names[kept], table[kept].astype(np.float32), model.bias


def training_rows(documents: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAINING_DOCS) -> DataFrame:
    """``(doc_id, text, label)``: the labelled documents to fit on, at most ``max_docs``.

    Labels are read without regard to case and space; unknown and null labels
    are left out. Of a document labelled twice the most frequent label counts,
    'none' last.
    """
    label = F.lower(F.trim("label"))
    votes = labels.filter(F.col("doc_id").isNotNull() & label.isin(*CATEGORIES, "none")).groupBy("doc_id", label.alias("label")).agg(F.count(F.lit(1)).alias("votes"))
    order = Window.partitionBy("doc_id").orderBy(F.desc("votes"), F.col("label") == "none", "label")
    chosen = votes.withColumn("n", F.row_number().over(order)).filter("n = 1").select("doc_id", "label")
    sample = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    texts = documents.filter(F.col("text").isNotNull()).select("doc_id", "text")
    # At most max_docs small rows: sent to the texts, so that these are not shuffled.
    return texts.join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"])


def trained_weights(documents: DataFrame, labels: DataFrame, terms: DataFrame, max_docs: int = MAX_TRAINING_DOCS) -> tuple[list[tuple[str, str]], np.ndarray, np.ndarray, np.ndarray]:
    """Hint terms, indexes, weights and bias, fitted in one task over the bounded sample."""
    hints = [(r.term, r.category) for r in terms.filter("term IS NOT NULL AND category IS NOT NULL").select("term", "category").distinct().orderBy("term", "category").limit(MAX_TERMS + 1).collect()]
    if len(hints) > MAX_TERMS:
        raise ValueError(f"more than {MAX_TERMS} hint terms")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))]
        rows.sort(key=lambda r: r[0])
        index, weights, bias = fit([r[1] for r in rows], [r[2] for r in rows], hints)
        yield pa.RecordBatch.from_arrays([pa.array([index.astype("<i8").tobytes()]), pa.array([weights.astype("<f4").tobytes()]), pa.array([bias.tobytes()])], names=["idx", "weights", "bias"])

    row = training_rows(documents, labels, max_docs).select("doc_id", "text", "label").repartition(1).mapInArrow(train, "idx binary, weights binary, bias binary").collect()
    if not row:
        return hints, np.zeros(0, np.int64), np.zeros((0, len(CATEGORIES)), np.float32), np.full(len(CATEGORIES), -2.0)
    return hints, np.frombuffer(row[0].idx, "<i8"), np.frombuffer(row[0].weights, "<f4").reshape(-1, len(CATEGORIES)), np.frombuffer(row[0].bias, np.float64)


def score_documents(documents: DataFrame, labels: DataFrame, terms: DataFrame, max_docs: int = MAX_TRAINING_DOCS) -> DataFrame:
    """``documents`` without ``text``, with ``score_abuse, score_hate, score_sexual`` (0 to 1).

    Every row is scored over its whole text; null and empty texts score 0.
    Without usable labels all scores are those of the prior. Columns of those
    names in ``documents`` are replaced.
    """
    hints, index, weights, bias = trained_weights(documents, labels, terms, max_docs)
    # At most 2**HASH_BITS weights per category, whatever the size of the data.
    shared = documents.sparkSession.sparkContext.broadcast((hints, index, weights, bias))
    made = [f"score_{c}" for c in CATEGORIES]
    kept = [c for c in documents.columns if c != "text" and c not in made]
    source = documents.select(*kept, "text")
    schema = T.StructType([*source.schema.fields[:-1], *(T.StructField(m, T.DoubleType()) for m in made)])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hints, index, weights, bias = shared.value
        featurizer = Featurizer(hints)
        table = np.zeros((1 << HASH_BITS, len(CATEGORIES)), np.float32)
        table[index] = weights
        used = table.any(axis=1)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            parts = [text_scores(featurizer, texts[at : at + TEXTS_AT_ONCE], table, used, bias) for at in range(0, len(texts), TEXTS_AT_ONCE)]
            scores = np.concatenate(parts) if parts else np.zeros((0, len(CATEGORIES)))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)] + [pa.array(scores[:, k]) for k in range(len(CATEGORIES))]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *made])

    return source.mapInArrow(score, schema)


def found_content(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Distinct ``(doc_id, category)`` whose score reaches the threshold."""
    flags = F.array(*(F.when(F.col(f"score_{c}") >= threshold, F.lit(c)) for c in CATEGORIES))
    return scored.select("doc_id", F.explode(F.array_compact(flags)).alias("category")).distinct()


def source_rates(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per source (null as ``(none)``): documents, flagged ones and rate per category."""
    named = scored.withColumn("source", F.coalesce("source", F.lit("(none)")))
    counts = [F.count(F.when(F.col(f"score_{c}") >= threshold, 1)).alias(f"n_{c}") for c in CATEGORIES]
    anyway = F.count(F.when(F.greatest(*(F.col(f"score_{c}") for c in CATEGORIES)) >= threshold, 1)).alias("n_flagged")
    totals = named.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), anyway, *counts)
    return totals.select("*", *((F.col(f"n_{c}") / F.col("n_docs")).alias(f"rate_{c}") for c in CATEGORIES), (F.col("n_flagged") / F.col("n_docs")).alias("rate_flagged"))
