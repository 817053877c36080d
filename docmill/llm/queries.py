"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docmill.llm import knn, markup, mixing, neardup, packing, sitelines, split, tokens, toxicity
from docmill.plans.runtime import materialize


def p1_token_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_budget(tokens.corpus_slices(spark, sf_dir))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.found_families(spark.read.parquet(f"{sf_dir}/parsed.parquet"))


def p2_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.clean_documents(spark.read.parquet(f"{sf_dir}/parsed.parquet").select("id", "source", "ingested_at", "text"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.found_oversized(split.sized_items(spark, sf_dir))


def p3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_corpus(spark, sf_dir)


def _similar_sections(spark: SparkSession, sf_dir: str) -> neardup.NearDuplicates:
    return neardup.NearDuplicates(spark.read.parquet(f"{sf_dir}/parsed.parquet"), words=3, threshold=0.6, min_words=30)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _similar_sections(spark, sf_dir).id_pairs()


def p4_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _similar_sections(spark, sf_dir).groups()


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitelines.found_lines(spark.read.parquet(f"{sf_dir}/parsed.parquet"))


def p5_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    sections = spark.read.parquet(f"{sf_dir}/parsed.parquet").select("id", "source", "doc", "ingested_at", "text")
    return sitelines.remove_lines(sections, sitelines.found_lines(sections))


def p5_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    sections = spark.read.parquet(f"{sf_dir}/parsed.parquet")
    projected = materialize(sitelines.frequent_lines(materialize(sitelines.line_table(sections), "lines")), "frequent-lines")
    return sitelines.described(sitelines.FrequentSequences(projected).table(), projected, sections)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.found_pairs(spark.read.parquet(f"{sf_dir}/points.parquet"))


def p6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.nearest_vectors(spark.read.parquet(f"{sf_dir}/points.parquet"))


def p6_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = spark.read.parquet(f"{sf_dir}/points.parquet")
    return knn.recall_report(points, knn.nearest_vectors(points))


def p7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/capacities.parquet"))


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, capacities = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "capacities"))
    sized = packing.sized_documents(documents)
    return packing.packing_report(packing.pack_documents(documents, capacities, sized=sized), capacities, sized)


def _mixed(spark: SparkSession, sf_dir: str, whole: bool = False) -> tuple[DataFrame, list[tuple]]:
    """Mixes at the largest budget that reaches all shares, or (``whole``) of as many tokens as the documents have."""
    sized = packing.sized_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    total = int(sized.agg({"n_tokens": "sum"}).first()[0] or 0) if whole else None
    plan = mixing.mixing_plan(sized, spark.read.parquet(f"{sf_dir}/mix_targets.parquet"), total)
    return mixing.mix_documents(sized, plan), plan


def p8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixed(spark, sf_dir)[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares_report(*_mixed(spark, sf_dir))


def p8_capped_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A budget that small sources cannot serve: they run out at their cap, the others fill up."""
    return _mixed(spark, sf_dir, whole=True)[0]


def p8_capped_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares_report(*_mixed(spark, sf_dir, whole=True))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return toxicity.score_documents(read("documents").select("doc_id", "source", "text"), read("review_labels"), read("flag_terms"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.found_content(_scored(spark, sf_dir))


def p9_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir)


def p9_source_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.source_rates(_scored(spark, sf_dir))


P3_FOUND_SQL = """
SELECT DISTINCT 'chunk' AS kind, id FROM chunks
WHERE metadata.configuration.budget = 'characters' AND length(text) > metadata.configuration.size
UNION
SELECT DISTINCT 'section' AS kind, id FROM parsed WHERE length(text) > 2400
"""


P4_FOUND_SQL = r"""
WITH w AS (SELECT DISTINCT id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM parsed),
s AS (SELECT DISTINCT id, unnest(list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])) AS shingle FROM w WHERE len(w) >= 30),
n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
c AS (SELECT a.id AS id_a, b.id AS id_b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.id < b.id GROUP BY ALL)
SELECT id_a, id_b FROM c JOIN n x ON x.id = id_a JOIN n y ON y.id = id_b WHERE c / (x.n + y.n - c) >= 0.6
"""

_SITE_LINES = r"""
WITH RECURSIVE lines AS (SELECT id, source, doc, generate_subscripts(l, 1) AS line_no, unnest(l) AS line FROM (SELECT DISTINCT id, source, doc, string_split(text, chr(10)) AS l FROM parsed)),
tidy AS (SELECT id, source, doc, line_no, trim(regexp_replace(line, '[\s\x{1c}-\x{1f}\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')) AS line FROM lines),
marks AS (SELECT id, line_no, row_number() OVER (PARTITION BY id ORDER BY line_no) AS k, substr(line, 1, 3) AS mark FROM tidy WHERE substr(line, 1, 3) IN ('```', '~~~')),
scan AS (SELECT id, 0::BIGINT AS k, 0::BIGINT AS line_no, '' AS run FROM (SELECT DISTINCT id FROM tidy)
UNION ALL SELECT s.id, m.k, m.line_no, CASE WHEN s.run = '' THEN m.mark WHEN s.run = m.mark THEN '' ELSE s.run END FROM scan s JOIN marks m ON m.id = s.id AND m.k = s.k + 1),
open AS (SELECT t.*, s.run FROM tidy t ASOF JOIN scan s ON s.id = t.id AND s.line_no <= t.line_no WHERE substr(t.line, 1, 3) NOT IN ('```', '~~~')),
counted AS (SELECT id, source, doc, line_no, lower(regexp_replace(line, '\p{Nd}+', '0', 'g')) AS line FROM open WHERE run = ''),
kept AS (SELECT * FROM counted WHERE length(line) >= 20 AND regexp_matches(line, '\p{L}')),
frequent AS (SELECT source, line FROM kept GROUP BY source, line HAVING count(DISTINCT doc) >= 8)
"""
P5_FOUND_SQL = _SITE_LINES + "SELECT DISTINCT k.id, k.line_no FROM kept k JOIN frequent f ON k.source = f.source AND k.line = f.line"
# Items, then every way to take items of a text in order; a sequence counts in how many documents it can be taken.
P5_SEQUENCES_SQL = (
    _SITE_LINES.rstrip()
    + r""",
rows AS (SELECT DISTINCT k.id, k.source, k.doc, k.line_no, k.line FROM kept k JOIN frequent f ON k.source = f.source AND k.line = f.line),
beside AS (SELECT *, lag(line) OVER w AS before, lead(line) OVER w AS after FROM rows WINDOW w AS (PARTITION BY id, source, doc ORDER BY line_no)),
sides AS (SELECT source, line, CASE WHEN count(before) = count(*) AND min(before) = max(before) THEN min(before) END AS before, CASE WHEN count(after) = count(*) AND min(after) = max(after) THEN min(after) END AS after FROM beside GROUP BY source, line),
inner_lines AS (SELECT b.source, b.line FROM sides a JOIN sides b ON a.source = b.source AND a.after = b.line AND b.before = a.line),
marked AS (SELECT r.*, sum(CASE WHEN i.line IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY r.id, r.source, r.doc ORDER BY r.line_no) AS item FROM rows r LEFT JOIN inner_lines i ON i.source = r.source AND i.line = r.line),
items AS (SELECT id, source, doc, item, string_agg(line, chr(10) ORDER BY line_no) AS lines, count(*) AS n FROM marked GROUP BY ALL),
taken AS (SELECT id, source, doc, item, lines AS seq, 1 AS length, n AS n_lines FROM items
UNION ALL SELECT t.id, t.source, t.doc, i.item, t.seq || chr(10) || i.lines, t.length + 1, t.n_lines + i.n FROM taken t JOIN items i ON i.id = t.id AND i.source = t.source AND i.doc = t.doc AND i.item > t.item)
SELECT source, seq, length, n_lines, count(DISTINCT doc) AS n_docs FROM taken GROUP BY source, seq, length, n_lines HAVING count(DISTINCT doc) >= 8
"""
)


P6_FOUND_SQL = """
WITH good AS (SELECT vec_id, vector::DOUBLE[] AS v FROM points WHERE len(vector) = 64 AND len(list_filter(vector, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(vector, lambda x: x <> 0)) > 0),
ranked AS (SELECT a.vec_id AS a, b.vec_id AS b, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_cosine_similarity(a.v, b.v), 9) DESC, b.vec_id) AS n FROM good a JOIN good b ON a.vec_id <> b.vec_id)
SELECT DISTINCT least(a, b) AS vec_a, greatest(a, b) AS vec_b FROM ranked WHERE n <= 5
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    names = """
        p1_token_budget p2_found p2_clean_text p3_found p3_pieces p4_found p4_groups
        p5_found p5_clean_text p5_sequences p6_found p6_nearest p6_recall
        p7_packing p7_report p8_mixture p8_shares p8_capped_mixture p8_capped_shares p9_found p9_scores p9_source_rates
    """.split()
    return {name: globals()[name] for name in names}


def oracle_sql() -> dict[str, str]:
    return {"p3_found": P3_FOUND_SQL, "p4_found": P4_FOUND_SQL, "p5_found": P5_FOUND_SQL, "p5_sequences": P5_SEQUENCES_SQL, "p6_found": P6_FOUND_SQL}
