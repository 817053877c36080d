"""Queries over the reference tables, one or more per operator, with their SQL.

Every query reads its whole tables. Where the operator is a kernel over one text
(rendering, sectioning, splitting) there is no SQL; those are tested against
plain forms and invariants.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmill.functions import expressions as ex
from docmill.functions import html, markdown
from docmill.functions.identity import content_hash, point_id
from docmill.functions.text import each
from docmill.operators import artifacts, chunking, embedding, retrieval, sections, vindex
from docmill.sources import crawl, scan
from docmill.sources.config import MAX_SOURCES, Source, addressed, sources_of

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

# The characters that a strip takes for white space, as a class of the SQL engine's patterns.
_WS = r"[\s\x{1c}-\x{1f}\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_ORDER = r"regexp_extract(id, ':(\d{1,15})$', 1)::BIGINT"
_ONCE = "(SELECT * FROM parsed QUALIFY row_number() OVER (PARTITION BY id ORDER BY ingested_at) = 1)"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        _QUERIES[function.__name__] = function
        if sql is not None:
            _SQL[function.__name__] = sql
        return function

    return add


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- acquisition and scan


@query(r"""SELECT DISTINCT regexp_extract(doc, '[^/]*$') AS page FROM (SELECT 'class' || regexp_replace(doc, '^.*/', '') AS doc FROM audit UNION ALL SELECT regexp_replace(doc, '^.*/', '') FROM audit UNION ALL SELECT 'struct' || doc || '-members.html' FROM audit)
WHERE doc LIKE '%.html' AND regexp_matches(regexp_extract(doc, '[^/]*$'), '^(class|struct|namespace)') AND doc NOT LIKE '%-members.html' AND NOT starts_with(regexp_extract(doc, '[^/]*$'), 'namespacemembers_')""")
def page_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc")
    names = _read(spark, sf_dir, "audit").select(F.explode(F.array(F.concat(F.lit("class"), F.regexp_replace(doc, "^.*/", "")), F.regexp_replace(doc, "^.*/", ""), F.concat(F.lit("struct"), doc, F.lit("-members.html")))).alias("doc"))
    page = F.regexp_extract("doc", "[^/]*$", 0)
    return names.select(page.alias("page")).filter(ex.keeps_reference_page(F.col("page"))).distinct()


@query("""SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all('<a href="' || url || '">' || coalesce(text, '') || '<a href="' || url || '"> <a href="#' || doc_id || '">', 'href="([^"]+)"', 1))), '|') AS links FROM documents WHERE url IS NOT NULL""")
def href_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    page = F.concat(F.lit('<a href="'), url, F.lit('">'), F.coalesce("text", F.lit("")), F.lit('<a href="'), url, F.lit('"> <a href="#'), F.col("doc_id"), F.lit('">'))
    return _read(spark, sf_dir, "documents").filter(url.isNotNull()).select("doc_id", F.array_join(ex.links_in(page), "|").alias("links"))


@query("""SELECT DISTINCT doc AS path, 'https://raw.example/' || sha256 || '/' || doc AS url FROM audit WHERE sha256 IS NOT NULL AND (starts_with(doc, 'ref/') OR starts_with(doc, 'howto/')) AND (doc LIKE '%.md' OR doc LIKE '%.cpp')""")
def tree_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = _read(spark, sf_dir, "audit").filter("sha256 IS NOT NULL").select(
        F.to_json(F.struct(F.col("sha256").alias("sha"), F.lit(False).alias("truncated"), F.array(F.struct(F.col("doc").alias("path"), F.lit("blob").alias("type"))).alias("tree"))).alias("json")
    )
    return crawl.tree_files(listing, ["ref/", "howto/"], [".md", ".cpp"], "https://raw.example").distinct()


@query("""SELECT count(*) AS files, round(coalesce(sum(strlen(text)), 0) / 1e6, 6) AS megabytes FROM documents WHERE text IS NOT NULL""")
def corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _read(spark, sf_dir, "documents").filter("text IS NOT NULL").select(F.col("text").alias("content"))
    return crawl.corpus_size(files).select("files", F.round("megabytes", 6).alias("megabytes"))


@query(r"""SELECT a.source, a.doc, array_to_string(list_sort(list(DISTINCT g.glob)), '|') AS patterns FROM (SELECT source, regexp_replace(doc, '^skipped/', '') AS doc FROM audit UNION ALL SELECT name, unnest(['index.md', 'event-' || name || '.md', 'search.md', 'a/search.md']) FROM sources) a
JOIN (SELECT name, unnest("exclude") AS glob FROM sources) g ON g.name = a.source
WHERE regexp_full_match(a.doc, replace(replace(regexp_replace(g.glob, '([.\\+^$(){}|\[\]])', '\\\1', 'g'), '*', '.*'), '?', '.'), 's') GROUP BY a.source, a.doc""")
def source_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = _read(spark, sf_dir, "sources")
    seen = _read(spark, sf_dir, "audit").select("source", F.regexp_replace("doc", "^skipped/", "").alias("doc"))
    more = sources.select(F.col("name").alias("source"), F.explode(F.array(F.lit("index.md"), F.concat(F.lit("event-"), "name", F.lit(".md")), F.lit("search.md"), F.lit("a/search.md"))).alias("doc"))
    return scan.exclusion_report(seen.unionByName(more), sources).select("source", "doc", F.array_join("patterns", "|").alias("patterns"))


@query(r"""SELECT a.audit_id, replace(replace(s.url, '{path}', a.doc), '{page}', CASE WHEN stem = 'index' OR stem LIKE '%/index' THEN regexp_replace(stem, 'index$', '') ELSE stem || '/' END) AS url
FROM (SELECT *, regexp_replace(doc, '([^/])\.[^./]+$', '\1') AS stem FROM audit) a JOIN sources s ON s.name = a.source WHERE a.doc IS NOT NULL""")
def doc_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "audit").filter("doc IS NOT NULL").select("audit_id", "source", "doc")
    return addressed(documents, sources_of(_read(spark, sf_dir, "sources"))).filter("url IS NOT NULL").select("audit_id", "url")


@query("SELECT doc_id, sha256(text) AS sha256 FROM documents WHERE text IS NOT NULL")
def content_sha256(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents").filter("text IS NOT NULL").select("doc_id", content_hash(F.col("text")).alias("sha256"))


# ---- conversion


@query(r"""SELECT id, len(parts) - CASE WHEN parts[-1] = '' THEN 1 ELSE 0 END AS n_lines FROM (SELECT id, string_split_regex(text, '\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]') AS parts FROM parsed)""")
def line_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return each(_read(spark, sf_dir, "parsed").select("id", "text"), markdown.line_count, ["text"], "n_lines", T.IntegerType())


@query(rf"""SELECT id, regexp_replace(regexp_replace(trim(regexp_replace(text, '{_WS}+', ' ', 'g')), ' +([(),])', '\1', 'g'), '\( +', '(', 'g') AS line FROM parsed""")
def one_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return each(_read(spark, sf_dir, "parsed").select("id", "text"), html.one_line, ["text"], "line", T.StringType())


@query(r"""SELECT id, '# ' || doc || chr(10) || chr(10) || fence || CASE WHEN regexp_matches(doc, '\.(cpp|hpp)$') THEN 'cpp' ELSE 'text' END || chr(10) || rtrim(text, chr(10)) || chr(10) || fence || chr(10) AS markdown
FROM (SELECT *, repeat('`', greatest(3, coalesce(list_max(list_transform(regexp_extract_all(text, '`+'), lambda x: length(x))), 0) + 1)::INT) AS fence FROM parsed) t""")
def code_wrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return each(_read(spark, sf_dir, "parsed").select("id", "doc", "text"), sections.code_markdown, ["doc", "text"], "markdown", T.StringType())


@query(r"""SELECT DISTINCT id, trim(regexp_extract('<html><head><title> ' || metadata.title || ' </title></head>', '<title>(.*?)</title>', 1)) AS title FROM parsed WHERE metadata.title IS NOT NULL""")
def html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.concat(F.lit("<html><head><title> "), F.col("metadata.title"), F.lit(" </title></head>"))
    pages = _read(spark, sf_dir, "parsed").filter("metadata.title IS NOT NULL").select("id", page.alias("page")).distinct()
    return each(pages, lambda text: html.page_title(html.parse_html(text)), ["page"], "title", T.StringType())


def _parse(spark: SparkSession, sf_dir: str, kind: str, before: str = "", after: str = "") -> DataFrame:
    """Every section text read as a document of its own."""
    source = Source("all", kind, ".", "https://docs.example/{page}" if kind == "markdown" else "https://docs.example/{path}", flatten=["div.signature"] if kind == "html" else [], drop=["nav"] if kind == "html" else [])
    suffix = {"html": ".html", "markdown": ".md", "code": ".cpp"}[kind]
    documents = _read(spark, sf_dir, "parsed").select(F.lit("all").alias("source"), F.concat("id", F.lit(suffix)).alias("doc"), F.encode(F.concat(F.lit(before), "text", F.lit(after)), "UTF-8").alias("content"))
    return sections.parse_documents(documents, [source])


@query()
def parse_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.sections_of(_parse(spark, sf_dir, "markdown"))


@query()
def parse_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.sections_of(_parse(spark, sf_dir, "html", "<html><head><title>Page</title></head><body>", "</body></html>"))


# A page and a Markdown file made for each section, with ``{A}`` for a name that follows from its id, and what conversion makes of them.
_PAGE = (
    '<html><head><title> Page  of {A} </title></head><body><div class="nav">menu</div><div id="main"><h2 id="s7">About <em>{A}</em></h2><p>See <a href="../b/c.html#q">the page</a> and <img alt="figure {A}" src="x.png"/>.</p>'
    '<p class="hidden">gone</p><ul><li>first {A}</li><li>second</li></ul><div class="signature"><table><tr><td>void</td><td>f</td><td>(</td><td>int a</td><td>,</td><td>{A} &amp; b</td><td>)</td></tr></table></div>'
    '<div class="fragment"><div class="line"><span class="lineno">1</span>int {A};</div><div class="line"><span class="lineno">2</span>int&#160;b;</div></div>'
    '<a name="t7"></a><h3>Next</h3><p>Text <code>x_y</code> <b>{A}</b>.</p><table><tr><th>k</th><th>v</th></tr><tr><td>1</td><td>{A}</td></tr></table></div></body></html>'
)
_PAGE_SECTIONS = (
    "## About *{A}*\n\nSee [the page](https://docs.example/b/c.html#q) and figure {A}.\n\n* first {A}\n* second\n\n```\nvoid f(int a, {A} & b)\n```\n\n```\nint {A};\nint b;\n```",
    "### Next\n\nText `x_y` **{A}**.\n\n| k | v |\n| --- | --- |\n| 1 | {A} |",
)
_FILE = "Intro of {A}\r\n\n# Guide *to* {A}\n\nSee [b](b.md#q), ![fig](f.md) and `[c](c.md) <b>`; <b>bold {A}</b> <a href='d.md'>d</a>.\n\n```md\n[no](x.md) <i>{A}</i>\n```\n\nNext {A}\n---\n\n- [up](../up/index.md) and [out](https://o.example/x.md)\n\n## Empty\n"
_FILE_SECTIONS = (
    "Intro of {A}",
    "# Guide *to* {A}\n\nSee [b](https://docs.example/how/b/#q), ![fig](f.md) and `[c](c.md) <b>`; **bold {A}** [d](https://docs.example/how/d/).\n\n```md\n[no](x.md) <i>{A}</i>\n```",
    "Next {A}\n---\n\n- [up](https://docs.example/up/) and [out](https://o.example/x.md)",
)


def _sql(text: str) -> str:
    """A literal of the SQL engine with the name of a row in place of ``{A}``."""
    quoted = text.replace("'", "''").replace("\r", "' || chr(13) || '").replace("\n", "' || chr(10) || '")
    return f"replace('{quoted}', '{{A}}', a)"


_NAMES = "(SELECT DISTINCT substr(md5(id), 1, 8) AS a FROM parsed)"


def _made(spark: SparkSession, sf_dir: str, template: str, doc: str, source: Source) -> DataFrame:
    """Sections of one document per section id, made from a template."""
    # Names are small and what is made of them is not: adaptive execution would join them to one task.
    names = _read(spark, sf_dir, "parsed").select(F.substring(F.md5("id"), 1, 8).alias("a")).distinct().repartition(spark.sparkContext.defaultParallelism)
    fill = lambda text: F.replace(F.lit(text), F.lit("{A}"), F.col("a"))
    documents = names.select(F.lit(source.name).alias("source"), fill(doc).alias("doc"), F.encode(fill(template), "UTF-8").alias("content"))
    m = F.col("metadata")
    rows = sections.sections_of(sections.parse_documents(documents, [source]))
    return rows.select("id", "text", m["title"].alias("title"), F.array_join(m["headings"], "|").alias("headings"), m["url"].alias("url"), F.coalesce(m["anchor"], F.lit("")).alias("anchor"))


@query(f"""WITH made AS (SELECT a, 'h/p/' || a || '.html@' || substr(sha256({_sql(_PAGE)}), 1, 16) || '#' AS document, 'https://docs.example/p/' || a || '.html#' AS address FROM {_NAMES})
SELECT document || 's7:0' AS id, {_sql(_PAGE_SECTIONS[0])} AS text, 'Page  of ' || a AS title, 'About *' || a || '*' AS headings, address || 's7' AS url, 's7' AS anchor FROM made
UNION ALL SELECT document || 't7:1', {_sql(_PAGE_SECTIONS[1])}, 'Page  of ' || a, 'About *' || a || '*|Next', address || 't7', 't7' FROM made""")
def html_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region, dropped and flattened parts, listings, anchors, links, images and tables of a page."""
    return _made(spark, sf_dir, _PAGE, "p/{A}.html", Source("h", "html", ".", "https://docs.example/{path}", content="#main", drop=["p.hidden"], flatten=[".signature"]))


_FILE_KEYS = [
    f"substr(sha256('{{\"headings\": [' || {heads} || '], \"page\": null, \"text\": \"' || replace(replace(replace({_sql(text)}, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"'), chr(10), chr(92) || 'n') || '\"}}'), 1, 16)"
    for text, heads in zip(_FILE_SECTIONS, ("''", "'\"Guide *to* ' || a || '\"'", "'\"Guide *to* ' || a || '\", \"Next ' || a || '\"'"))
]


@query(f"""WITH made AS (SELECT a, 'm/how/' || a || '.md@' || substr(sha256({_sql(_FILE)}), 1, 16) || '#' AS document, 'https://docs.example/how/' || a || '/' AS url, 'Guide *to* ' || a AS title FROM {_NAMES})
SELECT document || {_FILE_KEYS[0]} || ':0' AS id, {_sql(_FILE_SECTIONS[0])} AS text, title, '' AS headings, url, '' AS anchor FROM made
UNION ALL SELECT document || {_FILE_KEYS[1]} || ':1', {_sql(_FILE_SECTIONS[1])}, title, title, url, '' FROM made
UNION ALL SELECT document || {_FILE_KEYS[2]} || ':2', {_sql(_FILE_SECTIONS[2])}, title, title || '|Next ' || a, url, '' FROM made""")
def markdown_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code that stays, embedded HTML, links of a directory-style site, two kinds of headings and a section without body."""
    return _made(spark, sf_dir, _FILE, "how/{A}.md", Source("m", "markdown", ".", "https://docs.example/{page}"))


@query("SELECT doc, 'parsed' AS status, sha AS sha256, n AS replacement_characters FROM (SELECT id || '.cpp' AS doc, sha256(text) AS sha, length(text) - length(replace(text, chr(65533), '')) AS n FROM parsed)")
def parse_code_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.audit_of(_parse(spark, sf_dir, "code")).select("doc", "status", "sha256", "replacement_characters")


def _pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[Source]]:
    """Sections with a page number read as pages, and their sources."""
    rows = _read(spark, sf_dir, "parsed").filter("metadata.page IS NOT NULL").dropDuplicates(["id"])
    names = rows.select("source").distinct().limit(MAX_SOURCES + 1).collect()
    if len(names) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    pages = rows.select("source", "doc", F.coalesce("metadata.document_sha256", F.lit("")).alias("sha256"), F.lit(None).cast("string").alias("title"), "metadata.page", "text")
    return pages, [Source(r.source, "pdf", ".", "https://docs.example/{path}") for r in names]


@query()
def parse_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.parse_pages(*_pages(spark, sf_dir))


@query(rf"""WITH pages AS (SELECT source, doc, metadata.page AS page, coalesce(metadata.document_sha256, '') AS sha256, length(text) - length(replace(text, chr(65533), '')) AS damaged FROM parsed WHERE metadata.page IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY ingested_at) = 1)
SELECT source, doc, CASE WHEN n > 0 THEN 'parsed' ELSE 'empty' END AS status, n AS sections, sha256, damaged AS replacement_characters
FROM (SELECT source, doc, min(sha256) AS sha256, count(*) FILTER (WHERE page % 3 > 0) AS n, coalesce(sum(damaged) FILTER (WHERE page % 3 > 0), 0) AS damaged FROM pages GROUP BY ALL)""")
def page_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of one heading with a line, one without and, on every third page, no text."""
    pages, sources = _pages(spark, sf_dir)
    line = F.concat(F.lit("# Page\nIt says: "), F.regexp_replace("text", ex.SPACE + "+", " "), F.lit("\n## Empty\n"))
    pages = pages.withColumn("text", F.when(F.col("page") % 3 > 0, line))
    return sections.audit_of_pages(pages, sections.parse_pages(pages, sources)).select("source", "doc", "status", "sections", "sha256", "replacement_characters")


# ---- sections


_LEVELS = ", ".join(f"CASE WHEN len(h) >= {k} AND page % 6 < {k} THEN h[{k}] END AS h{k}" for k in range(1, 7))
_TOP = "CASE " + " ".join(f"WHEN h{k} IS NOT NULL THEN {k}" for k in range(1, 7)) + " ELSE 7 END"
_CARRY = ", ".join(f"last_value(CASE WHEN top <= {k} THEN struct_pack(v := h{k}) END IGNORE NULLS) OVER w AS c{k}" for k in range(1, 7))


@query(f"""WITH base AS (SELECT id, source, doc, metadata.page AS page, {_ORDER} AS seq, coalesce(metadata.headings, []) AS h FROM parsed WHERE metadata.page IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY ingested_at) = 1),
levels AS (SELECT id, source, doc, page, seq, {_LEVELS} FROM base), marked AS (SELECT *, {_TOP} AS top FROM levels),
carried AS (SELECT id, {_CARRY} FROM marked WINDOW w AS (PARTITION BY source, doc ORDER BY page, seq ROWS UNBOUNDED PRECEDING))
SELECT id, {' || '.join(f"coalesce(c{k}.v || '>', '-')" for k in range(1, 7))} AS headings FROM carried""")
def heading_carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _read(spark, sf_dir, "parsed").filter("metadata.page IS NOT NULL").dropDuplicates(["id"])
    page, heads = F.col("metadata.page"), F.coalesce("metadata.headings", F.array().cast("array<string>"))
    levels = F.array(*(F.when((F.size(heads) >= k) & (page % 6 < k), F.get(heads, F.lit(k - 1))) for k in range(1, 7)))
    rows = base.select("id", "source", "doc", page.alias("page"), F.regexp_extract("id", r":(\d{1,15})$", 1).cast("bigint").alias("seq"), levels.alias("levels"))
    joined = F.concat(*(F.coalesce(F.concat(F.get("carried", F.lit(k)), F.lit(">")), F.lit("-")) for k in range(6)))
    return sections.carry_headings(rows).select("id", joined.alias("headings"))


@query(rf"""SELECT id, array_to_string(list_transform(metadata.headings, lambda h: regexp_replace(regexp_replace(regexp_replace('*<b>' || h || '</b>*', '\*\*|`|</?(?:span|em|strong|b|i)(?:\s[^>]*)?>', '', 'g'), '^{_WS}+|{_WS}+$', '', 'g'), '^\*(.+)\*$', '\1')), '|') AS headings FROM parsed WHERE metadata.headings IS NOT NULL""")
def heading_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = F.transform("metadata.headings", lambda h: ex.heading_text(F.concat(F.lit("*<b>"), h, F.lit("</b>*"))))
    return _read(spark, sf_dir, "parsed").filter("metadata.headings IS NOT NULL").select("id", F.array_join(heads, "|").alias("headings"))


def _numbered(parsed: DataFrame, *columns) -> DataFrame:  # noqa: ANN002
    """Sections once per id with their number ``i`` (from 0) in the document."""
    position = F.regexp_extract("id", r":(\d{1,15})$", 1).cast("bigint")
    flat = parsed.dropDuplicates(["id"]).select("id", "source", "doc", position.alias("position"), *columns)
    return sections.numbered(flat, ["position", "id"], F.floor(F.col("position") / 1000))


@query(rf"""SELECT id, source || '/' || doc || '@' || substr(coalesce(metadata.document_sha256, ''), 1, 16) || '#' || coalesce(metadata.anchor, 'key') || ':' || (row_number() OVER (PARTITION BY source, doc ORDER BY {_ORDER}) - 1) AS rebuilt FROM {_ONCE}""")
def section_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = _numbered(_read(spark, sf_dir, "parsed"), F.col("metadata"))
    m = F.col("metadata")
    rebuilt = sections.section_id(F.coalesce(m["document_sha256"], F.lit("")), F.coalesce(m["anchor"], F.lit("key")), F.col("i"))
    return flat.select("id", rebuilt.alias("rebuilt"))


@query("SELECT metadata.source AS source, metadata.doc AS doc, count(*) AS sections, sum(length(text) - length(replace(text, chr(65533), ''))) AS replacement_characters FROM parsed GROUP BY ALL")
def audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.audit_sections(_read(spark, sf_dir, "parsed"))


@query("SELECT metadata.source AS source, count(DISTINCT metadata.doc) AS docs, count(*) AS sections, sum(length(text)) AS chars FROM parsed GROUP BY ALL")
def source_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.source_summary(_read(spark, sf_dir, "parsed"))


@query(f"""SELECT a.source, a.doc FROM audit a ANTI JOIN parsed p ON p.source = a.source AND p.doc = a.doc WHERE a.status = 'parsed'
UNION ALL SELECT a.source, a.doc FROM audit a JOIN (SELECT source, doc, count(*) AS n FROM {_ONCE} GROUP BY ALL) p USING (source, doc) WHERE a.sections IS NOT NULL AND a.sections + CASE WHEN a.audit_id % 7 = 0 THEN 1 ELSE 0 END <> p.n
UNION ALL SELECT source, doc || '#gone' FROM audit WHERE audit_id % 11 = 0 AND status = 'parsed'""")
def audit_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit with every seventh number wrong, and every eleventh document once more under a name without sections."""
    audit = _read(spark, sf_dir, "audit")
    wrong = audit.withColumn("sections", F.col("sections") + F.when(F.col("audit_id") % 7 == 0, 1).otherwise(0))
    gone = audit.filter("audit_id % 11 = 0").withColumn("doc", F.concat("doc", F.lit("#gone")))
    return sections.audit_mismatches(wrong.unionByName(gone), _read(spark, sf_dir, "parsed"))


_LINE_ENDS = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
_UNDER = r"^ {0,3}(=+|-+)\s*$"
# One row per line of each text (line ends made equal), with what the scanners ask of it.
_LINES = rf"""texts AS (SELECT DISTINCT id, regexp_replace(text, '{_LINE_ENDS}', chr(10), 'g') AS text FROM parsed),
raw AS (SELECT id, generate_subscripts(l, 1) AS k, unnest(l) AS line FROM (SELECT id, string_split(text, chr(10)) AS l FROM texts)),
lines AS (SELECT id, k, line, regexp_extract(line, '^ {{0,3}}(`{{3,}}|~{{3,}})', 1) AS mark, regexp_matches(line, '^ {{0,3}}(`{{3,}}|~{{3,}})\s*$') AS bare, regexp_replace(line, '{_WS}+', '', 'g') = '' AS blank,
regexp_extract(line, '^ {{0,3}}(#{{1,6}})[ \t]+(.+?)\s*#*\s*$', 1) AS atx, regexp_extract(line, '^ {{0,3}}(#{{1,6}})[ \t]+(.+?)\s*#*\s*$', 2) AS name, lead(line) OVER (PARTITION BY id ORDER BY k) AS following FROM raw)"""


def _title(raw: str) -> str:
    """SQL of a heading text without emphasis and inline tags."""
    plain = rf"regexp_replace(regexp_replace({raw}, '\*\*|`|</?(?:span|em|strong|b|i)(?:\s[^>]*)?>', '', 'g'), '^{_WS}+|{_WS}+$', '', 'g')"
    return rf"regexp_replace({plain}, '^\*(.+)\*$', '\1')"


_STACK = ", ".join(f"last_value(CASE WHEN level <= {k} THEN struct_pack(v := CASE WHEN level = {k} THEN title END) END IGNORE NULLS) OVER w AS c{k}" for k in range(1, 7))


def _same_line_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.regexp_replace("text", ex.LINE_SEPARATORS, "\n")
    return _read(spark, sf_dir, "parsed").select("id", text.alias("text")).distinct()


# ---- structure and chunks


@query(rf"""WITH RECURSIVE {_LINES},
scan AS (SELECT id, 0::BIGINT AS k, 1::BIGINT AS next, '' AS run, 0 AS level FROM texts
UNION ALL SELECT s.id, l.k, l.k + CASE WHEN s.run = '' AND under THEN 2 ELSE 1 END, CASE WHEN s.run = '' AND under THEN '' WHEN s.run = '' THEN l.mark WHEN starts_with(l.mark, s.run) AND l.mark <> '' AND l.bare THEN '' ELSE s.run END,
CASE WHEN s.run <> '' THEN 0 WHEN l.atx <> '' THEN length(l.atx) WHEN under THEN CASE WHEN ltrim(l.following) LIKE '=%' THEN 1 ELSE 2 END ELSE 0 END
FROM scan s JOIN (SELECT *, coalesce(NOT blank AND regexp_matches(following, '{_UNDER}') AND NOT starts_with(line, '    ') AND NOT starts_with(line, chr(9)), false) AS under FROM lines) l ON l.id = s.id AND l.k = s.next),
parts AS (SELECT r.id, r.k, r.line, sum(CASE WHEN s.level > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY r.id ORDER BY r.k) AS part, CASE WHEN s.level > 0 THEN s.level END AS level, CASE WHEN r.atx <> '' THEN {_title("r.name")} ELSE {_title("r.line")} END AS title, sum(length(r.line) + 1) OVER (PARTITION BY r.id ORDER BY r.k) - length(r.line) - 1 AS pos
FROM lines r LEFT JOIN scan s ON s.id = r.id AND s.k = r.k),
sections AS (SELECT id, part, min(pos) AS start, max(pos + length(line) + 1) AS last, max(level) AS level, max(title) FILTER (WHERE level > 0) AS title, trim(string_agg(line, chr(10) ORDER BY k), chr(10)) AS text FROM parts GROUP BY id, part),
carried AS (SELECT *, {_STACK}, lead(start) OVER (PARTITION BY id ORDER BY part) AS following FROM sections WINDOW w AS (PARTITION BY id ORDER BY part ROWS UNBOUNDED PRECEDING))
SELECT c.id, row_number() OVER (PARTITION BY c.id ORDER BY part) - 1 AS section_no, start, coalesce(following, length(t.text)) AS stop, {' || '.join(f"coalesce(c{k}.v || '>', '')" for k in range(1, 7))} AS headings, c.text FROM carried c JOIN texts t ON t.id = c.id WHERE regexp_replace(c.text, '{_WS}+', '', 'g') <> ''""")
def section_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = F.array_join(F.transform("headings", lambda h: F.concat(h, F.lit(">"))), "")
    return sections.split_texts(_same_line_ends(spark, sf_dir)).select("id", "section_no", "start", F.col("end").alias("stop"), joined.alias("headings"), "text")


@query(rf"""WITH RECURSIVE {_LINES},
scan AS (SELECT id, 0::BIGINT AS k, '' AS before, '' AS run FROM texts
UNION ALL SELECT s.id, l.k, s.run, CASE WHEN s.run = '' THEN l.mark WHEN starts_with(l.mark, s.run) AND l.mark <> '' AND l.bare THEN '' ELSE s.run END FROM scan s JOIN lines l ON l.id = s.id AND l.k = s.k + 1),
state AS (SELECT l.id, l.k, l.line, s.before, s.run, s.before = '' AND s.run = '' AND l.blank AS gap, CASE WHEN s.before <> '' OR s.run <> '' THEN 2 WHEN contains(l.line, '|') THEN 1 ELSE 0 END AS kind FROM lines l JOIN scan s ON s.id = l.id AND s.k = l.k),
numbered AS (SELECT *, sum(gap::INT + (before = '' AND run <> '')::INT) OVER w + coalesce(sum((before <> '' AND run = '')::INT) OVER (PARTITION BY id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS number FROM state WINDOW w AS (PARTITION BY id ORDER BY k)),
kept AS (SELECT *, coalesce(lag(number) OVER w <> number OR lag(kind) OVER w <> kind, true) AS fresh FROM numbered WHERE NOT gap WINDOW w AS (PARTITION BY id ORDER BY k)),
islands AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY id ORDER BY k) AS island FROM kept)
SELECT id, island - 1 AS block_no, string_agg(line, chr(10) ORDER BY k) || CASE WHEN max_by(run, k) <> '' THEN chr(10) || max_by(run, k) ELSE '' END AS text FROM islands GROUP BY id, island""")
def text_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.block_table(_same_line_ends(spark, sf_dir))


@query(r"""WITH RECURSIVE lines AS (SELECT id, generate_subscripts(l, 1) AS k, unnest(l) AS line FROM (SELECT id, string_split_regex(text, '\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]') AS l FROM (SELECT DISTINCT id, text FROM parsed))),
marks AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY k) AS k, regexp_extract(line, '^ {0,3}(`{3,}|~{3,})', 1) AS mark, regexp_matches(line, '^ {0,3}(`{3,}|~{3,})\s*$') AS bare FROM lines WHERE regexp_matches(line, '^ {0,3}(`{3,}|~{3,})')),
scan AS (SELECT id, 0::BIGINT AS k, '' AS run FROM (SELECT DISTINCT id FROM parsed) UNION ALL
SELECT s.id, m.k, CASE WHEN s.run = '' THEN m.mark WHEN starts_with(m.mark, s.run) AND m.bare THEN '' ELSE s.run END FROM scan s JOIN marks m ON m.id = s.id AND m.k = s.k + 1)
SELECT id, arg_max(run, k) AS run FROM scan GROUP BY id""")
def fence_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return each(_read(spark, sf_dir, "parsed").select("id", "text").distinct(), lambda text: (markdown.open_fence(text) or markdown.Fence("", "")).run, ["text"], "run", T.StringType())


@query(rf"""SELECT id, sum(length(text) + 2) OVER (PARTITION BY source, doc ORDER BY {_ORDER}) - length(text) - 2 AS "begin", length(text) AS length FROM {_ONCE} WHERE regexp_replace(text, '{_WS}+', '', 'g') <> ''""")
def document_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.section_offsets(_read(spark, sf_dir, "parsed")).select("id", "begin", "length")


@query(r"""WITH RECURSIVE units AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS k, length(line) AS n FROM (SELECT doc_id, generate_subscripts(l, 1) AS k, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)) WHERE line <> ''),
pack AS (SELECT doc_id, k, n AS open, 1 AS grp FROM units WHERE k = 1 UNION ALL
SELECT u.doc_id, u.k, CASE WHEN p.open + 2 + u.n <= 600 THEN p.open + 2 + u.n ELSE u.n END, CASE WHEN p.open + 2 + u.n <= 600 THEN p.grp ELSE p.grp + 1 END FROM pack p JOIN units u ON u.doc_id = p.doc_id AND u.k = p.k + 1),
groups AS (SELECT doc_id, grp, max_by(open, k) AS size FROM pack GROUP BY ALL)
SELECT doc_id, array_to_string(list(size ORDER BY grp), ',') AS sizes FROM groups GROUP BY doc_id""")
def greedy_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a text as units; one that is too long stands alone."""
    docs = _read(spark, sf_dir, "documents").filter("text IS NOT NULL").select("doc_id", F.filter(F.split("text", "\n"), lambda line: line != "").alias("lines")).filter(F.size("lines") > 0)
    packed = lambda lines: chunking.filled(lines, "\n\n".join, lambda body: len(body) <= 600, lambda line: iter([line]))
    return each(docs, lambda lines: ",".join(str(len(body)) for body in packed(lines)), ["lines"], "sizes", T.StringType())


@query("""SELECT id, array_to_string(list_concat([metadata.title], CASE WHEN len(metadata.headings) > 0 AND metadata.headings[1] = metadata.title THEN metadata.headings[2:] ELSE metadata.headings END), ' > ') AS header FROM chunks WHERE metadata.title IS NOT NULL AND metadata.headings IS NOT NULL""")
def chunk_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "chunks").filter("metadata.title IS NOT NULL AND metadata.headings IS NOT NULL")
    return each(rows.select("id", F.col("metadata.title").alias("title"), F.col("metadata.headings").alias("headings")), chunking.header_text, ["title", "headings"], "header", T.StringType())


@query(f"""WITH pairs AS (SELECT id, metadata.headings AS a, lag(metadata.headings) OVER (PARTITION BY source, doc ORDER BY {_ORDER}) AS b FROM {_ONCE})
SELECT id, array_to_string(a[1:coalesce(list_position(list_transform(range(1, least(len(a), len(b)) + 1), lambda k: a[k] IS DISTINCT FROM b[k]), true) - 1, least(len(a), len(b)))], '|') AS prefix FROM pairs WHERE a IS NOT NULL AND b IS NOT NULL""")
def common_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _numbered(_read(spark, sf_dir, "parsed"), F.col("metadata.headings").alias("a"))
    # The section before, by its number: a join spreads where a window over a document would not.
    before = rows.select("source", "doc", (F.col("i") + 1).alias("i"), F.col("a").alias("b"))
    pairs = rows.join(before, ["source", "doc", "i"]).filter("a IS NOT NULL AND b IS NOT NULL").select("id", F.array("a", "b").alias("lists"))
    return each(pairs, chunking.shared_prefix, ["lists"], "prefix", T.ArrayType(T.StringType())).select("id", F.array_join("prefix", "|").alias("prefix"))


def _flat_chunks(chunks: DataFrame) -> DataFrame:
    m = F.col("metadata")
    return chunks.select("id", "text", "body", F.array_join(m["headings"], " > ").alias("headings"), m["url"].alias("url"), m["page"].alias("page"), F.array_join(m["sections"], "|").alias("sections"))


@query()
def chunk_structured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_chunks(chunking.chunk_structured(_read(spark, sf_dir, "parsed"), strict=False))


@query()
def chunk_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_chunks(chunking.chunk_recursive(_read(spark, sf_dir, "parsed")))


_HEADER = "array_to_string(list_concat([coalesce({title}, '')], CASE WHEN len({heads}) > 0 AND {heads}[1] = {title} THEN {heads}[2:] ELSE {heads} END), ' > ')"
_PREFIX = "{a}[1:coalesce(list_position(list_transform(range(1, least(len({a}), len({b})) + 1), lambda k: {a}[k] IS DISTINCT FROM {b}[k]), true) - 1, least(len({a}), len({b})))]"


@query(f"""WITH RECURSIVE base AS (SELECT id, source, doc, metadata.title AS title, coalesce(metadata.headings, []) AS h, 'About ' || id AS t, row_number() OVER (PARTITION BY source, doc ORDER BY {_ORDER}) AS n FROM {_ONCE} WHERE regexp_replace(text, '{_WS}+', '', 'g') <> ''),
fold AS (SELECT source, doc, n, 1 AS grp, length(t) AS body, h AS shared, h AS last, title FROM base WHERE n = 1
UNION ALL SELECT source, doc, n, CASE WHEN joins THEN grp ELSE grp + 1 END, CASE WHEN joins THEN body + 2 ELSE 0 END + length(t), CASE WHEN joins THEN common ELSE h END, h, CASE WHEN joins THEN title ELSE own END
FROM (SELECT *, (last = h OR (len(last) >= 2 AND len(h) >= 2 AND last[1:len(last) - 1] = h[1:len(h) - 1])) AND body < 300 AND length({_HEADER.format(title="title", heads="common")}) + body + length(t) + 4 <= 1200 AS joins
FROM (SELECT b.source, b.doc, b.n, b.h, b.t, b.title AS own, f.grp, f.body, f.last, f.title, {_PREFIX.format(a="f.shared", b="b.h")} AS common FROM fold f JOIN base b ON b.source = f.source AND b.doc = f.doc AND b.n = f.n + 1))),
groups AS (SELECT f.source, f.doc, f.grp, arg_max(f.shared, f.n) AS shared, any_value(f.title) AS title, string_agg(b.t, chr(10) || chr(10) ORDER BY f.n) AS body, string_agg(b.id, '|' ORDER BY f.n) AS sections FROM fold f JOIN base b ON b.source = f.source AND b.doc = f.doc AND b.n = f.n GROUP BY f.source, f.doc, f.grp)
SELECT source || '/' || doc || '#' || (grp - 1) AS chunk, {_HEADER.format(title="title", heads="shared")} || chr(10) || chr(10) || body AS text, sections FROM groups""")
def chunk_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every section with a short text of its own, so that sections are merged and none is cut."""
    parsed = _read(spark, sf_dir, "parsed")
    short = parsed.withColumn("text", F.when(~ex.is_blank(F.col("text")), F.concat(F.lit("About "), "id")))
    chunks = chunking.chunk_structured(short)
    m = F.col("metadata")
    return chunks.select(F.regexp_extract("id", "^[^:]*:[^:]*:(.*)$", 1).alias("chunk"), "text", F.array_join(m["sections"], "|").alias("sections"))


@query("""WITH docs AS (SELECT DISTINCT id, length(text) % 700 + 1 AS n FROM parsed),
chunks AS (SELECT id, n, j, 1 + 175 * j AS first, least(n, 200 + 175 * j) AS last FROM docs, range(0, 5) t(j) WHERE j = 0 OR 200 + 175 * (j - 1) < n)
SELECT id || '#' || j AS chunk, array_to_string(list_transform(range(first, last + 1), lambda k: CASE WHEN k > 1 THEN ' ' ELSE '' END || 'w' || lpad(k::VARCHAR, 4, '0')), '') AS text, id AS section, greatest(6 * first - 7, 0) AS span_start, 6 * last - 1 AS span_end FROM chunks""")
def chunk_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every section as a document of numbered words of five letters, cut recursively with overlap: 200 words fit, 25 are repeated."""
    rows = _read(spark, sf_dir, "parsed").filter("text IS NOT NULL").select("id", F.length("text").alias("n"), "metadata")
    words = F.array_join(F.transform(F.sequence(F.lit(1), F.col("n") % 700 + 1), lambda k: F.concat(F.lit("w"), F.lpad(k.cast("string"), 4, "0"))), " ")
    made = rows.select("id", words.alias("text"), F.col("metadata").withField("doc", F.col("id")).withField("source", F.lit("s")).alias("metadata"))
    each_chunk = chunking.chunk_recursive(made).select(F.regexp_extract("id", "^[^:]*:[^:]*:s/(.*)$", 1).alias("chunk"), "text", F.explode("metadata.locations").alias("l"))
    return each_chunk.select("chunk", "text", F.col("l.section_id").alias("section"), F.get("l.section_span", F.lit(0)).alias("span_start"), F.get("l.section_span", F.lit(1)).alias("span_end"))


_FRAMES = {"code": ("```c", "```", "int v{k} = {k};"), "table": ("| key | square |\n| --- | --- |", "", "| {k} | {kk} |")}


def _framed(kind: str, rows: int) -> str:
    head, foot, row = _FRAMES[kind]
    return "\n".join(filter(None, [head, *(row.format(k=k, kk=k * k) for k in range(1, rows + 1)), foot]))


@query("""WITH RECURSIVE lines AS (SELECT 'code' AS kind, k, 'int v' || k || ' = ' || k || ';' AS line, 4 + 1 + 1 + 3 AS frame FROM range(1, 121) t(k) UNION ALL SELECT 'table', k, '| ' || k || ' | ' || (k * k) || ' |', 16 + 1 + 13 + 1 FROM range(1, 121) t(k)),
fold AS (SELECT kind, k, 0 AS piece, frame + length(line) AS open FROM lines WHERE k = 1
UNION ALL SELECT l.kind, l.k, CASE WHEN f.open + 1 + length(l.line) <= 100 THEN f.piece ELSE f.piece + 1 END, CASE WHEN f.open + 1 + length(l.line) <= 100 THEN f.open + 1 ELSE l.frame END + length(l.line) FROM fold f JOIN lines l ON l.kind = f.kind AND l.k = f.k + 1),
texts AS (SELECT DISTINCT id, length(text) % 120 + 1 AS n FROM parsed)
SELECT t.id, l.kind, f.piece, CASE WHEN l.kind = 'code' THEN '```c' ELSE '| key | square |' || chr(10) || '| --- | --- |' END || chr(10) || string_agg(l.line, chr(10) ORDER BY l.k) || CASE WHEN l.kind = 'code' THEN chr(10) || '```' ELSE '' END AS text
FROM texts t JOIN lines l ON l.k <= t.n JOIN fold f ON f.kind = l.kind AND f.k = l.k GROUP BY t.id, l.kind, f.piece""")
def block_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing and a table of as many rows as the length of each text gives, cut into pieces of 100 characters."""
    rows = _read(spark, sf_dir, "parsed").select("id", (F.length("text") % 120 + 1).alias("n")).distinct().filter("n IS NOT NULL").repartition(spark.sparkContext.defaultParallelism)
    both = rows.select("id", "n", F.explode(F.array(*map(F.lit, _FRAMES))).alias("kind")).withColumn("k", F.col("kind"))
    cut = each(both, lambda kind, n: chunking.pack_text(_framed(kind, n), 100), ["k", "n"], "pieces", T.ArrayType(T.StringType()))
    return cut.select("id", "kind", F.posexplode("pieces").alias("piece", "text"))


@query(rf"""WITH flat AS (SELECT source, doc, id, length(text) AS length, sum(length(text) + 2) OVER (PARTITION BY source, doc ORDER BY {_ORDER}) - length(text) - 2 AS begin FROM {_ONCE} WHERE regexp_replace(text, '{_WS}+', '', 'g') <> ''),
pieces AS (SELECT source, doc, piece, piece * 1000 - CASE WHEN piece > 0 THEN 100 ELSE 0 END AS start, piece * 1000 + 1000 AS stop FROM (SELECT source, doc, unnest(range(0, (sum(length + 2) // 1000)::BIGINT + 1)) AS piece FROM flat GROUP BY source, doc))
SELECT p.piece, s.id, greatest(0, p.start - s.begin) AS span_start, least(s.length, p.stop - s.begin) AS span_end FROM pieces p JOIN flat s ON p.source = s.source AND p.doc = s.doc AND s.begin < p.stop AND s.begin + s.length > p.start""")
def coverage_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    offsets = chunking.section_offsets(_read(spark, sf_dir, "parsed"))
    sizes = offsets.groupBy("source", "doc").agg(F.sum(F.col("length") + 2).alias("size"))
    pieces = sizes.select("source", "doc", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr("size div 1000"))).alias("piece"))
    windows = pieces.select("source", "doc", "piece", (F.col("piece") * 1000 - F.when(F.col("piece") > 0, 100).otherwise(0)).alias("start"), (F.col("piece") * 1000 + 1000).alias("stop"))
    return chunking.coverage(windows, offsets).select("piece", "id", "span_start", "span_end")


@query("SELECT count(*) AS chunks, list_sort(list(length(text)))[count(*) // 2 + 1] AS median, max(length(text)) AS max FROM chunks WHERE text IS NOT NULL")
def chunk_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.length_statistics(_read(spark, sf_dir, "chunks"))


@query(f"""SELECT problem, count(*) AS rows FROM (SELECT CASE WHEN id IS NULL OR id = '' THEN 'id' WHEN text IS NULL OR regexp_replace(text, '{_WS}+', '', 'g') = '' THEN 'text' WHEN metadata IS NULL THEN 'metadata' END AS problem FROM chunks) WHERE problem IS NOT NULL GROUP BY problem
UNION ALL SELECT 'duplicate', sum(n) FROM (SELECT id, count(*) AS n FROM chunks WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1) HAVING sum(n) > 0""")
def chunk_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return artifacts.chunk_violations(_read(spark, sf_dir, "chunks"))


# ---- embedding and index


@query("""SELECT vec_id, CASE WHEN vector IS NULL THEN 'null' WHEN len(vector) <> 64 THEN 'dimension' WHEN len(list_filter(vector, lambda x: x IS NULL OR NOT isfinite(x))) > 0 THEN 'non-finite' WHEN len(list_filter(vector, lambda x: x <> 0)) = 0 THEN 'zero' ELSE 'ok' END AS state FROM points""")
def vector_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "points").select("vec_id", F.coalesce(ex.vector_problem(F.col("vector"), 64), F.lit("ok")).alias("state"))


@query(rf"SELECT doc_id, 'Instruct: Find the page.' || chr(10) || 'Query: ' || text AS prompt FROM documents WHERE regexp_replace(text, '{_WS}+', '', 'g') <> ''")
def query_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents").filter(~ex.is_blank(F.coalesce("text", F.lit(""))))
    return each(documents.select("doc_id", "text"), lambda text: embedding.query_prompt(text, "Find the page."), ["text"], "prompt", T.StringType())


@query("""SELECT DISTINCT id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', (strpos('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS point_id
FROM (SELECT id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('docmill:chunk:' || id)) AS h FROM chunks)""")
def point_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "chunks").select("id", point_id(F.col("id")).alias("point_id")).distinct()


@query("SELECT DISTINCT id FROM chunks WHERE id IS NOT NULL AND id NOT IN (SELECT chunk_id FROM points WHERE chunk_id IS NOT NULL)")
def resume_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _read(spark, sf_dir, "points").filter("chunk_id IS NOT NULL").select(point_id(F.col("chunk_id")).alias("point_id"))
    return vindex.missing_chunks(points, _read(spark, sf_dir, "chunks").filter("id IS NOT NULL").select("id").distinct()).select("id")


@query("""SELECT id FROM (SELECT id, text, body, row_number() OVER (PARTITION BY id ORDER BY ingested_at) AS n FROM chunks) WHERE n = 1 AND length(text) % 2 = 0""")
def payload_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = _read(spark, sf_dir, "chunks").dropDuplicates(["id"]).select("id", "text", "body", "metadata")
    stored = chunks.withColumn("body", F.when(F.length("text") % 2 == 0, F.concat("body", F.lit("!"))).otherwise(F.col("body")))
    points = stored.select(point_id(F.col("id")).alias("point_id"), F.struct("id", "text", "body", "metadata").alias("payload"))
    return vindex.payload_mismatches(points, chunks).select("id")


@query("SELECT indexed, expected, indexed = expected AS complete FROM (SELECT count(DISTINCT chunk_id) AS indexed FROM points), (SELECT count(DISTINCT id) AS expected FROM chunks)")
def complete_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vindex.completeness(_read(spark, sf_dir, "points"), _read(spark, sf_dir, "chunks"), "chunk_id")


# ---- retrieval


@query("""SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings ORDER BY vec_id LIMIT 1)), 6) AS score FROM embeddings ORDER BY round(list_cosine_similarity(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings ORDER BY vec_id LIMIT 1)), 9) DESC, vec_id LIMIT 5""")
def cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    asked = table.orderBy("vec_id").first()
    return retrieval.cosine_top_k(table, asked.vector, 5, "vec_id", 9).select("vec_id", F.round("score", 6).alias("score"))


_EMBEDDED = "(SELECT q.vec_id AS query_id, p.vec_id AS id, p.label AS label, q.label AS query_label, round(list_cosine_similarity(q.embedding::DOUBLE[], p.embedding::DOUBLE[]), 9) AS s FROM embeddings q JOIN embeddings p ON p.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)"


@query(f"SELECT query_id, id, round(s, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank FROM {_EMBEDDED} QUALIFY rank <= 10")
def batch_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    found = retrieval.batch_top_k(table, table.filter("query_id % 50 = 0"), 10, 64, "query_id")
    return found.select("query_id", "id", F.round("score", 6).alias("score"), "rank")


@query("""SELECT id, coalesce(l.section_id, '') AS section_id, l.url AS url, l.page AS page FROM (SELECT id, unnest(CASE WHEN len(metadata.locations) > 0 THEN list_transform(metadata.locations, lambda x: struct_pack(section_id := x.section_id, url := x.url, page := x.page)) ELSE [struct_pack(section_id := NULL::VARCHAR, url := metadata.url, page := metadata.page)] END) AS l FROM chunks)""")
def citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = _read(spark, sf_dir, "chunks").select("id", F.explode(ex.citations(F.col("metadata"))).alias("l"))
    return each.select("id", F.coalesce("l.section_id", F.lit("")).alias("section_id"), F.col("l.url").alias("url"), F.col("l.page").alias("page"))


@query(f"""WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank FROM {_EMBEDDED}), totals AS (SELECT query_id, count(*) FILTER (WHERE label = query_label) AS total FROM ranked GROUP BY query_id)
SELECT r.query_id, round(count(*) FILTER (WHERE rank <= 10 AND label = query_label) / least(any_value(total), 10), 6) AS recall, round(coalesce(1 / min(rank) FILTER (WHERE rank <= 10 AND label = query_label), 0), 6) AS reciprocal_rank
FROM ranked r JOIN totals t USING (query_id) WHERE total > 0 GROUP BY r.query_id""")
def recall_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extension: rows of the same label are relevant."""
    table = _read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"), "label")
    ranked = retrieval.batch_top_k(table, table.filter("query_id % 50 = 0"), 10, 64, "query_id")
    labels = table.select(F.col("query_id").alias("id"), "label")
    asked = table.filter("query_id % 50 = 0").select("query_id", "label")
    relevant = asked.join(labels, "label").filter("query_id <> id").select("query_id", "id")
    return retrieval.recall_at_k(ranked, relevant, 10).select("query_id", F.round("recall", 6).alias("recall"), F.round("reciprocal_rank", 6).alias("reciprocal_rank"))


@query("""WITH held AS (SELECT id, any_value(metadata) AS m FROM chunks WHERE id IS NOT NULL GROUP BY id),
good AS (SELECT vec_id, chunk_id, vector::DOUBLE[] AS v FROM points WHERE len(vector) = 64 AND len(list_filter(vector, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(vector, lambda x: x <> 0)) > 0),
scored AS (SELECT g.vec_id, h.id, h.m, round(list_cosine_similarity(g.v, (SELECT v FROM good ORDER BY vec_id LIMIT 1)), 9) AS s FROM good g JOIN held h ON h.id = g.chunk_id ORDER BY s DESC, vec_id LIMIT 10)
SELECT vec_id, id AS chunk_id, round(s, 6) AS score, array_to_string(CASE WHEN len(m.locations) > 0 THEN list_transform(m.locations, lambda x: coalesce(x.url, '')) ELSE [coalesce(m.url, '')] END, '|') AS citations FROM scored""")
def retrieve_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored vectors with the chunks they belong to as a collection; the first usable vector asks."""
    points = _read(spark, sf_dir, "points").filter(ex.vector_problem(F.col("vector"), 64).isNull())
    payload = _read(spark, sf_dir, "chunks").filter("id IS NOT NULL").dropDuplicates(["id"]).select(F.col("id").alias("chunk_id"), F.struct("id", "text", "body", "metadata").alias("payload"))
    asked = points.orderBy("vec_id").select("vector").first().vector
    found = retrieval.cosine_top_k(points.join(payload, "chunk_id").select("vec_id", "vector", "payload"), asked, 10, "vec_id", digits=9)
    return retrieval.cited(found, "vec_id").select("vec_id", F.col("chunk.id").alias("chunk_id"), F.round("score", 6).alias("score"), F.array_join(F.transform("citations", lambda c: F.coalesce(c["url"], F.lit(""))), "|").alias("citations"))


_QUESTION = "Which option rebuilds the preconditioner of the linear solver?"


def _search(chunks: DataFrame, k: int) -> DataFrame:
    """Chunks to vectors to the nearest chunks with citations."""
    provider = embedding.HashingEmbedding(256)
    points = embedding.embed_table(chunks.select(point_id(F.col("id")).alias("point_id"), "text", F.struct("id", "text", "body", "metadata").alias("payload")), provider)
    found = retrieval.cited(retrieval.cosine_top_k(points, provider.embed_query(_QUESTION), k, digits=9))
    return found.select(F.round("score", 6).alias("score"), F.col("chunk.id").alias("chunk_id"), F.col("chunk.text").alias("text"), F.array_join(F.transform("citations", lambda c: F.coalesce(c["url"], F.lit(""))), "|").alias("citations"))


@query()
def retrieve_cited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(chunking.chunk_structured(_read(spark, sf_dir, "parsed"), strict=False), 5)


@query()
def strategy_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _read(spark, sf_dir, "parsed")
    structured = _search(chunking.chunk_structured(parsed, strict=False), 5).withColumn("strategy", F.lit("structured"))
    # A piece of white space alone is no valid record of a collection.
    recursive = _search(chunking.chunk_recursive(parsed).filter(~ex.is_blank(F.col("text"))), 5).withColumn("strategy", F.lit("recursive"))
    return structured.unionByName(recursive)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
