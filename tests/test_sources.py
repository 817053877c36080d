import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmill.cli import build_parser, run
from docmill.functions import expressions as ex
from docmill.functions import html, markdown
from docmill.functions.text import each
from docmill.operators.sections import code_markdown
from docmill.sources.config import Source, addressed, document_address, read_sources, select_sources
from docmill.sources.crawl import corpus_size, download, fetch_url, listed, listed_files, listed_pages, provenance, tree_files
from docmill.sources.scan import scan_pages


def texts(spark, values):
    return spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, t string")


def both(spark, values, column, plain):
    got = {r.k: r.v for r in texts(spark, values).select("k", column.alias("v")).collect()}
    for k, value in enumerate(values):
        assert got[k] == plain(value), repr(value)


def noise(n, alphabet, seed, most=30):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, most))) for _ in range(n)]


def test_native_expressions_equal_the_kernels(spark):
    t = F.col("t")
    both(spark, noise(400, "*a`<b>/ i", 3), ex.heading_text(t), lambda s: markdown.heading_texts({1: s})[0])
    docs = ["a/b.html", "how/x.md", "index.md", "t/index.md", "dir/.hidden", "plain", "a.b/c", "x/index", "noindex.md"]
    both(spark, docs, ex.document_url(F.lit("u/{page}|{path}"), t), lambda d: document_address("u/{page}|{path}", d))
    globs = ["index.md", "event*.md", "a?c", "t/*"]
    import fnmatch

    both(spark, ["index.md", "event1.md", "x/event.md", "abc", "a/c", "t/u/v", ""], ex.matching_globs(t, globs), lambda d: [g for g in globs if fnmatch.fnmatchcase(d, g)])


def test_kernels_over_a_table(spark):
    df = spark.createDataFrame([(1, "a", ["x"]), (2, None, None)], "k int, t string, l array<string>")
    got = {r.k: r.n for r in each(df, lambda t, items: len(t or "") + len(items or []), ["t", "l"], "n", T.LongType()).collect()}
    assert got == {1: 2, 2: 0} and each(df.limit(0), len, ["t"], "k", T.IntegerType()).columns == ["l", "k"]
    assert html.one_line(" f ( int a ,  b ) ") == "f(int a, b)" and code_markdown("d.hpp", "x ```` y\n\n") == "# d.hpp\n\n`````cpp\nx ```` y\n`````\n"


def test_choosing_pages(spark):
    page = '<a href="classA.html"><a href="classA.html"><a href="structB.html"><a href="classA-members.html"><a href="namespacemembers_a.html"><a href="namespaceX.html"><a href="files.html">'
    got = listed_pages(spark.createDataFrame([(page,), (None,)], "html string"), "https://d/").collect()
    assert [tuple(r) for r in got] == [(n, f"https://d/{n}") for n in ("classA.html", "namespaceX.html", "structB.html")]
    tree = '{"sha":"s1","truncated":%s,"tree":[{"path":"src/a.md"},{"path":"src/b.txt"},{"path":"doc/c.md"}]}'
    listing = lambda flag: spark.createDataFrame([(tree % flag,)], "json string")
    assert [tuple(r) for r in tree_files(listing("false"), ["src/"], [".md"], "https://r").collect()] == [("src/a.md", "https://r/s1/src/a.md")]
    with pytest.raises(Exception, match="no file"):
        tree_files(listing("false"), ["none/"], [".md"], "https://r").collect()
    with pytest.raises(Exception, match="truncated"):
        tree_files(listing("true"), ["src/"], [".md"], "https://r").collect()


def test_addresses_of_a_table(spark):
    docs = spark.createDataFrame([("s", "a.md", "old"), ("none", "b.md", "old"), (None, None, "old")], "source string, doc string, url string")
    sources = [Source("s", "markdown", ".", "https://x/{page}"), Source("s", "markdown", ".", "https://y/{page}")]
    assert sorted((str(r.source), r.url) for r in addressed(docs, sources[:1]).collect()) == [("None", None), ("none", None), ("s", "https://x/a/")]
    assert addressed(docs, sources).count() == 3 and addressed(docs.limit(0), []).count() == 0


def test_download(spark):
    urls = listed_files(spark, "https://x/", ["a", "b"])
    rows = download(urls, lambda url: url.encode(), 2)
    assert {r.path: bytes(r.content) for r in rows.collect()} == {"a": b"https://x/a", "b": b"https://x/b"}
    assert tuple(corpus_size(rows).first()) == (2, 22 / 1e6) and provenance("source: x\n", "2026-01-01").endswith("fetched: 2026-01-01\n")
    with pytest.raises(ValueError, match="empty"):
        download(urls.limit(0))

    def fail(url):
        raise OSError("404")

    with pytest.raises(Exception, match="404"):
        download(urls, fail).collect()


CRAWL = """
[[crawl]]
name = "api"
kind = "index"
url = "https://d.org/html/annotated.html"
about = "source: d.org\\n"
[[crawl]]
name = "guide"
kind = "tree"
urls = ["https://d.org/tree.json"]
prefixes = ["src/"]
suffixes = [".md"]
raw = "https://raw.d.org"
[[crawl]]
name = "pdf"
kind = "files"
base = "https://d.org/"
paths = ["manual.pdf"]
"""


def test_crawl_builds_its_lists(spark, tmp_path):
    (tmp_path / "crawl.toml").write_text(CRAWL)
    web = {
        "https://d.org/html/annotated.html": '<a href="classA.html"><a href="index.html">', "https://d.org/html/classA.html": "A", "https://d.org/manual.pdf": "%PDF",
        "https://d.org/tree.json": '{"sha":"s","truncated":false,"tree":[{"path":"src/a.md"},{"path":"doc/b.md"}]}', "https://raw.d.org/s/src/a.md": "# A",
    }
    call = lambda *args: run(build_parser().parse_args(["--root", str(tmp_path), "crawl", *args]), spark, lambda url: web[url].encode())
    assert call().split("\n") == ["api: 1 files, 0.0 MB", "guide: 1 files, 0.0 MB", "pdf: 1 files, 0.0 MB"]
    assert {r.path: bytes(r.content) for r in spark.read.parquet(f"{tmp_path}/data/raw/guide").collect()} == {"src/a.md": b"# A"}
    assert (tmp_path / "data/raw/api.SOURCE.txt").read_text().startswith("source: d.org\nfetched: ")
    assert call("--source", "pdf").startswith("pdf")
    with pytest.raises(ValueError, match="unknown"):
        call("--source", "none")
    with pytest.raises(ValueError, match="kind"):
        listed(spark, {"kind": "else"})


def test_transfers_are_tried_again(monkeypatch):
    tries = []

    def broken(url, timeout):
        tries.append(timeout)
        raise OSError("down")

    monkeypatch.setattr("urllib.request.urlopen", broken)
    with pytest.raises(OSError):
        fetch_url("https://x")
    assert tries == [20] * 4


def test_paged_sources_on_the_command_line(spark, tmp_path):
    (tmp_path / "sources.toml").write_text('[[source]]\nname = "m"\nformat = "pdf"\npath = "m.pdf"\nurl = "https://x.org/m.pdf"\nexclude = ["old*"]\n')
    call = lambda: run(build_parser().parse_args(["--root", str(tmp_path), "parse"]), spark)
    with pytest.raises(FileNotFoundError, match="m: missing"):
        call()
    rows = [("m.pdf", "h", None, 1, "# One\ntext"), ("m.pdf", "h", None, 2, "more"), ("old.pdf", "o", None, 1, "gone")]
    spark.createDataFrame(rows, "doc string, sha256 string, title string, page int, text string").write.parquet(f"{tmp_path}/data/pages/m")
    assert call().startswith("m: 1 docs, 2 sections")
    audit = {r.doc: (r.status, r.sections, r.patterns) for r in spark.read.parquet(f"{tmp_path}/data/parsed/audit").collect()}
    assert audit == {"m.pdf": ("parsed", 2, None), "old.pdf": ("excluded", 0, ["old*"])}
    optional = Source("n", "pdf", "n", "u", optional=True)
    with pytest.warns(UserWarning):
        pages, audit = scan_pages(spark, optional, f"{tmp_path}/data/pages/n")
    assert pages.count() == 0 and audit.first().status == "missing_optional"


def test_command_line(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/guide.md").write_text("# Guide\n" + "The mesh is refined. " * 30 + "\n## Solver\n" + "Call the solver. " * 30)
    (tmp_path / "sources.toml").write_text('[[source]]\nname = "web"\nformat = "markdown"\npath = "raw"\nurl = "https://x.org/{page}"\n')
    assert select_sources(read_sources(tmp_path / "sources.toml"), ["web"])[0].directory_style
    with pytest.raises(ValueError):
        select_sources([], ["none"])
    call = lambda *args: run(build_parser().parse_args(["--root", str(tmp_path), *args]), spark)
    assert call("parse").startswith("web: 1 docs, 2 sections")
    folder = call("chunk", "--size", "500", "--min-size", "100")
    assert call("chunk", "--strategy", "recursive", "--size", "300", "--overlap", "50") != folder
    with pytest.raises(ValueError, match="tokenizer"):
        call("chunk", "--unit", "tokens")
    assert '"status": "complete"' in call("index", "--input", folder, "--collection", f"{tmp_path}/c")
    assert "https://x.org/guide/" in call("retrieve", "how do I call the solver", "--collection", f"{tmp_path}/c", "--top-k", "1")
    defaults = build_parser().parse_args(["chunk"])
    assert (defaults.strategy, defaults.size, defaults.overlap, defaults.min_size, defaults.unit) == ("structured", 1200, 150, 300, "characters")
