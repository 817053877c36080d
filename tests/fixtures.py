"""Fixtures of the core tests."""

from docmill.schemas import SECTION


def section(doc, i, text, headings=(), title="Title", page=None):
    return {
        "source": "s", "doc": doc, "position": i, "id": f"s/{doc}@0#k:{i}", "text": text, "title": title, "headings": list(headings), "url": f"https://x.org/{doc}", "page": page,
        "document_sha256": None, "source_span": None,
    }


def to_table(spark, rows):
    data = [(r["id"], r["text"], (r["source"], r["doc"], r["title"], r["headings"], r["url"], r["page"], None, None, None, None)) for r in rows]
    return spark.createDataFrame(data, SECTION)
