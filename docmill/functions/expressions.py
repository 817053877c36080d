"""Native expressions of the reference operators: no text leaves the JVM."""

from __future__ import annotations

import fnmatch

from pyspark.sql import Column
from pyspark.sql import functions as F

# Line separators, and white space as a strip sees it.
LINE_SEPARATORS = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\u0085\\u2028\\u2029]"
SPACE = "[\\s\\u001c-\\u001f\\u0085\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"


def strip(text: Column) -> Column:
    """``text`` without Unicode white space at the ends."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def is_blank(text: Column) -> Column:
    """Whether there is nothing but Unicode white space; stops at the first other character."""
    return ~text.rlike(f"[^{SPACE[1:]}")


def glob_pattern(glob: str) -> str:
    """A shell glob as a Java pattern; ``*`` also crosses ``/``."""
    pattern = fnmatch.translate(glob)
    return pattern.replace(r"\Z", r"\z")


def matching_globs(path: Column, globs: list[str]) -> Column:
    """The globs that match ``path``, in their order."""
    if not globs:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*(F.when(path.rlike(f"^{glob_pattern(g)}"), F.lit(g)) for g in globs)))


def page_path(doc: Column) -> Column:
    """Directory-style address: ``a/b.md`` to ``a/b/``, ``x/index.*`` to ``x/``, ``index.*`` to nothing."""
    stem = F.regexp_replace(doc, r"(?<=[^/])\.[^./]+$", "")
    return F.when((stem == "index") | stem.endswith("/index"), F.regexp_replace(stem, "index$", "")).otherwise(F.concat(stem, F.lit("/")))


def document_url(template: Column, doc: Column) -> Column:
    """``template`` with ``{path}`` and ``{page}`` filled in."""
    return F.replace(F.replace(template, F.lit("{path}"), doc), F.lit("{page}"), page_path(doc))


def heading_text(raw: Column) -> Column:
    """A heading without emphasis and inline tags; only a wholly italic one loses its single stars."""
    plain = strip(F.regexp_replace(raw, r"\*\*|`|</?(?:span|em|strong|b|i)(?:\s[^>]*)?>", ""))
    return F.regexp_replace(plain, r"^\*(.+)\*$", "$1")


def headings_of(levels: list[Column]) -> Column:
    """Heading texts of the six levels in order, missing ones left out."""
    return F.array_compact(F.array(*(heading_text(level) for level in levels)))


def vector_problem(vector: Column, dim: int) -> Column:
    """Why a vector cannot be used for cosine search (``null``, ``dimension``, ``non-finite``, ``zero``), or null."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return (
        F.when(vector.isNull(), "null").when(F.size(vector) != dim, "dimension").when(~finite, "non-finite").when(~F.exists(vector, lambda x: x != 0), "zero")
    )


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def citations(metadata: Column) -> Column:
    """Locations of a chunk, or one made of its url and page where it has none."""
    single = F.array(
        F.struct(
            F.lit(None).cast("string").alias("section_id"), metadata["url"].alias("url"), metadata["page"].alias("page"), F.lit(None).cast("string").alias("document_sha256"),
            F.lit(None).cast("array<int>").alias("source_span"), F.lit(None).cast("array<int>").alias("section_span"),
        )
    )
    return F.when(F.size(F.coalesce(metadata["locations"], F.array())) > 0, metadata["locations"]).otherwise(single)


def keeps_reference_page(name: Column) -> Column:
    """Whether a listed page is API reference: class, struct or namespace pages without member indexes."""
    wanted = name.endswith(".html") & (name.startswith("class") | name.startswith("struct") | name.startswith("namespace"))
    return wanted & ~name.endswith("-members.html") & ~name.startswith("namespacemembers_")


def links_in(html: Column) -> Column:
    """Distinct targets of ``href="..."``, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(html, F.lit('href="([^"]+)"'), F.lit(1))))
