"""Source descriptions: reading, checking and addressing them."""

from __future__ import annotations

import tomllib
from dataclasses import asdict, dataclass, field, fields
from pathlib import Path, PurePosixPath

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.functions.expressions import document_url

# Formats and the suffixes they read (None: every file).
FORMATS = {"html": (".html",), "markdown": (".md",), "pdf": (".pdf",), "code": (".cpp", ".hpp", ".opts")}
MAX_SOURCES = 100_000


@dataclass(frozen=True)
class Source:
    """One configured source. ``path`` is a file or a folder, ``url`` a template with ``{path}`` or ``{page}``."""

    name: str
    format: str
    path: str
    url: str
    content: str | None = None
    drop: list[str] = field(default_factory=list)
    flatten: list[str] = field(default_factory=list)
    margins: list[int] = field(default_factory=lambda: [0, 0, 0, 0])
    exclude: list[str] = field(default_factory=list)
    optional: bool = False

    def __post_init__(self) -> None:
        if self.format not in FORMATS:
            raise ValueError(f"{self.name}: unsupported format {self.format!r}")

    @property
    def directory_style(self) -> bool:
        """Whether pages are addressed by directory, as ``{page}`` does."""
        return "{page}" in self.url

    def describe(self) -> dict:
        return asdict(self)


def source_from(values: dict) -> Source:
    known = {f.name for f in fields(Source)}
    return Source(**{k: v for k, v in values.items() if k in known and v is not None})


def read_sources(path: str | Path) -> list[Source]:
    """The ``[[source]]`` tables of a TOML file."""
    with open(path, "rb") as stream:
        return [source_from(entry) for entry in tomllib.load(stream)["source"]]


def sources_of(table: DataFrame, names: list[str] | None = None) -> list[Source]:
    """Sources from a table with the same fields; ``names`` selects some. Rows without a name are ignored."""
    rows = table.filter("name IS NOT NULL")
    if names is not None:
        rows = rows.filter(rows["name"].isin(names))
    found = rows.orderBy("name").limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    return [source_from(r.asDict()) for r in found]


def select_sources(sources: list[Source], names: list[str] | None) -> list[Source]:
    """All sources, or those named; an unknown name raises."""
    if not names:
        return sources
    known = {s.name: s for s in sources}
    missing = [n for n in names if n not in known]
    if missing:
        raise ValueError(f"unknown source {missing[0]!r}")
    return [known[n] for n in dict.fromkeys(names)]


def addressed(documents: DataFrame, sources: list[Source]) -> DataFrame:
    """``documents`` (``source, doc``, others kept) with ``url``, null where the source is not among ``sources``.

    The table of sources has ``MAX_SOURCES`` rows at most and is broadcast.
    """
    if len(sources) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    templates = documents.sparkSession.createDataFrame([(s.name, s.url) for s in sources], "source string, template string")
    joined = documents.drop("url").join(F.broadcast(templates.dropDuplicates(["source"])), "source", "left")
    return joined.withColumn("url", document_url(F.col("template"), F.col("doc"))).drop("template")


def document_address(template: str, doc: str) -> str:
    """``template`` with the path of ``doc`` or its directory-style address."""
    path = PurePosixPath(doc)
    stem = path.with_suffix("").as_posix() if path.suffix else doc
    page = stem[: -len("index")] if PurePosixPath(stem).name == "index" else stem + "/"
    return template.replace("{path}", doc).replace("{page}", page)
