"""Finding and reading the files of configured sources."""

from __future__ import annotations

import warnings
from functools import reduce
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.functions.expressions import matching_globs
from docmill.schemas import AUDIT
from docmill.sources.config import FORMATS, Source


def _filesystem(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def _missing(spark: SparkSession, source: Source, full: str) -> DataFrame:
    """Audit row of an optional source that is not there; a required one raises."""
    if not source.optional:
        raise FileNotFoundError(f"{source.name}: missing source: {full}")
    warnings.warn(f"{source.name}: optional source missing: {full}", stacklevel=3)
    return spark.createDataFrame([(source.name, None, "missing_optional", 0, False, None, None, None)], AUDIT)


PAGES = "source string, doc string, sha256 string, title string, page int, text string"


def scan_pages(spark: SparkSession, source: Source, folder: str) -> tuple[DataFrame, DataFrame]:
    """``(pages, audit)`` of a paged source whose page texts (or positioned lines) are a Parquet table in ``folder``.

    Documents that the source excludes are left out and audited. A missing
    table, or one without pages, raises unless the source is optional.
    """
    fs, path = _filesystem(spark, folder)
    if not fs.exists(path):
        return spark.createDataFrame([], PAGES), _missing(spark, source, folder)
    matched = spark.read.parquet(folder).withColumn("source", F.lit(source.name)).withColumn("__patterns", matching_globs(F.col("doc"), source.exclude))
    kept = matched.filter(F.size("__patterns") == 0).drop("__patterns")
    if not source.optional and kept.select("doc").isEmpty():
        raise FileNotFoundError(f"{source.name}: no pages under {folder}")
    return kept, _excluded(matched.filter(F.size("__patterns") > 0).select("source", "doc", F.col("__patterns").alias("patterns")).distinct())


def _excluded(rows: DataFrame) -> DataFrame:
    """Audit rows of excluded documents ``(source, doc, patterns)``."""
    return rows.select(
        "source", "doc", F.lit("excluded").alias("status"), F.lit(0).alias("sections"), F.lit(False).alias("empty"), F.lit(None).cast("string").alias("sha256"), F.lit(None).cast("int").alias("replacement_characters"), "patterns"
    )


def scan_source(spark: SparkSession, source: Source, root: str) -> tuple[DataFrame, DataFrame]:
    """``(documents, audit)`` of one source.

    ``documents`` has ``source, doc, content``; ``doc`` is the path below the
    source's path. Suffix and exclusion are decided on the path, so the content
    of a file that is left out is never read. ``audit`` lists excluded files
    with the patterns that matched. A missing path raises unless the source is
    optional, which warns and reports ``missing_optional``. Files whose names
    start with ``_`` or ``.`` are not seen.
    """
    full = source.path if urlparse(source.path).scheme or source.path.startswith("/") else f"{root.rstrip('/')}/{source.path}"
    fs, path = _filesystem(spark, full)
    if not fs.exists(path):
        return spark.createDataFrame([], "source string, doc string, content binary"), _missing(spark, source, full)
    base = fs.resolvePath(path).toUri().getPath()
    single = fs.getFileStatus(path).isFile()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(full)
    location = F.regexp_replace("path", "^[a-z0-9]+:/*(?=/)", "")
    doc = F.element_at(F.split(location, "/"), -1) if single else F.substring(location, len(base.rstrip("/")) + 2, 1 << 20)
    named = files.withColumn("doc", doc)
    if not single or source.format == "code":
        suffixes = "|".join(s.replace(".", r"\.") for s in FORMATS[source.format])
        named = named.filter(F.col("doc").rlike(rf"({suffixes})$"))
    matched = named.withColumn("patterns", matching_globs(F.col("doc"), source.exclude))
    kept = matched.filter(F.size("patterns") == 0).select(F.lit(source.name).alias("source"), "doc", "content")
    excluded = _excluded(matched.filter(F.size("patterns") > 0).select(F.lit(source.name).alias("source"), "doc", "patterns"))
    if not source.optional and kept.drop("content").isEmpty():
        raise FileNotFoundError(f"{source.name}: no {source.format} files under {full}")
    return kept, excluded


def scan_sources(spark: SparkSession, sources: list[Source], root: str) -> tuple[DataFrame, DataFrame]:
    """Documents and audit of all sources (see :func:`scan_source`)."""
    if not sources:
        raise ValueError("no sources configured")
    parts = [scan_source(spark, s, root) for s in sources]
    return tuple(reduce(DataFrame.unionByName, group) for group in zip(*parts))


def exclusion_report(documents: DataFrame, sources: DataFrame) -> DataFrame:
    """``(source, doc, patterns)`` of the documents that their source's ``exclude`` globs match.

    Works on tables alone: ``documents`` has ``source, doc``; ``sources`` has
    ``name, exclude``. Globs turn into patterns inside the JVM, so the table of
    sources may have any size. Nulls match nothing.
    """
    escaped = F.regexp_replace(F.col("glob"), r"([.\\+^$(){}|\[\]])", r"\\$1")
    pattern = F.concat(F.lit("^(?s)"), F.regexp_replace(F.regexp_replace(escaped, r"\*", ".*"), r"\?", "."), F.lit("$"))
    globs = sources.select(F.col("name").alias("source"), F.explode("exclude").alias("glob")).withColumn("pattern", pattern)
    hits = documents.select("source", "doc").join(globs, "source").filter(F.expr("doc rlike pattern"))
    return hits.groupBy("source", "doc").agg(F.array_sort(F.collect_set("glob")).alias("patterns"))
