"""Acquisition: choosing pages, fetching them and recording where they came from.

Fetching is pluggable: a fetcher takes a URL and returns bytes. Choosing works
on tables of listings and needs no network.
"""

from __future__ import annotations

import time
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.functions.expressions import keeps_reference_page, links_in

Fetcher = Callable[[str], bytes]
# Parallel transfers, seconds to connect and in all, retries.
PARALLEL, CONNECT, TIMEOUT, RETRIES = 16, 20, 180, 3
TREE = "struct<sha:string,truncated:boolean,tree:array<struct<path:string,type:string>>>"


def fetch_url(url: str) -> bytes:
    """Read a URL, trying again on failure; a transfer may stall for ``CONNECT`` seconds and last ``TIMEOUT``."""
    for attempt in range(RETRIES + 1):
        try:
            until = time.monotonic() + TIMEOUT
            with urllib.request.urlopen(url, timeout=CONNECT) as answer:  # noqa: S310
                parts = []
                while part := answer.read(1 << 16):
                    parts.append(part)
                    if time.monotonic() > until:
                        raise TimeoutError(f"{url}: more than {TIMEOUT} seconds")
                return b"".join(parts)
        except OSError:
            if attempt == RETRIES:
                raise
    raise AssertionError


def listed_pages(index: DataFrame, base: str) -> DataFrame:
    """``(page, url)`` of the reference pages that index pages (``html``) link to, distinct and in order."""
    names = index.select(F.explode(links_in(F.col("html"))).alias("page")).distinct()
    return names.filter(keeps_reference_page(F.col("page"))).select("page", F.concat(F.lit(base.rstrip("/") + "/"), "page").alias("url")).orderBy("page")


def tree_files(listing: DataFrame, prefixes: list[str], suffixes: list[str], raw_base: str) -> DataFrame:
    """``(path, url)`` of the files of repository listings (``json``) under a prefix and with a suffix.

    A truncated listing and an empty choice raise when the result is computed.
    """
    tree = listing.select(F.from_json("json", TREE).alias("t")).select("t.*")
    whole = tree.select("sha", "tree", F.when(F.coalesce("truncated", F.lit(False)), F.raise_error(F.lit("the repository listing is truncated"))).alias("checked")).filter(F.col("checked").isNull())
    paths = whole.select("sha", F.explode("tree.path").alias("path"))
    start = F.lit(False)
    for prefix in prefixes:
        start = start | F.col("path").startswith(prefix)
    end = F.lit(False)
    for suffix in suffixes:
        end = end | F.col("path").endswith(suffix)
    chosen = paths.filter(start & end).select("path", F.concat(F.lit(raw_base.rstrip("/") + "/"), "sha", F.lit("/"), "path").alias("url"))
    nothing = F.when(F.count(F.lit(1)) == 0, F.raise_error(F.lit("no file of the repository listing was chosen")))
    return chosen.unionByName(chosen.agg(nothing.alias("path")).filter("path IS NOT NULL").select(F.col("path").cast("string").alias("path"), F.lit(None).cast("string").alias("url")))


def listed_files(spark: SparkSession, base: str, paths: list[str]) -> DataFrame:
    """``(path, url)`` of a fixed list."""
    return spark.createDataFrame([(p, base + p) for p in paths], "path string, url string")


def listed(spark: SparkSession, wanted: dict, fetch: Fetcher = fetch_url) -> DataFrame:
    """``(path, url)`` of what one entry of a crawl file asks for.

    ``kind`` is ``index`` (reference pages that the page at ``url`` links to),
    ``tree`` (files of the repository listings at ``urls`` under ``prefixes``
    with ``suffixes``, to be had below ``raw``) or ``files`` (``paths`` below
    ``base``; a single PDF is such a list).
    """
    kind = wanted.get("kind")
    if kind == "index":
        page = spark.createDataFrame([(fetch(wanted["url"]).decode("utf-8", "replace"),)], "html string")
        return listed_pages(page, wanted["url"].rpartition("/")[0]).withColumnRenamed("page", "path")
    if kind == "tree":
        listing = spark.createDataFrame([(fetch(url).decode("utf-8"),) for url in wanted["urls"]], "json string")
        return tree_files(listing, wanted["prefixes"], wanted["suffixes"], wanted["raw"])
    if kind == "files":
        return listed_files(spark, wanted["base"], wanted["paths"])
    raise ValueError(f"unknown kind of crawl {kind!r}")


def download(urls: DataFrame, fetch: Fetcher = fetch_url, parallel: int = PARALLEL) -> DataFrame:
    """``(path, url, content, fetched_on)`` of every row; any failure fails the job, so no corpus is silently short.

    An empty list is refused.
    """
    if urls.isEmpty():
        raise ValueError("refusing an empty download list")

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, url in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([url]), pa.array([fetch(url)], pa.binary())], names=["path", "url", "content"])

    fetched = urls.select("path", "url").repartition(parallel).mapInArrow(get, "path string, url string, content binary")
    return fetched.withColumn("fetched_on", F.current_date().cast("string"))


def save_files(downloaded: DataFrame, folder: str) -> None:
    """Replace ``folder`` by the downloaded table; readers take ``path`` as document name."""
    downloaded.write.mode("overwrite").parquet(folder)


def provenance(body: str, day: str) -> str:
    return f"{body}fetched: {day}\n"


def corpus_size(files: DataFrame) -> DataFrame:
    """Number of files and megabytes of a table with ``content``."""
    return files.agg(F.count(F.lit(1)).alias("files"), (F.coalesce(F.sum(F.octet_length("content")), F.lit(0)) / 1e6).alias("megabytes"))
