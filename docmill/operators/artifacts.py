"""Artifacts of the stages: tables with manifests that bind them together.

Tables are written by Spark's commit protocol and the manifest last, so a
manifest never names data that is not there; its fingerprints detect a table
that was changed afterwards.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill import __version__
from docmill.functions.expressions import is_blank
from docmill.functions.identity import fingerprint, table_fingerprint
from docmill.operators.chunking import length_statistics
from docmill.operators.sections import corpus_identity, source_summary
from docmill.schemas import CHUNK, SCHEMA_VERSION, SECTION
from docmill.sources.config import Source

MANIFEST = "manifest.json"


def _path(spark: SparkSession, name: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, name: str) -> bool:
    fs, path = _path(spark, name)
    return fs.exists(path)


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder of a few."""
    fs, path = _path(spark, folder)
    return [entry.getPath().getName() for entry in fs.listStatus(path)]


def write_text(spark: SparkSession, name: str, text: str) -> None:
    """Write a small file beside its place and move it there in one step."""
    fs, path = _path(spark, name)
    _, temporary = _path(spark, f"{name}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(temporary, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if not fs.rename(temporary, path):
        fs.delete(path, False)
        if not fs.rename(temporary, path):
            raise OSError(f"cannot write {name}")


def read_text(spark: SparkSession, name: str) -> str:
    fs, path = _path(spark, name)
    stream = fs.open(path)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def write_json(spark: SparkSession, name: str, value: object) -> None:
    write_text(spark, name, json.dumps(value, indent=2, ensure_ascii=False) + "\n")


def read_json(spark: SparkSession, name: str) -> dict:
    return json.loads(read_text(spark, name))


def write_jsonl(df: DataFrame, folder: str) -> None:
    """JSON Lines with null fields kept, UTF-8, one file per task."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(folder)


def read_jsonl(spark: SparkSession, folder: str, schema) -> DataFrame:  # noqa: ANN001
    """JSON Lines under a declared schema; only line feeds end a record. A malformed line fails the read."""
    return spark.read.schema(schema).option("lineSep", "\n").option("mode", "FAILFAST").json(folder)


def write_parsed(sections: DataFrame, audit: DataFrame, sources: list[Source], folder: str) -> dict:
    """Sections partitioned by source, the audit, then the manifest. An empty corpus raises."""
    spark = sections.sparkSession
    data = f"{folder}/sections"
    sections.withColumn("partition_source", F.col("metadata.source")).write.mode("overwrite").partitionBy("partition_source").parquet(data)
    audit.write.mode("overwrite").parquet(f"{folder}/audit")
    written = spark.read.parquet(data)
    summary = [r.asDict() for r in source_summary(written).orderBy("source").collect()]
    if not summary:
        raise ValueError("nothing was parsed; check the sources")
    manifest = {
        "schema_version": SCHEMA_VERSION, "engine": __version__, "corpus_id": corpus_identity(sources, spark.read.parquet(f"{folder}/audit")),
        "configuration": {"sources": [s.describe() for s in sources]}, "outputs": summary, "fingerprint": table_fingerprint(written.select(*SECTION.names)),
    }
    write_json(spark, f"{folder}/{MANIFEST}", manifest)
    return manifest


def load_parsed(spark: SparkSession, folder: str, sources: list[Source] | None = None) -> tuple[DataFrame, dict]:
    """Sections and manifest after all integrity checks; any mismatch raises ``ValueError``."""
    if not exists(spark, f"{folder}/{MANIFEST}"):
        raise ValueError("the parsed manifest is missing; parse first")
    manifest = read_json(spark, f"{folder}/{MANIFEST}")
    if manifest.get("schema_version") != SCHEMA_VERSION:
        raise ValueError("unsupported schema version; parse again")
    if sources is not None and [s.describe() for s in sources] != manifest["configuration"]["sources"]:
        raise ValueError("the sources changed since parsing; parse again")
    sections = spark.read.parquet(f"{folder}/sections").select(*SECTION.names)
    if table_fingerprint(sections) != manifest["fingerprint"]:
        raise ValueError("parsed sections changed; parse again")
    if not manifest["outputs"]:
        raise ValueError("no parsed sections")
    return sections, manifest


def write_chunks(chunks: DataFrame, folder: str, corpus_id: str, configuration: dict, length=None) -> dict:  # noqa: ANN001
    """Chunks and their manifest. The folder is named by the caller; the manifest holds the run id."""
    spark = chunks.sparkSession
    chunks.write.mode("overwrite").parquet(f"{folder}/chunks")
    written = spark.read.parquet(f"{folder}/chunks")
    lengths = length_statistics(written, length).first()
    if not lengths.chunks:
        raise ValueError("no chunks were made; check the parsed content")
    run = {"corpus_id": corpus_id, "configuration": configuration}
    manifest = {
        "schema_version": SCHEMA_VERSION, "run_id": fingerprint(run)[:16], **run, "file": "chunks", "sha256": table_fingerprint(written), "chunks": lengths.chunks,
        "lengths": {"median": lengths.median, "max": lengths.max},
    }
    write_json(spark, f"{folder}/{MANIFEST}", manifest)
    return manifest


def chunk_violations(chunks: DataFrame) -> DataFrame:
    """``(problem, rows)``: records without id, text or metadata, and repeated ids. No rows means valid."""
    problem = F.when(F.col("id").isNull() | (F.col("id") == ""), "id").when(F.col("text").isNull() | is_blank(F.col("text")), "text").when(F.col("metadata").isNull(), "metadata")
    single = chunks.select(problem.alias("problem")).filter("problem IS NOT NULL").groupBy("problem").agg(F.count(F.lit(1)).alias("rows"))
    repeated = chunks.filter("id IS NOT NULL").groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").agg(F.sum("n").alias("rows")).filter("rows > 0")
    return single.unionByName(repeated.select(F.lit("duplicate").alias("problem"), "rows"))


def load_chunks(spark: SparkSession, folder: str) -> tuple[DataFrame, dict]:
    """Chunks and manifest after all checks; any mismatch or invalid record raises ``ValueError``."""
    if not exists(spark, f"{folder}/{MANIFEST}"):
        raise ValueError("the chunk manifest is missing")
    manifest = read_json(spark, f"{folder}/{MANIFEST}")
    chunks = spark.read.schema(CHUNK).parquet(f"{folder}/{manifest.get('file')}")
    if manifest.get("schema_version") != SCHEMA_VERSION or manifest.get("sha256") != table_fingerprint(chunks):
        raise ValueError("chunk manifest, schema or data do not match")
    bad = chunk_violations(chunks).collect()
    if bad:
        raise ValueError(f"invalid chunks: {', '.join(f'{r.problem} ({r.rows})' for r in bad)}")
    if not manifest.get("chunks") or manifest["chunks"] != chunks.count():
        raise ValueError("the chunk count does not match or the artifact is empty")
    return chunks, manifest
