"""Declared schemas of sections, chunks, points and collection state."""

from __future__ import annotations

from pyspark.sql import types as T

SCHEMA_VERSION = 2
STATE_VERSION = 1

_S, _I = T.StringType(), T.IntegerType()

SECTION_METADATA = T.StructType(
    [
        T.StructField("source", _S), T.StructField("doc", _S), T.StructField("title", _S), T.StructField("headings", T.ArrayType(_S)), T.StructField("url", _S),
        T.StructField("page", _I), T.StructField("document_sha256", _S), T.StructField("anchor", _S), T.StructField("source_span", T.ArrayType(_I)), T.StructField("span_unit", _S),
    ]
)
SECTION = T.StructType([T.StructField("id", _S), T.StructField("text", _S), T.StructField("metadata", SECTION_METADATA)])

LOCATION = T.StructType(
    [
        T.StructField("section_id", _S), T.StructField("url", _S), T.StructField("page", _I), T.StructField("document_sha256", _S),
        T.StructField("source_span", T.ArrayType(_I)), T.StructField("section_span", T.ArrayType(_I)),
    ]
)
CHUNK_CONFIGURATION = T.StructType(
    [
        T.StructField("schema_version", _I), T.StructField("strategy", _S), T.StructField("size", _I), T.StructField("overlap", _I), T.StructField("min_size", _I),
        T.StructField("budget", _S), T.StructField("chunker_sha256", _S), T.StructField("markdown_sha256", _S), T.StructField("libraries", T.MapType(_S, _S)),
    ]
)
CHUNK_METADATA = T.StructType(
    [
        T.StructField("source", _S), T.StructField("doc", _S), T.StructField("title", _S), T.StructField("headings", T.ArrayType(_S)), T.StructField("url", _S), T.StructField("page", _I),
        T.StructField("sections", T.ArrayType(_S)), T.StructField("locations", T.ArrayType(LOCATION)), T.StructField("strategy", _S),
        T.StructField("configuration", CHUNK_CONFIGURATION), T.StructField("artifact_id", _S),
    ]
)
CHUNK = T.StructType([T.StructField("id", _S), T.StructField("text", _S), T.StructField("body", _S), T.StructField("metadata", CHUNK_METADATA)])

AUDIT = T.StructType(
    [
        T.StructField("source", _S), T.StructField("doc", _S), T.StructField("status", _S), T.StructField("sections", _I), T.StructField("empty", T.BooleanType()),
        T.StructField("sha256", _S), T.StructField("replacement_characters", _I), T.StructField("patterns", T.ArrayType(_S)),
    ]
)
POINT = T.StructType([T.StructField("point_id", _S), T.StructField("vector", T.ArrayType(T.FloatType())), T.StructField("payload", CHUNK)])
#: Raw documents as the scan gives them; pages of paged formats carry a number.
RAW_DOCUMENT = T.StructType(
    [T.StructField("source", _S), T.StructField("doc", _S), T.StructField("content", T.BinaryType()), T.StructField("page", _I), T.StructField("page_text", _S), T.StructField("title", _S)]
)
