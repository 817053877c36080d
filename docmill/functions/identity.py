"""Deterministic identities: fingerprints, file hashes and name-based UUIDs."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POINT_PREFIX = "docmill:chunk:"


def canonical_json(value: object) -> str:
    """JSON with sorted keys, non-ASCII characters kept and the usual separators."""
    return json.dumps(value, sort_keys=True, ensure_ascii=False)


def fingerprint(value: object) -> str:
    """SHA-256 of the canonical JSON of a driver-side value."""
    return hashlib.sha256(canonical_json(value).encode("utf-8", "surrogatepass")).hexdigest()


def content_hash(column: Column) -> Column:
    """SHA-256 of a binary or string column."""
    return F.sha2(column.cast("binary"), 256)


def uuid5(namespace: uuid.UUID, name: Column) -> Column:
    """Version 5 UUID of ``name`` as text, without leaving the JVM."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"), F.substring(digest, 9, 4), F.lit("-5"), F.substring(digest, 14, 3), F.lit("-"), variant, F.substring(digest, 18, 3), F.lit("-"), F.substring(digest, 21, 12)
    )


def point_id(chunk_id: Column, prefix: str = POINT_PREFIX) -> Column:
    """Id of the point that holds a chunk; ``prefix`` names the engine that made it."""
    return uuid5(uuid.NAMESPACE_URL, F.concat(F.lit(prefix), chunk_id))


def table_fingerprint(df: DataFrame) -> str:
    """Identity of the rows of a table, whatever their order and partitioning.

    One aggregation over 128 bits of hash per row: sums are exact, so equal
    tables have equal fingerprints and repeated rows count as often as they occur.
    """
    text = F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]), {"ignoreNullFields": "false"})
    digest = F.sha2(text, 256)
    parts = [F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(38,0)") for at in (1, 16)]
    row = df.select(*(p.alias(f"p{k}") for k, p in enumerate(parts))).agg(F.count(F.lit(1)).alias("n"), F.sum("p0").alias("a"), F.sum("p1").alias("b")).first()
    return fingerprint([row.n, str(row.a), str(row.b)])
