"""Text expressions shared by the operators (all JVM-side), and the way a kernel over one text meets a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def each(df: DataFrame, kernel: Callable, inputs: list[str], out: str, kind: T.DataType) -> DataFrame:
    """``df`` without ``inputs``, with ``out``: what ``kernel`` makes of the inputs of each row.

    Columns come and go as Arrow batches; arrays reach the kernel as lists.
    """
    kept = [c for c in df.columns if c not in {*inputs, out}]
    source = df.select(*kept, *inputs)
    schema = T.StructType([*source.schema.fields[: len(kept)], T.StructField(out, kind)])
    made = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [kernel(*row) for row in zip(*(batch.column(name).to_pylist() for name in inputs))]
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in kept), pa.array(values, made)], names=[*kept, out])

    return source.mapInArrow(run, schema)


def primary_language(lang: Column) -> Column:
    """Primary subtag of a language tag in lower case; ``und`` where it is absent.

    ``en_GB``, ``EN`` and ``en-US`` all become ``en``; null, blank, ``und``,
    ``unknown``, ``none`` and ``null`` become ``und``.
    """
    tag = F.lower(F.trim(F.regexp_extract(F.coalesce(lang, F.lit("")), r"^\s*([A-Za-z]*)", 1)))
    return F.when(tag.isin("", "unknown", "none", "null"), "und").otherwise(tag)


def url_host(url: Column) -> Column:
    """Host of an absolute URL in lower case, without user, port and trailing dot; null if there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@\s]*@)?(\[[^\]]*\]|[^:/?#\s]+)", 1)
    host = F.lower(F.regexp_replace(host, r"\.$", ""))
    return F.when(host != "", host)
