"""Session-level helpers: shipping the package to workers and cutting lineage.

Lineage is cut by writing a Parquet table into the shared folder that the
cluster names in ``spark.checkpoint.dir``, so a lost executor never loses the
only copy of an intermediate result and later readers prune its columns.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
_OWN_DIR: dict[str, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    handle, target = tempfile.mkstemp(prefix="docmill-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(target, "w") as bundle:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    bundle.write(path, os.path.join("docmill", os.path.relpath(path, root)))
    spark.sparkContext.addPyFile(target)
    # Executors fetch it as they start, so it stays until the driver ends.
    atexit.register(lambda: os.path.exists(target) and os.remove(target))
    _SHIPPED.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables.

    ``spark.checkpoint.dir`` of the session wins. Only where it is unset (tests
    on one machine) a temporary folder is made; a cluster master without the
    setting is refused because its executors could not share such a folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIR:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _OWN_DIR[app] = "file://" + tempfile.mkdtemp(prefix="docmill-shared-")
    return _OWN_DIR[app]


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of what was written.

    The table is removed when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session is gone; the folder belongs to the cluster
        pass


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`materialize` before exit."""
    for path in {os.path.dirname(name) for name in df.inputFiles()}:
        _remove(df.sparkSession, path)


def tasks_for(rows: int, rows_per_task: int, least: int = 1) -> int:
    """Number of tasks so that each holds about ``rows_per_task`` rows."""
    return max(least, -(-rows // rows_per_task))
