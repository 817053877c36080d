"""Extension: incremental indexing of a folder of chunk files.

The reference is batch only. New files are read as a stream; each micro-batch
is embedded for the chunks that have no point yet, which makes a replayed batch
harmless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docmill.operators.embedding import BATCH_SIZE, EmbeddingProvider, embed_table
from docmill.operators.vindex import collection_points, missing_chunks
from docmill.schemas import CHUNK


def stream_chunks(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(CHUNK).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def index_stream(chunks: DataFrame, folder: str, provider: EmbeddingProvider, checkpoint: str, batch_size: int = BATCH_SIZE, once: bool = True) -> StreamingQuery:
    """Append a point for every new chunk of the stream; repeated ids count once."""

    def add(batch: DataFrame, _: int) -> None:
        fresh = missing_chunks(collection_points(batch.sparkSession, folder), batch.dropDuplicates(["id"]))
        points = embed_table(fresh.select("point_id", "text", F.struct("id", "text", "body", "metadata").alias("payload")), provider, batch_size)
        points.select("point_id", "vector", "payload").write.mode("append").parquet(f"{folder}/points")

    writer = chunks.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
