"""docmill: documentation ingestion, chunking, indexing and retrieval on Spark."""

__version__ = "0.1.0"
