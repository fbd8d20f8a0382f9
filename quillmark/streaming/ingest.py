"""Incremental indexing (an addition): new documents of a folder are cleaned
and chunked as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import structure
from ..sources import corpus


def stream_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema("doc_id long, text string").parquet(path)


def index_stream(documents: DataFrame, target: str, checkpoint: str, depth: int = 4) -> StreamingQuery:
    """Chunks of each new document under ``target``; a repeated batch replaces its own output."""

    def batch(frame: DataFrame, number: int) -> None:
        structure.chunks(corpus.text_lines(frame), depth).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return documents.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
