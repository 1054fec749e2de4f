"""Continuous indexing: documents that arrive as files are added to an index batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rankweave.operators.index import FIELDS, append_documents

DOC_SCHEMA = "docid string, url string, title string, body string"


def index_new_files(spark: SparkSession, source: str, index_path: str, state_path: str,
                    fields: tuple[str, ...] = FIELDS, stem: bool = False, files_per_batch: int | None = None,
                    name: str = "stream") -> StreamingQuery:
    """Add the Parquet files of `source` that were not seen yet, then stop.

    `state_path` holds the progress. A batch that is repeated after a failure replaces its own rows, so every
    document is indexed once.
    """
    reader = spark.readStream.schema(DOC_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def add(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read several times below
        try:
            append_documents(index_path, batch, f"{name}-{batch_id}", fields, stem)
        finally:
            batch.unpersist()

    return (
        reader.parquet(source)
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", state_path)
        .trigger(availableNow=True)
        .start()
    )
