"""Keeping an index current from a stream of upserts and deletes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gleaner.sources.index import latest
from gleaner.sources.store import IndexStore, stream_writer

VISIBLE_WITHIN = "1 second"


def read_changes(spark: SparkSession, path: str, schema, files_per_trigger: int = 100, **options) -> DataFrame:
    """A folder of change files as a stream."""
    return (
        spark.readStream.schema(schema).options(**options)
        .option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    )


def upsert_stream(
    changes: DataFrame, store: IndexStore, to_documents: Callable[[DataFrame], DataFrame], checkpoint: str,
    available_now: bool = False, with_postings: bool = True,
) -> StreamingQuery:
    """Append each micro-batch of changes to the store.

    ``to_documents`` builds document rows with ``version`` and ``op`` ("U" or "D").
    Each batch keeps the last write per document, and writes its own part under the
    name of the checkpoint, so a batch that runs twice leaves the same rows and no
    other stream or bulk load is overwritten.  An older version that arrives late
    loses against the stored one by its version; no watermark is needed.  Writing a batch touches its own partitions
    only, whatever the store holds.  ``changes`` in the query's progress tells each batch's rows.
    """

    writer_name = stream_writer(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        docs = latest(to_documents(batch)).withColumn("indexed_at", F.current_timestamp())
        if with_postings:
            store.append(docs, batch_id, unique=True, writer=writer_name)
        else:
            store.append_documents(docs, batch_id, unique=True, writer=writer_name)

    watched = changes.observe("changes", F.count(F.lit(1)).alias("rows"))
    writer = watched.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": VISIBLE_WITHIN}
    return writer.trigger(**trigger).start()
