"""Incremental ingestion with Structured Streaming.

* ``ingest_stream``: new manifest files are picked up by the file source; with
  ``trigger(availableNow=True)`` a re-run processes only files it has not seen (the source's
  log in the checkpoint remembers them), then stops.
* ``dedup_stream``: running duplicate removal by content hash.  Without a watermark the state
  keeps every hash ever seen (as the reference's in-memory set does, but spilled to the state
  store); with an event-time column, ``dropDuplicatesWithinWatermark`` bounds it.
* ``pending_stream``: every micro-batch is anti-joined with the *current* ledger (re-read per
  batch inside ``foreachBatch``) and written to a folder named by the batch id, so a replayed
  batch overwrites its own output instead of duplicating it.

Checkpoints must live in shared storage (``spark.checkpoint.dir`` or an explicit path).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", **options) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def ingest_stream(spark: SparkSession, path: str, schema, out: str, checkpoint: str, fmt: str = "csv",
                  transform: Callable[[DataFrame], DataFrame] | None = None, out_format: str = "parquet",
                  **options):
    """Process all files not yet seen under ``path`` and stop; returns the finished query."""
    df = read_stream(spark, path, schema, fmt, **options)
    if transform is not None:
        df = transform(df)
    q = (df.writeStream.format(out_format).option("checkpointLocation", checkpoint)
         .option("path", out).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def dedup_stream(df: DataFrame, col: str, watermark: tuple[str, str] | None = None) -> DataFrame:
    """Drop rows whose ``col`` was seen before (``watermark=(event_time_col, delay)`` bounds state)."""
    if watermark:
        ts, delay = watermark
        return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark([col])
    return df.dropDuplicates([col])


def dedup_increment(spark: SparkSession, path: str, schema, col: str, out: str, checkpoint: str, watermark: tuple[str, str] | None = None,
                    transform: Callable[[DataFrame], DataFrame] | None = None, **options):
    """Process the files not yet seen under ``path``, drop what was seen before, append to ``out`` and stop; returns the query.

    With a watermark, keys older than it leave the state and rows older than it are dropped as late; run again (after a stop
    or a loss), it goes on with the state of the checkpoint."""
    df = read_stream(spark, path, schema, **options)
    if transform is not None:
        df = transform(df)
    q = (dedup_stream(df, col, watermark).writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .option("path", out).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def state_rows(query) -> list[int]:
    """Rows in the state after each batch of a finished query."""
    return [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in query.recentProgress if p["stateOperators"]]


def pending_stream(df: DataFrame, ledger_loader: Callable[[], DataFrame], out: str, checkpoint: str,
                   on: str = "row_id", transform: Callable[[DataFrame], DataFrame] | None = None):
    """Write the rows of each micro-batch that are not done yet; returns the finished query."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        done = ledger_loader().select(F.col(on)).distinct()
        rows = batch.join(done, on, "left_anti")
        if transform is not None:
            rows = transform(rows)
        rows.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={batch_id}")

    q = (df.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
