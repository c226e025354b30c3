"""File-arrival streams (T-1, T-3).

``readStream`` over the landing folder -> each store's cleaner (by the file's
path) -> keyed upsert inside ``foreachBatch``. The query's checkpoint records
which files were taken (each new file is processed once); if a micro-batch is
retried after a failure, the upsert by a stable key makes the retry harmless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths
from ..operators import clean as C
from ..operators.dispatch import Cleaner, clean_dispatch
from ..operators.quality import Quality
from ..schemas import DEFAULT_UPSERT_KEY
from ..session import written_once
from ..sinks.upsert import write_upsert
from ..sources.listings import stream_listing_csv


def upsert_clean_rows(spark: SparkSession, good: DataFrame, table_path: str, keys: list[str] | None = None, batch_written: bool = False) -> None:
    """K-5 for clean listing rows of any store (batch or stream, same table layout).

    Per key the row that arrived last wins: by the file's time, then its name,
    then the position in it (columns that the rows do not have are left out).
    The table keeps the other columns, partitioned by store and day.
    """
    order = [c for c in ("file_time", "file", "pos") if c in good.columns]
    rows = good.withColumn("_seq", F.struct(*order)).drop(*order)
    write_upsert(spark, table_path, rows, keys or DEFAULT_UPSERT_KEY, "_seq", ["store", "scrap_date"], batch_written)


def clean_and_upsert_batch(
    spark: SparkSession,
    batch: DataFrame,
    table_path: str,
    rejects_path: str | None = None,
    keys: list[str] | None = None,
    batch_id: int = 0,
    registry: dict[str, Cleaner] | None = None,
    figures_path: str | None = None,
) -> None:
    """One micro-batch (or one batch run): clean by store, split, upsert, keep rejects.

    The cleaned batch is written once to a scratch folder, read for the upsert
    and the rejects, and deleted. Rejects go to the ``batch_id`` partition of
    ``rejects_path``, replaced as a whole, so a retried micro-batch does not
    write them twice. So do the batch's quality figures with ``figures_path``;
    they are collected by the one write of the cleaned batch.
    """
    keys = keys or DEFAULT_UPSERT_KEY
    quality = Quality() if figures_path else None
    # record id (stable hash of the key) and processing time (one per micro-batch)
    cleaned = C.with_record_meta(clean_dispatch(batch, registry, quality=quality), keys=keys)
    with written_once(cleaned, "clean-batch") as rows:
        good, bad = C.split_rejects(rows)
        upsert_clean_rows(spark, good, table_path, keys, batch_written=True)
        if rejects_path:
            _write_batch(bad.withColumn("source_file", paths.file_name("file")), batch_id, rejects_path)
        if quality:
            _write_batch(quality.rows(spark).coalesce(1), batch_id, figures_path)


def _write_batch(rows: DataFrame, batch_id: int, path: str) -> None:
    """The ``batch_id`` partition of a table, replaced as a whole."""
    rows = rows.withColumn("batch_id", F.lit(batch_id).cast("long"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def start_clean_upsert_stream(
    spark: SparkSession,
    landing_path: str,
    table_path: str,
    checkpoint_path: str,
    rejects_path: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    figures_path: str | None = None,
):
    """T-1: start the stream; returns the ``StreamingQuery``."""
    src = stream_listing_csv(spark, landing_path)

    def each(batch_df: DataFrame, epoch_id: int) -> None:
        clean_and_upsert_batch(batch_df.sparkSession, batch_df, table_path, rejects_path, batch_id=epoch_id, figures_path=figures_path)

    writer = src.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time or "1 minute")
    return writer.start()
