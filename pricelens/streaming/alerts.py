"""Job failure notices (T-2): keep events whose type, source and status
equal the pattern and pass them to a sink (no message is sent)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import FAILURE_DETAIL_TYPE, FAILURE_SOURCE, FAILURE_STATUS


def failure_pattern(detail_type: str = FAILURE_DETAIL_TYPE, source: str = FAILURE_SOURCE, status: str = FAILURE_STATUS) -> Column:
    return (F.col("detail_type") == detail_type) & (F.col("source") == source) & (F.col("status") == status)


def failure_alerts(job_events: DataFrame, **pattern) -> DataFrame:
    """Works on a batch or a streaming DataFrame of job state events."""
    return job_events.filter(failure_pattern(**pattern))


def alerts_once(job_events: DataFrame, delay: str = "24 hours", key: str = "event_id", time_col: str = "ts", **pattern) -> DataFrame:
    """One notice per event, however often and in whatever order it is delivered.

    Events come at least once. State holds the key of every notice until the
    event time has moved on by ``delay``; a copy is dropped while the key is
    held, and afterwards because it is older than the watermark. ``delay`` must
    so cover the longest way of a first delivery (an event that first arrives
    later than that gives no notice). Rows without a key or time are no events.
    On a batch every key gives one notice as well.
    """
    alerts = failure_alerts(job_events, **pattern).where(F.col(key).isNotNull() & F.col(time_col).isNotNull())
    if not job_events.isStreaming:
        return alerts.dropDuplicates([key])
    event_time = "event_time"
    while event_time in alerts.columns:
        event_time += "_"
    timed = alerts.withColumn(event_time, F.col(time_col).cast("timestamp")).withWatermark(event_time, delay)
    return timed.dropDuplicatesWithinWatermark([key]).drop(event_time)


def start_alert_once_stream(job_events: DataFrame, out_path: str, checkpoint_path: str, delay: str = "24 hours", available_now: bool = True):
    """Append ``alerts_once`` to ``out_path``; state and sink survive a restart."""
    w = alerts_once(job_events, delay).writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint_path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.outputMode("append").start()


def start_alert_stream(job_events: DataFrame, out_path: str, checkpoint_path: str, available_now: bool = True):
    """Append failure notices to ``out_path`` (a file sink with a checkpoint)."""
    w = failure_alerts(job_events).writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint_path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.outputMode("append").start()
