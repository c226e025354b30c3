"""Time stamps rendered in the store's zone (H-18, P-19).

Inputs are UTC wall-clock ``timestamp_ntz`` columns (capture time), so the
results do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import FILE_NAME_OFFSET, STORE_TZ


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utc_now_ntz() -> Column:
    """Current time as UTC wall clock (one value per query / micro-batch)."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())


def local_ntz(ts_utc, tz: str = STORE_TZ) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _col(ts_utc))


def scrape_day(ts_utc, tz: str = STORE_TZ) -> Column:
    """H-18: calendar day of the capture time in the store's zone."""
    return F.to_date(local_ntz(ts_utc, tz))


def file_name_day(ts_utc, offset: str = FILE_NAME_OFFSET) -> Column:
    """Day used in output file names: a fixed offset, not the zone rules."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(offset), _col(ts_utc)))


def iso_local_text(ts_utc, tz: str = STORE_TZ) -> Column:
    """P-19 text form: ``2024-01-01T19:00:07.179575-05:00``.

    Like an ISO formatter, the fraction is left out when it is zero.
    """
    ts = _col(ts_utc)
    local = local_ntz(ts, tz)
    offset_min = F.timestamp_diff("MINUTE", ts, local)
    sign = F.when(offset_min < 0, F.lit("-")).otherwise(F.lit("+"))
    off_abs = F.abs(offset_min)
    offset = F.concat(
        sign,
        F.lpad((off_abs / 60).cast("int").cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((off_abs % 60).cast("string"), 2, "0"),
    )
    micros = F.date_format(local, "SSSSSS")
    body = F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(F.lit(""))
    return F.concat(body, frac, offset)


def processing_time_text(tz: str = STORE_TZ) -> Column:
    return iso_local_text(utc_now_ntz(), tz)
