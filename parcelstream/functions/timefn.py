"""Time helpers as Column expressions (JVM-side, codegen-friendly).

One explicit zone is used both ways (local text <-> epoch millis); the
session zone is UTC and never influences a result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_TZ = "Asia/Shanghai"
EIGHT_HOURS_MS = 8 * 60 * 60 * 1000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def text_to_millis(s, full: bool = True, tz: str = DEFAULT_TZ) -> Column:
    """Local ``yyyy-MM-dd HH:mm:ss`` (or ``yyyy-MM-dd``) text -> epoch millis.
    Unparseable text gives null instead of failing the job."""
    fmt = F.lit("yyyy-MM-dd HH:mm:ss" if full else "yyyy-MM-dd")
    local = F.try_to_timestamp(_c(s), fmt)
    return F.unix_millis(F.to_utc_timestamp(local, tz))


def _local(ms, tz: str) -> Column:
    return F.from_utc_timestamp(F.timestamp_millis(_c(ms)), tz)


def millis_to_date(ms, tz: str = DEFAULT_TZ) -> Column:
    return F.date_format(_local(ms, tz), "yyyy-MM-dd")


def millis_to_partition_date(ms, tz: str = DEFAULT_TZ) -> Column:
    return F.date_format(_local(ms, tz), "yyyyMMdd")


def millis_to_ymd_hms(ms, tz: str = DEFAULT_TZ) -> Column:
    return F.date_format(_local(ms, tz), "yyyy-MM-dd HH:mm:ss")


def iso_to_millis(s) -> Column:
    """``2023-05-27T20:00:00Z`` -> epoch millis of that UTC instant."""
    return F.unix_millis(F.try_to_timestamp(_c(s), F.lit("yyyy-MM-dd'T'HH:mm:ssX")))


def iso_to_local_text(s, tz: str = DEFAULT_TZ) -> Column:
    """ISO UTC text -> local ``yyyy-MM-dd HH:mm:ss`` in ``tz``."""
    return millis_to_ymd_hms(iso_to_millis(s), tz)


def estimate_arrive_text(ms, tz: str = DEFAULT_TZ) -> Column:
    """Estimated arrival is stored eight hours ahead; shift back, then render."""
    return millis_to_ymd_hms(_c(ms) - F.lit(EIGHT_HOURS_MS), tz)
