"""Wall-clock columns from epoch milliseconds.

Everything is TIMESTAMP_NTZ arithmetic, so results do not depend on the
session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "Asia/Shanghai"
SECOND_MS = 1_000
MINUTE_MS = 60_000
HOUR_MS = 3_600_000
DAY_MS = 86_400_000


def floor_ms(ms: Column, width_ms: int) -> Column:
    """Start of the bucket of ``width_ms`` that holds ``ms`` (UTC aligned)."""
    return ms - F.pmod(ms, F.lit(width_ms))


def bucket(ms: Column, width_ms: int) -> Column:
    """Number of the bucket of ``width_ms`` that holds ``ms``."""
    return F.call_function("div", floor_ms(ms, width_ms), F.lit(width_ms))


def wall_clock(ms: Column) -> Column:
    """Epoch milliseconds as local TIMESTAMP_NTZ."""
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return F.convert_timezone(
        F.lit("UTC"), F.lit(ZONE), F.timestamp_add("MILLISECOND", ms, epoch)
    )


def stat_date(ms: Column) -> Column:
    return wall_clock(ms).cast("date")


def stat_minute(ms: Column) -> Column:
    return wall_clock(floor_ms(ms, MINUTE_MS))


def stat_hour(ms: Column) -> Column:
    return F.hour(wall_clock(ms))


def clock_text(ms: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSS`` text of the local wall clock."""
    return F.concat(
        clock_text_seconds(ms), F.lit("."), F.lpad(F.pmod(ms, F.lit(1000)).cast("string"), 3, "0")
    )


def clock_text_seconds(ms: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of the local wall clock."""
    return F.substring(wall_clock(floor_ms(ms, SECOND_MS)).cast("string"), 1, 19)


def ntz_to_ms(ts: Column) -> Column:
    """TIMESTAMP_NTZ read as UTC, to epoch milliseconds."""
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    seconds = F.extract(F.lit("SECOND"), ts)
    return (
        days * DAY_MS
        + F.hour(ts).cast("long") * HOUR_MS
        + F.minute(ts).cast("long") * MINUTE_MS
        + F.floor(seconds * 1000).cast("long")
    )


def wall_to_ms(ts: Column) -> Column:
    """Local TIMESTAMP_NTZ, as stored in the tables, back to epoch milliseconds."""
    return ntz_to_ms(F.convert_timezone(F.lit(ZONE), F.lit("UTC"), ts))


def since(ms: Column, now_ms: int, hours: int) -> Column:
    """Predicate: in the last ``hours`` before an explicit ``now_ms``."""
    return (ms >= F.lit(now_ms - hours * HOUR_MS)) & (ms <= F.lit(now_ms))


# Upper limits in ms of the arrival-delay tiers.
DELAY_TIERS = [
    ("le_30s", 30_000),
    ("le_10m", 600_000),
    ("le_6h", 21_600_000),
    ("le_48h", 172_800_000),
]


def delay_tier(event_ms: Column, ingest_ms: Column) -> Column:
    """Name of the arrival-delay tier; null when a time is missing."""
    delay = ingest_ms - event_ms
    tier = F.when(delay.isNull(), F.lit(None).cast("string"))
    for name, limit in DELAY_TIERS:
        tier = tier.when(delay <= limit, F.lit(name))
    return tier.otherwise(F.lit("beyond"))


# Size of the clock-shift noise and the lead that betrays it.
SHIFT_MS = 8 * HOUR_MS
SHIFT_LEAD_MS = 7 * HOUR_MS


def is_shifted(event_ms: Column, ingest_ms: Column, flag: Column) -> Column:
    return F.coalesce(flag == "suspect", F.lit(False)) | F.coalesce(
        event_ms - ingest_ms > SHIFT_LEAD_MS, F.lit(False)
    )


def corrected_time(event_ms: Column, ingest_ms: Column, flag: Column) -> Column:
    """Event time with the eight-hour clock shift taken back out."""
    return F.when(is_shifted(event_ms, ingest_ms, flag), event_ms - SHIFT_MS).otherwise(event_ms)
