"""Column functions on timestamps."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.constants import BUCKET_MINUTES, CREATED_AT_PATTERNS, LOOKBACK_HOURS

Moment = str | datetime


def moment(value: Moment | None) -> Column:
    """A timestamp literal; ``None`` means now."""
    return F.current_timestamp() if value is None else F.lit(value).cast("timestamp")


def parse_timestamp(text: Column, strict_z: bool = True) -> Column:
    """First accepted layout that fits, else null. ``strict_z=False`` also reads other UTC offsets."""
    tries = [F.try_to_timestamp(text, F.lit(pattern)) for pattern in CREATED_AT_PATTERNS]
    if not strict_z:
        tries.append(F.try_to_timestamp(text))
    return F.coalesce(*tries)


def round_seconds(ts: Column) -> Column:
    """Nearest whole second, as a column without fractional digits would store it."""
    return F.date_trunc("second", ts + F.expr("INTERVAL 500 MILLISECONDS"))


def floor_minutes(ts: Column, bucket: int = BUCKET_MINUTES) -> Column:
    step = bucket * 60
    return F.timestamp_seconds(F.floor(F.unix_timestamp(ts) / step) * step)


def timestamp_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def hour_label(hour: Column) -> Column:
    """0 → ``12 AM`` … 23 → ``11 PM``."""
    half = F.when(hour < 12, F.lit("AM")).otherwise(F.lit("PM"))
    twelve = F.when(hour % 12 == 0, F.lit(12)).otherwise(hour % 12)
    return F.concat_ws(" ", twelve.cast("string"), half)


def in_range(df: DataFrame, column: str, start: Moment | Column, end: Moment | Column, closed: str = "left") -> DataFrame:
    """Rows with ``start <= column < end``, or ``<= end`` with ``closed="both"``.

    The column stays bare on its side of the comparison so that the bounds reach the scan.
    """
    low, high = (b if isinstance(b, Column) else moment(b) for b in (start, end))
    value = F.col(column)
    if closed == "both":
        return df.filter(value.between(low, high))
    if closed == "left":
        return df.filter((value >= low) & (value < high))
    raise ValueError(f"closed must be 'left' or 'both', not {closed!r}")


def lookback(as_of: Moment | None = None, hours: int = LOOKBACK_HOURS, bucket: int = BUCKET_MINUTES) -> tuple[Column, Column]:
    """``(start, end)``: the last ``hours`` before ``as_of`` floored to ``bucket`` minutes."""
    end = floor_minutes(moment(as_of), bucket)
    return end - F.expr(f"INTERVAL {int(hours)} HOURS"), end
