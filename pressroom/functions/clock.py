"""Time expressions. None reads the clock: callers pass ``as_of``."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def round_second(ts: Column) -> Column:
    """Nearest whole second; an exact half goes to the even second."""
    micros = F.unix_micros(ts)
    rest = F.pmod(micros, F.lit(MICROS))
    down = micros - rest
    down_is_odd = F.pmod(down, F.lit(2 * MICROS)) != 0
    up = (rest > MICROS // 2) | ((rest == MICROS // 2) & down_is_odd)
    return F.timestamp_micros(F.when(up, down + MICROS).otherwise(down))


def chunk_name(ts: Column) -> Column:
    """Hour directory a moment belongs to, ``YYYY/MM/DD/HH``."""
    return F.date_format(ts, "yyyy/MM/dd/HH")


def epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts)


def interval_seconds(start: Column, end: Column) -> Column:
    """Whole seconds between two timestamps, cut towards zero."""
    return F.timestamp_diff("SECOND", start, end)


def as_date(value: date | datetime | str | Column) -> Column:
    return value.cast("date") if isinstance(value, Column) else F.lit(value).cast("date")


def as_timestamp(value: date | datetime | str | Column) -> Column:
    return value.cast("timestamp") if isinstance(value, Column) else F.lit(value).cast("timestamp")


def whole_days_between(as_of, moment: Column, moment_is_date: bool = True) -> Column:
    """Days from ``moment`` to ``as_of``, floored, so one second ahead counts as -1."""
    if moment_is_date:
        return F.datediff(as_date(as_of), moment)
    micros = F.unix_micros(as_timestamp(as_of)) - F.unix_micros(moment)
    return F.floor(micros / F.lit(86_400 * MICROS).cast("double")).cast("int")


def half_life_decay(as_of, moment: Column, half_life: float, moment_is_date: bool = True) -> Column:
    """``0.5 ** (days / half_life)``; a moment in the future gives more than 1."""
    days = whole_days_between(as_of, moment, moment_is_date)
    return F.pow(F.lit(0.5), days / F.lit(float(half_life)))


def last_n_days(day: Column, as_of, days: int) -> Column:
    """True from ``days - 1`` days before ``as_of`` on; there is no upper end."""
    return day >= F.date_sub(as_date(as_of), days - 1)
