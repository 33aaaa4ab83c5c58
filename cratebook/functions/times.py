"""Column expressions on play and membership times. Session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# First hour and end hour of each daypart.
DAYPARTS = {"night": (0, 6), "morning": (6, 12), "afternoon": (12, 18), "evening": (18, 24)}


def month_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def months_back(as_of: str, months: int) -> str:
    """The label of the month that lies ``months`` before the day ``as_of`` (yyyy-MM-dd...)."""
    number = int(as_of[:4]) * 12 + int(as_of[5:7]) - 1 - months
    return f"{number // 12:04d}-{number % 12 + 1:02d}"


def in_months(df: DataFrame, column: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Rows of the months ``first`` to ``last`` (yyyy-MM, both included; without time: none).

    The labels become a range in the column's own type, so that a scan can use it. Times kept
    as text are compared by their label.
    """
    kind, value = dict(df.dtypes)[column], F.col(column)
    rows = df.where(value.isNotNull())
    if kind == "string":
        label = month_label(value)
        rows = rows if first is None else rows.where(label >= first)
        return rows if last is None else rows.where(label <= last)

    def start(month: str) -> Column:
        return F.lit(f"{month}-01").cast(kind)

    if first is not None:
        rows = rows.where(value >= start(first))
    return rows if last is None else rows.where(value < start(months_back(last, -1)))


def with_time_parts(df: DataFrame, ts: str = "timestamp", ms: str = "ms_played") -> DataFrame:
    t = F.col(ts)
    parts = {
        "date": F.to_date(t),
        "hour": F.hour(t),
        "day_of_week": F.date_format(t, "EEEE"),
        "day_of_week_num": F.weekday(t),
        "month": month_label(t),
    }
    if ms in df.columns:
        parts["minutes_played"] = F.col(ms) / 60000
    return df.withColumns(parts)


def daypart(ts: Column) -> Column:
    hour = F.hour(ts)
    chain = F.when(ts.isNull(), F.lit(None).cast("string"))
    for name, (start, end) in DAYPARTS.items():
        chain = chain.when((hour >= start) & (hour < end), name)
    return chain


def in_daypart(ts: Column, name: str) -> Column:
    """Membership in a daypart, or in the weekend, which overlaps all of them."""
    if name == "weekend":
        return F.weekday(ts) >= 5
    if name not in DAYPARTS:
        return F.lit(False)
    return daypart(ts) == name


def period_end(period_type: Column, value: Column) -> Column:
    """Last second of a ``month`` yyyy-MM or a ``year`` yyyy; null when invalid."""
    first = F.when(
        period_type == "month", F.try_to_timestamp(value, F.lit("yyyy-MM"))
    ).when(period_type == "year", F.try_to_timestamp(F.concat(value, F.lit("-12")), F.lit("yyyy-MM")))
    return F.last_day(first).cast("timestamp") + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")


def age_days(as_of: str, ts: Column) -> Column:
    """Fractional days from ``ts`` to ``as_of``."""
    end = F.lit(as_of).cast("timestamp")
    return (F.unix_micros(end) - F.unix_micros(ts.cast("timestamp"))) / 86_400_000_000


def days_before(as_of: str, days: int) -> Column:
    return F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAYS")


def meaningful_play(ms: Column, skipped: Column | None = None, minimum: int = 30_000) -> Column:
    keep = ms >= minimum
    return keep if skipped is None else keep & ~F.coalesce(skipped, F.lit(False))
