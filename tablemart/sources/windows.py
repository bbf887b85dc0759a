"""Date windows: always [start, end)."""

from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F

from tablemart.functions.times import LOCAL_ZONE

WEATHER_DELAY_DAYS = 5
WEATHER_OVERLAP_DAYS = 14
CHUNK_DAYS = 30


def _today(today):
    return today or datetime.now(ZoneInfo(LOCAL_ZONE)).date()


def daily_window(today=None):
    """Yesterday in the local zone."""
    today = _today(today)
    return today - timedelta(days=1), today


def year_window(year, today=None, first=None):
    """A completed calendar year, not before `first` if that is given."""
    if year >= (today or date.today()).year or first is not None and year < first:
        raise ValueError("choose a completed year" + (f" from {first} on" if first is not None else ""))
    return date(year, 1, 1), date(year + 1, 1, 1)


def weather_window(today=None):
    """The overlapping re-read window that lets late weather rows replace earlier ones."""
    end = _today(today) - timedelta(days=WEATHER_DELAY_DAYS)
    return end - timedelta(days=WEATHER_OVERLAP_DAYS), end


def within(column, start, end):
    """Filter of a date or timestamp column to [start, end)."""
    return (column >= F.lit(start)) & (column < F.lit(end))


def chunk_windows(bounds, start="start", end="end", days=CHUNK_DAYS):
    """Split every [start, end) row into chunks of `days`.

    `request_from` and `request_to` are what the source is asked for: one extra UTC day before
    each chunk, so that the local evening hours of the last day are included.
    """
    step = F.make_interval(days=F.lit(days))
    first, last = F.col(start).cast("date"), F.col(end).cast("date")
    return (
        bounds.filter(first < last)
        .select(first.alias("_first"), last.alias("_last"))
        .select("_last", F.explode(F.sequence("_first", F.date_sub("_last", 1), step)).alias("chunk_start"))
        .select(
            "chunk_start",
            F.least(F.date_add("chunk_start", days), F.col("_last")).alias("chunk_end"),
            F.date_sub("chunk_start", 1).alias("request_from"),
        )
        .withColumn("request_to", F.col("chunk_end"))
    )


def chunk_start_of(column, first, days=CHUNK_DAYS):
    """Start of the chunk that holds a date, for chunks counted from `first`."""
    number = F.floor(F.datediff(column, first) / days).cast("int")
    return F.date_add(first, number * days)
