"""Month calendars."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def month_range(start: dt.date, end: dt.date, strict: bool = True) -> list[dt.date]:
    """First days of the months from start to end, both included.

    A start after the end is an error, or an empty list with `strict=False`.
    """
    first, last = start.year * 12 + start.month - 1, end.year * 12 + end.month - 1
    if first > last and strict:
        raise ValueError(f"start {start} is after end {end}")
    return [dt.date(m // 12, m % 12 + 1, 1) for m in range(first, last + 1)]


def months(spark: SparkSession, start: dt.date, end: dt.date, strict: bool = True) -> DataFrame:
    """The same calendar as rows, with the half-open window of each month."""
    days = month_range(start, end, strict)
    if not days:
        return month_windows(spark.createDataFrame([], "month date"))
    calendar = F.sequence(F.lit(days[0]), F.lit(days[-1]), F.expr("interval 1 month"))
    return month_windows(spark.range(1).select(F.explode(calendar).alias("month")))


def months_covering(df: DataFrame, column: str) -> DataFrame:
    """Every month between the first and last value of a column, gaps included."""
    ends = df.agg(F.trunc(F.min(column), "month").alias("lo"), F.trunc(F.max(column), "month").alias("hi"))
    calendar = ends.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("month"))
    return month_windows(calendar)


def month_windows(calendar: DataFrame) -> DataFrame:
    """Half-open window [first day, first day of next month) and the days in the month."""
    return calendar.select(
        "month",
        F.date_format("month", "yyyyMMdd'0000'").alias("period_start"),
        F.date_format(F.add_months("month", 1), "yyyyMMdd'0000'").alias("period_end"),
        F.dayofmonth(F.last_day("month")).alias("days"))
