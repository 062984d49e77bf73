"""Business-day calendars as ordinary tables and the operators that join them.

A calendar has one row a day: cal_date, is_bizday, biz_idx (business days up to and including the day) and
next_bizday (the day itself or the next business day). It has a few thousand rows for a century, so it is
broadcast wherever it is joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# fixed values: the letters of the delivery months January to December
MONTH_LETTERS = "FGHJKMNQUVXZ"
MATURITY_DAYS = ("first day", "15th day", "first bizday", "last day")


def build_calendar(spark: SparkSession, start: Any, end: Any, holidays: Sequence[Any] | None = None, kind: str = "bizday") -> DataFrame:
    """kind "actual": every day is a business day; "bizday": weekdays that are no holiday."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))).alias("cal_date"))
    is_bizday = F.lit(True)
    if kind == "bizday":
        is_bizday = ~F.dayofweek("cal_date").isin(1, 7)
        if holidays:
            is_bizday = is_bizday & ~F.col("cal_date").isin(*[F.lit(str(h)).cast("date") for h in holidays])
    elif kind != "actual":
        raise ValueError(f"unknown kind: {kind}")
    days = days.withColumn("is_bizday", is_bizday)
    up_to = Window.orderBy("cal_date").rowsBetween(Window.unboundedPreceding, 0)
    onward = Window.orderBy("cal_date").rowsBetween(0, Window.unboundedFollowing)
    return days.select(
        "cal_date",
        "is_bizday",
        F.sum(F.col("is_bizday").cast("long")).over(up_to).alias("biz_idx"),
        F.first(F.when(F.col("is_bizday"), F.col("cal_date")), ignorenulls=True).over(onward).alias("next_bizday"),
    )


def bizday_seq(cal: DataFrame, start: Any, end: Any) -> DataFrame:
    inside = F.col("cal_date").between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))
    return cal.where(F.col("is_bizday") & inside).select("cal_date")


def _looked_up(df: DataFrame, cal: DataFrame, date: Column, wanted: Column, output: str) -> DataFrame:
    key = cal.select(F.col("cal_date").alias("__day"), wanted.alias("__found"))
    met = df.withColumn("__key", date).join(F.broadcast(key), F.col("__key") == F.col("__day"), "left")
    return met.withColumn(output, F.col("__found")).drop("__key", "__day", "__found")


def following_bizday(df: DataFrame, cal: DataFrame, date_column: str, adjusted_column: str) -> DataFrame:
    return _looked_up(df, cal, F.col(date_column), F.col("next_bizday"), adjusted_column)


def bizdays_between(df: DataFrame, cal: DataFrame, from_column: str, to_column: str, output_column: str) -> DataFrame:
    """Business days from one date to the other, both moved to the following business day first."""
    index = cal.where("is_bizday").select(F.col("cal_date").alias("d"), F.col("biz_idx").alias("i"))
    ends = cal.join(index, F.col("next_bizday") == F.col("d")).select("cal_date", F.col("i").alias("at"))
    df = _looked_up(df, ends, F.col(from_column), F.col("at"), "__from")
    df = _looked_up(df, ends, F.col(to_column), F.col("at"), "__to")
    return df.withColumn(output_column, F.col("__to") - F.col("__from")).drop("__from", "__to")


def offset_bizdays(df: DataFrame, cal: DataFrame, date_column: str, n_column: str, output_column: str) -> DataFrame:
    """The date n business days after (before, if negative) the following business day of the date."""
    days = cal.where("is_bizday").select(F.col("biz_idx").alias("__i"), F.col("cal_date").alias("__to"))
    by_date = cal.select("cal_date", F.when(F.col("is_bizday"), F.col("biz_idx")).otherwise(F.col("biz_idx") + 1).alias("at"))
    df = _looked_up(df, by_date, F.col(date_column), F.col("at"), "__at")
    met = df.join(F.broadcast(days), F.col("__at") + F.col(n_column) == F.col("__i"), "left")
    return met.withColumn(output_column, F.col("__to")).drop("__at", "__i", "__to")


def maturity_to_date(df: DataFrame, cal: DataFrame, code_column: str, date_column: str, maturity_day: str = "first day") -> DataFrame:
    """From the last three characters of a code, month letter and two-digit year, to a date."""
    if maturity_day not in MATURITY_DAYS:
        raise ValueError(f"unknown day rule: {maturity_day}")
    code = F.substring(F.trim(code_column), -3, 3)
    month = F.instr(F.lit(MONTH_LETTERS), F.substring(code, 1, 1))
    year = F.substring(code, 2, 2).try_cast("int") + 2000
    good = code.rlike(f"^[{MONTH_LETTERS}][0-9]{{2}}$")
    day = F.lit(15 if maturity_day == "15th day" else 1)
    date = F.when(good, F.make_date(F.when(good, year), F.when(good, month), day))
    if maturity_day == "last day":
        date = F.last_day(date)
    df = df.withColumn(date_column, date)
    return following_bizday(df, cal, date_column, date_column) if maturity_day == "first bizday" else df
