"""Interest rates: implied rates, flat-forward interpolation at standard terms, curve vertices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tapewright.operators.calendar import bizdays_between, following_bizday, offset_bizdays

BUSINESS_YEAR, MONEY_YEAR = 252, 360


def implied_rate(
    df: DataFrame,
    price_column: str,
    rate_column: str,
    days_to_maturity_column: str,
    compounding: str = "simple",
    forward_price: float = 100_000,
) -> DataFrame:
    growth = F.lit(float(forward_price)) / F.nullif(F.col(price_column), F.lit(0.0))
    days = F.nullif(F.col(days_to_maturity_column), F.lit(0))
    if compounding == "simple":
        rate = (growth - 1) * MONEY_YEAR / days
    elif compounding == "discrete":
        rate = F.pow(F.when(growth > 0, growth), F.lit(float(BUSINESS_YEAR)) / days) - 1
    else:
        raise ValueError(f"unknown compounding: {compounding}")
    return df.withColumn(rate_column, rate)


def rate_from_settlement(product: Column, price: Column, business_days: Column, calendar_days: Column, discrete: Sequence[str], simple: Sequence[str]) -> Column:
    """Rate of a 100,000-point contract by product, to five places; null for others and for zeros."""
    growth = F.lit(100000.0) / F.when(price > 0, price)
    compound = F.pow(growth, F.lit(float(BUSINESS_YEAR)) / F.nullif(business_days, F.lit(0))) - 1
    linear = (growth - 1) * MONEY_YEAR / F.nullif(calendar_days, F.lit(0))
    return F.when(product.isin(*discrete), F.round(compound, 5)).when(product.isin(*simple), F.round(linear, 5))


def standard_terms(
    df: DataFrame,
    cal: DataFrame | None,
    standard_terms: Sequence[int],
    symbol_prefix: str,
    refdate_column: str = "refdate",
    business_days_column: str = "business_days",
    rate_column: str = "adjusted_tax",
) -> DataFrame:
    """Rates at fixed numbers of business days, one row a date and term.

    The logarithm of the growth to a vertex is linear in its term between vertices and flat beyond them. Vertices
    and wanted terms are one series per date; each wanted term finds its neighbours by windows.
    """
    t, y = F.col(business_days_column).cast("double"), F.col(rate_column)
    knots = df.where(y.isNotNull() & (t > 0)).select(
        F.col(refdate_column).alias("refdate"),
        t.alias("t"),
        F.struct(t.alias("t"), (F.log(1 + y) * t / BUSINESS_YEAR).alias("y")).alias("knot"),
        F.lit(None).cast("int").alias("term"),
    )
    wanted = knots.select("refdate").distinct().withColumn("term", F.explode(F.lit([int(x) for x in standard_terms])))
    wanted = wanted.select("refdate", F.col("term").cast("double").alias("t"), F.lit(None).cast(knots.schema["knot"].dataType).alias("knot"), "term")
    series = Window.partitionBy("refdate").orderBy("t")
    below = F.last("knot", ignorenulls=True).over(series.rangeBetween(Window.unboundedPreceding, 0))
    above = F.first("knot", ignorenulls=True).over(series.rangeBetween(0, Window.unboundedFollowing))
    found = knots.unionByName(wanted).withColumns({"a": below, "b": above}).where("term is not null")
    share = (F.col("t") - F.col("a.t")) / F.nullif(F.col("b.t") - F.col("a.t"), F.lit(0.0))
    value = F.col("a.y") + (F.col("b.y") - F.col("a.y")) * F.coalesce(share, F.lit(0.0))
    value = F.when(F.col("a").isNull(), F.col("b.y")).when(F.col("b").isNull(), F.col("a.y")).otherwise(value)
    rates = found.select(
        F.col("refdate").alias(refdate_column),
        F.concat(F.lit(symbol_prefix), F.col("term").cast("string")).alias("symbol"),
        F.col("term").cast("long").alias(business_days_column),
        (F.exp(value * BUSINESS_YEAR / F.col("t")) - 1).alias(rate_column),
    )
    return offset_bizdays(rates, cal, refdate_column, business_days_column, "maturity_date") if cal is not None else rates


def yield_curve(
    futures: DataFrame,
    overnight: DataFrame,
    cal: DataFrame,
    refdate: str = "refdate",
    maturity: str = "maturity_date",
    rate: str = "adjusted_tax",
) -> DataFrame:
    """Vertices of the futures and, on dates that have any, one overnight vertex of one day.

    Both tables: refdate and rate; the futures also maturity. Maturities move to business days.
    """
    curve = following_bizday(futures.select(refdate, maturity, rate), cal, maturity, maturity)
    dates = curve.select(refdate).distinct()
    first = overnight.join(dates, refdate, "left_semi").withColumn("__one", F.lit(1))
    first = offset_bizdays(first, cal, refdate, "__one", maturity).select(refdate, maturity, rate)
    return bizdays_between(curve.unionByName(first), cal, refdate, maturity, "business_days").where("business_days > 0")
