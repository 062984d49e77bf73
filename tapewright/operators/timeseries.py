"""Operators on price and return series: returns, adjustment, candles, futures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tapewright.operators.calendar import bizdays_between
from tapewright.operators.transforms import Order, first_rows, ordered, top_k


def simple_log_returns(df: DataFrame, price: str, partition_by: Sequence[str], order_by: Order | Sequence[Order]) -> DataFrame:
    """Adds pct_return and log_return to the row before; the first row of each series goes."""
    series = Window.partitionBy(*partition_by).orderBy(*ordered(order_by))
    before = F.lag(price).over(series)
    ratio = F.col(price) / F.nullif(F.col("__before"), F.lit(0.0))
    found = df.withColumn("__before", before).withColumn("__rn", F.row_number().over(series)).where("__rn > 1")
    return found.withColumns({"pct_return": ratio - 1, "log_return": F.when(ratio > 0, F.log(ratio))}).drop("__before", "__rn")


def lag_diff(df: DataFrame, column: str, partition_by: Sequence[str], order_by: Order | Sequence[Order], output: str = "diff") -> DataFrame:
    """The difference to the row before; the first row stays, with null."""
    series = Window.partitionBy(*partition_by).orderBy(*ordered(order_by))
    return df.withColumn(output, F.col(column) - F.lag(column).over(series))


def reverse_cum_product(df: DataFrame, ratio: str, partition_by: Sequence[str], order_by: Order | Sequence[Order], output: str) -> DataFrame:
    """The product of the ratio from this row on; null counts as 1."""
    onward = Window.partitionBy(*partition_by).orderBy(*ordered(order_by)).rowsBetween(0, Window.unboundedFollowing)
    return df.withColumn(output, F.exp(F.sum(F.coalesce(F.log(F.when(F.col(ratio) > 0, F.col(ratio))), F.lit(0.0))).over(onward)))


def rolling_spike(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Order | Sequence[Order],
    value: str,
    window: int = 21,
    max_avg: float | None = None,
    min_value: float | None = None,
) -> DataFrame:
    """Adds the mean of the rows before (prev_avg) and the value's ratio to it (spike)."""
    before = Window.partitionBy(*partition_by).orderBy(*ordered(order_by)).rowsBetween(-window, -1)
    found = df.withColumn("prev_avg", F.avg(value).over(before))
    found = found.withColumn("spike", F.col(value) / F.nullif(F.col("prev_avg"), F.lit(0.0)))
    if max_avg is not None:
        found = found.where(F.col("prev_avg") <= max_avg)
    if min_value is not None:
        found = found.where(F.col(value) >= min_value)
    return found


def ohlc_candles(df: DataFrame, symbol: str | Sequence[str], ts: str, value: str, tie_break: str, invert: Column | None = None) -> DataFrame:
    """Daily open, high, low and close. Where ``invert`` holds, of 1 / value: its low comes from the high."""
    keys = [symbol] if isinstance(symbol, str) else list(symbol)
    price = F.col(value)
    if invert is not None:
        price = F.when(invert, 1 / F.nullif(price, F.lit(0.0))).otherwise(price)
    rows = df.withColumn("__p", price).where(F.col("__p").isNotNull()).withColumn("refdate", F.to_date(ts))
    at = F.struct(ts, tie_break)
    return rows.groupBy("refdate", *keys).agg(
        F.min_by("__p", at).alias("open"), F.max("__p").alias("high"), F.min("__p").alias("low"), F.max_by("__p", at).alias("close")
    )


def adjust_prices(
    df: DataFrame,
    returns_column: str = "returns",
    price_columns: Sequence[str] = ("open", "high", "low", "close"),
    anchor_column: str = "close",
    calendar: DataFrame | None = None,
    fill_calendar_gaps: bool = False,
    symbol_column: str = "symbol",
    date_column: str = "refdate",
) -> DataFrame:
    """Prices adjusted backwards from each symbol's latest close by its returns.

    The factor of a row is the exponential of the returns after it. A null return is skipped in the sum,
    but the next older row has no factor. With gap filling the series is first put on the business days
    between its ends, an absent day taking the whole row before it and a return of 0.
    """
    if fill_calendar_gaps:
        df = on_calendar(df, calendar, returns_column, symbol_column, date_column)
    down = Window.partitionBy(symbol_column).orderBy(F.col(date_column).desc())
    newer = down.rowsBetween(Window.unboundedPreceding, -1)
    found = df.withColumn("__rn", F.row_number().over(down))
    known = (F.col("__rn") == 1) | F.lag(returns_column).over(down).isNotNull()
    found = found.withColumn("__sum", F.coalesce(F.sum(returns_column).over(newer), F.lit(0.0)))
    found = found.withColumn("__factor", F.when(known, F.exp("__sum")))
    found = found.withColumn("__anchor", F.first(anchor_column).over(down.rowsBetween(Window.unboundedPreceding, 0)))
    found = found.withColumn("__adjusted", F.col("__anchor") / F.col("__factor"))
    scale = F.col("__adjusted") / F.nullif(F.col(anchor_column), F.lit(0.0))
    new = {c: F.col("__adjusted") if c == anchor_column else F.col(c) * scale for c in price_columns}
    return found.withColumns(new).drop("__rn", "__sum", "__factor", "__anchor", "__adjusted")


def on_calendar(df: DataFrame, calendar: DataFrame, returns_column: str, symbol_column: str = "symbol", date_column: str = "refdate") -> DataFrame:
    """One row a business day between a symbol's ends; absent days carry the whole row before them."""
    days = calendar.where("is_bizday").select(F.col("cal_date").alias(date_column))
    spans = df.groupBy(symbol_column).agg(F.min(date_column).alias("a"), F.max(date_column).alias("b"))
    # the days of a span are made where the span is, then looked up: no join by range
    grid = spans.select(symbol_column, F.explode(F.sequence(F.to_date("a"), F.to_date("b"))).alias(date_column))
    grid = grid.join(F.broadcast(days), date_column)
    rest = [c for c in df.columns if c not in (symbol_column, date_column)]
    rows = df.select(symbol_column, date_column, F.struct(*rest).alias("__row"))
    series = Window.partitionBy(symbol_column).orderBy(date_column).rowsBetween(Window.unboundedPreceding, 0)
    met = grid.join(rows, [symbol_column, date_column], "left")
    met = met.withColumn("__absent", F.col("__row").isNull())
    met = met.withColumn("__row", F.last("__row", ignorenulls=True).over(series))
    zero = F.when(F.col("__absent"), F.lit(0.0)).otherwise(F.col(f"__row.{returns_column}"))
    return met.select(*[F.col(c) if c in (symbol_column, date_column) else (zero if c == returns_column else F.col(f"__row.{c}")).alias(c) for c in df.columns])


def front_contract(
    df: DataFrame, group: Sequence[str], refdate: str, maturity: str, min_bizdays: int | None = None, cal: DataFrame | None = None, rank: int = 1
) -> DataFrame:
    """The contract that matures next, or the rank-th; optionally with that many business days left."""
    live = df.where(F.col(maturity) > F.col(refdate))
    if min_bizdays is not None:
        live = bizdays_between(live, cal, refdate, maturity, "__left").where(F.col("__left") >= min_bizdays).drop("__left")
    order = [maturity, *[c for c in sorted(df.columns) if c not in (maturity, refdate, *group)]]
    if rank == 1:
        return first_rows(live, [*group, refdate], order)
    series = Window.partitionBy(*group, refdate).orderBy(*ordered(order))
    return live.withColumn("__rn", F.row_number().over(series)).where(F.col("__rn") == rank).drop("__rn")


def continuous_future(df: DataFrame, group: str, refdate: str, maturity: str, quote: str) -> DataFrame:
    """(group, refdate, price): the front quote times all roll ratios from the day on.

    On a roll day, when the first contract matures, the ratio is that of the second contract's quote.
    """
    order = [F.col(maturity).asc_nulls_last(), F.col(quote).asc_nulls_last()]
    series = Window.partitionBy(group, refdate).orderBy(*order)
    live = df.where(F.col(maturity) >= F.col(refdate)).withColumn("rn", F.row_number().over(series)).where("rn <= 2")
    days = live.groupBy(group, refdate).agg(
        F.max(F.when(F.col("rn") == 1, F.col(quote))).alias("s1"),
        F.max(F.when(F.col("rn") == 2, F.col(quote))).alias("s2"),
        F.max(F.when(F.col("rn") == 1, F.col(maturity))).alias("m1"),
    )
    ratio = F.when(F.col("m1") == F.col(refdate), F.col("s2") / F.nullif(F.col("s1"), F.lit(0.0)))
    days = reverse_cum_product(days.withColumn("ratio", ratio), "ratio", [group], refdate, "__product")
    return days.select(group, refdate, (F.col("s1") * F.col("__product")).alias("price"))


def returns_from_oscillation(df: DataFrame, oscillation: str, sign: str | None = None) -> DataFrame:
    """pct_return and log_return from a change in percent, unsigned if a sign column is given."""
    pct = F.coalesce(F.col(oscillation), F.lit(0.0)) / 100
    if sign:
        pct = F.when(F.trim(sign) == "-", -pct).otherwise(pct)
    return df.withColumn("pct_return", pct).withColumn("log_return", F.when(pct > -1, F.log(1 + pct)))


def before_after_change(df: DataFrame, key: str, refdate: str, value: str, first, second) -> DataFrame:
    """(key, before, after, change) of the keys that have both dates."""
    a = df.where(F.col(refdate) == F.lit(first).cast("date")).select(key, F.col(value).alias("before"))
    b = df.where(F.col(refdate) == F.lit(second).cast("date")).select(key, F.col(value).alias("after"))
    return a.join(b, key).withColumn("change", F.col("after") - F.col("before"))


def liquidity_spikes(df: DataFrame, symbol: str, refdate: str, volume: str, k: int, window: int = 21) -> DataFrame:
    """The k greatest ratios of a day's volume to its symbol's trailing mean."""
    spikes = rolling_spike(df, [symbol], refdate, volume, window).where("prev_avg > 0")
    return top_k(spikes, ["-spike", refdate, symbol], k)
