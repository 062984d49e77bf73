"""Scans over ordered series in blocks: a long series is many tasks, not one.

Rows are dealt by ranges of series and order, and each range is a block. What a block needs of the blocks before it is a
carry: one row for each series and block, found by a grouped sum, carried along the few blocks of a series by a window, and joined
back. Windows over rows run inside one block of one series. Rows of equal order are in one block; give enough order
columns that ties cannot matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tapewright.functions.scratch import written
from tapewright.operators.transforms import Order, ordered

BLOCK = "__block"


def blocks(df: DataFrame, partition_by: Sequence[str], order_by: Order | Sequence[Order], count: int) -> DataFrame:
    """The rows with the number of their range; written, as the numbers must be the same whenever they are read."""
    keys = [F.col(c) for c in partition_by]
    dealt = df.repartitionByRange(count, *keys, *ordered(order_by))
    return written(dealt.withColumn(BLOCK, F.spark_partition_id()), "blocks")


def _inside(partition_by: Sequence[str], order_by: Order | Sequence[Order]):
    return Window.partitionBy(*partition_by, BLOCK).orderBy(*ordered(order_by))


def _met(rows: DataFrame, carries: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows with the carry of their series and block."""
    named = carries.withColumnsRenamed({c: f"__k{i}" for i, c in enumerate(partition_by)}).withColumnRenamed(BLOCK, "__kb")
    same = rows[BLOCK] == named["__kb"]
    for i, c in enumerate(partition_by):
        same = same & rows[c].eqNullSafe(named[f"__k{i}"])
    return rows.join(named, same, "left").drop("__kb", BLOCK, *[f"__k{i}" for i in range(len(partition_by))])


def _carried(ends: DataFrame, partition_by: Sequence[str], value: Column, frame: tuple[int, int]) -> DataFrame:
    """One row per series and block: the value over the blocks before (or after) it as ``__carry``."""
    along = Window.partitionBy(*partition_by).orderBy(BLOCK).rowsBetween(*frame)
    return ends.select(*partition_by, BLOCK, value.over(along).alias("__carry"))


BEFORE = (Window.unboundedPreceding, -1)
AFTER = (1, Window.unboundedFollowing)


def forward_fill(df: DataFrame, column: str, order_by: Order | Sequence[Order], partition_by: Sequence[str], count: int) -> DataFrame:
    """Nulls take the last value before them."""
    rows = blocks(df, partition_by, order_by, count)
    place = F.row_number().over(_inside(partition_by, order_by))
    ends = rows.withColumn("__at", place).where(F.col(column).isNotNull()).groupBy(*partition_by, BLOCK).agg(F.max_by(column, "__at").alias("__last"))
    # blocks without a value pass on what they get
    every = rows.select(*partition_by, BLOCK).distinct()
    met = _joined(every, ends, partition_by)
    carries = _carried(met, partition_by, F.last("__last", ignorenulls=True), BEFORE)
    filled = F.last(column, ignorenulls=True).over(_inside(partition_by, order_by).rowsBetween(Window.unboundedPreceding, 0))
    found = _met(rows.withColumn("__own", filled), carries, partition_by)
    return found.withColumn(column, F.coalesce("__own", "__carry")).select(*df.columns)


def _joined(every: DataFrame, ends: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    named = ends.withColumnsRenamed({c: f"__k{i}" for i, c in enumerate(partition_by)}).withColumnRenamed(BLOCK, "__kb")
    same = every[BLOCK] == named["__kb"]
    for i, c in enumerate(partition_by):
        same = same & every[c].eqNullSafe(named[f"__k{i}"])
    return every.join(named, same, "left").select(*[every[c] for c in partition_by], every[BLOCK], "__last")


def before(df: DataFrame, column: str, partition_by: Sequence[str], order_by: Order | Sequence[Order], output: str, count: int) -> DataFrame:
    """Adds the value of the row before; null in the first row of a series."""
    rows = blocks(df, partition_by, order_by, count)
    inside = _inside(partition_by, order_by)
    placed = rows.withColumns({"__at": F.row_number().over(inside), "__own": F.lag(column).over(inside)})
    ends = placed.groupBy(*partition_by, BLOCK).agg(F.max_by(F.struct(F.col(column).alias("v")), "__at").alias("__last"))
    carries = _carried(ends, partition_by, F.last("__last"), BEFORE)
    found = _met(placed, carries, partition_by)
    return found.withColumn(output, F.when(F.col("__at") > 1, F.col("__own")).otherwise(F.col("__carry.v"))).select(*df.columns, output)


def lag_diff(df: DataFrame, column: str, partition_by: Sequence[str], order_by: Order | Sequence[Order], count: int, output: str = "diff") -> DataFrame:
    found = before(df, column, partition_by, order_by, "__before", count)
    return found.withColumn(output, F.col(column) - F.col("__before")).drop("__before")


def running_sum(df: DataFrame, value: Column, partition_by: Sequence[str], order_by: Order | Sequence[Order], output: str, count: int, onward: bool = False) -> DataFrame:
    """Adds the sum of the values up to each row, or with ``onward`` from it on."""
    rows = blocks(df.withColumn("__value", value), partition_by, order_by, count)
    frame = (0, Window.unboundedFollowing) if onward else (Window.unboundedPreceding, 0)
    own = F.sum("__value").over(_inside(partition_by, order_by).rowsBetween(*frame))
    ends = rows.groupBy(*partition_by, BLOCK).agg(F.sum("__value").alias("__last"))
    carries = _carried(ends, partition_by, F.sum("__last"), AFTER if onward else BEFORE)
    found = _met(rows.withColumn("__own", own), carries, partition_by)
    return found.withColumn(output, F.col("__own") + F.coalesce("__carry", F.lit(0))).select(*df.columns, output)


def reverse_cum_product(df: DataFrame, ratio: str, partition_by: Sequence[str], order_by: Order | Sequence[Order], output: str, count: int) -> DataFrame:
    logs = F.coalesce(F.log(F.when(F.col(ratio) > 0, F.col(ratio))), F.lit(0.0))
    return running_sum(df, logs, partition_by, order_by, output, count, onward=True).withColumn(output, F.exp(output))
