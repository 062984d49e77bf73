"""What several operators share: scratch tables in the shared folder and byte tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from tapewright.functions.scratch import scratch, table

__all__ = ["LOWER", "at_most", "fields_of", "named", "packed", "saved", "schema_of", "scratch", "table"]

# bytes -> bytes: lower-cases A-Z and leaves every other byte as it is
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """The same rows, written to the shared folder and read back: a cut in the lineage.

    The write's shuffle files go at its end, as nothing reads them again; otherwise they stay until a collection in the driver.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    before = spark.conf.get(_FREED, "false")
    spark.conf.set(_FREED, "true")
    try:
        writer.parquet(path)
    finally:
        spark.conf.set(_FREED, before)
    fields = {f.name: f for f in df.schema}
    last = [fields[c] for c in partition_by]
    return spark.read.schema(StructType([f for f in df.schema if f.name not in partition_by] + last)).parquet(path)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def named(*columns: str) -> list[Column]:
    """Columns by their whole names, dots and other signs included."""
    return [F.col(_quoted(c)) for c in columns]


def packed(docs: DataFrame, but: str | None = None, keep: str | None = None) -> Column:
    """A struct of all columns but one, which travels through an operator; ``keep`` stays where it would be empty."""
    columns = [c for c in docs.columns if c != but] or [keep or docs.columns[0]]
    return F.struct(*named(*columns))


def fields_of(docs: DataFrame, text_column: str | None = None, row: str = "row", text: str = "text") -> list[Column]:
    """The input's columns out of a packed row; the text comes from a column of its own."""
    return [F.col(text if c == text_column else f"{row}.{_quoted(c)}").alias(c) for c in docs.columns]


def schema_of(**columns: str | DataType) -> StructType:
    """A schema from names and types, each a type or its DDL."""
    found = StructType()
    for name, kind in columns.items():
        found.add(name, DataType.fromDDL(kind) if isinstance(kind, str) else kind)
    return found


def at_most(rows: DataFrame, size: Column, most: int, steps: int = 64) -> DataFrame:
    """The rows of greatest size, ``most`` of them or fewer: all those down to a size that is the same for all.

    The cut comes from counts per size on a logarithmic scale, so that no task or driver sorts rows. ``rows`` is read
    twice and should be a table; sizes are positive.
    """
    step = F.floor(F.log2(size) * steps)
    counts = rows.groupBy(step.alias("step")).agg(F.count("*").alias("n")).orderBy(F.desc("step")).collect()
    total, least = 0, None
    for r in counts:
        total += r["n"]
        if total > most:
            break
        least = r["step"]
    return rows.where(step >= least) if least is not None else rows.limit(0)
