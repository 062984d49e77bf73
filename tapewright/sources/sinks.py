"""Writers: partitions replaced one by one, whole datasets, the outputs of one scan, query results.

A dataset is replaced as a whole by a write beside it and two renames, so that a job that fails leaves the old rows, and a
job may read what it replaces. Partitions are replaced by Spark's own staging.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shaped(df: DataFrame, schema: T.StructType | None) -> DataFrame:
    """Columns in the schema's order and types; absent ones are null."""
    if schema is None:
        return df
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def write_partitioned(df: DataFrame, path: str, partitioning: Sequence[str], schema: T.StructType | None = None, seen: Observation | None = None) -> None:
    """Replaces the partitions that the frame has and keeps all others; ``seen`` gets the number of rows as ``n``."""
    out = shaped(df, schema)
    if not partitioning:
        return write_single(out, path)
    # adaptive execution splits a large partition among tasks and joins small ones, by the sizes that it sees
    rows = out.hint("rebalance", *partitioning)
    if seen is not None:
        rows = _counted(rows, seen)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitioning).parquet(path)


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the maker of its paths."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def _beside(path: str, what: str) -> str:
    """Another path in the same folder, which readers of that folder skip."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/.{name}.{what}"


def recover(spark: SparkSession, path: str) -> None:
    """Ends a replacement that stopped between its renames: what was there before comes back."""
    fs, at = _files(spark, path)
    if not fs.exists(at(path)) and fs.exists(at(_beside(path, "old"))):
        fs.rename(at(_beside(path, "old")), at(path))


def replace(spark: SparkSession, path: str, write: Callable[[str], None], accept: Callable[[], bool] = lambda: True) -> bool:
    """``write`` gets a path beside the target; only when it is done, and ``accept`` agrees, does that take the target's place."""
    fs, at = _files(spark, path)
    recover(spark, path)
    staged, old = _beside(path, f"new-{uuid.uuid4().hex}"), _beside(path, "old")
    try:
        write(staged)
        if not accept():
            return False
        fs.delete(at(old), True)
        if fs.exists(at(path)) and not fs.rename(at(path), at(old)):
            raise OSError(f"{path} cannot be moved")
        if not fs.rename(at(staged), at(path)):
            recover(spark, path)
            raise OSError(f"{staged} cannot be moved to {path}")
        fs.delete(at(old), True)
        return True
    finally:
        fs.delete(at(staged), True)


def write_single(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    """Replaces the dataset, which the frame may read."""
    replace(df.sparkSession, path, lambda staged: shaped(df, schema).write.parquet(staged))


def _counted(df: DataFrame, seen: Observation) -> DataFrame:
    return df.observe(seen, F.count(F.lit(1)).alias("n"))


def write_dataset(df: DataFrame, root: str, name: str, layer: str = "staging", partitioning: Sequence[str] = (), schema: T.StructType | None = None) -> str:
    path = f"{root}/{layer}/{name}"
    write_partitioned(df, path, partitioning, schema)
    return path


def sql_export(spark: SparkSession, query: str, path: str, partitioning: Sequence[str] = ()) -> None:
    """The query's rows in place of all that the target held; the query may read the target."""
    rows = spark.sql(query)

    def write(staged: str) -> None:
        writer = rows.write
        (writer.partitionBy(*partitioning) if partitioning else writer).parquet(staged)

    replace(spark, path, write)


def write_multi(dfs: Mapping[str, DataFrame], root: str, name: str, layer: str = "input", partitioning: Sequence[str] = (), schemas: Mapping[str, T.StructType] | None = None) -> list[str]:
    """Each output that has rows, as ``name-output``, in one job each: rows are counted while they are written.

    Where the outputs come from one scan, ``write_outputs`` reads it once.
    """
    done = []
    for output, df in dfs.items():
        path, seen = f"{root}/{layer}/{name}-{output}", Observation()
        rows = shaped(df, (schemas or {}).get(output))
        if partitioning:
            write_partitioned(rows, path, partitioning, seen=seen)
        else:
            replace(rows.sparkSession, path, _counted(rows, seen).write.parquet, lambda seen=seen: seen.get["n"] > 0)
        if seen.get["n"]:
            done.append(path)
    return done


def write_outputs(rows: DataFrame, root: str, name: str, layer: str = "input", partitioning: Sequence[str] = ()) -> str:
    """All outputs of tagged rows (``readers.tagged``) in one job and one pass, below ``layer/name/output=...``; returns that path.

    Partitions that the rows have are replaced, all others stay, also those of other outputs. Outputs without rows get no
    folder. Large partitions are split among tasks and small ones joined by adaptive execution.
    """
    path = f"{root}/{layer}/{name}"
    write_partitioned(rows, path, ["output", *partitioning])
    return path


def read_output(spark: SparkSession, path: str, output: str, columns: Mapping[str, str]) -> DataFrame:
    """One output of ``write_outputs`` with its own columns (name -> type); no rows if it was never written."""
    fs, at = _files(spark, path)
    folder = f"{path}/output={output}"
    schema = T.StructType()
    for column, kind in columns.items():
        schema.add(column, kind).add(f"{column}@{output}", kind)
    if fs.exists(at(folder)):
        rows = spark.read.schema(schema).option("basePath", folder).parquet(folder)
    else:
        rows = spark.createDataFrame([], schema)
    return rows.select(*[F.coalesce(F.col(f"`{c}`"), F.col(f"`{c}@{output}`")).alias(c) for c in columns])


MANY_PARTITIONS = 10_000  # touched partitions are named in the filter up to so many


def touched(old: DataFrame, new: DataFrame, partitioning: Sequence[str]) -> DataFrame:
    """The rows of ``old`` in the partitions that ``new`` has rows in; a few are named in the scan's filter, many are joined."""
    hit = new.select(*partitioning).distinct()
    named = hit.limit(MANY_PARTITIONS + 1).collect()
    if len(named) > MANY_PARTITIONS:
        met = hit.withColumnsRenamed({c: f"__{c}" for c in partitioning})
        same = [old[c].eqNullSafe(met[f"__{c}"]) for c in partitioning]
        return old.join(met, same, "left_semi")
    condition = F.lit(False)
    for values in sorted({tuple(r)[:-1] for r in named}, key=str):
        same = F.lit(True)
        for column, value in zip(partitioning, values, strict=False):
            same = same & F.col(column).eqNullSafe(F.lit(value))
        last = [r[-1] for r in named if tuple(r)[:-1] == values]
        inner = F.col(partitioning[-1]).isin([v for v in last if v is not None]) if any(v is not None for v in last) else F.lit(False)
        if None in last:
            inner = inner | F.col(partitioning[-1]).isNull()
        condition = condition | (same & inner)
    return old.where(condition)


def save_result(df: DataFrame, path: str, kind: str = "parquet") -> None:
    if kind not in ("csv", "json", "parquet", "orc"):
        raise ValueError(f"unknown format: {kind}")
    writer = df.write.mode("overwrite")
    writer.option("header", True).csv(path) if kind == "csv" else getattr(writer, kind)(path)
