"""Incremental processing: new files as a stream, snapshots and overlapping reloads."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.functions.scratch import written
from tapewright.operators.transforms import latest_per_key
from tapewright.sources.sinks import _files, replace, touched, write_partitioned


def latest_snapshot(df: DataFrame, args: Sequence[str], snapshot_key: str) -> DataFrame:
    """Of snapshots with equal arguments the one of the greatest key; rows without a key stay."""
    last = df.groupBy(*args).agg(F.max(F.when(F.col(snapshot_key) != "", F.col(snapshot_key))).alias("__last"))
    keyed = F.coalesce(F.col(snapshot_key), F.lit("")) != ""
    met = df.withColumns({f"__a{k}": F.col(a) for k, a in enumerate(args)})
    last = last.withColumnsRenamed({a: f"__b{k}" for k, a in enumerate(args)})
    condition = F.lit(True)
    for k in range(len(args)):
        condition = condition & F.col(f"__a{k}").eqNullSafe(F.col(f"__b{k}"))
    return met.join(last, condition).where(~keyed | (F.col(snapshot_key) == F.col("__last"))).select(*df.columns)


def overlap_reload(old: DataFrame, new: DataFrame, keys: Sequence[str], version_column: str) -> DataFrame:
    """Old and new rows of a range that was fetched again: the later version of each key wins."""
    rest = [c for c in old.columns if c not in (*keys, version_column)]
    return latest_per_key(old.unionByName(new), keys, [f"-{version_column}", *rest])


def merge_reload(spark: SparkSession, target: str, new: DataFrame, keys: Sequence[str], version_column: str, partitioning: Sequence[str]) -> DataFrame:
    """``overlap_reload`` into a partitioned dataset, of which only the partitions that the new rows hit are read and written.

    The partition columns are among the keys, so that a row stays in its partition. Returns what was written.
    """
    if not set(partitioning) <= set(keys):
        raise ValueError("partition columns must be keys: a row of another version would be in another partition")
    schema = new.schema
    fs, at = _files(spark, target)
    old = spark.read.schema(schema).parquet(target) if fs.exists(at(target)) else spark.createDataFrame([], schema)
    merged = written(overlap_reload(touched(old, new, partitioning), new, keys, version_column), "merged")
    write_partitioned(merged, target, partitioning)
    return merged


def _escaped(value: str | None) -> str:
    """A partition's value as Spark writes it in the folder's name."""
    if value is None or value == "":
        return "__HIVE_DEFAULT_PARTITION__"
    return re.sub(r"[\x00-\x1f\x7f\"#%'*/:=?\\{\[\]^]", lambda m: f"%{ord(m[0]):02X}", value)


def ingest_files(
    spark: SparkSession,
    source_dir: str,
    parse: Callable[[DataFrame], DataFrame],
    target: str,
    partitioning: Sequence[str],
    ledger: str,
    file_key: Column | None = None,
    max_files: int = 10_000,
) -> int:
    """Parses the files that are new or changed since the last call; returns how many.

    ``ledger`` is a table of (source, modified, length, the partitions that the file's rows are in). A row's last partition column is
    its ``source``, so files of one partition stand side by side, and a file that was fetched again replaces its own rows and no
    others, also where they have moved to other partitions. ``file_key`` (a column over ``file``, the path) names a file in the ledger; by
    default its name without the folder. Of files with one key the one modified last counts. Rows are written before the ledger, so that
    a call that stopped is done again in full. Spark lists no files of zero bytes: a file that was emptied keeps its rows. ``parse`` gets text lines (value, file) and keeps ``file``.
    """
    fs, at = _files(spark, ledger)
    key = F.element_at(F.split("file", "/"), -1) if file_key is None else file_key
    entry = "source string, modified timestamp, length long, places array<array<string>>"
    known = spark.read.schema(entry).parquet(ledger) if fs.exists(at(ledger)) else spark.createDataFrame([], entry)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source_dir)
    listed = listed.select("path", F.col("_metadata.file_path").alias("file"), F.col("modificationTime").alias("modified"), "length")
    listed = latest_per_key(listed.withColumn("source", key), ["source"], ["-modified", "-file"])
    same = known.select("source", "modified", "length")
    pending = written(listed.join(same, ["source", "modified", "length"], "left_anti"), "pending")
    done = 0
    while True:
        batch = pending.orderBy("modified", "source").offset(done).limit(max_files).collect()
        if not batch:
            return done
        sources = [r["source"] for r in batch]
        lines = spark.read.text([r["path"] for r in batch]).select("value", F.col("_metadata.file_path").alias("file"))
        rows = parse(lines).withColumn("source", key).drop("file")
        rows = written(rows, "parsed")
        write_partitioned(rows, target, [*partitioning, "source"])
        place = F.array(*[F.col(c).cast("string") for c in partitioning]).cast("array<string>")
        now = rows.groupBy("source").agg(F.collect_set(place).alias("places"))
        entries = spark.createDataFrame([(r["source"], r["modified"], r["length"]) for r in batch], "source string, modified timestamp, length long")
        entries = entries.join(now, "source", "left").select("source", "modified", "length", F.coalesce("places", F.array().cast("array<array<string>>")).alias("places"))
        entries = written(entries, "entries")
        before = known.where(F.col("source").isin(sources)).select("source", F.explode("places").alias("place"))
        left = before.join(entries.select("source", F.explode("places").alias("place")), ["source", "place"], "left_anti")
        for r in left.toLocalIterator():  # places that the file's rows have left
            steps = [f"{c}={_escaped(v)}" for c, v in zip([*partitioning, "source"], [*r["place"], r["source"]], strict=True)]
            fs.delete(at("/".join((target, *steps))), True)
        known = written(known.where(~F.col("source").isin(sources)).unionByName(entries), "ledger")
        replace(spark, ledger, lambda staged, rows=known: rows.write.parquet(staged))
        done += len(batch)


def ingest_new_files(
    spark: SparkSession,
    source_dir: str,
    parse: Callable[[DataFrame], DataFrame],
    target: str,
    partitioning: Sequence[str],
    checkpoint: str,
    max_files: int | None = None,
    replace: bool = True,
) -> None:
    """Parses the files that were not seen before and replaces their partitions; ends when none is left.

    ``parse`` gets text lines (value, file). A repeated run changes nothing. A later batch replaces the partitions that
    it has, as a file that was fetched again does. Where files of one partition come bit by bit, ``replace=False`` keeps
    all of them: each batch then writes its own ``batch=N`` folder inside the partition, which a repeated batch replaces.
    """
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.load(source_dir).select("value", F.col("_metadata.file_path").alias("file"))

    def write(batch: DataFrame, number: int) -> None:
        rows = parse(batch)
        if replace:
            write_partitioned(rows, target, partitioning)
        else:
            write_partitioned(rows.withColumn("batch", F.lit(number)), target, [*partitioning, "batch"])

    query = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
