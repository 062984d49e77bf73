"""Exact deduplication by distributed most-significant-digit radix partitioning.

Every document is cut into successive byte strings of its lower-cased text: 64 bytes, then 256,
1024 and so on. A group starts as all documents; at each level it is split by the level's bytes.
Groups of one row leave at once, groups whose texts have ended are copies, and only the others go
on, so the number of rounds grows with the logarithm of the longest text and the rows in them with
the number of copies. Equality is that of the bytes themselves; the digest is only reported.

Group sizes are counted with map-side partial sums and joined back, so that a group with a third of
all rows is never gathered in one task: the join's hot key is a plain skewed join, which adaptive
execution splits.

Defined results: a null or empty text is an empty text and a copy of every other one; a null doc_id
counts as smaller than any other; of rows that repeat both doc_id and text, exactly one is kept;
further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.llm.util import LOWER, named, saved

FIRST_WIDTH = 64
GROWTH = 4
MAX_WIDTH = 1 << 20
# every level's width is bounded, so that no row carries more than 1 MB of a text

_CHUNKS = "row_id long, doc_id long, text_sha256 string, level int, chunk binary"


def widths(first: int = FIRST_WIDTH, growth: int = GROWTH, most: int = MAX_WIDTH) -> Iterator[int]:
    width = first
    while True:
        yield width
        width = min(width * growth, most)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (row, level, bytes); the last one of a text is shorter than its level's width."""
    for batch in batches:
        out: tuple[list, ...] = ([], [], [], [], [])
        size = 0
        for row, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            data = (text or "").encode("utf-8", "surrogatepass").translate(LOWER)
            digest, at = hashlib.sha256(data).hexdigest(), 0
            for level, width in enumerate(widths()):
                piece = data[at : at + width]
                for column, value in zip(out, (row, doc, digest if not level else None, level, piece), strict=True):
                    column.append(value)
                at += width
                size += len(piece)
                if len(piece) < width:
                    break
            if size > 8 << 20:
                yield _batch(out)
                out, size = ([], [], [], [], []), 0
        yield _batch(out)


def _batch(columns: tuple[list, ...]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.binary())
    names = ("row_id", "doc_id", "text_sha256", "level", "chunk")
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts (after lower-casing A-Z), the row with the largest id is kept.
    """
    id_of, text_of = named(id_column, text_column)
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), id_of.cast("long").alias("doc_id"), text_of.alias("text"))
    # written once: row numbers stay the same from here on, also when an executor is lost
    chunks = saved(rows.mapInArrow(_cut, _CHUNKS), "radix", ("level",))
    base = chunks.where("level = 0").select("row_id", "doc_id", "text_sha256")
    active = base.select("row_id", "doc_id", F.lit(0).cast("long").alias("part"))
    copies: list[DataFrame] = []
    for level, width in enumerate(widths()):
        here = chunks.where(F.col("level") == level)
        if level == 0:
            rows = here.select("row_id", "doc_id", F.lit(0).cast("long").alias("part"), "chunk")
        else:
            # always a merge join: the bytes moved then follow the input, however few rows are active
            rows = active.hint("merge").join(here.select("row_id", "chunk"), "row_id")
        counted = rows.groupBy("part", "chunk").agg(
            F.count("*").alias("n"),
            F.min("row_id").alias("next"),
            F.max(F.struct("doc_id", "row_id")).alias("last"),
        )
        shared = saved(counted.where("n > 1"), "radix-groups")
        ended = F.octet_length("chunk") < width
        met = saved(
            rows.join(shared, ["part", "chunk"]).select(
                "row_id", "doc_id", "n", F.col("next").alias("part"), "last", ended.alias("ended")
            ),
            "radix-rows",
        )
        copies.append(met.where("ended"))
        active = met.where("not ended").select("row_id", "doc_id", "part")
        if active.isEmpty():
            break
    found = copies[0]
    for more in copies[1:]:
        found = found.unionByName(more)
    found = found.select("row_id", "n", F.col("last.doc_id").alias("keep"), F.col("last.row_id").alias("keep_row"))
    alone = F.col("n").isNull()
    return base.join(found, "row_id", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row_id") == F.col("keep_row"))).alias("kept"),
        "text_sha256",
    )
