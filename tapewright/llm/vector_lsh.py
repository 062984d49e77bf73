"""Near-duplicates of vectors by Euclidean p-stable hashing with exact cosine checks.

Vectors are normalised, so that a cosine is a distance: cosine 0.9 is distance 0.447. A hash is the number of the interval of
width ``WIDTH`` (in units of that distance) in which a random Gaussian projection falls; a table's bucket is named by ``k`` such
hashes. ``k`` grows with the logarithm of the number of vectors, so that orthogonal ones share about one bucket a table and
vector, and the number of tables follows from the recall asked for at the threshold itself (``tables``); pairs that are nearer
are found nearly always.

Equal vectors are one from the start, with a weight. Then hot groups are folded into balls: every vector takes the
bucket's least name as its centre if it is within half the threshold's distance, so that any two of a ball are
linked by the triangle inequality and need no comparison. Balls that share a bucket are compared by their centres: too far for any link, so near that
all are links, or undecided. Only undecided ones are compared member by member, in blocks of about ``BLOCK``, which hand back counts and not
pairs. So a group of near copies with a third of all rows costs as many rows as it has members. What stays
quadratic is a group that is spread over the whole width of the threshold, as its links must be counted one by one.

Distances decide with a margin far over rounding; between the margins cosines are computed from the vectors in double
precision. Names of vectors are 128-bit digests of their components.

Defined results: a vector that is null, empty, zero or has null or non-finite components (or a norm that overflows) has no
links and is its own component; vectors of different lengths are never linked; rows with the same id and equal vectors count as vectors
of their own; null ids are left out of the least id of a component, which is null where it has no other; an empty
table gives no rows; further columns of any name are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.llm.components import components
from tapewright.llm.util import named, saved

COSINE = 0.9
RECALL = 0.95  # of pairs right at the threshold
WIDTH = 5.0  # of an interval, in units of the threshold's distance
BLOCK = 128
MARGIN = 1e-9  # on distances of unit vectors: many times the rounding of a sum of doubles
MIN_HASHES = 4
SEED = 20

_VECTORS = "name binary, id long, vector array<double>, dims int"


def _meets(ratio: float) -> float:
    """The chance that vectors share an interval ``ratio`` times as wide as they are apart."""
    return math.erf(ratio / math.sqrt(2)) - math.sqrt(2 / math.pi) / ratio * (1 - math.exp(-(ratio**2) / 2))


def tables(count: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """(hashes a table, tables) for so many vectors."""
    near = math.sqrt(2 - 2 * cosine)
    far = _meets(WIDTH * near / math.sqrt(2))
    hashes = max(MIN_HASHES, math.ceil(math.log(max(count, 2)) / -math.log(far)))
    return hashes, math.ceil(math.log(1 - recall) / math.log(1 - _meets(WIDTH) ** hashes))


def unit_of(vector: list | None) -> np.ndarray | None:
    """The vector at length one; None if it can have no links."""
    if not vector or None in vector:
        return None
    found = np.array(vector, np.float64)
    top = np.abs(found).max()
    if not np.isfinite(top) or top == 0:
        return None
    found = found / top  # so that squares neither overflow nor vanish
    return found / math.sqrt(float(found @ found))


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, ids, vectors = [], [], []
        for doc, vector in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            unit = unit_of(vector)
            names.append(None if unit is None else hashlib.blake2b((np.array(vector, np.float64) + 0.0).tobytes(), digest_size=16).digest())
            ids.append(doc)
            vectors.append(unit)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.binary()), pa.array(ids, pa.int64()), pa.array(vectors, pa.list_(pa.float64())), pa.array([None if v is None else len(v) for v in vectors], pa.int32())],
            names=["name", "id", "vector", "dims"],
        )


def _hashed(hashes: int, count: int, cosine: float):
    """Adds the names of a vector's buckets in all tables."""
    width = WIDTH * math.sqrt(2 - 2 * cosine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            out = []
            for vector in batch.column(1).to_pylist():
                dims = len(vector)
                if dims not in drawn:
                    rng = np.random.default_rng([SEED, dims])
                    odd = rng.integers(1, 1 << 62, hashes, np.int64) * 2 + 1
                    drawn[dims] = rng.standard_normal((count * hashes, dims)), rng.uniform(0, width, count * hashes), odd
                lines, shifts, odd = drawn[dims]
                places = np.floor((lines @ np.array(vector) + shifts) / width).astype(np.int64).reshape(count, hashes)
                with np.errstate(over="ignore"):
                    mixed = (places * odd).sum(1)
                    mixed ^= mixed >> 29
                    out.append(mixed * np.int64(0x5851F42D4C957F2D) + dims)
            buckets = pa.array(out, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), buckets], names=["name", "buckets"])

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of one length as a matrix."""
    return np.array(column.flatten()).reshape(len(column), -1)


def _apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All columns but the last two, which are vectors, and their distance and cosine."""
    for batch in batches:
        distance, cosine = np.zeros(len(batch)), np.zeros(len(batch))
        *kept, a, b = batch.columns
        lengths = np.array(a.value_lengths()) if len(batch) else np.array([], int)
        for dims in np.unique(lengths):
            rows = np.flatnonzero(lengths == dims)
            x, y = (_matrix(c.take(pa.array(rows))) for c in (a, b))
            distance[rows] = np.sqrt(((x - y) ** 2).sum(1))
            cosine[rows] = (x * y).sum(1)
        yield pa.RecordBatch.from_arrays([*kept, pa.array(distance), pa.array(cosine)], names=[*batch.schema.names[:-2], "distance", "cosine"])


def _block_links(cosine: float) -> Callable:
    """(side, ball, name, linked weight) of the members of two blocks that are linked with the other block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                row = batch.slice(at, 1).to_pylist()[0]
                x, y = np.array([m["vector"] for m in row["x"]]), np.array([m["vector"] for m in row["y"]])
                linked = np.array([(x * v).sum(1) for v in y]).T >= cosine
                out: tuple[list, ...] = ([], [], [], [])
                for own, other, met, weights in (("a", "b", linked, row["y"]), ("b", "a", linked.T, row["x"])):
                    total = met @ np.array([m["weight"] for m in weights], np.int64)
                    for i in np.flatnonzero(total):
                        members = row["x"] if own == "a" else row["y"]
                        for column, value in zip(out, (row[own], row[other], members[i]["name"], int(total[i])), strict=True):
                            column.append(value)
                kinds = (pa.binary(), pa.binary(), pa.binary(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["ball", "other", "name", "links"])

    return run


def _with_vectors(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Pairs (a, b) with both vectors, in the columns last."""
    one = vectors.select(F.col("name").alias("a"), F.col("vector").alias("of_a"))
    two = vectors.select(F.col("name").alias("b"), F.col("vector").alias("of_b"))
    kept = [c for c in pairs.columns if c not in ("a", "b")]
    return pairs.join(one, "a").join(two, "b").select("a", "b", *kept, "of_a", "of_b")


def _balls(rows: DataFrame, vectors: DataFrame, near: float) -> DataFrame:
    """(name, ball, away): the centre that a vector takes, itself if no other is near enough, and how far it is."""
    least = rows.groupBy("table", "bucket").agg(F.min("name").alias("b"), F.count("*").alias("n")).where("n > 1")
    centres = rows.join(least, ["table", "bucket"]).where("name != b").select(F.col("name").alias("a"), "b").distinct()
    met = _with_vectors(centres, vectors).mapInArrow(_apart, "a binary, b binary, distance double, cosine double")
    taken = met.where(F.col("distance") <= near / 2 - MARGIN).groupBy("a").agg(F.min(F.struct("b", "distance")).alias("centre"))
    found = vectors.select("name").join(taken, F.col("name") == F.col("a"), "left")
    return found.select("name", F.coalesce("centre.b", "name").alias("ball"), F.coalesce("centre.distance", F.lit(0.0)).alias("away"))


def vector_links(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", cosine: float = COSINE, recall: float = RECALL
) -> DataFrame:
    """(id, n_links, component_id) of every row; cosine is over 0.5, recall below 1."""
    near = math.sqrt(2 - 2 * cosine)
    id_of, vector_of = named(id_column, vector_column)
    rows = vectors.select(id_of.cast("long").alias("id"), vector_of.cast("array<double>").alias("vector"))
    rows = saved(rows.mapInArrow(_named, _VECTORS), "vectors")
    own = rows.where("name is not null").groupBy("name").agg(F.count("*").alias("weight"), F.min("id").alias("least"), F.first("vector").alias("vector"), F.first("dims").alias("dims"))
    own = saved(own, "distinct")
    hashes, count = tables(own.count(), cosine, recall)
    buckets = own.select("name", "vector").mapInArrow(_hashed(hashes, count, cosine), "name binary, buckets array<long>")
    buckets = saved(buckets, "buckets")
    placed = buckets.select("name", F.posexplode("buckets").alias("table", "bucket"))
    inside = saved(_balls(placed, own, near), "balls")

    members = inside.join(own, "name")
    balls = members.groupBy("ball").agg(F.sum("weight").alias("weight"), F.min("least").alias("least"), F.max("away").alias("radius"), F.count("*").alias("n"))
    balls = saved(balls, "sizes")
    of_balls = buckets.join(inside.select("name", "ball"), "name").select("ball", F.posexplode("buckets").alias("table", "bucket")).distinct()
    of_balls = saved(of_balls, "places")
    left, right = of_balls.withColumnRenamed("ball", "a"), of_balls.withColumnRenamed("ball", "b")
    pairs = left.join(right, ["table", "bucket"]).where("a < b").select("a", "b").distinct()
    one = balls.select(F.col("ball").alias("a"), F.col("radius").alias("radius_a"), F.col("weight").alias("weight_a"), F.col("n").alias("n_a"))
    two = balls.select(F.col("ball").alias("b"), F.col("radius").alias("radius_b"), F.col("weight").alias("weight_b"), F.col("n").alias("n_b"))
    pairs = pairs.join(one, "a").join(two, "b")
    kept = ", ".join(f"{c} {t}" for c, t in pairs.select([c for c in pairs.columns if c not in ("a", "b")]).dtypes)
    met = _with_vectors(pairs, own).mapInArrow(_apart, f"a binary, b binary, {kept}, distance double, cosine double")
    reach = F.col("radius_a") + F.col("radius_b")
    alone = (F.col("n_a") == 1) & (F.col("n_b") == 1) & (F.col("radius_a") == 0) & (F.col("radius_b") == 0)
    every = F.when(alone, F.col("cosine") >= cosine).otherwise(F.col("distance") + reach <= near - MARGIN)
    none = F.when(alone, F.col("cosine") < cosine).otherwise(F.col("distance") - reach > near + MARGIN)
    met = saved(met.where(~none).withColumn("every", every), "met")

    sure = met.where("every")
    whole = sure.select(F.col("a").alias("ball"), F.col("weight_b").alias("links")).unionByName(sure.select(F.col("b").alias("ball"), F.col("weight_a").alias("links")))
    blocks = members.join(balls.select("ball", "n"), "ball").withColumn("block", F.pmod(F.xxhash64("name"), F.ceil(F.col("n") / BLOCK)))
    blocks = blocks.groupBy("ball", "block").agg(F.collect_list(F.struct("name", "weight", "vector")).alias("x"))
    open_pairs = met.where("not every").select("a", "b")
    facing = open_pairs.join(blocks.select(F.col("ball").alias("a"), "x"), "a").join(blocks.select(F.col("ball").alias("b"), F.col("x").alias("y")), "b")
    checked = saved(facing.select("a", "b", "x", "y").mapInArrow(_block_links(cosine), "ball binary, other binary, name binary, links long"), "checked")

    edges = sure.select("a", "b").unionByName(checked.select(F.col("ball").alias("a"), F.col("other").alias("b"))).distinct()
    labels = components(edges)
    joined = balls.join(labels, F.col("ball") == F.col("node"), "left").select("ball", "least", "weight", F.coalesce("label", "ball").alias("label"))
    joined = saved(joined, "labelled")
    lowest = joined.groupBy("label").agg(F.min("least").alias("component_id"))
    total = whole.groupBy("ball").agg(F.sum("links").alias("more"))
    per_ball = joined.join(lowest, "label").join(total, "ball", "left").select("ball", "component_id", (F.col("weight") - 1 + F.coalesce("more", F.lit(0))).alias("base"))
    extra = checked.groupBy("name").agg(F.sum("links").alias("extra"))
    per_name = inside.select("name", "ball").join(per_ball, "ball").join(extra, "name", "left")
    per_name = per_name.select("name", "component_id", (F.col("base") + F.coalesce("extra", F.lit(0))).alias("n_links"))
    linked = rows.where("name is not null").join(per_name, "name").select("id", "n_links", "component_id")
    apart = rows.where("name is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(apart)


def vector_report(vectors: DataFrame, id_column: str = "vec_id", **options) -> DataFrame:
    """(vec_id, n_links, component_id, kept): of each component the vector with the least id is kept."""
    found = vector_links(vectors, id_column, **options)
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
