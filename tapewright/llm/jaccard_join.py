"""Near-duplicate documents by an n-gram Jaccard join with adaptive multi-match prefixes.

A document is its set of distinct word shingles. Two documents link when their Jaccard similarity is
at least ``percent`` hundredths. Identical word sequences are one class from the start. All shingles
have one global order: rare ones by hash, then the frequent ones by frequency, the frequent ones
being known from summaries of every task's documents (bounded; they steer the order and the cost
estimate, never the result).

With r(n) the least overlap that a set of n needs, two similar sets share at least ``l`` of the first
n - r(n) + l shingles of each. A class takes l = 1 where its prefix is cheap; where the frequencies
in its prefix predict many candidates it takes a longer prefix and asks for more shared shingles. For
a pair the smaller l of the two holds, and the sizes of both raise the number asked for further, to
o - r + l with o the overlap that this pair would need.

Pairs are not expanded inside a group. In ``ROUNDS`` rounds every prefix shingle names one of its classes a
centre, every class is checked against the best centre that it meets often enough, and what links is
merged (one round is enough where groups are edits of one text). Only pairs that are still in different components are then enumerated and checked, which is
what makes the result exact: a link between two texts is either found or already implied by
a path of links. Checks are made on whole sets of shingles, made anew from the texts.

Defined results: null, empty and blank texts have no shingles and link with nothing; a text with fewer
words than a shingle is one shingle; repeated rows are one class; a null id never names a
component unless all its ids are null; further columns are ignored or kept. Shingles and word sequences are told apart by
64-bit hashes: of 10^9 different sequences two have the same one with a chance of 1 in 37.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from pyspark.sql.window import Window

from tapewright.llm.components import components
from tapewright.llm.util import LOWER, at_most, fields_of, named, saved

FREQUENT = 100_000  # entries of the frequency table that every task gets (1.6 MB)
MAX_LEVEL = 8
SCAN_COST, CHECK_COST = 1.0, 20.0
ROUNDS = 1
_SLICE = 2_000_000  # shingles held at once
SEEN = 100_000  # classes that a task knows at once to pass over repeats

_C2, _C3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words between blanks, tabs and line ends."""
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()


def _mixed(x):
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _C2
    x = (x ^ (x >> np.uint64(27))) * _C3
    return x ^ (x >> np.uint64(31))


def shingles(words: list[bytes], k: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of k words."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(k, len(h))
    count = len(h) - width + 1
    z = np.full(count, width, np.uint64)
    for i in range(width):
        z += h[i : i + count] * np.uint64((0x9E3779B97F4A7C15 * (2 * i + 1)) % (1 << 64))  # another odd factor for each place
    return np.unique(_mixed(z))


def class_of(words: list[bytes]) -> int:
    return xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63)


def _least(n: int, percent: int) -> int:
    """The overlap that a set of n needs with any other."""
    return -(-percent * n // 100)


class _Frequencies:
    """Shingles that occur most often among a task's classes; bounded."""

    def __init__(self) -> None:
        self.tokens, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.held: list[np.ndarray] = []
        self.size = 0

    def add(self, tokens: np.ndarray) -> None:
        self.held.append(tokens)
        self.size += len(tokens)
        if self.size > _SLICE:
            self.settle()

    def settle(self) -> None:
        if not self.held:
            return
        tokens = np.concatenate(self.held)
        # only what shares its place in a small table of counts is sorted
        place = (tokens >> np.uint64(42)).astype(np.int64)
        tokens, counts = np.unique(tokens[np.bincount(place, minlength=1 << 22)[place] > 1], return_counts=True)
        often = counts > 1
        tokens = np.concatenate([self.tokens, tokens[often]])
        counts = np.concatenate([self.counts, counts[often]])
        self.tokens, back = np.unique(tokens, return_inverse=True)
        self.counts = np.bincount(back, counts, len(self.tokens)).astype(np.int64)
        if len(self.tokens) > FREQUENT:
            top = np.sort(np.argpartition(self.counts, -FREQUENT)[-FREQUENT:])
            self.tokens, self.counts = self.tokens[top], self.counts[top]
        self.held, self.size = [], 0


def _sets(k: int):
    """One row per document (id, class, size), then one per frequent shingle (token, df)."""
    names = ["doc_id", "class", "n", "token", "df"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequencies, seen = _Frequencies(), {}
        for batch in batches:
            classes, sizes = [], []
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                name = class_of(words)
                if name not in seen:
                    if len(seen) > SEEN:
                        seen.clear()
                    tokens = shingles(words, k)
                    seen[name] = len(tokens)
                    frequencies.add(tokens)
                classes.append(name)
                sizes.append(seen[name])
            none = pa.nulls(len(classes), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(classes, pa.int64()), pa.array(sizes, pa.int64()), none, none], names=names
            )
        frequencies.settle()
        none = pa.nulls(len(frequencies.tokens), pa.int64())
        found = [none, none, none, pa.array(frequencies.tokens.view(np.int64)), pa.array(frequencies.counts)]
        yield pa.RecordBatch.from_arrays([a.cast(t) for a, t in zip(found, kinds, strict=True)], names=names)

    return run


def level(df: np.ndarray, n: int, percent: int) -> int:
    """How many shared prefix shingles to ask for: the cheapest number by the estimate."""
    least = _least(n, percent)
    first = n - least + 1
    most = min(MAX_LEVEL, least)
    scanned = np.cumsum(df[: first + most - 1])[first - 1 :].astype(float)
    cost = scanned * SCAN_COST + scanned / np.arange(1, most + 1) * CHECK_COST
    return 1 + int(np.argmin(cost))


def _prefixes(k: int, percent: int, frequent: Broadcast):
    """(token, class, n, l, place of the token in the order) of every class that a task meets."""
    names = ["token", "class", "n", "l", "pos"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = frequent.value
        seen: set[int] = set()
        for batch in batches:
            held: list[list[np.ndarray]] = [[] for _ in names]
            size = 0
            for text in batch.column(0).to_pylist():
                words = words_of(text)
                name = class_of(words)
                if not words or name in seen:
                    continue
                if len(seen) > SEEN:
                    seen.clear()
                seen.add(name)
                tokens = shingles(words, k)
                n = len(tokens)
                df = np.zeros(n, np.int64)
                if len(known):
                    place = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
                    df = np.where(known[place] == tokens, counts[place], 0)
                often = np.flatnonzero(df)  # tokens are in the order of their hashes already
                order = np.concatenate([np.flatnonzero(df == 0), often[np.argsort(df[often], kind="stable")]])
                l = level(df[order], n, percent)  # noqa: E741
                first = n - _least(n, percent) + 1
                part = tokens[order[: first + l - 1]]
                for column, value in zip(held, (part.view(np.int64), name, n, l, np.arange(1, len(part) + 1)), strict=True):
                    column.append(value if isinstance(value, np.ndarray) else np.full(len(part), value, np.int64))
                size += len(part)
                if size > 500_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in held], names=names)
                    held, size = [[] for _ in names], 0
            if size:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in held], names=names)

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, compressed words) of every class that a task meets."""
    press, seen = zstandard.ZstdCompressor(level=1), set()
    for batch in batches:
        for at in range(0, len(batch), 500):
            names, data = [], []
            for text in batch.column(0).slice(at, 500).to_pylist():
                words = words_of(text)
                name = class_of(words)
                if words and name not in seen:
                    if len(seen) > SEEN:
                        seen.clear()
                    seen.add(name)
                    names.append(name)
                    data.append(press.compress(b" ".join(words)))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(data, pa.binary())], names=["class", "data"])


def _linked(k: int, percent: int):
    """Pairs whose sets are similar enough. Each row holds both texts; the sets of the last ones are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        kept: dict[int, np.ndarray] = {}
        size = 0
        for batch in batches:
            out = []
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            for a, b, data_a, data_b in rows:
                both = []
                for name, data in ((a, data_a), (b, data_b)):
                    if name not in kept:
                        if size > _SLICE:
                            kept, size = {}, 0
                        kept[name] = shingles(unpress.decompress(data).split(), k)
                        size += len(kept[name])
                    both.append(kept[name])
                x, y = both
                shared = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * shared >= percent * (len(x) + len(y) - shared):
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in out], pa.int64()) for i in (0, 1)], names=["a", "b"]
            )

    return run


def _checked(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link. b should vary more than a: rows end up dealt by b."""
    one = texts.select(F.col("class").alias("a"), F.col("data").alias("data_a"))
    other = texts.select(F.col("class").alias("b"), F.col("data").alias("data_b"))
    both = pairs.join(one, "a").join(other, "b").select("a", "b", "data_a", "data_b")
    return both.mapInArrow(_linked(k, percent), "a long, b long")


def _may_link(n: Column, m: Column, percent: int) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _least_of(n: Column, percent: int) -> Column:
    return F.ceil(n * percent / 100 - 1e-9)


def _overlap(n: Column, m: Column, percent: int) -> Column:
    """Shingles that sets of n and m share at least if they link."""
    return F.ceil((n + m) * percent / (100 + percent) - 1e-9)


def _asked(n: Column, m: Column, l: Column, percent: int) -> Column:  # noqa: E741
    """Shared prefix shingles that a pair of sizes n and m must have at level l."""
    return _overlap(n, m, percent) - _least_of(F.greatest(n, m), percent) + l


def _level_of(pos: Column, n: Column, percent: int) -> Column:
    """The least level whose prefix holds the shingle at this place."""
    return F.greatest(F.lit(1), pos - (n - _least_of(n, percent)))


def _shared(prefixes: DataFrame) -> DataFrame:
    """The rows whose token two classes have, once each. Most tokens have one: all rows are dealt by token once, and only these are kept."""
    own = Window.partitionBy("token")
    both = prefixes.withColumns({"low": F.min("class").over(own), "high": F.max("class").over(own)})
    return both.where("low != high").drop("low", "high").dropDuplicates(["token", "class"])


def _placed(rows: DataFrame, percent: int) -> DataFrame:
    """Adds met (how many shingles of its prefix a class shares) and place.

    place orders a class's prefix anew: what no other class has comes first, then the shared shingles by how many
    classes have them. Any order that all classes follow will do, as the same shingles are in the prefix.
    """
    often = rows.groupBy("token").agg(F.count("*").alias("df"))
    own = Window.partitionBy("class")
    rows = rows.join(often, "token").withColumns(
        {"met": F.count("*").over(own), "rank": F.row_number().over(own.orderBy("df", "token"))}
    )
    length = F.col("n") - _least_of(F.col("n"), percent) + F.col("l")
    return rows.withColumn("place", length - F.col("met") + F.col("rank")).drop("df", "rank")


def _first_common(n: Column, m: Column, percent: int) -> Column:
    """The last place in a prefix of n's at which the first shingle shared with a set of m can be.

    A pair shares ``asked`` shingles of both prefixes, so the first of them has that many less one after it. For a
    prefix that is longer than the pair's level asks, the place moves by as much.
    """
    return n - _least_of(n, percent) + _least_of(F.greatest(n, m), percent) - _overlap(n, m, percent) + 1


def _round(rows: DataFrame, number: int, percent: int) -> DataFrame:
    """(a, b): for each class b the centre a that it shares most prefix shingles with.

    ``rows``: token, class, n, l, pos, label, met. A token's centre is its class of highest priority; priorities
    are the same for all tokens, so that classes of one group meet the same few centres. At first that is the
    class which shares the most of its prefix, as the text that others are edits of does; later a random one.
    """
    own = F.lit(0) if number else F.col("met") * 1000 / (F.col("n") - _least_of(F.col("n"), percent) + F.col("l"))
    priority = F.struct(own.cast("long").alias("own"), F.xxhash64("class", F.lit(number)).alias("random"))
    centre = F.max(F.struct(priority.alias("p"), "class", "n", "l", "pos", "label")).alias("c")
    groups = rows.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"), centre)
    groups = groups.where("low != high").select("token", "c")
    met = rows.join(groups, "token").where(F.col("label") != F.col("c.label"))
    met = met.where(_may_link(F.col("n"), F.col("c.n"), percent))
    lower = F.least(F.col("l"), F.col("c.l"))
    met = met.where(_level_of(F.col("pos"), F.col("n"), percent) <= lower)
    met = met.where(_level_of(F.col("c.pos"), F.col("c.n"), percent) <= lower)
    asked = _asked(F.col("n"), F.col("c.n"), lower, percent)
    pairs = met.groupBy(F.col("c.class").alias("a"), F.col("class").alias("b"), asked.alias("asked")).agg(F.count("*").alias("s"))
    pairs = pairs.where(F.col("s") >= F.col("asked"))
    return pairs.groupBy("b").agg(F.max(F.struct("s", "a")).alias("best")).select(F.col("best.a").alias("a"), "b")


def _rest(rows: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of classes in different components that share enough prefix shingles.

    Pairs come from the places where their first shared shingle can be; then the shared ones of
    their prefixes are counted. A class's list is bounded by its own prefix.
    """
    mixed = rows.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high")
    some = saved(rows.join(mixed.select("token"), "token"), "mixed")
    one = some.select("token", *[F.col(c).alias(f"{c}_1") for c in ("class", "n", "l", "place", "label")])
    two = some.select("token", *[F.col(c).alias(f"{c}_2") for c in ("class", "n", "l", "place", "label")])
    n, m, lower = F.col("n_1"), F.col("n_2"), F.least("l_1", "l_2")
    met = one.join(two, "token").where(
        (F.col("class_1") < F.col("class_2"))
        & (F.col("label_1") != F.col("label_2"))
        & _may_link(n, m, percent)
        & (F.col("place_1") <= _first_common(n, m, percent) + F.col("l_1") - lower)
        & (F.col("place_2") <= _first_common(m, n, percent) + F.col("l_2") - lower)
    )
    asked = _asked(n, m, lower, percent)
    pairs = met.select(F.col("class_1").alias("a"), F.col("class_2").alias("b"), lower.alias("lower"), asked.alias("asked")).distinct()
    at = _level_of(F.col("pos"), F.col("n"), percent)
    lists = rows.groupBy("class").agg(F.collect_list(F.struct("token", at.alias("at"))).alias("tokens"))

    def within(column: str) -> Column:
        return F.transform(F.filter(column, lambda x: x["at"] <= F.col("lower")), lambda x: x["token"])

    both = pairs.join(lists.select(F.col("class").alias("a"), F.col("tokens").alias("tokens_a")), "a")
    both = both.join(lists.select(F.col("class").alias("b"), F.col("tokens").alias("tokens_b")), "b")
    return both.where(F.size(F.array_intersect(within("tokens_a"), within("tokens_b"))) >= F.col("asked")).select("a", "b")


def _merged(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """Labels after more edges: components of the labels' own graph, which gets smaller from round to round."""
    if labels is None:
        return components(edges)
    a = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    b = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    lifted = edges.join(a, "a", "left").join(b, "b", "left")
    lifted = lifted.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).where("a != b").distinct()
    higher = components(lifted)
    up = higher.select(F.col("node").alias("label"), F.col("label").alias("top"))
    moved = labels.join(up, "label", "left").select("node", F.coalesce("top", "label").alias("label"))
    return saved(moved.unionByName(higher.join(labels.select("node"), "node", "left_anti")), "labels")


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return rows.withColumn("label", F.col("class"))
    known = labels.select(F.col("node").alias("class"), "label")
    return rows.join(known, "class", "left").withColumn("label", F.coalesce("label", "class"))


def link_components(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = 5, percent: int = 80
) -> DataFrame:
    """One row per input row: doc_id, class, n_shingles, component_id (the least id that links reach)."""
    context = docs.sparkSession.sparkContext
    (id_of,), (text_of,) = named(id_column), named(text_column)
    rows = docs.select(id_of.cast("long").alias("doc_id"), text_of.alias("text"))
    texts = rows.select("text")
    found = saved(rows.mapInArrow(_sets(k), "doc_id long, class long, n long, token long, df long"), "sets")
    sets = found.where("token is null").select("doc_id", "class", "n")
    top = saved(found.where("token is not null").groupBy("token").agg(F.sum("df").alias("df")), "frequent")
    top = sorted((r["token"] % (1 << 64), r["df"]) for r in at_most(top, F.col("df"), FREQUENT).collect())
    frequent = context.broadcast((np.array([t for t, _ in top], np.uint64), np.array([d for _, d in top], np.int64)))
    prefixes = texts.mapInArrow(_prefixes(k, percent, frequent), "token long, class long, n long, l long, pos long")
    met = saved(_shared(prefixes), "shared")
    met = saved(_placed(met, percent), "placed")
    wanted = met.select("class").distinct()
    packed = texts.mapInArrow(_packed, "class long, data binary")
    packed = saved(packed.join(wanted, "class", "left_semi").dropDuplicates(["class"]), "texts")

    labels = None
    for number in range(ROUNDS + 1):
        now = _labelled(met, labels)
        pairs = _round(now, number, percent) if number < ROUNDS else _rest(now, percent)
        new = saved(_checked(pairs, packed, k, percent), "links")
        if not new.isEmpty():
            labels = _merged(labels, new)

    classes = sets.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("first"))
    labelled = _labelled(classes, labels)
    least = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    labelled = saved(labelled.join(least, "label").select("class", "component_id"), "components")
    linked = sets.where("n > 0").join(labelled, "class").select("doc_id", "class", "n", "component_id")
    alone = sets.where("n = 0").select("doc_id", "class", "n", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumnRenamed("n", "n_shingles")


def component_report(docs: DataFrame, **options) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id."""
    return link_components(docs, **options).select("doc_id", "n_shingles", "component_id")


@F.arrow_udf(LongType())
def _class_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([class_of(words_of(text.as_py())) for text in batch], pa.int64())


def near_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The input's rows and columns, with one row of each component: the one of the least id.

    Rows without words and rows without id stay, and so do all rows that repeat the id and words of one that stays.
    """
    found = link_components(docs, id_column, text_column, **options)
    gone = found.where("n_shingles > 0 and doc_id is not null and doc_id != component_id").select("doc_id", "class").distinct()
    (id_of,), (text_of,) = named(id_column), named(text_column)
    rows = docs.select(F.struct(*named(*docs.columns)).alias("row"), id_of.cast("long").alias("doc_id"), _class_of(text_of).alias("class"))
    return rows.join(gone, ["doc_id", "class"], "left_anti").select(*fields_of(docs))
