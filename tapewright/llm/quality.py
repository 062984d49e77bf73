"""Quality by hierarchical empirical Bayes: a document classifier's evidence, corrected by its site.

Each document gets a few integer features of its form (symbols, capitals, digits, word lengths,
repetition, separators) and one of its words: the mean log-odds of its distinct words, by hashed words of the labelled
documents. The features' log-odds on labelled rows, smoothed towards zero, add up to the document's evidence.
Labelled rows are dealt to ``FOLDS``, and a row is judged by tables that were learnt without its own fold, so
that no label speaks for itself; all others are judged by the tables of all folds.
Then the documents' posteriors are pooled: a host's share of good text is shrunk towards the global
share, a path's towards its host's. How strongly follows from the groups themselves (method of
moments), so that a site with few documents says little and a large one speaks for itself. A document
is judged by its own evidence with its path's posterior as prior, its own part in that left out.

Host and path sums are grouped aggregations with map-side combination; a host with a third of all rows is one partial row
a task. The classifier's tables are bounded (features x ``BINS`` rows and ``BUCKETS`` words a fold), learnt from at most about
``TRAINING_ROWS`` labelled rows.

Defined results: a null or empty text has the features of an empty text; a null host or path is a group of its
own; rows that repeat are rows of their own; without labels all evidence is 0 and the global share 0.5; labels with a null id or value
are ignored and a row repeated in the labels counts once, as bad if any of its rows is; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewright.llm.util import LOWER, named, saved, schema_of

TRAINING_ROWS = 200_000
BINS = 16
BUCKETS = 1 << 16
FOLDS = 4
SMOOTH = 2.0
WORD_SMOOTH = 4.0
DAMPING = 0.5  # the features overlap: their sum is halved
KEEP = 0.5
FEATURES = ("symbols", "capitals", "digits", "separators", "marks", "word_length", "distinct", "lines", "size", "words")

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = b"0123456789"
_SYMBOLS = b"%$#&*@^~_=<>{}[]\\/+"
_SEPARATORS = b"|;\t"
_MARKS = b"!?"


def _share_bin(part: int, whole: int) -> int:
    """0 for none, else by halvings of the share: 15 is more than a half."""
    if not part or not whole:
        return 0
    return min(BINS - 1, max(1, BINS - 1 + math.ceil(math.log2(part / whole))))


def features(text: str | None) -> list[int]:
    """Bins of the document's form."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    n, count = len(data), len(words)
    lines = [x for x in data.split(b"\n") if x.strip()]

    def of(chars: bytes) -> int:
        return n - len(data.translate(None, chars))

    letters = sum(map(len, words))
    return [
        _share_bin(of(_SYMBOLS), n),
        _share_bin(of(_UPPER), n),
        _share_bin(of(_DIGITS), n),
        _share_bin(of(_SEPARATORS), max(count, 1)),
        _share_bin(of(_MARKS), max(count, 1)),
        min(BINS - 1, round(letters / count)) if count else 0,
        min(BINS - 1, int(len(set(words)) / count * (BINS - 1))) if count else 0,
        _share_bin(len(lines) - len(set(lines)), len(lines)),
        min(BINS - 1, count.bit_length()),
    ]


def buckets(text: str | None) -> np.ndarray:
    """Hash buckets of the document's distinct words, letters' case aside."""
    words = set((text or "").encode("utf-8", "surrogatepass").translate(LOWER).split())
    return np.fromiter((xxhash.xxh3_64_intdigest(w) % BUCKETS for w in words), np.int64, len(words))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a task that have a word, by bucket, fold and label; what is not 0."""
    counts = np.zeros((BUCKETS, FOLDS, 2), np.int64)
    for batch in batches:
        for text, fold, good in zip(*batch.columns, strict=True):
            counts[np.unique(buckets(text.as_py())), fold.as_py(), good.as_py()] += 1
    bucket, fold, good = np.nonzero(counts)
    columns = [bucket, fold, good, counts[bucket, fold, good]]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["bucket", "fold", "good", "n"])


def word_weights(rows: DataFrame) -> np.ndarray | None:
    """Log-odds of a bucket's words for good text: a row a fold that is left out, then one of all. ``rows``: text, fold, good."""
    found = rows.select("text", "fold", "good").mapInArrow(_word_counts, "bucket long, fold long, good long, n long")
    found = found.groupBy("bucket", "fold", "good").agg(F.sum("n").alias("n")).toArrow()  # BUCKETS x FOLDS x 2 rows at most
    counts = np.zeros((BUCKETS, FOLDS, 2))
    counts[tuple(found.column(c).to_numpy() for c in ("bucket", "fold", "good"))] = found.column("n").to_numpy()
    sizes = np.zeros((FOLDS, 2))
    for r in rows.groupBy("fold", "good").agg(F.count("*").alias("n")).collect():
        sizes[r["fold"], r["good"]] = r["n"]
    if not sizes.sum(axis=0).all():
        return None
    table = []
    for left_out in range(FOLDS + 1):
        kept = [k for k in range(FOLDS) if k != left_out]
        n, whole = counts[:, kept].sum(axis=1), sizes[kept].sum(axis=0) + 1e-9
        prior = (n.sum(axis=1) / whole.sum())[:, None]  # as often in one class as in the other
        p = (n + WORD_SMOOTH * prior) / (whole + WORD_SMOOTH)
        table.append(np.where(n.sum(axis=1) > 0, np.log((p[:, 1] + 1e-9) / (p[:, 0] + 1e-9)), 0.0))
    return np.array(table)


def word_bin(text: str | None, weights: np.ndarray | None) -> int:
    """The mean log-odds of the words in steps of an eighth; the middle bins are 0."""
    found = buckets(text)
    mean = float(weights[found].mean()) if weights is not None and len(found) else 0.0
    return int(min(BINS - 1, max(0, BINS // 2 + math.floor(mean * 8 + 0.5))))


def _featured(weights: Broadcast):
    kind = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = weights.value
        for batch in batches:
            out = []
            for text, fold in zip(batch.column(1), batch.column(2), strict=True):
                own = None if table is None else table[fold.as_py()]
                out.append([*features(text.as_py()), word_bin(text.as_py(), own)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out, kind)], names=["row", "fold", "features"])

    return run


def known_labels(labels: DataFrame, id_column: str, label: str, bound: int) -> DataFrame:
    """(labelled, good, fold): the bounded labels to learn from."""
    id_of, value = named(id_column, label)
    usable = labels.select(id_of.alias("labelled"), value.alias("good"))
    usable = usable.where(F.col("labelled").isNotNull() & F.col("good").isin(0, 1))
    total = usable.count()
    if total > bound:
        share = int((1 << 30) * bound / total)
        usable = usable.where(F.pmod(F.xxhash64("labelled"), F.lit(1 << 30)) < share)
    fold = F.pmod(F.crc32(F.col("labelled").cast("string").cast("binary")), F.lit(FOLDS))
    return usable.groupBy("labelled").agg(F.min("good").cast("int").alias("good")).withColumn("fold", fold.cast("int"))


def _weights(rows: DataFrame) -> tuple[list[list[list[float]]], float]:
    """Log-odds by left-out fold (the last: none), feature and bin, and the share of good rows; one small aggregation.

    ``rows``: features, fold, good of the labelled rows.
    """
    met = rows.select("good", "fold", F.posexplode("features"))
    found = met.groupBy("pos", "col", "fold", "good").agg(F.count("*").alias("n")).collect()
    counts = np.zeros((len(FEATURES), BINS, FOLDS, 2))
    for r in found:
        counts[r["pos"], r["col"], r["fold"], r["good"]] = r["n"]
    sizes = counts[0].sum(axis=(0, 1))
    table = np.zeros((FOLDS + 1, len(FEATURES), BINS))
    if not sizes.all():
        return table.tolist(), 0.5
    for left_out in range(FOLDS + 1):
        n = counts[:, :, [k for k in range(FOLDS) if k != left_out]].sum(axis=2)
        bad, good = n[..., 0], n[..., 1]
        s0, s1 = bad[0].sum(), good[0].sum()
        if not (s0 and s1):
            continue
        prior = (bad + good + 1) / (s0 + s1 + BINS)  # as often in one class as in the other
        p, q = ((x + SMOOTH * BINS * prior * s / (s0 + s1)) / (s + SMOOTH * BINS * s / (s0 + s1)) for x, s in ((good, s1), (bad, s0)))
        table[left_out] = np.where(bad + good > 0, np.log(p / q), 0.0)
    return table.tolist(), float(sizes[1] / sizes.sum())


def logit(p: Column) -> Column:
    inside = F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9))
    return F.log(inside / (1 - inside))


def strength(groups: DataFrame, mean: Column) -> float:
    """Prior strength (in documents) by moments: how far group means differ beyond chance.

    ``groups``: n and good (sum of posteriors) of each group, and what ``mean`` needs.
    """
    of = groups.where("n > 1").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - mean, F.lit(2))).alias("between"),
        F.sum(F.col("n") * mean * (1 - mean)).alias("within"),
        F.count("*").alias("groups"),
    ).first()
    if not of["n"] or not of["groups"] or not of["within"]:
        return 100.0
    chance = of["within"] / of["n"]
    variance = max(0.0, (of["between"] - of["groups"] * chance) / of["n"])
    return min(1e6, max(1.0, chance / variance - 1 if variance > 0 else 1e6))


def pooled(docs: DataFrame, share: float) -> DataFrame:
    """Adds host_mean, path_mean and score to rows of host, path and posterior."""
    sums = (F.count("*").alias("n"), F.sum("posterior").alias("good"))
    paths = saved(docs.groupBy("host", "path").agg(*sums), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    m = strength(hosts, F.lit(share))
    hosts = hosts.select("host", ((F.lit(m * share) + F.col("good")) / (F.lit(m) + F.col("n"))).alias("host_mean"))
    paths = paths.join(hosts.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h"))).drop("h")
    k = strength(paths, F.col("host_mean"))
    paths = paths.withColumnsRenamed({"host": "h", "path": "p"})
    met = docs.join(paths, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p"))).drop("h", "p")
    others = (F.lit(k) * F.col("host_mean") + F.col("good") - F.col("posterior")) / (F.lit(k) + F.col("n") - 1)
    met = met.withColumn("path_mean", (F.lit(k) * F.col("host_mean") + F.col("good")) / (F.lit(k) + F.col("n")))
    final = logit(others) - logit(F.lit(share)) + logit(F.col("posterior"))
    return met.withColumn("score", 1 / (1 + F.exp(-final))).drop("n", "good")


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    host: Column | None = None,
    path: Column | None = None,
    label: str = "quality",
    training_bound: int = TRAINING_ROWS,
) -> DataFrame:
    """id, host, path, evidence, posterior, host_mean, path_mean, score of every row."""
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    (id_of,), (text_of,) = named(id_column), named(text_column)
    row = F.struct(id_of.alias("id"), host.cast("string").alias("host"), path.cast("string").alias("path"))
    rows = docs.select(row.alias("row"), text_of.alias("text"))
    known = saved(known_labels(labels, id_column, label, training_bound), "labels")  # bounded
    learnt = saved(rows.join(F.broadcast(known), F.col("row.id") == F.col("labelled")).select("text", "fold", "good"), "training")
    weights = docs.sparkSession.sparkContext.broadcast(word_weights(learnt))
    dealt = rows.join(F.broadcast(known.select("labelled", "fold")), F.col("row.id") == F.col("labelled"), "left")
    dealt = dealt.select("row", "text", F.coalesce("fold", F.lit(FOLDS)).alias("fold"))
    found = dealt.mapInArrow(_featured(weights), schema_of(row=dealt.schema["row"].dataType, fold="int", features="array<int>"))
    found = saved(found, "features")
    judged_by = found.join(F.broadcast(known.select("labelled", "good")), F.col("row.id") == F.col("labelled"))
    table, share = _weights(judged_by.select("features", "fold", "good"))
    flat = F.lit([w for fold in table for weights_of in fold for w in weights_of])
    start = F.col("fold") * (len(FEATURES) * BINS)
    parts = [F.element_at(flat, (start + F.col("features")[k] + 1 + k * BINS).cast("int")) for k in range(len(FEATURES))]
    evidence = sum(parts[1:], parts[0]) * DAMPING
    judged = found.select("row.*", evidence.alias("evidence"))
    judged = judged.withColumn("posterior", 1 / (1 + F.exp(-(F.col("evidence") + logit(F.lit(share))))))
    return pooled(judged, share)
