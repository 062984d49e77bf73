"""Toxicity by maximum-scoring segment search.

Every word gets a log-odds weight of toxic against clean labelled documents, with an informative
Dirichlet prior in proportion to the word's frequency in both; a word that was never seen takes the
weight of its first letters. Weights count where they are significant, on either side: those for toxic text only if
they also stand in several different contexts, so that the vocabulary of one much-copied document
does not count as toxic; those for clean text lower the score. All other words cost a small constant.

A linear scan (all maximal scoring subsequences) then finds every passage of a document. A passage's
normalised score is its score times lambda less the logarithm of the search space, so that long documents
do not look toxic for being long. lambda solves the extreme-value equation for the weights of all words of the clean
training documents, and the search space per word is fitted to how many passages those documents have. Their sum
over the significant passages is calibrated to a probability by a monotone fit on the training rows.

The model is bounded: at most ``MAX_FEATURES`` weights of each kind, learnt from at most about ``TRAINING_ROWS``
labelled rows (all of them where there are no more; else a share of them by a hash of their id). Rows
whose crc32(id as text) mod 4 is 2 are held out. Scoring is one pass without a shuffle.

Defined results: null and empty texts have no passages and get the score of such texts; a null id is
neither learnt from nor held out; a row repeated in the labels counts once, as toxic if any of its
rows is; a row repeated in the documents is learnt from as often; without any label of either kind every score is 0;
features that tie at the bound of ``MAX_FEATURES`` are all left out; of passages that tie the one further left is named
first; further columns are ignored or kept.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewright.llm.decontaminate import words_of
from tapewright.llm.util import at_most, named, saved

TRAINING_ROWS = 200_000
MAX_FEATURES = 20_000
PREFIX = 5  # bytes
PRIOR = 0.1  # of the documents seen
MIN_Z = 3.0
MIN_WEIGHT = 1.0  # significance alone would admit frequent words that lean a little to one side
DRIFT = 0.05  # what a word without weight costs
SPACE_FROM = 1.0  # the search space is fitted to clean passages of this score (times lambda) or more
SIGNIFICANCE = 0.01  # a passage counts if so many as good are expected in a clean text of the length, or fewer
THRESHOLD = 0.3
BINS_PER_UNIT, BINS = 2, 64
_FLUSH = 200_000


@dataclass
class Model:
    weights: dict[bytes, float] = field(default_factory=dict)
    prefixes: dict[bytes, float] = field(default_factory=dict)
    rate: float = 1.0  # lambda
    space: float = 0.1  # independent passages that a word of clean text starts
    probabilities: list[float] = field(default_factory=lambda: [0.0] * BINS)

    def weight(self, word: bytes) -> float:
        """What the word adds to a passage."""
        found = self.weights.get(word)
        if found is None and len(word) > PREFIX:
            found = self.prefixes.get(word[:PREFIX])
        return -DRIFT if found is None else found

    def segments(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """All maximal scoring subsequences (start, end, score); positions in words; in linear time.

        A candidate looks for the last one before it that starts lower. Each keeps what it found, so that
        whatever was passed over once is not looked at again.
        """
        get, prefixes = self.weights.get, self.prefixes
        total, seen = 0.0, 0
        stack: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum after, the last that starts lower
        for i, word in enumerate(words):
            weight = get(word)
            if weight is None:
                weight = prefixes.get(word[:PREFIX])
                if weight is None or len(word) <= PREFIX:
                    continue
            if weight <= 0:
                total += weight
                seen += 1
                continue
            # the sum of everything before i: each weight so far, less the drift of the others
            before = total - DRIFT * (i - seen)
            total += weight
            seen += 1
            start, left, right = i, before, before + weight
            k = len(stack) - 1
            while True:
                while k >= 0 and stack[k][2] >= left:
                    k = stack[k][4]
                if k < 0 or stack[k][3] >= right:
                    stack.append((start, i + 1, left, right, k))
                    break
                start, left, k, reached = stack[k][0], stack[k][2], stack[k][4], k
                del stack[reached:]
        return [(a, b, r - l) for a, b, l, r, _ in stack]

    def passages(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """Significant passages with their normalised scores."""
        space = math.log(max(1.0, self.space * len(words) / SIGNIFICANCE))
        found = ((a, b, self.rate * s - space) for a, b, s in self.segments(words))
        return [x for x in found if x[2] > 0]

    @staticmethod
    def bin(total: float) -> int:
        return 0 if total <= 0 else min(BINS - 1, 1 + int(total * BINS_PER_UNIT))

    def score(self, total: float) -> float:
        """The calibrated probability, rising a little inside a bin so that ranks are kept."""
        k = self.bin(total)
        low = self.probabilities[k]
        high = self.probabilities[min(k + 1, BINS - 1)]
        inside = 0.0 if k == 0 else min(1.0, total * BINS_PER_UNIT + 1 - k) if k < BINS - 1 else 1 - math.exp(-total)
        return min(1.0, low + max(high - low, 1e-6) * inside * 0.999)


def held_out(id_column: Column) -> Column:
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label: str, bound: int) -> DataFrame:
    """(text, toxic) of the labelled rows that may be learnt from.

    The labels that take part are bounded, and so may be broadcast: the documents are not shuffled.
    """
    id_of, text_of, value = named(id_column, text_column, label)
    usable = labels.select(id_of.alias("labelled"), value.alias("toxic"))
    usable = usable.where(F.col("labelled").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("labelled")))
    total = usable.count()
    if total > bound:
        share = int((1 << 30) * bound / total)
        usable = usable.where(F.pmod(F.xxhash64("labelled"), F.lit(1 << 30)) < share)
    known = usable.groupBy("labelled").agg(F.max("toxic").cast("int").alias("toxic"))
    rows = docs.select(id_of.alias("id"), text_of.alias("text"))
    return rows.join(F.broadcast(known), F.col("id") == F.col("labelled")).select("text", "toxic")


def features(words: list[bytes]) -> Iterator[bytes]:
    """Words, and the first letters of longer words; told apart by their first byte."""
    for word in words:
        yield b"w" + word
        if len(word) > PREFIX:
            yield b"p" + word[:PREFIX]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that have a feature, by class; partial counts of bounded size."""
    counts = Counter(), Counter()

    def flush() -> pa.RecordBatch:
        keys = list(counts[0].keys() | counts[1].keys())
        columns = [pa.array(keys, pa.binary()), *(pa.array([c[k] for k in keys], pa.int64()) for c in counts)]
        for c in counts:
            c.clear()
        return pa.RecordBatch.from_arrays(columns, names=["feature", "c0", "c1"])

    for batch in batches:
        for text, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            counts[toxic].update(set(features(words_of(text))))
            if len(counts[0]) + len(counts[1]) > _FLUSH:
                yield flush()
    yield flush()


def _contexts(chosen: Broadcast):
    """(feature, hash of the words beside it, class) of the chosen features, once per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = chosen.value
        for batch in batches:
            seen = set()
            for text, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = [b"", *words_of(text), b""]
                for i in range(1, len(words) - 1):
                    for feature in features(words[i : i + 1]):
                        if feature in wanted:
                            beside = xxhash.xxh3_64_intdigest(words[i - 1] + b" " + words[i + 1]) >> 1
                            seen.add((feature, beside, toxic))
            columns = list(zip(*seen, strict=True)) or [[], [], []]
            kinds = (pa.binary(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["feature", "beside", "toxic"]
            )

    return run


def _weighed(counts: DataFrame, n0: int, n1: int) -> DataFrame:
    """(feature, weight, z) of the features that are significant for either kind of text."""
    prior = F.lit(PRIOR) * (F.col("c0") + F.col("c1"))
    whole = PRIOR * (n0 + n1)
    log_odds = F.log((F.col("c1") + prior) / (n1 + whole)) - F.log((F.col("c0") + prior) / (n0 + whole))
    spread = F.sqrt(1 / (F.col("c1") + prior) + 1 / (F.col("c0") + prior))
    weighed = counts.select("feature", log_odds.alias("weight"), (log_odds / spread).alias("z"))
    return weighed.where((F.col("z") <= -MIN_Z) | ((F.col("z") >= MIN_Z) & (F.col("weight") >= MIN_WEIGHT)))


def _rate(weights: dict[float, int]) -> float:
    """lambda: the mean of exp(lambda * weight) over the words of clean text is 1; by bisection."""
    words = sum(weights.values())

    def excess(rate: float) -> float:
        return sum(n / words * math.exp(min(700.0, rate * w)) for w, n in weights.items()) - 1

    low, high = 1e-3, 20.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return max(low, 0.2)


def _monotone(bins: dict[int, tuple[int, int]]) -> list[float]:
    """Pooled shares of toxic rows, never falling from bin to bin, each with a weak prior."""
    blocks: list[list[float]] = []
    for k in range(BINS):
        n, toxic = bins.get(k, (0, 0))
        blocks.append([toxic, n, 1])
        while len(blocks) > 1 and _share(blocks[-2]) >= _share(blocks[-1]):
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return [_share(b) for b in blocks for _ in range(int(b[2]))]


def _share(block: list[float]) -> float:
    return (block[0] + 0.05) / (block[1] + 0.5) if block[1] else 1.0


def _scanned(model: Broadcast):
    """Per document its class, number of words and passage scores; then how often clean text has each weight."""
    names = ["toxic", "n_words", "scores", "weight", "n"]
    kinds = (pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.float64(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, clean = model.value, Counter()
        for batch in batches:
            sizes, scores = [], []
            for text, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(text)
                sizes.append(len(words))
                scores.append([s for _, _, s in fitted.segments(words)])
                if not toxic:
                    clean.update(map(fitted.weight, words))
            none = [pa.nulls(len(sizes), k) for k in kinds[3:]]
            found = [batch.column(1), pa.array(sizes, kinds[1]), pa.array(scores, kinds[2]), *none]
            yield pa.RecordBatch.from_arrays(found, names=names)
        none = [pa.nulls(len(clean), k) for k in kinds[:3]]
        yield pa.RecordBatch.from_arrays([*none, pa.array(clean.keys(), kinds[3]), pa.array(clean.values(), kinds[4])], names=names)

    return run


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label: str = "toxic",
    training_bound: int = TRAINING_ROWS,
    max_features: int = MAX_FEATURES,
) -> Model:
    context = docs.sparkSession.sparkContext
    rows = saved(training_rows(docs, labels, id_column, text_column, label, training_bound), "training")
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return Model()
    counts = rows.mapInArrow(_counted, "feature binary, c0 long, c1 long").groupBy("feature")
    first = saved(_weighed(counts.agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")), n0, n1), "weights")
    toxic, clean = (at_most(first.where(side), F.abs("z"), max_features).collect() for side in ("z > 0", "z < 0"))
    chosen = context.broadcast({bytes(r["feature"]) for r in toxic})
    places = rows.mapInArrow(_contexts(chosen), "feature binary, beside long, toxic int").distinct()
    by_context = places.groupBy("feature").agg(
        F.count_if(F.col("toxic") == 0).alias("c0"), F.count_if(F.col("toxic") == 1).alias("c1")
    )
    toxic = _weighed(by_context, n0, n1).where("z > 0").collect()  # no more than were chosen
    chosen.unpersist()
    model = Model()
    for r in [*toxic, *clean]:
        feature = bytes(r["feature"])
        (model.weights if feature[:1] == b"w" else model.prefixes)[feature[1:]] = r["weight"]
    first_model = context.broadcast(model)
    scanned = saved(
        rows.mapInArrow(_scanned(first_model), "toxic int, n_words long, scores array<double>, weight double, n long"), "scanned"
    )
    first_model.unpersist()
    weights = scanned.where("weight is not null").groupBy("weight").agg(F.sum("n").alias("n"))
    seen = {r["weight"]: r["n"] for r in weights.collect()}  # a row per weight of the model
    model.rate = _rate(seen) if seen else 1.0
    texts = scanned.where("toxic is not null").select(
        "toxic", "n_words", F.transform("scores", lambda s: s * model.rate).alias("scores")
    )
    high = F.sum(F.size(F.filter("scores", lambda s: s >= SPACE_FROM)))
    found = texts.where("toxic = 0").agg(high.alias("high"), F.sum("n_words").alias("words")).first()
    share = (found["high"] + 0.5) * math.exp(SPACE_FROM) / (found["words"] + 1)
    model.space = min(1.0, max(1e-6, share))
    space = F.log(F.greatest(F.lit(1.0), F.col("n_words") * (model.space / SIGNIFICANCE)))
    total = F.aggregate("scores", F.lit(0.0), lambda t, s: t + F.greatest(s - space, F.lit(0.0)))
    binned = texts.select("toxic", total.alias("total")).select(
        "toxic",
        F.when(F.col("total") <= 0, 0).otherwise(F.least(F.lit(BINS - 1), 1 + F.floor(F.col("total") * BINS_PER_UNIT))).alias("bin"),
    )
    bins = binned.groupBy("bin").agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).collect()
    model.probabilities = _monotone({r["bin"]: (r["n"], r["toxic"]) for r in bins})
    return model


def _scored(model: Broadcast):
    kind = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])

    @F.arrow_udf("struct<score:double,passages:array<struct<start:int,end:int,score:double>>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted = model.value
        for batch in batches:
            scores, passages = [], []
            for text in batch:
                found = fitted.passages(words_of(text.as_py()))
                scores.append(fitted.score(sum(x[2] for x in found)))
                passages.append([{"start": a, "end": b, "score": s} for a, b, s in found])
            columns = [pa.array(scores, pa.float64()), pa.array(passages, pa.list_(kind))]
            yield pa.StructArray.from_arrays(columns, names=["score", "passages"])

    return run


def score(docs: DataFrame, model: Model, text_column: str = "text") -> Column:
    """A struct for each row: score, passages (start and end in words, normalised score)."""
    return _scored(docs.sparkSession.sparkContext.broadcast(model))(*named(text_column))


def toxicity_report(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted, passages (number)."""
    model = fit(docs, labels, id_column, text_column, **options)
    (id_of,) = named(id_column)
    found = docs.select(id_of.alias("doc_id"), score(docs, model, text_column).alias("found"))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("found.score").alias("score"),
        (F.col("found.score") >= THRESHOLD).cast("int").alias("predicted"),
        F.size("found.passages").alias("passages"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, text_column: str = "text", **options) -> DataFrame:
    """The input's rows and columns, without the rows that score ``threshold`` or more."""
    model = fit(docs, labels, text_column=text_column, **options)
    return docs.where(score(docs, model, text_column)["score"] < threshold)
