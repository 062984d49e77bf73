"""Substring deduplication by sliding spans of sentences.

A text is cut into sentences; a sentence of more than ``CLAUSE`` words is cut further, at commas and after
words that their own letters choose, so that a passage is cut alike wherever it stands and what runs into
the host text at either end is a few words. Every run of several consecutive sentences with ``min_words``
words or more is looked for in all documents (letters' case and blanks do not count). Of these runs only those are hashed
that hold no shorter one with the same first or the same last sentence: they meet wherever a longer one does, and
together they cover it. A text of fewer than ``min_words`` words is one run as a whole.

A run that occurs in several documents stays where it comes first, in the document of the least id; in all
others, and where a document repeats itself, the sentences that it covers are removed. A single line that many documents
share (a licence, a greeting) is no run. What is missed are passages of less than ``min_words`` words in whole sentences.

The runs of one hash are counted with map-side partial aggregation (least and greatest id), so that a
run which a third of all documents share is one row per task in the shuffle. Runs are then joined with the repeated
hashes alone; the join's hot key is an inner join that adaptive execution splits. Texts move once, to
meet their sentence numbers. Runs are told apart by 96 bits of hash: of 10^13 runs, two different ones meet
with a chance of 1 in 1500.

Defined results: null and empty texts have no sentences and stay; rows that repeat an id are one document
where it comes to being first, so they are not removed against each other; rows with a null id come after all
others, and count as one document among themselves; further columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.llm.util import fields_of, named, packed, saved, schema_of

MIN_WORDS = 16
CLAUSE = 12  # words that a sentence has at least before it is cut; four times as many at most
LAST_ID = (1 << 63) - 1

_END = re.compile(r"(?<![.!?])[.!?]++[\"')\]]*+\s+|\n\s*")
_WORD = re.compile(r"\s*\S+\s*")


def _clauses(sentence: str) -> Iterator[str]:
    """A long sentence in pieces of CLAUSE words or more; where it is cut depends on the words there alone."""
    words = _WORD.findall(sentence)
    start = 0
    at = CLAUSE - 1
    while at < len(words) - 1:
        word = words[at].strip()
        chosen = word[-1] in ",;:" or xxhash.xxh3_64_intdigest(word.lower().encode("utf-8", "surrogatepass")) & 1
        if chosen or at - start + 1 == 4 * CLAUSE:
            yield "".join(words[start : at + 1])
            start, at = at + 1, at + CLAUSE
        else:
            at += 1
    yield "".join(words[start:])


def sentences(text: str | None) -> list[str]:
    """Pieces that make up the whole text, each with the blanks after it."""
    text = text or ""
    ends = [m.end() for m in _END.finditer(text)]
    pieces: list[str] = []
    start = 0
    for end in ends if ends and ends[-1] == len(text) else [*ends, len(text)]:
        piece = text[start:end]
        if piece.isspace() and end < len(text):
            continue  # goes with what comes after
        if (piece.count(" ") < CLAUSE and len(piece.split()) <= CLAUSE) or piece.isspace():
            pieces.append(piece)
        else:
            pieces.extend(_clauses(piece))
        start = end
    return [p for p in pieces if p]


def spans_of(pieces: list[str], min_words: int) -> Iterator[tuple[int, int, int, int]]:
    """(first sentence, end, hash, further bits of it) of the runs that are hashed."""
    words = [p.lower().split() for p in pieces]
    plain = [" ".join(w).encode("utf-8", "surrogatepass") for w in words]
    counts = list(map(len, words))
    count = len(pieces)
    if not any(counts):
        return
    chosen = []
    at = end = total = 0
    while True:
        # the shortest run from each sentence on
        while end < count and (end - at < 2 or total < min_words):
            total += counts[end]
            end += 1
        if end - at < 2 or total < min_words:
            break
        chosen.append((at, end))
        total -= counts[at]
        at += 1
    # the shortest run up to each sentence that ends none of these
    ended = {end for _, end in chosen}
    for end in range(chosen[0][1] if chosen else count, count + 1):
        if end not in ended and chosen:
            at, total = end, 0
            while end - at < 2 or total < min_words:
                at -= 1
                total += counts[at]
            chosen.append((at, end))
    if not chosen:
        chosen.append((0, count))
    for at, end in chosen:
        name = xxhash.xxh3_128_intdigest(b"\n".join(plain[at:end]))
        yield at, end, (name & ((1 << 64) - 1)) - (1 << 63), (name >> 64 & ((1 << 32) - 1)) - (1 << 31)


def _version(text: str | None) -> int:
    return xxhash.xxh3_64_intdigest((text or "").encode("utf-8", "surrogatepass")) - (1 << 63)


def _spans(min_words: int):
    """(run, further bits, id, version of the text, first sentence, end, whether the document has had it before)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [], [])
            for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                seen: set[tuple[int, int]] = set()
                version = _version(text)
                for at, end, name, more in spans_of(sentences(text), min_words):
                    for column, value in zip(out, (name, more, doc, version, at, end, (name, more) in seen), strict=True):
                        column.append(value)
                    seen.add((name, more))
                if len(out[0]) > 100_000:
                    yield _batch(out)
                    out = ([], [], [], [], [], [], [])
            yield _batch(out)

    return run


def _batch(columns: tuple[list, ...]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())
    names = ["run", "more", "id", "version", "at", "end", "again"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the sentences that the runs in ``starts`` cover."""
    for batch in batches:
        texts, totals, gone = [], [], []
        for text, starts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            pieces = sentences(text)
            removed = sorted({i for x in starts or () for i in range(x["at"], x["end"])})
            if removed:
                out = set(removed)
                text = "".join(p for i, p in enumerate(pieces) if i not in out)
            texts.append(text)
            totals.append(len(pieces))
            gone.append(removed)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(texts, pa.string()), pa.array(totals, pa.int64()), pa.array(gone, pa.list_(pa.int32()))],
            names=["row", "text", "n_sentences", "removed"],
        )


def _versioned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        versions = pa.array([_version(t) for t in batch.column(2).to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, versions], names=["row", "id", "text", "version"])


def removed_sentences(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """row (the input's columns but the text), text (cleaned), n_sentences, removed (sentence numbers)."""
    (id_of,), (text_of,) = named(id_column), named(text_column)
    number = F.coalesce(id_of.cast("long"), F.lit(LAST_ID))
    rows = docs.select(number.alias("id"), text_of.alias("text"))
    found = rows.mapInArrow(_spans(min_words), "run long, more int, id long, version long, at int, end int, again boolean")
    found = saved(found, "spans")
    shared = found.where("not again").groupBy("run", "more").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    shared = saved(shared.where("first != last").select("run", "more", "first"), "repeated")
    later = found.where("not again").hint("merge").join(shared, ["run", "more"]).where("id != first").select("id", "version", "at", "end")
    again = found.where("again").select("id", "version", "at", "end")
    starts = later.unionByName(again).groupBy("id", "version").agg(F.collect_set(F.struct("at", "end")).alias("starts"))
    whole = docs.select(packed(docs, but=text_column, keep=id_column).alias("row"), number.alias("id"), text_of.alias("text"))
    row = whole.schema["row"].dataType
    whole = whole.mapInArrow(_versioned, schema_of(row=row, id="long", text="string", version="long"))
    # always a merge join: what is moved then follows the input, however few documents have repeats
    met = whole.hint("merge").join(starts, ["id", "version"], "left").select("row", "text", "starts")
    return met.mapInArrow(_cut, schema_of(row=row, text="string", n_sentences="long", removed="array<int>"))


def remove_repeats(docs: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """The input's rows and columns with shortened texts; documents of which nothing is left go."""
    found = removed_sentences(docs, text_column=text_column, **options)
    left = found.where((F.size("removed") == 0) | (F.trim("text") != ""))
    return left.select(*fields_of(docs, text_column))
