"""Benchmark decontamination with a generalised suffix automaton of the test items.

All items of a shard go into one suffix automaton over word numbers. Training texts are streamed
through it word by word: the automaton keeps the longest suffix of what was read that occurs in some
item, so a match of at least ``window`` words marks its words as hit, and an item shorter than the
window is hit when it occurs whole. A word that no item has resets the automaton, so only runs of
known words are walked.

Only the items are broadcast, in shards of at most ``SHARD_WORDS`` words. One shard takes one pass over the
documents without a shuffle. With more of them every pass reads the texts and writes its hits alone, and the spans of
all passes are merged per document.

Defined results: a null or empty text has no words; a null or empty item has no windows; repeated
items are separate items with separate ids; items with a null id hit like others, count as one item together and
are not named in the digest; without items nothing is hit; further columns of the input are ignored or kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructType

from tapewright.llm.util import fields_of, named, packed, saved

WINDOW = 10
SHARD_WORDS = 200_000  # an automaton of that many words takes about 250 MB in a Python worker

# bytes -> bytes: A-Z become a-z; 0-9, a-z and all bytes above 0x7F stay; the others become blanks
WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)



_PLACES = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")  # the same words, in mixed case


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(WORDS).split()


class Automaton:
    """Generalised suffix automaton of word sequences."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.go: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        numbered = [(name, [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in ws]) for name, ws in items]
        for _, ids in numbered:
            at = 0
            for word in ids:
                at = self._extend(at, word)
        # whole[s]: the nearest state on the way up from s that is a whole short item
        self.whole: list[int] = [-1] * len(self.go)
        self.names: list[set[str]] = [set() for _ in self.go]
        self.shortest = window
        short: set[int] = set()
        for name, ids in numbered:
            if not ids:
                continue
            at = 0
            for k, word in enumerate(ids):
                at = self.go[at][word]
                up = at
                # all states above the prefix read so far hold subsequences of this item
                while up > 0 and name not in self.names[up]:
                    self.names[up].add(name)
                    up = self.link[up]
                if k + 1 == len(ids) < window:
                    short.add(at)
                    self.shortest = min(self.shortest, len(ids))
        for state in sorted(range(1, len(self.go)), key=self.size.__getitem__):
            self.whole[state] = state if state in short else self.whole[self.link[state]]
        self.short_names: dict[int, set[str]] = {s: set() for s in short}
        for name, ids in numbered:
            if 0 < len(ids) < window:
                at = 0
                for word in ids:
                    at = self.go[at][word]
                self.short_names[at].add(name)

    def _add(self, edges: dict[int, int], size: int, link: int) -> int:
        self.go.append(edges)
        self.size.append(size)
        self.link.append(link)
        return len(self.go) - 1

    def _split(self, above: int, word: int) -> int:
        """The state reached from ``above`` by ``word``, made to hold nothing longer."""
        old = self.go[above][word]
        if self.size[old] == self.size[above] + 1:
            return old
        copy = self._add(dict(self.go[old]), self.size[above] + 1, self.link[old])
        self.link[old] = copy
        while above >= 0 and self.go[above].get(word) == old:
            self.go[above][word] = copy
            above = self.link[above]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.go[last]:
            return self._split(last, word)
        new = self._add({}, self.size[last] + 1, 0)
        while last >= 0 and word not in self.go[last]:
            self.go[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word)
        return new

    def spans(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit spans [start, end) in ascending order, not overlapping, and the items met."""
        ids = list(map(self.vocabulary.get, words))
        found: list[tuple[int, int]] = []
        names: set[str] = set()
        at, total = 0, len(ids)
        while at < total:
            if ids[at] is None:
                at += 1
                continue
            end = at
            while end < total and ids[end] is not None:
                end += 1
            if end - at >= self.shortest:
                self._walk(ids, at, end, found, names)
            at = end
        return found, names

    def _walk(self, ids: list, start: int, stop: int, found: list[tuple[int, int]], names: set[str]) -> None:
        go, link, size, window = self.go, self.link, self.size, self.window
        state = length = 0
        for i in range(start, stop):
            word = ids[i]
            while state and word not in go[state]:
                state = link[state]
                length = size[state]
            if word in go[state]:
                state = go[state][word]
                length += 1
            hit = 0
            if length >= window:
                hit = length
                up = state
                while size[link[up]] >= window:
                    up = link[up]
                names |= self.names[up]
            up = state
            while (up := self.whole[up]) > 0:
                if length >= size[up]:
                    hit = max(hit, size[up])
                    names |= self.short_names[up]
                up = link[up]
            if hit:
                first = i + 1 - hit
                while found and found[-1][1] >= first:
                    first = min(first, found.pop()[0])
                found.append((first, i + 1))


_built: list = [None, None]  # in a worker process: the shard in use and its automaton


def _automaton(items: Broadcast, window: int) -> Automaton:
    if _built[0] is not items.value:
        _built[:] = items.value, Automaton([(name, data.split()) for name, data in items.value], window)
    return _built[1]


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans, those that meet made one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and out[-1][1] >= start:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


_SPAN_LIST = ArrayType(StructType().add("s", IntegerType()).add("e", IntegerType()))
_FOUND = StructType().add("n_words", LongType()).add("spans", _SPAN_LIST).add("items", ArrayType(StringType()))


def _streamed(items: Broadcast, window: int):
    """What one shard's items hit: n_words, spans and items of a text."""
    span = pa.struct([("s", pa.int32()), ("e", pa.int32())])

    @F.arrow_udf(_FOUND)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            automaton = _automaton(items, window)
            counts, spans, names = [], [], []
            for text in batch:
                words = words_of(text.as_py())
                found, met = automaton.spans(words)
                counts.append(len(words))
                spans.append([{"s": a, "e": b} for a, b in found])
                names.append(sorted(met, key=lambda name: (name is None, name)))
            columns = [pa.array(counts, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(names, pa.list_(pa.string()))]
            yield pa.StructArray.from_arrays(columns, names=["n_words", "spans", "items"])

    return run


@F.arrow_udf(_SPAN_LIST)
def _united(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The spans of several shards as sorted spans that do not meet."""
    span = pa.struct([("s", pa.int32()), ("e", pa.int32())])
    for batch in batches:
        found = [_joined([(x["s"], x["e"]) for x in spans.as_py() or ()]) for spans in batch]
        yield pa.array([[{"s": a, "e": b} for a, b in spans] for spans in found], pa.list_(span))


def _shards(items: DataFrame, window: int, shard_words: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """Lists of (item id as text, its words), of at most ``shard_words`` words each; one at least.

    Rows come to the driver one partition at a time and only one shard is held. An item longer than a
    shard is cut into pieces that overlap by a window less one word, which keeps every window.
    """
    shard: list[tuple[str | None, bytes]] = []
    size, given = 0, False
    for row in items.toLocalIterator():
        words = words_of(row["text"])
        for at in range(0, max(1, len(words) - window + 1), shard_words - window + 1):
            piece = words[at : at + shard_words]
            if size + len(piece) > shard_words and shard:
                yield shard
                shard, size, given = [], 0, True
            shard.append((row["id"], b" ".join(piece)))
            size += len(piece)
    if shard or not given:
        yield shard


def _usable(items: DataFrame, item_column: str, item_text_column: str) -> DataFrame:
    item, text = named(item_column, item_text_column)
    return items.select(item.cast("string").alias("id"), text.alias("text")).where("text is not null")


def contaminated_spans(
    docs: DataFrame,
    items: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """row (all columns of the input), found: n_words, spans [s, e) of word numbers, items met (with null ids).

    One shard takes one pass without a shuffle. With more of them the input is written once with a number for each
    row; every pass reads its texts and writes only the rows that it hits, and these are joined in at the end.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select(packed(docs).alias("row"))
    text = F.col("row")[text_column]
    shards = _shards(_usable(items, item_column, item_text_column), window, shard_words)
    shard, after = next(shards), next(shards, None)
    if after is None:
        return rows.withColumn("found", _streamed(context.broadcast(shard), window)(text))
    rows = saved(rows.withColumn("at", F.monotonically_increasing_id()), "numbered")
    passes = []
    while shard is not None:
        streamed = _streamed(context.broadcast(shard), window)
        found = saved(rows.select("at", streamed(text).alias("found")), "shard")
        passes.append(found)
        shard, after = after, next(shards, None)
    counts = passes[0].select("at", F.col("found.n_words").alias("n_words"))
    hits = None
    for found in passes:
        some = found.where(F.size("found.items") > 0).select("at", "found.spans", "found.items")
        hits = some if hits is None else hits.unionByName(some)
    hits = hits.groupBy("at").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")
    )
    hits = hits.select("at", _united("spans").alias("spans"), "items")
    met = rows.join(counts, "at").join(hits, "at", "left")
    no_spans, no_items = (F.expr(f"cast(array() as {kind})") for kind in ("array<struct<s:int,e:int>>", "array<string>"))
    found = F.struct("n_words", F.coalesce("spans", no_spans).alias("spans"), F.coalesce("items", no_items).alias("items"))
    return met.select("row", found.alias("found"))


def decontamination_report(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """One row per input row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows = docs.select(*[c.alias(n) for c, n in zip(named(id_column, text_column), ("doc_id", "text"), strict=True)])
    found = contaminated_spans(rows, items, **options).select("row.doc_id", "found.*")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["e"] - s["s"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def _is_over(spans: list, n_words: int, max_hit_words: int, max_coverage: float) -> bool:
    sizes = [b - a for a, b in spans]
    return bool(sizes) and (max(sizes) >= max_hit_words or sum(sizes) >= n_words * max_coverage)


def _without(text: str, spans: list) -> str:
    """The text without the words of its spans, and without the blanks after them."""
    places = [m.span() for m in _PLACES.finditer(text)]
    at, parts = 0, []
    for start, end in spans:
        parts.append(text[at : places[start][0]])
        at = places[end][0] if end < len(places) else len(text)
    return "".join([*parts, text[at:]])


def _cleaned(items: Broadcast, window: int, max_hit_words: int, max_coverage: float):
    """A list of the clean text, or of nothing where the items' words were all that a text had."""

    @F.arrow_udf(ArrayType(StringType()))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            automaton = _automaton(items, window)
            out = []
            for value in batch:
                text, cut = value.as_py(), False
                while True:
                    words = words_of(text)
                    spans = automaton.spans(words)[0]
                    if not _is_over(spans, len(words), max_hit_words, max_coverage):
                        break
                    text, cut = _without(text, spans), True
                out.append([text] if not cut or _PLACES.search(text) else [])
            yield pa.array(out, pa.list_(pa.string()))

    return run


def _cut(max_hit_words: int, max_coverage: float):
    """The same for spans that are known already: text after one cut (none where nothing is left), whether it was cut."""

    @F.arrow_udf(StructType().add("texts", ArrayType(StringType())).add("cut", BooleanType()))
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, found in batches:
            out, cut = [], []
            for text, hit in zip(texts.to_pylist(), found.to_pylist(), strict=True):
                spans = [(x["s"], x["e"]) for x in hit["spans"]]
                cut.append(_is_over(spans, hit["n_words"], max_hit_words, max_coverage))
                if cut[-1]:
                    text = _without(text, spans)
                out.append([text] if not cut[-1] or _PLACES.search(text) else [])
            yield pa.StructArray.from_arrays([pa.array(out, pa.list_(pa.string())), pa.array(cut)], names=["texts", "cut"])

    return run


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    max_hit_words: int = 40,
    max_coverage: float = 0.2,
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """The input's rows and columns without the text that comes from the items.

    A document whose longest hit span has ``max_hit_words`` words or more, or whose share of hit words is
    ``max_coverage`` or more, loses its hit spans; if nothing but the items' words were in it, it
    goes as a whole. Others stay as they are. What stood on both sides of a removed span can make a hit
    together, so what was cut is read again until no document is over the limits: at once where all items are one
    shard, else by another round of passes over the rows that were cut.
    """
    context = docs.sparkSession.sparkContext
    limits = max_hit_words, max_coverage
    shards = _shards(_usable(items, item_column, item_text_column), window, shard_words)
    shard = next(shards)
    if next(shards, None) is None:
        clean = _cleaned(context.broadcast(shard), window, *limits)(*named(text_column))
        rows = docs.select(packed(docs, but=text_column).alias("row"), F.explode(clean).alias("text"))
        return rows.select(*fields_of(docs, text_column))
    done, pending = None, docs
    while True:
        found = contaminated_spans(pending, items, text_column, item_column, item_text_column, window, shard_words)
        (text,) = named(text_column)
        cut = found.select("row", _cut(*limits)(F.col("row")[text_column], "found").alias("clean"))
        cut = saved(cut.select("row", "clean.cut", F.explode("clean.texts").alias("text")), "cut")
        clean = cut.where("not cut").select(*fields_of(docs, text_column))
        done = clean if done is None else done.unionByName(clean)
        pending = cut.where("cut").select(*fields_of(docs, text_column))
        if pending.isEmpty():
            return done
