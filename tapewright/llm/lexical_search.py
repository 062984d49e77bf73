"""Ranked lexical search: exact top-k inner products by sparse ball trees.

A document is a sparse vector of saturated term frequencies, an item of a query set a sparse vector of term weights, both whole
numbers; a score is their inner product. Documents are read once: a task keeps the terms that any item has, with their numbers
(what no item has cannot score), and document frequencies and lengths come from grouped sums over that table.

The search is over blocks of documents. A task builds a ball tree for each block: nodes are halved along the line
between two far documents, and each has its centre and radius. Components are scaled by the root of the term's weight, which
leaves inner products as they are. For an item, no document of a node scores more than the item's product with the centre plus its length
times the radius (Cauchy and Schwarz), or, where that is less, plus how far documents are above the centre along the item's own terms.
Bounds are raised by more than rounding can take away. Subtrees are opened best first, and none whose bound is below the k-th score so
far, which goes on from block to block. Leaves are scored in 64-bit integers. Tasks hand on k rows an item; a
window takes the best k of these.

Terms of at most ``TERMS`` (items are taken in blocks up to that many) are sent to the tasks; documents, scores and trees are
never gathered.

Defined results: null and empty texts, and those without terms, are in no ranking and not counted; a null document id comes after
all others of its score; documents that repeat an id rank as rows of their own; each row of the items has a ranking of
its own, also where ids repeat or are null; items without terms have none; empty tables give no rows; further columns of any
name are ignored.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapewright.llm.util import LOWER, named, saved

K = 10
TERMS = 500_000  # distinct terms of a block of items
BLOCK_ROWS = 8192
BLOCK_TERMS = 2_000_000  # of a block's documents together
LEAF = 32
SLACK = 1e-9  # relative; sums of doubles over a vector are off by far less

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_BEST = "item int, id long, score long"


def terms_of(text: str | None) -> list[str]:
    """Runs of digits, letters and signs beyond ASCII; A-Z lower-cased."""
    return _TERM.findall((text or "").encode("utf-8", "surrogatepass").translate(LOWER).decode("utf-8", "surrogatepass"))


def weight(documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


def _counted(vocabulary):
    """(id, length, terms by number, how often each) of the documents that have terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = vocabulary.value
        for batch in batches:
            for at in range(0, len(batch), 1000):
                out: tuple[list, ...] = ([], [], [], [])
                for doc, text in zip(*(c.slice(at, 1000).to_pylist() for c in batch.columns), strict=True):
                    found = terms_of(text)
                    if found:
                        counts = Counter(found)
                        known = sorted((numbers[t], counts[t]) for t in counts.keys() & numbers.keys())
                        for column, value in zip(out, (doc, len(found), [t for t, _ in known], [n for _, n in known]), strict=True):
                            column.append(value)
                kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["id", "length", "terms", "counts"])

    return run


class Block:
    """Some documents as rows of a sparse matrix: ``start`` has a row's first entry in ``terms`` and ``values``."""

    def __init__(self, start: np.ndarray, terms: np.ndarray, values: np.ndarray) -> None:
        self.start, self.terms, self.values = start, terms, values

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entries of some rows, and where each row begins in them."""
        sizes = self.start[rows + 1] - self.start[rows]
        begin = np.concatenate(([0], np.cumsum(sizes)))
        return np.arange(begin[-1]) + np.repeat(self.start[rows] - begin[:-1], sizes), begin

    def dot(self, entries: np.ndarray, begin: np.ndarray, values: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Products of the rows with a dense vector; no row is empty."""
        return np.add.reduceat(values[entries] * dense[self.terms[entries]], begin[:-1])


class Node:
    __slots__ = ("centre", "children", "deviation", "radius", "rows", "terms")


def ball_tree(block: Block, scaled: np.ndarray, size: int, leaf: int = LEAF) -> list[Node]:
    """The nodes of a block's tree, the root first; ``scaled`` has the geometry's values of the entries."""
    nodes: list[Node] = []
    squares = np.add.reduceat(scaled * scaled, block.start[:-1])
    dense = np.zeros(size)
    todo: list[tuple[np.ndarray, Node | None]] = [(np.arange(len(block.start) - 1), None)]
    while todo:
        rows, parent = todo.pop()
        node = Node()
        if parent is not None:
            parent.children.append(len(nodes))
        nodes.append(node)
        entries, begin = block.entries(rows)
        own = block.terms[entries]
        values = scaled[entries]
        centre = np.bincount(own, values, size) / len(rows)
        node.terms = np.flatnonzero(centre)
        node.centre = centre[node.terms]
        # per term: how far a document may be above the centre
        np.maximum.at(dense, own, values)
        node.deviation = dense[node.terms] - node.centre
        dense[own] = 0.0
        dense[node.terms] = node.centre
        away = squares[rows] - 2 * block.dot(entries, begin, scaled, dense) + node.centre @ node.centre
        node.radius = math.sqrt(max(float(away.max()), 0.0) + SLACK * float(squares[rows].max()))
        dense[node.terms] = 0.0
        node.rows, node.children = rows, []
        if len(rows) <= leaf:
            continue
        first = rows[away.argmax()]
        line = block.entries(np.array([first]))[0]
        dense[block.terms[line]] = scaled[line]
        apart = squares[rows] - 2 * block.dot(entries, begin, scaled, dense)
        last = rows[apart.argmax()]
        line = block.entries(np.array([last]))[0]
        dense[block.terms[line]] -= scaled[line]
        along = block.dot(entries, begin, scaled, dense)
        dense[own] = 0.0
        for row in (first, last):
            dense[block.terms[block.start[row] : block.start[row + 1]]] = 0.0
        order = rows[np.argsort(along, kind="stable")]
        half = len(order) // 2
        todo += [(order[:half], node), (order[half:], node)]
    return nodes


class Items:
    """Items by their terms; ``by_term`` lists, for each term, the items that have it."""

    def __init__(self, terms: list[list[int]], weights: np.ndarray) -> None:
        self.terms = [np.array(t, np.int64) for t in terms]
        self.weights, self.root = weights, np.sqrt(weights)
        self.length = np.sqrt([float(weights[t].sum()) for t in self.terms])
        pairs = sorted((t, i) for i, ts in enumerate(terms) for t in ts)
        self.item = np.array([i for _, i in pairs], np.int64)
        self.start = np.searchsorted(np.array([t for t, _ in pairs], np.int64), np.arange(len(weights) + 1))

    def bounds(self, node: Node) -> np.ndarray:
        """For every item: no document of the node scores more."""
        sizes = self.start[node.terms + 1] - self.start[node.terms]
        begin = np.concatenate(([0], np.cumsum(sizes)))
        places = np.arange(begin[-1]) + np.repeat(self.start[node.terms] - begin[:-1], sizes)
        of, count = self.item[places], len(self.terms)
        root = self.root[node.terms]
        product = np.bincount(of, np.repeat(node.centre * root, sizes), count)
        along = np.bincount(of, np.repeat(node.deviation * root, sizes), count)
        return (product + np.minimum(self.length * node.radius, along)) * (1 + SLACK) + 1


def search_block(block: Block, ids: list, items: Items, best: list[list], k: int, leaf: int = LEAF) -> int:
    """Takes a block's documents into ``best``, a heap of (score, order, id) an item; returns the number of leaves that were scored."""
    nodes = ball_tree(block, block.values * items.root[block.terms], len(items.weights), leaf)
    bounds = np.array([items.bounds(n) for n in nodes])
    leaves = {i: block.entries(n.rows) for i, n in enumerate(nodes) if not n.children}
    dense = np.zeros(len(items.weights), np.int64)
    scored = 0
    for item, terms in enumerate(items.terms):
        heap, of, held = [(-bounds[0, item], 0)], bounds[:, item].tolist(), best[item]
        dense[terms] = items.weights[terms]
        while heap:
            bound, at = heapq.heappop(heap)
            if len(held) == k and -bound < held[0][0]:
                break  # of all others the bounds are no higher
            if nodes[at].children:
                for child in nodes[at].children:
                    heapq.heappush(heap, (-of[child], child))
                continue
            scored += 1
            scores = block.dot(*leaves[at], block.values, dense)
            least = held[0][0] if len(held) == k else 1
            for i in np.flatnonzero(scores >= least):
                doc = ids[nodes[at].rows[i]]
                entry = (int(scores[i]), (0, -doc) if doc is not None else (-1, 0), doc)
                if len(held) < k:
                    heapq.heappush(held, entry)
                elif entry[:2] > held[0][:2]:
                    heapq.heapreplace(held, entry)
        dense[terms] = 0
    return scored


def _searched(terms, weights, scale: tuple[int, int], k: int):
    """The best documents of a task's rows for every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(terms.value, weights.value)
        best: list[list] = [[] for _ in items.terms]
        held: list[pa.RecordBatch] = []
        rows = entries = 0
        for batch in batches:
            at = 0
            while at < len(batch):
                piece = batch.slice(at, BLOCK_ROWS - rows)
                held.append(piece)
                rows, entries, at = rows + len(piece), entries + len(piece.column(2).flatten()), at + len(piece)
                if rows >= BLOCK_ROWS or entries >= BLOCK_TERMS:
                    _take(held, items, scale, best, k)
                    held, rows, entries = [], 0, 0
        if held:
            _take(held, items, scale, best, k)
        found = [(i, doc, score) for i, heap in enumerate(best) for score, _, doc in heap]
        columns = list(zip(*found, strict=True)) or [[], [], []]
        kinds = (pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["item", "id", "score"])

    return run


def _take(held: list[pa.RecordBatch], items: Items, scale: tuple[int, int], best: list[list], k: int) -> None:
    table = pa.Table.from_batches(held)
    ids, lengths = table.column(0).to_pylist(), np.array(table.column(1).to_pylist(), np.int64)
    terms, counts = (np.concatenate([np.asarray(c.flatten()) for c in table.column(n).chunks]).astype(np.int64) for n in (2, 3))
    sizes = np.concatenate([np.asarray(c.value_lengths()) for c in table.column(2).chunks])
    documents, total = scale
    m = np.array([10 + 90 * int(n) * documents // total for n in lengths], np.int64)
    values = 1_000_000_000 * counts // (1000 * counts + 8 * np.repeat(m, sizes))
    kept = np.flatnonzero(sizes)
    start = np.concatenate(([0], np.cumsum(sizes[kept])))
    if len(kept):
        search_block(Block(start, terms, values), [ids[i] for i in kept], items, best, k)


def _item_blocks(items: DataFrame, most: int) -> Iterator[tuple[list, list[list[str]]]]:
    """Blocks of items (their ids and distinct terms) with at most so many different terms together, if one item has not more."""
    ids, terms, seen = [], [], set()
    for item, text in items.toLocalIterator():
        own = set(terms_of(text))
        if not own:
            continue
        if terms and len(seen | own) > most:
            yield ids, terms
            ids, terms, seen = [], [], set()
        ids.append(item)
        terms.append(sorted(own))
        seen |= own
    if terms:
        yield ids, terms


def ranked_documents(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text_column: str = "text", k: int = K, most_terms: int = TERMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item, ranks from 1."""
    spark = docs.sparkSession
    rows = docs.select(*named(id_column, text_column))
    kind = items.select(*named(item_column)).schema[0].dataType
    context = spark.sparkContext
    found = None
    for ids, terms in _item_blocks(items.select(*named(item_column, item_text_column)), most_terms):
        numbers = {t: i for i, t in enumerate(sorted({t for ts in terms for t in ts}))}
        vectors = rows.mapInArrow(_counted(context.broadcast(numbers)), "id long, length long, terms array<int>, counts array<int>")
        vectors = saved(vectors, "vectors")
        documents, total = vectors.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
        frequency = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # a row for each of the terms
        weights = np.zeros(len(numbers), np.int64)
        for term, count in frequency:
            weights[term] = weight(documents, count)
        wanted = [[numbers[t] for t in ts] for ts in terms]
        best = vectors.select("id", "length", "terms", "counts").mapInArrow(
            _searched(context.broadcast(wanted), context.broadcast(weights), (documents, total), k), _BEST
        )
        place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id")))
        best = best.withColumn("rank", place).where(F.col("rank") <= k)
        names = spark.createDataFrame(list(enumerate(ids)), f"item int, item_id {kind.simpleString()}")
        part = best.join(names, "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
