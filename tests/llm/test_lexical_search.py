import math
import random
import re
from collections import Counter

import numpy as np

from tapewright.llm import lexical_search as L


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lowered)


def brute(docs, items, k=10):
    counts = [(i, Counter(words(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    total, length = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    found = []
    for item, text in items:
        scores = []
        for i, c in counts:
            m = 100 - 90 + (90 * c.total() * total) // length
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(words(text)) if c[t])
            if s > 0:
                scores.append((-s, i is None, i))
        found += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(found, key=str)


def corpus(seed, n=400):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdéñ1", k=rng.choice([1, 2, 3, 5]))) for _ in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, rng.choice([" ", ", ", "\n"]).join(w.upper() if rng.random() < 0.1 else w for w in rng.choices(vocabulary, weights, k=rng.choice([1, 5, 20, 80, 400])))) for i in range(n)]
    docs += [(n + i, docs[3][1]) for i in range(30)] + [(None, docs[3][1]), (5, docs[3][1]), (n + 50, None), (n + 51, " .,"), (n + 52, "word " * 40_000)]
    rng.shuffle(docs)
    items = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([1, 3, 12, 40])))) for i in range(25)]
    items += [(30, docs[7][1]), (31, None), (32, "--"), (33, "nowhere at all"), (34, dict(docs)[3]), (None, "ab Word")]
    return docs, items


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, score string, item int"),
        spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int"),
    )


def rows(found):
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_equals_brute_force(spark):
    docs, items = corpus(1)
    found = L.ranked_documents(*frames(spark, docs, items))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(found) == brute(docs, items)


def test_blocks_of_documents_and_items(spark, monkeypatch):
    docs, items = corpus(2, 150)
    d, i = frames(spark, docs, items)
    monkeypatch.setattr(L, "BLOCK_ROWS", 50)
    assert rows(L.ranked_documents(d.repartition(2), i, k=3, most_terms=60)) == brute(docs, items, 3)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(4)
    size, topics = 400, 8
    rows, values = [], []
    for _ in range(1500):
        topic = rng.integers(topics)
        terms = np.unique(topic * 50 + rng.integers(0, 50, 12))
        rows.append(terms)
        values.append(rng.integers(1, 1_000_000, len(terms)))
    start = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
    block = L.Block(start, np.concatenate(rows), np.concatenate(values))
    weights = rng.integers(1, 12_000, size)
    items = L.Items([sorted(set((t * 50 + rng.integers(0, 50, 10)).tolist())) for t in range(topics)], weights)
    nodes = L.ball_tree(block, block.values * items.root[block.terms], size)
    assert sorted(i for n in nodes if not n.children for i in n.rows) == list(range(1500))
    for item, terms in enumerate(items.terms):
        own = np.isin(block.terms, terms)
        scores = np.add.reduceat(np.where(own, block.values * weights[block.terms], 0), start[:-1])
        for node in nodes:
            assert items.bounds(node)[item] >= scores[node.rows].max()
    best = [[] for _ in items.terms]
    scored = L.search_block(block, list(range(1500)), items, best, 10)
    leaves = sum(not n.children for n in nodes)
    assert scored < leaves * topics / 2


def test_empty(spark):
    docs, items = frames(spark, [], [(1, "a b")])
    assert L.ranked_documents(docs, items).count() == 0
    assert L.ranked_documents(docs, items.limit(0)).count() == 0
