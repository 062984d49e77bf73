import random

import numpy as np
from pyspark.sql import Row

from tapewright.llm import jaccard_join as J


def brute(texts: dict, k: int, percent: int) -> dict:
    sets = {}
    for i, text in texts.items():
        words = J.words_of(text)
        sets[i] = {tuple(words[a : a + k]) for a in range(max(1, len(words) - k + 1))} if words else set()
    label = {i: i for i in texts}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(texts)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                p, q = find(a), find(b)
                label[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed: int) -> dict:
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    line = rng.choices(vocabulary, k=8)
    texts = {}
    for _ in range(25):
        base = rng.choices(vocabulary, k=rng.choice([1, 2, 3, 5, 9, 30, 60])) + (line if rng.random() < 0.5 else [])
        for _ in range(rng.choice([1, 1, 2, 12])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts[len(texts)] = rng.choice([" ", "\n", "  "]).join(w.upper() if rng.random() < 0.1 else w for w in words)
    texts[len(texts)] = None
    texts[len(texts)] = " \t"
    texts[len(texts)] = "long text " * 30000
    return texts


def test_components_equal_brute_force(spark):
    for seed, k, percent in ((1, 4, 85), (2, 5, 80)):
        texts = corpus(seed)
        docs = spark.createDataFrame([Row(doc_id=i, text=t, n="x", row="y") for i, t in texts.items()])
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.component_report(docs, k=k, percent=percent).collect()}
        assert got == brute(texts, k, percent)
        kept = J.near_dedup(docs, k=k, percent=percent)
        assert kept.columns == docs.columns
        assert {r["doc_id"] for r in kept.collect()} == {i for i, (_, c) in got.items() if i == c}


def test_longer_prefixes_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(J, "level", lambda df, n, percent: 1 + n % min(J.MAX_LEVEL, J._least(n, percent)))
    texts = corpus(4)
    docs = spark.createDataFrame([Row(doc_id=i, text=t) for i, t in texts.items()])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.component_report(docs, k=4, percent=85).collect()}
    assert got == brute(texts, 4, 85)


def test_level_rises_with_estimated_cost():
    rare = np.zeros(100, np.int64)
    assert J.level(rare, 100, 80) == 1
    assert J.level(np.full(100, 5000), 100, 80) > 1


def test_odd_rows(spark):
    rows = [Row(doc_id=None, text="a b c d e f"), Row(doc_id=4, text="a b c d e f"), Row(doc_id=4, text="a b c d e f"), Row(doc_id=5, text=None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["component_id"]) for r in J.component_report(docs).collect())
    assert got == [("4", 4), ("4", 4), ("5", 5), ("None", 4)]
    assert J.component_report(docs.limit(0)).count() == 0
    assert J.near_dedup(docs).count() == 4


def test_saved_tables_leave_no_shuffle_files(spark):
    import time

    from pyspark.sql import functions as F

    from tapewright.llm.util import saved

    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    before = disk.getAllFiles().size()
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    assert saved(rows, "counts").count() == 7
    for _ in range(50):
        if disk.getAllFiles().size() <= before + 2:  # those of the count above
            return
        time.sleep(0.1)
    raise AssertionError("shuffle files are left")


def test_shared_prefixes(spark):
    rows = [(1, 10, 5, 1, 1), (1, 10, 5, 1, 1), (2, 10, 5, 1, 2), (2, 11, 5, 1, 1), (2, 11, 5, 1, 1)]
    found = J._shared(spark.createDataFrame(rows, "token long, class long, n long, l long, pos long")).collect()
    assert sorted(tuple(r) for r in found) == [(2, 10, 5, 1, 2), (2, 11, 5, 1, 1)]
