import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Row

from tapewright.llm.quality import features, pooled, score, strength


def test_pooling_equals_plain_loops(spark):
    rng = random.Random(4)
    rows = []
    for h, n in (("a", 300), ("b", 40), ("c", 2), (None, 5)):
        good = {"a": 0.9, "b": 0.2}.get(h, 0.6)
        rows += [Row(id=len(rows) + i, host=h, path=rng.choice(["x", "y", None]), posterior=min(0.99, max(0.01, rng.gauss(good, 0.1)))) for i in range(n)]
    docs = spark.createDataFrame(rows)
    share = 0.7
    got = {r["id"]: r for r in pooled(docs, share).collect()}
    groups: dict = {}
    for r in rows:
        groups.setdefault(r["host"], {}).setdefault(r["path"], []).append(r["posterior"])

    def moments(parts):
        parts = [(x, m) for x, m in parts if len(x) > 1]
        n = sum(len(x) for x, _ in parts)
        between = sum(len(x) * (sum(x) / len(x) - m) ** 2 for x, m in parts)
        chance = sum(len(x) * m * (1 - m) for x, m in parts) / n
        variance = (between - len(parts) * chance) / n
        return min(1e6, max(1.0, chance / variance - 1)) if variance > 0 else 1e6

    hosts = {h: [v for p in ps.values() for v in p] for h, ps in groups.items()}
    m = moments([(x, share) for x in hosts.values()])
    mean = {h: (m * share + sum(x)) / (m + len(x)) for h, x in hosts.items()}
    k = moments([(x, mean[h]) for h, ps in groups.items() for x in ps.values()])
    for r in rows:
        x = groups[r["host"]][r["path"]]
        others = (k * mean[r["host"]] + sum(x) - r["posterior"]) / (k + len(x) - 1)
        z = sum(s * math.log(v / (1 - v)) for s, v in ((1, others), (-1, share), (1, r["posterior"])))
        assert got[r["id"]]["score"] == pytest.approx(1 / (1 + math.exp(-z)), rel=1e-6)
    assert strength(docs.limit(0).selectExpr("1 n", "posterior good"), F.lit(0.5)) == 100.0


def test_separates_junk_and_keeps_good(spark):
    rng = random.Random(1)
    words = ["alpha", "beta", "gamma", "delta", "of", "the", "and"]
    rows, labels = [], []
    for i in range(400):
        text = " ".join(rng.choices(words, k=60)) + "."
        if i % 4 == 0:
            text = " ".join(w + "%%%" for w in text.split())
        rows.append(Row(doc_id=i, text=text, source=f"s{i % 7}", lang=None, score="clash"))
        if i % 3 == 0:
            labels.append(Row(doc_id=i, quality=int(i % 4 != 0)))
    rows += [Row(doc_id=None, text=None, source=None, lang=None, score=None), Row(doc_id=400, text="", source=None, lang="x", score=None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, score string")
    marked = spark.createDataFrame(labels + [Row(doc_id=None, quality=1), Row(doc_id=1, quality=None), labels[0]], "doc_id long, quality int")
    found = score(docs, marked).collect()
    assert len(found) == 402
    assert all((r["score"] >= 0.5) == (r["id"] % 4 != 0) for r in found if r["id"] is not None and r["id"] < 400)
    assert {r["evidence"] for r in score(docs, marked.limit(0)).collect()} == {0.0}
    assert score(docs.limit(0), marked).count() == 0
    assert features(None) == features("") == [0] * 9


def auc(marks, scores) -> float:
    """Share of (good, bad) pairs in the right order, ties by half."""
    order = sorted(zip(scores, marks, strict=True))
    below = total = at = 0.0
    while at < len(order):
        same = [m for s, m in order[int(at) :] if s == order[int(at)][0]]
        bad = same.count(0)
        total += same.count(1) * (below + bad / 2)
        below += bad
        at += len(same)
    return total / (marks.count(0) * marks.count(1))


def test_labelled_rows_are_judged_without_their_own_label(spark):
    """Random labels on random words cannot be told apart; a table that saw them would do so."""
    rng = random.Random(8)
    rows = [Row(doc_id=i, text=" ".join(f"w{rng.randrange(10**9)}" for _ in range(20)), source="s", lang="l") for i in range(600)]
    labels = [Row(doc_id=i, quality=rng.randrange(2)) for i in range(600)]
    found = score(spark.createDataFrame(rows), spark.createDataFrame(labels)).select("id", "evidence").collect()
    marks = [labels[r["id"]]["quality"] for r in found]
    assert 0.4 < auc(marks, [r["evidence"] for r in found]) < 0.6


def test_words_alone_tell_apart(spark):
    rng = random.Random(9)
    rows = [Row(doc_id=i, text=" ".join(rng.choices(["spam", "buy"] if i % 3 == 0 else ["good", "text"], k=2) + rng.choices(["a", "b", "c", "d"], k=6)), source="s", lang="l") for i in range(600)]
    labels = [Row(doc_id=i, quality=int(i % 3 != 0)) for i in range(0, 600, 2)]
    found = score(spark.createDataFrame(rows), spark.createDataFrame(labels)).collect()
    rest = [(int(r["id"] % 3 != 0), r["score"]) for r in found if r["id"] % 2]
    assert auc([m for m, _ in rest], [s for _, s in rest]) > 0.99


def test_sparse_sites_shrink(spark):
    rng = random.Random(3)
    rows = [Row(id=i, host=f"h{i % 40}" if i >= 40 else f"lone{i}", path="p", posterior=0.9 if i % 40 < 20 else 0.3) for i in range(2000)]
    rng.shuffle(rows)
    found = {r["id"]: r for r in pooled(spark.createDataFrame(rows), 0.6).collect()}
    lone, large = found[0], found[40]
    assert abs(lone["path_mean"] - 0.6) < abs(large["path_mean"] - 0.6) and large["path_mean"] == pytest.approx(0.9, abs=0.02)


def test_unseen_labels_of_the_test_data(spark):
    import os

    path = "/root/testdata/sf0.1"
    if not os.path.exists(path):
        pytest.skip("no test data")
    labels = spark.read.parquet(f"{path}/labels.parquet")
    found = score(spark.read.parquet(f"{path}/documents.parquet"), labels).join(labels, F.col("id") == F.col("doc_id"))
    rows = found.where("quality is not null").select("quality", "evidence", "score").collect()
    figures = [auc([r["quality"] for r in rows], [r[c] for r in rows]) for c in ("evidence", "score")]
    print("AUC of unseen labels", figures)
    assert min(figures) > 0.9
