import random
import zlib

from pyspark.sql import Row

from tapewright.llm.toxicity import DRIFT, Model, _rate, drop_toxic, held_out, toxicity_report


def brute(scores):
    """Maximal scoring subsequences by their definition: the best one, then left and right of it."""
    best = None
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            s = round(sum(scores[a:b]), 9)
            if s > 0 and (best is None or s > best[0] or (s == best[0] and b - a < best[2] - best[1])):
                best = s, a, b
    if best is None:
        return []
    s, a, b = best
    return brute(scores[:a]) + [(a, b, s)] + [(x + b, y + b, z) for x, y, z in brute(scores[b:])]


def test_segments_equal_the_definition():
    rng = random.Random(3)
    for _ in range(400):
        weights = {b"bad": 0.37, b"vile": 0.111, b"good": -0.41, b"kind": -0.2}
        words = rng.choices([*weights, b"x"], k=rng.randrange(18))
        scores = [weights.get(w, -DRIFT) for w in words]
        got = [(a, b, round(s, 9)) for a, b, s in Model(weights=weights).segments(words)]
        assert sorted(x[2] for x in got) == sorted(x[2] for x in brute(scores)), (words, got, brute(scores))


def test_the_scan_is_linear():
    """Passages that never merge, and ones that fall step by step: twice the text takes about twice the steps."""
    import time

    model = Model(weights={b"bad": 1.0, b"good": -0.9})
    for unit in ([b"bad"] + [b"x"] * 41, [b"bad", b"good"], [b"good", b"bad", b"good"]):
        began = time.process_time()
        found = model.segments(unit * 60_000)
        assert time.process_time() - began < 20 and found
    assert len(model.segments(([b"bad"] + [b"x"] * 41) * 16_000)) == 16_000


def test_lambda_and_sizes():
    import math

    weights = {-DRIFT: 9_000, 1.5: 40, -0.7: 300, 2.5: 5}
    rate = _rate(weights)
    total = sum(weights.values())
    assert abs(sum(n / total * math.exp(rate * w) for w, n in weights.items()) - 1) < 1e-6


def test_at_most_keeps_the_greatest(spark):
    from pyspark.sql import functions as F

    from tapewright.llm.util import at_most

    rows = spark.range(1, 1001).withColumn("size", F.col("id") % 100 + 1.0)
    for most in (0, 5, 10, 250, 5000):
        kept = [r["size"] for r in at_most(rows, F.col("size"), most).collect()]
        assert len(kept) <= most and len(kept) >= min(1000, most) - 20
        assert not kept or min(kept) > max([r["size"] for r in rows.collect() if r["size"] not in kept], default=0)


def docs_and_labels(spark, n=600):
    rng = random.Random(2)
    vocabulary = [f"{a}{b}ord" for a in "bcdfghjklm" for b in "aeiou"]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(vocabulary, k=40)
        toxic = int(i % 5 == 0)
        if toxic:
            for w in rng.sample(["scum", "moron", "idiot"], 2):
                words.insert(rng.randrange(len(words)), w)
        docs.append(Row(doc_id=i, text=" ".join(words), score="clash", row="r"))
        if i % 2 == 0:
            labels.append(Row(doc_id=i, toxic=toxic))
    docs += [Row(doc_id=None, text="scum", score=None, row=None), Row(doc_id=n, text=None, score=None, row=None), Row(doc_id=n, text="", score=None, row=None)]
    labels += [Row(doc_id=None, toxic=1), Row(doc_id=2, toxic=None), labels[0]]
    return spark.createDataFrame(docs, "doc_id long, text string, score string, row string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_finds_toxic_documents_and_leaves_clean_ones(spark):
    docs, labels = docs_and_labels(spark)
    rows = toxicity_report(docs, labels).collect()
    assert len(rows) == 603
    wrong = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 600 and r["predicted"] != (r["doc_id"] % 5 == 0)]
    assert not wrong and all(0 <= r["score"] <= 1 for r in rows)
    kept = drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 480 + 2 + (1 if not [r for r in rows if r["doc_id"] is None][0]["predicted"] else 0)


def test_weights_equal_plain_counts(spark):
    """Words by documents that have them, then by contexts; log-odds with the prior; both sides."""
    import math

    from tapewright.llm.toxicity import MIN_WEIGHT, MIN_Z, PREFIX, PRIOR, fit

    docs, labels = docs_and_labels(spark)
    marks = {r["doc_id"]: r["toxic"] for r in labels.where("doc_id is not null and toxic is not null").collect()}
    learnt = [r for r in docs.where("doc_id < 600").collect() if r["doc_id"] in marks and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    rows = [(r["text"].split(), marks[r["doc_id"]]) for r in learnt]
    sizes = [sum(y == k for _, y in rows) for k in (0, 1)]

    def weighed(counts):
        out = {}
        for feature, c in counts.items():
            prior = PRIOR * sum(c)
            parts = [(c[k] + prior) for k in (0, 1)]
            weight = math.log(parts[1] / (sizes[1] + PRIOR * sum(sizes))) - math.log(parts[0] / (sizes[0] + PRIOR * sum(sizes)))
            z = weight / math.sqrt(1 / parts[0] + 1 / parts[1])
            if z <= -MIN_Z or (z >= MIN_Z and weight >= MIN_WEIGHT):
                out[feature] = weight, z
        return out

    def named(word):
        return [("w", word)] + ([("p", word[:PREFIX])] if len(word) > PREFIX else [])

    counts, places = {}, {}
    for words, y in rows:
        for f in {f for w in words for f in named(w)}:
            counts.setdefault(f, [0, 0])[y] += 1
        for a, w, b in zip(["", *words[:-1]], words, [*words[1:], ""], strict=True):
            for f in named(w):
                places.setdefault(f, set()).add((a, b, y))
    first = weighed(counts)
    toxic = {f for f, (_, z) in first.items() if z > 0}
    second = weighed({f: [sum(p[2] == k for p in places[f]) for k in (0, 1)] for f in toxic})
    wanted = {f: w for f, (w, z) in second.items() if z > 0} | {f: w for f, (w, z) in first.items() if z < 0}
    model = fit(docs, labels)
    got = {("w", k.decode()): v for k, v in model.weights.items()} | {("p", k.decode()): v for k, v in model.prefixes.items()}
    assert set(got) == set(wanted) and len(wanted) >= 3 and all(abs(got[k] - wanted[k]) < 1e-9 for k in wanted)
    assert all(a <= b + 1e-12 for a, b in zip(model.probabilities, model.probabilities[1:], strict=False)) and 0 < model.space <= 1


def test_empty_tables(spark):
    docs, labels = docs_and_labels(spark, 20)
    assert {r["score"] for r in toxicity_report(docs, labels.limit(0)).collect()} <= {0.0, 1e-6}
    assert toxicity_report(docs.limit(0), labels).count() == 0


def test_odd_columns_and_very_long_texts(spark):
    docs, labels = docs_and_labels(spark)
    odd = docs.withColumnRenamed("row", "a.b`c").union(docs.limit(1).selectExpr("9999L", "repeat('scum word ', 200000)", "score", "row"))
    rows = {r["doc_id"]: r for r in toxicity_report(odd, labels).collect()}
    assert rows[9999]["predicted"] == 1
    assert drop_toxic(odd, labels).columns == odd.columns and drop_toxic(odd, labels).count() < odd.count()


def test_held_out_rows_of_the_test_data(spark):
    """Trained without them, labelled rows are told apart."""
    import os

    import pytest

    path = "/root/testdata/sf0.1"
    if not os.path.exists(path):
        pytest.skip("no test data")
    labels = spark.read.parquet(f"{path}/labels.parquet")
    rows = toxicity_report(spark.read.parquet(f"{path}/documents.parquet"), labels).join(labels, "doc_id").where("held_out")
    found = {(r["toxic"], r["predicted"]): r["count"] for r in rows.groupBy("toxic", "predicted").count().collect()}
    assert found[1, 1] >= 0.9 * (found[1, 1] + found.get((1, 0), 0)) and found.get((0, 1), 0) <= 0.01 * found[0, 0]


def test_held_out_is_by_crc32(spark):
    from pyspark.sql import functions as F

    rows = spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in rows)
