import hashlib
import random

from pyspark.sql import Row

from tapewright.llm.decontaminate import Automaton, decontaminate, decontamination_report, words_of


def brute(words, items, window):
    hit, met = set(), set()
    for name, item in items:
        k = min(window, len(item))
        grams = {tuple(item[a : a + k]) for a in range(len(item) - k + 1)} if item else set()
        for i in range(len(words) - k + 1 if k else 0):
            if tuple(words[i : i + k]) in grams:
                hit |= set(range(i, i + k))
                met.add(name)
    return hit, met


def test_automaton_equals_brute_force():
    rng = random.Random(7)
    for _ in range(1500):
        letters = [b"a", b"b", b"c"][: rng.randint(1, 3)]
        items = [(str(k), rng.choices(letters, k=rng.randrange(9))) for k in range(rng.randrange(5))]
        words = rng.choices([*letters, b"z"], k=rng.randrange(40))
        window = rng.randint(2, 6)
        spans, met = Automaton(items, window).spans(words)
        hit, names = brute(words, items, window)
        assert {i for a, b in spans for i in range(a, b)} == hit and met == names, (items, words, window)
        assert spans == sorted(spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:], strict=False))


def tables(spark):
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(50)]
    items = {k: " ".join(rng.choices(vocabulary, k=rng.choice([3, 12, 25]))) for k in range(12)}
    docs = {}
    for k in range(60):
        text = " ".join(rng.choices(vocabulary, k=rng.randrange(60)))
        if k % 3 == 0:
            item = items[rng.randrange(12)].split()
            text += "; " + " ".join(item[rng.randrange(2) :]).upper() + "! tail"
        docs[k] = text
    docs[60], docs[61], docs[62] = None, "", "w1 " * 50000
    bench = [Row(item_id=k, text=t, extra=1) for k, t in items.items()] + [Row(item_id=None, text=docs[1], extra=1), Row(item_id=99, text=None, extra=1)]
    return docs, items, spark.createDataFrame([Row(doc_id=k, text=t, spans="clash", items="x") for k, t in docs.items()]), spark.createDataFrame(bench, "item_id long, text string, extra int")


def test_report_equals_brute_force_in_one_shard_and_in_many(spark):
    docs, items, frame, bench = tables(spark)
    named = [(str(k), words_of(t)) for k, t in items.items()] + [(None, words_of(docs[1]))]
    for shard_words in (200_000, 30):
        got = {r["doc_id"]: r for r in decontamination_report(frame, bench, shard_words=shard_words).collect()}
        for k, text in docs.items():
            words = words_of(text)
            hit, met = brute(words, named, 10) if k != 62 else (set(), set())
            r = got[k]
            assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (len(words), len(hit), len(met), bool(hit))
            assert r["items_sha256"] == hashlib.sha256(",".join(sorted(met - {None})).encode()).hexdigest()
    assert got[1]["n_items"] >= 1


def test_removal_and_empty_tables(spark):
    passage = " ".join(f"q{k}" for k in range(15))
    docs = spark.createDataFrame([Row(doc_id=1, text=f"Clean words here, {passage.upper()}. And after.", row=1), Row(doc_id=2, text=passage, row=2), Row(doc_id=3, text="nothing at all", row=3), Row(doc_id=4, text=None, row=4)])
    bench = spark.createDataFrame([Row(item_id=5, text=passage)])
    got = decontaminate(docs, bench)
    assert got.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {1: "Clean words here, And after.", 3: "nothing at all", 4: None}
    assert decontamination_report(docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontamination_report(docs.limit(0), bench).count() == 0
    odd = docs.withColumnRenamed("row", "a.b`c")
    for shard_words in (200_000, 12):
        got = decontaminate(odd, bench, shard_words=shard_words)
        assert got.columns == odd.columns and sorted(r["doc_id"] for r in got.collect()) == [1, 3, 4]


def test_what_stands_around_a_removed_span_is_read_again(spark):
    item = [f"q{k}" for k in range(18)]
    text = " ".join(["own", *item[:9], *item, *item[9:], "words"])
    docs = spark.createDataFrame([Row(doc_id=1, text=text), Row(doc_id=2, text="own words")])
    bench = spark.createDataFrame([Row(item_id=5, text=" ".join(item))])
    for options in ({}, {"max_hit_words": 1, "max_coverage": 0.0, "shard_words": 12}):
        got = decontaminate(docs, bench, **options)
        assert {r["doc_id"]: r["text"] for r in got.collect()} == {1: "own words", 2: "own words"}
        assert decontamination_report(got, bench).where("contaminated").count() == 0
