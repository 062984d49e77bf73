import hashlib

from pyspark.sql import Row

from tapewright.llm.exact_dedup import exact_dedup


def test_equals_grouping_of_texts(spark):
    long = "x" * 70000
    texts = {1: "Abc", 2: "aBC", 3: "É", 4: "é", 5: None, 6: "", 7: long, 8: long.upper(), 9: long + "y", 10: "a" * 64, 11: "a" * 64, 12: "a" * 320, 13: "a" * 65, 14: "abc "}
    docs = spark.createDataFrame([Row(doc_id=k, text=t, level=1, chunk="c") for k, t in texts.items()])

    def plain(t):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")

    got = {r["doc_id"]: r for r in exact_dedup(docs).collect()}
    assert len(got) == len(texts)
    for k, t in texts.items():
        group = [j for j, u in texts.items() if plain(u) == plain(t)]
        r = got[k]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (max(group), len(group), k == max(group))
        assert r["text_sha256"] == hashlib.sha256(plain(t).encode()).hexdigest()


def test_repeated_rows_and_null_ids(spark):
    docs = spark.createDataFrame([(2, "a"), (2, "a"), (None, "a"), (None, "b"), (None, "b")], "doc_id long, text string")
    rows = exact_dedup(docs).collect()
    assert sorted((str(r["doc_id"]), r["group_size"], str(r["keep_id"])) for r in rows) == [("2", 3, "2"), ("2", 3, "2"), ("None", 2, "None"), ("None", 2, "None"), ("None", 3, "2")]
    assert sum(r["kept"] for r in rows) == 2
    assert exact_dedup(docs.limit(0)).count() == 0
