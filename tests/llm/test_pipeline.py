import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tapewright.llm import jaccard_join as J
from tapewright.llm.decontaminate import Automaton, decontamination_report, words_of
from tapewright.llm.queries import SQL, tokenizer_path
from tapewright.llm.token_files import Encoder
from tapewright.llm.toxicity import THRESHOLD, fit
from tapewright.llm.util import saved, table

SF = "/root/testdata/sf0.01"


def test_stages_equal_a_plain_version(spark):
    """Every stage by plain loops on the rows that the stage before kept; the model of toxicity is the operator's."""
    got = {(r["doc_id"], r["start"]): (r["n_tokens"], r["ids_crc32"]) for r in P.run(spark, SF).collect()}
    rows = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    docs = {r["doc_id"]: r for r in rows}
    model = fit(table(spark, SF, "documents"), table(spark, SF, "labels"))
    kept = {k: r for k, r in docs.items() if model.score(sum(x[2] for x in model.passages(words_of(r["text"])))) < THRESHOLD}
    assert 0 < len(docs) - len(kept) < 0.3 * len(docs)
    sets = {}
    for k, r in kept.items():
        w = J.words_of(r["text"])
        sets[k] = {tuple(w[a : a + 5]) for a in range(max(1, len(w) - 4))} if w else set()
    label = {k: k for k in kept}

    def find(k):
        while label[k] != k:
            k = label[k]
        return k

    ids = sorted(kept)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                p, q = sorted((find(a), find(b)))
                label[q] = p
    kept = {k: r for k, r in kept.items() if find(k) == k}
    bench = Automaton([(str(r["item_id"]), words_of(r["text"])) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()])
    clean = {k for k, r in kept.items() if not bench.spans(words_of(r["text"]))[0]}
    assert len(clean) < len(kept)
    # sources here are of like sizes: all are passed once, and those below the largest in part again
    encoder, by_id = Encoder(tokenizer_path()), {}
    for (k, _), value in got.items():
        by_id.setdefault(k, set()).add(value)
    assert set(by_id) <= set(kept) and clean <= set(by_id)
    for k in clean:
        data = encoder.whole(docs[k]["text"]) + np.zeros(1, "<u4").tobytes()
        assert by_id[k] == {(len(data) // 4, zlib.crc32(data))}
    start = 0
    for (k, at), (n, _) in sorted(got.items(), key=lambda x: x[0][1]):
        assert at == start
        start += n


def test_stage_functions_return_the_columns_of_documents(spark):
    docs = table(spark, SF, "documents")
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_no_benchmark_text_is_left_after_decontamination(spark):
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    item = bench.where("text is not null").first()["text"]
    own = " ".join(f"own{k}" for k in range(1200))
    long = docs.limit(1).withColumns({"doc_id": F.lit(-1).cast("long"), "text": F.lit(f"{own} {item} {own}")})
    docs = docs.unionByName(long)
    before = {r["doc_id"]: r["contaminated"] for r in decontamination_report(docs, bench).collect()}
    cleaned = P.decontamination(spark, docs, SF)
    assert before[-1] and decontamination_report(cleaned, bench).where("contaminated").count() == 0
    given = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert got[-1] == f"{own} {own}" and all(got[k] == t for k, t in given.items() if not before[k])


def plain_cut(text, grams):
    """The text without the words of any gram, read again until there is none; None if no word is left."""
    while words := words_of(text):
        hit = {i for n in {len(g) for g in grams} for a in range(len(words) - n + 1) if tuple(words[a : a + n]) in grams for i in range(a, a + n)}
        if not hit:
            return text
        starts = [m.start() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)] + [len(text)]
        text = text[: starts[0]] + "".join(text[starts[i] : starts[i + 1]] for i in range(len(words)) if i not in hit)
    return None


def test_cut_texts_copies_and_tokens_equal_plain_loops(spark):
    """All rows of the last three stages: cuts by plain loops, copies by the SQL of op9, ids by a tokenizer as loaded."""
    duckdb, tokenizers = pytest.importorskip("duckdb"), pytest.importorskip("tokenizers")
    docs = table(spark, SF, "documents")
    for name, stage in P.STAGES[:2]:
        docs = saved(stage(spark, docs, SF), name)
    rows = docs.select("doc_id", "source", "text").toArrow().to_pylist()
    for name, stage in P.STAGES[2:4]:
        docs = saved(stage(spark, docs, SF), name)
    got = Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in P.token_files(spark, docs, SF).collect())
    items = [words_of(r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    grams = {tuple(w[a : a + 10]) for w in items if w for a in range(max(1, len(w) - 9))}
    cut = [{**r, "text": plain_cut(r["text"], grams) if words_of(r["text"]) else r["text"]} for r in rows]
    left = [c for c, r in zip(cut, rows, strict=True) if c["text"] is not None or not words_of(r["text"])]
    assert any(c["text"] != r["text"] for c, r in zip(cut, rows, strict=True))
    with duckdb.connect() as db:
        db.register("documents", pa.Table.from_pylist(left))
        copies = dict(db.execute(f"SELECT doc_id, count(*) FROM ({SQL['op9_mixing']}) GROUP BY 1").fetchall())
    tokenizer, wanted = tokenizers.Tokenizer.from_file(tokenizer_path()), Counter()
    for r in left:
        data = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        wanted[r["doc_id"], len(data) // 4, zlib.crc32(data)] += copies[r["doc_id"]]
    assert got == wanted and max(wanted.values()) > 1


def odd_tables(spark, path, empty=False):
    words = [f"word{k}" for k in range(60)]
    texts = {
        1: " ".join(words), 2: " ".join(words), 3: None, 4: "", 5: " \n ", 6: " ".join(words[:50] + ["other"] * 10), 7: "long " * 300_000,
        8: " ".join(f"own{k}" for k in range(40)), 9: "item " + " ".join(f"bench{k}" for k in range(15)),
    }
    rows = [(k, t, "en", None if k == 8 else f"s{k % 2}", None, "clash", 1, 2) for k, t in texts.items()]
    rows += [rows[7], (None, "no id here", None, "s1", 3, None, None, None), (None, None, None, None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, mix_copy int, `a.b` int"
    docs = spark.createDataFrame([] if empty else rows, schema)
    labels = spark.createDataFrame([] if empty else [(1, 1, 0), (8, 1, None), (None, 0, 1), (8, None, 0)], "doc_id long, quality int, toxic int")
    items = [(1, " ".join(f"bench{k}" for k in range(15))), (2, None), (None, "")]
    bench = spark.createDataFrame([] if empty else items, "item_id long, text string")
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", bench)):
        df.write.parquet(f"{path}/{name}.parquet")
    return docs


def test_odd_rows_and_clashing_columns(spark, tmp_path):
    """Nulls in every column, empty and very long texts, repeated rows, no usable labels."""
    docs = odd_tables(spark, str(tmp_path))
    for _, stage in P.STAGES[:-1]:
        docs = saved(stage(spark, docs, str(tmp_path)), "stage")
        assert set(docs.columns) == {"doc_id", "text", "lang", "source", "n_chars", "row", "mix_copy", "a.b"}
    kept = Counter(r["doc_id"] for r in docs.select("doc_id").distinct().collect())
    # 2 is a copy of 1; 6 shares too little with it; of 9 the benchmark's words go
    assert set(kept) == {None, 1, 3, 4, 5, 6, 7, 8, 9}
    by_id = {r["doc_id"]: r for r in docs.collect() if r["doc_id"] is not None}
    assert by_id[9]["text"].strip() == "item" and by_id[1]["row"] == "clash" and by_id[1]["mix_copy"] == 1
    assert docs.where("doc_id = 8").count() >= 2  # a repeated row stays as often
    found = P.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in found} == set(kept) and {r["n_tokens"] for r in found if r["doc_id"] in (3, 4)} == {1}


def test_empty_tables(spark, tmp_path):
    odd_tables(spark, str(tmp_path), empty=True)
    assert P.run(spark, str(tmp_path)).count() == 0
