import math

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tapewright.llm.mixing import find_exponent, mix, mixed


def docs(spark):
    rows = [Row(doc_id=k, source="big", text="a b c d e " * 4, mix_copy="clash") for k in range(300)]
    rows += [Row(doc_id=1000 + k, source="mid", text="a b c", mix_copy="x") for k in range(200)]
    rows += [Row(doc_id=2000 + k, source=None, text="a\tb\nc d", mix_copy=None) for k in range(50)]
    rows += [Row(doc_id=None, source="", text=None, mix_copy=None), Row(doc_id=7, source="empty", text="  ", mix_copy=None), Row(doc_id=7, source="empty", text=None, mix_copy=None)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string, mix_copy string")


def test_bisection_meets_its_targets(spark):
    p = [0.7, 0.2, 0.1]
    shares = spark.createDataFrame([(x,) for x in p], "share double")
    e = find_exponent(shares, 3.0, None, None)
    assert e == pytest.approx(1 - math.log(3) / math.log(7), abs=1e-9)
    e = find_exponent(shares, None, 1.0, None)
    w = [x**e for x in p]
    assert -sum(x / sum(w) * math.log(x / sum(w)) for x in w) == pytest.approx(1.0, abs=1e-6)
    e = find_exponent(shares, 1.5, None, 1.0)
    assert max(x**e / sum(y**e for y in p) / x for x in p) == pytest.approx(1.5, abs=1e-6)
    assert find_exponent(shares, None, 0.1, None) == 1.0 and find_exponent(shares, None, 5.0, None) == 0.0 and find_exponent(shares, 100.0, None, None) == 0.0
    with pytest.raises(ValueError):
        find_exponent(shares, None, None, None)


def test_every_row_comes_and_small_sources_repeat(spark):
    d = docs(spark)
    rows = mix(d, repetition_limit=2.0).collect()
    counts = {}
    for r in rows:
        counts[r["source"] or "", r["doc_id"], r["mix_copy"]] = counts.get((r["source"] or "", r["doc_id"], r["mix_copy"]), 0) + 1
    seen = {(s, i) for s, i, _ in counts}
    assert len(seen) == 300 + 200 + 50 + 1 + 1 and counts["empty", 7, 0] == 2
    big = [r for r in rows if r["source"] == "big"]
    assert len(big) == 300 and len([r for r in rows if r["source"] is None]) == 100
    mid = [r for r in rows if r["source"] == "mid"]
    passes = (6000 / 600) ** (math.log(2) / math.log(6000 / 200))
    assert abs(sum(r["mix_tokens"] for r in mid) - passes * 600) <= 3
    assert mix(d.limit(0), repetition_limit=2.0).count() == 0


def test_budget_is_kept_by_block_permutations(spark):
    d = docs(spark)
    rows = mix(d, target_entropy=0.9, budget_tokens=3000).collect()
    total = sum(r["mix_tokens"] for r in rows)
    assert 3000 - 5 <= total <= 3000 + 3 * 20
    again = mix(d, target_entropy=0.9, budget_tokens=3000).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    other = mix(d, target_entropy=0.9, budget_tokens=3000, seed=1).collect()
    assert {r["doc_id"] for r in other} != {r["doc_id"] for r in rows}


def test_clashing_and_odd_names_and_long_texts(spark):
    d = docs(spark).withColumns({"a.b`c": F.lit(1), "input_mix_copy": F.lit(1)})
    rows = mix(d, repetition_limit=2.0)
    assert {"input_input_mix_copy", "input_mix_copy", "a.b`c", "mix_copy"} <= set(rows.columns) and rows.where("input_input_mix_copy = 'clash'").count() == 300
    same = mixed(d, repetition_limit=2.0)
    assert same.columns == d.columns and same.where("mix_copy = 'clash'").count() == 300
    long = spark.createDataFrame([Row(doc_id=1, source="s", text="w " * 500_000), Row(doc_id=2, source="t", text="w")])
    assert {r["doc_id"]: r["mix_tokens"] for r in mix(long, repetition_limit=2.0).collect()} == {1: 500_000, 2: 1}
