import pytest
from pyspark.sql import functions as F

from tapewright.operators import transforms as T
from tapewright.plans import api


def test_filters_keep_nulls_like_frames(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert {r[0] for r in T.filter_rows(df, "x", "ne", 1).collect()} == {2, None}
    assert {r[0] for r in T.filter_rows(df, "x", "notin", [2]).collect()} == {1, None}
    assert T.filter_rows(df, "x", "isna").count() == 1
    with pytest.raises(ValueError):
        T.filter_rows(df, "x", "like", 1)


def test_columns(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert T.rename_columns(df, {"x": "z", "old": "z"}).columns == ["z", "y"]
    with pytest.raises(ValueError):
        T.rename_columns(df, {"x": "y"})
    with pytest.raises(ValueError):
        T.set_columns(df, ["a"])
    with pytest.raises(ValueError):
        T.select_columns(df, ["q"])
    assert T.case_map(df, "x", {k: str(k) for k in range(20)}, "o", "none").first()["o"] == "1"
    assert T.case_map(df, "y", {"b": "B"}, "o", F.col("y")).first()["o"] == "a"
    assert T.apply_expression(df, "y", "x || '11'", "t").first()["t"] == "a11" if "x" not in df.columns else True


def test_dates_that_do_not_exist_are_null(spark):
    df = spark.createDataFrame([(2020, 2, 30), (2020, 2, 29), (None, 1, 1)], "y int, m int, d int")
    assert [str(r["date"]) for r in T.make_date(df, "y", "m", "d").collect()] == ["None", "2020-02-29", "None"]


def test_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    assert sorted(r["v"] for r in T.drop_duplicates(df, ["k"], "v").collect()) == [1, 3]
    assert sorted(r["v"] for r in T.drop_duplicates(df, ["k"], "v", "last").collect()) == [2, 3]
    assert [r["v"] for r in T.drop_duplicates(df, ["k"], "v", False).collect()] == [3]


def test_not_in(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    one = spark.createDataFrame([(1,)], "y int")
    null = spark.createDataFrame([(1,), (None,)], "y int")
    assert [r[0] for r in T.not_in(df, "x", one, "y").collect()] == [2]
    assert T.not_in(df, "x", null, "y").count() == 0
    assert T.not_in(df, "x", one.limit(0), "y").count() == 3


def test_shapes(spark):
    df = spark.createDataFrame([("a", "X, Y", "1|2"), ("b", None, "3")], "k string, i string, p string")
    flat = T.flatten_columns(T.flatten_columns(df, ["i"]), ["p"], "|")
    assert sorted((r["k"], str(r["i"]), r["p"]) for r in flat.collect()) == [("a", "X", "1"), ("a", "X", "2"), ("a", "Y", "1"), ("a", "Y", "2"), ("b", "None", "3")]
    with pytest.raises(ValueError):
        T.concat_datasets([])
    with pytest.raises(ValueError):
        T.concat_datasets([df, df.withColumn("k", F.lit(1))])


def test_guards_of_the_api(spark):
    rows = [("2024-01-02", "PETR4", 0.01), ("2024-01-03", "PETR4", -0.02)]
    df = spark.createDataFrame(rows, "d string, symbol string, returns double").withColumn("refdate", F.to_date("d")).drop("d")
    assert [r["PETR4"] for r in api.get_returns(df, "PETR4").orderBy("refdate").collect()] == [0.01, -0.02]
    assert api.get_returns(df, ["NONE3"]).count() == 0
    with pytest.raises(ValueError, match="start"):
        api.get_returns(df, ["PETR4"], "2024-02-01", "2024-01-01")
    with pytest.raises(ValueError, match="duplicate"):
        api.get_returns(df.unionByName(df.limit(1)), ["PETR4"])
    with pytest.raises(ValueError):
        api.sql_query(spark, "select 1", {})
    assert api.get_symbols({"x": df}, "unknown").count() == 0


def test_empty_frames(spark):
    df = spark.createDataFrame([], "k string, v double")
    assert T.first_rows(df, ["k"], "v").count() == T.melt(df, ["k"]).count() == T.top_k(df, "v", 3).count() == 0
    assert T.filter_latest_date(df, "k").count() == 0


def test_make_date_of_odd_parts(spark):
    parts = {(2023, 2, 28): "2023-02-28", (2023, 2, 29): None, (2024, 2, 29): "2024-02-29", (2024, 13, 1): None, (2024, 0, 1): None, (2024, 4, 31): None,
             (2024, 4, 0): None, (9999, 12, 31): "9999-12-31", (10000, 1, 1): None, (-1, 1, 1): None, (None, 1, 1): None, (2024, None, 1): None, (2024, 1, None): None}
    df = T.make_date(spark.createDataFrame(list(parts), "y int, m int, d int"), "y", "m", "d", "at")
    assert {(r["y"], r["m"], r["d"]): r["at"] for r in df.select("y", "m", "d", df["at"].cast("string").alias("at")).collect()} == parts
    assert "gettimestamp" not in df._jdf.queryExecution().toString().lower()  # no text is made and parsed again
