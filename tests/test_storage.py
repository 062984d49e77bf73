import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tapewright.functions.fields import Field
from tapewright.functions.scratch import scratch
from tapewright.operators import blocked
from tapewright.operators import checks as Q
from tapewright.operators.transforms import forward_fill
from tapewright.plans import api
from tapewright.sources import readers, sinks
from tapewright.sources import xml_layouts as L
from tapewright.streaming import ingest

D = dt.date


def lines(folder, name, text, encoding="utf-8"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(text.encode(encoding))


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=str)


# ---- headers


def test_rows_follow_their_own_files_header(spark, tmp_path):
    lines(tmp_path / "in", "a.csv", "x,y\n1,2\n")
    lines(tmp_path / "in", "b.csv", "y,x\n2,1\n")
    assert rows(readers.read_csv(spark, f"{tmp_path}/in"), "x", "y") == [("1", "2"), ("1", "2")]


def test_headers_of_other_columns_quotes_and_marks(spark, tmp_path):
    lines(tmp_path / "in", "a.csv", '﻿x;y\n1;"a;b"\n\n3;4\n')
    lines(tmp_path / "in", "b.csv", "y;z;z;\n5;6;7;8\nonly\n")
    lines(tmp_path / "in", "empty.csv", "")
    lines(tmp_path / "in", "head.csv", "w;x\n")
    got = readers.read_csv(spark, f"{tmp_path}/in", ";")
    assert sorted(got.columns) == ["_c3", "w", "x", "y", "z1", "z2"]
    assert rows(got, "x", "y", "z1", "z2", "_c3") == [("1", "a;b", None, None, None), ("3", "4", None, None, None), (None, "5", "6", "7", "8"), (None, "only", None, None, None)]


def test_headers_after_skipped_lines(spark, tmp_path):
    for name, head in (("a.csv", "title\nx,y\n1,2\n"), ("b.csv", "other title\nsep=,\ny,x\n4,3\n")):
        lines(tmp_path / "in", name, head)
    assert rows(readers.read_csv(spark, f"{tmp_path}/in", skip=1, skip_if_startswith="sep="), "x", "y") == [("1", "2"), ("3", "4")]


def test_long_files_in_pieces(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines(tmp_path / "in", "a.csv", "x,y\n" + "".join(f"{k},{-k}\n" for k in range(5000)))
        lines(tmp_path / "in", "b.csv", "y,x\n" + "".join(f"{-k},{k}\n" for k in range(5000)))
        got = readers.read_csv(spark, f"{tmp_path}/in")
        assert got.count() == 10_000 and got.where("cast(x as int) + cast(y as int) = 0").count() == 10_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_one_header_is_read_by_the_scan(spark, tmp_path):
    for name in ("a.csv", "b.csv"):
        lines(tmp_path / "in", name, "x,y\n1,2\n")
    got = readers.read_csv(spark, f"{tmp_path}/in").select("y")
    assert rows(got) == [("2",), ("2",)]
    assert "ReadSchema: struct<y:string>" in got._jdf.queryExecution().toString()


# ---- layouts and outputs


def test_layout_tables():
    assert {L.INSTRUMENT_NAMES[e]: len(f) for e, f in L.INSTRUMENT_FIELDS.items()}["fixed_income_non_tradable"] == 48
    assert sum(map(len, L.INSTRUMENT_FIELDS.values())) == 367 and len(L.INSTRUMENT_FIELDS) == 16
    assert [f.name for f in L.INDEX_FIELDS["BDRInf"]] == ["symbol", "security_id", "security_proprietary", "security_market", "ref_price"]
    for fields in (*L.INSTRUMENT_FIELDS.values(), *L.INDEX_FIELDS.values()):
        names = [f.name for f in fields]
        assert all(names) and len(set(names)) == len(names)
    futures = {f.name: f for f in L.INSTRUMENT_FIELDS["FutrCtrctsInf"]}
    assert futures["asset_settlement_indicator"].tag == "InstrmInf/FutrCtrctsInf/AsstQtnQty" and futures["maturity_date"].kind == "date"
    assert futures["underlying_security_market"].tag.endswith("UndrlygInstrmId/OthrId/PlcOfListg/MktIdrCd")


MESSAGE = """<Doc><Hdr><CreDt>2024-01-02T10:00:00</CreDt></Hdr>
<Instrm><RptParams><RptDtAndTm><Dt>2024-01-02</Dt></RptDtAndTm></RptParams><FinInstrmId><OthrId><Id>7</Id></OthrId></FinInstrmId>
<InstrmInf><EqtyInf><TckrSymb> ABCD4 </TckrSymb><LastPric Ccy="BRL">12.5</LastPric><DstrbtnId>bad</DstrbtnId></EqtyInf></InstrmInf></Instrm>
<Instrm><RptParams><RptDtAndTm><Dt>2024-01-02</Dt></RptDtAndTm></RptParams>
<InstrmInf><FutrCtrctsInf><TckrSymb>DOLG24</TckrSymb><XprtnDt>2024-02-01</XprtnDt></FutrCtrctsInf></InstrmInf></Instrm>
<Instrm><InstrmInf><Unknown><TckrSymb>?</TckrSymb></Unknown></InstrmInf></Instrm></Doc>"""


def test_instruments_from_one_scan(spark, tmp_path):
    lines(tmp_path / "in", "a.xml", MESSAGE)
    tagged = readers.xml_instrument_rows(spark, f"{tmp_path}/in", L.INSTRUMENT_FIELDS, header_tag="Hdr", created="CreDt", names=L.INSTRUMENT_NAMES)
    assert tagged._jdf.queryExecution().executedPlan().toString().count("FileScan xml") == 2  # the messages' heads and the instruments
    assert rows(tagged, "output", "refdate", "symbol", "close", "distribution_id", "maturity_date") == [
        ("equities", D(2024, 1, 2), "ABCD4", 12.5, None, None), ("future_contracts", D(2024, 1, 2), "DOLG24", None, None, D(2024, 2, 1))]
    single = readers.read_xml_instruments(spark, f"{tmp_path}/in", L.INSTRUMENT_FIELDS)["EqtyInf"]
    assert rows(single, "symbol", "security_id", "close") == [("ABCD4", "7", 12.5)]


def test_outputs_share_one_pass_and_keep_their_own_columns(spark, tmp_path):
    text = "00" + " " * 28 + "20240102\n" + "01AB  5\n02AB7777\n01CD  6\n99??\n"
    lines(tmp_path / "in", "a.txt", text)
    datasets = {"01": [Field("name", width=2), Field("n", "integer", width=3)], "02": [Field("name", width=2), Field("n", "numeric", dec=2, width=4)], "03": [Field("name", width=2)]}
    tagged = readers.fwf_multi_rows(spark, f"{tmp_path}/in", datasets, names={"01": "one"})
    assert tagged.columns == ["output", "refdate", "name", "n@one", "n@02"]
    path = sinks.write_outputs(tagged, f"{tmp_path}/out", "bulletin", partitioning=["refdate"])
    assert rows(sinks.read_output(spark, path, "one", {"refdate": "date", "name": "string", "n": "long"})) == [(D(2024, 1, 2), "AB", 5), (D(2024, 1, 2), "CD", 6)]
    assert rows(sinks.read_output(spark, path, "02", {"name": "string", "n": "double"})) == [("AB", 77.77)]
    assert sinks.read_output(spark, path, "03", {"name": "string"}).count() == 0
    sinks.write_outputs(tagged.where("output = '02'").withColumn("n@02", F.lit(1.0)), f"{tmp_path}/out", "bulletin", partitioning=["refdate"])
    assert sinks.read_output(spark, path, "one", {"n": "long"}).count() == 2
    assert rows(sinks.read_output(spark, path, "02", {"n": "double"})) == [(1.0,)]


@pytest.mark.parametrize("partitioning", [(), ("p",)])
def test_outputs_without_rows_leave_what_was_there(spark, tmp_path, partitioning):
    df = spark.range(4).withColumn("p", F.col("id") % 2)
    outputs = {"a": df, "b": df.where("id > 9")}
    assert sinks.write_multi(outputs, str(tmp_path), "d", partitioning=partitioning) == [f"{tmp_path}/input/d-a"]
    assert not list(tmp_path.glob("input/d-b/**/*.parquet"))
    assert sinks.write_multi({"a": df.where("id > 9")}, str(tmp_path), "d", partitioning=partitioning) == []
    assert spark.read.parquet(f"{tmp_path}/input/d-a").count() == 4
    assert sinks.write_multi({"a": df.where("id = 1")}, str(tmp_path), "d", partitioning=partitioning) == [f"{tmp_path}/input/d-a"]
    assert spark.read.parquet(f"{tmp_path}/input/d-a").count() == (3 if partitioning else 1)


# ---- replacement


def test_a_failing_write_keeps_the_old_rows(spark, tmp_path):
    path = f"{tmp_path}/single"
    sinks.write_single(spark.range(3), path)
    stopped = spark.range(5).withColumn("id", F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("stopped")).cast("long")))
    with pytest.raises(Exception, match="stopped"):
        sinks.write_single(stopped, path)
    assert spark.read.parquet(path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["single"]
    sinks.write_single(spark.read.parquet(path).where("id > 0"), path)
    assert rows(spark.read.parquet(path)) == [(1,), (2,)]


def test_a_stop_between_the_renames_is_mended(spark, tmp_path):
    path = f"{tmp_path}/single"
    sinks.write_single(spark.range(3), path)
    (tmp_path / "single").rename(tmp_path / ".single.old")
    sinks.recover(spark, path)
    assert spark.read.parquet(path).count() == 3
    (tmp_path / "single").rename(tmp_path / ".single.old")
    sinks.write_single(spark.range(9), path)
    assert spark.read.parquet(path).count() == 9 and [p.name for p in tmp_path.iterdir()] == ["single"]


def test_an_export_may_read_its_target(spark, tmp_path):
    path = f"{tmp_path}/export"
    sinks.write_single(spark.range(4).withColumn("p", F.col("id") % 2), path)
    spark.read.parquet(path).createOrReplaceTempView("exported")
    sinks.sql_export(spark, "SELECT id + 1 AS id, p FROM exported", path, ["p"])
    assert rows(spark.read.parquet(path), "id") == [(1,), (2,), (3,), (4,)]


# ---- incremental loads


def test_only_touched_partitions_are_read_and_written(spark, tmp_path):
    path = f"{tmp_path}/target"
    old = spark.createDataFrame([(1, 10, 1, "a"), (2, 20, 1, "b"), (3, 30, 1, None)], "k long, value long, version int, day string")
    sinks.write_partitioned(old, path, ["day"])
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    new = spark.createDataFrame([(2, 21, 2, "b"), (4, 40, 2, "b"), (3, 29, 0, None)], old.schema)
    ingest.merge_reload(spark, path, new, ["k", "day"], "version", ["day"])
    got = spark.read.schema(old.schema).parquet(path)
    assert rows(got, "k", "value") == [(1, 10), (2, 21), (3, 30), (4, 40)]
    assert [p for p in before if p.exists() and "day=a" in str(p)]
    plan = sinks.touched(got, new.where("day = 'b'"), ["day"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "= b" in plan
    with pytest.raises(ValueError, match="partition"):
        ingest.merge_reload(spark, path, new, ["k"], "version", ["day"])


def test_file_ledger(spark, tmp_path):
    source, target = tmp_path / "in", f"{tmp_path}/out"

    def parse(text):
        cells = F.split("value", ";")
        return text.where("value != ''").select(cells[0].alias("k"), cells[1].alias("day"), "file")

    def take(**options):
        return ingest.ingest_files(spark, str(source), parse, target, ["day"], f"{tmp_path}/ledger", **options)

    def stored():
        return rows(spark.read.schema("k string, day string, source string").parquet(target), "k", "day", "source")

    lines(source, "a.txt", "1;x\n2;y:1\n")
    lines(source, "b.txt", "3;x\n")
    assert take() == 2 and take() == 0
    assert stored() == [("1", "x", "a.txt"), ("2", "y:1", "a.txt"), ("3", "x", "b.txt")]
    lines(source, "c.txt", "4;x\n")
    lines(source, "a.txt", "1;x\n9;x\n7;z\n")  # fetched again: one row has gone from its day
    assert take(max_files=1) == 2
    assert stored() == [("1", "x", "a.txt"), ("3", "x", "b.txt"), ("4", "x", "c.txt"), ("7", "z", "a.txt"), ("9", "x", "a.txt")]
    lines(source, "b.txt", "\n")
    assert take() == 1 and take() == 0
    assert ("3", "x", "b.txt") not in stored() and len(stored()) == 4


# ---- rules


def test_ten_rules_read_the_table_once(spark, tmp_path):
    sinks.write_single(spark.createDataFrame([(D(2024, 1, 2), "A", 1.0), (D(2024, 1, 2), "A", None), (D(2024, 1, 5), "B", 9.0)], "refdate date, symbol string, x double"), f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    from tapewright.operators.calendar import build_calendar

    cal = build_calendar(spark, "2024-01-01", "2024-01-31", ["2024-01-02"])
    rules = [
        {"rule": "calendar_gaps", "cal": cal}, {"rule": "calendar_gaps", "cal": cal, "group_column": "symbol", "end": "2024-01-08"}, {"rule": "unexpected_dates", "cal": cal},
        {"rule": "no_duplicates", "key": ["refdate", "symbol"]}, {"rule": "no_duplicates", "key": ["x"]}, {"rule": "not_null", "columns": ["x", "symbol"]},
        {"rule": "value_range", "column": "x", "max": 5}, {"rule": "period_gaps", "frequency": "monthly"}, {"rule": "date_gaps", "cal": cal}, {"rule": "value_range", "column": "symbol", "min": 1},
    ]
    facts, _ = Q.compile_rules(df, rules)
    assert facts.frame()._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = Q.dq_suite({"t": df}, {"t": rules})
    apart = None
    for rule in rules[:9]:
        options = {k: v for k, v in rule.items() if k != "rule"}
        part = Q.RULES[rule["rule"]](df, **options)
        apart = part if apart is None else apart.unionByName(part)
    assert rows(got.where("detail != 'symbol: not a number'").drop("dataset")) == rows(apart.drop("dataset"))
    assert got.where("detail = 'symbol: not a number'").count() == 1
    bad = Q.dq_suite({"t": df}, {"t": [{"rule": "not_null", "columns": ["nowhere"]}, {"rule": "value_range", "column": "x", "most": 3}]})
    assert bad.count() == 2
    assert Q.dq_suite({"t": df.limit(0)}, {"t": rules[:9]}).count() == 0


# ---- long series


def test_blocks_equal_plain_windows(spark):
    rng = random.Random(5)
    data = [(k, rng.choice(["hot"] * 5 + ["a", "b", None]), None if rng.random() < 0.7 else k * 1.0, 1 + rng.random() / 100) for k in range(1500)]
    data += [(k, "void", None, 1.0) for k in range(2000, 2040)]
    df = spark.createDataFrame(data, "at long, series string, x double, ratio double").repartition(6)
    plain = rows(forward_fill(df, "x", "at", ["series"]), "at", "x")
    assert rows(blocked.forward_fill(df, "x", "at", ["series"], 12), "at", "x") == plain
    numbered = blocked.blocks(df, ["series"], "at", 12)
    assert numbered.where("series = 'hot'").select(blocked.BLOCK).distinct().count() > 4
    from tapewright.operators import timeseries as X

    for order in ("at", "-at"):
        want = {r["at"]: r["d"] for r in X.lag_diff(df, "ratio", ["series"], order, "d").collect()}
        got = {r["at"]: r["d"] for r in blocked.lag_diff(df, "ratio", ["series"], order, 12, "d").collect()}
        assert got == want
        want = {r["at"]: r["p"] for r in X.reverse_cum_product(df, "ratio", ["series"], order, "p").collect()}
        got = {r["at"]: r["p"] for r in blocked.reverse_cum_product(df, "ratio", ["series"], order, "p", 12).collect()}
        assert got == pytest.approx(want)
    assert blocked.forward_fill(df.limit(0), "x", "at", ["series"], 4).count() == 0


# ---- catalogue


def test_catalogue_of_a_root(spark, tmp_path):
    root = str(tmp_path)
    sinks.write_dataset(spark.range(3), root, "b3-numbers", "input")
    path = sinks.write_dataset(spark.createDataFrame([(1, "x")], "k int, day string"), root, "days", partitioning=["day"])
    sinks.write_partitioned(spark.createDataFrame([(2, 3.5, "y")], "k int, weight double, day string"), path, ["day"])
    assert [(r["layer"], r["dataset"], r["partitions"], r["files"]) for r in api.list_datasets(spark, root).collect()] == [("input", "b3-numbers", [], r0(tmp_path)), ("staging", "days", ["day"], 2)]
    got = api.describe_root(spark, root, ["staging.days"])
    assert [tuple(r)[2:] for r in got.collect()] == [("k", "int", False), ("weight", "double", False), ("day", "string", True)]
    assert rows(api.open_dataset(spark, root, "staging.days")) == [(1, None, "x"), (2, 3.5, "y")]
    with pytest.raises(ValueError, match="no dataset"):
        api.open_dataset(spark, root, "staging.none")


def r0(tmp_path):
    return len(list((tmp_path / "input" / "b3-numbers").glob("*.parquet")))


def test_symbol_lists(spark):
    names = spark.createDataFrame([("PETR", D(2020, 1, 1)), ("VALE", D(2024, 1, 1))], "instrument_asset string, refdate date")
    assert [r[0] for r in api.get_symbols({"instrument_assets": names}, "company").collect()] == ["PETR", "VALE"]
    companies = spark.createDataFrame([("PETR", "Energy", "Oil", "Oil", "1")], "issuing_company string, sector string, subsector string, segment string, code_cvm string")
    tickers = spark.createDataFrame([("PETR4", "PETR"), ("PETR3", "PETR"), ("X3", "X")], "symbol string, issuing_company string")
    members = spark.createDataFrame([("PETR4", "IBOV", 1, D(2024, 1, 1)), ("VALE3", "IBOV", 5, D(2024, 5, 1))], "symbol string, index string, end_month int, refdate date")
    found = {"symbol_properties": api.symbol_properties(tickers, companies), "index_members": members}
    for kind, options, want in (
        ("equity", {}, ["PETR3", "PETR4"]), ("equity", {"sector": "Energy"}, ["PETR3", "PETR4"]), ("equity", {"sector": "Other"}, []), ("equity", {"index": "IBOV"}, ["VALE3"]),
        ("equity", {"index": "IBOV", "end_month": 1}, ["PETR4"]), ("index", {}, ["IBOV"]), ("industry-sector", {}, ["Energy"]), ("company-name", {}, []), ("sector", {}, []),
    ):
        assert [r[0] for r in api.get_symbols(found, kind, **options).collect()] == want


def test_scratch_is_shared_and_can_be_cleared(spark, monkeypatch):
    from tapewright.functions import scratch as module

    monkeypatch.setattr(module, "_handed_out", [])
    assert scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    kept = module.written(spark.range(3), "y")
    assert kept.count() == 3 and module.clear(spark) == 1 and module.clear(spark) == 0
    with pytest.raises(Exception, match="(?i)not.*(exist|found)"):
        module.written(kept, "z")


def test_company_files(spark, tmp_path):
    from tapewright.sources import layouts as Y

    lines(tmp_path / "in", "A.json", '[{"stockCapital": "1.234,50", "roundLot": "x", "cashDividends": [{"rate": "0,25", "approvedOn": "06/05/2021"}, {"rate": null}], "extra": [1]}]')
    lines(tmp_path / "in", "B.json", '[{"stockCapital": null, "subscriptions": []}]')
    key = {"company": F.regexp_extract("file", "([A-Z]).json", 1)}
    got = readers.read_json_tables(spark, f"{tmp_path}/in", "info", Y.COMPANY_INFO, Y.COMPANY_INFO_ARRAYS, key)
    assert rows(got["info"], "company", "stockCapital", "roundLot") == [("A", 1234.5, None), ("B", None, None)]
    assert rows(got["cash_dividends"], "company", "rate", "approvedOn") == [("A", 0.25, D(2021, 5, 6)), ("A", None, None)]
    assert got["stock_dividends"].count() == got["subscriptions"].count() == 0


def test_bulletin_layouts_fill_their_lines(spark, tmp_path):
    from tapewright.sources import layouts as Y

    assert {sum(f.width for f in fields) for fields in Y.BULLETIN.values()} == {350} and len(Y.BULLETIN) == 8
    iopv = "08" + "07ABCD" + "Short name".ljust(12) + "Long name".ljust(30) + "0001234" + " " * 300
    lines(tmp_path / "in", "a.txt", "00".ljust(30) + "20240102\n" + iopv + "\n")
    for got in (readers.read_fwf_multi(spark, f"{tmp_path}/in", Y.BULLETIN, coded=True)["08"], readers.fwf_multi_rows(spark, f"{tmp_path}/in", Y.BULLETIN, coded=True)):
        assert rows(got, "refdate", "tipo_registro", "id_iopv", "sigla_iopv", "nome_iopv", "iopv_abertura", "iopv_min") == [(D(2024, 1, 2), "08", 7.0, "ABCD", "Long name", 12.34, None)]


def test_rows_of_several_tables_ask_for_their_table_once(spark, tmp_path):
    line = "02" + "".join(str(k) for k in range(1, 10))
    spark.createDataFrame([("00" + " " * 28 + "20101220",), (line,), ("03abcdefghi",)], "value string").coalesce(1).write.text(f"{tmp_path}/in")
    datasets = {c: [Field(f"f{k}", kind, width=1) for k in range(9)] for c, kind in (("02", "integer"), ("03", "string"))}
    rows = readers.fwf_multi_rows(spark, f"{tmp_path}/in", datasets)
    got = {r["output"]: r for r in rows.collect()}
    assert [got["02"][f"f{k}@02"] for k in range(9)] == list(range(1, 10)) and got["02"]["f0@03"] is None
    assert [got["03"][f"f{k}@03"] for k in range(9)] == list("abcdefghi") and got["03"]["f0@02"] is None
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CASE WHEN (__output") == 2, plan  # not for each of the 18 columns
    assert "1048576" not in plan  # the line is not copied for each of its cells
