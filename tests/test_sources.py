import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F

from tapewright.functions.fields import Field, apply_fields, schema_of, seconds_of_day
from tapewright.sources import readers, sinks
from tapewright.streaming import ingest

D = dt.date


def test_types(spark):
    df = spark.createDataFrame(
        [("7", "1.234.567,89", "0000012345", "02/01/2024", "YES", "x", "10:20:30"), ("7.5", "1d", "NaN", "31/02/2024", "maybe", " ", "99"), (None,) * 7],
        "id string, amount string, cents string, day string, active string, text string, at string",
    )
    fields = [
        Field("id", "int"), Field("amount", "number", thousands=".", decimal=","), Field("cents", "numeric", dec=2, sign="-"),
        Field("day", "date", format="%d/%m/%Y"), Field("active", "boolean"), Field("text", "character"), Field("at", "time"), Field("gone", "date"),
    ]
    rows = [tuple(r) for r in apply_fields(df, fields).collect()]
    assert rows[0] == (7, 1234567.89, -123.45, D(2024, 1, 2), True, "x", "10:20:30")
    assert rows[1] == (None, None, None, None, None, " ", None) and rows[2] == (None,) * 7
    assert schema_of(fields)["cents"].dataType.simpleString() == "double"
    assert apply_fields(df, fields).select(seconds_of_day(F.col("at"))).first()[0] == 37230
    with pytest.raises(ValueError):
        Field("x", "money")


def test_multi_record_files_keep_their_own_header_date(spark, tmp_path):
    for day, code in (("20101220", "PETR4"), ("20101221", "VALE5")):
        lines = ["00" + " " * 28 + day, f"01{code:<8}002557", "02x", "99"]
        (tmp_path / f"{day}.txt").write_text("\n".join(lines))
    fields = {"01": [Field("symbol", width=8), Field("last", "numeric", dec=2, width=6)], "02": [Field("x", width=1)], "03": [Field("y", width=1)]}
    got = readers.read_fwf_multi(spark, str(tmp_path), fields)
    assert sorted(tuple(r) for r in got["01"].collect()) == [(D(2010, 12, 20), "PETR4", 25.57), (D(2010, 12, 21), "VALE5", 25.57)]
    assert got["02"].count() == 2 and got["03"].count() == 0


def test_delimited_and_fixed_width_with_skipped_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Status do Arquivo: Final\nA;1\nStatus;2\n")
    (tmp_path / "b.csv").write_text("B;3\n")
    got = readers.read_csv(spark, str(tmp_path / "*.csv"), ";", skip_if_startswith="Status", names=["n", "v"])
    assert sorted(tuple(r) for r in got.collect()) == [("A", "1"), ("B", "3"), ("Status", "2")]
    got = readers.read_csv(spark, str(tmp_path / "a.csv"), ";", skip=1, names=["n", "v"])
    assert sorted(tuple(r) for r in got.collect()) == [("A", "1"), ("Status", "2")]
    with gzip.open(tmp_path / "c.txt.gz", "wt") as f:
        f.write("HEAD\nDI1F16 001458\n")
    got = readers.read_fwf(spark, str(tmp_path / "c.txt.gz"), [Field("s", width=7), Field("v", "numeric", dec=2, width=6)], skip=1)
    assert [tuple(r) for r in got.collect()] == [("DI1F16", 14.58)]


def test_json(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"header": {"date": "2024-01-02"}, "results": [{"c": "A", "codes": [{"code": "X", "isin": "1"}, {"code": "Y", "isin": "2"}]}, {"c": "B", "codes": null}]}')
    got = readers.read_json(spark, str(tmp_path / "a.json"), "results", {"date": "header.date"})
    assert got.columns[0] == "date" and got.count() == 2
    rows = sorted((r["c"], r["code"]) for r in readers.json_explode_codes(got, "codes").collect())
    assert rows == [("A", "X"), ("A", "Y"), ("B", None)]
    parts = readers.json_nested_split(got, ["c"], ["codes"], ["c"])
    assert parts["root"].count() == 2 and parts["codes"].count() == 2


def test_xml(spark, tmp_path):
    (tmp_path / "a.xml").write_text(
        "<Document><Instrm><Id>1</Id><InstrmInf><EqtyInf><T> PETR4 </T></EqtyInf></InstrmInf></Instrm>"
        "<Instrm><Id>2</Id><InstrmInf><FutrInf><T>DI1</T></FutrInf></InstrmInf></Instrm></Document>"
    )
    fields = {"EqtyInf": [Field("id", "integer", tag="Id"), Field("symbol", tag="InstrmInf/EqtyInf/T"), Field("none", tag="InstrmInf/EqtyInf/Zz")], "Other": [Field("id", tag="Id")]}
    got = readers.read_xml_instruments(spark, str(tmp_path / "a.xml"), fields)
    assert [tuple(r) for r in got["EqtyInf"].collect()] == [(1, "PETR4", None)] and got["Other"].count() == 0


def test_messages(spark):
    rows = [("m1", D(2024, 1, 2), "2024-01-02 18:00", D(2024, 1, 2), 1.0), ("m2", D(2024, 1, 2), "2024-01-02 20:00", D(2024, 1, 2), 2.0), ("m2", D(2024, 1, 2), "2024-01-02 20:00", D(2024, 1, 3), 3.0), ("m3", D(2024, 1, 2), None, D(2024, 1, 2), 4.0)]
    df = spark.createDataFrame(rows, "message string, day date, created string, trade date, last double")
    last = readers.latest_message(df, "day", "created", "message")
    assert {r["last"] for r in last.collect()} == {2.0, 3.0}
    assert [r["last"] for r in readers.drop_cross_day_rows(last, "trade", "day", "message").collect()] == [2.0]
    other = df.where("last = 3.0")
    assert readers.drop_cross_day_rows(other, "trade", "day", "message").count() == 1
    assert readers.drop_cross_day_rows(other.drop("trade"), "trade", "day", "message").count() == 1


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("2026-04-30", "L", 1.0), ("2026-05-01", "L", 9.0)], "refdate string, symbol string, price double")
    sinks.write_partitioned(df, path, ["refdate"])
    sinks.write_partitioned(spark.createDataFrame([("2026-05-01", "E", 2.0)], df.schema), path, ["refdate"])
    got = sorted(tuple(r) for r in spark.read.schema(df.schema).parquet(path).select("refdate", "symbol").collect())
    assert got == [("2026-04-30", "L"), ("2026-05-01", "E")]
    assert sorted(p.name for p in (tmp_path / "t").glob("refdate=*")) == ["refdate=2026-04-30", "refdate=2026-05-01"]


def test_stream_takes_each_file_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    calls = []

    def parse(lines):
        calls.append(lines.count())
        return lines.selectExpr("split(value, ';')[0] as refdate", "split(value, ';')[1] as symbol")

    def run():
        ingest.ingest_new_files(spark, str(source), parse, str(tmp_path / "out"), ["refdate"], str(tmp_path / "check"))
        return sorted(tuple(r) for r in spark.read.schema("symbol string, refdate string").parquet(str(tmp_path / "out")).collect())

    (source / "1.txt").write_text("d1;A\nd1;B\n")
    (source / "2.txt").write_text("d2;C\n")
    assert run() == [("A", "d1"), ("B", "d1"), ("C", "d2")]
    assert run() == [("A", "d1"), ("B", "d1"), ("C", "d2")] and sum(calls) == 3
    (source / "3.txt").write_text("d1;Z\n")
    assert run() == [("C", "d2"), ("Z", "d1")]


def test_layouts_from_a_table(spark):
    from tapewright.functions.fields import field_of, fields_of
    from tapewright.sources.layouts import INDEX_MONTHS, TRADES

    rows = [{"name": "code", "type": "character", "width": 4}, {"name": "price", "type": "numeric(dec=2, sign='-')", "width": 6}, {"name": "day", "type": "date(format='%d%m%Y')", "width": 8}]
    df = spark.createDataFrame([("AB  00012531122023",)], "value string")
    assert [tuple(r) for r in readers.parse_fwf(df, "value", fields_of(rows)).collect()] == [("AB", -1.25, D(2023, 12, 31))]
    assert len(TRADES) == 11 and len(INDEX_MONTHS) == 15
    with pytest.raises(ValueError):
        field_of("x", "numeric(")


def test_lines_are_skipped_in_every_file(spark, tmp_path):
    for k in range(6):
        (tmp_path / f"{k}.txt").write_text("HEAD\n" + "".join(f"{k}{j}\n" for j in range(2)))
    (tmp_path / "short.txt").write_text("HEAD\n")
    (tmp_path / "empty.txt").write_text("")
    fields = [Field("a", width=1), Field("b", width=1)]
    wanted = sorted((str(k), str(j)) for k in range(6) for j in range(2))
    assert sorted(tuple(r) for r in readers.read_fwf(spark, str(tmp_path), fields, skip=1).collect()) == wanted
    got = readers.read_csv(spark, str(tmp_path), names=["v"], skip=1)
    assert sorted(r["v"] for r in got.collect()) == sorted(a + b for a, b in wanted)
    got = readers.read_csv(spark, str(tmp_path), names=["v"], skip=1, skip_if_startswith="1")
    assert sorted(r["v"] for r in got.collect()) == sorted(a + b for a, b in wanted if (a, b) != ("1", "0"))
    got = readers.read_csv(spark, str(tmp_path), names=["v"], skip_if_startswith="HEAD")
    assert sorted(r["v"] for r in got.collect()) == sorted(a + b for a, b in wanted)
    assert readers.read_csv(spark, str(tmp_path), names=["v"], skip=3).count() == 0
    # a file of several blocks
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        (tmp_path / "big").mkdir()
        (tmp_path / "big" / "one.txt").write_text("HEAD\n" + "".join(f"{j % 10}x\n" for j in range(200)))
        assert readers.read_csv(spark, str(tmp_path / "big"), names=["v"], skip=1).where("v like '%x'").count() == 200
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_batches_of_one_partition_can_be_kept(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()

    def parse(lines):
        part = F.split("value", ";")
        return lines.select(part[0].alias("refdate"), part[1].alias("symbol"))

    for k, text in enumerate(("d1;A\n", "d1;B\nd2;C\n", "d1;D\n")):
        (source / f"{k}.txt").write_text(text)
        ingest.ingest_new_files(spark, str(source), parse, str(tmp_path / "out"), ["refdate"], str(tmp_path / "check"), replace=False)
    got = spark.read.parquet(str(tmp_path / "out")).select("refdate", "symbol").collect()
    assert sorted(tuple(r) for r in got) == [("d1", "A"), ("d1", "B"), ("d1", "D"), ("d2", "C")]


def test_index_messages_have_their_own_dates(spark, tmp_path):
    for k, date in enumerate(("2024-01-02", "2024-01-03")):
        rows = "".join(f"<IndxInf><T>A{k}{j}</T></IndxInf>" for j in range(2)) + f"<BDRInf><T>B{k}</T></BDRInf>"
        (tmp_path / f"{k}.xml").write_text(f"<Doc><BizGrp><TradDt><Dt>{date}</Dt></TradDt>{rows}</BizGrp></Doc>")
    fields = [Field("symbol", tag="T")]
    got = readers.read_xml_indexes(spark, str(tmp_path), {"IndxInf": fields, "BDRInf": fields}, {"IndxInf": "T string", "BDRInf": "T string"})
    assert sorted((str(r["refdate"]), r["symbol"]) for r in got["IndxInf"].collect()) == [
        ("2024-01-02", "A00"), ("2024-01-02", "A01"), ("2024-01-03", "A10"), ("2024-01-03", "A11")
    ]
    assert sorted((str(r["refdate"]), r["symbol"]) for r in got["BDRInf"].collect()) == [("2024-01-02", "B0"), ("2024-01-03", "B1")]
    (tmp_path / "2.xml").write_text("<Doc><IndxInf><T>C</T></IndxInf></Doc>")
    with pytest.raises(Exception, match="TradDt not found"):
        readers.read_xml_indexes(spark, str(tmp_path), {"IndxInf": fields}, {"IndxInf": "T string"})["IndxInf"].collect()


def test_instruments_have_the_creation_time_of_their_message(spark, tmp_path):
    for k in range(2):
        body = f"<Instrm><InstrmInf><E><S>X{k}</S></E></InstrmInf></Instrm>"
        (tmp_path / f"{k}.xml").write_text(f"<Doc><Hdr><CreDtAndTm>2024-01-0{k + 1}T10:00:00</CreDtAndTm></Hdr>{body}</Doc>")
    fields = [Field("symbol", tag="InstrmInf/E/S")]
    got = readers.read_xml_instruments(spark, str(tmp_path), {"E": fields}, schema="InstrmInf struct<E struct<S string>>", header_tag="Hdr")["E"]
    assert sorted(tuple(r) for r in got.collect()) == [("2024-01-01T10:00:00", "X0"), ("2024-01-02T10:00:00", "X1")]
    none = got.withColumn("day", F.lit(None).cast("date")).withColumn("creation_date", F.lit(None).cast("string"))
    with pytest.raises(ValueError):
        readers.latest_message(none, "day", "creation_date", "symbol")


def test_partition_columns_and_kinds(spark):
    from tapewright.operators.transforms import filter_date_range
    from tapewright.plans import api

    df = spark.createDataFrame([("A", "x", "1", 3)], "symbol string, trading_name string, code_cvm string, end_month int")
    found = api.describe_datasets({"companies": df}, {"companies": ["symbol"]}).collect()
    assert [(r["column"], r["is_partition"]) for r in found] == [("symbol", True), ("trading_name", False), ("code_cvm", False), ("end_month", False)]
    assert [r["symbol"] for r in api.get_symbols({"companies_names": df}, "company-cvm-code").collect()] == ["1"]
    funds = spark.createDataFrame([(D(2024, 1, 1), "ETF", "A"), (D(2024, 1, 2), "Fixed Income ETF", "B")], "refdate date, fund_type string, symbol string")
    assert [r["symbol"] for r in api.get_symbols({"listed_funds": funds}, "FIETF").collect()] == ["B"]
    dates = spark.createDataFrame([(D(1999, 1, 1),), (D(2005, 1, 1),), (D(2999, 1, 1),)], "refdate date")
    assert [r["refdate"] for r in filter_date_range(dates, "refdate").collect()] == [D(2005, 1, 1)]
    assert filter_date_range(dates, "refdate", end="2004-01-01").count() == 0
    with pytest.raises(ValueError):
        filter_date_range(dates, "refdate", "2005-01-01", "2004-01-01")


def test_layouts_type_their_records(spark, tmp_path):
    from tapewright.sources import layouts as L

    assert [sum(f.width for f in x) for x in (L.PRICE_HISTORY, L.ECONOMIC_INDICATORS)] == [245, 109]
    assert [len(x) for x in (L.PRICE_HISTORY, L.REGISTERED_CONTRACTS, L.DERIVATIVES_DAILY, L.PRICE_REPORTS, L.COMPANY_REGISTRATION)] == [26, 31, 80, 30, 48]
    values = {"regtype": "01", "refdate": "20240102", "symbol": "PETR4", "close": "0000000003725", "isin": "BRPETRACNPR6", "strike_price_in_points": "0000001500000"}
    line = "".join(values.get(f.name, "").ljust(f.width) for f in L.PRICE_HISTORY)
    (tmp_path / "h.txt").write_text("00HEADER".ljust(245) + "\n" + line + "\n" + "99".ljust(245) + "\n")
    rows = readers.read_fwf(spark, str(tmp_path), L.PRICE_HISTORY).where("regtype = '01'").collect()
    assert len(rows) == 1 and (rows[0]["refdate"], rows[0]["symbol"], rows[0]["close"], rows[0]["strike_price_in_points"]) == (D(2024, 1, 2), "PETR4", 37.25, 1.5)
    tags = {f.name: f.tag for f in L.PRICE_REPORTS}
    assert tags["close"] == "FinInstrmAttrbts/LastPric" and {f.name: f.kind for f in L.PRICE_REPORTS}["refdate"] == "date"
    money = next(f for f in L.CASH_DIVIDENDS if f.name == "value_cash")
    df = apply_fields(spark.createDataFrame([("1.234,5", "ON")], "value_cash string, type_stock string"), L.CASH_DIVIDENDS)
    assert (money.thousands, money.decimal) == (".", ",") and tuple(df.first()) == (1234.5, "ON")


def test_packed_json_files_are_read_as_files_are(spark, tmp_path):
    texts = {"a": '{"name": "A", "parts": [{"n": "1"}, {"n": "2"}]}', "b": '[{"name": "B"}, {"name": "C", "parts": [{"n": "3"}]}]', "c": '{"name": null, "parts": null}'}
    for k, text in texts.items():
        (tmp_path / f"{k}.json").write_text(text)
    packed = spark.createDataFrame([(f"/x/{k}.json", t) for k, t in texts.items()], "file string, value string")
    layouts, key = {"root": [Field("name")], "parts": [Field("n", "integer")]}, {"key": F.regexp_extract("file", "([a-z])[.]json$", 1)}
    both = [readers.read_json_tables(spark, source, "root", layouts, {"parts": "parts"}, key) for source in (str(tmp_path), packed)]
    for table in ("root", "parts"):
        one, other = (sorted(map(str, tables[table].collect())) for tables in both)
        assert one == other and len(one) == {"root": 4, "parts": 3}[table]
