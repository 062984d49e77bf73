"""Queries over the tables, one per operator, with the same question as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.functions.fields import Field, apply_fields, seconds_of_day
from tapewright.functions.scratch import scratch, table
from tapewright.operators import calendar as C
from tapewright.operators import checks as Q
from tapewright.operators import curves as R
from tapewright.operators import symbols as S
from tapewright.operators import timeseries as X
from tapewright.operators import transforms as T
from tapewright.plans import api
from tapewright.sources import readers, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name or f.__name__] = f
        if sql:
            SQL[name or f.__name__] = sql
        return f

    return add


# ---- shared inputs

HOLIDAYS = ("2024-01-01", "2024-01-15", "1996-12-25", "1997-01-01")


def bars(spark: SparkSession, d: str, by: str = "event_type") -> DataFrame:
    """Daily candles of the events by type or user: refdate, symbol, open, high, low, close."""
    e = table(spark, d, "events").withColumn("symbol", F.col(by).cast("string"))
    return X.ohlc_candles(e, "symbol", "ts", "value", "event_id")


def _bars_sql(by: str = "event_type") -> str:
    return f"""candles AS (
        SELECT CAST(ts AS DATE) AS refdate, CAST({by} AS VARCHAR) AS symbol,
               arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
               arg_max(value, (ts, event_id)) AS close
        FROM events WHERE value IS NOT NULL GROUP BY 1, 2)"""


def returned(spark: SparkSession, d: str) -> DataFrame:
    return X.simple_log_returns(bars(spark, d), "close", ["symbol"], "refdate")


_RETURNS_SQL = f"""{_bars_sql()},
    lagged AS (SELECT *, lag(close) OVER w AS before, row_number() OVER w AS rn FROM candles WINDOW w AS (PARTITION BY symbol ORDER BY refdate)),
    returned AS (
        SELECT refdate, symbol, open, high, low, close, close / nullif(before, 0) - 1 AS pct_return,
               CASE WHEN close / nullif(before, 0) > 0 THEN ln(close / nullif(before, 0)) END AS log_return
        FROM lagged WHERE rn > 1)"""


def cal24(spark: SparkSession) -> DataFrame:
    return C.build_calendar(spark, "2023-12-15", "2024-03-15", HOLIDAYS)


def _cal_sql(start: str, end: str, kind: str = "bizday") -> str:
    dates = ", ".join(f"DATE '{h}'" for h in HOLIDAYS)
    test = "TRUE" if kind == "actual" else f"(dayofweek(d) NOT IN (0, 6) AND d NOT IN ({dates}))"
    return f"""days AS (SELECT CAST(unnest(generate_series(TIMESTAMP '{start}', TIMESTAMP '{end}', INTERVAL 1 DAY)) AS DATE) AS d),
    marked AS (SELECT d, {test} AS b FROM days),
    cal AS (
        SELECT d AS cal_date, b AS is_bizday,
               CAST(sum(CASE WHEN b THEN 1 ELSE 0 END) OVER (ORDER BY d ROWS UNBOUNDED PRECEDING) AS BIGINT) AS biz_idx,
               min(CASE WHEN b THEN d END) OVER (ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_bizday
        FROM marked)"""


_CAL24 = _cal_sql("2023-12-15", "2024-03-15")
_CAL_ALL = _cal_sql("1994-12-01", "2003-12-31")


def cal_all(spark: SparkSession) -> DataFrame:
    return C.build_calendar(spark, "1994-12-01", "2003-12-31", HOLIDAYS)


def six(column: str):
    return F.round(column, 6).alias(column)


# ---- sources


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def load_dataset(spark, d):
    return readers.load_dataset(spark, f"{d}/nation.parquet", "n_nationkey int, n_name string, n_regionkey int")


@query("SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def scan_columns(spark, d):
    return readers.load_dataset(spark, f"{d}/lineitem.parquet", columns=("l_orderkey", "l_partkey", "l_quantity"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1997-12-31' AND o_orderpriority = '5-LOW'")
def scan_filter(spark, d):
    where = F.col("o_orderstatus").isin("F", "P") & F.col("o_orderdate").between("1996-01-01", "1997-12-31") & (F.col("o_orderpriority") == "5-LOW")
    return readers.load_dataset(spark, f"{d}/orders.parquet", where=where, columns=("o_orderkey", "o_totalprice"))


@query("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def scan_partition(spark, d):
    path = scratch(spark, "by-priority")
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    sinks.write_partitioned(orders, path, ["o_orderpriority"])
    return readers.load_dataset(spark, path, orders.schema, where=F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 20")
def head(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey").orderBy("o_orderkey").limit(20)


@query("SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def read_csv(spark, d):
    path = scratch(spark, "csv")
    columns = ("p_partkey", "p_name", "p_size", "p_retailprice")
    table(spark, d, "part").select(*columns).write.option("sep", ";").option("header", True).csv(path)
    fields = [Field("p_partkey", "integer"), Field("p_name"), Field("p_size", "integer"), Field("p_retailprice", "numeric")]
    text = readers.read_csv(spark, path, ";", skip_if_startswith="p_partkey;", names=columns)
    return apply_fields(text, fields).withColumn("p_size", F.col("p_size").cast("int"))


_FWF = [Field("custkey", "integer", width=10), Field("name", width=20), Field("cents", "numeric", dec=2, width=12), Field("segment", width=12)]


def _fwf_text(customers: DataFrame):
    return F.concat(
        F.lpad(F.col("c_custkey").cast("string"), 10, "0"),
        F.rpad("c_name", 20, " "),
        F.lpad(F.round(F.col("c_acctbal") * 100).cast("long").cast("string"), 12, " "),
        F.rpad("c_mktsegment", 12, " "),
    )


@query("SELECT c_custkey AS custkey, c_name AS name, round(c_acctbal, 2) AS cents, c_mktsegment AS segment FROM customer")
def read_fwf(spark, d):
    path = scratch(spark, "fwf")
    customers = table(spark, d, "customer")
    customers.select(_fwf_text(customers).alias("value")).write.text(path)
    return readers.read_fwf(spark, path, _FWF).withColumn("cents", F.round("cents", 2))


@query("SELECT DATE '2010-12-20' AS refdate, c_custkey AS custkey, c_mktsegment AS segment FROM customer")
def read_fwf_multi(spark, d):
    """Every file: a header, then customers as records 01 and nations as records 02."""
    path = scratch(spark, "bulletin")
    customers = table(spark, d, "customer")
    body = customers.select(F.concat(F.lit("01"), F.lpad(F.col("c_custkey").cast("string"), 10, "0"), F.rpad("c_mktsegment", 12, " ")).alias("value"))
    head_line = F.concat(F.rpad(F.lit("00"), 30, " "), F.lit("20101220"))
    body.withColumn("part", F.spark_partition_id()).withColumn("value", F.concat_ws("\n", head_line, "value")).select("value").write.text(path)
    fields = {"01": [Field("custkey", "integer", width=10), Field("segment", width=12)], "02": [Field("x", width=2)]}
    return readers.read_fwf_multi(spark, path, fields)["01"]


@query("SELECT CAST(event_id AS BIGINT) AS event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, 'events' AS source FROM events")
def read_json(spark, d):
    """Whole-file JSON with the rows in an array beside a constant of the file."""
    path = scratch(spark, "json")
    e = table(spark, d, "events").withColumn("p", F.from_json("props", "k long"))
    rows = e.select(F.struct("event_id", "user_id", F.col("p.k").alias("k")).alias("r"), F.floor(F.col("event_id") / 5000).alias("g"))
    files = rows.groupBy("g").agg(F.collect_list("r").alias("rows")).select(F.struct(F.struct(F.lit("events").alias("source")).alias("header"), "rows").alias("doc"))
    files.select("doc.*").write.option("maxRecordsPerFile", 1).json(path)  # one document a file
    schema = "header struct<source string>, rows array<struct<event_id long, user_id long, k long>>"
    return readers.read_json(spark, path, "rows", {"source": "header.source"}, schema)


@query("SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_path_columns(spark, d):
    whole = table(spark, d, "events").select("event_id", "event_type", F.from_json("props", "k long").alias("d"))
    return whole.select("event_id", "event_type", readers.at_path(F.col("d"), "k").alias("k"))


@query("SELECT o_orderkey, l_partkey, l_quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F'")
def json_nested_split(spark, d):
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_partkey", "l_quantity")).alias("lines"))
    docs = table(spark, d, "orders").where("o_orderstatus = 'F'").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return readers.json_nested_split(docs, ["o_orderkey"], ["lines"], ["o_orderkey"])["lines"]


@query("SELECT o_orderkey, l_partkey AS code FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey")
def json_explode_codes(spark, d):
    codes = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_partkey").alias("code"))).alias("codes"))
    docs = table(spark, d, "orders").select("o_orderkey").join(codes, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return readers.json_explode_codes(docs.select("o_orderkey", "codes"), "codes")


def _xml(spark: SparkSession, d: str) -> str:
    path = scratch(spark, "xml")
    s = table(spark, d, "supplier")
    kind = F.when(F.col("s_nationkey") % 2 == 0, "EqtyInf").otherwise("FutrCtrctsInf")
    body = F.format_string(
        "<Instrm><FinInstrmId><Id>%d</Id></FinInstrmId><InstrmInf><%s><TckrSymb> %s </TckrSymb><Bal>%s</Bal></%s></InstrmInf></Instrm>",
        "s_suppkey", kind, "s_name", F.col("s_acctbal").cast("string"), kind,
    )
    # one document a file, of a bounded number of suppliers
    files = s.select(F.floor(F.col("s_suppkey") / 100).alias("g"), body.alias("x")).groupBy("g").agg(F.concat_ws("", F.collect_list("x")).alias("x"))
    files = files.withColumn("value", F.concat(F.lit("<Document>"), "x", F.lit("</Document>")))
    files.select("g", "value").write.partitionBy("g").text(path)
    return f"{path}/*"


_XML_SCHEMA = "FinInstrmId struct<Id string>, InstrmInf struct<EqtyInf struct<TckrSymb string, Bal string>, FutrCtrctsInf struct<TckrSymb string, Bal string>>"


@query("SELECT s_suppkey AS id, s_name AS symbol, s_acctbal AS balance FROM supplier WHERE s_nationkey % 2 = 0")
def read_xml_instruments(spark, d):
    fields = [Field("id", "integer", tag="FinInstrmId/Id"), Field("symbol", tag="InstrmInf/EqtyInf/TckrSymb"), Field("balance", "numeric", tag="InstrmInf/EqtyInf/Bal")]
    return readers.read_xml_instruments(spark, _xml(spark, d), {"EqtyInf": fields}, schema=_XML_SCHEMA)["EqtyInf"]


@query("SELECT s_suppkey AS id, CASE WHEN s_nationkey % 2 = 1 THEN s_name END AS symbol FROM supplier")
def read_xml_prices(spark, d):
    fields = [Field("id", "integer", tag="FinInstrmId/Id"), Field("symbol", tag="InstrmInf/FutrCtrctsInf/TckrSymb")]
    return readers.read_xml(spark, _xml(spark, d), "Instrm", fields, _XML_SCHEMA)


@query("""SELECT event_id, CAST(ts AS DATE) AS day, user_id FROM events e
    WHERE (CAST(ts AS DATE), hour(ts)) IN (SELECT (CAST(ts AS DATE), max(hour(ts))) FROM events GROUP BY CAST(ts AS DATE))""")
def latest_message(spark, d):
    """An hour's events are a message of the day; the last message stays."""
    e = table(spark, d, "events").withColumns({"day": F.to_date("ts"), "message": F.hour("ts"), "created": F.date_trunc("hour", "ts")})
    return readers.latest_message(e, "day", "created", "message").select("event_id", "day", "user_id")


@query("""WITH m AS (SELECT *, max(CASE WHEN hour(ts) < 22 THEN CAST(ts AS DATE) END) OVER (PARTITION BY user_id) AS md FROM events),
    n AS (SELECT *, count(*) FILTER (WHERE CAST(ts AS DATE) = md) OVER (PARTITION BY user_id) AS own FROM m)
    SELECT event_id, user_id FROM n WHERE CAST(ts AS DATE) = md OR own = 0""")
def drop_cross_day_rows(spark, d):
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    last = e.where(F.hour("ts") < 22).groupBy("user_id").agg(F.max("day").alias("message_day"))
    met = e.join(last, "user_id", "left")
    return readers.drop_cross_day_rows(met, "day", "message_day", "user_id").select("event_id", "user_id")


@query("""SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS refdate, o_orderkey AS id, o_orderstatus AS symbol FROM orders""")
def read_xml_indexes(spark, d):
    """A message per month of orders, each with its own date."""
    path = scratch(spark, "indexes")
    one = F.format_string("<IndxInf><Id>%d</Id><TckrSymb>%s</TckrSymb></IndxInf>", "o_orderkey", "o_orderstatus")
    months = table(spark, d, "orders").groupBy(F.trunc("o_orderdate", "month").alias("first")).agg(F.concat_ws("", F.collect_list(one)).alias("rows"))
    head_text = F.concat(F.lit("<Doc><TradDt><Dt>"), F.col("first").cast("string"), F.lit("</Dt></TradDt>"))
    messages = months.select(F.concat(head_text, "rows", F.lit("</Doc>")).alias("value"))
    messages.write.option("maxRecordsPerFile", 1).text(path)  # one message a file
    fields = [Field("id", "integer", tag="Id"), Field("symbol", tag="TckrSymb")]
    return readers.read_xml_indexes(spark, path, {"IndxInf": fields}, {"IndxInf": "Id string, TckrSymb string"})["IndxInf"]


@query("SELECT page_id, regexp_extract(html, '<html\\b[^>]*\\blang=\"([^\"]*)\"', 1) AS lang FROM pages")
def html_attr(spark, d):
    return table(spark, d, "pages").select("page_id", readers.html_attr(F.col("html"), "html", "lang").alias("lang"))


# ---- sinks


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice, o_orderpriority FROM orders""")
def write_partitioned(spark, d):
    """One partition is written again; the others stay."""
    path = scratch(spark, "partitioned")
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    sinks.write_partitioned(orders, path, ["o_orderpriority"])
    again = orders.where("o_orderpriority = '1-URGENT'").withColumn("o_totalprice", -F.col("o_totalprice"))
    sinks.write_partitioned(again, path, ["o_orderpriority"])
    return spark.read.schema(orders.schema).parquet(path)


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0")
def write_single(spark, d):
    path = scratch(spark, "single")
    sinks.write_single(table(spark, d, "customer").select("c_custkey"), path)
    sinks.write_single(table(spark, d, "customer").where("c_acctbal > 0").select("c_custkey", "c_acctbal"), path)
    return spark.read.parquet(path)


@query("SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem WHERE l_quantity > 10")
def sql_export(spark, d):
    path = scratch(spark, "export")
    api.register_view(table(spark, d, "lineitem"), "input.lineitem")
    sinks.sql_export(spark, "SELECT l_orderkey, l_quantity, l_returnflag FROM `input.lineitem` WHERE l_quantity > 10", path, ["l_returnflag"])
    return spark.read.schema("l_orderkey long, l_quantity double, l_returnflag string").parquet(path)


@query("SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, CAST(NULL AS DOUBLE) AS weight FROM nation")
def write_dataset(spark, d):
    schema = apply_schema("n_nationkey long, n_name string, weight double", spark)
    return spark.read.parquet(sinks.write_dataset(table(spark, d, "nation"), scratch(spark, "layers"), "nation", schema=schema))


def apply_schema(ddl: str, spark: SparkSession):
    return spark.createDataFrame([], ddl).schema


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def write_multi(spark, d):
    root = scratch(spark, "multi")
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    outputs = {s: orders.where(F.col("o_orderstatus") == s) for s in ("F", "none")}
    written = sinks.write_multi(outputs, root, "orders")
    return spark.read.parquet(*[p for p in written if p.endswith("-F")])


@query("SELECT c_custkey, c_name FROM customer")
def save_result(spark, d):
    path = scratch(spark, "result")
    sinks.save_result(table(spark, d, "customer").select("c_custkey", "c_name"), path, "orc")
    return spark.read.orc(path)


# ---- columns


@query("SELECT p_size, p_name FROM part")
def select_columns(spark, d):
    return T.select_columns(table(spark, d, "part"), ["p_size", "p_name"])


@query("SELECT p_partkey, p_brand FROM part", name="select_fields")
def select_fields_query(spark, d):
    from tapewright.functions.fields import select_fields

    return select_fields(table(spark, d, "part"), [Field("p_partkey"), Field("p_brand")])


@query("SELECT n_nationkey AS key, n_name AS name, n_regionkey FROM nation")
def rename_columns(spark, d):
    return T.rename_columns(table(spark, d, "nation"), {"n_nationkey": "key", "n_name": "name", "absent": "name"})


@query("SELECT r_regionkey AS a, r_name AS b FROM region")
def set_columns(spark, d):
    return T.set_columns(table(spark, d, "region"), ["a", "b"])


@query("SELECT c_custkey, c_name, 'BR' AS country FROM customer")
def add_column(spark, d):
    df = table(spark, d, "customer").select("c_custkey", "c_name")
    return T.add_column(T.add_column(df, "country", "BR"), "c_name", "x", only_if_missing=True)


@query("SELECT n_name AS name, 'v1' AS version FROM nation UNION ALL SELECT r_name, 'v1' FROM region")
def add_column_multi(spark, d):
    dfs = {k: table(spark, d, k).select(F.col(f"{k[0]}_name").alias("name")) for k in ("nation", "region")}
    return T.concat_datasets(list(T.add_column_multi(dfs, "version", "v1").values()))


@query("SELECT s_suppkey, s_name || '11' AS ticker FROM supplier")
def apply_lambda(spark, d):
    return T.apply_expression(table(spark, d, "supplier").select("s_suppkey", "s_name"), "s_name", "x || '11'", "ticker").drop("s_name")


@query("SELECT p_partkey, TRY_CAST(CASE WHEN regexp_matches(split_part(p_brand, '#', 2), '^[0-9]+$') THEN split_part(p_brand, '#', 2) END AS BIGINT) AS brand, CAST(NULL AS DOUBLE) AS name, CAST(p_size AS VARCHAR) AS p_size FROM part")
def cast_columns(spark, d):
    df = table(spark, d, "part").select("p_partkey", F.split_part("p_brand", F.lit("#"), F.lit(2)).alias("brand"), F.col("p_name").alias("name"), "p_size")
    return T.cast_columns(T.cast_columns(T.cast_columns(df, ["brand", "absent"], "int"), ["name"], "float"), ["p_size"], "str")


_FIELDS_SQL = """SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS day, -round(o_totalprice, 2) AS amount,
    o_orderstatus = 'F' AS done, strftime(o_orderdate, '%H:%M:%S') AS at, CAST(0 AS INTEGER) AS second FROM orders"""


@query(_FIELDS_SQL, name="apply_fields")
def apply_fields_query(spark, d):
    raw = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("day"),
        F.translate(F.format_number("o_totalprice", 2), ",.", ".,").alias("amount"),
        F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("off").alias("done"),
        F.date_format("o_orderdate", "HHmmss").alias("at"),
    )
    fields = [
        Field("id", "integer"),
        Field("day", "date", format="%d/%m/%Y"),
        Field("amount", "numeric", thousands=".", decimal=",", sign="-"),
        Field("done", "boolean"),
        Field("at", "time", format="%H%M%S"),
        Field("absent", "integer"),
    ]
    typed = apply_fields(raw, fields)
    return typed.withColumn("amount", F.round("amount", 2)).withColumn("second", seconds_of_day(F.col("at")))


@query("SELECT CAST(n_nationkey AS BIGINT) AS key, n_name AS name FROM nation", name="apply_fields_multi")
def apply_fields_multi_query(spark, d):
    from tapewright.functions.fields import apply_fields_multi

    text = table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("name"))
    return apply_fields_multi({"a": text, "b": text.limit(1)}, {"a": [Field("key", "int")]})["a"]


@query("""SELECT l_orderkey, l_linenumber, round(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * l_extendedprice / pow(10.0, l_linenumber), 10) AS price FROM lineitem""")
def scale_and_sign(spark, d):
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"), F.when(F.col("l_returnflag") == "R", " - ").alias("sign"))
    return T.scale_and_sign(df, ["price"], "l_linenumber", {"price": "sign"}).drop("sign").withColumn("price", F.round("price", 10))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS status FROM orders")
def case_map(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return T.case_map(df, "o_orderstatus", {"F": "filled", "O": "open"}, "status", F.col("o_orderstatus")).drop("o_orderstatus")


# ---- filters

_ODD = "SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders"


def _odd(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"))


@query(f"SELECT * FROM ({_ODD}) WHERE status IS NULL OR status <> 'F'")
def filter_rows(spark, d):
    return T.filter_rows(T.filter_rows(_odd(spark, d), "status", "ne", "F"), "o_orderkey", "ge", 0)


@query(f"SELECT * FROM ({_ODD}) WHERE status IS NULL OR status NOT IN ('F', 'X')")
def filter_rows_notin(spark, d):
    return T.filter_rows(_odd(spark, d), "status", "notin", ["F", "X"])


@query(f"SELECT * FROM ({_ODD}) WHERE status IS NOT NULL")
def drop_na(spark, d):
    return T.drop_na(_odd(spark, d), ["status"])


@query("SELECT event_id, event_type FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)")
def filter_latest_date(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", F.to_date("ts").alias("refdate"))
    return T.filter_latest_date(e).drop("refdate")


@query("SELECT event_id FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'")
def filter_date_range(spark, d):
    e = table(spark, d, "events").select("event_id", F.to_date("ts").alias("refdate"))
    return T.filter_date_range(e, "refdate", "2024-01-05", "2024-01-09").select("event_id")


@query("SELECT p_partkey, p_name FROM part WHERE p_name NOT ILIKE '%RED%' AND p_type <> 'PROMO' AND p_size IN (1, 5, 9, 13)")
def filter_ilike(spark, d):
    return table(spark, d, "part").where("p_name NOT ILIKE '%RED%' AND p_type <> 'PROMO' AND p_size IN (1, 5, 9, 13)").select("p_partkey", "p_name")


@query("SELECT p_partkey, p_brand FROM part WHERE regexp_matches(trim(p_brand), '^Brand#[1-3][0-9]$')")
def filter_regex(spark, d):
    return table(spark, d, "part").where(F.trim("p_brand").rlike("^Brand#[1-3][0-9]$")).select("p_partkey", "p_brand")


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def filter_in_subquery(spark, d):
    poor = table(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, d, "orders").join(poor, "o_custkey", "left_semi").select("o_orderkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 1000)")
def filter_not_in(spark, d):
    rich = table(spark, d, "orders").where("o_totalprice > 1000").select("o_custkey")
    return T.not_in(table(spark, d, "customer").select("c_custkey"), "c_custkey", rich, "o_custkey")


# ---- joins


@query("SELECT l_orderkey, l_partkey, s_name FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey WHERE p_size > 40")
def join_inner(spark, d):
    lines, part, supplier = (table(spark, d, n) for n in ("lineitem", "part", "supplier"))
    met = lines.join(part.where("p_size > 40"), lines.l_partkey == part.p_partkey).join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return met.select("l_orderkey", "l_partkey", "s_name")


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders)
    SELECT c_custkey, o_orderkey AS last_order FROM customer LEFT JOIN (SELECT * FROM r WHERE rn = 1) ON c_custkey = o_custkey""")
def join_left(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderdate", F.col("o_orderkey").alias("last_order"))
    met = T.join_left_unique(table(spark, d, "customer").select("c_custkey"), orders, ["c_custkey"], ["-o_orderdate", "last_order"])
    return met.select("c_custkey", "last_order")


@query("""SELECT n_nationkey, count(s_suppkey) AS rich FROM nation LEFT JOIN supplier ON n_nationkey = s_nationkey AND s_acctbal > 5000 GROUP BY 1""")
def join_left_cond(spark, d):
    rich = table(spark, d, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("n_nationkey"), "s_suppkey")
    return table(spark, d, "nation").join(rich, "n_nationkey", "left").groupBy("n_nationkey").agg(F.count("s_suppkey").alias("rich"))


@query("""WITH a AS (SELECT o_orderkey, o_totalprice AS price FROM orders WHERE o_orderkey % 3 <> 0),
    b AS (SELECT o_orderkey, o_totalprice + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS price FROM orders WHERE o_orderkey % 2 = 0)
    SELECT o_orderkey, coalesce(a.price, b.price) AS price,
           CASE WHEN a.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL THEN 'both' WHEN a.o_orderkey IS NOT NULL THEN 'first' ELSE 'second' END AS provenance,
           round(a.price, 6) <> round(b.price, 6) AS price_differs
    FROM a FULL JOIN b USING (o_orderkey)""")
def join_full_outer_coalesce(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    a = orders.where("o_orderkey % 3 <> 0")
    b = orders.where("o_orderkey % 2 = 0").withColumn("price", F.col("price") + F.when(F.col("o_orderkey") % 5 == 0, 1).otherwise(0))
    return T.full_outer_reconcile(a, b, ["o_orderkey"], compare=["price"], names=("first", "second"))


@query("SELECT s_suppkey, s_acctbal - (SELECT avg(s_acctbal) FROM supplier) > 0 AS above FROM supplier")
def join_cross_scalar(spark, d):
    s = table(spark, d, "supplier")
    return s.crossJoin(F.broadcast(s.agg(F.avg("s_acctbal").alias("mean")))).select("s_suppkey", (F.col("s_acctbal") - F.col("mean") > 0).alias("above"))


@query("""WITH s AS (SELECT o_custkey, min(o_orderkey) AS a, max(o_orderkey) AS b FROM orders GROUP BY 1)
    SELECT x.o_custkey AS ends, y.o_custkey AS starts FROM s x JOIN s y ON y.a = x.b + 1""")
def join_adjacent(spark, d):
    s = table(spark, d, "orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("a"), F.max("o_orderkey").alias("b"))
    x = s.select(F.col("o_custkey").alias("ends"), (F.col("b") + 1).alias("a"))
    return x.join(s.select(F.col("o_custkey").alias("starts"), "a"), "a").select("ends", "starts")


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def join_semi(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").join(orders, "c_custkey", "left_semi").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def join_anti(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").join(orders, "c_custkey", "left_anti").select("c_custkey")


@query("""SELECT c_custkey AS a, CAST(n AS INTEGER) AS depth, c_custkey + n AS terminal
    FROM (SELECT c_custkey, least(20, 30 - c_custkey % 31, max(c_custkey) OVER () + 1 - c_custkey) AS n FROM customer) WHERE c_custkey % 31 < 30""")
def resolve_chains(spark, d):
    """Customers one after the other, in chains of up to 30 links: a third of them is longer than the limit of 20."""
    key = F.col("c_custkey")
    edges = table(spark, d, "customer").where(key % 31 < 30).select(key.alias("a"), (key + 1).alias("b"))
    return S.resolve_chains(edges, "a", "b").select("a", "depth", "terminal")


# ---- aggregations


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, min(l_quantity) AS lo, max(l_quantity) AS hi, round(sum(l_extendedprice), 2) AS total,
    round(avg(l_discount), 6) AS mean, round(stddev(l_tax), 6) AS sd FROM lineitem GROUP BY 1, 2 HAVING count(*) > 10""")
def agg_basic(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"), F.round(F.sum("l_extendedprice"), 2).alias("total"),
        F.round(F.avg("l_discount"), 6).alias("mean"), F.round(F.stddev("l_tax"), 6).alias("sd"),
    ).where("n > 10")


@query("SELECT user_id, arg_min(value, (ts, event_id)) AS first_value, arg_max(value, (ts, event_id)) AS last_value FROM events WHERE value IS NOT NULL GROUP BY 1")
def arg_min_max(spark, d):
    at = F.struct("ts", "event_id")
    return table(spark, d, "events").where("value is not null").groupBy("user_id").agg(F.min_by("value", at).alias("first_value"), F.max_by("value", at).alias("last_value"))


@query("SELECT n_regionkey, min(r_name) AS name FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def any_value(spark, d):
    met = table(spark, d, "nation").join(F.broadcast(table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return met.groupBy("n_regionkey").agg(F.any_value("r_name").alias("name"))


@query("SELECT o_custkey, count(nullif(o_orderstatus, 'P')) = 0 AS all_null FROM orders GROUP BY 1")
def count_is_zero(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg((F.count(F.nullif("o_orderstatus", F.lit("P"))) == 0).alias("all_null"))


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
    SELECT o_custkey, max(CASE WHEN rn = 1 THEN o_orderkey END) AS k1, max(CASE WHEN rn = 2 THEN o_orderkey END) AS k2 FROM r GROUP BY 1""")
def pivot_max_case(spark, d):
    r = T.ranked(table(spark, d, "orders"), ["o_custkey"], ["-o_totalprice", "o_orderkey"])
    return r.groupBy("o_custkey").agg(*[F.max(F.when(F.col("rn") == k, F.col("o_orderkey"))).alias(f"k{k}") for k in (1, 2)])


@query("SELECT l_partkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1")
def max_per_key(spark, d):
    return table(spark, d, "lineitem").groupBy("l_partkey").agg(F.max("l_shipdate").alias("last_ship"))


@query("SELECT DISTINCT p_brand, p_type FROM part")
def distinct(spark, d):
    return table(spark, d, "part").select("p_brand", "p_type").distinct()


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def group_count_dups(spark, d):
    return Q.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


# ---- windows


@query("""SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def latest_per_key(spark, d):
    return T.latest_per_key(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["-o_orderdate", "-o_orderkey"])


@query("SELECT user_id, event_id FROM events QUALIFY rank() OVER (PARTITION BY user_id ORDER BY value DESC NULLS LAST) <= 3")
def qualify(spark, d):
    from pyspark.sql.window import Window

    rank = F.rank().over(Window.partitionBy("user_id").orderBy(F.col("value").desc_nulls_last()))
    return table(spark, d, "events").withColumn("r", rank).where("r <= 3").select("user_id", "event_id")


@query("SELECT DISTINCT ON (event_type) event_type, event_id, ts FROM events ORDER BY event_type, ts, event_id")
def distinct_on(spark, d):
    return T.distinct_on(table(spark, d, "events").select("event_type", "event_id", "ts"), ["event_type"], ["ts", "event_id"])


@query("""SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY nullif(o_orderstatus, 'P') DESC NULLS LAST, o_totalprice DESC NULLS LAST, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def best_row_nulls_last(spark, d):
    status = F.nullif("o_orderstatus", F.lit("P")).desc_nulls_last()
    return T.first_rows(table(spark, d, "orders"), ["o_custkey"], [status, F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@query(f"WITH {_RETURNS_SQL} SELECT refdate, symbol, round(pct_return, 6) AS pct_return, round(log_return, 6) AS log_return FROM returned")
def lag_ratio_returns(spark, d):
    return returned(spark, d).select("refdate", "symbol", six("pct_return"), six("log_return"))


@query(f"WITH {_bars_sql()} SELECT refdate, symbol, round(close - lag(close) OVER (PARTITION BY symbol ORDER BY refdate), 6) AS diff FROM candles")
def lag_diff(spark, d):
    return X.lag_diff(bars(spark, d), "close", ["symbol"], "refdate").select("refdate", "symbol", six("diff"))


@query("SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders QUALIFY count(*) OVER (PARTITION BY o_custkey) > 2")
def count_over_partition(spark, d):
    from pyspark.sql.window import Window

    return table(spark, d, "orders").select("o_orderkey", F.count("*").over(Window.partitionBy("o_custkey")).alias("n")).where("n > 2")


@query(f"""WITH {_bars_sql("user_id")} SELECT refdate, symbol, round(close, 6) AS close, round(avg(close) OVER w, 6) AS prev_avg, round(close / nullif(avg(close) OVER w, 0), 6) AS spike
    FROM candles WINDOW w AS (PARTITION BY symbol ORDER BY refdate ROWS BETWEEN 21 PRECEDING AND 1 PRECEDING) QUALIFY avg(close) OVER w <= 60 AND close >= 20""")
def rolling_avg_prev(spark, d):
    found = X.rolling_spike(bars(spark, d, "user_id"), ["symbol"], "refdate", "close", 21, 60, 20)
    return found.select("refdate", "symbol", six("close"), six("prev_avg"), six("spike"))


@query(f"""WITH {_RETURNS_SQL} SELECT refdate, symbol, round(exp(sum(coalesce(CASE WHEN pct_return > -1 THEN ln(1 + pct_return) END, 0)) OVER
    (PARTITION BY symbol ORDER BY refdate ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS product FROM returned""")
def reverse_cum_product(spark, d):
    r = returned(spark, d).withColumn("ratio", 1 + F.col("pct_return"))
    return X.reverse_cum_product(r, "ratio", ["symbol"], "refdate", "product").select("refdate", "symbol", six("product"))


@query("""SELECT l_suppkey, l_shipdate, l_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) AS rn FROM lineitem) WHERE rn <= 2""")
def first_maturity(spark, d):
    return T.first_rows(table(spark, d, "lineitem"), ["l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"], 2).select("l_suppkey", "l_shipdate", "l_orderkey")


@query("SELECT refdate, CAST(row_number() OVER (ORDER BY refdate) AS INTEGER) AS session FROM (SELECT DISTINCT CAST(ts AS DATE) AS refdate FROM events)")
def session_rank(spark, d):
    return S.sessions(table(spark, d, "events").select(F.to_date("ts").alias("refdate")))


_PAIRS = "SELECT l_partkey AS a, l_suppkey AS b, round(sum(l_quantity), 2) AS w FROM lineitem GROUP BY 1, 2"


@query(f"""WITH p AS ({_PAIRS}),
    r1 AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY w DESC, a, b) AS s, row_number() OVER (PARTITION BY b ORDER BY w DESC, a, b) AS t FROM p),
    c1 AS (SELECT a, b, w FROM r1 WHERE s = 1 AND t = 1),
    p2 AS (SELECT * FROM p WHERE a NOT IN (SELECT a FROM c1) AND b NOT IN (SELECT b FROM c1)),
    r2 AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY w DESC, a, b) AS s, row_number() OVER (PARTITION BY b ORDER BY w DESC, a, b) AS t FROM p2)
    SELECT * FROM c1 UNION ALL SELECT a, b, w FROM r2 WHERE s = 1 AND t = 1""")
def mutual_best_match(spark, d):
    p = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b")).agg(F.round(F.sum("l_quantity"), 2).alias("w"))
    return S.mutual_best(p, "a", "b", [F.desc("w"), F.col("a"), F.col("b")]).select("a", "b", "w")


@query("""SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS value FROM events""")
def forward_fill(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "ts", F.when(F.col("event_type") == "purchase", F.col("value")).alias("value"))
    return T.forward_fill(e, "value", ["ts", "event_id"], ["user_id"]).select("event_id", "value")


# ---- order, sets, shapes


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_mktsegment DESC NULLS LAST, c_acctbal ASC NULLS LAST")
def sort(spark, d):
    return T.sort(table(spark, d, "customer"), ["c_mktsegment", "c_acctbal"], [True, False]).select("c_custkey", "c_acctbal")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 25")
def top_k(spark, d):
    return T.top_k(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["-o_totalprice", "o_orderkey"], 25)


@query("SELECT n_nationkey FROM nation ORDER BY n_nationkey LIMIT 7")
def limit(spark, d):
    return table(spark, d, "nation").select("n_nationkey").orderBy("n_nationkey").limit(7)


@query("""SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def drop_duplicates(spark, d):
    return T.drop_duplicates(table(spark, d, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], "o_orderkey", "last")


@query("SELECT o_custkey, o_orderkey FROM orders QUALIFY count(*) OVER (PARTITION BY o_custkey) = 1")
def drop_duplicates_none(spark, d):
    return T.drop_duplicates(table(spark, d, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], "o_orderkey", False)


@query("SELECT c_name AS name, c_acctbal AS value, 'c' AS kind FROM customer UNION ALL SELECT s_name, s_acctbal, 's' FROM supplier UNION ALL SELECT p_name, p_retailprice, 'p' FROM part")
def union_all(spark, d):
    parts = [("customer", "c_name", "c_acctbal"), ("supplier", "s_name", "s_acctbal"), ("part", "p_name", "p_retailprice")]
    return T.concat_datasets([table(spark, d, t).select(F.col(a).alias("name"), F.col(b).alias("value"), F.lit(a[0]).alias("kind")) for t, a, b in parts])


@query("""SELECT o_orderkey, o_totalprice AS price FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
    UNION ALL SELECT o_orderkey, -o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate <> TIMESTAMP '1999-06-01'
    UNION ALL SELECT o_orderkey, 0.0 FROM orders WHERE o_orderdate = TIMESTAMP '1999-06-01'""")
def union_cutover(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate", F.col("o_totalprice").alias("price"))
    new, patch = o.withColumn("price", -F.col("price")), o.withColumn("price", F.lit(0.0))
    at = F.col("o_orderdate")
    found = T.union_cutover([(o, at < "1998-01-01"), (new, (at >= "1998-01-01") & (at != "1999-06-01")), (patch, at == "1999-06-01")])
    return found.select("o_orderkey", "price")


@query("SELECT c_name AS name, c_acctbal AS balance, CAST(NULL AS INTEGER) AS size FROM customer UNION ALL SELECT p_name, NULL, p_size FROM part")
def union_schema_aligned(spark, d):
    a = table(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    b = table(spark, d, "part").select(F.col("p_name").alias("name"), F.col("p_size").alias("size"))
    return T.union_aligned([a, b])


@query("SELECT n_nationkey AS key, n_name AS name FROM nation UNION ALL SELECT r_regionkey, r_name FROM region")
def concat_datasets(spark, d):
    a = T.set_columns(table(spark, d, "nation").drop("n_regionkey"), ["key", "name"])
    return T.concat_datasets([a, T.set_columns(table(spark, d, "region"), ["key", "name"])], ["key", "name"])


@query("SELECT l_orderkey, l_linenumber, l_partkey, 'l_discount' AS field, l_discount AS x FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'l_tax', l_tax FROM lineitem")
def melt(spark, d):
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_tax")
    return T.melt(df, ["l_orderkey", "l_linenumber", "l_partkey"], var_name="field", value_name="x")


@query("SELECT p_partkey, trim(unnest(string_split(p_name, ' '))) AS word FROM part")
def flatten_columns(spark, d):
    return T.flatten_columns(table(spark, d, "part").select("p_partkey", F.col("p_name").alias("word")), ["word"], " ")


@query(f"""WITH {_bars_sql()} SELECT refdate, max(CASE WHEN symbol = 'click' THEN close END) AS click, max(CASE WHEN symbol = 'error' THEN close END) AS error
    FROM candles WHERE symbol IN ('click', 'error') GROUP BY 1""")
def pivot_wide(spark, d):
    return T.pivot_wide(bars(spark, d), "refdate", "symbol", "close", ["click", "error"])


_WIDE_SQL = """w AS (SELECT refdate, max(CASE WHEN symbol = 'click' THEN close END) AS click, max(CASE WHEN symbol = 'view' THEN close END) AS view
    FROM candles WHERE symbol IN ('click', 'view') GROUP BY 1),
    b AS (SELECT min(refdate) AS lo, max(refdate) AS hi FROM w)"""


@query(f"WITH {_bars_sql()}, {_WIDE_SQL}, {_CAL24} SELECT cal_date AS refdate, click, view FROM cal CROSS JOIN b LEFT JOIN w ON refdate = cal_date WHERE is_bizday AND cal_date BETWEEN lo AND hi")
def reindex_calendar(spark, d):
    return api.reindex_calendar(T.pivot_wide(bars(spark, d), "refdate", "symbol", "close", ["click", "view"]), cal24(spark))


# ---- scalar functions


@query("""SELECT c_custkey, upper(trim(c_name)) AS name, substr(c_name, 1, 4) || '3' AS symbol, split_part(c_name, '#', 2) AS number, nullif(c_mktsegment, 'HOUSEHOLD') AS segment,
    replace(c_name, '#', '.') AS dotted, regexp_replace(c_name, '[0-9]+', '', 'g') AS letters, regexp_extract(c_name, '^(\\w+)', 1) AS word FROM customer""")
def string_functions(spark, d):
    c = table(spark, d, "customer").select(
        "c_custkey", F.upper(F.trim("c_name")).alias("name"), F.concat(F.substring("c_name", 1, 4), F.lit("3")).alias("symbol"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("number"), F.nullif("c_mktsegment", F.lit("HOUSEHOLD")).alias("segment"), "c_name",
        F.regexp_extract("c_name", "(?U)^(\\w+)", 1).alias("word"),
    )
    c = T.str_replace(c, "c_name", "#", ".", "dotted")
    return T.str_replace(c, "c_name", "[0-9]+", "", "letters", regex=True).drop("c_name")


@query("""WITH i AS (SELECT p_partkey, 'BR' || upper(substr(p_name, 1, 4)) || CASE p_size % 3 WHEN 0 THEN 'ACNOR' WHEN 1 THEN 'ACNPR' ELSE 'CDAM1' END || '1' AS isin FROM part)
    SELECT p_partkey, substr(isin, 7, 3) AS kind, CASE substr(isin, 10, 2) WHEN 'OR' THEN 'ON' WHEN 'PR' THEN 'PN' ELSE substr(isin, 10, 2) END AS class FROM i""")
def isin_parsing(spark, d):
    size = F.col("p_size") % 3
    tail = F.when(size == 0, "ACNOR").when(size == 1, "ACNPR").otherwise("CDAM1")
    isin = F.concat(F.lit("BR"), F.upper(F.substring("p_name", 1, 4)), tail, F.lit("1"))
    return table(spark, d, "part").select("p_partkey", S.isin_instrument_type(isin).alias("kind"), S.isin_share_class(isin, "code").alias("class"))


@query("""SELECT o_orderkey, CASE WHEN day(o_orderdate) + 3 <= day(last_day(CAST(o_orderdate AS DATE))) THEN CAST(o_orderdate + INTERVAL 3 DAY AS DATE) END AS date,
    CAST(o_orderdate + INTERVAL 1 DAY AS DATE) AS next_day FROM orders""")
def date_functions(spark, d):
    o = table(spark, d, "orders")
    o = o.select("o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), (F.day("o_orderdate") + 3).alias("dd"), F.to_date(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("next_day"))
    return T.make_date(o, "y", "m", "dd").drop("y", "m", "dd")


@query("SELECT p_partkey, round(ln(p_retailprice), 6) AS l, round(exp(p_size / 50.0), 6) AS e, round(pow(p_size, 1.5), 6) AS p, abs(-p_size) AS a, round(p_retailprice / nullif(p_size - 10, 0), 6) AS q FROM part")
def math_functions(spark, d):
    return table(spark, d, "part").selectExpr("p_partkey", "round(ln(p_retailprice), 6) l", "round(exp(p_size / 50.0D), 6) e", "round(pow(p_size, 1.5D), 6) p", "abs(-p_size) a", "round(p_retailprice / nullif(p_size - 10, 0), 6) q")
