"""Queries that run dataset jobs over the tables, in the roles of the jobs' inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapewright.functions.scratch import table
from tapewright.operators import curves as R
from tapewright.operators import timeseries as X
from tapewright.plans import datasets as DS
from tapewright.plans.finance_queries import _CONTRACTS_SQL, _ENDS_SQL, _KNOTS_SQL, _USER_SQL, cal_all, contracts, knots
from tapewright.plans.queries import _CAL24, _CAL_ALL, _RETURNS_SQL, bars, cal24, query, returned, six


@query("""WITH m AS (SELECT CAST(ts AS DATE) AS refdate, CASE event_type WHEN 'click' THEN 'IGPM' WHEN 'view' THEN 'CDI' WHEN 'purchase' THEN 'IPCA' END AS symbol, value, event_id FROM events WHERE event_type IN ('click', 'view', 'purchase'))
    SELECT refdate, symbol, value FROM m QUALIFY row_number() OVER (PARTITION BY refdate, symbol ORDER BY event_id DESC) = 1""")
def ds_macro_series(spark, d):
    code = F.when(F.col("event_type") == "click", 189).when(F.col("event_type") == "view", 4389).when(F.col("event_type") == "purchase", 433).otherwise(0)
    e = table(spark, d, "events").select(F.to_date("ts").alias("refdate"), code.alias("code"), "value", F.col("event_id").alias("downloaded_at"))
    return DS.DATASETS["macro_series"]({"macro": e})


@query("""SELECT CAST(l_shipdate AS DATE) AS refdate, CASE l_returnflag WHEN 'A' THEN 'RT' WHEN 'N' THEN 'SE' ELSE '??' END AS indicator_group, 'S' || l_suppkey AS symbol,
    CASE l_returnflag WHEN 'A' THEN 'Real-Time Indicators' WHEN 'N' THEN 'Selic Rate' ELSE 'Unknown' END AS indicator_group_description, round(l_quantity / pow(10.0, l_linenumber), 9) AS value FROM lineitem""")
def ds_economic_indicators(spark, d):
    group = F.when(F.col("l_returnflag") == "A", "RT").when(F.col("l_returnflag") == "N", "SE").otherwise("??")
    e = table(spark, d, "lineitem").select(
        F.to_date("l_shipdate").alias("data_geracao_arquivo"), group.alias("grupo_indicador"), F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("cod_indicador"),
        F.col("l_quantity").alias("valor_indicador"), F.col("l_linenumber").alias("num_casas_decimais"),
    )
    return DS.DATASETS["economic_indicators"]({"economic_indicators_fwf": e}).withColumn("value", F.round("value", 9))


@query("""WITH b AS (SELECT ts, CASE event_type WHEN 'click' THEN 'USD' ELSE upper(event_type) END AS currency, CASE WHEN event_type = 'view' THEN NULL ELSE value END AS ask, value + 1 AS parity_ask FROM events),
    k AS (SELECT currency, count(ask) = 0 AS type_b FROM b GROUP BY 1),
    v AS (SELECT ts, currency, CASE WHEN currency = 'USD' THEN ask ELSE parity_ask END AS p, currency = 'USD' OR type_b AS inv FROM b JOIN k USING (currency)),
    c AS (SELECT CAST(ts AS DATE) AS refdate, currency, inv, arg_min(p, ts) AS o, max(p) AS h, min(p) AS l, arg_max(p, ts) AS c FROM v WHERE p IS NOT NULL AND NOT (inv AND p = 0) GROUP BY 1, 2, 3)
    SELECT refdate, CASE WHEN currency = 'USD' THEN 'BRLUSD' ELSE currency || 'USD' END AS symbol, round(CASE WHEN inv THEN 1 / o ELSE o END, 6) AS open, round(CASE WHEN inv THEN 1 / l ELSE h END, 6) AS high,
           round(CASE WHEN inv THEN 1 / h ELSE l END, 6) AS low, round(CASE WHEN inv THEN 1 / c ELSE c END, 6) AS close FROM c""")
def ds_currency_consolidated(spark, d):
    currency = F.when(F.col("event_type") == "click", "USD").otherwise(F.upper("event_type"))
    ask = F.when(F.col("event_type") != "view", F.col("value"))
    b = table(spark, d, "events").select(
        F.col("ts").alias("refdate"), currency.alias("currency"), F.lit("all").alias("bulletin_type"), ask.alias("ask"),
        (F.col("value") + 1).alias("parity_ask"), F.col("event_id").alias("downloaded_at"),
    )
    found = DS.DATASETS["currency_consolidated"]({"fx_bulletins": b})
    return found.select("refdate", "symbol", *[six(c) for c in DS.OHLC])


@query(f"""WITH {_RETURNS_SQL} SELECT refdate, symbol, round(pct_return, 6) AS pct_return, round(log_return, 6) AS log_return FROM returned""")
def ds_currencies_returns(spark, d):
    return DS.DATASETS["currencies_returns"]({"currency_consolidated": bars(spark, d)}).select("refdate", "symbol", six("pct_return"), six("log_return"))


@query("SELECT p_partkey AS symbol, trim(unnest(string_split(replace(p_name, ' ', ' , '), ','))) AS indexes FROM part")
def ds_indexes_composition_consolidated(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("symbol"), F.replace("p_name", F.lit(" "), F.lit(" , ")).alias("indexes"))
    return DS.DATASETS["indexes_composition_consolidated"]({"indexes_composition": p})


@query("""WITH m AS (SELECT c_name AS symbol, CAST(c_custkey % 31 + 1 AS INTEGER) AS dd, CAST(2000 + c_nationkey AS INTEGER) AS yy, unnest(range(1, 13)) AS mm, c_acctbal FROM customer),
    v AS (SELECT symbol, CASE WHEN dd <= day(last_day(make_date(yy, CAST(mm AS INTEGER), 1))) THEN make_date(yy, CAST(mm AS INTEGER), dd) END AS refdate, CASE WHEN mm % 5 = 0 THEN NULL ELSE round(c_acctbal + mm, 2) END AS value FROM m)
    SELECT symbol, refdate, value FROM v WHERE value IS NOT NULL""")
def ds_indexes_historical_prices(spark, d):
    c = table(spark, d, "customer")
    months = [F.when(F.lit(k % 5 != 0), F.round(F.col("c_acctbal") + k, 2)).alias(f"month{k:02d}") for k in range(1, 13)]
    wide = c.select(F.col("c_name").alias("index"), (F.col("c_custkey") % 31 + 1).alias("day"), (F.col("c_nationkey") + 2000).alias("year"), *months)
    return DS.DATASETS["indexes_historical_prices_pivot_longer"]({"index_months": wide})


@query("""WITH t AS (SELECT o_orderkey AS trade_id, CAST(o_orderdate AS DATE) + 10000 AS refdate, o_orderstatus, o_totalprice AS traded_price FROM orders)
    SELECT trade_id, refdate, traded_price FROM t WHERE (o_orderstatus = 'F' AND refdate <= DATE '2026-04-30') OR (o_orderstatus <> 'F' AND refdate > DATE '2026-04-30')""")
def ds_trades_intraday_consolidated(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("trade_id"), F.date_add(F.to_date("o_orderdate"), 10000).alias("refdate"), F.col("o_totalprice").alias("traded_price"), "o_orderstatus")
    parts = {"trades": o.where("o_orderstatus = 'F'"), "trades_equities": o.where("o_orderstatus = 'O'"), "trades_derivatives": o.where("o_orderstatus not in ('F', 'O')")}
    return DS.DATASETS["trades_intraday_consolidated"](parts).drop("o_orderstatus")


def market_futures(spark, d):
    """The orders' contracts as futures of two commodities."""
    c = contracts(spark, d)
    commodity = F.when(F.col("product") == "1-URGENT", "DOL").when(F.col("product") == "2-HIGH", "WDO").otherwise("OTHER")
    symbol = F.concat(commodity, F.date_format("maturity", "yyyyMMdd"))
    return c.select("refdate", symbol.alias("symbol"), commodity.alias("commodity"), F.col("maturity").alias("maturity_date"), F.col("quote").alias("adjusted_quote"), F.lit(None).cast("double").alias("adjusted_tax"))


@query(f"""WITH {_CONTRACTS_SQL} SELECT refdate, 'DOLT01' AS symbol, 'DOL' || strftime(min(maturity), '%Y%m%d') AS ref, min(maturity) AS maturity_date, arg_min(quote, maturity) AS adjusted_quote
    FROM contracts WHERE product = '1-URGENT' AND maturity > refdate GROUP BY 1""")
def ds_futures_dol_first_generic(spark, d):
    return DS.DATASETS["futures_dol_first_generic"]({"futures": market_futures(spark, d)}).drop("adjusted_tax")


@query(f"""WITH {_CONTRACTS_SQL}, c AS (SELECT refdate, maturity, quote, row_number() OVER (PARTITION BY refdate ORDER BY maturity, quote) AS rn FROM contracts WHERE product = '2-HIGH'),
    s AS (SELECT refdate, max(CASE WHEN rn = 1 THEN quote END) AS s1, max(CASE WHEN rn = 2 THEN quote END) AS s2, max(CASE WHEN rn = 1 THEN maturity END) AS m1 FROM c WHERE rn <= 2 GROUP BY 1),
    p AS (SELECT refdate, ln(s1) + sum(CASE WHEN m1 = refdate AND s2 / s1 > 0 THEN ln(s2 / s1) ELSE 0 END) OVER (ORDER BY refdate ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lp FROM s),
    r AS (SELECT refdate, lp - lag(lp) OVER (ORDER BY refdate) AS x FROM p)
    SELECT refdate, 'WDOADJ' AS symbol, round(x, 6) AS log_return FROM r WHERE x IS NOT NULL""")
def ds_futures_wdo_adjusted_returns(spark, d):
    adjusted = DS.DATASETS["futures_wdo_adjusted"]({"futures": market_futures(spark, d)})
    return DS.DATASETS["futures_wdo_adjusted_returns"]({"futures_wdo_adjusted": adjusted}).select("refdate", "symbol", six("log_return"))


@query("""WITH s AS (SELECT s_name AS symbol, 'BR' || upper(substr(s_name, 1, 4)) || CASE s_suppkey % 4 WHEN 0 THEN 'ACNOR' WHEN 1 THEN 'ACNPR' WHEN 2 THEN 'ACNPB' ELSE 'CDAM1' END || '1' AS isin, 'I' || s_nationkey AS issuing_company, CAST(s_suppkey AS VARCHAR) AS code_cvm FROM supplier)
    SELECT *, 'B' AS market, CASE WHEN substr(isin, 7, 3) = 'ACN' THEN 'EQUITY' ELSE 'UNIT' END AS instrument_type,
        CASE WHEN substr(isin, 7, 3) <> 'ACN' THEN NULL WHEN substr(isin, 10, 2) = 'OR' THEN 'ON' WHEN substr(isin, 10, 2) = 'PR' THEN 'PN' ELSE 'PN' || substr(isin, 11, 1) END AS share_class FROM s""")
def ds_companies_symbols(spark, d):
    k = F.col("s_suppkey") % 4
    tail = F.when(k == 0, "ACNOR").when(k == 1, "ACNPR").when(k == 2, "ACNPB").otherwise("CDAM1")
    s = table(spark, d, "supplier").select(
        F.concat(F.lit("I"), F.col("s_nationkey").cast("string")).alias("issuingCompany"), F.col("s_name").alias("code"),
        F.concat(F.lit("BR"), F.upper(F.substring("s_name", 1, 4)), tail, F.lit("1")).alias("isin"), F.col("s_suppkey").alias("codeCVM"), F.lit("B").alias("market"), F.lit("2024-01-02").alias("refdate"),
    )
    older = s.withColumns({"refdate": F.lit("2023-01-02"), "isin": F.lit("BROLD0ACNOR1")})
    return DS.DATASETS["companies_symbols"]({"company_details": s.unionByName(older)})


@query(f"""WITH {_RETURNS_SQL}, u AS (SELECT refdate, symbol, log_return AS r FROM returned) SELECT refdate, symbol, round(r, 6) AS returns FROM u, range(9)""")
def ds_returns(spark, d):
    part = returned(spark, d).withColumn("returns", F.col("log_return"))
    return DS.DATASETS["returns"](dict.fromkeys(DS.RETURN_PARTS, part)).select("refdate", "symbol", six("returns"))


@query(f"""WITH {_USER_SQL}, {_CAL24}, spans AS (SELECT symbol, min(refdate) AS a, max(refdate) AS b FROM returned GROUP BY 1),
    grid AS (SELECT symbol, cal_date AS refdate FROM spans JOIN cal ON is_bizday AND cal_date BETWEEN a AND b),
    met AS (SELECT g.symbol, g.refdate, r.refdate AS own FROM grid g LEFT JOIN returned r USING (symbol, refdate)),
    carried AS (SELECT *, max(own) OVER (PARTITION BY symbol ORDER BY refdate ROWS UNBOUNDED PRECEDING) AS from_date FROM met)
    SELECT c.refdate, c.symbol, r.open, r.close, own IS NULL AS absent FROM carried c LEFT JOIN returned r ON r.symbol = c.symbol AND r.refdate = c.from_date""")
def locf_grid(spark, d):
    rows = bars(spark, d, "user_id").withColumn("returns", F.lit(1.0))
    found = X.on_calendar(rows, cal24(spark), "returns")
    absent = F.coalesce(F.col("returns") == 0.0, F.lit(True))
    return found.select("refdate", "symbol", "open", "close", absent.alias("absent"))


@query(f"""WITH {_ENDS_SQL}, {_KNOTS_SQL}, w AS (SELECT DISTINCT refdate FROM knots), k AS (SELECT refdate, min(t) AS t, arg_min(r, t) AS r FROM knots GROUP BY 1)
    SELECT k.refdate, 'X5' AS symbol, CAST(5 AS BIGINT) AS business_days, round(exp(ln(1 + r) * t / 252 * 252 / 5) - 1, 4) AS adjusted_tax, m.cal_date AS maturity_date
    FROM k JOIN cal c ON c.cal_date = k.refdate LEFT JOIN cal m ON m.is_bizday AND m.biz_idx = 5 + CASE WHEN c.is_bizday THEN c.biz_idx ELSE c.biz_idx + 1 END""")
def standard_terms(spark, d):
    """Below the first vertex the price stays as it is there."""
    return R.standard_terms(knots(spark, d), cal_all(spark), [5], "X").withColumn("adjusted_tax", F.round("adjusted_tax", 4))


@query(f"""WITH {_CAL_ALL}, f AS (SELECT CAST(o_orderdate AS DATE) AS refdate, 'DI1' || o_orderkey AS symbol, CAST(o_orderdate AS DATE) + CAST(o_custkey % 400 AS INTEGER) AS raw, round(o_totalprice / 5000000, 6) AS tax FROM orders WHERE o_orderstatus = 'F'),
    g AS (SELECT * FROM f WHERE raw > refdate UNION ALL SELECT DISTINCT refdate, 'CDI', refdate + 1, 0.1165 FROM f WHERE raw > refdate),
    ends AS (SELECT a.cal_date, b.biz_idx AS at FROM cal a JOIN cal b ON a.next_bizday = b.cal_date)
    SELECT refdate, symbol, tax AS adjusted_tax, next_bizday AS maturity_date, y.at - x.at AS business_days
    FROM g JOIN cal c ON c.cal_date = raw JOIN ends x ON x.cal_date = refdate JOIN ends y ON y.cal_date = next_bizday""")
def ds_curves_di1(spark, d):
    o = table(spark, d, "orders").where("o_orderstatus = 'F'").withColumn("refdate", F.to_date("o_orderdate"))
    f = o.select("refdate", F.concat(F.lit("DI1"), F.col("o_orderkey").cast("string")).alias("symbol"), F.lit("DI1").alias("commodity"), F.date_add("refdate", (F.col("o_custkey") % 400).cast("int")).alias("maturity_date"), F.round(F.col("o_totalprice") / 5000000, 6).alias("adjusted_tax"))
    n = o.select("refdate", F.lit("RT").alias("indicator_group"), F.lit("DI1").alias("symbol"), F.lit(11.65).alias("value"))
    found = DS.DATASETS["curves_di1"]({"futures": f, "economic_indicators": n}, calendar=cal_all(spark))
    return found.select("refdate", "symbol", "adjusted_tax", "maturity_date", "business_days")


# ---- companies and equities; each SQL is written from the published rules of its dataset

_REGISTER_SQL = """reg AS (SELECT CAST(o_orderdate AS DATE) AS refdate, 'S' || o_custkey AS symbol, CASE o_custkey % 9 WHEN 0 THEN 'TAXA' ELSE 'A' || o_custkey % 97 END AS instrument_asset,
        CASE WHEN o_custkey % 13 = 0 THEN 'Ativo Teste ON' WHEN o_custkey % 17 = 0 THEN 'XX' WHEN o_custkey % 19 = 0 THEN NULL ELSE 'Corp ' || o_custkey END AS corporation_name,
        CASE WHEN o_orderstatus = 'P' THEN 20 ELSE 10 END AS instrument_market, CASE WHEN o_orderpriority = '5-LOW' THEN 2 ELSE 1 END AS instrument_segment,
        o_custkey % 23 AS security_category, CASE WHEN o_orderkey % 11 = 0 THEN DATE '9999-12-31' ELSE CAST(o_orderdate AS DATE) END AS trading_start_date, o_orderkey FROM orders)"""


def register(spark, d):
    o, key = table(spark, d, "orders"), F.col("o_custkey")
    never, refdate = F.lit("9999-12-31").cast("date"), F.to_date("o_orderdate")
    named = F.when(key % 13 == 0, "Ativo Teste ON").when(key % 17 == 0, "XX").when(key % 19 == 0, None).otherwise(F.concat(F.lit("Corp "), key.cast("string")))
    return o.select(
        refdate.alias("refdate"), F.concat(F.lit("S"), key.cast("string")).alias("symbol"),
        F.when(key % 9 == 0, "TAXA").otherwise(F.concat(F.lit("A"), (key % 97).cast("string"))).alias("instrument_asset"),
        named.alias("corporation_name"), F.when(F.col("o_orderstatus") == "P", 20).otherwise(10).alias("instrument_market"),
        F.when(F.col("o_orderpriority") == "5-LOW", 2).otherwise(1).alias("instrument_segment"), (key % 23).alias("security_category"),
        F.when(F.col("o_orderkey") % 11 == 0, never).otherwise(refdate).alias("trading_start_date"), "o_orderkey",
    )


_SPOT_SQL = """spot AS (SELECT * FROM reg WHERE instrument_market = 10 AND instrument_segment = 1 AND instrument_asset <> 'TAXA' AND trading_start_date <> DATE '9999-12-31'
        AND security_category IN (1, 11, 6, 21, 3, 13) AND corporation_name NOT ILIKE '%TESTE%' AND corporation_name <> 'XX')"""


@query(f"WITH {_REGISTER_SQL}, {_SPOT_SQL} SELECT refdate, symbol, instrument_asset, corporation_name, o_orderkey FROM spot")
def ds_equities_spot_market(spark, d):
    found = DS.DATASETS["equities_spot_market"]({"instruments_equities": register(spark, d)})
    return found.select("refdate", "symbol", "instrument_asset", "corporation_name", "o_orderkey")


@query(f"""WITH {_REGISTER_SQL} SELECT instrument_asset, max(refdate) AS refdate FROM reg WHERE security_category IN (11, 13) AND instrument_market = 10 AND instrument_segment = 1
    AND instrument_asset <> 'TAXA' AND trading_start_date <> DATE '9999-12-31' GROUP BY 1""")
def ds_equities_instrument_assets(spark, d):
    return DS.DATASETS["equities_instrument_assets"]({"instruments_equities": register(spark, d)})


def company_info(spark, d):
    key = F.col("o_custkey")
    return table(spark, d, "orders").select(
        F.to_date("o_orderdate").alias("refdate"), F.when(key % 10 == 0, "0").otherwise(key.cast("string")).alias("codeCVM"),
        F.concat(F.lit(" "), "o_orderstatus", F.lit(" ")).alias("tradingName"), F.concat(F.lit("I"), (key % 83).cast("string")).alias("issuingCompany"),
    )


# every customer is a company whose names are its orders' states: the last order of each counts, and a tenth has no code
@query("""SELECT CAST(max(o_orderdate) AS DATE) AS refdate, CAST(o_custkey AS VARCHAR) AS code_cvm, o_orderstatus AS trading_name, 'I' || any_value(o_custkey % 83) AS instrument_asset
    FROM orders WHERE o_custkey % 10 > 0 GROUP BY o_custkey, o_orderstatus""")
def ds_companies_names(spark, d):
    return DS.DATASETS["companies_names"]({"company_info": company_info(spark, d)})


# The line's number and part decide on the paper, so what must come out is known from them: odd lines have an ordinary paper of their
# own, of even lines 2 is a unit, 4 a preferred paper that has a ticker, 6 one without. Of equal events the last line counts.
@query("""SELECT (SELECT CAST(max(s_suppkey) AS VARCHAR) FROM supplier WHERE s_suppkey % 83 = issuer AND issuer < 60) AS code_cvm, 'I' || issuer AS issuing_company,
           CASE WHEN paper = 4 AND EXISTS (FROM part WHERE p_partkey % 300 = number) THEN 'T' || number END AS symbol,
           CASE paper WHEN 1 THEN 'BRA' ELSE 'BRB' END || lpad(CAST(number AS VARCHAR), 3, '0') || ['ACNOR1', 'UNT0R1', '', 'ACNPR2', '', 'ACNPA1'][paper] AS asset_isin,
           ['ON', 'UNT', '', 'PN', '', 'PN'][paper] AS share_class, label AS event_type_raw, factor, approved_on, ex_date, 'BRB' || lpad(CAST(number AS VARCHAR), 3, '0') || last.code AS isin
    FROM (SELECT l_suppkey % 83 AS issuer, l_partkey % 300 AS number, CASE WHEN l_linenumber % 2 = 1 THEN 1 ELSE l_linenumber END AS paper, l_returnflag AS label, l_tax AS factor,
              CAST(date_trunc('year', l_shipdate) AS DATE) AS approved_on, CAST(date_trunc('month', l_shipdate) AS DATE) AS ex_date,
              min({'before': -epoch(l_shipdate), 'code': ['ACNPR2', 'UNT0R1', 'ACNPA1', 'ACNPR2', 'UNT0R1', 'ACNPA1', 'ACNPR2'][l_linenumber]}) AS last
          FROM lineitem GROUP BY ALL)""")
def ds_stock_events(spark, d):
    def three(column):
        return F.lpad((F.col(column) % 300).cast("string"), 3, "0")

    line = F.col("l_linenumber")
    kind = F.when(line % 3 == 0, "ACNPA1").when(line % 3 == 1, "ACNPR2").otherwise("UNT0R1")
    events = table(spark, d, "lineitem").select(
        F.concat(F.lit("I"), (F.col("l_suppkey") % 83).cast("string")).alias("issuingCompany"),
        F.when(line % 2 == 0, "").otherwise(F.concat(F.lit("BRA"), three("l_partkey"), F.lit("ACNOR1"))).alias("assetIssued"),
        F.concat(F.lit("BRB"), three("l_partkey"), kind).alias("isinCode"), F.col("l_returnflag").alias("label"), F.col("l_tax").alias("factor"),
        F.trunc("l_shipdate", "year").alias("approvedOn"), F.trunc("l_shipdate", "month").alias("lastDatePrior"), F.to_date("l_shipdate").alias("refdate"),
    )
    suppliers = table(spark, d, "supplier").where("s_suppkey % 83 < 60")
    names = suppliers.select(
        F.concat(F.lit("I"), (F.col("s_suppkey") % 83).cast("string")).alias("instrument_asset"), F.col("s_suppkey").alias("code_cvm"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("s_suppkey").cast("int")).alias("refdate"), F.lit("x").alias("trading_name"),
    )
    part = table(spark, d, "part")
    symbols = part.select(F.concat(F.lit("BRB"), three("p_partkey"), F.lit("ACNPR2")).alias("isin"), F.concat(F.lit("T"), (F.col("p_partkey") % 300).cast("string")).alias("symbol"))
    return DS.DATASETS["stock_events"]({"stock_dividends": events, "companies_names": names, "companies_symbols": symbols})


@query(f"""WITH {_REGISTER_SQL}, {_SPOT_SQL}, sym AS (SELECT DISTINCT symbol FROM spot WHERE security_category IN (1, 11, 13)),
    daily AS (SELECT CAST(o_orderdate AS DATE) AS refdate, 'S' || o_custkey AS symbol, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice / 10000 - 20 END AS osc, o_orderkey FROM orders),
    cot AS (SELECT 'S' || o_custkey AS symbol, min(o_totalprice) AS c0, max(o_totalprice) AS c1, count(*) AS n FROM orders GROUP BY 1),
    bul AS (SELECT 'S' || o_custkey AS symbol, o_totalprice / 100000 AS mag, CASE o_orderstatus WHEN 'F' THEN '-' WHEN 'O' THEN '+' ELSE '/' END AS sign, CASE WHEN o_orderpriority = '1-URGENT' THEN 3 ELSE 2 END AS bdi FROM orders),
    u AS (SELECT DATE '2021-06-10' AS refdate, symbol, c1 / c0 - 1 AS p FROM cot JOIN sym USING (symbol) WHERE n % 2 = 0
        UNION ALL SELECT refdate, symbol, coalesce(osc, 0) / 100 FROM daily JOIN sym USING (symbol)
        UNION ALL SELECT DATE '2016-02-29', symbol, CASE WHEN sign = '-' THEN -1 ELSE 1 END * mag / 100 FROM bul JOIN sym USING (symbol) WHERE bdi = 2 AND sign IN ('+', '-', '='))
    SELECT refdate, symbol, round(p, 6) AS pct_return, round(ln(1 + p), 6) AS log_return FROM u""")
def ds_equities_returns(spark, d):
    """Oscillations of all orders; the two gap days from pairs of prices and from signed bulletins."""
    spot = DS.DATASETS["equities_spot_market"]({"instruments_equities": register(spark, d)})
    o = table(spark, d, "orders").withColumn("symbol", F.concat(F.lit("S"), F.col("o_custkey").cast("string")))
    daily = o.select(F.to_date("o_orderdate").alias("refdate"), "symbol", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice") / 10000 - 20).alias("oscillation"))
    sums = o.groupBy("symbol").agg(F.min("o_totalprice").alias("c0"), F.max("o_totalprice").alias("c1"), F.count("*").alias("n"))
    days = (("2021-06-09", "c0", F.lit(0).cast("long")), ("2021-06-10", "c1", F.col("n") % 2))
    parts = [sums.select(F.lit(day).cast("date").alias("refdate"), "symbol", F.col(c).alias("close"), moved.alias("distribution_id")) for day, c, moved in days]
    sign = F.when(F.col("o_orderstatus") == "F", "-").when(F.col("o_orderstatus") == "O", "+").otherwise("/")
    bulletin = o.select(
        F.lit("2016-02-29").cast("date").alias("refdate"), F.col("symbol").alias("cod_negociacao"), (F.col("o_totalprice") / 100000).alias("oscilacao_preco"),
        sign.alias("sinal_oscilacao_preco"), F.when(F.col("o_orderpriority") == "1-URGENT", 3).otherwise(2).alias("cod_bdi"), F.lit(1.0).alias("preco_ult"),
    )
    found = DS.DATASETS["equities_returns"](
        {"equities_spot_market": spot, "price_reports": daily, "cotahist": parts[0].unionByName(parts[1]), "bulletin_stocks": bulletin}
    )
    return found.select("refdate", "symbol", six("pct_return"), six("log_return"))


# ---- futures

_BULLETIN_SQL = """bul AS (SELECT CAST(o_orderdate AS DATE) + 4000 AS refdate, ' ' || CASE o_orderstatus WHEN 'F' THEN 'DI1' WHEN 'O' THEN 'DDI' ELSE 'DOL' END || CASE WHEN o_custkey % 5 = 0 THEN 'A' ELSE 'F' END || lpad(CAST(o_custkey % 90 AS VARCHAR), 2, '0') || ' ' AS cod_gts,
        CASE o_orderstatus WHEN 'F' THEN 'DI1' WHEN 'O' THEN 'DDI' ELSE 'DOL' END AS commodity, CASE WHEN o_custkey % 7 = 0 THEN '1' ELSE '2' END AS market, CASE WHEN o_custkey % 11 = 0 THEN 0 ELSE 20000 + o_totalprice / 10 END AS settle,
        o_custkey % 300 AS du, o_custkey % 400 AS dc, o_orderkey FROM orders)"""


def derivatives_daily(spark, d):
    o, key = table(spark, d, "orders"), F.col("o_custkey")
    commodity = F.when(F.col("o_orderstatus") == "F", "DI1").when(F.col("o_orderstatus") == "O", "DDI").otherwise("DOL")
    settle = F.when(key % 11 == 0, 0.0).otherwise(F.col("o_totalprice") / 10 + 20000)
    code = F.concat(F.lit(" "), commodity, F.when(key % 5 == 0, "A").otherwise("F"), F.lpad((key % 90).cast("string"), 2, "0"), F.lit(" "))
    same = {c: settle for c in ("cot_primeiro_negocio", "cot_maior_negocio", "cot_menor_negocio", "cot_ult_negocio", "cot_med_negocios", "cot_ajuste")}
    return o.select(
        F.date_add(F.to_date("o_orderdate"), 4000).alias("data_geracao_arquivo"), code.alias("cod_gts"), commodity.alias("cod_mercadoria"),
        F.when(key % 7 == 0, "1").otherwise("2").alias("cod_mercado"), F.to_date("o_orderdate").alias("data_vencimento"), F.lit(1.0).alias("tamanho_contr"),
        (key % 300).alias("num_dias_saques"), (key % 400).alias("num_dias_corridos"), F.col("o_orderkey").alias("qtd_contr"), F.lit(2.0).alias("volume_real"),
        F.lit(3).alias("qtd_contr_aberto"), F.lit(4.0).alias("valor_ajuste_contr"), *[v.alias(k) for k, v in same.items()],
    )


_BD_SQL = """bd AS (SELECT refdate, trim(cod_gts) AS symbol, commodity, substr(trim(cod_gts), 4) AS expiration_code, nullif(settle, 0) AS adjusted_quote,
        CASE WHEN commodity IN ('DI1', 'OC1', 'DAP') AND settle > 0 AND du > 0 THEN round(ln(1 + round(pow(100000.0 / settle, 252.0 / du) - 1, 5)), 3)
             WHEN commodity IN ('DDI', 'DCO') AND settle > 0 AND dc > 0 THEN round((100000.0 / settle - 1) * 360.0 / dc, 5) END AS rate, o_orderkey AS traded_contracts
        FROM bul WHERE market = '2' AND refdate >= DATE '2006-05-22' AND regexp_matches(trim(cod_gts), '^[A-Z0-9]{3}[FGHJKMNQUVXZ][0-9]{2}$'))"""


@query(f"WITH {_BULLETIN_SQL}, {_BD_SQL} SELECT refdate, symbol, commodity, expiration_code, round(adjusted_quote, 4) AS adjusted_quote, rate, traded_contracts FROM bd")
def ds_futures_bd(spark, d):
    """Discrete rates span many powers of ten: their logarithm is compared."""
    found = DS.DATASETS["futures_bd"]({"derivatives_daily": derivatives_daily(spark, d)})
    rate = F.when(F.col("commodity") == "DI1", F.round(F.log(F.col("adjusted_tax") + 1), 3)).otherwise(F.col("adjusted_tax"))
    return found.select("refdate", "symbol", "commodity", "expiration_code", F.round("adjusted_quote", 4).alias("adjusted_quote"), rate.alias("rate"), "traded_contracts")


# the price row of a day and contract with most trades counts, none at all being less than any number; contracts of returned lines alone are not registered
@query("""SELECT CAST(l_shipdate AS DATE) AS refdate, 'F' || l_partkey % 50 AS symbol, nullif(best[1], -1) AS traded_contracts, best[2] AS volume, round(best[4] / 100, 8) AS adjusted_tax, CAST(best[3] AS BIGINT) AS open_interest
    FROM (SELECT l_shipdate, l_partkey, max([CASE WHEN l_linenumber = 4 THEN -1 ELSE l_quantity END, l_extendedprice, l_orderkey * 10 + l_linenumber, l_tax]) OVER w AS best,
              bool_or(l_returnflag <> 'R') OVER w AS registered, row_number() OVER w AS n FROM lineitem WINDOW w AS (PARTITION BY CAST(l_shipdate AS DATE), l_partkey % 50))
    WHERE registered AND n = 1""")
def ds_futures_bvbg(spark, d):
    line = table(spark, d, "lineitem").withColumns({"refdate": F.to_date("l_shipdate"), "symbol": F.concat(F.lit("F"), (F.col("l_partkey") % 50).cast("string"))})
    contracts = line.where("l_returnflag <> 'R'").select("refdate", "symbol").distinct()
    contracts = contracts.withColumns({"instrument_asset": F.lit("X"), "expiration_code": F.lit("F24"), "maturity_date": F.col("refdate"), "contract_multiplier": F.lit(1.0)})
    prices = line.select(
        "refdate", "symbol", F.when(F.col("l_linenumber") != 4, F.col("l_quantity")).alias("traded_contracts"), F.col("l_extendedprice").alias("volume"),
        F.lit(1.0).alias("adjusted_quote"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("open_interest"), F.col("l_tax").alias("adjusted_tax"),
    )
    found = DS.DATASETS["futures_bvbg"]({"price_reports": prices, "instruments_futures": contracts})
    return found.select("refdate", "symbol", "traded_contracts", "volume", F.round("adjusted_tax", 8).alias("adjusted_tax"), "open_interest")
