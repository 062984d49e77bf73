"""More queries of dataset jobs. Their inputs are made of the tables so that what must come out is known from the rows alone:
the SQL says that, not the steps of the job."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapewright.functions.scratch import table
from tapewright.operators import timeseries as X
from tapewright.plans import datasets as DS
from tapewright.plans.dataset_queries import register
from tapewright.plans.finance_queries import _CONTINUOUS_SQL, _CONTRACTS_SQL, _PLANTED_SQL, cal_all, contracts, planted, planted_changes, planted_quotes
from tapewright.plans.queries import _CAL24, _CAL_ALL, _RETURNS_SQL, _bars_sql, bars, cal24, query, returned, six

PRICES = ("open", "high", "low", "close")


def _text(*parts):
    return F.concat(*[F.col(p).cast("string") if p[0].islower() else F.lit(p) for p in parts])


# ---- adjusted prices: returns that are the closes' own ratios leave the closes as they are

_HELD = "NOT (day(refdate) % 7 = 3 AND day(refdate) < 25)"
_SIX = ", ".join(f"round({c}, 6) AS {c}" for c in PRICES)


def _with_gaps(spark, d):
    """Candles without some days."""
    return bars(spark, d).where((F.day("refdate") % 7 != 3) | (F.day("refdate") >= 25))


def _rounded(found):
    return found.select("refdate", "symbol", *[six(c) for c in PRICES])


@query(f"""WITH {_RETURNS_SQL} SELECT refdate, symbol, CASE WHEN {_HELD} THEN round(open, 6) END AS open, CASE WHEN {_HELD} THEN round(high, 6) END AS high,
    CASE WHEN {_HELD} THEN round(low, 6) END AS low, round(close, 6) AS close FROM returned""")
def ds_equities_adjusted_prices(spark, d):
    """Days without a price keep their return; a price of the first day, which has no return, goes."""
    inputs = {"equities_returns": returned(spark, d), "price_reports": _with_gaps(spark, d)}
    return _rounded(DS.DATASETS["equities_adjusted_prices"](inputs))


def _index_reports(spark, d):
    return bars(spark, d).withColumnsRenamed({new: old for old, new in DS.REPORTED.items()})


@query(f"""WITH {_RETURNS_SQL} SELECT refdate, symbol, {_SIX} FROM returned WHERE symbol <> 'error'""")
def ds_indexes_adjusted_prices(spark, d):
    """An index without a return on the last day is left out."""
    last = F.col("refdate") < "2024-01-20"
    inputs = {"indexes_returns": returned(spark, d).where((F.col("symbol") != "error") | last), "index_reports": _index_reports(spark, d)}
    return _rounded(DS.DATASETS["indexes_adjusted_prices"](inputs))


# returns between the business days that are left; a day without any is filled with the row before it
_BIZ_SQL = f"""{_CAL24}, {_bars_sql()}, kept AS (SELECT candles.* FROM candles JOIN cal ON cal_date = refdate WHERE is_bizday AND {_HELD}),
    biz AS (SELECT * FROM kept k WHERE refdate > (SELECT min(refdate) FROM kept WHERE symbol = k.symbol)),
    grid AS (SELECT symbol, cal_date AS refdate FROM (SELECT symbol, min(refdate) AS a, max(refdate) AS b FROM biz GROUP BY 1) JOIN cal ON is_bizday AND cal_date BETWEEN a AND b)"""


def _on_bizdays(spark, d):
    days = cal24(spark).where("is_bizday").select(F.col("cal_date").alias("refdate"))
    return X.simple_log_returns(_with_gaps(spark, d).join(F.broadcast(days), "refdate"), "close", ["symbol"], "refdate")


@query(f"WITH {_BIZ_SQL} SELECT grid.refdate, grid.symbol, {_SIX} FROM grid ASOF JOIN biz ON grid.symbol = biz.symbol AND grid.refdate >= biz.refdate")
def ds_equities_adjusted_prices_filled(spark, d):
    rows = _on_bizdays(spark, d)
    return _rounded(DS.DATASETS["equities_adjusted_prices_filled"]({"equities_returns": rows, "price_reports": rows}, calendar=cal24(spark)))


@query(f"WITH {_BIZ_SQL} SELECT grid.refdate, grid.symbol, {_SIX} FROM grid ASOF JOIN biz ON grid.symbol = biz.symbol AND grid.refdate >= biz.refdate")
def ds_indexes_adjusted_prices_filled(spark, d):
    rows = _on_bizdays(spark, d)
    reports = rows.withColumnsRenamed({new: old for old, new in DS.REPORTED.items()})
    return _rounded(DS.DATASETS["indexes_adjusted_prices_filled"]({"indexes_returns": rows, "index_reports": reports}, calendar=cal24(spark)))


@query(f"WITH {_bars_sql()} SELECT refdate, symbol, {_SIX} FROM candles WHERE symbol <> 'error'")
def ds_indexes_prices(spark, d):
    reports = _index_reports(spark, d).where((F.col("symbol") != "error") | (F.col("refdate") < "2024-01-20"))
    return _rounded(DS.DATASETS["indexes_prices"]({"index_reports": reports}))


@query("SELECT DATE '2024-01-02' AS refdate, p_name AS symbol, round(coalesce(nullif(p_size, 13), 0) / 100.0, 6) AS pct_return, round(ln(1 + coalesce(nullif(p_size, 13), 0) / 100.0), 6) AS log_return FROM part")
def ds_indexes_returns(spark, d):
    p = table(spark, d, "part").select(F.lit("2024-01-02").cast("date").alias("refdate"), F.col("p_name").alias("symbol"), F.nullif("p_size", F.lit(13)).cast("double").alias("oscillation_val"))
    return DS.DATASETS["indexes_returns"]({"index_reports": p}).select("refdate", "symbol", six("pct_return"), six("log_return"))


@query(f"WITH {_bars_sql()} SELECT refdate, symbol, round(close, 6) AS price FROM candles, range(5)")
def ds_prices(spark, d):
    part = bars(spark, d).withColumn("price", F.col("close"))
    return DS.DATASETS["prices"](dict.fromkeys(DS.PRICE_PARTS, part)).select("refdate", "symbol", six("price"))


@query(f"WITH {_bars_sql()} SELECT refdate, symbol, {_SIX} FROM candles, range(3)")
def ds_ohlc_prices(spark, d):
    return _rounded(DS.DATASETS["ohlc_prices"](dict.fromkeys(DS.OHLC_PARTS, bars(spark, d))))


# ---- price history: the order's state says from which source a day comes, its key whether it is in the universe

@query("""SELECT CAST(o_orderdate AS DATE) + 8000 AS refdate, 'O' || o_orderkey AS symbol, o_orderkey AS trade_quantity, o_totalprice AS close, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 100 + 1 END AS distribution_id
    FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 4 < 3
    UNION ALL SELECT CASE WHEN o_orderkey % 3 = 0 THEN DATE '2021-06-10' ELSE CAST(o_orderdate AS DATE) + 4000 END, 'O' || o_orderkey, o_orderkey, o_totalprice, 7
    FROM orders WHERE o_orderstatus = 'O' AND o_orderkey % 4 < 3 AND o_orderkey % 7 > 0 AND (o_orderkey % 3 = 0 OR o_orderkey % 5 > 0)
    UNION ALL SELECT DATE '2016-02-29', 'O' || o_orderkey, o_orderkey, o_totalprice, 5
    FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 4 < 3 AND o_orderkey % 7 > 0 AND o_orderkey % 2 = 1 AND o_orderkey % 3 > 0""")
def ds_equities_unadjusted_prices(spark, d):
    """Reports by symbol; history and bulletin by symbol and paper, on their days only."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    o = table(spark, d, "orders").withColumns({"symbol": _text("O", "o_orderkey"), "day": F.to_date("o_orderdate")})
    o = o.withColumn("isin", F.when(key % 7 == 0, "OLD").otherwise(_text("I", "o_orderkey")))
    same = [price.alias(c) for c in ("volume", "open", "low", "high", "close", "average")]
    f, old, b = (o.where(F.col("o_orderstatus") == s) for s in "FOP")
    reports = f.select(F.date_add("day", 8000).alias("refdate"), "symbol", key.alias("traded_quantity"), key.alias("traded_contracts"), *same)
    spot = [F.lit(10).alias("instrument_market"), F.lit(1).alias("instrument_segment"), F.lit("A").alias("instrument_asset"), F.lit(11).alias("security_category")]
    ids = F.explode(F.array(key % 100, key % 100 + 1)).alias("distribution_id")
    registered = f.where(key % 2 == 0).select(F.date_add("day", 8000).alias("refdate"), "symbol", ids, *spot)
    gap = F.when(key % 3 == 0, F.lit("2021-06-10").cast("date")).otherwise(F.date_add("day", 4000))
    history = old.select(gap.alias("refdate"), "symbol", "isin", F.when(key % 5 == 0, 20).otherwise(10).alias("instrument_market"), key.alias("trade_quantity"), key.alias("traded_contracts"), F.lit(7).cast("long").alias("distribution_id"), *same)
    bulletin = b.select(
        F.when(key % 2 == 1, "2016-02-29").otherwise("2016-02-28").cast("date").alias("refdate"), F.col("symbol").alias("cod_negociacao"), F.col("isin").alias("cod_isin"),
        F.when(key % 3 == 0, 3).otherwise(2).alias("cod_bdi"), key.alias("qtd_negocios"), key.alias("qtd_titulos_negociados"), F.lit(5.0).alias("num_dist"),
        *[price.alias(c) for c in ("volume_titulos_negociados", "preco_abertura", "preco_min", "preco_max", "preco_ult", "preco_med")],
    )
    inputs = {
        "equities_spot_market": o.where(key % 4 < 3).select("symbol", _text("I", "o_orderkey").alias("isin")), "instruments_equities": registered,
        "price_reports": reports, "cotahist": history, "bulletin_stocks": bulletin,
    }
    return DS.DATASETS["equities_unadjusted_prices"](inputs).select("refdate", "symbol", "trade_quantity", "close", "distribution_id")


@query("SELECT CAST(o_orderdate AS DATE) AS refdate, 'O' || o_orderkey AS symbol, o_totalprice AS close FROM orders WHERE o_orderstatus IN ('F', 'O')")
def ds_cotahist(spark, d):
    o = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("refdate"), _text("O", "o_orderkey").alias("symbol"), F.col("o_totalprice").alias("close"), "o_orderstatus")
    yearly, daily = (o.where(F.col("o_orderstatus") == s).drop("o_orderstatus") for s in "FO")
    return DS.DATASETS["cotahist"]({"cotahist_yearly": yearly, "cotahist_daily": daily})


@query("SELECT CAST(o_orderdate AS DATE) AS refdate, 'S' || o_custkey AS symbol, o_orderkey FROM orders")
def ds_equities_register(spark, d):
    return DS.DATASETS["equities_register"]({"instruments_equities": register(spark, d)}).select("refdate", "symbol", "o_orderkey")


@query("SELECT 'F' || s_suppkey AS acronym, 'F' || s_suppkey || '11' AS symbol FROM supplier")
def ds_listed_funds_consolidated(spark, d):
    return DS.DATASETS["listed_funds_consolidated"]({"listed_funds": table(spark, d, "supplier").select(_text("F", "s_suppkey").alias("acronym"))})


@query(f"""WITH {_bars_sql()} SELECT refdate - 3000 AS refdate, symbol, round(close / before - 1, 6) AS pct_return, round(ln(close / before), 6) AS log_return
    FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY refdate) AS before FROM candles WHERE symbol <> 'view') WHERE before IS NOT NULL
    UNION ALL SELECT refdate, symbol, round(coalesce(close, 0) / 100, 6), round(ln(1 + coalesce(close, 0) / 100), 6) FROM candles WHERE symbol <> 'view'""")
def ds_equities_etfs_returns(spark, d):
    """The ratio of closes in the old days, oscillations in the new ones."""
    b = bars(spark, d)
    universe = b.select("symbol", F.when(F.col("symbol") == "view", 11).otherwise(3).alias("security_category"))
    old = b.select(F.date_sub("refdate", 3000).alias("refdate"), "symbol", "close")
    found = DS.DATASETS["equities_etfs_returns"]({"equities_spot_market": universe, "cotahist": old, "price_reports": b.withColumn("oscillation", F.col("close"))})
    return found.select("refdate", "symbol", six("pct_return"), six("log_return"))


# ---- renames that are planted

def _planted_inputs(spark, d):
    moves = planted(spark, d).where("has_return").select(F.date_add(F.lit("2018-01-01").cast("date"), F.col("cut").cast("int")).alias("refdate"), F.col("new_symbol").alias("symbol"), (F.col("percent") / 100).alias("pct_return"))
    return {"cotahist": planted_quotes(spark, d).withColumns({"instrument_market": F.lit(10), "corporation_name": F.substring("symbol", 1, 4)}), "equities_returns": moves}


@query(f"""WITH {_PLANTED_SQL} SELECT old_symbol AS src_symbol, new_symbol AS dest_symbol, DATE '2018-01-01' + CAST(cut AS INTEGER) AS change_date, CAST(10 + j AS DOUBLE) AS src_last_close,
    round((10 + j) * (1 + percent / 100.0), 6) AS dest_first_close, substr(old_symbol, 1, 4) AS corporation_name_src, substr(new_symbol, 1, 4) AS corporation_name_dest FROM planted WHERE NOT apart""")
def ds_equities_symbol_changes(spark, d):
    found = DS.DATASETS["equities_symbol_changes"](_planted_inputs(spark, d))
    return found.select("src_symbol", "dest_symbol", "change_date", "src_last_close", six("dest_first_close"), "corporation_name_src", "corporation_name_dest")


def _renames(spark, d):
    return planted_changes(spark, d).select(F.col("old_symbol").alias("src_symbol"), F.col("new_symbol").alias("dest_symbol"))


@query(f"""WITH {_PLANTED_SQL}, k AS (SELECT *, unnest(range(40)) AS k FROM planted WHERE NOT apart)
    SELECT DATE '2018-01-01' + CAST(k AS INTEGER) AS refdate, new_symbol AS symbol, CAST(10 + j AS DOUBLE) AS close FROM k WHERE k < cut""")
def ds_equities_returns_symbols_changes(spark, d):
    inputs = {"equities_symbol_changes": _renames(spark, d), "equities_returns": planted_quotes(spark, d).select("refdate", "symbol", "close")}
    return DS.DATASETS["equities_returns_symbols_changes"](inputs)


@query(f"""WITH {_PLANTED_SQL} SELECT old_symbol AS symbol, 1 AS first_session, CAST(cut AS INTEGER) AS last_session, TRUE AS hard_stop, FALSE AS sudden_start, NOT apart AS stop_matched, FALSE AS start_matched FROM planted
    UNION ALL SELECT new_symbol, CAST(cut + CASE WHEN j % 11 = 0 THEN 2 ELSE 1 END AS INTEGER), 40, FALSE, TRUE, FALSE, NOT apart FROM planted""")
def ds_equities_symbol_spans_analysis(spark, d):
    inputs = {"equities_symbol_changes": _renames(spark, d), "equities_unadjusted_prices": planted_quotes(spark, d)}
    found = DS.DATASETS["equities_symbol_spans_analysis"](inputs)
    return found.select("symbol", "first_session", "last_session", "hard_stop", "sudden_start", "stop_matched", "start_matched")


# ---- companies

_INDUSTRY = {0: "Financeiro / Intermediários Financeiros / Bancos", 1: "Saúde / Equipamentos / Material", 2: "Agro / Grãos", 3: None}


def _company_inputs(spark, d):
    """Every supplier is a company; older snapshots and a second ticker say something else."""
    j = F.col("s_suppkey")
    s = table(spark, d, "supplier").withColumns({"issuingCompany": _text("I", "s_suppkey"), "codeCVM": j.cast("long")})
    new, old = F.lit("2024-02-01").cast("date").alias("refdate"), F.lit("2023-02-01").cast("date").alias("refdate")
    kind = F.when(j % 9 == 0, "BALCAO").otherwise("BOLSA").alias("tp_merc")
    cvm = [s.select(j.alias("code_cvm"), _text("C", "s_suppkey").alias("cnpj_cia"), name.alias("denom_social"), F.lit("reg").alias("denom_comerc"), F.lit("ATIVO").alias("sit"), kind, day) for name, day in ((F.col("s_name"), new), (F.lit("old"), old))]
    industry = F.when(j % 4 == 0, _INDUSTRY[0]).when(j % 4 == 1, _INDUSTRY[1]).when(j % 4 == 2, _INDUSTRY[2])
    known = s.where(j % 5 > 0)
    details = [
        known.select("issuingCompany", "codeCVM", F.concat(F.lit(word), "s_name").alias("companyName"), F.lit("det").alias("tradingName"), industry.alias("industryClassification"), code.alias("code"), F.lit("site").alias("website"), F.lit("B").alias("hasBDR"), day)
        for word, code, day in (("Own ", F.lit("A"), new), ("Own ", F.lit("B"), new), ("Old ", F.lit("A"), old))
    ]
    info = [s.where(j % 3 > 0).select("issuingCompany", F.lit("inf").alias("tradingName"), F.lit(level).alias("segment"), (F.col("s_acctbal") + more).alias("stockCapital"), F.lit("S").alias("hasCommom"), day) for level, more, day in (("NM", 0, new), ("N1", 1, old))]
    return {"cvm_registration": cvm[0].unionByName(cvm[1]), "company_details": details[0].unionByName(details[1]).unionByName(details[2]), "company_info": info[0].unionByName(info[1])}


_COMPANIES_SQL = """master AS (SELECT CAST(s_suppkey AS VARCHAR) AS code_cvm, CASE WHEN has THEN 'Own ' || s_name ELSE s_name END AS company_name, CASE WHEN has AND s_suppkey % 3 > 0 THEN 'inf' WHEN has THEN 'det' ELSE 'reg' END AS trading_name,
        CASE WHEN has THEN 'I' || s_suppkey END AS issuing_company, 'C' || s_suppkey AS cvm_cnpj,
        CASE WHEN has THEN ['Financeiro', 'Saúde', 'Agro', NULL][s_suppkey % 4 + 1] END AS sector, CASE WHEN has THEN ['Intermediários Financeiros', 'Equipamentos', 'Grãos', NULL][s_suppkey % 4 + 1] END AS subsector,
        CASE WHEN has THEN ['Bancos', 'Material', '', NULL][s_suppkey % 4 + 1] END AS segment, CASE WHEN has THEN 'site' END AS website, CASE WHEN has THEN 'B' END AS has_bdr,
        CASE WHEN has AND s_suppkey % 3 > 0 THEN 'NM' END AS listing_segment, CASE WHEN has AND s_suppkey % 3 > 0 THEN s_acctbal END AS stock_capital, CASE WHEN has AND s_suppkey % 3 > 0 THEN 'S' END AS has_common
    FROM (SELECT *, s_suppkey % 5 > 0 AS has FROM supplier WHERE s_suppkey % 9 > 0))"""


@query(f"WITH {_COMPANIES_SQL} SELECT * FROM master")
def ds_companies(spark, d):
    found = DS.DATASETS["companies"](_company_inputs(spark, d))
    return found.select("code_cvm", "company_name", "trading_name", "issuing_company", "cvm_cnpj", "sector", "subsector", "segment", "website", "has_bdr", "listing_segment", "stock_capital", "has_common")


@query(f"""WITH {_COMPANIES_SQL}, names AS (SELECT * FROM (VALUES ('Financeiro', 'Financials', 'Financials', 'Financials', 'Banking'), ('Saúde', 'Health Care', 'Health Care', 'Health Care', 'Medical Equipment'), ('Agro', 'Unclassified', 'Unclassified', 'Unclassified', 'Other'))
        t(sector, gics_sector, icb_sector, normalized_sector, normalized_subsector))
    SELECT DISTINCT sector, subsector, gics_sector, icb_sector, normalized_sector, normalized_subsector FROM master JOIN names USING (sector)""")
def ds_industry_sectors(spark, d):
    return DS.DATASETS["industry_sectors"]({"companies": DS.DATASETS["companies"](_company_inputs(spark, d))})


# ---- events: every part is a company; its key says which sources know its event

def _paper(key):
    """An ISIN a key, whatever its size: five digits before the type, and those above them, counted from one, at the end."""
    return F.concat(F.lit("B"), F.lpad((key % 100000).cast("string"), 5, "0"), F.lit("ACNOR"), (F.floor(key / 100000) + 1).cast("string"))


def _event_inputs(spark, d):
    key = F.col("p_partkey")
    p = table(spark, d, "part").withColumns({"issuing": _text("I", "p_partkey"), "day": F.date_add(F.lit("2020-01-01").cast("date"), (key % 300).cast("int"))})
    new, old = (F.lit(x).cast("date").alias("refdate") for x in ("2021-02-01", "2021-01-01"))
    names = p.select(key.alias("code_cvm"), F.concat(_text("T", "p_partkey"), F.lit(" ")).alias("trading_name"), F.col("issuing").alias("instrument_asset"), new)
    symbols = p.where(key % 5 > 0).select(F.col("issuing").alias("issuing_company"), F.lit("ON").alias("share_class"), F.concat("issuing", F.lit("3")).alias("symbol"), _paper(key).alias("isin"))
    a = [
        p.where(key % 2 == 0).select(
            _text("T", "p_partkey").alias("trading_name"), F.lit("on").alias("type_stock"), F.lit("DIVIDENDO").alias("corporate_action"), F.col("day").alias("last_date_prior_ex"), F.col("day").alias("date_approval"),
            value.alias("value_cash"), F.lit(1.0).alias("ratio"), F.lit(2.0).alias("corporate_action_price"), F.lit(3.0).alias("closing_price_prior_ex_date"), day)
        for value, day in ((key / 100, new), (F.lit(99999.0), old))
    ]
    event = p.select(
        "p_partkey", F.col("issuing").alias("issuingCompany"), F.lit("").alias("assetIssued"), _paper(key).alias("isinCode"), F.lit("DIVIDENDO").alias("label"), F.col("day").alias("lastDatePrior"), F.col("day").alias("approvedOn"),
        F.col("day").alias("paymentDate"), F.lit("2020").alias("relatedTo"), F.when(key % 9 == 0, key / 100 + 1).otherwise(key / 100).alias("rate"), F.lit(4.0).alias("factor"), F.lit(5.0).alias("priceUnit"), F.col("day").alias("subscriptionDate"), new)
    b = event.where(key % 3 == 0)
    return {
        "companies_names": names, "companies_symbols": symbols, "cash_dividends": a[0].unionByName(a[1]), "company_cash_dividends": b.drop("p_partkey"),
        "subscriptions": event.where(key % 3 == 1).withColumn("label", F.when(key % 2 == 0, "SUBSCRICAO").otherwise("OUTRA")).drop("p_partkey"),
        "stock_dividends": event.where(key % 3 == 2).withColumn("label", F.when(key % 2 == 0, "DESDOBRAMENTO").otherwise("GRUPAMENTO")).drop("p_partkey"),
    }


_CASH_SQL = """cash AS (SELECT CAST(p_partkey AS VARCHAR) AS code_cvm, 'I' || p_partkey AS issuing_company, CASE WHEN p_partkey % 5 > 0 THEN 'I' || p_partkey || '3' END AS symbol, 'ON' AS share_class, DATE '2020-01-01' + CAST(p_partkey % 300 AS INTEGER) AS ex_date,
        round(CASE WHEN p_partkey % 9 = 0 AND p_partkey % 2 = 1 THEN p_partkey / 100.0 + 1 ELSE p_partkey / 100.0 END, 6) AS value_cash, CASE WHEN p_partkey % 18 = 0 THEN round(p_partkey / 100.0 + 1, 6) END AS value_cash_alt,
        CASE WHEN p_partkey % 6 = 0 THEN 'both' WHEN p_partkey % 2 = 0 THEN 'b3-cash-dividends' ELSE 'company-info' END AS source FROM part WHERE p_partkey % 2 = 0 OR p_partkey % 3 = 0)"""


@query(f"WITH {_CASH_SQL} SELECT * FROM cash")
def ds_cash_dividends_events(spark, d):
    found = DS.DATASETS["cash_dividends_events"](_event_inputs(spark, d))
    return found.select("code_cvm", "issuing_company", "symbol", "share_class", "ex_date", six("value_cash"), six("value_cash_alt"), "source")


@query("""SELECT CAST(p_partkey AS VARCHAR) AS code_cvm, 'I' || p_partkey AS issuing_company, CASE WHEN p_partkey % 5 > 0 THEN 'I' || p_partkey || '3' END AS symbol, 'ON' AS share_class,
    CASE WHEN p_partkey % 2 = 0 THEN 'SUBSCRICAO' ELSE 'OUTRA' END AS event_type_raw, DATE '2020-01-01' + CAST(p_partkey % 300 AS INTEGER) AS ex_date, 5.0 AS subscription_price FROM part WHERE p_partkey % 3 = 1""")
def ds_subscription_events(spark, d):
    return DS.DATASETS["subscription_events"](_event_inputs(spark, d)).select("code_cvm", "issuing_company", "symbol", "share_class", "event_type_raw", "ex_date", "subscription_price")


@query(f"""WITH {_CASH_SQL} SELECT 'CASH' AS event_family, 'CASH_DIVIDEND' AS event_type, issuing_company, symbol, ex_date, value_cash, CAST(NULL AS DOUBLE) AS factor, CAST(NULL AS DOUBLE) AS subscription_price, source FROM cash
    UNION ALL SELECT CASE p_partkey % 3 WHEN 1 THEN 'SUBSCRIPTION' ELSE 'STOCK' END, CASE WHEN p_partkey % 3 = 1 AND p_partkey % 2 = 0 THEN 'SUBSCRIPTION' WHEN p_partkey % 3 = 1 THEN 'OTHER' WHEN p_partkey % 2 = 0 THEN 'SPLIT' ELSE 'REVERSE_SPLIT' END,
        'I' || p_partkey, CASE WHEN p_partkey % 5 > 0 THEN 'I' || p_partkey || '3' END, DATE '2020-01-01' + CAST(p_partkey % 300 AS INTEGER), NULL, CASE WHEN p_partkey % 3 = 2 THEN 4.0 END, CASE WHEN p_partkey % 3 = 1 THEN 5.0 END, 'company-info' FROM part WHERE p_partkey % 3 > 0""")
def ds_corporate_events(spark, d):
    i = _event_inputs(spark, d)
    families = {name: DS.DATASETS[name](i) for name in ("cash_dividends_events", "stock_events", "subscription_events")}
    return DS.DATASETS["corporate_events"](families).select("event_family", "event_type", "issuing_company", "symbol", "ex_date", six("value_cash"), "factor", "subscription_price", "source")


# ---- futures: the orders' contracts as futures of five commodities

COMMODITIES = {"1-URGENT": "DAP", "2-HIGH": "IND", "3-MEDIUM": "WDO", "4-NOT SPECIFIED": "WIN", "5-LOW": "DDI"}


def _futures(spark, d):
    c = contracts(spark, d)
    commodity = F.lit("OTHER")
    for product, name in COMMODITIES.items():
        commodity = F.when(F.col("product") == product, name).otherwise(commodity)
    named = c.withColumn("commodity", commodity)
    return named.select(
        "refdate", F.concat("commodity", F.date_format("maturity", "yyyyMMdd")).alias("symbol"), "commodity", F.col("maturity").alias("maturity_date"),
        F.col("quote").alias("adjusted_quote"), F.lit(None).cast("double").alias("adjusted_tax"),
    )


def _generic(product: str, commodity: str):
    @query(f"""WITH {_CONTRACTS_SQL} SELECT refdate, '{commodity}T01' AS symbol, '{commodity}' || strftime(min(maturity), '%Y%m%d') AS ref, min(maturity) AS maturity_date, arg_min(quote, maturity) AS adjusted_quote
        FROM contracts WHERE product = '{product}' AND maturity > refdate GROUP BY 1""", name=f"ds_futures_{commodity.lower()}_first_generic")
    def generic(spark, d):
        return DS.DATASETS[f"futures_{commodity.lower()}_first_generic"]({"futures": _futures(spark, d)}).drop("adjusted_tax")


for _product, _commodity in COMMODITIES.items():
    if _commodity != "DDI":
        _generic(_product, _commodity)


@query(f"""WITH {_CAL_ALL}, {_CONTRACTS_SQL}, ends AS (SELECT cal_date, CASE WHEN is_bizday THEN biz_idx ELSE biz_idx + 1 END AS at FROM cal)
    SELECT refdate, 'DDIT01' AS symbol, min(maturity) AS maturity_date, arg_min(quote, maturity) AS adjusted_quote FROM contracts JOIN ends x ON x.cal_date = refdate JOIN ends y ON y.cal_date = maturity
    WHERE product = '5-LOW' AND maturity > refdate AND y.at - x.at >= 2 GROUP BY 1""")
def ds_futures_ddi_first_generic(spark, d):
    found = DS.DATASETS["futures_ddi_first_generic"]({"futures": _futures(spark, d)}, calendar=cal_all(spark))
    return found.select("refdate", "symbol", "maturity_date", "adjusted_quote")


def _adjusted(product: str, commodity: str):
    @query(f"WITH {_CONTRACTS_SQL}, {_CONTINUOUS_SQL} SELECT refdate, '{commodity}ADJ' AS symbol, round(ln(s1) + p, 6) AS log_price FROM continuous WHERE product = '{product}'", name=f"ds_futures_{commodity.lower()}_adjusted")
    def adjusted(spark, d):
        found = DS.DATASETS[f"futures_{commodity.lower()}_adjusted"]({"futures": _futures(spark, d)})
        return found.select("refdate", "symbol", F.round(F.log("price"), 6).alias("log_price"))


_adjusted("3-MEDIUM", "WDO")
_adjusted("4-NOT SPECIFIED", "WIN")


@query(f"WITH {_RETURNS_SQL} SELECT refdate, symbol, round(pct_return, 6) AS pct_return, round(log_return, 6) AS log_return FROM returned")
def ds_futures_win_adjusted_returns(spark, d):
    found = DS.DATASETS["futures_win_adjusted_returns"]({"futures_win_adjusted": bars(spark, d).withColumn("price", F.col("close"))})
    return found.select("refdate", "symbol", six("pct_return"), six("log_return"))


@query("""SELECT 'F' || l_partkey AS symbol, l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) + 6500 AS refdate, l_quantity AS open_interest FROM lineitem
    WHERE (CAST(l_shipdate AS DATE) + 6500 < DATE '2016-02-01' OR CAST(l_shipdate AS DATE) + 6500 = DATE '2016-02-29') = (l_returnflag = 'A')""")
def ds_futures(spark, d):
    """Lines that were sent back are the old source, all others the new one; each is taken on its own days."""
    line = table(spark, d, "lineitem").select(_text("F", "l_partkey").alias("symbol"), "l_orderkey", "l_linenumber", F.date_add(F.to_date("l_shipdate"), 6500).alias("refdate"), F.col("l_quantity").alias("open_interest"), "l_returnflag")
    old, new = (line.where(f).drop("l_returnflag") for f in ("l_returnflag = 'A'", "l_returnflag <> 'A'"))
    return DS.DATASETS["futures"]({"futures_bd": old.withColumn("only_old", F.lit(1)), "futures_bvbg": new})


@query("SELECT 'F' || o_orderkey AS symbol, CAST(o_orderdate AS DATE) AS refdate FROM orders WHERE CAST(o_orderdate AS DATE) = (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)")
def ds_futures_register(spark, d):
    o = table(spark, d, "orders").select(_text("F", "o_orderkey").alias("symbol"), F.to_date("o_orderdate").alias("refdate"))
    return DS.DATASETS["futures_register"]({"instruments_futures": o})


def _copy(name: str, source: str):
    @query("SELECT p_partkey, p_name, p_retailprice FROM part", name=f"ds_{name}")
    def copy(spark, d):
        return DS.DATASETS[name]({source: table(spark, d, "part").select("p_partkey", "p_name", "p_retailprice")})


for _name in ("futures_settlement_prices", "indexes_current_portfolio", "indexes_theoretical_portfolio"):
    _copy(f"{_name}_consolidated", _name)


# ---- curves

@query(f"""WITH {_CAL_ALL}, f AS (SELECT CAST(o_orderdate AS DATE) AS refdate, 'DAP' || o_orderkey AS symbol, CAST(o_orderdate AS DATE) + CAST(o_custkey % 400 AS INTEGER) AS raw, o_custkey % 1000 / 10000.0 AS tax FROM orders WHERE o_orderstatus = 'O'),
    ends AS (SELECT a.cal_date, b.biz_idx AS at FROM cal a JOIN cal b ON a.next_bizday = b.cal_date)
    SELECT refdate, symbol, tax AS adjusted_tax, next_bizday AS maturity_date, y.at - x.at AS business_days FROM f JOIN cal c ON c.cal_date = raw JOIN ends x ON x.cal_date = refdate JOIN ends y ON y.cal_date = next_bizday WHERE raw > refdate""")
def ds_curves_dap(spark, d):
    o = table(spark, d, "orders").where("o_orderstatus = 'O'").withColumn("refdate", F.to_date("o_orderdate"))
    f = o.select("refdate", _text("DAP", "o_orderkey").alias("symbol"), F.lit("DAP").alias("commodity"), F.date_add("refdate", (F.col("o_custkey") % 400).cast("int")).alias("maturity_date"), (F.col("o_custkey") % 1000 / 10000).alias("adjusted_tax"))
    return DS.DATASETS["curves_dap"]({"futures": f}, calendar=cal_all(spark)).select("refdate", "symbol", "adjusted_tax", "maturity_date", "business_days")


# a curve whose logarithm is a straight line of the days is the same line between its vertices
_LINE_SQL = """line AS (SELECT CAST(o_orderdate AS DATE) AS refdate, 0.0001 * (count(*) % 7) AS a, 0.0002 + 0.00001 * (count(*) % 5) AS b FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1)"""


def _line(spark, d):
    days = table(spark, d, "orders").where("o_orderdate < '1998-01-01'").groupBy(F.to_date("o_orderdate").alias("refdate")).agg(F.count("*").alias("n"))
    return days.select("refdate", (F.col("n") % 7 * 0.0001).alias("a"), (F.col("n") % 5 * 0.00001 + 0.0002).alias("b"))


def _rate(t):
    return F.exp((F.col("a") + F.col("b") * t) * 252 / t) - 1


def _standard(product: str, terms: tuple[int, ...]):
    wanted = ", ".join(map(str, terms))

    @query(f"""WITH {_CAL_ALL}, {_LINE_SQL}, w AS (SELECT *, unnest([{wanted}]) AS term FROM line)
        SELECT refdate, '{product}T' || term AS symbol, CAST(term AS BIGINT) AS business_days, round(exp((a + b * term) * 252 / term) - 1, 6) AS adjusted_tax FROM w""", name=f"ds_curves_{product.lower()}_standard")
    def standard(spark, d):
        knots = _line(spark, d).withColumn("business_days", F.explode(F.array(*[F.lit(t) for t in (15, 300, 700, 1300)])))
        knots = knots.select("refdate", "business_days", _rate(F.col("business_days")).alias("adjusted_tax"))
        found = DS.DATASETS[f"curves_{product.lower()}_standard"]({f"curves_{product.lower()}": knots}, calendar=cal_all(spark))
        return found.select("refdate", "symbol", "business_days", six("adjusted_tax"))

    @query(f"WITH {_bars_sql()} SELECT refdate, symbol, round(close - lag(close) OVER (PARTITION BY symbol ORDER BY refdate), 6) AS returns FROM candles", name=f"ds_curves_{product.lower()}_standard_returns")
    def moved(spark, d):
        found = DS.DATASETS[f"curves_{product.lower()}_standard_returns"]({f"curves_{product.lower()}_standard": bars(spark, d).withColumn("adjusted_tax", F.col("close"))})
        return found.select("refdate", "symbol", six("returns"))


for _curve, _terms in DS.STANDARD_TERMS.items():
    _standard(_curve, _terms)
