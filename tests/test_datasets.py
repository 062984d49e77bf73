import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tapewright.operators.calendar import build_calendar
from tapewright.plans import datasets as DS

D = dt.date


def build(name, inputs, **options):
    return DS.DATASETS[name](inputs, **options)


def test_every_dataset_has_a_job():
    assert len(DS.DATASETS) == 58


@pytest.fixture()
def market(spark):
    spot = spark.createDataFrame([("PETR4", "BRPETRACNPR6", 11)], "symbol string, isin string, security_category int")
    q = "refdate date, symbol string, isin string, instrument_market long, trade_quantity long, traded_contracts long, volume double, open double, low double, high double, close double, average double, distribution_id long"
    hist = [(D(2005, 3, 1), "BROTHERXXXX0", 10, 9.0, 100), (D(2010, 6, 15), "BRPETRACNPR6", 10, 10.5, 102), (D(2010, 6, 16), "BRPETRACNPR6", 20, 10.6, 102), (D(2021, 6, 10), "BRPETRACNPR6", 10, 28.0, 205)]
    cot = spark.createDataFrame([(d, "PETR4", i, m, 1, 1, 1.0, c, c, c, c, c, k) for d, i, m, c, k in hist], q)
    daily = spark.createDataFrame([(D(2016, 3, 1), "PETR4", 1, 1, 1.0, 12.5, 12.5, 12.5, 12.5, 12.5, 2.0), (D(2016, 3, 2), "PETR4", 1, 1, 1.0, 13.0, 13.0, 13.0, 13.0, 13.0, None)], "refdate date, symbol string, traded_quantity long, traded_contracts long, volume double, open double, low double, high double, close double, average double, oscillation double")
    b = "refdate date, cod_negociacao string, cod_isin string, cod_bdi long, qtd_negocios long, qtd_titulos_negociados long, volume_titulos_negociados double, preco_abertura double, preco_min double, preco_max double, preco_ult double, preco_med double, num_dist double, oscilacao_preco double, sinal_oscilacao_preco string"
    bulletin = spark.createDataFrame([(D(2016, 2, 29), "PETR4", "BRPETRACNPR6", 2, 1, 1, 1.0, 11.0, 11.0, 11.0, 11.0, 11.0, 115.0, 3.0, "-")], b)
    reg = [(D(2016, 3, 1), "PETR4", k, m, 1, "PETR", 11) for k, m in ((137, 10), (138, 10), (999, 20))]
    register = spark.createDataFrame(reg, "refdate date, symbol string, distribution_id long, instrument_market long, instrument_segment long, instrument_asset string, security_category long")
    return {"equities_spot_market": spot, "cotahist": cot, "price_reports": daily, "bulletin_stocks": bulletin, "instruments_equities": register}


def test_unadjusted_prices(market):
    got = [(r["refdate"], r["close"], r["distribution_id"]) for r in build("equities_unadjusted_prices", market).collect()]
    assert got == [(D(2010, 6, 15), 10.5, 102), (D(2016, 2, 29), 11.0, 115), (D(2016, 3, 1), 12.5, 138), (D(2016, 3, 2), 13.0, None), (D(2021, 6, 10), 28.0, 205)]


def test_returns_of_equities(market):
    got = [(r["refdate"], round(r["pct_return"], 6)) for r in build("equities_returns", market).collect()]
    assert got == [(D(2016, 2, 29), -0.03), (D(2016, 3, 1), 0.02), (D(2016, 3, 2), 0.0)]
    inputs = {"price_reports": market["price_reports"], "equities_returns": build("equities_returns", market)}
    adjusted = build("equities_adjusted_prices", inputs).orderBy("refdate").collect()
    assert [(r["refdate"], r["close"]) for r in adjusted] == [(D(2016, 2, 29), pytest.approx(13.0 / 1.02)), (D(2016, 3, 1), 13.0), (D(2016, 3, 2), 13.0)]
    assert build("equities_adjusted_prices_filled", inputs, calendar=build_calendar(market["cotahist"].sparkSession, "2010-01-01", "2021-12-31")).count() == 3


@pytest.mark.parametrize(("name", "prices", "returns"), [("equities_adjusted_prices", "price_reports", "equities_returns"), ("indexes_adjusted_prices", "index_reports", "indexes_returns")])
def test_a_return_without_a_price_counts(spark, name, prices, returns):
    rows = [(D(2024, 1, k), "A", c) for k, c in ((2, 10.0), (3, 11.0), (5, 13.0), (9, 14.0))]
    p = spark.createDataFrame(rows, "refdate date, symbol string, close double").withColumns({c: F.col("close") for c in ("open", "high", "low")})
    r = spark.createDataFrame([(D(2024, 1, 2), "A", 0.5), (D(2024, 1, 4), "A", 0.1), (D(2024, 1, 5), "A", 0.2), (D(2024, 1, 9), "A", 0.3)], "refdate date, symbol string, log_return double")
    i, cal = {prices: p, returns: r}, build_calendar(spark, "2023-12-01", "2024-01-31")
    wanted = {2: 14 * math.exp(-0.6), 4: 14 * math.exp(-0.5), 5: 14 * math.exp(-0.3), 9: 14.0}  # the price of the 3rd has no return
    for options in ({}, {"calendar": cal}):
        got = {x["refdate"].day: x for x in build(name, i, **options).collect()}
        assert {k: x["close"] for k, x in got.items()} == pytest.approx(wanted) and got[4]["open"] is None
    filled = {x["refdate"].day: x["close"] for x in build(f"{name}_filled", i, calendar=cal).collect()}
    assert filled == pytest.approx({**wanted, 3: 14 * math.exp(-0.6), 8: 14 * math.exp(-0.3)})
    with pytest.raises(ValueError, match="calendar"):
        build(f"{name}_filled", i)


def test_universe(spark):
    rows = [(D(2016, 2, 1), "PETR4", "PETROBRAS", "PETR", 10), (D(2026, 7, 24), "PETR4", "PETROBRAS", "PETR", 10), (D(2016, 2, 1), "T1", "Ativo Teste ON", "T", 10), (D(2016, 2, 1), "X1", "XX", "XONE", 10), (D(2016, 2, 1), "F1", "F", "F", 20)]
    df = spark.createDataFrame(rows, "refdate date, symbol string, corporation_name string, instrument_asset string, instrument_market long").withColumns({"instrument_segment": F.lit(1), "security_category": F.lit(11)})
    got = build("equities_spot_market", {"instruments_equities": df})
    assert [r["symbol"] for r in got.collect()] == ["PETR4", "PETR4"]
    last = {r["instrument_asset"]: r["refdate"] for r in build("equities_instrument_assets", {"instruments_equities": df}).collect()}
    assert last == {"PETR": D(2026, 7, 24), "T": D(2016, 2, 1), "XONE": D(2016, 2, 1)}
    never = df.withColumn("trading_start_date", F.lit("9999-12-31").cast("date"))
    assert build("equities_spot_market", {"instruments_equities": never}).count() == 0


def futures(spark):
    rows = []
    for k, (front, second) in enumerate(((100.0, 102.0), (101.0, 103.0), (104.0, 106.0))):
        day = D(2024, 1, 8 + k)
        rows += [(day, "WDOG24", "WDO", D(2024, 1, 9), front, None), (day, "WDOH24", "WDO", D(2024, 2, 9), second, None)]
        rows += [(day, "DI1G24", "DI1", D(2024, 2, 10), 99000.0, 0.11), (day, "DI1F25", "DI1", D(2025, 1, 2), 90000.0, 0.10)]
    return spark.createDataFrame(rows, "refdate date, symbol string, commodity string, maturity_date date, adjusted_quote double, adjusted_tax double")


def test_futures(spark):
    i = {"futures": futures(spark)}
    front = sorted((r["refdate"].day, r["ref"]) for r in build("futures_wdo_first_generic", i).collect())
    assert front == [(8, "WDOG24"), (9, "WDOH24"), (10, "WDOH24")]
    adjusted = build("futures_wdo_adjusted", i).orderBy("refdate").collect()
    ratio = 103 / 101
    assert [r["price"] for r in adjusted] == [pytest.approx(100 * ratio), pytest.approx(101 * ratio), pytest.approx(106.0)]
    back = build("futures_wdo_adjusted_returns", {"futures_wdo_adjusted": build("futures_wdo_adjusted", i)}).collect()
    assert len(back) == 2
    wanted = build("futures", {"futures_bd": i["futures"].withColumn("refdate", F.to_date(F.lit("2016-02-29"))), "futures_bvbg": i["futures"].withColumn("refdate", F.to_date(F.lit("2016-02-29")))})
    assert wanted.count() == 12


def test_curves(spark):
    cal = build_calendar(spark, "2023-12-01", "2026-12-31")
    overnight = spark.createDataFrame([(D(2024, 1, 8), "RT", "DI1", 11.65), (D(2023, 12, 5), "RT", "DI1", 11.0)], "refdate date, indicator_group string, symbol string, value double")
    curve = build("curves_di1", {"futures": futures(spark), "economic_indicators": overnight}, calendar=cal)
    rows = [(r["refdate"].day, r["symbol"], r["business_days"]) for r in curve.collect()]
    assert rows[0] == (8, "CDI", 1) and len(rows) == 7
    terms = build("curves_di1_standard", {"curves_di1": curve}, calendar=cal)
    assert terms.count() == 30 and terms.where("symbol = 'DI1T126'").count() == 3
    moved = build("curves_di1_standard_returns", {"curves_di1_standard": terms})
    assert moved.where("returns is null").count() == 10


def test_companies_and_events(spark):
    i = {
        "companies_names": spark.createDataFrame([("9512", "PETROBRAS ", "PETR", D(2024, 1, 1))], "code_cvm string, trading_name string, instrument_asset string, refdate date"),
        "company_details": spark.createDataFrame([("PETR", "PETR4", "BRPETRACNPR6", 9512, "B", D(2024, 1, 1)), ("PETR", "PETR4", "BROLD0ACNPR6", 9512, "B", D(2023, 1, 1)), ("PETR", None, None, 9512, "B", D(2024, 1, 1))], "issuingCompany string, code string, isin string, codeCVM long, market string, refdate date"),
    }
    i["companies_symbols"] = build("companies_symbols", i)
    (row,) = i["companies_symbols"].collect()
    assert (row["symbol"], row["instrument_type"], row["share_class"], row["isin"]) == ("PETR4", "EQUITY", "PN", "BRPETRACNPR6")
    a = [("PETROBRAS", "PN", "DIVIDENDO", D(2024, 1, 3), D(2024, 1, 1), 1.0, 10.0), ("PETROBRAS", "PN", "RENDIMENTO", D(2024, 1, 4), D(2024, 1, 1), 2.0, 10.0)]
    i["cash_dividends"] = spark.createDataFrame(a, "trading_name string, type_stock string, corporate_action string, last_date_prior_ex date, refdate date, value_cash double, closing_price_prior_ex_date double").withColumns({"date_approval": F.lit(None).cast("date"), "ratio": F.lit(1.0), "corporate_action_price": F.lit(0.1)})
    b = [("PETR", "BRPETRACNPR6", "X", "DIVIDENDO", D(2024, 1, 3), D(2024, 1, 1), 1.5), ("PETR", "", "BRPETRACNPR6", "JUROS RF", D(2024, 1, 9), D(2024, 1, 1), 3.0)]
    i["company_cash_dividends"] = spark.createDataFrame(b, "issuingCompany string, assetIssued string, isinCode string, label string, lastDatePrior date, refdate date, rate double").withColumns({"approvedOn": F.lit(None).cast("date"), "paymentDate": F.lit(None).cast("date"), "relatedTo": F.lit("2023")})
    i["cash_dividends_events"] = build("cash_dividends_events", i)
    got = {r["event_type_raw"]: r for r in i["cash_dividends_events"].collect()}
    assert {k: (r["source"], r["value_cash"], r["value_cash_alt"], r["symbol"]) for k, r in got.items()} == {
        "DIVIDENDO": ("both", 1.0, 1.5, "PETR4"), "RENDIMENTO": ("b3-cash-dividends", 2.0, None, "PETR4"), "JUROS RF": ("company-info", 3.0, None, "PETR4"),
    }
    s = [("PETR", "BRPETRACNPR6", "X", "DESDOBRAMENTO", D(2024, 2, 1), D(2024, 1, d), 100.0) for d in (1, 2)]
    i["stock_dividends"] = spark.createDataFrame(s, "issuingCompany string, assetIssued string, isinCode string, label string, lastDatePrior date, refdate date, factor double").withColumn("approvedOn", F.lit(D(2024, 1, 1)))
    i["stock_events"] = build("stock_events", i)
    assert i["stock_events"].count() == 1
    i["subscriptions"] = spark.createDataFrame(s, i["stock_dividends"].drop("approvedOn").schema).drop("factor").withColumns({"approvedOn": F.lit(D(2024, 1, 1)), "priceUnit": F.lit(2.0), "subscriptionDate": F.lit(D(2024, 3, 1)), "label": F.lit("SUBSCRICAO")})
    i["subscription_events"] = build("subscription_events", i)
    found = {r["event_type"]: r["event_family"] for r in build("corporate_events", i).collect()}
    assert found == {"CASH_DIVIDEND": "CASH", "INCOME": "CASH", "INTEREST_FIXED_INCOME": "CASH", "SPLIT": "STOCK", "SUBSCRIPTION": "SUBSCRIPTION"}


def test_other_datasets(spark):
    months = spark.createDataFrame([(30, "IBOV", 2023, *([1.0] + [None] + [3.0] * 10))], "day long, index string, year long, " + ", ".join(f"month{k:02d} double" for k in range(1, 13)))
    assert build("indexes_historical_prices_pivot_longer", {"index_months": months}).count() == 11
    macro = spark.createDataFrame([(D(2024, 1, 2), 4389, 11.0, 1), (D(2024, 1, 2), 4389, 12.0, 2), (D(2024, 1, 2), 7, 1.0, 1)], "refdate date, code long, value double, downloaded_at long")
    assert [tuple(r) for r in build("macro_series", {"macro": macro}).collect()] == [(D(2024, 1, 2), "CDI", 12.0)]
    fwf = spark.createDataFrame([(D(2024, 1, 2), "RT", "DI1", 1165, 2), (D(2024, 1, 2), "??", "Z", 5, 0)], "data_geracao_arquivo date, grupo_indicador string, cod_indicador string, valor_indicador long, num_casas_decimais int")
    assert {(r["symbol"], r["indicator_group_description"], r["value"]) for r in build("economic_indicators", {"economic_indicators_fwf": fwf}).collect()} == {("DI1", "Real-Time Indicators", 11.65), ("Z", "Unknown", 5.0)}
    trades = spark.createDataFrame([(D(2026, 4, 30), "a", 1.0), (D(2026, 5, 1), "a", 9.0)], "refdate date, symbol string, traded_price double")
    new = spark.createDataFrame([(D(2026, 4, 1), "e", 7.0), (D(2026, 5, 1), "e", 2.0)], trades.schema)
    got = build("trades_intraday_consolidated", {"trades": trades, "trades_equities": new, "trades_derivatives": new.limit(0)})
    assert sorted(r["traded_price"] for r in got.collect()) == [1.0, 2.0]
    part = spark.createDataFrame([(D(2024, 1, 2), "A", 0.5)], "refdate date, symbol string, log_return double").withColumn("returns", F.col("log_return"))
    assert build("returns", dict.fromkeys(DS.RETURN_PARTS, part)).count() == 9
    members = spark.createDataFrame([("A", "IBOV, IBXX"), ("B", None)], "symbol string, indexes string")
    assert sorted(str(r["indexes"]) for r in build("indexes_composition_consolidated", {"indexes_composition": members}).collect()) == ["IBOV", "IBXX", "None"]
