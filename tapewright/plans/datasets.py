"""Derived market datasets, each one lazy plan over its inputs.

``DATASETS`` maps a dataset's name to its function; a function takes the input frames by name and, where it
works with business days, a calendar. Nothing is written or collected here: the caller picks the sink.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tapewright.operators import calendar as C
from tapewright.operators import curves as R
from tapewright.operators import symbols as S
from tapewright.operators import timeseries as X
from tapewright.operators import transforms as T
from tapewright.plans.taxonomy import SECTORS, SUBSECTORS, UNCLASSIFIED, UNNAMED

Inputs = Mapping[str, DataFrame]

# fixed values: days on which one source has no rows, and the day from which it is complete
GAP_2016, GAP_2021 = "2016-02-29", "2021-06-10"
FEED_START = "2016-02-01"
INTRADAY_CUT = "2026-04-30"
SHARE_CATEGORIES = (1, 11, 13)
ETF_CATEGORY = 3
SPOT_CATEGORIES = (1, 3, 6, 11, 13, 21)
ASSET_CATEGORIES = (11, 13)
DISCRETE_PRODUCTS, SIMPLE_PRODUCTS = ("DI1", "OC1", "DAP"), ("DDI", "DCO")
OUTRIGHT = "^[A-Z0-9]{3}[FGHJKMNQUVXZ][0-9]{2}$"
STANDARD_TERMS = {"DI1": (21, 42, 63, 126, 252, 378, 504, 756, 1008, 1260), "DAP": (504, 1260)}
MACRO_CODES = {189: "IGPM", 432: "SETA", 433: "IPCA", 1178: "SELIC", 4389: "CDI"}
INDICATOR_GROUPS = {
    "BT": "Bitcoin",
    "BV": "Bovespa Index",
    "DA": "US Dollar / Exchange Rate",
    "DE": "Electric Energy Derivatives",
    "DF": "Financial Derivatives",
    "EI": "Ethanol Indicators",
    "ES": "Euro Stoxx Index",
    "ET": "Ethanol",
    "EU": "Euro",
    "FF": "Fed Funds / International Rates",
    "IA": "Agricultural Indicators",
    "ID": "DI / CDI Index",
    "IF": "Inflation (IPCA / IGP)",
    "IM": "Merval Index (Argentina)",
    "IN": "Nikkei Index (Japan)",
    "IS": "S&P 500 Index",
    "IT": "Interest Rate Index",
    "ME": "Emerging Market Currencies",
    "RA": "Agricultural Commodities",
    "RT": "Real-Time Indicators",
    "SE": "Selic Rate",
    "SO": "Soybean",
    "TI": "International Securities",
    "TO": "Overnight Rate",
    "TX": "Exchange Rates",
    "XF": "Foreign Indices",
}
CASH_EVENTS = {
    "DIVIDENDO": "CASH_DIVIDEND",
    "JRS CAP PROPRIO": "INTEREST_ON_CAPITAL",
    "RENDIMENTO": "INCOME",
    "REST CAP DIN": "CAPITAL_RETURN_CASH",
    "AT MONETARIA": "MONETARY_RESTATEMENT",
    "JUROS RF": "INTEREST_FIXED_INCOME",
    "AMORTIZACAO RF": "AMORTIZATION_FIXED_INCOME",
}
STOCK_EVENTS = {
    "DESDOBRAMENTO": "SPLIT",
    "GRUPAMENTO": "REVERSE_SPLIT",
    "BONIFICACAO": "BONUS_SHARES",
    "CIS RED CAP": "SPINOFF",
    "CIS RED CAP QTD": "SPINOFF",
    "INCORPORACAO": "MERGER",
    "RESG TOTAL RV": "FULL_REDEMPTION",
    "REST CAP ACOES": "CAPITAL_RETURN_SHARES",
    "REST CAP C/ RED": "CAPITAL_RETURN_WITH_REDUCTION",
}
SUBSCRIPTION_EVENTS = {
    "SUBSCRICAO": "SUBSCRIPTION",
    "PRIORIDADE SUBS": "SUBSCRIPTION_PRIORITY",
    "SUBS C/ RENUNC": "SUBSCRIPTION_WITH_WAIVER",
}

OHLC = ("open", "high", "low", "close")


def day(text: str) -> Column:
    return F.lit(text).cast("date")


# ---- companies and their events


def companies_names(i: Inputs) -> DataFrame:
    """The last date of each code, trading name and issuer."""
    rows = i["company_info"].where("codeCVM <> '0'")
    rows = rows.groupBy("codeCVM", "tradingName", "issuingCompany").agg(F.max("refdate").alias("refdate"))
    return rows.select(
        "refdate", F.col("codeCVM").alias("code_cvm"), F.trim("tradingName").alias("trading_name"), F.col("issuingCompany").alias("instrument_asset")
    )


def companies_symbols(i: Inputs) -> DataFrame:
    """One row per ticker of the last snapshot, with what its ISIN says."""
    d = i["company_details"].where("code is not null")
    d = T.latest_per_key(d, ["issuingCompany", "code"], ["-refdate", "isin"])
    kind = S.isin_instrument_type(F.col("isin"))
    named = (
        F.when(kind == "ACN", "EQUITY")
        .when(kind.isin("CDA", "UNT"), "UNIT")
        .when(kind == "BDR", "BDR")
        .when(kind.rlike("^D[A-Z]"), "DEBENTURE")
        .when(kind.rlike("^D[0-9]"), "SUBSCRIPTION_RIGHT")
        .when(kind.rlike("^[RN][0-9]"), "SUBSCRIPTION_RECEIPT")
        .otherwise("OTHER")
    )
    return d.select(
        F.col("code").alias("symbol"),
        "isin",
        F.col("issuingCompany").alias("issuing_company"),
        F.col("codeCVM").cast("string").alias("code_cvm"),
        "market",
        named.alias("instrument_type"),
        F.when(kind == "ACN", S.isin_share_class(F.col("isin"), "null")).alias("share_class"),
    )


def _asset_isin() -> Column:
    return F.coalesce(F.when(F.col("assetIssued") != "", F.col("assetIssued")), F.col("isinCode"))


def _company_codes(i: Inputs) -> DataFrame:
    names = T.latest_per_key(i["companies_names"], ["instrument_asset"], ["-refdate", "code_cvm"])
    return names.select(F.col("instrument_asset").alias("issuing_company"), F.col("code_cvm").cast("string").alias("code_cvm"))


def _symbols_by(i: Inputs, *keys: str) -> DataFrame:
    rows = i["companies_symbols"].na.drop(subset=[keys[-1]])
    return T.distinct_on(rows, list(keys), ["symbol"]).select(*keys, "symbol")


def _company_event(i: Inputs, rows: DataFrame, keys: Sequence[str], class_variant: str, extra: Sequence[Column]) -> DataFrame:
    """The last snapshot of each event with its share class, company code and ticker."""
    rows = rows.withColumn("asset_isin", _asset_isin())
    rest = [c for c in rows.columns if c not in keys]
    rows = T.latest_per_key(rows, keys, ["-refdate", *sorted(c for c in rest if c != "refdate")])
    rows = rows.withColumnRenamed("issuingCompany", "issuing_company").join(_company_codes(i), "issuing_company", "left")
    symbols = _symbols_by(i, "isin").withColumnRenamed("isin", "asset_isin")
    return rows.join(symbols, "asset_isin", "left").select(
        "code_cvm",
        "issuing_company",
        "symbol",
        "asset_isin",
        S.isin_share_class(F.col("asset_isin"), class_variant).alias("share_class"),
        F.col("label").alias("event_type_raw"),
        F.col("approvedOn").alias("approved_on"),
        F.col("lastDatePrior").alias("ex_date"),
        F.col("isinCode").alias("isin"),
        *extra,
    )


def stock_events(i: Inputs) -> DataFrame:
    """Splits, bonuses and the like."""
    keys = ["issuingCompany", "asset_isin", "label", "lastDatePrior", "approvedOn", "factor"]
    return _company_event(i, i["stock_dividends"], keys, "plain", [F.col("factor")])


def subscription_events(i: Inputs) -> DataFrame:
    keys = ["issuingCompany", "asset_isin", "label", "lastDatePrior", "approvedOn"]
    extra = [F.col("priceUnit").alias("subscription_price"), F.col("subscriptionDate").alias("subscription_date")]
    return _company_event(i, i["subscriptions"], keys, "plain", extra)


def cash_dividends_events(i: Inputs) -> DataFrame:
    """Cash events of two sources made one: a row per company, share class, label and ex-date."""
    keys = ["issuing_company", "share_class", "event_type_raw", "ex_date"]
    a = i["cash_dividends"].withColumnsRenamed({"corporate_action": "event_type_raw", "last_date_prior_ex": "ex_date"})
    a = T.latest_per_key(a, ["trading_name", "type_stock", "event_type_raw", "ex_date"], ["-refdate", "value_cash"])
    names = i["companies_names"].withColumn("trading_name", F.trim("trading_name"))
    names = T.latest_per_key(names, ["trading_name"], ["-refdate", "code_cvm"])
    names = names.select("trading_name", F.col("code_cvm").cast("string").alias("code_cvm"), F.col("instrument_asset").alias("issuing_company"))
    a = a.withColumns({"trading_name": F.trim("trading_name"), "share_class": F.upper("type_stock")}).join(names, "trading_name", "left")
    a = a.join(_symbols_by(i, "issuing_company", "share_class"), ["issuing_company", "share_class"], "left")
    a = T.distinct_on(a, keys, ["-value_cash", "symbol"]).select(
        *keys, "code_cvm", "symbol", F.col("date_approval").alias("approved_on"), "value_cash", "ratio",
        F.col("corporate_action_price").alias("yield_pct"), F.col("closing_price_prior_ex_date").alias("prior_ex_close"), F.lit(True).alias("in_a"),
    )
    extra = [F.col("paymentDate").alias("payment_date"), F.col("rate").alias("value_cash"), F.col("relatedTo").alias("related_to")]
    b = _company_event(i, i["company_cash_dividends"], ["issuingCompany", "asset_isin", "label", "lastDatePrior"], "UNT", extra)
    b = T.distinct_on(b, keys, ["-value_cash", "asset_isin"]).withColumn("in_b", F.lit(True))
    b = b.withColumnsRenamed({c: f"b_{c}" for c in ("code_cvm", "symbol", "approved_on", "value_cash")})
    met = a.join(b, keys, "full_outer")
    both = F.col("in_a") & F.col("in_b")
    differs = both & (F.round("value_cash", 6) != F.round("b_value_cash", 6))
    return met.select(
        F.coalesce("code_cvm", "b_code_cvm").alias("code_cvm"), "issuing_company", F.coalesce("symbol", "b_symbol").alias("symbol"), "asset_isin",
        "share_class", "event_type_raw", "ex_date", F.coalesce("approved_on", "b_approved_on").alias("approved_on"), "payment_date",
        F.coalesce("value_cash", "b_value_cash").alias("value_cash"), F.when(differs, F.col("b_value_cash")).alias("value_cash_alt"),
        "ratio", "yield_pct", "prior_ex_close", "related_to", "isin",
        F.when(both, "both").when(F.col("in_a"), "b3-cash-dividends").otherwise("company-info").alias("source"),
    )


def corporate_events(i: Inputs) -> DataFrame:
    """The three families of events with one vocabulary; columns that a family lacks are null."""
    families = (
        ("CASH", "cash_dividends_events", CASH_EVENTS),
        ("STOCK", "stock_events", STOCK_EVENTS),
        ("SUBSCRIPTION", "subscription_events", SUBSCRIPTION_EVENTS),
    )
    parts = []
    for family, name, labels in families:
        rows = T.case_map(i[name].withColumn("event_family", F.lit(family)), "event_type_raw", labels, "event_type", "OTHER")
        parts.append(T.add_column(rows, "source", "company-info", only_if_missing=True))
    return T.union_aligned(parts)


# fixed values: columns of the details and of the capital of a company, and what they are called
DETAILS = {
    "issuingCompany": "issuing_company", "cnpj": "cnpj", "industryClassification": "industry_classification",
    "industryClassificationEng": "industry_classification_eng", "activity": "activity", "website": "website", "status": "status",
    "market": "market", "marketIndicator": "market_indicator", "institutionCommon": "institution_common",
    "institutionPreferred": "institution_preferred", "hasQuotation": "has_quotation", "hasEmissions": "has_emissions",
    "hasBDR": "has_bdr", "typeBDR": "type_bdr", "describleCategoryBVMF": "describe_category_bvmf",
}
CAPITAL = {
    "segment": "listing_segment", "stockCapital": "stock_capital", "quotedPerSharSince": "quoted_per_shar_since",
    "commonSharesForm": "common_shares_form", "preferredSharesForm": "preferred_shares_form", "hasCommom": "has_common",
    "hasPreferred": "has_preferred", "roundLot": "round_lot", "numberCommonShares": "number_common_shares",
    "numberPreferredShares": "number_preferred_shares", "totalNumberShares": "total_number_shares",
}


def _last_of(rows: DataFrame, key: str) -> DataFrame:
    """A row per key: that of the last date, of equal dates the least by all other columns."""
    rest = sorted(c for c in rows.columns if c not in (key, "refdate"))
    return T.latest_per_key(rows, [key], ["-refdate", *rest])


def companies(i: Inputs) -> DataFrame:
    """The company master: companies registered for the exchange with the last details and capital that are known of them.

    A column that a source lacks is null. The level of listing is ``listing_segment``, as ``segment`` is the last level of the sector.
    """
    registered = _last_of(i["cvm_registration"].where("tp_merc = 'BOLSA'"), "cnpj_cia").select(
        F.col("code_cvm").cast("string").alias("code_cvm"), F.col("denom_social").alias("__name"), F.col("denom_comerc").alias("__trading"),
        F.col("sit").alias("company_status"), F.col("cnpj_cia").alias("cvm_cnpj"),
    )
    details = _last_of(i["company_details"].withColumn("code_cvm", F.col("codeCVM").cast("string")), "code_cvm")
    known = [F.col("code_cvm"), _or_null(details, "companyName").alias("__own_name"), _or_null(details, "tradingName").alias("__own_trading")]
    details = details.select(*known, *[_or_null(details, c).alias(n) for c, n in DETAILS.items()])
    capital = _last_of(i["company_info"].where("issuingCompany is not null"), "issuingCompany")
    capital = capital.select(
        F.col("issuingCompany").alias("issuing_company"), _or_null(capital, "tradingName").alias("__listed_trading"),
        *[_or_null(capital, c).alias(n) for c, n in CAPITAL.items()],
    )
    met = registered.join(details, "code_cvm", "left").join(capital, "issuing_company", "left")
    levels = F.split("industry_classification", "/")
    level = {name: F.when(F.col("industry_classification").isNotNull(), F.coalesce(F.trim(F.get(levels, k)), F.lit(""))) for k, name in enumerate(("sector", "subsector", "segment"))}
    first = ("issuing_company", "company_status", "cnpj", "cvm_cnpj", "industry_classification", "industry_classification_eng")
    return met.select(
        "code_cvm", F.coalesce("__own_name", "__name").alias("company_name"), F.coalesce("__listed_trading", "__own_trading", "__trading").alias("trading_name"),
        *first, *[c.alias(n) for n, c in level.items()], *[n for n in DETAILS.values() if n not in first], *CAPITAL.values(),
    )


def _or_null(df: DataFrame, column: str) -> Column:
    return F.col(column) if column in df.columns else F.lit(None).cast("string")


def industry_sectors(i: Inputs, taxonomy: Mapping[str, Sequence[str]] = SECTORS, subsectors: Mapping[str, Mapping[str, str]] = SUBSECTORS) -> DataFrame:
    """Distinct pairs of sector and subsector with their names in other taxonomies; companies without a sector are left out."""
    pairs = i["companies"].select(F.trim("sector").alias("sector"), F.trim("subsector").alias("subsector")).where("sector <> ''").distinct()
    spark = pairs.sparkSession
    names = spark.createDataFrame([(s, *n) for s, n in taxonomy.items()], "sector string, gics_sector string, icb_sector string, normalized_sector string")
    lower = spark.createDataFrame([(s, k, n) for s, own in subsectors.items() for k, n in own.items()], "sector string, subsector string, normalized_subsector string")
    met = pairs.join(F.broadcast(names), "sector", "left").join(F.broadcast(lower), ["sector", "subsector"], "left")
    met = met.na.fill(UNCLASSIFIED, list(names.columns[1:])).na.fill(UNNAMED, ["normalized_subsector"])
    return met.select("sector", "subsector", *names.columns[1:], "normalized_subsector")


# ---- equities


def cotahist(i: Inputs) -> DataFrame:
    return T.sort(T.concat_datasets([i["cotahist_yearly"], i["cotahist_daily"]]), ["refdate", "symbol"])


def equities_register(i: Inputs) -> DataFrame:
    return i["instruments_equities"]


NEVER = "9999-12-31"  # the start of trading of what is registered only


def _spot(register: DataFrame, categories: Sequence[int]) -> DataFrame:
    """Registered instruments of the spot market that trade."""
    kept = (F.col("instrument_market") == 10) & (F.col("instrument_segment") == 1) & (F.col("instrument_asset") != "TAXA")
    if "trading_start_date" in register.columns:
        kept = kept & (F.col("trading_start_date") != day(NEVER))
    return register.where(kept & F.col("security_category").isin(*categories))


def equities_spot_market(i: Inputs) -> DataFrame:
    """The tradable universe: spot market, no test instruments."""
    name = F.col("corporation_name")
    return _spot(i["instruments_equities"], SPOT_CATEGORIES).where(~name.ilike("%TESTE%") & (name != "XX"))


def equities_instrument_assets(i: Inputs) -> DataFrame:
    """The last date of each asset that has shares or units on the spot market."""
    return _spot(i["instruments_equities"], ASSET_CATEGORIES).groupBy("instrument_asset").agg(F.max("refdate").alias("refdate"))


def equities_unadjusted_prices(i: Inputs) -> DataFrame:
    """Prices of the universe's symbols, each day from one of three sources; older ones guarded by the ISIN."""
    universe = i["equities_spot_market"].select("symbol", "isin").distinct()
    register = i["instruments_equities"]
    spot = (F.col("instrument_market") == 10) & (F.col("instrument_segment") == 1) & (F.col("instrument_asset") != "TAXA")
    register = register.where(spot & F.col("security_category").isin(*SPOT_CATEGORIES))
    register = register.groupBy("refdate", "symbol").agg(F.max("distribution_id").alias("distribution_id"))
    columns = ["refdate", "symbol", "trade_quantity", "traded_contracts", "volume", "open", "low", "high", "close", "average", "distribution_id"]
    daily = i["price_reports"].join(universe.select("symbol").distinct(), "symbol", "left_semi")
    daily = daily.join(register, ["refdate", "symbol"], "left").withColumnRenamed("traded_quantity", "trade_quantity")
    history = i["cotahist"].join(universe, ["symbol", "isin"], "left_semi")
    bulletin = i["bulletin_stocks"].where("cod_bdi = 2").select(
        F.col("refdate").cast("date").alias("refdate"), F.col("cod_negociacao").alias("symbol"), F.col("cod_isin").alias("isin"),
        F.col("qtd_negocios").alias("trade_quantity"), F.col("qtd_titulos_negociados").alias("traded_contracts"),
        F.col("volume_titulos_negociados").alias("volume"), F.col("preco_abertura").alias("open"), F.col("preco_min").alias("low"),
        F.col("preco_max").alias("high"), F.col("preco_ult").alias("close"), F.col("preco_med").alias("average"),
        F.col("num_dist").cast("long").alias("distribution_id"),
    )
    bulletin = bulletin.join(universe, ["symbol", "isin"], "left_semi")
    at = F.col("refdate")
    branches = [
        (daily, F.lit(True)),
        (history, at == day(GAP_2021)),
        (bulletin, at == day(GAP_2016)),
        (history, (at < day(FEED_START)) & (F.col("instrument_market") == 10)),
    ]
    return T.sort(T.concat_datasets([df.where(p).select(*columns) for df, p in branches]), ["refdate", "symbol"])


def _universe(i: Inputs, *categories: int) -> DataFrame:
    return i["equities_spot_market"].where(F.col("security_category").isin(*categories)).select("symbol").distinct()


def equities_returns(i: Inputs) -> DataFrame:
    """Returns from the daily oscillation, with the two gap days from other sources."""
    symbols = _universe(i, *SHARE_CATEGORIES)
    columns = ["refdate", "symbol", "pct_return", "log_return"]
    daily = X.returns_from_oscillation(i["price_reports"].join(symbols, "symbol", "left_semi"), "oscillation").select(*columns)
    # the day before the gap is the other day of the pair; a symbol counts if it has both and no distribution between them
    pair = i["cotahist"].join(symbols, "symbol", "left_semi").where(F.col("refdate").isin(day("2021-06-09"), day(GAP_2021)))
    series = Window.partitionBy("symbol").orderBy("refdate")
    pair = pair.withColumns({"n": F.count("*").over(Window.partitionBy("symbol")), "moved": F.col("distribution_id") - F.lag("distribution_id").over(series)})
    patched = X.simple_log_returns(pair, "close", ["symbol"], "refdate").where("n = 2 and moved = 0").select(*columns)
    old = i["bulletin_stocks"].withColumnRenamed("cod_negociacao", "symbol").join(symbols, "symbol", "left_semi")
    old = old.where((F.col("refdate") == day(GAP_2016)) & (F.col("cod_bdi") == 2) & F.col("sinal_oscilacao_preco").isin("+", "-", "=") & (F.col("preco_ult") > 0))
    old = X.returns_from_oscillation(old, "oscilacao_preco", "sinal_oscilacao_preco").select(*columns)
    return T.sort(T.concat_datasets([patched, daily, old]), ["refdate", "symbol"])


def equities_etfs_returns(i: Inputs) -> DataFrame:
    """Close ratios up to 2017 and on the gap day, then oscillations."""
    symbols = _universe(i, ETF_CATEGORY)
    columns = ["refdate", "symbol", "pct_return", "log_return"]
    old = X.simple_log_returns(i["cotahist"].join(symbols, "symbol", "left_semi"), "close", ["symbol"], "refdate")
    old = old.where((F.col("refdate") < day("2018-01-01")) | (F.col("refdate") == day(GAP_2021))).where("pct_return is not null")
    new = X.returns_from_oscillation(i["price_reports"].join(symbols, "symbol", "left_semi"), "oscillation")
    return T.sort(T.concat_datasets([old.select(*columns), new.select(*columns)]), ["refdate", "symbol"])


def equities_symbol_changes(i: Inputs) -> DataFrame:
    spot = i["cotahist"].where("instrument_market = 10")
    found = S.symbol_changes(spot, i["equities_returns"])
    return found.select(
        F.col("old_symbol").alias("src_symbol"),
        F.col("new_symbol").alias("dest_symbol"),
        "change_date",
        F.col("last_close").alias("src_last_close"),
        F.col("first_close").alias("dest_first_close"),
        "close_change_pct",
        "ret_match",
        "isin_class",
        F.col("old_share_class").alias("src_share_class"),
        F.col("new_share_class").alias("dest_share_class"),
        F.col("old_isin").alias("src_isin"),
        F.col("new_isin").alias("dest_isin"),
        F.col("old_corporation_name").alias("corporation_name_src"),
        F.col("new_corporation_name").alias("corporation_name_dest"),
    )


def _renames(i: Inputs) -> DataFrame:
    return i["equities_symbol_changes"].select(F.col("src_symbol").alias("old_symbol"), F.col("dest_symbol").alias("new_symbol"))


def equities_symbol_spans_analysis(i: Inputs) -> DataFrame:
    return S.symbol_spans(i["equities_unadjusted_prices"], changes=_renames(i))


def equities_returns_symbols_changes(i: Inputs) -> DataFrame:
    """The history of renamed symbols under their last names; only what was renamed."""
    old = _renames(i).select(F.col("old_symbol").alias("symbol"))
    return S.relabel_returns(i["equities_returns"].join(old, "symbol", "left_semi"), _renames(i))


def adjusted_prices(i: Inputs, prices: str, returns: str, alive: bool = False, filled: bool = False, calendar: DataFrame | None = None) -> DataFrame:
    """The days of the returns with the prices of the reports, adjusted backwards; if ``filled`` also on the calendar's business days.

    A day without a price keeps its return, which counts for all older days; a price on a day without a return is left out.
    With ``alive`` only symbols that have a return on the reports' last date.
    """
    if filled and calendar is None:
        raise ValueError("filled prices need a calendar")
    r, quotes = i[returns], i[prices].withColumnsRenamed(REPORTED)
    if alive:
        last = quotes.agg(F.max("refdate").alias("refdate"))
        r = r.join(r.join(F.broadcast(last), "refdate", "left_semi").select("symbol").distinct(), "symbol", "left_semi")
    r = r.select("refdate", "symbol", F.col("log_return").alias("returns"))
    met = r.join(quotes.select("refdate", "symbol", *OHLC), ["refdate", "symbol"], "left")
    return X.adjust_prices(met, calendar=calendar, fill_calendar_gaps=filled).select("refdate", "symbol", *OHLC)


# fixed values: prices of the index reports by their names there
REPORTED = {"open_price": "open", "max_price": "high", "min_price": "low", "close_price": "close", "oscillation_val": "oscillation"}


def listed_funds_consolidated(i: Inputs) -> DataFrame:
    return T.apply_expression(i["listed_funds"], "acronym", "x || '11'", "symbol")


# ---- futures and curves


def futures_bd(i: Inputs) -> DataFrame:
    """Outright futures of the old bulletin; zeros are no values, rates come from settlement prices."""
    b = i["derivatives_daily"].withColumn("symbol", F.trim("cod_gts"))
    b = b.where((F.col("cod_mercado") == "2") & (F.col("data_geracao_arquivo") >= day("2006-05-22")) & F.col("symbol").rlike(OUTRIGHT))
    price = {"open": "cot_primeiro_negocio", "high": "cot_maior_negocio", "low": "cot_menor_negocio", "close": "cot_ult_negocio", "average": "cot_med_negocios", "adjusted_quote": "cot_ajuste"}
    rate = R.rate_from_settlement(F.col("cod_mercadoria"), F.col("cot_ajuste"), F.col("num_dias_saques"), F.col("num_dias_corridos"), DISCRETE_PRODUCTS, SIMPLE_PRODUCTS)
    return b.select(
        F.col("data_geracao_arquivo").alias("refdate"), "symbol", F.col("cod_mercadoria").alias("commodity"), F.substring("symbol", 4, 10).alias("expiration_code"),
        F.col("data_vencimento").alias("maturity_date"), F.col("tamanho_contr").alias("contract_multiplier"),
        *[F.nullif(F.col(c), F.lit(0)).alias(n) for n, c in price.items()], rate.alias("adjusted_tax"), F.col("valor_ajuste_contr").alias("adjusted_value_contract"),
        F.col("qtd_contr").alias("traded_contracts"), F.col("volume_real").alias("volume"), F.col("qtd_contr_aberto").alias("open_interest"),
    )


def futures_bvbg(i: Inputs) -> DataFrame:
    """Registered contracts with the most liquid of their price rows."""
    order = [F.col(c).desc_nulls_last() for c in ("traded_contracts", "volume", "adjusted_quote", "open_interest")]
    best = T.first_rows(i["price_reports"], ["refdate", "symbol"], order)
    best = best.withColumn("adjusted_tax", F.col("adjusted_tax") / 100)
    contracts = i["instruments_futures"].select("refdate", "symbol", F.col("instrument_asset").alias("commodity"), "expiration_code", "maturity_date", "contract_multiplier")
    return contracts.join(best, ["refdate", "symbol"])


def futures(i: Inputs) -> DataFrame:
    """The canonical series: the old bulletin to the cut and on the gap day, the reports otherwise."""
    at = F.col("refdate")
    old = (at < day(FEED_START)) | (at == day(GAP_2016))
    columns = [c for c in i["futures_bd"].columns if c in i["futures_bvbg"].columns]
    return T.union_cutover([(i["futures_bd"].select(*columns), old), (i["futures_bvbg"].select(*columns), ~old)])


def first_generic(i: Inputs, commodity: str, symbol: str, min_bizdays: int | None = None, calendar: DataFrame | None = None) -> DataFrame:
    f = i["futures"].where(F.col("commodity") == commodity).select("refdate", F.lit(symbol).alias("generic"), F.col("symbol").alias("ref"), "maturity_date", "adjusted_quote", "adjusted_tax")
    return X.front_contract(f, ["generic"], "refdate", "maturity_date", min_bizdays, calendar).withColumnRenamed("generic", "symbol")


def futures_register(i: Inputs) -> DataFrame:
    return T.filter_latest_date(i["instruments_futures"])


def copied(i: Inputs, name: str) -> DataFrame:
    """The same rows; what changes is the layer and the partitions they are written to."""
    return i[name]


def futures_adjusted(i: Inputs, commodity: str) -> DataFrame:
    f = i["futures"].where(F.col("commodity") == commodity).withColumn("symbol", F.lit(f"{commodity}ADJ"))
    return X.continuous_future(f, "symbol", "refdate", "maturity_date", "adjusted_quote")


def price_returns(i: Inputs, name: str, price: str) -> DataFrame:
    return X.simple_log_returns(i[name], price, ["symbol"], "refdate").select("refdate", "symbol", "pct_return", "log_return")


def curve(i: Inputs, product: str, calendar: DataFrame, overnight: bool) -> DataFrame:
    """Vertices of a product's futures; with the overnight rate on days that have any."""
    f = i["futures"].where((F.col("commodity") == product) & (F.col("maturity_date") > F.col("refdate")) & F.col("adjusted_tax").isNotNull())
    f = f.select("refdate", "symbol", F.col("maturity_date").alias("maturity_date_raw"), "adjusted_tax")
    if overnight:
        n = i["economic_indicators"].where("indicator_group = 'RT' and symbol = 'DI1' and value is not null")
        n = n.join(f.select("refdate").distinct(), "refdate", "left_semi")
        n = n.select("refdate", F.lit("CDI").alias("symbol"), F.date_add("refdate", 1).alias("maturity_date_raw"), (F.col("value") / 100).alias("adjusted_tax")).distinct()
        f = f.unionByName(n)
    f = C.following_bizday(f, calendar, "maturity_date_raw", "maturity_date")
    f = C.bizdays_between(f, calendar, "refdate", "maturity_date", "business_days")
    return T.sort(f, ["refdate", "maturity_date"])


def curve_standard(i: Inputs, name: str, product: str, calendar: DataFrame) -> DataFrame:
    return R.standard_terms(i[name], calendar, STANDARD_TERMS[product], f"{product}T")


def curve_standard_returns(i: Inputs, name: str) -> DataFrame:
    return X.lag_diff(i[name], "adjusted_tax", ["symbol"], "refdate", "returns").select("refdate", "symbol", "returns")


# ---- indexes


def _alive_indexes(i: Inputs) -> DataFrame:
    return T.filter_latest_date(i["index_reports"]).select("symbol").distinct()


def indexes_prices(i: Inputs) -> DataFrame:
    """Prices of the indexes that exist at the last date."""
    return i["index_reports"].withColumnsRenamed(REPORTED).join(_alive_indexes(i), "symbol", "left_semi").select("refdate", "symbol", *OHLC)


def indexes_returns(i: Inputs) -> DataFrame:
    return X.returns_from_oscillation(i["index_reports"].withColumnsRenamed(REPORTED), "oscillation").select("refdate", "symbol", "pct_return", "log_return")


def indexes_composition_consolidated(i: Inputs) -> DataFrame:
    """One row per stock and index."""
    return T.flatten_columns(i["indexes_composition"], ["indexes"], ",")


def indexes_historical_prices(i: Inputs) -> DataFrame:
    """Twelve month columns as dated rows."""
    months = [f"month{k:02d}" for k in range(1, 13)]
    long = T.melt(i["index_months"], ["index", "day", "year"], months, "month", "value")
    long = T.cast_columns(T.str_replace(long, "month", "month", ""), ["month"], "int")
    long = T.rename_columns(T.make_date(long, "year", "month", "day", "refdate"), {"index": "symbol"})
    return T.sort(T.drop_na(T.select_columns(long, ["symbol", "refdate", "value"]), ["value"]), "refdate")


# ---- other markets and unions


def trades_intraday_consolidated(i: Inputs) -> DataFrame:
    """Three feeds, each day from one generation of them."""
    at = F.col("refdate")
    new = at > day(INTRADAY_CUT)
    return T.union_cutover([(i["trades"], at <= day(INTRADAY_CUT)), (i["trades_equities"], new), (i["trades_derivatives"], new)])


def economic_indicators(i: Inputs) -> DataFrame:
    e = i["economic_indicators_fwf"].withColumnsRenamed({"data_geracao_arquivo": "refdate", "grupo_indicador": "indicator_group", "cod_indicador": "symbol"})
    e = T.case_map(e, "indicator_group", INDICATOR_GROUPS, "indicator_group_description", "Unknown")
    e = T.scale_and_sign(e, ["valor_indicador"], "num_casas_decimais").withColumnRenamed("valor_indicador", "value")
    return e.select("refdate", "indicator_group", "symbol", "indicator_group_description", "value")


def macro_series(i: Inputs) -> DataFrame:
    """The last download of each series and date."""
    s = i["macro"].where(F.col("code").isin(*MACRO_CODES))
    s = T.latest_per_key(s, ["refdate", "code"], ["-downloaded_at", "value"])
    return T.case_map(s, "code", MACRO_CODES, "symbol").select("refdate", "symbol", "value")


def currency_candles(i: Inputs) -> DataFrame:
    """Daily candles of the bulletins' quotes against the dollar, the dollar's own as BRLUSD.

    The dollar's quote is its ask, any other currency's its parity. The dollar, and currencies that never have an ask,
    are inverted. Of bulletins that were fetched again the last download counts.
    """
    b = i["fx_bulletins"].withColumnRenamed("refdate", "ts")
    asked = b.groupBy(F.col("currency").alias("of")).agg((F.count("ask") == 0).alias("indirect"))  # a row a currency
    b = T.latest_per_key(b, ["currency", "ts", "bulletin_type"], ["-downloaded_at", "ask", "parity_ask"])
    dollar = F.col("currency") == "USD"
    b = b.join(F.broadcast(asked), F.col("currency") == F.col("of")).withColumn("quote", F.when(dollar, F.col("ask")).otherwise(F.col("parity_ask")))
    found = X.ohlc_candles(b, "currency", "ts", "quote", "bulletin_type", dollar | F.col("indirect"))
    symbol = F.when(dollar, "BRLUSD").otherwise(F.concat("currency", F.lit("USD")))
    return found.select("refdate", symbol.alias("symbol"), *OHLC)


def long_union(i: Inputs, parts: Mapping[str, str], value: str) -> DataFrame:
    """refdate, symbol and one value of many datasets, each under its own column."""
    return T.concat_datasets([i[name].select("refdate", "symbol", F.col(column).cast("double").alias(value)) for name, column in parts.items()])


def ohlc_union(i: Inputs, parts: Sequence[str]) -> DataFrame:
    return T.concat_datasets([i[name].select("refdate", "symbol", *OHLC) for name in parts])


RETURN_PARTS = {
    "equities_returns": "log_return",
    "indexes_returns": "log_return",
    "equities_etfs_returns": "log_return",
    "equities_returns_symbols_changes": "log_return",
    "curves_di1_standard_returns": "returns",
    "curves_dap_standard_returns": "returns",
    "currencies_returns": "log_return",
    "futures_win_adjusted_returns": "log_return",
    "futures_wdo_adjusted_returns": "log_return",
}
PRICE_PARTS = {
    "equities_adjusted_prices": "close",
    "indexes_adjusted_prices": "close",
    "currency_consolidated": "close",
    "futures_win_adjusted": "price",
    "futures_wdo_adjusted": "price",
}
OHLC_PARTS = ("equities_adjusted_prices", "indexes_adjusted_prices", "currency_consolidated")

# name -> function of the inputs; those that need a calendar or a table take it as a keyword
DATASETS: dict[str, Callable[..., DataFrame]] = {
    "cash_dividends_events": cash_dividends_events,
    "companies_names": companies_names,
    "companies_symbols": companies_symbols,
    "stock_events": stock_events,
    "subscription_events": subscription_events,
    "curves_di1": partial(curve, product="DI1", overnight=True),
    "curves_dap": partial(curve, product="DAP", overnight=False),
    "curves_di1_standard": partial(curve_standard, name="curves_di1", product="DI1"),
    "curves_dap_standard": partial(curve_standard, name="curves_dap", product="DAP"),
    "curves_di1_standard_returns": partial(curve_standard_returns, name="curves_di1_standard"),
    "curves_dap_standard_returns": partial(curve_standard_returns, name="curves_dap_standard"),
    "cotahist": cotahist,
    "equities_adjusted_prices": partial(adjusted_prices, prices="price_reports", returns="equities_returns"),
    "equities_adjusted_prices_filled": partial(adjusted_prices, prices="price_reports", returns="equities_returns", filled=True),
    "equities_etfs_returns": equities_etfs_returns,
    "equities_instrument_assets": equities_instrument_assets,
    "equities_register": equities_register,
    "equities_spot_market": equities_spot_market,
    "equities_returns": equities_returns,
    "equities_returns_symbols_changes": equities_returns_symbols_changes,
    "equities_symbol_changes": equities_symbol_changes,
    "equities_symbol_spans_analysis": equities_symbol_spans_analysis,
    "equities_unadjusted_prices": equities_unadjusted_prices,
    "listed_funds_consolidated": listed_funds_consolidated,
    "futures_bd": futures_bd,
    "futures_bvbg": futures_bvbg,
    "futures": futures,
    **{f"futures_{c.lower()}_first_generic": partial(first_generic, commodity=c, symbol=f"{c}T01") for c in ("DAP", "DOL", "IND", "WDO", "WIN")},
    "futures_ddi_first_generic": partial(first_generic, commodity="DDI", symbol="DDIT01", min_bizdays=2),
    "futures_register": futures_register,
    "futures_settlement_prices_consolidated": partial(copied, name="futures_settlement_prices"),
    "futures_wdo_adjusted": partial(futures_adjusted, commodity="WDO"),
    "futures_win_adjusted": partial(futures_adjusted, commodity="WIN"),
    "futures_wdo_adjusted_returns": partial(price_returns, name="futures_wdo_adjusted", price="price"),
    "futures_win_adjusted_returns": partial(price_returns, name="futures_win_adjusted", price="price"),
    "indexes_prices": indexes_prices,
    "indexes_adjusted_prices": partial(adjusted_prices, prices="index_reports", returns="indexes_returns", alive=True),
    "indexes_adjusted_prices_filled": partial(adjusted_prices, prices="index_reports", returns="indexes_returns", alive=True, filled=True),
    "indexes_composition_consolidated": indexes_composition_consolidated,
    "indexes_current_portfolio_consolidated": partial(copied, name="indexes_current_portfolio"),
    "indexes_theoretical_portfolio_consolidated": partial(copied, name="indexes_theoretical_portfolio"),
    "indexes_historical_prices_pivot_longer": indexes_historical_prices,
    "indexes_returns": indexes_returns,
    "trades_intraday_consolidated": trades_intraday_consolidated,
    "economic_indicators": economic_indicators,
    "currencies_returns": partial(price_returns, name="currency_consolidated", price="close"),
    "currency_consolidated": currency_candles,
    "macro_series": macro_series,
    "companies": companies,
    "corporate_events": corporate_events,
    "industry_sectors": industry_sectors,
    "prices": partial(long_union, parts=PRICE_PARTS, value="price"),
    "ohlc_prices": partial(ohlc_union, parts=OHLC_PARTS),
    "returns": partial(long_union, parts=RETURN_PARTS, value="returns"),
}
