"""Questions to a set of datasets: SQL over views, wide returns and prices, symbol lists."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.operators.transforms import distinct_on, filter_latest_date, pivot_wide, unique_series


def register_view(df: DataFrame, name: str) -> None:
    """A view "layer.dataset" that SQL can name with backticks around the whole."""
    df.createOrReplaceTempView(f"`{name}`")


def sql(spark: SparkSession, text: str, datasets: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """SQL over registered views; ``datasets`` are registered first."""
    if not text or not text.strip():
        raise ValueError("an empty query")
    for name, df in (datasets or {}).items():
        register_view(df, name)
    return spark.sql(text)


def sql_query(spark: SparkSession, text: str, datasets: Mapping[str, DataFrame]) -> DataFrame:
    """The query as a step: it needs named datasets."""
    if not datasets:
        raise ValueError("no datasets")
    return sql(spark, text, datasets)


def _range(start: Any, end: Any) -> tuple[str, str]:
    start, end = str(start or "2000-01-01"), str(end or datetime.date.today())
    if start > end:
        raise ValueError(f"start {start} is after end {end}")
    return start, end


def reindex_calendar(wide: DataFrame, cal: DataFrame, index: str = "refdate") -> DataFrame:
    """One row a business day between the first and last row; other days go."""
    ends = wide.agg(F.min(index).alias("__a"), F.max(index).alias("__b"))
    days = cal.where("is_bizday").select(F.col("cal_date").alias(index)).crossJoin(F.broadcast(ends))
    days = days.where(F.col(index).between(F.col("__a"), F.col("__b"))).select(index)
    return days.join(wide, index, "left").select(*wide.columns)


def _wide(df: DataFrame, symbols: str | Sequence[str], start: Any, end: Any, calendar: DataFrame | None, columns: str | Sequence[str]) -> DataFrame:
    symbols = [symbols] if isinstance(symbols, str) else list(symbols)
    start, end = _range(start, end)
    inside = df.where(F.col("symbol").isin(*symbols) & F.col("refdate").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    wide = pivot_wide(unique_series(inside, ["refdate", "symbol"]), "refdate", "symbol", columns, symbols, check=False)
    return reindex_calendar(wide, calendar) if calendar is not None else wide


def get_returns(returns: DataFrame, symbols: str | Sequence[str], start: Any = None, end: Any = None, calendar: DataFrame | None = None, column: str = "returns") -> DataFrame:
    """refdate and one column per symbol; unknown symbols give no rows, repeated days an error."""
    return _wide(returns, symbols, start, end, calendar, column)


def get_prices(prices: DataFrame, symbols: str | Sequence[str], start: Any = None, end: Any = None, calendar: DataFrame | None = None, columns: str | Sequence[str] = "close") -> DataFrame:
    """As get_returns; several columns are named column_symbol."""
    return _wide(prices, symbols, start, end, calendar, columns)


# kinds of symbols: the dataset and column that lists them, a filter, and whether only its last date counts
SYMBOL_KINDS = {
    "etf": ("listed_funds", "symbol", "fund_type = 'ETF'", True),
    "fii": ("listed_funds", "symbol", "fund_type = 'FII'", True),
    "fixed-income-etf": ("listed_funds", "symbol", "fund_type = 'Fixed Income ETF'", True),
    "fietf": ("listed_funds", "symbol", "fund_type = 'Fixed Income ETF'", True),
    "index": ("index_members", "index", "true", True),
    "company": ("instrument_assets", "instrument_asset", "true", False),
    "company-trading-name": ("companies_names", "trading_name", "true", False),
    "company-cvm-code": ("companies_names", "code_cvm", "true", False),
    "industry-sector": ("symbol_properties", "sector", "true", False),
    "industry-subsector": ("symbol_properties", "subsector", "true", False),
    "industry-segment": ("symbol_properties", "segment", "true", False),
    "equity": ("symbol_properties", "symbol", "true", False),
}


def symbol_properties(companies_symbols: DataFrame, companies: DataFrame) -> DataFrame:
    """(symbol, sector, subsector, segment) of every ticker whose company is known."""
    levels = distinct_on(companies, ["issuing_company"], ["code_cvm"]).select("issuing_company", "sector", "subsector", "segment")
    return companies_symbols.join(levels, "issuing_company").select("symbol", "sector", "subsector", "segment").distinct()


def get_symbols(
    datasets: Mapping[str, DataFrame], kind: str, sector: str | None = None, index: str | None = None, end_month: int | None = None
) -> DataFrame:
    """(symbol) distinct and sorted; an unknown kind or an absent dataset gives none.

    Equities by sector or by index, too, the sector first where both are given; of an index the members of its last date, or of the
    last one with that ``end_month``. ``symbol_properties`` makes the table of tickers and their sectors.
    """
    name, column, condition, last = SYMBOL_KINDS.get(kind.lower(), ("", "", "", False))
    if name == "symbol_properties" and column == "symbol" and sector is not None:
        condition = F.col("sector") == sector
    elif name == "symbol_properties" and column == "symbol" and index is not None:
        name, condition, last = "index_members", F.col("index") == index, True
    if name not in datasets:
        some = next(iter(datasets.values()))
        return some.sparkSession.createDataFrame([], "symbol string")
    df = datasets[name]
    if name == "index_members" and end_month is not None:
        date = df.where(F.col("end_month") == end_month).agg(F.max("refdate").alias("refdate"))
        df = df.join(F.broadcast(date), "refdate", "left_semi")
    elif last and "refdate" in df.columns:
        df = filter_latest_date(df)
    df = df.where(condition).select(F.col(column).cast("string").alias("symbol"))
    return df.where("symbol is not null").distinct().orderBy("symbol")


def get_industry_sectors(companies: DataFrame, columns: Sequence[str] = ("sector", "subsector", "segment")) -> DataFrame:
    return companies.select(*columns).distinct().orderBy(*columns)


def describe_datasets(datasets: Mapping[str, DataFrame], partitions: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """(dataset, column, type) of every dataset; with ``partitions`` also whether the column is one of its partition columns."""
    spark = next(iter(datasets.values())).sparkSession
    rows = [(name, f.name, f.dataType.simpleString(), f.name in (partitions or {}).get(name, ())) for name, df in datasets.items() for f in df.schema]
    found = spark.createDataFrame(rows, "dataset string, column string, type string, is_partition boolean")
    return found if partitions is not None else found.drop("is_partition")


# layer/dataset/partition folders/file, below a root
_PLACE = r"/([^/]+)/([^/]+)((?:/[^/=]+=[^/]*)*)/[^/]+$"


def list_datasets(spark: SparkSession, root: str) -> DataFrame:
    """(layer, dataset, partitions, files, bytes) of the parquet datasets below a root, from its folders alone.

    Files are listed by Spark; none is opened. ``partitions`` are the partition columns in the order of their folders. Folders and files
    whose names begin with a dot or an underscore are not datasets.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    path = F.substring_index("path", root.rstrip("/").rpartition("/")[2] + "/", -1)
    place = F.concat(F.lit("/"), path)
    files = files.select(place.alias("place"), "length").where(F.col("place").rlike(_PLACE) & ~F.col("place").rlike("/[._]"))
    names = F.transform(F.filter(F.split(F.regexp_extract("place", _PLACE, 3), "/"), lambda x: x != ""), lambda x: F.substring_index(x, "=", 1))
    rows = files.select(F.regexp_extract("place", _PLACE, 1).alias("layer"), F.regexp_extract("place", _PLACE, 2).alias("dataset"), names.alias("partitions"), "length")
    found = rows.groupBy("layer", "dataset").agg(F.max("partitions").alias("partitions"), F.count("*").alias("files"), F.sum("length").alias("bytes"))
    return found.orderBy("layer", "dataset")


def describe_root(spark: SparkSession, root: str, datasets: Sequence[str] | None = None) -> DataFrame:
    """(layer, dataset, column, type, is_partition): columns merged from the footers of all of a dataset's files.

    Partition columns come last, as text. ``datasets`` are names "layer.dataset"; without them all are described. A
    column whose type differs between files and cannot be widened is an error that names the dataset.
    """
    rows = []
    for r in list_datasets(spark, root).collect():  # a row a dataset
        if datasets is not None and f"{r['layer']}.{r['dataset']}" not in datasets:
            continue
        path = f"{root.rstrip('/')}/{r['layer']}/{r['dataset']}"
        try:
            schema = spark.read.option("mergeSchema", "true").parquet(path).schema
        except Exception as problem:
            raise ValueError(f"{r['layer']}.{r['dataset']}: {problem}") from problem
        own = [f for f in schema if f.name not in r["partitions"]]
        rows += [(r["layer"], r["dataset"], f.name, f.dataType.simpleString(), False) for f in own]
        rows += [(r["layer"], r["dataset"], c, "string", True) for c in r["partitions"]]
    return spark.createDataFrame(rows, "layer string, dataset string, column string, type string, is_partition boolean")


def open_dataset(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A dataset "layer.dataset" below a root, partition columns as text."""
    layer, _, dataset = name.partition(".")
    columns = describe_root(spark, root, [name]).collect()
    if not columns:
        raise ValueError(f"no dataset {name}")
    schema = ", ".join(f"`{r['column']}` {r['type']}" for r in columns)
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{layer}/{dataset}")
