"""Column, row, set and reshape operators: DataFrame in, DataFrame out, for use with ``transform``."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

Order = Column | str


def ordered(by: Order | Sequence[Order]) -> list[Column]:
    """Sort keys with nulls last; a plain name sorts upwards, a leading "-" downwards."""
    keys = []
    for key in [by] if isinstance(by, str | Column) else by:
        if isinstance(key, str):
            key = F.col(key[1:]).desc_nulls_last() if key.startswith("-") else F.col(key).asc_nulls_last()
        keys.append(key)
    return keys


# ---- columns


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return df.select(*[F.col(f"`{c}`") for c in columns])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Renames what is present; of several old names for one new name at most one may be."""
    present = {a: b for a, b in mapping.items() if a in df.columns}
    names = [present.get(c, c) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"renaming would repeat columns: {twice}")
    return df.withColumnsRenamed(present)


def set_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    if len(names) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns, but {len(names)} names")
    return df.toDF(*names)


def add_column(df: DataFrame, name: str, value: Any, only_if_missing: bool = False) -> DataFrame:
    if only_if_missing and name in df.columns:
        return df
    return df.withColumn(name, value if isinstance(value, Column) else F.lit(value))


def add_column_multi(dfs: Mapping[str, DataFrame], name: str, value: Any, only_if_missing: bool = False) -> dict[str, DataFrame]:
    return {key: add_column(df, name, value, only_if_missing) for key, df in dfs.items()}


def apply_expression(df: DataFrame, column: str, expression: str, output: str | None = None) -> DataFrame:
    """SQL text over ``x``, which stands for the column."""
    shadowed = df.withColumn("x", F.col(column)) if "x" not in df.columns or column == "x" else None
    if shadowed is None:
        raise ValueError("the frame has a column named x")
    result = shadowed.withColumn(output or column, F.expr(expression))
    return result if "x" in (column, output) else result.drop("x")


NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
TRUE_WORDS = ("true", "t", "yes", "y", "1", "on")
FALSE_WORDS = ("false", "f", "no", "n", "0", "off")


def to_number(text: Column) -> Column:
    """Double, or null where the text is no plain number."""
    text = text.cast("string")
    return F.when(text.rlike(NUMBER), F.trim(text)).try_cast("double")


def to_integer(text: Column) -> Column:
    """Long, or null where the text is no whole number."""
    number = to_number(text)
    return F.when(number == F.floor(number), number).cast("long")


def to_boolean(text: Column) -> Column:
    word = F.lower(F.trim(text.cast("string")))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def cast_columns(df: DataFrame, columns: Sequence[str], dtype: str) -> DataFrame:
    """int, float, str, datetime, date or bool; values that do not fit become null, absent columns are skipped."""
    kinds = {
        "int": to_integer,
        "float": to_number,
        "str": lambda c: c.cast("string"),
        "datetime": lambda c: F.try_to_timestamp(c.cast("string")),
        "date": lambda c: F.try_to_timestamp(c.cast("string")).cast("date"),
        "bool": to_boolean,
    }
    if dtype not in kinds:
        raise ValueError(f"unknown type: {dtype}")
    return df.withColumns({c: kinds[dtype](F.col(c)) for c in columns if c in df.columns})


def case_map(df: DataFrame, column: str, mapping: Mapping[Any, Any], output: str, default: Any = None) -> DataFrame:
    """A lookup; ``default`` may be a Column. Small maps are CASE, longer ones a literal map."""
    key = F.col(column)
    otherwise = default if isinstance(default, Column) else F.lit(default)
    if not mapping:
        return df.withColumn(output, otherwise)
    if len(mapping) <= 8:
        chain = reduce(lambda c, kv: c.when(key == kv[0], F.lit(kv[1])), mapping.items(), F)
        return df.withColumn(output, chain.otherwise(otherwise))
    table = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return df.withColumn(output, F.coalesce(F.try_element_at(table, key), otherwise))


def scale_and_sign(
    df: DataFrame, columns: Sequence[str], decimals_column: str, sign_columns: Mapping[str, str] | None = None
) -> DataFrame:
    """Divides by ten to the row's number of decimals; negative where the sign column says "-"."""
    new = {}
    for c in columns:
        value = F.col(c) / F.pow(F.lit(10.0), F.col(decimals_column))
        if sign_columns and c in sign_columns:
            value = F.when(F.trim(sign_columns[c]) == "-", -value).otherwise(value)
        new[c] = value
    return df.withColumns(new)


def str_replace(
    df: DataFrame, column: str, pattern: str, replacement: str = "", output: str | None = None, regex: bool = False
) -> DataFrame:
    if regex:
        value = F.regexp_replace(column, f"(?U){pattern}", replacement)
    else:
        value = F.replace(F.col(column), F.lit(pattern), F.lit(replacement))
    return df.withColumn(output or column, value)


def make_date(df: DataFrame, year_column: str, month_column: str, day_column: str, output: str = "date") -> DataFrame:
    """Parts that are no date of the years 0 to 9999 give null."""
    year, month, day = (F.col(c).cast("int") for c in (year_column, month_column, day_column))
    first = F.when(year.between(0, 9999) & month.between(1, 12), F.make_date(year, month, F.lit(1)))
    return df.withColumn(output, F.when(day.between(1, F.day(F.last_day(first))), F.date_add(first, day - 1)))


# ---- rows


def filter_rows(df: DataFrame, column: str, operator: str, value: Any = None) -> DataFrame:
    """eq ne gt lt ge le in notin notna isna. ne and notin keep nulls."""
    c = F.col(column)
    conditions = {
        "eq": lambda: c == value,
        "ne": lambda: ~c.eqNullSafe(value),
        "gt": lambda: c > value,
        "lt": lambda: c < value,
        "ge": lambda: c >= value,
        "le": lambda: c <= value,
        "in": lambda: c.isin(*value),
        "notin": lambda: c.isNull() | ~c.isin(*value),
        "notna": c.isNotNull,
        "isna": c.isNull,
    }
    if operator not in conditions:
        raise ValueError(f"unknown operator: {operator}")
    return df.where(conditions[operator]())


def drop_na(df: DataFrame, columns: Sequence[str] | None = None, how: str = "any") -> DataFrame:
    return df.na.drop(how=how, subset=list(columns) if columns else None)


def filter_latest_date(df: DataFrame, date_column: str = "refdate") -> DataFrame:
    """Rows at the greatest date: the one-row maximum goes to all tasks."""
    latest = df.agg(F.max(date_column).alias("__latest"))
    return df.join(F.broadcast(latest), F.col(date_column) == F.col("__latest")).drop("__latest")


def filter_date_range(df: DataFrame, date_column: str, start: Any = None, end: Any = None) -> DataFrame:
    """Rows from start to end; without them from 2000-01-01 to today."""
    start = "2000-01-01" if start is None else start
    if end is None:
        return df.where(F.col(date_column).between(F.lit(start).cast("date"), F.current_date()))
    if str(start) > str(end):
        raise ValueError(f"start {start} is after end {end}")
    return df.where(F.col(date_column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def sort(df: DataFrame, by: Order | Sequence[Order], descending: bool | Sequence[bool] = False) -> DataFrame:
    """Nulls last in either direction."""
    keys = [by] if isinstance(by, str | Column) else list(by)
    down = [descending] * len(keys) if isinstance(descending, bool) else list(descending)
    if len(down) != len(keys):
        raise ValueError("as many directions as keys")
    return df.orderBy(*[F.col(k).desc_nulls_last() if d else F.col(k).asc_nulls_last() for k, d in zip(keys, down, strict=True)])


def top_k(df: DataFrame, by: Order | Sequence[Order], k: int) -> DataFrame:
    return df.orderBy(*ordered(by)).limit(k)


def ranked(df: DataFrame, keys: Sequence[str], order_by: Order | Sequence[Order], name: str = "rn") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*ordered(order_by))))


def first_rows(df: DataFrame, keys: Sequence[str], order_by: Order | Sequence[Order], k: int = 1) -> DataFrame:
    """The first k rows of every key by the order; give enough keys that ties cannot matter."""
    return ranked(df, keys, order_by, "__rn").where(F.col("__rn") <= k).drop("__rn")


def distinct_on(df: DataFrame, keys: Sequence[str], order_by: Order | Sequence[Order]) -> DataFrame:
    return first_rows(df, keys, order_by)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Order | Sequence[Order]) -> DataFrame:
    """The first row of every key; ``order_by`` as in ``ordered``, such as ("-refdate", "id")."""
    return first_rows(df, keys, order_by)


def drop_duplicates(df: DataFrame, subset: Sequence[str], order_by: Order | Sequence[Order], keep: str | bool = "first") -> DataFrame:
    """keep: "first", "last" by the order, or False for rows whose key is unique."""
    if keep is False:
        counted = df.withColumn("__n", F.count("*").over(Window.partitionBy(*subset)))
        return counted.where("__n = 1").drop("__n")
    if keep == "first":
        return first_rows(df, subset, order_by)
    if keep != "last":
        raise ValueError(f"keep: {keep}")
    total = F.count("*").over(Window.partitionBy(*subset))
    return ranked(df.withColumn("__n", total), subset, order_by, "__rn").where("__rn = __n").drop("__rn", "__n")


def forward_fill(df: DataFrame, column: str, order_by: Order | Sequence[Order], partition_by: Sequence[str] = ()) -> DataFrame:
    window = Window.partitionBy(*partition_by).orderBy(*ordered(order_by)).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(column, F.last(column, ignorenulls=True).over(window))


# ---- joins


def join_left_unique(left: DataFrame, right: DataFrame, keys: Sequence[str], order_by: Order | Sequence[Order]) -> DataFrame:
    """Enrichment: the right side has one row a key first, so that no row of the left is repeated."""
    return left.join(first_rows(right, keys, order_by), list(keys), "left")


def full_outer_reconcile(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str],
    prefer: str = "a",
    compare: Sequence[str] = (),
    names: tuple[str, str] = ("a", "b"),
) -> DataFrame:
    """Two sources of the same columns made one; which of them had a row, and where they differ.

    Adds ``provenance`` (both or the source's name) and, for each compared number, ``<name>_differs``.
    """
    columns = [c for c in a.columns if c in b.columns and c not in keys]
    left = a.select(*keys, *[F.col(c).alias(f"a_{c}") for c in columns], F.lit(True).alias("in_a"))
    right = b.select(*keys, *[F.col(c).alias(f"b_{c}") for c in columns], F.lit(True).alias("in_b"))
    met = left.join(right, list(keys), "full_outer")
    first, second = ("a", "b") if prefer == "a" else ("b", "a")
    merged = [F.coalesce(f"{first}_{c}", f"{second}_{c}").alias(c) for c in columns]
    where = F.when(F.col("in_a") & F.col("in_b"), "both").when(F.col("in_a"), names[0]).otherwise(names[1])
    differs = [(F.round(f"a_{c}", 6) != F.round(f"b_{c}", 6)).alias(f"{c}_differs") for c in compare]
    return met.select(*keys, *merged, where.alias("provenance"), *differs)


def not_in(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """SQL's NOT IN: no row at all if the other side has a null."""
    nulls = other.where(F.col(other_column).isNull()).limit(1).select(F.lit(1).alias("__null"))
    kept = df.join(other.select(F.col(other_column).alias("__other")).distinct(), F.col(column) == F.col("__other"), "left_anti")
    kept = kept.join(F.broadcast(nulls), F.lit(True), "left_anti")
    some = other.limit(1).select(F.lit(1).alias("__some"))
    without_key = kept.where(F.col(column).isNull()).join(F.broadcast(some), F.lit(True), "left_anti")
    return kept.where(F.col(column).isNotNull()).unionByName(without_key)


# ---- sets and shapes


def concat_datasets(dfs: Sequence[DataFrame], columns: Sequence[str] | None = None) -> DataFrame:
    if not dfs:
        raise ValueError("no datasets")
    parts = [select_columns(df, columns) if columns else df for df in dfs]
    for part in parts[1:]:
        if sorted(part.dtypes) != sorted(parts[0].dtypes):
            raise ValueError(f"schemas differ: {parts[0].dtypes} and {part.dtypes}")
    return reduce(DataFrame.unionByName, parts)


def union_cutover(branches: Iterable[tuple[DataFrame, Column | str]]) -> DataFrame:
    """Each source under its own predicate, so that every day comes from exactly one."""
    return reduce(DataFrame.unionByName, [df.where(predicate) for df, predicate in branches])


def union_aligned(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union by name in which absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def melt(
    df: DataFrame,
    id_vars: Sequence[str],
    value_vars: Sequence[str] | None = None,
    var_name: str = "variable",
    value_name: str = "value",
) -> DataFrame:
    values = list(value_vars) if value_vars else [c for c in df.columns if c not in id_vars]
    return df.unpivot(list(id_vars), values, var_name, value_name)


def flatten_columns(df: DataFrame, columns: Sequence[str], separator: str = ",") -> DataFrame:
    """One row per part, trimmed; a null stays one null row; several columns give their product."""
    for c in columns:
        parts = F.transform(F.split(F.col(c), "\\Q" + separator + "\\E"), lambda x: F.trim(x))
        df = df.withColumn(c, F.explode_outer(parts))
    return df


def unique_series(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The frame itself; an error that lists up to ten keys if any is repeated."""
    twice = df.groupBy(*keys).count().where("count > 1").orderBy(*keys).limit(10).collect()
    if twice:
        raise ValueError("duplicate " + ", ".join(str(tuple(r)[:-1]) for r in twice))
    return df


def pivot_wide(df: DataFrame, index: str, columns: str, values: str | Sequence[str], symbols: Sequence[Any], check: bool = True) -> DataFrame:
    """Long to wide; the symbols are given, so that no job is needed to find them."""
    names = [values] if isinstance(values, str) else list(values)
    rows = df.where(F.col(columns).isin(*symbols))
    if check:
        unique_series(rows, [index, columns])
    cells = [F.first(v) for v in names]
    if len(names) == 1:
        return rows.groupBy(index).pivot(columns, list(symbols)).agg(cells[0])
    wide = rows.groupBy(index).pivot(columns, list(symbols)).agg(*[c.alias(v) for c, v in zip(cells, names, strict=True)])
    return wide.withColumnsRenamed({f"{s}_{v}": f"{v}_{s}" for s in symbols for v in names})
