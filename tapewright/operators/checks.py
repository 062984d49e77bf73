"""Data-quality checks. Each returns findings: dataset, rule, series, detail, count."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType

from tapewright.functions.scratch import written

SAMPLE = 20


def _found(df: DataFrame, rule: str, series: Column, detail: Column, count: Column) -> DataFrame:
    return df.select(
        F.lit(None).cast("string").alias("dataset"),
        F.lit(rule).alias("rule"),
        series.cast("string").alias("series"),
        detail.cast("string").alias("detail"),
        count.cast("long").alias("count"),
    )


def _series(group_column: str | None) -> Column:
    return F.col(group_column).cast("string") if group_column else F.lit("*")


def _spans(df: DataFrame, date_column: str, group_column: str | None, start: Any, end: Any) -> DataFrame:
    low = F.lit(str(start)).cast("date") if start else F.min(F.to_date(date_column))
    high = F.lit(str(end)).cast("date") if end else F.max(F.to_date(date_column))
    return df.groupBy(_series(group_column).alias("series")).agg(low.alias("low"), high.alias("high"))


def missing_days(df: DataFrame, cal: DataFrame, date_column: str = "refdate", group_column: str | None = None, start: Any = None, end: Any = None) -> DataFrame:
    """(series, cal_date): business days of each series' span without an observation."""
    spans = _spans(df, date_column, group_column, start, end)
    days = spans.where("low <= high").select("series", F.explode(F.sequence("low", "high")).alias("cal_date"))
    days = days.join(F.broadcast(cal.where("is_bizday").select("cal_date")), "cal_date")
    seen = df.select(_series(group_column).alias("series"), F.to_date(date_column).alias("cal_date")).distinct()
    return days.join(seen, ["series", "cal_date"], "left_anti")


def dq_calendar_gaps(df: DataFrame, cal: DataFrame, date_column: str = "refdate", group_column: str | None = None, start: Any = None, end: Any = None) -> DataFrame:
    gaps = missing_days(df, cal, date_column, group_column, start, end)
    return _found(gaps, "calendar_gaps", F.col("series"), F.col("cal_date"), F.lit(1))


def dq_period_gaps(df: DataFrame, frequency: str, date_column: str = "refdate", group_column: str | None = None, start: Any = None, end: Any = None) -> DataFrame:
    """Months (YYYY-MM) or quarters (YYYY-Qn) without an observation."""
    per_year = {"monthly": 12, "quarterly": 4}.get(frequency)
    if per_year is None:
        raise ValueError(f"unknown frequency: {frequency}")

    def number(date: Column) -> Column:
        return F.year(date) * per_year + (F.month(date) if per_year == 12 else F.quarter(date)) - 1

    spans = _spans(df, date_column, group_column, start, end)
    wanted = spans.select("series", F.explode(F.sequence(number(F.col("low")), number(F.col("high")))).alias("period"))
    seen = df.select(_series(group_column).alias("series"), number(F.to_date(date_column)).alias("period")).distinct()
    year = F.floor(F.col("period") / per_year).cast("int")
    part = (F.col("period") % per_year + 1).cast("int")
    name = F.format_string("%04d-%02d" if per_year == 12 else "%04d-Q%d", year, part)
    return _found(wanted.join(seen, ["series", "period"], "left_anti"), "period_gaps", F.col("series"), name, F.lit(1))


def dq_unexpected_dates(df: DataFrame, cal: DataFrame, date_column: str = "refdate", group_column: str | None = None) -> DataFrame:
    """Observed days that the calendar knows and that are no business days."""
    seen = df.groupBy(_series(group_column).alias("series"), F.to_date(date_column).alias("cal_date")).agg(F.count("*").alias("n"))
    return _unexpected(seen, cal)


def _unexpected(seen: DataFrame, cal: DataFrame) -> DataFrame:
    met = seen.join(F.broadcast(cal.where("not is_bizday").select("cal_date")), "cal_date")
    return _found(met, "unexpected_dates", F.col("series"), F.col("cal_date"), F.col("n"))


def dq_coverage(df: DataFrame, cal: DataFrame, first: Any = None, last: Any = None, date_column: str = "refdate", group_column: str | None = None) -> DataFrame:
    """(series, missing, extra, observed, expected): extra days are not expected ones."""
    missing = missing_days(df, cal, date_column, group_column, first, last).groupBy("series").agg(F.count("*").alias("missing"))
    seen = df.select(_series(group_column).alias("series"), F.to_date(date_column).alias("cal_date")).distinct()
    if first or last:
        seen = seen.where(F.col("cal_date").between(F.lit(str(first or "0001-01-01")).cast("date"), F.lit(str(last or "9999-12-31")).cast("date")))
    marked = seen.join(F.broadcast(cal.select("cal_date", "is_bizday")), "cal_date", "left")
    counts = marked.groupBy("series").agg(F.count_if("is_bizday").alias("observed"), F.count_if(~F.col("is_bizday")).alias("extra"))
    met = counts.join(missing, "series", "left").na.fill(0, ["missing"])
    return met.select("series", "missing", "extra", "observed", (F.col("observed") + F.col("missing")).alias("expected"))


def dq_date_gaps(df: DataFrame, cal: DataFrame, date_column: str = "refdate", look_back_days: int | None = None) -> DataFrame:
    """Missing business days among a dataset's dates, within a window before its last one; none below two dates."""
    dates = df.select(F.to_date(date_column).alias("d")).distinct()
    if look_back_days is not None:
        last = dates.agg(F.max("d").alias("last"))
        dates = dates.crossJoin(F.broadcast(last)).where(F.col("d") >= F.date_sub("last", look_back_days)).drop("last")
    gaps = missing_days(dates, cal, "d")
    many = dates.agg(F.count("*").alias("n")).where("n > 1").select(F.lit(1).alias("one"))
    return _found(gaps.join(F.broadcast(many), F.lit(True), "left_semi"), "date_gaps", F.col("series"), F.col("cal_date"), F.lit(1))


def dq_value_range(df: DataFrame, column: str, min: float | None = None, max: float | None = None) -> DataFrame:  # noqa: A002
    """One finding if any value is outside [min, max]: the count, the extremes and a sample."""
    if min is None and max is None:
        return config_finding(df, "value_range", f"{column}: no bound given")
    if not isinstance(df.schema[column].dataType, NumericType):
        return config_finding(df, "value_range", f"{column}: not a number")
    outside = F.lit(False)
    if min is not None:
        outside = outside | (F.col(column) < min)
    if max is not None:
        outside = outside | (F.col(column) > max)
    of = df.where(outside).agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi"))
    detail = F.format_string("%s outside, from %s to %s", F.col("n").cast("string"), F.col("lo").cast("string"), F.col("hi").cast("string"))
    return _found(of.where("n > 0"), "value_range", F.lit(column), detail, F.col("n"))


def outside_range_sample(df: DataFrame, column: str, min: float, max: float, k: int = SAMPLE) -> DataFrame:  # noqa: A002
    return df.where(~F.col(column).between(min, max)).limit(k)


def dq_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls of each listed column, all counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.unpivot([], list(columns), "column", "n").where("n > 0")
    return _found(long, "not_null", F.col("column"), F.lit("null values"), F.col("n"))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def dq_no_duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One finding if keys repeat: their number in the detail, the excess rows as the count."""
    of = duplicate_keys(df, key).agg(F.count("*").alias("keys"), F.sum(F.col("n") - 1).alias("excess"))
    return _found(of.where("keys > 0"), "no_duplicates", F.lit(",".join(key)), F.format_string("%d keys", "keys"), F.col("excess"))


def config_finding(df: DataFrame, rule: str, detail: str) -> DataFrame:
    one = df.sparkSession.range(1)
    return _found(one, rule, F.lit("*"), F.lit(detail), F.lit(1))


RULES = {
    "calendar_gaps": dq_calendar_gaps,
    "period_gaps": dq_period_gaps,
    "unexpected_dates": dq_unexpected_dates,
    "date_gaps": dq_date_gaps,
    "value_range": dq_value_range,
    "not_null": dq_not_null,
    "no_duplicates": dq_no_duplicates,
}


class Facts:
    """What the rules on one table need of it, gathered in one aggregation.

    Rules are compiled by the key that they group by: none (counts and extremes of columns), a key of columns
    (``no_duplicates``), or a series and its days. Each row is taken once for each different key, with map-side partial sums; rules of equal
    keys share them. Keys that occur once are left out before anything is written.
    """

    def __init__(self, df: DataFrame) -> None:
        self.df = df
        self.metrics: dict[str, Column] = {}
        self.tags: dict[tuple, int] = {}

    def column(self, name: str) -> Column:
        if name not in self.df.columns:
            raise ValueError(f"{name}: no such column")
        return F.col(f"`{name}`")

    def metric(self, of: Callable[[Column], Column]) -> str:
        """A value over all rows; ``of`` gets the condition that a row is taken for the table as a whole."""
        name = f"m{len(self.metrics)}"
        self.metrics[name] = of(F.col("t.tag") == 0)
        return name

    def tag(self, *key) -> int:
        return self.tags.setdefault(key, len(self.tags) + 1)

    def _takes(self) -> list[Column]:
        takes = [(0, F.lit(None).cast("string"), F.lit(None).cast("date"))] if self.metrics else []
        for (kind, *key), tag in self.tags.items():
            if kind == "key":
                takes.append((tag, F.to_json(F.struct(*[self.column(c) for c in key])), F.lit(None).cast("date")))
            else:
                takes.append((tag, _series(key[0]), F.to_date(self.column(key[1]))))
        return [F.struct(F.lit(tag).alias("tag"), k.alias("key"), day.alias("day")) for tag, k, day in takes]

    def frame(self) -> DataFrame:
        """(tag, key, day, n and the metrics)."""
        rows = self.df.withColumn("t", F.explode(F.array(*self._takes())))
        found = rows.groupBy("t.tag", "t.key", "t.day").agg(F.count("*").alias("n"), *[c.alias(name) for name, c in self.metrics.items()])
        keys = [tag for (kind, *_), tag in self.tags.items() if kind == "key"]
        return found.where(~F.col("tag").isin(keys) | (F.col("n") > 1)) if keys else found


def _value_range(facts: Facts, column: str, min: float | None = None, max: float | None = None):  # noqa: A002
    value = facts.column(column)
    if min is None and max is None:
        raise ValueError(f"{column}: no bound given")
    if not isinstance(facts.df.schema[column].dataType, NumericType):
        raise ValueError(f"{column}: not a number")
    outside = F.lit(False)
    if min is not None:
        outside = outside | (value < min)
    if max is not None:
        outside = outside | (value > max)
    n = facts.metric(lambda whole: F.count_if(whole & outside))
    lo, hi = (facts.metric(lambda whole, least=least: least(F.when(whole & outside, value))) for least in (F.min, F.max))

    def finding(found: DataFrame) -> DataFrame:
        detail = F.format_string("%s outside, from %s to %s", F.col(n).cast("string"), F.col(lo).cast("string"), F.col(hi).cast("string"))
        return _found(found.where(f"tag = 0 and {n} > 0"), "value_range", F.lit(column), detail, F.col(n))

    return finding


def _not_null(facts: Facts, columns: Sequence[str]):
    counts = {c: facts.metric(lambda whole, of=facts.column(c): F.count_if(whole & of.isNull())) for c in columns}

    def finding(found: DataFrame) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(m).alias("n")) for c, m in counts.items()])
        long = found.where("tag = 0").select(F.inline(cells)).where("n > 0")
        return _found(long, "not_null", F.col("column"), F.lit("null values"), F.col("n"))

    return finding


def _no_duplicates(facts: Facts, key: Sequence[str]):
    for c in key:
        facts.column(c)
    tag = facts.tag("key", *key)

    def finding(found: DataFrame) -> DataFrame:
        of = found.where(f"tag = {tag} and n > 1").agg(F.count("*").alias("keys"), F.sum(F.col("n") - 1).alias("excess"))
        return _found(of.where("keys > 0"), "no_duplicates", F.lit(",".join(key)), F.format_string("%d keys", "keys"), F.col("excess"))

    return finding


def _dated(rule: str):
    """Rules on the days of a series; they read (series, day, n) instead of the table."""

    def compiled(facts: Facts, *args, date_column: str = "refdate", group_column: str | None = None, **options):
        facts.column(date_column)
        if group_column is not None:
            facts.column(group_column)
        if rule == "period_gaps" and (args[0] if args else options.get("frequency")) not in ("monthly", "quarterly"):
            raise ValueError(f"unknown frequency: {options.get('frequency')}")
        tag = facts.tag("days", group_column, date_column)

        def finding(found: DataFrame) -> DataFrame:
            seen = found.where(f"tag = {tag}").select(F.col("key").alias("series"), F.col("day").alias("cal_date"), "n")
            if rule == "unexpected_dates":
                return _unexpected(seen, *args, **options)
            if rule == "date_gaps":
                return dq_date_gaps(seen, *args, date_column="cal_date", **options)
            return RULES[rule](seen, *args, date_column="cal_date", group_column="series", **options)

        return finding

    return compiled


COMPILED = {
    "value_range": _value_range,
    "not_null": _not_null,
    "no_duplicates": _no_duplicates,
    **{rule: _dated(rule) for rule in ("calendar_gaps", "period_gaps", "unexpected_dates", "date_gaps")},
}


def compile_rules(df: DataFrame, rules: Sequence[Mapping[str, Any]]) -> tuple[Facts, list[Callable[[DataFrame], DataFrame]]]:
    """The facts that the rules need, and for each rule its findings from a table of them."""
    facts, findings = Facts(df), []
    for options in rules:
        options = dict(options)
        rule = options.pop("rule", None)
        try:
            if rule not in RULES:
                raise ValueError(f"unknown rule: {rule}")
            inspect.signature(RULES[rule]).bind(df, **options)
            findings.append(COMPILED[rule](facts, **options))
        except (TypeError, ValueError, KeyError) as problem:
            findings.append(lambda _, rule=str(rule), text=str(problem): config_finding(df, rule, text))
    return facts, findings


def dq_suite(tables: Mapping[str, DataFrame], spec: Mapping[str, Sequence[Mapping[str, Any]]]) -> DataFrame:
    """Findings of all rules of ``spec`` (dataset -> rules with their options); each dataset is read once.

    Unknown rules and options that do not fit are findings themselves; datasets that are absent are skipped.
    """
    found: list[DataFrame] = []
    for dataset, rules in spec.items():
        if dataset not in tables:
            continue
        facts, findings = compile_rules(tables[dataset], rules)
        gathered = written(facts.frame(), "facts") if facts.metrics or facts.tags else None
        found += [f(gathered).withColumn("dataset", F.lit(dataset)) for f in findings]
    if not found:
        raise ValueError("nothing to check")
    return reduce(DataFrame.unionByName, found)


def schema_compare(actual: StructType, declared: StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(column, problem, actual type, declared type): only in data, only declared, or of another type."""
    a = {f.name: f.dataType.simpleString() for f in actual}
    d = {f.name: f.dataType.simpleString() for f in declared}
    rows = [(n, "only in data", t, None) for n, t in a.items() if n not in d]
    rows += [(n, "only declared", None, t) for n, t in d.items() if n not in a]
    return rows + [(n, "other type", a[n], d[n]) for n in a if n in d and a[n] != d[n]]


def dq_schema_drift(df: DataFrame, declared: StructType) -> DataFrame:
    schema = "column string, problem string, actual string, declared string"
    return df.sparkSession.createDataFrame(schema_compare(df.schema, declared), schema)
