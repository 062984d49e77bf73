import datetime as dt

import pytest

from tapewright.operators import checks as Q
from tapewright.operators.calendar import build_calendar

D = dt.date


def dates(spark, *days):
    return spark.createDataFrame([(d, "A", 1.0) for d in days], "refdate date, symbol string, value double")


def detail(df):
    return sorted(r["detail"] for r in df.collect())


def test_calendar_gaps(spark):
    cal = build_calendar(spark, "2020-01-01", "2020-12-31")
    days = [r[0] for r in cal.where("is_bizday and cal_date between '2020-01-02' and '2020-03-31'").select("cal_date").collect()]
    gone = days.pop(10)
    df = dates(spark, *days)
    assert detail(Q.dq_calendar_gaps(df, cal)) == [str(gone)]
    assert len(detail(Q.dq_calendar_gaps(df, cal, start="2020-05-01", end="2020-05-31"))) == 21
    row = Q.dq_coverage(df, cal).first()
    assert (row["missing"], row["extra"], row["observed"], row["expected"]) == (1, 0, len(days), len(days) + 1)
    assert detail(Q.dq_unexpected_dates(dates(spark, D(2020, 1, 4), D(2020, 1, 6), D(2031, 1, 4)), cal)) == ["2020-01-04"]
    assert Q.dq_date_gaps(dates(spark, D(2020, 1, 2)), cal).count() == 0


def test_period_gaps(spark):
    assert detail(Q.dq_period_gaps(dates(spark, D(2024, 1, 15), D(2024, 3, 5)), "monthly")) == ["2024-02"]
    assert detail(Q.dq_period_gaps(dates(spark, D(2023, 11, 2), D(2024, 2, 2)), "monthly")) == ["2023-12", "2024-01"]
    assert detail(Q.dq_period_gaps(dates(spark, D(2024, 1, 10), D(2024, 12, 10)), "quarterly")) == ["2024-Q2", "2024-Q3"]
    assert detail(Q.dq_period_gaps(dates(spark, D(2024, 2, 15)), "monthly", start="2024-01-20", end="2024-03-10")) == ["2024-01", "2024-03"]


def test_ranges_nulls_and_keys(spark):
    df = spark.createDataFrame([(D(2021, 1, 4), "A", 1.0), (D(2021, 1, 4), "A", 9.0), (D(2021, 1, 5), "B", None)], "refdate date, symbol string, value double")
    (row,) = Q.dq_no_duplicates(df, ["refdate", "symbol"]).collect()
    assert (row["detail"], row["count"]) == ("1 keys", 1)
    (row,) = Q.dq_value_range(df, "value", 0, 5).collect()
    assert row["count"] == 1 and "9.0" in row["detail"]
    assert Q.dq_value_range(df, "value", 1, 9).count() == 0
    assert [(r["series"], r["count"]) for r in Q.dq_not_null(df, ["value", "symbol"]).collect()] == [("value", 1)]
    assert "not a number" in Q.dq_value_range(df, "symbol", 1).first()["detail"]


def test_suite_reports_bad_rules(spark):
    df = dates(spark, D(2021, 1, 4))
    found = Q.dq_suite({"a": df}, {"a": [{"rule": "x"}, {"rule": "period_gaps", "frequency": "weekly"}, {"rule": "not_null"}], "b": [{"rule": "x"}]})
    assert [r["dataset"] for r in found.collect()] == ["a"] * 3
    with pytest.raises(ValueError):
        Q.dq_suite({}, {"b": []})
