import datetime as dt
import math

import pytest

from tapewright.operators import calendar as C
from tapewright.operators import curves as R
from tapewright.operators import timeseries as X

D = dt.date


def frame(spark, middle=math.log(110 / 100), days=(2, 3, 4)):
    rows = {2: (99.0, 101.0, 98.0, 100.0, None), 3: (109.0, 111.0, 108.0, 110.0, middle), 4: (120.0, 122.0, 119.0, 121.0, math.log(121 / 110))}
    return spark.createDataFrame([(D(2024, 1, k), "IDX1", *rows[k]) for k in days], "refdate date, symbol string, open double, high double, low double, close double, returns double")


def weekdays(spark):
    return C.build_calendar(spark, "2023-12-01", "2024-03-31")


def test_consistent_returns_change_nothing(spark):
    got = X.adjust_prices(frame(spark)).orderBy("refdate").collect()
    assert [[r[c] for c in ("open", "high", "low", "close")] for r in got] == [pytest.approx(x) for x in ((99, 101, 98, 100), (109, 111, 108, 110), (120, 122, 119, 121))]


def test_latest_close_is_the_anchor(spark):
    got = X.adjust_prices(frame(spark, math.log(105 / 100))).orderBy("refdate").collect()
    assert got[2]["close"] == 121 and got[0]["close"] == pytest.approx(121 / math.exp(math.log(121 / 110) + math.log(105 / 100)))


def test_gaps_are_filled_only_on_demand(spark):
    gap = frame(spark, days=(2, 4))
    assert X.adjust_prices(gap).count() == 2
    filled = X.adjust_prices(gap, calendar=weekdays(spark), fill_calendar_gaps=True).orderBy("refdate").collect()
    assert [r["refdate"].day for r in filled] == [2, 3, 4] and filled[1]["close"] == pytest.approx(filled[0]["close"])


def test_null_return_leaves_the_next_older_row_without_factor(spark):
    rows = [(D(2024, 1, k), "A", 10.0, r) for k, r in ((1, 0.1), (2, 0.2), (3, None), (4, 0.3))]
    df = spark.createDataFrame(rows, "refdate date, symbol string, close double, returns double")
    got = [r["close"] for r in X.adjust_prices(df, price_columns=("close",)).orderBy("refdate").collect()]
    assert got == [pytest.approx(10 / math.exp(0.5)), None, pytest.approx(10 / math.exp(0.3)), 10]


def test_carries_whole_rows_and_drops_weekends(spark):
    rows = [(D(2024, 1, 4), "A", 1.0, 5.0, 0.0), (D(2024, 1, 6), "A", 2.0, 6.0, 0.0), (D(2024, 1, 5), "A", None, 7.0, 0.0), (D(2024, 1, 9), "A", 3.0, 7.0, 0.0)]
    df = spark.createDataFrame(rows, "refdate date, symbol string, open double, close double, returns double")
    got = X.on_calendar(df, weekdays(spark), "returns").orderBy("refdate").collect()
    assert [(r["refdate"].day, r["open"], r["close"]) for r in got] == [(4, 1.0, 5.0), (5, None, 7.0), (8, None, 7.0), (9, 3.0, 7.0)]


def test_interpolation(spark):
    curve = spark.createDataFrame([(D(2020, 1, 2), t, r) for t, r in ((21, 0.10), (252, 0.11), (504, 0.12))], "refdate date, business_days long, adjusted_tax double")
    cal = C.build_calendar(spark, "2020-01-01", "2024-12-31")
    got = {r["symbol"]: r for r in R.standard_terms(curve, cal, [1, 21, 126, 252, 756], "DI1T").collect()}
    assert got["DI1T21"]["adjusted_tax"] == pytest.approx(0.10) and got["DI1T252"]["adjusted_tax"] == pytest.approx(0.11)
    y = math.log(1.10) * 21 / 252 + (math.log(1.11) - math.log(1.10) * 21 / 252) * 105 / 231
    assert got["DI1T126"]["adjusted_tax"] == pytest.approx(math.exp(y * 2) - 1)
    assert got["DI1T756"]["adjusted_tax"] == pytest.approx((1.12**2) ** (252 / 756) - 1)
    assert got["DI1T1"]["adjusted_tax"] == pytest.approx(1.1**21 - 1)
    assert got["DI1T21"]["maturity_date"] == D(2020, 1, 31)


def test_implied_rates(spark):
    df = spark.createDataFrame([(90000.0, 252), (0.0, 252), (90000.0, 0)], "p double, n long")
    simple = [r["r"] for r in R.implied_rate(df, "p", "r", "n").collect()]
    assert simple == [pytest.approx((100 / 90 - 1) * 360 / 252), None, None]
    assert R.implied_rate(df, "p", "r", "n", "discrete").first()["r"] == pytest.approx(100 / 90 - 1)
    with pytest.raises(ValueError):
        R.implied_rate(df, "p", "r", "n", "continuous")


def test_calendar(spark):
    cal = C.build_calendar(spark, "2024-01-01", "2024-01-14", ["2024-01-01"])
    assert [r[0].day for r in C.bizday_seq(cal, "2024-01-01", "2024-01-08").collect()] == [2, 3, 4, 5, 8]
    df = spark.createDataFrame([(D(2024, 1, 6), D(2024, 1, 9), 2), (D(2024, 1, 5), D(2024, 1, 5), -1), (None, D(2024, 1, 5), 1)], "a date, b date, n long")
    got = C.offset_bizdays(C.bizdays_between(C.following_bizday(df, cal, "a", "f"), cal, "a", "b", "d"), cal, "a", "n", "o").collect()
    assert {(r["f"], r["d"], r["o"]) for r in got} == {(D(2024, 1, 8), 1, D(2024, 1, 10)), (D(2024, 1, 5), 0, D(2024, 1, 4)), (None, None, None)}
    codes = spark.createDataFrame([("DI1F24",), ("XYZ",), (None,)], "code string")
    assert [r["m"] for r in C.maturity_to_date(codes, cal, "code", "m", "first bizday").collect()] == [D(2024, 1, 2), None, None]
    assert C.maturity_to_date(codes, cal, "code", "m", "15th day").first()["m"] == D(2024, 1, 15)
    assert C.build_calendar(spark, "2024-01-06", "2024-01-07", kind="actual").where("is_bizday").count() == 2
