"""Tables whose keys are larger than those of the small copies."""

import datetime as dt

from tapewright.plans import registry


def run(name, spark, folder):
    return registry.QUERIES[name](spark, str(folder)).collect()


def test_events_of_parts_with_six_digits(spark, tmp_path):
    keys = [k + more for k in range(10001, 10031) for more in (0, 90000, 100000, 1200000)]
    spark.createDataFrame([(k,) for k in keys], "p_partkey long").write.parquet(str(tmp_path / "part.parquet"))
    for name, held in (("ds_cash_dividends_events", lambda k: k % 2 == 0 or k % 3 == 0), ("ds_subscription_events", lambda k: k % 3 == 1), ("ds_corporate_events", lambda k: True)):
        got = {(r["issuing_company"], r["symbol"]) for r in run(name, spark, tmp_path)}
        assert got == {(f"I{k}", f"I{k}3" if k % 5 else None) for k in keys if held(k)}, name


def test_renames_of_suppliers_with_near_prices(spark, tmp_path):
    keys = range(9000, 9120)  # prices of one day are 0.2 percent apart, returns fit by 0.5
    spark.createDataFrame([(j,) for j in keys], "s_suppkey long").write.parquet(str(tmp_path / "supplier.parquet"))
    kept = [j for j in keys if j % 5 and j % 11]
    day = {j: dt.date(2018, 1, 1) + dt.timedelta(days=10 + j % 20) for j in kept}
    got = run("ds_equities_symbol_changes", spark, tmp_path)
    assert {(r["src_last_close"], r["dest_first_close"], r["change_date"]) for r in got} == {(10.0 + j, round((10 + j) * (1 + (1 + j % 7) / 100), 6), day[j]) for j in kept}
    assert len(got) == len(kept)
