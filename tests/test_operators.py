"""Trends, spine joins, aggregates and snapshot de-duplication."""
import pytest
from pyspark.sql import functions as F

from strata.operators.aggregates import (class_slices, conditional_stats, headline_stats, period_end,
                                         pivot_wide)
from strata.operators.quality import drop_nulls_observed, dropped_pct, latest_snapshot
from strata.operators.spine import key_spine, spine_join, spine_merge, union_by_name
from strata.operators.trends import yoy


def yoy_of(spark, pairs, **kw):
    df = spark.createDataFrame([(2000 + i, None if v is None else float(v)) for i, v in enumerate(pairs)],
                               "year int, v double")
    return [r.p for r in yoy(df, "v", pct="p", aggregated=True, **kw).orderBy("year").collect()]


@pytest.mark.parametrize("cur,prev,expected", [
    (1100, 1000, 10.0), (900, 1000, -10.0), (1000, None, None), (100, 0, None), (1000, 1000, 0.0)])
def test_yoy_pairs(spark, cur, prev, expected):
    assert yoy_of(spark, [prev, cur])[1] == expected


def test_yoy_ranges(spark):
    assert 7.0 < yoy_of(spark, [1406.27, 1516.98])[1] < 8.5
    assert yoy_of(spark, [111.9, 91.5])[1] < -15


def test_yoy_chain_by_key(spark):
    df = spark.createDataFrame([("Dublin", 2016, 1406.27), ("Dublin", 2017, 1516.98), ("Dublin", 2018, 1638.98),
                                ("Cork", 2017, 900.0)], "location string, year int, v double")
    got = {(r.location, r.year): r.p for r in yoy(df, "v", "year", ["location"], pct="p").collect()}
    assert got[("Dublin", 2016)] is None and got[("Cork", 2017)] is None
    assert round(got[("Dublin", 2017)], 1) == 7.9 and round(got[("Dublin", 2018)], 1) == 8.0


def test_yoy_gap_by_row_and_strict(spark):
    df = spark.createDataFrame([(2016, 100.0), (2020, 150.0)], "year int, v double")
    assert [r.p for r in yoy(df, "v", pct="p", aggregated=True).orderBy("year").collect()] == [None, 50.0]
    assert [r.p for r in yoy(df, "v", pct="p", aggregated=True, strict=True).orderBy("year").collect()] == [None, None]


def test_yoy_global_needs_aggregated(spark):
    with pytest.raises(ValueError):
        yoy(spark.range(3).withColumnRenamed("id", "year"), "year")


def test_abs_change(spark):
    df = spark.createDataFrame([(2020, 10.0), (2021, 14.4)], "year int, v double")
    out = yoy(df, "v", change="d", pct="p", aggregated=True).orderBy("year").collect()
    assert [r.d for r in out] == [None, 4.0]


def years(spark, ys):
    return spark.createDataFrame([(y,) for y in ys], "year int")


def test_spine_merges(spark):
    assert sorted(r.year for r in key_spine([years(spark, [2005, 2006, 2007]), years(spark, [2008, 2009]),
                                             years(spark, [2015, 2016])]).collect()) == \
        [2005, 2006, 2007, 2008, 2009, 2015, 2016]
    assert key_spine([years(spark, [2015, 2016, 2020]), years(spark, [2016, 2020, 2021])]).count() == 4
    spans = [range(2001, 2025), range(2005, 2026), range(2008, 2025), [2015, 2016, 2020, 2021]]
    got = sorted(r.year for r in key_spine([years(spark, list(s)) for s in spans]).collect())
    assert got == list(range(2001, 2026))


def test_spine_join_nulls_before(spark):
    spine = years(spark, [2005, 2006, 2007, 2008])
    rent = spark.createDataFrame([(2008, 973.19)], "year int, rent double")
    price = spark.createDataFrame([(2006, 1.0), (2007, 2.0), (2030, 9.0)], "year int, p double")
    got = {r.year: (r.rent, r.p) for r in spine_join(spine, [rent, price]).collect()}
    assert got == {2005: (None, None), 2006: (None, 1.0), 2007: (None, 2.0), 2008: (973.19, None)}


def test_union_by_name(spark):
    a = spark.createDataFrame([("x", "1")], "address string, postal_code string")
    b = spark.createDataFrame([("y", "D6")], "address string, eircode string")
    rows = {r.address: (r.postal_code, r.eircode) for r in union_by_name([a, b]).collect()}
    assert rows == {"x": ("1", None), "y": (None, "D6")}


SALES = [(2020, 350000.0, "New"), (2020, 280000.0, "Second-Hand"), (2020, 420000.0, "New"),
         (2020, 310000.0, "Second-Hand")]
CLASSES = {"New": ("new_n", "new_avg"), "Second-Hand": ("sh_n", "sh_avg")}


def test_class_aggregate_both_ways(spark):
    df = spark.createDataFrame(SALES, "year int, price double, cls string")
    one = conditional_stats(df, ["year"], "price", "cls", CLASSES).first()
    assert (one.new_n, one.new_avg, one.sh_n, one.sh_avg) == (2, 385000.0, 2, 295000.0)
    slices = class_slices(df, ["year"], "price", "cls", CLASSES)
    joined = spine_join(years(spark, [2020]), list(slices.values())).first()
    assert (joined.new_n, joined.new_avg, joined.sh_n) == (2, 385000.0, 2)


def test_conditional_null_when_class_absent(spark):
    df = spark.createDataFrame([(2020, 1.0, "New")], "year int, price double, cls string")
    r = conditional_stats(df, ["year"], "price", "cls", CLASSES).first()
    assert (r.new_n, r.sh_n, r.sh_avg) == (1, None, None)


def test_headline_median(spark):
    df = spark.createDataFrame([(1, float(v)) for v in [5, 1, 4, 2, 3, 100]], "k int, v double")
    r = headline_stats(df, ["k"], "v", {"count": "n", "median": "med", "min": "lo", "max": "hi"}).first()
    assert (r.n, r.med, r.lo, r.hi) == (6, 3.0, 1.0, 100.0)


def test_pivot_fixed_names_and_unknown_key(spark):
    df = spark.createDataFrame([("2024 December", "T", "price_index", 163.6), ("2024 December", "T", None, 5.0),
                                ("2024 November", "T", "pct_change_1m", 0.456)],
                               "period string, t string, k string, v double")
    got = {r.period: (r.price_index, r.pct_change_1m)
           for r in pivot_wide(df, ["period", "t"], "k", "v", ["price_index", "pct_change_1m"]).collect()}
    assert got == {"2024 December": (163.6, None), "2024 November": (None, 0.46)}


def test_period_end(spark):
    df = spark.createDataFrame([(2023, 11, 1.0), (2023, 12, 2.0), (2024, 6, 3.0)], "year int, month int, v double")
    assert {r.year: r.v for r in period_end(df, ["year"], "month", ["v"]).collect()} == {2023: 2.0}
    assert {r.year: r.v for r in period_end(df, ["year"], "month", ["v"], at=None).collect()} == {2023: 2.0, 2024: 3.0}


def test_drop_nulls_observed(spark):
    df = spark.createDataFrame([(1,), (None,), (3,), (None,)], "d int")
    kept, obs = drop_nulls_observed(df, "d")
    assert kept.count() == 2
    assert obs.get == {"rows_in": 4, "rows_dropped": 2} and dropped_pct(obs.get) == 50.0


def test_latest_snapshot(spark):
    df = spark.createDataFrame([("a", "s1", 1), ("a", "s2", 2), ("a", "s2", 3), ("b", "s1", 4)],
                               "ds string, snap string, v int")
    assert sorted(r.v for r in latest_snapshot(df, ["ds"], "snap").collect()) == [2, 3, 4]


def test_spine_merge_equals_spine_join(spark):
    a = spark.createDataFrame([(2005, 1.0, True), (2006, 2.0, False), (2009, None, True)],
                              "year int, a double, flag boolean")
    b = spark.createDataFrame([(2006, "x"), (2007, "y")], "year int, b string")
    c = spark.createDataFrame([(2007, 7), (2030, 9)], "year int, c long")
    spine = key_spine([a.filter("flag"), b], "year")
    joined = {tuple(r) for r in spine_join(spine, [a.drop("flag"), b, c]).select("year", "a", "b", "c").collect()}
    merged = {tuple(r) for r in spine_merge([a, b, c], "year", in_spine=[F.col("flag"), True, False])
              .select("year", "a", "b", "c").collect()}
    assert merged == joined == {(2005, 1.0, None, None), (2006, 2.0, "x", None),
                                (2007, None, "y", 7), (2009, None, None, None)}


def test_pivot_keeps_newest_snapshot_of_a_repeated_cell(spark):
    df = spark.createDataFrame([("p", "price_index", 1.0, "s1"), ("p", "price_index", 0.5, "s2"),
                                ("p", "pct_change_1m", 9.0, None)],
                               "period string, k string, v double, snap string")
    r = pivot_wide(df, ["period"], "k", "v", ["price_index", "pct_change_1m"], order_col="snap").first()
    assert (r.price_index, r.pct_change_1m) == (0.5, None)
