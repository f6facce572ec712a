"""Exact quantiles against sorting in plain Python."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from strata.operators.aggregates import headline_stats
from strata.operators.selection import exact_quantile, with_exact_median
from strata.plans import gold


def brute(rows, q):
    groups = {}
    for k, v in rows:
        groups.setdefault(k, [])
        if v is not None:
            groups[k].append(v)
    nan_last = lambda v: (isinstance(v, float) and math.isnan(v), v)
    return {k: sorted(vs, key=nan_last)[max(math.ceil(q * len(vs)), 1) - 1] if vs else None for k, vs in groups.items()}


def run(spark, rows, schema, q=0.5, **options):
    df = spark.createDataFrame(rows, schema).repartition(5)
    return {r["k"]: r["median"] for r in exact_quantile(df, ["k"], "v", q, **options).collect()}


@pytest.mark.parametrize("seed,q", [(1, 0.5), (2, 0.25), (3, 0.99), (4, 1.0), (5, 0.0)])
def test_against_sorting_in_many_rounds(spark, seed, q):
    """Tiny sketches force several rounds; a third of the rows are one value of one key."""
    rng = random.Random(seed)
    rows = [("hot", rng.choice([7.0, rng.uniform(-1, 1), 10.0 ** rng.randint(-300, 300)])) for _ in range(3000)]
    rows += [(rng.choice(["a", "b", None]), rng.choice([None, 2.5, float(rng.randint(0, 9)), rng.gauss(0, 1e6)])) for _ in range(1500)]
    rows += [("none", None), ("one", -0.5)]
    assert run(spark, rows, "k string, v double", q, grid=4, accuracy=50) == brute(rows, q)


def test_ints_dates_and_infinities(spark):
    rows = [("x", i * 2**40) for i in range(-150, 150)]
    assert run(spark, rows, "k string, v long", grid=4, accuracy=20) == brute(rows, 0.5)
    days = [("x", dt.date(2000, 1, 1) + dt.timedelta(days=i * i % 977)) for i in range(400)]
    assert run(spark, days, "k string, v date", grid=4, accuracy=20) == brute(days, 0.5)
    odd = [("x", v) for v in [math.inf, -math.inf] * 100 + [1.0] * 30]
    assert run(spark, odd, "k string, v double", grid=4, accuracy=20) == brute(odd, 0.5)


def test_nan_ranks_last(spark):
    rows = [("x", 1.0)] * 3 + [("x", math.nan)] * 2 + [("y", math.nan)] * 4 + [("y", 1.0)]
    got = run(spark, rows, "k string, v double")
    assert got["x"] == 1.0 and math.isnan(got["y"])


def test_one_hot_group_of_many_rows(spark):
    df = spark.range(300_000).select(F.lit(1).alias("k"), F.expr("pmod(id * 7919, 300000)").alias("v"))
    assert exact_quantile(df, ["k"], "v").first()["median"] == 149_999


def test_no_keys_nulls_and_empty(spark):
    df = spark.createDataFrame([(3.0,), (1.0,), (2.0,), (4.0,)], "v double")
    assert exact_quantile(df, [], "v").first()["median"] == 2.0
    none = spark.createDataFrame([], "k string, v double")
    assert exact_quantile(none, ["k"], "v").collect() == []
    with pytest.raises(ValueError):
        exact_quantile(df, [], "v", q=1.5)


def test_sets_the_median_of_headline_stats(spark):
    rows = [(y, float(v)) for y in (2001, 2002, None) for v in range(10 + (y or 0) % 3)]
    df = spark.createDataFrame(rows, "year int, price double")
    stats = headline_stats(df, ["year"], "price", {"count": "n", "median": "mid"})
    got = {r["year"]: r["mid"] for r in with_exact_median(stats, df, ["year"], "price", "mid").collect()}
    assert got == {y: float((len([1 for a, _ in rows if a == y]) - 1) // 2) for y in (2001, 2002, None)}


def test_sales_mart_with_exact_medians(spark):
    rows = [(2020 + i % 2, float(i * 37 % 501), "New" if i % 3 else "Second-Hand") for i in range(600)]
    silver = spark.createDataFrame(rows, "year int, price_eur double, property_description string")
    got = {r["year"]: r["median_price_eur"] for r in gold.property_sales(silver, "2024-06-30", exact_median=True).collect()}
    assert got == {y: v for y, v in brute([(y, v) for y, v, _ in rows], 0.5).items()}
