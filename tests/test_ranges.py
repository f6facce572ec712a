"""Ranges of a total order and the lag over whole tables, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from strata.operators.ranges import carried, into_ranges
from strata.operators.trends import yoy_in_order

NULLS = lambda v: (v is not None, v if v is not None else 0)


def rows(seed, n=400):
    rng = random.Random(seed)
    return [(i, rng.choice("ab") if rng.random() < 0.5 else "hot", None if rng.random() < 0.1 else 7 if rng.random() < 0.4
             else rng.randint(0, 40), None if rng.random() < 0.1 else float(rng.randint(0, 9))) for i in range(n)]


def brute(data, keyed):
    data = sorted(data, key=lambda r: ((r[1],) if keyed else ()) + (NULLS(r[2]), NULLS(r[3]), r[0]))
    out, last = {}, {}
    for i, key, _, value in data:
        k = key if keyed else 0
        out[i] = last.get(k)
        last[k] = value
    return out


@pytest.mark.parametrize("seed,keyed", [(1, False), (2, True), (3, False)])
def test_lag_against_brute_force(spark, seed, keyed):
    data = rows(seed)
    df = spark.createDataFrame(data, "id long, key string, at int, v double").repartition(5)
    out = yoy_in_order(df, "v", "at", ["key"] if keyed else None, ties=["v", "id"], previous="p", change="d", pct="pct")
    want = brute(data, keyed)
    got = out.collect()
    assert len(got) == len(data)
    for r in got:
        assert r["p"] == want[r["id"]]
        both = r["p"] is not None and r["v"] is not None
        assert r["d"] == (r["v"] - r["p"] if both else None)
        assert r["pct"] == (round((r["v"] - r["p"]) / r["p"] * 100, 2) if both and r["p"] else None)


def test_one_value_in_several_ranges(spark):
    df = spark.range(4000).select("id", F.lit(1).alias("at"))
    held = into_ranges(df, ["at"], parts=8)
    sizes = {r["_range"]: r["count"] for r in held.groupBy("_range").count().collect()}
    assert len(sizes) == 8 and max(sizes.values()) < 2000


def test_empty_and_single_rows(spark):
    none = spark.createDataFrame([], "at int, v double")
    assert yoy_in_order(none, "v", "at").collect() == []
    one = spark.createDataFrame([(1, 2.0)], "at int, v double")
    assert yoy_in_order(one, "v", "at", previous="p").first()["p"] is None


def test_repeated_rows_and_default_ties(spark):
    data = [(1, 5.0, "x"), (1, 5.0, "x"), (1, 4.0, "y"), (None, 1.0, "z")] * 5
    df = spark.createDataFrame(data, "at int, v double, t string").repartition(4)
    got = sorted((r["v"], r["p"] or 0.0) for r in yoy_in_order(df, "v", "at", previous="p").collect())
    order = sorted(data, key=lambda r: (NULLS(r[0]), r[1], r[2]))
    assert got == sorted((b[1], a[1] if a else 0.0) for a, b in zip([None, *order], order))


def test_carried_sums(spark):
    per = spark.createDataFrame([(0, 3, 5), (2, 4, 1), (5, 1, 1)], "_range int, n long, s long")
    assert [tuple(r) for r in carried(per, ["n", "s"]).orderBy("_range").collect()] == [(0, 0, 0), (2, 3, 5), (5, 7, 6)]
