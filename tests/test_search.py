"""Substring search by index against a scan."""

import random

import pytest

from strata.operators.search import find, search_rows, write_index
from strata.plans import views


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    parts = ["Dublin", "Cork", "Dún", "Laoghaire", "Ath", "town", "Newtown", "co.", "X", "日本語", "aaa", "İl", " "]
    out = {" ".join(rng.choices(parts, k=rng.randint(0, 5))) for _ in range(150)}
    return sorted(out) + ["ab", "a", ""]


@pytest.fixture(scope="module")
def index(spark, texts, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 2)] + [(-1, None)], "id int, place string").repartition(4)
    write_index(rows, "place", path)
    return path, rows


NEEDLES = ["dublin", "DUBLIN", "own", "n", "dú", "ath town", "日本", "本語", "aaaa", "aa", "zzz", "zz", "z", "co. x", " ", "  ", "lin c", "k", "", None,
           "dublin", "not there at all"]


def test_equals_a_scan(spark, texts, index):
    path, _ = index
    needles = spark.createDataFrame([(n,) for n in NEEDLES], "needle string")
    got = sorted((r["needle"], r["text"]) for r in find(spark, path, needles).collect())
    low = {r["text"]: r["low"] for r in spark.createDataFrame([(t,) for t in texts], "text string").selectExpr("text", "lower(text) low").collect()}
    want = sorted((n, t) for n in {n for n in NEEDLES if n} for t in set(texts) if n.lower() in low[t])
    assert got == want


def test_random_substrings(spark, texts, index):
    path, rows = index
    rng = random.Random(7)
    needles = set()
    for t in texts:
        if t:
            a = rng.randrange(len(t))
            needles.add(t[a:a + rng.randint(1, 9)])
    df = spark.createDataFrame([(n,) for n in needles], "needle string")
    got = sorted((r["needle"], r["id"]) for r in search_rows(spark, path, df, rows, "place").collect())
    want = sorted((r["needle"], r["id"]) for r in
                  rows.crossJoin(df).filter("contains(lower(place), lower(needle))").collect())
    assert got == want


def test_lookup_is_no_cross_join(spark, index):
    path, _ = index
    plan = find(spark, path, spark.createDataFrame([("dublin",)], "needle string"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_rents_of_many_locations(spark, tmp_path):
    rows = [(loc, 2020 + i, 100.0 * i, 1.0, 2.0, i, None) for i, loc in enumerate(["Dublin 1", "Dublin 2", "Cork", "North Cork", "Dún Laoghaire"])]
    gold = spark.createDataFrame(rows, "location string, year int, avg_monthly_rent double, min_monthly_rent double, "
                                       "max_monthly_rent double, sample_count long, yoy_change_pct double")
    write_index(gold, "location", str(tmp_path / "ix"))
    texts = ["dublin", " 'Cork' ", "1", "dún", "%", "nowhere"]
    got = views.rents_of_many(gold, str(tmp_path / "ix"), texts, to_year=2023).collect()
    want = []
    for t in ("dublin", "Cork", "1", "dún", "nowhere"):
        want += [(t, r["location"], r["year"]) for r in views.rents(gold, t, to_year=2023).collect()]
    assert [(r["location_searched"], r["location"], r["year"]) for r in got] == sorted(want)
