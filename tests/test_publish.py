"""Publishing without a gap and refreshing changed years."""

import os

import pytest
from pyspark.sql import functions as F

from strata.plans.publish import (changed, current_version, fingerprints, publish, publish_together, refresh_mart,
                                  refresh_table, retire, write_marked, write_version)
from strata.operators.trends import yoy
from strata.session import clear_scratch, scratch_path

SCHEMA = "year int, k string, v double"


@pytest.fixture
def db(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS publish_test")
    yield "publish_test"
    spark.sql("DROP DATABASE publish_test CASCADE")


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def seen(spark, name):
    return sorted(tuple(r) for r in spark.table(f"publish_test.{name}").select("year", "k", "v").collect())


def test_switch_and_retire(spark, db):
    first = publish(frame(spark, (2020, "a", 1.0), (2021, "b", 2.0)), db, "mart")
    assert seen(spark, "mart") == [(2020, "a", 1.0), (2021, "b", 2.0)]
    reader = spark.table("publish_test.mart")  # a query that began before the switch
    second = publish(frame(spark, (2022, "c", 3.0)), db, "mart")
    assert seen(spark, "mart") == [(2022, "c", 3.0)] and reader.count() == 2
    assert current_version(spark, db, "mart") == second != first
    publish(frame(spark, (2023, "d", 4.0)), db, "mart")
    left = [r["tableName"] for r in spark.sql("SHOW TABLES IN publish_test").collect()]
    assert first not in left and second in left and seen(spark, "mart") == [(2023, "d", 4.0)]


def test_failed_write_leaves_the_old_rows(spark, db):
    publish(frame(spark, (2020, "a", 1.0)), db, "kept")
    bad = spark.range(200, numPartitions=4).select(
        F.lit(2021).alias("year"), F.lit("x").alias("k"),
        F.when(F.col("id") == 150, F.raise_error(F.lit("half-way")).cast("double")).otherwise(F.col("id").cast("double")).alias("v"))
    with pytest.raises(Exception, match="half-way"):
        publish(bad, db, "kept")
    assert seen(spark, "kept") == [(2020, "a", 1.0)]
    publish(frame(spark, (2021, "b", 2.0)), db, "kept")
    assert seen(spark, "kept") == [(2021, "b", 2.0)]


def test_unswitched_versions_are_not_seen_nor_dropped(spark, db):
    publish(frame(spark, (2020, "a", 1.0)), db, "open")
    waiting = write_version(frame(spark, (2021, "b", 2.0)), db, "open")
    assert seen(spark, "open") == [(2020, "a", 1.0)] and retire(spark, db, "open", keep=1) == []
    assert waiting in [r["tableName"] for r in spark.sql("SHOW TABLES IN publish_test").collect()]


def test_pruned_through_the_view(spark, db):
    publish(frame(spark, *[(y, "a", float(y)) for y in range(2000, 2010)]), db, "wide")
    plan = spark.table("publish_test.wide").filter("year = 2003")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_together_nothing_switches_when_one_fails(spark, db):
    publish_together({"one": frame(spark, (1, "a", 1.0)), "two": frame(spark, (1, "b", 1.0))}, spark, db)
    bad = frame(spark, (2, "c", 1.0)).withColumn("v", F.raise_error(F.lit("no")).cast("double"))
    with pytest.raises(Exception, match="no"):
        publish_together({"one": frame(spark, (2, "a", 2.0)), "two": bad}, spark, db)
    assert seen(spark, "one") == [(1, "a", 1.0)] and seen(spark, "two") == [(1, "b", 1.0)]


def test_fingerprints_do_not_depend_on_order_but_on_rows(spark):
    rows = [(2020 + i % 3, f"k{i}", float(i)) for i in range(60)]
    marks = lambda r: fingerprints(spark.createDataFrame(r, SCHEMA).repartition(3))
    assert changed(marks(rows), marks(rows[::-1])) == ([], [])
    assert changed(marks(rows + rows[:1]), marks(rows)) == ([2020], [])  # a repeated row counts
    assert changed(marks([(y, k, v + (k == "k4")) for y, k, v in rows]), marks(rows)) == ([2021], [])
    assert changed(marks([r for r in rows if r[0] != 2022]), marks(rows)) == ([], [2022])
    assert changed(marks(rows + [(None, "n", 1.0)]), marks(rows)) == ([None], [])


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_refresh_rewrites_changed_years_only(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = [(2020 + i % 4, f"k{i}", float(i)) for i in range(40)]
    assert refresh_table(spark.createDataFrame(rows, SCHEMA), path)["rewritten"] == [2020, 2021, 2022, 2023]
    before = files(path)
    assert refresh_table(spark.createDataFrame(rows[::-1], SCHEMA), path)["rewritten"] == [] and files(path) == before
    new = [(y, k, v * 2 if y == 2021 else v) for y, k, v in rows] + [(2030, "z", 1.0)]
    assert refresh_table(spark.createDataFrame(new, SCHEMA), path)["rewritten"] == [2021, 2030]
    same = {f: t for f, t in files(path).items() if "2021" not in f and "2030" not in f}
    assert same == {f: t for f, t in before.items() if "year=2021" not in f}
    assert sorted(map(tuple, spark.read.parquet(path).select("year", "k", "v").collect())) == sorted(new)
    assert refresh_table(spark.createDataFrame(new[4:-1], SCHEMA), path)["gone"] == [2030]
    assert sorted(map(tuple, spark.read.parquet(path).select("year", "k", "v").collect())) == sorted(new[4:-1])
    assert [d for d in os.listdir(tmp_path) if "staged" in d] == []


def mart(silver):
    yearly = silver.groupBy("year").agg(F.sum("v").alias("total"))
    return yoy(yearly, "total", "year", pct=None, change="change", aggregated=True)


def test_mart_equals_a_full_rebuild_and_reads_few_years(spark, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    rows = [(2010 + i % 8, f"k{i}", float(i)) for i in range(80) if i % 8 != 5]  # no 2015
    write_marked(spark.createDataFrame(rows, SCHEMA), silver)
    assert refresh_mart(spark, silver, gold, mart)["changed"] == [2010, 2011, 2012, 2013, 2014, 2016, 2017]
    assert refresh_mart(spark, silver, gold, mart) == {"changed": [], "rebuilt": [], "read": []}
    new = [(y, k, v + 1 if y == 2014 else v) for y, k, v in rows]
    refresh_table(spark.createDataFrame(new, SCHEMA), silver)
    read = []
    done = refresh_mart(spark, silver, gold, lambda df: (read.extend(df.inputFiles()), mart(df))[1])
    assert done == {"changed": [2014], "rebuilt": [2014, 2016], "read": [2013, 2014, 2016]}
    got = sorted(tuple(r) for r in spark.read.parquet(gold).select("year", "total", "change").collect())
    assert got == sorted(tuple(r) for r in mart(spark.createDataFrame(new, SCHEMA)).select("year", "total", "change").collect())
    # a year between two others changes the one after it
    refresh_table(spark.createDataFrame(new + [(2015, "x", 9.0)], SCHEMA), silver)
    assert refresh_mart(spark, silver, gold, mart)["rebuilt"] == [2015, 2016]
    got = sorted(tuple(r) for r in spark.read.parquet(gold).select("year", "total", "change").collect())
    full = mart(spark.createDataFrame(new + [(2015, "x", 9.0)], SCHEMA))
    assert got == sorted(tuple(r) for r in full.select("year", "total", "change").collect())


def test_a_build_that_fails_is_made_up_by_the_next(spark, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    rows = [(2010 + i % 4, f"k{i}", float(i)) for i in range(40)]
    write_marked(spark.createDataFrame(rows, SCHEMA), silver)
    refresh_mart(spark, silver, gold, mart)
    refresh_table(spark.createDataFrame([(y, k, v + (y == 2011)) for y, k, v in rows], SCHEMA), silver)
    with pytest.raises(Exception, match="boom"):
        refresh_mart(spark, silver, gold, lambda df: mart(df).withColumn("total", F.raise_error(F.lit("boom")).cast("double")))
    assert refresh_mart(spark, silver, gold, mart)["rebuilt"][:2] == [2011, 2012]


def test_scratch_folders_are_removed(spark):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert clear_scratch(spark) >= 1 and not os.path.exists(path)
