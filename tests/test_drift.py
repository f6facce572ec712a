"""Snapshots whose types drift."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.drift import folder_schemas, join_types, read_drifting

INT, LONG, DOUBLE, TEXT, DEC = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.DecimalType


def test_lattice():
    cases = [(INT, LONG, LONG), (INT, DOUBLE, DOUBLE), (T.ShortType(), T.FloatType(), DOUBLE), (LONG, DOUBLE, TEXT), (INT, TEXT, TEXT),
             (T.FloatType(), DOUBLE, DOUBLE), (T.NullType(), INT, INT), (DEC(10, 2), INT, DEC(12, 2)), (DEC(10, 2), DEC(9, 4), DEC(12, 4)),
             (DEC(38, 2), LONG, DEC(38, 2)), (DEC(38, 30), LONG, TEXT), (DEC(10, 2), DOUBLE, TEXT), (T.DateType(), INT, TEXT),
             (T.BooleanType(), INT, TEXT), (T.ArrayType(INT), T.ArrayType(LONG), T.ArrayType(LONG))]
    for a, b, want in cases:
        assert join_types(a, b) == want and join_types(b, a) == want, (a, b)
        assert join_types(join_types(a, b), a) == want  # joining again changes nothing


@pytest.fixture
def landings(spark, tmp_path):
    root = str(tmp_path / "in")
    spark.createDataFrame([(1, 10)], "id int, price int").write.parquet(f"{root}/a")
    spark.createDataFrame([(2, 2.5, "x")], "id long, price double, note string").write.parquet(f"{root}/b")
    spark.createDataFrame([("3.75", 3)], "price string, id int").write.parquet(f"{root}/c/deep")
    return root


def test_one_frame_of_all_landings(spark, landings):
    rows = read_drifting(spark, landings, file_col="file")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    assert kinds == {"id": "bigint", "price": "string", "note": "string", "file": "string"}
    assert sorted((r["id"], r["price"], r["note"]) for r in rows.collect()) == [(1, "10", None), (2, "2.5", "x"), (3, "3.75", None)]
    assert {r["file"].rsplit("/", 2)[1] for r in rows.collect()} == {"a", "b", "deep"}
    with pytest.raises(Exception):
        spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(landings).collect()


def test_types_that_differ_within_one_folder(spark, tmp_path):
    root = str(tmp_path / "mixed")
    for i, kind in enumerate(("int", "double", "int")):
        spark.range(i, i + 1).select(F.col("id").cast("int").alias("id"), F.col("id").cast(kind).alias("v")).coalesce(1).write.mode("append").parquet(root)
    assert len(folder_schemas(spark, root)) == 3
    assert sorted((r["id"], r["v"]) for r in read_drifting(spark, root).collect()) == [(0, 0.0), (1, 1.0), (2, 2.0)]


def test_columns_some_files_lack_share_one_scan(spark, tmp_path):
    root = str(tmp_path / "lack")
    spark.createDataFrame([(1,)], "id int").coalesce(1).write.parquet(root)
    spark.createDataFrame([(2, "b")], "id int, note string").coalesce(1).write.mode("append").parquet(root)
    assert len(folder_schemas(spark, root)) == 1
    assert sorted((r["id"], r["note"]) for r in read_drifting(spark, root).collect()) == [(1, None), (2, "b")]


def test_values_never_change(spark, tmp_path):
    root = str(tmp_path / "exact")
    spark.createDataFrame([(2**62 + 1,)], "v long").write.parquet(f"{root}/a")
    spark.createDataFrame([(0.1,)], "v double").write.parquet(f"{root}/b")
    assert sorted(r["v"] for r in read_drifting(spark, root).collect()) == ["0.1", str(2**62 + 1)]
    root = str(tmp_path / "dec")
    spark.createDataFrame([(decimal.Decimal("1.25"), dt.date(2024, 1, 2))], "v decimal(6,2), d date").write.parquet(f"{root}/a")
    spark.createDataFrame([(2**40, dt.datetime(2024, 1, 2, 3))], "v long, d timestamp").write.parquet(f"{root}/b")
    rows = read_drifting(spark, root)
    assert rows.schema["v"].dataType == DEC(22, 2) and {r["v"] for r in rows.collect()} == {decimal.Decimal("1.25"), decimal.Decimal(2**40)}
    assert sorted(r["d"] for r in rows.collect()) == ["2024-01-02", "2024-01-02 03:00:00"]


def test_nothing_there(spark, tmp_path):
    assert read_drifting(spark, str(tmp_path / "none")) is None
