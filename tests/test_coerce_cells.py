"""Per-cell typing against the plain rule."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions.coerce import cell_kinds, coerce_cells


def rule(v):
    """The source's rule: no point: whole number; a point: decimal number; else the text."""
    if v is None or v == "":
        return None
    try:
        return int(v) if "." not in v else float(v)
    except ValueError:
        return v


def typed(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").coalesce(1)
    out = []
    for r in cell_kinds(coerce_cells(df), ["v"], ["i"]).orderBy("i").collect():
        got = r["whole"] if r["whole"] is not None else r["number"] if r["number"] is not None else r["characters"]
        out.append(int(got) if r["kind"] == "DECIMAL" else got)
    return out


CASES = [None, "", "0", "-17", "+5", " 42 ", "007", "1_000", "1__0", "_1", "9" * 18, "9" * 19, "9" * 30, "1.5", "-.5", "5.", ".", "1.5e3",
         "1e5", "1.e", "1_0.2_5", "12.5.1", "nan", "inf", "NO", "1,5", "-", "+", " ", "\t7\n", "0x1F", "2024-01-05", "1.7976931348623157e309",
         "é1", "1 2", "-0", "-0.0"]


def test_cases_against_the_rule(spark):
    assert [repr(x) for x in typed(spark, CASES)] == [repr(rule(v)) for v in CASES]


def test_too_many_digits_stay_text(spark):
    assert typed(spark, ["9" * 39, "9" * 38]) == ["9" * 39, int("9" * 38)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="0123456789+-._eE x", max_size=9), min_size=40, max_size=60))
def test_any_text_against_the_rule(spark, values):
    assert [repr(x) for x in typed(spark, values)] == [repr(rule(v)) for v in values]


def test_mixed_column_to_json_and_parquet(spark, tmp_path):
    df = coerce_cells(spark.createDataFrame([("1", "a"), ("2.5", "b"), ("x", "c"), ("", "d")], "v string, k string"), ["v"])
    df.write.parquet(str(tmp_path / "cells"))
    back = spark.read.parquet(str(tmp_path / "cells")).select(F.to_json(F.struct("v", "k"), {"ignoreNullFields": "false"}).alias("j"))
    assert sorted((json.loads(r["j"]) for r in back.collect()), key=lambda d: d["k"]) == [
        {"v": 1, "k": "a"}, {"v": 2.5, "k": "b"}, {"v": "x", "k": "c"}, {"v": None, "k": "d"}]
    assert df.schema["k"].dataType.simpleString() == "string"
