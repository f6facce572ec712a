"""Scalar functions and column operators against the reference's cases."""
import pytest
from pyspark.sql import functions as F

from strata.fixed_values import CSV_NAME_BLANKS, KEY_PROPERTY_TYPES, MISREAD_EURO, MONTHS, PRICE_STATISTICS, SALES_MONEY_CHARS
from strata.functions.coerce import add_lineage, coerce_strings, ensure_year, infer_string_types
from strata.functions.names import clean_name, drop_code_columns, drop_matching, rename_synonyms
from strata.functions.values import (chart_time, classify, first_nonblank, first_year, keep_blank_or_no,
                                     lookup, month_of_period, parse_date, parse_money, parse_price)


def one_col(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r.out for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


@pytest.mark.parametrize("raw,expected", [
    ("1 01 2021", "2021-01-01"), ("28 02 2021", "2021-02-28"), ("1 1 2021", "2021-01-01"),
    ("31 12 2021", "2021-12-31"), (" 1 01 2021", "2021-01-01"), ("1 01 2021 ", "2021-01-01"),
    ("15 3 2021", "2021-03-15"), ("02/01/2015", "2015-01-02"), ("3/06/2020", "2020-06-03"),
    ("31/12/2016", "2016-12-31"), (None, None), ("", None), ("   ", None), ("2021", None),
    ("not a date", None), ("1, Main Street", None), ("31/02/2020", None),
])
def test_parse_date(spark, raw, expected):
    got = one_col(spark, [raw], parse_date)[0]
    assert (got.isoformat() if got else None) == expected


def test_first_year(spark):
    got = one_col(spark, ["2024M01", "2024", "2024Q1", "2005 January", None, "January"], first_year)
    assert got == [2024, 2024, 2024, 2005, None, None]


def test_month_of_period(spark):
    periods = [f"2010 {m}" for m in MONTHS] + ["2024", None, "2024 Smarch"]
    assert one_col(spark, periods, month_of_period) == list(range(1, 13)) + [None, None, None]


def test_parse_money(spark):
    got = one_col(spark, ["€1,234.50", "\x80343,000.00", "?1 000", "junk", None],
                  lambda c: parse_money(c, SALES_MONEY_CHARS))
    assert got == [1234.5, 343000.0, 1000.0, None, None]


def test_first_nonblank(spark):
    df = spark.createDataFrame([("D06 XY12", "Dublin 6"), (None, "Dublin 15"), (None, None), ("", "Dublin 8"),
                                ("", "")], "e string, p string")
    got = [r.x for r in df.select(first_nonblank("e", "p").alias("x")).collect()]
    assert got == ["D06 XY12", "Dublin 15", None, "Dublin 8", None]


def test_keep_blank_or_no(spark):
    vals = [None, "", "No", "NO", "Yes", " no"]
    df = spark.createDataFrame([(v,) for v in vals], "f string")
    kept = sorted((r.f is None, r.f or "") for r in df.filter(keep_blank_or_no("f")).collect())
    assert kept == sorted([(True, ""), (False, ""), (False, "No"), (False, "NO")])


def test_classify(spark):
    got = one_col(spark, ["New Dwelling house /Apartment", "NEW DWELLING HOUSE",
                          "Second-Hand Dwelling house /Apartment", None, "", "Unknown property type",
                          "Newtown"], classify)
    assert got == ["New", "New", "Second-Hand", "Second-Hand", "Second-Hand", "Second-Hand", "New"]


def test_statistic_map(spark):
    names = list(PRICE_STATISTICS) + ["Something else"]
    assert one_col(spark, names, lambda c: lookup(c, PRICE_STATISTICS)) == [
        "price_index", "pct_change_1m", "pct_change_3m", "pct_change_12m", None]


def test_key_types(spark):
    names = KEY_PROPERTY_TYPES + ["Fingal - houses", "South Dublin - houses",
                                  "Dun Laoghaire-Rathdown - houses", "Border excluding Louth - houses"]
    assert one_col(spark, names, lambda c: c.isin(KEY_PROPERTY_TYPES)) == [True] * 6 + [False] * 4


def test_chart_time(spark):
    assert [d.isoformat() for d in one_col(spark, [2005, 2024], chart_time, "int")] == ["2005-01-01", "2024-01-01"]


def test_clean_names():
    assert [clean_name(c, CSV_NAME_BLANKS) for c in ["Statistic Label", "Number of Bedrooms", "VALUE", "Property Type"]] \
        == ["statistic_label", "number_of_bedrooms", "value", "property_type"]
    assert clean_name(" Type of Residential-Property (A/B) ") == "type_of_residential_property_a_b"
    assert clean_name("Nation-Code/ID", CSV_NAME_BLANKS) == "nation-code/id"


def test_code_columns(spark):
    cols = ["STATISTIC", "Statistic Label", "TLIST(A1)", "Year", "C02970V03592", "Location", "UNIT", "VALUE", "C0 only"]
    df = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in cols))
    assert drop_code_columns(df).columns == ["Statistic Label", "Year", "Location", "VALUE", "C0 only"]
    assert drop_matching(df, ["^Loc", "Label"]).columns == [c for c in cols if c not in ("Location", "Statistic Label")]
    assert drop_matching(df, []).columns == cols


def test_drop_and_rename(spark):
    df = spark.createDataFrame([("a", "b", "c")], "`C01V2` string, `Location` string, `Price (?)` string")
    out = rename_synonyms(drop_code_columns(df), {"Location": "location"}, {r"^Price \(.*\)$": "price_raw"})
    assert out.columns == ["location", "price_raw"]
    weird = spark.createDataFrame([("1",)], "`Price (â\x82¬)` string")
    assert rename_synonyms(weird, {}, {r"^Price \(.*\)$": "price_raw"}).columns == ["price_raw"]


def test_coerce_strings(spark):
    df = spark.createDataFrame(
        [("2024", "356275.5", "Dublin", "0", None), ("2025", "-18.2", "2026-06-14", "", "1_000"),
         ("", "", "x", "7", "")], "a string, b string, c string, d string, e string")
    kinds = infer_string_types(df)
    assert kinds == {"a": "bigint", "b": "double", "c": "string", "d": "bigint", "e": "string"}
    rows = coerce_strings(df, kinds).orderBy("a").collect()
    assert [r.a for r in rows] == [None, 2024, 2025]
    assert sorted(r.b for r in rows if r.b is not None) == [-18.2, 356275.5]
    assert {r.d for r in rows} == {0, None, 7}


def test_lineage_and_year(spark):
    df = spark.createDataFrame([("FY2019/20",)], "year string")
    out = add_lineage(ensure_year(df, 2030), "RIA02", "2024-06-30", coverage="dublin").first()
    assert (out.year, out.source_dataset, out.ingestion_date, out.coverage) == (2019, "RIA02", "2024-06-30", "dublin")
    assert ensure_year(spark.range(1), 2030).first().year == 2030


def test_prices_are_never_made_up(spark):
    texts = ["2 bed", "N/A 12", "1,234.50 (est 2)", "€1,234.50", MISREAD_EURO + "99.5", "\x80 7", None, ""]
    assert one_col(spark, texts, parse_price) == [None, None, None, 1234.5, 99.5, 7.0, None, None]


def test_types_keep_every_value(spark):
    rows = [("1e5", "nan", "12345678901234567890", "", "1", "9007199254740993", "9" * 39),
            ("2", "1.5", "7", None, "2.5", "0.5", "1")]
    cols = ["exponent", "special", "long", "blank", "mixed", "mixed_long", "too_long"]
    kinds = infer_string_types(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols)))
    assert kinds == {"exponent": "string", "special": "string", "long": "decimal(38,0)", "blank": "string",
                     "mixed": "double", "mixed_long": "string", "too_long": "string"}
    out = coerce_strings(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))).collect()
    assert int(out[0].long) == 12345678901234567890 and out[0].exponent == "1e5" and out[0].blank is None
