"""View parameters, view filters and the result envelope."""
import json

import pytest

from strata.fixed_values import LOCATION_EXTRA_CHARS
from strata.plans import views
from strata.plans.sinks import envelope


@pytest.mark.parametrize("raw", ['2016"', '"2016', '"2016"', " 2016 ", "'2016'"])
def test_clean_year(raw):
    assert views.clean_year(raw, 2000) == 2016


def test_clean_year_default():
    assert views.clean_year(None, 2016) == 2016


@pytest.mark.parametrize("raw,expected", [
    ("Dublin", "Dublin"), ("South Dublin", "South Dublin"), ("Carlow, Ireland", "Carlow, Ireland"),
    ("Dun-Laoghaire", "Dun-Laoghaire"), ('Dublin"', "Dublin"), (None, None), ("", None),
    # the whitelist keeps letters and hyphens: quotes and semicolons go, words stay
    ("Dublin'; DROP TABLE users; --", "Dublin DROP TABLE users --"),
])
def test_clean_text(raw, expected):
    assert views.clean_text(raw, LOCATION_EXTRA_CHARS) == expected


@pytest.fixture
def rents_gold(spark):
    rows = [("Dublin", 2016, 1406.27), ("Dublin", 2017, 1516.98), ("South Dublin", 2017, 1600.0),
            ("Cork", 2017, 1100.0), ("Cork", 2010, 700.0)]
    return spark.createDataFrame(
        [(loc, y, v, v, v, None, 1) for loc, y, v in rows],
        "location string, year int, avg_monthly_rent double, min_monthly_rent double, "
        "max_monthly_rent double, yoy_change_pct double, sample_count long")


def test_rents_view(rents_gold):
    got = [(r.location, r.year) for r in views.rents(rents_gold, location="dublin").collect()]
    assert got == [("Dublin", 2016), ("Dublin", 2017), ("South Dublin", 2017)]
    assert views.rents(rents_gold, from_year='"2010"', to_year=2010).count() == 1
    assert views.rents(rents_gold, limit=2).count() == 2


def test_envelope(rents_gold):
    out = envelope(views.rents(rents_gold, location="cork", from_year=2016), "gold_avg_rent_by_location_year",
                   {"location_filter": "cork"}).collect()
    assert len(out) == 1 and out[0].status == "ok"
    assert json.loads(out[0].data)["avg_monthly_rent"] == 1100.0
    meta = json.loads(out[0].meta)
    assert meta == {"table": "gold_avg_rent_by_location_year", "location_filter": "cork", "row_count": 1}


def test_preview_is_topk(rents_gold):
    from strata.plans.sinks import preview
    df = preview(rents_gold, ["year", "location"], n=2)
    assert [(r.year, r.location) for r in df.collect()] == [(2010, "Cork"), (2016, "Dublin")]
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()


def test_summary_and_sales_views_defaults_and_quotes(spark):
    cols = views.SUMMARY_COLUMNS
    rows = [tuple([y] + [None] * (len(cols) - 2) + ["2024-06-30"]) for y in (2000, 2001, 2025, 2026)]
    schema = ", ".join(f"{c} {'int' if c == 'year' else 'string' if c == 'gold_updated' else 'double'}"
                       for c in cols)
    gold = spark.createDataFrame(rows, schema)
    assert [r.year for r in views.summary(gold).collect()] == [2000, 2001, 2025, 2026]  # no default bounds
    assert [r.year for r in views.summary(gold, 2001, 2025).collect()] == [2001, 2025]
    assert [r.year for r in views.summary(gold, from_year='"2025"', to_year="'2026' ").collect()] == [2025, 2026]
    sales_cols = views.SALES_COLUMNS
    srows = [tuple([y] + [None] * (len(sales_cols) - 2) + ["Dublin"]) for y in (2014, 2015, 2021)]
    sschema = ", ".join(f"{c} {'int' if c == 'year' else 'string' if c == 'county' else 'double'}"
                        for c in sales_cols)
    assert [r.year for r in views.sales(spark.createDataFrame(srows, sschema)).collect()] == [2014, 2015, 2021]


def test_prices_type_whitelist_drops_commas():
    from strata.fixed_values import TYPE_EXTRA_CHARS
    assert views.clean_text("Dublin, houses", TYPE_EXTRA_CHARS) == "Dublin houses"


def test_envelope_keeps_nulls(rents_gold):
    row = envelope(views.rents(rents_gold, location="cork", from_year=2017, to_year=2017), "t").first()
    assert '"yoy_change_pct":null' in row.data


def test_views_cut_nothing_unless_asked(spark):
    gold = spark.createDataFrame([(f"L{i:04d}", 2026, 1.0, 1.0, 1.0, None, 1) for i in range(901)],
                                 "location string, year int, avg_monthly_rent double, min_monthly_rent double, "
                                 "max_monthly_rent double, yoy_change_pct double, sample_count long")
    assert views.rents(gold).count() == 901
    assert views.rents(gold, limit=500).count() == 500
