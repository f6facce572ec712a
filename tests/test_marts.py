"""Gold marts on hand-made Silver rows (the reference's integration cases)."""
from strata.fixed_values import PERMISSIONS_CONSTRUCTION, PERMISSIONS_STATISTIC
from strata.plans import gold

RUN = "2024-06-30"
PRICE_COLS = "statistic string, period string, type_of_residential_property string, metric_value double, year int"


def price_rows(spark):
    rows = []
    for year, idx in [(2023, 150.0), (2024, 163.6)]:
        for m in ["November", "December"]:
            for t in ["National - all residential properties", "Dublin - all residential properties",
                      "Fingal - houses"]:
                rows.append(("Residential Property Price Index", f"{year} {m}", t, idx, year))
                rows.append(("Percentage Change over 12 months for Residential Property Price Index",
                             f"{year} {m}", t, 9.1234, year))
    rows.append(("Residential Property Price Index", "2025 June", "National - all residential properties", 170.0, 2025))
    return spark.createDataFrame(rows, PRICE_COLS)


def test_price_index(spark):
    out = gold.price_index(price_rows(spark), RUN)
    assert out.count() == 9  # Fingal filtered out; 2 types x 4 periods + June 2025
    r = out.filter("period = '2024 December' AND type_of_residential_property LIKE 'National%'").first()
    assert (r.price_index, r.pct_change_12m, r.pct_change_1m, r.month, r.year, r.gold_updated) == \
        (163.6, 9.12, None, 12, 2024, RUN)


def rent_rows(spark):
    rows = [("Dublin", 2016, 1406.27), ("Dublin", 2017, 1516.98), ("Dublin", 2018, 1638.98),
            ("Cork", 2017, 1000.0), ("Cork", 2018, 1100.0)]
    data = [(loc, y, v, "All bedrooms", "All property types") for loc, y, v in rows]
    data.append(("Dublin", 2017, 99999.0, "One bed", "All property types"))
    return spark.createDataFrame(data, "location string, year int, value double, number_of_bedrooms string, "
                                       "property_type string")


def test_rent_trends(spark):
    out = {(r.location, r.year): r for r in gold.rent_trends(rent_rows(spark), RUN).collect()}
    assert out[("Dublin", 2016)].yoy_change_pct is None
    assert out[("Dublin", 2017)].yoy_change_pct == 7.87 and out[("Dublin", 2018)].yoy_change_pct == 8.04
    assert out[("Dublin", 2017)].sample_count == 1 and out[("Cork", 2018)].yoy_change_pct == 10.0


def test_permissions_trend(spark):
    rows = [(2019, 100.0, PERMISSIONS_CONSTRUCTION, PERMISSIONS_STATISTIC),
            (2019, 50.0, PERMISSIONS_CONSTRUCTION, PERMISSIONS_STATISTIC),
            (2020, 120.0, PERMISSIONS_CONSTRUCTION, PERMISSIONS_STATISTIC),
            (2020, 999.0, "Extension", PERMISSIONS_STATISTIC)]
    df = spark.createDataFrame(rows, "year int, metric_value double, type_of_construction string, statistic string")
    out = [(r.year, r.new_communal_permissions, r.yoy_change, r.yoy_change_pct, r.estimated_annual_need)
           for r in gold.permissions_trend(df, RUN).orderBy("year").collect()]
    assert out == [(2019, 150.0, None, None, 35000), (2020, 120.0, -30.0, -20.0, 35000)]


def sales_rows(spark):
    rows = [(2020, 350000.0, "New Dwelling house /Apartment"), (2020, 280000.0, "Second-Hand Dwelling"),
            (2020, 420000.0, "NEW DWELLING HOUSE"), (2020, 310000.0, None), (2021, 400000.0, "Second-Hand"),
            (2021, None, "Second-Hand")]
    return spark.createDataFrame(rows, "year int, price_eur double, property_description string")


def test_property_sales_both_shapes(spark):
    for single in (True, False):
        out = {r.year: r for r in gold.property_sales(sales_rows(spark), RUN, single_pass=single).collect()}
        a, b = out[2020], out[2021]
        assert (a.total_sales, a.new_build_sales, a.new_build_avg_price, a.second_hand_sales) == (4, 2, 385000.0, 2)
        assert (a.median_price_eur, a.min_price_eur, a.max_price_eur) == (310000.0, 280000.0, 420000.0)
        assert (b.total_sales, b.new_build_sales, b.second_hand_sales) == (1, None, 1)
        assert b.yoy_price_change_pct == round((400000 - 340000) / 340000 * 100, 2)
        assert a.county == "Dublin"


def test_crisis_summary(spark):
    price = gold.price_index(price_rows(spark), RUN)
    rent = gold.rent_trends(rent_rows(spark), RUN)
    perms = spark.createDataFrame([(2015, 10.0, None)], "year int, new_communal_permissions double, "
                                                        "yoy_change_pct double")
    sales = gold.property_sales(sales_rows(spark), RUN)
    out = {r.year: r for r in gold.crisis_summary(price, rent, perms, sales, RUN).collect()}
    # spine: national price years with December (2023, 2024), rents 2016-2018, permissions 2015, sales 2020-21
    assert sorted(out) == [2015, 2016, 2017, 2018, 2020, 2021, 2023, 2024]
    assert out[2024].national_price_index == 163.6 and out[2024].dublin_price_index == 163.6
    assert out[2017].avg_national_rent == round((1516.98 + 1000.0) / 2, 2)
    assert out[2017].avg_dublin_rent == 1516.98 and out[2016].avg_national_rent == 1406.27
    assert out[2020].dublin_total_sales == 4 and out[2015].new_communal_permissions == 10.0
    assert 2025 not in out  # June only: no December reading, not in the spine


def test_summary_latest_month_option(spark):
    price = gold.price_index(price_rows(spark), RUN)
    rent = gold.rent_trends(rent_rows(spark), RUN)
    perms = spark.createDataFrame([(2025, 1.0, None)], "year int, new_communal_permissions double, "
                                                       "yoy_change_pct double")
    sales = gold.property_sales(sales_rows(spark), RUN)
    out = {r.year: r for r in gold.crisis_summary(price, rent, perms, sales, RUN, year_end_month=None).collect()}
    assert out[2025].national_price_index == 170.0  # June is 2025's latest reading
    assert out[2024].national_price_index == 163.6


def test_cube_without_time_dimension_has_null_year(spark):
    import json

    from strata.plans.silver import cube_silver
    doc = {"id": ["A"], "size": [2], "value": [1, 2],
           "dimension": {"A": {"label": "Area", "category": {"index": ["x", "y"]}}}}
    docs = spark.createDataFrame([("d", json.dumps(doc))], "path string, body string")
    silver, rejects = cube_silver(docs, "T", RUN)
    rows = sorted((r.area, r.metric_value, r.year) for r in silver.collect())
    assert rows == [("x", 1.0, None), ("y", 2.0, None)] and rejects.count() == 0
