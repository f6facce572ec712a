"""Silver -> Gold marts.

Each builder takes Silver DataFrames and returns the Gold DataFrame; its
filter values default to the source marts' fixed values and can be
overridden, so the same plans run on any table of the same shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.fixed_values import (DUBLIN_ALL, DUBLIN_NEEDLE, ESTIMATED_ANNUAL_NEED,
                                 KEY_PROPERTY_TYPES, NATIONAL_ALL, PERMISSIONS_CONSTRUCTION,
                                 PERMISSIONS_STATISTIC, PRICE_STATISTICS, RENT_ALL_BEDROOMS,
                                 RENT_ALL_PROPERTY_TYPES, SALE_CLASS_NEW, SALE_CLASS_OTHER,
                                 SALES_COUNTY)
from strata.functions.values import classify, contains_ci, lookup, month_of_period
from strata.operators.aggregates import (MEDIAN_ACCURACY, class_slices, conditional_aggs,
                                         group_stats, headline_aggs, headline_stats,
                                         pivot_wide, sum_by)
from strata.operators.selection import with_exact_median
from strata.operators.spine import spine_join, spine_merge
from strata.operators.trends import yoy

SALE_CLASSES = {SALE_CLASS_NEW: ("new_build_sales", "new_build_avg_price"),
                SALE_CLASS_OTHER: ("second_hand_sales", "second_hand_avg_price")}


def _equal_all(filters: dict[str, str]):
    cond = F.lit(True)
    for col, val in filters.items():
        cond = cond & (F.col(col) == F.lit(val))
    return cond


def price_index(silver: DataFrame, run_date: str, key_types: list[str] = KEY_PROPERTY_TYPES,
                statistics: dict[str, str] = PRICE_STATISTICS,
                type_col: str = "type_of_residential_property") -> DataFrame:
    """One row per period x property type, one column per statistic (T4).

    F1 ``isin`` on the key types (pushed to the Parquet scan), a literal-map
    statistic -> column name, a pivot with the fixed column list, the month
    number from the period label.  A statistic outside the map keeps its
    row group with null cells.
    """
    df = silver.filter(F.col(type_col).isin(key_types)) \
        .withColumn("stat_key", lookup("statistic", statistics))
    wide = pivot_wide(df, ["period", "year", type_col], "stat_key", "metric_value",
                      list(statistics.values()), digits=2)
    return wide.withColumns({"month": month_of_period("period"), "gold_updated": F.lit(run_date)})


def rent_trends(silver: DataFrame, run_date: str,
                filters: dict[str, str] | None = None) -> DataFrame:
    """Headline rent per location x year with year-on-year change (T5)."""
    filters = filters if filters is not None else {
        "number_of_bedrooms": RENT_ALL_BEDROOMS, "property_type": RENT_ALL_PROPERTY_TYPES}
    stats = group_stats(silver.filter(_equal_all(filters)), ["location", "year"], "value",
                        avg="avg_monthly_rent", min="min_monthly_rent",
                        max="max_monthly_rent", count="sample_count")
    return yoy(stats, "avg_monthly_rent", "year", ["location"], pct="yoy_change_pct") \
        .withColumn("gold_updated", F.lit(run_date))


def permissions_trend(silver: DataFrame, run_date: str, filters: dict[str, str] | None = None,
                      annual_need: int = ESTIMATED_ANNUAL_NEED) -> DataFrame:
    """Yearly permission total with absolute and percent change.

    The window runs over the yearly aggregate (one row per year), so the
    single-task global window sees at most a few hundred rows.
    """
    filters = filters if filters is not None else {
        "type_of_construction": PERMISSIONS_CONSTRUCTION, "statistic": PERMISSIONS_STATISTIC}
    yearly = sum_by(silver.filter(_equal_all(filters)), ["year"], "metric_value",
                    "new_communal_permissions", digits=0)
    trend = yoy(yearly, "new_communal_permissions", "year", change="yoy_change",
                pct="yoy_change_pct", aggregated=True)
    return trend.withColumns({"estimated_annual_need": F.lit(annual_need),
                              "gold_updated": F.lit(run_date)})


def property_sales(silver: DataFrame, run_date: str, single_pass: bool = True,
                   county: str = SALES_COUNTY, accuracy: int = MEDIAN_ACCURACY,
                   exact_median: bool = False) -> DataFrame:
    """Yearly sales headline, YoY and new / second-hand breakdown.

    ``single_pass`` computes the class breakdown with conditional
    aggregates inside the headline aggregation -- one shuffle (A6); otherwise the
    source mart's shape -- a year x class aggregate filtered twice and left
    joined back (A4, J1) -- is used.  Both give the same rows.
    ``exact_median`` replaces the sketched median by the exact one, for years of more
    than ``accuracy`` sales, at the cost of a second pass.
    """
    df = silver.withColumn("sale_type", classify("property_description"))
    names = {"count": "total_sales", "avg": "avg_price_eur", "median": "median_price_eur",
             "min": "min_price_eur", "max": "max_price_eur"}
    if single_pass:
        annual = df.groupBy("year").agg(
            *headline_aggs("price_eur", names, digits=0, accuracy=accuracy),
            *conditional_aggs("price_eur", "sale_type", SALE_CLASSES, digits=0))
    else:
        annual = headline_stats(df, ["year"], "price_eur", names, digits=0, accuracy=accuracy)
        slices = class_slices(df, ["year"], "price_eur", "sale_type", SALE_CLASSES, digits=0)
        annual = spine_join(annual, list(slices.values()), "year")
    if exact_median:
        annual = with_exact_median(annual, df, ["year"], "price_eur", "median_price_eur", digits=0)
    annual = yoy(annual, "avg_price_eur", "year", pct="yoy_price_change_pct", aggregated=True)
    return annual.withColumns({"county": F.lit(county), "gold_updated": F.lit(run_date)})


def crisis_summary(price: DataFrame, rent: DataFrame, perms: DataFrame, sales: DataFrame,
                   run_date: str, national: str = NATIONAL_ALL, dublin: str = DUBLIN_ALL,
                   dublin_needle: str = DUBLIN_NEEDLE, year_end_month: int | None = 12,
                   type_col: str = "type_of_residential_property") -> DataFrame:
    """One row per year joining the four marts onto a year spine.

    Price readings are the December row of each year (A9; a year without
    December has none; ``year_end_month=None`` takes each year's latest
    month instead); rents are unweighted means of location means, overall
    and for locations containing ``dublin_needle`` (A7, A8).  The spine is
    the years of national price, national rent, permissions and sales (U2);
    the four per-year frames are merged onto it (J2) in one aggregation.
    """
    # National and Dublin readings in one aggregate per mart: the year-end
    # row of each type is the max of a (month, values) struct, so a year
    # without that month has none, and each mart is scanned once.
    price_rows = price.filter(F.col(type_col).isin(national, dublin))
    if year_end_month is not None:
        price_rows = price_rows.filter(F.col("month") == F.lit(year_end_month))
    is_nat, is_dub = F.col(type_col) == F.lit(national), F.col(type_col) == F.lit(dublin)
    readings = price_rows.groupBy("year").agg(
        F.max(F.when(is_nat, F.struct("month", "price_index", "pct_change_12m"))).alias("_nat"),
        F.max(F.when(is_dub, F.struct("month", "price_index"))).alias("_dub"))
    prices = readings.select(
        "year", F.col("_nat.price_index").alias("national_price_index"),
        F.col("_nat.pct_change_12m").alias("national_price_yoy_pct"),
        F.col("_dub.price_index").alias("dublin_price_index"), F.col("_nat").isNotNull().alias("_has_nat"))
    rents = rent.groupBy("year").agg(
        F.round(F.avg("avg_monthly_rent"), 2).alias("avg_national_rent"),
        F.round(F.avg(F.when(contains_ci("location", dublin_needle), F.col("avg_monthly_rent"))), 2)
        .alias("avg_dublin_rent"))
    perms_slim = perms.select("year", "new_communal_permissions",
                              F.col("yoy_change_pct").alias("permissions_yoy_pct"))
    sales_slim = sales.select("year", F.col("total_sales").alias("dublin_total_sales"),
                              F.col("avg_price_eur").alias("dublin_avg_sale_price"),
                              F.col("median_price_eur").alias("dublin_median_sale_price"),
                              "yoy_price_change_pct")
    # every frame is per year: one union + aggregate instead of spine + 4 joins
    joined = spine_merge([prices, rents, perms_slim, sales_slim], "year",
                         in_spine=[F.col("_has_nat"), True, True, True]).drop("_has_nat")
    return joined.select(
        "year", "national_price_index", "national_price_yoy_pct", "dublin_price_index",
        "avg_national_rent", "avg_dublin_rent", "new_communal_permissions", "permissions_yoy_pct",
        "dublin_total_sales", "dublin_avg_sale_price", "dublin_median_sale_price",
        "yoy_price_change_pct", F.lit(run_date).alias("gold_updated"))
