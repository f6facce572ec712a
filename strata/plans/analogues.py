"""Section 2.14 queries: every operator exercised on the driver's tables.

Each query is ``fn(spark, sf_dir) -> DataFrame`` built only from the
library's public functions; :data:`ORACLES` holds the DuckDB SQL that must
give the same rows.  Round trips write to a fresh folder under the
session's checkpoint folder (shared storage on a cluster).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.fixed_values import (CSV_NAME_BLANKS, MISREAD_EURO, RENT_ALL_BEDROOMS, RENT_ALL_PROPERTY_TYPES, SALES_HEADER_PATTERNS,
                                 SALES_HEADER_SYNONYMS, SALES_MONEY_CHARS)
from strata.functions.coerce import add_lineage, coerce_strings, ensure_year
from strata.functions.names import clean_columns, drop_code_columns, rename_synonyms
from strata.functions.values import (chart_time, contains_ci, first_nonblank, first_year,
                                     keep_blank_or_no, lookup, month_of_period, parse_date,
                                     parse_money, parse_price, to_bigint)
from strata.operators import jsonstat
from strata.operators.aggregates import (group_stats, headline_stats, mean_of_means, period_end,
                                         sum_by)
from strata.operators.quality import (LANDING_FOLDERS, drop_nulls_observed, dropped_pct, latest_snapshot,
                                      null_count)
from strata.operators.spine import key_spine, spine_join, spine_merge, union_by_name
from strata.operators.trends import yoy
from strata.plans import fixtures, gold, jobs, views
from strata.plans.silver import cube_silver, read_sales, rents_silver, sales_silver
from strata.plans.sinks import (ensure_database, envelope, preview, register_external, sample_rows,
                                write_partitioned)
from strata.session import scratch_path
from strata.sources.documents import read_documents
from strata.sources.files import (LATIN1, land_raw, load_manifest, manifest_tally, newest_snapshot_files,
                                  read_csv_by_header, read_csv_explicit)

RUN_DATE = "2024-06-30"
RUN_YEAR = 2024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _land_docs(spark: SparkSession, docs: DataFrame, name: str) -> str:
    """Write documents to a Bronze-style drop folder; return its root."""
    root = scratch_path(spark, name)
    land_raw(docs.select(F.lit(name).alias("dataset"), F.lit(RUN_YEAR).alias("year"),
                         F.lit("06").alias("month"), "body"), root, fmt="text")
    return root


# --- N1-N8, T1: cube documents round trip ------------------------------------

def q_jsonstat_unpack(spark, sf_dir):
    docs = fixtures.orders_cube_docs(table(spark, sf_dir, "orders"))
    root = _land_docs(spark, docs, "orders_cube")
    silver, _ = cube_silver(read_documents(spark, root), "ORD01", RUN_DATE)
    return silver.select("statistic", "period", "order_priority", "metric_value",
                         "source_dataset", "ingestion_date", "year")


_ORDER_CELLS = """
  c AS (SELECT year(o_orderdate)::INT AS y, month(o_orderdate)::INT AS m, o_orderpriority AS p,
               count(*)::DOUBLE AS n, round(sum(o_totalprice), 2) AS s
        FROM orders GROUP BY ALL)"""

ORACLES = {
    "q_jsonstat_unpack": f"""
WITH {_ORDER_CELLS},
  g AS (SELECT a.y, a.m, b.p FROM (SELECT DISTINCT y, m FROM c) a
        JOIN (SELECT DISTINCT y, p FROM c) b ON a.y = b.y),
  st(k, statistic) AS (VALUES (0, 'Number of Orders'), (1, 'Total Order Value'))
SELECT st.statistic, strftime(make_date(g.y, g.m, 1), '%Y %B') AS period, g.p AS order_priority,
       CASE WHEN st.k = 0 THEN c.n ELSE c.s END AS metric_value,
       'ORD01' AS source_dataset, '{RUN_DATE}' AS ingestion_date, g.y AS year
FROM g CROSS JOIN st LEFT JOIN c ON c.y = g.y AND c.m = g.m AND c.p = g.p
""",
}

QUERIES = {
    "q_jsonstat_unpack": q_jsonstat_unpack,
}


# --- N2, S8, S9, P1-P11, F1-F3, 2.11 scalars ---------------------------------

def q_jsonstat_index_forms(spark, sf_dir):
    docs = fixtures.orders_cube_docs(table(spark, sf_dir, "orders"), by_status=True, vary_forms=True)
    root = _land_docs(spark, docs, "orders_status_cube")
    silver, _ = cube_silver(read_documents(spark, root), "ORD02", RUN_DATE)
    return silver.select("statistic", "period", "order_priority", "order_status", "metric_value", "year")


def q_json_rejects(spark, sf_dir):
    good = fixtures.orders_cube_docs(table(spark, sf_dir, "orders"))
    root = _land_docs(spark, fixtures.broken_docs(good), "orders_cube_mixed")
    parsed = jsonstat.parse(read_documents(spark, root).select("path", "body"))
    return (parsed.groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n_docs")))


def q_clean_columns(spark, sf_dir):
    awkward = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Customer Key"), F.col("c_name").alias(" Name (Full) "),
        F.col("c_nationkey").alias("Nation-Code"), F.col("c_acctbal").alias("Account/Balance"),
        F.col("c_mktsegment").alias("Market Segment"))
    return clean_columns(awkward)


def q_drop_code_columns(spark, sf_dir):
    extract = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("STATISTIC"),
        F.col("c_mktsegment").alias("Statistic Label"),
        F.lit("2024").alias("TLIST(A1)"),
        F.col("c_nationkey").cast("string").alias("C02970V03592"),
        F.concat(F.lit("Nation "), F.col("c_nationkey")).alias("Nation Name"),
        F.lit("EUR").alias("UNIT"),
        F.col("c_acctbal").alias("Account Balance (EUR)"),
        F.col("c_custkey").alias("Customer-Key/ID"))
    return clean_columns(drop_code_columns(extract), CSV_NAME_BLANKS)


def q_lineage_columns(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return add_lineage(orders, "ORDERS", RUN_DATE, coverage="all", county="n/a")


def q_fallback_year(spark, sf_dir):
    with_text = table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("source"),
        F.concat(F.lit("FY"), F.year("o_orderdate"), F.lit("/Q"), F.quarter("o_orderdate")).alias("year"))
    without = table(spark, sf_dir, "customer").select(F.lit("customer").alias("source"))
    both = ensure_year(with_text, RUN_YEAR).unionByName(ensure_year(without, RUN_YEAR))
    return both.groupBy("source", "year").agg(F.count(F.lit(1)).alias("n"))


def q_coerce_strings(spark, sf_dir):
    text = table(spark, sf_dir, "lineitem").select(
        *[F.col(c).cast("string").alias(c) for c in
          ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")],
        F.when(F.col("l_returnflag") == "N", F.lit("")).otherwise(F.col("l_discount").cast("string"))
        .alias("l_discount"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"))
    return coerce_strings(text)


def q_chart_time(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    return (orders.groupBy("year").agg(F.count(F.lit(1)).alias("n_orders"))
            .withColumn("chart_time", chart_time("year")))


def q_in_list(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.filter(F.col("p_type").isin("ECONOMY", "SMALL", "STANDARD")) \
        .select("p_partkey", "p_type", "p_retailprice")


def q_conjunct(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")) \
        .select("o_orderkey", "o_totalprice")


EVENT_FLAGS = {"view": "No", "click": "NO", "purchase": "", "signup": " no"}


def q_keep_blank_or_no(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn(
        "flag", F.when(F.col("value") >= 450, F.lit("Yes")).otherwise(lookup("event_type", EVENT_FLAGS)))
    return events.filter(keep_blank_or_no("flag")).select("event_id", "event_type", "flag")


def _order_date_text():
    d = F.col("o_orderdate")
    return (F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format(d, "d M yyyy"))
            .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit(" "), F.date_format(d, "d MM yyyy"), F.lit(" ")))
            .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format(d, "dd/MM/yyyy"))
            .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.date_format(d, "d/MM/yyyy"))
            .otherwise(F.date_format(d, "yyyy")))


def q_valid_dates(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", parse_date(_order_date_text()).alias("date_of_sale"))
    kept, _ = drop_nulls_observed(orders, "date_of_sale")
    return kept.withColumns({"year": F.year("date_of_sale"), "month": F.month("date_of_sale")})


def _price_text():
    price = F.format_number("p_retailprice", 2)
    return (F.when(F.col("p_partkey") % 7 == 0, F.concat(F.lit("N/A "), price))       # no number: null
            .when(F.col("p_partkey") % 7 == 1, F.concat(price, F.lit(" (est 2)")))
            .when(F.col("p_partkey") % 7 == 2, F.concat(F.lit(MISREAD_EURO), price))
            .when(F.col("p_type") == "ECONOMY", F.concat(F.lit("€"), price))
            .when(F.col("p_type") == "SMALL", F.concat(F.lit("\x80"), price))
            .otherwise(F.concat(F.lit("? "), F.regexp_replace(price, ",", " "))))


def q_money_clean(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", parse_price(_price_text()).alias("price_eur"))


def q_first_nonblank(spark, sf_dir):
    seg = F.col("c_mktsegment")
    eircode = (F.when(seg.isin("BUILDING", "MACHINERY"),
                      F.concat(F.lit("D"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"),
                               F.lit(" "), F.substring("c_name", -4, 4)))
               .when(seg == "FURNITURE", F.lit("")))
    postal = F.when(seg != "AUTOMOBILE", F.concat(F.lit("Dublin "), F.col("c_nationkey")))
    customer = table(spark, sf_dir, "customer")
    return customer.select("c_custkey", first_nonblank(eircode, postal).alias("location_code"))


def q_month_map(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy MMMM").alias("period"))
    return orders.select("o_orderkey", first_year("period").alias("year"),
                         month_of_period("period").alias("month"))


ORACLES.update({
    "q_jsonstat_index_forms": f"""
WITH c AS (SELECT year(o_orderdate)::INT AS y, o_orderstatus AS t, month(o_orderdate)::INT AS m,
                  o_orderpriority AS p, count(*)::DOUBLE AS n, round(sum(o_totalprice), 2) AS s
           FROM orders GROUP BY ALL),
  g AS (SELECT a.y, a.t, a.m, b.p FROM (SELECT DISTINCT y, t, m FROM c) a
        JOIN (SELECT DISTINCT y, t, p FROM c) b ON a.y = b.y AND a.t = b.t),
  st(k, statistic) AS (VALUES (0, 'Number of Orders'), (1, 'Total Order Value'))
SELECT st.statistic, strftime(make_date(g.y, g.m, 1), '%Y %B') AS period,
       CASE WHEN g.p = '5-LOW' THEN 'P5' ELSE g.p END AS order_priority,
       'Status ' || g.t AS order_status,
       CASE WHEN st.k = 0 THEN c.n ELSE c.s END AS metric_value, g.y AS year
FROM g CROSS JOIN st LEFT JOIN c ON c.y = g.y AND c.t = g.t AND c.m = g.m AND c.p = g.p
""",
    "q_json_rejects": """
SELECT r.reason, count(DISTINCT year(o_orderdate))::BIGINT AS n_docs
FROM orders CROSS JOIN (VALUES ('accepted'), ('error_reply'), ('malformed'), ('no_values'),
     ('shape_mismatch'), ('missing_dimension'), ('short_codes')) r(reason)
GROUP BY r.reason
""",
    "q_clean_columns": """
SELECT c_custkey AS customer_key, c_name AS name_full, c_nationkey AS nation_code,
       c_acctbal AS account_balance, c_mktsegment AS market_segment FROM customer
""",
    "q_drop_code_columns": """
SELECT c_mktsegment AS statistic_label, 'Nation ' || c_nationkey AS nation_name,
       c_acctbal AS account_balance_eur, c_custkey AS "customer-key/id" FROM customer
""",
    "q_lineage_columns": f"""
SELECT o_orderkey, o_totalprice, 'ORDERS' AS source_dataset, '{RUN_DATE}' AS ingestion_date,
       'all' AS coverage, 'n/a' AS county FROM orders
""",
    "q_fallback_year": f"""
SELECT 'orders' AS source, year(o_orderdate)::INT AS year, count(*)::BIGINT AS n FROM orders GROUP BY 2
UNION ALL
SELECT 'customer', {RUN_YEAR}, count(*)::BIGINT FROM customer
""",
    "q_coerce_strings": """
SELECT l_orderkey::BIGINT AS l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_quantity,
       l_extendedprice, l_returnflag,
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_discount END AS l_discount,
       strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
FROM lineitem
""",
    "q_chart_time": """
SELECT year(o_orderdate)::INT AS year, count(*)::BIGINT AS n_orders,
       make_date(year(o_orderdate)::INT, 1, 1) AS chart_time
FROM orders GROUP BY 1
""",
    "q_in_list": """
SELECT p_partkey, p_type, p_retailprice FROM part WHERE p_type IN ('ECONOMY', 'SMALL', 'STANDARD')
""",
    "q_conjunct": """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
""",
    "q_keep_blank_or_no": """
WITH e AS (SELECT event_id, event_type,
                  CASE WHEN value >= 450 THEN 'Yes'
                       WHEN event_type = 'view' THEN 'No' WHEN event_type = 'click' THEN 'NO'
                       WHEN event_type = 'purchase' THEN '' WHEN event_type = 'signup' THEN ' no'
                  END AS flag FROM events)
SELECT event_id, event_type, flag FROM e WHERE upper(flag) IN ('NO', '') OR flag IS NULL
""",
    "q_valid_dates": """
SELECT o_orderkey, o_orderdate::DATE AS date_of_sale, year(o_orderdate)::INT AS year,
       month(o_orderdate)::INT AS month
FROM orders WHERE o_orderpriority <> '5-LOW'
""",
    "q_money_clean": """
SELECT p_partkey, CASE WHEN p_partkey % 7 > 1 THEN round(p_retailprice, 2) END AS price_eur FROM part
""",
    "q_first_nonblank": """
SELECT c_custkey, coalesce(
    nullif(CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY')
                  THEN 'D' || lpad(c_nationkey::VARCHAR, 2, '0') || ' ' || right(c_name, 4)
                WHEN c_mktsegment = 'FURNITURE' THEN '' END, ''),
    nullif(CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN 'Dublin ' || c_nationkey END, '')) AS location_code
FROM customer
""",
    "q_month_map": """
SELECT o_orderkey, year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month FROM orders
""",
})

QUERIES.update({
    "q_jsonstat_index_forms": q_jsonstat_index_forms,
    "q_json_rejects": q_json_rejects,
    "q_clean_columns": q_clean_columns,
    "q_drop_code_columns": q_drop_code_columns,
    "q_lineage_columns": q_lineage_columns,
    "q_fallback_year": q_fallback_year,
    "q_coerce_strings": q_coerce_strings,
    "q_chart_time": q_chart_time,
    "q_in_list": q_in_list,
    "q_conjunct": q_conjunct,
    "q_keep_blank_or_no": q_keep_blank_or_no,
    "q_valid_dates": q_valid_dates,
    "q_money_clean": q_money_clean,
    "q_first_nonblank": q_first_nonblank,
    "q_month_map": q_month_map,
})


RENT_NEEDLE = "e"      # analog of the Dublin filter on rent locations (priorities)
DUBLIN_ANALOG = "high"  # analog location holding the "Dublin" rents in the summary


# --- A1-A11, W1-W4, J1, J2, U2, T4-T8 -------------------------------------------

def _orders_y(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))


def q_group_stats(spark, sf_dir):
    return group_stats(_orders_y(spark, sf_dir), ["o_orderpriority", "year"], "o_totalprice",
                       avg="avg_price", min="min_price", max="max_price", count="n_orders")


def q_pivot_wide(spark, sf_dir):
    return gold.price_index(fixtures.price_silver(table(spark, sf_dir, "orders")), RUN_DATE)


def q_yoy_by_key(spark, sf_dir):
    return gold.rent_trends(fixtures.rents_silver(table(spark, sf_dir, "orders")), RUN_DATE)


def q_sum_by_year(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate"))
    return sum_by(lines, ["year"], "l_quantity", "total_quantity", digits=0)


def q_abs_change(spark, sf_dir):
    return gold.permissions_trend(fixtures.permissions_silver(table(spark, sf_dir, "lineitem")), RUN_DATE)


def q_median_by_year(spark, sf_dir):
    return headline_stats(_orders_y(spark, sf_dir), ["year"], "o_totalprice",
                          {"count": "n_orders", "avg": "avg_price", "median": "median_price",
                           "min": "min_price", "max": "max_price"}, digits=2)


def q_left_slices(spark, sf_dir):
    return gold.property_sales(fixtures.sales_silver(table(spark, sf_dir, "orders")), RUN_DATE,
                               single_pass=False)


def q_conditional_agg(spark, sf_dir):
    return gold.property_sales(fixtures.sales_silver(table(spark, sf_dir, "orders")), RUN_DATE,
                               single_pass=True)


def _rent_gold(spark, sf_dir):
    return gold.rent_trends(fixtures.rents_silver(table(spark, sf_dir, "orders")), RUN_DATE)


def q_mean_of_means(spark, sf_dir):
    return mean_of_means(_rent_gold(spark, sf_dir), ["year"], "avg_monthly_rent", "avg_national_rent")


def q_filtered_mean(spark, sf_dir):
    rents = _rent_gold(spark, sf_dir).filter(contains_ci("location", RENT_NEEDLE))
    return mean_of_means(rents, ["year"], "avg_monthly_rent", "avg_filtered_rent")


def _monthly_orders(spark, sf_dir):
    return (table(spark, sf_dir, "orders")
            .groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
            .agg(F.round(F.sum("o_totalprice"), 2).alias("total_value")))


def q_year_end_snapshot(spark, sf_dir):
    monthly = _monthly_orders(spark, sf_dir)
    latest = period_end(monthly, ["year"], "month", ["total_value"], at=None)
    december = period_end(monthly, ["year"], "month", ["total_value"], at=12) \
        .withColumnRenamed("total_value", "december_value")
    return spine_join(latest, [december], "year")


def q_yoy_global(spark, sf_dir):
    yearly = (_orders_y(spark, sf_dir).groupBy("year")
              .agg(F.round(F.sum("o_totalprice"), 2).alias("total_value")))
    return yoy(yearly, "total_value", "year", pct="yoy_pct", change="yoy_change",
               change_digits=2, aggregated=True)


def q_year_spine_summary(spark, sf_dir):
    o = (_orders_y(spark, sf_dir).groupBy("year")
         .agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("order_value")))
    li = (table(spark, sf_dir, "lineitem").groupBy(F.year("l_shipdate").alias("year"))
          .agg(F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_quantity"), 0).alias("quantity")))
    ev = (table(spark, sf_dir, "events").groupBy(F.year("ts").alias("year"))
          .agg(F.count(F.lit(1)).alias("n_events")))
    return spine_join(key_spine([o, li, ev], "year"), [o, li, ev], "year")


def q_gold_summary(spark, sf_dir):
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    price = gold.price_index(fixtures.price_silver(orders), RUN_DATE)
    rent = gold.rent_trends(fixtures.rents_silver(orders), RUN_DATE)
    perms = gold.permissions_trend(fixtures.permissions_silver(lineitem), RUN_DATE)
    sales = gold.property_sales(fixtures.sales_silver(orders), RUN_DATE)
    return gold.crisis_summary(price, rent, perms, sales, RUN_DATE, dublin_needle=DUBLIN_ANALOG)


_PRICE_SILVER = """
  ps AS (SELECT year(o_orderdate)::INT AS year, strftime(o_orderdate, '%Y %B') AS period,
                month(o_orderdate)::INT AS m,
                CASE o_orderpriority WHEN '1-URGENT' THEN 'National - all residential properties'
                     WHEN '2-HIGH' THEN 'Dublin - all residential properties'
                     WHEN '3-MEDIUM' THEN 'National - houses'
                     WHEN '4-NOT SPECIFIED' THEN 'Fingal - houses'
                     WHEN '5-LOW' THEN 'Dublin - apartments' END AS t,
                CASE o_orderstatus WHEN 'F' THEN 'Residential Property Price Index'
                     WHEN 'O' THEN 'Percentage Change over 1 month for Residential Property Price Index'
                     WHEN 'P' THEN 'Percentage Change over 3 months for Residential Property Price Index'
                END AS statistic,
                round(sum(o_totalprice) / 10000, 2) AS v
         FROM orders GROUP BY ALL),
  pg AS (SELECT period, year, t AS type_of_residential_property,
           round(max(v) FILTER (WHERE statistic = 'Residential Property Price Index'), 2) AS price_index,
           round(max(v) FILTER (WHERE statistic = 'Percentage Change over 1 month for Residential Property Price Index'), 2) AS pct_change_1m,
           round(max(v) FILTER (WHERE statistic = 'Percentage Change over 3 months for Residential Property Price Index'), 2) AS pct_change_3m,
           round(max(v) FILTER (WHERE statistic = 'Percentage Change over 12 months for Residential Property Price Index'), 2) AS pct_change_12m,
           any_value(m) AS month, '""" + RUN_DATE + """' AS gold_updated
         FROM ps WHERE t IN ('National - all residential properties', 'National - houses',
              'National - apartments', 'Dublin - all residential properties', 'Dublin - houses',
              'Dublin - apartments')
         GROUP BY period, year, t)"""

_RENT_GOLD = """
  rg0 AS (SELECT o_orderpriority AS location, year(o_orderdate)::INT AS year,
                 round(avg(o_totalprice), 2) AS avg_monthly_rent, round(min(o_totalprice), 2) AS min_monthly_rent,
                 round(max(o_totalprice), 2) AS max_monthly_rent, count(o_totalprice)::BIGINT AS sample_count
          FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2),
  rg AS (SELECT *, round((avg_monthly_rent - lag(avg_monthly_rent) OVER w)
                         / nullif(lag(avg_monthly_rent) OVER w, 0) * 100, 2) AS yoy_change_pct,
                '""" + RUN_DATE + """' AS gold_updated
         FROM rg0 WINDOW w AS (PARTITION BY location ORDER BY year))"""

_PERMS_GOLD = """
  py AS (SELECT year(l_shipdate)::INT AS year, round(sum(l_quantity), 0) AS new_communal_permissions
         FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus = 'O' GROUP BY 1),
  pm AS (SELECT year, new_communal_permissions,
                round(new_communal_permissions - lag(new_communal_permissions) OVER w, 0) AS yoy_change,
                round((new_communal_permissions - lag(new_communal_permissions) OVER w)
                      / nullif(lag(new_communal_permissions) OVER w, 0) * 100, 2) AS yoy_change_pct,
                35000 AS estimated_annual_need, '""" + RUN_DATE + """' AS gold_updated
         FROM py WINDOW w AS (ORDER BY year))"""

_SALES_GOLD = """
  ss AS (SELECT year(o_orderdate)::INT AS year, o_totalprice AS p,
                CASE WHEN o_orderpriority <> '5-LOW' AND o_orderstatus IN ('O', 'P')
                     THEN 'New' ELSE 'Second-Hand' END AS c FROM orders),
  sa AS (SELECT year, count(p)::BIGINT AS total_sales, round(avg(p), 0) AS avg_price_eur,
                round(quantile_disc(p, 0.5), 0) AS median_price_eur, round(min(p), 0) AS min_price_eur,
                round(max(p), 0) AS max_price_eur,
                CASE WHEN count(*) FILTER (WHERE c = 'New') > 0
                     THEN count(p) FILTER (WHERE c = 'New') END::BIGINT AS new_build_sales,
                round(avg(p) FILTER (WHERE c = 'New'), 0) AS new_build_avg_price,
                CASE WHEN count(*) FILTER (WHERE c = 'Second-Hand') > 0
                     THEN count(p) FILTER (WHERE c = 'Second-Hand') END::BIGINT AS second_hand_sales,
                round(avg(p) FILTER (WHERE c = 'Second-Hand'), 0) AS second_hand_avg_price
         FROM ss GROUP BY year),
  sg AS (SELECT *, round((avg_price_eur - lag(avg_price_eur) OVER w)
                         / nullif(lag(avg_price_eur) OVER w, 0) * 100, 2) AS yoy_price_change_pct,
                'Dublin' AS county, '""" + RUN_DATE + """' AS gold_updated
         FROM sa WINDOW w AS (ORDER BY year))"""

def _summary_sql(sales_ctes: str) -> str:
    """Oracle of the summary mart over the analog marts; ``sales_ctes`` defines ``sg``."""
    return f"""
WITH {_PRICE_SILVER}, {_RENT_GOLD}, {_PERMS_GOLD}, {sales_ctes},
  nat AS (SELECT year, price_index AS national_price_index, pct_change_12m AS national_price_yoy_pct
          FROM pg WHERE type_of_residential_property = 'National - all residential properties' AND month = 12),
  dub AS (SELECT year, price_index AS dublin_price_index
          FROM pg WHERE type_of_residential_property = 'Dublin - all residential properties' AND month = 12),
  nr AS (SELECT year, round(avg(avg_monthly_rent), 2) AS avg_national_rent FROM rg GROUP BY year),
  dr AS (SELECT year, round(avg(avg_monthly_rent), 2) AS avg_dublin_rent FROM rg
         WHERE contains(lower(location), '{DUBLIN_ANALOG}') GROUP BY year),
  spine AS (SELECT year FROM nat UNION SELECT year FROM nr UNION SELECT year FROM pm UNION SELECT year FROM sg)
SELECT spine.year, nat.national_price_index, nat.national_price_yoy_pct, dub.dublin_price_index,
       nr.avg_national_rent, dr.avg_dublin_rent, pm.new_communal_permissions,
       pm.yoy_change_pct AS permissions_yoy_pct, sg.total_sales AS dublin_total_sales,
       sg.avg_price_eur AS dublin_avg_sale_price, sg.median_price_eur AS dublin_median_sale_price,
       sg.yoy_price_change_pct, '{RUN_DATE}' AS gold_updated
FROM spine LEFT JOIN nat ON nat.year = spine.year LEFT JOIN dub ON dub.year = spine.year
     LEFT JOIN nr ON nr.year = spine.year LEFT JOIN dr ON dr.year = spine.year
     LEFT JOIN pm ON pm.year = spine.year LEFT JOIN sg ON sg.year = spine.year
"""


ORACLES.update({
    "q_group_stats": """
SELECT o_orderpriority, year(o_orderdate)::INT AS year, round(avg(o_totalprice), 2) AS avg_price,
       round(min(o_totalprice), 2) AS min_price, round(max(o_totalprice), 2) AS max_price,
       count(o_totalprice)::BIGINT AS n_orders
FROM orders GROUP BY 1, 2
""",
    "q_pivot_wide": f"WITH {_PRICE_SILVER} SELECT * FROM pg",
    "q_yoy_by_key": f"WITH {_RENT_GOLD} SELECT * FROM rg",
    "q_sum_by_year": """
SELECT year(l_shipdate)::INT AS year, round(sum(l_quantity), 0) AS total_quantity FROM lineitem GROUP BY 1
""",
    "q_abs_change": f"WITH {_PERMS_GOLD} SELECT * FROM pm",
    "q_median_by_year": """
SELECT year(o_orderdate)::INT AS year, count(o_totalprice)::BIGINT AS n_orders,
       round(avg(o_totalprice), 2) AS avg_price, round(quantile_disc(o_totalprice, 0.5), 2) AS median_price,
       round(min(o_totalprice), 2) AS min_price, round(max(o_totalprice), 2) AS max_price
FROM orders GROUP BY 1
""",
    "q_left_slices": f"WITH {_SALES_GOLD} SELECT * FROM sg",
    "q_conditional_agg": f"WITH {_SALES_GOLD} SELECT * FROM sg",
    "q_mean_of_means": f"""WITH {_RENT_GOLD}
SELECT year, round(avg(avg_monthly_rent), 2) AS avg_national_rent FROM rg GROUP BY year""",
    "q_filtered_mean": f"""WITH {_RENT_GOLD}
SELECT year, round(avg(avg_monthly_rent), 2) AS avg_filtered_rent FROM rg
WHERE contains(lower(location), '{RENT_NEEDLE}') GROUP BY year""",
    "q_year_end_snapshot": """
WITH m AS (SELECT year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month,
                  round(sum(o_totalprice), 2) AS total_value FROM orders GROUP BY 1, 2)
SELECT year, max(month) AS month, arg_max(total_value, month) AS total_value,
       max(total_value) FILTER (WHERE month = 12) AS december_value
FROM m GROUP BY year
""",
    "q_yoy_global": """
WITH y AS (SELECT year(o_orderdate)::INT AS year, round(sum(o_totalprice), 2) AS total_value
           FROM orders GROUP BY 1)
SELECT year, total_value, round(total_value - lag(total_value) OVER w, 2) AS yoy_change,
       round((total_value - lag(total_value) OVER w) / nullif(lag(total_value) OVER w, 0) * 100, 2) AS yoy_pct
FROM y WINDOW w AS (ORDER BY year)
""",
    "q_year_spine_summary": """
WITH o AS (SELECT year(o_orderdate)::INT AS year, count(*)::BIGINT AS n_orders,
                  round(sum(o_totalprice), 2) AS order_value FROM orders GROUP BY 1),
     l AS (SELECT year(l_shipdate)::INT AS year, count(*)::BIGINT AS n_lines,
                  round(sum(l_quantity), 0) AS quantity FROM lineitem GROUP BY 1),
     e AS (SELECT year(ts)::INT AS year, count(*)::BIGINT AS n_events FROM events GROUP BY 1),
     s AS (SELECT year FROM o UNION SELECT year FROM l UNION SELECT year FROM e)
SELECT s.year, o.n_orders, o.order_value, l.n_lines, l.quantity, e.n_events
FROM s LEFT JOIN o ON o.year = s.year LEFT JOIN l ON l.year = s.year LEFT JOIN e ON e.year = s.year
""",
    "q_gold_summary": _summary_sql(_SALES_GOLD),
})

QUERIES.update({
    "q_group_stats": q_group_stats,
    "q_pivot_wide": q_pivot_wide,
    "q_yoy_by_key": q_yoy_by_key,
    "q_sum_by_year": q_sum_by_year,
    "q_abs_change": q_abs_change,
    "q_median_by_year": q_median_by_year,
    "q_left_slices": q_left_slices,
    "q_conditional_agg": q_conditional_agg,
    "q_mean_of_means": q_mean_of_means,
    "q_filtered_mean": q_filtered_mean,
    "q_year_end_snapshot": q_year_end_snapshot,
    "q_yoy_global": q_yoy_global,
    "q_year_spine_summary": q_year_spine_summary,
    "q_gold_summary": q_gold_summary,
})


PART_SYNONYMS = {"Part Key": "p_partkey", "Name": "p_name", "Description": "description",
                 **SALES_HEADER_SYNONYMS}


# --- S3-S11, K1-K7, T2, T3, V1-V4, D1 -------------------------------------------

def q_csv_latin1_roundtrip(spark, sf_dir):
    root = scratch_path(spark, "part_csv")
    fixtures.write_part_csv(table(spark, sf_dir, "part"), root)
    raw = rename_synonyms(read_csv_explicit(spark, root, encoding=LATIN1), PART_SYNONYMS,
                          SALES_HEADER_PATTERNS)
    return raw.select(to_bigint("p_partkey").alias("p_partkey"), "p_name",
                      "description", parse_money("price_raw", SALES_MONEY_CHARS).alias("price_eur"))


SALES_SILVER_COLUMNS = ["address", "county", "not_full_market_price", "vat_exclusive",
                        "property_description", "property_size", "location_code", "price_eur",
                        "date_of_sale", "year", "month", "source_dataset", "ingestion_date", "coverage"]


def _sales_from_csv(spark, sf_dir):
    root = scratch_path(spark, "sales_register")
    fixtures.write_sales_register(table(spark, sf_dir, "orders"), root)
    raw, _rejected = read_sales(spark, root)
    silver, _obs = sales_silver(raw, RUN_DATE)
    return silver


def q_csv_mixed_headers(spark, sf_dir):
    return _sales_from_csv(spark, sf_dir).select(*SALES_SILVER_COLUMNS)


def q_sales_gold_from_csv(spark, sf_dir):
    return gold.property_sales(_sales_from_csv(spark, sf_dir), RUN_DATE)


def q_rents_silver(spark, sf_dir):
    root = scratch_path(spark, "rent_extract")
    fixtures.write_rent_extract(table(spark, sf_dir, "orders"), root)
    return rents_silver(read_csv_explicit(spark, root), RUN_DATE, RUN_YEAR)


def q_manifest(spark, sf_dir):
    """Landing through land_raw in both layouts, dataset names with a blank, and the tally."""
    root = scratch_path(spark, "landing")
    orders = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("orders "), F.substring("o_orderpriority", 1, 1)).alias("dataset"),
        F.year("o_orderdate").alias("year"), F.lit("06").alias("month"), "o_orderkey", "o_totalprice", "o_orderstatus")
    land_raw(orders.drop("o_orderstatus"), root, fmt="csv")
    land_raw(orders.filter(F.col("o_orderstatus") == "F").drop("o_orderstatus"), root, fmt="csv", dataset_path="cso/fulfilled")
    expected = [f"orders {i}" for i in range(1, 7)] + ["cso/fulfilled"]
    manifest = load_manifest(spark, root, expected, glob="*.csv").persist()
    tally = manifest_tally(manifest.select("dataset", "status").distinct())
    return (manifest.groupBy("dataset", "status").agg(F.sum("row_count").alias("rows"))
            .unionByName(tally.select(F.lit("(tally)").alias("dataset"), "status", F.col("n").alias("rows"))))


def _orders_written(spark, sf_dir):
    path = scratch_path(spark, "orders_by_year")
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    write_partitioned(orders, path, ["year"], sort_by=["o_orderkey"])
    return path


def _year_totals(df):
    return (df.filter(F.col("year").between(1996, 1999)).groupBy("year")
            .agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("order_value")))


def q_partitioned_roundtrip(spark, sf_dir):
    path = _orders_written(spark, sf_dir)
    return _year_totals(spark.read.parquet(path))


def _new_database(spark, prefix):
    """A database of its own for each run: runs at once cannot drop each other's tables."""
    name = f"{prefix}_{uuid.uuid4().hex[:8]}"
    ensure_database(spark, name, scratch_path(spark, name))
    return name


def q_catalog_table(spark, sf_dir):
    path = _orders_written(spark, sf_dir)
    name = register_external(spark, _new_database(spark, "strata_checks"), "orders", path, spark.read.parquet(path))
    return _year_totals(spark.table(name))


def q_write_metrics(spark, sf_dir):
    """Counts observed on the write; low-priority orders have no date, so a null year."""
    orders = table(spark, sf_dir, "orders").withColumn(
        "year", F.when(F.col("o_orderpriority") != "5-LOW", F.year("o_orderdate")))
    obs = write_partitioned(orders, scratch_path(spark, "orders_by_year"), ["year"], checks={
        "rows_written": F.count(F.lit(1)), "null_years": null_count("year"),
        "high_value": F.count_if(F.col("o_totalprice") > 400000)})
    return spark.createDataFrame([obs.get], "rows_written bigint, null_years bigint, high_value bigint")


def _sales_gold(spark, sf_dir):
    return gold.property_sales(fixtures.sales_silver(table(spark, sf_dir, "orders")), RUN_DATE)


def q_view_topk(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    silver = orders.select(
        F.concat(F.lit("Customer "), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("location"),
        # whole euros: a mean of cents can land on an exact half cent, where
        # decimal and binary rounding legitimately disagree
        F.year("o_orderdate").alias("year"), F.floor("o_totalprice").cast("double").alias("value"),
        F.lit(RENT_ALL_BEDROOMS).alias("number_of_bedrooms"),
        F.lit(RENT_ALL_PROPERTY_TYPES).alias("property_type"))
    rents_gold = gold.rent_trends(silver, RUN_DATE)
    # raw parameter as a request would carry it: quoted, padded
    return views.rents(rents_gold, location=" 'customer 0000001\" ", from_year="1996", to_year=2000, limit=500)


def q_view_summary(spark, sf_dir):
    return views.summary(q_gold_summary(spark, sf_dir), from_year="'1996'", to_year=" 2000")


def q_view_prices(spark, sf_dir):
    price = gold.price_index(fixtures.price_silver(table(spark, sf_dir, "orders")), RUN_DATE)
    return views.prices(price, type="National", from_year=1996, to_year=2001, limit=1000)


def q_view_sales(spark, sf_dir):
    return views.sales(_sales_gold(spark, sf_dir))


def q_json_envelope(spark, sf_dir):
    return envelope(views.sales(_sales_gold(spark, sf_dir), from_year=1990, to_year=2025),
                    "gold_property_sales_dublin", {"from_year": "1990", "to_year": "2025"})


def q_latest_snapshot(spark, sf_dir):
    root = scratch_path(spark, "snapshots")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    older = orders.filter(F.col("o_orderstatus") != "P") \
        .withColumn("o_totalprice", F.round(F.col("o_totalprice") * 0.9, 2))
    older.write.parquet(f"{root}/dataset=orders/snapshot=20240501T000000")
    orders.write.parquet(f"{root}/dataset=orders/snapshot=20240601T000000")
    both = spark.read.parquet(root)
    return latest_snapshot(both, ["dataset"], "snapshot").select("o_orderkey", "o_totalprice", "o_orderstatus")


_SALES_CSV_ROWS = f"""
  sr AS (SELECT 'Order ' || o_orderkey || ', Dublin' AS address, 'Dublin' AS county,
                'No' AS not_full_market_price, 'No' AS vat_exclusive,
                CASE o_orderstatus WHEN 'O' THEN 'New order' WHEN 'F' THEN 'Fulfilled order'
                     WHEN 'P' THEN 'Pending (renewed)' END AS property_description,
                NULL::VARCHAR AS property_size,
                CASE WHEN o_orderpriority = '1-URGENT' THEN NULL
                     ELSE 'D' || substr(o_orderpriority, 1, 1) END AS location_code,
                round(o_totalprice, 2) AS price_eur, o_orderdate::DATE AS date_of_sale,
                year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month,
                'PSRA_PPR' AS source_dataset, '{RUN_DATE}' AS ingestion_date, 'dublin' AS coverage
         FROM orders WHERE o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P')"""

_SALES_CSV_GOLD = _SALES_CSV_ROWS + """,
  sc AS (SELECT year, price_eur AS p,
                CASE WHEN contains(lower(property_description), 'new') THEN 'New' ELSE 'Second-Hand' END AS c
         FROM sr),
  sa AS (SELECT year, count(p)::BIGINT AS total_sales, round(avg(p), 0) AS avg_price_eur,
                round(quantile_disc(p, 0.5), 0) AS median_price_eur, round(min(p), 0) AS min_price_eur,
                round(max(p), 0) AS max_price_eur,
                CASE WHEN count(*) FILTER (WHERE c = 'New') > 0
                     THEN count(p) FILTER (WHERE c = 'New') END::BIGINT AS new_build_sales,
                round(avg(p) FILTER (WHERE c = 'New'), 0) AS new_build_avg_price,
                CASE WHEN count(*) FILTER (WHERE c = 'Second-Hand') > 0
                     THEN count(p) FILTER (WHERE c = 'Second-Hand') END::BIGINT AS second_hand_sales,
                round(avg(p) FILTER (WHERE c = 'Second-Hand'), 0) AS second_hand_avg_price
         FROM sc GROUP BY year),
  sg AS (SELECT *, round((avg_price_eur - lag(avg_price_eur) OVER w)
                         / nullif(lag(avg_price_eur) OVER w, 0) * 100, 2) AS yoy_price_change_pct,
                'Dublin' AS county, '""" + RUN_DATE + """' AS gold_updated
         FROM sa WINDOW w AS (ORDER BY year))"""

_YEAR_TOTALS = """
SELECT year(o_orderdate)::INT AS year, count(*)::BIGINT AS n_orders, round(sum(o_totalprice), 2) AS order_value
FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1999 GROUP BY 1
"""

ORACLES.update({
    "q_csv_latin1_roundtrip": """
SELECT p_partkey, p_name, p_name || ', "' || p_brand || '"' AS description,
       round(p_retailprice, 2) AS price_eur FROM part
""",
    "q_csv_mixed_headers": f"WITH {_SALES_CSV_ROWS} SELECT * FROM sr",
    "q_sales_gold_from_csv": f"WITH {_SALES_CSV_GOLD} SELECT * FROM sg",
    "q_rents_silver": f"""
SELECT 'RTB Average Monthly Rent Report' AS statistic_label, year(o_orderdate)::INT AS year,
       CASE WHEN o_orderstatus = 'F' THEN 'All bedrooms' ELSE 'One bed' END AS number_of_bedrooms,
       'All property types' AS property_type, o_orderpriority AS location, o_totalprice AS value,
       'RIA02' AS source_dataset, '{RUN_DATE}' AS ingestion_date
FROM orders
""",
    "q_manifest": """
SELECT 'orders ' || substr(o_orderpriority, 1, 1) AS dataset, 'success' AS status, count(*)::BIGINT AS rows
FROM orders GROUP BY 1
UNION ALL SELECT 'cso/fulfilled', 'success', count(*)::BIGINT FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'orders 6', 'failed', NULL::BIGINT
UNION ALL SELECT '(tally)', 'success', (1 + count(DISTINCT substr(o_orderpriority, 1, 1)))::BIGINT FROM orders
UNION ALL SELECT '(tally)', 'failed', 1::BIGINT
""",
    "q_partitioned_roundtrip": _YEAR_TOTALS,
    "q_catalog_table": _YEAR_TOTALS,
    "q_write_metrics": """
SELECT count(*)::BIGINT AS rows_written,
       (count(*) FILTER (WHERE o_orderpriority = '5-LOW'))::BIGINT AS null_years,
       (count(*) FILTER (WHERE o_totalprice > 400000))::BIGINT AS high_value FROM orders
""",
    "q_view_topk": """
WITH g0 AS (SELECT 'Customer ' || lpad(o_custkey::VARCHAR, 9, '0') AS location, year(o_orderdate)::INT AS year,
                   round(avg(floor(o_totalprice)), 2) AS avg_monthly_rent,
                   round(min(floor(o_totalprice)), 2) AS min_monthly_rent,
                   round(max(floor(o_totalprice)), 2) AS max_monthly_rent,
                   count(o_totalprice)::BIGINT AS sample_count
            FROM orders GROUP BY 1, 2),
     g AS (SELECT *, round((avg_monthly_rent - lag(avg_monthly_rent) OVER w)
                           / nullif(lag(avg_monthly_rent) OVER w, 0) * 100, 2) AS yoy_change_pct
           FROM g0 WINDOW w AS (PARTITION BY location ORDER BY year))
SELECT location, year, avg_monthly_rent, min_monthly_rent, max_monthly_rent, yoy_change_pct, sample_count
FROM g WHERE year BETWEEN 1996 AND 2000 AND contains(lower(location), 'customer 0000001')
ORDER BY location, year LIMIT 500
""",
    "q_view_summary": "SELECT * FROM (" + ORACLES["q_gold_summary"] + ") t WHERE year BETWEEN 1996 AND 2000",
    "q_view_prices": f"""WITH {_PRICE_SILVER}
SELECT period, year, month, type_of_residential_property, price_index, pct_change_1m, pct_change_3m,
       pct_change_12m
FROM pg WHERE year BETWEEN 1996 AND 2001 AND contains(lower(type_of_residential_property), 'national')
ORDER BY year, month, type_of_residential_property, period LIMIT 1000
""",
    "q_view_sales": f"""WITH {_SALES_GOLD}
SELECT year, total_sales, avg_price_eur, median_price_eur, min_price_eur, max_price_eur, new_build_sales,
       new_build_avg_price, second_hand_sales, second_hand_avg_price, yoy_price_change_pct, county
FROM sg
""",
    "q_latest_snapshot": "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders",
})

QUERIES.update({
    "q_csv_latin1_roundtrip": q_csv_latin1_roundtrip,
    "q_csv_mixed_headers": q_csv_mixed_headers,
    "q_sales_gold_from_csv": q_sales_gold_from_csv,
    "q_rents_silver": q_rents_silver,
    "q_manifest": q_manifest,
    "q_partitioned_roundtrip": q_partitioned_roundtrip,
    "q_catalog_table": q_catalog_table,
    "q_write_metrics": q_write_metrics,
    "q_view_topk": q_view_topk,
    "q_view_summary": q_view_summary,
    "q_view_prices": q_view_prices,
    "q_view_sales": q_view_sales,
    "q_json_envelope": q_json_envelope,
    "q_latest_snapshot": q_latest_snapshot,
})


# --- both batch jobs end to end, K6, F4, the incremental stream -----------------

def q_medallion_summary(spark, sf_dir):
    """Both batch jobs end to end on Bronze derived from orders and lineitem."""
    root, database = scratch_path(spark, "medallion"), _new_database(spark, "strata_medallion")
    fixtures.write_bronze(spark, table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"),
                          f"{root}/bronze")
    jobs.bronze_to_silver(spark, f"{root}/bronze", f"{root}/silver", RUN_DATE,
                          database=database)
    jobs.silver_to_gold(spark, f"{root}/silver", f"{root}/gold", RUN_DATE, database=database,
                        summary_options={"dublin_needle": DUBLIN_ANALOG})
    return views.summary(spark.table(f"{database}.gold_housing_crisis_summary"))


ORACLES["q_medallion_summary"] = (
    "SELECT * FROM (" + _summary_sql(_SALES_CSV_GOLD) + ") t")
QUERIES["q_medallion_summary"] = q_medallion_summary


def q_preview(spark, sf_dir):
    """K6: first rows of a Gold table in a total order (a top-k, not a sort)."""
    return preview(gold.rent_trends(fixtures.rents_silver(table(spark, sf_dir, "orders")), RUN_DATE),
                   ["year", "location"], n=5)


def q_dropped_rows(spark, sf_dir):
    """rows kept, rows dropped and their share, observed on the one pass."""
    dates = table(spark, sf_dir, "orders").select(parse_date(_order_date_text()).alias("d"))
    kept, obs = drop_nulls_observed(dates, "d")
    kept.write.format("noop").mode("overwrite").save()
    m = obs.get
    return spark.createDataFrame([(m["rows_in"], m["rows_dropped"], round(dropped_pct(m), 2))],
                                 "rows_in bigint, rows_dropped bigint, dropped_pct double")


ORACLES.update({
    "q_preview": f"WITH {_RENT_GOLD} SELECT * FROM rg ORDER BY year, location LIMIT 5",
    "q_dropped_rows": """
SELECT count(*)::BIGINT AS rows_in, (count(*) FILTER (WHERE o_orderpriority = '5-LOW'))::BIGINT AS rows_dropped,
       round(100.0 * count(*) FILTER (WHERE o_orderpriority = '5-LOW') / count(*), 2) AS dropped_pct
FROM orders
""",
})
QUERIES.update({"q_preview": q_preview, "q_dropped_rows": q_dropped_rows})

ORACLES["q_json_envelope"] = f"""WITH {_SALES_GOLD}
SELECT 'ok' AS status,
       to_json(struct_pack(year := year, total_sales := total_sales, avg_price_eur := avg_price_eur,
               median_price_eur := median_price_eur, min_price_eur := min_price_eur,
               max_price_eur := max_price_eur, new_build_sales := new_build_sales,
               new_build_avg_price := new_build_avg_price, second_hand_sales := second_hand_sales,
               second_hand_avg_price := second_hand_avg_price,
               yoy_price_change_pct := yoy_price_change_pct, county := county))::VARCHAR AS data,
       to_json(struct_pack("table" := 'gold_property_sales_dublin', from_year := '1990', to_year := '2025',
               row_count := (SELECT count(*) FROM sg WHERE year BETWEEN 1990 AND 2025)))::VARCHAR AS meta
FROM sg WHERE year BETWEEN 1990 AND 2025
"""


def q_stream_cube_unpack(spark, sf_dir):
    """Incremental unpack: two runs, one cube landed twice, same rows as the batch."""
    from strata.streaming.bronze import cube_to_silver_stream
    docs = fixtures.orders_cube_docs(table(spark, sf_dir, "orders"))
    bronze, silver = scratch_path(spark, "stream_bronze"), scratch_path(spark, "stream_silver")
    checkpoint = scratch_path(spark, "stream_checkpoint")
    early, late = docs.filter(F.col("year") <= 1997), docs.filter(F.col("year") > 1997)
    for month, landed in (("05", {"early": early}), ("06", {"early": early, "late": late})):  # early lands again
        for name, part in landed.items():
            part.select("body").write.text(f"{bronze}/{name}/year={RUN_YEAR}/month={month}")
        cube_to_silver_stream(spark, f"{bronze}/*/*/*", silver, "ORD01", RUN_DATE,
                              [("STATISTIC", "statistic"), ("TLIST(M1)", "period"), (fixtures.PRIORITY_DIM, "order_priority")],
                              checkpoint=checkpoint).awaitTermination()
    return spark.read.parquet(silver).select("statistic", "period", "order_priority", "metric_value",
                                             "source_dataset", "ingestion_date", "year")


ORACLES["q_stream_cube_unpack"] = ORACLES["q_jsonstat_unpack"]
QUERIES["q_stream_cube_unpack"] = q_stream_cube_unpack


# --- landings, odd files, wide and mixed cubes, open views ------------------------

def q_latest_files(spark, sf_dir):
    """Rows read and replaced per source: several files in a landing, months 9 and 10,
    sales years of two files each and a folder without landing time."""
    root = scratch_path(spark, "landings")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("y"))
    older = orders.filter(F.col("o_orderstatus") != "P")
    line = lambda df: df.select(F.col("o_orderkey").cast("string").alias("value"))
    line(older).repartition(3).write.text(f"{root}/cube/year=2024/month=9")
    line(orders).repartition(3).write.text(f"{root}/cube/year=2024/month=10")
    for _ in range(2):
        (orders.select(F.col("o_orderkey").cast("string").alias("value"), F.col("y").alias("year")).repartition("year")
         .write.mode("append").partitionBy("year").text(f"{root}/sales"))
    line(orders).repartition(2).write.text(f"{root}/plain")
    out = []
    for name, folders in (("cube", LANDING_FOLDERS), ("sales", ()), ("plain", LANDING_FOLDERS)):
        for status, paths in zip(("read", "superseded"), newest_snapshot_files(spark, f"{root}/{name}", "*.txt", folders)):
            if paths:
                out.append(spark.read.text(paths).agg(F.count(F.lit(1)).alias("rows"))
                           .select(F.lit(name).alias("source"), F.lit(status).alias("status"), "rows"))
    return union_by_name(out)


def q_view_rents_all(spark, sf_dir):
    """V2 without bounds or limit: every row, years after 2025 included."""
    orders = table(spark, sf_dir, "orders")
    silver = orders.select(
        F.concat(F.lit("Customer "), F.col("o_custkey")).alias("location"), (F.year("o_orderdate") + 30).alias("year"),
        F.floor("o_totalprice").cast("double").alias("value"), F.lit(RENT_ALL_BEDROOMS).alias("number_of_bedrooms"),
        F.lit(RENT_ALL_PROPERTY_TYPES).alias("property_type"))
    return views.rents(gold.rent_trends(silver, RUN_DATE)).select("location", "year", "avg_monthly_rent", "sample_count")


def q_cube_wide_dimension(spark, sf_dir):
    """N4 on cubes whose cells grow with lineitem and whose part dimension is very wide."""
    root = _land_docs(spark, fixtures.part_month_cube_docs(table(spark, sf_dir, "lineitem")), "part_cube")
    return jsonstat.unpack(read_documents(spark, root).select("path", "body"),
                           columns=[("TLIST(M1)", "period"), ("PART", "part")])


def q_cube_mixed_time(spark, sf_dir):
    """Annual and monthly cubes in one source share the period column."""
    orders = table(spark, sf_dir, "orders")
    monthly = fixtures.orders_cube_docs(orders, by_status=True).select("body")
    root = _land_docs(spark, monthly.unionByName(fixtures.annual_cube_docs(orders)), "mixed_cube")
    silver, _ = cube_silver(read_documents(spark, root), "ORD03", RUN_DATE)
    return silver.select("statistic", "period", "order_priority", "order_status", "metric_value", "year")


def q_csv_rejects(spark, sf_dir):
    """Files and rows set aside or noted, by reason, and the rows read."""
    root = scratch_path(spark, "odd_csv")
    fixtures.write_odd_csv(table(spark, sf_dir, "customer"), root)
    rows, rejects = read_csv_by_header(spark, root, SALES_HEADER_SYNONYMS, glob="*.txt", required=["date_of_sale_raw"])
    read = rows.filter(F.col("date_of_sale_raw") == "01/02/2020").agg(F.count(F.lit(1)).alias("n"))
    return (rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
            .unionByName(read.select(F.lit("(rows read)").alias("reason"), "n")))


def q_coerce_edge(spark, sf_dir):
    """P10 on columns that only look like numbers."""
    key, line = F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")
    text = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") == 1, F.lit("1e5")).otherwise(key).alias("exponent"),
        F.when(F.col("l_linenumber") == 1, F.lit("nan")).otherwise(F.concat(line, F.lit(".5"))).alias("special"),
        F.concat(F.lit("1234567890"), F.lpad(key, 10, "0")).alias("digits20"),
        F.concat(F.lit("9" * 30), F.lpad(key, 10, "0")).alias("digits40"),
        F.lit("").alias("blank"),
        F.when(F.col("l_linenumber") == 1, key).otherwise(F.concat(line, F.lit(".25"))).alias("mixed"),
        F.when(F.col("l_linenumber") == 1, F.lit("n/a")).otherwise(line).alias("some_text"))
    return coerce_strings(text)


def q_gold_summary_null_year(spark, sf_dir):
    """Marts with rows that have no year join with nothing on it."""
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    a = orders.groupBy(F.when(F.col("o_orderpriority") != "5-LOW", F.year("o_orderdate")).alias("year")).agg(
        F.count(F.lit(1)).alias("n_orders"))
    b = lineitem.groupBy(F.when(F.col("l_returnflag") != "N", F.year("l_shipdate")).alias("year")).agg(
        F.count(F.lit(1)).alias("n_lines"))
    return spine_merge([a, b])


def q_empty_dimensions(spark, sf_dir):
    """Dimensions without categories, per document."""
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey")).agg(F.count(F.lit(1)).alias("n"))
    dim = lambda codes: F.struct(F.lit("L").alias("label"), F.struct(codes.alias("index")).alias("category"))
    codes = F.when(F.col("n") % 2 == 0, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    body = F.to_json(F.struct(
        F.array(F.lit("A"), F.lit("B")).alias("id"), F.array(F.lit(1), F.size(codes)).alias("size"),
        F.struct(dim(F.array(F.lit("a"))).alias("A"), dim(codes).alias("B")).alias("dimension"),
        F.array_repeat(F.lit(1), F.size(codes)).alias("value")))
    found = jsonstat.empty_dimensions(jsonstat.parse(orders.select("o_custkey", body.alias("body"))))
    return found.select("o_custkey", "dimension_id")


def q_plain_limit(spark, sf_dir):
    """O3: any rows, as many as asked for (which ones is open, so only their number)."""
    return sample_rows(table(spark, sf_dir, "orders"), 7).agg(F.count(F.lit(1)).alias("n"))


ORACLES.update({
    "q_latest_files": """
SELECT 'cube' AS source, 'read' AS status, count(*)::BIGINT AS rows FROM orders
UNION ALL SELECT 'cube', 'superseded', count(*)::BIGINT FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT 'sales', 'read', (2 * count(*))::BIGINT FROM orders
UNION ALL SELECT 'plain', 'read', count(*)::BIGINT FROM orders
""",
    "q_view_rents_all": """
SELECT 'Customer ' || o_custkey AS location, (year(o_orderdate) + 30)::INT AS year,
       round(avg(floor(o_totalprice)), 2) AS avg_monthly_rent, count(*)::BIGINT AS sample_count
FROM orders GROUP BY 1, 2
""",
    "q_cube_wide_dimension": """
SELECT strftime(l_shipdate, '%Y %B') AS period, 'Part ' || l_partkey AS part, sum(l_quantity)::DOUBLE AS metric_value
FROM lineitem GROUP BY 1, 2
""",
    "q_cube_mixed_time": """
WITH c AS (SELECT year(o_orderdate)::INT AS y, o_orderstatus AS t, month(o_orderdate)::INT AS m,
                  o_orderpriority AS p, count(*)::DOUBLE AS n, round(sum(o_totalprice), 2) AS s
           FROM orders GROUP BY ALL),
  g AS (SELECT a.y, a.t, a.m, b.p FROM (SELECT DISTINCT y, t, m FROM c) a
        JOIN (SELECT DISTINCT y, t, p FROM c) b ON a.y = b.y AND a.t = b.t),
  st(k, statistic) AS (VALUES (0, 'Number of Orders'), (1, 'Total Order Value'))
SELECT st.statistic, strftime(make_date(g.y, g.m, 1), '%Y %B') AS period, g.p AS order_priority,
       'Status ' || g.t AS order_status, CASE WHEN st.k = 0 THEN c.n ELSE c.s END AS metric_value, g.y AS year
FROM g CROSS JOIN st LEFT JOIN c ON c.y = g.y AND c.t = g.t AND c.m = g.m AND c.p = g.p
UNION ALL
SELECT NULL, year(o_orderdate)::VARCHAR, NULL, o_orderstatus, count(*)::DOUBLE, year(o_orderdate)::INT
FROM orders GROUP BY year(o_orderdate), o_orderstatus
""",
    "q_csv_rejects": """
WITH c AS (SELECT *, c_nationkey % 6 AS k, c_custkey // 1000 AS r FROM customer),
     f AS (SELECT DISTINCT c_nationkey, k, r FROM c)
SELECT 'duplicate header' AS reason, count(*)::BIGINT AS n FROM f WHERE k = 1 HAVING count(*) > 0
UNION ALL SELECT 'no header', count(*)::BIGINT FROM f WHERE k = 2 HAVING count(*) > 0
UNION ALL SELECT 'missing column date_of_sale_raw', count(*)::BIGINT FROM f WHERE k = 4 HAVING count(*) > 0
UNION ALL SELECT 'too many fields', count(*)::BIGINT FROM c WHERE k = 5 AND c_mktsegment = 'AUTOMOBILE' HAVING count(*) > 0
UNION ALL SELECT 'too few fields', count(*)::BIGINT FROM c WHERE k = 5 AND c_mktsegment = 'BUILDING' HAVING count(*) > 0
UNION ALL SELECT '(rows read)', count(*)::BIGINT FROM c WHERE k NOT IN (2, 4)
""",
    "q_coerce_edge": """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linenumber = 1 THEN '1e5' ELSE l_orderkey::VARCHAR END AS exponent,
       CASE WHEN l_linenumber = 1 THEN 'nan' ELSE l_linenumber || '.5' END AS special,
       ('1234567890' || lpad(l_orderkey::VARCHAR, 10, '0'))::DECIMAL(38, 0) AS digits20,
       repeat('9', 30) || lpad(l_orderkey::VARCHAR, 10, '0') AS digits40,
       NULL::VARCHAR AS blank,
       CASE WHEN l_linenumber = 1 THEN l_orderkey ELSE l_linenumber + 0.25 END::DOUBLE AS mixed,
       CASE WHEN l_linenumber = 1 THEN 'n/a' ELSE l_linenumber::VARCHAR END AS some_text
FROM lineitem
""",
    "q_gold_summary_null_year": """
WITH a AS (SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN year(o_orderdate) END::INT AS year,
                  count(*)::BIGINT AS n_orders FROM orders GROUP BY 1),
     b AS (SELECT CASE WHEN l_returnflag <> 'N' THEN year(l_shipdate) END::INT AS year,
                  count(*)::BIGINT AS n_lines FROM lineitem GROUP BY 1),
     s AS (SELECT year FROM a UNION SELECT year FROM b)
SELECT s.year, a.n_orders, b.n_lines FROM s LEFT JOIN a ON a.year = s.year LEFT JOIN b ON b.year = s.year
""",
    "q_empty_dimensions": """
SELECT o_custkey, 'B' AS dimension_id FROM orders GROUP BY o_custkey HAVING count(*) % 2 = 1
""",
    "q_plain_limit": "SELECT least(7, count(*))::BIGINT AS n FROM orders",
})
QUERIES.update({q.__name__: q for q in (
    q_latest_files, q_view_rents_all, q_cube_wide_dimension, q_cube_mixed_time, q_csv_rejects, q_coerce_edge,
    q_gold_summary_null_year, q_empty_dimensions, q_plain_limit)})
