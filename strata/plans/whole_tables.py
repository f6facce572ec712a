"""Queries of the operators that work on whole, unaggregated tables, and their SQL.

Round trips write below the session's checkpoint folder.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from strata.functions.coerce import cell_kinds, coerce_cells
from strata.functions.values import to_double
from strata.operators import jsonstat
from strata.operators.aggregates import headline_stats
from strata.operators.cube_split import unpack_split
from strata.operators.ranges import numbered
from strata.operators.search import search_rows, write_index
from strata.operators.selection import exact_quantile, with_exact_median
from strata.operators.trends import yoy_in_order
from strata.plans import fixtures, gold, jobs, views
from strata.plans.analogues import ORACLES as CUBE_ORACLES
from strata.plans.analogues import DUBLIN_ANALOG, RUN_DATE, _land_docs, _orders_y, table
from strata.plans.publish import publish, refresh_mart, refresh_table, write_marked
from strata.plans.silver import cube_silver, cube_silver_parsed
from strata.plans.sinks import ensure_database
from strata.session import scratch_path
from strata.sources.documents import read_documents
from strata.sources.drift import read_drifting
from strata.sources.landing import land_once, landed_files, read_manifest

QUERIES = {}
ORACLES = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return add


@query("""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN DATE '1995-06-17'
                  ELSE o_orderdate::DATE END AS day, CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS price FROM orders),
  p AS (SELECT *, lag(price) OVER (ORDER BY day NULLS FIRST, price NULLS FIRST, o_orderkey) AS previous FROM o)
SELECT o_orderkey, day, price, previous, round(price - previous, 2) AS change,
       round((price - previous) / nullif(previous, 0) * 100, 2) AS change_pct FROM p
""")
def q_global_lag(spark, sf_dir):
    """W2 over every order: null days, one day that holds a third of the rows, null prices."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 == 0, None).when(F.col("o_orderkey") % 3 == 0, F.lit("1995-06-17").cast("date"))
        .otherwise(F.col("o_orderdate").cast("date")).alias("day"),
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_totalprice")).alias("price"))
    return yoy_in_order(orders, "price", "day", previous="previous", change="change", change_digits=2, pct="change_pct")


@query("""
WITH l AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN 'HOT' ELSE l_returnflag END AS flag,
                  l_shipdate::DATE AS day, l_extendedprice AS price FROM lineitem)
SELECT *, lag(price) OVER w AS previous, round(price - lag(price) OVER w, 2) AS change
FROM l WINDOW w AS (PARTITION BY flag ORDER BY day, price, l_orderkey, l_linenumber)
""")
def q_keyed_lag_hot(spark, sf_dir):
    """W1 over every line with a key that holds a third of them."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_orderkey") % 3 == 0, "HOT").otherwise(F.col("l_returnflag")).alias("flag"),
        F.col("l_shipdate").cast("date").alias("day"), F.col("l_extendedprice").alias("price"))
    return yoy_in_order(lines, "price", "day", ["flag"], previous="previous", change="change", change_digits=2,
                        pct=None, ties=["price", "l_orderkey", "l_linenumber"])


@query("""
SELECT l_returnflag, count(*)::BIGINT AS n_lines, round(avg(l_extendedprice), 2) AS avg_price,
       quantile_disc(l_extendedprice, 0.5) AS median_price FROM lineitem GROUP BY 1
""")
def q_median_exact(spark, sf_dir):
    """A3, A4: exact medians of groups far beyond the sketch, one of them half of the table."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    stats = headline_stats(lines, ["l_returnflag"], "l_extendedprice",
                           {"count": "n_lines", "avg": "avg_price", "median": "median_price"}, digits=2)
    return with_exact_median(stats, lines, ["l_returnflag"], "l_extendedprice", "median_price", digits=None)


_HOT_CLASS = "CASE WHEN l_orderkey % 3 = 0 THEN 'HOT' ELSE l_returnflag || l_linenumber END"


@query(f"""
WITH l AS (SELECT {_HOT_CLASS} AS class, l_quantity AS v, 'quantity' AS measure FROM lineitem
           UNION ALL SELECT {_HOT_CLASS}, l_extendedprice, 'price' FROM lineitem),
  r AS (SELECT *, row_number() OVER (PARTITION BY class, measure ORDER BY v) AS i,
               count(*) OVER (PARTITION BY class, measure) AS n FROM l)
SELECT class, measure, max(CASE WHEN i = greatest(ceil(n * 0.9), 1) THEN v END) AS ninth_decile FROM r GROUP BY 1, 2
""")
def q_quantile_exact(spark, sf_dir):
    """The 0.9 quantile of many groups, a third of the rows in one, and of values with heavy ties."""
    lines = table(spark, sf_dir, "lineitem").withColumn("class", F.expr(_HOT_CLASS))
    both = lines.select("class", F.lit("quantity").alias("measure"), F.col("l_quantity").alias("v")).unionByName(
        lines.select("class", F.lit("price").alias("measure"), F.col("l_extendedprice").alias("v")))
    return exact_quantile(both, ["class", "measure"], "v", q=0.9, name="ninth_decile")


@query(CUBE_ORACLES["q_jsonstat_unpack"])
def q_cube_repeated_keys(spark, sf_dir):
    """Label and index objects that repeat a key: the last entry counts, one row per cell."""
    docs = fixtures.orders_cube_docs(table(spark, sf_dir, "orders"))
    body = F.regexp_replace("body", r'"label":\{"P1":', '"label":{"P1":"stale","P2":"older","P1":')
    body = F.regexp_replace(body, r'"index":\{"P1":', '"index":{"P1":9,"P1":3,"P1":')
    root = _land_docs(spark, docs.withColumn("body", body), "orders_cube_repeated")
    silver, _ = cube_silver(read_documents(spark, root), "ORD01", RUN_DATE)
    return silver.select("statistic", "period", "order_priority", "metric_value", "source_dataset", "ingestion_date", "year")


_MIXED_CELL = """CASE l_linenumber WHEN 1 THEN CAST(l_orderkey AS STRING) WHEN 2 THEN concat(CAST(l_partkey AS STRING), '.25')
  WHEN 3 THEN l_returnflag WHEN 4 THEN '' WHEN 5 THEN concat(CAST(l_partkey AS STRING), 'e2')
  WHEN 6 THEN concat(' -', CAST(l_suppkey AS STRING), ' ') END"""


@query("""
WITH l AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_quantity::BIGINT::VARCHAR || '.5' AS quantity FROM lineitem)
SELECT l_orderkey, l_partkey, l_linenumber, 'cell' AS column_name,
       CASE WHEN l_linenumber IN (1, 6) THEN 'BIGINT' WHEN l_linenumber = 2 THEN 'DOUBLE' WHEN l_linenumber IN (3, 5) THEN 'STRING' ELSE 'VOID' END AS kind,
       CASE l_linenumber WHEN 1 THEN l_orderkey WHEN 6 THEN -l_suppkey END AS whole,
       CASE WHEN l_linenumber = 2 THEN l_partkey + 0.25::DOUBLE END AS number,
       CASE l_linenumber WHEN 3 THEN l_returnflag WHEN 5 THEN l_partkey || 'e2' END AS characters FROM l
UNION ALL
SELECT l_orderkey, l_partkey, l_linenumber, 'quantity', 'DOUBLE', NULL, quantity::DOUBLE, NULL FROM l
""")
def q_coerce_cells(spark, sf_dir):
    """P10 per cell: a column of whole numbers, decimals, text and blanks, and one of decimals."""
    text = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", F.expr(_MIXED_CELL).alias("cell"),
        F.concat(F.col("l_quantity").cast("bigint").cast("string"), F.lit(".5")).alias("quantity"))
    return cell_kinds(coerce_cells(text), ["cell", "quantity"], ["l_orderkey", "l_partkey", "l_linenumber"])


# -- landing -----------------------------------------------------------------------------

def _customer_line():
    return F.concat_ws(",", F.col("c_custkey").cast("string"), F.lit("Dún"), "c_name", "c_mktsegment")


@query("""
WITH f AS (SELECT c_nationkey, string_agg(c_custkey || ',D' || chr(250) || 'n,' || c_name || ',' || c_mktsegment, chr(13) ORDER BY c_custkey)
                  || chr(13) AS body FROM customer GROUP BY 1),
  b AS (SELECT unhex(replace(hex(encode(body)), 'C3BA', 'FA')) AS bytes FROM f)
SELECT landing, sha256(bytes) AS sha256, octet_length(bytes)::BIGINT AS length,
       CASE WHEN landing = 1 THEN 'stored' ELSE 'duplicate' END AS status, 1::BIGINT AS n_held, sha256(bytes) AS held_sha256
FROM b, (VALUES (1), (2)) l(landing)
""")
def q_land_once(spark, sf_dir):
    """A latin-1 file per nation with bare carriage returns, landed twice; the bytes
    held are hashed again from the landed files."""
    lines = table(spark, sf_dir, "customer").withColumn("line", _customer_line())
    drop, root = scratch_path(spark, "drop"), scratch_path(spark, "landed")
    (lines.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey").select("line", "c_nationkey")
     .write.partitionBy("c_nationkey").option("encoding", "ISO-8859-1").option("lineSep", "\r").csv(
         drop, quote="\u0000", sep="\u0001"))
    for month in ("01", "02"):
        land_once(spark, drop, root, "customers", f"2024-{month}-01 00:00:00", glob="part-*")
    held = landed_files(spark, root, "customers").groupBy("sha256").agg(
        F.count(F.lit(1)).alias("n_held"), F.max(F.sha2("content", 256)).alias("held_sha256"))
    return (read_manifest(spark, root).join(held, "sha256", "left")
            .select(F.month("landed_at").alias("landing"), "sha256", "length", "status", "n_held", "held_sha256"))


# -- publishing and refreshing -----------------------------------------------------------

_STAGE = "WITH o AS (SELECT year(o_orderdate)::INT AS year, o_totalprice AS price, o_orderstatus AS s FROM orders)"


@query(f"""{_STAGE}
SELECT 1 AS run, year, count(*)::BIGINT AS n, round(sum(price), 2) AS total FROM o WHERE s = 'F' GROUP BY 2
UNION ALL SELECT 2, year, count(*)::BIGINT, round(sum(price), 2) FROM o GROUP BY 2
""")
def q_atomic_publish(spark, sf_dir):
    """K1, K3: a mart published twice; what readers of the view see after each run."""
    db, name = "strata_publish", f"orders_{uuid.uuid4().hex[:8]}"
    ensure_database(spark, db, scratch_path(spark, "publish"))
    orders = _orders_y(spark, sf_dir).select("year", "o_orderkey", "o_totalprice", "o_orderstatus")
    seen = []
    for run, df in enumerate((orders.filter("o_orderstatus = 'F'"), orders), start=1):
        publish(df, db, name, keep=2)
        view = spark.table(f"{db}.{name}")
        seen.append(view.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
                    .select(F.lit(run).alias("run"), "year", "n", "total"))
    return seen[0].unionByName(seen[1])


@query(CUBE_ORACLES["q_yoy_by_key"])
def q_incremental_gold(spark, sf_dir):
    """K1: the rents mart refreshed after one year of Silver changed equals the full rebuild."""
    silver, mart = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    now = fixtures.rents_silver(table(spark, sf_dir, "orders"))
    before = now.withColumn("value", F.when(F.col("year") == 1995, F.col("value") * 2).otherwise(F.col("value")))
    build = lambda df: gold.rent_trends(df, RUN_DATE)
    write_marked(before, silver)
    refresh_mart(spark, silver, mart, build)
    refresh_table(now, silver)
    done = refresh_mart(spark, silver, mart, build)
    if done["changed"] != [1995] or len(done["read"]) > 3:
        raise RuntimeError(f"more was rebuilt than one year calls for: {done}")
    return spark.read.schema(build(now).schema).parquet(mart)


@query(CUBE_ORACLES["q_medallion_summary"])
def q_medallion_refresh(spark, sf_dir):
    """Both jobs run again after Bronze changed: only changed years are rewritten, and the summary
    equals that of a full run."""
    root = scratch_path(spark, "medallion-refresh")
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    older = orders.withColumn("o_totalprice", F.when(F.year("o_orderdate") == 1995, F.col("o_totalprice") + 1000)
                              .otherwise(F.col("o_totalprice")))
    for step, version in enumerate((older, orders)):
        fixtures.write_bronze(spark, version, lineitem, f"{root}/bronze{step}")
        jobs.bronze_to_silver(spark, f"{root}/bronze{step}", f"{root}/silver", RUN_DATE, incremental=True)
        done = jobs.refresh_gold(spark, f"{root}/silver", f"{root}/gold", RUN_DATE,
                                 summary_options={"dublin_needle": DUBLIN_ANALOG})
    if any(set(d["rebuilt"]) - {1995, 1996} for d in done.values()):
        raise RuntimeError(f"more years were rebuilt than changed: {done}")
    return views.summary(spark.read.parquet(f"{root}/gold/gold_housing_crisis_summary"))


@query(CUBE_ORACLES["q_medallion_summary"])
def q_medallion_published(spark, sf_dir):
    """The five marts published as views, twice; the summary as its readers see it."""
    root = scratch_path(spark, "medallion-published")
    db = f"strata_published_{uuid.uuid4().hex[:8]}"
    fixtures.write_bronze(spark, table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"), f"{root}/bronze")
    jobs.bronze_to_silver(spark, f"{root}/bronze", f"{root}/silver", RUN_DATE)
    for _ in range(2):
        jobs.publish_gold(spark, f"{root}/silver", RUN_DATE, db, f"{root}/catalog", exact_median=True,
                          summary_options={"dublin_needle": DUBLIN_ANALOG})
    return views.summary(spark.table(f"{db}.gold_housing_crisis_summary"))


# -- large and sparse cubes --------------------------------------------------------------

CUBE_ROWS = 1000  # categories of the first dimension of the large cube


def large_cube(spark, sf_dir) -> str:
    """One cube document, in parts, that holds two numbers of every line item; its folder.

    Dimensions: measure (2), row (1000), column (as many as needed).  The text is written as
    a stream of lines, a cell each, by many tasks: a range of the lines is a part.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    order = lines.columns
    placed = numbered(lines, order, "i")
    n = placed.count()
    width = -(-n // CUBE_ROWS)
    total = CUBE_ROWS * width
    cat = lambda label, codes: {"label": label, "category": {"index": codes, "label": {}}}
    head = json.dumps({"id": ["MEASURE", "ROW", "COLUMN"], "size": [2, CUBE_ROWS, width], "dimension": {
        "MEASURE": {"label": "Measure", "category": {"index": {"P": 0, "Q": 1}, "label": {"P": "Price, each", "Q": "Quantity"}}},
        "ROW": cat("Row", [f"r{i}" for i in range(CUBE_ROWS)]), "COLUMN": cat("Column", [f"c{i}" for i in range(width)])}})
    end = 2 * total - 1
    comma = lambda at: F.when(at < end, F.lit(",")).otherwise(F.lit(""))
    cells = [placed.select((F.col("i") + k * total).alias("at"), F.col(c).cast("string").alias("v"))
             for k, c in enumerate(("l_extendedprice", "l_quantity"))]
    gaps = spark.range(n, total).select(F.explode(F.array(F.col("id"), F.col("id") + total)).alias("at"), F.lit("null").alias("v"))
    body = cells[0].unionByName(cells[1]).unionByName(gaps).select("at", F.concat("v", comma(F.col("at"))).alias("line"))
    rows = body.unionByName(spark.createDataFrame(
        [(-1, head[:-1] + ', "value": ['), (2 * total, '], "status": {"0": "a, b"}}')], "at long, line string"))
    root = scratch_path(spark, "large-cube")
    rows.repartitionByRange("at").sortWithinPartitions("at").select("line").write.text(root)
    return root


@query(f"""
WITH l AS (SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) - 1 AS i,
                  l_extendedprice AS p, l_quantity AS q FROM lineitem),
  w AS (SELECT ceil(count(*) / {CUBE_ROWS})::BIGINT AS width FROM lineitem),
  c AS (SELECT unnest(range(0, {CUBE_ROWS} * width)) AS i, width FROM w)
SELECT m.measure, 'r' || (c.i // c.width) AS "row", 'c' || (c.i % c.width) AS "column", CASE WHEN m.measure = 'Quantity' THEN q ELSE p END AS metric_value
FROM c LEFT JOIN l ON l.i = c.i CROSS JOIN (VALUES ('Price, each'), ('Quantity')) m(measure)
""")
def q_cube_split(spark, sf_dir):
    """One document of every line item, written in parts, its value array read in as many splits as Spark makes."""
    return unpack_split(spark, large_cube(spark, sf_dir), parts=True).select("measure", "row", "column", "metric_value")


def sparse_docs(docs):
    """Cube documents with their value array as an object of the cells that are set, and one
    entry beyond the cube."""
    dense = F.from_json(F.get_json_object("body", "$.result.value"), "array<string>")
    cells = F.filter(F.transform(dense, lambda v, i: F.struct(i.cast("string").alias("key"), v.alias("value"))),
                     lambda e: e["value"].isNotNull())
    text = F.array_join(F.transform(cells, lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), e["value"])), ",")
    value = F.concat(F.lit('"value":{'), text, F.lit(',"99999999":1.5,"x":2}'))
    return docs.withColumn("body", F.concat(F.regexp_extract("body", r'^(.*)"value":\[[^\]]*\](.*)$', 1), value,
                                            F.regexp_extract("body", r'^(.*)"value":\[[^\]]*\](.*)$', 2)))


@query(CUBE_ORACLES["q_jsonstat_unpack"])
def q_cube_sparse(spark, sf_dir):
    """Sparse documents, whose missing cells are null and whose stray entries are dropped."""
    docs = sparse_docs(fixtures.orders_cube_docs(table(spark, sf_dir, "orders")))
    root = _land_docs(spark, docs, "orders_cube_sparse")
    parsed = jsonstat.parse(read_documents(spark, root).select("path", "body"), sparse=True)
    silver, _ = cube_silver_parsed(parsed, "ORD01", RUN_DATE)
    return silver.select("statistic", "period", "order_priority", "metric_value", "source_dataset", "ingestion_date", "year")


@query("""
SELECT r.key, r.value, 'position outside the cube' AS reason, count(DISTINCT year(o_orderdate))::BIGINT AS n_docs
FROM orders CROSS JOIN (VALUES ('99999999', '1.5'), ('x', '2')) r(key, value) GROUP BY 1, 2
""")
def q_cube_sparse_dropped(spark, sf_dir):
    """What sparse documents hold outside their cube."""
    docs = sparse_docs(fixtures.orders_cube_docs(table(spark, sf_dir, "orders")))
    parsed = jsonstat.parse(docs.select("doc_key", "body"), sparse=True)
    return jsonstat.dropped_positions(parsed).groupBy("key", "value", "reason").agg(F.count(F.lit(1)).alias("n_docs"))


# -- search and drift --------------------------------------------------------------------

@query("""
WITH t AS (SELECT DISTINCT p_name || ' of ' || p_brand AS text FROM part),
  n AS (SELECT DISTINCT substr(p_name, 2, 1 + (p_partkey % 9)::INT) AS needle FROM part
        UNION SELECT upper(split_part(p_name, ' ', 2)) FROM part UNION SELECT p_brand || '0' FROM part UNION SELECT 'D'),
  f AS (SELECT p.*, p_name || ' of ' || p_brand AS text FROM part p)
SELECT needle, count(*)::BIGINT AS n_parts, count(DISTINCT f.text)::BIGINT AS n_texts, round(sum(p_retailprice), 2) AS total
FROM n JOIN f ON contains(lower(f.text), lower(needle)) GROUP BY needle
""")
def q_location_index(spark, sf_dir):
    """Hundreds of needles at once, of all lengths, through the trigram index."""
    parts = table(spark, sf_dir, "part").withColumn("text", F.concat_ws(" of ", "p_name", "p_brand"))
    path = scratch_path(spark, "location-index")
    write_index(parts, "text", path)
    cut = F.substring("p_name", F.lit(2), (F.lit(1) + F.col("p_partkey") % 9).cast("int"))
    needles = parts.select(F.explode(F.array(cut, F.upper(F.split_part("p_name", F.lit(" "), F.lit(2))),
                                             F.concat("p_brand", F.lit("0")), F.lit("D"))).alias("needle"))
    return (search_rows(spark, path, needles, parts, "text").groupBy("needle")
            .agg(F.count(F.lit(1)).alias("n_parts"), F.countDistinct("text").alias("n_texts"),
                 F.round(F.sum("p_retailprice"), 2).alias("total")))


@query("""
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN floor(o_totalprice)::DOUBLE ELSE o_totalprice END AS price,
       CASE o_orderkey % 4 WHEN 3 THEN NULL ELSE o_custkey END AS o_custkey,
       CASE o_orderkey % 4 WHEN 1 THEN o_orderstatus END AS status, 'string' AS kind
FROM orders
""")
def q_snapshot_drift(spark, sf_dir):
    """Four landings of orders, prices as INT, DOUBLE, text and DECIMAL, columns that come
    and go, keys of two widths."""
    orders = table(spark, sf_dir, "orders")
    root = scratch_path(spark, "drift")
    forms = [
        [F.col("o_orderkey").cast("int"), F.floor("o_totalprice").cast("int").alias("price"), F.col("o_custkey").cast("int")],
        ["o_orderkey", F.col("o_totalprice").alias("price"), "o_custkey", F.col("o_orderstatus").alias("status")],
        ["o_orderkey", "o_custkey", F.col("o_totalprice").cast("string").alias("price")],
        [F.col("o_totalprice").cast("decimal(14,2)").alias("price"), "o_orderkey"]]
    for k, cols in enumerate(forms):
        orders.filter(F.col("o_orderkey") % 4 == k).select(*cols).write.parquet(f"{root}/landed={k}")
    rows = read_drifting(spark, root)
    return rows.select("o_orderkey", to_double("price").alias("price"), "o_custkey", "status",
                       F.lit(rows.schema["price"].dataType.simpleString()).alias("kind"))
