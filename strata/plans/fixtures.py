"""Bronze inputs derived from the driver's tables.

The source marts read housing cubes and CSV extracts; the test tables are
TPC-H-like.  These builders derive Bronze-shaped inputs (cube documents,
CSV files) from those tables with Spark, so every analog query reads the
given tables and its work grows with them.  Cubes are built from
pre-aggregated cells, so a document holds at most months x priorities x
statistics values however large ``orders`` is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.fixed_values import (PERMISSIONS_CONSTRUCTION, PERMISSIONS_STATISTIC,
                                 RENT_ALL_BEDROOMS, RENT_ALL_PROPERTY_TYPES, SILVER_PATHS)
from strata.functions.values import lookup
from strata.sources.files import land_raw

ORDER_STATS = ["Number of Orders", "Total Order Value"]
PRIORITY_DIM = "C03737V04487"


def order_cells(orders: DataFrame, by_status: bool = False) -> DataFrame:
    """(year, [status,] month, priority) -> order count and rounded value sum."""
    keys = [F.year("o_orderdate").alias("year")]
    if by_status:
        keys.append(F.col("o_orderstatus").alias("status"))
    keys += [F.month("o_orderdate").alias("month"), F.col("o_orderpriority").alias("priority")]
    return orders.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.round(F.sum("o_totalprice"), 2).alias("s"))


def orders_cube_docs(orders: DataFrame, by_status: bool = False, vary_forms: bool = False) -> DataFrame:
    """One JSON-stat document per year (or year x status): ``(doc_key, body)``.

    Dimensions: ``STATISTIC`` (list index), ``TLIST(M1)`` (empty index: codes
    are the label keys), the priority (dict index).  With ``by_status`` each
    document also has a one-category ``Order Status`` dimension.  With
    ``vary_forms`` the spellings vary by status: no ``result`` envelope for
    ``P``, an absent time index for ``F``, a dict index written in reverse
    order for ``O``, and no label for priority ``5-LOW`` (its code is used).
    """
    doc_keys = ["year", "status"] if by_status else ["year"]
    cells = order_cells(orders, by_status)
    docs = cells.groupBy(*doc_keys).agg(
        F.collect_list(F.struct("month", "priority", "n", "s")).alias("cells"))
    docs = docs.select(
        *doc_keys,
        F.expr("array_sort(array_distinct(transform(cells, c -> c.month)))").alias("months"),
        F.expr("array_sort(array_distinct(transform(cells, c -> c.priority)))").alias("prios"),
        F.expr("map_from_entries(transform(cells, c -> "
               "struct(concat(c.month, '|', c.priority), struct(c.n, c.s))))").alias("cellmap"),
    )
    values = F.expr("""
        flatten(transform(array(0, 1), k -> flatten(transform(months, m -> transform(prios, p ->
          CASE WHEN k = 0 THEN cellmap[concat(m, '|', p)].n
               ELSE cellmap[concat(m, '|', p)].s END)))))""")
    month_codes = F.expr("transform(months, m -> format_string('%dM%02d', year, m))")
    month_labels = F.expr("transform(months, m -> date_format(make_date(year, m, 1), 'yyyy MMMM'))")
    prio_codes = F.expr("transform(prios, p -> concat('P', substring(p, 1, 1)))")
    if vary_forms:
        prio_labels = F.expr("map_from_arrays(transform(filter(prios, p -> p <> '5-LOW'), "
                             "p -> concat('P', substring(p, 1, 1))), filter(prios, p -> p <> '5-LOW'))")
        prio_index = F.when(
            F.col("status") == "O",
            F.expr("map_from_entries(reverse(arrays_zip(transform(prios, p -> concat('P', substring(p, 1, 1))), "
                   "sequence(0, size(prios) - 1))))"))\
            .otherwise(F.expr("map_from_arrays(transform(prios, p -> concat('P', substring(p, 1, 1))), "
                              "sequence(0, size(prios) - 1))"))
        time_index = F.when(F.col("status") == "F", F.lit(None).cast("map<string,int>")) \
            .otherwise(F.expr("cast(map() AS map<string,int>)"))
    else:
        prio_labels = F.map_from_arrays(prio_codes, F.col("prios"))
        prio_index = F.map_from_arrays(prio_codes, F.expr("sequence(0, size(prios) - 1)"))
        time_index = F.expr("cast(map() AS map<string,int>)")
    dims = [
        F.struct(F.lit("Statistic").alias("label"), F.struct(
            F.array(F.lit("ORD01C01"), F.lit("ORD01C02")).alias("index"),
            F.create_map(F.lit("ORD01C01"), F.lit(ORDER_STATS[0]),
                         F.lit("ORD01C02"), F.lit(ORDER_STATS[1])).alias("label")).alias("category"))
        .alias("STATISTIC"),
        F.struct(F.lit("Month").alias("label"), F.struct(
            time_index.alias("index"),
            F.map_from_arrays(month_codes, month_labels).alias("label")).alias("category"))
        .alias("TLIST(M1)"),
        F.struct(F.lit("Order Priority").alias("label"), F.struct(
            prio_index.alias("index"), prio_labels.alias("label")).alias("category"))
        .alias(PRIORITY_DIM),
    ]
    ids = [F.lit("STATISTIC"), F.lit("TLIST(M1)"), F.lit(PRIORITY_DIM)]
    sizes = [F.lit(2), F.size("months"), F.size("prios")]
    if by_status:
        dims.append(F.struct(F.lit("Order Status").alias("label"), F.struct(
            F.array(F.col("status")).alias("index"),
            F.create_map(F.col("status"), F.concat(F.lit("Status "), F.col("status"))).alias("label"))
            .alias("category")).alias("STATUS"))
        ids.append(F.lit("STATUS"))
        sizes.append(F.lit(1))
    cube = F.struct(F.array(*ids).alias("id"), F.array(*sizes).alias("size"),
                    F.struct(*dims).alias("dimension"), values.alias("value"))
    body = F.to_json(F.struct(cube.alias("result")))
    if vary_forms:
        body = F.when(F.col("status") == "P", F.to_json(cube)).otherwise(body)
    return docs.select(F.concat_ws("-", *[F.col(k).cast("string") for k in doc_keys]).alias("doc_key"),
                       *doc_keys, body.alias("body"))


# Broken variants of a good document, one per reject reason (body text edits).
def broken_docs(good: DataFrame) -> DataFrame:
    """For each good ``(doc_key, year, body)`` add one document per reject reason.

    Returns ``(doc_key, year, expected, body)``; ``expected`` is the reason
    the unpack must report (``accepted`` for the untouched document).
    """
    body = F.col("body")
    last_size = F.get_json_object(body, "$.result.size[2]").cast("int")
    variants = {
        "accepted": body,
        "error_reply": F.concat(F.lit('{"error": {"code": -32603, "message": "no data for '),
                                F.col("year").cast("string"), F.lit('"}}')),
        "malformed": F.expr("substring(body, 1, length(body) - 1)"),
        "no_values": F.regexp_replace(body, r'"value":\[[^\]]*\]', '"value":{"0":1.0}'),
        "shape_mismatch": F.regexp_replace(body, r'"size":\[', '"size":[1,'),
        "missing_dimension": F.regexp_replace(
            F.regexp_replace(body, r'"size":\[', '"size":[1,'), r'"id":\[', '"id":["EXTRA",'),
        "short_codes": F.regexp_replace(
            body, F.lit(r'"size":\[2,([0-9]+),[0-9]+\]'),
            F.concat(F.lit('"size":[2,$1,'), (last_size + 1).cast("string"), F.lit("]"))),
    }
    return good.select("doc_key", "year", F.explode(F.array(*[
        F.struct(F.lit(k).alias("expected"), v.alias("body")) for k, v in variants.items()])).alias("v")
    ).select("doc_key", "year", "v.expected", "v.body")


# --- Silver-shaped tables derived from the driver's tables -------------------
# Analog values chosen so the marts' own filters keep some rows and drop others.
ANALOG_STATISTICS = {
    "F": "Residential Property Price Index",
    "O": "Percentage Change over 1 month for Residential Property Price Index",
    "P": "Percentage Change over 3 months for Residential Property Price Index",
}
ANALOG_PROPERTY_TYPES = {
    "1-URGENT": "National - all residential properties",
    "2-HIGH": "Dublin - all residential properties",
    "3-MEDIUM": "National - houses",
    "4-NOT SPECIFIED": "Fingal - houses",
    "5-LOW": "Dublin - apartments",
}
ANALOG_DESCRIPTIONS = {"O": "New order", "F": "Fulfilled order", "P": "Pending (renewed)"}


def price_silver(orders: DataFrame) -> DataFrame:
    """Price-index-shaped Silver from orders: one value per period x type x statistic."""
    return orders.groupBy(
        F.year("o_orderdate").alias("year"),
        F.date_format("o_orderdate", "yyyy MMMM").alias("period"),
        lookup("o_orderpriority", ANALOG_PROPERTY_TYPES).alias("type_of_residential_property"),
        lookup("o_orderstatus", ANALOG_STATISTICS).alias("statistic"),
    ).agg(F.round(F.sum("o_totalprice") / 10000, 2).alias("metric_value"))


def rents_silver(orders: DataFrame) -> DataFrame:
    """Rent-shaped Silver from orders: location = priority, value = order price."""
    return orders.select(
        F.col("o_orderpriority").alias("location"), F.year("o_orderdate").alias("year"),
        F.col("o_totalprice").alias("value"),
        F.when(F.col("o_orderstatus") == "F", F.lit(RENT_ALL_BEDROOMS)).otherwise(F.lit("One bed"))
        .alias("number_of_bedrooms"),
        F.lit(RENT_ALL_PROPERTY_TYPES).alias("property_type"))


def permissions_silver(lineitem: DataFrame) -> DataFrame:
    """Permission-shaped Silver from lineitem: quantity by ship year."""
    return lineitem.select(
        F.year("l_shipdate").alias("year"), F.col("l_quantity").alias("metric_value"),
        F.when(F.col("l_returnflag") == "N", F.lit(PERMISSIONS_CONSTRUCTION)).otherwise(F.lit("Repair"))
        .alias("type_of_construction"),
        F.when(F.col("l_linestatus") == "O", F.lit(PERMISSIONS_STATISTIC)).otherwise(F.lit("Other"))
        .alias("statistic"))


def sales_silver(orders: DataFrame) -> DataFrame:
    """Sales-register-shaped Silver from orders; low-priority orders lack a description."""
    return orders.select(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
        F.col("o_totalprice").alias("price_eur"),
        F.when(F.col("o_orderpriority") != "5-LOW", lookup("o_orderstatus", ANALOG_DESCRIPTIONS))
        .alias("property_description"))


# --- Bronze CSV files derived from the driver's tables -----------------------

def _price_text(col: str, mark: str) -> F.Column:
    return F.concat(F.lit(mark), F.format_number(col, 2))


def write_part_csv(part: DataFrame, root: str) -> None:
    """Part as a latin-1 CSV with a doubled-quote field and a euro-byte price."""
    (part.select(F.col("p_partkey").alias("Part Key"), F.col("p_name").alias("Name"),
                 F.concat(F.col("p_name"), F.lit(', "'), F.col("p_brand"), F.lit('"')).alias("Description"),
                 _price_text("p_retailprice", "\x80").alias("Price (\x80)"))
     .write.option("header", True).option("encoding", "ISO-8859-1")
     .option("quote", '"').option("escape", '"').csv(root))


# Header variants of the sales register by order year: (years, price header,
# currency mark, code header, file encoding).
SALES_VARIANTS = [
    ((None, 1996), "Price (\x80)", "\x80", "Postal Code", "ISO-8859-1"),
    ((1997, 1998), "Price (?)", "?", "Postal Code", "ISO-8859-1"),
    ((1999, None), "Price (€)", "€", "Eircode", "UTF-8"),
]


def write_sales_register(orders: DataFrame, root: str) -> None:
    """Orders as yearly sales-register CSVs with three header spellings.

    Low-priority orders get an unparseable date, status ``P`` a non-market
    flag; urgent orders have a blank location code.  Orders are spread over all cores
    first: a Parquet file has few splits, and its text is many times larger.
    """
    d = F.col("o_orderdate")
    date_text = (F.when(F.col("o_orderpriority") == "5-LOW", F.lit("n/a"))
                 .when(F.col("o_orderpriority") == "2-HIGH", F.date_format(d, "d M yyyy"))
                 .otherwise(F.date_format(d, "dd/MM/yyyy")))
    code = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("")) \
        .otherwise(F.concat(F.lit("D"), F.substring("o_orderpriority", 1, 1)))
    base = orders.repartition("o_orderkey").withColumn("year", F.year("o_orderdate"))
    for (lo, hi), price_header, mark, code_header, encoding in SALES_VARIANTS:
        own = (F.lit(True) if lo is None else F.col("year") >= lo) & (F.lit(True) if hi is None else F.col("year") <= hi)
        (base.filter(own)
         .select("year",
                 date_text.alias("Date of Sale (dd/mm/yyyy)"),
                 F.concat(F.lit("Order "), F.col("o_orderkey"), F.lit(", Dublin")).alias("Address"),
                 F.lit("Dublin").alias("County"),
                 code.alias(code_header),
                 _price_text("o_totalprice", mark).alias(price_header),
                 F.when(F.col("o_orderstatus") == "P", F.lit("Yes")).otherwise(F.lit("No"))
                 .alias("Not Full Market Price"),
                 F.lit("No").alias("VAT Exclusive"),
                 lookup("o_orderstatus", ANALOG_DESCRIPTIONS).alias("Description of Property"),
                 F.lit("").alias("Property Size Description"))
         .write.mode("append").partitionBy("year").option("header", True).option("encoding", encoding)
         .option("quote", '"').option("escape", '"').csv(root))


def write_rent_extract(orders: DataFrame, root: str) -> None:
    """Orders as a flat cube CSV extract: code and label columns side by side."""
    (orders.repartition("o_orderkey").select(
        F.lit("RIA02").alias("STATISTIC"),
        F.lit("RTB Average Monthly Rent Report").alias("Statistic Label"),
        F.year("o_orderdate").cast("string").alias("TLIST(A1)"),
        F.year("o_orderdate").cast("string").alias("Year"),
        F.col("o_orderstatus").alias("C02970V03592"),
        F.when(F.col("o_orderstatus") == "F", F.lit(RENT_ALL_BEDROOMS)).otherwise(F.lit("One bed"))
        .alias("Number of Bedrooms"),
        F.lit("00").alias("C02969V03591"),
        F.lit(RENT_ALL_PROPERTY_TYPES).alias("Property Type"),
        F.substring("o_orderpriority", 1, 1).alias("C03004V03625"),
        F.col("o_orderpriority").alias("Location"),
        F.lit("Euro").alias("UNIT"),
        F.col("o_totalprice").cast("string").alias("VALUE"))
     .write.option("header", True).csv(root))


# --- Generic cube documents ----------------------------------------------------

def cube_documents(cells: DataFrame, doc_keys: list[str], dims: list[tuple], value_col: str) -> DataFrame:
    """JSON-stat documents, one per ``doc_keys`` group, from pre-aggregated cells.

    ``dims`` lists ``(dim_id, dim_label, code_col, label_col, form)`` in
    row-major order (last fastest); ``form`` is ``list``, ``dict`` or
    ``labels`` (empty index: codes are the label keys).  Category codes are
    the sorted distinct codes of each document; a combination without a
    cell is null.  A document holds one value per combination, so its size
    is bounded by the product of the category counts, never by row counts.
    """
    n = len(dims)
    key = F.concat_ws("|", *[F.col(d[2]) for d in dims])
    docs = cells.groupBy(*doc_keys).agg(
        F.map_from_entries(F.collect_list(F.struct(key, F.col(value_col)))).alias("_cells"),
        *[F.collect_set(F.struct(F.col(d[2]).alias("c"), F.col(d[3]).alias("l"))).alias(f"_s{i}")
          for i, d in enumerate(dims)])
    docs = docs.select(
        *doc_keys, "_cells",
        *[F.expr(f"array_sort(array_distinct(transform(_s{i}, e -> e.c)))").alias(f"_c{i}") for i in range(n)],
        *[F.map_from_entries(F.expr(f"transform(_s{i}, e -> struct(e.c, e.l))")).alias(f"_m{i}")
          for i in range(n)])
    # label maps written in code order: for the "labels" form that order *is*
    # the category order
    docs = docs.select(
        *doc_keys, "_cells", *[f"_c{i}" for i in range(n)],
        *[F.expr(f"map_from_arrays(_c{i}, transform(_c{i}, c -> _m{i}[c]))").alias(f"_l{i}")
          for i in range(n)])
    sizes = [F.size(f"_c{i}") for i in range(n)]
    stride = [" * ".join([f"size(_c{j})" for j in range(i + 1, n)]) or "1" for i in range(n)]
    total = " * ".join(f"size(_c{i})" for i in range(n))
    code_at = ", ".join(f"_c{i}[cast((p div ({stride[i]})) % size(_c{i}) AS INT)]" for i in range(n))
    values = F.expr(f"transform(sequence(0, {total} - 1), p -> _cells[concat_ws('|', {code_at})])")
    dim_structs = []
    for i, (dim_id, dim_label, _, _, form) in enumerate(dims):
        codes = F.col(f"_c{i}")
        index = {"list": codes,
                 "dict": F.map_from_arrays(codes, F.expr(f"sequence(0, size(_c{i}) - 1)")),
                 "labels": F.expr("cast(map() AS map<string,int>)")}[form]
        dim_structs.append(F.struct(F.lit(dim_label).alias("label"), F.struct(
            index.alias("index"), F.col(f"_l{i}").alias("label")).alias("category")).alias(dim_id))
    cube = F.struct(F.array(*[F.lit(d[0]) for d in dims]).alias("id"), F.array(*sizes).alias("size"),
                    F.struct(*dim_structs).alias("dimension"), values.alias("value"))
    return docs.select(*doc_keys, F.to_json(F.struct(cube.alias("result"))).alias("body"))


def price_cube_docs(orders: DataFrame) -> DataFrame:
    """Price-index-shaped cube documents from orders, one per order year."""
    cells = orders.groupBy(
        F.year("o_orderdate").alias("year"),
        F.date_format("o_orderdate", "yyyy'M'MM").alias("t_code"),
        F.date_format("o_orderdate", "yyyy MMMM").alias("t_label"),
        F.col("o_orderpriority").alias("p_code"),
        lookup("o_orderpriority", ANALOG_PROPERTY_TYPES).alias("p_label"),
        F.concat(F.lit("HPM06C0"), F.col("o_orderstatus")).alias("s_code"),
        lookup("o_orderstatus", ANALOG_STATISTICS).alias("s_label"),
    ).agg(F.round(F.sum("o_totalprice") / 10000, 2).alias("v"))
    return cube_documents(cells, ["year"], [
        ("STATISTIC", "Statistic", "s_code", "s_label", "list"),
        ("TLIST(M1)", "Month", "t_code", "t_label", "labels"),
        ("C02803V03373", "Type of Residential Property", "p_code", "p_label", "dict"),
    ], "v")


def permissions_cube_docs(lineitem: DataFrame) -> DataFrame:
    """Permissions-shaped cube documents from lineitem, one per return flag."""
    cells = lineitem.groupBy(
        F.col("l_returnflag").alias("flag"),
        F.year("l_shipdate").cast("string").alias("y"),
        F.col("l_linestatus").alias("s_code"),
        F.when(F.col("l_linestatus") == "O", F.lit(PERMISSIONS_STATISTIC)).otherwise(F.lit("Other"))
        .alias("s_label"),
        F.col("l_returnflag").alias("c_code"),
        F.when(F.col("l_returnflag") == "N", F.lit(PERMISSIONS_CONSTRUCTION)).otherwise(F.lit("Repair"))
        .alias("c_label"),
    ).agg(F.sum("l_quantity").alias("v"))
    return cube_documents(cells, ["flag"], [
        ("STATISTIC", "Statistic", "s_code", "s_label", "list"),
        ("TLIST(A1)", "Year", "y", "y", "labels"),
        ("C02342V02816", "Type of Construction", "c_code", "c_label", "dict"),
    ], "v")


def write_bronze(spark, orders: DataFrame, lineitem: DataFrame, bronze: str, stamp: str = "20240630") -> None:
    """The four Bronze sources, landed in the layout the jobs read."""
    for name, docs in (("house_price_index", price_cube_docs(orders)),
                       ("new_dwelling_completions", permissions_cube_docs(lineitem))):
        land_raw(docs.select(F.lit(stamp[:4]).alias("year"), F.lit(stamp[4:6]).alias("month"), "body"),
                 bronze, fmt="text", dataset_path=SILVER_PATHS[name])
    write_rent_extract(orders, f"{bronze}/{SILVER_PATHS['rent_by_county']}/year={stamp[:4]}/month={stamp[4:6]}")
    write_sales_register(orders, f"{bronze}/{SILVER_PATHS['sales_register']}")


# --- wide cubes, odd CSV files ---------------------------------------------------

def part_month_cube_docs(lineitem: DataFrame, keys_per_doc: int = 20_000) -> DataFrame:
    """Quantity by part and ship month as cubes with one very wide dimension: ``(body)``.

    A document holds one month and a range of ``keys_per_doc`` part keys, so it
    is bounded whatever the scale; the number of documents and cells grows.
    """
    cells = lineitem.groupBy(
        F.date_format("l_shipdate", "yyyy'M'MM").alias("m_code"), F.date_format("l_shipdate", "yyyy MMMM").alias("m_label"),
        F.floor(F.col("l_partkey") / keys_per_doc).alias("range"), F.col("l_partkey")).agg(F.sum("l_quantity").alias("v"))
    docs = cells.groupBy("m_code", "m_label", "range").agg(F.sort_array(F.collect_list(F.struct("l_partkey", "v"))).alias("c"))
    codes = F.transform("c", lambda x: F.concat(F.lit("P"), x["l_partkey"]))
    labels = F.map_from_arrays(codes, F.transform("c", lambda x: F.concat(F.lit("Part "), x["l_partkey"])))
    index = F.map_from_arrays(codes, F.sequence(F.lit(0), F.size("c") - 1))
    cube = F.struct(
        F.array(F.lit("TLIST(M1)"), F.lit("PART")).alias("id"), F.array(F.lit(1), F.size("c")).alias("size"),
        F.struct(
            F.struct(F.lit("Month").alias("label"), F.struct(
                F.array("m_code").alias("index"), F.create_map("m_code", "m_label").alias("label")).alias("category"))
            .alias("TLIST(M1)"),
            F.struct(F.lit("Part").alias("label"), F.struct(index.alias("index"), labels.alias("label")).alias("category"))
            .alias("PART")).alias("dimension"),
        F.transform("c", lambda x: x["v"]).alias("value"))
    return docs.select(F.to_json(cube).alias("body"))


def annual_cube_docs(orders: DataFrame) -> DataFrame:
    """Order counts by year and status as annual cubes, one per status: ``(body)``."""
    cells = orders.groupBy(F.col("o_orderstatus").alias("status"), F.year("o_orderdate").cast("string").alias("y")).agg(
        F.count(F.lit(1)).cast("double").alias("v"))
    return cube_documents(cells.withColumn("s", F.col("status")), ["status"], [
        ("TLIST(A1)", "Year", "y", "y", "labels"), ("STATUS", "Order Status", "s", "s", "list")], "v").select("body")


ODD_FILES = ("good", "duplicate header", "blank file", "line ends", "no date column", "field counts")


def write_odd_csv(customer: DataFrame, root: str, rows_per_file: int = 1000) -> None:
    """Customers as register-like CSV files, one per nation and key range, of the six
    kinds in ODD_FILES (by nation key): every file holds its customers, all with a
    date; of ``field counts`` files, customers in AUTOMOBILE have a field too many,
    those in BUILDING one too few."""
    seg, kind = F.col("c_mktsegment"), F.element_at(F.array(*[F.lit(k) for k in ODD_FILES]),
                                                    (F.col("c_nationkey") % len(ODD_FILES) + 1).cast("int"))
    plain = F.concat_ws(",", F.lit("01/02/2020"), F.col("c_name"), F.lit("Dublin"))
    row = (F.when((F.col("kind") == "field counts") & (seg == "AUTOMOBILE"), F.concat(plain, F.lit(",extra")))
           .when((F.col("kind") == "field counts") & (seg == "BUILDING"), F.concat_ws(",", F.lit("01/02/2020"), "c_name"))
           .otherwise(plain))
    files = (customer.withColumn("kind", kind).withColumn("row", row)
             .groupBy("kind", F.col("c_nationkey").alias("nation"), F.floor(F.col("c_custkey") / rows_per_file).alias("range"))
             .agg(F.array_sort(F.collect_list("row")).alias("rows")))
    header = (F.when(F.col("kind") == "duplicate header", "Date of Sale (dd/mm/yyyy),Note,note")
              .when(F.col("kind") == "no date column", "Day,Address,County")
              .otherwise("Date of Sale (dd/mm/yyyy),Address,County"))
    end = F.when(F.col("kind") == "line ends", "\r").otherwise("\n")
    lines = F.concat(F.array(header), F.col("rows"))
    text = F.when(F.col("kind") == "blank file", " ").otherwise(
        F.aggregate(F.slice(lines, F.lit(2), F.size(lines)), F.element_at(lines, 1), lambda a, r: F.concat(a, end, r)))
    # one row per file; a given number of tasks, as adaptive execution would let one task write
    # all these small files
    tasks = int(customer.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (files.select("nation", "range", text.alias("value")).repartition(tasks, "nation", "range").drop("range")
     .write.partitionBy("nation").option("maxRecordsPerFile", 1).text(root))
