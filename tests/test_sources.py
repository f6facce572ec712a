"""File sources, landing, manifest, partitioned sink and catalog."""
import os

from pyspark.sql import functions as F

from strata.fixed_values import SALES_HEADER_PATTERNS, SALES_HEADER_SYNONYMS
from strata.plans.silver import SALES_CANONICAL, read_sales, sales_silver
from strata.plans.sinks import ensure_database, register_external, write_partitioned
from strata.session import scratch_path
from strata.sources.documents import read_documents
from strata.sources.files import (file_headers, list_files, load_manifest, manifest_tally,
                                  read_csv_by_header, split_header)


def write(path, text, encoding):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode(encoding))


HEAD_2015 = '"Date of Sale (dd/mm/yyyy)","Address","County","Postal Code","Price (\x80)",' \
            '"Not Full Market Price","VAT Exclusive","Description of Property","Property Size Description"\n'
HEAD_2021 = 'Date of Sale (dd/mm/yyyy),Address,County,Eircode,Price (€),Not Full Market Price,' \
            'VAT Exclusive,Description of Property,Property Size Description\n'


def sales_files(root):
    write(f"{root}/year=2015/month=full/ppr_2015.csv",
          HEAD_2015 + '"02/01/2015","1 Main St, Dublin 6","Dublin","Dublin 6","\x80343,000.00","No","No",'
          '"Second-Hand Dwelling house /Apartment",""\n'
          '"1 1 2015","""The Mews"", Dublin","Dublin","","\x80100,000.00","Yes","No","New Dwelling house",""\n',
          "latin-1")
    write(f"{root}/year=2021/month=full/ppr_2021.csv",
          HEAD_2021 + '3/06/2021,2 High St,Dublin,D06 XY12,"€410,000.00",,No,New Dwelling house /Apartment,\n'
          'garbage,3 Low St,Dublin,,"€1.00",No,No,Second-Hand,\n', "utf-8")
    write(f"{root}/year=2016/month=full/empty.csv", "", "utf-8")
    write(f"{root}/notes.txt", "not a csv", "utf-8")


def test_split_header():
    assert split_header('"a","b ""x""",c') == ["a", 'b "x"', "c"]


def test_headers_and_mixed_read(spark):
    root = scratch_path(spark, "t-sales")
    sales_files(root)
    files = list_files(spark, root)
    assert files.count() == 2  # zero-length file holds no rows and is not listed
    heads = {os.path.basename(r.path): r.header for r in file_headers(spark, [r.path for r in files.collect()]).collect()}
    assert heads["ppr_2015.csv"].startswith('"Date of Sale') and heads["ppr_2021.csv"].startswith("Date of")
    raw, rejected = read_sales(spark, root)
    assert rejected.count() == 0
    assert set(SALES_CANONICAL) <= set(raw.columns)
    rows = {r.address: r for r in raw.collect()}
    assert rows['"The Mews", Dublin'].price_raw == "\x80100,000.00"
    assert rows["1 Main St, Dublin 6"].postal_code == "Dublin 6"
    assert rows["2 High St"].eircode == "D06 XY12"
    silver, obs = sales_silver(raw, "2024-06-30")
    got = {r.address: (r.date_of_sale.isoformat(), r.price_eur, r.location_code, r.year)
           for r in silver.collect()}
    # "Yes" (not full market price) and the garbage date are dropped
    assert got == {"1 Main St, Dublin 6": ("2015-01-02", 343000.0, "Dublin 6", 2015),
                   "2 High St": ("2021-06-03", 410000.0, "D06 XY12", 2021)}
    assert obs.get == {"rows_in": 4, "rows_dropped": 1}


def test_blank_header_rejected(spark):
    root = scratch_path(spark, "t-blank")
    write(f"{root}/a.csv", "\n \n", "utf-8")
    raw, rejected = read_csv_by_header(spark, root, SALES_HEADER_SYNONYMS)
    assert raw is None and rejected.first().reason == "no header"
    write(f"{root}/b.csv", "\nx,y\n1,2\n", "utf-8")  # the header is the first line with text
    raw, _ = read_csv_by_header(spark, root, SALES_HEADER_SYNONYMS)
    assert [(r.x, r.y) for r in raw.collect()] == [("1", "2")]


def test_required_column_rejects_group(spark):
    root = scratch_path(spark, "t-noreq")
    write(f"{root}/a.csv", "Address,County\nx,y\n", "utf-8")
    raw, rejected = read_csv_by_header(spark, root, SALES_HEADER_SYNONYMS, SALES_HEADER_PATTERNS,
                                       required=["date_of_sale_raw"])
    assert raw is None and rejected.first().reason == "missing column date_of_sale_raw"


def test_missing_paths_are_empty(spark):
    missing = scratch_path(spark, "t-missing")
    assert read_documents(spark, missing).count() == 0
    assert list_files(spark, missing).count() == 0


def test_documents_one_per_line_and_whole_file(spark):
    root = scratch_path(spark, "t-docs")
    write(f"{root}/year=2024/month=05/data_1.json", '{"a": 1}\n{"a": 2}\n', "utf-8")
    write(f"{root}/year=2024/month=06/data_2.json", '{\n "a": 3\n}\n', "utf-8")
    lines = read_documents(spark, root)
    assert lines.columns == ["path", "modified", "body"] and lines.count() == 5
    assert read_documents(spark, root, whole_file=True).count() == 2


def test_manifest(spark):
    root = scratch_path(spark, "t-land")
    write(f"{root}/dataset=ppr_2015/year=2024/month=06/a.csv", "h\n1\n2\n", "utf-8")
    write(f"{root}/dataset=rtb/year=2024/month=06/b.csv", "", "utf-8")
    m = load_manifest(spark, root, ["ppr_2015", "rtb", "cso"])
    got = {r.dataset: (r.status, r.row_count, r.error) for r in m.collect()}
    assert got == {"ppr_2015": ("success", 2, None), "rtb": ("failed", None, "no data landed"),
                   "cso": ("failed", None, "no data landed")}
    assert {r.status: r.n for r in manifest_tally(m).collect()} == {"success": 1, "failed": 2}
    key = [r.key for r in m.collect() if r.dataset == "ppr_2015"][0]
    assert key == "dataset=ppr_2015/year=2024/month=06/a.csv"


def test_partitioned_write_and_catalog(spark):
    path = scratch_path(spark, "t-part")
    df = spark.range(1000).select((F.col("id") % 4 + 2020).cast("int").alias("year"), F.col("id").alias("v"))
    obs = write_partitioned(df, path, ["year"], checks={"rows": F.count(F.lit(1))})
    assert obs.get == {"rows": 1000}
    dirs = sorted(d for d in os.listdir(path.replace("file:", "")) if d.startswith("year="))
    assert dirs == [f"year={y}" for y in range(2020, 2024)]
    back = spark.read.parquet(path).filter(F.col("year").between(2021, 2022))
    assert back.count() == 500
    ensure_database(spark, "t_strata", scratch_path(spark, "t-db"))
    name = register_external(spark, "t_strata", "gold_t", path, df)
    assert spark.table(name).count() == 1000
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 4


def reasons(rejects):
    return sorted((os.path.basename(r.path), r.reason, r.record) for r in rejects.collect())


def test_odd_files_and_rows_do_not_end_the_read(spark):
    root = scratch_path(spark, "t-odd")
    write(f"{root}/dup.csv", "Date of Sale (dd/mm/yyyy),Note,note\n01/01/2020,a,b\n", "utf-8")
    write(f"{root}/cr.csv", "Date of Sale (dd/mm/yyyy),Address\r02/01/2020,x\r", "utf-8")
    write(f"{root}/blank.csv", " \n\n", "utf-8")
    write(f"{root}/nodate.csv", "Address\nx\n", "utf-8")
    write(f"{root}/open.csv", 'Date of Sale (dd/mm/yyyy),"Add\nress"\n01/01/2020,x\n', "utf-8")
    write(f"{root}/rows.csv", 'Date of Sale (dd/mm/yyyy),Address,County\n03/01/2020,"a, ""b""",Dublin,extra\n'
                              "04/01/2020,c\n05/01/2020,d,Cork\n", "utf-8")
    raw, rejects = read_csv_by_header(spark, root, SALES_HEADER_SYNONYMS, required=["date_of_sale_raw"])
    assert sorted(r.date_of_sale_raw for r in raw.collect()) == [f"0{i}/01/2020" for i in range(1, 6)]
    assert reasons(rejects) == [
        ("blank.csv", "no header", None), ("dup.csv", "duplicate header", None),
        ("nodate.csv", "missing column date_of_sale_raw", None),
        ("open.csv", "bad header: header spans several lines", None),
        ("rows.csv", "too few fields", "04/01/2020,c"),
        ("rows.csv", "too many fields", '03/01/2020,"a, ""b""",Dublin,extra')]


def test_very_long_header(spark):
    root = scratch_path(spark, "t-long")
    names = [f"{'column' * 20}{i}" for i in range(10_000)]  # 1.2 MB
    write(f"{root}/a.csv", ",".join([*names, "Date of Sale (dd/mm/yyyy)"]) + "\n" + "," * 10_000 + "01/02/2023\n", "utf-8")
    raw, rejects = read_csv_by_header(spark, root, SALES_HEADER_SYNONYMS, required=["date_of_sale_raw"])
    assert rejects.count() == 0 and len(raw.columns) == 10_002
    assert raw.select("date_of_sale_raw").first()[0] == "01/02/2023"


def test_paths_with_blanks_and_percent_signs(spark):
    root = scratch_path(spark, "t-blank path")
    write(f"{root}/a b 100%.csv", "Address\nx\n", "utf-8")
    raw, _ = read_csv_by_header(spark, root, SALES_HEADER_SYNONYMS)
    assert [r.address for r in raw.collect()] == ["x"]


def newest(spark, root, *args):
    from strata.sources.files import newest_snapshot_files
    read, old = newest_snapshot_files(spark, root, *args)
    return [sorted(p.split(root.replace("file:", ""))[-1] for p in ps) for ps in (read, old)]


def test_every_file_of_the_newest_landing_is_read(spark):
    root = scratch_path(spark, "t-newest")
    for rel in ["cube/year=2024/month=9/data_20240930_120000.json", "cube/year=2024/month=10/data_20241031_120000.json",
                "three/year=2024/month=6/a.json", "three/year=2024/month=6/b.json", "three/year=2024/month=6/c.json",
                "three/year=2024/month=5/a.json",
                "sales/ppr-2015.csv", "sales/ppr-2016.csv", "sales/ppr-2020.csv",
                "yearly/year=2015/month=full/ppr_2015_dublin_20240531.csv",
                "yearly/year=2015/month=full/ppr_2015_dublin_20240630.csv",
                "yearly/year=2015/month=full/ppr_2015_cork_20240531.csv", "yearly/year=2016/month=full/ppr_2016_dublin_20240531.csv",
                "parts/year=2024/month=2/part-00000-a.txt", "parts/year=2024/month=2/part-00001-a.txt",
                "parts/year=2023/month=12/part-00000-b.txt"]:
        write(f"{root}/{rel}", "x\n", "utf-8")
    assert newest(spark, f"{root}/cube") == [["/year=2024/month=10/data_20241031_120000.json"],
                                             ["/year=2024/month=9/data_20240930_120000.json"]]
    assert newest(spark, f"{root}/three") == [[f"/year=2024/month=6/{x}.json" for x in "abc"], ["/year=2024/month=5/a.json"]]
    assert newest(spark, f"{root}/sales", "*.csv", ()) == [["/ppr-2015.csv", "/ppr-2016.csv", "/ppr-2020.csv"], []]
    read, old = newest(spark, f"{root}/yearly", "*.csv", ())
    assert old == ["/year=2015/month=full/ppr_2015_dublin_20240531.csv"] and len(read) == 3
    assert newest(spark, f"{root}/parts") == [
        ["/year=2024/month=2/part-00000-a.txt", "/year=2024/month=2/part-00001-a.txt"],
        ["/year=2023/month=12/part-00000-b.txt"]]


def test_manifest_names_datasets_in_both_layouts(spark):
    root = scratch_path(spark, "t-land-names")
    write(f"{root}/dataset=orders 1/year=2024/month=06/a.csv", "h\n1\n", "utf-8")
    write(f"{root}/cso/house_price_index/year=2024/month=06/data_20240630.json", "{}\n", "utf-8")
    write(f"{root}/ppr/sales 100%/ppr-2015.csv", "h\n1\n2\n", "utf-8")
    m = load_manifest(spark, root, ["orders 1", "cso/house_price_index", "ppr/sales 100%", "rtb"])
    got = {r.dataset: (r.status, r.row_count) for r in m.collect()}
    assert got == {"orders 1": ("success", 1), "cso/house_price_index": ("success", 0), "ppr/sales 100%": ("success", 2),
                   "rtb": ("failed", None)}
    assert load_manifest(spark, f"{root}/none", ["x"]).first().status == "failed"


def test_manifest_of_one_run(spark):
    import time
    root = scratch_path(spark, "t-land-run")
    write(f"{root}/dataset=a/year=2024/month=05/old.csv", "h\n1\n", "utf-8")
    old = os.path.getmtime(f"{root}/dataset=a/year=2024/month=05/old.csv".replace("file:", ""))
    os.utime(f"{root}/dataset=a/year=2024/month=05/old.csv".replace("file:", ""), (old - 3600, old - 3600))
    start = time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime(time.time() - 60))
    write(f"{root}/dataset=a/year=2024/month=06/new.csv", "h\n1\n2\n3\n", "utf-8")
    m = load_manifest(spark, root, ["a"], since=start).collect()
    assert [(r.dataset, r.status, r.row_count) for r in m] == [("a", "success", 3)]


def test_csv_missing_path_and_text_landing(spark):
    from strata.sources.files import land_raw, read_csv_explicit
    assert read_csv_explicit(spark, scratch_path(spark, "t-none")) is None
    root = scratch_path(spark, "t-land-text")
    docs = spark.createDataFrame([("cso", 2024, "06", '{"a": 1}'), ("cso", 2024, "06", '{"a": 2}')],
                                 "dataset string, year int, month string, body string")
    land_raw(docs, root, fmt="text")
    back = read_documents(spark, root)
    assert sorted(r.body for r in back.collect()) == ['{"a": 1}', '{"a": 2}']
    assert all("dataset=cso/year=2024/month=06/" in r.path for r in back.collect())


def test_pretty_printed_cube_needs_whole_file_mode(spark):
    import json as _json

    from strata.operators import jsonstat
    root = scratch_path(spark, "t-pretty")
    doc = {"id": ["A"], "size": [2], "value": [1, 2],
           "dimension": {"A": {"label": "A", "category": {"index": ["x", "y"]}}}}
    write(f"{root}/cube.json", _json.dumps(doc, indent=2), "utf-8")
    whole = jsonstat.parse(read_documents(spark, root, whole_file=True).select("path", "body"))
    assert jsonstat.cells(whole).count() == 2
    lines = jsonstat.parse(read_documents(spark, root).select("path", "body"))
    assert lines.filter("reason IS NULL").count() == 0  # fragments of a document are rejected


def test_folders_of_one_header_are_read_by_name(spark, tmp_path, monkeypatch):
    """Files of one folder cost one path; mixed folders and given files are read file by file."""
    from strata.sources import files as source
    good, other = "Date of Sale (dd/mm/yyyy),Address\n", "Date of Sale (dd/mm/yyyy),Address,County\n"
    for folder, heads in {"one": [good, good, good], "mixed": [good, other], "deep": [other]}.items():
        (tmp_path / folder).mkdir()
        for i, head in enumerate(heads):
            (tmp_path / folder / f"{i}.csv").write_text(f"{head}01/02/2020,{folder}{i}" + (",X\n" if head is other else "\n"))
    (tmp_path / "deep" / "below").mkdir()
    (tmp_path / "deep" / "below" / "0.csv").write_text(f"{good}01/02/2020,below\n")
    (tmp_path / "one" / "note.txt").write_text("not a register\n")
    seen = []
    kept = source._folders_of_one_group
    monkeypatch.setattr(source, "_folders_of_one_group", lambda *a: seen.append(kept(*a)) or seen[-1])
    rows, rejects = source.read_csv_by_header(spark, str(tmp_path), SALES_HEADER_SYNONYMS)
    want = {"one0", "one1", "one2", "mixed0", "mixed1", "deep0", "below"}
    assert sorted(r["address"] for r in rows.collect()) == sorted(want) and rejects.count() == 0
    assert {os.path.basename(f) for f in seen[0].values()} == {"one", "below"} and len(seen[0]) == 4
    some = [str(tmp_path / "one" / "0.csv"), str(tmp_path / "one" / "2.csv")]
    rows, _ = source.read_csv_by_header(spark, some, SALES_HEADER_SYNONYMS)
    assert sorted(r["address"] for r in rows.collect()) == ["one0", "one2"] and seen[1] == {}


def test_odd_csv_files_are_written_by_many_tasks(spark, tmp_path):
    from strata.plans.fixtures import write_odd_csv
    customer = spark.range(4000).selectExpr("id AS c_custkey", "concat('C', id) AS c_name", "cast(id % 12 AS int) AS c_nationkey",
                                            "'BUILDING' AS c_mktsegment")
    write_odd_csv(customer, str(tmp_path / "odd"), rows_per_file=100)
    names = [r["path"] for r in list_files(spark, str(tmp_path / "odd"), "*.txt").collect()]
    assert len(names) == 12 * 40
    assert len({os.path.basename(n).split("-")[1] for n in names}) > 4  # the writing tasks' numbers


def test_headers_are_found_without_a_sort(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text(f"\n  \nhead {i},x\nrow,1\n")
    (tmp_path / "blank.csv").write_text(" \n\n")
    heads = file_headers(spark, [str(tmp_path / f"{n}.csv") for n in (0, 1, 2, "blank")])
    assert sorted(r["header"] for r in heads.collect()) == ["head 0,x", "head 1,x", "head 2,x"]
    assert "Sort" not in heads._jdf.queryExecution().executedPlan().toString()


def test_bronze_text_is_written_by_many_tasks(spark, tmp_path):
    from strata.plans.fixtures import write_rent_extract
    orders = spark.range(0, 200_000, 1, 1).selectExpr(
        "id AS o_orderkey", "timestamp'1995-01-01' AS o_orderdate", "'F' AS o_orderstatus", "'1-URGENT' AS o_orderpriority",
        "cast(id AS double) AS o_totalprice")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # few rows would be put together
    try:
        write_rent_extract(orders, str(tmp_path / "rents"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert list_files(spark, str(tmp_path / "rents")).count() > 1
    assert spark.read.option("header", True).csv(str(tmp_path / "rents")).count() == 200_000
