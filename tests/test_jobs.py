"""The two batch jobs on a tiny hand-made Bronze tree."""
import json
import os

from strata.fixed_values import KEY_PROPERTY_TYPES
from strata.plans import jobs
from strata.session import scratch_path


def write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode(encoding))


def price_doc(value):
    return json.dumps({"result": {
        "id": ["STATISTIC", "TLIST(M1)", "C02803V03373"], "size": [1, 1, 1],
        "dimension": {
            "STATISTIC": {"label": "Statistic", "category": {"index": ["HPM06C01"], "label": {
                "HPM06C01": "Residential Property Price Index"}}},
            "TLIST(M1)": {"label": "Month", "category": {"index": {}, "label": {"2023M12": "2023 December"}}},
            "C02803V03373": {"label": "Type of Residential Property", "category": {
                "index": {"1": 0}, "label": {"1": KEY_PROPERTY_TYPES[0]}}}},
        "value": [value]}})


def test_jobs_keep_latest_snapshot_and_register(spark):
    root = scratch_path(spark, "t-jobs").replace("file:", "")
    hpi = f"{root}/bronze/cso/house_price_index"
    write(f"{hpi}/year=2024/month=05/data_20240531_120000.json", price_doc(150.0) + "\n")
    write(f"{hpi}/year=2024/month=06/data_20240630_120000.json", price_doc(163.6) + "\n")
    perms = json.dumps({
        "id": ["STATISTIC", "TLIST(A1)", "C02342V02816"], "size": [1, 1, 1],
        "dimension": {
            "STATISTIC": {"label": "Statistic", "category": {"index": ["B1"], "label": {
                "B1": "Planning Permissions Granted for Communal Dwellings"}}},
            "TLIST(A1)": {"label": "Year", "category": {"label": {"2023": "2023"}}},
            "C02342V02816": {"label": "Type of Construction", "category": {
                "index": ["N"], "label": {"N": "New construction"}}}},
        "value": [42]})
    write(f"{root}/bronze/cso/new_dwelling_completions/year=2024/month=06/data_20240630_120000.json",
          perms + "\n")
    rents = f"{root}/bronze/rtb/rent_by_county"
    head = "Statistic Label,Year,Number of Bedrooms,Property Type,Location,VALUE\n"
    write(f"{rents}/year=2024/month=05/rtb.csv", head + "Rent,2023,All bedrooms,All property types,Dublin,1000\n")
    write(f"{rents}/year=2024/month=06/rtb.csv", head + "Rent,2023,All bedrooms,All property types,Dublin,1500\n")
    sales = f"{root}/bronze/ppr/sales_register/year=2023/month=full"
    shead = "Date of Sale (dd/mm/yyyy),Address,County,Eircode,Price (\x80),Not Full Market Price," \
            "VAT Exclusive,Description of Property,Property Size Description\n"
    write(f"{sales}/ppr_2023_dublin_20240531.csv", shead + "01/02/2023,a,Dublin,,\x80100,No,No,New,\n", "latin-1")
    write(f"{sales}/ppr_2023_dublin_20240630.csv", shead + "01/02/2023,a,Dublin,,\x80200,No,No,New,\n"
          + "02/02/2023,b,Dublin,,\x80400,No,No,Second-Hand,\n", "latin-1")
    metrics = jobs.bronze_to_silver(spark, f"{root}/bronze", f"{root}/silver", "2024-06-30",
                                    database="t_jobs", database_location=f"{root}/catalog")
    assert spark.table("t_jobs.silver_sales_register").count() == 2
    assert spark.table("t_jobs.silver_house_price_index").first().metric_value == 163.6
    assert metrics["house_price_index"]["rows"] == 1
    assert metrics["rent_by_county"]["rows"] == 1
    assert metrics["sales_register"]["rows"] == 2
    paths = jobs.silver_to_gold(spark, f"{root}/silver", f"{root}/gold", "2024-06-30",
                                database="t_jobs", database_location=f"{root}/catalog")
    assert len(paths) == 5
    summary = spark.table("t_jobs.gold_housing_crisis_summary").collect()
    assert [(r.year, r.national_price_index, r.avg_national_rent, r.new_communal_permissions,
             r.dublin_total_sales, r.dublin_avg_sale_price) for r in summary] == \
        [(2023, 163.6, 1500.0, 42.0, 2, 300.0)]


def test_refresh_and_publish_after_a_correction(spark):
    """A corrected file of one year: Silver and Gold rewrite that year, and rents the next one."""
    root = scratch_path(spark, "t-refresh").replace("file:", "")
    head = "Statistic Label,Year,Number of Bedrooms,Property Type,Location,VALUE\n"
    row = "Rent,{},All bedrooms,All property types,{},{}\n"
    doc = json.dumps({"id": ["STATISTIC", "TLIST(A1)", "C02342V02816"], "size": [1, 1, 1], "value": [42], "dimension": {
        "STATISTIC": {"label": "Statistic", "category": {"index": ["B1"], "label": {"B1": "Planning Permissions Granted for Communal Dwellings"}}},
        "TLIST(A1)": {"label": "Year", "category": {"label": {"2023": "2023"}}},
        "C02342V02816": {"label": "Type of Construction", "category": {"index": ["N"], "label": {"N": "New construction"}}}}})
    shead = "Date of Sale (dd/mm/yyyy),Address,County,Eircode,Price (\x80),Not Full Market Price," \
            "VAT Exclusive,Description of Property,Property Size Description\n"
    years = (2020, 2021, 2022, 2023)

    def bronze(name, rent_2021):
        at = f"{root}/{name}"
        write(f"{at}/rtb/rent_by_county/year=2024/month=05/rtb.csv",
              head + "".join(row.format(y, "Cork", rent_2021 if y == 2021 else y) for y in years))
        write(f"{at}/cso/house_price_index/year=2024/month=05/d.json", price_doc(150.0) + "\n")
        write(f"{at}/cso/new_dwelling_completions/year=2024/month=05/d.json", doc + "\n")
        write(f"{at}/ppr/sales_register/year=2023/month=full/ppr.csv",
              shead + "".join(f"01/02/{y},a,Dublin,,\x80{y},No,No,New,\n" for y in years), "latin-1")
        return at

    run = lambda at, date: jobs.bronze_to_silver(spark, at, f"{root}/silver", date, incremental=True)
    first = run(bronze("one", 2021), "2024-06-30")
    assert first["rent_by_county"]["rewritten"] == list(years) and first["rent_by_county"]["rows"] == 4
    jobs.refresh_gold(spark, f"{root}/silver", f"{root}/gold", "2024-06-30")
    second = run(bronze("two", 3000), "2024-07-31")
    assert {k: m["rewritten"] for k, m in second.items()} == {
        "house_price_index": [], "new_dwelling_completions": [], "rent_by_county": [2021], "sales_register": []}
    done = jobs.refresh_gold(spark, f"{root}/silver", f"{root}/gold", "2024-07-31")
    # the summary follows every row of the marts that differs
    assert sorted(d["rebuilt"] for d in done.values()) == [[], [], [], [2021, 2022], [2021, 2022]]
    jobs.silver_to_gold(spark, f"{root}/silver", f"{root}/full", "2024-07-31")
    versions = jobs.publish_gold(spark, f"{root}/silver", "2024-07-31", "t_published", f"{root}/catalog")
    for name in versions:
        same = lambda df: sorted(map(repr, df.drop("gold_updated").collect()))
        full = spark.read.parquet(f"{root}/full/{name}")
        assert same(spark.read.parquet(f"{root}/gold/{name}").select(full.columns)) == same(full)
        assert same(spark.table(f"t_published.{name}").select(full.columns)) == same(full)
