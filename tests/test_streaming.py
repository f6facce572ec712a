"""Incremental cube unpack: each run appends only newly landed documents."""
import json
import os

from strata.session import scratch_path
from strata.streaming.bronze import cube_to_silver_stream


def doc(year, values):
    return json.dumps({"result": {
        "id": ["STATISTIC", "TLIST(A1)"], "size": [1, len(values)],
        "dimension": {"STATISTIC": {"label": "Statistic", "category": {"index": ["S1"], "label": {"S1": "Stock"}}},
                      "TLIST(A1)": {"label": "Year", "category": {
                          "index": {}, "label": {str(year + i): str(year + i) for i in range(len(values))}}}},
        "value": values}})


def land(root, name, body):
    os.makedirs(root, exist_ok=True)
    with open(f"{root}/{name}", "w") as f:
        f.write(body + "\n")


COLUMNS = [("STATISTIC", "statistic"), ("TLIST(A1)", "period")]


def run(spark, bronze, silver, ckpt):
    cube_to_silver_stream(spark, f"{bronze}/*/*/*", silver, "TEST01", "2024-06-30", COLUMNS, checkpoint=ckpt).awaitTermination()
    return sorted((r.year, r.metric_value) for r in spark.read.parquet(silver).collect())


def test_runs_take_new_documents_and_replace_cubes_landed_again(spark):
    bronze = scratch_path(spark, "t-stream-bronze").replace("file:", "")
    silver, ckpt = scratch_path(spark, "t-stream-silver"), scratch_path(spark, "t-stream-ckpt")
    land(f"{bronze}/a/year=2024/month=9", "data_20240901.json", doc(2020, [1, 2]))
    assert run(spark, bronze, silver, ckpt) == [(2020, 1.0), (2021, 2.0)]
    land(f"{bronze}/b/year=2024/month=10", "data_20241001.json", doc(2022, [3]))
    land(f"{bronze}/a/year=2024/month=10", "data_20241001.json", doc(2020, [7, 8, 9]))  # the same cube again
    land(f"{bronze}/c/year=2024/month=10", "data_20241001.json", '{"error": {"code": 1}}')
    assert run(spark, bronze, silver, ckpt) == [(2020, 7.0), (2021, 8.0), (2022, 3.0), (2022, 9.0)]
    assert [r.reason for r in spark.read.json(f"{silver}/_rejects").collect()] == ["error_reply"]


def test_replayed_batch_is_not_duplicated(spark):
    from strata.streaming.bronze import write_cube_batch
    silver = scratch_path(spark, "t-stream-replay")
    batch = spark.createDataFrame([("x/a.json", doc(2020, [1, 2]))], "path string, body string")
    for _ in range(2):
        write_cube_batch(batch, 7, silver, "TEST01", "2024-06-30", COLUMNS)
    write_cube_batch(spark.createDataFrame([("x/b.json", doc(2020, [9]))], "path string, body string"),
                     8, silver, "TEST01", "2024-06-30", COLUMNS)
    rows = sorted((r.year, r.metric_value) for r in spark.read.parquet(silver).collect())
    assert rows == [(2020, 1.0), (2020, 9.0), (2021, 2.0)]


def test_undeclared_dimension_is_rejected_and_the_schema_stays(spark):
    from strata.streaming.bronze import write_cube_batch
    silver = scratch_path(spark, "t-stream-schema")
    odd = json.loads(doc(2020, [5]))
    odd["result"]["id"].append("SECTOR")
    odd["result"]["size"].append(1)
    odd["result"]["dimension"]["SECTOR"] = {"label": "Sector", "category": {"index": ["s"]}}
    batch = [("x/a.json", doc(2020, [1])), ("x/b.json", json.dumps(odd))]
    write_cube_batch(spark.createDataFrame(batch, "path string, body string"), 1, silver, "T", "2024-06-30", COLUMNS)
    back = spark.read.parquet(silver)
    assert set(back.columns) == {"statistic", "period", "metric_value", "source_dataset", "ingestion_date", "year", "dataset_key"}
    assert back.count() == 1
    assert [r.reason for r in spark.read.json(f"{silver}/_rejects").collect()] == ["undeclared_dimension"]
