"""Documents read by many tasks, sparse values and repeated keys."""

import json
import random

import pytest

from strata.operators import jsonstat
from strata.operators.cube_split import read_split, unpack_split


def document(n_rows, n_cols, values, key_first=True, pretty=False, **more):
    dims = {"R": {"label": "Row, all", "category": {"index": [f"r{i}" for i in range(n_rows)], "label": {"r0": 'first, "quoted"'}}},
            "C": {"label": "Column", "category": {"index": {f"c{i}": i for i in range(n_cols)}}}}
    doc = {"id": ["R", "C"], "size": [n_rows, n_cols], "dimension": dims}
    doc = {**doc, "value": values, **more} if key_first else {"value": values, **doc, **more}
    return json.dumps(doc, indent=1 if pretty else None)




def rows_of(df):
    names = [c for c in df.columns if c != "metric_value"]
    return sorted(((*(r[c] for c in names), r["metric_value"]) for r in df.collect()), key=repr)


def check_file(spark, folder, text):
    (folder / "doc.json").write_text(text, encoding="utf-8")
    got = rows_of(unpack_split(spark, str(folder)))
    whole = spark.createDataFrame([("p", text)], "path string, body string")
    assert got == rows_of(jsonstat.unpack(whole)) and got
    return got


@pytest.mark.parametrize("key_first,pretty", [(True, False), (False, False), (True, True), (False, True)])
def test_equals_the_whole_reader_over_many_splits(spark, tmp_path, key_first, pretty):
    rng = random.Random(3)
    values = [rng.choice([None, "..", rng.randint(0, 99), rng.random()]) for _ in range(40 * 25)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        check_file(spark, tmp_path, document(40, 25, values, key_first, pretty, status={"0": "a, b]"}))
        _, cells = read_split(spark, str(tmp_path))
        assert spark.read.option("lineSep", ",").text(str(tmp_path)).rdd.getNumPartitions() > 5
        assert cells.count() == 1000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("values", [[1.5], [1, 2, 3], list(range(9))])
def test_short_and_long_arrays(spark, tmp_path, values):
    check_file(spark, tmp_path, document(2, 3, values, updated="2024"))


def test_rejects_and_empty_arrays(spark, tmp_path):
    texts = {"empty.json": document(2, 2, []), "error.json": '{"error": {"code": 1, "message": "no, data"}}', "broken.json": "{nope, [1",
             "torn.json": document(1, 2, ["1,5", 2]), "sparse.json": document(1, 2, {"0": 1}), "good.json": document(1, 2, [7, 8])}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    parsed, cells = read_split(spark, str(tmp_path))
    reasons = {r["path"].rsplit("/", 1)[1]: r["reason"] for r in parsed.select("path", "reason").collect()}
    assert reasons == {"empty.json": None, "error.json": "error_reply", "broken.json": "malformed", "torn.json": "split_text",
                       "sparse.json": "no_values", "good.json": None}
    assert sorted((r["path"].rsplit("/", 1)[1], r["pos"], r["value"]) for r in cells.collect()) == [("good.json", 0, "7"), ("good.json", 1, "8")]


def test_too_many_documents_are_refused(spark, tmp_path, monkeypatch):
    for i in range(3):
        (tmp_path / f"{i}.json").write_text(document(1, 1, [1]))
    monkeypatch.setattr("strata.operators.cube_split.MAX_DOCUMENTS", 2)
    with pytest.raises(ValueError):
        read_split(spark, str(tmp_path))


# -- sparse values -----------------------------------------------------------------------

def test_sparse_equals_dense(spark, docs):
    rng = random.Random(4)
    values = [rng.choice([None, None, rng.randint(0, 9)]) for _ in range(60)]
    dense = document(12, 5, values)
    sparse = document(12, 5, {str(i): v for i, v in enumerate(values) if v is not None})
    want = rows_of(jsonstat.unpack(docs(dense)))
    assert rows_of(jsonstat.unpack(docs(sparse), sparse=True)) == want
    both = rows_of(jsonstat.unpack(docs(sparse, dense, sparse), sparse=True))
    assert both == sorted(want * 3, key=repr)
    enveloped = json.dumps({"result": json.loads(sparse)})
    assert rows_of(jsonstat.unpack(docs(enveloped), sparse=True)) == want


def test_sparse_is_rejected_unless_asked_for(docs):
    parsed = jsonstat.parse(docs(document(1, 2, {"0": 1})))
    assert [r["reason"] for r in jsonstat.rejects(parsed).collect()] == ["no_values"]
    parsed = jsonstat.parse(docs('{"id":["A"],"size":[1],"dimension":{"A":{}}}'), sparse=True)
    assert [r["reason"] for r in jsonstat.rejects(parsed).collect()] == ["no_values"]


def test_positions_outside_the_cube_are_noted(docs):
    text = document(1, 3, {"1": 5, "7": 1, "-1": 2, "x": 3, "2": None}).replace('"1": 5', '"1": 4, "1": 5, " 2": 6')
    parsed = jsonstat.parse(docs(text), sparse=True)
    assert sorted((r["key"], r["value"]) for r in jsonstat.dropped_positions(parsed).collect()) == [("-1", "2"), ("7", "1"), ("x", "3")]
    got = {r["pos"]: r["value"] for r in jsonstat.cells(parsed).collect()}
    assert got == {0: None, 1: "5", 2: None}


def test_a_large_sparse_cube_lists_all_its_cells(docs):
    text = document(300, 100, {"0": 1, "29999": 2, "4096": 3})
    cells = jsonstat.cells(jsonstat.parse(docs(text), sparse=True))
    assert cells.count() == 30_000 and cells.filter("value IS NOT NULL").count() == 3
    assert {r["pos"]: r["value"] for r in cells.filter("value IS NOT NULL").collect()} == {0: "1", 4096: "3", 29999: "2"}


# -- repeated keys -----------------------------------------------------------------------

def test_the_last_label_of_a_repeated_key_counts(docs):
    text = '{"id":["A"],"size":[2],"value":[1,2],"dimension":{"A":{"label":"A","category":{"index":["x","y"],"label":{"x":"X","x":"X2","y":"Y","x":"X3"}}}}}'
    assert rows_of(jsonstat.unpack(docs(text))) == [("X3", 1.0), ("Y", 2.0)]
    bare = text.replace('"index":["x","y"],', "")  # label keys are the codes, each once
    assert rows_of(jsonstat.unpack(docs(bare))) == [("X3", 1.0), ("Y", 2.0)]


def test_the_last_place_of_a_repeated_code_counts(docs):
    text = '{"id":["A"],"size":[3],"value":[1,2,3],"dimension":{"A":{"category":{"index":{"x":0,"y":1,"x":2,"z":0},"label":{}}}}}'
    assert rows_of(jsonstat.unpack(docs(text))) == [("x", 3.0), ("y", 2.0), ("z", 1.0)]


def test_repeated_keys_of_many_codes_stay_linear(docs):
    n = 30_000
    index = ",".join([f'"k{i}":{n + i}' for i in range(n)] + [f'"k{i}":{i}' for i in range(n)])
    text = f'{{"id":["A"],"size":[{n}],"value":{list(range(n))},"dimension":{{"A":{{"category":{{"index":{{{index}}}}}}}}}}}'
    wide = jsonstat.unpack(docs(text))
    assert wide.count() == n and wide.filter("a <> concat('k', cast(metric_value AS int))").count() == 0


# -- documents in parts ------------------------------------------------------------------

def test_a_document_in_parts_equals_the_whole(spark, tmp_path):
    text = document(40, 25, [None if i % 7 == 0 else i for i in range(1000)], status={"0": "a, b]"})
    pieces = text.split(",")
    folder = tmp_path / "cube"
    folder.mkdir()
    cuts = [0, 1, 30, 200, 201, 700, len(pieces)]  # before, inside and behind the array
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        (folder / f"part-{k:05d}.txt").write_text(",".join(pieces[a:b]) + (",\n" if b < len(pieces) else "\n"))
    whole = spark.createDataFrame([("p", text)], "path string, body string")
    assert rows_of(unpack_split(spark, str(folder), parts=True)) == rows_of(jsonstat.unpack(whole))


def test_a_part_cut_inside_a_cell_is_set_aside(spark, tmp_path):
    text = document(2, 2, [11, 22, 33, 44])
    for name, at in (("inside", text.index("22") + 1), ("behind", text.index("22"))):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part-0.txt").write_text(text[:at])
        (tmp_path / name / "part-1.txt").write_text(text[at:])
    parsed, cells = read_split(spark, str(tmp_path), parts=True)
    assert {r["path"].rsplit("/", 1)[1]: r["reason"] for r in parsed.collect()} == {"inside": "cut_cell", "behind": None}
    assert [(r["pos"], r["value"]) for r in cells.orderBy("pos").collect()] == [(0, "11"), (1, "22"), (2, "33"), (3, "44")]


def test_the_large_cube_is_written_by_many_tasks(spark, tmp_path):
    from strata.plans.whole_tables import q_cube_split
    spark.range(3000).selectExpr("id AS l_orderkey", "1 AS l_linenumber", "id % 7 AS l_partkey", "id / 4 AS l_extendedprice",
                                 "cast(id % 5 AS double) AS l_quantity").write.parquet(str(tmp_path / "lineitem.parquet"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = q_cube_split(spark, str(tmp_path))
        want = spark.range(3000).selectExpr("concat('r', id div 3) AS row", "concat('c', id % 3) AS column", "id / 4 AS price")
        prices = got.filter("measure = 'Price, each'")
        assert got.count() == 6000
        assert prices.join(want, ["row", "column"]).filter("metric_value = price").count() == 3000
        from strata.plans.whole_tables import large_cube
        import glob
        assert len(glob.glob(large_cube(spark, str(tmp_path)).removeprefix("file:") + "/part-*")) > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
