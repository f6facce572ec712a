"""Cube unpack on small hand-made cubes, edge cases and large shapes."""
import json
import time

from pyspark.sql import functions as F

from strata.operators import jsonstat

TIDES = {"result": {
    "id": ["MEASURE", "TLIST(Q1)"], "size": [2, 3],
    "dimension": {
        "MEASURE": {"label": "Measure", "category": {
            "index": ["hi", "lo"], "label": {"hi": "High water (m)", "lo": "Low water (m)"}}},
        "TLIST(Q1)": {"label": "Quarter", "category": {
            "index": {}, "label": {"2019Q1": "2019 Q1", "2019Q2": "2019 Q2", "2019Q3": "2019 Q3"}}}},
    "value": [4.1, 4.4, 3.9, 0.7, 0.5, 0.9]}}

HARBOURS = {
    "id": ["PORT"], "size": [4],
    "dimension": {"PORT": {"label": "Harbour", "category": {
        "index": {"N": 2, "S": 0, "W": 3, "E": 1},
        "label": {"E": "East Quay", "N": "North Pier", "S": "South Slip", "W": "West Basin"}}}},
    "value": [11, 12, 13, 14]}


def cube(ids, sizes, cats, values, labels=None):
    return {"id": ids, "size": sizes, "value": values, "dimension": {
        d: {"label": (labels or {}).get(d, d), "category": c} for d, c in zip(ids, cats)}}


def unpacked(df, **kw):
    """The wide rows in cell order."""
    parsed = jsonstat.parse(df)
    return jsonstat.widen(parsed, jsonstat.dimension_columns(parsed), keep=["path", "pos"], **kw).orderBy("path", "pos")


def test_cube_rows_in_order(docs):
    wide = jsonstat.unpack(docs(json.dumps(TIDES)), keep=["path"])
    assert wide.columns == ["path", "measure", "period", "metric_value"]
    got = [(r.measure, r.period, r.metric_value) for r in unpacked(docs(json.dumps(TIDES))).collect()]
    quarters = ["2019 Q1", "2019 Q2", "2019 Q3"]
    assert got == [(m, q, v) for (m, q), v in zip(
        [(m, q) for m in ("High water (m)", "Low water (m)") for q in quarters], TIDES["result"]["value"])]
    assert [r.value for r in jsonstat.cells(jsonstat.parse(docs(json.dumps(TIDES)))).orderBy("pos").collect()] == [
        "4.1", "4.4", "3.9", "0.7", "0.5", "0.9"]


def test_dict_index_orders_by_position(docs):
    got = [(r.harbour, r.metric_value) for r in unpacked(docs(json.dumps(HARBOURS))).collect()]
    assert got == [("South Slip", 11.0), ("East Quay", 12.0), ("North Pier", 13.0), ("West Basin", 14.0)]


def test_bare_and_wrapped_cubes_agree(docs):
    both = unpacked(docs(json.dumps(HARBOURS), json.dumps({"result": HARBOURS}))).collect()
    assert [r[2:] for r in both if r.path == "doc0"] == [r[2:] for r in both if r.path == "doc1"]


def test_label_falls_back_to_code(docs):
    doc = cube(["A"], [3], [{"index": ["x", "y", "z"], "label": {"y": "Why"}}], [1, 2, 3])
    assert [r.a for r in unpacked(docs(json.dumps(doc))).collect()] == ["x", "Why", "z"]


def test_list_index_and_missing_index(docs):
    doc = cube(["A", "B"], [2, 2], [{"index": ["p", "q"]}, {"label": {"k2": "Two", "k1": "One"}}], [1, 2, 3, 4])
    assert [(r.a, r.b) for r in unpacked(docs(json.dumps(doc))).collect()] == [
        ("p", "Two"), ("p", "One"), ("q", "Two"), ("q", "One")]


def test_value_longer_or_shorter_than_sizes(docs):
    short = cube(["A"], [5], [{"index": list("abcde")}], [1, 2, 3])
    long = cube(["A"], [2], [{"index": list("ab")}], [1, 2, 3, 4])
    c = jsonstat.cells(jsonstat.parse(docs(json.dumps(short), json.dumps(long))))
    by_doc = {}
    for r in c.collect():
        by_doc.setdefault(r.path, []).append(r.value)
    assert sorted(by_doc["doc0"]) == ["1", "2", "3"]
    assert sorted(by_doc["doc1"]) == ["1", "2"]


def test_equal_documents_do_not_multiply(docs):
    assert unpacked(docs(*[json.dumps(HARBOURS)] * 3)).count() == 12


def test_null_and_dotdot_cells_are_null(docs):
    doc = cube(["A"], [3], [{"index": ["a", "b", "c"]}], [1.5, None, ".."])
    wide = jsonstat.unpack(docs(json.dumps(doc)))
    assert sorted((r.a, r.metric_value) for r in wide.collect()) == [("a", 1.5), ("b", None), ("c", None)]


def test_rejects_with_reasons(docs):
    good = cube(["A"], [2], [{"index": ["a", "b"]}], [1, 2])
    short_codes = cube(["A"], [3], [{"index": ["a", "b"]}], [1, 2, 3])
    obj_value = dict(good, value={"0": 1})
    bad_shape = dict(good, size=[2, 1])
    missing_dim = dict(good, id=["A", "Q"], size=[2, 1])
    bodies = [json.dumps(good), json.dumps(short_codes), json.dumps(obj_value), json.dumps(bad_shape),
              json.dumps(missing_dim), '{"error": {"code": 1}}', '{"id": ["A"], "size": [2', "not json"]
    parsed = jsonstat.parse(docs(*bodies))
    reasons = {r.path: r.reason for r in parsed.select("path", "reason").collect()}
    assert reasons == {"doc0": None, "doc1": "short_codes", "doc2": "no_values", "doc3": "shape_mismatch",
                       "doc4": "missing_dimension", "doc5": "error_reply", "doc6": "malformed",
                       "doc7": "malformed"}
    assert jsonstat.rejects(parsed).count() == 7
    assert jsonstat.cells(parsed).count() == 2


def test_short_codes_only_when_visited(docs):
    # values stop before the missing code is ever addressed: nothing to reject
    doc = cube(["A"], [3], [{"index": ["a", "b"]}], [1, 2])
    parsed = jsonstat.parse(docs(json.dumps(doc)))
    assert parsed.first().reason is None


def test_empty_dimension_flagged(docs):
    doc = cube(["A", "B"], [1, 0], [{"index": ["a"]}, {"index": []}], [])
    parsed = jsonstat.parse(docs(json.dumps(doc)))
    assert [r.dimension_id for r in jsonstat.empty_dimensions(parsed).collect()] == ["B"]
    assert jsonstat.cells(parsed).count() == 0


def test_three_dimensions_row_major(docs):
    doc = cube(["A", "B", "C"], [4, 5, 7],
               [{"index": [f"a{i}" for i in range(4)]}, {"index": {f"b{i}": i for i in range(5)}},
                {"label": {f"c{i}": f"C{i}" for i in range(7)}}], list(range(140)))
    got = [(r.a, r.b, r.c, r.metric_value) for r in unpacked(docs(json.dumps(doc))).collect()]
    assert got == [(f"a{p // 35}", f"b{p // 7 % 5}", f"C{p % 7}", float(p)) for p in range(140)]


def test_column_names_from_labels(docs):
    doc = cube(["C1V2", "TLIST(A1)"], [1, 1], [{"index": ["x"]}, {"index": ["2024"]}], [5],
               labels={"C1V2": "Type of Residential (Property) - A/B"})
    cols = jsonstat.dimension_columns(jsonstat.parse(docs(json.dumps(doc))))
    assert cols == [("C1V2", "type_of_residential_property___a_b"), ("TLIST(A1)", "period")]


def test_time_ids_of_two_kinds_share_the_period(docs):
    annual = cube(["TLIST(A1)"], [2], [{"index": ["2001", "2002"]}], [1, 2])
    monthly = cube(["TLIST(M1)", "X"], [2, 1], [{"index": ["2003M01", "2003M02"]}, {"index": ["x"]}], [3, 4])
    d = docs(json.dumps(annual), json.dumps(monthly))
    assert jsonstat.unpack(d).columns == ["period", "x", "metric_value"]
    assert [(r.period, r.x, r.metric_value) for r in unpacked(d).collect()] == [
        ("2001", None, 1.0), ("2002", None, 2.0), ("2003M01", "x", 3.0), ("2003M02", "x", 4.0)]


def test_clashing_labels_in_one_cube_keep_apart(docs):
    doc = cube(["Z1", "Z2", "Z3", "Z4"], [1, 2, 1, 1],
               [{"index": ["a"]}, {"index": ["b", "c"]}, {"index": ["1999"]}, {"index": ["v"]}], [1, 2],
               labels={"Z1": "Area", "Z2": "Area", "Z3": "Year", "Z4": "Metric Value"})
    d = docs(json.dumps(doc))
    assert jsonstat.unpack(d).columns == ["area", "area_z2", "year_dimension", "metric_value_dimension", "metric_value"]
    assert [(r.area, r.area_z2, r.year_dimension) for r in unpacked(d).collect()] == [("a", "b", "1999"), ("a", "c", "1999")]


def test_wide_dimension_is_linear_and_spread(spark, docs):
    def run(n):
        doc = cube(["A"], [n], [{"index": {f"code{i}": i for i in range(n)},
                                 "label": {f"code{i}": f"Label {i}" for i in range(n)}}], list(range(n)))
        began = time.perf_counter()
        parsed = jsonstat.parse(docs(json.dumps(doc)))
        wide = jsonstat.widen(parsed, [("A", "a")], keep=["pos"])
        bad = wide.filter((F.col("a") != F.concat(F.lit("Label "), "pos")) | (F.col("metric_value") != F.col("pos"))).count()
        assert bad == 0 and wide.count() == n
        return time.perf_counter() - began
    run(1000)
    small, large = run(8000), run(64_000)
    assert large < 8 * small + 10  # a quadratic unpack would take 64 times as long


def test_unpack_parses_documents_once(docs):
    """Columns, categories and cells read the parsed documents; none parses them again."""
    text = '{"id":["A"],"size":[3],"value":[1,2,3],"dimension":{"A":{"label":"A","category":{"index":{"z":2,"x":0,"y":1}}}}}'
    wide = jsonstat.unpack(docs(text))
    assert "from_json" not in wide._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r["a"], r["metric_value"]) for r in wide.collect()) == [("x", 1.0), ("y", 2.0), ("z", 3.0)]
