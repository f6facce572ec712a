"""Cube unpack against a brute-force Python unpack on random documents."""
import itertools
import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators import jsonstat


@st.composite
def cube_doc(draw):
    n_dims = draw(st.integers(1, 3))
    ids, sizes, dimension = [], [], {}
    for d in range(n_dims):
        dim_id = f"D{d}" if d else draw(st.sampled_from(["D0", "TLIST(M1)"]))
        size = draw(st.integers(1, 4))
        codes = [f"c{d}_{i}" for i in range(size)]
        form = draw(st.sampled_from(["list", "dict", "dict_shuffled", "empty", "absent"]))
        labels = {c: f"L{c}" for c in codes if draw(st.booleans()) or form in ("empty", "absent")}
        category = {"label": labels}
        if form == "list":
            category["index"] = codes
        elif form == "dict":
            category["index"] = {c: i for i, c in enumerate(codes)}
        elif form == "dict_shuffled":
            category["index"] = dict(reversed(list({c: i for i, c in enumerate(codes)}.items())))
        elif form == "empty":
            category["index"] = {}
        ids.append(dim_id)
        sizes.append(size)
        dimension[dim_id] = {"label": f"Label {d}", "category": category}
    total = 1
    for s in sizes:
        total *= s
    n_values = draw(st.integers(0, total + 2))
    values = [draw(st.one_of(st.integers(-5, 5), st.none(), st.just(".."))) for _ in range(n_values)]
    doc = {"id": ids, "size": sizes, "dimension": dimension, "value": values}
    return {"result": doc} if draw(st.booleans()) else doc


def brute_force(raw):
    """Cells of a document the way a per-document Python loop unpacks it."""
    data = raw.get("result", raw)
    dims = []
    for dim_id in data["id"]:
        cat = data["dimension"][dim_id]["category"]
        labels, index = cat.get("label", {}), cat.get("index", {})
        if isinstance(index, dict) and index:
            codes = [k for k, _ in sorted(index.items(), key=lambda kv: kv[1])]
        elif isinstance(index, list) and index:
            codes = index
        else:
            codes = list(labels.keys())
        dims.append((dim_id, codes, labels))
    out = set()
    values = data["value"]
    for pos, combo in enumerate(itertools.product(*[range(s) for s in data["size"]])):
        if pos >= len(values):
            break
        cell = tuple(sorted((d, labels.get(codes[i], codes[i])) for (d, codes, labels), i in zip(dims, combo)))
        v = values[pos]
        out.add((pos, cell, None if v in (None, "..") else float(v)))
    return out


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(cube_doc(), min_size=1, max_size=25))
def test_unpack_matches_brute_force(spark, docs):
    frame = spark.createDataFrame([(f"doc{i}", json.dumps(d)) for i, d in enumerate(docs)],
                                  "path string, body string")
    parsed = jsonstat.parse(frame)
    assert parsed.filter("reason IS NOT NULL").count() == 0
    ids = sorted({i for d in docs for i in d.get("result", d)["id"]})
    wide = jsonstat.widen(parsed, [(i, f"dim_{k}") for k, i in enumerate(ids)], keep=["path", "pos"])
    got = {}
    for r in wide.collect():
        cell = tuple((i, r[f"dim_{k}"]) for k, i in enumerate(ids) if r[f"dim_{k}"] is not None)
        got.setdefault(r.path, set()).add((r.pos, cell, r.metric_value))
    for i, d in enumerate(docs):
        assert got.get(f"doc{i}", set()) == brute_force(d), f"doc{i}: {json.dumps(d)}"
