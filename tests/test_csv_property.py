"""Mixed-header CSV reads against a per-file read mapped by column name."""
import csv
import io
import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.fixed_values import SALES_HEADER_PATTERNS, SALES_HEADER_SYNONYMS
from strata.session import scratch_path
from strata.sources.files import read_csv_by_header

SPELLINGS = {}
for header, canonical in SALES_HEADER_SYNONYMS.items():
    SPELLINGS.setdefault(canonical, []).append(header)
OPTIONAL = sorted(c for c in SPELLINGS if c != "date_of_sale_raw")
VALUE = st.text(alphabet="ab1, \"'-", max_size=6)


@st.composite
def csv_file(draw):
    cols = ["date_of_sale_raw"] + draw(st.lists(st.sampled_from(OPTIONAL), unique=True, max_size=6))
    cols = draw(st.permutations(cols))
    utf8 = draw(st.booleans())
    headers = []
    for c in cols:
        options = [h for h in SPELLINGS[c] if utf8 or h.encode("latin-1", "ignore").decode("latin-1") == h]
        options = [h for h in options if utf8 or "€" not in h]
        headers.append(draw(st.sampled_from(options)))
    rows = draw(st.lists(st.lists(VALUE, min_size=len(cols), max_size=len(cols)), min_size=1, max_size=4))
    return cols, headers, rows, utf8


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(csv_file(), min_size=1, max_size=5))
def test_read_by_header_matches_per_file_mapping(spark, files):
    root = scratch_path(spark, "t-csv-prop").replace("file:", "")
    os.makedirs(root)
    expected = set()
    for i, (cols, headers, rows, utf8) in enumerate(files):
        buf = io.StringIO()
        w = csv.writer(buf, quoting=csv.QUOTE_MINIMAL, lineterminator="\n")
        w.writerow(headers)
        w.writerows(rows)
        with open(f"{root}/f{i}.csv", "wb") as f:
            f.write(buf.getvalue().encode("utf-8" if utf8 else "latin-1"))
        for row in rows:
            if len(row) == 1 and row[0].isspace():
                continue  # a line of blanks is no row
            rec = {c: (v if v != "" else None) for c, v in zip(cols, row)}
            expected.add((f"f{i}.csv", tuple(rec.get(c) for c in ["date_of_sale_raw"] + OPTIONAL)))
    df, rejected = read_csv_by_header(spark, root, SALES_HEADER_SYNONYMS, SALES_HEADER_PATTERNS,
                                      canonical=sorted(SPELLINGS))
    assert rejected.count() == 0
    got = {(r.source_file.rsplit("/", 1)[-1], tuple(r[c] for c in ["date_of_sale_raw"] + OPTIONAL))
           for r in df.collect()}
    assert got == expected
