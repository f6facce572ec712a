"""String-to-typed coercion against the per-value rule, lifted to whole columns."""
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.functions.coerce import coerce_strings, infer_string_types

TEXTS = st.one_of(
    st.integers(-10**6, 10**6).map(str),
    st.integers(-999, 999).map(lambda i: f" {i} "),
    st.integers(0, 99).map(lambda i: f"+{i}"),
    st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False).map(repr),
    st.sampled_from(["1e3", "-2.5E-2", ".5", "7.", "inf", "nan", "abc", "2024-01-01", "12a", "1.2.3",
                     "", None]),
)


def expected_column(values):
    """The per-value rule: no "." is a whole number or text, "." a decimal number or text."""
    filled = [v for v in values if v not in (None, "")]

    def kind(v):
        if re.fullmatch(r"\s*[+-]?[0-9]+\s*", v):
            return "whole"
        return "decimal" if re.fullmatch(r"\s*[+-]?([0-9]+\.[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*", v) else "text"

    kinds = {kind(v) for v in filled}
    if kinds == {"whole"}:
        return "bigint", [None if v in (None, "") else int(v) for v in values]
    if kinds and kinds <= {"whole", "decimal"}:
        return "double", [None if v in (None, "") else float(v) for v in values]
    return "string", [None if v in (None, "") else v for v in values]


def same(a, b):
    if isinstance(a, float) and isinstance(b, float) and a != a and b != b:
        return True  # nan
    return a == b


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(TEXTS, min_size=1, max_size=8), min_size=1, max_size=6).flatmap(
    lambda cols: st.just(cols)))
def test_coercion_matches_per_value_rule(spark, columns):
    n = max(len(c) for c in columns)
    cols = [c + [None] * (n - len(c)) for c in columns]
    names = [f"c{i}" for i in range(len(cols))]
    rows = [(i, *[col[i] for col in cols]) for i in range(n)]
    df = spark.createDataFrame(rows, "i int, " + ", ".join(f"{c} string" for c in names))
    kinds = infer_string_types(df.drop("i"))
    out = coerce_strings(df, kinds).orderBy("i").collect()
    for name, values in zip(names, cols):
        kind, want = expected_column(values)
        assert kinds[name] == kind, (name, values)
        got = [r[name] for r in out]
        assert all(same(g, w) for g, w in zip(got, want)), (name, values, got)
