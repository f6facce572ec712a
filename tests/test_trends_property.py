"""Year-on-year change against a brute-force computation on random series."""
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators.trends import yoy

SERIES = st.dictionaries(st.sampled_from(["A", "B", "C"]),
                         st.dictionaries(st.integers(2000, 2012),
                                         st.one_of(st.none(), st.just(0.0),
                                                   st.integers(1, 5000).map(float)),
                                         min_size=1, max_size=8),
                         min_size=1, max_size=3)


def half_up(x, digits):
    # Spark's round of a double: decimal text of the double, half up
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def brute(series, strict):
    out = {}
    for key, points in series.items():
        years = sorted(points)
        for i, y in enumerate(years):
            prev = points[years[i - 1]] if i else None
            if strict and i and years[i - 1] != y - 1:
                prev = None
            cur = points[y]
            pct = None
            if cur is not None and prev not in (None, 0.0):
                pct = half_up((cur - prev) / prev * 100, 2)
            out[(key, y)] = pct
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(SERIES, st.booleans())
def test_yoy_matches_brute_force(spark, series, strict):
    rows = [(k, y, v) for k, pts in series.items() for y, v in pts.items()]
    df = spark.createDataFrame(rows, "k string, year int, v double")
    got = {(r.k, r.year): r.p for r in yoy(df, "v", "year", ["k"], pct="p", strict=strict).collect()}
    assert got == brute(series, strict)
