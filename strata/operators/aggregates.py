"""Grouped statistics.

All aggregates are declarative ``groupBy().agg()`` so Spark plans a partial
(map-side) aggregate before the shuffle: only one partial row per group and
task crosses the network, whatever the skew of the group keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The median sketch (percentile_approx) has rank error n / accuracy and keeps
# about accuracy * log(n / accuracy) samples per group.  At 1e5 it is exact
# for groups under 100k rows and, for a group holding a third of 100 TB
# (~1e12 rows), within 1e-5 of rank on a buffer of tens of MB -- bounded,
# unlike an exact percentile that buffers the whole group.
MEDIAN_ACCURACY = 100_000


def median(col: Column | str, accuracy: int = MEDIAN_ACCURACY) -> Column:
    """Median as a value of the column (lower middle for even counts)."""
    return F.percentile_approx(col, 0.5, accuracy)


def group_stats(df: DataFrame, keys: list[str], value: str, *, avg: str | None = None,
                min: str | None = None, max: str | None = None,  # noqa: A002
                count: str | None = None, digits: int = 2) -> DataFrame:
    """avg / min / max rounded to ``digits`` and the non-null count (A1).

    ``count`` counts the column, not rows: null values stay out of it.
    """
    aggs = []
    if avg:
        aggs.append(F.round(F.avg(value), digits).alias(avg))
    if min:
        aggs.append(F.round(F.min(value), digits).alias(min))
    if max:
        aggs.append(F.round(F.max(value), digits).alias(max))
    if count:
        aggs.append(F.count(value).alias(count))
    return df.groupBy(*keys).agg(*aggs)


def sum_by(df: DataFrame, keys: list[str], value: str, name: str, digits: int = 0) -> DataFrame:
    """Sum per group rounded to ``digits`` (A2)."""
    return df.groupBy(*keys).agg(F.round(F.sum(value), digits).alias(name))


def headline_aggs(value: str, names: dict[str, str], digits: int = 0,
                  accuracy: int = MEDIAN_ACCURACY) -> list[Column]:
    """Aggregate expressions for :func:`headline_stats`."""
    build = {
        "count": lambda: F.count(value),
        "avg": lambda: F.round(F.avg(value), digits),
        "median": lambda: F.round(median(value, accuracy), digits),
        "min": lambda: F.round(F.min(value), digits),
        "max": lambda: F.round(F.max(value), digits),
    }
    return [build[k]().alias(v) for k, v in names.items()]


def headline_stats(df: DataFrame, keys: list[str], value: str, names: dict[str, str],
                   digits: int = 0, accuracy: int = MEDIAN_ACCURACY) -> DataFrame:
    """count, avg, median, min, max of ``value`` per group (A3, A4).

    ``names`` maps any of ``count avg median min max`` to output names.
    """
    return df.groupBy(*keys).agg(*headline_aggs(value, names, digits, accuracy))


def pivot_wide(df: DataFrame, keys: list[str], name_col: str, value_col: str,
               names: list[str], digits: int | None = 2,
               order_col: str | None = None) -> DataFrame:
    """Long to wide with a fixed list of new columns (A5).

    One aggregate with one conditional aggregate per name: a single
    exchange, where ``groupBy().pivot()`` plans two aggregations (by keys and
    name, then by keys).  The fixed ``names`` also spare the distinct job a
    pivot without values runs.  A cell holding several values keeps the one
    with the highest ``order_col`` (e.g. the newest snapshot; rows with a
    null order are never picked), else the largest value, so the result
    never depends on row order.  Keys whose
    name is outside ``names`` (or null) still give a row, with null cells.
    """
    cells = []
    for name in names:
        hit = F.col(name_col) == F.lit(name)
        value = F.when(hit, F.col(value_col))
        pick = F.max_by(value, F.when(hit, F.col(order_col))) if order_col else F.max(value)
        cells.append((F.round(pick, digits) if digits is not None else pick).alias(name))
    return df.groupBy(*keys).agg(*cells)


def conditional_aggs(value: str, class_col: str, classes: dict[str, tuple[str, str]],
                     digits: int = 0) -> list[Column]:
    """Aggregate expressions for :func:`conditional_stats`.

    A class without rows in a group gets a null count, as a left join of the
    per-class aggregate would give; a class whose values are all null gets 0.
    """
    aggs = []
    for cls, (count_name, avg_name) in classes.items():
        hit = F.col(class_col) == F.lit(cls)
        aggs.append(F.when(F.count_if(hit) > 0, F.count(F.when(hit, F.col(value))))
                    .alias(count_name))
        aggs.append(F.round(F.avg(F.when(hit, F.col(value))), digits).alias(avg_name))
    return aggs


def conditional_stats(df: DataFrame, keys: list[str], value: str, class_col: str,
                      classes: dict[str, tuple[str, str]], digits: int = 0) -> DataFrame:
    """Per class count and mean in one pass over ``df``.

    ``classes`` maps a class value to (count column, average column).  Same
    result as filtering once per class and joining back, without the joins.
    """
    return df.groupBy(*keys).agg(*conditional_aggs(value, class_col, classes, digits))


def class_slices(df: DataFrame, keys: list[str], value: str, class_col: str,
                 classes: dict[str, tuple[str, str]], digits: int = 0) -> dict[str, DataFrame]:
    """Per class (count, average) frames keyed by ``keys``, one per class (A4).

    The form the source mart joins back with left joins (J1); prefer
    :func:`conditional_stats` when a single pass will do.
    """
    per_class = df.groupBy(*keys, class_col).agg(
        F.count(value).alias("_n"), F.round(F.avg(value), digits).alias("_avg"))
    return {cls: per_class.filter(F.col(class_col) == F.lit(cls))
            .select(*keys, F.col("_n").alias(n), F.col("_avg").alias(a))
            for cls, (n, a) in classes.items()}


def mean_of_means(group_means: DataFrame, keys: list[str], value: str, name: str,
                  digits: int = 2) -> DataFrame:
    """Unweighted mean of already-aggregated means per ``keys``."""
    return group_means.groupBy(*keys).agg(F.round(F.avg(value), digits).alias(name))


def period_end(df: DataFrame, keys: list[str], period_col: str, values: list[str],
               at: int | None = 12) -> DataFrame:
    """The row that stands for a whole year.

    With ``at`` (default 12, December) only that period is kept: a year
    without it has no row.  With ``at=None`` each group keeps its latest
    period's values via ``max_by``, a plain aggregate with no window.
    """
    if at is not None:
        return df.filter(F.col(period_col) == F.lit(at)).select(*keys, *values)
    return df.groupBy(*keys).agg(
        F.max(period_col).alias(period_col),
        *[F.max_by(v, period_col).alias(v) for v in values])
