"""Exact medians and quantiles of groups of any size (A3, A4).

A sorted or buffered group does not fit a task when one key holds a third of a large table,
and a sketch alone is off by some ranks.  Here the two work together, in rounds:

1. a sketch per group proposes pivots (``GRID`` - 1 of them); groups smaller than the
   sketch's accuracy are exact already and are done;
2. one partial aggregate counts, per group, the rows in every range between neighbouring
   pivots and those equal to a pivot -- at most ``2 * GRID`` small counts per group and
   task, whatever the skew;
3. the running counts tell which range holds the wanted rank.  If it is a pivot itself the
   group is done; otherwise only the rows of that range, about one in ``GRID``, go to the next
   round, where a group that has become small is settled from its own few rows.

Counts are exact, so the result is, whatever the sketch proposes; every round takes its
pivots out, so it ends.  Rounds read the input twice, then a shrinking part of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import scratch_path

GRID = 128           # ranges a round divides a group into
ACCURACY = 10_000    # sketch size; groups with fewer rows are exact at once


def exact_quantile(df: DataFrame, keys: list[str], value: str, q: float = 0.5, name: str = "median",
                   grid: int = GRID, accuracy: int = ACCURACY) -> DataFrame:
    """``keys`` and the value of rank ``ceil(q * n)`` among a group's n non-null values.

    The lower middle for the median of an even count; NaN ranks last; a group without values
    gets null.  Null keys are a group.  ``value`` must be numeric, a date or a timestamp.
    """
    if not 0 <= q <= 1:
        raise ValueError("a quantile lies between 0 and 1")
    names = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(value).alias("_v"))
    kind = rows.schema["_v"].dataType
    number = F.when(~F.isnan("_v"), F.col("_v")) if isinstance(kind, (T.DoubleType, T.FloatType)) else F.col("_v")
    rank = F.greatest(F.ceil(F.count("_v") * F.lit(q)), F.lit(1)).cast("long")
    marks = [k / grid for k in range(1, grid)]
    sketch = lambda: F.array_distinct(F.percentile_approx("_v", marks, accuracy))
    small = F.col("n") < accuracy

    # one sketch gives the pivots and, last, the value itself; small groups need no pivots
    first = rows.withColumn("_x", number).groupBy(*names).agg(
        F.count("_v").alias("n"), F.count("_x").alias("m"), rank.alias("rank"), F.max("_v").alias("top"),
        F.percentile_approx("_x", [*marks, q], accuracy).alias("sketch"))
    first = _written(first.select(
        *names, "n", "m", "rank", "top", F.get("sketch", F.lit(grid - 1)).alias("mid"),
        F.when(~small, F.array_distinct(F.slice("sketch", 1, grid - 1))).alias("pivots")), "quantile-groups")
    nan_or_none = (F.col("n") == 0) | (F.col("rank") > F.col("m"))
    done = [first.filter(nan_or_none).select(*names, F.col("top").alias("_q")),
            first.filter(~nan_or_none & small).select(*names, F.col("mid").alias("_q"))]
    open_ = first.filter(~nan_or_none & ~small).select(*names, "rank", "pivots")
    rows = rows.filter(number.isNotNull())

    while not open_.isEmpty():
        counted = (_with_keys(rows, open_.select(*names, "pivots"), names)
                   .groupBy(*names, _range_of(F.col("_v"), F.col("pivots")).alias("part")).agg(F.count(F.lit(1)).alias("n")))
        upto = Window.partitionBy(*names).orderBy("part")
        placed = _with_keys(counted.withColumn("upto", F.sum("n").over(upto)), open_, names).filter(
            (F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n")))
        at = (F.col("part") / 2).cast("int")  # odd parts are pivots, even ones the ranges before them
        found = _written(placed.select(
            *names, (F.col("part") % 2 == 1).alias("hit"), F.get("pivots", at).alias("high"), F.get("pivots", at - 1).alias("low"),
            (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"), "n"), "quantile-ranges")
        done.append(found.filter("hit").select(*names, F.col("high").alias("_q")))
        left = found.filter(~F.col("hit"))
        if left.isEmpty():
            break
        inside = (F.col("low").isNull() | (F.col("_v") > F.col("low"))) & (F.col("high").isNull() | (F.col("_v") < F.col("high")))
        rows = _written(_with_keys(rows, left.select(*names, "low", "high"), names).filter(inside).select(*names, "_v"),
                        "quantile-rows")
        # small by now: a group's few rows, fewer than the sketch holds, are listed
        few = left.filter(F.col("n") < accuracy).select(*names, "rank")
        done.append(_with_keys(rows, few, names).groupBy(*names).agg(
            F.element_at(F.array_sort(F.collect_list("_v")), F.max("rank").cast("int")).alias("_q")))
        large = left.filter(F.col("n") >= accuracy).select(*names, "rank")
        open_ = _written(_with_keys(rows, large, names).groupBy(*names).agg(
            F.max("rank").alias("rank"), sketch().alias("pivots")), "quantile-groups")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], F.col("_q").alias(name))


def with_exact_median(stats: DataFrame, df: DataFrame, keys: list[str], value: str, name: str,
                      digits: int | None = 0) -> DataFrame:
    """``stats`` (one row per ``keys``) with column ``name`` set to the exact median of ``value``."""
    middle = exact_quantile(df, keys, value, name="_median")
    if digits is not None:
        middle = middle.withColumn("_median", F.round("_median", digits))
    named = [f"_j{i}" for i in range(len(keys))]
    middle = middle.select(*[F.col(k).alias(n) for k, n in zip(keys, named)], "_median")
    same = F.lit(True)
    for k, n in zip(keys, named):
        same = same & F.col(k).eqNullSafe(F.col(n))
    return stats.join(middle, same, "left").withColumn(name, F.col("_median")).select(
        *stats.columns, *([] if name in stats.columns else [name]))


def _range_of(value: Column, pivots: Column) -> Column:
    """2 * i for values before pivot i (and after the one before it), 2 * i + 1 for pivot i."""
    below = F.size(F.filter(pivots, lambda p: p < value))
    return below * 2 + F.when(F.array_contains(pivots, value), 1).otherwise(0)


def _with_keys(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
    """Inner join on null-safe equal ``names``, which the result holds once."""
    renamed = right.select(*[F.col(n).alias(f"{n}_r") for n in names], *[c for c in right.columns if c not in names])
    same = F.lit(True)
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"{n}_r"))
    return left.join(renamed, same).drop(*[f"{n}_r" for n in names])


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
