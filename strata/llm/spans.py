"""Places of regular-expression matches, with SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEP = 256  # running sums go by steps, so that long arrays are not copied item by item


def running_totals(sizes: Column) -> Column:
    """array<int> of the sums of all items up to and including each one.

    Two levels of short aggregates: an append copies at most STEP items, or one
    item per step.  ``sizes`` must be a plain column: a lambda reads it.
    """
    empty = F.array().cast("array<int>")
    steps = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(sizes) / F.lit(STEP)).cast("int") - 1, F.lit(0)))
    part = lambda k: F.slice(sizes, k * STEP + 1, F.lit(STEP))

    def totals(xs: Column, start: Column) -> Column:
        return F.aggregate(
            xs, F.struct(start.alias("sum"), empty.alias("out")),
            lambda acc, x: F.struct((acc["sum"] + x).alias("sum"),
                                    F.concat(acc["out"], F.array(acc["sum"] + x)).alias("out")),
            lambda acc: acc["out"])

    step_sums = F.transform(steps, lambda k: F.aggregate(part(k), F.lit(0), lambda a, x: a + x))
    starts = F.concat(F.array(F.lit(0)), totals(step_sums, F.lit(0)))
    return F.flatten(F.zip_with(steps, F.slice(starts, F.lit(1), F.size(steps)), lambda k, start: totals(part(k), start)))


def with_matches(df: DataFrame, name: str, text: str, pattern: str, value_group: int = 0,
                 test: Column | None = None) -> DataFrame:
    """``df`` plus ``name`` array<struct<start, end, value>>: the leftmost
    non-overlapping matches of ``pattern`` in column ``text``.

    Places are code points; ``value`` is the text of ``value_group``.  ``test`` is a
    cheap condition that every text with a match meets.  The pattern must not
    match the empty string, and the text must not be null.
    """
    none = F.array().cast("array<string>")
    every = lambda group: F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(group))
    hits, values, gaps, sizes, ends = (f"_{name}_{part}" for part in ("hits", "values", "gaps", "sizes", "ends"))
    df = df.withColumn(hits, every(0) if test is None else F.when(test, every(0)).otherwise(none))
    found = F.size(hits) > 0
    df = df.withColumns({
        values: F.col(hits) if value_group == 0 else F.when(found, every(value_group)).otherwise(none),
        gaps: F.when(found, F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))).otherwise(none)})
    df = df.withColumn(sizes, F.zip_with(gaps, hits, lambda g, h: F.length(g) + F.length(h)))
    df = df.withColumn(ends, F.when(found, running_totals(F.col(sizes))).otherwise(F.array().cast("array<int>")))
    spans = F.transform(F.arrays_zip(F.col(ends).alias("end"), F.col(hits).alias("hit"), F.col(values).alias("value")),
                        lambda x: F.struct((x["end"] - F.length(x["hit"])).alias("start"), x["end"].alias("end"),
                                           x["value"].alias("value")))
    return df.withColumn(name, spans).drop(hits, values, gaps, sizes, ends)
