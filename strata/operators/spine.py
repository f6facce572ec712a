"""Unions and key-spine joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """N-way union by column name; a column absent from a frame is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def key_spine(frames: list[DataFrame], key: str = "year") -> DataFrame:
    """Distinct key values found in any of ``frames``.

    Each frame is reduced to its distinct keys before the union, so only
    one partial row per key and task reaches the final de-duplication.
    """
    return reduce(lambda a, b: a.union(b),
                  [f.select(key).distinct() for f in frames]).distinct()


def spine_join(spine: DataFrame, frames: list[DataFrame], key: str = "year") -> DataFrame:
    """Left-join every frame onto the spine by ``key``.

    No broadcast hint: the sides are aggregates whose size is only known at
    run time, so adaptive execution broadcasts them when they measure under
    the broadcast threshold and keeps a shuffled join otherwise.  All joins
    share one key, so a shuffled plan reuses the same hash partitioning.
    """
    return reduce(lambda acc, f: acc.join(f, on=key, how="left"), frames, spine)


def spine_merge(frames: list[DataFrame], key: str = "year",
                in_spine: list[Column | bool] | None = None) -> DataFrame:
    """Single-pass form of :func:`key_spine` + :func:`spine_join` for per-key frames.

    When every frame has at most one row per ``key`` (per-year marts), the
    left joins onto the spine equal a union followed by one aggregate per
    key: each frame is computed once and combined in a single shuffle,
    instead of once for the spine and once for its join.  ``in_spine`` says
    which rows contribute their key to the spine (default: all); keys found
    only elsewhere are dropped, as a left join onto the spine would.  A null
    key in the spine gives a row without values, as those joins do.
    Columns must be distinct across frames except ``key``.
    """
    flags = in_spine if in_spine is not None else [True] * len(frames)
    tagged = [f.withColumn("_spine", flag if isinstance(flag, Column) else F.lit(bool(flag)))
              for f, flag in zip(frames, flags)]
    merged = union_by_name(tagged)
    values = [c for c in merged.columns if c not in (key, "_spine")]
    # a null key joins with nothing, though grouping brings its rows together
    known = F.col(key).isNotNull()
    return (merged.groupBy(key)
            .agg(*[F.max(F.when(known, F.col(c))).alias(c) for c in values], F.max("_spine").alias("_spine"))
            .filter(F.col("_spine")).drop("_spine"))
