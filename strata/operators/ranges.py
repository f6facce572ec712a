"""Rows in ranges of a total order: the basis of order-dependent operators without a one-task window.

A window without keys (or with one key holding a third of the rows) gathers rows in one
task.  Here rows are dealt to ranges by an exchange on the order, each range is worked on
alone, and what passes from range to range -- its last row, its count, its sums -- is one
small row per range, carried over with a window of that few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import scratch_path

RANGE = "_range"


def nulls_first(order: list[str]) -> list[Column]:
    return [F.col(f"`{c}`").asc_nulls_first() for c in order]


def into_ranges(df: DataFrame, order: list[str], name: str = "ranges", parts: int | None = None) -> DataFrame:
    """``df`` plus ``_range``: rows of a lower range precede those of a higher one in
    ``order`` (nulls first).

    Written once to the shared scratch folder, so that a lost executor re-reads and the
    ranges stay as they were dealt.  Rows equal in all of ``order`` may be dealt to
    several ranges, so that no value makes a range of its own too large; ``order``
    must tell apart all rows whose places matter.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (df.withColumn("_tie", F.monotonically_increasing_id())
             .repartitionByRange(parts, *nulls_first(order), "_tie").drop("_tie")
             .withColumn(RANGE, F.spark_partition_id()))
    path = scratch_path(spark, name)
    dealt.write.parquet(path)
    return spark.read.schema(dealt.schema).parquet(path)


def carried(per_range: DataFrame, sums: list[str]) -> DataFrame:
    """``per_range`` (one row per range) with each of ``sums`` replaced by the total of
    all earlier ranges."""
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return per_range.withColumns({c: F.coalesce(F.sum(c).over(before), F.lit(0)).cast(per_range.schema[c].dataType)
                                  for c in sums})


def with_previous(df: DataFrame, order: list[str], columns: list[str], keys: list[str] | None = None,
                  name: str = "_prev") -> DataFrame:
    """``df`` plus ``name``: struct of ``columns`` of the row before in ``order`` within
    ``keys`` (null at the start), computed range by range.

    ``order`` must be total up to rows that are interchangeable.  The last row of each
    range travels to the next range that has rows; it is one row per range, at most the
    number of shuffle partitions, so it is broadcast.
    """
    keys = keys or []
    full = keys + [c for c in order if c not in keys]
    held = into_ranges(df, full, "lag")
    inside = Window.partitionBy(RANGE).orderBy(*nulls_first(full))
    mine = F.struct(*[F.col(f"`{c}`") for c in [*keys, *columns]])
    last = (held.groupBy(RANGE).agg(F.max_by(mine, F.struct(*[F.col(f"`{c}`") for c in full])).alias("_last"))
            .withColumn("_last", F.lag("_last").over(Window.orderBy(RANGE))))
    out = (held.withColumn("_before", F.lag(mine).over(inside))
           .join(F.broadcast(last), RANGE, "left")
           .withColumn("_before", F.coalesce("_before", "_last")))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"_before.`{k}`").eqNullSafe(F.col(f"`{k}`"))
    picked = F.struct(*[F.col(f"_before.`{c}`").alias(c) for c in columns])
    return out.withColumn(name, F.when(F.col("_before").isNotNull() & same, picked)).drop(RANGE, "_before", "_last")


def numbered(df: DataFrame, order: list[str], name: str = "row_no") -> DataFrame:
    """``df`` plus ``name``: the place of each row in ``order`` (nulls first), from 0.

    The numbers of one global ``row_number``, from places within ranges and the carried
    counts of the ranges before; rows equal in ``order`` are numbered arbitrarily.
    """
    held = into_ranges(df, order, "numbered")
    counts = carried(held.groupBy(RANGE).agg(F.count(F.lit(1)).alias("_rows")), ["_rows"])
    inside = Window.partitionBy(RANGE).orderBy(*nulls_first(order))
    return (held.join(F.broadcast(counts), RANGE).withColumn(name, (F.col("_rows") + F.row_number().over(inside) - 1).cast("long"))
            .drop(RANGE, "_rows"))
