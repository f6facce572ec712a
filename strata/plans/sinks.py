"""Sinks and catalog (K1-K7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path


def write_partitioned(df: DataFrame, path: str, by: list[str] | tuple[str, ...] = ("year",),
                      sort_by: list[str] | tuple[str, ...] = (), mode: str = "overwrite",
                      max_records_per_file: int | None = None, checks: dict | None = None):
    """Parquet write partitioned by ``by`` (K1).

    Rows pass through a ``REBALANCE`` on ``by``: a hash exchange that
    adaptive execution resizes at run time -- a partition value holding a
    third of all rows is split into advisory-size pieces
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``) over many tasks,
    and small ones are coalesced, so each folder gets a few well-sized
    files.  Unlike a range repartition it needs no sampling pass, so the
    upstream plan runs exactly once.  The default overwrite is static (full
    refresh); set ``spark.sql.sources.partitionOverwriteMode=dynamic`` for
    incremental runs.

    ``checks`` (name -> aggregate Column) are observed on the write itself
    (K5) and returned as an ``Observation``.
    """
    out = df.hint("rebalance", *by).sortWithinPartitions(*by, *sort_by)
    obs = None
    if checks:
        obs = Observation()
        out = out.observe(obs, *[c.alias(k) for k, c in checks.items()])
    writer = out.write.mode(mode).partitionBy(*by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)
    return obs


def ensure_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` (K2)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`{loc}")


def register_external(spark: SparkSession, db: str, table: str, path: str, df: DataFrame,
                      by: list[str] | tuple[str, ...] = ("year",)) -> str:
    """Drop and recreate an external Parquet table over ``path`` (K3, K4).

    Column types come from ``df`` so the catalog follows schema changes on
    every run; partitions already on disk are discovered with
    ``MSCK REPAIR TABLE``.  Returns the qualified table name.
    """
    name = f"`{db}`.`{table}`"
    by_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cols = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in by]
    cols += [f"`{c}` {by_types.get(c, 'int')}" for c in by]
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({', '.join(cols)}) USING parquet "
              f"PARTITIONED BY ({', '.join(f'`{c}`' for c in by)}) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return f"{db}.{table}"


def preview(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in ``order`` for a console check (K6): a top-k, not a sort."""
    return df.orderBy(*order).limit(n)


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` rows (O3): stops reading as soon as it has them."""
    return df.limit(n)


def envelope(df: DataFrame, table: str, filters: dict | None = None) -> DataFrame:
    """Result rows in the JSON envelope of the serving layer (K7).

    One row per input row: ``status`` ("ok"), ``data`` (the row as JSON) and
    ``meta`` (JSON of table, filters and the total ``row_count``).  The view
    is computed once: it is written to the shared scratch folder with its
    rows counted on that write, and the envelope reads the written rows.
    """
    spark = df.sparkSession
    filters = filters or {}
    path, obs = scratch_path(spark, "envelope"), Observation()
    df.observe(obs, F.count(F.lit(1)).alias("n")).write.parquet(path)
    rows = spark.read.schema(df.schema).parquet(path)
    meta_struct = F.struct(
        F.lit(table).alias("table"),
        *[F.lit(v).alias(k) for k, v in filters.items()],
        F.lit(obs.get["n"]).cast("bigint").alias("row_count"))
    keep_nulls = {"ignoreNullFields": "false"}  # a missing value reads as null, not as absent
    return rows.select(F.lit("ok").alias("status"),
                       F.to_json(F.struct(*[F.col(c) for c in rows.columns]), keep_nulls).alias("data"),
                       F.to_json(meta_struct, keep_nulls).alias("meta"))
