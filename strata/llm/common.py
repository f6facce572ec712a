"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

# Words are runs of anything but these six ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"


BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches to ``BATCH_ROWS`` rows: rows hold whole texts, and a batch is in
    memory several times on its way between JVM and Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def few_partitions(spark: SparkSession) -> int:
    """Partitions for results much smaller than the input: an eighth of the shuffle's."""
    return max(4, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)


def materialize(df: DataFrame, name: str, few: bool = False) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage with files that every executor can read, so a lost
    executor costs a re-read and not a recomputation.  ``few`` is for results
    much smaller than the input that come out of a shuffle: their partitions
    are merged, so that they do not make as many files as the shuffle has.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.coalesce(few_partitions(spark)) if few else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame, **own: Column) -> DataFrame:
    """``docs`` as one struct column ``_row`` beside the columns ``own``, so that no name
    of an operator can clash with one of the table."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       *[c.alias(name) for name, c in own.items()])


def unpacked(df: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """The packed table's ``columns``, those in ``new`` replaced, and the rest of ``new``."""
    lower = {name.lower(): name for name in new}
    kept = [new[lower[c.lower()]].alias(c) if c.lower() in lower else F.col(f"_row.`{c}`").alias(c) for c in columns]
    held = {c.lower() for c in columns}
    return df.select(*kept, *[c.alias(name) for name, c in new.items() if name.lower() not in held])
