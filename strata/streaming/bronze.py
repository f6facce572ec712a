"""Incremental Bronze -> Silver for cube documents.

The batch job re-reads every Bronze snapshot on each run.  This is the same
step as a file stream: each run picks up only the documents landed since
the last one (the stream's checkpoint records the files already taken),
unpacks them with the batch operators and brings them into Silver.  Run it
with ``available_now=True`` from the monthly schedule and it processes the
backlog, then stops -- exactly-once per file, restartable after a failure.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.functions.coerce import add_lineage
from strata.functions.values import first_year
from strata.operators import jsonstat
from strata.operators.quality import dataset_key, keep_latest_files
from strata.session import ensure_checkpoint_dir


def document_stream(spark: SparkSession, path_glob: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Bronze documents as a stream of ``(path, body)``, one per line."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (reader.load(path_glob)
            .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))
            .filter(F.length("body") > 0))


def write_cube_batch(batch: DataFrame, batch_id: int, silver: str, dataset: str, run_date: str,
                     columns: list[tuple[str, str]]) -> None:
    """Unpack one micro-batch of documents into Silver; replaying it is harmless.

    ``columns`` declares the (dimension id, column) pairs, so every batch
    writes one schema; a document with another dimension is rejected as
    ``undeclared_dimension``.  Rows go to a folder per dataset (a file's path
    without its landing time) with dynamic overwrite: a cube landed again
    replaces its earlier rows, and so does a batch written again.
    """
    names = [d for d, _ in columns]
    batch = batch.withColumn("dataset_key", F.md5(dataset_key(F.col("path"))))
    newest = keep_latest_files(batch, "path")
    parsed = jsonstat.parse(newest).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        strange = F.size(F.array_except("ids", F.array(*[F.lit(n) for n in names]))) > 0
        reason = F.coalesce("reason", F.when(strange, F.lit("undeclared_dimension")))
        checked = parsed.withColumn("reason", reason)
        wide = add_lineage(jsonstat.widen(checked, columns, keep=["dataset_key"]), dataset, run_date)
        year = first_year("period") if "period" in wide.columns else F.lit(None).cast("int")
        (wide.withColumn("year", year).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("dataset_key").parquet(silver))
        (jsonstat.rejects(checked).select("path", "reason", F.lit(batch_id).cast("long").alias("ingest_batch"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("ingest_batch").json(f"{silver.rstrip('/')}/_rejects"))
    finally:
        parsed.unpersist()


def cube_to_silver_stream(spark: SparkSession, path_glob: str, silver: str, dataset: str,
                          run_date: str, columns: list[tuple[str, str]], checkpoint: str | None = None,
                          available_now: bool = True) -> StreamingQuery:
    """Bring newly landed cube documents into the Silver table at ``silver``.

    Each micro-batch is written by :func:`write_cube_batch`, so no row lands
    twice and the table keeps one schema.  ``checkpoint`` defaults to a folder
    under the session's checkpoint directory (shared storage on a cluster).
    """
    checkpoint = checkpoint or f"{ensure_checkpoint_dir(spark)}/streams/{dataset}"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        write_cube_batch(batch, batch_id, silver, dataset, run_date, columns)

    writer = (document_stream(spark, path_glob).writeStream
              .foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
