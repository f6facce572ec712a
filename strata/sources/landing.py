"""Landing files byte for byte, each content once.

Bronze keeps what the source sent: the bytes are written as they are, whatever their
encoding, line ends or validity as text.  A landed file is named by its SHA-256, so a file
sent again -- next month's unchanged download, or the same file under another name -- is noted
in the manifest and not stored a second time.

Layout below ``root``::

    data/dataset=<name>/sha256=<hex>/part-*.txt      one file, the source's bytes
    manifest/                                        Parquet, one row per file of every landing

Spark has no sink for raw bytes, but its text sink writes a string's bytes unchanged and then
a line end that may be any character.  So each file is written without its last byte and
with that byte as the line end: one write per distinct last byte (mostly one, a newline).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

MANIFEST = "dataset string, source_path string, sha256 string, length long, status string, key string, landed_at timestamp"


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """All rows of the manifest, none before the first landing.

    ``status`` is ``stored`` or ``duplicate``; ``key`` is the folder, below ``root``, that
    holds the content.
    """
    try:
        return spark.read.schema(MANIFEST).parquet(f"{root.rstrip('/')}/manifest")
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return spark.createDataFrame([], MANIFEST)
        raise


def _files(spark: SparkSession, source: str | list[str], glob: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(source)
            .filter(F.col("length") > 0))


def land_once(spark: SparkSession, source: str | list[str], root: str, dataset: str, landed_at, glob: str = "*") -> DataFrame:
    """Land every file under ``source`` that ``root`` does not hold yet; returns this landing's
    manifest rows.

    Two passes over the bytes: one for the hashes, one that writes new content.  Within
    a landing the first path (in order) of equal files is stored.  Content known under any
    dataset counts as held by that dataset only.  Files are read whole, one row each (Spark's
    limit for them is 2 GB); empty files are invisible to Spark's file scans.  A run that dies
    before its manifest rows are written stores the same bytes in the same folder again, which
    leaves a folder with two equal files, of which readers take one (:func:`landed_files`).
    """
    root = root.rstrip("/")
    data = f"{root}/data"
    seen = _files(spark, source, glob).select(
        F.col("path").alias("source_path"), "length", F.sha2("content", 256).alias("sha256"),
        F.lower(F.hex(F.substring("content", -1, 1))).alias("_last"))
    path = scratch_path(spark, "landing")
    seen.write.parquet(path)
    seen = spark.read.schema(seen.schema).parquet(path)
    held = read_manifest(spark, root).filter((F.col("dataset") == dataset) & (F.col("status") == "stored")).select("sha256").distinct()
    fresh = seen.join(held, "sha256", "left_anti").groupBy("sha256").agg(
        F.min("source_path").alias("source_path"), F.first("_last").alias("_last"))
    path = scratch_path(spark, "landing-new")
    fresh.write.parquet(path)
    fresh = spark.read.schema(fresh.schema).parquet(path)
    for row in fresh.select("_last").distinct().collect():  # at most 256 values
        own = fresh.filter(F.col("_last") == row["_last"]).select(F.col("source_path").alias("path"), "sha256")
        body = F.expr("substring(content, 1, length(content) - 1)").cast("string")
        (_files(spark, source, glob).select("path", "content").join(own, "path")
         .select(body.alias("value"), F.lit(dataset).alias("dataset"), "sha256")
         .write.mode("append").partitionBy("dataset", "sha256").option("encoding", "ISO-8859-1")
         .option("lineSep", chr(int(row["_last"], 16))).text(data))
    rows = seen.join(fresh.select("sha256", F.col("source_path").alias("_first")), "sha256", "left").select(
        F.lit(dataset).alias("dataset"), "source_path", "sha256", "length",
        F.when(F.col("_first") == F.col("source_path"), "stored").otherwise("duplicate").alias("status"),
        F.concat(F.lit(f"data/dataset={dataset}/sha256="), F.col("sha256")).alias("key"),
        F.lit(landed_at).cast("timestamp").alias("landed_at"))
    rows.write.mode("append").parquet(f"{root}/manifest")
    return read_manifest(spark, root).filter((F.col("dataset") == dataset) & (F.col("landed_at") == F.lit(landed_at).cast("timestamp")))


def landed_files(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """Every content of ``dataset`` once: ``(sha256, path, length, content)``.

    ``path`` can be given to any of Spark's readers; ``content`` is only read if selected.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root.rstrip('/')}/data/dataset={dataset}")
    named = files.withColumn("sha256", F.regexp_extract("path", "/sha256=([0-9a-f]{64})/", 1))
    one = named.select("sha256", "path").groupBy("sha256").agg(F.min("path").alias("path"))
    return named.join(one, ["sha256", "path"], "left_semi").select("sha256", "path", "length", "content")


def landing_tally(manifest: DataFrame) -> DataFrame:
    """Files and bytes by dataset and status."""
    return manifest.groupBy("dataset", "status").agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))
