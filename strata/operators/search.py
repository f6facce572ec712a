"""Substring search over many texts by a trigram index.

``LIKE '%needle%'`` reads every text for every needle.  The index is a posting table:
one row per distinct text and three-character gram of it, written once with the table it
serves.  A text that contains a needle has all the needle's grams, so the postings of the
needle's *rarest* gram hold every hit; they are looked up by an equi-join, for many
needles at once, and each candidate is verified on its text.  Needles of one or two
characters are grams themselves: they are looked up in the grams of that length, which
need no verification.

Grams are of the lower-cased text, so matching is case-insensitive as in
:func:`strata.functions.values.contains_ci`.  Texts are those of a dictionary (distinct
values of a column), however many rows hold them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAM = 3
FEW = 1000  # needles whose grams are given to the scan as a filter


def grams(text: Column, size: int) -> Column:
    """Distinct runs of ``size`` characters of a column (none of a shorter text)."""
    runs = F.transform(F.sequence(F.lit(1), F.length(text) - size + 1), lambda i: F.substring(text, i, F.lit(size)))
    return F.when(F.length(text) >= size, F.array_distinct(runs))


def postings(df: DataFrame, column: str) -> DataFrame:
    """The index of the distinct values of ``column``: ``(gram, low, text)``.

    Sorted by gram when written with :func:`write_index`; ``low`` is the lower-cased text that
    candidates are verified on.
    """
    texts = df.select(F.col(column).alias("text")).filter(F.col("text").isNotNull()).distinct()
    low = texts.select("text", F.lower("text").alias("low"))
    return low.select(F.explode(grams(F.col("low"), GRAM)).alias("gram"), "low", "text")


def write_index(df: DataFrame, column: str, path: str) -> None:
    """Write the index of ``column`` to ``path``: ``postings`` in ranges of grams, so that a
    look-up skips row groups, the number of texts per gram (``counts``) and the texts."""
    posted = postings(df, column)
    posted.repartitionByRange("gram", "text").sortWithinPartitions("gram").write.mode("overwrite").parquet(f"{path}/postings")
    spark = df.sparkSession
    (spark.read.parquet(f"{path}/postings").groupBy("gram").agg(F.count(F.lit(1)).alias("n_texts"))
     .write.mode("overwrite").parquet(f"{path}/counts"))
    (df.select(F.col(column).alias("text")).filter(F.col("text").isNotNull()).distinct()
     .write.mode("overwrite").parquet(f"{path}/texts"))


def find(spark: SparkSession, path: str, needles: DataFrame) -> DataFrame:
    """``(needle, text)``: every text of the index at ``path`` that contains each needle.

    ``needles`` has a column ``needle``; equal ones are looked up once, null and empty ones
    (which every text contains) are left out, as the views leave them unfiltered.
    """
    wanted = (needles.select("needle").filter(F.length("needle") > 0).distinct()
              .withColumn("want", F.lower("needle")))
    posted, counts = spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/counts")
    own = wanted.filter(F.length("want") >= GRAM).select("needle", "want", F.explode(grams(F.col("want"), GRAM)).alias("gram"))
    # a gram that no text has rules its needle out: inner joins drop the rest with it
    ranked = own.join(counts, "gram", "left").groupBy("needle", "want").agg(
        F.min_by("gram", F.struct(F.coalesce("n_texts", F.lit(0)), "gram")).alias("gram"))
    few = [r["gram"] for r in ranked.select("gram").distinct().limit(FEW + 1).collect()]
    if len(few) <= FEW:  # the postings are sorted by gram, so the scan skips what lies between
        posted = posted.filter(F.col("gram").isin(few)) if few else posted.limit(0)
    long = (posted.join(ranked, "gram").filter(F.contains("low", "want")).select("needle", "text"))
    texts = spark.read.parquet(f"{path}/texts")
    out = long
    short = wanted.filter(F.length("want") < GRAM)
    sizes = [r["n"] for r in short.select(F.length("want").alias("n")).distinct().collect()]
    for size in sizes:  # 1 and 2 at most
        of = texts.select(F.explode(grams(F.lower("text"), size)).alias("want"), "text")
        out = out.unionByName(of.join(short.filter(F.length("want") == size), "want").select("needle", "text"))
    return out


def search_rows(spark: SparkSession, path: str, needles: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """``needle`` and the rows whose ``column`` contains it."""
    found = find(spark, path, needles).withColumnRenamed("text", "_text")
    return rows.join(found, F.col(column) == F.col("_text")).drop("_text")
