"""The training sample of very common languages."""

from pyspark.sql import functions as F

from strata.llm import langid


def _labelled(spark, n, row_id):
    text = F.when(F.col("id") < 30, "der die das und ist").otherwise("the and with of is")
    return spark.range(n).select(row_id.alias("row_id"), F.when(F.col("id") < 30, "de").otherwise("en").alias("lang"),
                                 text.cast("binary").alias("body"))


def test_commonest_language_is_learnt(spark):
    model = langid.learn(_labelled(spark, 25_000_000, F.col("id").cast("string")), sample=2)
    assert model.langs == ["de", "en"]


def test_rows_with_one_hash_are_learnt(spark):
    model = langid.learn(_labelled(spark, 100_000, F.lit(None).cast("string")), sample=2)
    assert model.langs == ["de", "en"]
