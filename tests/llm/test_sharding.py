"""Byte shards against plain Python."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from strata.llm.sharding import assign, manifest, write_shards


def brute(rows, shards):
    """(id, size, crc, shard, slot) of every row, sorted."""
    rows = sorted(((d is not None, d or 0), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    total, at, out, slots = sum(r[1] for r in rows), 0, [], {}
    for (given, d), size, crc in rows:
        shard = min((2 * at + size) * shards // (2 * total), shards - 1)
        slots[shard] = slots.get(shard, -1) + 1
        out.append((d if given else -1, size, crc, shard, slots[shard]))
        at += size
    return sorted(out)


def corpus(seed, n=300):
    rng = random.Random(seed)
    words = ["ab", "é", "日本", "x" * 50, ""]
    rows = [(rng.choice([None, 7, rng.randint(-50, 400)]), rng.choice([None, "", "same text", " ".join(rng.choices(words, k=rng.randint(0, 40)))]))
            for _ in range(n)]
    return rows + [(5, "long " * 20_000)] + rows[:20]


@pytest.mark.parametrize("seed,shards", [(1, 8), (2, 3), (3, 1), (4, 50)])
def test_against_brute_force(spark, seed, shards):
    rows = corpus(seed)
    out = assign(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), shards)
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"])
                 for r in out.collect())
    assert got == brute(rows, shards)


def test_balance_and_contiguity(spark):
    rows = [(i, "w" * (i * 37 % 101)) for i in range(2000)]
    out = assign(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), 8)
    told = sorted(manifest(out).collect())
    target = sum(r["n_bytes"] for r in told) / 8
    assert len(told) == 8 and all(abs(r["n_bytes"] - target) <= 102 for r in told)
    assert [r["first_id"] for r in told[1:]] == [r["last_id"] + 1 for r in told[:-1]]


def test_fewer_rows_than_shards_and_none(spark):
    some = assign(spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string"), 8).collect()
    assert sorted((r["doc_id"], r["size"], r["text_crc32"], r["slot"]) for r in some) == [(1, 2, zlib.crc32(b"a"), 0), (2, 1, 0, 0)]
    assert assign(spark.createDataFrame([], "doc_id long, text string"), 8).collect() == []


def test_hot_id_and_equal_rows(spark):
    rows = [(1, "same")] * 900 + [(None, "same")] * 500 + [(2, f"t{i}") for i in range(100)]
    out = assign(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), 8)
    per = {r["shard"]: (r["n"], r["top"]) for r in out.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.max("slot").alias("top")).collect()}
    assert sum(n for n, _ in per.values()) == 1500 and all(top == n - 1 for n, top in per.values())


def test_clashing_columns_pass_through(spark):
    df = spark.createDataFrame([(1, "a b", 5, "s", 9.5)], "doc_id long, text string, slot long, _size string, `x.y` double")
    row = assign(df, 2).first().asDict()
    assert row["slot"] == 0 and row["_size"] == "s" and row["x.y"] == 9.5 and row["size"] == 4


def test_written_shards_read_back_in_order(spark, tmp_path):
    rows = [(i, f"text {i}") for i in range(500)]
    out = assign(spark.createDataFrame(rows, "doc_id long, text string"), 4)
    write_shards(out, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 500 and back.select("shard").distinct().count() == 4
    assert sorted(r["doc_id"] for r in back.select("doc_id").collect()) == list(range(500))
