"""Suffix-array and substring dedup against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from strata.llm import repeats
from strata.llm.substring_dedup import remove_repeated_words
from strata.llm.suffix_dedup import remove_repeated_bytes


def brute_bytes(rows, length):
    first = {}
    data = [(d, (t or "").encode()) for d, t in rows]
    for d, b in data:
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            first[w] = min(first.get(w, (d, p)), (d, p))
    out = []
    for d, b in data:
        gone = [False] * len(b)
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < (d, p):
                gone[p:p + length] = [True] * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def brute_words(rows, length):
    data = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    seen = {}
    for i, (_, w) in enumerate(data):
        for p in range(len(w) - length + 1):
            seen.setdefault(tuple(w[p:p + length]), []).append((i, p))
    out = []
    for i, (d, w) in enumerate(data):
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            if len(seen[tuple(w[p:p + length])]) > 1:
                gone[p:p + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 9)))
    text = lambda k: "".join(word() + rng.choice([" ", " ", "\n", "  ", "\t"]) for _ in range(k))
    passages = [text(rng.choice([5, 40, 90])) for _ in range(6)]
    rows = []
    for d in range(n):
        kind = rng.random()
        if kind < 0.35 or not rows:
            t = text(rng.randint(0, 120))
        elif kind < 0.55:
            t = rng.choice(rows)[1]
        elif kind < 0.8:  # near copy
            t = rng.choice(rows)[1] or ""
            for _ in range(3):
                at = rng.randint(0, len(t))
                t = t[:at] + rng.choice(["x", "", "longer insertion "]) + t[at + rng.randint(0, 3):]
        else:
            t = text(rng.randint(0, 30)) + rng.choice(passages) + text(rng.randint(0, 30)) + rng.choice(passages)
        rows.append((d * 7 - 50, t))
    rows += [(5001, None), (5002, ""), (5003, "a" * 3000), (5004, "ab" * 700 + "c"), (5005, "x " * 400),
             (5006, "one two three " * 60), (5007, "short")]
    return rows


@pytest.mark.parametrize("seed,hot,block", [(1, 20_000, 16), (2, 3, 8), (3, 20_000, 1024)])
def test_bytes_against_brute_force(spark, seed, hot, block):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in remove_repeated_bytes(df, hot=hot, block_docs=block, bucket_bytes=5000).collect())
    assert got == brute_bytes(rows, 100)


@pytest.mark.parametrize("seed,hot,block", [(4, 20_000, 16), (5, 3, 8), (6, 20_000, 1024)])
def test_words_against_brute_force(spark, seed, hot, block):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in remove_repeated_words(df, hot=hot, block_docs=block, bucket_bytes=5000).collect())
    assert got == brute_words(rows, 35)


def test_shorter_windows(spark):
    rows = corpus(9, 40)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(tuple(r) for r in remove_repeated_bytes(df, length=30, gram=10, block_docs=4).collect())
    assert got == brute_bytes(rows, 30)
    got = sorted(tuple(r) for r in remove_repeated_words(df, length=6, gram=2, block_docs=4).collect())
    assert got == brute_words(rows, 6)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeated_bytes(df).collect() == []
    assert remove_repeated_words(df).collect() == []


def test_null_ids_repeated_rows_and_clashing_columns(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(None, text, "b1", 1), (3, text, "b2", 2), (3, text, "b2", 2), (4, None, None, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, body string, block int")
    got = {(r.doc_id, r.n_removed) for r in remove_repeated_bytes(df).collect()}
    assert got == {(None, 0), (3, len(text)), (4, 0)}
    words = [(r.doc_id, r.n_removed) for r in remove_repeated_words(df).collect()]
    assert sorted(words, key=str) == sorted([(None, 60), (3, 60), (3, 60), (4, 0)], key=str)


def test_kept_text(spark):
    text = " ".join(f"word{i}" for i in range(60))
    df = spark.createDataFrame([(1, text), (2, "head " + text)], "doc_id long, text string")
    kept = {r.doc_id: bytes(r.kept).decode() for r in remove_repeated_bytes(df, keep_text=True).collect()}
    assert kept == {1: text, 2: "head "}


# -- blocks ------------------------------------------------------------------------------

def odd_ids(seed):
    """Null and repeated ids, repeated rows, long documents that share long passages."""
    rng = random.Random(seed)
    rows = [(rng.choice([None, 3, 3, d]), t) for d, t in corpus(seed, n=40)]
    passage = " ".join(f"w{rng.randint(0, 50)}" for _ in range(900))
    rows += [(d, f"{d} " * rng.randint(1, 50) + passage + f" {d}" * 9) for d in (60, 61, None, 3)]
    return rows + rows[:6]


def by_start(rows, length):
    """Brute force with null ids first; rows that share an id compare by start alone."""
    low = -(10 ** 9)
    out = brute_bytes([(low if d is None else d, t) for d, t in rows], length)
    return sorted(out)


@pytest.mark.parametrize("seed,block_bytes,chunk", [(11, 16 << 20, 1 << 20), (12, 1500, 1 << 20), (13, 3000, 700)])
def test_bytes_whatever_the_blocks(spark, monkeypatch, seed, block_bytes, chunk):
    monkeypatch.setattr(repeats, "CHUNK", chunk)
    rows = odd_ids(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = remove_repeated_bytes(df, block_docs=16, bucket_bytes=5000, block_bytes=block_bytes).collect()
    assert sorted((-(10 ** 9) if r[0] is None else r[0], *r[1:]) for r in got) == by_start(rows, 100)


@pytest.mark.parametrize("seed,block_bytes,chunk", [(14, 1500, 1 << 20), (15, 3000, 90)])
def test_words_whatever_the_blocks(spark, monkeypatch, seed, block_bytes, chunk):
    monkeypatch.setattr(repeats, "CHUNK", chunk)
    rows = odd_ids(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = remove_repeated_words(df, block_docs=16, bucket_bytes=5000, block_bytes=block_bytes).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(map(key, got)) == sorted(key(r) for r in
                                           [(rows[i][0], *r[1:]) for i, r in enumerate(in_order(rows, 35))])


def in_order(rows, length):
    """brute_words row by row (it sorts by id, which may be null here)."""
    numbered = brute_words([(i, t) for i, (_, t) in enumerate(rows)], length)
    return numbered


def test_blocks_hold_a_bounded_number_of_bytes(spark):
    """64 MB of text under one id, and a third of the rows without an id."""
    text = F.concat(F.col("id").cast("string"), F.lit(" "), F.repeat(F.lit("0123456789"), 10_000))
    hot = spark.range(640, numPartitions=8).select(F.lit(7).cast("long").alias("doc_id"), text.cast("binary").alias("body"))
    null = spark.range(300, numPartitions=8).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), text.cast("binary").alias("body"))
    for df in (hot, null):
        sizes = repeats.into_blocks(df, 1024, 4 << 20).groupBy("block").agg(
            F.sum(F.octet_length("body")).alias("b"), F.count(F.lit(1)).alias("n")).collect()
        assert sum(r["n"] for r in sizes) == df.count() and max(r["b"] for r in sizes) < 3 * (4 << 20)


def test_one_id_with_64_mb_of_text(spark):
    docs = spark.range(640, numPartitions=8).select(
        F.lit(7).cast("long").alias("doc_id"), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(1599)), lambda i: F.sha2(F.concat(
            F.col("id").cast("string"), F.lit("-"), i.cast("string")).cast("binary"), 256)), "").alias("text"))
    got = remove_repeated_bytes(docs).agg(F.sum("n_bytes").alias("n"), F.sum("n_removed").alias("gone"), F.count(F.lit(1)).alias("c")).first()
    assert (got["n"], got["gone"], got["c"]) == (640 * 1600 * 64, 0, 640)
