"""Sharding into contiguous shards of balanced bytes.

Rows go to ranges of the order (doc_id, size, checksum); every range's bytes and rows are
summed, and the running totals of the ranges -- one small row each -- give every row
its global byte offset and place.  The byte line is cut at equal targets: a row lies in
the shard that holds its middle byte, so a shard differs from the target by less than
the largest row.  Shards are contiguous in the order, and a row's slot counts from its
shard's first row.

Texts move once, with the exchange into ranges; ranges are balanced whatever the ids (one
id may hold any share of the rows, as ties are dealt over ranges).  What is broadcast is one
row per range and one per shard.

Defined cases: a null text has no bytes (size 1, checksum 0); null ids come first; repeated
ids, repeated rows and equal texts are rows like others, and are not kept in one shard
(that would break the balance); with fewer rows than shards some shards are empty; an
empty table gives an empty result; columns of any name pass through, except that
``shard``, ``slot``, ``size`` and ``text_crc32`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import packed, unpacked
from strata.operators.ranges import RANGE, carried, into_ranges, nulls_first


def middle_cut(at: Column, size: Column, total: Column, shards: int) -> Column:
    """Number of the equal part of ``total`` that holds the middle of [at, at + size)."""
    wide = lambda c: c.cast("decimal(38,0)")
    twice = (wide(at) * F.lit(2) + wide(size)).cast("decimal(30,0)") * F.lit(shards).cast("decimal(8,0)")
    part = F.call_function("div", twice, wide(total * F.lit(2)))
    return F.least(part, F.lit(shards - 1)).cast("int")


def assign(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` plus ``size`` (UTF-8 bytes and 1), ``text_crc32``, ``shard`` (from 0) and
    ``slot`` (gapless from 0 in each shard)."""
    body = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = packed(docs, _id=F.col(f"`{id_col}`"), _size=F.octet_length(body).cast("long") + 1,
                  _crc=F.crc32(body.cast("binary")))
    order = ["_id", "_size", "_crc"]
    held = into_ranges(rows, order, "shard-ranges")
    totals = held.groupBy(RANGE).agg(F.sum("_size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    totals = totals.withColumn("_total", F.sum("_bytes").over(Window.partitionBy()))
    inside = Window.partitionBy(RANGE).orderBy(*nulls_first(order))
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = (held.join(F.broadcast(carried(totals, ["_bytes", "_rows"])), RANGE)
              .withColumn("_at", F.col("_bytes") + F.coalesce(F.sum("_size").over(before), F.lit(0)))
              .withColumn("_place", F.col("_rows") + F.row_number().over(inside) - 1)
              .withColumn("_shard", middle_cut(F.col("_at"), F.col("_size"), F.col("_total"), shards)))
    starts = placed.groupBy("_shard").agg(F.min("_place").alias("_first"))
    done = placed.join(F.broadcast(starts), "_shard")
    return unpacked(done, docs.columns, size=F.col("_size"), text_crc32=F.col("_crc"), shard=F.col("_shard"),
                    slot=(F.col("_place") - F.col("_first")).cast("long"))


def manifest(assigned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per shard that has rows: shard, n_rows, n_bytes, first and last id."""
    return assigned.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("n_bytes"),
        F.min_by(id_col, "slot").alias("first_id"), F.max_by(id_col, "slot").alias("last_id"))


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order over files that follow each other by name.

    A shard may be many files: rows are dealt by ranges of (shard, slot), so a task
    writes a contiguous piece and never a whole shard.
    """
    (assigned.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
