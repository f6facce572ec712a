"""N-gram Jaccard self-join with rare-first prefix filtering, exact.

A document's set holds the hashes of its distinct word n-grams.  Two
documents link when the Jaccard similarity of their sets reaches a threshold;
results are per document its class (equal sets) and its component.

1. One pass counts n-grams in a count sketch of fixed size (2**20 cells, whatever
   the corpus), which orders n-grams rare first, ties by hash, and gives each
   document its set's signature and profile (n-grams per hash bin).  Equal
   sets become one class, represented by its smallest doc_id.
2. A second pass sends, per distinct set, the prefix n-grams: two sets above the
   threshold share one.  Buckets keep n-grams that at least two classes sent.
3. In the groups that share a prefix n-gram, pairs pass the length, positional
   and suffix filters; the suffix filter bounds the Hamming distance from below
   by the profiles' difference.  First only each member's nearest candidate is
   verified on the full sets, and components formed; then the nearest of those
   still apart; then every pair across components that the filters leave.  So a
   group of many near copies costs a few pairs per member, and no link between
   components is lost.
   Groups of more than ``group_limit`` members are dealt out as pairs of blocks.
4. Candidate pairs are made distinct before they meet their sets, so each is
   verified once.  Sets are computed anew for the documents in a pair; a bit
   filter of fixed size (2 MB) keeps the rest of the texts from being sent.
   Components come from alternating star contractions.

Defined cases: null or wordless text has an empty set and links with nothing;
a text with fewer words than n has one n-gram, all its words; a null doc_id
counts as the smallest id and is returned as null; repeated rows form one
class; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import few_partitions, materialize, packed, small_batches, unpacked
from strata.llm.repeats import NULL_ID, arrow_bytes, group_starts, mix64, spans_index, word_tokens

BINS = 64
CELL_BITS = 20
FILTER_BITS = 24
PARTS = 16
ENTRY = np.dtype([("token", "<u8"), ("sid1", "<u8"), ("pos", "<u2")])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def gram_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    data, offsets = arrow_bytes(column)
    tokens = word_tokens(LOWER[data], offsets)[0]
    words, first = tokens.raw, tokens.offsets
    grams = np.full(max(len(words) - n + 1, 0), 1, np.uint64)
    for i in range(n):
        grams = mix64(grams * np.uint64(0x9E3779B97F4A7C15) + words[i:i + len(grams)])
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= n:
            yield np.unique(grams[a:b - n + 1])
        elif b > a:
            whole = np.full(1, b - a, np.uint64)
            for w in words[a:b]:
                whole = mix64(whole * np.uint64(0xD1B54A32D192ED03) + w)
            yield whole
        else:
            yield np.zeros(0, np.uint64)


def bounded_slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``most`` bytes of ``column``."""
    offsets = np.zeros(batch.num_rows + 1, np.int64)
    np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), out=offsets[1:])
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def signature(grams: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        return (int(mix64(grams ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)),
                int((mix64(grams + np.uint64(0x14057B7EF767814F)) * np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64)))


def sid_bytes(a: int, b: int) -> bytes:
    return a.to_bytes(8, "little") + b.to_bytes(8, "little")


def _survey(n: int):
    """kind 0: a row per document (doc_id, size, sid, profile); kind 1: parts of the sketch."""
    names = ["kind", "doc_id", "size", "sid", "sid1", "profile"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << CELL_BITS, np.uint32)
        seen = False
        for whole in batches:
            for batch in bounded_slices(whole, "body") if whole.num_rows else ():
                size, sid, half, profile = [], [], [], []
                for grams in gram_sets(batch.column("body"), n):
                    size.append(len(grams))
                    both = signature(grams)
                    sid.append(sid_bytes(*both))
                    half.append(both[0])
                    bins = np.bincount((grams & np.uint64(BINS - 1)).astype(np.int64), minlength=BINS)
                    profile.append(np.minimum(bins, 255).astype(np.uint8).tobytes())
                    np.add.at(cells, (grams >> np.uint64(64 - CELL_BITS)).astype(np.int64), 1)
                    seen = True
                yield pa.record_batch([pa.array(np.zeros(len(size), np.int32)), batch.column("doc_id"),
                                       pa.array(size, pa.int64()), pa.array(sid, pa.binary()),
                                       pa.array(np.array(half, np.uint64).view(np.int64)),
                                       pa.array(profile, pa.binary())], names)
        if seen:
            parts = cells.reshape(PARTS, -1)
            yield pa.record_batch([pa.array(np.ones(PARTS, np.int32)), pa.array(np.arange(PARTS), pa.int64()),
                                   pa.array(np.zeros(PARTS, np.int64)), pa.array([b""] * PARTS, pa.binary()),
                                   pa.array(np.zeros(PARTS, np.int64)), pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary())], names)
    return run


def _add_parts(table: pa.Table) -> pa.Table:
    total = np.zeros((1 << CELL_BITS) // PARTS, np.uint64)
    for blob in table.column("profile"):
        total += np.frombuffer(zlib.decompress(blob.as_py()), np.uint32)
    return pa.table({"part": pa.array([table.column("doc_id")[0].as_py()], pa.int64()),
                     "cells": pa.array([np.minimum(total, 65535).astype(np.uint16).tobytes()], pa.binary())})


def prefix_size(size: int, num: int, den: int) -> int:
    return size - -(-num * size // den) + 1


def _prefixes(n: int, num: int, den: int, buckets: int, sketch: np.ndarray, flush: int = 2_000_000):
    """Packed prefix entries by bucket, each set once per task (or flush)."""
    def pack(held: list) -> Iterator[pa.RecordBatch]:
        rec = np.concatenate(held)
        bucket = (rec["token"] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        rec, bucket = rec[order], bucket[order]
        cut = group_starts(bucket)
        ends = np.append(cut[1:], len(rec))
        yield pa.record_batch([pa.array(bucket[cut]), pa.array([rec[i:j].tobytes() for i, j in zip(cut, ends)], pa.binary())],
                              ["bucket", "rec"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, known = [], 0, set()
        for whole in batches:
            for batch in bounded_slices(whole, "body") if whole.num_rows else ():
                for grams in gram_sets(batch.column("body"), n):
                    if not len(grams):
                        continue
                    sid = signature(grams)
                    if sid in known:
                        continue
                    known.add(sid)
                    rank = sketch[(grams >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
                    lead = np.argsort(rank, kind="stable")[:prefix_size(len(grams), num, den)]
                    rec = np.zeros(len(lead), ENTRY)
                    rec["token"], rec["sid1"] = grams[lead], sid[0]
                    rec["pos"] = np.minimum(np.arange(len(lead)), 65535)  # a smaller place only filters less
                    held.append(rec)
                    count += len(rec)
                if count >= flush:
                    yield from pack(held)
                    held, count, known = [], 0, set()
        if count:
            yield from pack(held)
    return run


def _shared_tokens(table: pa.Table) -> pa.Table:
    """The entries whose token at least two different sets have.

    Sets go by the first half of their signature here; should two have it in
    common, both stay as members, and verification tells.
    """
    rec = np.frombuffer(b"".join(table.column("rec").to_pylist()), ENTRY)
    order = np.lexsort((rec["sid1"], rec["token"]))
    rec = rec[order]
    rec = rec[group_starts(rec["token"], rec["sid1"])]
    lead = group_starts(rec["token"])
    size = np.diff(np.append(lead, len(rec)))
    rec = rec[np.repeat(size > 1, size)]
    return pa.table({"token": pa.array(rec["token"].copy().view(np.int64)), "sid1": pa.array(rec["sid1"].copy().view(np.int64)),
                     "pos": pa.array(rec["pos"].astype(np.int32))})


def _candidate_pairs(num: int, den: int, nearest: int, step: int = 200_000):
    """Pairs of the groups that the filters leave and that lie in different components,
    with the bound of their distance: each member's ``nearest`` ones, or (0) all.

    A row's ``side`` tells the block it belongs to: only pairs of different blocks
    are formed where a group has been dealt out (-1: not dealt out).
    """
    def run(table: pa.Table) -> pa.Table:
        col = lambda c: table.column(c).to_numpy()
        order = np.lexsort((col("rep"), col("size"), col("part"), col("token")))
        token, part, rep, n, pos, comp, side = (col(c)[order] for c in ("token", "part", "rep", "size", "pos", "comp", "side"))
        profile = np.frombuffer(b"".join(table.column("profile").to_pylist()), np.uint8).reshape(-1, BINS)[order]
        lead = group_starts(token, part)
        group = np.repeat(np.arange(len(lead)), np.diff(np.append(lead, len(token))))
        key = group * (1 << 32) + n  # sorted: group, then size
        upto = np.searchsorted(key, group * (1 << 32) + np.minimum(n * den // num, (1 << 32) - 1), side="right")
        many = upto - np.arange(len(n)) - 1
        ends = np.cumsum(many)
        found = []
        at = 0
        while at < len(n):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + step, side="right")))
            i = np.repeat(np.arange(at, to), many[at:to])
            j = spans_index(np.arange(at, to)[many[at:to] > 0] + 1, many[at:to][many[at:to] > 0])
            at = to
            need = -(-num * (n[i] + n[j]) // (num + den))
            ok = (1 + np.minimum(n[i] - pos[i], n[j] - pos[j]) - 1 >= need) & (rep[i] != rep[j])
            ok &= (side[i] < 0) | (side[i] != side[j])
            ok &= comp[i] != comp[j]
            i, j, need = i[ok], j[ok], need[ok]
            bound = np.empty(len(i), np.int64)
            for lo in range(0, len(i), 50_000):
                a, b = i[lo:lo + 50_000], j[lo:lo + 50_000]
                bound[lo:lo + 50_000] = np.abs(profile[a].astype(np.int16) - profile[b]).sum(axis=1, dtype=np.int64)
            ok = bound <= n[i] + n[j] - 2 * need
            i, j, bound = i[ok], j[ok], bound[ok]
            if nearest and len(i):
                own, other, dist = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([bound, bound])
                order = np.lexsort((rep[other], dist, own))
                own, other, dist = own[order], other[order], dist[order]
                first = group_starts(own)
                rank = np.arange(len(own)) - np.repeat(first, np.diff(np.append(first, len(own))))
                i, j, bound = own[rank < nearest], other[rank < nearest], dist[rank < nearest]
            found.append(np.stack([np.minimum(rep[i], rep[j]), np.maximum(rep[i], rep[j]), bound], axis=1))
        pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1]), "bound": pa.array(pairs[:, 2])})
    return run


def _verify(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _id_bits(ids: np.ndarray) -> Iterator[np.ndarray]:
    """The places of ids in the filter of wanted documents."""
    for salt in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179, 0x3C6EF372FE94F82B):
        yield (mix64(ids.astype(np.int64).view(np.uint64) + np.uint64(salt)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _filter_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits, seen = np.zeros(1 << FILTER_BITS, bool), False
    for batch in batches:
        for places in _id_bits(batch.column("rep").to_numpy()):
            bits[places] = True
        seen |= batch.num_rows > 0
    if seen:
        parts = np.packbits(bits).reshape(PARTS, -1)
        yield pa.record_batch([pa.array(np.arange(PARTS), pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())],
                              ["part", "bits"])


def _join_parts(table: pa.Table) -> pa.Table:
    total = 0
    for blob in table.column("bits"):
        total = total | np.frombuffer(blob.as_py(), np.uint8)
    return pa.table({"part": table.column("part").slice(0, 1), "bits": pa.array([total.tobytes()], pa.binary())})


def _sets(n: int, wanted: np.ndarray):
    """Sets of the documents whose id passes the filter ``wanted`` (packed bits)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            ids = whole.column("doc_id").to_numpy()
            use = np.ones(len(ids), bool)
            for places in _id_bits(ids):
                use &= (wanted[places >> 3] >> (7 - (places & 7)) & 1).astype(bool)
            whole = whole.filter(pa.array(use))
            for batch in bounded_slices(whole, "body") if whole.num_rows else ():
                yield pa.record_batch([batch.column("doc_id"), pa.array([g.tobytes() for g in gram_sets(batch.column("body"), n)],
                                                                        pa.binary())], ["rep", "grams"])
    return run


def _contract_locally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a task to stars on their smallest member, by union-find."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
    stars = [(x, root(x)) for x in parent if root(x) != x]
    for lo in range(0, len(stars), 100_000):
        part = stars[lo:lo + 100_000]
        yield pa.record_batch([pa.array([s[1] for s in part], pa.int64()), pa.array([s[0] for s in part], pa.int64())],
                              ["a", "b"])


def components(links: DataFrame, name: str) -> DataFrame:
    """node, comp (smallest node of its component) of every node in ``links`` (a, b).

    Tasks first contract their own edges; then large-star and small-star steps
    alternate until every edge points at its component's smallest node.
    """
    edges = materialize(links.mapInArrow(_contract_locally, "a long, b long"), f"{name}-local", few=True)
    for k in range(60):
        # large star: every larger neighbour of a node to the smallest of its neighbourhood
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("c")).filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        # small star: every smaller neighbour, and the node itself, to the smallest
        large = large.filter("a <> b").distinct()
        small_least = large.groupBy(F.col("b").alias("c")).agg(F.min("a").alias("m"))
        joined = large.join(small_least, F.col("b") == F.col("c"))
        small = (joined.select(F.col("m").alias("a"), F.col("a").alias("b"))
                 .union(joined.select("m", "c")).filter("a <> b").distinct())
        after = materialize(small, f"{name}-star{k}", few=True)
        # done when no node is pointed at that points on, or points at two
        roots = after.select("a").distinct()
        loose = (after.join(roots.select(F.col("a").alias("r")), F.col("b") == F.col("r"), "left_semi").limit(1).count()
                 or after.groupBy("b").count().filter("count > 1").limit(1).count())
        edges = after
        if not loose:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("comp")).union(
        edges.select(F.col("a").alias("node"), F.col("a").alias("comp")).distinct())


def link_groups(docs: DataFrame, n: int = 3, num: int = 90, den: int = 100, id_col: str = "doc_id", text_col: str = "text",
                group_limit: int = 4096, bucket_entries: int = 300_000) -> DataFrame:
    """doc_id, n_shingles, class_id, component_id of every row.

    Documents link when ``den * |intersection| >= num * |union|``.  ``class_id`` is the
    smallest doc_id with an equal set, ``component_id`` the smallest reachable by
    links.  Links inside a component that is known already are not listed.
    """
    small_batches(docs.sparkSession)
    body = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc_id"),
                       F.col(text_col).cast("binary").alias("body"))
    survey = body.mapInArrow(_survey(n), "kind int, doc_id long, size long, sid binary, sid1 long, profile binary")
    survey = materialize(survey.repartition(few_partitions(docs.sparkSession)), "ngram-survey")
    rows = survey.filter("kind = 0")
    parts = (survey.filter("kind = 1").select("doc_id", "profile").groupBy("doc_id")
             .applyInArrow(_add_parts, "part long, cells binary").collect())
    sketch = np.zeros(1 << CELL_BITS, np.uint16)
    for p in parts:
        width = (1 << CELL_BITS) // PARTS
        sketch[p["part"] * width:(p["part"] + 1) * width] = np.frombuffer(p["cells"], np.uint16)
    classes = materialize(rows.filter("size > 0").groupBy("sid").agg(
        F.min("doc_id").alias("rep"), F.first("sid1").alias("sid1"), F.first("size").alias("size"), F.first("profile").alias("profile")), "ngram-classes", few=True)
    total = classes.agg(F.sum("size")).first()[0] or 0
    buckets = max(8, math.ceil(total * (den - num) / den / bucket_entries))
    entries = body.select("body").mapInArrow(_prefixes(n, num, den, buckets, sketch), "bucket long, rec binary")
    shared = entries.groupBy("bucket").applyInArrow(_shared_tokens, "token long, sid1 long, pos int")
    half = classes.select("rep", "size", "profile", "sid1")
    members = materialize(shared.join(half, "sid1").select("token", "pos", "rep", "size", "profile"), "ngram-members", few=True)
    members = _deal_out(members, group_limit)

    def pairs(members: DataFrame, comps: DataFrame | None, nearest: int, name: str) -> DataFrame:
        """Distinct candidate pairs (a, b, bound) of ``members`` across components."""
        rows = members.withColumn("comp", F.col("rep")) if comps is None else (
            members.join(comps, F.col("rep") == F.col("node"), "left").withColumn("comp", F.coalesce("comp", "rep")))
        found = (rows.withColumn("bucket", F.pmod(F.xxhash64("token", "part"), F.lit(max(8, buckets // 4))))
                 .groupBy("bucket").applyInArrow(_candidate_pairs(num, den, nearest), "a long, b long, bound long"))
        return materialize(found.distinct(), f"{name}-candidates", few=True)

    def sets_of(ids: DataFrame) -> DataFrame:
        """Sets (rep, grams) of the documents ``ids`` (rep)."""
        parts = (ids.mapInArrow(_filter_parts, "part long, bits binary").groupBy("part")
                 .applyInArrow(_join_parts, "part long, bits binary").collect())
        wanted = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
        for p in parts:
            width = len(wanted) // PARTS
            wanted[p["part"] * width:(p["part"] + 1) * width] = np.frombuffer(p["bits"], np.uint8)
        return materialize(body.mapInArrow(_sets(n, wanted), "rep long, grams binary")
                           .groupBy("rep").agg(F.min("grams").alias("grams")), "ngram-sets", few=True)

    def verified(candidates: DataFrame, name: str) -> DataFrame:
        met = (candidates.select("a", "b").join(sets.select(F.col("rep").alias("a"), F.col("grams").alias("x")), "a")
               .join(sets.select(F.col("rep").alias("b"), F.col("grams").alias("y")), "b"))
        return materialize(met.select("a", "b", "x", "y").mapInArrow(_verify(num, den), "a long, b long"),
                           f"{name}-links", few=True)

    # nearest of each member in each group: every member with a candidate is in one of these
    near = pairs(members, None, 1, "ngram-near")
    paired = near.select(F.col("a").alias("rep")).union(near.select("b")).distinct()
    sets = sets_of(paired)
    active = materialize(members.join(paired, "rep", "left_semi"), "ngram-active", few=True)
    # first the nearest of each member over all groups, then of what is still apart, then all of it
    sides = near.select(F.col("a").alias("own"), F.col("b").alias("other"), "bound").union(near.select("b", "a", "bound"))
    best = sides.groupBy("own").agg(F.min(F.struct("bound", "other"))["other"].alias("other"))
    first = best.select(F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b")).distinct()
    links = verified(first, "ngram-first")
    tried = first.select("a", "b")  # verified in any round, linked or not
    for name, nearest in (("ngram-second", 1), ("ngram-rest", 0)):
        apart = pairs(active, components(links, f"{name}-before"), nearest, name).join(tried, ["a", "b"], "left_anti")
        links = links.unionByName(verified(apart, name))
        tried = tried.unionByName(apart.select("a", "b"))
    comps = components(links, "ngram-all")
    of_class = (classes.select("sid", "rep").join(comps, F.col("rep") == F.col("node"), "left").drop("node"))
    out = (rows.join(of_class.withColumnRenamed("sid", "_sid"), F.col("sid") == F.col("_sid"), "left")
           .withColumn("class_id", F.when(F.col("size") > 0, F.col("rep")).otherwise(F.col("doc_id")))
           .withColumn("component_id", F.coalesce("comp", "class_id")))
    real = lambda c: F.when(F.col(c) != NULL_ID, F.col(c)).alias(c)
    return out.select(real("doc_id"), F.col("size").alias("n_shingles"), real("class_id"), real("component_id"))


def _deal_out(members: DataFrame, limit: int) -> DataFrame:
    """Groups over ``limit`` members as pairs of blocks: every two blocks meet in one
    part, and each block in a part of its own."""
    hot = members.groupBy("token").count().filter(F.col("count") > limit).select(
        F.col("token").alias("_t"), F.ceil(F.col("count") / (limit // 2)).cast("long").alias("_g"))
    marked = members.join(hot, F.col("token") == F.col("_t"), "left")
    block = F.pmod(F.xxhash64("rep"), F.col("_g"))
    other = F.explode(F.when(F.col("_g").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(
        F.sequence(F.lit(0).cast("long"), F.col("_g") - 1)))
    dealt = marked.withColumn("_own", block).withColumn("_other", other)
    part = F.when(F.col("_g").isNull(), F.lit(-1).cast("long")).otherwise(
        F.least("_own", "_other") * F.col("_g") + F.greatest("_own", "_other"))
    side = F.when(F.col("_g").isNull() | (F.col("_own") == F.col("_other")), F.lit(-1).cast("long")).otherwise(F.col("_own"))
    # in the part of two blocks, members of one block do not meet: they meet in their own part
    return dealt.withColumns({"part": part, "side": side}).drop("_t", "_g", "_own", "_other")


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, **options) -> DataFrame:
    """``docs`` without the members of a component other than the one with the smallest
    doc_id (of repeated rows of it, one)."""
    groups = link_groups(docs, n, num, den, **options)
    stay = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.coalesce("doc_id", F.lit(NULL_ID)).alias("_key")).distinct()
    rows = packed(docs, _key=F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)), _text=F.col("text"))
    again = Window.partitionBy("_key").orderBy(F.xxhash64("_text"))
    once = (rows.join(stay, "_key", "left_semi")  # the window keeps the join's partitioning: texts move once
            .withColumn("_rank", F.rank().over(again)).withColumn("_place", F.row_number().over(again))
            .filter(F.col("_rank") == F.col("_place")))
    return unpacked(once, docs.columns)
