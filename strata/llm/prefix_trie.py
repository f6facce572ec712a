"""Conversation prefix trie by truncation peeling.

Every distinct sequence of a conversation's first d turns is a node.  The trie is never
built top down: starting at the greatest depth, conversations that end at a depth are merged
with the nodes that survive from below, each group is a node and is finished there (counts,
least member, leaves, saved tokens), then the last turn is stripped and what is left is
regrouped one level up.  Nodes are discovered and aggregated in the same pass.

Keys: a prefix is named by 128 bits, the sum over its turns of hashes of (depth, role, text),
so stripping a turn is a subtraction and prefixes of a conversation of any length come from
running sums over ranges of (conversation, turn); no task needs a whole conversation.

Skew: conversations that end in one node are merged before peeling, with partial sums, so
copies cost nothing further.  A subtree of at most ``bound`` turns (below the shallowest
prefix of 1, 2, 4, 8, ... turns where it is that small) is peeled whole inside one task, many
subtrees to a task; above such subtrees peeling goes level by level with grouped sums, which
no hot prefix can overload.  A single path longer than ``bound`` needs no merging at all and
is finished by running sums.  The list of conversations that end in a node is hashed as
a stream of sorted pieces, never gathered.

Defined cases: turns go by (turn, role, text), nulls first; a null role or text is empty;
repeated rows are turns of their own; a null conv_id is one conversation that sorts first
(``null`` in lists of members); an empty table has no node; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import materialize
from strata.operators.ranges import RANGE, into_ranges, nulls_first

NULL_ID = -(1 << 63)
MASK = 0xFFFFFFFF
KEY = ["depth", "k1", "k2"]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
PIECE = 1000  # members in one piece of a list
NODE = ("depth long, k1 long, k2 long, p1 long, p2 long, rep long, parent_rep long, top boolean, "
        "n_convs long, n_children long, n_leaves long, saved long, n_end long, end_rep long")
NODE_COLUMNS = [f.split()[0] for f in NODE.split(", ")]


def turns_of(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """``_c``, ``depth`` (place of the turn from 1), ``role``, ``text`` of every row."""
    named = lambda c, none: F.coalesce(F.col(f"`{c}`"), none)
    rows = conversations.select(named(conv_col, F.lit(NULL_ID)).alias("_c"), F.col(f"`{turn_col}`").alias("_t"),
                                named(role_col, F.lit("")).alias("role"), named(text_col, F.lit("")).alias("text"))
    order = ["_t", "role", "text"]
    held = into_ranges(rows, ["_c", *order], "trie-turns")
    inside = Window.partitionBy(RANGE, "_c").orderBy(*nulls_first(order))
    return (_continued(held.withColumn("_local", F.row_number().over(inside)), held.withColumn("_n", F.lit(1)), ["_n"])
            .select("_c", (F.col("_local") + F.col("_n")).cast("long").alias("depth"), "role", "text"))


def _continued(rows: DataFrame, held: DataFrame, sums: list[str]) -> DataFrame:
    """``rows`` plus, per conversation and range, the totals of ``sums`` over its earlier ranges.

    Only a range's first conversation can have begun earlier: one row per range at most is
    broadcast.
    """
    pieces = held.groupBy(RANGE, "_c").agg(*[F.sum(s).alias(s) for s in sums])
    earlier = Window.partitionBy("_c").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carry = pieces.select(RANGE, "_c", *[F.sum(s).over(earlier).alias(s) for s in sums]).filter(F.col(sums[0]).isNotNull())
    out = rows.drop(*sums).join(F.broadcast(carry), [RANGE, "_c"], "left")
    return out.withColumns({s: F.coalesce(s, F.lit(0)) for s in sums})


def graft_heads(turns: DataFrame, group: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on common heads: ``(turns, all conversation ids)``.

    Conversation c becomes the first h turns of conversation c - c % group, h = crc32(c) % heads,
    and then its own turns after its first h.  A null conv_id keeps its own turns.
    """
    h = F.when(F.col("_c") == NULL_ID, 0).otherwise(F.crc32(F.col("_c").cast("string").cast("binary")) % heads)
    own = materialize(turns, "trie-own")
    convs = own.groupBy("_c").agg(F.lit(1).alias("one")).select("_c", h.alias("_h"))
    heads_of = convs.filter((F.col("_c") != NULL_ID) & (F.col("_h") > 0)).select(
        F.col("_c").alias("_to"), "_h", (F.col("_c") - F.col("_c") % group).alias("_c"))
    copied = (own.filter(F.col("depth") < heads).join(heads_of, "_c").filter(F.col("depth") <= F.col("_h"))
              .select(F.col("_to").alias("_c"), "depth", "role", "text"))
    return own.filter(F.col("depth") > h).unionByName(copied), convs.select("_c")


def _packed(high: Column, low: Column) -> Column:
    cut = lambda c: c.bitwiseAND(F.lit(MASK))
    return F.shiftleft(cut(high), 32).bitwiseOR(cut(low))


def prefixes(turns: DataFrame) -> DataFrame:
    """One row per conversation and depth: key of the prefix and of its parent, bytes of
    the last turn's text and of all so far."""
    held = into_ranges(turns, ["_c", "depth"], "trie-rebuilt")
    inside = Window.partitionBy(RANGE, "_c").orderBy("depth")
    renumbered = _continued(held.withColumn("_local", F.row_number().over(inside)), held.withColumn("_n", F.lit(1)), ["_n"])
    renumbered = renumbered.withColumn("depth", (F.col("_local") + F.col("_n")).cast("long"))
    hashes = [F.xxhash64(F.lit(salt), "depth", "role", "text") for salt in (1, 2)]
    parts = {f"_s{i}{j}": part for i, x in enumerate(hashes)
             for j, part in enumerate((F.shiftrightunsigned(x, 32), x.bitwiseAND(F.lit(MASK))))}
    sums = [*parts, "_b"]
    hashed = materialize(renumbered.select(RANGE, "_c", "depth", *[c.alias(n) for n, c in parts.items()],
                                           F.octet_length("text").cast("long").alias("_b")), "trie-hashes")
    running = Window.partitionBy(RANGE, "_c").orderBy("depth")
    local = hashed.select(RANGE, "_c", "depth", *[F.col(s).alias(f"{s}_own") for s in sums],
                          *[F.sum(s).over(running).alias(f"{s}_sum") for s in sums])
    full = _continued(local, hashed, sums)
    upto = lambda s: F.col(f"{s}_sum") + F.col(s)
    before = lambda s: upto(s) - F.col(f"{s}_own")
    return full.select("_c", "depth", _packed(upto("_s00"), upto("_s01")).alias("k1"), _packed(upto("_s10"), upto("_s11")).alias("k2"),
                       _packed(before("_s00"), before("_s01")).alias("p1"), _packed(before("_s10"), before("_s11")).alias("p2"),
                       F.col("_b_own").alias("n_bytes"), upto("_b").alias("sum_bytes"))


# -- peeling inside a task ---------------------------------------------------------------

def _peel(table: pa.Table) -> pa.Table:
    """Peel the subtrees of one bucket from the greatest depth up to each one's cut."""
    col = {n: table.column(n).to_numpy() for n in ("_c", *KEY, "p1", "p2", "n_bytes", "len", "n_end", "cut")}
    order = np.lexsort((col["_c"], -col["depth"]))
    col = {n: x[order] for n, x in col.items()}
    bounds = np.flatnonzero(np.append(True, col["depth"][1:] != col["depth"][:-1])).tolist() + [len(order)]
    out = []
    alive = None  # survivors of the level below: rep, n_convs, leaves, saved and their row in `out`
    for a, b in zip(bounds[:-1], bounds[1:]):
        level = {n: x[a:b] for n, x in col.items()}
        ended = np.flatnonzero(level["len"] == level["depth"])
        stripped = np.searchsorted(level["_c"], alive["rep"]) if alive is not None else np.zeros(0, np.int64)
        at = np.concatenate([ended, stripped])
        n_end = np.concatenate([level["n_end"][ended], np.zeros(len(stripped), np.int64)])
        below = lambda n: np.concatenate([np.zeros(len(ended), np.int64), alive[n] if alive is not None else np.zeros(0, np.int64)])
        members, leaves, saved = below("n_convs") + n_end, below("n_leaves"), below("saved")
        child = np.arange(len(at)) >= len(ended)
        by = np.lexsort((level["_c"][at], level["k2"][at], level["k1"][at]))
        at, n_end, members, leaves, saved, child = (x[by] for x in (at, n_end, members, leaves, saved, child))
        k1, k2 = level["k1"][at], level["k2"][at]
        lead = np.flatnonzero(np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])))
        add = lambda x: np.add.reduceat(x, lead)
        first = at[lead]  # members sorted by id: the least comes first
        node = {n: level[n][first] for n in (*KEY, "p1", "p2", "cut")}
        node["rep"], node["n_convs"], node["n_children"] = level["_c"][first], add(members), add(child.astype(np.int64))
        node["n_leaves"] = np.maximum(add(leaves), 1)
        node["saved"] = add(saved) + (node["n_convs"] - 1) * level["n_bytes"][first]
        node["n_end"] = add(n_end)
        node["end_rep"] = np.maximum.reduceat(np.where(child, NULL_ID, level["_c"][at]), lead)
        node["top"] = node["depth"] == node["cut"]
        node["parent_rep"] = np.zeros(len(lead), np.int64)
        if alive is not None:
            group = np.repeat(np.arange(len(lead)), np.diff(np.append(lead, len(at))))
            place = by[child] - len(ended)  # survivors in the order they came in
            out[-1]["parent_rep"][alive["place"][place]] = node["rep"][group[child]]
        out.append(node)
        go = np.flatnonzero(~node["top"])
        alive = {n: node[n][go] for n in ("rep", "n_convs", "n_leaves", "saved")} | {"place": go}
        if len(go):  # tops of other subtrees end here; the rest meets its parents one level up
            by_rep = np.argsort(alive["rep"], kind="stable")
            alive = {n: x[by_rep] for n, x in alive.items()}
        else:
            alive = None
    done = {n: np.concatenate([o[n] for o in out]) for n in NODE_COLUMNS}
    return pa.table({n: pa.array(done[n], mask=done["top"] if n == "parent_rep" else None) for n in NODE_COLUMNS})


def _hash_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's members, from pieces in order."""
    key, sha, done = None, None, []

    def flush():
        rows = [(*k, s) for k, s in done]
        done.clear()
        return pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in
                                enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))], [*KEY, "ends_sha256"])

    for batch in batches:
        for *k, text in zip(*(batch.column(n).to_pylist() for n in (*KEY, "text"))):
            if k != key:
                if key is not None:
                    done.append((key, sha.hexdigest()))
                key, sha = k, hashlib.sha256(text.encode())
            else:
                sha.update(b"," + text.encode())
        if done:
            yield flush()
    if key is not None:
        done.append((key, sha.hexdigest()))
        yield flush()


# -- the trie ----------------------------------------------------------------------------

def build(turns: DataFrame, convs: DataFrame | None = None, bound: int = 200_000) -> DataFrame:
    """All nodes of the trie of ``turns`` (``_c``, ``depth``, ``role``, ``text``).

    Conversations in ``convs`` (column ``_c``) without turns end in the root.  Columns:
    conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    (over the subtree, copies of each last turn beyond the first, in bytes), n_ended and
    ends_sha256 (members that end here).
    """
    paths = materialize(prefixes(turns), "trie-prefixes")
    ends = paths.groupBy("_c").agg(F.max(F.struct(*KEY, "sum_bytes")).alias("e")).select("_c", "e.*")
    if convs is not None:
        zero = F.lit(0).cast("long")
        ends = ends.unionByName(convs.join(ends, "_c", "left_anti").select(
            "_c", *[zero.alias(c) for c in (*KEY, "sum_bytes")]))
    ends = into_ranges(ends, [*KEY, "_c"], "trie-ends")
    end_nodes = materialize(ends.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_end"), F.min("_c").alias("_c"),
                                                   F.max("sum_bytes").alias("end_bytes")), "trie-end-nodes")
    reps = end_nodes.select("_c", F.col("depth").alias("len"), "n_end", "end_bytes").filter("len > 0")
    rows = materialize(paths.join(reps, "_c"), "trie-paths")

    # where subtrees are small enough to be peeled whole
    gates = rows.filter(F.expr("depth & (depth - 1)") == 0)
    large = (gates.groupBy(*KEY).agg(F.sum(F.expr("len - depth + 1")).alias("w"), F.count(F.lit(1)).alias("n"))
             .filter(F.col("w") > bound).select(*KEY, "n"))
    cuts = materialize(gates.join(large, KEY, "left").filter(F.coalesce("n", F.lit(1)) == 1).groupBy("_c").agg(
        F.min("depth").alias("cut"), F.min_by(F.struct("k1", "k2"), "depth").alias("at"),
        F.min_by(F.col("n").isNotNull(), "depth").alias("path"),
        F.max("len").alias("len")), "trie-cuts")
    told = cuts.agg(F.sum(F.expr("len - cut + 1"))).first()[0] or 0
    buckets = max(1, math.ceil(told / bound))
    cut_rows = rows.join(cuts.select("_c", "cut", "path", F.pmod(F.xxhash64("at"), F.lit(buckets)).alias("_bucket")), "_c", "left")
    small = cut_rows.filter((F.col("depth") >= F.col("cut")) & ~F.col("path"))
    nodes = [small.select("_bucket", "_c", *KEY, "p1", "p2", "n_bytes", "len", "n_end", "cut")
             .groupBy("_bucket").applyInArrow(_peel, NODE)]
    lone = cut_rows.filter((F.col("depth") >= F.col("cut")) & F.col("path"))
    is_end, top = F.col("depth") == F.col("len"), F.col("depth") == F.col("cut")
    nodes.append(lone.select(
        *KEY, "p1", "p2", F.col("_c").alias("rep"), F.when(~top, F.col("_c")).alias("parent_rep"), top.alias("top"),
        F.col("n_end").alias("n_convs"), F.when(is_end, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("n_end") - 1) * (F.col("end_bytes") - F.col("sum_bytes") + F.col("n_bytes"))).alias("saved"),
        F.when(is_end, F.col("n_end")).otherwise(0).cast("long").alias("n_end"),
        F.when(is_end, F.col("_c")).otherwise(F.lit(NULL_ID)).alias("end_rep")))
    deep = materialize(nodes[0].unionByName(nodes[1]), "trie-subtrees")

    # the rest, level by level
    upper = cut_rows.filter(F.col("cut").isNull() | (F.col("depth") < F.col("cut")))
    known = materialize(upper.groupBy(*KEY).agg(*[F.min(c).alias(c) for c in ("p1", "p2", "n_bytes")]), "trie-upper")
    ending = end_nodes.join(cuts.select("_c"), "_c", "left_anti")
    below = deep.filter("top").select("depth", "p1", "p2", "rep", "n_convs", "n_leaves", "saved")
    levels = []
    for d in range(known.agg(F.max("depth")).first()[0] or 0, -1, -1):
        came = below.filter(F.col("depth") == d + 1)
        if levels:
            came = came.unionByName(levels[-1].select(*came.columns))
        stripped = came.select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), "rep", "n_convs", F.lit(1).alias("child"),
                               "n_leaves", "saved", F.lit(0).alias("n_end"), F.lit(NULL_ID).alias("end_rep"))
        ended = ending.filter(F.col("depth") == d).select(
            "k1", "k2", F.col("_c").alias("rep"), F.col("n_end").alias("n_convs"), F.lit(0).alias("child"),
            F.lit(0).alias("n_leaves"), F.lit(0).alias("saved"), "n_end", F.col("_c").alias("end_rep"))
        node = stripped.unionByName(ended).groupBy("k1", "k2").agg(
            F.min("rep").alias("rep"), F.sum("n_convs").alias("n_convs"), F.sum("child").cast("long").alias("n_children"),
            F.greatest(F.sum("n_leaves"), F.lit(1)).alias("n_leaves"), F.sum("saved").alias("saved"),
            F.sum("n_end").cast("long").alias("n_end"), F.max("end_rep").alias("end_rep")).withColumn("depth", F.lit(d).cast("long"))
        if d:
            node = node.join(known.filter(F.col("depth") == d).drop("depth"), ["k1", "k2"])
        else:
            node = node.withColumns({c: F.lit(0).cast("long") for c in ("p1", "p2", "n_bytes")})
        node = node.withColumn("saved", F.col("saved") + (F.col("n_convs") - 1) * F.col("n_bytes")).drop("n_bytes")
        levels.append(materialize(node.withColumns({"parent_rep": F.lit(None).cast("long"), "top": F.lit(True)})
                                  .select(*NODE_COLUMNS), f"trie-level-{d}", few=d < 2))
    upper_nodes = levels[0]
    for level in levels[1:]:
        upper_nodes = upper_nodes.unionByName(level)
    parents = upper_nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                                 F.col("rep").alias("_parent"))
    open_ = deep.filter("top").unionByName(upper_nodes).join(parents, ["depth", "p1", "p2"], "left").withColumn(
        "parent_rep", F.col("_parent")).select(*NODE_COLUMNS)
    every = deep.filter("NOT top").unionByName(open_)

    listed = every.join(_member_lists(ends), KEY, "left")
    given = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return listed.select(
        given("rep").alias("conv_id"), "depth", given("parent_rep").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.col("n_end").alias("n_ended"),
        F.coalesce("ends_sha256", F.when(F.col("n_end") > 0, F.sha2(_shown("end_rep").cast("binary"), 256))
                   .otherwise(F.lit(EMPTY_SHA))).alias("ends_sha256"))


def _shown(c: str) -> Column:
    return F.when(F.col(c) == NULL_ID, F.lit("null")).otherwise(F.col(c).cast("string"))


def _member_lists(ends: DataFrame) -> DataFrame:
    """Hash of the sorted, comma-joined members of every end node with two or more.

    Members lie in ranges of (node, id); each range joins its own into pieces, and a
    task hashes the pieces of a node one after the other as they stream by.
    """
    inside = Window.partitionBy(RANGE, *KEY).orderBy("_c")
    pieces = (ends.withColumn("_piece", F.floor((F.row_number().over(inside) - 1) / PIECE))
              .groupBy(RANGE, *KEY, "_piece")
              .agg(F.array_sort(F.collect_list("_c")).alias("ids"), F.min("_c").alias("first"))
              .withColumn("text", F.concat_ws(",", F.transform("ids", lambda c: F.when(c == NULL_ID, F.lit("null")).otherwise(c.cast("string"))))))
    ordered = pieces.select(*KEY, "first", "text").repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return ordered.mapInArrow(_hash_lists, "depth long, k1 long, k2 long, ends_sha256 string")
