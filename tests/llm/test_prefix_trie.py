"""Prefix trie against plain Python."""

import hashlib
import math
import random
import zlib

import pytest

from strata.llm import prefix_trie
from strata.llm.prefix_trie import NULL_ID, build, graft_heads, turns_of

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def ordered(rows):
    """conv (NULL_ID for null) to its list of (role, text)."""
    out = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for r in sorted(rows, key=key):
        out.setdefault(NULL_ID if r[0] is None else r[0], []).append((r[2] or "", r[3] or ""))
    return out


def grafted(convs):
    out = {}
    for c, own in convs.items():
        h = 0 if c == NULL_ID else zlib.crc32(str(c).encode()) % 9
        base = convs.get(c - int(math.fmod(c, 5)), []) if c != NULL_ID else []
        out[c] = base[:h] + own[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids, saved, leaves = {}, {}, {}
    for s in members:
        if s:
            kids.setdefault(s[:-1], []).append(s)
    for s in sorted(members, key=len, reverse=True):
        own = (len(members[s]) - 1) * len(s[-1][1].encode()) if s else 0
        saved[s] = own + sum(saved[k] for k in kids.get(s, []))
        leaves[s] = sum(leaves[k] for k in kids.get(s, [])) or 1
    show = lambda c: None if c == NULL_ID else c
    out = []
    for s, m in members.items():
        ends = sorted(c for c in m if len(convs[c]) == len(s))
        text = ",".join("null" if c == NULL_ID else str(c) for c in ends)
        out.append((show(min(m)), len(s), show(min(members[s[:-1]])) if s else None, len(m), len(kids.get(s, [])),
                    leaves[s], saved[s], hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, n=60, depth=10):
    rng = random.Random(seed)
    pool = [[(rng.choice(["user", "assistant", None]), rng.choice(["hi", "é" * 3, "", None, f"t{i}"])) for i in range(depth)]
            for _ in range(3)]
    rows = []
    for c in range(n):
        base = rng.choice(pool)
        keep = rng.randint(0, depth)
        talk = base[:keep] + [("user", f"own {c} {i}") for i in range(rng.choice([0, 0, 1, 3]))]
        rows += [(c if c % 13 else c - 40, i if i else None, r, t) for i, (r, t) in enumerate(talk)]
    rows += [(None, 1, "user", "null id"), (None, 1, "user", "null id"), (None, None, None, None)]
    rng.shuffle(rows)
    return rows


def run(spark, rows, graft, **options):
    turns = turns_of(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4))
    out = build(*graft_heads(turns), **options) if graft else build(turns, **options)
    return sorted((tuple(r) for r in out.select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("seed,graft,bound", [(1, False, 200_000), (2, True, 200_000), (3, False, 40), (4, True, 60)])
def test_against_brute_force(spark, seed, graft, bound):
    rows = corpus(seed)
    want = ordered(rows)
    assert run(spark, rows, graft, bound=bound) == brute(grafted(want) if graft else want)


def test_chain_of_truncations_and_copies(spark):
    """Every prefix of one long conversation is a conversation, and one is copied often."""
    talk = [("user", f"turn {i}") for i in range(24)]
    rows = [(c, i, *talk[i]) for c in range(24) for i in range(c + 1)]
    rows += [(100 + c, i, *talk[i]) for c in range(60) for i in range(12)]
    want = brute(ordered(rows))
    assert run(spark, rows, False) == want
    assert run(spark, rows, False, bound=200) == want


def test_single_path_beyond_the_bound(spark):
    rows = [(c, i, "user", f"t{i}") for c in (1, 2, 3) for i in range(50)] + [(9, 0, "user", "other")]
    assert run(spark, rows, False, bound=10) == brute(ordered(rows))


def test_long_member_lists_stream(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    rows = [(c, 0, "user", "same") for c in range(-50, 250)]
    got = run(spark, rows, False)
    assert got == brute(ordered(rows)) and len(got) == 2


def test_turnless_conversations_end_in_the_root(spark):
    turns = turns_of(spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string"))
    convs = spark.createDataFrame([(1,), (5,), (7,)], "_c long")
    rows = {r["depth"]: r for r in build(turns, convs).collect()}
    assert rows[0]["n_convs"] == 3 and rows[0]["n_ended"] == 2 and rows[0]["conv_id"] == 1
    assert rows[0]["ends_sha256"] == hashlib.sha256(b"5,7").hexdigest()
    only = build(turns.filter("false"), spark.createDataFrame([(4,)], "_c long")).collect()
    assert [(r["conv_id"], r["depth"], r["n_leaves"]) for r in only] == [(4, 0, 1)]


def test_empty_table_and_odd_columns(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert build(*graft_heads(turns_of(none))).collect() == []
    odd = spark.createDataFrame([(1, 0, "u", "x" * 300_000, 5, "q")],
                                "conv_id long, turn long, role string, text string, depth long, _c string")
    assert [(r["depth"], r["n_convs"], r["saved_tokens"]) for r in build(turns_of(odd)).orderBy("depth").collect()] == [
        (0, 1, 0), (1, 1, 0)]
