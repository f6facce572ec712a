"""Finding every repeated window of L tokens in a corpus (bytes or words).

The shared engine of suffix-array dedup and substring dedup.

* A rolling hash over k-token grams picks a *trigger* for every window of L
  tokens: the leftmost gram with the smallest hash inside it.  Consecutive
  windows with one trigger form a *phrase* ``[s, s + n + L - 1)``; a
  document's phrases are its parse.  A phrase holds each of its windows
  whole, and equal windows have equal triggers at equal offsets, so only
  phrases with the same trigger gram need comparing.
* Round 1 counts triggers: each task sends, per block of documents, its
  distinct (trigger, phrase) to the trigger's bucket; the bucket answers each
  block which of its triggers occur again, and whether always in one phrase.
* Round 2 settles the triggers that do: every block sends its distinct
  phrases with their first position and count (and their tokens, where phrases
  of one trigger differ); the bucket sorts the suffixes of its dictionary of
  phrases and answers which windows repeat.
* The answers return to the blocks, which mark the covered tokens.

Skew: a block sends a trigger, phrase or window once, however many copies it
holds, so a bucket never gets more than one record of a key from a block.  A
trigger with very many different phrases (a passage that a third of all
documents continue differently) is split: its windows travel one by one, dealt
by the hash of the whole window.  Shuffled are packed arrays, a row per block
and bucket.

Memory: a block holds 16 MB of text or one longer document, about 24 bytes a byte in the task that
works on it; a long document is parsed a piece at a time.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialize, small_batches

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
LOW = np.uint64(63)
HIGH = ~LOW
CHUNK = 1 << 20
NULL_ID = -(1 << 63)

HEAD = np.dtype([("trig", "<u8"), ("phrase", "<u8"), ("doc", "<i8"), ("s", "<i8"), ("n", "<i4"), ("cnt", "<i4")])
DUP = np.dtype([("phrase", "<u8"), ("lo", "<i4"), ("hi", "<i4")])

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i (mod 2**64) for i < n."""
    if len(_powers[0]) < n:
        for i, b in enumerate((BASE, INVERSE)):
            x = np.full(n, b, np.uint64)
            x[0] = 1
            _powers[i] = np.multiply.accumulate(x)
    return _powers[0][:n], _powers[1][:n]


def mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@dataclass(frozen=True)
class Tokens:
    """A block's documents as one token array: document i is raw[offsets[i]:offsets[i + 1]]."""
    raw: np.ndarray
    offsets: np.ndarray
    values: Callable[[np.ndarray], np.ndarray]  # raw tokens to 64-bit values for hashing


def arrow_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column and its n + 1 offsets (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def byte_tokens(column) -> Tokens:
    raw, offsets = arrow_bytes(column)
    return Tokens(raw, offsets, lambda x: BYTE_VALUE[x])


IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end bytes of every word, and the number of the first word of each text (n + 1)."""
    solid = ~IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[1:-1] = solid[1:] != solid[:-1]
    edge[offsets] = True  # a text's end ends its last word
    before = np.zeros(len(data) + 1, bool)
    before[1:] = solid
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = solid
    starts, ends = np.flatnonzero(edge & after), np.flatnonzero(edge & before)
    return starts, ends, np.searchsorted(starts, offsets)


HEAD_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
LENGTH_SALT = np.uint64(0xA0761D6478BD642F)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words data[start:end].

    A word of up to 16 bytes is hashed from its first and last 8 bytes and its
    length, which tell it apart from any other; longer ones from all bytes.
    """
    padded = np.zeros(len(data) + 16, np.uint8)
    padded[8:-8] = data
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))  # the 8 bytes from each place
    size = ends - starts
    head = eight[starts + 8] & HEAD_MASK[np.minimum(size, 8)]
    tail = np.where(size > 8, eight[ends], np.uint64(0))
    out = mix64(head ^ mix64(tail + size.astype(np.uint64) * LENGTH_SALT))
    long = np.flatnonzero(size > 16)
    for lo in range(0, len(long), CHUNK // 32):
        pick = long[lo:lo + CHUNK // 32]
        n = size[pick]
        x = BYTE_VALUE[data[spans_index(starts[pick], n)]]
        p, inv = powers(len(x) + 1)
        sums = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(x * p[:len(x)], out=sums[1:])
        e = np.cumsum(n)
        out[pick] ^= mix64((sums[e] - sums[e - n]) * inv[e - n])
    return out


def word_tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[Tokens, np.ndarray, np.ndarray]:
    """Words as 64-bit hashes, with their start and end bytes."""
    starts, ends, first = word_bounds(data, offsets)
    return Tokens(word_hashes(data, starts, ends), first, lambda x: x), starts, ends


class Phrases:
    """Parse of a block: arrays trig, phrase (hashes), s (first token), n (windows), row (document)."""

    def __init__(self, tokens: Tokens, length: int, gram: int, windows_too: bool = False):
        parts = []
        off = tokens.offsets
        d = 0
        while d + 1 < len(off):
            e = max(d + 1, int(np.searchsorted(off, off[d] + CHUNK, side="right")) - 1)
            a, b = int(off[d]), int(off[e])
            if e == d + 1:  # a long document goes by pieces that share length - 1 tokens; a phrase may be cut in two
                for lo in range(a, b - length + 1, CHUNK):
                    hi = min(lo + CHUNK + length - 1, b)
                    parts.append(self._parse(tokens, lo, hi, np.array([0, hi - lo]), length, gram))
            elif b - a >= length:
                parts.append(self._parse(tokens, a, b, off[d:e + 1] - a, length, gram))
            d = e
        cat = lambda i, t: np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, t)
        self.trig, self.phrase = cat(0, np.uint64), cat(1, np.uint64)
        self.s, self.n = cat(2, np.int64), cat(3, np.int64)
        self.row = np.searchsorted(off, self.s, side="right") - 1
        self.length = length

    @staticmethod
    def _parse(tokens: Tokens, a: int, b: int, off: np.ndarray, length: int, gram: int):
        m, w = b - a, length - gram + 1
        p, inv = powers(m + 1)
        sums = np.zeros(m + 1, np.uint64)
        np.cumsum(tokens.values(tokens.raw[a:b]) * p[:m], out=sums[1:])
        g = mix64((sums[gram:] - sums[:-gram]) * inv[:m - gram + 1]) & HIGH
        # sliding minimum over w grams: running minima of aligned runs of w, from both ends
        rows = -(-len(g) // w)
        padded = np.full(rows * w, np.iinfo(np.uint64).max, np.uint64)
        padded[:len(g)] = g
        padded = (padded & HIGH).reshape(rows, w) | np.arange(w, dtype=np.uint64)
        fwd = np.minimum.accumulate(padded, axis=1).ravel()
        bwd = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
        # windows that lie in one document
        last = np.repeat(off[1:], np.diff(off)) - length
        start = np.flatnonzero(np.arange(m) <= last)
        left, right = bwd[start], fwd[start + w - 1]
        use_left = (left & HIGH) <= (right & HIGH)
        at = np.where(use_left, start - start % w + (left & LOW).astype(np.int64),
                      (start + w - 1) - (start + w - 1) % w + (right & LOW).astype(np.int64))
        new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.zeros(0, np.int64)
        s, trig_at = start[new], at[new]
        n = np.diff(np.append(new, len(at)))
        size = n + length - 1
        body = (sums[s + size] - sums[s]) * inv[s]
        phrase = mix64(body + (trig_at - s).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)
                       + size.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        return g[trig_at], phrase, s + a, n


def spans_index(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Concatenation of the ranges [start, start + size)."""
    if not len(starts):
        return np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    out = np.ones(int(ends[-1]), np.int64)
    out[0] = starts[0]
    out[ends[:-1]] = starts[1:] - (starts[:-1] + sizes[:-1] - 1)
    return np.cumsum(out)


def group_starts(*keys: np.ndarray) -> np.ndarray:
    """First places of the groups of equal keys (keys already sorted)."""
    change = np.ones(len(keys[0]), bool)
    if len(change):
        change[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(change)


# -- round 1 ------------------------------------------------------------------------

def _trigger_counts(make, length: int, gram: int, buckets: int, flush: int = 4_000_000):
    """Per block and bucket the distinct triggers, each with a phrase; the low bits of a
    trigger tell what the block holds: 0 one phrase once, 1 one phrase repeated,
    1 + c about 2**c phrases."""
    def pack(held: list) -> Iterator[pa.RecordBatch]:
        block = np.concatenate([h[0] for h in held])
        trig = np.concatenate([h[1] for h in held])
        phrase = np.concatenate([h[2] for h in held])
        order = np.lexsort((phrase, trig, block))
        block, trig, phrase = block[order], trig[order], phrase[order]
        lead = group_starts(block, trig)
        size = np.diff(np.append(lead, len(block)))
        change = np.zeros(len(phrase), np.int64)
        change[1:] = phrase[1:] != phrase[:-1]
        kinds = np.add.reduceat(change, lead) - change[lead] + 1  # distinct phrases of the group
        code = np.where(kinds > 1, 1 + np.ceil(np.log2(np.maximum(kinds, 2))).astype(np.int64), np.minimum(size, 2) - 1)
        block, phrase = block[lead], phrase[lead]
        trig = trig[lead] | code.astype(np.uint64)
        bucket = ((trig >> np.uint64(6)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((block, bucket))
        rec = np.stack([trig[order], phrase[order]], axis=1)
        block, bucket = block[order], bucket[order]
        cut = group_starts(bucket, block)
        ends = np.append(cut[1:], len(block))
        for lo in range(0, len(cut), 2000):
            c, e = cut[lo:lo + 2000], ends[lo:lo + 2000]
            yield pa.record_batch([pa.array(bucket[c]), pa.array(block[c]),
                                   pa.array([rec[i:j].tobytes() for i, j in zip(c, e)], pa.binary())],
                                  ["bucket", "block", "rec"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ph = Phrases(make(batch.column("body")), length, gram)
            held.append((batch.column("block").to_numpy()[ph.row], ph.trig, ph.phrase))
            count += len(ph.trig)
            if count >= flush:  # a block's triggers may then be sent in parts
                yield from pack(held)
                held, count = [], 0
        if count:
            yield from pack(held)
    return run


def _repeated_triggers(hot: int):
    """Answers to the blocks: the triggers that occur again; low bits 1: in one phrase
    only, 2: in several, 3: in very many."""
    def run(table: pa.Table) -> pa.Table:
        blobs = table.column("rec").to_pylist()
        sizes = np.array([len(b) // 16 for b in blobs])
        rec = np.frombuffer(b"".join(blobs), np.uint64).reshape(-1, 2)
        block = np.repeat(table.column("block").to_numpy(), sizes)
        order = np.lexsort((rec[:, 1], rec[:, 0] & HIGH))
        key, code, phrase, block = rec[order, 0] & HIGH, (rec[order, 0] & LOW).astype(np.int64), rec[order, 1], block[order]
        lead = group_starts(key)
        size = np.diff(np.append(lead, len(key)))
        several = (np.maximum.reduceat(code, lead) > 1) | (
            np.minimum.reduceat(phrase, lead) != np.maximum.reduceat(phrase, lead))
        again = (size > 1) | (code[lead] > 0)
        many = np.add.reduceat(np.where(code > 1, np.left_shift(1, np.maximum(code - 1, 0)), 1), lead) > hot
        kind = np.where(several, np.where(many, 3, 2), 1) * again
        kind = np.repeat(kind, size)
        use = np.flatnonzero(kind)
        key, block = key[use] | kind[use].astype(np.uint64), block[use]
        order = np.lexsort((key, block))
        key, block = key[order], block[order]
        one = group_starts(block, key)
        key, block = key[one], block[one]
        cut = group_starts(block)
        ends = np.append(cut[1:], len(block))
        return pa.table({"block": pa.array(block[cut], pa.int64()),
                         "round": pa.array(np.ones(len(cut), np.int32)),
                         "rec": pa.array([key[i:j].tobytes() for i, j in zip(cut, ends)], pa.binary())})
    return run


# -- round 2 ------------------------------------------------------------------------

class BlockView:
    """A block's phrases whose triggers repeat: distinct ones first in corpus order."""

    def __init__(self, tokens: Tokens, ids: np.ndarray, answers: bytes, length: int, gram: int):
        known = np.sort(np.frombuffer(answers, np.uint64))
        self.length = length
        ph = Phrases(tokens, length, gram)
        place = np.minimum(np.searchsorted(known & HIGH, ph.trig), max(len(known) - 1, 0))
        hit = (known[place] & HIGH) == ph.trig if len(known) else np.zeros(len(ph.trig), bool)
        kind = (known[place[hit]] & LOW).astype(np.int64) if len(known) else np.zeros(0, np.int64)
        trig, phrase, s, n, row = (x[hit] for x in (ph.trig, ph.phrase, ph.s, ph.n, ph.row))
        # windows of very common triggers travel one by one
        hot = kind == 3
        if hot.any():
            at = spans_index(s[hot], n[hot])
            own = np.repeat(np.flatnonzero(hot), n[hot])
            window = self._window_hashes(tokens, at)
            trig = np.concatenate([trig[~hot], trig[own]])
            phrase = np.concatenate([phrase[~hot], window])
            s, row = np.concatenate([s[~hot], at]), np.concatenate([row[~hot], row[own]])
            n = np.concatenate([n[~hot], np.ones(len(at), np.int64)])
            kind = np.concatenate([kind[~hot], np.full(len(at), 3)])
        doc, local = ids[row], s - tokens.offsets[row]
        order = np.lexsort((local, doc, phrase))
        self.trig, self.phrase, self.s, self.n = trig[order], phrase[order], s[order], n[order]
        self.kind, self.doc, self.local = kind[order], doc[order], local[order]
        self.lead = group_starts(self.phrase)
        self.count = np.diff(np.append(self.lead, len(self.phrase)))

    def _window_hashes(self, tokens: Tokens, at: np.ndarray) -> np.ndarray:
        out = np.empty(len(at), np.uint64)
        for lo in range(0, len(at), 50_000):
            p = at[lo:lo + 50_000]
            x = tokens.values(tokens.raw[p[:, None] + np.arange(self.length)])
            out[lo:lo + 50_000] = mix64((x * powers(self.length)[0]).sum(axis=1, dtype=np.uint64) ^ np.uint64(77))
        return out


def _send_phrases(make, length: int, gram: int, buckets: int):
    def run(key, docs: pa.Table, answers: pa.Table) -> pa.Table:
        block = key[0].as_py()
        blob = b"".join(answers.column("rec").to_pylist())
        if not docs.num_rows or not blob:
            return pa.table({"bucket": pa.array([], pa.int64()), "block": pa.array([], pa.int64()),
                             "head": pa.array([], pa.binary()), "body": pa.array([], pa.binary())})
        tokens = make(docs.column("body"))
        view = BlockView(tokens, docs.column("doc_id").to_numpy(), blob, length, gram)
        first = view.lead
        head = np.zeros(len(first), HEAD)
        head["trig"] = view.trig[first] | view.kind[first].astype(np.uint64)
        head["phrase"], head["doc"], head["s"] = view.phrase[first], view.doc[first], view.local[first]
        head["n"], head["cnt"] = view.n[first], np.minimum(view.count, 1 << 30)
        deal = np.where(view.kind[first] == 3, view.phrase[first], view.trig[first] >> np.uint64(6))
        bucket = (deal % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cut = group_starts(bucket[order])
        ends = np.append(cut[1:], len(order))
        heads, bodies = [], []
        for i, j in zip(cut, ends):
            pick = order[i:j]
            told = pick[view.kind[first[pick]] > 1]
            heads.append(head[pick].tobytes())
            bodies.append(tokens.raw[spans_index(view.s[first[told]], view.n[first[told]] + length - 1)].tobytes())
        return pa.table({"bucket": pa.array(bucket[order][cut], pa.int64()),
                         "block": pa.array(np.full(len(cut), block), pa.int64()),
                         "head": pa.array(heads, pa.binary()), "body": pa.array(bodies, pa.binary())})
    return run


def truncated_suffix_array(tokens: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``tokens`` that start at ``at``, sorted by their first ``length``
    tokens: the order, and a flag where the common prefix with the one before is
    shorter than ``length``."""
    if tokens.dtype != np.uint8:  # dense big-endian ranks compare as bytes
        tokens = np.unique(tokens, return_inverse=True)[1].astype(">u4")
    rows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(tokens, length)[at])
    keys = rows.view(np.dtype((np.void, rows.dtype.itemsize * length))).ravel()
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(order), bool)
    ranked = rows[order]
    new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
    return order, new


def _settle(length: int, dtype, judge: Callable, slice_windows: int = 200_000):
    """Which windows of which phrases repeat, answered to each block."""
    def run(table: pa.Table) -> pa.Table:
        heads = [np.frombuffer(b, HEAD) for b in table.column("head").to_pylist()]
        block = np.repeat(table.column("block").to_numpy(), [len(h) for h in heads])
        head = np.concatenate(heads)
        told = (head["trig"] & LOW) > 1
        body = np.frombuffer(b"".join(table.column("body").to_pylist()), dtype)
        size = np.where(told, head["n"] + length - 1, 0).astype(np.int64)
        place = np.cumsum(size) - size
        # classes: distinct phrases, with their first occurrence and all blocks' counts
        order = np.lexsort((head["s"], head["doc"], head["phrase"], head["trig"]))
        head, block, place = head[order], block[order], place[order]
        lead = group_starts(head["trig"], head["phrase"])
        cls = np.repeat(np.arange(len(lead)), np.diff(np.append(lead, len(head))))
        total = np.add.reduceat(head["cnt"].astype(np.int64), lead)
        first = head[lead]
        several = (first["trig"] & LOW) > 1
        # singles: the phrase is a window of its own kind
        dup_cls, dup_lo, dup_hi = [], [], []
        one = np.flatnonzero(~several)
        mark = judge(np.arange(len(one)), first["doc"][one], first["s"][one], total[one])
        dup_cls.append(one[mark]), dup_lo.append(np.zeros(mark.sum(), np.int64)), dup_hi.append(first["n"][one][mark])
        # dictionaries: slices of whole triggers, about slice_windows windows each
        multi = np.flatnonzero(several)
        if len(multi):
            whole = np.where((first["trig"][multi] & LOW) == 3, first["phrase"][multi], first["trig"][multi])
            multi = multi[np.argsort(whole, kind="stable")]
            whole = np.sort(whole)
            bound = group_starts(whole)
            upto = np.cumsum(first["n"][multi])
            step = np.append(upto[bound[1:] - 1], upto[-1]) // slice_windows if len(bound) > 1 else np.array([0])
            slices = np.append(bound[group_starts(step)], len(multi))
            for i, j in zip(slices[:-1], slices[1:]):
                own = multi[i:j]
                sizes = (first["n"][own] + length - 1).astype(np.int64)
                text = body[spans_index(place[lead[own]], sizes)]
                n = first["n"][own].astype(np.int64)
                at = spans_index(np.cumsum(sizes) - sizes, n)
                of, j_in = np.repeat(own, n), spans_index(np.zeros(len(n), np.int64), n)
                sa, new = truncated_suffix_array(text, at, length)
                group = np.empty(len(sa), np.int64)
                group[sa] = np.cumsum(new) - 1
                mark = judge(group, first["doc"][of], first["s"][of] + j_in, total[of])
                w = np.flatnonzero(mark)
                if len(w):  # runs of marked windows of one class
                    brk = np.ones(len(w), bool)
                    brk[1:] = (of[w[1:]] != of[w[:-1]]) | (j_in[w[1:]] != j_in[w[:-1]] + 1)
                    b = np.flatnonzero(brk)
                    dup_cls.append(of[w[b]]), dup_lo.append(j_in[w[b]])
                    dup_hi.append(j_in[w[np.append(b[1:], len(w)) - 1]] + 1)
        dup_cls, dup_lo, dup_hi = (np.concatenate(x) for x in (dup_cls, dup_lo, dup_hi))
        order = np.argsort(dup_cls, kind="stable")
        dup_cls, dup_lo, dup_hi = dup_cls[order], dup_lo[order], dup_hi[order]
        # answers per block and phrase: a class's marks hold for its first occurrence; judge
        # says whether later occurrences are covered whole
        # (rows that share an id and a place are equally first, whichever blocks they lie in)
        is_first = (head["doc"] == first["doc"][cls]) & (head["s"] == first["s"][cls])
        same = np.flatnonzero(is_first | (not judge.later_covered))
        a, b = np.searchsorted(dup_cls, cls[same]), np.searchsorted(dup_cls, cls[same], side="right")
        pick = spans_index(a[b > a], (b - a)[b > a])
        of = np.repeat(same, b - a)
        rest = np.flatnonzero(~is_first) if judge.later_covered else np.zeros(0, np.int64)
        out = np.zeros(len(of) + len(rest), DUP)
        out["phrase"] = np.concatenate([head["phrase"][of], head["phrase"][rest]])
        out["lo"] = np.concatenate([dup_lo[pick], np.zeros(len(rest), np.int64)])
        out["hi"] = np.concatenate([dup_hi[pick], head["n"][rest]])
        to = np.concatenate([block[of], block[rest]])
        order = np.argsort(to, kind="stable")
        out, to = out[order], to[order]
        cut = group_starts(to)
        ends = np.append(cut[1:], len(to))
        return pa.table({"block": pa.array(to[cut], pa.int64()), "round": pa.array(np.full(len(cut), 2, np.int32)),
                         "rec": pa.array([out[i:j].tobytes() for i, j in zip(cut, ends)], pa.binary())})
    return run


class SeenEarlier:
    """A window is covered if an equal one starts earlier in corpus order."""
    later_covered = True

    def __call__(self, group, doc, start, count):
        if not len(group):
            return np.zeros(0, bool)
        order = np.lexsort((start, doc, group))
        mark = np.ones(len(group), bool)
        lead = group_starts(group[order])
        size = np.diff(np.append(lead, len(group)))
        best_doc, best_start = np.repeat(doc[order][lead], size), np.repeat(start[order][lead], size)
        mark[order] = (doc[order] != best_doc) | (start[order] != best_start)
        return mark


class SeenAnywhere:
    """A window is covered if an equal one starts anywhere else."""
    later_covered = False

    def __call__(self, group, doc, start, count):
        if not len(group):
            return np.zeros(0, bool)
        return np.bincount(group, weights=count)[group] > 1


def _cover(make, length: int, gram: int, judge, digest: Callable, schema: str):
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    out = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")])

    def run(key, docs: pa.Table, answers: pa.Table) -> pa.Table:
        tokens = make(docs.column("body"))
        ids = docs.column("doc_id").to_numpy()
        rounds = answers.column("round").to_pylist()
        recs = answers.column("rec").to_pylist()
        triggers = b"".join(r for k, r in zip(rounds, recs) if k == 1)
        dups = np.frombuffer(b"".join(r for k, r in zip(rounds, recs) if k == 2), DUP)
        removed = np.zeros(len(tokens.raw) + 1, np.int32)
        if triggers:
            view = BlockView(tokens, ids, triggers, length, gram)
            phrase = view.phrase[view.lead]
            cls = np.repeat(np.arange(len(view.lead)), view.count)
            # what the buckets answered, for the first occurrence or for all
            hit = np.searchsorted(phrase, dups["phrase"])
            if judge.later_covered:
                start = [view.s[view.lead[hit]] + dups["lo"]]
                end = [view.s[view.lead[hit]] + dups["hi"]]
                later = np.ones(len(view.s), bool)
                later[view.lead] = False
                # a repeated row shares its document's positions: nothing starts earlier
                lead_of = view.lead[cls]
                later &= (view.doc != view.doc[lead_of]) | (view.local != view.local[lead_of])
                start.append(view.s[later]), end.append(view.s[later] + view.n[later])
                twin = ~later
                twin[view.lead] = False
                if twin.any():
                    order = np.argsort(hit, kind="stable")
                    a = np.searchsorted(hit[order], cls[twin])
                    b = np.searchsorted(hit[order], cls[twin], side="right")
                    pick = order[spans_index(a[b > a], (b - a)[b > a])]
                    base = np.repeat(view.s[twin], b - a)
                    start.append(base + dups["lo"][pick]), end.append(base + dups["hi"][pick])
            else:
                n = view.count[hit]
                occ = spans_index(view.lead[hit], n)
                start = [view.s[occ] + np.repeat(dups["lo"], n)]
                end = [view.s[occ] + np.repeat(dups["hi"], n)]
            start, end = np.concatenate(start), np.concatenate(end)
            np.add.at(removed, start, 1)
            np.add.at(removed, end + length - 1, -1)
            np.cumsum(removed, out=removed)
        return pa.table(digest(docs, tokens, removed[:-1] > 0, ids), schema=out)
    return run


def into_blocks(docs: DataFrame, block_docs: int, block_bytes: int) -> DataFrame:
    """``docs`` (doc_id, body) plus ``block``: ranges of ``block_docs`` ids, and where these hold more than
    ``block_bytes`` (long texts, null or repeated ids), parts of them dealt by the hash of the row.

    Equal rows share a block.  Which block a document lies in does not change the result.  The parts are
    a row per range that is too large, at most one for every ``block_bytes`` of input.
    """
    rows = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), "body").withColumn(
        "block", F.floor(F.col("doc_id") / block_docs).cast("long"))
    size = F.sum(F.coalesce(F.octet_length("body"), F.lit(0)))
    large = materialize(rows.groupBy("block").agg(F.ceil(size / block_bytes).alias("_parts")).filter(F.col("_parts") > 1),
                        "repeat-large-blocks", few=True)
    part = F.pmod(F.xxhash64("doc_id", "body"), F.col("_parts"))
    return rows.join(large, "block", "left").withColumn(
        "block", F.when(F.col("_parts").isNull(), F.col("block")).otherwise(F.xxhash64("block", part))).select("doc_id", "body", "block")


def without_repeats(docs: DataFrame, make: Callable, dtype, length: int, gram: int, judge, digest: Callable,
                    schema: str, block_docs: int = 1024, bucket_bytes: int = 16 << 20, hot: int = 20_000,
                    block_bytes: int = 16 << 20) -> DataFrame:
    """Apply ``digest`` to every block of ``docs`` (doc_id long, body binary) and the
    mask of its tokens that a repeated window covers.

    ``make`` turns the body column into :class:`Tokens`.  A null doc_id sorts first.
    """
    small_batches(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    buckets = max(8, math.ceil(total / bucket_bytes))
    blocks = into_blocks(docs, block_docs, block_bytes)
    counted = blocks.select("block", "body").mapInArrow(
        _trigger_counts(make, length, gram, buckets), "bucket long, block long, rec binary")
    answer = "block long, round int, rec binary"
    one = materialize(counted.groupBy("bucket").applyInArrow(_repeated_triggers(hot), answer), "repeat-triggers")
    sent = blocks.groupBy("block").cogroup(one.groupBy("block")).applyInArrow(
        _send_phrases(make, length, gram, buckets), "bucket long, block long, head binary, body binary")
    two = materialize(sent.groupBy("bucket").applyInArrow(_settle(length, dtype, judge), answer), "repeat-windows")
    return blocks.groupBy("block").cogroup(one.unionByName(two).groupBy("block")).applyInArrow(
        _cover(make, length, gram, judge, digest, schema), schema)
