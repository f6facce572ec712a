"""Benchmark decontamination by latent semantic retrieval.

1. Words are hashed to ``DIMS`` features; one pass over the corpus counts in how
   many passages (64 words) each feature occurs.  A feature weighs the cube of
   its inverse document frequency, so that common words do not fill the
   leading directions.
2. A second pass multiplies the TF-IDF matrix A of all passages from both sides
   by a random test matrix, A'(A Omega): every task sums its share, the shares
   are added by parts, and the driver gets the DIMS x rank sketch, whose size
   depends on neither corpus nor cluster.  Its Nystroem form gives the leading
   right singular vectors and values.
3. A third pass projects every text in blocks of 16 words.  Sums of neighbouring
   blocks are windows fitting each item's length; windows whose cosine with an
   item reaches ``cosine`` are candidates.  So are, whatever their cosine, windows
   around a seed of the item, a pair of neighbouring words that few other items
   have: words of an item in many passages weigh next to nothing, and other words
   of the window would hide it.
4. Candidates are checked on their words: the longest common subsequence must
   cover ``lcs`` of the item, or ``weak_lcs`` of it if the item's answer (its last
   ``answer_words`` words) stands in the window in one piece.

Items are searched in blocks of ``item_block``, so what goes to the tasks is
bounded however many there are.  The corpus is never shuffled.

Defined cases: null or wordless texts and items match nothing; items that
repeat are found each; a null doc_id is reported as null; repeated rows give
repeated findings in :func:`find_leaks` and go together in
:func:`remove_leaks`; an empty corpus or benchmark gives no findings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialize, packed, small_batches, unpacked
from strata.llm.ngram_join import LOWER, bounded_slices
from strata.llm.repeats import arrow_bytes, spans_index, word_tokens

DIM_BITS = 12
DIMS = 1 << DIM_BITS
PASSAGE = 64
BLOCK = 16
PARTS = 8
STEP = 1 << 15  # words per matrix step
SEEDS = 8  # word pairs of an item, and as many again at most in its answer
SEED_BITS = 22


def _words(column) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, and the first word of each (n + 1)."""
    data, offsets = arrow_bytes(column)
    tokens = word_tokens(LOWER[data], offsets)[0]
    return tokens.raw, tokens.offsets


def _feature(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - DIM_BITS)).astype(np.int64)


def _pairs(words: np.ndarray) -> np.ndarray:
    """Hash of each word with the next one."""
    return (words[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (words[1:] * np.uint64(0xC2B2AE3D27D4EB4F))


def _pieces(first: np.ndarray, size: int) -> np.ndarray:
    """Starts of the runs of ``size`` words that each text is cut into."""
    n = -(-np.diff(first) // size)
    begin = np.repeat(first[:-1], n)
    return begin + spans_index(np.zeros((n > 0).sum(), np.int64), n[n > 0]) * size


def _passage_features(words: np.ndarray, start: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The distinct features of each passage, step by step: (features, first of each passage)."""
    size = np.diff(np.append(start, len(words)))
    for i in range(0, len(start), STEP // PASSAGE):
        n = size[i:i + STEP // PASSAGE]
        rows = np.full((len(n), PASSAGE), DIMS, np.uint16)  # DIMS stands for no word
        rows[np.arange(PASSAGE) < n[:, None]] = _feature(words[start[i]:start[i] + n.sum()])
        rows.sort(axis=1)
        once = rows < DIMS
        once[:, 1:] &= rows[:, 1:] != rows[:, :-1]
        yield rows[once].astype(np.int64), np.cumsum(once.sum(axis=1)) - once.sum(axis=1)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, passages = np.zeros(DIMS, np.int64), 0
    for whole in batches:
        for batch in bounded_slices(whole, "body") if whole.num_rows else ():
            words, first = _words(batch.column("body"))
            start = _pieces(first, PASSAGE)
            for features, _ in _passage_features(words, start):
                df += np.bincount(features, minlength=DIMS)
            passages += len(start)
    if passages:
        yield pa.record_batch([pa.array([passages], pa.int64()), pa.array([df.tolist()], pa.list_(pa.int64()))], ["n", "df"])


def feature_weights(body: DataFrame) -> np.ndarray | None:
    """Weight (cubed inverse document frequency) of every feature over all passages;
    None without any."""
    counts = body.mapInArrow(_frequencies, "n long, df array<long>")
    per = counts.select("n", F.posexplode("df").alias("i", "c")).groupBy("i").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))
    rows = per.collect()  # DIMS rows
    if not rows:
        return None
    out = np.zeros(DIMS)
    for r in rows:
        out[r["i"]] = np.log((1 + r["n"]) / (1 + r["c"])) ** 3
    return out.astype(np.float32)


def _sketch(idf: np.ndarray, omega: np.ndarray):
    """A task's share of A'(A Omega), in parts of rows."""
    table = idf[:, None] * omega

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(omega.shape), False
        for whole in batches:
            for batch in bounded_slices(whole, "body") if whole.num_rows else ():
                words, first = _words(batch.column("body"))
                for f, at in _passage_features(words, _pieces(first, PASSAGE)):
                    w = idf[f]
                    norm = np.add.reduceat(w * w, at) + 1e-12
                    y = np.add.reduceat(table[f], at, axis=0) / norm[:, None]
                    own = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(f))))
                    order = np.argsort(f.astype(np.uint16), kind="stable")
                    f, own = f[order], own[order]
                    lead = np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]]))
                    total[f[lead]] += np.add.reduceat(y[own], lead, axis=0) * idf[f[lead]][:, None]
                    seen = True
        if seen:
            yield pa.record_batch([pa.array(np.arange(PARTS), pa.int64()),
                                   pa.array([p.tobytes() for p in total.reshape(PARTS, -1)], pa.binary())], ["part", "share"])
    return run


def _add_shares(table: pa.Table) -> pa.Table:
    total = 0
    for blob in table.column("share"):
        total = total + np.frombuffer(blob.as_py(), np.float64)
    return pa.table({"part": table.column("part").slice(0, 1), "share": pa.array([total.tobytes()], pa.binary())})


def latent_projection(body: DataFrame, idf: np.ndarray, rank: int, seed: int) -> np.ndarray | None:
    """DIMS x k matrix that takes counts to whitened latent coordinates (k at most ``rank``)."""
    omega = np.linalg.qr(np.random.default_rng(seed).standard_normal((DIMS, rank + 8)))[0].astype(np.float32)
    rows = (body.mapInArrow(_sketch(idf, omega), "part long, share binary").groupBy("part")
            .applyInArrow(_add_shares, "part long, share binary").collect())
    if not rows:
        return None
    rows.sort(key=lambda r: r["part"])
    b = np.concatenate([np.frombuffer(r["share"], np.float64) for r in rows]).reshape(omega.shape)
    scale = np.linalg.norm(b)
    if not scale:
        return None
    # Nystroem: K = A'A is about B (Omega'B)^-1 B', stabilised by a small shift
    shift = 1e-6 * scale
    b = b + shift * omega
    core = omega.T.astype(np.float64) @ b
    chol = np.linalg.cholesky((core + core.T) / 2 + 1e-9 * scale * np.eye(len(core)))
    u, s, _ = np.linalg.svd(np.linalg.solve(chol, b.T).T, full_matrices=False)
    values = np.maximum(s * s - shift, 0)
    keep = np.flatnonzero(values[:rank] > 1e-4 * values[0])
    return (idf[:, None] * u[:, keep] / np.sqrt(values[keep])).astype(np.float32)


class Items:
    """A block of benchmark items, ready to be searched."""

    def __init__(self, rows: list, projection: np.ndarray, answer_words: int):
        self.projection = projection
        words, first = _words(pa.array([r["text"].encode() for r in rows], pa.large_binary()))
        self.ids, self.words, vectors, scales = [], [], [], []
        for r, a, b in zip(rows, first[:-1], first[1:]):
            if a == b:
                continue
            v = projection[_feature(words[a:b])].sum(axis=0)
            norm = np.linalg.norm(v)  # 0 if its words are in every passage
            self.ids.append(r["item_id"])
            self.words.append(words[a:b].tolist())
            vectors.append(v / (norm or 1))
            scales.append(-(-(b - a + BLOCK - 1) // BLOCK))  # blocks that hold it wherever it starts
        self.answers = [w[-answer_words:] for w in self.words]
        self.vectors = np.asarray(vectors, np.float32)
        self.scales = np.asarray(scales)
        self.has_feature = np.zeros((len(self.ids), DIMS), bool)
        self.sizes = np.array([len(w) for w in self.words])
        self.masks = []
        for i, w in enumerate(self.words):
            self.has_feature[i, _feature(np.array(w, np.uint64))] = True
        for w in self.words:
            mask: dict[int, int] = {}
            for i, x in enumerate(w):
                mask[x] = mask.get(x, 0) | (1 << i)
            self.masks.append(mask)
        self._plant(answer_words)

    def _plant(self, answer_words: int) -> None:
        """Choose each item's seeds: the pairs that fewest items have, in all of it and in its answer."""
        pairs = [_pairs(np.array(w, np.uint64)) for w in self.words]
        known, uses = np.unique(np.concatenate([np.unique(p) for p in pairs] or [np.zeros(0, np.uint64)]), return_counts=True)
        keys, items, places = [], [], []
        for i, p in enumerate(pairs):
            order = np.argsort(uses[np.searchsorted(known, p)], kind="stable")
            tail = order[order > len(p) - answer_words]
            rare = order
            if len(rare) > SEEDS:  # of equally rare ones, some from all over the item
                same = uses[np.searchsorted(known, p[order])] <= uses[np.searchsorted(known, p[order[SEEDS - 1]])]
                rare = order[same][np.linspace(0, same.sum() - 1, SEEDS).astype(int)]
            own = np.union1d(rare, tail[:SEEDS])
            keys.append(p[own])
            items.append(np.full(len(own), i))
            places.append(own)
        keys = np.concatenate(keys or [np.zeros(0, np.uint64)])
        order = np.argsort(keys, kind="stable")
        self.seed_keys = keys[order]
        self.seed_items = np.concatenate(items or [np.zeros(0, np.int64)])[order]
        self.seed_places = np.concatenate(places or [np.zeros(0, np.int64)])[order]
        self.seeded = np.zeros(1 << SEED_BITS, bool)
        self.seeded[keys >> np.uint64(64 - SEED_BITS)] = True

    def seed_windows(self, words: np.ndarray, text: np.ndarray, bounds: np.ndarray, begin: np.ndarray,
                     stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, first block) of the windows that a seed points at, each once, in order of items."""
        keys = _pairs(words)
        at = np.flatnonzero(self.seeded[keys >> np.uint64(64 - SEED_BITS)])
        lo, hi = (np.searchsorted(self.seed_keys, keys[at], side) for side in ("left", "right"))
        at, lo, n = at[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
        seed = spans_index(lo, n)
        at = np.repeat(at, n)
        block = np.searchsorted(bounds, at, side="right") - 1
        # a pair across two texts points at the first one: harmless, as candidates are checked
        own = text[block]
        item = self.seed_items[seed]
        lead = np.searchsorted(bounds, np.maximum(at - self.seed_places[seed], 0), side="right") - 1
        last = np.maximum(stop[own] - self.scales[item], begin[own])
        # words more or less before the seed shift the start
        start = np.concatenate([np.clip(lead + k, begin[own], last) for k in (-1, 0)])
        both = np.unique(np.tile(item, 2) * np.int64(len(bounds)) + start)
        return both // len(bounds), both % len(bounds)

    def candidates(self, words: np.ndarray, first: np.ndarray, cosine: float,
                   share: float) -> Iterator[tuple[int, int, int, int, float]]:
        """(item, text, first word, end word, cosine) of the windows near an item or with a seed of it.

        Windows with fewer words of the item's features than ``share`` of its length
        cannot hold such a subsequence and are left out.
        """
        start = _pieces(first, BLOCK)
        if not len(start):
            return
        f = _feature(words)
        blocks = np.empty((len(start), self.projection.shape[1]), np.float32)
        bounds = np.append(start, len(words))
        per = STEP // BLOCK
        for i in range(0, len(start), per):
            j = min(len(start), i + per)
            blocks[i:j] = np.add.reduceat(self.projection[f[bounds[i]:bounds[j]]], start[i:j] - bounds[i], axis=0)
        text = np.searchsorted(first, start, side="right") - 1
        begin = np.searchsorted(text, np.arange(len(first) - 1))
        stop = np.searchsorted(text, np.arange(len(first) - 1), side="right")
        for scale in np.unique(self.scales):
            own = np.flatnonzero(self.scales == scale)
            # windows of `scale` blocks; a shorter text is one window
            n = np.where(stop > begin, np.maximum(stop - begin - scale + 1, 1), 0)
            b = spans_index(begin[n > 0], n[n > 0])
            e = np.minimum(b + scale, stop[text[b]])
            for lo in range(0, len(b), 8192):
                p, q = b[lo:lo + 8192], e[lo:lo + 8192]
                z = blocks[p]
                for k in range(1, scale):
                    more = p + k < q
                    if more.all():
                        z += blocks[p + k]
                    else:
                        z[more] += blocks[p[more] + k]
                z /= np.linalg.norm(z, axis=1, keepdims=True) + 1e-12
                near = z @ self.vectors[own].T
                ws, its = np.nonzero(near >= cosine)
                yield from self._held(own[its], p[ws], q[ws], near[ws, its], f, text, bounds, share)
        item, p = self.seed_windows(words, text, bounds, begin, stop)
        q = np.minimum(p + self.scales[item], stop[text[p]])
        for lo in range(0, len(p), 4096):
            i, b, e = item[lo:lo + 4096], p[lo:lo + 4096], q[lo:lo + 4096]
            z = np.add.reduceat(blocks[spans_index(b, e - b)], np.cumsum(e - b) - (e - b), axis=0)
            near = (z * self.vectors[i]).sum(axis=1) / (np.linalg.norm(z, axis=1) + 1e-12)
            new = near < cosine  # the others came above
            yield from self._held(i[new], b[new], e[new], near[new], f, text, bounds, share)

    def _held(self, items: np.ndarray, p: np.ndarray, q: np.ndarray, near: np.ndarray, f: np.ndarray, text: np.ndarray,
              bounds: np.ndarray, share: float) -> Iterator[tuple[int, int, int, int, float]]:
        """The windows (blocks ``p`` to ``q``) with enough words of the item's features."""
        for at in range(0, len(items), 4096):
            i, b, e = items[at:at + 4096], p[at:at + 4096], q[at:at + 4096]
            place = bounds[b][:, None] + np.arange(BLOCK * self.scales[i].max())
            inside = place < bounds[e][:, None]
            held = self.has_feature[i[:, None], f[np.minimum(place, len(f) - 1)]] & inside
            for k in np.flatnonzero(held.sum(axis=1) >= share * self.sizes[i]):
                yield int(i[k]), int(text[b[k]]), int(bounds[b[k]]), int(bounds[e[k]]), float(near[at + k])

    def lcs(self, item: int, words: list[int]) -> int:
        """Length of the longest common subsequence with an item, bit-parallel."""
        mask, full = self.masks[item], (1 << len(self.words[item])) - 1
        row = full
        for w in words:
            m = mask.get(w)
            if m:
                u = row & m
                row = ((row + u) | (row - u)) & full
        return len(self.words[item]) - row.bit_count()

    def has_answer(self, item: int, words: list[int]) -> bool:
        answer = self.answers[item]
        n = len(answer)
        return any(words[i:i + n] == answer for i, w in enumerate(words) if w == answer[0])


def _search(items: Items, cosine: float, lcs: float, weak_lcs: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in bounded_slices(whole, "body") if whole.num_rows else ():
                words, first = _words(batch.column("body"))
                best: dict[tuple[int, int], tuple] = {}
                for item, text, a, b, near in items.candidates(words, first, cosine, weak_lcs):
                    held = best.get((text, item))
                    window = words[a:b].tolist()
                    share = items.lcs(item, window) / len(items.words[item])
                    if held and held[0] >= share:
                        continue
                    answer = share >= weak_lcs and items.has_answer(item, window)
                    if share >= lcs or answer:
                        best[text, item] = (share, near, answer)
                found = sorted(best.items())
                yield pa.record_batch([
                    batch.column("doc_id").take(pa.array([k[0] for k, _ in found], pa.int64())),
                    pa.array([items.ids[k[1]] for k, _ in found], pa.int64()),
                    pa.array([v[1] for _, v in found], pa.float64()), pa.array([v[0] for _, v in found], pa.float64()),
                    pa.array([v[2] for _, v in found], pa.bool_())],
                    ["doc_id", "item_id", "cosine", "lcs", "answer"])
    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, rank: int = 48, cosine: float = 0.35, lcs: float = 0.8,
               weak_lcs: float = 0.6, answer_words: int = 5, item_block: int = 20_000, seed: int = 3,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, item_id, cosine, lcs, answer of every document that holds an item."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, cosine double, lcs double, answer boolean"
    body = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("body"))
    none = spark.createDataFrame([], schema)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null")
    n_items = items.count()
    idf = feature_weights(body.select("body")) if n_items else None
    projection = None if idf is None else latent_projection(body.select("body"), idf, rank, seed)
    if idf is None:
        return none
    if projection is None:  # no word tells passages apart: seeds alone
        projection = np.zeros((DIMS, 1), np.float32)
    blocks = -(-n_items // item_block)
    out = none
    for k in range(blocks):  # one search per block of items
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        ready = Items(rows, projection, answer_words)
        if ready.ids:
            out = out.unionByName(body.mapInArrow(_search(ready, cosine, lcs, weak_lcs), schema))
    return out


def remove_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without those that hold a benchmark item."""
    leaks = materialize(find_leaks(docs, benchmark, **options).select(F.col("doc_id").alias("_leak")).distinct(),
                        "benchmark-leaks", few=True)
    rows = packed(docs, _id=F.col(options.get("id_col", "doc_id")).cast("long"))
    return unpacked(rows.join(leaks, F.col("_id").eqNullSafe(F.col("_leak")), "left_anti"), docs.columns)
