"""Substring dedup by prefix-partitioned suffix subtrees, over words.

Removes every word covered by a window of ``length`` words whose word sequence
also starts anywhere else in the corpus, the same document included; windows
are judged on the input.

Suffixes are split by a prefix of variable length: the words of a suffix up to
the end of its trigger gram, the gram of least hash among its first ``length``
words (see :mod:`strata.llm.repeats`).  Equal windows have equal prefixes, so
each prefix's suffixes form a subtree of their own; prefixes are dealt to
buckets of bounded size by their last gram, and one with too many suffixes is
split on by the hash of the whole window.  In a bucket the subtree's leaves are
sorted and their common prefixes compared; internal nodes at least ``length``
words deep are the repeats that get removed.

Defined cases: null or empty text has no words; repeated rows repeat each
other's windows; null doc_ids are documents like others; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.repeats import (IS_SPACE, NULL_ID, SeenAnywhere, arrow_bytes, spans_index, without_repeats,
                                word_bounds, word_tokens)

SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _make(column):
    return word_tokens(*arrow_bytes(column))[0]


def _digest(docs, tokens, removed, ids, keep_text: bool = False):
    data, offsets = arrow_bytes(docs.column("body"))
    starts, ends, first = word_bounds(data, offsets)
    # kept words with the white space byte that follows each, if any, made a blank
    limit = np.repeat(offsets[1:], np.diff(first))
    stay = np.flatnonzero(~removed)
    size = np.minimum(ends + 1, limit) - starts
    at = spans_index(starts[stay], size[stay])
    flat = data[at]
    flat[IS_SPACE[flat]] = 32
    filled = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(np.where(removed, 0, size), out=filled[1:])
    done = np.concatenate([[0], np.cumsum(removed)])
    cut = filled[first]
    kept = [flat[a:b].tobytes().rstrip(b" ") for a, b in zip(cut[:-1], cut[1:])]
    out = {"doc_id": ids, "n_words": np.diff(first), "n_removed": done[first[1:]] - done[first[:-1]],
           "kept_sha256": np.array([hashlib.sha256(k).hexdigest() for k in kept], object)}
    if keep_text:
        out["kept"] = np.array(kept, object)
    return out


def remove_repeated_words(docs: DataFrame, length: int = 35, gram: int = 8, keep_text: bool = False,
                          id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document, and the kept words
    joined by one space (``kept``) on request."""
    def digest(*block):
        return _digest(*block, keep_text=keep_text)

    body = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("body"))
    out = without_repeats(body, _make, np.uint64, length, gram, SeenAnywhere(), digest,
                          SCHEMA + ", kept binary" * keep_text, **options)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")))
