"""Suffix-array dedup by prefix-free parsing.

Removes every byte covered by a ``length``-byte string that also starts
earlier in the corpus (smaller doc_id, or the same document further left);
strings are judged on the input and never cross documents.

Rolling-hash triggers cut the texts into phrases that overlap by
``length - 1`` bytes (see :mod:`strata.llm.repeats`); the distinct phrases are
the dictionary, the (doc_id, start) order of their occurrences is the parse.
The suffix array of each bucket's dictionary brings equal strings together,
and the parse tells which of them comes first in corpus order.  Dictionary
and parse are only built for phrases whose trigger occurs twice, so texts that
repeat nothing cost one pass and 16 bytes per phrase.

Defined cases: null or empty text has no bytes; null doc_id sorts first; rows
that share a doc_id are one document and compare by start alone, so exact
repeats of a row give equal results and cover nothing of each other; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.repeats import NULL_ID, SeenEarlier, byte_tokens, without_repeats

SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _digest(docs, tokens, removed, ids, keep_text: bool = False):
    off = tokens.offsets
    done = np.concatenate([[0], np.cumsum(removed)])
    edge = removed.copy()
    edge[1:] &= ~removed[:-1]
    first = off[:-1][off[:-1] < off[1:]]
    edge[first] = removed[first]  # a span does not cross documents
    edges = np.concatenate([[0], np.cumsum(edge)])
    kept = [tokens.raw[a:b][~removed[a:b]].tobytes() if done[b] > done[a] else tokens.raw[a:b].tobytes()
            for a, b in zip(off[:-1], off[1:])]
    out = {"doc_id": ids, "n_bytes": np.diff(off), "n_removed": done[off[1:]] - done[off[:-1]],
           "n_spans": edges[off[1:]] - edges[off[:-1]],
           "kept_sha256": np.array([hashlib.sha256(k).hexdigest() for k in kept], object)}
    if keep_text:
        out["kept"] = np.array(kept, object)
    return out


def remove_repeated_bytes(docs: DataFrame, length: int = 100, gram: int = 37, keep_text: bool = False,
                          id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document, and the
    remaining bytes (``kept``) on request.

    ``length - gram`` must be below 64.
    """
    def digest(*block):
        return _digest(*block, keep_text=keep_text)

    body = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("body"))
    out = without_repeats(body, byte_tokens, np.uint8, length, gram, SeenEarlier(), digest,
                          SCHEMA + ", kept binary" * keep_text, **options)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")))
