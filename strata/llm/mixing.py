"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source carries the same real copy count
``target / source size``.  Its whole part is taken outright; the fractions are
rounded by the pivotal method: two fractional units meet, probability mass
moves at random from one to the other until one of them is 0 or 1, and the
other one goes on.  Sums of probabilities are kept by every meeting, so a
source's copies (and, since only documents of similar size meet, its words)
end next to the target.

The meetings form a reduction tree.  Units are dealt to blocks of about
``block`` rows by (source, size class, hash), so a source that holds a third
of the table is many blocks; each block leaves at most one fractional unit,
``fan_in`` blocks' residuals meet on the next level, then the size classes of
a source, and the last unit of a source is rounded by its own probability.
All draws come from the seed and the block's own key, so reruns agree.

Defined cases: null text has size 0; a null source is a source of its own,
ordered last; repeated rows are units of their own; an empty table gives an
empty result; a source without words has target 0 and copies 0.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, materialize, packed, unpacked

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
EPS = 1e-9

UNIT = ("source string, cls int, blk long, doc_id long, ord long, size long, "
        "source_size long, target double, base int, p double")


def pivotal(p: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Round all but at most one of the probabilities ``p`` to 0 or 1, in order.

    ``u`` holds one uniform draw per unit.  Returns the new probabilities;
    their sum is that of ``p``.
    """
    p = np.where(p < EPS, 0.0, np.where(p > 1 - EPS, 1.0, p)).tolist()
    open_unit = -1
    for j, b in enumerate(p):
        if b in (0.0, 1.0):
            continue
        if open_unit < 0:
            open_unit = j
            continue
        i, a = open_unit, p[open_unit]
        s = a + b
        if s < 1 - EPS:
            lose, keep = (i, j) if u[j] * s < b else (j, i)
            p[lose], p[keep] = 0.0, s
        else:
            win, keep = (i, j) if u[j] * (2 - s) < 1 - b else (j, i)
            rest = max(0.0, s - 1)
            p[win], p[keep] = 1.0, 0.0 if rest < EPS else rest
        open_unit = keep if p[keep] > 0 else -1
    return np.asarray(p)


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """One row per source: source_size and target words.

    Water filling: sources in order of cap / weight; a source is capped if its
    cap is below what the sources not yet capped would share by weight.  The
    windows run over one row per source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(0))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    per = (per.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(cap))
           .withColumn("goal", F.sum("source_size").over(every) * F.lit(share))
           .withColumn("all_w", F.sum("w").over(every)))
    before = (Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    per = (per.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
           .withColumn("w_before", F.coalesce(F.sum("w").over(before), F.lit(0.0)))
           .withColumn("capped", F.col("cap") / F.col("w")
                       <= (F.col("goal") - F.col("cap_before")) / (F.col("all_w") - F.col("w_before"))))
    free_w = F.sum(F.when(~F.col("capped"), F.col("w"))).over(every)
    rest = F.col("goal") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(every), F.lit(0.0))
    return per.withColumn("target", F.when(F.col("capped"), F.col("cap")).otherwise(
        F.least("cap", F.col("w") * rest / free_w))).select("source", "source_size", "n_docs", "target")


def _meet(seed: int, level: int, last: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "doc_id", "ord"], kind="stable", na_position="first")
        head = pdf.iloc[0]
        key = repr((seed, level, head["source"], int(head["cls"]), int(head["blk"]))).encode()
        rng = np.random.Generator(np.random.Philox(int.from_bytes(hashlib.sha256(key).digest()[:8], "little")))
        p = pivotal(pdf["p"].to_numpy(dtype=float), rng.random(len(pdf)))
        if last:
            p = np.where((p > 0) & (p < 1), (rng.random(len(p)) < p).astype(float), p)
        return pdf.assign(p=p)
    return run


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = 17,
        block: int = 4096, fan_in: int = 64, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """Copies of every document: doc_id, ord, source, size, source_size, target, copies, taken.

    ``ord`` numbers the rows that share a doc_id (by text, then source).
    """
    same = Window.partitionBy("doc_id").orderBy("size", "h", "source")
    sized = materialize(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                    F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                    F.xxhash64(F.col(text_col)).alias("h"))
        .withColumn("ord", F.row_number().over(same).cast("long")).drop("h"), "mix-sizes", few=True)
    targets = source_targets(sized, weights, share, cap)
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(copies + F.lit(EPS))
    cls = F.when(F.col("size") > 0, F.floor(F.log2(F.col("size").cast("double")) * 4)).otherwise(F.lit(-1)).cast("int")
    sized = sized.withColumn("cls", cls)
    blocks = sized.groupBy("source", "cls").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("long").alias("n_blk"))
    units = (sized.alias("d")
             .join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
             .join(blocks.alias("b"), F.col("d.source").eqNullSafe(F.col("b.source")) & (F.col("d.cls") == F.col("b.cls")))
             .select("d.source", "d.cls",
                     F.pmod(F.xxhash64(F.lit(seed), "d.doc_id", "d.ord"), F.col("n_blk")).alias("blk"),
                     "d.doc_id", "d.ord", "d.size", "t.source_size", "t.target",
                     whole.cast("int").alias("base"),
                     F.greatest(F.lit(0.0), copies - whole).alias("p")))
    widest = blocks.agg(F.max("n_blk")).first()[0] or 1
    settled, level = [], 0
    while True:
        done = materialize(units.groupBy("source", "cls", "blk")
                           .applyInPandas(_meet(seed, level, False), UNIT), f"mix-level{level}", few=True)
        is_open = (F.col("p") > 0) & (F.col("p") < 1)
        settled.append(done.filter(~is_open))
        units, level = done.filter(is_open), level + 1
        if widest <= 1:
            break
        widest = -(-widest // fan_in)
        units = units.withColumn("blk", F.floor(F.col("blk") / fan_in).cast("long"))
    # at most one unit per size class is left in each source
    units = units.withColumns({"cls": F.lit(0), "blk": F.lit(0).cast("long")})
    settled.append(units.groupBy("source", "cls", "blk").applyInPandas(_meet(seed, level, True), UNIT))
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    copies = (F.col("base") + F.col("p").cast("int")).cast("int")
    return out.select("doc_id", "ord", "source", "size", "source_size", "target",
                      copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it (column ``copy``, from 1)."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    same = Window.partitionBy("_key").orderBy("_size", "_h", "_source")
    rows = (packed(docs, _key=key, _size=size, _h=F.xxhash64(F.col("text")), _source=F.col("source").cast("string"))
            .withColumn("_ord", F.row_number().over(same).cast("long")))
    taken = mix(docs, **options).filter("copies > 0").select(
        key.alias("_key2"), F.col("ord").alias("_ord2"), F.col("copies").alias("_copies"))
    # joined by the window's own key, the place compared beside it: texts move once
    joined = rows.join(taken, (F.col("_key") == F.col("_key2")) & (F.col("_ord") - F.col("_ord2") == 0))
    return unpacked(joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))), docs.columns,
                    copy=F.col("_copy"))
