"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Base patterns find key assignments, access keys and long hex strings in every
whole text.  Added to them are *bare* credentials: long tokens of letters and
digits outside the base spans.  All candidates' hashes are counted over the
corpus by distinct repositories and distinct owners; a value that many owners
have is a copied example, one that few owners have and that looks random is
live.  Base spans always stay (their verdict is reported); a bare token is
only kept when it is live.

Counting goes by (hash, owner, repository), then (hash, owner), then hash, each
with partial sums, so a value in every document is no hot key.  Texts are read
once; only candidates are shuffled.  Spans of one text are compared in one sorted
pass, so a text of many spans takes time in proportion.

Defined cases: null text is empty; a null owner or repository is one of its
own; rows repeated with one id and text count once and get equal results; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import materialize
from strata.llm.spans import with_matches

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
BARE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_=-]*[0-9])(?=[A-Za-z0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])"
KINDS = ("assign", "access", "hex", "bare")


def _of_kind(kind: int):
    return lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                              s["value"].alias("value"))


def with_candidates(df: DataFrame, text: str) -> DataFrame:
    """``df`` plus ``found``: all candidate spans of column ``text`` as an array of
    (kind number, start, end, value)."""
    body = F.col(text)
    # each test holds for every text with a match, and is much cheaper than one
    tests = (body.contains("=") | body.contains(":"), body.contains("AKIA"), body.rlike("[0-9a-f]{24}"),
             body.rlike("[A-Za-z0-9+/_=-]{20}"))
    parts = []
    for kind, (pattern, group) in enumerate(((ASSIGN, 2), (ACCESS, 0), (HEX, 0), (BARE, 0))):
        name = f"_{KINDS[kind]}"
        df = with_matches(df, name, text, pattern, group, tests[kind])
        kept = F.filter(name, lambda s: F.length(s["value"]) >= 6) if kind == 0 else F.col(name)
        parts.append(F.transform(kept, _of_kind(kind)))
    return df.withColumn("found", F.concat(*parts)).drop(*[f"_{k}" for k in KINDS])


def looks_random(value: Column) -> Column:
    """Long enough, with digits and letters, and of many different characters."""
    return (F.length(value) >= 16) & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (
        F.size(F.array_distinct(F.split(value, ""))) >= 8)


def ownership(found: DataFrame) -> DataFrame:
    """``found`` (hash, owner, repo) to hash, n_owners, n_repos, distinct counts."""
    pairs = found.groupBy("hash", "owner", "repo").agg(F.lit(1).alias("one"))
    owners = pairs.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repos"))
    return owners.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("repos").alias("n_repos"))


def scan(docs: DataFrame, max_owners: int = 2, max_repos: int = 20, id_col: str = "doc_id", text_col: str = "text",
         owner_col: str = "source", repo_col: str = "doc_id") -> DataFrame:
    """doc_id, ``spans`` array<struct<kind, start, end, live, n_owners, n_repos>> of every row.

    A value is live if it looks random, and at most ``max_owners`` owners and
    ``max_repos`` repositories have it.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(owner_col).alias("owner"), F.col(repo_col).alias("repo"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    rows = materialize(with_candidates(rows, "body").select(
        "doc_id", F.xxhash64("body").alias("h"), "owner", "repo", "found"), "secret-candidates")
    each = rows.filter(F.size("found") > 0).select("doc_id", "h", "owner", "repo", F.explode("found").alias("s"))
    # a bare token inside a base span is that span: of all base spans that start before the
    # token ends, the one that reaches furthest must end before it starts
    is_base = F.col("s.kind") < 3
    upto = (Window.partitionBy("doc_id", "h").orderBy(F.when(is_base, F.col("s.start")).otherwise(F.col("s.end") - 1), "s.kind")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    each = each.withColumn("reach", F.max(F.when(is_base, F.col("s.end"))).over(upto))
    each = each.filter(is_base | F.col("reach").isNull() | (F.col("reach") <= F.col("s.start"))).drop("reach")
    each = each.withColumn("hash", F.sha2(F.col("s.value"), 256))
    owners = ownership(each)
    live = looks_random(F.col("s.value")) & (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos)
    judged = (each.join(owners, "hash").withColumn("live", live).filter((F.col("s.kind") < 3) | F.col("live"))
              .groupBy("doc_id", "h").agg(F.array_sort(F.collect_set(F.struct(
                  F.col("s.start").alias("start"), F.col("s.kind").alias("kind"), F.col("s.end").alias("end"),
                  "live", "n_owners", "n_repos"))).alias("spans"))
              .select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"), "spans"))
    none = F.array().cast(judged.schema["spans"].dataType)
    return (rows.select("doc_id", "h")
            .join(judged, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left")
            .select("doc_id", F.coalesce("spans", none).alias("spans")))


def span_list(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the order of the array."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])))
