"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Every rule rejects a document when one of its ratios is above a cutoff.  The
cutoffs are not set by hand: for each stratum (language), rule and grid value,
the documents labelled good tell how often that cutoff would reject wrongly.
A cutoff is admitted if the exact binomial test refutes, at level
``delta / number of tests`` (Bonferroni over all strata, rules and grid
values), that its false rejection rate exceeds ``alpha / number of rules``.  So
with probability 1 - ``delta`` all admitted cutoffs together reject at most
``alpha`` of a stratum's good documents.  Of the admitted ones the rule takes
the cutoff that rejects most documents labelled bad, the loosest on ties; a
rule without one that rejects any rejects nothing in that stratum.

The binomial tail is a SQL aggregate in logarithms, on one row per stratum,
rule and grid value.  Counts of a text are array work inside its row; texts are
read once and never shuffled.

Defined cases: null text has no words and fails the base rules; a null stratum
is one of its own; labels that contradict each other count as bad, repeated
ones once; without labels only the base rules reject; an empty table gives an
empty result; repeated rows are judged alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import WORD, materialize, packed, unpacked

GRID = (0.0, 0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.75)
RULES = ("symbol_ratio", "dup_line_ratio", "repeat_ratio")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
ALPHA = 0.02
DELTA = 0.05
PLACE_BITS = 24


def measure(docs: DataFrame, text_col: str = "text", place_bits: int = PLACE_BITS) -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    Repeated 3-word windows: a window is packed to one long, the high bits of
    its hash and its place, and the longs are sorted, so equal windows are
    neighbours.  Should windows that share the hash bits differ in their
    words, or a text have more places than fit, the windows are sorted as
    strings.
    """
    text = F.col("_text")
    place = F.lit((1 << place_bits) - 1).cast("long")
    longs = F.array().cast("array<long>")
    word = lambda i: F.get(F.col("_words"), i)
    window = lambda i: F.concat_ws(" ", word(i), word(i + 1), word(i + 2))
    high = lambda x: F.shiftrightunsigned(x, place_bits)
    at = lambda x: x.bitwiseAND(place).cast("int")

    def alike(items: str, k: Column, other: Column) -> Column:
        return F.coalesce(high(F.get(F.col(items), k)) == high(F.get(F.col(items), other)), F.lit(False))

    df = packed(docs, _text=F.coalesce(F.col(text_col), F.lit(""))).withColumns({
        "_words": F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
        "_lines": F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)),
        "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))).cast("long")})
    df = df.withColumns({
        "n_words": F.size("_words").cast("long"), "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_hashes": F.transform("_words", lambda w: F.xxhash64(w))})
    small = (F.col("n_words") >= 3) & (F.col("n_words") < (1 << place_bits))
    keyed = F.transform(
        F.sequence(F.lit(0), F.size("_words") - 3),
        lambda i: F.xxhash64(F.get("_hashes", i), F.get("_hashes", i + 1), F.get("_hashes", i + 2))
        .bitwiseAND(F.bitwise_not(place)).bitwiseOR(i.cast("long")))
    df = df.withColumn("_packed", F.when(small, F.sort_array(keyed)).otherwise(longs))
    df = df.withColumn("_twice", F.filter("_packed", lambda x, k: alike("_packed", k, k - 1) | alike("_packed", k, k + 1)))
    mixed = F.size(F.filter("_twice", lambda x, k: alike("_twice", k, k - 1) & (
        window(at(x)) != window(at(F.get(F.col("_twice"), k - 1)))))) > 0
    df = df.withColumn("_exact", mixed | (F.col("n_words") >= (1 << place_bits)))
    strings = F.sort_array(F.transform(F.sequence(F.lit(0), F.size("_words") - 3),
                                       lambda i: F.struct(window(i).alias("w"), i.alias("i"))))
    df = df.withColumn("_strings", F.when(F.col("_exact"), strings))
    by_string = F.transform(
        F.filter("_strings", lambda x, k: F.coalesce(x["w"] == F.get("_strings", k - 1)["w"], F.lit(False))
                 | F.coalesce(x["w"] == F.get("_strings", k + 1)["w"], F.lit(False))), lambda x: x["i"])
    places = F.sort_array(F.when(F.col("_exact"), by_string).otherwise(F.transform("_twice", at)))
    covered = F.aggregate(
        places, F.struct(F.lit(0).alias("sum"), F.lit(0).alias("upto")),
        lambda acc, p: F.struct((acc["sum"] + p + 3 - F.greatest(p, acc["upto"])).alias("sum"), (p + 3).alias("upto")),
        lambda acc: acc["sum"])
    return unpacked(df.withColumn("n_repeat_words", covered.cast("long")), docs.columns,
                    **{name: F.col(name) for name in MEASURES})


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def ratio(rule: str) -> Column:
    part, whole = {"symbol_ratio": ("n_symbols", "n_words"), "dup_line_ratio": ("n_dup_lines", "n_lines"),
                   "repeat_ratio": ("n_repeat_words", "n_words")}[rule]
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial(n, p), summed exactly in logarithms; 1 where k / n > p."""
    odds = F.lit(p / (1 - p))

    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i * odds)
        top = F.greatest(acc["sum"], term)
        return F.struct(term.alias("term"),
                        (top + F.log(F.exp(acc["sum"] - top) + F.exp(term - top))).alias("sum"))

    first = n * F.log(F.lit(1 - p))
    terms = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>"))
    tail = F.exp(F.aggregate(terms, F.struct(first.alias("term"), first.alias("sum")), step, lambda acc: acc["sum"]))
    return F.when(k > n * p, F.lit(1.0)).otherwise(tail)


def admitted_cutoffs(measured: DataFrame, labels: DataFrame, stratum: str, alpha: float = ALPHA, delta: float = DELTA,
                     rules=RULES, grid=GRID) -> DataFrame:
    """One row per stratum: ``stratum`` and a cutoff (or null) for each rule.

    A trial is a distinct labelled document: rows repeated with one id and equal measures
    count once, so that the binomial bound holds.
    """
    good = labels.groupBy("doc_id").agg((F.min("quality") == 1).alias("_good")).filter(F.col("_good").isNotNull())
    held = measured.filter(~base_failed()).select(F.col("doc_id").alias("_id"), F.col(stratum).alias("stratum"),
                                                  *[ratio(r).alias(r) for r in rules]).distinct()
    held = held.join(good, F.col("_id") == F.col("doc_id"))
    counts = [F.count(F.when(F.col("_good"), 1)).alias("n")]
    for j, rule in enumerate(rules):
        for i, c in enumerate(grid):
            over = F.col(rule) > c
            counts += [F.count(F.when(over & F.col("_good"), 1)).alias(f"g{j}_{i}"),
                       F.count(F.when(over & ~F.col("_good"), 1)).alias(f"b{j}_{i}")]
    per = held.groupBy("stratum").agg(*counts)
    tests = per.select("stratum", "n", F.explode(F.array(*[
        F.struct(F.lit(j).alias("rule"), F.lit(c).alias("cutoff"), F.col(f"g{j}_{i}").alias("wrong"),
                 F.col(f"b{j}_{i}").alias("caught")) for j in range(len(rules)) for i, c in enumerate(grid)])).alias("t"))
    n_strata = per.agg(F.count(F.lit(1)).alias("n_strata"))
    level = F.lit(delta) / (F.col("n_strata") * len(rules) * len(grid))
    passed = (F.col("t.caught") > 0) & (binomial_tail(F.col("t.wrong"), F.col("n"), alpha / len(rules)) <= level)
    best = tests.join(n_strata, F.lit(True)).filter(passed)
    return best.groupBy("stratum").agg(*[
        F.max(F.when(F.col("t.rule") == j, F.struct("t.caught", "t.cutoff")))["cutoff"].alias(f"cut_{rule}")
        for j, rule in enumerate(rules)])


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", text_col: str = "text", **options) -> DataFrame:
    """``docs`` (without its text) plus the measures, base_failed and kept."""
    measured = materialize(measure(docs, text_col).drop(text_col), "quality-measures")
    cuts = admitted_cutoffs(measured, labels, stratum, **options)
    cuts = cuts.select(F.col("stratum").alias("_stratum"), *[F.col(f"cut_{r}").alias(f"_cut_{r}") for r in options.get("rules", RULES)])
    joined = measured.join(cuts, F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    over = F.lit(False)
    for rule in options.get("rules", RULES):
        over = over | F.coalesce(ratio(rule) > F.col(f"_cut_{rule}"), F.lit(False))
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~over).select(
        *measured.columns, "base_failed", "kept")
