"""Spelling variant grouping with a trie-node pair dictionary.

The words' prefixes are the nodes of a forward trie and their suffixes the nodes of a
reversed one; every node gets a whole number.  A word is then, at each position, a pair
of numbers (prefix node, suffix node):

* skipping one letter: the node before it and the node after it;
* splitting between two letters: the nodes that meet there.

Two words differ by one replaced letter exactly if they share a skipped pair, and by one
inserted or deleted letter exactly if a skipped pair of the longer is a split pair of the
shorter.  Pairs of numbers brought together are therefore exact neighbours, with no
candidate left to verify.  In a run of equal letters only the last is skipped for
deletions, so that every two neighbours meet once.

Numbering: words lie in ranges of their order (of their reversed spelling for the
suffixes).  A task goes through its sorted range and gives a number to every prefix that
the word before does not have; prefixes of a range's last word are named by range and
depth, so that the next ranges name them alike, knowing only each range's last word.
Numbers are exact: no hash is involved.

Sizes: a split pair spells one word, so it is one row; a skipped pair is shared by at most
as many words as the alphabet has letters (90).  No group grows with the corpus, so nothing
is split or capped.  Texts are read once and tokens counted with partial sums; all the
rest runs on distinct words.

Defined cases: a null text has no words; a null doc_id is empty in ``<doc_id>:``; repeated
rows count each time; a word of any length is one row until its positions are listed; ties
between forms go to the first in code-point order; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialize
from strata.operators.ranges import RANGE, into_ranges

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PLACE = 40  # a number is range * 2**40 + place in the range


def letter_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc``, ``word``: every run of letters with A-Z lower-cased, one row each."""
    runs = F.regexp_extract_all(F.translate(F.col(f"`{text_col}`"), UPPER, LOWER), F.lit(RUN), F.lit(0))
    return docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("doc"), F.explode(runs).alias("word"))


def drop_letters(runs: DataFrame, every: int = 97) -> DataFrame:
    """Runs with one code point deleted where ``every`` divides the checksum of
    ``<doc>:<word>``: deterministic misspellings."""
    hashed = runs.withColumn("_h", F.crc32(F.concat("doc", F.lit(":"), "word").cast("binary")))
    at = (F.col("_h") % F.length("word")).cast("int")
    cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    return hashed.withColumn("word", F.when(F.col("_h") % every == 0, cut).otherwise(F.col("word"))).drop("_h")


def count_words(runs: DataFrame, min_letters: int = 5, min_count: int = 3) -> DataFrame:
    """Distinct words of at least ``min_letters`` that occur ``min_count`` times: word, n."""
    return (runs.filter(F.length("word") >= min_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= min_count))


# -- trie nodes --------------------------------------------------------------------------

def common_prefix(a: str, b: str) -> int:
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return i
    return min(len(a), len(b))


def boundary_name(at: int, depth: int) -> int:
    """Number of the node at ``depth`` on the path of range ``at``'s last word."""
    return -((at << PLACE) + depth) - 1


def _numbering(lasts: list[tuple[int, str]], spelled: str):
    """Task for one range: rows with their number in order and the numbers of all nodes on
    their path (depth 0 to the word's length)."""
    def run(table: pa.Table) -> pa.Table:
        at = table.column(RANGE)[0].as_py()
        order = np.array(sorted(range(table.num_rows), key=table.column(spelled).to_pylist().__getitem__))
        table = table.take(pa.array(order))
        words = table.column(spelled).to_pylist()
        # nodes that began in earlier ranges: the earliest last word that has the prefix names them
        path, before, end = [], None, words[-1]
        for other, last in lasts:
            if other < at:
                shared = common_prefix(last, words[0])
                path += [boundary_name(other, d) for d in range(len(path), shared + 1)]
        paths, fresh = [], at << PLACE
        for word in words:
            if before is not None:
                del path[common_prefix(before, word) + 1:]
            shared = common_prefix(word, end)
            while len(path) <= len(word):
                depth = len(path)
                if depth <= shared:
                    path.append(boundary_name(at, depth))
                else:
                    fresh += 1
                    path.append(fresh)
            paths.append(list(path))
            before = word
        numbers = pa.array((at << PLACE) + np.arange(len(words)), pa.int64())
        return pa.table({**{c: table.column(c) for c in table.column_names if c not in (RANGE, spelled)},
                         "number": numbers, spelled: table.column(spelled), "path": pa.array(paths, pa.list_(pa.int64()))})
    return run


def number_nodes(words: DataFrame, spelled: str) -> DataFrame:
    """``words`` (distinct in ``spelled``) plus ``number``, which follows the code-point order
    of ``spelled``, and ``path``, the numbers of the trie nodes of all its prefixes."""
    held = into_ranges(words, [spelled], "spelling-ranges")
    # one word per range
    lasts = [(r[RANGE], r["last"]) for r in held.groupBy(RANGE).agg(F.max(spelled).alias("last")).orderBy(RANGE).collect()]
    rest = [f for f in words.schema.fields if f.name != spelled]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rest], "number long", f"{spelled} string", "path array<long>"])
    return held.select(*[f.name for f in rest], RANGE, spelled).groupBy(RANGE).applyInArrow(
        _numbering(lasts, spelled), schema)


# -- neighbours --------------------------------------------------------------------------

def pair_dictionary(words: DataFrame) -> DataFrame:
    """One row per word and pair of nodes: ``p``, ``s``, the word's ``number`` and ``n``, and
    ``kind``: 0 split, 1 skipped, 2 skipped as the last of a run of equal letters.

    ``words`` holds number, n, word and the paths ``forward`` and ``backward``.
    """
    last = F.expr("""zip_with(split(word, ''), slice(split(word, ''), 2, length(word)), (x, y) -> IF(x <=> y, 1, 2))""")
    skipped = F.expr("""
      zip_with(zip_with(slice(forward, 1, length(word)), reverse(slice(backward, 1, length(word))), (p, s) -> struct(p, s)),
               last_of_run, (x, kind) -> struct(x.p AS p, x.s AS s, kind AS kind))""")
    split = F.zip_with("forward", F.reverse("backward"), lambda p, s: F.struct(p.alias("p"), s.alias("s"), F.lit(0).alias("kind")))
    return (words.filter(F.length("word") > 0).withColumn("last_of_run", last)
            .select("number", "n", F.inline(F.concat(skipped, split))))


def neighbours(pairs: DataFrame) -> DataFrame:
    """Every two words one letter apart, both ways: number, n, near, near_n."""
    who = F.struct("number", "n", "kind")
    met = pairs.groupBy("p", "s").agg(F.collect_list(who).alias("met")).filter(F.size("met") > 1)
    # two skipped: a replaced letter; one skipped (last of its run) and one split: a letter more
    return (met.select(F.explode("met").alias("a"), "met").select("a", F.explode("met").alias("b"))
            .filter((F.col("a.number") != F.col("b.number"))
                    & (((F.col("a.kind") > 0) & (F.col("b.kind") > 0)) | ((F.col("a.kind") + F.col("b.kind")) == 2)))
            .select(F.col("a.number").alias("number"), F.col("a.n").alias("n"),
                    F.col("b.number").alias("near"), F.col("b.n").alias("near_n")))


def roots(forms: DataFrame) -> DataFrame:
    """``number``, ``root`` for every ``number`` with a ``form``: the end of its chain.

    Counts at least double along a chain, so it is short; pointers are doubled until none
    moves.
    """
    step = forms.select("number", F.col("form").alias("root"))
    while True:
        ahead = step.select(F.col("number").alias("root"), F.col("root").alias("_next"))
        moved = materialize(step.join(ahead, "root", "left").select(
            "number", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "spelling-roots")
        step = moved.select("number", "root")
        if moved.filter("moved").isEmpty():
            return step


def group_variants(counted: DataFrame, ratio: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``counted`` (word distinct, n).

    ``form`` is the near word with the largest count (ties: first in code-point order), if
    that is at least ``ratio`` times the word's own; ``root`` the last of the chain of forms.
    """
    forward = materialize(number_nodes(counted, "word").withColumnRenamed("path", "forward"), "spelling-forward")
    back = number_nodes(forward.select(F.col("number").alias("of"), F.reverse("word").alias("drow")), "drow")
    both = forward.join(back.select(F.col("of").alias("number"), F.col("path").alias("backward")), "number")
    # numbers follow code-point order, so the smaller number wins a tie
    best = materialize(neighbours(pair_dictionary(both)).groupBy("number").agg(
        F.count(F.lit(1)).alias("n_near"), F.max(F.struct("near_n", (-F.col("near")).alias("less"))).alias("best")), "spelling-near")
    words = forward.select("number", "word", "n")
    told = words.join(best, "number", "left").withColumn("takes", F.col("best.near_n") >= ratio * F.col("n"))
    forms = materialize(told.filter("takes").select("number", (-F.col("best.less")).alias("form"),
                                                    F.col("best.near_n").alias("form_n")), "spelling-forms")
    named = lambda c: words.select(F.col("number").alias(c), F.col("word").alias(f"{c}_word"))
    chain = forms.join(roots(forms), "number").join(named("form"), "form").join(named("root"), "root")
    return (words.join(best.select("number", "n_near"), "number", "left")
            .join(chain.select("number", "form_word", "root_word", "form_n"), "number", "left")
            .select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))
