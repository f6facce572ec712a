"""Spelling variants against plain Python."""

import random
import re
import zlib

import pytest

from strata.llm import spelling
from strata.llm.spelling import count_words, drop_letters, group_variants, letter_runs, number_nodes


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts):
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    form = {}
    for w in counts:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted((w, form[w] or "", root(w), counts[w], len(near[w]), counts[form[w]] if form[w] else 0) for w in counts)


def grouped(spark, counts):
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in group_variants(df).collect())


@pytest.mark.parametrize("seed,alphabet", [(1, "ab"), (2, "abé"), (3, "abcÀÿ")])
def test_groups_against_brute_force(spark, seed, alphabet):
    rng = random.Random(seed)
    counts = {}
    for _ in range(250):
        w = "".join(rng.choice(alphabet) for _ in range(rng.randint(5, 8)))
        counts[w] = rng.choice([3, 3, 4, 7, 20, 60])
    assert grouped(spark, counts) == brute(counts)


def test_runs_of_equal_letters_meet_once(spark):
    counts = {"aaaaa": 3, "aaaaaa": 10, "aaaaaaa": 30, "aabaa": 5, "abbbba": 4, "abbbbba": 9}
    assert grouped(spark, counts) == brute(counts)


def test_chains_ties_and_a_long_word(spark):
    long = "xy" * 30_000
    counts = {"chainaaa": 3, "chainaab": 6, "chainabb": 12, "chainbbb": 24, "tiedword": 3, "tiedwora": 9, "tiedworb": 9,
              long: 5, long + "z": 20, "lonely": 3}
    assert grouped(spark, counts) == brute(counts)


def test_nodes_have_one_number_over_all_ranges(spark):
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(400)})
    rows = number_nodes(spark.createDataFrame([(w,) for w in words], "word string").repartition(4), "word").collect()
    names = {}
    for r in rows:
        for d, number in enumerate(r["path"]):
            names.setdefault(r["word"][:d], set()).add(number)
    assert all(len(v) == 1 for v in names.values())
    assert len({next(iter(v)) for v in names.values()}) == len(names)
    assert [r["word"] for r in sorted(rows, key=lambda r: r["number"])] == words


def test_words_of_texts(spark):
    """Counting, lower-casing and the dropped letters, against plain Python."""
    rng = random.Random(9)
    vocab = ["Straße", "ÀÉÎõ", "garden", "Garden", "house", "houses", "x1yellow", "naïve", "日本garden"]
    docs = [(rng.choice([None, 3, i]), rng.choice([None, "", " ".join(rng.choices(vocab, k=30))])) for i in range(200)]
    docs += docs[:10] + [(77, "abcde " * 5000)]
    want = {}
    for d, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                want[run] = want.get(run, 0) + 1
    runs = letter_runs(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    got = {r["word"]: r["n"] for r in count_words(drop_letters(runs)).collect()}
    assert got == {w: n for w, n in want.items() if n >= 3}


def test_empty_table_and_odd_columns(spark):
    none = letter_runs(spark.createDataFrame([], "doc_id long, text string"))
    assert group_variants(count_words(drop_letters(none))).collect() == []
    odd = spark.createDataFrame([(1, "wordy wordy wordy", "a", 2)], "doc_id long, text string, word string, n long")
    assert [r["word"] for r in group_variants(count_words(letter_runs(odd))).collect()] == ["wordy"]


def test_common_prefix():
    assert [spelling.common_prefix(*p) for p in (("ab", "ac"), ("", "x"), ("ab", "abc"), ("é", "é"))] == [1, 0, 2, 1]
