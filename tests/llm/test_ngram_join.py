"""N-gram Jaccard join against all pairs."""

import random
import re

import pytest

from strata.llm.ngram_join import keep_one, link_groups

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, n, num, den):
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    sets = []
    for _, t in rows:
        w = WORD.findall(low(t))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    comp = list(range(len(rows)))

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * both >= num * len(sets[i] | sets[j]):
                comp[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows))


def corpus(seed, count=150):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    text = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    rows = []
    for d in range(count):
        if rng.random() < 0.3 or not rows:
            t = text(rng.randint(0, 90))
        else:
            words = (rng.choice(rows[-20:])[1] or "").split(" ")
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(vocab)
            t = rng.choice([" ", "\n", "  "]).join(words)
            t = t.upper() if rng.random() < 0.2 else t
        rows.append((d * 3 + 5, t))
    rng.shuffle(rows)
    return rows + [(9001, None), (9002, ""), (9003, " \n "), (9004, "one"), (9005, "ONE"), (9006, "two words"), (9007, "é É é É")]


@pytest.mark.parametrize("seed,n,num,limit", [(1, 3, 90, 4096), (2, 5, 80, 4096), (3, 3, 60, 8), (4, 2, 80, 4)])
def test_against_all_pairs(spark, seed, n, num, limit):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = link_groups(df, n, num, 100, group_limit=limit, bucket_entries=500).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, n, num, 100)


def test_edge_rows(spark):
    text = " ".join(f"t{i}" for i in range(30))
    rows = [(None, text, 1), (4, text, 1), (4, text, 1), (6, text + " more", 2), (7, "", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, rep int")
    got = sorted(((r.doc_id, r.component_id) for r in link_groups(df, 3, 90, 100).collect()), key=str)
    assert got == sorted([(None, None), (4, None), (4, None), (6, None), (7, 7)], key=str)
    kept = sorted((r.doc_id for r in keep_one(df).collect()), key=str)
    assert kept == [7, None]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert link_groups(df).collect() == []
