"""Benchmark items that many passages hold."""

import random

import pytest

from strata.llm import decontam


@pytest.mark.parametrize("every,size", [(10, 18), (3, 18), (10, 30), (3, 40)])
def test_popular_items_are_found(spark, every, size):
    rng = random.Random(every * size)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(4000)]
    text = lambda k: [rng.choice(vocab) for _ in range(k)]
    items = [(i, " ".join(text(size))) for i in range(20)]
    rows, truth = [], set()
    for d in range(1500):
        words = text(rng.randint(60, 300))
        if d % every == 0:
            at = rng.randint(0, len(words))
            words[at:at] = items[7][1].split()
            truth.add((d, 7))
        rows.append((d, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, bench).collect()}
    assert got == truth


def test_item_of_words_in_every_passage_is_found(spark):
    docs = spark.createDataFrame([(1, "one two three four"), (2, "one two three four")], "doc_id long, text string")
    bench = spark.createDataFrame([(5, "one two three four")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, bench).collect()} == {(1, 5), (2, 5)}
