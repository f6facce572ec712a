"""The pipeline end to end on an empty and on an odd table."""

import random
import re

import pytest

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, copy string, _text string"
WORDS = {"en": "the house was near old river and people walked slowly along quiet streets while children played games".split(),
         "de": "das haus war nahe am alten fluss und leute gingen langsam durch stille straßen während kinder spiele spielten".split(),
         "fr": "la maison était près de la vieille rivière et les gens marchaient lentement dans les rues calmes avec enfants".split(),
         "es": "la casa estaba cerca del viejo río y la gente caminaba despacio por calles tranquilas mientras los niños jugaban".split()}
ITEM = "which of these seventeen planets orbits the binary star kepler sixteen in roughly two hundred twenty nine days exactly"


def prose(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", f"{rng.randint(0, 999)}"]) for _ in range(n))


def write(spark, folder, docs, items):
    spark.createDataFrame(docs, SCHEMA).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


@pytest.fixture(scope="module")
def outcome(spark, tmp_path_factory):
    rng = random.Random(1)
    folder = str(tmp_path_factory.mktemp("odd"))
    docs = []
    for i in range(120):
        lang = ("en", "de", "fr", "es")[i % 4]
        docs.append((i, prose(rng, lang, 60), lang, f"s{i % 3}", None, "c", "t"))
    copied = docs[8][1]
    docs += [(200, copied, "en", "s1", 1, None, None), (201, copied + " end", "en", "s2", 1, None, None), docs[8],
             (210, prose(rng, "en", 50) + " " + ITEM + " " + prose(rng, "en", 20), "en", "s0", 3, "", ""),
             (220, "write to Mrs. Clara Foster, clara.foster@mail.example; " + prose(rng, "en", 60), "en", None, 4, None, None),
             (230, None, "en", "s1", None, None, None), (231, "", "en", "s1", 0, None, None), (232, "12 34 !!", None, "s1", 8, None, None),
             (None, prose(rng, "de", 70), "de", None, None, None, None),
             (240, prose(rng, "fr", 30_000), "fr", "s2", None, None, None)]
    write(spark, folder, docs, [(1, ITEM), (2, None), (3, ""), (1, ITEM)])
    return docs, [r.asDict() for r in corpus_pipeline.run(spark, folder).collect()]


def test_columns_and_what_goes(outcome):
    docs, rows = outcome
    ids = {r["doc_id"] for r in rows}
    assert set(rows[0]) >= {"doc_id", "text", "lang", "source", "n_chars", "copy", "_text"}
    assert not ids & {230, 231, 232}, "texts without a language"
    assert 210 not in ids, "a benchmark item"
    assert not ids & {200, 201}, "near copies of a document with a smaller id"
    assert all(r["text"] for r in rows)


def test_what_stays(outcome):
    """Clean documents leave the stages before the mixing as they came."""
    docs, rows = outcome
    texts = {d: t for d, t, *_ in docs}
    kept = [r for r in rows if r["doc_id"] != 220]
    assert all(r["text"] == texts[r["doc_id"]] for r in kept)
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_personal_data_is_replaced(outcome):
    _, rows = outcome
    for r in rows:
        assert "Foster" not in r["text"] and "clara" not in r["text"].lower()
        if r["doc_id"] == 220:
            assert re.match(r"write to Mrs\. \S+ \S+, \S+@\S+\.example; ", r["text"])


def test_no_document_is_repeated_beyond_twice(outcome):
    """The mix takes at most two times a document's words."""
    _, rows = outcome
    seen = {}
    for r in rows:
        seen[r["doc_id"], r["text"]] = seen.get((r["doc_id"], r["text"]), 0) + 1
    assert max(seen.values()) <= 2


def test_empty_tables(spark, tmp_path):
    write(spark, str(tmp_path), [], [])
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.collect() == [] and "text" in out.columns
