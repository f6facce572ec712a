"""Language identification, mixing, chat formatting, decontamination, pipeline."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from strata.llm import chat, decontam, langid, mixing
from strata.llm.common import materialize, read

SF = "/root/testdata/sf0.001"


def test_language_held_out_accuracy(spark):
    df = __spark_entry__.queries()["op2_language_id"](spark, "/root/testdata/sf0.01")
    truth = read(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang")
    rows = df.join(truth, "doc_id").filter("held_out").collect()
    right = sum(r.lang == r.lang_pred for r in rows)
    assert len(rows) > 150 and right >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edge_rows(spark):
    docs = [(i, f"the quick brown fox number {i}", "en") for i in range(30)]
    docs += [(100, None, "en"), (101, "", None), (102, "123 !!!", "en"), (103, "the fox", None), (None, "the fox", "en")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumn("score", F.lit("clash")).drop("score")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(df, F.lit(True)).collect()}
    assert got[100] == got[101] == got[102] == ("und", 0.0)
    assert got[103] == got[None] == ("en", 1.0)
    untaught = langid.identify(df.withColumn("lang", F.lit(None).cast("string")), F.lit(True)).collect()
    assert {r.lang_pred for r in untaught} == {"und"}
    assert langid.identify(df.limit(0), F.lit(True)).collect() == []


def test_long_text_scores_like_its_repetition(spark):
    docs = [(i, t, lang) for i, (t, lang) in enumerate([("der die das und ist ein", "de"), ("the and with of is", "en")] * 20)]
    docs += [(900, "the and with of is " * 100_000, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    assert {r.lang_pred for r in langid.identify(df, F.lit(True)).collect() if r.doc_id == 900} == {"en"}


def water_fill(sizes, weights, share=1.5, cap=2.0):
    goal, free, target = share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while True:
        rest = goal - sum(target[i] for i in range(len(sizes)) if i not in free)
        for i in free:
            target[i] = rest * weights[i] / sum(weights[j] for j in free)
        over = {i for i in free if target[i] > cap * sizes[i] + 1e-9}
        if not over:
            return target
        for i in over:
            target[i] = cap * sizes[i]
        free -= over


def test_mixing(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(["a", "b", "B", "ä", None, "c"] + ["hot"] * 3)) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df, block=64, fan_in=4).collect()
    assert len(got) == len(rows)
    names = sorted({r[2] for r in rows if r[2] is not None}) + [None]
    sizes = [sum(len(t.split()) for _, t, s in rows if s == n) for n in names]
    target = water_fill(sizes, [(3, 1, 2)[i % 3] for i in range(len(names))])
    for n, size, goal in zip(names, sizes, target):
        own = [r for r in got if r.source == n]
        assert own[0].source_size == size and own[0].target == pytest.approx(goal)
        assert sum(r.taken for r in own) == pytest.approx(goal, rel=0.02)
        assert all(r.taken <= 2 * r.size for r in own)
    again = {(r.doc_id, r.taken) for r in mixing.mix(df, block=64, fan_in=4).collect()}
    assert again == {(r.doc_id, r.taken) for r in got}


def test_mixing_edge_rows(spark):
    rows = [(1, None, "a"), (None, "x y", None), (2, "x y z", "a"), (2, "x y z", "a"), (3, "", "empty")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit(7))
    got = mixing.mix(df).collect()
    assert len(got) == 5 and sum(r.size for r in got) == 8
    out = mixing.mixed_documents(df).collect()
    assert len(out) == sum(r.copies for r in got)
    assert mixing.mix(df.limit(0)).collect() == []


def test_pivotal_keeps_the_sum_and_the_chances():
    rng = np.random.default_rng(0)
    p = rng.random(12)
    p *= 5 / p.sum()
    p = np.minimum(p, 0.95)
    runs = np.array([mixing.pivotal(p, rng.random(12)) for _ in range(4000)])
    assert np.allclose(runs.sum(axis=1), p.sum())
    assert (((runs > 1e-9) & (runs < 1 - 1e-9)).sum(axis=1) <= 1).all()
    assert np.abs(runs.mean(axis=0) - p).max() < 0.04


def test_chat_prefix_and_masks(spark):
    turn = "array<struct<role:string,text:string>>"
    a = [("user", "hi"), ("assistant", "é!"), ("user", None), ("assistant", "yes")]
    b = [("user", "hi"), ("assistant", "é!"), ("user", None), ("assistant", "no"), (None, "end")]
    df = spark.createDataFrame([(1, a, b), (2, a, a), (3, [], b)], f"conv_id long, chosen {turn}, rejected {turn}")
    got = {r.conv_id: r for r in chat.format_preferences(df).collect()}
    r = got[1]
    assert r.n_common == 3
    assert r.prompt == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\né!<|im_end|>\n<|im_start|>user\n<|im_end|>\n"
    assert [r.chosen_text[s.start:s.end] for s in r.chosen_mask] == ["yes<|im_end|>"]
    assert [r.rejected_text[s.start:s.end] for s in r.rejected_mask] == ["no<|im_end|>"]
    assert got[2].same and got[2].chosen_text == "" and got[3].n_common == 0 and not got[3].chosen_mask


def test_chat_pairs(spark):
    rows = [(0, 0, "user", "q"), (0, 1, "assistant", "a0"), (1, 0, "user", "p"), (1, 1, "assistant", "a1"),
            (1, 1, "assistant", "a1"), (4, 0, "user", "alone"), (None, 0, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = {r.conv_id: r for r in chat.swapped_reply_pairs(chat.gather_turns(df)).collect()}
    assert [t.text for t in got[0].rejected] == ["q", "a1"] and [t.text for t in got[1].chosen] == ["p", "a1"]
    assert [t.text for t in got[4].rejected] == ["alone", ""]
    assert chat.gather_turns(df.limit(0)).collect() == []


def test_leaks_against_brute_force(spark):
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(4000)]
    text = lambda k: [rng.choice(vocab) for _ in range(k)]
    items = [(i, " ".join(text(rng.randint(15, 60)))) for i in range(60)] + [(90, None), (91, " ")]
    rows, truth = [], set()
    for d in range(600):
        words = text(rng.randint(0, 400))
        if d % 4 == 0:
            i = rng.randrange(60)
            own = items[i][1].split()
            if d % 8 == 0:  # paraphrase: one word in twelve changed, the rest in order
                own = [rng.choice(vocab) if rng.random() < 0.08 else w for w in own]
            at = rng.randint(0, len(words))
            words = words[:at] + own + words[at:]
            same = sum(a == b for a, b in zip(own, items[i][1].split())) / len(own)
            if same >= 0.85:
                truth.add((d, i))
        rows.append((d, " ".join(words).upper() if d % 16 == 0 else " ".join(words)))
    rows += [(9000, None), (None, items[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("body", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, bench, item_block=25).collect()}
    assert (None, 3) in got
    got.discard((None, 3))
    assert len(truth & got) >= 0.9 * len(truth) and len(got - truth) <= 0.05 * len(got)
    kept = {r.doc_id for r in decontam.remove_leaks(docs, bench).collect()}
    assert kept == {r[0] for r in rows} - {d for d, _ in got} - {None}
    assert decontam.find_leaks(docs, bench.limit(0)).collect() == []
    assert decontam.find_leaks(docs.limit(0), bench).collect() == []


def test_latent_projection_matches_exact_svd(spark):
    rng = random.Random(2)
    topics = [[f"t{k}x{i}" for i in range(30)] for k in range(6)]
    rows = [(i, " ".join(rng.choice(topics[i % 6]) for _ in range(64))) for i in range(300)]
    body = spark.createDataFrame(rows, "doc_id long, text string").select(F.col("text").cast("binary").alias("body"))
    idf = decontam.feature_weights(body)
    projection = decontam.latent_projection(body, idf, 6, 1)
    import pyarrow as pa
    words, first = decontam._words(pa.array([t.encode() for _, t in rows], pa.binary()))
    a = np.zeros((300, decontam.DIMS))
    for i in range(300):
        f = decontam._feature(words[first[i]:first[i + 1]])
        np.add.at(a[i], f, idf[f])
        a[i] /= np.sqrt((idf[f] ** 2).sum())
    exact = np.linalg.svd(a, full_matrices=False)[2][:6]
    use = idf > 0
    basis = np.linalg.qr(projection[use] / idf[use][:, None])[0]
    assert np.linalg.svd(exact[:, use] @ basis)[1].min() > 0.95


def test_pipeline_stages(spark):
    docs = read(spark, SF, "documents")
    columns, before = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = materialize(stage(spark, docs, SF), f"test-{name}")
        if k < 4:
            assert docs.columns == columns and docs.count() <= before
            before = docs.count()
    assert before > 100 and "copy" in docs.columns
    total = docs.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    assert total > 0


@pytest.mark.parametrize("k", range(5))
def test_pipeline_stages_on_odd_tables(spark, k):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score int, _h int"
    rows = [(1, None, None, None, None, 1, 1), (2, "", "en", "a", 0, None, 2), (None, "a b c d", "en", "a", 7, 2, 3),
            (3, "das ist ein Text", "de", "b", 16, 3, 4), (3, "das ist ein Text", "de", "b", 16, 3, 4)]
    stage = corpus_pipeline.STAGES[k][1]
    for table in (rows, []):
        df = spark.createDataFrame(table, schema)
        out = stage(spark, df, SF)
        got = out.collect()
        assert set(schema.replace(",", "").split()[::2]) <= set(out.columns)
        assert len(got) <= 2 * len(table)
