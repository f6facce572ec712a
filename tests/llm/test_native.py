"""Secret scan, quality rules and personal data against plain Python."""

import math
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.llm import pii, quality, secrets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.I | re.A)


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def secret_text(rng):
    parts = ["password: token : abcdef", "API_KEY='sk_live.12=='", "token=short", "token=longenough", "AKIA" + "Q7" * 9,
             "AKIAAKIA12", "deadbeef" * 4, "é" * 3, "secret = \"", "Passwd=a.b", "x" * 5, "0123456789abcdef01234567",
             "apikey  :  zzzzzz", "tOkEn=\n", "AKIAAKIA" + "A1" * 8, "😀"]
    return rng.choice(["", " ", "\n"]).join(rng.choice(parts) for _ in range(rng.randint(0, 12)))


def test_secret_base_spans(spark):
    rng = random.Random(1)
    rows = [(i, secret_text(rng), f"s{i % 3}") for i in range(300)]
    rows += [(900, None, "s"), (901, "", None), (902, "token=abcdef " * 1500, "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: [(s.start, s.kind, s.end) for s in r.spans if s.kind < 3] for r in secrets.scan(df).collect()}
    assert got == {d: base_spans(t or "") for d, t, _ in rows}


def test_secret_ownership(spark):
    shared, own = "q8Zt4LmN2xWv7RkP1sYb", "h3Jd9Tc5Vf0Gq6Ba8Xe2"
    rows = [(i, f"see {shared} here", f"owner{i}") for i in range(5)]
    rows += [(10, f"mine {own} ok", "owner1"), (11, f"token={shared}", "owner9"), (12, f"key {own}", "owner1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: [(secrets.KINDS[s.kind], s.live, s.n_owners) for s in r.spans] for r in secrets.scan(df).collect()}
    assert got[0] == [] and got[10] == [("bare", True, 1)] and got[12] == [("bare", True, 1)]
    assert got[11] == [("assign", False, 6)]  # base spans stay, copied values are not live


def test_secret_edge_rows(spark):
    rows = [(None, "token=abcdefgh", None), (1, "token=abcdefgh", "a"), (1, "token=abcdefgh", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("found", F.lit("x"))
    assert sorted(len(r.spans) for r in secrets.scan(df).collect()) == [1, 1, 1]
    assert secrets.scan(df.limit(0)).collect() == []


def test_secret_spans_of_one_text_take_linear_time(spark):
    """100,000 spans in one text, bare tokens inside and outside of base spans."""
    text = "token=abcdefgh q8Zt4LmN2xWv7RkP1sYb password: h3Jd9Tc5Vf0Gq6Ba8Xe2 " * 33_334
    df = spark.createDataFrame([(1, text, "a")], "doc_id long, text string, source string")
    begun = time.perf_counter()
    spans = secrets.scan(df).first()["spans"]
    assert [sum(s["kind"] == k for s in spans) for k in range(4)] == [66_668, 0, 0, 33_334]
    assert time.perf_counter() - begun < 60


def test_secret_tokens_inside_base_spans(spark):
    """A bare token counts only outside of all base spans, however they overlap."""
    rng = random.Random(6)
    own = "h3Jd9Tc5Vf0Gq6Ba8Xe2"
    bare = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
    parts = [own, f"token={own}", f"{own}=", "token=abcdef." + own, "deadbeef" * 4, f"x-{own}", "AKIA" + "Q7" * 9, f"key: {own}", "plain"]
    rows = [(i, " ".join(rng.choices(parts, k=rng.randint(1, 8))), "s") for i in range(18)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for r in secrets.scan(df, max_repos=100).collect():
        text = rows[r.doc_id][1]
        base = base_spans(text)
        want = [(m.start(), m.end()) for m in bare.finditer(text) if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0])
                and not any(s < m.end() and m.start() < e for s, _, e in base)]
        assert [(s.start, s.end) for s in r.spans if s.kind == 3] == want


def counts(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    c = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


@pytest.mark.parametrize("bits", [24, 60, 5])
def test_quality_measures(spark, bits):
    rng = random.Random(bits)
    rows = [(i, "".join(rng.choice(["a", "b", "é#", "$", "cc", "😀"]) + rng.choice([" ", "\n", "\t", "  ", " \x0b"])
                        for _ in range(rng.randint(0, 60)))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, "a b"), (903, "a a a"), (904, "a a a a"), (905, "x y z " * 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = {r.doc_id: tuple(r[n] for n in names) for r in quality.measure(df, place_bits=bits).collect()}
    assert got == {d: counts(t) for d, t in rows}


def test_binomial_tail(spark):
    cases = [(0, 10, 0.1), (3, 100, 0.05), (5, 1000, 0.01), (0, 0, 0.2), (40, 10_000, 0.006)]
    for k, n, p in cases:
        exact = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p)
                             + (n - i) * math.log(1 - p)) for i in range(k + 1))
        got = spark.range(1).select(quality.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).first()[0]
        assert got == pytest.approx(exact if k <= n * p else 1.0)


def test_quality_cutoffs_keep_their_promise(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows, labels = [], []
    for i in range(3000):
        bad = i % 10 == 0
        rows.append((i, " ".join(word() + ("$" if bad or rng.random() < 0.001 else "") for _ in range(60)), "en"))
        labels.append((i, 0 if bad else 1))
    rows += [(5000, "too short", "en"), (5001, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    lab = spark.createDataFrame(labels + [(1, 1), (2, None), (None, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.judge(docs, lab).collect()}
    assert len(got) == len(rows) and got[5000].base_failed and not got[5001].kept
    wrong = sum(not got[i].kept for i, q in labels if q == 1)
    assert wrong <= 0.02 * 2700
    assert not any(got[i].kept for i, q in labels if q == 0)
    none = quality.judge(docs, lab.limit(0)).collect()
    assert all(r.kept == (not r.base_failed) for r in none)
    assert quality.judge(docs.limit(0), lab).collect() == []


def test_repeated_rows_are_one_trial(spark):
    """Too few labelled documents for a cutoff stay too few when their rows are repeated."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows = [(i, " ".join(word() + ("$" if i % 10 == 0 else "") for _ in range(60)), "en") for i in range(200)]
    lab = spark.createDataFrame([(i, int(i % 10 != 0)) for i in range(200)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    many = spark.createDataFrame(rows * 20, "doc_id long, text string, lang string")
    kept = lambda df: {r.doc_id: r.kept for r in quality.judge(df, lab).collect()}
    once = kept(docs)
    assert kept(many) == once and all(once.values())


TEXT = ("Call Mrs. Anna Müller or Herr Иван Петров, +44 20 7946 0958; 123-45-6789; 4111-1111-1111-1111 "
        "bob@X.org Bob@x.org. Version 1.2.3.4.5 and 10.0.0.1. key 04dbebab91ab85687d33eeaaf9ac699e1188f962!")


def test_surrogates(spark):
    rows = [(1, TEXT), (2, None), (3, "Frau Anna Müller, bob@x.org +1 (974) 555-3436 +1 974 555 3436"), (4, "clean 12 a.b"),
            (5, ""), (None, "bob@x.org"), (3, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kind", F.lit(1))
    out = pii.replace(df).collect()
    got = {r.doc_id: r.text for r in out if r.text != "x"}
    assert got[2] is None and got[4] == "clean 12 a.b" and got[5] == "" and len(out) == len(rows)
    t = got[1]
    for gone in ("Anna", "Müller", "Иван", "Петров", "7946", "123-45", "4111", "bob", "Bob", "10.0.0.1", "04dbeb"):
        assert gone not in t
    assert "Version 1.2.3.4.5" in t and "Mrs. " in t and "Herr " in t and len(t) >= len(TEXT) - 12
    mail = re.search(r"([a-z]+@)([A-Za-z])\.org ([A-Z][a-z]+@)([a-z])\.org", t)
    assert mail[1].lower() == mail[3].lower() and mail[2] == mail[4].upper()  # one person, two spellings
    name = re.search(r"Mrs\. (\w+ \w+)", t)[1]
    assert got[3].startswith(f"Frau {name}, ") and name.split()[0] in pii.FEMALE
    assert re.search(r"Herr (\w+) ", t)[1] in pii.MALE
    card = re.search(r"\d{4}-\d{4}-\d{4}-\d{4}", t)[0].replace("-", "")
    total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(card)))
    assert total % 10 == 0 and card[0] == "4"
    a, b = re.findall(r"\+1 [()\d -]+\d", got[3].replace(" +1", "\n+1"))
    assert re.sub(r"\D", "", a) == re.sub(r"\D", "", b)
    assert got[None] == re.search(r"(\S+@\S+) ", got[3])[1]


def test_surrogates_stay_distinct(spark):
    # more than half of all two-digit octet addresses of one form: draws must collide
    rows = [(i, f"host 10.0.0.{i}") for i in range(10, 100)] + [(i, f"at 9.9.9.{i % 10}") for i in range(100, 110)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in pii.replace(df).collect()}
    assert len(set(out.values())) == len(rows)
    assert pii.replace(df).select("text").distinct().count() == len(rows)  # reruns agree
    assert {r.text for r in pii.replace(df).collect()} == set(out.values())


def test_collisions_are_drawn_again(spark):
    ents = spark.createDataFrame([("ssn", f"{i}") for i in range(6)], "kind string, entity string")
    with pytest.raises(RuntimeError):  # ten one-digit numbers cannot name six others
        pii.distinct_surrogates(ents, rounds=3)
    ents = spark.createDataFrame([("ssn", f"{i:02d}") for i in range(40)], "kind string, entity string")
    got = pii.distinct_surrogates(ents).collect()
    assert len({r.core for r in got}) == 40 and not {r.core for r in got} & {r.entity for r in got}


def test_surrogates_empty(spark):
    assert pii.replace(spark.createDataFrame([], "doc_id long, text string")).collect() == []
