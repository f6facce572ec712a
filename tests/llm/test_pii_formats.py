"""Personal data of formats that have too few surrogates."""

import re

from pyspark.sql import functions as F

from strata.llm import pii


def test_full_formats_get_longer_surrogates(spark):
    names = [f"Miss {n}" for n in pii.FEMALE] + [f"Herr {n}" for n in pii.MALE]
    names += [f"Dr {c}{v}" for c in pii.ALPHABETS[4] for v in pii.ALPHABETS[1]]  # every two-letter name
    names += ["Dr Łł", "Dr Ωω", "Prof Łął Ąą"]  # letters of no alphabet
    ips = [f"{a}.{b}.{c}.{d}" for a in range(1, 10) for b in range(10) for c in range(1, 10) for d in range(1, 10)]
    mails = [f"{a}{b}@x.org" for a in "aeiou" for b in "AEIOU"]
    old = names + ips + mails
    df = spark.createDataFrame(list(enumerate(old)), "doc_id long, text string")
    new = {r.doc_id: (r.n_entities, r.text) for r in pii.replace(df).collect()}
    texts = [new[i][1] for i in range(len(old))]
    assert all(n == 1 for n, _ in new.values())
    bare = [re.sub(r"^\S+ ", "", t) for t in texts]
    assert len(set(bare)) == len(old) and not set(bare) & {re.sub(r"^\S+ ", "", t) for t in old}
    for o, t in zip(names, texts):
        assert t.split()[0] == o.split()[0] and t.split()[1] != o.split()[1]
        assert re.fullmatch(r"\S+( [^\W\d_]+)+", t)
    assert texts[names.index("Miss Emma")].split()[1] in pii.FEMALE
    for t in texts[len(names):len(names) + len(ips)]:
        assert all(0 <= int(o) <= 255 and str(int(o)) == o for o in t.split(".")) and t.count(".") == 3
    for t in texts[-len(mails):]:
        assert re.fullmatch(r"[a-z]*[a-z][A-Z]@[a-z]+\.org", t)


def test_longer_digits_keep_separators_and_check_digit(spark):
    rows = [("card", "4111111111111111", "4111-1111-1111-1111"), ("ssn", "123456789", "123-45-6789"),
            ("phone", "1|4155550100", "+1 (415) 555-0100"), ("key", "0a" * 16, "0a" * 16)]
    df = spark.createDataFrame(rows, "kind string, entity string, mention string")
    core = pii.surrogate(F.col("kind"), F.col("entity"), F.lit(pii.RELAX + 1))
    got = {r.kind: r.t for r in df.select("kind", pii.in_format_of(F.col("mention"), F.col("kind"), core).alias("t")).collect()}
    assert re.fullmatch(r"4\d{3}(-\d{4}){2}-\d{6}", got["card"])
    total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(got["card"].replace("-", ""))))
    assert total % 10 == 0
    assert re.fullmatch(r"\d{3}-\d{2}-\d{6}", got["ssn"]) and re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{6}", got["phone"])
    assert re.fullmatch(r"[0-9a-f]{34}", got["key"])
