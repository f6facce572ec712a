"""One person, phone number or address is one entity, wherever and however it is written."""

import re

from strata.llm import pii


def replaced(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["text"] for r in sorted(pii.replace(df).collect(), key=lambda r: r["doc_id"])]


def test_names_are_looked_up_again_in_their_document(spark):
    text = "Mrs. Anna Müller wrote. Later Anna Müller came; Mrs. Müller left. Müllers and Annabel stay, Müller too."
    other = "Anna Müller is not announced here."
    got, left = replaced(spark, text, other)
    assert left == other
    full = re.match(r"Mrs\. (\S+ \S+) wrote\.", got)[1]
    surname = full.split()[-1]
    assert got == f"Mrs. {full} wrote. Later {full} came; Mrs. {surname} left. Müllers and Annabel stay, {surname} too."
    assert "Müller " not in got.replace("Müllers", "") and "Anna " not in got


def test_a_surname_of_two_people_is_its_own(spark):
    got, = replaced(spark, "Mr. John Foster met Mrs. Clara Foster. Foster laughed.")
    john, clara, alone = re.match(r"Mr\. (\S+ \S+) met Mrs\. (\S+ \S+)\. (\S+) laughed\.", got).groups()
    assert len({john, clara, alone}) == 3 and "Foster" not in got


def test_particles_and_apostrophes(spark):
    got = replaced(spark, "Dr. van der Berg and Mr. O’Neil met Frau Maria von Trapp.", "Herr de Witt")
    assert not re.search("Berg|Neil|Trapp|Witt", " ".join(got))
    assert re.fullmatch(r"Dr\. \S+ \S+ \S+ and Mr\. \S’\S+ met Frau \S+ \S+ \S+\.", got[0])


def test_phone_numbers_by_their_digits(spark):
    forms = ["+1 415 555 0100", "+14155550100", "+1 (415) 555-0100", "+49 30 1234567", "+49301234567", "+353 21 234 5678"]
    got = replaced(spark, *forms)
    digits = [re.sub(r"\D", "", t) for t in got]
    assert digits[0] == digits[1] == digits[2] and digits[3] == digits[4]
    assert digits[0].startswith("1") and digits[3].startswith("49") and digits[5].startswith("353")
    assert len(set(digits)) == 3 and not set(digits) & {re.sub(r"\D", "", f) for f in forms}
    assert [re.sub(r"\d", "0", t) for t in got] == [re.sub(r"\d", "0", f) for f in forms]


def test_ipv6(spark):
    forms = ["2001:db8:85a3:0:0:8a2e:370:7334", "2001:DB8:85A3:0:0:8A2E:370:7334", "fe80::1ff:fe23:4567", "at 12:30:45 or 10:20"]
    got = replaced(spark, *forms)
    assert got[0] != forms[0] and got[1] == got[0].upper() and got[3] == forms[3]
    assert re.fullmatch(r"[0-9a-f]{4}::[0-9a-f]{3}:[0-9a-f]{4}:[0-9a-f]{4}", got[2])


def test_many_names_in_a_long_text_and_odd_rows(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = [f"Q{a}{b}x R{b}{a}y" for a in letters[:20] for b in letters[:20]]
    text = " ".join(f"Mr. {n} said. {n} went." for n in names) + " calm words here" * 20_000
    got, none, empty = replaced(spark, text, None, "")
    assert none is None and empty == "" and not any(n in got for n in names)
    said = re.findall(r"Mr\. (.+?) said\. (.+?) went\.", got)
    assert len(said) == 400 and all(a == b for a, b in said) and len({a for a, _ in said}) == 400
