"""Personal data replaced by surrogates, in DataFrame functions only.

Detected are e-mail addresses, phone numbers, IPv4 and IPv6 addresses, payment card
numbers (valid check digit) and other account numbers, social security
numbers, long hex keys, and names after an honorific (particles such as "van der" included).
A name found once is looked up again in the whole document, without an honorific too, and so
is the surname of a full name; a surname that one full name of the document has is that
person, and its surrogate is that person's surname.  Not detected are names that no
honorific announces anywhere in their document, dates and postal addresses.

A surrogate is drawn by a keyed hash from the entity's
normal form (lower case, or digits alone; a phone number's country code by the numbering
plan, however it is spaced), so all mentions of one entity get one surrogate everywhere;
it has the type and
format of the mention: digits for digits, letters of the same script, case and
vowel class, separators in place, valid octets, a valid check digit, the
country code and the top-level domain kept.  A name keeps its honorific, and a
known given name becomes another one of the same gender.

Distinctness is checked over the whole corpus: a surrogate that two entities
share, or that is itself an entity of the corpus, is drawn again (a higher
attempt number) until none is left.  An entity whose format has no free surrogate
after ``RELAX`` draws gets a longer one: digits or letters are added, a lone
given name gets a surname, octets may have any length.  Texts without a candidate never leave
their task; mentions are counted by entity before they are matched, so an
entity in every document is no hot key.

Defined cases: null text stays null; rows repeated with one id and text get equal results; an empty table gives an
empty result; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialize, packed, unpacked

KEY = "replace-with-a-secret"
ROUNDS = 40
RELAX = 8  # attempts that keep the format; later ones lengthen the surrogate

# Alphabets by script, case and vowel class.
ALPHABETS = (
    "0123456789",
    "aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ",
    "àáâãäåæèéêëìíîïòóôõöøùúûü", "çñß", "ÀÁÂÃÄÅÆÈÉÊËÌÍÎÏÒÓÔÕÖØÙÚÛÜ", "ÇÑ",
    "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "АЕЁИОУЫЭЮЯ", "БВГДЖЗЙКЛМНПРСТФХЦЧШЩ",
    "αεηιουω", "βγδζθκλμνξπρστφχψ", "ΑΕΗΙΟΥΩ", "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ",
    "אבגדהוזחטיכלמנסעפצקרשת", "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
    "कखगघचछजझटठडढतथदधनपफबभमयरलवशषसह",
    "あいうえおかきくけこさしすせそたちつてとなにぬねの", "アイウエオカキクケコサシスセソタチツテトナニヌネノ",
    "王李张刘陈杨黄赵吴周徐孙马朱胡林郭何高罗", "김이박최정강조윤장임한오서신권황안송류홍",
)
HEX_DIGITS = "0123456789abcdef"
LATIN = "abcdefghijklmnopqrstuvwxyz"
# Given names by gender.
FEMALE = ("Anna", "Clara", "Elena", "Emma", "Eva", "Ines", "Julia", "Laura", "Lena", "Lucia", "Maria", "Marie",
          "Marta", "Nina", "Nora", "Olga", "Paula", "Rosa", "Sara", "Sofia", "Анна", "Елена", "Мария", "Ольга")
MALE = ("Adam", "Bruno", "Daniel", "David", "Emil", "Felix", "Hugo", "Ivan", "Jan", "John", "Karl", "Leo", "Lucas",
        "Marco", "Max", "Oscar", "Paul", "Peter", "Samuel", "Thomas", "Антон", "Борис", "Иван", "Павел")

HONORIFIC = (r"(?:Mrs?|Ms|Miss|Dr|Prof|Sir|Madam|Herr|Frau|Señora?|Sra?|Monsieur|Madame|Mme|Mlle|"
             r"Господин|Госпожа)\.?")
PARTICLES = r"(?: (?:van|von|der|den|de|del|di|da|dos|du|la|le|ter|ten|zu))*"
NAME_WORD = r" \p{Lu}[\p{L}'’-]+"
# Calling codes of one and two digits; all others have three.
COUNTRY = r"^(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{1,3})"
GROUP16 = "[0-9A-Fa-f]{1,4}"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
PATTERNS = {
    "email": r"[\p{L}\p{N}][\p{L}\p{N}._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "key": r"(?<![\p{L}\p{N}])(?=[0-9a-f]*[0-9])(?=[0-9a-f]*[a-f])[0-9a-f]{32,}(?![\p{L}\p{N}])",
    "ssn": r"(?<![\p{L}\d-])\d{3}-\d{2}-\d{4}(?![\p{L}\d-])",
    "ip": rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\d|\.\d)",
    "ip6": rf"(?<![\w:])(?:(?:{GROUP16}:){{7}}{GROUP16}|(?:{GROUP16}:){{1,6}}(?::{GROUP16}){{1,6}})(?![\w:])",
    "phone": r"(?:\+\d{1,3}(?:[ .-]?(?:\(\d{1,4}\)|\d{2,4})){2,4}|"
             r"(?<![\p{L}\d.(-])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4})(?![\p{L}\d])",
    "card": r"(?<![\p{L}\d])(?:\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{13,19})(?![\p{L}\d])",
    "name": HONORIFIC + PARTICLES + NAME_WORD + f"(?:{PARTICLES}{NAME_WORD})?",
}
KINDS = tuple(PATTERNS)
ANY = "|".join(PATTERNS[k].replace(r"([ -])", r"(?<sep>[ -])").replace(r"\1", r"\k<sep>") for k in KINDS)
# every match has a digit, or an at sign, or starts with an honorific
HINT = r"[0-9@]|" + HONORIFIC + PARTICLES + r" \p{Lu}"


def kind_of(hit: Column) -> Column:
    """Kind of a match of ANY; a long number with a valid check digit is a card."""
    digits = F.regexp_replace(hit, r"\D", "")
    return (F.when(hit.contains("@"), "email").when(hit.rlike(r"^[0-9a-f]{32,}$"), "key")
            .when(hit.rlike(r"^[0-9A-Fa-f]+:[0-9A-Fa-f:]+$"), "ip6")
            .when(hit.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn").when(hit.rlike(r"^(?:\d{1,3}\.){3}\d{1,3}$"), "ip")
            .when(hit.rlike(r"^[+(]|^\d{3}[.-]\d{3}[.-]"), "phone")
            .when(hit.rlike(r"^\d"), F.when(luhn_sum(digits) % 10 == 0, "card").otherwise("account")).otherwise("name"))


def luhn_sum(digits: Column) -> Column:
    """Check sum of a string of digits, the last one included."""
    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return acc + F.when(i % 2 == 1, twice).otherwise(d)
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add)


def normal_form(kind: Column, hit: Column) -> Column:
    """What makes two mentions one entity."""
    digits = F.regexp_replace(hit, r"\D", "")
    country = F.when(hit.startswith("+"), F.regexp_extract(digits, COUNTRY, 1)).otherwise("")
    return (F.when(kind.isin("email", "ip6"), F.lower(hit))
            .when(kind == "phone", F.concat(country, F.lit("|"), F.substring(digits, F.length(country) + 1, F.length(digits))))
            .when(kind.isin("card", "account", "ssn"), digits)
            .when(kind == "name", F.regexp_replace(hit, "^" + HONORIFIC + " ", "")).otherwise(hit))


def _draw(key: str, *parts: Column) -> Column:
    """A number below 2**60 by keyed hash."""
    inner = F.sha2(F.concat_ws("\x1f", F.lit(key), *[p.cast("string") for p in parts]), 256)
    return F.conv(F.substring(F.sha2(F.concat(F.lit(key), inner), 256), 1, 15), 16, 10).cast("long")


def _letters(chars: Column, kept: Column, seed: tuple, key: str, alphabets=ALPHABETS, loose: Column | None = None) -> Column:
    """Every character (from place ``kept`` on: unchanged) by one of its own alphabet; where
    ``loose`` holds, a letter of no alphabet by a Latin one."""
    def swap(c: Column, i: Column) -> Column:
        n = _draw(key, *seed, i)
        pick = F.when(i >= kept, c)
        for a in alphabets:
            pick = pick.when(F.instr(F.lit(a), c) > 0,
                             F.substring(F.lit(a), (n % len(a) + 1).cast("int"), F.lit(1)))
        if loose is not None:
            latin = F.substring(F.lit(LATIN), (n % len(LATIN) + 1).cast("int"), F.lit(1))
            pick = pick.when(loose & c.rlike(r"\p{L}"), F.when(c != F.lower(c), F.upper(latin)).otherwise(latin))
        return pick.otherwise(c)
    return F.array_join(F.transform(chars, swap), "")


def _added(n: Column, seed: tuple, key: str, *alphabets: str) -> Column:
    """``n`` drawn characters, of the alphabets in turn."""
    def one(i: Column) -> Column:
        r = _draw(key, *seed, F.lit("added"), i)
        out = F.lit("")
        for k, a in enumerate(alphabets):
            out = F.when(i % len(alphabets) == k, F.substring(F.lit(a), (r % len(a) + 1).cast("int"), F.lit(1))).otherwise(out)
        return out
    return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), one), "")).otherwise("")


def _given(name: Column, n: Column) -> Column:
    """Another given name of the same gender and script, or null if ``name`` is no known one."""
    out = F.lit(None).cast("string")
    for group in (FEMALE, MALE):
        for cyrillic in (False, True):
            own = [x for x in group if (x[0] > "Ѐ") == cyrillic]
            out = F.when(name.isin(own), F.get(
                F.array_remove(F.array(*[F.lit(x) for x in own]), name), (n % (len(own) - 1)).cast("int"))).otherwise(out)
    return out


def surrogate(kind: Column, entity: Column, attempt: Column, key: str = KEY) -> Column:
    """The normal form of an entity's surrogate; from attempt ``RELAX`` on longer by the attempt."""
    seed = (kind, attempt, entity)
    more = F.greatest(attempt - (RELAX - 1), F.lit(0))
    loose = more > 0
    digits = _added(more, seed, key, ALPHABETS[0])
    chars = F.filter(F.split(entity, ""), lambda c: c != "")
    n = F.length(entity)
    dot = n - F.length(F.substring_index(entity, ".", -1))  # an address keeps its top-level domain
    email = F.concat(_added(more, seed, key, LATIN), _letters(chars, dot, seed, key, loose=loose))
    hexes = F.concat(_letters(chars, n, seed, key, (HEX_DIGITS,)), _added(more, seed, key, HEX_DIGITS))
    country = F.substring_index(entity, "|", 1)
    number = F.substring_index(entity, "|", -1)
    phone = F.concat(country, F.lit("|"), _letters(F.split(number, ""), F.lit(1 << 30), seed, key, ALPHABETS[:1]), digits)
    plain = F.concat(_letters(chars, n, seed, key, ALPHABETS[:1]), digits)
    # the card's first digit tells its issuer, the last one is the check digit
    middle = F.concat(F.substring(entity, 1, 1), _letters(F.slice(chars, F.lit(2), n - 2), n, seed, key, ALPHABETS[:1]), digits)
    check = (10 - luhn_sum(F.concat(middle, F.lit("0"))) % 10) % 10
    card = F.concat(middle, check.cast("string"))

    def octet(o: Column, i: Column) -> Column:
        r = _draw(key, *seed, i)
        return F.when(loose, r % 256).when(F.length(o) == 1, r % 9 + 1).when(F.length(o) == 2, r % 90 + 10).otherwise(r % 156 + 100).cast("string")

    # even all addresses may be taken
    ip = F.concat(F.array_join(F.transform(F.split(entity, r"\."), octet), "."),
                  _added(attempt - (2 * RELAX - 1), seed, key, ALPHABETS[0]))
    first = F.substring_index(entity, " ", 1)
    rest = F.slice(chars, F.length(first) + 1, F.greatest(n - F.length(first), F.lit(0)))
    given = F.coalesce(_given(first, _draw(key, *seed, F.lit("given"))),
                       _letters(F.filter(F.split(first, ""), lambda c: c != ""), n, seed, key, loose=loose))
    def tail(vowels: str, consonants: str) -> Column:
        return F.when(F.instr(entity, " ") > 0, _added(2 * more, seed, key, vowels, consonants)).otherwise(
            F.concat(F.lit(" "), F.initcap(_added(2 * more + 2, seed, key, vowels, consonants))))

    name = F.concat(given, _letters(rest, n, (*seed, F.lit("rest")), key, loose=loose),
                    F.when(~loose, "").when(first.rlike(r"^\p{IsCyrillic}"), tail(ALPHABETS[8], ALPHABETS[9]))
                    .when(first.rlike(r"^\p{IsGreek}"), tail(ALPHABETS[12], ALPHABETS[13])).otherwise(tail(ALPHABETS[1], ALPHABETS[2])))
    return (F.when(kind == "email", email).when(kind.isin("key", "ip6"), hexes).when(kind == "phone", phone)
            .when(kind.isin("ssn", "account"), plain).when(kind == "card", card).when(kind == "ip", ip).otherwise(name))


def in_format_of(mention: Column, kind: Column, core: Column) -> Column:
    """The surrogate ``core`` (a normal form) spelled the way the mention is."""
    chars = F.filter(F.split(mention, ""), lambda c: c != "")
    more = F.greatest(F.length(core) - F.length(F.lower(mention)), F.lit(0))  # a longer surrogate has its new letters first
    cased = F.concat(F.substring(core, F.lit(1), more), F.array_join(F.transform(chars, lambda c, i: F.when(
        c != F.lower(c), F.upper(F.substring(core, more + i + 1, F.lit(1)))).otherwise(F.substring(core, more + i + 1, F.lit(1)))), ""))
    digits = F.regexp_replace(core, r"\|", "")
    # a digit of the mention is the next one of the surrogate; those left over follow
    numbered = F.aggregate(
        chars, F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda acc, c: F.struct(
            F.concat(acc["out"], F.when(c.rlike(r"\d"), F.substring(digits, acc["at"], F.lit(1))).otherwise(c)).alias("out"),
            (acc["at"] + F.when(c.rlike(r"\d"), 1).otherwise(0)).alias("at")),
        lambda acc: F.concat(acc["out"], F.substring(digits, acc["at"], F.length(digits))))
    honorific = F.regexp_extract(mention, "^" + HONORIFIC + " ", 0)
    return (F.when(kind == "email", cased).when((kind == "ip6") & mention.rlike("[A-F]"), F.upper(core)).when(kind.isin("phone", "card", "account", "ssn"), numbered)
            .when(kind == "name", F.concat(honorific, core)).otherwise(core))


def distinct_surrogates(entities: DataFrame, key: str = KEY, rounds: int = ROUNDS) -> DataFrame:
    """``entities`` (kind, entity; distinct) plus ``core``: one-to-one within a kind, and
    never an entity of the corpus itself."""
    def with_core(df: DataFrame) -> DataFrame:
        return df.withColumn("core", surrogate(F.col("kind"), F.col("entity"), F.col("attempt"), key))

    # drawing is the costly part: it is spread over all tasks, however few bytes the entities have
    tasks = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = entities.repartition(tasks, "kind", "entity").withColumn("attempt", F.lit(0))
    settled, trial = None, materialize(with_core(first), "pii-round0")
    known = entities.select("kind", F.col("entity").alias("core"))
    for k in range(1, rounds + 1):
        # a longer surrogate must not show the entity either; of those that share a core, the smallest entity has it
        keepers = materialize(trial.filter(~F.col("core").contains(F.col("entity"))).groupBy("kind", "core")
                              .agg(F.min("entity").alias("entity")), f"pii-keepers{k}", few=True)
        # entities and cores that are held already, as far as a keeper meets them
        wanted = keepers.select("kind", "core")
        taken = known.join(wanted, ["kind", "core"], "left_semi")
        if settled is not None:
            taken = taken.unionByName(settled.select("kind", "core").join(wanted, ["kind", "core"], "left_semi"))
        free = keepers.join(taken, ["kind", "core"], "left_anti").select("kind", "core", "entity")
        good = materialize(trial.join(free, ["kind", "core", "entity"], "left_semi"), f"pii-good{k}", few=True)
        settled = good if settled is None else settled.unionByName(good)
        trial = materialize(with_core(trial.join(good, ["kind", "entity"], "left_anti").drop("core")
                                      .withColumn("attempt", F.lit(k))), f"pii-round{k}", few=True)
        if trial.isEmpty():
            return settled.drop("attempt")
    raise RuntimeError("surrogates still collide: too many entities of one format")


def with_names(rows: DataFrame) -> DataFrame:
    """``rows`` plus ``_hits`` (all matches in its text), ``_fulls`` (the full names that an honorific
    announces) and ``_again``: the pattern that finds the announced names too (null: there are none)."""
    announced = F.filter("_hits", lambda h: h.rlike("^" + HONORIFIC + " "))
    rows = rows.withColumn("_hits", F.regexp_extract_all(F.col("_text"), F.lit(ANY), F.lit(0)))
    rows = rows.withColumn("_names", F.array_distinct(F.transform(announced, lambda h: F.regexp_replace(h, "^" + HONORIFIC + " ", ""))))
    rows = rows.withColumn("_fulls", F.filter("_names", lambda n: n.contains(" ")))
    # longest first, so that a full name is not taken for its surname
    sought = F.array_distinct(F.concat("_names", F.transform("_fulls", lambda n: F.substring_index(n, " ", -1))))
    sought = F.reverse(F.array_sort(F.transform(F.filter(sought, lambda n: F.length(n) >= 3),
                                                lambda n: F.struct(F.length(n).alias("size"), n.alias("name")))))
    either = F.array_join(F.transform(sought, lambda x: F.concat(F.lit("\\Q"), x["name"], F.lit("\\E"))), "|")
    rows = rows.withColumn("_either", either)
    again = F.concat(F.lit(ANY + r"|(?<![\p{L}\p{N}])(?=\p{L})(?:"), F.col("_either"), F.lit(r")(?![\p{L}\p{N}])"))
    rows = rows.withColumn("_again", F.when(F.col("_either") != "", again))
    return rows.withColumn("_hits", F.when(F.col("_again").isNotNull(), F.regexp_extract_all(F.col("_text"), F.col("_again"), F.lit(0)))
                           .otherwise(F.col("_hits"))).drop("_names", "_either")


def replace(docs: DataFrame, key: str = KEY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every detected entity of the text replaced, plus n_entities (long)."""
    text = F.col("_text")
    marked = packed(docs, _id=F.col(id_col), _text=F.col(text_col),
                    _hit=F.coalesce(F.col(text_col).rlike(HINT), F.lit(False)))
    calm = unpacked(marked.filter(~F.col("_hit")), docs.columns, n_entities=F.lit(0).cast("long"))
    rows = marked.filter("_hit").select("_row", "_id", "_text", F.xxhash64("_text").alias("_h"))
    entity = normal_form(F.col("_kind"), F.col("_mention"))
    whose = F.filter("_fulls", lambda n: n.endswith(F.concat(F.lit(" "), F.col("_entity"))))
    # the outer form: a plain explode would have its "array is not empty" pushed down with all expressions in it
    mentions = (with_names(rows).select("_id", "_h", "_fulls", "_again", F.posexplode_outer("_hits").alias("_i", "_mention"))
                .filter(F.col("_mention").isNotNull())
                .withColumn("_kind", kind_of(F.col("_mention"))).withColumn("_entity", entity)
                .withColumn("_person", F.when((F.col("_kind") == "name") & (F.size(whose) == 1), F.get(whose, F.lit(0)))))
    mentions = materialize(
        mentions.select("_id", "_h", "_i", "_mention", "_kind", F.coalesce("_person", "_entity").alias("_entity"),
                        F.col("_person").isNotNull().alias("_surname"), F.when(F.col("_i") == 0, F.col("_again")).alias("_again"))
        .distinct(), "pii-mentions", few=True)
    entities = materialize(mentions.filter(F.col("_kind").isNotNull())
                           .select(F.col("_kind").alias("kind"), F.col("_entity").alias("entity")).distinct(), "pii-entities", few=True)
    cores = distinct_surrogates(entities, key)
    found = mentions.join(cores, (F.col("_kind") == F.col("kind")) & (F.col("_entity") == F.col("entity")), "left")
    core = F.when(F.col("_surname"), F.substring_index("core", " ", -1)).otherwise(F.col("core"))
    new = F.coalesce(in_format_of(F.col("_mention"), F.col("_kind"), core), F.col("_mention"))
    swaps = (found.groupBy("_id", "_h").agg(F.array_sort(F.collect_set(F.struct("_i", new.alias("_new")))).alias("_swaps"),
                                            F.count("core").alias("_n"), F.max("_again").alias("_again"))
             .select(F.col("_id").alias("_id2"), F.col("_h").alias("_h2"), "_swaps", "_n", F.coalesce("_again", F.lit(ANY)).alias("_pattern")))
    joined = rows.join(swaps, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_h") == F.col("_h2")), "left")
    rebuilt = F.concat_ws("", F.flatten(F.zip_with(
        F.expr("split(_text, _pattern, -1)"), "_swaps", lambda gap, s: F.array(gap, s["_new"]))))
    out = unpacked(joined, docs.columns, **{
        text_col: F.when(F.col("_n") > 0, rebuilt).otherwise(text), "n_entities": F.coalesce("_n", F.lit(0)).cast("long")})
    return calm.unionByName(out)
