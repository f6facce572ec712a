"""DuckDB SQL for the operators whose results SQL can state."""

from __future__ import annotations

from strata.llm.quality import ALPHA, DELTA, GRID, RULES

WORDS = r"[^\x20\x09-\x0D]+"

OP1 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, unnest(range(0, length(h) // 2 - 99)) AS s, h FROM d WHERE length(h) >= 200),
w AS (SELECT doc_id, s, sha256(substr(h, 2 * s + 1, 200)) AS k FROM p),
r AS (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS n FROM w),
dup AS (SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM r WHERE n > 1),
runs AS (SELECT doc_id, s, sum(CASE WHEN before IS NULL OR s > before + 100 THEN 1 ELSE 0 END)
                           OVER (PARTITION BY doc_id ORDER BY s) AS run FROM dup),
spans AS (SELECT doc_id, run, min(s) AS a, max(s) + 100 AS b FROM runs GROUP BY doc_id, run),
gaps AS (SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS g, a AS e FROM spans
         UNION ALL SELECT d.doc_id, length(h) // 2 + 1, coalesce(max(b), 0), length(h) // 2
         FROM d LEFT JOIN spans ON spans.doc_id = d.doc_id GROUP BY d.doc_id, h),
kept AS (SELECT g.doc_id, string_agg(substr(h, 2 * g + 1, 2 * (e - g)), '' ORDER BY a) AS k
         FROM gaps g JOIN d ON d.doc_id = g.doc_id GROUP BY g.doc_id)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes,
       (length(h) // 2 - length(k) // 2)::BIGINT AS n_removed,
       (SELECT count(*) FROM spans s WHERE s.doc_id = d.doc_id)::BIGINT AS n_spans,
       sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept ON kept.doc_id = d.doc_id
"""

OP3 = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
p(kind, name, rx, grp) AS (VALUES
  (0, 'assign', '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2),
  (1, 'access', 'AKIA[A-Z0-9]+', 0), (2, 'hex', '[0-9a-f]+', 0), (3, 'bare', '[A-Za-z0-9+/_=-]+', 0)),
hits AS (
  SELECT doc_id, source, 0 AS kind, t, regexp_extract_all(t, (SELECT rx FROM p WHERE kind = 0)) AS h,
         regexp_extract_all(t, (SELECT rx FROM p WHERE kind = 0), 2) AS v,
         string_split_regex(t, (SELECT rx FROM p WHERE kind = 0)) AS g FROM d
  UNION ALL SELECT doc_id, source, kind, t, regexp_extract_all(t, rx), regexp_extract_all(t, rx), string_split_regex(t, rx)
  FROM d, (VALUES (1, 'AKIA[A-Z0-9]{16,}'), (2, '[0-9a-f]{24,}'), (3, '[A-Za-z0-9+/_=-]{20,}')) q(kind, rx)),
each AS (SELECT doc_id, source, kind, h, v, g, unnest(range(1, len(h) + 1)) AS i FROM hits WHERE len(h) > 0),
span AS (SELECT doc_id, source, kind, v[i] AS v, length(h[i]) AS n,
                (list_sum(list_transform(g[1:i], lambda x: length(x)))
                 + coalesce(list_sum(list_transform(h[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s FROM each),
base AS (SELECT * FROM span WHERE (kind = 0 AND length(v) >= 6) OR kind IN (1, 2)),
found AS (SELECT * FROM base UNION ALL
          SELECT * FROM span b WHERE kind = 3 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')
          AND NOT EXISTS (SELECT 1 FROM base x WHERE x.doc_id = b.doc_id AND x.s < b.s + b.n AND b.s < x.s + x.n)),
own AS (SELECT v, count(DISTINCT source) AS n_owners, count(DISTINCT doc_id) AS n_repos FROM found GROUP BY v),
judged AS (SELECT f.*, length(f.v) >= 16 AND regexp_matches(f.v, '[0-9]') AND regexp_matches(f.v, '[A-Za-z]')
                  AND len(list_distinct(string_split(f.v, ''))) >= 8 AND n_owners <= 2 AND n_repos <= 20 AS live
           FROM found f JOIN own ON own.v = f.v),
kept AS (SELECT DISTINCT j.doc_id, j.kind, s, n, live, name || ':' || s || ':' || (s + n) AS txt
         FROM judged j JOIN p ON p.kind = j.kind WHERE j.kind < 3 OR live)
SELECT d.doc_id, (count(txt) FILTER (WHERE kind = 0))::BIGINT AS n_assign,
       (count(txt) FILTER (WHERE kind = 1))::BIGINT AS n_access, (count(txt) FILTER (WHERE kind = 2))::BIGINT AS n_hex,
       sha256(coalesce(string_agg(txt, ',' ORDER BY s, kind, n) FILTER (WHERE kind < 3), '')) AS base_sha256,
       coalesce(string_agg(txt, ',' ORDER BY s, kind, n), '') AS spans,
       (count(txt) FILTER (WHERE live))::BIGINT AS n_live
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id GROUP BY d.doc_id
"""

OP5 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS s, w FROM d WHERE len(w) >= 35),
k AS (SELECT doc_id, s, sha256(array_to_string(w[s:s + 34], ' ')) AS k FROM p),
dup AS (SELECT doc_id, s FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY k) AS n FROM k) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, s + o AS i FROM dup, range(0, 35) r(o)),
word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM d),
agg AS (SELECT word.doc_id, count(gone.i) AS n_removed,
               coalesce(string_agg(x, ' ' ORDER BY word.i) FILTER (WHERE gone.i IS NULL), '') AS kept
        FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.i = word.i GROUP BY word.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN agg ON agg.doc_id = d.doc_id
"""

_RATIOS = {"symbol_ratio": ("n_symbols", "n_words"), "dup_line_ratio": ("n_dup_lines", "n_lines"),
           "repeat_ratio": ("n_repeat_words", "n_words")}
_RATE = ALPHA / len(RULES)

OP6 = rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
l AS (SELECT *, regexp_extract_all(t, '{WORDS}') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORDS}')) AS ln FROM d),
win AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM l WHERE len(w) >= 3),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM win)
        WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT i + o) AS c FROM rep, range(0, 3) r(o) GROUP BY doc_id),
m AS (SELECT l.doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(ln)::BIGINT AS n_lines,
             (len(ln) - len(list_distinct(ln)))::BIGINT AS n_dup_lines, coalesce(c, 0)::BIGINT AS n_repeat_words
      FROM l LEFT JOIN cov ON cov.doc_id = l.doc_id),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             {", ".join(f"CASE WHEN {b} > 0 THEN {a}::DOUBLE / {b} ELSE 0 END AS {r}" for r, (a, b) in _RATIOS.items())}
      FROM m),
good AS (SELECT doc_id, min(quality) = 1 AS good FROM labels GROUP BY doc_id HAVING min(quality) IS NOT NULL),
held AS (SELECT DISTINCT f.doc_id, lang, {", ".join(RULES)}, good FROM f JOIN good ON good.doc_id = f.doc_id WHERE NOT base_failed),
grid(c) AS (VALUES {", ".join(f"({c}::DOUBLE)" for c in GRID)}),
val AS ({" UNION ALL ".join(f"SELECT lang, good, '{r}' AS rule, {r} AS v FROM held" for r in RULES)}),
test AS (SELECT lang, rule, c, count(*) FILTER (WHERE good) AS n, count(*) FILTER (WHERE good AND v > c) AS wrong,
                count(*) FILTER (WHERE NOT good AND v > c) AS caught FROM val, grid GROUP BY lang, rule, c),
tail AS (SELECT *, CASE WHEN wrong > n * {_RATE} THEN 1.0 ELSE list_sum(list_transform(range(0, wrong + 1),
                lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({_RATE}) + (n - i) * ln(1 - {_RATE}))))
                END AS p FROM test),
ok AS (SELECT * FROM tail WHERE caught > 0
       AND p <= {DELTA} / ((SELECT count(DISTINCT coalesce(lang, chr(0))) FROM held) * {len(RULES)} * {len(GRID)})),
cut AS (SELECT lang, rule, c FROM (SELECT *, row_number() OVER (PARTITION BY lang, rule ORDER BY caught DESC, c DESC) AS k
                                  FROM ok) WHERE k = 1)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT EXISTS (
         SELECT 1 FROM cut WHERE cut.lang IS NOT DISTINCT FROM f.lang
         AND CASE rule {" ".join(f"WHEN '{r}' THEN {r}" for r in RULES)} END > c) AS kept
FROM f
"""

OP8 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                     'abcdefghijklmnopqrstuvwxyz'), '{WORDS}') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, CASE WHEN len(w) >= 3 THEN array_to_string(w[i:i + 2], ' ') ELSE array_to_string(w, ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS MATERIALIZED (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
         GROUP BY a.doc_id, b.doc_id),
link AS MATERIALIZED (SELECT x, y FROM common JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
                      WHERE 100 * c >= 90 * (a.n + b.n - c)),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, y FROM reach JOIN link ON x = r)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
       coalesce((SELECT min(y) FROM common c JOIN n b ON b.doc_id = y
                 WHERE x = d.doc_id AND c.c = n.n AND b.n = n.n AND y < d.doc_id), d.doc_id)::BIGINT AS class_id,
       min(r)::BIGINT AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN reach ON reach.doc_id = d.doc_id GROUP BY d.doc_id, n.n
"""

# CRC-32 of bytes in SQL: the table by its rule (reflected polynomial), then a fold over the bytes.
CRC_TABLE = """crc_table AS MATERIALIZED (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY i) AS t FROM range(256) r(i))"""


def crc32(text: str) -> str:
    """SQL for the unsigned CRC-32 of the UTF-8 bytes of ``text``; needs crc_table in FROM."""
    return (f"xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode({text})), '..'), "
            "lambda b: ('0x' || b)::BIGINT)), lambda c, b: xor(c >> 8, crc_table.t[(xor(c, b) & 255) + 1])), 4294967295)")


OP12 = f"""
WITH {CRC_TABLE},
d AS (SELECT doc_id, (strlen(coalesce(text, '')) + 1)::BIGINT AS size, {crc32("coalesce(text, '')")}::BIGINT AS text_crc32
      FROM documents, crc_table),
placed AS (SELECT *, coalesce(sum(size) OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins, sum(size) OVER () AS total FROM d),
cut AS (SELECT *, least((2 * begins + size) * 8 // (2 * total), 7)::INT AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
       NULL::INT AS grown_shard
FROM cut
"""

OP11 = f"""
WITH RECURSIVE {CRC_TABLE},
own AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
        FROM conversations),
convs AS (SELECT c, CASE WHEN c IS NULL THEN 0 ELSE {crc32("c::VARCHAR")} % 9 END AS h
          FROM (SELECT DISTINCT c FROM own), crc_table),
turns AS (SELECT v.c, o.i, o.role, o.text FROM convs v JOIN own o ON o.c IS NOT DISTINCT FROM v.c AND o.i > v.h
          UNION ALL SELECT v.c, o.i, o.role, o.text FROM convs v JOIN own o ON o.c = v.c - v.c % 5 AND o.i <= v.h),
seq AS (SELECT v.c, list(sha256(role || chr(0) || text) ORDER BY i) FILTER (WHERE i IS NOT NULL) AS s,
               list(strlen(text) ORDER BY i) FILTER (WHERE i IS NOT NULL) AS b
        FROM convs v LEFT JOIN turns t ON t.c IS NOT DISTINCT FROM v.c GROUP BY v.c),
way AS (SELECT c, d, sha256(coalesce(array_to_string(s[1:d], ','), '')) AS k,
               CASE WHEN d > 0 THEN sha256(coalesce(array_to_string(s[1:d - 1], ','), '')) END AS p,
               CASE WHEN d > 0 THEN b[d] ELSE 0 END AS nb, d = coalesce(len(s), 0) AS last
        FROM (SELECT *, unnest(range(0, coalesce(len(s), 0) + 1)) AS d FROM seq)),
node AS (SELECT d, k, any_value(p) AS p, min(c) AS rep, count(*) AS n, any_value(nb) AS nb,
                string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE last) AS ends FROM way GROUP BY d, k),
kids AS (SELECT d - 1 AS d, p AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY d - 1, p),
up(d, k, ad, ak) AS (
  SELECT d, k, d, k FROM node
  UNION ALL SELECT up.d, up.k, node.d - 1, node.p FROM up JOIN node ON node.d = up.ad AND node.k = up.ak WHERE node.d > 0),
total AS (SELECT ad AS d, ak AS k, sum((n.n - 1) * n.nb) AS saved, count(*) FILTER (WHERE kids.n IS NULL) AS leaves
          FROM up JOIN node n ON n.d = up.d AND n.k = up.k LEFT JOIN kids ON kids.d = up.d AND kids.k = up.k GROUP BY ad, ak)
SELECT node.rep AS conv_id, node.d::BIGINT AS depth, parent.rep AS parent_conv_id, node.n::BIGINT AS n_convs,
       coalesce(kids.n, 0)::BIGINT AS n_children, total.leaves::BIGINT AS n_leaves, total.saved::BIGINT AS saved_tokens,
       sha256(coalesce(node.ends, '')) AS ends_sha256
FROM node JOIN total ON total.d = node.d AND total.k = node.k LEFT JOIN kids ON kids.d = node.d AND kids.k = node.k
     LEFT JOIN node parent ON parent.d = node.d - 1 AND parent.k = node.p
"""

OP13 = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS r FROM documents),
each AS (SELECT doc_id, r, count(*) AS k FROM runs WHERE length(r) >= 5 GROUP BY ALL),
h AS (SELECT r, k, {crc32("coalesce(doc_id::VARCHAR, '') || ':' || r")} AS h FROM each, crc_table),
w AS (SELECT CASE WHEN h % 97 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word, k FROM h),
v AS MATERIALIZED (SELECT word, sum(k)::BIGINT AS n FROM w WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
less AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS part
  FROM (SELECT *, unnest(range(0, length(word))) AS i FROM v)),
near AS (SELECT a.word AS a, a.n AS n, b.word AS b, b.n AS bn FROM less a JOIN less b ON a.part = b.part AND a.i = b.i AND a.word <> b.word
          UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN v b ON a.part = b.word
          UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN v b ON a.part = b.word),
best AS (SELECT a, count(*) AS n_near, arg_min(b, (-bn, b)) AS b, max(bn) AS bn FROM near GROUP BY a),
form AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN bn >= 2 * v.n THEN b END AS form,
                CASE WHEN bn >= 2 * v.n THEN bn END AS form_n FROM v LEFT JOIN best ON best.a = v.word),
chain(word, last, form) AS (SELECT word, word, form FROM form
                    UNION ALL SELECT chain.word, form.word, form.form FROM chain JOIN form ON form.word = chain.form)
SELECT form.word, form.form, chain.last AS root, form.n, form.n_near::BIGINT AS n_near, form.form_n::BIGINT AS form_n
FROM form JOIN chain ON chain.word = form.word AND chain.form IS NULL
"""
