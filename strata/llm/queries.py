"""Queries of the training-data operators, one per operator, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import chat, decontam, langid, mixing, ngram_join, oracles, pii, prefix_trie, quality, secrets, sharding, spelling, substring_dedup, suffix_dedup
from strata.llm.common import read

QUERIES = {}
ORACLES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    found = langid.identify(docs.withColumn("held_out", held_out), ~F.col("held_out"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op9_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    done = chat.format_preferences(chat.swapped_reply_pairs(chat.gather_turns(rows)))
    spans = lambda c: F.concat_ws(",", F.transform(c, lambda s: F.concat_ws(":", s["start"], s["end"])))
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return done.select("conv_id", F.col("n_common").cast("long").alias("n_common"), "same",
                       sha("prompt").alias("prompt_sha256"),
                       sha("chosen_text").alias("chosen_sha256"), sha("rejected_text").alias("rejected_sha256"),
                       spans("chosen_mask").alias("chosen_mask"), spans("rejected_mask").alias("rejected_mask"))


ORACLES["op9_preference_format"] = """
WITH turns AS (
  SELECT conv_id, turn, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)),
lasts AS (SELECT conv_id, max(n) AS n, max(CASE WHEN role = 'assistant' THEN i END) AS last_i FROM turns GROUP BY conv_id),
pairs AS (
  SELECT l.conv_id, l.n, coalesce(l.last_i - 1, l.n) AS kept,
         coalesce(t.text, '') AS reply, t.conv_id IS NOT NULL AS has_reply, t.text AS raw_reply
  FROM lasts l
  LEFT JOIN lasts p ON p.conv_id = xor(l.conv_id, 1)
  LEFT JOIN turns t ON t.conv_id = p.conv_id AND t.i = p.last_i),
common AS (
  SELECT p.*, CASE WHEN t.i IS NOT NULL
                    AND t.text IS NOT DISTINCT FROM (CASE WHEN has_reply THEN raw_reply ELSE '' END)
              THEN kept + 1 ELSE kept END AS n_common
  FROM pairs p LEFT JOIN turns t ON t.conv_id = p.conv_id AND t.i = p.kept + 1),
parts AS (
  SELECT c.conv_id, t.i, t.i <= c.n_common AS shared,
         '<|im_start|>' || coalesce(t.role, '') || chr(10) || coalesce(t.text, '') || '<|im_end|>' || chr(10) AS r,
         length('<|im_start|>' || coalesce(t.role, '') || chr(10)) AS head,
         length(coalesce(t.text, '') || '<|im_end|>') AS body, coalesce(t.role = 'assistant', false) AS own
  FROM common c JOIN turns t USING (conv_id)),
placed AS (
  SELECT *, coalesce(sum(length(r)) OVER (PARTITION BY conv_id, shared ORDER BY i
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM parts),
chosen AS (
  SELECT conv_id,
         coalesce(string_agg(r, '' ORDER BY i) FILTER (WHERE shared), '') AS prompt,
         coalesce(string_agg(r, '' ORDER BY i) FILTER (WHERE NOT shared), '') AS txt,
         coalesce(string_agg((off + head)::BIGINT || ':' || (off + head + body)::BIGINT, ',' ORDER BY i)
                  FILTER (WHERE NOT shared AND own), '') AS mask
  FROM placed GROUP BY conv_id)
SELECT c.conv_id, c.n_common::BIGINT AS n_common, c.n_common = c.n AND c.n_common = c.kept + 1 AS same,
       sha256(h.prompt) AS prompt_sha256, sha256(h.txt) AS chosen_sha256,
       sha256(CASE WHEN c.n_common > c.kept THEN '' ELSE
         '<|im_start|>assistant' || chr(10) || c.reply || '<|im_end|>' || chr(10) END) AS rejected_sha256,
       h.mask AS chosen_mask,
       CASE WHEN c.n_common > c.kept THEN '' ELSE
         '22:' || (22 + length(c.reply || '<|im_end|>')) END AS rejected_mask
FROM common c JOIN chosen h USING (conv_id)
"""


ORACLES.update({"op1_suffix_array_dedup": oracles.OP1, "op3_secret_scan": oracles.OP3, "op5_substring_dedup": oracles.OP5,
                "op6_quality_rules": oracles.OP6, "op8_ngram_jaccard_join": oracles.OP8, "op11_prefix_trie": oracles.OP11,
                "op12_byte_shards": oracles.OP12, "op13_spelling_variants": oracles.OP13})


@query
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeated_bytes(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeated_words(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = secrets.scan(docs)
    of_kind = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id", of_kind(0).alias("n_assign"), of_kind(1).alias("n_access"), of_kind(2).alias("n_hex"),
        F.sha2(secrets.span_list(base).cast("binary"), 256).alias("base_sha256"),
        secrets.span_list(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"))


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = quality.judge(docs, read(spark, sf_dir, "labels").select("doc_id", "quality"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


@query
def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace(docs).select("doc_id", "n_entities", "text")


@query
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_groups(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.find_leaks(docs, read(spark, sf_dir, "benchmark").select("item_id", "text"))


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turns_of(read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    nodes = prefix_trie.build(*prefix_trie.graft_heads(turns))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@query
def op12_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = sharding.assign(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling.letter_runs(read(spark, sf_dir, "documents").select("doc_id", "text"))
    counted = spelling.count_words(spelling.drop_letters(runs.filter(F.length("word") >= 5)))
    return spelling.group_variants(counted)
