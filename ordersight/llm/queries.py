"""The queries of this subpackage over the given tables, and the SQL that restates them."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import chat, decontam, langid, lm_score, near_text, pack, prefix_trie, quality, sharding, spill_counts, token_files, toxicity, vectors
from .common import held_out, read, scratch

N_SHARDS = 40


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.pack(read(spark, sf_dir, "documents"), tokenizer_path()).drop("ids")


def op2_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target corpus: the documents labelled as of good quality."""
    good = read(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return lm_score.cross_entropy_difference(read(spark, sf_dir, "documents"), good)


def op3_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(read(spark, sf_dir, "embeddings"))


def op4_deobfuscated_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F
    docs = read(spark, sf_dir, "documents")
    out = langid.identify(docs, langid.fit(docs))
    return out.select("doc_id", held_out(F.col("doc_id"), langid.FOLDS, langid.TEST_FOLD).alias("held_out"), "lang_pred", "score")


def op5_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_text.near_duplicates(read(spark, sf_dir, "documents"))


def op9_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(read(spark, sf_dir, "conversations"))


def op10_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F
    out = sharding.place(read(spark, sf_dir, "documents"), N_SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard", "region", "rack")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(read(spark, sf_dir, "conversations"))


def op12_spill_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spill_counts.alignment(read(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "token-files")
    token_files.write(read(spark, sf_dir, "documents"), folder, tokenizer_path("word_bpe_49k.json"), end_id=1)
    return token_files.documents(spark, folder, with_ids=False)


OP9_SQL = """
WITH said AS (
  SELECT conv_id, turn, coalesce(nullif(trim(coalesce(role, ''), ' '), ''), 'unknown') AS speaker, coalesce(text, '') AS body
  FROM conversations),
people AS (SELECT DISTINCT conv_id, speaker AS participant FROM said WHERE speaker <> 'system'),
seen AS (
  SELECT s.conv_id, p.participant, s.turn, s.speaker, md5(s.body) AS k,
         CASE WHEN s.speaker = 'system' THEN 'system' WHEN s.speaker = p.participant THEN 'assistant' ELSE 'user' END AS role_out,
         replace(s.body, '<|', '<||') AS body
  FROM said s JOIN people p ON s.conv_id IS NOT DISTINCT FROM p.conv_id),
made AS (
  SELECT *, '<|im_start|>' || role_out || CASE WHEN role_out = 'user'
           THEN ' name=' || regexp_replace(replace(speaker, '<|', '<||'), '\\s+', ' ', 'g') ELSE '' END || chr(10) AS header
  FROM seen),
sized AS (SELECT *, header || body || '<|im_end|>' || chr(10) AS rendered FROM made)
SELECT conv_id, participant, row_number() OVER w AS position, turn, speaker, role_out, rendered,
       CAST(sum(length(rendered)) OVER w - length(rendered) AS BIGINT) AS "start", length(rendered) AS "length",
       CAST(sum(length(rendered)) OVER w - length(rendered) + CASE WHEN role_out = 'assistant' THEN length(header) ELSE 0 END AS BIGINT) AS mask_start,
       CAST(CASE WHEN role_out = 'assistant' THEN length(rendered) - length(header) - 1 ELSE 0 END AS BIGINT) AS mask_length
FROM sized
WINDOW w AS (PARTITION BY conv_id, participant ORDER BY turn NULLS FIRST, speaker, k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""

#: crc32 bit by bit over the digits; prefixes as lists, ancestors by cutting them.
OP11_SQL = """
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS who, coalesce(text, '') AS body,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT c, 4294967295 - list_reduce(
           list_prepend(4294967295, flatten(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda d: [256 + CAST(unicode(d) AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0]))),
           lambda s, x: CASE WHEN x >= 256 THEN xor(s, x - 256) ELSE xor(s >> 1, 3988292384 * (s & 1)) END) AS crc
  FROM (SELECT DISTINCT c FROM turns)),
plan AS (SELECT c, CAST(crc % 4 AS BIGINT) AS h, c - c % 20 AS base FROM ids),
parts AS (
  SELECT p.c, 0 AS later, t.place, t.who, t.body FROM plan p JOIN turns t ON t.c = p.base AND t.place <= p.h
  UNION ALL SELECT p.c, 1, t.place, t.who, t.body FROM plan p JOIN turns t ON t.c = p.c AND t.place > p.h),
whole AS (
  SELECT p.c, coalesce(list({'who': q.who, 'body': q.body} ORDER BY q.later, q.place) FILTER (WHERE q.c IS NOT NULL), []) AS said
  FROM plan p LEFT JOIN parts q ON q.c = p.c GROUP BY p.c),
members AS (SELECT c, d, said[1:d] AS prefix, d = len(said) AS ends FROM (SELECT c, said, unnest(range(0, len(said) + 1)) AS d FROM whole)),
nodes AS (
  SELECT prefix, d, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
  FROM members GROUP BY prefix, d),
kids AS (SELECT prefix[1:d - 1] AS top, d - 1 AS top_d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
own AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children,
         CASE WHEN n.d = 0 THEN 0 ELSE (n.n_convs - 1) * len(regexp_extract_all(n.prefix[n.d].body, '[^\x20\x09-\x0D]+')) END AS saved
  FROM nodes n LEFT JOIN kids k ON k.top = n.prefix AND k.top_d = n.d),
below AS (
  SELECT prefix[1:e] AS top, e AS top_d, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT prefix, n_children, saved, unnest(range(0, d + 1)) AS e FROM own) GROUP BY ALL)
SELECT o.conv_id, CAST(o.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(o.n_convs AS BIGINT) AS n_convs, CAST(o.n_children AS BIGINT) AS n_children,
       CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, o.ends_sha256
FROM own o JOIN below b ON b.top = o.prefix AND b.top_d = o.d
LEFT JOIN nodes p ON o.d > 0 AND p.d = o.d - 1 AND p.prefix = o.prefix[1:o.d - 1]
"""


def queries() -> dict:
    return {"op1_hilbert_packing": op1_hilbert_packing, "op2_cross_entropy": op2_cross_entropy, "op3_pruned_graph": op3_pruned_graph,
            "op4_deobfuscated_toxicity": op4_deobfuscated_toxicity,
            "op5_spaced_seeds": op5_spaced_seeds, "op6_ftrl_quality": op6_ftrl_quality, "op7_crf_language": op7_crf_language,
            "op8_order_minhash": op8_order_minhash, "op9_perspective_rotation": op9_perspective_rotation, "op10_hash_tree": op10_hash_tree,
            "op11_prefix_trie": op11_prefix_trie, "op12_spill_counts": op12_spill_counts, "op13_token_files": op13_token_files}


def oracle_sql() -> dict[str, str]:
    return {"op9_perspective_rotation": OP9_SQL, "op11_prefix_trie": OP11_SQL}
