"""The registered queries of this subpackage, bound to the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bottomk, html_blocks, langid, mixing, negatives, packing, pii, prefix_trie, quality,
               secrets, sentencepieces, simhash, topk)
from .common import id_hash_bucket, read_table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3-word shingles, links at 2 or fewer differing bits."""
    out = simhash.near_duplicate_groups(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


@register
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article text of every page."""
    return html_blocks.extract(read_table(spark, sf_dir, "pages"))


@register
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-mail, IP, card and phone spans, and the boosted trees' additions."""
    return pii.find_personal_data(read_table(spark, sf_dir, "documents"))


@register
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from labels with crc32(doc_id) mod 5 other than 0; scores all rows."""
    docs = read_table(spark, sf_dir, "documents")
    held = F.coalesce(id_hash_bucket(F.col("doc_id"), 5) == 0, F.lit(False))
    labels = read_table(spark, sf_dir, "labels").where(~held).select("doc_id", F.col("quality").alias("label"))
    scored = quality.score(docs, quality.train(docs, labels, cut=0.3))
    return scored.select("doc_id", held.alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@register
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens of ``word_bpe_49k.json``, end id 1."""
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), capacity=4096, end_id=1)


@register
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed formats and values of at least 10^10 guesses."""
    return secrets.find_secrets(read_table(spark, sf_dir, "documents"))


#: shares of the tokens after mixing, by domain of the ``labels`` table
MIX_WEIGHTS = {"clean": 0.97, "low": 0.02, "toxic": 0.01}


def label_domains(labels: DataFrame) -> DataFrame:
    """``doc_id, domain`` of the labelled documents."""
    return labels.where("quality is not null and toxic is not null").select("doc_id", F.expr(
        "CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'clean' ELSE 'low' END").alias("domain"))


@register
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates that bring clean, low and toxic text to 97, 2 and 1 percent of the
    tokens, clean text keeping its tokens."""
    table, domains = mixing.mix(read_table(spark, sf_dir, "documents"),
                                label_domains(read_table(spark, sf_dir, "labels")), MIX_WEIGHTS, "clean")
    return table.select("doc_id", "tokens", *[F.col("p")[k].alias(f"p_{d}") for k, d in enumerate(domains)],
                        "rate", (F.col("tokens") * F.col("rate")).alias("expected_tokens"))


@register
def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-64 sketches of 5-word shingles of each text, edited and next."""
    rows = bottomk.edited_and_next(read_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        bottomk.sketch_text(F.col("sketch")).alias("fingerprint"),
        bottomk.sketch_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        bottomk.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        bottomk.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        bottomk.distinct_shingles(F.col("sketch")).alias("shingles"))


@register
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from rows with crc32(doc_id) mod 4 other than 2; scores all rows."""
    docs = read_table(spark, sf_dir, "documents")
    held = F.coalesce(id_hash_bucket(F.col("doc_id"), 4) == 2, F.lit(False))
    model = langid.train(docs.where(~held))
    return (langid.predict(docs, model)
            .select("doc_id", held.alias("held_out"), "lang_pred", "score", "accepted"))


@register
def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best of every vector whose id is divisible by 50, against all others."""
    return topk.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@register
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of other labels that score from 80 to 100 percent of a positive's
    score, for anchors whose id is divisible by 100; labels of ids divisible by
    7 are moved on by one first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(read_table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


@register
def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of ``piece_bpe_32k.model`` and the text they decode to."""
    rows = sentencepieces.encode_and_decode(read_table(spark, sf_dir, "documents"), ["doc_id"])
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


@register
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of conversations with shared heads."""
    turns = prefix_trie.ordered_turns(read_table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(*prefix_trie.share_heads(turns))


ORACLES["op10_exact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
  FROM embeddings
  WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.ints, c.ints), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

ORACLES["op11_hard_negatives"] = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    CAST(list_sum(list_transform(list_zip(a.ints, c.ints), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a, v c WHERE a.vec_id % 100 = 0 AND NOT (c.vec_id = a.vec_id AND c.ints = a.ints AND c.label = a.label)),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY rank <= 5"""

ORACLES["op13_conversation_trie"] = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
    xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
        lambda d: CAST(ascii(d) AS BIGINT))),
      lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
        lambda r, i: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END)), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.pos, t.role, t.text FROM c JOIN t USING (conv_id) WHERE t.pos > c.h),
s AS (
  SELECT c.conv_id, coalesce(list({'role': role, 'text': text} ORDER BY part, pos) FILTER (part IS NOT NULL), []) AS turns
  FROM c LEFT JOIN rebuilt USING (conv_id) GROUP BY c.conv_id),
m AS (SELECT conv_id, turns[1:d] AS node, d, len(turns) = d AS ends
      FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM s)),
n AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
    (count(*) - 1) * coalesce(length(node[-1].text), 0) AS own
  FROM m GROUP BY node, d),
k AS (SELECT node[1:d - 1] AS node, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2),
l AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k USING (node, d)),
u AS (SELECT node[1:a] AS node, a AS d, count(*) FILTER (n_children = 0) AS n_leaves, sum(own) AS saved_tokens
      FROM (SELECT *, unnest(range(d + 1)) AS a FROM l) GROUP BY 1, 2)
SELECT l.conv_id, l.d AS depth, p.conv_id AS parent_conv_id, l.n_convs, l.n_children, u.n_leaves,
  CAST(u.saved_tokens AS BIGINT) AS saved_tokens, l.ends_sha256
FROM l JOIN u ON u.node = l.node AND u.d = l.d LEFT JOIN n p ON l.d > 0 AND p.d = l.d - 1 AND p.node = l.node[1:l.d - 1]"""
