"""The registered queries ``opN_<name>`` and their DuckDB twins.

Each query applies its operator with production parameters to its whole table
and derives the digest columns of its contract.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarmetrics.llm import bpe, chat, decontaminate, hardneg, importance, langid, licenses, neardup, perplexity, quality, sharding, suffixdedup, warc
from scholarmetrics.llm.common import cut, load

#: Vocabulary of operator 1 (a parameter; never copied into the repository).
BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BPE_PATTERN = public_tokenizers.PATTERN


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_decode(docs, BPE_RANKS, BPE_PATTERN).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(bpe.ids_text("ids"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(load(spark, sf_dir, "documents").select("doc_id", "text"))
    base, more = F.col("places.label"), F.col("matches.label")
    label_list = lambda c: F.array_join(F.sort_array(F.array_distinct(c)), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.word").alias("first_word"),
        F.array_max("places.word").alias("last_word"),
        label_list(base).alias("base_labels"),
        label_list(F.concat(base, more)).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max("matches.share"), F.lit(0.0))).alias("score"),
    )


def op3_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    rows = cut(quality.add_stats(docs).drop("text"))
    return quality.judge(rows, quality.fit(rows)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


def op4_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op5_bigru_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_held_out(load(spark, sf_dir, "documents"))


def op6_bottomk_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.group(load(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, load(spark, sf_dir, "benchmark")).drop("text")
    share = F.transform("found", lambda x: x["shared"] / x["size"])
    return found.select(
        "doc_id",
        F.size("found").cast("long").alias("n_items"),
        F.col("found.item_id").alias("item_ids"),
        F.coalesce(F.array_max(share), F.lit(0.0)).alias("containment"),
        (F.size("found") == 0).alias("kept"),
    )


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return suffixdedup.dedup(docs).select(
        "doc_id",
        n_bytes.alias("n_bytes"),
        (n_bytes - F.octet_length("kept")).alias("n_removed"),
        F.coalesce(F.size("begins"), F.lit(0)).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op9_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    judged = perplexity.classify(docs, load(spark, sf_dir, "labels"))
    return judged.select("doc_id", "lang", "n_symbols", "perplexity", "threshold", "kept")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write(load(spark, sf_dir, "pages"))
    return warc.read(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format(turns.unionByName(own)), ordered=True)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = load(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hardneg.quantized(vectors, label_of=label)
    return hardneg.mine(rows, F.col("id") % hardneg.ANCHOR_EVERY == 0)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_license_scan": op2_license_scan,
    "op3_quality_mcd": op3_quality_mcd,
    "op4_minimax_shards": op4_minimax_shards,
    "op5_bigru_langid": op5_bigru_langid,
    "op6_bottomk_neardup": op6_bottomk_neardup,
    "op7_decontaminate": op7_decontaminate,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_kneser_ney": op9_kneser_ney,
    "op10_warc": op10_warc,
    "op11_chat_format": op11_chat_format,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_importance_resampling": op13_importance_resampling,
}


# --- DuckDB twins ------------------------------------------------------------------------

_OP10 = """
WITH p AS (SELECT page_id, COALESCE(html, '') AS body FROM pages),
d AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest FROM p),
f AS (SELECT payload_digest, max(page_id) AS first FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN f.first IS NULL OR f.first = d.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f.first <> d.page_id THEN f.first END AS refers_to
FROM d LEFT JOIN f ON d.payload_bytes >= 1000 AND d.payload_digest = f.payload_digest
"""

_OP11 = r"""
WITH c AS (
    SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e AS (
    SELECT *, regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\1\\|', 'g') AS role_out,
           regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') AS text_out,
           CASE WHEN role = 'assistant' THEN text ELSE '' END AS learned FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(length(learned)) AS BIGINT) AS loss_chars,
       sha256(string_agg(learned, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       CAST(sum(length('<|im_start|>') + length(role_out) + 1 + length(text_out) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

_OP12 = """
WITH v AS (
    SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
      AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
s AS (
    SELECT a.id AS anchor_id, b.id, a.label = b.label AS same,
           CAST(list_dot_product(CAST(a.vec AS DOUBLE[]), CAST(b.vec AS DOUBLE[])) AS BIGINT) AS score
    FROM v a JOIN v b ON a.id <> b.id WHERE a.id % 50 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
       s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
WHERE 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""

# CRC-32 of every distinct feature, byte by byte from a table that is made by rule
_OP13 = r"""
WITH t AS (
    SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
        lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS crc_of),
w AS (
    SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
    UNION ALL
    SELECT 'b', item_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
f AS (
    SELECT kind, id, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) AS feature FROM w),
g AS (SELECT DISTINCT feature, hex(encode(feature)) AS h FROM f),
b AS (
    SELECT feature, CAST(xor(list_reduce(
        list_prepend(4294967295, list_transform(range(len(h) // 2), lambda i: CAST('0x' || h[2 * i + 1 : 2 * i + 2] AS BIGINT))),
        lambda c, x: xor(c // 256, crc_of[xor(c % 256, x) + 1])), 4294967295) % 10000 AS BIGINT) AS bucket FROM g, t),
n AS (SELECT f.kind, f.id, b.bucket, count(*) AS n FROM f JOIN b ON f.feature = b.feature GROUP BY ALL),
a AS (SELECT sum(n) FILTER (kind = 'd') AS s_all, COALESCE(sum(n) FILTER (kind = 'b'), 0) AS t_all FROM n),
k AS (
    SELECT bucket, COALESCE(sum(n) FILTER (kind = 'd'), 0) AS s, COALESCE(sum(n) FILTER (kind = 'b'), 0) AS t FROM n GROUP BY bucket),
gain AS (
    SELECT bucket, CAST(floor(1000 * ln((CAST(t + 1 AS DOUBLE) * CAST(s_all + 10000 AS DOUBLE))
                                        / (CAST(s + 1 AS DOUBLE) * CAST(t_all + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM k, a),
m AS (SELECT n.id, sum(n.n) AS n, sum(n.n * gain.gain) AS total FROM n JOIN gain ON n.bucket = gain.bucket WHERE n.kind = 'd' GROUP BY n.id),
r AS (
    SELECT w.id AS doc_id, len(w.words) AS n_words, CAST(COALESCE(m.n, 0) AS BIGINT) AS n_features,
           CAST(COALESCE((m.total - ((m.total % m.n) + m.n) % m.n) // m.n, 0) AS BIGINT) AS weight,
           CAST('0x' || substr(sha256('7:' || CAST(w.id AS VARCHAR)), 1, 8) AS BIGINT) AS h
    FROM w LEFT JOIN m ON w.id = m.id WHERE w.kind = 'd'),
c AS (
    SELECT *, weight + CAST(floor(-1000 * ln(-ln((CAST(h AS DOUBLE) + 0.5) / 4294967296.0))) AS BIGINT) AS score FROM r),
o AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, 25 * count(*) OVER () // 100 AS most FROM c WHERE n_words >= 20)
SELECT c.doc_id, c.n_features, c.weight, c.score, CASE WHEN o.place <= o.most THEN o.place END AS rank
FROM c LEFT JOIN o ON c.doc_id = o.doc_id
"""

ORACLE_SQL: dict[str, str] = {
    "op10_warc": _OP10,
    "op11_chat_format": _OP11,
    "op12_hard_negatives": _OP12,
    "op13_importance_resampling": _OP13,
}
