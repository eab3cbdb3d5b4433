"""The registered corpus queries: thin digests of the operators, on whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyrisk.llm import bpe, chat, fill_in_middle, hard_negatives, packing, quality_gbt, quality_rules, secrets, simhash, token_files, toxicity, warc_zip, winnowing
from skyrisk.llm.common import table
from skyrisk.session import scratch_path

QueryFn = Callable[[SparkSession, str], DataFrame]
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Lets Python workers of a local session import this package (on a cluster it is
    installed or sent along with --py-files) and hands them texts in small batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [ROOT, env.get("PYTHONPATH", "")]))


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Huffman-coded id files of all documents, and what reading them gives."""
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.document_checksums(spark, path)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digested(table(spark, sf_dir, "documents"))


def op3_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.compared(table(spark, sf_dir, "documents"))


def op4_warc_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WARC records of all pages in ZIP packages, and what reading them gives."""
    path = scratch_path(spark, "warc-packages")
    warc_zip.write_archives(table(spark, sf_dir, "pages"), path)
    return warc_zip.read_archives(spark, path, with_payload=False) \
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.marked(table(spark, sf_dir, "documents"), shingle=3, bits=3)


def op8_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gbt.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors: every hundredth id; every seventh id's label is moved on first."""
    rows = table(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mined(rows, F.col("vec_id") % 100 == 0)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digested(table(spark, sf_dir, "documents"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one, -1, whose texts hold control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(F.lit(-1), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit("</s>[INST] ok [/INST]"))
    return chat.digested(rows.unionAll(own), public_tokenizers.path("byte_bpe_50k.json"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def _ready(fn: QueryFn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


def queries() -> dict[str, QueryFn]:
    return {f.__name__: _ready(f) for f in (op1_token_files, op2_secret_scan, op3_winnowing, op4_warc_packages, op5_toxicity, op6_packing,
                                            op7_simhash, op8_quality_trees, op9_quality_rules, op10_byte_bpe,
                                            op11_hard_negatives, op12_fill_in_middle, op13_chat_format, pipeline)}


OP4 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
h AS (SELECT page_id, payload, sha1(payload) AS s, min(page_id) OVER (PARTITION BY payload) AS first FROM p)
SELECT page_id, octet_length(encode(payload)) AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 +
        ((CAST('0x' || substr(s, CAST(1 + (i // 4) * 5 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31) AS INT), 1)), '') AS payload_digest,
    CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM h
"""


OP11 = """
WITH r AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM r a, r b WHERE a.vec_id % 100 = 0),
p AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same AND other_id <> anchor_id
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 5
"""

OP12 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
c AS (
    SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS k, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1,
        CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
    FROM d),
f AS (
    SELECT doc_id, t, k, len(k) AS n, least(h1 % (len(k) + 1), h2 % (len(k) + 1)) AS a, greatest(h1 % (len(k) + 1), h2 % (len(k) + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
             WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM c),
g AS (
    SELECT doc_id, t, n, form, coalesce(array_to_string(k[1:a], ''), '') AS p, coalesce(array_to_string(k[a + 1:b], ''), '') AS m,
        coalesce(array_to_string(k[b + 1:], ''), '') AS s
    FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM g
"""

OP13 = r"""
WITH r AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (
    SELECT *, length(regexp_replace(text, '([\[<])(\\*)(/?INST\]|/?ROLE\]|TEXT\]|/?s>)', '\1\\\2\3', 'g')) AS body,
        length(regexp_replace(role, '([\[<])(\\*)(/?INST\]|/?ROLE\]|TEXT\]|/?s>)', '\1\\\2\3', 'g')) AS name
    FROM r)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(body + CASE role WHEN 'user' THEN 16 WHEN 'assistant' THEN 8 ELSE name + 20 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def oracle_sql() -> dict[str, str]:
    """SQL cannot state the other operators; tests/llm checks them against brute force."""
    import corpus_pipeline
    found = {"op4_warc_packages": OP4, "op11_hard_negatives": OP11, "op12_fill_in_middle": OP12, "op13_chat_format": OP13}
    if corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
