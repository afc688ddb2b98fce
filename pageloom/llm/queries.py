"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, html_extract, matroska, packing, pii, secrets, simhash, token_files, toxicity, warc
from .common import shared_dir


def tokenizer_path() -> str:
    """The public vocabulary that the queries name; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matroska.text_media(table(spark, sf_dir, "documents"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents"), secrets.train(secrets.samples(spark))))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_files.read_token_files(token_files.write_token_files(docs, shared_dir(spark, "token-files"), tokenizer_path()))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def held_out() -> Column:
    """Rows whose labels are not learnt."""
    return F.expr("crc32(cast(doc_id as string)) % 5 = 0")


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    return toxicity.train(docs, table(spark, sf_dir, "labels"), usable=~held_out())


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity_model(spark, docs, sf_dir)).select("doc_id", held_out().alias("held_out"), "score", F.expr("int(score >= 0.5)").alias("predicted"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.read_warc(warc.write_warc(table(spark, sf_dir, "pages"), shared_dir(spark, "warc")))
    return rows.selectExpr("key as page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {f.__name__: f for f in (op1_main_text, op2_media, op3_secrets, op4_simhash, op5_pii, op6_token_files, op7_decontamination, op8_toxicity, op9_packing, op10_warc)}
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w"

#: DuckDB's SQL; the other operators learn, hash with XXH64 or run a tokenizer, and are tested against plain versions.
ORACLE_SQL: dict[str, str] = {
    "op7_decontamination": f"""
WITH item_words AS (SELECT item_id, {_WORDS} FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[k : k + least(len(w), 10) - 1], ' ') AS s
  FROM item_words, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(k) WHERE len(w) > 0),
doc_words AS (SELECT doc_id, {_WORDS} FROM documents),
places AS (SELECT doc_id, m, k, array_to_string(w[k : k + m - 1], ' ') AS s
  FROM doc_words, (SELECT DISTINCT m FROM windows), unnest(range(1, len(w) - m + 2)) AS t(k)),
found AS (SELECT doc_id, item_id, k, m FROM places JOIN windows USING (m, s)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n FROM found, unnest(range(k, k + m)) AS t(p) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM found GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits h USING (doc_id) LEFT JOIN items i USING (doc_id)""",
    "op10_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS target FROM p GROUP BY d),
bits AS (SELECT *, list_transform(range(8), lambda g: ('0x' || substr(d, (g * 5 + 1)::INTEGER, 5))::INTEGER) AS groups FROM p JOIN f USING (d))
SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((groups[(k // 4 + 1)::INTEGER] >> (15 - 5 * (k % 4))::INTEGER) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = target THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> target THEN target END AS refers_to
FROM bits""",
}
