"""Tenants, quarantined pages and their review, stored documents."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import final_text
from ..schemas import QUARANTINE
from .summary import status


class UnknownKey(PermissionError):
    """The API key is missing or belongs to no tenant."""


def tenants(spark: SparkSession, keys: str | None = None) -> DataFrame:
    """(api_key, tenant_id) from a JSON object; without one, the development key. Broken JSON raises."""
    known = json.loads(keys) if keys else {"dev-key": "dev-tenant"}
    return spark.createDataFrame(list(known.items()) or [], "api_key string, tenant_id string")


def tenant_of(spark: SparkSession, keys: str | None, api_key: str | None) -> str:
    known = json.loads(keys) if keys else {"dev-key": "dev-tenant"}
    if not api_key or api_key not in known:
        raise UnknownKey("missing API key" if not api_key else "unknown API key")
    return known[api_key]


def with_tenant(requests: DataFrame, of_keys: DataFrame) -> DataFrame:
    """Requests whose api_key belongs to a tenant, with its tenant_id. Catalyst broadcasts the keys while they are few."""
    return requests.join(of_keys, "api_key")


def quarantine(scored: DataFrame, tenant_id: str) -> DataFrame:
    """Pending records of quarantined pages. The id comes from tenant, document and page, so that a repeated ingest replaces its records."""
    key = F.sha2(F.concat_ws("\u001f", F.lit(tenant_id), "document_id", F.col("page_num").cast("string")), 256)
    none = lambda kind: F.lit(None).cast(kind)
    df = scored.where("quality = 'quarantined'").select(
        F.left(key, F.lit(24)).alias("id"), F.lit(tenant_id).alias("tenant_id"), "document_id", "page_num", "s_fidelity", "c_retention", "t_matrix", "table_detected_in_pdf", "table_detected_in_md", "markdown",
        F.lit("pending").alias("status"), none("string").alias("reviewed_markdown"), none("string").alias("review_note"), none("timestamp").alias("reviewed_at"), F.current_timestamp().alias("created_at"),
    )
    assert df.columns == [c.split()[0] for c in QUARANTINE.split(", ")]
    return df


def records(store: DataFrame, tenant_id: str, of_status: str | None = None, document_id: str | None = None) -> DataFrame:
    """A tenant's records, oldest first; without a status or document, all of them."""
    df = store.where(F.col("tenant_id") == tenant_id)
    if of_status and of_status != "all":
        df = df.where(F.col("status") == of_status)
    if document_id:
        df = df.where(F.col("document_id") == document_id)
    return df.orderBy("created_at", "id")


def record(store: DataFrame, tenant_id: str, record_id: str) -> DataFrame:
    """One record; empty for another tenant's."""
    return store.where((F.col("tenant_id") == tenant_id) & (F.col("id") == record_id))


def reviewed(store: DataFrame, reviews: DataFrame) -> DataFrame:
    """The store after its reviews: (tenant_id, id, status, reviewed_markdown, review_note, reviewed_at), any state to any state; the latest counts.

    A review replaces text and note even when it brings none.
    """
    latest = W.partitionBy("tenant_id", "id").orderBy(F.desc("reviewed_at"), F.desc("status"))
    last = reviews.withColumn("n", F.row_number().over(latest)).where("n = 1").select("tenant_id", "id", F.struct("status", "reviewed_markdown", "review_note", "reviewed_at").alias("r"))
    df = store.join(last, ["tenant_id", "id"], "left")
    changed = ("status", "reviewed_markdown", "review_note", "reviewed_at")
    return df.select(*(F.when(F.col("r").isNotNull(), F.col(f"r.{c}")).otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in store.columns))


def approved_chunks(store: DataFrame, tenant_id: str) -> DataFrame:
    """Approved pages in the export's shape, with the reviewed text if there is one."""
    df = store.where((F.col("tenant_id") == tenant_id) & (F.col("status") == "approved"))
    meta = F.create_map(F.lit("tenant_id"), F.col("tenant_id"), F.lit("document_id"), F.col("document_id"), F.lit("page_num"), F.col("page_num").cast("string"), F.lit("source"), F.lit("approved_quarantine"), F.lit("s_fidelity"), F.col("s_fidelity").cast("string"))
    return df.select("id", final_text(F.col("reviewed_markdown"), F.col("markdown")).alias("text"), meta.alias("metadata"), F.lit(None).cast("array<float>").alias("embedding"))


def document_list(traces: DataFrame, tenant_id: str) -> DataFrame:
    """A tenant's documents, newest first."""
    df = traces.where(F.col("tenant_id") == tenant_id)
    return df.select("document_id", "ingested_at", "total_pages", "chunks_emitted", "pages_quarantined", status(F.col("pages_quarantined")).alias("status")).orderBy(F.desc("ingested_at"), "document_id")


def listing(df: DataFrame, name: str) -> dict:
    """Rows and their number as an answer to a caller, such as of quarantine records or documents."""
    rows = [r.asDict() for r in df.toLocalIterator()]
    return {"count": len(rows), name: rows}
