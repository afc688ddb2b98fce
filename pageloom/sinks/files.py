"""Records as NDJSON, tables by tenant, and stitched Markdown files."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import chunks, fidelity, review
from ..plans.ingest import Ingested, traces
from ..schemas import CHUNKS, QUARANTINE, REVIEWS, SCORED, TRACE_SPANS, without


def records(done: Ingested) -> DataFrame:
    """document_id, type and the JSON of every record of an ingest: page_fidelity, chunk, summary, fatal_error."""

    def tagged(df: DataFrame, kind: str, nested: str | None = None) -> DataFrame:
        body = F.struct(F.lit(kind).alias("type"), F.struct("*").alias(nested)) if nested else F.struct(F.lit(kind).alias("type"), "*")
        return df.select("document_id", F.lit(kind).alias("type"), F.to_json(body).alias("value"))

    out = tagged(fidelity.page_records(done.pages), "page_fidelity").unionByName(tagged(done.chunks, "chunk", "payload"))
    return out.unionByName(tagged(done.summary, "summary")).unionByName(tagged(done.errors, "fatal_error"))


def write_ndjson(done: Ingested, path: str) -> None:
    records(done).select("value").write.mode("overwrite").text(path)


BUCKETS = 64  #: folders of a tenant in each table, by a hash of the document's id
TABLES = {
    "chunks": CHUNKS, "pages": SCORED, "markdown": "document_id string, markdown string", "sources": "document_id string, content binary",
    "traces": without(TRACE_SPANS, "tenant_id"), "quarantine": without(QUARANTINE, "tenant_id"),
}


def bucket(document_id: Column) -> Column:
    return F.pmod(F.xxhash64(document_id), F.lit(BUCKETS)).cast("int")


def save(done: Ingested, root: str, tenant_id: str, sources: DataFrame | None = None, elapsed_ms: float = 0.0) -> None:
    """Append an ingest to the tables under ``root``, by tenant and bucket; ``sources`` (document_id, content) are kept too.

    Each save has a number, and the rows of the last number that ``traces`` has for a document are its current ones, so a
    repeated ingest replaces its documents whole, with nothing left of what they no longer have. Traces come last: readers
    see a document's new rows all at once. Reviews are a table of their own and outlast ingests.
    """
    spark = done.pages.sparkSession
    known = read(spark, root, "traces", tenant_id, every=True).agg(F.max("saved")).first()[0]
    number = max(time.time_ns(), (known or 0) + 1)
    tables = {"chunks": done.chunks, "pages": done.pages, "markdown": chunks.stitch(done.chunks), "quarantine": review.quarantine(done.pages, tenant_id)}
    tables |= {"sources": sources} if sources is not None else {}
    for name, df in (tables | {"traces": traces(done, tenant_id, elapsed_ms)}).items():
        columns = [c.split()[0] for c in TABLES[name].split(", ")]
        df = df.select(*columns, F.lit(number).alias("saved"), F.lit(tenant_id).alias("tenant_id"), bucket(F.col("document_id")).alias("bucket"))
        df.repartition("bucket").write.mode("append").partitionBy("tenant_id", "bucket").parquet(f"{root}/{name}")


def read(spark: SparkSession, root: str, name: str, tenant_id: str, document_id: str | None = None, every: bool = False) -> DataFrame:
    """A tenant's current rows of a table, none if there is no table yet; ``every``: all that was ever saved, with its number.

    The tenant is a partition, so other tenants' files are never opened, and one document's are in one folder of it.
    """
    df = _table(spark, root, name, f"{TABLES[name]}, saved long").where(F.col("tenant_id") == tenant_id)
    if document_id is not None:
        df = df.where((F.col("bucket") == bucket(F.lit(document_id))) & (F.col("document_id") == document_id))
    if every:
        return df.drop("bucket")
    last = _table(spark, root, "traces", "document_id string, saved long").where(F.col("tenant_id") == tenant_id)
    last = last.groupBy("document_id").agg(F.max("saved").alias("saved"))
    return df.join(last, ["document_id", "saved"], "left_semi").select(*(c.split()[0] for c in TABLES[name].split(", ")), "tenant_id")


def add_reviews(reviews: DataFrame, root: str) -> None:
    """Append reviews (tenant_id, id, status, reviewed_markdown, review_note, reviewed_at)."""
    reviews.select(*(c.split()[0] for c in REVIEWS.split(", ")), "tenant_id").write.mode("append").partitionBy("tenant_id").parquet(f"{root}/reviews")


def quarantined(spark: SparkSession, root: str, tenant_id: str) -> DataFrame:
    """A tenant's current quarantine records after their reviews, which a repeated ingest does not undo."""
    reviews = _table(spark, root, "reviews", REVIEWS).where(F.col("tenant_id") == tenant_id)
    return review.reviewed(read(spark, root, "quarantine", tenant_id), reviews)


def audit_report(spark: SparkSession, root: str, tenant_id: str, document_id: str) -> DataFrame:
    """The page reports of a stored document."""
    return fidelity.page_records(read(spark, root, "pages", tenant_id, document_id)).orderBy("page_num")


def source_file(spark: SparkSession, root: str, tenant_id: str, document_id: str) -> bytes | None:
    """The stored file of a document."""
    row = read(spark, root, "sources", tenant_id, document_id).first()
    return bytes(row["content"]) if row and row["content"] is not None else None


def _table(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    whole = f"{schema}, tenant_id string" + ("" if name == "reviews" else ", bucket int")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(f"{root}/{name}")
