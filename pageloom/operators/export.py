"""Embeddings and export to vector stores."""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable, Iterable
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import vector_literal
from ..session import prepare

Post = Callable[[str, str, dict, dict], dict]


def http(method: str, url: str, body: dict, headers: dict, timeout: float = 30.0) -> dict:
    """Send JSON and return JSON; a status of 300 or more raises."""
    request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json", **headers}, method=method)
    with urllib.request.urlopen(request, timeout=timeout) as answer:
        data = answer.read()
        if answer.status >= 300:
            raise OSError(f"{url}: status {answer.status}")
    return json.loads(data) if data.strip() else {}


class Embedder(Protocol):
    dimensions: int

    def embed(self, texts: list[str]) -> list[list[float] | None]: ...


class NullEmbedder:
    """No vectors."""

    dimensions = 0

    def embed(self, texts: list[str]) -> list[list[float] | None]:
        return [None] * len(texts)


class HTTPEmbedder:
    """An endpoint of the common embeddings shape: {model, input} in, {data: [{embedding}]} out."""

    def __init__(self, url: str, model: str, api_key: str = "", dimensions: int = 0):
        self.url, self.model, self.api_key, self.dimensions = url, model, api_key, dimensions

    def embed(self, texts: list[str]) -> list[list[float] | None]:
        headers = {"Authorization": f"Bearer {self.api_key}"} if self.api_key else {}
        data = http("POST", self.url, {"model": self.model, "input": texts}, headers).get("data", [])
        if len(data) != len(texts):
            raise ValueError(f"{len(data)} vectors for {len(texts)} texts")
        return [x["embedding"] for x in data]


def embed_missing(chunks: DataFrame, embedder: Embedder, batch: int = 128) -> DataFrame:
    """Fill in only the missing vectors, up to ``batch`` texts to a call; a wrong number of vectors raises."""
    prepare(chunks.sparkSession)
    at, text = chunks.columns.index("embedding"), chunks.columns.index("text")

    def fill(batches):
        import pyarrow as pa

        for b in batches:
            vectors, texts = b.column(at).to_pylist(), b.column(text).to_pylist()
            missing = [k for k, v in enumerate(vectors) if not v]
            for k in range(0, len(missing), batch):
                part = missing[k : k + batch]
                new = embedder.embed([texts[i] for i in part])
                if len(new) != len(part):
                    raise ValueError(f"{len(new)} vectors for {len(part)} texts")
                for i, v in zip(part, new, strict=True):
                    vectors[i] = v
            yield b.set_column(at, b.schema.field(at), pa.array(vectors, b.schema.field(at).type))

    return chunks.mapInArrow(fill, chunks.schema)


def payload(text: str, metadata: dict | None) -> dict:
    """The text and the metadata, which wins."""
    return {"text": text, **(metadata or {})}


def placeholder(vector: list[float] | None, dimensions: int) -> list[float]:
    """A missing vector as zeros of the collection's size, at least one."""
    return list(vector) if vector else [0.0] * max(1, dimensions)


class QdrantExporter:
    name = "qdrant"

    def __init__(self, url: str, collection: str, api_key: str = "", dimensions: int = 0):
        self.url, self.collection, self.dimensions = url.rstrip("/"), collection, dimensions
        self.headers = {"api-key": api_key} if api_key else {}

    def prepare(self) -> None:
        http("PUT", f"{self.url}/collections/{self.collection}", {"vectors": {"size": max(1, self.dimensions), "distance": "Cosine"}}, self.headers)

    def upsert(self, rows: list[dict]) -> None:
        points = [{"id": r["id"], "vector": placeholder(r["embedding"], self.dimensions), "payload": payload(r["text"], r["metadata"])} for r in rows]
        http("PUT", f"{self.url}/collections/{self.collection}/points?wait=true", {"points": points}, self.headers)


class PineconeExporter:
    name = "pinecone"

    def __init__(self, host: str, api_key: str, namespace: str = "", dimensions: int = 0):
        if not host or not api_key:
            raise ValueError("a host and an API key are needed")
        self.host = host if "://" in host else f"https://{host}"
        self.headers, self.namespace, self.dimensions = {"Api-Key": api_key}, namespace, dimensions

    def prepare(self) -> None:
        """Indexes are made beforehand."""

    def upsert(self, rows: list[dict]) -> None:
        body: dict = {"vectors": [{"id": r["id"], "values": placeholder(r["embedding"], self.dimensions), "metadata": payload(r["text"], r["metadata"])} for r in rows]}
        if self.namespace:
            body["namespace"] = self.namespace
        http("POST", f"{self.host}/vectors/upsert", body, self.headers)


class PgvectorExporter:
    """Upserts by way of any DB-API connection; each call is one transaction."""

    name = "pgvector"

    def __init__(self, connect: Callable, table: str = "rag_chunks", dimensions: int = 0):
        if not all(map(_identifier, table.split("."))):
            raise ValueError(f"not a table name: {table}")
        self.connect, self.dimensions = connect, dimensions
        self.table = ".".join(f'"{x}"' for x in table.split("."))

    def ddl(self) -> list[str]:
        kind = f"VECTOR({self.dimensions})" if self.dimensions else "VECTOR"
        return ["CREATE EXTENSION IF NOT EXISTS vector", f"CREATE TABLE IF NOT EXISTS {self.table} (id TEXT PRIMARY KEY, text TEXT NOT NULL, metadata JSONB NOT NULL DEFAULT '{{}}', embedding {kind})"]

    def prepare(self) -> None:
        self._run([(x, ()) for x in self.ddl()])

    def upsert(self, rows: list[dict]) -> None:
        sql = f"INSERT INTO {self.table} (id, text, metadata, embedding) VALUES (%s, %s, %s, %s) ON CONFLICT (id) DO UPDATE SET text = EXCLUDED.text, metadata = EXCLUDED.metadata, embedding = EXCLUDED.embedding"
        self._run([(sql, (r["id"], r["text"], json.dumps(r["metadata"] or {}), r["vector_text"])) for r in rows])

    def _run(self, statements: Iterable[tuple]) -> None:
        connection = self.connect()
        try:
            cursor = connection.cursor()
            for sql, values in statements:
                cursor.execute(sql, values)
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.close()


def _identifier(x: str) -> bool:
    return x.isascii() and x.isidentifier()


def check_dimensions(chunks: DataFrame, dimensions: int) -> DataFrame:
    """Ids of chunks whose vector has another size than ``dimensions``."""
    return chunks.where(F.col("embedding").isNotNull() & (F.size("embedding") != dimensions)).select("id", F.size("embedding").alias("dims"))


def export(chunks: DataFrame, exporter, embedder: Embedder | None = None, batch: int = 256) -> dict:
    """Fill in vectors, then upsert from the executors, ``batch`` rows to a call. An upsert is idempotent, so a repeated task does no harm."""
    if chunks.isEmpty():
        raise ValueError("no chunks to export")
    embedder = embedder or NullEmbedder()
    exporter.prepare()
    filled = embed_missing(chunks, embedder).withColumn("vector_text", vector_literal(F.col("embedding")))

    def write(batches):
        import pyarrow as pa

        part, n = [], 0
        for b in batches:
            for row in b.to_pylist():
                part.append(row | {"metadata": dict(row["metadata"] or [])})
                if len(part) == batch:
                    exporter.upsert(part)
                    n, part = n + len(part), []
        if part:
            exporter.upsert(part)
        yield pa.RecordBatch.from_pydict({"n": pa.array([n + len(part)], pa.int64())})

    done = filled.mapInArrow(write, "n long").agg(F.sum("n")).first()[0]
    return {"target": exporter.name, "chunks_exported": done, "embedder": type(embedder).__name__}


def export_rows(chunks: DataFrame, approved: DataFrame | None = None) -> DataFrame:
    """The request's chunks and the approved pages, in one shape; missing metadata is empty."""
    shape = ["id", "text", "metadata", "embedding"]
    df = chunks.select(shape)
    if approved is not None:
        df = df.unionByName(approved.select(shape))
    return df.withColumn("metadata", F.coalesce("metadata", F.create_map().cast("map<string,string>")))
