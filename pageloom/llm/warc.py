"""WARC archives: a deterministic sharded writer, and a reader.

The records are range-sorted by key into shards that depend on the keys and payload sizes alone, so that neither many
nor large records make one task long; one task writes a shard and rolls to the next file when the compressed size passes
a bound. Every record is a gzip member of its own. Headers and digests are
made anew from the payload. Files get their names only when whole, and a manifest commits the archive.

Of records with equal payloads of at least ``min_bytes`` bytes, the one with the smallest key is a response and the
others are revisits, which hold headers but no payload; smaller payloads are always responses.

Rows: a null payload is an empty one and a null URL an empty one. Rows with a null key sort first and are responses.
Rows that repeat the smallest key with the same payload are all responses. An empty table gives no files. Other columns
are neither read nor written.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import AtomicFile, cut, filesystem, prepare, range_shard, rows_of

MANIFEST = "shard int, part int, file string, first_key long, last_key long, n_records long, n_bytes long, sha256 string"
NAMESPACE = uuid.UUID("6f1d9c1e-8a52-5d0b-9b0e-3d8b8d1c7a10")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _one_line(text: str) -> str:
    return "".join(c if c > "\x1f" and c != "\x7f" else "%%%02X" % ord(c) for c in text)


def record(key: int | None, url: str, payload: bytes, refers_to: int | None, refers_url: str, date: str) -> bytes:
    """The uncompressed bytes of one record. The HTTP header always states the full payload's length."""
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    name = lambda k, d: f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{k}:{d}')}>"
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name(key, digest)}", f"WARC-Date: {date}", f"WARC-Target-URI: {_one_line(url)}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {name(refers_to, digest)}", f"WARC-Refers-To-Target-URI: {_one_line(refers_url)}", f"WARC-Refers-To-Key: {refers_to}", "WARC-Truncated: length"]
    head += [f"WARC-Record-Key: {'' if key is None else key}", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    """One gzip member without name or time."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def read_records(uri: str, chunk: int = 1 << 20) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of a gzipped WARC file; a wrong block digest raises."""
    store, path = filesystem(uri)
    with store.open_input_stream(path, compression=None) as f:
        rest = b""
        while rest or (rest := f.read(chunk)):
            z, data = zlib.decompressobj(31), []
            while not z.eof:
                data.append(z.decompress(rest))
                rest = z.unused_data if z.eof else f.read(chunk)
                if not z.eof and not rest:
                    raise ValueError(f"{uri} ends within a record")
            head, _, body = b"".join(data).partition(b"\r\n\r\n")
            version, *lines = head.decode().split("\r\n")
            if not version.startswith("WARC/"):
                raise ValueError(f"{uri}: not a WARC record")
            headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
            block = body[: int(headers["content-length"])]
            if headers["warc-block-digest"] != f"sha1:{base32_sha1(block)}":
                raise ValueError(f"{uri}: damaged block of {headers['warc-record-id']}")
            yield headers, block


def write_warc(pages: DataFrame, out: str, *, key_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, rows_per_shard: int = 4096, bytes_per_shard: int = 128 << 20, roll_bytes: int = 256 << 20, date: str = "1970-01-01T00:00:00Z", level: int = 6) -> DataFrame:
    """Write all pages as records under ``out`` and return the manifest.

    Only the revisits' keys are shuffled by digest; the payloads are shuffled once, by key range, and each shard meets
    its revisits' targets in key order.
    """
    spark = prepare(pages.sparkSession)
    df = pages.select(F.col(key_col).cast("long").alias("key"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8").alias("payload"))
    keys = df.where(F.col("key").isNotNull() & (F.length("payload") >= min_bytes)).select("key", "url", F.sha1("payload").alias("digest"))
    first = keys.groupBy("digest").agg(F.min(F.struct("key", "url")).alias("to"), F.count("*").alias("n")).where("n > 1").select("digest", "to")
    revisits = cut(keys.join(first, "digest").where(F.col("key") > F.col("to.key")).select("key", "digest", F.col("to.key").alias("to_key"), F.col("to.url").alias("to_url")).distinct(), "revisits")
    shard, n = range_shard(df, "key", rows_per_shard, F.length("payload"), bytes_per_shard)
    none = lambda kind: F.lit(None).cast(kind)
    both = df.select("key", "url", "payload", none("string").alias("digest"), none("long").alias("to_key"), none("string").alias("to_url"), F.lit(1).alias("kind")).unionByName(
        revisits.select("key", none("string").alias("url"), none("binary").alias("payload"), "digest", "to_key", "to_url", F.lit(0).alias("kind"))
    )
    both = both.withColumn("shard", shard).repartitionById(n, F.col("shard")).sortWithinPartitions("shard", F.col("key").asc_nulls_first(), "kind", "digest", "url", "payload")

    def write(batches):
        import pyarrow as pa

        rows, sink, now, part, targets = [], None, None, 0, (None, {})

        def close():
            sink.commit()
            rows.append({"shard": now, "part": part, "file": uri, "first_key": first_key, "last_key": last_key, "n_records": count, "n_bytes": sink.size, "sha256": sha.hexdigest()})

        try:
            for batch in batches:
                for s, key, kind, url, payload, digest, to_key, to_url in rows_of(batch, "shard", "key", "kind", "url", "payload", "digest", "to_key", "to_url"):
                    if kind == 0:
                        if targets[0] != key:
                            targets = (key, {})
                        targets[1][digest] = (to_key, to_url)
                        continue
                    if sink is None or s != now or sink.size >= roll_bytes:
                        if sink:
                            close()
                        part = part + 1 if s == now else 0
                        now, uri, first_key, count, sha = s, f"{out}/records-{s:06d}-{part:04d}.warc.gz", key, 0, hashlib.sha256()
                        sink = AtomicFile(uri)
                    to = targets[1].get(hashlib.sha1(payload).hexdigest()) if targets[0] == key and key is not None else None
                    data = member(record(key, url, payload, *(to or (None, "")), date), level)
                    sink.write(data)
                    sha.update(data)
                    last_key, count = key, count + 1
            if sink:
                close()
        finally:
            if sink:
                sink.abort()  # of a file that was not committed
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("file", pa.string()), ("first_key", pa.int64()), ("last_key", pa.int64()), ("n_records", pa.int64()), ("n_bytes", pa.int64()), ("sha256", pa.string())]))

    both.mapInArrow(write, MANIFEST).write.parquet(f"{out}/manifest")
    return read_manifest(spark, out)


def read_manifest(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{out}/manifest")


def read_warc(manifest: DataFrame) -> DataFrame:
    """One row a record of the archives: key, url, record_type, payload_bytes, payload_digest, refers_to, payload (null for revisits)."""
    spark = prepare(manifest.sparkSession)
    names = ("key", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload")

    def read(batches):
        import pyarrow as pa

        schema = pa.schema(list(zip(names, (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()), strict=True)))
        for batch in batches:
            for file in batch["file"].to_pylist():
                rows, held = [], 0
                for h, block in read_records(file):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length:"))[15:])
                    kind, refers = h["warc-type"], h.get("warc-refers-to-key")
                    if kind == "response" and (len(payload) != size or h["warc-payload-digest"] != f"sha1:{base32_sha1(payload)}"):
                        raise ValueError(f"{file}: damaged payload of {h['warc-record-id']}")
                    rows.append((int(h["warc-record-key"]) if h["warc-record-key"] else None, h["warc-target-uri"], kind, size, h["warc-payload-digest"][5:], int(refers) if refers else None, payload if kind == "response" else None))
                    held += len(payload)
                    if held > 8 << 20 or len(rows) >= 4096:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema)

    files = manifest.count()
    n = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), files))
    return manifest.select("shard", "file").repartitionById(n, F.col("shard") % n).mapInArrow(read, "key long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary")
