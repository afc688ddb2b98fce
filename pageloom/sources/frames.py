"""Files of frames: a length as a big-endian 32-bit number and as many bytes, by turns a document's id and its PDF file."""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare

MOST_BYTES = 1 << 30  #: of a frame


def frame(data: bytes) -> bytes:
    if len(data) > MOST_BYTES:
        raise ValueError(f"a frame of {len(data)} bytes")
    return struct.pack(">I", len(data)) + data


def encode(documents: Iterable[tuple[str, bytes]]) -> bytes:
    return b"".join(frame(i.encode()) + frame(data) for i, data in documents)


def decode(data: bytes) -> Iterator[tuple[str, bytes]]:
    """(document_id, content) of every pair of frames; a cut or oversized frame raises."""
    at, parts = 0, []
    while at < len(data):
        if at + 4 > len(data):
            raise ValueError("a length is cut short")
        (size,) = struct.unpack_from(">I", data, at)
        if size > MOST_BYTES or at + 4 + size > len(data):
            raise ValueError(f"a frame of {size} bytes at byte {at}")
        parts.append(data[at + 4 : at + 4 + size])
        at += 4 + size
        if len(parts) == 2:
            yield parts[0].decode("utf-8", "replace"), parts[1]
            parts = []
    if parts:
        raise ValueError("an id without a file")


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    """(document_id, content, error) of all files under ``path``; what follows damage in a file is one row with the error."""
    prepare(spark)

    def run(batches):
        import pyarrow as pa

        schema = pa.schema([("document_id", pa.string()), ("content", pa.binary()), ("error", pa.string())])
        for b in batches:
            for name, data in zip(b["path"].to_pylist(), b["content"].to_pylist(), strict=True):
                try:
                    for i, content in decode(data):
                        yield pa.RecordBatch.from_pylist([{"document_id": i, "content": content, "error": None}], schema)
                except ValueError as e:
                    yield pa.RecordBatch.from_pylist([{"document_id": name, "content": None, "error": str(e)}], schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("content")).mapInArrow(run, "document_id string, content binary, error string")
