"""Token-ID files of independent zstandard frames with a trailing seek table and a checksum for each frame.

A file is a row of zstandard frames, each of which holds the ids of some whole documents; then come two skippable
frames. The first is the document index: for each frame its first document's place, its counts, and its least and greatest
id. The last is the seek
table of the Zstandard seekable format: compressed size, decompressed size and the low 32 bits of the content's XXH64
for each frame, then the number of frames, a descriptor byte and the magic number. Readers fetch the end of the file
first and then decompress only the frames that hold the documents they were asked for, by place or by id; the manifest
has each file's least and greatest id.

Rows: a null text is an empty one, and an empty text has the end id only. Repeated rows are written as often as they
occur; rows of one id are ordered by text. A null id comes first. An empty table gives no files. Other columns are
neither read nor written, whatever their names.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bpe import encoder
from .common import AtomicFile, filesystem, prepare, range_shard, rows_of

# Fixed values of the Zstandard seekable format.
SKIPPABLE_SEEK, SKIPPABLE_INDEX, SEEKABLE_MAGIC = 0x184D2A5E, 0x184D2A5D, 0x8F92EAB1
HAS_CHECKSUMS = 0x80

_DOC, _INDEX = struct.Struct("<qBI"), struct.Struct("<QIQqq")
NULL = -(1 << 63)  #: stands for a null id in the index, as nulls come first
MANIFEST = "shard int, file string, n_docs long, n_tokens long, n_frames int, n_bytes long, first_id long, last_id long"


class FrameWriter:
    """Gathers documents and writes a frame whenever ``frame_tokens`` ids are held; a document is never split."""

    def __init__(self, sink, frame_tokens: int, level: int, narrow: bool):
        import zstandard

        self.sink, self.frame_tokens, self.narrow = sink, frame_tokens, narrow
        self.compress = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True).compress
        self.heads, self.ids, self.held, self.ends = [], [], 0, None
        self.table, self.index, self.docs, self.tokens = [], [], 0, 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // 4
        key = NULL if doc_id is None else doc_id
        self.ends = (min(key, self.ends[0]), max(key, self.ends[1])) if self.ends else (key, key)
        self.heads.append(_DOC.pack(doc_id or 0, doc_id is None, n))
        self.ids.append(ids)
        self.held += n
        if self.held >= self.frame_tokens:
            self.flush()

    def flush(self) -> None:
        import xxhash

        if not self.heads:
            return
        ids = np.frombuffer(b"".join(self.ids), "<u4")
        if self.narrow and ids.max() > 65535:
            raise ValueError("ids beyond 16 bits need narrow=False")
        body = struct.pack("<IB", len(self.heads), self.narrow) + b"".join(self.heads) + (ids.astype("<u2") if self.narrow else ids).tobytes()
        packed = self.compress(body)
        self.sink.write(packed)
        self.table.append(struct.pack("<III", len(packed), len(body), xxhash.xxh64_intdigest(body) & 0xFFFFFFFF))
        self.index.append(_INDEX.pack(self.docs, len(self.heads), len(ids), *self.ends))
        self.docs, self.tokens = self.docs + len(self.heads), self.tokens + len(ids)
        self.heads, self.ids, self.held, self.ends = [], [], 0, None

    def finish(self) -> None:
        self.flush()
        index = b"".join(self.index)
        self.sink.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        seek = b"".join(self.table) + struct.pack("<IBI", len(self.table), HAS_CHECKSUMS, SEEKABLE_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_SEEK, len(seek)) + seek)


class FrameReader:
    """Random access to one file."""

    def __init__(self, uri: str):
        store, path = filesystem(uri)
        self.file = store.open_input_file(path)
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or not flags & HAS_CHECKSUMS:
            raise ValueError(f"{uri}: no seek table with checksums at its end")
        seek = size - 9 - 12 * n
        self.table = list(struct.iter_unpack("<III", self._at(seek, 12 * n)))
        index = seek - 8 - _INDEX.size * n
        self.index = list(_INDEX.iter_unpack(self._at(index, _INDEX.size * n)))
        self.starts = np.concatenate([[0], np.cumsum([c for c, _, _ in self.table])]).astype(int).tolist()

    def _at(self, offset: int, n: int) -> bytes:
        return self.file.read_at(n, offset)

    def frame(self, k: int) -> Iterator[tuple[int | None, np.ndarray]]:
        """The documents of frame ``k`` with their ids; a wrong checksum raises."""
        import xxhash
        import zstandard

        body = zstandard.ZstdDecompressor().decompress(self._at(self.starts[k], self.table[k][0]))
        if len(body) != self.table[k][1] or xxhash.xxh64_intdigest(body) & 0xFFFFFFFF != self.table[k][2]:
            raise ValueError(f"frame {k} is damaged")
        n, narrow = struct.unpack_from("<IB", body)
        at = 5 + n * _DOC.size
        ids, done = np.frombuffer(body, "<u2" if narrow else "<u4", offset=at).astype("<u4"), 0
        for doc, null, size in _DOC.iter_unpack(body[5:at]):
            yield None if null else doc, ids[done : done + size]
            done += size

    def documents(self, places: list[int]) -> dict[int, tuple[int | None, np.ndarray]]:
        """The documents at these places in the file; only the frames that hold them are read."""
        wanted, found = set(places), {}
        for k, (first, n, *_) in enumerate(self.index):
            if not wanted.isdisjoint(range(first, first + n)):
                found.update((first + i, x) for i, x in enumerate(self.frame(k)) if first + i in wanted)
        return found

    def find(self, doc_ids: list[int | None]) -> dict[int | None, list[np.ndarray]]:
        """The ids of all documents with these numbers; only frames whose range holds one of them are read."""
        wanted, found = {*doc_ids}, {}
        keys = sorted(NULL if i is None else i for i in wanted)
        for k, (*_, low, high) in enumerate(self.index):
            at = bisect_left(keys, low)
            if at < len(keys) and keys[at] <= high:
                for i, ids in self.frame(k):
                    if i in wanted:
                        found.setdefault(i, []).append(ids)
        return found

    def close(self) -> None:
        self.file.close()


def write_token_files(docs: DataFrame, out: str, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, rows_per_file: int = 8192, frame_tokens: int = 65536, level: int = 3, narrow: bool = True) -> DataFrame:
    """Write the ids of every text, with ``end_id`` after each, in ascending order of ``id_col``; return the manifest.

    The integer column ``id_col`` is cut into ranges of about ``rows_per_file`` rows, and one task writes a range's file.
    Files appear under their names only when whole, and the manifest, a Parquet table in ``out``, comes last.
    ``narrow`` stores 16-bit ids; ids beyond that raise.
    """
    spark = prepare(docs.sparkSession)
    df = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    shard, n = range_shard(df, "id", rows_per_file)
    df = df.withColumn("shard", shard).repartitionById(n, F.col("shard")).sortWithinPartitions("shard", F.col("id").asc_nulls_first(), "text")
    end = struct.pack("<I", end_id)

    def write(batches):
        import pyarrow as pa

        encode, sink, writer, now = encoder(tokenizer).encode, None, None, None
        rows = []

        def close():
            writer.finish()
            sink.commit()
            low, high = writer.index[0][-16:-8], writer.index[-1][-8:]
            low, high = (None if (x := struct.unpack("<q", e)[0]) == NULL else x for e in (low, high))
            rows.append((now, sink_uri, writer.docs, writer.tokens, len(writer.table), sink.size, low, high))

        try:
            for batch in batches:
                for s, i, text in rows_of(batch, "shard", "id", "text"):
                    if s != now:
                        if writer:
                            close()
                        now, sink_uri = s, f"{out}/ids-{s:06d}.zst"
                        sink = AtomicFile(sink_uri)
                        writer = FrameWriter(sink, frame_tokens, level, narrow)
                    writer.add(i, encode(text) + end)
            if writer:
                close()
        finally:
            if sink:
                sink.abort()  # of a file that was not committed
        names = MANIFEST.replace(",", "").split()[::2]
        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], pa.schema([(n, pa.string() if n == "file" else pa.int32() if n in ("shard", "n_frames") else pa.int64()) for n in names]))

    df.mapInArrow(write, MANIFEST).write.parquet(f"{out}/manifest")
    return read_manifest(spark, out)


def read_manifest(spark: SparkSession, out: str) -> DataFrame:
    """The files of ``out`` with ``start``, the ids in all files before."""
    w = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    return spark.read.schema(MANIFEST).parquet(f"{out}/manifest").withColumn("start", F.coalesce(F.sum("n_tokens").over(w), F.lit(0)))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Every document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    spark = prepare(manifest.sparkSession)

    def read(batches):
        import pyarrow as pa

        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for batch in batches:
            for file, start in zip(batch["file"].to_pylist(), batch["start"].to_pylist(), strict=True):
                reader = FrameReader(file)
                for k in range(len(reader.table)):
                    rows = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
                    for doc, ids in reader.frame(k):
                        for name, value in zip(rows, (doc, start, len(ids), zlib.crc32(ids.tobytes())), strict=True):
                            rows[name].append(value)
                        start += len(ids)
                    yield pa.RecordBatch.from_pydict(rows, schema)
                reader.close()

    n = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), manifest.count()))
    return manifest.select("shard", "file", "start").repartitionById(n, F.col("shard") % n).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
