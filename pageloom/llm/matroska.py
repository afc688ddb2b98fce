"""Media columns: Matroska files as packet tables.

``elements`` walks the variable-length EBML elements of a file; ``packets`` makes them into a table of packets with
track, timestamp, key flag and byte range, undoing Xiph, EBML and fixed-size lacing in SimpleBlocks and BlockGroups,
and ``cues`` gives the seek points. Elements of unknown size end where an element of their own level starts.
``mux`` writes 8-bit samples losslessly as a PCM track with laced blocks, clusters and cues; equal samples give equal files.

Rows: a null text is an empty one; an empty payload is padded to ``pad`` zero bytes. Repeated rows get a row each, and an
empty table gives none. Null or damaged media give no packets and the reason in ``error``. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, rows_of

# Element ids of EBML and Matroska.
EBML, SEGMENT, INFO, TIMESTAMP_SCALE, DURATION, MUXING_APP, WRITING_APP = 0x1A45DFA3, 0x18538067, 0x1549A966, 0x2AD7B1, 0x4489, 0x4D80, 0x5741
TRACKS, TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, FLAG_LACING, DEFAULT_DURATION, CODEC_ID = 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x9C, 0x23E383, 0x86
AUDIO, SAMPLING_FREQUENCY, CHANNELS, BIT_DEPTH = 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER, TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, REFERENCE_BLOCK, BLOCK_DURATION = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1, 0xFB, 0x9B
CUES, CUE_POINT, CUE_TIME, CUE_TRACK_POSITIONS, CUE_TRACK, CUE_CLUSTER_POSITION = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
EBML_VERSION, EBML_READ_VERSION, EBML_MAX_ID, EBML_MAX_SIZE, DOC_TYPE, DOC_TYPE_VERSION, DOC_TYPE_READ_VERSION = 0x4286, 0x42F7, 0x42F2, 0x42F3, 0x4282, 0x4287, 0x4285
MASTERS = {SEGMENT, INFO, TRACKS, TRACK_ENTRY, AUDIO, CLUSTER, BLOCK_GROUP, CUES, CUE_POINT, CUE_TRACK_POSITIONS}
TOP = {INFO, TRACKS, CLUSTER, CUES, 0x114D9B74, 0x1941A469, 0x1043A770, 0x1254C367}
NO_LACING, XIPH, FIXED, EBML_LACING = 0, 1, 2, 3


class Packet(NamedTuple):
    track: int
    timestamp: int  #: in units of the timestamp scale
    key: bool
    lace: int  #: place in its block
    start: int  #: byte range in the file
    end: int
    cluster: int  #: place of its cluster


def vint(value: int, width: int = 0) -> bytes:
    """A size as an EBML variable-length integer."""
    width = width or next(w for w in range(1, 9) if value < (1 << 7 * w) - 1)
    return (value | 1 << 7 * width).to_bytes(width, "big")


def read_vint(data: bytes, at: int, keep_marker: bool = False) -> tuple[int, int, int]:
    """Value, width and the next place. Without the marker, all ones mean unknown and give -1."""
    first = data[at]
    width = 9 - first.bit_length()
    if width > 8 or at + width > len(data):
        raise ValueError(f"no variable-length integer at byte {at}")
    value = int.from_bytes(data[at : at + width], "big")
    if not keep_marker:
        value &= (1 << 7 * width) - 1
        if value == (1 << 7 * width) - 1:
            value = -1
    return value, width, at + width


def element(kind: int, body: bytes) -> bytes:
    return kind.to_bytes((kind.bit_length() + 7) // 8, "big") + vint(len(body)) + body


def number(kind: int, value: int) -> bytes:
    return element(kind, value.to_bytes(max(1, (value.bit_length() + 7) // 8), "big"))


def elements(data: bytes, at: int = 0, end: int | None = None) -> Iterator[tuple[int, int, int, int, int]]:
    """(id, start, body start, end, depth) of every element, masters before what they hold, however deep they lie."""
    ends = [len(data) if end is None else end]
    while ends:
        if at >= ends[-1]:
            ends.pop()
            continue
        start, end = at, ends[-1]
        kind, _, at = read_vint(data, at, True)
        size, _, at = read_vint(data, at)
        stop = end if size < 0 else at + size
        if stop > end:
            raise ValueError(f"element {kind:X} at byte {start} is cut short")
        if size < 0 and kind == CLUSTER:  # ends where the next element of the segment starts
            stop = at
            while stop < end and read_vint(data, stop, True)[0] not in TOP:
                _, _, body = read_vint(data, stop, True)
                n, _, body = read_vint(data, body)
                if n < 0 or body + n > end:
                    raise ValueError(f"unknown or wrong size within the cluster at byte {start}")
                stop = body + n
        yield kind, start, at, stop, len(ends) - 1
        if kind in MASTERS:
            ends.append(stop)
        else:
            at = stop


def laces(data: bytes, at: int, end: int, lacing: int) -> list[tuple[int, int]]:
    """Byte ranges of a block's packets."""
    if lacing == NO_LACING:
        return [(at, end)]
    n = data[at] + 1
    at += 1
    sizes: list[int] = []
    if lacing == FIXED:
        if (end - at) % n:
            raise ValueError("fixed-size laces of unequal size")
        sizes = [(end - at) // n] * n
    elif lacing == XIPH:
        for _ in range(n - 1):
            size = 0
            while data[at] == 255:
                size, at = size + 255, at + 1
            sizes.append(size + data[at])
            at += 1
    else:
        for k in range(n - 1):
            value, width, at = read_vint(data, at)
            sizes.append(value if k == 0 else sizes[-1] + value - ((1 << 7 * width - 1) - 1))
    if lacing != FIXED:
        sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise ValueError("laces longer than their block")
    out = []
    for size in sizes:
        out.append((at, at + size))
        at += size
    return out


def packets(data: bytes) -> Iterator[Packet]:
    """The packet table of one file, in file order.

    The packets of a lace follow each other by their track's default duration or by equal parts of their block's duration;
    without either they have the block's timestamp.
    """
    if data[:4] != EBML.to_bytes(4, "big"):
        raise ValueError("no EBML header")
    cluster = base = entry = pending = 0
    scale, lasting = 1_000_000, {}  # nanoseconds: a unit of time, and each track's default duration
    group: list[Packet] = []
    group_end = spread = 0
    number_of = lambda a, z: int.from_bytes(data[a:z], "big")

    def finished():
        for p in group:
            yield p._replace(timestamp=p.timestamp + p.lace * spread // len(group)) if spread and p.track not in lasting else p

    for kind, start, body, stop, _ in elements(data):
        if group and start >= group_end:
            yield from finished()
            group = []
        if kind == CLUSTER:
            cluster = start
        elif kind == TIMESTAMP_SCALE:
            scale = number_of(body, stop) or scale
        elif kind == TRACK_ENTRY:
            entry = pending = 0
        elif kind == TRACK_NUMBER:
            entry = number_of(body, stop)
            if pending:
                lasting[entry] = pending
        elif kind == DEFAULT_DURATION:
            pending = number_of(body, stop)
            if entry:
                lasting[entry] = pending
        elif kind == TIMESTAMP:
            base = number_of(body, stop)
        elif kind == BLOCK_GROUP:
            group_end, spread = stop, 0
        elif kind == BLOCK_DURATION:
            spread = number_of(body, stop)
        elif kind == REFERENCE_BLOCK:
            group = [p._replace(key=False) for p in group]
        elif kind in (SIMPLE_BLOCK, BLOCK):
            track, _, at = read_vint(data, body)
            relative, flags = struct.unpack_from(">hB", data, at)
            key = bool(flags & 0x80) if kind == SIMPLE_BLOCK else True
            found = [Packet(track, base + relative + k * lasting.get(track, 0) // scale, key, k, a, z, cluster) for k, (a, z) in enumerate(laces(data, at + 3, stop, flags >> 1 & 3))]
            if kind == BLOCK:
                group += found
            else:
                yield from found
    yield from finished()


def cues(data: bytes) -> list[tuple[int, int, int]]:
    """(time, track, byte of the cluster in the file) of every cue point."""
    segment, out = 0, []
    for kind, _, body, stop, _ in elements(data):
        value = int.from_bytes(data[body:stop], "big") if kind in (CUE_TIME, CUE_TRACK, CUE_CLUSTER_POSITION) else 0
        if kind == SEGMENT:
            segment = body
        elif kind == CUE_TIME:
            time = value
        elif kind == CUE_TRACK:
            track = value
        elif kind == CUE_CLUSTER_POSITION:
            out.append((time, track, segment + value))
    return out


def block(track: int, relative: int, frames: list[bytes], lacing: int = EBML_LACING) -> bytes:
    """The body of a SimpleBlock with these packets."""
    if len(frames) == 1:
        return vint(track) + struct.pack(">hB", relative, 0x80) + frames[0]
    head = vint(track) + struct.pack(">hBB", relative, 0x80 | lacing << 1, len(frames) - 1)
    if lacing == XIPH:
        head += b"".join(b"\xff" * (len(f) // 255) + bytes([len(f) % 255]) for f in frames[:-1])
    elif lacing == EBML_LACING:
        head += vint(len(frames[0]))
        for a, b in zip(frames, frames[1:-1], strict=False):
            d = len(b) - len(a)
            width = next(w for w in range(1, 9) if abs(d) < (1 << 7 * w - 1) - 1)
            head += vint(d + (1 << 7 * width - 1) - 1, width)
    elif len({len(f) for f in frames}) > 1:
        raise ValueError("fixed-size lacing needs packets of one size")
    return head + b"".join(frames)


def mux(samples: bytes, rate: int = 8000, frame: int = 1024, frames_per_block: int = 8, blocks_per_cluster: int = 16) -> bytes:
    """A Matroska file with one track of unsigned 8-bit mono PCM that holds these samples."""
    parts = [samples[k : k + frame] for k in range(0, len(samples), frame)]
    ms = lambda k: k * frame * 1000 // rate
    header = element(EBML, number(EBML_VERSION, 1) + number(EBML_READ_VERSION, 1) + number(EBML_MAX_ID, 4) + number(EBML_MAX_SIZE, 8) + element(DOC_TYPE, b"matroska") + number(DOC_TYPE_VERSION, 4) + number(DOC_TYPE_READ_VERSION, 2))
    info = element(INFO, number(TIMESTAMP_SCALE, 1_000_000) + element(DURATION, struct.pack(">d", len(samples) * 1000 / rate)) + element(MUXING_APP, b"pageloom") + element(WRITING_APP, b"pageloom"))
    audio = element(AUDIO, element(SAMPLING_FREQUENCY, struct.pack(">d", float(rate))) + number(CHANNELS, 1) + number(BIT_DEPTH, 8))
    tracks = element(TRACKS, element(TRACK_ENTRY, number(TRACK_NUMBER, 1) + number(TRACK_UID, 1) + number(TRACK_TYPE, 2) + number(FLAG_LACING, 1) + number(DEFAULT_DURATION, frame * 1_000_000_000 // rate) + element(CODEC_ID, b"A_PCM/INT/LIT") + audio))
    body, points = [info, tracks], []
    at, per = len(info) + len(tracks), frames_per_block * blocks_per_cluster
    for first in range(0, len(parts), per):
        inner = [number(TIMESTAMP, ms(first))]
        for k in range(first, min(first + per, len(parts)), frames_per_block):
            inner.append(element(SIMPLE_BLOCK, block(1, ms(k) - ms(first), parts[k : k + frames_per_block])))
        points.append(element(CUE_POINT, number(CUE_TIME, ms(first)) + element(CUE_TRACK_POSITIONS, number(CUE_TRACK, 1) + number(CUE_CLUSTER_POSITION, at))))
        body.append(element(CLUSTER, b"".join(inner)))
        at += len(body[-1])
    if points:
        body.append(element(CUES, b"".join(points)))
    return header + element(SEGMENT, b"".join(body))


def packet_table(media: DataFrame, *, id_col: str = "id", media_col: str = "media") -> DataFrame:
    """Every packet of every file in a binary column: id, track, timestamp, key, lace, start, end, cluster, error."""
    prepare(media.sparkSession)

    def explode(batches):
        import pyarrow as pa

        names = ("id", *Packet._fields, "error")
        schema = pa.schema([("id", pa.string()), ("track", pa.int64()), ("timestamp", pa.int64()), ("key", pa.bool_()), *((n, pa.int64()) for n in ("lace", "start", "end", "cluster")), ("error", pa.string())])
        for b in batches:
            rows = []
            for i, data in rows_of(b, "id", "media", rows=16):
                try:
                    rows += [(i, *p, None) for p in packets(data or b"")]
                except (ValueError, IndexError, struct.error) as e:
                    rows.append((i, *[None] * 7, str(e)))
                while len(rows) >= 65536:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows[:65536]], schema)
                    rows = rows[65536:]
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema)

    return media.select(F.col(id_col).cast("string").alias("id"), F.col(media_col).alias("media")).mapInArrow(explode, "id string, track long, timestamp long, key boolean, lace long, start long, end long, cluster long, error string")


def features(samples: np.ndarray, table: list[Packet], points: list) -> str:
    """packets : clusters : cue points : last timestamp : mean, root mean square around it and zero crossings of the samples."""
    x = samples.astype(np.float64) - 128
    crossings = int(np.count_nonzero(np.diff(samples >= 128)))
    return f"{len(table)}:{len({p.cluster for p in table})}:{len(points)}:{table[-1].timestamp}:{x.mean():.6f}:{x.std():.6f}:{crossings}"


def text_media(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", pad: int = 64) -> DataFrame:
    """Each text as padded 8-bit samples in a Matroska file, read back through its packet table."""
    prepare(docs.sparkSession)

    def convert(batches):
        import pyarrow as pa

        schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])
        for b in batches:
            rows = []
            for doc, text in rows_of(b, "doc_id", "text"):
                raw = text.encode()
                media = mux(raw + bytes(-len(raw) % pad or (0 if raw else pad)))
                table = list(packets(media))
                payload = b"".join(media[p.start : p.end] for p in table)
                rows.append((doc, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), features(np.frombuffer(payload, np.uint8), table, cues(media))))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)] if rows else [pa.array([], f.type) for f in schema], schema=schema)

    df = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return df.mapInArrow(convert, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
