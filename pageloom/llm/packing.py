"""Packing of token sequences by non-negative least squares on the histogram of lengths.

Every document is cut into full windows and one rest, so that a piece has 1 to ``window`` ids. The plan is made on the
histogram of piece lengths alone, which has ``window`` bins whatever the corpus:

1. Shallow combinations are enumerated: the lengths of one, two or three pieces that fill a window to the last id.
2. Non-negative least squares (accelerated projected gradient, with residuals weighted towards long pieces) finds how
   often each combination is repeated so that the sums come close to the histogram.
3. The counts are rounded and then lowered where they would use more pieces than there are.
4. What is left is packed greedily, still on the histogram: a window takes the longest piece that fits, again and again,
   and the pattern found is repeated as often as its pieces last.

A piece's place follows from its length and its rank among the pieces of that length. Ranks are counted within each
block of documents (one task's input, written down once) and shifted by the counts of the blocks before, so no length,
however common, is gathered in one task. Sequence numbers therefore follow the documents' order and split into files; the
pieces and the padding do not depend on them.

Rows: a null text is an empty one; an empty text is a piece of the end id alone. Repeated rows and null ids are packed
like any other. An empty table gives no pieces. Other columns are not read.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bpe import encoder
from .common import ROW_BITS, Lists, cut, prepare, rows_of, write_lists

PIECES = "block int, length int, rank long, doc_id long, start long, ids_crc32 long, doc_tokens long"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def combinations(window: int, lengths: np.ndarray, depth: int = 3) -> np.ndarray:
    """All a <= b <= c of ``lengths`` that sum to ``window``; unused places are 0."""
    have = np.zeros(window + 1, bool)
    have[lengths] = True
    out = [np.array([[0, 0, window]])] if have[window] else [np.zeros((0, 3), int)]
    low = lengths[lengths <= window // 2]
    pairs = low[have[window - low]]
    out.append(np.stack([np.zeros_like(pairs), pairs, window - pairs], 1))
    if depth >= 3:
        for a in lengths[lengths <= window // 3]:
            b = lengths[(lengths >= a) & (lengths <= (window - a) // 2)]
            b = b[have[window - a - b]]
            out.append(np.stack([np.full_like(b, a), b, window - a - b], 1))
    return np.concatenate(out).astype(int)


def nnls(combos: np.ndarray, histogram: np.ndarray, weights: np.ndarray, rounds: int = 400) -> np.ndarray:
    """x >= 0 that makes the weighted squares of (combos' lengths times x - histogram) small."""
    n = len(histogram)
    scale = max(1.0, histogram.max())
    target, w2 = histogram / scale, weights**2
    used = combos > 0

    def times(x):
        return sum(np.bincount(combos[:, k][used[:, k]], x[used[:, k]], n) for k in range(3))

    def gradient(r):
        r = r * w2
        return sum(np.where(used[:, k], r[combos[:, k]], 0) for k in range(3))

    v = np.ones(len(combos))
    for _ in range(20):  # the largest eigenvalue, for the step
        v = gradient(times(v))
        norm = np.linalg.norm(v)
        v /= norm
    step = 1 / (norm * 1.05)
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * gradient(times(y) - target))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / t2 * (new - x), new, t2
    return x * scale


def make_plan(histogram: np.ndarray, window: int, depth: int = 3) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Patterns ((length, uses), ...) from the longest, and how often each is repeated; together they use every piece once.

    ``histogram[l]`` is the number of pieces of length l. The plan has at most a few patterns for each bin and combination.
    """
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    plan: list[tuple[tuple[tuple[int, int], ...], int]] = []

    def take(lengths: list[int], times: int) -> None:
        uses = [(x, lengths.count(x)) for x in sorted({*lengths}, reverse=True)]
        plan.append((tuple(uses), times))
        for x, u in uses:
            left[x] -= u * times

    if left[window]:
        take([window], int(left[window]))
    lengths = np.flatnonzero(left)
    combos = combinations(window, lengths, depth) if len(lengths) else np.zeros((0, 3), int)
    if len(combos):
        x = nnls(combos, left.astype(float), 0.5 + np.arange(window + 1) / window)
        repeats = np.rint(x).astype(np.int64)
        for k in np.argsort(-x, kind="stable"):
            if repeats[k] <= 0:
                break
            parts = [int(p) for p in combos[k] if p]
            if times := min(int(repeats[k]), *(int(left[p]) // parts.count(p) for p in parts)):
                take(parts, times)
    while left.any():
        room, parts, counts = window, [], left.copy()
        at = int(np.flatnonzero(counts)[-1])
        while room and at:
            at = min(at, room)
            while at and not counts[at]:
                at -= 1
            if at:
                n = int(min(counts[at], room // at))
                parts += [at] * n
                counts[at] -= n
                room -= n * at
        take(parts, min(int(left[p]) // parts.count(p) for p in {*parts}))
    return plan


def places(plan: list, window: int) -> dict[str, np.ndarray]:
    """For each length a run of ranks: from rank ``first``, ``uses`` pieces of ``length`` in a sequence, from sequence ``base`` and ``offset``. Sorted by (length, first)."""
    rows, base, seen = [], 0, np.zeros(window + 1, np.int64)
    for uses, times in plan:
        offset = 0
        for length, u in uses:
            rows.append((length, int(seen[length]), u, base, offset))
            seen[length] += u * times
            offset += u * length
        base += times
    rows.sort()
    return dict(zip(("length", "first", "uses", "base", "offset"), np.array(rows, np.int64).reshape(-1, 5).T, strict=True))


def cut_pieces(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", window: int = 1024, end_id: int = 0, remembered: int = 900_000) -> DataFrame:
    """The pieces of every document with their ranks within the block; written to the shared folder."""
    prepare(docs.sparkSession)
    end = struct.pack("<I", end_id)

    def pieces(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encode, block, seen = encoder(tokenizer, remembered).encode, TaskContext.get().partitionId(), [0] * (window + 1)
        schema = pa.schema([("block", pa.int32()), ("length", pa.int32()), *((n, pa.int64()) for n in ("rank", "doc_id", "start", "ids_crc32", "doc_tokens"))])
        for batch in batches:
            rows = []
            for doc, text in rows_of(batch, "id", "text"):
                ids = encode(text) + end
                n = len(ids) // 4
                for start in range(0, n, window):
                    part = ids[4 * start : 4 * (start + window)]
                    length = len(part) // 4
                    rows.append((block, length, seen[length], doc, start, zlib.crc32(part), n))
                    seen[length] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)] if rows else [pa.array([], f.type) for f in schema], schema=schema)

    df = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return cut(df.mapInArrow(pieces, PIECES), "pieces")


def pack(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", window: int = 1024, end_id: int = 0, depth: int = 3, remembered: int = 900_000) -> DataFrame:
    """Each piece of every document with its sequence and its offset there. Tasks remember the ids of about ``remembered`` words; fewer take less memory and more time."""
    spark = docs.sparkSession
    pieces = cut_pieces(docs, tokenizer, id_col=id_col, text_col=text_col, window=window, end_id=end_id, remembered=remembered)
    counts = cut(pieces.groupBy("block", "length").agg(F.count("*").alias("n")), "counts")
    histogram = np.zeros(window + 1, np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("n")).collect():  # a row for each length
        histogram[length] = n
    table = places(make_plan(histogram, window, depth), window)
    before = W.partitionBy("length").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select((F.shiftleft(F.col("block").cast("long"), ROW_BITS) + F.col("length")).alias("key"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    folder = write_lists(offsets, "offsets")  # each block finds its own, a row for each length
    key = table["length"] << 44 | table["first"] if len(table["length"]) else np.zeros(0, np.int64)
    held = spark.sparkContext.broadcast((key, table))  # bounded by the window and the combinations

    def place(batches):
        import pyarrow as pa

        key, table = held.value
        lists = Lists(folder, 2)
        for b in batches:
            if not b.num_rows:
                continue
            length, own = b["length"].to_numpy().astype(np.int64), b["block"].to_numpy().astype(np.int64) << ROW_BITS
            entries = lists.of(own + length)
            rank = b["rank"].to_numpy() + entries[np.searchsorted(entries[:, 0], own + length), 1]
            at = np.searchsorted(key, length << 44 | rank, side="right") - 1
            nth, uses = rank - table["first"][at], table["uses"][at]
            sequence, offset = table["base"][at] + nth // uses, table["offset"][at] + nth % uses * length
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["start"], pa.array(length), b["ids_crc32"], b["doc_tokens"], pa.array(sequence), pa.array(offset)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return pieces.mapInArrow(place, PACKED)
