"""Toxicity by a factorization machine over hashed terms.

Terms are a text's lower-cased words and the first five letters of longer words, hashed to ``buckets`` buckets. All of
them enter the machine, whatever each says of the label by itself: it has a weight and a vector for every bucket, so that
the score also holds how pairs of terms act together, such as an insult with a group's name, which no sum of single
weights can express. It is fitted by AdaGrad on the logistic loss; a bucket that no training row has counts for nothing.

Training takes at most ``max_rows`` labelled ids, the first in the order of a hash of the id; scoring takes whole texts
of all rows. Label rows without an id or label are left out, an id with several labels is toxic if one of them is, an id
with several texts is learnt from one of them, and labels without a document have no effect.

Rows: a null or empty text has no terms and gets the score of the machine's bias. Repeated rows get a row each, ties the
same score, and an empty table none. Without labels of both classes every text has the same score,
(toxic + 0.5) / (labelled + 2), so nothing is rejected unasked. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, rows_of

_WORDS = re.compile(r"[^\W_]+").findall
STEM = 5


class Model(NamedTuple):
    bias: float
    weight: np.ndarray  #: of each bucket
    factors: np.ndarray


def buckets_of(word: str, buckets: int) -> tuple[int, ...]:
    """The buckets of a word's terms."""
    own = zlib.crc32(word.encode()) % buckets
    return (own, zlib.crc32(b"^" + word[:STEM].encode()) % buckets) if len(word) > STEM else (own,)


def scores(model: Model, rows: list[list[int]]) -> np.ndarray:
    """Scores of rows of buckets; a bucket counts once. The sum over pairs is half of the square of the vectors' sum less their squares."""
    out = np.full(len(rows), model.bias)
    for k, row in enumerate(rows):
        if row:
            v = model.factors[row].astype(np.float64)
            s = v.sum(0)
            out[k] += model.weight[row].sum(dtype=np.float64) + 0.5 * (s @ s - (v * v).sum())
    return 1 / (1 + np.exp(-np.clip(out, -60, 60)))


def fit(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, y: np.ndarray, width: int, *, factors: int = 8, steps: int = 1500, rate: float = 0.1, doubt: float = 3.0, pair_doubt: float = 1.0, l2: float = 1e-3, batch: int = 128, seed: int = 7) -> Model:
    """AdaGrad on the mean logistic loss of a factorization machine plus penalties.

    Both classes weigh the same. Row k has ``sizes[k]`` buckets from flat[starts[k]] on. Each weight is penalised by its size
    times ``doubt`` standard deviations of the gradient that chance alone gives its bucket, each vector by its length
    times ``pair_doubt`` of them, and by ``l2`` / 2 times its square. A step only touches the buckets of its batch; each
    then shrinks by what it missed.
    """
    rng = np.random.default_rng(seed)
    count = np.bincount(flat, minlength=width)
    used = np.flatnonzero(count)
    n, count = len(used), count[used]
    place = np.zeros(width, np.int32)
    place[used] = np.arange(n, dtype=np.int32)
    flat = place[flat]
    bias, w, v = 0.0, np.zeros(n), rng.normal(0, 0.05, (n, factors))
    gb, gw, gv = 1e-6, np.full(n, 1e-6), np.full(n, 1e-6)
    share = y.mean()
    weight_of = np.where(y > 0, 0.5 / share, 0.5 / (1 - share))
    touched = -np.expm1(min(batch, len(y)) * np.log1p(-np.minimum(count / len(y), 1 - 1e-9)))  # the chance that a batch has the bucket
    shrink = np.sqrt((weight_of**2).mean() * count) / (2 * len(y)) / touched
    decay = (l2 / touched)[:, None]
    order = np.zeros(0, int)
    for _ in range(steps):
        if len(order) < min(batch, len(y)):
            order = rng.permutation(len(y))
        part, order = order[:batch], order[batch:]
        own = sizes[part]
        row = np.repeat(np.arange(len(part)), own)
        at = flat[np.arange(own.sum()) + np.repeat(starts[part] - np.cumsum(own) + own, own)]
        vx = v[at]
        s = np.stack([np.bincount(row, vx[:, f], len(part)) for f in range(factors)], 1)
        z = bias + np.bincount(row, w[at], len(part)) + 0.5 * ((s * s).sum(1) - np.bincount(row, (vx * vx).sum(1), len(part)))
        g = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y[part]) * weight_of[part] / len(part)
        seen, to = np.unique(at, return_inverse=True)
        each = g[row]
        dw = np.bincount(to, each, len(seen))
        each = each[:, None] * (s[row] - vx)
        dv = np.stack([np.bincount(to, each[:, f], len(seen)) for f in range(factors)], 1) + decay[seen] * v[seen]
        gb += g.sum() ** 2
        gw[seen] += dw * dw
        gv[seen] += (dv * dv).mean(1)
        bias -= rate * g.sum() / gb**0.5
        step = rate / np.sqrt(gw[seen])
        new = w[seen] - step * dw
        w[seen] = np.sign(new) * np.maximum(0, np.abs(new) - step * doubt * shrink[seen])
        step = rate / np.sqrt(gv[seen])
        new = v[seen] - step[:, None] * dv
        length = np.maximum(np.sqrt((new * new).sum(1)), 1e-30)
        v[seen] = new * np.maximum(0, 1 - step * pair_doubt * shrink[seen] * np.sqrt((s * s).sum(1).mean()) / length)[:, None]
    weight, vectors = np.zeros(width, np.float32), np.zeros((width, factors), np.float32)
    weight[used], vectors[used] = w, v
    return Model(float(bias), weight, vectors)


def train(docs: DataFrame, labels: DataFrame, *, usable: Column | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = 20_000, buckets: int = 1 << 18, **fitting) -> Model:
    """Fit on at most ``max_rows`` labelled ids, of those that ``usable`` (an expression of doc_id) allows."""
    spark = prepare(docs.sparkSession)
    own = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y is not null")
    if usable is not None:
        own = own.where(usable)
    own = own.groupBy("doc_id").agg(F.max(F.expr("int(y > 0)")).alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def terms(batches):
        import pyarrow as pa

        for b in batches:
            rows = [sorted({x for w in {*_WORDS(t.lower())} for x in buckets_of(w, buckets)}) for (t,) in rows_of(b, "text")]
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["y"], pa.array(rows, pa.list_(pa.int32()))], names=["doc_id", "y", "terms"])

    found = texts.join(F.broadcast(own), "doc_id").select("doc_id", "y", "text").mapInArrow(terms, "doc_id long, y int, terms array<int>")  # max_rows ids are broadcast
    rows = found.groupBy("doc_id").agg(F.max("y").alias("y"), F.min("terms").alias("terms")).toArrow()  # a row for each of at most max_rows ids
    order = np.argsort(rows["doc_id"].to_numpy())
    y = rows["y"].to_numpy()[order].astype(float)
    if not 0 < y.sum() < len(y):
        share = (y.sum() + 0.5) / (len(y) + 2)
        return Model(float(np.log(share / (1 - share))), np.zeros(buckets, np.float32), np.zeros((buckets, 1), np.float32))
    sizes = pc.list_value_length(rows["terms"]).to_numpy()
    starts = np.cumsum(sizes) - sizes
    flat = np.concatenate([x.flatten().to_numpy() for x in rows["terms"].chunks])
    del rows
    return fit(flat, starts[order], sizes[order], y, buckets, **fitting)


class Scorer:
    """Scores of texts; remembers the buckets of lately seen words."""

    def __init__(self, model: Model, remembered: int = 65_536):
        self.model, self.remembered, self.places = model, remembered, {}

    def row(self, text: str) -> list[int]:
        places, buckets, found = self.places, len(self.model.weight), set()
        if len(places) > self.remembered:
            places.clear()
        for word in {*_WORDS(text.lower())}:
            if (at := places.get(word)) is None:
                at = places[word] = buckets_of(word, buckets)
            found.update(at)
        return sorted(found)

    def __call__(self, texts) -> np.ndarray:
        return np.array([scores(self.model, [self.row(t) if t else []])[0] for t in texts])


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score, 0 to 1, of every row."""
    held = prepare(docs.sparkSession).sparkContext.broadcast(model)  # a weight and a vector for each bucket

    def run(batches):
        import pyarrow as pa

        scorer = Scorer(held.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(scorer(t for (t,) in rows_of(b, "text")))], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")


def without_toxic(docs: DataFrame, model: Model, *, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows whose score is below ``least``, with all their columns."""
    held = prepare(docs.sparkSession).sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        scorer = Scorer(held.value)
        for b in batches:
            if b.num_rows:
                texts = pa.RecordBatch.from_arrays([b["row"].field(at)], names=["text"])
                yield pa.RecordBatch.from_arrays([b["row"].filter(pa.array(scorer(t for (t,) in rows_of(texts, "text")) < least))], names=["row"])

    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    return rows.mapInArrow(run, rows.schema).select("row.*")
