"""SimHash near-duplicates by the generalised pigeonhole principle.

64-bit fingerprints are cut into m parts of bits. If two differ in at most tau bits and the parts have thresholds that
sum to tau - m + 1 (one of -1 skips its part), then in some part they differ by no more than its threshold. So:

1. Over all distinct fingerprints the bits' pairwise counts are taken, and correlated bits are put in the same part.
2. Over all distinct fingerprints the parts' values are counted. A dynamic program gives the parts unequal thresholds
   with the least estimated work: candidates (from the counts, and for thresholds above 0 from the bits' chances to
   agree) and probes (the values within the threshold). The number of parts is chosen by the same estimate.
3. Each fingerprint is filed under its part's value and probes all values within the threshold. The fingerprints of a
   bucket are verified on all 64 bits, and a spanning tree of its links is kept.
4. Buckets of more than ``bucket`` fingerprints aren't compared pair by pair. Their members are filed under every value
   one bit away and under their own: two share such a value if and only if they differ in at most two bits, and at most
   65 share one, so the work stays in proportion however large the bucket. This holds for tau of 2 alone.
5. Links are joined into components without gathering them.

Rows: a null text is an empty one and has fingerprint zero, which is linked like any other. Repeated rows and repeated
ids get a row each. A null id is never a component's smallest id; a component of null ids alone has a null id. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from math import comb

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, prepare, rows_of
from .components import connected_components

BITS = 64
PROBE_COST = 4.0  #: of filing one value, in verified candidates


def shingle_hashes(text: str, words_per_shingle: int = 3, seed: int = 42) -> list[int]:
    """The XXH64 of all word shingles in order, repeats included; A-Z are lower-cased first."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # of bytes: on 0x20 and 0x09 to 0x0D, and A-Z only
    if not words:
        return []
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(words_per_shingle, len(words))
    starts = [0, *(ends[: len(words) - k] + 1).tolist()]
    return [xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, ends[k - 1 :].tolist(), strict=True)]


def majority(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes."""
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 8192):
        total += np.unpackbits(hashes[at : at + 8192].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str, words_per_shingle: int = 3, seed: int = 42) -> int:
    """Majority of the bits of the hashes of all word shingles; zero for a text without words."""
    return majority(np.array(shingle_hashes(text, words_per_shingle, seed), np.uint64))


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""
    prepare(docs.sparkSession)

    def compute(batches):
        import pyarrow as pa

        for b in batches:
            fps = [fingerprint(t, words_per_shingle, seed) for (t,) in rows_of(b, "text")]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(np.array(fps, np.uint64).view(np.int64))], names=["doc_id", "fp"])

    df = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return df.mapInArrow(compute, "doc_id long, fp long")


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and in how many of them bits i and j are both set."""

    def count(batches):
        import pyarrow as pa

        total, n = np.zeros((BITS, BITS)), 0
        for b in batches:
            bits = np.unpackbits(b["fp"].to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            for at in range(0, len(bits), 65536):
                part = bits[at : at + 65536]
                total += part.T @ part
            n += len(bits)
        at = np.arange(BITS * BITS + 1)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(total.ravel().astype(np.int64), n))], names=["at", "n"])

    out = np.zeros(BITS * BITS + 1, np.int64)
    for at, n in fps.mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n")).collect():  # 4097 rows
        out[at] = n
    return int(out[-1]), out[:-1].reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Parts of nearly equal size; each grows from its most correlated bit by the bits most correlated with it."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(corr, 0)
    left, groups = [*range(BITS)], []
    for k in range(parts):
        size = len(left) // (parts - k)
        group = [max(left, key=lambda i: corr[i, left].sum())]
        left.remove(group[0])
        while len(group) < size:
            best = max(left, key=lambda i: corr[i, group].sum())
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def agreement(p: np.ndarray) -> np.ndarray:
    """Chance that two fingerprints differ in at most t of some bits, for each t, if bits are set with chances p."""
    dist = np.ones(1)
    for x in p:
        d = 2 * x * (1 - x)
        dist = np.append(dist * (1 - d), 0) + np.append(0, dist * d)
    return np.cumsum(dist)


def allocate(cost: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds from -1 that sum to ``total`` with the least cost; cost[i][t] is of part i at threshold t, and -1 costs nothing."""
    best = {0: (0.0, [])}
    for part in cost:
        new: dict[int, tuple[float, list[int]]] = {}
        for done, (spent, chosen) in best.items():
            for t in range(-1, len(part)):
                x = (spent + (part[t] if t >= 0 else 0.0), [*chosen, t])
                if done + t not in new or x < new[done + t]:
                    new[done + t] = x
        best = new
    return best[total]


def value_of(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The part's value, its bits in their own places."""
    return fps & np.uint64(sum(1 << b for b in bits))


def within(value: np.ndarray, bits: list[int], t: int) -> list[np.ndarray]:
    """All values within t bits of each value, itself first."""
    out, ring = [value], [(value, 0)]
    for _ in range(t):
        ring = [(v ^ np.uint64(1 << b), k + 1) for v, at in ring for k, b in enumerate(bits) if k >= at]
        out += [v for v, _ in ring]
    return out


def plan_parts(fps: DataFrame, tau: int) -> tuple[list[list[int]], list[int], DataFrame]:
    """Bits and threshold of each part, and the counts of the parts' values (part, key, n)."""
    n, both = bit_counts(fps)
    options = [group_bits(n, both, m) for m in range(max(1, tau), tau + 2)]
    masks = [(k, m, sum(1 << b for b in bits)) for k, groups in enumerate(options) for m, bits in enumerate(groups)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    parts = F.array(*(F.struct(F.lit(k).alias("option"), F.lit(m).alias("part"), F.col("fp").bitwiseAND(F.lit(signed(mask)).cast("long")).alias("key")) for k, m, mask in masks))
    values = cut(fps.select(F.inline(parts)).groupBy("option", "part", "key").agg(F.count("*").alias("n")), "values")
    pairs = {(r["option"], r["part"]): float(r["pairs"]) for r in values.groupBy("option", "part").agg(F.sum(F.expr("double(n) * (n - 1) / 2")).alias("pairs")).collect()}
    p, choices = np.diag(both) / max(n, 1), []
    for k, groups in enumerate(options):
        cost = []
        for m, bits in enumerate(groups):
            chance = agreement(p[bits])
            probes = [sum(comb(len(bits), d) for d in range(t + 1)) for t in range(tau + 1)]
            cost.append([pairs.get((k, m), 0.0) * chance[t] / max(chance[0], 1e-300) + PROBE_COST * n * (probes[t] + (t > 0)) for t in range(tau + 1)])
        choices.append((*allocate(cost, tau - len(groups) + 1), k))
    _, thresholds, k = min(choices)
    return options[k], thresholds, values.where(F.col("option") == k).select("part", "key", "n")


def near(members: np.ndarray, tau: int):
    """Spanning links (a, b) of the graph of members that differ in at most tau bits."""
    left = members
    while len(left) > 1:
        root, left, frontier = left[0], left[1:], [left[0]]
        while frontier and len(left):
            close = np.bitwise_count(left ^ frontier.pop()) <= tau
            if close.any():
                new, left = left[close], left[~close]
                frontier.extend(new)
                yield from ((root, x) for x in new)


def links(fps: DataFrame, tau: int = 2, bucket: int = 4096) -> DataFrame:
    """Links (a, b) between distinct fingerprints: their graph has the same components as that of all pairs within tau bits."""
    import pyarrow as pa

    if tau != 2:
        raise ValueError("large buckets are split for two differing bits only")
    parts, thresholds, values = plan_parts(fps, tau)

    def file(batches):
        for b in batches:
            fp = b["fp"].to_numpy().view(np.uint64)
            for m, (bits, t) in enumerate(zip(parts, thresholds, strict=True)):
                if t >= 0:
                    for key in within(value_of(fp, bits), bits, t):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), m, np.int32)), pa.array(key.view(np.int64)), b["fp"]], names=["part", "key", "fp"])

    def verify(batches):
        now, held = None, []
        out: list[tuple[int, int]] = []
        for b in batches:
            for part, key, fp in zip(b["part"].to_pylist(), b["key"].to_pylist(), b["fp"].to_pylist(), strict=True):
                if (part, key) != now:
                    if len(held) > 1:
                        out += near(np.unique(np.array(held, np.int64).view(np.uint64)), tau)
                    now, held = (part, key), []
                held.append(fp)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in zip(*out, strict=True)], names=["a", "b"])
                out = []
        if len(held) > 1 and (out := [*near(np.unique(np.array(held, np.int64).view(np.uint64)), tau)]):
            yield pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in zip(*out, strict=True)], names=["a", "b"])

    filed = fps.select("fp").mapInArrow(file, "part int, key long, fp long")
    if all(t <= 0 for t in thresholds):  # the counts at hand are the buckets' sizes
        sizes = values
    else:
        sizes = filed.groupBy("part", "key").agg(F.count("*").alias("n"))
    large = cut(sizes.where(F.col("n") > bucket).select("part", "key"), "large")
    crowds = bool(large.take(1))
    small = filed.join(large, ["part", "key"], "left_anti") if crowds else filed
    found = small.repartition("part", "key").sortWithinPartitions("part", "key").mapInArrow(verify, "a long, b long")
    if crowds:
        crowded = filed.join(large, ["part", "key"], "left_semi").select("fp").distinct()
        flips = F.array(F.lit(0).cast("long"), *(F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(BITS)))
        middle = crowded.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("middle"))
        stars = middle.groupBy("middle").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("all")).where(F.size("all") > 1)
        found = found.unionByName(stars.select("a", F.explode("all").alias("b")).where("a != b").distinct())
    return found


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tau: int = 2, words_per_shingle: int = 3, seed: int = 42, bucket: int = 4096) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest id whose fingerprint is reachable by links of at most tau bits."""
    each = cut(fingerprints(docs, id_col=id_col, text_col=text_col, words_per_shingle=words_per_shingle, seed=seed), "fingerprints")
    distinct = cut(each.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = connected_components(links(distinct, tau, bucket))
    held = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = held.join(held.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return each.join(ids, "fp").select("doc_id", "fp", "component_id")
