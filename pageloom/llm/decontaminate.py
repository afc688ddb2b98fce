"""Benchmark decontamination: a prefix-filtered containment join over windows the size of benchmark items.

A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one window. A document
contains a window if the window's words occur in it one after the other. For containment of a whole window one prefix
token is enough: its rarest shingle, in the order of the shingles' counts over all documents, at its place in the window.

1. The items' shingles of ``shingle`` words (all of a shorter item) are counted in all documents; each window is filed
   under its rarest.
2. Documents give a candidate for every position with such a shingle, with the words around it. A table of bits, of a
   bounded size whatever the benchmark's, keeps most others out; what it lets through by chance finds no partner.
3. Candidates and windows are joined on the shingle. Starts before the first word or without room for the whole window
   are ruled out by place and length, and the rest is verified word for word.
4. Equal windows of several items are one window here; it stands for the set of its items. A document's sets are made
   distinct before items are looked up, so a passage that many items share costs each document what one item's would.

So the benchmark's windows are shuffled or broadcast as Catalyst decides by their size, never held by the driver, and the
documents are read twice whatever the benchmark's size. Each document's hits are united before they are counted.

Rows: a null or empty text has no words, and so no hits. Repeated documents get a row each; repeated items (the same id)
count once. Items with a null id count as items but are left out of the list of ids. An empty benchmark hits nothing, and
an empty table gives no rows. Other columns of either table are not read, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, prepare, rows_of

#: Of UTF-8 after A-Z are lower-cased: digits, a-z and everything beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xFF]+")


def words_of(text: bytes | str | None) -> list[bytes]:
    """The words in UTF-8; lower() of bytes changes A-Z only."""
    if not text:
        return []
    return WORD.findall((text.encode() if isinstance(text, str) else text).lower())


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k hashes in a row."""
    out = words[: len(words) - k + 1].copy()
    for j in range(1, k):
        out = (out ^ out >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) + words[j : len(words) - k + 1 + j]
    return (out ^ out >> np.uint64(32)) * np.uint64(0x94D049BB133111EB)


def shingles_of(benchmark: DataFrame, id_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """Each place of each window of each item: item, id, window (its words), start, place, token (a shingle's hash), words (the shingle's)."""

    def run(batches):
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        schema = pa.schema([("item", pa.int64()), ("id", pa.string()), ("words", pa.list_(pa.string())), ("tokens", pa.list_(pa.int64())), ("size", pa.int32())])
        for b in batches:
            out = []
            for item, i, text in rows_of(b, "item", "id", "text"):
                if words := words_of(text):
                    k = min(shingle, len(words))
                    hashes = shingle_hashes(np.array([xxh64_intdigest(w) for w in words], np.uint64), k)
                    out.append((item, i, [w.decode() for w in words], hashes.view(np.int64), k))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], f.type) for c, f in enumerate(schema)], schema=schema)

    rows = benchmark.select(F.monotonically_increasing_id().alias("item"), F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").alias("text"))
    items = cut(rows.mapInArrow(run, "item long, id string, words array<string>, tokens array<long>, size int"), "items")
    m = F.least(F.lit(window), F.size("words"))
    starts = items.select("item", "id", "words", "tokens", "size", m.alias("m"), F.explode(F.sequence(F.lit(0), F.size("words") - m)).alias("start"))
    places = starts.select("item", "id", F.expr("slice(words, start + 1, m)").alias("window"), "size", "start", F.posexplode(F.expr("slice(tokens, start + 1, m - size + 1)")).alias("place", "token"))
    return places.withColumn("words", F.expr("slice(window, place + 1, size)")).drop("size")


def bits_of(tokens: DataFrame, most: int = 1 << 28) -> dict:
    """A table of at most ``most`` bits (a power of two) that says of a hash whether it may be one of ``tokens`` (token, words); their words, and their sizes."""
    from xxhash import xxh64_intdigest

    tokens = tokens.distinct().persist(StorageLevel.DISK_ONLY)
    try:
        size = min(most, max(1 << 12, 1 << (16 * tokens.count()).bit_length())) // 64
        own = tokens.select(F.expr(f"cast(shiftrightunsigned(token, 6) & {size - 1}L as int)").alias("at"), F.expr("shiftleft(1L, cast(token & 63L as int))").alias("bit"))
        rows = own.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most ``most`` / 64
        words = [r[0].encode() for r in tokens.select(F.explode("words")).distinct().collect()]  # the benchmark's vocabulary
        sizes = sorted(r[0] for r in tokens.select(F.size("words")).distinct().collect())
    finally:
        tokens.unpersist()
    table = np.zeros(size, np.uint64)
    table[rows["at"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    hashes = np.array([0, *map(xxh64_intdigest, words)], np.uint64)
    return {"table": table, "places": {w: k for k, w in enumerate(words, 1)}, "hashes": hashes, "sizes": sizes}


def seen(words: list[bytes], bits: dict) -> list[tuple[int, np.uint64]]:
    """(position, token) of the shingles that may be among those of the table; all their words are known ones."""
    get, table, out = bits["places"].get, bits["table"], []
    own = np.array([get(w, 0) for w in words], np.int64)
    if not own.any():
        return out
    hashes, known = bits["hashes"][own], own > 0
    for k in bits["sizes"]:
        if k > len(words):
            break
        whole = known[: len(words) - k + 1]
        for j in range(1, k):
            whole = whole & known[j : len(words) - k + 1 + j]
        at = np.flatnonzero(whole)
        if len(at):
            tokens = shingle_hashes(hashes, k)[at]
            held = table[(tokens >> np.uint64(6)) & np.uint64(len(table) - 1)] >> (tokens & np.uint64(63)) & np.uint64(1)
            some = np.flatnonzero(held)
            out += zip(at[some].tolist(), tokens[some], strict=True)
    return out


def token_counts(docs: DataFrame, bits: dict, flush: int = 1 << 18) -> DataFrame:
    """How often each shingle that may be among those of the table occurs in all texts."""
    held = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        import pyarrow as pa

        total: dict[int, int] = {}

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(np.array([*total], np.uint64).view(np.int64)), pa.array([*total.values()], pa.int64())], names=["token", "n"])

        for b in batches:
            for (text,) in rows_of(b, "text"):
                for _, token in seen(words_of(text), held.value):
                    total[int(token)] = total.get(int(token), 0) + 1
            if len(total) > flush:
                yield rows()
                total.clear()
        yield rows()

    return docs.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def candidates(docs: DataFrame, bits: dict, window: int, flush: int = 1 << 13) -> DataFrame:
    """Of each row (key, id, text) one with its words' number, and one for each of its candidates, which alone have a
    position: at, token, the words around and how many of them lie before the position.
    """
    held = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        import pyarrow as pa

        kinds = {"at": pa.int32(), "token": pa.int64(), "near": pa.list_(pa.string()), "before": pa.int32()}
        for b in batches:
            names, n_words, found = ["key", "id", "n_words", *kinds], [], []

            def rows(b=b, names=names, found=found):
                keys, *own = zip(*found, strict=True)
                empty = pa.nulls(len(keys), b["id"].type), pa.nulls(len(keys), pa.int64())
                return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *empty, *map(pa.array, own, kinds.values())], names=names)

            for key, text in rows_of(b, "key", "text"):
                words = words_of(text)
                for at, token in seen(words, held.value):
                    a = max(0, at - window + 1)
                    found.append((key, at, int(token.view(np.int64)), [w.decode() for w in words[a : at + window]], at - a))
                    if len(found) == flush:
                        yield rows()
                        found.clear()
                n_words.append(len(words))
            if found:
                yield rows()
            yield pa.RecordBatch.from_arrays([b["key"], b["id"], pa.array(n_words, pa.int64()), *(pa.nulls(b.num_rows, t) for t in kinds.values())], names=names)

    own = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"key long, id {own}, n_words long, at int, token long, near array<string>, before int")


def contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", window: int = 10, shingle: int = 3) -> DataFrame:
    """Each row's key (monotonically_increasing_id of ``docs``), id, n_words, hits (word spans that windows cover, united, end exclusive), items (their ids, as strings, sorted), n_items."""
    spark = prepare(docs.sparkSession)
    own = docs.select(F.monotonically_increasing_id().alias("key"), F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    places = shingles_of(benchmark, item_id_col, item_text_col, window, shingle)
    counts = token_counts(own, bits_of(places.select("token", "words")))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "place", "words")).alias("r")
    owner = F.expr("struct(id, if(id is null, item, null) as nameless)")
    windows = places.join(counts, "token", "left").groupBy("window").agg(rarest, F.sort_array(F.collect_set(owner)).alias("owners"))
    windows = cut(windows.select("window", "r.token", "r.place", "r.words", F.sha2(F.to_json("owners"), 256).alias("set"), "owners"), "windows")
    scanned = cut(candidates(own, bits_of(windows.select("token", "words")), window), "scanned")
    found = scanned.where("at is not null").select("key", "at", "token", "near", "before")
    fits = "before >= place and slice(near, before - place + 1, size(window)) = window"  # a slice beyond the last word is shorter
    hits = found.join(windows.select("token", "place", "window", "set"), "token").where(fits).select("key", F.expr("at - place").alias("start"), F.expr("at - place + size(window)").alias("end"), "set")
    hits = cut(hits.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"), F.collect_set("set").alias("sets")), "hits")
    sets = windows.groupBy("set").agg(F.first("owners").alias("owners"))
    named = hits.select("key", F.explode("sets").alias("set")).join(sets, "set").select("key", F.explode("owners").alias("owner")).groupBy("key").agg(F.collect_set("owner").alias("owners"))
    items = named.select("key", F.expr("sort_array(filter(owners.id, i -> i is not null))").alias("items"), F.size("owners").cast("long").alias("n_items"))
    united = hits.select("key", "spans").join(items, "key").mapInArrow(_unite, "key long, hits array<struct<start:int,end:int>>, items array<string>, n_items long")
    none = "from_json('[]', 'array<struct<start:int,end:int>>')"
    each = scanned.where("at is null").select("key", "id", "n_words")
    return each.join(united, "key", "left").select("key", "id", "n_words", F.coalesce("hits", F.expr(none)).alias("hits"), F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"), F.coalesce("n_items", F.lit(0)).alias("n_items"))


def _unite(batches):
    """Spans that overlap or touch become one."""
    import pyarrow as pa

    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for b in batches:
        hits = [[{"start": a, "end": z} for a, z in unite([(s["start"], s["end"]) for s in spans])] for (spans,) in rows_of(b, "spans")]
        yield pa.RecordBatch.from_arrays([b["key"], pa.array(hits, span), b["items"], b["n_items"]], names=["key", "hits", "items", "n_items"])


def unite(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.expr("cast(coalesce(aggregate(hits, 0, (n, h) -> n + h.end - h.start), 0) as long)")
    return found.select(F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
