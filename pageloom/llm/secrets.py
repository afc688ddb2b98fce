"""Secret scans with DataFrame expressions only.

Base spans (assign, access, hex) follow fixed patterns. A fourth kind, random, comes from two character Markov models,
of random strings and of ordinary identifiers, trained by counting character pairs of labelled samples: a token of
``least_chars`` or more characters is reported if its log-likelihood ratio per transition is at least ``least_ratio``.

Spark's regular expressions give matches but no places. The text between the matches is what ``split`` returns, so the
places are running sums of the lengths of both. Sums, overlaps and masks are folded in blocks of 256 in order of place,
so that the work grows in proportion to a text's matches.

Rows: a null text is an empty one and has no spans; texts of any length are scanned whole. Repeated rows get a row each. Without samples of both classes no
token is reported as random. Columns of ``docs`` are kept and come back unchanged; results are in one struct column,
whose name the caller picks.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # 18 or more in all; a shorter run of these characters holds no match either
HEX = r"[0-9a-f]{16,}"
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}"
KINDS = ("assign", "access", "hex", "random")

#: Parts of ordinary identifiers, fixed values.
PARTS = (
    "get set add remove update delete create find load save read write open close start stop run build parse format encode decode"
    " user name account email address order item product price count total index value result error message status state type"
    " file path folder image page text line word table column row key list map node tree graph server client request response"
    " session config option default version release number length width height color time date year month first last next previous"
    " the and for with from that this which there other about people would these into under after while house water world great"
    " nation tion ment able less ness ing ough ther ent ion que des les ein und sch lich keit heit ung aire eau para cion mente"
).split()


def samples(spark: SparkSession, n: int = 20_000) -> DataFrame:
    """Labelled samples (text, random) made by rule: digests in hexadecimal, base 64 and capitals, and joined identifier parts or runs of one character."""
    words = F.from_json(F.lit(json.dumps(PARTS)), "array<string>")
    pick = lambda k: F.element_at(words, (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(len(PARTS))) + 1).cast("int"))
    digest = F.sha2(F.concat(F.lit("sample "), F.col("id").cast("string")), 256)
    random = F.element_at(F.array(F.substring(digest, 1, 40), F.regexp_replace(F.base64(F.unhex(digest)), "=", ""), F.translate(F.upper(F.substring(F.base64(F.unhex(digest)), 1, 32)), "+/=", "23"), F.translate(F.base64(F.unhex(digest)), "+/=", "-_")), (F.col("id") % 4 + 1).cast("int"))
    camel = F.concat(pick(1), F.initcap(pick(2)), F.initcap(pick(3)), F.initcap(pick(4)))
    digits = (F.pmod(F.xxhash64("id", F.lit(9)), F.lit(2100))).cast("string")
    run = F.repeat(F.substring(F.lit("ABCXabcx019-_=+/"), F.pmod(F.xxhash64("id", F.lit(11)), F.lit(16)).cast("int") + 1, F.lit(1)), 24)
    plain = F.element_at(F.array(F.concat_ws("_", pick(1), pick(2), pick(3), pick(4)), camel, F.concat_ws("-", pick(1), pick(2), digits, pick(3)), F.concat_ws("/", pick(1), pick(2), pick(3), digits), F.concat(pick(1), pick(2), pick(3), pick(4), pick(5)), F.upper(F.concat_ws("_", pick(1), pick(2), pick(3))), run), (F.col("id") % 7 + 1).cast("int"))
    ids = spark.range(n)
    return ids.select(random.alias("text"), F.lit(True).alias("random")).unionByName(ids.select(plain.alias("text"), F.lit(False).alias("random")))


def train(labelled: DataFrame, smoothing: float = 0.5, alphabet: int = 66) -> list[float]:
    """Log-likelihood ratio, random over ordinary, of each pair of ASCII characters (128 a + b), from counts of the samples' pairs."""
    codes = F.transform(F.split("text", ""), lambda c: F.ascii(c))
    pairs = labelled.where("text is not null and length(text) > 1").select("random", codes.alias("c")).select("random", F.explode(F.zip_with(F.slice("c", 1, F.size("c") - 1), F.slice("c", 2, F.size("c") - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("p"))
    counts: dict[bool, dict[tuple[int, int], int]] = {True: {}, False: {}}
    for r in pairs.where("p.a between 1 and 127 and p.b between 1 and 127").groupBy("random", "p.a", "p.b").count().collect():  # at most 2 * 127 * 127 rows
        counts[r["random"]][r["a"], r["b"]] = r["count"]
    if not counts[True] or not counts[False]:
        return [-math.inf] * 128 * 128

    def logs(held):
        after = [0] * 128
        for (a, _), n in held.items():
            after[a] += n
        return [math.log((held.get((a, b), 0) + smoothing) / (after[a] + smoothing * alphabet)) for a in range(128) for b in range(128)]

    return [x - y for x, y in zip(logs(counts[True]), logs(counts[False]), strict=True)]


def let(value: Column, body) -> Column:
    """body(value), with the value computed once however often the body, or a lambda within it, uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


BLOCK = 256  #: items of an array that are folded together


def _blocks(items: Column) -> Column:
    """The items in arrays of at most BLOCK."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int")), lambda k: F.slice(items, k * BLOCK + 1, F.lit(BLOCK)))


def _running(items: Column, zero: int, of, combine, put, kind: str) -> Column:
    """put(state, item), an array of ``kind``, of all items in order, joined; the state combines of(item) of the items before.

    ``combine`` is associative and ``zero`` its neutral element. Blocks are combined first, so that the work grows in proportion.
    """
    none = F.from_json(F.lit("[]"), f"array<{kind}>")

    def firsts(blocks: Column) -> Column:
        each = F.transform(blocks, lambda b: F.aggregate(b, F.lit(zero), lambda n, x: combine(n, of(x))))
        return F.aggregate(each, F.array(F.lit(zero)), lambda out, n: F.concat(out, F.array(combine(F.element_at(out, -1), n))))

    def step(held: Column, x: Column) -> Column:
        return F.struct(combine(held["at"], of(x)).alias("at"), F.concat(held["out"], put(held["at"], x)).alias("out"))

    def joined(blocks: Column) -> Column:
        return let(firsts(blocks), lambda first: F.flatten(F.transform(blocks, lambda b, k: F.aggregate(b, F.struct(F.element_at(first, k + 1).alias("at"), none.alias("out")), step)["out"])))

    return let(items, lambda held: let(_blocks(held), joined))


def _places(text: Column, pattern: str) -> Column:
    """array<struct<start, end>> of all matches, in order, in code points, end exclusive."""

    def steps(matches: Column) -> Column:
        return F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(matches)), matches, lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("own")))

    def put(at: Column, s: Column) -> Column:
        return F.array(F.struct((at + s["gap"]).alias("start"), (at + s["gap"] + s["own"]).alias("end")))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: _running(steps(m), 0, lambda s: s["gap"] + s["own"], lambda a, b: a + b, put, "struct<start:int,end:int>"))


def _apart(base: Column, random: Column) -> Column:
    """The random spans that overlap no base span: none that starts before a span's end ends after its start."""
    starts = F.transform(base, lambda b: F.struct(b["start"].alias("at"), F.lit(1).alias("own"), b["start"].alias("start"), b["end"].alias("end")))
    asked = F.transform(random, lambda r: F.struct(r["end"].alias("at"), F.lit(0).alias("own"), r["start"].alias("start"), r["end"].alias("end")))
    kind = "struct<start:int,rank:int,end:int>"
    none = F.from_json(F.lit("[]"), f"array<{kind}>")

    def put(last: Column, x: Column) -> Column:
        return F.when((x["own"] == 0) & (last <= x["start"]), F.array(F.struct(x["start"].alias("start"), F.lit(KINDS.index("random")).alias("rank"), x["end"].alias("end")))).otherwise(none)

    return _running(F.array_sort(F.concat(starts, asked)), 0, lambda x: F.when(x["own"] == 1, x["end"]).otherwise(0), F.greatest, put, kind)


def _spans(kind: str, places: Column) -> Column:
    return F.transform(places, lambda p: F.struct(p["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), p["end"].alias("end")))


def scan(docs: DataFrame, ratios: list[float], *, text_col: str = "text", out_col: str = "found", least_chars: int = 20, least_ratio: float = 0.7) -> DataFrame:
    """``docs`` with a struct of ``base`` and ``spans``: arrays of (start, rank, end) by start, then kind; rank is the kind's place in KINDS."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    low = F.lower(text)
    none = F.from_json(F.lit("[]"), "array<struct<start:int,rank:int,end:int>>")
    named = F.lit(False)
    for word in ("password", "passwd", "secret", "token", "apikey", "api_key"):
        named = named | low.contains(word)
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    assign = F.filter(F.zip_with(_places(text, ASSIGN), values, lambda p, v: F.struct(p["start"].alias("start"), p["end"].alias("end"), F.length(v).alias("n"))), lambda x: x["n"] >= 12)
    guarded = lambda guard, spans: F.when(guard, spans).otherwise(none)
    base = F.array_sort(F.concat(guarded(named & text.rlike(ASSIGN), _spans("assign", assign)), guarded(text.contains("AKIA") & text.rlike(ACCESS), _spans("access", _places(text, ACCESS))), guarded(text.rlike(HEX), _spans("hex", _places(text, HEX)))))
    table = F.from_json(F.lit(json.dumps([round(max(-99.0, x), 6) for x in ratios])), "array<double>")

    def ratio(token: Column) -> Column:
        def mean(codes: Column) -> Column:
            pairs = F.zip_with(F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes) - 1), lambda a, b: F.element_at(table, a * 128 + b + 1))
            return F.aggregate(pairs, F.lit(0.0), lambda n, x: n + x) / F.greatest(F.size(codes) - 1, F.lit(1))

        return let(F.transform(F.split(token, ""), lambda c: F.ascii(c)), mean)

    pattern = TOKEN % least_chars
    tokens = F.zip_with(_places(text, pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda p, m: F.struct(p["start"].alias("start"), p["end"].alias("end"), ratio(m).alias("ratio")))
    random = guarded(text.rlike(pattern), _spans("random", F.filter(tokens, lambda x: x["ratio"] >= least_ratio)))
    apart = F.when(F.size("_base") == 0, F.col("_random")).otherwise(_apart(F.col("_base"), F.col("_random")))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    held = docs.select(row.alias("_row"), base.alias("_base"), random.alias("_random"))
    held = held.select("_row", "_base", F.when(F.size("_random") == 0, F.col("_base")).otherwise(F.array_sort(F.concat("_base", apart))).alias("_spans"))
    return held.select("_row.*", F.struct(F.col("_base").alias("base"), F.col("_spans").alias("spans")).alias(out_col))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame, id_col: str = "doc_id", out_col: str = "found") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""

    def count(rank):
        return F.size(F.filter(F.col(out_col)["base"], lambda s: s["rank"] == rank)).cast("long").alias(f"n_{KINDS[rank]}")

    n = map(count, range(3))
    return found.select(id_col, *n, F.sha2(joined(F.col(out_col)["base"]), 256).alias("base_sha256"), joined(F.col(out_col)["spans"]).alias("spans"))


def redact(docs: DataFrame, ratios: list[float], *, text_col: str = "text", mask: str = "[SECRET]", **options) -> DataFrame:
    """``docs`` with the same columns and every span of the text replaced; spans that overlap or touch are replaced together. Null texts stay null."""
    found = scan(docs, ratios, text_col=text_col, out_col="_found", **options)
    text = F.col(text_col)

    def gap(last: Column, x: Column) -> Column:
        """What lies between a span that touches none before it and the end of those."""
        return F.when(x["start"] > last, F.array(F.struct(F.greatest(last, F.lit(0)).alias("start"), x["start"].alias("end")))).otherwise(F.from_json(F.lit("[]"), "array<struct<start:int,end:int>>"))

    def cut_out(block: Column) -> Column:
        """The block's gaps of the text, found from the first one on and not from the text's start."""
        first = block[0]["start"]
        part = text.substr(first + 1, F.element_at(block, -1)["end"] - first)
        return let(part, lambda own: F.transform(block, lambda g: F.substring(own, g["start"] - first + 1, g["end"] - g["start"])))

    def replaced(spans: Column) -> Column:
        last = F.struct(F.array_max(F.transform(spans, lambda s: s["end"])).alias("start"), F.length(text).alias("end"))
        gaps = F.concat(_running(spans, -1, lambda x: x["end"], F.greatest, gap, "struct<start:int,end:int>"), F.array(last))
        pieces = let(gaps, lambda held: F.flatten(F.transform(_blocks(held), cut_out)))
        return F.when(F.size(spans) > 0, F.array_join(pieces, mask)).otherwise(text)

    return found.select(*(let(F.col("_found")["spans"], replaced).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns))
