"""Personal data by weak supervision.

Base spans (email, ip, card, phone) follow fixed patterns and are always kept. Beyond them a wider net gives candidates:
phone numbers without a country code, social security numbers, bank account numbers, spelled-out email addresses and
names of persons. On every candidate, base spans included, four labelers vote yes, no or nothing: the format (check
digits and value ranges), a gazetteer (mail hosts, countries, issuers, given names), the words before it, and how it is
set off from its surroundings. The votes of all documents are counted by pattern; expectation-maximisation on these
counts estimates how reliable each labeler is and how likely a candidate of each pattern is real. A logistic classifier
is trained on these likelihoods and decides on the spans beyond the base ones; besides the votes, the kind and the length
it sees the shape of the span's characters and the words around it, from which it learns what no labeler knows.

Counts of vote patterns reach the driver, whose number depends on the kinds and labelers alone, and at most ``max_spans``
candidates to fit the classifier on, the first by a hash of their text and place.

Rows: a null text is an empty one and has no spans. Repeated rows get a row each and are counted as often. Without any
candidates the classifier accepts none. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, prepare, rows_of

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "local_phone", "ssn", "iban", "spelled_email", "person")

_DIGIT = re.compile("[0-9]").search
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
# A run of digits is tried from its first digit only; from a later one it would fail in the same way.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++").finditer
_CARD = re.compile(r"[0-9](?:[ -]?[0-9]){13,}+").finditer
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]").finditer
_MORE = {
    "local_phone": re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[.-][0-9]{4}(?![0-9]|[.-][0-9])").finditer,
    "ssn": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])").finditer,
    "iban": re.compile(r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Z0-9])").finditer,
    "spelled_email": re.compile(r"(?<![\w.])[A-Za-z0-9._%+-]{1,64} ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,63}(?: ?[\[(] ?dot ?[\])] ?[A-Za-z0-9-]{1,63}){1,8}", re.I).finditer,
    "person": re.compile(r"(?<!\w)(?:(?:Mr|Mrs|Ms|Dr|Prof)\.? |(?:[Nn]ame|[Cc]ontact): )[A-Z][a-z]{1,20}(?: [A-Z][a-z]{1,20}){0,2}").finditer,
}
_TITLES = ("Mr", "Ms", "Dr", "Prof", "ame: ", "ontact: ")

# Gazetteers and context words, fixed values.
MAIL_ENDS = frozenset("com org net edu gov io de fr es uk eu info biz us ca".split())
COUNTRIES = frozenset("AT BE CH CZ DE DK ES FI FR GB GR HU IE IT LU NL NO PL PT SE".split())
GIVEN_NAMES = frozenset(
    "Adam Alan Alice Amy Ana Andrea Andrew Angela Anna Anne Anthony Antoine Antonio Barbara Ben Brian Camille Carlos Carmen Carol Charles Charlotte Christian"
    " Claire Claudia Daniel David Diana Diego Donna Edward Elena Elizabeth Emily Emma Eric Erika Eva Felix Fernando Francisco Frank Friedrich George Hannah Hans"
    " Heinrich Helen Henry Ingrid Isabel Jack Jacques James Jan Jane Javier Jean Jennifer Jessica John Jorge Joseph Juan Julia Julie Karen Karl Kevin Klaus Laura"
    " Lena Leon Linda Lisa Louis Lucas Luis Luisa Lukas Manuel Marco Margaret Maria Marie Mark Marta Martin Mary Matthew Max Michael Michel Miguel Monika Nancy"
    " Nicolas Nina Olivier Otto Pablo Patricia Paul Pedro Peter Philippe Pierre Rachel Richard Robert Rosa Sabine Samuel Sandra Sara Sarah Simon Sofia Sophie"
    " Stefan Steven Susan Susanne Teresa Thomas Ursula Victor Walter William Wolfgang".split()
)
FOR_IT = re.compile(r"phone|tel\b|call|mobile|fax|mail|contact|reach|write|card|visa|credit|iban|account|ssn|social security|\bip\b|address|name|signed", re.I).search
AGAINST_IT = re.compile(r"version|isbn|issn|order|invoice|figure|chapter|section|page|serial|build|release", re.I).search


def emails(text: str) -> list[tuple[int, int]]:
    """Around each @; a local part starts after the match before."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN(text, at + 1)):
            out.append((start, m.end()))
            last = m.end()
            at = text.find("@", last)
        else:
            at = text.find("@", at + 1)
    return out


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))
    return total % 10 == 0


def _part(x: str) -> bool:
    x = x.lstrip("0")
    return len(x) < 3 or len(x) == 3 and int(x) <= 255


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed."""
    out = [(a, z, "email") for a, z in emails(text)] if "@" in text else []
    if _DIGIT(text):
        out += [(*m.span(), "ip") for m in _IP(text) if all(map(_part, m[0].split(".")))]
        out += [(*m.span(), "card") for m in _CARD(text) if len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d)]
        if "+" in text:
            out += [(*m.span(), "phone") for m in _PHONE(text) if 10 <= sum(map(str.isdecimal, m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], BASE.index(s[2])))


def more_candidates(text: str) -> list[tuple[int, int, str]]:
    out = []
    digits = _DIGIT(text)
    for kind, find in _MORE.items():
        if digits if kind in ("local_phone", "ssn", "iban") else "at" in text and ("[" in text or "(" in text) if kind == "spelled_email" else any(t in text for t in _TITLES):
            out += [(*m.span(), kind) for m in find(text)]
    return out


def apart(base: list[tuple[int, int, str]], more: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Of more, in order, those that overlap no base span and none taken before."""
    held = sorted((a, z) for a, z, _ in base)
    starts, last = [a for a, _ in held], [*accumulate((z for _, z in held), max)]
    taken, out = [], []
    for start, end, kind in more:
        at = bisect_left(starts, end)
        own = bisect_left(taken, (end, 0))
        if not (at and last[at - 1] > start) and not (own and taken[own - 1][1] > start):
            insort(taken, (start, end))
            out.append((start, end, kind))
    return out


def votes(text: str, start: int, end: int, kind: str) -> tuple[int, int, int, int]:
    """1 yes, 0 no, -1 nothing: format, gazetteer, context, setting."""
    span = text[start:end]
    digits = "".join(c for c in span if c in "0123456789")
    shape = known = -1
    if kind == "email":
        shape, known = int(".." not in span and span[0] != "."), int(span.rpartition(".")[2].lower() in MAIL_ENDS)
    elif kind == "ip":
        first = int(span.split(".")[0])
        shape, known = int(all(str(int(x)) == x for x in span.split("."))), int(first not in (0, 10, 127, 255))
    elif kind == "card":
        shape, known = 1, int(digits[0] in "3456")
    elif kind in ("phone", "local_phone"):
        area = digits[-10:-7]
        shape, known = int(area[:1] not in ("0", "1")), int(len(digits) in (10, 11, 12)) if kind == "phone" else -1
    elif kind == "ssn":
        shape = int(digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000")
    elif kind == "iban":
        flat = span.replace(" ", "")
        shape, known = int(int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1), int(flat[:2] in COUNTRIES)
    elif kind == "spelled_email":
        shape, known = 1, int(re.split(r"\W+", span)[-1].lower() in MAIL_ENDS)
    elif kind == "person":
        shape, known = int(span[0] in "MDP"), int(not GIVEN_NAMES.isdisjoint(span.split())) or -1
    before = text[max(0, start - 40) : start] + (span if kind == "person" else "")
    context = 1 if FOR_IT(before) else 0 if AGAINST_IT(before) else -1
    setting = int(not (start and text[start - 1].isalnum()) and not text[end : end + 1].isalnum())
    return shape, known, context, setting


def pattern(text: str, start: int, end: int, kind: str) -> str:
    """Kind, votes and a length class, as the classifier sees a candidate."""
    return f"{kind},{','.join(map(str, votes(text, start, end, kind)))},{min(3, (end - start) // 12)}"


def expectation_maximisation(counts: dict[str, int], rounds: int = 50) -> tuple[dict[str, float], dict[str, np.ndarray]]:
    """Likelihood of each pattern, and per labeler and kind the chances of no vote, no and yes for false and true candidates. The start trusts the labelers."""
    names = list(counts)
    n = np.array([counts[p] for p in names], float)
    kind = np.array([KINDS.index(p.split(",")[0]) for p in names], int)
    vote = np.array([[int(v) + 1 for v in p.split(",")[1:5]] for p in names], int).reshape(-1, 4)
    prior = np.full(len(KINDS), 0.6)  # what no labeler speaks against is rather real
    trusted = np.tile(np.array([[1, 2, 0.7], [1, 0.7, 2]]), (4, 1, 1))
    trusted[2] = np.array([[1, 3, 0.3], [1, 0.3, 3]])  # words that speak against a candidate outweigh a form that many numbers have
    usual = np.stack([(np.bincount(kind * 3 + vote[:, k], n, 3 * len(KINDS)).reshape(-1, 3) + 1) for k in range(4)])
    said = usual[:, :, None, 1:] * trusted[:, None, :, 1:]  # a labeler that says the same of all of a kind tells nothing
    said *= (usual[:, :, None, 1:].sum(-1) / said.sum(-1))[..., None]
    first = np.concatenate([np.broadcast_to(usual[:, :, None, :1], (*said.shape[:3], 1)), said], -1) / usual.sum(-1)[:, :, None, None]
    trust = first.copy()
    post = np.full(len(names), 0.5)
    for _ in range(rounds):
        p1, p0 = np.log(prior[kind]), np.log(1 - prior[kind])
        for k in range(4):
            p0, p1 = p0 + np.log(trust[k, kind, 0, vote[:, k]]), p1 + np.log(trust[k, kind, 1, vote[:, k]])
        post = 1 / (1 + np.exp(np.clip(p0 - p1, -60, 60)))
        yes, no = n * post, n * (1 - post)
        prior = (np.bincount(kind, yes, len(KINDS)) + 2) / (np.bincount(kind, n, len(KINDS)) + 4)
        for k in range(4):
            for c, w in enumerate((no, yes)):
                seen = np.bincount(kind * 3 + vote[:, k], w, 3 * len(KINDS)).reshape(-1, 3) + 20 * first[k, :, c]  # as 20 candidates at the start
                trust[k, :, c] = seen / seen.sum(1, keepdims=True)
    return dict(zip(names, post.tolist(), strict=True)), dict(zip(("format", "gazetteer", "context", "setting"), trust, strict=True))


_RUNS = re.compile(r"(.)\1{4,}", re.S).sub
_WORD = re.compile(r"[^\W_]+").findall
HASHED = 2048  #: places of shapes and words
WEIGHTS = 25 + HASHED + 1  #: kinds, votes and lengths, then those, and the bias


def shape_of(span: str) -> str:
    """The span's characters by class, with long runs shortened."""
    return _RUNS(r"\1\1\1\1+", "".join("9" if c.isdecimal() else "A" if c.isupper() else "a" if c.isalpha() else c for c in span))


def features(text: str, start: int, end: int, kind: str) -> list[int]:
    """Places of the weights for a candidate: its kind, votes and length, its shape, the three words before it and the one after."""
    said = votes(text, start, end, kind)
    seen = [f"shape {kind} {shape_of(text[start:end])}", *(f"before {w.lower()}" for w in _WORD(text[max(0, start - 40) : start])[-3:]), *(f"after {w.lower()}" for w in _WORD(text[end : end + 24])[:1])]
    return [KINDS.index(kind), *(9 + 3 * k + v + 1 for k, v in enumerate(said)), 21 + min(3, (end - start) // 12), *sorted({25 + zlib.crc32(x.encode()) % HASHED for x in seen})]


def train_classifier(rows: list[list[int]], target: np.ndarray, rounds: int = 300, l2: float = 0.3) -> np.ndarray:
    """Weights (bias last) of a logistic regression of the likelihoods on the features, by AdaGrad on all rows."""
    w, held = np.zeros(WEIGHTS), np.full(WEIGHTS, 1e-6)
    if not rows:
        return w
    flat = np.array([x for r in rows for x in (*r, WEIGHTS - 1)])
    row = np.repeat(np.arange(len(rows)), [len(r) + 1 for r in rows])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[flat], len(rows)), -60, 60)))
        g = np.bincount(flat, (p - target)[row], WEIGHTS) + l2 * w
        held += g * g
        w -= 0.5 * g / np.sqrt(held)
    return w


def accepted(w: np.ndarray, found: list[int]) -> bool:
    return float(w[found].sum() + w[-1]) > 0


def candidates(docs: DataFrame) -> DataFrame:
    """Every candidate's vote pattern, features, and a hash of its text and place."""

    def run(batches):
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        schema = pa.schema([("pattern", pa.string()), ("features", pa.list_(pa.int32())), ("hash", pa.int64())])
        for b in batches:
            out = []
            for (text,) in rows_of(b, "text"):
                base = base_spans(text)
                if found := [*base, *apart(base, more_candidates(text))]:
                    seed = xxh64_intdigest(text.encode())
                    out += [(pattern(text, *s), features(text, *s), (seed + s[0] * 0x9E3779B97F4A7C15) % (1 << 64) - (1 << 63)) for s in found]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(schema)], schema=schema)

    return docs.select("text").mapInArrow(run, "pattern string, features array<int>, hash long")


def learn(docs: DataFrame, max_spans: int = 20_000) -> tuple[dict[str, int], dict[str, float], np.ndarray]:
    """The counts of all vote patterns, their likelihoods, and the classifier's weights."""
    held = cut(candidates(docs), "candidates")
    counts = dict(sorted((r[0], r[1]) for r in held.groupBy("pattern").agg(F.count("*")).collect()))  # patterns are bounded by kinds and votes
    posterior, _ = expectation_maximisation(counts)
    some = held.orderBy("hash", "pattern", "features").limit(max_spans).select("pattern", "features").collect()
    return counts, posterior, train_classifier([r.features for r in some], np.array([posterior[r.pattern] for r in some]))


def spans_of(text: str, w: np.ndarray) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans, and all spans: accepted candidates are added where they overlap no other span."""
    base = base_spans(text)
    spans = base + [s for s in apart(base, more_candidates(text)) if accepted(w, features(text, *s))]
    return base, sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_spans: int = 20_000) -> DataFrame:
    """doc_id, base and spans: arrays of (kind, start, end) in code points, end exclusive."""
    prepare(docs.sparkSession)
    df = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    _, _, w = learn(df, max_spans)

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for b in batches:
            both = [spans_of(t, w) for (t,) in rows_of(b, "text")]
            columns = [pa.array([[{"kind": k, "start": a, "end": z} for a, z, k in x[side]] for x in both], kind) for side in (0, 1)]
            yield pa.RecordBatch.from_arrays([b["doc_id"], *columns], names=["doc_id", "base", "spans"])

    return df.mapInArrow(run, "doc_id long, base array<struct<kind:string,start:int,end:int>>, spans array<struct<kind:string,start:int,end:int>>")


def joined(column: str):
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    n = map(count, BASE)
    return found.select("doc_id", *n, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
