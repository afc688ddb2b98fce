"""Vocabularies of byte-pair encodings: the map of bytes to printable characters, and merges from ranks."""

from __future__ import annotations


def byte_characters() -> dict[int, str]:
    """A printable character for each byte: itself where Latin-1 prints it, else the next one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def printable(token: bytes) -> str:
    own = byte_characters()
    return "".join(own[b] for b in token)


def as_bytes(text: str) -> bytes:
    own = {c: b for b, c in byte_characters().items()}
    return bytes(own[c] for c in text)


def merge_of(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The pair that a token was merged from: its bytes, merged again and again at the lowest rank below its own."""
    own, parts = ranks[token], [token[k : k + 1] for k in range(len(token))]
    while len(parts) > 2:
        rank, at = min((ranks.get(parts[k] + parts[k + 1], own), k) for k in range(len(parts) - 1))
        if rank >= own:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    if len(parts) != 2:
        raise ValueError(f"{token!r} is not the merge of two tokens")
    return parts[0], parts[1]


def merges(ranks: dict[bytes, int]) -> list[tuple[str, str]]:
    """All merges in order of rank, in printable characters."""
    longer = sorted((t for t in ranks if len(t) > 1), key=ranks.__getitem__)
    return [tuple(map(printable, merge_of(t, ranks))) for t in longer]


def widths_of_metrics(lines: list[str], encoding: dict[int, str], missing: int = 500) -> list[int]:
    """256 widths from the character lines of a font metrics file (``C 65 ; WX 667 ; N A ; ...``); ``encoding`` names the glyph of a code."""
    held = {}
    for line in lines:
        parts = {p[0]: p[1:] for p in (x.split() for x in line.split(";")) if p}
        if "WX" in parts and "N" in parts:
            held[parts["N"][0]] = int(float(parts["WX"][0]))
    return [held.get(encoding.get(c, ""), missing) for c in range(256)]
