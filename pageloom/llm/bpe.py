"""Token ids of whole texts, through the tokenizers library with a memory of words seen before."""

from __future__ import annotations

import re
import struct

import numpy as np

#: A blank that another white space character follows; elsewhere a blank always starts a new piece.
_ODD = re.compile(r" \s").search
_AT_BLANK = re.compile(r" (?=\S)").split
#: Runs of ASCII letters with the blank before them, single line ends, and runs of sentence marks.
_SIMPLE = re.compile(r"(?: ?[A-Za-z]++|[.,|;:!?%$&*#]++|\n)++").fullmatch
_PARTS = re.compile(r" ?[A-Za-z]+|[.,|;:!?%$&*#]+|\n").findall

_loaded: dict[tuple, "CachedEncoder"] = {}


class CachedEncoder:
    """``encode(text)`` gives little-endian unsigned 32-bit ids, the same as the library's ``encode(text, add_special_tokens=False)``.

    A byte-level pre-tokenizer starts a new piece at every blank that a character other than white space follows, so the
    text is cut there and each part's ids are looked up; parts not seen lately are encoded by the library, many at once.
    Texts that hold an added token's string are encoded whole. At most two generations of ``words`` parts are remembered.
    """

    def __init__(self, path: str, words: int = 900_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        pre = str(self.tokenizer.pre_tokenizer)
        self.by_word = pre.startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in pre and self.tokenizer.normalizer is None
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words, self.young, self.old = words, {}, {}
        vocabulary = self.tokenizer.get_vocab()
        self.starts = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for piece, i in vocabulary.items():
            self.starts[i] = piece.startswith("Ġ")

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if not self.by_word or any(a in text for a in self.added):
            return self.whole(text)
        first, *rest = _AT_BLANK(text) if _ODD(text) else text.split(" ")
        parts = [" " + x for x in rest]
        if first:
            parts.insert(0, first)
        try:
            return b"".join(map(self.young.__getitem__, parts))
        except KeyError:
            self.learn(parts)
            return b"".join(map(self.young.__getitem__, parts))

    def learn(self, parts: list[str]) -> None:
        if len(self.young) > self.words:
            self.old, self.young = self.young, {}
        young, old, composed, plain = self.young, self.old, {}, {}
        for part in {*parts}.difference(young):
            if (known := old.get(part)) is not None:
                young[part] = known
            elif part[1:].isalpha():
                plain[part] = None
            elif _SIMPLE(part) and "\n\n" not in part and not part.endswith("\n") and len(pieces := _PARTS(part)) > 1:
                composed[part] = pieces
                for piece in pieces:
                    if piece not in young:
                        plain[piece] = None
            else:
                plain[part] = None
        self.remember([*plain])
        for part, pieces in composed.items():
            young[part] = b"".join(map(young.__getitem__, pieces))

    def remember(self, new: list[str]) -> None:
        """Words of ASCII letters are single pieces, so the model gets them as the pre-tokenizer would give them, without the
        passes over the text. Other words that start with their only blank are encoded as one text; the ids that start with
        a blank tell them apart.
        """
        young, tokenize, rest = self.young, self.tokenizer.model.tokenize, []
        for x in new:
            if x.isascii() and (x[1:] if x[0] == " " else x).isalpha():
                ids = [t.id for t in tokenize("Ġ" + x[1:] if x[0] == " " else x)]
                young[x] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                rest.append(x)
        joined = [x for x in rest if x[0] == " " and x[1:].isalnum()]
        if joined:
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(joined)], add_special_tokens=False)[0].ids, "<u4")
            at = [*np.flatnonzero(self.starts[ids]).tolist(), len(ids)]
            if len(at) != len(joined) + 1:
                raise AssertionError("words and ids do not agree")
            data = ids.tobytes()
            young.update((x, data[4 * a : 4 * b]) for x, a, b in zip(joined, at, at[1:], strict=False))
        other = [x for x in rest if x not in young]
        for x, e in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False) if other else [], strict=True):
            young[x] = np.array(e.ids, "<u4").tobytes()


def encoder(path: str, words: int = 900_000) -> CachedEncoder:
    """One encoder a Python worker; it outlives the task."""
    if (path, words) not in _loaded:
        _loaded.clear()
        _loaded[path, words] = CachedEncoder(path, words)
    return _loaded[path, words]
