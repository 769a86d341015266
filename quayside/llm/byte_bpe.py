"""Byte-level BPE ids of many texts at once, equal to those of the tokenizers library.

The pattern that cuts a text into words is evaluated on the bytes of whole
batches, and each different word is encoded once, by tiktoken with the ranks of
the same vocabulary.  The pattern here knows the characters below U+0280; texts
with others, or with blanks outside ASCII, go to the tokenizers library itself.
"""

from __future__ import annotations

import json
from itertools import chain

import numpy as np
import pyarrow as pa
import regex

from quayside.llm.arrays import SpanHashes, flat, ranges

_LETTER, _NUMBER, _OTHER, _BLANK, _FOREIGN = range(5)
_KNOWN = 0x280

#: Words whose ids are kept from one batch to the next.
MOST_WORDS = 50_000


def _kinds() -> np.ndarray:
    kinds = np.full(_KNOWN, _OTHER, np.uint8)
    for point in range(_KNOWN):
        char = chr(point)
        if regex.fullmatch(r"\p{L}", char):
            kinds[point] = _LETTER
        elif regex.fullmatch(r"\p{N}", char):
            kinds[point] = _NUMBER
        elif regex.fullmatch(r"\p{White_Space}", char):
            kinds[point] = _BLANK if point < 128 else _FOREIGN
    return kinds


def _byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    printable = [b for b in range(256) if chr(b).isprintable() and b not in (32, 160, 173)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteBpe:
    """Tokenizer of one vocabulary file; its ids do not depend on how texts are batched."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            self._json = file.read()
        model = json.loads(self._json)["model"]
        vocab = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        byte_of = _byte_letters()
        pieces = [*byte_of, *("".join(m) for m in merges)]
        self._ranks = {bytes(byte_of[c] for c in piece): vocab[piece] for piece in pieces}
        ids = [vocab["".join(m)] for m in merges]
        if ids != sorted(ids):
            raise ValueError(f"{path}: ids are not in the order of the merges")
        self._kinds = _kinds()
        self._library = self._by_rank = None
        self._known: dict[bytes, list[int]] = {}

    def __getstate__(self):
        return self.__dict__ | {"_library": None, "_by_rank": None, "_known": {}}

    def _by_library(self, text: str) -> np.ndarray:
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self._json)
            self._library.encode_special_tokens = True
        return np.array(self._library.encode(text, add_special_tokens=False).ids, np.int32)

    def _kinds_of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Kind of each byte's character, and which texts have a foreign one."""
        kind = self._kinds[np.minimum(data, 127)]
        lead = np.flatnonzero(data >= 0xC0)
        if len(lead):
            point = (data[lead].astype(np.int32) & 0x1F) << 6 | (data[lead + 1] & 0x3F)
            kind[lead] = np.where(data[lead] < 0xCA, self._kinds[np.minimum(point, _KNOWN - 1)], _FOREIGN)
            kind[lead + 1] = kind[lead]
        foreign = np.zeros(len(offsets) - 1, bool)
        foreign[np.searchsorted(offsets, np.flatnonzero(kind == _FOREIGN), "right") - 1] = True
        return kind, foreign

    @staticmethod
    def _starts(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Where words begin.

        Letters, numbers and other signs each run together, with one space
        before them.  Of several blanks the last stands alone or is that space.
        An apostrophe by itself takes the ending after it (fixed by the pattern).
        """
        n = len(data)
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        blank = kind == _BLANK
        before_kind = np.empty(n, np.uint8)
        before_kind[1:], before_kind[0] = kind[:-1], 255
        before_kind[edge[:n]] = 255
        space_before = np.zeros(n, bool)
        space_before[1:] = data[:-1] == 32
        space_before[edge[:n]] = False
        ends_blanks = np.zeros(n, bool)
        ends_blanks[:-1] = ~blank[1:]
        ends_blanks &= ~edge[1:]
        start = np.where(blank, (before_kind != _BLANK) | ends_blanks, (kind != before_kind) & ~space_before)
        start[edge[:n]] = True

        mark = np.flatnonzero((data == 39) & (before_kind != _OTHER) & ~space_before)
        room = offsets[np.searchsorted(offsets, mark, "right")] - mark
        padded = np.concatenate([data, np.zeros(2, np.uint8)])
        one, two = padded[mark + 1], padded[np.minimum(mark + 2, n + 1)]
        size = np.where((room > 1) & np.isin(one, np.frombuffer(b"stmd", np.uint8)), 1, 0)
        pairs = [(b"r"[0], b"e"[0]), (b"v"[0], b"e"[0]), (b"l"[0], b"l"[0])]
        for a, b in pairs:
            size = np.where((room > 2) & (one == a) & (two == b), 2, size)
        taken = size > 0
        start[mark[taken] + 1] = False
        after = mark[taken] + 1 + size[taken]
        inside = after < n
        after = after[inside]
        # The ending's own letters are over; what follows begins anew unless a space joins it.
        start[after[~edge[after]]] |= kind[after[~edge[after]]] != _BLANK
        return np.flatnonzero(start)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has; null is empty."""
        data, offsets = flat(texts)
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
        kind, foreign = self._kinds_of(data, offsets)
        starts = self._starts(data, offsets, kind)
        if foreign.any():
            starts = starts[~foreign[np.searchsorted(offsets, starts, "right") - 1]]
        of = np.searchsorted(offsets, starts, "right") - 1
        ends = np.append(starts[1:], len(data))
        ends = np.minimum(ends, offsets[of + 1])
        ids, counts = self._words(data, starts, ends)
        per_text = np.zeros(len(offsets) - 1, np.int64)
        np.add.at(per_text, of, counts)
        if not foreign.any():
            return ids, per_text
        parts = np.split(ids, np.cumsum(per_text)[:-1])
        for i in np.flatnonzero(foreign):
            parts[i] = self._by_library(texts[i].as_py())
            per_text[i] = len(parts[i])
        return np.concatenate(parts), per_text

    def _words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and how many each has; every different word is merged once."""
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        _, sample, which = np.unique(SpanHashes(data)(starts, ends), return_index=True, return_inverse=True)
        if self._by_rank is None:
            from tiktoken import Encoding

            self._by_rank = Encoding("words", pat_str="", mergeable_ranks=self._ranks, special_tokens={})
        one, known = self._by_rank._core_bpe.encode_single_piece, self._known
        if len(known) > MOST_WORDS:
            known.clear()
        raw = data.tobytes()
        found = []
        for a, b in zip(starts[sample].tolist(), ends[sample].tolist(), strict=True):
            word = raw[a:b]
            ids = known.get(word)
            if ids is None:
                ids = known[word] = one(word)
            found.append(ids)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        at = np.cumsum(counts) - counts
        merged = np.fromiter(chain.from_iterable(found), np.int32, int(counts.sum()))
        return merged[ranges(at[which], counts[which])], counts[which]
