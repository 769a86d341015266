"""Words of Arrow texts: runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z is lower-cased.

All these characters but the ASCII ones are bytes from 0x80 on in UTF-8, so words are
found on bytes.  A word's number is its place among the different words, by their bytes.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

from quayside.llm.arrays import LOWER, U64, flat, mix, runs

IN_WORD = np.zeros(256, bool)
IN_WORD[48:58] = IN_WORD[65:91] = IN_WORD[97:123] = IN_WORD[128:] = True

_SIZE = U64(0xD6E8FEB86659FD93)
_LANES = np.array([0x9E3779B97F4A7C15, 0x632BE59BD9B4E019], U64)


class Words(NamedTuple):
    """``ids`` index ``forms``; ``of`` is the text, ``start`` and ``end`` the bytes of all texts laid end to end."""

    ids: np.ndarray
    of: np.ndarray
    start: np.ndarray
    end: np.ndarray
    forms: pa.Array

    def first_of(self, texts: int) -> np.ndarray:
        """Where each text's words begin, and the end."""
        return np.searchsorted(self.of, np.arange(texts + 1))


def coded(spelled: np.ndarray, sizes: np.ndarray) -> pa.DictionaryArray:
    """Strings of given sizes, laid end to end, as numbers of the different ones."""
    bounds = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=bounds[1:])
    whole = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(bounds), pa.py_buffer(spelled)])
    return whole.dictionary_encode()


def hashes(spelled: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """128-bit hashes of such strings, two numbers each.

    Eight bytes at a time go into a chain of stirred numbers, so that neither bytes nor their order
    cancel out; strings of one size up to eight bytes never share a number.
    """
    padded = np.zeros(len(spelled) + 8, np.uint8)
    padded[: len(spelled)] = spelled
    eights = np.ndarray((len(spelled) + 1,), U64, padded, strides=(1,))
    begin = np.cumsum(sizes) - sizes
    out = mix(sizes.astype(U64)[:, None] * _SIZE + _LANES)
    todo, at = np.flatnonzero(sizes > 0), 0
    while len(todo):
        left = np.minimum(sizes[todo] - at, 8)
        chunk = eights[begin[todo] + at] & (U64(0xFFFFFFFFFFFFFFFF) >> (8 * (8 - left)).astype(U64))
        out[todo] = mix(out[todo] ^ mix(chunk[:, None] + _LANES))
        at += 8
        todo = todo[sizes[todo] > at]
    return out


def words_of(texts: pa.Array) -> Words:
    """Null texts have no words."""
    data, offsets = flat(texts)
    inside = IN_WORD[data]
    start, end, of = runs(inside, offsets)
    found = coded(LOWER[data[inside]], end - start)
    return Words(found.indices.to_numpy().astype(np.int64), of, start, end, found.dictionary)
