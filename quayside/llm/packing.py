"""Packing of token ids into windows by best fit decreasing.

A text longer than a window is first cut into full windows; each is a sequence of
its own.  What is left of every text is placed, longest first, into the open
window with the least room that holds it, or into a new one.  A segment tree
over the room left (0 to ``WINDOW``) counts the open windows and finds the
tightest in ten steps.

Every task packs its own rows, ``POOL`` left-overs at a time: no shuffle, and
memory does not grow with the input.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.arrays import pieces
from quayside.llm.byte_bpe import ByteBpe

WINDOW = 1024
END = 0
POOL = 1 << 16


class RoomTree:
    """Open windows by the room they have left."""

    def __init__(self, most: int):
        self._leaves = 1 << most.bit_length()
        self._open = [0] * (2 * self._leaves)
        self._windows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, room: int, window: int) -> None:
        self._windows[room].append(window)
        self._count(room, 1)

    def _count(self, room: int, by: int) -> None:
        node = room + self._leaves
        while node:
            self._open[node] += by
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Removes a window with the least room of ``least`` or more: its room and number."""
        node = least + self._leaves
        while not self._open[node]:
            # The next node to the right: up while this is a right child.
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self._leaves:
            node = 2 * node if self._open[2 * node] else 2 * node + 1
        room = node - self._leaves
        self._count(room, -1)
        return room, self._windows[room].pop()


def best_fit(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, int]:
    """Window and offset of each piece of ``1 <= length <= window``, and how many windows there are."""
    tree, n = RoomTree(window), 0
    placed, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        found = tree.take(length)
        if found is None:
            found = window, n
            n += 1
        room, number = found
        placed[i], offset[i] = number, window - room
        if room > length:
            tree.add(room - length, number)
    return placed, offset, n


_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _packed(tokenizer: ByteBpe, window: int, pool: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 40
    waiting: list[tuple] = []

    def rows(found: list[tuple], sequences, offsets) -> pa.RecordBatch:
        columns = [*zip(*found, strict=True)]
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in columns), pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64())],
            _NAMES,
        )

    def packed_pool() -> pa.RecordBatch:
        nonlocal number, waiting
        placed, offsets, n = best_fit(np.array([w[2] for w in waiting]), window)
        out = rows(waiting, placed + number, offsets)
        number, waiting = number + n, []
        return out

    for batch in batches:
        for piece in pieces(batch, "text"):
            ids, counts = tokenizer.encode(piece.column("text"))
            ends = np.cumsum(counts)
            full: list[tuple] = []
            for i, doc_id in enumerate(piece.column("doc_id").to_pylist()):
                own = np.append(ids[ends[i] - counts[i] : ends[i]], END).astype("<u4")
                raw, size = own.tobytes(), len(own)
                for at in range(0, size, window):
                    part = (doc_id, at, min(window, size - at), zlib.crc32(raw[4 * at : 4 * (at + window)]), size)
                    (full if part[2] == window else waiting).append(part)
                if len(waiting) >= pool:
                    yield packed_pool()
            if full:
                yield rows(full, np.arange(len(full)) + number, np.zeros(len(full), np.int64))
                number += len(full)
    if waiting:
        yield packed_pool()


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, pool: int = POOL) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of every piece of ``docs(doc_id, text)``.

    Null and empty texts are the end id alone.  Repeated rows are packed each; a
    null ``doc_id`` stays null.  An empty table gives no rows; other columns are
    not read.
    """
    schema = ", ".join(f"{name} bigint" for name in _NAMES)
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return texts.mapInArrow(partial(_packed, ByteBpe(tokenizer_path), window, pool), schema)
