"""Benchmark decontamination by an FM-index of every shard of documents.

A shard is what a task has of a partition, up to ``SHARD_BYTES`` of whole texts.  Its words
are numbered and indexed; all windows of the benchmark items, runs of ``WINDOW``
words or a shorter item whole, are searched backward in it at once, word by word
from their ends.  Their occurrences are located by sampled suffix positions and merged
to spans of words to remove.

Only the benchmark moves: its windows go to the executors in blocks of bounded size,
one pass over the documents for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.arrays import lists, pieces, ranges
from quayside.llm.fm_index import FMIndex
from quayside.llm.store import written
from quayside.llm.words import words_of

WINDOW = 10

SHARD_BYTES = 1 << 22

#: Text of the items whose windows go to the executors at a time.
BLOCK_BYTES = 1 << 22


class Windows(NamedTuple):
    """Different windows of a block of items.

    ``words`` holds the windows of each length as rows of numbers of ``forms``, in the
    order of ``lengths``; window w is in the items ``item_of[first[w]:first[w + 1]]``.
    """

    forms: pa.Array
    lengths: list[int]
    words: list[np.ndarray]
    first: np.ndarray
    item_of: np.ndarray
    names: np.ndarray


def windows_of(items: pa.Table, window: int) -> Windows:
    """``item_id`` is text; an item without one has windows, but names none."""
    found = words_of(items.column("text").combine_chunks())
    begin = found.first_of(len(items))
    count = np.diff(begin)
    ids = items.column("item_id").to_pylist()
    names = sorted({i for i in ids if i is not None})
    place = {name: k for k, name in enumerate(names)}
    named = np.array([place.get(i, -1) for i in ids], np.int64)
    lengths, words, firsts, item_of = [], [], [np.zeros(1, np.int64)], []
    base = 0
    for length in range(1, window + 1):
        whose = np.flatnonzero(count >= window if length == window else count == length)
        if not len(whose):
            continue
        n = count[whose] - length + 1
        starts = ranges(begin[whose], n)
        rows = found.ids[starts[:, None] + np.arange(length)].astype(np.int32)
        different, which = np.unique(rows, axis=0, return_inverse=True)
        pairs = np.unique(np.stack([which.ravel(), np.repeat(named[whose], n)], axis=1), axis=0)
        pairs = pairs[pairs[:, 1] >= 0]
        lengths.append(length)
        words.append(different)
        firsts.append(base + np.cumsum(np.bincount(pairs[:, 0], minlength=len(different))))
        item_of.append(pairs[:, 1])
        base += len(pairs)
    held = np.concatenate(item_of) if item_of else np.zeros(0, np.int64)
    return Windows(found.forms, lengths, words, np.concatenate(firsts), held, np.array(names, object))


class _Hits(NamedTuple):
    """Of every text: hit words as a mask over all words, and pairs of text and window."""

    hit: np.ndarray
    text: np.ndarray
    window: np.ndarray


def _hits(found, texts: int, windows: Windows) -> _Hits:
    index = FMIndex(found.ids, found.of, texts, len(found.forms))
    here = pc.fill_null(pc.index_in(windows.forms, value_set=found.forms), -1).to_numpy().astype(np.int64)
    edges = np.zeros(len(found.ids) + 1, np.int64)
    pairs = [np.zeros((0, 2), np.int64)]
    base = 0
    for length, words in zip(windows.lengths, windows.words):
        symbols = here[words] if len(here) else np.zeros(words.shape, np.int64) - 1
        present = np.flatnonzero((symbols >= 0).all(axis=1))
        low, high = index.search(symbols[present])
        for word, pattern in index.locate(low, high):
            edges += np.bincount(word, minlength=len(edges))
            edges -= np.bincount(word + length, minlength=len(edges))
            pairs.append(np.unique(np.stack([found.of[word], base + present[pattern]], axis=1), axis=0))
        base += len(words)
    met = np.concatenate(pairs)
    return _Hits(np.cumsum(edges[:-1]) > 0, met[:, 0], met[:, 1])


_SPAN = pa.struct([("first", pa.int64()), ("n", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def _shard(piece: pa.RecordBatch, windows: Windows) -> pa.RecordBatch:
    coded = piece.column("text").dictionary_encode()  # copies of a text are searched once
    of_row = pc.fill_null(coded.indices, -1).to_numpy().astype(np.int64)
    texts = len(coded.dictionary)
    found = words_of(coded.dictionary)
    hits = _hits(found, texts, windows)
    hit, met = hits.hit, [set() for _ in range(texts)]
    begin = found.first_of(texts)
    # What blocks before found in these texts.
    for row in np.flatnonzero(pc.is_valid(piece.column("spans")).to_numpy(zero_copy_only=False)):
        k = of_row[row]
        if k >= 0:
            for span in piece.column("spans")[row].as_py():
                hit[begin[k] + span["first"] : begin[k] + span["first"] + span["n"]] = True
            met[k].update(piece.column("items")[row].as_py())
    sizes = windows.first[hits.window + 1] - windows.first[hits.window]
    named = np.unique(
        np.stack([np.repeat(hits.text, sizes), windows.item_of[ranges(windows.first[hits.window], sizes)]], axis=1), axis=0
    )
    for k, item in zip(named[:, 0].tolist(), windows.names[named[:, 1]].tolist()):
        met[k].add(item)

    edge = np.append(begin, len(hit))
    starts = hit.copy()
    starts[1:] &= ~hit[:-1] | (found.of[1:] != found.of[:-1])
    ends = hit.copy()
    ends[:-1] &= ~hit[1:] | (found.of[1:] != found.of[:-1])
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends)
    of = found.of[starts]
    text_start = np.concatenate([[0], np.cumsum(pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False))])
    span_from = np.searchsorted(of, np.arange(texts + 1))

    # Rows take what their text has; null texts have nothing.
    known = of_row >= 0
    n_words = np.where(known, np.append(np.diff(edge[: texts + 1]), 0)[of_row], 0)
    n_spans = np.where(known, np.append(np.diff(span_from), 0)[of_row], 0)
    at = ranges(np.append(span_from[:-1], 0)[of_row], n_spans)
    spans = pa.StructArray.from_arrays(
        [
            pa.array(starts[at] - begin[of[at]]),
            pa.array((ends - starts + 1)[at]),
            pa.array(found.start[starts[at]] - text_start[of[at]]),
            pa.array(found.end[ends[at]] - text_start[of[at]]),
        ],
        fields=list(_SPAN),
    )
    offsets = np.concatenate([[0], np.cumsum(n_spans)]).astype(np.int32)
    items = [sorted(met[k]) if k >= 0 else [] for k in of_row.tolist()]
    return pa.RecordBatch.from_arrays(
        [
            piece.column("row"),
            piece.column("text"),
            pa.array(n_words.astype(np.int64)),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans),
            pa.array(items, pa.list_(pa.string())),
        ],
        ["row", "text", "n_words", "spans", "items"],
    )


def _searched(sent: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    windows = Windows(*sent.value)
    for batch in batches:
        for piece in pieces(batch, "text", SHARD_BYTES):
            yield _shard(piece, windows)


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``row, text, n_words, spans, items`` for every row of ``docs(text, ...)``.

    ``row`` is a struct of the row's columns but ``text``.  ``spans`` are disjoint runs of hit
    words, in order: ``first`` and ``n`` in words, ``start`` and ``end`` in UTF-8 bytes.  ``items``
    are the different ``item_id`` of ``benchmark(item_id, text)``, as text and sorted, a window of which is in the
    document; an item without ``item_id`` hits words but is not listed, and rows with one
    ``item_id`` are one item.  Null or empty texts and items have no words: they hit nothing.  An
    empty benchmark hits nothing, an empty table gives no rows.
    """
    spark = docs.sparkSession
    rest = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row")
    span = "array<struct<first:bigint,n:bigint,start:bigint,end:bigint>>"
    rows = docs.select(
        rest,
        F.col("text").cast("string").alias("text"),
        F.lit(None).cast(span).alias("spans"),
        F.lit(None).cast("array<string>").alias("items"),
    )
    carried = rows.schema["row"].dataType.simpleString()
    kinds = f"row {carried}, text string, n_words bigint, spans {span}, items array<string>"
    items = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).where("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(size) // block_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for k in range(blocks):
        if k:
            rows = written(found.drop("n_words"), "searched")
        windows = windows_of(items.where(block == k).dropDuplicates().toArrow(), window)
        found = rows.mapInArrow(partial(_searched, spark.sparkContext.broadcast(tuple(windows))), kinds)
    return found


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``row, n_words, n_hit, n_items, items_sha256, contaminated``: what ``find`` finds, counted.

    The digest is of the items, joined by commas; of nothing where there are none.
    """
    found = find(docs, benchmark, window, block_bytes)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, span: n + span["n"])
    return found.select(
        "row",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column("text"), batch.column("spans")):
            if not text.is_valid or not len(spans):
                texts.append(text.as_py())
                continue
            raw, at, kept = text.as_buffer().to_pybytes(), 0, []
            for span in spans.as_py():
                kept.append(raw[at : span["start"]])
                at = span["end"]
            kept.append(raw[at:])
            texts.append(b"".join(kept).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(texts, pa.string()), batch.column("n_words"), batch.column("items")],
            ["row", "text", "n_words", "items"],
        )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``row, text, n_words, items``: what ``find`` found, cut out of each text; null texts stay null."""
    found = find(docs, benchmark, window).select("row", "text", "n_words", "spans", "items")
    carried = found.schema["row"].dataType.simpleString()
    return found.mapInArrow(_cut, f"row {carried}, text string, n_words bigint, items array<string>")
