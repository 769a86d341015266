"""Repeated byte strings, by interval expansion on a Burrows-Wheeler transform.

A byte goes if a string of ``LEAST`` bytes over it also starts anywhere else.

Strings that are equal must meet, wherever they are.  Of the hashes of the
``GRAM``-byte grams in a string the smallest is its anchor; neighbouring strings
of a text with one anchor are a segment.  Equal strings have equal anchors, so
segments are counted by anchor over the whole table, and one whose anchor
is nowhere else is done with.  Equal segments are one class, whose strings are all
repeated; of each class one text is looked at.

Classes of the same anchor go to the same block.  A block's suffixes are sorted
as far as ``LEAST`` bytes, and their transform is searched breadth first: strings
are extended to the left, one byte a round, so the common prefixes of
neighbouring suffixes are found by increasing length, and the search stops at
``LEAST``.  Where no shorter end was found, the strings are equal.

An anchor with more than ``CLASSES`` classes would fill a block by itself, so its
strings are counted by 128-bit hashes instead, wherever they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.arrays import U64, SpanHashes, flat, mix, pieces, ranges
from quayside.llm.store import written

LEAST, GRAM, CLASSES = 400, 200, 256
BLOCK_BYTES = 1 << 19

_SHUFFLED = np.random.default_rng(7).permutation(256).astype(np.uint8)


def _sliding(values: np.ndarray, width: int, take: np.ufunc, filler) -> np.ndarray:
    """``take`` over ``values[i : i + width]`` for every i that has so many."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, filler, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    before = take.accumulate(blocks, axis=1).ravel()
    after = take.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return take(after[:n], before[width - 1 : width - 1 + n])


def segments(data: np.ndarray, offsets: np.ndarray, least: int, gram: int):
    """Anchor, hash, text, start, number of strings, and whether the anchor is there twice, of every segment."""
    n = len(data)
    nothing = np.zeros(0, np.int64)
    if n < least:
        return nothing.view(U64), nothing.view(U64), nothing, nothing, nothing, nothing.astype(bool)
    hashes = SpanHashes(data)
    at = np.arange(n - gram + 1)
    grams = hashes(at, at + gram) | U64(1)
    width = least - gram + 1
    anchor = _sliding(grams, width, np.minimum, np.iinfo(np.uint64).max)
    valid = np.zeros(len(anchor), bool)
    sizes = np.diff(offsets)
    fits = sizes >= least
    valid[ranges(offsets[:-1][fits], sizes[fits] - least + 1)] = True
    anchor[~valid] = 0
    first = valid.copy()
    first[1:] &= anchor[1:] != anchor[:-1]
    last = valid.copy()
    last[:-1] &= anchor[1:] != anchor[:-1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    value = anchor[start]
    of = np.searchsorted(offsets, start, "right") - 1
    # Where the anchors are: grams that are the smallest of some string.
    padded = np.concatenate([np.zeros(width - 1, U64), anchor, np.zeros(width - 1, U64)])
    placed = np.flatnonzero(_sliding(padded, width, np.maximum, 0) == grams)
    named = mix(grams[placed] + (np.searchsorted(offsets, placed, "right") - 1).astype(U64) * U64(0x9E3779B97F4A7C15))
    names, times = np.unique(named, return_counts=True)
    own = mix(value + of.astype(U64) * U64(0x9E3779B97F4A7C15))
    twice = times[np.searchsorted(names, own)] > 1 if len(own) else nothing.astype(bool)
    return value, hashes(start, end + least - 1), of, start - offsets[of], end - start, twice


def _segments(least: int, gram: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            value, hashed, of, start, n, twice = segments(*flat(piece.column("text")), least, gram)
            keys = piece.column("key").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(value.view(np.int64)),
                    pa.array(hashed.view(np.int64)),
                    pa.array(keys[of], pa.int64()),
                    pa.array(start, pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array(twice, pa.bool_()),
                ],
                ["anchor", "class", "key", "start", "n", "twice"],
            )


_CUT = "anchor bigint, times bigint, key bigint, start bigint, bytes binary"


def _cut(least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each segment listed in ``wanted``."""
    for batch in batches:
        for piece in pieces(batch, "text"):
            data, offsets = flat(piece.column("text"))
            raw = data.tobytes()
            rows = []
            keys = piece.column("key").to_pylist()
            for i, wanted in enumerate(piece.column("wanted").to_pylist()):
                for w in wanted:
                    at = int(offsets[i]) + w["start"]
                    rows.append((w["anchor"], w["times"], keys[i], w["start"], raw[at : at + w["n"] + least - 1]))
            columns = [*zip(*rows, strict=True)] if rows else [[]] * 5
            kinds = [pa.int64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["anchor", "times", "key", "start", "bytes"],
            )


def _sorted_suffixes(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first ``depth`` symbols, and each one's place, by prefix doubling."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(n, np.int64)
    sorted_symbols = symbols[order]
    new = np.append(True, sorted_symbols[1:] != sorted_symbols[:-1])
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[order] = head
    known = 1
    while known < depth:
        alone = new & np.append(new[1:], True)
        slots = np.flatnonzero(~alone)
        if not len(slots):
            break
        open_ = order[slots]
        beyond = open_ + known
        second = np.where(beyond < n, rank[np.minimum(beyond, n - 1)] + 1, 0)
        keys = rank[open_] * (n + 1) + second
        by_key = np.argsort(keys)
        order[slots] = open_[by_key]
        keys = keys[by_key]
        new[slots] = np.append(True, keys[1:] != keys[:-1])
        head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[order[slots]] = head[slots]
        known *= 2
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    return order, place


def repeated_starts(texts: list[bytes], least: int) -> np.ndarray:
    """Places, in the texts laid end to end with one byte between, where a string begins that is there twice."""
    k = len(texts)
    data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    symbols = data.astype(np.int64) + k
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    symbols[ends] = np.arange(k)  # every end differs from all others
    n = len(symbols)
    order, place = _sorted_suffixes(symbols, least)
    before = order - 1
    transform = np.where(before >= 0, symbols[before], 0)
    back = np.where(before >= 0, place[before], 0)

    # known[j]: the common prefix of suffixes j - 1 and j is shorter than what was searched.
    known = np.zeros(n + 1, bool)
    known[0] = known[n] = True
    first = symbols[order]
    new = np.append(True, first[1:] != first[:-1])
    low = np.flatnonzero(new)
    high = np.append(low[1:], n) - 1
    known[high + 1] = True
    for _ in range(1, least):
        sizes = high - low + 1
        at = ranges(low, sizes)
        owner = np.repeat(np.arange(len(low)), sizes)
        inner = transform[at] >= k
        at, owner = at[inner], owner[inner]
        if not len(at):
            break
        to = back[at]
        by_place = np.argsort(to)
        to, owner, symbol = to[by_place], owner[by_place], transform[at][by_place]
        new = np.append(True, (to[1:] != to[:-1] + 1) | (owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1]))
        low = to[new]
        high = to[np.append(new[1:], True)]
        fresh = ~known[high + 1]
        low, high = low[fresh], high[fresh]
        known[high + 1] = True
    same = np.flatnonzero(~known)
    return np.unique(np.concatenate([order[same], order[same - 1]]))


def _block(least: int, group: pa.Table) -> pa.Table:
    """Runs of repeated strings in the classes of a block that are there once."""
    texts = group.column("bytes").to_pylist()
    starts = repeated_starts(texts, least)
    begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
    of = np.searchsorted(begin, starts, "right") - 1
    once = group.column("times").to_numpy()[of] == 1
    starts, of = starts[once], of[once]
    new = np.append(True, (starts[1:] != starts[:-1] + 1) | (of[1:] != of[:-1])) if len(starts) else np.zeros(0, bool)
    head = np.flatnonzero(new)
    run = np.diff(np.append(head, len(starts)))
    return pa.table(
        {
            "key": group.column("key").to_numpy()[of[head]],
            "start": group.column("start").to_numpy()[of[head]] + starts[head] - begin[of[head]],
            "n": run.astype(np.int64),
        }
    )


_WINDOWS = "key bigint, start bigint, times bigint, one bigint, two bigint"


def _windows(least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every string of crowded anchors by its hash."""
    for batch in batches:
        for i in range(batch.num_rows):
            data = np.frombuffer(batch.column("bytes")[i].as_py(), np.uint8)
            at = np.arange(len(data) - least + 1)
            n = len(at)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, batch.column("key")[i].as_py())),
                    pa.array(at + batch.column("start")[i].as_py()),
                    pa.array(np.full(n, batch.column("times")[i].as_py())),
                    pa.array(SpanHashes(data)(at, at + least).view(np.int64)),
                    pa.array(SpanHashes(_SHUFFLED[data])(at, at + least).view(np.int64)),
                ],
                ["key", "start", "times", "one", "two"],
            )


_REST = "doc_id bigint, n_bytes bigint, spans array<struct<start: bigint, n: bigint>>, kept binary"


def _removed(least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts the strings that begin in the runs ``found`` out of each text."""
    for batch in batches:
        for piece in pieces(batch, "text"):
            data, offsets = flat(piece.column("text"))
            raw = data.tobytes()
            removed, rest = [], []
            for i, found in enumerate(piece.column("found").to_pylist()):
                whole = raw[offsets[i] : offsets[i + 1]]
                spans, kept, at = [], [], 0
                for a, b in sorted((f["start"], f["start"] + f["n"] + least - 1) for f in found or ()):
                    if spans and a <= at:
                        at = max(at, b)
                        spans[-1]["n"] = at - spans[-1]["start"]
                    else:
                        kept.append(whole[at:a])
                        spans.append({"start": a, "n": b - a})
                        at = b
                kept.append(whole[at:])
                removed.append(spans)
                rest.append(b"".join(kept))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array(np.diff(offsets)),
                    pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("n", pa.int64())]))),
                    pa.array(rest, pa.binary()),
                ],
                ["doc_id", "n_bytes", "spans", "kept"],
            )


def repeated(texts: DataFrame, least: int = LEAST, gram: int = GRAM, classes: int = CLASSES) -> DataFrame:
    """``key, start, n``: runs of ``n`` strings of ``least`` bytes in ``texts(key, text)`` that are there more than once.

    Texts of one key are equal.
    """
    found = written(
        texts.mapInArrow(
            partial(_segments, least, gram),
            "anchor bigint, class bigint, key bigint, start bigint, n bigint, twice boolean",
        ),
        "segments",
    )
    met = (
        found.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("times"), F.max("twice").alias("twice"))
        .where("times > 1 OR twice")
        .select("anchor")
    )
    found = written(found.join(met, "anchor", "left_semi"), "met")
    kinds = found.groupBy("anchor", "class").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct("key", "start", "n")).alias("of"), F.max("twice").alias("twice")
    )
    kinds = written(kinds, "classes")
    crowd = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("classes"))
    wanted = (
        kinds.join(crowd, "anchor")
        .where("classes > 1 OR (twice AND times = 1)")
        .select("anchor", "times", "classes", "of.key", "of.start", "of.n")
    )
    wanted = written(wanted, "wanted")
    size = wanted.agg(F.sum(F.col("n") + least)).first()[0] or 0
    by_text = wanted.groupBy("key").agg(F.collect_list(F.struct("anchor", "times", "start", "n")).alias("wanted"))
    # Copies of a text are each cut; one of them is kept.
    cut = texts.join(by_text, "key").mapInArrow(partial(_cut, least), _CUT).dropDuplicates(["key", "start"])
    cut = written(cut.join(crowd, "anchor"), "cut")
    blocks = max(1, -(-int(size) // BLOCK_BYTES))
    searched = (
        cut.where(F.col("classes") <= classes)
        .select("times", "key", "start", "bytes", F.pmod(F.xxhash64("anchor"), F.lit(blocks)).alias("block"))
        .groupBy("block")
        .applyInArrow(lambda g: _block(least, g), "key bigint, start bigint, n bigint")
    )
    strings = cut.where(F.col("classes") > classes).select("key", "start", "times", "bytes")
    strings = written(strings.mapInArrow(partial(_windows, least), _WINDOWS), "strings")
    again = strings.groupBy("one", "two").agg(F.sum("times").alias("n")).where("n > 1").select("one", "two")
    hashed = strings.join(again, ["one", "two"], "left_semi").select("key", "start", F.lit(1).cast("bigint").alias("n"))
    copies = kinds.where("times > 1").select("anchor", "class")
    copied = found.join(copies, ["anchor", "class"], "left_semi").select("key", "start", "n")
    return copied.unionByName(searched).unionByName(hashed)


def cut_repeats(docs: DataFrame, least: int = LEAST, gram: int = GRAM, classes: int = CLASSES) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` for every row of ``docs(doc_id, text)``.

    ``spans(start, n)`` are the maximal runs of removed bytes, in order, and ``kept``
    are the bytes that are left.  Null texts are empty; texts shorter than ``least``
    bytes keep all.  Repeated rows are copies of each other, also without ``doc_id``,
    which is returned as it is.  An empty table gives no rows; other columns are not read.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("key", F.xxhash64("text"))
    found = repeated(rows.select("key", "text"), least, gram, classes)
    per_text = found.groupBy("key").agg(F.collect_set(F.struct("start", "n")).alias("found"))
    return (
        rows.join(per_text, "key", "left").select("doc_id", "text", "found").mapInArrow(partial(_removed, least), _REST)
    )


def digests() -> list[Column]:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of the rows of ``cut_repeats``."""
    return [
        F.col("doc_id"),
        F.col("n_bytes"),
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    ]


def kept_text() -> Column:
    """``kept`` as text: the rest of a character that was cut through is U+FFFD."""
    return F.make_valid_utf8(F.col("kept").cast("string"))


def remove_repeats(docs: DataFrame, least: int = LEAST, gram: int = GRAM, classes: int = CLASSES) -> DataFrame:
    """The ``digests`` of ``cut_repeats``."""
    return cut_repeats(docs, least, gram, classes).select(*digests())
