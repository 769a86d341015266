"""Substring de-duplication by sliding spans of sentences.

A sentence ends after ``.``, ``!`` or ``?`` before a blank, or at the end of a
line.  One of more than ``LONG`` words is cut after ``,``, ``;`` and ``:``, and a clause that is
still longer after words whose hash says so, so that the cuts follow the words and
not their place; all pieces are sentences from here on.  From every sentence a span runs over
``sentences`` sentences, and on until it has ``words`` words.  A passage of over 50
words therefore holds whole spans wherever its ends fall, and a few stop words or one
common line are no repeat.

All spans are hashed to 128 bits and brought into one order over the whole table, where equal ones
are neighbours; a span's first occurrence, by document and place, stays, and sentences under
any other are removed.  The order is cut into ranges, so a span that is in a
third of all documents is spread over many tasks; no occurrence meets another in a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from quayside.llm.arrays import BLANK, LOWER, U64, flat, mix, pieces, runs
from quayside.llm.store import document_key, written
from quayside.llm.words import hashes

SENTENCES, WORDS = 2, 24

#: Sentences with more words are cut; a word in ``ONE_IN`` ends a clause that has no mark.
LONG, ONE_IN = 8, 4

_STOP, _CLAUSE = np.zeros(256, bool), np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?"]] = True
_CLAUSE[[ord(c) for c in ",;:"]] = True

_STEP = U64(0x9E3779B97F4A7C15)


def _cut(breaks: np.ndarray, ends_clause: np.ndarray) -> np.ndarray:
    """``breaks`` and, in pieces of more than ``LONG`` words, the words after one that ends a clause."""
    first = np.flatnonzero(breaks)
    size = np.diff(np.append(first, len(breaks)))
    long = np.repeat(size > LONG, size)
    more = breaks.copy()
    more[1:] |= long[1:] & ends_clause[:-1]
    return more


def split(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start byte, text, word count and hash, two numbers, of every sentence.

    A sentence begins with its first word and its bytes reach to the next
    sentence, so blanks between them belong to the one before.
    """
    inside = ~BLANK[data]
    starts, ends, of = runs(inside, offsets)
    if not len(starts):
        return starts, of, np.zeros(0, np.int64), np.zeros((0, 2), U64)
    words = hashes(LOWER[data[inside]], ends - starts)
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    breaks = np.ones(len(starts), bool)
    last = data[ends - 1]
    breaks[1:] = _STOP[last[:-1]] | (lines[starts[1:]] > lines[ends[:-1]]) | (of[1:] != of[:-1])
    breaks = _cut(breaks, _CLAUSE[last])
    breaks = _cut(breaks, words[:, 0] % U64(ONE_IN) == 0)
    first = np.flatnonzero(breaks)
    count = np.diff(np.append(first, len(starts)))
    # Words are stirred with their place, so that no order of them is like another.
    place = (np.arange(len(starts)) - np.repeat(first, count)).astype(U64) * _STEP
    spread = mix(words + place[:, None])
    found = mix(np.add.reduceat(spread, first, axis=0) + count.astype(U64)[:, None])
    return starts[first], of[first], count, found


def spans(of: np.ndarray, count: np.ndarray, found: np.ndarray, sentences: int, words: int):
    """First and last sentence and hash, two numbers, of the span from every sentence that has one."""
    n = len(of)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 2), U64)
    total = np.concatenate([[0], np.cumsum(count)])
    first = np.arange(n)
    last = np.maximum(first + sentences - 1, np.searchsorted(total, total[:-1] + words) - 1)
    limit = np.searchsorted(of, of, "right") - 1
    first = first[last <= limit]
    last = last[last <= limit]
    sums = np.zeros((len(first), 2), U64)
    for k in range(int((last - first).max(initial=-1)) + 1):
        long = np.flatnonzero(first + k <= last)
        sums[long] += mix(found[first[long] + k] + U64((k + 1) * int(_STEP) % (1 << 64)))
    return first, last, mix(sums + (last - first).astype(U64)[:, None])


_SPAN = "one bigint, two bigint, key bigint, first int, n int"


def _spans(sentences: int, words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            _, of, count, found = split(*flat(piece.column("text")))
            first, last, span = spans(of, count, found, sentences, words)
            span = np.ascontiguousarray(span.T).view(np.int64)
            keys = piece.column("key").to_numpy()
            begin = np.searchsorted(of, np.arange(len(keys)))
            whose = of[first]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(span[0]),
                    pa.array(span[1]),
                    pa.array(keys[whose], pa.int64()),
                    pa.array(first - begin[whose], pa.int32()),
                    pa.array(last - first + 1, pa.int32()),
                ],
                ["one", "two", "key", "first", "n"],
            )


_EDGE = ("one", "two", "last_one", "last_two", "last_key", "last_first")
_AGAIN = "key bigint, first int, n int, " + ", ".join(f"{c} bigint" for c in _EDGE)


def _again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted spans those that are not the first of their hash, and a row for the range's edges.

    That row has the range's first span, which may be another's copy too, and the last
    span's hash and first occurrence in the range.
    """
    opening = last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        one, two, key, first, n = (batch.column(c).to_numpy() for c in ("one", "two", "key", "first", "n"))
        new = np.ones(len(one), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        if last is None:
            opening = [int(c[0]) for c in (key, first, n, one, two)]
        else:
            new[0] = (one[0], two[0]) != last[:2]
        at = np.maximum.accumulate(np.where(new, np.arange(len(one)), -1))
        of_key = np.where(at >= 0, key[at], 0 if last is None else last[2])
        of_first = np.where(at >= 0, first[at], 0 if last is None else last[3])
        hit = (key != of_key) | (first != of_first)
        last = (one[-1], two[-1], of_key[-1], of_first[-1])
        nothing = [pa.nulls(int(hit.sum()), pa.int64())] * len(_EDGE)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[hit]), pa.array(first[hit]), pa.array(n[hit]), *nothing], ["key", "first", "n", *_EDGE]
        )
    if last is not None:
        values = [*opening, *(int(x) for x in last)]
        kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * len(_EDGE)]
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], ["key", "first", "n", *_EDGE])


def _opening_hits(edges: list[Row]) -> list[tuple[int, int, int]]:
    """First spans of ranges that have an earlier occurrence in the ranges before."""
    hits, before = [], None
    for e in sorted(edges, key=lambda e: (e["one"], e["two"], e["key"], e["first"])):
        origin = (e["last_one"], e["last_two"], e["last_key"], e["last_first"])
        if before is not None and before[:2] == (e["one"], e["two"]):
            if before[2:] != (e["key"], e["first"]):
                hits.append((e["key"], e["first"], e["n"]))
            if origin[:2] == before[:2]:
                origin = before
        before = origin
    return hits


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts the sentences under ``[first, first + n)`` of ``hits`` out of each text."""
    for batch in batches:
        for piece in pieces(batch, "text"):
            column = piece.column("text")
            data, offsets = flat(column)
            start, of, _, _ = split(data, offsets)
            begin = np.searchsorted(of, np.arange(len(column) + 1))
            hits = piece.column("hits")
            texts, total, gone = [], np.diff(begin), np.zeros(len(column), np.int64)
            raw = data.tobytes()
            for i, found in enumerate(hits.to_pylist()):
                a, b = begin[i], begin[i + 1]
                whole = raw[offsets[i] : offsets[i + 1]]
                if not found:
                    texts.append(whole.decode() if column[i].is_valid else None)
                    continue
                covered = np.zeros(b - a, bool)
                for hit in found:
                    covered[hit["first"] : hit["first"] + hit["n"]] = True
                bounds = np.append(start[a:b], offsets[i + 1]) - offsets[i]
                kept = [whole[: bounds[0]], *(whole[bounds[k] : bounds[k + 1]] for k in np.flatnonzero(~covered))]
                texts.append(b"".join(kept).decode())
                gone[i] = covered.sum()
            drop = [piece.schema.get_field_index(c) for c in ("text", "hits")]
            names = [c for k, c in enumerate(piece.schema.names) if k not in drop]
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(c) for c in names), pa.array(texts, pa.string()), pa.array(total, pa.int64()), pa.array(gone)],
                [*names, "text", "n_sentences", "n_removed"],
            )


def repeated(texts: DataFrame, sentences: int = SENTENCES, words: int = WORDS) -> DataFrame:
    """``key, first, n``: spans of ``texts(key, text)`` that are not the first of their kind."""
    spark = texts.sparkSession
    found = texts.mapInArrow(partial(_spans, sentences, words), _SPAN)
    order = ["one", "two", "key", "first"]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = found.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    again = written(placed.mapInArrow(_again, _AGAIN), "again")
    edges = again.where("one IS NOT NULL").collect()  # one for each range
    opening = spark.createDataFrame(_opening_hits(edges), "key bigint, first int, n int")
    return again.where("one IS NULL").select("key", "first", "n").unionByName(opening)


def remove_repeats(docs: DataFrame, sentences: int = SENTENCES, words: int = WORDS) -> DataFrame:
    """``row, text, n_sentences, n_removed`` for every row of ``docs(doc_id, text, ...)``.

    ``row`` is a struct of the row's columns but ``text``; ``text`` is what is left, in order, byte for byte.  Null texts stay null, and
    texts with fewer sentences or words than a span has stay whole.  Rows with one
    ``doc_id`` are one document and lose nothing to each other; a row without
    gets a key from its text.  An empty table gives no rows.
    """
    rest = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row")
    whole = docs.select(document_key().alias("key"), F.col("text").cast("string"), rest)
    hits = (
        repeated(whole.select("key", "text"), sentences, words)
        .groupBy("key")
        .agg(F.collect_set(F.struct("first", "n")).alias("hits"))
    )
    carried = whole.schema["row"].dataType.simpleString()
    return (
        whole.join(hits, "key", "left")
        .select("row", "text", "hits")
        .mapInArrow(_removed, f"row {carried}, text string, n_sentences bigint, n_removed bigint")
    )
