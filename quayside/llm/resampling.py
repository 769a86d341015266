"""Importance resampling towards a target: documents drawn by how much they look like it.

Features are runs of one to three words, hashed into buckets.  A bucket's gain is the
log of how much more frequent it is in the target than in the corpus; a document's weight
is the sum of the gains of its features, read from one array of gains.  Gumbel noise
from the hash of its id is added, and the documents with the highest sums are drawn.

The least key drawn is found by a distributed quickselect: random keys of the range left
are its pivots, exact counts below, at and above each tell which part holds the
wanted key, and the range narrows to it.  Only the winners are sorted.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from quayside.functions.ranks import ranked
from quayside.llm.arrays import pieces
from quayside.llm.store import written
from quayside.llm.words import words_of

BUCKETS, LONGEST_RUN, LEAST_WORDS, SEED = 10_000, 3, 20, 42

#: Share drawn of the documents that are long enough.
DRAWN, OF = 5, 100

#: Pivots a round; each round reads one row of counts for each side of them.
PIVOTS = 8

_PIECE = 1 << 22


def _applied(columns: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A linear map on 32 bits, by the images of the single bits."""
    out = np.zeros_like(values)
    for i in range(32):
        out ^= np.where(values >> np.uint32(i) & np.uint32(1), columns[i], np.uint32(0))
    return out


_tables: dict[int, np.ndarray] = {}


def _zeros(n: int) -> np.ndarray:
    """Tables, one for each byte of a CRC-32, of what ``n`` zero bytes after it make of it."""
    if n not in _tables:
        if len(_tables) >= 4096:
            _tables.clear()
        _tables[n] = _made(n)
    return _tables[n]


def _made(n: int) -> np.ndarray:
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    power = bits.copy()
    for _ in range(8):
        power = power >> np.uint32(1) ^ np.where(power & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    whole = bits
    while n:
        if n & 1:
            whole = _applied(power, whole)
        power = _applied(power, power)
        n >>= 1
    every = np.arange(256, dtype=np.uint32)
    return np.stack([_applied(whole, every << np.uint32(8 * k)) for k in range(4)])


def _followed(crc: np.ndarray, by: np.ndarray, by_crc: np.ndarray) -> np.ndarray:
    """CRC-32 of strings followed by others of ``by`` bytes and CRC-32 ``by_crc``."""
    sizes, which = np.unique(by, return_inverse=True)
    tables = np.stack([_zeros(int(n)) for n in sizes]) if len(sizes) else np.zeros((0, 4, 256), np.uint32)
    out = by_crc.copy()
    for k in range(4):
        out ^= tables[which, k, crc >> np.uint32(8 * k) & np.uint32(255)]
    return out


def buckets(texts: pa.Array, n_buckets: int, longest: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For runs of 1, 2, ... words the bucket of the run from every word, -1 where it has none; and words by text."""
    found = words_of(texts)
    forms = [f.as_py() for f in found.forms]
    plain = np.array([zlib.crc32(f) for f in forms], np.uint32)
    spaced = np.array([zlib.crc32(b" " + f) for f in forms], np.uint32)
    size = np.array([len(f) + 1 for f in forms], np.int64)
    ids, of, n = found.ids, found.of, len(found.ids)
    crc = plain[ids] if n else np.zeros(0, np.uint32)
    out = [crc.astype(np.int64) % n_buckets]
    for k in range(1, longest):
        here = max(0, n - k)
        crc = _followed(crc[:here], size[ids[k:]], spaced[ids[k:]]) if here else crc[:0]
        run = np.full(n, -1, np.int64)
        run[:here] = np.where(of[:here] == of[k:], crc.astype(np.int64) % n_buckets, -1)
        out.append(run)
    return out, np.bincount(of, minlength=len(texts)) if n else np.zeros(len(texts), np.int64)


def _counted(n_buckets: int, longest: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each bucket and task."""
    total = np.zeros(n_buckets, np.int64)
    for batch in batches:
        for piece in pieces(batch, "text", _PIECE):
            for run in buckets(piece.column("text"), n_buckets, longest)[0]:
                total += np.bincount(run[run >= 0], minlength=n_buckets)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])


def feature_counts(texts: DataFrame, n_buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> DataFrame:
    """``bucket, n``: the features of all texts, repeats counted."""
    per_task = texts.select(F.col("text").cast("string")).mapInArrow(
        partial(_counted, n_buckets, longest), "bucket bigint, n bigint"
    )
    return per_task.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, n_buckets: int = BUCKETS) -> np.ndarray:
    """For each bucket floor(1000 ln) of its share in the target over that in the corpus, one added to each count."""
    counts = []
    for found in (corpus, target):
        dense = [0] * n_buckets
        for r in found.collect():  # n_buckets rows at most
            dense[r["bucket"]] = r["n"]
        counts.append(dense)
    s, t = counts
    all_s, all_t = float(sum(s) + n_buckets), float(sum(t) + n_buckets)
    return np.array([math.floor(1000 * math.log((b + 1) * all_s / ((a + 1) * all_t))) for a, b in zip(s, t)], np.int64)


def _weighed(gain: np.ndarray, longest: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    padded = np.append(gain, 0)  # a run that is none has bucket -1
    for batch in batches:
        for piece in pieces(batch, "text", _PIECE):
            found, n_words = buckets(piece.column("text"), len(gain), longest)
            sums = np.concatenate([[0], np.cumsum(sum(padded[run] for run in found))])
            ends = np.cumsum(n_words)
            n_features = sum(np.maximum(n_words - k, 0) for k in range(longest))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("row"),
                    pa.array(n_words.astype(np.int64)),
                    pa.array(n_features.astype(np.int64)),
                    pa.array((sums[ends] - sums[ends - n_words]).astype(np.int64)),
                ],
                ["row", "n_words", "n_features", "weight"],
            )


def weigh(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST_RUN, seed: int = SEED) -> DataFrame:
    """``row, n_words, n_features, weight, score`` of every row of ``docs(doc_id, text, ...)``.

    ``row`` is a struct of the row's columns but ``text``.
    """
    rest = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row")
    whole = docs.select(rest, F.col("text").cast("string").alias("text"))
    carried = whole.schema["row"].dataType.simpleString()
    weighed = whole.mapInArrow(
        partial(_weighed, gain, longest), f"row {carried}, n_words bigint, n_features bigint, weight bigint"
    )
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("row.doc_id").cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log(uniform)))
    return weighed.withColumn("score", F.col("weight") + noise)


def _literal(key: Row) -> Column:
    return F.struct(*(F.lit(v).cast("bigint").alias(n) for n, v in key.asDict().items()))


def nth_key(rows: DataFrame, key: Column, n: int, pivots: int = PIVOTS) -> Row:
    """The ``n``-th smallest (from 1) of different keys, structs of long numbers; no row is sorted or moved.

    ``rows`` must give the same rows each time, and ``n`` of them at least.
    """
    keys = rows.select(key.alias("key"))
    low = high = None
    bounds: list[Row] = []
    for turn in range(10_000):
        left = keys
        # The first field by itself too: that filter reaches the files.
        if low is not None:
            left = left.where((F.col(f"key.{keys.schema['key'].dataType.names[0]}") >= low[0]) & (F.col("key") > _literal(low)))
        if high is not None:
            left = left.where((F.col(f"key.{keys.schema['key'].dataType.names[0]}") <= high[0]) & (F.col("key") < _literal(high)))
        # Even parts lie between pivots, odd ones are a pivot itself.
        part = sum(((F.col("key") >= _literal(b)).cast("int") + (F.col("key") > _literal(b)).cast("int") for b in bounds), F.lit(0))
        chance = [F.xxhash64("key", F.lit(turn), F.lit(i)) for i in range(pivots)]
        found = (
            left.groupBy(part.alias("part"))
            .agg(F.count(F.lit(1)).alias("n"), F.array(*(F.min_by("key", c) for c in chance)).alias("pivots"))
            .collect()
        )
        for r in sorted(found, key=lambda r: r["part"]):
            if n <= r["n"]:
                break
            n -= r["n"]
        else:
            raise ValueError(f"fewer keys than asked for, by {n}")
        at, odd = divmod(r["part"], 2)
        if odd:
            return bounds[at]
        low = bounds[at - 1] if at else low
        high = bounds[at] if at < len(bounds) else high
        bounds = sorted(set(r["pivots"]))
    raise AssertionError("the range does not narrow: rows change between reads")


def resample(
    docs: DataFrame,
    target: DataFrame,
    drawn: int = DRAWN,
    of: int = OF,
    least_words: int = LEAST_WORDS,
    n_buckets: int = BUCKETS,
    longest: int = LONGEST_RUN,
    seed: int = SEED,
) -> DataFrame:
    """``row, n_words, n_features, weight, score, rank`` for every row of ``docs(doc_id, text, ...)``.

    ``row`` is a struct of the row's columns but ``text``.  Of the N rows with
    ``least_words`` words the floor(N * drawn / of) with the highest scores are
    drawn; their ``rank`` counts from 1, ties to the smaller ``doc_id``, and is null for
    all others.  Null and empty texts have no feature and weight 0.  A
    row without ``doc_id`` hashes an empty id and comes last among ties.  Repeated rows are rows
    of their own; of equal ones at the end of the draw as many are drawn as fit.
    An empty target or corpus gives gains of no feature seen; an empty table no rows.
    """
    gain = gains(feature_counts(docs, n_buckets, longest), feature_counts(target, n_buckets, longest), n_buckets)
    # Written with a number for each row, so that every later read sees the same keys.
    scored = written(
        weigh(docs, gain, longest, seed)
        .withColumn("uid", F.monotonically_increasing_id())
        .withColumn("down", -F.col("score")),
        "weights",
    )
    enough = F.col("n_words") >= least_words
    doc_id = F.col("row.doc_id").cast("bigint")
    order = {
        "down": F.col("down"),
        "unnamed": doc_id.isNull().cast("bigint"),
        "doc_id": F.coalesce(doc_id, F.lit(0).cast("bigint")),
        "n_features": F.col("n_features"),
        "uid": F.col("uid"),
    }
    key = F.struct(*(c.alias(n) for n, c in order.items()))
    wanted = scored.where(enough).count() * drawn // of
    listed = ["row", "n_words", "n_features", "weight", "score"]
    if not wanted:
        return scored.select(*listed, F.lit(None).cast("bigint").alias("rank"))
    last = nth_key(scored.where(enough), key, wanted)
    wins = enough & (F.col("down") <= last["down"]) & (key <= _literal(last))
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    winners = ranked(scored.where(wins), list(order.values()), ranges)
    others = scored.where(~wins).withColumn("rank", F.lit(None).cast("bigint"))
    return winners.select(*listed, "rank").unionByName(others.select(*listed, "rank"))
