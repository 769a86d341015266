"""Language identification by prediction by partial matching.

Per language, a context tree of bytes: how often each byte followed each context
of three, two, one and no bytes.  The length of a text's code in a language is
exact: a byte costs ``log2((N + D) / n)`` in the longest context known, and where
the context does not know it an escape of ``log2((N + D) / D)`` into the next
shorter one, whose bytes known to the longer are excluded (``N`` bytes seen, ``D``
different ones, ``n`` times this one); after no context, all bytes left are
alike.  The statistics are frozen: scoring learns nothing.

The trees are learned from a bounded sample, ``DOCUMENTS_PER_LANGUAGE`` documents
of each language in the order of a hash of their id, whatever their lengths; these
are counted whole, on the executors, and every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from quayside.llm.arrays import flat, pieces

DOCUMENTS_PER_LANGUAGE = 200
#: Slices by a hash of the id that a language's documents are ranked in first.
SLICES = 64
ORDER = 3
UNKNOWN = "und"

#: Texts that cost more bits a byte in every language are in none of them.
FOREIGN_BITS = 5.0


def held_out() -> Column:
    """Rows that no model learns from; a row without ``doc_id`` is held out too."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(True))


def _grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each byte below the three before it; a text begins after three zeros."""
    grams = data.astype(np.uint32)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    for k in range(1, ORDER + 1):
        before = np.zeros(len(data), np.uint32)
        before[k:] = data[: len(data) - k] if len(data) > k else 0
        before[place < k] = 0
        grams |= before << np.uint32(8 * k)
    return grams


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            for lang in set(piece.column("lang").to_pylist()):
                chosen = piece.filter(pa.compute.equal(piece.column("lang"), lang))
                grams, n = np.unique(_grams(*flat(chosen.column("text"))), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(n, pa.int64())],
                    ["lang", "gram", "n"],
                )


@dataclass
class Level:
    """Counts of one order: by context and byte, and by context."""

    grams: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    seen: np.ndarray
    different: np.ndarray
    #: The same of the next shorter context, without the bytes known here.
    rest_seen: np.ndarray | None = None
    rest_different: np.ndarray | None = None


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted key is, and whether it is there."""
    at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
    return at, (keys[at] == wanted) if len(keys) else np.zeros(len(wanted), bool)


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kept, where = np.unique(keys, return_inverse=True)
    total = np.zeros((len(kept), values.shape[1]), values.dtype)
    np.add.at(total, where, values)
    return kept, total


class ContextTrees:
    """Frozen statistics of all languages, and the code length of any byte in any context."""

    def __init__(self, languages: list[str], grams: np.ndarray, counts: np.ndarray):
        """``grams``: distinct four-byte sequences; ``counts``: one column for each language."""
        self.languages = languages
        self.levels: list[Level] = []
        for order in range(ORDER + 1):
            keys, n = _summed(grams & np.uint32((1 << 8 * (order + 1)) - 1), counts)
            contexts, seen = _summed(keys >> np.uint32(8), n)
            different = _summed(keys >> np.uint32(8), (n > 0).astype(np.int64))[1]
            self.levels.append(Level(keys, n, contexts, seen, different))
        for order in range(1, ORDER + 1):
            this, shorter = self.levels[order], self.levels[order - 1]
            suffix = np.uint32((1 << 8 * order) - 1)
            at, _ = _find(shorter.grams, this.grams & suffix)
            known = np.where(this.counts > 0, shorter.counts[at], 0)
            known = _summed(this.grams >> np.uint32(8), known)[1]
            at, _ = _find(shorter.contexts, this.contexts & np.uint32((1 << 8 * (order - 1)) - 1))
            this.rest_seen = shorter.seen[at] - known
            this.rest_different = shorter.different[at] - this.different
        self.known = self.levels[ORDER].grams
        self.lengths = self.walk(self.known)
        self._hashed()

    def walk(self, grams: np.ndarray) -> np.ndarray:
        """Bits for each gram's last byte after its first three, one column for each language."""
        shape = (len(grams), len(self.languages))
        bits, done = np.zeros(shape), np.zeros(shape, bool)
        longer = None
        for order in range(ORDER, -1, -1):
            level = self.levels[order]
            context = (grams >> np.uint32(8)) & np.uint32((1 << 8 * order) - 1)
            at, there = _find(level.contexts, context)
            base = np.where(there[:, None], level.seen[at], 0)
            seen, different = base, np.where(there[:, None], level.different[at], 0)
            if longer is not None:
                escaped, excluded_seen, excluded_different = longer
                seen = np.where(escaped, excluded_seen, seen)
                different = np.where(escaped, excluded_different, different)
            at_gram, known = _find(level.grams, grams & np.uint32((1 << 8 * (order + 1)) - 1))
            n = np.where(known[:, None], level.counts[at_gram], 0)
            total = np.log2(np.maximum(seen + different, 1))
            hit = ~done & (base > 0) & (n > 0)
            bits += np.where(hit, total - np.log2(np.maximum(n, 1)), 0)
            escape = ~done & (base > 0) & (n == 0) & (different > 0)
            bits += np.where(escape, total - np.log2(np.maximum(different, 1)), 0)
            done |= hit
            if order:
                longer = (
                    base > 0,
                    np.where(there[:, None], level.rest_seen[at], 0),
                    np.where(there[:, None], level.rest_different[at], 0),
                )
        left = np.log2(np.maximum(256 - self.levels[0].different[0], 1)) if len(self.levels[0].seen) else 8.0
        return bits + np.where(done, 0, left)

    def _hashed(self) -> None:
        """A table of slots; a gram that shares its slot is found by search instead."""
        bits = max(10, int(np.ceil(np.log2(8 * max(1, len(self.known))))))
        self._shift = np.uint32(32 - min(bits, 24))
        self._slots = np.full(1 << min(bits, 24), -1, np.int32)
        self._slots[self._slot(self.known)] = np.arange(len(self.known))

    def _slot(self, grams: np.ndarray) -> np.ndarray:
        return (grams * np.uint32(2654435761)) >> self._shift

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text in each language."""
        total = np.zeros((len(offsets) - 1, len(self.languages)))
        if not len(data) or not len(self.known):
            return total
        grams = _grams(data, offsets)
        at = self._slots[self._slot(grams)]
        missed = np.flatnonzero((at < 0) | (self.known[at] != grams))
        searched, there = _find(self.known, grams[missed])
        at[missed] = searched
        bits = self.lengths[at]
        unseen = missed[~there]
        if len(unseen):
            rare, where = np.unique(grams[unseen], return_inverse=True)
            bits[unseen] = self.walk(rare)[where]
        filled = np.flatnonzero(np.diff(offsets))
        total[filled] = np.add.reduceat(bits, offsets[filled], axis=0)
        return total


def learn(docs: DataFrame, per_language: int = DOCUMENTS_PER_LANGUAGE) -> ContextTrees:
    """Trees from a sample of the rows of ``docs(doc_id, text, lang)`` that are not held out.

    A language is learned if any of its documents may be, also if all are very long.
    """
    rows = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    ids = rows.select("doc_id", "lang").distinct().withColumn("slice", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SLICES)))
    # The first of each slice, then of these: one language may hold most rows.
    for keys in (["lang", "slice"], ["lang"]):
        by_hash = Window.partitionBy(*keys).orderBy(F.xxhash64("doc_id"), "doc_id")
        ids = ids.withColumn("rank", F.row_number().over(by_hash)).where(F.col("rank") <= per_language)
    ids = ids.select("doc_id").distinct()
    # At most per_language ids for each language, so this side may be broadcast.
    texts = rows.join(F.broadcast(ids), "doc_id", "left_semi")
    counted = (
        texts.select(F.col("lang").cast("string"), F.col("text").cast("string"))
        .mapInArrow(_counted, "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    languages = sorted(set(counted.column("lang").to_pylist()))
    column = np.searchsorted(np.array(languages, object), counted.column("lang").to_numpy()) if languages else []
    grams, row = np.unique(counted.column("gram").to_numpy().astype(np.uint32), return_inverse=True)
    counts = np.zeros((len(grams), len(languages)), np.int64)
    counts[row, column] = counted.column("n").to_numpy()
    return ContextTrees(languages, grams, counts)


_LETTER = regex.compile(r"\p{L}")


def _scored(trees: ContextTrees, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            data, offsets = flat(piece.column("text"))
            bits = trees.code_lengths(data, offsets)
            letters = np.array([bool(t) and _LETTER.search(t) is not None for t in piece.column("text").to_pylist()], bool)
            if trees.languages:
                best = bits.argmin(axis=1)
                least = bits[np.arange(len(best)), best]
                score = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
                named = np.array([*trees.languages, UNKNOWN], object)[np.where(letters, best, len(trees.languages))]
                per_byte = least / np.maximum(np.diff(offsets), 1)
            else:
                named, score, per_byte = np.full(len(letters), UNKNOWN, object), np.zeros(len(letters)), np.zeros(len(letters))
            others = [piece.column(c) for c in piece.schema.names if c != "text"]
            names = [c for c in piece.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*others, pa.array(named, pa.string()), pa.array(np.where(letters, score, 0.0)), pa.array(per_byte)],
                [*names, "lang_pred", "score", "bits_per_byte"],
            )


def identify(docs: DataFrame, trees: ContextTrees) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, bits_per_byte`` for every row of ``docs(doc_id, text)``.

    ``score`` is the share of the best language's probability of the text among
    all languages (ties: the first by name).  Null texts and texts without a
    letter are ``und`` with score 0, as is everything if no language was learned.
    Repeated rows give equal rows, an empty table none; other columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), held_out().alias("held_out"), F.col("text").cast("string"))
    return texts.mapInArrow(
        partial(_scored, trees),
        "doc_id bigint, held_out boolean, lang_pred string, score double, bits_per_byte double",
    )


def _known(trees: ContextTrees, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            column = pa.RecordBatch.from_arrays([piece.column("text")], ["text"])
            found = next(iter(_scored(trees, [column])))
            named = pa.compute.not_equal(found.column("lang_pred"), UNKNOWN)
            yield piece.filter(pa.compute.and_(named, pa.compute.less_equal(found.column("bits_per_byte"), FOREIGN_BITS)))


def keep_known(docs: DataFrame, trees: ContextTrees) -> DataFrame:
    """The rows of ``docs`` in a language that was learned, with all their columns."""
    return docs.mapInArrow(partial(_known, trees), docs.schema)
