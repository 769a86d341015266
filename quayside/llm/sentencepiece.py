"""SentencePiece encoding with seeded merge-dropout, and decoding.

Pieces are merged from an agenda ordered by score, then place.  Every candidate
merge of a document is skipped when the hash of the seed, the document's key and
the three places it joins falls below the dropout: the same seed gives the same
pieces on any machine and in any order, another seed another segmentation.  With
no dropout the ids are those of the SentencePiece library.

Blanks become the word mark, and a word mark is put before each text that is not
empty, as the model does.  Characters without a piece, the mark itself included,
become their UTF-8 bytes, so decoding returns every text exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.arrays import PIECE_BYTES, U64, lists, mix, pieces, ranges
from quayside.llm.merges import MergeTable
from quayside.llm.store import document_key

MARK = "▁"
DROPOUT, SEED = 0.1, 20240101

#: Characters merged at a time; longer texts are cut between words.
SPAN = 1 << 20


@dataclass
class Pieces:
    """A model's pieces as tables."""

    merges: MergeTable
    #: Id of each code point's piece, -1 where it has none.
    characters: np.ndarray
    byte_ids: np.ndarray
    blob: np.ndarray
    begins: np.ndarray
    sizes: np.ndarray

    @classmethod
    def load(cls, path: str) -> Pieces:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain, byte_ids, decoded = {}, np.zeros(256, np.int32), [b""] * n
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                byte_ids[value], decoded[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                plain[piece], decoded[i] = i, piece.replace(MARK, " ").encode()
        by_score = sorted({-model.get_score(i) for i in plain.values()})
        rank_of = {score: k for k, score in enumerate(by_score)}
        pairs = [
            (plain[piece[:k]], plain[piece[k:]], i, rank_of[-model.get_score(i)])
            for piece, i in plain.items()
            for k in range(1, len(piece))
            if piece[:k] in plain and piece[k:] in plain
        ]
        characters = np.full(0x110000, -1, np.int32)
        for piece, i in plain.items():
            if len(piece) == 1:
                characters[ord(" " if piece == MARK else piece)] = i
        sizes = np.array([len(d) for d in decoded], np.int64)
        return cls(
            MergeTable(*np.array(pairs, np.int64).T),
            characters,
            byte_ids,
            np.frombuffer(b"".join(decoded), np.uint8),
            np.cumsum(sizes) - sizes,
            sizes,
        )

    def encode(self, text: str, seed: int, dropout: float) -> np.ndarray:
        return self.encode_all([text], np.array([seed], U64), dropout)[0]

    def encode_all(self, texts: list[str], seeds: np.ndarray, dropout: float) -> list[np.ndarray]:
        """Ids of each text; ``seeds`` decide which merges each skips."""
        marked = ["" if not t else f" {t}" for t in texts]
        sizes = np.array([len(t) for t in marked], np.int64)
        points = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32)
        if not len(points):
            return [np.zeros(0, np.int32) for _ in texts]
        begins = np.cumsum(sizes) - sizes
        symbols = self.characters[points]
        blank = points == 32
        word = np.zeros(len(points), bool)
        word[begins[sizes > 0]] = True
        word[1:] |= blank[1:] & ~blank[:-1]
        word |= symbols < 0
        word[1:] |= symbols[:-1] < 0
        starts = np.flatnonzero(word)
        lengths = np.diff(np.append(starts, len(points)))
        text_of = np.repeat(np.arange(len(texts)), sizes)
        ids, places = [], []
        cut = 0
        while cut < len(starts):
            to = max(cut + 1, int(np.searchsorted(starts, starts[cut] + SPAN)))
            lo = starts[cut]
            hi = starts[to] if to < len(starts) else len(points)

            def skip(left, right, end, lo=lo):
                of = text_of[left + lo]
                base = begins[of] - lo
                hashed = mix(seeds[of] + (left - base).astype(U64) * U64(0x9E3779B97F4A7C15))
                hashed = mix(hashed ^ ((right - base).astype(U64) << U64(32) | (end - base).astype(U64)))
                return hashed < U64(int(dropout * (2**64 - 1)))

            found, place = self.merges.apply(symbols[lo:hi], lengths[cut:to], skip if dropout > 0 else None)
            ids.append(found)
            places.append(place + lo)
            cut = to
        ids, places = np.concatenate(ids), np.concatenate(places)
        ids, counts = self._with_bytes(ids, points[places])
        per_text = np.zeros(len(texts), np.int64)
        np.add.at(per_text, text_of[places], counts)
        return np.split(ids, np.cumsum(per_text)[:-1])

    def _with_bytes(self, ids: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece as the pieces of their bytes; how many each became."""
        counts = np.ones(len(ids), np.int64)
        unknown = np.flatnonzero(ids < 0)
        if not len(unknown):
            return ids, counts
        kinds, which = np.unique(points[unknown], return_inverse=True)
        coded = [self.byte_ids[np.frombuffer(chr(p).encode(), np.uint8)] for p in kinds]
        size = np.array([len(c) for c in coded], np.int64)
        counts[unknown] = size[which]
        out = np.repeat(ids, counts)
        begin = np.cumsum(counts) - counts
        begin_of_kind = np.cumsum(size) - size
        out[ranges(begin[unknown], size[which])] = np.concatenate(coded)[ranges(begin_of_kind[which], size[which])]
        return out, counts

    def decode(self, ids: np.ndarray) -> str:
        """The text that ids of any segmentation stand for."""
        return self.blob[ranges(self.begins[ids], self.sizes[ids])].tobytes()[1:].decode()


def _encoded(model: Pieces, seed: int, dropout: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text", 2 * PIECE_BYTES):
            texts = [t or "" for t in piece.column("text").to_pylist()]
            with np.errstate(over="ignore"):
                seeds = mix(piece.column("key").to_numpy().astype(np.int64).view(U64) + U64(seed))
                ids = model.encode_all(texts, mix(seeds), dropout)
            decoded = [model.decode(i) for i in ids]
            sizes = np.array([len(i) for i in ids], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array(sizes),
                    lists(np.concatenate(ids), sizes, pa.int32()),
                    pa.array([sha256(t.encode()).hexdigest() for t in decoded], pa.string()),
                    pa.array([a == b for a, b in zip(decoded, texts, strict=True)], pa.bool_()),
                ],
                ["doc_id", "n_ids", "ids", "decoded_sha256", "lossless"],
            )


def encode(docs: DataFrame, model_path: str, seed: int = SEED, dropout: float = DROPOUT) -> DataFrame:
    """``doc_id, n_ids, ids, decoded_sha256, lossless`` for every row of ``docs(doc_id, text)``.

    Null and empty texts have no ids and decode to the empty text.  Rows with one
    ``doc_id`` share their skips; a row without takes them from its text.  An
    empty table gives no rows; other columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), document_key().alias("key"), F.col("text").cast("string"))
    return texts.mapInArrow(
        partial(_encoded, Pieces.load(model_path), seed, dropout),
        "doc_id bigint, n_ids bigint, ids array<int>, decoded_sha256 string, lossless boolean",
    )


def _decoded(model: Pieces, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [model.decode(np.array(i or [], np.int64)) for i in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, text`` for every row of ``encoded(doc_id, ids)``; null ids give the empty text."""
    return encoded.select("doc_id", "ids").mapInArrow(
        partial(_decoded, Pieces.load(model_path)), "doc_id bigint, text string"
    )
