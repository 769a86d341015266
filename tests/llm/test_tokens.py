from __future__ import annotations

import random
import tracemalloc
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from quayside.llm import packing, sentencepiece
from quayside.llm.byte_bpe import ByteBpe

MODEL, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
ROWS = [
    (1, "don't we're I'll 'tis  ''s ('s \n's  's 'really it'd"), (2, None), (3, ""), (4, " a  b \n\n c\t"), (5, "x" * 300 + " y"),
    (6, "naïve  ünd 12ab3 €5 日本  z"), (7, "<|endoftext|> hi"), (None, "'"), (8, "no mark of▁words ▁"), (1, "again"), (9, "the cat " * 700),
]


def test_dropout_decodes_and_without_it_ids_are_the_librarys(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    encoded = sentencepiece.encode(df, MODEL)
    assert all(r["lossless"] for r in encoded.collect())
    assert sorted(r["text"] for r in sentencepiece.decode(encoded, MODEL).collect()) == sorted(t or "" for _, t in ROWS)
    library = SentencePieceProcessor(model_file=MODEL)
    plain = sorted(r["ids"] for r in sentencepiece.encode(df, MODEL, dropout=0.0).collect())
    marked = [t for _, t in ROWS if "▁" in (t or "")]
    assert [i for i in sorted(library.encode(t or "") for _, t in ROWS if t not in marked) if i not in plain] == []
    other = sentencepiece.encode(df, MODEL, seed=5)
    assert {tuple(r["ids"]) for r in other.collect()} != {tuple(r["ids"]) for r in encoded.collect()}


def test_pieces_are_the_tokenizers_ids(spark):
    library = Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    rows = [r for r in ROWS if r[1] != "again"]
    got = packing.pack(spark.createDataFrame(rows, "doc_id bigint, text string"), BYTES).collect()
    want = set()
    for doc_id, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for at in range(0, len(ids), 1024):
            part = ids[at : at + 1024]
            want.add((doc_id, at, len(part), zlib.crc32(part.tobytes()), len(ids)))
    assert {tuple(r)[:5] for r in got} == want and len(got) == len(want)
    for s in {r["sequence_id"] for r in got}:
        at = 0
        for r in sorted((r for r in got if r["sequence_id"] == s), key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024


@pytest.mark.parametrize("seed", [1, 2])
def test_best_fit_takes_the_tightest_window(seed):
    lengths = np.random.default_rng(seed).integers(1, 1025, 500)
    placed, offset, n = packing.best_fit(lengths)
    rooms: list[int] = []
    for i in np.argsort(-lengths, kind="stable"):
        fits = [k for k, room in enumerate(rooms) if room >= lengths[i]]
        least = min((rooms[k] for k in fits), default=None)
        if least is None:
            rooms.append(1024)
            assert placed[i] == len(rooms) - 1 and offset[i] == 0
        else:
            assert offset[i] == 1024 - least == 1024 - rooms[placed[i]]
        rooms[placed[i]] -= lengths[i]
    assert len(rooms) == n


def test_memory_of_a_task_that_packs(monkeypatch):
    """What a task holds beside its rows: by pieces of a batch, and words kept up to a bound."""
    rng = random.Random(4)
    texts = [" ".join(str(rng.randrange(10**6)) for _ in range(2000)) for _ in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array(texts)], ["doc_id", "text"])
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    tokenizer = ByteBpe(BYTES)
    list(packing._packed(tokenizer, 1024, 1 << 16, iter([batch.slice(0, 1)])))
    tracemalloc.start()
    rows = sum(out.num_rows for out in packing._packed(tokenizer, 1024, 1 << 16, iter([batch])))
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert rows >= 400 and most < 90 << 20
