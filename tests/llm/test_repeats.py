from __future__ import annotations

import random
from collections import defaultdict
from hashlib import sha256

import pytest

from quayside.llm.queries import op9_repeats
from quayside.llm.repeats import cut_repeats, remove_repeats, repeated_starts


def brute(rows, least):
    where = defaultdict(int)
    data = [(t or "").encode() for _, t in rows]
    for b in data:
        for i in range(len(b) - least + 1):
            where[b[i : i + least]] += 1
    out = []
    for (doc_id, _), b in zip(rows, data, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - least + 1):
            if where[b[i : i + least]] > 1:
                gone[i : i + least] = b"\1" * least
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(b)))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((doc_id, len(b), sum(gone), spans, sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, **how):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumnRenamed("text", "text")
    return sorted((tuple(r) for r in remove_repeats(df, **how).collect()), key=str)


def some_texts(seed):
    rng = random.Random(seed)
    passage = ["".join(rng.choice("abcé ") for _ in range(90)) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [rng.choice(passage)[rng.randint(0, 30) :] if rng.random() < 0.4 else "".join(rng.choice("abcdeü ") for _ in range(rng.randint(0, 80))) for _ in range(rng.randint(0, 4))]
        rows.append((i, "".join(parts)))
    return [*rows, (100, "xy" * 60), (101, None), (102, ""), (None, rows[5][1]), (7, rows[7][1]), (7, rows[8][1] + "z"), (103, "q" * 41), (104, "q" * 40)]


@pytest.mark.parametrize("classes", [256, 1])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, classes):
    rows = some_texts(seed)
    assert found(spark, rows, least=40, gram=20, classes=classes) == brute(rows, 40)


def test_whole_table(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in small.select("doc_id", "text").collect()]
    ours = sorted((tuple(r) for r in remove_repeats(small).collect()), key=str)
    assert ours == brute(rows, 400)
    assert any(r[2] for r in ours)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_other_columns_are_not_read(spark):
    df = spark.createDataFrame([(1, "a" * 500, 3, None)], "doc_id int, text string, key int, found string")
    assert remove_repeats(df).first()["n_removed"] == 500


def test_search_equals_brute_force():
    rng = random.Random(3)
    for _ in range(40):
        texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(1, 6))]
        least = rng.choice([2, 4, 7])
        where, at = defaultdict(list), 0
        for t in texts:
            for i in range(len(t) - least + 1):
                where[t[i : i + least]].append(at + i)
            at += len(t) + 1
        assert set(repeated_starts(texts, least).tolist()) == {p for v in where.values() if len(v) > 1 for p in v}


def test_query_gives_the_text_that_is_left(spark, tmp_path):
    rng = random.Random(4)

    def words(n):
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(5, 9))) for _ in range(n))

    passages = [words(n) for n in (70, 80, 90)]
    own = [words(60) for _ in range(9)]
    rows = [(i, f"{own[i]}\n{passages[i // 2]}\n{own[i][::-1]}") for i in range(6)]
    rows += [(i, own[i]) for i in (6, 7, 8)] + [(9, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {r["doc_id"]: r for r in op9_repeats(spark, str(tmp_path)).collect()}
    for i in range(6):
        # The line ends beside a passage are repeated with it.
        assert (out[i]["n_spans"], out[i]["text"]) == (1, own[i] + own[i][::-1])
    assert [out[i]["text"] for i in (6, 7, 8, 9)] == [*own[6:], ""]
    for doc_id, text in rows:
        row = out[doc_id]
        assert row["n_removed"] == row["n_bytes"] - len(row["text"]) and row["n_bytes"] == len(text or "")
        assert row["kept_sha256"] == sha256(row["text"].encode()).hexdigest()


def test_spans_and_kept_bytes_make_up_the_text(spark):
    rows = [(i, t) for i, (_, t) in enumerate(some_texts(5))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    cut = {r["doc_id"]: r for r in cut_repeats(df, least=40, gram=20).collect()}
    for doc_id, text in rows:
        whole, row, at, kept = (text or "").encode(), cut[doc_id], 0, b""
        for span in row["spans"]:
            assert span["n"] >= 40 and (span["start"] > at or span["start"] == at == 0)
            kept, at = kept + whole[at : span["start"]], span["start"] + span["n"]
        assert kept + whole[at:] == bytes(row["kept"]) and at <= len(whole) == row["n_bytes"]


def test_a_character_cut_through_is_replaced(spark, tmp_path):
    # U+00E9 and U+00E8 share their first byte, which goes with the string before it.
    rows = [(1, "a" + "xyz" * 133 + "wé1"), (2, "b" + "xyz" * 133 + "wè2")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {r["doc_id"]: r for r in op9_repeats(spark, str(tmp_path)).collect()}
    for (doc_id, text), rest in zip(rows, (b"a\xa91", b"b\xa82"), strict=True):
        row = out[doc_id]
        assert (row["n_removed"], row["kept_sha256"]) == (len(text.encode()) - 3, sha256(rest).hexdigest())
        assert row["text"] == rest.decode(errors="replace")
