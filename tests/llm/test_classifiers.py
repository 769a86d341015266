from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from compare import connect, difference
from quayside.llm import language, oracles, perspectives, quality, queries

COLUMNS = "doc_id bigint, text string, lang string, source string"


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet")


def test_languages_of_held_out_documents(spark, small):
    got = {r["doc_id"]: r for r in language.identify(small, language.learn(small)).collect()}
    rows = small.collect()
    assert len(got) == len(rows)
    out = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert {r["doc_id"] for r in out} == {d for d, r in got.items() if r["held_out"]}
    judged = [r for r in out if r["lang"] and r["text"] and any(c.isalpha() for c in r["text"])]
    right = sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in judged)
    assert len(judged) > 20 and right >= 0.9 * len(judged)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_ignores_lang_source_and_the_held_out(spark, small):
    trees = language.learn(small)
    turned = small.selectExpr("doc_id", "text", "'zz' AS lang", "'q' AS source")
    assert sorted(language.identify(small, trees).collect()) == sorted(language.identify(turned, trees).collect())
    learning = small.where("crc32(cast(doc_id AS string)) % 4 <> 2")
    again = language.learn(learning)
    assert again.languages == trees.languages and (again.known == trees.known).all()


def test_language_of_very_long_texts_alone_is_learned(spark):
    """Whatever the length of its documents, a language counts."""
    rng = random.Random(5)
    words = {"aa": ["kala", "moro", "tuti"], "bb": ["schwitz", "krumpf", "blenz"]}
    said = {lang: [" ".join(rng.choices(w, k=30_000 if lang == "bb" else 40)) for _ in range(12)] for lang, w in words.items()}
    rows = [(i, text, lang, "s") for lang in said for i, text in enumerate(said[lang], 100 if lang == "bb" else 0)]
    docs = spark.createDataFrame(rows, COLUMNS)
    trees = language.learn(docs)
    assert trees.languages == ["aa", "bb"]
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, trees).collect()}
    assert got == {r[0]: r[2] for r in rows}


def code_length(texts, text):
    """Bits of a text after learning others, byte by byte with dictionaries: the definition, no tables."""
    seen = {}
    for t in texts:
        data = b"\0\0\0" + t.encode()
        for i in range(3, len(data)):
            for k in range(4):
                after = seen.setdefault((k, data[i - k : i]), {})
                after[data[i]] = after.get(data[i], 0) + 1
    data, bits = b"\0\0\0" + text.encode(), 0.0
    for i in range(3, len(data)):
        excluded = set()
        for k in range(3, -1, -1):
            whole = seen.get((k, data[i - k : i]), {})
            after = {b: n for b, n in whole.items() if b not in excluded}
            total = sum(after.values()) + len(after)
            if data[i] in after:
                bits += math.log2(total / after[data[i]])
                break
            if after:
                bits += math.log2(total / len(after))
            excluded |= set(whole)
        else:
            bits += math.log2(max(256 - len(excluded), 1))
    return bits


def test_code_lengths_equal_their_definition(spark):
    rng = random.Random(8)
    letters = {"aa": "abcdé ", "bb": "cdefgß "}
    texts = {lang: ["".join(rng.choices(w, k=rng.randint(1, 200))) for _ in range(9)] for lang, w in letters.items()}
    rows = [(i, t, lang, None) for lang in texts for i, t in enumerate(texts[lang], 50 * (lang == "bb"))]
    trees = language.learn(spark.createDataFrame(rows, COLUMNS))
    learned = {lang: [t for i, t, of, _ in rows if of == lang and zlib.crc32(str(i).encode()) % 4 != 2] for lang in texts}
    judged = ["abc déf zzz", "a", "ßß\nabcabc", *texts["aa"][:3], *texts["bb"][:3]]
    data = np.frombuffer("".join(judged).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in judged])])
    want = [[code_length(learned[lang], t) for lang in trees.languages] for t in judged]
    assert np.allclose(trees.code_lengths(data, offsets), want)


def test_language_of_unusual_rows(spark, small):
    rows = [(1, None, None, "a"), (2, "", "en", "a"), (3, "12 34 !", "en", "a"), (None, "words of a text", None, None), (5, "x" * 500_000, None, None)]
    odd = spark.createDataFrame([*rows, rows[3]], COLUMNS)
    got = language.identify(odd, language.learn(small)).collect()
    assert len(got) == 6
    assert {r["doc_id"]: r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3)} == dict.fromkeys((1, 2, 3), "und")
    none = language.learn(odd.limit(0))
    assert {r["lang_pred"] for r in language.identify(odd, none).collect()} == {"und"}
    assert language.identify(odd.limit(0), none).collect() == []


def test_quality_scores_every_document(spark, small, labels):
    model = quality.co_train(small, labels)
    got = {r["doc_id"]: r for r in quality.score(small, model).collect()}
    assert set(got) == {r["doc_id"] for r in small.select("doc_id").collect()}
    kept = quality.keep_good(small, model)
    assert kept.columns == small.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, r in got.items() if r["kept"]}


def test_quality_of_documents_whose_labels_were_not_learned(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    half = F.expr("crc32(cast(doc_id AS string)) % 2 = 0")
    scored = quality.score(docs, quality.co_train(docs, labels.where(half))).join(labels.where(~half), "doc_id")
    judged = [(r["quality"] == 1 and r["toxic"] == 0, r["kept"]) for r in scored.collect()]
    assert sum(good == kept for good, kept in judged) >= 0.9 * len(judged)
    assert sum(kept for good, kept in judged if good) >= 0.95 * sum(good for good, _ in judged)


def test_exchange_takes_every_document(spark, small):
    """Sums over the whole table equal those of its documents one by one, whatever its partitions."""
    rows = small.select("doc_id", "text", "lang", "source").collect()
    rng = np.random.default_rng(4)
    models = [rng.normal(0, deviation, size + 1) for deviation, size in ((0.4, quality.CONTENT), (2, quality.METADATA))]
    want = {}
    for r in rows:
        batch = pa.RecordBatch.from_pylist([r.asDict()], pa.schema([("doc_id", pa.int64()), *((c, pa.string()) for c in ("text", "lang", "source"))]))
        features = [quality.content_features(batch.column("text"))[0], quality.metadata_features(batch)[0]]
        for view in (0, 1):
            teacher = models[1 - view]
            good = 1 / (1 + math.exp(-(teacher[features[1 - view]].sum() + teacher[-1])))
            label = 1 if good >= quality.SURE else 0 if good <= 1 - quality.SURE else None
            if label is not None:
                total = want.setdefault((view, label), [0, {}])
                total[0] += 1
                for f in features[view].tolist():
                    total[1][f] = total[1].get(f, 0) + 1
    assert len(want) == 4
    texts = small.select("doc_id", "text", "lang", "source")
    for split in (texts, texts.repartition(7)):
        got = quality.exchange(split, models)
        for (view, label), (documents, features) in want.items():
            assert got[view][label].documents == documents
            at = np.flatnonzero(got[view][label].features)
            assert dict(zip(at.tolist(), got[view][label].features[at].astype(int).tolist())) == features


def test_metadata_of_unlabelled_documents_is_learned(spark):
    """A source without any label is told from the texts that the content view is sure of."""
    rng = random.Random(6)
    words = {1: "river stone meadow lantern harbour window".split(), 0: "casino jackpot viagra lottery winner bonus".split()}
    rows, labels = [], []
    for i in range(900):
        good = i % 2
        source = "mixed" if i < 300 else "fine" if good else "foul"
        rows.append((i, " ".join(rng.choices(words[good], k=30)), "en", source))
        if i < 300:
            labels.append((i, good, 0))
    docs = spark.createDataFrame(rows, COLUMNS).repartition(5)
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = quality.co_train(docs, labels)
    assert all(r["kept"] == bool(r["doc_id"] % 2) for r in quality.score(docs, model).collect())
    fine, foul = (zlib.crc32(s) % 1024 for s in (b"fine", b"foul"))
    assert model.metadata[fine] > 0.5 and model.metadata[foul] < -0.5
    alone = quality.co_train(docs, labels, rounds=0)
    assert alone.metadata[fine] == alone.metadata[foul] == 0


def test_repeated_labelled_documents_are_learned_once(spark, small, labels):
    again = small.unionByName(small.withColumn("text", F.concat("text", F.lit(" more"))))
    once = quality.co_train(small, labels, rounds=0)
    twice = quality.co_train(again.withColumn("good", F.lit(0)).withColumn("order", F.lit(1)), labels, rounds=0)
    assert np.allclose(once.content, twice.content) and np.allclose(once.metadata, twice.metadata)


def test_quality_of_unusual_rows(spark, small, labels):
    rows = [(1, None, None, None), (2, "", "en", "a"), (None, "some words", "en", None), (2, "", "en", "a")]
    odd = spark.createDataFrame(rows, COLUMNS)
    got = quality.score(odd, quality.co_train(small, labels)).collect()
    assert len(got) == 4 and all(0 <= r["score"] <= 1 for r in got)
    alone = quality.co_train(small, labels.limit(0))
    assert {r["score"] for r in quality.score(odd, alone).collect()} == {1.0}
    assert quality.score(odd.limit(0), alone).collect() == []


def rendered(messages, speaker):
    """The whole dialogue of ``(turn, role, text)`` as one string and its mask, by plain code."""
    text, mask = "", []
    for _, role, said in sorted(messages):
        head = f"<|im_start|>{'assistant' if role == speaker else 'user name=' + role}\n"
        body = f"{said}<|im_end|>\n"
        text += head + body
        mask += [len(head), len(body)] if role == speaker else [len(head + body), 0]
    return text, mask


def test_perspectives_equal_plain_code(spark):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["ann", "bob", "cy"]), f"line {t} é\n") for c in range(5) for t in range(rng.randint(1, 150))]
    rows += [(90, 1, "ann", ""), (90, 1, "ann", ""), (None, 0, "dan", "hm")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    df = df.withColumn("part", F.lit("x")).withColumn("speaker", F.lit("y"))
    got = {}
    for r in sorted(perspectives.perspectives(df).collect(), key=lambda r: r["first_message"]):
        text, mask = got.get((r["conv_id"], r["speaker"]), ("", []))
        got[r["conv_id"], r["speaker"]] = text + r["text"], mask + list(r["mask"])
        assert r["n_learned"] == sum(r["mask"][1::2]) and sum(r["mask"]) == len(r["text"])
    expected = {}
    for conv, speaker in {(c, role) for c, _, role, _ in rows}:
        expected[conv, speaker] = rendered([r[1:] for r in rows if r[0] == conv], speaker)
    assert got == expected


def test_perspectives_of_unusual_rows(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    df = spark.createDataFrame([(1, None, None, None), (1, 1, "ann", "hi")], schema)
    got = {(r["speaker"], r["first_message"]): r["text"] for r in perspectives.perspectives(df).collect()}
    assert got["unknown", 0] == "<|im_start|>assistant\n<|im_end|>\n<|im_start|>user name=ann\nhi<|im_end|>\n"
    assert got["ann", 0] == "<|im_start|>user name=unknown\n<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n"
    assert len(got) == 2
    assert perspectives.perspectives(df.limit(0)).collect() == []


@pytest.mark.parametrize("ranges", ["4", "61"])
def test_crowded_conversations_keep_their_order(spark, ranges):
    """Thousands of messages without a turn, and of one message again and again: parts follow each other."""
    rng = random.Random(9)
    rows = [(7, None, rng.choice(["ann", "bob"]), f"m{i}") for i in range(3000)] + [(8, 3, "ann", "same")] * 2500
    rows += [(None, i % 5, "cy", "lost") for i in range(700)] + [(c, 1, "dan", "hi") for c in range(20, 60)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(7)
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        parts = perspectives.perspectives(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    got, ends = {}, {}
    for r in sorted(parts, key=lambda r: r["first_message"]):
        key = r["conv_id"], r["speaker"]
        assert r["first_message"] == ends.get(key, 0) and r["n_messages"] <= 64
        ends[key] = r["first_message"] + r["n_messages"]
        text, mask = got.get(key, ("", []))
        got[key] = text + r["text"], mask + list(r["mask"])
    first = [(-1 if t is None else t, role, said) for c, t, role, said in rows if c == 7]
    assert got[7, "ann"] == rendered(first, "ann")
    assert got[8, "ann"] == rendered([r[1:] for r in rows if r[0] == 8], "ann")
    assert got[None, "cy"] == rendered([r[1:] for r in rows if r[0] is None], "cy")
    assert len(got) == 4 + 40


def test_perspectives_equal_their_sql(spark):
    name = "op8_perspectives"
    sf = "/root/testdata/sf0.001"
    assert difference(queries.QUERIES[name](spark, sf), connect(sf), oracles.SQL[name]) is None
