"""Every stage of the pipeline against a plain version of it, on a table with planted rows."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
import test_near_dedup
import test_sentences
from quayside.llm import language, quality

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def planted(spark):
    """The small table with near copies, a passage in many documents, and rows without text or id."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rng = random.Random(6)
    rows = [tuple(r) for r in docs.collect()]
    long = [r for r in rows if r[1] and len(r[1].split()) > 150 and r[2] == "en"]
    passage = " ".join(rng.choice(long)[1].split()[20:90])
    for k, r in enumerate(long[:12]):
        words = r[1].split()
        words[40 + k] = "changed"
        rows.append((5000 + k, " ".join(words), *r[2:]))
        words = long[-1 - k][1].split()
        rows.append((6000 + k, " ".join([*words[:60], *passage.split(), *words[60:]]), *r[2:]))
    rows += [(7000, None, None, None, None), (7001, "", "en", "web", 0), rows[3], rows[3], (None, rows[5][1], *rows[5][2:])]
    return spark.createDataFrame(rows, docs.schema)


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages_and_their_order():
    assert list(STAGES) == ["quality", "language", "near duplicates", "substrings", "packing"]


def test_quality_keeps_what_the_classifier_keeps(spark, planted):
    kept = STAGES["quality"](spark, planted, SF)
    scored = quality.score(planted, quality.co_train(planted, spark.read.parquet(f"{SF}/labels.parquet")))
    assert kept.columns == planted.columns
    wanted = [r["doc_id"] for r in scored.where("kept").collect()]
    assert sorted(map(str, (r[0] for r in texts(kept)))) == sorted(map(str, wanted))
    assert 0.6 * planted.count() < len(wanted) < planted.count()
    assert not set(bag(kept)) - set(bag(planted))


def test_language_drops_what_was_not_learned(spark, planted):
    kept = STAGES["language"](spark, planted, SF)
    assert kept.columns == planted.columns and not set(bag(kept)) - set(bag(planted))
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(planted, language.learn(planted)).collect()}
    gone = {r[0] for r in texts(planted)} - {r[0] for r in texts(kept)}
    assert {7000, 7001} <= {d for d, lang in found.items() if lang == "und"}
    assert len(gone) < 0.1 * planted.count()
    foreign = spark.createDataFrame([(1, "\u0416\u0429\u042d " * 60, "xx", "web", 240)], planted.schema)
    assert language.keep_known(foreign, language.learn(planted)).count() == 0


def test_one_document_of_each_group_stays(spark, planted):
    kept = STAGES["near duplicates"](spark, planted, SF)
    assert kept.columns == planted.columns
    brute = test_near_dedup.brute(texts(planted), 5)
    wanted = {str(r[0]) for r in brute if r[3]}
    assert {str(d) for d, _ in texts(kept)} == wanted
    assert not any(str(5000 + k) in wanted for k in range(12))
    assert len(texts(kept)) == len(wanted)


def test_repeated_sentences_go(spark, planted):
    # A row without an id is placed by a key from its text, perhaps before the others.
    docs = planted.where("doc_id IS NOT NULL")
    kept = STAGES["substrings"](spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    brute = test_sentences.brute(texts(docs))
    assert sorted(texts(kept), key=str) == sorted([r[:2] for r in brute], key=str)
    n_chars = {r["doc_id"]: (r["n_chars"], len(r["text"])) for r in kept.where("text IS NOT NULL").collect()}
    assert all(a == b for a, b in n_chars.values())


def test_packing_loses_no_token(spark, planted):
    pieces = STAGES["packing"](spark, planted.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), SF).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = {d: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for d, t in texts(planted) if d is not None}
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append((p["start"], p["length"]))
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for listed, ends in ((by_doc, wanted), (by_sequence, None)):
        for name, spans in listed.items():
            at = 0
            for start, length in sorted(spans):
                assert start == at and length > 0
                at += length
            assert at == ends[name] if ends else at <= 1024
    assert by_doc.keys() == wanted.keys()


@pytest.mark.parametrize("name", [n for n in STAGES if n != "packing"])
def test_stages_carry_columns_of_any_name(spark, planted, name):
    odd = ["row", "key", "hits", "class", "score", "kept", "component_id", "lang_pred", "n_removed", "size"]
    docs = planted.limit(60).withColumns({c: F.lit(i) for i, c in enumerate(odd)})
    kept = STAGES[name](spark, docs, SF)
    assert kept.columns == docs.columns
    assert {tuple(r[c] for c in odd) for r in kept.collect()} == {tuple(range(len(odd)))}


def test_all_stages_of_an_empty_table(spark, planted):
    docs = planted.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        docs = out if name != "packing" else docs
