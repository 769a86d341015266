from __future__ import annotations

import random
import re

import numpy as np
import pytest

from quayside.llm.sentences import remove_repeats, split
from quayside.llm.words import hashes

WORD = re.compile(r"[^ \t\n\v\f\r]+")


LONG, ONE_IN = 8, 4


def ends_by_hash(word):
    spelled = np.frombuffer(word.encode(), np.uint8)
    return int(hashes(spelled, np.array([len(spelled)]))[0, 0]) % ONE_IN == 0


def cut(sentence, ends):
    """A long list of ``(word, place, as written)`` cut after words that end a clause."""
    if len(sentence) <= LONG:
        return [sentence]
    parts, part = [], []
    for word in sentence:
        part.append(word)
        if ends(word):
            parts.append(part)
            part = []
    return parts + [part] if part else parts


def sentences_of(text):
    """Each sentence's words and where it begins."""
    out, before = [], None
    for m in WORD.finditer(text):
        if before is None or before.group()[-1] in ".!?" or "\n" in text[before.end() : m.start()]:
            out.append([])
        word = "".join(c.lower() if "A" <= c <= "Z" else c for c in m.group())
        out[-1].append((word, m.start(), m.group()))
        before = m
    out = [p for s in out for p in cut(s, lambda w: w[2][-1] in ",;:")]
    out = [p for s in out for p in cut(s, lambda w: ends_by_hash(w[0]))]
    return [([w[0] for w in s], s[0][1]) for s in out]


def spans_of(sentences, n, words):
    for i in range(len(sentences)):
        j = i + n
        while j <= len(sentences) and sum(len(s[0]) for s in sentences[i:j]) < words:
            j += 1
        if j <= len(sentences):
            yield i, j, tuple(tuple(s[0]) for s in sentences[i:j])


def brute(rows, n=2, words=24):
    first = {}
    for doc_id, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        for i, _, span in spans_of(sentences_of(text or ""), n, words):
            first.setdefault(span, (doc_id, i))
    out = []
    for doc_id, text in rows:
        sentences = sentences_of(text or "")
        gone = {k for i, j, s in spans_of(sentences, n, words) if first[s] != (doc_id, i) for k in range(i, j)}
        at = [b for _, b in sentences] + [len(text or "")]
        left = (text or "")[: at[0]] + "".join((text or "")[at[k] : at[k + 1]] for k in range(len(sentences)) if k not in gone)
        out.append((doc_id, None if text is None else left, len(sentences), len(gone)))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in remove_repeats(df).select("row.doc_id", "text", "n_sentences", "n_removed").collect()), key=str)


def test_equals_brute_force(spark):
    rng = random.Random(5)
    said = [" ".join(f"w{rng.randint(0, 60)}" for _ in range(rng.randint(1, 9))) + rng.choice([".", "!", "?", "\n", ". "]) for _ in range(80)]
    rows = []
    for i in range(70):
        parts = []
        for _ in range(rng.randint(0, 5)):
            at = rng.randint(0, 70)
            parts.append(" ".join(said[at : at + rng.randint(1, 8)]))
        rows.append((i * 7 % 101, " ".join(parts)))
    rows += [(200, None), (201, ""), (202, "  \n "), (203, rows[3][1].upper()), (204, "a. " * 400), (205, "ü é. ñ! " * 20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(df) == brute(rows)
    assert sum(r[3] for r in found(df)) > 50


def test_whole_table(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in small.select("doc_id", "text").collect()]
    assert found(small) == brute(rows)


def test_carries_columns_of_any_name(spark):
    text = "one two three four. five six seven eight. nine ten eleven twelve. " * 2
    df = spark.createDataFrame([(1, text, 5, "x"), (2, "Begin here. " + text, 6, "y"), (None, "q", 7, None)], "doc_id bigint, text string, key int, hits string")
    got = {r["row"]["key"]: (r["row"]["hits"], r["text"]) for r in remove_repeats(df).collect()}
    assert got == {5: ("x", text), 6: ("y", "Begin here. "), 7: (None, "q")}
    assert remove_repeats(df.limit(0)).count() == 0


def a_word(rng):
    return "".join(rng.choice("abdeghiklmnoprstu") for _ in range(rng.randint(2, 9)))


def prose(rng, n):
    """Words of any language with stops and commas now and then."""
    words = []
    for _ in range(n):
        words.append(a_word(rng) + rng.choice(["", "", "", "", "", "", ",", ".", ".\n", "?"]))
    return words


@pytest.mark.parametrize("length", [52, 60, 90])
def test_passages_at_any_word_are_caught_and_clean_texts_stay(spark, length):
    rng = random.Random(length)
    common = " ".join(prose(rng, 11))
    passages = [prose(rng, length) for _ in range(20)]
    # One passage is a single sentence without a mark.
    passages[0] = [w.strip(".,?\n") for w in passages[0]]
    rows, planted = [], {}
    for i in range(200):
        host = prose(rng, rng.randint(60, 200))
        if i % 3 == 0:
            host.insert(rng.randint(0, len(host)), common)
        if i % 2:
            at = rng.randint(0, len(host))
            passage = passages[i // 2 % 20]
            host[at:at] = passage
            planted[i] = " ".join(passage).split()
        rows.append((i, " ".join(host)))
    got = {r["row"]["doc_id"]: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    texts = dict(rows)
    seen, caught = set(), 0
    for i, passage in planted.items():
        if tuple(passage) not in seen:
            seen.add(tuple(passage))
            assert got[i]["text"] == texts[i]
            continue
        caught += len(texts[i].split()) - len(got[i]["text"].split()) >= length // 2
    assert caught >= 0.97 * (len(planted) - len(seen))
    assert all(got[i]["text"] == texts[i] for i in texts if i not in planted)


def test_hot_spans_over_many_ranges(spark):
    """A text that most documents are: its spans fill whole ranges, and the first document alone keeps them."""
    rng = random.Random(3)
    hot = " ".join(prose(rng, 60))
    rows = [(i, hot if i % 4 else " ".join(prose(rng, 40))) for i in range(400)] + [(1, hot)] * 30
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        assert found(df) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_structured_texts_have_different_hashes():
    """A Thue-Morse word and its complement, equal for a polynomial modulo a power of two."""
    word = [bin(i).count("1") % 2 for i in range(1024)]
    texts = [" ".join(("x", "y")[b ^ k] for b in word).encode() for k in (0, 1)]
    for joined in (texts, [t.replace(b" ", b"") for t in texts]):
        data = np.frombuffer(b"".join(joined), np.uint8)
        _, of, count, hashed = split(data, np.array([0, len(joined[0]), len(data)]))
        assert count.sum() in (2048, 2)
        assert hashed[of == 0].tolist() != hashed[of == 1].tolist()


def test_hashes_of_words():
    """Equal for equal words wherever they lie, different for all others."""
    rng = random.Random(4)
    words = ["a" * n for n in range(40)] + ["".join(rng.choice("ab") for _ in range(rng.randint(0, 20))) for _ in range(5000)]
    words += [w + "\0" for w in words[:50]]
    coded = [w.encode() for w in words]
    got = hashes(np.frombuffer(b"".join(coded), np.uint8), np.array([len(w) for w in coded]))
    for lane in (0, 1):
        by_word = dict(zip(words, got[:, lane].tolist()))
        assert all(by_word[w] == h for w, h in zip(words, got[:, lane].tolist()))
        assert len(set(by_word.values())) == len(by_word)
    assert hashes(np.zeros(0, np.uint8), np.zeros(0, np.int64)).shape == (0, 2)
