from __future__ import annotations

import random
import re
from hashlib import sha256

import numpy as np
import pytest

from compare import connect, difference
from quayside.llm import oracles, queries
from quayside.llm.decontamination import contamination, decontaminate, find
from quayside.llm.fm_index import FMIndex, suffix_order

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    windows = {}
    for item_id, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1)) if w else ():
            windows.setdefault(tuple(w[i : i + window]), set()).add(item_id)
    out = []
    for doc_id, text in docs:
        w, hit, met = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                found = windows.get(tuple(w[i : i + size]))
                if found:
                    hit.update(range(i, i + size))
                    met |= {str(x) for x in found if x is not None}
        out.append((doc_id, len(w), len(hit), len(met), sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def got(docs, items, **options):
    found = contamination(docs, items, **options)
    listed = found.select("row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    return sorted(map(tuple, listed.collect()), key=str)


def test_equals_its_sql(spark):
    name = "op13_decontamination"
    assert difference(queries.QUERIES[name](spark, SF), connect(SF), oracles.SQL[name]) is None


def tables(spark, seed):
    rng = random.Random(seed)
    common = [f"w{i}" for i in range(6)]
    items = [(i % 70, " ".join(rng.choice(common) for _ in range(rng.choice([0, 1, 2, 5, 9, 10, 11, 30])))) for i in range(90)]
    items = [(i, t) for i, t in items if len(t.split()) not in (1, 2) or i < 3]
    items += [(None, "names no item but hits"), (200, None), (201, ""), (202, "only"), (items[5][0], "Ünï ÉÉ one more")]
    docs = []
    for i in range(150):
        parts = [" ".join(f"x{rng.randrange(50)}" for _ in range(rng.randrange(9)))]
        for _ in range(rng.randrange(4)):
            parts.append(rng.choice(items)[1] or "")
            parts.append(" ".join(rng.choice(common) for _ in range(rng.randrange(15))))
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(parts)))
    docs += [(500, None), (501, ""), (502, "-- --"), (503, docs[3][1].upper()), (None, docs[4][1]), docs[5], docs[5]]
    docs += [(504, "ünï ÉÉ one MORE"), (505, "names no item but hits"), (506, "w1 " * 50_000), (507, "tail w0 w1")]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("block_bytes", [1 << 22, 1500])
def test_equals_brute_force(spark, seed, block_bytes):
    docs, items = tables(spark, seed)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = got(df, bench, block_bytes=block_bytes)
    assert found == brute(docs, items)
    assert {r[5] for r in found} == {True, False}


def test_empty_tables_and_extra_columns(spark):
    docs = spark.createDataFrame([(1, "a b c", "x", 7), (2, None, None, 8)], "doc_id bigint, text string, spans string, n_words int")
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert got(docs, none) == brute([(1, "a b c"), (2, None)], [])
    bench = spark.createDataFrame([("q", "B", 1)], "item_id string, text string, row int")
    assert got(docs, bench) == brute([(1, "a b c"), (2, None)], [("q", "b")])
    assert got(docs.limit(0), bench) == []
    cut = {r["row"]["n_words"]: (r["row"]["spans"], r["text"], r["items"]) for r in decontaminate(docs, bench).collect()}
    assert cut == {7: ("x", "a  c", ["q"]), 8: (None, None, [])}


def test_spans_are_of_words_and_bytes(spark):
    docs = spark.createDataFrame([(1, "é one, TWO three; two three. Two; two")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "two three")], "item_id bigint, text string")
    spans = find(docs, bench).first()["spans"]
    assert [tuple(s) for s in spans] == [(2, 4, 8, 28)]


@pytest.mark.parametrize("seed", range(4))
def test_index_finds_all_places(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(0, 60, 25)
    of = np.repeat(np.arange(25), sizes)
    ids = rng.integers(0, 3, len(of))
    index = FMIndex(ids, of, 25, 4)
    patterns = rng.integers(0, 4, (60, 4))
    low, high = index.search(patterns)
    found = [set() for _ in patterns]
    for word, pattern in index.locate(low, high, at_once=17):
        for w, p in zip(word.tolist(), pattern.tolist()):
            assert w not in found[p]
            found[p].add(w)
    for p, places in zip(patterns, found):
        assert places == {
            i for i in range(len(ids) - 3) if of[i] == of[i + 3] and (ids[i : i + 4] == p).all()
        }


def test_suffixes_are_sorted():
    rng = np.random.default_rng(1)
    for n_symbols in (1, 2, 50, 1 << 33):
        symbols = rng.integers(0, min(n_symbols, 3), 300)
        order = suffix_order(symbols, n_symbols)
        assert list(order) == sorted(range(300), key=lambda i: list(symbols[i:]))
