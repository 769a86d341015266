from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from compare import connect, difference
from quayside.llm import oracles, queries
from quayside.llm.resampling import nth_key, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
    return words, [zlib.crc32(r.encode()) % 10000 for r in runs]


def brute(docs, target):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in docs:
        words, found = features(text)
        weight = sum(
            math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in found
        )
        h = int(sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, score, None, len(words) >= 20])
    order = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for i, r in enumerate(order[: 5 * len(order) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def found(docs, target):
    rows = resample(docs, target).select("row.doc_id", "n_features", "weight", "score", "rank").collect()
    return sorted(map(tuple, rows), key=str)


def test_whole_table(spark, small):
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = found(small, target)
    assert got == brute(
        [(r["doc_id"], r["text"]) for r in small.collect()], [r["text"] for r in target.collect()]
    )
    assert sum(r[4] is not None for r in got) > 3


def test_equals_its_sql(spark):
    name = "op11_resampling"
    assert difference(queries.QUERIES[name](spark, "/root/testdata/sf0.001"), connect("/root/testdata/sf0.001"), oracles.SQL[name]) is None


def test_nulls_ties_repeats_and_extra_columns(spark):
    text = " ".join(f"w{i % 7} Ünï{i}" for i in range(30))
    rows = [(i, text, "x") for i in (5, 5, 5, 5, 9)] * 10 + [(None, text, None)] * 20
    rows += [(100, None, "y"), (101, "", None), (102, " \n--", None), (103, "one two", None), (104, "A " * 40_000, "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string").repartition(5)
    target = spark.createDataFrame([("w1 ünï1 w2",), (None,), ("",)], "text string")
    assert found(docs, target) == brute([r[:2] for r in rows], ["w1 ünï1 w2", None, ""])
    assert resample(docs, target).where("row.score = 'z'").count() == 1


def test_empty_tables(spark, small):
    none = small.limit(0)
    assert found(none, none) == []
    docs = spark.createDataFrame([(1, "too short"), (2, None)], "doc_id bigint, text string")
    assert found(docs, none) == brute([(1, "too short"), (2, None)], [])


@pytest.mark.parametrize("n", [1, 2, 499, 500, 501, 1000])
def test_quickselect(spark, n):
    rows = spark.range(0, 1000, 1, 7).select((F.col("id") * 7919 % 10 - 5).alias("a"), "id")
    values = sorted(map(tuple, rows.collect()))
    assert tuple(nth_key(rows, F.struct("a", "id"), n)) == values[n - 1]
    with pytest.raises(ValueError):
        nth_key(rows, F.struct("a", "id"), 1001)
