from __future__ import annotations

import re
from hashlib import md5, sha256

import pytest
from pyspark.sql import functions as F

from quayside.llm import queries
from quayside.llm.fingerprints import ANCHORS, compare_edited, near_pairs


def signature(anchor, chain):
    return int(md5(" ".join([anchor, *chain, *[""] * (2 - len(chain))]).encode()).hexdigest()[:8], 16)


def signatures(text):
    words = [w for w in re.split(r"[^\w]+|_+", text.lower()) if w]
    out, anchors = set(), set(ANCHORS)
    for i, w in [(-1, ""), *enumerate(words)]:
        if i < 0 or w in anchors:
            chain = [x for x in words[i + 1 :] if x not in anchors][:2]
            if chain:
                out.add(signature(w, chain))
    content = [w for w in words if w not in anchors]
    if 16 * (len(words) - len(content)) < len(content):
        out |= {signature(w, content[i + 1 : i + 3]) for i, w in enumerate(content[:-1])}
    return out or {int(md5(text.encode()).hexdigest()[:8], 16)}


def near(a, b):
    return len(a & b) / len(a | b)


def brute(rows):
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    ids = sorted({d for d, _ in rows}, key=lambda d: (d is not None, d or 0))
    first = {d: next(t for e, t in rows if e == d) for d in ids}
    out = []
    for d, t in rows:
        follow = first[ids[(ids.index(d) + 1) % len(ids)]]
        half = len(t) // 2
        edited = t[: len(t) - half] + follow[:half]
        a, b, c = signatures(t), signatures(edited), signatures(follow)
        show = ["".join(f"{s:08x}" for s in sorted(x)) for x in (a, b)]
        out.append((d, len(t), sha256(edited.encode()).hexdigest(), *show, near(a, b), near(a, c), len(a)))
    return sorted(out, key=str)


ROWS = [
    (5, "The cat of the house sat on a mat with the dog"), (2, None), (9, ""), (3, "..."), (4, "the of and"),
    (7, "Größe und Übermut der Straße"), (8, "one"), (None, "the first of all"), (11, "x " * 5000), (9, "also nine"), (12, "日本 の"),
]


def test_equals_brute_force(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string").withColumn("next", F.lit(1))
    assert sorted((tuple(r) for r in compare_edited(df).collect()), key=str) == brute(ROWS)


def test_whole_table(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in small.select("doc_id", "text").collect()]
    got = {r[0]: tuple(r) for r in compare_edited(small).collect()}
    for want in brute(rows):
        assert got[want[0]][:5] == want[:5]
        assert got[want[0]][5:] == pytest.approx(want[5:])


def test_texts_without_anchors_are_told_apart_beyond_their_start(spark):
    """Tables and code of hundreds of words that share only their first two."""
    texts = ["alpha beta " + " ".join(f"{kind}{i}" for i in range(500)) for kind in ("cell", "item")]
    texts.append(texts[0].replace("cell250 ", "changed "))
    got = compare_edited(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).orderBy("doc_id").collect()
    assert got[0]["near_next"] < 0.01 and got[0]["near_edited"] < 0.6
    assert got[2]["near_next"] > 0.98
    assert all(r["n_signatures"] > 450 for r in got)


@pytest.mark.parametrize("n", [0, 1])
def test_few_rows(spark, n):
    got = compare_edited(spark.createDataFrame(ROWS[:n], "doc_id bigint, text string")).collect()
    assert len(got) == n


def test_no_python_in_the_plan(spark):
    plan = compare_edited(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert "cartesian" not in plan.lower()


def test_near_pairs_equal_brute_force(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in small.select("doc_id", "text").collect()]
    least = {}
    for d, t in rows:
        key = frozenset(signatures(t))
        least[key] = min(d, least.get(key, d))
    want = {
        (min(least[a], least[b]), max(least[a], least[b]))
        for a in least
        for b in least
        if least[a] < least[b] and near(a, b) >= 0.8
    }
    assert {(r["a"], r["b"]) for r in near_pairs(small).collect()} == want
    assert want


def test_registered(spark):
    assert queries.QUERIES["op1_spot_signatures"](spark, "/root/testdata/sf0.001").columns[:7] == [
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    ]
