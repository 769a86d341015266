from __future__ import annotations

import math
import random

import numpy as np
import pytest

from compare import connect, difference
from quayside.llm import oracles, queries
from quayside.llm.hard_negatives import Walk, mine, spanning_tree

SF = "/root/testdata/sf0.01"


def brute(rows):
    taken = {}
    for vec_id, embedding, label in rows:
        if None in (vec_id, label, embedding) or any(x is None or not math.isfinite(x) for x in embedding):
            continue
        whole = [math.floor(256 * x) for x in embedding]
        if any(abs(x) >= 2**53 for x in embedding) or sum(x * x for x in whole) >= 2**62:
            continue
        row = ((label + 1) % 10 if vec_id % 7 == 0 else label, whole)
        taken[vec_id] = min(taken.get(vec_id, row), row)
    out = []
    for anchor, (label, e) in taken.items():
        if anchor % 100:
            continue
        scores = [
            (-sum(x * y for x, y in zip(e, f)), other, other_label)
            for other, (other_label, f) in taken.items()
            if other != anchor and len(f) == len(e)
        ]
        scores.sort()
        for p, positive, _ in [s for s in scores if s[2] == label][:5]:
            fits = [s for s in scores if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p]
            out += [(anchor, positive, i + 1, n, -p, -s) for i, (s, n, _) in enumerate(fits[:10])]
    return sorted(out)


def found(df, **options):
    return sorted(map(tuple, mine(df, **options).collect()))


KINDS = "vec_id bigint, embedding array<float>, label int"


def clustered(seed, n=900, d=12):
    """Vectors around a few centres, with small components so that many scores tie."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d))
    at = rng.integers(0, 6, n)
    vectors = np.round(centres[at] + rng.normal(size=(n, d)) * 0.1, 2)
    return [(int(i) * 10, [float(x) for x in np.float32(v)], int(rng.integers(0, 3))) for i, v in enumerate(vectors)]


def test_equals_its_sql(spark):
    name = "op12_hard_negatives"
    assert difference(queries.QUERIES[name](spark, SF), connect(SF), oracles.SQL[name]) is None


@pytest.mark.parametrize("block,at_once", [(512, 1 << 24), (7, 1), (1, 4000)])
def test_blocks_and_turns_change_nothing(spark, block, at_once):
    rows = clustered(1)
    df = spark.createDataFrame(rows, KINDS).repartition(5)
    got = found(df, block=block, at_once=at_once)
    assert got == brute(rows)
    assert len(got) > 500


def test_odd_rows(spark):
    rng = random.Random(3)
    rows = clustered(2, 200)
    rows += [(100 * i, [rng.uniform(-1, 1) for _ in range(3)], i % 2) for i in range(30, 60)]
    rows += [(3000 + i, [rng.uniform(-1, 1) for _ in range(3)], i % 3) for i in range(1, 50)]
    rows = [(i, None if e is None else [float(np.float32(x)) for x in e], y) for i, e, y in rows]
    rows += [(10_000, [1.0, None], 1), (10_100, [math.nan] * 12, 1), (10_200, [math.inf] * 3, 1), (10_300, None, 1)]
    rows += [(10_400, [1.0, 0.5, 0.25], None), (None, [1.0, 0.5, 0.25], 1), (10_500, [], 1), (10_501, [], 1), (10_502, [], 2)]
    rows += [(10_600, [3e38, 0.0, 0.0], 1), (10_700, [1e6, 2.0, -1e6], 1), (10_701, [1e6, 1.0, -1e6], 1), (10_702, [7e5, 0.0, -1e5], 0)]
    rows += rows[5:9] * 3 + [(3001, [0.25, 0.5, 0.125], 9)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], KINDS + ", vector string, block int").repartition(4)
    assert found(df) == brute(rows)
    assert found(df.limit(0)) == []
    assert found(df.where("label IS NULL")) == []


def test_bounds_leave_out_candidates_of_clusters():
    """Near anchors are not all scored against every candidate, and nothing is lost by it."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(5, 32)) * 200
    anchors = np.floor(centres[np.arange(100) % 5] + rng.normal(size=(100, 32)) * 8).astype(np.int64)
    others = np.floor(centres[rng.integers(0, 5, 4000)] + rng.normal(size=(4000, 32)) * 8)
    labels = np.zeros(100, np.int64)
    tree = spanning_tree(np.arange(100) + 10_000, labels, anchors)
    tree.vectors = tree.vectors.astype(np.int64)
    walk = Walk(tree, [[(-np.inf, np.inf, 0)] for _ in range(100)], True, 5)
    for at in range(0, 4000, 500):
        walk.add(np.arange(at, at + 500), np.zeros(500, np.int64), others[at : at + 500])
    assert walk.scored < 0.7 * 100 * 4000
    for j in range(100):
        scores = others.astype(np.int64) @ tree.vectors[j]
        order = np.lexsort((np.arange(4000), -scores))[:5]
        assert list(walk.best[j][0].ids) == list(order)
