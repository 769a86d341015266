"""Hard negatives of anchor vectors, with bounds along a spanning tree of the anchors.

Anchors that lie near each other share a block, and the anchors of a block are joined by a
minimum spanning tree of their distances.  Every candidate is scored against the
root.  By Cauchy and Schwarz the score at a child is the parent's plus or minus
the length of the edge times the candidate's norm, so walking down the tree gives each
candidate an interval at each anchor, from the nearest ancestor that scored it. Only candidates
whose interval meets the anchor's window are scored there.

Two walks: the first finds the positives, the window being all scores from the worst
positive so far on; their scores set the windows of the second, which finds the
negatives.  Candidates stay in their tasks; what moves is a block's tree, of
bounded size, and each task's best few for each anchor.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.functions.ranks import ranked
from quayside.llm.store import written

EVERY, RELABELLED, LABELS, SCALE = 100, 7, 10, 256
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90

#: Anchors of one tree, and bytes of trees sent to the executors at a time.
BLOCK, AT_ONCE = 512, 1 << 24

#: Random directions whose signs bring anchors that are near each other together.
DIRECTIONS = 16

#: Squared norms from here on could give a score that is no long.
LONGEST = float(1 << 62)

_EXACT = float(1 << 53)
_BATCH = 8192


@dataclass
class Tree:
    """Anchors of a block, parents before children; ``edge`` is the distance to the parent."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    parent: np.ndarray
    edge: np.ndarray


def spanning_tree(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Tree:
    """Prim's algorithm from the anchor nearest to the mean."""
    n = len(ids)
    points = vectors.astype(np.float64)
    root = int(np.argmin(((points - points.mean(axis=0)) ** 2).sum(axis=1)))
    near = np.full(n, np.inf)
    via = np.zeros(n, np.int64)
    near[root], via[root] = 0.0, -1
    open_ = np.ones(n, bool)
    order, parent = [], []
    for _ in range(n):
        at = int(np.argmin(np.where(open_, near, np.inf)))
        open_[at] = False
        order.append(at)
        parent.append(via[at])
        apart = ((points - points[at]) ** 2).sum(axis=1)
        closer = open_ & (apart < near)
        near[closer], via[closer] = apart[closer], at
    order = np.array(order)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    parent = np.array(parent)
    up = np.where(parent < 0, -1, place[parent])
    # A little longer than computed, so that rounding cannot cut a bound short.
    edge = np.sqrt(near[order]) * (1 + 1e-9)
    return Tree(ids[order], labels[order], vectors[order], up, edge)


def _scores(vectors: np.ndarray, norms: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers."""
    if not len(vectors):
        return np.zeros(0, np.int64)
    if norms.max() * np.sqrt((anchor.astype(np.float64) ** 2).sum()) < _EXACT / 4:
        return (vectors @ anchor.astype(np.float64)).astype(np.int64)
    return vectors.astype(np.int64) @ anchor


class _Best:
    """The first few by score, ties by smaller id."""

    def __init__(self, keep: int):
        self.keep = keep
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)

    @property
    def least(self) -> float:
        """Scores below this change nothing."""
        return float(self.scores[-1]) if len(self.scores) == self.keep else -np.inf

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > self.keep:
            bound = np.partition(scores, len(scores) - self.keep)[len(scores) - self.keep]
            scores, ids = scores[scores >= bound], ids[scores >= bound]
        scores, ids = np.append(self.scores, scores), np.append(self.ids, ids)
        order = np.lexsort((ids, -scores))[: self.keep]
        self.scores, self.ids = scores[order], ids[order]


class Walk:
    """Candidates walked down one tree; ``windows[j]`` lists ``(low, high, key)`` of anchor j."""

    def __init__(self, tree: Tree, windows: list[list[tuple[float, float, int]]], same_label: bool, keep: int):
        self.tree = tree
        self.windows = windows
        self.same_label = same_label
        self.best = [[_Best(keep) for _ in w] for w in windows]
        # Which anchors are a parent: only those hand their intervals on.
        self.parents = np.zeros(len(tree.ids), bool)
        self.parents[tree.parent[tree.parent >= 0]] = True
        self.scored = 0

    def add(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        tree = self.tree
        norms = np.sqrt((vectors**2).sum(axis=1)) * (1 + 1e-9)
        low: dict[int, np.ndarray] = {}
        high: dict[int, np.ndarray] = {}
        children = np.bincount(tree.parent[tree.parent >= 0], minlength=len(tree.ids))
        for j in range(len(tree.ids)):
            p = int(tree.parent[j])
            if p < 0:
                known = np.ones(len(ids), bool)
                lo = hi = None
            else:
                reach = tree.edge[j] * norms
                lo, hi = low[p] - reach, high[p] + reach
                children[p] -= 1
                if not children[p]:
                    del low[p], high[p]
                known = np.zeros(len(ids), bool)
                # A margin for the rounding of sums beyond the numbers that a double holds exactly.
                slack = 1 + 1e-9 * np.abs(reach)
                for (a, b, _), best in zip(self.windows[j], self.best[j]):
                    known |= (hi + slack >= max(a, best.least)) & (lo - slack <= b)
                wanted = (labels == tree.labels[j]) == self.same_label
                # Below the root a candidate of the wrong label matters to the anchor's children alone.
                known &= wanted & (ids != tree.ids[j])
            rows = np.flatnonzero(known)
            whole = len(rows) == len(ids)
            scores = _scores(vectors if whole else vectors[rows], norms, tree.vectors[j])
            self.scored += len(rows)
            if self.parents[j]:
                if lo is None or whole:
                    low[j] = high[j] = scores.astype(np.float64)
                else:
                    lo, hi = lo.copy(), hi.copy()
                    lo[rows] = hi[rows] = scores
                    low[j], high[j] = lo, hi
            if p < 0:
                keep = ((labels == tree.labels[j]) == self.same_label) & (ids != tree.ids[j])
                rows, scores = rows[keep], scores[keep]
            for (a, b, _), best in zip(self.windows[j], self.best[j]):
                fits = (scores >= max(a, best.least)) & (scores <= b)
                if fits.any():
                    best.add(scores[fits], ids[rows[fits]])


def _vectors(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows by their number of components, and their whole-numbered vectors as doubles."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    out = []
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        out.append((rows, flat[(ends[rows] - d)[:, None] + np.arange(d)].astype(np.float64)))
    return out


_FOUND = "anchor bigint, key int, score bigint, vec_id bigint"


def _walked(trees: Broadcast, same_label: bool, keep: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    walks: dict[int, list[Walk]] = {}
    for d, tree, windows in trees.value:
        walks.setdefault(d, []).append(Walk(Tree(*tree), windows, same_label, keep))
    for batch in batches:
        for at in range(0, batch.num_rows, _BATCH):
            part = batch.slice(at, _BATCH)
            ids = part.column("vec_id").to_numpy()
            labels = part.column("label").to_numpy()
            for rows, vectors in _vectors(part.column("vector")):
                for walk in walks.get(vectors.shape[1], ()):
                    walk.add(ids[rows], labels[rows], vectors)
    for found in walks.values():
        for walk in found:
            for j, (windows, best) in enumerate(zip(walk.windows, walk.best)):
                n = [len(b.ids) for b in best]
                if sum(n):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(sum(n), walk.tree.ids[j])),
                            pa.array(np.repeat([k for _, _, k in windows], n), pa.int32()),
                            pa.array(np.concatenate([b.scores for b in best])),
                            pa.array(np.concatenate([b.ids for b in best])),
                        ],
                        ["anchor", "key", "score", "vec_id"],
                    )


def _first(found: DataFrame, keep: int) -> DataFrame:
    """The first ``keep`` of all tasks, with their rank."""
    order = Window.partitionBy("anchor", "key").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


_TREE = "block bigint, place int, vec_id bigint, label bigint, vector array<double>, parent int, edge double"


def _trees(group: pa.Table) -> pa.Table:
    vectors = np.array(group.column("vector").to_pylist(), np.float64).reshape(group.num_rows, -1)
    tree = spanning_tree(group.column("vec_id").to_numpy(), group.column("label").to_numpy(), vectors)
    n = len(tree.ids)
    return pa.table(
        {
            "block": np.full(n, group.column("block")[0].as_py()),
            "place": np.arange(n, dtype=np.int32),
            "vec_id": tree.ids,
            "label": tree.labels,
            "vector": pa.array(list(tree.vectors), pa.list_(pa.float64())),
            "parent": tree.parent.astype(np.int32),
            "edge": tree.edge,
        }
    )


def _usable(rows: DataFrame) -> DataFrame:
    """``vec_id, label, vector``: relabelled, whole-numbered rows that take part, one for each ``vec_id``."""
    fine = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    # Comparing with a number first: floor() of a larger one would not fit a long.
    small = F.forall("embedding", lambda x: F.abs(x.cast("double")) < 2.0**53)
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    label = F.col("label").cast("bigint")
    taken = (
        rows.select("vec_id", "label", "embedding")
        .where(fine)
        .where(small)
        .select(
            F.col("vec_id").cast("bigint"),
            F.when(F.col("vec_id") % RELABELLED == 0, F.pmod(label + 1, F.lit(LABELS))).otherwise(label).alias("label"),
            whole.alias("vector"),
        )
        .where(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x) < LONGEST)
    )
    return taken.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row")).select("vec_id", "row.*")


def _side(i: int) -> Column:
    """A bit: on which side of a random plane a vector lies."""
    turned = F.transform("vector", lambda x, k: F.when(F.xxhash64(k, F.lit(i)) % 2 == 0, x).otherwise(-x))
    return F.when(F.aggregate(turned, F.lit(0.0), lambda s, x: s + x) > 0, F.lit(1 << i)).otherwise(F.lit(0))


def _blocks(anchors: DataFrame, block: int) -> DataFrame:
    """Anchors of one dimension, numbered along random signs and cut into blocks; a tree for each."""
    code = sum((_side(i) for i in range(DIRECTIONS)), F.lit(0))
    placed = anchors.withColumns({"size": F.size("vector"), "code": code})
    ranges = int(anchors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = ranked(placed, [F.col("size"), F.col("code"), F.col("vec_id")], ranges, "place")
    # Dimensions share no block: a block is its number and its size.
    numbered = numbered.withColumn("block", F.expr(f"(place - 1) div {block}"))
    grouped = numbered.select("block", "size", "vec_id", "label", "vector").groupBy("block", "size")
    return grouped.applyInArrow(lambda group: _trees(group), _TREE)


def _held(rows: list) -> list[tuple[int, Tree, list]]:
    """Trees of collected rows."""
    out = []
    by_block: dict[tuple[int, int], list] = {}
    for r in rows:
        by_block.setdefault((r["block"], len(r["vector"])), []).append(r)
    for (_, d), found in by_block.items():
        found.sort(key=lambda r: r["place"])
        vectors = np.array([r["vector"] for r in found], np.float64).reshape(len(found), d)
        tree = Tree(
            np.array([r["vec_id"] for r in found], np.int64),
            np.array([r["label"] for r in found], np.int64),
            vectors.astype(np.int64),
            np.array([r["parent"] for r in found], np.int64),
            np.array([r["edge"] for r in found], np.float64),
        )
        out.append((d, tree, []))
    return out


def mine(
    rows: DataFrame,
    every: int = EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    block: int = BLOCK,
    at_once: int = AT_ONCE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` from ``rows(vec_id, embedding, label)``.

    Rows with a null id, label or vector, or a component that is null, not finite, or
    2**53 and beyond, or with a norm of 2**31 whole-numbered units and beyond (their scores need
    not fit a long) take no part.  Of rows with one ``vec_id`` the smallest by label and vector
    does.  Vectors score against those of as many components only.  A positive whose score
    is negative has an empty window.  Anchors with no positive, and positives without a
    negative in their window, give no rows; so does an empty table.  Other columns are not read.

    Anchors go to the executors in turns of ``at_once`` bytes, so their number has no bound.
    """
    spark = rows.sparkSession
    taken = written(_usable(rows), "vectors")
    trees = written(_blocks(taken.where(F.col("vec_id") % every == 0), block), "trees")
    sizes = trees.groupBy("block").agg(F.sum(8 * F.size("vector") + 64).alias("bytes"))
    last = trees.agg(F.max("block")).first()[0]
    width = sizes.agg(F.max("bytes")).first()[0] or 1
    turn = max(1, at_once // width)
    results = []
    for first in range(0, 0 if last is None else last + 1, turn):
        held = _held(trees.where((F.col("block") >= first) & (F.col("block") < first + turn)).collect())
        open_ = [(d, tree, [[(-np.inf, np.inf, 0)] for _ in tree.ids]) for d, tree, _ in held]
        sent = _sent(spark, open_)
        near = _first(taken.mapInArrow(partial(_walked, sent, True, positives), _FOUND), positives)
        near = written(near, "positives")
        best: dict[int, list] = {}
        for r in near.collect():  # ``positives`` rows an anchor of this turn
            best.setdefault(r["anchor"], []).append((r["rank"], r["score"]))
        windows = [
            (d, tree, [[(_up(low * s), _down(high * s), k) for k, s in best.get(int(a), [])] for a in tree.ids])
            for d, tree, _ in held
        ]
        sent = _sent(spark, windows)
        hard = _first(taken.mapInArrow(partial(_walked, sent, False, negatives), _FOUND), negatives)
        positive = near.select(
            "anchor", F.col("rank").alias("key"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
        )
        found = hard.join(positive, ["anchor", "key"]).select(
            F.col("anchor").alias("anchor_id"),
            "positive_id",
            "rank",
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
        results.append(written(found, "negatives"))
    if not results:
        kinds = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        return spark.createDataFrame([], kinds)
    whole, *others = results
    for other in others:
        whole = whole.unionByName(other)
    return whole


def _sent(spark: SparkSession, trees: list[tuple[int, Tree, list]]) -> Broadcast:
    """Trees as plain arrays: executors need no copy of the library to read them."""
    return spark.sparkContext.broadcast(
        [(d, (t.ids, t.labels, t.vectors, t.parent, t.edge), windows) for d, t, windows in trees]
    )


def _up(hundredths: int) -> int:
    return -(-hundredths // 100)


def _down(hundredths: int) -> int:
    return hundredths // 100
