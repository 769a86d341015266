"""Quality classification by co-training.

Two classifiers see a document from two sides: its text (words, and shares of
signs, capitals and repetitions) and its metadata (source, language, size and
line lengths).  Both are logistic models of hashed features.  In every round each
labels every document of the table that it is sure of for the other to learn from.
Each view is then calibrated on labelled documents kept apart, and the calibrated
views are combined into the score of every document of the table.

Labelled rows are learned from as a bounded sample, ``LABELLED`` documents in the
order of a hash of the id, with all their text.  All other documents take part in
every round: executors score them by both views and count the features of those a
view is sure of, so that only sums, of as many numbers as the views have features,
reach the driver.  A class of pseudo-labelled documents enters the other view as
their mean, which weighs ``PSEUDO`` times what the labelled ones of that class do.
A document is good if it is labelled of quality and not toxic.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.arrays import BLANK, LOWER, U64, SpanHashes, flat, lists, pieces, runs
from quayside.llm.store import written

LABELLED = 6000
ROUNDS, SURE, PSEUDO = 3, 0.95, 0.5
KEPT_FROM = 0.5
#: Standard deviations from the share of good documents at which a feature is used.
TELLING = 3.0

WORD_BUCKETS = 1 << 16
BINS = 16
_SHARES = 7
CONTENT = WORD_BUCKETS + _SHARES * BINS
_SOURCES, _LANGUAGES, _SIZES = 1024, 64, 40
METADATA = _SOURCES + _LANGUAGES + 3 * _SIZES

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SENTENCE = np.zeros(256, bool)
_SENTENCE[[ord(c) for c in ".,;:?'-\"()"]] = True
_SIGN = ~(_LETTER | _DIGIT | BLANK | _SENTENCE)


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return np.diff(total[offsets]).astype(float)


def content_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each text, and how many each has."""
    data, offsets = flat(texts)
    n = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1)
    starts, ends, of = runs(_LETTER[data], offsets)
    words = SpanHashes(LOWER[data])(starts, ends)
    bucket = (words % U64(WORD_BUCKETS)).astype(np.int64)
    count = np.bincount(of, minlength=n)
    own = np.unique(of * WORD_BUCKETS + bucket)
    whose, feature = own // WORD_BUCKETS, own % WORD_BUCKETS
    distinct = np.bincount(whose, minlength=n)
    again = np.zeros(len(of), bool)
    again[1:] = (words[1:] == words[:-1]) & (of[1:] == of[:-1])
    shares = [
        _sums(_SIGN[data], offsets) / size * 4,
        _sums(_UPPER[data], offsets) / np.maximum(_sums(_LETTER[data], offsets), 1),
        _sums(_DIGIT[data], offsets) / size * 4,
        _sums(data == ord("."), offsets) / np.maximum(count, 1),
        distinct / np.maximum(count, 1),
        np.bincount(of[again], minlength=n) / np.maximum(count, 1),
        np.minimum(_sums(_LETTER[data], offsets) / np.maximum(count, 1) / 16, 1),
    ]
    binned = [
        WORD_BUCKETS + k * BINS + np.minimum((share * BINS).astype(np.int64), BINS - 1) for k, share in enumerate(shares)
    ]
    whose = np.concatenate([whose, *[np.arange(n)] * _SHARES])
    feature = np.concatenate([feature, *binned])
    order = np.argsort(whose, kind="stable")
    return feature[order], np.bincount(whose, minlength=n)


def _hashed(values: list, buckets: int) -> np.ndarray:
    known: dict = {}
    for value in values:
        if value not in known:
            known[value] = crc32(str(value).encode()) % buckets
    return np.array([known[v] for v in values], np.int64)


def metadata_features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The same of ``source``, ``lang`` and the sizes of texts and lines; null is a value of its own."""
    data, offsets = flat(batch.column("text"))
    size = np.diff(offsets).astype(float)
    lines = _sums(data == 10, offsets) + 1
    base = _SOURCES + _LANGUAGES
    columns = [
        _hashed(batch.column("source").to_pylist(), _SOURCES),
        _SOURCES + _hashed(batch.column("lang").to_pylist(), _LANGUAGES),
        *(
            base + k * _SIZES + np.minimum(np.log2(x + 1) * 2, _SIZES - 1).astype(np.int64)
            for k, x in enumerate((size, lines, size / lines))
        ),
    ]
    return np.stack(columns, axis=1).ravel(), np.full(batch.num_rows, len(columns), np.int64)


@dataclass
class Rows:
    """Sparse rows of ones."""

    features: np.ndarray
    counts: np.ndarray

    def __post_init__(self):
        self._row = np.repeat(np.arange(len(self.counts)), self.counts)

    def sums(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self._row, weights[self.features], len(self.counts))

    def gradient(self, by_row: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.features, by_row[self._row], size)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Sums:
    """Documents of one pseudo-label: how many, and how many hold each feature."""

    documents: int
    features: np.ndarray


def _told(seen: np.ndarray, ups: np.ndarray, held: np.ndarray, base: float) -> np.ndarray:
    """Each feature's log-odds ratio of good, 0 if it is rare or may be by chance.

    ``seen`` and ``ups`` weigh the documents, and the good ones, that hold it;
    ``held`` counts them.  Scaling features by it (Wang and Manning, 2012) keeps
    thousands of rare words from fitting the sample together while a few telling
    ones go unlearned.
    """
    deviation = np.abs(ups - seen * base) / np.sqrt(seen * base * (1 - base) + 1e-9)
    ratio = np.log((ups + 1) / (seen - ups + 1)) - np.log(base / (1 - base))
    return np.where((held >= 4) & (deviation >= TELLING), ratio, 0.0)


def _logistic(rows: Rows, target: np.ndarray, size: int, pseudo: dict[int, Sums], steps: int = 150) -> np.ndarray:
    """Weights (the last one is the intercept) by Adam on all rows, of the features that tell good from bad.

    The mean of each class of ``pseudo`` is one more row.
    """
    labels = [label for label in (0, 1) if label in pseudo and pseudo[label].documents]
    means = np.array([pseudo[label].features / pseudo[label].documents for label in labels]).reshape(len(labels), size)
    # As the labelled ones of the class, but no more than there are documents.
    weight = np.array([PSEUDO * min((target == label).sum(), pseudo[label].documents) for label in labels])
    seen = rows.gradient(np.ones(len(target)), size) + weight @ means
    ups = rows.gradient(target, size) + (weight * labels) @ means
    held = rows.gradient(np.ones(len(target)), size) + sum((pseudo[label].features for label in labels), np.zeros(size))
    total = max(len(target) + weight.sum(), 1e-9)
    base = float(np.clip((target.sum() + (weight * labels).sum()) / total, 1e-6, 1 - 1e-6))
    scale = _told(seen, ups, held, base)
    parameters, first, second = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        scaled = parameters[:-1] * scale
        error = (_sigmoid(rows.sums(scaled) + parameters[-1]) - target) / total
        error_of_means = (_sigmoid(means @ scaled + parameters[-1]) - labels) * weight / total
        slope = (rows.gradient(error, size) + error_of_means @ means) * scale + 1e-4 * parameters[:-1]
        slope = np.append(slope, error.sum() + error_of_means.sum())
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        rate = 0.1 * (1 - 0.9 * step / steps)
        parameters -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return np.append(parameters[:-1] * scale, parameters[-1])


def _dense_logistic(x: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A few weights and an intercept, by Newton's method with a small prior on them."""
    design = np.column_stack([x, np.ones(len(x))])
    parameters = np.zeros(design.shape[1])
    prior = np.full(len(parameters), 0.1)
    for _ in range(25):
        p = _sigmoid(design @ parameters)
        slope = design.T @ (p - target) + prior * parameters
        curve = (design * (p * (1 - p))[:, None]).T @ design + np.diag(prior)
        parameters = parameters - np.linalg.solve(curve, slope)
    return parameters


@dataclass
class CoTrained:
    """Both views, their calibrations and the combination; without weights every score is ``constant``."""

    content: np.ndarray | None
    metadata: np.ndarray | None
    calibration: list[np.ndarray]
    combined: np.ndarray | None
    constant: float = 1.0

    def scores(self, content: Rows, metadata: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of being good: by content, by metadata, by both."""
        if self.content is None:
            alike = np.full(len(content.counts), self.constant)
            return alike, alike, alike
        views = [
            rows.sums(w[:-1]) + w[-1] for rows, w in ((content, self.content), (metadata, self.metadata))
        ]
        logits = [a * view + b for view, (a, b) in zip(views, self.calibration, strict=True)]
        return (
            _sigmoid(logits[0]),
            _sigmoid(logits[1]),
            _sigmoid(np.column_stack(logits) @ self.combined[:-1] + self.combined[-1]),
        )


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            content, metadata = content_features(piece.column("text")), metadata_features(piece)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("order"),
                    piece.column("good"),
                    lists(content[0].astype(np.int32), content[1], pa.int32()),
                    lists(metadata[0].astype(np.int32), metadata[1], pa.int32()),
                ],
                ["order", "good", "content", "metadata"],
            )


def _rows(column: pa.ChunkedArray, chosen: np.ndarray) -> Rows:
    taken = column.take(pa.array(chosen)).combine_chunks()
    features = taken.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    counts = pa.compute.list_value_length(taken).to_numpy(zero_copy_only=False).astype(np.int64)
    return Rows(features, counts)


def _confident(models: list[np.ndarray], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of the documents that one view is sure of, summed up for the other; feature -1 counts documents."""
    sizes = (CONTENT, METADATA)
    sums = {(view, label): np.zeros(sizes[view] + 1, np.int64) for view in (0, 1) for label in (0, 1)}
    for batch in batches:
        for piece in pieces(batch, "text"):
            views = [Rows(*content_features(piece.column("text"))), Rows(*metadata_features(piece))]
            for view in (0, 1):
                teacher, learner = models[1 - view], views[view]
                good = _sigmoid(views[1 - view].sums(teacher[:-1]) + teacher[-1])
                for label, sure in ((0, good <= 1 - SURE), (1, good >= SURE)):
                    total = sums[view, label]
                    total[:-1] += learner.gradient(sure.astype(float), sizes[view]).astype(np.int64)
                    total[-1] += sure.sum()
    for (view, label), total in sums.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(at), view, np.int32)),
                pa.array(np.full(len(at), label, np.int32)),
                pa.array(np.where(at == sizes[view], -1, at).astype(np.int32)),
                pa.array(total[at]),
            ],
            ["view", "label", "feature", "n"],
        )


def exchange(texts: DataFrame, models: list[np.ndarray]) -> list[dict[int, Sums]]:
    """For each view, the documents of ``texts`` that the other one is sure of, by pseudo-label."""
    found = (
        texts.mapInArrow(partial(_confident, models), "view int, label int, feature int, n bigint")
        .groupBy("view", "label", "feature")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    view, label, feature, n = (found.column(c).to_numpy() for c in ("view", "label", "feature", "n"))
    out = []
    for v, size in enumerate((CONTENT, METADATA)):
        own = {}
        for c in (0, 1):
            of = (view == v) & (label == c)
            features = np.zeros(size)
            features[feature[of & (feature >= 0)]] = n[of & (feature >= 0)]
            own[c] = Sums(int(n[of & (feature < 0)].sum()), features)
        out.append(own)
    return out


def co_train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, rounds: int = ROUNDS) -> CoTrained:
    """Learns from ``docs(doc_id, text, lang, source)`` and ``labels(doc_id, quality, toxic)``.

    A document with several labels is good if all say so; labels with a null are
    not used, those beyond the sample neither.  Of rows that repeat a labelled
    ``doc_id`` the smallest is learned from.  All other rows take part in each
    exchange, also those without a ``doc_id``.  Without labels of both kinds every
    score is the share of good ones (1 without any).
    """
    texts = docs.select(
        F.col("doc_id").cast("bigint"),
        F.col("text").cast("string"),
        F.col("lang").cast("string"),
        F.col("source").cast("string"),
    )
    named = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.min((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int").alias("good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(labelled)
    )
    # At most ``labelled`` ids, so this side may be broadcast.
    named = F.broadcast(written(named, "labelled"))
    sample = (
        texts.join(named, "doc_id")
        .groupBy("doc_id", "good")
        .agg(F.min(F.struct("text", "lang", "source")).alias("row"))
        .select(F.xxhash64("doc_id", F.lit(2)).alias("order"), "good", "row.*")
        .mapInArrow(_sampled, "order bigint, good int, content array<int>, metadata array<int>")
        .toArrow()
    )
    sample = sample.sort_by([("order", "ascending")])
    good = sample.column("good").to_numpy().astype(float)
    apart = np.flatnonzero(np.arange(len(good)) % 5 == 0)
    fitted = np.flatnonzero(np.arange(len(good)) % 5 != 0)
    if any(len(set(good[part].tolist())) < 2 for part in (apart, fitted)):
        return CoTrained(None, None, [], None, float(np.mean(good)) if len(good) else 1.0)
    columns = (sample.column("content"), sample.column("metadata"))
    views = [_rows(c, fitted) for c in columns]
    others = texts.join(named, "doc_id", "left_anti")
    pseudo: list[dict[int, Sums]] = [{}, {}]
    for turn in range(rounds + 1):
        models = [_logistic(v, good[fitted], size, p) for v, size, p in zip(views, (CONTENT, METADATA), pseudo, strict=True)]
        if turn < rounds:
            pseudo = exchange(others, models)
    held = [_rows(c, apart) for c in columns]
    raw = [rows.sums(m[:-1]) + m[-1] for rows, m in zip(held, models, strict=True)]
    calibration = [_dense_logistic(x[:, None], good[apart]) for x in raw]
    logits = np.column_stack([a * x + b for x, (a, b) in zip(raw, calibration, strict=True)])
    return CoTrained(*models, calibration, _dense_logistic(logits, good[apart]))


def _scored(model: CoTrained, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            by_content, by_metadata, score = model.scores(
                Rows(*content_features(piece.column("text"))), Rows(*metadata_features(piece))
            )
            names = [c for c in piece.schema.names if c not in ("text", "lang", "source")]
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(c) for c in names), pa.array(by_content), pa.array(by_metadata), pa.array(score)],
                [*names, "content_score", "metadata_score", "score"],
            )


def score(docs: DataFrame, model: CoTrained) -> DataFrame:
    """``doc_id, content_score, metadata_score, score, kept`` for every row of ``docs``.

    Scores are probabilities of being good; ``kept`` from 0.5 on.  A null text
    counts as empty, null metadata as a value of its own.  Repeated rows give
    equal rows, an empty table none; other columns are not read.
    """
    texts = docs.select(
        F.col("doc_id").cast("bigint"), *(F.col(c).cast("string") for c in ("text", "lang", "source"))
    )
    return texts.mapInArrow(
        partial(_scored, model), "doc_id bigint, content_score double, metadata_score double, score double"
    ).withColumn("kept", F.col("score") >= KEPT_FROM)


def _good(model: CoTrained, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            scores = model.scores(Rows(*content_features(piece.column("text"))), Rows(*metadata_features(piece)))
            yield piece.filter(pa.array(scores[2] >= KEPT_FROM))


def keep_good(docs: DataFrame, model: CoTrained) -> DataFrame:
    """The rows of ``docs`` that ``score`` keeps, with all their columns."""
    return docs.mapInArrow(partial(_good, model), docs.schema)
