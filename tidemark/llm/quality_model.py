"""Quality of texts, learned from trusted positives and unlabelled text.

Positive-unlabelled learning: a linear model minimises the non-negative unbiased
risk, in which the risk on negatives is that on all unlabelled texts less the
share of positives among them, and never less than zero.  The share (class
prior) is estimated: a first model separates positives from unlabelled texts, and
the prior is the least ratio, over all thresholds that enough positives pass, of
the unlabelled and the positive texts above the threshold.

The trusted positives are a bounded sample (``Sample``), the first labelled rows in
the order of a hash of id and text.  The class prior and the risk on unlabelled texts
are those of all rows outside the held-out ones: the prior counts every row's score
against the thresholds, and ``passes`` times the risk and its gradient are summed over
every row.  A sample of unlabelled texts only says where to begin and how the risk
curves: between two passes the driver minimises the sample's risk, corrected so that
value and gradient are those of all rows where it starts.  Where this comes to rest
the gradient over all rows is zero, whatever the sample.  Sums are of whole numbers,
so that they do not depend on the order of rows; a number per feature and task is
shuffled.  Scoring reads every whole text.

Null texts count as empty and get a score like any other text.  Labels of null
ids, and null labels, are not used; a repeated label counts once per row, a repeated
row as often as it stands among the unlabelled.  Rows are scored by themselves, so repeated rows give repeated scores.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASHED = 2048
SHAPE = 4 * 64
N_FEATURES = HASHED + SHAPE + 1
_MIX = np.uint32(2654435761)
#: Sums over all rows are of whole numbers: slopes and features in these parts of one.
_SLOPE = 1 << 16
_FEATURE = 1 << 12
_CHUNK = 256


@dataclass(frozen=True)
class Sample:
    """Bounds of what reaches the driver, and how often all rows are read to correct it."""

    positives: int = 2000
    unlabelled: int = 4000
    passes: int = 2


def features(text: str) -> np.ndarray:
    """Roots of the shares of hashed byte pairs, and buckets of how much the text repeats itself."""
    data = text.encode()
    x = np.zeros(N_FEATURES, np.float32)
    x[-1] = 1
    if len(data) > 1:
        b = np.frombuffer(data, np.uint8).astype(np.uint32)
        pairs = ((b[:-1] << 8 | b[1:]) * _MIX) >> np.uint32(21)
        x[:HASHED] = np.sqrt(np.bincount(pairs, minlength=HASHED) / (len(data) - 1))
    words = data.split()
    n = len(words)
    length = min(7, n.bit_length() // 2)
    sentences = data.split(b". ")
    lines = [line for line in data.split(b"\n") if line.strip()]
    shares = (
        len(set(words)) / max(n, 1),
        len(set(sentences)) / max(len(sentences), 1),
        len(set(lines)) / max(len(lines), 1),
        sum(map(len, words)) / max(n, 1) / 20,
    )
    for i, share in enumerate(shares):
        x[HASHED + 64 * i + 8 * length + min(7, int(share * 8))] = 0.3
    return x


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class _Adam:
    def __init__(self, size: int, rate: float):
        self.w, self.m, self.v = (np.zeros(size, np.float32) for _ in range(3))
        self.rate, self.t = rate, 0

    def step(self, gradient: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (gradient - self.m)
        self.v += 0.001 * (gradient**2 - self.v)
        scale = np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8
        self.w -= (self.rate * self.m / (1 - 0.9**self.t) / scale).astype(np.float32)


Above = Callable[[list[np.ndarray], np.ndarray], np.ndarray]


def class_prior(
    positive: np.ndarray,
    unlabelled: np.ndarray,
    p_half: np.ndarray | None = None,
    u_half: np.ndarray | None = None,
    above: Above | None = None,
    least: float = 0.1,
) -> float:
    """Share of positives among the unlabelled texts.

    Models fitted on one half of the sample rank the other half; the prior is the
    least ratio of the shares above a threshold that at least ``least`` of the
    positives pass.  ``above`` gives, for the two models and the thresholds, how many
    unlabelled texts there are and how many pass each; without it they are the sample's.
    """
    p_half = np.arange(len(positive)) % 2 if p_half is None else p_half
    u_half = np.arange(len(unlabelled)) % 2 if u_half is None else u_half
    models = []
    for half in (0, 1):
        p, u = positive[p_half == half], unlabelled[u_half == half]
        if not len(p) or not len(u):
            return 0.5
        model = _Adam(positive.shape[1], 0.05)
        for _ in range(80):
            gradient = -p.T @ (1 - _sigmoid(p @ model.w)) / len(p) + u.T @ _sigmoid(u @ model.w) / len(u)
            model.step(gradient + 1e-3 * model.w)
        models.append(model.w)
    p_scores = np.where(p_half == 0, positive @ models[1], positive @ models[0])
    thresholds = np.quantile(p_scores, np.linspace(0, 1 - least, 40))
    above_p = np.array([(p_scores >= t).mean() for t in thresholds])
    if above is None:
        u_scores = np.where(u_half == 0, unlabelled @ models[1], unlabelled @ models[0])
        passed = np.array([len(u_scores), *((u_scores >= t).sum() for t in thresholds)])
    else:
        passed = above(models, thresholds)
    above_u = passed[1:] / passed[0]
    # Upper bounds of the ratio, so that a small sample does not push the least one down.
    slack = np.sqrt(1 / (2 * passed[0])) + np.sqrt(1 / (2 * len(p_scores)))
    best = int(np.argmin((above_u + slack) / np.maximum(above_p, 1e-9)))
    return float(np.clip(above_u[best] / above_p[best], 0.05, 0.99))


def risk(x: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean sigmoid loss of the texts as negatives, and its gradient."""
    s = _sigmoid(x @ w)
    # loss(z, +1) = sigmoid(-z), loss(z, -1) = sigmoid(z); both have slope -+ s (1 - s)
    return float(s.mean()), x.T @ (s * (1 - s)) / len(x)


def fit(
    positive: np.ndarray,
    unlabelled: np.ndarray,
    prior: float,
    rounds: int = 300,
    start: np.ndarray | None = None,
    everywhere: tuple[float, np.ndarray] | None = None,
) -> np.ndarray:
    """Weights that minimise the non-negative risk with the sigmoid loss.

    ``everywhere`` is the risk on all unlabelled texts at ``start``; that of the sample
    is corrected to it.
    """
    model = _Adam(positive.shape[1], 0.05 if start is None else 0.01)
    more, slope = 0.0, np.zeros(positive.shape[1])
    if start is not None:
        model.w = start.astype(np.float32)
    if everywhere is not None:
        value, gradient = risk(unlabelled, model.w)
        more, slope = everywhere[0] - value, everywhere[1] - gradient
    origin = model.w.copy()
    for _ in range(rounds):
        on_positive, on_p = risk(positive, model.w)
        on_unlabelled, on_u = risk(unlabelled, model.w)
        on_unlabelled += more + float(slope @ (model.w - origin))
        on_u = on_u + slope
        if on_unlabelled - prior * on_positive >= 0:
            gradient = -prior * on_p + on_u - prior * on_p
        else:
            gradient = prior * on_p - on_u
        model.step(gradient + 1e-4 * model.w)
    return model.w


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def _vectors(docs: DataFrame, text_col: str, n: int, id_col: str, among: DataFrame | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Halves and feature vectors of the first ``n`` different rows in the order of a hash, of the ids in ``among``."""
    keyed = docs.select(F.col(id_col), F.col(text_col), F.xxhash64(id_col, text_col).alias("_key"))
    # The rows are chosen by their keys alone; at most n keys are broadcast, and one text of each goes on.
    keys = keyed.select(id_col, "_key")
    if among is not None:
        keys = keys.join(among, id_col, "left_semi")
    chosen = keys.select("_key").distinct().orderBy("_key").limit(n)
    rows = keyed.join(F.broadcast(chosen), "_key", "left_semi")
    first = rows.groupBy("_key").agg(F.first(text_col).alias(text_col)).select("_key", text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(text or "").tobytes() for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["key", "x"])

    rows = sorted(first.mapInArrow(run, "key long, x binary").collect())
    vectors = np.frombuffer(b"".join(bytes(row.x) for row in rows), np.float32).reshape(len(rows), N_FEATURES)
    return np.array([row.key & 1 for row in rows], np.int64), vectors


def _sums(docs: DataFrame, id_col: str, text_col: str, size: int, of: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Sums over all rows of the ``size`` whole numbers that ``of`` gives for halves and vectors of some rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, _CHUNK):
                some = batch.slice(start, _CHUNK)
                x = np.stack([features(text or "") for text in some.column(1).to_pylist()])
                total += of(some.column(0).to_numpy(), x).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total)], ["at", "n"])

    halves = docs.select(F.xxhash64(id_col, text_col).bitwiseAND(F.lit(1)).alias("half"), F.col(text_col))
    rows = halves.mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(size, np.int64)
    for row in rows:
        out[row["at"]] = row["n"]
    return out


def passing(docs: DataFrame, models: list[np.ndarray], thresholds: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Number of rows, and of those that reach each threshold by the model of the other half."""

    def of(halves: np.ndarray, x: np.ndarray) -> np.ndarray:
        scores = np.array([row @ models[1 - half] for half, row in zip(halves, x)])
        return np.array([len(x), *((scores >= t).sum() for t in thresholds)])

    return _sums(docs, id_col, text_col, 1 + len(thresholds), of)


def risk_everywhere(docs: DataFrame, w: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> tuple[float, np.ndarray]:
    """``risk`` over all rows."""

    def of(_: np.ndarray, x: np.ndarray) -> np.ndarray:
        s = _sigmoid(np.array([row @ w for row in x], np.float64))
        # Whole numbers far below 2 ** 53: their products and sums are exact.
        slopes = np.rint(s * (1 - s) * _SLOPE)
        on_x = slopes @ np.rint(x.astype(np.float64) * _FEATURE)
        return np.concatenate([[len(x), np.rint(s * _SLOPE).sum()], on_x])

    n, value, *gradient = _sums(docs, id_col, text_col, 2 + len(w), of)
    return value / _SLOPE / n, np.array(gradient) / _SLOPE / _FEATURE / n


def train(
    docs: DataFrame, labels: DataFrame, sample: Sample = Sample(), id_col: str = "doc_id", text_col: str = "text"
) -> tuple[np.ndarray, float]:
    """Weights and class prior, from positive labels outside the held-out rows and from all unlabelled texts."""
    trusted = labels.where((F.col("quality") == 1) & ~held_out(id_col)).select(F.col(id_col)).distinct()
    learned = docs.where(~held_out(id_col))
    p_half, positive = _vectors(learned, text_col, sample.positives, id_col, trusted)
    u_half, unlabelled = _vectors(learned, text_col, sample.unlabelled, id_col)
    if not len(positive) or not len(unlabelled):
        # Nothing to learn from: every text scores one half.
        return np.zeros(N_FEATURES, np.float32), 0.5

    def above(models: list[np.ndarray], thresholds: np.ndarray) -> np.ndarray:
        return passing(learned, models, thresholds, id_col, text_col)

    prior = class_prior(positive, unlabelled, p_half, u_half, above)
    weights = fit(positive, unlabelled, prior)
    for _ in range(sample.passes):
        everywhere = risk_everywhere(learned, weights, id_col, text_col)
        weights = fit(positive, unlabelled, prior, 100, weights, everywhere)
    return weights.astype(np.float32), prior


def score_quality(
    docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text", keep_cols: tuple[str, ...] = ()
) -> DataFrame:
    """Id, ``held_out``, ``score`` and ``predicted`` of every text; ``keep_cols`` are handed through."""
    schema = T.StructType(
        [
            docs.schema[id_col],
            T.StructField("held_out", T.BooleanType()),
            T.StructField("score", T.DoubleType()),
            *(docs.schema[name] for name in keep_cols),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = np.array([features(text or "") @ weights for text in batch.column(2).to_pylist()], np.float64)
            kept = batch.columns[3:]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(_sigmoid(z)), *kept], schema.names)

    given = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), F.col(text_col), *map(F.col, keep_cols))
    return given.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
