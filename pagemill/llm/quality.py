"""Quality classification by co-training a text view and a metadata view.

Two logistic models see the same documents from two sides: hashed words and character
shares of the whole text, and language, source and length. Each starts from the labelled
rows. In every round each one labels the pool documents it is surest of, and those join the
training rows of the other. At the end both are calibrated on labelled rows that neither was
fitted to, and their log-odds add up to the score of every document.

Fitting happens on the driver over bounded samples (``MAX_LABELLED`` and ``MAX_POOL`` rows of
a few hundred numbers); scoring covers every row and whole text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from pagemill.lineage import broadcast_if_small, cut_lineage, scratch
from pagemill.llm.rows import FILE, ROW, add_columns, located, shielded
from pagemill.llm.words import SPACED, utf8, word_blocks

# Rows drawn by hash to fit on: labelled ones, and unlabelled ones that may get pseudo-labels.
MAX_LABELLED, MAX_POOL = 4_000, 4_000
ROUNDS = 5
# Share of the pool that each view labels in a round at most, and how sure it has to be.
PER_ROUND, SURE = 0.05, 0.9
WORD_FEATURES, META_FEATURES = 256, 128
RIDGE = 1.0

_BYTES = np.arange(256)
_CLASSES = np.zeros(256, dtype=np.int64)
_CLASSES[(_BYTES >= 0x61) & (_BYTES <= 0x7A)] = 1
_CLASSES[(_BYTES >= 0x41) & (_BYTES <= 0x5A)] = 2
_CLASSES[(_BYTES >= 0x30) & (_BYTES <= 0x39)] = 3
_CLASSES[_BYTES >= 0x80] = 4
_CLASSES[_BYTES == 0x20] = 5
_CLASSES[(_BYTES >= 0x09) & (_BYTES <= 0x0D)] = 6
_N_CLASSES = 7


def text_features(column: pa.Array) -> np.ndarray:
    """Per text, the shares of hashed words and of character classes, and sizes; zeros if empty."""
    out = np.zeros((len(column), WORD_FEATURES + _N_CLASSES + 3), dtype=np.float32)
    if len(column) == 0:
        return out
    data, offsets = utf8(column)
    for lo, hi, words in word_blocks(column, SPACED):
        docs, counts = hi - lo, words.counts()
        owner = np.repeat(np.arange(docs), counts)
        hashes = words.hashes()
        at = owner * WORD_FEATURES + (hashes >> np.uint64(56)).astype(np.int64)
        hashed = np.bincount(at, minlength=docs * WORD_FEATURES).reshape(docs, WORD_FEATURES)
        out[lo:hi, :WORD_FEATURES] = hashed / np.maximum(1, counts)[:, None]
        sizes = np.diff(offsets[lo : hi + 1])
        at = np.repeat(np.arange(docs), sizes) * _N_CLASSES + _CLASSES[data[offsets[lo] : offsets[hi]]]
        shares = np.bincount(at, minlength=docs * _N_CLASSES).reshape(docs, _N_CLASSES)
        out[lo:hi, WORD_FEATURES : WORD_FEATURES + _N_CLASSES] = shares / np.maximum(1, sizes)[:, None]
        distinct = np.unique(np.stack([owner.astype(np.uint64), hashes]), axis=1)[0] if len(owner) else owner
        different = np.bincount(distinct.astype(np.int64), minlength=docs)
        out[lo:hi, -3] = np.log1p(counts)
        out[lo:hi, -2] = (sizes - shares[:, 5] - shares[:, 6]) / np.maximum(1, counts)
        out[lo:hi, -1] = different / np.maximum(1, counts)
    return out


def meta_features(langs: list, sources: list, lengths: list) -> np.ndarray:
    """Hashed language, source and power of two of the length; a null is a value of its own."""
    out = np.zeros((len(langs), META_FEATURES), dtype=np.float32)
    for i, (lang, source, n) in enumerate(zip(langs, sources, lengths)):
        for name in (f"lang={lang}", f"source={source}", f"size={n if n is None else max(0, int(n)).bit_length()}"):
            out[i, xxhash.xxh64_intdigest(name) % META_FEATURES] = 1
    return out


@dataclass
class View:
    """A logistic model on standardised features, with a Platt calibration of its log-odds."""

    weights: np.ndarray | None = None
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.zeros(0))
    slope: float = 1.0
    offset: float = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        self.mean, deviation = x.mean(axis=0), x.std(axis=0)
        self.scale = np.where(deviation > 1e-9, 1 / np.maximum(deviation, 1e-9), 0)
        inputs = self._inputs(x)
        penalty = np.full(inputs.shape[1], RIDGE)
        penalty[-1] = 1e-6  # the constant is free
        self.weights = newton(inputs, y, penalty, np.zeros(inputs.shape[1]))

    def _inputs(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([(x - self.mean) * self.scale, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self._inputs(x.astype(np.float64)) @ self.weights

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Few rows leave the log-odds about as they are."""
        raw = self.raw(x)
        start = np.array([1.0, 0.0])
        self.slope, self.offset = newton(np.stack([raw, np.ones(len(raw))], axis=1), y, np.ones(2), start).tolist()

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return self.slope * self.raw(x) + self.offset


def newton(x: np.ndarray, y: np.ndarray, penalty: np.ndarray, center: np.ndarray, steps: int = 25) -> np.ndarray:
    """Logistic regression, with a quadratic penalty on what departs from ``center``.

    Each step is halved until the loss falls, since a full one may overshoot.
    """

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - y * z).sum() + 0.5 * (penalty * (w - center) ** 2).sum())

    w, now = center.copy(), loss(center)
    for _ in range(steps):
        p = sigmoid(x @ w)
        curve = x.T @ (x * np.maximum(p * (1 - p), 1e-6)[:, None]) + np.diag(penalty)
        move = np.linalg.solve(curve, x.T @ (p - y) + penalty * (w - center))
        while np.abs(move).max() > 1e-9 and loss(w - move) > now:
            move /= 2
        if np.abs(move).max() <= 1e-9:
            break
        w, before = w - move, now
        now = loss(w)
        if before - now <= 1e-6 * before:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


@dataclass
class Model:
    views: tuple[View, View] | None
    prior: float

    def scores(self, features: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
        """Both calibrated views, and their combination under independence given the class."""
        if self.views is None:
            return [np.full(len(features[0]), self.prior)] * 3
        odds = [view.log_odds(x) for view, x in zip(self.views, features)]
        prior = np.log(self.prior / (1 - self.prior))
        return [sigmoid(odds[0]), sigmoid(odds[1]), sigmoid(odds[0] + odds[1] - prior)]


def co_train(
    labelled: tuple[np.ndarray, np.ndarray], y: np.ndarray, pool: tuple[np.ndarray, np.ndarray], rounds: int = ROUNDS
) -> Model:
    """A model from features of labelled rows and of the pool, a matrix per view.

    Every fifth labelled row is kept for calibration. Without rows of both classes on either
    side of that split, the model is the share of good rows (a half without any).
    """
    share = float(y.mean()) if len(y) else 0.5
    for_calibration = np.arange(len(y)) % 5 == 4
    fit, check = ~for_calibration, for_calibration
    if not (0 < y[fit].sum() < fit.sum() and 0 < y[check].sum() < check.sum()):
        return Model(None, share)
    prior = float(y[fit].mean())
    views = (View(), View())
    rows = [[x[fit]] for x in labelled]
    answers = [[y[fit]], [y[fit]]]
    free = np.arange(len(pool[0]))
    # A view is sure of a document by its odds as well as by what it adds to the prior's: one
    # that tells little has nothing to teach.
    odds, before = np.log(SURE / (1 - SURE)), np.log(prior / (1 - prior))
    high, low = max(odds, odds + before), min(-odds, -odds + before)
    for turn in range(rounds + 1):
        for k, view in enumerate(views):
            view.fit(np.vstack(rows[k]).astype(np.float64), np.concatenate(answers[k]))
            view.calibrate(labelled[k][check], y[check])
        if turn == rounds or not len(free):
            break
        taken = np.zeros(len(free), dtype=bool)
        for k, view in enumerate(views):
            told = view.log_odds(pool[k][free])
            n = max(1, int(PER_ROUND * len(pool[0])))
            good = np.argsort(-told, kind="stable")[: max(1, round(n * prior))]
            bad = np.argsort(told, kind="stable")[: max(1, round(n * (1 - prior)))]
            chosen = np.concatenate([good[told[good] >= high], bad[told[bad] <= low]])
            rows[1 - k].append(pool[1 - k][free[chosen]])
            answers[1 - k].append((told[chosen] > 0).astype(np.float64))
            taken[chosen] = True
        free = free[~taken]
    return Model(views, prior)


def sampled(rows: DataFrame, ids: DataFrame, n: int) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Features and ``quality`` of the ``n`` rows of ``ids`` (locator, ``doc_id, quality``)
    with the smallest hashes."""
    drawn = ids.orderBy(F.xxhash64("doc_id", ROW), "doc_id", FILE, ROW).limit(n).select(FILE, ROW, "quality")
    # At most n rows.
    few = rows.select("doc_id", "text", "lang", "source", "n_chars", FILE, ROW).join(F.broadcast(cut_lineage(drawn)), [FILE, ROW])

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        text, meta = batch_features(batch)
        return [pa.array(list(text), pa.list_(pa.float32())), pa.array(list(meta), pa.list_(pa.float32()))]

    fields = [T.StructField(c, T.ArrayType(T.FloatType())) for c in ("_x0", "_x1")]
    found = add_columns(few, fields, compute, ("text", "lang", "source", "n_chars"))
    found = found.orderBy(F.xxhash64("doc_id", ROW), "doc_id", FILE, ROW).toArrow()
    widths = (WORD_FEATURES + _N_CLASSES + 3, META_FEATURES)
    x = tuple(
        np.array(found.column(c).to_pylist(), dtype=np.float32).reshape(found.num_rows, width)
        for c, width in zip(("_x0", "_x1"), widths)
    )
    return x, np.array(found.column("quality").to_pylist(), dtype=np.float64)


def batch_features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    meta = meta_features(*(batch.column(c).to_pylist() for c in ("lang", "source", "n_chars")))
    return text_features(batch.column("text")), meta


def train(rows: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, max_pool: int = MAX_POOL) -> Model:
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        # Labels that disagree go by the majority, a tie counts as good.
        F.when(F.avg("quality") >= 0.5, 1.0).otherwise(0.0).alias("quality")
    )
    known, _ = broadcast_if_small(cut_lineage(known))
    ids = rows.select("doc_id", FILE, ROW)
    labelled, y = sampled(rows, ids.join(known, "doc_id"), max_labelled)
    others = ids.join(known, "doc_id", "left_anti").withColumn("quality", F.lit(0.5))
    pool, _ = sampled(rows, others, max_pool)
    return co_train(labelled, y, pool)


@shielded("doc_id", "text", "lang", "source", "n_chars")
def classify(docs: DataFrame, labels: DataFrame, drop: tuple = ()) -> DataFrame:
    """``docs`` with ``text_score, meta_score, quality_score, good``.

    Scores are probabilities of good quality; ``good`` is a ``quality_score`` of a half or
    more. Labels of unknown documents and null labels are passed over; a null text counts as
    empty; null metadata are values of their own; repeated rows are scored alike. Without
    labels of both classes every score is the share of good labels (a half without any). An
    empty table stays empty; columns of ``docs`` named like the added ones are replaced.
    """
    names = ["text_score", "meta_score", "quality_score"]
    rows = located(docs)
    with scratch(docs.sparkSession):
        model = train(rows, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array(s, pa.float64()) for s in shared.value.scores(batch_features(batch))]

    scored = add_columns(rows.drop(FILE, ROW), [T.StructField(n, T.DoubleType()) for n in names], compute, drop)
    return scored.withColumn("good", F.col("quality_score") >= 0.5)
