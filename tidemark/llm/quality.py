"""Quality by compression: which of two dictionaries, built from good or from bad text, makes a text shorter.

For dictionaries of several sizes, ``(bytes with the bad one - bytes with the good one) / bytes of the text`` is
measured, and the share that remains without a dictionary. A logistic curve, fitted on labelled documents that did not go into the
dictionaries, turns these into a score.

Learning is bounded: about ``PER_CLASS`` documents of each label, chosen by a hash of the id; a first half makes
the dictionaries, the other half fits the curve. Scoring is one map over the table.

Defined cases: a null text is an empty one; an empty text has sizes 0 and gets the curve's value there; if a label is
missing, every score is the labels' smoothed share of ones (0.5 without labels); labels of null quality, and of a
document with different labels, are left out; rows that repeat are scored row by row.
"""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import map_slices, stash, texts

PER_CLASS = 1500
SIZES = (16 << 10, 64 << 10)
LEVEL = 3
CUT = 0.7


def dictionary(size: int, samples: list[bytes]) -> bytes:
    """A trained dictionary; where there is too little text to train one, the end of the text itself."""
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


class Sizer:
    """Compressed sizes of a text under each dictionary."""

    def __init__(self, pairs: list[tuple[bytes, bytes]]):
        bare = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.plain = zstandard.ZstdCompressor(level=LEVEL, **bare)
        self.pairs = [[zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), **bare) if d else self.plain
                       for d in pair] for pair in pairs]

    def features(self, data: bytes) -> list[float]:
        size = max(1, len(data))
        left = [(len(bad.compress(data)) - len(good.compress(data))) / size if data else 0.0 for bad, good in self.pairs]
        return [*left, len(self.plain.compress(data)) / size if data else 0.0]


def _widened(features: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((features - mean) / scale, -6, 6)
    n = z.shape[1]
    cross = [z[:, i] * z[:, j] for i in range(n) for j in range(i, n)]
    return np.column_stack([np.ones(len(z)), z, *cross])


def fit_curve(features: np.ndarray, labels: np.ndarray, penalty: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression by Newton's method: weights, and the features' mean and scale."""
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-9
    x, w = _widened(features, mean, scale), None
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        ridge = np.full(len(w), penalty)
        ridge[0] = 1e-6
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (p - labels) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w, mean, scale


class Model:
    """Dictionaries and curve, or a constant score."""

    def __init__(self, samples: list[tuple[int, bool, bytes]]):
        """``samples``: label, whether it makes the dictionaries (else it fits the curve), text."""
        texts = {(q, first): [t for label, f, t in samples if label == q and f == first] for q in (0, 1) for first in (True, False)}
        ones = sum(label for label, _, _ in samples)
        self.constant = (ones + 1) / (len(samples) + 2) if not all(texts.values()) else None
        self.pairs, self.curve = [], None
        if self.constant is None:
            self.pairs = [(dictionary(size, texts[0, True]), dictionary(size, texts[1, True])) for size in SIZES]
            sizer = Sizer(self.pairs)
            fitting = [(q, sizer.features(t)) for q in (0, 1) for t in texts[q, False]]
            self.curve = fit_curve(np.array([f for _, f in fitting]), np.array([q for q, _ in fitting], float))

    def scores(self, features: np.ndarray) -> np.ndarray:
        weights, mean, scale = self.curve
        sums = _widened(features, mean, scale) @ weights  # whose last digits depend on the rows beside it
        return np.round(1 / (1 + np.exp(-np.clip(sums, -30, 30))), 9)


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """``labels`` (``doc_id, quality``) holds only rows that may be learned from."""
    sure = (labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id")
            .agg(F.min("quality").cast("int").alias("quality"), F.max("quality").alias("other")).where("quality = other").drop("other"))
    sizes = dict(sure.groupBy("quality").count().collect())
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 20))
    most = F.when(F.col("quality") == 1, F.lit(min(1.0, per_class / max(1, sizes.get(1, 0))))).otherwise(
        F.lit(min(1.0, per_class / max(1, sizes.get(0, 0)))))
    chosen = stash(sure.where(drawn < most * (1 << 20)).withColumn("first", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == 0),
                   "quality-sample")
    rows = docs.select("doc_id", "text").where("text IS NOT NULL").join(chosen, "doc_id").orderBy("doc_id", "text")
    shown = {0: 1.0, 1: 1.0}
    total = sum(sizes.values())
    if total:  # classes are drawn at different rates; the curve is fitted at the labels' own rate
        shown = {q: sizes.get(q, 0) for q in (0, 1)}
    model = Model([(r.quality, r.first, r.text.encode()) for r in rows.collect()])
    if model.curve is not None:
        drawn_share = {q: min(sizes[q], per_class) for q in (0, 1)}
        shift = np.log(shown[1] / shown[0]) - np.log(drawn_share[1] / drawn_share[0])
        model.curve[0][0] += shift
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, predicted``."""
    if model.constant is not None:
        value = float(model.constant)
        return docs.select("doc_id", F.lit(value).alias("score"), F.lit(int(value >= CUT)).alias("predicted"))
    pairs, kind = model.pairs, docs.schema["doc_id"].dataType.simpleString()
    sizers: list[Sizer] = []

    def of(piece):
        if not sizers:
            sizers.append(Sizer(pairs))
        scores = model.scores(np.array([sizers[0].features((t or "").encode()) for t in texts(piece)]))
        return [piece.column("doc_id"), scores, (scores >= CUT).astype(np.int32)]

    return map_slices(docs.select("doc_id", "text"), f"doc_id {kind}, score double, predicted int", of)
