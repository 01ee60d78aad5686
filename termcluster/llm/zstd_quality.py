"""Quality classifier by compression with zstandard dictionaries.

Two dictionaries are trained, on good and on bad labelled texts. A text is
compressed with both; the difference of the compressed sizes, normalised by
their sum and by the text's length, and the compressed share of the length, go
through a logistic calibration (with squares), which is fitted on labelled texts
that no dictionary has seen and corrected to the shares of the labels.

Training: of the labelled documents the ``PER_CLASS`` of each class with the
smallest hash of their id are drawn (a bounded sample; their texts, at most
``SAMPLE_BYTES`` a class, come to the driver; a longer text that does not fit is
left out of training). The first half trains the dictionary, the rest the
calibration. Ids, languages, sources and labels are no inputs of a score.

Scale: scoring is one pass without a shuffle. Model: two dictionaries of
``DICT_BYTES`` and some numbers.

Defined cases: a null or empty text is scored like any other, with differences
of zero; a document without a label, or with several, counts in training not at
all, or with its smallest label; without both classes of labels every score is
the share of good labels (one half without any). Extra columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termcluster.llm.shared import batch, id_and_text
from termcluster.llm.training_sample import labelled_sample

PER_CLASS = 1500
SAMPLE_BYTES = 24 << 20
DICT_BYTES = 16 << 10
LEVEL = 3
PENALTY = 1e-2


def dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; too few texts to train one serve as raw content."""
    texts = [t for t in texts if t]
    try:
        return zstandard.train_dictionary(DICT_BYTES, texts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(texts)[:DICT_BYTES]


class Compressors:
    def __init__(self, good: bytes, bad: bytes):
        self.good, self.bad = (self.one(d) for d in (good, bad))

    @staticmethod
    def one(data: bytes) -> zstandard.ZstdCompressor:
        known = zstandard.ZstdCompressionDict(data) if data else None
        if known:
            known.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(dict_data=known, level=LEVEL, write_content_size=False)
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)

    def features(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros((len(texts), 3))
        for i, t in enumerate(texts):
            if t:
                good, bad = len(self.good.compress(t)), len(self.bad.compress(t))
                out[i] = (bad - good) / (bad + good), (bad - good) / len(t), good / len(t)
        return out


@dataclass
class Model:
    good: bytes
    bad: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of the features, their squares, and one

    def inputs(self, features: np.ndarray) -> np.ndarray:
        z = (features - self.mean) / self.scale
        return np.column_stack([z, z * z, np.ones(len(z))])

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.inputs(features) @ self.weights, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float) -> np.ndarray:
    """Weights of the largest penalised likelihood: Newton steps, halved until the
    likelihood rises by a share of what the slope promises. It is strictly concave, so
    this ends at its one maximum; a run that doesn't is an error."""
    def likelihood(w: np.ndarray) -> float:
        z = x @ w
        return float(y @ z - np.logaddexp(0, z).sum() - penalty / 2 * (w @ w))

    w = np.zeros(x.shape[1])
    reached = likelihood(w)
    for _ in range(500):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        gradient = x.T @ (y - p) - penalty * w
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty * np.eye(len(w)), gradient)
        promised, size = float(gradient @ step), 1.0
        if promised <= 1e-10 * max(1.0, abs(reached)):
            return w
        while (now := likelihood(w + size * step)) < reached + 1e-4 * size * promised and size > 1e-9:
            size /= 2
        if now <= reached:
            return w  # what is left to gain is below the precision of doubles
        w, reached = w + size * step, now
    raise RuntimeError("the fit of the score doesn't converge")


def train(good: list[bytes], bad: list[bytes], good_share: float) -> Model:
    constant = Model(b"", b"", np.zeros(3), np.ones(3), np.append(np.zeros(6), np.log((good_share + 1e-9) / (1 - good_share + 1e-9))))
    if len(good) < 2 or len(bad) < 2:
        return constant
    (g1, g2), (b1, b2) = ((t[:len(t) // 2], t[len(t) // 2:]) for t in (good, bad))
    model = Model(dictionary(g1), dictionary(b1), constant.mean, constant.scale, constant.weights)
    features = Compressors(model.good, model.bad).features(g2 + b2)
    y = np.append(np.ones(len(g2)), np.zeros(len(b2)))
    model.mean, model.scale = features.mean(0), features.std(0) + 1e-9
    w = logistic(model.inputs(features), y, PENALTY)
    # the sample holds as many of either class; the corpus does not
    w[-1] += np.log(good_share / (1 - good_share)) - np.log(len(g2) / len(b2))
    model.weights = w
    return model


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_class: int = PER_CLASS) -> Model:
    """Model from the labelled documents outside the held-out fold."""
    texts, share = labelled_sample(docs, labels, id_col, text_col, label_col, per_class, SAMPLE_BYTES)
    bad, good = ([t.encode() for _, t in texts[y]] for y in (0, 1))
    return train(good, bad, share)


def score_rows(model):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        compressors = Compressors(m.good, m.bad)
        for b in batches:
            texts = [x.as_buffer().to_pybytes() if x.is_valid else b"" for x in b.column("txt").cast(pa.large_binary())]
            yield batch(id=b.column("id"), score=m.score(compressors.features(texts)))
    return rows


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, score (probability of the good label),
    predicted (1 from one half on)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    scored = id_and_text(docs, id_col, text_col).mapInArrow(score_rows(sent), "id long, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
