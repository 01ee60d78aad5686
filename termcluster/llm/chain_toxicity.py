"""Toxicity by a classifier chain of linear models.

Labels give one category, ``toxic``. The chain predicts three categories, each
contained in the one before:

    marked   the text holds words that are much more frequent in toxic labelled texts
    dense    such words are a larger part of the text than in half of the marked toxic texts
    toxic    the label

(the first two are derived from the training labels by word statistics). Each
link is a logistic model over the words and word pairs that tell most about the
label, with the probabilities of all earlier links as further inputs. In training those
probabilities are out of fold: every training text gets them from models that
have not seen it, so a later link learns how far an earlier one can be trusted.

Training: of the labelled documents the ``PER_CLASS`` of each class with the
smallest hash of their id (a bounded sample; at most ``SAMPLE_BYTES`` of text a
class) come to the driver. The fold of ids with crc32 modulo 3 = 1 is left out,
so that held-out accuracy can be measured. Ids, languages and sources are no
inputs.

Scale: scoring is one pass without a shuffle over whole texts; a model is at
most ``FEATURES`` hashes and weights for each link.

Defined cases: null or empty texts have no words and get the scores of the bare
intercepts; null or contradicting labels count as in ``zstd_quality``; without
both classes every score is the share of toxic labels (0 without any). Extra
columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from termcluster.llm.shared import batch, id_and_text
from termcluster.llm.textarrays import BASE_ONE, LETTER_WORD, U, mix, prefix_sums, range_hash, text_slices, words
from termcluster.llm.training_sample import labelled_sample

CATEGORIES = ("marked", "dense", "toxic")
PER_CLASS = 3000
SAMPLE_BYTES = 24 << 20
FEATURES = 2000
FOLDS = 5
STEPS, RATE, PENALTY = 150, 0.3, 1e-4
MARKER_TEXTS, MARKER_RATIO, LEAST_GAIN = 5, 8.0, 7.0


def hashed(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text: the hashes of its distinct words and word pairs, and those
    of its words in order."""
    out = []
    for texts in text_slices(column):
        w = words(texts, LETTER_WORD, lower=True)
        sums = prefix_sums(w.hash, BASE_ONE)
        at = np.arange(max(len(w.hash) - 1, 0))
        pair = mix(range_hash(sums, at, at + 2, BASE_ONE))
        for i in range(len(texts)):
            a, b = w.bounds[i], w.bounds[i + 1]
            out.append((np.unique(np.concatenate([w.hash[a:b], pair[a:max(a, b - 1)]])), w.hash[a:b]))
    return out


def telling(hashes: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """The FEATURES words and pairs whose presence tells most about the label,
    by the likelihood ratio; sorted."""
    if not hashes:
        return np.zeros(0, U)
    # two sorted copies at most, rather than the places of all words in value
    value, with_all = np.unique(np.concatenate(hashes), return_counts=True)
    some, times = np.unique(np.concatenate([h for h, y in zip(hashes, toxic, strict=True) if y] or [np.zeros(0, U)]), return_counts=True)
    with_1 = np.zeros(len(value))
    with_1[np.searchsorted(value, some)] = times
    n, n_1 = len(hashes), toxic.sum()
    gain = np.zeros(len(value))
    for seen, rows, base in ((with_1, with_all, n_1), (with_all - with_1, with_all, n - n_1), (n_1 - with_1, n - with_all, n_1), (n - n_1 - with_all + with_1, n - with_all, n - n_1)):
        expected = rows * base / n
        gain += np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0)
    gain[(with_all < MARKER_TEXTS) | (gain < LEAST_GAIN)] = 0
    best = np.argsort(-gain, kind="stable")[:FEATURES]
    return np.sort(value[best[gain[best] > 0]])


class Rows:
    """Texts as sparse rows over the chosen features (present or not)."""

    def __init__(self, hashes: list[np.ndarray], features: np.ndarray):
        size = np.array([len(h) for h in hashes], np.int64)
        flat = np.concatenate(hashes) if hashes else np.zeros(0, U)
        at = np.minimum(np.searchsorted(features, flat), max(len(features) - 1, 0))
        known = features[at] == flat if len(features) else np.zeros(len(flat), bool)
        self.n, self.width = len(hashes), len(features)
        self.flat, self.row = at[known], np.repeat(np.arange(self.n), size)[known]

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.flat], self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.flat, g[self.row], self.width)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


@dataclass
class Link:
    """One linear model: weights of the buckets, of earlier links, intercept."""

    weights: np.ndarray
    earlier: np.ndarray
    intercept: float

    def score(self, rows: Rows, before: np.ndarray) -> np.ndarray:
        return sigmoid(rows.dot(self.weights) + before @ self.earlier + self.intercept)


def fit_link(rows: Rows, before: np.ndarray, y: np.ndarray) -> Link:
    """Logistic regression by full gradient steps scaled per coordinate."""
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3) if len(y) else 0.5
    w, e, c = np.zeros(rows.width), np.zeros(before.shape[1]), float(np.log(share / (1 - share)))
    gw, ge, gc = np.full(rows.width, 1e-8), np.full(before.shape[1], 1e-8), 1e-8
    for _ in range(STEPS):
        g = (sigmoid(rows.dot(w) + before @ e + c) - y) / max(len(y), 1)
        dw, de, dc = rows.back(g) + PENALTY * w, before.T @ g + PENALTY * e, g.sum()
        gw, ge, gc = gw + dw * dw, ge + de * de, gc + dc * dc
        w, e, c = w - RATE * dw / np.sqrt(gw), e - RATE * de / np.sqrt(ge), c - RATE * dc / np.sqrt(gc)
    return Link(w, e, float(c))


def derived(words_of: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Columns marked, dense, toxic from the training texts."""
    seen = [np.unique(w) for w in words_of]
    of = [np.unique(np.concatenate([s for s, t in zip(seen, toxic, strict=True) if t == k] or [np.zeros(0, U)]), return_counts=True) for k in (0, 1)]
    (clean, clean_n), (bad, bad_n) = of
    at = np.minimum(np.searchsorted(clean, bad), max(len(clean) - 1, 0))
    other = np.where(clean[at] == bad, clean_n[at], 0) if len(clean) else np.zeros(len(bad), np.int64)
    ratio = (bad_n / max((toxic == 1).sum(), 1)) / ((other + 0.5) / max((toxic == 0).sum(), 1))
    markers = bad[(bad_n >= MARKER_TEXTS) & (ratio >= MARKER_RATIO)]
    share = np.array([np.isin(w, markers).sum() / max(len(w), 1) for w in words_of])
    marked = (share > 0).astype(float)
    both = share[(marked == 1) & (toxic == 1)]
    dense = ((share > 0) & (share >= (np.median(both) if len(both) else 1))).astype(float)
    return np.column_stack([marked, dense, toxic.astype(float)])


@dataclass
class Chain:
    features: np.ndarray
    links: list[Link]

    def probabilities(self, hashes: list[np.ndarray]) -> np.ndarray:
        """A column for each category, each link fed with the ones before."""
        rows, out = Rows(hashes, self.features), np.zeros((len(hashes), 0))
        for link in self.links:
            out = np.column_stack([out, link.score(rows, logit(out))])
        return out


def fit_chain(texts: list[str], toxic: list[int], share: float) -> Chain:
    """The links in order, later ones trained on out-of-fold probabilities."""
    if len(set(toxic)) < 2:
        bare = float(logit(np.array(share)))
        return Chain(np.zeros(0, U), [Link(np.zeros(0), np.zeros(k), bare) for k in range(len(CATEGORIES))])
    got = hashed(pa.array(texts, pa.string()))
    label = np.array(toxic)
    y = derived([w for _, w in got], label)
    hashes = [h for h, _ in got]
    fold = np.arange(len(texts)) % FOLDS
    features = telling(hashes, label)
    rows = Rows(hashes, features)
    # the features of a fold's models, too, are chosen without the fold
    parts = []
    for f in range(FOLDS):
        seen, held = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
        own = telling([hashes[i] for i in seen], label[seen])
        parts.append((seen, held, Rows([hashes[i] for i in seen], own), Rows([hashes[i] for i in held], own)))
    before = np.zeros((len(texts), 0))
    links = []
    for k in range(len(CATEGORIES)):
        links.append(fit_link(rows, before, y[:, k]))
        if k + 1 < len(CATEGORIES):
            out = np.zeros(len(texts))
            for seen, held, seen_rows, held_rows in parts:
                out[held] = fit_link(seen_rows, before[seen], y[seen, k]).score(held_rows, before[held])
            before = np.column_stack([before, logit(out)])
    # the sample holds more toxic texts than the corpus
    links[-1].intercept += float(logit(np.array(share)) - logit(np.array(label.mean())))
    return Chain(features, links)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = PER_CLASS) -> Chain:
    texts, share = labelled_sample(docs, labels, id_col, text_col, label_col, per_class, SAMPLE_BYTES)
    mixed = sorted(((i, t, y) for y in (0, 1) for i, t in texts[y]), key=lambda r: (r[0], r[2], r[1]))
    return fit_chain([t for _, t, _ in mixed], [y for _, _, y in mixed], share)


def score_rows(chain):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = chain.value.probabilities([h for h, _ in hashed(b.column("txt"))])
            yield batch(id=b.column("id"), **{c: np.ascontiguousarray(p[:, k]) for k, c in enumerate(CATEGORIES)})
    return rows


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and the probability of each category."""
    sent = docs.sparkSession.sparkContext.broadcast(chain)
    return id_and_text(docs, id_col, text_col).mapInArrow(score_rows(sent), "id long, " + ", ".join(f"{c} double" for c in CATEGORIES))
