"""Hard-negative mining with exact integer scores from a residue-number-system GEMM.

A row's components are floor(scale * x); the score of a row for an anchor is their
integer inner product. Higher scores come first, ties by smaller id.

Scores: component matrices are reduced modulo several small primes to residues of
at most (p - 1) / 2 either way and multiplied in float32. The primes are so small
that no sum of a chunk of dimensions passes 2**24, so every product is exact.
Balanced mixed-radix digits (Chinese remaindering) then give the signed score.
Norms bound the scores (Cauchy-Schwarz), which says how many primes are needed.

Selection, a block of anchors at a time:

1. Each task scores the anchors against its rows, in slices, and keeps the first
   ``positives`` rows of the anchor's label; a window over what the tasks kept (at
   most ``positives`` rows an anchor and task) gives the anchor's positives.
2. Each positive opens a window of scores, low * positive score to high * positive
   score (both over den). Each task keeps the first ``negatives`` rows of another
   label in each window; a second window function merges these.

Scale: the query set is stated (anchors), so rows are never paired among
themselves. Rows stay where they are: only what tasks keep is shuffled. A block of
anchors is the only broadcast data, at most BLOCK_BYTES of components and as much
again for its positives; more anchors mean more blocks, one after the other. One
task holds a slice of scores (ANCHOR_CHUNK x ROW_SLICE) and what it keeps.

Defined cases: rows with a null id, label or vector, or with any null or non-finite
component, take no part. Vectors of unlike length count as padded with zeros. Rows
that share an id are rows of their own: an anchor's copy may be its positive, and
each copy of an anchor has rows of its own in the result. Many equal vectors are
ties, broken by id. An anchor without rows of its label, and a positive without rows
in its window, give no rows; a negative positive score has an empty window where
low < high. A score beyond 64 bits raises OverflowError. Empty tables give no rows;
extra columns are ignored."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termcluster.llm.shared import batch, scratch

SCALE, LOW, HIGH, DEN = 256, 80, 100, 100
POSITIVES, NEGATIVES = 5, 5
DIMENSIONS = 1024  # of one float32 product
BLOCK_BYTES = 16 << 20
ANCHOR_CHUNK, ROW_SLICE = 1024, 2048
EXACT = 1 << 24  # float32 holds all integers up to here


def moduli(dimensions: int, bound: int) -> list[int]:
    """The largest primes whose residue products stay exact over ``dimensions``,
    as many as tell apart all integers from -bound to bound."""
    p = 2 * math.isqrt(EXACT // max(1, min(dimensions, DIMENSIONS))) + 1
    out: list[int] = []
    while math.prod(out) < 2 * bound + 1:
        if all(p % q for q in range(2, math.isqrt(p) + 1)):
            out.append(p)
        p -= 1
        if p < 3:
            raise OverflowError("scores are too large for the primes of this dimension")
    return out


def centred(x: np.ndarray, p: int) -> np.ndarray:
    """Residues modulo the odd p, between -(p-1)/2 and (p-1)/2."""
    r = np.mod(x, p)
    return np.where(r > p // 2, r - p, r)


def residue_product(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """a @ b.T modulo p, of integer components as doubles, by float32 products."""
    x, y = centred(a, p).astype(np.float32), centred(b, p).astype(np.float32)
    total = np.zeros((len(a), len(b)), np.int64)
    for k in range(0, a.shape[1], DIMENSIONS):
        total += (x[:, k:k + DIMENSIONS] @ y[:, k:k + DIMENSIONS].T).astype(np.int64)
    return total % p


def reconstruct(residues: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The signed integers of these residues: balanced mixed-radix digits, summed
    modulo 2**64, which is exact for values of 64 bits."""
    digits: list[tuple[np.ndarray, int]] = []
    value, weight = np.zeros(residues[0].shape, np.int64), 1
    for r, p in zip(residues, primes, strict=True):
        t = r.astype(np.int64)
        for d, w in digits:
            t = t - d * (w % p)
        t = centred(t % p * pow(weight, -1, p), p)
        value += t * np.uint64(weight & 0xFFFFFFFFFFFFFFFF).astype(np.int64)
        digits.append((t, weight))
        weight *= p
    return value


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of a and b (integers held as doubles)."""
    d = min(a.shape[1], b.shape[1])  # what one lacks is zero
    a, b = a[:, :d], b[:, :d]
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    longest = [float(np.sqrt((m * m).sum(axis=1)).max()) for m in (a, b)]
    limit = longest[0] * longest[1] * (1 + 1e-6) + 1
    if limit >= 2.0 ** 62 and (not math.isfinite(limit) or np.abs(a @ b.T).max() >= 2.0 ** 62):
        raise OverflowError("an inner product passes 64 bits")
    primes = moduli(d, int(limit))
    return reconstruct([residue_product(a, b, p) for p in primes], primes)


def matrix(vectors: pa.Array) -> np.ndarray:
    """Lists of doubles as rows, shorter ones padded with zeros."""
    offsets = vectors.offsets.to_numpy()
    flat, length = vectors.values.to_numpy(zero_copy_only=False), np.diff(offsets)
    width = int(length.max(initial=0))
    if (length == width).all():
        return flat[offsets[0]:offsets[-1]].reshape(len(vectors), width)
    out = np.zeros((len(vectors), width))
    out[np.arange(width) < length[:, None]] = flat[offsets[0]:offsets[-1]]
    return out


class Kept:
    """The first ``k`` candidates of every slot seen so far, by score descending,
    then id, then row."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.least = np.full(slots, np.iinfo(np.int64).min)  # nothing below can still enter
        self.slot = self.score = self.id = self.row = np.zeros(0, np.int64)

    def add(self, slots: np.ndarray, found: np.ndarray, allowed: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """found, allowed: one line for each of the (distinct) slots, one column a row."""
        if found.shape[1] > self.k:
            masked = np.where(allowed, found, np.iinfo(np.int64).min)
            least = np.maximum(self.least[slots], np.partition(masked, -self.k, axis=1)[:, -self.k])
        else:
            least = self.least[slots]
        line, column = np.nonzero(allowed & (found >= least[:, None]))
        if not len(line):
            return
        slot, score, i, row = (np.concatenate(x) for x in ((self.slot, slots[line]), (self.score, found[line, column]), (self.id, ids[column]), (self.row, rows[column])))
        order = np.lexsort((row, i, -score, slot))
        slot = slot[order]
        first = np.searchsorted(slot, slot)
        best = np.arange(len(slot)) - first < self.k
        order = order[best]
        self.slot, self.score, self.id, self.row = slot[best], score[order], i[order], row[order]
        full = np.flatnonzero(np.arange(len(self.slot)) - np.searchsorted(self.slot, self.slot) == self.k - 1)
        self.least[self.slot[full]] = self.score[full]


def row_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    for b in batches:
        for at in range(0, b.num_rows, ROW_SLICE):
            part = b.slice(at, ROW_SLICE)
            yield *(part.column(c).to_numpy(zero_copy_only=False) for c in ("rid", "id", "label")), matrix(part.column("v"))


KEPT = "slot long, score long, id long, rid long"


def positive_rows(block, k: int):
    """The first k rows of the anchor's label in this task, for every anchor."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arid, _, alabel, a = block.value
        kept = Kept(len(arid), k)
        for rid, i, label, v in row_slices(batches):
            for x in np.unique(label):
                ours, theirs = np.flatnonzero(alabel == x), np.flatnonzero(label == x)
                for at in range(0, len(ours), ANCHOR_CHUNK):
                    part = ours[at:at + ANCHOR_CHUNK]
                    kept.add(part, scores(a[part], v[theirs]), arid[part, None] != rid[theirs], i[theirs], rid[theirs])
        yield batch(slot=kept.slot, score=kept.score, id=kept.id, rid=kept.row)
    return rows


def negative_rows(block, windows, k: int):
    """The first k rows of another label in this task, for every window. windows:
    (slot, anchor, least, most) arrays, the most one line for each anchor and place."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, alabel, a = block.value
        anchor, place, least, most = windows.value
        kept = Kept(len(anchor), k)
        by_place = [np.flatnonzero(place == x) for x in np.unique(place)]
        for rid, i, label, v in row_slices(batches):
            for at in range(0, len(a), ANCHOR_CHUNK):
                part = slice(at, at + ANCHOR_CHUNK)
                got = scores(a[part], v)
                other = alabel[part, None] != label
                for slots in by_place:
                    slots = slots[(anchor[slots] >= at) & (anchor[slots] < at + ANCHOR_CHUNK)]
                    mine = anchor[slots] - at
                    found = got[mine]
                    inside = other[mine] & (found >= least[slots, None]) & (found <= most[slots, None])
                    kept.add(slots, found, inside, i, rid)
        yield batch(slot=kept.slot, score=kept.score, id=kept.id, rid=kept.row)
    return rows


def participants(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """rid, id, label, v: the rows that take part, with integer components."""
    scaled = F.transform(F.col(vector_col), lambda x: x.cast("double") * F.lit(float(scale)))
    # a double of 2**53 or more is an integer already
    whole = F.transform("v", lambda x: F.when(F.abs(x) < 2.0 ** 53, F.floor(x).cast("double")).otherwise(x))
    return (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), scaled.alias("v"))
            .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull())
            .filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
            .select(F.monotonically_increasing_id().alias("rid"), "id", "label", whole.alias("v")))


def scaled_bounds(score: np.ndarray, low: int, high: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and the most n with low * score <= den * n <= high * score, without
    a product that passes 64 bits (low and high at most den)."""
    q, r = np.divmod(score, den)
    return low * q - (-(low * r) // den), high * q + high * r // den


def first_of(kept: DataFrame, k: int) -> DataFrame:
    """The first k rows of every slot over all tasks, with their rank."""
    w = Window.partitionBy("slot").orderBy(F.col("score").desc(), "id", "rid")
    return kept.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column | str, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, den: int = DEN,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank int, negative_id, positive_score, negative_score.
    is_anchor: a condition on the column ``id``, as a column or SQL."""
    if not 0 <= low <= high <= den:
        raise ValueError("0 <= low <= high <= den doesn't hold")
    spark = vectors.sparkSession
    rows = scratch(participants(vectors, id_col, vector_col, label_col, scale), "rows")
    anchors = scratch(rows.filter(is_anchor), "anchors")
    n, width = anchors.agg(F.count("*"), F.max(F.size("v"))).first()
    per_block = max(1, block_bytes // (8 * max(1, width or 1)))
    blocks = max(1, -(-2 * n // per_block)) if n > per_block else 1
    number = F.pmod(F.xxhash64("rid"), F.lit(blocks))
    result = None
    for k in range(blocks):
        part = anchors.filter(number == k).limit(per_block + 1).toPandas().sort_values("rid") if n else None
        if part is None or not len(part):
            continue
        if len(part) > per_block:
            raise RuntimeError("a block of anchors passes its bound")  # twice the mean: not met in practice
        arid, aid, alabel = (part[c].to_numpy(np.int64) for c in ("rid", "id", "label"))
        a = matrix(pa.array(part["v"].tolist(), pa.list_(pa.float64())))
        block = spark.sparkContext.broadcast((arid, aid, alabel, a))
        chosen = first_of(rows.mapInArrow(positive_rows(block, positives), KEPT), positives).orderBy("slot", "rank").toPandas()  # at most ``positives`` an anchor
        anchor, place, score, pid = (chosen[c].to_numpy(np.int64) for c in ("slot", "rank", "score", "id"))
        least, most = scaled_bounds(score, low, high, den)
        windows = spark.sparkContext.broadcast((anchor, place, least, most))
        found = first_of(rows.mapInArrow(negative_rows(block, windows, negatives), KEPT), negatives)
        # the block's windows go as a table: at most ``positives`` rows an anchor
        names = spark.createDataFrame(pa.table({"slot": np.arange(len(anchor)), "anchor_id": aid[anchor], "positive_id": pid, "positive_score": score}))
        out = found.join(F.broadcast(names), "slot").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        out = scratch(out, f"negatives-{k}") if blocks > 1 else out
        result = out if result is None else result.unionByName(out)
    if result is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return result
