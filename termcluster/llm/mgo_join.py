"""N-gram Jaccard join filtered by multiple global token orders.

A document is the set of its distinct word n-grams (lower-cased A-Z; the whole
sequence if it is shorter). Two documents link when their Jaccard similarity
reaches num/den. Linked sets of n tokens share a token among the first
n - ceil(n*num/den) + 1 of both, under *every* total order of the tokens.

1. Equal sets become one class (two 64-bit sums of mixed hashes).
2. First order, rarest first by a fixed-size count sketch, then by hash: the
   prefixes are posted by token. Every posting meets up to three hubs (the
   smallest ids of its token). A token posted by more rows than one task should
   read is spread over parts, whose hubs meet in a second step.
   A pair must fit by size, and by place: with p and q tokens before the first
   common one, the overlap is at most min(n - p, m - q).
3. A candidate must also share prefix tokens under two more, independent
   orders; what passes the intersected filters is verified on whole sets.
4. Links give components. Tokens whose postings lie in different components
   then give all pairs across components (never within one) that fit,
   which are filtered and verified in the same way. So no link between different
   components is lost, while a group of n near copies costs about 3n pairs.

Step 4 can in the worst case list all pairs of documents that consist almost
wholly of one passage and yet do not link; prefixes of rare tokens make that
case rare, and no cap is applied.

Scale: postings are 28 bytes for a quarter of the words, shuffled once; texts
of documents in candidate pairs are shuffled compressed. The sketch (4 MB) and
the list of classes with over a thousandth of all documents (at most a
thousand) are the only broadcast data.

Defined cases: null or empty texts have the empty set and link with nothing;
a null id links with nothing and has no component; rows that share an id are
one document with several sets. Extra columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termcluster.llm.components import components
from termcluster.llm.rlz_dedup import compressed, texts_of
from termcluster.llm.shared import batch, id_and_text, scratch
from termcluster.llm.textarrays import BASE_ONE, PLAIN_WORD, Texts, U, mix, prefix_sums, range_hash, runs, text_slices, words

WORDS, NUM, DEN = 5, 75, 100
SKETCH_BITS, SKETCH_PARTS = 20, 64
HUBS = 3
ROWS_PER_PART = 1 << 16
LARGE_CLASSES = 1000
FIRST_SEED, SECOND_SEED = U(0x5851F42D4C957F2D), U(0x14057B7EF767814F)


def shingle_sets(texts: Texts, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct token hashes of all texts, and the bounds of each text;
    within a text ascending."""
    w = words(texts, PLAIN_WORD, lower=True)
    size = np.diff(w.bounds)
    count = np.where(size >= n, size - n + 1, np.minimum(size, 1))
    start = runs(w.bounds[:-1], count)
    doc = np.repeat(np.arange(len(texts)), count)
    length = np.minimum(size, n)[doc]
    sums = prefix_sums(w.hash, BASE_ONE)
    token = mix(range_hash(sums, start, start + length, BASE_ONE) + length.astype(U))
    order = np.argsort(token)
    order = order[np.argsort(doc[order].astype(np.uint16 if len(texts) < 65536 else np.int64), kind="stable")]
    token, doc = token[order], doc[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (doc[1:] != doc[:-1])
    return token[new], np.searchsorted(doc[new], np.arange(len(texts) + 1))


def signatures(token: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sums = (np.append(U(0), np.cumsum(mix(token ^ seed))) for seed in (FIRST_SEED, SECOND_SEED))
    return tuple(s[bounds[1:]] - s[bounds[:-1]] for s in sums)


def bucket(token: np.ndarray) -> np.ndarray:
    return (token >> U(64 - SKETCH_BITS)).astype(np.int64)


def prefix_lengths(n: np.ndarray, num: int, den: int) -> np.ndarray:
    return np.where(n > 0, n - -(-n * num // den) + 1, 0)


def first_tokens(token: np.ndarray, bounds: np.ndarray, key: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of each text's prefix under the order (key, token), and texts."""
    n = np.diff(bounds)
    doc = np.repeat(np.arange(len(n)), n)
    order = np.argsort(key, kind="stable")
    order = order[np.argsort(doc[order].astype(np.uint16 if len(n) < 65536 else np.int64), kind="stable")]
    length = prefix_lengths(n, num, den)
    return order[runs(bounds[:-1], length)], np.repeat(np.arange(len(n)), length)


SET_ROWS = "id long, n long, s1 long, s2 long, part int, counts binary"


def set_rows(n: int):
    """Size and signature of each document's set; one sketch for each task."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        nothing = lambda k, t: pa.nulls(k, t)
        for b in batches:
            for texts in text_slices(b.column("txt")):
                token, bounds = shingle_sets(texts, n)
                counts += np.bincount(bucket(token), minlength=len(counts))
                s1, s2 = signatures(token, bounds)
                yield batch(id=b.column("id").slice(texts.first, len(texts)), n=np.diff(bounds), s1=s1, s2=s2,
                            part=nothing(len(texts), pa.int32()), counts=nothing(len(texts), pa.binary()))
        if counts.any():
            whole = nothing(SKETCH_PARTS, pa.int64())
            yield batch(id=whole, n=whole, s1=whole, s2=whole, part=np.arange(SKETCH_PARTS, dtype=np.int32),
                        counts=pa.array([x.tobytes() for x in np.split(counts, SKETCH_PARTS)], pa.binary()))
    return rows


def add_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for part, counts in zip(b.column("part").to_pylist(), b.column("counts"), strict=True):
            total[part] = total.get(part, 0) + np.frombuffer(counts.as_buffer(), np.int64)
    if total:
        yield batch(part=np.array(list(total), np.int32), counts=pa.array([x.tobytes() for x in total.values()], pa.binary()))


def posting_rows(n: int, num: int, den: int, rows_per_part: int, sketch, large):
    """Prefix tokens under the first order: token, part (0: not spread), id,
    and fit: the set's size n and, in the low half, the largest size of a
    partner for which this may be the first common token. With p tokens before
    it the overlap is at most n - p."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, copies = sketch.value, large.value
        common = 2 * int(np.median(counts)) + rows_per_part
        for b in batches:
            ids = b.column("id").to_numpy()
            for texts in text_slices(b.column("txt")):
                token, bounds = shingle_sets(texts, n)
                seen = counts[bucket(token)]
                key = np.minimum(seen, (1 << 24) - 1).astype(U) << U(40) | mix(token) >> U(24)
                at, doc = first_tokens(token, bounds, key, num, den)
                size = np.diff(bounds)
                place = runs(np.zeros(len(size), np.int64), prefix_lengths(size, num, den))
                fit = size[doc] << 32 | np.maximum((size[doc] - place) * (num + den) // num - size[doc], 0)
                if copies:
                    s1, s2 = signatures(token, bounds)
                    skip = np.array([copies.get((int(x), int(y)), i) != i for x, y, i in zip(s1, s2, ids[texts.first:], strict=False)], bool)
                    stay = ~skip[doc]
                    at, doc, fit = at[stay], doc[stay], fit[stay]
                own = ids[texts.first + doc]
                parts = np.where(seen[at] > common, seen[at] // rows_per_part + 1, 0)
                part = np.where(parts > 0, mix(own.astype(U)) % np.maximum(parts, 1).astype(U) + U(1), U(0)).astype(np.int32)
                yield batch(token=token[at], part=part, id=own, fit=fit)
    return rows


def meet_hubs(num: int, den: int):
    """Rows sorted by (token, part, id): every posting, its place among those
    of its token (up to HUBS), and the hubs before it that sizes and places
    allow. A posting that is alone goes, unless its token is spread."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = np.zeros((0, 4), np.int64)  # first rows of the last group so far
        told = np.zeros(0, bool)  # which of them were given out

        def out(rows, given, last_open):
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
            group = np.cumsum(new) - 1
            first = np.flatnonzero(new)[group]
            size = np.diff(np.append(np.flatnonzero(new), len(rows)))[group]
            place = np.arange(len(rows)) - first
            give = (size > 1) | (rows[:, 1] > 0)
            start = first[-1]
            if last_open and size[-1] == 1:
                give[start] = False
            result = give & ~given
            n, top = rows[:, 3] >> 32, rows[:, 3] & ((1 << 32) - 1)
            hubs = {}
            for k in range(HUBS):
                h = np.minimum(first + k, len(rows) - 1)
                no = (place <= k) | (n > top[h]) | (n[h] > top) | (den * np.minimum(n, n[h]) < num * np.maximum(n, n[h]))
                hubs[f"h{k + 1}"] = pa.array(rows[h, 2][result], mask=no[result])
            got = batch(token=rows[result, 0], part=rows[result, 1].astype(np.int32), id=rows[result, 2], fit=rows[result, 3],
                        place=np.minimum(place, HUBS)[result].astype(np.int32), **hubs)
            return got, rows[start:start + HUBS], (give | given)[start:start + HUBS]

        for b in batches:
            if b.num_rows:
                new = np.stack([b.column(c).to_numpy().astype(np.int64) for c in ("token", "part", "id", "fit")], 1)
                got, head, told = out(np.concatenate([head, new]), np.append(told, np.zeros(len(new), bool)), True)
                yield got
        if len(head):
            yield out(head, told, False)[0]
    return rows


POSTING = "token long, part int, id long, fit long"
MET = POSTING + ", place int, h1 long, h2 long, h3 long"


def with_hubs(postings: DataFrame, num: int, den: int) -> DataFrame:
    return postings.repartition("token", "part").sortWithinPartitions("token", "part", "id").mapInArrow(meet_hubs(num, den), MET)


def hub_pairs(met: DataFrame) -> DataFrame:
    hubs = F.explode(F.array(*(f"h{k + 1}" for k in range(HUBS)))).alias("b")
    return met.select(F.col("id").alias("a"), hubs).filter("b is not null and a <> b")


def linked(num: int, den: int, a_sets, b_sets) -> bool:
    """Filters of the further orders, then the whole sets."""
    (a, *a_prefixes), (b, *b_prefixes) = a_sets, b_sets
    for x, y in zip(a_prefixes, b_prefixes, strict=True):
        if not np.isin(x, y, assume_unique=True).any():
            return False
    both = np.intersect1d(a, b, assume_unique=True).size
    return den * both >= num * (len(a) + len(b) - both)


def verify_rows(n: int, num: int, den: int):
    def sets_of(column: list[bytes]) -> list[tuple]:
        out = []
        for texts in text_slices(texts_of(pa.array(column, pa.binary()))):
            token, bounds = shingle_sets(texts, n)
            prefixes = []
            for seed in (FIRST_SEED, SECOND_SEED):
                at, doc = first_tokens(token, bounds, mix(token + seed), num, den)
                prefixes.append((token[at], np.searchsorted(doc, np.arange(len(texts) + 1))))
            out += [(token[bounds[i]:bounds[i + 1]], *(t[d[i]:d[i + 1]] for t, d in prefixes)) for i in range(len(texts))]
        return out

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(i, 1000) for i in range(0, whole.num_rows, 1000)):
                left, right = b.column("a_txt").to_pylist(), b.column("b_txt").to_pylist()
                place = {t: i for i, t in enumerate(dict.fromkeys(left + right))}
                sets = sets_of(list(place))
                ok = np.array([linked(num, den, sets[place[x]], sets[place[y]]) for x, y in zip(left, right, strict=True)], bool)
                yield batch(a=b.column("a").to_numpy()[ok], b=b.column("b").to_numpy()[ok])
    return rows


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS, num: int = NUM, den: int = DEN,
                       rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id that it
    reaches by links)."""
    spark = docs.sparkSession
    base = id_and_text(docs, id_col, text_col)
    sets = scratch(base.mapInArrow(set_rows(n), SET_ROWS), "sets")
    doc = sets.filter("part is null").select("id", "n", "s1", "s2")
    real = doc.filter("n > 0 and id is not null")
    classes = scratch(real.groupBy("s1", "s2", "n").agg(F.min("id").alias("rep"), F.count("*").alias("size")), "classes")

    member = scratch(real.join(classes, ["s1", "s2", "n"]).select("id", "rep"), "members")

    sketch = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.int64)
    summed = sets.filter("part is not null").select("part", "counts").repartition("part").mapInArrow(add_sketches, "part int, counts binary")
    for r in summed.collect():  # of fixed size
        sketch[r.part] = np.frombuffer(r.counts, np.int64)
    total = classes.agg(F.sum("size")).first()[0] or 0
    large = classes.filter(F.col("size") > max(total // LARGE_CLASSES, 1)).collect()  # fewer than LARGE_CLASSES rows
    bits = (1 << 64) - 1
    sc = spark.sparkContext
    args = sc.broadcast(sketch.reshape(-1)), sc.broadcast({(r.s1 & bits, r.s2 & bits): r.rep for r in large})

    given = base.filter("id is not null")
    met = scratch(with_hubs(given.mapInArrow(posting_rows(n, num, den, rows_per_part, *args), POSTING), num, den), "met")
    heads = met.filter(f"part > 0 and place < {HUBS}").select("token", F.lit(0).alias("part"), "id", "fit")
    packed = given.mapInArrow(compressed, "id long, txt binary")

    def verified(pairs: DataFrame) -> DataFrame:
        one = pairs.join(packed.select(F.col("id").alias("a"), F.col("txt").alias("a_txt")), "a")
        two = one.join(packed.select(F.col("id").alias("b"), F.col("txt").alias("b_txt")), "b")
        return two.mapInArrow(verify_rows(n, num, den), "a long, b long")

    near = hub_pairs(met).union(hub_pairs(with_hubs(heads, num, den))).distinct()
    for side in ("a", "b"):
        near = near.join(member.select(F.col("id").alias(side), F.col("rep").alias(f"{side}_rep")), side)
    near = scratch(near.filter("a_rep <> b_rep").select(F.greatest("a_rep", "b_rep").alias("a"), F.least("a_rep", "b_rep").alias("b")).distinct(), "pairs")
    links = scratch(verified(near), "links")
    label = scratch(components(links), "labels")

    # pairs across the components so far, for tokens with more postings than hubs cover
    wide = met.groupBy("token").agg(F.count("*").alias("k")).filter(F.col("k") > HUBS + 1).select("token")
    posted = (met.select("token", "id", F.shiftright("fit", 32).alias("n"), F.col("fit").bitwiseAND((1 << 32) - 1).alias("top")).join(wide, "token")
              .join(member.select("id", F.col("rep").alias("node")), "id").select("token", "node", "n", "top").distinct()
              .join(label, "node", "left").select("token", "node", "n", "top", F.coalesce("label", "node").alias("comp")))
    posted = scratch(posted, "posted")
    groups = posted.groupBy("token", "comp").agg(F.min("n").alias("n"), F.max("top").alias("top"))
    meet = groups.toDF("token", "c1", "x_n", "x_top").join(groups.toDF("token", "c2", "y_n", "y_top"), "token").filter("c1 < c2 and x_n <= y_top and y_n <= x_top")
    sides = [posted.select("token", F.col("comp").alias(c), F.col("node").alias(x), F.col("n").alias(f"{x}_n"), F.col("top").alias(f"{x}_top")) for c, x in (("c1", "a"), ("c2", "b"))]
    across = meet.select("token", "c1", "c2", "y_n").join(sides[0], ["token", "c1"]).filter("a_top >= y_n").join(sides[1], ["token", "c2"])
    across = across.filter(f"a_n <= b_top and b_n <= a_top and {den} * least(a_n, b_n) >= {num} * greatest(a_n, b_n)")
    across = across.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    rest = scratch(verified(scratch(across.join(near, ["a", "b"], "left_anti"), "across")), "rest")
    label = scratch(components(links.union(rest)), "labels")

    known = member.join(label, F.col("rep") == F.col("node"), "left").groupBy("id").agg(F.min(F.coalesce("label", "rep")).alias("component_id"))
    return (doc.join(known, "id", "left").select("id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")))


def component_survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", one_per_id: bool = False, **options) -> DataFrame:
    """Documents of which one per component stays: the one with the smallest
    id. Rows without an id stay; rows that share an id all stay, or with
    one_per_id the one with the smallest text (then the smallest row hash)."""
    found = jaccard_components(docs, id_col, text_col, **options)
    stay = found.filter("id = component_id").groupBy(F.col("id").alias(id_col)).agg(F.count("*").alias("k"))
    no_id = docs.filter(F.col(id_col).isNull())
    if not one_per_id:
        return docs.join(stay.select(id_col), id_col, "left_semi").unionByName(no_id).select(docs.columns)
    stay = scratch(stay, "stay")
    repeated = scratch(stay.filter("k > 1").select(id_col), "repeated")
    alone = docs.join(stay.filter("k = 1").select(id_col), id_col, "left_semi")
    order = F.struct(F.col(text_col), F.xxhash64(F.to_json(F.struct("*"))))
    ranked = docs.join(repeated, id_col, "left_semi").select(F.col(id_col).alias("id"), F.struct("*").alias("row"), order.alias("order"))
    return alone.unionByName(ranked.groupBy("id").agg(F.min_by("row", "order").alias("row")).select("row.*")).unionByName(no_id).select(docs.columns)
