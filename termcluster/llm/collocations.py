"""Phrase collocations: frequent n-grams by Misra-Gries summaries, then exact counts.

Texts are lower-cased (A-Z), split at ``BREAKS`` into pieces and those at spaces and
tabs into words; phrases are up to ``max_words`` words of one piece, counted per
language.

1. Each task counts the 64-bit hashes of its phrases a block of words at a time and
   sends sorted (hash, count) arrays to hash partitions.
2. A partition merges its blocks into one Misra-Gries summary: when it holds more than
   ``capacity`` counters, the value of the next largest is taken from all of them and
   those that reach zero go. Capacity exceeds the partition's mass (occurrences)
   divided by the threshold, and every unit taken costs capacity + 1 occurrences, so
   less than the threshold is taken in all and every frequent phrase survives. A
   second walk over the same blocks counts the survivors; those below the threshold go.
3. The frequent hashes set bits of a filter of fixed size. The second pass over the
   texts counts, as text, the phrases that pass it; a group-by adds these up exactly
   and the threshold applies again. A collision of hashes or a full filter therefore
   costs time, never a result.
4. Scores. Every candidate asks its parts' counts by joins (all of them are frequent,
   as they occur at least as often); the lowest-scoring cut counts. A candidate is
   dropped if a longer one that holds it occurs at least num/den times as often.
   Products are decimals of 38 digits, exact up to counts of 10**16.

Scale: blocks hold at most one entry for each distinct phrase, so a phrase that makes
up a third of all words is one entry a block. The number of partitions follows the
bytes of text (PARTITION_BYTES for each), so the blocks and the summary of one stay
small; both walks are over the blocks that a task holds. The filter (FILTER_BITS) is
the only broadcast data, of fixed size. Frequent words are frequent join keys on the
candidates' side alone; AQE splits them. The first ``top`` phrases are cut in every
task, then in PARTS parts of a language, then in the language.

Defined cases: a null language is ``und``; null and empty texts have no words; a
language without candidates has no rows; repeated rows and ids count as often as they
occur; ties by count, then by the phrase's bytes. A very long text is held whole, as
UTF-8 bytes and some 60 bytes a word. Extra columns are ignored; an empty table gives
no rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termcluster.llm.shared import batch, scratch
from termcluster.llm.textarrays import BASE_BYTES, BASE_ONE, BYTE_VALUES, LOWER, Texts, U, byte_class, mix, prefix_sums, range_hash, text_slices

BREAKS = ".,;:!?\x0a\x0b\x0c\x0d"  # end a piece
SPACES = " \t"
WORD = byte_class(BREAKS + SPACES)
BREAK = ~byte_class(BREAKS)
MAX_WORDS, LEAST, TOP = 3, 10, 2000
COVER_NUM, COVER_DEN = 50, 100
SCORE_UNIT = 1_000_000
PARTS = 32
UNKNOWN = "und"

BLOCK_ENTRIES = 1 << 21  # hashes that a task gathers before it sends a block
BLOCKS_AT_ONCE = 16
PARTITION_BYTES = 8 << 20  # of text, for each partition of hashes
SLICE_BYTES = 1 << 20
FILTER_BITS, FILTER_PART_BITS = 27, 8  # 16 MB, in 256 parts


def lang_seeds(langs: pa.Array) -> tuple[np.ndarray, list[str]]:
    """For each row the number of its language, and the languages."""
    coded = langs.fill_null(UNKNOWN).dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist()


def lang_hash(name: str) -> int:
    data = np.frombuffer(name.encode(), np.uint8)
    sums = prefix_sums(BYTE_VALUES[data], BASE_BYTES)
    return int(mix(range_hash(sums, np.array([0]), np.array([len(data)]), BASE_BYTES) + U(len(data)))[0])


class Phrases:
    """Words of a slice of texts, and the phrases that begin at each of them."""

    def __init__(self, texts: Texts, seed: np.ndarray):
        """seed: the hash of each text's language."""
        self.data = LOWER[texts.data]
        inside, n = WORD[self.data], len(self.data)
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edge = texts.offsets[(texts.offsets > 0) & (texts.offsets < n)]
        before[edge], after[edge - 1] = False, False
        self.start, self.end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        self.text = np.searchsorted(texts.offsets, self.start, "right") - 1
        sums = prefix_sums(BYTE_VALUES[self.data], BASE_BYTES)
        length = (self.end - self.start).astype(U)
        self.word = mix((range_hash(sums, self.start, self.end, BASE_BYTES) + length) ^ seed[self.text])
        self.second = None
        # words of one piece: no break and no text's end between them
        breaks = np.append(0, np.cumsum(BREAK[self.data]))
        joined = np.zeros(len(self.start), bool)
        if len(joined):
            joined[:-1] = (self.text[1:] == self.text[:-1]) & (breaks[self.start[1:]] == breaks[self.end[:-1]])
        self.joined = joined  # with the next word

    def of_size(self, size: int, held: np.ndarray | None = None, last: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all phrases of this size; held and last are those
        of one word less."""
        if size == 1:
            return np.arange(len(self.word)), self.word
        more = self.joined[held + size - 2]
        at = held[more]
        return at, mix(last[more] * U(BASE_BYTES) + self.word[at + size - 1] + U(size))

    def sizes(self, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        at = h = None
        for size in range(1, most + 1):
            at, h = self.of_size(size, at, h)
            yield size, at, h

    def check(self, at: np.ndarray, size: int) -> np.ndarray:
        """Second hashes of these phrases."""
        if self.second is None:
            sums = prefix_sums(mix(BYTE_VALUES[self.data]), BASE_ONE)
            self.second = mix(range_hash(sums, self.start, self.end, BASE_ONE) + U(1))
        out = self.second[at]
        for k in range(1, size):
            out = mix(out * U(BASE_ONE) + self.second[at + k])
        return out

    def texts_of(self, at: np.ndarray, size: int) -> pa.Array:
        """The phrases as text, their words joined by one space."""
        words = [self.word_texts(at + k) for k in range(size)]
        return pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string())) if size > 1 else words[0]

    def word_texts(self, at: np.ndarray) -> pa.Array:
        length = self.end[at] - self.start[at]
        offsets = np.append(0, np.cumsum(length))
        flat = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - self.start[at], length)
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(self.data[flat]))


def merged(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, ascending, and the sums of their counts."""
    h = np.concatenate(hashes) if hashes else np.zeros(0, U)
    c = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    order = np.argsort(h, kind="stable")
    h, c = h[order], c[order]
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1])[:len(h)])
    return h[first], np.add.reduceat(c, first) if len(first) else c


def slices(b: pa.RecordBatch, seeds: dict[str, int]) -> Iterator[tuple[Phrases, np.ndarray, list[str]]]:
    number, names = lang_seeds(b.column("lang"))
    for name in names:
        seeds.setdefault(name, lang_hash(name))
    seed = np.array([seeds[n] for n in names], U)
    for texts in text_slices(b.column("txt"), SLICE_BYTES):
        rows = number[texts.first:texts.first + len(texts)]
        yield Phrases(texts, seed[rows]), rows, names


BLOCK = "part long, mass long, hashes binary, counts binary"


def block_rows(max_words: int, partitions: int, entries: int):
    """Sorted (hash, count) blocks of each partition's phrases. A partition holds the
    hashes of one range."""
    def flushed(held):
        h = np.sort(np.concatenate(held))
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        counts = np.diff(np.append(first, len(h))).astype(np.uint32)
        h = h[first]
        part = ((h >> U(32)) * U(partitions) >> U(32)).astype(np.int64)
        cuts = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(h))
        for k in range(0, len(cuts) - 1, BLOCKS_AT_ONCE):
            some = list(zip(cuts[k:k + BLOCKS_AT_ONCE].tolist(), cuts[k + 1:k + 1 + BLOCKS_AT_ONCE].tolist()))
            yield batch(part=part[cuts[k:k + len(some)]], mass=np.array([int(counts[x:y].sum()) for x, y in some], np.int64),
                        hashes=pa.array([h[x:y].tobytes() for x, y in some], pa.binary()), counts=pa.array([counts[x:y].tobytes() for x, y in some], pa.binary()))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds: dict[str, int] = {}
        held, n = [], 0
        for b in batches:
            for phrases, _, _ in slices(b, seeds):
                for _, _, h in phrases.sizes(max_words):
                    held.append(h)
                    n += len(h)
                if n >= entries:
                    yield from flushed(held)
                    held, n = [], 0
        if n:
            yield from flushed(held)
    return rows


class Summary:
    """A Misra-Gries summary of at most ``capacity`` counters. What is taken from
    every counter in all is less than mass / capacity."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.keys, self.counts, self.taken = np.zeros(0, U), np.zeros(0, np.int64), 0

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add another summary's counters (or a block's counts)."""
        self.keys, self.counts = merged([self.keys, keys], [self.counts, counts])
        if len(self.keys) > self.capacity:
            at = len(self.counts) - self.capacity - 1
            cut = int(np.partition(self.counts, at)[at])  # the largest that may not stay
            keep = self.counts > cut
            self.keys, self.counts, self.taken = self.keys[keep], self.counts[keep] - cut, self.taken + cut


def frequent(blocks: list[tuple[np.ndarray, np.ndarray]], mass: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys that occur ``least`` times or more in these blocks, and their counts."""
    summary = Summary(mass // least + 1)
    for keys, counts in blocks:
        summary.merge(keys, counts)
    total = np.zeros(len(summary.keys), np.int64)
    for keys, counts in blocks:
        at = np.searchsorted(summary.keys, keys)
        at[at == len(total)] = 0
        hit = summary.keys[at] == keys if len(total) else np.zeros(len(keys), bool)
        total[at[hit]] += counts[hit]  # a block has every key once
    often = total >= least
    return summary.keys[often], total[often]


def frequent_rows(least: int):
    """The frequent hashes of each partition; its blocks follow each other."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blocks, mass = None, [], 0
        for b in batches:
            columns = (b.column(c) for c in ("part", "mass", "hashes", "counts"))
            for p, m, h, c in zip(*columns, strict=True):
                p = p.as_py()
                if p != part:
                    if blocks:
                        yield batch(hash=frequent(blocks, mass, least)[0])
                    part, blocks, mass = p, [], 0
                blocks.append((np.frombuffer(h.as_py(), U), np.frombuffer(c.as_py(), np.uint32)))
                mass += m.as_py()
        if blocks:
            yield batch(hash=frequent(blocks, mass, least)[0])
    return rows


def filter_rows(bits: int, part_bits: int):
    """The filter's parts: one bit for each hash, in the part of its first bits."""
    width = 1 << bits - part_bits

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            at = (b.column("hash").to_numpy().view(U) >> U(64 - bits)).astype(np.int64)
            for p in np.unique(at // width).tolist():
                held.setdefault(p, np.zeros(width, bool))[at[at // width == p] % width] = True
        if held:
            yield batch(part=np.array(list(held), np.int64), bits=pa.array([np.packbits(x).tobytes() for x in held.values()], pa.binary()))
    return rows


def phrase_filter(hashes: DataFrame, bits: int = FILTER_BITS, part_bits: int = FILTER_PART_BITS) -> np.ndarray:
    """One bit for each value of a hash's first ``bits`` bits, packed. The driver gets
    the whole filter, of fixed size, whatever the number of hashes."""
    out = np.zeros((1 << part_bits, 1 << bits - part_bits - 3), np.uint8)
    dealt = hashes.repartition(1 << part_bits, F.shiftrightunsigned("hash", 64 - part_bits))
    for r in dealt.mapInArrow(filter_rows(bits, part_bits), "part long, bits binary").collect():
        out[r.part] |= np.frombuffer(r.bits, np.uint8)
    return out.reshape(-1)


COUNTED = "lang string, words int, phrase string, n long"


def grouped(h: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows, and where groups of equal pairs begin in it. Pairs that
    share h alone may make several groups, never a mixed one."""
    order = np.argsort(h, kind="stable")
    h, check = h[order], check[order]
    return order, np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (check[1:] != check[:-1]))[:len(h)])


def counted_rows(max_words: int, passing, bits: int, entries: int):
    """Counts, as text, of the phrases whose hashes pass the filter; and of all words
    of a language, as the phrase of no words. A task adds up what has two equal 64-bit
    hashes, independent of each other, before it sends the text."""
    types = {"lang": pa.string(), "words": pa.int32(), "phrase": pa.string(), "n": pa.int64()}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds: dict[str, int] = {}
        held: dict[tuple[str, int], list] = {}
        total: dict[str, int] = {}
        n, flags = 0, passing.value

        def flushed():
            for (name, size), found in held.items():
                h, check, count = (np.concatenate(x) for x in list(zip(*found))[:3])
                texts = pa.concat_arrays([x[3] for x in found])
                order, first = grouped(h, check)
                k = len(first)
                yield pa.RecordBatch.from_arrays([pa.repeat(name, k), pa.repeat(pa.scalar(size, pa.int32()), k), texts.take(pa.array(order[first])).cast(pa.string()),
                                                  pa.array(np.add.reduceat(count[order], first))], names=list(types))
            held.clear()

        for b in batches:
            for phrases, lang_of, names in slices(b, seeds):
                lang = lang_of[phrases.text]
                for k, words in enumerate(np.bincount(lang, minlength=len(names)).tolist()):
                    total[names[k]] = total.get(names[k], 0) + words
                for size, at, h in phrases.sizes(max_words):
                    place = (h >> U(64 - bits)).astype(np.int64)
                    passes = np.flatnonzero(flags[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1)
                    at, h = at[passes], h[passes]
                    if not len(at):
                        continue
                    check = phrases.check(at, size)
                    order, first = grouped(h, check)
                    count = np.diff(np.append(first, len(h)))
                    one = order[first]
                    at, h, check = at[one], h[one], check[one]
                    for k in np.unique(lang[at]).tolist():
                        mine = lang[at] == k
                        held.setdefault((names[k], size), []).append((h[mine], check[mine], count[mine], phrases.texts_of(at[mine], size)))
                    n += len(at)
                if n >= entries:
                    yield from flushed()
                    n = 0
        yield from flushed()
        names = list(total)
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((names, [0] * len(names), [""] * len(names), list(total.values())), types.values(), strict=True)], names=list(types))
    return rows


def phrase_counts(docs: DataFrame, max_words: int = MAX_WORDS, least: int = LEAST, lang_col: str = "lang", text_col: str = "text",
                  partition_bytes: int = PARTITION_BYTES, entries: int = BLOCK_ENTRIES, bits: int = FILTER_BITS) -> DataFrame:
    """lang, words, phrase, n: exact counts of all phrases of 1 to ``max_words`` words
    that occur ``least`` times or more in a language, and, with words 0, the number of
    words of each language."""
    base = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).cast("string").alias("txt"))
    size = base.agg(F.sum(F.octet_length("txt").cast("long"))).first()[0] or 0
    partitions = max(1, -(-size // partition_bytes))
    blocks = base.mapInArrow(block_rows(max_words, partitions, entries), BLOCK)
    dealt = blocks.repartition(partitions, "part").sortWithinPartitions("part")
    hashes = scratch(dealt.mapInArrow(frequent_rows(least), "hash long"), "frequent")
    passing = docs.sparkSession.sparkContext.broadcast(phrase_filter(hashes, bits))
    counted = base.mapInArrow(counted_rows(max_words, passing, bits, entries // 2), COUNTED)
    found = scratch(counted.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
                    .filter((F.col("words") == 0) | (F.col("n") >= least)), "phrases")
    passing.destroy()  # workers that are used again don't keep it
    return found


def wide(c: str) -> Column:
    return F.col(c).cast("decimal(19,0)")


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, least: int = LEAST, top: int = TOP, num: int = COVER_NUM, den: int = COVER_DEN, **options) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of a language."""
    counts = phrase_counts(docs, max_words, least, **options)
    known = counts.filter("words > 0").select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    candidates = counts.filter("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))
    word = F.split("phrase", " ")
    # both parts of every cut
    cuts = candidates.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"), word.alias("w"), "words")
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("head"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("tail"))
    cuts = cuts.join(known.select("lang", F.col("part").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(known.select("lang", F.col("part").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    product = F.lit(SCORE_UNIT).cast("decimal(7,0)") * (wide("a") * wide("a")).cast("decimal(31,0)")
    cuts = cuts.withColumn("score", exact_div(product.cast("decimal(38,0)"), (wide("l") * wide("r")).cast("decimal(38,0)")))
    scored = (cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
              .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    # the most frequent longer candidate that holds a phrase
    size, begin = F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"), F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("begin")
    inner = candidates.filter("words > 2").select("lang", "a", "words", word.alias("w"), size).select("lang", "a", "w", "size", begin)
    longer = inner.groupBy("lang", F.array_join(F.slice("w", F.col("begin"), F.col("size")), " ").alias("phrase")).agg(F.max("a").alias("longer"))
    left = scored.join(longer, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (wide("longer") * den < wide("a") * num))
    order = (F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    # first in parts of a language, so that the last step sees PARTS * top rows of one
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    first = left.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    first = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    totals = counts.filter("words = 0").select("lang", "n")  # a row a language
    return first.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def exact_div(a: Column, b: Column) -> Column:
    """The quotient of two decimals without fraction, rounded down."""
    return F.call_function("div", a, b)
