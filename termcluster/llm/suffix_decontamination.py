"""Benchmark decontamination with training suffix arrays.

Every shard of the training documents (a slice of a task's input) gets a
suffix array over its words, and every test suffix is found in it by binary
search. The interval of a suffix gives all places where its window occurs; from
there matches are extended to the longest verbatim match. Documents in which
the hit words reach a given share are removed.

A window is ``window`` consecutive words of a test item; a shorter item is one
window. Suffixes of a shard that cannot start a window are left out of the array:
those of which a word within the shortest window's length occurs in no test item,
those whose text ends before, and those whose first ``PREFIX`` words (all words of a
shorter window) begin no test suffix, by a lookup in the sorted hashes of these
beginnings. Only the test suffixes met in this lookup are searched, so the work of a
shard depends on what it shares with the test set and, but for a logarithm, not on the
test set's size. Words are compared by hashes (64 bits for each word) up to the window's
length or the end of their text.

Test items are the query set. Spark deals them (distinct ones) by hash to blocks of
about ``block_bytes`` of text and writes these to the shared folder; nothing of their
size reaches the driver. A task reads and expands one block at a time (some 50 bytes a
byte of text while it is sorted; a longer item is expanded whole), and a worker keeps
the last one. Each block is one more pass over the documents. With several blocks the
hit spans of a document meet in one more shuffle, which holds texts only where
``row`` is asked for.

Defined cases: null or empty texts and items have no words: not hit, and in no
document. Item ids are compared as strings; an item without an id hits words but is
not named. Rows that share an id are judged alone. Extra columns are ignored,
or kept in ``row``."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termcluster.llm.shared import batch, id_and_text, shared_folder
from termcluster.llm.textarrays import BASE_ONE, LETTER_WORD, Texts, U, mix, runs, text_slices, words

WINDOW, SHARE = 13, 20
BLOCK_BYTES = 8 << 20
PREFIX = 4
MATCH = "struct<item:string,start:int,length:int>"


def beginnings(word: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Hashes of the first 1, 2, ... ``PREFIX`` words at these places (zeros after the end)."""
    padded = np.append(word, np.zeros(PREFIX, U))
    total = np.zeros(len(at), U)
    for n in range(1, PREFIX + 1):
        total = mix(total * U(BASE_ONE) + padded[at + n - 1])
        yield n, total


class Suffixes:
    """Test suffixes of one block: the first ``length`` words of each, sorted,
    equal ones once, with the items and the places in them that they come from."""

    def __init__(self, names: list[str | None], column: pa.Array, window: int):
        rows, length, of_item, places = [], [], [], []
        for texts in text_slices(column):
            w = words(texts, LETTER_WORD, lower=True)
            size = np.diff(w.bounds)
            count = np.where(size >= window, size - window + 1, np.minimum(size, 1))
            start = runs(w.bounds[:-1], count)
            item = np.repeat(np.arange(len(texts)), count)
            n = np.minimum(size[item], window)
            padded = np.append(w.hash, np.zeros(window, U))
            row = padded[start[:, None] + np.arange(window)]
            row[np.arange(window) >= n[:, None]] = 0
            rows.append(row)
            length.append(n)
            of_item.append(texts.first + item)
            places.append(start - w.bounds[:-1][item])
        row = np.concatenate(rows) if rows else np.zeros((0, window), U)
        n = np.concatenate(length) if length else np.zeros(0, np.int64)
        order = np.lexsort(row.T[::-1])
        row, n = row[order], n[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]).any(1)
        self.words, self.length = row[new], n[new]
        self.vocabulary = np.unique(row[row != 0])
        self.shortest = int(n.min()) if len(n) else 0
        self.names = names
        self.bounds = np.append(np.flatnonzero(new), len(new))
        self.item, self.place = (np.concatenate(x)[order] if x else np.zeros(0, np.int64) for x in (of_item, places))

        # the sorted hashes of the suffixes' beginnings, and the suffixes of each
        depth = np.minimum(self.length, PREFIX)
        key = np.zeros(len(depth), U)
        flat = np.concatenate([self.words[:, :PREFIX], np.zeros((len(depth), max(PREFIX - window, 0)), U)], 1).ravel()
        for n, got in beginnings(flat, np.arange(len(depth)) * PREFIX):
            key[depth == n] = got[depth == n]
        self.depths = set(depth.tolist())
        self.by_key = np.argsort(key, kind="stable")
        self.key, self.sharing = np.unique(key, return_counts=True)
        self.first_by_key = np.cumsum(self.sharing) - self.sharing

    def beginning(self, word: np.ndarray, at: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of these places begin like a test suffix, and all suffixes that
        one of them begins like. left: words from a place to its text's end."""
        found, met = np.zeros(len(at), bool), np.zeros(len(self.key), bool)
        for n, got in beginnings(word, at):
            if n in self.depths:
                near = np.minimum(np.searchsorted(self.key, got), len(self.key) - 1)
                hit = (self.key[near] == got) & (left >= n)
                found |= hit
                met[near[hit]] = True
        return found, np.sort(self.by_key[runs(self.first_by_key[met], self.sharing[met])])

    def origins(self, suffix: int) -> tuple[list[int], list[int]]:
        """Items (by their place in the block) of a test suffix, and its places in them."""
        mine = slice(self.bounds[suffix], self.bounds[suffix + 1])
        return self.item[mine].tolist(), self.place[mine].tolist()


def suffix_array(word: np.ndarray, bounds: np.ndarray, tests: Suffixes, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of a shard's suffixes in the order of their first ``window``
    words (0 from the text's end on), these words, and the test suffixes that
    begin like one of them."""
    known = tests.vocabulary[np.minimum(np.searchsorted(tests.vocabulary, word), len(tests.vocabulary) - 1)] == word
    end = np.repeat(bounds[1:], np.diff(bounds))
    unknown = np.flatnonzero(~known)
    stop = np.append(unknown, len(word))[np.searchsorted(unknown, np.arange(len(word)))]
    at = np.flatnonzero(np.minimum(stop, end) - np.arange(len(word)) >= tests.shortest)
    found, chosen = tests.beginning(word, at, end[at] - at)
    at = at[found]
    rows = np.append(word, np.zeros(window, U))[at[:, None] + np.arange(window)]
    rows[at[:, None] + np.arange(window) >= end[at][:, None]] = 0
    order = np.lexsort(rows.T[::-1])
    return at[order], rows[order], chosen


def search(rows: np.ndarray, wanted: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Interval of the array in which each wanted suffix (of this length) is a
    prefix, for all of them at once: a binary search with whole-row comparisons."""
    n, q = len(rows), len(length)
    inside = np.arange(rows.shape[1]) < length[:, None]

    def bound(after: bool) -> np.ndarray:
        low, high = np.zeros(q, np.int64), np.full(q, n)
        while (low < high).any():
            mid = (low + high) // 2
            got = rows[np.minimum(mid, n - 1)]
            differ = (got != wanted) & inside
            first = differ.argmax(1)
            some = differ.any(1)
            k = np.arange(q)
            less = np.where(some, got[k, first] < wanted[k, first], after)
            open_ = low < high
            low = np.where(open_ & less, mid + 1, low)
            high = np.where(open_ & ~less, mid, high)
        return low

    return bound(False), bound(True)


def shard_matches(texts: Texts, tests: Suffixes, window: int):
    """n_words of each text, and the hits: text, first word, length, test suffix."""
    w = words(texts, LETTER_WORD, lower=True)
    none = np.zeros(0, np.int64)
    if not len(w.hash) or not len(tests.length):
        return np.diff(w.bounds), none, none, none, none
    at, rows, chosen = suffix_array(w.hash, w.bounds, tests, window)
    if not len(at):
        return np.diff(w.bounds), none, none, none, none
    low, high = search(rows, tests.words[chosen], tests.length[chosen])
    place = at[runs(low, high - low)]
    suffix = np.repeat(chosen, high - low)
    text = np.searchsorted(w.bounds, place, "right") - 1
    return np.diff(w.bounds), text, place - w.bounds[text], tests.length[suffix], suffix


def covered(text: np.ndarray, start: np.ndarray, length: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Number of covered words of each text."""
    bounds = np.append(0, np.cumsum(n_words))
    first = bounds[text] + start
    steps = np.bincount(first, minlength=bounds[-1] + 1) - np.bincount(first + length, minlength=bounds[-1] + 1)
    hit = np.append(0, np.cumsum(np.cumsum(steps)[:-1] > 0))
    return hit[bounds[1:]] - hit[bounds[:-1]]


def longest_matches(tests: Suffixes, start: np.ndarray, length: np.ndarray, suffix: np.ndarray) -> list[dict]:
    """Longest verbatim matches of one document: windows are joined while they
    advance by one word in the document and in the item. Matches within a longer
    one of the same item are left out."""
    runs_of: dict[int, tuple[int, int, dict[int, int]]] = {}  # item: last start, length, place there -> start of the match
    spans: dict[str | None, set] = {}

    def ended(item: int, going: dict[int, int]) -> None:
        last, size, run = runs_of[item]
        first = min((s for p, s in run.items() if p + 1 not in going), default=None)
        if first is not None:
            spans.setdefault(tests.names[item], set()).add((first, last + size))

    for k in np.argsort(start, kind="stable"):
        s, n = int(start[k]), int(length[k])
        now: dict[int, dict[int, int]] = {}
        for item, place in zip(*tests.origins(suffix[k]), strict=True):
            last, _, run = runs_of.get(item, (None, 0, {}))
            now.setdefault(item, {})[place] = run.get(place - 1, s) if last == s - 1 else s
        for item, going in now.items():
            if item in runs_of:
                ended(item, going if runs_of[item][0] == s - 1 else {})
            runs_of[item] = s, n, going
    for item in list(runs_of):
        ended(item, {})
    out = []
    for name in sorted(spans, key=lambda x: x or ""):
        reached = 0
        for first, end in sorted(spans[name], key=lambda x: (x[0], -x[1])):
            if end > reached:
                out.append({"item": name, "start": first, "length": end - first})
                reached = end
    return out


@lru_cache(maxsize=1)
def block_suffixes(path: str, block: int, window: int) -> Suffixes:
    """Test suffixes of one block of the shared folder (no such block: none)."""
    system, root = fs.FileSystem.from_uri(path)
    folder = f"{root}/block={block}"
    if system.get_file_info(folder).type == fs.FileType.NotFound:
        return Suffixes([], pa.array([], pa.string()), window)
    got = pq.read_table(folder, columns=["item", "txt"], filesystem=system, partitioning=None)
    text = pa.concat_arrays(got.column("txt").cast(pa.large_string()).chunks) if got.num_rows else pa.array([], pa.large_string())
    return Suffixes(got.column("item").to_pylist(), text, window)


def hit_rows(path: str, block: int, window: int, with_row: bool):
    """Of each document: words, words hit by this block, the distinct hit
    spans and the items."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = block_suffixes(path, block, window)
        for b in batches:
            n_words, n_hit, found, spans = [], [], [], []
            for texts in text_slices(b.column("txt")):
                n, text, start, length, suffix = shard_matches(texts, tests, window)
                n_words.append(n)
                n_hit.append(covered(text, start, length, n))
                order = np.argsort(text, kind="stable")
                ends = np.searchsorted(text[order], np.arange(len(texts) + 1))
                for i in range(len(texts)):
                    mine = order[ends[i]:ends[i + 1]]
                    found.append(sorted({tests.names[i] for k in np.unique(suffix[mine]) for i in tests.origins(k)[0]} - {None}) if len(mine) else [])
                    spans.append(longest_matches(tests, start[mine], length[mine], suffix[mine]) if len(mine) else [])
            out = {"id": b.column("id"), "n_words": np.concatenate(n_words), "n_hit": np.concatenate(n_hit),
                   "items": pa.array(found, pa.list_(pa.string())),
                   "matches": pa.array(spans, pa.list_(pa.struct([("item", pa.string()), ("start", pa.int32()), ("length", pa.int32())])))}
            if with_row:
                out |= {"row": b.column("row")}
            else:
                out |= {"tkey": b.column("tkey")}
            yield batch(**out)
    return rows


def item_blocks(items: DataFrame, item_col: str, text_col: str, block_bytes: int) -> tuple[str, int]:
    """Write the distinct test items with a text in blocks of about ``block_bytes``
    to the shared folder: its path and the number of blocks."""
    spark = items.sparkSession
    given = items.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("txt")).filter("txt is not null").distinct()
    size, count = given.agg(F.sum(F.octet_length("txt").cast("long")), F.count("*")).first()
    n = max(min(-(-(size or 0) // block_bytes), count), 1)
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}-items"
    dealt = given.withColumn("block", F.pmod(F.xxhash64("item", "txt"), F.lit(n)))
    dealt.repartition("block").write.partitionBy("block").parquet(path)
    return path, n


def union_of_spans(spans):
    """Number of words in the union of spans (sorted structs of start, length)."""
    zero = F.struct(F.lit(0).alias("hit"), F.lit(0).alias("end"))
    step = lambda a, s: F.struct(
        (a.hit + F.greatest(F.lit(0), s.start + s.length - F.greatest(a.end, s.start))).alias("hit"), F.greatest(a.end, s.start + s.length).alias("end"))
    return F.aggregate(F.array_sort(spans), zero, step, lambda a: a.hit)


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  window: int = WINDOW, share: int = SHARE, block_bytes: int = BLOCK_BYTES, keep_row: bool = False) -> DataFrame:
    """One row per document: id, n_words, n_hit, items (ids of the test items
    found, sorted), matches (longest verbatim matches: item, first word,
    length in words) and contaminated (share * n_hit >= n_words > 0, n_hit > 0);
    keep_row: also the input row as a struct."""
    base = id_and_text(docs, id_col, text_col, keep_row)
    if not keep_row:
        base = base.withColumn("tkey", F.lit(0).cast("long"))
    path, blocks = item_blocks(items, item_col, item_text_col, block_bytes)
    parts = []
    several = blocks > 1
    if several:  # a row is known by its id and text
        base = base.withColumn("tkey", F.xxhash64("txt"))
    schema = T._parse_datatype_string(f"id long, n_words long, n_hit long, items array<string>, matches array<{MATCH}>")
    key = T.StructField("tkey", T.LongType())
    for k in range(blocks):
        with_row = keep_row and not several
        last = [f for f in base.schema.fields if f.name == "row"] if with_row else [key]
        parts.append(base.mapInArrow(hit_rows(path, k, window, with_row), T.StructType(schema.fields + last)))
    if several:
        met = reduce(DataFrame.union, parts).dropDuplicates(["id", "tkey", "items", "matches"])
        met = met.groupBy("id", "tkey", "n_words").agg(F.flatten(F.collect_list("items")).alias("items"), F.flatten(F.collect_list("matches")).alias("matches"))
        spans = F.transform("matches", lambda m: F.struct(m.start.alias("start"), m.length.alias("length")))
        met = met.select("id", "tkey", "n_words", union_of_spans(spans).cast("long").alias("n_hit"), F.array_sort(F.array_distinct("items")).alias("items"), "matches")
        rows = base.select(F.col("id").alias("i"), F.col("tkey").alias("t"), *(["row"] if keep_row else []))
        out = rows.join(met, F.expr("i <=> id and t = tkey")).drop("i", "t", "tkey")
    else:
        out = parts[0].drop("tkey")
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))


def items_digest(found):
    """sha256 of the item ids, sorted as strings, joined by commas."""
    return F.sha2(F.concat_ws(",", found), 256)
