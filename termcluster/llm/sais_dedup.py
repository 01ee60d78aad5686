"""Substring dedup on bytes with suffix arrays by induced sorting.

Each byte is removed that lies in a string of ``length`` bytes which also starts
somewhere else, in the same document or another.

Texts are cut into content-defined blocks (``anchors``): equal strings of
``length`` bytes always lie in blocks with the same anchor hash, and have the
anchor at the same place. A block that occurs twice as a whole is all repeats.
Where one anchor has several different blocks, the strings of one copy of each
are dealt into cells, by the place of the anchor in them: up to ``grid`` adjacent
strings, known by the bytes that all of them have. Equal strings lie in cells with
equal such bytes (the key of a cell), so a key that only one cell has is done. A
cell that occurs in several blocks is all repeats. Of the other cells with a common
key, one copy of each goes to a shard, and a suffix array of the shard's cells
finds the strings that they share:

1. suffixes are classified as smaller (S) or larger (L) than the next one;
2. the substrings between leftmost S positions are sorted by one induction and
   named; if names repeat, the string of names is sorted recursively;
3. two linear inductions, L from the left and S from the right, give the array;
4. permuted common prefixes (each suffix with its predecessor in the array,
   counted up to ``length``) show which strings occur again.

Inductions run bucket by bucket in whole numpy steps. A string of names with more
than ``NUMPY_BUCKETS`` different values, where a step would hold a few elements
only, is sorted by prefix doubling instead of a further induction.

A shard is all differing cells of some keys. If a key has more of them than
``BLOCKS_PER_SHARD`` (a passage with very many surroundings), its cells are cut
into smaller ones, of ``FINER`` times fewer strings, down to cells of one string.
Those differ if their keys do, so they are counted, whatever their number, and
no group of equal strings is held by a task. Only hashes and places of cells are
shuffled before it is known which cells have to be compared.

Blocks are known by (anchor, content), cells by (key, sub): 128 bits.

Defined cases: a null text is empty; matches never cross documents; rows with
equal ids or without an id are documents like any other (equal rows are copies
of each other). Extra columns are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termcluster.llm.anchors import blocks
from termcluster.llm.rlz_dedup import compressed, texts_of
from termcluster.llm.shared import batch, id_and_text, scratch
from termcluster.llm.textarrays import BASE_ONE, BASE_TWO, BYTE_VALUES, U, mix, prefix_sums, range_hash, runs, text_slices

LENGTH, GRAM = 400, 32
BLOCKS_PER_SHARD = 4000
SHARD_BYTES = 1 << 19
# Texts held at a time where every byte takes several numbers.
SLICE = 1 << 19
# Rows of whole texts held at a time.
ROWS = 256
FINER = 8
NUMPY_BUCKETS = 6000


# --- suffix array -----------------------------------------------------------


def types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (S); the last value
    is a sentinel smaller than all others."""
    n = len(text)
    differ = np.append(text[1:] != text[:-1], True)
    at = np.flatnonzero(differ)
    nearest = at[np.searchsorted(at, np.arange(n))]
    following = np.append(text[1:], -1)
    s = text[nearest] < following[nearest]
    s[-1] = True
    return s


def induce(text: np.ndarray, s: np.ndarray, seeds: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Suffix order from ordered leftmost-S suffixes: larger types from the
    left, then smaller types from the right, bucket by bucket. heads: bounds of
    the buckets of each value. A bucket is done in waves, as a suffix can put the
    one before it into the same bucket."""
    n, k = len(text), len(heads) - 1
    sa = np.full(n, -1, np.int64)
    tails = heads[1:].copy()
    # seeds at the end of their buckets, in order
    count = np.bincount(text[seeds], minlength=k)
    seeds = seeds[np.argsort(text[seeds], kind="stable")]
    sa[runs(tails - count, count)] = seeds
    seed_from = tails - count
    next_l = heads[:-1].copy()

    def put_l(sources: np.ndarray) -> None:
        before = sources[sources > 0] - 1
        before = before[~s[before]]
        if len(before):
            v = text[before]
            order = np.argsort(v, kind="stable")
            before, v = before[order], v[order]
            start = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
            size = np.diff(np.append(start, len(v)))
            sa[runs(next_l[v[start]], size)] = before
            next_l[v[start]] += size

    used = np.flatnonzero(np.bincount(text, minlength=k))
    for c in used:
        done = heads[c]
        while done < next_l[c]:
            wave, done = sa[done:next_l[c]], next_l[c]
            put_l(wave)
        if seed_from[c] < tails[c]:
            put_l(sa[seed_from[c]:tails[c]])
    # all L suffixes stand; S suffixes are written anew from the right
    next_s = tails.copy()

    def put_s(sources: np.ndarray) -> None:
        """sources from right to left."""
        before = sources[sources > 0] - 1
        before = before[s[before]]
        if len(before):
            v = text[before]
            order = np.argsort(v, kind="stable")
            before, v = before[order], v[order]
            start = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
            size = np.diff(np.append(start, len(v)))
            # the first of a value goes furthest right
            sa[np.repeat(next_s[v[start]] - 1, size) - (np.arange(len(v)) - np.repeat(start, size))] = before
            next_s[v[start]] -= size

    for c in used[::-1]:
        if c == text[n - 1]:
            sa[heads[c]] = n - 1  # the sentinel has a bucket of its own
            next_s[c] = heads[c]
        done = tails[c]
        while done > next_s[c]:
            wave, done = sa[next_s[c]:done][::-1], next_s[c]
            put_s(wave)
        if heads[c] < next_l[c]:
            put_s(sa[heads[c]:next_l[c]][::-1])
    return sa


def doubled(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling, for strings of very many values."""
    n = len(text)
    rank, width = text.astype(np.int64), 1
    while True:
        second = np.zeros(n, np.int64)
        second[:n - width] = rank[width:] + 1 if width < n else 0
        key = rank * (n + 2) + second
        order = np.argsort(key, kind="stable")
        got = key[order]
        new = np.append(0, np.cumsum(got[1:] != got[:-1]))
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1 or width >= n:
            return order
        width *= 2


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of values 0..k-1 of which the last is the only 0."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    s = types(text)
    left = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    heads = np.append(0, np.cumsum(np.bincount(text)))
    if len(heads) > NUMPY_BUCKETS:
        return doubled(text)
    first = induce(text, s, left, heads)
    # names of the substrings between leftmost S positions, in their sorted order
    is_left = np.zeros(n, bool)
    is_left[left] = True
    ordered = first[is_left[first]]
    length = np.append(np.diff(left), 1)  # up to the next one, which is compared too
    size = np.zeros(n, np.int64)
    size[left] = length + 1
    size[left[-1]] = 1
    a, b = ordered[:-1], ordered[1:]
    same = size[a] == size[b]
    k = 0
    alive = np.flatnonzero(same)
    while len(alive):
        alive = alive[size[a[alive]] > k]
        equal = text[a[alive] + k] == text[b[alive] + k]
        same[alive[~equal]] = False
        alive = alive[equal]
        k += 1
    name = np.zeros(n, np.int64)
    name[ordered] = np.append(0, np.cumsum(~same))
    names = name[left]
    if names.max() + 1 < len(left):
        order = left[suffix_array(names)]
    else:
        order = left[np.argsort(names)]
    return induce(text, s, order, heads)


def common_prefixes(sa: np.ndarray, words: np.ndarray, limit: np.ndarray, most: int) -> np.ndarray:
    """Permuted common prefixes up to ``most``: of every position with the
    suffix before it in the array. words[i]: the eight bytes from i on."""
    n = len(sa)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    out = np.zeros(n, np.int64)
    alive = np.flatnonzero((before >= 0) & (limit >= most))
    alive = alive[limit[before[alive]] >= most]
    k = 0
    while len(alive) and k < most:
        at = min(k, most - 8)
        equal = words[alive + at] == words[before[alive] + at]
        alive = alive[equal]
        k += 8
    out[alive] = most
    return out


def repeated_starts(data: np.ndarray, bounds: np.ndarray, length: int) -> np.ndarray:
    """Flags of the positions at which a string of ``length`` bytes starts
    that also starts elsewhere among the pieces data[bounds[i]:bounds[i+1]]."""
    pieces = len(bounds) - 1
    # every piece ends with a separator below all bytes; the last one is the sentinel
    n = len(data) + pieces + 1
    text = np.ones(n, np.int64)
    own = np.arange(len(data)) + np.repeat(np.arange(pieces), np.diff(bounds))
    text[own] = data.astype(np.int64) + 2
    text[-1] = 0
    sa = suffix_array(text)
    ends = bounds[1:] + np.arange(pieces)
    limit = np.zeros(n, np.int64)
    limit[own] = np.repeat(ends, np.diff(bounds)) - own
    raw = np.append(np.minimum(text, 255).astype(np.uint8), np.zeros(8, np.uint8))
    raw[own] = data
    words = np.ndarray((n,), "<u8", raw, 0, (1,))
    equal = common_prefixes(sa, words, limit, length)[sa] >= length
    flags = np.zeros(n, bool)
    flags[sa[equal]] = True
    flags[sa[np.flatnonzero(equal) - 1]] = True
    return flags[own]


# --- Spark ------------------------------------------------------------------


def block_rows(length: int, gram: int):
    """Blocks of every text: anchor, content, row, start, windows."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row = b.column("rid").to_numpy()
            for texts in text_slices(b.column("txt"), SLICE):
                found = blocks(BYTE_VALUES[texts.data], texts.offsets, length, gram)
                at = texts.first + found.text
                start = found.start - texts.offsets[found.text]
                yield batch(anchor=found.anchor, content=found.content, rid=row[at], place=start << 32 | found.end - found.start)
    return rows


def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, ROWS):
            yield b.slice(i, ROWS)


def piece_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the chosen blocks of each text."""
    for b in few(batches):
        out: dict[str, list] = {c: [] for c in ("anchor", "content", "bytes")}
        for text, chosen in zip(texts_of(b.column("txt")), b.column("chosen").to_pylist(), strict=True):
            data = memoryview(text.as_buffer())
            for c in chosen:
                start = c["place"] >> 32
                out["anchor"].append(c["anchor"])
                out["content"].append(c["content"])
                out["bytes"].append(data[start:start + (c["place"] & 0xFFFFFFFF)].tobytes())
        yield batch(anchor=np.array(out["anchor"], np.int64), content=np.array(out["content"], np.int64), bytes=pa.array(out["bytes"], pa.binary()))


def grids(length: int, gram: int) -> list[int]:
    """Strings in a cell, level by level; each divides the one before."""
    out = [1 << max((length - gram) // 4, 1).bit_length() - 1]
    while out[-1] > 1:
        out.append(max(out[-1] // FINER, 1))
    return out


def cells(data: np.ndarray, bounds: np.ndarray, anchor: np.ndarray, piece: np.ndarray, low: np.ndarray, high: np.ndarray, length: int, gram: int, grid: int) -> tuple[np.ndarray, ...]:
    """Cells of the strings that start at low[i] to high[i] in piece[i] (blocks
    data[bounds[i]:bounds[i+1]]): which i, start, end, key, sub."""
    values = BYTE_VALUES[data]
    one, two = prefix_sums(values, BASE_ONE), prefix_sums(mix(values + U(1)), BASE_TWO)
    # a block's anchor is the first such gram that all its strings have
    begin = bounds[1:] - length
    count = bounds[:-1] + length - gram + 1 - begin
    at, whose = runs(begin, count), np.repeat(np.arange(len(begin)), count)
    hit = np.flatnonzero(mix(range_hash(one, at, at + gram, BASE_ONE)) == anchor[whose])
    pick = at[hit[np.searchsorted(whose[hit], np.arange(len(begin)))]][piece]
    near, far = pick - high, pick - low
    count = far // grid - near // grid + 1
    cell, which = runs(near // grid, count), np.repeat(np.arange(len(piece)), count)
    pick = pick[which]
    last = cell * grid + grid - 1
    start, end = pick - np.minimum(last, far[which]), pick - np.maximum(cell * grid, near[which]) + length
    key = mix(range_hash(one, pick - cell * grid, pick - last + length, BASE_ONE) + mix(anchor[piece[which]] ^ cell.astype(U)))
    sub = mix(range_hash(two, start, end, BASE_TWO) + mix((end - start).astype(U) << U(32) | (pick - start).astype(U)))
    return which, start, end, key, sub


def cell_rows(length: int, gram: int, grid: int):
    """Cells of each block, or of its given parts, without their bytes."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            anchors, contents = b.column("anchor").to_numpy(), b.column("content").to_numpy()
            parts = b.column("parts") if "parts" in b.schema.names else None
            for texts in text_slices(b.column("bytes"), SLICE):
                mine = slice(texts.first, texts.first + len(texts))
                piece = np.arange(len(texts))
                low, high = texts.offsets[:-1], texts.offsets[1:] - length
                if parts is not None:
                    ends = parts.offsets.to_numpy()[mine.start:mine.stop + 1]
                    first, size = (parts.values.field(c).to_numpy()[ends[0]:ends[-1]] for c in ("first", "size"))
                    piece = np.repeat(piece, np.diff(ends))
                    low = texts.offsets[piece] + first
                    high = low + size - length
                which, start, end, key, sub = cells(texts.data, texts.offsets, anchors[mine].view(U), piece, low, high, length, gram, grid)
                at = piece[which]
                yield batch(key=key, sub=sub, anchor=anchors[mine][at], content=contents[mine][at], first=(start - texts.offsets[at]).astype(np.int32), size=(end - start).astype(np.int32))
    return rows


def cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the given parts of each block, on their way to the shards."""
    for b in few(batches):
        out: dict[str, list] = {c: [] for c in ("key", "anchor", "content", "first", "bytes")}
        for anchor, content, data, parts in zip(*(b.column(c).to_pylist() for c in ("anchor", "content", "bytes", "parts")), strict=True):
            for c in parts:
                out["key"].append(c["key"])
                out["anchor"].append(anchor)
                out["content"].append(content)
                out["first"].append(c["first"])
                out["bytes"].append(data[c["first"]:c["first"] + c["size"]])
        longs = {c: np.array(out[c], np.int64) for c in ("key", "anchor", "content")}
        yield batch(**longs, first=np.array(out["first"], np.int32), bytes=pa.array(out["bytes"], pa.binary()))


def shard_rows(length: int):
    """Repeated windows of each block, found in suffix arrays of the keys that
    follow each other in a partition sorted by key."""
    def search(rows: list[tuple]) -> pa.RecordBatch:
        data = np.frombuffer(b"".join(r[4] for r in rows), np.uint8)
        bounds = np.append(0, np.cumsum([len(r[4]) for r in rows]))
        at = np.flatnonzero(repeated_starts(data, bounds, length))
        piece = np.searchsorted(bounds, at, "right") - 1
        # strings that start at adjacent places of a piece make one span
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (piece[1:] != piece[:-1])
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(at))[:len(head)] - 1
        piece = piece[head]
        base = np.array([r[3] for r in rows], np.int64)[piece] - bounds[piece]
        return batch(anchor=np.array([r[1] for r in rows], np.int64)[piece], content=np.array([r[2] for r in rows], np.int64)[piece], start=at[head] + base, end=at[tail] + base + length)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for b in batches:
            for r in zip(*(b.column(c).to_pylist() for c in ("key", "anchor", "content", "first", "bytes")), strict=True):
                if held and size > SHARD_BYTES and r[0] != last:
                    yield search(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[4])
                last = r[0]
        if held:
            yield search(held)
    return rows


def kept_rows(length: int, with_text: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in few(batches):
            out: dict[str, list] = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
            lists = b.column("spans")
            ends, flat = lists.offsets.to_numpy(), lists.values
            first, last = flat.field("start").to_numpy(), flat.field("end").to_numpy()
            for i, text in enumerate(texts_of(b.column("txt"))):
                data = np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid else np.zeros(0, np.uint8)
                mine = slice(ends[i], ends[i + 1])
                steps = np.bincount(first[mine], minlength=len(data) + 1) - np.bincount(last[mine], minlength=len(data) + 1)
                gone = np.cumsum(steps)[:len(data)] > 0
                kept = data[~gone].tobytes()
                out["n_bytes"].append(len(data))
                out["n_removed"].append(int(gone.sum()))
                out["n_spans"].append(int((np.diff(np.append(0, gone.view(np.int8))) == 1).sum()))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["kept"].append(kept if with_text else None)
            got = {"id": b.column("id")} | {c: pa.array(v, pa.int64()) for c, v in list(out.items())[:3]} | {"kept_sha256": pa.array(out["kept_sha256"], pa.string())}
            if with_text:
                got["kept"] = pa.array(out["kept"], pa.binary())
            yield batch(**got)
    return rows


def shared_strings(pieces: DataFrame, length: int, gram: int, blocks_per_shard: int) -> DataFrame:
    """Strings of the given blocks that also start elsewhere in one of them, as
    spans of each block: anchor, content, start, end."""
    found, given = [], pieces
    for grid in grids(length, gram):
        cell = scratch(given.mapInArrow(cell_rows(length, gram, grid), "key long, sub long, anchor long, content long, first int, size int"), "cells")
        kinds = scratch(cell.groupBy("key", "sub").agg(F.count("*").alias("k"), F.min("anchor").alias("anchor"), F.min("content").alias("content"), F.min_by("first", "content").alias("first"), F.min("size").alias("size")), "cellkinds")
        again = cell.join(kinds.filter("k > 1").select("key", "sub"), ["key", "sub"])
        found.append(again.select("anchor", "content", F.col("first").cast("long").alias("start"), (F.col("first") + F.col("size")).cast("long").alias("end")))
        several = scratch(kinds.groupBy("key").agg(F.count("*").alias("kinds")).filter("kinds > 1"), "several")
        part = F.struct("key", "first", "size")
        differing = scratch(kinds.join(several, "key").select("anchor", "content", part.alias("part"), (F.col("kinds") > blocks_per_shard).alias("hot")), "differing")
        by_block = differing.groupBy("anchor", "content", "hot").agg(F.collect_list("part").alias("parts"))
        cut = pieces.join(by_block.filter("not hot").drop("hot"), ["anchor", "content"]).mapInArrow(cut_rows, "key long, anchor long, content long, first int, bytes binary")
        starts = cut.repartition("key").sortWithinPartitions("key").mapInArrow(shard_rows(length), "anchor long, content long, start long, end long")
        found.append(scratch(starts, "strings"))
        if differing.filter("hot").isEmpty():
            break
        given = pieces.join(by_block.filter("hot").drop("hot"), ["anchor", "content"])
    return reduce(DataFrame.union, found)


def byte_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, with_text: bool = True,
               blocks_per_shard: int = BLOCKS_PER_SHARD) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans (maximal removed
    runs), kept_sha256; with_text: kept (the remaining bytes)."""
    base = id_and_text(docs, id_col, text_col)
    # equal rows have equal fates, so a row is known by its id and text
    base = base.withColumn("rid", F.xxhash64("id", "txt"))
    found = base.filter("txt is not null").select("rid", "txt").mapInArrow(block_rows(length, gram), "anchor long, content long, rid long, place long")
    index = scratch(found.groupBy("anchor").agg(F.count("*").alias("k"), F.min("content").alias("lo"), F.max("content").alias("hi")).filter("k > 1")
                    .select("anchor", (F.col("lo") != F.col("hi")).alias("differ")), "index")
    shared = scratch(found.join(index, "anchor"), "shared")
    # one copy of each differing block; equal (anchor, content) have equal bytes, so any will do
    kinds = scratch(shared.filter("differ").groupBy("anchor", "content").agg(F.count("*").alias("k"), F.min("rid").alias("rid"), F.min_by("place", "rid").alias("place")), "kinds")
    chosen = kinds.groupBy("rid").agg(F.collect_list(F.struct("anchor", "content", "place")).alias("chosen"))
    packed = base.mapInArrow(compressed, "id long, txt binary, rid long")
    given = packed.filter("txt is not null").select("rid", "txt").join(chosen.hint("shuffle_hash"), "rid").dropDuplicates(["rid"])
    pieces = scratch(given.mapInArrow(piece_rows, "anchor long, content long, bytes binary"), "pieces")
    strings = shared_strings(pieces, length, gram, blocks_per_shard)
    # whole blocks that occur again, and strings of the others
    start, size = F.shiftright("place", 32), F.col("place").bitwiseAND(0xFFFFFFFF)
    again = shared.filter("differ").join(kinds.filter("k > 1").select("anchor", "content"), ["anchor", "content"])
    whole = shared.filter("not differ").select("rid", "place").union(again.select("rid", "place")).select("rid", start.alias("start"), (start + size).alias("end"))
    inner = kinds.filter("k = 1").select("anchor", "content", "rid", start.alias("at")).join(strings, ["anchor", "content"])
    spans = whole.union(inner.select("rid", (F.col("at") + F.col("start")).alias("start"), (F.col("at") + F.col("end")).alias("end")))
    by_row = spans.groupBy("rid").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return packed.join(by_row.hint("shuffle_hash"), "rid", "left").select("id", "txt", "spans").mapInArrow(kept_rows(length, with_text), schema)
