"""Substring dedup against reference blocks, with relative Lempel-Ziv factors.

A passage is a duplicate if the words of a ``window`` also start in a document
with a smaller id. Documents are cut into content-defined reference blocks
(``anchors``). The index keeps, for every block, the first document that
holds it. A document is then parsed greedily: its matches are the blocks that an
earlier document holds, a factor is the run of overlapping matches of one earlier
document that reaches furthest, and the next factor goes on at its end. Runs are
at least ``window`` words long; the words of the factors are removed.

Runs of blocks end where a block differs from the indexed ones of the same anchor,
and only there can a duplicate window straddle a factor boundary. Those blocks
(in one copy per distinct content) are checked window by window, and the windows
found are matches for the parse like the blocks. Two equal
windows always have the same anchor, so either their blocks are equal, or both
blocks are checked: no duplicate window is missed, however often it occurs.

Blocks are compared by (anchor, content), windows by two independent hashes:
128 bits each. A factor names its reference document, not the place in it.

Scale: five longs per block (one for some 12 words) are pre-aggregated and
shuffled; texts are shuffled compressed, by document. Every join with a hot
key has a file on either side, so that adaptive execution can split it. No
group is collected but the spans of one document.

Defined cases: a null or empty text has no words and loses none. A row without
an id is never a reference and loses nothing. Rows that share an id are judged
against smaller ids only (not against each other), and told apart by a 64-bit hash
of the text. Extra columns are ignored,
or kept in ``row``."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termcluster.llm.anchors import blocks
from termcluster.llm.shared import batch, id_and_text, scratch
from termcluster.llm.textarrays import BASE_ONE, BASE_TWO, PLAIN_WORD, U, mix, prefix_sums, range_hash, runs, text_slices, words

WINDOW, GRAM = 50, 20
# A block's place in one long: first word, windows in the block.
COUNT_BITS = 8
FACTOR = "array<struct<start:int,length:int,ref:bigint>>"


def block_rows(window: int, gram: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, keys = b.column("id").to_numpy(), b.column("tkey").to_numpy()
            for texts in text_slices(b.column("txt")):
                w = words(texts, PLAIN_WORD)
                found = blocks(w.hash, w.bounds, window, gram)
                at = texts.first + found.text
                start = found.start - w.bounds[found.text]
                count = found.end - found.start - window + 1
                yield batch(anchor=found.anchor, content=found.content, id=ids[at], tkey=keys[at], place=start << COUNT_BITS | count)
    return rows


def compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """txt as zstd frames: a third less to shuffle than by Spark's codec."""
    press = zstandard.ZstdCompressor(level=1).compress
    for b in batches:
        at = b.schema.get_field_index("txt")
        packed = pa.array([press(x.as_buffer()) if x.is_valid else None for x in b.column(at).cast(pa.large_binary())], pa.binary())
        yield b.set_column(at, "txt", packed)


def texts_of(column: pa.Array) -> pa.Array:
    expand = zstandard.ZstdDecompressor().decompress
    return pa.array([expand(x.as_buffer()) if x.is_valid else None for x in column], pa.large_binary())


def window_rows(window: int):
    """The windows of the given blocks of each document, by two hashes."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, keys = b.column("id").to_numpy(), b.column("tkey").to_numpy()
            lists = b.column("starts")
            places, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
            for texts in text_slices(texts_of(b.column("txt"))):
                w = words(texts, PLAIN_WORD)
                one, two = prefix_sums(w.hash, BASE_ONE), prefix_sums(mix(w.hash + U(1)), BASE_TWO)
                mine = slice(ends[texts.first], ends[texts.first + len(texts)])
                doc = np.repeat(np.arange(len(texts)), np.diff(ends[texts.first:texts.first + len(texts) + 1]))
                start = places[mine] >> COUNT_BITS
                count = places[mine] & ((1 << COUNT_BITS) - 1)
                at = runs(w.bounds[doc] + start, count)
                doc = np.repeat(doc, count)
                at, first = np.unique(at, return_index=True)
                doc = doc[first]
                yield batch(h1=mix(range_hash(one, at, at + window, BASE_ONE)), h2=mix(range_hash(two, at, at + window, BASE_TWO)),
                            id=ids[texts.first + doc], tkey=keys[texts.first + doc], start=at - w.bounds[doc])
    return rows


def greedy_factors(start: np.ndarray, end: np.ndarray, ref: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, ...]:
    """The greedy parse of documents that lie one after the other: start, end,
    ref and document of each factor, from their matches in that form.

    Matches of one reference that overlap or touch are a run. At the first word
    not parsed yet that a match covers, the factor is the run that reaches
    furthest (then the one that starts first, then the smallest reference); the
    next one goes on at its end, where a run may have started before."""
    if not len(start):
        return start, end, ref, doc
    order = np.lexsort((start, ref, doc))
    s, e, r, d = (x[order].astype(np.int64) for x in (start, end, ref, doc))
    new = np.ones(len(s), bool)
    new[1:] = (d[1:] != d[:-1]) | (r[1:] != r[:-1])
    lift = np.cumsum(new) * (e.max() + 1)
    reach = np.maximum.accumulate(e + lift) - lift
    new[1:] |= s[1:] > reach[:-1]
    first = np.flatnonzero(new)
    s, e, r, d = s[first], reach[np.append(first[1:], len(s)) - 1], r[first], d[first]
    order = np.lexsort((r, -e, s))
    s, e, r, d = s[order], e[order], r[order], d[order]
    further = np.append(True, e[1:] > np.maximum.accumulate(e)[:-1])  # no other run is ever the choice
    s, e, r, d = s[further], e[further], r[further], d[further]
    starts, ends, taken, begin, at, i = s.tolist(), e.tolist(), [], [], -1, 0
    while i < len(starts):
        at = max(at, starts[i])
        while i + 1 < len(starts) and starts[i + 1] <= at:
            i += 1
        begin.append(at)
        taken.append(i)
        at, i = ends[i], i + 1
    return np.array(begin), e[taken], r[taken], d[taken]


def kept_rows(with_row: bool, with_text: bool):
    """Parse each document into factors and remove their words."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column, spans = texts_of(b.column("txt")), b.column("spans")
            ends, flat = spans.offsets.to_numpy(), spans.values
            start, end, ref = (flat.field(k).to_numpy() for k in ("start", "end", "ref"))
            n_words, n_removed, digests, kept_text, factors = [], [], [], [], []
            for texts in text_slices(column):
                w = words(texts, PLAIN_WORD)
                total = len(w.start)
                mine = slice(ends[texts.first], ends[texts.first + len(texts)])
                counts = np.diff(ends[texts.first:texts.first + len(texts) + 1])
                doc = np.repeat(np.arange(len(texts)), counts)
                f_start, f_end, f_ref, f_doc = greedy_factors(w.bounds[doc] + start[mine], w.bounds[doc] + end[mine], ref[mine], doc)
                steps = np.bincount(f_start, minlength=total + 1) - np.bincount(f_end, minlength=total + 1)
                keep = np.cumsum(steps)[:total] == 0
                kept = np.flatnonzero(keep)
                length = w.end[kept] - w.start[kept] + 1
                data = np.append(texts.data, np.uint8(32))[runs(w.start[kept], length)]
                ends_of_words = np.cumsum(length)
                data[ends_of_words - 1] = 32
                bounds = np.append(0, ends_of_words)[np.searchsorted(kept, w.bounds)]
                view = memoryview(data)
                before = np.append(0, np.cumsum(keep))[w.bounds]
                words_in = np.diff(w.bounds)
                removed = words_in - np.diff(before)
                n_words.append(words_in)
                n_removed.append(removed)
                for i in range(len(texts)):
                    own = view[bounds[i]:max(bounds[i], bounds[i + 1] - 1)]
                    digests.append(hashlib.sha256(own).hexdigest())
                    if with_text:
                        kept_text.append(bytes(own) if removed[i] else None)
                if with_text:
                    offsets = pa.array(np.searchsorted(f_doc, np.arange(len(texts) + 1)), pa.int32())
                    parts = [pa.array(x, t) for x, t in ((f_start - w.bounds[f_doc], pa.int32()), (f_end - f_start, pa.int32()), (f_ref, pa.int64()))]
                    factors.append(pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(parts, ["start", "length", "ref"])))
            out = {"id": b.column("id"), "n_words": np.concatenate(n_words), "n_removed": np.concatenate(n_removed), "kept_sha256": pa.array(digests, pa.string())}
            if with_text:
                out["kept_text"] = pa.array(kept_text, pa.binary()).cast(pa.string())
                out["factors"] = pa.concat_arrays(factors)
            if with_row:
                out["row"] = b.column("row")
            yield batch(**out)
    return rows


def duplicate_spans(base: DataFrame, packed: DataFrame, window: int, gram: int) -> DataFrame:
    """id, tkey, start, end, ref: the words start..end-1 of a document occur
    in the same order in document ref < id; together all duplicate windows."""
    given = base.filter("id is not null").select("id", "tkey", "txt")
    found = given.mapInArrow(block_rows(window, gram), "anchor long, content long, id long, tkey long, place long")
    index = scratch(
        found.groupBy("anchor").agg(F.min("content").alias("lo"), F.max("content").alias("hi"), F.min("id").alias("ref"), F.max("id").alias("last"))
        .filter("ref < last").select("anchor", "ref", (F.col("lo") != F.col("hi")).alias("differ")), "index")
    shared = scratch(found.join(index, "anchor").filter("differ or ref < id"), "shared")
    kinds = scratch(shared.filter("differ").groupBy("anchor", "content").agg(F.min("id").alias("own")), "kinds")
    differing = shared.filter("differ").join(kinds, ["anchor", "content"]).select("id", "tkey", "place", "own")
    whole = shared.filter("not differ").select("id", "tkey", "place", "ref").union(differing.filter("own < id").select("id", "tkey", "place", F.col("own").alias("ref")))
    start = F.shiftright("place", COUNT_BITS).cast("int")
    count = F.col("place").bitwiseAND((1 << COUNT_BITS) - 1).cast("int")
    spans = whole.select("id", "tkey", start.alias("start"), (start + count + F.lit(window - 1)).alias("end"), "ref")
    # the boundary check: one copy of each block that differs
    checked = differing.filter("own = id").groupBy("id", "tkey").agg(F.collect_set("place").alias("starts"))
    at_ends = (packed.select("id", "tkey", "txt").join(checked.hint("shuffle_hash"), ["id", "tkey"])
               .mapInArrow(window_rows(window), "h1 long, h2 long, id long, tkey long, start long"))
    firsts = scratch(at_ends.groupBy("h1", "h2").agg(F.min("id").alias("ref"), F.max("id").alias("last")).filter("ref < last").select("h1", "h2", "ref"), "firsts")
    straddling = at_ends.join(firsts, ["h1", "h2"]).filter("ref < id")
    return spans.union(straddling.select("id", "tkey", F.col("start").cast("int"), (F.col("start") + window).cast("int"), "ref"))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
                    with_text: bool = True, keep_row: bool = False) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept_sha256 (of the kept
    words joined by one space); with_text: kept_text (null if nothing was
    removed) and factors (start, length in words, ref: the earlier document);
    keep_row: the whole input row as the struct ``row``."""
    if not 1 <= gram <= window < gram + (1 << COUNT_BITS) - 1:
        raise ValueError("needs 1 <= gram <= window < gram + 255")
    base = id_and_text(docs, id_col, text_col, keep_row).withColumn("tkey", F.xxhash64("txt"))
    fields = [f if f.name != "txt" else T.StructField("txt", T.BinaryType()) for f in base.schema.fields]
    packed = base.mapInArrow(compressed, T.StructType(fields))
    slim = packed if not keep_row else base.drop("row").mapInArrow(compressed, T.StructType([f for f in fields if f.name != "row"]))
    spans = duplicate_spans(base, slim, window, gram)
    by_doc = spans.groupBy("id", "tkey").agg(F.collect_set(F.struct("start", "end", "ref")).alias("spans"))
    schema = "id long, n_words long, n_removed long, kept_sha256 string" + f", kept_text string, factors {FACTOR}" * with_text
    out = T.StructType(T._parse_datatype_string(schema).fields + [f for f in base.schema.fields if f.name == "row"])
    return packed.join(by_doc.hint("shuffle_hash"), ["id", "tkey"], "left").mapInArrow(kept_rows(keep_row, with_text), out)
