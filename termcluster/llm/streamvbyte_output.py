"""Token-ID output: frequency-ranked ids in byte-aligned variable-length coding.

Texts are encoded with the tokenizers library and an end id is appended to every
document. Ids are replaced by their rank by frequency in the whole corpus (ties
by id), so that common ids take one byte. A block holds the ranks of several
documents: the control bytes (two bits per rank: its length less one, four ranks
to a byte) apart from the data bytes (the ranks, little-endian, without leading
zero bytes). A dataset is a folder with

    ranks    the id of every rank (one row per id that occurs)
    blocks   shard, place of the first document, ids before it in the shard,
             ids and lengths of the documents, control, data

and ``ids``, the plain ids, with the counts of each shard from which the ranks
come. All are written by Spark as uncompressed Parquet, whose binary columns hold the
coded bytes. Shards are ranges of doc_id in ascending order, blocks ascending within
them, so ids lie in the file order of their documents. Decoding looks up the
lengths, offsets and byte places of four ranks at a time in numpy tables of 256
rows.

Encoding works on pieces between ASCII white space, which the tokenizer splits
and normalises independently (checked when it is loaded, else whole texts are
encoded), so each distinct piece or word goes to the library once per cache.

Scale: texts are range-partitioned and sorted by doc_id once; everything after
that stays in place. Frequencies and shard sizes are aggregated; what reaches
all tasks is the rank table (a row per vocabulary entry) and a row per shard.
Blocks hold at most ``BLOCK_IDS`` ids, unless one document has more.

Defined cases: a null or empty text has just the end id. Rows with a null id
come first; rows that share an id stay together, in the order of their texts' hashes.
Extra columns are ignored."""

from __future__ import annotations

import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termcluster.llm.shared import batch, id_and_text, shared_folder
from termcluster.llm.textarrays import runs, text_slices

END_ID = 2
BLOCK_IDS = 1 << 18
CACHE = 800_000


class Store:
    """Ids of the strings met so far, in one flat array. A string that is looked
    up gets the next place; ``add`` then says where its ids lie."""

    def __init__(self):
        self.place: defaultdict = defaultdict()
        self.place.default_factory = self.place.__len__
        self.start, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.ids, self.used, self.done = np.zeros(1 << 16, np.int32), 0, 0

    def places(self, lists: list[list]) -> np.ndarray:
        """Places of all strings of the lists."""
        return np.fromiter(map(self.place.__getitem__, chain.from_iterable(lists)), np.int64, sum(map(len, lists)))

    def new(self) -> list:
        """Strings that have a place and no ids yet, by place."""
        got = list(islice(reversed(self.place), len(self.place) - self.done))
        got.reverse()
        while len(self.place) > len(self.start):
            self.start, self.size = (np.append(x, np.zeros(len(x), np.int64)) for x in (self.start, self.size))
        return got

    def add(self, places: np.ndarray, ids: np.ndarray, ends: np.ndarray) -> None:
        """ends: where the ids of each of these places end in ids."""
        while self.used + len(ids) > len(self.ids):
            self.ids = np.append(self.ids, np.zeros(len(self.ids), np.int32))
        self.ids[self.used:self.used + len(ids)] = ids
        starts = np.append(0, ends)[:-1]
        self.start[places], self.size[places] = self.used + starts, ends - starts
        self.used += len(ids)
        self.done += len(places)

    def gather(self, flat: np.ndarray, lists: list[list]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the lists' places, and the end of each list's ids."""
        count = np.cumsum([len(x) for x in lists], dtype=np.int64)
        size = self.size[flat]
        return self.ids[runs(self.start[flat], size)], np.append(0, np.cumsum(size))[count]


class PieceEncoder:
    """Ids of texts by the tokenizers library, with a cache.

    A text is cut at ASCII white space. Pieces of ``PLAIN`` characters, whose classes
    and lower case are the same in every version of Unicode and which no normal form
    joins, are cut into words by the tokenizer's own pattern, and only new words go to
    the library: the end-of-word mark, which every word's last token has, tells them
    apart. All other new pieces of a slice go to the library as one text; the offsets
    that it reports give the ids of each. A text with the start of an added token is encoded whole."""

    PLAIN = regex.compile("[\x21-\x7e\xa1-\u012f\u0131-\u017f]+").fullmatch
    PROBE = ["Ab cd", "áb ́c", "It's  1st\n#2..", "ΣΣ Σ", "x\ty\x0bz\x0cq\rw", "I'LL don't've 12", "ÄÖ's Ÿ¼²x¿Š-Œ ŉ ſ's É1ß", "İ a\xa0b \xadc\x85d"]

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        suffix = spec["model"].get("end_of_word_suffix") or "\0"
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.ends_word[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.added = [t["content"][:2].encode() for t in spec.get("added_tokens", [])]
        pattern = [p["pattern"]["Regex"] for p in (spec.get("pre_tokenizer") or {}).get("pretokenizers", []) if p["type"] == "Split"]
        self.words = regex.compile(pattern[0]).findall if pattern else None
        self.pieces, self.known = Store(), Store()
        self.cached = self.words is not None and all(self.by_piece([t.encode()])[0].tolist() == self.library([t])[0] for t in self.PROBE)

    def library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def add_plain(self, places: np.ndarray, pieces: list[str]) -> None:
        split = [self.words(p.lower()) for p in pieces]
        flat = self.known.places(split)
        new = self.known.new()
        if new:
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(new)], add_special_tokens=False)[0].ids, np.int32)
            first = self.known.done
            self.known.add(np.arange(first, first + len(new)), ids, np.flatnonzero(self.ends_word[ids]) + 1)
        self.pieces.add(places, *self.known.gather(flat, split))

    def add_other(self, places: np.ndarray, pieces: list[str]) -> None:
        got = self.tokenizer.encode(" ".join(pieces), add_special_tokens=False)
        ends = np.cumsum([len(t) + 1 for t in pieces])
        first = np.array([a for a, _ in got.offsets], np.int64)
        self.pieces.add(places, np.array(got.ids, np.int32), np.searchsorted(first, ends))

    def by_piece(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and their end for each text; ASCII letters are lowered here
        already, as the tokenizer would do."""
        if len(self.pieces.place) > CACHE:
            self.pieces = Store()
        if len(self.known.place) > CACHE:
            self.known = Store()
        split = [t.lower().split() for t in texts]
        first = self.pieces.done
        flat = self.pieces.places(split)
        new = [p.decode() for p in self.pieces.new()]
        if new:
            plain = np.fromiter((p.isascii() or self.PLAIN(p) is not None for p in new), bool, len(new))
            for chosen, add in ((plain, self.add_plain), (~plain, self.add_other)):
                if chosen.any():
                    add(first + np.flatnonzero(chosen), list(compress(new, chosen.tolist())))
        return self.pieces.gather(flat, split)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, and the bounds of each."""
        raw = data.tobytes()
        at = offsets.tolist()
        texts = [raw[a:b] for a, b in zip(at, at[1:], strict=False)]
        whole = [k for k, t in enumerate(texts) if not self.cached or any(x in t for x in self.added)]
        if not whole:
            ids, ends = self.by_piece(texts)
            return ids, np.append(0, ends)
        kept = set(whole)
        ids, ends = self.by_piece([b"" if k in kept else t for k, t in enumerate(texts)]) if len(kept) < len(texts) else (np.zeros(0, np.int32), np.zeros(len(texts), np.int64))
        parts = np.split(ids, ends[:-1])
        for k, x in zip(whole, self.library([texts[k].decode() for k in whole]), strict=True):
            parts[k] = np.array(x, np.int32)
        return np.concatenate(parts).astype(np.int32), np.append(0, np.cumsum([len(x) for x in parts]))


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


# Tables of the coding: for every control byte the lengths of its four values
# and where they start among its data bytes.
LENGTHS = (np.arange(256)[:, None] >> np.arange(0, 8, 2) & 3) + 1
STARTS = np.cumsum(LENGTHS, 1) - LENGTHS
TOTAL = LENGTHS.sum(1)


def vbyte_encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    v = np.zeros(-(-len(values) // 4) * 4, "<u4")
    v[:len(values)] = values
    if not len(v) or v.max() <= 0xFFFF:  # lengths of one bit, half the bytes to choose from
        used = np.ones((len(v), 2), bool)
        used[:, 1] = v > 0xFF
        four = used[:, 1].view(np.uint8).reshape(-1, 4)
        control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
        used[len(values):] = False
        return control.tobytes(), v.astype("<u2").view(np.uint8).reshape(-1, 2)[used].tobytes()
    length = 1 + (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    four = (length - 1).reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    used = np.arange(4) < length[:, None]
    used[len(values):] = False
    return control.astype(np.uint8).tobytes(), v.view(np.uint8).reshape(-1, 4)[used].tobytes()


def vbyte_decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n values of one block."""
    c = np.frombuffer(control, np.uint8)
    first = np.cumsum(TOTAL[c]) - TOTAL[c]
    at = (first[:, None] + STARTS[c]).reshape(-1)[:n]
    length = LENGTHS[c].reshape(-1)[:n]
    raw = np.append(np.frombuffer(data, np.uint8), np.zeros(4, np.uint8))
    out = raw[at].astype(np.uint32)
    for k in range(1, 4):
        more = np.flatnonzero(length > k)
        out[more] |= raw[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def encoded_rows(path: str, end_id: int):
    """Ids of each document as little-endian 32-bit or, if all fit, 16-bit
    integers, with its place in the shard and the ids before it there. The last
    row of a shard, at place -1, holds how often each id occurs in it: the ids as
    32-bit and then the counts as 64-bit integers."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(path)
        total = np.zeros(0, np.int64)
        place = before = 0
        for b in batches:
            for texts in text_slices(b.column("txt")):
                ids, bounds = encoder.encode(texts.data, texts.offsets)
                n = len(texts)
                at = bounds[1:] + np.arange(n)
                flat = np.zeros(len(ids) + n, np.uint32)
                inside = np.ones(len(flat), bool)
                inside[at] = False
                flat[inside], flat[at] = ids, end_id
                starts = np.append(0, at + 1)
                wide = bool(len(flat)) and int(flat.max()) > 0xFFFF
                raw = memoryview(flat.astype("<u4" if wide else "<u2").tobytes())
                step = 4 if wide else 2
                got = [bytes(raw[x * step:y * step]) for x, y in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
                yield batch(id=b.column("id").slice(texts.first, n), place=np.arange(place, place + n), before=before + starts[:-1], step=np.full(n, step, np.int32), ids=pa.array(got, pa.binary()))
                place, before = place + n, before + len(flat)
                count = np.bincount(flat, minlength=len(total))
                count[:len(total)] += total
                total = count
        seen = np.flatnonzero(total)
        if len(seen):
            packed = seen.astype("<u4").tobytes() + total[seen].astype("<i8").tobytes()
            yield batch(id=pa.nulls(1, pa.int64()), place=np.array([-1]), before=np.array([before]), step=np.zeros(1, np.int32), ids=pa.array([packed], pa.binary()))
    return rows


def unpacked(ids: pa.Array, step: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), "<u4" if s == 4 else "<u2") for x, s in zip(ids, step.to_pylist(), strict=True)]


def count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of the shards' last rows, added up over a task's shards."""
    total = np.zeros(0, np.int64)
    for b in batches:
        for x in b.column("ids"):
            raw = x.as_py()
            n = len(raw) // 12
            token = np.frombuffer(raw, "<u4", n)
            total = np.append(total, np.zeros(max(int(token.max(initial=0)) + 1 - len(total), 0), np.int64))
            total[token] += np.frombuffer(raw, "<i8", n, 4 * n)
    seen = np.flatnonzero(total)
    if len(seen):
        yield batch(token=seen, k=total[seen])


def block_rows(ranks, block_ids: int):
    """Coded blocks of documents that follow each other in a shard."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank_of = ranks.value
        docs, held, n, begin, expected = [], [], 0, None, None

        def coded():
            control, data = vbyte_encode(rank_of[np.concatenate(held)])
            shard, place, before = begin
            return batch(shard=np.array([shard], np.int32), place=np.array([place]), before=np.array([before]), n=np.array([n]), docs=pa.array([docs], pa.list_(pa.int64())),
                         lengths=pa.array([[len(x) for x in held]], pa.list_(pa.int64())), control=pa.array([control], pa.binary()), data=pa.array([data], pa.binary()))

        for b in batches:
            columns = (b.column(c).to_pylist() for c in ("shard", "place", "before", "id"))
            for shard, place, before, i, ids in zip(*columns, unpacked(b.column("ids"), b.column("step")), strict=True):
                if held and ((shard, place) != expected or n + len(ids) > block_ids):
                    yield coded()
                    docs, held, n = [], [], 0
                if not held:
                    begin = shard, place, before
                docs.append(i)
                held.append(ids)
                n += len(ids)
                expected = shard, place + 1
        if held:
            yield coded()
    return rows


IDS = "id long, place long, before long, step int, ids binary"
BLOCK = "shard int, place long, before long, n long, docs array<long>, lengths array<long>, control binary, data binary"


def write_token_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", block_ids: int = BLOCK_IDS) -> str:
    """Write the dataset under ``path`` (a folder that all executors share)."""
    spark = docs.sparkSession
    base = id_and_text(docs, id_col, text_col)
    ordered = base.repartitionByRange(F.col("id").asc_nulls_first(), F.xxhash64("txt")).sortWithinPartitions(F.col("id").asc_nulls_first(), F.xxhash64("txt"))
    ids = ordered.mapInArrow(encoded_rows(tokenizer, end_id), IDS)
    ids.withColumn("shard", F.spark_partition_id()).write.parquet(f"{path}/ids")
    # from here on rows carry their shard and place, so it doesn't matter which task reads them
    ids = spark.read.schema(IDS + ", shard int").parquet(f"{path}/ids")
    counts = ids.filter("place < 0").select("ids").mapInArrow(count_rows, "token long, k long").groupBy("token").agg(F.sum("k").alias("k")).collect()
    token, k = (np.array([r[c] for r in counts], np.int64) for c in ("token", "k"))  # at most one row per vocabulary entry
    order = np.lexsort((token, -k))
    rank_of = np.zeros(int(token.max(initial=0)) + 1, np.uint32)
    rank_of[token[order]] = np.arange(len(order))
    spark.createDataFrame(list(zip(range(len(order)), token[order].tolist(), k[order].tolist(), strict=True)), "rank long, token long, k long").coalesce(1).write.parquet(f"{path}/ranks")
    ids.filter("place >= 0").mapInArrow(block_rows(spark.sparkContext.broadcast(rank_of), block_ids), BLOCK).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    return path


def decoded_rows(token_of):
    """Documents of the blocks: first id, number and crc32 of the ids."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_of.value
        for b in batches:
            for r in range(b.num_rows):
                lengths = np.array(b.column("lengths")[r].as_py(), np.int64)
                ids = tokens[vbyte_decode(b.column("control")[r].as_py(), b.column("data")[r].as_py(), int(lengths.sum()))].astype("<u4")
                ends = np.cumsum(lengths)
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * x:4 * y]) for x, y in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]
                yield batch(id=b.column("docs")[r].values, start=b.column("start")[r].as_py() + ends - lengths, n_tokens=lengths, ids_crc32=np.array(crc, np.int64))
    return rows


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the dataset: id, start (ids of all documents
    before it), n_tokens, ids_crc32."""
    blocks = spark.read.parquet(f"{path}/blocks")
    shards = blocks.groupBy("shard").agg(F.sum("n").alias("total"))
    earlier = shards.select(F.col("shard").alias("s"), (F.sum("total").over(Window.orderBy("shard")) - F.col("total")).alias("earlier"))
    table = spark.read.parquet(f"{path}/ranks").collect()
    token_of = np.zeros(len(table), np.uint32)
    for r in table:
        token_of[r.rank] = r.token
    placed = blocks.join(earlier, F.col("shard") == F.col("s")).select("docs", "lengths", "control", "data", (F.col("before") + F.col("earlier")).alias("start"))
    return placed.mapInArrow(decoded_rows(spark.sparkContext.broadcast(token_of)), "id long, start long, n_tokens long, ids_crc32 long")


def token_id_round_trip(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write the dataset to a new place in the shared folder and read it back."""
    spark = docs.sparkSession
    return read_token_ids(spark, write_token_ids(docs, f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}-tokens", tokenizer, **options))
