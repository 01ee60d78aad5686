"""BPE encoding and decoding by batched numpy merge rounds.

Texts are split into pre-tokens by the pattern of byte-level BPE, with the tokenizers
library's classes of characters (``pretokens``). The distinct
pre-tokens of a batch are merged all at once: their symbols lie in one flat
array; a round looks up the rank of every adjacent pair by binary search over
the sorted pair keys, and each word merges all places of its lowest-ranked pair
(overlapping ones from the left). Words without a ranked pair leave the array. Ids
of a text are the gathered ids of its pre-tokens, and decoding is one gather
from a byte table.

Pre-tokens longer than ``LONG`` symbols would need about as many rounds as
symbols; they are merged one by one with a heap, by the same rule.

A task holds one slice of texts, the vocabulary and a cache of at most
``CACHE`` pre-tokens. There is no shuffle.

Defined cases: a null or empty text has no ids and decodes to the empty text;
added tokens of the vocabulary (such as an end-of-text mark) are matched in
texts first, as the tokenizers library does by default. Rows are judged alone,
also with repeated or null ids. Extra columns are ignored, or kept in
``row``."""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from termcluster.llm.pretokens import Odd, Splitter, odd_characters
from termcluster.llm.shared import batch, id_and_text
from termcluster.llm.textarrays import runs, text_slices

LONG = 256
CACHE = 200_000
NO_RANK = np.int64(1 << 60)


def byte_letters() -> list[str]:
    """Letter that a byte-level vocabulary writes for each byte: printable
    Latin-1 characters stand for themselves, the others follow from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Vocabulary:
    """Tables of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        letters = byte_letters()
        self.byte_id = np.array([ids[c] for c in letters], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left = np.array([ids[a] for a, _ in pairs], np.int64)
        right = np.array([ids[b] for _, b in pairs], np.int64)
        merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        key = left << 32 | right
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.merged = key[order], order, merged[order]
        self.pair_rank = {(int(a), int(b)): (r, int(m)) for r, (a, b, m) in enumerate(zip(left, right, merged, strict=True))}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        value = {c: b for b, c in enumerate(letters)}
        n = max([*ids.values(), *self.added.values()]) + 1
        text = [b""] * n
        for token, i in ids.items():
            text[i] = bytes(value[c] for c in token)
        for token, i in self.added.items():
            text[i] = token.encode()
        self.length = np.array([len(t) for t in text], np.int64)
        self.bounds = np.append(0, np.cumsum(self.length))
        self.bytes = np.frombuffer(b"".join(text), np.uint8)

    def pair_at(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of each pair among the sorted keys, -1 if it never merges."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, at, -1)


def merge_rounds(v: Vocabulary, symbol: np.ndarray, word: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge the symbols of words (word: ascending word numbers) until no pair
    has a rank. Returns the final symbols and the bounds of each word."""
    done_symbol, done_word = [], []
    found = np.where(word[1:] == word[:-1], v.pair_at(symbol[:-1], symbol[1:]), -1) if len(symbol) else np.zeros(0, np.int64)
    while len(symbol):
        rank = np.append(np.where(found >= 0, v.rank[found], NO_RANK), NO_RANK)
        start = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        size = np.diff(np.append(start, len(word)))
        best = np.minimum.reduceat(rank, start)
        active = np.repeat(best < NO_RANK, size)
        if not active.all():
            done_symbol.append(symbol[~active])
            done_word.append(word[~active])
            pairs = np.append(found, -1)[active]
            symbol, word, rank, best, size = symbol[active], word[active], rank[active], best[best < NO_RANK], size[best < NO_RANK]
            if not len(symbol):
                break
        else:
            pairs = np.append(found, -1)
        chosen = np.flatnonzero(rank == np.repeat(best, size))
        # of overlapping places, as in a run of one symbol, every second merges
        head = np.flatnonzero(np.append(True, np.diff(chosen) != 1))
        offset = np.arange(len(chosen)) - np.repeat(head, np.diff(np.append(head, len(chosen))))
        chosen = chosen[offset % 2 == 0]
        symbol[chosen] = v.merged[pairs[chosen]]
        keep = np.ones(len(symbol), bool)
        keep[chosen + 1] = False
        # only pairs next to a merge change
        place = (np.cumsum(keep) - 1)[chosen]
        symbol, word, found = symbol[keep], word[keep], pairs[keep][:-1]
        new = np.concatenate([place, place - 1])
        new = new[(new >= 0) & (new < len(found))]
        found[new] = np.where(word[new + 1] == word[new], v.pair_at(symbol[new], symbol[new + 1]), -1)
    symbol = np.concatenate(done_symbol) if done_symbol else np.zeros(0, np.int64)
    word = np.concatenate(done_word) if done_word else np.zeros(0, np.int64)
    order = np.argsort(word, kind="stable")
    return symbol[order], np.searchsorted(word[order], np.arange(n_words + 1))


def merge_long(v: Vocabulary, symbol: list[int]) -> list[int]:
    """The same merges for one long word: lowest rank first, then leftmost."""
    n = len(symbol)
    after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = [(*v.pair_rank[p], i, p) for i in range(n - 1) if (p := (symbol[i], symbol[i + 1])) in v.pair_rank]
    heap = [(r, i, m, p) for r, m, i, p in heap]
    heapq.heapify(heap)
    while heap:
        _, i, m, p = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or (symbol[i], symbol[j]) != p:
            continue
        symbol[i], alive[j], after[i] = m, False, after[j]
        if after[j] < n:
            before[after[j]] = i
        for a in (before[i], i):
            if a >= 0 and after[a] < n and (q := (symbol[a], symbol[after[a]])) in v.pair_rank:
                r, m2 = v.pair_rank[q]
                heapq.heappush(heap, (r, a, m2, q))
    return [s for s, x in zip(symbol, alive, strict=True) if x]


class Encoder:
    """Ids of pre-tokens, cached: a growing flat array and a place for each."""

    def __init__(self, v: Vocabulary, odd: Odd):
        self.v, self.split = v, Splitter(odd)
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.used = np.zeros(1 << 16, np.int32), 0
        self.bounds = np.zeros(1, np.int64)
        self.written: list[str] = []

    def add(self, tokens: list[str]) -> None:
        """Encode pre-tokens that are not in the cache."""
        data = [t.encode() for t in tokens]
        length = np.array([len(d) for d in data], np.int64)
        symbol = self.v.byte_id[np.frombuffer(b"".join(data), np.uint8)]
        short = length <= LONG
        mine = np.repeat(short, length)
        word = np.repeat(np.arange(len(data)), length)
        got, bounds = merge_rounds(self.v, symbol[mine], word[mine], len(data))
        if not short.all():
            pieces = np.split(got, bounds[1:-1])
            for k in np.flatnonzero(~short):
                pieces[k] = np.array(merge_long(self.v, self.v.byte_id[np.frombuffer(data[k], np.uint8)].tolist()), np.int64)
            bounds = np.append(0, np.cumsum([len(x) for x in pieces]))
            got = np.concatenate(pieces)
        self.append(tokens, got, bounds)

    def append(self, tokens: list[str], ids: np.ndarray, bounds: np.ndarray) -> None:
        while self.used + len(ids) > len(self.ids):
            self.ids = np.append(self.ids, np.zeros(len(self.ids), np.int32))
        self.ids[self.used:self.used + len(ids)] = ids
        first = len(self.place)
        self.place.update(zip(tokens, range(first, first + len(tokens)), strict=True))
        self.bounds = np.append(self.bounds, bounds[1:] + self.used)
        self.used += len(ids)
        text = ids.tolist()
        ends = bounds.tolist()
        self.written += [",".join(map(str, text[a:b])) for a, b in zip(ends, ends[1:], strict=False)]

    def pretokens(self, text: str) -> list[str]:
        v = self.v
        if v.special is None or not any(s in text for s in v.added):
            return self.split(text)
        out = []
        for piece in v.special.split(text):
            if piece in v.added:
                out.append("\0special" + piece)
            else:
                out += self.split(piece)
        return out

    def places(self, texts: list[str]) -> list[np.ndarray]:
        """Cache places of the pre-tokens of each text."""
        if len(self.place) > CACHE:
            self.clear()
        split = [self.pretokens(t) for t in texts]
        new = list({t for tokens in split for t in tokens}.difference(self.place))
        special = [t for t in new if t.startswith("\0special")]
        if special:
            ids = np.array([self.v.added[t[8:]] for t in special], np.int64)
            self.append(special, ids, np.arange(len(ids) + 1))
            new = [t for t in new if not t.startswith("\0special")]
        if new:
            self.add(new)
        return [np.fromiter(map(self.place.__getitem__, tokens), np.int64, len(tokens)) for tokens in split]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(path: str, texts: list[str]) -> list[np.ndarray]:
    """Ids of texts; for use without Spark."""
    e = Encoder(vocabulary(path), odd_characters())
    out = []
    for p in e.places(texts):
        out.append(e.ids[runs(e.bounds[p], e.bounds[p + 1] - e.bounds[p])])
    return out


def decode_bytes(v: Vocabulary, ids: np.ndarray) -> np.ndarray:
    return v.bytes[runs(v.bounds[ids], v.length[ids])]


def bpe_rows(path: str, odd: Odd, with_ids: bool, with_row: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        encoder = Encoder(v, odd)
        for b in batches:
            n_tokens, ids_sha, text_sha, all_ids, decoded = [], [], [], [], []
            for texts in text_slices(b.column("txt")):
                strings = [bytes(texts.data[i:j]).decode() for i, j in zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist(), strict=True)]
                places = encoder.places(strings)
                flat = np.concatenate(places) if places else np.zeros(0, np.int64)
                bounds = encoder.bounds
                size = bounds[flat + 1] - bounds[flat]
                ids = encoder.ids[runs(bounds[flat], size)]
                ends = np.append(0, np.cumsum(size))[np.append(0, np.cumsum([len(p) for p in places]))]
                data = decode_bytes(v, ids)
                byte_ends = np.append(0, np.cumsum(v.length[ids]))[ends]
                written = encoder.written
                for k, p in enumerate(places):
                    ids_sha.append(hashlib.sha256(",".join([written[x] for x in p.tolist()]).encode()).hexdigest())
                    text = data[byte_ends[k]:byte_ends[k + 1]].tobytes()
                    text_sha.append(hashlib.sha256(text.decode("utf-8", "replace").encode()).hexdigest())
                    if with_ids:
                        decoded.append(text.decode("utf-8", "replace"))
                n_tokens.append(np.diff(ends))
                if with_ids:
                    all_ids += np.split(ids, ends[1:-1])
            out = {"id": b.column("id"), "n_tokens": np.concatenate(n_tokens), "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())}
            if with_ids:
                out |= {"ids": pa.array(all_ids, pa.list_(pa.int32())), "decoded": pa.array(decoded, pa.string())}
            if with_row:
                out["row"] = b.column("row")
            yield batch(**out)
    return rows


def bpe_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True, keep_row: bool = False) -> DataFrame:
    """One row per document: id, n_tokens, ids_sha256 (decimal ids joined by
    commas), decoded_sha256; with_ids: the ids and the decoded text."""
    base = id_and_text(docs, id_col, text_col, keep_row)
    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_ids
    fields = T._parse_datatype_string(schema).fields + [f for f in base.schema.fields if f.name == "row"]
    return base.mapInArrow(bpe_rows(path, odd_characters(), with_ids, keep_row), T.StructType(fields))
