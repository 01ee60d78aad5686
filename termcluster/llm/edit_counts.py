"""Token counts that follow edits, by pre-token segment trees.

A document is split into pre-tokens by the pattern of byte-level BPE, and every
``LEAF`` pre-tokens form a leaf. Its segment tree holds, for every node, the
bytes and the tokens below it: node 1 is the root, nodes 2k and 2k+1 are the
children of k. The tree is the document's state; it is an array column and can
be stored.

An edit replaces the bytes start..end-1 by other text. The tree finds the leaves
that it touches; they are split again, with one leaf of context before and as many
leaves after as it takes until the new pre-tokens meet an old leaf boundary again.
Only that region is encoded; its leaves replace the old ones and the sums above
are updated. The pattern looks at most one character past a pre-token, so where
a new pre-token boundary falls on an old leaf boundary and the same text follows,
everything after it is unchanged.

A region may take more or fewer leaves than before; leaves keep their place, and
the last leaf of the region takes what is left over. Once it holds over ``SPLIT``
times as many pre-tokens as planned, the tree is built anew.

Scale: one pass over the rows, no shuffle: a document's edits are a column of
its row. Counts of pre-tokens are cached (at most ``CACHE`` in a task).

Defined cases: a null or empty text has an empty tree (one leaf of nothing); edits
are applied from the last to the first place and must not overlap; their places
are cut to the text's length and moved back to a character's start; null edits or
replacements count as none or as the empty text. Extra columns are ignored."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termcluster.llm.pretokens import PATTERN, Odd, Splitter, odd_characters
from termcluster.llm.shared import batch

LEAF = 64
SPLIT = 8
CACHE = 300_000
EDITS = "array<struct<start:int,end:int,text:string>>"


class Counter:
    """Number of tokens of pre-tokens, by a rank file of byte-level BPE."""

    def __init__(self, path: str, odd: Odd):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.ranks = ranks
        self.split = Splitter(odd)
        self.known: dict[str, int] = {}

    def counts(self, pretokens: list[str]) -> list[int]:
        if len(self.known) > CACHE:
            self.known.clear()
        new = list(set(pretokens).difference(self.known))
        for t in new:
            self.known[t] = 1 if t.encode() in self.ranks else len(self.encoding.encode_ordinary(t))
        return list(map(self.known.__getitem__, pretokens))

    def leaves(self, text: str) -> list[tuple[int, int, int]]:
        """bytes, tokens, pre-tokens of each leaf of a text."""
        pre = self.split(text)
        n = self.counts(pre)
        size = list(map(len, pre)) if text.isascii() else [len(p.encode()) for p in pre]
        return [(sum(size[k:k + LEAF]), sum(n[k:k + LEAF]), len(n[k:k + LEAF])) for k in range(0, len(pre), LEAF)]


@lru_cache(maxsize=1)
def counter(path: str, odd: Odd) -> Counter:
    return Counter(path, odd)


class Tree:
    """Sums of bytes and tokens over the leaves of one document."""

    def __init__(self, leaves: list[tuple[int, int, int]]):
        self.width = 1 << max(0, (len(leaves) - 1).bit_length())
        self.sums = np.zeros((2 * self.width, 2), np.int64)
        self.pre = [x[2] for x in leaves] + [0] * (self.width - len(leaves))
        if leaves:
            self.sums[self.width:self.width + len(leaves)] = [x[:2] for x in leaves]
        level = self.width
        while level > 1:
            half = level // 2
            self.sums[half:level] = self.sums[level:2 * level].reshape(half, 2, 2).sum(1)
            level = half

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds a byte (the last one with text for the end),
        and where the leaf begins."""
        place = max(0, min(place, int(self.sums[1, 0]) - 1))
        node, before = 1, 0
        while node < self.width:
            node *= 2
            if before + self.sums[node, 0] <= place:
                before += int(self.sums[node, 0])
                node += 1
        return node - self.width, before

    def replace(self, first: int, last: int, leaves: list[tuple[int, int, int]]) -> None:
        """Leaves first..last now hold these; sums above are updated."""
        room = last - first + 1
        if len(leaves) > room:
            rest = leaves[room - 1:]
            leaves = [*leaves[:room - 1], tuple(map(sum, zip(*rest, strict=True)))]
        leaves = leaves + [(0, 0, 0)] * (room - len(leaves))
        self.sums[self.width + first:self.width + last + 1] = [x[:2] for x in leaves]
        self.pre[first:last + 1] = [x[2] for x in leaves]
        a, b = (self.width + first) // 2, (self.width + last) // 2
        while a:
            for node in range(a, b + 1):
                self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]
            a, b = a // 2, b // 2


def char_start(data: bytes, place: int) -> int:
    while 0 < place < len(data) and data[place] & 0xC0 == 0x80:
        place -= 1
    return place


def apply_edit(tree: Tree, data: bytes, start: int, end: int, text: str, count: Counter) -> tuple[Tree, bytes, int]:
    """Tree and text after one edit, and how many bytes were encoded again."""
    start = char_start(data, max(0, min(start, len(data))))
    end = char_start(data, max(start, min(end, len(data))))
    new = data[:start] + text.encode() + data[end:]
    if not data:
        return Tree(count.leaves(new.decode())), new, len(new)
    shift = len(new) - len(data)
    first, begin = tree.find(start)
    if begin:
        first, begin = tree.find(begin - 1)
    last, at = tree.find(max(end - 1, start))
    close = at + int(tree.sums[tree.width + last, 0])
    while True:
        if close < len(data):  # one more leaf, as the text before decides where its first pre-token starts
            last, at = tree.find(close)
            close = at + int(tree.sums[tree.width + last, 0])
        # with the character that follows, on which the last pre-token may depend
        beyond = min(len(data), close + 256)
        while beyond < len(data) and data[beyond] & 0xC0 == 0x80:
            beyond += 1
        region = new[begin:beyond + shift].decode()
        pre = count.split(region)
        size = [len(p.encode()) for p in pre]
        ends = np.cumsum(size)
        stop = close + shift - begin
        if close == len(data):
            k = len(pre)
            break
        k = int(np.searchsorted(ends, stop))
        # boundaries must agree at the end of the last leaf, beyond all changed text
        if close >= end and k < len(ends) and ends[k] == stop and k + 1 < len(pre):
            k += 1
            break
    n = count.counts(pre[:k])
    leaves = [(sum(size[i:min(k, i + LEAF)]), sum(n[i:i + LEAF]), len(n[i:i + LEAF])) for i in range(0, k, LEAF)]
    encoded = sum(size[:k])
    tree.replace(first, last, leaves)
    if max(tree.pre) > SPLIT * LEAF:
        tree = Tree(count.leaves(new.decode()))
        encoded = len(new)
    return tree, new, encoded


def edit_rows(path: str, odd: Odd, with_tree: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path, odd)
        for b in batches:
            out: dict[str, list] = {c: [] for c in ("n_tokens", "n_edits", "n_bytes_encoded", "n_tokens_after", "n_bytes_after")}
            trees, texts = [], []
            for text, edits in zip(b.column("txt"), b.column("edits").to_pylist(), strict=True):
                text = text.as_py() or ""
                tree, data, encoded = Tree(count.leaves(text)), text.encode(), 0
                before = tree.tokens
                known = sorted((e for e in edits or () if e and e["start"] is not None and e["end"] is not None), key=lambda e: (-e["start"], -e["end"]))
                for e in known:
                    tree, data, again = apply_edit(tree, data, e["start"], e["end"], e["text"] or "", count)
                    encoded += again
                for c, v in zip(out, (before, len(known), encoded, tree.tokens, len(data)), strict=True):
                    out[c].append(v)
                if with_tree:
                    trees.append(tree.sums[:, 1].tolist())
                    texts.append(data.decode())
            got = {"id": b.column("id")} | {c: pa.array(v, pa.int64()) for c, v in out.items()}
            if with_tree:
                got |= {"tree": pa.array(trees, pa.list_(pa.int64())), "text_after": pa.array(texts, pa.string())}
            yield batch(**got)
    return rows


def edited_counts(docs: DataFrame, edits: Column, path: str, id_col: str = "doc_id", text_col: str = "text", with_tree: bool = True) -> DataFrame:
    """One row per document: id, n_tokens before, n_edits, n_bytes_encoded (again,
    for the edits), n_tokens_after, n_bytes_after; with_tree: the tree's token
    sums and the edited text. edits: a column of type EDITS over docs, places
    in UTF-8 bytes of the text."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("txt"), edits.cast(EDITS).alias("edits"))
    schema = "id long, n_tokens long, n_edits long, n_bytes_encoded long, n_tokens_after long, n_bytes_after long" + ", tree array<long>, text_after string" * with_tree
    return rows.mapInArrow(edit_rows(path, odd_characters(), with_tree), schema)


def line_edits(text: Column) -> Column:
    """Edits of a text: every line that repeats the one before it goes, with
    its line break."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    zero = F.struct(F.lit(0).alias("at"), F.lit(None).cast("string").alias("last"), F.array().cast(EDITS).alias("found"))

    def step(a, x):
        end = a.at + F.octet_length(x)
        gone = F.struct((a.at - 1).alias("start"), end.alias("end"), F.lit("").alias("text"))
        return F.struct((end + 1).alias("at"), x.alias("last"), F.when(x == a.last, F.concat(a.found, F.array(gone))).otherwise(a.found).alias("found"))

    return F.aggregate(lines, zero, step, lambda a: a.found)
