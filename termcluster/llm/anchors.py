"""Content-defined blocks of sequences, shared by the substring operators.

Every window of ``window`` consecutive values picks an anchor: the leftmost
of its ``gram``-long sub-windows whose (truncated) hash is smallest. Equal
windows pick equal anchors at equal offsets, wherever they occur. Adjacent
windows of a text with one anchor form a block; so a block is defined by its
content, equal passages are cut into equal blocks but for their two ends, and
two equal windows always lie in blocks that have the same anchor hash."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from termcluster.llm.textarrays import BASE_ONE, BASE_TWO, U, mix, prefix_sums, range_hash, window_starts

POSITION_BITS = 30  # values of one slice; a longer slice cannot be held anyway


@dataclass
class Blocks:
    """Block i: values start[i]:end[i] of text[i]; end - start - window + 1
    windows, all with the anchor hash anchor[i]. content: a second,
    independent hash over the whole block."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    anchor: np.ndarray
    content: np.ndarray


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """min(values[i:i+width]) for every i with a whole window."""
    out, size = values, 1
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return out if size == width else np.minimum(out[:size - width], out[width - size:])


def blocks(values: np.ndarray, bounds: np.ndarray, window: int, gram: int) -> Blocks:
    """Blocks of the texts values[bounds[i]:bounds[i+1]]."""
    first = window_starts(bounds, window)
    none = np.zeros(0, np.int64)
    if not len(first):
        return Blocks(none, none, none, np.zeros(0, U), np.zeros(0, U))
    one = prefix_sums(values, BASE_ONE)
    at = np.arange(len(values) - gram + 1)
    key = mix(range_hash(one, at, at + gram, BASE_ONE))
    key = (key >> U(POSITION_BITS)) << U(POSITION_BITS) | at.astype(U)
    pick = (sliding_min(key, window - gram + 1)[first] & U((1 << POSITION_BITS) - 1)).astype(np.int64)
    new = np.ones(len(first), bool)
    new[1:] = (pick[1:] != pick[:-1]) | (first[1:] != first[:-1] + 1)
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(first)) - 1
    start, end, pick = first[begin], first[last] + window, pick[begin]
    two = prefix_sums(mix(values + U(1)), BASE_TWO)
    anchor = mix(range_hash(one, pick, pick + gram, BASE_ONE))
    # the anchor's place in the block is part of the content hash
    content = mix(range_hash(two, start, end, BASE_TWO) + mix((end - start).astype(U) << U(32) | (pick - start).astype(U)))
    return Blocks(np.searchsorted(bounds, start, "right") - 1, start, end, anchor, content)
