"""Pre-tokens of byte-level BPE, by the character classes of the tokenizers library.

The pattern is the same everywhere, but the letters and numbers of Unicode grow with
its versions, and those of the regex module are newer than the library's. One probe of
the library over all code points gives the differing ones. Texts that hold one of them
are split by a pattern with the library's classes, all others by the plain one."""

from __future__ import annotations

from functools import lru_cache

import regex

# Fixed value: the pattern of byte-level BPE pre-tokens.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CLASSES = {"letter": r"\p{L}", "number": r"\p{N}", "space": r"\s"}

Odd = tuple[tuple[str, str], ...]


def ranges(points: list[int]) -> str:
    """Ascending code points as the inside of a character class."""
    out, k = [], 0
    while k < len(points):
        j = k
        while j + 1 < len(points) and points[j + 1] == points[j] + 1:
            j += 1
        out.append(f"\\U{points[k]:08X}-\\U{points[j]:08X}")
        k = j + 1
    return "".join(out)


@lru_cache(maxsize=1)
def odd_characters() -> Odd:
    """The code points whose class isn't the regex module's, by the class that the
    library gives them. All code points in order are one probe: a run of one class is
    one pre-token, whose class then shows by what its first character joins."""
    from tokenizers import pre_tokenizers

    cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    every = "".join(map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x110000)]))
    found: dict[str, list[int]] = {k: [] for k in (*CLASSES, "other")}
    for _, (a, b) in cut(every):
        mine = next((k for k, c in (("letter", "x"), ("number", "1"), ("other", "!")) if len(cut(c + every[a])) == 1), "space")
        run = every[a:b]
        if mine == "other":
            differ = regex.finditer(r"[\s\p{L}\p{N}]", run)
        else:
            differ = regex.finditer(f"[^{CLASSES[mine]}]", run)
        found[mine] += [ord(m[0]) for m in differ]
    return tuple((k, ranges(v)) for k, v in found.items())


class Splitter:
    """Cut texts into pre-tokens. odd: ``odd_characters()``, found once by the driver."""

    def __init__(self, odd: Odd):
        self.plain = regex.compile(PATTERN).findall
        own = dict(odd)
        every = "".join(own.values())
        self.odd = regex.compile(f"[{every}]").search if every else None
        if every:
            letter, number, space = (f"[[{p}--[{every}]]{own[k] and f'[{own[k]}]'}]" for k, p in CLASSES.items())
            other = f"[^{letter}{number}{space}]"
            self.exact = regex.compile(rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?{other}+|{space}+(?![^{space}])|{space}+").findall

    def __call__(self, text: str) -> list[str]:
        if self.odd is None or text.isascii() or not self.odd(text):
            return self.plain(text)
        return self.exact(text)
