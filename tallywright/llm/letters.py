"""Texts as arrays of characters, for operators that look at each character of a batch at once."""

from __future__ import annotations

from functools import cache

import numpy as np

SCRIPTS = (
    ("Latin", ((0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF))),
    ("Greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))),
    ("Cyrillic", ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F))),
    ("Armenian", ((0x530, 0x58F),)),
    ("Hebrew", ((0x590, 0x5FF), (0xFB1D, 0xFB4F))),
    ("Arabic", ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF))),
    ("Devanagari", ((0x900, 0x97F),)),
    ("Bengali", ((0x980, 0x9FF),)),
    ("Gurmukhi", ((0xA00, 0xA7F),)),
    ("Gujarati", ((0xA80, 0xAFF),)),
    ("Tamil", ((0xB80, 0xBFF),)),
    ("Telugu", ((0xC00, 0xC7F),)),
    ("Kannada", ((0xC80, 0xCFF),)),
    ("Malayalam", ((0xD00, 0xD7F),)),
    ("Thai", ((0xE00, 0xE7F),)),
    ("Georgian", ((0x10A0, 0x10FF), (0x1C90, 0x1CBF))),
    ("Hangul", ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF))),
    ("Kana", ((0x3040, 0x30FF), (0x31F0, 0x31FF))),
    ("Han", ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))),
)
OTHER = len(SCRIPTS)  # letters of scripts without a range above
NONE = 255
POINTS = 0x110000


@cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the lower-case letter (0 where there is no letter) and its script."""
    lower = np.zeros(POINTS, np.uint32)
    script = np.full(POINTS, NONE, np.uint8)
    for point in (*range(0xD800), *range(0xE000, 0x40000)):
        c = chr(point)
        if c.isalpha():
            small = c.lower()
            lower[point] = ord(small) if len(small) == 1 else point
            script[point] = OTHER
    letters = script == OTHER
    for number, (_, ranges) in enumerate(SCRIPTS):
        for a, b in ranges:
            script[a : b + 1][letters[a : b + 1]] = number
    return lower, script


def points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by one zero, and where each text starts (and ends)."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    joined = "\0".join(texts) + "\0" if texts else ""
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, np.concatenate(([0], np.cumsum(sizes)))


def groups(texts: list[str | None], most: int) -> list[tuple[int, int]]:
    """Ranges of rows of about ``most`` characters in all; a longer text is a range of its own."""
    return ranges([len(text or "") for text in texts], most)


def ranges(lengths: list[int], most: int) -> list[tuple[int, int]]:
    """``groups`` of texts known by their lengths alone."""
    found, start, size = [], 0, 0
    for k, length in enumerate(lengths):
        length += 1
        if size and size + length > most:
            found.append((start, k))
            start, size = k, 0
        size += length
    if start < len(lengths):
        found.append((start, len(lengths)))
    return found
