"""Counts over one text, shared by the quality rules and the quality
classifier.  A word is a maximal run of code points other than space and
U+0009 to U+000D (what ``bytes.split`` splits on)."""

from __future__ import annotations

from collections import Counter

import numpy as np

WINDOW = 8
SYMBOLS = "#*$%&|<>"
FIELDS = ("n_chars", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_distinct_words", "top_word", "n_adjacent", "n_upper", "n_lower",
          "n_digits", "n_exclaim", "n_pipes", "n_stops", "n_commas", "n_other")
_WHITE = " \t\n\r\x0b\x0c"


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words lying in a ``size``-word window that occurs twice or more,
    first occurrence included.  Windows are grouped by a 64-bit mix of word
    hashes; only where groups meet are the words themselves compared."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    with np.errstate(over="ignore"):
        mixed = h[:n].copy()
        for k in range(1, size):
            mixed *= np.uint64(0x9E3779B97F4A7C15)
            mixed += h[k:k + n]
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed, kind="stable")
    same = mixed[order[1:]] == mixed[order[:-1]]
    if not same.any():
        return 0
    member = np.zeros(n, bool)
    member[order[1:][same]] = True
    member[order[:-1][same]] = True
    at = np.flatnonzero(member)
    seen = Counter(tuple(words[i:i + size]) for i in at.tolist())
    covered = np.zeros(len(words) + 1, np.int64)
    for i in at.tolist():
        if seen[tuple(words[i:i + size])] > 1:
            covered[i] += 1
            covered[i + size] -= 1
    return int((np.cumsum(covered) > 0).sum())


def text_stats(text: str) -> tuple[int, ...]:
    """The numbers named in ``FIELDS`` for one text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n_white = sum(map(text.count, _WHITE))
    lines = text.split("\n")
    real = [x for x in lines if x.strip(_WHITE)]
    counts = Counter(words)
    codes = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    return (len(text), len(words), len(text) - n_white, int(codes[_SYMBOL_CODES].sum()),
            len(real) - len(set(real)), repeated_words(words), len(real), len(counts),
            max(counts.values(), default=0),
            sum(a == b for a, b in zip(words, words[1:])),
            int(codes[65:91].sum()), int(codes[97:123].sum()), int(codes[48:58].sum()),
            int(codes[33]), int(codes[124]), int(codes[46]), int(codes[44]),
            int(codes[0xC3:0xF8].sum()))


_SYMBOL_CODES = np.array([ord(c) for c in SYMBOLS])
