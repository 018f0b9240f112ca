"""Counts over a text that the quality rules and their model use."""

from __future__ import annotations

import math
import string
from collections import Counter

import numpy as np

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
_BLANKS = b" \t\n\x0b\x0c\r"
_UPPER = string.ascii_uppercase.encode()
_DIGITS = string.digits.encode()
_PUNCTUATION = string.punctuation.encode()

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = (
    "symbol_ratio",
    "dup_line_ratio",
    "repeat_ratio",
    "mean_word_chars",
    "longest_word",
    "distinct_ratio",
    "upper_ratio",
    "digit_ratio",
    "punctuation_ratio",
    "stop_mark_ratio",
    "exclamation_ratio",
    "bare_mark_ratio",
    "words_per_line",
    "top_word_ratio",
    "short_word_ratio",
    "log_words",
)
# Features that may only lower the score as they rise.
FALLING = ("symbol_ratio", "dup_line_ratio", "repeat_ratio")


def _without(text: bytes, chars: bytes) -> int:
    return len(text) - len(text.translate(None, chars))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside a window of so many words that occurs twice or more, the first included."""
    count = len(words) - window + 1
    if count < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.uint64)
    if len(numbers) == len(words):
        return 0
    mixed = ids * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03)
    mixed ^= mixed >> np.uint64(29)
    hashes = np.zeros(count, np.uint64)
    for i in range(window):
        hashes = hashes * np.uint64(0xBF58476D1CE4E5B9) + mixed[i : i + count]
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(count, bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    # Equal hashes are looked at word by word, so the count is exact.
    at = np.flatnonzero(twice)
    windows = [ids[i : i + window].tobytes() for i in at.tolist()]
    seen = Counter(windows)
    starts = at[[seen[w] > 1 for w in windows]]
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    return int((np.cumsum(change) > 0).sum())


def statistics(text: bytes) -> tuple[list[int], list[float]]:
    """The BASE counts and the RATIOS of a text in UTF-8."""
    words = text.split()
    n = len(words)
    chars = len(text.decode())
    word_chars = chars - _without(text, _BLANKS)
    symbols = _without(text, SYMBOLS)
    lines = [line for line in text.split(b"\n") if line.strip()]
    dup_lines = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    base = [n, word_chars, symbols, dup_lines, repeats]
    if not n:
        return base, [0.0] * len(RATIOS)
    counts = Counter(words)
    lengths = list(map(len, words))
    return base, [
        symbols / n,
        dup_lines / len(lines),
        repeats / n,
        word_chars / n,
        float(max(lengths)),
        len(counts) / n,
        _without(text, _UPPER) / word_chars,
        _without(text, _DIGITS) / word_chars,
        _without(text, _PUNCTUATION) / word_chars,
        (text.count(b".") + text.count(b",")) / n,
        text.count(b"!") / n,
        (counts[b"|"] + counts[b"-"] + counts[b"*"]) / n,
        n / len(lines),
        counts.most_common(1)[0][1] / n,
        sum(map((3).__ge__, lengths)) / n,
        math.log(n),
    ]
