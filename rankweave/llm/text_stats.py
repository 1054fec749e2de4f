"""Statistics of one text, each computed when first asked for. Words are runs without ASCII blanks."""

from __future__ import annotations

import math
from collections import Counter
from functools import cached_property

import numpy as np

from rankweave.llm.common import window_hashes

# Characters that count as symbols, and the runs of words that count as repeats.
SYMBOLS = b"#*$%&|<>"
REPEAT_WIDTH = 8
UPPER = bytes(range(ord("A"), ord("Z") + 1))
LOWER = bytes(range(ord("a"), ord("z") + 1))
DIGITS = b"0123456789"
BLANKS = b" \t\n\x0b\x0c\r"
CONTINUATION = bytes(range(0x80, 0xC0))


def _without(data: bytes, drop: bytes) -> int:
    return len(data.translate(None, drop))


class TextStats:
    def __init__(self, data: bytes):
        self.data = data

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        """Code points in words."""
        return _without(self.data, BLANKS + CONTINUATION)

    @cached_property
    def n_symbols(self) -> int:
        return len(self.data) - _without(self.data, SYMBOLS)

    @cached_property
    def n_upper(self) -> int:
        return len(self.data) - _without(self.data, UPPER)

    @cached_property
    def n_lower(self) -> int:
        return len(self.data) - _without(self.data, LOWER)

    @cached_property
    def n_digits(self) -> int:
        return len(self.data) - _without(self.data, DIGITS)

    @cached_property
    def n_beyond_ascii(self) -> int:
        return len(self.data) - _without(self.data, bytes(range(0xC0, 0x100)))

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines that have a word."""
        return [x for x in self.data.split(b"\n") if x.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        """Lines with a word that equal an earlier line."""
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def word_numbers(self) -> np.ndarray:
        """Words by number, equal words alike."""
        number: dict[bytes, int] = {}
        return np.fromiter((number.setdefault(w, len(number)) for w in self.words), np.int64, self.n_words)

    @cached_property
    def n_distinct(self) -> int:
        return int(self.word_numbers.max()) + 1 if self.n_words else 0

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside runs of eight words that the text has twice or more, the first of them included."""
        hashes = window_hashes(self.word_numbers.astype(np.uint64), REPEAT_WIDTH)
        if not len(hashes):
            return 0
        order = np.argsort(hashes, kind="stable")
        in_order = hashes[order]
        same = in_order[1:] == in_order[:-1]
        if not same.any():
            return 0
        # A run counts if it equals its neighbour in hash order word by word, so a collision of hashes counts nothing.
        left, right = order[:-1][same], order[1:][same]
        windows = np.lib.stride_tricks.sliding_window_view(self.word_numbers, REPEAT_WIDTH)
        equal = (windows[left] == windows[right]).all(axis=1)
        if not equal.all():
            return self._repeats_by_content(windows)
        return _covered(np.unique(np.concatenate([left, right])), self.n_words)

    def _repeats_by_content(self, windows: np.ndarray) -> int:
        runs = [w.tobytes() for w in windows]
        counts = Counter(runs)
        return _covered(np.array([i for i, w in enumerate(runs) if counts[w] > 1], np.int64), self.n_words)

    @cached_property
    def word_entropy(self) -> float:
        """Entropy of the words in bits over its greatest possible value; 1 for a text of one word or none."""
        if self.n_words < 2:
            return 1.0
        share = np.bincount(self.word_numbers) / self.n_words
        return float(-(share * np.log2(share)).sum() / math.log2(self.n_words))


def _covered(starts: np.ndarray, n: int) -> int:
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + REPEAT_WIDTH, -1)
    return int((np.cumsum(edges) > 0).sum())
