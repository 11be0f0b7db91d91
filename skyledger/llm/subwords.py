"""Character n-grams of many words at once, as numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Scripts without spaces between words: ideographs and kana; and alphabets (Thai, Lao, Tibetan, Burmese, Khmer).
IDEOGRAPHS = "\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
UNSPACED = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff" + IDEOGRAPHS
OPENS, CLOSES = "<", ">"
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _mixed(hashes: np.ndarray) -> np.ndarray:
    return (hashes ^ (hashes >> np.uint64(29))) * _FACTOR


def overlapping(word: str, width: int, overlap: int) -> list[str]:
    """Pieces of at most ``width`` letters; any ``overlap + 1`` letters in a row are together in one of them."""
    return [word[k : k + width] for k in range(0, max(1, len(word) - overlap), width - overlap)]


class BoundedWords:
    """Words of letters and digits, each between two marks and cut at a longest length, as one row of code points."""

    def __init__(self, words: pa.Array, longest: int):
        self.size = len(words)
        bounded = pc.binary_join_element_wise(OPENS, pc.utf8_slice_codeunits(words, 0, longest), CLOSES, "")
        text = "".join(bounded.to_numpy(zero_copy_only=False).tolist())
        self._codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
        opens = self._codes == ord(OPENS)
        self._starts = np.flatnonzero(opens)
        self._word = np.cumsum(opens) - 1
        self._lengths = np.diff(np.append(self._starts, len(self._codes)))
        self._within = np.arange(len(self._codes)) - self._starts[self._word]
        self._rolled = {1: self._codes + np.uint64(1)}

    @property
    def lengths(self) -> np.ndarray:
        """Letters and digits of each word, as far as they are kept."""
        return self._lengths - 2

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """A hash of each n-gram, marks included, and the word it is in."""
        for k in range(2, n + 1):
            if k not in self._rolled:
                before = self._rolled[k - 1]
                self._rolled[k] = before[:-1] * _FACTOR + self._codes[k - 1 :] if len(before) else before
        rolled = self._rolled[n]
        word = self._word[: len(rolled)]
        inside = self._within[: len(rolled)] + n <= self._lengths[word]
        return _mixed(rolled[inside] + np.uint64(n)), word[inside]

    def whole(self) -> np.ndarray:
        """A hash of each word."""
        if not self.size:
            return np.zeros(0, np.uint64)
        powers = _mixed(self._within.astype(np.uint64) + np.uint64(7)) | np.uint64(1)
        return _mixed(np.add.reduceat((self._codes + np.uint64(1)) * powers, self._starts))
