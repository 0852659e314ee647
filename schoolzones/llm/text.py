"""Word arrays for the numpy kernels. A word is a run of anything but the six ASCII white-space characters."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cached_property
from itertools import chain

import numpy as np

#: The same set as in the regular expression [\x20\x09-\x0D]; bytes.split() without arguments splits on it.
SPACES = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"
GAP = "[\\x20\\x09-\\x0D]+"


def encoded(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def chunks(texts: Iterable[str | None], size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Whole texts as bytes, in lists of about ``size`` bytes; a longer text comes alone."""
    held, total = [], 0
    for text in texts:
        raw = encoded(text)
        if held and total + len(raw) > size:
            yield held
            held, total = [], 0
        held.append(raw)
        total += len(raw)
    if held:
        yield held


class Words:
    """The words of several texts in one sequence.

    ``text_of[i]`` is the text of word ``i``, ``count`` the words per text, ``codes`` a 64-bit code per word (good
    within this process) and ``chars`` its code points.
    """

    def __init__(self, texts: list[bytes]):
        split = [t.split() for t in texts]
        self.words = list(chain.from_iterable(split))
        self.count = np.fromiter(map(len, split), np.int64, len(split))
        self.text_of = np.repeat(np.arange(len(split)), self.count)

    @cached_property
    def codes(self) -> np.ndarray:
        return np.fromiter(map(hash, self.words), np.int64, len(self.words)).view(np.uint64)

    @property
    def chars(self) -> np.ndarray:
        buffer = np.frombuffer(b"".join(self.words), np.uint8)
        first = np.concatenate(([0], np.cumsum((buffer & 0xC0) != 0x80)))
        ends = np.cumsum(np.fromiter(map(len, self.words), np.int64, len(self.words)))
        return np.diff(first[ends], prepend=0)


_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[str, np.ndarray] = {}


def _power(name: str, n: int) -> np.ndarray:
    """The powers of the base, or of its inverse modulo 2^64, at least ``n`` of them."""
    held = _powers.get(name, np.zeros(0, np.uint64))
    if len(held) < n:
        base = _BASE if name == "up" else pow(_BASE, -1, 1 << 64)
        row = np.full(max(n, 1 << 16), base, np.uint64)
        row[0] = 1
        held = _powers[name] = np.multiply.accumulate(row)
    return held


def scrambled(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stable_codes(words: list[bytes]) -> np.ndarray:
    """A 64-bit code of every word that is the same in all processes."""
    buffer = np.frombuffer(b"".join(words), np.uint8).astype(np.uint64) + np.uint64(1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64) if len(words) else ends
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(buffer * _power("up", len(buffer))[: len(buffer)])))
    return scrambled((sums[ends] - sums[starts]) * _power("down", len(buffer) + 1)[starts])
