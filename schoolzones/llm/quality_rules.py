"""Quality rules on repetition: characters inside duplicated n-grams and duplicated lines.

N-grams of several lengths get rolling hashes (each length from the one before), in numpy, over all texts of a chunk
at once. An n-gram can occur twice only where its first n-1 words do, so each length looks at the survivors of the one
before; only the shortest length is sorted in full.

Nulls and empty texts have no words and are rejected (fewer than 20 words). Rows are judged on their own, so repeated
rows, ties and extra columns have no influence; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .native import unused
from .text import SPACES, Words, chunks

SYMBOLS = "#*$%&|<>"
_STEP = np.uint64(0x9E3779B97F4A7C15)
_TEXT = np.uint64(0xC2B2AE3D27D4EB4F)

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, line_chars long, "
    "dup_line_chars long, ngram_chars array<long>"
)


@dataclass(frozen=True)
class Rules:
    """``lengths``: n-gram lengths measured; ``window``: the one whose repeated words are counted (one of ``lengths``).

    A text is rejected with fewer than ``min_words`` words, with more than ``max_repeat_pct`` percent of its words in
    repeated windows, or if duplicated lines, or duplicated n-grams of any length, hold more than the given share of
    its characters.
    """

    lengths: tuple[int, ...] = (5, 6, 7, 8, 9, 10)
    window: int = 8
    min_words: int = 20
    max_repeat_pct: int = 30
    max_line_share: float = 0.3
    max_ngram_share: tuple[float, ...] = (0.35, 0.34, 0.33, 0.32, 0.31, 0.30)


def _twice(keys: np.ndarray) -> np.ndarray:
    """Which keys occur at least twice."""
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    found = np.zeros(len(keys), bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    return found


def repeated_words(words: Words, lengths: tuple[int, ...]) -> dict[int, np.ndarray]:
    """For each length: which words lie in an n-gram that their text has twice or more (all occurrences count)."""
    total = len(words.codes)
    salt = words.text_of.astype(np.uint64) * _TEXT
    starts = np.arange(total)
    rolled, length, out = words.codes.copy(), 1, {}
    for n in sorted(lengths):
        while length < n:  # the hash of a longer n-gram from that of the shorter one
            rolled = rolled[:-1] * _STEP + words.codes[length:]
            length += 1
        starts = starts[starts + n <= total]
        starts = starts[words.text_of[starts] == words.text_of[starts + n - 1]] if total else starts
        starts = starts[_twice(rolled[starts] ^ salt[starts])]
        edges = np.zeros(total + 1, np.int64)
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + n, -1)
        out[n] = np.cumsum(edges[:-1]) > 0
    return out


def _lines(text: bytes) -> tuple[int, int, int]:
    """Lines equal to an earlier line, their characters, and the characters of all lines that have a word."""
    seen, n, chars, total = set(), 0, 0, 0
    for line in text.decode("utf-8", "surrogatepass").split("\n"):
        if line.strip(SPACES):
            total += len(line)
            if line in seen:
                n, chars = n + 1, chars + len(line)
            seen.add(line)
    return n, chars, total


def measure(texts: list[bytes], rules: Rules) -> pd.DataFrame:
    """The measures of some whole texts."""
    words, k = Words(texts), len(texts)
    chars = words.chars
    per_text = lambda values: np.bincount(words.text_of, values, k).astype(np.int64)
    covered = repeated_words(words, rules.lengths)
    lines = np.array([_lines(t) for t in texts], np.int64).reshape(k, 3)
    symbols = SYMBOLS.encode()
    return pd.DataFrame(
        {
            "n_words": words.count,
            "word_chars": per_text(chars),
            "n_symbols": [len(t) - len(t.translate(None, symbols)) for t in texts],
            "n_dup_lines": lines[:, 0],
            "n_repeat_words": per_text(covered[rules.window]),
            "line_chars": lines[:, 2],
            "dup_line_chars": lines[:, 1],
            "ngram_chars": list(
                np.stack([per_text(np.where(covered[n], chars, 0)) for n in rules.lengths], 1)
            ),
        }
    )


def measures(text: Column, rules: Rules = Rules()) -> Column:
    """A struct of the measures of one text column."""

    @F.pandas_udf(MEASURES)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [measure(part, rules) for part in chunks(batch)]
            yield pd.concat(parts, ignore_index=True) if parts else measure([], rules)

    return run(text)


def verdicts(df: DataFrame, text: str = "text", name: str = "quality", rules: Rules = Rules()) -> DataFrame:
    """``df`` with one struct column ``name``: the measures, ``base_failed`` and ``kept``.

    The struct replaces a column of that name; all others pass as they are.
    """
    m = measures(F.col(text), rules)
    df = df.withColumn(name, m)
    field = lambda x: F.col(f"{name}.{x}")
    base = (field("n_words") < rules.min_words) | (
        field("n_repeat_words") * 100 > field("n_words") * rules.max_repeat_pct
    )
    too_much = field("dup_line_chars") > field("line_chars") * rules.max_line_share
    for i, share in enumerate(rules.max_ngram_share):
        too_much |= field("ngram_chars")[i] > field("word_chars") * share
    return df.withColumn(
        name,
        F.col(name).withField("base_failed", base).withField("kept", ~base & ~too_much),
    )


def keep_good(df: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The rows whose text passes, with the columns of ``df``, whatever their names are."""
    name = unused("verdict", df)
    return verdicts(df, text, name, rules).where(F.col(name)["kept"]).drop(name)
