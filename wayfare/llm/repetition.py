"""Repetition rules from suffix arrays of words.

The suffixes of a document, as sequences of word numbers, are put in groups that agree in
2, 4, 8 … words (prefix doubling). Only suffixes that still share their group with another go
on, so text that does not repeat leaves after the first rounds. Sorting the rest gives the
suffix array of all repeated places, and the stored ranks give the longest common prefix of
neighbours. A run of neighbours with at least `least` common words is an LCP interval, that is
a repeated substring; it is maximal where no repeat as long starts one word earlier. The
union of their spans and the longest of them are limited.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import BLANKS, bounded_batches, text_of, words_of

SYMBOLS = "#*$%&|<>"
# Words that a repeated substring must have to count.
LEAST_REPEAT = 5
# Largest share of the words that repeated substrings may cover, and that one of them may have.
MAX_COVERED = 0.4
MAX_LONGEST = 0.25
# The base rule: fewest words, and most words (of 100) in 3-word windows that repeat.
LEAST_WORDS = 50
WINDOW = 3
MAX_WINDOW_PERCENT = 50
# Words of several documents whose suffixes are sorted together.
GROUP_WORDS = 200_000

FIELDS = (
    ("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"),
    ("n_repeat_words", "long"), ("base_failed", "boolean"), ("n_repeats", "long"),
    ("covered_words", "long"), ("longest_repeat", "long"), ("kept", "boolean"),
    ("repeat_spans", "string"),
)


def suffix_order(ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of word numbers 0, 1, …, and the ranks by the first 2**k words.

    A rank is the place in the suffix array where the group of suffixes begins that agree so
    far. Every round sorts only suffixes whose group has others. The end sorts first.
    """
    n = len(ids)
    counts = np.bincount(ids)
    rank = (np.cumsum(counts) - counts)[ids]
    places = np.flatnonzero(counts[ids] > 1)
    levels = [rank]
    step = 1
    while len(places):
        ahead = places + step
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
        order = np.argsort(rank[places] * (n + 1) + second + 1, kind="stable")
        places, second = places[order], second[order]
        group = rank[places]
        new_group = np.append(True, group[1:] != group[:-1])
        new = new_group | np.append(True, second[1:] != second[:-1])
        at = np.arange(len(places))
        group_start = np.maximum.accumulate(np.where(new_group, at, 0))
        start = np.maximum.accumulate(np.where(new, at, 0))
        rank = rank.copy()
        rank[places] = group + start - group_start
        levels.append(rank)
        sizes = np.diff(np.append(np.flatnonzero(new), len(places)))
        places = places[np.repeat(sizes, sizes) > 1]
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Words that each suffix in the array shares with the one before it (0 for the first)."""
    n = len(order)
    found = np.zeros(n, np.int64)
    pairs = np.arange(1, n)
    # Neighbours that differ in the first word share nothing.
    pairs = pairs[levels[0][order[1:]] == levels[0][order[:-1]]]
    a, b = order[pairs - 1], order[pairs]
    length = np.zeros(len(pairs), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + length, b + length
        fits = (x < n) & (y < n)
        rank = levels[k]
        equal = fits & (rank[np.minimum(x, n - 1)] == rank[np.minimum(y, n - 1)])
        length[equal] += 1 << k
    found[pairs] = length
    return found


def longest_repeats(ids: np.ndarray) -> np.ndarray:
    """For every place, the length of the deepest LCP interval that its suffix is in.

    So many words from there occur at another place too. The interval is one end of a
    neighbouring pair, so it is the larger prefix shared with either neighbour.
    """
    if len(ids) < 2:
        return np.zeros(len(ids), np.int64)
    order, levels = suffix_order(ids)
    shared = common_prefixes(order, levels)
    found = np.empty(len(ids), np.int64)
    found[order] = np.maximum(shared, np.append(shared[1:], 0))
    return found


@dataclass(frozen=True)
class Rules:
    least_repeat: int = LEAST_REPEAT
    max_covered: float = MAX_COVERED
    max_longest: float = MAX_LONGEST


def repeat_figures(length: np.ndarray, least: int) -> tuple[int, int, int, str]:
    """(maximal repeats by place, covered words, longest, spans) of one document.

    A repeat of `length` words at a place is maximal unless the place before starts one that
    is a word longer: then it only is the rest of that. Spans are unions, as start:end words.
    """
    counted = length >= least
    if not counted.any():
        return 0, 0, 0, ""
    places = np.arange(len(length))
    before = np.append(0, length[:-1])
    maximal = counted & (before != length + 1)
    reach = np.maximum.accumulate(np.where(counted, places + length, 0))
    inside = np.concatenate([[False], reach > places, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2)
    spans = ",".join(f"{a}:{b}" for a, b in edges.tolist())
    return int(maximal.sum()), int((reach > places).sum()), int(length.max()), spans


def base_counts(text: str) -> tuple[int, int, int]:
    """word_chars, n_symbols, n_dup_lines."""
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return chars, symbols, len(lines) - len(set(lines))


def figures(texts: Iterable[str], rules: Rules = Rules()) -> list[tuple]:
    """One row of FIELDS per text. Suffixes of several texts are sorted together.

    Each text has word numbers of its own, so no repeat spans two texts.
    """
    rows: list[tuple] = []
    waiting: list[tuple[tuple[int, int, int], int]] = []
    numbers: list[int] = []
    next_id = 0

    def flush() -> None:
        length = longest_repeats(np.array(numbers, np.int64))
        at = 0
        for (chars, symbols, lines), n in waiting:
            own = length[at : at + n]
            at += n
            window = np.zeros(n, bool)
            for k in range(min(WINDOW, n)):
                window[k:] |= own[: n - k] >= WINDOW
            repeated = int(window.sum())
            failed = n < LEAST_WORDS or 100 * repeated > MAX_WINDOW_PERCENT * n
            count, covered, longest, spans = repeat_figures(own, rules.least_repeat)
            good = covered <= rules.max_covered * n and longest <= rules.max_longest * n
            rows.append((n, chars, symbols, lines, repeated, failed, count, covered, longest,
                         not failed and good, spans))

    for text in texts:
        words = words_of(text)
        known = {word: k for k, word in enumerate(dict.fromkeys(words), next_id)}
        next_id += len(known)
        numbers.extend(map(known.__getitem__, words))
        waiting.append((base_counts(text), len(words)))
        if len(numbers) >= GROUP_WORDS:
            flush()
            waiting, numbers, next_id = [], [], 0
    flush()
    return rows


def repetition(text: Column, rules: Rules = Rules()) -> Column:
    """The figures of a text as a struct of FIELDS."""

    @F.pandas_udf(", ".join(f"{name} {kind}" for name, kind in FIELDS))
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(figures(texts, rules), columns=[name for name, _ in FIELDS])

    return of(text)


def quality_figures(docs: DataFrame, name: str = "_quality", rules: Rules = Rules()) -> DataFrame:
    """`docs` with a struct of the figures of each whole text.

    A null text has no words, like an empty one, and fails the base rule. Rows and other columns
    stay as they are; a column called `name` is replaced. Memory is a few dozen bytes per word
    of the longest text, times the logarithm of its longest repeat.
    """
    bounded_batches(docs.sparkSession)
    return docs.withColumn(name, repetition(text_of(), rules))


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of `docs` that the rules keep, with its columns."""
    name = "_wf_quality"
    return quality_figures(docs, name, rules).filter(F.col(f"{name}.kept")).drop(name)
