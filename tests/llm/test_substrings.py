"""Removal of repeated windows against a plain version, and the parts of the sketch."""

import random
from collections import Counter

import numpy as np
import pytest

from wayfare.llm import hashing
from wayfare.llm import substrings as S


def plain(rows, window):
    words = [[w for w in _cut(text or "")] for _, text in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((doc_id, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def _cut(text):
    word = ""
    for c in text + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                yield word
            word = ""
        else:
            word += c


def rows_of(df):
    return Counter(map(tuple, df.select("doc_id", "n_words", "n_removed", "kept").collect()))


@pytest.mark.parametrize("window", [1, 2, 5, 35])
def test_equal_to_a_plain_version(spark, window):
    source = random.Random(window)
    rows = []
    passage = [f"p{k}" for k in range(60)]
    for n in range(120):
        words = source.choices(["a", "b", "ä", "漢字", "x" * 70], k=source.randrange(3 * window + 2))
        if n % 3 == 0:
            words += passage[source.randrange(20) :]
        rows.append((n, source.choice([" ", "\n", "\t "]).join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert rows_of(S.remove_repeats(df, window)) == Counter(plain(rows, window))


def test_bundles_of_any_size_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(S, "SHARD_ENTRIES", 20)
    source = random.Random(7)
    rows = [(n, " ".join(source.choices("abcd", k=source.randrange(40)))) for n in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(S.bundled, "__defaults__", (50,))
    assert rows_of(S.remove_repeats(df, 6)) == Counter(plain(rows, 6))
    stored, windows = S.bundled(df, 6)
    assert stored.count() > 50
    assert windows == sum(max(0, len(text.split()) - 5) for _, text in rows)


def test_odd_rows(spark, odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert rows_of(S.remove_repeats(odd)) == Counter(plain(rows, 35))
    assert rows_of(S.remove_repeats(odd, 3)) == Counter(plain(rows, 3))
    assert S.remove_repeats(nothing).count() == 0


def test_one_word_in_all_places(spark):
    rows = [(n, "same " * 3000) for n in range(20)] + [(99, "same " * 34), (100, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert rows_of(S.remove_repeats(df)) == Counter(plain(rows, 35))


def test_the_sketch_never_counts_too_little():
    source = np.random.default_rng(1)
    parts = [source.integers(0, 1 << 63, (2, 400), dtype=np.uint64) for _ in range(6)]
    parts[3][:, :100] = parts[0][:, :100]
    parts[5][:, 200:250] = parts[5][:, 250:300]
    sketch = S.Sketch(100, 8)
    for row in (0, 1, S.EXACT):
        sent = [dict(sketch.sent(part, row)) for part in parts]
        answers = [{} for _ in parts]
        for shard in range(8):
            there = [k for k, found in enumerate(sent) if shard in found]
            if not there:
                continue
            for k, bits in zip(there, S.occur_twice(row, [sent[k][shard] for k in there])):
                answers[k][shard] = bits
        twice = [sketch.twice(part, row, found) for part, found in zip(parts, answers)]
        assert twice[0][:100].all() and twice[3][:100].all() and twice[5][200:300].all()
        if row == S.EXACT:
            assert sum(t.sum() for t in twice) == 300


def test_sorted_numbers_survive_packing():
    for values in ([], [0], [0, 0, 1], [5, 5, 1 << 40, (1 << 56) - 1, 1 << 62], range(0, 90_000, 300)):
        numbers = np.array(values, np.uint64)
        assert (S.unpacked(S.packed(numbers)) == numbers).all()


def test_hashes_do_not_depend_on_the_place(monkeypatch):
    monkeypatch.setattr(hashing, "_CHUNK", 64)
    monkeypatch.setattr(hashing, "_tables", [])
    words = [b"one", b"two", b"three", "dreiß".encode(), b"y" * 65, b"z" * 500, b"a"]
    texts = [b" ".join(words), b"\n\t " + b"  ".join(words[2:]), b"", b" ", b"a"]
    bundle = S.Bundle(texts, 1)
    first = bundle.first.tolist()
    whole = bundle.hashes
    assert first == [0, 7, 12, 12, 12, 13]
    assert (whole[:, 2:7] == whole[:, 7:12]).all()
    assert (whole[:, 6] == whole[:, 12]).all()
    assert len({tuple(h) for h in whole.T.tolist()}) == 7
