"""Packing, repetition rules, BPE, SimHash groups and token-id files against plain versions."""

import bisect
import random
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wayfare.llm import elias_fano, packing, prefix_bpe, repetition, simhash
from wayfare.llm.common import table
from wayfare.llm.components import connected_components
from wayfare.llm.tokens import chunk_starts, default_path, library_coder
from wayfare.session import shared_dir


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_path())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


ALPHABET = [*" \n\t'strdllve12éß漢.,-\x1c ", "   ", " \n ", "ing", " the", "<|endoftext|>", "aaaa"]


def random_texts(seed, number, longest=40):
    source = random.Random(seed)
    return ["".join(source.choices(ALPHABET, k=source.randrange(longest))) for _ in range(number)]


# -- tokens and BPE --------------------------------------------------------------------------


def test_chunks_begin_where_pieces_do(tokenizer):
    texts = [*random_texts(1, 400), "don't, 'tis!'s a12b  c\n\nd \n e.f–g über×ß  ", "", " ", "  x", "x "]
    said = [text.encode() for text in texts]
    edges = np.cumsum([0, *map(len, said)])
    starts = chunk_starts(np.frombuffer(b"".join(said), np.uint8), edges[:-1]).tolist()
    for text, data, a, b in zip(texts, said, edges, edges[1:]):
        pieces = {len(text[: place[0]].encode()) for _, place in tokenizer.pre_tokenizer.pre_tokenize_str(text)}
        mine = {start - a for start in starts if a <= start < b}
        if "<|endoftext|>" not in text:
            assert mine <= pieces and bool(mine) == bool(data)


@pytest.mark.parametrize("coder", [library_coder, prefix_bpe.prefix_coder])
def test_ids_equal_the_library_on_whole_texts(tokenizer, coder):
    texts = [*random_texts(2, 3000), "x" * 5000, "ab" * 3000, " " * 700, "é" * 999, ""]
    found = list(coder(default_path()).encode(texts))
    for text, ids in zip(texts, found):
        assert array("I", ids).tolist() == ids_of(tokenizer, text)


def test_every_kind_of_character(tokenizer):
    source = random.Random(3)
    points = [*range(0x300), *(source.randrange(0x300, 0x110000) for _ in range(3000))]
    texts = [f"a{c}b {c}{c}1 {c}" for c in map(chr, points) if not "\ud800" <= c <= "\udfff"]
    found = list(prefix_bpe.prefix_coder(default_path()).encode(texts))
    assert [array("I", ids).tolist() for ids in found] == [ids_of(tokenizer, t) for t in texts]


def test_decoding_equals_the_library(tokenizer):
    source = random.Random(4)
    coder = prefix_bpe.prefix_coder(default_path())
    for _ in range(500):
        ids = [source.randrange(50257) for _ in range(source.randrange(12))]
        assert coder.decode(array("I", ids).tobytes()) == tokenizer.decode(ids, skip_special_tokens=False)


def test_generations_of_kept_chunks(tokenizer, monkeypatch):
    monkeypatch.setattr("wayfare.llm.tokens.KEPT_CHUNKS", 3)
    monkeypatch.setattr("wayfare.llm.tokens.GROUP_CHARS", 20)
    texts = random_texts(5, 300)
    found = list(library_coder(default_path()).encode(texts))
    assert [array("I", ids).tolist() for ids in found] == [ids_of(tokenizer, t) for t in texts]


def test_round_trip_of_odd_rows(spark, odd, nothing, tokenizer):
    found = prefix_bpe.round_trip_digests(odd).collect()
    rows = odd.select("doc_id", "text").collect()

    def expected(row):
        ids = ids_of(tokenizer, row.text)
        data = array("I", ids).tobytes()
        text = tokenizer.decode(ids, skip_special_tokens=False)
        return row.doc_id, len(ids), prefix_bpe.sha256_hex(data), prefix_bpe.sha256_hex(text.encode())

    assert Counter(map(tuple, found)) == Counter(map(expected, rows))
    assert prefix_bpe.round_trip_digests(nothing).count() == 0


def test_ids_column_and_array(spark, odd, tokenizer):
    encoded = prefix_bpe.encode_documents(odd)
    assert set(encoded.columns) == set(odd.columns)
    rows = encoded.select("text", prefix_bpe.id_array(F.col("ids")).alias("n"),
                          prefix_bpe.decoded(F.col("ids")).alias("back")).collect()
    for row in rows:
        assert row.n == ids_of(tokenizer, row.text)
        assert row.back == (row.text or "")


# -- repetition ------------------------------------------------------------------------------


def longest_by_comparison(words):
    n = len(words)
    found = [0] * n
    for i in range(n):
        for j in range(n):
            k = 0
            while i != j and i + k < n and j + k < n and words[i + k] == words[j + k]:
                k += 1
            found[i] = max(found[i], k)
    return found


def plain_figures(text, rules):
    text = text or ""
    blanks = " \t\n\x0b\x0c\r"
    words, word = [], ""
    for c in [*text, " "]:
        if c in blanks:
            words, word = ([*words, word] if word else words), ""
        else:
            word += c
    n = len(words)
    lines = [line for line in text.split("\n") if any(c not in blanks for c in line)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(n - 2))
    covered = {i + k for i in range(n - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    longest = longest_by_comparison(words)
    inside = {p + k for p, m in enumerate(longest) if m >= rules.least_repeat for k in range(m)}
    most = max([m for m in longest if m >= rules.least_repeat], default=0)
    failed = n < 50 or 100 * len(covered) > 50 * n
    good = len(inside) <= rules.max_covered * n and most <= rules.max_longest * n
    return (
        n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
        len(covered), failed, len(inside), most, not failed and good,
    )


def test_repetition_equals_comparison_of_all_places():
    source = random.Random(6)
    rules = repetition.Rules()
    texts = ["", None, " \n", "a", "a a", "a a a a a a a a"]
    for _ in range(120):
        words = [source.choice("abcdefgh"[: source.randrange(1, 9)]) for _ in range(source.randrange(90))]
        texts.append("".join(w + source.choice([" ", "\n", "\t", " \n\n", "|", " "]) for w in words))
    passage = " ".join(f"p{k}" for k in range(30))
    texts += [f"{passage} and {' '.join(f'q{k}' for k in range(20))} {passage}",
              f"{passage} {' '.join(f'q{k}' for k in range(300))} {passage}"]
    for text, row in zip(texts, repetition.figures([t or "" for t in texts])):
        assert row[:6] + row[7:10] == plain_figures(text, rules), text
    kept = [row[9] for row in repetition.figures(texts[-2:])]
    assert kept == [False, True]


def test_repeats_of_documents_sorted_together_stay_apart():
    text = " ".join(f"w{k}" for k in range(60))
    assert [row[8] for row in repetition.figures([text] * 5)] == [0] * 5


def test_spans_are_unions():
    words = "a b c d e x a b c d e y b c d e f".split()
    row = repetition.figures([" ".join(words)], repetition.Rules(least_repeat=4))[0]
    assert row[10] == "0:5,6:11,12:16" and row[8] == 5


def test_quality_figures_of_odd_rows(odd, nothing):
    rules = repetition.Rules()
    names = [name for name, _ in repetition.FIELDS]
    rows = repetition.quality_figures(odd, "spans").select("doc_id", "text", "spans.*").collect()
    assert len(rows) == odd.count()
    for row in rows:
        if len(row.text or "") < 1000:
            found = tuple(row[name] for name in names)
            assert found[:6] + found[7:10] == plain_figures(row.text, rules)
    kept = repetition.keep_good(odd)
    assert kept.columns == odd.columns
    assert [row.doc_id for row in kept.collect()] == [6]
    assert repetition.keep_good(nothing).count() == 0


# -- SimHash ---------------------------------------------------------------------------------


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in lowered.translate({ord(c): " " for c in "\t\n\x0b\x0c\r"}).split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(pairs):
    """Smallest doc_id per row, from (doc_id, fingerprint) of all rows."""
    group = list(range(len(pairs)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, (_, a) in enumerate(pairs):
        for j in range(i):
            if (a ^ pairs[j][1]).bit_count() <= 3:
                group[root(i)] = root(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(pairs):
        if doc is not None:
            least[root(i)].append(doc)
    return [min(least[root(i)], default=None) for i in range(len(pairs))]


def near_texts(seed, number):
    source = random.Random(seed)
    texts = []
    for k in range(number):
        if texts and source.random() < 0.5:
            words = source.choice(texts).split(" ")
            words[source.randrange(len(words))] = f"new{k}"
            texts.append(" ".join(words))
        else:
            texts.append(" ".join(f"V{source.randrange(60)}" for _ in range(source.randrange(1, 120))))
    return texts


def test_fingerprints():
    for text in [None, "", "One", "one two", "A b C d É", *near_texts(7, 40), *random_texts(8, 60)]:
        assert simhash.fingerprint(text or "") == plain_fingerprint(text)


def test_groups_equal_all_pairs(spark, odd, nothing):
    rows = [(k, t) for k, t in enumerate(near_texts(9, 400))] + [(None, "lonely row"), (500, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for frame in (docs, odd):
        pairs = [(row.doc_id, plain_fingerprint(row.text)) for row in frame.collect()]
        expected = Counter(
            (doc, f"{fp:016x}", root) for (doc, fp), root in zip(pairs, plain_groups(pairs))
        )
        found = simhash.near_duplicates(frame).select(
            "doc_id", simhash.fingerprint_hex(F.col("_fp")), "component_id"
        )
        assert Counter(map(tuple, found.collect())) == expected
    assert simhash.near_duplicates(nothing).count() == 0


def test_large_shards_are_cut_again(spark):
    source = random.Random(10)
    values = {0}
    while len(values) < 300:
        value = source.choice([*values])
        for _ in range(source.randrange(1, 5)):
            value ^= 1 << source.randrange(64)
        values.add(value)
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    frame = spark.createDataFrame([(s, s) for s in signed.values()], "value long, id long")
    members = simhash.shard_members(frame, shard_rows=20, depth=3)
    roots = dict(connected_components(simhash.links(members)).collect())
    found = defaultdict(set)
    for value in values:
        found[roots.get(signed[value], signed[value])].add(value)
    expected = defaultdict(set)
    ordered = sorted(values)
    for value, root in zip(ordered, plain_groups([(k, v) for k, v in enumerate(ordered)])):
        expected[root].add(value)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, expected.values()))


def test_shards_that_no_band_cuts_are_searched_in_blocks(spark):
    """10,000 fingerprints that agree in 37 bits; no task gets more than a bounded shard."""
    source = np.random.default_rng(12)
    values = np.unique(source.integers(0, 1 << 27, 10_000, dtype=np.uint64) | np.uint64(0x5A5A5A5A5 << 27))
    frame = spark.createDataFrame([(int(v), int(v)) for v in values], "value long, id long")
    members = simhash.shard_members(frame, shard_rows=1000)
    sizes = members.groupBy("key").count()
    assert sizes.agg(F.max("count")).first()[0] <= 1.3 * 1000
    roots = dict(connected_components(simhash.links(members)).collect())
    found = [roots.get(int(v), int(v)) for v in values]
    group = np.arange(len(values))
    near = [np.flatnonzero(np.bitwise_count(values ^ v) <= 3) for v in values]
    for _ in range(100):
        after = np.array([group[n].min() for n in near])
        if (after == group).all():
            break
        group = after
    assert found == [int(values[g]) for g in group]


def test_bk_tree_finds_all_within_the_radius():
    source = random.Random(11)
    values = [source.getrandbits(10) for _ in range(200)]
    tree = simhash.BKTree()
    for value in dict.fromkeys(values):
        tree.add(value)
    for value in range(0, 1024, 7):
        for radius in (0, 1, 3):
            found = sorted(tree.values[node] for node in tree.within(value, radius))
            assert found == sorted({v for v in values if (v ^ value).bit_count() <= radius})


def test_one_row_of_each_group_stays(odd, nothing):
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    pairs = [(r.doc_id, plain_fingerprint(r.text)) for r in odd.collect()]
    expected = Counter({root: 1 for root in plain_groups(pairs)})
    assert Counter(row.doc_id for row in rows) == expected
    assert simhash.keep_first(nothing).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(200)]
    star = [(1000, 1000 + k) for k in range(1, 200)] + [(1005, 1005), (1006, 1000)]
    frame = spark.createDataFrame(chain + star, "a long, b long")
    found = dict(connected_components(frame).collect())
    assert found == {k: 0 for k in range(201)} | {k: 1000 for k in range(1000, 1200)}
    assert connected_components(frame.filter("a < 0")).count() == 0


# -- packing ---------------------------------------------------------------------------------


def check_packing(rows, capacity):
    sequences = defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append((row.offset, row.length))
    for items in sequences.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def best_fit_decreasing(lengths, capacity):
    free = []
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(free, length)
        room = free.pop(at) if at < len(free) else capacity
        bisect.insort(free, room - length)
    return len(free)


@pytest.mark.parametrize("seed", range(5))
def test_plans_place_every_piece_once(seed):
    source = random.Random(seed)
    draw = [
        lambda: min(128, 1 + int(source.expovariate(1 / 40))), lambda: source.choice([65, 64, 43, 42, 30]),
        lambda: source.randrange(1, 129), lambda: 50, lambda: source.randrange(40, 60),
    ][seed]
    lengths = [draw() for _ in range(1500)]
    histogram = Counter(lengths)
    runs = packing.plan_sequences(histogram, 128)
    indices = defaultdict(list)
    for run in runs:
        assert run.free == 128 - sum(n * places for n, _, places in run.items) >= 0
        for length, first, places in run.items:
            indices[length] += range(first, first + run.count * places)
    assert {n: sorted(found) for n, found in indices.items()} == {n: [*range(c)] for n, c in histogram.items()}
    used = sum(run.count for run in runs)
    assert used <= best_fit_decreasing(lengths, 128)
    assert used >= packing.fewest_possible(histogram, 128)


@pytest.mark.parametrize(("low", "high", "number"), [(700, 1499, 10_000), (300, 900, 10_000), (257, 1100, 9000)])
def test_configurations_beat_best_fit_on_mid_sizes(low, high, number):
    source = random.Random(low)
    lengths = [source.randrange(low, high + 1) for _ in range(number)]
    used = sum(run.count for run in packing.plan_sequences(Counter(lengths), 2048))
    assert used <= best_fit_decreasing(lengths, 2048)
    # Without rounding to groups and best fit in between, the bound would be met.
    assert used <= 1.02 * packing.fewest_possible(Counter(lengths), 2048)


def test_the_programme_is_solved_to_its_optimum():
    # Pairs and threes that fill a sequence exactly, so the optimum is known.
    sizes = [70, 60, 58, 50, 45, 42, 40, 30, 28, 25]
    counts = Counter()
    for pattern in ([70, 58], [60, 40, 28], [50, 50, 28], [45, 58, 25], [42, 42, 44], [30, 70, 28]):
        if sum(pattern) == 128 and all(p in sizes for p in pattern):
            counts.update({p: 100 * pattern.count(p) for p in set(pattern)})
    used = [n for n in sizes if counts[n]]
    plan = packing.configurations(used, [counts[n] for n in used], 128)
    assert sum(times for _, times in plan) == sum(n * c for n, c in counts.items()) // 128
    assert packing.configurations([], [], 128) == []


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_documents_take_no_more_sequences_than_best_fit(spark, scale):
    docs = table(spark, f"/root/testdata/{scale}", "documents")
    counted = packing.cut_documents(docs).groupBy("length").count().collect()
    histogram = {r["length"]: r["count"] for r in counted}
    lengths = [n for n, c in histogram.items() for _ in range(c)]
    used = sum(run.count for run in packing.plan_sequences(histogram))
    assert used <= best_fit_decreasing(lengths, 2048)
    assert used == packing.fewest_possible(histogram, 2048)


def test_packing_of_odd_rows(spark, odd, nothing, tokenizer):
    rows = packing.pack_documents(odd, capacity=64).collect()
    sequences = check_packing(rows, 64)
    expected = Counter()
    total = 0
    for row in odd.collect():
        ids = [*ids_of(tokenizer, row.text), 0]
        first = len(ids) % 64 or min(64, len(ids))
        for piece, start in enumerate([0, *range(first, len(ids), 64)]):
            part = ids[start : first if not piece else start + 64]
            expected[row.doc_id, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
            total += len(part)
    found = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert found == expected
    assert sequences <= -(-total // 64) + 1
    assert packing.pack_documents(nothing).count() == 0


def test_one_length_holds_most_pieces(spark, monkeypatch):
    monkeypatch.setattr(packing, "SALT_ROWS", 10)
    monkeypatch.setattr(packing, "LEAST_SALTS", 3)
    frame = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 40).otherwise(F.col("id") % 97 + 1).alias("length"))
    rows = packing.pack(frame.withColumn("_index", F.lit(1)).withColumn("offset", F.lit("x")), 100).collect()
    assert check_packing(rows, 100) >= 1000 and len(rows) == 3000


# -- token-id files --------------------------------------------------------------------------


@pytest.mark.parametrize("values", [
    [], [0], [0, 0, 0], [5], [0, 1, 2, 3], [0, 10**12], [*range(0, 10**6, 37)], [7] * 2000,
    sorted(random.Random(12).randrange(1 << 40) for _ in range(3000)), [0, (1 << 64) - 1],
])
def test_elias_fano_selects_every_value(values):
    coded = elias_fano.EliasFano.of(np.array(values, np.uint64))
    coded = elias_fano.EliasFano.from_parts(*coded.parts())
    assert coded.select(0, len(values)).tolist() == values
    for k in range(0, len(values), 131):
        assert coded.select(k, k + 1).tolist() == [values[k]]
    for a in range(0, len(values), 700):
        assert coded.select(a, min(a + 513, len(values))).tolist() == values[a : a + 513]


def test_boundaries_take_little_space():
    ends = np.cumsum(np.random.default_rng(0).integers(1, 2000, 100_000))
    size = sum(map(len, elias_fano.EliasFano.of(ends).parts()))
    assert size < 2 * len(ends) < 8 * len(ends) / 3


def test_files_of_odd_rows(spark, odd, nothing, tokenizer):
    manifest = elias_fano.write_shards(odd, shared_dir(spark), shards=3)
    rows = elias_fano.read_shards(elias_fano.with_starts(manifest)).collect()
    ordered = sorted(rows, key=lambda row: row.start)
    ids = [row.doc_id for row in ordered]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    at = 0
    for row in ordered:
        assert row.start == at
        at += row.n_tokens
    def crc(row):
        tokens = [*ids_of(tokenizer, row.text), 0]
        return row.doc_id, len(tokens), zlib.crc32(np.array(tokens, "<u4").tobytes())
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == Counter(map(crc, odd.collect()))
    assert elias_fano.write_and_read(spark, nothing).count() == 0


def test_starts_are_summed_without_the_driver(spark, monkeypatch):
    rows = [(shard, f"p{shard}", 1, 10 + shard % 7) for shard in range(0, 3000, 3)]
    manifest = spark.createDataFrame(rows, elias_fano.MANIFEST).repartition(5)
    expected, total = {}, 0
    for shard, _, _, tokens in rows:
        expected[shard] = total
        total += tokens
    for window in (1 << 16, 10):
        monkeypatch.setattr(elias_fano, "ONE_WINDOW", window)
        monkeypatch.setattr(elias_fano, "LEVELS", (5,))
        found = elias_fano.with_starts(manifest)
        tasks = found.select("shard", "start", F.spark_partition_id().alias("p")).collect()
        assert {r.shard: r.start for r in tasks} == expected
        assert all(r.p == r.shard for r in tasks)
    assert "collect" not in elias_fano.with_starts.__code__.co_names
    assert elias_fano.with_starts(manifest.filter("false")).isEmpty()


def test_random_access_in_a_shard(spark, tokenizer):
    docs = spark.createDataFrame([(k * 3 - 50, f"text number {k} " * (k % 7)) for k in range(700)], "doc_id long, text string")
    path, = (row.path for row in elias_fano.write_shards(docs, shared_dir(spark), shards=1).collect())
    shard = elias_fano.Shard(path)
    assert shard.width == 2 and shard.docs == 700
    for k in (0, 1, 511, 512, 513, 699):
        start, end = shard.offsets(k, k + 1).tolist()
        assert shard.doc_ids(k, k + 1) == [k * 3 - 50]
        assert shard.ids(start, end).tolist() == [*ids_of(tokenizer, f"text number {k} " * (k % 7)), 0]


def test_shards_follow_the_bytes_of_the_input(spark, tmp_path, monkeypatch):
    rows = [(k, f"text {k} " * 50) for k in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    size = sum(f.stat().st_size for f in (tmp_path / "d").rglob("*.parquet"))
    monkeypatch.setattr(elias_fano, "SHARD_BYTES", size // 20)
    manifest = elias_fano.write_shards(docs, shared_dir(spark))
    assert manifest.count() >= 20
    rows = elias_fano.read_shards(elias_fano.with_starts(manifest)).collect()
    assert sorted(row.doc_id for row in rows) == list(range(400))
