"""Removal of repeated word windows with a count-min prefilter.

A window is a run of `window` words of one document. A word goes if a window that covers it also
starts anywhere else. Two passes find the windows that repeat:

1. Each bundle of documents makes a count-min sketch of its windows: for each of SKETCH_ROWS hash
   rows, which cells it hits, and whether it hits one more than once. Sketches of all bundles are
   merged cell by cell; a cell counts every window that falls in it, so counts are never too
   small. A bundle gets back, for the cells it hits, whether they were hit twice.
2. Windows with a count of two or more in every row may repeat. Only these are grouped exactly, by
   a 128-bit hash; a bundle gets back which of them occur twice. None is lost by the first pass.

A sketch has CELLS cells for each window of the corpus, so that the share of windows that pass
wrongly stays the same at every size. It is never held as a whole: a bundle sends the cells it
hits in sorted order, as differences of a byte or two, and shards of cells are merged by one task
each. Nothing is broadcast and nothing but the number of windows reaches the driver. A window in
very many documents adds two entries for each bundle, not one for each document.

Bundles are rows of a table in the shared folder: their texts, compressed. Every pass makes
the same windows of them again, so nothing depends on which task or executor does it.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import bounded_batches, file_place, text_of
from wayfare.llm.hashing import mixed, word_hashes, word_places
from wayfare.session import materialise_with, shared_dir

WINDOW = 35
# Words of a bundle; a longer document is a bundle of its own.
BUNDLE_WORDS = 1_000_000
# Hash rows of the sketch, and cells of each row for every window.
SKETCH_ROWS = 2
CELLS = 4
# Entries that one task merges at a time, about.
SHARD_ENTRIES = 2_000_000
# The row number of entries that are whole hashes of windows.
EXACT = -1

_U = np.uint64
# Odd numbers that windows are mixed with, by lane.
_MIX = (_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F))


# -- windows ----------------------------------------------------------------------------------


def window_hashes(words: np.ndarray, window: int) -> np.ndarray:
    """A hash for each run of `window` words, from hashes of runs of 1, 2, 4, ... words."""

    def joined(first: np.ndarray, second: np.ndarray, after: int) -> np.ndarray:
        n = max(0, second.shape[1] - after)
        return np.stack([
            mixed(first[lane, :n] * _MIX[1 - lane] + second[lane, after : after + n], lane)
            for lane in (0, 1)
        ])

    level, width, found, covered = words, 1, None, 0
    while True:
        if window & width:
            found = level if found is None else joined(found, level, covered)
            covered += width
        if 2 * width > window:
            return found
        level, width = joined(level, level, width), 2 * width


class Bundle:
    """The windows of a bundle's documents."""

    def __init__(self, texts: list[bytes], window: int):
        self.texts, self.window = texts, window
        data = np.frombuffer(b"\n".join(texts), np.uint8)
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        starts, ends = word_places(data)
        hashes = word_hashes(data, starts, ends)
        # Number of the first word of each document, and the number of all words.
        edges = np.concatenate([[0], np.cumsum(sizes)]) if len(texts) else np.zeros(1, np.int64)
        self.first = np.searchsorted(starts, edges)
        self.first[-1] = len(starts)
        counts = np.diff(self.first)
        enough = counts >= window
        marks = np.zeros(len(starts) + 1, np.int8)
        np.add.at(marks, self.first[:-1][enough], 1)
        np.add.at(marks, (self.first[1:] - window + 1)[enough], -1)
        # Number of the word that each window starts with.
        self.starts = np.flatnonzero(np.cumsum(marks[:-1], dtype=np.int8))
        self.hashes = window_hashes(hashes, window)[:, self.starts]

    def removed(self, repeated: np.ndarray) -> np.ndarray:
        """For each word, whether one of the windows marked as repeated covers it."""
        places = self.starts[repeated]
        marks = np.zeros(self.first[-1] + 1 + self.window, np.int64)
        marks[places] += 1
        marks[places + self.window] -= 1
        return np.cumsum(marks)[: self.first[-1]] > 0


# -- sorted entries --------------------------------------------------------------------------


def packed(values: np.ndarray) -> bytes:
    """Sorted numbers as differences, seven bits to a byte."""
    steps = np.diff(values, prepend=_U(0))
    sizes = np.ones(len(steps), np.int64)
    for k in range(1, 10):
        sizes += steps >> _U(7 * k) > 0
    ends = np.cumsum(sizes)
    out = np.zeros(ends[-1] if len(ends) else 0, np.uint8)
    for k in range(int(sizes.max(initial=0))):
        some = sizes > k
        more = (sizes[some] > k + 1).astype(np.uint8) << 7
        out[(ends - sizes)[some] + k] = (steps[some] >> _U(7 * k) & _U(127)).astype(np.uint8) | more
    return out.tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    data = np.frombuffer(blob, np.uint8)
    if not len(data):
        return np.zeros(0, _U)
    ends = np.flatnonzero(data < 128)
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
    digits = (data & 127).astype(_U) << (7 * place).astype(_U)
    return np.cumsum(np.add.reduceat(digits, starts))


class Runs:
    """Keys (columns) in order, in runs of equal ones.

    A run is sent as one entry, or as two if it is longer; `sent` are the places of these.
    """

    def __init__(self, keys: np.ndarray):
        self.order = np.argsort(keys[0]) if len(keys) == 1 else np.lexsort(keys[::-1])
        self.keys = keys[:, self.order]
        same = (self.keys[:, 1:] == self.keys[:, :-1]).all(axis=0)
        n = len(self.order)
        fresh = np.concatenate([[True], ~same])[:n]
        self.firsts = np.flatnonzero(fresh)
        self.run = np.cumsum(fresh) - 1
        self.sent = np.flatnonzero(~np.concatenate([[False, False], same[1:] & same[:-1]])[:n])

    def entries(self) -> np.ndarray:
        return self.keys[:, self.sent]

    def each(self, of_run: np.ndarray) -> np.ndarray:
        """What holds for its run, for each key in the order given."""
        out = np.zeros(len(self.order), bool)
        out[self.order] = of_run[self.run]
        return out

    def marked(self, bits: np.ndarray) -> np.ndarray:
        """For each key, the bit of the entry sent for it."""
        return self.each(bits[np.searchsorted(self.sent, self.firsts)])


class Sketch:
    """Sizes of the sketch, and what a bundle sends and gets back."""

    def __init__(self, windows: int, shards: int, cells: int = CELLS, rows: int = SKETCH_ROWS):
        self.bits = max(10, (cells * windows - 1).bit_length())
        self.shard_bits = min((shards - 1).bit_length(), self.bits)
        self.rows = rows

    def runs(self, hashes: np.ndarray, row: int) -> Runs:
        """The cells of the windows in a row of the sketch, or the whole hashes."""
        if row == EXACT:
            return Runs(hashes)
        cells = mixed(hashes[0] + _U(2 * row + 1) * hashes[1], row % 2)
        return Runs((cells >> _U(64 - self.bits))[None])

    def cuts(self, runs: Runs, row: int) -> np.ndarray:
        """Where the entries of each shard begin: shards go by the highest bits."""
        entries = runs.entries()[0]
        width = 64 if row == EXACT else self.bits
        limits = np.arange(1, 1 << self.shard_bits, dtype=_U) << _U(width - self.shard_bits)
        return np.concatenate([[0], np.searchsorted(entries, limits), [len(entries)]])

    def sent(self, hashes: np.ndarray, row: int) -> Iterator[tuple[int, bytes]]:
        """(shard, entries) of a bundle's own sketch, or of its windows."""
        runs = self.runs(hashes, row)
        entries, cuts = runs.entries(), self.cuts(runs, row)
        for shard, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())):
            if b > a:
                part = entries[:, a:b]
                yield shard, packed(part[0]) if row != EXACT else np.ascontiguousarray(part).tobytes()

    def twice(self, hashes: np.ndarray, row: int, answers: dict[int, bytes]) -> np.ndarray:
        """For each window, whether the answers (by shard) to what was sent count it twice."""
        runs = self.runs(hashes, row)
        cuts = self.cuts(runs, row)
        bits = np.zeros(len(runs.sent), bool)
        for shard, blob in answers.items():
            a, b = cuts[shard], cuts[shard + 1]
            bits[a:b] = np.unpackbits(np.frombuffer(blob, np.uint8), count=b - a)
        return runs.marked(bits)

    def maybe(self, hashes: np.ndarray, answers: dict[int, dict[int, bytes]]) -> np.ndarray:
        """Windows whose count is two or more in every row."""
        found = np.ones(hashes.shape[1], bool)
        for row in range(self.rows):
            found &= self.twice(hashes, row, answers.get(row, {}))
        return found


def occur_twice(row: int, blobs: list[bytes]) -> list[bytes]:
    """For each blob of a shard, one bit per entry: whether it occurs twice in all of them."""
    if row == EXACT:
        parts = [np.frombuffer(blob, _U).reshape(2, -1) for blob in blobs]
    else:
        parts = [unpacked(blob)[None] for blob in blobs]
    runs = Runs(np.concatenate(parts, axis=1))
    bits = runs.each(np.bincount(runs.run) > 1)
    cuts = np.cumsum([part.shape[1] for part in parts])
    return [np.packbits(b).tobytes() for b in np.split(bits, cuts[:-1])]


# -- Spark jobs ------------------------------------------------------------------------------

BUNDLES = "part int, seq int, n_windows long, docs binary"
ENTRIES = "part int, seq int, row int, shard int, entries binary"
ANSWERS = "part int, seq int, row int, shard int, bits binary"


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [field.split() for field in schema.split(", ")]
    columns = zip(*rows) if rows else [[]] * len(fields)
    arrays = [pa.array(column, kinds[kind]) for (_, kind), column in zip(fields, columns)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def bundled(docs: DataFrame, window: int, words: int = BUNDLE_WORDS) -> tuple[DataFrame, int]:
    """The documents in compressed bundles, as a stored table, and the number of windows."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        ids: list[int | None] = []
        texts: list[bytes] = []
        held = windows = seq = 0

        def out() -> pa.RecordBatch:
            table = pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.binary())})
            sink = io.BytesIO()
            options = pa.ipc.IpcWriteOptions(compression="zstd")
            with pa.ipc.new_stream(sink, table.schema, options=options) as stream:
                stream.write_table(table)
            return _batch(BUNDLES, [(part, seq, windows, sink.getvalue())])

        for batch in batches:
            read = batch.column("text").cast(pa.binary()).to_pylist()
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), read):
                n = len(text.split())
                if texts and held + n > words:
                    yield out()
                    ids, texts, held, windows, seq = [], [], 0, 0, seq + 1
                ids.append(doc_id)
                texts.append(text)
                held += n
                windows += max(0, n - window + 1)
        if texts:
            yield out()

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    stored, seen = materialise_with(
        read.mapInArrow(fill, BUNDLES), windows=F.coalesce(F.sum("n_windows"), F.lit(0))
    )
    return stored, seen["windows"]


def _opened(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


class Answers:
    """What was sent back to the bundles of one part, from the files of `folder`."""

    def __init__(self, folder: str):
        self._folder, self._part, self._table = folder, None, None

    def of(self, part: int, seq: int) -> dict[int, dict[int, bytes]]:
        """The bits by row and shard."""
        if self._part != part:
            files, place = file_place(f"{self._folder}/part={part}")
            self._table, self._part = None, part
            if files.get_file_info(place).type == pa.fs.FileType.Directory:
                listed = files.get_file_info(pa.fs.FileSelector(place))
                self._table = pa.concat_tables(
                    pq.read_table(f.path, filesystem=files, partitioning=None)
                    for f in listed
                    if f.path.endswith(".parquet")
                )
        bits: dict[int, dict[int, bytes]] = {}
        if self._table is not None:
            mine = self._table.filter(pc.equal(self._table["seq"], seq))
            for row, shard, blob in zip(*(mine[c].to_pylist() for c in ("row", "shard", "bits"))):
                bits.setdefault(row, {})[shard] = blob
        return bits


_answers: dict[str, Answers] = {}


def _kept_answers(folder: str) -> Answers:
    """One reader per worker and folder; those of other jobs go."""
    if folder not in _answers:
        while len(_answers) > 1:
            del _answers[next(iter(_answers))]
        _answers[folder] = Answers(folder)
    return _answers[folder]


def _answered(entries: DataFrame, partitions: int) -> str:
    """Merge entries shard by shard, and store what each bundle gets back by its part."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by row and shard; a shard may span batches."""
        key, rows = None, []

        def out() -> pa.RecordBatch:
            found = occur_twice(key[0], [r[-1] for r in rows])
            return _batch(ANSWERS, [(*r[:4], bits) for r, bits in zip(rows, found)])

        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("part", "seq", "row", "shard", "entries"))):
                if r[2:4] != key:
                    if rows:
                        yield out()
                    key, rows = r[2:4], []
                rows.append(r)
        if rows:
            yield out()

    dealt = entries.repartition(partitions, "row", "shard").sortWithinPartitions("row", "shard")
    answers = dealt.mapInArrow(merge, ANSWERS)
    folder = shared_dir(entries.sparkSession)
    answers.repartition(partitions, "part").sortWithinPartitions("part").write.partitionBy("part").parquet(folder)
    return folder


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words (joined by a blank) of every row.

    A word is removed if a window of `window` words that covers it occurs anywhere else too, in
    this or another row. Windows are judged on the input. A null text has no words, like an empty
    one; a text shorter than a window keeps all its words. A null doc_id stays null. Rows that
    are equal lose all windows they have. Other columns are not read. No rows give no rows. A
    document is held whole by one task, with some 100 bytes for each of its words.
    """
    spark = bounded_batches(docs.sparkSession)
    bundles, windows = bundled(docs, window)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(2 * partitions, windows // SHARD_ENTRIES)
    sketch = Sketch(windows, shards)

    def each_bundle(
        work: Callable[[int, int, pa.Table, Bundle], Iterator[pa.RecordBatch]],
    ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                columns = (batch.column(c).to_pylist() for c in ("part", "seq", "docs"))
                for part, seq, blob in zip(*columns):
                    table = _opened(blob)
                    yield from work(part, seq, table, Bundle(table["text"].to_pylist(), window))

        return run

    def cells(part: int, seq: int, table: pa.Table, bundle: Bundle) -> Iterator[pa.RecordBatch]:
        for row in range(sketch.rows):
            sent = sketch.sent(bundle.hashes, row)
            yield _batch(ENTRIES, [(part, seq, row, shard, blob) for shard, blob in sent])

    counted = _answered(bundles.mapInArrow(each_bundle(cells), ENTRIES), partitions)

    def candidates(part: int, seq: int, bundle: Bundle) -> np.ndarray:
        return sketch.maybe(bundle.hashes, _kept_answers(counted).of(part, seq))

    def exact(part: int, seq: int, table: pa.Table, bundle: Bundle) -> Iterator[pa.RecordBatch]:
        sent = sketch.sent(bundle.hashes[:, candidates(part, seq, bundle)], EXACT)
        yield _batch(ENTRIES, [(part, seq, EXACT, shard, blob) for shard, blob in sent])

    grouped = _answered(bundles.mapInArrow(each_bundle(exact), ENTRIES), partitions)

    def cut(part: int, seq: int, table: pa.Table, bundle: Bundle) -> Iterator[pa.RecordBatch]:
        repeated = candidates(part, seq, bundle)
        found = _kept_answers(grouped).of(part, seq).get(EXACT, {})
        repeated[repeated] = sketch.twice(bundle.hashes[:, repeated], EXACT, found)
        gone = bundle.removed(repeated)
        kept, n_words, n_removed = [], [], []
        for text, a, b in zip(bundle.texts, bundle.first.tolist(), bundle.first[1:].tolist()):
            mine = gone[a:b]
            lost = int(mine.sum())
            words = text.split()
            kept.append(b" ".join(compress(words, (~mine).tolist()) if lost else words))
            n_words.append(b - a)
            n_removed.append(lost)
        yield pa.RecordBatch.from_arrays(
            [
                table["doc_id"].combine_chunks(), pa.array(n_words, pa.int64()),
                pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            ["doc_id", "n_words", "n_removed", "kept"],
        )

    return bundles.mapInArrow(each_bundle(cut), "doc_id long, n_words long, n_removed long, kept string")



# For `documents`; windows are compared as texts, since words hold no blanks.
SQL = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
),
windows AS (
    SELECT r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS said
    FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM docs WHERE len(w) >= {WINDOW})
),
repeated AS (
    SELECT r, i FROM windows
    SEMI JOIN (SELECT said FROM windows GROUP BY said HAVING count(*) > 1) USING (said)
),
words AS (SELECT r, unnest(range(1, len(w) + 1)) AS j, unnest(w) AS word FROM docs),
marked AS (
    SELECT words.r, j, word,
        coalesce(max(i) OVER (PARTITION BY words.r ORDER BY j) >= j - {WINDOW - 1}, false) AS gone
    FROM words LEFT JOIN repeated ON repeated.r = words.r AND repeated.i = words.j
),
kept AS (
    SELECT r, count(*) FILTER (gone) AS n_removed,
        string_agg(word, ' ' ORDER BY j) FILTER (NOT gone) AS said
    FROM marked GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed,
    sha256(coalesce(said, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""
