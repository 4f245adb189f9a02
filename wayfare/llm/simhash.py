"""SimHash near-duplicates with BK-trees.

Fingerprints that differ in at most `radius` of 64 bits agree in at least one of radius + 1
bands of bits. A shard holds the distinct fingerprints that agree in one band; a shard with too
many of them is cut again by a band of the other bits, with the same guarantee. Each shard has a
BK-tree: a child hangs below its parent by their Hamming distance, and a search follows only
edges within the radius. A shard's tree goes to the one task that also holds its searches; trees
of all fingerprints are never sent to every task, because their size grows with the corpus.

A shard gives one link from each fingerprint to the root of its group there, not all pairs; the
groups of the corpus are the connected components of these links.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import ROW, bounded_batches, fields_of, text_of, whole_rows
from wayfare.llm.components import connected_components
from wayfare.session import materialise

BITS = 64
SHINGLE = 3
RADIUS = 3
SEED = 42
# A shard with more distinct fingerprints is cut again, at most so many times, and then in blocks.
SHARD_ROWS = 2000
DEPTH = 3
# Shingles whose bits are counted at once.
COUNTED = 1 << 16


# -- fingerprints ----------------------------------------------------------------------------


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """A bit is set if it is in over half of the shingles' hashes; no words give zero."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    windows = zip(*(words[k:] for k in range(shingle))) if len(words) >= shingle else [words]
    hashes = np.fromiter(
        map(xxhash.xxh64_intdigest, map(b" ".join, windows), repeat(seed)), np.uint64
    )
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), COUNTED):
        part = hashes[at : at + COUNTED].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed 64-bit integer."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        found = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
        return pd.Series(found.view(np.int64), index=texts.index)

    return of(text)


def fingerprint_hex(column: Column) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


# -- BK-tree ---------------------------------------------------------------------------------


class BKTree:
    """Distinct fingerprints by Hamming distance; also keeps which ones a search has linked."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []
        self.group: list[int] = []

    def add(self, value: int) -> int:
        node = len(self.values)
        self.values.append(value)
        self.children.append({})
        self.group.append(node)
        at = 0
        while node:
            distance = (self.values[at] ^ value).bit_count()
            below = self.children[at]
            if distance not in below:
                below[distance] = node
                break
            at = below[distance]
        return node

    def within(self, value: int, radius: int) -> Iterator[int]:
        """Nodes at most `radius` away."""
        values, children = self.values, self.children
        stack = [0] if values else []
        while stack:
            node = stack.pop()
            distance = (values[node] ^ value).bit_count()
            if distance <= radius:
                yield node
            below = children[node]
            if below:
                for edge in range(distance - radius, distance + radius + 1):
                    if edge in below:
                        stack.append(below[edge])

    def root(self, node: int) -> int:
        group = self.group
        while group[node] != node:
            group[node] = group[group[node]]
            node = group[node]
        return node


def shard_links(rows: Iterable[tuple[int, int]], radius: int = RADIUS) -> list[tuple[int, int]]:
    """(id, id of its group's root) for the members of one shard, given (fingerprint, id).

    Roots have the smallest id of their group. Each value is searched in the tree of the ones
    before it. Once all of these are one group, a single hit says all there is to know.
    """
    ordered = sorted(rows, key=lambda row: row[1])
    tree = BKTree()
    groups = 0
    for value, _ in ordered:
        mine = len(tree.values)
        found = set()
        for node in tree.within(value, radius):
            found.add(tree.root(node))
            if len(found) == groups:
                break
        tree.add(value)
        if found:
            low = min(found)
            for node in found:
                tree.group[node] = low
            tree.group[mine] = low
            groups -= len(found) - 1
        else:
            groups += 1
    return [
        (ordered[node][1], ordered[top][1])
        for node in range(len(ordered))
        if (top := tree.root(node)) != node
    ]


# -- shards ----------------------------------------------------------------------------------


def band_keys(value: Column, path: Column, masks: list[list[int]]) -> Column:
    """For each list of bit positions: (path so far, band number, the bits of the band)."""

    def bits(positions: list[int]) -> Column:
        mask = sum(1 << p for p in positions)
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        return value.bitwiseAND(F.lit(signed).cast("long"))

    return F.array(
        *(
            F.struct(F.concat_ws("/", path, F.lit(str(k)), F.hex(bits(m))).alias("key"), F.lit(k).alias("band"))
            for k, m in enumerate(masks)
        )
    )


def bands(positions: list[int], radius: int) -> list[list[int]]:
    """Positions in radius + 1 bands of about equal width."""
    cuts = [round(k * len(positions) / (radius + 1)) for k in range(radius + 2)]
    return [positions[a:b] for a, b in zip(cuts, cuts[1:])]


def shard_members(
    values: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS, depth: int = DEPTH
) -> DataFrame:
    """(key, value, id): every pair within the radius has a key in common.

    Fingerprints of a shard agree in its band, so they differ only in the other bits. Too
    large a shard is cut by bands of those. Only sizes of shards are counted for that. What is
    too large after `depth` cuts is looked at in pairs of blocks.
    """
    rest = [(list(range(BITS)), values.withColumn("key", F.lit("")))]
    done: list[DataFrame] = []
    for level in range(depth):
        following = []
        for positions, rows in rest:
            cut = bands(positions, radius)
            exploded = rows.select(
                F.inline(band_keys(F.col("value"), F.col("key"), cut)), "value", "id"
            )
            sizes = exploded.groupBy("key").count().filter(F.col("count") > shard_rows)
            large = materialise(sizes)
            if large.isEmpty():
                done.append(exploded.select("key", "value", "id"))
                continue
            done.append(exploded.join(large, "key", "left_anti").select("key", "value", "id"))
            if level + 1 == depth:
                done.append(_in_blocks(exploded.join(large, "key"), shard_rows))
                continue
            cut_again = materialise(exploded.join(large.select("key"), "key", "left_semi"))
            for k, own in enumerate(cut):
                others = [p for p in positions if p not in own]
                part = cut_again.filter(F.col("band") == k).select("key", "value", "id")
                if not part.isEmpty():
                    following.append((others, part))
        rest = following
        if not rest:
            break
    members = done[0]
    for part in done[1:]:
        members = members.unionByName(part)
    return members


def _in_blocks(rows: DataFrame, shard_rows: int) -> DataFrame:
    """(key, value, id) of shards that no band cuts any more, in a shard for each pair of blocks.

    Blocks are dealt by hash, so a pair of them has about `shard_rows` rows; every two rows of a
    shard are together in one pair at least.
    """
    blocks = F.greatest(F.ceil(2 * F.col("count") / shard_rows), F.lit(2)).cast("int")
    own = F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int")
    dealt = rows.select("key", "value", "id", blocks.alias("_blocks")).withColumn("_own", own)
    paired = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    low, high = (f("_own", "_other").cast("string") for f in (F.least, F.greatest))
    pair = F.concat_ws("/", F.col("key"), F.concat_ws("-", low, high))
    return paired.filter("_own <> _other").select(pair.alias("key"), "value", "id")


def links(members: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): each id with the root of its group in a shard, a > b."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key; a shard may span batches."""
        key, rows = None, []

        def out() -> pa.RecordBatch:
            found = shard_links(rows, radius)
            return pa.RecordBatch.from_arrays(
                [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"]
            )

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("key", "value", "id"))
            for own, value, number in zip(*columns):
                if own != key:
                    if len(rows) > 1:
                        yield out()
                    key, rows = own, []
                rows.append((value & (1 << 64) - 1, number))
        if len(rows) > 1:
            yield out()

    dealt = members.repartition("key").sortWithinPartitions("key")
    return dealt.select("key", "value", "id").mapInArrow(search, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, `keep` columns, _fp (signed fingerprint), _group and component_id of every row.

    `_group` numbers the components, by the smallest of their signed fingerprints.

    component_id is the smallest doc_id of all rows linked directly or through others. A null
    text has no words, like an empty one: fingerprint zero, linked like any other. Rows without
    a doc_id take part; a component of such rows alone has a null id. Equal rows are equal
    results. No rows give no rows.
    """
    spark = bounded_batches(docs.sparkSession)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keep, text_of().alias("_text"))
    marked = materialise(
        read.withColumn("_fp", fingerprints(F.col("_text"), shingle)).drop("_text")
    )
    # Ids of distinct fingerprints must be unique: the fingerprint itself is one.
    distinct = materialise(marked.groupBy("_fp").agg(F.min("doc_id").alias("_first")))
    values = distinct.select(F.col("_fp").alias("value"), F.col("_fp").alias("id"))
    groups = connected_components(links(shard_members(values, radius), radius))
    named = materialise(
        distinct.join(groups.withColumnRenamed("node", "_fp"), "_fp", "left").select(
            "_fp", "_first", F.coalesce("root", "_fp").alias("_root")
        )
    )
    smallest = materialise(named.groupBy("_root").agg(F.min("_first").alias("component_id")))
    ids = named.join(smallest, "_root").select("_fp", F.col("_root").alias("_group"), "component_id")
    ids = materialise(ids)
    return marked.join(ids, "_fp").select("doc_id", *keep, "_fp", "_group", "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of `docs` for each group of near-duplicates, with its columns.

    It is the row of the smallest doc_id, one without doc_id only where none has any; of equal
    ones any single row.
    """
    numbered = whole_rows(docs)
    read = numbered.select(ROW, "_doc.doc_id", "_doc.text")
    found = materialise(near_duplicates(read, shingle, radius, keep=(ROW,)))
    first = found.groupBy("_group").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", ROW)).alias("_first")
    )
    first = materialise(first.select(F.col(f"_first.{ROW}").alias(ROW)))
    # Always merged: a broadcast would do for a small corpus only.
    return numbered.join(first.hint("merge"), ROW, "left_semi").select(*fields_of(numbered))
