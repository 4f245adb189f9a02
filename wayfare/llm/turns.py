"""Repair of conversation structure by a grammar-compressed dynamic programme.

A row of a conversation is one symbol: the initial of its role and its fault. A conversation is a
string of symbols, cut into chunks of at most CHUNK where it is long. Edits are to make the role
initials read `(s?(ua)+)?`, which is an automaton of four states. For a string of symbols, the
least cost of going from one state to another, with the edits that do it, is a matrix of four by
four; strings that follow each other multiply by minimum and sum.

Conversations have much in common, so a grammar is made of all of them by Re-Pair: pairs of
symbols that stand next to each other are counted over all distinct strings, weighted by how often
each occurs, and the most frequent ones become symbols of their own, a batch of RULES in
each of ROUNDS rounds. Each rule has one matrix, made from those of its two symbols, whatever
number of conversations uses it; its edits are ropes, which share those of the parts. A string is
then a few symbols, and its result a product of a few matrices. The grammar has at most
RULES * ROUNDS rules, so it goes to all tasks.

Rows are ordered by ranges of (conversation, turn), so that one very long conversation is spread
over tasks, and its chunks are put together afterwards. Equal cheapest edits are told apart by
their letters. Two strings of edits of equal cost never begin one another, since what the longer
one has more are insertions, which cost; so the least of a whole is made of the least of its parts.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import bounded_batches
from wayfare.session import materialise

# Damage by the check sum of a row, modulo this.
KINDS = 20
DROPPED, EMPTIED, CUT_OFF, REPEATED, REROLED = range(5)

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
# Symbols: 3 * class + fault, with classes by role initial and faults as below.
INITIALS = "sua"
OTHER = 3
SOUND, CUT, MUST_GO = range(3)
TERMINALS = 12

# States of the automaton, and where each initial leads.
START, S, U, A = range(4)
STEPS = {(START, "s"): S, (START, "u"): U, (S, "u"): U, (U, "a"): A, (A, "u"): U}
LEGAL = {"su", "ua", "au"}
# What an insertion adds in a state.
INSERTED = {START: "u", S: "u", U: "a", A: "u"}
ROLES = {"u": "user", "a": "assistant"}

CHUNK = 4096
RULES = 256
ROUNDS = 12
LARGEST = (1 << 63) - 1
# Strings whose result a worker keeps.
KEPT_STRINGS = 50_000


# -- rows ------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after damage; a null role, text or part of the check sum counts as one blank."""
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    )
    kind = F.crc32(key.cast("binary")) % KINDS
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    copies = F.when(kind == REPEATED, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.filter(kind != DROPPED).select(
        "conv_id", "turn",
        F.when(kind == REROLED, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == EMPTIED, F.lit(""))
        .when(kind == CUT_OFF, F.translate(text, ".!?", ""))
        .otherwise(text).alias("text"),
        F.explode(copies).alias("copy"),
    )


def _named(rows: DataFrame) -> DataFrame:
    """`_c` names a conversation: its id in decimal, empty for those without."""
    return rows.withColumn("_c", F.coalesce(F.col("conv_id").cast("long").cast("string"), F.lit("")))


ORDER = ("turn", "role", "said", "copy")


def _order() -> list[Column]:
    """Rows of a conversation: by turn (none first), equal turns by role and digest of the text."""
    return [F.asc_nulls_first(c) for c in ORDER]


def with_faults(rows: DataFrame) -> DataFrame:
    """Narrow rows: _c, the order columns, kind, blank, truncated, later.

    `later` marks rows whose role and text stood earlier: the first place of each is an
    aggregate, which is joined back.
    """
    initial = F.substring("role", 1, 1)
    kind = F.coalesce(*(F.when(initial == c, F.lit(k)) for k, c in enumerate(INITIALS)), F.lit(OTHER))
    narrow = materialise(rows.select(
        "_c", *ORDER, kind.alias("kind"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"),
    ))
    place = F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)), "copy")
    first = narrow.groupBy("_c", "said").agg(F.min(place).alias("_first"))
    # Equal rows have equal places; the chunks tell these apart.
    return narrow.join(first, ["_c", "said"]).withColumn("later", place != F.col("_first")).drop("_first")


# -- chunks ----------------------------------------------------------------------------------

CHUNKS = (
    "_c string, part int, k int, whole boolean, symbols binary, blank long, duplicate long, "
    "truncated long, illegal long, first int, last int, first_turn long, last_turn long, turns long"
)


class _Chunk:
    """Symbols and figures of rows of one conversation that follow each other."""

    def __init__(self) -> None:
        self.symbols: list[int] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = None
        self.first_turn = self.last_turn = None

    def add(self, kind: int, blank: bool, duplicate: bool, truncated: bool, turn: int | None) -> None:
        fault = SOUND
        if blank or duplicate:
            fault = MUST_GO
            self.blank += blank
            self.duplicate += not blank
        elif truncated:
            fault = CUT
            self.truncated += 1
        if self.last is None:
            self.first = kind
        else:
            self.illegal += not legal(self.last, kind)
        self.last = kind
        if turn is not None:
            if self.first_turn is None:
                self.first_turn = turn
            self.turns += turn != self.last_turn
            self.last_turn = turn
        self.symbols.append(3 * kind + fault)

    def row(self, name: str, part: int, k: int, whole: bool) -> tuple:
        return (
            name, part, k, whole, np.array(self.symbols, "<u2").tobytes(), self.blank, self.duplicate,
            self.truncated, self.illegal, self.first, self.last, self.first_turn, self.last_turn, self.turns,
        )


def legal(before: int, after: int) -> bool:
    return OTHER not in (before, after) and INITIALS[before] + INITIALS[after] in LEGAL


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {
        "string": pa.string(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(),
        "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
    }
    fields = [field.split() for field in schema.split(", ")]
    columns = zip(*rows) if rows else [[]] * len(fields)
    arrays = [pa.array(column, kinds[kind]) for (_, kind), column in zip(fields, columns)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def _columns(batch: pa.RecordBatch, names: Iterable[str]) -> Iterator[tuple]:
    return zip(*(batch.column(name).to_pylist() for name in names))


def chunks_of(faults: DataFrame, size: int = CHUNK) -> DataFrame:
    """Chunks of all conversations, stored; `whole` marks those that surely are a conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        name, k, chunk, seen, edge = None, 0, _Chunk(), None, True
        rows: list[tuple] = []
        for batch in batches:
            for own, turn, copy, role, said, kind, blank, cut, later in _columns(
                batch, ("_c", "turn", "copy", "role", "said", "kind", "blank", "truncated", "later")
            ):
                if own != name:
                    if name is not None:
                        # The first conversation of a partition may have begun before it.
                        rows.append(chunk.row(name, part, k, not edge and k == 0))
                        edge = False
                    name, k, chunk, seen = own, 0, _Chunk(), None
                elif len(chunk.symbols) >= size:
                    rows.append(chunk.row(name, part, k, False))
                    k, chunk = k + 1, _Chunk()
                place = (turn, role, said, copy)
                # Equal rows stand next to each other: all but the first are duplicates too.
                chunk.add(kind, blank, later or place == seen, cut, turn)
                seen = place
            if rows:
                yield _batch(CHUNKS, rows)
                rows = []
        if name is not None:
            yield _batch(CHUNKS, [chunk.row(name, part, k, False)])

    ordered = faults.repartitionByRange("_c", *_order()).sortWithinPartitions("_c", *_order())
    return materialise(ordered.mapInArrow(run, CHUNKS))


# -- grammar ---------------------------------------------------------------------------------


def pair_counts(symbols: list[int]) -> Counter:
    """How often each pair can be replaced: in a row of equal symbols, every second time."""
    found: Counter = Counter()
    before = None
    for pair in zip(symbols, symbols[1:]):
        if pair == before and pair[0] == pair[1]:
            before = None
            continue
        found[pair] += 1
        before = pair
    return found


def replaced(symbols: list[int], rules: dict[tuple[int, int], int]) -> list[int]:
    """From left to right, pairs that are rules as their symbol."""
    out, at, n = [], 0, len(symbols)
    while at < n:
        rule = rules.get((symbols[at], symbols[at + 1])) if at + 1 < n else None
        out.append(symbols[at] if rule is None else rule)
        at += 1 if rule is None else 2
    return out


def numbers(blob: bytes) -> list[int]:
    return np.frombuffer(blob, "<u2").tolist()


def grammar_of(chunks: DataFrame, rules: int = RULES, rounds: int = ROUNDS) -> list[list[tuple[int, int]]]:
    """Pairs that became symbols, by round; they are numbered from TERMINALS on."""
    if TERMINALS + rules * rounds > 1 << 16:
        raise ValueError("too many rules for symbols of 16 bits")
    strings = materialise(chunks.groupBy("symbols").agg(F.count(F.lit(1)).alias("n")))
    found: list[list[tuple[int, int]]] = []

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for blob, n in _columns(batch, ("symbols", "n")):
                for pair, times in pair_counts(numbers(blob)).items():
                    counts[pair] += n * times
        yield _batch("a int, b int, n long", [(a, b, n) for (a, b), n in counts.items()])

    for _ in range(rounds):
        pairs = strings.mapInArrow(count, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
        best = pairs.filter("n > 1").orderBy(F.desc("n"), "a", "b").limit(rules).collect()
        if not best:
            break
        base = TERMINALS + sum(map(len, found))
        found.append([(row.a, row.b) for row in best])
        names = {pair: base + k for k, pair in enumerate(found[-1])}

        def replace(batches: Iterator[pa.RecordBatch], names: dict = names) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [
                    (np.array(replaced(numbers(blob), names), "<u2").tobytes(), n)
                    for blob, n in _columns(batch, ("symbols", "n"))
                ]
                yield _batch("symbols binary, n long", rows)

        strings = materialise(strings.mapInArrow(replace, "symbols binary, n long"))
    return found


# -- matrices --------------------------------------------------------------------------------


class Rope:
    """Edits, as text or as two ropes after each other."""

    __slots__ = ("left", "right", "text")

    def __init__(self, text: str | None, left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right

    def leaves(self) -> Iterator[str]:
        stack = [self]
        while stack:
            node = stack.pop()
            if node.text is None:
                stack += (node.right, node.left)
            elif node.text:
                yield node.text

    def __str__(self) -> str:
        return "".join(self.leaves())

    def __lt__(self, other: Rope) -> bool:
        mine, its = self.leaves(), other.leaves()
        a = b = ""
        while True:
            a, b = a or next(mine, ""), b or next(its, "")
            if not a or not b:
                return bool(b)
            n = min(len(a), len(b))
            if a[:n] != b[:n]:
                return a[:n] < b[:n]
            a, b = a[n:], b[n:]


# Least cost and its edits from a state (row) to a state (column); None where there is no way.
Entry = tuple[int, Rope] | None
Matrix = list[list[Entry]]
NOTHING = Rope("")


def _joined(a: Rope, b: Rope) -> Rope:
    if a is NOTHING:
        return b
    return a if b is NOTHING else Rope(None, a, b)


def _insertions() -> Matrix:
    """Shortest ways from state to state by insertions alone."""
    found: Matrix = [[None] * 4 for _ in range(4)]
    for state in range(4):
        at, n = state, 0
        while found[state][at] is None:
            found[state][at] = (INSERT * n, Rope("I" * n) if n else NOTHING)
            at, n = STEPS[at, INSERTED[at]], n + 1
    return found


def least(entries: Iterable[Entry]) -> Entry:
    best: Entry = None
    for entry in entries:
        if entry is None:
            continue
        if best is None or entry[0] < best[0] or entry[0] == best[0] and entry[1] < best[1]:
            best = entry
    return best


def times(row: list[Entry], matrix: Matrix) -> list[Entry]:
    """A row of a matrix times a matrix, by minimum and sum."""
    return [
        least(
            (row[k][0] + matrix[k][j][0], _joined(row[k][1], matrix[k][j][1]))
            for k in range(4)
            if row[k] is not None and matrix[k][j] is not None
        )
        for j in range(4)
    ]


INSERTIONS = _insertions()


def terminal(symbol: int) -> Matrix:
    """Insertions, then one edit of a row."""
    kind, fault = divmod(symbol, 3)
    edits: Matrix = [[None] * 4 for _ in range(4)]
    more = TRUNCATED if fault == CUT else 0
    for state in range(4):
        ways: list[tuple[int, Entry]] = [(state, (DELETE, Rope("D")))]
        if fault != MUST_GO:
            if kind != OTHER and (state, INITIALS[kind]) in STEPS:
                ways.append((STEPS[state, INITIALS[kind]], (KEEP + more, Rope("K"))))
            ways += [
                (STEPS[state, initial], (REROLE + more, Rope("R")))
                for initial in ROLES
                if (state, initial) in STEPS
            ]
        for to in range(4):
            edits[state][to] = least(entry for place, entry in ways if place == to)
    return [times(row, edits) for row in INSERTIONS]


class Evaluator:
    """Matrices of terminals and rules, each made once, and results of whole strings."""

    def __init__(self, grammar: list[list[tuple[int, int]]]):
        self._rounds: list[dict[tuple[int, int], int]] = []
        self.matrices: list[Matrix] = [terminal(symbol) for symbol in range(TERMINALS)]
        for pairs in grammar:
            self._rounds.append({pair: len(self.matrices) + k for k, pair in enumerate(pairs)})
            for a, b in pairs:
                self.matrices.append([times(row, self.matrices[b]) for row in self.matrices[a]])
        self._kept: dict[tuple[bytes, bool], tuple[list, list]] = {}

    def parsed(self, symbols: list[int]) -> list[int]:
        for rules in self._rounds:
            if len(symbols) < 2:
                break
            symbols = replaced(symbols, rules)
        return symbols

    def of(self, blob: bytes, whole: bool) -> tuple[list[int | None], list[str | None]]:
        """Costs and edits by pair of states; only from START for a whole conversation."""
        found = self._kept.get((blob, whole))
        if found is None:
            symbols = self.parsed(numbers(blob))
            entries: list[Entry] = []
            for state in range(1 if whole else 4):
                row: list[Entry] = [None] * 4
                row[state] = (0, NOTHING)
                for symbol in symbols:
                    row = times(row, self.matrices[symbol])
                entries += row
            found = [e and e[0] for e in entries], [e and str(e[1]) for e in entries]
            if len(blob) <= 256:
                if len(self._kept) >= KEPT_STRINGS:
                    self._kept.clear()
                self._kept[blob, whole] = found
        return found


def finished(row: list[Entry]) -> Entry:
    """With insertions after the last row, in a state where a conversation may end."""
    ends = times(row, INSERTIONS)
    return least([ends[START], ends[A]])


# -- conversations ---------------------------------------------------------------------------

_FIGURES = [field.split()[0] for field in CHUNKS.split(", ")[5:]]
_VALUED = "_c string, part int, k int, costs array<long>, edits array<string>, " + CHUNKS.split("binary, ")[1]
AUDITS = (
    "_c string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)


def audits_of(chunks: DataFrame, grammar: list[list[tuple[int, int]]]) -> DataFrame:
    """Figures, cost and cheapest edits of each conversation that has rows."""

    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evaluator = Evaluator(grammar)
        for batch in batches:
            rows = [
                (name, part, k, *evaluator.of(blob, whole), *figures)
                for name, part, k, whole, blob, *figures in _columns(
                    batch, ("_c", "part", "k", "whole", "symbols", *_FIGURES)
                )
            ]
            yield _batch(_VALUED, rows)

    def out(name: str, row: list[Entry], sums: list[int], ends: list) -> tuple:
        _, first_turn, last_turn, turns = ends
        cost, edits = finished(row)
        gaps = 0 if first_turn is None else last_turn - first_turn + 1 - turns
        return (name, min(gaps, LARGEST), *sums, cost, str(edits))

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunks come in order; a conversation may span batches."""
        name, row, sums, ends = None, [], [], []
        for batch in batches:
            done = []
            for own, costs, edits, *figures in _columns(batch, ("_c", "costs", "edits", *_FIGURES)):
                entries = [None if c is None else (c, Rope(e)) for c, e in zip(costs, edits)]
                *counts, first, last, first_turn, last_turn, turns = figures
                if own != name:
                    if name is not None:
                        done.append(out(name, row, sums, ends))
                    name, row, sums, ends = own, entries[:4], counts, [last, first_turn, last_turn, turns]
                    continue
                row = times(row, [entries[at : at + 4] for at in range(0, 16, 4)])
                sums = [a + b for a, b in zip(sums, counts)]
                sums[-1] += not legal(ends[0], first)
                ends[0] = last
                if first_turn is not None:
                    ends[3] += turns - (first_turn == ends[2])
                    ends[1] = first_turn if ends[1] is None else ends[1]
                    ends[2] = last_turn
            if done:
                yield _batch(AUDITS, done)
        if name is not None:
            yield _batch(AUDITS, [out(name, row, sums, ends)])

    valued = chunks.mapInArrow(evaluate, _VALUED)
    dealt = valued.repartition("_c").sortWithinPartitions("_c", "part", "k")
    return materialise(dealt.mapInArrow(combine, AUDITS))


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str | None, str | None]]:
    """(conversation, role, text) of every repaired row; (conversation, None, None) at its end.

    Rows come by conversation, the one with the audit first.
    """
    name, audit, at, state = None, "", 0, START

    def inserted() -> Iterator[tuple[str, str, str]]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            initial = INSERTED[state]
            state, at = STEPS[state, initial], at + 1
            yield name, ROLES[initial], ""

    for batch in batches:
        for own, edits, role, text in _columns(batch, ("_c", "audit", "role", "text")):
            if edits is not None:
                if name is not None:
                    yield from inserted()
                    yield name, None, None
                name, audit, at, state = own, edits, 0, START
                continue
            yield from inserted()
            edit, at = audit[at], at + 1
            if edit == "D":
                continue
            if edit == "R":
                role = ROLES[INSERTED[state]]
            state = STEPS[state, role[0]]
            yield name, role, text
    if name is not None:
        yield from inserted()
        yield name, None, None


def _beside(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Rows with the audit before them, by conversation and in order."""
    none = F.lit(None)
    first = audits.select(
        "_c", F.lit(0).alias("_kind"), none.cast("long").alias("turn"), none.cast("string").alias("role"),
        none.cast("string").alias("said"), none.cast("int").alias("copy"), none.cast("string").alias("text"),
        "audit",
    )
    rest = rows.select("_c", F.lit(1).alias("_kind"), *ORDER, "text", none.cast("string").alias("audit"))
    dealt = first.unionByName(rest).repartition("_c").sortWithinPartitions("_c", "_kind", *_order())
    return dealt.select("_c", "audit", "role", "text")


def _prepared(conversations: DataFrame, damage: bool) -> tuple[DataFrame, DataFrame]:
    """(rows with a name and digest, audits), both stored."""
    bounded_batches(conversations.sparkSession)
    read = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    if damage:
        rows = damaged(read)
    else:
        blank = F.lit(" ")
        rows = read.select(
            "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
            F.lit(0).alias("copy"),
        )
    # The length keeps role and text apart.
    said = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
    rows = materialise(_named(rows).withColumn("said", said))
    chunks = chunks_of(with_faults(rows))
    return rows, audits_of(chunks, grammar_of(chunks))


def repaired_rows(conversations: DataFrame, damage: bool = False) -> DataFrame:
    """conv_id, place (from 0), role and text of the rows of repaired conversations.

    See `repair` for what is done. Conversations without rows after repair have none here.
    """
    rows, audits = _prepared(conversations, damage)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, place = [], 0
        for name, role, text in _edited(batches):
            if role is None:
                place = 0
                continue
            out.append((int(name) if name else None, place, role, text))
            place += 1
            if len(out) >= 1000:
                yield _batch("conv_id long, place long, role string, text string", out)
                out = []
        yield _batch("conv_id long, place long, role string, text string", out)

    return _beside(rows, audits).mapInArrow(run, "conv_id long, place long, role string, text string")


def repair(conversations: DataFrame, damage: bool = False) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    One row for each conv_id, rows without one being a conversation too. With `damage`, rows
    are damaged first. A null role or text is one blank. Rows of a conversation go by turn, null ones
    first, those of equal turns by role and digest of role and text. A row is blank without a visible character,
    else duplicate if its role and text stood earlier, else truncated if its last visible character
    is none of `.!?`. gaps are turns missing between the first and the last, at most 2**63 - 1. The audit are the
    cheapest edits, the least ones of equal cost; the digest is that of the repaired rows as
    `role:text`, joined by newlines. A conversation without rows has zeros and the
    digest of an empty text. Other columns are not read. No rows give no rows.

    A conversation's text is read by one task, row by row, since its digest is a sequence; all
    else is spread over tasks however long a conversation is.
    """
    rows, audits = _prepared(conversations, damage)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, seen, fresh = [], hashlib.sha256(), True
        for name, role, text in _edited(batches):
            if role is None:
                out.append((name, seen.hexdigest()))
                seen, fresh = hashlib.sha256(), True
                if len(out) >= 1000:
                    yield _batch("_c string, repaired_sha256 string", out)
                    out = []
                continue
            seen.update(f"{'' if fresh else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
            fresh = False
        yield _batch("_c string, repaired_sha256 string", out)

    digests = _beside(rows, audits).mapInArrow(digest, "_c string, repaired_sha256 string")
    every = _named(conversations.select(F.col("conv_id").cast("long").alias("conv_id")))
    named = every.groupBy("_c").agg(F.min("conv_id").alias("conv_id"))
    found = named.join(audits, "_c", "left").join(digests, "_c", "left")
    zeros = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        "conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in zeros),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
