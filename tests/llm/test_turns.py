"""Conversation repair against a plain dynamic programme and against all edits."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from wayfare.llm import turns as T
from wayfare.llm.common import table

BLANKS = " \t\n\x0b\x0c\r"
GOAL = re.compile(r"(s?(ua)+)?")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def digest_of(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def faults(rows):
    seen, found = set(), []
    for _, _, role, text in rows:
        visible = text.strip(BLANKS)
        if not visible:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("" if visible[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def step(state, initial):
    return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))


def plain_repair(rows, found):
    """(cost, audit, lines) by a table of states after each row."""
    def inserted(best):
        for _ in range(3):
            for state, (cost, audit, lines) in list(best.items()):
                for role in ("user", "assistant"):
                    to = step(state, role[0])
                    if to is not None:
                        new = (cost + 3, audit + "I", [*lines, f"{role}:"])
                        if to not in best or new[:2] < best[to][:2]:
                            best[to] = new
        return best

    best = inserted({"": (0, "", [])})
    for (_, _, role, text), fault in zip(rows, found):
        after = {}

        def offer(state, cost, audit, lines):
            if state is not None and (state not in after or (cost, audit) < after[state][:2]):
                after[state] = (cost, audit, lines)

        for state, (cost, audit, lines) in best.items():
            offer(state, cost + 4, audit + "D", lines)
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault == "truncated" else 0
            offer(step(state, role[:1]), cost + more, audit + "K", [*lines, f"{role}:{text}"])
            for new in ("user", "assistant"):
                offer(step(state, new[0]), cost + 3 + more, audit + "R", [*lines, f"{new}:{text}"])
        best = inserted(after)
    return min(best[s] for s in ("", "a") if s in best)


def all_edits(rows, found):
    """(cost, audit, lines) by trying all edits with up to four insertions in one place."""
    best = None
    n = len(rows)
    choices = [["D"] if f in ("blank", "duplicate") else ["D", "K", "user", "assistant"] for f in found]
    for edits in itertools.product(*choices):
        for gaps in itertools.product(range(4), repeat=n + 1):
            for first in itertools.product(("user", "assistant"), repeat=n + 1):
                cost, audit, lines = 0, "", []
                for k in range(n + 1):
                    role = first[k]
                    for _ in range(gaps[k]):
                        lines.append(f"{role}:")
                        audit += "I"
                        cost += 3
                        role = "assistant" if role == "user" else "user"
                    if k == n:
                        break
                    if edits[k] == "D":
                        cost, audit = cost + 4, audit + "D"
                        continue
                    own = rows[k][2] if edits[k] == "K" else edits[k]
                    cost += (0 if edits[k] == "K" else 3) + 3 * (found[k] == "truncated")
                    audit += "K" if edits[k] == "K" else "R"
                    lines.append(f"{own}:{rows[k][3]}")
                if GOAL.fullmatch("".join(line[0] if line[0] != ":" else "?" for line in lines)):
                    best = min(best or (cost, audit, lines), (cost, audit, lines))
    return best


def plain(rows, damaged=True):
    done = damage(rows) if damaged else [(c, t, r or " ", x or " ") for c, t, r, x in rows]
    by = defaultdict(list)
    for row in done:
        by[row[0]].append(row)
    out = []
    for conv in {row[0] for row in rows}:
        mine = sorted(by[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], digest_of(r[2], r[3])))
        found = faults(mine)
        cost, audit, lines = plain_repair(mine, found) if mine else (0, "", [])
        known = [r[1] for r in mine if r[1] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        initials = [r[2][:1] for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        counts = Counter(found)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest))
    return Counter(out)


SCHEMA = "conv_id long, turn long, role string, text string, audit string, _c string, copy long, said string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", None, "d") for r in rows], SCHEMA).repartition(4)


def random_rows(seed, conversations=60, longest=12):
    source = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(source.randrange(longest)):
            role = source.choice(["system", "user", "assistant", "user", "assistant", "tool", ""])
            text = source.choice(["Yes.", "No", "What?", "", " \n", "Go on!\t ", f"t{turn}.", f"u{turn} "])
            rows.append((conv, 2 * turn - source.randrange(3), role, text))
    return list({(r[0], r[1]): r for r in rows}.values())


def rows_of(df):
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return Counter(map(tuple, df.select(*names).collect()))


@pytest.mark.parametrize("seed", range(3))
def test_equal_to_a_plain_version(spark, seed):
    rows = random_rows(seed)
    assert rows_of(T.repair(frame(spark, rows), damage=True)) == plain(rows)
    assert rows_of(T.repair(frame(spark, rows))) == plain(rows, damaged=False)


def test_the_plain_version_tries_enough():
    source = random.Random(5)
    for _ in range(60):
        rows = [
            (1, k, source.choice(["system", "user", "assistant", "tool"]), source.choice(["a.", "b", "", f"c{k}!"]))
            for k in range(source.randrange(4))
        ]
        found = faults(rows)
        assert plain_repair(rows, found)[:2] == all_edits(rows, found)[:2]


def test_the_table_given(spark):
    folder = "/root/testdata/sf0.001"
    df = table(spark, folder, "conversations")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(T.repair(df, damage=True)) == plain(rows)


def test_odd_rows(spark):
    rows = [
        (None, None, None, None), (None, 1, "user", "x."), (None, None, "user", None), (1, None, "user", "Hi."),
        (1, None, "user", "Hi."), (1, 3, "assistant", "Hi."), (1, 3, "assistant", "Hi."), (1, 3, "user", "Hi."),
        (2, -(1 << 63), "user", "a."), (2, (1 << 63) - 2, "assistant", "漢字。"), (3, 5, "s", "x." * 20_000),
        (4, 1, "ünknown", "a "), (5, 0, "system", "only."),
    ]
    rows += [(40 + n, t, "user", "q?") for n in range(40) for t in range(1)]
    found = rows_of(T.repair(frame(spark, rows), damage=True))
    expected = plain(rows)
    assert {r[0] for r in found} == {r[0] for r in expected}
    large = (1 << 63) - 1
    assert found == Counter({(r[0], min(r[1], large), *r[2:]): n for r, n in expected.items()})
    assert T.repair(frame(spark, rows[:0]), damage=True).count() == 0


def test_a_long_conversation_is_spread_over_tasks(spark, monkeypatch, request):
    monkeypatch.setattr(T.chunks_of, "__defaults__", (7,))
    source = random.Random(9)
    rows = [
        (7, turn, source.choice(["user", "assistant", "user", "assistant", "system"]),
         source.choice(["Yes.", f"n{turn}.", f"m{turn}", " "]))
        for turn in range(1500)
    ] + random_rows(10, 20)
    rows = list({(r[0], r[1]): r for r in rows}.values())
    spread = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(spread, "false")
    request.addfinalizer(lambda: spark.conf.set(spread, "true"))
    named = T.materialise(T._named(T.damaged(frame(spark, rows))).withColumn("said", F.md5(F.col("text"))))
    chunks = T.chunks_of(T.with_faults(named))
    assert chunks.filter("_c = '7'").select("part").distinct().count() > 3
    assert rows_of(T.repair(frame(spark, rows), damage=True)) == plain(rows)


def test_repaired_rows_are_what_the_digest_is_of(spark):
    rows = random_rows(4)
    digests = {r.conv_id: r.repaired_sha256 for r in T.repair(frame(spark, rows)).collect()}
    lines = defaultdict(dict)
    for r in T.repaired_rows(frame(spark, rows)).collect():
        lines[r.conv_id][r.place] = f"{r.role}:{r.text}"
    for conv, digest in digests.items():
        mine = [lines[conv][k] for k in range(len(lines[conv]))]
        assert hashlib.sha256("\n".join(mine).encode()).hexdigest() == digest
        assert GOAL.fullmatch("".join(line[0] for line in mine))


def test_rules_expand_to_the_string(spark):
    rows = random_rows(6, 300, 30)
    named = T.materialise(T._named(T.damaged(frame(spark, rows))).withColumn("said", F.md5(F.col("text"))))
    chunks = T.chunks_of(T.with_faults(named))
    grammar = T.grammar_of(chunks, rules=5, rounds=6)
    assert len(grammar) == 6 and all(len(pairs) <= 5 for pairs in grammar)
    evaluator = T.Evaluator(grammar)
    flat = [pair for pairs in grammar for pair in pairs]

    def expanded(symbol):
        if symbol < T.TERMINALS:
            return [symbol]
        return [x for part in flat[symbol - T.TERMINALS] for x in expanded(part)]

    shorter = 0
    for row in chunks.select("symbols").collect():
        symbols = T.numbers(row.symbols)
        parsed = evaluator.parsed(symbols)
        assert [x for symbol in parsed for x in expanded(symbol)] == symbols
        shorter += len(symbols) - len(parsed)
    assert shorter > 500
    first = flat[0]
    for i in range(4):
        for j in range(4):
            entry = evaluator.matrices[T.TERMINALS][i][j]
            ways = [
                (a[0] + b[0], str(a[1]) + str(b[1]))
                for k in range(4)
                if (a := evaluator.matrices[first[0]][i][k]) and (b := evaluator.matrices[first[1]][k][j])
            ]
            assert (entry and (entry[0], str(entry[1]))) == (min(ways) if ways else None)


def test_ropes_compare_as_their_texts():
    source = random.Random(3)
    for _ in range(300):
        ropes = []
        for _ in range(2):
            rope = T.Rope(source.choice(["", "D", "KI"]))
            for _ in range(source.randrange(5)):
                rope = T.Rope(None, rope, T.Rope(source.choice(["", "D", "K", "DI"])))
            ropes.append(rope)
        assert (ropes[0] < ropes[1]) == (str(ropes[0]) < str(ropes[1]))
