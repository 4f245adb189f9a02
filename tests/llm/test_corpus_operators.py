"""Disclosure, vector search, secrets, URL lists, the classifier and the pipeline."""

import datetime
import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from oracle import compare
from wayfare.llm import pii, secrets, urls, vafile, weak_labels
from wayfare.llm.registry import ORACLE, QUERIES
from wayfare.session import materialise

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    assert compare(QUERIES[name](spark, DATA), ORACLE[name], DATA) > 0


def test_all_operators_and_the_pipeline_are_registered():
    names = [name for name in entry.queries() if re.match(r"op\d+_|pipeline$", name)]
    assert sorted(int(re.findall(r"\d+", n)[0]) for n in names if n != "pipeline") == [*range(1, 14)]
    assert "pipeline" in names


# -- personal data ---------------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    """The patterns as they are written, one after the other."""
    def digits(s):
        return [int(c) for c in s if "0" <= c <= "9"]

    def luhn(ds):
        return sum(d if k % 2 == 0 else (2 * d) // 10 + (2 * d) % 10 for k, d in enumerate(reversed(ds))) % 10 == 0

    checks = {
        "email": (EMAIL, lambda m: True),
        "ip": (IP, lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (CARD, lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": (PHONE, lambda m: 8 <= len(digits(m)) <= 15),
    }
    return [(kind, m.start(), m.end()) for kind, (p, ok) in checks.items() for m in p.finditer(text) if ok(m[0])]


def test_base_spans_equal_the_patterns():
    source = random.Random(1)
    pieces = [*"ab.@%+-_ ()0123456789\n", "4929348929385146306"[:16], "1.2.3.4", "@x.y", "+1 (017) 555-7713", "é", "255.", "4539 1488 0343 6467"]
    for _ in range(6000):
        text = "".join(source.choices(pieces, k=source.randrange(40)))
        assert pii.base_spans(text) == plain_spans(text), text
    assert pii.base_spans("1.2.3." + "0" * 6000 + "4")[0][0] == "ip"
    for long in ("a" * 100_000, "1" * 100_000, "a.b@" * 20_000, "+1 " + " " * 100_000, "1." * 50_000):
        pii.base_spans(long)


def test_terms_that_reveal_an_entity_are_found(spark):
    source = random.Random(2)
    word = lambda: "".join(source.choices("abcdefghij", k=5))
    rows = [" ".join(word() for _ in range(30)) for _ in range(200)]
    for k in range(6):
        rows.append(f"{word()} {word()} Zebulon {word()} zed@corp.example.com {word()} office {word()}")
        rows.append(f"{word()} office {word()} {word()}")
        rows.append(f"the office {word()} " + ("Zebulon again" if k == 0 else ""))
    # Copies of one passage are one witness, so their rare words reveal nothing.
    rows += ["rarest words here copy@corp.example.com as always"] * 50
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {row.doc_id: row for row in pii.find_spans(docs).collect()}
    terms = Counter()
    for k, text in enumerate(rows):
        for span in found[k].spans.split(",") if found[k].spans else []:
            kind, start, end = span.rsplit(":", 2)
            if kind in ("remove", "generalise"):
                terms[text[int(start) : int(end)]] += 1
        assert found[k].spans.startswith(found[k].base)
        assert found[k].base == pii.join_spans(plain_spans(text))
    assert terms["Zebulon"] == 7 and set(terms) <= {"Zebulon", "office"}
    clean = {row.doc_id: row.text for row in pii.sanitise(docs).collect()}
    assert not any("Zebulon" in text or "@" in text for text in clean.values())
    assert "[email]" in clean[200] and clean[0] == rows[0]


def disclosed(spark, rows):
    """Words of more than one character that the method takes out."""
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {row.doc_id: row.spans for row in pii.find_spans(docs).collect()}
    words = set()
    for k, text in enumerate(rows):
        for span in found[k].split(",") if found[k] else []:
            kind, start, end = span.rsplit(":", 2)
            if kind in ("remove", "generalise"):
                words.add(text[int(start) : int(end)])
    return words


def plain_disclosure(texts, width=pii.CONTEXT_WORDS):
    """term: ratio of all terms that met an entity in two contexts, counted one by one."""
    near, holding, contexts = Counter(), Counter(), defaultdict(set)
    together, beside, documents = defaultdict(set), Counter(), Counter()
    for text in texts:
        spans = plain_spans(text)
        words = [(m[0].lower(), m.start(), m.end()) for m in pii._TERM.finditer(text)]
        documents.update({word for word, _, _ in words})
        words = [w for w in words if all(w[2] <= a or b <= w[1] for _, a, b in spans)]
        met = defaultdict(set)
        for kind, a, b in spans:
            value = text[a:b]
            name = (kind, re.sub("[^0-9]", "", value) if kind in ("card", "phone") else value.lower())
            before, after = [w for w in words if w[2] <= a], [w for w in words if w[1] >= b]
            terms = frozenset(w[0] for w in before[-width:] + after[:width])
            contexts[name].add(terms)
            if name not in met:
                holding[name] += 1
            for term in terms:
                together[name, term].add(terms)
                if term not in met[name]:
                    beside[name, term] += 1
            met[name] |= terms

    def share(different, having, all_documents):
        once = min(different, having)
        return once / (all_documents - having + once)

    worst = {}
    for (name, term), seen in together.items():
        if len(seen) < 2:
            continue
        bits = -math.log2(share(len(contexts[name]), holding[name], len(texts)))
        given = share(len(seen), beside[name, term], documents[term])
        ratio = (math.log2(given) + bits) / bits if bits > 0 else 0.0
        worst[term] = max(worst.get(term, -math.inf), ratio)
    return worst


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_ratios_equal_a_plain_count_over_the_corpus(spark, scale):
    docs = spark.read.parquet(f"/root/testdata/{scale}/documents.parquet").select("text")
    wanted = plain_disclosure([row.text or "" for row in docs.collect()])
    wanted = {pii.term_hash(t): r for t, r in wanted.items() if r >= pii.GENERALISE}
    found = {row.h: row for row in pii.disclosing_terms(docs).collect()}
    assert found.keys() == wanted.keys()
    for h, row in found.items():
        assert row.ratio == pytest.approx(wanted[h])
        assert row.action == ("remove" if wanted[h] >= pii.REMOVE else "generalise")


def test_no_personal_value_is_stored(spark, monkeypatch):
    stored = []

    def keep(df):
        stored.append(df)
        return materialise(df)

    monkeypatch.setattr(pii, "materialise", keep)
    rows = [f"ask{k} Quillon at quill@corp.example.com or 10.1.2.3{k} now" for k in range(4)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    pii.find_spans(docs).collect()
    assert len(stored) > 3
    for df in stored:
        said = str(df.collect()).lower()
        assert "quill" not in said and "10.1.2" not in said


def test_two_contexts_are_evidence(spark):
    rows = [f"filler{k} text{k} without{k} any{k}" for k in range(200)]
    rows += ["a Quillon b quill@corp.example.com c", "d e Quillon f quill@corp.example.com g"]
    assert "Quillon" in disclosed(spark, rows)


def test_copies_neither_hide_nor_make_a_disclosing_term(spark):
    rows = [f"filler{k} text{k} without{k} any{k}" for k in range(1000)]
    hot = "ask Zebulon at zed@corp.example.com office about it"
    rows += [hot] * 400
    rows += [f"one{k} Zebulon two{k} zed@corp.example.com office three{k}" for k in range(2)]
    # `office` stands in many documents apart from the address, though in fewer than copies.
    rows += [f"my{k} office is{k} far{k}" for k in range(200)]
    assert disclosed(spark, rows) == {"Zebulon"}


def test_spans_of_one_document_are_counted_once_as_a_document(spark):
    rows = [
        "Zed a@b.example x y Zed a@b.example z " + "far " * 20 + "Zed a@b.example q",
        "no mail here", "Zed w", "",
    ]
    docs = spark.createDataFrame([(t,) for t in rows], "text string")
    near = pii.context_rows(docs, 2).groupBy("entity").agg(
        F.count_distinct("context").alias("c"), F.sum(F.col("fresh").isNull().cast("int")).alias("n")
    )
    assert [(r.c, r.n) for r in near.collect()] == [(3, 1)]


def test_sanitising_odd_rows(odd, nothing):
    rows = pii.find_spans(odd).collect()
    assert Counter((r.doc_id, r.base) for r in rows) == Counter(
        (r.doc_id, pii.join_spans(plain_spans(r.text or ""))) for r in odd.collect()
    )
    clean = pii.sanitise(odd)
    assert clean.columns == odd.columns and clean.count() == odd.count()
    assert clean.filter("text IS NULL").count() == odd.filter("text IS NULL").count()
    assert pii.find_spans(nothing).count() == pii.sanitise(nothing).count() == 0


# -- vector search ---------------------------------------------------------------------------


def test_top_k_equals_brute_force(spark):
    source = random.Random(3)
    vectors = [[source.gauss(0, 1) for _ in range(5)] for _ in range(300)]
    rows = [(k, v) for k, v in enumerate(vectors)] + [(k, vectors[7]) for k in range(300, 420)]
    rows += [(500, None), (550, [1.0, None, 1.0, 1.0, 1.0]), (600, [float("nan")] * 5), (650, [float("inf")] * 5),
             (None, vectors[0]), (700, [1.0, 2.0]), (703, [1.0, 3.0]), (750, []), (4, vectors[9]), (50, vectors[8]),
             (800, [0.5])]
    schema = "vec_id long, embedding array<double>, vector string, id string, rank int"
    frame = spark.createDataFrame([(*row, "x", "y", 1) for row in rows], schema)
    found = defaultdict(list)
    for row in vafile.top_k(frame, F.col("vec_id") % 50 == 0, block_rows=64).collect():
        found[row.query_id].append((row.rank, row.vec_id, row.score))
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = defaultdict(list)
    for i, v in good:
        if i % 50 == 0:
            queries[i].append(v)
    expected = {}
    for i, own in queries.items():
        scores = sorted((-sum(a * b for a, b in zip(min(own), v)), j) for j, v in good if j != i and len(v) == len(min(own)))
        if scores:
            expected[i] = [(k + 1, j, -s) for k, (s, j) in enumerate(scores[:5])]
    assert {i: sorted(rows) for i, rows in found.items()} == expected


def test_large_components_are_exact_and_empty_tables_empty(spark):
    frame = spark.createDataFrame([(k, [2.0**21 * (k + 1), 3.0, -(2.0**22)]) for k in range(8)], "vec_id long, embedding array<double>")
    rows = vafile.top_k(frame, F.col("vec_id") == 0).orderBy("rank").collect()
    vector = lambda k: [256 * 2**21 * (k + 1), 768, -256 * 2**22]
    expected = sorted((-sum(a * b for a, b in zip(vector(0), vector(k))), k) for k in range(1, 8))[:5]
    assert [(r.vec_id, r.score) for r in rows] == [(k, -s) for s, k in expected]
    assert vafile.top_k(frame.filter("vec_id < 0"), F.col("vec_id") == 0).count() == 0


@pytest.mark.parametrize("size", [100, 2**40, 2**60])
def test_bounds_hold_at_any_size(size):
    numbers = np.random.default_rng(0).normal(0, size, (500, 16)).astype(np.int64)
    low = numbers.min(0)
    span = numbers.max(0).astype(object) - low
    width = np.array([max(1, -(-(int(s) + 1) // 256)) for s in span], np.int64)
    row = {"dim": 16, "ids": np.arange(500).tobytes(), "places": np.arange(500).tobytes(), "lows": low.tobytes(),
           "widths": width.tobytes(), "cells": ((numbers - low) // width).astype(np.uint8).tobytes()}
    block = vafile.Block(row)
    lower, upper = block.bounds(numbers[:20], slice(0, 500))
    exact = [[sum(a * b for a, b in zip(q, v)) for v in numbers.tolist()] for q in numbers[:20].tolist()]
    largest = max(abs(x) for row in exact for x in row)
    for own, low_row, high_row in zip(exact, lower.tolist(), upper.tolist()):
        assert all(a <= x <= b for x, a, b in zip(own, low_row, high_row))
        assert max(b - a for a, b in zip(low_row, high_row)) < 0.15 * largest


def test_few_exact_vectors_are_read_over_all_blocks(spark, monkeypatch):
    read = []
    reaching = vafile._reaching

    def counted(pairs):
        found = materialise(reaching(pairs))
        read.append(found.count())
        return found

    monkeypatch.setattr(vafile, "_reaching", counted)
    rows = np.random.default_rng(5).normal(0, 1, (4000, 16)).tolist()
    frame = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>").repartition(6)
    found = vafile.top_k(frame, F.col("vec_id") % 50 == 0, block_rows=300)
    assert found.count() == 80 * 5
    # 80 queries x 4,000 rows; a bound per block alone would read over 80 x 14 x 5.
    assert read[0] < 80 * 20


def test_equal_vectors_stay_few_rows(spark):
    rows = [(4, [1.0, 2.0])] * 40 + [(n, [1.0, 2.0]) for n in range(1000, 1300)] + [(50, [1.0, 2.0]), (7, [0.5, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    found = defaultdict(list)
    for r in vafile.top_k(frame, F.col("vec_id").isin(4, 50)).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    same = 256 * 256 + 512 * 512
    assert found[4] == [(50, same), *((n, same) for n in range(1000, 1004))]
    assert found[50] == [(4, same)] * 5


# -- secrets ---------------------------------------------------------------------------------

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def plain_secrets(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_base_secrets_equal_the_patterns(spark, odd, nothing):
    source = random.Random(4)
    pieces = ["token", "Secret", "api_key", "APIKEY", "password", "passwd", "=", ":", " ", '"', "'", "ab", "12", "cdef0123", "AKIA", "QWERTY12345678", "é", "\n", ".", "/", "x" * 9, "deadbeef" * 3]
    texts = ["".join(source.choices(pieces, k=source.randrange(1, 25))) for _ in range(1500)]
    docs = spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)], "doc_id long, text string, source string")
    for row in secrets.scan(docs).collect():
        base = [(s.start, s.kind, s.end) for s in row.spans if s.kind < 3]
        assert base == plain_secrets(texts[row.doc_id]), texts[row.doc_id]
    found = secrets.scan(odd).collect()
    assert Counter((r.doc_id, len([s for s in r.spans if s.kind < 3])) for r in found) == Counter(
        (r.doc_id, len(plain_secrets(r.text or ""))) for r in odd.collect())
    assert secrets.digests(nothing).count() == secrets.redact(nothing).count() == 0


def test_owners_separate_examples_from_live_secrets(spark):
    shared, own = "A1b2C3d4E5f6G7h8I9j0", "Zz9Yy8Xx7Ww6Vv5Uu4Tt"
    rows = [(k, f'token = "{shared}" in the manual', f"owner{k % 6}") for k in range(12)]
    rows += [(20, f"token = {own} mine", "me"), (21, f"seen bare {own} here", "me"), (22, "password: aaaaaaaa", "me"), (23, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    verdicts = {r.doc_id: [(s.kind, s.verdict) for s in r.spans] for r in secrets.scan(docs).collect()}
    assert verdicts[0] == [(0, "example")] and verdicts[20] == [(0, "live")]
    assert verdicts[21] == [(3, "live")] and verdicts[22] == [(0, "weak")] and verdicts[23] == []
    texts = {r.doc_id: r.text for r in secrets.redact(docs).collect()}
    assert texts[0] == rows[0][1] and texts[20] == "[secret] mine" and texts[21] == "seen bare [secret] here"
    assert texts[23] is None


def test_redacting_odd_rows(odd):
    found = secrets.redact(odd)
    assert found.columns == odd.columns
    texts = Counter((r.doc_id, r.text) for r in found.collect())
    assert sum(texts.values()) == odd.count()
    assert texts[8, "[secret]\" mail a.b@c.de and 10.0.0.256 then 10.0.0.25"] == 1


def test_a_text_of_very_many_secrets(spark):
    source = random.Random(11)
    words = [f"{source.getrandbits(128):032x}" for _ in range(100_000)]
    words[::10] = ["plain words"] * 10_000
    text = " é ".join(words)
    docs = spark.createDataFrame([(1, text, "me"), (2, "none", "me")], "doc_id long, text string, source string")
    found = {r.doc_id: r for r in secrets.scan(docs).collect()}
    assert found[1].n_hex == sum(1 for m in re.finditer("[0-9a-f]{24,}", text))
    assert [(s.start, s.kind, s.end) for s in found[1].spans if s.kind < 3] == plain_secrets(text)
    texts = {r.doc_id: r.text for r in secrets.redact(docs).collect()}
    assert texts[1] == re.sub("[0-9a-f]{24,}", "[secret]", text) and texts[2] == "none"


def test_work_grows_with_the_matches_of_a_text(spark):
    def seconds(n):
        text = " ".join(f"{k:032x}" for k in range(n))
        docs = spark.createDataFrame([(1, text, "me")], "doc_id long, text string, source string")
        began = time.perf_counter()
        assert secrets.redact(docs).count() == 1 and secrets.digests(docs).first().n_hex == n
        return time.perf_counter() - began

    seconds(1000)
    few, many = seconds(20_000), seconds(160_000)
    assert many < 8 * few + 10


@pytest.mark.parametrize("block", [1, 2, 5, 16_384])
def test_redaction_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(secrets, "BLOCK", block)
    source = random.Random(block)
    rows = []
    for k in range(40):
        text = "".join(source.choices("ab é漢\n😀", k=source.randrange(30)))
        spans = [(a, a + source.randrange(1, 9)) for a in source.choices(range(len(text) or 1), k=source.randrange(6))]
        rows.append((k, text, [(a, min(b, len(text))) for a, b in spans if a < len(text)]))
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "_wf_row long, text string")
    spans = spark.createDataFrame([(k, a, b) for k, _, s in rows for a, b in s], "_wf_row long, start long, end long")
    cut = docs.join(secrets._cuts(secrets._islands(spans)), "_wf_row")
    new = cut.select("_wf_row", secrets._without(F.col("text"), F.col("_cuts"), "#").alias("new"))
    found = {r._wf_row: r.new for r in new.collect()}
    for k, text, own in rows:
        out, at = "", 0
        for a, b in sorted(own):
            if a >= at:
                out += text[at:a] + "#"
            at = max(at, b)
        assert found.get(k, text) == out + text[at:]


def test_only_hashes_of_secrets_are_stored(spark, monkeypatch, tmp_path):
    stored = []

    def keep(df):
        stored.append(df)
        return materialise(df)

    monkeypatch.setattr(secrets, "materialise", keep)
    own = "Zz9Yy8Xx7Ww6Vv5Uu4Tt"
    docs = spark.createDataFrame([(1, f"token = {own}", "me")], "doc_id long, text string, source string")
    secrets.digests(docs).collect()
    assert stored
    for df in stored:
        assert own not in str(df.collect())


# -- URL lists -------------------------------------------------------------------------------


def test_entries_apply_as_of_the_fetch(spark):
    day = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(n)
    log = [("spam", "bad.com", day(10), True), ("spam", "bad.com", day(20), False), ("spam", "bad.com", day(30), True),
           ("spam", "bad.com", day(30), True), ("spam", "twice.com", day(5), True), ("spam", "twice.com", day(5), False),
           ("path", "ok.com/a/b", day(0), True), (None, "ok.com", day(0), True), ("x", None, day(0), True), ("x", "ok.com", None, True)]
    entries = spark.createDataFrame(log, "category string, key string, day date, active boolean")
    cases = [("http://bad.com/x", 9, ""), ("http://bad.com/x", 10, "spam"), ("https://u:p@WWW.BAD.com:80?q", 19, "spam"),
             ("http://bad.com", 20, ""), ("http://bad.com.", 400, "spam"), ("http://notbad.com", 12, ""), ("http://twice.com", 6, ""),
             ("http://ok.com/a/b/c", 3, "path"), ("http://ok.com/a/bc", 3, ""), ("http://ok.com/a", 3, ""), (None, 3, ""), ("", 3, ""),
             ("nonsense", 3, ""), ("http://bad.com", None, ""), ("http://ok.com/" + "a/" * 20_000, 3, ""), ("http://bad.com/x", 10, "spam")]
    captures = spark.createDataFrame([(k, u, None if n is None else day(n), "h", "p") for k, (u, n, _) in enumerate(cases)],
                                     "page_id long, url string, fetched date, host string, _host string")
    for period in (1, 32):
        found = urls.blocked(captures, entries, period_days=period)
        assert {r.page_id: r.categories for r in found.collect()} == {k: c for k, (_, _, c) in enumerate(cases)}
        assert "_host" in found.columns
    assert urls.blocked(captures.limit(0), entries).count() == 0
    assert {r.categories for r in urls.blocked(captures, entries.limit(0)).collect()} == {""}


# -- classifier ------------------------------------------------------------------------------


def test_em_recovers_accuracies_and_posteriors():
    source = random.Random(5)
    rates = [(0.9, 0.02), (0.6, 0.01), (0.5, 0.05), (0.3, 0.02)]
    counts, truth = Counter(), []
    for _ in range(20_000):
        bad = source.random() < 0.3
        votes = "".join("b" if source.random() < r[not bad] else "-" for r in rates) + "-"
        counts[votes] += 1
        truth.append((votes, bad))
    model = weak_labels.fit_weak_labels(counts)
    assert abs(model.prior - 0.3) < 0.03
    for j, (right, wrong) in enumerate(rates):
        assert abs(model.likely[j, 0, 1] - right) < 0.06 and abs(model.likely[j, 0, 0] - wrong) < 0.03
    errors = sum((model.posterior(v) > 0.5) != bad for v, bad in truth)
    assert errors < 0.05 * len(truth)


def plain_em(documents, rounds=100):
    """Expectation-maximisation document by document; returns prior and likelihoods as dicts."""
    labellers = range(len(documents[0]))
    prior = 0.15
    likely = {(j, v, c): p for j in labellers for v, both in (("b", (0.02, 0.3)), ("g", (0.3, 0.02)), ("-", (0.68, 0.68)))
              for c, p in enumerate(both)}
    known = any(d[-1] != "-" for d in documents)

    def posterior(votes):
        if votes[-1] != "-":
            return 0.995 if votes[-1] == "b" else 1 - 0.995
        good, bad = math.log(1 - prior), math.log(prior)
        for j, v in enumerate(votes[:-1]):
            good, bad = good + math.log(likely[j, v, 0]), bad + math.log(likely[j, v, 1])
        return 1 / (1 + math.exp(good - bad))

    for step in range(rounds):
        used = [d for d in documents if d[-1] != "-"] if step == 0 and known else documents
        sums = {key: 0.5 for key in likely}
        total = [0.0, 0.0]
        for d in used:
            p = posterior(d)
            total[0], total[1] = total[0] + 1 - p, total[1] + p
            for j, v in enumerate(d):
                sums[j, v, 0] += 1 - p
                sums[j, v, 1] += p
        before, old = prior, likely
        prior = (total[1] + 0.5) / (len(used) + 1)
        likely = {(j, v, c): sums[j, v, c] / sum(sums[j, w, c] for w in "bg-") for j, v, c in sums}
        if abs(prior - before) < 1e-7 and max(abs(likely[k] - old[k]) for k in likely) < 1e-6:
            break
    return prior, likely, posterior


@pytest.mark.parametrize("labelled", [0.0, 0.1])
def test_em_on_counts_equals_em_on_documents(labelled):
    source = random.Random(6)
    documents = []
    for _ in range(1500):
        bad = source.random() < 0.25
        votes = "".join("b" if source.random() < r[not bad] else "-" for r in ((0.8, 0.05), (0.6, 0.02), (0.4, 0.1)))
        documents.append(votes + (("b" if bad else "g") if source.random() < labelled else "-"))
    model = weak_labels.fit_weak_labels(Counter(documents))
    prior, likely, posterior = plain_em(documents)
    assert model.prior == pytest.approx(prior, abs=1e-6)
    for (j, v, c), p in likely.items():
        assert model.likely[j, "bg-".index(v), c] == pytest.approx(p, abs=1e-5)
    for votes in set(documents):
        assert model.posterior(votes) == pytest.approx(posterior(votes), abs=1e-4)


def test_scorer_equals_a_plain_logistic_model():
    source = random.Random(7)
    rows, labels = [], []
    for _ in range(200):
        bad = source.random() < 0.4
        rows.append(np.array(sorted({*source.sample(range(20, 60), 5), *([3, 4] if bad else [5])})))
        labels.append(0.97 if bad else 0.02)
    scorer = weak_labels.fit_scorer(rows, np.array(labels))
    # What is informative, by the definition of G².
    used = set()
    for f in {int(x) for row in rows for x in row}:
        def g(n, k):
            p = min(max(k / max(n, 1e-9), 1e-9), 1 - 1e-9)
            return k * math.log(p) + (n - k) * math.log(1 - p)

        have = [y for row, y in zip(rows, labels) if f in row]
        total, mine = sum(labels), sum(have)
        gain = 2 * (g(len(have), mine) + g(len(rows) - len(have), total - mine) - g(len(rows), total))
        if len(have) >= weak_labels.LEAST_DOCS and gain >= weak_labels.LEAST_GAIN:
            used.add(f)
    assert {3, 4, 5} <= used
    base = sum(labels) / len(labels)
    bias, weights, seen, seen_bias = math.log(base / (1 - base)), Counter(), {f: 1e-2 for f in used}, 1e-2
    order = np.random.default_rng(0)
    for _ in range(weak_labels.EPOCHS):
        for i in order.permutation(len(rows)).tolist():
            own = [f for f in rows[i].tolist() if f in used]
            error = 1 / (1 + math.exp(-(bias + sum(weights[f] for f in own)))) - labels[i]
            for f in own:
                step = error + weak_labels.SHRINK * weights[f]
                seen[f] += step * step
                weights[f] -= weak_labels.RATE * step / math.sqrt(seen[f])
            seen_bias += error * error
            bias -= weak_labels.RATE * error / math.sqrt(seen_bias)
    assert set(np.flatnonzero(scorer.weights).tolist()) <= used
    for row in rows:
        plain = 1 / (1 + math.exp(-(bias + sum(weights[f] for f in row.tolist()))))
        assert scorer.score(row) == pytest.approx(plain, abs=1e-9)


def test_held_out_labels(spark):
    """Scores of documents whose labels the fit did not see."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    seen, unseen = labels.filter("doc_id % 3 <> 0"), labels.filter("doc_id % 3 = 0")
    scored = weak_labels.classify(docs, seen, "s").select("doc_id", "s.*").join(unseen, "doc_id").collect()
    clean = [r for r in scored if r.quality == 1 and r.toxic == 0]
    toxic = [r for r in scored if r.toxic == 1]
    junk = [r for r in scored if r.quality == 0]
    assert sum(r.kept for r in clean) >= 0.98 * len(clean)
    assert sum(not r.kept for r in toxic) >= 0.9 * len(toxic)
    assert sum(not r.kept for r in junk) >= 0.95 * len(junk)


def test_classifying_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, None), (None, 0, 1), (99, None, None)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0), None):
        found = weak_labels.classify(odd, known, "ids")
        assert found.count() == odd.count() and set(found.columns) == set(odd.columns)
    assert weak_labels.keep_good(odd, labels).columns == odd.columns
    assert weak_labels.keep_good(nothing, labels).count() == 0


# -- pipeline --------------------------------------------------------------------------------


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = docs.collect()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = len(rows)
        frame = stage(spark, docs, DATA)
        assert frame.columns == docs.columns, name
        rows = frame.collect()
        assert len(rows) < before or name == "secret scans"
        docs = spark.createDataFrame(rows, docs.schema)
    assert len({r.doc_id for r in rows}) == len(rows)
    packed = corpus_pipeline.run(spark, DATA).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in rows}


def test_pipeline_on_no_documents(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{DATA}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_a_label_of_one_copy_is_not_lost(spark):
    rows = [
        (1, "b--", "-b-"), (1, "b-b", "-bg"), (1, "b-g", "-b-"),
        (2, "---", "---"), (2, "--g", "---"), (3, "-b-", "b--"),
    ]
    voted = spark.createDataFrame(rows, "_h long, junk string, toxic string")
    names = ("junk", "toxic")
    found = voted.groupBy("_h").agg(*(weak_labels.pattern_of_copies(n).alias(n) for n in names))
    assert {tuple(r) for r in found.collect()} == {(1, "b-b", "-bg"), (2, "--g", "---"), (3, "-b-", "b--")}
