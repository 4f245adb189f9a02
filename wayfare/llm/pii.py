"""Sanitising personal data by what the corpus itself discloses.

Patterns find the base personal data: mail addresses, IP addresses, card and phone numbers. Each
value is a protected entity. Terms near an entity are counted over all documents, those that
repeat a context once, so that copies of a passage are one witness. A term t discloses an entity e by

    PMI(e; t) / IC(e),  PMI = log2 p(e | t) / p(e),  IC = -log2 p(e)

which is 0 if they are independent and 1 if every occurrence of t points to e. Terms with enough
witnesses and a ratio above a threshold are sanitised wherever they occur: above the upper
threshold they are removed, above the lower one replaced by their class.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import ROW, bounded_batches, fields_of, texts_in, whole_rows
from wayfare.session import materialise

KINDS = ("email", "ip", "card", "phone")
# Words on either side of an entity that count as its context.
CONTEXT_WORDS = 8
# Distinct contexts in which a term must have met an entity, and the disclosure ratios. Any rare
# word has one neighbour by chance; that the same two meet in a second context is evidence.
WITNESSES = 2
GENERALISE = 0.7
REMOVE = 0.9
# Bits of the filter that spares exact look-ups for other terms; fixed, so its size is bounded.
FILTER_BITS = 1 << 23
# Distinct words a worker counts or remembers before it passes them on or starts anew.
KEPT_WORDS = 200_000

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile(r"\w+")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[str, int, int]


# -- base patterns ---------------------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _octet(part: str) -> bool:
    value = part.lstrip("0")
    return len(value) <= 3 and int(value or "0") <= 255


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from each @: all characters before it that may stand there.

    Every match holds one @, and no start before that @ can reach another one.
    """
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield "email", start, free
            at = text.find("@", free)
        else:
            # What stands before this @ can not start a match; the next one may follow it.
            free = at + 1
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """Base personal data by kind, then start. Matches that fail their check are passed over."""
    found = list(emails(text)) if "@" in text else []
    if not _DIGIT.search(text):
        return found
    if "." in text:
        for m in _IP.finditer(text):
            if all(map(_octet, m[0].split("."))):
                found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGIT.findall(m[0])) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


def entity(kind: str, value: str) -> str:
    """One form for the ways to write a value."""
    if kind in ("card", "phone"):
        return f"{kind}:{''.join(_DIGIT.findall(value))}"
    return f"{kind}:{value.lower()}"


def terms(text: str, spans: list[Span]) -> list[tuple[str, int, int]]:
    """Lower-case words with their places, without those that touch base spans."""
    covered = sorted((start, end) for _, start, end in spans)
    found, at = [], 0
    for m in _TERM.finditer(text):
        while at < len(covered) and covered[at][1] <= m.start():
            at += 1
        if at == len(covered) or m.end() <= covered[at][0]:
            found.append((m[0].lower(), m.start(), m.end()))
    return found


def distinct_terms(text: str) -> set[str]:
    return set(map(str.lower, set(_TERM.findall(text))))


def contexts(text: str, spans: list[Span], width: int) -> Iterator[tuple[str, list[str]]]:
    """(entity, distinct terms within `width` words on either side) of each base span."""
    if not spans:
        return
    found = terms(text, spans)
    ends = [end for _, _, end in found]
    starts = [start for _, start, _ in found]
    for kind, start, end in spans:
        left = int(np.searchsorted(ends, start, "right"))
        right = int(np.searchsorted(starts, end, "left"))
        near = found[max(0, left - width) : left] + found[right : right + width]
        yield entity(kind, text[start:end]), sorted({term for term, _, _ in near})


def join_spans(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def term_hash(term: str) -> int:
    """A signed 64-bit hash."""
    value = xxhash.xxh64_intdigest(term.encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >= 1 << 63 else value


# -- corpus statistics -----------------------------------------------------------------------


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(columns, schema)], schema=schema
    )


def context_rows(texts: DataFrame, width: int, secret: bytes | None = None) -> DataFrame:
    """(entity, context, terms, fresh) of every base span, all of them hashes.

    `entity` and `context` (the entity with its terms) are keyed by a secret of this run, so that
    no personal value can be read or looked up in what is stored; terms are `term_hash`es. `fresh`
    has the terms that met the entity in no earlier span of the document. It is null for
    the first span, where all are fresh.
    """
    schema = pa.schema(
        [("entity", pa.binary()), ("context", pa.binary())]
        + [(name, pa.list_(pa.int64())) for name in ("terms", "fresh")]
    )
    key = os.urandom(32) if secret is None else secret

    def hidden(*said: str) -> bytes:
        text = "\0".join(said).encode("utf-8", "surrogatepass")
        return hashlib.blake2b(text, digest_size=16, key=key).digest()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in texts_in(batch):
                met: dict[str, set[str]] = {}
                for name, near in contexts(text, base_spans(text), width):
                    before = met.get(name)
                    fresh = None if before is None else [term_hash(t) for t in near if t not in before]
                    met.setdefault(name, set()).update(near)
                    rows.append((hidden(name), hidden(name, *near), [term_hash(t) for t in near], fresh))
            yield _batch(rows, schema)

    return texts.mapInArrow(
        find, "entity binary, context binary, terms array<long>, fresh array<long>"
    )


def bit_filter(hashes: DataFrame, bits: int = FILTER_BITS) -> bytes:
    """One bit per hash, set where a hash falls. Its length does not depend on the input."""
    place = F.pmod(F.col("h"), F.lit(bits))
    words = hashes.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(
            F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
        ).alias("set")
    )
    table = np.zeros(bits // 64, np.int64)
    for word, value in words.toLocalIterator():
        table[word] = value
    return table.tobytes()


class SeenFilter:
    """Membership of words in a bit filter; answers are kept for words that come again."""

    def __init__(self, data: bytes):
        self._bits = np.frombuffer(data, np.uint8)
        self._size = 8 * len(data)
        self._known: dict[str, bool] = {}

    def __call__(self, word: str) -> bool:
        known = self._known.get(word)
        if known is None:
            if len(self._known) > KEPT_WORDS:
                self._known.clear()
            place = term_hash(word) % self._size
            known = self._known[word] = bool(self._bits[place >> 3] >> (place & 7) & 1)
        return known


def document_counts(texts: DataFrame, wanted: bytes) -> DataFrame:
    """(h, documents): in how many documents each term of the filter occurs, all of them read."""
    schema = pa.schema([("h", pa.int64()), ("documents", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, found = SeenFilter(wanted), Counter()
        for batch in batches:
            for text in texts_in(batch):
                found.update(filter(seen, distinct_terms(text)))
            if len(found) > KEPT_WORDS:
                yield _batch([(term_hash(w), n) for w, n in found.items()], schema)
                found.clear()
        yield _batch([(term_hash(w), n) for w, n in found.items()], schema)

    counted = texts.mapInArrow(count, "h long, documents long")
    return counted.groupBy("h").agg(F.sum("documents").alias("documents"))


def disclosing_terms(
    texts: DataFrame,
    witnesses: int = WITNESSES,
    generalise: float = GENERALISE,
    remove: float = REMOVE,
    width: int = CONTEXT_WORDS,
) -> DataFrame:
    """(h, ratio, action) of every term that discloses some entity too well.

    p(e) is the share of documents that hold e, p(e | t) the share of a term's documents in which
    it stood near e. Those with the same context of e count once, above and below the line.
    Counting is over all documents.
    """
    near = context_rows(texts, width).groupBy("entity", "context", "fresh")
    near = materialise(near.agg(F.first("terms").alias("terms"), F.count(F.lit(1)).alias("n")))
    is_fresh = F.col("fresh").isNull() | F.array_contains("fresh", F.col("h"))
    met = near.select("entity", "context", "fresh", "n", F.explode("terms").alias("h"))
    met = met.groupBy("entity", "h").agg(
        F.count_distinct("context").alias("together"),
        F.sum(F.when(is_fresh, F.col("n")).otherwise(0)).alias("beside"),
    )
    met = materialise(met.filter(F.col("together") >= witnesses))
    # The filter has the terms of candidates only.
    documents = document_counts(texts, bit_filter(met.select("h").distinct()))
    entities = near.groupBy("entity").agg(
        F.count_distinct("context").alias("contexts"),
        F.sum(F.when(F.col("fresh").isNull(), F.col("n")).otherwise(0)).alias("holding"),
    )
    total = texts.count()
    joined = met.join(entities, "entity").join(documents, "h")
    p_entity = _share("contexts", F.col("holding"), F.lit(total))
    p_given = _share("together", F.col("beside"), F.col("documents"))
    bits = -F.log2(p_entity)
    ratio = F.when(bits > 0, (F.log2(p_given) + bits) / bits).otherwise(F.lit(0.0))
    worst = joined.select("h", ratio.alias("ratio")).groupBy("h").agg(F.max("ratio").alias("ratio"))
    action = F.when(F.col("ratio") >= remove, "remove").otherwise("generalise")
    return materialise(
        worst.filter(F.col("ratio") >= generalise).select("h", "ratio", action.alias("action"))
    )


def _share(different: str, having: Column, documents: Column) -> Column:
    """The share of documents `having` something, where repeats of the `different` ones count once."""
    once = F.least(F.col(different), having)
    return once / (documents - having + once)


# -- application -----------------------------------------------------------------------------

FOUND = (
    f"doc_id long, {ROW} long, n_email long, n_ip long, n_card long, n_phone long, base string, "
    "h array<long>, starts array<long>, ends array<long>"
)


def _candidates(rows: DataFrame, wanted: bytes) -> DataFrame:
    """Base spans of each row, and the places of terms that the filter lets through."""
    schema = pa.schema(
        [("doc_id", pa.int64()), (ROW, pa.int64())]
        + [(f"n_{kind}", pa.int64()) for kind in KINDS]
        + [("base", pa.string())]
        + [(name, pa.list_(pa.int64())) for name in ("h", "starts", "ends")]
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = SeenFilter(wanted)
        any_term = any(wanted)
        for batch in batches:
            rows = []
            ids = zip(batch.column("doc_id").to_pylist(), batch.column(ROW).to_pylist())
            for (doc_id, row), text in zip(ids, texts_in(batch)):
                spans = base_spans(text)
                counts = Counter(kind for kind, _, _ in spans)
                hits: list[tuple[str, int, int]] = []
                if any_term and any(map(seen, distinct_terms(text))):
                    hits = [t for t in terms(text, spans) if seen(t[0])]
                rows.append(
                    (doc_id, row, *(counts[kind] for kind in KINDS), join_spans(spans),
                     [term_hash(t) for t, _, _ in hits], [a for _, a, _ in hits],
                     [b for _, _, b in hits])
                )
            yield _batch(rows, schema)

    return rows.mapInArrow(find, FOUND)


def find_spans(docs: DataFrame, row: Column | None = None, **thresholds: float) -> DataFrame:
    """doc_id, row id, counts of base kinds, base spans and all spans of each row.

    Spans are kind:start:end in code points, end exclusive, joined by commas: base spans by kind,
    then those of the method, kinds `generalise` and `remove`, by start. They never overlap
    base spans. A null text counts as empty and has no spans. Rows may repeat and doc_id may
    be null or repeat; other columns are not read. No rows give no rows.
    """
    bounded_batches(docs.sparkSession)
    columns = [F.col("text").cast("string").alias("text")]
    disclosing = disclosing_terms(docs.select(*columns), **thresholds)
    wanted = bit_filter(disclosing.select("h"))
    numbered = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.monotonically_increasing_id() if row is None else row).alias(ROW),
        *columns,
    )
    # Written once: row ids are fixed, and the texts are left behind.
    found = materialise(_candidates(numbered, wanted))
    places = found.filter(F.size("h") > 0).select(
        ROW, F.inline(F.arrays_zip("h", "starts", "ends"))
    )
    # A frequent term is dealt over its places by adaptive execution: both sides are written.
    places = materialise(places)
    exact = places.join(disclosing.select("h", "action"), "h")
    added = exact.groupBy(ROW).agg(
        F.array_sort(
            F.collect_list(F.struct(F.col("starts"), F.col("ends"), F.col("action")))
        ).alias("_terms")
    )
    text = F.transform(
        "_terms", lambda t: F.concat_ws(":", t["action"], t["starts"].cast("string"), t["ends"].cast("string"))
    )
    base = F.when(F.col("base") != "", F.col("base"))
    return found.drop("h", "starts", "ends").join(added, ROW, "left").select(
        "doc_id", ROW, *(f"n_{kind}" for kind in KINDS), "base",
        F.concat_ws(",", base, F.array_join(text, ",")).alias("spans"),
    )


def sanitise_text(text: str | None, spans: str) -> str | None:
    """The text with spans replaced: base ones by their kind, terms by their class or nothing."""
    if not spans or text is None:
        return text
    cuts = []
    for span in spans.split(","):
        kind, start, end = span.rsplit(":", 2)
        cuts.append((int(start), int(end), kind))
    parts, at = [], 0
    for start, end, kind in sorted(cuts):
        if end <= at:
            continue
        parts.append(text[at : max(at, start)])
        if kind == "generalise":
            parts.append("[number]" if text[start:end].isnumeric() else "[term]")
        elif kind != "remove":
            parts.append(f"[{kind}]")
        at = end
    return "".join([*parts, text[at:]])


def sanitise(docs: DataFrame, **thresholds: float) -> DataFrame:
    """`docs` with sanitised texts; other columns stay. See `find_spans` for odd input."""
    bounded_batches(docs.sparkSession)
    numbered = whole_rows(docs)
    found = find_spans(numbered.select("_doc.doc_id", "_doc.text", ROW), F.col(ROW), **thresholds)
    spans = materialise(found.filter("spans <> ''").select(ROW, "spans"))
    clean = F.udf(sanitise_text, "string", useArrow=True)
    text = F.when(F.col("spans").isNull(), F.col("_doc.text")).otherwise(
        clean(F.col("_doc.text"), F.coalesce("spans", F.lit("")))
    )
    return numbered.join(spans, ROW, "left").select(*fields_of(numbered, {"text": text}))
