"""Secrets by how many owners share them, with DataFrame functions only.

Base patterns find candidate credentials, and so does any long token that mixes letters and
digits. Every candidate's value is hashed; per hash the distinct owners and repositories are
counted over the corpus. A value that many owners have is an example that was copied around. A
value of few owners that looks random is treated as live, and every place where it occurs,
also without a keyword before it, is reported.

Positions come from the pieces between matches: `split` and `regexp_extract_all` with the same
pattern alternate, so running sums of their lengths give the code points. These sums, and which
spans overlap, are windows over the matches of a text, so the work grows with the number of
matches, not its square. Only hashes of values leave the task that read the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfare.llm.common import ROW, fields_of, text_of, whole_rows
from wayfare.session import materialise

KINDS = ("assign", "access", "hex")
ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
# A run that is long enough, from its first character: the same as all runs, then the long ones.
HEX = r"[0-9a-f]{24,}"
# A token that could be a credential wherever it stands.
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
LEAST_ASSIGNED = 6
# Fewest distinct characters of a value that looks random.
LEAST_DISTINCT = 8
# A value of more distinct owners and repositories than these is an example.
MAX_OWNERS = 3
MAX_REPOSITORIES = 5
# Code points of a text that are redacted at a time.
BLOCK = 16_384

STEPS = "array<struct<kind:int,i:int,before:int,size:int,hash:string,random:boolean,used:boolean>>"
SPANS = "array<struct<start:bigint,kind:int,end:bigint,verdict:string>>"


def looks_random(value: Column) -> Column:
    """Of several different characters, with letters and digits, as live credentials are."""
    distinct = F.size(F.array_distinct(F.filter(F.split(value, ""), lambda c: c != "")))
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    return (distinct >= LEAST_DISTINCT) & mixed


def steps(text: Column, pattern: str, kind: int, group: int = 0) -> Column:
    """Array of the leftmost matches that do not overlap, each with the piece before it.

    Fields: kind, i (from 0), before and size (code points), hash and random of the value, which
    is the text of `group`, and used: whether the value is long enough.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    between = F.split(text, pattern, -1)
    least = LEAST_ASSIGNED if kind == 0 else 0

    def judged(match: Column, said: Column) -> Column:
        return F.struct(
            F.length(match).alias("size"), F.md5(said.cast("binary")).alias("hash"),
            looks_random(said).alias("random"), (F.length(said) >= least).alias("used"),
        )

    values = F.zip_with(whole, value, judged)
    # There is one piece more than matches; the last one is left out.
    pairs = F.zip_with(
        values, F.slice(between, 1, F.size(between) - 1), lambda z, b: F.struct(z.alias("z"), F.length(b).alias("b"))
    )
    found = F.transform(
        pairs,
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), x["b"].alias("before"), x["z"]["size"].alias("size"),
            x["z"]["hash"].alias("hash"), x["z"]["random"].alias("random"), x["z"]["used"].alias("used"),
        ),
    )
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(STEPS))


def with_steps(
    docs: DataFrame, owner: Column, repository: Column, row: Column | None = None
) -> DataFrame:
    """doc_id, row, owner, repository and matches of all patterns of every row, without texts."""
    text = F.col("_text")
    row = F.monotonically_increasing_id() if row is None else row
    read = docs.select(
        row.alias(ROW), F.col("doc_id").cast("long").alias("doc_id"),
        owner.cast("string").alias("_owner"), repository.cast("string").alias("_repo"),
        text_of().alias("_text"),
    )
    every = (steps(text, ASSIGN, 0, 2), steps(text, ACCESS, 1), steps(text, HEX, 2), steps(text, TOKEN, 3))
    return read.select(ROW, "doc_id", "_owner", "_repo", F.concat(*every).alias("_steps"))


def span_rows(found: DataFrame, max_owners: int, max_repositories: int) -> DataFrame:
    """Row id, start, kind, end and verdict of all spans, from the stored result of `with_steps`."""
    found = found.filter(F.size("_steps") > 0).select(ROW, "_owner", "_repo", F.inline("_steps"))
    so_far = Window.partitionBy(ROW, "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = found.withColumn("end", F.sum((F.col("before") + F.col("size")).cast("long")).over(so_far))
    placed = placed.withColumn("start", F.col("end") - F.col("size"))
    reported = F.col("used") & ((F.col("kind") < 3) | F.col("random"))
    places = materialise(
        placed.filter(reported).select(ROW, "_owner", "_repo", "kind", "start", "end", "hash", "random")
    )
    # Copies within one owner and repository are combined before anything is exchanged.
    uses = places.filter("random").groupBy("hash", "_owner", "_repo").agg(F.lit(1).alias("_one"))
    owners = uses.groupBy("hash", "_owner").agg(F.count(F.lit(1)).alias("_repos"))
    shared = materialise(
        owners.groupBy("hash").agg(
            F.count(F.lit(1)).alias("owners"), F.sum("_repos").alias("repositories")
        )
    )
    judged = places.join(shared, "hash", "left")
    example = (F.col("owners") > max_owners) & (F.col("repositories") > max_repositories)
    verdict = F.when(~F.col("random"), "weak").when(example, "example").otherwise("live")
    judged = judged.select(ROW, "start", "kind", "end", verdict.alias("verdict"))
    return _without_overlaps(judged.filter((F.col("kind") < 3) | (F.col("verdict") == "live")))


def _without_overlaps(spans: DataFrame) -> DataFrame:
    """All base spans, and those of the method that touch none of them."""
    base = F.col("kind") < 3
    ordered = Window.partitionBy(ROW).orderBy("start", "kind")
    turned = Window.partitionBy(ROW).orderBy(F.desc("start"), F.desc("kind"))
    earlier = F.max(F.when(base, F.col("end"))).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    later = F.min(F.when(base, F.col("start"))).over(turned.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("_earlier", earlier).withColumn("_later", later)
    touched = F.coalesce(F.col("_earlier") > F.col("start"), F.lit(False)) | F.coalesce(
        F.col("_later") < F.col("end"), F.lit(False)
    )
    return marked.filter(base | ~touched).drop("_earlier", "_later")


def scan(
    docs: DataFrame,
    owner: Column | None = None,
    repository: Column | None = None,
    max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
    row: Column | None = None,
) -> DataFrame:
    """Row id, doc_id, counts of base kinds, base spans and all spans of every row.

    `spans` is an array of (start, kind, end, verdict): base spans, and the places of tokens
    judged live, kind 3, that no base span overlaps. The verdict is `live` or `example` or, for base
    spans whose value does not look random, `weak`. The owner is `source` and the repository
    `doc_id` unless columns are given; `row` may give an id that is unique. Rows without an owner count as one owner, as do those
    without a repository. A null text counts as empty. Rows may repeat. Other columns are not
    read. No rows give no rows.
    """
    owner = F.col("source") if owner is None else owner
    repository = F.col("doc_id") if repository is None else repository
    # Written once: row ids are fixed and texts left behind.
    found = materialise(with_steps(docs, owner, repository, row))
    by_row = span_rows(found, max_owners, max_repositories).groupBy(ROW).agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end", "verdict"))).alias("spans")
    )

    def number(kind: int) -> Column:
        return F.size(F.filter("_steps", lambda m: (m["kind"] == kind) & m["used"])).cast("long")

    result = found.select(ROW, "doc_id", *(number(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)))
    return result.join(by_row, ROW, "left").select(
        ROW, "doc_id", *(f"n_{kind}" for kind in KINDS),
        F.coalesce("spans", F.array().cast(SPANS)).alias("spans"),
    )


def joined(spans: Column) -> Column:
    """kind:start:end of each span, by start, then kind."""
    names = F.array(*(F.lit(name) for name in (*KINDS, "live")))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def digests(docs: DataFrame, **options: object) -> DataFrame:
    """The columns of the registered query."""
    base = F.filter("spans", lambda s: s["kind"] < 3)
    examples = F.filter("spans", lambda s: s["verdict"] == "example")
    live = F.filter("spans", lambda s: s["verdict"] == "live")
    return scan(docs, **options).select(
        "doc_id", *(f"n_{kind}" for kind in KINDS),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        F.size(live).cast("long").alias("n_live"), F.size(examples).cast("long").alias("n_example"),
    )


def redact(docs: DataFrame, mark: str = "[secret]", **options: object) -> DataFrame:
    """`docs` with live and weak secrets replaced by `mark`; widely copied examples stay.

    All rows and other columns stay.
    """
    numbered = whole_rows(docs)
    read = numbered.select("_doc.doc_id", "_doc.text", "_doc.source", ROW)
    cuts = materialise(_cuts(_islands(_to_replace(read, **options))))
    text = F.col("_doc.text")
    new = F.when(F.col("_cuts").isNull(), text).otherwise(_without(text, F.col("_cuts"), mark))
    return numbered.join(cuts, ROW, "left").select(*fields_of(numbered, {"text": new}))


def _to_replace(docs: DataFrame, **options: object) -> DataFrame:
    """Row id, start and end of live and weak spans."""
    spans = scan(docs, row=F.col(ROW), **options).select(ROW, F.inline("spans"))
    return spans.filter(F.col("verdict") != "example").select(ROW, "start", "end")


def _islands(spans: DataFrame) -> DataFrame:
    """Spans that overlap as one."""
    ordered = Window.partitionBy(ROW).orderBy("start", "end")
    before = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce(F.col("start") >= F.col("_before"), F.lit(True))
    number = F.sum(fresh.cast("int")).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    marked = spans.withColumn("_before", before).withColumn("_island", number)
    return marked.groupBy(ROW, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end"))


def _cuts(islands: DataFrame) -> DataFrame:
    """Row id and _cuts: for each block of BLOCK code points with islands, its number and its parts of them."""
    first = F.floor(F.col("start") / BLOCK).cast("long")
    last = F.floor((F.col("end") - 1) / BLOCK).cast("long")
    cut = islands.select(ROW, "start", "end", F.explode(F.sequence(first, last)).alias("block"))
    low = F.col("block") * BLOCK
    part = F.struct(
        (F.greatest("start", low) - low).cast("int").alias("from"),
        F.least(F.col("end") - low, F.lit(BLOCK)).cast("int").alias("to"),
        (F.col("start") >= low).alias("opens"),
    )
    parts = cut.groupBy(ROW, "block").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return parts.groupBy(ROW).agg(F.array_sort(F.collect_list(F.struct("block", "parts"))).alias("_cuts"))


def _without(text: Column, cuts: Column, mark: str) -> Column:
    """The text with `mark` for each island.

    It is cut into blocks, so that no place is looked for from the start of a long text.
    """
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def replaced(said: Column, parts: Column) -> Column:
        def step(state: Column, part: Column) -> Column:
            plain = F.substring(said, state["at"] + 1, part["from"] - state["at"])
            shown = F.when(part["opens"], F.lit(mark)).otherwise("")
            return F.struct(part["to"].alias("at"), F.concat(state["out"], plain, shown).alias("out"))

        return F.aggregate(
            parts, start, step, lambda s: F.concat(s["out"], F.substring(said, s["at"] + 1, F.length(said)))
        )

    def block(said: Column, number: Column) -> Column:
        parts = F.get(F.filter(cuts, lambda cut: cut["block"] == number), F.lit(0))["parts"]
        return F.when(parts.isNull(), said).otherwise(replaced(said, parts))

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    return F.array_join(F.transform(blocks, block), "")


def _sql_matches(kind: str, pattern: str, group: int = 0) -> str:
    """Rows (doc_id, start, kind, end, value) of a pattern, by the same interleaving as `matches`."""
    quoted = pattern.replace("'", "''")
    order = (*KINDS, "live").index(kind)
    return f"""
SELECT doc_id, source, i, {order} AS kind, v[i] AS value,
  CAST(list_sum(list_transform(b[1:i], lambda x: length(x)))
    + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start,
  length(m[i]) AS size
FROM (
  SELECT doc_id, source, m, v, b, unnest(range(1, len(m) + 1)) AS i FROM (
    SELECT doc_id, source, regexp_extract_all(t, '{quoted}', 0) AS m,
      regexp_extract_all(t, '{quoted}', {group}) AS v, string_split_regex(t, '{quoted}') AS b
    FROM docs
  )
)"""


def _sql_joined(condition: str) -> str:
    """kind:start:end of the spans that meet a condition, by start, then kind."""
    return (
        "coalesce(string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) "
        f"FILTER ({condition}), '')"
    )


SQL = f"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
found AS (
  {_sql_matches("assign", ASSIGN, 2)} UNION ALL {_sql_matches("access", ACCESS)}
  UNION ALL {_sql_matches("hex", HEX)} UNION ALL {_sql_matches("live", TOKEN)}
), places AS (
  SELECT doc_id, source, kind, ['assign', 'access', 'hex', 'live'][kind + 1] AS name, start,
    start + size AS stop, value,
    len(list_distinct(string_split(value, ''))) >= {LEAST_DISTINCT}
      AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AS random
  FROM found WHERE kind > 0 OR length(value) >= {LEAST_ASSIGNED}
), shared AS (
  SELECT value, count(DISTINCT coalesce(source, chr(0))) AS owners,
    count(DISTINCT (source, doc_id)) AS repositories
  FROM places WHERE random GROUP BY value
), judged AS (
  SELECT p.*, CASE WHEN NOT random THEN 'weak'
    WHEN owners > {MAX_OWNERS} AND repositories > {MAX_REPOSITORIES} THEN 'example'
    ELSE 'live' END AS verdict
  FROM places AS p LEFT JOIN shared USING (value)
), kept AS (
  SELECT * FROM judged AS j WHERE kind < 3 OR verdict = 'live' AND NOT EXISTS (
    SELECT 1 FROM judged AS b
    WHERE b.doc_id = j.doc_id AND b.kind < 3 AND b.start < j.stop AND j.start < b.stop)
), by_doc AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
    count(*) FILTER (kind = 2) AS n_hex, {_sql_joined("kind < 3")} AS base,
    {_sql_joined("TRUE")} AS spans, count(*) FILTER (verdict = 'live') AS n_live,
    count(*) FILTER (verdict = 'example') AS n_example
  FROM kept GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM docs LEFT JOIN by_doc USING (doc_id)"""
