"""Quality classifier from weak labels.

Several heuristic labellers vote `bad` or nothing on each document: each knows one way to be bad,
so its silence is no praise. Known labels are one more labeller, which also votes `good` and which is
believed, so that the classes mean what the labels mean. Only how often each pattern of votes occurs, over all documents, is needed to
estimate by expectation-maximisation how accurate every labeller is and how many documents
are bad; there are 3**labellers patterns at most. The posterior of its pattern is a document's
soft label. A linear scorer over hashed features is fitted to the soft labels of a bounded sample
of documents on which some labeller voted, and scores every whole text. There are two such models: one for junk, one for toxic text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import bounded_batches, text_of
from wayfare.session import materialise

# Sample that the scorers are fitted to: at most so many documents of at most so many characters.
SAMPLE_DOCS = 12_000
SAMPLE_CHARS = 20_000
HASH_BITS = 18
# A feature is used if so many documents of the sample have it and it is this informative (G²).
LEAST_DOCS = 8
LEAST_GAIN = 16.0
EPOCHS = 12
# Lengths of the beginnings of words.
PREFIXES = (4, 5, 6, 7)
# Words whose features a worker keeps.
KEPT_WORDS = 200_000
RATE = 0.3
SHRINK = 1e-3
LIMIT = 0.5

# How often known labels are right.
KNOWN_RIGHT = 0.995

BAD, GOOD, NONE = "b", "g", "-"

# Insults, as generic as a word list of the kind is.
INSULTS = frozenset(
    "clown disgusting dumb fool garbage idiot imbecile jerk loser moron pathetic scum stupid trash "
    "worthless".split()
)
_WORD = re.compile(r"\w+")
_MARKS = re.compile(r"[^\w\s]{2,}")


# -- labellers -------------------------------------------------------------------------------


@dataclass
class Facts:
    """What the labellers look at."""

    text: str
    words: list[str] = field(init=False)
    tokens: list[str] = field(init=False)

    def __post_init__(self) -> None:
        self.words = self.text.split()
        self.tokens = _WORD.findall(self.text.lower())


def _share(part: float, whole: int) -> float:
    return part / whole if whole else 0.0


def lettered(f: Facts) -> float:
    """Share of words with a letter."""
    having = [w[0].isalpha() or any(map(str.isalpha, w)) for w in f.words]
    return _share(sum(having), len(f.words))


def upper(f: Facts) -> float:
    """Characters that lower case changes, as a share of those of words."""
    low = f.text.lower()
    if len(low) != len(f.text):  # few characters have a lower case of another length
        low = "".join(c.lower()[0] for c in f.text)
    own, other = (
        np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in (f.text, low)
    )
    return _share(float((own != other).sum()), sum(map(len, f.tokens)))


def repeated(f: Facts) -> float:
    """Share of words that equal the one before."""
    return _share(sum(a == b for a, b in zip(f.words, f.words[1:])), len(f.words))


def symbols(f: Facts) -> float:
    """Symbols per word."""
    return _share(sum(map(f.text.count, "#*$%&<>{}~^\\")), len(f.words))


def doubled(f: Facts) -> float:
    """Runs of two or more punctuation marks per word."""
    return _share(len(_MARKS.findall(f.text)), len(f.words))


def commonest(f: Facts) -> float:
    """Share of the commonest word."""
    return _share(max(Counter(f.tokens).values(), default=0), len(f.tokens))


def mean_length(f: Facts) -> float:
    """Mean characters of a word."""
    return _share(sum(map(len, f.words)), len(f.words))


def insults(f: Facts) -> float:
    """How many different insults there are."""
    return len(INSULTS.intersection(f.tokens))


def insults_per_word(f: Facts) -> float:
    """Insults per word."""
    return _share(sum(w in INSULTS for w in f.tokens), len(f.tokens))


Measure = Callable[[Facts], float]
Rule = tuple[Measure, Callable[[float], bool]]

# A measure, and when it votes bad. Measures that see the same fault would count it twice.
JUNK: tuple[Rule, ...] = (
    (lettered, lambda x: x < 0.8),
    (upper, lambda x: x > 0.4),
    (repeated, lambda x: x > 0.2),
    (symbols, lambda x: x > 0.3),
    (commonest, lambda x: x > 0.4),
    (mean_length, lambda x: not 2.0 <= x <= 14.0),
)
TOXIC: tuple[Rule, ...] = (
    (insults, lambda x: x >= 2),
    (insults_per_word, lambda x: x > 0.01),
)


def pattern(facts: Facts, rules: tuple[Rule, ...]) -> str:
    """One letter per labeller."""
    return "".join(BAD if bad(measure(facts)) else NONE for measure, bad in rules)


# -- weak-label model ------------------------------------------------------------------------


@dataclass
class WeakLabelModel:
    """Prior of bad, and per labeller how likely each vote is for bad and for good documents."""

    prior: float
    likely: np.ndarray  # labeller, vote (bad, good, none), class (good, bad)

    def posterior(self, votes: str) -> float:
        """Probability that a document with these votes is bad."""
        if votes[-1] != NONE:
            return KNOWN_RIGHT if votes[-1] == BAD else 1 - KNOWN_RIGHT
        odds = math.log(self.prior / (1 - self.prior))
        for own, v in zip(self.likely, votes[:-1]):
            k = (BAD + GOOD + NONE).index(v)
            odds += math.log(own[k, 1] / own[k, 0])
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))


def fit_weak_labels(counts: dict[str, int], rounds: int = 100) -> WeakLabelModel:
    """Expectation-maximisation over counts of vote patterns; the last vote is the known label.

    It starts from the documents whose label is known or, without any, from the belief that a
    vote is fifteen times as likely to be right. It keeps half a document of each kind in every
    count, so that no probability is zero.
    """
    labellers = len(next(iter(counts), ""))
    votes = np.array([["bg-".index(v) for v in p] for p in counts], int).reshape(len(counts), labellers)
    every = np.array(list(counts.values()), float)
    start = np.array([[0.02, 0.3], [0.3, 0.02], [0.68, 0.68]])
    model = WeakLabelModel(0.15, np.repeat(start[None], labellers, 0))
    labelled = np.array([p[-1] != NONE for p in counts], bool)
    for step in range(rounds if counts else 0):
        bad = np.array([model.posterior(p) for p in counts])
        weight = every * labelled if step == 0 and labelled.any() else every
        likely = np.full((labellers, 3, 2), 0.5)
        for j in range(labellers):
            for k in range(3):
                own = votes[:, j] == k
                likely[j, k] += (weight[own] @ (1 - bad[own]), weight[own] @ bad[own])
        likely /= likely.sum(1, keepdims=True)
        prior = (weight @ bad + 0.5) / (weight.sum() + 1)
        done = abs(prior - model.prior) < 1e-7 and np.abs(likely - model.likely).max() < 1e-6
        model = WeakLabelModel(prior, likely)
        if done:
            break
    return model


# -- hashed linear scorer --------------------------------------------------------------------


def feature(name: str) -> int:
    return xxhash.xxh32_intdigest(name.encode("utf-8", "surrogatepass")) >> (32 - HASH_BITS)


def junk_features(f: Facts) -> Iterator[str]:
    """Measures in bins of equal ratio, one feature for each bin reached."""
    for measure in (*(measure for measure, _ in JUNK), doubled):
        value = measure(f)
        for step in range(1, 24):
            if value > 64 * 0.75**step:
                yield f"{measure.__name__}>{step}"


def toxic_features(f: Facts) -> Iterator[str]:
    """Words, and the beginnings of words, which inflected forms share."""
    beginnings = set()
    for word in set(f.tokens):
        yield word
        beginnings.update(word[:n] for n in PREFIXES if n < len(word))
    yield from (f"{beginning}-" for beginning in beginnings)


class WordPlaces:
    """Places of the features of toxic text, of those that a mask lets through.

    What a word gives is kept, in a table that starts anew when it is full: most words come again,
    and give nothing.
    """

    def __init__(self, used: np.ndarray):
        self._used = used
        self._kept: dict[str, tuple[int, ...]] = {}

    def __call__(self, facts: Facts) -> np.ndarray:
        found: set[int] = set()
        kept = self._kept
        if len(kept) > KEPT_WORDS:
            kept.clear()
        for word in set(facts.tokens):
            own = kept.get(word)
            if own is None:
                names = (word, *(f"{word[:n]}-" for n in PREFIXES if n < len(word)))
                own = kept[word] = tuple(p for p in map(feature, names) if self._used[p])
            if own:
                found.update(own)
        return np.array(sorted(found), np.int64)


@dataclass
class Scorer:
    """A logistic model over hashed features; only features that carry weight are kept."""

    bias: float
    weights: np.ndarray

    def score(self, features: np.ndarray) -> float:
        total = self.bias + float(self.weights[features].sum())
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, total))))


def informative(having: np.ndarray, bad: np.ndarray, total: float, total_bad: float) -> np.ndarray:
    """Which features enough documents have, and tell enough about being bad (G²)."""

    def likelihood(part: np.ndarray, of: np.ndarray | float) -> np.ndarray:
        share = np.clip(part / np.maximum(of, 1e-9), 1e-9, 1 - 1e-9)
        return part * np.log(share) + (of - part) * np.log(1 - share)

    apart = likelihood(bad, having) + likelihood(total_bad - bad, total - having)
    gain = 2 * (apart - likelihood(np.array(total_bad), total))
    return (having >= LEAST_DOCS) & (gain >= LEAST_GAIN)


def fit_scorer(rows: list[np.ndarray], labels: np.ndarray) -> Scorer:
    """Fit to soft labels. Features that tell little, or that few documents have, get no weight."""
    size = 1 << HASH_BITS
    weights = np.zeros(size)
    total, bad = len(rows), float(labels.sum())
    if not total:
        return Scorer(-2.0, weights)
    having, having_bad = np.zeros(size), np.zeros(size)
    for own, label in zip(rows, labels):
        having[own] += 1
        having_bad[own] += label
    used = informative(having, having_bad, total, bad)
    kept = [own[used[own]] for own in rows]
    base = min(max(bad / total, 1e-3), 1 - 1e-3)
    bias = math.log(base / (1 - base))
    seen, seen_bias = np.full(size, 1e-2), 1e-2
    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for i in order.permutation(total).tolist():
            own = kept[i]
            z = bias + weights[own].sum()
            error = 1 / (1 + math.exp(-max(-500.0, min(500.0, z)))) - labels[i]
            step = error + SHRINK * weights[own]
            seen[own] += step * step
            weights[own] -= RATE * step / np.sqrt(seen[own])
            seen_bias += error * error
            bias -= RATE * error / math.sqrt(seen_bias)
    return Scorer(bias, weights)


# -- Spark jobs ------------------------------------------------------------------------------

MODELS: tuple[tuple[str, tuple[Rule, ...], Callable[[Facts], Iterable[str]]], ...] = (
    ("junk", JUNK, junk_features),
    ("toxic", TOXIC, toxic_features),
)


def hashed(names: Iterable[str]) -> np.ndarray:
    return np.unique(np.fromiter(map(feature, names), np.int64))


def vote_patterns(docs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(_h, _chars, junk, toxic): a hash of each text, its length and the votes on it.

    The last vote of each pattern is the known label: `quality` 0 is bad for junk, `toxic` 1
    for toxic. A document with contradicting labels has the worse one.
    """

    @F.pandas_udf("junk string, toxic string")
    def votes(texts: pd.Series) -> pd.DataFrame:
        facts = [Facts(text) for text in texts]
        return pd.DataFrame(
            {name: [pattern(f, rules) for f in facts] for name, rules, _ in MODELS}
        )

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("_text"))
    voted = materialise(
        read.select(
            "doc_id", F.xxhash64("_text").alias("_h"), F.length("_text").alias("_chars"),
            votes("_text").alias("_v"),
        ).select("doc_id", "_h", "_chars", "_v.*")
    )
    if labels is None:
        return voted.withColumns({n: F.concat(n, F.lit(NONE)) for n in ("junk", "toxic")})
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = materialise(known.agg(F.min("quality").alias("_q"), F.max("toxic").alias("_t")))
    gold = {
        "junk": F.when(F.col("_q") == 0, BAD).when(F.col("_q") == 1, GOOD).otherwise(NONE),
        "toxic": F.when(F.col("_t") == 1, BAD).when(F.col("_t") == 0, GOOD).otherwise(NONE),
    }
    joined = voted.join(known, "doc_id", "left")
    return materialise(
        joined.select(
            "_h", "_chars", *(F.concat(n, vote).alias(n) for n, vote in gold.items())
        )
    )


def pattern_of_copies(name: str) -> Column:
    """Aggregate: the votes, which copies of a text share, and the worst label known of any copy."""
    votes, label = F.expr(f"left({name}, length({name}) - 1)"), F.right(name, F.lit(1))
    known = F.min(F.when(label != NONE, label))
    return F.concat(F.min(votes), F.coalesce(known, F.lit(NONE)))


def fit(
    docs: DataFrame, labels: DataFrame | None, sample_docs: int = SAMPLE_DOCS
) -> dict[str, tuple[WeakLabelModel, Scorer]]:
    """Both models. Votes are counted over all documents; the scorers see a bounded sample.

    The sample has different texts of at most SAMPLE_CHARS characters, those of the lowest hashes.
    """
    voted = vote_patterns(docs, labels)
    models, praised, seen = {}, {}, {}
    for name, _, _ in MODELS:
        counts = {row[0]: row[1] for row in voted.groupBy(name).count().collect()}
        models[name] = fit_weak_labels(counts)
        seen[name] = list(counts)
        praised[name] = any(GOOD in p for p in counts)
    # Where nobody ever votes good, silence has to stand for it.
    spoken = [F.lit(True) if not good else F.col(n).rlike("[bg]") for n, good in praised.items()]
    chosen = voted.filter((F.col("_chars") <= SAMPLE_CHARS) & (spoken[0] | spoken[1]))
    chosen = chosen.groupBy("_h").agg(*(pattern_of_copies(n).alias(n) for n, _, _ in MODELS))
    chosen = materialise(chosen.orderBy("_h").limit(sample_docs))

    texts = docs.select(text_of().alias("_text")).withColumn("_h", F.xxhash64("_text"))
    # At most `sample_docs` hashes are sent to every task.
    sample = texts.join(F.broadcast(chosen.select("_h")), "_h", "left_semi")
    sample = materialise(sample.groupBy("_h").agg(F.min("_text").alias("_text")).join(chosen, "_h"))
    soft = {
        name: {p: models[name].posterior(p) for p in patterns if not praised[name] or p.strip(NONE)}
        for name, patterns in seen.items()
    }
    useful = _useful_features(sample, soft)
    return {
        name: (models[name], fit_scorer(*rows))
        for name, rows in _sample_rows(sample, soft, useful).items()
    }


def _useful_features(
    sample: DataFrame, soft: dict[str, dict[str, float]]
) -> dict[str, np.ndarray]:
    """Per model, a mask of informative features, counted where the texts are."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = 1 << HASH_BITS
        sums = {name: np.zeros((2, size + 1)) for name, _, _ in MODELS}
        for batch in batches:
            for row in batch.itertuples(index=False):
                facts = Facts(row.text)
                for name, _, features in MODELS:
                    label = soft[name].get(getattr(row, name))
                    if label is not None:
                        # The last place counts documents.
                        own = np.append(hashed(features(facts)), size)
                        sums[name][0, own] += 1
                        sums[name][1, own] += label
        for name, (having, bad) in sums.items():
            own = np.flatnonzero(having)
            yield pd.DataFrame({"model": name, "f": own, "n": having[own], "bad": bad[own]})

    read = sample.select(F.col("_text").alias("text"), "junk", "toxic")
    counted = read.mapInPandas(count, "model string, f long, n double, bad double")
    counted = counted.groupBy("model", "f").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    # At most one row per place of the hashed vectors.
    found = counted.filter(F.col("n") >= LEAST_DOCS).toPandas()
    useful = {}
    for name, _, _ in MODELS:
        own = found[found["model"] == name]
        having, bad = np.zeros((2, (1 << HASH_BITS) + 1))
        having[own["f"]], bad[own["f"]] = own["n"], own["bad"]
        useful[name] = informative(having[:-1], bad[:-1], having[-1], bad[-1])
    return useful


def _sample_rows(
    sample: DataFrame, soft: dict[str, dict[str, float]], useful: dict[str, np.ndarray]
) -> dict[str, tuple[list[np.ndarray], np.ndarray]]:
    """Per model, the useful features of each sample document, and its soft label."""

    @F.pandas_udf("junk array<int>, toxic array<int>")
    def features(texts: pd.Series) -> pd.DataFrame:
        facts = [Facts(text) for text in texts]
        found = {name: [hashed(of(f)) for f in facts] for name, _, of in MODELS}
        return pd.DataFrame({name: [f[useful[name][f]] for f in rows] for name, rows in found.items()})

    rows = sample.select("_h", "junk", "toxic", features("_text").alias("_f")).select(
        "_h", "junk", "toxic", F.col("_f.junk").alias("junk_f"), F.col("_f.toxic").alias("toxic_f")
    ).toPandas().sort_values("_h")
    found = {}
    for name, _, _ in MODELS:
        labels = rows[name].map(soft[name])
        own = [np.asarray(f, np.int64) for f in rows.loc[labels.notna(), f"{name}_f"]]
        found[name] = own, labels.dropna().to_numpy(float)
    return found


def score(
    docs: DataFrame, models: dict[str, tuple[WeakLabelModel, Scorer]], name: str = "_scores"
) -> DataFrame:
    """`docs` with a struct of the scores p_junk and p_toxic of each whole text."""
    spark = docs.sparkSession
    # Two vectors of 2**HASH_BITS numbers, whatever the corpus is.
    sent = spark.sparkContext.broadcast(
        {
            m: (scorer.bias, np.flatnonzero(scorer.weights), scorer.weights[scorer.weights != 0])
            for m, (_, scorer) in models.items()
        }
    )

    @F.pandas_udf("p_junk double, p_toxic double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorers = {}
        for m, (bias, places, values) in sent.value.items():
            weights = np.zeros(1 << HASH_BITS)
            weights[places] = values
            scorers[m] = Scorer(bias, weights)
        words = WordPlaces(scorers["toxic"].weights != 0)
        for texts in batches:
            facts = [Facts(text) for text in texts]
            yield pd.DataFrame(
                {
                    "p_junk": [scorers["junk"].score(hashed(junk_features(f))) for f in facts],
                    "p_toxic": [scorers["toxic"].score(words(f)) for f in facts],
                }
            )

    return docs.withColumn(name, scores(text_of()))


def classify(
    docs: DataFrame, labels: DataFrame | None = None, name: str = "_scores", limit: float = LIMIT
) -> DataFrame:
    """`docs` with a struct (p_junk, p_toxic, kept): kept if both scores are at most `limit`.

    A null text counts as empty. Rows may repeat, doc_id may be null or repeat, and other columns
    stay; a column called `name` is replaced. Without labels, or with labels of no document,
    the labellers alone decide. No rows give no rows.
    """
    bounded_batches(docs.sparkSession)
    scored = score(docs, fit(docs, labels), name)
    fine = (F.col(f"{name}.p_junk") <= limit) & (F.col(f"{name}.p_toxic") <= limit)
    return scored.withColumn(name, F.struct(f"{name}.p_junk", f"{name}.p_toxic", fine.alias("kept")))


def keep_good(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """The rows of `docs` that the classifier keeps, with its columns."""
    name = "_wf_scores"
    return classify(docs, labels, name).filter(F.col(f"{name}.kept")).drop(name)
