"""Toxicity by a weighted finite-state grammar over clauses.

A text is read word by word. The lexical transducer turns a word into a symbol
(insult, threat, target, negation, report, other) and an insult also into the
weight of its arc. Three small transducers are composed behind it:

* target: an insult after a target becomes ``aimed``; a threat followed closely
  by a target becomes ``threatened``;
* negation: lowers what follows a negator within three words;
* reported speech: lowers what follows a verb of saying, to the end of the next
  clause (the quoted one).

A clause ends at punctuation or a line break and scores the sum of its weighted
symbols, so an isolated target, negator or verb of saying scores nothing. A
clause in which an insult stands without any other symbol is no composed match
and counts by ``LONE_FACTOR``; it is not nothing, as labelled texts may hold
their insults that way. A contraction with "n't" is one negator. A logistic
function of the matched clauses gives the score of a text.

The insult arcs are learned: whole words and word beginnings whose document
counts differ between toxic and clean labelled texts beyond chance. Weights are
log odds. Everything is fitted on at most ``MAX_TRAINING_DOCS`` labelled
documents, picked by a hash of their id; that bound is a parameter. All arcs
that pass the test are kept. The odds of an arc count up to ``MOST_ODDS``, as
those of a rare one are uncertain, and the feature of the strongest clause up to
``STRONGEST``, about two such arcs, so that one repeated word does not outweigh
all else. Scoring covers all documents and whole texts.

Defined results: a null or empty text has no clause and gets the score of no
match; an empty table gives an empty result; without usable labels no arc is
learned and threats alone score; repeated rows are scored each; contradicting
labels of one id count as toxic; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.llm.common import materialize, table

MAX_TRAINING_DOCS = 20_000
STEM_LENGTHS = range(3, 9)

# Words of the grammar that are not learned.
NEGATION = frozenset("not no never cannot cant dont didnt wont isnt pas jamais nicht kein keine nie nunca tampoco".split())
REPORT = frozenset("said says wrote writes claimed called quoted told reported dit écrit disait sagte schrieb dijo escribió".split())
TARGET = frozenset("you your yours he she him her they them their tu toi vous du dich dir ihr euch usted ustedes vosotros".split())
THREAT = frozenset("kill murder hurt destroy shoot stab strangle smash crush beat tuer frapper töten schlagen matar golpear".split())
THREAT_WEIGHT = 6.0
AIMED_FACTOR = 1.5
NEGATED_FACTOR = 0.3
REPORTED_FACTOR = 0.4
LONE_FACTOR = 0.5
MOST_ODDS = 6.0
STRONGEST = 12.0

_TOKENS = re.compile(r"(\w+)((?<=n)['’]t\b)?|([.,;:!?()|\n\"“”«»])")
BOUNDARY = "boundary"
SYMBOLS = ("insult", "aimed", "threat", "threatened", "target", "negation", "report", "other", BOUNDARY)
_SCORED = ("insult", "aimed", "threatened")

Step = Callable[[object, str], tuple[object, str, float]]


@dataclass(frozen=True)
class Transducer:
    """Deterministic: ``arcs[state, symbol]`` is (next state, symbol out, factor)."""

    start: object
    arcs: dict[tuple[object, str], tuple[object, str, float]]

    @staticmethod
    def of(start: object, step: Step) -> Transducer:
        arcs, todo = {}, [start]
        while todo:
            state = todo.pop()
            if (state, SYMBOLS[0]) in arcs:
                continue
            for symbol in SYMBOLS:
                arcs[state, symbol] = step(state, symbol)
                todo.append(arcs[state, symbol][0])
        return Transducer(start, arcs)

    def then(self, other: Transducer) -> Transducer:
        """The composition: ``other`` reads what this one writes; factors multiply."""

        def step(state, symbol):
            mine, theirs = state
            mine, out, f = self.arcs[mine, symbol]
            theirs, out, g = other.arcs[theirs, out]
            return (mine, theirs), out, f * g

        return Transducer.of((self.start, other.start), step)


def _target_step(state, symbol):
    """State: whether a target was seen in this clause, and for how many words a threat still waits."""
    seen, waits = state
    if symbol == BOUNDARY:
        return (False, 0), symbol, 1.0
    if symbol == "target":
        return (True, 0), "threatened" if waits else symbol, 1.0
    if symbol == "threat":
        return (seen, 4), symbol, 1.0
    left = max(0, waits - 1)
    if symbol == "insult" and seen:
        return (seen, left), "aimed", AIMED_FACTOR
    return (seen, left), symbol, 1.0


def _negation_step(state, symbol):
    """State: for how many words a negator still holds."""
    if symbol == BOUNDARY:
        return 0, symbol, 1.0
    if symbol == "negation":
        return 3, symbol, 1.0
    # A threat is negated where its verb is, and told apart at its target.
    return max(0, state - 1), symbol, NEGATED_FACTOR if state and symbol in _SCORED else 1.0


def _report_step(state, symbol):
    """State: boundaries until the reported clause is over, plus one; 0 if nothing is reported."""
    if symbol == BOUNDARY:
        return max(0, state - 1), symbol, 1.0
    if symbol == "report":
        return 3, symbol, 1.0
    return state, symbol, REPORTED_FACTOR if state and symbol in _SCORED else 1.0


GRAMMAR = (
    Transducer.of((False, 0), _target_step)
    .then(Transducer.of(0, _negation_step))
    .then(Transducer.of(0, _report_step))
)


# --- lexical transducer -------------------------------------------------------------


def arcs_of(word: str) -> list[str]:
    """The names of all arcs that accept a word: its beginnings, and itself, marked by ``$``."""
    names = [word[:n] for n in STEM_LENGTHS if n <= len(word)]
    return [*names, word + "$"] if len(word) >= STEM_LENGTHS[0] else names


@dataclass
class Lexicon:
    weights: dict[str, float]
    known: dict[str, tuple[str, float]] = field(default_factory=dict)

    def read(self, word: str, contracted: bool = False) -> tuple[str, float]:
        """Symbol and weight of a lower-case word; ``contracted`` if "'t" follows its n."""
        if contracted:
            return "negation", 0.0
        best = max((self.weights.get(a, 0.0) for a in arcs_of(word)), default=0.0)
        if best > 0:
            return "insult", best
        if word in THREAT:
            return "threat", 0.0
        if word in TARGET:
            return "target", THREAT_WEIGHT
        if word in NEGATION:
            return "negation", 0.0
        return ("report", 0.0) if word in REPORT else ("other", 0.0)


def clause_scores(text: str, lexicon: Lexicon) -> tuple[list[float], int]:
    """The scores of the clauses that match, and how many clauses there are."""
    scores: list[float] = []
    clauses, score, words, symbols = 0, 0.0, 0, 0
    state, arcs = GRAMMAR.start, GRAMMAR.arcs

    def close() -> None:
        nonlocal clauses, score, words, symbols
        clauses += words > 0
        if score:
            scores.append(score if symbols > 1 else score * LONE_FACTOR)
        score, words, symbols = 0.0, 0, 0

    for token in _TOKENS.finditer(text.lower()):
        word = token[1]
        if word:
            symbol, weight = lexicon.read(word, token[2] is not None)
            state, out, factor = arcs[state, symbol]
            words += 1
            symbols += symbol != "other"
            if out in _SCORED:
                score += factor * weight
        else:
            state = arcs[state, BOUNDARY][0]
            close()
    close()
    return scores, clauses


N_FEATURES = 4


def features(scores: list[float], clauses: int) -> list[float]:
    """1, all matched weight, the strongest clause, the share of clauses that match."""
    return [1.0, math.log1p(sum(scores)), min(max(scores, default=0.0), STRONGEST) / 4, len(scores) / max(clauses, 1)]


# --- learning -------------------------------------------------------------------------


def training_sample(labels: DataFrame, most: int, key: str = "doc_id", label: str = "toxic") -> DataFrame:
    """At most ``most`` labelled ids outside the held-out fifth, picked by hash."""
    usable = labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(key))
    merged = usable.groupBy(F.col(key).alias("key")).agg(F.max(label).alias("label"))
    return merged.orderBy(F.xxhash64("key"), "key").limit(most)


def held_out(key: str):
    return F.crc32(F.col(key).cast("string")) % 5 == 0


_COUNTS = "arc STRING, toxic BIGINT, clean BIGINT"


def _count_arcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each label that contain an arc, summed per task and emptied when large."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def emptied() -> pa.RecordBatch:
        names = list(counts[0].keys() | counts[1].keys())
        toxic, clean = ([c[n] for n in names] for c in (counts[1], counts[0]))
        for c in counts:
            c.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(toxic, pa.int64()), pa.array(clean, pa.int64())],
            names=["arc", "toxic", "clean"],
        )

    for batch in batches:
        for text, label in zip(batch.column("text"), batch.column("label").to_pylist()):
            words = {t[1] for t in _TOKENS.finditer((text.as_py() or "").lower()) if t[1]}
            counts[label].update({a for w in words for a in arcs_of(w)})
            if len(counts[0]) + len(counts[1]) > 150_000:
                yield emptied()
    yield emptied()


def learn_arcs(training: DataFrame) -> dict[str, float]:
    """Arc weights from rows of text and label. Collects the arcs that pass, of the bounded sample."""
    n = training.groupBy("label").count().collect()
    total = {r["label"]: r["count"] for r in n}
    n_toxic, n_clean = total.get(1, 0), total.get(0, 0)
    if not n_toxic or not n_clean:
        return {}
    counted = training.select("text", "label").mapInArrow(_count_arcs, _COUNTS)
    summed = materialize(
        counted.groupBy("arc").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b")).filter("a >= 3"), "arcs"
    )
    a, b = F.col("a"), F.col("b")
    share = (a + b) / F.lit(n_toxic + n_clean)

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    # Likelihood ratio of "this arc comes with toxic texts" against "it does not matter".
    gain = 2 * (
        part(a, share * n_toxic)
        + part(n_toxic - a, (1 - share) * n_toxic)
        + part(b, share * n_clean)
        + part(n_clean - b, (1 - share) * n_clean)
    )
    odds = F.log(((a + 0.5) / (n_toxic + 1)) / ((b + 0.5) / (n_clean + 1)))
    scored = summed.select("arc", gain.alias("gain"), odds.alias("odds"))
    # By chance the best of n arcs gains about 2 ln n.
    tried = summed.count()
    bar = 2 * math.log(max(tried, 2)) + 4
    best = scored.filter((F.col("gain") > bar) & (F.col("odds") > math.log(6)))
    return {r.arc: min(r.odds, MOST_ODDS) for r in best.collect()}


def _features_of(lexicon_weights: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = _reader(lexicon_weights)
        for batch in batches:
            rows = [read(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.list_(pa.float64())), batch.column("label")], names=["x", "label"]
            )

    return run


# Where the fit starts, and what it is drawn to: no match is clean, a match adds up.
_PRIOR = np.array([-3.0, 1.5, 1.0, 0.5])


def fit_logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray = _PRIOR, strength: float = 0.5) -> np.ndarray:
    beta = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-6)
        gradient = x.T @ (y - p) - strength * (beta - prior)
        step = np.linalg.solve((x * w[:, None]).T @ x + strength * np.eye(len(beta)), gradient)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return beta


@dataclass
class ToxicityModel:
    weights: dict[str, float]
    coefficients: list[float]

    def score(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """key and score of every row."""
        schema = f"key {docs.schema[key].dataType.simpleString()}, score DOUBLE"
        rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        return rows.mapInArrow(_scorer(self.weights, self.coefficients), schema).withColumnRenamed("key", key)

    def keep_clean(self, docs: DataFrame, text: str = "text", most: float = 0.5) -> DataFrame:
        """The rows that score less than ``most``, all columns as they are."""
        return docs.mapInArrow(_keeper(self.weights, self.coefficients, text, most), docs.schema)

    def text_score(self, text: str | None) -> float:
        return _logistic(_reader(self.weights)(text or ""), self.coefficients)


def _logistic(x: list[float], beta: list[float]) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(x, beta))))))


def _reader(weights: dict[str, float]) -> Callable[[str], list[float]]:
    """Features of a text. A text without the beginning of any scoring word is not parsed."""
    import ahocorasick

    lexicon = Lexicon(weights)
    automaton = ahocorasick.Automaton()
    for name in {w.removesuffix("$") for w in weights} | THREAT:
        automaton.add_word(name, len(name))
    automaton.make_automaton()
    nothing = features([], 1)

    def read(text: str) -> list[float]:
        low = text.lower()
        for end, n in automaton.iter(low):
            at = end - n
            if at < 0 or not (low[at].isalnum() or low[at] == "_"):
                return features(*clause_scores(text, lexicon))
        return nothing

    return read


def _scorer(weights: dict[str, float], beta: list[float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = _reader(weights)
        for batch in batches:
            scores = [_logistic(read(t.as_py() or ""), beta) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(scores, pa.float64())], names=["key", "score"])

    return run


def _keeper(weights: dict[str, float], beta: list[float], text: str, most: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = _reader(weights)
        for batch in batches:
            yield batch.filter(pa.array([_logistic(read(t.as_py() or ""), beta) < most for t in batch.column(text)], pa.bool_()))

    return run


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    most_docs: int = MAX_TRAINING_DOCS,
) -> ToxicityModel:
    """Learn from ``labels`` joined to ``docs``. At most ``most_docs`` ids are broadcast."""
    sample = F.broadcast(training_sample(labels, most_docs, key, label))
    joined = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(sample, "key")
    training = materialize(joined.select("text", F.col("label").cast("int")), "toxic-training")
    weights = learn_arcs(training)
    rows = training.mapInArrow(_features_of(weights), "x ARRAY<DOUBLE>, label INT").collect()
    if not weights:
        return ToxicityModel({}, _PRIOR.tolist())
    beta = fit_logistic(np.array([r.x for r in rows]), np.array([r["label"] for r in rows], float))
    return ToxicityModel(weights, beta.tolist())


def op2_toxic_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return model.score(docs).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
