"""Toxicity by a weighted grammar of finite-state transducers over clauses.

Words become classes: insult (learned words and word beginnings), threat, target,
negation, reported speech, other. Five transducers rewrite the classes of a clause
one after another; they are composed once into a single machine, which turns a clause
into marks: an insult that is aimed at someone, plain, negated or reported, and a
threat. A clause's marks weigh as much as the lexicon says. A logistic model, learned
from labelled rows, turns them and the length of the text into a score; no mark lowers
it, and an aimed insult counts at least as much as a plain one, that as a negated one.

A word or beginning is in the lexicon for how much more often it stands in toxic text
than elsewhere, word for word, so that one that long harmless texts hold by chance can
be learned as well. Repeats in equal surroundings, as copies have, count once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.llm.scratch import Scratch
from affinis.llm.tasks import releasing

FIT_ROWS = 20_000  # labelled rows at most that the lexicon and the model are learned from
SUPPORT = 5  # toxic texts that a word or beginning needs, counted by its first surroundings in each
LEAST_ODDS = 3.0  # log odds from which it is an insult
BEGINNINGS = (4, 5, 6, 7)
KNOWN_WORDS = 1 << 16  # words whose weight a task remembers
THRESHOLD = 0.7
ROWS_AT_ONCE = 500  # rows in one batch handed on
WORD = re.compile(r"[^\W\d_]+")
CLAUSE = re.compile(r"[.!?;:\n]+")

#: Words of the classes that are not learned, in the four languages of the texts.
THREATS = set("kill kills hurt burn shoot beat destroy töten sterben schlagen tuer mourir frapper matar morir golpear".split())
TARGETS = set("you your yours they them those people du dich dir ihr euch sie tu toi vous ils eux tú te usted ustedes ellos".split())
NEGATIONS = set("not no never nobody nicht kein keine nie niemand pas jamais aucun ne nunca jamás ningún tampoco".split())
REPORTS = set("said says wrote writes quoted called claims sagte schrieb behauptet dit écrit prétend dijo escribió afirma".split())

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = "other", "insult", "threat", "target", "negation", "report"
PLAIN, AIMED, NEGATED, REPORTED = "plain", "aimed", "negated", "reported"
CLASSES = [OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT]
MARKS = [PLAIN, AIMED, NEGATED, REPORTED, THREAT]
#: Columns of the model: each step of the ladder from negated to aimed adds to the one before. All but the length have weights of zero or more.
LADDER = [(NEGATED, PLAIN, AIMED), (PLAIN, AIMED), (AIMED,), (REPORTED,), (THREAT,)]


@dataclass(frozen=True)
class Transducer:
    """Letter by letter: arcs[state, letter] = (next state, written letter, weight). State 0 begins."""

    arcs: dict[tuple[int, str], tuple[int, str, float]]

    def run(self, letters: list[str]) -> list[tuple[str, float]]:
        state, out = 0, []
        for letter in letters:
            state, written, weight = self.arcs[state, letter]
            out.append((written, weight))
        return out


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The machine that writes what ``second`` writes on reading what ``first`` writes; weights multiply."""
    numbers, todo, arcs = {(0, 0): 0}, [(0, 0)], {}
    while todo:
        here = todo.pop()
        for (state, letter), (after, middle, weight) in first.arcs.items():
            if state != here[0] or (here[1], middle) not in second.arcs:
                continue
            beyond, written, more = second.arcs[here[1], middle]
            if (after, beyond) not in numbers:
                numbers[after, beyond] = len(numbers)
                todo.append((after, beyond))
            arcs[numbers[here], letter] = (numbers[after, beyond], written, weight * more)
    return Transducer(arcs)


def marking(trigger: str, subject: str, mark: str, reach: int | None, alphabet: list[str], weight: float = 1.0) -> Transducer:
    """Rewrites ``subject`` as ``mark`` if ``trigger`` came up to ``reach`` words before it (None: anywhere before)."""
    far = 1 if reach is None else reach
    arcs = {}
    for state in range(far + 1):
        for letter in alphabet:
            fade = state if reach is None else max(0, state - 1)
            after = far if letter == trigger else fade
            arcs[state, letter] = (after, mark if state and letter == subject else letter, weight if state and letter == subject else 1.0)
    return Transducer(arcs)


def grammar() -> Transducer:
    """Reported speech, then negation, then targets; an insult that none of them marks is plain."""
    letters = list(CLASSES)
    machine = marking(REPORT, INSULT, REPORTED, None, letters)
    for trigger, mark, reach in ((NEGATION, NEGATED, 3), (TARGET, AIMED, 4)):
        letters.append(REPORTED if mark == NEGATED else NEGATED)
        machine = compose(machine, marking(trigger, INSULT, mark, reach, letters))
    letters.append(AIMED)
    # A threat needs a target before it; a lone word of that kind says nothing.
    aimed_threat = "aimed threat"
    machine = compose(machine, marking(TARGET, THREAT, aimed_threat, 6, letters))
    last = {(0, x): (0, OTHER, 0.0) for x in letters}
    last |= {(0, x): (0, x, 1.0) for x in (AIMED, NEGATED, REPORTED)}
    last |= {(0, INSULT): (0, PLAIN, 1.0), (0, aimed_threat): (0, THREAT, 1.0)}
    return compose(machine, Transducer(last))


GRAMMAR = grammar()


def features_of(word: str) -> list[str]:
    return [word, *(f"{word[:k]}*" for k in BEGINNINGS if len(word) > k)]


class Lexicon:
    def __init__(self, odds: dict[str, float]):
        self.odds = odds
        self.weight = lru_cache(KNOWN_WORDS)(self._weight)

    def _weight(self, word: str) -> float:
        return max((self.odds.get(f, 0.0) for f in features_of(word)), default=0.0)

    def class_of(self, word: str) -> str:
        if self.weight(word) > 0:
            return INSULT
        for name, words in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)):
            if word in words:
                return name
        return OTHER

    def marks(self, text: str | None) -> np.ndarray:
        """What the marks of each step of the ladder weigh in the text, and its length, as logarithms."""
        weights = dict.fromkeys(MARKS, 0.0)
        low = (text or "").lower()
        found = WORD.findall(low)
        calls = {w for w in set(found) if w in THREATS or self.weight(w) > 0}
        for clause in CLAUSE.split(low) if calls else ():
            words = WORD.findall(clause)
            if calls.isdisjoint(words):
                continue
            for word, (mark, weight) in zip(words, GRAMMAR.run([self.class_of(w) for w in words]), strict=True):
                if weight:
                    weights[mark] += weight * (self.weight(word) or LEAST_ODDS)
        return np.log1p([*(sum(weights[m] for m in step) for step in LADDER), len(found) / 100])


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    weights: list[float]  # of the ladder, the length, and a constant

    def score(self, marks: np.ndarray) -> float:
        z = float(np.append(marks, 1.0) @ np.asarray(self.weights))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learning_rows(docs: DataFrame, labels: DataFrame, scratch: Scratch, rows: int = FIT_ROWS) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled rows that are not held out, drawn by a hash of the id."""
    known = labels.filter("doc_id is not null and toxic is not null").filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, 0.9 * rows / max(1, known.count()))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).limit(rows)
    return scratch.written(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic"), "learning")


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, about, first): a word's features with its neighbours, and whether no earlier word of the text has the feature."""
    seen: dict[tuple[str, str], int] = {}

    def handed() -> pa.RecordBatch:
        columns = [pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.string()), pa.array(list(seen.values()), pa.int32())]
        seen.clear()
        return pa.RecordBatch.from_arrays(columns, names=["feature", "about", "first"])

    for batch in batches:
        for text in batch.column("text"):
            words, met = ["", *WORD.findall((text.as_py() or "").lower()), ""], set()
            for i in range(1, len(words) - 1):
                about = f"{words[i - 1]} {words[i + 1]}"
                for feature in features_of(words[i]):
                    seen[feature, about] = max(seen.get((feature, about), 0), int(feature not in met))
                    met.add(feature)
                if len(seen) > 50_000:
                    yield handed()
    yield handed()


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, rows, words) of each batch's texts."""
    for batch in batches:
        words = pa.array([len(WORD.findall((t.as_py() or "").lower())) for t in batch.column("text")], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array([1] * len(words), pa.int64()), words], names=["toxic", "rows", "words"])


def _occurrences(wanted):
    """(feature, n): how often each wanted feature stands in the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = wanted.value, Counter()
        for batch in batches:
            for text in batch.column("text"):
                total.update(f for w in WORD.findall((text.as_py() or "").lower()) for f in features_of(w) if f in known)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["feature", "n"])

    return run


def _marks_of(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(sent.value)
        for batch in batches:
            marks = [lexicon.marks(t.as_py()).tolist() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(marks, pa.list_(pa.float64()))], names=["toxic", "marks"])

    return run


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic model with a constant, by Newton's method with a small ridge."""
    x = np.column_stack([x, np.ones(len(x))])
    w, keep = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def rising(x: np.ndarray, y: np.ndarray, free: int) -> np.ndarray:
    """A logistic model whose weights are zero or more, but for column ``free`` and the constant.

    The column with the lowest weight below zero is left out, until none has such a weight.
    """
    columns = list(range(x.shape[1]))
    while True:
        fitted = logistic(x[:, columns], y)
        below = [(w, c) for w, c in zip(fitted[:-1], columns, strict=True) if w < 0 and c != free]
        if not below:
            break
        columns.remove(min(below)[1])
    weights = np.zeros(x.shape[1] + 1)
    weights[[*columns, -1]] = fitted
    return weights


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, scratch: Scratch | None = None) -> Model:
    """Learn the lexicon and the weights from labelled rows that are not held out.

    Only ``rows`` bounds the sample. Without a label of either kind the model has an
    empty lexicon and scores every text with the share of toxic labels (0 if none).
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "toxicity")
    sample = learning_rows(docs, labels, scratch, rows).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    totals = sample.mapInArrow(releasing(_sizes), "toxic int, rows long, words long").groupBy("toxic").agg(F.sum("rows").alias("rows"), F.sum("words").alias("words"))
    sizes = {r.toxic: r for r in totals.collect()}
    if 0 not in sizes or 1 not in sizes:
        rate = min(max(float(1 in sizes), 1e-9), 1 - 1e-9)
        return Model({}, [0.0] * (len(LADDER) + 1) + [float(np.log(rate / (1 - rate)))])
    offers = (
        sample.filter("toxic = 1")
        .mapInArrow(releasing(_surroundings), "feature string, about string, first int")
        .groupBy("feature", "about")
        .agg(F.max("first").alias("first"))
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("first").alias("texts"))
        .filter(F.col("texts") >= SUPPORT)
        .collect()
    )
    wanted = spark.sparkContext.broadcast({r.feature for r in offers})
    harmless = sample.filter("toxic = 0").mapInArrow(releasing(_occurrences(wanted)), "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    elsewhere = {r.feature: r.n for r in harmless.collect()}
    odds = {
        r.feature: float(np.log((r.n + 0.5) / max(1, sizes[1].words)) - np.log((elsewhere.get(r.feature, 0) + 1) / max(1, sizes[0].words))) for r in offers
    }
    lexicon = {f: o for f, o in odds.items() if o >= LEAST_ODDS}
    marked = sample.mapInArrow(releasing(_marks_of(spark.sparkContext.broadcast(lexicon))), "toxic int, marks array<double>").collect()
    weights = rising(np.array([r.marks for r in marked]), np.array([r.toxic for r in marked], float), len(LADDER))
    return Model(lexicon, weights.tolist())


def _scores(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        lexicon = Lexicon(model.lexicon)
        for batch in batches:
            scores = [model.score(lexicon.marks(t.as_py())) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return run


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row; the whole text is read. A null text scores like an empty one.

    Repeated rows and null ids stay one row each; other columns are ignored.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(releasing(_scores(sent)), f"doc_id {id_type}, score double")


def predicted(threshold: float = THRESHOLD) -> Column:
    return (F.col("score") >= threshold).cast("int")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with all their columns.

    A null text scores like an empty one; repeated rows stay or go together; null ids and
    other columns pass unchanged. Without documents or labels nothing goes.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.value.lexicon)
        for whole in batches:
            for first in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(first, ROWS_AT_ONCE)
                yield batch.filter(pa.array([model.value.score(lexicon.marks(t.as_py())) < threshold for t in batch.column("text")], pa.bool_()))

    return docs.mapInArrow(releasing(run), schema)
