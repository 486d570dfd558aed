"""Toxicity by a weighted finite-state pattern grammar over clauses.

Five deterministic machines read a clause token by token: insult, threat,
target, negation and reported speech. Their synchronous product is compiled
once into one table, state x token class -> state, and every insult or threat
leaves it with the context it was read in (aimed at a target, negated,
reported). The clause is scored as a whole: the mass of its hits, by context,
closed at the clause's end.

Weights are learned, never listed: words and word beginnings (stems) of
labelled documents whose presence is tied to the label become insult arcs weighted
by their log odds (likelihood ratio so large that less than one of all words
and stems seen in ``LEAST_ROWS`` rows or more would reach it by chance); the weight of
each context and the offset come from a logistic regression over the clause
totals. Function words of the four other machines are fixed lists. ``fit`` reads
at most ``MAX_LABELLED`` labelled rows (those with the smallest hash of
doc_id), and its lexicon holds at most ``MAX_ARCS`` arcs; both bounds are
parameters. Scoring covers every whole text.

Nulls and ties: a null text is scored like an empty one. A label row without
doc_id or label is unused; of several labels of one doc_id the largest counts.
Without labelled rows of both classes every score is 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.common import cut, text_chunks

MAX_LABELLED = 20_000
MAX_ARCS = 5_000
LEAST_ROWS = 3
STEMS = (4, 5, 6)

# Function words (en, de, fr, es) of the context machines.
THREAT_WORDS = "kill hurt destroy beat shoot burn töten schlagen umbringen tuer tuer frapper détruire matar golpear".split()
TARGET_WORDS = "you your yours u du dich dir dein euch ihr tu toi ton vous votre tú usted ustedes vosotros".split()
NEGATION_WORDS = "not never no n't nicht kein keine nie ne pas jamais nunca jamás ni".split()
REPORT_WORDS = "said says told wrote quoted claimed sagte sagt schrieb behauptet dit disait écrit dijo dice escribió".split()

WORD = re.compile(r"[^\W\d_]+")
CLAUSE = re.compile(r"[.!?;:\n]+")

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)


def _machines() -> list[tuple[int, callable]]:
    """(number of states, step(state, class) -> state) of the context machines."""
    target = (2, lambda s, c: 1 if c == TARGET else s)
    negation = (4, lambda s, c: 3 if c == NEGATION else max(0, s - 1))  # reaches three tokens on
    report = (2, lambda s, c: 1 if c == REPORT else s)
    return [target, negation, report]


def compile_grammar() -> tuple[list[list[int]], list[tuple[int, ...]]]:
    """The product of the machines: table[state][class] -> state, and the
    component states of each product state. State 0 opens a clause."""
    machines = _machines()
    states = list(product(*(range(n) for n, _ in machines)))
    number = {s: k for k, s in enumerate(states)}
    table = [
        [number[tuple(step(s, c) for (_, step), s in zip(machines, state))] for c in range(6)] for state in states
    ]
    return table, states


TABLE, STATES = compile_grammar()
# Context of a hit: kind (insult, threat) x negated x reported; aimed is known at the clause's end.
FEATURES = 2 * 2 * 2 * 2


@dataclass
class Grammar:
    """A fitted grammar: arcs by word and by stem, and the regression's weights."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    weights: tuple[float, ...] = (0.0,) * (FEATURES + 2)
    offset: float = -math.inf

    def __post_init__(self) -> None:
        self.seen: dict[str, tuple[int, float]] = {}
        self.plain = {w: (THREAT, 1.0) for w in THREAT_WORDS}
        for words, kind in ((TARGET_WORDS, TARGET), (NEGATION_WORDS, NEGATION), (REPORT_WORDS, REPORT)):
            self.plain |= {w: (kind, 0.0) for w in words}

    def arc(self, word: str) -> tuple[int, float]:
        """The class and weight of a (lower-case) word."""
        found = self.seen.get(word)
        if found is None:
            weight = max([self.words.get(word, 0.0), *(self.stems.get(word[:n], 0.0) for n in STEMS if len(word) > n)])
            found = (INSULT, weight) if weight > 0 else self.plain.get(word, (OTHER, 0.0))
            if len(self.seen) >= 100_000:
                self.seen.clear()
            self.seen[word] = found
        return found

    def clauses(self, text: str) -> Iterator[tuple[str, list[float]]]:
        """Matched clauses with the mass of their hits by context."""
        text = text.lower()
        arc = self.arc
        if not any(arc(w)[1] for w in set(WORD.findall(text))):
            return
        for clause in CLAUSE.split(text):
            arcs = [arc(w) for w in WORD.findall(clause)]
            if not any(weight for _, weight in arcs):
                continue
            state, mass = 0, [0.0] * (FEATURES // 2)
            for kind, weight in arcs:
                if weight:
                    _, negated, reported = STATES[state]
                    mass[(kind == THREAT) * 4 + (negated > 0) * 2 + reported] += weight
                state = TABLE[state][kind]
            aimed = STATES[state][0]
            yield clause, [0.0] * (FEATURES // 2) * aimed + mass + [0.0] * (FEATURES // 2) * (1 - aimed)

    def features(self, text: str) -> list[float]:
        """Totals over the clauses, the largest clause, and the share of matched words."""
        total, top = [0.0] * FEATURES, 0.0
        for _, mass in self.clauses(text):
            total = [a + b for a, b in zip(total, mass)]
            top = max(top, sum(mass))
        return [math.log1p(x) for x in total] + [math.log1p(top), math.log1p(sum(total))]

    def score(self, text: str) -> float:
        """0 to 1; the higher, the likelier toxic."""
        if self.offset == -math.inf:
            return 0.0
        z = self.offset + sum(w * x for w, x in zip(self.weights, self.features(text)))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def _words_of(text: str) -> set[str]:
    words = set(WORD.findall(text.lower()))
    return words | {f"{w[:n]}*" for w in words for n in STEMS if len(w) > n}


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, with label 1, with label 0) of a task's documents, pre-aggregated."""
    held: tuple[Counter, Counter] = (Counter(), Counter())

    def flush() -> pa.RecordBatch:
        names = list(held[0].keys() | held[1].keys())
        out = pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *(pa.array([c[n] for n in names], pa.int64()) for c in (held[1], held[0]))],
            ["feature", "pos", "neg"],
        )
        held[0].clear()
        held[1].clear()
        return out

    for b in text_chunks(batches):
        for text, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist()):
            held[y].update(_words_of(text or ""))
        if len(held[0]) + len(held[1]) > 400_000:
            yield flush()
    yield flush()


def _regress(x: np.ndarray, y: np.ndarray, ridge: float = 0.01, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps; the last weight is the offset."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge * len(x) / 100)
    keep[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + keep * w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(keep), grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, max_arcs: int = MAX_ARCS) -> Grammar:
    """Learn from documents (doc_id, text) and labels (doc_id, toxic)."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("y"))
        .filter("doc_id is not null and y in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_labelled)
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(F.broadcast(known), "doc_id").select("text", "y")  # max_labelled rows at most
    classes = dict(rows.groupBy("y").count().collect())
    pos, neg = classes.get(1, 0), classes.get(0, 0)
    if not pos or not neg:
        return Grammar()
    counts = rows.mapInArrow(_counted, "feature string, pos long, neg long").groupBy("feature")
    counts = cut(counts.agg(F.sum("pos").alias("a"), F.sum("neg").alias("b")).filter(F.expr("a + b") >= LEAST_ROWS))
    total, level = pos + neg, 2 * math.log(max(1, counts.count())) + 2

    def part(seen, rest):  # seen * ln(seen / expected)
        return F.when(seen > 0, seen * F.log(seen / rest)).otherwise(F.lit(0.0))

    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    inside, outside = a + b, F.lit(float(total)) - a - b
    g2 = 2 * (
        part(a, inside * pos / total)
        + part(b, inside * neg / total)
        + part(pos - a, F.greatest(outside * pos / total, F.lit(1e-9)))
        + part(neg - b, F.greatest(outside * neg / total, F.lit(1e-9)))
    )
    odds = F.log((a + 0.5) / (pos + 1.0)) - F.log((b + 0.5) / (neg + 1.0))
    arcs = counts.select("feature", g2.alias("g2"), odds.alias("odds")).filter((F.col("g2") >= level) & (F.col("odds") >= 1))
    arcs = arcs.orderBy(F.desc("g2"), "feature").limit(max_arcs).collect()  # max_arcs rows at most
    grammar = Grammar(
        {r["feature"]: r["odds"] for r in arcs if not r["feature"].endswith("*")},
        {r["feature"][:-1]: r["odds"] for r in arcs if r["feature"].endswith("*")},
    )

    def measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_chunks(batches):
            got = [grammar.features(t or "") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.list_(pa.float64())), b.column("y")], ["x", "y"])

    seen = rows.mapInArrow(measured, "x array<double>, y int")
    found = seen.groupBy("x", "y").count().orderBy("x", "y").collect()  # max_labelled rows at most
    times = [r["count"] for r in found]
    x = np.repeat(np.array([r["x"] for r in found]), times, axis=0)
    w = _regress(x, np.repeat(np.array([float(r["y"]) for r in found]), times))
    return Grammar(grammar.words, grammar.stems, tuple(w[:-1].tolist()), float(w[-1]))


def score(docs: DataFrame, grammar: Grammar, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name`` of scores (which must not exist yet)."""
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_chunks(batches):
            got = [grammar.score(t or "") for t in b.column(at).cast(pa.large_string()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.float64())], names=[*names, name])

    from pyspark.sql import types as T

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def held_out(doc_id: str = "doc_id"):
    """True for the documents that are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))
