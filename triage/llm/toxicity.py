"""Toxicity by a weighted finite-state pattern grammar.

A text is cut into clauses at sentence marks and line ends, and each word is
put into a class: insult (with a weight), target, negation, reported speech,
intent, violence, or other. Five transducers read the classes of a clause:

* *insult* passes a word's weight on,
* *target* raises it after a person that is addressed or spoken of,
* *negation* lowers it in the words after a negation,
* *report* lowers it after a verb of speech, to the clause's end,
* *threat* raises violence after a statement of intent and lowers it else.

They are composed once into one machine (states are tuples of states, arc
factors multiply), and the machine is run over the clauses that hold an insult
or violence: a clause's score is the sum of its arcs, so that words count by
the clause they stand in. A document's score is a logistic function of its
clause scores (largest, sum, number of clauses, share of words).

Learned from at most about ``SAMPLE_ROWS`` labelled rows outside the held-out
fold, near copies counted once: the insult lexicon (words and word beginnings
that are far more frequent in toxic texts, with their log-odds as weights) and
the logistic function. The class words of the other transducers are fixed.
The lexicon is bounded (``LEXICON``) and broadcast; scoring is one pass
without a shuffle.

Defined results: null, empty and wordless texts, and texts without a matched
clause, have the score of no match; without labelled rows of both classes the
lexicon is empty and every score is the share of toxic rows (0 without rows).
Ids, labels, language and source are never read for a score.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triage.llm import words as W
from triage.llm.common import bound_batches, labelled_sample, written

SAMPLE_ROWS = 12_000
LEXICON = 4_096
PREFIXES = (4, 5, 6)
#: a lexicon entry is this many times as frequent in toxic texts, and in this share of them
LIFT, SUPPORT, LEAST = 25.0, 0.01, 3

OTHER, INSULT, TARGET, NEGATION, REPORT, INTENT, VIOLENCE = range(7)
#: fixed values: the class words (English, German, French, Spanish)
CLASS_WORDS = {
    TARGET: "you your yours u he she they him her them these those people everyone du dich dir ihr euch sie er man "
            "tu toi te vous il elle ils eux tú ti usted ustedes ellos ella él",
    NEGATION: "not no never neither nor without isn aren wasn don doesn didn won wouldn nicht kein keine nie niemals ohne "
              "pas jamais aucun aucune sans ni nunca jamás sin tampoco",
    REPORT: "said says say told tell wrote writes quote quoted quotes claimed claims reported called sagte sagt schrieb "
            "zitiert dit disait écrit cite dijo dice escribió cita",
    INTENT: "will ll shall going gonna must should want werde werden will wird soll vais va vas veux dois voy vas quiero debes",
    VIOLENCE: "kill hurt destroy beat burn shoot stab murder crush attack hang töten schlagen verbrennen vernichten "
              "tuer frapper brûler détruire matar golpear quemar destruir",
}
VIOLENCE_WEIGHT = 1.5


@dataclass
class Transducer:
    """From each state and class: the next state and the arc's factor."""

    states: int
    arcs: dict[tuple[int, int], tuple[int, float]]

    def then(self, other: Transducer) -> Transducer:
        """The composition: reads the same classes, factors multiply."""
        pair = lambda a, b: a * other.states + b
        arcs = {}
        for a, b, c in itertools.product(range(self.states), range(other.states), range(7)):
            (na, fa), (nb, fb) = self.arcs[a, c], other.arcs[b, c]
            arcs[pair(a, b), c] = (pair(na, nb), fa * fb)
        return Transducer(self.states * other.states, arcs)


def scope(opened_by: int, length: int | None, inside: dict[int, float], outside: dict[int, float]) -> Transducer:
    """State 0, and ``length`` states after a word of a class, one for each
    word that the scope still lasts (None: to the clause's end)."""
    states, arcs = (length or 1) + 1, {}
    for s in range(states):
        for c in range(7):
            after = states - 1 if c == opened_by else s if length is None else max(0, s - 1)
            arcs[s, c] = (after, (inside if s else outside).get(c, 1.0))
    return Transducer(states, arcs)


def grammar() -> Transducer:
    insult = Transducer(1, {(0, c): (0, 1.0 if c in (INSULT, VIOLENCE) else 0.0) for c in range(7)})
    target = scope(TARGET, 5, {INSULT: 1.3, VIOLENCE: 1.3}, {})
    negation = scope(NEGATION, 3, {INSULT: 0.4, VIOLENCE: 0.3}, {})
    report = scope(REPORT, None, {INSULT: 0.6, VIOLENCE: 0.5}, {})
    threat = scope(INTENT, 4, {VIOLENCE: 1.5}, {VIOLENCE: 0.2})
    return insult.then(target).then(negation).then(report).then(threat)


def span_hash(words: list[str]) -> np.ndarray:
    """Hashes of words as in a text."""
    cp = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(w) for w in words])
    return W.hashes(cp, ends - np.array([len(w) for w in words]), ends)


class Words:
    """The words (runs of letters) of a column's texts."""

    def __init__(self, col: pa.Array):
        self.data, off = W.code_points(col)
        self.ws = W.runs(W.letters()[self.data], off)
        self.n = len(off) - 1
        self.text = self.ws.text_of()
        self.hash = W.hashes(self.data, self.ws.starts, self.ws.ends)

    def prefix(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Words longer than k, and hashes of their first k characters."""
        at = np.flatnonzero(self.ws.ends - self.ws.starts > k)
        s = self.ws.starts[at]
        return at, W.mix(W.hashes(self.data, s, s + k) + W.U64(k))

    def clauses(self) -> np.ndarray:
        """A number for each word's clause."""
        mark = np.isin(self.data, np.frombuffer(".!?;\n\0".encode("utf-32-le"), np.uint32))
        return np.cumsum(mark)[self.ws.starts] if len(self.ws.starts) else np.zeros(0, np.int64)

    def features(self) -> list[np.ndarray]:
        """The distinct hashed words and beginnings of each text."""
        h, t = [self.hash], [self.text]
        for k in PREFIXES:
            at, p = self.prefix(k)
            h.append(p)
            t.append(self.text[at])
        h, t = np.concatenate(h), np.concatenate(t)
        order = np.argsort(t, kind="stable")
        bounds = np.searchsorted(t[order], np.arange(self.n + 1))
        return [np.unique(h[order[a:b]]) for a, b in zip(bounds[:-1], bounds[1:])]


class Scorer:
    """The lexicon, the composed machine and the logistic function."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, machine: Transducer):
        self.keys, self.weights = keys, weights
        pairs = [(h, c) for c, ws in CLASS_WORDS.items() for h in span_hash(sorted(set(ws.split()))).tolist()]
        self.class_keys = np.array([p[0] for p in pairs], np.uint64)
        order = np.argsort(self.class_keys, kind="stable")
        self.class_keys, self.class_of = self.class_keys[order], np.array([p[1] for p in pairs], np.int8)[order]
        self.to = [[machine.arcs[s, c] for c in range(7)] for s in range(machine.states)]
        self.fitted, self.rest = None, 0.0

    def lookup(self, h: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(h))
        i = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return np.where(self.keys[i] == h, self.weights[i], 0.0)

    def matches(self, col: pa.Array) -> tuple[Words, list[tuple[int, int, int, float]]]:
        """(text, first word, end word, score) of each matched clause."""
        w = Words(col)
        weight = self.lookup(w.hash)
        for k in PREFIXES:
            at, p = w.prefix(k)
            weight[at] = np.maximum(weight[at], self.lookup(p))
        i = np.minimum(np.searchsorted(self.class_keys, w.hash), len(self.class_keys) - 1)
        kind = np.where(self.class_keys[i] == w.hash, self.class_of[i], OTHER)
        kind = np.where(weight > 0, INSULT, kind)
        weight = np.where(kind == VIOLENCE, VIOLENCE_WEIGHT, weight)
        clause = w.clauses()
        out = []
        for c in np.unique(clause[(kind == INSULT) | (kind == VIOLENCE)]):
            a, b = np.searchsorted(clause, [c, c + 1])
            state, score = 0, 0.0
            for k, x in zip(kind[a:b].tolist(), weight[a:b].tolist()):
                state, factor = self.to[state][k]
                score += factor * x
            if score > 0:
                out.append((int(w.text[a]), int(a - w.ws.bounds[w.text[a]]), int(b - w.ws.bounds[w.text[a]]), score))
        return w, out

    def features(self, col: pa.Array) -> tuple[np.ndarray, list]:
        w, found = self.matches(col)
        x = np.zeros((w.n, 4))
        for t, _, _, s in found:
            x[t] += (0, s, 1, 0)
            x[t, 0] = max(x[t, 0], s)
        words = np.maximum(np.diff(w.ws.bounds), 1)
        return np.stack([np.minimum(x[:, 0], 10), np.log1p(x[:, 1]), np.log1p(x[:, 2]), np.log1p(100 * x[:, 1] / words)], axis=1), found

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.fitted is None:
            return np.full(len(x), self.rest)
        return 1 / (1 + np.exp(-np.clip(self.fitted[0] + x @ self.fitted[1:], -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton's method for a ridge logistic regression."""
    x = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        grad = x.T @ (p - y) + ridge * b * (np.arange(len(b)) > 0)
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b))
        b = b - np.linalg.solve(hess, grad)
    return b


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, held_out: int = 0,
        text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> Scorer:
    spark = docs.sparkSession
    bound_batches(spark)
    rows = labelled_sample(docs, labels, label, folds, held_out, sample_rows).select(F.col(text_col).alias("_text"), "_y")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in W.pieces(whole, "_text"):
                f = Words(W.column(b, "_text")).features()
                # near copies have the same least hashes
                sketch = [int(x[:3].sum(dtype=np.uint64).view(np.int64)) if len(x) else 0 for x in f]
                yield pa.RecordBatch.from_arrays([W.column(b, "_text"), W.column(b, "_y"), pa.array(sketch, pa.int64()),
                                                  pa.array([x.view(np.int64) for x in f], pa.list_(pa.int64()))], ["text", "y", "sketch", "features"])

    sample = written(rows.mapInArrow(extract, "text string, y int, sketch bigint, features array<bigint>")
                     .dropDuplicates(["sketch", "y"]), "toxicity-sample")
    n = {r.y: r.n for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    bad, good = n.get(1, 0), n.get(0, 0)
    scorer = Scorer(np.zeros(0, np.uint64), np.zeros(0), grammar())
    scorer.rest = bad / max(bad + good, 1)
    if not bad or not good:
        return scorer
    count = lambda y: sample.where(F.col("y") == y).select(F.explode("features").alias("h")).groupBy("h").agg(F.count("*").alias("n"))
    frequent = count(1).where(F.col("n") >= max(LEAST, int(SUPPORT * bad)))
    clean = (sample.where("y = 0").select(F.explode("features").alias("h")).join(frequent.select("h"), "h", "left_semi")
             .groupBy("h").agg(F.count("*").alias("m")))
    odds = (F.col("n") + 0.5) / bad / ((F.coalesce("m", F.lit(0)) + 0.5) / good)
    entries = (frequent.join(clean, "h", "left").withColumn("odds", odds).where(F.col("odds") >= LIFT)
               .orderBy(F.desc("n"), "h").limit(LEXICON).select("h", "odds").collect())
    keys = np.array([e.h for e in entries], np.int64).view(np.uint64)
    order = np.argsort(keys)
    scorer.keys, scorer.weights = keys[order], np.log(np.array([e.odds for e in entries]))[order]
    shared = spark.sparkContext.broadcast(scorer)

    def observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in W.pieces(whole, "text"):
                x, _ = shared.value.features(W.column(b, "text"))
                yield pa.RecordBatch.from_arrays([W.column(b, "y"), *(pa.array(c) for c in x.T)], ["y", "a", "b", "c", "d"])

    seen = sample.select("y", "text").mapInArrow(observe, "y int, a double, b double, c double, d double").toArrow()  # the bounded sample
    x = np.stack([seen[c].to_numpy() for c in "abcd"], axis=1)
    scorer.fitted = logistic(x, seen["y"].to_numpy().astype(float))
    return scorer


CLAUSES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
OUT = ("toxic_score", "toxic_clauses")


def score(docs: DataFrame, scorer: Scorer, text_col: str = "text") -> DataFrame:
    """``docs`` with ``toxic_score`` and ``toxic_clauses`` (first and end word
    of each matched clause, counted in letter runs, and its score)."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    kept = [f for f in docs.schema.fields if f.name not in OUT]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in W.pieces(whole, text_col, 1 << 20):
                x, found = shared.value.features(W.column(b, text_col))
                clauses: list[list] = [[] for _ in range(b.num_rows)]
                for t, first, end, s in found:
                    clauses[t].append({"start": first, "end": end, "score": s})
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shared.value.probability(x)), pa.array(clauses, CLAUSES)],
                                                 [*(f.name for f in kept), *OUT])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "toxic_score double",
                        "toxic_clauses array<struct<start:int,end:int,score:double>>"])
    return docs.select(*(F.col(f"`{f.name}`") for f in kept)).mapInArrow(run, schema)
