"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words become categories: insult, threat, target, negation, report, or other.  Insult terminals are words
and word beginnings: a short fixed list and those that the labelled rows of the training folds single out.
Sequential transducers with weighted arcs read each clause that holds an insult or a threat.  They are composed, the
output tape of one is the input tape of the next: INSULTING and THREATENING join the words of one match; LED_BY
(from the end) and AIMING (from the front) attach targets; NEGATING flips what a negation reaches; QUOTING marks
reported speech.  What comes out are the matches of a clause, each of one of six kinds, and the weight of the path.
A document's counts of kinds and its summed weight, scaled by logistic regression on the training sample, give its
score.  Words outside matched clauses never count.

Defined results: null text counts as empty; texts without a matched clause all get the same base score;
without labelled rows the fixed list works with fixed weights; of terms of equal evidence those with the smaller hashes
are learned; repeated rows repeat their score; texts of any length are read whole; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .shared import small_batches
from .quality_knn import labelled_sample

#: Labelled rows that the grammar is fitted on at most, and learned terminals at most.
MAX_LABELLED, MAX_TERMS = 8000, 4096
#: Evidence (n times the divergence of a word's toxic share from the base rate, in nats) that makes a word an insult.
EVIDENCE, PRECISION = 16.0, 0.75
#: Byte lengths of word beginnings that may be learned as terminals.
BEGINNINGS = (4, 5, 6, 7)
# The word lists of the grammar.
INSULTS = ("idiot", "moron", "stupid", "loser", "worthless", "pathetic", "disgusting", "clown", "scum", "trash")
THREATS = ("kill", "hurt", "destroy", "beat", "smash", "punish", "shoot", "burn", "die")
TARGETS = ("you", "your", "he", "she", "they", "them", "people", "everyone", "du", "ihr", "sie", "tu", "vous", "toi", "usted", "ustedes", "ellos")
NEGATIONS = ("not", "no", "never", "without", "isn't", "aren't", "nicht", "kein", "keine", "nie", "pas", "jamais", "sans", "nunca", "sin")
REPORTS = ("said", "says", "wrote", "called", "quoted", "reported", "claims", "sagte", "schrieb", "dit", "dijo")
INSULT, THREAT, TARGET, NEGATION, REPORT = 1, 2, 3, 4, 5
#: Kinds of matches: bare insult, insult at a target, bare threat, threat at a target, negated, reported.
KINDS = 6
#: Words after a negation that it reaches.
REACH = 3
_END = np.zeros(256, bool)
_END[list(b".,;:!?\n|")] = True


class Transducer:
    """A sequential weighted finite-state transducer.

    An arc (state, symbol) -> (state, output, weight); a symbol without an arc of its own is passed on unchanged
    and leads to the state's home.
    """

    def __init__(self, arcs: dict[tuple, tuple], home: dict | None = None):
        self.arcs, self.home = arcs, home or {}

    def arc(self, state, symbol) -> tuple:
        return self.arcs.get((state, symbol)) or (self.home.get(state, state), symbol, 0.0)

    def __rshift__(self, then: "Transducer") -> "Transducer":
        """The composition: the output tape of this machine is the input tape of the next one; weights add up."""
        arcs, todo, seen = {}, [(0, 0)], {(0, 0)}
        while todo:
            p, q = todo.pop()
            for symbol in SYMBOLS:
                p2, out, w = self.arc(p, symbol)
                q2, out, v = then.arc(q, out)
                arcs[(p, q), symbol] = ((p2, q2), out, w + v)
                if (p2, q2) not in seen:
                    seen.add((p2, q2))
                    todo.append((p2, q2))
        names = {s: k for k, s in enumerate(sorted(seen, key=lambda s: (s != (0, 0), str(s))))}
        return Transducer({(names[s], c): (names[t], out, w) for (s, c), (t, out, w) in arcs.items()})

    def read(self, tape: list[int]) -> tuple[list[int], float]:
        """The output tape and the weight of the path."""
        state, out, weight = 0, [], 0.0
        for symbol in tape:
            state, made, w = self.arc(state, symbol)
            out.append(made)
            weight += w
        return out, weight


OTHER = 0
#: Symbols of the inner tapes: hits with a target behind them, hits with a target on either side, negated and reported hits.
LED, AIMED, NEGATED, QUOTED = 6, 8, 10, 11
SYMBOLS = range(12)
HITS = (INSULT, THREAT)
#: Weights of the arcs: what each machine adds to the log odds of the clause it reads.
BARE_INSULT, BARE_THREAT, AIM, NEGATION_WEIGHT, QUOTE_WEIGHT = 1.0, 0.5, 0.5, -1.5, -0.8
#: Repeated words of one insult, or of one threat, are one match.
INSULTING = Transducer({(0, INSULT): (1, INSULT, BARE_INSULT), (1, INSULT): (1, OTHER, 0.0)}, {1: 0})
THREATENING = Transducer({(0, THREAT): (1, THREAT, BARE_THREAT), (1, THREAT): (1, OTHER, 0.0)}, {1: 0})
#: Reads a clause from its end: hits that a target follows.
LED_BY = Transducer({(0, TARGET): (1, TARGET, 0.0)} | {(1, h): (1, LED + h - 1, AIM) for h in HITS})
#: Reads from the front: hits with a target before them, or behind.
AIMING = Transducer({(0, TARGET): (1, TARGET, 0.0)} | {(s, LED + h - 1): (s, AIMED + h - 1, 0.0) for h in HITS for s in (0, 1)} | {(1, h): (1, AIMED + h - 1, AIM) for h in HITS})
_MATCHES = (*HITS, *(AIMED + h - 1 for h in HITS))
#: State: words that the last negation still reaches.
NEGATING = Transducer({(s, NEGATION): (REACH, NEGATION, 0.0) for s in range(REACH + 1)} | {(s, m): (s - 1, NEGATED, NEGATION_WEIGHT) for s in range(1, REACH + 1) for m in _MATCHES}, {s: max(0, s - 1) for s in range(REACH + 1)})
#: Reads on after reported speech began, in this clause or the one before.
QUOTING = Transducer({(0, REPORT): (1, REPORT, 0.0)} | {(1, m): (1, QUOTED, QUOTE_WEIGHT) for m in _MATCHES})
#: The front-to-back half of the grammar, composed into one machine.
FORWARD = INSULTING >> THREATENING
CLAUSE = AIMING >> NEGATING >> QUOTING
KIND_OF = {INSULT: 0, AIMED + INSULT - 1: 1, THREAT: 2, AIMED + THREAT - 1: 3, NEGATED: 4, QUOTED: 5}


def read_clause(clause: list[int], reported_before: bool) -> tuple[list[int], float]:
    """(kinds of the matches of one clause, its weight by the arcs)."""
    once, w1 = FORWARD.read(clause)
    led, w2 = LED_BY.read(once[::-1])
    # what was reported before the clause is a report at its front
    out, w3 = CLAUSE.read(([REPORT] if reported_before else []) + led[::-1])
    return [KIND_OF[c] for c in out if c in KIND_OF], w1 + w2 + w3


def hashes_of(words: tuple[str, ...]) -> np.ndarray:
    data, off = next((d, o) for _, d, o in tx.slices(pa.array([" ".join(words)])))
    return np.sort(tx.words(data, off, tx.BLANKS)[0])


def member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


def beginnings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(word numbers, hashes) of the whole words and of their beginnings; the lengths never clash."""
    prefix = tx.Prefix(data)
    out = [(np.arange(len(start)), prefix.spans(start, end))]
    for n in BEGINNINGS:
        at = np.flatnonzero(end - start > n)
        out.append((at, tx.mix(prefix.spans(start[at], start[at] + n) + np.uint64(n))))
    return out


def learn_terms(sample: DataFrame, base: float) -> np.ndarray:
    """Hashes of words and beginnings whose documents are toxic far above the base rate."""

    def count(batches: Iterator[pa.RecordBatch], among=None) -> Iterator[pa.RecordBatch]:
        """(term, documents of the slice that hold it)"""
        for batch in batches:
            for _, data, off in tx.slices(batch.column("text")):
                start, end, first = tx.spans(data, off, tx.ALNUM)
                doc = np.repeat(np.arange(len(off) - 1), np.diff(first)).astype(np.uint64)
                found = beginnings(tx.LOWER[data], start, end)
                h, d = np.concatenate([h for _, h in found]), np.concatenate([doc[at] for at, _ in found])
                if among is not None:
                    here = member(h, among.value)
                    h, d = h[here], d[here]
                order = np.lexsort((d, h))
                h, d = h[order], d[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
                term, n = np.unique(h[new], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n)], names=["term", "n"])

    bad = sample.where("y = 1").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).where("n >= 5")
    bad = bad.orderBy(F.desc("n"), "term").limit(40 * MAX_TERMS).toArrow()
    order = np.argsort(bad["term"].to_numpy().view(np.uint64))
    terms, toxic = bad["term"].to_numpy().view(np.uint64)[order], bad["n"].to_numpy()[order]
    known = sample.sparkSession.sparkContext.broadcast(terms)
    good = sample.where("y = 0").mapInArrow(lambda batches: count(batches, known), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    n = toxic.astype(float)
    n[np.searchsorted(terms, good["term"].to_numpy().view(np.uint64))] += good["n"].to_numpy()
    share = toxic / np.maximum(n, 1)
    s, b = np.clip(share, 1e-6, 1 - 1e-6), min(max(base, 1e-3), 0.5)
    evidence = n * (s * np.log(s / b) + (1 - s) * np.log((1 - s) / (1 - b)))
    keep = (share >= PRECISION) & (evidence >= EVIDENCE)
    best = np.argsort(-evidence[keep], kind="stable")[:MAX_TERMS]
    return np.sort(terms[keep][best])


class Grammar:
    def __init__(self, learned: np.ndarray):
        self.insults = np.unique(np.concatenate([hashes_of(INSULTS), learned]))
        self.words = [(THREAT, hashes_of(THREATS)), (TARGET, hashes_of(TARGETS)), (NEGATION, hashes_of(NEGATIONS)), (REPORT, hashes_of(REPORTS))]

    def kinds(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """documents x counts of the KINDS of matches."""
        return self.matches(data, off)[:, :KINDS]

    def matches(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """documents x (counts of the KINDS of matches, summed weight of the matched clauses)."""
        out = np.zeros((len(off) - 1, KINDS + 1))
        start, end, first = tx.spans(data, off, tx.ALNUM)
        category = np.zeros(len(start), np.uint8)
        all_ = beginnings(tx.LOWER[data], start, end)
        for at, h in all_[::-1]:
            category[at[member(h, self.insults)]] = INSULT
        for c, known in self.words:
            category[(category == 0) & member(all_[0][1], known)] = c
        hits = np.flatnonzero((category == INSULT) | (category == THREAT))
        if not len(hits):
            return out
        doc = np.searchsorted(first, hits, "right") - 1
        ends = np.concatenate([[0], np.cumsum(_END[data])])
        opens = np.zeros(len(start), bool)  # words that open a clause
        opens[1:] = ends[start[1:]] > ends[end[:-1]]
        opens[first[:-1][np.diff(first) > 0]] = True
        clause = np.cumsum(opens)
        begin = np.flatnonzero(opens)
        done = -1
        for h, d in zip(hits.tolist(), doc.tolist(), strict=True):
            k = int(clause[h]) - 1
            if k == done:
                continue
            done = k
            a, b = int(begin[k]), int(begin[k + 1]) if k + 1 < len(begin) else len(start)
            before = category[begin[k - 1] : a] if k and begin[k - 1] >= first[d] else category[:0]
            kinds, weight = read_clause(category[a:b].tolist(), bool((before == REPORT).any()))
            for kind in kinds:
                out[d, kind] += 1
            out[d, KINDS] += weight
        return out


def features(kinds: np.ndarray) -> np.ndarray:
    weight = kinds[:, KINDS:]
    return np.hstack([np.ones((len(kinds), 1)), np.log1p(kinds[:, :KINDS]), (kinds[:, :4].sum(1, keepdims=True) > 0), np.sign(weight) * np.log1p(np.abs(weight))])


DEFAULT_WEIGHTS = np.array([-2.0, 1.0, 1.5, 0.5, 2.0, -0.5, 0.2, 2.0, 0.2])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> tuple[Grammar, np.ndarray]:
    """The grammar and the weights of its kinds, from the bounded sample of the training folds."""
    from .shared import materialize

    sample = materialize(labelled_sample(docs, labels, "toxic", limit), "toxicity-sample")
    seen = sample.agg(F.count("*").alias("n"), F.avg("y").alias("base")).first()
    if not seen["n"] or not 0 < seen["base"] < 1:
        return Grammar(np.zeros(0, np.uint64)), DEFAULT_WEIGHTS
    grammar = Grammar(learn_terms(sample, seen["base"]))
    shared = docs.sparkSession.sparkContext.broadcast(grammar)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, off in tx.slices(batch.column("text")):
                got = shared.value.matches(data, off)
                yield pa.RecordBatch.from_arrays([batch.column("y").slice(row, len(got)), pa.array(list(got), pa.list_(pa.float64()))], names=["y", "kinds"])

    rows = sample.mapInArrow(count, "y int, kinds array<double>").groupBy("y", "kinds").agg(F.count("*").alias("n")).orderBy("y", "kinds").collect()
    x = np.repeat(features(np.array([r["kinds"] for r in rows])), [r["n"] for r in rows], axis=0)
    y = np.repeat(np.array([r["y"] for r in rows], float), [r["n"] for r in rows])
    return grammar, logistic(x, y)


def toxicity_scores(docs: DataFrame, labels: DataFrame, labelled_docs: DataFrame | None = None, limit: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, score, kinds, weight) of every row of docs; kinds counts its matches, weight sums its matched clauses."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs if labelled_docs is None else labelled_docs, labels, limit))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, weights = shared.value
        for batch in batches:
            for row, data, off in tx.slices(batch.column("text")):
                kinds = grammar.matches(data, off)
                p = 1 / (1 + np.exp(-np.clip(features(kinds) @ weights, -30, 30)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(row, len(p)), pa.array(p), pa.array(list(kinds[:, :KINDS].astype(np.int64)), pa.list_(pa.int64())), pa.array(kinds[:, KINDS])], names=["doc_id", "score", "kinds", "weight"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    small_batches(docs.sparkSession)
    return rows.mapInArrow(score, "doc_id long, score double, kinds array<long>, weight double")
