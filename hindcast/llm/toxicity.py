"""Toxicity by weak supervision: many voters, a generative model of them, a linear classifier.

Terms (words and beginnings of words) that labelled toxic texts hold far more often than others are
dealt to lexicons; each lexicon is a voter that fires where a text holds one of its terms. Patterns
(shouting, strings of marks, drawn-out letters) are voters too. How often each combination of votes
occurs among all documents is a table of at most 2^voters rows, and all that the label model needs:
a hidden class, each voter's accuracy given the class, and correlations as a forest in which a voter
depends on one other voter besides the class. Expectation maximisation fits it, from accuracies
counted on labelled rows, which keep their label throughout; the forest is the heaviest one by
mutual information given the class. The posterior of a document's votes, updated by the labelled
rows with the same votes, is its training label: a logistic regression over all terms, also those
too weak to vote, and patterns is fitted to it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindcast.llm.common import Scratch, column_or_null, sliced, texts, training_side

#: Bytes of a word's beginning that count as a term.
STEM = 5
#: Lexicons of whole words and of beginnings.
WORD_LEXICONS, STEM_LEXICONS = 8, 4
#: Three words in capitals in a row; marks in a row; a letter four times in a row.
PATTERNS = (
    re.compile(rb"(?:\b[A-Z]{3,}\b[^A-Za-z]+){3}"),
    re.compile(rb"[!?]{2,}"),
    re.compile(rb"([A-Za-z])\1\1\1"),
)
VOTERS = WORD_LEXICONS + STEM_LEXICONS + len(PATTERNS)
#: Mutual information, in nats, from which two voters count as correlated.
CORRELATED = 1e-3
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def _terms(text: bytes) -> set[bytes]:
    """The words in small letters, and the beginnings of longer ones marked with a star."""
    words = set(text.translate(_PLAIN).split())
    return words | {w[:STEM] + b"*" for w in words if len(w) > STEM}


@dataclass(frozen=True)
class Terms:
    """Terms in order of their weight of evidence; ``votes`` holds each one's voter or -1."""

    terms: list[bytes]
    votes: list[int]
    number: dict[bytes, int] = field(init=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "number", {t: k for k, t in enumerate(self.terms)})

    def features(self, text: bytes) -> list[int]:
        """Numbers of the terms in a text; patterns come after the terms."""
        found = sorted(self.number[t] for t in self.number.keys() & _terms(text))
        return found + [len(self.terms) + k for k, p in enumerate(PATTERNS) if p.search(text)]

    def pattern(self, features: list[int]) -> int:
        """The voters that fire, as bits."""
        bits, first = 0, WORD_LEXICONS + STEM_LEXICONS - len(self.terms)
        for f in features:
            voter = self.votes[f] if f < len(self.terms) else first + f
            if voter >= 0:
                bits |= 1 << voter
        return bits


class LabelModel:
    """A hidden class and voters that depend on it and on at most one other voter each."""

    def __init__(self, voters: int = VOTERS) -> None:
        self.voters = voters
        self.parents = [-1] * voters
        self.prior = 0.5
        #: P(vote | class, vote of the parent)
        self.fires = np.full((voters, 2, 2), 0.5)

    def fit(self, patterns: np.ndarray, times: np.ndarray, labelled: np.ndarray, share: float, rounds: int = 100):
        """``labelled`` holds, for each pattern, how many rows of class 0 and 1 are known to have it;
        ``share`` is that of class 1 among labelled rows."""
        votes = (patterns[:, None] >> np.arange(self.voters)) & 1
        fixed = self._weighted(labelled, share)
        self.prior = share
        self._estimate(votes, fixed)
        # One look at all documents is enough to see which voters go together, and more would make
        # a correlated pair the hidden class; the fit then starts from the labelled rows again.
        self.parents = _forest(votes, self._counts(votes, times, fixed))
        self._estimate(votes, fixed)
        for _ in range(rounds):
            counts = self._counts(votes, times, fixed)
            before, self.prior = self.prior, (counts[:, 1].sum() + 1) / (counts.sum() + 2)
            self._estimate(votes, counts)
            if abs(self.prior - before) < 1e-9:
                break
        return self

    def _counts(self, votes: np.ndarray, times: np.ndarray, fixed: np.ndarray) -> np.ndarray:
        p = self.posterior(votes)
        return times[:, None] * np.column_stack([1 - p, p]) + fixed

    def _estimate(self, votes: np.ndarray, counts: np.ndarray) -> None:
        for v, parent in enumerate(self.parents):
            other = votes[:, parent] if parent >= 0 else np.zeros(len(votes), dtype=np.int64)
            for up in (0, 1) if parent >= 0 else (0,):
                here = counts * (other == up)[:, None]
                # Add-one smoothing towards the voter's rate without its parent.
                rate = (votes[:, v] @ counts + 0.5) / (counts.sum(axis=0) + 1)
                self.fires[v, :, up] = (votes[:, v] @ here + rate) / (here.sum(axis=0) + 1)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of class 1 for rows of votes."""
        score = np.tile(np.log([1 - self.prior, self.prior]), (len(votes), 1))
        for v, parent in enumerate(self.parents):
            up = votes[:, parent] if parent >= 0 else np.zeros(len(votes), dtype=np.int64)
            rate = np.clip(self.fires[v][:, up].T, 1e-9, 1 - 1e-9)
            score += np.where(votes[:, v : v + 1] == 1, np.log(rate), np.log(1 - rate))
        return 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -700, 700)))

    def updated(self, votes: np.ndarray, labelled: np.ndarray, share: float, worth: float = 2.0) -> np.ndarray:
        """The posterior, worth some labelled rows, together with those that have just these votes."""
        fixed = self._weighted(labelled, share)
        return (worth * self.posterior(votes) + fixed[:, 1]) / (worth + fixed.sum(axis=1))

    @staticmethod
    def _weighted(labelled: np.ndarray, share: float) -> np.ndarray:
        known = labelled.sum(axis=0)
        return labelled / np.maximum(known, 1) * np.array([1 - share, share]) * known.sum()

    def accuracies(self, votes: np.ndarray, times: np.ndarray) -> np.ndarray:
        """How often each voter agrees with the class."""
        p = self.posterior(votes)
        agrees = np.where(votes == 1, p[:, None], 1 - p[:, None])
        return times @ agrees / max(times.sum(), 1)


def _forest(votes: np.ndarray, counts: np.ndarray) -> list[int]:
    """Each voter's parent in the heaviest forest by mutual information given the class, or -1."""
    m = votes.shape[1]
    total = max(counts.sum(), 1e-9)
    weight = np.zeros((m, m))
    for k in (0, 1):
        share = counts[:, k] / total
        mass = max(share.sum(), 1e-12)
        one = votes.T @ share
        both = (votes * share[:, None]).T @ votes
        for a in (0, 1):
            for b in (0, 1):
                pa_ = one if a else mass - one
                pb = one if b else mass - one
                joint = both if a and b else one[:, None] - both if a else one[None, :] - both if b else (
                    mass - one[:, None] - one[None, :] + both
                )
                joint = np.maximum(joint, 0)
                with np.errstate(divide="ignore", invalid="ignore"):
                    part = joint * np.log(joint * mass / (pa_[:, None] * pb[None, :]))
                weight += np.nan_to_num(part, nan=0.0, posinf=0.0, neginf=0.0)
    parents, left = [-1] * m, set(range(m))
    while left:  # Prim's algorithm, tree by tree
        tree = {min(left)}
        left -= tree
        while left:
            w, a, b = max((weight[a, b], -a, -b) for a in tree for b in left)
            if w < CORRELATED:
                break
            parents[-b] = -a
            tree.add(-b)
            left.remove(-b)
    return parents


@dataclass(frozen=True)
class Model:
    """Terms, their weights and the constant; ``voters`` tells accuracy and parent of each voter."""

    terms: Terms
    weights: np.ndarray
    constant: float
    voters: list[tuple[float, int]]

    def scores(self, found: list[bytes]) -> np.ndarray:
        z = np.array([self.constant + self.weights[self.terms.features(t)].sum() for t in found])
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def labelled_texts(
    docs: DataFrame, labels: DataFrame, *, label: str, modulus: int, held_out: int, sample: int, longest: int
) -> tuple[DataFrame, float]:
    """(label, text) of at most ``sample`` documents of each class, and the share of class 1.

    Documents with contradicting labels, held-out ones, empty texts and those of more than
    ``longest`` characters are left out. An id on several rows gives its least text. Of texts of one
    class with the same least hash of three words in a row, which most near copies share, one counts:
    otherwise the words of a text that was copied often would look like words of its class.
    """
    learn = labels.select(column_or_null(labels, "doc_id", "long"), column_or_null(labels, label, "int"))
    learn = learn.where(training_side(F.col("doc_id"), modulus, held_out) & F.col("doc_id").isNotNull())
    learn = learn.where(F.col(label).isin(0, 1)).groupBy("doc_id")
    learn = learn.agg(F.min(label).alias("label"), F.max(label).alias("other"))
    learn = learn.where("label = other").select("doc_id", "label")
    share = {r["label"]: r["n"] for r in learn.groupBy("label").agg(F.count("*").alias("n")).collect()}
    rows = docs.select(column_or_null(docs, "doc_id", "long"), "text")
    short = rows.where((F.length("text") > 0) & (F.length("text") <= longest))
    usable = learn.join(short.select("doc_id").hint("merge"), "doc_id", "left_semi")
    order = [F.md5(F.col("doc_id").cast("string")), "doc_id"]
    chosen = usable.where("label = 0").orderBy(*order).limit(sample)
    chosen = chosen.union(usable.where("label = 1").orderBy(*order).limit(sample))
    # Broadcast: at most two samples of ids.
    found = short.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label")
    found = found.agg(F.min("text").alias("text")).select("label", "text").mapInArrow(
        _signed, "label int, text string, signature long"
    )
    found = found.groupBy("label", "signature").agg(F.min("text").alias("text"))
    return found, (share.get(1, 0) + 1) / (sum(share.values()) + 2)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        signatures = []
        for text in texts(batch):
            words = text.split()
            shingles = (b" ".join(words[k : k + 3]) for k in range(max(len(words) - 2, 1)))
            signatures.append(min(map(zlib.crc32, shingles)))
        columns = [batch.column("label"), batch.column("text"), pa.array(signatures, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["label", "text", "signature"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class with a term; partial counts, handed on before they grow large."""

    def out(counts: tuple[Counter, Counter]) -> pa.RecordBatch:
        keys = list(counts[0].keys() | counts[1].keys())
        clean, toxic = ([c[t] for t in keys] for c in counts)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(clean, pa.int64()), pa.array(toxic, pa.int64())],
            ["term", "clean", "toxic"],
        )

    counts = Counter(), Counter()
    for batch in sliced(batches):
        for text, label in zip(texts(batch), batch.column("label").to_pylist(), strict=True):
            counts[label].update(_terms(text))
        if len(counts[0]) + len(counts[1]) > 300_000:
            yield out(counts)
            counts = Counter(), Counter()
    yield out(counts)


def mined(found: DataFrame, scratch: Scratch, *, most: int) -> Terms:
    """Terms of toxic texts, at most ``most``, by the likelihood ratio G of their four counts.

    G of 10 and odds of e to 1 make a term; it votes if G is what the best of so many terms would
    hardly reach by chance and the odds are e squared to 1. Lexicons get them by rank, in turn.
    """
    n = {r["label"]: r["n"] for r in found.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return Terms([], [])
    sums = found.mapInArrow(_counted, "term binary, clean long, toxic long").groupBy("term")
    sums = scratch.keep(sums.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    all_terms = max(sums.count(), 2)
    clean, toxic = float(n[0]), float(n[1])
    g = "0.0"
    for here, of, every in (("toxic", toxic, "(toxic + clean)"), ("clean", clean, "(toxic + clean)")):
        for cell, cells in ((here, every), (f"({of} - {here})", f"({clean + toxic} - {every})")):
            expected = f"({cells} * {of} / {clean + toxic})"
            g += f" + IF({cell} > 0, 2 * {cell} * ln({cell} / {expected}), 0)"
    odds = f"ln((toxic + 0.5) / ({toxic} - toxic + 0.5)) - ln((clean + 0.5) / ({clean} - clean + 0.5))"
    top = sums.where("toxic >= 2").select("term", F.expr(g).alias("g"), F.expr(odds).alias("odds"))
    top = top.where("g >= 10 AND odds >= 1").orderBy(F.desc("g"), "term").limit(most)
    terms, votes, dealt = [], [], [0, 0]
    for r in top.collect():
        term = bytes(r["term"])
        stem = term.endswith(b"*")
        terms.append(term)
        if r["g"] >= 2 * np.log(all_terms) and r["odds"] >= 2:
            voter = WORD_LEXICONS + dealt[1] % STEM_LEXICONS if stem else dealt[0] % WORD_LEXICONS
            dealt[stem] += 1
            votes.append(voter)
        else:
            votes.append(-1)
    return Terms(terms, votes)


def voted(rows: DataFrame, terms: Terms, carried: str) -> DataFrame:
    """One column carried along, with ``features`` and ``pattern`` of the column ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            features = [terms.features(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(carried),
                    pa.array(features, pa.list_(pa.int32())),
                    pa.array([terms.pattern(f) for f in features], pa.int32()),
                ],
                [carried, "features", "pattern"],
            )

    kind = dict(rows.dtypes)[carried]
    return rows.select(carried, "text").mapInArrow(run, f"{carried} {kind}, features array<int>, pattern int")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label: str = "toxic",
    modulus: int = 5,
    held_out: int = 0,
    sample: int = 6000,
    longest: int = 16_384,
    most: int = 4096,
    examples: int = 20_000,
) -> Model:
    """Learn from all documents' votes and a bounded sample of the labels that are not held out.

    ``sample`` bounds the labelled documents of each class, ``longest`` their characters, ``most``
    the terms, ``examples`` the documents of each side of the posterior that the regression sees
    (chosen by a hash, weighted back to all). If a class is missing among the labels, every text
    gets the smoothed share of class 1.
    """
    spark = docs.sparkSession
    how = dict(label=label, modulus=modulus, held_out=held_out, sample=sample, longest=longest)
    with Scratch(spark, "toxicity") as scratch:
        found, share = labelled_texts(docs, labels, **how)
        found = scratch.keep(found)
        terms = mined(found, scratch, most=most)
        constant = float(np.log(share / (1 - share)))
        if not terms.terms:
            return Model(terms, np.zeros(len(PATTERNS)), constant, [])
        known = voted(found, terms, "label").groupBy("pattern", "label").agg(F.count("*").alias("n")).collect()
        doc_id = column_or_null(docs, "doc_id", "long")
        rows = docs.select(
            F.when(training_side(doc_id, modulus, held_out), F.xxhash64(doc_id, "text")).alias("lot"), "text"
        )
        seen = scratch.keep(voted(rows, terms, "lot"))
        # A row per combination of votes: 2^15 at most.
        every = seen.groupBy("pattern").agg(F.count("*").alias("n"), F.count("lot").alias("learnt")).collect()
        patterns = np.array(sorted({r["pattern"] for r in every} | {r["pattern"] for r in known}), dtype=np.int64)
        place = {p: k for k, p in enumerate(patterns.tolist())}
        times, learnt, fixed = np.zeros(len(patterns)), np.zeros(len(patterns)), np.zeros((len(patterns), 2))
        for r in every:
            times[place[r["pattern"]]], learnt[place[r["pattern"]]] = r["n"], r["learnt"]
        for r in known:
            fixed[place[r["pattern"]], r["label"]] = r["n"]
        model = LabelModel().fit(patterns, times, fixed, share)
        votes = (patterns[:, None] >> np.arange(VOTERS)) & 1
        posterior = model.updated(votes, fixed, share)
        toxic = posterior >= 0.5
        shares = [min(1.0, examples / max(learnt[toxic == side].sum(), 1)) for side in (False, True)]
        table = spark.createDataFrame(
            [(int(p), float(y), float(shares[int(y >= 0.5)])) for p, y in zip(patterns, posterior, strict=True)],
            "pattern int, y double, part double",
        )
        lot = F.pmod(F.col("lot"), F.lit(1 << 30)) / float(1 << 30)
        chosen = seen.where("lot IS NOT NULL").join(F.broadcast(table), "pattern").where(lot < F.col("part"))
        # Alike documents become one row: about two samples of rows at most.
        chosen = chosen.groupBy("features", "y", "part").agg(F.count("*").alias("n")).collect()
        weights, constant = _regression(
            [r["features"] for r in chosen],
            np.array([r["y"] for r in chosen]),
            np.array([r["n"] / r["part"] for r in chosen]),
            len(terms.terms) + len(PATTERNS),
            constant,
        )
        accuracies = model.accuracies(votes, times)
    return Model(terms, weights, constant, list(zip(accuracies.tolist(), model.parents, strict=True)))


def _regression(
    rows: list[list[int]], y: np.ndarray, weight: np.ndarray, size: int, constant: float, ridge: float = 0.1
) -> tuple[np.ndarray, float]:
    """Logistic regression on 0/1 features, by accelerated gradient steps scaled by feature."""
    if not len(y):
        return np.zeros(size), constant
    lengths = np.array([len(r) for r in rows])
    row = np.repeat(np.arange(len(rows)), lengths)
    column = np.concatenate([np.array(r, dtype=np.int64) for r in rows])
    # Bound of the curvature of each feature: a row spreads it over the features it holds.
    reach = np.bincount(column, weights=weight[row] * (lengths[row] + 1), minlength=size) / 4 + ridge
    base = (weight * (lengths + 1)).sum() / 4 + 1e-9
    w, at, c, c_at = np.zeros(size), np.zeros(size), constant, constant
    for k in range(600):
        z = c_at + np.bincount(row, weights=at[column], minlength=len(rows))
        off = weight * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y)
        new = at - (np.bincount(column, weights=off[row], minlength=size) + ridge * at) / reach
        new_c = c_at - off.sum() / base
        pull = k / (k + 3)
        at, c_at = new + pull * (new - w), new_c + pull * (new_c - c)
        step, w, c = max(np.abs(new - w).max(), abs(new_c - c)), new, new_c
        if step < 1e-7:
            break
    return w, float(c)


def score(
    docs: DataFrame, model: Model, *, threshold: float = 0.5, modulus: int = 5, held_out: int = 0
) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score`` (probability of toxic), ``predicted``.

    The score sees the text alone, all of it; null counts as empty, and an empty text, which holds no
    term, gets the regression's constant. Repeated rows score alike; an empty table gives an empty
    result; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            scores = pa.array(model.scores(texts(batch)), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])

    rows = docs.select(column_or_null(docs, "doc_id", "long"), "text")
    return rows.mapInArrow(run, "doc_id long, score double").select(
        "doc_id",
        (~training_side(F.col("doc_id"), modulus, held_out)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
