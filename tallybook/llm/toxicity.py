"""Toxicity by weak supervision.

Many lexicon and pattern voters look at each whole text: lists of insults by kind, patterns
of their use, and words and word beginnings mined from the labels of the training fold (invented
and foreign insults are in no public list).  A generative label model with a latent class
is fitted to the votes by expectation-maximisation: each voter has a rate of votes per class,
from which its accuracy follows, and voters that agree beyond what the class explains are
correlated, so each of them counts for a share of one vote.  A linear classifier is trained on
the posterior labels, and its margin is mapped to a probability on training labels.

Mining reads at most ``SAMPLE`` labelled documents, and so does the probability map (those of least id hash).  The label model and the
classifier are fitted to all documents: Spark groups equal feature rows, most of which hold no vote at all,
and sums the statistics of every round over them.  Every document is then scored over its whole text.

Defined cases: null and empty texts have no votes and get the score of a text without
hits; texts of any length count whole; null ids are scored; repeated rows and other ties get equal scores; without training labels nothing is mined and
the posterior alone decides; an empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import Words, blocks, lowered, span_hashes
from .linear import bounded, calibrated, held_out, logistic_all, matrix, sigmoid, totals, train_labels
from .tables import Stages

SAMPLE = 20_000
#: Lexicon voters: insults by kind.
LEXICON = {
    "intellect": "idiot idiots moron morons imbecile imbeciles",
    "stupid": "stupid dumb dumbass brainless halfwit",
    "failure": "loser losers",
    "worth": "worthless useless pathetic",
    "filth": "scum filth vermin scumbag",
    "trash": "trash garbage rubbish",
    "disgust": "disgusting revolting repulsive vile",
    "ridicule": "clown clowns fool fools jerk",
    "hostile": "bastard bitch asshole scumbag cretin",
    "german": "idioten dummkopf arschloch abschaum trottel",
    "romance": "connard salaud imbécile estúpido gilipollas asqueroso",
}
#: Words before an insult that aim it at someone.
AIMED = "you your youre these such a an"
PATTERNS = ("twice", "often", "dense", "aimed", "varied")
#: Lengths in bytes of mined word beginnings; 0 stands for whole words.
CUTS = (0, 4, 5, 6)
ROUNDS = 25


def _sorted_hashes(words: str) -> np.ndarray:
    return np.sort(Words([words.encode()]).hash)


def _member(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if len(known) == 0 or len(values) == 0:
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def terms(words: Words, cut: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, word number) of whole words, or of the first ``cut`` bytes of longer words."""
    if cut == 0:
        return words.hash, np.arange(len(words.hash))
    long = np.flatnonzero(words.end - words.start > cut)
    return span_hashes(words.sums, words.start[long], words.start[long] + cut) ^ np.uint64(cut), long


def votes(texts: list[bytes], mined: list[tuple[int, int]]) -> np.ndarray:
    """Feature rows of some lower-cased texts; the first columns are the voters' 0/1 votes."""
    n = len(texts)
    words = Words(texts)
    groups = [(0, _sorted_hashes(x)) for x in LEXICON.values()] + [(c, np.array([h], np.uint64)) for c, h in mined]
    flagged = np.zeros(len(words.hash), bool)
    columns = []
    for cut in CUTS:
        own = [(i, known) for i, (c, known) in enumerate(groups) if c == cut]
        if not own:
            continue
        h, at = terms(words, cut)
        hit = np.flatnonzero(_member(h, np.unique(np.concatenate([k for _, k in own]))))
        flagged[at[hit]] = True
        columns += [(i, np.bincount(words.text[at[hit]][_member(h[hit], known)], minlength=n)) for i, known in own]
    counts = np.column_stack([c for _, c in sorted(columns, key=lambda x: x[0])])
    hit = np.flatnonzero(flagged)
    text = words.text[hit]
    total, size = np.bincount(text, minlength=n), np.maximum(np.diff(words.first), 1)
    inside = hit > words.first[text]
    aimed = _member(words.hash[hit[inside] - 1], _sorted_hashes(AIMED))
    n_aimed = np.bincount(text[inside][aimed], minlength=n)
    kinds = (counts > 0).sum(axis=1)
    return np.column_stack([
        counts > 0, total >= 2, total >= 4, total / size >= 0.005, n_aimed > 0, kinds >= 2,
        total > 0, np.log1p(total), np.log1p(n_aimed), np.minimum(1, 20 * total / size), kinds / 4,
    ]).astype(np.float32)


def mine(docs: DataFrame, labels: DataFrame, stages: Stages, sample: int = SAMPLE) -> list[tuple[int, int]]:
    """(cut, hash) of terms that mark label 1 in at most ``sample`` labelled documents.

    A term must occur in five distinct texts of label 1 or more and in next to none of label 0.  Each text of label 1 nominates the most
    frequent of its terms of every length, so that the words of one much copied document crowd nothing out and every text
    that has a marking term is covered.
    """
    some = F.broadcast(bounded(labels, "doc_id", sample))  # at most ``sample`` rows of two numbers
    chosen = docs.join(some, "doc_id").groupBy(F.xxhash64("text").alias("doc_id")).agg(F.first("text").alias("text"), F.max("y").alias("y"))

    def occurrences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, y, ids = lowered(list(pdf["text"])), pdf["y"].to_numpy(), pdf["doc_id"].to_numpy()
            for lo, hi in blocks(texts, 1 << 18):
                words = Words(texts[lo:hi])
                for cut in CUTS:
                    h, at = terms(words, cut)
                    t = words.text[at]
                    order = np.lexsort((h, t))
                    h, t = h[order], t[order]
                    new = np.concatenate([[True], (h[1:] != h[:-1]) | (t[1:] != t[:-1])])[: len(h)]
                    h, t = h[new], t[new]
                    yield pd.DataFrame({"cut": np.full(len(h), cut), "h": h.view(np.int64), "doc_id": ids[lo:hi][t], "y": y[lo:hi][t]})

    seen = stages.save(chosen.mapInPandas(occurrences, "cut int, h long, doc_id long, y int"), "terms")
    strong = seen.groupBy("cut", "h").agg(F.sum("y").alias("n1"), F.count("*").alias("n")).where("n1 >= 5 and n - n1 <= 0.02 * n1")
    best = seen.where("y = 1").join(strong, ["cut", "h"]).groupBy("doc_id", "cut").agg(F.max(F.struct("n1", "h")).alias("best"))
    picked = best.select("cut", "best.h").distinct().orderBy("cut", "h").toArrow()
    stages.drop("terms")
    return list(zip(picked["cut"].to_pylist(), (h % (1 << 64) for h in picked["h"].to_pylist())))


class LabelModel:
    """Two latent classes; a rate of votes per voter and class; shares that allow for correlated voters.

    A voter votes for class 1 or abstains, which says nothing by itself: most voters
    know one language.  That all abstain is the one vote for class 0.
    """

    def __init__(self, patterns: DataFrame, n_voters: int, prior: float, rounds: int = ROUNDS):
        """Fit to ``patterns`` (x, n): feature rows, whose first columns are votes, and how many documents have each."""
        self.base = np.log(prior / (1 - prior))
        k = n_voters + 1
        self.weight, start = np.zeros(k), True
        for _ in range(rounds):

            def statistic(pdf: pd.DataFrame) -> np.ndarray:
                v, n = self.ballot(matrix(pdf["x"])[:, :n_voters]), pdf["n"].to_numpy()
                post = np.where(v[:, -1] > 0, 0.01, 0.9) if start else sigmoid(self.base + v @ self.weight)
                p1, p0 = n * post, n * (1 - post)
                return np.concatenate([[p1.sum(), p0.sum()], p1 @ v, p0 @ v, ((v * p1[:, None]).T @ v).ravel(), ((v * p0[:, None]).T @ v).ravel()])

            s = totals(patterns, 2 + 2 * k + 2 * k * k, statistic)
            n1, n0, s1, s0 = s[0], s[1], s[2 : 2 + k], s[2 + k : 2 + 2 * k]
            m1, m0 = s[2 + 2 * k :].reshape(2, k, k)
            self.rate1, self.rate0 = (s1 + 0.5) / (n1 + 1), (s0 + 0.05) / (n0 + 10)
            self.rate0[:-1] = np.minimum(self.rate0[:-1], self.rate1[:-1])
            # correlations of voters within the classes
            about = lambda m, s, n, r: m - np.outer(s, r) - np.outer(r, s) + n * np.outer(r, r)
            cov = about(m1, s1, n1, self.rate1) + about(m0, s0, n0, self.rate0)
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            self.correlation = np.clip(cov / np.outer(sd, sd), 0, 1)
            np.fill_diagonal(self.correlation, 1)
            before, self.weight = self.weight, np.log(self.rate1 / self.rate0) / self.correlation.sum(axis=1)
            done, start = not start and np.abs(self.weight - before).max() < 1e-2, False
            if done:
                break
        self.accuracy = self.rate1 / (self.rate1 + self.rate0)

    @staticmethod
    def ballot(v: np.ndarray) -> np.ndarray:
        return np.column_stack([v, ~v.astype(bool).any(axis=1)]).astype(np.float64)

    def posterior(self, v: np.ndarray) -> np.ndarray:
        return sigmoid(self.base + self.ballot(v) @ self.weight)


def ballots(docs: DataFrame, mined: list[tuple[int, int]], stages: Stages) -> DataFrame:
    """(doc_id, x) for every row of docs (doc_id, text), written once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = lowered(list(pdf["text"]))
            for lo, hi in blocks(texts):
                yield pd.DataFrame({"doc_id": pdf["doc_id"].iloc[lo:hi].to_numpy(), "x": list(votes(texts[lo:hi], mined))})

    return stages.save(docs.mapInPandas(run, "doc_id long, x array<float>"), "ballots")


def fit(table: DataFrame, labels: DataFrame, n_voters: int, stages: Stages, sample: int = SAMPLE):
    """A function from feature rows to probabilities, and the label model behind it."""
    share = labels.agg(F.avg("y")).first()[0]
    prior = float(np.clip(0.1 if share is None else share, 0.01, 0.5))
    patterns = stages.save(table.groupBy("x").agg(F.count("*").alias("n")), "patterns")
    size = patterns.agg(F.max(F.size("x"))).first()[0]
    if size is None:
        return (lambda x: np.zeros(len(x))), None
    model = LabelModel(patterns, n_voters, prior)

    def read(pdf: pd.DataFrame):
        x = matrix(pdf["x"])
        return x, model.posterior(x[:, :n_voters]), pdf["n"].to_numpy()

    weights = logistic_all(patterns, size, read, l2=1e-5)
    stages.drop("patterns")
    margin = lambda x: x @ weights[:-1] + weights[-1]

    @F.pandas_udf("double")
    def z(x: pd.Series) -> pd.Series:
        return pd.Series(margin(matrix(x)) if len(x) else np.zeros(0))

    slope, offset = calibrated(table.join(labels, "doc_id").select("doc_id", "y", z("x").alias("z")), sample)
    return (lambda x: sigmoid(slope * margin(x) + offset)), model


def toxicity_scores(docs: DataFrame, labels: DataFrame, stages: Stages, doc_id="doc_id", text="text", label="toxic", modulus: int = 3, held: int = 1, threshold: float = 0.7, sample: int = SAMPLE) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    known = stages.save(train_labels(labels, label, modulus, held), "labels")
    mined = mine(docs, known, stages, sample)
    table = ballots(docs, mined, stages)
    probability, _ = fit(table, known, len(LEXICON) + len(mined) + len(PATTERNS), stages, sample)

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(probability(matrix(x)) if len(x) else np.zeros(0))

    return table.select(
        "doc_id", held_out("doc_id", modulus, held).alias("held_out"), score("x").alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
