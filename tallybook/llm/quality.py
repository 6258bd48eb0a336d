"""Quality classifier by positive-unlabelled learning.

Trusted positives are training documents labelled 1; every document may stand among the
unlabelled.  The class prior is estimated from the training labels, and a
linear scorer minimises the non-negative unbiased risk.  A monotone logistic map fitted on the
training labels turns its margin into a probability.

Features are style counts of the whole text; one pass over the table computes them for every
document, so fitting and scoring never read texts again.  Means, scales and the risk are summed over all documents in
each round; only the probability map uses at most ``SAMPLE`` labelled rows (those of least id hash).

Defined cases: null and empty texts get the features of an empty text and a score like any other; texts of any length count
whole; null ids are scored; repeated rows and other ties get equal scores; without both classes among the
training labels the margin itself is mapped; an empty table gives an empty result.  Other
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import Words, blocks, span_hashes
from .linear import calibrated, held_out, matrix, nonnegative_pu, sigmoid, totals, train_labels
from .tables import Stages

SAMPLE = 20_000
FEATURES = (
    "words", "word_length", "symbols", "pipes", "upper", "digits", "exclaim", "non_ascii", "commas", "stops",
    "line_length", "repeated_lines", "distinct_words", "distinct_shingles", "short_words", "stutter", "glued", "any_symbols", "any_upper", "any_pipes", "empty",
)


def _per_text(flags: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(flags.astype(np.int64), starts)


def _distinct_share(text: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Distinct values over values, per text; 1 where there are none."""
    if len(value) == 0:
        return np.ones(n)
    order = np.lexsort((value, text))
    t, v = text[order], value[order]
    new = np.concatenate([[True], (t[1:] != t[:-1]) | (v[1:] != v[:-1])])
    return np.bincount(t[new], minlength=n) / np.maximum(np.bincount(t, minlength=n), 1) + (np.bincount(t, minlength=n) == 0)


def style(texts: list[bytes]) -> np.ndarray:
    """The FEATURES of some UTF-8 texts, one row each."""
    n = len(texts)
    words = Words(texts)
    data = words.data
    starts = words.text_end - np.array([len(t) + 1 for t in texts])
    size = np.maximum(words.text_end - starts - 1, 1)
    count = np.diff(words.first)
    some = np.maximum(count, 1)
    upper = _per_text((data >= 65) & (data <= 90), starts)
    lower = _per_text((data >= 97) & (data <= 122), starts)
    of = lambda chars: _per_text(np.isin(data, np.frombuffer(chars, np.uint8)), starts)
    symbols, pipes, exclaim = of(b"$%#&*@^~=+<>{}[]\\_"), of(b"|"), of(b"!")
    length = words.end - words.start
    lines = _per_text(data == 10, starts)
    # a line's hash adds up its words; lines without words do not count
    line = np.searchsorted(np.flatnonzero(data == 10), words.start)
    fresh = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(line) else np.zeros(0, np.int64)
    place = (np.arange(len(line)) - np.repeat(fresh, np.diff(np.append(fresh, len(line))))).astype(np.uint64)
    line_hash = np.add.reduceat(words.hash * (place * np.uint64(2) + np.uint64(0x9E3779B97F4A7C15)), fresh) if len(fresh) else np.zeros(0, np.uint64)
    shingle, shingle_text = words.shingles(5)
    same = np.zeros(len(words.hash), bool)
    same[1:] = (np.diff(words.text) == 0) & (words.end[1:] - words.start[1:] == words.end[:-1] - words.start[:-1])
    same[1:] &= span_hashes(words.sums, words.start[1:] + 1, words.end[1:]) == span_hashes(words.sums, words.start[:-1] + 1, words.end[:-1])
    follows = words.end < len(data)
    glued = np.bincount(words.text, weights=follows & np.isin(data[np.minimum(words.end, len(data) - 1)], np.frombuffer(b"$%#&*!|@", np.uint8)), minlength=n)
    x = np.column_stack([
        np.log1p(count),
        np.bincount(words.text, weights=length, minlength=n) / some,
        symbols / size, pipes / some, upper / np.maximum(upper + lower, 1), _per_text((data >= 48) & (data <= 57), starts) / size,
        exclaim / some, _per_text(data >= 128, starts) / size, of(b",;:") / some, of(b".?") / some,
        np.log1p(count / lines),
        1 - _distinct_share(words.text[fresh], line_hash, n),
        _distinct_share(words.text, words.hash, n), _distinct_share(shingle_text, shingle, n),
        np.bincount(words.text, weights=length <= 3, minlength=n) / some,
        np.bincount(words.text, weights=same, minlength=n) / some,
        glued / some,
        np.minimum(symbols, 20) / 20, np.minimum(upper / (some * 0.5), 1), np.minimum(pipes, 20) / 20,
        count == 0,
    ])
    return x


def style_table(docs: DataFrame, stages: Stages) -> DataFrame:
    """(doc_id, x) for every row of docs (doc_id, text), written once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in pdf["text"]]
            for lo, hi in blocks(texts):
                yield pd.DataFrame({"doc_id": pdf["doc_id"].iloc[lo:hi].to_numpy(), "x": list(style(texts[lo:hi]).astype(np.float32))})

    return stages.save(docs.mapInPandas(run, "doc_id long, x array<float>"), "style")


class QualityModel:
    """Standardised features, PU weights and the probability map."""

    def __init__(self, mean, scale, weights, slope, offset, prior):
        self.mean, self.scale, self.weights, self.slope, self.offset, self.prior = mean, scale, weights, slope, offset, prior

    def margin(self, x: np.ndarray) -> np.ndarray:
        return _expand(x, self.mean, self.scale) @ self.weights[:-1] + self.weights[-1]

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.margin(x) + self.offset)


def _expand(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / scale, -8, 8)
    return np.column_stack([z, z * z / 8])


def fit(table: DataFrame, prior: float, sample: int = SAMPLE) -> QualityModel:
    """Fit on ``table`` (doc_id, x, y): y is the label of the training fold, null for all other rows."""
    d = len(FEATURES)
    s = totals(table.select("x"), 1 + 2 * d, lambda pdf: np.concatenate([[len(pdf)], (x := matrix(pdf["x"])).sum(axis=0), (x * x).sum(axis=0)]))
    mean = s[1 : 1 + d] / max(s[0], 1)
    scale = np.sqrt(np.maximum(s[1 + d :] / max(s[0], 1) - mean * mean, 0)) + 1e-3
    weights = nonnegative_pu(table.select("x", "y"), 2 * d, lambda pdf: (_expand(matrix(pdf["x"]), mean, scale), (pdf["y"] == 1).to_numpy()), prior)
    model = QualityModel(mean, scale, weights, 1.0, 0.0, prior)

    @F.pandas_udf("double")
    def margin(x: pd.Series) -> pd.Series:
        return pd.Series(model.margin(matrix(x)) if len(x) else np.zeros(0))

    model.slope, model.offset = calibrated(table.where("y is not null").select("doc_id", "y", margin("x").alias("z")), sample)
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, stages: Stages, doc_id="doc_id", text="text", label="quality", modulus: int = 5, held: int = 0, threshold: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    table = style_table(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), stages)
    known = stages.save(train_labels(labels, label, modulus, held), "labels")
    share = known.agg(F.avg("y")).first()[0]
    table = stages.save(table.join(known, "doc_id", "left"), "fit")
    model = fit(table, float(np.clip(0.5 if share is None else share, 0.02, 0.98)), sample)

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(matrix(x)) if len(x) else np.zeros(0))

    return table.select(
        "doc_id", held_out("doc_id", modulus, held).alias("held_out"), score("x").alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
