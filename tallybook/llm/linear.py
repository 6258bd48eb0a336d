"""Small linear models.  Sums over all rows come from Spark; only their totals reach the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def totals(table: DataFrame, size: int, statistic: Callable[[pd.DataFrame], np.ndarray]) -> np.ndarray:
    """The sum over all rows of a vector: ``statistic`` gives that of a batch, tasks add up batches and Spark adds up tasks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for pdf in batches:
            if len(pdf):
                total += statistic(pdf)
        yield pd.DataFrame({"at": np.arange(size, dtype=np.int32), "v": total})

    found = table.mapInPandas(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(size)
    out[found["at"].to_numpy()] = found["v"].to_numpy()
    return out


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def newton(evaluate: Callable[[np.ndarray], tuple[float, np.ndarray, np.ndarray]], size: int, rounds: int = 25) -> np.ndarray:
    """Minimise a convex function by damped Newton steps; ``evaluate`` gives value, gradient and Hessian, or an infinite value where not allowed."""
    w = np.zeros(size)
    value, grad, hess = evaluate(w)
    for _ in range(rounds):
        step = np.linalg.solve(hess + 1e-9 * np.eye(size), grad)
        step *= min(1.0, 5 / (np.abs(step).max() + 1e-12))
        for _ in range(6):
            found = evaluate(w - step)
            if found[0] <= value:
                break
            step /= 2
        else:
            break
        w, gain = w - step, value - found[0]
        value, grad, hess = found
        if gain < 1e-7 * max(abs(value), 1e-3):
            break
    return w


def logistic_all(table: DataFrame, size: int, read: Callable[[pd.DataFrame], tuple[np.ndarray, np.ndarray, np.ndarray]], l2: float) -> np.ndarray:
    """Weights (last one the intercept) for soft labels over all rows; ``read`` gives features, labels and numbers of rows of a batch."""
    d = size + 1

    def evaluate(w: np.ndarray):
        def statistic(pdf: pd.DataFrame) -> np.ndarray:
            x, y, n = read(pdf)
            x = np.column_stack([x, np.ones(len(x))])
            z = x @ w
            p = sigmoid(z)
            return np.concatenate([[n.sum(), (n * (np.logaddexp(0, z) - y * z)).sum()], x.T @ (n * (p - y)), ((x * (n * p * (1 - p))[:, None]).T @ x).ravel()])

        s = totals(table, 2 + d + d * d, statistic)
        n, ridge = max(s[0], 1.0), np.append(np.full(size, l2), 1e-9)
        return s[1] / n + (ridge * w * w).sum() / 2, s[2 : 2 + d] / n + ridge * w, s[2 + d :].reshape(d, d) / n + np.diag(ridge)

    return newton(evaluate, d)


def nonnegative_pu(table: DataFrame, size: int, read: Callable[[pd.DataFrame], tuple[np.ndarray, np.ndarray]], prior: float, l2: float = 1e-4) -> np.ndarray:
    """Weights (last one the intercept) of a linear scorer that minimises the non-negative unbiased PU risk, logistic loss.

    ``read`` gives features and flags of trusted positives; every row stands among the unlabelled.
    risk = prior * E_P[loss(+)] + E_U[loss(-)] - prior * E_P[loss(-)], which the logistic loss makes convex;
    a step that would turn the part of the negatives (the last two terms) below zero is shortened until it does not.
    """
    d = size + 1

    def evaluate(w: np.ndarray):
        def statistic(pdf: pd.DataFrame) -> np.ndarray:
            x, known = read(pdf)
            x = np.column_stack([x, np.ones(len(x))])
            z = x @ w
            p, up = sigmoid(z), np.logaddexp(0, z)
            return np.concatenate([
                [len(x), known.sum(), up.sum(), up[known].sum(), (up - z)[known].sum()], x.T @ p, x[known].sum(axis=0), ((x * (p * (1 - p))[:, None]).T @ x).ravel(),
            ])

        s = totals(table, 5 + 2 * d + d * d, statistic)
        n, k = max(s[0], 1.0), max(s[1], 1.0)
        negative = s[2] / n - prior * s[3] / k
        ridge = np.append(np.full(size, l2), 1e-9)
        value = prior * s[4] / k + negative + (ridge * w * w).sum() / 2 if negative >= 0 else np.inf
        return value, s[5 : 5 + d] / n - prior * s[5 + d : 5 + 2 * d] / k + ridge * w, s[5 + 2 * d :].reshape(d, d) / n + np.diag(ridge)

    return newton(evaluate, d)


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-2, rounds: int = 30) -> np.ndarray:
    """Weights (last one the intercept) for soft labels y in [0, 1] of a few rows, by damped Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], l2 * max(len(x), 1))
    ridge[-1] = 1e-6
    for _ in range(rounds):
        p = sigmoid(x @ w)
        grad = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge), grad)
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def calibration(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of a monotone logistic map of scores, fitted with the usual smoothed targets."""
    n1, n0 = int((y == 1).sum()), int((y == 0).sum())
    if n1 == 0 or n0 == 0:
        return 1.0, 0.0
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = np.std(z) or 1.0
    a, b = logistic((z / scale)[:, None], target, l2=1e-6)
    return max(float(a) / scale, 1e-6), float(b)


def calibrated(known: DataFrame, sample: int) -> tuple[float, float]:
    """(slope, offset) for margins ``z`` of labelled rows (doc_id, z, y), from at most ``sample`` rows of least id hash."""
    rows = bounded(known, "doc_id", sample).select("z", "y").toArrow()
    return calibration(rows["z"].to_numpy(), rows["y"].to_numpy()) if rows.num_rows else (1.0, 0.0)


def bounded(df: DataFrame, key: str, n: int) -> DataFrame:
    """At most n rows, those of least key hash: the same rows on every run, in the same order at every size.

    Only rows of small hash are ordered (half as many again as needed), so that not every task sends n rows to be merged.
    """
    level = int((1 << 40) * min(1.0, (1.5 * n + 100) / max(df.count(), 1)))
    place = F.pmod(F.xxhash64(key), F.lit(1 << 40))
    return df.where(place < level).orderBy(place, key).limit(n)


def train_labels(labels: DataFrame, column: str, modulus: int, held: int) -> DataFrame:
    """(doc_id, y): one 0/1 label per document of the training fold; null and other values are ignored.

    Conflicting labels of one document count as 1 if any is 1.
    """
    return (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("y"))
        .where(f"y in (0, 1) and doc_id is not null and crc32(cast(doc_id as string)) % {modulus} <> {held}")
        .groupBy("doc_id").agg(F.max("y").alias("y"))
    )


def held_out(doc_id: str, modulus: int, held: int):
    """The fold column; a null id hashes as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus == held
