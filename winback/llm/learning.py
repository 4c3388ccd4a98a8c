"""Fitting of small linear models from a bounded sample of labelled texts."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# One sparse example: sorted distinct feature numbers and their values.
Example = tuple[np.ndarray, np.ndarray]


def remainder(id_column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo a divisor: the folds that hold rows out."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % divisor


def held_out(id_column: str, divisor: int, fold: int) -> Column:
    return F.coalesce(remainder(id_column, divisor) == fold, F.lit(False))


def labelled_texts(
    documents: DataFrame,
    labels: DataFrame,
    label: str,
    learned: Column,
    per_class: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> tuple[pa.Table, dict[int, int]]:
    """At most `per_class` texts of each label value 0 and 1, and how many labels there are.

    `learned` (over the id column) says which rows may be seen. Ids are taken in the order
    of their hash, so the sample is the same in every run. An id with several labels counts
    by their mean; one with several texts gives the smallest; equal texts stay. The sample
    is small by its bound, so it is broadcast to the documents and its texts collected.
    """
    clean = (
        labels.select(F.col(id_column).alias("id"), F.col(label).cast("double").alias("label"))
        .filter(F.col("id").isNotNull() & F.col("label").isNotNull())
        .withColumnRenamed("id", id_column)
        .filter(learned)
        .groupBy(F.col(id_column).alias("id"))
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    )
    sizes = {r["label"]: r["count"] for r in clean.groupBy("label").count().collect()}
    chosen = None
    for value in sorted(sizes):
        some = clean.filter(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(per_class)
        chosen = some if chosen is None else chosen.unionAll(some)
    if chosen is None:
        return pa.table({"label": pa.array([], pa.int32()), "text": pa.array([], pa.string())}), {}
    texts = documents.select(
        F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")
    )
    sample = (
        texts.join(F.broadcast(chosen), "id")
        .groupBy("id", "label")
        .agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
        .orderBy(F.xxhash64("id"), "id")
        .select("label", "text")
    )
    return sample.toArrow(), sizes


def classes_of(sizes: dict[int, int]) -> float | None:
    """The share of label 1 where there is nothing to tell apart, else None."""
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    return None if n0 and n1 else (n1 + 1) / (n0 + n1 + 2)


def dual_coordinate_descent(
    examples: list[Example],
    signs: np.ndarray,
    size: int,
    cost: np.ndarray | float = 1.0,
    rounds: int = 20,
    tolerance: float = 1e-3,
    seed: int = 0,
) -> np.ndarray:
    """Weights of a linear support vector machine with hinge loss, one multiplier at a time.

    The last weight is the bias, an extra feature of value 1 in every example. `cost` is the
    upper bound of the multipliers, for all examples or for each.
    """
    weights = np.zeros(size + 1)
    costs = np.broadcast_to(np.asarray(cost, float), len(examples))
    squares = np.array([float(v @ v) + 1.0 for _, v in examples])
    multipliers = np.zeros(len(examples))
    order = np.arange(len(examples))
    shuffle = np.random.default_rng(seed)
    for _ in range(rounds):
        shuffle.shuffle(order)
        worst = 0.0
        for i in order.tolist():
            at, values = examples[i]
            slope = signs[i] * (weights[at] @ values + weights[size]) - 1
            old = multipliers[i]
            new = min(max(old - slope / squares[i], 0.0), costs[i])
            if new != old:
                worst = max(worst, abs(new - old) * squares[i])
                multipliers[i] = new
                step = (new - old) * signs[i]
                weights[at] += step * values
                weights[size] += step
        if worst < tolerance:
            break
    return weights


def logistic(
    inputs: np.ndarray, labels: np.ndarray, weights: np.ndarray, penalty: float = 1e-2, steps: int = 50
) -> np.ndarray:
    """Coefficients and intercept (last) of a weighted logistic regression, by Newton steps."""
    x = np.column_stack((inputs, np.ones(len(inputs))))
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-9
    found = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ found)
        slope = x.T @ (weights * (p - labels)) + ridge * found
        curve = (x * (weights * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        found -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return found


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -700, 700)))


def curve_rows(classes: np.ndarray, every: int = 4) -> np.ndarray:
    """Rows kept from a fit so that its curve sees unfamiliar texts: every fourth of each
    class, or all rows (which the fit then uses too) where a class has too few to share."""
    if min((classes == value).sum() for value in (0, 1)) < 2 * every:
        return np.ones(len(classes), bool)
    place = np.zeros(len(classes), np.int64)
    for value in (0, 1):
        place[classes == value] = np.arange((classes == value).sum())
    return place % every == every - 1


def class_weights(labels: np.ndarray, sizes: dict[int, int]) -> np.ndarray:
    """Weights that give a sample by class the shares the classes really have."""
    out = np.ones(len(labels))
    for value in (0, 1):
        there = labels == value
        if there.any():
            out[there] = sizes[value] / there.sum()
    return out / out.mean()


def score_column(score: Callable[[pa.Array], np.ndarray]):
    """A column function that scores whole texts in Arrow batches."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(score(texts), pa.float64())

    return scored
