"""Seeded random search over boosted tree settings on a fixed validation split."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winback.contract import RANDOM_SEED
from winback.operators.boosting import TOGETHER, fit_many
from winback.operators.metrics import evaluate
from winback.operators.models import predict
from winback.operators.splits import positive_weight
from winback.session import materialise

TRIALS = 100

Draw = Callable[[random.Random], float]


def steps(low: float, high: float, step: float) -> Draw:
    count = round((high - low) / step)
    return lambda rng: low + step * rng.randint(0, count)


def log_uniform(low: float, high: float) -> Draw:
    return lambda rng: math.exp(rng.uniform(math.log(low), math.log(high)))


# The eight ranges searched.
SPACE: Mapping[str, Draw] = {
    "maxIter": steps(200, 800, 50),
    "maxDepth": steps(2, 6, 1),
    "stepSize": log_uniform(0.01, 0.20),
    "minChildWeight": steps(1, 12, 1),
    "subsamplingRate": steps(0.60, 1.00, 0.05),
    "featureShare": steps(0.60, 1.00, 0.05),
    "l1": log_uniform(1e-4, 5.0),
    "l2": log_uniform(0.01, 20.0),
}
_WHOLE = ("maxIter", "maxDepth", "minChildWeight")
_SHARES = ("subsamplingRate", "featureShare")


def draw_settings(rng: random.Random, space: Mapping[str, Draw] = SPACE) -> dict:
    drawn = {name: draw(rng) for name, draw in space.items()}
    whole = {name: int(drawn[name]) for name in _WHOLE if name in drawn}
    shares = {name: round(drawn[name], 2) for name in _SHARES if name in drawn}
    return {**drawn, **whole, **shares}


@dataclass(frozen=True)
class Trial:
    number: int
    settings: dict
    valid_pr_auc: float


def search(
    split: DataFrame,
    trials: int = TRIALS,
    together: int = TOGETHER,
    seed: int = RANDOM_SEED,
    space: Mapping[str, Draw] = SPACE,
) -> list[Trial]:
    """Trials in order of their number; each fits on train and is judged on valid.

    Rows are binned once and `together` trials grow in the same passes over them.
    """
    stored = materialise(split, "search")
    train = stored.filter(F.col("split") == "train")
    valid = stored.filter(F.col("split") == "valid")
    weight = positive_weight(train)
    rng = random.Random(seed)
    drawn = [draw_settings(rng, space) for _ in range(trials)]
    models = fit_many(train, drawn, weight, seed, together=together)
    return [
        Trial(number, drawn[number], evaluate(predict(model, valid)).select("pr_auc").first()[0])
        for number, model in enumerate(models)
    ]


def best_trial(found: list[Trial]) -> Trial:
    return max(found, key=lambda t: (t.valid_pr_auc, -t.number))
