import numpy as np
import pytest
from pyspark.sql import functions as F

from winback.functions.drift import psi
from winback.functions.ordered import exact_percentiles, with_rank, with_running_totals
from winback.operators.metrics import evaluate
from winback.operators.scoring import with_priority


def test_rank_with_heavy_ties(spark):
    """A third of all rows share one score; ranks stay exact and complete."""
    df = spark.range(3000).select(
        F.col("id"), (F.col("id") % 2).alias("g"),
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(1)).alias("score"),
    )
    df = spark.createDataFrame(df.toPandas())
    ranked = with_rank(df.repartition(7), ["g"], [F.col("score").desc(), F.col("id")]).toPandas()
    for _, part in ranked.groupby("g"):
        part = part.sort_values(["score", "id"], ascending=[False, True])
        assert list(part["rank"]) == list(range(1, len(part) + 1))
        assert set(part["rank_of"]) == {len(part)}


def test_running_totals(spark):
    rng = np.random.default_rng(3)
    rows = [(int(g), int(i), int(v)) for i, (g, v) in enumerate(rng.integers(0, 4, (500, 2)))]
    df = spark.createDataFrame(rows, "g int, i int, v int").repartition(5)
    got = with_running_totals(df, ["g"], [F.col("i")], {"so_far": F.col("v")}).toPandas()
    got = got.sort_values(["g", "i"])
    assert (got["so_far"] == got.groupby("g")["v"].cumsum()).all()
    assert (got["so_far_total"] == got.groupby("g")["v"].transform("sum")).all()


def test_percentiles_equal_numpy(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(size=203), np.full(101, 0.25)])
    df = spark.createDataFrame([("a", float(v)) for v in values] + [("b", 4.0)], "g string, v double")
    probs = {f"p{i}": i / 20 for i in range(21)}
    rows = {r["g"]: r for r in exact_percentiles(df, ["g"], "v", probs).collect()}
    assert np.allclose([rows["a"][n] for n in probs], np.quantile(values, list(probs.values())))
    assert all(rows["b"][n] == 4.0 for n in probs)


def numpy_psi(reference, current, bins=10):
    """The definition, on arrays."""
    if not len(reference) or not len(current):
        return None
    values = np.unique(np.concatenate([reference, current]))
    if len(values) <= 10:
        shares = [[np.mean(side == v) for v in values] for side in (reference, current)]
    else:
        edges = np.unique(np.quantile(reference, np.linspace(0, 1, bins + 1)))
        if len(edges) < 3:
            return 0.0
        inner = edges[1:-1]
        shares = [
            np.bincount(np.searchsorted(inner, side, side="right"), minlength=len(inner) + 1)
            / len(side)
            for side in (reference, current)
        ]
    r, c = (np.maximum(s, 1e-6) for s in shares)
    return float(np.sum((c - r) * np.log(c / r)))


CASES = {
    "same": (np.arange(200.0), np.arange(200.0)),
    "shifted": (np.arange(200.0), np.arange(200.0) + 40),
    "few_values": (np.array([1.0, 2, 2, 3] * 9), np.array([2.0, 3, 3, 4] * 7)),
    "constant_reference": (np.full(50, 3.0), np.arange(40.0)),
    "heavy_value": (np.r_[np.zeros(80), np.arange(1, 90.0)], np.r_[np.zeros(10), np.arange(1, 50.0)]),
}


@pytest.mark.parametrize("case", CASES)
def test_psi_equals_definition(spark, case):
    reference, current = CASES[case]
    frame = lambda values: spark.createDataFrame([(float(v),) for v in values], "x double")
    got = psi(frame(reference), frame(current), ["x"]).first()["psi"]
    assert got == pytest.approx(numpy_psi(reference, current), abs=1e-9)


def test_psi_ignores_non_finite_and_empty_sides(spark):
    rows = [(float(v),) for v in range(30)] + [(float("nan"),), (float("inf"),), (None,)]
    df = spark.createDataFrame(rows, "x double")
    assert psi(df, df, ["x"]).first()["psi"] == 0.0
    assert psi(df, df.limit(0), ["x"]).first()["psi"] is None
    assert psi(df.limit(0), df, ["x"]).first()["psi"] is None


def scored(spark, rows):
    return spark.createDataFrame(
        [(i, "s", float(p), y) for i, (p, y) in enumerate(rows)],
        "customer_id bigint, split string, reactivation_probability double, "
        "target_reactivated_30d int",
    )


def metrics_of(spark, rows):
    return evaluate(scored(spark, rows), keys=("customer_id",)).first()


def test_metrics_equal_definition(spark):
    rng = np.random.default_rng(11)
    p = np.round(rng.random(157), 1)
    y = (rng.random(157) < p * 0.6).astype(int)
    got = metrics_of(spark, zip(p, y.tolist()))
    order = np.lexsort((np.arange(157), -p))
    for k in (10, 20, 30):
        top = y[order][: max(1, int(np.ceil(157 * k / 100)))]
        assert got[f"precision_at_{k}pct"] == pytest.approx(top.mean())
        assert got[f"recall_at_{k}pct"] == pytest.approx(top.sum() / y.sum())
        assert got[f"lift_at_{k}pct"] == pytest.approx(top.mean() / y.mean())
    ap = recall = 0.0
    for s in sorted(set(p), reverse=True):
        chosen = y[p >= s]
        ap += (chosen.sum() / y.sum() - recall) * chosen.mean()
        recall = chosen.sum() / y.sum()
    assert got["pr_auc"] == pytest.approx(ap)
    wins = [(a > b) + (a == b) / 2 for a in p[y == 1] for b in p[y == 0]]
    assert got["roc_auc"] == pytest.approx(np.mean(wins))
    assert got["brier_score"] == pytest.approx(np.mean((p - y) ** 2))
    cells = [got[c] for c in ("true_negative", "false_positive", "false_negative", "true_positive")]
    assert sum(cells) == got["row_count"] == 157


@pytest.mark.parametrize("label, precision", [(0, 0.0), (1, 1.0)])
def test_one_class(spark, label, precision):
    got = metrics_of(spark, [(0.9, label), (0.4, label), (0.4, label)])
    assert got["roc_auc"] is None
    assert got["precision_at_10pct"] == precision
    assert got["recall_at_10pct"] == pytest.approx(precision / 3)
    assert got["lift_at_10pct"] == precision


def test_equal_scores_and_tiny_groups(spark):
    got = metrics_of(spark, [(0.5, 1), (0.5, 0), (0.5, 0), (0.5, 1)])
    assert got["roc_auc"] == 0.5 and got["pr_auc"] == 0.5
    # ceil(0.4) = 1 row, the first customer.
    assert got["precision_at_10pct"] == 1.0


def test_priority_groups_partition_the_population(spark):
    df = spark.range(47).select(
        F.col("id").alias("customer_id"), F.lit("2011-01-01").cast("date").alias("scoring_date"),
        (F.col("id") % 5 / 5).alias("reactivation_probability"),
    )
    found = with_priority(df).groupBy("priority_group").count().collect()
    # Groups hold floor(share * N) customers, 4 of 47 at 10 %.
    assert dict(map(tuple, found)) == {"TOP_10": 4, "TOP_20": 5, "TOP_30": 5, "REMAINDER": 33}


def test_tiny_population_has_no_top(spark):
    df = spark.range(3).select(
        F.col("id").alias("customer_id"), F.lit("2011-01-01").cast("date").alias("scoring_date"),
        F.lit(0.1).alias("reactivation_probability"),
    )
    rows = with_priority(df).orderBy("score_rank").collect()
    assert [r.customer_id for r in rows] == [0, 1, 2]
    assert {r.priority_group for r in rows} == {"REMAINDER"}
