import itertools
import math
from multiprocessing.pool import ThreadPool

import numpy as np
import pytest
from pyspark.sql import functions as F

from winback.contract import CHAMPION, FEATURES, PROBABILITY, TARGET, ModelInfo
from winback.functions.trees import model_nodes
from winback.operators import explain, models, registry, search, splits
from winback.operators.quality import DataQualityError
from winback.sources.tables import Tables


@pytest.fixture(scope="module")
def sample(spark):
    """300 customers whose return follows two of the ten features."""
    rng = np.random.default_rng(23)
    x = np.round(rng.normal(size=(300, len(FEATURES))), 3)
    y = (rng.random(300) < 1 / (1 + np.exp(-(1.5 * x[:, 0] - x[:, 3])))).astype(int)
    rows = [(i, *map(float, x[i]), int(y[i])) for i in range(300)]
    names = ", ".join(f"{f} double" for f in FEATURES)
    df = spark.createDataFrame(rows, f"customer_id bigint, {names}, {TARGET} int")
    df = df.withColumn("reference_date", F.lit("2011-01-01").cast("date")).withColumn(
        "split", F.when(F.col("customer_id") < 200, "train").otherwise("valid"))
    return df.repartition(3).cache(), x, y


@pytest.fixture(scope="module")
def boosted(sample):
    df, _, _ = sample
    return models.fit_boosted(df, positive_weight=2.0, maxIter=6, maxDepth=3)


def test_logistic_reaches_the_optimum(sample):
    df, x, y = sample
    fitted = models.fit_logistic(df).stages[-1]
    w, b = np.array(fitted.coefficients), fitted.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    # Gradient of sum log-loss + |w|^2 / (2 C) with C = 1.
    assert np.abs(x.T @ (p - y) + w).max() < 0.05
    assert abs((p - y).sum()) < 0.05


def test_prior_model(sample):
    df, _, y = sample
    train = df.filter(F.col("split") == "train")
    rows = models.prior_scores(train, df).select(PROBABILITY, "prediction_0_5").distinct().collect()
    assert len(rows) == 1 and rows[0][0] == pytest.approx(y[:200].mean())
    assert rows[0][1] == int(y[:200].mean() > 0.5)


def test_boosting_repeats_with_its_seed(sample, boosted):
    df, _, _ = sample
    again = models.fit_boosted(df, positive_weight=2.0, maxIter=6, maxDepth=3)
    score = lambda m: sorted(map(tuple, models.predict(m, df).select(
        "customer_id", PROBABILITY).collect()))
    assert score(boosted) == score(again)


def test_predict_keeps_columns_and_checks_features(sample, boosted):
    df, _, _ = sample
    assert models.predict(boosted, df).columns == [*df.columns, PROBABILITY, "prediction_0_5"]
    models.check_features(boosted)
    with pytest.raises(ValueError, match="differ"):
        models.check_features(boosted, FEATURES[::-1])


def expected_margin(nodes, weights, x, present):
    """Mean margin when only `present` features are known, weighted by cover."""
    def walk(tree, number):
        node = nodes[tree, number]
        if node["left"] < 0:
            return node["prediction"]
        sides = (node["left"], node["right"])
        if node["feature"] in present:
            return walk(tree, sides[int(x[node["feature"]] > node["cut"])])
        return sum(walk(tree, s) * nodes[tree, s]["cover"] for s in sides) / node["cover"]
    return 2 * sum(w * walk(t, 0) for t, w in enumerate(weights))


def test_tree_contributions_equal_brute_force(spark, sample, boosted):
    df, x, _ = sample
    model = boosted.stages[-1]
    nodes = {(n["tree"], n["id"]): n for n in model_nodes(model).collect()}
    used = sorted({n["feature"] for n in nodes.values() if n["left"] >= 0})
    few = df.filter(F.col("customer_id") < 3)
    explained = explain.tree_contributions(models.predict(boosted, few), model).collect()
    for row in explained:
        point = x[row.customer_id]
        value = lambda s: expected_margin(nodes, model.treeWeights, point, s)
        assert row.base_value == pytest.approx(value(set()), abs=1e-9)
        known = {}
        for size in range(len(used) + 1):
            for group in itertools.combinations(used, size):
                known[frozenset(group)] = value(set(group))
        for j in range(len(FEATURES)):
            want = 0.0
            if j in used:
                for group, before in known.items():
                    if j not in group:
                        k = len(group)
                        weight = math.factorial(k) * math.factorial(len(used) - k - 1)
                        want += weight / math.factorial(len(used)) * (known[group | {j}] - before)
            assert row.contributions[j] == pytest.approx(want, abs=1e-9)
        margin = row.base_value + sum(row.contributions)
        assert 1 / (1 + math.exp(-margin)) == pytest.approx(row[PROBABILITY], abs=1e-9)


def scored(df):
    return df.withColumnRenamed("reference_date", "scoring_date").withColumns(
        {"priority_group": F.lit("TOP_10"), "score_rank": F.col("customer_id") + 1})


def test_local_rows_add_up(sample, boosted):
    df, _, _ = sample
    population = scored(models.predict(boosted, df))
    explained = explain.tree_contributions(population, boosted.stages[-1])
    info = ModelInfo("m", "1")
    local, overall = explain.local_explanations(explained, info), explain.global_importance(explained, info)
    assert local.filter(F.abs(F.col("probability_from_margin") - F.col(PROBABILITY)) > 1e-9).isEmpty()
    ranks = local.groupBy("customer_id").agg(F.sort_array(F.collect_list("contribution_rank")).alias("r"))
    assert ranks.filter(F.col("r") != F.array(*map(F.lit, range(1, 11)))).isEmpty()
    explain.check_outputs(overall, local)
    with pytest.raises(DataQualityError):
        explain.check_outputs(overall.limit(9), local)
    with pytest.raises(DataQualityError):
        explain.check_outputs(overall, local.filter("contribution_rank < 10"))
    assert explain.top_contributions(local).count() == 3 * 300


def test_sample_is_bounded_and_repeats(sample, boosted):
    df, _, _ = sample
    population = scored(df)
    ids = lambda d: {r.customer_id for r in d.collect()}
    first = ids(explain.sample_population(population, rows=50))
    assert len(first) == 50
    assert first == ids(explain.sample_population(population.repartition(7), rows=50))
    assert len(ids(explain.sample_population(population, rows=5000))) == 300
    assert first != ids(explain.sample_population(population, rows=50, seed=1))


def test_choice_of_customer(sample):
    df, _, _ = sample
    population = scored(df)
    assert explain.choose_customer(population).first().customer_id == 0
    assert explain.choose_customer(population, 17).first().customer_id == 17
    with pytest.raises(ValueError, match="customer 999"):
        explain.choose_customer(population, 999)


def test_search_is_seeded_and_within_range(sample):
    import random

    drawn = [search.draw_settings(random.Random(s)) for s in range(40)]
    assert all(200 <= d["maxIter"] <= 800 and d["maxIter"] % 50 == 0 for d in drawn)
    assert all(2 <= d["maxDepth"] <= 6 and 0.01 <= d["stepSize"] <= 0.2 for d in drawn)
    assert all(0.6 <= d["subsamplingRate"] <= 1 for d in drawn)
    assert all(1e-4 <= d["l1"] <= 5 and 0.01 <= d["l2"] <= 20 for d in drawn)
    assert len(search.SPACE) == 8
    assert search.draw_settings(random.Random(3)) == drawn[3]
    space = {**search.SPACE, "maxIter": search.steps(2, 4, 1), "maxDepth": search.steps(2, 2, 1)}
    df, _, _ = sample
    found = search.search(df, trials=2, together=2, space=space)
    again = search.search(df, trials=2, together=1, space=space)
    assert found == again and search.best_trial(found) in found


def test_no_positive_class(sample):
    df, _, _ = sample
    with pytest.raises(ValueError, match="no positive"):
        splits.positive_weight(df.filter(F.col(TARGET) == 0))


def test_registry_flow(spark, sample, boosted):
    df, _, _ = sample
    tables = Tables.scratch(spark)
    metrics = {"valid_pr_auc": 0.4, "test_pr_auc": 0.5, "test_lift_at_10pct": 3.0}
    registry.log_run(tables, "failed", {}, {"valid_pr_auc": 0.9}, status="FAILED")
    registry.log_run(tables, "none", {}, {})
    weak = registry.log_run(tables, "weak", {}, {**metrics, "valid_pr_auc": 0.1, "test_pr_auc": 0.1})
    run_id = registry.log_run(tables, "good", {"maxIter": 6}, metrics, model=boosted)
    runs = registry.read_runs(spark, tables)
    best = registry.leaderboard(runs).first()
    assert best.run_id == run_id and best.params == {"maxIter": "6"}
    checked = registry.guardrails(runs)
    assert dict(map(tuple, registry.promotion(checked).collect()))[run_id] == "APPROVED"
    registry.enforce_guardrails(checked.filter(F.col("run_id") == run_id))
    with pytest.raises(ValueError, match="test_pr_auc=0.1"):
        registry.enforce_guardrails(checked.filter(F.col("run_id") == weak))
    for version in ("1", "2"):
        info = registry.register(tables, "m", best.asDict())
        assert info.version == version
    registry.register(tables, "other", best.asDict(), alias="candidate")
    registry.set_alias(tables, "m", 1, "previous")
    assert registry.load(tables, "m", "previous")[1].version == "1"
    registry.set_alias(tables, "m", 1)
    model, info = registry.load(tables, "m")
    assert (info.version, info.alias, info.run_id) == ("1", CHAMPION, run_id)
    assert registry.aliases(tables).count() == 3
    before, after = (models.predict(m, df).agg(F.sum(PROBABILITY)).first()[0] for m in (boosted, model))
    assert before == pytest.approx(after)
    with pytest.raises(ValueError, match="no model"):
        registry.load(tables, "m", "nobody")


def test_registrations_at_the_same_time(spark):
    """Eight threads: eight numbers, and the alias ends at the last of them."""
    tables = Tables.scratch(spark)
    with ThreadPool(8) as pool:
        made = pool.map(
            lambda i: registry.register(tables, "m", {"run_id": f"r{i}", "model_path": f"p{i}"}), range(8)
        )
    assert sorted(int(info.version) for info in made) == list(range(1, 9))
    stored = {r.model_version: r.source_run_id for r in tables.read("registry", "versions").collect()}
    assert stored == {int(info.version): info.run_id for info in made}
    assert [tuple(r) for r in registry.aliases(tables).collect()] == [("m", CHAMPION, 8)]


def test_a_name_is_claimed_once(spark):
    tables = Tables.scratch(spark)
    with ThreadPool(16) as pool:
        assert sum(pool.map(lambda _: tables.claim("x/y"), range(64))) == 1
    assert tables.claim_number("x/n", 3) == 3 and tables.claim_number("x/n", 3) == 4
    with pytest.raises(ValueError, match="partition value"):
        registry.set_alias(tables, "a/b", 1)


@pytest.mark.parametrize("value", [None, float("nan"), float("inf"), 0.29])
def test_bad_metrics_block(spark, value):
    run = spark.createDataFrame([("r", {"test_pr_auc": value, "test_lift_at_10pct": 9.0})],
                                "run_id string, metrics map<string,double>")
    rows = {r.guardrail: r.status for r in registry.guardrails(run).collect()}
    assert rows == {"test_pr_auc": "BLOCKED", "test_lift_at_10pct": "APPROVED"}


def test_ratio_bounds():
    from winback.functions.dates import monthly_dates

    dates = monthly_dates("2010-03-08", "2011-11-08")
    bounds = splits.bounds_by_ratio(dates)
    sizes = [sum(a <= d <= b for d in dates) for a, b in bounds.values()]
    assert sizes == [15, 3, 3]
