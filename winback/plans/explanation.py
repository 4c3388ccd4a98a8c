"""Queries on score explanations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winback.contract import PROBABILITY, ModelInfo
from winback.functions.dates import as_date
from winback.operators import explain, scoring
from winback.plans import frames
from winback.plans.catalog import query
from winback.plans.sql import FEATURE_LIST, with_steps
from winback.session import materialise

_DAY = as_date(frames.MATURED_ROUND)
LINEAR = ModelInfo("linear_rule", "1")

# A linear rule on the log-odds scale, small enough not to saturate.
INTERCEPT = -1.25
WEIGHTS = {
    "inactive_days": -0.004,
    "number_orders": 0.05,
    "total_items": 0.0004,
    "total_spent": 0.0000005,
    "unique_products": 0.006,
    "distinct_countries": 0.02,
    "customer_tenure_days": -0.0002,
    "average_ticket": 0.000002,
    "average_amount_per_country": -0.000001,
    "average_amount_per_stock_code": 0.0,
}


def linear_scores(spark: SparkSession, folder: str) -> DataFrame:
    features = frames.round_features(spark, folder, (_DAY,))
    probability = explain.sigmoid(explain.linear_margin(WEIGHTS, INTERCEPT))
    return scoring.score_population(features, probability, LINEAR)


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return explain.scored_population(
        materialise(linear_scores(spark, folder), "scores"), _DAY
    )


def _explained(population: DataFrame) -> DataFrame:
    return explain.linear_contributions(population, WEIGHTS, INTERCEPT, population)


def _sql_number(value: float) -> str:
    return f"CAST({value!r} AS DOUBLE)"


_MARGIN = " + ".join(
    [_sql_number(INTERCEPT), *[f"{_sql_number(w)} * {f}" for f, w in WEIGHTS.items()]]
)
_BASE = " + ".join(
    [_sql_number(INTERCEPT), *[f"{_sql_number(w)} * avg({f}) OVER ()" for f, w in WEIGHTS.items()]]
)
_ENTRIES = " UNION ALL ".join(
    f"SELECT customer_id, scoring_date, priority_group, score_rank, p, base_value, "
    f"{i} AS position, '{f}' AS feature_name, {f} AS feature_value, "
    f"{_sql_number(w)} * ({f} - avg({f}) OVER ()) AS shap_value FROM lin"
    for i, (f, w) in enumerate(WEIGHTS.items())
)
_STEPS = f"""
margins AS (SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + exp(-({_MARGIN}))) AS p FROM round_input
  WHERE scoring_date = DATE '2001-06-08'),
placed AS (SELECT *, row_number() OVER (ORDER BY p DESC, customer_id) AS score_rank,
  CAST(row_number() OVER (ORDER BY p DESC, customer_id) AS DOUBLE) / count(*) OVER () AS pct
  FROM margins),
lin AS (SELECT *, {_BASE} AS base_value,
  CASE WHEN pct <= 0.10::DOUBLE THEN 'TOP_10' WHEN pct <= 0.20::DOUBLE THEN 'TOP_20'
    WHEN pct <= 0.30::DOUBLE THEN 'TOP_30' ELSE 'REMAINDER' END AS priority_group
  FROM placed),
entries AS ({_ENTRIES}),
local AS (SELECT *, sum(shap_value) OVER (PARTITION BY customer_id) + base_value AS raw_margin,
  row_number() OVER (PARTITION BY customer_id ORDER BY abs(shap_value) DESC, position)
    AS contribution_rank FROM entries),
importance AS (SELECT scoring_date, feature_name, position,
    avg(abs(shap_value)) AS mean_absolute_shap, avg(shap_value) AS mean_shap,
    median(shap_value) AS median_shap,
    avg(CASE WHEN shap_value > 0 THEN 1 ELSE 0 END) AS positive_contribution_rate,
    avg(CASE WHEN shap_value < 0 THEN 1 ELSE 0 END) AS negative_contribution_rate,
    count(*) AS sample_size
  FROM entries GROUP BY scoring_date, feature_name, position),
ranked_importance AS (SELECT *, CAST(row_number() OVER
    (ORDER BY mean_absolute_shap DESC, position) AS INTEGER) AS importance_rank
  FROM importance),
examples AS (SELECT customer_id FROM (SELECT customer_id, row_number() OVER
    (PARTITION BY priority_group ORDER BY score_rank) AS k FROM lin) WHERE k <= 3
  UNION SELECT max(customer_id) FROM lin)
"""


@query(
    "explain_population",
    with_steps(
        f"""SELECT customer_id, scoring_date, priority_group, score_rank,
              reactivation_probability, {FEATURE_LIST}
            FROM scores WHERE scoring_date = DATE '2001-06-08'"""
    ),
)
def explain_population(spark: SparkSession, folder: str) -> DataFrame:
    scores = materialise(frames.scored_rounds(spark, folder, (_DAY,)), "scores")
    found = explain.scored_population(scores, _DAY)
    explain.enforce_explainable(found)
    return found


@query(
    "explain_sample",
    with_steps(
        """SELECT customer_id, scoring_date, priority_group, score_rank FROM lin
           ORDER BY md5(concat_ws('|', 42, customer_id, scoring_date)), customer_id LIMIT 2000""",
        _STEPS,
    ),
)
def explain_sample(spark: SparkSession, folder: str) -> DataFrame:
    """The seeded sample of at most 2,000 customers."""
    sample = explain.sample_population(_scored(spark, folder))
    return sample.select("customer_id", "scoring_date", "priority_group", "score_rank")


_CONTRIBUTIONS = "round(shap_value, 9) + 0.0 AS shap_value"


@query(
    "explain_linear_contributions",
    with_steps(
        f"SELECT customer_id, feature_name, feature_value, {_CONTRIBUTIONS}, "
        "round(base_value, 9) AS base_value FROM entries",
        _STEPS,
    ),
)
def explain_linear_contributions(spark: SparkSession, folder: str) -> DataFrame:
    long = explain.long_contributions(_explained(_scored(spark, folder)))
    return long.select(
        "customer_id",
        "feature_name",
        "feature_value",
        (F.round("shap_value", 9) + F.lit(0.0)).alias("shap_value"),
        F.round("base_value", 9).alias("base_value"),
    )


_IMPORTANCE = [
    "mean_absolute_shap", "mean_shap", "median_shap",
    "positive_contribution_rate", "negative_contribution_rate",
]


@query(
    "explain_global_importance",
    with_steps(
        "SELECT scoring_date, importance_rank, feature_name, sample_size, "
        + ", ".join(f"round({n}, 6) + 0.0 AS {n}" for n in _IMPORTANCE)
        + ", 'linear_rule' AS model_name, '1' AS model_version FROM ranked_importance",
        _STEPS,
    ),
)
def explain_global_importance(spark: SparkSession, folder: str) -> DataFrame:
    found = explain.global_importance(_explained(_scored(spark, folder)), LINEAR)
    # Adding zero turns a rounded -0.0 into 0.0.
    return found.drop("calculated_at").withColumns(
        {n: F.round(n, 6) + F.lit(0.0) for n in _IMPORTANCE}
    )


_LOCAL_SQL = """SELECT customer_id, scoring_date, priority_group, score_rank,
  round(p, 6) AS reactivation_probability,
  round(1 / (1 + exp(-raw_margin)), 6) AS probability_from_margin,
  round(raw_margin, 6) AS raw_margin, round(base_value, 6) AS base_value,
  CAST(contribution_rank AS INTEGER) AS contribution_rank, feature_name, feature_value,
  round(shap_value, 6) + 0.0 AS shap_value, round(abs(shap_value), 6) AS absolute_shap_value,
  CASE WHEN shap_value > 0 THEN 'INCREASES_SCORE' WHEN shap_value < 0 THEN 'REDUCES_SCORE'
    ELSE 'NEUTRAL' END AS direction, 'linear_rule' AS model_name, '1' AS model_version
FROM local"""
_LOCAL_ROUNDED = [
    PROBABILITY, "probability_from_margin", "raw_margin", "base_value", "shap_value",
    "absolute_shap_value",
]


def _round_local(local: DataFrame) -> DataFrame:
    return local.drop("explained_at").withColumns(
        {n: F.round(n, 6) + F.lit(0.0) for n in _LOCAL_ROUNDED}
    )


@query("explain_local_rows", with_steps(_LOCAL_SQL, _STEPS))
def explain_local_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _round_local(explain.local_explanations(_explained(_scored(spark, folder)), LINEAR))


@query(
    "explain_contribution_ranks",
    with_steps(
        "SELECT customer_id, feature_name, CAST(contribution_rank AS INTEGER) "
        "AS contribution_rank FROM local",
        _STEPS,
    ),
)
def explain_contribution_ranks(spark: SparkSession, folder: str) -> DataFrame:
    local = explain.local_explanations(_explained(_scored(spark, folder)), LINEAR)
    return local.select("customer_id", "feature_name", "contribution_rank")


@query(
    "explain_chosen_customer",
    with_steps(
        """SELECT 'best' AS choice, customer_id, score_rank FROM lin WHERE score_rank = 1
           UNION ALL SELECT 'named', customer_id, score_rank FROM lin
             WHERE customer_id = (SELECT max(customer_id) FROM lin)""",
        _STEPS,
    ),
)
def explain_chosen_customer(spark: SparkSession, folder: str) -> DataFrame:
    scored = _scored(spark, folder)
    named = scored.agg(F.max("customer_id")).first()[0]
    picks = {
        "best": explain.choose_customer(scored),
        "named": explain.choose_customer(scored, named),
    }
    rows = [
        df.select(F.lit(name).alias("choice"), "customer_id", "score_rank")
        for name, df in picks.items()
    ]
    return rows[0].unionByName(rows[1])


def _examples(scored: DataFrame) -> DataFrame:
    named = scored.agg(F.max("customer_id")).first()[0]
    return explain.example_customers(scored, explain.choose_customer(scored, named))


@query(
    "explain_example_customers",
    with_steps(
        "SELECT customer_id, priority_group, score_rank FROM lin "
        "WHERE customer_id IN (SELECT * FROM examples)",
        _STEPS,
    ),
)
def explain_example_customers(spark: SparkSession, folder: str) -> DataFrame:
    return _examples(_scored(spark, folder)).select(
        "customer_id", "priority_group", "score_rank"
    )


@query(
    "explain_top_contributions",
    with_steps(
        f"SELECT * FROM ({_LOCAL_SQL}) WHERE contribution_rank <= 3 "
        "AND customer_id IN (SELECT * FROM examples)",
        _STEPS,
    ),
)
def explain_top_contributions(spark: SparkSession, folder: str) -> DataFrame:
    """The three strongest contributions of each example customer."""
    scored = _scored(spark, folder)
    explained = explain.linear_contributions(_examples(scored), WEIGHTS, INTERCEPT, scored)
    local = explain.local_explanations(explained, LINEAR)
    return _round_local(explain.top_contributions(local))


@query(
    "explain_leading_features",
    with_steps(
        f"SELECT customer_id, feature_name, {_CONTRIBUTIONS} FROM entries WHERE feature_name IN "
        "(SELECT feature_name FROM ranked_importance WHERE importance_rank <= 8)",
        _STEPS,
    ),
)
def explain_leading_features(spark: SparkSession, folder: str) -> DataFrame:
    explained = _explained(_scored(spark, folder))
    importance = explain.global_importance(explained, LINEAR)
    found = explain.leading_feature_values(explained, importance)
    return found.withColumn("shap_value", F.round("shap_value", 9) + F.lit(0.0))


@query(
    "explain_output_sizes",
    with_steps(
        """SELECT 'global' AS output, count(*) AS row_count FROM importance
           UNION ALL SELECT 'local', count(*) FROM local""",
        _STEPS,
    ),
)
def explain_output_sizes(spark: SparkSession, folder: str) -> DataFrame:
    explained = _explained(_scored(spark, folder))
    outputs = {
        "global": explain.global_importance(explained, LINEAR),
        "local": explain.local_explanations(explained, LINEAR),
    }
    explain.check_outputs(outputs["global"], outputs["local"])
    counted = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("output"), "row_count")
        for name, df in outputs.items()
    ]
    return counted[0].unionByName(counted[1])
