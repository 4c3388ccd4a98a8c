"""Queries on population, target, features, splits and metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winback.contract import MONTH, OBSERVATION_DAYS, TARGET, Parameters
from winback.functions.dates import as_date, reference_dates
from winback.functions.lines import month
from winback.operators import carried, features, metrics, population, registry, rounds, splits
from winback.operators.models import prior_scores
from winback.operators.monitoring import matured_labels
from winback.operators.scoring import rule_scores
from winback.plans import frames
from winback.plans.catalog import query
from winback.plans.sql import ROUNDED_METRICS, metric_steps, rounded, with_steps
from winback.session import FILE_ROWS
from winback.sources.tables import Tables


def _rounded(df: DataFrame, names=ROUNDED_METRICS, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


@query("population_reference_dates", with_steps("SELECT reference_date FROM ref_dates"))
def population_reference_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Dates with valid lines up to them: the calendar, joined with what the data covers."""
    first = frames.lines(spark, folder, "modeling").agg(F.min("purchase_date")).scalar()
    dates = reference_dates(spark, frames.REFERENCE_START, frames.REFERENCE_END)
    return dates.filter(F.col("reference_date") >= first)


def _state(spark: SparkSession, folder: str) -> DataFrame:
    slots = population.purchase_slots(
        frames.lines(spark, folder, "modeling"), frames.dates(), look_ahead=0
    )
    return population.as_of(slots, frames.dates(), counted=())


@query(
    "population_as_of_history",
    with_steps(
        "SELECT customer_id, reference_date, lines_so_far, last_purchase_date, inactive_days "
        "FROM state"
    ),
)
def population_as_of_history(spark: SparkSession, folder: str) -> DataFrame:
    return _state(spark, folder).select(
        "customer_id", "reference_date", "lines_so_far", "last_purchase_date", "inactive_days"
    )


@query(
    "population_eligible",
    with_steps(
        "SELECT customer_id, reference_date, last_purchase_date, inactive_days FROM state "
        "WHERE inactive_days >= 60"
    ),
)
def population_eligible(spark: SparkSession, folder: str) -> DataFrame:
    return population.eligible(_state(spark, folder)).select(
        "customer_id", "reference_date", "last_purchase_date", "inactive_days"
    )


def _population(spark: SparkSession, folder: str) -> DataFrame:
    return population.population(frames.lines(spark, folder, "modeling"), frames.dates())


@query(
    "population_reactivated",
    with_steps(
        "SELECT customer_id, reference_date FROM population WHERE target_reactivated_30d = 1"
    ),
)
def population_reactivated(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _population(spark, folder)
        .filter(F.col(TARGET) == 1)
        .select("customer_id", "reference_date")
    )


@query(
    "population_with_target",
    with_steps(
        "SELECT customer_id, reference_date, last_purchase_date, inactive_days, "
        "target_reactivated_30d FROM population"
    ),
)
def population_with_target(spark: SparkSession, folder: str) -> DataFrame:
    return _population(spark, folder)


@query(
    "population_target_rate",
    with_steps(
        """SELECT reference_date, count(*) AS eligible_customers,
             CAST(sum(target_reactivated_30d) AS BIGINT) AS reactivated_customers,
             CAST(round(CAST(sum(target_reactivated_30d) * 100 AS DOUBLE) / count(*), 2) AS DOUBLE)
               AS reactivation_rate
           FROM population GROUP BY reference_date"""
    ),
)
def population_target_rate(spark: SparkSession, folder: str) -> DataFrame:
    return population.target_rate(_population(spark, folder))


@query(
    "population_class_balance",
    with_steps(
        """SELECT target_reactivated_30d, count(*) AS "count",
             count(*) * 100.0::DOUBLE / (SELECT count(*) FROM population) AS percent
           FROM population GROUP BY target_reactivated_30d"""
    ),
)
def population_class_balance(spark: SparkSession, folder: str) -> DataFrame:
    return population.class_balance(_population(spark, folder))


@query(
    "features_history",
    with_steps(
        "SELECT p.customer_id, p.reference_date, p.lines_so_far, f.total_items FROM population p "
        "JOIN base_sums f ON p.customer_id = f.customer_id AND p.reference_date = f.reference_date"
    ),
)
def features_history(spark: SparkSession, folder: str) -> DataFrame:
    return population.eligible(_state(spark, folder)).select(
        "customer_id", "reference_date", "lines_so_far", "total_items"
    )


@query("features_modeling_base", with_steps("SELECT * FROM base"))
def features_modeling_base(spark: SparkSession, folder: str) -> DataFrame:
    return frames.base(spark, folder)


@query("features_at_scoring_dates", with_steps("SELECT * FROM round_features"))
def features_at_scoring_dates(spark: SparkSession, folder: str) -> DataFrame:
    return frames.round_features(spark, folder)


@query("features_carried_forward", with_steps("SELECT * FROM round_features"))
def features_carried_forward(spark: SparkSession, folder: str) -> DataFrame:
    """The same features from state carried from round to round over stored silver."""
    tables = Tables.scratch(spark)
    tables.write_full(
        frames.silver(spark, folder).withColumn(MONTH, month()), "silver", "transactions", by=MONTH,
        file_rows=FILE_ROWS,
    )
    history = tables.create_full_history()
    for day in frames.ROUNDS:
        rounds.carry_state(tables, history, day)
    return reduce(DataFrame.unionAll, [carried.features(tables, day) for day in frames.ROUNDS])


_WINDOWED = """windowed AS (
  SELECT customer_id, reference_date, min(purchase_date) AS first_purchase_date,
    count(DISTINCT invoice) AS number_orders, CAST(sum(quantity) AS BIGINT) AS total_items,
    CAST(sum(total_amount) AS DOUBLE) AS total_spent,
    count(DISTINCT stock_code) AS unique_products,
    count(DISTINCT country) AS distinct_countries
  FROM modeling JOIN ref_dates
    ON purchase_date BETWEEN reference_date - 180 AND reference_date
  GROUP BY customer_id, reference_date
)"""


@query(
    "features_windowed_base",
    with_steps(
        """SELECT p.customer_id, p.reference_date, last_purchase_date, inactive_days,
             target_reactivated_30d, first_purchase_date, number_orders, total_items, total_spent,
             unique_products, distinct_countries,
             CAST(p.reference_date - first_purchase_date AS INTEGER) AS customer_tenure_days,
             total_spent / number_orders AS average_ticket,
             total_spent / distinct_countries AS average_amount_per_country,
             total_spent / unique_products AS average_amount_per_stock_code
           FROM population p LEFT JOIN windowed f
             ON p.customer_id = f.customer_id AND p.reference_date = f.reference_date""",
        _WINDOWED,
    ),
)
def features_windowed_base(spark: SparkSession, folder: str) -> DataFrame:
    return features.modeling_base(
        frames.lines(spark, folder, "modeling"),
        frames.dates(),
        Parameters(observation_days=OBSERVATION_DAYS),
    )


@query(
    "features_activity_and_trend",
    with_steps(
        """SELECT p.customer_id, p.reference_date, d.active_days,
             CAST(p.last_purchase_date - d.first_day AS DOUBLE) / nullif(d.active_days - 1, 0)
               AS mean_days_between_purchases,
             s.total_spent, coalesce(w.total_spent, 0) AS recent_spent,
             coalesce(w.total_spent, 0) / s.total_spent AS recent_spend_share
           FROM population p
           JOIN (SELECT customer_id, reference_date, count(DISTINCT purchase_date) AS active_days,
                   min(purchase_date) AS first_day FROM history GROUP BY 1, 2) d
             ON p.customer_id = d.customer_id AND p.reference_date = d.reference_date
           JOIN base_sums s
             ON p.customer_id = s.customer_id AND p.reference_date = s.reference_date
           LEFT JOIN windowed w
             ON p.customer_id = w.customer_id AND p.reference_date = w.reference_date""",
        _WINDOWED,
    ),
)
def features_activity_and_trend(spark: SparkSession, folder: str) -> DataFrame:
    return features.extra_features(frames.lines(spark, folder, "modeling"), frames.dates())


@query(
    "split_labelled",
    with_steps(
        "SELECT customer_id, reference_date, split, target_reactivated_30d FROM split_base"
    ),
)
def split_labelled(spark: SparkSession, folder: str) -> DataFrame:
    labelled = splits.with_split(_population(spark, folder), frames.BOUNDS)
    return labelled.select("customer_id", "reference_date", "split", TARGET)


@query(
    "split_audit",
    with_steps(
        """SELECT split, min(reference_date) AS min_date, max(reference_date) AS max_date,
             count(*) AS row_count FROM split_base GROUP BY split"""
    ),
)
def split_audit(spark: SparkSession, folder: str) -> DataFrame:
    return splits.split_audit(splits.with_split(_population(spark, folder), frames.BOUNDS))


@query(
    "split_audit_by_ratio",
    with_steps(
        """SELECT CASE WHEN k <= 15 THEN 'train' WHEN k <= 18 THEN 'valid' ELSE 'test' END AS split,
             min(reference_date) AS min_date, max(reference_date) AS max_date,
             count(*) AS row_count
           FROM (SELECT *, dense_rank() OVER (ORDER BY reference_date) AS k FROM population)
           GROUP BY 1"""
    ),
)
def split_audit_by_ratio(spark: SparkSession, folder: str) -> DataFrame:
    bounds = splits.bounds_by_ratio(frames.dates())
    return splits.split_audit(splits.with_split(_population(spark, folder), bounds))


@query(
    "split_class_weight",
    with_steps(
        """SELECT count(*) FILTER (target_reactivated_30d = 0) AS negatives,
             count(*) FILTER (target_reactivated_30d = 1) AS positives,
             CAST(count(*) FILTER (target_reactivated_30d = 0) AS DOUBLE)
               / count(*) FILTER (target_reactivated_30d = 1) AS positive_weight
           FROM split_base WHERE split = 'train'"""
    ),
)
def split_class_weight(spark: SparkSession, folder: str) -> DataFrame:
    labelled = splits.with_split(_population(spark, folder), frames.BOUNDS)
    return splits.class_weight(labelled.filter(F.col("split") == "train"))


_BY_SPLIT = metric_steps("rule_base", "split", "customer_id, reference_date")
_COUNTS = "row_count, true_negative, false_positive, false_negative, true_positive"


@query(
    "metric_table_by_split",
    with_steps(f"SELECT split, {_COUNTS}, {rounded(ROUNDED_METRICS)} FROM evaluated", _BY_SPLIT),
)
def metric_table_by_split(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.evaluate(frames.rule_scored_base(spark, folder)))


_TOP = [n for n in ROUNDED_METRICS if n.endswith("pct")]


@query("metric_top_k", with_steps(f"SELECT split, {rounded(_TOP)} FROM evaluated", _BY_SPLIT))
def metric_top_k(spark: SparkSession, folder: str) -> DataFrame:
    found = metrics.evaluate(frames.rule_scored_base(spark, folder))
    return _rounded(found.select("split", *_TOP), _TOP)


_CURVES = ["pr_auc", "roc_auc"]


@query("metric_curves", with_steps(f"SELECT split, {rounded(_CURVES)} FROM evaluated", _BY_SPLIT))
def metric_curves(spark: SparkSession, folder: str) -> DataFrame:
    found = metrics.evaluate(frames.rule_scored_base(spark, folder))
    return _rounded(found.select("split", *_CURVES), _CURVES)


@query(
    "metric_confusion",
    with_steps(
        "SELECT split, true_negative, false_positive, false_negative, true_positive, "
        f"{rounded(['precision', 'recall', 'f1'])} FROM evaluated",
        _BY_SPLIT,
    ),
)
def metric_confusion(spark: SparkSession, folder: str) -> DataFrame:
    found = metrics.confusion(frames.rule_scored_base(spark, folder))
    return _rounded(found, ["precision", "recall", "f1"])


_RATES = ["positive_rate", "predicted_positive_rate", "brier_score"]


@query(
    "metric_rates_and_brier",
    with_steps(f"SELECT split, row_count, {rounded(_RATES)} FROM evaluated", _BY_SPLIT),
)
def metric_rates_and_brier(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.rates(frames.rule_scored_base(spark, folder)), _RATES)


@query(
    "model_prior_baseline",
    with_steps(
        f"SELECT split, {_COUNTS}, {rounded(ROUNDED_METRICS)} FROM evaluated",
        """prior AS (SELECT *, (SELECT avg(target_reactivated_30d) FROM split_base
             WHERE split = 'train') AS reactivation_probability FROM split_base),"""
        + metric_steps("prior", "split", "customer_id, reference_date"),
    ),
)
def model_prior_baseline(spark: SparkSession, folder: str) -> DataFrame:
    labelled = splits.with_split(_population(spark, folder), frames.BOUNDS)
    train = labelled.filter(F.col("split") == "train")
    return _rounded(metrics.evaluate(prior_scores(train, labelled)))


def _by_rule(base: DataFrame) -> DataFrame:
    """The base once per rule, with the rule's score."""
    scored = [
        F.struct(F.lit(name).alias("rule"), score.alias("score"))
        for name, score in rule_scores(base).items()
    ]
    return base.select(
        "customer_id", "reference_date", "split", TARGET, F.explode(F.array(*scored)).alias("_s")
    ).select("customer_id", "reference_date", "split", TARGET, "_s.*")


_RULES = """by_rule AS (
  SELECT customer_id, reference_date, target_reactivated_30d, 'recency/' || split AS rule_split,
    -CAST(inactive_days AS DOUBLE) AS score FROM split_base
  UNION ALL SELECT customer_id, reference_date, target_reactivated_30d, 'frequency/' || split,
    CAST(number_orders AS DOUBLE) FROM split_base
  UNION ALL SELECT customer_id, reference_date, target_reactivated_30d, 'monetary/' || split,
    total_spent FROM split_base
  UNION ALL SELECT customer_id, reference_date, target_reactivated_30d, 'ticket/' || split,
    average_ticket FROM split_base
),""" + metric_steps("by_rule", "rule_split", "customer_id, reference_date", "score")

_RANKING = ["positive_rate", *_CURVES, *_TOP]


@query(
    "model_rule_baselines",
    with_steps(
        f"SELECT split_part(rule_split, '/', 1) AS rule, split_part(rule_split, '/', 2) AS split, "
        f"row_count, {rounded(_RANKING)} FROM evaluated",
        _RULES,
    ),
)
def model_rule_baselines(spark: SparkSession, folder: str) -> DataFrame:
    scored = _by_rule(frames.split_base(spark, folder))
    found = metrics.evaluate(scored, group=("rule", "split"), score="score")
    return _rounded(found.select("rule", "split", "row_count", *_RANKING), _RANKING)


def _rule_runs(spark: SparkSession, folder: str) -> DataFrame:
    """A finished run per rule; its metrics are those measured on valid and test."""
    found = metrics.evaluate(
        _by_rule(frames.split_base(spark, folder)).filter(F.col("split") != "train"),
        group=("rule", "split"),
        score="score",
    )
    names = ("pr_auc", "lift_at_10pct")
    entries = F.array(
        *[
            F.struct(F.concat_ws("_", "split", F.lit(n)).alias("key"), F.round(n, 6).alias("value"))
            for n in names
        ]
    )
    # Two splits per rule, two metrics each.
    return found.groupBy(F.col("rule").alias("run_id")).agg(
        F.lit(registry.FINISHED).alias("status"),
        F.map_from_entries(F.flatten(F.collect_list(entries))).alias("metrics"),
    )


_RUNS = _RULES + """, runs AS (
  SELECT split_part(rule_split, '/', 1) AS run_id,
    round(max(pr_auc) FILTER (rule_split LIKE '%/valid'), 6) AS valid_pr_auc,
    round(max(pr_auc) FILTER (rule_split LIKE '%/test'), 6) AS test_pr_auc,
    round(max(lift_at_10pct) FILTER (rule_split LIKE '%/test'), 6) AS test_lift_at_10pct
  FROM evaluated GROUP BY 1
)"""


@query(
    "model_leaderboard",
    with_steps(
        """(SELECT 'valid_pr_auc' AS metric, run_id, valid_pr_auc AS metric_value FROM runs
            ORDER BY valid_pr_auc DESC, run_id LIMIT 1)
           UNION ALL (SELECT 'test_pr_auc', run_id, test_pr_auc FROM runs
            ORDER BY test_pr_auc DESC, run_id LIMIT 1)""",
        _RUNS,
    ),
)
def model_leaderboard(spark: SparkSession, folder: str) -> DataFrame:
    runs = _rule_runs(spark, folder)
    tops = [
        registry.leaderboard(runs, metric).select(
            F.lit(metric).alias("metric"), "run_id", "metric_value"
        )
        for metric in ("valid_pr_auc", "test_pr_auc")
    ]
    return tops[0].unionByName(tops[1])


@query(
    "model_guardrails",
    with_steps(
        """SELECT run_id, guardrail, minimum_value, actual_value,
             coalesce(actual_value >= minimum_value, false) AS approved,
             CASE WHEN actual_value >= minimum_value THEN 'APPROVED' ELSE 'BLOCKED' END AS status
           FROM (SELECT run_id, 'test_pr_auc' AS guardrail, CAST(0.30 AS DOUBLE) AS minimum_value,
                   test_pr_auc AS actual_value FROM runs
                 UNION ALL SELECT run_id, 'test_lift_at_10pct', 2.5, test_lift_at_10pct FROM runs)""",
        _RUNS,
    ),
)
def model_guardrails(spark: SparkSession, folder: str) -> DataFrame:
    return registry.guardrails(_rule_runs(spark, folder))


@query(
    "model_promotion",
    with_steps(
        """SELECT run_id, CASE WHEN test_pr_auc >= 0.30 AND test_lift_at_10pct >= 2.5
             THEN 'APPROVED' ELSE 'BLOCKED' END AS promotion_status FROM runs""",
        _RUNS,
    ),
)
def model_promotion(spark: SparkSession, folder: str) -> DataFrame:
    return registry.promotion(registry.guardrails(_rule_runs(spark, folder)))


@query(
    "metric_return_rate_by_priority",
    with_steps(
        """SELECT priority_group, count(*) AS customers, CAST(sum(y) AS BIGINT)
             AS reactivated_customers, round(avg(y), 6) AS reactivation_rate
           FROM (SELECT priority_group, CASE WHEN customer_id IN (SELECT customer_id FROM strict
               WHERE purchase_date > DATE '2001-06-08' AND purchase_date <= DATE '2001-06-08' + 30)
               THEN 1 ELSE 0 END AS y FROM scores WHERE scoring_date = DATE '2001-06-08')
           GROUP BY priority_group"""
    ),
)
def metric_return_rate_by_priority(spark: SparkSession, folder: str) -> DataFrame:
    day = as_date(frames.MATURED_ROUND)
    scores = frames.scored_rounds(spark, folder, (day,))
    labelled = matured_labels(scores, frames.silver(spark, folder), day)
    found = metrics.return_rate_by_group(labelled)
    return found.withColumn("reactivation_rate", F.round("reactivation_rate", 6))
