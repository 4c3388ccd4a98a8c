"""Runs, promotion guardrails, model versions and aliases as tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winback.contract import CHAMPION, FEATURES, GUARDRAILS, ModelInfo
from winback.operators.models import check_features
from winback.operators.search import Trial, best_trial
from winback.sources.tables import Tables

FINISHED = "FINISHED"
SELECTION_METRIC = "valid_pr_auc"

RUN_SCHEMA = (
    "run_id string, run_name string, parent_run_id string, status string, "
    "params map<string,string>, metrics map<string,double>, tags map<string,string>, "
    "model_path string, finished_at timestamp"
)
VERSION_SCHEMA = (
    "source_run_id string, model_path string, description string, "
    "tags map<string,string>, registered_at timestamp, model_name string, model_version int"
)
MOVE_SCHEMA = "model_version int, model_name string, alias string, move int"


def _now() -> datetime:
    return datetime.now(timezone.utc)


def run_metrics(evaluated: DataFrame, group: str = "split") -> dict[str, float]:
    """Metric rows per split as one mapping, `<split>_<metric>`; a few dozen numbers."""
    out = {}
    for row in evaluated.collect():
        values = row.asDict()
        name = values.pop(group)
        out.update({f"{name}_{k}": float(v) for k, v in values.items() if v is not None})
    return out


def log_run(
    tables: Tables,
    name: str,
    params: Mapping[str, object],
    metrics: Mapping[str, float],
    tags: Mapping[str, str] | None = None,
    model: PipelineModel | None = None,
    parent: str | None = None,
    status: str = FINISHED,
) -> str:
    """Append a run; its model, if any, is saved beside the tables."""
    run_id = uuid.uuid4().hex
    path = None
    if model is not None:
        path = f"{tables.root}/models/{run_id}"
        model.write().save(path)
    row = (
        run_id,
        name,
        parent,
        status,
        {k: str(v) for k, v in params.items()},
        dict(metrics),
        dict(tags or {}),
        path,
        _now(),
    )
    tables.write_append(
        tables.spark.createDataFrame([row], RUN_SCHEMA), "registry", "runs"
    )
    return run_id


def log_trials(tables: Tables, found: Sequence[Trial], name: str) -> str:
    """A run for the search with its best settings, and one child run per trial."""
    best = best_trial(found)
    parent = log_run(
        tables, name, best.settings, {SELECTION_METRIC: best.valid_pr_auc},
        tags={"run_role": "search", "trials": str(len(found)), "best_trial": str(best.number)},
        status="SEARCHED",
    )
    rows = [
        (
            uuid.uuid4().hex,
            f"trial_{t.number:03d}",
            parent,
            "TRIED",
            {k: str(v) for k, v in t.settings.items()},
            {SELECTION_METRIC: t.valid_pr_auc},
            {"run_role": "trial", "optimization_metric": SELECTION_METRIC},
            None,
            _now(),
        )
        for t in found
    ]
    trials = tables.spark.createDataFrame(rows, RUN_SCHEMA)
    tables.write_append(trials, "registry", "runs")
    return parent


def leaderboard(runs: DataFrame, metric: str = SELECTION_METRIC, rows: int = 1) -> DataFrame:
    """Best finished runs by a metric; runs without it come last."""
    return (
        runs.filter(F.col("status") == FINISHED)
        .withColumn("metric_value", F.col("metrics").getItem(metric))
        .orderBy(F.col("metric_value").desc_nulls_last(), "run_id")
        .limit(rows)
    )


def guardrails(
    run: DataFrame, limits: Mapping[str, float] = GUARDRAILS
) -> DataFrame:
    """One row per run and guardrail; a missing or non-finite metric blocks."""
    checks = F.array(
        *[
            F.struct(
                F.lit(name).alias("guardrail"),
                F.lit(float(least)).alias("minimum_value"),
                F.col("metrics").getItem(name).alias("actual_value"),
            )
            for name, least in limits.items()
        ]
    )
    value = F.col("actual_value")
    usable = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
    approved = F.coalesce(usable & (value >= F.col("minimum_value")), F.lit(False))
    return (
        run.select("run_id", F.explode(checks).alias("_c"))
        .select("run_id", "_c.*")
        .withColumn("approved", approved)
        .withColumn("status", F.when(F.col("approved"), "APPROVED").otherwise("BLOCKED"))
    )


def promotion(checked: DataFrame) -> DataFrame:
    return checked.groupBy("run_id").agg(
        F.when(F.bool_and("approved"), "APPROVED").otherwise("BLOCKED").alias("promotion_status")
    )


def enforce_guardrails(checked: DataFrame) -> None:
    blocked = checked.filter(~F.col("approved")).collect()
    if blocked:
        raise ValueError(
            "promotion blocked: "
            + ", ".join(f"{r['guardrail']}={r['actual_value']}" for r in blocked)
        )


def _newest(tables: Tables, model_name: str, alias: str | None = None) -> int:
    """The last version of a model, or of those registered for an alias; 0 if there is none."""
    if not tables.exists("registry", "versions"):
        return 0
    own = tables.read("registry", "versions").filter(F.col("model_name") == model_name)
    if alias is not None:
        own = own.filter(F.col("tags")["alias"] == alias)
    return own.agg(F.max("model_version")).first()[0] or 0


def register(
    tables: Tables,
    model_name: str,
    run: Mapping,
    description: str = "",
    tags: Mapping[str, str] | None = None,
    alias: str = CHAMPION,
) -> ModelInfo:
    """Add a version for a run's model and point the alias at it.

    The number is claimed, so no two registrations share one. Of registrations at the same
    time the alias ends at the last version, in whatever order they finish.
    """
    version = tables.claim_number(f"{model_name}/version", _newest(tables, model_name) + 1)
    row = (
        run["run_id"],
        run["model_path"],
        description,
        {**(tags or {}), "alias": alias},
        _now(),
        model_name,
        version,
    )
    tables.write_entry(
        tables.spark.createDataFrame([row], VERSION_SCHEMA),
        "registry", "versions", model_name=model_name, model_version=version,
    )
    moved = version
    set_alias(tables, model_name, moved, alias)
    while (newest := _newest(tables, model_name, alias)) > moved:
        moved = newest
        set_alias(tables, model_name, moved, alias)
    return ModelInfo(model_name, str(version), alias, run["run_id"])


def set_alias(tables: Tables, model_name: str, version: int, alias: str = CHAMPION) -> None:
    """A move is a row with a claimed number; the alias is where its last move put it."""
    last = 0
    if tables.exists("registry", "aliases"):
        own = (F.col("model_name") == model_name) & (F.col("alias") == alias)
        last = tables.read("registry", "aliases").filter(own).agg(F.max("move")).first()[0] or 0
    move = tables.claim_number(f"{model_name}/alias-{alias}", last + 1)
    row = tables.spark.createDataFrame([(version, model_name, alias, move)], MOVE_SCHEMA)
    tables.write_entry(row, "registry", "aliases", model_name=model_name, alias=alias, move=move)


def aliases(tables: Tables) -> DataFrame:
    """The version each alias of each model stands at."""
    moves = tables.read("registry", "aliases")
    return moves.groupBy("model_name", "alias").agg(
        F.max_by("model_version", "move").alias("model_version")
    )


def load(
    tables: Tables, model_name: str, alias: str = CHAMPION
) -> tuple[PipelineModel, ModelInfo]:
    """The model behind an alias, checked against the feature contract."""
    if not tables.exists("registry", "aliases"):
        raise ValueError(f"no model {model_name} with alias {alias}")
    found = (
        aliases(tables)
        .filter((F.col("model_name") == model_name) & (F.col("alias") == alias))
        .join(tables.read("registry", "versions"), ["model_name", "model_version"])
        .first()
    )
    if found is None:
        raise ValueError(f"no model {model_name} with alias {alias}")
    model = PipelineModel.load(found["model_path"])
    check_features(model, FEATURES)
    return model, ModelInfo(
        model_name, str(found["model_version"]), alias, found["source_run_id"]
    )


def read_runs(spark: SparkSession, tables: Tables) -> DataFrame:
    if tables.exists("registry", "runs"):
        return tables.read("registry", "runs")
    return spark.createDataFrame([], RUN_SCHEMA)
