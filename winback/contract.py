"""The fixed contract of the pipeline: parameters, schemas and names."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Business rules and thresholds that results depend on.
INACTIVE_DAYS = 60
OBSERVATION_DAYS = 180
PREDICTION_DAYS = 30
LABEL_THRESHOLD = 0.5
TOP_FRACTIONS = (0.10, 0.20, 0.30)
PSI_WARNING, PSI_CRITICAL = 0.10, 0.25
VOLUME_WARNING, VOLUME_CRITICAL = 0.30, 0.50
PSI_BINS = 10
PSI_EPSILON = 1e-6
GUARDRAILS = {"test_pr_auc": 0.30, "test_lift_at_10pct": 2.5}
EXPLANATION_SAMPLE = 2000
RANDOM_SEED = 19
SAMPLE_SEED = 42
CHAMPION = "champion"

# Column names that stored tables share; the month silver is stored by.
TARGET = "target_reactivated_30d"
PROBABILITY = "reactivation_probability"
MONTH = "invoice_month"

# Model features, in model order.
FEATURES = (
    "inactive_days",
    "number_orders",
    "total_items",
    "total_spent",
    "unique_products",
    "distinct_countries",
    "customer_tenure_days",
    "average_ticket",
    "average_amount_per_country",
    "average_amount_per_stock_code",
)

# Raw column names and their table names.
BRONZE_NAMES = {
    "Invoice": "invoice",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "Price": "price",
    "Customer ID": "customer_id",
    "Country": "country",
}

# The transaction row.
TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("invoice", T.StringType()),
        T.StructField("stock_code", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("invoice_date", T.TimestampNTZType()),
        T.StructField("price", T.DecimalType(16, 4)),
        T.StructField("customer_id", T.LongType()),
        T.StructField("country", T.StringType()),
    ]
)
TRANSACTION_COLUMNS = tuple(TRANSACTION_SCHEMA.fieldNames())

# Layers and tables addressed by logical key.
TABLES = {
    "bronze": ("transactions_i", "transactions_ii"),
    "silver": ("transactions",),
    "gold": (
        "modeling",
        "feature_snapshot",
        "reactivation_scores",
        "customer_state",
        "customer_seen",
    ),
    "synthetic": ("transactions", "generation_runs", "full_history"),
    "monitoring": ("summary", "feature_monitoring", "performance"),
    "explainability": ("global_feature_importance", "local_feature_contributions"),
    "registry": ("runs", "versions", "aliases"),
}

# Columns of the score table, in order.
SCORE_COLUMNS = (
    "customer_id",
    "scoring_date",
    "first_purchase_date",
    "last_purchase_date",
    *FEATURES,
    PROBABILITY,
    "prediction_0_5",
    "score_rank",
    "score_percentile",
    "priority_group",
    "model_name",
    "model_version",
    "model_alias",
    "source_run_id",
    "scored_at",
)


@dataclass(frozen=True)
class Parameters:
    """One run's settings; the defaults are fixed values of the contract."""

    inactive_days: int = INACTIVE_DAYS
    observation_days: int | None = None
    prediction_days: int = PREDICTION_DAYS
    label_threshold: float = LABEL_THRESHOLD
    rule: str = "modeling"


@dataclass(frozen=True)
class ModelInfo:
    """Provenance stamped on scored and explained rows."""

    name: str
    version: str
    alias: str = CHAMPION
    run_id: str = ""
