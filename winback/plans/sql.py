"""Direct SQL definitions the results are checked against.

Each text follows the plain definition: lines are joined to every later date, ranks come
from one window. Common table expressions that a text does not use are not run.
"""

from __future__ import annotations

_STEPS = """
mapped AS (
  SELECT
    CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || CAST(o_orderkey AS VARCHAR) AS "Invoice",
    CASE WHEN p_size = 1 THEN 'TEST' ELSE '' END || CAST(l_partkey AS VARCHAR) AS "StockCode",
    CASE WHEN p_size = 2 THEN 'Discount' WHEN p_size = 3 THEN NULL ELSE p_name END AS "Description",
    CASE WHEN l_returnflag = 'R' THEN -CAST(l_quantity AS INTEGER)
         ELSE CAST(l_quantity AS INTEGER) END AS "Quantity",
    CAST(o_orderdate AS TIMESTAMP) AS "InvoiceDate",
    CAST(CASE WHEN o_orderkey % 97 = 0 THEN 0
         ELSE CAST(p_retailprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) END
         AS DECIMAL(16,4)) AS "Price",
    CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE o_custkey END AS "Customer ID",
    n_name AS "Country"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
),
bronze AS (
  SELECT * FROM mapped WHERE "InvoiceDate" < TIMESTAMP '1999-01-01'
  UNION ALL
  SELECT * FROM mapped WHERE "InvoiceDate" >= TIMESTAMP '1998-12-01'
),
renamed AS (
  SELECT "Invoice" AS invoice, "StockCode" AS stock_code, "Description" AS description,
    "Quantity" AS quantity, "InvoiceDate" AS invoice_date, "Price" AS price,
    "Customer ID" AS customer_id, "Country" AS country
  FROM bronze
),
silver AS (SELECT DISTINCT * FROM renamed WHERE customer_id IS NOT NULL),
flagged AS (
  SELECT *, invoice LIKE 'C%' AS is_cancelled, stock_code LIKE 'TEST%' AS is_test,
    description = 'Discount' AS is_discount, quantity * price AS total_amount,
    price = 0 AS is_zero_price, quantity = 0 AS is_zero_quantity,
    CAST(invoice_date AS DATE) AS purchase_date
  FROM silver
),
modeling AS (
  SELECT * FROM flagged
  WHERE NOT is_cancelled AND NOT is_test AND NOT is_zero_price AND NOT is_zero_quantity
),
strict AS (
  SELECT * FROM flagged
  WHERE NOT is_cancelled AND NOT is_test AND NOT is_discount AND price > 0 AND quantity > 0
),
ref_dates AS (
  SELECT CAST(unnest(generate_series(TIMESTAMP '1999-10-08', TIMESTAMP '2001-06-08',
    INTERVAL 1 MONTH)) AS DATE) AS reference_date
),
history AS (
  SELECT customer_id, reference_date, invoice, stock_code, country, quantity, total_amount,
    purchase_date
  FROM modeling JOIN ref_dates ON purchase_date <= reference_date
),
state AS (
  SELECT customer_id, reference_date, count(*) AS lines_so_far,
    max(purchase_date) AS last_purchase_date,
    CAST(reference_date - max(purchase_date) AS INTEGER) AS inactive_days
  FROM history GROUP BY customer_id, reference_date
),
population AS (
  SELECT customer_id, reference_date, last_purchase_date, inactive_days, lines_so_far,
    CASE WHEN EXISTS (SELECT 1 FROM modeling m WHERE m.customer_id = s.customer_id
      AND m.purchase_date > s.reference_date AND m.purchase_date <= s.reference_date + 30)
    THEN 1 ELSE 0 END AS target_reactivated_30d
  FROM state s WHERE inactive_days >= 60
),
base_sums AS (
  SELECT customer_id, reference_date, min(purchase_date) AS first_purchase_date,
    count(DISTINCT invoice) AS number_orders, CAST(sum(quantity) AS BIGINT) AS total_items,
    CAST(sum(total_amount) AS DOUBLE) AS total_spent,
    count(DISTINCT stock_code) AS unique_products,
    count(DISTINCT country) AS distinct_countries
  FROM history GROUP BY customer_id, reference_date
),
base AS (
  SELECT p.customer_id, p.reference_date, last_purchase_date, inactive_days,
    target_reactivated_30d, first_purchase_date, number_orders, total_items, total_spent,
    unique_products, distinct_countries,
    CAST(p.reference_date - first_purchase_date AS INTEGER) AS customer_tenure_days,
    total_spent / number_orders AS average_ticket,
    total_spent / distinct_countries AS average_amount_per_country,
    total_spent / unique_products AS average_amount_per_stock_code
  FROM population p JOIN base_sums f
    ON p.customer_id = f.customer_id AND p.reference_date = f.reference_date
),
split_base AS (
  SELECT *, CASE WHEN reference_date <= DATE '2000-12-08' THEN 'train'
    WHEN reference_date <= DATE '2001-03-08' THEN 'valid' ELSE 'test' END AS split
  FROM base
),
rule_base AS (
  SELECT *, CAST(number_orders AS DOUBLE) / (CAST(number_orders AS DOUBLE) + inactive_days / 30.0::DOUBLE)
    AS reactivation_probability
  FROM split_base
),
round_dates AS (
  SELECT unnest([DATE '2001-05-08', DATE '2001-06-08', DATE '2001-08-01']) AS scoring_date
),
round_sums AS (
  SELECT customer_id, scoring_date, min(purchase_date) AS first_purchase_date,
    max(purchase_date) AS last_purchase_date, count(DISTINCT invoice) AS number_orders,
    CAST(sum(quantity) AS BIGINT) AS total_items,
    CAST(sum(total_amount) AS DOUBLE) AS total_spent,
    count(DISTINCT stock_code) AS unique_products,
    count(DISTINCT country) AS distinct_countries
  FROM strict JOIN round_dates ON purchase_date <= scoring_date
  GROUP BY customer_id, scoring_date
),
round_features AS (
  SELECT customer_id, scoring_date, first_purchase_date, last_purchase_date,
    CAST(scoring_date - last_purchase_date AS INTEGER) AS inactive_days, number_orders,
    total_items, total_spent, unique_products, distinct_countries,
    CAST(scoring_date - first_purchase_date AS INTEGER) AS customer_tenure_days,
    total_spent / number_orders AS average_ticket,
    total_spent / distinct_countries AS average_amount_per_country,
    total_spent / unique_products AS average_amount_per_stock_code
  FROM round_sums WHERE scoring_date - last_purchase_date >= 60
),
round_input AS (
  SELECT customer_id, scoring_date, first_purchase_date, last_purchase_date,
    CAST(inactive_days AS DOUBLE) AS inactive_days, CAST(number_orders AS DOUBLE) AS number_orders,
    CAST(total_items AS DOUBLE) AS total_items, total_spent,
    CAST(unique_products AS DOUBLE) AS unique_products,
    CAST(distinct_countries AS DOUBLE) AS distinct_countries,
    CAST(customer_tenure_days AS DOUBLE) AS customer_tenure_days, average_ticket,
    average_amount_per_country, average_amount_per_stock_code
  FROM round_features
),
round_scores AS (
  SELECT *, number_orders / (number_orders + inactive_days / 30.0::DOUBLE)
    AS reactivation_probability
  FROM round_input
),
round_ranked AS (
  SELECT *, CASE WHEN reactivation_probability >= 0.5 THEN 1 ELSE 0 END AS prediction_0_5,
    row_number() OVER (PARTITION BY scoring_date
      ORDER BY reactivation_probability DESC, customer_id) AS score_rank,
    CAST(row_number() OVER (PARTITION BY scoring_date
      ORDER BY reactivation_probability DESC, customer_id) AS DOUBLE)
      / count(*) OVER (PARTITION BY scoring_date) AS score_percentile
  FROM round_scores
),
scores AS (
  SELECT *, CASE WHEN score_percentile <= 0.10::DOUBLE THEN 'TOP_10'
      WHEN score_percentile <= 0.20::DOUBLE THEN 'TOP_20'
      WHEN score_percentile <= 0.30::DOUBLE THEN 'TOP_30' ELSE 'REMAINDER' END AS priority_group,
    'frequency_recency' AS model_name, '1' AS model_version, 'champion' AS model_alias,
    'rule' AS source_run_id
  FROM round_ranked
)
"""


def with_steps(body: str, extra: str = "") -> str:
    """A query over the common steps, optionally with further steps of its own."""
    return f"WITH {_STEPS.strip()}{', ' + extra.strip() if extra else ''}\n{body.strip()}"


FEATURE_LIST = (
    "inactive_days, number_orders, total_items, total_spent, unique_products, "
    "distinct_countries, customer_tenure_days, average_ticket, average_amount_per_country, "
    "average_amount_per_stock_code"
)


def metric_steps(source: str, group: str, keys: str, score: str = "reactivation_probability") -> str:
    """Steps that end in `evaluated`: every metric per group."""
    top = []
    for k in (10, 20, 30):
        hits = f"coalesce(sum(y) FILTER (r <= greatest(1, ceil(n * {k / 100}::DOUBLE))), 0)"
        size = f"greatest(1, ceil(max(n) * {k / 100}::DOUBLE))"
        top.append(
            f"CAST({hits} AS DOUBLE) / {size} AS precision_at_{k}pct, "
            f"coalesce(CAST({hits} AS DOUBLE) / nullif(sum(y), 0), 0) AS recall_at_{k}pct, "
            f"coalesce(CAST({hits} AS DOUBLE) / {size} / nullif(avg(y), 0), 0) AS lift_at_{k}pct"
        )
    return f"""
marked AS (
  SELECT {group}, CAST({score} AS DOUBLE) AS s, CAST(target_reactivated_30d AS BIGINT) AS y,
    CASE WHEN {score} >= 0.5 THEN 1 ELSE 0 END AS c,
    row_number() OVER (PARTITION BY {group} ORDER BY {score} DESC, {keys}) AS r,
    count(*) OVER (PARTITION BY {group}) AS n
  FROM {source}
),
points AS (
  SELECT {group}, s, sum(y) AS pos, count(*) - sum(y) AS neg,
    sum(sum(y)) OVER w AS tp_so_far, sum(count(*)) OVER w AS n_so_far
  FROM marked GROUP BY {group}, s
  WINDOW w AS (PARTITION BY {group} ORDER BY s DESC)
),
curves AS (
  SELECT {group},
    CASE WHEN sum(pos) > 0 THEN sum(pos * CAST(tp_so_far AS DOUBLE) / n_so_far) / sum(pos)
      ELSE 0 END AS pr_auc,
    CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN
      sum(CAST(neg AS DOUBLE) * (tp_so_far - pos / 2.0)) / sum(pos) / sum(neg) END AS roc_auc
  FROM points GROUP BY {group}
),
cells AS (
  SELECT {group}, count(*) AS row_count, avg(y) AS positive_rate,
    avg(c) AS predicted_positive_rate, avg((s - y) * (s - y)) AS brier_score,
    count(*) FILTER (y = 0 AND c = 0) AS true_negative,
    count(*) FILTER (y = 0 AND c = 1) AS false_positive,
    count(*) FILTER (y = 1 AND c = 0) AS false_negative,
    count(*) FILTER (y = 1 AND c = 1) AS true_positive,
    {', '.join(top)}
  FROM marked GROUP BY {group}
),
evaluated AS (
  SELECT *,
    coalesce(CAST(true_positive AS DOUBLE) / nullif(true_positive + false_positive, 0), 0) AS "precision",
    coalesce(CAST(true_positive AS DOUBLE) / nullif(true_positive + false_negative, 0), 0) AS recall,
    coalesce(2.0 * true_positive
      / nullif(2 * true_positive + false_positive + false_negative, 0), 0) AS f1
  FROM cells JOIN curves USING ({group})
)
"""


ROUNDED_METRICS = (
    "positive_rate",
    "predicted_positive_rate",
    "pr_auc",
    "roc_auc",
    "brier_score",
    "precision",
    "recall",
    "f1",
    *[f"{m}_at_{k}pct" for k in (10, 20, 30) for m in ("precision", "recall", "lift")],
)


def rounded(names, digits: int = 6) -> str:
    return ", ".join(f'round(CAST("{n}" AS DOUBLE), {digits}) AS "{n}"' for n in names)
