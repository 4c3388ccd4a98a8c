"""Allow or block web addresses: rules first, a fitted model for the rest.

Built from DataFrame functions and Spark's own logistic regression only. Host and path are
cut out of the address; the longest rule whose host is the address's host or a parent
domain, and whose path begins the address's path, decides. Addresses under a rule are the
labelled table: a bounded number of them per verdict, by hash, fits a logistic regression
on hashed character n-grams of host and path, which judges the addresses under no rule.

A null address, or one without `://`, has an empty host and path, fits no rule, and is
judged like any other. If the labelled table lacks a verdict, the one it has is given to
all, and `allow` if it is empty. Rows are judged alone, whatever their number or copies, and
an address of any length as a whole, in time that grows with its length.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winback.session import materialise

ALLOW, BLOCK = "allow", "block"
# (verdict, host and path)
Rule = tuple[str, str]

FEATURES = 1 << 14
SIZES = (3, 4, 5)
PER_VERDICT = 1_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lowered; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(rule: str, host: Column, path: Column) -> Column:
    name, slash, rest = rule.partition("/")
    return ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)


def matched_rule(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null where none does."""
    longest = sorted(rules, key=lambda rule: (-len(rule[1]), rule[1]))
    chosen, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, rule in reversed(longest):
        fits = _fits(rule, host, path)
        chosen = F.when(fits, F.lit(rule)).otherwise(chosen)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return chosen, verdict


def character_n_grams(text: Column, sizes: Sequence[int] = SIZES) -> Column:
    """All character n-grams of a text; a shorter one counts as a whole.

    The text is cut into characters once and joined with itself shifted, so time grows with
    the length and not with its square.
    """
    characters, length = F.split(text, ""), F.greatest(F.length(text), F.lit(1))
    shifted = F.arrays_zip(*[F.slice(characters, F.lit(k + 1), length) for k in range(max(sizes))])

    def of(size: int) -> Column:
        grams = F.transform(shifted, lambda at: F.concat(*[at[str(k)] for k in range(size)]))
        return F.when(F.length(text) >= size, F.array_compact(grams)).otherwise(F.array(text))

    return reduce(F.concat, [of(size) for size in sizes])


def with_features(judged: DataFrame, features: int) -> DataFrame:
    """The hashed n-grams of `host` and `path`; `^` marks the beginning, a space the border."""
    grams = character_n_grams(F.concat(F.lit("^"), F.col("host"), F.lit(" "), F.col("path"), F.lit("$")))
    hashing = HashingTF(numFeatures=features, inputCol="_grams", outputCol="_features", binary=True)
    return hashing.transform(judged.withColumn("_grams", grams)).drop("_grams")


def labelled_addresses(ruled: DataFrame, per_verdict: int = PER_VERDICT) -> DataFrame:
    """A bounded table of distinct addresses under a rule, the first of each verdict by hash."""
    known = ruled.filter("verdict is not null").select("host", "path", "verdict").distinct()
    some = [
        known.filter(F.col("verdict") == verdict)
        .orderBy(F.xxhash64("host", "path"), "host", "path")
        .limit(per_verdict)
        for verdict in (ALLOW, BLOCK)
    ]
    return some[0].unionAll(some[1])


def fit(
    ruled: DataFrame, per_verdict: int = PER_VERDICT, features: int = FEATURES
) -> LogisticRegressionModel | str:
    """The model, or the only verdict there is."""
    labelled = labelled_addresses(ruled, per_verdict)
    labelled = labelled.withColumn("label", (F.col("verdict") == BLOCK).cast("double"))
    labelled = materialise(labelled, "labelled")
    seen = {r["verdict"] for r in labelled.groupBy("verdict").count().collect()}
    if len(seen) < 2:
        return next(iter(seen), ALLOW)
    learner = LogisticRegression(
        featuresCol="_features", labelCol="label", regParam=0.01, maxIter=50, standardization=False
    )
    return learner.fit(with_features(labelled, features))


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    per_verdict: int = PER_VERDICT,
    features: int = FEATURES,
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """page_id, host, path, the rule that fits, the verdict, and the model's probability of
    `block` (null if there is no model)."""
    url = F.col(url_column).cast("string")
    split = pages.select(
        F.col(id_column).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path")
    )
    rule, verdict = matched_rule(rules, F.col("host"), F.col("path"))
    ruled = split.withColumns({"rule": rule, "verdict": verdict})
    model = fit(ruled, per_verdict, features)
    if isinstance(model, str):
        return ruled.withColumns(
            {
                "verdict": F.coalesce("verdict", F.lit(model)),
                "block_probability": F.lit(None).cast("double"),
            }
        )
    model = model.setProbabilityCol("_probability").setRawPredictionCol("").setPredictionCol("")
    scored = model.transform(with_features(ruled, features))
    probability = F.get(vector_to_array("_probability"), F.lit(1))
    scored = scored.withColumn("block_probability", probability)
    guess = F.when(F.col("block_probability") >= 0.5, BLOCK).otherwise(ALLOW)
    return scored.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("verdict", guess).alias("verdict"),
        "block_probability",
    )
