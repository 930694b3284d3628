"""Linear regression with one absorbed categorical effect (ML1-ML5)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclograph.operators.quantiles import exact_quantile
from cyclograph.session import materialize

LABEL = "trip_count"
FEATURES = ("crime_count_within_quarter_mile", "day_of_week", "month")
EFFECT = "station_id"


def training_rows(station_day: DataFrame, before: str | None = None, since: str | None = None) -> DataFrame:
    """Label, incident count, weekday (Sunday=1), month, station and date."""
    rows = station_day.select(
        LABEL,
        FEATURES[0],
        F.dayofweek("date_key").alias("day_of_week"),
        F.month("date_key").alias("month"),
        EFFECT,
        "date_key",
    )
    if before:
        rows = rows.filter(F.col("date_key") < F.lit(before).cast("date"))
    if since:
        rows = rows.filter(F.col("date_key") >= F.lit(since).cast("date"))
    return rows


def in_training_split(*keys: str, percent: int = 80) -> Column:
    """Reproducible split from a digest of the row's keys."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    bucket = F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("bigint") % 100
    return bucket < percent


def with_indicators(rows: DataFrame, column: str, levels: Sequence[int]) -> tuple[DataFrame, list[str]]:
    """0/1 columns for every level but the first, to treat a numeric feature as categorical."""
    names = [f"{column}_{level}" for level in list(levels)[1:]]
    flags = {n: (F.col(column) == level).cast("int") for n, level in zip(names, list(levels)[1:])}
    return rows.withColumns(flags), names


@dataclass
class FixedEffectModel:
    """Weights of the numeric inputs and a table with one effect per category."""

    features: list[str]
    weights: list[float]
    intercept: float
    effect: str
    effects: DataFrame  # (effect column, "category_weight"), relative to the intercept

    def weight_rows(self) -> DataFrame:
        """One row per input; categorical inputs have one row per category instead."""
        spark = self.effects.sparkSession
        numeric = [(f, None, float(w)) for f, w in zip(self.features, self.weights)]
        numeric.append(("__INTERCEPT__", None, float(self.intercept)))
        head = spark.createDataFrame(numeric, "processed_input string, category string, weight double")
        categories = self.effects.select(
            F.lit(self.effect).alias("processed_input"),
            F.col(self.effect).cast("string").alias("category"),
            F.col("category_weight").alias("weight"),
        )
        return head.unionByName(categories)

    def linear_part(self) -> Column:
        total = F.lit(float(self.intercept))
        for feature, weight in zip(self.features, self.weights):
            total = total + F.col(feature) * F.lit(float(weight))
        return total

    def predict(self, rows: DataFrame, name: str = "predicted_trip_count") -> DataFrame:
        """Unseen categories get the mean effect, i.e. none beside the intercept."""
        joined = rows.join(self.effects, self.effect, "left")
        return joined.select(
            *rows.columns,
            (self.linear_part() + F.coalesce("category_weight", F.lit(0.0))).alias(name),
            F.col("category_weight").isNotNull().alias("seen_station"),
        )


def fit(rows: DataFrame, label: str = LABEL, features: Sequence[str] = FEATURES, effect: str = EFFECT) -> FixedEffectModel:
    """Ordinary least squares with the category's means taken out.

    One aggregation by category yields its size, means and (co)variances; these merge
    on the map side, so a frequent category costs nothing extra. The within-category
    cross products are their size-weighted sums: a single row of k(k+3)/2 numbers comes
    to the driver, which solves the k x k system.
    """
    features = list(features)
    rows = rows.dropna(subset=[label, effect, *features])
    columns = [label, *features]
    double = {c: F.col(c).cast("double") for c in columns}
    n = F.count(F.lit(1))
    moments = {"__n": n}
    moments.update({f"__mean_{i}": F.avg(double[c]) for i, c in enumerate(columns)})
    for i in range(1, len(columns)):
        for j in range(0, i + 1):
            moments[f"__cross_{i}_{j}"] = n * F.covar_pop(double[columns[i]], double[columns[j]])
    # Read twice below, for the totals and for the effects.
    per_category = materialize(rows.groupBy(effect).agg(*[m.alias(k) for k, m in moments.items()]), "moments")

    pairs = [(i, j) for i in range(1, len(columns)) for j in range(0, i + 1)]
    totals = per_category.agg(
        F.sum("__n").alias("n"),
        *[F.sum(F.col("__n") * F.col(f"__mean_{i}")).alias(f"s{i}") for i in range(len(columns))],
        *[F.sum(f"__cross_{i}_{j}").alias(f"c{i}_{j}") for i, j in pairs],
    ).first()
    if not totals["n"]:
        raise ValueError("no complete training rows")
    k = len(features)
    gram, target = np.zeros((k, k)), np.zeros(k)
    for i, j in pairs:
        if j == 0:
            target[i - 1] = totals[f"c{i}_0"]
        else:
            gram[i - 1, j - 1] = gram[j - 1, i - 1] = totals[f"c{i}_{j}"]
    scale = np.sqrt(np.diag(gram))
    if (scale == 0).any() or np.linalg.matrix_rank(gram / np.outer(scale, scale)) < k:
        raise ValueError("singular system: an input is constant within every category or depends on others")
    weights = np.linalg.solve(gram, target)
    means = np.array([totals[f"s{i}"] for i in range(k + 1)]) / totals["n"]
    intercept = float(means[0] - means[1:] @ weights)
    own_level = F.col("__mean_0")
    for i, weight in enumerate(weights, start=1):
        own_level = own_level - F.col(f"__mean_{i}") * F.lit(float(weight))
    effects = per_category.select(effect, (own_level - F.lit(intercept)).alias("category_weight"))
    return FixedEffectModel(features, [float(w) for w in weights], intercept, effect, effects)


def evaluate(predictions: DataFrame, label: str = LABEL, predicted: str = "predicted_trip_count") -> DataFrame:
    """One row of hold-out metrics. Negative predictions enter the logarithmic error as 0."""
    scored = predictions.select(
        F.col(label).cast("double").alias("y"),
        F.col(predicted).alias("p"),
    ).withColumns({"e": F.col("y") - F.col("p"), "a": F.abs(F.col("y") - F.col("p"))})
    log_error = F.log1p("y") - F.log1p(F.greatest(F.col("p"), F.lit(0.0)))
    metrics = scored.agg(
        F.avg("a").alias("mean_absolute_error"),
        F.avg(F.col("e") * F.col("e")).alias("mean_squared_error"),
        F.avg(log_error * log_error).alias("mean_squared_log_error"),
        (1 - F.sum(F.col("e") * F.col("e")) / F.nullif(F.count(F.lit(1)) * F.var_pop("y"), F.lit(0.0))).alias("r2_score"),
        (1 - F.var_pop("e") / F.nullif(F.var_pop("y"), F.lit(0.0))).alias("explained_variance"),
    )
    metrics = metrics.withColumn("median_absolute_error", exact_quantile(scored, "a", 0.5).scalar())
    return metrics.select(
        "mean_absolute_error",
        "mean_squared_error",
        "mean_squared_log_error",
        "median_absolute_error",
        "r2_score",
        "explained_variance",
    )
