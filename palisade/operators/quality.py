"""Quality gates, alarms over time windows, data-quality baselines, registry tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.functions.numeric import col, finite
from palisade.operators.evaluation import binary_quality

HOUR = "1 hour"

# Alarm limits.
F2_FLOOR = 0.8
DRIFT_CEILING = 1.0
IMPACT_CORRIDOR = (0.8, 1.25)


def hour_start(when: str | Column, span: str = HOUR) -> Column:
    return F.window(col(when), span)["start"].alias("hour")


# ---- gates ------------------------------------------------------------------


def gate_results(metrics: DataFrame, gates: Sequence[tuple[str, float, str]]) -> DataFrame:
    """Value against threshold per gate; a missing metric fails.

    ``metrics`` has (metric, value); a gate is (metric, threshold, 'max' or 'min').
    """
    table = metrics.sparkSession.createDataFrame(
        [(m, float(t), d) for m, t, d in gates], "metric string, threshold double, direction string"
    )
    passed = F.when(F.col("direction") == "max", F.col("value") <= F.col("threshold")).otherwise(
        F.col("value") >= F.col("threshold")
    )
    return table.join(metrics.select("metric", "value"), "metric", "left").withColumn(
        "passed", F.coalesce(passed, F.lit(False))
    )


def overall_gate(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count("*").alias("gates"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.bool_and("passed").alias("passed"),
    )


def step_outcome(steps: DataFrame, order: str = "step", name: str = "name") -> DataFrame:
    """Overall result of ordered steps; skipped ones count as passed."""
    fine = F.col("passed") | F.col("skipped")
    return steps.agg(
        F.count("*").alias("steps"),
        F.count_if("skipped").alias("skipped"),
        F.bool_and(fine).alias("passed"),
        F.min_by(F.when(~fine, col(name)), F.when(~fine, col(order))).alias("first_failure"),
    )


# ---- hourly alarms ----------------------------------------------------------


def hourly_quality(
    df: DataFrame, when: str, truth: Column, predicted: Column, beta: float = 2.0, span: str = HOUR
) -> DataFrame:
    """Confusion counts and F-beta of every hour."""
    return binary_quality(df, truth, predicted, [hour_start(when, span)], beta)


def f2_alarm(quality: DataFrame, floor: float = F2_FLOOR) -> DataFrame:
    return quality.withColumn("breached", F.col("fbeta") < floor)


def drift_alarm(distances: DataFrame, by: Sequence[str], ceiling: float = DRIFT_CEILING) -> DataFrame:
    """Largest feature distance per period against the ceiling."""
    return distances.groupBy(*by).agg(F.max("distance").alias("max_distance")).withColumn(
        "breached", F.col("max_distance") >= ceiling
    )


def disparate_impact(
    df: DataFrame, when: str, facet: Column, positive: Column, corridor: tuple[float, float] = IMPACT_CORRIDOR, span: str = HOUR
) -> DataFrame:
    """Positive rate of the facet over that of the rest per hour, and the corridor test."""
    rates = df.groupBy(hour_start(when, span)).agg(
        F.avg(F.when(facet, positive.cast("int"))).alias("rate_facet"),
        F.avg(F.when(~facet, positive.cast("int"))).alias("rate_rest"),
    )
    ratio = rates.withColumn("impact", F.try_divide(F.col("rate_facet"), F.col("rate_rest")))
    return ratio.withColumn(
        "breached", (F.col("impact") < corridor[0]) | (F.col("impact") > corridor[1])
    )


# ---- data quality -----------------------------------------------------------


def baseline(df: DataFrame) -> DataFrame:
    """Per column: type, completeness, and range and moments of numeric ones.

    Works as the suggested constraints for later data.  One pass over the table.
    """
    parts, fields = [], list(df.schema)
    for i, field in enumerate(fields):
        numeric = isinstance(field.dataType, T.NumericType)
        value = finite(field.name) if numeric else F.lit(None).cast("double")
        parts += [
            F.avg(col(field.name).isNotNull().cast("int")).alias(f"c{i}"),
            F.min(value).alias(f"lo{i}"),
            F.max(value).alias(f"hi{i}"),
            F.avg(value).alias(f"m{i}"),
            F.stddev_samp(value).alias(f"s{i}"),
        ]
    entries = [
        F.struct(
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.col(f"c{i}").alias("completeness"),
            F.col(f"lo{i}").alias("min"),
            F.col(f"hi{i}").alias("max"),
            F.col(f"m{i}").alias("mean"),
            F.col(f"s{i}").alias("std"),
        )
        for i, field in enumerate(fields)
    ]
    return df.agg(*parts).select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def violations(constraints: DataFrame, profile: DataFrame) -> DataFrame:
    """Broken constraints of a new profile: type, completeness, range, lost column."""
    now = profile.select(
        "column",
        *[F.col(c).alias(f"now_{c}") for c in ("type", "completeness", "min", "max")],
    )
    both = constraints.join(now, "column", "left")
    gone = F.col("now_type").isNull()
    checks = [
        F.when(gone, F.lit("missing_column")),
        F.when(F.col("type") != F.col("now_type"), F.lit("type")),
        F.when(F.col("now_completeness") < F.col("completeness"), F.lit("completeness")),
        F.when(F.col("now_min") < F.col("min"), F.lit("below_min")),
        F.when(F.col("now_max") > F.col("max"), F.lit("above_max")),
    ]
    return both.select("column", F.explode(F.array_compact(F.array(*checks))).alias("violation"))


def joined_predictions(predictions: DataFrame, truth: DataFrame, key: str) -> DataFrame:
    """Captured predictions merged with ground truth on the inference id."""
    return predictions.join(truth, key)


# ---- registry ---------------------------------------------------------------


def model_versions(packages: DataFrame) -> DataFrame:
    """Flat comparison table of registry packages, newest first.

    Expects version, status, approval, created (text), description and
    containers, an array of structs with image and model_url.  The first container
    counts; the file part of its paths is shown, ``N/A`` where there is none.
    """

    def last_part(field: str) -> Column:
        path = F.get("containers", F.lit(0))[field]
        return F.coalesce(F.element_at(F.split(path, "/"), -1), F.lit("N/A"))

    return packages.select(
        "version",
        "status",
        "approval",
        last_part("image").alias("image"),
        last_part("model_url").alias("model_data"),
        F.substring("created", 1, 10).alias("created"),
        F.coalesce("description", F.lit("N/A")).alias("description"),
    ).orderBy(F.desc("created"), F.desc("version"))


def trigger_record(df: DataFrame, defaults: Mapping[str, str] | None = None) -> DataFrame:
    """JSON text of a detection: attack_type, confidence, mse_error, timestamp."""
    defaults = defaults or {}
    return df.select(
        F.to_json(
            F.struct(
                F.coalesce("attack_type", F.lit(defaults.get("attack_type", "UNKNOWN"))).alias("attack_type"),
                F.coalesce("confidence", F.lit(float(defaults.get("confidence", 0.0)))).alias("confidence"),
                F.coalesce("mse_error", F.lit(float(defaults.get("mse_error", 0.0)))).alias("mse_error"),
                F.coalesce("timestamp", F.lit(defaults.get("timestamp", "unknown"))).alias("timestamp"),
            )
        ).alias("record")
    )
