"""Rolling drift of value series and distances between periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.functions.flows import drift_severity
from palisade.functions.numeric import col, zscore
from palisade.operators.ordered import rolling

SPREAD_FLOOR = 1e-9


def rolling_stats(
    df: DataFrame,
    value: str,
    order: Sequence[Column],
    slot: Column,
    width: int,
    series: Sequence[str] = (),
    block_rows: int = 100_000,
) -> DataFrame:
    """Mean and population deviation of the last ``width`` values, and the 0-based index."""
    stats = rolling(
        df,
        {"mean": F.avg(value), "std": F.stddev_pop(value)},
        order,
        slot,
        width,
        series,
        block_rows,
        keep_position="index",
    )
    return stats.withColumn("index", F.col("index") - 1)


def with_drift(stats: DataFrame, value: str) -> DataFrame:
    return stats.withColumn("z_score", zscore(value, "mean", "std", SPREAD_FLOOR))


def drift_events(stats: DataFrame, value: str, limit: float = 3.0) -> DataFrame:
    """Rows further than ``limit`` deviations from their rolling mean."""
    return with_drift(stats, value).where(F.abs("z_score") > limit)


def drift_report(
    stats: DataFrame,
    value: str,
    width: int,
    limit: float = 3.0,
    series: Sequence[str] = (),
    listed: int = 50,
) -> DataFrame:
    """One row per series: totals, severity and the first ``listed`` events.

    Only the listed events are gathered; the row number filter keeps that many
    per series and task before the shuffle.
    """
    if not series:
        stats, series = stats.withColumn("series", F.lit("all")), ["series"]
    scored = with_drift(stats, value)
    is_event = F.abs("z_score") > limit
    totals = scored.groupBy(*series).agg(
        F.count("*").alias("samples"),
        F.round(F.avg(value), 6).alias("overall_mean"),
        F.round(F.stddev_pop(value), 6).alias("overall_std"),
        F.count_if(is_event).alias("drift_event_count"),
        F.round(F.count_if(is_event) * 100.0 / F.count("*"), 2).alias("drift_rate_pct"),
        drift_severity(F.avg(value)).alias("severity"),
    )
    place = F.row_number().over(Window.partitionBy(*series).orderBy("index"))
    events = (
        scored.where(is_event)
        .withColumn("__place", place)
        .where(F.col("__place") <= listed)
        .groupBy(*series)
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct("index", col(value).alias("value"), F.round("z_score", 4).alias("z_score"))
                )
            ).alias("drift_events")
        )
    )
    return totals.join(events, list(series), "left").withColumns({"window_size": F.lit(width), "z_threshold": F.lit(limit)})


def published_metrics(report: DataFrame, series: Sequence[str], namespace: str = "DriftDetection") -> DataFrame:
    """Report totals as (namespace, metric, value, unit) rows per series."""
    entries = F.array(
        F.struct(F.lit("DriftRatePct").alias("metric"), F.col("drift_rate_pct").alias("value"), F.lit("Percent").alias("unit")),
        F.struct(F.lit("MeanMSE").alias("metric"), F.col("overall_mean").alias("value"), F.lit("None").alias("unit")),
    )
    return report.select(
        F.lit(namespace).alias("namespace"), *series, F.explode(entries).alias("m")
    ).select("namespace", *series, "m.*")


def loss_history(df: DataFrame, loss: str, order: str, series: Sequence[str] = ()) -> DataFrame:
    """Best value so far and improvement over the previous row, per series.

    Meant for summaries with few rows per series (epochs, days).
    """
    frame = Window.partitionBy(*series).orderBy(order)
    return df.withColumns(
        {
            "best": F.min(loss).over(frame.rowsBetween(Window.unboundedPreceding, 0)),
            "improvement": F.lag(loss).over(frame) - col(loss),
        }
    )


def overall_improvement(df: DataFrame, loss: str, order: str, series: Sequence[str] = ()) -> DataFrame:
    """First, last and best value, improvement in total and per step."""
    first, last = F.min_by(loss, order), F.max_by(loss, order)
    return df.groupBy(*series).agg(
        F.count("*").alias("steps"),
        first.alias("first"),
        last.alias("last"),
        F.min(loss).alias("best"),
        (first - last).alias("improvement"),
        F.try_divide(first - last, F.count("*")).alias("per_step"),
        F.try_divide((first - last) * 100.0, first).alias("improvement_pct"),
    )


def mean_shift(baseline: DataFrame, current: DataFrame, value: str, by: Sequence[str], base_by: Sequence[str]) -> DataFrame:
    """|mean - baseline mean| / baseline deviation of each current group.

    1.0 means a shift by one baseline standard deviation.
    """
    base = baseline.groupBy(*base_by).agg(
        F.avg(value).alias("base_mean"), F.stddev_samp(value).alias("base_std")
    )
    now = current.groupBy(*by).agg(F.avg(value).alias("mean"), F.count("*").alias("n"))
    return now.join(base, list(base_by)).withColumn(
        "distance", F.abs(zscore("mean", "base_mean", "base_std"))
    )


def importance_distance(before: DataFrame, after: DataFrame, key: str = "feature", value: str = "importance") -> DataFrame:
    """Largest absolute difference between two importance tables, each scaled to sum 1."""

    def share(df: DataFrame, name: str) -> DataFrame:
        total = F.sum(value).over(Window.partitionBy())
        return df.select(key, F.try_divide(col(value), total).alias(name))

    both = share(before, "a").join(share(after, "b"), key)
    return both.agg(
        F.max(F.abs(F.col("a") - F.col("b"))).alias("max_shift"),
        F.sum(F.abs(F.col("a") - F.col("b"))).alias("total_shift"),
    )
