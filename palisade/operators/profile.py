"""Column profiles of wide tables.

Wide numeric tables are turned into (feature, value) rows with ``unpivot``, which
adds no shuffle, and then aggregated once per feature.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palisade.functions.numeric import clip, col, finite, is_infinite, min_max
from palisade.operators.ordered import attach, sized_broadcast
from palisade.operators.prep import repeatable_sample
from palisade.operators.quantiles import quantile_columns

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
SUMMARY = {**QUARTILES, "p95": 0.95, "p99": 0.99}
ERROR_SUMMARY = {"p50": 0.5, "p95": 0.95, "p99": 0.99, "p99_9": 0.999}


def long_form(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., feature, value) rows of the wide table, values as doubles."""
    wide = df.select(*[col(k) for k in keep], *[col(f).cast("double").alias(f) for f in features])
    return wide.unpivot([col(k) for k in keep], [col(f) for f in features], "feature", "value")


def feature_summary(
    df: DataFrame, features: Sequence[str], by: Sequence[str] = (), method: str = "ranks"
) -> DataFrame:
    """count, mean, std, min, max and quantiles per feature; NaN and Inf ignored."""
    rows = long_form(df, features, by)
    keys = [*by, "feature"]
    moments = rows.groupBy(*keys).agg(
        F.count(finite("value")).alias("count"),
        F.avg(finite("value")).alias("mean"),
        F.stddev_samp(finite("value")).alias("std"),
        F.min(finite("value")).alias("min"),
        F.max(finite("value")).alias("max"),
    )
    return attach(moments, quantile_columns(rows, "value", SUMMARY, keys, method), keys)


def missing_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features with missing values (null, NaN, infinite): count and percent."""
    counted = long_form(df, features).groupBy("feature").agg(
        F.count_if(finite("value").isNull()).alias("missing"), F.count("*").alias("rows")
    )
    return (
        counted.where("missing > 0")
        .select("feature", "missing", (F.col("missing") * 100.0 / F.col("rows")).alias("pct"))
        .orderBy(F.desc("pct"), "feature")
    )


def infinite_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features with infinite values: count and percent."""
    counted = long_form(df, features).groupBy("feature").agg(
        F.count_if(is_infinite("value")).alias("infinite"), F.count("*").alias("rows")
    )
    return (
        counted.where("infinite > 0")
        .select("feature", "infinite", (F.col("infinite") * 100.0 / F.col("rows")).alias("pct"))
        .orderBy(F.desc("pct"), "feature")
    )


def zero_share(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Percent of zeros among the finite values of each feature."""
    value = finite("value")
    return long_form(df, features).groupBy("feature").agg(
        (F.avg(F.when(value.isNotNull(), (value == 0).cast("int"))) * 100.0).alias("zero_pct")
    )


def null_map(df: DataFrame, features: Sequence[str], rows: int | None = 5000, key: Sequence[str] = ()) -> DataFrame:
    """Which features have a missing value, in a repeatable sample or everywhere."""
    if rows:
        df = repeatable_sample(df, rows, key)
    return long_form(df, features).groupBy("feature").agg(
        F.bool_or(finite("value").isNull()).alias("has_missing")
    )


def variances(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return long_form(df, features).groupBy("feature").agg(
        F.var_samp(finite("value")).alias("variance")
    )


def clip_bounds(
    df: DataFrame, features: Sequence[str], low: float = 0.01, high: float = 0.99, method: str = "ranks"
) -> DataFrame:
    """(feature, low, high) quantiles: one row per feature."""
    rows = long_form(df, features)
    return quantile_columns(rows, "value", {"low": low, "high": high}, ["feature"], method)


def clipped_long(
    df: DataFrame,
    features: Sequence[str],
    keep: Sequence[str] = (),
    low: float = 0.01,
    high: float = 0.99,
    method: str = "ranks",
) -> DataFrame:
    """Long form with values clipped to the feature's quantile range.

    The bounds have one row per feature, so the join needs no shuffle of the data.
    """
    bounds = clip_bounds(df, features, low, high, method)
    rows = long_form(df, features, keep).withColumn("value", finite("value"))
    return (
        rows.join(F.broadcast(bounds), "feature")
        .withColumn("value", clip("value", F.col("low"), F.col("high")))
        .drop("low", "high")
    )


def within_bounds(
    df: DataFrame,
    features: Sequence[str],
    keep: Sequence[str] = (),
    low: float = 0.01,
    high: float = 0.99,
    method: str = "ranks",
) -> DataFrame:
    """Long form restricted to values inside the feature's quantile range."""
    bounds = clip_bounds(df, features, low, high, method)
    return (
        long_form(df, features, keep)
        .join(F.broadcast(bounds), "feature")
        .where(F.col("value").between(F.col("low"), F.col("high")))
        .drop("low", "high")
    )


def shape(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Population skewness and excess kurtosis of the clipped features."""
    return clipped_long(df, features).groupBy("feature").agg(
        F.skewness("value").alias("skew"), F.kurtosis("value").alias("kurtosis")
    )


def histogram(rows: DataFrame, bins: int, by: str = "feature", value: str = "value") -> DataFrame:
    """Equal-width counts between each group's minimum and maximum.

    ``rows`` is in long form.  Group ranges are one row per group; the maximum is
    counted in the last bin.  Bins are numbered from 1; empty bins have no row.
    """
    ranges, _ = sized_broadcast(
        rows.groupBy(by).agg(F.min(value).alias("low"), F.max(value).alias("high"))
    )
    number = F.when(F.col("low") == F.col("high"), F.lit(1)).otherwise(
        F.least(F.width_bucket(col(value), F.col("low"), F.col("high"), F.lit(bins)), F.lit(bins))
    )
    return (
        rows.where(col(value).isNotNull())
        .join(ranges, by)
        .groupBy(by, "low", "high", number.cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def box_statistics(
    df: DataFrame,
    features: Sequence[str],
    by: str,
    low: float | None = 0.01,
    high: float | None = 0.99,
    method: str = "ranks",
) -> DataFrame:
    """Quartiles and whiskers per class and feature, optionally inside a quantile range."""
    if low is None:
        rows = long_form(df, features, [by]).withColumn("value", finite("value"))
    else:
        rows = within_bounds(df, features, [by], low, high, method)
    keys = [by, "feature"]
    quartile = quantile_columns(rows, "value", QUARTILES, keys, method)
    fences = quartile.withColumns(
        {
            "fence_low": F.col("p25") - 1.5 * (F.col("p75") - F.col("p25")),
            "fence_high": F.col("p75") + 1.5 * (F.col("p75") - F.col("p25")),
        }
    )
    fences, _ = sized_broadcast(fences)
    inside = F.col("value").between(F.col("fence_low"), F.col("fence_high"))
    whiskers = (
        attach(rows, fences, keys)
        .groupBy(*keys)
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )
    return attach(fences.drop("fence_low", "fence_high"), whiskers, keys)


def density(rows: DataFrame, points: int = 200, bins: int = 512, by: str = "feature") -> DataFrame:
    """Gaussian density per group on an even grid between minimum and maximum.

    Values are first counted in ``bins`` equal bins, so the kernel sum costs
    bins x points per group whatever the number of rows.  Bandwidth is the usual
    std * n^(-1/5).
    """
    stats = rows.groupBy(by).agg(
        F.count("value").alias("rows"),
        F.stddev_samp("value").alias("std"),
    )
    counted = histogram(rows, bins, by)
    width = (F.col("high") - F.col("low")) / F.lit(bins)
    centres = counted.select(
        by,
        "low",
        "high",
        (F.col("low") + (F.col("bin") - 0.5) * width).alias("centre"),
        "n",
    ).join(stats, by)
    bandwidth = F.col("std") * F.pow(F.col("rows"), F.lit(-0.2))
    grid = centres.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    x = F.col("low") + (F.col("high") - F.col("low")) * F.col("point") / F.lit(points - 1)
    scaled = (F.col("x") - F.col("centre")) / F.col("h")
    return (
        grid.withColumns({"x": x, "h": bandwidth})
        .where("h > 0")
        .groupBy(by, "point", "x", "rows", "h")
        .agg(F.sum(F.col("n") * F.exp(-scaled * scaled / 2)).alias("mass"))
        .select(
            by,
            "point",
            "x",
            (F.col("mass") / (F.col("rows") * F.col("h") * F.sqrt(2 * F.pi()))).alias("density"),
        )
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Number of rows that repeat an earlier one."""
    counts = df.groupBy(*[col(c) for c in df.columns]).agg(F.count("*").alias("__n"))
    return counts.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicates"))


def column_counts(df: DataFrame) -> DataFrame:
    """Distinct count and missing ratio per column, most incomplete first."""
    parts = []
    for index, name in enumerate(df.columns):
        parts += [
            F.count_distinct(col(name)).alias(f"d{index}"),
            F.avg(col(name).isNull().cast("int")).alias(f"m{index}"),
        ]
    entries = [
        F.struct(
            F.lit(name).alias("column"),
            F.col(f"d{index}").alias("distinct"),
            F.col(f"m{index}").alias("missing_ratio"),
        )
        for index, name in enumerate(df.columns)
    ]
    return (
        df.agg(*parts)
        .select(F.explode(F.array(*entries)).alias("e"))
        .select("e.*")
        .orderBy(F.desc("missing_ratio"), "column")
    )


def rows_per_key(df: DataFrame, key: str, method: str = "ranks") -> DataFrame:
    """Describe the number of rows per key value: one row."""
    counts = df.groupBy(key).agg(F.count("*").cast("double").alias("rows"))
    return feature_summary(counts, ["rows"], method=method).select(
        "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def constant_columns(df: DataFrame) -> list[str]:
    """Columns with one distinct value; reads one row of minima and maxima.

    Runs a job, because the answer decides which columns a plan has.
    """
    names = df.columns
    ends = df.agg(
        *[
            (F.count(col(n)) == 0).alias(f"e{i}")
            for i, n in enumerate(names)
        ],
        *[(F.min(col(n)) == F.max(col(n))).alias(f"c{i}") for i, n in enumerate(names)],
    ).first()
    return [n for i, n in enumerate(names) if not ends[f"e{i}"] and ends[f"c{i}"]]


def drop_constant(df: DataFrame) -> DataFrame:
    return df.drop(*constant_columns(df))


def error_summary(df: DataFrame, value: str, by: Sequence[str] = (), method: str = "ranks") -> DataFrame:
    """Mean, population deviation and high quantiles of an error column."""
    moments = df.groupBy(*by).agg(
        F.count(finite(value)).alias("n"),
        F.avg(finite(value)).alias("mean"),
        F.stddev_pop(finite(value)).alias("std"),
    )
    tails = quantile_columns(df, value, ERROR_SUMMARY, by, method)
    if by:
        return attach(moments, tails, list(by))
    # One row each, put side by side without a join.
    both = moments.unionByName(tails, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def scaled_share(df: DataFrame, value: str, by: Sequence[str], name: str, pad: float = 0.0) -> DataFrame:
    """Min-max of a small result column inside ``by`` (all rows when empty)."""
    group = Window.partitionBy(*by)
    return df.withColumn(
        name, min_max(value, F.min(value).over(group), F.max(value).over(group), pad)
    )


