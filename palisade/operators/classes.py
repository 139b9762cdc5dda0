"""Class balance, class-by-day tables, class profiles and separation ranking.

Everything starts from counts or medians per class, which are as few as the
classes; the windows below run over those result rows, not over flows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.functions.flows import BENIGN, attack_family
from palisade.functions.numeric import clip, col, finite, magnitude_slot
from palisade.operators.ordered import attach, prefix_sums
from palisade.operators.profile import long_form, scaled_share
from palisade.operators.quantiles import interpolated, order_statistics, quantile_columns


def _all():
    return Window.partitionBy()


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows and percent per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(_all()))


def imbalance(df: DataFrame, label: str = "label") -> DataFrame:
    """Family, share and ratio of the largest class to each class."""
    counts = class_counts(df, label)
    return counts.select(
        label,
        attack_family(label).alias("family"),
        "n",
        F.round("pct", 4).alias("pct"),
        (F.max("n").over(_all()) / F.greatest(F.col("n"), F.lit(1))).alias("imbalance_ratio"),
    )


def class_by_day(df: DataFrame, label: str = "label", day: str = "day") -> DataFrame:
    """(class, day, n) for every combination, 0 where nothing was seen.

    The full grid comes from the distinct classes and days of the counts, by an
    array of days per class rather than a join of rows.
    """
    counts = df.groupBy(label, day).agg(F.count("*").alias("n"))
    days = F.array_sort(F.collect_set(day).over(_all()))
    known = (
        counts.withColumn("__days", days)
        .groupBy(label, "__days")
        .agg(F.map_from_entries(F.collect_list(F.struct(day, "n"))).alias("__seen"))
    )
    return known.select(label, "__seen", F.explode("__days").alias(day)).select(
        label, day, F.coalesce(F.col("__seen")[F.col(day)], F.lit(0)).alias("n")
    )


def class_day_pivot(df: DataFrame, days: Sequence, label: str = "label", day: str = "day") -> DataFrame:
    """Wide class-by-day counts for the named days, 0 where nothing was seen."""
    wide = df.groupBy(label).pivot(day, list(days)).agg(F.count(F.lit(1)))
    return wide.fillna(0)


def scaled_by_class(grid: DataFrame, label: str = "label") -> DataFrame:
    """Counts divided by the class maximum (a maximum of 0 counts as 1)."""
    peak = F.max("n").over(Window.partitionBy(label))
    return grid.withColumn("share", F.col("n") / F.when(peak == 0, 1).otherwise(peak))


def percent_by_day(grid: DataFrame, day: str = "day") -> DataFrame:
    """Counts as percent of the day's total."""
    total = F.sum("n").over(Window.partitionBy(day))
    return grid.withColumn("pct", F.try_divide(F.col("n") * 100.0, total))


def attack_share(df: DataFrame, label: str = "label", day: str = "day") -> DataFrame:
    """Rows, benign rows, attack rows and attack percent per day."""
    return df.groupBy(day).agg(
        F.count("*").alias("n_rows"),
        F.count_if(col(label) == BENIGN).alias("n_benign"),
        F.count_if(col(label) != BENIGN).alias("n_attack"),
    ).withColumn("attack_pct", F.try_divide(F.col("n_attack") * 100.0, F.col("n_rows")))


def family_totals(df: DataFrame, label: str = "label") -> DataFrame:
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    return counts.groupBy(attack_family(label).alias("family")).agg(F.sum("n").alias("n"))


# ---- class profiles ---------------------------------------------------------


def _clipped_medians(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(label, feature, median, low, high) of values clipped to p1..p99 of the feature.

    Clipping keeps the order, so the middle values of the clipped rows are the clipped
    middle values of the rows.  The bounds of all classes and the middles of each come
    from one search over both groupings.
    """
    found = order_statistics(
        long_form(df, features, [label]), "value", [([label, "feature"], [0.5]), (["feature"], [0.01, 0.99])]
    )
    of_feature = Window.partitionBy("feature")
    bound = lambda i: F.max(F.when(F.col("set") == 1, interpolated(F.col("places")[i]))).over(of_feature)
    middle = F.col("places")[0]
    clipped = F.struct(
        clip(middle["low"], F.col("low"), F.col("high")).alias("low"),
        clip(middle["high"], F.col("low"), F.col("high")).alias("high"),
        middle["weight"].alias("weight"),
    )
    return (
        found.withColumns({"low": bound(0), "high": bound(1)})
        .where("set = 0")
        .select(label, "feature", interpolated(clipped).alias("median"), "low", "high")
    )


def class_medians(
    df: DataFrame, features: Sequence[str], label: str = "label", method: str = "ranks"
) -> DataFrame:
    """Median per class and feature of the values clipped to p1..p99."""
    if method == "ranks":
        return _clipped_medians(df, features, label).select(label, "feature", "median")
    # Equal values are counted once; bounds and medians both start from the counts.
    counts = (
        long_form(df, features, [label])
        .groupBy(label, "feature", finite("value").alias("value"))
        .agg(F.count("*").alias("n"))
    )
    ends = F.percentile(F.col("value"), F.array(F.lit(0.01), F.lit(0.99)), F.col("n"))
    bounds = counts.groupBy("feature").agg(ends.alias("ends"))
    clipped = clip("value", F.col("ends")[0], F.col("ends")[1])
    return (
        counts.join(bounds, "feature")
        .groupBy(label, "feature")
        .agg(F.percentile(clipped, F.lit(0.5), F.col("n")).alias("median"))
    )


def scaled_medians(df: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """Class medians placed in the feature's clipped range (a range of 0 counts as 1).

    The least and largest clipped values are the bounds themselves.
    """
    span = F.col("high") - F.col("low")
    scaled = (F.col("median") - F.col("low")) / F.when(span == 0, 1.0).otherwise(span)
    return _clipped_medians(df, features, label).select(label, "feature", "median", scaled.alias("scaled"))


def separation(medians: DataFrame, label: str = "label", benign: str = BENIGN) -> DataFrame:
    """|median - benign median| / (|benign median| + 1e-9) per attack and feature.

    The benign row is found by a window over the few medians of a feature, so they
    are computed once.
    """
    of_feature = Window.partitionBy("feature")
    base = F.max(F.when(col(label) == benign, F.col("median"))).over(of_feature)
    return (
        medians.withColumn("benign_median", base)
        .where(col(label) != benign)
        .select(
            col(label).alias("attack"),
            "feature",
            (
                F.abs(F.col("median") - F.col("benign_median"))
                / (F.abs("benign_median") + F.lit(1e-9))
            ).alias("abs_delta"),
            F.col("median").alias("attack_median"),
            "benign_median",
        )
        .orderBy("attack", F.desc("abs_delta"), "feature")
    )


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of each group.

    Spark keeps only k rows per group and task before the shuffle, because the
    filter on the row number is pushed below the exchange as a group limit.
    """
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("place", rank).where(F.col("place") <= k)


def family_medians(
    df: DataFrame,
    families: Mapping[str, Sequence[str]],
    label: str = "label",
    method: str = "ranks",
) -> DataFrame:
    """Median of the feature medians per class and feature family, scaled per family."""
    features = [f for members in families.values() for f in members]
    of_feature = F.create_map(
        *[F.lit(x) for name, members in families.items() for f in members for x in (f, name)]
    )
    medians = quantile_columns(
        long_form(df, features, [label]), "value", {"median": 0.5}, [label, "feature"], method
    )
    families_df = medians.groupBy(label, of_feature[F.col("feature")].alias("family")).agg(
        F.percentile("median", F.lit(0.5)).alias("median")
    )
    return scaled_share(families_df, "median", ["family"], "scaled", pad=1e-9)


def truncated_rank(df: DataFrame, score: str, name: str = "rank") -> DataFrame:
    """Descending rank with ties averaged and then cut to a whole number."""
    counts = df.groupBy(F.col(score).alias("__score")).agg(F.count("*").alias("__ties"))
    value, ends = F.col("__score").cast("double"), F.lit(2**61)
    # Not a number comes before infinity; rows without a score come last.
    slot = (
        F.when(value.isNull(), ends * 2)
        .when(F.isnan(value) | (value == float("inf")), -ends)
        .when(value == float("-inf"), ends)
        .otherwise(-magnitude_slot(value))
    )
    reached = prefix_sums(counts, {"__reached": F.col("__ties")}, [F.desc_nulls_last("__score")], slot)
    middle = F.col("__reached") - (F.col("__ties") - 1) / 2.0
    ranks = reached.select(F.col("__score").alias(score), F.floor(middle).cast("int").alias(name))
    return attach(df, ranks, [score])
