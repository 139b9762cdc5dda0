"""Quality of scores and predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.functions.numeric import col
from palisade.operators.ordered import depth_slots, prefix_sums
from palisade.operators.profile import error_summary


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.groupBy(truth, predicted).agg(F.count("*").alias("n"))


def class_quality(df: DataFrame, truth: str = "label", predicted: str = "predicted_label") -> DataFrame:
    """Precision, recall, F1 and support per class, and the overall accuracy.

    Starts from the confusion counts, so only classes x classes rows are reshaped.
    """
    counts = confusion(df, truth, predicted)
    as_truth = counts.select(
        col(truth).alias("class"),
        F.col("n").alias("truth_n"),
        F.lit(0).alias("pred_n"),
        F.when(col(truth) == col(predicted), F.col("n")).otherwise(0).alias("hit"),
    )
    as_pred = counts.select(
        col(predicted).alias("class"), F.lit(0).alias("truth_n"), F.col("n").alias("pred_n"), F.lit(0).alias("hit")
    )
    totals = (
        as_truth.unionByName(as_pred)
        .groupBy("class")
        .agg(F.sum("truth_n").alias("support"), F.sum("pred_n").alias("predicted"), F.sum("hit").alias("tp"))
    )
    precision = F.try_divide(F.col("tp"), F.col("predicted"))
    recall = F.try_divide(F.col("tp"), F.col("support"))
    everything = Window.partitionBy()
    return totals.select(
        "class",
        "support",
        "predicted",
        "tp",
        F.coalesce(precision, F.lit(0.0)).alias("precision"),
        F.coalesce(recall, F.lit(0.0)).alias("recall"),
        F.coalesce(
            F.try_divide(2.0 * F.col("tp"), F.col("predicted") + F.col("support")), F.lit(0.0)
        ).alias("f1"),
        (F.sum("tp").over(everything) / F.sum("support").over(everything)).alias("accuracy"),
    )


def binary_quality(
    df: DataFrame, truth: Column, predicted: Column, by: Sequence = (), beta: float = 1.0
) -> DataFrame:
    """Counts, accuracy, precision, recall and F-beta of a yes/no prediction.

    ``by`` may hold columns such as a time window.
    """
    counts = df.groupBy(*by).agg(
        F.count_if(truth & predicted).alias("tp"),
        F.count_if(~truth & predicted).alias("fp"),
        F.count_if(truth & ~predicted).alias("fn"),
        F.count_if(~truth & ~predicted).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    b2 = beta * beta

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

    return counts.withColumns(
        {
            "accuracy": share(tp + tn, tp + fp + fn + tn),
            "precision": share(tp, tp + fp),
            "recall": share(tp, tp + fn),
            "fbeta": share((1 + b2) * tp, (1 + b2) * tp + b2 * fn + fp),
        }
    )


def detection_rates(df: DataFrame, label: str, anomalous: str, benign: str) -> DataFrame:
    """Share of rows flagged per class: detection rate, false positives for benign."""
    return df.groupBy(label).agg(
        F.count("*").alias("n"),
        F.avg(col(anomalous).cast("int")).alias("flagged_rate"),
    ).withColumn(
        "kind",
        F.when(col(label) == benign, F.lit("false_positive_rate")).otherwise(F.lit("detection_rate")),
    )


def error_rates(df: DataFrame, label: str, anomalous: str, benign: str) -> DataFrame:
    """False positive rate among benign rows, false negative rate among attacks."""
    is_benign, flagged = col(label) == benign, col(anomalous)
    return df.agg(
        F.avg(F.when(is_benign, flagged.cast("int"))).alias("false_positive_rate"),
        F.avg(F.when(~is_benign, (~flagged).cast("int"))).alias("false_negative_rate"),
    )


def array_difference(left: DataFrame, right: DataFrame, key: str, values: str) -> DataFrame:
    """Largest and mean absolute difference of two arrays joined on ``key``."""
    pairs = left.select(key, col(values).alias("a")).join(right.select(key, col(values).alias("b")), key)
    gaps = F.transform(F.arrays_zip("a", "b"), lambda p: F.abs(p["a"].cast("double") - p["b"].cast("double")))
    row = pairs.select(
        F.array_max(gaps).alias("m"),
        F.aggregate(gaps, F.lit(0.0), lambda t, x: t + x).alias("s"),
        F.size("a").alias("k"),
    )
    return row.agg(
        F.count("*").alias("rows"),
        F.max("m").alias("max_abs_diff"),
        (F.sum("s") / F.sum("k")).alias("mean_abs_diff"),
    )


def thresholds(df: DataFrame, error: str, method: str = "ranks") -> DataFrame:
    """Candidate thresholds: p95, p99 and p99.9 of the benign errors."""
    return error_summary(df, error, (), method).select("p95", "p99", "p99_9")


def sweep(df: DataFrame, score: str, positive: Column, slot_rows: int = 100_000) -> DataFrame:
    """Counts at every distinct threshold (flag when score >= threshold).

    Rows are first counted per distinct score, then accumulated from the highest
    score down across slots of about ``slot_rows`` scores each, however they are
    spread.  The two totals are read first.
    """
    value = col(score).cast("double")
    counts = df.where(value.isNotNull()).groupBy(value.alias("threshold")).agg(
        F.count_if(positive).alias("p"), F.count_if(~positive).alias("n")
    )
    summed = prefix_sums(
        depth_slots(counts, "threshold", slot_rows, "__depth"),
        {"tp": F.col("p"), "fp": F.col("n")},
        [F.desc("threshold")],
        -F.col("__depth"),
    ).drop("__depth")
    totals = counts.agg(F.sum("p").alias("p"), F.sum("n").alias("n")).first()
    all_p, all_n = F.lit(totals["p"]).cast("long"), F.lit(totals["n"]).cast("long")
    return summed.withColumns({"all_p": all_p, "all_n": all_n}).withColumns(
        {
            "tpr": F.try_divide(F.col("tp"), F.col("all_p")),
            "fpr": F.try_divide(F.col("fp"), F.col("all_n")),
            "f1": F.try_divide(2.0 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("all_p")),
        }
    )


def best_thresholds(swept: DataFrame) -> DataFrame:
    """Thresholds with the largest Youden J and F1, and the area under the ROC curve.

    The area adds, for every score, the trapezoid between it and the next higher
    one: (p / P) is the step up and (n / N) the step right.
    """
    youden = F.col("tpr") - F.col("fpr")
    step = F.col("n") * (F.col("tp") - F.col("p") / 2.0)
    return swept.agg(
        F.max_by("threshold", F.struct(F.round(youden, 9), F.col("threshold"))).alias("youden_threshold"),
        F.max(youden).alias("youden_j"),
        F.max_by("threshold", F.struct(F.round("f1", 9), F.col("threshold"))).alias("f1_threshold"),
        F.max("f1").alias("best_f1"),
        (F.sum(step) / (F.max("all_p").cast("double") * F.max("all_n"))).alias("roc_auc"),
    )


def centroid_validation(df: DataFrame, vector: str, label: str, fold: str, width: int) -> DataFrame:
    """Per fold: rows, accuracy and mean recall of a nearest-centroid classifier that was
    fitted on the other folds.

    One pass adds up every (fold, class); the centroids without a fold are the totals less
    the fold's own sums, a table of folds times classes.  Each row is then compared with
    the centroids of its fold.  Ties go to the class that comes first.
    """
    cells = [F.element_at(col(vector), i + 1).cast("double") for i in range(width)]
    sums = df.groupBy(fold, col(label).alias("class")).agg(
        F.count("*").alias("n"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(cells)]
    )
    folds = F.array_sort(F.collect_set(fold).over(Window.partitionBy()))
    left = (
        sums.withColumn("__folds", folds)
        .select("class", F.col(fold).alias("__own"), "n", *[f"s{i}" for i in range(width)], F.explode("__folds").alias(fold))
        .groupBy("class", fold)
        .agg(
            F.sum(F.when(F.col("__own") != F.col(fold), F.col("n"))).alias("n"),
            F.array(*[F.sum(F.when(F.col("__own") != F.col(fold), F.col(f"s{i}"))) for i in range(width)]).alias("sums"),
        )
        .where("n > 0")
        .select(fold, F.struct("class", F.transform("sums", lambda s: s / F.col("n")).alias("centre")).alias("c"))
        .groupBy(fold)
        .agg(F.array_sort(F.collect_list("c")).alias("centres"))
    )
    far = lambda c: F.aggregate(
        F.zip_with(c["centre"], F.array(*cells), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, x: t + x
    )
    ranked = F.transform("centres", lambda c: F.struct(far(c).alias("d"), c["class"].alias("class")))
    judged = df.join(left, fold, "left").select(fold, col(label).alias("class"), F.array_min(ranked)["class"].alias("predicted"))
    hits = judged.groupBy(fold, "class").agg(F.count("*").alias("n"), F.count_if(F.col("class") == F.col("predicted")).alias("hit"))
    return hits.groupBy(fold).agg(
        F.sum("n").alias("rows"),
        (F.sum("hit") / F.sum("n")).alias("accuracy"),
        F.avg(F.col("hit") / F.col("n")).alias("mean_recall"),
    )
