"""Flow tables from CSV to scaled, split feature tables, and the detector."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.operators import models as M
from palisade.operators import prep
from palisade.operators.profile import error_summary
from palisade.sources import flows

# Shares of the four-way split.
SPLIT = {"train": 0.4, "test": 0.1, "val": 0.1, "production": 0.4}


@dataclass
class Prepared:
    """Scaled rows with key, label and split, and the scaler used."""

    rows: DataFrame
    scaler: prep.Scaler


def prepare(
    table: DataFrame,
    features: Sequence[str],
    key: Sequence[str],
    label: str = "label",
    ratios: Mapping[str, float] = SPLIT,
    fit_on: str = "train",
) -> Prepared:
    """Clean, split by label and scale.

    The scaler sees the training rows only; ``fit_on='all'`` fits on everything.
    """
    clean = prep.project(prep.complete_rows(table, features), features, [*key, label])
    parts = prep.split(clean, ratios, key, [label])
    fitted = prep.fit_min_max(parts if fit_on == "all" else parts.where(F.col("split") == "train"), features)
    return Prepared(fitted.transform(parts), fitted)


def store(spark: SparkSession, prepared: Prepared, path: str) -> None:
    """Rows partitioned by split beside the scaler and a split report."""
    prepared.rows.write.mode("overwrite").partitionBy("split").parquet(f"{path}/rows")
    prepared.scaler.save(spark, f"{path}/scaler")
    prep.split_summary(prepared.rows).coalesce(1).write.mode("overwrite").json(f"{path}/split_report")


def flow_table(spark: SparkSession, files: Mapping[str, str], path: str) -> DataFrame:
    """Day files as one Parquet table partitioned by day, read back."""
    flows.read_days(spark, files).write.mode("overwrite").partitionBy("day").parquet(path)
    return spark.read.parquet(path)


@dataclass
class Detector:
    """Fitted reconstruction model, threshold and attack classifier."""

    reconstruction: M.Reconstruction
    threshold: float
    classifier: M.AttackClassifier

    def detect(self, df: DataFrame, vector: str, key: str) -> DataFrame:
        forest = M.flat_forest(df.sparkSession, self.classifier.model)
        return M.detect_vectors(df, vector, self.reconstruction, self.threshold, forest.classify, self.classifier.labels, key)


def fit_detector(
    benign: DataFrame, attacks: DataFrame, vector: str, label: str = "label", percentile: str = "p95"
) -> Detector:
    """Reconstruction model and threshold from benign rows, classifier from attack codes."""
    reconstruction = M.fit_reconstruction(benign, vector)
    errors = error_summary(reconstruction.score(benign, vector), "mse_error").first()
    classifier = M.fit_classifier(reconstruction.score(attacks, vector), "code", label)
    return Detector(reconstruction, float(errors[percentile]), classifier)
