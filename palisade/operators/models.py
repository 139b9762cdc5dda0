"""Reconstruction scoring, attack classification and the two-stage detector."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.functions.flows import action_text, is_anomalous
from palisade.functions.numeric import col
from palisade.operators.prep import class_weights, decode_labels, encode_labels, label_map
from palisade.session import scratch_path

CODE_WIDTH = 8


def feature_array(features: Sequence[str]) -> Column:
    """Feature columns as one array of doubles, null read as 0."""
    return F.array(*[F.coalesce(col(f).cast("double"), F.lit(0.0)) for f in features])


def to_columns(df: DataFrame, array: str, width: int, prefix: str = "f") -> DataFrame:
    """Spread an array column into ``width`` double columns."""
    cells = {f"{prefix}{i:02d}": F.element_at(array, i + 1).cast("double") for i in range(width)}
    return df.withColumns(cells).drop(array)


@dataclass(frozen=True)
class Reconstruction:
    """Linear encoder and decoder around a centre: code = (x - c) E, x' = c + code D.

    Any trained linear weights can be held here.  They are a few kilobytes and
    travel with the tasks.
    """

    centre: np.ndarray
    encoder: np.ndarray
    decoder: np.ndarray

    def score(self, df: DataFrame, vector: str, code: str = "code", error: str = "mse_error") -> DataFrame:
        """Add the code and the mean squared reconstruction error of every row.

        One matrix product per Arrow batch; only ``vector`` is sent to Python.
        """
        centre, encoder, decoder = self.centre, self.encoder, self.decoder
        schema = T.StructType(
            [
                T.StructField(code, T.ArrayType(T.DoubleType())),
                T.StructField(error, T.DoubleType()),
            ]
        )

        @F.pandas_udf(schema)
        def reconstruct(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch) == 0:
                    yield pd.DataFrame({code: [], error: []})
                    continue
                x = np.vstack(batch.to_numpy()).astype(float)
                codes = (x - centre) @ encoder
                residual = x - centre - codes @ decoder
                yield pd.DataFrame({code: list(codes), error: (residual**2).mean(axis=1)})

        scored = df.withColumn("__s", reconstruct(col(vector).cast("array<double>")))
        return scored.withColumns({code: F.col(f"__s.{code}"), error: F.col(f"__s.{error}")}).drop("__s")


def fit_reconstruction(benign: DataFrame, vector: str, width: int = CODE_WIDTH) -> Reconstruction:
    """Principal components of the benign rows, fitted by Spark.

    Stands in for an iteratively trained network: the covariance is one
    distributed pass, and the best linear code of the same width follows from it.
    """
    rows = benign.select(array_to_vector(col(vector).cast("array<double>")).alias("features"))
    components = PCA(k=width, inputCol="features", outputCol="code").fit(rows).pc.toArray()
    size = components.shape[0]
    centre = benign.agg(
        *[F.avg(F.element_at(col(vector), i + 1).cast("double")).alias(f"m{i}") for i in range(size)]
    ).first()
    return Reconstruction(
        np.array([float(centre[f"m{i}"]) for i in range(size)]), components, components.T
    )


def block_reconstruction(benign: DataFrame, vector: str, size: int, width: int = CODE_WIDTH) -> Reconstruction:
    """Code = mean of each block of neighbouring features, around the benign mean.

    A fixed-weight code whose error has a closed form, used where results must be
    reproducible outside Spark.
    """
    centre = benign.agg(
        *[F.avg(F.element_at(col(vector), i + 1).cast("double")).alias(f"m{i}") for i in range(size)]
    ).first()
    span = size // width
    encoder, decoder = np.zeros((size, width)), np.zeros((width, size))
    for i in range(size):
        block = min(i // span, width - 1)
        encoder[i, block] = 1.0
        decoder[block, i] = 1.0
    encoder /= encoder.sum(axis=0)
    return Reconstruction(np.array([float(centre[f"m{i}"]) for i in range(size)]), encoder, decoder)


@dataclass
class AttackClassifier:
    """A fitted forest and the (label, label_id) table its classes refer to."""

    model: object
    labels: DataFrame
    features: str

    def classify(self, df: DataFrame) -> DataFrame:
        """Add predicted_id, confidence and predicted_label."""
        vectors = df.withColumn("__x", array_to_vector(col(self.features).cast("array<double>")))
        scored = self.model.transform(vectors)
        chances = vector_to_array("probability")
        result = scored.withColumns(
            {"predicted_id": F.col("prediction").cast("int"), "confidence": F.array_max(chances)}
        ).drop("__x", "rawPrediction", "probability", "prediction")
        return decode_labels(result, self.labels, "predicted_id")


def fit_classifier(
    df: DataFrame,
    features: str,
    label: str = "label",
    trees: int = 50,
    depth: int = 6,
    seed: int = 42,
) -> AttackClassifier:
    """Class-weighted forest on an array column."""
    labels = label_map(df, label)
    prepared = (
        encode_labels(df, labels, label)
        .join(F.broadcast(class_weights(df, label)), label)
        .select(
            array_to_vector(col(features).cast("array<double>")).alias("__x"), "label_id", "weight"
        )
    )
    forest = RandomForestClassifier(
        featuresCol="__x",
        labelCol="label_id",
        weightCol="weight",
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
    )
    return AttackClassifier(forest.fit(prepared), labels, features)


def validate_classifier(
    df: DataFrame, features: str, label: str, fold: str, trees: int = 50, depth: int = 6, seed: int = 42
) -> DataFrame:
    """(fold, accuracy): the class-weighted forest, fitted without a fold and tried on it.

    Folds come from a column, so they do not change with partitioning.  One fit for each
    fold; the accuracies are as many as the folds.
    """
    labels = label_map(df, label)
    count = df.agg(F.max(fold) + 1).first()[0] or 0
    if count < 2:
        raise ValueError("two folds are needed at least")
    prepared = encode_labels(df, labels, label).join(class_weights(df, label), label).select(
        array_to_vector(col(features).cast("array<double>")).alias("__x"), "label_id", "weight", col(fold).cast("int").alias(fold)
    )
    forest = RandomForestClassifier(
        featuresCol="__x", labelCol="label_id", weightCol="weight", numTrees=trees, maxDepth=depth, seed=seed
    )
    tried = CrossValidator(
        estimator=forest,
        estimatorParamMaps=[{}],
        evaluator=MulticlassClassificationEvaluator(labelCol="label_id", metricName="accuracy"),
        numFolds=count,
        foldCol=fold,
        collectSubModels=True,
        seed=seed,
    ).fit(prepared)
    parts = []
    for number, models in enumerate(tried.subModels):
        test = models[0].transform(prepared.where(F.col(fold) == number))
        hit = F.avg((F.col("prediction") == F.col("label_id")).cast("int"))
        parts.append(test.agg(F.lit(number).alias("fold"), F.count("*").alias("rows"), hit.alias("accuracy")))
    return reduce(DataFrame.unionByName, parts)


def classify_scores(df: DataFrame, scores: str, mapping: DataFrame) -> DataFrame:
    """Argmax, confidence and label of an array of class scores."""
    best = F.array_max(scores)
    placed = df.withColumns(
        {
            "confidence": best.cast("double"),
            "predicted_id": (F.array_position(scores, best) - 1).cast("int"),
        }
    )
    return decode_labels(placed, mapping, "predicted_id")


def detect(
    scored: DataFrame,
    threshold: float,
    classify,
    key: str,
    error: str = "mse_error",
) -> DataFrame:
    """Two-stage detection: classify anomalous rows only, then name the action.

    ``classify`` adds predicted_label and confidence.  Rows below the threshold
    never reach it; both parts come from one scored table and are put together by
    a union, so no join is needed.
    """
    flagged = scored.withColumn("is_anomalous", F.coalesce(is_anomalous(error, threshold), F.lit(False)))
    hot = classify(flagged.where("is_anomalous"))
    calm = flagged.where("NOT is_anomalous")
    return (
        hot.unionByName(calm, allowMissingColumns=True)
        .withColumn("action", action_text(error, threshold, "predicted_label"))
        .select(
            *[c for c in scored.columns if c in (key, "true_label")],
            error,
            "is_anomalous",
            "predicted_label",
            "confidence",
            "action",
        )
    )


@dataclass(frozen=True)
class FlatForest:
    """A fitted forest as arrays, evaluated for a batch of rows level by level.

    ``shares`` are the class shares at each node; inner nodes have a feature, leaves -1.
    """

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    shares: np.ndarray
    roots: np.ndarray

    def classify(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(class id, confidence) of each row: the trees' shares are averaged."""
        at = np.repeat(self.roots[None, :], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        while True:
            inner = self.feature[at] >= 0
            if not inner.any():
                break
            low = x[rows, np.maximum(self.feature[at], 0)] <= self.threshold[at]
            at = np.where(inner, np.where(low, self.left[at], self.right[at]), at)
        chances = self.shares[at].mean(axis=1)
        return chances.argmax(axis=1), chances.max(axis=1)


def flat_forest(spark: SparkSession, model) -> FlatForest:
    """Nodes of a fitted forest with numeric features, read from its saved form.

    The table has at most trees x 2^(depth + 1) rows, whatever the data.
    """
    path = scratch_path(spark, "forest")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    place = {(n["treeID"], n["id"]): i for i, n in enumerate(nodes)}
    if any(n["split"]["numCategories"] != -1 for n in nodes if n["leftChild"] >= 0):
        raise ValueError("splits on categories are not supported")
    inner = [n["leftChild"] >= 0 for n in nodes]
    child = lambda n, side: place[n["treeID"], n[side]]
    stats = np.array([n["impurityStats"] for n in nodes], dtype=float)
    return FlatForest(
        np.array([n["split"]["featureIndex"] if x else -1 for n, x in zip(nodes, inner, strict=True)]),
        np.array([n["split"]["leftCategoriesOrThreshold"][0] if x else 0.0 for n, x in zip(nodes, inner, strict=True)]),
        np.array([child(n, "leftChild") if x else i for i, (n, x) in enumerate(zip(nodes, inner, strict=True))]),
        np.array([child(n, "rightChild") if x else i for i, (n, x) in enumerate(zip(nodes, inner, strict=True))]),
        stats / np.maximum(stats.sum(axis=1, keepdims=True), 1e-300),
        np.array([i for i, n in enumerate(nodes) if n["id"] == 0]),
    )


def best_score(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class scores read from the code itself: (position of the largest, the largest)."""
    return codes.argmax(axis=1), codes.max(axis=1)


def detect_vectors(
    df: DataFrame,
    vector: str,
    reconstruction: Reconstruction,
    threshold: float,
    classify: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]],
    labels: DataFrame,
    key: str,
    error: str = "mse_error",
) -> DataFrame:
    """Two-stage detection straight from the vectors, in one scan and one evaluation.

    Each Arrow batch is scored whole; the codes of its anomalous rows alone go to
    ``classify``, which returns class ids and confidences.  A null vector has no error
    and is not anomalous.
    """
    centre, encoder, decoder = reconstruction.centre, reconstruction.encoder, reconstruction.decoder
    schema = T.StructType(
        [
            T.StructField("error", T.DoubleType()),
            T.StructField("hot", T.BooleanType()),
            T.StructField("id", T.IntegerType()),
            T.StructField("confidence", T.DoubleType()),
        ]
    )

    @F.pandas_udf(schema)
    def staged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known, n = batch.notna().to_numpy(), len(batch)
            error, hot, ids, sure = np.full(n, np.nan), np.zeros(n, dtype=bool), np.full(n, -1), np.full(n, np.nan)
            if known.any():
                x = np.vstack(batch[known].to_numpy()).astype(float) - centre
                codes = x @ encoder
                error[known] = ((x - codes @ decoder) ** 2).mean(axis=1)
                hot = known & ~(error < threshold)
                if hot.any():
                    ids[hot], sure[hot] = classify(codes[hot[known]])
            yield pd.DataFrame(
                {
                    "error": pd.Series(error).astype("Float64").where(known),
                    "hot": hot,
                    "id": pd.Series(ids).astype("Int32").where(hot),
                    "confidence": pd.Series(sure).astype("Float64").where(hot),
                }
            )

    scored = df.withColumn("__s", staged(col(vector).cast("array<double>"))).select(
        *[c for c in df.columns if c in (key, "true_label")],
        F.col("__s.error").alias(error),
        F.col("__s.hot").alias("is_anomalous"),
        F.col("__s.id").alias("predicted_id"),
        F.col("__s.confidence").alias("confidence"),
    )
    named = decode_labels(scored, labels, "predicted_id")
    text = F.concat(F.lit("ATTACK: "), F.col("predicted_label"))
    return named.withColumn("action", F.when(F.col("is_anomalous"), text).otherwise(F.lit("BENIGN - Passed"))).drop("predicted_id")


def detection_totals(detections: DataFrame) -> DataFrame:
    return detections.agg(
        F.count("*").alias("total_samples"),
        F.count_if(~F.col("is_anomalous")).alias("benign_count"),
        F.count_if("is_anomalous").alias("anomalous_count"),
        F.count_if(F.col("predicted_label").isNotNull()).alias("malicious_count"),
        F.bool_or("is_anomalous").alias("triggered"),
    )


def first_trigger(detections: DataFrame, key: str, batch: Sequence[str] = ()) -> DataFrame:
    """The first anomalous row of each batch, as an ordinary minimum.

    ``min_by`` is combined on the map side, so a huge batch is never sorted.
    """
    row = F.struct(*detections.columns)
    return (
        detections.where("is_anomalous")
        .groupBy(*batch)
        .agg(F.min_by(row, F.col(key)).alias("t"))
        .where("t IS NOT NULL")
        .select("t.*")
    )


def first_of_label(df: DataFrame, label: str, value: str, key: str, count: int = 100, most: int | None = None) -> DataFrame:
    """First ``count`` rows of a label in key order, or ``most`` if that is given and less."""
    return df.where(col(label) == value).orderBy(key).limit(count if most is None else min(count, most))

