"""Cleaning, scaling, encoding, sampling and splitting of feature tables.

Scalers follow the estimator idea: ``fit`` runs one aggregate and returns a small
model (two numbers per column); ``transform`` is then a plain projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.functions.flows import BENIGN
from palisade.functions.numeric import col, finite
from palisade.operators.ordered import hash_key, hash_positions, sized_broadcast


def drop_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the listed columns that exist."""
    return df.drop(*[n for n in names if n in df.columns])


def keep_benign(df: DataFrame, label: str = "label") -> DataFrame:
    return df.where(col(label) == BENIGN)


def keep_attacks(df: DataFrame, label: str = "label") -> DataFrame:
    return df.where(col(label) != BENIGN)


def complete_rows(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows whose features are all finite."""
    return df.withColumns({f: finite(f) for f in features}).dropna(subset=list(features))


def project(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Columns in the saved feature order."""
    return df.select(*[col(k) for k in keep], *[col(f) for f in features])


# ---- scaling ----------------------------------------------------------------


@dataclass(frozen=True)
class Scaler:
    """x * scale + offset per column, in a fixed column order."""

    features: tuple[str, ...]
    scale: tuple[float, ...]
    offset: tuple[float, ...]

    def transform(self, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
        """Scaled features in the stored order; values outside the range are not cut."""
        keep = [c for c in df.columns if c not in self.features] if keep is None else keep
        scaled = [
            (col(f).cast("double") * F.lit(s) + F.lit(o)).alias(f)
            for f, s, o in zip(self.features, self.scale, self.offset)
        ]
        return df.select(*[col(k) for k in keep], *scaled)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(list(self.scale), list(self.offset), len(self.features), list(self.features))]
        return spark.createDataFrame(
            rows, "scale array<double>, min array<double>, n_features int, feature_columns array<string>"
        )

    def save(self, spark: SparkSession, path: str) -> None:
        self.table(spark).coalesce(1).write.mode("overwrite").json(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Scaler:
        schema = "scale array<double>, min array<double>, n_features int, feature_columns array<string>"
        row = spark.read.schema(schema).json(path).first()
        return cls(tuple(row["feature_columns"]), tuple(row["scale"]), tuple(row["min"]))


def fit_min_max(df: DataFrame, features: Sequence[str]) -> Scaler:
    """Maps each feature's minimum to 0 and maximum to 1; a zero range counts as 1."""
    ends = df.agg(
        *[F.min(finite(f)).alias(f"lo{i}") for i, f in enumerate(features)],
        *[F.max(finite(f)).alias(f"hi{i}") for i, f in enumerate(features)],
    ).first()
    scale, offset = [], []
    for i in range(len(features)):
        low, high = ends[f"lo{i}"], ends[f"hi{i}"]
        low, high = (0.0, 0.0) if low is None else (low, high)
        factor = 1.0 / (high - low) if high > low else 1.0
        scale.append(factor)
        offset.append(-low * factor)
    return Scaler(tuple(features), tuple(scale), tuple(offset))


def fit_standard(df: DataFrame, features: Sequence[str]) -> Scaler:
    """Zero mean and unit population deviation; a zero deviation counts as 1."""
    stats = df.agg(
        *[F.avg(finite(f)).alias(f"m{i}") for i, f in enumerate(features)],
        *[F.stddev_pop(finite(f)).alias(f"s{i}") for i, f in enumerate(features)],
    ).first()
    scale = [1.0 / stats[f"s{i}"] if stats[f"s{i}"] else 1.0 for i in range(len(features))]
    means = [stats[f"m{i}"] or 0.0 for i in range(len(features))]
    return Scaler(tuple(features), tuple(scale), tuple(-m * s for m, s in zip(means, scale)))


def benign_features(days: Sequence[DataFrame], features: Sequence[str], label: str = "label") -> tuple[DataFrame, Scaler]:
    """Complete benign rows of all tables, scaled by their own range."""
    rows = reduce(
        lambda a, b: a.unionByName(b),
        [project(complete_rows(keep_benign(d, label), features), features, [label]) for d in days],
    )
    scaler = fit_min_max(rows, features)
    return scaler.transform(rows), scaler


def attack_features(
    days: Sequence[DataFrame], scaler: Scaler, label: str = "label"
) -> DataFrame:
    """Complete attack rows of all tables with labels, scaled by the given scaler."""
    features = list(scaler.features)
    rows = reduce(
        lambda a, b: a.unionByName(b),
        [project(complete_rows(keep_attacks(d, label), features), features, [label]) for d in days],
    )
    return scaler.transform(rows)


# ---- labels -----------------------------------------------------------------


def label_map(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, label_id): ids from 0 in sorted label order."""
    order = Window.orderBy(label)
    return df.select(label).distinct().select(
        label, (F.row_number().over(order) - 1).cast("int").alias("label_id")
    )


def encode_labels(df: DataFrame, mapping: DataFrame, label: str = "label") -> DataFrame:
    held, _ = sized_broadcast(mapping)
    return df.join(held, label, "left")


def decode_labels(df: DataFrame, mapping: DataFrame, id_column: str, name: str = "predicted_label") -> DataFrame:
    """Label text of an id; ids without a label read ``Class_<id>``."""
    names = mapping.select(F.col("label_id").alias(id_column), F.col(mapping.columns[0]).alias(name))
    held, _ = sized_broadcast(names)
    fallback = F.concat(F.lit("Class_"), F.col(id_column).cast("string"))
    return df.join(held, id_column, "left").withColumn(name, F.coalesce(F.col(name), fallback))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weight rows / (classes * class rows) per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    everything = Window.partitionBy()
    weight = F.sum("n").over(everything) / (F.count("*").over(everything) * F.col("n"))
    return counts.select(label, weight.alias("weight"))


# ---- samples and splits -----------------------------------------------------


def hash_fraction(*key: str) -> Column:
    """Repeatable number in [0, 1) from the key columns."""
    return F.conv(F.substring(hash_key(*key), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def repeatable_sample(df: DataFrame, rows: int, key: Sequence[str]) -> DataFrame:
    """The ``rows`` rows whose keys have the smallest hashes.

    The same rows whatever the partitioning: every task keeps its smallest, and these are
    merged.  Meant for samples that one task can hold.
    """
    return df.orderBy(hash_key(*key), *[F.col(k) for k in key]).limit(rows)


def sample(df: DataFrame, fraction: float, key: Sequence[str]) -> DataFrame:
    """Repeatable simple sample: a narrow filter, no shuffle."""
    return df.where(hash_fraction(*key) < fraction)


def _with_place(df: DataFrame, key: Sequence[str], group: Sequence[str]) -> DataFrame:
    """Position by key hash within the group, and the size of the group."""
    keyed = df.withColumn("__hash", hash_key(*key))
    ties = [F.col(k) for k in key]
    return hash_positions(keyed, "__hash", group, ties, "__place", "__size")


def stratified_sample(
    df: DataFrame, fraction: float, key: Sequence[str], group: Sequence[str]
) -> DataFrame:
    """round(fraction * size) rows per group; groups too small for one row stay whole."""
    share = F.col("__size") * F.lit(fraction)
    kept = F.when(share >= 1, F.col("__place") <= F.rint(share)).otherwise(F.lit(True))
    return _with_place(df, key, group).where(kept).drop("__hash", "__place", "__size")


def split(
    df: DataFrame,
    ratios: Mapping[str, float],
    key: Sequence[str],
    strata: Sequence[str] = (),
    name: str = "split",
) -> DataFrame:
    """Assign every row to a split with exact sizes per stratum.

    Rows are ordered by a hash of their key, so the result does not depend on
    partitioning.  Cumulative sizes are rounded, so the splits add up to the
    stratum.  The order is cut at hash prefixes; no stratum is one task.
    """
    if abs(sum(ratios.values()) - 1.0) > 1e-8:
        raise ValueError(f"ratios must sum to 1, got {sum(ratios.values())}")
    placed = _with_place(df, key, strata)
    done, label = 0.0, F.lit(list(ratios)[-1])
    bounds = []
    for split_name, ratio in ratios.items():
        done += ratio
        bounds.append((split_name, round(done, 10)))
    for split_name, bound in reversed(bounds[:-1]):
        edge = F.floor(F.col("__size") * F.lit(bound) + F.lit(0.5))
        label = F.when(F.col("__place") <= edge, F.lit(split_name)).otherwise(label)
    return placed.withColumn(name, label).drop("__hash", "__place", "__size")


def benign_split(df: DataFrame, key: Sequence[str], name: str = "split") -> DataFrame:
    """40 % production; a third of the rest is halved into test and validation."""
    ratios = {"production": 0.4, "train": 0.6 * 0.667, "test": 0.6 * 0.1665, "val": 0.6 * 0.1665}
    return split(df, ratios, key, (), name)


def split_summary(df: DataFrame, label: str = "label", name: str = "split", top: int = 5) -> DataFrame:
    """Rows and share per split and its largest classes."""
    counts = df.groupBy(name, label).agg(F.count("*").alias("n"))
    by_split, everything = Window.partitionBy(name), Window.partitionBy()
    place = F.row_number().over(by_split.orderBy(F.desc("n"), label))
    return counts.withColumns(
        {
            "split_rows": F.sum("n").over(by_split),
            "classes": F.count("*").over(by_split),
            "pct": F.sum("n").over(by_split) * 100.0 / F.sum("n").over(everything),
            "place": place,
        }
    ).where(F.col("place") <= top)


def folds(df: DataFrame, k: int, key: Sequence[str], name: str = "fold") -> DataFrame:
    """Fold number 0..k-1 from the key hash; no shuffle."""
    return df.withColumn(name, F.least(F.floor(hash_fraction(*key) * k), F.lit(k - 1)).cast("int"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
