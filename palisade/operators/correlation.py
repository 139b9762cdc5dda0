"""Pearson correlation of wide numeric tables, in long form."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.functions.numeric import col, finite

# Below this share of the sum of squares a spread is rounding noise.
NOISE = 1e-12


def pearson(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature_a, feature_b, r) for every pair a before b in ``features`` order.

    Each pair uses the rows where both values are finite; constant columns give
    null.
    """
    return _from_blocks(df, list(features))


def _centred(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.select(*[finite(f).alias(f"f{i}") for i, f in enumerate(features)])


def _from_blocks(df: DataFrame, features: list[str]) -> DataFrame:
    """Pair sums by matrix products per Arrow batch, added up by Spark.

    Values are shifted by the column means first, which keeps the sums of
    products accurate; a row counts for a pair when both values are present.
    """
    width = len(features)
    table = _centred(df, features)
    # A constant column is shifted by its value, not by a rounded mean, so it becomes zero.
    middle = lambda c: F.when(F.min(c) == F.max(c), F.min(c)).otherwise(F.avg(c))
    means = table.agg(*[middle(c).alias(c) for c in table.columns]).first()
    shift = np.array([means[c] if means[c] is not None else 0.0 for c in table.columns])

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((6, width, width))
        for batch in batches:
            x = batch.to_numpy(dtype=float) - shift
            seen = ~np.isnan(x)
            x = np.where(seen, x, 0.0)
            m = seen.astype(float)
            total[0] += m.T @ m
            total[1] += x.T @ m
            total[2] += m.T @ x
            total[3] += x.T @ x
            total[4] += (x * x).T @ m
            total[5] += m.T @ (x * x)
        i, j = np.triu_indices(width, 1)
        yield pd.DataFrame(
            {"i": i, "j": j, **{k: total[s][i, j] for s, k in enumerate(("n", "x", "y", "xy", "xx", "yy"))}}
        )

    parts = table.mapInPandas(
        products, "i int, j int, n double, x double, y double, xy double, xx double, yy double"
    )
    sums = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xy", "xx", "yy")])
    names = F.array(*[F.lit(f) for f in features])
    spread_x = F.col("xx") - F.try_divide(F.col("x") * F.col("x"), F.col("n"))
    spread_y = F.col("yy") - F.try_divide(F.col("y") * F.col("y"), F.col("n"))
    joint = F.col("xy") - F.try_divide(F.col("x") * F.col("y"), F.col("n"))
    spread = F.when((spread_x > F.col("xx") * NOISE) & (spread_y > F.col("yy") * NOISE), spread_x * spread_y)
    r = F.try_divide(joint, F.sqrt(F.when(spread > 0, spread)))
    return sums.select(
        names[F.col("i")].alias("feature_a"),
        names[F.col("j")].alias("feature_b"),
        F.when(r.isNotNull(), F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0))).alias("r"),
    )


def strong_pairs(pairs: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Pairs with |r| at or above the threshold, strongest first."""
    return (
        pairs.where(F.abs("r") >= threshold)
        .select(
            "feature_a",
            "feature_b",
            F.round("r", 6).alias("pearson_r"),
            F.round(F.abs("r"), 6).alias("abs_r"),
        )
        .orderBy(F.desc("abs_r"), "feature_a", "feature_b")
    )


def strong_share(pairs: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Percent of the defined pairs at or above the threshold."""
    return pairs.agg(
        F.count("r").alias("pairs"),
        (F.avg(F.when(F.col("r").isNotNull(), (F.abs("r") >= threshold).cast("int"))) * 100.0).alias(
            "pct_strong"
        ),
    )


def redundant_features(pairs: DataFrame, threshold: float = 0.9) -> DataFrame:
    """The second feature of every strong pair, once."""
    return (
        pairs.where(F.abs("r") >= threshold)
        .select(col("feature_b").alias("feature"))
        .distinct()
    )
