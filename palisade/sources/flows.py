"""Readers and writers for network-flow CSV files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.functions.flows import clean_label
from palisade.functions.numeric import col
from palisade.sources.logs import files_by_header

# Identifier columns that are never features.
IDENTIFIERS = (
    "Flow ID",
    "Source IP",
    "Source Port",
    "Destination IP",
    "Destination Port",
    "Protocol",
    "Timestamp",
)
LABEL = "Label"


def trimmed(df: DataFrame) -> DataFrame:
    """Same columns with blanks stripped from the header names."""
    return df.toDF(*[c.strip() for c in df.columns])


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path).schema
        return True
    except AnalysisException:
        return False


def flow_schema(names: Sequence[str]) -> T.StructType:
    """Doubles everywhere but in identifiers and label: no inference pass."""
    text = {*IDENTIFIERS, LABEL}
    return T.StructType(
        [
            T.StructField(n, T.StringType() if n.strip() in text else T.DoubleType())
            for n in names
        ]
    )


def read_flow_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One or several flow files (a glob works); trimmed header, trimmed label."""
    parts = []
    for names, files in files_by_header(spark, path).items():
        reader = spark.read.option("header", True).option("enforceSchema", False).option("nanValue", "NaN")
        reader = reader.option("positiveInf", "Infinity").option("negativeInf", "-Infinity")
        parts.append(trimmed(reader.schema(flow_schema(names)).csv(files)))
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return df.withColumn(LABEL, clean_label(LABEL)) if LABEL in df.columns else df


def union_days(days: Mapping[str, DataFrame], name: str = "day") -> DataFrame:
    """Union of day tables with a tag column; columns missing in one become null."""
    tagged = [trimmed(df).withColumn(name, F.lit(day)) for day, df in days.items()]
    if not tagged:
        raise FileNotFoundError("no flow table found")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def read_days(spark: SparkSession, files: Mapping[str, str]) -> DataFrame:
    """All day files that exist, tagged by day."""
    present = {d: p for d, p in files.items() if path_exists(spark, p)}
    return union_days({d: read_flow_csv(spark, p) for d, p in present.items()})


def feature_columns(df: DataFrame, drop: Sequence[str] = (*IDENTIFIERS, LABEL, "day")) -> list[str]:
    """Numeric columns that are neither identifiers nor the label."""
    return [
        f.name
        for f in df.schema
        if f.name not in drop and isinstance(f.dataType, T.NumericType)
    ]


def write_csv(df: DataFrame, path: str, decimals: int = 6) -> None:
    """CSV with a header; floating-point columns are rounded to ``decimals``."""
    floating = (T.DoubleType, T.FloatType)
    rounded = [
        F.round(col(f.name), decimals).alias(f.name) if isinstance(f.dataType, floating) else col(f.name)
        for f in df.schema
    ]
    df.select(*rounded).write.mode("overwrite").option("header", True).csv(path)


def with_labels(features: DataFrame, labels: DataFrame, key: str, values: Sequence[str], label: str = "label") -> DataFrame:
    """Features joined with labels on a row key: null feature 0, no label UNKNOWN.

    Two position-aligned files have no meaning for a distributed reader, so the
    row key is written with both sides when they are split.
    """
    filled = features.select(
        key, *[F.coalesce(col(v), F.lit(0.0)).alias(v) for v in values]
    )
    return filled.join(labels.select(key, label), key, "left").withColumn(
        label, F.coalesce(col(label), F.lit("UNKNOWN"))
    )
