"""Reports, snapshots and value series kept in JSON and CSV files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.functions.numeric import col

SNAPSHOT = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField(
            "endpoints",
            T.MapType(
                T.StringType(),
                T.StructType(
                    [
                        T.StructField("endpoint", T.StringType()),
                        T.StructField("status", T.StringType()),
                        T.StructField("metrics", T.MapType(T.StringType(), T.StringType())),
                    ]
                ),
            ),
        ),
    ]
)


def write_report(df: DataFrame, path: str) -> None:
    """JSON report of nested columns; replaces the previous one."""
    df.write.mode("overwrite").json(path)


def append_snapshots(df: DataFrame, path: str) -> None:
    """One JSON line per snapshot, added to those already there."""
    df.write.mode("append").json(path)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Snapshot lines; blank and malformed ones are skipped."""
    return spark.read.schema(SNAPSHOT).option("mode", "DROPMALFORMED").json(path)


def snapshot_metric(line: str | Column, path: str, scale: float = 1e-6) -> Column:
    """Numeric field of a JSON text line times ``scale``; null for anything else."""
    text = F.get_json_object(col(line), path)
    return text.try_cast("double") * F.lit(scale)


def read_metric_series(
    spark: SparkSession, path: str, endpoint: str, metric: str, scale: float = 1e-6
) -> DataFrame:
    """(timestamp, value) of one metric of one endpoint, ordered by nothing."""
    value = F.col("endpoints")[endpoint]["metrics"][metric].try_cast("double") * F.lit(scale)
    return (
        read_snapshots(spark, path)
        .select("timestamp", value.alias("value"))
        .where(F.col("value").isNotNull())
    )


def read_number_column(spark: SparkSession, path: str, column: str = "mse_error") -> DataFrame:
    """Numbers of one CSV column, or of the first one; text cells are skipped."""
    df = spark.read.option("header", True).csv(path)
    chosen = column if column in df.columns else df.columns[0]
    value = col(chosen).try_cast("double")
    return df.select(value.alias("value")).where(F.col("value").isNotNull())
