"""What is stored where: sizes, profiles and catalogs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.functions.numeric import col
from palisade.operators.ordered import attach
from palisade.operators.prep import repeatable_sample


# Fixed value: the class of rows without a label.
UNKNOWN = "UNKNOWN"


def stored_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes under a directory, from the file listing alone."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length")
    )
    return files.agg(
        F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    )


def size_reduction(spark: SparkSession, before: str, after: str) -> DataFrame:
    """Bytes of two datasets and the reduction in percent."""
    old = stored_bytes(spark, before).select(F.lit("before").alias("side"), "bytes")
    new = stored_bytes(spark, after).select(F.lit("after").alias("side"), "bytes")

    def of(side: str):
        return F.max(F.when(F.col("side") == side, F.col("bytes")))

    totals = old.unionByName(new).agg(
        of("before").alias("bytes_before"), of("after").alias("bytes_after")
    )
    saved = F.try_divide(
        (F.col("bytes_before") - F.col("bytes_after")) * 100.0, F.col("bytes_before")
    )
    return totals.withColumn("reduction_pct", F.round(saved, 2))


def dataset_profile(df: DataFrame) -> DataFrame:
    """One row per column: type, non-null and null counts, min and max as text.

    All columns are profiled in a single pass over the data.
    """
    parts = []
    for index, field in enumerate(df.schema):
        c = col(field.name)
        parts += [
            F.count(c).alias(f"n{index}"),
            F.min(c).cast("string").alias(f"lo{index}"),
            F.max(c).cast("string").alias(f"hi{index}"),
        ]
    totals = df.agg(F.count("*").alias("rows"), *parts)
    entries = [
        F.struct(
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.col("rows"),
            F.col(f"n{index}").alias("non_null"),
            (F.col("rows") - F.col(f"n{index}")).alias("nulls"),
            F.col(f"lo{index}").alias("min_value"),
            F.col(f"hi{index}").alias("max_value"),
        )
        for index, field in enumerate(df.schema)
    ]
    return totals.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def file_count(df: DataFrame) -> DataFrame:
    """Number of data files and rows behind a file-based table."""
    return df.select(F.col("_metadata.file_path").alias("file")).agg(
        F.count_distinct("file").alias("files"), F.count("*").alias("rows")
    )


def flow_catalog(df: DataFrame, label: str = "Label", day: str = "day") -> DataFrame:
    """Per day: rows, attack classes seen, class counts as a map.

    Rows are first counted per (day, class), so the collected map is as small as
    the number of classes.
    """
    counts = df.groupBy(day, F.coalesce(col(label), F.lit(UNKNOWN)).alias(label)).agg(F.count("*").alias("n"))
    return counts.groupBy(day).agg(
        F.sum("n").alias("rows"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(label, "n")))).alias("distribution"),
        F.sort_array(F.collect_set(label)).alias("classes"),
    ).withColumn("columns", F.lit(len([c for c in df.columns if c != day])))


def file_catalog(df: DataFrame, label: str = "Label") -> DataFrame:
    """Per file of a file-based table: name, bytes, rows, columns, class counts and classes;
    and one row of totals, whose file is null.  Rows without a class count as UNKNOWN.

    Path and size come with the rows from the file system, so nothing is listed on the
    driver.  Rows are counted by (file, class); what is gathered is as small as the classes.
    """
    counts = df.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"),
        F.coalesce(col(label), F.lit(UNKNOWN)).alias("class"),
    ).groupBy("file", "bytes", "class").agg(F.count("*").alias("n"))
    whole = F.grouping("file").alias("whole")
    spread = counts.groupingSets([["file", "class"], ["class"]], "file", "class").agg(whole, F.sum("n").alias("n"))
    classes = spread.groupBy("whole", "file").agg(
        F.sum("n").alias("rows"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("class", "n")).alias("d"))).alias("distribution"),
        F.array_sort(F.collect_set("class")).alias("classes"),
    )
    files = counts.groupBy("file").agg(F.max("bytes").alias("bytes"))
    sizes = files.rollup("file").agg(whole, F.sum("bytes").alias("bytes"), F.count("*").alias("files"))
    return attach(classes, sizes, ["whole", "file"]).select(
        "file", "files", "bytes", "rows", F.lit(len(df.columns)).alias("columns"), "distribution", "classes"
    )


def profile_with_sample(df: DataFrame, key: Sequence[str], rows: int = 5) -> DataFrame:
    """``dataset_profile`` with a repeatable sample of each column's values as text."""
    sample = repeatable_sample(df, rows, key)
    gathered = sample.agg(
        *[F.collect_list(F.coalesce(col(c).cast("string"), F.lit("null"))).alias(c) for c in df.columns]
    )
    values = gathered.unpivot([], [col(c) for c in df.columns], "column", "sample")
    return dataset_profile(df).join(values, "column")
