"""Readers and layer writers for user-activity logs."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.functions.activity import TIMESTAMP_PATTERNS, parse_timestamp

log = logging.getLogger(__name__)

_TEXT = T.StringType()


def _schema(*names: str, booleans: Sequence[str] = ()) -> T.StructType:
    return T.StructType(
        [T.StructField(n, T.BooleanType() if n in booleans else _TEXT) for n in names]
    )


# Columns the derivations use; the reader matches header names and ignores others.
LOG_SCHEMAS = {
    "logon": _schema("date", "user", "pc"),
    "device": _schema("date", "user", "activity"),
    "http": _schema("date", "user", "url"),
    "email": _schema("date", "user", "to", "cc", "bcc", "activity", "attachments"),
    "file": _schema(
        "date", "user", "pc", "filename", "activity", "to_removable_media",
        "from_removable_media", "content",
        booleans=("to_removable_media", "from_removable_media"),
    ),
    "decoy_file": _schema("decoy_filename", "pc"),
    "insiders": _schema("dataset", "user", "start", "end"),
}

PARTITION_PARTS = {"year": 1, "month": 2, "day": 3}


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, multiline: bool = False
) -> DataFrame:
    """CSV with a header; ``schema`` names the wanted columns in any order.

    Each file's header is read first (a handful of bytes); files with the same header
    are read together, so columns are matched by name and the declared types are used
    without an inference pass over the data.
    ``multiline`` allows line breaks inside quotes, at the price of one task per file.
    """
    types = {f.name.strip().lower(): f.dataType for f in schema}
    parts = []
    for names, files in files_by_header(spark, path).items():
        full = T.StructType([T.StructField(n, types.get(n.strip().lower(), _TEXT)) for n in names])
        reader = spark.read.option("header", True).option("multiLine", multiline).option("escape", '"')
        df = reader.schema(full).option("enforceSchema", False).csv(files)
        by_name = {n.strip().lower(): n for n in names}
        missing = [f.name for f in schema if f.name.lower() not in by_name]
        if missing:
            raise KeyError(f"columns {missing} not found in {files}")
        parts.append(df.select(*[F.col(f"`{by_name[f.name.lower()]}`").alias(f.name) for f in schema]))
    return reduce(DataFrame.unionByName, parts)


def files_by_header(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files of a path, list or glob by their header."""
    found: dict[tuple[str, ...], list[str]] = {}
    for file in sorted(spark.read.text(path).inputFiles()):
        names = spark.read.option("header", True).option("escape", '"').csv(file).columns
        found.setdefault(tuple(names), []).append(file)
    if not found:
        raise FileNotFoundError(f"no file at {path}")
    return found


def read_parquet(spark: SparkSession, path: str, rows: int | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.limit(rows) if rows and rows > 0 else df


def capped(df: DataFrame, rows: int | None, order: Sequence[Column | str]) -> DataFrame:
    """At most ``rows`` rows, the same ones in every run."""
    return df.orderBy(*order).limit(rows) if rows and rows > 0 else df


def with_timestamp(
    df: DataFrame, source: str = "date", patterns: Sequence[str] = TIMESTAMP_PATTERNS
) -> DataFrame:
    """Parse the text column into ``timestamp`` and drop it, when it is there."""
    if source not in df.columns:
        return df
    return df.withColumn("timestamp", parse_timestamp(source, patterns)).drop(source)


def with_partition_columns(
    df: DataFrame, column: str = "timestamp", granularity: str = "day"
) -> tuple[DataFrame, list[str]]:
    """Add year / month / day down to ``granularity`` and name the columns added."""
    if column not in df.columns:
        raise KeyError(f"partition column '{column}' not found")
    depth = PARTITION_PARTS.get((granularity or "day").casefold())
    if depth is None:
        log.warning("unknown partition granularity %r: written without partitions", granularity)
        return df, []
    when = F.col(column)
    parts = {"year": F.year(when), "month": F.month(when), "day": F.dayofmonth(when)}
    chosen = dict(list(parts.items())[:depth])
    return df.withColumns(chosen), list(chosen)


def write_layer(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = (),
    overwrite: bool = False,
    codec: str = "zstd",
    level: int = 3,
) -> None:
    """Parquet table; an existing one is replaced or, by default, left alone.

    Rows are rebalanced by the partition columns, so that one day becomes neither
    thousands of small files nor one huge task: adaptive execution splits a
    partition that grows beyond the advisory size.
    """
    if partitions:
        df = df.hint("rebalance", *[F.col(p) for p in partitions])
    writer = (
        df.write.mode("overwrite" if overwrite else "ignore")
        .option("compression", codec)
        .option("parquet.compression.codec.zstd.level", str(level))
    )
    if overwrite:
        writer = writer.option("partitionOverwriteMode", "static")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(path)


# Files that a task may hold open at once; each gathers a row group in memory.
OPEN_FILES = 8
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def write_folders(df: DataFrame, path: str, column: str, open_files: int = OPEN_FILES) -> None:
    """Parquet folders by the values of ``column``, of which a task should hold few.

    A task keeps a file open for each value instead of sorting all its rows by it first;
    with more than ``open_files`` values in a task Spark sorts the rest.
    """
    spark = df.sparkSession
    before = spark.conf.get(WRITERS, None)
    spark.conf.set(WRITERS, open_files)
    try:
        df.write.partitionBy(column).parquet(path)
    finally:
        spark.conf.set(WRITERS, before) if before is not None else spark.conf.unset(WRITERS)


def ingest_csv(
    spark: SparkSession,
    source: str,
    target: str,
    schema: T.StructType,
    granularity: str | None = "day",
    overwrite: bool = False,
    rows: int | None = None,
    patterns: Sequence[str] = TIMESTAMP_PATTERNS,
) -> None:
    """CSV file(s) to a bronze Parquet table; ``granularity=None`` for lookups."""
    df = with_timestamp(read_csv(spark, source, schema), patterns=patterns)
    df = capped(df, rows, df.columns)
    partitions: list[str] = []
    if granularity is not None:
        df, partitions = with_partition_columns(df, "timestamp", granularity)
    write_layer(df, target, partitions, overwrite)


def day_partition(df: DataFrame, year: int, month: int, day: int) -> DataFrame:
    """One day of a bronze table; the filter prunes directories."""
    return df.where((F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day))


def read_day(spark: SparkSession, path: str, year: int, month: int, day: int) -> DataFrame:
    """One day of a table written with granularity ``day``; other folders are not opened."""
    return day_partition(read_parquet(spark, path), year, month, day)
