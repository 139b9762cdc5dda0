"""User-activity layers: CSV to bronze, silver, gold and the labelled table."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.operators import userday as U
from palisade.operators.prep import drop_present
from palisade.operators.profile import constant_columns
from palisade.sources import logs
from palisade.sources.flows import path_exists

# Folder name of rows without a date.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"

SILVER = {
    "logon": U.silver_logon,
    "device": U.silver_device,
    "http": U.silver_http,
    "email": U.silver_email,
    "file": U.silver_file,
    "decoy_file": U.decoy_lookup,
}


def ingest(
    spark: SparkSession, raw_dir: str, bronze_dir: str, overwrite: bool = False, rows: int | None = None
) -> None:
    """All raw logs to bronze; the decoy list is a lookup without partitions."""
    for name in SILVER:
        logs.ingest_csv(
            spark,
            f"{raw_dir}/{name}.csv",
            f"{bronze_dir}/{name}",
            logs.LOG_SCHEMAS[name],
            granularity=None if name == "decoy_file" else "day",
            overwrite=overwrite,
            rows=rows,
        )


def build_silver(spark: SparkSession, bronze_dir: str, silver_dir: str, overwrite: bool = False) -> None:
    """Flagged events of every log; existing tables are kept unless overwritten."""
    for name, derive in SILVER.items():
        partitions = [] if name == "decoy_file" else ["date"]
        derived = derive(spark.read.parquet(f"{bronze_dir}/{name}"))
        derived = derived.drop("year", "month", "day")
        logs.write_layer(derived, f"{silver_dir}/{name}", partitions, overwrite, codec="snappy")


def gold_tables(silver: Mapping[str, DataFrame], exact: bool = False) -> dict[str, DataFrame]:
    """The five user-day feature tables, lazily, in merge order."""
    return {
        "logon": U.logon_features(silver["logon"]),
        "device": U.device_features(silver["device"]),
        "email": U.email_features(silver["email"]),
        "file": U.file_features(silver["file"], silver["decoy_file"], exact),
        "http": U.http_features(silver["http"], exact),
    }


def build_gold(spark: SparkSession, silver_dir: str, gold_dir: str, overwrite: bool = False) -> None:
    silver = {name: spark.read.parquet(f"{silver_dir}/{name}") for name in SILVER}
    for name, table in gold_tables(silver).items():
        logs.write_layer(table, f"{gold_dir}/{name}_features", (), overwrite, codec="snappy")


def stored_days(spark: SparkSession, path: str) -> DataFrame:
    """(date, signature) of every ``date=`` folder, from the file listing alone.

    The signature changes whenever a file of the day is added, replaced or removed.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select(F.regexp_extract("path", r"/date=([^/]+)/", 1).alias("date"), "path", "length", "modificationTime")
    )
    mark = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    text = F.concat_ws("|", F.count("*"), F.sum("length"), F.max("modificationTime").cast("string"), F.sum(mark).cast("string"))
    return files.groupBy("date").agg(F.md5(text).alias("signature"))


LEDGER = "date string, signature string, run long"


def stale_days(spark: SparkSession, source: str, cache: str, redo: Sequence[str] = ()) -> DataFrame:
    """(date, signature) of days that ``cache`` lacks or holds from other files, and of ``redo``."""
    days = stored_days(spark, source)
    ledger = f"{cache}/_days"
    if not path_exists(spark, ledger):
        return days
    done = spark.read.schema(LEDGER).json(ledger).groupBy("date").agg(F.max_by("signature", "run").alias("known"))
    return days.join(done, "date", "left").where(
        F.col("known").isNull() | (F.col("known") != F.col("signature")) | F.col("date").isin(*redo)
    ).select("date", "signature")


def rows_of_days(df: DataFrame, dates: Sequence[str]) -> DataFrame:
    """Rows of the named days; the literal dates prune folders before anything is read."""
    known = [d for d in dates if d != NO_DATE]
    wanted = F.col("date").isin(*[F.lit(d).cast("date") for d in known]) if known else F.lit(False)
    return df.where(wanted | F.col("date").isNull() if NO_DATE in dates else wanted)


def refresh_http_days(spark: SparkSession, silver_dir: str, cache_dir: str, redo: Sequence[str] = ()) -> DataFrame:
    """Daily web aggregates, computing only days that are new, changed or in ``redo``.

    Stale days replace their folders and others stay.  A day counts as done once its
    signature is in the ledger, which is written last, so a broken run is repeated by
    the next one, and late rows make their day stale.  One small row per calendar day
    passes through the driver.  Returns the complete table.
    """
    source = f"{silver_dir}/http"
    stale = [tuple(r) for r in stale_days(spark, source, cache_dir, redo).collect()]
    if stale:
        todo = rows_of_days(spark.read.parquet(source), [d for d, _ in stale])
        daily = U.daily_http(todo)
        daily.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(cache_dir)
        rows = [(d, s, time.time_ns()) for d, s in stale]
        spark.createDataFrame(rows, LEDGER).coalesce(1).write.mode("append").json(f"{cache_dir}/_days")
    return spark.read.parquet(cache_dir)


def labelled_from_silver(silver: Mapping[str, DataFrame], insiders: DataFrame, exact: bool = False) -> DataFrame:
    """``labelled_days`` straight from the silver tables; all logs meet in one shuffle."""
    return U.label_periods(U.merged_features(silver, exact), insiders)


def labelled_days(gold: Mapping[str, DataFrame], insiders: DataFrame) -> DataFrame:
    """One row per user and date with all features and the 0/1 target."""
    first, *rest = gold.values()
    return U.label_periods(U.merge_gold(first, rest), insiders)


def labelled_from_disk(
    spark: SparkSession, gold_dir: str, insiders_csv: str, dataset: float = 6.2, fixes: Mapping[str, str] | None = None
) -> DataFrame:
    """Labelled table from stored gold, without constant columns."""
    order = ("logon", "device", "email", "file", "http")
    gold = {n: spark.read.parquet(f"{gold_dir}/{n}_features") for n in order}
    insiders = U.insider_periods(
        logs.read_csv(spark, insiders_csv, logs.LOG_SCHEMAS["insiders"]), dataset, dict(fixes or {})
    )
    table = labelled_days(gold, insiders)
    return drop_present(table, [c for c in constant_columns(table) if c != "target"])

