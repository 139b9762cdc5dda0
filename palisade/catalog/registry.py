"""Named queries over a directory of tables, each with SQL for the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.functions.numeric import col

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Tables of a directory as attributes: ``Tables(spark, dir).events``."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self.directory = spark, directory.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.directory}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def query(name: str, sql: str | None = None):
    """Register a function ``Tables -> DataFrame`` and, if there is one, its SQL."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, directory: build(Tables(spark, directory))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def plain(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Comparable output: whole numbers as long, fractions rounded, dates as text.

    ``special`` gives other digits for single columns.  Adding zero turns a rounded
    negative zero into zero.
    """
    out = []
    for field in df.schema:
        c, kind = col(field.name), field.dataType
        if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), special.get(field.name, digits)) + F.lit(0.0)
        elif isinstance(kind, (T.IntegralType, T.BooleanType)):
            c = c.cast("long") if not isinstance(kind, T.BooleanType) else c.cast("int").cast("long")
        elif isinstance(kind, (T.DateType,)):
            c = c.cast("string")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(field.name))
    return df.select(*out)


def num(expression: str, name: str, digits: int = 6) -> str:
    """SQL for a rounded fraction."""
    return f"ROUND(CAST({expression} AS DOUBLE), {digits}) + 0.0 AS {name}"


def whole(expression: str, name: str) -> str:
    """SQL for a whole number."""
    return f"CAST({expression} AS BIGINT) AS {name}"


def flag_sql(condition: str, name: str) -> str:
    return f"CAST(CASE WHEN {condition} THEN 1 ELSE 0 END AS BIGINT) AS {name}"


def text_time(expression: str, name: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S') AS {name}"
