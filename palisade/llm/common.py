"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.session import scratch_path

# White space between words: space, tab, line feed, vertical tab, form feed, return.
SPACES = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read back.

    This cuts the lineage in storage that every executor sees; a lost executor
    costs its running tasks only.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    result = df.sparkSession.read.schema(df.schema).parquet(path)
    result.stored_at = path
    return result


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` wrote and nothing will read again."""
    for df in tables:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def arrow_batches(spark: SparkSession, size: str):
    """Jobs run inside hand Python at most about ``size`` bytes of rows at a time.

    A batch is held by the JVM and by Python at once, by every running task.
    """
    return _set(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": size})


def bloom_filters(spark: SparkSession):
    """Joins run inside drop rows without a partner by Spark's Bloom filters before they move
    them, from small tables on and for up to 1 GB of keys; a filter has 8 MB at most."""
    name = "spark.sql.optimizer.runtime.bloomFilter."
    return _set(spark, {name + "enabled": "true", name + "applicationSideScanSizeThreshold": "1m", name + "creationSideThreshold": "1g"})


def words_of(text: Column) -> Column:
    """Words of a text as an array; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES + "+", -1), lambda w: w != "")


def held(value: Column) -> Column:
    """``value``, evaluated once per row.

    The row id keeps the optimizer from copying the expression to where it is used:
    a copied array inside a lambda would be computed again for every element.
    """
    return F.when(F.monotonically_increasing_id() >= 0, value)


def word_texts(column) -> list:
    """Lists of words (bytes, A-Z in lower case) of an Arrow string column.

    ``bytes.lower`` and ``bytes.split`` touch ASCII letters and the six ASCII white
    space characters only.
    """
    import pyarrow as pa

    return [(t or b"").lower().split() for t in column.cast(pa.binary()).to_pylist()]


def flat_words(column):
    """(words, ends) of an Arrow string column: the words of ``word_texts`` end to end as an
    Arrow binary array, and after how many of them each text ends."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(column.cast(pa.string()), "")))
    words, stops = pc.list_flatten(parts).cast(pa.binary()), np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    some = pc.greater(pc.binary_length(words), 0)  # white space at an end of a text leaves an empty part
    kept = np.append(0, np.cumsum(some.to_numpy(zero_copy_only=False)))
    return words.filter(some), kept[stops]
