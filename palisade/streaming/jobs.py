"""Structured Streaming forms of the monitoring and user-day operators.

Every function takes and returns a streaming DataFrame; ``run_available`` drains
what is there into a Parquet table with a checkpoint and returns that table.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from palisade.functions import activity as A
from palisade.operators.drift import SPREAD_FLOOR
from palisade.operators.models import first_trigger
from palisade.operators.quality import trigger_record
from palisade.session import scratch_path

# The state store that timers and lists of stateful processors need.
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def started(writer: DataStreamWriter, spark: SparkSession):
    """Start a query with the state store of stateful processors, for this query only."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKS)
    try:
        return writer.start()
    finally:
        if before is None:
            spark.conf.unset(STORE)
        else:
            spark.conf.set(STORE, before)


def read_stream(spark: SparkSession, path: str, schema: T.StructType, when: str = "ts", files: int | None = None) -> DataFrame:
    """Parquet files as a stream; the event time becomes a zoned timestamp, which
    watermarks need."""
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.parquet(path).withColumn(when, F.col(when).cast("timestamp"))


def run_available(stream: DataFrame, name: str, mode: str = "append", target: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process everything available, then read the written table."""
    spark = stream.sparkSession
    target = target or scratch_path(spark, f"{name}-out")
    writer = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", target)
        .option("checkpointLocation", checkpoint or scratch_path(spark, f"{name}-checkpoint"))
        .trigger(availableNow=True)
    )
    query = started(writer, spark)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)


def append_snapshots(stream: DataFrame, path: str, checkpoint: str, every: str | None = None):
    """Write snapshots as JSON lines, once for all or on a fixed interval."""
    writer = stream.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def hourly_metrics(
    stream: DataFrame, when: str, endpoint: str, value: str, failed: Column, span: str = "1 hour", late: str = "1 hour"
) -> DataFrame:
    """Calls, errors, mean and maximum per endpoint and hour, once the hour is over."""
    return (
        stream.withWatermark(when, late)
        .groupBy(F.window(when, span).alias("w"), endpoint)
        .agg(
            F.count("*").alias("invocations"),
            F.count_if(failed).alias("errors_5xx"),
            F.avg(value).alias("latency_average"),
            F.max(value).alias("latency_max"),
        )
        .select(F.col("w.start").alias("window_start"), endpoint, "invocations", "errors_5xx", "latency_average", "latency_max")
    )


def hourly_confusion(
    stream: DataFrame, when: str, truth: Column, predicted: Column, span: str = "1 hour", late: str = "1 hour"
) -> DataFrame:
    """Confusion counts per hour of a stream of labelled predictions."""
    return (
        stream.withWatermark(when, late)
        .groupBy(F.window(when, span).alias("w"))
        .agg(
            F.count_if(truth & predicted).alias("tp"),
            F.count_if(~truth & predicted).alias("fp"),
            F.count_if(truth & ~predicted).alias("fn"),
            F.count_if(~truth & ~predicted).alias("tn"),
        )
        .select(F.col("w.start").alias("hour"), "tp", "fp", "fn", "tn")
    )


def user_day_counts(stream: DataFrame, when: str = "ts", late: str = "1 hour") -> DataFrame:
    """Logon-style counts per user and day, emitted when the day is over."""
    flagged = stream.withWatermark(when, late).withColumns(
        {
            "after_hours_flag": A.after_hours(F.hour(when)),
            "weekend_flag": A.weekend(A.iso_weekday(when)),
            "hour": F.hour(when),
        }
    )
    return (
        flagged.groupBy(F.window(when, "1 day").alias("w"), "user")
        .agg(
            F.count("*").alias("logon_count"),
            F.min("hour").alias("first_logon_hour"),
            F.max("hour").alias("last_activity_hour"),
            F.sum("after_hours_flag").alias("after_hours_logon_count"),
            F.max("weekend_flag").alias("weekend_flag"),
        )
        .select("user", F.to_date("w.start").alias("date"), "logon_count", "first_logon_hour", "last_activity_hour", "after_hours_logon_count", "weekend_flag")
    )


def with_lookup(stream: DataFrame, lookup: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Stream joined with a static list, 1 where the keys are listed."""
    marked = lookup.select(*keys).distinct().withColumn(name, F.lit(1))
    return stream.join(marked, list(keys), "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)))


def _millis(us: int) -> int:
    """The first watermark (in ms) that settles a time given in microseconds."""
    return -(-int(us) // 1000)


def _packed(columns: Mapping[str, pa.Array]) -> bytes:
    batch = pa.RecordBatch.from_pydict(dict(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(bytes(data)).read_all()


def _coded(*parts: pa.ChunkedArray) -> tuple[list[np.ndarray], pa.Array]:
    """Numbers of the series in each part (null is one too) and the series by number."""
    joined = pa.chunked_array([c for p in parts for c in p.chunks], pa.string()).combine_chunks()
    coded = joined.dictionary_encode(null_encoding="encode")
    ends = np.cumsum([len(p) for p in parts])[:-1]
    return np.split(coded.indices.to_numpy(zero_copy_only=False).astype("int64"), ends), coded.dictionary


class BucketProcessor(StatefulProcessor):
    """Rows of a bucket of series that wait until the watermark has passed them.

    Every access to the state is a round trip to the JVM, so one call serves all series
    of a bucket and its rows are held as Arrow batches.  A bucket has one timer.
    """

    PART = 50_000  # rows in one entry of the state

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", "data binary")
        self.waiting = handle.getListState("waiting", "data binary")
        self.due = handle.getValueState("due", "ms long")

    def wake(self, us: int) -> None:
        """Be called once the watermark has passed ``us``, or earlier."""
        ms, due = _millis(us), self.due.get()[0] if self.due.exists() else None
        if due is None or ms < due:
            if due is not None:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(ms)
            self.due.update((ms,))

    def wait(self, rows: pa.Table) -> None:
        for low in range(0, rows.num_rows, self.PART):
            part = rows.slice(low, self.PART)
            self.waiting.appendValue((_packed({n: part[n].combine_chunks() for n in part.column_names}),))

    def keep(self, rows: pa.Table) -> None:
        if rows.num_rows:
            self.kept.update((_packed({n: rows[n].combine_chunks() for n in rows.column_names}),))
        else:
            self.kept.clear()

    def arriving(self, rows: Iterator[pd.DataFrame], names: Mapping[str, str]) -> pa.Table | None:
        """Arrow rows without beats; ``names`` gives the columns and their types."""
        parts = []
        for batch in rows:
            batch = batch[~batch["beat"].astype(bool)]
            if len(batch):
                parts.append(pa.table({n: pa.array(batch[n], t, from_pandas=n == "series") for n, t in names.items()}))
        return pa.concat_tables(parts) if parts else None

    def held(self) -> pa.Table | None:
        """All waiting rows, which are taken out of the state with the timer that fired."""
        parts = [_unpacked(x[0]) for x in self.waiting.get()]
        self.waiting.clear()
        self.due.clear()
        return pa.concat_tables(parts) if parts else None

    def close(self) -> None:
        pass


class CooldownProcessor(BucketProcessor):
    """Fired alerts of a bucket of keys, in event-time order whatever order they arrive in.

    Alerts wait until the watermark has passed them, because an earlier one may still
    arrive.  Waiting times lie within the watermark's delay, and those that the last
    fired alert already silences are not kept.  The end of a cooldown is forgotten once
    the watermark has passed it.
    """

    NONE = pa.table({"series": pa.array([], pa.string()), "ready": pa.array([], pa.int64())})

    def __init__(self, key: str, width: int):
        self.key, self.width = key, width

    def ready(self, series: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """Numbers of ``series``, all series of the bucket, and when each may fire again."""
        kept = _unpacked(self.kept.get()[0]) if self.kept.exists() else self.NONE
        (codes, old), names = _coded(series, kept["series"])
        ready = np.full(len(names), np.iinfo("int64").min)
        ready[old] = kept["ready"].to_numpy()
        return codes, names, ready

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = self.arriving(rows, {"series": pa.string(), "moment_us": pa.int64()})
        if new is not None:
            codes, _, ready = self.ready(new["series"])
            new = new.filter(pa.array(new["moment_us"].to_numpy() >= ready[codes]))
            if new.num_rows:
                self.wait(new)
                self.wake(int(new["moment_us"].to_numpy().min()))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        settled, rows = timerValues.getCurrentWatermarkInMs() * 1000, self.held()
        if rows is None:
            rows = pa.table({"series": pa.array([], pa.string()), "moment_us": pa.array([], pa.int64())})
        codes, names, ready = self.ready(rows["series"])
        us = rows["moment_us"].to_numpy()
        order = np.lexsort((codes, us))
        codes, us = codes[order], us[order]
        end, fired = int(np.searchsorted(us, settled, side="right")), []
        ends, width = ready.tolist(), max(self.width, 1)
        for i, (c, t) in enumerate(zip(codes[:end].tolist(), us[:end].tolist(), strict=True)):
            if t >= ends[c]:
                ends[c] = t + width
                fired.append(i)
        ready = np.array(ends, dtype="int64")
        rest = end + np.flatnonzero(us[end:] >= ready[codes[end:]])
        # Equal times of a key lie side by side; one of them is enough.
        again = (np.diff(us[rest], prepend=-1) == 0) & (np.diff(codes[rest], prepend=-1) == 0)
        rest = rest[~again]
        later = np.flatnonzero(ready > settled)
        self.keep(pa.table({"series": names.take(pa.array(later)), "ready": pa.array(ready[later])}))
        if len(rest):
            self.wait(pa.table({"series": names.take(pa.array(codes[rest])), "moment_us": pa.array(us[rest])}))
            self.wake(int(us[rest[0]]))
        elif len(later):
            self.wake(int(ready[later].max()))
        if fired:
            yield pd.DataFrame({self.key: names.take(pa.array(codes[fired])).to_pandas(), "moment_us": us[fired]})


class RollingDriftProcessor(BucketProcessor):
    """Drift events of a bucket of series against their last ``width`` values.

    Rows wait until the watermark has passed them; then they go through the window of
    their series in the order of (time, order).
    """

    COLUMNS = {"series": pa.string(), "moment_us": pa.int64(), "row_order": pa.int64(), "row_value": pa.float64()}

    def __init__(self, key: str, width: int, limit: float):
        self.key, self.width, self.limit = key, width, limit

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = self.arriving(rows, self.COLUMNS)
        if new is not None:
            self.wait(new)
            self.wake(int(new["moment_us"].to_numpy().min()))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        settled, rows = timerValues.getCurrentWatermarkInMs() * 1000, self.held()
        if rows is None:
            return
        over = rows["moment_us"].to_numpy() <= settled
        rest = rows.filter(pa.array(~over))
        if rest.num_rows:
            self.wait(rest)
            self.wake(int(rest["moment_us"].to_numpy().min()))
        rows = rows.filter(pa.array(over))
        if not rows.num_rows:
            return
        # The last values of every series come before its new rows, in their order.
        past = _unpacked(self.kept.get()[0]) if self.kept.exists() else None
        old = 0 if past is None else past.num_rows
        (codes,), names = _coded(pa.chunked_array([*([] if past is None else past["series"].chunks), *rows["series"].chunks], pa.string()))
        us, order, values = (rows[n].to_numpy() for n in ("moment_us", "row_order", "row_value"))
        if old:
            us = np.concatenate([np.full(old, np.iinfo("int64").min), us])
            order = np.concatenate([np.arange(old), order])
            values = np.concatenate([past["row_value"].to_numpy(), values])
        ranked = np.lexsort((order, us, codes))
        new = ranked >= old
        codes, order, values = codes[ranked], order[ranked], values[ranked]
        starts = np.searchsorted(codes, codes, side="left")
        at = np.flatnonzero(new)
        z = np.concatenate([self.scores(values, starts, at[low : low + self.PART]) for low in range(0, len(at), self.PART)])
        last = np.searchsorted(codes, codes, side="right") - np.arange(len(codes)) < self.width
        self.keep(pa.table({"series": names.take(pa.array(codes[last])), "row_value": pa.array(values[last])}))
        hit = at[np.abs(z) > self.limit]
        if len(hit):
            yield pd.DataFrame(
                {self.key: names.take(pa.array(codes[hit])).to_pandas(), "row_order": order[hit], "row_value": values[hit], "z_score": z[np.abs(z) > self.limit]}
            )

    def scores(self, values: np.ndarray, starts: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Deviations of the rows ``at`` from the window that ends there, 0 in a flat one.

        Values that are no finite numbers are not in the windows.
        """
        back = at[:, None] - np.arange(self.width)
        window = values[np.maximum(back, 0)]
        inside = (back >= starts[at, None]) & np.isfinite(window)
        # Distances from the row itself: a flat window has exactly none.
        own = np.where(np.isfinite(values[at]), values[at], 0.0)
        far = np.where(inside, np.where(inside, window, 0.0) - own[:, None], 0.0)
        n = np.maximum(inside.sum(axis=1), 1)
        mean = far.sum(axis=1) / n
        std = np.sqrt((np.where(inside, far - mean[:, None], 0.0) ** 2).sum(axis=1) / n)
        return np.divide(values[at] - own - mean, std, out=np.zeros(len(at)), where=std > SPREAD_FLOOR)


# Stands for a null order, which comes first.
NO_ORDER = -(2**62)

# Series are dealt over this many buckets, each with one state and one timer.
BUCKETS = 1024


def _keyed(stream: DataFrame, key: str, when: str, late: str, beats: Column | None, *more: Column):
    """Rows grouped into buckets of series for a stateful processor.

    Keys travel as text and no other column is null: pandas turns whole numbers with a
    gap into fractions, which are other keys.
    """
    return (
        stream.withWatermark(when, late)
        .where(F.col(when).isNotNull())
        .select(
            F.col(key).cast("string").alias("series"),
            F.col(when).alias("moment"),
            F.unix_micros(when).alias("moment_us"),
            (F.lit(False) if beats is None else F.coalesce(beats, F.lit(False))).alias("beat"),
            *more,
        )
        .withColumn("bucket", F.pmod(F.xxhash64("series"), F.lit(BUCKETS)))
        .groupBy("bucket")
    )


def cooldown(
    stream: DataFrame, key: str, when: str, seconds: float, late: str = "1 hour", beats: Column | None = None
) -> DataFrame:
    """Fired alerts only: (key, fired_at), once the watermark has passed them.

    Rows for which ``beats`` is true are no alerts; they only move the watermark.
    """
    output = T.StructType([T.StructField("series", T.StringType()), T.StructField("moment_us", T.LongType())])
    return (
        _keyed(stream, key, when, late, beats)
        .transformWithStateInPandas(CooldownProcessor("series", int(round(seconds * 1_000_000))), output, "append", "eventTime")
        .select(F.col("series").cast(stream.schema[key].dataType).alias(key), F.timestamp_micros("moment_us").alias("fired_at"))
    )


def rolling_drift(
    stream: DataFrame,
    key: str,
    order: str,
    value: str,
    width: int,
    limit: float = 3.0,
    when: str = "ts",
    late: str = "1 hour",
    beats: Column | None = None,
) -> DataFrame:
    """Drift events per series: (key, order, value, z_score).

    Rows may come in any order within ``late``; they count in the order of time and
    ``order``.  Rows for which ``beats`` is true only move the watermark.
    """
    output = T.StructType(
        [T.StructField(n, t) for n, t in (("series", T.StringType()), ("row_order", T.LongType()), ("row_value", T.DoubleType()), ("z_score", T.DoubleType()))]
    )
    place = F.coalesce(F.col(order).cast("long"), F.lit(NO_ORDER)).alias("row_order")
    keyed = _keyed(stream, key, when, late, beats, place, F.col(value).cast("double").alias("row_value"))
    return keyed.transformWithStateInPandas(RollingDriftProcessor("series", width, limit), output, "append", "eventTime").select(
        F.col("series").cast(stream.schema[key].dataType).alias(key),
        F.nullif("row_order", F.lit(NO_ORDER)).alias(order),
        F.col("row_value").alias(value),
        "z_score",
    )


def trigger_sink(detections: DataFrame, key: str, path: str, checkpoint: str, defaults: Mapping[str, str] | None = None):
    """One JSON trigger record for each micro-batch with an anomalous row: its first.

    A batch that is run again replaces its own folder, so every batch counts once.
    ``detections`` has ``detect_vectors``' columns; a ``timestamp`` column is used if
    there is one, else the default.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        first = first_trigger(batch, key).withColumnRenamed("predicted_label", "attack_type")
        if "timestamp" not in first.columns:
            first = first.withColumn("timestamp", F.lit(None).cast("string"))
        trigger_record(first, defaults).coalesce(1).write.mode("overwrite").text(f"{path}/batch={batch_id}")

    writer = detections.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return started(writer.trigger(availableNow=True), detections.sparkSession)
