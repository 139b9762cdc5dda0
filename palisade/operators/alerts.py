"""Metric snapshots, threshold checks, alert rows and cooldown."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.functions.numeric import col
from palisade.operators.ordered import attach
from palisade.operators.quantiles import quantile_columns

# Endpoint states that raise no alert.
HEALTHY_STATES = ("InService", "Updating")


def snapshots(
    df: DataFrame,
    when: str,
    endpoint: str,
    latency_us: str,
    failed: Column,
    lookback: str = "1 hour",
    method: str = "ranks",
) -> DataFrame:
    """Metrics per endpoint and lookback window: calls, errors, latency statistics."""
    timed = df.withColumns({"window_start": F.window(col(when), lookback)["start"], "__failed": failed})
    keys = ["window_start", endpoint]
    metrics = timed.groupBy(*keys).agg(
        F.count("*").alias("invocations"),
        F.count_if("__failed").alias("errors_5xx"),
        F.avg(latency_us).alias("latency_average"),
        F.max(latency_us).alias("latency_max"),
    )
    tails = quantile_columns(timed, latency_us, {"latency_p90": 0.9, "latency_p99": 0.99}, keys, method)
    return attach(metrics, tails, keys)


def latest_snapshot(df: DataFrame, when: str, endpoint: str) -> DataFrame:
    """The newest row per endpoint."""
    return df.groupBy(endpoint).agg(F.max_by(F.struct(*df.columns), col(when)).alias("t")).select("t.*")


def latest_values(df: DataFrame, metric: str, value: str, when: Sequence[str]) -> DataFrame:
    """Most recent value per metric; later columns of ``when`` break ties."""
    return df.groupBy(metric).agg(F.max_by(value, F.struct(*when)).alias(value))


def threshold_level(value: Column, warning: float, critical: float) -> Column:
    return (
        F.when(value >= critical, F.lit("CRITICAL")).when(value >= warning, F.lit("WARNING"))
    )


def checked(
    df: DataFrame,
    latency_us: str = "latency_p99",
    errors: str = "errors_5xx",
    calls: str = "invocations",
    latency_ms: tuple[float, float] = (200.0, 500.0),
    error_pct: tuple[float, float] = (1.0, 5.0),
) -> DataFrame:
    """Latency in ms, error rate in percent and the level each of them reaches."""
    calls_or_one = F.when(F.coalesce(col(calls), F.lit(0)) == 0, 1).otherwise(col(calls))
    measured = df.withColumns(
        {
            "latency_ms": col(latency_us) / 1000.0,
            "error_rate_pct": F.when(col(errors) > 0, col(errors) * 100.0 / calls_or_one),
        }
    )
    return measured.withColumns(
        {
            "latency_level": threshold_level(F.col("latency_ms"), *latency_ms),
            "error_level": threshold_level(F.col("error_rate_pct"), *error_pct),
        }
    )


def alert_rows(df: DataFrame, endpoint: str, when: str, status: str | None = None) -> DataFrame:
    """One row per breach: key, level, subject and body, in long form."""
    name = col(endpoint)
    latency_text = F.format_string("%d ms", F.round("latency_ms", 0).cast("long"))
    rate_text = F.concat(F.round("error_rate_pct", 1).cast("string"), F.lit("%"))

    def alert(condition: Column, key: Column, level: Column, subject: Column, body: Column) -> Column:
        made = F.struct(
            key.alias("key"), level.alias("level"), subject.alias("subject"), body.alias("body")
        )
        return F.when(condition, made)

    latency, errors = F.col("latency_level"), F.col("error_level")
    made = [
        alert(
            latency.isNotNull(),
            F.concat(name, F.lit("_latency_"), F.lower(latency)),
            latency,
            F.concat(F.lit("latency of "), name, F.lit(": "), latency_text),
            F.concat(name, F.lit(" p99 latency is "), latency_text),
        ),
        alert(
            errors.isNotNull(),
            F.concat(name, F.lit("_error_rate_"), F.lower(errors)),
            errors,
            F.concat(F.lit("5xx errors of "), name, F.lit(": "), rate_text),
            F.concat(
                name,
                F.lit(" error rate is "),
                rate_text,
                F.lit("; errors "),
                col("errors_5xx").cast("string"),
                F.lit(" of "),
                col("invocations").cast("string"),
            ),
        ),
    ]
    if status is not None:
        state = col(status)
        made.append(
            alert(
                ~state.isin(*HEALTHY_STATES),
                F.concat(name, F.lit("_status")),
                F.lit("CRITICAL"),
                F.concat(F.lit("endpoint "), name, F.lit(" is "), state),
                F.concat(name, F.lit(" has status "), state),
            )
        )
    return df.select(col(when), name, F.explode(F.array_compact(F.array(*made))).alias("a")).select(
        when, endpoint, "a.*"
    )


# ---- cooldown ---------------------------------------------------------------

_LONG_AGO = -(2**62)
BLOCK_ALERTS, BLOCK_COOLDOWNS = 50_000, 64
_NOTHING = object()


def _same(a, b) -> bool:
    return a == b or (a is not _NOTHING and b is not _NOTHING and pd.isna(a) and pd.isna(b))


def _by_group(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Rows of a group in one partition, next to each other and in order."""
    return df.repartition(*keys).sortWithinPartitions(*keys, *order)


def _runs(frame: pd.DataFrame, keys: Sequence[str]) -> Iterator[tuple[int, int]]:
    """Row ranges of equal keys in a sorted frame."""
    if frame.empty:
        return
    changed = np.zeros(len(frame) - 1, dtype=bool)
    for key in keys:
        codes = pd.factorize(frame[key], use_na_sentinel=True)[0]
        changed |= codes[1:] != codes[:-1]
    edges = [0, *(np.flatnonzero(changed) + 1), len(frame)]
    yield from zip(edges, edges[1:])


def _whole_groups(batches: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[pd.DataFrame]:
    """Sorted batches regrouped so that no group is cut; one group is held at most."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        *_, (last, _) = _runs(batch, keys)
        if last > 0:
            yield pd.concat([*held, batch.iloc[:last]], ignore_index=True)
            held = [batch.iloc[last:]]
        elif held and not all(_same(held[-1][k].iat[-1], batch[k].iat[0]) for k in keys):
            yield pd.concat(held, ignore_index=True)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield pd.concat(held, ignore_index=True)


def _block_table(us: np.ndarray, reach: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First alert taken in a block -> last alert fired in it.

    ``us`` is sorted and distinct.  Only alerts before ``reach`` (block start plus
    cooldown) and the one after them can be the first; runs with the same outcome
    are kept as their last entry.
    """
    after = np.searchsorted(us, us + width, side="left")
    last = np.arange(len(us))
    for i in range(len(us) - 1, -1, -1):
        if after[i] < len(us):
            last[i] = last[after[i]]
    entries = min(int(np.searchsorted(us, reach, side="left")) + 1, len(us))
    exits = us[last[:entries]]
    ends = np.append(exits[1:] != exits[:-1], True)
    return us[:entries][ends], exits[ends]


def cooldown(
    df: DataFrame,
    key: str,
    when: str,
    seconds: float,
    tie: Sequence[str] = (),
    block_seconds: float | None = None,
    name: str = "fired",
) -> DataFrame:
    """Mark alerts that fire: the first of a key, then the first one at least
    ``seconds`` after the last one that fired.

    Which alert fires depends on the whole past of its key, but the past reaches a
    time block only through the last firing before it.  So blocks are worked out
    separately: each one reduces to a short table "first alert taken -> last alert
    fired", a key chains its blocks' tables, and then every block knows where to
    start.  No task ever holds all alerts of a key.
    """
    width = int(round(seconds * 1_000_000))
    # Text keys survive the trip through pandas unchanged, whatever their type.
    stamped = df.withColumns(
        {"__us": F.unix_micros(col(when).cast("timestamp")), "__key": col(key).cast("string")}
    )
    if width <= 0:
        return stamped.withColumn(name, F.lit(True)).drop("__us", "__key")
    times = stamped.select("__key", "__us").where("__us IS NOT NULL").distinct()
    if block_seconds is None:
        # As many cooldowns as keep the fullest block near BLOCK_ALERTS distinct times.
        slots = times.groupBy("__key", F.floor(F.col("__us") / F.lit(width))).agg(F.count("*").alias("n"))
        peak = slots.agg(F.max("n")).first()[0] or 1
        block = width * max(1, min(BLOCK_COOLDOWNS, BLOCK_ALERTS // peak))
    else:
        block = max(int(round(block_seconds * 1_000_000)), width)
    times = times.withColumn("__block", F.floor(F.col("__us") / F.lit(block)).cast("long"))

    def reduce_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _whole_groups(batches, ["__key", "__block"]):
            rows = []
            for first, last in _runs(frame, ["__key", "__block"]):
                us = frame["__us"].to_numpy()[first:last]
                number = frame["__block"].iat[first]
                entry, leave = _block_table(us, int(number) * block + width, width)
                rows.append((frame["__key"].iat[first], number, entry, leave))
            yield pd.DataFrame(rows, columns=["__key", "__block", "entry", "exit"])

    tables = _by_group(times, ["__key", "__block"], ["__us"]).mapInPandas(
        reduce_blocks, "__key string, __block long, entry array<long>, exit array<long>"
    )

    def chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, ready = _NOTHING, _LONG_AGO
        for frame in batches:
            starts = []
            for owner, entry, leave in zip(frame["__key"], frame["entry"], frame["exit"]):
                if not _same(owner, current):
                    current, ready = owner, _LONG_AGO
                starts.append(ready)
                at = int(np.searchsorted(entry, ready, side="left"))
                if at < len(entry):
                    ready = int(leave[at]) + width
            yield pd.DataFrame(
                {"__key": frame["__key"], "__block": frame["__block"], "__us": starts, "__start": True}
            )

    markers = _by_group(tables, ["__key"], ["__block"]).mapInPandas(
        chain, "__key string, __block long, __us long, __start boolean"
    )

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _whole_groups(batches, ["__key", "__block"]):
            moments, fired = frame["__us"].to_numpy(), []
            for first, last in _runs(frame, ["__key", "__block"]):
                # The first row of a block is its start; each jump finds the next alert to fire.
                us = moments[first + 1 : last]
                at = int(np.searchsorted(us, moments[first], side="left"))
                while at < len(us):
                    fired.append(first + 1 + at)
                    at = int(np.searchsorted(us, us[at] + width, side="left"))
            yield frame.iloc[fired][["__key", "__us"]]

    # The start of a block is a marker row that sorts before the block's alerts, so
    # blocks and starts meet in one shuffle.
    marked_times = times.withColumn("__start", F.lit(False)).unionByName(markers)
    fired = (
        _by_group(marked_times, ["__key", "__block"], [F.desc("__start"), F.col("__us")])
        .mapInPandas(walk, "__key string, __us long")
        .withColumn("__hit", F.lit(True))
    )
    place = F.row_number().over(Window.partitionBy("__key", "__us").orderBy(*[col(t) for t in tie or [when]]))
    marked = attach(stamped.withColumn("__place", place), fired, ["__key", "__us"], "left")
    return marked.withColumn(
        name, F.coalesce(F.col("__hit"), F.lit(False)) & (F.col("__place") == 1)
    ).drop("__us", "__key", "__place", "__hit")


def state_changes(df: DataFrame, alarm: Sequence[str], when: str, breached: Column) -> DataFrame:
    """Rows where an alarm goes off or recovers.  One row per alarm and period in."""
    order = Window.partitionBy(*alarm).orderBy(when)
    state = df.withColumn("state", F.when(breached, F.lit("ALARM")).otherwise(F.lit("OK")))
    before = F.coalesce(F.lag("state").over(order), F.lit("OK"))
    return state.withColumn("previous", before).where(F.col("state") != F.col("previous"))
