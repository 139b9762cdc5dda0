"""Stateful streams beside their batch forms: several triggers, late rows, restarts."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta, timezone

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from palisade.operators import alerts as L
from palisade.operators import models as M
from palisade.streaming import jobs as J

START = datetime(2024, 5, 1, tzinfo=timezone.utc)
SCHEMA = "id long, key long, ts timestamp, value double"


def arrive(spark, path, files):
    """One file for each list of rows, in this order."""
    for rows in files:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture(scope="module")
def files():
    """Rows of three series over a day; some come up to 50 minutes late, in the next file."""
    rng = random.Random(11)
    rows = [
        (i, rng.choice([1, 1, 1, 2, None]), START + timedelta(seconds=rng.randrange(86_400), microseconds=rng.randrange(10**6)), rng.gauss(0, 1) + 9 * (i % 37 == 0))
        for i in range(600)
    ]
    parts = [[] for _ in range(6)]
    for r in sorted(rows, key=lambda r: r[2]):
        arrival = (r[2] - START).total_seconds() + (3000 if r[0] % 4 == 0 else 0)
        parts[min(int(arrival // 14_400), 5)].append(r)
    for part in parts:
        rng.shuffle(part)
    beat = (None, None, START + timedelta(hours=30), None)
    return rows, [*parts, [beat]]


def streamed(spark, tmp_path, files, job, once):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = spark.createDataFrame([], SCHEMA).schema
    if once:
        arrive(spark, source, files)
        return J.run_available(job(J.read_stream(spark, source, schema, "ts", 1)), "t", target=out, checkpoint=checkpoint)
    for part in files:
        arrive(spark, source, [part])
        result = J.run_available(job(J.read_stream(spark, source, schema, "ts")), "t", target=out, checkpoint=checkpoint)
    return result


BEAT = "id IS NULL"


@pytest.mark.parametrize("once", [True, False])
def test_cooldown_stream_equals_batch(spark, tmp_path, files, once):
    rows, parts = files
    job = lambda s: J.cooldown(s, "key", "ts", 1800, beats=F.expr(BEAT))
    got = sorted((r.key if r.key is not None else -1, r.fired_at) for r in streamed(spark, tmp_path, parts, job, once).collect())
    batch = L.cooldown(spark.createDataFrame(rows, SCHEMA), "key", "ts", 1800, ["id"]).where("fired")
    assert got == sorted((r.key if r.key is not None else -1, r.ts) for r in batch.collect())
    assert len(got) > 60


@pytest.mark.parametrize("once", [True, False])
def test_drift_stream_equals_a_plain_window(spark, tmp_path, files, once):
    rows, parts = files
    job = lambda s: J.rolling_drift(s, "key", "id", "value", 25, 2.5, beats=F.expr(BEAT))
    got = {r.id: r.z_score for r in streamed(spark, tmp_path, parts, job, once).collect()}
    want = {}
    for key in (1, 2, None):
        series = sorted((r for r in rows if r[1] == key), key=lambda r: (r[2], r[0]))
        for i, r in enumerate(series):
            window = np.array([x[3] for x in series[max(0, i - 24) : i + 1]])
            z = (r[3] - window.mean()) / window.std() if window.std() > 1e-9 else 0.0
            if abs(z) > 2.5:
                want[r[0]] = z
    assert got.keys() == want.keys() and len(got) > 5
    assert np.allclose([got[k] for k in want], list(want.values()))


def test_rows_behind_the_watermark_do_not_fire(spark, tmp_path):
    at = lambda h: START + timedelta(hours=h)
    parts = [[(1, 1, at(5), 0.0)], [(2, 1, at(9), 0.0)], [(3, 1, at(1), 0.0)], [(None, None, at(30), None)]]
    job = lambda s: J.cooldown(s, "key", "ts", 600, beats=F.expr(BEAT))
    got = sorted(r.fired_at.hour for r in streamed(spark, tmp_path, parts, job, False).collect())
    assert got == [5, 9]


@pytest.mark.parametrize("limit", [1, 50_000])
def test_blocks_of_a_hot_key_fire_the_same(spark, monkeypatch, limit):
    rng = random.Random(3)
    rows = [(i, rng.choice([1, 1, 2]), START + timedelta(seconds=rng.randrange(40_000)), 0.0) for i in range(1500)]
    monkeypatch.setattr(L, "BLOCK_ALERTS", limit)
    got = {r.id for r in L.cooldown(spark.createDataFrame(rows, SCHEMA), "key", "ts", 500, ["id"]).where("fired").collect()}
    want = set()
    for key in (1, 2):
        last = None
        for i, _, ts, _ in sorted((r for r in rows if r[1] == key), key=lambda r: (r[2], r[0])):
            if last is None or ts - last >= timedelta(seconds=500):
                last = ts
                want.add(i)
    assert got == want


def test_trigger_sink_counts_a_batch_once(spark, tmp_path):
    model = M.Reconstruction(np.zeros(2), np.array([[1.0], [0.0]]), np.array([[1.0, 0.0]]))
    names = spark.createDataFrame([("Bot", 0)], "label string, label_id int")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in ([(1, [1.0, 0.1]), (2, [4.0, 8.0]), (3, [5.0, 9.0])], [(4, [1.0, 0.0])], [(6, [7.0, 7.0]), (5, [2.0, 6.0])]):
        spark.createDataFrame(part, "k long, v array<double>").coalesce(1).write.mode("append").parquet(source)
    schema = spark.read.parquet(source).schema

    def run(checkpoint):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        found = M.detect_vectors(stream, "v", model, 1.0, M.best_score, names, "k")
        J.trigger_sink(found, "k", out, str(tmp_path / checkpoint)).awaitTermination()
        return sorted((r.batch, json.loads(r.value)["confidence"]) for r in spark.read.text(out).collect())

    assert run("a") == [(0, 4.0), (2, 2.0)]
    # A second run from the start writes the same batches again.
    assert run("b") == [(0, 4.0), (2, 2.0)]


class Handle:
    """State of one bucket in memory; ``calls`` counts its accesses."""

    def __init__(self):
        self.calls, self.timers = 0, set()

    def getValueState(self, name, schema):
        return State(self)

    def getListState(self, name, schema):
        return States(self)

    def registerTimer(self, ms):
        self.calls += 1
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.calls += 1
        self.timers.discard(ms)


class State:
    def __init__(self, handle):
        self.handle, self.rows = handle, []

    def _called(self):
        self.handle.calls += 1

    def exists(self):
        self._called()
        return bool(self.rows)

    def get(self):
        self._called()
        return self.rows[0]

    def update(self, row):
        self._called()
        self.rows = [row]

    def appendValue(self, row):
        self._called()
        self.rows.append(row)

    def clear(self):
        self._called()
        self.rows = []


class States(State):
    def get(self):
        self._called()
        return iter(self.rows)


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def in_batches(processor, batches, watermarks):
    """Rows of a processor over (bucket rows, watermark after them), and its state calls."""
    handle, out, before = Handle(), [], -1
    processor.init(handle)
    for rows, ms in zip(batches, watermarks, strict=True):
        out += list(processor.handleInputRows((0,), iter([rows]), Clock(before)))
        for timer in sorted(t for t in handle.timers if t <= ms):
            out += list(processor.handleExpiredTimer((0,), Clock(ms), None))
            handle.timers.discard(timer)
        before = ms
    return pd.concat(out), handle


@pytest.fixture
def bucket():
    """300 series (one is null) with unordered rows in two batches, half an hour late at most."""
    rng = np.random.default_rng(5)
    n = 12_000
    names = np.array([None, *[str(i) for i in range(299)]], dtype=object)
    rows = pd.DataFrame({
        "series": names[rng.integers(0, 300, n)], "moment_us": rng.integers(0, 86_400, n) * 1_000_000, "row_order": np.arange(n),
        "row_value": rng.normal(0, 1, n) + 9 * (np.arange(n) % 41 == 0), "beat": False,
    })
    late = rows["moment_us"] + rng.choice([0, 1_700_000_000], n) < 43_200_000_000
    return rows, [rows[late], rows[~late]], [41_400_000, 100_000_000]


def test_a_bucket_of_many_keys_costs_the_calls_of_one(bucket):
    rows, batches, watermarks = bucket
    got, handle = in_batches(J.CooldownProcessor("series", 3_600_000_000), batches, watermarks)
    want = []
    for name, group in rows.groupby("series", dropna=False):
        ready = -1
        for us in sorted(group["moment_us"]):
            if us >= ready:
                want.append((name if isinstance(name, str) else "", us))
                ready = us + 3_600_000_000
    assert sorted(zip(got["series"].fillna(""), got["moment_us"], strict=True)) == sorted(want)
    assert handle.calls < 60


def test_drift_of_a_bucket_of_many_series_costs_the_calls_of_one(bucket):
    rows, batches, watermarks = bucket
    got, handle = in_batches(J.RollingDriftProcessor("series", 20, 2.5), batches, watermarks)
    want = {}
    for _, group in rows.groupby("series", dropna=False):
        group = group.sort_values(["moment_us", "row_order"])
        frame = group["row_value"].rolling(20, min_periods=1)
        z = (group["row_value"] - frame.mean()) / frame.std(ddof=0)
        want.update({o: x for o, x in zip(group["row_order"], z, strict=True) if abs(x) > 2.5})
    assert len(got) == len(want) > 100
    assert np.allclose(got["z_score"], [want[o] for o in got["row_order"]])
    assert handle.calls < 60


def test_values_that_are_no_numbers_are_not_in_the_window():
    values = [1.0, 2.0, float("inf"), float("nan"), float("inf"), 1.5, 30.0, 30.0, 30.0]
    rows = pd.DataFrame({"series": "a", "moment_us": range(9), "row_order": range(9), "row_value": values, "beat": False})
    got, _ = in_batches(J.RollingDriftProcessor("series", 3, 0.5), [rows], [10])
    series = pd.Series(values)
    std = series.rolling(3, min_periods=1).std(ddof=0)
    z = ((series - series.rolling(3, min_periods=1).mean()) / std)[std > 1e-9]
    z = z[z.abs() > 0.5]
    assert got["row_order"].tolist() == z.index.tolist() and 2 in z.index
    assert np.allclose(got["z_score"], z)
