"""Order-dependent operators against plain windows, with a key that holds most rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from palisade.operators import alerts as L
from palisade.operators import classes
from palisade.operators import drift as D
from palisade.operators.ordered import positions, prefix_sums, rolling
from palisade.operators.profile import box_statistics, feature_summary
from palisade.operators.quantiles import quantiles


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    n = 4000
    frame = pd.DataFrame(
        {
            "id": np.arange(n),
            "key": np.where(rng.random(n) < 0.7, "hot", rng.choice(["a", "b", "c"], n)),
            "t": rng.permutation(n),
            "x": np.round(rng.normal(0, 50, n), 1) * rng.choice([0, 1, 1e-6, 1e6], n),
        }
    )
    return spark.createDataFrame(frame).repartition(7).cache()


def slot():
    return F.floor(F.col("t") / 37)


def test_positions_equal_row_number(skewed):
    plain = F.row_number().over(Window.partitionBy("key").orderBy("t"))
    got = positions(skewed, [F.col("t")], slot(), ["key"], "p", "size").withColumn("q", plain)
    assert got.where("p <> q").count() == 0
    sizes = {r["key"]: r["n"] for r in skewed.groupBy("key").agg(F.count("*").alias("n")).collect()}
    assert all(sizes[r["key"]] == r["size"] for r in got.select("key", "size").distinct().collect())


def test_prefix_sums_without_group(skewed):
    plain = F.sum("id").over(Window.orderBy("t").rowsBetween(Window.unboundedPreceding, 0))
    got = prefix_sums(skewed, {"s": F.col("id")}, [F.col("t")], slot()).withColumn("q", plain)
    assert got.where("s <> q").count() == 0


@pytest.mark.parametrize("block", [10, 64, 100_000])
def test_rolling_equals_window(skewed, block):
    frame = Window.partitionBy("key").orderBy("t").rowsBetween(-9, 0)
    got = rolling(skewed, {"m": F.sum("id"), "n": F.count("id")}, [F.col("t")], slot(), 10, ["key"], block)
    both = got.withColumns({"m2": F.sum("id").over(frame), "n2": F.count("id").over(frame)})
    assert both.count() == 4000 and both.where("m <> m2 OR n <> n2").count() == 0


def test_quantile_routes_agree(skewed):
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    for group in ([], ["key"]):
        a = sorted(quantiles(skewed, "x", probs, group, "q", "buffered").collect())
        b = sorted(quantiles(skewed, "x", probs, group, "q", "ranks").collect())
        assert len(a) == len(b)
        for x, y in zip(a, b):
            assert np.allclose(x["q"], y["q"], rtol=1e-12, atol=1e-12)


def test_quantiles_of_missing_values(spark):
    df = spark.createDataFrame(
        [("a", None), ("a", float("nan")), ("b", 1.0), ("b", float("inf")), ("b", 3.0), (None, 4.0)],
        "g string, x double",
    )
    for method in ("buffered", "ranks"):
        got = {r["g"]: r["q"] for r in quantiles(df, "x", [0.5], ["g"], "q", method).collect()}
        assert got["b"] == [2.0] and got[None] == [4.0]
        assert got["a"] is None or got["a"] == [None]


def test_summary_does_not_depend_on_partitioning(skewed):
    def rows(df):
        return [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in feature_summary(df, ["x"], ["key"]).orderBy("key").collect()]

    assert rows(skewed.coalesce(1)) == rows(skewed.repartition(13, "t"))
    assert box_statistics(skewed, ["x"], "key").count() == 4


def brute_force(frame: pd.DataFrame, seconds: float) -> set[int]:
    fired, last = set(), {}
    for row in frame.sort_values(["us", "id"]).itertuples():
        if row.key not in last or row.us - last[row.key] >= seconds * 1_000_000:
            last[row.key] = row.us
            fired.add(row.id)
    return fired


@pytest.mark.parametrize("seconds,block", [(5, 5), (5, 11), (60, 600), (3, None), (700, 700)])
def test_cooldown_against_brute_force(spark, seconds, block):
    rng = np.random.default_rng(int(seconds))
    n = 1500
    frame = pd.DataFrame(
        {
            "id": np.arange(n),
            "key": np.where(rng.random(n) < 0.8, 1, rng.integers(2, 6, n)),
            "us": rng.integers(0, 4000, n) * 1_000_000 + 1_700_000_000_000_000,
        }
    )
    df = spark.createDataFrame(frame).withColumn("when", F.timestamp_micros("us"))
    got = L.cooldown(df, "key", "when", seconds, ["id"], block)
    assert got.count() == n
    assert {r["id"] for r in got.where("fired").select("id").collect()} == brute_force(frame, seconds)


def test_cooldown_restarts_exactly_at_its_end(spark):
    times = [0, 10, 19, 20, 39, 40]
    df = spark.createDataFrame([(1, t) for t in times], "key int, s long").withColumn("when", F.timestamp_seconds("s"))
    got = L.cooldown(df, "key", "when", 20).where("fired").orderBy("s").collect()
    assert [r["s"] for r in got] == [0, 20, 40]


def test_drift_report_lists_at_most_fifty_events(spark):
    values = [0.0 if i % 3 else float(i) for i in range(600)]
    df = spark.createDataFrame(list(enumerate(values)), "seq long, v double")
    stats = D.rolling_stats(df, "v", [F.col("seq")], F.floor(F.col("seq") / 100), 3)
    report = D.drift_report(stats, "v", 3, 1.0).first()
    assert report["samples"] == 600 and len(report["drift_events"]) == 50
    assert report["drift_event_count"] > 50
    indexes = [e["index"] for e in report["drift_events"]]
    assert indexes == sorted(indexes)


def test_truncated_rank_of_odd_scores(spark):
    scores = [3.0, 1.0, 3.0, None, -2.5, 0.0, float("nan"), float("inf"), float("-inf"), 3.0, None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(scores)], "i int, score double")
    got = {r.i: r["rank"] for r in classes.truncated_rank(df, "score").collect()}
    assert got == {6: 1, 7: 2, 0: 4, 2: 4, 9: 4, 1: 6, 5: 7, 4: 8, 8: 9, 3: 10, 10: 10}
    assert classes.truncated_rank(df.where("i < 0"), "score").count() == 0
