"""Plans that read once, incremental days, the merge of all logs, exact places of quantiles."""

from __future__ import annotations

import random
import re
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from palisade.catalog import behaviour as catalog
from palisade.catalog import detection
from palisade.catalog import inputs as I
from palisade.catalog.registry import Tables, plain
from palisade.operators import models as M
from palisade.operators import profile as P
from palisade.operators import quantiles as Q
from palisade.operators import userday as U
from palisade.plans import behaviour
from palisade.sources import logs as G

DIRECTORY = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "5000")
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def rows_of(df):
    return sorted(map(repr, map(tuple, df.select(*sorted(df.columns)).collect())))


# ---- merge of all logs --------------------------------------------------------


@pytest.mark.parametrize("exact", [True, False])
def test_merge_of_logs_equals_joined_tables(spark, exact):
    silver = catalog.sparse_silver(Tables(spark, DIRECTORY))
    first, *rest = behaviour.gold_tables(silver, exact).values()
    joined = U.merge_gold(first, rest)
    merged = U.merged_features(silver, exact)
    assert merged.columns == joined.columns
    assert rows_of(plain(merged)) == rows_of(plain(joined))


def test_merge_of_logs_meets_once(spark):
    table = behaviour.labelled_from_silver(catalog.silver_tables(t := Tables(spark, DIRECTORY)), I.periods(t), exact=True)
    assert plan_of(table).count("Exchange hashpartitioning") <= 7


def test_users_of_one_log_have_no_row_without_logon(spark):
    silver = catalog.silver_tables(Tables(spark, DIRECTORY))
    few = dict(silver, logon=silver["logon"].where("user < 'u3'"))
    users = {r.user for r in U.merged_features(few).select("user").distinct().collect()}
    assert users and max(users) < "u3"


# ---- incremental days ---------------------------------------------------------


def test_stale_days_are_a_partition_filter(spark, tmp_path):
    rows = spark.range(40).select((F.col("id") % 4).alias("k"), F.date_add(F.lit("2024-03-01").cast("date"), (F.col("id") % 5).cast("int")).alias("date"))
    rows.write.partitionBy("date").parquet(str(tmp_path / "days"))
    some = behaviour.rows_of_days(spark.read.parquet(str(tmp_path / "days")), ["2024-03-02", "2024-03-04"])
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan_of(some)).group(1)
    assert "2024-03-02" in filters and "2024-03-04" in filters and "2024-03-01" not in filters
    assert some.count() == 16
    scan = some.select("date").distinct()
    assert {str(r.date) for r in scan.collect()} == {"2024-03-02", "2024-03-04"}


def http_rows(spark, entries):
    schema = "user string, date date, url string, domain string, url_length int, suspicious_url_flag int, after_hours_flag int, weekend_flag int"
    made = [(u, pd.Timestamp(d).date() if d else None, f"http://{x}", str(x), 8, 0, 0, 0) for u, d, x in entries]
    return spark.createDataFrame(made, schema)


def test_refresh_redoes_new_late_asked_and_broken_days(spark, tmp_path):
    layer, cache = str(tmp_path / "silver"), str(tmp_path / "cache")
    write = lambda e, mode: http_rows(spark, e).coalesce(1).write.mode(mode).partitionBy("date").parquet(f"{layer}/http")
    write([("a", "2024-01-01", 1), ("a", "2024-01-02", 2), ("b", None, 3)], "overwrite")
    stale = lambda redo=(): sorted(r.date for r in behaviour.stale_days(spark, f"{layer}/http", cache, redo).collect())
    counts = lambda df: {(r.user, str(r.date)): r.http_request_count for r in df.collect()}
    assert stale() == ["2024-01-01", "2024-01-02", behaviour.NO_DATE]
    assert counts(behaviour.refresh_http_days(spark, layer, cache)) == {("a", "2024-01-01"): 1, ("a", "2024-01-02"): 1, ("b", "None"): 1}
    assert stale() == [] and stale(["2024-01-02"]) == ["2024-01-02"]
    # A late row of a stored day, a new day, and a day whose run broke before its entry.
    write([("a", "2024-01-02", 5), ("c", "2024-01-03", 6), ("c", "2024-01-04", 7)], "append")
    U.daily_http(http_rows(spark, [("x", "2024-01-04", 1)])).write.mode("append").partitionBy("date").parquet(cache)
    assert stale() == ["2024-01-02", "2024-01-03", "2024-01-04"]
    got = counts(behaviour.refresh_http_days(spark, layer, cache))
    assert got == {("a", "2024-01-01"): 1, ("a", "2024-01-02"): 2, ("c", "2024-01-03"): 1, ("c", "2024-01-04"): 1, ("b", "None"): 1}
    assert stale() == []


def test_one_day_is_pruned_by_folders(spark, tmp_path):
    df = spark.createDataFrame([(i, datetime(2024, 1 + i % 2, 1 + i % 3)) for i in range(12)], "id long, timestamp timestamp")
    dated, names = G.with_partition_columns(df, "timestamp", "day")
    G.write_layer(dated, str(tmp_path / "t"), names)
    day = G.read_day(spark, str(tmp_path / "t"), 2024, 1, 1)
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan_of(day)).group(1)
    assert "(year" in filters and "(month" in filters and "(day" in filters
    assert sorted(r.id for r in day.collect()) == [0, 6]


# ---- detector -----------------------------------------------------------------


def test_detector_scans_and_evaluates_once(spark):
    plan = plan_of(detection.detections(Tables(spark, DIRECTORY)))
    assert plan.count("ArrowEvalPython") == 1 and plan.count("Scan parquet") == 1 and "Union" not in plan


def test_classifier_sees_anomalous_codes_only(spark):
    model = M.Reconstruction(np.zeros(2), np.array([[1.0], [0.0]]), np.array([[1.0, 0.0]]))

    def classify(codes):
        assert (codes > 5).all()
        return codes.argmax(axis=1), codes.max(axis=1)

    rows = [(1, [9.0, 3.0]), (2, [1.0, 0.5]), (3, None), (4, [8.0, 2.0]), (5, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "k long, v array<double>")
    names = spark.createDataFrame([("Bot", 0)], "label string, label_id int")
    got = {r.k: r for r in M.detect_vectors(df, "v", model, 1.0, classify, names, "k").collect()}
    assert [got[k].is_anomalous for k in range(1, 6)] == [True, False, False, True, False]
    assert got[1].action == "ATTACK: Bot" and got[4].confidence == 8.0 and got[1].mse_error == 4.5
    assert got[3].mse_error is None and got[2].predicted_label is None and got[5].action == "BENIGN - Passed"


def test_flat_forest_equals_the_fitted_one(spark):
    rng = np.random.default_rng(5)
    rows = [(i, f"c{i % 3}", (rng.normal(size=4) + 2 * np.eye(4)[i % 3]).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, label string, v array<double>")
    model = M.fit_classifier(df, "v", trees=7, depth=5)
    want = model.classify(df).orderBy("id").select("predicted_id", "confidence").collect()
    ids, sure = M.flat_forest(spark, model.model).classify(np.array([r[2] for r in rows]))
    assert ids.tolist() == [r.predicted_id for r in want]
    assert np.allclose(sure, [r.confidence for r in want], atol=1e-12)


# ---- quantiles ----------------------------------------------------------------


def test_tied_values_are_their_own_quantiles(spark):
    rng = random.Random(2)
    rows = []
    for group in range(30):
        values = [rng.choice([0.1, 0.3, 7.7, 1e-9, 123.456]) for _ in range(3)]
        rows += [(group, v) for v in values for _ in range(rng.randrange(1, 400))]
    rows += [(99, None), (98, float("nan")), (98, float("inf"))]
    df = spark.createDataFrame(rows, "g int, v double")
    probabilities = [0.01, 0.1, 0.25, 0.5, 0.8, 0.99]
    ranks = {r.g: r.quantiles for r in Q.quantiles(df, "v", probabilities, ["g"]).collect()}
    frame = pd.DataFrame(rows, columns=["g", "v"])
    assert ranks[99] is None and ranks[98] is None
    for group in range(30):
        values = np.sort(frame.v[frame.g == group].to_numpy())
        for p, got in zip(probabilities, ranks[group], strict=True):
            at = (len(values) - 1) * p
            low, high = values[int(np.floor(at))], values[int(np.ceil(at))]
            if low == high:
                assert got == low
            else:
                assert low < got < high
    buffered = {r.g: r.quantiles for r in Q.quantiles(df, "v", probabilities, ["g"], method="buffered").collect()}
    assert all(np.allclose(ranks[g], buffered[g], rtol=1e-12) for g in range(30))


def test_several_groupings_in_one_search(spark):
    rng = np.random.default_rng(3)
    rows = [(f"a{i % 3}", f"b{i % 4}", float(v)) for i, v in enumerate(rng.normal(size=999))] + [(None, "b0", 2.5), ("a0", None, None)]
    df = spark.createDataFrame(rows, "a string, b string, v double")
    found = Q.order_statistics(df, "v", [(["a", "b"], [0.5]), (["b"], [0.1, 0.9]), (["a", "b"], [0.2])]).collect()
    frame = pd.DataFrame(rows, columns=["a", "b", "v"])
    value = lambda p: p["low"] + (p["high"] - p["low"]) * p["weight"]
    for r in found:
        keep = (frame.b == r.b) if r.b else frame.b.isna()
        if r.set != 1:
            keep &= (frame.a == r.a) if r.a else frame.a.isna()
        values = frame.v[keep].dropna()
        if values.empty:
            assert r.places is None
            continue
        asked = [[0.5], [0.1, 0.9], [0.2]][r.set]
        assert np.allclose([value(p) for p in r.places[: len(asked)]], np.quantile(values, asked))
    assert len(found) == 14 + 5 + 14


def test_quantiles_of_nothing(spark):
    none = spark.createDataFrame([], "g int, v double")
    assert Q.quantiles(none, "v", [0.5]).collect()[0][0] is None
    assert Q.quantiles(none, "v", [0.5], ["g"]).count() == 0
    row = P.error_summary(none, "v").first()
    assert row.n == 0 and row.p95 is None


def test_class_medians_search_once(spark):
    from palisade.operators import classes as C

    df = I.flows(Tables(spark, DIRECTORY))
    # The first two scans are jobs of their own; the plan that is left holds the third.
    assert plan_of(C.class_medians(df, I.FEATURES)).count("Scan parquet") == 1


# ---- slots, folds, files, samples ---------------------------------------------


def test_depth_slots_follow_the_values(spark):
    from palisade.operators.ordered import depth_slots

    rng = np.random.default_rng(9)
    values = np.unique(np.concatenate([rng.uniform(1.0, 1.05, 4000), -rng.uniform(1.0, 1.05, 3000), rng.lognormal(0, 5, 500), [0.0]]))
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = depth_slots(df, "v", rows=200, name="slot").orderBy("v").collect()
    slots = [r.slot for r in got]
    assert len(got) == len(values) and slots == sorted(slots)
    sizes = pd.Series(slots).value_counts()
    # 7,000 of the values lie in a twentieth of an octave on either side.
    assert sizes.max() <= 500 and len(sizes) < 200


def test_sweep_is_the_same_in_small_slots(spark):
    from palisade.operators import evaluation as E

    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(float(v), bool(v > 0.9)) for v in rng.uniform(0.5, 1.0, 900).round(4)], "s double, p boolean")
    some, one = (E.sweep(df, "s", F.col("p"), n).orderBy("threshold").collect() for n in (20, 10**6))
    assert some == one


def test_centroids_are_fitted_without_the_fold(spark):
    from palisade.operators import evaluation as E

    rng = np.random.default_rng(2)
    rows = [(i, i % 3, f"c{i % 4}", (rng.normal(size=3) + (i % 4) * (i % 2)).tolist()) for i in range(240)]
    df = spark.createDataFrame(rows, "id long, fold int, label string, v array<double>")
    got = {r.fold: (r.rows, r.accuracy) for r in E.centroid_validation(df, "v", "label", "fold", 3).collect()}
    for fold in range(3):
        centres = {c: np.mean([r[3] for r in rows if r[2] == c and r[1] != fold], axis=0) for c in ("c0", "c1", "c2", "c3")}
        test = [r for r in rows if r[1] == fold]
        hits = sum(min(centres, key=lambda c: ((centres[c] - np.array(r[3])) ** 2).sum()) == r[2] for r in test)
        assert got[fold][0] == len(test) and np.isclose(got[fold][1], hits / len(test))


def test_catalog_of_files_has_sizes_and_totals(spark, tmp_path):
    from palisade.sources import inventory as V

    for name, labels in (("a", ["x", "x", None]), ("b", ["y"])):
        spark.createDataFrame([(v, 1) for v in labels], "Label string, n int").coalesce(1).write.parquet(str(tmp_path / name))
    files = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path))
    rows = V.file_catalog(files).collect()
    sizes = [f.stat().st_size for f in tmp_path.rglob("*.parquet")]
    total = next(r for r in rows if r.file is None)
    assert len(rows) == 3 and (total.files, total.rows, total.bytes) == (2, 4, sum(sizes))
    assert sorted(r.bytes for r in rows if r.file) == sorted(sizes)
    assert sorted(r.classes for r in rows if r.file) == [["UNKNOWN", "x"], ["y"]] and total.classes == ["UNKNOWN", "x", "y"]
    assert V.file_catalog(files.where("n > 5")).count() == 0


def test_samples_do_not_depend_on_partitions(spark):
    from palisade.operators import prep

    df = spark.range(500).withColumnRenamed("id", "k")
    one = prep.repeatable_sample(df.repartition(7), 20, ["k"]).collect()
    assert sorted(one) == sorted(prep.repeatable_sample(df.coalesce(1), 20, ["k"]).collect()) and len(one) == 20


def test_scratch_is_shared_or_local():
    from palisade import session

    class Conf:
        def __init__(self, **values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key.replace(".", "_"), default)

    class Spark:
        def __init__(self, **values):
            self.conf = Conf(**values)

    assert session.scratch_path(Spark(spark_master="local[3]"), "x").startswith(session._own_scratch)
    assert session.scratch_path(Spark(spark_master="yarn", spark_checkpoint_dir="hdfs:///c"), "x").startswith("hdfs:///c/x-")
    for master in ("yarn", "local-cluster[2,1,900]"):
        with pytest.raises(RuntimeError):
            session.scratch_path(Spark(spark_master=master), "x")
