"""Splits, scalers, reconstruction, detector and the stored layers."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from palisade.operators import models as M
from palisade.operators import prep
from palisade.operators import userday as U
from palisade.plans import behaviour, network
from palisade.sources import flows as S
from palisade.sources import logs as G


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    rows = [
        (i, "BENIGN" if i % 3 else "DoS", float(rng.normal()), float("inf") if i % 50 == 0 else float(rng.random()))
        for i in range(1000)
    ]
    return spark.createDataFrame(rows, "id long, label string, a double, b double")


def test_split_sizes_are_exact_and_repeatable(table):
    def assigned(df):
        return {r["id"]: r["split"] for r in prep.split(df, network.SPLIT, ["id"], ["label"]).collect()}

    first, again = assigned(table), assigned(table.repartition(11))
    assert first == again and len(first) == 1000
    counts = prep.split(table, network.SPLIT, ["id"], ["label"]).groupBy("label", "split").count().collect()
    for row in counts:
        size = 666 if row["label"] == "BENIGN" else 334
        assert abs(row["count"] - size * network.SPLIT[row["split"]]) <= 1


def test_split_ratios_must_sum_to_one(table):
    with pytest.raises(ValueError):
        prep.split(table, {"a": 0.5, "b": 0.4}, ["id"])


def test_small_groups_stay_whole(table):
    kept = prep.stratified_sample(table, 0.001, ["id"], ["label"])
    assert kept.count() == 1000
    assert prep.stratified_sample(table, 0.1, ["id"], ["label"]).count() == 67 + 33


def test_prepared_rows_lie_in_unit_range(spark, table, tmp_path):
    ready = network.prepare(table, ["a", "b"], ["id"], fit_on="all")
    ends = ready.rows.agg(F.min("a"), F.max("a"), F.min("b"), F.max("b"), F.count("*")).first()
    assert np.allclose(ends[:4], [0, 1, 0, 1]) and ends[4] == 980
    network.store(spark, ready, str(tmp_path / "flows"))
    assert prep.Scaler.load(spark, str(tmp_path / "flows/scaler")) == ready.scaler
    assert spark.read.parquet(str(tmp_path / "flows/rows")).count() == 980


def test_unknown_class_id_has_a_name(spark, table):
    mapping = prep.label_map(table)
    ids = spark.createDataFrame([(0,), (1,), (7,)], "i int")
    assert [r["predicted_label"] for r in prep.decode_labels(ids, mapping, "i").orderBy("i").collect()] == ["BENIGN", "DoS", "Class_7"]


def test_reconstruction_matches_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12))
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id long, v array<double>")
    model = M.fit_reconstruction(df, "v", 4)
    got = np.array([r["mse_error"] for r in model.score(df, "v").orderBy("id").collect()])
    centred = x - x.mean(axis=0)
    _, _, vt = np.linalg.svd(centred, full_matrices=False)
    want = ((centred - centred @ vt[:4].T @ vt[:4]) ** 2).mean(axis=1)
    assert np.allclose(got, want, rtol=1e-6, atol=1e-9)


def test_detector_classifies_only_anomalies(spark):
    df = spark.createDataFrame([(1, 0.1, [0.2, 0.8]), (2, 0.5, [0.9, 0.1]), (3, None, [0.5, 0.4])], "k int, mse_error double, s array<double>")
    names = spark.createDataFrame([("Bot", 0), ("XSS", 1)], "label string, label_id int")
    seen = M.detect(df, 0.5, lambda d: M.classify_scores(d, "s", names), "k").orderBy("k").collect()
    assert [r["action"] for r in seen] == ["BENIGN - Passed", "ATTACK: Bot", "BENIGN - Passed"]
    assert seen[0]["predicted_label"] is None and seen[1]["confidence"] == 0.9


def test_fitted_classifier_learns(spark):
    rng = np.random.default_rng(5)
    rows = [(i, f"c{i % 3}", (rng.normal(size=4) + 4 * np.eye(4)[i % 3]).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, label string, v array<double>")
    model = M.fit_classifier(df, "v", trees=5, depth=4)
    hits = model.classify(df).agg(F.avg((F.col("label") == F.col("predicted_label")).cast("int"))).first()[0]
    assert hits > 0.9


def test_missing_partition_column_and_unknown_granularity(table):
    with pytest.raises(KeyError):
        G.with_partition_columns(table, "timestamp")
    dated = table.withColumn("timestamp", F.current_timestamp())
    df, names = G.with_partition_columns(dated, "timestamp", "week")
    assert names == [] and df.columns == dated.columns


def test_no_day_file_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        S.read_days(spark, {"Monday": str(tmp_path / "absent.csv")})


def test_files_with_other_column_orders_are_read_by_name(spark, tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    (folder / "a.csv").write_text("user,pc,date\nu1,PC-1,d1\n")
    (folder / "b.csv").write_text("pc,user,date\nPC-2,u2,d2\n")
    rows = G.read_csv(spark, str(folder / "*.csv"), G.LOG_SCHEMAS["logon"]).orderBy("date").collect()
    assert [(r.user, r.pc) for r in rows] == [("u1", "PC-1"), ("u2", "PC-2")]
    (folder / "c.txt").write_text("")
    flows = tmp_path / "flows"
    flows.mkdir()
    (flows / "a.csv").write_text("x, y,Label\n1,2,A \n")
    (flows / "b.csv").write_text("y,x,Label\n4,3, B\n")
    got = S.read_flow_csv(spark, str(flows / "*.csv")).orderBy("x").collect()
    assert [(r.x, r.y, r.Label) for r in got] == [(1.0, 2.0, "A"), (3.0, 4.0, "B")]


LOGS = {
    "logon": "id,date,user,pc\n1,01/05/2010 07:30:00,ABC1,PC-1\n2,1/5/2010 9:00,abc1,PC-2\n3,01/06/2010 10:00:00,ABC1,PC-1\n",
    "device": "date,user,activity\n01/05/2010 08:00:00,ABC1,Connect\n01/05/2010 09:00:00,ABC1,Connect\n01/05/2010 10:00:00,ABC1,Disconnect\n",
    "http": "date,user,url\n01/05/2010 08:00:00,ABC1,http://a.com/login\n01/06/2010 22:00:00,ABC1,http://b.com/x\n",
    "email": "date,user,to,cc,bcc,activity,attachments\n01/05/2010 18:00:00,ABC1,a@dtaa.com;b@x.org,,,Send,f1;f2\n",
    "file": 'date,user,pc,filename,activity,to_removable_media,from_removable_media,content\n01/05/2010 12:00:00,ABC1,PC-1,f.doc,Copy,True,False,"one two, three"\n',
    "decoy_file": "decoy_filename,pc\nf.doc,PC-1\nf.doc,PC-1\n",
    "insiders": "dataset,user,start,end\n6.2,ABC1,01/06/2010 00:00:00,01/07/2010 00:00:00\n5.2,ABC1,01/01/2010 00:00:00,01/05/2010 00:00:00\n",
}


def test_activity_layers_end_to_end(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for name, text in LOGS.items():
        (raw / f"{name}.csv").write_text(text)
    bronze, silver, gold = (str(tmp_path / layer) for layer in ("bronze", "silver", "gold"))
    behaviour.ingest(spark, str(raw), bronze)
    behaviour.build_silver(spark, bronze, silver)
    behaviour.build_gold(spark, silver, gold)
    behaviour.ingest(spark, str(raw), bronze)  # existing tables are left alone
    names = ("logon", "device", "email", "file", "http")
    tables = {n: spark.read.parquet(f"{gold}/{n}_features") for n in names}
    insiders = U.insider_periods(G.read_csv(spark, str(raw / "insiders.csv"), G.LOG_SCHEMAS["insiders"]))
    first, second = behaviour.labelled_days(tables, insiders).orderBy("date").collect()
    assert (first["user"], first["logon_count"], first["unique_pc_count"], first["after_hours_logon_count"]) == ("abc1", 2, 2, 1)
    assert (first["usb_connect_count"], first["incomplete_session_flag"], first["decoy_access_count"]) == (2, 1, 1)
    assert (first["email_count"], first["external_email_ratio"], first["attachment_per_email"]) == (1, 1.0, 2.0)
    assert first["avg_keyword_count"] == 3.0 and first["suspicious_url_count"] == 1 and first["usb_copy_count"] == 1
    assert first["after_hours_email_count"] == 1 and second["after_hours_http_count"] == 1
    assert (second["email_count"], second["usb_connect_count"]) == (0, 0)
    assert [first["target"], second["target"]] == [0, 1]
    small = behaviour.labelled_from_disk(spark, gold, str(raw / "insiders.csv"))
    assert "target" in small.columns and "user" not in small.columns


@pytest.mark.parametrize(
    ("name", "size"),
    [("f20_forest_importance", (100, 12)), ("f21_combined_ranking", (100, 12)), ("f22_training_accuracy", (100, 12)), ("f13_attack_classifier", (50, 6))],
)
def test_queries_grow_whole_forests(spark, monkeypatch, name, size):
    import palisade.catalog  # noqa: F401
    from pyspark.ml.classification import RandomForestClassifier

    from palisade.catalog.registry import QUERIES

    class Asked(Exception):
        pass

    def fit(self, *_):
        raise Asked((self.getNumTrees(), self.getMaxDepth()))

    monkeypatch.setattr(RandomForestClassifier, "fit", fit)
    with pytest.raises(Asked) as asked:
        QUERIES[name](spark, "/root/testdata/sf0.001")
    assert asked.value.args[0] == size


def test_forest_rows_are_dealt_over_all_cores(spark, monkeypatch):
    """Rows of a single task are fitted by as many tasks as there are cores."""
    from pyspark.ml.classification import RandomForestClassifier

    from palisade.operators import ranking

    class Asked(Exception):
        pass

    def fit(self, rows):
        raise Asked([len(part) for part in rows.select("target").rdd.glom().collect()])

    monkeypatch.setattr(RandomForestClassifier, "fit", fit)
    rows = spark.range(0, 4000, numPartitions=1).selectExpr("id % 3 AS label", "CAST(id AS double) AS x", "CAST(id % 7 AS double) AS y")
    with pytest.raises(Asked) as asked:
        ranking.forest(rows, ["x", "y"])
    parts = asked.value.args[0]
    assert sum(parts) == 4000 and len(parts) == spark.sparkContext.defaultParallelism
    assert max(parts) <= 2 * 4000 / len(parts)


def small_forest(spark, monkeypatch, trees, cells):
    """A forest on 800 rows, and the number of trees and the seed of every fit Spark was asked for."""
    from pyspark.ml.wrapper import JavaEstimator

    from palisade.operators import ranking

    asked, fit = [], JavaEstimator._fit_java

    def recorded(self, rows):
        if self.hasParam("numTrees"):
            asked.append((self.getNumTrees(), self.getSeed(), self.getCheckpointInterval()))
        return fit(self, rows)

    monkeypatch.setattr(JavaEstimator, "_fit_java", recorded)
    monkeypatch.setattr(ranking, "FIT_CELLS", cells, raising=False)
    rows = spark.range(0, 800).selectExpr("IF(id % 10 + id * 37 % 13 < 10, 'a', 'b') AS label", "CAST(id % 10 AS double) AS x", "CAST(id * 37 % 13 AS double) AS y")
    model, prepared = ranking.forest(rows, ["x", "y"], trees=trees, depth=4)
    return model, prepared, asked


def test_few_trees_are_held_at_once(spark, monkeypatch):
    """f20: with 100 rows a core and 500 cells, five trees at once; nothing kept or checkpointed."""
    model, _, asked = small_forest(spark, monkeypatch, 12, 5 * -(-800 // spark.sparkContext.defaultParallelism))
    assert sum(n for n, _, _ in asked) == 12 and max(n for n, _, _ in asked) <= 5
    assert len({seed for _, seed, _ in asked}) == len(asked) and {every for _, _, every in asked} == {-1}
    assert model.getNumTrees == len(model.trees) == 12 and model.numClasses == 2
    assert len({tree.toDebugString.split("\n", 1)[1] for tree in model.trees}) > 1
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()
    assert [n for n, _, _ in small_forest(spark, monkeypatch, 12, 1_000_000)[2]][-1:] == [12]


def test_portions_share_their_importance(spark, monkeypatch):
    """f21: the importance is the trees' average, whatever portion they were grown in."""
    model, _, asked = small_forest(spark, monkeypatch, 9, 4 * -(-800 // spark.sparkContext.defaultParallelism))
    assert len(asked) == 3 and sum(n for n, _, _ in asked) == 9
    trees = np.array([tree.featureImportances.toArray() for tree in model.trees])
    assert np.allclose(model.featureImportances.toArray(), trees.sum(axis=0) / trees.sum(), atol=1e-12)


def test_portions_predict_together(spark, monkeypatch):
    """f22: a prediction comes from all trees; rows are dealt with what a fit reads, and all kept."""
    model, prepared, asked = small_forest(spark, monkeypatch, 9, 4 * -(-800 // spark.sparkContext.defaultParallelism))
    assert len(asked) == 3 and prepared.columns == ["features", "target", "weight"]
    tried = model.transform(prepared).select("features", "target", "prediction", "probability").collect()
    ids, sure = M.flat_forest(spark, model).classify(np.array([r.features.toArray() for r in tried]))
    assert len(tried) == 800 and ids.tolist() == [int(r.prediction) for r in tried]
    assert np.allclose(sure, [max(r.probability) for r in tried], atol=1e-12)
    assert np.mean([r.prediction == r.target for r in tried]) > 0.8


def test_folders_are_written_without_sorting(spark, tmp_path, monkeypatch):
    """A task keeps a file open for each value; the setting for it ends with the write."""
    from pyspark.sql import DataFrameWriter

    seen, parquet = [], DataFrameWriter.parquet

    def recorded(self, *args, **more):
        seen.append(spark.conf.get(G.WRITERS))
        return parquet(self, *args, **more)

    monkeypatch.setattr(DataFrameWriter, "parquet", recorded)
    before = spark.conf.get(G.WRITERS, None)
    rows = spark.range(0, 90, numPartitions=1).selectExpr("id", "id % 3 AS day")
    G.write_folders(rows.unionByName(spark.range(90, 95).selectExpr("id", "CAST(NULL AS bigint) AS day")).coalesce(1), str(tmp_path / "days"), "day")
    assert [int(n) for n in seen] == [G.OPEN_FILES] and spark.conf.get(G.WRITERS, None) == before
    back = spark.read.parquet(str(tmp_path / "days"))
    assert {r.day: r["count"] for r in back.groupBy("day").count().collect()} == {0: 30, 1: 30, 2: 30, None: 5}
    assert len(list((tmp_path / "days").glob("day=*/*.parquet"))) == 4


def test_exact_days_are_counted_after_the_shuffle(spark):
    """No rows are gathered by the tasks that read a log, and one day's rows are dealt."""
    logs = {
        "a": spark.range(0, 1000, numPartitions=4).selectExpr("'U1' AS user", "DATE '2024-01-01' AS date", "CAST(id % 7 AS string) AS pc", "1 AS one"),
        "b": spark.sql("SELECT 'u2' AS user, DATE '2024-01-02' AS date, CAST(NULL AS string) AS pc, 5 AS one"),
    }
    measures = {"a": U.Measures("a_rows", {"a_sum": "one"}, distinct={"a_pcs": "pc"}), "b": U.Measures("b_rows", {"b_sum": "one"}, distinct={"b_pcs": "pc"})}
    days = U.merged_days(logs, True, measures)
    plan = days._jdf.queryExecution().sparkPlan().toString()
    first = plan[: plan.index("RepartitionByExpression") if "RepartitionByExpression" in plan else plan.index("REPARTITION_BY_NUM")]
    below = plan[len(first) :]
    assert "Aggregate" in first and "Aggregate" not in below
    got = {r.user: (r.a_rows, r.a_sum, r.a_pcs, r.b_rows, r.b_sum, r.b_pcs) for r in days.collect()}
    assert got == {"u1": (1000, 1000, 7, None, None, 0), "u2": (None, None, 0, 1, 5, 0)}
