"""Drift, snapshots, alerts, gates and hourly alarms over the event stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from palisade.catalog import inputs as I
from palisade.catalog.detection import DETECTED, detections
from palisade.catalog.profiles import MI
from palisade.catalog.registry import num, plain, query, text_time
from palisade.operators import alerts as L
from palisade.operators import drift as D
from palisade.operators import models as M
from palisade.operators import quality as Q
from palisade.operators import ranking as K
from palisade.operators.evaluation import binary_quality

WIDTH = 20

# ---- drift ------------------------------------------------------------------


def series(t):
    """Error-sized values per user in time order."""
    return t.events.select("event_id", "user_id", "ts", (F.col("value") / 1000.0).alias("mse_error"))


def rolled(t):
    return D.rolling_stats(
        series(t), "mse_error", [F.col("ts"), F.col("event_id")], F.date_trunc("day", "ts"), WIDTH, ["user_id"]
    )


ROLLED = f"""s AS (SELECT event_id, user_id, ts, value / 1000.0 AS v FROM events),
r AS (SELECT *, row_number() OVER o - 1 AS idx, AVG(v) OVER w AS m, stddev_pop(v) OVER w AS sd FROM s
  WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id),
  w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN {WIDTH - 1} PRECEDING AND CURRENT ROW)),
zs AS (SELECT *, CASE WHEN sd > 1e-9 THEN (v - m) / sd ELSE 0 END AS z FROM r)"""


@query("e01_rolling_stats", f"WITH {ROLLED} SELECT event_id, user_id, idx AS index, {num('m', 'mean', 9)}, {num('sd', 'std', 9)} FROM r")
def _(t):
    return plain(rolled(t).select("event_id", "user_id", "index", "mean", "std"), 9)


@query("e02_drift_events", f"WITH {ROLLED} SELECT event_id, user_id, idx AS index, {num('z', 'z_score', 4)} FROM zs WHERE abs(z) > 3")
def _(t):
    return plain(D.drift_events(rolled(t), "mse_error").select("event_id", "user_id", "index", "z_score"), 4)


REPORT = ROLLED + """, tot AS (SELECT user_id, COUNT(*) AS samples, AVG(v) AS mean, stddev_pop(v) AS std,
  COUNT(*) FILTER (WHERE abs(z) > 3) AS events FROM zs GROUP BY user_id),
lst AS (SELECT user_id, string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx) AS listed FROM
  (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY idx) AS place FROM zs WHERE abs(z) > 3) q WHERE place <= 50 GROUP BY user_id)"""
_SEVERITY = "CASE WHEN mean >= 0.0891 THEN 'CRITICAL' WHEN mean >= 0.0567 THEN 'HIGH' WHEN mean >= 0.0234 THEN 'ELEVATED' ELSE 'OK' END AS severity"


def report(t):
    return D.drift_report(rolled(t), "mse_error", WIDTH, 3.0, ["user_id"])


@query(
    "g06_drift_report",
    f"WITH {REPORT} SELECT t.user_id, samples, CAST({WIDTH} AS BIGINT) AS window_size, {num('3.0', 'z_threshold')}, {num('mean', 'overall_mean')}, "
    f"{num('std', 'overall_std')}, events AS drift_event_count, {num('events * 100.0 / samples', 'drift_rate_pct', 2)}, {_SEVERITY}, "
    "COALESCE(listed, '') AS listed FROM tot t LEFT JOIN lst l ON l.user_id = t.user_id",
)
def _(t):
    listed = F.concat_ws(",", F.transform("drift_events", lambda e: e["index"].cast("string")))
    return plain(report(t).withColumn("listed", listed).drop("drift_events"))


@query(
    "g07_published_metrics",
    f"WITH {REPORT} SELECT 'DriftDetection' AS namespace, user_id, 'DriftRatePct' AS metric, {num('events * 100.0 / samples', 'value', 2)}, 'Percent' AS unit FROM tot "
    f"UNION ALL SELECT 'DriftDetection', user_id, 'MeanMSE', {num('mean', 'value')}, 'None' FROM tot",
)
def _(t):
    return plain(D.published_metrics(report(t), ["user_id"]))


@query(
    "e10_top_drift_events",
    f"WITH {ROLLED} SELECT event_id, {num('z', 'z_score', 4)} FROM zs WHERE abs(z) > 3 ORDER BY abs(round(z, 6)) DESC, event_id LIMIT 5",
)
def _(t):
    top = D.drift_events(rolled(t), "mse_error").orderBy(F.desc(F.abs(F.round("z_score", 6))), "event_id").limit(5)
    return plain(top.select("event_id", "z_score"), 4)


DAILY = "daily AS (SELECT event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, SUM(value) AS loss FROM events GROUP BY 1, 2)"


def daily_loss(t):
    return t.events.groupBy("event_type", F.to_date("ts").alias("date")).agg(F.sum("value").alias("loss"))


@query(
    "e06_loss_history",
    f"WITH {DAILY} SELECT event_type, date, {num('loss', 'loss')}, {num('MIN(loss) OVER (PARTITION BY event_type ORDER BY date)', 'best')}, "
    f"{num('LAG(loss) OVER (PARTITION BY event_type ORDER BY date) - loss', 'improvement')} FROM daily",
)
def _(t):
    return plain(D.loss_history(daily_loss(t), "loss", "date", ["event_type"]))


@query(
    "e07_overall_improvement",
    f"WITH {DAILY}, g AS (SELECT event_type, COUNT(*) AS steps, arg_min(loss, date) AS a, arg_max(loss, date) AS b, MIN(loss) AS best FROM daily GROUP BY event_type) "
    f"SELECT event_type, steps, {num('a', 'first')}, {num('b', 'last')}, {num('best', 'best')}, {num('a - b', 'improvement')}, "
    f"{num('(a - b) / steps', 'per_step')}, {num('(a - b) * 100.0 / a', 'improvement_pct')} FROM g",
)
def _(t):
    return plain(D.overall_improvement(daily_loss(t), "loss", "date", ["event_type"]))


# ---- snapshots and alerts ---------------------------------------------------


@query(
    "d43_latest_value",
    f"SELECT event_type, {num('arg_max(value, event_id)', 'value')} FROM events GROUP BY event_type",
)
def _(t):
    return plain(L.latest_values(t.events, "event_type", "value", ["ts", "event_id"]))


def snapshots(t):
    """Each kind of event is an endpoint; the value is its latency in ms."""
    calls = t.events.withColumn("latency_us", F.col("value") * 1000.0)
    return L.snapshots(calls, "ts", "event_type", "latency_us", F.col("value") >= 150, "6 hours")


SNAP = """calls AS (SELECT event_type, value, value * 1000.0 AS us, time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '1970-01-01') AS w FROM events),
snap AS (SELECT w, event_type, COUNT(*) AS n, COUNT(*) FILTER (WHERE value >= 150) AS e, AVG(us) AS a, MAX(us) AS x,
  quantile_cont(us, 0.9) AS p90, quantile_cont(us, 0.99) AS p99 FROM calls GROUP BY w, event_type)"""
_SNAP = f"{text_time('w', 'window_start')}, event_type, n AS invocations, e AS errors_5xx, {num('a', 'latency_average', 3)}, {num('x', 'latency_max', 3)}, {num('p90', 'latency_p90', 3)}, {num('p99', 'latency_p99', 3)}"


@query("g01_endpoint_snapshots", f"WITH {SNAP} SELECT {_SNAP} FROM snap")
def endpoint_snapshots(t):
    return plain(snapshots(t), 3)


LIMITS = {"latency_ms": (120.0, 200.0), "error_pct": (1.0, 10.0)}
CHECKED = SNAP + """, lv AS (SELECT *, p99 / 1000.0 AS ms, CASE WHEN e > 0 THEN e * 100.0 / greatest(n, 1) END AS rate FROM snap),
chk AS (SELECT *, CASE WHEN ms >= 200 THEN 'CRITICAL' WHEN ms >= 120 THEN 'WARNING' END AS ll,
  CASE WHEN rate >= 10 THEN 'CRITICAL' WHEN rate >= 1 THEN 'WARNING' END AS el FROM lv)"""


@query(
    "g02_threshold_check",
    f"WITH {CHECKED} SELECT {text_time('w', 'window_start')}, event_type, {num('ms', 'latency_ms')}, {num('rate', 'error_rate_pct')}, ll AS latency_level, el AS error_level FROM chk",
)
def _(t):
    checked = L.checked(snapshots(t), **LIMITS)
    return plain(
        checked.select("window_start", "event_type", "latency_ms", "error_rate_pct", "latency_level", "error_level")
    )


def alert_rows(t, snaps):
    status = F.when(F.col("errors_5xx") >= 3, "Failed").when(F.col("errors_5xx") == 2, "Updating").otherwise("InService")
    return L.alert_rows(L.checked(snaps, **LIMITS).withColumn("status", status), "event_type", "window_start", "status")


ALERTS = CHECKED + """, al AS (
SELECT w, event_type, event_type || '_latency_' || lower(ll) AS key, ll AS level, 'latency of ' || event_type || ': ' || CAST(CAST(round(ms) AS BIGINT) AS VARCHAR) || ' ms' AS subject FROM {src} WHERE ll IS NOT NULL
UNION ALL SELECT w, event_type, event_type || '_error_rate_' || lower(el), el, '5xx errors of ' || event_type || ': ' || CAST(round(CAST(rate AS DOUBLE), 1) AS VARCHAR) || '%' FROM {src} WHERE el IS NOT NULL
UNION ALL SELECT w, event_type, event_type || '_status', 'CRITICAL', 'endpoint ' || event_type || ' is Failed' FROM {src} WHERE e >= 3)"""
_ALERT = f"SELECT {text_time('w', 'window_start')}, event_type, key, level, subject FROM al"


@query("g03_alert_rows", f"WITH {ALERTS.format(src='chk')} {_ALERT}")
def _(t):
    return plain(alert_rows(t, snapshots(t)).drop("body"))


@query(
    "g05_latest_snapshot_alerts",
    f"WITH {ALERTS.format(src='newest').replace('), al AS', '), newest AS (SELECT * FROM chk c WHERE w = (SELECT MAX(w) FROM chk d WHERE d.event_type = c.event_type)), al AS')} {_ALERT}",
)
def _(t):
    newest = L.latest_snapshot(snapshots(t), "window_start", "event_type")
    return plain(alert_rows(t, newest).drop("body"))


@query(
    "g04_cooldown",
    """WITH RECURSIVE a AS (SELECT user_id, event_id, epoch_us(ts) AS us FROM events WHERE event_type = 'error'),
nxt AS (SELECT a.user_id, a.us, MIN(b.us) AS nx FROM a JOIN a b ON b.user_id = a.user_id AND b.us >= a.us + 129600000000 GROUP BY 1, 2),
chain AS (SELECT user_id, MIN(us) AS us FROM a GROUP BY user_id
  UNION ALL SELECT c.user_id, n.nx FROM chain c JOIN nxt n ON n.user_id = c.user_id AND n.us = c.us)
SELECT a.event_id, a.user_id, CAST(CASE WHEN c.us IS NULL THEN 0 ELSE 1 END AS BIGINT) AS fired
FROM a LEFT JOIN chain c ON c.user_id = a.user_id AND c.us = a.us""",
)
def _(t):
    errors = t.events.where("event_type = 'error'").select("event_id", "user_id", "ts")
    return plain(L.cooldown(errors, "user_id", "ts", 36 * 3600, ["event_id"]).drop("ts"))


# ---- steps and hourly alarms ------------------------------------------------


@query(
    "g09_step_outcome",
    """WITH s AS (SELECT event_type, AVG(value) < 50 AS passed, MAX(value) > 400 AS skipped FROM events GROUP BY event_type)
SELECT COUNT(*) AS steps, COUNT(*) FILTER (WHERE skipped) AS skipped, CAST(bool_and(passed OR skipped) AS BIGINT) AS passed,
MIN(event_type) FILTER (WHERE NOT (passed OR skipped)) AS first_failure FROM s""",
)
def _(t):
    steps = t.events.groupBy("event_type").agg(
        (F.avg("value") < 50).alias("passed"), (F.max("value") > 400).alias("skipped")
    )
    return plain(Q.step_outcome(steps, "event_type", "event_type"))


TRUTH = """lab AS (SELECT e.ts, e.event_id, l.quality = 1 AS truth, e.value < 50 AS pred FROM events e JOIN labels l ON l.doc_id = e.event_id),
hq AS (SELECT date_trunc('hour', ts) AS w, COUNT(*) FILTER (WHERE truth AND pred) AS tp, COUNT(*) FILTER (WHERE NOT truth AND pred) AS fp,
  COUNT(*) FILTER (WHERE truth AND NOT pred) AS fn, COUNT(*) FILTER (WHERE NOT truth AND NOT pred) AS tn FROM lab GROUP BY 1),
fb AS (SELECT *, COALESCE(5.0 * tp / NULLIF(5.0 * tp + 4.0 * fn + fp, 0), 0) AS f2, COALESCE(tp / NULLIF(tp + fp, 0), 0) AS prec,
  COALESCE(tp / NULLIF(tp + fn, 0), 0) AS rec, (tp + tn) / (tp + fp + fn + tn) AS acc FROM hq)"""


def judged(t):
    """Captured predictions merged with the labels known for them."""
    predictions = t.events.select("event_id", "ts", (F.col("value") < 50).alias("predicted"))
    truth = t.labels.select(F.col("doc_id").alias("event_id"), (F.col("quality") == 1).alias("truth"))
    return Q.joined_predictions(predictions, truth, "event_id")


@query(
    "c05_joined_predictions",
    f"WITH {TRUTH} SELECT event_id, CAST(truth AS BIGINT) AS truth, CAST(pred AS BIGINT) AS predicted FROM lab",
)
def _(t):
    return plain(judged(t).select("event_id", "truth", "predicted"))


@query(
    "g10_f2_alarm",
    f"WITH {TRUTH} SELECT {text_time('w', 'hour')}, tp, fp, fn, tn, {num('f2', 'fbeta')}, CAST(f2 < 0.8 AS BIGINT) AS breached FROM fb",
)
def _(t):
    hourly = Q.hourly_quality(judged(t), "ts", F.col("truth"), F.col("predicted"))
    return plain(Q.f2_alarm(hourly).drop("accuracy", "precision", "recall"))


@query(
    "g16_hourly_quality",
    f"WITH {TRUTH} SELECT {text_time('w', 'hour')}, tp, fp, fn, tn, {num('acc', 'accuracy')}, {num('prec', 'precision')}, {num('rec', 'recall')}, {num('f2', 'fbeta')} FROM fb",
)
def _(t):
    return plain(Q.hourly_quality(judged(t), "ts", F.col("truth"), F.col("predicted")))


@query(
    "g16_overall_quality",
    "WITH lab AS (SELECT l.quality = 1 AS truth, d.n_chars >= 400 AS pred FROM documents d JOIN labels l ON l.doc_id = d.doc_id), "
    "c AS (SELECT COUNT(*) FILTER (WHERE truth AND pred) AS tp, COUNT(*) FILTER (WHERE NOT truth AND pred) AS fp, "
    "COUNT(*) FILTER (WHERE truth AND NOT pred) AS fn, COUNT(*) FILTER (WHERE NOT truth AND NOT pred) AS tn FROM lab) "
    f"SELECT tp, fp, fn, tn, {num('(tp + tn) / (tp + fp + fn + tn)', 'accuracy')}, {num('tp / (tp + fp)', 'precision')}, {num('tp / (tp + fn)', 'recall')}, "
    f"{num('2.0 * tp / (2.0 * tp + fn + fp)', 'fbeta')} FROM c",
)
def _(t):
    predictions = t.documents.select("doc_id", (F.col("n_chars") >= 400).alias("predicted"))
    both = Q.joined_predictions(predictions, t.labels, "doc_id")
    return plain(binary_quality(both, F.col("quality") == 1, F.col("predicted")))


@query(
    "g11_feature_drift",
    """WITH b AS (SELECT event_type, AVG(value) AS m, stddev_samp(value) AS s FROM events WHERE ts < TIMESTAMP '2024-01-08' GROUP BY event_type),
h AS (SELECT date_trunc('hour', ts) AS w, event_type, AVG(value) AS v FROM events GROUP BY 1, 2),
m AS (SELECT h.w, MAX(abs(h.v - b.m) / b.s) AS d FROM h JOIN b ON b.event_type = h.event_type GROUP BY h.w) """
    f"SELECT {text_time('w', 'hour')}, {num('d', 'max_distance')}, CAST(d >= 1.0 AS BIGINT) AS breached FROM m",
)
def _(t):
    timed = t.events.withColumn("hour", Q.hour_start("ts"))
    early = t.events.where(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz"))
    distances = D.mean_shift(early, timed, "value", ["hour", "event_type"], ["event_type"])
    return plain(Q.drift_alarm(distances, ["hour"]))


@query(
    "g12_disparate_impact",
    """WITH h AS (SELECT date_trunc('hour', ts) AS w,
  AVG(CASE WHEN event_type IN ('click', 'view') THEN CASE WHEN value > 50 THEN 1 ELSE 0 END END) AS a,
  AVG(CASE WHEN event_type NOT IN ('click', 'view') THEN CASE WHEN value > 50 THEN 1 ELSE 0 END END) AS b FROM events GROUP BY 1),
r AS (SELECT *, a / NULLIF(b, 0) AS q FROM h) """
    f"SELECT {text_time('w', 'hour')}, {num('a', 'rate_facet')}, {num('b', 'rate_rest')}, {num('q', 'impact')}, CAST(q < 0.8 OR q > 1.25 AS BIGINT) AS breached FROM r",
)
def _(t):
    facet = F.col("event_type").isin("click", "view")
    return plain(Q.disparate_impact(t.events, "ts", facet, F.col("value") > 50))


def _mi_period(name: str, condition: str) -> str:
    text = MI
    for part in ("longf", "cuts", "cells", "tot"):
        text = text.replace(f"{part} AS", f"{part}_{name} AS").replace(f"FROM {part} ", f"FROM {part}_{name} ")
        text = text.replace(f"FROM {part})", f"FROM {part}_{name})").replace(f"JOIN {part} ", f"JOIN {part}_{name} ")
    text = text.replace("flows AS", f"flows_{name} AS").replace("FROM flows", f"FROM flows_{name}")
    return text.replace("FROM lineitem)", f"FROM lineitem WHERE {condition})") + (
        f", mi_{name} AS (SELECT feature, SUM(n / t * ln(n * t / (b * c))) AS mi FROM tot_{name} GROUP BY feature), "
        f"share_{name} AS (SELECT feature, mi / SUM(mi) OVER () AS s FROM mi_{name})"
    )


@query(
    "g13_explanation_drift",
    f"WITH {_mi_period('a', 'year(l_shipdate) < 1998')}, {_mi_period('b', 'year(l_shipdate) >= 1998')} "
    f"SELECT {num('MAX(abs(a.s - b.s))', 'max_shift')}, {num('SUM(abs(a.s - b.s))', 'total_shift')} FROM share_a a JOIN share_b b ON b.feature = a.feature",
)
def _(t):
    table = I.flows(t)
    before = K.mutual_information(table.where("day < 1998"), I.FEATURES)
    after = K.mutual_information(table.where("day >= 1998"), I.FEATURES)
    return plain(D.importance_distance(before, after, value="mi"))


@query(
    "g14_state_changes",
    """WITH h AS (SELECT event_type, date_trunc('hour', ts) AS w, AVG(value) AS v FROM events GROUP BY 1, 2),
s AS (SELECT *, CASE WHEN v >= 80 THEN 'ALARM' ELSE 'OK' END AS state FROM h),
p AS (SELECT *, COALESCE(LAG(state) OVER (PARTITION BY event_type ORDER BY w), 'OK') AS previous FROM s) """
    f"SELECT event_type, {text_time('w', 'hour')}, {num('v', 'value')}, state, previous FROM p WHERE state <> previous",
)
def _(t):
    hourly = t.events.groupBy("event_type", Q.hour_start("ts")).agg(F.avg("value").alias("value"))
    return plain(L.state_changes(hourly, ["event_type"], "hour", F.col("value") >= 80))


# ---- data quality -----------------------------------------------------------

_HALF = "TIMESTAMP '2024-01-16'"


def _half(t, early: bool):
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    labels = t.labels.select(F.col("doc_id").alias("event_id"), "quality")
    rows = t.events.join(labels, "event_id", "left").select("ts", "event_id", "user_id", "value", "event_type", "quality")
    return rows.where(F.col("ts") < middle if early else F.col("ts") >= middle).drop("ts")


def _profile_sql(condition: str) -> str:
    source = f"(SELECT e.event_id, e.user_id, e.value, e.event_type, l.quality FROM events e LEFT JOIN labels l ON l.doc_id = e.event_id WHERE {condition})"
    parts = []
    for column, kind in (("event_id", "bigint"), ("user_id", "bigint"), ("value", "double"), ("event_type", "string"), ("quality", "int")):
        v = column if kind != "string" else "CAST(NULL AS DOUBLE)"
        parts.append(
            f"SELECT '{column}' AS \"column\", '{kind}' AS type, AVG(CASE WHEN {column} IS NULL THEN 0 ELSE 1 END) AS completeness, "
            f"CAST(MIN({v}) AS DOUBLE) AS lo, CAST(MAX({v}) AS DOUBLE) AS hi, AVG({v}) AS m, stddev_samp({v}) AS s FROM {source}"
        )
    return " UNION ALL ".join(parts)


@query(
    "g15_quality_baseline",
    f"WITH p AS ({_profile_sql(f'ts < {_HALF}')}) SELECT \"column\", type, {num('completeness', 'completeness')}, {num('lo', 'min')}, {num('hi', 'max')}, {num('m', 'mean')}, {num('s', 'std')} FROM p",
)
def _(t):
    return plain(Q.baseline(_half(t, True)))


@query(
    "g15_violations",
    f"WITH p AS ({_profile_sql(f'ts < {_HALF}')}), n AS ({_profile_sql(f'ts >= {_HALF}')}), "
    "j AS (SELECT p.\"column\", p.completeness AS pc, n.completeness AS nc, p.lo AS plo, n.lo AS nlo, p.hi AS phi, n.hi AS nhi FROM p JOIN n ON n.\"column\" = p.\"column\") "
    "SELECT \"column\", 'completeness' AS violation FROM j WHERE nc < pc UNION ALL SELECT \"column\", 'below_min' FROM j WHERE nlo < plo "
    "UNION ALL SELECT \"column\", 'above_max' FROM j WHERE nhi > phi",
)
def _(t):
    return plain(Q.violations(Q.baseline(_half(t, True)), Q.baseline(_half(t, False))))


# ---- registry and trigger records -------------------------------------------


@query(
    "g17_model_versions",
    """SELECT s_suppkey AS version, CASE WHEN s_acctbal < 0 THEN 'Failed' ELSE 'Completed' END AS status,
  CASE WHEN s_nationkey < 12 THEN 'Approved' ELSE 'PendingManualApproval' END AS approval,
  CASE WHEN s_acctbal < 0 THEN 'N/A' ELSE s_name END AS image,
  CASE WHEN s_acctbal < 0 THEN 'N/A' ELSE 'model-' || s_suppkey || '.tar.gz' END AS model_data,
  CAST(DATE '2024-01-01' + CAST(s_nationkey AS INTEGER) AS VARCHAR) AS created,
  CASE WHEN s_nationkey > 20 THEN 'N/A' ELSE s_name END AS description FROM supplier""",
)
def _(t):
    key = F.col("s_suppkey").cast("string")
    container = F.struct(
        F.concat(F.lit("registry/models/"), F.col("s_name")).alias("image"),
        F.concat(F.lit("store/versions/model-"), key, F.lit(".tar.gz")).alias("model_url"),
    )
    created = F.date_add(F.lit("2024-01-01").cast("date"), F.col("s_nationkey"))
    failed = F.col("s_acctbal") < 0
    packages = t.supplier.select(
        F.col("s_suppkey").alias("version"),
        F.when(failed, "Failed").otherwise("Completed").alias("status"),
        F.when(F.col("s_nationkey") < 12, "Approved").otherwise("PendingManualApproval").alias("approval"),
        F.concat(created.cast("string"), F.lit(" 10:00:00")).alias("created"),
        F.when(F.col("s_nationkey") <= 20, F.col("s_name")).alias("description"),
        F.when(~failed, F.array(container)).alias("containers"),
    )
    return plain(Q.model_versions(packages))


@query(
    "g18_trigger_records",
    f"WITH {DETECTED} SELECT COALESCE(predicted_label, 'UNKNOWN') AS attack_type, {num('COALESCE(confidence, 0)', 'confidence')}, {num('mse', 'mse_error')}, "
    "'2024-01-30T00:00:00' AS timestamp FROM detected WHERE hot",
)
def _(t):
    rows = detections(t).where("is_anomalous").select(F.col("predicted_label").alias("attack_type"), "confidence", "mse_error").withColumn(
        "timestamp", F.lit(None).cast("string")
    )
    records = Q.trigger_record(rows, {"timestamp": "2024-01-30T00:00:00"})
    parsed = F.from_json("record", "attack_type string, confidence double, mse_error double, timestamp string")
    return plain(records.select(parsed.alias("r")).select("r.*"))


@query(
    "g18_first_trigger_record",
    f"WITH {DETECTED} SELECT predicted_label AS attack_type, {num('confidence', 'confidence')}, {num('mse', 'mse_error')} FROM detected WHERE hot ORDER BY vec_id LIMIT 1",
)
def _(t):
    first = M.first_trigger(detections(t), "vec_id").select(
        F.col("predicted_label").alias("attack_type"), "confidence", "mse_error", F.lit("now").alias("timestamp")
    )
    parsed = F.from_json("record", "attack_type string, confidence double, mse_error double")
    return plain(Q.trigger_record(first).select(parsed.alias("r")).select("r.*"))

