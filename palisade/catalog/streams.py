"""Streaming forms, drained over the whole event table and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from palisade.catalog import inputs as I
from palisade.catalog.detection import DETECTED
from palisade.catalog.monitoring import WIDTH
from palisade.catalog.registry import num, plain, query, text_time, whole
from palisade.functions import activity as A
from palisade.operators import models as M
from palisade.operators import prep
from palisade.session import scratch_path
from palisade.sources import monitoring as W
from palisade.streaming import jobs as J


SLICES = 3


def arrivals(t, slices: int = SLICES):
    """The event table cut into slices of time, as it would arrive.

    One event in ten comes half an hour late, so some come with the next slice.
    """
    ends = t.events.agg(F.min("ts"), F.max("ts")).first()
    low, width = ends[0], (ends[1] - ends[0]).total_seconds() / slices
    late = F.when(F.col("event_id") % 10 == 0, F.expr("INTERVAL 30 MINUTES")).otherwise(F.expr("INTERVAL 0 MINUTES"))
    seconds = F.unix_micros((F.col("ts") + late).cast("timestamp")) / 1e6 - F.unix_micros(F.lit(low).cast("timestamp")) / 1e6
    placed = t.events.withColumn("slice", F.least(F.floor(seconds / width), F.lit(slices - 1)))
    return [placed.where(F.col("slice") == i).drop("slice") for i in range(slices)], ends[1]


def drained(t, name: str, job, beat: bool = False):
    """The result of a streaming job over the whole event table, which comes in slices.

    The job is started anew for every slice and goes on from its checkpoint.  With
    ``beat`` a last row without user and kind, two hours later, moves the watermark past
    all events.
    """
    spark = t.spark
    path, target, checkpoint = (scratch_path(spark, f"{name}-{part}") for part in ("files", "out", "checkpoint"))
    parts, last = arrivals(t)
    result = None
    for i, part in enumerate(parts):
        part.repartitionByRange("ts").sortWithinPartitions("ts").write.mode("append").parquet(path)
        if beat and i == len(parts) - 1:
            row = spark.range(1).select(
                *[
                    (F.lit(last) + F.expr("INTERVAL 2 HOURS") if f.name == "ts" else F.lit(None)).cast(f.dataType).alias(f.name)
                    for f in part.schema
                ]
            )
            row.write.mode("append").parquet(path)
        stream = J.read_stream(spark, path, t.events.schema, "ts")
        result = J.run_available(job(stream), name, target=target, checkpoint=checkpoint)
    return result


def is_beat():
    return F.col("event_type").isNull()


# An hour is final once the watermark (latest time minus the delay) has passed its end.
CLOSED = "(SELECT MAX(ts) - INTERVAL 1 HOUR FROM events)"


@query(
    "g01_stream_hourly_metrics",
    "WITH h AS (SELECT date_trunc('hour', ts) AS w, event_type, COUNT(*) AS n, COUNT(*) FILTER (WHERE value >= 150) AS e, AVG(value) AS a, MAX(value) AS x FROM events GROUP BY 1, 2) "
    f"SELECT {text_time('w', 'window_start')}, event_type, n AS invocations, e AS errors_5xx, {num('a', 'latency_average')}, {num('x', 'latency_max')} FROM h WHERE w + INTERVAL 1 HOUR <= {CLOSED}",
)
def _(t):
    return plain(drained(t, "hourly", lambda s: J.hourly_metrics(s, "ts", "event_type", "value", F.col("value") >= 150)))


@query(
    "g16_stream_hourly_confusion",
    "WITH h AS (SELECT date_trunc('hour', e.ts) AS w, COUNT(*) FILTER (WHERE l.quality = 1 AND e.value < 50) AS tp, COUNT(*) FILTER (WHERE l.quality <> 1 AND e.value < 50) AS fp, "
    "COUNT(*) FILTER (WHERE l.quality = 1 AND e.value >= 50) AS fn, COUNT(*) FILTER (WHERE l.quality <> 1 AND e.value >= 50) AS tn FROM events e JOIN labels l ON l.doc_id = e.event_id GROUP BY 1) "
    f"SELECT {text_time('w', 'hour')}, tp, fp, fn, tn FROM h WHERE w + INTERVAL 1 HOUR <= (SELECT MAX(e.ts) - INTERVAL 1 HOUR FROM events e JOIN labels l ON l.doc_id = e.event_id)",
)
def _(t):
    truth = t.labels.select(F.col("doc_id").alias("event_id"), (F.col("quality") == 1).alias("truth"))
    judged = lambda s: J.hourly_confusion(s.join(truth, "event_id"), "ts", F.col("truth"), F.col("value") < 50)
    return plain(drained(t, "confusion", judged))


@query(
    "d01_stream_user_days",
    "WITH g AS (SELECT lower('U' || user_id) AS u, CAST(ts AS DATE) AS d, COUNT(*) AS n, MIN(hour(ts)) AS h0, MAX(hour(ts)) AS h1, "
    "SUM(CASE WHEN hour(ts) < 8 OR hour(ts) > 18 THEN 1 ELSE 0 END) AS ah, MAX(CASE WHEN isodow(ts) >= 5 THEN 1 ELSE 0 END) AS we FROM events GROUP BY 1, 2) "
    f"SELECT u AS \"user\", CAST(d AS VARCHAR) AS date, n AS logon_count, {whole('h0', 'first_logon_hour')}, {whole('h1', 'last_activity_hour')}, "
    f"{whole('ah', 'after_hours_logon_count')}, {whole('we', 'weekend_flag')} FROM g WHERE d + INTERVAL 1 DAY <= {CLOSED}",
)
def _(t):
    user = F.lower(F.concat(F.lit("U"), F.col("user_id").cast("string")))
    return plain(drained(t, "user-days", lambda s: J.user_day_counts(s.withColumn("user", user))))


@query("c01_stream_lookup", f"WITH {I.FILES} SELECT event_id, {whole('decoy', 'decoy')} FROM flagged")
def _(t):
    name = F.concat(F.lit("file-"), F.get_json_object("props", "$.k")).alias("filename")
    pc = F.concat(F.lit("pc-"), F.col("user_id").cast("string")).alias("pc")
    decoys = I.decoys(t).select(F.col("decoy_filename").alias("filename"), A.normalised("pc").alias("pc"))
    flagged = lambda s: J.with_lookup(s.select("event_id", name, pc), decoys, ["filename", "pc"], "decoy")
    return plain(drained(t, "lookup", lambda s: flagged(s).select("event_id", "decoy")))


@query(
    "g04_stream_cooldown",
    """WITH RECURSIVE a AS (SELECT user_id, epoch_us(ts) AS us, ts FROM events WHERE event_type = 'error'),
nxt AS (SELECT a.user_id, a.us, MIN(b.us) AS nx FROM a JOIN a b ON b.user_id = a.user_id AND b.us >= a.us + 129600000000 GROUP BY 1, 2),
chain AS (SELECT user_id, MIN(us) AS us FROM a GROUP BY user_id
  UNION ALL SELECT c.user_id, n.nx FROM chain c JOIN nxt n ON n.user_id = c.user_id AND n.us = c.us) """
    f"SELECT c.user_id, {text_time('make_timestamp(c.us)', 'fired_at')} FROM chain c",
)
def _(t):
    errors = lambda s: s.where("event_type = 'error' OR event_type IS NULL")
    fired = lambda s: J.cooldown(errors(s), "user_id", "ts", 36 * 3600, beats=is_beat())
    return plain(drained(t, "cooldown", fired, beat=True))


@query(
    "g06_stream_rolling_drift",
    f"""WITH r AS (SELECT event_id, user_id, value AS v, AVG(value) OVER w AS m, stddev_pop(value) OVER w AS sd FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN {WIDTH - 1} PRECEDING AND CURRENT ROW))
SELECT event_id, user_id, {num('v', 'value')}, {num('(v - m) / sd', 'z_score', 4)} FROM r WHERE sd > 1e-9 AND abs((v - m) / sd) > 3""",
)
def _(t):
    drift = lambda s: J.rolling_drift(s, "user_id", "event_id", "value", WIDTH, beats=is_beat())
    return plain(drained(t, "drift", drift, beat=True), z_score=4)


@query("g19_polled_snapshots", "SELECT event_type AS endpoint, COUNT(*) AS n FROM events GROUP BY event_type")
def _(t):
    """Snapshots appended as JSON lines by a stream, then read like a log."""
    path, source, checkpoint = (scratch_path(t.spark, f"polled-{part}") for part in ("out", "files", "checkpoint"))
    metrics = F.create_map(F.lit("ModelLatency_Average"), (F.col("value") * 1e6).cast("string"))
    endpoint = F.struct(F.col("event_type").alias("endpoint"), F.lit("InService").alias("status"), metrics.alias("metrics"))
    for part in arrivals(t)[0]:
        part.write.mode("append").parquet(source)
        stream = J.read_stream(t.spark, source, t.events.schema, "ts", 2)
        snapshots = stream.select(F.col("ts").cast("string").alias("timestamp"), F.create_map(F.col("event_type"), endpoint).alias("endpoints"))
        J.append_snapshots(snapshots, path, checkpoint).awaitTermination()
    names = W.read_snapshots(t.spark, path).select(F.explode(F.map_keys("endpoints")).alias("endpoint"))
    return plain(names.groupBy("endpoint").agg(F.count("*").alias("n")))


@query(
    "g18_stream_triggers",
    f"WITH {DETECTED}, b AS (SELECT *, vec_id * {SLICES} // (SELECT MAX(vec_id) + 1 FROM embeddings) AS batch FROM detected WHERE hot) "
    f"SELECT batch, predicted_label AS attack_type, {num('confidence', 'confidence')}, {num('mse', 'mse_error')}, '2024-01-30T00:00:00' AS timestamp "
    "FROM b QUALIFY row_number() OVER (PARTITION BY batch ORDER BY vec_id) = 1",
)
def _(t):
    """The first anomalous vector of every micro-batch becomes a trigger record."""
    spark = t.spark
    path, source, checkpoint = (scratch_path(spark, f"triggers-{part}") for part in ("out", "files", "checkpoint"))
    rows = I.vectors(t)
    model = M.block_reconstruction(rows.where("true_label = 'BENIGN'"), "embedding", I.DIMENSIONS)
    names = prep.label_map(rows.where("true_label <> 'BENIGN'"), "true_label")
    size = rows.agg(F.max("vec_id") + 1).first()[0]
    for i in range(SLICES):
        rows.where(F.floor(F.col("vec_id") * SLICES / size) == i).write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        found = M.detect_vectors(stream, "embedding", model, I.THRESHOLD, M.best_score, names, "vec_id")
        J.trigger_sink(found, "vec_id", path, checkpoint, {"timestamp": "2024-01-30T00:00:00"}).awaitTermination()
    parsed = F.from_json("value", "attack_type string, confidence double, mse_error double, timestamp string")
    return plain(spark.read.text(path).select(F.col("batch").cast("long"), parsed.alias("r")).select("batch", "r.*"))
