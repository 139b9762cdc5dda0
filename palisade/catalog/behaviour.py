"""User-day features, baselines, merge, labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from palisade.catalog import inputs as I
from palisade.catalog.registry import flag_sql, num, plain, query, whole
from palisade.functions import activity as A
from palisade.functions.numeric import ratio_or_zero
from palisade.operators import profile as P
from palisade.operators import userday as U
from palisade.plans import behaviour
from palisade.session import scratch_path

ID = 'u AS "user", d AS date'


def z_sql(value: str, name: str, user: str = "u") -> str:
    mean = f"AVG({value}) OVER (PARTITION BY {user})"
    std = f"stddev_samp({value}) OVER (PARTITION BY {user})"
    return num(f"CASE WHEN {std} > 0 THEN ({value} - {mean}) / {std} ELSE 0 END", name)


LOGON_DAY = I.LOGS + """, logon_day AS (SELECT u, d, COUNT(*) AS n, COUNT(DISTINCT lower(pc)) AS pcs, MIN(h) AS h0, MAX(h) AS h1,
  SUM(ah) AS ah, MAX(we) AS we FROM logs GROUP BY u, d)"""


def silver_logon(t):
    return U.silver_logon(I.logs(t))


@query(
    "d01_logon_daily",
    f"WITH {LOGON_DAY} SELECT {ID}, n AS logon_count, pcs AS unique_pc_count, {whole('h0', 'first_logon_hour')}, "
    f"{whole('h1', 'last_activity_hour')}, {whole('ah', 'after_hours_logon_count')}, {whole('we', 'weekend_flag')} FROM logon_day",
)
def _(t):
    return plain(U.daily_logon(silver_logon(t)))


LOGON_SQL = (
    f"SELECT {ID}, n AS logon_count, pcs AS unique_pc_count, {whole('h0', 'first_logon_hour')}, "
    f"{whole('h1', 'last_activity_hour')}, {whole('ah', 'after_hours_logon_count')}, {whole('we', 'weekend_flag')}, "
    f"{z_sql('n', 'logon_count_zscore')}, {whole('h1 - h0', 'work_duration_hours')} FROM logon_day"
)


@query("logon_features", f"WITH {LOGON_DAY} {LOGON_SQL}")
def logon_features(t):
    return plain(U.logon_features(silver_logon(t)))


@query(
    "d02_device_daily",
    f"WITH {I.DEVICE} SELECT {ID}, {whole('c', 'usb_connect_count')}, {whole('dc', 'usb_disconnect_count')}, "
    f"{flag_sql('c <> dc', 'incomplete_session_flag')}, {z_sql('c', 'usb_connect_zscore')} FROM device",
)
def _(t):
    return plain(U.device_features(U.silver_device(I.device_log(t))))


HTTP_DAY = I.HTTP + """, http_day AS (SELECT u, d, COUNT(*) AS n, COUNT(DISTINCT url) AS urls, COUNT(DISTINCT domain) AS domains,
  SUM(suspicious) AS sus, SUM(ah) AS ah, MAX(we) AS we, AVG(url_length) AS len FROM http GROUP BY u, d)"""
HTTP_SQL = (
    f"SELECT {ID}, n AS http_request_count, urls AS unique_url_count, domains AS unique_domain_count, "
    f"{whole('sus', 'suspicious_url_count')}, {whole('ah', 'after_hours_http_count')}, {whole('we', 'weekend_http_flag')}, "
    f"{num('len', 'mean_url_length')}, {z_sql('n', 'http_count_zscore')}, {z_sql('domains', 'domain_count_zscore')} FROM http_day"
)


@query("d03_http_daily", f"WITH {HTTP_DAY} {HTTP_SQL}")
def _(t):
    return plain(U.http_features(U.silver_http(I.http_log(t)), exact=True))


def near(sketched: str, exact: str, name: str):
    """Whether a sketch lies within three of its standard errors (5 %) of the exact count."""
    return (F.abs(F.col(sketched) - F.col(exact)) <= 0.15 * F.col(exact) + 1).alias(name)


def beside_exact(rows, exact, counts):
    """Approximate table with its sketched counts replaced by whether they are near."""
    true = exact.select("user", "date", *[F.col(c).alias(f"true_{c}") for c in counts])
    kept = [c for c in rows.columns if c not in counts]
    return rows.join(true, ["user", "date"]).select(*kept, *[near(c, f"true_{c}", c) for c in counts])


@query(
    "d03_http_daily_approximate",
    f"WITH {HTTP_DAY} SELECT * EXCLUDE (domain_count_zscore) REPLACE (CAST(1 AS BIGINT) AS unique_url_count, CAST(1 AS BIGINT) AS unique_domain_count) FROM ({HTTP_SQL})",
)
def _(t):
    """The default route; distinct counts are sketches and are held against exact ones."""
    silver = U.silver_http(I.http_log(t))
    rows = U.http_features(silver).drop("domain_count_zscore")
    return plain(beside_exact(rows, U.daily_http(silver, exact=True), ["unique_url_count", "unique_domain_count"]))


EMAIL_DAY = I.EMAIL + """, email_day AS (SELECT u, d, COUNT(*) AS n, SUM(send) AS sent, SUM(ah) AS ah, SUM(n_all) AS rcpt, SUM(n_ext) AS ext,
  SUM(CASE WHEN n_ext > 0 THEN 1 ELSE 0 END) AS w_ext, SUM(n_att) AS att FROM email GROUP BY u, d)"""


@query(
    "d04_email_daily",
    f"WITH {EMAIL_DAY} SELECT {ID}, n AS email_count, {whole('sent', 'send_count')}, {whole('ah', 'after_hours_email_count')}, "
    f"{whole('rcpt', 'total_recipients')}, {whole('ext', 'total_external_recipients')}, {whole('w_ext', 'emails_with_external')}, "
    f"{whole('att', 'total_attachments')}, {num('COALESCE(ext / NULLIF(rcpt, 0), 0)', 'external_recipient_ratio')}, "
    f"{num('w_ext / n', 'external_email_ratio')}, {num('att / n', 'attachment_per_email')} FROM email_day",
)
def _(t):
    return plain(U.daily_email(U.silver_email(I.email_log(t))))


EMAIL_SQL = (
    f"SELECT {ID}, n AS email_count, {whole('sent', 'send_count')}, {whole('ah', 'after_hours_email_count')}, "
    f"{num('w_ext / n', 'external_email_ratio')}, {num('att / n', 'attachment_per_email')}, "
    f"{num('n - AVG(n) OVER (PARTITION BY u)', 'email_volume_deviation')}, "
    f"{num('w_ext / n - AVG(w_ext / n) OVER (PARTITION BY u)', 'external_ratio_deviation')} FROM email_day"
)


@query("d09_email_deviation", f"WITH {EMAIL_DAY} {EMAIL_SQL}")
def _(t):
    return plain(U.email_features(U.silver_email(I.email_log(t))))


FILE_DAY = I.FILES + """, file_day AS (SELECT u, d, SUM(CASE WHEN kind = 'click' THEN 1 ELSE 0 END) AS cp,
  SUM(CASE WHEN kind = 'view' THEN 1 ELSE 0 END) AS wr, SUM(CASE WHEN kind = 'error' THEN 1 ELSE 0 END) AS de,
  SUM(CASE WHEN kind = 'purchase' THEN 1 ELSE 0 END) AS tu, SUM(CASE WHEN kind = 'view' THEN 1 ELSE 0 END) AS fu,
  SUM(ah) AS ah, COUNT(DISTINCT filename) AS files, AVG(words) AS words, SUM(decoy) AS decoy FROM flagged GROUP BY u, d)"""
FILE_SQL = (
    f"SELECT {ID}, {whole('cp', 'file_copy_count')}, {whole('wr', 'file_write_count')}, {whole('de', 'file_delete_count')}, "
    f"{whole('tu', 'usb_copy_count')}, {whole('fu', 'usb_read_count')}, {whole('ah', 'after_hours_file_count')}, "
    f"files AS unique_file_count, {num('words', 'avg_keyword_count')}, {whole('decoy', 'decoy_access_count')}, "
    f"{z_sql('cp', 'file_copy_zscore')} FROM file_day"
)


@query("d05_file_daily", f"WITH {FILE_DAY} {FILE_SQL}")
def _(t):
    return plain(
        U.file_features(U.silver_file(I.file_log(t)), U.decoy_lookup(I.decoys(t)), exact=True)
    )


@query(
    "d05_file_daily_approximate",
    f"WITH {FILE_DAY} SELECT * REPLACE (CAST(1 AS BIGINT) AS unique_file_count) FROM ({FILE_SQL})",
)
def _(t):
    """The default route; the count of files is a sketch and is held against the exact one."""
    silver, decoys = U.silver_file(I.file_log(t)), U.decoy_lookup(I.decoys(t))
    exact = U.file_features(silver, decoys, exact=True)
    return plain(beside_exact(U.file_features(silver, decoys), exact, ["unique_file_count"]))


@query("c01_lookup_flag", f"WITH {I.FILES} SELECT event_id, {whole('decoy', 'decoy_access_flag')} FROM flagged")
def _(t):
    files = I.file_log(t).drop("content").withColumn("pc", A.normalised("pc"))
    flagged = U.lookup_flag(files, U.decoy_lookup(I.decoys(t)), ["filename", "pc"], "decoy_access_flag")
    return plain(flagged.select("event_id", "decoy_access_flag"))


@query(
    "c02_baseline_join",
    f"WITH {LOGON_DAY}, base AS (SELECT u, AVG(n) AS m, stddev_samp(n) AS s FROM logon_day GROUP BY u) "
    f"SELECT l.u AS \"user\", l.d AS date, l.n AS logon_count, {num('b.m', 'mean_logon_count')}, {num('b.s', 'std_logon_count')} "
    "FROM logon_day l LEFT JOIN base b ON b.u = l.u",
)
def _(t):
    joined = U.join_baseline(U.daily_logon(silver_logon(t)), ["logon_count"])
    return plain(joined.select("user", "date", "logon_count", "mean_logon_count", "std_logon_count"))


@query(
    "d06_safe_ratio",
    "SELECT user_id, " + num("COALESCE(SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) / NULLIF(SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END), 0), 0)", "errors_per_click") + " FROM events GROUP BY user_id",
)
def _(t):
    counts = t.events.groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "error").alias("e"),
        F.count_if(F.col("event_type") == "click").alias("c"),
    )
    return plain(counts.select("user_id", ratio_or_zero("e", "c").alias("errors_per_click")))


@query(
    "d07_user_baseline",
    f"WITH {LOGON_DAY} SELECT u AS \"user\", {num('AVG(n)', 'mean_logon_count')}, {num('AVG(pcs)', 'mean_unique_pc_count')}, "
    f"{num('stddev_samp(n)', 'std_logon_count')}, {num('stddev_samp(pcs)', 'std_unique_pc_count')} FROM logon_day GROUP BY u",
)
def _(t):
    return plain(U.user_baseline(U.daily_logon(silver_logon(t)), ["logon_count", "unique_pc_count"]))


@query(
    "d08_zscores",
    f"WITH {LOGON_DAY} SELECT {ID}, {z_sql('n', 'count_z')}, {z_sql('pcs', 'pc_z')} FROM logon_day",
)
def _(t):
    scored = U.with_zscores(
        U.daily_logon(silver_logon(t)), {"logon_count": "count_z", "unique_pc_count": "pc_z"}
    )
    return plain(scored.select("user", "date", "count_z", "pc_z"))


@query(
    "d10_incremental_daily",
    f"WITH {HTTP_DAY} SELECT {ID}, n AS http_request_count, {whole('ah', 'after_hours_http_count')}, {num('len', 'mean_url_length')} FROM http_day",
)
def _(t):
    """The first half of the month is stored first, the rest by a second run."""
    spark = t.spark
    layer, cache = scratch_path(spark, "silver"), scratch_path(spark, "http-days")
    silver = U.silver_http(I.http_log(t))
    middle = F.lit("2024-01-15").cast("date")
    silver.where(F.col("date") <= middle).write.partitionBy("date").parquet(f"{layer}/http")
    behaviour.refresh_http_days(spark, layer, cache)
    silver.where(F.col("date") > middle).write.mode("append").partitionBy("date").parquet(f"{layer}/http")
    days = behaviour.refresh_http_days(spark, layer, cache)
    return plain(days.select("user", "date", "http_request_count", "after_hours_http_count", "mean_url_length"))


@query(
    "d10_late_and_broken_days",
    f"WITH {HTTP_DAY} SELECT {ID}, n AS http_request_count, {whole('ah', 'after_hours_http_count')}, {num('len', 'mean_url_length')}, "
    f"{z_sql('n', 'http_count_zscore')} FROM http_day",
)
def _(t):
    """Late rows for stored days, and a run that broke before it was entered as done."""
    spark = t.spark
    layer, cache = scratch_path(spark, "silver"), scratch_path(spark, "http-days")
    silver = U.silver_http(I.http_log(t))
    late, broken = F.col("event_id") % 7 == 0, F.dayofmonth("date") % 5 == 0
    silver.where(~late).write.partitionBy("date").parquet(f"{layer}/http")
    # What a broken run may leave: half of a day's users, and no entry.
    U.daily_http(silver.where(broken & ~late & (F.col("user") < "u5"))).write.partitionBy("date").parquet(cache)
    behaviour.refresh_http_days(spark, layer, cache)
    silver.where(late).write.mode("append").partitionBy("date").parquet(f"{layer}/http")
    days = U.http_scores(behaviour.refresh_http_days(spark, layer, cache))
    return plain(days.select("user", "date", "http_request_count", "after_hours_http_count", "mean_url_length", "http_count_zscore"))


def silver_tables(t):
    return {
        "logon": silver_logon(t),
        "device": U.silver_device(I.device_log(t)),
        "email": U.silver_email(I.email_log(t)),
        "file": U.silver_file(I.file_log(t)),
        "http": U.silver_http(I.http_log(t)),
        "decoy_file": U.decoy_lookup(I.decoys(t)),
    }


def _by_kind(t):
    """The same activity split into one table per kind, so that days are missing."""
    rows = I.logs(t).withColumn("user", F.lower("user")).withColumn("date", F.to_date("timestamp"))

    def daily(kind, name):
        return rows.where(F.col("activity") == kind).groupBy("user", "date").agg(
            F.count("*").alias(f"{name}_count"), F.sum("value").alias(f"{name}_value")
        )

    return [daily("click", "click"), daily("view", "view"), daily("error", "error"), daily("purchase", "purchase"), daily("signup", "signup")]


def _kind_sql(kind: str) -> str:
    return f"{kind} AS (SELECT u, d, COUNT(*) AS n, SUM(value) AS v FROM logs WHERE activity = '{kind}' GROUP BY u, d)"


KINDS = ["click", "view", "error", "purchase", "signup"]
GOLD = (
    I.LOGS
    + ", "
    + ", ".join(_kind_sql(k) for k in KINDS)
    + ", gold AS (SELECT c.u, c.d, "
    + ", ".join(
        f"{whole(f'COALESCE({k}.n, 0)', f'{k}_count')}, {num(f'COALESCE({k}.v, 0)', f'{k}_value')}"
        for k in ["c", *KINDS[1:]]
    ).replace("c_count", "click_count").replace("c_value", "click_value")
    + " FROM click c "
    + " ".join(f"LEFT JOIN {k} ON {k}.u = c.u AND {k}.d = c.d" for k in KINDS[1:])
    + ")"
)
GOLD_COLUMNS = ", ".join(f"{k}_count, {k}_value" for k in KINDS)


@query("c03_gold_merge", f"WITH {GOLD} SELECT {ID}, {GOLD_COLUMNS} FROM gold")
def _(t):
    first, *rest = _by_kind(t)
    return plain(U.merge_gold(first, rest))


@query(
    "c04_range_label",
    f"WITH {LOGON_DAY}, {I.PERIODS} SELECT {ID}, n AS logon_count, "
    + flag_sql("EXISTS (SELECT 1 FROM periods p WHERE p.u = l.u AND CAST(l.d AS DATE) BETWEEN p.a AND p.b)", "target")
    + " FROM logon_day l",
)
def _(t):
    days = U.daily_logon(silver_logon(t)).select("user", "date", "logon_count")
    return plain(U.label_periods(days, I.periods(t)))


@query(
    "labelled_user_day",
    f"WITH {LOGON_DAY}, {I.PERIODS}, {HTTP_DAY}, {EMAIL_DAY}, {FILE_DAY}, device AS (SELECT u, d, "
    "SUM(CASE WHEN activity = 'click' THEN 1 ELSE 0 END) AS c, SUM(CASE WHEN activity = 'view' THEN 1 ELSE 0 END) AS dc "
    f"FROM logs GROUP BY u, d), l AS ({LOGON_SQL}), h AS ({HTTP_SQL}), e AS ({EMAIL_SQL}), f AS ({FILE_SQL}), "
    f"v AS (SELECT {ID}, {whole('c', 'usb_connect_count')}, {whole('dc', 'usb_disconnect_count')}, "
    f"{flag_sql('c <> dc', 'incomplete_session_flag')}, {z_sql('c', 'usb_connect_zscore')} FROM device) "
    "SELECT l.*, v.* EXCLUDE (\"user\", date), e.* EXCLUDE (\"user\", date), "
    "f.* EXCLUDE (\"user\", date) REPLACE (COALESCE(f.avg_keyword_count, 0) AS avg_keyword_count), "
    "h.* EXCLUDE (\"user\", date) REPLACE (COALESCE(h.suspicious_url_count, 0) AS suspicious_url_count, COALESCE(h.mean_url_length, 0) AS mean_url_length), "
    + flag_sql("EXISTS (SELECT 1 FROM periods p WHERE p.u = l.\"user\" AND CAST(l.date AS DATE) BETWEEN p.a AND p.b)", "target")
    + " FROM l JOIN v USING (\"user\", date) JOIN e USING (\"user\", date) JOIN f USING (\"user\", date) JOIN h USING (\"user\", date)",
)
def labelled(t):
    return plain(behaviour.labelled_from_silver(silver_tables(t), I.periods(t), exact=True))


def sparse_silver(t):
    """Silver tables that each miss days: every log keeps the events of some kinds."""
    kept = {
        "logon": "activity <> 'signup'",
        "device": "activity IN ('Connect', 'Disconnect')",
        "email": "attachments IS NOT NULL",
        "file": "activity <> 'open' AND to_usb_event + from_usb_event + copy_event > 0",
        "http": "url IS NOT NULL",
    }
    logs = {"logon": I.logs(t), "device": I.device_log(t)}
    tables = silver_tables(t)
    derive = {"logon": U.silver_logon, "device": U.silver_device}
    some = {n: derive[n](df.where(kept[n])) for n, df in logs.items()}
    return {**tables, **some, **{n: tables[n].where(kept[n]) for n in ("email", "file", "http")}}


_SPARSE = {
    "logs": "activity <> 'signup'", "device_rows": "activity IN ('click', 'view')", "email": "attachments IS NOT NULL",
    "flagged": "kind IN ('click', 'view')", "http": "url IS NOT NULL",
}


def _zero(columns: str) -> str:
    return ", ".join(f"COALESCE({c}, 0) AS {c.split('.')[-1]}" for c in columns.split())


@query(
    "c03_user_day_features",
    f"WITH {LOGON_DAY.replace('FROM logs GROUP', 'FROM logs WHERE ' + _SPARSE['logs'] + ' GROUP')}, "
    f"{HTTP_DAY.replace('FROM http GROUP', 'FROM http WHERE ' + _SPARSE['http'] + ' GROUP')}, "
    f"{EMAIL_DAY.replace('FROM email GROUP', 'FROM email WHERE ' + _SPARSE['email'] + ' GROUP')}, "
    f"{FILE_DAY.replace('FROM flagged GROUP', 'FROM flagged WHERE ' + _SPARSE['flagged'] + ' GROUP')}, device AS (SELECT u, d, "
    "SUM(CASE WHEN activity = 'click' THEN 1 ELSE 0 END) AS c, SUM(CASE WHEN activity = 'view' THEN 1 ELSE 0 END) AS dc "
    f"FROM logs WHERE {_SPARSE['device_rows']} GROUP BY u, d), l AS ({LOGON_SQL}), h AS ({HTTP_SQL}), e AS ({EMAIL_SQL}), f AS ({FILE_SQL}), "
    f"v AS (SELECT {ID}, {whole('c', 'usb_connect_count')}, {whole('dc', 'usb_disconnect_count')}, "
    f"{flag_sql('c <> dc', 'incomplete_session_flag')}, {z_sql('c', 'usb_connect_zscore')} FROM device) SELECT l.*, "
    + _zero("v.usb_connect_count v.usb_disconnect_count v.incomplete_session_flag v.usb_connect_zscore e.email_count e.send_count "
            "e.after_hours_email_count e.external_email_ratio e.attachment_per_email e.email_volume_deviation e.external_ratio_deviation "
            "f.file_copy_count f.file_write_count f.file_delete_count f.usb_copy_count f.usb_read_count f.after_hours_file_count "
            "f.unique_file_count f.avg_keyword_count f.decoy_access_count f.file_copy_zscore h.http_request_count h.unique_url_count "
            "h.unique_domain_count h.suspicious_url_count h.after_hours_http_count h.weekend_http_flag h.mean_url_length "
            "h.http_count_zscore h.domain_count_zscore")
    + " FROM l "
    + " ".join(f'LEFT JOIN {x} ON {x}."user" = l."user" AND {x}.date = l.date' for x in "vefh"),
)
def _(t):
    return plain(U.merged_features(sparse_silver(t), exact=True))


@query(
    "c06_activity_facet",
    f"WITH {LOGON_DAY}, dv AS (SELECT DISTINCT u, d FROM logs WHERE activity IN ('click', 'view')) "
    "SELECT CAST(CASE WHEN dv.u IS NULL THEN 0 ELSE 1 END AS BIGINT) AS has_device, COUNT(*) AS days "
    "FROM logon_day l LEFT JOIN dv ON dv.u = l.u AND dv.d = l.d GROUP BY 1",
)
def _(t):
    days = U.daily_logon(silver_logon(t))
    used = U.silver_device(I.device_log(t)).where("usb_connect_event = 1 OR usb_disconnect_event = 1")
    return plain(
        U.activity_facet(days, used).groupBy("has_device").agg(F.count("*").alias("days"))
    )


@query(
    "e08_rolling_days",
    f"WITH {LOGON_DAY} SELECT {ID}, n AS logon_count, "
    + num("AVG(n) OVER (PARTITION BY u ORDER BY d ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)", "avg_50")
    + ", "
    + num("AVG(n) OVER (PARTITION BY u ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)", "avg_7")
    + " FROM logon_day",
)
def _(t):
    daily = U.daily_logon(silver_logon(t)).select("user", "date", "logon_count")
    return plain(U.rolling_days(U.rolling_days(daily, "logon_count", "avg_50"), "logon_count", "avg_7", 7))


@query(
    "e08_tumbling_days",
    f"WITH {LOGON_DAY} SELECT u AS \"user\", {whole('floor(date_diff(' + chr(39) + 'day' + chr(39) + ', DATE ' + chr(39) + '1970-01-01' + chr(39) + ', CAST(d AS DATE)) / 50)', 'span')}, "
    f"{num('AVG(n)', 'avg_50')} FROM logon_day GROUP BY 1, 2",
)
def _(t):
    return plain(U.tumbling_days(U.daily_logon(silver_logon(t)), "logon_count", "avg_50"))


@query(
    "f24_heuristic_label",
    f"WITH {LOGON_DAY}, z AS (SELECT {ID}, {z_sql('n', 'count_z')}, {z_sql('pcs', 'pc_z')} FROM logon_day) "
    "SELECT *, CAST(CASE WHEN abs(count_z) > 2 OR abs(pc_z) > 2 THEN 1 ELSE 0 END AS BIGINT) AS anomaly FROM z",
)
def _(t):
    scored = U.with_zscores(
        U.daily_logon(silver_logon(t)), {"logon_count": "count_z", "unique_pc_count": "pc_z"}
    ).select("user", "date", "count_z", "pc_z")
    return plain(U.heuristic_label(scored, ["count_z", "pc_z"], 2.0))


@query("b23_drop_constant", f"WITH {GOLD} SELECT {ID}, {GOLD_COLUMNS} FROM gold")
def _(t):
    first, *rest = _by_kind(t)
    merged = U.merge_gold(first, rest).withColumns({"always": F.lit(1), "tag": F.lit("x")})
    return plain(P.drop_constant(merged))


@query(
    "b24_fill_missing",
    "SELECT e.event_id, COALESCE(l.quality, 0)::BIGINT AS quality, COALESCE(l.toxic, 0)::BIGINT AS toxic, e.event_type FROM events e LEFT JOIN labels l ON l.doc_id = e.event_id",
)
def _(t):
    labels = t.labels.withColumnRenamed("doc_id", "event_id")
    joined = t.events.select("event_id", "event_type").join(labels, "event_id", "left")
    return plain(U.fill_numeric(joined).select("event_id", "quality", "toxic", "event_type"))


@query(
    "b25_corrected_periods",
    """SELECT lower(c_name) AS "user", CASE WHEN c_name = 'Customer#000000002' THEN '2011-04-21'
  WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE CAST(DATE '2010-01-01' + CAST(c_nationkey AS INTEGER) AS VARCHAR) END AS start_date,
  CAST(DATE '2010-02-01' + CAST(c_nationkey AS INTEGER) AS VARCHAR) AS end_date
  FROM customer WHERE c_mktsegment <> 'BUILDING'""",
)
def _(t):
    base = F.date_add(F.lit("2010-01-01").cast("date"), F.col("c_nationkey"))
    later = F.date_add(F.lit("2010-02-01").cast("date"), F.col("c_nationkey"))
    rows = t.customer.select(
        F.when(F.col("c_mktsegment") == "BUILDING", "5.2").otherwise("6.2").alias("dataset"),
        F.col("c_name").alias("user"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "not a date")
        .otherwise(F.date_format(base, "MM/dd/yyyy 09:30:00"))
        .alias("start"),
        F.date_format(later, "M/d/yyyy 17:05").alias("end"),
    )
    fixes = {"Customer#000000002": "04/21/2011 11:43:39"}
    return plain(U.insider_periods(rows, 6.2, fixes))
