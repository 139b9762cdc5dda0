"""Activity logs, flow tables and score tables derived from the stored tables.

Each input exists twice: as a DataFrame and as a SQL common table expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.catalog.registry import Tables

# ---- activity logs ----------------------------------------------------------


def logs(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("user"),
        F.concat(F.lit("PC-"), _k()).alias("pc"),
        F.col("event_type").alias("activity"),
        "value",
    )


def _k():
    return F.get_json_object("props", "$.k")


LOGS = """logs AS (SELECT event_id, ts, 'U' || user_id AS "user",
  'PC-' || regexp_extract(props, '([0-9]+)', 1) AS pc, event_type AS activity, value,
  lower('U' || user_id) AS u, CAST(CAST(ts AS DATE) AS VARCHAR) AS d, hour(ts) AS h, isodow(ts) AS wd,
  CASE WHEN hour(ts) < 8 OR hour(ts) > 18 THEN 1 ELSE 0 END AS ah,
  CASE WHEN isodow(ts) >= 5 THEN 1 ELSE 0 END AS we FROM events)"""


def device_log(t: Tables) -> DataFrame:
    activity = (
        F.when(F.col("activity") == "click", "Connect")
        .when(F.col("activity") == "view", "Disconnect")
        .otherwise(F.col("activity"))
    )
    return logs(t).withColumn("activity", activity)


DEVICE = LOGS + """, device AS (SELECT u, d,
  SUM(CASE WHEN activity = 'click' THEN 1 ELSE 0 END) AS c,
  SUM(CASE WHEN activity = 'view' THEN 1 ELSE 0 END) AS dc FROM logs GROUP BY u, d)"""


def http_log(t: Tables) -> DataFrame:
    pages = t.pages.select("page_id", "url")
    visits = t.events.withColumn("page_id", F.floor("value").cast("long"))
    return visits.join(pages, "page_id", "left").select(
        "event_id",
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("user"),
        "url",
    )


URL_FLAG = "regexp_matches(lower(url), 'login|auth|verify|secure')"
HTTP = """http AS (SELECT e.event_id, lower('U' || e.user_id) AS u, CAST(CAST(e.ts AS DATE) AS VARCHAR) AS d, p.url,
  NULLIF(regexp_extract(p.url, 'https?://([^/]+)', 1), '') AS domain, length(p.url) AS url_length,
  CASE WHEN p.url IS NULL THEN NULL WHEN regexp_matches(lower(p.url), 'login|auth|verify|secure') THEN 1 ELSE 0 END AS suspicious,
  CASE WHEN hour(e.ts) < 8 OR hour(e.ts) > 18 THEN 1 ELSE 0 END AS ah,
  CASE WHEN isodow(e.ts) >= 5 THEN 1 ELSE 0 END AS we
  FROM events e LEFT JOIN pages p ON p.page_id = CAST(floor(e.value) AS BIGINT))"""


def email_log(t: Tables) -> DataFrame:
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    inside = F.concat(F.lit("a"), user, F.lit("@dtaa.com"))
    outside = F.concat(F.lit("b"), _k(), F.lit("@mail.net"))
    return t.events.select(
        "event_id",
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("U"), user).alias("user"),
        F.when(kind == "click", inside)
        .when(kind == "view", F.concat(inside, F.lit(";"), outside))
        .otherwise(outside)
        .alias("to"),
        F.when(~kind.isin("click", "error"), F.concat(F.lit("d"), _k(), F.lit("@dtaa.com"))).alias("cc"),
        F.when(
            kind == "purchase",
            F.concat(F.lit("e"), _k(), F.lit("@web.org;f"), _k(), F.lit("@dtaa.com")),
        ).alias("bcc"),
        F.when(kind.isin("click", "purchase"), "Send").otherwise("View").alias("activity"),
        F.when(F.col("value") >= 120, "x;y;z")
        .when(F.col("value") >= 60, "x;y")
        .when(F.col("value") >= 20, "x")
        .alias("attachments"),
    )


EMAIL = """raw_email AS (SELECT event_id, ts, user_id, event_type, value, regexp_extract(props, '([0-9]+)', 1) AS k FROM events),
mail AS (SELECT event_id, lower('U' || user_id) AS u, CAST(CAST(ts AS DATE) AS VARCHAR) AS d, hour(ts) AS h,
  CASE event_type WHEN 'click' THEN 'a' || user_id || '@dtaa.com'
    WHEN 'view' THEN 'a' || user_id || '@dtaa.com;b' || k || '@mail.net'
    ELSE 'b' || k || '@mail.net' END AS to_f,
  CASE WHEN event_type NOT IN ('click', 'error') THEN 'd' || k || '@dtaa.com' END AS cc_f,
  CASE WHEN event_type = 'purchase' THEN 'e' || k || '@web.org;f' || k || '@dtaa.com' END AS bcc_f,
  CASE WHEN event_type IN ('click', 'purchase') THEN 1 ELSE 0 END AS send,
  CASE WHEN value >= 120 THEN 'x;y;z' WHEN value >= 60 THEN 'x;y' WHEN value >= 20 THEN 'x' END AS attachments FROM raw_email),
listed AS (SELECT *, string_split(COALESCE(to_f, '') || ';' || COALESCE(cc_f, '') || ';' || COALESCE(bcc_f, ''), ';') AS everything,
  CASE WHEN h < 8 OR h >= 18 THEN 1 ELSE 0 END AS ah,
  CASE WHEN attachments IS NULL THEN 0 ELSE len(string_split(attachments, ';')) END AS n_att FROM mail),
email AS (SELECT *, len(list_filter(everything, lambda a: a <> '')) AS n_all,
  len(list_filter(everything, lambda a: a <> '' AND NOT contains(a, '@dtaa.com'))) AS n_ext FROM listed)"""


def file_log(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    text = t.documents.select(F.col("doc_id").alias("event_id"), F.col("text").alias("content"))
    files = t.events.select(
        "event_id",
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("user"),
        F.concat(F.lit("PC-"), F.col("user_id").cast("string")).alias("pc"),
        F.concat(F.lit("file-"), _k()).alias("filename"),
        F.when(kind == "click", "Copy")
        .when(kind == "view", "Write")
        .when(kind == "error", "Delete")
        .otherwise("Open")
        .alias("activity"),
        F.when(kind == "purchase", True).when(kind == "signup", False).alias("to_removable_media"),
        F.when(kind == "view", True).when(kind == "click", False).alias("from_removable_media"),
    )
    return files.join(text, "event_id", "left")


def decoys(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.concat(F.lit("file-"), F.col("s_nationkey").cast("string")).alias("decoy_filename"),
        F.concat(F.lit("PC-"), F.col("s_suppkey").cast("string")).alias("pc"),
    )


DECOYS = """decoys AS (SELECT DISTINCT 'file-' || s_nationkey AS filename, lower('PC-' || s_suppkey) AS pc FROM supplier)"""
FILES = DECOYS + """, files AS (SELECT e.event_id, lower('U' || e.user_id) AS u, CAST(CAST(e.ts AS DATE) AS VARCHAR) AS d,
  'file-' || regexp_extract(e.props, '([0-9]+)', 1) AS filename, lower('PC-' || e.user_id) AS pc, e.event_type AS kind,
  CASE WHEN hour(e.ts) < 8 OR hour(e.ts) > 18 THEN 1 ELSE 0 END AS ah,
  len(string_split(t.text, ' ')) AS words
  FROM events e LEFT JOIN documents t ON t.doc_id = e.event_id),
flagged AS (SELECT f.*, CASE WHEN k.filename IS NULL THEN 0 ELSE 1 END AS decoy
  FROM files f LEFT JOIN decoys k ON k.filename = f.filename AND k.pc = f.pc)"""


def periods(t: Tables) -> DataFrame:
    """Watch periods per user: two overlapping ones for each supplier's namesake."""
    user = F.concat(F.lit("u"), F.col("s_suppkey").cast("string"))
    first = F.date_add(F.lit("2024-01-01").cast("date"), F.col("s_nationkey"))
    rows = t.supplier.select(user.alias("user"), first.alias("start_date"), F.date_add(first, 6).alias("end_date"))
    later = rows.select(
        "user", F.date_add("start_date", 3).alias("start_date"), F.date_add("end_date", 2).alias("end_date")
    )
    return rows.unionByName(later)


PERIODS = """watch AS (SELECT 'u' || s_suppkey AS u, DATE '2024-01-01' + CAST(s_nationkey AS INTEGER) AS s FROM supplier),
periods AS (SELECT u, s AS a, s + 6 AS b FROM watch UNION ALL SELECT u, s + 3, s + 8 FROM watch)"""

# ---- flows ------------------------------------------------------------------

KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
PLAIN_FEATURES = ["quantity", "price", "discount", "tax"]
FEATURES = [*PLAIN_FEATURES, "flow_rate", "tax_rate"]


def flows(t: Tables) -> DataFrame:
    discount, tax = F.col("l_discount") + F.lit(0.0), F.col("l_tax") + F.lit(0.0)
    inf, nan = F.lit(float("inf")), F.lit(float("nan"))
    open_status = F.col("l_linestatus") == "O"
    label = (
        F.when(F.col("l_returnflag") == "N", "BENIGN")
        .when((F.col("l_returnflag") == "R") & open_status, "DoS Hulk")
        .when(F.col("l_returnflag") == "R", "DDoS")
        .when(open_status, "PortScan")
        .otherwise("FTP-Patator")
    )
    return t.lineitem.select(
        *KEY,
        label.alias("label"),
        F.year("l_shipdate").alias("day"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        discount.alias("discount"),
        tax.alias("tax"),
        F.when(discount == 0, inf).otherwise(F.try_divide("l_quantity", discount)).alias("flow_rate"),
        F.when(discount == 0, F.when(tax == 0, nan).otherwise(inf))
        .otherwise(F.try_divide(tax, discount))
        .alias("tax_rate"),
    )


def days_of(table: DataFrame) -> list:
    """The days that a flow table holds, in order: one small row each."""
    return [r["day"] for r in table.select("day").distinct().orderBy("day").collect()]


FLOWS = """flows AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CASE WHEN l_returnflag = 'N' THEN 'BENIGN'
    WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'DoS Hulk' WHEN l_returnflag = 'R' THEN 'DDoS'
    WHEN l_linestatus = 'O' THEN 'PortScan' ELSE 'FTP-Patator' END AS label,
  CAST(year(l_shipdate) AS BIGINT) AS day, l_quantity AS quantity, l_extendedprice AS price,
  l_discount + 0.0 AS discount, l_tax + 0.0 AS tax,
  CASE WHEN l_discount = 0 THEN CAST('Infinity' AS DOUBLE) ELSE l_quantity / l_discount END AS flow_rate,
  CASE WHEN l_discount = 0 AND l_tax = 0 THEN CAST('NaN' AS DOUBLE) WHEN l_discount = 0 THEN CAST('Infinity' AS DOUBLE)
    ELSE l_tax / l_discount END AS tax_rate,
  md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))) AS hk
  FROM lineitem)"""


def long_sql(features: list[str], name: str = "longf", source: str = "flows") -> str:
    """Long form of ``source``: label, day, feature, raw value and finite value."""
    parts = [
        f"SELECT label, day, '{f}' AS feature, {f} AS raw, CASE WHEN isfinite({f}) THEN {f} END AS value FROM {source}"
        for f in features
    ]
    return f"{name} AS ({' UNION ALL '.join(parts)})"


def clipped_sql(features: list[str], low: float = 0.01, high: float = 0.99) -> str:
    return (
        FLOWS
        + ", "
        + long_sql(features)
        + f""", bounds AS (SELECT feature, quantile_cont(value, {low}) AS lo, quantile_cont(value, {high}) AS hi FROM longf GROUP BY feature),
clipped AS (SELECT l.label, l.day, l.feature, l.value AS original, b.lo, b.hi,
  CASE WHEN l.value IS NULL THEN NULL ELSE least(greatest(l.value, b.lo), b.hi) END AS value
  FROM longf l JOIN bounds b ON b.feature = l.feature)"""
    )


# ---- scores -----------------------------------------------------------------

DIMENSIONS = 64
THRESHOLD = 0.0138


def vectors(t: Tables) -> DataFrame:
    """Feature vectors; labels below 5 are benign, the others attack classes."""
    label = F.when(F.col("label") < 5, F.lit("BENIGN")).otherwise(
        F.concat(F.lit("class_"), F.col("label").cast("string"))
    )
    return t.embeddings.select("vec_id", label.alias("true_label"), "embedding")


SCORES = """emb AS (SELECT vec_id, CASE WHEN label < 5 THEN 'BENIGN' ELSE 'class_' || label END AS true_label,
  unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
centre AS (SELECT i, AVG(x) AS c FROM emb WHERE true_label = 'BENIGN' GROUP BY i),
dev AS (SELECT e.vec_id, e.true_label, e.i, e.x - c.c AS dx, (e.i - 1) // 8 AS b FROM emb e JOIN centre c ON c.i = e.i),
codes AS (SELECT vec_id, b, AVG(dx) AS m FROM dev GROUP BY vec_id, b),
scored AS (SELECT d.vec_id, d.true_label, AVG((d.dx - k.m) * (d.dx - k.m)) AS mse
  FROM dev d JOIN codes k ON k.vec_id = d.vec_id AND k.b = d.b GROUP BY d.vec_id, d.true_label),
best AS (SELECT vec_id, MAX(m) AS confidence, arg_max(b, m) AS predicted_id FROM codes GROUP BY vec_id),
attack_names AS (SELECT true_label AS name, row_number() OVER (ORDER BY true_label) - 1 AS label_id
  FROM (SELECT DISTINCT true_label FROM emb WHERE true_label <> 'BENIGN') n)"""
