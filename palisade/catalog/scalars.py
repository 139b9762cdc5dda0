"""Scalar expressions over activity logs, flows and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from palisade.catalog import inputs as I
from palisade.catalog.registry import flag_sql, num, plain, query, whole
from palisade.functions import activity as A
from palisade.functions import flows as N
from palisade.functions.numeric import band
from palisade.operators import userday as U


@query("b01_lower_case", "SELECT c_custkey, lower(c_mktsegment) AS segment FROM customer")
def _(t):
    return plain(t.customer.select("c_custkey", A.normalised("c_mktsegment").alias("segment")))


@query(
    "b02_activity_flags",
    "SELECT event_id, "
    + flag_sql("event_type = 'click'", "connect_flag")
    + ", "
    + flag_sql("event_type = 'view'", "disconnect_flag")
    + " FROM events",
)
def _(t):
    return plain(
        I.device_log(t).select(
            "event_id",
            A.equals_flag("activity", "connect").alias("connect_flag"),
            A.equals_flag("activity", "disconnect").alias("disconnect_flag"),
        )
    )


@query(
    "b03_after_hours",
    "SELECT event_id, "
    + flag_sql("hour(ts) < 8 OR hour(ts) > 18", "after_hours")
    + ", "
    + flag_sql("hour(ts) < 8 OR hour(ts) >= 18", "after_hours_mail")
    + " FROM events",
)
def _(t):
    hour = F.hour("ts")
    return plain(
        t.events.select(
            "event_id",
            A.after_hours(hour).alias("after_hours"),
            A.after_hours(hour, end_counts=True).alias("after_hours_mail"),
        )
    )


@query(
    "b04_weekend",
    "SELECT event_id, " + flag_sql("isodow(ts) >= 5", "weekend") + ", " + flag_sql("isodow(ts) >= 6", "weekend_strict") + " FROM events",
)
def _(t):
    day = A.iso_weekday("ts")
    return plain(
        t.events.select(
            "event_id", A.weekend(day).alias("weekend"), A.weekend(day, 6).alias("weekend_strict")
        )
    )


@query(
    "b05_calendar_parts",
    "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, CAST(0 AS BIGINT) AS hour, "
    + whole("isodow(o_orderdate)", "weekday")
    + " FROM orders",
)
def _(t):
    # The text alternates between the two log formats by order status.
    when = F.col("o_orderdate")
    text = F.when(
        F.col("o_orderstatus") == "F", F.date_format(when, "MM/dd/yyyy HH:mm:ss")
    ).otherwise(F.date_format(when, "M/d/yyyy H:mm"))
    typed = t.orders.select("o_orderkey", text.alias("timestamp"))
    return plain(A.with_calendar(typed, "timestamp", A.TIMESTAMP_PATTERNS))


@query(
    "b06_nullable_boolean",
    "SELECT event_id, "
    + flag_sql("event_type = 'purchase'", "to_usb")
    + ", "
    + flag_sql("event_type = 'view'", "from_usb")
    + " FROM events",
)
def _(t):
    return plain(
        I.file_log(t).select(
            "event_id",
            A.boolean_flag("to_removable_media").alias("to_usb"),
            A.boolean_flag("from_removable_media").alias("from_usb"),
        )
    )


@query("b07_attachment_count", f"WITH {I.EMAIL} SELECT event_id, {whole('n_att', 'attachments')} FROM email")
def _(t):
    return plain(I.email_log(t).select("event_id", A.separated_count("attachments").alias("attachments")))


@query(
    "b08_keyword_count",
    "SELECT doc_id, CAST(length(text) - length(replace(text, ' ', '')) + 1 AS BIGINT) AS keywords FROM documents",
)
def _(t):
    return plain(t.documents.select("doc_id", A.keyword_count("text").alias("keywords")))


@query(
    "b09_recipient_list",
    f"WITH {I.EMAIL} SELECT event_id, array_to_string(list_filter(everything, lambda a: a <> ''), ',') AS recipients, "
    "array_to_string(everything, ',') AS with_empty FROM email",
)
def _(t):
    fields = ["to", "cc", "bcc"]
    return plain(
        I.email_log(t).select(
            "event_id",
            F.concat_ws(",", A.recipients(fields)).alias("recipients"),
            F.concat_ws(",", A.recipients(fields, drop_empty=False)).alias("with_empty"),
        )
    )


@query(
    "b10_external_recipients",
    f"WITH {I.EMAIL} SELECT event_id, {whole('n_all', 'recipients')}, {whole('n_ext', 'external')}, "
    f"{flag_sql('n_ext > 0', 'has_external')} FROM email",
)
def _(t):
    listed = I.email_log(t).withColumn("r", A.recipients(["to", "cc", "bcc"]))
    external = A.external_count("r")
    return plain(
        listed.select(
            "event_id",
            F.size("r").alias("recipients"),
            external.alias("external"),
            A.flag(external > 0).alias("has_external"),
        )
    )


@query(
    "b11_url_domain",
    "SELECT page_id, NULLIF(regexp_extract(url, 'https?://([^/]+)', 1), '') AS domain FROM pages",
)
def _(t):
    return plain(t.pages.select("page_id", A.url_domain("url").alias("domain")))


@query("b12_url_length", "SELECT page_id, length(url) AS url_length FROM pages")
def _(t):
    return plain(t.pages.select("page_id", F.char_length("url").alias("url_length")))


@query(
    "b13_suspicious_words",
    "SELECT 'page' AS kind, page_id AS id, " + flag_sql(I.URL_FLAG, "suspicious") + " FROM pages UNION ALL "
    "SELECT 'document', doc_id, " + flag_sql("regexp_matches(lower(text), 'login|auth|verify|secure')", "suspicious") + " FROM documents",
)
def _(t):
    pages = t.pages.select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), A.suspicious_url("url").alias("suspicious")
    )
    docs = t.documents.select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), A.suspicious_url("text").alias("suspicious")
    )
    return plain(pages.unionByName(docs))


@query("b14_decoy_lookup", f"WITH {I.DECOYS} SELECT filename, pc FROM decoys")
def _(t):
    return plain(U.decoy_lookup(I.decoys(t)))


_FAMILY_SQL = """CASE WHEN contains(lower(label), 'benign') THEN 'Benign' WHEN contains(lower(label), 'dos hulk') THEN 'DoS'
  WHEN contains(lower(label), 'ddos') THEN 'DDoS' WHEN contains(lower(label), 'portscan') THEN 'Probe / Scan'
  WHEN contains(lower(label), 'patator') THEN 'Brute Force' ELSE 'Other' END"""


@query(
    "b19_attack_family",
    f"WITH {I.FLOWS}, c AS (SELECT label, COUNT(*) AS n FROM flows GROUP BY label) SELECT label, {_FAMILY_SQL} AS family, n FROM c",
)
def _(t):
    counts = I.flows(t).groupBy("label").agg(F.count("*").alias("n"))
    return plain(counts.select("label", N.attack_family("label").alias("family"), "n"))


@query(
    "b20_class_group",
    f"""WITH {I.FLOWS} SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  CASE WHEN label = 'BENIGN' THEN 'BENIGN' WHEN contains(lower(label), 'ddos') THEN 'DDoS'
    WHEN contains(lower(label), 'dos') THEN 'DoS' WHEN contains(lower(label), 'portscan') THEN 'PortScan'
    WHEN contains(lower(label), 'patator') THEN 'Brute Force' ELSE 'Other' END AS class_group,
  CASE WHEN label = 'BENIGN' THEN 'BENIGN' WHEN contains(lower(label), 'dos') THEN 'DoS'
    WHEN contains(lower(label), 'portscan') THEN 'PortScan'
    WHEN contains(lower(label), 'patator') THEN 'Brute Force' ELSE 'Other' END AS class_group_dos_first FROM flows""",
)
def _(t):
    return plain(
        I.flows(t).select(
            *I.KEY,
            N.class_group("label").alias("class_group"),
            N.class_group("label", ddos_first=False).alias("class_group_dos_first"),
        )
    )


@query(
    "b29_severity_band",
    """SELECT event_id, CASE WHEN value >= 150 THEN 'CRITICAL' WHEN value >= 80 THEN 'HIGH'
  WHEN value >= 40 THEN 'ELEVATED' ELSE 'OK' END AS severity FROM events""",
)
def _(t):
    limits = [(40.0, "ELEVATED"), (80.0, "HIGH"), (150.0, "CRITICAL")]
    return plain(t.events.select("event_id", band("value", limits, "OK").alias("severity")))


@query("b30_micros_to_millis", "SELECT event_id, " + num("value / 1000.0", "millis") + " FROM events")
def _(t):
    return plain(t.events.select("event_id", N.micros_to_millis("value").alias("millis")))


@query(
    "b32_binary_class",
    f"WITH {I.FLOWS} SELECT CASE WHEN label = 'BENIGN' THEN 'B' ELSE 'M' END AS class, COUNT(*) AS n FROM flows GROUP BY 1",
)
def _(t):
    return plain(I.flows(t).groupBy(N.binary_class("label").alias("class")).agg(F.count("*").alias("n")))


@query("b33_trimmed_label", "SELECT event_type AS label, COUNT(*) AS n FROM events GROUP BY event_type")
def _(t):
    padded = t.events.select(F.concat(F.lit("  "), F.col("event_type"), F.lit(" ")).alias("label"))
    return plain(padded.groupBy(N.clean_label("label").alias("label")).agg(F.count("*").alias("n")))
