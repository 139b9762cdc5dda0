"""Sources, layers and sinks, each written to scratch space and read back."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.catalog import inputs as I
from palisade.catalog.registry import num, plain, query, text_time, whole
from palisade.operators import models as M
from palisade.session import scratch_path
from palisade.sources import flows as S
from palisade.sources import inventory as V
from palisade.sources import logs as G
from palisade.sources import monitoring as W

ORDERS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("date", T.StringType()),
        T.StructField("user", T.StringType()),
    ]
)


def order_log(t):
    """Orders as a raw log: the date is text in two formats, and invalid for status P."""
    when, status = F.col("o_orderdate"), F.col("o_orderstatus")
    text = (
        F.when(status == "F", F.date_format(when, "MM/dd/yyyy HH:mm:ss"))
        .when(status == "O", F.date_format(when, "M/d/yyyy H:mm"))
        .otherwise(F.concat(F.lit("on "), F.date_format(when, "yyyy-MM-dd")))
    )
    return t.orders.select(
        F.concat(F.lit("U"), F.col("o_custkey").cast("string")).alias("user"),
        "o_orderkey",
        text.alias("date"),
        "o_totalprice",
        F.col("o_orderpriority").alias("ignored"),
    )


def order_csv(t) -> str:
    path = scratch_path(t.spark, "orders-csv")
    order_log(t).write.option("header", True).csv(path)
    return path


@query(
    "a01_csv_scan",
    """SELECT o_orderkey, ROUND(o_totalprice, 6) + 0.0 AS o_totalprice, CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%m/%d/%Y %H:%M:%S')
  WHEN 'O' THEN strftime(o_orderdate, '%-m/%-d/%Y %-H:%M') ELSE 'on ' || strftime(o_orderdate, '%Y-%m-%d') END AS date,
  'U' || o_custkey AS "user" FROM orders""",
)
def _(t):
    return plain(G.read_csv(t.spark, order_csv(t), ORDERS))


@query("a02_row_cap", f"SELECT event_id, event_type, {num('value', 'value')} FROM events ORDER BY event_id LIMIT 5000")
def _(t):
    return plain(G.capped(t.events, 5000, ["event_id"]).select("event_id", "event_type", "value"))


@query(
    "a03_parsed_timestamps",
    f"SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE {text_time('o_orderdate', 'x').replace(' AS x', '')} END AS timestamp FROM orders",
)
def _(t):
    return plain(G.with_timestamp(order_log(t)).select("o_orderkey", "timestamp"))


@query(
    "a04_partition_columns",
    "SELECT o_orderkey, " + ", ".join([whole("year(o_orderdate)", "year"), whole("month(o_orderdate)", "month"), whole("day(o_orderdate)", "day")]) + " FROM orders",
)
def _(t):
    df, names = G.with_partition_columns(t.orders, "o_orderdate", "Day")
    return plain(df.select("o_orderkey", *names))


def bronze_orders(t) -> str:
    """CSV to partitioned bronze; rows without a valid timestamp go to the null partition."""
    path = scratch_path(t.spark, "orders-bronze")
    G.ingest_csv(t.spark, order_csv(t), path, ORDERS, "month")
    return path


@query(
    "a05_partitioned_write",
    f"SELECT CASE WHEN o_orderstatus <> 'P' THEN CAST(year(o_orderdate) AS BIGINT) END AS year, CASE WHEN o_orderstatus <> 'P' THEN CAST(month(o_orderdate) AS BIGINT) END AS month, "
    f"COUNT(*) AS n, {num('SUM(o_totalprice)', 'total', 2)} FROM orders GROUP BY 1, 2",
)
def _(t):
    stored = G.read_parquet(t.spark, bronze_orders(t))
    return plain(stored.groupBy("year", "month").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total")), 2)


@query("a06_keep_or_overwrite", "SELECT 'kept' AS run, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS n FROM orders UNION ALL SELECT 'replaced', COUNT(*) FROM orders")
def _(t):
    """A second write leaves the table alone; with overwrite it is replaced."""
    path, other = scratch_path(t.spark, "kept"), scratch_path(t.spark, "replaced")
    some = t.orders.where("o_orderstatus = 'F'")
    for target, overwrite in ((path, False), (other, True)):
        G.write_layer(some, target, ["o_orderpriority"])
        G.write_layer(t.orders, target, ["o_orderpriority"], overwrite)

    def counted(target, run):
        return G.read_parquet(t.spark, target).agg(F.count("*").alias("n")).select(F.lit(run).alias("run"), "n")

    return plain(counted(path, "kept").unionByName(counted(other, "replaced")))


@query("a08_row_limit", "SELECT least(COUNT(*), 1000) AS n FROM events")
def _(t):
    return plain(G.read_parquet(t.spark, t.path("events"), 1000).agg(F.count("*").alias("n")))


@query(
    "a09_pruned_day",
    f"SELECT o_orderkey, {num('o_totalprice', 'o_totalprice')} FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-10-03'",
)
def _(t):
    path = scratch_path(t.spark, "orders-by-month")
    df, names = G.with_partition_columns(t.orders, "o_orderdate", "month")
    G.write_layer(df, path, names)
    stored = G.read_parquet(t.spark, path).withColumn("day", F.dayofmonth("o_orderdate"))
    return plain(G.day_partition(stored, 1998, 10, 3).select("o_orderkey", "o_totalprice"))


@query(
    "a09_pruned_event_day",
    f"SELECT event_id, user_id, {num('value', 'value')} FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-17'",
)
def _(t):
    """One day of a table partitioned down to the day: one folder is read."""
    path = scratch_path(t.spark, "events-by-day")
    df, names = G.with_partition_columns(t.events, "ts", "day")
    G.write_layer(df, path, names)
    return plain(G.read_day(t.spark, path, 2024, 1, 17).select("event_id", "user_id", "value"))


@query("a10_parquet_sink", f"SELECT event_id, user_id, {num('value', 'value')} FROM events")
def _(t):
    path = scratch_path(t.spark, "events-snappy")
    G.write_layer(t.events, path, codec="snappy")
    return plain(G.read_parquet(t.spark, path).select("event_id", "user_id", "value"))


# ---- flows ------------------------------------------------------------------

def flow_csv(t) -> dict[str, str]:
    """One CSV directory for each day there is, blanks around header names, and a missing day."""
    root = scratch_path(t.spark, "flow-csv")
    table = I.flows(t).select(
        F.concat(F.lit(" "), F.col("label"), F.lit(" ")).alias(" Label"),
        F.col("l_orderkey").alias(" Flow ID"),
        F.col("quantity").alias(" quantity "),
        F.col("price"),
        F.col("flow_rate").alias(" Flow Bytes/s"),
        "day",
    )
    table.write.partitionBy("day").option("header", True).csv(root)
    days = {str(d): f"{root}/day={d}" for d in I.days_of(table) if d is not None}
    return {**days, "missing": f"{root}/day=missing"}


@query(
    "a11_union_of_day_files",
    f"WITH {I.FLOWS} SELECT CAST(day AS VARCHAR) AS day, label AS \"Label\", COUNT(*) AS n, {num('SUM(quantity)', 'quantity', 2)}, COUNT(*) FILTER (WHERE isinf(flow_rate)) AS infinite FROM flows GROUP BY day, label",
)
def _(t):
    table = S.read_days(t.spark, flow_csv(t))
    infinite = F.count_if(F.abs(F.col("`Flow Bytes/s`")) == float("inf"))
    return plain(
        table.groupBy("day", "Label").agg(F.count("*").alias("n"), F.sum("quantity").alias("quantity"), infinite.alias("infinite")), 2
    )


@query("a12_label_only", f"WITH {I.FLOWS} SELECT label, COUNT(*) AS n FROM flows GROUP BY label")
def _(t):
    return plain(I.flows(t).select("label").groupBy("label").agg(F.count("*").alias("n")))


@query("a13_glob_scan", f"WITH {I.FLOWS} SELECT label AS \"Label\", COUNT(*) AS n, {num('SUM(price)', 'price', 2)} FROM flows GROUP BY label")
def _(t):
    root = flow_csv(t)["missing"].rsplit("/", 1)[0]
    table = S.read_flow_csv(t.spark, f"{root}/day=*")
    return plain(table.groupBy("Label").agg(F.count("*").alias("n"), F.sum("price").alias("price")), 2)


@query("a14_csv_sink", f"WITH {I.FLOWS} SELECT l_orderkey, {num('quantity / 3.0', 'x')} FROM flows")
def _(t):
    path = scratch_path(t.spark, "features-csv")
    S.write_csv(I.flows(t).select("l_orderkey", (F.col("quantity") / 3.0).alias("x")), path)
    back = t.spark.read.option("header", True).schema("l_orderkey long, x double").csv(path)
    return plain(back)


# ---- reports and series -----------------------------------------------------


@query(
    "a15_json_report",
    f"WITH {I.FLOWS}, c AS (SELECT day, label, COUNT(*) AS n FROM flows GROUP BY day, label) SELECT day, {whole('SUM(n)', 'rows')}, COUNT(*) AS classes, {whole('MAX(n) FILTER (WHERE label = ' + repr('BENIGN') + ')', 'benign')} FROM c GROUP BY day",
)
def _(t):
    path = scratch_path(t.spark, "report")
    W.write_report(V.flow_catalog(I.flows(t), "label"), path)
    back = t.spark.read.schema("day long, rows long, distribution map<string,long>, classes array<string>").json(path)
    return plain(back.select("day", "rows", F.size("classes").alias("classes"), F.col("distribution")["BENIGN"].alias("benign")))


def snapshot_rows(t):
    """One snapshot per event: its kind is the endpoint, its value the latency."""
    metrics = F.create_map(F.lit("ModelLatency_Average"), (F.col("value") * 1e6).cast("string"))
    endpoint = F.struct(
        F.col("event_type").alias("endpoint"), F.lit("InService").alias("status"), metrics.alias("metrics")
    )
    return t.events.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.create_map(F.col("event_type"), endpoint).alias("endpoints"),
        "event_id",
    )


@query("a16_appended_snapshots", "SELECT event_type AS endpoint, COUNT(*) AS n FROM events GROUP BY event_type")
def _(t):
    path = scratch_path(t.spark, "monitor-jsonl")
    rows = snapshot_rows(t)
    W.append_snapshots(rows.where("event_id < 5000").drop("event_id"), path)
    W.append_snapshots(rows.where("event_id >= 5000").drop("event_id"), path)
    names = W.read_snapshots(t.spark, path).select(F.explode(F.map_keys("endpoints")).alias("endpoint"))
    return plain(names.groupBy("endpoint").agg(F.count("*").alias("n")))


@query("a17_metric_series", f"SELECT COUNT(*) AS n, {num('SUM(value)', 'total', 2)} FROM events WHERE event_type = 'view'")
def _(t):
    """Lines with a cut end, blanks and text where a number belongs are skipped."""
    path = scratch_path(t.spark, "mixed-jsonl")
    good = snapshot_rows(t).select(F.to_json(F.struct("timestamp", "endpoints")).alias("value"))
    broken = good.select(F.expr("left(value, length(value) - 5)").alias("value"))
    text = good.select(F.regexp_replace("value", r'"ModelLatency_Average":"[^"]*"', '"ModelLatency_Average":"n/a"').alias("value"))
    blank = good.select(F.lit("  ").alias("value"))
    good.unionByName(broken).unionByName(text).unionByName(blank).write.text(path)
    series = W.read_metric_series(t.spark, path, "view", "ModelLatency_Average")
    return plain(series.agg(F.count("*").alias("n"), F.sum("value").alias("total")), 2)


@query("a17_nested_field", f"SELECT event_id, {num('CAST(regexp_extract(props, ' + repr('([0-9]+)') + ', 1) AS DOUBLE) * 1e-6', 'k', 9)} FROM events")
def _(t):
    return plain(t.events.select("event_id", W.snapshot_metric("props", "$.k").alias("k")), 9)


@query(
    "a18_number_column",
    f"SELECT 'named' AS source, COUNT(*) AS n, {num('SUM(value)', 'total', 2)} FROM events WHERE event_type <> 'view' UNION ALL "
    f"SELECT 'first', COUNT(*), {num('SUM(value)', 'total', 2)} FROM events",
)
def _(t):
    path = scratch_path(t.spark, "series-csv")
    bad = F.when(F.col("event_type") == "view", "n/a").otherwise(F.col("value").cast("string"))
    t.events.select(F.col("value").alias("first"), bad.alias("mse_error")).write.option("header", True).csv(path)

    def total(column, name):
        series = W.read_number_column(t.spark, path, column)
        return series.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.lit(name).alias("source"), "n", "total")

    return plain(total("mse_error", "named").unionByName(total("absent", "first")), 2)


@query(
    "a19_features_with_labels",
    "SELECT e.vec_id, COALESCE(CAST(l.quality AS VARCHAR), 'UNKNOWN') AS label, "
    + ", ".join(num(f"CASE WHEN e.embedding[{i + 1}] > 0 THEN e.embedding[{i + 1}] ELSE 0 END", f"f{i:02d}") for i in range(I.DIMENSIONS))
    + " FROM embeddings e LEFT JOIN labels l ON l.doc_id = e.vec_id",
)
def _(t):
    wide = M.to_columns(t.embeddings.drop("label"), "embedding", I.DIMENSIONS)
    names = [f"f{i:02d}" for i in range(I.DIMENSIONS)]
    gaps = wide.withColumns({n: F.when(F.col(n) > 0, F.col(n)) for n in names})
    labels = t.labels.select(F.col("doc_id").alias("vec_id"), F.col("quality").cast("string").alias("label"))
    return plain(S.with_labels(gaps, labels, "vec_id", names))


@query(
    "a20_size_reduction",
    "SELECT CAST(1 AS BIGINT) AS stored, CAST(1 AS BIGINT) AS smaller, CAST(1 AS BIGINT) AS percent_of_sizes, COUNT(*) AS rows FROM orders",
)
def _(t):
    """File sizes are not known to SQL: what holds of them is, and that all rows are there."""
    path = scratch_path(t.spark, "orders-zstd")
    G.write_layer(order_log(t), path)
    sizes = V.size_reduction(t.spark, order_csv(t), path)
    before, after = F.col("bytes_before"), F.col("bytes_after")
    facts = sizes.select(
        (after > 0).alias("stored"),
        (after < before).alias("smaller"),
        (F.abs(F.col("reduction_pct") - (before - after) * 100.0 / before) <= 0.0051).alias("percent_of_sizes"),
    )
    return plain(facts.withColumn("rows", F.lit(G.read_parquet(t.spark, path).count())))


@query(
    "a07_partition_column_missing",
    "SELECT 'as written' AS source, COUNT(*) AS rows, CAST(1 AS BIGINT) AS refused FROM orders UNION ALL SELECT 'parsed', COUNT(*), 0 FROM orders",
)
def _(t):
    """A log without its timestamp is refused before anything is read; a parsed one is not."""

    def tried(df, source):
        refused = 0
        try:
            df, _ = G.with_partition_columns(df, "timestamp", "day")
        except KeyError:
            refused = 1
        return df.agg(F.count("*").alias("rows")).select(F.lit(source).alias("source"), "rows", F.lit(refused).alias("refused"))

    raw = order_log(t)
    return plain(tried(raw, "as written").unionByName(tried(G.with_timestamp(raw), "parsed")))


_PROFILED = [("l_orderkey", "bigint"), ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_returnflag", "string")]


@query(
    "a21_dataset_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{k}' AS type, COUNT(*) AS rows, COUNT({c}) AS non_null, COUNT(*) - COUNT({c}) AS nulls, "
        f"CAST(MIN({c}) AS VARCHAR) AS min_value, CAST(MAX({c}) AS VARCHAR) AS max_value FROM lineitem"
        for c, k in _PROFILED
    ),
)
def _(t):
    return plain(V.dataset_profile(t.lineitem.select(*[c for c, _ in _PROFILED])))


@query("a21_file_count", "SELECT CAST(1 AS BIGINT) AS files, COUNT(*) AS rows FROM lineitem")
def _(t):
    return plain(V.file_count(t.lineitem))


@query(
    "a22_flow_catalog",
    f"WITH {I.FLOWS}, c AS (SELECT day, label, COUNT(*) AS n FROM flows GROUP BY day, label) SELECT day, {whole('SUM(n)', 'rows')}, "
    "string_agg(label || '=' || n, ',' ORDER BY label) AS distribution, string_agg(label, ',' ORDER BY label) AS classes, CAST(11 AS BIGINT) AS columns FROM c GROUP BY day",
)
def _(t):
    catalog = V.flow_catalog(I.flows(t), "label")
    entries = F.transform(
        F.array_sort(F.map_entries("distribution")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
    )
    return plain(
        catalog.withColumns({"distribution": F.concat_ws(",", entries), "classes": F.concat_ws(",", "classes")})
    )


_SAMPLED = [*_PROFILED, ("l_partkey", "bigint"), ("l_suppkey", "bigint")]


@query(
    "a21_profile_with_sample",
    f"WITH picked AS (SELECT * FROM lineitem ORDER BY md5(concat_ws('|', {', '.join(f'CAST({k} AS VARCHAR)' for k in I.KEY)})), {', '.join(I.KEY)} LIMIT 5) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{k}' AS type, (SELECT COUNT(*) FROM lineitem) AS rows, (SELECT COUNT({c}) FROM lineitem) AS non_null, "
        f"string_agg(CAST({c} AS VARCHAR), ',' ORDER BY CAST({c} AS VARCHAR)) AS sample FROM picked"
        for c, k in _SAMPLED
    ),
)
def _(t):
    rows = t.lineitem.select(*[c for c, _ in _SAMPLED])
    profile = V.profile_with_sample(rows, I.KEY)
    return plain(profile.select("column", "type", "rows", "non_null", F.concat_ws(",", F.array_sort("sample")).alias("sample")))


@query(
    "a22_file_catalog",
    f"WITH {I.FLOWS}, c AS (SELECT day, label, COUNT(*) AS n FROM flows GROUP BY day, label), d AS (SELECT label, SUM(n) AS n FROM c GROUP BY label) "
    f"SELECT 'day=' || day AS file, CAST(1 AS BIGINT) AS files, {whole('SUM(n)', 'rows')}, CAST(11 AS BIGINT) AS columns, "
    "string_agg(label || '=' || n, ',' ORDER BY label) AS distribution, string_agg(label, ',' ORDER BY label) AS classes, CAST(1 AS BIGINT) AS sized FROM c GROUP BY day "
    f"UNION ALL SELECT NULL, (SELECT COUNT(DISTINCT day) FROM c), {whole('SUM(n)', 'rows')}, 11, "
    "string_agg(label || '=' || CAST(n AS BIGINT), ',' ORDER BY label), string_agg(label, ',' ORDER BY label), 1 FROM d",
)
def _(t):
    """One file for each day; sizes are held against each other, as SQL does not know them."""
    path = scratch_path(t.spark, "flow-files")
    G.write_folders(I.flows(t).repartition("day"), path, "day")
    schema = I.flows(t).drop("day").schema
    files = t.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)
    entries = F.transform(
        F.array_sort(F.map_entries("distribution")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
    )
    every = Window.partitionBy()
    of_files = F.sum(F.when(F.col("file").isNotNull(), F.col("bytes"))).over(every)
    sized = F.when(F.col("file").isNull(), F.col("bytes") == of_files).otherwise(F.col("bytes") > 0)
    return plain(
        V.file_catalog(files, "label").select(
            F.regexp_extract("file", "(day=[^/]+)/", 1).alias("file"), "files", "rows", "columns",
            F.concat_ws(",", entries).alias("distribution"), F.concat_ws(",", "classes").alias("classes"), sized.alias("sized"),
        ).withColumn("file", F.when(F.col("file") != "", F.col("file")))
    )
