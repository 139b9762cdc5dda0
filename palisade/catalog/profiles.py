"""Profiles of the wide flow table: classes, features, correlation, separation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from palisade.catalog import inputs as I
from palisade.catalog.registry import num, plain, query, whole
from palisade.functions.numeric import finite
from palisade.operators import classes as C
from palisade.operators import correlation as R
from palisade.operators import profile as P
from palisade.operators import ranking as K
from palisade.sources import flows as S

LONG = I.FLOWS + ", " + I.long_sql(I.FEATURES)
CLIPPED = I.clipped_sql(I.FEATURES)

_FAMILY = """CASE WHEN label = 'BENIGN' THEN 'Benign' WHEN label = 'DoS Hulk' THEN 'DoS' WHEN label = 'DDoS' THEN 'DDoS'
  WHEN label = 'PortScan' THEN 'Probe / Scan' ELSE 'Brute Force' END"""

# ---- classes ----------------------------------------------------------------

COUNTS = I.FLOWS + ", counts AS (SELECT label, COUNT(*) AS n FROM flows GROUP BY label)"
DAYS = I.FLOWS + """, seen AS (SELECT label, day, COUNT(*) AS n FROM flows GROUP BY label, day),
grid AS (SELECT l.label, d.day, COALESCE(s.n, 0) AS n FROM (SELECT DISTINCT label FROM flows) l
  CROSS JOIN (SELECT DISTINCT day FROM flows) d LEFT JOIN seen s ON s.label = l.label AND s.day = d.day)"""


@query("d11_class_counts", f"WITH {COUNTS} SELECT label, n, {num('n * 100.0 / SUM(n) OVER ()', 'pct')} FROM counts")
def _(t):
    return plain(C.class_counts(I.flows(t)))


@query(
    "d12_imbalance",
    f"WITH {COUNTS} SELECT label, {_FAMILY} AS family, n, {num('n * 100.0 / SUM(n) OVER ()', 'pct', 4)}, "
    f"{num('MAX(n) OVER () / greatest(n, 1)', 'imbalance_ratio')} FROM counts",
)
def _(t):
    return plain(C.imbalance(I.flows(t)))


@query(
    "d13_class_day_pivot",
    f"WITH {I.FLOWS} SELECT label, COLUMNS(* EXCLUDE (label)) FROM (PIVOT (SELECT label, day FROM flows) ON day USING COUNT(*) GROUP BY label)",
)
def _(t):
    table = I.flows(t)
    return plain(C.class_day_pivot(table, I.days_of(table)))


@query(
    "d14_pivot_by_class_maximum",
    f"WITH {DAYS} SELECT label, day, n, {num('n / MAX(n) OVER (PARTITION BY label)', 'share')} FROM grid",
)
def _(t):
    return plain(C.scaled_by_class(C.class_by_day(I.flows(t))))


@query(
    "d15_pivot_percent_of_day",
    f"WITH {DAYS} SELECT label, day, n, {num('n * 100.0 / SUM(n) OVER (PARTITION BY day)', 'pct')} FROM grid",
)
def _(t):
    return plain(C.percent_by_day(C.class_by_day(I.flows(t))))


@query(
    "d16_attack_share",
    f"WITH {I.FLOWS} SELECT day, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE label = 'BENIGN') AS n_benign, "
    f"COUNT(*) FILTER (WHERE label <> 'BENIGN') AS n_attack, "
    f"{num('COUNT(*) FILTER (WHERE label <> ' + repr('BENIGN') + ') * 100.0 / COUNT(*)', 'attack_pct')} FROM flows GROUP BY day",
)
def _(t):
    return plain(C.attack_share(I.flows(t)))


@query("d17_family_totals", f"WITH {I.FLOWS} SELECT {_FAMILY} AS family, COUNT(*) AS n FROM flows GROUP BY 1")
def _(t):
    return plain(C.family_totals(I.flows(t)))


# ---- features ---------------------------------------------------------------

_STATS = ", ".join(
    [
        "COUNT(value) AS count",
        num("AVG(value)", "mean", 4),
        num("stddev_samp(value)", "std", 4),
        num("MIN(value)", "min", 4),
        num("MAX(value)", "max", 4),
        *[num(f"quantile_cont(value, {p})", n, 4) for n, p in P.SUMMARY.items()],
    ]
)


@query("d18_feature_summary", f"WITH {LONG} SELECT feature, {_STATS} FROM longf GROUP BY feature")
def feature_summary(t):
    return plain(P.feature_summary(I.flows(t), I.FEATURES), 4)


@query("d18_feature_summary_by_class", f"WITH {LONG} SELECT label, feature, {_STATS} FROM longf GROUP BY label, feature")
def _(t):
    return plain(P.feature_summary(I.flows(t), I.FEATURES, ["label"]), 4)


@query(
    "d19_missing_values",
    f"WITH {LONG}, c AS (SELECT feature, COUNT(*) FILTER (WHERE value IS NULL) AS missing, COUNT(*) AS n FROM longf GROUP BY feature) "
    f"SELECT feature, missing, {num('missing * 100.0 / n', 'pct')} FROM c WHERE missing > 0",
)
def _(t):
    return plain(P.missing_features(I.flows(t), I.FEATURES))


@query(
    "d20_infinite_values",
    f"WITH {LONG}, c AS (SELECT feature, COUNT(*) FILTER (WHERE isinf(raw)) AS infinite, COUNT(*) AS n FROM longf GROUP BY feature) "
    f"SELECT feature, infinite, {num('infinite * 100.0 / n', 'pct')} FROM c WHERE infinite > 0",
)
def _(t):
    return plain(P.infinite_features(I.flows(t), I.FEATURES))


@query(
    "d21_zero_share",
    f"WITH {LONG} SELECT feature, {num('AVG(CASE WHEN value IS NULL THEN NULL WHEN value = 0 THEN 1 ELSE 0 END) * 100', 'zero_pct')} FROM longf GROUP BY feature",
)
def _(t):
    return plain(P.zero_share(I.flows(t), I.FEATURES))


@query(
    "d22_null_map",
    f"WITH {LONG} SELECT feature, CAST(bool_or(value IS NULL) AS BIGINT) AS has_missing FROM longf GROUP BY feature",
)
def _(t):
    return plain(P.null_map(I.flows(t), I.FEATURES, rows=None))


@query(
    "d22_null_map_of_sample",
    f"WITH {I.FLOWS}, picked AS (SELECT * FROM flows ORDER BY hk, l_orderkey, l_partkey, l_suppkey, l_linenumber LIMIT 5000), "
    + I.long_sql(I.FEATURES, "longs", "picked")
    + " SELECT feature, CAST(bool_or(value IS NULL) AS BIGINT) AS has_missing FROM longs GROUP BY feature",
)
def _(t):
    return plain(P.null_map(I.flows(t), I.FEATURES, key=I.KEY))


@query("d23_variance", f"WITH {LONG} SELECT feature, {num('var_samp(value)', 'variance', 2)} FROM longf GROUP BY feature")
def _(t):
    return plain(P.variances(I.flows(t), I.FEATURES), 2)


def _pairs(names):
    return [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]


def _finite(name: str) -> str:
    return f"CASE WHEN isfinite({name}) THEN {name} END"


PAIRS = I.FLOWS + ", pairs AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({_finite(a)}, {_finite(b)}) AS r FROM flows"
    for a, b in _pairs(I.FEATURES)
) + ")"


@query("d24_correlation", f"WITH {PAIRS} SELECT feature_a, feature_b, {num('r', 'r')} FROM pairs")
def _(t):
    return plain(R.pearson(I.flows(t), I.FEATURES))


@query("d24_correlation_blocks", f"WITH {PAIRS} SELECT feature_a, feature_b, {num('r', 'r')} FROM pairs")
def _(t):
    return plain(R.pearson(I.flows(t), I.FEATURES))


LIMIT = 0.3


@query(
    "d25_strong_pairs",
    f"WITH {PAIRS} SELECT feature_a, feature_b, {num('r', 'pearson_r')}, {num('abs(r)', 'abs_r')} FROM pairs WHERE abs(r) >= {LIMIT}",
)
def _(t):
    return plain(R.strong_pairs(R.pearson(I.flows(t), I.FEATURES), LIMIT))


@query(
    "d26_strong_share",
    f"WITH {PAIRS} SELECT COUNT(r) AS pairs, {num(f'AVG(CASE WHEN abs(r) >= {LIMIT} THEN 1 ELSE 0 END) * 100', 'pct_strong')} FROM pairs WHERE r IS NOT NULL",
)
def _(t):
    return plain(R.strong_share(R.pearson(I.flows(t), I.FEATURES), LIMIT))


def _bin_sql(value: str, low: str, high: str, bins: int) -> str:
    return (
        f"CASE WHEN {low} = {high} THEN 1 ELSE least(CAST(floor(({value} - {low}) / (({high} - {low}) / {bins})) AS BIGINT) + 1, {bins}) END"
    )


def _bucket_sql(value: str, low: str, high: str, bins: int) -> str:
    """Bins as width_bucket counts them: many rates lie exactly on a bound."""
    return f"CASE WHEN {low} = {high} THEN 1 ELSE least(CAST(floor({bins} * ({value} - {low}) / ({high} - {low})) AS BIGINT) + 1, {bins}) END"


@query(
    "d26_correlation_histogram",
    f"WITH {PAIRS}, a AS (SELECT 'abs_r' AS feature, abs(r) AS value FROM pairs WHERE r IS NOT NULL), "
    f"s AS (SELECT MIN(value) AS lo, MAX(value) AS hi FROM a), b AS (SELECT {_bin_sql('value', 'lo', 'hi', 80)} AS bin FROM a, s) "
    "SELECT CAST(bin AS BIGINT) AS bin, COUNT(*) AS n FROM b GROUP BY 1",
)
def _(t):
    pairs = R.pearson(I.flows(t), I.FEATURES)
    rows = pairs.select(F.lit("abs_r").alias("feature"), F.abs("r").alias("value"))
    return plain(P.histogram(rows, 80).select("bin", "n"))


@query(
    "d27_redundant_features",
    f"WITH {PAIRS} SELECT DISTINCT feature_b AS feature FROM pairs WHERE abs(r) >= {LIMIT}",
)
def _(t):
    return plain(R.redundant_features(R.pearson(I.flows(t), I.FEATURES), LIMIT))


# ---- class profiles ---------------------------------------------------------

MEDIANS = CLIPPED + ", med AS (SELECT label, feature, median(value) AS m FROM clipped GROUP BY label, feature)"
_SEPARATION = """, sep AS (SELECT a.label AS attack, a.feature, abs(a.m - b.m) / (abs(b.m) + 1e-9) AS delta, a.m AS am, b.m AS bm
  FROM med a JOIN med b ON b.feature = a.feature AND b.label = 'BENIGN' WHERE a.label <> 'BENIGN')"""


@query("d28_class_medians", f"WITH {MEDIANS} SELECT label, feature, {num('m', 'median', 4)} FROM med")
def _(t):
    return plain(C.class_medians(I.flows(t), I.FEATURES), 4)


@query("d28_class_medians_by_ranks", f"WITH {MEDIANS} SELECT label, feature, {num('m', 'median', 4)} FROM med")
def _(t):
    return plain(C.class_medians(I.flows(t), I.FEATURES, method="ranks"), 4)


@query(
    "d29_scaled_medians",
    f"WITH {MEDIANS}, g AS (SELECT feature, MIN(value) AS lo, MAX(value) AS hi FROM clipped GROUP BY feature) "
    f"SELECT m.label, m.feature, {num('m.m', 'median', 4)}, {num('(m.m - g.lo) / CASE WHEN g.hi = g.lo THEN 1 ELSE g.hi - g.lo END', 'scaled')} "
    "FROM med m JOIN g ON g.feature = m.feature",
)
def _(t):
    return plain(C.scaled_medians(I.flows(t), I.FEATURES), median=4)


@query(
    "d30_separation",
    f"WITH {MEDIANS}{_SEPARATION} SELECT attack, feature, {num('delta', 'abs_delta')}, {num('am', 'attack_median', 4)}, {num('bm', 'benign_median', 4)} FROM sep",
)
def _(t):
    return plain(C.separation(C.class_medians(I.flows(t), I.FEATURES)), attack_median=4, benign_median=4)


GROUPS = {"Amounts": ["quantity", "price"], "Charges": ["discount", "tax"], "Rates": ["flow_rate", "tax_rate"]}


@query(
    "d31_family_medians",
    f"WITH {LONG}, med AS (SELECT label, feature, median(value) AS m FROM longf GROUP BY label, feature), "
    "fam AS (SELECT label, CASE WHEN feature IN ('quantity', 'price') THEN 'Amounts' WHEN feature IN ('discount', 'tax') THEN 'Charges' ELSE 'Rates' END AS family, "
    "median(m) AS mm FROM med GROUP BY 1, 2) "
    f"SELECT label, family, {num('mm', 'median', 4)}, {num('(mm - MIN(mm) OVER w) / (MAX(mm) OVER w - MIN(mm) OVER w + 1e-9)', 'scaled')} FROM fam WINDOW w AS (PARTITION BY family)",
)
def _(t):
    return plain(C.family_medians(I.flows(t), GROUPS), median=4)


_M = "AVG(value) OVER (PARTITION BY feature)"


@query(
    "d32_skew_kurtosis",
    f"WITH {CLIPPED}, c AS (SELECT feature, value - {_M} AS x FROM clipped WHERE value IS NOT NULL), "
    "m AS (SELECT feature, AVG(x * x) AS m2, AVG(x * x * x) AS m3, AVG(x * x * x * x) AS m4 FROM c GROUP BY feature) "
    f"SELECT feature, {num('m3 / pow(m2, 1.5)', 'skew')}, {num('m4 / (m2 * m2) - 3', 'kurtosis')} FROM m",
)
def _(t):
    return plain(P.shape(I.flows(t), I.FEATURES))


@query(
    "d33_histogram",
    f"WITH {LONG}, s AS (SELECT feature, MIN(value) AS lo, MAX(value) AS hi FROM longf GROUP BY feature), "
    f"b AS (SELECT l.feature, {_bucket_sql('l.value', 's.lo', 's.hi', 50)} AS bin FROM longf l JOIN s ON s.feature = l.feature WHERE l.value IS NOT NULL) "
    "SELECT feature, CAST(bin AS BIGINT) AS bin, COUNT(*) AS n FROM b GROUP BY 1, 2",
)
def _(t):
    rows = P.long_form(I.flows(t), I.FEATURES).withColumn("value", finite("value"))
    return plain(P.histogram(rows, 50).select("feature", "bin", "n"))


@query(
    "d34_box_statistics",
    f"WITH {CLIPPED}, kept AS (SELECT label, feature, original AS value FROM clipped WHERE original BETWEEN lo AND hi), "
    "q AS (SELECT label, feature, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.5) AS b, quantile_cont(value, 0.75) AS c FROM kept GROUP BY label, feature), "
    "w AS (SELECT k.label, k.feature, MIN(k.value) FILTER (WHERE k.value BETWEEN q.a - 1.5 * (q.c - q.a) AND q.c + 1.5 * (q.c - q.a)) AS lo, "
    "MAX(k.value) FILTER (WHERE k.value BETWEEN q.a - 1.5 * (q.c - q.a) AND q.c + 1.5 * (q.c - q.a)) AS hi, "
    "COUNT(*) FILTER (WHERE NOT (k.value BETWEEN q.a - 1.5 * (q.c - q.a) AND q.c + 1.5 * (q.c - q.a))) AS outliers "
    "FROM kept k JOIN q ON q.label = k.label AND q.feature = k.feature GROUP BY k.label, k.feature) "
    f"SELECT q.label, q.feature, {num('q.a', 'p25', 4)}, {num('q.b', 'p50', 4)}, {num('q.c', 'p75', 4)}, {num('w.lo', 'whisker_low', 4)}, "
    f"{num('w.hi', 'whisker_high', 4)}, w.outliers FROM q JOIN w ON w.label = q.label AND w.feature = q.feature",
)
def _(t):
    return plain(P.box_statistics(I.flows(t), I.FEATURES, "label"), 4)


_BIN = _bin_sql("l.value", "s.lo", "s.hi", 512)


@query(
    "d35_density",
    f"WITH {CLIPPED}, l AS (SELECT feature, value FROM clipped WHERE value IS NOT NULL), "
    "s AS (SELECT feature, MIN(value) AS lo, MAX(value) AS hi, COUNT(*) AS n, stddev_samp(value) * pow(COUNT(*), -0.2) AS h FROM l GROUP BY feature), "
    f"c AS (SELECT l.feature, {_BIN} AS bin, COUNT(*) AS k FROM l JOIN s ON s.feature = l.feature GROUP BY 1, 2), p AS (SELECT unnest(range(200)) AS point), "
    "x AS (SELECT s.feature, p.point, s.lo + (s.hi - s.lo) * p.point / 199 AS x, s.n, s.h, s.lo + (c.bin - 0.5) * (s.hi - s.lo) / 512 AS centre, c.k "
    "FROM p, s JOIN c ON c.feature = s.feature) "
    f"SELECT feature, point, {num('x', 'x', 4)}, {num('SUM(k * exp(-(x - centre) * (x - centre) / (h * h) / 2)) / (n * h * sqrt(2 * pi())) * 1e6', 'density', 3)} "
    "FROM x GROUP BY feature, point, x, n, h",
)
def _(t):
    rows = P.clipped_long(I.flows(t), I.FEATURES)
    return plain(P.density(rows).withColumn("density", F.col("density") * 1e6), x=4, density=3)


# ---- tables -----------------------------------------------------------------


@query(
    "d36_duplicate_rows",
    "SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicates FROM (SELECT COUNT(*) AS n FROM events GROUP BY user_id, event_type, CAST(ts AS DATE))",
)
def _(t):
    rows = t.events.select("user_id", "event_type", F.to_date("ts").alias("date"))
    return plain(P.duplicate_rows(rows))


@query(
    "d37_column_counts",
    "WITH e AS (SELECT e.event_id, e.user_id, e.event_type, l.quality, l.toxic FROM events e LEFT JOIN labels l ON l.doc_id = e.event_id) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT(DISTINCT {c}) AS \"distinct\", {num(f'AVG(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)', 'missing_ratio')} FROM e"
        for c in ("event_id", "user_id", "event_type", "quality", "toxic")
    ),
)
def _(t):
    labels = t.labels.withColumnRenamed("doc_id", "event_id")
    rows = t.events.select("event_id", "user_id", "event_type").join(labels, "event_id", "left")
    return plain(P.column_counts(rows))


@query(
    "d38_rows_per_user",
    "WITH c AS (SELECT COUNT(*) AS value FROM events GROUP BY user_id) SELECT COUNT(*) AS count, "
    + ", ".join(
        [num("AVG(value)", "mean"), num("stddev_samp(value)", "std"), num("MIN(value)", "min"), num("MAX(value)", "max")]
        + [num(f"quantile_cont(value, {p})", n) for n, p in P.QUARTILES.items()]
    )
    + " FROM c",
)
def _(t):
    return plain(P.rows_per_key(t.events, "user_id"))


# ---- order, union, distinct -------------------------------------------------


@query(
    "e03_truncated_rank",
    "WITH c AS (SELECT user_id, COUNT(*) AS n FROM events GROUP BY user_id), "
    "k AS (SELECT user_id, n, rank() OVER (ORDER BY n DESC) AS first, COUNT(*) OVER (PARTITION BY n) AS ties FROM c) "
    "SELECT user_id, n, CAST(floor(first + (ties - 1) / 2.0) AS BIGINT) AS rank FROM k",
)
def _(t):
    counts = t.events.groupBy("user_id").agg(F.count("*").alias("n"))
    return plain(C.truncated_rank(counts, "n"))


@query(
    "e04_top_features_per_attack",
    f"WITH {MEDIANS}{_SEPARATION}, k AS (SELECT *, row_number() OVER (PARTITION BY attack ORDER BY round(delta, 9) DESC, feature) AS place FROM sep) "
    f"SELECT attack, feature, {num('delta', 'abs_delta')}, place FROM k WHERE place <= 3",
)
def _(t):
    ranked = C.separation(C.class_medians(I.flows(t), I.FEATURES))
    top = C.top_per_group(ranked, ["attack"], [F.desc(F.round("abs_delta", 9)), F.col("feature")], 3)
    return plain(top.select("attack", "feature", "abs_delta", "place"))


@query(
    "e09_top_variance",
    f"WITH {LONG} SELECT feature, {num('var_samp(value)', 'variance', 2)} FROM longf GROUP BY feature ORDER BY var_samp(value) DESC LIMIT 3",
)
def _(t):
    return plain(P.variances(I.flows(t), I.FEATURES).orderBy(F.desc("variance")).limit(3), 2)


@query(
    "e11_mixed_order",
    f"WITH {MEDIANS}{_SEPARATION} SELECT attack, feature, {num('delta', 'abs_delta')} FROM sep ORDER BY attack, delta DESC",
)
def _(t):
    ranked = C.separation(C.class_medians(I.flows(t), I.FEATURES))
    return plain(ranked.select("attack", "feature", "abs_delta"))


@query(
    "e12_union_days",
    f"WITH {I.FLOWS} SELECT CAST(day AS VARCHAR) AS tag, COUNT(*) AS n, {num('SUM(quantity)', 'quantity', 2)} FROM flows GROUP BY 1",
)
def _(t):
    table = I.flows(t)
    days = {
        str(d): table.where(F.col("day").eqNullSafe(F.lit(d))).drop("day").withColumnRenamed("quantity", " quantity ")
        for d in I.days_of(table)
    }
    return plain(
        S.union_days(days, "tag").groupBy("tag").agg(F.count("*").alias("n"), F.sum("quantity").alias("quantity")), 2
    )


@query("e13_distinct_classes", f"WITH {I.FLOWS} SELECT DISTINCT day, label FROM flows")
def _(t):
    return plain(I.flows(t).select("day", "label").distinct())


# ---- feature ranking --------------------------------------------------------

MI = LONG + """, cuts AS (SELECT feature, quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM longf GROUP BY feature),
cells AS (SELECT l.feature, l.label, len(list_filter(c.q, lambda x: x < l.value)) AS bin, COUNT(*) AS n
  FROM longf l JOIN cuts c ON c.feature = l.feature WHERE l.value IS NOT NULL GROUP BY 1, 2, 3),
tot AS (SELECT *, SUM(n) OVER (PARTITION BY feature) AS t, SUM(n) OVER (PARTITION BY feature, bin) AS b, SUM(n) OVER (PARTITION BY feature, label) AS c FROM cells)"""


@query(
    "f19_mutual_information",
    f"WITH {MI} SELECT feature, {num('SUM(n / t * ln(n * t / (b * c)))', 'mi', 8)} FROM tot GROUP BY feature",
)
def _(t):
    return plain(K.mutual_information(I.flows(t), I.FEATURES), 8)


@query("f20_forest_importance", f"SELECT unnest({I.FEATURES}) AS feature, CAST(1 AS BIGINT) AS valid, 1.0::DOUBLE AS total")
def _(t):
    """A forest has no closed form: shares lie between 0 and 1 and add up to 1."""
    shares = K.forest_importance(I.flows(t), I.FEATURES)
    total = F.sum("importance").over(Window.partitionBy())
    return plain(shares.select("feature", F.col("importance").between(0, 1).alias("valid"), total.alias("total")))


@query(
    "f21_combined_ranking",
    f"WITH {MI}, m AS (SELECT feature, SUM(n / t * ln(n * t / (b * c))) AS mi FROM tot GROUP BY feature), "
    "v AS (SELECT feature, var_samp(value) AS s FROM longf GROUP BY feature), "
    "j AS (SELECT m.feature, mi, (s - MIN(s) OVER ()) / (MAX(s) OVER () - MIN(s) OVER () + 1e-9) AS vn, "
    "(mi - MIN(mi) OVER ()) / (MAX(mi) OVER () - MIN(mi) OVER () + 1e-9) AS mn FROM m JOIN v ON v.feature = m.feature) "
    f"SELECT feature, {num('vn', 'variance_norm')}, {num('mn', 'mi_norm')}, CAST(1 AS BIGINT) AS combined, CAST(1 AS BIGINT) AS ranked FROM j",
)
def _(t):
    """The forest's share has no closed form; score and rank are held against their definitions."""
    table = I.flows(t)
    mi = K.mutual_information(table, I.FEATURES)
    ranked = K.combined_ranking(table, I.FEATURES, mi, K.forest_importance(table, I.FEATURES))
    every = Window.partitionBy()
    above = F.size(F.filter(F.collect_list("combined").over(every), lambda x: x > F.col("combined")))
    ties = F.size(F.filter(F.collect_list("combined").over(every), lambda x: x == F.col("combined")))
    return plain(
        ranked.select(
            "feature", "variance_norm", "mi_norm",
            (F.abs(F.col("combined") - F.sqrt(F.col("mi_norm") * F.col("rf_norm"))) < 1e-9).alias("score"),
            (F.col("combined_rank") == F.floor(above + (ties + 1) / 2)).alias("ranked"),
        ).withColumnRenamed("score", "combined")
    )


@query(
    "f21_normalised_scores",
    f"WITH {LONG}, v AS (SELECT feature, var_samp(value) AS s FROM longf GROUP BY feature) "
    f"SELECT feature, {num('(s - MIN(s) OVER ()) / (MAX(s) OVER () - MIN(s) OVER () + 1e-9)', 'score', 9)} FROM v",
)
def _(t):
    scores = P.scaled_share(P.variances(I.flows(t), I.FEATURES), "variance", [], "score", pad=1e-9)
    return plain(scores.select("feature", "score"), 9)


@query(
    "f22_training_accuracy",
    f"WITH {I.FLOWS} SELECT COUNT(*) AS rows, CAST(1 AS BIGINT) AS above_chance FROM flows WHERE "
    + " AND ".join(f"isfinite({f})" for f in I.FEATURES),
)
def _(t):
    """Rows used, and whether the mean recall of the classes is above that of a guess."""
    model, prepared = K.forest(I.flows(t), I.FEATURES)
    hit = (F.col("prediction") == F.col("target")).cast("int")
    classes = model.transform(prepared).groupBy("target").agg(F.count("*").alias("n"), F.avg(hit).alias("recall"))
    return plain(classes.agg(F.sum("n").alias("rows"), (F.avg("recall") > 1.0 / F.count("*")).alias("above_chance")))
