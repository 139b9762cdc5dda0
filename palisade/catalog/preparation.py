"""Cleaning, clipping, scaling, encoding, sampling and splitting of flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from palisade.catalog import inputs as I
from palisade.catalog.registry import num, plain, query, whole
from palisade.operators import prep
from palisade.operators import profile as P
from palisade.plans import network
from palisade.session import scratch_path

KEYS = "l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber"
COMPLETE = I.FLOWS + ", complete AS (SELECT * FROM flows WHERE isfinite(flow_rate) AND isfinite(tax_rate))"


@query("b15_drop_columns", "SELECT l_orderkey, l_quantity AS quantity FROM lineitem")
def _(t):
    table = t.lineitem.withColumnRenamed("l_quantity", "quantity")
    names = [c for c in table.columns if c not in ("l_orderkey", "quantity")]
    return plain(prep.drop_present(table, [*names, "Flow ID", "Timestamp"]))


@query(
    "b16_benign_and_attacks",
    f"WITH {I.FLOWS} SELECT 'benign' AS part, label, COUNT(*) AS n FROM flows WHERE label = 'BENIGN' GROUP BY label "
    "UNION ALL SELECT 'attack', label, COUNT(*) FROM flows WHERE label <> 'BENIGN' GROUP BY label",
)
def _(t):
    table = I.flows(t)

    def counted(df, part):
        return df.groupBy("label").agg(F.count("*").alias("n")).select(F.lit(part).alias("part"), "label", "n")

    return plain(counted(prep.keep_benign(table), "benign").unionByName(counted(prep.keep_attacks(table), "attack")))


@query(
    "b17_complete_rows",
    f"WITH {COMPLETE} SELECT {KEYS}, {num('flow_rate', 'flow_rate')}, {num('tax_rate', 'tax_rate')} FROM complete",
)
def _(t):
    return plain(prep.complete_rows(I.flows(t), I.FEATURES).select(*I.KEY, "flow_rate", "tax_rate"))


@query(
    "b18_saved_order",
    f"WITH {I.FLOWS} SELECT {KEYS}, {num('tax', 'tax')}, {num('quantity', 'quantity')}, {num('price', 'price')} FROM flows",
)
def _(t):
    return plain(prep.project(I.flows(t), ["tax", "quantity", "price"], I.KEY))


@query(
    "b21_clipped_features",
    f"WITH {I.clipped_sql(I.FEATURES)} SELECT label, feature, COUNT(value) AS n, {num('MIN(value)', 'low', 4)}, {num('MAX(value)', 'high', 4)}, "
    f"{num('AVG(value)', 'mean', 4)} FROM clipped GROUP BY label, feature",
)
def _(t):
    rows = P.clipped_long(I.flows(t), I.FEATURES, ["label"])
    return plain(
        rows.groupBy("label", "feature").agg(
            F.count("value").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"), F.avg("value").alias("mean")
        ),
        4,
    )


@query(
    "b22_rows_within_quantiles",
    f"WITH {I.clipped_sql(I.FEATURES, 0.02, 0.98)} SELECT label, feature, COUNT(*) AS n, {num('AVG(original)', 'mean', 4)} "
    "FROM clipped WHERE original BETWEEN lo AND hi GROUP BY label, feature",
)
def _(t):
    rows = P.within_bounds(I.flows(t), I.FEATURES, ["label"], 0.02, 0.98)
    return plain(rows.groupBy("label", "feature").agg(F.count("*").alias("n"), F.avg("value").alias("mean")), 4)


_FRACTION = "CAST(CAST('0x' || substr(hk, 1, 8) AS BIGINT) AS DOUBLE) / 4294967296"


@query("b26_sample", f"WITH {I.FLOWS} SELECT {KEYS}, label FROM flows WHERE {_FRACTION} < 0.1")
def _(t):
    return plain(prep.sample(I.flows(t), 0.1, I.KEY).select(*I.KEY, "label"))


@query(
    "b27_stratified_sample",
    f"WITH {I.FLOWS}, k AS (SELECT *, row_number() OVER (PARTITION BY day, label ORDER BY hk) AS place, COUNT(*) OVER (PARTITION BY day, label) AS size FROM flows) "
    f"SELECT {KEYS}, day, label FROM k WHERE size * 0.08 < 1 OR place <= round_even(size * 0.08, 0)",
)
def _(t):
    kept = prep.stratified_sample(I.flows(t), 0.08, I.KEY, ["day", "label"])
    return plain(kept.select(*I.KEY, "day", "label"))


# ---- scaling ----------------------------------------------------------------

_ENDS = "ends AS (SELECT " + ", ".join(
    f"MIN({f}) AS {f}_lo, MAX({f}) AS {f}_hi, AVG({f}) AS {f}_m, stddev_pop({f}) AS {f}_s" for f in I.FEATURES
) + " FROM {source})"


def _scaled(features, alias: str = "r") -> str:
    return ", ".join(
        num(f"({alias}.{f} - e.{f}_lo) / CASE WHEN e.{f}_hi = e.{f}_lo THEN 1 ELSE e.{f}_hi - e.{f}_lo END", f, 8)
        for f in features
    )


@query(
    "f01_min_max",
    f"WITH {COMPLETE}, {_ENDS.format(source='complete')} SELECT {KEYS}, {_scaled(I.FEATURES)} FROM complete r, ends e",
)
def _(t):
    clean = prep.project(prep.complete_rows(I.flows(t), I.FEATURES), I.FEATURES, I.KEY)
    return plain(prep.fit_min_max(clean, I.FEATURES).transform(clean), 8)


@query(
    "f02_saved_scaler",
    f"WITH {COMPLETE}, early AS (SELECT * FROM complete WHERE day < 1998), {_ENDS.format(source='early')} "
    f"SELECT {KEYS}, {_scaled(I.FEATURES)} FROM complete r, ends e",
)
def _(t):
    """Fitted on early days, stored, read back and applied to every complete row."""
    table = prep.complete_rows(I.flows(t), I.FEATURES)
    path = scratch_path(t.spark, "scaler")
    prep.fit_min_max(table.where("day < 1998"), I.FEATURES).save(t.spark, path)
    return plain(prep.Scaler.load(t.spark, path).transform(table, I.KEY), 8)


@query(
    "f03_standard_scaling",
    f"WITH {I.FLOWS}, {_ENDS.format(source='flows').replace('FROM flows', 'FROM flows WHERE isfinite(flow_rate) AND isfinite(tax_rate)')} SELECT {KEYS}, "
    + ", ".join(num(f"(r.{f} - e.{f}_m) / e.{f}_s", f) for f in I.FEATURES)
    + " FROM flows r, ends e WHERE isfinite(r.flow_rate) AND isfinite(r.tax_rate)",
)
def _(t):
    clean = prep.project(prep.complete_rows(I.flows(t), I.FEATURES), I.FEATURES, I.KEY)
    return plain(prep.fit_standard(clean, I.FEATURES).transform(clean))


@query(
    "f04_label_encoding",
    f"WITH {I.FLOWS}, m AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS label_id FROM (SELECT DISTINCT label FROM flows) x) "
    "SELECT f.label, m.label_id, f.label AS decoded, COUNT(*) AS n FROM flows f JOIN m ON m.label = f.label GROUP BY 1, 2",
)
def _(t):
    table = I.flows(t)
    mapping = prep.label_map(table)
    coded = prep.encode_labels(table.select("label"), mapping)
    both = prep.decode_labels(coded, mapping, "label_id", "decoded")
    return plain(both.groupBy("label", "label_id", "decoded").agg(F.count("*").alias("n")))


@query(
    "f05_class_weights",
    f"WITH {I.FLOWS}, c AS (SELECT label, COUNT(*) AS n FROM flows GROUP BY label) "
    f"SELECT label, {num('SUM(n) OVER () / (COUNT(*) OVER () * n)', 'weight')} FROM c",
)
def _(t):
    return plain(prep.class_weights(I.flows(t)))


# ---- splits -----------------------------------------------------------------

_PLACED = ", placed AS (SELECT *, row_number() OVER (PARTITION BY {strata} ORDER BY hk) AS place, COUNT(*) OVER (PARTITION BY {strata}) AS size FROM {source})"


def _bands(bounds) -> str:
    *first, (last, _) = bounds
    return "CASE " + " ".join(f"WHEN place <= floor(size * CAST({b} AS DOUBLE) + 0.5) THEN '{n}'" for n, b in first) + f" ELSE '{last}' END AS split"


FOUR = [("train", 0.4), ("test", 0.5), ("val", 0.6), ("production", 1.0)]
FOUR_WAY = I.FLOWS + _PLACED.format(strata="label", source="flows") + f", parts AS (SELECT *, {_bands(FOUR)} FROM placed)"


@query("f06_four_way_split", f"WITH {FOUR_WAY} SELECT {KEYS}, label, split FROM parts")
def _(t):
    parts = prep.split(I.flows(t), network.SPLIT, I.KEY, ["label"])
    return plain(parts.select(*I.KEY, "label", "split"))


BENIGN_BOUNDS = [("production", 0.4), ("train", 0.8002), ("test", 0.9001), ("val", 1.0)]


@query(
    "f07_benign_split",
    f"WITH {I.FLOWS}, benign AS (SELECT * FROM flows WHERE label = 'BENIGN')"
    + _PLACED.format(strata="1", source="benign").replace("PARTITION BY 1 ", "").replace("PARTITION BY 1", "")
    + f" SELECT {KEYS}, {_bands(BENIGN_BOUNDS)} FROM placed",
)
def _(t):
    parts = prep.benign_split(prep.keep_benign(I.flows(t)), I.KEY)
    return plain(parts.select(*I.KEY, "split"))


@query(
    "f08_train_test_split",
    f"WITH {I.FLOWS}{_PLACED.format(strata='label', source='flows')} SELECT {KEYS}, {_bands([('train', 0.8), ('test', 1.0)])} FROM placed",
)
def _(t):
    parts = prep.split(I.flows(t), {"train": 0.8, "test": 0.2}, I.KEY, ["label"])
    return plain(parts.select(*I.KEY, "split"))


def _days(t):
    table = I.flows(t)
    return [table.where("day < 1998"), table.where("day >= 1998")]


@query(
    "f09_benign_features",
    f"WITH {COMPLETE}, benign AS (SELECT * FROM complete WHERE label = 'BENIGN'), {_ENDS.format(source='benign')} "
    f"SELECT label, COUNT(*) AS n, "
    + ", ".join(num(f"AVG((r.{f} - e.{f}_lo) / (e.{f}_hi - e.{f}_lo))", f) for f in I.FEATURES)
    + " FROM benign r, ends e GROUP BY label",
)
def _(t):
    rows, _ = prep.benign_features(_days(t), I.FEATURES)
    return plain(rows.groupBy("label").agg(F.count("*").alias("n"), *[F.avg(f).alias(f) for f in I.FEATURES]))


@query(
    "f10_attack_features",
    f"WITH {COMPLETE}, benign AS (SELECT * FROM complete WHERE label = 'BENIGN'), {_ENDS.format(source='benign')} "
    f"SELECT label, COUNT(*) AS n, "
    + ", ".join(num(f"AVG((r.{f} - e.{f}_lo) / (e.{f}_hi - e.{f}_lo))", f) for f in I.FEATURES)
    + " FROM complete r, ends e WHERE label <> 'BENIGN' GROUP BY label",
)
def _(t):
    _, scaler = prep.benign_features(_days(t), I.FEATURES)
    rows = prep.attack_features(_days(t), scaler)
    return plain(rows.groupBy("label").agg(F.count("*").alias("n"), *[F.avg(f).alias(f) for f in I.FEATURES]))


@query(
    "d44_split_summary",
    f"WITH {FOUR_WAY}, c AS (SELECT split, label, COUNT(*) AS n FROM parts GROUP BY split, label), "
    "k AS (SELECT *, SUM(n) OVER (PARTITION BY split) AS rows, COUNT(*) OVER (PARTITION BY split) AS classes, "
    "SUM(n) OVER () AS total, row_number() OVER (PARTITION BY split ORDER BY n DESC, label) AS place FROM c) "
    f"SELECT split, label, n, {whole('rows', 'split_rows')}, classes, {num('rows * 100.0 / total', 'pct')}, place FROM k WHERE place <= 5",
)
def _(t):
    return plain(prep.split_summary(prep.split(I.flows(t), network.SPLIT, I.KEY, ["label"])))


@query(
    "f18_folds",
    f"WITH {I.FLOWS}, k AS (SELECT label, CAST(least(floor({_FRACTION} * 5), 4) AS BIGINT) AS fold FROM flows) SELECT fold, label, COUNT(*) AS n FROM k GROUP BY fold, label",
)
def _(t):
    return plain(prep.folds(I.flows(t), 5, I.KEY).groupBy("fold", "label").agg(F.count("*").alias("n")))




@query(
    "prepared_flows",
    f"WITH {COMPLETE}{_PLACED.format(strata='label', source='complete')}, parts AS (SELECT *, {_bands(FOUR)} FROM placed), "
    f"train AS (SELECT * FROM parts WHERE split = 'train'), {_ENDS.format(source='train')} "
    f"SELECT {KEYS}, label, split, {_scaled(I.FEATURES)} FROM parts r, ends e",
)
def prepared(t):
    return plain(network.prepare(I.flows(t), I.FEATURES, I.KEY).rows, 8)
