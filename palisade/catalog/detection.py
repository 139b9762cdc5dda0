"""Reconstruction scores, thresholds, classification and detection quality."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from palisade.catalog import inputs as I
from palisade.catalog.registry import num, plain, query, whole
from palisade.functions.flows import action_text, is_anomalous
from palisade.operators import evaluation as E
from palisade.operators import models as M
from palisade.operators import prep
from palisade.operators import profile as P
from palisade.plans import network
from palisade.operators.quality import gate_results, overall_gate

LIMIT = I.THRESHOLD


def scored(t):
    """Vectors with an 8-wide code and error of the fixed-weight reconstruction."""
    rows = I.vectors(t)
    benign = rows.where("true_label = 'BENIGN'")
    return M.block_reconstruction(benign, "embedding", I.DIMENSIONS).score(rows, "embedding")


@query("f11_reconstruction_error", f"WITH {I.SCORES} SELECT vec_id, true_label, {num('mse', 'mse_error', 8)} FROM scored")
def _(t):
    return plain(scored(t).select("vec_id", "true_label", "mse_error"), 8)


@query(
    "f11_codes",
    f"WITH {I.SCORES} SELECT vec_id, CAST(b AS BIGINT) AS position, {num('m', 'code')} FROM codes",
)
def _(t):
    return plain(scored(t).select("vec_id", F.posexplode("code").alias("position", "code")))


@query(
    "f12_fitted_reconstruction",
    f"WITH {I.SCORES} SELECT true_label, COUNT(*) AS n, CAST(1 AS BIGINT) AS valid, "
    "CASE WHEN true_label = 'BENIGN' THEN CAST(1 AS BIGINT) END AS below_fixed_code FROM scored GROUP BY true_label",
)
def _(t):
    """The fitted code has no closed form, but no linear code of its width fits the benign
    rows better, so their mean error lies below that of the fixed one."""
    rows = I.vectors(t)
    benign = F.col("true_label") == "BENIGN"
    fitted = M.fit_reconstruction(rows.where(benign), "embedding").score(rows, "embedding", error="fitted")
    both = M.block_reconstruction(rows.where(benign), "embedding", I.DIMENSIONS).score(fitted, "embedding", "fixed_code")
    return plain(
        both.groupBy("true_label").agg(
            F.count("*").alias("n"),
            F.bool_and(F.col("fitted") >= 0).alias("valid"),
            F.when(F.first(benign), F.avg("fitted") < F.avg("mse_error")).alias("below_fixed_code"),
        )
    )


@query(
    "b28_threshold_action",
    f"WITH {I.SCORES} SELECT vec_id, CAST(mse >= {LIMIT} AS BIGINT) AS is_anomalous, "
    f"CASE WHEN mse >= {LIMIT} THEN 'ATTACK: ' || true_label ELSE 'BENIGN - Passed' END AS action FROM scored",
)
def _(t):
    return plain(
        scored(t).select(
            "vec_id",
            is_anomalous("mse_error", LIMIT).alias("is_anomalous"),
            action_text("mse_error", LIMIT, "true_label").alias("action"),
        )
    )


@query(
    "b31_first_rows_of_label",
    "SELECT vec_id FROM embeddings WHERE label = 7 ORDER BY vec_id LIMIT 5000",
)
def _(t):
    return plain(M.first_of_label(I.vectors(t), "true_label", "class_7", "vec_id", 5000).select("vec_id"))


@query(
    "d39_error_summary",
    f"WITH {I.SCORES} SELECT true_label, COUNT(*) AS n, {num('AVG(mse)', 'mean', 8)}, {num('stddev_pop(mse)', 'std', 8)}, "
    + ", ".join(num(f"quantile_cont(mse, {p})", n, 8) for n, p in P.ERROR_SUMMARY.items())
    + " FROM scored GROUP BY true_label",
)
def _(t):
    return plain(P.error_summary(scored(t), "mse_error", ["true_label"]), 8)


@query(
    "f16_thresholds",
    f"WITH {I.SCORES} SELECT "
    + ", ".join(num(f"quantile_cont(mse, {p})", n, 8) for n, p in list(P.ERROR_SUMMARY.items())[1:])
    + " FROM scored WHERE true_label = 'BENIGN'",
)
def _(t):
    return plain(E.thresholds(scored(t).where("true_label = 'BENIGN'"), "mse_error", "ranks"), 8)


# ---- classification ---------------------------------------------------------

_NAMED = ", named AS (SELECT s.vec_id, s.true_label, s.mse, b.confidence, b.predicted_id, COALESCE(a.name, 'Class_' || b.predicted_id) AS predicted FROM scored s JOIN best b ON b.vec_id = s.vec_id LEFT JOIN attack_names a ON a.label_id = b.predicted_id)"
NAMED = I.SCORES + _NAMED


def by_code(t):
    """Classifier reading the code as class scores: argmax, confidence, name."""
    names = prep.label_map(I.vectors(t).where("true_label <> 'BENIGN'"), "true_label")
    return lambda df: M.classify_scores(df, "code", names)


@query(
    "f14_classification",
    f"WITH {NAMED} SELECT vec_id, {whole('predicted_id', 'predicted_id')}, predicted AS predicted_label, {num('confidence', 'confidence')} FROM named",
)
def _(t):
    return plain(by_code(t)(scored(t)).select("vec_id", "predicted_id", "predicted_label", "confidence"))


def detections(t):
    rows = I.vectors(t)
    model = M.block_reconstruction(rows.where("true_label = 'BENIGN'"), "embedding", I.DIMENSIONS)
    names = prep.label_map(rows.where("true_label <> 'BENIGN'"), "true_label")
    return M.detect_vectors(rows, "embedding", model, LIMIT, M.best_score, names, "vec_id")


DETECTED = NAMED + f""", detected AS (SELECT vec_id, true_label, mse, mse >= {LIMIT} AS hot,
  CASE WHEN mse >= {LIMIT} THEN predicted END AS predicted_label, CASE WHEN mse >= {LIMIT} THEN confidence END AS confidence,
  CASE WHEN mse >= {LIMIT} THEN 'ATTACK: ' || predicted ELSE 'BENIGN - Passed' END AS action FROM named)"""


@query(
    "f15_two_stage_detector",
    f"WITH {DETECTED} SELECT vec_id, true_label, {num('mse', 'mse_error', 8)}, CAST(hot AS BIGINT) AS is_anomalous, predicted_label, "
    f"{num('confidence', 'confidence')}, action FROM detected",
)
def detector(t):
    return plain(detections(t), mse_error=8)


@query(
    "f15_fitted_detector",
    f"WITH {I.SCORES}, b AS (SELECT COUNT(*) AS n FROM scored WHERE true_label = 'BENIGN') "
    "SELECT CASE WHEN true_label = 'BENIGN' THEN 'benign' ELSE 'attack' END AS kind, COUNT(*) AS rows, "
    "CASE WHEN true_label = 'BENIGN' THEN CAST(MAX(b.n - 1 - floor((b.n - 1) * 0.95)) AS BIGINT) END AS flagged, CAST(1 AS BIGINT) AS consistent "
    "FROM scored, b GROUP BY 1, true_label = 'BENIGN'",
)
def _(t):
    """What holds of any fitted detector: benign rows above their own p95 are flagged, and a
    row is named if and only if it is anomalous."""
    rows = I.vectors(t)
    model = network.fit_detector(
        rows.where("true_label = 'BENIGN'"), rows.where("true_label <> 'BENIGN'"), "embedding", "true_label"
    )
    found = model.detect(rows, "embedding", "vec_id")
    hot, named = F.col("is_anomalous"), F.col("predicted_label")
    fits = (
        (hot == (F.col("mse_error") >= model.threshold))
        & (named.isNotNull() == hot)
        & (F.col("confidence").between(0, 1) | ~hot)
        & (F.col("action") == F.when(hot, F.concat(F.lit("ATTACK: "), named)).otherwise("BENIGN - Passed"))
    )
    kind = F.when(F.col("true_label") == "BENIGN", "benign").otherwise("attack").alias("kind")
    return plain(
        found.groupBy(kind).agg(
            F.count("*").alias("rows"),
            F.when(F.first(F.col("true_label") == "BENIGN"), F.count_if(hot)).alias("flagged"),
            F.bool_and(fits).alias("consistent"),
        )
    )


@query(
    "f13_attack_classifier",
    f"WITH {I.SCORES} SELECT true_label AS class, COUNT(*) - CAST(floor(COUNT(*) * 0.8 + 0.5) AS BIGINT) AS support, CAST(1 AS BIGINT) AS valid "
    "FROM scored WHERE true_label <> 'BENIGN' GROUP BY true_label",
)
def _(t):
    """Held-out rows of each class; every one is given a class, and the shares are shares.
    (The classes of the stored vectors cannot be told apart, so accuracy says nothing.)"""
    rows = scored(t)
    attacks = prep.split(rows.where("true_label <> 'BENIGN'"), {"train": 0.8, "test": 0.2}, ["vec_id"], ["true_label"])
    model = M.fit_classifier(attacks.where("split = 'train'"), "code", "true_label")
    tested = model.classify(attacks.where("split = 'test'"))
    quality = E.class_quality(tested, "true_label", "predicted_label")
    every = Window.partitionBy()
    shares = F.array(*[F.col(c).between(0, 1) for c in ("precision", "recall", "f1", "accuracy")])
    valid = F.forall(shares, lambda x: x) & (F.sum("predicted").over(every) == F.sum("support").over(every))
    return plain(quality.select("class", "support", valid.alias("valid")))


_FOLDED = I.SCORES + """, folded AS (SELECT s.*, CAST(least(floor(CAST(CAST('0x' || substr(md5(CAST(s.vec_id AS VARCHAR)), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296 * 3), 2) AS BIGINT) AS fold FROM scored s)"""


@query(
    "f18_centroid_validation",
    f"WITH {_FOLDED}, att AS (SELECT f.fold, f.true_label, f.vec_id, c.b, c.m FROM folded f JOIN codes c ON c.vec_id = f.vec_id WHERE true_label <> 'BENIGN'), "
    "cen AS (SELECT k.fold AS out, a.true_label AS class, a.b, AVG(a.m) AS c FROM att a JOIN (SELECT DISTINCT fold FROM att) k ON k.fold <> a.fold GROUP BY 1, 2, 3), "
    "d AS (SELECT a.fold, a.vec_id, a.true_label, c.class, SUM((c.c - a.m) * (c.c - a.m)) AS d FROM att a JOIN cen c ON c.out = a.fold AND c.b = a.b GROUP BY ALL), "
    "p AS (SELECT fold, vec_id, true_label, arg_min(class, (d, class)) AS predicted FROM d GROUP BY ALL), "
    "h AS (SELECT fold, true_label, COUNT(*) AS n, COUNT(*) FILTER (WHERE predicted = true_label) AS hit FROM p GROUP BY ALL) "
    f"SELECT fold, {whole('SUM(n)', 'rows')}, {num('SUM(hit) / SUM(n)', 'accuracy')}, {num('AVG(hit / n)', 'mean_recall')} FROM h GROUP BY fold",
)
def _(t):
    attacks = prep.folds(scored(t), 3, ["vec_id"]).where("true_label <> 'BENIGN'")
    return plain(E.centroid_validation(attacks, "code", "true_label", "fold", M.CODE_WIDTH))


@query(
    "f18_forest_validation",
    f"WITH {_FOLDED} SELECT fold, COUNT(*) AS rows, CAST(1 AS BIGINT) AS valid FROM folded WHERE true_label <> 'BENIGN' GROUP BY fold",
)
def _(t):
    """The forest fitted without each fold; rows tried in it."""
    attacks = prep.folds(scored(t), 3, ["vec_id"]).where("true_label <> 'BENIGN'")
    tried = M.validate_classifier(attacks, "code", "true_label", "fold")
    return plain(tried.select("fold", "rows", F.col("accuracy").between(0, 1).alias("valid")))


@query(
    "f18_cross_validation",
    f"WITH {_FOLDED}, k AS (SELECT DISTINCT fold AS out FROM folded), "
    "l AS (SELECT out, quantile_cont(mse, 0.95) AS threshold FROM folded JOIN k ON out <> fold WHERE true_label = 'BENIGN' GROUP BY out) "
    f"SELECT fold, {num('threshold', 'threshold', 8)}, {num('AVG(CASE WHEN mse >= threshold THEN 1 ELSE 0 END) FILTER (WHERE true_label = ' + repr('BENIGN') + ')', 'false_positive_rate')}, "
    f"{num('AVG(CASE WHEN mse < threshold THEN 1 ELSE 0 END) FILTER (WHERE true_label <> ' + repr('BENIGN') + ')', 'false_negative_rate')} "
    "FROM folded JOIN l ON out = fold GROUP BY fold, threshold",
)
def _(t):
    rows = prep.folds(scored(t), 3, ["vec_id"])
    parts = []
    for fold in range(3):
        train, test = rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)
        limit = E.thresholds(train.where("true_label = 'BENIGN'"), "mse_error").first()["p95"]
        flagged = test.withColumn("hot", is_anomalous("mse_error", limit))
        rates = E.error_rates(flagged, "true_label", "hot", "BENIGN")
        parts.append(rates.withColumns({"fold": F.lit(fold), "threshold": F.lit(limit)}))
    return plain(parts[0].unionByName(parts[1]).unionByName(parts[2]), threshold=8)


@query(
    "e05_first_trigger",
    f"WITH {DETECTED} SELECT vec_id, {num('mse', 'mse_error', 8)}, predicted_label, {num('confidence', 'confidence')} FROM detected WHERE hot ORDER BY vec_id LIMIT 1",
)
def _(t):
    first = M.first_trigger(detections(t), "vec_id")
    return plain(first.select("vec_id", "mse_error", "predicted_label", "confidence"), mse_error=8)


@query(
    "d42_detection_totals",
    f"WITH {DETECTED} SELECT COUNT(*) AS total_samples, COUNT(*) FILTER (WHERE NOT hot) AS benign_count, COUNT(*) FILTER (WHERE hot) AS anomalous_count, "
    "COUNT(predicted_label) AS malicious_count, CAST(bool_or(hot) AS BIGINT) AS triggered FROM detected",
)
def _(t):
    return plain(M.detection_totals(detections(t)))


# ---- quality ----------------------------------------------------------------

CLASSES = NAMED + """, cls AS (SELECT DISTINCT true_label AS c FROM named UNION SELECT DISTINCT predicted FROM named),
qual AS (SELECT c, (SELECT COUNT(*) FROM named WHERE true_label = c) AS support, (SELECT COUNT(*) FROM named WHERE predicted = c) AS predicted,
  (SELECT COUNT(*) FROM named WHERE true_label = c AND predicted = c) AS tp FROM cls)"""


@query(
    "d40_class_quality",
    f"WITH {CLASSES} SELECT c AS class, support, predicted, tp, {num('CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END', 'precision')}, "
    f"{num('CASE WHEN support = 0 THEN 0 ELSE tp / support END', 'recall')}, {num('2.0 * tp / (predicted + support)', 'f1')}, "
    f"{num('SUM(tp) OVER () / SUM(support) OVER ()', 'accuracy')} FROM qual",
)
def _(t):
    return plain(E.class_quality(by_code(t)(scored(t)), "true_label", "predicted_label"))


@query(
    "d41_table_difference",
    f"WITH {I.SCORES}, pairs AS (SELECT abs(x - (x - dx)) AS gap FROM (SELECT e.x, d.dx FROM emb e JOIN dev d ON d.vec_id = e.vec_id AND d.i = e.i) y) "
    f"SELECT (SELECT COUNT(*) FROM embeddings) AS rows, {num('MAX(gap)', 'max_abs_diff')}, {num('AVG(gap)', 'mean_abs_diff')} FROM pairs",
)
def _(t):
    """Vectors against the same vectors shifted by the benign centre."""
    rows = I.vectors(t)
    model = M.block_reconstruction(rows.where("true_label = 'BENIGN'"), "embedding", I.DIMENSIONS)
    left = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("values"))
    centre = F.array(*[F.lit(float(c)) for c in model.centre])
    right = left.select("vec_id", F.zip_with("values", centre, lambda x, c: x - (x - c)).alias("values"))
    return plain(E.array_difference(left, right, "vec_id", "values"))


@query(
    "f17_threshold_sweep",
    f"WITH {I.SCORES}, c AS (SELECT mse, COUNT(*) FILTER (WHERE true_label <> 'BENIGN') AS p, COUNT(*) FILTER (WHERE true_label = 'BENIGN') AS n FROM scored GROUP BY mse), "
    "s AS (SELECT mse, SUM(p) OVER (ORDER BY mse DESC) AS tp, SUM(n) OVER (ORDER BY mse DESC) AS fp, SUM(p) OVER () AS ap, SUM(n) OVER () AS an FROM c) "
    f"SELECT {num('mse', 'threshold', 7)}, {whole('tp', 'tp')}, {whole('fp', 'fp')}, {num('tp / ap', 'tpr')}, {num('fp / an', 'fpr')}, {num('2.0 * tp / (tp + fp + ap)', 'f1')} FROM s",
)
def _(t):
    swept = E.sweep(scored(t), "mse_error", F.col("true_label") != "BENIGN")
    return plain(swept.select("threshold", "tp", "fp", "tpr", "fpr", "f1"), threshold=7)


@query(
    "f17_best_thresholds",
    f"WITH {I.SCORES}, c AS (SELECT mse, COUNT(*) FILTER (WHERE true_label <> 'BENIGN') AS p, COUNT(*) FILTER (WHERE true_label = 'BENIGN') AS n FROM scored GROUP BY mse), "
    "s AS (SELECT mse, p, n, SUM(p) OVER (ORDER BY mse DESC) AS tp, SUM(n) OVER (ORDER BY mse DESC) AS fp, SUM(p) OVER () AS ap, SUM(n) OVER () AS an FROM c) "
    f"SELECT {num('(SELECT mse FROM s ORDER BY round(tp / ap - fp / an, 9) DESC, mse DESC LIMIT 1)', 'youden_threshold', 7)}, {num('MAX(tp / ap - fp / an)', 'youden_j')}, "
    f"{num('(SELECT mse FROM s ORDER BY round(2.0 * tp / (tp + fp + ap), 9) DESC, mse DESC LIMIT 1)', 'f1_threshold', 7)}, {num('MAX(2.0 * tp / (tp + fp + ap))', 'best_f1')}, "
    f"{num('SUM(n * (tp - p / 2.0)) / (MAX(ap) * MAX(an))', 'roc_auc')} FROM s",
)
def _(t):
    swept = E.sweep(scored(t), "mse_error", F.col("true_label") != "BENIGN")
    return plain(E.best_thresholds(swept), youden_threshold=7, f1_threshold=7)


@query(
    "f23_detection_rates",
    f"WITH {I.SCORES} SELECT true_label, COUNT(*) AS n, {num(f'AVG(CASE WHEN mse >= {LIMIT} THEN 1 ELSE 0 END)', 'flagged_rate')}, "
    "CASE WHEN true_label = 'BENIGN' THEN 'false_positive_rate' ELSE 'detection_rate' END AS kind FROM scored GROUP BY true_label",
)
def _(t):
    flagged = scored(t).withColumn("hot", is_anomalous("mse_error", LIMIT))
    return plain(E.detection_rates(flagged, "true_label", "hot", "BENIGN"))


@query(
    "f23_error_rates",
    f"WITH {I.SCORES} SELECT {num(f'AVG(CASE WHEN mse >= {LIMIT} THEN 1 ELSE 0 END) FILTER (WHERE true_label = ' + repr('BENIGN') + ')', 'false_positive_rate')}, "
    f"{num(f'AVG(CASE WHEN mse < {LIMIT} THEN 1 ELSE 0 END) FILTER (WHERE true_label <> ' + repr('BENIGN') + ')', 'false_negative_rate')} FROM scored",
)
def _(t):
    flagged = scored(t).withColumn("hot", is_anomalous("mse_error", LIMIT))
    return plain(E.error_rates(flagged, "true_label", "hot", "BENIGN"))


# Gate on the error of benign rows; the limits are the expected validation errors.
GATES = [("mean", 0.05, "max"), ("p95", 0.0234, "max"), ("p99", 0.0567, "max"), ("accuracy", 0.92, "min")]
_GATES = (
    NAMED
    + ", e AS (SELECT AVG(mse) AS mean, quantile_cont(mse, 0.95) AS p95, quantile_cont(mse, 0.99) AS p99 FROM scored WHERE true_label = 'BENIGN'), "
    "a AS (SELECT AVG(CASE WHEN predicted = true_label THEN 1 ELSE 0 END) AS acc FROM named), "
    "g AS (SELECT 'mean' AS metric, mean AS value, 0.05::DOUBLE AS threshold, 'max' AS direction FROM e UNION ALL SELECT 'p95', p95, 0.0234, 'max' FROM e "
    "UNION ALL SELECT 'p99', p99, 0.0567, 'max' FROM e UNION ALL SELECT 'accuracy', acc, 0.92, 'min' FROM a), "
    "r AS (SELECT *, CASE WHEN direction = 'max' THEN value <= threshold ELSE value >= threshold END AS passed FROM g)"
)


def gates(t):
    errors = P.error_summary(scored(t).where("true_label = 'BENIGN'"), "mse_error")
    values = errors.unpivot([], ["mean", "p95", "p99"], "metric", "value")
    quality = E.class_quality(by_code(t)(scored(t)), "true_label", "predicted_label")
    accuracy = quality.agg(F.max("accuracy").alias("value")).select(F.lit("accuracy").alias("metric"), "value")
    return gate_results(values.unionByName(accuracy), GATES)


@query("g08_gate_results", f"WITH {_GATES} SELECT metric, {num('threshold', 'threshold')}, direction, {num('value', 'value', 8)}, CAST(passed AS BIGINT) AS passed FROM r")
def _(t):
    return plain(gates(t), value=8)


@query("g08_overall_gate", f"WITH {_GATES} SELECT COUNT(*) AS gates, COUNT(*) FILTER (WHERE NOT passed) AS failed, CAST(bool_and(passed) AS BIGINT) AS passed FROM r")
def _(t):
    return plain(overall_gate(gates(t)))
