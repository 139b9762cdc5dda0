"""Severity of toxic language by cumulative-link (ordinal) regression.

P(grade <= k) = sigmoid(cut_k - w.x): one sparse weight vector is shared by all
ordered thresholds.  x marks which words and word stems a text holds, so a few
insults in a long text count as much as in a short one; the L1 penalty leaves weight
on features that tell grades apart and none on the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.llm.common import SPACES, stored

# Bound on the labelled rows used for fitting; their texts are used whole.
SAMPLE_ROWS = 8000
MIN_DOCUMENTS = 5
GRADES = 3
CANDIDATES = 1500
MARKS = ".,;:!?\"'()[]*#%$&|<>"


def features(text: bytes | None) -> set[str]:
    """Distinct words of a text, A-Z in lower case, without punctuation at their ends,
    and, marked by a star, their first four and first five characters (stems)."""
    words = {w.strip(MARKS) for w in (text or b"").lower().decode("utf-8", "replace").split()}
    words.discard("")
    return words | {w[:4] + "*" for w in words} | {w[:5] + "*" for w in words}


@dataclass(frozen=True)
class SeverityModel:
    """Weights of words and the ordered cuts between ``len(cuts) + 1`` grades."""

    weights: dict[str, float]
    cuts: tuple[float, ...]

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        """Grade probabilities, one row per score."""
        below = 1 / (1 + np.exp(-np.clip(np.asarray(self.cuts)[None, :] - scores[:, None], -50, 50)))
        edges = np.hstack([np.zeros((len(scores), 1)), below, np.ones((len(scores), 1))])
        return np.diff(edges, axis=1)

    def score_texts(self, texts: list[bytes | None]) -> np.ndarray:
        w = self.weights
        return np.array([sum(w[x] for x in features(t) & w.keys()) for t in texts], dtype=float)


def _safe_rate(columns, owner, n, size, rate: float) -> float:
    """``rate``, or less where the rows share their features.

    The likelihood's curvature in the scaled weights is at most half the largest
    eigenvalue of the scaled Gram matrix, which a few products with it approach from
    below; the step stays under its inverse.
    """
    scale = np.sqrt(size)
    v, top = scale.copy(), 0.0
    for _ in range(20):
        length = np.linalg.norm(v)
        if length == 0:
            return rate
        v = v / length
        rows = np.bincount(owner, weights=(scale * v)[columns], minlength=n)
        v = scale * np.bincount(columns, weights=rows[owner], minlength=len(size)) / n
        top = float(np.linalg.norm(v))
    return min(rate, 1.6 / max(top, 1e-12))


def _descend(columns, owner, grades, size, cuts, penalty, steps):
    """Accelerated proximal gradient on the cumulative-link likelihood."""
    n, width = len(grades), len(size)
    w = past = look = np.zeros(width)
    momentum, rate, cuts = 1.0, _safe_rate(columns, owner, n, size, 0.02), cuts.copy()
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -50, 50)))
    for _ in range(steps):
        s = np.bincount(owner, weights=look[columns], minlength=n)
        a = np.where(grades == len(cuts), 1.0, sigmoid(np.append(cuts, 0)[grades] - s))
        b = np.where(grades == 0, 0.0, sigmoid(np.append(0, cuts)[grades] - s))
        inside = np.maximum(a - b, 1e-9)
        slope = (a * (1 - a) - b * (1 - b)) / inside  # minus d log-likelihood / d score
        gradient = np.bincount(columns, weights=slope[owner], minlength=width) / n
        w = look - rate * size * gradient
        w = np.sign(w) * np.maximum(np.abs(w) - rate * size * penalty, 0)
        for k in range(len(cuts)):
            rise, fall = (a * (1 - a) / inside)[grades == k].sum(), (b * (1 - b) / inside)[grades == k + 1].sum()
            cuts[k] += 2.0 * (rise - fall) / n
        cuts = np.maximum.accumulate(cuts + 1e-6 * np.arange(len(cuts)))
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        look, past, momentum = w + (momentum - 1) / following * (w - past), w, following
    return w, cuts


def fit_ordinal(where: list[np.ndarray], names: list[str], grades: np.ndarray, n_grades: int, penalty: float = 3e-3,
                steps: int = 300) -> SeverityModel:
    """Fit on rows given as the numbers of the ``names`` they hold: an L1 fit selects
    features, a second fit on those alone, with a fortieth of the penalty, undoes its
    shrinkage.

    With a single grade there are no weights and the cuts give the observed shares;
    without rows grade 0 is taken for the usual one.
    """
    share = np.bincount(grades, minlength=n_grades) + 0.5
    share[0] += 0 if len(grades) else 100
    cumulative = np.clip(np.cumsum(share / share.sum())[:-1], 1e-6, 1 - 1e-6)
    cuts = np.log(cumulative / (1 - cumulative))
    if len(set(grades.tolist())) < 2:
        return SeverityModel({}, tuple(cuts.tolist()))
    columns = np.concatenate(where).astype(np.int64) if where else np.zeros(0, dtype=np.int64)
    owner = np.repeat(np.arange(len(where)), [len(x) for x in where])
    start, kept, w = cuts, np.arange(len(names)), np.zeros(len(names))
    for strength in (penalty, penalty / 40):
        place = np.full(len(names), -1)
        place[kept] = np.arange(len(kept))
        here = place[columns] >= 0
        local, rows = place[columns[here]], owner[here]
        # Features in few rows have a small curvature and may take larger steps.
        size = 1 / (0.25 * np.bincount(local, minlength=len(kept)) / len(where) + 0.02)
        w, cuts = _descend(local, rows, grades, size, start, strength, steps)
        kept, w = kept[w != 0], w[w != 0]
    return SeverityModel({names[i]: float(x) for i, x in zip(kept, w, strict=True)}, tuple(cuts.tolist()))


def labelled_sample(df: DataFrame, labels: DataFrame, grade_col: str, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(row, y, features) of at most ``rows`` labelled rows, chosen by a hash of the id.

    Rows with label 0 fill at most three quarters, so a rare grade is not crowded out.
    The table is stored: it is counted several times, and the driver never holds it.
    """
    text = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = labels.select(F.col(id_col).alias("id"), F.col(grade_col).cast("int").alias("y")).where("y IS NOT NULL")
    order = [F.xxhash64("id"), F.col("id"), F.col("y")]
    some = known.where("y > 0").orderBy(*order).limit(rows // 4).unionByName(
        known.where("y <= 0").orderBy(*order).limit(rows - rows // 4)
    )
    # Features are sets, so each text comes as its distinct words.
    words = F.array_join(F.array_sort(F.array_distinct(F.split(F.col("text"), SPACES + "+"))), " ")
    got = text.join(some, "id").select("id", "y", words.alias("text")).orderBy(F.xxhash64("id"), "id", "y", "text").limit(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 200):
                batch = whole.slice(low, 200)
                held = [sorted(features(t)) for t in batch.column(2).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(held, pa.list_(pa.string()))], names=["row", "y", "features"])

    numbered = got.select(F.monotonically_increasing_id().alias("row"), "y", "text")
    return stored(numbered.mapInArrow(run, "row long, y int, features array<string>"), "severity-sample")


def _counted(sample: DataFrame) -> DataFrame:
    """(feature, clean, toxic): rows of label 0 and of the others that hold a feature."""
    each = sample.select("y", F.explode("features").alias("feature"))
    return each.groupBy("feature").agg(F.count_if(F.col("y") <= 0).alias("clean"), F.count_if(F.col("y") > 0).alias("toxic"))


def screened(counts: DataFrame, clean_rows: int, toxic_rows: int, candidates: int) -> list[str]:
    """The ``candidates`` features whose share differs most between label 0 and the others,
    in standard errors, among those in MIN_DOCUMENTS rows or more; in order of their names."""
    n0, n1 = float(max(1, clean_rows)), float(max(1, toxic_rows))
    pooled = (F.col("clean") + F.col("toxic") + 0.5) / (n0 + n1)
    spread = F.sqrt(pooled * (1 - F.least(pooled, F.lit(0.999))) * (1 / n0 + 1 / n1))
    z = F.abs((F.col("toxic") / n1 - F.col("clean") / n0) / spread)
    best = counts.where(F.col("clean") + F.col("toxic") >= MIN_DOCUMENTS).orderBy(F.desc(z), "feature").limit(candidates)
    return sorted(r["feature"] for r in best.select("feature").collect())


def graded(sample: DataFrame, counts: DataFrame, clean_rows: int, toxic_rows: int) -> dict[int, int]:
    """Severity 1 or 2 of each toxic row of the sample.

    Labels only say toxic or not.  Features that are at least five times as frequent in
    toxic as in other rows count as strong; a toxic row with more of them than the
    median toxic row has grade 2, the other toxic rows have grade 1.
    """
    n0, n1 = max(1, clean_rows), max(1, toxic_rows)
    strong = counts.where(
        (F.col("toxic") >= MIN_DOCUMENTS) & (F.col("toxic") / n1 >= 5.0 * (F.col("clean") + 1) / n0)
    ).select("feature")
    toxic = sample.where("y > 0")
    held = toxic.select("row", F.explode("features").alias("feature")).join(strong, "feature").groupBy("row").agg(F.count("*").alias("n"))
    rows = toxic.select("row").join(held, "row", "left").select("row", F.coalesce("n", F.lit(0)).alias("n")).collect()
    middle = np.median([r["n"] for r in rows]) if rows else 0.0
    return {r["row"]: 1 + int(r["n"] > middle) for r in rows}


def fit(df: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic", candidates: int = CANDIDATES) -> SeverityModel:
    """Fit on a bounded sample of labelled rows (``rows``), graded by ``graded``.

    Spark counts features by label over the sample's whole texts.  The driver gets the
    ``candidates`` features that tell labels apart best and, for each row, which of these
    it holds, as numbers; the fit itself chooses among them.
    """
    sample = labelled_sample(df, labels, label_col, rows, id_col, text_col)
    sizes = sample.agg(F.count_if(F.col("y") <= 0), F.count_if(F.col("y") > 0)).first()
    counts = stored(_counted(sample), "severity-counts")
    names = screened(counts, *sizes, candidates)
    grades = graded(sample, counts, *sizes)
    number = sample.sparkSession.createDataFrame([(x, i) for i, x in enumerate(names)], "feature string, number int")
    held = sample.select("row", F.explode("features").alias("feature")).join(F.broadcast(number), "feature")
    lists = held.groupBy("row").agg(F.array_sort(F.collect_list("number")).alias("numbers"))
    table = sample.select("row").join(lists, "row", "left").orderBy("row").toArrow()
    of = [np.zeros(0, dtype=np.int64) if x is None else np.array(x, dtype=np.int64) for x in table.column("numbers").to_pylist()]
    marks = np.array([grades.get(r, 0) for r in table.column("row").to_pylist()], dtype=np.int64)
    return fit_ordinal(of, names, marks, GRADES)


def score(df: DataFrame, model: SeverityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Severity of each whole text, one output row per input row.

    Returns the id, ``severity`` (expected grade), ``grade`` (most probable) and
    ``toxic`` (grade above 0 more likely than grade 0).  Null, empty and blank texts
    hold no word and get the severity of a text without known words.  Repeated rows
    are scored one by one; an empty table gives an empty result; other columns of
    ``df`` are not read.
    """
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.probabilities(model.score_texts(batch.column(1).cast(pa.binary()).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(p @ np.arange(p.shape[1])),
                    pa.array(p.argmax(axis=1).astype(np.int32)),
                    pa.array(p[:, 0] < 0.5),
                ],
                names=[id_col, "severity", "grade", "toxic"],
            )

    schema = T.StructType(
        [
            T.StructField(id_col, kind),
            T.StructField("severity", T.DoubleType()),
            T.StructField("grade", T.IntegerType()),
            T.StructField("toxic", T.BooleanType()),
        ]
    )
    return source.mapInArrow(run, schema)


def drop_toxic(df: DataFrame, model: SeverityModel, text_col: str = "text") -> DataFrame:
    """Rows of ``df`` that the model does not call toxic, all columns unchanged.

    Null, empty and blank texts hold no word and are judged by the cuts alone; repeated
    rows are judged one by one; other columns, whatever their names, are passed on.
    """
    at, schema = df.columns.index(text_col), df.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score_texts(batch.column(at).cast(pa.binary()).to_pylist())
            yield batch.filter(pa.array(model.probabilities(scores)[:, 0] >= 0.5))

    return df.mapInArrow(run, schema)
