"""Rule-based text quality: a table of thresholds compiled into one projection.

Each measure is a built-in expression over the whole text, so the filter runs
inside the scan stage: no shuffle, no user function.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.llm.common import SPACES, held, words_of

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the and of to in is that it for with as on was be are this or an at by "
    "de la que el en los y a se del las por con no una "
    "le et les des un une du est dans il au "
    "der die und den von zu das mit sich auf ist ein eine"
).split()


class Rule(NamedTuple):
    """A text passes when ``low <= measure <= high``; None leaves a side open."""

    measure: str
    low: float | None
    high: float | None


RULES = (
    Rule("n_words", 20, None),
    Rule("mean_word_chars", 2.0, 14.0),
    Rule("symbol_ratio", None, 0.1),
    Rule("stop_ratio", 0.02, None),
    Rule("dup_line_ratio", None, 0.4),
    Rule("stutter_ratio", None, 0.3),
    Rule("repeat_ratio", None, 0.3),
)


def _covered(words: Column) -> Column:
    """Words inside windows of WINDOW words that occur twice or more in the text.

    Hashes tell texts without any repeated window; only the others are compared
    by their words, sorted, so cost is n log n in the length of the text.
    """
    starts = F.when(
        F.size(words) >= WINDOW, F.sequence(F.lit(0), F.size(words) - WINDOW)
    ).otherwise(F.array().cast("array<int>"))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i + 1, WINDOW)))
    # The one-element arrays bind a value once for use inside a lambda.
    repeats = F.transform(
        F.array(hashes), lambda h: F.size(F.array_distinct(h)) < F.size(h)
    )[0]
    ordered = F.array_sort(
        F.transform(
            starts,
            lambda i: F.struct(
                F.array_join(F.slice(words, i + 1, WINDOW), " ").alias("w"), i.alias("p")
            ),
        )
    )

    def twice(s: Column) -> Column:
        same = lambda x, i, step: F.coalesce(F.get(s, i + step)["w"] == x["w"], F.lit(False))
        return F.filter(s, lambda x, i: same(x, i, F.lit(-1)) | same(x, i, F.lit(1)))

    found = F.transform(F.array(ordered), twice)[0]
    places = F.array_sort(F.transform(found, lambda x: x["p"]))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))
    total = F.aggregate(
        places,
        start,
        lambda a, p: F.struct(
            (p + WINDOW).alias("end"),
            (a["total"] + p + WINDOW - F.greatest(p, a["end"])).alias("total"),
        ),
        lambda a: a["total"],
    )
    return F.when(repeats, total).otherwise(F.lit(0))


def measures(df: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """Add the counts and ratios that rules refer to, as ``prefix`` + name.

    Null and blank texts have zero of everything and ratios of zero.  Columns of
    ``df`` with a produced name are replaced.
    """
    t, w, n = f"{prefix}__text", f"{prefix}__words", lambda name: F.col(f"{prefix}{name}")
    base = df.withColumn(t, F.coalesce(F.col(text_col), F.lit("")))
    lines = F.filter(F.split(F.col(t), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = base.withColumns({w: held(words_of(F.col(t))), f"{prefix}__lines": held(lines)})
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    stop = list(dict.fromkeys(STOP_WORDS))
    counted = base.withColumns(
        {
            f"{prefix}n_words": F.size(F.col(w)).cast("long"),
            f"{prefix}word_chars": F.length(F.regexp_replace(F.col(t), SPACES + "+", "")).cast("long"),
            f"{prefix}n_symbols": F.regexp_count(F.col(t), F.lit(SYMBOLS)).cast("long"),
            f"{prefix}n_lines": F.size(F.col(f"{prefix}__lines")).cast("long"),
            f"{prefix}n_dup_lines": (
                F.size(F.col(f"{prefix}__lines")) - F.size(F.array_distinct(F.col(f"{prefix}__lines")))
            ).cast("long"),
            f"{prefix}n_repeat_words": held(_covered(F.col(w))).cast("long"),
            f"{prefix}n_stutters": F.size(
                F.filter(F.col(w), lambda x, i: (i > 0) & (F.get(F.col(w), i - 1) == x))
            ).cast("long"),
            f"{prefix}n_stop_words": F.size(
                F.filter(F.col(w), lambda x: F.lower(x).isin(stop))
            ).cast("long"),
        }
    )
    return counted.withColumns(
        {
            f"{prefix}mean_word_chars": ratio(n("word_chars"), n("n_words")),
            f"{prefix}symbol_ratio": ratio(n("n_symbols"), n("n_words")),
            f"{prefix}stop_ratio": ratio(n("n_stop_words"), n("n_words")),
            f"{prefix}stutter_ratio": ratio(n("n_stutters"), n("n_words")),
            f"{prefix}dup_line_ratio": ratio(n("n_dup_lines"), n("n_lines")),
            f"{prefix}repeat_ratio": ratio(n("n_repeat_words"), n("n_words")),
        }
    ).drop(t, w, f"{prefix}__lines")


def compiled(rules=RULES, prefix: str = "") -> Column:
    """One boolean expression for a table of rules."""
    passed = F.lit(True)
    for rule in rules:
        value = F.col(f"{prefix}{rule.measure}")
        if rule.low is not None:
            passed = passed & (value >= F.lit(rule.low))
        if rule.high is not None:
            passed = passed & (value <= F.lit(rule.high))
    return passed


def base_failed(prefix: str = "") -> Column:
    """Under 20 words, or over 30 % of the words in repeated windows."""
    n, r = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < 20) | (r * 100 > n * 30)


def assess(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """Counts and verdict per row: one output row for each input row, in any order.

    Null, empty and blank texts count zero words and are rejected.  Repeated rows
    are judged one by one.  An empty table gives an empty result.  Other columns
    of ``df`` are not read.
    """
    m = measures(df.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__in")), "__in")
    return m.select(
        F.col("__id").alias(id_col),
        *[F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed().alias("base_failed"),
        (~base_failed() & compiled(rules)).alias("kept"),
        *[F.col(c) for c in ("n_lines", "n_stop_words")],
    )


def keep(df: DataFrame, text_col: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``df`` that pass, all columns unchanged.

    Null, empty and blank texts do not pass; repeated rows are judged one by one.
    """
    m = measures(df, text_col, "__q_")
    return m.where(~base_failed("__q_") & compiled(rules, "__q_")).select(*[m[f"`{c}`"] for c in df.columns])
