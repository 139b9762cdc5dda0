"""Secrets in texts: three fixed patterns and a character Markov model, all native.

Spans are code points, end exclusive.  A pattern's positions come from the lengths
of its matches and of the gaps between them.  Long tokens are judged by two
first-order Markov chains over character classes: one of random strings, one of
ordinary identifiers; the log-likelihood ratio says which made the token.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.llm.common import held

KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")


def either_case(word: str) -> str:
    """ASCII letters of a pattern in both cases, other characters as they are."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() and c.isascii() else c for c in word)


ASSIGN = (
    "(" + "|".join(map(either_case, KEYWORDS)) + ")"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
# A run of 24 or more starts where the run starts, so this finds the same spans.
LONG_HEX = r"[0-9a-f]{24,}"
LONG_ACCESS = r"AKIA[A-Z0-9]{16,}"
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
# Bound on the documents that give labelled samples.
SAMPLE_DOCUMENTS = 2000
# Rows expected below the sample's bound on hashes, as a multiple of the sample.
SLACK = 2.0
# A token is a secret when the ratio exceeds this many nats in all and per step.
MIN_TOTAL, MIN_STEP = 12.0, 0.5
# Weight of single characters against counted transitions.
BACKOFF = 10.0


CHUNK = 64


def running(values: Column, combine, first: int = 0) -> Column:
    """For each whole number of an array, ``combine`` of all before it, from ``first``.

    Appending to an array copies it, so the array is cut into pieces of CHUNK: each is
    run through on its own, from what the pieces before it come to.
    """
    count = F.floor((F.size(values) + (CHUNK - 1)) / CHUNK).cast("int")
    starts = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))

    def through(piece: Column, start: Column) -> Column:
        zero = F.struct(start.cast("int").alias("at"), F.array().cast("array<int>").alias("out"))
        step = lambda acc, x: F.struct(combine(acc["at"], x).cast("int").alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        return F.aggregate(piece, zero, step, lambda acc: acc["out"])

    pieces = F.transform(starts, lambda i: F.slice(values, i * CHUNK + 1, CHUNK))
    totals = F.transform(pieces, lambda p: F.aggregate(p, F.lit(first), lambda acc, x: combine(acc, x).cast("int")))
    # One-element arrays bind a value once for use inside a lambda.
    bound = F.transform(F.array(F.struct(pieces.alias("p"), totals.alias("t"))), lambda b: F.flatten(
        F.zip_with(b["p"], through(b["t"], F.lit(first)), through)
    ))
    return F.get(bound, F.lit(0))


def _spans(text: Column, pattern: str) -> Column:
    """array<struct<start,end,match>> of leftmost non-overlapping matches."""
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(
        F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: F.struct(g.alias("g"), m.alias("m"))
    )

    def placed(pairs: Column) -> Column:
        before = running(F.transform(pairs, lambda p: p["g"] + F.length(p["m"])), lambda a, b: a + b)
        return F.zip_with(
            pairs,
            before,
            lambda p, at: F.struct(
                (at + p["g"]).alias("start"), (at + p["g"] + F.length(p["m"])).alias("end"), p["m"].alias("match")
            ),
        )

    found = F.get(F.transform(F.array(pairs), placed), F.lit(0))
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")
    return F.when(text.rlike(pattern), found).otherwise(none)


def _kind(spans: Column, kind: str) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.lit(KINDS.index(kind)).alias("rank"),
            s["match"].alias("match"),
        ),
    )


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of the fixed patterns by kind; matches that are too short are dropped."""
    assigned = F.filter(
        _spans(text, ASSIGN), lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= 6
    )
    return {
        "assign": _kind(assigned, "assign"),
        "access": _kind(_spans(text, LONG_ACCESS), "access"),
        "hex": _kind(_spans(text, LONG_HEX), "hex"),
    }


def _steps(token: Column) -> Column:
    """Codes of the character pairs of a token (first-order transitions)."""
    size = len(ALPHABET) + 1
    codes = F.transform(F.split(token, "", -1), lambda c: F.position(c, F.lit(ALPHABET)))
    return F.zip_with(
        F.slice(codes, 1, F.greatest(F.size(codes) - 1, F.lit(0))),
        F.slice(codes, 2, F.greatest(F.size(codes) - 1, F.lit(0))),
        lambda a, b: a * size + b,
    )


def labelled_tokens(df: DataFrame, id_col: str, text_col: str, documents: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """(token, random) from at most ``documents`` whole texts of each sort.

    Random strings are the values that the fixed patterns find; ordinary identifiers
    are the long words of texts in which they find nothing.
    """
    t = df.select(F.xxhash64(id_col).alias("h"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    t = t.withColumn("hit", F.col("t").rlike(f"{LONG_ACCESS}|{LONG_HEX}|{ASSIGN}"))
    found = {r["hit"]: r["n"] for r in t.groupBy("hit").agg(F.approx_count_distinct("h", 0.02).alias("n")).collect()}

    def first(hit: bool) -> DataFrame:
        # The smallest hashes: a bound on them, with room to spare, lets each task pass on
        # a few texts, so that the one task that takes the first ones is handed a few thousand.
        share = min(1.0, SLACK * documents / max(1, found.get(hit, 0)))
        bound = min(2**63 - 1, int(share * 2**64) - 2**63)
        return t.where((F.col("h") <= F.lit(bound)) & (F.col("hit") == F.lit(hit))).orderBy("h", "t").limit(documents)

    hits, rest = first(True), first(False)
    values = F.concat(
        F.regexp_extract_all(F.col("t"), F.lit(LONG_ACCESS), F.lit(0)),
        F.regexp_extract_all(F.col("t"), F.lit(LONG_HEX), F.lit(0)),
        F.regexp_extract_all(F.col("t"), F.lit(ASSIGN), F.lit(2)),
    )
    words = F.regexp_extract_all(F.col("t"), F.lit(r"[A-Za-z0-9+/_=-]{6,}"), F.lit(0))
    return hits.select(F.explode(values).alias("token"), F.lit(True).alias("random")).where(
        F.length("token") >= 12
    ).unionByName(rest.select(F.explode(words).alias("token"), F.lit(False).alias("random")))


def fit(samples: DataFrame, smoothing: float = 0.5) -> list[float]:
    """Log-likelihood ratio (random over ordinary) of every character transition.

    ``samples``: (token string, random boolean).  Counts are made by Spark; what comes
    back is at most one row per transition, whatever the sample.  Without samples of
    a sort its chain is uniform.
    """
    size = len(ALPHABET) + 1
    counts = {True: [0.0] * size * size, False: [0.0] * size * size}
    rows = samples.select("random", F.explode(_steps(F.col("token"))).alias("step")).groupBy("random", "step").count()
    for r in rows.collect():  # bounded by the alphabet
        counts[bool(r["random"])][r["step"]] = float(r["count"])
    # A chain falls back on how common the next character is: a transition from a
    # character never seen is then as rare as its end.
    alone = {}
    for k, v in counts.items():
        ends = [sum(v[b::size]) + smoothing for b in range(size)]
        alone[k] = [x / sum(ends) for x in ends]
    ratio = []
    for a in range(size):
        row = {k: v[a * size : (a + 1) * size] for k, v in counts.items()}
        chance = {k: [(x + BACKOFF * p) / (sum(r) + BACKOFF) for x, p in zip(r, alone[k], strict=True)] for k, r in row.items()}
        ratio += [math.log(x) - math.log(y) for x, y in zip(chance[True], chance[False], strict=True)]
    return ratio


def _is_secret(token: Column, ratio: list[float]) -> Column:
    values = F.lit([float(x) for x in ratio])
    total = F.aggregate(_steps(token), F.lit(0.0), lambda acc, s: acc + F.get(values, s))
    return (total >= MIN_TOTAL) & (total >= MIN_STEP * (F.length(token) - 1))


def find(df: DataFrame, ratio: list[float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``found``: array<struct<start,end,rank,match>> sorted by start and kind.

    Kinds by rank: assign, access, hex, markov.  Markov spans that touch a span of a
    fixed pattern are left out.  Null and empty texts have no spans.  One row per
    input row; other columns of ``df`` are not read.
    """
    t = df.select(
        F.col(id_col).alias("__id"), held(F.coalesce(F.col(text_col), F.lit(""))).alias("__t")
    )
    t = t.select("__id", "__t", *[held(c).alias(f"__{k}") for k, c in base_spans(F.col("__t")).items()])
    t = t.select(
        "__id",
        held(F.array_sort(F.concat("__assign", "__access", "__hex"))).alias("__base"),
        held(_kind(_spans(F.col("__t"), TOKEN), "markov")).alias("__tokens"),
    )
    clear = lambda s: ~F.exists(F.col("__base"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    markov = F.filter(F.col("__tokens"), lambda s: clear(s) & _is_secret(s["match"], ratio))
    return t.select(
        F.col("__id").alias(id_col), held(F.array_sort(F.concat(F.col("__base"), markov))).alias("found")
    )


def listing(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def report(df: DataFrame, ratio: list[float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts by kind and spans per row."""
    f = find(df, ratio, id_col, text_col)
    count = lambda k: F.size(F.filter("found", lambda s: s["rank"] == KINDS.index(k))).cast("long")
    base = F.filter(F.col("found"), lambda s: s["rank"] < 3)
    return f.select(
        id_col,
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(listing(base), 256).alias("base_sha256"),
        listing(F.col("found")).alias("spans"),
    )


def redact(df: DataFrame, ratio: list[float], text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``df`` with every span of ``text_col`` replaced by ``mark``, all columns kept.

    Overlapping spans are replaced as one.  Null texts stay null, and empty and blank ones
    as they are.  Repeated rows are treated one by one; columns may have any names.
    """
    work = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"))
    text = F.col("__row")[text_col]
    found = find(work.select(F.struct("__row").alias("k"), text.alias("t")), ratio, "k", "t")
    t = F.col("k")["__row"][text_col]
    ends = F.transform("found", lambda s: s["end"])
    reached = running(ends, lambda a, b: F.greatest(a, b))
    pieces = F.zip_with(
        F.col("found"),
        reached,
        lambda s, at: F.when(
            s["start"] >= at, F.concat(t.substr(at + 1, s["start"] - at), F.lit(mark))
        ).otherwise(F.lit("")),
    )
    clean = F.concat(F.array_join(pieces, ""), t.substr(F.array_max(ends) + 1, F.length(t)))
    new = F.when(F.size("found") > 0, clean).otherwise(t)
    return found.select(
        *[(new if c == text_col else F.col("k")["__row"][c]).alias(c) for c in df.columns]
    )
