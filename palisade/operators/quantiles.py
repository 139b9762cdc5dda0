"""Exact quantiles with linear interpolation.

Spark's ``percentile`` buffers the distinct values of a group in one task, which is
wrong for a feature column of a huge flow table.  ``quantiles`` narrows the
requested ranks in three passes of map-side combined counts: coarse slots,
fine slots inside the slots that hold a requested rank, then the values inside
those fine slots.  The slots found (a few per group) are broadcast after a size
check, so the data itself is scanned three times and only counts are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.functions.numeric import col, finite, magnitude_slot
from palisade.operators.ordered import COARSE_PER_OCTAVE, FINE_PER_OCTAVE, attach, sized_broadcast


def quantiles(
    df: DataFrame,
    value: str | Column,
    probabilities: Sequence[float],
    group: Sequence[str] = (),
    name: str = "quantiles",
    method: str = "ranks",
) -> DataFrame:
    """One row per group: ``name`` is the array of quantiles, in the order asked.

    Non-finite values are ignored.  ``method`` is ``ranks`` or, as a check on small
    data, ``buffered``; both give the same numbers.
    """
    probabilities = [float(p) for p in probabilities]
    if method == "buffered":
        probs = F.array(*[F.lit(p) for p in probabilities])
        counts = (
            df.select(*[col(g) for g in group], finite(value).alias("__v"))
            .groupBy(*group, "__v")
            .agg(F.count("*").alias("__n"))
        )
        return counts.groupBy(*group).agg(
            F.percentile(F.col("__v"), probs, F.col("__n")).alias(name)
        )
    return _by_ranks(df, value, probabilities, list(group), name)


def quantile_columns(
    df: DataFrame,
    value: str | Column,
    named: dict[str, float],
    group: Sequence[str] = (),
    method: str = "ranks",
) -> DataFrame:
    """Like ``quantiles`` with one named column per probability."""
    wide = quantiles(df, value, list(named.values()), group, "__q", method)
    return wide.select(*group, *[F.col("__q")[i].alias(n) for i, n in enumerate(named)])


def interpolated(place: Column) -> Column:
    """Value of a place (low, high, weight); equal ends give exactly that value."""
    low, high = place["low"], place["high"]
    return F.when(low == high, low).otherwise(low + (high - low) * place["weight"])


def _located(counts: DataFrame, keys: Sequence[str], slot: str) -> DataFrame:
    """Add the first and last rank of each slot inside the enclosing slot ``keys``."""
    running = Window.partitionBy(*keys).orderBy(slot).rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("__last", F.sum("__n").over(running) - 1).withColumn(
        "__first", F.col("__last") - F.col("__n") + 1
    )


def _narrow(located: DataFrame) -> DataFrame:
    """Keep slots that hold a requested rank; ranks become relative to the slot.

    A group without values keeps one row without ranks.
    """
    inside = F.filter(
        "__hits", lambda h: (h["rank"] >= F.col("__first")) & (h["rank"] <= F.col("__last"))
    )
    moved = F.transform(inside, lambda h: h.withField("rank", h["rank"] - F.col("__first")))
    return located.withColumn("__hits", moved).where(
        (F.size("__hits") > 0) | ((F.col("__total") == 0) & F.col("__n").isNotNull())
    ).drop("__first", "__last", "__n")


def order_statistics(
    df: DataFrame, value: str | Column, sets: Sequence[tuple[Sequence[str], Sequence[float]]]
) -> DataFrame:
    """Places of quantiles of several groupings of the same values, in one search.

    ``sets`` holds (group columns, probabilities).  Returns ``set`` (its index), the
    columns of all groupings, null where a grouping has none, and ``places``: for each
    probability the values on both sides and the weight of the upper one.  The search
    scans the data three times, however many groupings there are: rows are counted by
    the finest grouping, and its counts are summed up for the others.
    """
    finest = list(dict.fromkeys(c for group, _ in sets for c in group))
    shared = [c for c in finest if all(c in group for group, _ in sets)]
    rows = df.select(*[col(c) for c in finest], finite(value).alias("__v")).withColumns(
        {
            "__coarse": magnitude_slot("__v", COARSE_PER_OCTAVE),
            "__fine": magnitude_slot("__v", FINE_PER_OCTAVE),
        }
    )
    kinds = {f.name: f.dataType for f in rows.schema}

    def by_set(counts: DataFrame, slots: Sequence[str]) -> DataFrame:
        """Counts of the finest grouping summed up for every grouping."""
        if len(sets) == 1:
            return counts.withColumn("set", F.lit(0))
        entries = [
            F.struct(
                F.lit(i).alias("set"),
                *[(col(c) if c in group else F.lit(None).cast(kinds[c])).alias(c) for c in finest],
            )
            for i, (group, _) in enumerate(sets)
        ]
        spread = counts.select(*slots, "__n", F.explode(F.array(*entries)).alias("__e")).select("__e.*", *slots, "__n")
        return spread.groupBy("set", *finest, *slots).agg(F.sum("__n").alias("__n"))

    keys = ["set", *finest]
    total = F.sum("__n").over(Window.partitionBy(*keys))
    wanted = F.when(F.lit(False), F.array().cast("array<struct<i:int,side:string,rank:bigint,weight:double>>"))
    for number, (_, probabilities) in enumerate(sets):
        asked = []
        for index, probability in enumerate(probabilities):
            place = (F.col("__total") - 1) * F.lit(float(probability))
            for side, rank in (("low", F.floor(place)), ("high", F.ceil(place))):
                asked.append(
                    F.struct(
                        F.lit(index).alias("i"),
                        F.lit(side).alias("side"),
                        rank.cast("long").alias("rank"),
                        (place - F.floor(place)).alias("weight"),
                    )
                )
        wanted = wanted.when(F.col("set") == number, F.array(*asked))
    counts = by_set(rows.groupBy(*finest, "__coarse").agg(F.count("__v").alias("__n")), ["__coarse"])
    counts = counts.withColumn("__total", total)
    located = _located(counts, keys, "__coarse").withColumn("__hits", wanted)
    hits, _ = sized_broadcast(_narrow(located.where("__n > 0 OR __total = 0")))
    empty = hits.where("__total = 0").select(*keys)

    present, slots = rows.where(F.col("__v").isNotNull()), ["__coarse"]
    for inner in ("__fine", "__v"):
        inside = attach(present, hits.select(*shared, *slots).distinct(), [*shared, *slots], "left_semi")
        counts = by_set(inside.groupBy(*finest, *slots, inner).agg(F.count("*").alias("__n")), [*slots, inner])
        hits = _narrow(attach(_located(counts, [*keys, *slots], inner), hits.where("__total > 0"), [*keys, *slots]))
        slots.append(inner)
        if inner == "__fine":
            hits, _ = sized_broadcast(hits)

    found = hits.select(*keys, "__v", F.explode("__hits").alias("h"))

    def at(index: int, side: str, what: Column) -> Column:
        return F.max(F.when((F.col("h.i") == index) & (F.col("h.side") == side), what))

    places = [
        F.struct(
            at(index, "low", F.col("__v")).alias("low"),
            at(index, "high", F.col("__v")).alias("high"),
            at(index, "low", F.col("h.weight")).alias("weight"),
        )
        for index in range(max(len(p) for _, p in sets))
    ]
    result = found.groupBy(*keys).agg(F.array(*places).alias("places"))
    return result.unionByName(empty.distinct(), allowMissingColumns=True)


def _by_ranks(
    df: DataFrame, value: Column, probabilities: list[float], group: list[str], name: str
) -> DataFrame:
    found = order_statistics(df, value, [(group, probabilities)])
    if not group:
        found = found.agg(F.max("places").alias("places"))
    return found.select(*[col(g) for g in group], F.transform("places", interpolated).alias(name))
