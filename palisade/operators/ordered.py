"""Order-dependent operators that never put a whole series into one task.

A plain window over a series key sorts every row of that key in one task.  Here
the order is cut into *slots*: a slot is an expression that never decreases along
the order (an hour, a hash prefix, a magnitude slot).  Totals per slot are
combined on the map side, their running sum is a small table, and the row-level
window only covers one slot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.functions.numeric import magnitude_slot

COARSE_PER_OCTAVE = 16
FINE_PER_OCTAVE = 65536

_SLOT = "__slot"
_POS = "__pos"


def attach(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which null matches null; keeps the left keys."""
    renamed = right.select(
        *[F.col(k).alias(f"__r_{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(renamed[f"__r_{key}"])
    return left.join(renamed, condition, how).drop(*[f"__r_{k}" for k in keys])


def sized_broadcast(df: DataFrame, rows: int = 100_000) -> tuple[DataFrame, bool]:
    """Hold a small result table for broadcasting, after checking that it is small.

    Returns the table marked for broadcast and True when it has at most ``rows``
    rows (those rows pass through the driver).  A larger one comes back as it was,
    with False, and joins by shuffle.
    """
    held = df.limit(rows + 1).toArrow()
    if held.num_rows > rows:
        return df, False
    if held.num_rows == 0:
        return df.sparkSession.createDataFrame([], df.schema), True
    return F.broadcast(df.sparkSession.createDataFrame(held, df.schema)), True


def prefix_sums(
    df: DataFrame,
    sums: Mapping[str, Column],
    order: Sequence[Column],
    slot: Column,
    group: Sequence[str] = (),
    totals: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add inclusive running sums of ``sums`` along ``order`` within ``group``.

    ``slot`` must not decrease along ``order``; rows that tie on ``order`` are
    numbered arbitrarily, so make the order total where that matters.  ``totals``
    maps a sum to the name of a column for its total over the group.

    The sums before each slot are computed first and, when few enough, broadcast;
    then the data is shuffled once, by (group, slot).
    """
    group = list(group)
    inputs = {f"__in_{i}": (name, value) for i, (name, value) in enumerate(sums.items())}
    rows = df.withColumns({_SLOT: slot, **{key: value for key, (_, value) in inputs.items()}})
    per_slot = rows.groupBy(*group, _SLOT).agg(*[F.sum(key).alias(f"__t{key}") for key in inputs])
    before = Window.partitionBy(*group).orderBy(_SLOT).rowsBetween(Window.unboundedPreceding, -1)
    wanted = {name: key for key, (name, _) in inputs.items()}
    carried, _ = sized_broadcast(
        per_slot.select(
            *group,
            _SLOT,
            *[F.coalesce(F.sum(f"__t{key}").over(before), F.lit(0)).alias(f"__c{key}") for key in inputs],
            *[
                F.sum(f"__t{wanted[name]}").over(Window.partitionBy(*group)).alias(total)
                for name, total in (totals or {}).items()
            ],
        )
    )
    inside = (
        Window.partitionBy(*group, _SLOT).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    joined = attach(rows, carried, [*group, _SLOT])
    return joined.withColumns(
        {
            name: F.coalesce(F.sum(key).over(inside), F.lit(0)) + F.col(f"__c{key}")
            for key, (name, _) in inputs.items()
        }
    ).drop(_SLOT, *inputs, *[f"__c{key}" for key in inputs])


def depth_slots(df: DataFrame, value: str, rows: int = 100_000, name: str = _SLOT + "_depth") -> DataFrame:
    """Add a slot number that never decreases along ``value`` and follows where values lie.

    Coarse magnitude slots are counted first.  Neighbours share a slot until it has about
    ``rows`` rows, and a coarse slot with more is cut into as many parts as its count asks
    for, at most its fine slots.  The counts have at most one row for each magnitude a
    double can have.
    """
    coarse, fine = magnitude_slot(value, COARSE_PER_OCTAVE), magnitude_slot(value, FINE_PER_OCTAVE)
    part = FINE_PER_OCTAVE // COARSE_PER_OCTAVE
    counts = df.groupBy(coarse.alias("__coarse")).agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__coarse").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    table, _ = sized_broadcast(
        counts.select(
            "__coarse", F.floor(before / F.lit(rows)).cast("long").alias("__group"), F.least(F.ceil(F.col("__n") / F.lit(rows)), F.lit(part)).alias("__cut")
        )
    )
    # Fine slots of one coarse slot lie within ``part`` of its first, above or below.
    inside = F.floor((fine - F.col("__coarse") * part + part) * F.col("__cut") / F.lit(part)) + 1
    slot = F.col("__group") * (2 * part + 2) + F.when(F.col("__cut") > 1, inside).otherwise(0)
    return df.withColumn("__coarse", coarse).join(table, "__coarse").withColumn(name, slot).drop("__coarse", "__group", "__cut")


def positions(
    df: DataFrame,
    order: Sequence[Column],
    slot: Column,
    group: Sequence[str] = (),
    name: str = "position",
    size: str | None = None,
) -> DataFrame:
    """Exact 1-based position of every row along ``order`` within ``group``, and,
    when ``size`` is named, the number of rows of the group."""
    totals = {name: size} if size else None
    return prefix_sums(df, {name: F.lit(1).cast("long")}, order, slot, group, totals)


def hash_key(*keys: str) -> Column:
    """Repeatable pseudo-random text of the key columns, the same in any engine."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", *parts))


def hash_positions(
    df: DataFrame,
    key: str,
    group: Sequence[str] = (),
    tie: Sequence[Column] = (),
    name: str = "position",
    size: str | None = None,
    slot_rows: int = 100_000,
) -> DataFrame:
    """Positions along the hash text in column ``key``; slots are hash prefixes.

    The rows are counted first, and the prefix is as long as it takes for a slot to
    hold about ``slot_rows`` rows or fewer, even if they are all in one group.
    """
    rows, digits = df.count(), 1
    while rows > slot_rows * 16**digits:
        digits += 1
    slot = F.substring(F.col(key), 1, digits)
    return positions(df, [F.col(key), *tie], slot, group, name, size)


def rolling(
    df: DataFrame,
    aggregates: Mapping[str, Column],
    order: Sequence[Column],
    slot: Column,
    width: int,
    group: Sequence[str] = (),
    block_rows: int = 100_000,
    keep_position: str | None = None,
) -> DataFrame:
    """Aggregates over the last ``width`` rows, shorter at the start of a series.

    Rows are numbered, cut into blocks, and the last ``width - 1`` rows of a block
    are also handed to the next one, so every block can be computed on its own.
    """
    size = max(block_rows, width)
    numbered = positions(df, order, slot, group, _POS)
    offset = F.col(_POS) - 1
    block = F.floor(offset / F.lit(size)).cast("long")
    in_tail = offset % F.lit(size) >= size - (width - 1)
    copies = numbered.withColumn("__home", block).withColumn(
        "__block",
        F.explode(
            F.when(in_tail, F.array(F.col("__home"), F.col("__home") + 1)).otherwise(
                F.array(F.col("__home"))
            )
        ),
    )
    frame = Window.partitionBy(*group, "__block").orderBy(_POS).rowsBetween(-(width - 1), 0)
    result = (
        copies.withColumns({name: value.over(frame) for name, value in aggregates.items()})
        .where(F.col("__block") == F.col("__home"))
        .drop("__block", "__home")
    )
    if keep_position:
        return result.withColumnRenamed(_POS, keep_position)
    return result.drop(_POS)
