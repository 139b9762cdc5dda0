"""Shards of equal bytes by best-fit-decreasing bin packing.

Groups of equal texts are indivisible.  Groups above a thousandth of a shard are
items of their own; the others are dealt by hash into a thousand lots per shard,
which are items too, so packing sees at most 2,000 items per shard whatever the
table.  Items go, largest first, into the bin with the tightest room that holds them;
the capacity is the smallest for which the given number of shards suffices.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.operators.ordered import attach

LOTS_PER_SHARD = 1000
ROW_BYTES = 16
# Rows of a shard that one task numbers.
SLOT_ROWS = 100_000


def best_fit(sizes: list[int], bins: int, capacity: int) -> list[int] | None:
    """Bin of each size (in descending order), or None when they do not fit.

    The open bins stand in a sorted list of (room, bin): the first with enough room is
    the tightest.
    """
    rooms = [(capacity, b) for b in range(bins)]
    out = []
    for size in sizes:
        at = bisect_left(rooms, (size, -1))
        if at == len(rooms):
            return None
        room, b = rooms.pop(at)
        insort(rooms, (room - size, b))
        out.append(b)
    return out


def balanced(items: list[tuple[int, str]], bins: int) -> dict[str, int]:
    """Bin of each (size, name): best fit decreasing at the smallest capacity that works.

    An item above the mean room gets a bin of its own, and the rest share the others.
    """
    order = sorted(items, key=lambda x: (-x[0], x[1]))
    out: dict[str, int] = {}
    free = bins
    total = sum(s for s, _ in order)
    while order and free > 1 and order[0][0] * free > total:
        size, name = order.pop(0)
        free -= 1
        out[name] = free
        total -= size
    if not order:
        return out
    sizes = [s for s, _ in order]
    low, high = max(-(-total // free), sizes[0]), max(2 * -(-total // free), sizes[0]) + sizes[0]
    found = best_fit(sizes, free, high)
    while high - low > max(1, low // 100_000):
        middle = (low + high) // 2
        tried = best_fit(sizes, free, middle)
        if tried is None:
            low = middle + 1
        else:
            found, high = tried, middle
    out.update(zip((n for _, n in order), found, strict=True))
    return out


def numbered(df: DataFrame, group: str, order: list[str], name: str, part: Column, parts: int) -> DataFrame:
    """Add the gapless position from 0 of each row in its group.

    Each group is cut into ``parts`` by ``part``; rows are numbered inside a part, and
    the parts' sizes, a table of groups times parts, give the rows before it.
    """
    rows = df.withColumn("__part", part)
    counts = rows.groupBy(group, "__part").agg(F.count("*").alias("__c"))
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(group, "__part", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(group, "__part").orderBy(*order)
    ranked = rows.withColumn("__in", F.row_number().over(inside) - 1)
    return attach(ranked, starts, [group, "__part"]).withColumn(
        name, (F.col("__before") + F.col("__in")).cast("long")
    ).drop("__part", "__in", "__before")


def shard(df: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, size, text_crc32, law, shard, slot, grown_shard.

    Size: UTF-8 bytes of the text (null: none) and 16.  Null and empty texts are one
    group.  A group larger than an even share has a shard nearly to itself, and the
    others stay equal.  Repeated rows are placed one by one.  An empty table gives an
    empty result; with fewer items than shards some shards stay empty.  Other columns
    are not read.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    lots = shards * LOTS_PER_SHARD
    rows = df.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.md5(text).alias("name"),
    ).withColumn("lot", F.concat(F.lit("#"), F.pmod(F.xxhash64("name"), F.lit(lots)).cast("string")))
    groups = rows.groupBy("name", "lot").agg(F.sum("size").alias("bytes"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    # A table of at most ``lots`` rows: so many groups can exceed that share of the total.
    large = groups.where(F.col("bytes") * lots > total).select("name", "bytes").collect()
    names = spark.createDataFrame([(r["name"],) for r in large], "name string")
    small = groups.join(F.broadcast(names), "name", "left_anti").groupBy("lot").agg(F.sum("bytes").alias("bytes"))
    items = [(r["bytes"], r["name"]) for r in large] + [(r["bytes"], r["lot"]) for r in small.collect()]
    placed = balanced(items, shards)
    schema = T.StructType([T.StructField("item", T.StringType()), T.StructField("shard", T.IntegerType())])
    # At most 2 * lots rows each, by construction.
    own = spark.createDataFrame([(k, v) for k, v in placed.items() if k[0] != "#"], schema)
    lot = spark.createDataFrame([(k, v) for k, v in placed.items() if k[0] == "#"], schema)
    dealt = rows.join(F.broadcast(own.toDF("name", "own")), "name", "left").join(
        F.broadcast(lot.toDF("lot", "dealt")), "lot", "left"
    ).select("id", "size", "text_crc32", F.coalesce("own", "dealt").alias("shard"))
    n = dealt.count()
    parts = max(4, -(-n // (shards * SLOT_ROWS)))
    cut = F.pmod(F.xxhash64("id", "text_crc32"), F.lit(parts))
    result = numbered(dealt.withColumn("__cut", cut), "shard", ["id", "text_crc32"], "slot", F.col("__cut"), parts)
    return result.select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
