"""Tool calls of conversations: linked to results, ordered, validated, serialised.

All native: calls and results are joined by identifier, dependencies are resolved by
doubling jumps along chains and in rounds where chains meet, arguments are parsed as
variants and checked against a table of fields, and JSON is written with sorted keys.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.llm.common import stored
from palisade.operators.ordered import attach

# Turns of a block and depths of a band that are numbered together.
ORDER_BLOCK, BAND = 10_000, 1000


class Field(NamedTuple):
    """A field of a tool's arguments: its type as Spark names a variant's."""

    tool: str
    name: str
    kind: str
    required: bool


def _errors(name: Column, arguments: Column, parsed: Column, fields: list[Field]) -> Column:
    """Array of what is wrong with a call's arguments, in the order of ``fields``."""
    tools = sorted({f.tool for f in fields})
    found = [
        F.when(name.isNull() | ~name.isin(tools), F.lit("unknown tool")),
        F.when(parsed.isNull(), F.lit("invalid json")).when(
            ~F.schema_of_variant(parsed).startswith("OBJECT"), F.lit("not an object")
        ),
    ]
    for f in fields:
        value = F.try_variant_get(parsed, f"$.{f.name}", "variant")
        kind = F.schema_of_variant(value)
        absent = value.isNull() | F.is_variant_null(value)
        wrong = ~absent & (kind != f.kind)
        problem = F.when(wrong, F.lit(f"{f.name}: not {f.kind}"))
        if f.required:
            problem = F.when(absent, F.lit(f"{f.name}: missing")).otherwise(problem)
        found.append(F.when((name == f.tool) & parsed.isNotNull(), problem))
    return F.filter(F.array(*found), lambda e: e.isNotNull())


def _jumps(single: DataFrame) -> DataFrame:
    """(conv, call, root, steps, done) of calls with one need: the end of the chain of such
    calls before it and its distance, found by doubling jumps; not done on a cycle."""
    jumps = stored(single.withColumns({"steps": F.lit(1).cast("long"), "done": F.lit(False)}), "jumps")
    longest = jumps.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    for _ in range(int(longest).bit_length() + 1):  # the last one sees that nothing follows
        hop = jumps.select("conv", F.col("call").alias("root"), F.col("root").alias("next"), F.col("steps").alias("more"))
        moved = jumps.where("NOT done").join(hop, ["conv", "root"], "left").select(
            "conv", "call", F.coalesce("next", "root").alias("root"),
            (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), F.col("next").isNull().alias("done"),
        )
        jumps = stored(moved.unionByName(jumps.where("done")), "jumps")
        if jumps.where("NOT done").isEmpty():
            break
    return jumps


def _depths(calls: DataFrame, needs: DataFrame) -> DataFrame:
    """(conv, call, depth): 0 without needs, else one more than the deepest of them.

    Calls with one need follow their chain in a logarithm of its length; those with more
    take a round for each such call on the longest path.  Calls on a cycle, or behind
    one, have no row.
    """
    edges = stored(needs, "needs")
    key = ["conv", "call"]
    counted = stored(edges.groupBy(*key).agg(F.count("*").alias("c"), F.min("need").alias("root")), "counted")
    placed = calls.select(*key).distinct().join(counted, key, "left_anti").withColumn("depth", F.lit(0).cast("long"))
    placed = stored(placed, "placed")
    jumps = _jumps(counted.where("c = 1").select(*key, "root"))
    ends = jumps.select("conv", F.col("call").alias("need"), "root", "steps")
    pending = edges.join(counted.where("c > 1").select(*key), key, "left_semi").join(ends, ["conv", "need"], "left")
    pending = stored(
        pending.select(*key, F.coalesce("root", "need").alias("root"), F.coalesce("steps", F.lit(0)).alias("steps")), "pending"
    )
    while not pending.isEmpty():
        at = placed.select("conv", F.col("call").alias("root"), "depth")
        tried = pending.join(at, ["conv", "root"], "left").groupBy(*key).agg(
            F.max(F.col("depth").isNull()).alias("missing"), (F.max(F.col("depth") + F.col("steps")) + 1).alias("depth")
        )
        ready = stored(tried.where("NOT missing").select(*key, "depth"), "ready")
        if ready.isEmpty():
            break
        placed = placed.unionByName(ready)
        pending = stored(pending.join(ready, key, "left_anti"), "pending")
    at = placed.select("conv", F.col("call").alias("root"), "depth")
    chained = jumps.where("done").join(at, ["conv", "root"]).select(*key, (F.col("depth") + F.col("steps")).alias("depth"))
    return placed.unionByName(chained)


def _positioned(rows: DataFrame) -> DataFrame:
    """Add ``position``, from 0 in each conversation by depth, turn and call.

    Rows are numbered inside a cell (depth, block of turns); the rows before a cell are
    summed over the bands of depths before its own and the cells before it in its band,
    so no task sees a whole conversation.
    """
    cell = ["conv", "__band", "__depth", "__block"]
    depth = F.coalesce("depth", F.lit(2**62))
    rows = rows.withColumns(
        {"__depth": depth, "__band": F.floor(depth / BAND), "__block": F.floor(F.col("turn") / ORDER_BLOCK)}
    )
    cells = rows.groupBy(*cell).agg(F.count("*").alias("__c"))
    bands = cells.groupBy("conv", "__band").agg(F.sum("__c").alias("__c"))
    earlier = lambda w: F.coalesce(F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bands = bands.select("conv", "__band", earlier(Window.partitionBy("conv").orderBy("__band")).alias("__low"))
    inner = earlier(Window.partitionBy("conv", "__band").orderBy("__depth", "__block"))
    starts = cells.withColumn("__inner", inner).join(bands, ["conv", "__band"]).select(
        *cell, (F.col("__low") + F.col("__inner")).alias("__before")
    )
    ranked = rows.withColumn("__in", F.row_number().over(Window.partitionBy(*cell).orderBy("turn", "call")) - 1)
    return attach(ranked, starts, cell).withColumn("position", (F.col("__before") + F.col("__in")).cast("long")).drop(
        "__band", "__depth", "__block", "__in", "__before"
    )


def link(calls: DataFrame, results: DataFrame, fields: list[Field]) -> DataFrame:
    """One row per call: position, depth, matched, errors and json.

    ``calls``: conv, call, turn, name, arguments (JSON text), needs (array of call ids
    of the same conversation).  ``results``: conv, call, content.  The first row of a
    call id counts (smallest turn, then name, then arguments), and of its results the
    smallest content.  Calls without an id, and results without a call, are dropped.
    Needs that name no call are ignored.  A call on or behind a cycle has a null depth
    and position and the error "cycle".  Positions count from 0 in each conversation, by
    depth, then turn, then id.  Other columns are not read; empty tables give no rows.
    """
    key = ["conv", "call"]
    first = F.min(F.struct("turn", "name", "arguments", "needs")).alias("c")
    own = calls.where("call IS NOT NULL AND conv IS NOT NULL").groupBy("conv", "call").agg(first).select("conv", "call", "c.*")
    own = stored(own, "calls")
    asked = own.select("conv", "call", F.explode("needs").alias("need")).distinct()
    asked = asked.join(own.select("conv", F.col("call").alias("need")), ["conv", "need"]).select("conv", "call", "need")
    depths = _depths(own, asked)
    answers = results.groupBy("conv", "call").agg(F.min("content").alias("content"), F.lit(True).alias("matched"))
    rows = own.join(depths, key, "left").join(answers, key, "left").withColumn("parsed", F.try_parse_json("arguments"))
    errors = _errors(F.col("name"), F.col("arguments"), F.col("parsed"), fields)
    errors = F.concat(errors, F.when(F.col("depth").isNull(), F.array(F.lit("cycle"))).otherwise(F.array().cast("array<string>")))
    body = F.to_json(
        F.struct(
            F.col("parsed").alias("arguments"), F.col("call").alias("id"), F.col("name"), F.col("content").alias("result")
        ),
        {"ignoreNullFields": "false"},
    )
    rows = rows.select(
        "conv", "call", "turn", "depth", F.coalesce("matched", F.lit(False)).alias("matched"), errors.alias("errors"), body.alias("json")
    )
    return _positioned(rows).withColumn("position", F.when(F.col("depth").isNotNull(), F.col("position")))
