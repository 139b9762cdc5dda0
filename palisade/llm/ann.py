"""Approximate nearest neighbours by cosine: NN-descent graph, greedy graph search.

Building: every vector starts with its nearest among the vectors beside it along a few
random directions.  Then, again and again, each node compares its neighbours, forward
and reverse, with each other (neighbours of neighbours), and every node keeps its best
DEGREE, until hardly an edge is new.  All steps are joins and bounded groups: reverse neighbours of a node are
drawn by hash slot, at most DEGREE of them, before anything is grouped.

Searching: each query keeps a beam of the best nodes seen, expands the best unexpanded
ones, and stops when the beam holds none.  Vectors are compared in half precision; at
last all of the beam that rounding could have kept from the best ``k`` is scored on the
original vectors in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palisade.llm.common import discard, stored

DEGREE = 20
DIRECTIONS = 4
BLOCK = 512
DELTA = 0.001  # share of new edges below which the graph is settled
OFFERS = 6  # per node, list and round
BEAM = 448
WIDTH = 64
ENTRIES = 64
# Far beyond what building or searching needs; reaching it is an error.
LIMIT = 500


def clean(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x): usable vectors as doubles, one per id.

    Left out: null ids, null, empty and zero vectors, vectors with null or non-finite
    components, and vectors of another length than most have.  Of rows that share an
    id the smallest vector counts.
    """
    x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    usable = df.select(F.col(id_col).cast("long").alias("id"), x.alias("x")).where(
        F.col("id").isNotNull() & (F.size("x") > 0)
        & ~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        & F.exists("x", lambda v: v != 0)
    )
    lengths = usable.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    usable = usable.where(F.size("x") == (lengths[0]["n"] if lengths else 0))
    return usable.groupBy("id").agg(F.min("x").alias("x"))


def _matrix(column) -> np.ndarray:
    """Rows of an Arrow list column of equal lengths."""
    flat = np.asarray(column.flatten())
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _halves(column) -> np.ndarray:
    """Rows of half-precision vectors stored as binary."""
    if not len(column):
        return np.zeros((0, 0), np.float32)
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float16).reshape(len(column), -1).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, in steps that neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _packed(vectors: DataFrame) -> DataFrame:
    """(id, v, p0..): unit vectors in half precision and their place along directions."""
    names = [f"p{i}" for i in range(DIRECTIONS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _unit(_matrix(b.column(1)))
            along = x @ np.random.default_rng(5).normal(size=(x.shape[1], DIRECTIONS))
            half = x.astype(np.float16)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([r.tobytes() for r in half], pa.binary()), *[pa.array(along[:, i]) for i in range(DIRECTIONS)]],
                names=["id", "v", *names],
            )

    return vectors.mapInArrow(run, "id long, v binary, " + ", ".join(f"{n} double" for n in names))


def _start(packed: DataFrame) -> DataFrame:
    """(id, other, sim): best DEGREE of each vector inside blocks along each direction."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []

        def block(rows):
            ids = np.array([r[0] for r in rows])
            x = np.frombuffer(b"".join(r[1] for r in rows), dtype=np.float16).reshape(len(rows), -1).astype(np.float32)
            s = x @ x.T
            np.fill_diagonal(s, -2)
            k = min(DEGREE, len(rows) - 1)
            at = np.argpartition(-s, k - 1, axis=1)[:, :k]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, k)), pa.array(ids[at].ravel()), pa.array(np.take_along_axis(s, at, axis=1).ravel().astype(np.float32))],
                names=["id", "other", "sim"],
            )

        for b in batches:
            held += zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
            while len(held) >= 2 * BLOCK:
                yield block(held[:BLOCK])
                held = held[BLOCK:]
        if len(held) > 1:
            yield block(held)

    found = None
    for i in range(DIRECTIONS):
        rows = packed.select("id", "v", f"p{i}").repartitionByRange(f"p{i}").sortWithinPartitions(f"p{i}")
        part = rows.select("id", "v").mapInArrow(run, "id long, other long, sim float")
        found = part if found is None else found.unionByName(part)
    return found


def _best(edges: DataFrame) -> DataFrame:
    """The DEGREE best edges of each node; ``old`` tells edges compared before."""
    once = edges.groupBy("id", "other").agg(F.max("sim").alias("sim"), F.max("old").alias("old"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("sim"), "other"))
    return once.withColumn("rank", rank).where(F.col("rank") <= DEGREE).drop("rank")


def _drawn(edges: DataFrame) -> DataFrame:
    """Reverse edges, at most DEGREE per node: the first by hash in each hash slot."""
    slot = F.pmod(F.xxhash64("id", "other"), F.lit(DEGREE))
    return (
        edges.groupBy(F.col("other").alias("node"), slot.alias("slot"))
        .agg(F.min(F.struct(F.xxhash64("other", "id").alias("h"), F.col("id").alias("member"), "old")).alias("m"))
        .select("node", "m.member", "m.old")
    )


def _compare(lists: DataFrame) -> DataFrame:
    """Local joins: members of a node's list offer each other as neighbours."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 500):
                out_id, out_other, out_sim = [], [], []
                for members in whole.column(0).slice(low, 500).to_pylist():
                    ids = np.array([m["member"] for m in members])
                    x = np.frombuffer(b"".join(m["v"] for m in members), dtype=np.float16).reshape(len(ids), -1).astype(np.float32)
                    old = np.array([m["old"] for m in members], dtype=bool)
                    worst = np.array([m["worst"] for m in members], dtype=np.float32)
                    s = x @ x.T
                    s[ids[:, None] == ids[None, :]] = -2
                    s[old[:, None] & old[None, :]] = -2
                    s[s <= worst[:, None]] = -2
                    k = min(OFFERS, len(ids))
                    at = np.argpartition(-s, k - 1, axis=1)[:, :k]
                    got = np.take_along_axis(s, at, axis=1)
                    r, c = np.nonzero(got > -1.5)
                    out_id.append(ids[r])
                    out_other.append(ids[at[r, c]])
                    out_sim.append(got[r, c])
                if out_id:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(c)) for c in (out_id, out_other, out_sim)], names=["id", "other", "sim"]
                    )

    return lists.mapInArrow(run, "id long, other long, sim float")


def build(packed: DataFrame) -> DataFrame:
    """Neighbour graph (id, other, sim, old), improved until it settles."""
    false = F.lit(False).alias("old")
    graph = stored(_best(_start(packed).select("id", "other", "sim", false)), "graph")
    for _ in range(LIMIT):
        # A node keeps its first list position for what it has, and asks its members' vectors.
        lists = graph.select(F.col("id").alias("node"), F.col("other").alias("member"), "old").unionByName(_drawn(graph))
        lists = lists.groupBy("node", "member").agg(F.min("old").alias("old"))
        worst = graph.groupBy(F.col("id").alias("wid")).agg(F.min("sim").alias("worst"), F.count("*").alias("n"))
        known = packed.select("id", "v").join(worst, F.col("id") == F.col("wid"), "left").select(
            F.col("id").alias("member"), "v", F.when(F.col("n") >= DEGREE, F.col("worst")).otherwise(F.lit(-1.0)).cast("float").alias("worst")
        )
        asked = lists.join(known, "member").groupBy("node").agg(
            F.collect_list(F.struct("member", "old", "worst", "v")).alias("members")
        )
        offers = _compare(asked.select("members")).select("id", "other", "sim", false)
        last, graph = graph, stored(_best(graph.withColumn("old", F.lit(True)).unionByName(offers)), "graph")
        discard(last)
        fresh, edges = graph.agg(F.count_if(~F.col("old")), F.count("*")).first()
        if fresh <= DELTA * edges:
            return graph
    raise RuntimeError(f"the neighbour graph has not settled after {LIMIT} rounds")


def search(packed: DataFrame, graph: DataFrame, queries: DataFrame, k: int, beam: int = BEAM) -> DataFrame:
    """(query, id) of the nodes seen for ``queries`` (query, qv) that may be among its best ``k``.

    A query whose id is a node starts at its own neighbours; all queries also start at
    ENTRIES nodes drawn by hash.
    """
    links = stored(
        graph.select(F.col("id").alias("node"), F.col("other").alias("next"))
        .unionByName(_drawn(graph).select("node", F.col("member").alias("next"))).distinct()
        .groupBy("node").agg(F.collect_list("next").alias("next")),
        "links",
    )
    entries = [r["id"] for r in packed.select("id").orderBy(F.xxhash64("id"), "id").limit(ENTRIES).collect()]
    empty = "array<struct<id:long,sim:float,open:boolean>>"
    state = queries.select("query", "qv", F.array().cast(empty).alias("beam"), F.lit(True).alias("busy"))
    asked = queries.select("query", F.explode(F.array(F.col("query"), *[F.lit(e).cast("long") for e in entries])).alias("next"))
    own = queries.select("query", F.col("query").alias("node")).join(links, "node").select("query", F.explode("next").alias("next"))
    asked = asked.unionByName(own)
    schema = f"query long, qv binary, beam {empty}, busy boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 100):
                b = whole.slice(low, 100)
                beams, busy = [], []
                for q, qv, old, found in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                    best = {x["id"]: (x["sim"], False) for x in old}
                    # What was open and among the first WIDTH has just been expanded.
                    left = WIDTH
                    for x in old:
                        if x["open"]:
                            best[x["id"]] = (x["sim"], left <= 0)
                            left -= 1
                    if found:
                        x = np.frombuffer(b"".join(f["v"] for f in found), dtype=np.float16).reshape(len(found), -1)
                        s = x.astype(np.float32) @ np.frombuffer(qv, dtype=np.float16).astype(np.float32)
                        for f, v in zip(found, s.tolist(), strict=True):
                            if f["id"] != q and f["id"] not in best:
                                best[f["id"]] = (v, True)
                    kept = sorted(best.items(), key=lambda i: (-i[1][0], i[0]))[:beam]
                    beams.append([{"id": i, "sim": v, "open": o} for i, (v, o) in kept])
                    busy.append(any(o for _, (_, o) in kept))
                kind = pa.list_(pa.struct([("id", pa.int64()), ("sim", pa.float32()), ("open", pa.bool_())]))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(beams, kind), pa.array(busy, pa.bool_())], names=["query", "qv", "beam", "busy"]
                )

    vectors = packed.select(F.col("id").alias("next"), "v")
    for step in range(LIMIT):
        found = asked.distinct().join(vectors, "next").groupBy("query").agg(
            F.collect_list(F.struct(F.col("next").alias("id"), "v")).alias("found")
        )
        moving = state if step == 0 else state.where("busy")
        moved = moving.join(found, "query", "left").select("query", "qv", "beam", "found").mapInArrow(run, schema)
        last, state = state, stored(moved if step == 0 else moved.unionByName(state.where("NOT busy")), "beams")
        if step:
            discard(last)
        if state.where("busy").isEmpty():
            break
        fresh = F.slice(F.filter("beam", lambda x: x["open"]), 1, WIDTH)
        front = state.where("busy").select("query", F.explode(fresh).alias("f")).select("query", F.col("f.id").alias("node"))
        asked = front.join(links, "node").select("query", F.explode("next").alias("next"))
    else:
        raise RuntimeError(f"queries are still searching after {LIMIT} steps")
    # Half precision moves a component by 2^-11 of itself, so a product of unit vectors by
    # about 2^-10; sums and the smallest components add far less than 2^-22 a dimension.
    off = F.lit(1.01 * 2.0**-10) + F.length("qv") / 2 * F.lit(2.0**-22)
    least = F.when(F.size("beam") >= k, F.get("beam", F.lit(k - 1))["sim"].cast("double") - 2 * off).otherwise(F.lit(-9.0))
    beams = state.select("query", "beam", least.alias("least"))
    close = beams.select("query", F.explode(F.filter("beam", lambda x: x["sim"] >= F.col("least"))).alias("b"))
    return close.select("query", F.col("b.id").alias("id"))


def scored(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """``pairs`` (query, id) with the cosine of the original vectors in doubles."""
    q = vectors.select(F.col("id").alias("query"), F.col("x").alias("qx"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                s = (_unit(_matrix(b.column(2))) * _unit(_matrix(b.column(3)))).sum(axis=1)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s)], names=["query", "id", "score"])

    return pairs.join(q, "query").join(vectors, "id").select("query", "id", "qx", "x").mapInArrow(
        run, "query long, id long, score double"
    )


def nearest(df: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest of every row whose id is divisible by ``every``.

    Returns query_id, rank (from 1), the neighbour's id and score (cosine), nearest
    first, ties to the smaller id.  A query is no neighbour of itself; with fewer other
    vectors all of them are returned.  Which vectors take part: see ``clean``.  An
    empty table gives an empty result; other columns are not read.
    """
    vectors = stored(clean(df, id_col, vector_col), "vectors")
    packed = stored(_packed(vectors), "packed")
    graph = build(packed)
    queries = packed.where(F.col("id") % every == 0).select(F.col("id").alias("query"), F.col("v").alias("qv"))
    found = scored(search(packed, graph, queries, k).distinct(), vectors)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(
        F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score"
    )
