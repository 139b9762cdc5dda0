"""Repair of the turn structure of conversations at least cost, by block tables.

Kept, rerolled and inserted rows must have the roles (system? (user assistant)+)?.  An
automaton of four states reads them, and a row's symbol (role initial, truncated or
not, or to be deleted) turns the vector of costs to finish from each state after the
row into the vector before it.  Less their minimum, only a few such vectors occur.  They
are numbered, and a table gives, for every vector and every block of BLOCK symbols, the
vector before the block and what the minimum grows by.  A conversation is read from its
end, one lookup a block; then blocks are expanded backward, row by row, and followed
forward.  Each edit has one outcome in each state, so taking the first letter among the
cheapest edits gives the ASCII-least audit.

Rows are range-partitioned by conversation and turn and packed into chunks of at most
CHUNK_ROWS.  A conversation that is cut has, for each chunk, a map from the vector after
it to the vector before it and, once that vector is known, from state to state; these
maps are chained in order, so no task holds a long conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.llm.common import stored
from palisade.operators.ordered import attach

BLOCK = 4
CHUNK_ROWS = 1 << 14
SAID = r"[^\x20\x09-\x0D]"
LAST_SAID = r"(?s)([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z"

# States: nothing yet, after system, after user, after assistant.
STATES, NEXT = 4, (2, 2, 3, 2)
ROLES = {2: "user", 3: "assistant"}
MUST_DELETE = 8  # symbols 0 to 3: s, u, a, other; 4 to 7: the same, truncated


class Costs(NamedTuple):
    rerole: int = 3
    delete: int = 4
    insert: int = 3
    truncated: int = 3


# What is done about a row (or at the end): letters, the new role of each, state after.
Edits = tuple[str, tuple, int]


class Tables(NamedTuple):
    """Numbered cost vectors and, by vector after and symbol, what happens before."""

    vectors: list[tuple[int, ...]]
    end: int
    before: list[list[int]]
    edits: list[list[list[Edits]]]  # vector, symbol, state
    final: list[Edits]
    block_before: np.ndarray
    block_grown: np.ndarray


def _kept(state: int, symbol: int) -> int | None:
    """State after keeping a row, if its role may stand there."""
    role = symbol % 4
    if role == 0:
        return 1 if state == 0 else None
    if role == 1:
        return 2 if state != 2 else None
    return 3 if role == 2 and state == 2 else None


def _with_inserts(costs: list[int], insert: int) -> tuple[int, ...]:
    for _ in range(STATES):
        costs = [min(c, insert + costs[NEXT[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


def _options(after: tuple[int, ...], symbol: int, state: int, c: Costs) -> list[tuple[str, int, int]]:
    """(letter, cost to finish, next state) of the edits that use up a row."""
    found = [("D", c.delete + after[state], state)]
    if symbol != MUST_DELETE:
        extra = c.truncated if symbol >= 4 else 0
        kept = _kept(state, symbol)
        if kept is not None:
            found.append(("K", extra + after[kept], kept))
        found.append(("R", c.rerole + extra + after[NEXT[state]], NEXT[state]))
    return found


def tables(c: Costs = Costs()) -> Tables:
    """All tables for these costs; vectors are found by following every symbol."""
    big = 1 << 20
    start = _with_inserts([0, big, big, 0], c.insert)
    number, vectors, before, grown, edits = {start: 0}, [start], [], [], []
    for v in vectors:  # grows while it is read
        row_before, row_grown, row_edits = [], [], []
        for symbol in range(MUST_DELETE + 1):
            own = [_options(v, symbol, q, c) for q in range(STATES)]
            full = _with_inserts([min(o[1] for o in found) for found in own], c.insert)
            least = min(full)
            normal = tuple(x - least for x in full)
            if normal not in number:
                number[normal] = len(vectors)
                vectors.append(normal)
            row_before.append(number[normal])
            row_grown.append(least)
            by_state = []
            for q in range(STATES):
                letters, roles, at = "", [], q
                while not letters or letters[-1] == "I":
                    choices = [(x, to) for x, cost, to in own[at] if cost == full[at]]
                    if c.insert + full[NEXT[at]] == full[at]:
                        choices.append(("I", NEXT[at]))
                    letter, at = min(choices)
                    letters += letter
                    roles.append(ROLES[at] if letter in "IR" else None)
                by_state.append((letters, tuple(roles), at))
            row_edits.append(by_state)
        before.append(row_before)
        grown.append(row_grown)
        edits.append(row_edits)
    one, plus = np.array(before), np.array(grown, dtype=np.int64)
    count, symbols = one.shape
    codes = np.array(list(product(range(symbols), repeat=BLOCK)))
    at = np.repeat(np.arange(count)[:, None], len(codes), axis=1)
    total = np.zeros_like(at)
    for place in range(BLOCK - 1, -1, -1):
        total += plus[at, codes[:, place]]
        at = one[at, codes[:, place]]
    final = [("", (), 0), ("II", ("user", "assistant"), 3), ("I", ("assistant",), 3), ("", (), 3)]
    return Tables(vectors, 0, before, edits, final, at, total)


def _codes(symbols: np.ndarray) -> tuple[int, list[int]]:
    """(rows before the first whole block, codes of the blocks in order)."""
    head = len(symbols) % BLOCK
    if len(symbols) == head:
        return head, []
    weights = (MUST_DELETE + 1) ** np.arange(BLOCK - 1, -1, -1)
    return head, (symbols[head:].astype(np.int64).reshape(-1, BLOCK) @ weights).tolist()


def chunk_map(symbols: np.ndarray, t: Tables) -> list[int]:
    """Vector before a chunk for every vector after it."""
    at = np.arange(len(t.before))
    head, codes = _codes(symbols)
    for code in reversed(codes):
        at = t.block_before[at, code]
    one = np.array(t.before)
    for s in symbols[:head][::-1]:
        at = one[at, s]
    return at.tolist()


def trace(symbols: np.ndarray, after: int, state: int, last: bool, t: Tables) -> tuple[list[Edits], int]:
    """(edits for each row and, in the last chunk, for the end; state after)."""
    head, codes = _codes(symbols)
    bounds = [after]
    for code in reversed(codes):
        bounds.append(int(t.block_before[bounds[-1], code]))
    spans = [(low, low + BLOCK) for low in range(head, len(symbols), BLOCK)]
    if head:
        spans.insert(0, (0, head))
    else:
        bounds.pop()
    out, plain = [], symbols.tolist()
    for (low, high), right in zip(spans, reversed(bounds), strict=True):
        inside = [right]
        for s in reversed(plain[low + 1 : high]):
            inside.append(t.before[inside[-1]][s])
        for s, vector in zip(plain[low:high], reversed(inside), strict=True):
            out.append(t.edits[vector][s][state])
            state = out[-1][2]
    if last:
        out.append(t.final[state])
        state = out[-1][2]
    return out, state


# ---- faults -----------------------------------------------------------------


def _rows(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Stored rows with a number of their own; null roles and texts are one space."""
    said = F.coalesce(F.col(text), F.lit(" "))
    return stored(
        df.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(conv).alias("conv"),
            F.col(turn).cast("long").alias("turn"),
            F.coalesce(F.col(role), F.lit(" ")).alias("role"),
            said.alias("text"),
        ),
        "conversation-rows",
    )


def _judged(rows: DataFrame) -> DataFrame:
    """(row, conv, turn, role, digest, initial, fault): the first fault of each row."""
    slim = rows.select(
        "row", "conv", "turn", "role",
        F.sha2(F.concat("role", F.lit("\n"), "text"), 256).alias("digest"),
        F.substring("role", 1, 1).alias("initial"),
        F.col("text").rlike(SAID).alias("said"),
        F.regexp_extract("text", LAST_SAID, 1).alias("last"),
    )
    # Structs compare field by field and nulls come first, as turns do.
    first = slim.groupBy("conv", "digest").agg(F.min(F.struct("turn", "row"))["row"].alias("row"))
    joined = slim.join(first.select("row", F.lit(True).alias("first")), "row", "left")
    fault = (
        F.when(~F.col("said"), "blank")
        .when(F.col("first").isNull(), "duplicate")
        .when(~F.col("last").isin(".", "!", "?"), "truncated")
    )
    return joined.withColumn("fault", fault).select("row", "conv", "turn", "role", "digest", "initial", "fault")


PACKED = T.StructType(
    [
        T.StructField("conv", T.StringType()),
        T.StructField("chunk", T.LongType()),
        T.StructField("whole", T.BooleanType()),
        T.StructField("rows", T.ArrayType(T.LongType())),
        T.StructField("symbols", T.BinaryType()),
        T.StructField("first", T.StringType()),
        T.StructField("last", T.StringType()),
        T.StructField("illegal", T.LongType()),
        T.StructField("map", T.ArrayType(T.IntegerType())),
    ]
)
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def _arrow(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _packed(judged: DataFrame, costs: Costs) -> DataFrame:
    """Chunks of consecutive rows of one conversation; chunks of a conversation ascend.

    A chunk is ``whole`` when it is a conversation's only one: neither the first nor the
    last conversation of its task, which may go on in another, nor cut by its size.
    """
    role = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), MUST_DELETE).when(F.col("fault") == "truncated", role + 4).otherwise(role)
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "digest", "row")]
    source = judged.repartitionByRange(*order).sortWithinPartitions(*order).select(
        F.col("conv").cast("string").alias("conv"), "row", "initial", symbol.cast("int").alias("symbol")
    )
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.binary(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        t = tables(costs)
        chunk = TaskContext.get().partitionId() << 33
        current, ids, symbols, initials, edge, before = None, [], [], [], True, None
        out = []

        def close(whole: bool):
            nonlocal chunk, before
            illegal = sum(pair not in LEGAL for pair in zip(initials, initials[1:]))
            made = np.array(symbols, dtype=np.uint8)
            out.append((current, chunk, whole, ids, made.tobytes(), initials[0], initials[-1], illegal, None if whole else chunk_map(made, t)))
            chunk += 1

        for batch in batches:
            for conv, row, initial, symbol in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if ids and (conv != current or len(ids) == CHUNK_ROWS):
                    cut = conv == current
                    close(not edge and not cut)
                    edge, ids, symbols, initials = cut, [], [], []
                current = conv
                ids.append(row)
                symbols.append(symbol)
                initials.append(initial)
            if len(out) >= 1000:
                yield _arrow(out, PACKED.names, kinds)
                out = []
        if ids:
            close(False)
        yield _arrow(out, PACKED.names, kinds)

    return stored(source.mapInArrow(run, PACKED), "conversation-chunks")


def _in_order(df: DataFrame, *order: Column) -> DataFrame:
    return df.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), *order)


def _backward(chunks: DataFrame, costs: Costs) -> DataFrame:
    """(conv, chunk, after, final, joint): vector after each chunk of a cut conversation,
    whether it is the last one, and whether its last row and the next are an illegal pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, after, following, started = None, 0, None, False
        end = tables(costs).end
        for batch in batches:
            out = []
            for conv, chunk, first, last, mapped in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not started or conv != current:
                    current, after, following, started = conv, end, None, True
                joint = following is not None and (last, following) not in LEGAL
                out.append((conv, chunk, after, following is None, joint))
                after, following = mapped[after], first
            yield _arrow(out, names, kinds)

    names = ["conv", "chunk", "after", "final", "joint"]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_()]
    cut = chunks.where("NOT whole").select("conv", "chunk", "first", "last", "map")
    return _in_order(cut, F.desc("chunk")).mapInArrow(run, "conv string, chunk long, after int, final boolean, joint boolean")


def _forward(chunks: DataFrame, costs: Costs) -> DataFrame:
    """(chunk, state, position): state and number of edits before each chunk of a cut
    conversation.  Every chunk is traced from each state first, each in a task of its own."""

    def try_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tables(costs)
        for batch in batches:
            out = []
            for conv, chunk, symbols, after, final in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                made = np.frombuffer(symbols, dtype=np.uint8)
                got = [trace(made, after, q, final, t) for q in range(STATES)]
                out.append((conv, chunk, [q for _, q in got], [sum(len(e[0]) for e in x) for x, _ in got]))
            yield _arrow(out, ["conv", "chunk", "to", "size"], [pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())])

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, position, started = None, 0, 0, False
        for batch in batches:
            out = []
            for conv, chunk, to, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not started or conv != current:
                    current, state, position, started = conv, 0, 0, True
                out.append((chunk, state, position))
                state, position = to[state], position + size[state]
            yield _arrow(out, ["chunk", "state", "position"], [pa.int64(), pa.int32(), pa.int64()])

    tried = chunks.select("conv", "chunk", "symbols", "after", "final").mapInArrow(
        try_all, "conv string, chunk long, to array<int>, size array<long>"
    )
    return _in_order(tried, F.col("chunk")).mapInArrow(chain, "chunk long, state int, position long")


STEP = "conv string, position long, edit string, row long, new_role string"


def _edits(chunks: DataFrame, costs: Costs) -> DataFrame:
    """(conv, position, edit, row, new_role) for every edit of every chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tables(costs)
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
        names = ["conv", "position", "edit", "row", "new_role"]
        for batch in batches:
            out = []
            for conv, rows, symbols, after, final, state, position in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                made, _ = trace(np.frombuffer(symbols, dtype=np.uint8), after, state, final, t)
                for row, (letters, roles, _) in zip([*rows, None], made, strict=False):
                    for letter, role in zip(letters, roles, strict=True):
                        out.append((conv, position, letter, None if letter == "I" else row, role))
                        position += 1
                if len(out) >= 10_000:
                    yield _arrow(out, names, kinds)
                    out = []
            yield _arrow(out, names, kinds)

    return chunks.select("conv", "rows", "symbols", "after", "final", "state", "position").mapInArrow(run, STEP)


# ---- interface --------------------------------------------------------------


class Repaired(NamedTuple):
    """``steps``: (conv, position, edit, role, text, fault, cost), edits in order: K keeps,
    R gives a new role, D deletes (role and text are those of the row) and I inserts an
    empty text.  ``faults``: (conv, gaps, blank, duplicate, truncated, illegal)."""

    steps: DataFrame
    faults: DataFrame


def damage(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Conversations with planted faults, chosen by crc32(conv:turn) modulo 20.

    0 drops a row, 1 empties its text, 2 removes its full stops, exclamation and question
    marks, 3 repeats it and 4 sets its role to user.  Nulls of the key, of roles and of
    texts are one space.  Other columns are not kept.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_col, turn_col)])
    text, role = F.coalesce(F.col(text_col), F.lit(" ")), F.coalesce(F.col(role_col), F.lit(" "))
    kind = F.col("__kind")
    return (
        df.select(F.pmod(F.crc32(key.cast("binary")), F.lit(20)).alias("__kind"), F.col(conv_col), F.col(turn_col), role.alias(role_col), text.alias(text_col))
        .where(kind != 0)
        .select(
            conv_col,
            turn_col,
            F.when(kind == 4, "user").otherwise(F.col(role_col)).alias(role_col),
            F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text_col, "[.!?]", "")).otherwise(F.col(text_col)).alias(text_col),
            F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("__copy"),
        )
        .drop("__copy")
    )


def repair(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", costs: Costs = Costs()) -> Repaired:
    """Cheapest edits that give every conversation the roles (system? (user assistant)+)?.

    Rows are taken by turn, nulls first; rows of one turn by role and by a hash of their
    text.  Keep costs nothing, and blank texts and repeated (role, text) must be deleted.
    Texts are not altered.  Null roles and texts are one space, so they are no known role
    and blank.  Rows without a conversation form one of their own.  Very long texts and
    repeated rows are no special case; an empty table gives empty results; other columns
    are not read.
    """
    kind = df.schema[conv_col].dataType
    rows = _rows(df, conv_col, turn_col, role_col, text_col)
    judged = stored(_judged(rows), "conversation-faults")
    chunks = _packed(judged, costs)
    back = stored(_backward(chunks, costs), "conversation-vectors")
    cut = chunks.where("NOT whole").join(back.select("chunk", "after", "final"), "chunk")
    whole = chunks.where("whole").withColumns({"after": F.lit(tables(costs).end), "final": F.lit(True), "state": F.lit(0), "position": F.lit(0).cast("long")})
    edits = _edits(whole.unionByName(cut.join(_forward(cut, costs), "chunk")), costs)

    extra = F.when(F.col("fault") == "truncated", costs.truncated).otherwise(0)
    price = F.when(F.col("edit") == "D", costs.delete).when(F.col("edit") == "R", costs.rerole + extra).otherwise(extra)
    known = rows.select("row", "role", "text").join(judged.select("row", "fault"), "row")
    edited = edits.where("row IS NOT NULL").join(known, "row").select(
        "conv", "position", "edit", F.coalesce("new_role", "role").alias("role"), "text", "fault", price.alias("cost")
    )
    inserted = edits.where("row IS NULL").select(
        "conv", "position", "edit", F.col("new_role").alias("role"), F.lit("").alias("text"),
        F.lit(None).cast("string").alias("fault"), F.lit(costs.insert).alias("cost"),
    )
    named = lambda t: t.withColumn("conv", F.col("conv").cast(kind))

    counts = judged.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
    )
    pairs = chunks.select("conv", "illegal").unionByName(back.select("conv", F.col("joint").cast("long").alias("illegal")))
    illegal = named(pairs.groupBy("conv").agg(F.sum("illegal").alias("illegal")))
    return Repaired(named(edited.unionByName(inserted)), attach(counts, illegal, ["conv"]))


def digests(steps: DataFrame) -> DataFrame:
    """(conv, audit, cost, repaired_sha256) of every conversation with steps.

    A hash of all rows of a conversation can only be taken in order, so its rows pass
    through one task; they are streamed, and none is held.
    """
    kind = steps.schema["conv"].dataType
    source = _in_order(steps, F.col("position")).select(
        F.col("conv").cast("string"), "edit", F.col("cost").cast("long"), F.concat("role", F.lit(":"), "text").cast("binary")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, started, out = None, False, []
        letters, total, seal, empty = [], 0, hashlib.sha256(), True
        done = lambda: out.append((current, "".join(letters), total, seal.hexdigest()))
        for batch in batches:
            for conv, edit, cost, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not started or conv != current:
                    if started:
                        done()
                    current, started = conv, True
                    letters, total, seal, empty = [], 0, hashlib.sha256(), True
                letters.append(edit)
                total += cost
                if edit != "D":
                    seal.update(line if empty else b"\n" + line)
                    empty = False
            if len(out) >= 1000:
                yield _arrow(out, names, kinds)
                out.clear()
        if started:
            done()
        yield _arrow(out, names, kinds)

    names = ["conv", "audit", "cost", "repaired_sha256"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string()]
    got = source.mapInArrow(run, "conv string, audit string, cost long, repaired_sha256 string")
    return got.withColumn("conv", F.col("conv").cast(kind))


def report(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", costs: Costs = Costs()) -> DataFrame:
    """One row for each conversation of ``df``, as it is after ``damage`` and ``repair``."""
    done = repair(damage(df, conv_col, turn_col, role_col, text_col), conv_col, turn_col, role_col, text_col, costs)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    parts = df.select(F.col(conv_col).alias("conv")).distinct()
    for more in (done.faults, digests(done.steps)):
        parts = parts.unionByName(more, allowMissingColumns=True)
    return parts.groupBy(F.col("conv").alias(conv_col)).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.sha2(F.lit(b""), 256)).alias("repaired_sha256"),
    )
