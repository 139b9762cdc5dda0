"""Groups of texts whose five-word shingle sets overlap by three quarters or more.

Exact, by signature trees.  Two sets with that overlap share a token among the first
n - ceil(3n/4) + 1 of either, in any fixed order; tokens that a sample shows to be
frequent come last in it.  All documents with a common token there form one tree:

* a leaf holds up to LEAF documents, sorted by size;
* every node keeps the OR of its documents' token bitmaps and their range of sizes;
* two nodes are compared by the largest overlap that bitmaps and sizes allow, from
  the root down, and only pairs of leaves that may hold a link are opened.

Links found between neighbours in a leaf are joined to components first.  Nodes whose
documents already lie in one component are not compared again, so a large group of
near copies costs about its size, not its square.  Candidates are then decided on
the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palisade.llm.common import arrow_batches, bloom_filters, discard, stored
from palisade.llm.components import components

SHINGLE = 5
LEAF = 64
FANOUT = 16
BITS = 1024
WORDS = BITS // 64
# Frequent tokens: seen in FREQUENT or more of the documents sampled one in SAMPLE.
SAMPLE, FREQUENT, MOST_FREQUENT = 16, 4, 1 << 18
SALTS = 16
PARTNERS = 3
# Bytes of rows that Python gets at a time, and documents or pairs worked on at once.
BATCH_BYTES, AT_ONCE = "4m", 250


def needed(a, b):
    """Smallest overlap of two linked sets of sizes ``a`` and ``b``: ceil(3 (a + b) / 7)."""
    return (3 * (a + b) + 6) // 7


def _mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit words."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# A-Z in lower case; every white space character as a space.
_PLAIN = bytes(32 if c in b" \t\n\v\f\r" else c + 32 if 65 <= c <= 90 else c for c in range(256))
_BYTE = _mix(np.arange(1, 257, dtype=np.uint64))


def _word_block(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the words in ``data``, which ends with a space."""
    raw = np.frombuffer(data, dtype=np.uint8)
    gap = raw == 32
    edge = np.flatnonzero(np.diff(gap, prepend=True))
    start, length = edge[::2], edge[1::2] - edge[::2]
    if not len(start):
        return start, np.zeros(0, np.uint64)
    first = np.cumsum(length) - length
    place = np.arange(length.sum()) - np.repeat(first, length)
    with np.errstate(over="ignore"):
        weight = _mix(np.arange(257, 257 + int(length.max()), dtype=np.uint64)) | np.uint64(1)
        sums = np.add.reduceat(_BYTE[raw[~gap]] * weight[place], first)
        return start, _mix(sums + length.astype(np.uint64))


def shingle_sets(texts: list[bytes | None], size: int = SHINGLE, block: int = 1 << 20) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of each text.

    Fewer words than ``size`` make one shingle; no words make none.  The texts are hashed
    end to end, about ``block`` bytes at a time and cut between words.
    """
    data = b" ".join([*(t or b"" for t in texts), b""]).translate(_PLAIN)
    starts, hashes, low = [], [], 0
    while low < len(data):
        high = data.rfind(b" ", low, low + block) + 1 if low + block < len(data) else len(data)
        if not high:
            high = data.index(b" ", low + block) + 1
        start, h = _word_block(data[low:high])
        starts.append(start + low)
        hashes.append(h)
        low = high
    start = np.concatenate([*starts, np.zeros(0, np.int64)])
    h = np.concatenate([*hashes, np.zeros(0, np.uint64)])
    ends = np.cumsum([len(t or b"") + 1 for t in texts])
    bounds = np.concatenate([[0], np.searchsorted(start, ends)]).tolist()

    def runs(h: np.ndarray, width: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            out = np.full(max(len(h) - width + 1, 0), np.uint64(width))
            for k in range(width):
                out = (out ^ h[k : len(h) - width + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
                out ^= out >> np.uint64(29)
            out *= np.uint64(0xBF58476D1CE4E5B9)
            return out ^ (out >> np.uint64(32))

    whole = runs(h, size)
    return [
        np.unique(whole[a : b - size + 1]) if b - a >= size else runs(h[a:b], b - a) if b > a else np.zeros(0, np.uint64)
        for a, b in zip(bounds, bounds[1:], strict=False)
    ]


def _sets_of(column) -> list[np.ndarray]:
    """Shingle sets of an Arrow string column."""
    return shingle_sets(column.cast(pa.binary()).to_pylist())


def signature(tokens: np.ndarray) -> np.ndarray:
    """Token bitmap of BITS bits as 64-bit words."""
    bits = np.zeros(BITS, dtype=np.uint8)
    bits[(tokens >> np.uint64(17)).astype(np.int64) % BITS] = 1
    return np.packbits(bits, bitorder="little").view("<u8")


def wide_bitmap(tokens: np.ndarray) -> bytes:
    """Token bitmap with eight to sixteen bits for each token, a power of two in all."""
    size = max(BITS, 1 << (8 * max(len(tokens), 1) - 1).bit_length())
    bits = np.zeros(size, dtype=np.uint8)
    bits[(tokens >> np.uint64(17)).astype(np.int64) % size] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def wide_bound(a: bytes, n: int, b: bytes, m: int) -> int:
    """Largest possible overlap of two sets of ``n`` and ``m`` tokens by wide bitmaps; the
    longer bitmap is folded to the length of the shorter."""
    x, y = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
    size = min(len(x), len(y))
    x, y = (np.bitwise_or.reduce(z.reshape(-1, size), axis=0) for z in (x, y))
    count = lambda z: int(np.bitwise_count(z).sum())
    return count(x & y) + min(n - count(x), m - count(y))


def prefix(tokens: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, int]:
    """The tokens of which a linked set must share one, frequent ones last, and how many
    are not frequent."""
    n = len(tokens)
    if not n:
        return tokens, 0
    most = n - (3 * n + 3) // 4 + 1
    if not len(frequent):
        return tokens[:most], most
    at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
    order = np.where(frequent[at] == tokens, rank[at], 0)
    return tokens[np.argsort(order, kind="stable")][:most], min(most, int(np.count_nonzero(order == 0)))


def _sources(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))


def _per_batch(make, schema: str):
    """mapInArrow function calling ``make(ids, list of shingle arrays)`` on small batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(low, AT_ONCE)
                yield make(batch.column(0), _sets_of(batch.column(1)))

    return run, schema


def _i8(values) -> pa.Array:
    return pa.array(np.asarray(values, dtype=np.uint64).view(np.int64))


def _flat(ids, parts: list[np.ndarray], sizes: list[int], names) -> pa.RecordBatch:
    count = np.array([len(p) for p in parts], dtype=np.int64)
    tokens = np.concatenate([*parts, np.zeros(0, np.uint64)])
    return pa.RecordBatch.from_arrays(
        [_i8(tokens), ids.take(pa.array(np.repeat(np.arange(len(parts)), count))), pa.array(np.repeat(np.array(sizes, dtype=np.int32), count))],
        names=names,
    )


def _frequent(source: DataFrame) -> np.ndarray:
    """Tokens with their rank by sampled frequency, at most MOST_FREQUENT of them.

    A bounded hint for the order of tokens; any order gives the same links.
    """
    run, schema = _per_batch(
        lambda ids, sets: _flat(ids, sets, [len(s) for s in sets], ["token", "id", "n"]), "token long, id long, n int"
    )
    some = source.where(F.pmod(F.xxhash64("id"), F.lit(SAMPLE)) == 0).mapInArrow(run, schema)
    top = some.groupBy("token").agg(F.count("*").alias("c")).where(F.col("c") >= FREQUENT)
    rows = top.orderBy(F.desc("c"), "token").limit(MOST_FREQUENT).select("token").toArrow()
    return rows.column(0).to_numpy().view(np.uint64)[::-1]  # most frequent last


def _described(source: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(id, n, key, prefix, rare, extra, bits, wide) per row; equal keys mean equal sets, no
    shingle a null key.

    ``rare``: how many tokens of the prefix, the first ones, are not frequent.  ``bits`` and
    ``wide`` are bitmaps of all tokens; ``extra`` counts the tokens beyond the bits set in ``bits``.

    A key that the task has just seen comes without prefix and bitmaps: many exact copies
    cost no more than their ids.
    """
    import hashlib

    order = np.argsort(frequent)
    names, rank = frequent[order], order + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for whole in batches:
            for low in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(low, AT_ONCE)
                n, keys, rest = [], [], []
                for doc, tokens in zip(batch.column(0), _sets_of(batch.column(1)), strict=True):
                    key = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None
                    n.append(len(tokens))
                    keys.append(key)
                    # A row without an id is dropped before grouping, so it may not stand for its key.
                    if key is None or key in seen or not doc.is_valid:
                        rest.append((None,) * 5)
                        continue
                    if len(seen) > 200_000:
                        seen.clear()
                    seen.add(key)
                    some, few = prefix(tokens, names, rank)
                    bits = signature(tokens)
                    extra = len(tokens) - int(np.bitwise_count(bits).sum())
                    rest.append((some.view(np.int64), few, extra, bits.view(np.int64), wide_bitmap(tokens)))
                kinds = (pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                        *[pa.array(column, kind) for column, kind in zip(zip(*rest, strict=True), kinds, strict=True)],
                    ],
                    names=["id", "n", "key", "prefix", "rare", "extra", "bits", "wide"],
                )

    return source.mapInArrow(run, "id long, n long, key binary, prefix array<long>, rare int, extra int, bits array<long>, wide binary")


def _leaf_batch(token, salt, key, n, done: int, last: bool):
    """Leaves of sorted postings as a batch, and the postings left for the next call.

    ``done``: leaves that the first chain has had before.  The last chain may go on unless
    ``last``; of it at most one leaf is left over, with the leaves it has had.
    """
    new = np.flatnonzero((token[1:] != token[:-1]) | (salt[1:] != salt[:-1])) + 1
    start = np.concatenate([[0], new])
    stop = np.append(start[1:], len(token))
    count = -(-(stop - start) // LEAF)
    held = 0 if last else int(stop[-1] - start[-1] - (count[-1] - 1) * LEAF)
    count[-1] -= not last
    chain = np.repeat(np.arange(len(start)), count)
    no = np.arange(len(chain)) - np.repeat(np.cumsum(count) - count, count)
    low = start[chain] + no * LEAF
    high = np.minimum(low + LEAF, stop[chain])
    no += np.where(chain == 0, done, 0)
    after = high < stop[chain]
    # Places where a posting and the next one have sizes that allow a link.
    fits = np.cumsum(np.append(0, 3 * n[1:].astype(np.int64) <= 4 * n[:-1].astype(np.int64)))
    single = (no == 0) & ~after & (salt[low] < 0)
    keep = np.flatnonzero(~single | (fits[high - 1] > fits[low]))
    low, high, no, after, single = (x[keep] for x in (low, high, no, after, single))
    sizes = high - low
    offsets = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
    at = np.arange(sizes.sum()) + np.repeat(low - (np.cumsum(sizes) - sizes), sizes)
    following = key[np.minimum(high, len(key) - 1)]
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array(token[low]), pa.array(no * SALTS + np.maximum(salt[low], 0)), pa.ListArray.from_arrays(offsets, pa.array(key[at])),
            pa.ListArray.from_arrays(offsets, pa.array(n[at])), pa.array(following, mask=~after), pa.array(single),
        ],
        names=["tree", "idx", "ids", "sizes", "after", "single"],
    )
    rest = slice(len(token) - held, None)
    return batch, [x[rest] for x in (token, salt, key, n)], int(count[-1]) + (done if len(start) == 1 else 0)


def _leaves(postings: DataFrame) -> DataFrame:
    """Leaves of all trees: (tree, idx, ids, sizes, after, single).

    Rows stream through in order of (token, salt, size); a task holds one batch at a
    time.  The postings of a frequent token are spread over SALTS chains of leaves; others
    have the salt -1.  ``after`` is the first document of the next leaf of the chain;
    ``single`` marks a leaf that is a whole tree.  Leaves of one document and trees whose
    sizes rule out any link are left out.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, done = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            more = [b.column(i).to_numpy() for i in range(4)]
            out, held, done = _leaf_batch(*(more if held is None else map(np.append, held, more)), done, False)
            yield out
        if held is not None:
            yield _leaf_batch(*held, done, True)[0]

    dealt = postings.select("token", "salt", "id", "n").repartition("token", "salt").sortWithinPartitions("token", "salt", "n", "id")
    return dealt.mapInArrow(cut, "tree long, idx long, ids array<long>, sizes array<int>, after long, single boolean")


def _forest(postings: DataFrame) -> DataFrame:
    """Leaves with ``weight``: trees of one and the same leaf are kept once."""
    found = stored(_leaves(postings), "leaves")
    same = (
        found.where("single").groupBy("ids", "sizes").agg(F.min("tree").alias("tree"), F.count("*").alias("weight"))
        .select("tree", F.lit(0).cast("long").alias("idx"), "ids", "sizes", F.lit(None).cast("long").alias("after"), "weight")
    )
    rest = found.where("NOT single").select("tree", "idx", "ids", "sizes", "after", F.lit(1).cast("long").alias("weight"))
    forest = stored(same.unionByName(rest), "forest")
    discard(found)
    return forest


def _sets(source: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, tokens) of every text of the ids, which come with the number of their ``pairs``."""

    def make(ids, sets):
        return pa.RecordBatch.from_arrays(
            [ids, pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["id", "tokens"]
        )

    run, schema = _per_batch(make, "id long, tokens array<long>")
    # The condition on ``pairs`` is always met; with it Spark drops other texts by a Bloom
    # filter of the ids before it moves any.
    return source.join(ids.where("pairs > 0"), "id", "left_semi").mapInArrow(run, schema)


def _decided(pairs: DataFrame, source: DataFrame, signed: DataFrame) -> DataFrame:
    """The pairs (a, b) that link: those the wide bitmaps allow, decided on whole sets."""
    of = lambda c: signed.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("wide").alias(f"w{c}"))

    def allowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, AT_ONCE):
                b = whole.slice(low, AT_ONCE)
                n, m = b.column(2).to_pylist(), b.column(4).to_pylist()
                keep = [
                    wide_bound(x, i, y, j) >= needed(i, j)
                    for x, i, y, j in zip(b.column(3).to_pylist(), n, b.column(5).to_pylist(), m, strict=True)
                ]
                yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    may = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "na", "wa", "nb", "wb").mapInArrow(allowed, "a long, b long")
    may = stored(may, "pairs")
    # Stored, so that Spark knows how few texts are asked for before it moves any.
    ids = stored(may.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("pairs")), "asked")
    asked = stored(_sets(source, ids), "sets")
    x = asked.select(F.col("id").alias("a"), F.col("tokens").alias("x"))
    y = asked.select(F.col("id").alias("b"), F.col("tokens").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    links = may.join(x, "a").join(y, "b").where(both * 100 >= 75 * (F.size("x") + F.size("y") - both)).select("a", "b")
    links = stored(links, "links")
    discard(may, ids, asked)
    return links


def _neighbours(forest: DataFrame) -> DataFrame:
    """For every document the neighbour in a leaf with which it shares most tokens."""
    ids, sizes = F.concat("ids", F.filter(F.array("after"), lambda x: x.isNotNull())), F.col("sizes")
    steps = F.transform(
        F.slice(ids, 2, F.greatest(F.size(ids) - 1, F.lit(0))),
        lambda b, i: F.struct(
            F.get(ids, i).alias("a"), b.alias("b"),
            (F.coalesce(F.get(sizes, i + 1), F.get(sizes, i)) * 3 <= F.get(sizes, i) * 4).alias("fits"),
        ),
    )
    pairs = forest.select(F.explode(steps).alias("s"), "weight").where("s.fits AND s.a <> s.b")
    counted = pairs.groupBy("s.a", "s.b").agg(F.sum("weight").alias("w"))
    best = counted.groupBy("b").agg(F.max(F.struct("w", "a")).alias("m"))
    return best.select(F.least("m.a", "b").alias("a"), F.greatest("m.a", "b").alias("b")).distinct()


def _signed(known: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, extra, bits, n, wide) of every text of the wanted ids: its bitmaps, its tokens beyond
    those set in ``bits``, and all its tokens."""
    # Equal keys have equal bitmaps, so any row that carries them stands for all.
    each = known.groupBy("key").agg(
        F.first(F.when(F.col("wide").isNotNull(), F.struct("extra", "bits", F.col("n").cast("int").alias("n"), "wide")), ignorenulls=True).alias("s")
    )
    asked = known.select("id", "key").distinct().join(wanted, "id", "left_semi")
    return asked.join(each, "key").select("id", "s.*")


_MEMBER = "array<struct<n:int,id:long,comp:long,extra:int,bits:array<long>>>"


def _compared(a, b, same: bool):
    """(most, fits): the largest possible overlap of each pair of documents of two leaves,
    and which pairs may link and lie in different components."""
    get = lambda m, k: np.array([x[k] for x in m], dtype=np.int64)
    n, m, c, d = get(a, "n"), get(b, "n"), get(a, "comp"), get(b, "comp")
    left, right = (get(x, "bits").view(np.uint64) for x in (a, b))  # popcounts need unsigned words
    most = np.bitwise_count(left[:, None, :] & right[None, :, :]).sum(axis=2, dtype=np.int64)
    most += np.minimum(get(a, "extra")[:, None], get(b, "extra")[None, :])
    fits = (most >= needed(n[:, None], m[None, :])) & (c[:, None] != d[None, :])
    fits &= 3 * np.maximum(n[:, None], m[None, :]) <= 4 * np.minimum(n[:, None], m[None, :])
    if same:
        fits &= np.arange(len(a))[:, None] != np.arange(len(b))[None, :]
    return most, fits


def _open(a, b, same: bool):
    """Pairs of ids of two leaves that may link."""
    fits = _compared(a, b, same)[1]
    if same:
        fits = np.triu(fits)
    ids, others = [x["id"] for x in a], [x["id"] for x in b]
    return [(min(ids[i], others[j]), max(ids[i], others[j])) for i, j in zip(*(k.tolist() for k in np.nonzero(fits)), strict=True)]


def _partners(leaves: DataFrame) -> DataFrame:
    """For every document the PARTNERS in its leaves with the largest possible overlap,
    as a share of the overlap needed, among those it may link to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 20):
                out: list[list] = [[], [], []]
                for m in whole.slice(low, 20).column(0).to_pylist():
                    most, fits = _compared(m, m, True)
                    ids, n = np.array([x["id"] for x in m]), np.array([x["n"] for x in m])
                    share = np.where(fits, most / np.maximum(needed(n[:, None], n[None, :]), 1), 0.0)
                    at = np.argsort(-share, axis=1, kind="stable")[:, :PARTNERS]
                    value = np.take_along_axis(share, at, axis=1)
                    i, j = np.nonzero(value > 0)
                    for column, values in zip(out, (ids[i], ids[at[i, j]], value[i, j]), strict=True):
                        column += values.tolist()
                kinds = (pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["b", "a", "w"])

    each = leaves.select("left").mapInArrow(run, "b long, a long, w double").groupBy("b", "a").agg(F.max("w").alias("w"))
    rank = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("w"), "a"))
    best = each.withColumn("rank", rank).where(F.col("rank") <= PARTNERS)
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _opened(leaves: DataFrame) -> DataFrame:
    """(a, b) from rows with ``left`` and ``right`` members; a null right means itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 20):
                out = []
                for r in whole.slice(low, 20).to_pylist():
                    same = r["right"] is None
                    out += _open(r["left"], r["left"] if same else r["right"], same)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p[0] for p in out], pa.int64()), pa.array([p[1] for p in out], pa.int64())], names=["a", "b"]
                )

    return leaves.select("left", "right").mapInArrow(run, "a long, b long").distinct()


def _leaf_pairs(leaves: DataFrame, height: int) -> DataFrame:
    """Dual traversal from the roots: pairs (tree, i, j) of different leaves, i < j, that
    may hold a link between components."""
    bit = lambda c: [F.bit_or(F.get(F.col(c), F.lit(i))) for i in range(WORDS)]
    each = leaves.select("tree", "idx", F.explode("left").alias("m")).select("tree", "idx", "m.*")
    levels = [
        each.groupBy("tree", "idx").agg(
            F.min("n").alias("lo"), F.max("n").alias("hi"), F.max("extra").alias("extra"),
            F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.array(*bit("bits")).alias("bits"),
        )
    ]
    levels[0] = stored(levels[0], "nodes")
    for _ in range(height):
        levels.append(
            levels[-1].groupBy("tree", F.floor(F.col("idx") / FANOUT).cast("long").alias("idx")).agg(
                F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("extra").alias("extra"),
                F.min("c0").alias("c0"), F.max("c1").alias("c1"), F.array(*bit("bits")).alias("bits"),
            )
        )
    pairs = levels[height].select("tree", F.col("idx").alias("i"), F.col("idx").alias("j"))
    for level in reversed(levels[:height]):
        side = lambda s: level.select(
            "tree", F.floor(F.col("idx") / FANOUT).cast("long").alias("i" if s == "x" else "j"), F.struct("*").alias(s)
        )
        x, y = F.col("x"), F.col("y")
        most = F.least(x["extra"], y["extra"])
        for k in range(WORDS):
            most = most + F.bit_count(F.get(x["bits"], F.lit(k)).bitwiseAND(F.get(y["bits"], F.lit(k))))
        may = (
            (x["idx"] <= y["idx"])
            & (most >= F.ceil((x["lo"] + y["lo"]) * 3 / 7))
            & (x["lo"] * 3 <= y["hi"] * 4)
            & (y["lo"] * 3 <= x["hi"] * 4)
            & ~((x["c0"] == x["c1"]) & (y["c0"] == y["c1"]) & (x["c0"] == y["c0"]))
        )
        pairs = stored(
            pairs.join(side("x"), ["tree", "i"]).join(side("y"), ["tree", "j"]).where(may)
            .select("tree", x["idx"].alias("i"), y["idx"].alias("j")),
            "traversal",
        )
    return pairs.where("i < j")


def _live(forest: DataFrame, signed: DataFrame, linked: DataFrame) -> DataFrame:
    """Leaves (tree, idx, top, left members) of the trees that are not yet one component."""
    members = forest.select("tree", "idx", F.explode(F.arrays_zip("ids", "sizes")).alias("m")).select(
        "tree", "idx", F.col("m.ids").alias("id"), F.col("m.sizes").alias("n")
    )
    placed = stored(
        members.join(linked.withColumnRenamed("node", "id"), "id", "left").select(
            "tree", "idx", "id", "n", F.coalesce("component", "id").alias("comp")
        ),
        "placed",
    )
    trees = placed.groupBy("tree").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.max("idx").alias("top"))
    live = placed.join(trees.where("c0 < c1").select("tree", "top"), "tree").join(signed.select("id", "extra", "bits"), "id")
    leaves = live.groupBy("tree", "idx", "top").agg(
        F.sort_array(F.collect_list(F.struct("n", "id", "comp", "extra", "bits"))).cast(_MEMBER).alias("left")
    )
    leaves = stored(leaves, "live")
    discard(placed)
    return leaves


def _undecided(leaves: DataFrame) -> DataFrame:
    """All pairs in different components that the trees cannot rule out."""
    inside = _opened(leaves.withColumn("right", F.lit(None).cast(_MEMBER)))
    many = leaves.where("top > 0")
    top = many.agg(F.max("idx")).first()[0]
    if top is None:
        return inside
    height = 1
    while top // FANOUT**height:
        height += 1
    pairs = _leaf_pairs(many, height)
    left = many.select("tree", F.col("idx").alias("i"), "left")
    right = many.select("tree", F.col("idx").alias("j"), F.col("left").alias("right"))
    return inside.unionByName(_opened(pairs.join(left, ["tree", "i"]).join(right, ["tree", "j"]))).distinct()


def _merged(linked: DataFrame, links: DataFrame) -> DataFrame:
    """``linked`` (node, component) after more links (a, b)."""
    of = lambda c: linked.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")
    )
    merged = stored(components(between), "merged")
    old = linked.join(merged.toDF("component", "new"), "component", "left").select(
        "node", F.coalesce("new", "component").alias("component")
    )
    return stored(old.unionByName(merged.join(linked, "node", "left_anti")), "linked")


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles and component_id.

    component_id is the smallest id reachable by links, the own id included.  Texts
    without words (null, empty, blank) have no shingle and no link.  Rows that share
    an id count as one node with the links of all of them; rows without an id are in
    no link of others.  An empty table gives an empty result.  Other columns of ``df``
    are not read.
    """
    with arrow_batches(df.sparkSession, BATCH_BYTES), bloom_filters(df.sparkSession):
        return _groups(df, id_col, text_col)


def _groups(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    source = _sources(df, id_col, text_col)
    frequent = _frequent(source)
    rows = stored(_described(source, frequent), "described")
    known = rows.where("key IS NOT NULL AND id IS NOT NULL")
    classes = known.groupBy("key").agg(F.min("id").alias("id"))
    # Equal keys have equal prefixes, so any row that carries one stands for all.
    heads = known.groupBy("key").agg(
        F.min("id").alias("id"), F.first("n").cast("int").alias("n"),
        F.first(F.when(F.col("prefix").isNotNull(), F.struct("prefix", "rare")), ignorenulls=True).alias("first"),
    )
    postings = heads.select("id", "n", "first.rare", F.posexplode("first.prefix").alias("place", "token")).select(
        "token", F.when(F.col("place") < F.col("rare"), -1).otherwise(F.pmod("id", F.lit(SALTS))).cast("int").alias("salt"), "id", "n"
    )
    forest = _forest(postings)
    wanted = stored(forest.select(F.explode("ids").alias("id")).distinct(), "wanted")
    signed = stored(_signed(known, wanted), "signed")
    linked = stored(components(_decided(_neighbours(forest), source, signed)), "linked")
    # Components grow through their documents' best partners; few remain to be compared.
    live = _live(forest, signed, linked)
    linked = _merged(linked, _decided(_partners(live), source, signed))
    discard(live)
    # Whatever may still link, all of it.
    live = _live(forest, signed, linked)
    linked = _merged(linked, _decided(_undecided(live), source, signed))
    discard(live, signed, forest, wanted)
    final = classes.join(linked.withColumnRenamed("node", "id"), "id", "left").select(
        "key", F.coalesce("component", "id").alias("group")
    )
    # A copy's id may be larger or smaller than other members': the smallest id of the
    # class stands for it, so the smallest node is the smallest id reachable.
    return rows.select("id", "n", "key").join(final, "key", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("group", "id").alias("component_id")
    )


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``df`` that stand for their group: the one with the smallest id.

    All columns stay as they are.  Rows without words or without an id are kept, and so
    are all rows that share the id of a group's first member.
    """
    heads = groups(df, id_col, text_col).where(
        F.col(id_col).isNull() | (F.col("n_shingles") == 0) | (F.col("component_id") == F.col(id_col))
    ).select(F.col(id_col).alias("__id")).distinct()
    kept = df.join(heads, df[id_col].eqNullSafe(heads["__id"]), "left_semi")
    return kept
