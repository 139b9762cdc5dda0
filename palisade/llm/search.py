"""Ranked search: the best documents for each item of a query set, exactly.

Every task keeps its documents as rows of (term, occurrences), restricted to terms of
the items, and handles them in blocks.  In a block each item's documents get a bitmap
of the item's terms they hold, made by OR-ing one bit for each posting of a term.
Documents of one mask form a group; its maximum score takes, for each term of the
mask, the largest share that any document of the block reaches.  Groups are evaluated
by descending maximum, and an item is finished once the next maximum is below its
``k``-th best score so far, which blocks of a task hand on.

Documents are read once: counts and postings come from the same pass, whose result is
stored.  Items are taken in blocks of ITEM_BYTES, so what is broadcast stays bounded.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.llm.common import stored

ITEM_BYTES = 8 << 20
BLOCK_DOCUMENTS = 8192
BLOCK_POSTINGS = 1 << 22
MERGE = 64  # tasks' results are merged in this many parts for each item, then in one
SHIFT, SCALE, SOFT = 25, 1_000_000_000, 12

# Every ASCII byte that is no letter or digit becomes a space, A-Z become a-z.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
POSTINGS = "doc_id long, n long, terms array<int>, counts array<int>"
FOUND = "item int, score long, doc_id long, part int"


def terms_of(text: bytes | None) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of all other characters beyond ASCII."""
    return (text or b"").translate(FOLD).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def lengths(n: np.ndarray, documents: int, tokens: int) -> np.ndarray:
    """100 - 25 + (25 n N) div L, without overflow."""
    top = SHIFT * int(n.max(initial=0)) * documents
    if top < 2**62:
        return 100 - SHIFT + SHIFT * n * documents // max(tokens, 1)
    exact = [100 - SHIFT + SHIFT * int(x) * documents // max(tokens, 1) for x in n]
    return np.array(exact, dtype=np.int64)


def postings(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, counts) of every document with a term at all."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in batches:
            ids, n, terms, counts = [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = terms_of(text.as_py())
                if not words:
                    continue
                seen = Counter(words)
                held = [(number[w], seen[w]) for w in seen.keys() & number.keys()]
                ids.append(doc)
                n.append(len(words))
                terms.append([t for t, _ in held])
                counts.append([c for _, c in held])
            columns = [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "counts"])

    return source.mapInArrow(run, POSTINGS)


class Block:
    """Documents of a task that are searched together: postings by row and by term."""

    def __init__(self, ids, n, starts, terms, counts, documents: int, tokens: int):
        self.ids, self.starts, self.terms = ids, starts, terms
        m = np.repeat(lengths(n, documents, tokens), np.diff(starts))
        self.shares = SCALE * counts // (1000 * counts + SOFT * m)
        self.order = np.argsort(terms, kind="stable")
        self.rows = np.repeat(np.arange(len(ids)), np.diff(starts))[self.order]
        self.sorted_terms, sorted_shares = terms[self.order], self.shares[self.order]
        self.held, self.first = np.unique(self.sorted_terms, return_index=True)
        self.top = np.maximum.reduceat(sorted_shares, self.first) if len(terms) else sorted_shares
        self.last = np.append(self.first[1:], len(terms))

    def masks(self, item: np.ndarray):
        """(distinct masks as bits x terms, group of each document, documents) of an item's terms."""
        place = np.searchsorted(self.held, item)
        place = np.where(place < len(self.held), place, 0)
        present = np.flatnonzero(self.held[place] == item) if len(self.held) else np.array([], dtype=int)
        words = np.zeros(((len(present) + 63) // 64, len(self.ids)), dtype=np.uint64)
        for bit, j in enumerate(present):
            rows = self.rows[self.first[place[j]] : self.last[place[j]]]
            words[bit >> 6, rows] |= np.uint64(1 << (bit & 63))
        documents = np.flatnonzero(words.any(axis=0)) if len(present) else np.array([], dtype=int)
        group, distinct = np.zeros(len(documents), dtype=np.int64), None
        for word in words:
            _, code = np.unique(word[documents], return_inverse=True)
            _, group = np.unique(group * (code.max(initial=0) + 1) + code, return_inverse=True)
        _, distinct = np.unique(group, return_index=True)
        sample = words[:, documents[distinct]]
        bits = np.array([(sample[b >> 6] >> np.uint64(b & 63)) & np.uint64(1) for b in range(len(present))], dtype=np.int64)
        return bits.reshape(len(present), len(distinct)), present, self.top[place[present]], group, documents

    def scores(self, documents: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Scores of documents under an item's weight for each term of the vocabulary."""
        low, size = self.starts[documents], self.starts[documents + 1] - self.starts[documents]
        at = np.repeat(low - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())
        each = weights[self.terms[at]] * self.shares[at]
        return np.add.reduceat(each, np.append(0, np.cumsum(size)[:-1]))


def search_block(block: Block, item: np.ndarray, weights: np.ndarray, k: int, best: list[tuple]) -> list[tuple]:
    """The ``k`` best (-score, id is null, id) of ``best`` and the block's documents."""
    bits, present, top, group, documents = block.masks(item)
    if not len(documents):
        return best
    maximum = (weights[item[present]] * top) @ bits
    turn = np.argsort(-maximum, kind="stable")
    members = np.argsort(group, kind="stable")
    edges = np.append(0, np.cumsum(np.bincount(group, minlength=len(maximum))))
    at, want = 0, max(k, 16)
    while at < len(turn):
        floor = -best[k - 1][0] if len(best) >= k else 1
        # Equal scores are decided by the id, so groups that can tie are evaluated too.
        chosen, size = [], 0
        while at < len(turn) and size < want and maximum[turn[at]] >= floor:
            g = turn[at]
            chosen.append(members[edges[g] : edges[g + 1]])
            size += edges[g + 1] - edges[g]
            at += 1
        if not chosen:
            break
        some = documents[np.concatenate(chosen)]
        got = block.scores(some, weights)
        keep = np.flatnonzero(got >= max(floor, 1))
        if len(keep) > 4 * k:
            # No document below the k-th largest score of this lot can be among the best.
            least = np.partition(got[keep], len(keep) - k)[len(keep) - k]
            keep = keep[got[keep] >= least]
        new = [(-int(s), block.ids[d] is None, 0 if block.ids[d] is None else block.ids[d]) for s, d in zip(got[keep], some[keep], strict=True)]
        best = sorted([*best, *new])[:k]
        want *= 2
    return best


def _best_of_tasks(stored_postings: DataFrame, items: list[dict[int, int]], weights_of: dict[int, int], size: int,
                   documents: int, tokens: int, k: int) -> DataFrame:
    """(item, score, doc_id, part): the k best documents of every task for each item."""
    shared = stored_postings.sparkSession.sparkContext.broadcast((items, weights_of))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, weighted = shared.value
        numbers = [np.array(sorted(x), dtype=np.int64) for x in held]
        best: list[list[tuple]] = [[] for _ in held]

        def search(ids, n, starts, terms, counts):
            block = Block(ids, n, starts, terms, counts, documents, tokens)
            weights = np.zeros(size, dtype=np.int64)
            for i, (item, repeats) in enumerate(zip(numbers, held, strict=True)):
                weights[item] = [weighted[t] * repeats[t] for t in item.tolist()]
                best[i] = search_block(block, item, weights, k, best[i])
                weights[item] = 0

        for batch in batches:
            low = 0
            offsets = np.asarray(batch.column(2).offsets, dtype=np.int64)
            terms = np.asarray(batch.column(2).values, dtype=np.int64)
            counts = np.asarray(batch.column(3).values, dtype=np.int64)
            n = np.asarray(batch.column(1), dtype=np.int64)
            ids = batch.column(0).to_pylist()
            while low < batch.num_rows:
                high = int(np.searchsorted(offsets, offsets[low] + BLOCK_POSTINGS, side="right")) - 1
                high = min(max(high, low + 1), low + BLOCK_DOCUMENTS, batch.num_rows)
                a, b = offsets[low], offsets[high]
                search(ids[low:high], n[low:high], offsets[low : high + 1] - a, terms[a:b], counts[a:b])
                low = high
        out = [(i, -s, None if null else d) for i, rows in enumerate(best) for s, null, d in rows]
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for low in range(0, len(out), 10_000):
            some = out[low : low + 10_000]
            columns = [pa.array(c, t) for c, t in zip(zip(*some), (pa.int32(), pa.int64(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([part] * len(some), pa.int32())], names=["item", "score", "doc_id", "part"])

    return stored_postings.mapInArrow(run, FOUND)


def _top(df: DataFrame, keys: list[str | Column], k: int) -> DataFrame:
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def _item_blocks(items: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[list[tuple]]:
    """Items as lists of (id, text) of about ``limit`` bytes of text each."""
    source = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    size = source.agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 16)).first()[0] or 0
    blocks = max(1, -(-size // limit))
    for i in range(blocks):
        part = source.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i) if blocks > 1 else source
        yield [(r["item_id"], r["text"]) for r in part.collect()]


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", limit: int = ITEM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item.

    A score sums, over the item's terms with repeats, the term's weight times its share
    in the document; only scores above 0 are returned, ranks start at 1, and equal
    scores go by ascending document id.

    Null, empty and blank texts have no terms: such documents are not counted, such items
    have no results.  Rows that repeat an id are documents, or items, of their own;
    documents without an id count, and come after others of their score.  An item with
    fewer documents gets all of them.  Empty tables give an empty result.  Other columns
    are not read; texts are read whole.
    """
    spark = docs.sparkSession
    result = None
    for block in _item_blocks(items, item_col, item_text, limit):
        names: dict[bytes, int] = {}
        held = [Counter(names.setdefault(w, len(names)) for w in terms_of(t.encode() if t else None)) for _, t in block]
        rows = stored(postings(docs, names, id_col, text_col), "postings")
        documents, tokens = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        # At most one row for each term of this block of items.
        holding = {r["t"]: r["df"] for r in rows.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect()}
        weights = {t: weight(documents, holding.get(t, 0)) for t in names.values()}
        found = _best_of_tasks(rows, [dict(h) for h in held], weights, len(names), documents, tokens, k)
        found = _top(_top(found.withColumn("part", F.col("part") % MERGE), ["item", "part"], k).drop("rank"), ["item"], k)
        schema = "item int, item_id long"
        ids = spark.createDataFrame([(i, key) for i, (key, _) in enumerate(block)], schema)
        some = found.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")
        result = some if result is None else result.unionByName(some)
    return result
