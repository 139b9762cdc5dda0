"""Mixture-controlled packing of tokenised documents into fixed windows.

Every source is a queue of tokens.  The queues are served by deficit round-robin
with a quantum of QUANTUM tokens: packet k of a queue with rate r falls due at
(2k + 1) / 2r, and packets enter windows in the order of their due times.  So each
window holds the sources in proportion to their rates, up to one quantum, and what a
source lacks in one window is made up in the next.  The rate is the queue's number of
packets (the natural mix) or follows given target shares.  Due times depend on totals
only, so Spark places all packets by counting those due before: deficits carry over
windows and partitions without a running state, for any number of queues.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.llm.common import discard, stored
from palisade.operators.ordered import prefix_sums

WINDOW = 1024
QUANTUM = 128
END = 0
# Packets are counted in slots of due time: at most SLOTS per round of all queues, and
# none that would hold fewer than SLOT_PACKETS.
SLOTS, SLOT_PACKETS = 1 << 16, 1 << 13


class _Pieces(dict):
    """Token ids (two bytes each) of chunks of text that start a new pre-token."""

    LIMIT = 400_000

    def __init__(self, tokenizer: str, ranks: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        # The same vocabulary; the faster library for texts without special tokens.
        self.plain = tiktoken.Encoding(
            "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
        ).encode_ordinary
        self.file, self.exact = tokenizer, None

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[chunk] = np.array(self.plain(chunk), dtype="<u2").tobytes()
        return value

    def encode(self, text: str) -> bytes:
        """Ids of a whole text.  A single space before a visible character always starts
        a pre-token, so the text may be cut there."""
        if "<|endoftext|>" in text:
            if self.exact is None:
                from tokenizers import Tokenizer

                self.exact = Tokenizer.from_file(self.file)
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype="<u2").tobytes()
        if not text:
            return b""
        parts = text.split(" ")
        if any(not p or p[0].isspace() for p in parts[1:]):
            joined = [parts[0]]
            for p in parts[1:]:
                if not p or p[0].isspace():
                    joined[-1] += " " + p
                else:
                    joined.append(" " + p)
        else:
            joined = parts[:1] + [" " + p for p in parts[1:]]
        return b"".join([self[c] for c in joined if c])


_encoders: dict[tuple[str, str], _Pieces] = {}


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def tokenised(df: DataFrame, id_col: str, text_col: str, source_col: str,
              paths: tuple[str, str] | None = None) -> DataFrame:
    """id, part, queue, at, n, ids: token ids (two bytes each) of every text with the
    end id, and their place ``at`` in the part's share of the queue.

    ``queue`` is the source behind "=", and empty for null.  ``part`` numbers the tasks
    of this pass; the result has to be stored before use.
    """
    source = df.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("queue"),
    )
    given = paths

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        where = given or tokenizer_paths()
        if where not in _encoders:
            _encoders[where] = _Pieces(*where)
        encode, part = _encoders[where].encode, TaskContext.get().partitionId()
        filled: dict[str, int] = {}
        end = np.array([END], dtype="<u2").tobytes()
        for whole in batches:
            for low in range(0, whole.num_rows, 500):
                batch = whole.slice(low, 500)
                ids = [encode(t or "") + end for t in batch.column(1).to_pylist()]
                at = []
                for q, x in zip(batch.column(2).to_pylist(), ids, strict=True):
                    at.append(filled.get(q, 0))
                    filled[q] = at[-1] + len(x) // 2
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), pa.array([part] * len(ids), pa.int32()), batch.column(2),
                        pa.array(at, pa.int64()), pa.array([len(x) // 2 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                    ],
                    names=["id", "part", "queue", "at", "n", "ids"],
                )

    return source.mapInArrow(run, "id long, part int, queue string, at long, n long, ids binary")


def rates(totals: DataFrame, packets: int, shares: Mapping[str, float] | None) -> Column:
    """Packets of a queue per round of ``packets``: its own number of packets, or its share
    of the round; sources without a share divide what the others leave by their packets."""
    if not shares:
        return F.col("full").cast("double")
    if any(not 0 < v <= 1 for v in shares.values()) or sum(shares.values()) > 1 + 1e-9:
        raise ValueError("shares must be above 0, and at most 1 together")
    keys = {f"={name}": float(v) for name, v in shares.items()}
    named = F.col("queue").isin(*keys)
    others = totals.where(~named).agg(F.sum("full")).first()[0] or 0
    left = 1 - sum(keys.values())
    if others and left < 1e-9:
        raise ValueError("shares leave nothing for the other sources")
    table = F.create_map(*[F.lit(x) for pair in keys.items() for x in pair])
    return F.when(named, F.try_element_at(table, F.col("queue")) * packets).otherwise(
        F.col("full") * F.lit(left * packets / max(others, 1))
    )


def cuts(start: np.ndarray, n: np.ndarray, full: np.ndarray, rest_at: np.ndarray):
    """Cuts of documents with ``n`` tokens from ``start`` of their queues.

    Arrays (document, first token, length, packet, place in the packet, position).  A queue
    has ``full`` whole packets; what is left lies at ``rest_at`` of all windows, is cut
    where a window ends, and is the only part whose position is known here (else -1).
    """
    low = start // QUANTUM
    count = (start + n - 1) // QUANTUM - low + 1
    doc = np.repeat(np.arange(len(n)), count)
    packet = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - low, count)
    begin = np.maximum(packet * QUANTUM, start[doc])
    length = np.minimum((packet + 1) * QUANTUM, (start + n)[doc]) - begin
    inside = begin - packet * QUANTUM
    position = np.where(packet < full[doc], -1, rest_at[doc] + inside)
    crossing = np.flatnonzero((position >= 0) & (position // WINDOW != (position + length - 1) // WINDOW))
    before = WINDOW - position[crossing] % WINDOW
    doc, packet = np.append(doc, doc[crossing]), np.append(packet, packet[crossing])
    begin = np.append(begin, begin[crossing] + before)
    inside = np.append(inside, inside[crossing] + before)
    position = np.append(position, position[crossing] + before)
    length = np.append(length, length[crossing] - before)
    length[crossing] = before
    return doc, begin - start[doc], length, packet, inside, position


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for low in range(0, whole.num_rows, 1000):
            batch = whole.slice(low, 1000)
            n, start, full, rest_at, rate = (batch.column(i).to_numpy() for i in (2, 3, 4, 5, 6))
            ids = [np.frombuffer(x, dtype="<u2").astype("<u4").tobytes() for x in batch.column(7).to_pylist()]
            doc, first, length, packet, inside, position = cuts(start, n, full, rest_at)
            crc32 = [
                zlib.crc32(memoryview(ids[d])[4 * a : 4 * b])
                for d, a, b in zip(doc.tolist(), first.tolist(), (first + length).tolist(), strict=True)
            ]
            placed = position >= 0
            due = (2 * packet + 1) / np.where(placed, 1.0, 2 * rate[doc])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(doc)), pa.array(first), pa.array(length), pa.array(crc32, pa.int64()),
                    pa.array(n[doc]), batch.column(1).take(pa.array(doc)), pa.array(packet), pa.array(inside),
                    pa.array(due, mask=placed), pa.array(position, mask=~placed),
                ],
                names=["id", "start", "length", "ids_crc32", "doc_tokens", "queue", "packet", "inside", "due", "position"],
            )


PIECES = (
    "id long, start long, length long, ids_crc32 long, doc_tokens long, queue string, packet long, inside long, due double, position long"
)


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         paths: tuple[str, str] | None = None, shares: Mapping[str, float] | None = None) -> DataFrame:
    """One row per piece of a document: where it starts, its length, window and offset.

    Every token of every text, and an end token, lies in exactly one piece.  ``shares``:
    target proportion of tokens by source, together at most 1; the other sources divide
    what is left by their size, and once a source runs out the rest go on in proportion.
    Without it the target is the natural mix.  Null and empty texts are a single end
    token; null is a source of its own.  Repeated rows are packed one by one, and ids may
    repeat.  An empty table gives no piece.  Windows are full but for the very last one.
    The order inside a queue is that of the stored token table; what is left of the queues
    after their full packets follows at the end, queue by queue.  Other columns are not
    read.
    """
    tokens = stored(tokenised(df, id_col, text_col, source_col, paths), "tokens")
    per_part = tokens.groupBy("queue", "part").agg(F.sum("n").alias("n"))
    sizes = stored(
        per_part.groupBy("queue").agg(F.sum("n").alias("n")).select(
            "queue", F.floor(F.col("n") / QUANTUM).alias("full"), (F.col("n") % QUANTUM).alias("rest"), F.md5("queue").alias("key")
        ),
        "sizes",
    )
    packets, names = sizes.agg(F.sum("full"), F.count("*")).first()
    packets = packets or 0
    digits = len(f"{names // 100_000:x}")
    ranked = prefix_sums(sizes, {"upto": F.col("rest")}, [F.col("key"), F.col("queue")], F.substring("key", 1, digits))
    served = ranked.select(
        "queue", "full", rates(sizes, packets, shares).alias("rate"), (F.col("upto") - F.col("rest") + packets * QUANTUM).alias("rest_at")
    )
    # One row per task and queue; stored, so that Spark knows its size before joining.
    before = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(
        per_part.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n").join(served, "queue"), "offsets"
    )
    pieces = stored(
        tokens.join(offsets, ["queue", "part"]).select(
            "id", "queue", tokens["n"], (F.col("base") + F.col("at")).alias("begin"), "full", "rest_at", "rate", "ids"
        ).mapInArrow(_cutter, PIECES),
        "pieces",
    )
    discard(tokens, sizes, offsets)
    whole = pieces.where(F.col("position").isNull()).drop("position")
    slot = F.floor(F.col("due") * F.lit(float(packets / max(SLOT_PACKETS, packets // SLOTS))))
    # The first piece of a packet counts it, so all its pieces see the packets up to it.
    head = F.when(F.col("inside") == 0, 1).otherwise(0)
    counted = prefix_sums(whole, {"upto": head}, [F.col("due"), F.col("queue"), F.col("inside")], slot)
    placed = counted.withColumn("position", (F.col("upto") - 1) * QUANTUM + F.col("inside")).drop("upto")
    return placed.unionByName(pieces.where(F.col("position").isNotNull())).select(
        F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens",
        F.floor(F.col("position") / WINDOW).alias("sequence_id"), (F.col("position") % WINDOW).alias("offset"),
        F.when(F.col("queue") != "", F.substr(F.col("queue"), F.lit(2))).alias("source"),
        F.when(F.col("due").isNotNull(), F.col("packet")).alias("packet"),
    )
