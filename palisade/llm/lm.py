"""Log-bilinear language model, trained by noise-contrastive estimation in numpy.

The score of a word after another is  (C q(before)) . r(word) + b(word),  normalised
over the vocabulary: every word seen at least LEAST times (and the VOCABULARY most
frequent ones in any case) and classes of the others by the power of two below their
count, inside which words follow their counts.  The training corpus is cut into one share
a core, whatever its size, and a task for each trains on all tokens of its share, from the
same start; the parameters of each word are then averaged, weighted by how often each task
has seen it.  As a context is one word, its normalising sum is computed once, by tasks
that take blocks of contexts.

Counts of all words come from the whole corpus.  Frequent words, FREQUENT of them or
the whole vocabulary, are looked up inside the scan; the others join by shuffle, and
as their counts are not known inside the scan they share the first class.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.llm.common import flat_words, stored

VOCABULARY = 2048
LEAST = 100
WIDTH = 32
FREQUENT = 1 << 17
BATCH, NOISE, RATE = 2048, 64, 0.05
END = b"\n"  # no word holds white space
FLUSH = 300_000
AT_ONCE = 1000  # texts; the vocabulary is hashed again for each such part of a batch


def _source(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(10)) == 0
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))


def _counts(train: DataFrame) -> DataFrame:
    """(token, c) over all training texts, summed in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush():
            names = list(seen)
            out = pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array([seen[x] for x in names], pa.int64())], names=["token", "c"])
            seen.clear()
            return out

        for batch in batches:
            for low in range(0, batch.num_rows, AT_ONCE):
                words, ends = flat_words(batch.column(1).slice(low, AT_ONCE))
                found = pc.value_counts(words)
                for x, c in zip(found.field(0).to_pylist(), found.field(1).to_pylist(), strict=True):
                    seen[x] += c
                seen[END] += len(ends)
                if len(seen) > FLUSH:
                    yield flush()
        if seen:
            yield flush()

    return train.select("id", "text").mapInArrow(run, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


@dataclass
class LogBilinear:
    """Parameters: context vectors q, targets r, context matrix m, biases b."""

    q: np.ndarray
    r: np.ndarray
    m: np.ndarray
    b: np.ndarray

    @classmethod
    def start(cls, share: np.ndarray, seed: int = 7) -> LogBilinear:
        rng = np.random.default_rng(seed)
        shape = (len(share), WIDTH)
        return cls(
            rng.normal(0, 0.1, shape).astype(np.float32), rng.normal(0, 0.1, shape).astype(np.float32),
            np.eye(WIDTH, dtype=np.float32), np.log(share).astype(np.float32),
        )

    @staticmethod
    def _summed(index: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct indices and the sums of their rows."""
        order = np.argsort(index, kind="stable")
        index = index[order]
        heads = np.flatnonzero(np.append(True, index[1:] != index[:-1]))
        times = np.diff(heads, append=len(index))
        sums = rows.take(order[heads], axis=0)
        # Only what occurs more than once is added up.
        often = times > 1
        if often.any():
            starts = np.cumsum(times[often]) - times[often]
            sums[often] = np.add.reduceat(rows.take(order[np.repeat(often, times)], axis=0), starts, axis=0)
        return index[heads], sums

    def step(self, before: np.ndarray, word: np.ndarray, noise: np.ndarray, share: np.ndarray, rate: float,
             past: dict[str, np.ndarray]) -> None:
        """One stochastic NCE step: tell each word from ``noise`` words shared by the batch.

        Steps are scaled by the root of the squared gradients so far, kept in ``past``.
        """
        k, n = len(noise), len(word)
        q, near, far = self.q.take(before, axis=0), self.r.take(word, axis=0), self.r.take(noise, axis=0)
        c = q @ self.m
        good = (c * near).sum(axis=1) + self.b[word] - np.log(k * share[word])
        down = c @ far.T
        down += self.b[noise]
        down -= np.log(k * share[noise])
        up = (1 / (1 + np.exp(np.clip(good, -30, 30)))).astype(np.float32)  # 1 - sigmoid
        np.clip(down, -30, 30, out=down)
        np.negative(down, out=down)
        np.exp(down, out=down)
        down += 1
        np.divide(1, down, out=down)
        dc = up[:, None] * near
        dc -= down @ far
        # Only the rows of words in the batch change.
        pulls = np.empty((n + k, WIDTH + 1), dtype=np.float32)
        np.multiply(up[:, None], c, out=pulls[:n, :-1])
        np.negative(down.T @ c, out=pulls[n:, :-1])
        pulls[:n, -1] = up
        np.negative(down.sum(axis=0), out=pulls[n:, -1])
        pulls /= n
        at, g = self._summed(np.concatenate([word, noise]), pulls)
        back = dc @ self.m.T
        back /= n
        gradient = {"r": (at, g[:, :-1]), "b": (at, g[:, -1]), "q": self._summed(before, back), "m": (slice(None), q.T @ dc / n)}
        for x, (at, g) in gradient.items():
            values = getattr(self, x)
            if x not in past:
                past[x] = np.full_like(values, 1e-8)
            scale = past[x][at] + g * g
            past[x][at] = scale
            values[at] += rate * g / np.sqrt(scale)

    def sums(self, low: int = 0, high: int | None = None) -> np.ndarray:
        """Log of the sum over all words, for each context from ``low`` to ``high``."""
        contexts, out = self.q[low:high] @ self.m, []
        for i in range(0, len(contexts), 64):
            s = contexts[i : i + 64] @ self.r.T
            s += self.b
            top = s.max(axis=1, keepdims=True)
            s -= top
            np.exp(s, out=s)
            out.append(np.log(s.sum(axis=1, dtype=np.float64)) + top[:, 0])
        return np.concatenate(out) if out else np.zeros(0)

    def table(self) -> np.ndarray:
        """log10 P(word | before) for all pairs, one row per context."""
        return (((self.q @ self.m) @ self.r.T + self.b - self.sums()[:, None]) / np.log(10)).astype(np.float32)

    def packed(self) -> np.ndarray:
        """Parameters as rows: q | r | b per word, then the context matrix."""
        rows = np.hstack([self.q, self.r, self.b[:, None]])
        rest = np.zeros((WIDTH, rows.shape[1]), dtype=np.float32)
        rest[:, :WIDTH] = self.m
        return np.vstack([rows, rest]).astype(np.float32)

    @classmethod
    def unpacked(cls, rows: np.ndarray) -> LogBilinear:
        words, rest = rows[:-WIDTH], rows[-WIDTH:]
        return cls(words[:, :WIDTH].copy(), words[:, WIDTH : 2 * WIDTH].copy(), rest[:, :WIDTH].copy(), words[:, -1].copy())


def _ids(words: pa.Array, number: pa.Array, ids: np.ndarray) -> np.ndarray:
    """The entry of ``ids`` for each word: its place in ``number``, or the last one."""
    at = pc.fill_null(pc.index_in(words, value_set=number), len(number))
    return ids[at.to_numpy(zero_copy_only=False)]


def _pairs(words: np.ndarray, ends: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(before, word) of all tokens of texts: a text's words and the end, each after the one
    before it, the first after an end."""
    at = np.arange(len(words)) + np.searchsorted(ends, np.arange(len(words)), side="right")
    before, word = (np.full(len(words) + len(ends), end, dtype=np.int64) for _ in range(2))
    before[at + 1], word[at] = words, words
    return before, word


def _rows(at: np.ndarray, weight: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    data = np.ascontiguousarray(values, dtype=np.float32)
    ends = np.arange(len(data) + 1, dtype=np.int32) * (data.shape[1] * 4)
    packed = pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(weight, pa.int64()), packed], names=["row", "weight", "value"])


FITTED = "row long, weight long, value binary"


def fits(texts: DataFrame, number: dict[bytes, int], share: np.ndarray, shares: int | None = None) -> DataFrame:
    """Parameters that tasks fit to their shares of the corpus, and how often each was seen.

    There are at most ``shares`` shares, one a core if not given: each makes a row for
    every word it has seen, so more shares than cores only add rows.
    """
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast((list(number), np.array([*number.values(), 0], dtype=np.int64), share))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, numbers, p = shared.value
        names, end = pa.array(listed, pa.binary()), int(numbers[listed.index(END)])  # class 0: words not looked up
        model, rng = LogBilinear.start(p), np.random.default_rng(11)
        noise_edges = np.cumsum(p, dtype=np.float64)
        before, word, past = [], [], {}
        seen = np.zeros(len(p) + WIDTH, dtype=np.int64)

        def learn(b, w):
            noise = np.minimum(np.searchsorted(noise_edges, rng.random(NOISE)), len(p) - 1)
            model.step(b, w, noise, p, RATE, past)
            np.add.at(seen, b, 1)
            np.add.at(seen, w, 1)
            seen[len(p) :] += len(b)

        for batch in batches:
            for low in range(0, batch.num_rows, AT_ONCE):
                words, ends = flat_words(batch.column(0).slice(low, AT_ONCE))
                some = _pairs(_ids(words, names, numbers), ends, end)
                b, w = np.concatenate([*before, some[0]]), np.concatenate([*word, some[1]])
                for i in range(0, len(b) - BATCH + 1, BATCH):
                    learn(b[i : i + BATCH], w[i : i + BATCH])
                left = len(b) % BATCH
                before, word = [b[len(b) - left :]], [w[len(w) - left :]]
        if before and len(before[0]):
            learn(before[0], word[0])
        at, rows = np.flatnonzero(seen), model.packed()
        for low in range(0, len(at), 20_000):
            some = at[low : low + 20_000]
            yield _rows(some, seen[some], rows[some])

    return texts.select("text").coalesce(shares or spark.sparkContext.defaultParallelism).mapInArrow(run, FITTED)


def train(texts: DataFrame, number: dict[bytes, int], share: np.ndarray, shares: int | None = None) -> LogBilinear:
    """Average of the models that tasks fit to their shares of the corpus."""

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Weighted means of the rows of a partition, which holds all parts of its rows."""
        at, weight, total = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 2 * WIDTH + 1))
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.float32).reshape(batch.num_rows, -1)
            part = batch.column(1).to_numpy()
            index = np.concatenate([at, batch.column(0).to_numpy()])
            grown = np.hstack([np.append(weight, part)[:, None], np.vstack([total, values * part[:, None].astype(float)])])
            at, sums = LogBilinear._summed(index, grown)
            weight, total = sums[:, 0].astype(np.int64), sums[:, 1:]
        if len(at):
            yield _rows(at, weight, total / weight[:, None])

    parts = fits(texts, number, share, shares)
    got = parts.repartition("row").mapInArrow(average, FITTED).select("row", "value").toArrow()  # vocabulary + WIDTH rows
    rows = LogBilinear.start(share).packed()
    if got.num_rows:
        rows[got.column("row").to_numpy()] = np.frombuffer(b"".join(got.column("value").to_pylist()), dtype=np.float32).reshape(got.num_rows, -1)
    return LogBilinear.unpacked(rows)


def normalisers(model: LogBilinear, spark) -> np.ndarray:
    """``model.sums()``, a task for each block of contexts."""
    shared = spark.sparkContext.broadcast(model.packed())
    block = 1024

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = LogBilinear.unpacked(shared.value)
        for batch in batches:
            for i in batch.column(0).to_pylist():
                z = fitted.sums(i * block, (i + 1) * block)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(z)) + i * block), pa.array(z, pa.float64())], names=["row", "z"])

    blocks = -(-len(model.q) // block)
    got = spark.range(0, blocks, 1, min(blocks, 1000)).mapInArrow(run, "row long, z double").toArrow()
    out = np.empty(len(model.q))
    out[got.column("row").to_numpy()] = got.column("z").to_numpy()
    return out


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A tenth of the ids (by crc32) is held out from all that is learned.  Null and empty
    texts are one end token.  Rows are scored one by one, and ids may repeat or be
    null.  Without training texts every token has the same probability.  An empty table gives an empty result.  Other columns are not
    read.
    """
    spark = df.sparkSession
    source = _source(df, id_col, text_col)
    texts = source.where("NOT held_out")
    counts = stored(_counts(texts), "counts")
    n, v, often = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.count_if(F.col("c") >= LEAST)).first()
    # Words of the vocabulary, and more up to FREQUENT.
    top = counts.orderBy(F.desc("c"), "token").limit(max(FREQUENT, often)).collect()
    frequent = {bytes(r["token"]): r["c"] for r in top}
    listed = [w for w in frequent if w != END][: max(VOCABULARY - 2, often)]
    number = {END: 1, **{w: i + 2 for i, w in enumerate(listed)}}
    first = len(number) + 1
    # Class -> its occurrences and words; class 0 holds what is not looked up, and unseen words.
    totals, kinds = Counter({0: n - sum(frequent.values())}), Counter({0: v - len(frequent) + 1})
    grades: dict[int, int] = {}
    for w, c in frequent.items():
        if w not in number:
            number[w] = k = first + grades.setdefault(c.bit_length(), len(grades))
            totals[k] += c
            kinds[k] += 1
    share = np.array([totals[0], frequent.get(END, 0), *[frequent[w] for w in listed], *[totals[first + i] for i in range(len(grades))]], dtype=float) + 1
    share = (share / share.sum()).astype(np.float32)
    model = train(texts, number, share)
    base_of = lambda c: np.log10((c + 0.1) / (n + 0.1 * (v + 1)))
    # A word of a class has the class's probability times its share of the class.
    inside = {w: float(np.log10((frequent[w] + 0.1) / (totals[k] + 0.1 * kinds[k]))) for w, k in number.items() if k >= first}
    # By place in the list, and last for words that are not looked up.
    listed = list(number)
    model_ids = np.array([*number.values(), 0], dtype=np.int64)
    bases = np.array([*[float(base_of(frequent[w])) if w in frequent else np.nan for w in listed], np.nan])
    insides = np.array([*[inside.get(w, 0.0) for w in listed], 0.0])
    shared = spark.sparkContext.broadcast((listed, model_ids, bases, insides, model.packed(), normalisers(model, spark)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        names, numbers, base, within, fitted, z = shared.value
        # Rows are numbered here, once: the result is stored before it is split.
        next_row = TaskContext.get().partitionId() << 33
        fit = LogBilinear.unpacked(fitted)
        contexts = fit.q @ fit.m

        def likelihood(ids: np.ndarray) -> float:
            total = 0.0
            for i in range(0, len(ids) - 1, 50_000):
                b, w = ids[i : min(i + 50_000, len(ids) - 1)], ids[i + 1 : i + 50_001]
                total += float((np.einsum("ij,ij->i", contexts[b], fit.r[w]) + fit.b[w] - z[b]).sum(dtype=np.float64))
            return total / np.log(10)

        place, of_end = pa.array(names, pa.binary()), names.index(END)
        places, end = np.arange(len(names) + 1), numbers[of_end]
        for batch in batches:
            for low in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(low, AT_ONCE)
                texts_, lost = [], ([], [], [])
                words, ends = flat_words(part.column(1))
                found = _ids(words, place, places)
                for row, (start, stop) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True), next_row):
                    at = np.append(found[start:stop], of_end)
                    lm = likelihood(np.append(end, numbers[at])) + float(within[at].sum())
                    b = base[at]
                    gone = np.isnan(b)
                    if gone.any():
                        rare = Counter(words.take(pa.array(start + np.flatnonzero(gone))).to_pylist())
                        for column, values in zip(lost, (repeat(row, len(rare)), rare, rare.values()), strict=True):
                            column.extend(values)
                        b = b[~gone]
                    texts_.append((row, len(at), len(b), float(b.sum()), lm))
                next_row += len(texts_)
                n_texts, n_lost = len(texts_), len(lost[0])
                row, n_tokens, n_known, base_, lm = zip(*texts_, strict=True)

                def joined(kind, ours, theirs):
                    """A column of the rows of texts, then of those of words not looked up."""
                    fill = [x if isinstance(x, pa.Array) else pa.array(x, kind) for x in (ours, theirs)]
                    return pa.concat_arrays(fill)

                whole, no = pa.int64(), lambda kind, n: pa.nulls(n, kind)
                yield pa.RecordBatch.from_arrays(
                    [
                        joined(whole, row, lost[0]), joined(whole, part.column(0), no(whole, n_lost)), joined(pa.bool_(), part.column(2), no(pa.bool_(), n_lost)),
                        joined(pa.binary(), no(pa.binary(), n_texts), lost[1]), joined(whole, repeat(1, n_texts), lost[2]),
                        *[joined(k, x, repeat(0, n_lost)) for k, x in ((whole, n_tokens), (whole, n_known), (pa.float64(), base_), (pa.float64(), lm))],
                    ],
                    names=["row", "id", "held_out", "token", "times", "n_tokens", "n_known", "base", "lm"],
                )

    parts = stored(
        source.mapInArrow(run, "row long, id long, held_out boolean, token binary, times long, n_tokens long, n_known long, base double, lm double"),
        "scored",
    )
    texts_only = parts.where("token IS NULL")
    c, t = F.coalesce("c", F.lit(0)), F.col("times")
    rare = (
        parts.where("token IS NOT NULL").select("row", "token", "times").join(counts, "token", "left").groupBy("row").agg(
            F.sum(F.when(c > 0, t).otherwise(0)).alias("rare_known"),
            F.sum(t * F.log10((c + 0.1) / F.lit(n + 0.1 * (v + 1)))).alias("rare_base"),
            F.sum(t * F.log10((c + 0.1) / F.lit(totals[0] + 0.1 * kinds[0]))).alias("rare_lm"),
        )
    )
    zero = lambda name: F.coalesce(name, F.lit(0))
    joined = texts_only.join(rare, "row", "left")
    return joined.select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("n_known") + zero("rare_known")).cast("long").alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("base") + zero("rare_base")).alias("base_score"),
        (F.col("lm") + zero("rare_lm")).alias("score"),
    )
