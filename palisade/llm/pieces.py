"""Distinct sampled segmentations of texts into subword pieces, and back.

Each word of a text is a small lattice of vocabulary pieces; the text is their chain.
Gumbel top-k without replacement: a search over partial segmentations keeps, for each,
the largest Gumbel-perturbed log-probability of any way to finish it.  Popping the
largest first (A*, with an exact bound) emits complete segmentations in the order of a
sample without replacement, all of them distinct.

A batch of texts is searched together.  The way on from a partial segmentation is drawn by
the lattices' probabilities, independent of its value g; every branch beside it, of
log-probability m, then has the value m - log(exp(m - g) - log u): Gumbel noise below g.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLES = 3
SPACE = "▁"
BYTE_COST = 20.0
# Branches so far below their text's value are looked at only if nearer ones do not suffice.
FAR = 60.0
# Texts and bytes of them whose lattices are built at once; Python holds some 400 bytes a byte.
TEXTS, CHARACTERS = 100, 1 << 19


class Lattices:
    """Piece lattices of words for one model file.

    A piece's weight is -log(2 + rank) of its merge rank, so early merges are likelier;
    characters outside the vocabulary are spelled in byte pieces.
    """

    def __init__(self, model: str):
        import pandas as pd
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=model)
        p = self.processor
        pieces: dict[str, tuple[int, float]] = {}
        self.bytes = {}
        for i in range(p.get_piece_size()):
            piece = p.id_to_piece(i)
            if p.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
            elif not (p.is_control(i) or p.is_unknown(i) or p.is_unused(i)) and (len(piece) == 1 or p.get_score(i) > -1e8):
                pieces[piece] = (i, -math.log(2.0 + min(-p.get_score(i), 1e5)))
        # A trie of the pieces: a step's key is the state (0 is the root) and the character.
        steps: dict[int, int] = {}
        ends: dict[int, tuple[int, float]] = {}
        for piece, found in pieces.items():
            state = 0
            for c in piece:
                state = steps.setdefault(state << 21 | ord(c), len(steps) + 1)
            ends[state] = found
        self.longest = max(map(len, pieces))
        self.steps = pd.Index(np.fromiter(steps, np.int64, len(steps)))
        self.piece = np.array([ends.get(i, (-1, 0.0))[0] for i in range(len(steps) + 1)], dtype=np.int32)
        self.weight = np.array([ends.get(i, (-1, 0.0))[1] for i in range(len(steps) + 1)])

    def spelled(self, code: int) -> list[int]:
        """Byte pieces of a character."""
        return [self.bytes[b] for b in chr(code).encode("utf-8", "replace")]

    def normalised(self, text: str) -> str:
        return self.processor.normalize(text)

    def decode(self, ids: list[int]) -> str:
        return self.processor.decode(ids)


class Edges:
    """The lattices of distinct words as arrays.

    Nodes are places in words, those nearest to their word's end first; edges are ordered
    by their node and their length.  ``to`` is the node that an edge leads to, ``nodes``
    at the end of the word; ``p`` is its probability given the node, ``lp`` the log.
    """

    def __init__(self, lattices: Lattices, words: list[str]):
        length = np.fromiter(map(len, words), np.int64, len(words))
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        ends = np.cumsum(length)
        n = self.nodes = len(code)
        left = np.repeat(ends, length) - np.arange(n)
        short = left.astype(np.uint16) if n and left.max() < 1 << 16 else left
        place = np.argsort(short, kind="stable")
        node = np.empty(n + 1, dtype=np.int64)
        node[place] = np.arange(n)
        self.left = left = left[place]
        self.length, self.start = length, node[ends - length]
        # Edges of each length, then of each node; a character that is no piece is spelled in bytes.
        at, now, here = np.arange(n), np.zeros(n, dtype=np.int64), place
        found, fan = [], np.ones(n, dtype=np.int64)
        for k in range(lattices.longest):
            now = lattices.steps.get_indexer(now << 21 | code[here]) + 1
            if k:
                ends_here = np.flatnonzero(lattices.piece[now] >= 0)
                found.append((at[ends_here], now[ends_here]))
                fan[found[-1][0]] += 1
            else:
                found.append((at, np.where(lattices.piece[now] >= 0, now, 0)))
            on = np.flatnonzero((now > 0) & (left[at] > k + 1))
            at, now, here = at[on], now[on], here[on] + 1
            if not len(at):
                break
        self.first = np.append(0, np.cumsum(fan))
        free, edges = self.first[:-1].copy(), int(self.first[-1])
        source, size, state = np.repeat(np.arange(n), fan), np.empty(edges, dtype=np.int64), np.empty(edges, dtype=np.int64)
        for k, (at, now) in enumerate(found):
            to = free[at]
            size[to], state[to] = k, now
            free[at] = to + 1
        self.piece = lattices.piece[state]  # -1: bytes
        weight = lattices.weight[state]
        byte = np.flatnonzero(state == 0)
        self.code = code[place[source[byte]]]
        self.byte = byte
        self.spells = np.searchsorted([0x80, 0x800, 0x10000], self.code, side="right") + 1
        self.spells[(self.code >= 0xD800) & (self.code < 0xE000)] = 1
        weight[byte] = -BYTE_COST * self.spells
        after = place[source] + size + 1
        self.to = np.where(left[source] > size + 1, node[np.minimum(after, n)], n)
        total = np.zeros(n + 1)
        bounds = np.searchsorted(left, np.arange(1, (int(left[-1]) if n else 0) + 2)).tolist()
        for low, high in zip(bounds, bounds[1:], strict=False):
            a, b = self.first[low], self.first[high]
            x, heads = weight[a:b] + total[self.to[a:b]], self.first[low:high] - a
            top = np.maximum.reduceat(x, heads)
            x -= top[source[a:b] - low]
            total[low:high] = top + np.log(np.add.reduceat(np.exp(x), heads))
        self.lp = weight + total[self.to] - total[source]
        self.p = np.exp(self.lp)
        self.source = source

    def drawn(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge of each node by its probability, from uniform numbers."""
        edge, last = self.first[node], self.first[node + 1] - 1
        open_ = np.flatnonzero((edge < last) & (u >= self.p[edge]))
        u = u.copy()
        while len(open_):
            u[open_] -= self.p[edge[open_]]
            edge[open_] += 1
            at = edge[open_]
            open_ = open_[(at < last[open_]) & (u[open_] >= self.p[at])]
        return edge


def chunks(text: str) -> list[str]:
    """A normalised text cut before each space mark that follows another character."""
    first, *rest = text.split(SPACE)
    return [first, *[SPACE + part for part in rest]] if first else [SPACE + part for part in rest]


def _ranges(low: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers from each ``low`` on, ``count`` of them, end to end."""
    return np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())


def _drawn_rest(edges: Edges, start: np.ndarray, occ: np.ndarray, number: np.ndarray, at_place: np.ndarray, u: np.ndarray):
    """(edge, occurrence, edges in a row) drawn for the words ``number`` from their nodes ``start``.

    ``u[at_place - left]`` are the uniform numbers of the nodes of a word.
    """
    node, at, taken = start.copy(), np.arange(len(occ)), []
    many = np.zeros(len(occ), dtype=np.int64)
    while len(at):
        edge = edges.drawn(node, u[at_place[at] - edges.left[node]])
        taken.append((at, edge))
        many[at] += 1
        node = edges.to[edge]
        on = node < edges.nodes
        at, node = at[on], node[on]
    before = np.cumsum(many) - many
    out = np.empty(int(many.sum()), dtype=np.int64)
    for step, (at, edge) in enumerate(taken):
        out[before[at] + step] = edge
    return out, np.repeat(occ, many), np.bincount(number, many).astype(np.int64) if len(many) else many


def _largest(value: np.ndarray, row: np.ndarray, rows: int, most: int) -> np.ndarray:
    """Places of the ``most`` largest values of each row; rows are in order."""
    out, value, low = [], value.copy(), np.searchsorted(row, np.arange(rows))
    low = low[np.diff(low, append=len(row)) > 0]
    count = np.diff(low, append=len(row))
    for _ in range(min(most, int(count.max(initial=0)))):
        top = np.maximum.reduceat(value, low)
        hit = np.flatnonzero((value == np.repeat(top, count)) & (value > -np.inf))
        out.append(hit)
        value[hit] = -np.inf
    return np.concatenate([*out, np.zeros(0, np.int64)])


def samples(lattices: Lattices, texts: list[str], k: int, seeds: list[int]):
    """(text, ids, ends, log-probability, perturbed value, inclusion) of the segmentations
    of normalised texts: arrays, an entry for each segmentation, the texts in order; ``ids``
    of all of them lie end to end, up to ``ends``.  See ``sample``.
    """
    words = [chunks(t) for t in texts]
    n_words = np.fromiter(map(len, words), np.int64, len(words))
    words = list(chain.from_iterable(words))
    names = {w: i for i, w in enumerate(dict.fromkeys(words))}
    edges = Edges(lattices, list(names))
    word = np.fromiter(map(names.__getitem__, words), np.int64, len(words))
    high = np.cumsum(n_words)  # words of a text: low to high
    low = high - n_words
    chars = np.append(0, np.cumsum(edges.length[word]))
    stop = chars[1:] - np.repeat(chars[low], n_words)  # characters of the text up to a word's end
    n_chars = chars[high] - chars[low]
    # Draws depend on the seed alone: a generator for each text, asked in the text's own order.
    made = [np.random.default_rng(x & (1 << 64) - 1) for x in seeds]
    n = len(texts)
    # A row is one segmentation: its edges in ``path`` from ``at[row]`` on, the occurrence
    # of each, and the log-probability before it.
    path, occ_of, phi_of = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    rows: list[tuple[np.ndarray, ...]] = []  # text, low, high, log-probability, value
    text, occ, node = np.arange(n), low, np.full(n, -1)
    parent_low, taken, last, phi = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
    g = np.array([-math.log(-math.log(r.random() or 1e-300)) if m else 0.0 for r, m in zip(made, n_words.tolist(), strict=True)])
    # Branches that may still be among the first k + 1: text, value, place in ``path``, edge.
    pool = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))
    for turn in range(k):
        count = high[text] - occ
        row = np.repeat(np.arange(len(text)), count)
        each = _ranges(occ, count)
        start = edges.start[word[each]]
        head = (np.cumsum(count) - count)[(count > 0) & (node >= 0)]
        start[head] = node[(count > 0) & (node >= 0)]
        u = np.concatenate([*(made[t].random(m) for t, m in zip(text.tolist(), n_chars[text].tolist(), strict=True)), np.zeros(0)])
        room = np.cumsum(n_chars[text]) - n_chars[text]
        new, new_occ, length = _drawn_rest(edges, start, each, row, stop[each] + room[row], u)
        length = np.append(length, np.zeros(len(text) - len(length), np.int64))
        # The new rows: what they share with their parents, the branch taken, what was drawn.
        size = np.where(turn > 0, taken + 1, 0) + length
        begin = len(path) + np.cumsum(size) - size
        to = begin - len(path)
        grown = [np.empty(int(size.sum()), dtype=x.dtype) for x in (path, occ_of, phi_of)]
        tail = _ranges(to + size - length, length)
        if turn:
            for x, y, own in zip(grown, (path, occ_of, phi_of), (last, None, None), strict=True):
                x[_ranges(to, taken + 1)] = y[_ranges(parent_low, taken + 1)]
                if own is not None:
                    x[to + taken] = own
        grown[0][tail], grown[1][tail] = new, new_occ
        # Sums along each row, whose first term is the log-probability before it.
        heads = np.cumsum(length + 1) - length - 1
        sums = np.empty(len(new) + len(length))
        sums[heads] = phi
        sums[_ranges(heads + 1, length)] = edges.lp[new]
        for a, b in zip(heads.tolist(), (heads + length + 1).tolist(), strict=True):
            np.cumsum(sums[a:b], out=sums[a:b])
        total = sums[heads + length]
        grown[2][tail] = sums[_ranges(heads, length)]
        here = tail + len(path)
        path, occ_of, phi_of = (np.concatenate([x, y]) for x, y in zip((path, occ_of, phi_of), grown, strict=True))
        rows.append((text, begin, begin + size, total, g))
        # Branches beside what was drawn, first those not far below g.
        source, of_step = edges.source[new], np.repeat(np.arange(len(text)), length)
        fan = edges.first[source + 1] - edges.first[source]
        before = phi_of[here]
        far = before < (g - FAR)[of_step]
        need = np.ones(len(text), dtype=bool)
        for some in (~far, far):
            wide = np.flatnonzero((fan > 1) & some & need[of_step])
            side = _ranges(edges.first[source[wide]], fan[wide])
            back = np.repeat(wide, fan[wide])
            other = np.flatnonzero(side != new[back])
            side, back = side[other], back[other]
            of = of_step[back]
            noise = np.concatenate([
                *(made[t].standard_exponential(m) for t, m in zip(text.tolist(), np.bincount(of, minlength=len(text)).tolist(), strict=True)), np.zeros(0),
            ])
            m = before[back] + edges.lp[side]
            value = m - np.log(np.exp(m - g[of]) + noise)
            best = _largest(value, of, len(text), k - turn)
            pool = tuple(np.concatenate([x, y]) for x, y in zip(pool, (text[of[best]], value[best], here[back[best]], side[best]), strict=True))
            # A branch FAR below g is never (e**-40) above g - FAR / 3.
            near = np.bincount(of[best[value[best] > (g - FAR / 3)[of[best]]]], minlength=len(text))
            need = near < k - turn
            if not need.any():
                break
        order = np.lexsort([pool[2], -pool[1], pool[0]])
        pool = tuple(x[order] for x in pool)
        rank = np.arange(len(order)) - np.searchsorted(pool[0], pool[0])
        if turn == k - 1:
            pool = tuple(x[rank == 0] for x in pool)
            break
        # The largest branch of each text is its next segmentation.
        text, g, at, last = (x[rank == 0] for x in pool)
        pool = tuple(x[(rank > 0) & (rank < k - turn)] for x in pool)
        if not len(text):
            break
        begins = np.concatenate([r[1] for r in rows])
        # Rows without an edge have no branches, so the last row that begins at or before a place holds it.
        parent_low = begins[np.searchsorted(begins, at, side="right") - 1]
        taken, phi = at - parent_low, phi_of[at] + edges.lp[last]
        node = edges.to[last]
        occ = occ_of[at] + (node == edges.nodes)
        node = np.where(node == edges.nodes, -1, node)
    limit = dict(zip(pool[0].tolist(), pool[1].tolist(), strict=True))
    text, begin, end, phi, g = (np.concatenate(x) for x in zip(*rows, strict=True))
    order = np.argsort(text, kind="stable")
    text, begin, end, phi, g = (x[order] for x in (text, begin, end, phi, g))
    whole = path[_ranges(begin, end - begin)]
    ids, each = edges.piece[whole], np.ones(len(whole), dtype=np.int64)
    byte = np.flatnonzero(ids < 0)
    if len(byte):
        kind = np.searchsorted(edges.byte, whole[byte])
        each[byte] = edges.spells[kind]
        ids = np.repeat(ids, each)
        spelled: dict[int, list[int]] = {}
        flat = []
        for c in edges.code[kind].tolist():
            if c not in spelled:
                spelled[c] = lattices.spelled(c)
            flat += spelled[c]
        ids[ids < 0] = flat
    inclusion = [
        -math.expm1(-math.exp(min(p - limit[t], 700.0))) if t in limit else 1.0 for t, p in zip(text.tolist(), phi.tolist(), strict=True)
    ]
    return text, ids, np.append(0, np.cumsum(each))[np.cumsum(end - begin)], phi, g, np.array(inclusion)


def sample(lattices: Lattices, text: str, k: int, seed: int):
    """Up to ``k`` distinct segmentations of a normalised text, best perturbed first.

    Tuples (ids, log-probability, perturbed value, inclusion).  ``inclusion`` is the
    probability that the segmentation is above the threshold, the perturbed value of
    the first one not returned; it is 1 when there is no other segmentation.
    """
    _, ids, ends, *values = samples(lattices, [text], k, [seed])
    parts = np.split(ids, ends[:-1])
    return [(tuple(x.tolist()), *map(float, v)) for x, *v in zip(parts, *values, strict=True)]


def _parts(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of at most TEXTS rows and, where a row alone has no more, CHARACTERS bytes of text."""
    sizes, low, held = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist(), 0, 0
    for i, size in enumerate(sizes):
        if i > low and (i - low == TEXTS or held + size > CHARACTERS):
            yield batch.slice(low, i - low)
            low, held = i, 0
        held += size
    if low < len(sizes):
        yield batch.slice(low)


def encode(df: DataFrame, keys: list[str], text_col: str = "text", k: int = SAMPLES, model: str | None = None) -> DataFrame:
    """Rows (keys..., sample, ids, log_prob, perturbed, inclusion, decoded).

    ``sample`` counts from 1; a text with fewer than ``k`` segmentations has fewer rows.
    Null and empty texts have one empty segmentation.  Draws depend on the key only, so
    repeated rows get the same samples; a null key is a value of its own.  An empty
    table gives an empty result; other columns are not read.  ``decoded`` is the text
    that the ids stand for (the normalised text).
    """
    source = df.select(*keys, F.xxhash64(*keys).alias("__seed"), F.col(text_col).alias("__text"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*keys).schema)
    held: dict[str, Lattices] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if "x" not in held:
            import public_tokenizers

            held["x"] = Lattices(model or public_tokenizers.path("piece_bpe_32k.model"))
        lattices = held["x"]
        for whole in batches:
            for b in _parts(whole, len(keys) + 1):
                texts = [lattices.normalised(t or "") for t in b.column(len(keys) + 1).to_pylist()]
                text, ids, ends, *values = samples(lattices, texts, k, b.column(len(keys)).to_pylist())
                starts = np.append(0, ends[:-1])
                number = np.arange(len(text)) - np.searchsorted(text, text) + 1
                decoded: list[str] = []
                for i, s, low, high in zip(text.tolist(), number.tolist(), starts.tolist(), ends.tolist(), strict=True):
                    # All segmentations stand for one text; only space marks at its start are read by piece.
                    again = s > 1 and not texts[i].startswith(2 * SPACE)
                    decoded.append(decoded[-1] if again else lattices.decode(ids[low:high].tolist()))
                at = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[b.column(j).take(at) for j in range(len(keys))], pa.array(number, pa.int32()),
                        pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids, pa.int32())),
                        *[pa.array(v, pa.float64()) for v in values], pa.array(decoded, pa.string()),
                    ],
                    names=[*keys, "sample", "ids", "log_prob", "perturbed", "inclusion", "decoded"],
                )

    return source.mapInArrow(
        run, f"{types}, sample int, ids array<int>, log_prob double, perturbed double, inclusion double, decoded string"
    )
