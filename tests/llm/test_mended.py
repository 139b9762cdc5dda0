"""Cases that earlier versions of the corpus operators got wrong or took too long for."""

from __future__ import annotations

import random
import re
import time
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from palisade.llm import common, jaccard, lm, pieces, secrets, toxicity


def test_copies_of_a_row_without_id_keep_their_links(spark):
    rng = random.Random(2)
    text = " ".join(f"w{rng.randrange(999)}" for _ in range(120))
    rows = [(None, text), (1, text), (2, text + " more")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.component_id for r in jaccard.groups(df).collect()}
    assert got[1] == 1 and got[2] == 1 and got[None] in (None, 1)


def test_shingle_sets_against_sets_of_words():
    rng = random.Random(8)
    gaps = [" ", "  ", "\n", "\t \x0b", "\r\x0c"]
    texts = [None, b"", b" \n ", b"one", b"One TWO three  four", b"one two three four", b"a" * 5000, "É é \u00a0x \x1c".encode()]
    for _ in range(60):
        words = [rng.choice(["a", "b", "Ab", "cde", "\u00e9t\u00e9", "x" * 300]) for _ in range(rng.randrange(40))]
        texts.append("".join(w + rng.choice(gaps) for w in words).encode())

    def plain(text):
        words = (text or b"").lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    want = [plain(t) for t in texts]
    for block in (1, 7, 64, 1 << 20):
        got = jaccard.shingle_sets(texts, block=block)
        assert [len(g) for g in got] == [len(w) for w in want]
        for i in range(len(texts)):
            assert (got[i][:-1] < got[i][1:]).all()
            for j in range(i):
                assert len(np.intersect1d(got[i], got[j])) == len(want[i] & want[j])
    assert jaccard.shingle_sets([]) == []


def test_leaves_of_batches_against_a_plain_loop():
    rng = random.Random(9)
    for _ in range(200):
        rows = []
        for token in range(rng.randrange(1, 8)):
            for salt in rng.choice([[-1], [0, 3]]):
                size = rng.choice([1, 1, 2, 5, 63, 64, 65, 128, 200])
                rows += sorted((token, salt, rng.choice([10, 11, 40, 90]), rng.randrange(10**6)) for _ in range(size))
        want = []
        for chain in sorted({r[:2] for r in rows}):
            mine = [r for r in rows if r[:2] == chain]
            for no, low in enumerate(range(0, len(mine), jaccard.LEAF)):
                leaf, rest = mine[low : low + jaccard.LEAF], mine[low + jaccard.LEAF :]
                single = no == 0 and not rest and chain[1] < 0
                if single and not any(3 * b[2] <= 4 * a[2] for a, b in zip(leaf, leaf[1:], strict=False)):
                    continue
                want.append((
                    chain[0], no * jaccard.SALTS + max(chain[1], 0), [r[3] for r in leaf], [r[2] for r in leaf],
                    rest[0][3] if rest else None, single,
                ))
        columns = [np.array([r[i] for r in rows], t) for i, t in ((0, np.int64), (1, np.int32), (3, np.int64), (2, np.int32))]
        step, got, held, done = rng.choice([1, 3, 64, 150, 10_000]), [], None, 0
        for low in range(0, len(rows), step):
            more = [c[low : low + step] for c in columns]
            out, held, done = jaccard._leaf_batch(*(more if held is None else map(np.append, held, more)), done, False)
            assert len(held[0]) <= jaccard.LEAF
            got += out.to_pylist()
        got += jaccard._leaf_batch(*held, done, True)[0].to_pylist()
        assert [tuple(r.values()) for r in got] == want


def labelled(spark, texts, toxic):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    return df, labels


def test_severity_of_rows_that_share_their_features(spark):
    rng = random.Random(7)
    words = [f"common{i}" for i in range(500)]
    texts, toxic = [], []
    for i in range(40):
        rng.shuffle(words)
        texts.append(" ".join(words) + (" telling" if i % 2 else ""))
        toxic.append(i % 2)
    df, labels = labelled(spark, texts, toxic)
    model = toxicity.fit(df, labels)
    got = {r.doc_id: r.toxic for r in toxicity.score(df, model).collect()}
    assert all(got[i] == bool(toxic[i]) for i in range(40))


def test_severity_against_a_plain_optimiser():
    rng = np.random.default_rng(4)
    n, width = 400, 12
    held = rng.random((n, width)) < 0.3
    latent = held @ np.linspace(-2, 2, width) + rng.logistic(size=n)
    grades = np.digitize(latent, [0.5, 2.0])
    model = toxicity.fit_ordinal([np.flatnonzero(r) for r in held], [f"x{i:02d}" for i in range(width)], grades, 3, penalty=1e-4, steps=3000)
    w = np.array([model.weights.get(f"x{i:02d}", 0.0) for i in range(width)])

    def loss(w, cuts):
        below = 1 / (1 + np.exp(-(np.array(cuts)[None, :] - (held @ w)[:, None])))
        edges = np.hstack([np.zeros((n, 1)), below, np.ones((n, 1))])
        return -np.log(np.diff(edges, axis=1)[np.arange(n), grades]).mean()

    best, cuts = np.zeros(width), np.array([0.0, 1.0])
    for _ in range(4000):
        whole = np.append(best, cuts)
        gradient = np.array([
            (loss((whole + d)[:width], (whole + d)[width:]) - loss((whole - d)[:width], (whole - d)[width:])) / 2e-5
            for d in np.eye(width + 2) * 1e-5
        ])
        best, cuts = np.split(whole - 1.0 * gradient, [width])
        if np.abs(gradient).max() < 1e-4:
            break
    assert loss(w, model.cuts) < loss(best, cuts) + 2e-3
    assert np.allclose(w, best, atol=0.15) and np.allclose(model.cuts, cuts, atol=0.15)


def test_severity_without_labels_or_rows(spark):
    df, labels = labelled(spark, ["one two", None, ""], [0, 0, 0])
    for some in (labels, labels.limit(0)):
        model = toxicity.fit(df, some)
        assert {r.toxic for r in toxicity.score(df, model).collect()} == {False}
    assert toxicity.score(df.limit(0), model).count() == 0


def test_running_totals(spark):
    values = [random.Random(1).randrange(-5, 9) for _ in range(300)]
    rows = [(values[:n],) for n in (0, 1, 63, 64, 65, 128, 129, 300)] + [(None,)]
    df = spark.createDataFrame(rows, "v array<int>")
    got = df.select("v", secrets.running(F.col("v"), lambda a, b: a + b).alias("s"), secrets.running(F.col("v"), lambda a, b: F.greatest(a, b)).alias("m"))
    for v, s, m in got.collect():
        if v is not None:
            assert s == [sum(v[:i]) for i in range(len(v))]
            assert m == [max([0, *v[:i]]) for i in range(len(v))]


def test_a_text_of_many_spans_takes_time_in_proportion(spark):
    rng = random.Random(3)
    token = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJ0123456789") for _ in range(22))
    text = " ".join(token() for _ in range(16_000)) + " é " + " ".join(f"AKIA{rng.randrange(10**16):016d}" for _ in range(50))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    ratio = secrets.fit(spark.createDataFrame([("aB3kQ9zXw1", True), ("ordinary", False)], "token string, random boolean"))
    started = time.time()
    found = secrets.find(df, ratio).first().found
    clean = secrets.redact(df, ratio).first().text
    assert time.time() - started < 60
    assert [(s.start, s.end) for s in found if s.rank == 1] == [m.span() for m in re.finditer(r"AKIA[A-Z0-9]{16,}", text)]
    assert all(text[s.start : s.end] == s.match for s in found)
    want, at = [], 0
    for s in found:
        if s.start >= at:
            want += [text[at : s.start], "[SECRET]"]
        at = max(at, s.end)
    assert clean == "".join(want) + text[at:]


def test_best_fit_equals_a_plain_loop():
    from palisade.llm import sharding

    rng = random.Random(5)
    for _ in range(200):
        sizes = sorted((rng.randrange(1, 60) for _ in range(rng.randrange(1, 40))), reverse=True)
        bins, capacity = rng.randrange(1, 9), rng.randrange(40, 200)
        room, want = [capacity] * bins, []
        for size in sizes:
            fits = [(room[b], b) for b in range(bins) if room[b] >= size]
            if not fits:
                want = None
                break
            _, b = min(fits)
            room[b] -= size
            want.append(b)
        assert sharding.best_fit(sizes, bins, capacity) == want


def queued(spark, sizes):
    """Documents of about 300 tokens, so many of each source, and their sources."""
    rows = [(source, i) for source, n in sizes.items() for i in range(n)]
    random.Random(6).shuffle(rows)
    return spark.createDataFrame(
        [(k, "word " * 300, source) for k, (source, _) in enumerate(rows)], "doc_id long, text string, source string"
    ).repartition(3, "doc_id")


def whole_packets(got):
    """(source, packet) in the order of the windows, each with all its tokens in one place."""
    rows = got[got.packet.notna()].assign(at=got.sequence_id * 1024 + got.offset, name=got.source.fillna("")).sort_values("at")
    assert (rows.groupby(["name", "packet"]).length.sum() == 128).all()
    assert ((rows["at"] // 128).groupby([rows.name, rows.packet]).nunique() == 1).all()
    heads = rows[rows["at"] % 128 == 0]
    assert (heads["at"] == np.arange(len(heads)) * 128).all()
    return list(zip(heads.name, heads.packet.astype(int), strict=True))


def test_packets_come_in_the_order_of_plain_due_times(spark):
    from fractions import Fraction

    from palisade.llm import packing

    # More sources than any table of queues used to hold, of equal and unequal sizes, and null.
    sizes = {f"s{i:03d}": 1 + i % 4 for i in range(90)} | {None: 7, "big": 60}
    got = packing.pack(queued(spark, sizes)).toPandas()
    order = whole_packets(got)
    full = {}
    for name, packet in order:
        full[name] = max(full.get(name, 0), packet + 1)
    assert len(full) >= 92
    due = [Fraction(2 * k + 1, 2 * full[name]) for name, k in order]
    assert due == sorted(due) and len(set(order)) == sum(full.values())
    assert got.length.sum() == got.drop_duplicates("doc_id").doc_tokens.sum()
    windows = got.groupby("sequence_id").length.sum()
    assert (windows.iloc[:-1] == 1024).all()


def test_windows_follow_given_shares(spark):
    import pytest

    from palisade.llm import packing

    df = queued(spark, {"a": 60, "b": 60, "c": 20, "d": 20})
    order = [name for name, _ in whole_packets(packing.pack(df, shares={"a": 0.2, "b": 0.5}).toPandas())]
    # The shares hold until the first source is used up; the others go on in proportion.
    until = max(i for i, name in enumerate(order) if name == "b") + 1
    for name, share in {"a": 0.2, "b": 0.5, "c": 0.15, "d": 0.15}.items():
        held = np.cumsum([x == name for x in order[:until]])
        assert np.abs(held - share * np.arange(1, until + 1)).max() <= 2
    assert len(order) > until and set(order[until:]) <= set("acd")
    with pytest.raises(ValueError):
        packing.pack(df, shares={"a": 0.5, "b": 0.5})
    with pytest.raises(ValueError):
        packing.pack(df, shares={"a": 0.5, "b": 0.7})


def test_last_stages_of_the_pipeline_by_hand(spark):
    import zlib

    import public_tokenizers
    from tokenizers import Tokenizer

    import corpus_pipeline
    from palisade.llm.common import stored, table

    directory = "/root/testdata/sf0.01"  # the smaller tables hold no secret
    docs, before = table(spark, directory, "documents"), None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, directory), name)
    plain = {r.doc_id: r.text for r in before.collect()}
    clean = {r.doc_id: r.text for r in docs.collect()}
    assert clean.keys() == plain.keys() and docs.columns == before.columns
    marked = 0
    for k, text in clean.items():
        assert not re.search(r"AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}", text or "")
        at = 0
        for piece in (text or "").split("[SECRET]"):
            assert (place := (plain[k] or "").find(piece, at)) >= 0
            at = place + len(piece)
        marked += text != plain[k]
        if not re.search(r"[A-Za-z0-9+/_=-]{16,}|AKIA|[0-9a-f]{24}|(?i:passw|secret|token|api)", plain[k] or ""):
            assert text == plain[k]
    assert marked > 0
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode
    ids = {k: [*encode(t or "", add_special_tokens=False).ids, 0] for k, t in clean.items()}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, directory).collect()
    seen, windows = {k: [] for k in ids}, {}
    for p in pieces:
        own = ids[p.doc_id][p.start : p.start + p.length]
        assert p.ids_crc32 == zlib.crc32(np.array(own, dtype="<u4").tobytes()) and p.doc_tokens == len(ids[p.doc_id])
        seen[p.doc_id].append((p.start, p.length))
        windows.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for k, spans in seen.items():
        assert [s for s, _ in sorted(spans)] == [sum(n for _, n in sorted(spans)[:i]) for i in range(len(spans))]
        assert sum(n for _, n in spans) == len(ids[k])
    for spans in windows.values():
        assert [o for o, _ in sorted(spans)] == [sum(n for _, n in sorted(spans)[:i]) for i in range(len(spans))]
    sizes = [sum(n for _, n in windows[w]) for w in sorted(windows)]
    assert sizes[:-1] == [1024] * (len(sizes) - 1) and sizes[-1] <= 1024


def test_training_sends_rows_for_shares_not_for_splits(spark):
    """40 splits of the corpus are trained in one share a core, and every token is seen."""
    number = {lm.END: 1, **{f"w{i}".encode(): i + 2 for i in range(30)}}
    share = np.full(32, 1 / 32, dtype=np.float32)
    texts = [" ".join(f"w{(i * j) % 30}" for j in range(60)) for i in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(40)
    cores = spark.sparkContext.defaultParallelism
    rows = lm.fits(df, number, share).collect()
    assert len(rows) <= cores * (len(share) + lm.WIDTH) < 40 * (len(share) + lm.WIDTH)
    # Each context-word pair counts once in the rows of the context matrix.
    assert sum(r.weight for r in rows if r.row == len(share)) == 400 * 61
    assert {r.weight for r in lm.fits(df, number, share, 1).where(f"row = {len(share)}").collect()} == {400 * 61}


def test_sums_of_repeated_rows():
    index = np.array([5, 2, 5, 9, 2, 5])
    rows = np.arange(12, dtype=np.float32).reshape(6, 2)
    at, sums = lm.LogBilinear._summed(index, rows)
    assert at.tolist() == [2, 5, 9] and sums.tolist() == [[10, 12], [14, 17], [6, 7]]


def test_groups_hand_python_small_batches(spark, monkeypatch):
    """A batch is held by the JVM and by Python in every running task: all jobs bound its bytes."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, seen = spark.conf.get(name), []

    def spied(df, label, stored=jaccard.stored):
        seen.append(spark.conf.get(name))
        return stored(df, label)

    monkeypatch.setattr(jaccard, "stored", spied)
    words = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, "more"])), (3, "other text of a few words only"), (4, None)]
    got = {r.doc_id: r.component_id for r in jaccard.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}
    assert set(seen) == {jaccard.BATCH_BYTES} and spark.conf.get(name) == before

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes], pa.int64())], names=["bytes"])

    large = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("x"), 4096).alias("t")).mapInArrow(sizes, "bytes long")
    with common.arrow_batches(spark, "4m"):
        assert max(r.bytes for r in large.collect()) < 5 << 20


def test_groups_move_only_the_texts_that_candidates_ask_for(spark, monkeypatch):
    """Whole sets were stored for every text with a neighbour in a tree, more bytes than the texts."""
    name = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before, seen, sets = spark.conf.get(name), set(), []

    def spied(df, label, stored=jaccard.stored):
        seen.add(spark.conf.get(name))
        out = stored(df, label)
        if label == "sets":
            sets.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "stored", spied)
    rng = random.Random(8)
    shared = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*shared, *(f"x{rng.randrange(10**9)}" for _ in range(60))])) for i in range(80)]
    rows.append((100, rows[7][1] + " more"))
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    got = {r.doc_id: r.component_id for r in jaccard.groups(df).collect()}
    assert got == {i: i for i in range(80)} | {100: 7}
    assert sum(sets) <= 10  # 81 before
    assert seen == {"1m"} and spark.conf.get(name) == before


def test_segmentations_of_a_batch_follow_sampling_without_replacement():
    import public_tokenizers

    lattices = pieces.Lattices(public_tokenizers.path("piece_bpe_32k.model"))
    lattices.weight *= 0.2  # flatter, so that many segmentations come up
    text, n = lattices.normalised("haer it"), 12_000
    everything = {x[0]: np.exp(x[1]) for x in pieces.sample(lattices, text, 500, 0)}
    assert abs(sum(everything.values()) - 1) < 1e-9 and len(everything) > 20
    which, ids, ends, phi, g, inclusion = pieces.samples(lattices, [text] * n, 2, list(range(n)))
    assert (which == np.repeat(np.arange(n), 2)).all() and (g[::2] >= g[1::2]).all() and (inclusion > 0).all() and (inclusion <= 1).all()
    assert abs(g[::2].mean() - 0.5772) < 0.05
    parts = [tuple(x.tolist()) for x in np.split(ids, ends[:-1])]
    assert all(a != b for a, b in zip(parts[::2], parts[1::2], strict=True))
    assert np.allclose(np.exp(phi[:200]), [everything[x] for x in parts[:200]])
    for a in everything:
        second = sum(p * everything[a] / (1 - p) for b, p in everything.items() if b != a)
        assert abs(parts[::2].count(a) / n - everything[a]) < 0.02
        assert abs(parts[1::2].count(a) / n - second) < 0.02


def test_many_segmentations_take_little_time_and_do_not_hang_on_the_batch():
    import public_tokenizers

    lattices = pieces.Lattices(public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(5)
    raw = [" ".join("".join(rng.choices("aeinorst", k=rng.randrange(1, 12))) for _ in range(400)) + " 字͸" for _ in range(200)]
    texts = [lattices.normalised(t) for t in raw]
    began = time.process_time()
    which, ids, ends, phi, g, inclusion = pieces.samples(lattices, texts, 3, list(range(200)))
    assert time.process_time() - began < 5  # 12 s and more text by text
    parts = [tuple(x.tolist()) for x in np.split(ids, ends[:-1])]
    for i in (0, 7, 199):
        alone = pieces.sample(lattices, texts[i], 3, i)
        assert [x[0] for x in alone] == parts[3 * i : 3 * i + 3]
        assert np.allclose([x[1] for x in alone], phi[3 * i : 3 * i + 3]) and np.allclose([x[2] for x in alone], g[3 * i : 3 * i + 3])
        assert all(lattices.decode(list(x[0])) == lattices.decode(lattices.processor.encode(raw[i])) for x in alone)


def test_segmentations_hold_little_memory_at_once():
    """Every running task holds the lattices and paths of the texts that are segmented together."""
    import public_tokenizers

    lattices = pieces.Lattices(public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choices("aeinorst", k=rng.randrange(1, 12))) for _ in range(450)) for _ in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array(texts)], names=["id", "text"])
    tracemalloc.start()
    for part in pieces._parts(batch, 1):
        pieces.samples(lattices, [lattices.normalised(t) for t in part.column(1).to_pylist()], 3, part.column(0).to_pylist())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150 << 20  # 334 MB when up to 1,000 texts were taken


def test_words_end_to_end_are_the_words_of_the_texts():
    odd = pa.array([None, "", "  \n", "One TWO\x0bthree\x0cfour\r\n x ", "É é x \x1c b", " a\t\tb ", " z", " "])
    for column in (odd, odd.slice(2, 4), odd.slice(0, 0)):
        words, ends = common.flat_words(column)
        got, starts = words.to_pylist(), [0, *ends.tolist()]
        want = common.word_texts(column)
        assert [got[a:b] for a, b in zip(starts, starts[1:], strict=False)] == want
        number = {b"x": 2, lm.END: 1, b"a": 3}
        ids = lm._ids(words, pa.array(list(number), pa.binary()), np.array([*number.values(), 0]))
        plain = [[1, *(number.get(w, 0) for w in t), 1] for t in want]
        before, word = lm._pairs(ids, ends, 1)
        assert before.tolist() == [x for t in plain for x in t[:-1]] and word.tolist() == [x for t in plain for x in t[1:]]


def test_words_are_looked_up_in_little_time():
    rng = random.Random(6)
    words = list({"".join(rng.choices("abcdefghij", k=8)) for _ in range(100_000)})
    column = pa.array([" ".join(rng.choices(words, k=500)) for _ in range(500)])
    names, places = pa.array([w.encode() for w in words], pa.binary()), np.arange(len(words) + 1)
    began = time.process_time()
    for _ in range(8):
        lm._ids(common.flat_words(column)[0], names, places)
    took, began = time.process_time() - began, time.process_time()
    number = {w.encode(): i for i, w in enumerate(words)}
    for _ in range(8):
        for t in common.word_texts(column):
            np.array([*map(number.get, t)])
    assert took < 0.8 * (time.process_time() - began)  # as it was looked up before
