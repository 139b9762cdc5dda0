"""Corpus operators against brute force, exact round trips and edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from palisade.llm import ann, chat, components, jaccard, lm, packing, pieces, quality, queries, secrets, sharding, toxicity

TESTDATA = "/root/testdata/sf0.001"
EXTRA = "doc_id long, text string, lang string, source string, n_chars long, token string, id long, component long"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, blanks, a very long text, ties, repeated rows and clashing extra columns."""
    rng = random.Random(1)
    prose = lambda n: " ".join(rng.choice(["the", "of", "and", "river", "stone", "walks", "idiot"]) + str(rng.randrange(40)) for _ in range(n))
    long = prose(30_000)
    texts = [None, "", " \n\t ", "one", "one two three", prose(60), prose(60), long, long, "password=abc123def token: token: x"]
    rows = [(i, t, None, None if i % 3 else "s1", None, "x", 1, 2) for i, t in enumerate(texts)]
    rows += [rows[5], (None, prose(30), "en", "s2", 1, "x", 1, 2), (99, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, EXTRA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], EXTRA)


def documents(spark):
    return spark.read.parquet(f"{TESTDATA}/documents.parquet")


def test_quality_keeps_rows_and_columns(odd, nothing):
    assert quality.assess(odd).count() == odd.count()
    assert quality.assess(nothing).count() == 0
    assert quality.keep(odd).columns == odd.columns
    first = quality.assess(odd).where("doc_id = 0").first()
    assert (first.n_words, first.base_failed, first.kept) == (0, True, False)


def test_repeated_windows_count_covered_words(spark):
    words = [f"w{i}" for i in range(9)]
    text = " ".join(words + ["x"] + words)
    got = quality.assess(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert got.n_repeat_words == 18


def test_groups_match_all_pairs(spark):
    rng = random.Random(3)
    base = [[f"w{rng.randrange(5000)}" for _ in range(80)] for _ in range(6)]
    rows, key = [], 0
    for b in base:
        for _ in range(30):
            copy = list(b)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(80)] = f"e{rng.randrange(10**6)}"
            rows.append((key, " ".join(copy)))
            key += 1
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.groups(df).collect()}
    sets = {k: {tuple(t.split()[i : i + 5]) for i in range(76)} for k, t in rows}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert got == {k: find(k) for k in sets}


def test_groups_of_odd_rows(odd, nothing):
    got = jaccard.groups(odd).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got}
    assert (by[0].n_shingles, by[0].component_id) == (0, 0) and by[8].component_id == 7
    assert jaccard.groups(nothing).count() == 0
    assert jaccard.keep_one(odd).where("doc_id = 8").count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a = rng.integers(0, 2**63, rng.integers(1, 400)).astype(np.uint64)
        b = np.unique(np.concatenate([a[: len(a) // 2], rng.integers(0, 2**63, rng.integers(1, 3000)).astype(np.uint64)]))
        a = np.unique(a)
        assert jaccard.wide_bound(jaccard.wide_bitmap(a), len(a), jaccard.wide_bitmap(b), len(b)) >= len(np.intersect1d(a, b))


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(500, 499)], "a long, b long")
    got = {r.node: r.component for r in components.components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 499: 499, 500: 499}
    assert components.components(edges.where("a < 0")).count() == 0


def test_toxicity_separates_held_out_rows(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(600):
        words = [f"w{rng.randrange(300)}" for _ in range(40)]
        bad = i % 4 == 0
        for _ in range(rng.randrange(1, 6) if bad else 0):
            words[rng.randrange(40)] = rng.choice(["grumbo", "snark"]) + rng.choice(["a", "el", "ing"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    seen = spark.createDataFrame(labels[:400], "doc_id long, toxic int")
    model = toxicity.fit(df, seen)
    got = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    right = [got[i].toxic == bool(y) for i, y in labels[400:]]
    # 400 labelled rows; always answering "clean" is right on 0.75 of the others.
    assert np.mean(right) > 0.9
    assert not any(got[i].toxic for i, y in labels[400:] if not y)
    assert list(model.cuts) == sorted(model.cuts)


def test_toxicity_of_odd_rows(spark, odd, nothing):
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(odd, empty)
    assert toxicity.score(odd, model).where("toxic").count() == 0
    assert toxicity.score(nothing, model).count() == 0
    assert toxicity.drop_toxic(odd, model).columns == odd.columns


def test_secret_spans_match_patterns(spark, odd, nothing):
    patterns = {"assign": re.compile(secrets.ASSIGN), "access": re.compile(secrets.ACCESS), "hex": re.compile(secrets.HEX)}
    least = {"assign": (2, 6), "access": (0, 20), "hex": (0, 24)}
    extra = [
        (200, 'é "PassWord" : "abcdefé" AKIA' + "A1" * 9 + " " + "0f" * 13 + " secret: token: abcdef123"),
        (201, "token=x7Gk29fQmZp4LrT8vWn3"),
    ]
    df = odd.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    ratio = secrets.fit(secrets.labelled_tokens(df, "doc_id", "text"))
    for r in secrets.report(df, ratio).join(df, "doc_id").collect():
        spans = sorted(
            (m.start(), secrets.KINDS.index(k), m.end(), k)
            for k, p in patterns.items() for m in p.finditer(r.text or "") if len(m[least[k][0]]) >= least[k][1]
        )
        text = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
    clean = {r.doc_id: r.text for r in secrets.redact(df, ratio).collect()}
    assert "abcdef" not in clean[200].split("secret")[0] and clean[0] is None
    assert secrets.report(nothing, ratio).count() == 0


def test_labelled_tokens_come_from_the_smallest_hashes(spark):
    plain = [(i, f"identifier_number{i:06d}") for i in range(3000)]
    bad = [(i, f"password={hashlib.md5(str(i).encode()).hexdigest()}") for i in range(3000, 3040)]
    df = spark.createDataFrame(plain + bad, "doc_id long, text string").repartition(16)
    got = secrets.labelled_tokens(df, "doc_id", "text", documents=50)
    first = df.where("doc_id < 3000").orderBy(F.xxhash64("doc_id")).limit(50)
    assert {r.token for r in got.where("NOT random").collect()} == {r.text for r in first.collect()}
    # Each value is found by two patterns.
    assert {r.token for r in got.where("random").collect()} == {t.split("=")[1] for _, t in bad}
    same = spark.createDataFrame([(7, "identifier_number")] * 200, "doc_id long, text string")
    assert secrets.labelled_tokens(same, "doc_id", "text", documents=50).count() == 50


def test_toxicity_learns_from_whole_texts(spark):
    # The word that tells comes last in texts of 3,000 words.
    rows = [(i, " ".join(f"{i}w{k}" for k in range(3000)) + (" grumbo" if i % 2 else " calm")) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(df, spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int"))
    assert {r.doc_id for r in toxicity.score(df, model).where("toxic").collect()} == {i for i in range(40) if i % 2}


def test_markov_finds_a_random_token(spark):
    rng = random.Random(8)
    chars = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    rand = lambda n: "".join(rng.choice(chars) for _ in range(n))
    words = ["configuration", "document", "internationalization", "responsibility_matrix", "thunderstorm"]
    samples = spark.createDataFrame(
        [(rand(32), True) for _ in range(200)] + [(rng.choice(words), False) for _ in range(400)], "token string, random boolean"
    )
    ratio = secrets.fit(samples)
    df = spark.createDataFrame([(1, f"see {rand(40)} now"), (2, "see internationalization_document now")], "doc_id long, text string")
    got = {r.doc_id: r.n_markov for r in secrets.report(df, ratio).collect()}
    assert got == {1: 1, 2: 0}


def _check_pack(df, got):
    assert got.doc_id.nunique() == df[df.doc_id.notna()].doc_id.nunique()
    ordered = got.sort_values(["sequence_id", "offset"])
    assert (ordered.offset == ordered.groupby("sequence_id").length.cumsum() - ordered.length).all()
    full = ordered.groupby("sequence_id").length.sum()
    assert (full.iloc[:-1] == packing.WINDOW).all() and full.iloc[-1] <= packing.WINDOW


def test_packing_places_every_token(spark):
    from tokenizers import Tokenizer

    df = documents(spark)
    got = packing.pack(df).toPandas()
    _check_pack(df.toPandas(), got)
    exact = Tokenizer.from_file(packing.tokenizer_paths()[0])
    texts = {r.doc_id: r.text for r in df.collect()}
    for key, rows in got.groupby("doc_id"):
        ids = np.array([*exact.encode(texts[key] or "", add_special_tokens=False).ids, 0], dtype="<u4")
        rows = rows.sort_values("start")
        assert rows.length.sum() == len(ids) == rows.doc_tokens.iloc[0]
        for r in rows.itertuples():
            assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32


def test_windows_hold_the_mixture(spark):
    rows = [(i, "word " * 2000, "abc"[(i % 10 > 5) + (i % 10 > 8)]) for i in range(60)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, source string")).toPandas()
    packets = got[got.packet.notna()].sort_values(["sequence_id", "offset"]).drop_duplicates(["source", "packet"])
    n = np.arange(1, len(packets) + 1)
    for name in "abc":
        mine = (packets.source == name).to_numpy()
        assert np.abs(np.cumsum(mine) - mine.mean() * n).max() <= 1.5


def test_cutting_text_keeps_its_ids():
    from tokenizers import Tokenizer

    encoder, exact = packing._Pieces(*packing.tokenizer_paths()), Tokenizer.from_file(packing.tokenizer_paths()[0])
    for text in ("a  b", " a\n b \n\n c", "x\t y  ", "é ü  z\x1c a", "it's 12 34!? <|endoftext|> end", "", "   "):
        assert np.frombuffer(encoder.encode(text), dtype="<u2").tolist() == exact.encode(text, add_special_tokens=False).ids


def test_packing_of_odd_rows(odd, nothing):
    got = packing.pack(odd).toPandas()
    assert len(got[got.doc_id == 0]) == 1 and got[got.doc_id == 0].length.iloc[0] == 1
    assert packing.pack(nothing).count() == 0


def test_best_fit_takes_the_tightest_bin():
    assert sharding.best_fit([6, 5, 4, 3, 2], 2, 10) == [0, 1, 0, 1, 1]
    assert sharding.best_fit([6, 6, 6], 2, 10) is None


def test_shards_are_even_and_gapless(spark, odd, nothing):
    df = documents(spark)
    got = sharding.shard(df, 7).toPandas()
    assert len(got) == df.count()
    sizes = got.groupby("shard")["size"].sum()
    assert sizes.max() <= sizes.mean() * 1.02 or sizes.max() == got.groupby("text_crc32")["size"].sum().max()
    assert got.groupby("text_crc32").shard.nunique().max() == 1
    for _, rows in got.groupby("shard"):
        assert sorted(rows.slot) == list(range(len(rows)))
    assert sharding.shard(odd, 3).count() == odd.count()
    assert sharding.shard(nothing, 3).count() == 0


def test_language_model_counts_and_normalises(spark, odd, nothing):
    from collections import Counter

    df = documents(spark)
    got = lm.score(df).toPandas()
    texts = {r.doc_id: (r.text or "").encode().lower().split() + [b"\n"] for r in df.collect()}
    counts = Counter(w for k, t in texts.items() if zlib.crc32(str(k).encode()) % 10 for w in t)
    n, v = sum(counts.values()), len(counts)
    for r in got.itertuples():
        want = sum(np.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in texts[r.doc_id])
        assert abs(r.base_score - want) < 1e-6 * r.n_tokens and r.train_tokens == n
    held = got[got.held_out]
    assert held.score.sum() / held.n_tokens.sum() > held.base_score.sum() / held.n_tokens.sum() - 0.2
    model = lm.LogBilinear.start(np.full(50, 0.02))
    assert np.allclose((10.0 ** model.table()).sum(axis=1), 1, atol=1e-4)
    assert lm.score(odd).count() == odd.count() and lm.score(nothing).count() == 0


def test_language_model_learns_from_every_position(spark):
    rows = [(8 * i + 7, "left right" if i % 2 else f"w{i % 9} x{i % 7}") for i in range(4000)]
    number = {lm.END: 1, b"left": 2, b"right": 3, **{f"{a}{i}".encode(): 4 + i + 9 * (a == "x") for a in "wx" for i in range(9)}}
    df = spark.createDataFrame(rows, "id long, text string").coalesce(1)
    table = lm.train(df, number, np.full(24, 1 / 24, dtype=np.float32)).table()
    assert table[2, 3] > table[2, 4:].max() and not np.allclose(table, table[0], atol=0.05)


def test_language_model_vocabulary_follows_the_counts(spark, monkeypatch):
    taken = {}

    def train(texts, number, share):
        taken.update(number)
        assert abs(share.sum() - 1) < 1e-4 and len(share) == max(number.values()) + 1
        return lm.LogBilinear.start(share)

    monkeypatch.setattr(lm, "train", train)
    often = " ".join(f"o{i}" for i in range(3000))
    rows = [(i, often + "".join(f" r{k}" for k in range(60) if i % (k + 2) == 0)) for i in range(130)]
    got = lm.score(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    assert len({taken[f"o{i}".encode()] for i in range(3000)}) == 3000
    # Rarer words share classes by their counts; the model has a probability for each of them.
    assert 1 < len({taken[f"r{k}".encode()] for k in range(60)}) < 10
    assert np.isfinite(got.score).all()


def test_language_model_scores_rows_that_share_a_key(spark, monkeypatch):
    # Words beyond the looked-up ones join by shuffle; here all but four are.
    monkeypatch.setattr(lm, "FREQUENT", 4)
    rows = [(i, f"a a b b c d{i} e{i} f{i}") for i in range(40)]
    rows += [(k, f"a b d{i} e{i} new{i}") for k, low in ((3, 0), (None, 10)) for i in range(low, low + 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = lm.score(df).toPandas()
    assert len(got) == len(rows) and (got.n_known <= got.n_tokens).all()
    kept = [t.encode().split() + [b"\n"] for k, t in rows if k is None or zlib.crc32(str(k).encode()) % 10]
    counts = {}
    for w in (w for t in kept for w in t):
        counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    base = lambda t: sum(np.log10((counts.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in t.encode().split() + [b"\n"])
    assert np.allclose(sorted(got.base_score), sorted(base(t) for _, t in rows))


def test_neighbours_reach_brute_force(spark):
    df = spark.read.parquet(f"{TESTDATA}/embeddings.parquet")
    got = ann.nearest(df, every=10).toPandas()
    x = df.toPandas()
    m = np.stack(x.embedding).astype(float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    hits = total = 0
    for q, rows in got.groupby("query_id"):
        i = int(np.flatnonzero(x.vec_id == q)[0])
        s = m @ m[i]
        s[i] = -9
        hits += len(set(x.vec_id.to_numpy()[np.lexsort((x.vec_id, -s))[:5]]) & set(rows.vec_id))
        total += 5
    assert hits / total >= 0.9


def test_search_goes_on_until_no_query_is_busy(spark, monkeypatch):
    # A chain along a half circle: each step comes one node nearer.
    monkeypatch.setattr(ann, "ENTRIES", 2)
    n = 60
    points = [(i, [float(np.cos(np.pi * i / n)), float(np.sin(np.pi * i / n))]) for i in range(n)]
    packed = ann._packed(spark.createDataFrame(points, "id long, x array<double>"))
    entries = [r["id"] for r in packed.select("id").orderBy(F.xxhash64("id"), "id").limit(2).collect()]
    target = max(range(n), key=lambda i: min(abs(i - e) for e in entries))
    assert min(abs(target - e) for e in entries) > 11
    graph = spark.createDataFrame([(i, i + 1, 1.0, True) for i in range(n - 1)], "id long, other long, sim float, old boolean")
    query = packed.where(F.col("id") == target).select(F.lit(1000).cast("long").alias("query"), F.col("v").alias("qv"))
    assert target in {r["id"] for r in ann.search(packed, graph, query, 1).collect()}


def test_near_equal_neighbours_are_told_apart(spark):
    # Half precision sees 60 equal vectors, all of which are entries.
    rng = np.random.default_rng(3)
    x = np.ones((60, 8)) + rng.normal(0, 1e-5, (60, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for q in ann.nearest(df).orderBy("query_id", "rank").collect():
        got.setdefault(q["query_id"], []).append(q["score"])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for q, scores in got.items():
        assert np.allclose(scores, np.sort(np.delete(unit @ unit[q], q))[::-1][:5], rtol=0, atol=1e-14)


def test_neighbours_of_odd_vectors(spark):
    schema = "vec_id long, embedding array<float>, id long"
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (2, None, 1), (3, [0.0, 0.0], 1), (4, [float("nan"), 1.0], 1), (50, [0.0, 1.0], 1), (None, [1.0, 1.0], 1), (0, [1.0, 0.0], 1), (7, [1.0], 1)]
    got = [(r.query_id, r.rank, r.vec_id) for r in ann.nearest(spark.createDataFrame(rows, schema)).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 50), (50, 1, 1), (50, 2, 0)]
    assert ann.nearest(spark.createDataFrame([], schema)).count() == 0


def test_segmentations_are_distinct_and_decode(spark, odd, nothing):
    import sentencepiece

    import public_tokenizers

    p = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = pieces.encode(odd.where("doc_id < 7"), ["doc_id"]).collect()
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    seen: dict = {}
    for r in rows:
        assert r.decoded == p.decode(p.encode(texts[r.doc_id]))
        assert tuple(r.ids) not in seen.setdefault(r.doc_id, set()) or r.doc_id == 5
        seen[r.doc_id].add(tuple(r.ids))
        assert 0 <= r.inclusion <= 1
    assert pieces.encode(nothing, ["doc_id"]).count() == 0


def test_segmentations_cover_the_documents(spark, tmp_path):
    rows = [(1, "one two"), (2, None), (3, "river stone " * 3000)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op10_gumbel_segmentations(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == {1, 2, 3}
    assert len({tuple(r.ids) for r in got if r.doc_id == 3}) == pieces.SAMPLES


def test_first_sample_follows_the_probabilities():
    import public_tokenizers

    lattices = pieces.Lattices(public_tokenizers.path("piece_bpe_32k.model"))
    text = lattices.normalised("of")
    everything = pieces.sample(lattices, text, 50, 0)
    share = {x[0]: np.exp(x[1]) for x in everything}
    assert abs(sum(share.values()) - 1) < 1e-9
    drawn = [pieces.sample(lattices, text, 1, s)[0][0] for s in range(3000)]
    for ids, p in share.items():
        assert abs(drawn.count(ids) / 3000 - p) < 0.04


def test_tool_links(spark):
    calls = spark.createDataFrame(
        [
            (1, "b", 2, "reply", '{"turn": 1, "query": "x"}', ["a"]), (1, "a", 5, "reply", '{"turn":"no"}', []),
            (1, "c", 1, "other", "{bad", ["d"]), (1, "d", 1, "reply", "[1]", ["c"]), (1, "b", 9, "reply", "{}", []),
            (2, None, 1, "reply", "{}", []), (2, "e", 1, "reply", None, ["zz"]),
        ],
        "conv long, call string, turn long, name string, arguments string, needs array<string>",
    )
    results = spark.createDataFrame([(1, "a", "ok"), (1, "a", "late"), (9, "q", "x")], "conv long, call string, content string")
    got = {(r.conv, r.call): r for r in chat.link(calls, results, queries.TOOL_FIELDS).collect()}
    assert set(got) == {(1, "a"), (1, "b"), (1, "c"), (1, "d"), (2, "e")}
    assert got[1, "a"].position == 0 and got[1, "b"].position == 1 and got[1, "b"].depth == 1
    assert got[1, "b"].json == '{"arguments":{"query":"x","turn":1},"id":"b","name":"reply","result":null}'
    assert got[1, "a"].errors == ["query: missing", "turn: not BIGINT"] and got[1, "a"].matched
    assert "cycle" in got[1, "c"].errors and got[1, "d"].position is None
    assert got[2, "e"].errors == ["invalid json"]


def test_tool_links_along_chains(spark):
    """A long chain, two chains that meet, a fan, and what stands behind a cycle."""
    needs = {f"k{i:03}": [f"k{i - 1:03}"] if i else [] for i in range(300)}
    needs |= {"m0": [], "m1": ["m0"], "meet": ["m1", "k010"], "after": ["meet"], "late": ["after", "k299"]}
    needs |= {f"f{i}": ["k299"] for i in range(5)} | {"x": ["y"], "y": ["x"], "behind": ["y", "m0"], "far": ["behind"]}
    rows = [(1, c, i % 7, "reply", "{}", n) for i, (c, n) in enumerate(needs.items())]
    calls = spark.createDataFrame(rows, "conv long, call string, turn long, name string, arguments string, needs array<string>")
    got = {r.call: r for r in chat.link(calls, spark.createDataFrame([], "conv long, call string, content string"), []).collect()}
    depth: dict = {}
    while True:
        new = {c: 1 + max([depth[x] for x in n], default=-1) for c, n in needs.items() if c not in depth and all(x in depth for x in n)}
        if not new:
            break
        depth |= new
    assert {c: r.depth for c, r in got.items() if r.depth is not None} == depth
    order = sorted(depth, key=lambda c: (depth[c], list(needs).index(c) % 7, c))
    assert [got[c].position for c in order] == list(range(len(order)))
    assert {c for c, r in got.items() if "cycle" in r.errors} == {"x", "y", "behind", "far"}


def test_pipeline_agrees_with_its_parts(spark):
    import corpus_pipeline

    docs = documents(spark)
    kept = {r.doc_id for r in quality.assess(docs).where("kept").collect()}
    model = toxicity.fit(docs.where(F.col("doc_id").isin(list(kept))), spark.read.parquet(f"{TESTDATA}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity.score(docs, model).where("toxic").collect()}
    left = docs.where(F.col("doc_id").isin(list(kept - toxic)))
    heads = {r.doc_id for r in jaccard.groups(left).collect() if r.component_id == r.doc_id}
    got = corpus_pipeline.run(spark, TESTDATA).select("doc_id").distinct().collect()
    assert {r.doc_id for r in got} == heads
