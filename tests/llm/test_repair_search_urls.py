"""Conversation repair, ranked search and URL entries against SQL, brute force and edge cases."""

from __future__ import annotations

import random
from functools import lru_cache

import numpy as np
import pytest

import oracle
from palisade.llm import queries, repair, search, urls

TESTDATA = "/root/testdata/sf0.001"
TALK = "conv_id long, turn long, role string, text string, row long, conv string, fault string"
DOCS = "doc_id long, text string, terms string, n long, item string, rank long"
PAGES = "page_id long, url string, host string, path string, rule string, verdict string, __match string"


@pytest.mark.parametrize("name", ["op11_block_table_repair", "op12_mask_search", "op13_url_trie"])
def test_query_equals_sql(spark, name):
    difference, *_ = oracle.compare(spark, TESTDATA, queries.QUERIES[name], queries.ORACLES[name])
    assert difference is None, difference


def as_tables(spark, tmp_path, **tables):
    """DuckDB views of these tables, for a query's SQL."""
    import duckdb

    connection = duckdb.connect()
    for name, df in tables.items():
        df.coalesce(1).write.parquet(str(tmp_path / name))
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path / name}/*.parquet'")
    return connection


def same(got, want):
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall()))


# ---- repair -----------------------------------------------------------------


@pytest.fixture(scope="module")
def talk(spark):
    """Nulls in every column, ties of turns, repeated rows, unknown roles, a very long text."""
    rows = [
        (None, None, None, None), (None, 1, "user", "hi"), (None, 1, "user", "hi"), (5, None, "system", "s."),
        (5, None, "system", "s."), (5, 3, "tool", "x!"), (5, 3, "user", "y. \n"), (6, 1, "", "z?"),
        (6, 2, "assistant", "q"), (7, 0, "user", " "), (7, 1, "user", "a" * 300_000 + "."), (7, 9, "assistant", "ok."),
        (8, 2, "user", "one."), (8, 2, "assistant", "two."), (8, 2, "assistant", "two."), (9, 0, "assistant", "\u00e9!\t"),
    ]
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], TALK)


def test_repair_of_odd_rows_equals_sql(spark, tmp_path, talk):
    connection = as_tables(spark, tmp_path, conversations=talk)
    same(repair.report(talk), connection.sql(queries.ORACLES["op11_block_table_repair"]))


def test_repair_of_nothing(spark, talk):
    assert repair.report(talk.limit(0)).count() == 0
    done = repair.repair(talk.limit(0))
    assert (done.steps.count(), done.faults.count()) == (0, 0)


def test_one_long_conversation_is_cut_into_chunks(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(1, i // 2, rng.choice(["system", "user", "assistant", "user"]), rng.choice(["a.", "b", "c!", "", f"d{i}"])) for i in range(900)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = [tuple(r) for r in repair.report(df).collect()]
    monkeypatch.setattr(repair, "CHUNK_ROWS", 7)
    assert [tuple(r) for r in repair.report(df).collect()] == whole


def plain_audit(symbols: list[int]) -> tuple[int, str]:
    """Least cost and, of the audits of that cost, the ASCII-least, over all edits."""
    c = repair.Costs()

    @lru_cache(None)
    def finish(i: int, state: int, inserted: int) -> tuple[int, str]:
        found = []
        if i == len(symbols):
            if state in (0, 3):
                found.append((0, ""))
        else:
            s = symbols[i]
            price, rest = finish(i + 1, state, 0)
            found.append((c.delete + price, "D" + rest))
            if s != repair.MUST_DELETE:
                extra = c.truncated * (s >= 4)
                legal = {(0, 0): 1, (1, 0): 2, (1, 1): 2, (1, 3): 2, (2, 2): 3}
                if (s % 4, state) in legal:
                    price, rest = finish(i + 1, legal[s % 4, state], 0)
                    found.append((extra + price, "K" + rest))
                price, rest = finish(i + 1, 3 if state == 2 else 2, 0)
                found.append((c.rerole + extra + price, "R" + rest))
        if inserted < 3:
            price, rest = finish(i, 3 if state == 2 else 2, inserted + 1)
            found.append((c.insert + price, "I" + rest))
        return min(found) if found else (10**9, "")

    return finish(0, 0, 0)


def test_block_tables_trace_the_ascii_least_audit():
    t = repair.tables()
    rng = random.Random(5)
    for size in [*range(10), 40, 41, 42, 43] * 20:
        symbols = np.array([rng.randrange(9) for _ in range(size)], dtype=np.uint8)
        edits, state = repair.trace(symbols, t.end, 0, True, t)
        cost, audit = plain_audit(symbols.tolist())
        assert "".join(e[0] for e in edits) == audit and state in (0, 3)
        head, codes = repair._codes(symbols)
        at, total = t.end, 0
        for code in reversed(codes):
            total, at = total + t.block_grown[at, code], t.block_before[at, code]
        if head == 0:
            # Vectors are normalised, so the cost is what the minimum grew by and the start's share.
            assert repair.chunk_map(symbols, t)[t.end] == at
            assert total + t.vectors[at][0] == cost


def test_repaired_rows_have_legal_roles(spark, talk):
    import re

    steps = repair.repair(talk).steps.where("edit <> 'D'").collect()
    for conv in {r.conv for r in steps}:
        roles = "".join(r.role[0] for r in sorted((x for x in steps if x.conv == conv), key=lambda x: x.position))
        assert re.fullmatch("(s?(ua)+)?", roles)


# ---- search -----------------------------------------------------------------


@pytest.fixture(scope="module")
def odd_docs(spark):
    rng = random.Random(6)
    words = ["\u00e9t\u00e9", "River", "stone", "x1", "Walks", "\u4f60\u597d", "the", "THE"]
    prose = lambda n: "".join(rng.choice(words) + rng.choice([" ", ".", "-", "\n", "\u00a0"]) for _ in range(n))
    texts = [None, "", " .;\n", "the", *[prose(rng.randrange(1, 60)) for _ in range(150)], prose(60_000)]
    rows = [(i, t, "x", 1, "y", 2) for i, t in enumerate(texts)]
    rows += [rows[9], (None, "the river", "x", 1, "y", 2), (None, "the river", "x", 1, "y", 2), (500, "the river", None, None, None, None)]
    items = [(0, "the river, the STONE"), (1, None), (2, ""), (3, "nowhere"), (None, "\u4f60\u597d x1"), (0, "stone"), (4, prose(200))]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame([(*i, 3) for i in items], "item_id long, text string, score long")


@pytest.mark.parametrize("limit", [search.ITEM_BYTES, 40])
def test_search_of_odd_rows_equals_sql(spark, tmp_path, odd_docs, limit):
    docs, items = odd_docs
    connection = as_tables(spark, tmp_path, documents=docs, benchmark=items)
    same(search.search(docs, items, limit=limit), connection.sql(queries.ORACLES["op12_mask_search"]))


def test_small_blocks_find_the_same(spark, odd_docs, monkeypatch):
    docs, items = odd_docs
    want = sorted(map(repr, map(tuple, search.search(docs, items, k=3).collect())))
    monkeypatch.setattr(search, "BLOCK_DOCUMENTS", 5)
    monkeypatch.setattr(search, "BLOCK_POSTINGS", 20)
    assert sorted(map(repr, map(tuple, search.search(docs, items, k=3).collect()))) == want


def test_search_of_empty_tables(odd_docs):
    docs, items = odd_docs
    assert search.search(docs.limit(0), items).count() == 0
    assert search.search(docs, items.limit(0)).count() == 0


def test_items_of_many_terms_need_several_mask_words():
    rng = np.random.default_rng(8)
    starts, terms, counts = [0], [], []
    for _ in range(400):
        held = np.flatnonzero(rng.random(300) < rng.choice([0.02, 0.5]))
        terms += held.tolist()
        counts += rng.integers(1, 9, len(held)).tolist()
        starts.append(len(terms))
    n = rng.integers(100, 900, 400)
    block = search.Block(list(range(400)), n, np.array(starts), np.array(terms), np.array(counts), 400, int(n.sum()))
    weights = np.zeros(320, dtype=np.int64)
    item = np.arange(0, 310, 2)
    weights[item] = rng.integers(0, 9000, len(item))
    got = search.search_block(block, item, weights, 20, [])
    every = block.scores(np.arange(400), weights)
    want = sorted((-int(s), False, i) for i, s in enumerate(every) if s > 0)[:20]
    assert got == want


def test_lengths_do_not_overflow():
    n = np.array([1, 10**7])
    exact = [75 + 25 * int(x) * 10**12 // (3 * 10**14) for x in n]
    assert search.lengths(n, 10**12, 3 * 10**14).tolist() == exact


# ---- urls -------------------------------------------------------------------


ODD_URLS = [
    None, "", "x", "://", "http://", "HTTP://A.ORG", "http://a.org/?x#y", "a://b://c/d", "http://EXAMPLE.org/en/1\n2?",
    "http://nexample.org/es/", "http://example.org/es", "http://www.example.org/es/", "http://example.org/en/12/x",
    "http://example.org//en/1", "http://.org/", "http://org./", "http://com/fr/", "http://x.com/fr/../de/", "s://h#/a",
    "s://com:80/fr/", "http://org" + "/a" * 50_000, "http://" + "a." * 50_000 + "org/",
]


@pytest.fixture(scope="module")
def odd_pages(spark):
    rows = [(i, u, "h", "p", "r", "v", "m") for i, u in enumerate(ODD_URLS)]
    return spark.createDataFrame([*rows, rows[7], (None, "http://a.com/de/1", None, None, None, None, None)], PAGES)


@pytest.mark.parametrize("limit", [urls.TRIE_BYTES, 150])
def test_odd_urls_equal_sql(spark, tmp_path, odd_pages, limit):
    connection = as_tables(spark, tmp_path, pages=odd_pages)
    same(urls.judge(odd_pages, queries.URL_ENTRIES, limit=limit), connection.sql(queries.ORACLES["op13_url_trie"]))


def test_many_entries_equal_a_plain_loop(spark):
    rng = random.Random(9)
    label = lambda: rng.choice("abc")
    path = lambda n: "".join(rng.choice(["/", "a", "b", "ab"]) for _ in range(rng.randrange(n)))
    entries = [(".".join(label() for _ in range(rng.randrange(4))), rng.choice(["", "/" + path(5)]), rng.choice(["allow", "block"])) for _ in range(120)]
    given = [*entries, (None, "/", "block"), ("a", None, "allow"), ("b", "/", "maybe"), entries[0], ("A.B", "/Q", "block"), ("c.c", "/x", "allow"), ("c.c", "/x", "block")]
    rules = {}
    for h, p, v in given:
        if h is not None and v in ("allow", "block"):
            key = (h.lower(), p or "")
            rules[key] = "block" if "block" in (rules.get(key), v) else "allow"
    pages = [(i, f"http://{'.'.join(label() for _ in range(rng.randrange(1, 5)))}{rng.choice(['', '/' + path(7), '/Q', '/xy'])}") for i in range(400)]
    want = {}
    for i, url in pages:
        host, _, rest = url[7:].partition("/")
        seen = "/" + rest if "/" in url[7:] else ""
        fits = [(len(h.split(".")) if h else 0, len(p), h + p, v) for (h, p), v in rules.items()
                if (not h or host == h or host.endswith("." + h)) and seen.startswith(p)]
        want[i] = max(fits)[2:] if fits else (None, "block")
    table = spark.createDataFrame(given, "host string, path string, verdict string")
    df = spark.createDataFrame(pages, "page_id long, url string")
    for limit in (urls.TRIE_BYTES, 2000):
        got = {r.page_id: (r.rule, r.verdict) for r in urls.judge(df, table, default="block", limit=limit).collect()}
        assert got == want
    assert {r.page_id for r in urls.keep(df, table, default="block").collect()} == {i for i, x in want.items() if x[1] == "allow"}


def test_no_entries_and_no_pages(spark, odd_pages):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in urls.judge(odd_pages, none).collect()} == {"allow"}
    assert urls.judge(odd_pages.limit(0), queries.URL_ENTRIES).count() == 0
    kept = urls.keep(odd_pages, queries.URL_ENTRIES)
    assert kept.columns == odd_pages.columns and 0 < kept.count() < odd_pages.count()
