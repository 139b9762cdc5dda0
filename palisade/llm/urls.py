"""Allow and block entries for URLs, matched in a trie.

An entry is a host and a path.  It fits its host and all subdomains, where the URL's
path starts with the entry's.  The trie goes down the host's labels from the last to
the first and then the path's segments; what follows the last slash of an entry is
kept at its node and may be the start of a segment.  The longest match decides: of all
entries that fit, those of the longest host, and of these the longest path.

The trie is broadcast, so its size is checked: entries of more than TRIE_BYTES of text
are dealt by a hash over several tries, each built and applied in turn, and the longest
of their matches is taken.  The driver holds one of them at a time.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.llm.common import stored

TRIE_BYTES = 16 << 20
ENTRY_BYTES = 64  # counted for each entry besides its text

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
MATCH = "labels int, chars int, rule string, verdict string"


class Entry(NamedTuple):
    host: str
    path: str
    verdict: str


def host_of(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def build_trie(entries: Iterable[tuple[str, str, str]]) -> tuple[dict, dict, dict]:
    """(steps, ends, lengths): (node, label) -> node, node -> {start of a segment: match},
    and node -> longest such start.

    Node 0 is the root.  Steps into the path carry a slash before the segment, so they
    differ from host labels.  Of entries with one host and path, block wins.
    """
    steps: dict[tuple[int, str], int] = {}
    ends: dict[int, dict[str, tuple]] = {}
    for host, path, verdict in entries:
        labels = host.split(".")[::-1] if host else []
        *whole, last = path.split("/")
        node = 0
        for step in [*labels, *("/" + s for s in whole)]:
            node = steps.setdefault((node, step), len(steps) + 1)
        held = ends.setdefault(node, {})
        if last not in held or verdict == "block":
            held[last] = (len(labels), len(path), host + path, verdict)
    return steps, ends, {node: max(map(len, held)) for node, held in ends.items()}


def longest(trie: tuple[dict, dict, dict], host: str, path: str) -> tuple | None:
    """The longest match of a URL's host and path, or None."""
    steps, ends, lengths = trie
    nodes = [0]
    for label in reversed(host.split(".")):
        node = steps.get((nodes[-1], label))
        if node is None:
            break
        nodes.append(node)
    segments = path.split("/")
    for node in reversed(nodes):
        found = None
        for i, segment in enumerate(segments):
            starts = ends.get(node)
            if starts:
                for size in range(min(len(segment), lengths[node]), -1, -1):
                    if segment[:size] in starts:
                        found = starts[segment[:size]]
                        break
            node = steps.get((node, "/" + segment)) if i + 1 < len(segments) else None
            if node is None:
                break
        if found:
            return found
    return None


def _looked_up(df: DataFrame, entries: list[tuple[str, str, str]]) -> Column:
    """Match of columns __host and __path in one broadcast trie."""
    trie = df.sparkSession.sparkContext.broadcast(build_trie(entries))

    @F.arrow_udf(MATCH)
    def match(host: pa.Array, path: pa.Array) -> pa.Array:
        table = trie.value
        got = [longest(table, h, p) for h, p in zip(host.to_pylist(), path.to_pylist(), strict=True)]
        kinds = [("labels", pa.int32()), ("chars", pa.int32()), ("rule", pa.string()), ("verdict", pa.string())]
        rows = [g and dict(zip(("labels", "chars", "rule", "verdict"), g, strict=True)) for g in got]
        return pa.array(rows, pa.struct(kinds))

    return match("__host", "__path")


def _entries(df: DataFrame, entries) -> DataFrame:
    """Clean (host, path, verdict): hosts in lower case, null paths empty, no null hosts."""
    if not isinstance(entries, DataFrame):
        entries = df.sparkSession.createDataFrame([tuple(e) for e in entries], "host string, path string, verdict string")
    known = F.col("verdict").isin("allow", "block")
    return entries.where(known & F.col("host").isNotNull()).select(
        F.translate(F.col("host"), UPPER, LOWER).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        "verdict",
    ).distinct()


def matched(df: DataFrame, entries, url_col: str = "url", limit: int = TRIE_BYTES) -> DataFrame:
    """``df`` with __host, __path and __match (null where no entry fits)."""
    clean = _entries(df, entries)
    size = clean.agg(F.sum(F.octet_length("host") + F.octet_length("path") + ENTRY_BYTES)).first()[0] or 0
    tries = max(1, -(-size // limit))
    result = df.withColumns({"__host": host_of(F.col(url_col)), "__path": path_of(F.col(url_col))})
    if tries > 1:
        clean = stored(clean.withColumn("trie", F.pmod(F.xxhash64("host", "path"), F.lit(tries))), "entries")
    found = []
    for i in range(tries):
        part = clean.where(F.col("trie") == i) if tries > 1 else clean
        some = [(r["host"], r["path"], r["verdict"]) for r in part.select("host", "path", "verdict").collect()]
        result = result.withColumn(f"__match_{i}", _looked_up(df, some))
        found.append(F.col(f"__match_{i}"))
    best = F.greatest(*found) if tries > 1 else found[0]
    return result.withColumn("__match", best).drop(*[f"__match_{i}" for i in range(tries)])


def judge(df: DataFrame, entries, id_col: str = "page_id", url_col: str = "url", default: str = "allow",
          limit: int = TRIE_BYTES) -> DataFrame:
    """(id, host, path, rule, verdict): one output row for each input row.

    ``entries`` is a table or list of (host, path, verdict); rows with a null host or
    another verdict than allow and block are left out, a null path is empty, and an
    empty host fits every host.  ``default`` is the verdict where no entry fits.

    A null URL, or one without ://, has an empty host and path.  Repeated rows and rows
    without an id are judged one by one; URLs are read whole, whatever their length.
    An empty table gives an empty result, and without entries every row gets the
    default.  Other columns of ``df`` are not read.
    """
    rows = matched(df.select(F.col(id_col).alias("__id"), F.col(url_col).alias("__url")), entries, "__url", limit)
    return rows.select(
        F.col("__id").alias(id_col),
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        F.col("__match")["rule"].alias("rule"),
        F.coalesce(F.col("__match")["verdict"], F.lit(default)).alias("verdict"),
    )


def keep(df: DataFrame, entries, url_col: str = "url", default: str = "allow") -> DataFrame:
    """The rows of ``df`` whose URL is allowed, all columns unchanged; see ``judge``."""
    verdict = F.coalesce(F.col("__match")["verdict"], F.lit(default))
    return matched(df, entries, url_col).where(verdict == "allow").select(*[F.col(f"`{c}`") for c in df.columns])
