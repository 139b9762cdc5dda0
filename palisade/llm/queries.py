"""The corpus operators as queries over a directory of tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palisade.llm import ann, chat, jaccard, lm, packing, pieces, quality, repair, search, secrets, sharding, toxicity, urls
from palisade.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_nn_descent(spark: SparkSession, sf: str) -> DataFrame:
    return ann.nearest(table(spark, sf, "embeddings"), k=5, every=50)


@query
def op2_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.assess(table(spark, sf, "documents"))


@query
def op3_jaccard_groups(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.groups(table(spark, sf, "documents"))


@query
def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    return toxicity.score(documents, toxicity.fit(documents, table(spark, sf, "labels")))


TOOL_FIELDS = [
    chat.Field("reply", "query", "STRING", True),
    chat.Field("reply", "turn", "BIGINT", True),
    chat.Field("reply", "limit", "BIGINT", False),
    chat.Field("recall", "query", "STRING", True),
    chat.Field("recall", "depth", "BIGINT", True),
]


def conversation_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(calls, results) read from plain conversations.

    The tables hold no tool messages, so each assistant turn is taken as a call: its
    text is the query, every third one calls another tool (and lacks a field that the
    tool asks for), it needs the call before it, and the turn after it is its result.
    """
    block = F.floor(F.col("turn") / chat.ORDER_BLOCK).alias("block")
    spoken = conversations.where("role = 'assistant'").select("conv_id", "turn", "text", block)
    # The turn before is in the same block of turns or the last of the block before.
    last = spoken.groupBy("conv_id", "block").agg(F.max("turn").alias("last"))
    last = last.select("conv_id", "block", F.lag("last").over(Window.partitionBy("conv_id").orderBy("block")).alias("last"))
    earlier = Window.partitionBy("conv_id", "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.max("turn").over(earlier), "last")
    name = lambda turn: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    said = spoken.join(last, ["conv_id", "block"], "left").select(
        F.col("conv_id").alias("conv"), name(F.col("turn")).alias("call"), "turn",
        F.when(F.col("turn") % 3 == 0, F.lit("recall")).otherwise(F.lit("reply")).alias("name"),
        F.to_json(F.struct(F.col("turn"), F.col("text").alias("query"))).alias("arguments"),
        before.alias("before"), F.col("conv_id"),
    )
    needs = F.when(F.col("before").isNotNull(), F.array(name(F.col("before")))).otherwise(F.array().cast("array<string>"))
    calls = said.select("conv", "call", "turn", "name", "arguments", needs.alias("needs"))
    results = conversations.select(
        F.col("conv_id").alias("conv"), name(F.col("turn") - 1).alias("call"), F.col("text").alias("content")
    )
    return calls, results


@query
def op5_tool_links(spark: SparkSession, sf: str) -> DataFrame:
    calls, results = conversation_calls(table(spark, sf, "conversations"))
    linked = chat.link(calls, results, TOOL_FIELDS)
    return linked.select(
        F.col("conv").alias("conv_id"), F.col("call").alias("call_id"), F.col("position").cast("long").alias("position"),
        F.col("depth").cast("long").alias("depth"), "matched", F.array_join("errors", "; ").alias("errors"), "json",
    )


ORACLES["op5_tool_links"] = """
WITH a AS (
  SELECT conv_id, turn, text, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS before,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS k
  FROM conversations WHERE role = 'assistant'
), r AS (
  SELECT conv_id, turn - 1 AS turn, min(text) AS content FROM conversations GROUP BY 1, 2
)
SELECT a.conv_id, 'c' || a.conv_id || '-' || a.turn AS call_id, k AS position, k AS depth,
       r.turn IS NOT NULL AS matched,
       concat_ws('; ', CASE WHEN a.turn % 3 = 0 AND a.text IS NULL THEN 'query: missing'
                            WHEN a.turn % 3 <> 0 AND a.text IS NULL THEN 'query: missing' END,
                       CASE WHEN a.turn % 3 = 0 THEN 'depth: missing' END) AS errors,
       '{"arguments":{' || CASE WHEN a.text IS NULL THEN '' ELSE '"query":' || CAST(to_json(a.text) AS VARCHAR) || ',' END
       || '"turn":' || a.turn || '},"id":"c' || a.conv_id || '-' || a.turn
       || '","name":"' || CASE WHEN a.turn % 3 = 0 THEN 'recall' ELSE 'reply' END || '","result":'
       || coalesce(CAST(to_json(r.content) AS VARCHAR), 'null') || '}' AS json
FROM a LEFT JOIN r ON r.conv_id = a.conv_id AND r.turn = a.turn
"""


@query
def op6_best_fit_shards(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard(table(spark, sf, "documents"), 40)


@query
def op7_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    return secrets.report(documents, secrets.fit(secrets.labelled_tokens(documents, "doc_id", "text")))


@query
def op8_log_bilinear(spark: SparkSession, sf: str) -> DataFrame:
    return lm.score(table(spark, sf, "documents"))


@query
def op9_mixture_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"))


@query
def op10_gumbel_segmentations(spark: SparkSession, sf: str) -> DataFrame:
    return pieces.encode(table(spark, sf, "documents"), ["doc_id"])


@query
def op11_block_table_repair(spark: SparkSession, sf: str) -> DataFrame:
    return repair.report(table(spark, sf, "conversations"))


@query
def op12_mask_search(spark: SparkSession, sf: str) -> DataFrame:
    return search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"), k=20)


URL_ENTRIES = [
    urls.Entry("org", "/", "allow"),
    urls.Entry("example.org", "/es/", "block"),
    urls.Entry("example.org", "/en/1", "block"),
    urls.Entry("com", "/fr/", "allow"),
    urls.Entry("com", "/de/", "block"),
]


@query
def op13_url_trie(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judge(table(spark, sf, "pages"), URL_ENTRIES)


_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(quality.STOP_WORDS))
_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

ORACLES["op2_quality_rules"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), win AS (
  SELECT k, i, array_to_string(w[i:i + 7], ' ') AS g
  FROM (SELECT k, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)
), rep AS (
  SELECT k, count(DISTINCT i + o) AS n
  FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS c FROM win), range(0, 8) t(o) WHERE c > 1 GROUP BY k
), m AS (
  SELECT d.k, doc_id, len(w) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
         len(lines) AS n_lines, len(list_filter(w, lambda x: lower(x) IN ({_STOPS}))) AS n_stop_words,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_stutters
  FROM d LEFT JOIN rep USING (k)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
         AND word_chars / n_words BETWEEN 2.0 AND 14.0 AND n_symbols / n_words <= 0.1 AND n_stop_words / n_words >= 0.02
         AND n_dup_lines / n_lines <= 0.4 AND n_stutters / n_words <= 0.3 AND n_repeat_words / n_words <= 0.3 AS kept,
       CAST(n_lines AS BIGINT) AS n_lines, CAST(n_stop_words AS BIGINT) AS n_stop_words
FROM m
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLES["op3_jaccard_groups"] = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2
  ) JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1) c USING (doc_id)
"""

ORACLES["op11_block_table_repair"] = r"""
WITH RECURSIVE o AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key,
         dense_rank() OVER (ORDER BY conv_id) AS k
  FROM conversations
), z AS (
  SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(range(1, len(key) + 1),
           lambda i: list_prepend(CAST(ord(substr(key, i, 1)) AS BIGINT), [-1, -1, -1, -1, -1, -1, -1, -1])))),
         lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) END),
         4294967295) % 20 AS m
  FROM o
), d AS (
  SELECT k, conv_id, turn, CASE WHEN m = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN m = 1 THEN '' WHEN m = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM z, range(0, 2) t(copy) WHERE m <> 0 AND (m = 3 OR copy = 0)
), n AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, sha256(role || chr(10) || text)) AS i FROM d
), f AS (
  SELECT *, left(role, 1) AS r,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault
  FROM n
), s AS (
  SELECT k, i, role, text, r, coalesce(lag(r) OVER (PARTITION BY k ORDER BY i), '') AS p, turn, fault,
         fault IN ('blank', 'duplicate') AS del, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS e FROM f
), b AS (
  SELECT k, CAST(max(i) + 1 AS BIGINT) AS i, [0, 6, 3, 0] AS g FROM s GROUP BY k
  UNION ALL
  SELECT k, i, [least(h[1], 3 + least(h[3], 3 + h[4])), least(h[2], 3 + least(h[3], 3 + h[4])), least(h[3], 3 + h[4]), least(h[4], 3 + h[3])]
  FROM (
    SELECT s.k, s.i, CASE WHEN del THEN list_transform(g, lambda x: 4 + x) ELSE [
        least(4 + g[1], 3 + e + g[3], CASE r WHEN 's' THEN e + g[2] WHEN 'u' THEN e + g[3] ELSE 999 + g[1] END),
        least(4 + g[2], 3 + e + g[3], CASE r WHEN 'u' THEN e + g[3] ELSE 999 + g[1] END),
        least(4 + g[3], 3 + e + g[4], CASE r WHEN 'a' THEN e + g[4] ELSE 999 + g[1] END),
        least(4 + g[4], 3 + e + g[3], CASE r WHEN 'u' THEN e + g[3] ELSE 999 + g[1] END)] END AS h
    FROM b JOIN s ON s.k = b.k AND s.i = b.i - 1
  )
), w AS (
  SELECT k, CAST(1 AS BIGINT) AS i, 0 AS q, '' AS audit, CAST([] AS VARCHAR[]) AS o, min(g[1]) FILTER (WHERE i = 1) AS cost FROM b GROUP BY k
  UNION ALL
  SELECT k, CASE WHEN x = 'I' THEN i ELSE i + 1 END,
         CASE WHEN x = 'D' THEN q WHEN x = 'K' AND q = 0 AND r = 's' THEN 1 ELSE nx END, audit || x,
         CASE WHEN x = 'D' THEN o WHEN x = 'K' THEN list_append(o, role || ':' || text)
              ELSE list_append(o, CASE WHEN nx = 2 THEN 'user:' ELSE 'assistant:' END || CASE WHEN x = 'R' THEN text ELSE '' END) END, cost
  FROM (
    SELECT w.*, s.role, s.text, s.r, [2, 2, 3, 2][q + 1] AS nx,
           CASE WHEN s.i IS NULL THEN 'I'
                WHEN 4 + y.g[q + 1] = b.g[q + 1] THEN 'D'
                WHEN 3 + b.g[[2, 2, 3, 2][q + 1] + 1] = b.g[q + 1] THEN 'I'
                WHEN (r = 's' AND q = 0 AND e + y.g[2] = b.g[q + 1]) OR (r = 'u' AND q <> 2 AND e + y.g[3] = b.g[q + 1])
                  OR (r = 'a' AND q = 2 AND e + y.g[4] = b.g[q + 1]) THEN 'K'
                ELSE 'R' END AS x
    FROM w JOIN b ON b.k = w.k AND b.i = w.i LEFT JOIN s ON s.k = w.k AND s.i = w.i LEFT JOIN b y ON y.k = w.k AND y.i = w.i + 1
    WHERE s.i IS NOT NULL OR q IN (1, 2)
  )
), done AS (
  SELECT w.k, cost, audit, sha256(array_to_string(o, chr(10))) AS seal FROM w JOIN (SELECT k, max(i) AS i FROM b GROUP BY k) e ON e.k = w.k AND e.i = w.i
  WHERE q IN (0, 3)
), c AS (
  SELECT k, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
         count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE i > 1 AND p || r NOT IN ('su', 'ua', 'au')) AS illegal FROM s GROUP BY k
)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, coalesce(seal, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT k, conv_id FROM o) LEFT JOIN c USING (k) LEFT JOIN done USING (k)
"""

_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLES["op12_mask_search"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, {_TERMS} AS w FROM documents
), i AS (
  SELECT row_number() OVER () AS j, item_id, {_TERMS} AS w FROM benchmark
), c AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0
), it AS (SELECT j, item_id, t, count(*) AS r FROM (SELECT j, item_id, unnest(w) AS t FROM i) GROUP BY ALL
), tf AS (
  SELECT k, doc_id, t, count(*) AS tf, n FROM (SELECT k, doc_id, len(w) AS n, unnest(w) AS t FROM d)
  WHERE t IN (SELECT t FROM it) GROUP BY ALL
), wt AS (
  SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, c GROUP BY t, n_docs
), s AS (
  SELECT j, item_id, k, doc_id, CAST(sum(r * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM tf JOIN wt USING (t) JOIN it USING (t), c GROUP BY j, item_id, k, doc_id
)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY j ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0
) WHERE rank <= 20
"""

_FITS = " UNION ALL ".join(
    f"SELECT '{e.host}' AS h, '{e.path}' AS p, '{e.verdict}' AS v" for e in URL_ENTRIES
)
ORACLES["op13_url_trie"] = rf"""
WITH u AS (
  SELECT row_number() OVER () AS k, page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages
), e AS ({_FITS}
), m AS (
  SELECT k, h || p AS rule, v, row_number() OVER (PARTITION BY k ORDER BY length(h) DESC, length(p) DESC) AS best
  FROM u JOIN e ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM u LEFT JOIN m ON m.k = u.k AND best = 1
"""
