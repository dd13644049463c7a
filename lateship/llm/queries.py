"""One query per operator of this package, with production parameters.

``QUERIES`` and ``ORACLES`` are merged into the catalogue by
``__spark_entry__``. Each query applies its operator to the whole table and
derives the agreed columns from the operator's own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from ..sources.tables import table
from . import html_template, licenses, packing, token_alignment, tool_calls, url_filter, warc
from .components import saved
from .bag_search import bag_search
from .decontaminate import find_benchmark_passages
from .minhash import minhash_near_duplicates
from .quality_rules import quality_rules
from .simhash import simhash_near_duplicates
from .token_counts import token_counts

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP4_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, {WORDS_SQL} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
m AS (
  SELECT doc_id, w, l, len(w) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines,
         CASE WHEN len(w) >= 8 THEN list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i+7], chr(10)))
              ELSE [] END AS win
  FROM d),
pos AS (SELECT doc_id, unnest(win) AS g, unnest(range(1, len(win) + 1)) AS i FROM m),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM pos) WHERE c > 1),
rep AS (SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n_repeat_words
        FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM dup) GROUP BY doc_id),
r AS (
  SELECT m.*, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         len(list_filter(w, lambda x: x IN (__STOPS__))) AS n_stop,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i-1])) AS n_echo,
         len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09]*[-*•·]'))) AS n_bullet,
         len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis
  FROM m LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
             greatest(n_words, 1) AS nw, greatest(word_chars, 1) AS nc, greatest(len(l), 1) AS nl FROM r)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / nw BETWEEN 2.0 AND 20.0 AND n_symbols / nw <= 0.10 AND n_symbols / nc <= 0.10
       AND n_stop / nw >= 0.02 AND n_echo / nw <= 0.20 AND n_dup_lines / nl <= 0.60 AND n_bullet / nl <= 0.90
       AND n_ellipsis / nl <= 0.30 AS kept
FROM b
"""


def _op4_sql() -> str:
    from .quality_rules import STOP_WORDS
    stops = {w for ws in STOP_WORDS.values() for w in ws}
    stops |= {w.capitalize() for w in stops}
    return OP4_SQL.replace("__STOPS__", ", ".join(f"'{w}'" for w in sorted(stops)))


@query("op4_quality_rules", _op4_sql())
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                      "n_repeat_words", "base_failed", "kept")


OP5_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i:i+9], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT m FROM bw),
dw AS (SELECT doc_id, m, i, array_to_string(w[i:i+m-1], ' ') AS g
       FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, lens WHERE len(w) >= m)),
hit AS (SELECT doc_id, dw.m, i, item_id FROM dw JOIN bw ON dw.m = bw.m AND dw.g = bw.g),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT doc_id, m, i FROM hit)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op5_benchmark_decontamination", OP5_SQL)
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = find_benchmark_passages(spark, docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def packed(docs: DataFrame) -> DataFrame:
    """Documents packed with the production vocabulary and window."""
    import public_tokenizers
    return packing.pack_sequences(docs, public_tokenizers.path("byte_bpe_50k.json"),
                                  public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op10_simhash_near_dedup")
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near_duplicates(spark, table(spark, sf_dir, "documents", "doc_id", "text"), shingle=3, max_bits=2)


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    counted = token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"), limit=4096)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
m AS (SELECT h, min(page_id) AS first_id FROM p GROUP BY h),
d AS (SELECT page_id, first_id, octet_length(encode(h)) AS payload_bytes, upper(sha1(h)) AS x FROM p JOIN m USING (h)),
b AS (SELECT *, list_transform(range(0, 32), lambda k: list_reduce(list_transform(range(k * 5, k * 5 + 5), lambda j:
        ((strpos('0123456789ABCDEF', substr(x, CAST(j // 4 AS INTEGER) + 1, 1)) - 1) >> (3 - CAST(j % 4 AS INTEGER))) & 1),
        lambda s, v: s * 2 + v)) AS digits FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(digits, lambda v: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v AS INTEGER) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM b
"""


@query("op2_warc_segments", OP2_SQL)
def op2_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark, 'warc')}/archives"
    warc.write_archives(table(spark, sf_dir, "pages", "page_id", "url", "html"), path, "page_id", "url", "html")
    return warc.read_archives(spark, path).select(
        F.col("row_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"))


#: The production rules: host, path, verdict.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


@query("op7_url_filter")
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    return url_filter.filter_urls(spark, pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "score")


@query("op9_html_templates")
def op9_html_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    found = html_template.extract_main_text(spark, pages)
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


def _op3_sql() -> str:
    rows = ", ".join("('{}', {}, [{}], {}, {})".format(
        t.license, t.number, ", ".join(f"'{g}'" for g in t.bigrams), *licenses.size_bounds(len(t.bigrams), licenses.THRESHOLD))
        for t in licenses.templates())
    return f"""
WITH t(license, number, grams, lo, hi) AS (VALUES {rows}),
l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls, coalesce(text, '') AS text FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS line, unnest(ls) AS t FROM l
      UNION ALL SELECT doc_id, 0, text FROM l WHERE len(ls) > 1),
w AS (SELECT doc_id, line, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z]+') AS w FROM p),
g AS (SELECT doc_id, line, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM w WHERE len(w) > 1),
h AS (SELECT doc_id, line, license, 2 * len(list_intersect(g, grams)) / (len(g) + len(grams)) AS dice
      FROM g JOIN t ON len(g) BETWEEN lo AND hi),
m AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, max(dice) AS best,
             string_agg(DISTINCT CAST(line AS VARCHAR), ',' ORDER BY CAST(line AS VARCHAR)) AS lines
      FROM h WHERE dice >= {licenses.THRESHOLD} GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_matches, coalesce(licenses, '') AS licenses, coalesce(lines, '') AS lines, coalesce(best, 0.0) AS best_dice
FROM documents LEFT JOIN m USING (doc_id)
"""


@query("op3_license_scan", _op3_sql())
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents", "doc_id", "text"))
    e = F.col("licenses")
    return found.select(
        "doc_id", F.size(e).cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(e, lambda x: x["license"]))), ",").alias("licenses"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(e, lambda x: x["line"].cast("string")))), ",").alias("lines"),
        F.coalesce(F.array_max(F.transform(e, lambda x: x["dice"])), F.lit(0.0)).alias("best_dice"))


#: The tools of the derived calls.
TOOL_SCHEMAS = {
    "search": {"type": "object", "required": ["query"], "additionalProperties": False, "properties": {
        "query": {"type": "string", "minLength": 1}, "limit": {"type": "integer", "minimum": 1, "maximum": 50}, "after": {"type": "object"}}},
    "translate": {"type": "object", "required": ["query"], "additionalProperties": False, "properties": {
        "query": {"type": "string"}, "limit": {"type": "integer"}, "after": {"type": "object"}}},
    "rate": {"type": "object", "required": ["query", "limit"], "properties": {
        "query": {"type": "string", "maxLength": 2000}, "limit": {"type": ["integer", "null"], "maximum": 40}}},
}


def derived_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tool calls and results that the turns of ``conversations`` stand for.

    Every assistant turn is a call whose arguments hold its text; the turn
    after it, if it is a user's, is the result. A hash of the turn picks the
    tool (one in four is unknown), a limit (some are out of bounds, some are
    no integers) and a reference to another call (mostly an earlier one,
    sometimes a later one, which may close a cycle).
    """
    h = F.xxhash64("conv_id", "turn", "text")
    of = lambda t: F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), t.cast("string"))
    pick = lambda n: F.pmod(F.shiftright(h, 8 * (n % 6)), F.lit(n))
    tool = F.element_at(F.array(*[F.lit(t) for t in ("search", "translate", "rate", "paint")]), (pick(4) + 1).cast("int"))
    limit = F.when(pick(17) == 0, F.lit('"ten"')).otherwise(F.pmod(h, F.lit(53)).cast("string"))
    other = F.when(pick(31) == 0, F.col("turn") + 2).when(pick(3) == 0, F.col("turn") - 2)
    after = F.when(other.isNotNull(), F.concat(F.lit(', "after" : {"$ref": "'), of(other), F.lit('"}'))).otherwise(F.lit(""))
    query = F.regexp_replace(F.to_json(F.struct(F.col("text").alias("query"))), r"\}$", "")
    arguments = F.concat(query, after, F.lit(', "limit" : '), limit, F.lit("}"))
    calls = turns.where("role = 'assistant'").select(
        F.col("conv_id").alias("conv"), F.col("turn").alias("position"), of(F.col("turn")).alias("call"), tool.alias("name"),
        arguments.alias("arguments"))
    results = turns.where("role = 'user'").select(
        F.col("conv_id").alias("conv"), F.col("turn").alias("position"), of(F.col("turn") - 1).alias("call"), F.col("text").alias("content"))
    return calls, results


@query("op1_tool_calls")
def op1_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = derived_calls(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    linked = tool_calls.link_tool_calls(spark, calls, results, TOOL_SCHEMAS)
    return linked.select(F.col("conv").cast("long").alias("conv_id"), F.col("position").alias("turn"), F.col("call").alias("call_id"),
                         "name", "level", "status", F.size("errors").cast("long").alias("n_errors"), "message")


OP11_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g
      FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT u, v FROM pairs JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 80 * (x.n + y.n - c)),
arcs AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.v, reach.r FROM reach JOIN arcs e ON e.u = reach.doc_id),
low AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN low ON low.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


@query("op11_minhash_near_dedup", OP11_SQL)
def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return minhash_near_duplicates(spark, docs, shingle=2, percent=80).select("doc_id", "n_shingles", "component_id", "kept")


OP12_SQL = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
v AS (SELECT DISTINCT item_id, unnest(w) AS g FROM b),
c AS (SELECT count(*) AS nd, CAST(sum(len(w)) AS BIGINT) AS nl FROM t WHERE len(w) > 0),
tf AS (SELECT doc_id, g, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS g FROM t) WHERE g IN (SELECT g FROM v) GROUP BY doc_id, g),
df AS (SELECT g, count(*) AS df FROM tf GROUP BY g),
m AS (SELECT doc_id, 100 - 90 + (90 * len(w) * nd) // nl AS m FROM t, c WHERE len(w) > 0),
s AS (SELECT item_id, doc_id, CAST(sum(CAST(floor(1000 * ln((2 * nd + 2) / (2 * df + 1))) AS BIGINT)
                                       * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM v JOIN tf ON tf.g = v.g JOIN df ON df.g = v.g JOIN m USING (doc_id), c GROUP BY item_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10
"""


@query("op12_ranked_search", OP12_SQL)
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_search(spark, table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as p
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    aligned = token_alignment.alignments(docs, p.path("byte_bpe_50k.json"), p.path("piece_bpe_32k.model"), p.path("byte_bpe_50k.tiktoken"))
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    aligned = saved(spark, aligned.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    return token_alignment.link_statistics(spark, aligned).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
