"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The symbols are normalised words, the patterns every window of ten
consecutive words of a benchmark item (an item of fewer words is one window).
Patterns of one length share a searcher: its SHIFT table tells for each block
(two neighbouring words) how far the search may jump, its suffix buckets hold
the patterns that end in a block, and a bucket's patterns are compared
directly with the words of the text.

The patterns are the query set, the documents stream past them: no shuffle of
documents as long as all patterns fit one block of ``block_patterns``. A larger
benchmark is searched block by block, and what the blocks find in a text is
merged.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .components import saved

WINDOW = 10
#: (pattern, item) pairs searched, and broadcast, at a time.
BLOCK_PATTERNS = 200_000
#: A-Z become a-z; every other ASCII character but 0-9 and a-z parts words.
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
               for b in range(256))

FOUND = StructType([
    StructField("n_words", LongType()),
    StructField("spans", ArrayType(ArrayType(LongType()))),
    StructField("item_ids", ArrayType(StringType())),
])


def normal_words(text: str | None) -> list[bytes]:
    """The normalised words of one text (null: none)."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


class Searcher:
    """Wu-Manber tables for patterns of one length."""

    def __init__(self, patterns: dict[tuple, set]):
        self.length = m = len(next(iter(patterns)))
        self.block = b = min(2, m)
        self.default = m - b + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, list] = defaultdict(list)
        for p, items in patterns.items():
            for end in range(b, m + 1):
                key = p[end - b:end]
                self.shift[key] = min(self.shift.get(key, self.default), m - end)
            self.buckets[p[m - b:]].append((list(p), items))

    def search(self, words: list[bytes], starts: list[int], items: set) -> None:
        """Append the start of every occurrence and add its items."""
        m, default, shift, buckets = self.length, self.default, self.shift, self.buckets
        end, n = m, len(words)
        pair = self.block == 2
        while end <= n:
            key = (words[end - 2], words[end - 1]) if pair else (words[end - 1],)
            jump = shift.get(key, default)
            if jump:
                end += jump
                continue
            here = words[end - m:end]
            for pattern, owners in buckets[key]:
                if pattern == here:
                    starts.append(end - m)
                    items |= owners
                    break
            end += 1


class PatternSet:
    """The searchers of a set of ``(window, item)`` pairs."""

    def __init__(self, pairs):
        by_length: dict[int, dict[tuple, set]] = defaultdict(dict)
        for window, item in pairs:
            p = tuple(w.encode("utf-8", "surrogatepass") for w in window)
            owners = by_length[len(p)].setdefault(p, set())
            if item is not None:
                owners.add(item)
        self.searchers = [Searcher(by_length[n]) for n in sorted(by_length)]

    def find(self, words: list[bytes]) -> tuple[list, list]:
        """Merged ``[start, end)`` spans of words, and the sorted items."""
        spans, items = [], set()
        for s in self.searchers:
            starts: list[int] = []
            s.search(words, starts, items)
            spans += [(a, a + s.length) for a in starts]
        return merge_spans(spans), sorted(items)


def merge_spans(spans) -> list[list[int]]:
    """Overlapping and touching spans made one, in order."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct ``(words, item)`` pairs: each window of each item.

    ``item`` is the id as a string; items without words give no row.
    """
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    text = F.translate(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), upper, lower)
    words = F.regexp_extract_all(text, F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0))
    w = items.select(F.col(f"`{id_col}`").cast("string").alias("item"), words.alias("w")).where(F.size("w") > 0)
    at = F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)))
    return w.select("item", F.explode(at).alias("i"), "w").select(F.expr(f"slice(w, i, {window})").alias("words"), "item").distinct()


def _scan(patterns, text: Column) -> Column:
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        find = patterns.value.find
        for s in texts:
            rows = []
            for t in s:
                words = normal_words(t)
                rows.append((len(words), *find(words)))
            yield pd.DataFrame(rows, columns=["n_words", "spans", "item_ids"])
    return F.pandas_udf(run, FOUND)(text)


def _merge(lists: Column) -> Column:
    def run(found: pd.Series) -> pd.Series:
        return found.map(lambda parts: [list(map(int, x)) for x in merge_spans(tuple(map(int, y)) for p in parts for y in p)])
    return F.pandas_udf(run, ArrayType(ArrayType(LongType())))(lists)


def find_benchmark_passages(spark: SparkSession, docs: DataFrame, items: DataFrame, text_col: str = "text",
                            item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                            block_patterns: int = BLOCK_PATTERNS) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (merged ``[start, end)`` word
    ranges that stand inside occurrences of benchmark windows), ``item_ids``
    (sorted), ``n_hit`` (words inside) and ``contaminated``.

    The pairs of a block are hashed out evenly, so a block sent to the
    executors has about ``block_patterns`` rows at most, however large an item
    is or however many items share a window.

    Defined results: a null or wordless text has no words and no hits;
    wordless items match nothing; an item with a null id marks its hits but is
    not listed; no items, or an empty input, hit nothing; repeated rows are
    each searched; very long texts are searched whole; other columns pass through, and a column with the name of a
    result is replaced.
    """
    out = ["n_words", "spans", "item_ids", "n_hit", "contaminated"]
    pairs = saved(spark, benchmark_windows(items, item_id_col, item_text_col, window), "windows")
    blocks = max(1, -(-pairs.count() // block_patterns))
    keyed = pairs.withColumn("k", F.pmod(F.xxhash64("words", "item"), F.lit(blocks)))
    text = F.col(f"`{text_col}`")

    def patterns(k: int):
        return spark.sparkContext.broadcast(PatternSet((r["words"], r["item"]) for r in keyed.where(F.col("k") == k).collect()))

    kept = [F.col(f"`{c}`") for c in docs.columns if c not in out]
    if blocks == 1:
        found = docs.select(*kept, _scan(patterns(0), text).alias("__f")).select(*kept, "__f.*")
    else:
        parts = None
        for k in range(blocks):  # one bounded block of patterns at a time over all documents
            hits = (docs.select(F.sha2(text, 256).alias("__t"), _scan(patterns(k), text).alias("f"))
                    .select("__t", "f.spans", "f.item_ids").where(F.size("spans") > 0).dropDuplicates(["__t"]))
            hits = saved(spark, hits, "hits")
            parts = hits if parts is None else parts.unionByName(hits)
        merged = parts.groupBy("__t").agg(_collect("spans"), _collect("item_ids")).select(
            "__t", _merge(F.col("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten("item_ids"))).alias("item_ids"))
        n = F.pandas_udf(_count_words, LongType())(text)
        found = (docs.select(*kept, n.alias("n_words"), F.sha2(text, 256).alias("__t")).join(merged, "__t", "left")
                 .select(*kept, "n_words", F.coalesce("spans", F.array().cast("array<array<bigint>>")).alias("spans"),
                         F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])
    return found.withColumns({"n_hit": n_hit, "contaminated": n_hit > 0})


def _count_words(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: len(normal_words(t)))


def _collect(c: str) -> Column:
    return F.collect_list(c).alias(c)
