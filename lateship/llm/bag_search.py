"""Ranked lexical search by bag deduplication.

A set of items (the queries) ranks all documents by an integer BM25 score.

1. One Arrow-batched pass restricts each document to the items' vocabulary:
   what is left is its bag, the sorted (term, tf) vector packed into longs,
   and its number of terms n. The rest works on bags, never on texts.
2. Counts over all documents, pre-aggregated: N and L, and df of each term.
3. m depends on n only through a few values, so documents with the same bag
   and the same m score alike for every item. They form a class: grouped by a
   hash of both, and by bag and m themselves, so that equal hashes are
   verified. A class is (bag, m, smallest doc_id), however many members.
4. Each class is scored once, against all items, in Arrow batches; a task
   keeps the best ``top`` classes of each item and returns only those.
5. A document of an item's best ``top`` stands in one of the item's best
   ``top`` classes (by score, then smallest doc_id), so only these are
   expanded, by ascending doc_id and ``top`` members at most, cut before the
   shuffle.

The items are the query set. They are searched in blocks of about
``block_terms`` (item, term) pairs and ``block_items`` items, hashed by item,
so what is sent to the executors is bounded however many items there are.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from .components import dropped, saved
from .decontaminate import normal_words

TOP = 10
#: (item, term) pairs, and items, searched and broadcast at a time.
BLOCK_TERMS = 30_000
BLOCK_ITEMS = 500
#: Products of the scoring held at a time, which bounds a task's memory.
CELLS = 1 << 21
_LAST = np.iinfo(np.int64).max

_BAG = StructType([StructField("n", LongType()), StructField("bag", ArrayType(LongType()))])
_BEST = StructType([StructField("item", LongType()), StructField("score", LongType()), StructField("low", LongType()),
                    StructField("class", LongType())])


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct ``(item, term)``; wordless items and null ids give no row."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = F.regexp_extract_all(F.translate(F.col(f"`{text_col}`"), upper, lower), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0))
    return (items.where(F.col(f"`{id_col}`").isNotNull())
            .select(F.col(f"`{id_col}`").cast("long").alias("item"), F.explode(words).alias("term")).distinct())


def _bags(text: Column, numbers) -> Column:
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        number = numbers.value
        for s in texts:
            rows = []
            for t in s:
                words = normal_words(t)
                held = Counter(number[w] for w in words if w in number)
                rows.append((len(words), [(k << 32) | held[k] for k in sorted(held)]))
            yield pd.DataFrame(rows, columns=["n", "bag"])
    return F.pandas_udf(run, _BAG)(text)


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class ItemScorer:
    """Scores of bags for a block of items."""

    def __init__(self, terms: dict[int, list[int]], weights: dict[int, int]):
        self.items = np.array(sorted(terms), dtype=np.int64)
        self.matrix = np.zeros((max(weights, default=-1) + 1, len(self.items)), dtype=np.int64)
        for k, item in enumerate(self.items):
            for t in terms[item]:
                self.matrix[t, k] = weights[t]

    def scores(self, bags: list[np.ndarray], m: np.ndarray) -> np.ndarray:
        """``len(bags) x items`` scores (every bag holds a term)."""
        sizes = np.array([len(b) for b in bags])
        flat = np.concatenate(bags)
        tf = flat & 0xFFFFFFFF
        part = 1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, sizes))
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        return np.add.reduceat(self.matrix[flat >> 32] * part[:, None], starts, axis=0)


def _best(score: np.ndarray, low: np.ndarray, number: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` best by score, then smallest low, then number."""
    at = np.nonzero(score > 0)[0]
    if len(at) > top:
        least = np.partition(score[at], len(at) - top)[len(at) - top]
        at = at[score[at] >= least]
    return at[np.lexsort((number[at], low[at], -score[at]))][:top]


def _score_classes(scorer, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s: ItemScorer = scorer.value
        best = [np.empty((0, 3), dtype=np.int64) for _ in s.items]  # (score, low, class)
        per = max(1, CELLS // max(1, len(s.items)))
        for b in batches:
            bags, m = b.column(0), b.column(1).to_numpy(zero_copy_only=False)
            low = b.column(2).fill_null(_LAST).to_numpy(zero_copy_only=False)
            number = b.column(3).to_numpy(zero_copy_only=False)
            values, ends = bags.values.to_numpy(), bags.offsets.to_numpy()
            k = 0
            while k < len(bags):  # some classes at a time, at least one
                stop = max(k + 1, int(np.searchsorted(ends, ends[k] + per, side="right")) - 1)
                score = s.scores([values[ends[x]:ends[x + 1]] for x in range(k, stop)], m[k:stop])
                for i in range(len(s.items)):
                    held = best[i]
                    at = np.nonzero(score[:, i] > (held[-1, 0] - 1 if len(held) == top else 0))[0]
                    if len(at):
                        both = np.concatenate([held, np.stack([score[at, i], low[k + at], number[k + at]], axis=1)])
                        best[i] = both[_best(both[:, 0], both[:, 1], both[:, 2], top)]
                k = stop
        rows = np.concatenate([np.column_stack([np.full(len(h), item), h]) for item, h in zip(s.items, best)] or [np.empty((0, 4), dtype=np.int64)])
        yield pa.RecordBatch.from_arrays([pa.array(rows[:, c], type=pa.int64()) for c in range(4)], names=["item", "score", "low", "class"])
    return run


def _search_block(spark: SparkSession, docs: DataFrame, terms: DataFrame, id_col: str, text_col: str, top: int) -> DataFrame:
    """The ranking of one block of items, as a saved table."""
    sc = spark.sparkContext
    pairs = [(r["item"], r["term"].encode("utf-8", "surrogatepass")) for r in terms.collect()]
    number = {w: k for k, w in enumerate(sorted({w for _, w in pairs}))}
    of_item: dict[int, list[int]] = {}
    for item, w in pairs:
        of_item.setdefault(item, []).append(number[w])
    words = sc.broadcast(number)
    bags = saved(spark, docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), _bags(F.col(f"`{text_col}`"), words).alias("b"))
                 .select("id", "b.*"), "bags")
    n_docs, n_terms = bags.agg(F.sum(F.when(F.col("n") > 0, 1).otherwise(0)), F.sum("n")).first()
    df = {r["t"]: r["c"] for r in bags.select(F.explode("bag").alias("x")).groupBy(F.shiftright("x", 32).alias("t"))
          .agg(F.count("*").alias("c")).collect()}  # at most one row for each term of the block
    scorer = sc.broadcast(ItemScorer(of_item, {k: term_weight(n_docs or 0, df.get(k, 0)) for k in range(len(number))}))

    # A decimal product: 90 * n * N may exceed 64 bits where the quotient does not.
    share = (F.lit(90 * (n_docs or 0)).cast("decimal(20,0)") * F.col("n").cast("decimal(18,0)"))
    m = (F.lit(10) + F.expr(f"__share div {max(n_terms or 0, 1)}")).cast("long")
    held = bags.where("n > 0 AND size(bag) > 0").withColumn("__share", share).withColumn("m", m).drop("__share")
    held = held.withColumn("h", F.xxhash64("bag", "m"))
    classes = saved(spark, held.groupBy("h", "bag", "m").agg(F.min("id").alias("low")).select("bag", "m", "low")
                    .withColumn("class", F.monotonically_increasing_id()), "classes")
    first = classes.mapInArrow(_score_classes(scorer, top), _BEST)
    w = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("low"), "class")
    chosen = saved(spark, first.withColumn("r", F.row_number().over(w)).where(F.col("r") <= top).select("item", "score", "class"), "chosen")

    # Members of the chosen classes, by ascending id; at most top items x top classes.
    picked = F.broadcast(chosen.select("class").distinct().join(classes, "class").select("class", "bag", "m"))
    by_id = Window.partitionBy("class").orderBy(F.asc_nulls_last("id"))
    members = (held.join(picked, ["bag", "m"]).select("class", "id").withColumn("k", F.row_number().over(by_id))
               .where(F.col("k") <= top).select("class", "id"))
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = (chosen.join(members, "class").withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= top)
              .select("item", "rank", "id", "score"))
    out = saved(spark, ranked, "ranked")
    dropped(spark, bags, classes, chosen)
    words.unpersist()
    scorer.unpersist()
    return out


def bag_search(spark: SparkSession, docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id_col: str = "item_id", item_text_col: str = "text", top: int = TOP, block_terms: int = BLOCK_TERMS,
               block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``(item, rank, id, score)``: the ``top`` highest-scoring rows of
    ``docs`` for each item, scores above 0 only, equal scores by ascending id.

    Terms are maximal runs of ASCII letters and digits and of non-ASCII
    characters, with A-Z lower-cased. Ids are integers.

    Defined results: null, empty and wordless documents hold no term, are not
    counted in N and never ranked; wordless items and items with a null id
    rank nothing; rows of items that share an id are one item of all their
    terms; repeated rows and repeated ids each take a rank; a null id comes
    last among equal scores; an empty table gives an empty result; very long
    texts are counted whole; other columns are not read.
    """
    terms = saved(spark, item_terms(items, item_id_col, item_text_col), "terms")
    n_pairs, n_items = terms.agg(F.count("*"), F.count_distinct("item")).first()
    blocks = max(1, -(-n_pairs // block_terms), -(-n_items // block_items))
    parts = None
    for k in range(blocks):
        block = terms.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k)
        part = _search_block(spark, docs, block, id_col, text_col, top)
        parts = part if parts is None else parts.unionByName(part)
    dropped(spark, terms)
    return parts.select(F.col("item").alias(item_id_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
