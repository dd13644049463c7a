import math
import random
import re
from collections import Counter

import pytest
from lateship.llm.bag_search import bag_search
from pyspark.sql import functions as F

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def brute(docs, items, top=10):
    bags = [(d, terms(t)) for d, t in docs]
    bags = [(d, w, Counter(w)) for d, w in bags if w]
    n_docs, n_terms = len(bags), sum(len(w) for _, w, _ in bags)
    df = Counter(t for _, _, c in bags for t in c)
    wanted = {}
    for item, text in items:
        if item is not None and terms(text):
            wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, want in wanted.items():
        scored = []
        for d, w, c in bags:
            m = 100 - 90 + 90 * len(w) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in want if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scored, key=lambda x: x[:3])[:top])]
    return sorted(out, key=str)


def got(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=str)


def tables():
    rnd = random.Random(8)
    vocabulary = [f"t{i}" for i in range(60)] + ["É", "ß9", "字"]
    text = lambda n: "".join(rnd.choice(vocabulary) + rnd.choice([" ", ", ", "\n", "_"]) for _ in range(n))
    docs = [(10 * i, text(rnd.randrange(1, 40))) for i in range(150)]
    docs += [(10 * i + 5, docs[i % 7][1].upper()) for i in range(100)]     # classes of many members
    docs += [(3, None), (4, ""), (None, docs[3][1]), (None, docs[3][1]), (30, docs[3][1]), (9, "zzz yyy"), (11, "t1 " * 50_000)]
    items = [(i, text(rnd.randrange(1, 12))) for i in range(25)] + [(90, None), (91, "... "), (None, "t1"), (5, "t2 nowhere"), (92, "nowhere")]
    rnd.shuffle(docs)
    return docs, items


@pytest.mark.parametrize("blocks", [{}, {"block_terms": 40}, {"block_items": 3, "top": 3}])
def test_ranking_matches_brute_force(spark, blocks):
    docs, items = tables()
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, score string").repartition(5)
    q = spark.createDataFrame(items, "item_id long, text string")
    assert got(bag_search(spark, d, q, **blocks)) == brute(docs, items, blocks.get("top", 10))


def test_hot_class_is_expanded_by_ascending_id(spark):
    docs = [(i, "one hot bag") for i in range(5000)] + [(9000, "one hot bag other words")]
    items = [(1, "hot"), (2, "other hot")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    found = bag_search(spark, d, spark.createDataFrame(items, "item_id long, text string"))
    assert got(found) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert bag_search(spark, docs.where(F.lit(False)), items).count() == 0
    assert bag_search(spark, docs, items.where(F.lit(False))).count() == 0
    # one document holding the only term: its weight floor(1000 ln(4 / 3)) is positive
    assert got(bag_search(spark, docs, items)) == brute([(1, "a b")], [(1, "a")])


def test_query_matches_brute_force(spark, sf_dir):
    from lateship.llm.queries import QUERIES
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert got(QUERIES["op12_ranked_search"](spark, sf_dir)) == brute(docs, items)
