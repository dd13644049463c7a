import random

import numpy as np
import pytest
from lateship.llm.minhash import (is_link, min_matches, minhash_near_duplicates, shingle_set, signature,
                                  survivors)


def brute_set(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset([tuple(w)]) if w else frozenset()


def brute(rows, percent=80):
    """``(id, n, component, kept)`` of every row, from all pairs."""
    sets = [brute_set(t) for _, t in rows]
    ids = [d for d, _ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        r = find(i)
        low[r] = min((x for x in (low.get(r), d) if x is not None), default=None)
    return sorted((str(d), len(s), str(low[find(i)]), d == low[find(i)]) for i, (d, s) in enumerate(zip(ids, sets)))


def got(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in df.collect())


def edited(rnd, words, n):
    w = list(words)
    for _ in range(n):
        w[rnd.randrange(len(w))] = f"e{rnd.randrange(10 ** 6)}"
    return " ".join(w)


def crowd_rows():
    """Crowds of copies around the threshold, chains, copies and unrelated texts."""
    rnd = random.Random(3)
    texts = [None, "", " \n", "solo", "Solo", "two words", "two words", "three short words"]
    for n_words, n, most in ((120, 120, 16), (300, 40, 36), (40, 30, 5)):
        base = [f"w{rnd.randrange(3000)}" for _ in range(n_words)]
        texts += [edited(rnd, base, rnd.randrange(most)) for _ in range(n)]
    chain = [f"c{i}" for i in range(200)]
    for k in range(30):  # neighbours are linked, ends are not
        chain = chain[:4 * k] + [f"d{k}_{i}" for i in range(4)] + chain[4 * k + 4:]
        texts.append(" ".join(chain))
    texts += [" ".join(f"u{rnd.randrange(10 ** 5)}" for _ in range(60)) for _ in range(60)]
    return [(7 * i + 2, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("block", [1024, 7])
def test_components_match_all_pairs(spark, block):
    rows = crowd_rows()
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, component_id string").repartition(4)
    have = got(minhash_near_duplicates(spark, df, block=block))
    want = brute(rows)
    assert have == want
    assert 50 < len({c for _, _, c, _ in want}) < 200


def test_hot_pivots_are_spread(spark, monkeypatch):
    monkeypatch.setattr("lateship.llm.minhash.HOT", 5)
    monkeypatch.setattr("lateship.llm.minhash.BROADCAST_ROWS", 10)
    rows = crowd_rows()
    assert got(minhash_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
    monkeypatch.setattr("lateship.llm.minhash.BROADCAST_ROWS", 10 ** 6)
    assert got(minhash_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_null_ids_repeats_copies_and_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert minhash_near_duplicates(spark, df).count() == 0
    rows = [(None, "a b c d"), (7, "a b c d"), (7, "A b c d"), (None, "only null"), (4, None), (4, None), (None, "")]
    rows += [(100 + i, "one very hot copy of a text") for i in range(300)]
    assert got(minhash_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_very_long_texts(spark):
    rnd = random.Random(9)
    base = [f"l{rnd.randrange(10 ** 6)}" for _ in range(150_000)]
    rows = [(1, " ".join(base)), (2, edited(rnd, base, 9000)), (3, edited(rnd, base, 40_000))]
    assert got(minhash_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_shingles_and_links():
    assert len(shingle_set("a b a b a")) == 2 and len(shingle_set("a")) == 1 and len(shingle_set(" \t")) == 0
    assert shingle_set("A b")[0] == shingle_set("a B")[0] != shingle_set("b a")[0]
    assert shingle_set("É a")[0] != shingle_set("é a")[0]
    x = np.arange(100, dtype=np.uint64)
    assert is_link(x, x[:80]) and not is_link(x, x[:79])
    assert is_link(x[:9], x[1:10]) and not is_link(x[:8], x[1:9])  # 8 of 10, 7 of 9


def test_signatures_estimate_similarity_and_bounds_spare_links():
    rnd = np.random.default_rng(4)
    bounds = min_matches(288)
    assert [n for n, _ in bounds] == [32, 64, 96, 128, 160, 192, 224, 256, 288]
    assert all(m <= 0.8 * n for n, m in bounds)
    wrong = []
    for _ in range(300):
        pool = rnd.integers(0, 2 ** 63, 1100, dtype=np.uint64)
        a, b = signature(np.unique(pool[:1000])), signature(np.unique(pool[100:]))
        assert len(survivors(a[None], b[None], bounds)[0])     # similarity 0.82
        wrong.append((a == b).mean() - 900 / 1100)
        c = signature(np.unique(pool[600:]))
        assert not len(survivors(a[None], c[None], bounds)[0])  # similarity 0.36
    assert abs(np.mean(wrong)) < 0.01


def test_query_matches_all_pairs(spark, sf_dir):
    from lateship.llm.queries import QUERIES
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert got(QUERIES["op11_minhash_near_dedup"](spark, sf_dir)) == brute(rows)
