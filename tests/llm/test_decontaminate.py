import random
import re

import pytest
from lateship.llm.decontaminate import PatternSet, find_benchmark_passages, normal_words


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(text, items):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        p = words(t)
        for win in {tuple(p[i:i + 10]) for i in range(max(1, len(p) - 9))} if p else ():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i:i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    if item is not None:
                        found.add(str(item))
    return len(w), len(hit), sorted(found)


def case(seed=3):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(6)]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(1, text(40)), (2, text(12)), (10, "Short one!"), (3, ""), (4, None), (None, text(11)), (5, "uno"), (6, text(10)), (6, text(10))]
    docs = [None, "", "?!", "uno", "UNO-uno", "a short ONE b short,one c", "x " * 50_000 + "short one"]
    docs += [text(rnd.randrange(200)) for _ in range(60)]
    docs += [text(5) + " " + items[k][1].upper().replace(" ", "\n...") + " " + text(5) for k in (0, 1, 5, 7, 8)]
    docs += [" ".join(items[0][1].split()[3:k]) for k in range(3, 20)]
    return items, docs


@pytest.mark.parametrize("block", [200_000, 9])
def test_matches_brute_force(spark, block):
    """All patterns at once, and block by block."""
    items, docs = case()
    i = spark.createDataFrame(items, "item_id long, text string")
    d = spark.createDataFrame([(k, t, "kept") for k, t in enumerate(docs)] + [(0, None, "kept")], "doc_id long, text string, note string").repartition(3)
    got = find_benchmark_passages(spark, d, i, block_patterns=block).collect()
    assert len(got) == len(docs) + 1
    for r in got:
        assert (r.n_words, r.n_hit, r.item_ids) == brute(docs[r.doc_id], items), r.doc_id
        assert r.contaminated == (r.n_hit > 0) and r.note == "kept"
        assert sum(b - a for a, b in r.spans) == r.n_hit


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 99)], "doc_id long, text string, n_hit long")
    none = spark.createDataFrame([], "item_id long, text string")
    r = find_benchmark_passages(spark, docs, none).first()
    assert (r.n_hit, r.contaminated, r.item_ids) == (0, False, [])
    assert find_benchmark_passages(spark, docs.limit(0), spark.createDataFrame([(1, "a b")], none.schema)).count() == 0


def test_words_and_shifts():
    assert normal_words("Ab9-Cé \x7f{z}~`q") == ["ab9".encode(), "cé".encode(), b"z", b"q"]
    s = PatternSet([(("a", "b", "c"), "1"), (("b", "c", "a"), "2")]).searchers[0]
    assert s.shift[(b"b", b"c")] == 0 and s.shift[(b"c", b"a")] == 0 and s.shift[(b"a", b"b")] == 1 and s.default == 2
