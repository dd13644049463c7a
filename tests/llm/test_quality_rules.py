import re

from lateship.llm.quality_rules import RULES, Rule, quality_rules

TEXTS = [
    None, "", " \t\n\x0b", "a", "the of and " * 30, "the quick of brown and fox " * 4 + "x",
    "one two three four five six seven eight nine ten " * 2 + "end", "a\n\na\nb\n b\na",
    "# $ % & | < > * words the of and " * 5, "naïve 漢字 🙂 the of and " * 6,
    " ".join(f"the w{i} of v{i}" for i in range(400)), " ".join(f"the w{i % 97} of v{i}" for i in range(9000)),
    "x" * 200_000, "in in in in of of of of that that that that an an an an a a a a",
]


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    at = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i:i + 8]), []).append(i)
    hit = {p for v in at.values() if len(v) > 1 for i in v for p in range(i, i + 8)}
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit),
            n < 20 or 100 * len(hit) > 30 * n)


def test_counts_match_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "a"), (3, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = quality_rules(df).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute(TEXTS[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want, r.doc_id
        assert not (r.base_failed and r.kept)
    kept = {r.doc_id for r in got if r.kept}
    assert 10 in kept and not kept & {0, 1, 2, 3, 4, 8, 12, 13}


def test_empty_clashing_columns_and_own_rules(spark):
    assert quality_rules(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    df = spark.createDataFrame([("the of and to in " * 3 + " ".join(f"w{i}" for i in range(30)), "x", 7)], "text string, kept string, n_words int")
    r = quality_rules(df, rules=(Rule("short", "n_words", None, 10), *RULES)).first()
    assert r.n_words == 45 and r.kept is False and r.failed_rules == ["short"]


def test_labelled_documents_are_separated(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    j = quality_rules(docs).join(labels, "doc_id").where("NOT base_failed")
    n = {(r.quality, r.kept): r["count"] for r in j.groupBy("quality", "kept").count().collect()}
    assert n.get((1, False), 0) <= 0.005 * n[(1, True)]
    assert n.get((0, True), 0) <= 0.02 * n[(0, False)]


def test_no_python_and_no_shuffle_in_the_plan(spark, sf_dir):
    df = quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
