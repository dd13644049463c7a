import pytest
from lateship.llm.licenses import NOTICES, THRESHOLD, bigrams_of, normal_words, scan_licenses, size_bounds, templates


def brute(text):
    lines = (text or "").split("\n")
    out = []
    for n, t in ([(0, text)] if len(lines) > 1 else []) + list(enumerate(lines, 1)):
        g = bigrams_of(normal_words(t))
        for k in templates():
            d = 2 * len(g & set(k.bigrams)) / (len(g) + len(k.bigrams))
            if g and d >= THRESHOLD:
                out.append((n, k.license, k.number, d))
    return sorted(out)


def cases():
    mit = NOTICES["MIT"][1]
    apache = NOTICES["Apache-2.0"][1]
    return [None, "", "\n", "All rights reserved.", "all RIGHTS\treserved", "rights reserved", "x\nReleased under the MIT License.\ny" * 3, mit, mit.replace(" ", "\n"),
            mit.replace("software", "program").replace("free of charge", "gratis"), apache + " and some more words that do not belong here at all",
            "Licensed under the Apache License, Version 3.0.", "Licensed under CC BY-NC 4.0.\n" + "word " * 40_000, "This work is licensed under the GNU General Public License version 2",
            "all rights reserved " * 500, " ".join(mit.split()[:30]), " ".join(apache.split()[3:]), "été rights reserved all"] + [t for n in NOTICES.values() for t in n]


def test_matches_brute_force(spark):
    texts = cases()
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(3, texts[3], "x")], "doc_id long, text string, licenses string")
    got = scan_licenses(df).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        assert [(e.line, e.license, e.template, e.dice) for e in r.licenses] == brute(texts[r.doc_id]), texts[r.doc_id]
    assert scan_licenses(df.limit(0)).count() == 0


@pytest.mark.parametrize("t", [0.5, 0.8, 0.95])
def test_size_bounds_lose_nothing(t):
    for b in range(1, 40):
        low, high = size_bounds(b, t)
        for a in range(1, 200):
            if 2 * min(a, b) / (a + b) >= t:
                assert low <= a <= high


def test_plan_has_no_shuffle_or_python(spark, sf_dir):
    plan = scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Join" not in plan
