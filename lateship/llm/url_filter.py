"""URL filter: domain rules, and a character language-model ratio for the rest.

Two smoothed variable-order Markov models are counted, one over the URLs that
the rules accept and one over those they reject. A URL is scored by the
difference of its log-likelihoods, divided by its length, and allowed from a
threshold on that is calibrated on held-out URLs.

Everything is DataFrame and SQL functions. URLs are counted as distinct texts
with their number of rows first, so a very common URL is one row. The model
is a table of the distinct character n-grams of the corpus: the n-grams of
the longest order are counted with map-side combination, every lower order is
derived from that table, and each n-gram's log ratio is worked out once, not
once for every place where it stands. Log ratios are rounded to whole
millionths, so sums do not depend on the order of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import dropped, saved

ORDER = 4
#: n-grams with their scores are broadcast up to this many rows (about 60 bytes each), else joined.
BROADCAST_GRAMS = 400_000
#: Characters whose n-grams are cut from one block of a text.
GRAM_BLOCK = 512
#: One URL text in HELD_OUT is kept for the calibration of the threshold.
HELD_OUT = 5
MICRO = 1_000_000
#: Bins of the calibration histogram: scores from -BINS/2 to BINS/2 hundredths.
BINS = 2000
BEGIN, END = "\u0002", "\u0003"
CLASSES = ("a", "r")


def url_host(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or no ``://``: empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def match_rules(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest rule ``(host, path, verdict)`` that
    fits: the host or a subdomain of it, and a path that starts with the
    rule's. Null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _grams(rows: DataFrame, order: int, *kept: str) -> DataFrame:
    """``(*kept, gram)``: the n-grams of ``order`` + 1 characters that end at
    each character of ``url`` and at the end mark, the beginning filled up with
    begin marks. They are cut from blocks of the text, because a substring
    costs its distance from the beginning."""
    url = F.col("url")
    padded = F.concat(F.lit(BEGIN * order), url, F.lit(END))
    starts = F.sequence(F.lit(0), F.floor(F.length(url) / F.lit(GRAM_BLOCK)).cast("int"))
    blocks = F.transform(starts, lambda k: F.substring(padded, k * GRAM_BLOCK + 1, F.lit(GRAM_BLOCK + order)))
    cut = F.transform(F.sequence(F.lit(1), F.length("__block") - order), lambda i: F.substring(F.col("__block"), i, F.lit(order + 1)))
    return rows.select(*kept, F.explode(blocks).alias("__block")).select(*kept, F.explode(cut).alias("gram"))


def gram_scores(spark: SparkSession, urls: DataFrame, order: int = ORDER) -> DataFrame:
    """``(gram, score)``: the log ratio of each distinct n-gram's last
    character after the others, in millionths.

    ``urls(url, a, r)``: distinct texts and how many accepted and rejected
    rows each stands for (0, 0: only scored). Orders are interpolated by
    Witten and Bell: an order counts against the next lower one as its events
    against the distinct characters that followed the context.
    """
    grams = (_grams(urls, order, "a", "r")
             .groupBy("gram").agg(F.sum("a").alias("a"), F.sum("r").alias("r")))
    grams = saved(spark, grams, "grams")
    chars = grams.groupBy(F.substring("gram", order + 1, 1).alias("c")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    total = chars.agg(F.coalesce(F.sum("a"), F.lit(0)).alias("a"), F.coalesce(F.sum("r"), F.lit(0)).alias("r"), F.count("*").alias("n")).first()
    out = grams.select("gram")
    p = {}
    for k in range(order + 1):
        # events: the last k + 1 characters; contexts: those without the last.
        events = grams.groupBy(F.substring("gram", order + 1 - k, k + 1).alias(f"e{k}")).agg(
            F.sum("a").alias("a"), F.sum("r").alias("r"))
        out = out.withColumn(f"e{k}", F.substring("gram", order + 1 - k, k + 1))
        if k == 0:
            out = out.join(events.select("e0", F.col("a").alias("a0"), F.col("r").alias("r0")), "e0")
            for c in CLASSES:
                p[c] = (F.col(f"{c}0") + 1) / F.lit(float(total[c] + total["n"] + 1))
            continue
        contexts = events.groupBy(F.substring(f"e{k}", 1, k).alias(f"c{k}")).agg(
            *[F.sum(c).alias(f"n{c}{k}") for c in CLASSES],
            *[F.sum((F.col(c) > 0).cast("long")).alias(f"t{c}{k}") for c in CLASSES])
        events = events.withColumn(f"c{k}", F.substring(f"e{k}", 1, k)).join(contexts, f"c{k}").drop(f"c{k}")
        out = out.join(events.withColumnsRenamed({"a": f"a{k}", "r": f"r{k}"}), f"e{k}")
        for c in CLASSES:
            seen, kinds = F.col(f"n{c}{k}"), F.col(f"t{c}{k}")
            p[c] = F.when(seen > 0, (F.col(f"{c}{k}") + kinds * p[c]) / F.greatest(seen + kinds, F.lit(1))).otherwise(p[c])
    score = F.round(F.log(p["a"] / p["r"]) * MICRO).cast("long")
    scores = saved(spark, out.select("gram", score.alias("score")), "scores")
    dropped(spark, grams)
    return scores


def score_urls(urls: DataFrame, scores: DataFrame, order: int = ORDER, broadcast_grams: int = BROADCAST_GRAMS) -> DataFrame:
    """``(no, score)`` for ``urls(no, url)``: the length-normalised log ratio
    of each text, in millionths. Only its number goes with a text's n-grams.

    The model is broadcast only if it has at most ``broadcast_grams`` rows;
    beyond that both sides are shuffled by n-gram.
    """
    small = scores.count() <= broadcast_grams
    joined = _grams(urls, order, "no").join(F.broadcast(scores) if small else scores, "gram")
    return joined.groupBy("no").agg(F.expr("sum(score) div count(*)").alias("score"))


def calibrate(scored: DataFrame) -> float:
    """The threshold, in millionths, that separates accepted from rejected
    rows of ``scored(score, a, r)`` best by the mean of both rates; of equally
    good ones that closest to zero, where the two models are even.

    Only a histogram of ``BINS`` bins reaches the driver. Zero if either
    class has no row.
    """
    width = MICRO // 100
    b = F.greatest(F.lit(-BINS // 2), F.least(F.lit(BINS // 2 - 1), F.floor(F.col("score") / width)))
    bins = {r["b"]: (r["a"], r["r"]) for r in
            scored.groupBy(b.alias("b")).agg(F.sum("a").alias("a"), F.sum("r").alias("r")).collect()}
    n_a, n_r = sum(a for a, _ in bins.values()), sum(r for _, r in bins.values())
    if not n_a or not n_r:
        return 0.0
    below_a = below_r = 0
    best: list[tuple[float, int]] = []
    for x in range(-BINS // 2, BINS // 2 + 1):
        best.append(((n_a - below_a) / n_a + below_r / n_r, x))
        a, r = bins.get(x, (0, 0))
        below_a, below_r = below_a + a, below_r + r
    top = max(v for v, _ in best)
    return float(min((x for v, x in best if v == top), key=lambda x: (abs(x), x)) * width)


def filter_urls(spark: SparkSession, df: DataFrame, rules, url_col: str = "url", order: int = ORDER,
                broadcast_grams: int = BROADCAST_GRAMS) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule``, ``score``, ``threshold`` and ``verdict``.

    ``rules``: ``(host, path, "allow" | "block")``. A rule's verdict holds;
    without one, ``allow`` if the score reaches the threshold, else ``block``.
    URLs with a rule train the models, but for one text in five, which
    calibrates the threshold.

    Defined results: a null URL is an empty one (empty host and path, scored
    as the empty text); if the rules accept or reject nothing, the models have
    one class without counts and the threshold is zero; repeated rows are each
    returned; an empty input gives an empty result; very long URLs are scored
    whole; other columns pass through, and one with a result's name is
    replaced.
    """
    out = ["host", "path", "rule", "score", "threshold", "verdict"]
    kept = [F.col(f"`{c}`") for c in df.columns if c not in out]
    text = F.coalesce(F.col(f"`{url_col}`"), F.lit(""))
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    distinct = df.groupBy(text.alias("url")).agg(F.count("*").alias("n"))
    rule, verdict = match_rules(F.col("host"), F.col("path"), rules)
    urls = (distinct.select("url", "n", host.alias("host"), path.alias("path"))
            .withColumns({"rule": rule, "by_rule": verdict})
            .withColumns({"a": F.when(F.col("by_rule") == "allow", F.col("n")).otherwise(0),
                          "r": F.when(F.col("by_rule") == "block", F.col("n")).otherwise(0),
                          "held": F.pmod(F.xxhash64("url"), F.lit(HELD_OUT)) == 0}))
    urls = saved(spark, urls.withColumn("no", F.monotonically_increasing_id()), "urls")
    fit = urls.select("url", F.when(~F.col("held"), F.col("a")).otherwise(0).alias("a"),
                      F.when(~F.col("held"), F.col("r")).otherwise(0).alias("r"))
    scores = gram_scores(spark, fit, order)
    scored = saved(spark, urls.join(score_urls(urls, scores, order, broadcast_grams), "no"), "scored")
    dropped(spark, urls, scores)
    threshold = calibrate(scored.where("held"))
    judged = scored.select(F.col("url").alias("__url"), "host", "path", "rule", (F.col("score") / MICRO).alias("score"),
                           F.lit(threshold / MICRO).alias("threshold"),
                           F.coalesce("by_rule", F.when(F.col("score") >= threshold, "allow").otherwise("block")).alias("verdict"))
    return (df.select(*kept, text.alias("__key")).join(judged, F.col("__key") == F.col("__url"))
            .select(*kept, *out))
