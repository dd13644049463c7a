"""Quality rules: a threshold table compiled into one Spark projection.

Every metric is a column expression of built-in functions (no Python runs on
the executors) and every rule is a row of a threshold table: a ratio with a
lower and an upper bound. ``compile_rules`` turns the table into one array
expression, so adding a rule never adds a pass over the data.

Nothing is shuffled: a row's verdict depends on that row alone, so skewed
sources or copies cannot unbalance anything.

Defined results: a null text counts as an empty one (no words, ``base_failed``
true, ``kept`` false); an empty input gives an empty result; repeated rows are
judged each on its own; very long texts are judged whole; other columns pass through untouched, and a column
that has the name of a result column is replaced by the result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 8

#: Frequent function words of the four languages of the corpus.
STOP_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "with", "as", "be", "by", "this"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine", "als", "auch"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "sur", "au", "pas", "avec"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una", "su", "para", "es", "al", "lo"],
}


@dataclass(frozen=True)
class Rule:
    """Keep a text only if ``low <= value(metric) <= high`` (None: open)."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


#: The production threshold table.
RULES = (
    Rule("mean_word_length", "mean_word_chars", 2.0, 20.0),
    Rule("symbol_ratio", "symbol_ratio", None, 0.10),
    Rule("symbol_share", "symbol_share", None, 0.10),
    Rule("stop_word_ratio", "stop_word_ratio", 0.02, None),
    Rule("echo_word_ratio", "echo_word_ratio", None, 0.20),
    Rule("duplicate_line_ratio", "dup_line_ratio", None, 0.60),
    Rule("bullet_line_ratio", "bullet_line_ratio", None, 0.90),
    Rule("ellipsis_line_ratio", "ellipsis_line_ratio", None, 0.30),
)


def _count(cond_fn, items: Column) -> Column:
    return F.size(F.filter(items, cond_fn)).cast("long")


def base_metrics(df: DataFrame, text_col: str = "text", stop_words=None) -> DataFrame:
    """Add the counts the rules are made of to every row.

    Added columns: ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines``,
    ``n_dup_lines``, ``n_repeat_words``, ``n_stop_words``, ``n_echo_words`` (equal to the
    word before), ``n_bullet_lines``, ``n_ellipsis_lines`` (all long).

    Repeated 8-word windows are found by the 64-bit hash of each window's
    words within the one text: positions whose hash has an equal neighbour
    after sorting are repeats. The sort runs only for texts that have any.
    """
    stops = sorted({w for ws in (stop_words or STOP_WORDS).values() for w in ws})
    stops = stops + sorted({w.capitalize() for w in stops} - set(stops))
    out = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
           "n_stop_words", "n_echo_words", "n_bullet_lines", "n_ellipsis_lines"]
    rest = [c for c in df.columns if c not in out]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    keep = [F.col(f"`{c}`") for c in rest]
    words, lines, n = F.col("__words"), F.col("__lines"), F.col("n_words")

    step1 = df.select(
        *keep,
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("__words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)).alias("__lines"),
        F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("n_symbols"))
    step2 = step1.select(
        *keep, "word_chars", "n_symbols",
        F.size(words).cast("long").alias("n_words"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        _count(lambda w: w.isin(stops), words).alias("n_stop_words"),
        _count(lambda w, i: F.coalesce(w == F.get(words, i - 1), F.lit(False)), words).alias("n_echo_words"),
        _count(lambda x: x.rlike(r"^[\x20\x09]*[-*•·]"), lines).alias("n_bullet_lines"),
        _count(lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"), lines).alias("n_ellipsis_lines"),
        F.when(F.size(words) >= WINDOW,
               F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)),
                           lambda i: F.xxhash64(F.slice(words, i, WINDOW)))).alias("__hash"))
    hashes = F.col("__hash")
    counts = ["word_chars", "n_symbols", "n_words", "n_lines", "n_dup_lines", "n_stop_words", "n_echo_words",
              "n_bullet_lines", "n_ellipsis_lines"]
    step3 = step2.select(
        *keep, *counts,
        F.when(F.size(F.array_distinct(hashes)) < F.size(hashes),
               F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("__sorted"))
    pairs = F.col("__sorted")
    step4 = step3.select(
        *keep, *counts,
        F.sort_array(F.transform(
            F.filter(pairs, lambda x, k: (F.coalesce(F.get(pairs, k - 1)["h"] == x["h"], F.lit(False))
                                          | F.coalesce(F.get(pairs, k + 1)["h"] == x["h"], F.lit(False)))),
            lambda x: x["i"])).alias("__at"))
    at = F.col("__at")
    covered = F.aggregate(
        F.transform(at, lambda p, k: F.least(F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))),
        F.lit(0), lambda a, x: a + x)
    # A filter on the verdict would be pushed through these projections, and
    # the expressions, which refer to one another many times over, multiplied
    # out. Catalyst pushes nothing past a non-deterministic column.
    barrier = F.monotonically_increasing_id() < 0
    return step4.select(*keep, *counts, F.when(barrier, F.lit(None)).otherwise(F.coalesce(covered, F.lit(0))).cast("long").alias("n_repeat_words"))


def ratios() -> dict[str, Column]:
    """The named ratios a rule may bound, over the columns of ``base_metrics``."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "n_words": F.col("n_words"),
        "mean_word_chars": F.col("word_chars") / words,
        "symbol_ratio": F.col("n_symbols") / words,
        "symbol_share": F.col("n_symbols") / chars,
        "echo_word_ratio": F.col("n_echo_words") / words,
        "stop_word_ratio": F.col("n_stop_words") / words,
        "dup_line_ratio": F.col("n_dup_lines") / lines,
        "bullet_line_ratio": F.col("n_bullet_lines") / lines,
        "ellipsis_line_ratio": F.col("n_ellipsis_lines") / lines,
        "repeat_word_ratio": F.col("n_repeat_words") / words,
    }


def compile_rules(rules=RULES) -> Column:
    """The threshold table as one expression: the array of failed rule names."""
    value, failed = ratios(), []
    for r in rules:
        v = value[r.metric]
        bad = F.lit(False)
        if r.low is not None:
            bad = bad | (v < F.lit(r.low))
        if r.high is not None:
            bad = bad | (v > F.lit(r.high))
        failed.append(F.when(bad, F.lit(r.name)))
    return F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")


def quality_rules(df: DataFrame, text_col: str = "text", rules=RULES, stop_words=None) -> DataFrame:
    """``base_metrics`` with ``base_failed``, ``failed_rules`` and ``kept``.

    ``base_failed``: under 20 words, or over 30 % of the words stand in 8-word
    windows that occur twice or more in the text. ``kept``: not base_failed
    and no rule of the table failed.
    """
    m = base_metrics(df, text_col, stop_words)
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    m = m.withColumns({"base_failed": base, "failed_rules": compile_rules(rules)})
    return m.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
