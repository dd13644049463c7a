"""Repair of names that lost characters to '?' in a Latin-1 round trip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..sinks.files import LATIN1_OUTSIDE


def latin1_lossy_form(col: Column) -> Column:
    """What a name becomes after a Latin-1 write: every character outside
    ISO-8859-1 turns into '?'."""
    return F.regexp_replace(col, LATIN1_OUTSIDE, "?")


def repair_lossy_names(lossy: DataFrame, reference: DataFrame, name: str = "city",
                       scope: str = "state") -> DataFrame:
    """Restore names containing '?' from a reference list of the same scope.

    A reference name is a candidate when its own Latin-1 lossy form equals
    the damaged name -- the exact model of the loss. That makes the lookup an
    equi-join on (scope, lossy form): every reference name joins at most one
    damaged name, so no pairs are generated within a scope. The name is
    replaced only when exactly one candidate matches.
    """
    l = (lossy.filter(F.col(name).contains("?"))
              .select(F.col(name).alias("lossy_city"), F.col(scope).alias("_scope")).distinct())
    r = (reference.select(F.col(name).alias("_cand"), F.col(scope).alias("_scope"),
                          latin1_lossy_form(F.col(name)).alias("lossy_city"))
                  .filter(F.col("lossy_city").contains("?")).distinct())
    joined = l.join(r, ["_scope", "lossy_city"], "left")
    out = joined.groupBy("lossy_city", "_scope").agg(
        F.countDistinct("_cand").alias("candidates"), F.min("_cand").alias("_one"))
    return out.select(
        "lossy_city", F.col("_scope").alias(scope),
        F.when(F.col("candidates") == 1, F.col("_one")).otherwise(F.col("lossy_city")).alias("repaired_city"),
        "candidates")
