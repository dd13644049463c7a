"""Feature queries (A10-A12, M1-M5, M11, CV folds).

Each MLlib transformer's output is re-derived in SQL from its definition:
mean imputation, frequency-ordered indexing, one-hot with the last slot
dropped, assembly and standardization.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from ..ml.label_index import LabelIndex
from ..ml.stages import feature_stages
from ..operators import clean, features
from ..operators.geo import enrich_with_distance
from ..schema import CATEGORICAL_FEATURES, LABEL, NUMERIC_FEATURES
from ..session import shared_dir
from ..sources.fixtures import gazetteer, order_items_nulls
from .oracle import with_fixtures
from .registry import query


def model_input(spark, sf_dir):
    """Order items (with missing values) + gazetteer + distance, label present."""
    e = enrich_with_distance(order_items_nulls(spark, sf_dir), gazetteer(spark, sf_dir))
    return (e.select("order_id", "line_no", *NUMERIC_FEATURES, *CATEGORICAL_FEATURES, LABEL)
             .na.drop(subset=[LABEL]))


def _fit_transform(df, n_stages):
    """Fit the first ``n_stages`` feature stages (input persisted for the
    fitting passes), then transform."""
    from ..ml.train import persisted
    stages = feature_stages(NUMERIC_FEATURES, CATEGORICAL_FEATURES)[:n_stages]
    with persisted(df):
        model = Pipeline(stages=stages).fit(df)
    return model.transform(df)


def _present(c):
    return f"{c} IS NOT NULL AND NOT isnan({c})"


# --- SQL building blocks -----------------------------------------------------

def _fmt(x, d=6):
    """Same fixed-point integer text as :func:`features.vector_text`."""
    return f"CAST(CAST(floor({x} * {float(10 ** d)} + 0.5) AS BIGINT) AS VARCHAR)"


_MEANS = "means AS (SELECT " + ", ".join(
    f"avg({c}) FILTER (WHERE {_present(c)}) AS m_{c}" for c in NUMERIC_FEATURES) + " FROM model_input)"


def _imputed(c):
    return f"CASE WHEN {_present(c)} THEN {c} ELSE m_{c} END"


def _index_ctes():
    parts = []
    for c in CATEGORICAL_FEATURES:
        parts.append(f"""idx_{c} AS (
  SELECT value, CAST(row_number() OVER (ORDER BY cnt DESC, value) - 1 AS DOUBLE) AS idx
  FROM (SELECT {c} AS value, count(*) AS cnt FROM model_input WHERE {c} IS NOT NULL GROUP BY 1)),
k_{c} AS (SELECT count(*) AS k_{c} FROM idx_{c})""")
    return ",\n".join(parts)


def _indexed_select():
    """model_input + imputed numerics + index per categorical (null/unseen -> k)."""
    cols = ["m.*"] + [f"{_imputed(c)} AS {c}_imputed" for c in NUMERIC_FEATURES]
    cols += [f"coalesce(i_{c}.idx, CAST(k_{c} AS DOUBLE)) AS {c}_index" for c in CATEGORICAL_FEATURES]
    cols += [f"k_{c}" for c in CATEGORICAL_FEATURES]
    joins = " ".join(f"LEFT JOIN idx_{c} i_{c} ON m.{c} = i_{c}.value CROSS JOIN k_{c}"
                     for c in CATEGORICAL_FEATURES)
    return f"SELECT {', '.join(cols)} FROM model_input m CROSS JOIN means {joins}"


_FEATURE_CTES = _MEANS + ",\n" + _index_ctes() + ",\nindexed AS (" + _indexed_select() + ")"


def _onehot_list(c):
    return (f"list_transform(range(k_{c}), lambda i: CASE WHEN i = {c}_index THEN 1.0 ELSE 0.0 END)")


def _onehot_text(c):
    return f"array_to_string(list_transform({_onehot_list(c)}, lambda x: {_fmt('x')}), ',')"


_ASSEMBLED_LIST = ("list_concat([" + ", ".join(f"{c}_imputed" for c in NUMERIC_FEATURES) + "], "
                   + ", ".join(_onehot_list(c) for c in CATEGORICAL_FEATURES) + ")")


# --- queries -------------------------------------------------------------------

_means_sql = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, round(avg({c}) FILTER (WHERE {_present(c)}), 6) AS mean FROM model_input"
    for c in NUMERIC_FEATURES)


@query("imputer_means", with_fixtures(_means_sql, "model_input"))
def imputer_means(spark, sf_dir):
    m = features.imputer_means(model_input(spark, sf_dir), NUMERIC_FEATURES)
    return m.select("column_name", F.round("mean", 6).alias("mean"))


@query("impute_mean", with_fixtures(
    "SELECT order_id, line_no, " + ", ".join(f"round({_imputed(c)}, 6) AS {c}_imputed" for c in NUMERIC_FEATURES)
    + " FROM model_input CROSS JOIN means", "model_input", extra=_MEANS))
def impute_mean(spark, sf_dir):
    out = _fit_transform(model_input(spark, sf_dir), 1)
    return out.select("order_id", "line_no",
                      *[F.round(f"{c}_imputed", 6).alias(f"{c}_imputed") for c in NUMERIC_FEATURES])


_scaler_sql = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, round(avg({_imputed(c)}), 6) AS mean, "
    f"round(stddev_samp({_imputed(c)}), 6) AS std FROM model_input CROSS JOIN means"
    for c in NUMERIC_FEATURES)


@query("scaler_stats", with_fixtures(_scaler_sql, "model_input", extra=_MEANS))
def scaler_stats(spark, sf_dir):
    imp = _fit_transform(model_input(spark, sf_dir), 1)
    s = features.scaler_stats(imp, [f"{c}_imputed" for c in NUMERIC_FEATURES])
    return s.select(F.regexp_replace("column_name", "_imputed$", "").alias("column_name"),
                    F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


_mapping_sql = "\nUNION ALL\n".join(f"""
SELECT '{c}' AS column_name, value, cnt AS "count",
       CAST(row_number() OVER (ORDER BY cnt DESC, value) - 1 AS DOUBLE) AS "index"
FROM (SELECT {c} AS value, count(*) AS cnt FROM model_input WHERE {c} IS NOT NULL GROUP BY 1)"""
    for c in CATEGORICAL_FEATURES)


@query("string_index_mapping", with_fixtures(_mapping_sql, "model_input"))
def string_index_mapping(spark, sf_dir):
    return features.string_index_mapping(model_input(spark, sf_dir), CATEGORICAL_FEATURES)


@query("string_index_apply", with_fixtures(
    "SELECT order_id, line_no, " + ", ".join(f"{c}_index" for c in CATEGORICAL_FEATURES) + " FROM indexed",
    "model_input", extra=_FEATURE_CTES))
def string_index_apply(spark, sf_dir):
    out = _fit_transform(model_input(spark, sf_dir), 2)
    return out.select("order_id", "line_no", *[f"{c}_index" for c in CATEGORICAL_FEATURES])


@query("string_index_table", with_fixtures(f"""
SELECT m.order_id, m.line_no, coalesce(i.idx, k) AS item_ref_index, coalesce(s.idx, ks) AS order_state_index
FROM refs m LEFT JOIN ranked i ON m.item_ref = i.value LEFT JOIN states s ON m.order_state = s.value,
     (SELECT CAST(count(*) AS DOUBLE) AS k FROM ranked), (SELECT CAST(count(*) AS DOUBLE) AS ks FROM states)""", "model_input", extra="""
refs AS (SELECT *, CASE WHEN line_no <> 3 THEN CAST(order_id AS VARCHAR) || '-' || CAST(line_no % 2 AS VARCHAR) END AS item_ref FROM model_input),
ranked AS (SELECT value, CAST(row_number() OVER (ORDER BY cnt DESC, value) - 1 AS DOUBLE) AS idx
           FROM (SELECT item_ref AS value, count(*) AS cnt FROM refs WHERE item_ref IS NOT NULL AND order_id % 10 <> 7 GROUP BY 1)),
states AS (SELECT value, CAST(row_number() OVER (ORDER BY cnt DESC, value) - 1 AS DOUBLE) AS idx
           FROM (SELECT order_state AS value, count(*) AS cnt FROM refs WHERE order_state IS NOT NULL AND order_id % 10 <> 7 GROUP BY 1))"""))
def string_index_table(spark, sf_dir):
    """An index kept as a table: fitted without a tenth of the orders, whose
    references are then unseen, and applied to all rows. References number in
    the order of the rows; the broadcast head is kept small to join the rest."""
    df = model_input(spark, sf_dir).withColumn("item_ref", F.when(F.col("line_no") != 3, F.concat_ws("-", "order_id", F.col("line_no") % 2)))
    index = LabelIndex.fit(df.where(F.col("order_id") % 10 != 7), ["item_ref", "order_state"], shared_dir(spark, "label-index"))
    stored = LabelIndex(spark, index.path)
    return stored.transform(df, head=1000).select("order_id", "line_no", "item_ref_index", "order_state_index")


@query("one_hot_encode", with_fixtures(
    "SELECT order_id, line_no, " + ", ".join(f"{_onehot_text(c)} AS {c}_onehot" for c in CATEGORICAL_FEATURES)
    + " FROM indexed", "model_input", extra=_FEATURE_CTES))
def one_hot_encode(spark, sf_dir):
    out = _fit_transform(model_input(spark, sf_dir), 3)
    return out.select("order_id", "line_no",
                      *[features.vector_text(f"{c}_onehot").alias(f"{c}_onehot") for c in CATEGORICAL_FEATURES])


@query("assemble_features", with_fixtures(
    f"SELECT order_id, line_no, array_to_string(list_transform({_ASSEMBLED_LIST}, lambda x: {_fmt('x')}), ',')"
    " AS features_unscaled FROM indexed", "model_input", extra=_FEATURE_CTES))
def assemble_features(spark, sf_dir):
    out = _fit_transform(model_input(spark, sf_dir), 4)
    return out.select("order_id", "line_no", features.vector_text("features_unscaled").alias("features_unscaled"))


_STD_CTES = _FEATURE_CTES + f""",
feat AS (SELECT row_number() OVER () AS rid, order_id, line_no, {_ASSEMBLED_LIST} AS f FROM indexed),
long AS (SELECT rid, order_id, line_no, generate_subscripts(f, 1) AS i, unnest(f) AS x FROM feat),
fstats AS (SELECT i, avg(x) AS m, stddev_samp(x) AS s FROM long GROUP BY i),
scaled AS (SELECT rid, order_id, line_no, long.i,
                  CASE WHEN s IS NULL OR s = 0 THEN 0.0 ELSE (x - m) / s END AS z
           FROM long JOIN fstats ON long.i = fstats.i)"""


@query("standardize_features", with_fixtures(
    f"SELECT order_id, line_no, string_agg({_fmt('z', 4)}, ',' ORDER BY i) AS features "
    "FROM scaled GROUP BY rid, order_id, line_no", "model_input", extra=_STD_CTES))
def standardize_features(spark, sf_dir):
    out = _fit_transform(model_input(spark, sf_dir), 5)
    return out.select("order_id", "line_no", features.vector_text("features", 4).alias("features"))


def _bucket_sql(salt, buckets):
    return (f"CAST(('0x' || substr(md5(concat_ws('|', '{salt}', CAST(order_id AS VARCHAR), "
            f"CAST(line_no AS VARCHAR))), 1, 8)) AS BIGINT) % {buckets}")


@query("split_hash_80_20", with_fixtures(
    f"SELECT order_id, line_no, CASE WHEN {_bucket_sql('42', 10)} < 8 THEN 'train' ELSE 'test' END AS split "
    "FROM model_input", "model_input"))
def split_hash_80_20(spark, sf_dir):
    keys = ["order_id", "line_no"]
    return model_input(spark, sf_dir).select(*keys, clean.split_part(keys).alias("split"))


@query("cv_fold_assignment", with_fixtures(
    f"SELECT order_id, line_no, CAST({_bucket_sql('fold', 2)} AS INTEGER) AS fold FROM model_input "
    f"WHERE {_bucket_sql('42', 10)} < 8", "model_input"))
def cv_fold_assignment(spark, sf_dir):
    df = model_input(spark, sf_dir).select("order_id", "line_no")
    train, _ = clean.split_hash(df, ["order_id", "line_no"])
    return train.withColumn("fold", clean.hash_bucket(["order_id", "line_no"], 2, "fold"))
