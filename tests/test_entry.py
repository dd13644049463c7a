import __spark_entry__ as E

EXPECTED = {
    "shipping_mode_distribution", "row_count", "distinct_values_profile", "distinct_coordinates",
    "distinct_city_state", "distinct_rows", "duplicate_row_count", "geo_completeness",
    "quantile_bounds_exact", "boxplot_stats", "imputer_means", "scaler_stats",
    "string_index_mapping", "confusion_matrix", "classification_metrics", "auc_roc_exact",
    "top_k_shipping_modes", "gazetteer_union", "haversine_distance", "order_date_parse",
    "text_slug", "repair_lossy_city_names", "winsorize_column", "winsorize_columns",
    "sample_seeded", "sample_hash", "geocode_pick_candidate", "gazetteer_incremental",
    "winsorize_columns_approx", "confusion_matrix_square", "schema_report", "text_slug",
    "enrich_with_distance", "impute_mean", "string_index_apply", "one_hot_encode",
    "assemble_features", "standardize_features", "train_logistic_regression",
    "train_random_forest", "train_gbt", "split_hash_80_20", "cross_validate_grid",
    "cv_fold_assignment", "score_batch", "prediction_view", "evaluate_model",
    "score_fixed_logit", "stream_text_source", "stream_json_parse", "stream_static_join",
    "stream_score_fixed", "stream_score_model", "stream_fallback_score", "stream_end_to_end",
    "stream_foreach_batch_dual", "scan_csv_latin1", "scan_csv_inferred", "scan_gazetteer",
    "scan_csv_encoding_fallback", "model_save_load_score", "sink_csv_roundtrip", "sink_csv_latin1",
    "sink_gazetteer_append", "sink_json_documents", "preview_topn", "project_model_columns",
    "filter_geocoded", "clean_drop_nulls", "clean_null_audit", "drop_null_label",
    "fill_missing_coords", "geo_join_nullsafe", "geo_join_using", "geo_pending_keys",
    "geo_pending_keys_retry", "geo_dedup_gazetteer", "json_parse_flatten", "enrich_repeated_keys",
    "sink_gazetteer_append_retry", "sample_hash_small", "fold_moments", "fold_labels",
    "trained_feature_stages", "logistic_gradient", "string_index_table", "auc_histogram",
    "profile_state_merged", "sink_gazetteer_versions", "stream_rotating_lines",
    "stream_refreshed_gazetteer", "stream_replay_connector",
}


def test_catalogue_covers_inventory():
    q, o = E.queries(), E.oracle_sql()
    assert EXPECTED <= set(q), sorted(EXPECTED - set(q))
    assert set(o) <= set(q)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["shipping_mode", "count"]
    assert len(rows) == 4 and sum(r["count"] for r in rows) > 0
    counts = [r["count"] for r in rows]
    assert counts == sorted(counts, reverse=True)
