"""The registries hold together: SQL only for queries that exist, and each new one reads a given table."""

from lapengine.plans import registry

registry.load_all()
TABLES = ("lineitem", "orders", "events", "embeddings", "documents", "customer", "part", "nation", "supplier")


def test_sql_belongs_to_queries():
    assert set(registry.ORACLE) <= set(registry.QUERIES)


def test_sql_of_this_rounds_queries_reads_tables():
    new = ["f16_cv_linear_many", "f12_lasso_coefficients", "f22_linear_attribution_many", "f3_pca_norm_variance", "f3_pca_norm_loadings",
           "f3_f4_pca_scores", "f3_pca_embeddings", "f16_cv_lasso", "f15_exact_folds", "f9_unknown_levels", "e7_box_sketch", "c1_dropped_samples",
           "a4_merge_drifted_sessions", "a11_tyre_table_lap_time", "st1_laps_in_pieces"]
    for name in new:
        assert any(t in registry.ORACLE[name] for t in TABLES), name
