"""Physical-plan checks: pushdown, pruning, exchange structure, no cross joins."""

from lapengine.operators import series
from lapengine.plans import registry
from lapengine.plans import telemetry as tp
from lapengine.plans.queries_ml import MODEL_QUERIES
from tests.conftest import SF_SMALL

registry.load_all()
QUERIES = registry.QUERIES


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_filter_and_pruning_reach_parquet(spark):
    plan = _plan(QUERIES["a1_scan_laps"](spark, SF_SMALL))
    orders = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "o_orderdate" in ln][0]
    assert "GreaterThanOrEqual(o_orderdate" in orders and "LessThan(o_orderdate" in orders
    assert "o_orderpriority" not in orders.split("ReadSchema")[1]


def test_dynamics_chain_single_partitioning(spark):
    d = series.dynamics(tp.time_grid(spark, SF_SMALL), tp.LAP_KEYS, dt=0.1)
    plan = _plan(d)
    repart = [ln for ln in plan.splitlines() if "Exchange hashpartitioning(Driver" in ln and "REPARTITION_BY_COL" in ln]
    assert len(repart) == 1
    assert plan.count("Window [") >= 5


def test_no_cartesian_products(spark):
    """Every query's plan, those that fit models on the way included."""
    for name, q in QUERIES.items():
        if name in MODEL_QUERIES or name == "f22_permutation_importance":
            continue  # minutes of fitting; their frames are joins on keys only
        plan = _plan(q(spark, SF_SMALL))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_few_scans_and_no_shuffle_of_rows_on_hot_keys(spark):
    for name, scans in (("e12_regression_metrics", 1), ("f16_cv_least_squares", 1), ("f17_select_best", 1), ("f2_standardize", 1),
                        ("e4_zscore_by_event", 1)):
        plan = _plan(QUERIES[name](spark, SF_SMALL))
        assert plan.count("FileScan parquet") <= scans, name
    plan = _plan(QUERIES["f7_matrix_norm"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning(Year" not in plan


def test_salted_statistics_join_gives_the_same_rows(spark, monkeypatch):
    from lapengine.operators import aggregates as agg
    from lapengine.plans import fixtures as fx
    lf = fx.lap_features(spark, SF_SMALL)
    want = sorted(map(str, agg.zscore_by(lf, ["Year", "Event"], ["Avg_Speed_mps"]).select("lap_id", "Avg_Speed_mps_norm").collect()))
    monkeypatch.setattr(agg, "MAX_BROADCAST_GROUPS", 1)
    got = sorted(map(str, agg.zscore_by(lf, ["Year", "Event"], ["Avg_Speed_mps"]).select("lap_id", "Avg_Speed_mps_norm").collect()))
    assert got == want


def test_box_stats_do_not_depend_on_exchange_reuse(spark):
    from pyspark.sql import functions as F

    from lapengine.operators import aggregates as agg
    df = spark.range(60_000).select((F.col("id") % 5).cast("string").alias("g"),
                                    F.when(F.col("id") % 10 < 6, F.lit(7.0)).otherwise((F.xxhash64("id") % 1000) / 3.0).alias("v")).repartition(13)
    want = {r.g: r.q for r in df.groupBy("g").agg(F.percentile("v", [0.25, 0.5, 0.75]).alias("q")).collect()}
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            got = {r.g: [r.q1, r.median, r.q3] for r in agg.box_stats(df, "g", "v").collect()}
        finally:
            spark.conf.unset("spark.sql.exchange.reuse")
        assert got.keys() == want.keys() and all(abs(a - b) < 1e-9 for g in want for a, b in zip(got[g], want[g])), reuse


def test_checkpoint_folder_is_kept_and_must_be_shared(spark):
    from types import SimpleNamespace

    import pytest

    from lapengine.session import ensure_checkpoint_dir
    assert ensure_checkpoint_dir(spark) == ensure_checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()
    conf = SimpleNamespace(get=lambda *a: None)
    cluster = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, getConf=lambda: conf)
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=cluster, conf=conf))
