"""Sinks and sources round trips, stream = batch."""

import os

from pyspark.sql import functions as F

from lapengine.plans import fixtures as fx
from lapengine.plans import telemetry as tp
from lapengine.sources import artifacts as src
from lapengine.sources import sinks
from tests.conftest import SF_SMALL


def test_partitioned_write_dynamic_overwrite(spark, tmpdir_path):
    lp = fx.laps(spark, SF_SMALL).select("Driver", "LapNumber", "Year", "Event", "SessionType")
    path = sinks.write_artifact(lp, tmpdir_path, "laps")
    back = sinks.read_partitioned(spark, tmpdir_path, "laps")
    assert back.count() == lp.count()
    one = lp.where(F.col("SessionType") == "F").limit(3)
    sinks.write_artifact(one, tmpdir_path, "laps")  # replaces only the touched partitions
    back2 = sinks.read_partitioned(spark, tmpdir_path, "laps")
    assert back2.where(F.col("SessionType") == "O").count() == lp.where(F.col("SessionType") == "O").count()
    assert os.path.isdir(path)


def test_merge_sessions_from_folders(spark, tmpdir_path):
    from lapengine import schemas
    rows = [("1", 1, 90.0, "SOFT", 2.0) + (1.0,) * 8]
    cols = [f.name for f in schemas.LAP_FEATURES.fields]
    df = spark.createDataFrame(rows, schemas.LAP_FEATURES)
    for label in ["2024_Bahrain_Grand_Prix_R", "2023_Monaco_Grand_Prix_Q", "bad"]:
        df.write.mode("overwrite").parquet(os.path.join(tmpdir_path, label, "lap_features"))
    merged = src.merge_sessions(spark, tmpdir_path).collect()
    keys = sorted((r.Year, r.Event, r.SessionType) for r in merged)
    assert keys == [(2023, "Monaco_Grand_Prix", "Q"), (2024, "Bahrain_Grand_Prix", "R")]
    assert set(cols) <= set(merged[0].asDict())


def test_first_available(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "b")
    spark.range(3).write.parquet(p)
    got = src.first_available(spark, [os.path.join(tmpdir_path, "a"), p])
    assert got.count() == 3
    assert src.first_available(spark, [os.path.join(tmpdir_path, "zz")]) is None


def test_weather_text_roundtrip(spark):
    from lapengine.functions.columns import interval_text, interval_text_seconds
    df = spark.createDataFrame([(0,), (14093000,), (86400 * 10**6 + 1,)], "us long")
    out = df.select(interval_text("us").alias("t")).select("t", interval_text_seconds("t").alias("s")).collect()
    assert out[1].t == "0 days 00:00:14.093000" and abs(out[1].s - 14.093) < 1e-12
    assert out[2].t == "1 days 00:00:00.000001"


def test_stream_ingest_equals_batch(spark, tmpdir_path):
    from lapengine.streaming.ingest import ingest_available
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    # split into several files by day so the stream sees whole laps per file
    ev.withColumn("d", (F.dayofmonth("ts") - 1) / 10).write.partitionBy("d").parquet(os.path.join(tmpdir_path, "ev"))
    parts = sorted(os.listdir(os.path.join(tmpdir_path, "ev")))
    src_dir = os.path.join(tmpdir_path, "src")
    os.makedirs(src_dir)
    for i, p in enumerate(x for x in parts if x.startswith("d=")):
        spark.read.parquet(os.path.join(tmpdir_path, "ev", p)).write.parquet(os.path.join(src_dir, f"f{i}"))
    streamed = ingest_available(spark, f"{src_dir}/*/*.parquet", src_dir, ev.schema, tp.lap_features_of_events,
                                sink=os.path.join(tmpdir_path, "out"), checkpoint=os.path.join(tmpdir_path, "ck"))
    batch = tp.lap_features_of_events(ev)
    key = ["Driver", "LapNumber"]
    a = streamed.toPandas().sort_values(key).reset_index(drop=True)
    b = batch.toPandas().sort_values(key).reset_index(drop=True)
    assert len(a) == len(b)
    assert (a[key] == b[key]).all().all()


def test_read_artifact_csv_and_parquet(spark, tmpdir_path):
    from lapengine import schemas
    df = spark.createDataFrame([("1", 3, "SOFT", 2, 90.5)], schemas.LAPS_METADATA)
    df.write.option("header", True).csv(os.path.join(tmpdir_path, "meta_csv"))
    df.write.parquet(os.path.join(tmpdir_path, "meta_pq"))
    a = src.read_artifact(spark, os.path.join(tmpdir_path, "meta_csv"), "laps_metadata", fmt="csv").first()
    b = src.read_artifact(spark, os.path.join(tmpdir_path, "meta_pq"), "laps_metadata").first()
    assert a == b and a.LapTimeSeconds == 90.5 and a.LapNumber == 3


def test_year_beyond_an_integer_is_rejected(spark):
    df = spark.createDataFrame([("2024_A_R",), ("99999999999_A_R",), ("x_A_R",), ("2024",)], "label string")
    assert [r.label for r in src.with_session_keys(df, "label").collect()] == ["2024_A_R"]


def test_lap_time_text_and_seconds(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', INTERVAL '0 00:01:33.5' DAY TO SECOND), ('b', INTERVAL '1 00:00:05' DAY TO SECOND), "
                   "('c', CAST(NULL AS INTERVAL DAY TO SECOND)) t(Driver, LapTime)")
    got = {r.Driver: (r.LapTime, r.LapTimeSeconds) for r in src.tyre_table(df).collect()}
    assert got == {"a": ("0 days 00:01:33.500000", 93.5), "b": ("1 days 00:00:05", 86405.0), "c": ("NaT", None)}
    text = spark.createDataFrame([("a", "0 days 00:01:33.5"), ("b", "soon"), ("c", None)], "Driver string, LapTime string")
    assert {r.Driver: (r.LapTime, r.LapTimeSeconds) for r in src.tyre_table(text).collect()} == {
        "a": ("0 days 00:01:33.5", 93.5), "b": ("soon", None), "c": ("N/A", None)}
