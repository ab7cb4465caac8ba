"""Laps that arrive in pieces: closing, late samples, versions, retried batches."""

import pytest
from pyspark.sql import functions as F

from lapengine.streaming.ingest import shared_dir
from lapengine.streaming.open_laps import OpenLaps, ingest_in_pieces

SCHEMA = "d string, n int, at long, v double"


def _plan(samples):
    return samples.where("d is not null").groupBy("d", "n").agg(F.sum("v").alias("total"), F.count("*").alias("samples"), F.max("at").alias("last"))


def _laps(spark, grace=10):
    schema = spark.createDataFrame([], SCHEMA).schema
    return OpenLaps(shared_dir(spark, "t"), schema, F.col("d"), F.col("n"), F.col("at"), _plan, ["d", "n"], grace, buckets=3)


def _rows(spark, rows):
    return spark.createDataFrame([(d, n, at, float(at)) for d, n, at in rows], SCHEMA)


def _got(df):
    return {(r.d, r.n): (r.total, r.samples, r.last, r.is_open) for r in df.collect()}


def test_pieces_late_samples_and_open_laps(spark):
    first = [("a", 1, 0), ("a", 1, 5), ("a", 2, 30), ("b", 1, 3), (None, 1, 4), ("b", None, 5)]
    second = [("a", 2, 31), ("b", 1, 8), ("a", 1, 7), ("c", 9, 1), ("c", 9, 100)]           # ("a", 1) has been closed: late
    third = [("a", 3, 60), ("a", 3, 61), ("b", 1, 9), ("b", 2, 40), ("a", 1, 2)]             # and once more
    laps = _laps(spark)
    out = _got(ingest_in_pieces([_rows(spark, x) for x in (first, second, third)], laps))
    assert out == {("a", 1): (14.0, 4, 7, False), ("a", 2): (61.0, 2, 31, False), ("a", 3): (121.0, 2, 61, True), ("b", 1): (20.0, 3, 9, False),
                   ("b", 2): (40.0, 1, 40, True), ("c", 9): (101.0, 2, 100, True)}
    versions = spark.read.parquet(f"{laps.root}/laps").where("d = 'a' and n = 1").orderBy("epoch").collect()
    assert [(r.epoch, r.samples) for r in versions] == [(0, 2), (1, 3), (2, 4)]


def test_a_retried_batch_replaces_its_output(spark):
    laps = _laps(spark)
    batches = [_rows(spark, [("a", 1, 0), ("a", 2, 30)]), _rows(spark, [("a", 2, 35), ("a", 3, 90), ("a", 1, 1)]), _rows(spark, [("a", 3, 91)])]
    for epoch in (0, 0, 1, 1, 1, 2):
        laps.run_batch(batches[epoch], epoch)
    assert _got(laps.lap_table(spark)) == {("a", 1): (1.0, 2, 1, False), ("a", 2): (65.0, 2, 35, False), ("a", 3): (181.0, 2, 91, True)}


@pytest.mark.parametrize("grace", [1, 1000])
def test_grace_changes_versions_not_results(spark, grace):
    rows = [("ab"[i % 2], 1 + i // 12, 7 * i) for i in range(60)]
    laps = _laps(spark, grace)
    out = _got(ingest_in_pieces([_rows(spark, rows[:25]), _rows(spark, rows[50:] + rows[25:30]), _rows(spark, rows[30:50])], laps))
    want = {}
    for d, n, at in rows:
        t, c, last = want.get((d, n), (0.0, 0, 0))
        want[d, n] = (t + at, c + 1, max(last, at))
    assert {k: v[:3] for k, v in out.items()} == want


def test_empty_arrivals(spark):
    out = ingest_in_pieces([_rows(spark, []), _rows(spark, [("a", 1, 1)]), _rows(spark, [])], _laps(spark))
    assert _got(out) == {("a", 1): (1.0, 1, 1, True)}
