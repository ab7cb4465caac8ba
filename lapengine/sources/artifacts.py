"""Scans, session catalogue and table extraction."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapengine import schemas
from lapengine.functions.columns import interval_text, interval_text_seconds, session_label


def read_artifact(spark: SparkSession, path: str, kind: str, fmt: str = "parquet") -> DataFrame:
    """A1: read one artefact kind with its declared schema (no inference).

    Parquet scans prune columns and push filters by themselves; CSV gets the
    same explicit schema so nothing is sampled up front.
    """
    schema = schemas.SCHEMAS[kind]
    r = spark.read.schema(schema)
    if fmt == "csv":
        return r.option("header", True).csv(path)
    return r.parquet(path)


def with_session_keys(df: DataFrame, label: str | Column) -> DataFrame:
    """A2: ``<year>_<event>_<type>`` -> Year, Event, SessionType.

    Under two parts, or a year that is not digits or no integer: the row is
    rejected; exactly two parts: event ``UnknownEvent``.
    """
    lab = F.col(label) if isinstance(label, str) else label
    parts = F.split(lab, "_")
    n = F.size(parts)
    year = F.element_at(parts, 1)
    stype = F.element_at(parts, -1)
    event = F.when(n > 2, F.array_join(F.slice(parts, 2, n - 2), "_")).otherwise(F.lit("UnknownEvent"))
    number = F.when(year.rlike("^[0-9]+$"), year.try_cast("int"))
    ok = (n >= 2) & number.isNotNull()
    out = df.where(ok)
    return out.select("*", number.alias("Year"), event.alias("Event"), stype.alias("SessionType"))


def session_keys_from_path(df: DataFrame, depth_from_end: int = 2) -> DataFrame:
    """A2 on file paths: the session folder name is the label.

    Uses the hidden ``_metadata.file_path`` column of file sources.
    """
    p = F.col("_metadata.file_path")
    folder = F.element_at(F.split(p, "/"), -depth_from_end)
    return with_session_keys(df.select("*", folder.alias("_label")), "_label").drop("_label")


def merge_sessions(spark: SparkSession, root: str, artefact: str = "lap_features",
                   schema: T.StructType | None = None, evolve: bool = False) -> DataFrame:
    """A4: all sessions' artefact files as one DataFrame with session keys.

    One multi-path scan over ``<root>/<label>/<artefact>`` (parquet); empty
    and unparsable folders drop out through A2's filter.

    ``evolve``: folders may have other columns than the declared ones.  The
    scan's schema is the union over all files (one distributed pass over the
    footers); declared columns come first with their declared types, null where
    a folder lacks them, then any further columns by name, null elsewhere.  A
    column must have one type in all folders.
    """
    schema = schema or schemas.SCHEMAS[artefact]
    path = f"{root}/*/{artefact}"
    if not evolve:
        return session_keys_from_path(spark.read.schema(schema).option("recursiveFileLookup", "false").parquet(path), depth_from_end=3)
    found = spark.read.option("mergeSchema", "true").parquet(path).schema
    extra = sorted((f for f in found.fields if f.name not in schema.names), key=lambda f: f.name)
    return session_keys_from_path(spark.read.schema(T.StructType([*schema.fields, *extra])).parquet(path), depth_from_end=3)


def union_sessions(frames: list[DataFrame]) -> DataFrame:
    """A4 for frames already loaded: UNION ALL by name, drifted schemas allowed."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def list_sessions(df: DataFrame, label: str = "label") -> DataFrame:
    """A5: session names that start with a digit, newest first."""
    return df.select(label).where(F.col(label).rlike("^[0-9]")).distinct().orderBy(F.col(label).desc())


def race_calendar(schedule: DataFrame, round_col: str = "RoundNumber", name: str = "EventName") -> DataFrame:
    """Rounds above 0 whose name has neither ``Test`` nor ``Pre-Season``."""
    return schedule.where((F.col(round_col) > 0) & ~F.col(name).contains("Test")
                          & ~F.col(name).contains("Pre-Season"))


def pending_sessions(calendar: DataFrame, done: DataFrame, types: list[str],
                     year: str = "Year", event: str = "EventName") -> DataFrame:
    """(event x session type) not yet ingested.

    The session types are a literal list of a handful of values; they are
    attached with ``explode(array(...))`` (no join), then ``left_anti``
    against the done labels.
    """
    cal = calendar.select(year, event, F.explode(F.array(*[F.lit(t) for t in types])).alias("SessionType"))
    cal = cal.select("*", session_label(year, event, "SessionType").alias("label"))
    return cal.join(done.select("label"), "label", "left_anti")


def pending_signals(inventory: DataFrame, telemetry_labels: DataFrame, feature_labels: DataFrame) -> DataFrame:
    """Sessions that have telemetry and no lap features yet."""
    return (inventory.join(telemetry_labels.select("label"), "label", "left_semi")
                     .join(feature_labels.select("label"), "label", "left_anti"))


def interval_seconds(c: str | Column) -> Column:
    """Seconds of a day-time interval (exact to the microsecond)."""
    col = F.col(c) if isinstance(c, str) else c
    # wall-clock arithmetic on timestamp_ntz: independent of the session time zone
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    return F.timestamp_diff("MICROSECOND", epoch, epoch + col).cast("double") / F.lit(1e6)


def extract_laps(raw: DataFrame, lap_time: str = "LapTime") -> DataFrame:
    """``LapTime`` interval -> ``LapTimeSeconds`` (double)."""
    return raw.select("*", interval_seconds(lap_time).alias("LapTimeSeconds"))


def extract_weather(raw: DataFrame | None, time_text: str = "Time") -> DataFrame | None:
    """A10: weather with ``TimeSeconds`` parsed from the text interval; None passes through."""
    if raw is None:
        return None
    return raw.select("*", interval_text_seconds(time_text).alias("TimeSeconds"))


def tyre_table(laps: DataFrame) -> DataFrame:
    """Tyre / stint projection with per-column defaults and safe casts.

    ``LapTime``, a day-time interval or its text, gives a text column (``NaT`` for a null interval) and the seconds.
    """
    def txt(c, default):
        return (F.coalesce(F.col(c).cast("string"), F.lit(default)) if c in laps.columns
                else F.lit(default)).alias(c)

    def num(c):
        return (F.coalesce(F.expr(f"try_cast(`{c}` AS INT)"), F.lit(0)) if c in laps.columns
                else F.lit(0)).alias(c)
    lap_secs = (F.expr("try_cast(LapTimeSeconds AS DOUBLE)") if "LapTimeSeconds" in laps.columns
                else F.lit(None).cast("double"))
    text = []
    if "LapTime" in laps.columns:                               # its text, and the seconds parsed from it
        lap_time = F.col("LapTime")
        if not isinstance(laps.schema["LapTime"].dataType, T.StringType):
            us = F.round(interval_seconds(lap_time) * F.lit(1e6)).cast("long")
            lap_time = F.when(us.isNull(), F.lit("NaT")).otherwise(F.regexp_replace(interval_text(us), r"\.000000$", ""))
        text = [F.coalesce(lap_time, F.lit("N/A")).alias("LapTime")]
        lap_secs = interval_text_seconds(lap_time)
    return laps.select(txt("Driver", "N/A"), txt("DriverNumber", "N/A"), txt("Team", "N/A"), num("LapNumber"),
                       txt("Compound", "UNKNOWN"), num("TyreLife"), txt("FreshTyre", "N/A"), *text,
                       lap_secs.alias("LapTimeSeconds"), num("Stint"), txt("IsPersonalBest", "false"))


def stringify(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Text form of the given columns (default: all non-numeric ones)."""
    if cols is None:
        cols = [f.name for f in df.schema.fields
                if not isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    return df.select(*[F.col(c).cast("string").alias(c) if c in cols else F.col(c) for c in df.columns])


def results_table(df: DataFrame, types: tuple[str, ...] = ("Q", "R", "Sprint"),
                  type_col: str = "SessionType") -> DataFrame:
    """Results exist only for qualifying, race and sprint sessions."""
    return df.where(F.col(type_col).isin(list(types)))


def first_available(spark: SparkSession, paths: list[str], fmt: str = "parquet",
                    schema: T.StructType | None = None) -> DataFrame | None:
    """The first path that exists and holds a row, or None."""
    for p in paths:
        r = spark.read.schema(schema) if schema is not None else spark.read
        try:
            df = r.format(fmt).load(p)
            if not df.isEmpty():
                return df
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    return None
