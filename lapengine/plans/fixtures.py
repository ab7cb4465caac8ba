"""Telemetry-shaped views over the driver's synthetic tables (FIXTURES.md §2).

Each binding exists twice with identical arithmetic: as a Spark DataFrame
(``telemetry(spark, sf_dir)`` ...) and as a DuckDB CTE (``SQL_*``) used by
the oracle queries.  Every view is a projection of one or two given tables,
so its size grows with them.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapengine.functions.columns import floor_div

# Fixed binding parameters (shared by Spark and SQL).
FX1_LAP_DAYS = 10                      # days of events per lap
FX1_STEP_US = 6 * 3600 * 1_000_000     # C1 grid step on FX1: 6 h
FX1_DIST_UNIT_US = 100_000             # one distance unit per 0.1 s of session time
FX1_DIST_STEP = 100_000                # C2 grid step on FX1, distance units
FX1_DIST_SCALE = 100.0                 # distance units per metre
FX1_DT = 0.1                           # derivative step on the FX1 grid


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ts_us() -> F.Column:
    return F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)")


def telemetry(spark: SparkSession, sf_dir: str | None, *, null_value: bool = False,
              short_laps: bool = False, events: DataFrame | None = None) -> DataFrame:
    """FX1: raw lap telemetry from ``events`` (or from a given events frame, e.g. a micro-batch)."""
    ev = events if events is not None else _read(spark, sf_dir, "events")
    days = F.datediff(F.to_date("ts"), F.lit(date(2024, 1, 1)))
    lap = (days if short_laps else floor_div(days, FX1_LAP_DAYS)) + 1
    k = F.get_json_object("props", "$.k").cast("int").cast("double")
    value = F.col("value")
    if null_value:
        value = F.when(F.col("event_type") != "error", value)       # an error event carries no reading
    st = _ts_us()
    return ev.select(
        F.col("user_id").cast("string").alias("Driver"),
        lap.cast("int").alias("LapNumber"),
        F.col("event_id"),
        st.alias("SessionTime_us"),
        value.alias("Speed"),
        k.alias("Throttle"),
        (F.col("event_type") == "error").alias("Brake"),
        (F.col("event_id") % 997).cast("double").alias("X"),
        (floor_div(st, 1_000_000) % 1009).cast("double").alias("Y"),
        floor_div(st, FX1_DIST_UNIT_US).alias("Distance_c"),
        F.col("event_type").alias("Compound"),
    )


def telemetry_laps(spark: SparkSession, sf_dir: str | None, tel: DataFrame | None = None) -> DataFrame:
    """FX1 lap metadata: one row per lap, lap time from the sample span."""
    t = tel if tel is not None else telemetry(spark, sf_dir)
    return (t.groupBy("Driver", "LapNumber")
             .agg(((F.max("SessionTime_us") - F.min("SessionTime_us")).cast("double") / F.lit(1e6))
                  .alias("LapTimeSeconds"),
                  F.min(F.struct("SessionTime_us", "event_id", "Compound")).getField("Compound").alias("Compound"),
                  F.count(F.lit(1)).cast("int").alias("TyreLife")))


def laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX2: laps / sessions from ``orders`` x ``customer`` x ``nation``."""
    o = _read(spark, sf_dir, "orders")
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    x = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return x.select(
        F.col("o_custkey").cast("string").alias("Driver"),
        F.col("c_name").alias("DriverCode"),
        F.col("o_orderkey").alias("LapNumber"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("LapTimeSeconds"),  # P: lap not finished
        F.col("o_orderpriority").alias("Compound"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", (F.col("o_orderkey") % 30).cast("int")).alias("TyreLife"),
        F.year("o_orderdate").alias("Year"),
        F.col("o_orderdate").alias("SessionDate"),
        F.col("n_name").alias("Event"),
        F.col("n_nationkey").alias("RoundNumber"),
        F.col("o_orderstatus").alias("SessionType"),
    )


def lap_features(spark: SparkSession, sf_dir: str | None, lineitem: DataFrame | None = None) -> DataFrame:
    """FX3: lap feature rows from ``lineitem`` (unique ``lap_id``)."""
    li = lineitem if lineitem is not None else _read(spark, sf_dir, "lineitem")
    # the four keys are not unique in every table; the integer forms of the
    # remaining columns make the id a full-row identity
    lap_id = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                         F.round(F.col("l_extendedprice") * 100).cast("long"),
                         F.round(F.col("l_quantity") * 100).cast("long"),
                         F.round(F.col("l_discount") * 100).cast("long"), F.round(F.col("l_tax") * 100).cast("long"),
                         F.datediff(F.to_date("l_shipdate"), F.lit(date(1970, 1, 1))))
    return li.select(
        lap_id.alias("lap_id"),
        F.lit("R").alias("SessionType"),
        F.year("l_shipdate").alias("Year"),
        F.col("l_returnflag").alias("Event"),
        F.col("l_suppkey").cast("string").alias("Driver"),
        F.col("l_linenumber").alias("LapNumber"),
        F.col("l_extendedprice").alias("LapTimeSeconds"),
        F.when(F.col("l_tax") > 0, F.col("l_linestatus")).alias("Compound"),     # no compound on record without tax
        F.col("l_linenumber").cast("double").alias("TyreLife"),
        F.col("l_quantity").alias("Avg_Speed_mps"),
        (F.col("l_partkey") % 100).cast("double").alias("Avg_Throttle"),
        F.col("l_discount").alias("Brake_Aggression"),
        F.col("l_tax").alias("MeanAbs_Jerk_Long"),
        (F.col("l_quantity") * F.col("l_tax")).alias("MeanAbs_Jerk_Lat"),
        ((F.col("l_suppkey") % 50).cast("double") / F.lit(10.0)).alias("Max_Lateral_g"),
        (F.col("l_discount") * F.col("l_quantity")).alias("Max_Longitudinal_g"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("Energy_Index"),
        # a learnable target for model-quality checks
        (F.lit(3.0) * F.col("l_quantity") - F.lit(50.0) * F.col("l_discount") + F.lit(10.0)
         + (F.col("l_partkey") % 7).cast("double") / F.lit(100.0)).alias("TargetTime"),
    )


def matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX4: ``vec_id, label, x array<double>`` from ``embeddings``."""
    e = _read(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))


# ---------------------------------------------------------------------------
# DuckDB text of the same bindings
# ---------------------------------------------------------------------------

_SQL_TS_US = "(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00'))"
_SQL_K = "CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE)"


def sql_telemetry(null_value: bool = False, short_laps: bool = False) -> str:
    days = "date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))"
    lap = days if short_laps else f"({days} // {FX1_LAP_DAYS})"
    value = "CASE WHEN event_type <> 'error' THEN value END" if null_value else "value"
    return f"""SELECT CAST(user_id AS VARCHAR) AS Driver,
       CAST({lap} + 1 AS INTEGER) AS LapNumber,
       event_id,
       {_SQL_TS_US} AS SessionTime_us,
       {value} AS Speed,
       {_SQL_K} AS Throttle,
       (event_type = 'error') AS Brake,
       CAST(event_id % 997 AS DOUBLE) AS X,
       CAST(({_SQL_TS_US} // 1000000) % 1009 AS DOUBLE) AS Y,
       {_SQL_TS_US} // {FX1_DIST_UNIT_US} AS Distance_c,
       event_type AS Compound
FROM events"""


SQL_TELEMETRY_LAPS = f"""SELECT Driver, LapNumber,
       CAST(max(SessionTime_us) - min(SessionTime_us) AS DOUBLE) / 1e6 AS LapTimeSeconds,
       arg_min(Compound, (SessionTime_us, event_id)) AS Compound,
       CAST(count(*) AS INTEGER) AS TyreLife
FROM ({sql_telemetry()}) t
GROUP BY Driver, LapNumber"""

SQL_LAPS = """SELECT CAST(o_custkey AS VARCHAR) AS Driver,
       c_name AS DriverCode,
       o_orderkey AS LapNumber,
       CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS LapTimeSeconds,
       o_orderpriority AS Compound,
       CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(o_orderkey % 30 AS INTEGER) END AS TyreLife,
       CAST(year(o_orderdate) AS INTEGER) AS Year,
       o_orderdate AS SessionDate,
       n_name AS Event,
       n_nationkey AS RoundNumber,
       o_orderstatus AS SessionType
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""

SQL_LAP_FEATURES = """SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CAST(round(l_extendedprice * 100) AS BIGINT), CAST(round(l_quantity * 100) AS BIGINT),
         CAST(round(l_discount * 100) AS BIGINT), CAST(round(l_tax * 100) AS BIGINT),
         date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE))) AS lap_id,
       'R' AS SessionType,
       CAST(year(l_shipdate) AS INTEGER) AS Year,
       l_returnflag AS Event,
       CAST(l_suppkey AS VARCHAR) AS Driver,
       l_linenumber AS LapNumber,
       l_extendedprice AS LapTimeSeconds,
       CASE WHEN l_tax > 0 THEN l_linestatus END AS Compound,
       CAST(l_linenumber AS DOUBLE) AS TyreLife,
       l_quantity AS Avg_Speed_mps,
       CAST(l_partkey % 100 AS DOUBLE) AS Avg_Throttle,
       l_discount AS Brake_Aggression,
       l_tax AS MeanAbs_Jerk_Long,
       l_quantity * l_tax AS MeanAbs_Jerk_Lat,
       CAST(l_suppkey % 50 AS DOUBLE) / 10.0e0 AS Max_Lateral_g,
       l_discount * l_quantity AS Max_Longitudinal_g,
       l_extendedprice * l_discount AS Energy_Index,
       3.0e0 * l_quantity - 50.0e0 * l_discount + 10.0e0 + CAST(l_partkey % 7 AS DOUBLE) / 100.0e0 AS TargetTime
FROM lineitem"""

SQL_MATRIX = "SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings"


def with_ctes(body: str, **ctes: str) -> str:
    parts = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ctes.items())
    return f"WITH {parts}\n{body}"


def extraction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX1 extraction log: one row per event; status and flags from ``k``."""
    t = telemetry(spark, sf_dir)
    k = F.col("Throttle")
    return t.select(F.col("Compound").alias("event"), F.col("event_id"),
                    F.when(k >= 20, F.lit("success")).otherwise(F.lit("error")).alias("status"),
                    (k % 2 == 0).alias("has_laps"), (k % 3 == 0).alias("has_tires"),
                    (k % 5 == 0).alias("has_weather"), (k % 7 == 0).alias("has_telemetry"))


SQL_EXTRACTION_LOG = f"""SELECT Compound AS event, event_id,
       CASE WHEN Throttle >= 20 THEN 'success' ELSE 'error' END AS status,
       (Throttle % 2 = 0) AS has_laps, (Throttle % 3 = 0) AS has_tires,
       (Throttle % 5 = 0) AS has_weather, (Throttle % 7 = 0) AS has_telemetry
FROM ({sql_telemetry()}) t"""


def session_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX2 labels with a few malformed variants for the parser (A2, A5)."""
    from lapengine.functions.columns import session_label
    lp = laps(spark, sf_dir)
    lab = session_label("Year", "Event", "SessionType")
    m = F.col("LapNumber") % 50
    bad = (F.when(m == 0, F.lit("bad"))
            .when(m == 1, F.concat(F.lit("x"), lab))
            .when(m == 2, F.concat_ws("_", F.col("Year").cast("string"), F.col("SessionType")))
            .otherwise(lab))
    return lp.select("LapNumber", bad.alias("label"))


SQL_LABEL = "concat_ws('_', CAST(Year AS VARCHAR), replace(Event, ' ', '_'), replace(SessionType, ' ', '_'))"

SQL_SESSION_LABELS = f"""SELECT LapNumber,
       CASE WHEN LapNumber % 50 = 0 THEN 'bad'
            WHEN LapNumber % 50 = 1 THEN 'x' || {SQL_LABEL}
            WHEN LapNumber % 50 = 2 THEN concat_ws('_', CAST(Year AS VARCHAR), SessionType)
            ELSE {SQL_LABEL} END AS label
FROM ({SQL_LAPS}) l"""


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX2 calendar: distinct (Year, event, round); round 5 is a pre-season test."""
    lp = laps(spark, sf_dir)
    name = F.when(F.col("RoundNumber") == 5, F.concat(F.lit("Pre-Season "), F.col("Event"))).otherwise(F.col("Event"))
    return lp.select("Year", name.alias("EventName"), "RoundNumber").distinct()


SQL_CALENDAR = f"""SELECT DISTINCT Year,
       CASE WHEN RoundNumber = 5 THEN 'Pre-Season ' || Event ELSE Event END AS EventName, RoundNumber
FROM ({SQL_LAPS}) l"""


def done_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX2 sessions already processed: labels whose md5 starts with an even hex digit."""
    from lapengine.functions.columns import session_label
    lp = laps(spark, sf_dir).select(session_label("Year", "Event", "SessionType").alias("label")).distinct()
    return lp.where(F.substring(F.md5("label"), 1, 1).isin(*"02468ace"))


SQL_DONE_LABELS = f"""SELECT DISTINCT {SQL_LABEL} AS label FROM ({SQL_LAPS}) l
WHERE substr(md5({SQL_LABEL}), 1, 1) IN ('0','2','4','6','8','a','c','e')"""
