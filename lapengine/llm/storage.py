"""Written tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def bounded_batches(spark: SparkSession, rows: int = 1000) -> SparkSession:
    """``spark``, set to hand Python at most ``rows`` rows at a time: a batch of whole texts is some MB then."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``.

    The setting is read from the session.  Where it is unset, a temporary
    folder is used if the master runs in this one process; any other master
    raises, as its executors would not see that folder.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="lapengine-llm-")
    return f"{base.rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back: cuts the lineage and
    keeps several consumers from computing it again, and survives a lost executor."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
