"""ST2: online prediction - score arriving lap rows with a fitted pipeline.

A stateless map (defaults injected, ``PipelineModel.transform``) between a
file stream and a sink; no shuffle, no state store.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lapengine.operators.models import REQUEST_DEFAULTS, predict
from lapengine.streaming.ingest import shared_dir


def score_stream(spark: SparkSession, source_glob: str, base_path: str, schema: StructType,
                 model: PipelineModel, prepare, keep: list[str], defaults: dict = REQUEST_DEFAULTS,
                 sink: str | None = None, checkpoint: str | None = None, timeout_s: int = 3600) -> DataFrame:
    """Score every available row once (``availableNow``); return the written predictions."""
    sink = sink or shared_dir(spark, "score-out")
    checkpoint = checkpoint or shared_dir(spark, "score-ckpt")
    src = spark.readStream.schema(schema).option("basePath", base_path).parquet(source_glob)
    scored = predict(prepare(src), model, defaults).select(*keep, "prediction")
    q = (scored.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
               .outputMode("append").trigger(availableNow=True).start())
    finished = q.awaitTermination(timeout_s)
    if not finished:  # never hand back a partial result
        q.stop()
        raise TimeoutError(f"streaming query did not finish within {timeout_s} s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(sink)
