"""ST1 for laps whose samples arrive in pieces: laps stay open until they are complete, and late samples open them again.

The state is three keyed tables in the shared folder, one version a
micro-batch: the samples of open laps, how far each driver has been seen, and
an archive of closed laps' samples by driver bucket.  A micro-batch

1. takes the open laps of the version before and the new samples,
2. opens laps again that new samples older than what was seen of a driver belong
   to, with their archived samples (only then, and only in those drivers'
   buckets, is the archive read),
3. closes every lap that its driver has been seen ``grace`` beyond, and runs the
   ordinary batch plan on the closed laps.

A lap that was opened again is written again; readers take its latest version.
Everything a micro-batch writes lies under its own number with overwrite and
everything it reads under the number before, so a batch that is run again
replaces its own output.  ``lap_table`` adds the laps that are still open.

No step gathers a driver or a lap in one task: marks and ends are partial
aggregates, the rest are joins on keys.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from lapengine.functions.columns import all_not_null
from lapengine.streaming.ingest import shared_dir

BUCKETS = 64


@dataclass
class OpenLaps:
    """Ingest of samples into closed laps under ``root``.

    ``driver, lap, t``: columns of a sample (``t``: a number that grows with time); samples without one of them belong to no
    lap.  ``transform``: the batch plan from samples to one row a lap, with the columns ``lap_keys``.  ``grace`` (> 0, in the
    unit of ``t``): how long after a lap's last sample it stays open; a smaller one costs more second versions, no result.
    A driver's laps must not overlap in time; in what order samples arrive does not matter.
    """

    root: str
    schema: StructType
    driver: Column
    lap: Column
    t: Column
    transform: Callable[[DataFrame], DataFrame]
    lap_keys: list[str]
    grace: int
    buckets: int = BUCKETS

    def _keyed(self, samples: DataFrame) -> DataFrame:
        own = samples.select(F.struct(*samples.columns).alias("s"), self.driver.cast("string").alias("driver"), self.lap.cast("string").alias("lap"), self.t.cast("long").alias("t"))
        return own.where(all_not_null(["driver", "lap", "t"]))

    def _read(self, spark: SparkSession, table: str, epoch: int, like: DataFrame) -> DataFrame:
        """One version of a state table; before the first one it is empty."""
        if epoch < 0:
            return spark.createDataFrame([], like.schema)
        return spark.read.schema(like.schema).parquet(f"{self.root}/{table}/epoch={epoch}")

    def _archived(self, late: DataFrame, epoch: int) -> DataFrame:
        """The samples of the laps of ``late`` rows as last archived before ``epoch``, by driver bucket."""
        keys = late.select("bucket", "driver", "lap").distinct()
        try:
            archive = late.sparkSession.read.schema(StructType([*late.schema.fields]).add("epoch", IntegerType())).parquet(f"{self.root}/archive")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return late.limit(0)
        own = archive.where(F.col("epoch") < epoch).join(keys, ["bucket", "driver", "lap"], "left_semi")
        last = own.groupBy("bucket", "driver", "lap").agg(F.max("epoch").alias("epoch"))
        return own.join(last, ["bucket", "driver", "lap", "epoch"], "left_semi").select(*late.columns)

    def run_batch(self, df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        new = self._keyed(df)
        before = self._read(spark, "marks", epoch - 1, new.select("driver", F.col("t").alias("seen")))
        seen = before.unionByName(new.select("driver", F.col("t").alias("seen"))).groupBy("driver").agg(F.max("seen").alias("seen"))
        bucket = F.pmod(F.xxhash64("driver"), F.lit(self.buckets)).cast("int")
        # a sample that is older than what its driver has been seen with, and of no open lap, may be one of a closed lap
        still_open = self._read(spark, "open", epoch - 1, new).select("driver", "lap")
        late = (new.join(before, "driver").where(F.col("t") <= F.col("seen")).select(*new.columns)
                .join(still_open, ["driver", "lap"], "left_anti").select(*new.columns).withColumn("bucket", bucket))
        samples = self._read(spark, "open", epoch - 1, new).unionByName(new)
        if not late.isEmpty():
            samples = samples.unionByName(self._archived(late, epoch).select(*new.columns))
        ends = samples.groupBy("driver", "lap").agg(F.max("t").alias("last")).join(seen, "driver")
        closing = ends.where(F.col("seen") >= F.col("last") + self.grace)
        # written under this batch's number first, so that the steps below read one and the same split
        done, still = f"{self.root}/closing/epoch={epoch}", f"{self.root}/open/epoch={epoch}"
        split = samples.join(closing.select("driver", "lap", F.lit(True).alias("ends")), ["driver", "lap"], "left")
        split.where(F.col("ends").isNull()).select(*new.columns).write.mode("overwrite").parquet(still)
        split.where("ends").select(*new.columns).write.mode("overwrite").parquet(done)
        closed = spark.read.schema(new.schema).parquet(done)
        closed.withColumn("bucket", bucket).repartition("bucket", F.pmod(F.xxhash64("lap", "t"), F.lit(16))) \
              .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/archive/epoch={epoch}")
        seen.write.mode("overwrite").parquet(f"{self.root}/marks/epoch={epoch}")
        self.transform(closed.select("s.*")).write.mode("overwrite").parquet(f"{self.root}/laps/epoch={epoch}")

    def ingest(self, spark: SparkSession, source_glob: str, base_path: str, checkpoint: str, max_files: int | None = None, timeout_s: int = 3600) -> None:
        """Runs until all files that are there have been taken in."""
        reader = spark.readStream.schema(self.schema).option("basePath", base_path)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        q = (reader.parquet(source_glob).writeStream.foreachBatch(self.run_batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        if not q.awaitTermination(timeout_s):
            q.stop()
            raise TimeoutError(f"streaming query did not finish within {timeout_s} s")
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))

    def lap_table(self, spark: SparkSession) -> DataFrame:
        """The latest version of every closed lap, and the open laps as they stand; ``is_open`` tells which."""
        laps = spark.read.parquet(f"{self.root}/laps")
        last = laps.groupBy(*self.lap_keys).agg(F.max("epoch").alias("epoch"))
        now = spark.read.parquet(f"{self.root}/marks").agg(F.max("epoch").alias("e")).first().e
        empty = spark.createDataFrame([], self.schema)
        still = self.transform(self._read(spark, "open", now, self._keyed(empty)).select("s.*"))
        # a lap that late samples have opened again is open, whatever was written of it before
        closed = laps.join(last, [*self.lap_keys, "epoch"], "left_semi").drop("epoch").join(still.select(*self.lap_keys), self.lap_keys, "left_anti")
        return closed.withColumn("is_open", F.lit(False)).unionByName(still.withColumn("is_open", F.lit(True)))


def ingest_in_pieces(arrivals: list[DataFrame], laps: OpenLaps) -> DataFrame:
    """Each frame written as the next arrival of files and taken in on its own; the table of laps after the last one."""
    spark = arrivals[0].sparkSession
    source, checkpoint = shared_dir(spark, "pieces-src"), shared_dir(spark, "pieces-ckpt")
    for i, a in enumerate(arrivals):
        a.write.parquet(f"{source}/arrival{i}")
        laps.ingest(spark, f"{source}/arrival*", source, checkpoint)
    return laps.lap_table(spark)
