"""Tables that several plans share, written once to the cluster's checkpoint folder."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


def staging_folder(spark: SparkSession) -> str:
    """A new folder for one run, below the checkpoint folder that the session names."""
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach, or name a folder")
    return f"{root.rstrip('/')}/cohortlens-{uuid.uuid4().hex}"


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a run's folder, wherever Spark's file systems have it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(frame: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``frame`` to ``folder/name`` and read it back.

    The files outlive lost executors, and their sizes give the planner real statistics for what follows.
    """
    path = f"{folder}/{name}.parquet"
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def stage_together(frames: dict[str, DataFrame], folder: str, name: str) -> dict[str, DataFrame]:
    """Write several frames to ``folder/name`` in one job and read each of them back.

    Within a job Spark runs the frames' stages side by side and computes once what they have in common. Columns of one
    name have to be of one type.
    """
    tagged = [frame.withColumn("part", F.lit(part)) for part, frame in frames.items()]
    stacked = reduce(lambda some, one: some.unionByName(one, allowMissingColumns=True), tagged)
    path = f"{folder}/{name}.parquet"
    stacked.write.mode("overwrite").partitionBy("part").parquet(path)
    whole = stacked.sparkSession.read.schema(stacked.schema).parquet(path)
    return {part: whole.where(F.col("part") == part).select(*frame.columns) for part, frame in frames.items()}
