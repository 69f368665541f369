"""A claim store: claims bucketed and sorted by member, so that attribution need not shuffle them.

Lines are added up per member and day, and joined to the member's calendar, within the bucket in which they lie. For that
Spark has to take a table that is dealt by member alone as dealt well enough for joins on member and month:
``spark.sql.requireAllClusterKeysForCoPartition`` has to be false in the session, and there have to be at least as many
buckets as ``spark.sql.shuffle.partitions``, or Spark deals the claims to these; results are the same either way. All lines
of a member are in one bucket, so a store suits claims in which no member holds a large share.

A shuffled row is about three times as large as a row in a file. Were all claims dealt out at once, they would lie on disk as
shuffle files, beside those of whatever computes them, until the last bucket is written. They are staged by round, a share
of the buckets, and dealt out a round at a time; what a round no longer needs is removed with it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.sources.staging import remove
from cohortlens.sources.tables import ClaimTables, read_table

CLAIMS = "outclaims"
ROUND = "store_round"
# At most: a shuffle is then smaller than what is staged, and that has to lie on disk in any case.
ROUNDS = 4
ROW_GROUP = 32 << 20  # bytes; a task stages all rounds at once, and may hold a row group of each

SETTINGS = {
    # shuffle files go when the job that wrote them ends, and not when the driver happens to collect its garbage
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # claims are staged by round without a sort
    "spark.sql.maxConcurrentOutputFileWriters": str(ROUNDS),
}


def save_claim_store(tables: ClaimTables, folder: str, prefix: str, buckets: int) -> None:
    """Write the tables to ``folder``, and the claims as the catalog table ``<prefix>outclaims`` in ``buckets`` files."""
    for field in fields(ClaimTables):
        frame, path = getattr(tables, field.name), f"{folder}/{field.name}.parquet"
        if field.name == CLAIMS:
            save_in_rounds(frame, path, f"{prefix}{CLAIMS}", buckets, f"{folder}/{CLAIMS}-{uuid.uuid4().hex}")
        else:
            frame.write.mode("overwrite").parquet(path)


def save_in_rounds(frame: DataFrame, path: str, table: str, buckets: int, staged: str) -> None:
    """Write ``frame`` as ``table``, bucketed and sorted by member, by way of files in ``staged``."""
    spark = frame.sparkSession
    rounds = min(buckets, number_of_rounds(buckets, spark.sparkContext.defaultParallelism))
    with settings(spark):
        try:
            by_round = frame.withColumn(ROUND, F.expr(f"pmod(hash(member_id), {buckets}) % {rounds}"))
            writer = by_round.write.partitionBy(ROUND).option("parquet.block.size", ROW_GROUP)
            writer.option("compression", "zstd").parquet(staged)
            lines = spark.read.schema(by_round.schema).parquet(staged)
            shares = ((f"{staged}/{ROUND}={at}", lines.where(F.col(ROUND) == at).drop(ROUND)) for at in range(rounds))
            fill_table(frame, path, table, buckets, shares)
        finally:
            remove(spark, staged)


def fill_table(frame: DataFrame, path: str, table: str, buckets: int, shares: Iterable[tuple[str, DataFrame]]) -> None:
    """Make the table like ``frame`` and add one share after the other, whose files are then removed.

    A failure leaves no table of that name, so that nobody takes some of the shares for all.
    """
    spark = frame.sparkSession
    empty = frame.limit(0).write.mode("overwrite").option("path", path)
    empty.bucketBy(buckets, "member_id").sortBy("member_id").saveAsTable(table)
    try:
        for files, share in shares:
            # dealt like the buckets first: each is one file, written by one task
            share.repartition(buckets, "member_id").write.insertInto(table)
            remove(spark, files)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        raise


def number_of_rounds(buckets: int, slots: int) -> int:
    """A round should have a bucket for each of the tasks that can run, but all claims are never dealt out in one."""
    return max(2, min(ROUNDS, buckets // slots))


@contextmanager
def settings(spark: SparkSession) -> Iterator[None]:
    """``SETTINGS`` for a while."""
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def read_claim_store(spark: SparkSession, folder: str, prefix: str) -> ClaimTables:
    """The tables of a store; the catalog knows how the claims are bucketed."""
    others = {f.name: read_table(spark, folder, f.name) for f in fields(ClaimTables) if f.name != CLAIMS}
    return ClaimTables(**others, outclaims=spark.table(f"{prefix}{CLAIMS}"))
