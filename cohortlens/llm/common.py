"""What the corpus operators share: scratch tables, word patterns and the identity of a row."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space as the contracts define it: the class [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"


_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


def scratch_folder(spark: SparkSession) -> str:
    """Where scratch tables go: the folder of the run that is open, or else one of the application's own.

    Both are below ``spark.checkpoint.dir``. Only a local session that has none set uses a temporary folder, which is
    removed when Python ends.
    """
    if run := _run_folder.get():
        return run
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and every executor share")
        root = local_scratch()
    return f"{root.rstrip('/')}/llm-{spark.sparkContext.applicationId}"


@cache
def local_scratch() -> str:
    folder = tempfile.mkdtemp(prefix="llm-scratch-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """A folder of its own for the scratch tables that are written inside; gone at the end, with all that reads it."""
    folder = f"{scratch_folder(spark)}/run-{uuid.uuid4().hex}"
    token = _run_folder.set(folder)
    try:
        yield folder
    finally:
        _run_folder.reset(token)
        remove(spark, folder)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder wherever Spark's file systems have it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def remove_scratch(spark: SparkSession) -> None:
    """Delete all scratch tables of the application, when no frame of this package is to be used any more."""
    remove(spark, scratch_folder(spark))


def stage(df: DataFrame, name: str, *split_by: str) -> DataFrame:
    """Write ``df`` to a new scratch table and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    folder = f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*split_by).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(text: str | Column = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(text, F.lit(""))


def text_key(text: str | Column = "text") -> Column:
    """With ``doc_id`` the identity of a row: rows equal in both are one document, repeated."""
    return F.xxhash64(whole_text(text))


def words_of(text: Column) -> Column:
    """The words of a text, none for null."""
    return F.when(F.length(bare := F.trim(text, F.lit(SPACES))) > 0, F.split(bare, SPACE_CLASS + "+")).otherwise(
        F.array().cast("array<string>")
    )


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def keep_rows(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``marks`` (doc_id, text_key, kept; a row for each row of docs) keeps, columns as given.

    Of rows that repeat a kept document the marks keep one, and so does this. Texts are shuffled only where the
    dropped keys are too many for the session's broadcast threshold.
    """
    keys = (
        marks.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
        .agg(F.bool_or("kept").alias("_kept"), F.count(F.lit(1)).alias("_rows"))
        .where(~F.col("_kept") | (F.col("_rows") > 1))
    )
    odd = stage(keys, "dropped")
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_doc"), text_key().alias("_text"))
    on = same(rows["_doc"], odd["_id"]) & (rows["_text"] == odd["_key"])
    once = rows.join(odd, on, "left_anti")
    repeated = odd.where("_kept")
    on = same(rows["_doc"], repeated["_id"]) & (rows["_text"] == repeated["_key"])
    again = rows.join(repeated, on, "left_semi").dropDuplicates(["_doc", "_text"])
    return once.unionByName(again).select("_row.*")
