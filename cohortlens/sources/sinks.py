"""Result files."""

from __future__ import annotations

import csv
import io

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession


def save_table(frame: DataFrame, path: str, max_files: int | None = None) -> None:
    """Write parquet, in at most ``max_files`` files of ordinary size when given.

    Rows are dealt anew for it, so the stage that computes them keeps its tasks; adaptive execution makes fewer files of
    a small result, and more only of parts far larger than ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.
    """
    (frame.hint("rebalance", max_files) if max_files else frame).write.mode("overwrite").parquet(path)


def export_text(frame: DataFrame, path: str, sep: str = "|", header: bool = True, single_file: bool = True) -> None:
    """Write delimited text to the folder ``path``; with ``single_file`` all rows, in order, are one part file.

    Each task writes its own rows; the files are joined afterwards, by the file system where it can, so that no task
    holds them all.
    """
    names = header and not single_file
    frame.write.mode("overwrite").option("sep", sep).option("header", names).option("emptyValue", "").csv(path)
    if single_file:
        line = io.StringIO()
        if header:
            csv.writer(line, delimiter=sep, lineterminator="\n").writerow(frame.columns)
        join_parts(frame.sparkSession, path, line.getvalue())


def join_parts(spark: SparkSession, path: str, first: str) -> None:
    """Make one file of the part files in a folder, in the order of their names, after the text ``first``.

    File systems that can join files do it without reading them. For others the bytes are copied, a buffer at a time.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    folder = hadoop.fs.Path(path)
    system = folder.getFileSystem(conf)
    parts = sorted(
        (str(status.getPath()) for status in system.listStatus(folder) if status.getPath().getName().startswith("part-"))
    )
    whole = hadoop.fs.Path(folder, "_joined.csv")
    stream = system.create(whole, True)
    stream.write(bytearray(first.encode()))
    stream.close()
    if not (parts and first and _concat(spark, system, whole, parts)):
        stream = system.create(whole, True)
        stream.write(bytearray(first.encode()))
        for part in parts:
            source = system.open(hadoop.fs.Path(part))
            hadoop.io.IOUtils.copyBytes(source, stream, conf, False)
            source.close()
        stream.close()
        for part in parts:
            system.delete(hadoop.fs.Path(part), False)
    system.rename(whole, hadoop.fs.Path(folder, "part-00000.csv"))


def _concat(spark: SparkSession, system, whole, parts: list[str]) -> bool:
    path_class = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    sources = spark.sparkContext._gateway.new_array(path_class, len(parts))
    for at, part in enumerate(parts):
        sources[at] = path_class(part)
    try:
        system.concat(whole, sources)
    except (PySparkException, Py4JJavaError):
        return False
    return True
