"""Exact duplicates with a heavy-hitter split.

Misra-Gries summaries, one per partition and merged, find the digests that may be frequent. Their exact sizes and
winners are verified on all rows (sums before the shuffle), and are so few that they are broadcast: copies in the
frequent groups are decided where they are read and never shuffled. All other digests are shuffled as usual; a group
among them has at most rows / (slots + 1) members.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import SPACES, keep_rows, stage, text_key, whole_text

# Counters of a Misra-Gries summary: every digest of more than rows / (SLOTS + 1) rows is found.
SLOTS = 1024


def digests(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, text_key, points (code points), the SHA-256 of the text without white space, and place, a number
    that no other row has."""
    text = whole_text()
    return docs.select(
        "doc_id",
        text_key().alias("text_key"),
        F.length(text).alias("points"),
        F.unhex(F.sha2(F.translate(text, SPACES, ""), 256)).alias("digest"),
        F.monotonically_increasing_id().alias("place"),
    )


def frequent(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """At most ``slots`` digests, among them all of more than rows / (slots + 1) rows."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            counts.update(batch.column(0).to_pylist())
            if len(counts) > slots:
                least = sorted(counts.values(), reverse=True)[slots]
                counts = Counter({digest: n - least for digest, n in counts.items() if n > least})
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["digest", "floor"]
        )

    return (
        rows.select("digest")
        .mapInArrow(summarise, "digest binary, floor bigint")
        .groupBy("digest")
        .agg(F.sum("floor").alias("floor"))
        .orderBy(F.desc("floor"), "digest")
        .limit(slots)
        .select("digest")
    )


def exact_duplicates(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """A row for each row of docs: doc_id, text_key, digest, keep_id, group_size, kept.

    The row with the most code points, then the smallest doc_id stays (null ids last); of rows that repeat it, one.
    A null text is an empty one; white space alone equals an empty text. No rows give no rows. The one row that stays of a
    frequent group is the only one of it that is shuffled, also where rows repeat an id (or none) and a text.
    """
    rows = stage(digests(docs), "digests")
    winner = F.min(F.struct(-F.col("points"), F.col("doc_id").isNull(), "doc_id", "text_key", "place"))
    candidates = F.broadcast(frequent(rows, slots))  # at most ``slots`` rows of 32 bytes
    verified = (
        rows.join(candidates, "digest")
        .groupBy("digest")
        .agg(winner.alias("winner"), F.count(F.lit(1)).alias("size"))
        .select(
            "digest",
            F.col("winner.doc_id").alias("heavy_id"),
            F.col("winner.place").alias("heavy_place"),
            F.col("size").alias("heavy_size"),
        )
    )
    heavy = stage(verified, "frequent")
    marked = rows.join(F.broadcast(heavy), "digest", "left")  # at most ``slots`` rows
    beaten = F.col("heavy_size").isNotNull() & (F.col("place") != F.col("heavy_place"))
    columns = ("doc_id", "text_key", "digest")
    removed = marked.where(beaten).select(
        *columns,
        F.col("heavy_id").alias("keep_id"),
        F.col("heavy_size").alias("group_size"),
        F.lit(False).alias("kept"),
    )
    group = Window.partitionBy("digest")
    ranked = group.orderBy(F.desc("points"), F.col("doc_id").isNull(), "doc_id", "text_key")
    rest = marked.where(~beaten).select(
        *columns,
        F.first("doc_id").over(ranked).alias("keep_id"),
        F.coalesce("heavy_size", F.count(F.lit(1)).over(group)).alias("group_size"),
        (F.row_number().over(ranked) == 1).alias("kept"),
    )
    return removed.unionByName(rest)


def drop_exact_duplicates(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """The rows of docs that stay, columns as given."""
    return keep_rows(docs, exact_duplicates(docs, slots))
