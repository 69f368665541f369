"""Integer vectors, their exact inner products, and stated queries in blocks: what searches over embeddings share.

A search reads all rows once for each block of queries. A block is bounded in bytes, is sent to all tasks, and each task
keeps the best few rows of what it reads, so neither vectors nor scores are shuffled: only the few that were kept are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import stage

SCALE = 256
BLOCK_BYTES = 16 << 20  # of query vectors that are sent to tasks at once, on average
CHUNK = 512  # queries, and rows, that are multiplied at once
PENDING = 200_000  # rows that a task adds to its best ones before it cuts these


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def usable(vector: str = "embedding") -> Column:
    """Whether a vector is neither null nor has a null or non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite, F.lit(False))


def whole_numbers(vector: str = "embedding") -> Column:
    return F.transform(vector, lambda x: F.floor(SCALE * x.cast("double")))


def matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of 64-bit numbers; components that shorter vectors lack are zero."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    rows = np.zeros((len(lengths), max(lengths, default=0)), np.int64)
    rows[np.arange(rows.shape[1]) < lengths[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    return rows


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``left`` with all of ``right``. Those that may reach 2**56 are an error."""
    width = min(left.shape[1], right.shape[1])
    left, right = left[:, :width], right[:, :width]
    largest = [max(int(x.max(initial=0)), -int(x.min(initial=0))) for x in (left, right)]
    bound = largest[0] * largest[1] * width
    if bound < 1 << 53:  # sums of doubles are exact
        return (left.astype(float) @ right.T.astype(float)).astype(np.int64)
    if bound < 1 << 56:
        return left @ right.T
    raise OverflowError("components are too large for scores of 56 bits")


def identities(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids as 64-bit numbers, and which are null."""
    if isinstance(ids, pa.ChunkedArray):
        ids = ids.combine_chunks()
    return ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), ids.is_null().to_numpy(zero_copy_only=False)


class Best:
    """The ``k`` best rows of each group: higher scores first, then smaller ids, null ids last.

    What is added has to reach the group's floor; floors rise as groups fill up.
    """

    def __init__(self, groups: int, k: int) -> None:
        self.k, self.pending = k, 0
        self.floors = np.full(groups, np.iinfo(np.int64).min)  # what a score has to reach to be among them
        self.last = np.full(groups, np.iinfo(np.int64).max)  # the greatest id that may be among them at that score
        self.parts: list[tuple[np.ndarray, ...]] = [
            (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
        ]

    def add(self, groups: np.ndarray, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        late = (scores == self.floors[groups]) & (ids > self.last[groups])
        if late.any():
            groups, scores, ids, nulls = (x[~late] for x in (groups, scores, ids, nulls))
        if len(groups):
            self.parts.append((groups, scores, ids, nulls))
            self.pending += len(groups)
            if self.pending > max(PENDING, len(self.parts[0][0])):
                self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        """Groups, scores, ids and nulls of the best rows so far, in order."""
        groups, scores, ids, nulls = map(np.concatenate, zip(*self.parts))
        order = np.lexsort((ids, nulls, -scores, groups))
        groups, scores, ids, nulls = (x[order] for x in (groups, scores, ids, nulls))
        first = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]][: len(groups)])
        place = np.arange(len(groups)) - np.repeat(first, np.diff(np.r_[first, len(groups)]))
        full = place == self.k - 1
        self.floors[groups[full]] = scores[full]
        self.last[groups[full]] = np.where(nulls[full], self.last[groups[full]], ids[full])
        stay = place < self.k
        self.parts, self.pending = [(groups[stay], scores[stay], ids[stay], nulls[stay])], 0
        return self.parts[0]


def best_rows(found: DataFrame, k: int, *groups: str) -> DataFrame:
    """Of each group the first ``k`` rows by falling score, then vec_id, null last, with their rank; cut before the shuffle."""
    order = Window.partitionBy(*groups).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


@dataclass
class Block:
    """Queries that are answered together; ``first`` is the number of the first one."""

    first: int
    ids: np.ndarray
    vectors: np.ndarray
    other: dict[str, np.ndarray]

    def __len__(self) -> int:
        return len(self.ids)

    def chunks(self, among: np.ndarray | None = None) -> Iterator[np.ndarray]:
        """Places of the queries, or of those ``among`` them, a few at a time."""
        among = np.arange(len(self)) if among is None else among
        for at in range(0, len(among), CHUNK):
            yield among[at : at + CHUNK]


def query_blocks(queries: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The distinct rows of ``queries`` (vec_id, vector, others that are never null) in blocks.

    Rows are dealt to blocks by their hash; as many blocks are made as keep one at ``block_bytes`` on average.
    """
    queries = stage(queries.distinct(), "queries")
    size = queries.agg(F.sum(8 * F.size("vector") + 64)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    dealt = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int")
    queries = stage(queries.withColumn("block", dealt), "blocks", "block")
    first = 0
    for number in range(blocks):
        rows = queries.where(F.col("block") == number).drop("block").toArrow()
        others = [c for c in rows.column_names if c not in ("vec_id", "vector")]
        block = Block(
            first, identities(rows["vec_id"])[0], matrix(rows["vector"]), {c: rows[c].to_numpy() for c in others}
        )
        first += len(block)
        if len(block):
            yield block


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a task a chunk at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            yield batch.slice(at, CHUNK)
