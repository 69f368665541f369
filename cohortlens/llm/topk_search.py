"""Exact search for the highest inner products, with vectors in buckets of like length.

Rows are range-sorted by falling length and read in buckets. A query that needs a product of at least ``t`` needs, in a
bucket whose longest vector has length ``l``, a cosine of at least ``t / (|q| l)``. Above one the bucket is left out. Else
the query takes, for this bucket, the better of two ways to leave out rows: by length (only rows of at least ``t / |q|``)
or by coordinate (a cosine of ``c`` confines each coordinate of a normalised row to an interval about the query's; rows are
found in a sorted list of the query's greatest coordinate and tried on the next ones). What is left is multiplied.

A query's first bound is its k-th best product with the longest rows of all; it rises as a task finds better rows. Bounds
only leave out rows that are below k others, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import stage
from cohortlens.llm.vectors import (
    BLOCK_BYTES,
    CHUNK,
    Best,
    Block,
    best_rows,
    identities,
    matrix,
    products,
    query_blocks,
    rows_of,
    usable,
    whole_numbers,
)

TOP = 5
SEEDS = 2048  # longest rows that give queries their first bounds
FOCUS = 3  # coordinates on which a row is tried
SLACK = 1e-9  # bounds are taken wider by this share, since lengths are rounded
PAIR_COST = 8  # a row that is multiplied alone costs as much as so many in a matrix


class Bucket:
    """Some rows, longest first."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        vectors = matrix(batch.column("vector"))
        ids, nulls = identities(batch.column("vec_id"))
        lengths = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
        order = np.argsort(-lengths, kind="stable")
        self.ids, self.nulls, self.vectors, self.lengths = ids[order], nulls[order], vectors[order], lengths[order]
        self.units = self.vectors / np.maximum(self.lengths, 1)[:, None]  # a whole vector is zero or at least 1 long
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __len__(self) -> int:
        return len(self.ids)

    def longer(self, least: np.ndarray) -> np.ndarray:
        """For each of ``least`` how many rows are at least that long; these come first."""
        return np.searchsorted(-self.lengths, -least, side="right")

    def listed(self, coordinate: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows by one coordinate, and its values."""
        if coordinate not in self.lists:
            order = np.argsort(self.units[:, coordinate], kind="stable")
            self.lists[coordinate] = order, self.units[order, coordinate]
        return self.lists[coordinate]


class Search:
    """The queries of a block against one bucket after the other."""

    def __init__(self, block: Block, k: int) -> None:
        self.block, self.best = block, Best(len(block), k)
        if "bound" in block.other:
            self.best.floors = np.maximum(self.best.floors, block.other["bound"])
        self.lengths = np.sqrt((block.vectors.astype(float) ** 2).sum(axis=1))
        self.units = block.vectors / np.maximum(self.lengths, 1)[:, None]
        self.focus = np.argsort(-np.abs(self.units), axis=1, kind="stable")[:, :FOCUS]
        self.products = 0  # of a query and a row that were worked out

    def intervals(self, places: np.ndarray, cosines: np.ndarray, nth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nth focus coordinate of queries, and the least and greatest value of rows with at least these cosines."""
        coordinate = self.focus[places, nth]
        own = np.arccos(np.clip(self.units[places, coordinate], -1, 1))
        apart = np.arccos(np.clip(cosines, -1, 1))
        return coordinate, np.cos(np.minimum(np.pi, own + apart)) - SLACK, np.cos(np.maximum(0, own - apart)) + SLACK

    def read(self, bucket: Bucket) -> None:
        floors = self.best.floors
        reach = self.lengths * bucket.lengths[0]  # the greatest product there can be
        places = np.flatnonzero(floors <= reach * (1 + SLACK))
        # without a positive bound every row may count
        bounded = (floors[places] > 0) & (self.lengths[places] > 0)
        open_ended, places = places[~bounded], places[bounded]
        self.by_length(bucket, open_ended, np.full(len(open_ended), len(bucket)))

        least = floors[places] / self.lengths[places] * (1 - SLACK)
        prefix, cosines = bucket.longer(least), np.minimum(least / bucket.lengths[0], 1)
        width = bucket.units.shape[1]
        narrow, first, last = np.zeros(len(places), bool), np.zeros(len(places), int), np.zeros(len(places), int)
        if self.focus.shape[1]:
            coordinates, low, high = self.intervals(places, cosines, 0)
            for coordinate in np.unique(coordinates[coordinates < width]):
                of = np.flatnonzero(coordinates == coordinate)
                values = bucket.listed(coordinate)[1]
                first[of], last[of] = np.searchsorted(values, low[of]), np.searchsorted(values, high[of], "right")
                narrow[of] = PAIR_COST * (last[of] - first[of]) < prefix[of]
        self.by_length(bucket, places[~narrow], prefix[~narrow])
        self.by_coordinate(bucket, places[narrow], cosines[narrow], first[narrow], last[narrow])

    def by_length(self, bucket: Bucket, places: np.ndarray, prefix: np.ndarray) -> None:
        order = np.argsort(-prefix, kind="stable")
        places, prefix = places[order], prefix[order]
        at = 0
        for chunk in self.block.chunks(places):
            rows = prefix[at]
            scores = products(self.block.vectors[chunk], bucket.vectors[:rows])
            self.products += scores.size
            query, row = np.nonzero(scores >= self.best.floors[chunk][:, None])
            self.offer(bucket, chunk[query], row, scores[query, row])
            at += len(chunk)

    def by_coordinate(self, bucket: Bucket, places: np.ndarray, cosines: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        for chunk in self.block.chunks(np.arange(len(places))):
            counts = last[chunk] - first[chunk]
            pair = np.repeat(chunk, counts)
            place = np.repeat(first[chunk] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            row = np.empty(len(pair), int)
            main = self.focus[places[pair], 0]
            for coordinate in np.unique(main):
                of = main == coordinate
                row[of] = bucket.listed(coordinate)[0][place[of]]
            for nth in range(1, self.focus.shape[1]):
                coordinate, low, high = self.intervals(places[pair], cosines[pair], nth)
                known = coordinate < bucket.units.shape[1]
                value = np.where(known, bucket.units[row, np.where(known, coordinate, 0)], 0)
                inside = (value >= low) & (value <= high)
                pair, row = pair[inside], row[inside]
            for at in range(0, len(pair), CHUNK * CHUNK):
                query, of = places[pair[at : at + CHUNK * CHUNK]], row[at : at + CHUNK * CHUNK]
                width = min(self.block.vectors.shape[1], bucket.vectors.shape[1])
                scores = (self.block.vectors[query, :width] * bucket.vectors[of, :width]).sum(axis=1)
                self.products += len(of)
                enough = scores >= self.best.floors[query]
                self.offer(bucket, query[enough], of[enough], scores[enough])

    def offer(self, bucket: Bucket, query: np.ndarray, row: np.ndarray, scores: np.ndarray) -> None:
        other = (bucket.ids[row] != self.block.ids[query]) | bucket.nulls[row]
        query, row, scores = query[other], row[other], scores[other]
        self.best.add(query, scores, bucket.ids[row], bucket.nulls[row])


def by_falling_length(rows: DataFrame) -> DataFrame:
    """``rows`` (vec_id, vector) range-sorted by length; equal lengths, and rows repeated very often, are dealt on."""
    length = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    ranked = rows.withColumns({"length": length, "at": F.monotonically_increasing_id()})
    order = [F.desc("length"), F.asc("vec_id"), F.asc("at")]
    return ranked.repartitionByRange(*order).sortWithinPartitions(*order).select("vec_id", "vector")


def with_bounds(queries: DataFrame, rows: DataFrame, k: int, seeds: int) -> DataFrame:
    """``queries`` and bound, the score of the k-th best of the ``seeds`` longest rows; the least long without k."""
    length = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    longest = rows.orderBy(F.desc(length), F.asc_nulls_last("vec_id")).limit(seeds).toArrow()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not longest.num_rows:
            return
        bucket = Bucket(longest.combine_chunks().to_batches()[0])
        for batch in rows_of(batches):
            block = Block(0, identities(batch.column("vec_id"))[0], matrix(batch.column("vector")), {})
            search = Search(block, k)
            search.read(bucket)
            search.best.cut()
            yield batch.append_column("bound", pa.array(search.best.floors))

    return queries.mapInArrow(work, "vec_id bigint, vector array<bigint>, bound bigint")


def top_products(
    table: DataFrame,
    is_query: Column | str,
    k: int = TOP,
    block_bytes: int = BLOCK_BYTES,
    seeds: int = SEEDS,
) -> DataFrame:
    """Rows of query_id, rank (from 1), vec_id, score: for each row of ``table`` (vec_id, embedding, others) that
    ``is_query`` names, the k rows with the highest inner products of whole-numbered vectors, ties to the smaller vec_id.

    Vectors that are null or hold a null or non-finite component take no part. Shorter vectors count as filled up with
    zeros. Rows with the query's own vec_id are never among its results. Rows that repeat an id, or an id and a vector,
    are rows of their own for other queries; as queries, rows equal in both are one, and rows that share only the id
    are answered each. A null vec_id is no query, and comes last among ties. Fewer than k other rows give all of them,
    no rows none. Scores that may reach 2**56 are an error.
    """
    spark = table.sparkSession
    rows = table.where(usable()).select(F.col("vec_id").cast("bigint").alias("vec_id"), whole_numbers().alias("vector"))
    rows = stage(by_falling_length(rows), "by-length")
    queries = with_bounds(rows.where(is_query), rows, k, seeds)
    parts = [search_block(rows, block, k) for block in query_blocks(queries, block_bytes)]
    if not parts:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return best_rows(found, k, "query_id", "query").select("query_id", "rank", "vec_id", "score")


def search_block(rows: DataFrame, block: Block, k: int) -> DataFrame:
    """Of each task the rows that may be among the best of a query, written to the shared folder."""
    sent = rows.sparkSession.sparkContext.broadcast(block)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(sent.value, k)
        for batch in rows_of(batches):
            search.read(Bucket(batch))
        query, scores, ids, nulls = search.best.cut()
        columns = [
            pa.array(query + search.block.first),
            pa.array(search.block.ids[query]),
            pa.array(ids, mask=nulls),
            pa.array(scores),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["query", "query_id", "vec_id", "score"])

    found = stage(rows.mapInArrow(work, "query bigint, query_id bigint, vec_id bigint, score bigint"), "found")
    sent.unpersist()
    return found
