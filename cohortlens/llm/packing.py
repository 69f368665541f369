"""Hierarchical residual packing of token sequences.

Each task packs its own documents best fit, longest first, and emits the sequences that are nearly full. The others go
on as items, with all they hold, to a smaller number of tasks (partitions are merged in a tree), which pack them best
fit again. A task never holds more than ITEMS items, so a corpus whose rest can't be merged any further keeps many
tasks and ends when a round no longer helps.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import stage
from cohortlens.llm.tokens import ID_BYTES, TOKENIZER, cut, encoded

CAPACITY = 2048
SLACK = 8  # tokens that a sequence counted as nearly full may lack
ITEMS = 100_000  # packed together in a task at most
FAN_IN = 8  # tasks whose rest meets in one of the next round
LEAST_GAIN = 0.01  # share of the open sequences that a round must save for another at the same number of tasks


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each item. Bins are looked up by what is left in them: bit r of ``left`` says that some have r."""
    bins = np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    left, opened = 0, 0
    order = np.argsort(-lengths, kind="stable")
    for item, length in zip(order.tolist(), lengths[order].tolist(), strict=True):
        if fitting := left >> length:
            room = length + (fitting & -fitting).bit_length() - 1
            bin_ = by_room[room].pop()
            if not by_room[room]:
                left ^= 1 << room
        else:
            room, bin_ = capacity, opened
            opened += 1
        bins[item] = bin_
        if room > length:
            by_room[room - length].append(bin_)
            left |= 1 << (room - length)
    return bins


def packed(fills: np.ndarray, members: pa.ListArray, capacity: int) -> tuple[np.ndarray, pa.ListArray]:
    """Items (their fill and members, which have an offset) merged into bins: fills and members of the bins."""
    bins = best_fit_decreasing(fills, capacity)
    order = np.argsort(bins, kind="stable")
    fills, bins = fills[order], bins[order]
    ends = np.cumsum(fills)
    first = np.flatnonzero(np.diff(bins, prepend=-1))  # of each bin
    base = ends - fills
    base -= np.repeat(base[first], np.diff(first, append=len(bins)))
    taken = members.take(pa.array(order))
    counts = taken.value_lengths().to_numpy(zero_copy_only=False)
    flat = taken.flatten()
    names = [f.name for f in flat.type]
    columns = dict(zip(names, flat.flatten(), strict=True))
    columns["offset"] = pa.array(columns["offset"].to_numpy() + np.repeat(base, counts), pa.int64())
    values = pa.StructArray.from_arrays([columns[n] for n in names], names)
    starts = np.concatenate(([0], np.cumsum(np.add.reduceat(counts, first)))) if len(first) else np.zeros(1, np.int64)
    return np.add.reduceat(fills, first) if len(first) else fills, pa.ListArray.from_arrays(
        pa.array(starts, pa.int32()), values
    )


def bins_of(
    blocks: Iterator[tuple[np.ndarray, pa.ListArray]], level: int, capacity: int, slack: int
) -> Iterator[pa.RecordBatch]:
    """Rows of sequence_id, fill, members, open. Ids are unique by round, task and place."""
    at = (level << 56) + (TaskContext.get().partitionId() << 32)
    for fills, members in blocks:
        fills, members = packed(fills, members, capacity)
        ids = pa.array(np.arange(at, at + len(fills)), pa.int64())
        at += len(fills)
        columns = [ids, pa.array(fills.astype(np.int32)), members, pa.array(capacity - fills > slack)]
        yield pa.RecordBatch.from_arrays(columns, ["sequence_id", "fill", "members", "open"])


def packed_documents(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, slack: int = SLACK, items: int = ITEMS
) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null text is an empty one and has one id, the end of text. Documents beyond the capacity are cut into pieces of
    it, the last one shorter. Rows that repeat a doc_id are packed like any other. No rows give no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    member = (
        f"struct<doc_id: {kind}, piece: int, start: bigint, length: bigint, ids_crc32: bigint, offset: bigint>"
    )
    schema = f"sequence_id bigint, fill int, members array<{member}>, open boolean"

    def first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_type: list[pa.DataType] = []

        def seen() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                id_type[:] = [batch.schema.field(0).type]
                yield batch

        def blocks() -> Iterator[tuple[np.ndarray, pa.ListArray]]:
            rows: list[tuple] = []
            for doc_id, ids in encoded(seen(), tokenizer):
                rows += [
                    (doc_id, piece, start, len(part) // ID_BYTES, zlib.crc32(part))
                    for piece, start, part in cut(ids, capacity)
                ]
                if len(rows) >= items:
                    yield block(rows)
                    rows = []
            if rows:
                yield block(rows)

        def block(rows: list[tuple]) -> tuple[np.ndarray, pa.ListArray]:
            doc_ids, pieces, starts, lengths, sums = zip(*rows, strict=True)
            values = pa.StructArray.from_arrays(
                [
                    pa.array(doc_ids, id_type[0]),
                    pa.array(pieces, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(sums, pa.int64()),
                    pa.array(np.zeros(len(rows), np.int64)),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "offset"],
            )
            one_each = pa.array(np.arange(len(rows) + 1), pa.int32())
            return np.array(lengths, np.int64), pa.ListArray.from_arrays(one_each, values)

        yield from bins_of(blocks(), 0, capacity, slack)

    source = docs.select("doc_id", F.encode("text", "UTF-8").alias("text"))
    bins = stage(source.mapInArrow(first_round, schema), "bins", "open")
    tasks = source.rdd.getNumPartitions()
    done, level = [bins.where("not open")], 0
    open_bins, left = bins.where("open"), bins.where("open").count()
    while left > 1:
        level += 1
        fewest = -(-left // items)
        again = tasks == fewest
        tasks = max(fewest, -(-tasks // FAN_IN))
        merged = stage(open_bins.coalesce(tasks).mapInArrow(merging(level, capacity, slack, items), schema), "bins", "open")
        done.append(merged.where("not open"))
        before, open_bins, left = left, merged.where("open"), merged.where("open").count()
        if tasks == 1 or again and left > (1 - LEAST_GAIN) * before:
            break
    everything = reduce(DataFrame.unionByName, [*done, open_bins])
    return everything.select("sequence_id", F.inline("members")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def merging(level: int, capacity: int, slack: int, items: int):
    """Best-fit rounds over the open sequences of a merged partition."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks() -> Iterator[tuple[np.ndarray, pa.ListArray]]:
            held: list[pa.RecordBatch] = []
            for batch in batches:
                held.append(batch)
                if sum(map(len, held)) >= items:
                    yield block(held)
                    held = []
            if held:
                yield block(held)

        def block(held: list[pa.RecordBatch]) -> tuple[np.ndarray, pa.ListArray]:
            table = pa.Table.from_batches(held).combine_chunks()
            return table["fill"].to_numpy().astype(np.int64), table["members"].chunk(0)

        yield from bins_of(blocks(), level, capacity, slack)

    return merge
