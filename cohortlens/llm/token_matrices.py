"""Packed token-id matrices for training: best fit, longest first, with a segment tree over what bins have left."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from cohortlens.llm.tokens import ID_BYTES, TOKENIZER, cut, encoded

CAPACITY = 2048
MATRIX_ROWS = 256
SHARD_TOKENS = 8_000_000  # packed together in a task at most
PAD = 0


class Rooms:
    """Bins by the room they have left: a segment tree over rooms 0..capacity whose nodes count the bins below."""

    def __init__(self, capacity: int) -> None:
        self.width = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.width)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, bin_: int) -> None:
        self.bins[room].append(bin_)
        self._change(room, 1)

    def take(self, needed: int) -> tuple[int, int] | None:
        """(room, bin) of a bin with the least room that suffices."""
        node = needed + self.width
        while not self.count[node]:  # up to the first subtree on the right that has a bin
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.width:  # down to its leftmost
            node <<= 1
            node += not self.count[node]
        room = node - self.width
        self._change(room, -1)
        return room, self.bins[room].pop()

    def _change(self, room: int, by: int) -> None:
        node = room + self.width
        while node:
            self.count[node] += by
            node >>= 1


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """The items of each bin."""
    rooms, bins = Rooms(capacity), []
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = rooms.take(lengths[item])
        if found:
            room, bin_ = found
        else:
            room, bin_ = capacity, len(bins)
            bins.append([])
        bins[bin_].append(item)
        if room > lengths[item]:
            rooms.add(room - lengths[item], bin_)
    return bins


def token_matrices(
    docs: DataFrame,
    capacity: int = CAPACITY,
    matrix_rows: int = MATRIX_ROWS,
    tokenizer: str = TOKENIZER,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """A row per matrix of at most ``matrix_rows`` sequences of ``capacity`` ids, ready to be written.

    ids and positions are n_sequences x capacity matrices of little-endian unsigned 16-bit numbers (32-bit ids for a
    tokenizer that needs them: id_bytes says which); PAD fills up a sequence, and positions start at zero in each
    segment. For each sequence cu_seqlens has the cumulative lengths of its segments, from 0, and segments says whose
    they are (doc_id, start, length). A document is one segment with an end of text; those beyond the capacity are cut
    into several, of which nothing is lost. Null texts are empty ones; rows that repeat a doc_id are packed like any
    other; no rows give no matrices. Packing needs no shuffle: tasks pack what they read, up to ``shard_tokens`` at a
    time, and only the last few sequences of each time are not full.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        "matrix_id bigint, n_sequences int, capacity int, id_bytes int, ids binary, positions binary, "
        f"cu_seqlens array<array<int>>, segments array<array<struct<doc_id: {kind}, start: bigint, length: int>>>"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix_id = TaskContext.get().partitionId() << 32
        for pieces in shards(encoded(batches, tokenizer)):
            bins = best_fit_decreasing([len(part) // ID_BYTES for _, _, part in pieces], capacity)
            for at in range(0, len(bins), matrix_rows):
                sequences = [[pieces[i] for i in items] for items in bins[at : at + matrix_rows]]
                yield matrix(matrix_id, sequences)
                matrix_id += 1

    def shards(documents: Iterator[tuple[object, bytes]]) -> Iterator[list[tuple]]:
        pieces, held = [], 0
        for doc_id, ids in documents:
            pieces += [(doc_id, start, part) for _, start, part in cut(ids, capacity)]
            held += len(ids)
            if held >= shard_tokens * ID_BYTES:
                yield pieces
                pieces, held = [], 0
        if pieces:
            yield pieces

    def matrix(matrix_id: int, sequences: list[list[tuple]]) -> pa.RecordBatch:
        ids = np.full((len(sequences), capacity), PAD, "<u4")
        positions = np.zeros((len(sequences), capacity), "<u2" if capacity <= 1 << 16 else "<u4")
        ends, segments = [], []
        for row, sequence in enumerate(sequences):
            lengths = [len(part) // ID_BYTES for _, _, part in sequence]
            ends.append([0, *np.cumsum(lengths).tolist()])
            ids[row, : ends[-1][-1]] = np.frombuffer(b"".join(part for _, _, part in sequence), "<u4")
            for begin, length in zip(ends[-1], lengths):
                positions[row, begin : begin + length] = np.arange(length)
            segments.append(
                [
                    {"doc_id": doc_id, "start": start, "length": length}
                    for (doc_id, start, _), length in zip(sequence, lengths)
                ]
            )
        small = ids.max() < 1 << 16
        values = {
            "matrix_id": matrix_id,
            "n_sequences": len(sequences),
            "capacity": capacity,
            "id_bytes": 2 if small else 4,
            "ids": ids.astype("<u2" if small else "<u4").tobytes(),
            "positions": positions.tobytes(),
            "cu_seqlens": ends,
            "segments": segments,
        }
        return pa.RecordBatch.from_pylist([values], schema=out)

    out = to_arrow_schema(StructType.fromDDL(schema))
    return docs.select("doc_id", F.encode("text", "UTF-8").alias("text")).mapInArrow(work, schema)


def write_matrices(docs: DataFrame, folder: str, **options) -> None:
    """Write the matrices as parquet files, one or more for each task."""
    token_matrices(docs, **options).write.parquet(folder)
