"""Hard-negative mining by slots of scores.

An anchor's positives each have a window of scores, and windows overlap. Their upper limits cut the scores into disjoint
slots, so a row falls into one slot of an anchor however many windows hold it. Tasks keep the best few rows of each slot,
and so does their merge. A window is its slot and all below it, cut at its lower limit: walking from the lowest slot up,
what a slot keeps is put before what those below it have kept, and the first few of that answer the window.
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

POSITIVES = 5
NEGATIVES = 3
# A negative's score is at least and at most so many hundredths of the positive's.
LOW_PERCENT, HIGH_PERCENT = 50, 95

FOUND = "anchor bigint, anchor_id bigint, slot int, vec_id bigint, score bigint"
MINED = (
    "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
)


def by_label(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, which of them are null, labels and vectors."""
    return *identities(batch.column("vec_id")), batch.column("label").to_numpy(), matrix(batch.column("vector"))


def emitted(block: Block, best: Best, slots: int) -> pa.RecordBatch:
    group, scores, ids, nulls = best.cut()
    anchor, slot = np.divmod(group, slots)
    columns = [
        pa.array(anchor + block.first),
        pa.array(block.ids[anchor]),
        pa.array(slot, pa.int32()),
        pa.array(ids, mask=nulls),
        pa.array(scores),
    ]
    return pa.RecordBatch.from_arrays(columns, ["anchor", "anchor_id", "slot", "vec_id", "score"])


def positives(rows: DataFrame, anchors: Block, k: int) -> DataFrame:
    """(anchor, anchor_id, rank, vec_id, score): the best rows of each anchor's label, without those of its own id."""
    sent = rows.sparkSession.sparkContext.broadcast(anchors)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        best = Best(len(block), k)
        of_label = {label: np.flatnonzero(block.other["label"] == label) for label in np.unique(block.other["label"])}
        for batch in rows_of(batches):
            ids, nulls, labels, vectors = by_label(batch)
            for label in np.unique(labels):
                mine = labels == label
                for chunk in block.chunks(of_label.get(label, np.zeros(0, int))):
                    scores = products(block.vectors[chunk], vectors[mine])
                    other = (ids[mine] != block.ids[chunk][:, None]) | nulls[mine]
                    anchor, row = np.nonzero((scores >= best.floors[chunk][:, None]) & other)
                    best.add(chunk[anchor], scores[anchor, row], ids[mine][row], nulls[mine][row])
        yield emitted(block, best, 1)

    found = stage(rows.mapInArrow(work, FOUND), "positives-found")
    sent.unpersist()
    return stage(best_rows(found, k, "anchor"), "positives")


def limits(anchors: Block, found: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each anchor the distinct upper limits of its positives, falling, and the least lower limit.

    Anchors with fewer limits have impossible ones at the end; one without positives has no window at all.
    """
    least, most = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    uppers, lower = np.full((len(anchors), k), least), np.full(len(anchors), most)
    anchor, score = found["anchor"].to_numpy() - anchors.first, found["score"].to_numpy()
    upper = HIGH_PERCENT * score // 100
    anchor_upper = np.unique(np.stack((anchor, -upper), axis=1), axis=0) if len(anchor) else np.zeros((0, 2), np.int64)
    of, falling = anchor_upper[:, 0], -anchor_upper[:, 1]
    first = np.searchsorted(of, of)
    uppers[of, np.arange(len(of)) - first] = falling
    np.minimum.at(lower, anchor, -(-LOW_PERCENT * score // 100))
    return uppers, lower


def slots(rows: DataFrame, anchors: Block, uppers: np.ndarray, lower: np.ndarray, k: int) -> DataFrame:
    """(anchor, anchor_id, slot, rank, vec_id, score): the best rows of other labels in each slot, by falling limits."""
    sent = rows.sparkSession.sparkContext.broadcast((anchors, uppers, lower))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, uppers, lower = sent.value
        cuts = uppers.shape[1]
        best = Best(len(block) * cuts, k)
        for batch in rows_of(batches):
            ids, nulls, labels, vectors = by_label(batch)
            for chunk in block.chunks():
                scores = products(block.vectors[chunk], vectors)
                inside = (scores <= uppers[chunk, :1]) & (scores >= lower[chunk][:, None])
                anchor, row = np.nonzero(inside & (labels != block.other["label"][chunk][:, None]))
                score, anchor_at = scores[anchor, row], chunk[anchor]
                group = anchor_at * cuts + (score[:, None] <= uppers[anchor_at]).sum(axis=1) - 1
                enough = score >= best.floors[group]
                best.add(group[enough], score[enough], ids[row][enough], nulls[row][enough])
        yield emitted(block, best, cuts)

    found = stage(rows.mapInArrow(work, FOUND), "slots-found")
    sent.unpersist()
    return best_rows(found, k, "anchor", "anchor_id", "slot")


def windows(found: DataFrame, kept: DataFrame, k: int) -> DataFrame:
    """Answers all windows of an anchor from what its slots keep: a row for each anchor, with both as short lists."""

    def listed(rows: DataFrame, *columns: str) -> DataFrame:
        return rows.groupBy("anchor", "anchor_id").agg(F.collect_list(F.struct(*columns)).alias("rows"))

    anchors = listed(found, "rank", "vec_id", "score").join(
        listed(kept, "slot", "rank", "vec_id", "score").select("anchor", F.col("rows").alias("kept")), "anchor"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mined = []
            for anchor in batch.to_pylist():
                by_slot: dict[int, list[dict]] = {}
                for row in sorted(anchor["kept"], key=lambda r: r["rank"]):
                    by_slot.setdefault(row["slot"], []).append(row)
                by_limit: dict[int, list[dict]] = {}
                for positive in anchor["rows"]:
                    by_limit.setdefault(HIGH_PERCENT * positive["score"] // 100, []).append(positive)
                suffix: list[dict] = []
                for slot, limit in reversed(list(enumerate(sorted(by_limit, reverse=True)))):
                    suffix = (by_slot.get(slot, []) + suffix)[:k]
                    for positive in by_limit[limit]:
                        inside = [n for n in suffix if 100 * n["score"] >= LOW_PERCENT * positive["score"]]
                        mined += [
                            (anchor["anchor_id"], positive["vec_id"], rank, n["vec_id"], positive["score"], n["score"])
                            for rank, n in enumerate(inside, 1)
                        ]
            columns = list(zip(*mined)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    names = [column.split()[0] for column in MINED.split(", ")]
    return anchors.mapInArrow(work, MINED)


def hard_negatives(
    table: DataFrame,
    is_anchor: Column | str,
    label: Column | str = "label",
    positives_wanted: int = POSITIVES,
    negatives_wanted: int = NEGATIVES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Rows of anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Scores are inner products of whole-numbered vectors; higher ones come first, ties by smaller vec_id, null last. The
    positives of a row that ``is_anchor`` names are the first rows of its label; the negatives of a positive are the
    first rows of other labels whose score is at least LOW_PERCENT and at most HIGH_PERCENT of its own. There are fewer
    where there are no more; a positive of score zero takes scores of zero, one below zero has no window.

    Rows with a null label, a null vector or a null or non-finite component take no part. Shorter vectors count as
    filled up with zeros. Rows with the anchor's own vec_id are not its positives; one of another label can be its
    negative. Rows that repeat an id, or all, are rows of their own; as anchors, rows equal in id, vector and label are
    one. A null vec_id is no anchor. No rows give none. Scores that may reach 2**56 are an error.
    """
    spark = table.sparkSession
    rows = table.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        (F.col(label) if isinstance(label, str) else label).cast("bigint").alias("label"),
        F.when(usable(), whole_numbers()).alias("vector"),
    ).where("label is not null and vector is not null")
    rows = stage(rows, "labelled")
    parts = []
    for anchors in query_blocks(rows.where(is_anchor), block_bytes):
        found = positives(rows, anchors, positives_wanted)
        uppers, lower = limits(anchors, found.select("anchor", "score").toArrow(), positives_wanted)
        parts.append(windows(found, slots(rows, anchors, uppers, lower, negatives_wanted), negatives_wanted))
    if not parts:
        return spark.createDataFrame([], MINED)
    mined = parts[0]
    for part in parts[1:]:
        mined = mined.unionByName(part)
    return mined
