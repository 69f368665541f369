"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``radius`` bits have a variant in common that differs from each in at most
half of them. Every distinct fingerprint therefore emits its ball of half the radius (65 variants for radius 2), and
fingerprints meet on variants. A variant has at most as many fingerprints as a ball has members, however large the
groups of copies are, and all of them are within the radius of each other: links to the least one keep every
component whole without listing all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from cohortlens.llm.common import keep_rows, stage, text_key, whole_text
from cohortlens.llm.components import components

RADIUS = 2
SHINGLE_WORDS = 3
SEED = 42
BLOCK = 1 << 16  # hashes turned into bits at once


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """64 majority bits over the hashes of all shingles of a UTF-8 text; zero without a word."""
    words = text.lower().split()  # on bytes: A-Z only, and exactly the six ASCII spaces
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(len(words) - shingle_words, 0)
    starts, ends = starts[: last + 1].tolist(), ends[-(last + 1) :].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, last + 1, BLOCK):
        hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[at : at + BLOCK], ends[at : at + BLOCK])]
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > last + 1, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Per row: doc_id, text_key, fp (the fingerprint as a signed long)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(text.as_buffer().to_pybytes(), shingle_words) for text in batch.column("text")]
            signed = pa.array(np.array(fps, "<u8").view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), signed], ["doc_id", "text_key", "fp"]
            )

    source = docs.select(
        "doc_id", text_key().alias("text_key"), F.encode(whole_text(), "UTF-8").alias("text")
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(work, f"doc_id {kind}, text_key bigint, fp bigint")


def ball(bits: int) -> list[int]:
    """Masks of at most ``bits`` set bits, as signed longs."""
    masks = [sum(1 << i for i in c) for n in range(bits + 1) for c in combinations(range(64), n)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): verified links between distinct fingerprints ``fp``, enough to connect all that are within ``radius``."""
    if radius % 2:
        raise ValueError("the radius must be even: fingerprints that share a variant are then all within it")
    masks = F.array(*[F.lit(m).cast("bigint") for m in ball(radius // 2)])
    met = (
        fps.select("fp", F.explode(masks).alias("mask"))
        .select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
        .select("fp", F.min("fp").over(Window.partitionBy("variant")).alias("least"))
        .where("fp <> least")
        .distinct()
    )
    return met.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("least"))) <= radius).select(
        F.col("fp").alias("a"), F.col("least").alias("b")
    )


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """A row for each row of docs: doc_id, text_key, fp, component_id (the least doc_id of its component), root.

    Texts without a word share fingerprint zero and are linked like any other. Null ids are no one's component_id
    unless a component has no other. No rows give no rows.
    """
    rows = stage(fingerprints(docs, shingle_words), "fingerprints")
    groups = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct")
    roots = components(links(groups, radius))
    rooted = groups.join(roots, groups["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least_id"
    )
    rooted = stage(rooted, "rooted")
    ids = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    labels = stage(rooted.join(ids, "root").select("fp", "component_id", "root"), "labels")
    return rows.join(labels, "fp").select("doc_id", "text_key", "fp", "component_id", "root")


def drop_near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Of each component the row with the least doc_id (null last), then the least text_key; columns as given."""
    marks = near_duplicates(docs, radius, shingle_words)
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("doc_id"), F.col("text_key").alias("key")))
    leaders = stage(
        marks.groupBy("root").agg(first.alias("first")).select("root", "first.doc_id", "first.key"), "leaders"
    ).withColumnRenamed("doc_id", "lead_id")
    leads = F.col("doc_id").eqNullSafe(F.col("lead_id")) & (F.col("text_key") == F.col("key"))
    return keep_rows(docs, marks.join(leaders, "root").select("doc_id", "text_key", leads.alias("kept")))
