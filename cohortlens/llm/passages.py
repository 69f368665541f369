"""Repeated passages: lines are normalised and hashed, and the earliest occurrence of each is kept.

A whole line that an earlier one equals is removed, whatever its length. Lines are also cut at sentence ends, which finds
passages that start or end within a line: a piece is removed when an earlier piece equals it and the run of such pieces
that it stands in has at least ``min_words`` words. Single short sentences inside a line are style, not copies. Removals
are spans of the original text.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from cohortlens.llm.common import SPACE_CLASS, WORD_CLASS, same, text_key, whole_text

MIN_WORDS = 25
BLOCK = 100_000  # units compared with each other before they are shuffled, and sent to Spark at once
COMMON = 4096  # units repeated within a block that a task remembers for its later blocks
PIECE, LINE = 1, 2  # bits of what a unit is: a piece of a line, a whole line, or both
LINES = re.compile(r"[^\n]+")
WORD = re.compile(WORD_CLASS + "+")
BORDER_EVERY = 4  # words from one border of windows to the next, on average
# Up to a mark that ends a sentence before white space, or else to the end of the line.
UNIT = re.compile(rf"[^\n]*?[.!?](?={SPACE_CLASS})|[^\n]+")


def units_of(text: str) -> Iterator[tuple[int, int, int, int, bytes, int]]:
    """Of each piece with a word: its number, start, end (code points, end exclusive), words, digest of the words with
    A-Z in lower case, and PIECE. A line of one such piece is the same unit, PIECE | LINE; one of more is a unit of its
    own after them, LINE, with the number of its first piece."""
    unit = 0
    for line in LINES.finditer(text):
        pieces = []
        for found in UNIT.finditer(text, *line.span()):
            if words := found[0].encode().lower().split():  # on bytes: A-Z, and exactly the six ASCII spaces
                pieces.append((*found.span(), words))
        for at, (start, end, words) in enumerate(pieces):
            yield unit + at, start, end, len(words), digest_of(words), PIECE | LINE if len(pieces) == 1 else PIECE
        if len(pieces) > 1:
            words = [word for *_, some in pieces for word in some]
            yield unit, pieces[0][0], pieces[-1][1], len(words), digest_of(words), LINE
        unit += len(pieces)


def digest_of(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


class Marks:
    """Marks units that repeat one which ranks before them, among those of a block and the common ones of a task."""

    def __init__(self) -> None:
        self.common: dict[tuple, tuple] = {}

    def read(self, rows: list[tuple]) -> list[bool]:
        """For rows of (doc_id, text_key, unit, start, end, words, digest, kind) whether each is repeated in all it is."""
        places = [(row[0] is None, row[0], row[1], row[2]) for row in rows]
        first, counts = dict(self.common), Counter()
        for place, row in zip(places, rows, strict=True):
            for bit in (PIECE, LINE):
                if row[7] & bit:
                    key = row[6], bit
                    counts[key] += 1
                    if key not in first or place < first[key]:
                        first[key] = place
        for key, count in counts.most_common(COMMON):
            if key in self.common or count > 1 and len(self.common) < COMMON:
                self.common[key] = first[key]
        return [
            all(place != first[row[6], bit] for bit in (PIECE, LINE) if row[7] & bit)
            for place, row in zip(places, rows, strict=True)
        ]


def units(docs: DataFrame) -> DataFrame:
    """A row per unit: doc_id, text_key, unit, start, end, words, high and low (halves of the digest), kind, repeated.

    Units known to repeat one that ranks before them are marked ``repeated`` here and get a digest of their own: however
    often a line occurs, the shuffle has it once for each block at most, and for few blocks of a task.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "text_key", "unit", "start", "end", "words", "high", "low", "kind", "repeated"]
    schema = (
        f"doc_id {kind}, text_key bigint, unit int, start int, `end` int, words int, high bigint, low bigint, "
        "kind tinyint, repeated boolean"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, rows = Marks(), []
        id_type = pa.null()
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for doc_id, key, text in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "text_key", "text"))):
                rows += [(doc_id, key, *unit) for unit in units_of(text)]
                if len(rows) >= BLOCK:
                    yield record(rows, marks.read(rows), id_type)
                    rows = []
        if rows:
            yield record(rows, marks.read(rows), id_type)

    def record(rows: list[tuple], repeated: list[bool], id_type: pa.DataType) -> pa.RecordBatch:
        doc_ids, keys, numbers, starts, ends, words, digests, kinds = zip(*rows, strict=True)
        halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2).copy()
        for at in np.flatnonzero(repeated):
            halves[at] = xxh64_intdigest(f"{doc_ids[at]}:{numbers[at]}:{kinds[at]}") >> 1, keys[at]
        int32 = [pa.array(column, pa.int32()) for column in (numbers, starts, ends, words)]
        return pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, id_type), pa.array(keys, pa.int64()), *int32, pa.array(halves[:, 0]), pa.array(halves[:, 1]),
             pa.array(kinds, pa.int8()), pa.array(repeated, pa.bool_())],
            names,
        )

    source = docs.select("doc_id", text_key().alias("text_key"), whole_text().alias("text"))
    return source.mapInArrow(work, schema)


def spans_of(repeats: list[tuple[int, int, int, int, int]], min_words: int) -> tuple[int, int, list[tuple[int, int]]]:
    """Pieces removed in runs, lines removed on their own, and all spans, from a document's repeated (unit, start, end,
    words, kind)."""
    spans, n_removed, n_lines = [], 0, 0
    runs: list[list[tuple[int, int, int, int, int]]] = []
    for piece in sorted(r for r in set(repeats) if r[4] & PIECE):
        if not runs or piece[0] != runs[-1][-1][0] + 1:
            runs.append([])
        runs[-1].append(piece)
    gone = set()
    for run in runs:
        if sum(piece[3] for piece in run) >= min_words:
            spans.append((run[0][1], run[-1][2]))
            n_removed += len(run)
            gone |= {piece[0] for piece in run}
    # the pieces of a repeated line are repeated too, so a run holds all of a line or nothing
    for unit, start, end, *_ in sorted(r for r in set(repeats) if r[4] & LINE):
        if unit not in gone:
            spans.append((start, end))
            n_lines += 1
    return n_removed, n_lines, sorted(spans)


def removed_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """A row per document that loses something: doc_id, text_key, n_removed (pieces in runs), n_lines (lines outside
    them), removed (array of start, end in order).

    Occurrences are ranked by doc_id (null last), text_key and unit. Rows that repeat both are one document.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "unit")
    of_digest = Window.partitionBy("high", "low")

    def again(bit: int) -> F.Column:
        """The bit, of units that are of its kind and rank after another one."""
        is_kind = F.col("kind").bitwiseAND(bit) > 0
        later = F.col("repeated") | (F.col("place") > F.min(F.when(is_kind, F.col("place"))).over(of_digest))
        return F.when(is_kind & later, bit).otherwise(0)

    repeats = (
        units(docs)
        .withColumn("place", place)
        .withColumn("again", again(PIECE) + again(LINE))
        .where("again > 0")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_list(F.struct("unit", "start", "end", "words", "again")).alias("repeats"))
    )
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [spans_of([tuple(r.values()) for r in rows], min_words) for rows in batch.column("repeats").to_pylist()]
            removed = [[{"start": start, "end": end} for start, end in spans] for _, _, spans in found]
            columns = [pa.array([f[at] for f in found], pa.int64()) for at in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), *columns, pa.array(removed, span_type)],
                ["doc_id", "text_key", "n_removed", "n_lines", "removed"],
            )

    return repeats.mapInArrow(
        work,
        f"doc_id {kind}, text_key bigint, n_removed bigint, n_lines bigint, "
        "removed array<struct<start: bigint, `end`: bigint>>",
    ).where(F.size("removed") > 0)


def drop_repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """A row for each row of docs: doc_id, n_removed (pieces of lines, in repeated passages of ``min_words`` words or
    more), n_lines (shorter repeated lines), removed, kept (spans of the original text), text (what is kept, in order;
    line breaks between lines stay).

    A null text is an empty one and loses nothing. No rows give no rows. Spans grow with the documents, so they are
    never broadcast: both sides are shuffled at every size.
    """
    return without(docs, removed_spans(docs, min_words))


def without(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` less ``spans`` (doc_id, text_key, n_removed, n_lines, removed)."""
    spans = spans.select(F.col("doc_id").alias("of"), F.col("text_key").alias("of_text"), "n_removed", "n_lines", "removed")
    texts = docs.select("doc_id", whole_text().alias("text"), text_key().alias("key"))
    on = same(F.col("doc_id"), F.col("of")) & (F.col("key") == F.col("of_text"))
    joined = texts.join(spans.hint("merge"), on, "left")
    removed = F.coalesce("removed", F.array().cast("array<struct<start: bigint, end: bigint>>"))
    starts = F.concat(F.array(F.lit(0).cast("bigint")), F.transform("removed", lambda s: s["end"]))
    ends = F.concat(F.transform("removed", lambda s: s["start"]), F.array(F.length("text").cast("bigint")))
    kept = F.filter(F.arrays_zip(starts.alias("start"), ends.alias("end")), lambda s: s["start"] < s["end"])
    pieces = F.transform(
        "kept", lambda s: F.substring("text", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
    )
    counts = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("n_removed", "n_lines")]
    return (
        joined.select("doc_id", "text", *counts, removed.alias("removed"))
        .select("*", kept.alias("kept"))
        .select("doc_id", "n_removed", "n_lines", "removed", "kept", F.array_join(pieces, "").alias("text"))
    )


def windows_of(text: str) -> Iterator[tuple[int, int, bytes]]:
    """(start, end, digest) from each border to the first border that is MIN_WORDS or more words later.

    A border is after two words whose hash falls in a fixed residue, so windows depend on nothing but their own words
    and the two before: a passage has the same ones wherever it starts.
    """
    data = [(m.start(), m.end(), m[0].encode().lower()) for m in WORD.finditer(text)]
    borders = [
        at + 2
        for at in range(len(data) - 1)
        if not xxh64_intdigest(data[at][2] + b" " + data[at + 1][2]) % BORDER_EVERY
    ]
    last = 0
    for border in borders:
        while last < len(borders) and borders[last] < border + MIN_WORDS:
            last += 1
        if last == len(borders):
            return
        words = [w for _, _, w in data[border : borders[last]]]
        digest = hashlib.blake2b(b" ".join(words), digest_size=16, person=b"window").digest()
        yield data[border][0], data[borders[last] - 1][1], digest


def occurrences(docs: DataFrame) -> DataFrame:
    """A row per window: doc_id, text_key, start, end, digest."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "text_key", "start", "end", "digest"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            types = [batch.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            rows: list[tuple] = []
            for doc_id, key, text in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "text_key", "text"))):
                rows += [(doc_id, key, *found) for found in windows_of(text)]
                if len(rows) >= BLOCK:
                    yield record(rows, types)
                    rows = []
            if rows:
                yield record(rows, types)

    def record(rows: list[tuple], types: list[pa.DataType]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    source = docs.select("doc_id", text_key().alias("text_key"), whole_text().alias("text"))
    return source.mapInArrow(work, f"doc_id {kind}, text_key bigint, start bigint, `end` bigint, digest binary")


def all_removed_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``removed_spans`` and all but the earliest of each window; n_removed counts the merged spans, n_lines is 0.

    An occurrence that overlaps the earliest in the same text stays with it.
    """
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "start", "end")
    found = occurrences(docs).withColumn("place", place)
    first = found.groupBy("digest").agg(F.min("place").alias("first"))
    in_first = (
        same(F.col("doc_id"), F.col("first.doc_id"))
        & (F.col("text_key") == F.col("first.text_key"))
        & (F.col("start") < F.col("first.end"))
    )
    again = found.join(first, "digest").where(~in_first).select("doc_id", "text_key", "start", "end")
    runs = removed_spans(docs, min_words).select("doc_id", "text_key", F.inline("removed"))
    document = Window.partitionBy("doc_id", "text_key").orderBy("start", "end")
    before = document.rowsBetween(Window.unboundedPreceding, -1)
    return (
        again.unionByName(runs)
        .distinct()
        .withColumn("new", F.coalesce(F.col("start") > F.max("end").over(before), F.lit(True)))
        .withColumn("island", F.sum(F.col("new").cast("int")).over(document.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("doc_id", "text_key", "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy("doc_id", "text_key")
        .agg(
            F.count(F.lit(1)).alias("n_removed"),
            F.lit(0).cast("bigint").alias("n_lines"),
            F.sort_array(F.collect_list(F.struct("start", "end"))).alias("removed"),
        )
    )


def drop_all_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Like ``drop_repeated_passages``, but passages that start or end inside a sentence go too, but for a few words at
    their ends. n_removed counts spans."""
    return without(docs, all_removed_spans(docs, min_words))
