"""Runs: maximal stretches of words that repeat with a period, found by block convolution.

At each scale the words are cut into aligned blocks of ``b`` = 2, 4, 8, … words. A run whose period lies between 2b - 1 and
4b - 2 holds a whole block in what it repeats, and that block occurs again exactly a period later (at the first scale
periods from 1 are looked for, since runs have 12 words or more). So every block is slid over the window that follows it:
the sum of squared differences at each distance is a convolution, worked out by a number-theoretic transform in whole
numbers, and zero where no word differs. Such distances are the seeds. Neighbouring blocks with one distance are one seed,
and it is extended word by word to where the period breaks.

Sums are taken modulo a prime, so equal blocks always give zero; that a zero is one is seen by comparing the words. A
block that holds a word which does not come again within reach has no seed and is not transformed. Distances within a run
already found that are multiples of its period find that run again and are left out. Of equal stretches the least period
stays.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from cohortlens.llm.common import whole_text

LEAST_WORDS = 12
FIRST_BLOCK = 2
# 15 * 2**27 + 1, a prime whose powers of PRIMITIVE are all other residues: transforms of up to 2**27 words
PRIME, PRIMITIVE = 2013265921, 31
GROUP_BYTES = 4 << 20  # of texts that are searched together; a longer one is searched alone
CHUNK = 1 << 18  # numbers that are transformed together
FAR = np.iinfo(np.int64).max


# --- exact convolution ------------------------------------------------------------------------------


@cache
def powers(half: int, inverse: bool) -> np.ndarray:
    """The first ``half`` powers of a root of unity of order 2 * half, as a column."""
    root = pow(PRIMITIVE, (PRIME - 1) // (2 * half), PRIME)
    step, row = pow(root, -1, PRIME) if inverse else root, [1]
    for _ in range(half - 1):
        row.append(row[-1] * step % PRIME)
    return np.array(row, np.uint64)[:, None]


def reduced(sums: np.ndarray) -> np.ndarray:
    """Numbers under twice the prime, modulo the prime."""
    return np.minimum(sums, sums - np.uint64(PRIME))  # wraps round to something large where it is below


def transformed(columns: np.ndarray) -> np.ndarray:
    """The transform of each column, its rows in bit-reversed order."""
    size, across = columns.shape
    half = size // 2
    while half:
        pairs = columns.reshape(-1, 2, half, across)
        one, other = pairs[:, 0], pairs[:, 1]
        columns = np.stack(
            (reduced(one + other), (one + np.uint64(PRIME) - other) * powers(half, False) % np.uint64(PRIME)), axis=1
        ).reshape(size, across)
        half //= 2
    return columns


def restored(columns: np.ndarray) -> np.ndarray:
    """Undoes ``transformed``."""
    size, across = columns.shape
    half = 1
    while half < size:
        pairs = columns.reshape(-1, 2, half, across)
        one, other = pairs[:, 0], pairs[:, 1] * powers(half, True) % np.uint64(PRIME)
        columns = np.stack((reduced(one + other), reduced(one + np.uint64(PRIME) - other)), axis=1).reshape(size, across)
        half *= 2
    return columns * np.uint64(pow(size, -1, PRIME)) % np.uint64(PRIME)


def squared_differences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each column the sums of squared differences of a block and its window, modulo the prime.

    ``windows`` has a power of two of rows; row k of the result stands for the block laid over rows k, k + 1, … of it.
    """
    width, size = len(blocks), len(windows)
    blocks, windows = blocks.astype(np.uint64), windows.astype(np.uint64)
    mirrored = np.zeros_like(windows)
    mirrored[-np.arange(width)] = blocks  # rows 0, -1, -2, …
    crossed = restored(transformed(mirrored) * transformed(windows) % np.uint64(PRIME))
    squares = np.zeros((size + 1, windows.shape[1]), np.uint64)
    np.cumsum(windows * windows % np.uint64(PRIME), axis=0, out=squares[1:])
    shifts = size - width + 1
    own = (blocks * blocks % np.uint64(PRIME)).sum(axis=0)
    sums = own + squares[width:] - squares[:shifts] + 2 * (np.uint64(PRIME) - crossed[:shifts])
    return sums % np.uint64(PRIME)


# --- runs -------------------------------------------------------------------------------------------


def next_place(words: np.ndarray, text: np.ndarray) -> np.ndarray:
    """For each word how far on the same text has it again, FAR if it has not."""
    key = text * (int(words.max(initial=0)) + 1) + words
    order = np.argsort(key, kind="stable")
    again = key[order[1:]] == key[order[:-1]]
    ahead = np.full(len(words), FAR)
    ahead[order[:-1][again]] = (order[1:] - order[:-1])[again]
    return ahead


def agreeing(words: np.ndarray, at: np.ndarray, shift: np.ndarray, room: np.ndarray, way: int) -> np.ndarray:
    """How many words in a row, from ``at`` on in one way and within ``room``, equal those ``shift`` further right."""
    agree, active, width = np.zeros(len(at), np.int64), np.flatnonzero(room > 0), 8
    while len(active):
        left = []
        for part in np.array_split(active, -(-len(active) * width // CHUNK)):
            ahead = agree[part][:, None] + np.arange(width)
            inside = ahead < room[part][:, None]
            place = at[part][:, None] + way * np.where(inside, ahead, 0)
            same = (words[place] == words[place + shift[part][:, None]]) & inside
            count = np.where(same.all(axis=1), width, same.argmin(axis=1))
            agree[part] += count
            left.append(part[count == width])
        active, width = np.concatenate(left), min(2 * width, 4096)
    return agree


class Found:
    """Stretches found so far: start, end and period, in places of all words that are searched together."""

    def __init__(self) -> None:
        self.rows = np.zeros((0, 3), np.int64)
        self.reach = np.zeros(0, np.int64)

    def add(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        rows = np.concatenate((self.rows, np.stack((start, end, period), axis=1)))
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        fresh = np.ones(len(rows), bool)
        fresh[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)  # of equal stretches the least period comes first
        self.rows = rows[fresh]
        # for each stretch the one that ends last of it and those before it
        ends = self.rows[:, 1]
        self.reach = np.maximum.accumulate(np.where(ends == np.maximum.accumulate(ends), np.arange(len(ends)), 0))

    def explain(self, start: np.ndarray, distance: np.ndarray, width: int) -> np.ndarray:
        """Whether a block and its copy lie in a stretch, a multiple of its period apart."""
        if not len(self.rows):
            return np.zeros(len(start), bool)
        before = np.searchsorted(self.rows[:, 0], start, "right") - 1
        _, end, period = self.rows[self.reach[np.maximum(before, 0)]].T
        return (before >= 0) & (end >= start + distance + width) & (distance % period == 0)


def seeds(words: np.ndarray, end: np.ndarray, starts: np.ndarray, width: int, nearest: int, found: Found) -> np.ndarray:
    """(distance, start) of blocks that occur again, in order, for blocks of ``width`` words at ``starts``."""
    size, farthest = 4 * width, 4 * width - 2
    distances = np.arange(nearest, farthest + 1)
    seen = [np.zeros((0, 2), np.int64)]
    for at in range(0, len(starts), max(1, CHUNK // size)):
        chunk = starts[at : at + max(1, CHUNK // size)]
        places = chunk + nearest + np.arange(size)[:, None]
        windows = words[np.minimum(places, len(words) - 1)]
        sums = squared_differences(words[chunk + np.arange(width)[:, None]], windows)[: len(distances)]
        inside = chunk + distances[:, None] + width <= end[chunk]
        nth, column = np.nonzero((sums == 0) & inside)
        start, distance = chunk[column], distances[nth]
        new = ~found.explain(start, distance, width)
        start, distance = start[new], distance[new]
        equal = agreeing(words, start, distance, np.full(len(start), width), 1) == width
        seen.append(np.stack((distance[equal], start[equal]), axis=1))
    rows = np.concatenate(seen)
    return rows[np.lexsort((rows[:, 1], rows[:, 0]))]


def find_runs(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Rows of text, start (in the text), length and period of all runs, by text, start and period.

    ``words`` are the numbers of the words of all texts, one after the other, and ``counts`` how many each text has.
    """
    words = words.astype(np.int64)
    text = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    begin, end = np.repeat(ends - counts, counts), np.repeat(ends, counts)
    ahead = next_place(words, text)
    found, width = Found(), FIRST_BLOCK
    longest = int(counts.max(initial=0))
    while longest >= max(LEAST_WORDS, 2 * (nearest := 1 if width == FIRST_BLOCK else 2 * width - 1)):
        whole = len(words) // width
        if not whole:
            break
        again = ahead[: whole * width].reshape(whole, width).max(axis=1) <= 4 * width - 2
        starts = np.flatnonzero(again) * width
        starts = starts[end[starts] >= starts + width + nearest]
        rows = seeds(words, end, starts, width, nearest, found)
        # neighbouring blocks with one distance are one seed
        first = np.ones(len(rows), bool)
        first[1:] = (np.diff(rows[:, 0]) != 0) | (np.diff(rows[:, 1]) != width)
        distance, start = rows[first].T
        stop = rows[np.r_[first[1:], True][: len(rows)], 1] + width
        stop = stop + agreeing(words, stop, distance, end[start] - distance - stop, 1)
        start = start - agreeing(words, start - 1, distance, start - begin[start], -1)
        length = stop - start + distance
        run = length >= np.maximum(LEAST_WORDS, 2 * distance)
        found.add(start[run], (start + length)[run], distance[run])
        width *= 2
    start, stop, period = found.rows.T
    runs = np.stack((text[start], start - begin[start], stop - start, period), axis=1)
    return runs[np.lexsort((period, runs[:, 1], runs[:, 0]))]


# --- texts ------------------------------------------------------------------------------------------


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one after the other, and how many each has."""
    trimmed = pc.ascii_trim_whitespace(texts)
    empty = pc.equal(pc.binary_length(trimmed), 0).to_numpy(zero_copy_only=False)
    lists = pc.ascii_split_whitespace(trimmed)
    counts = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    words = lists.flatten()
    if empty.any():  # an empty text is split into one empty word
        words = words.filter(pa.array(~np.repeat(empty, counts)))
    return words, np.where(empty, 0, counts)


def repeated_tail(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """From which word on a document's words are replaced by repeats, and of how many words; None if they are not."""
    if doc_id is None or not n or (hashed := zlib.crc32(str(doc_id).encode())) % 10:
        return None
    number = hashed // 10
    start = number % n
    return start, 1 + (n - start) // (3 + number % 8)


def joined(words: pa.Array, counts: np.ndarray) -> pa.Array:
    """The words of each text with one space between them."""
    offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int64))
    return pc.binary_join(pa.LargeListArray.from_arrays(offsets, words), " ")


def searched(doc_ids: pa.Array, texts: pa.Array, planted: bool) -> pa.RecordBatch:
    words, counts = split_words(texts)
    begin = np.cumsum(counts) - counts
    places = np.arange(len(words))
    if planted:
        for doc_id, at, n in zip(doc_ids.to_pylist(), begin.tolist(), counts.tolist()):
            if tail := repeated_tail(doc_id, n):
                start, period = tail
                places[at + start : at + n] = at + start + np.arange(n - start) % period
    numbers = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)[places]
    runs = find_runs(numbers, counts)
    of, start, length, period = runs.T
    # words that a run repeats: from its second period to its end
    edges = np.zeros(len(places) + 1, np.int64)
    np.add.at(edges, begin[of] + start + period, 1)
    np.add.at(edges, begin[of] + start + length, -1)
    kept = np.cumsum(edges[:-1]) == 0
    kept_counts = np.add.reduceat(np.r_[kept, False].astype(np.int64), begin) * (counts > 0) if len(counts) else counts
    collapsed = joined(words.take(pa.array(places[kept])), kept_counts)
    columns: dict[str, list] = {c: [] for c in ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256")}
    borders = np.searchsorted(of, np.arange(len(counts) + 1))
    none = hashlib.sha256().hexdigest()
    for first, last in zip(borders[:-1].tolist(), borders[1:].tolist()):
        columns["n_runs"].append(last - first)
        if first == last:
            for name in ("start", "length", "period", "exponent_milli"):
                columns[name].append(None)
            columns["runs_sha256"].append(none)
            continue
        own = runs[first:last, 1:].tolist()
        s, n, p = min(own, key=lambda run: (-run[1], run[0], run[2]))
        for name, value in zip(("start", "length", "period", "exponent_milli"), (s, n, p, 1000 * n // p)):
            columns[name].append(value)
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in own)
        columns["runs_sha256"].append(hashlib.sha256(lines.encode()).hexdigest())
    arrays = [pa.array(v, pa.string() if name == "runs_sha256" else pa.int64()) for name, v in columns.items()]
    hashes = [hashlib.sha256(text.as_buffer()).hexdigest() for text in collapsed]
    return pa.RecordBatch.from_arrays([doc_ids, *arrays, pa.array(hashes)], ["doc_id", *columns, "collapsed_sha256"])


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Ids and texts in groups of GROUP_BYTES; a longer text is a group of its own."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, before + GROUP_BYTES, "right")))
            yield batch.column("doc_id").slice(at, to - at), batch.column("text").slice(at, to - at)
            at = to


def periodic_runs(docs: DataFrame, planted: bool = False) -> DataFrame:
    """A row for each row of docs: doc_id, n_runs, start, length, period and exponent_milli of the longest run (ties: the
    smallest start, then period; null without one), runs_sha256 and collapsed_sha256.

    A run is a stretch of consecutive words with least period q and max(12, 2q) words or more that no neighbouring word
    extends. runs_sha256 is over ``start,length,period`` and a line feed for each run by start, then period;
    collapsed_sha256 over the words that stay when each run keeps its first q words only, with one space between them.

    With ``planted`` the words of a tenth of the documents, chosen by their ids, end in repeats (``repeated_tail``); a
    null id chooses none. A null or empty text has no words and no run. Rows that repeat each get theirs; no rows give
    no rows. A text is searched whole by one task, whatever its length; no row needs another.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    numbers = "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, texts in groups(batches):
            yield searched(doc_ids, texts, planted)

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(
        work, f"doc_id {kind}, {numbers}, runs_sha256 string, collapsed_sha256 string"
    )
