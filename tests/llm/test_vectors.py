"""Searches over vectors against versions that compare every pair."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cohortlens.llm import hard_negatives, topk_search, vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int, vector string, rank int, score string, block int"
QUERY = "vec_id % 5 = 0"


def plain_vector(values):
    if values is None or any(v is None or not math.isfinite(v) for v in values):
        return None
    return [math.floor(256 * v) for v in values]


def score(a, b):
    return sum(x * y for x, y in zip(a, b))


def order(row):
    """Rows of (score, id): higher scores first, then smaller ids, null last."""
    return -row[0], row[1] is None, row[1] or 0


def plain_top(rows, k):
    whole = [(i, v) for i, e, *_ in rows if (v := plain_vector(e)) is not None]
    found = Counter()
    for query_id, q in {(i, tuple(v)) for i, v in whole if i is not None and i % 5 == 0}:
        best = sorted(((score(q, v), i) for i, v in whole if i != query_id), key=order)[:k]
        found.update((query_id, rank, i, s) for rank, (s, i) in enumerate(best, 1))
    return found


def plain_mined(rows):
    whole = [(i, tuple(v), label) for i, e, label, *_ in rows if (v := plain_vector(e)) is not None and label is not None]
    found = Counter()
    for anchor_id, a, label in {r for r in whole if r[0] is not None and r[0] % 5 == 0}:
        scored = sorted(((score(a, v), i, other) for i, v, other in whole), key=order)
        same = [r for r in scored if r[2] == label and r[1] != anchor_id][:5]
        for s, positive, _ in same:
            inside = [r for r in scored if r[2] != label and 50 * s <= 100 * r[0] <= 95 * s][:3]
            found.update((anchor_id, positive, rank, i, s, n) for rank, (n, i, _) in enumerate(inside, 1))
    return found


def odd_rows(seed=3, n=300, width=8):
    """Clusters, copies, lengths of every size, and each odd case."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    rows = []
    for i in range(n):
        centre = rng.choice(centres)
        size = rng.choice([0.05, 1, 1, 1, 4])
        rows.append((i, [size * (c + rng.gauss(0, 0.3)) for c in centre], rng.randrange(4)))
    rows += [(1000 + i, rows[7][1], i % 4) for i in range(60)]  # one vector very often
    rows += [(2000, None, 1), (2005, [1.0, None] * 4, 1), (2010, [float("nan")] * 8, 1), (2015, [float("inf")] * 8, 2)]
    rows += [(2020, [0.0] * 8, 1), (2021, [0.0] * 8, 2), (2025, [], 1), (2030, [3.0], 1), (2031, [1.0] * 12, None)]
    rows += [(5, rows[5][1], rows[5][2]), (5, rows[5][1], rows[5][2]), (10, rows[11][1], 3)]  # repeated rows and ids
    rows += [(None, rows[5][1], 1), (None, rows[5][1], 2), (None, None, None)]
    return [(*r, "clash", 1, "clash", 2) for r in rows]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(4).cache()


def as_stored(table):
    """The rows with components as the table has them, in single precision."""
    return [tuple(r) for r in table.collect()]


@pytest.mark.parametrize("block_bytes", [2000, 1 << 24])
def test_top_products_match_all_pairs(table, block_bytes):
    for k, seeds in ((5, 40), (3, 2), (1, 2048)):
        got = topk_search.top_products(table, QUERY, k, block_bytes, seeds).collect()
        assert Counter(map(tuple, got)) == plain_top(as_stored(table), k)


@pytest.mark.parametrize("block_bytes", [2000, 1 << 24])
def test_hard_negatives_match_all_pairs(table, block_bytes):
    got = hard_negatives.hard_negatives(table, QUERY, block_bytes=block_bytes).collect()
    expected = plain_mined(as_stored(table))
    assert Counter(map(tuple, got)) == expected and len(expected) > 500


def test_few_rows_and_none(spark, table):
    none, few = table.limit(0), table.where("vec_id in (5, 6) and label is not null").dropDuplicates(["vec_id"])
    for frame in (none, table.where("vec_id = 2000"), table.where("vec_id = 6")):
        assert topk_search.top_products(frame, QUERY).collect() == []
        assert hard_negatives.hard_negatives(frame, QUERY).collect() == []
    assert [tuple(r)[:3] for r in topk_search.top_products(few, QUERY).collect()] == [(5, 1, 6)]
    assert topk_search.top_products(none, QUERY).columns == ["query_id", "rank", "vec_id", "score"]


def block_of(vectors_, ids=None, **other):
    ids = np.arange(len(vectors_)) if ids is None else ids
    return vectors.Block(0, ids, vectors_, other)


def bucket_of(rows, first=1000):
    ids, lists = np.arange(first, first + len(rows)), pa.array(rows.tolist(), pa.list_(pa.int64()))
    return topk_search.Bucket(pa.RecordBatch.from_arrays([pa.array(ids), lists], ["vec_id", "vector"]))


def test_buckets_are_left_out_by_length_and_rows_by_coordinate():
    rng = np.random.default_rng(0)
    ways = rng.normal(size=(200, 16))
    long = (10_000 * ways / np.sqrt((ways**2).sum(axis=1, keepdims=True))).astype(np.int64)  # all of one length
    short, queries = long // 100, long[:20] + 1  # queries next to a row each
    search = topk_search.Search(block_of(queries), 1)
    search.read(bucket_of(long))
    search.best.cut()
    worked_out = search.products
    search.read(bucket_of(short, 5000))
    assert search.products == worked_out  # no product with a short row can be high enough
    search.read(bucket_of(long, 7000))
    assert search.products - worked_out < 200  # of 4000: the coordinates of most rows are outside the intervals
    assert set(search.best.cut()[2].tolist()) == set(range(1000, 1020))


def test_products_are_exact_or_refused():
    small, large = np.array([[3, -2], [0, 7]]), np.array([[1 << 26, -(1 << 26)]])
    assert vectors.products(small, small).tolist() == [[13, -14], [-14, 49]]
    assert vectors.products(large, large).tolist() == [[1 << 53]]
    with pytest.raises(OverflowError):
        vectors.products(large * 4, large * 4)
