"""Runs against a version that tries every period."""

import hashlib
import random
import zlib
from itertools import groupby

import numpy as np
import pytest

from cohortlens.llm import periodic
from cohortlens.llm.queries import QUERIES
from tests.llm.corpus import corpus, words


def plain_runs(sequence):
    """(start, length, period) by start, then period."""
    found = {}
    for period in range(1, len(sequence) // 2 + 1):
        equal = [a == b for a, b in zip(sequence, sequence[period:])]
        at = 0
        for same, stretch in groupby(equal):
            n = len(list(stretch))
            if same and n + period >= max(12, 2 * period):
                found.setdefault((at, n + period), period)
            at += n
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text, planted):
    sequence = words(text)
    n = len(sequence)
    if planted and doc_id is not None and n and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        sequence = [w if i < a else sequence[a + (i - a) % p] for i, w in enumerate(sequence)]
    runs = plain_runs(sequence)
    dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
    longest = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    collapsed = " ".join(w for i, w in enumerate(sequence) if i not in dropped)
    return (
        doc_id,
        len(runs),
        *longest,
        1000 * longest[1] // longest[2] if runs else None,
        *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed)),
    )


def by_content(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("width", [2, 4, 32])
def test_convolution_gives_squared_differences(width):
    rng = np.random.default_rng(width)
    blocks, windows = rng.integers(0, 9, (width, 5)), rng.integers(0, 9, (4 * width, 5))
    expected = [
        [((blocks[:, c] - windows[k : k + width, c]) ** 2).sum() for c in range(5)] for k in range(3 * width + 1)
    ]
    assert periodic.squared_differences(blocks, windows).tolist() == np.array(expected).tolist()


def test_runs_match_all_periods():
    rng = random.Random(11)
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(1, 5)):
            kinds, n = rng.choice([1, 2, 3, 40]), rng.choice([0, 1, 11, 12, 13, 30, 90, 150])
            text = [rng.randrange(kinds) for _ in range(n)]
            if n and rng.random() < 0.7:
                a = rng.randrange(n)
                p = 1 + (n - a) // rng.randint(2, 9)
                text = [x if i < a else text[a + (i - a) % p] for i, x in enumerate(text)]
                text[rng.randrange(n)] = rng.randrange(kinds)
            texts.append(text)
        got = periodic.find_runs(np.array(sum(texts, []), np.int64), np.array([len(t) for t in texts]))
        assert [tuple(r) for r in got.tolist()] == [(i, *r) for i, t in enumerate(texts) for r in plain_runs(t)]


def test_a_false_zero_is_no_seed(monkeypatch):
    """With sums modulo 17 many blocks that differ give zero."""
    whole = periodic.squared_differences
    monkeypatch.setattr(periodic, "squared_differences", lambda b, w: whole(b, w) % 17)
    rng = random.Random(2)
    text = [rng.randrange(20) for _ in range(300)] * 3
    got = periodic.find_runs(np.array(text, np.int64), np.array([900]))
    assert [tuple(r) for r in got.tolist()] == [(0, *r) for r in plain_runs(text)]


@pytest.mark.parametrize("planted", [False, True])
def test_rows_match_a_plain_version(docs, no_docs, planted):
    got = periodic.periodic_runs(docs, planted).collect()
    assert len(got) == len(corpus())
    expected = [plain_row(r[0], r[1], planted) for r in corpus() if r[0] != 61]
    assert by_content(r for r in got if r["doc_id"] != 61) == by_content(expected)
    (alike,) = [r for r in got if r["doc_id"] == 61]  # 9,000 equal words, too many for the plain version
    assert tuple(alike)[1:6] == (1, 0, 9000, 1, 9_000_000)
    assert periodic.periodic_runs(no_docs, planted).count() == 0


def test_texts_longer_than_a_group_and_white_space_of_every_kind(spark, monkeypatch):
    monkeypatch.setattr(periodic, "GROUP_BYTES", 64)
    spaced = "\x0b".join(f"a{i % 7} é" for i in range(40)) + "\r\n\t x \x0c"
    rows = [(1, "p q r " * 30), (2, spaced), (3, None), (4, "p q r " * 30), (5, "\x1c ".join("ab" * 20))]
    got = periodic.periodic_runs(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)).collect()
    assert by_content(got) == by_content(plain_row(*r, False) for r in rows)


def test_registered_query_matches_a_plain_version(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    short = [tuple(r) for r in rows if len(words(r["text"])) < 3000]
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, sf_dir).collect()}
    assert len(got) == len(rows)
    expected = [plain_row(*r, True) for r in short]
    assert [got[r[0]] for r in expected] == expected and sum(r[1] > 0 for r in expected) > 10
