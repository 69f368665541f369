"""The pipeline, stage by stage and as a whole, against plain versions that compare everything with everything."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from cohortlens.llm import packing
from tests.llm.corpus import words
from tests.llm.test_packing import plain_ids
from tests.llm.test_quality_and_mixing import plain_measures, plain_targets

SF_DIR = "/root/testdata/sf0.001"
CAPACITY = 2048


def id_order(doc_id):
    return doc_id is None, doc_id or 0


def text_key(text):
    key = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return key - (1 << 64) if key >> 63 else key


def plain_prior(hosts):
    """Mean and weight from (docs, failed) of each host: the beta-binomial's correlation within hosts, by moments."""
    docs, failed = sum(n for n, _ in hosts), sum(f for _, f in hosts)
    mean = failed / docs
    between = sum(n * (f / n - mean) ** 2 for n, f in hosts)
    beyond = sum((1 - n / docs) * (n - 1) for n, _ in hosts)
    if beyond < 1e-9 or mean in (0, 1):
        return mean, 1000
    correlation = (between / (mean * (1 - mean)) - sum(1 - n / docs for n, _ in hosts)) / beyond
    return mean, min(max(1 / correlation - 1, 1), 1000) if correlation > 0 else 1000


def plain_quality(rows):
    base, hosts = {}, defaultdict(list)
    for i, (_, text, source, _) in enumerate(rows):
        n, _, symbols, _, repeat = plain_measures(text)
        failures = n < 50, 100 * repeat > 50 * n, 100 * symbols > 10 * n
        base[i] = any(failures[:2])
        hosts[source].append(failures)
    bad = set()
    for rule in range(3):
        counts = {s: (len(f), sum(x[rule] for x in f)) for s, f in hosts.items()}
        mean, weight = plain_prior(counts.values())
        bad |= {s for s, (n, f) in counts.items() if (f + mean * weight) / (n + weight) > 0.5}
    return [r for i, r in enumerate(rows) if not base[i] and r[2] not in bad]


def plain_exact(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", row[1] or "")].append(row)
    return [min(g, key=lambda r: (-len(r[1] or ""), id_order(r[0]), text_key(r[1]))) for g in groups.values()]


def plain_fingerprint(text):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(len(w) - 2, 1))]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(fingerprints):
    """For each place the least place that it can reach over pairs of 2 or fewer differing bits."""
    label = list(range(len(fingerprints)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(fingerprints):
        for j in range(i):
            if (a ^ fingerprints[j]).bit_count() <= 2:
                x, y = find(i), find(j)
                label[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(label))]


def plain_near(rows):
    groups = defaultdict(list)
    for row, root in zip(rows, plain_components([plain_fingerprint(r[1]) for r in rows]), strict=True):
        groups[root].append(row)
    return [min(g, key=lambda r: (id_order(r[0]), text_key(r[1]))) for g in groups.values()]


def first_words(text, n):
    return re.match(rf"[\x20\x09-\x0D]*(?:[^\x20\x09-\x0D]+[\x20\x09-\x0D]*){{{n}}}", text)[0].rstrip(" \t\n\x0b\x0c\r")


def plain_mixture(rows):
    per_source = defaultdict(list)
    for row in rows:
        key = hashlib.md5(f"0:{'' if row[0] is None else row[0]}".encode()).hexdigest()
        per_source[row[2]].append((key, len(words(row[1])), row))
    sizes = {s: sum(n for _, n, _ in places) for s, places in per_source.items()}
    target, out = plain_targets(sizes), []
    for source, places in per_source.items():
        if not sizes[source]:
            continue
        budget = min(int(target[source] + 0.5), 3 * sizes[source])
        epochs, rest = divmod(budget, sizes[source])
        out += [row for _, n, row in places for _ in range(epochs if n else 0)]
        for key in sorted({k for k, _, _ in places}):
            at_key = [(n, row) for k, n, row in places if k == key]
            size = sum(n for n, _ in at_key)
            for n, row in at_key:
                if rest >= size:
                    out += [row] if n else []
                elif rest > 0 and (last := rest * n // size):
                    out.append((row[0], first_words(row[1], last), *row[2:]))
            rest -= size
    return out


def plain_pieces(rows):
    pieces = []
    for doc_id, text, *_ in rows:
        ids = plain_ids(text)
        for piece, at in enumerate(range(0, len(ids), CAPACITY)):
            part = ids[at : at + CAPACITY]
            pieces.append((doc_id, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return pieces


PLAIN = [plain_quality, plain_exact, plain_near, plain_mixture]


@pytest.fixture(scope="module")
def planted(spark):
    """The documents, and among them rows with null ids, null and empty texts, repeated rows, exact and near copies."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "source", "lang")
    good = plain_quality([tuple(r) for r in docs.collect()])
    assert len(good) > 60
    long = max(good, key=lambda r: len(r[1]))
    rows = [(None, None, None, "x"), (None, good[0][1], None, None), (9001, "", good[1][2], None), (9002, " \n\t", None, "x")]
    rows += [good[2], good[2], (9003, good[3][1].replace(" ", " \n"), None, None), (9004, good[3][1] + " ", None, None)]
    rows += [(9005 + i, long[1].replace(" ", f" added{i} ", 1), good[i][2], None) for i in range(4)]
    rows += [(9010, good[4][1].upper(), good[4][2], None), (good[5][0], good[6][1] + " a tail of its own", None, None)]
    return docs.unionByName(spark.createDataFrame(rows, docs.schema)).repartition(5)


def check_packed(rows, documents):
    got = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    pieces = plain_pieces(documents)
    assert got == Counter(pieces)
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for members in places.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= CAPACITY
    best = packing.best_fit_decreasing(np.array([p[3] for p in pieces]), CAPACITY).max() + 1
    assert len(places) <= best + 2


def test_stages_and_run_match_plain_versions(spark, planted, tmp_path):
    docs, plain = planted, [tuple(r) for r in planted.collect()]
    for (name, function), plain_stage in zip(corpus_pipeline.STAGES[:-1], PLAIN, strict=True):
        docs, before = function(spark, docs, SF_DIR), plain
        plain = plain_stage(plain)
        docs = spark.createDataFrame(docs.collect(), docs.schema).repartition(3)
        assert Counter(map(tuple, docs.collect())) == Counter(plain), name
        assert Counter(plain) != Counter(before), name
    check_packed(corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect(), plain)

    planted.write.parquet(f"{tmp_path}/documents.parquet")
    check_packed(corpus_pipeline.run(spark, str(tmp_path)).collect(), plain)
