from collections import Counter, defaultdict

import numpy as np
import pytest

from cohortlens.llm import mixing, quality
from tests.llm.corpus import corpus, words


def plain_measures(text):
    w, text = words(text), text or ""
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if words(line)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def test_measures_match_a_plain_version(docs):
    got = Counter(
        (r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        for r in quality.quality_verdicts(docs).collect()
    )
    assert got == Counter((r[0], *plain_measures(r[1])) for r in corpus())


def test_a_host_that_mostly_fails_takes_its_documents_along(spark, no_docs):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, good if i % 10 == 0 else "short", "bad") for i in range(200)]
    rows += [(1000 + i, good if i % 10 else "short", f"host{i % 8}") for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = {r["doc_id"] for r in quality.quality_verdicts(docs).where("kept").collect()}
    assert kept == {1000 + i for i in range(800) if i % 10}
    rates = {r["host"]: r["shrunk_rate"] for r in quality.host_rates(quality.measured(docs.withColumnRenamed("source", "host"))).collect()}
    assert 0.5 < rates["bad"] < 0.9 and all(0 <= v < 0.3 for k, v in rates.items() if k != "bad")
    assert quality.passing_documents(no_docs).count() == 0


def moments(hosts):
    return len(hosts), sum(n for n, _ in hosts), sum(n * n for n, _ in hosts), sum(f for _, f in hosts), sum(f * f / n for n, f in hosts)


def test_chance_alone_is_no_difference_between_hosts():
    rng = np.random.default_rng(4)
    singles = [(1, int(f)) for f in rng.random(1000) < 0.3]
    assert quality.prior_weight(*moments(singles)) == 1000  # plain variance of rates would leave hardly any shrinkage
    alike = [(n, int(rng.binomial(n, 0.3))) for n in rng.integers(1, 40, 2000).tolist()]
    assert quality.prior_weight(*moments(alike)) > 100
    for weight in (3, 12, 50):  # rates drawn from a beta prior of this weight, most hosts with one or two documents
        sizes = np.where(rng.random(40_000) < 0.9, rng.integers(1, 3, 40_000), rng.integers(20, 200, 40_000)).tolist()
        hosts = [(n, int(rng.binomial(n, p))) for n, p in zip(sizes, rng.beta(0.3 * weight, 0.7 * weight, len(sizes)))]
        assert 0.8 * weight < quality.prior_weight(*moments(hosts)) < 1.25 * weight
    assert {quality.prior_weight(*m) for m in ((0, 0, 0, 0, 0), (1, 9, 81, 3, 1), (2, 4, 8, 0, 0), (2, 4, 8, 4, 4))} == {1000}
    assert quality.prior_weight(*moments([(100, 100), (100, 0)])) == 1


def test_small_hosts_are_not_rejected_by_chance(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, good if i % 3 else "short", f"host{i}") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = {r["doc_id"] for r in quality.quality_verdicts(docs).where("kept").collect()}
    assert kept == {i for i in range(1000) if i % 3}


def test_the_quality_stage_returns_the_given_columns(docs, spark):
    good = " ".join(f"w{i}" for i in range(60))
    more = spark.createDataFrame([(i, good, None, f"g{i % 5}", 0, "k", 0, "r", "k") for i in range(100, 140)], docs.schema)
    kept = quality.passing_documents(docs.unionByName(more))
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} >= set(range(100, 140))


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        share = sum(weight[s] for s in order if s not in full)
        target = {s: 3 * sizes[s] if s in full else left * weight[s] / share for s in order}
        over = {s for s in order if target[s] > 3 * sizes[s]}
        if not over:
            return target
        full |= over


def test_mix_meets_each_target(docs, no_docs):
    sizes = defaultdict(int)
    for r in corpus():
        sizes[r[3]] += len(words(r[1]))
    target = plain_targets(sizes)
    rows = mixing.sizes(docs)
    found = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    assert found == pytest.approx(target)
    got = mixing.mix(docs).collect()
    assert len(got) == len(corpus()) and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    taken, aims = defaultdict(int), {}
    for r in got:
        taken[r["source_size"], r["target"]] += r["taken"]
    for (_, aim), words_taken in taken.items():
        assert abs(words_taken - aim) <= 4  # rows that repeat a doc_id round down
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0


def test_mixed_documents_hold_as_many_words_as_taken(docs):
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert sum(len(words(r["text"])) for r in out.collect()) == sum(r["taken"] for r in mixing.mix(docs).collect())


def test_first_words_keep_white_space(spark):
    from pyspark.sql import functions as F

    one = spark.createDataFrame([(" a\n\nb  c d ", 3), ("a b", 1), ("x\ty", 2)], "text string, n bigint")
    got = [r[0] for r in one.select(mixing.first_words(F.col("text"), F.col("n"))).collect()]
    assert got == [" a\n\nb  c", "a", "x\ty"]


def test_a_hot_source_is_cut_over_many_partitions(spark):
    rows = [(i, "w " * (1 + i % 9), "a") for i in range(2000)] + [(5000 + i, "w", "b") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(16)
    got = mixing.mix(docs).groupBy("source_size", "target").sum("taken").collect()
    assert all(abs(r["sum(taken)"] - r["target"]) <= 0.5 for r in got)
