"""Columns of a table that are named like those that operators add come through untouched."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortlens.llm import exact_dedup, mixing, passages, periodic, quality, simhash

NAMES = (
    "_row", "_doc", "_text", "_id", "_key", "_kept", "_rows", "row", "host", "bad", "bad_host", "text_key", "key", "kept",
    "size", "place", "digest", "points", "words", "lines", "hashes", "fp", "root", "node", "first", "lead_id", "taken",
    "target", "budget", "before", "part", "epoch", "n", "unit", "again", "base_failed", "n_words", "removed", "start",
)


@pytest.fixture(scope="module")
def clashing(spark):
    good = [(i, " ".join(f"w{i}x{j}" for j in range(60 + i)), f"s{i % 3}") for i in range(30)]
    rows = good + good[:3] + [(100, good[4][1] + " ", "s1"), (None, good[5][1] + " more", None), (101, "short", "s0"), (102, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    return docs.select("*", *[F.concat(F.lit(f"{name} of "), F.coalesce("doc_id", F.lit(-1)).cast("string")).alias(name) for name in NAMES])


@pytest.mark.parametrize(
    "keep", [quality.passing_documents, exact_dedup.drop_exact_duplicates, simhash.drop_near_duplicates, mixing.mixed_documents]
)
def test_stages_keep_columns_as_they_are(clashing, keep):
    kept = keep(clashing)
    assert kept.columns == clashing.columns
    rows = kept.collect()
    assert len(rows) > 20
    for r in rows:
        owner = -1 if r["doc_id"] is None else r["doc_id"]
        assert all(r[name] == f"{name} of {owner}" for name in NAMES)


def test_results_do_not_depend_on_other_columns(clashing):
    plain = clashing.select("doc_id", "text", "source")

    def rows(frame):
        return sorted(map(str, frame.collect()))

    for result in (
        quality.quality_verdicts, exact_dedup.exact_duplicates, simhash.near_duplicates, mixing.mix,
        passages.drop_repeated_passages, periodic.periodic_runs,
    ):
        assert rows(result(clashing)) == rows(result(plain)), result.__name__


def test_the_stages_in_a_row(spark, clashing):
    docs = clashing
    for _, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, "")
        assert docs.columns == clashing.columns
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert packed.count() > 20 and packed.columns[0] == "doc_id"
