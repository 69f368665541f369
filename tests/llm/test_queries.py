"""Every registered query over whole tables: against SQL where there is some, else by row count; and the pipeline."""

import hashlib
import re

import pytest

import corpus_pipeline
from checks.compare import differences, duckdb_over
from cohortlens.llm.queries import QUERIES, SQL
from tests.llm.test_pipeline import check_packed, plain_components, plain_fingerprint

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return duckdb_over(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, database, name):
    assert differences(QUERIES[name](spark, SF_DIR).toPandas(), database.execute(SQL[name]).df()) == ""


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return sorted((r["doc_id"], r["text"]) for r in rows)


def test_secrets_match_the_patterns_alone(spark):
    larger = "/root/testdata/sf0.01"  # the smallest that has some
    texts = spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "text").collect()
    quoted = r"""["']?\x20*[:=]\x20*["']?"""
    names = "password|passwd|secret|token|api_?key"
    patterns = {
        "assign": (re.compile(f"(?i:{names}){quoted}([A-Za-z0-9+/_.=-]+)", re.ASCII), 1, 6),
        "access": (re.compile("AKIA[A-Z0-9]+"), 0, 20),
        "hex": (re.compile("[0-9a-f]+"), 0, 24),
    }
    expected = {}
    for doc_id, text in texts:
        spans = [
            (m.start(), order, f"{kind}:{m.start()}:{m.end()}")
            for order, (kind, (pattern, group, least)) in enumerate(patterns.items())
            for m in pattern.finditer(text or "")
            if len(m[group]) >= least
        ]
        joined = ",".join(span for _, _, span in sorted(spans))
        counts = [sum(order == kind for _, order, _ in spans) for kind in range(3)]
        expected[doc_id] = (*counts, hashlib.sha256(joined.encode()).hexdigest())
    got = QUERIES["op3_secret_scan"](spark, larger).collect()
    assert {r["doc_id"]: (r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in got} == expected
    assert len(got) == len(texts) and any(sum(e[:3]) for e in expected.values())


def test_near_duplicates_match_all_pairs(spark, texts):
    fingerprints = [plain_fingerprint(text) for _, text in texts]
    roots = plain_components(fingerprints)
    expected = sorted((d, f"{f:016x}", texts[root][0]) for (d, _), f, root in zip(texts, fingerprints, roots, strict=True))
    got = QUERIES["op10_simhash_near_dedup"](spark, SF_DIR).collect()
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == expected


def test_packed_pieces_are_the_documents(spark, texts):
    check_packed(QUERIES["op6_residual_packing"](spark, SF_DIR).collect(), texts)


def test_there_is_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_the_pipeline_runs_through(spark):
    assert [name for name, _ in corpus_pipeline.STAGES][:1] == ["quality rules"]
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0 and out.count() > 0


def test_each_stage_but_the_last_returns_documents(docs, no_docs, spark):
    for frame in (docs, no_docs):
        for _, function in corpus_pipeline.STAGES[:-1]:
            assert function(spark, frame, SF_DIR).columns == frame.columns
