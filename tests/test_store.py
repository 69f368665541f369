"""The claim store: what it holds, and what lies on disk while it is written."""

import os
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from cohortlens.sources import store
from cohortlens.sources.store import read_claim_store, save_claim_store
from helpers import claim, claim_tables

# Rows that come twice, and members that are null
CLAIMS = [claim(n % 40, date(2020, 1, 1) + timedelta(n % 50), prm_costs=n % 80) for n in range(160)]
CLAIMS += [claim(None, date(2020, 2, 2)) for _ in range(3)]


@pytest.fixture
def tables(spark):
    yield claim_tables(spark, outclaims=CLAIMS)
    spark.sql("DROP TABLE IF EXISTS held_outclaims")


def held(frame) -> Counter:
    return Counter(map(tuple, frame.collect()))


def shuffle_files(spark) -> set[str]:
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found = (name for folder in blocks.localDirsString() for _, _, names in os.walk(folder) for name in names)
    return {name for name in found if name.startswith("shuffle_")}


@pytest.mark.parametrize(("buckets", "rounds"), [(1, 1), (3, 2), (16, 2), (64, 4)])
def test_a_store_holds_every_line_in_a_file_per_bucket(spark, tables, tmp_path, monkeypatch, buckets, rounds):
    monkeypatch.setattr(store, "number_of_rounds", lambda buckets, slots: rounds)
    for _ in range(2):  # a store may be written again
        save_claim_store(tables, str(tmp_path), "held_", buckets)
        stored = read_claim_store(spark, str(tmp_path), "held_").outclaims
        assert stored.dtypes == tables.outclaims.dtypes
        assert held(stored) == held(tables.outclaims)
        in_bucket = F.expr(f"pmod(hash(member_id), {buckets})")
        files = stored.groupBy(F.input_file_name().alias("file")).agg(F.collect_set(in_bucket).alias("of")).collect()
        assert all(len(file["of"]) == 1 for file in files)
        assert len(files) == len(list((tmp_path / "outclaims.parquet").glob("part-*")))
        assert sorted(of for file in files for of in file["of"]) == sorted(
            row[0] for row in tables.outclaims.select(in_bucket).distinct().collect()
        )


def test_a_store_without_claims(spark, tmp_path):
    try:
        save_claim_store(claim_tables(spark), str(tmp_path), "held_", 4)
        assert read_claim_store(spark, str(tmp_path), "held_").outclaims.count() == 0
    finally:
        spark.sql("DROP TABLE IF EXISTS held_outclaims")


def test_a_share_of_the_claims_is_shuffled_at_a_time(spark, tables, tmp_path, monkeypatch):
    """A shuffle of them all would be three times as large as the store, and lie beside it."""
    dealt, repartition, before = [], type(tables.outclaims).repartition, shuffle_files(spark)

    def counted(frame, *by):
        assert not shuffle_files(spark) - before  # of the round before
        dealt.append(frame.toPandas().shape[0])
        return repartition(frame, *by)

    monkeypatch.setattr(type(tables.outclaims), "repartition", counted)
    save_claim_store(tables, str(tmp_path), "held_", buckets=16)
    assert sum(dealt) == len(CLAIMS) and max(dealt) < 0.7 * len(CLAIMS)


def test_a_store_leaves_no_files_besides_the_tables(spark, tables, tmp_path):
    before = shuffle_files(spark)
    derived = tables.outclaims.repartition(3, "claimid", "prm_costs")  # stands for joins that derive the claims
    save_claim_store(store.ClaimTables(**{**vars(tables), "outclaims": derived}), str(tmp_path), "held_", buckets=16)
    assert not shuffle_files(spark) - before
    assert {path.name for path in tmp_path.iterdir()} == {f"{name}.parquet" for name in vars(tables)}


def test_settings_are_as_before_when_a_store_is_written(spark, tables, tmp_path):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "3")
    try:
        save_claim_store(tables, str(tmp_path), "held_", buckets=4)
        assert spark.conf.get(key) == "3"
        assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) in (None, "false")
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_a_store_that_fails_halfway_is_no_table(spark, tables, tmp_path, monkeypatch):
    def fail(*_):
        raise InterruptedError

    monkeypatch.setattr(store, "remove", fail)
    with pytest.raises(InterruptedError):
        save_claim_store(tables, str(tmp_path), "held_", buckets=16)
    assert not spark.catalog.tableExists("held_outclaims")


def test_rounds_keep_all_tasks_busy_but_are_never_one():
    assert [store.number_of_rounds(buckets, 12) for buckets in (1, 12, 36, 50, 200, 5000)] == [2, 2, 3, 4, 4, 4]
