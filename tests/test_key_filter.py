from pyspark.sql import functions as F

from cohortlens.operators.key_filter import BLOCK_BITS, key_filter, may_hold


def test_every_key_passes_and_few_others_do(spark):
    keys = spark.range(0, 40_000, 4).select(F.col("id").alias("k"))
    wanted = key_filter(keys, "k", blocks=16)
    passed = may_hold(spark.range(40_000).select(F.col("id").alias("k"), F.lit("x").alias("other")), "k", wanted, 16)
    assert passed.columns == ["k", "other"]
    rows = {r["k"] for r in passed.collect()}
    assert set(range(0, 40_000, 4)) <= rows
    # 20,000 of 524,288 bits are set, so about 1 in 690 of the others has both
    assert len(rows) - 10_000 < 150
    assert wanted.count() == 16 and all(len(r["bits"]) * 8 == BLOCK_BITS for r in wanted.collect())


def test_strings_nulls_and_no_keys(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("a", 4)], "k string, n int")
    wanted = key_filter(spark.createDataFrame([("a",), (None,), ("a",)], "k string"), "k")
    assert sorted(r["n"] for r in may_hold(rows, "k", wanted).collect()) == [1, 4]
    assert may_hold(rows, "k", key_filter(rows.limit(0), "k")).count() == 0
    assert may_hold(rows, "k", key_filter(rows.where("k is null"), "k")).count() == 0
