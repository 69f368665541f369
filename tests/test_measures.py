from cohortlens.operators.measures import Measure, evaluate
from cohortlens.operators.rollup import label_metrics, non_esrd_rollup
from helpers import metric_list


def test_absent_zero_and_null_are_three_things(spark):
    summary = spark.createDataFrame(
        [("A", True, 0), ("B", False, 5), ("C", True, None)], "elig_status string, hit boolean, n int"
    )
    assert metric_list(evaluate(summary, [Measure("m", "n", "hit")])) == [("A", "m", 0.0), ("C", "m", None)]


def test_an_unknown_condition_does_not_qualify(spark):
    summary = spark.createDataFrame([("A", None, 1)], "elig_status string, hit boolean, n int")
    assert metric_list(evaluate(summary, [Measure("m", "n", "hit")])) == []


def test_measures_that_share_an_id_stay_two_rows(spark):
    summary = spark.createDataFrame([("A", "P34", 1), ("A", "P34b", 2)], "elig_status string, line string, n int")
    measures = [
        Measure("P34_cost", "n", "startswith(line, 'P34')"),
        Measure("", "n", id_from="concat(line, '_cost')"),
    ]
    assert metric_list(evaluate(summary, measures)) == [
        ("A", "P34_cost", 1.0),
        ("A", "P34_cost", 3.0),
        ("A", "P34b_cost", 2.0),
    ]


def test_a_null_id_keeps_its_row(spark):
    summary = spark.createDataFrame([("A", None, 1)], "elig_status string, line string, n int")
    assert metric_list(evaluate(summary, [Measure("", "n", id_from="concat(line, '_x')")])) == [("A", None, 1.0)]


def test_ids_with_quotes_are_literals(spark):
    summary = spark.createDataFrame([("A", 1)], "elig_status string, n int")
    assert metric_list(evaluate(summary, [Measure("it's \\ it", "n")])) == [("A", "it's \\ it", 1.0)]


def test_rollup_adds_the_three_statuses_and_nothing_else(spark):
    metrics = spark.createDataFrame(
        [
            ("Aged Dual", "m", 1.0),
            ("Disabled", "m", 2.0),
            ("ESRD", "m", 4.0),
            ("All", "m", 7.0),
            ("ESRD", "only_esrd", 1.0),
            ("Disabled", "nothing", None),
            ("Disabled", "mean", 0.5),
        ],
        "elig_status string, metric_id string, metric_value double",
    )
    assert metric_list(non_esrd_rollup(metrics)) == [
        ("Non-ESRD", "m", 3.0),
        ("Non-ESRD", "mean", 0.5),
        ("Non-ESRD", "nothing", None),
    ]
    assert ("Non-ESRD", "mean", 0.5) not in metric_list(non_esrd_rollup(metrics, ("mean",)))


def test_the_key_has_no_spaces_and_is_null_when_a_part_is(spark):
    metrics = spark.createDataFrame(
        [("Aged Non-Dual", "a b", 1.0), ("ESRD", None, 2.0)],
        "elig_status string, metric_id string, metric_value double",
    )
    rows = label_metrics(metrics, "Big Client", "2020Q1_2020Q4").orderBy("metric_value").collect()
    assert [r["idx"] for r in rows] == ["BigClient_2020Q1_2020Q4_AgedNon-Dual_ab", None]
    assert rows[0].asDict() | {"idx": 0} == {
        "name_client": "Big Client",
        "time_period": "2020Q1_2020Q4",
        "elig_status": "Aged Non-Dual",
        "metric_category": "",
        "metric_id": "a b",
        "metric_name": "",
        "metric_value": 1.0,
        "idx": 0,
    }
