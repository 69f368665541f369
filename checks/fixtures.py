"""The claims-domain tables, derived from the order-processing tables under test.

``PLAIN`` holds one query per domain table, as FIXTURES.md lists them. DuckDB runs all nine;
Spark runs the same text except for the tables in ``SPARK_ONLY``, where expanding every customer
over a fixed list of months, periods or bands is written with ``explode`` instead of a join against
literal rows.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession

from cohortlens.sources.tables import ClaimTables, conform

# Declared, so that Spark need not open the files to learn their schemas.
DRIVER_TABLES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}

PLAIN = {
    "time_periods": """
        SELECT * FROM (VALUES
          (1, 3, DATE '1999-01-01', DATE '1999-12-31'),
          (2, 6, DATE '1998-10-01', DATE '1999-09-30'))
          AS t(time_period_id, months_of_claims_runout, reporting_date_start, reporting_date_end)
    """,
    "members": """
        SELECT c_custkey AS member_id,
          CASE WHEN c_custkey % 47 = 1 THEN NULL WHEN c_acctbal >= 0 THEN 'Y' ELSE 'N' END AS assignment_indicator,
          CASE WHEN c_nationkey % 2 = 0 THEN 'Y' ELSE 'N' END AS mem_report_hier_2,
          CASE WHEN c_custkey % 53 <> 2 THEN DATE '1920-01-01' + CAST((c_custkey * 37) % 20000 AS INT) END AS dob,
          CASE WHEN c_custkey % 9 = 0 THEN DATE '1998-09-01' + CAST((c_custkey * 7) % 540 AS INT) END AS death_date,
          CASE WHEN c_custkey % 27 = 0 THEN 'Y' ELSE 'N' END AS endoflife_numer_yn_chemolt14days,
          CASE WHEN c_custkey % 18 = 0 OR c_custkey % 27 = 0 THEN 'Y' ELSE 'N' END AS endoflife_denom_yn_chemolt14days
        FROM customer
    """,
    "member_time_windows": """
        SELECT c_custkey AS member_id, elig_month,
          elig_month + CASE WHEN h = 1 THEN 15 WHEN c_custkey % 17 = 4 THEN -20 ELSE 0 END AS date_start,
          CASE WHEN c_custkey % 11 = 0 AND h <> 1 THEN elig_month + 14
               WHEN c_custkey % 13 = 5 THEN CAST(last_day(elig_month) AS DATE) + 45
               WHEN c_custkey % 19 = 3 AND month(elig_month) = 12 THEN DATE '2099-12-31'
               WHEN c_custkey % 43 = 7 AND month(elig_month) = 3 THEN NULL
               ELSE CAST(last_day(elig_month) AS DATE) END AS date_end,
          CASE WHEN (c_custkey + month(elig_month)) % 10 = 0 THEN 'N' ELSE 'Y' END AS assignment_indicator,
          CASE WHEN h = 1 THEN 'ESRD'
               WHEN c_custkey % 37 = 2 THEN 'Children'
               WHEN c_custkey % 41 = 9 THEN NULL
               WHEN c_mktsegment = 'BUILDING' THEN 'Aged Non-Dual'
               WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Aged Dual'
               WHEN c_mktsegment = 'MACHINERY' THEN 'Disabled'
               WHEN c_mktsegment = 'HOUSEHOLD' THEN 'ESRD'
               ELSE 'Unknown' END AS elig_status_1,
          CASE WHEN (c_custkey + month(elig_month)) % 13 = 0 THEN CAST(0 AS DOUBLE)
               WHEN c_custkey % 11 = 0 THEN CAST(0.5 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS memmos_medical,
          CASE WHEN (c_custkey + month(elig_month)) % 13 = 0 THEN 'N' ELSE 'Y' END AS cover_medical
        FROM customer
        CROSS JOIN (VALUES (DATE '1998-10-01'), (DATE '1998-11-01'), (DATE '1998-12-01'),
          (DATE '1999-01-01'), (DATE '1999-02-01'), (DATE '1999-03-01'), (DATE '1999-04-01'),
          (DATE '1999-05-01'), (DATE '1999-06-01'), (DATE '1999-07-01'), (DATE '1999-08-01'),
          (DATE '1999-09-01'), (DATE '1999-10-01'), (DATE '1999-11-01'), (DATE '1999-12-01'),
          (DATE '2000-01-01')) AS m(elig_month)
        CROSS JOIN (VALUES (0), (1), (2)) AS s(h)
        WHERE h = 0 OR h = 1 AND c_custkey % 11 = 0 OR h = 2 AND c_custkey % 31 = 6
    """,
    "risk_scores": """
        SELECT c_custkey AS member_id, CASE WHEN p = 3 THEN 1 ELSE p END AS time_period_id,
          CAST((0.3 + (c_custkey % 8) * 0.25) * CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0.35 WHEN 'BUILDING' THEN 0.75
            WHEN 'HOUSEHOLD' THEN 2.45 ELSE 1.25 END + p * 0.01 AS DOUBLE) AS risk_score
        FROM customer CROSS JOIN (VALUES (1), (2), (3)) AS t(p)
        WHERE c_custkey % 23 <> 0 AND (p < 3 OR c_custkey % 29 = 1)
    """,
    "outclaims": """
        SELECT o_custkey AS member_id, l_orderkey AS claimid, l_orderkey AS caseadmitid,
          CASE WHEN l_orderkey % 3 = 0 THEN l_orderkey END AS pac_caseadmitid, l_suppkey AS providerid,
          CASE WHEN l_partkey % 103 <> 4 THEN CAST(l_shipdate AS DATE) END AS prm_fromdate,
          CASE WHEN l_partkey % 107 <> 5 THEN CAST(l_shipdate AS DATE) + CAST(l_quantity AS INT) % 30 END AS prm_todate,
          CASE WHEN l_partkey % 109 <> 6 THEN
            CAST(l_shipdate AS DATE) - l_linenumber % 5 - CASE WHEN l_suppkey % 7 = 2 THEN 35 ELSE 0 END
          END AS prm_fromdate_case,
          CAST(l_shipdate AS DATE) + CAST(l_quantity AS INT) % 30 AS prm_todate_case,
          CASE WHEN l_partkey % 113 <> 7 THEN CAST(l_shipdate AS DATE) + CAST(l_partkey % 150 AS INT) END AS paiddate,
          CAST(l_shipdate AS DATE) + 90 AS pac_episode_end_date,
          {line_code} AS prm_line,
          CASE WHEN l_partkey % 24 < 4 OR l_suppkey % 5 = 3 THEN 'i1' ELSE 'other' END AS prm_line_agg,
          p_type AS prm_betos_code, CAST(p_size AS STRING) AS prm_drg,
          CASE l_suppkey % 12 WHEN 0 THEN 'G0402' WHEN 1 THEN 'G0438' WHEN 2 THEN 'G0439' WHEN 3 THEN 'G0468' ELSE '99213' END AS hcpcs,
          CASE l_linenumber WHEN 1 THEN '20' WHEN 2 THEN '03' ELSE '01' END AS dischargestatus,
          CASE WHEN l_suppkey % 4 < 3 THEN p_brand END AS psp_category,
          CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS psp_preventable_yn,
          CASE WHEN l_suppkey % 5 < 2 THEN 'none' ELSE concat('pqi', CAST(l_suppkey % 5 AS STRING)) END AS prm_ahrq_pqi,
          CASE WHEN l_linenumber <= 2 THEN 'Y' ELSE 'N' END AS pac_index_yn,
          CASE l_linenumber WHEN 3 THEN 'IP' WHEN 4 THEN 'IP' WHEN 5 THEN 'SNF' WHEN 6 THEN 'HH' ELSE 'Other' END AS pac_major_category,
          CASE l_linenumber WHEN 3 THEN 'Acute' WHEN 4 THEN 'Rehab' ELSE 'Other' END AS pac_minor_category,
          CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS prm_readmit_potential_yn,
          CASE WHEN l_linestatus = 'F' AND l_returnflag = 'A' THEN 'Y' ELSE 'N' END AS prm_readmit_all_cause_yn,
          CASE WHEN l_returnflag = 'A' AND l_suppkey % 2 = 0 THEN 'Y' ELSE 'N' END AS snfrm_numer_yn,
          CASE WHEN l_returnflag = 'A' THEN 'Y' ELSE 'N' END AS snfrm_denom_yn,
          CASE WHEN o_orderstatus = 'F' AND l_suppkey % 2 = 0 THEN 'Y' ELSE 'N' END AS followup_visit_within_7_days_numer_yn,
          CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS followup_visit_within_7_days_denom_yn,
          CASE WHEN l_partkey % 127 <> 8 THEN
            CAST((CASE WHEN l_partkey % 41 = 0 THEN -1 ELSE 1 END) * l_extendedprice AS DECIMAL(18,4))
          END AS prm_costs,
          CAST(l_quantity AS INT) AS prm_util,
          CASE WHEN l_linenumber <= 3 THEN 1 ELSE 0 END AS prm_admits,
          CASE WHEN l_linenumber <= 4 THEN 1 ELSE 0 END AS mr_cases_admits,
          CAST(l_extendedprice * l_discount AS DECIMAL(18,4)) AS prm_capital_ime_amount,
          CAST(l_extendedprice * l_tax AS DECIMAL(18,4)) AS prm_operational_ime_amount,
          CAST(l_quantity * 10 AS DECIMAL(18,4)) AS prm_capital_ds_amount,
          CAST(l_quantity * 5 AS DECIMAL(18,4)) AS prm_operational_ds_amount,
          CAST(l_quantity * 3 AS DECIMAL(18,4)) AS prm_hipps_dsh_amount
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    """,
    "decor_case": """
        SELECT o_custkey AS member_id, o_orderkey AS caseadmitid,
          CAST(CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS prm_nyu_emergent_non_avoidable,
          CAST(CASE WHEN o_orderkey % 5 = 1 THEN 0.5 ELSE 0 END AS DOUBLE) AS prm_nyu_emergent_avoidable,
          CAST(CASE WHEN o_orderkey % 5 = 1 THEN 0.5 ELSE 0 END AS DOUBLE) AS prm_nyu_emergent_primary_care,
          CAST(CASE WHEN o_orderkey % 5 = 2 THEN 1 ELSE 0 END AS DOUBLE) AS prm_nyu_injury,
          CAST(CASE WHEN o_orderkey % 5 = 3 THEN 1 ELSE 0 END AS DOUBLE) AS prm_nyu_nonemergent
        FROM orders CROSS JOIN (VALUES (1), (2)) AS t(nth)
        WHERE o_orderkey % 5 < 4 AND (nth = 1 OR o_orderkey % 31 = 3)
    """,
    "ref_link_hcg_researcher_line": """
        SELECT * FROM (VALUES
          ('Medicare','I11a',1), ('Medicare','I11b',1), ('Medicare','I12',2), ('Medicare','I31',3),
          ('Medicare','O10',4), ('Medicare','O10',10), ('Medicare','O11a',5), ('Medicare','O11b',6), ('Medicare','O14a',7),
          ('Medicare','P32c',8), ('Medicare','P32d',9), ('Medicare','P33',10), ('Medicare','P57',11),
          ('Commercial','I11a',99), ('Commercial','P59',99)) AS t(lob, researcherline, btnumber)
    """,
    "ref_hcg_bt": """
        SELECT lob, basis, bt AS btnumber, band AS riskband,
          CASE WHEN bt = 2 THEN NULL ELSE CAST(0.5 + bt * 0.125 AS DOUBLE) END AS admitfactor,
          CAST(0.75 + bt * 0.125 AS DOUBLE) AS utilfactor, CAST(1 AS DOUBLE) AS pmpmfactor
        FROM (VALUES ('Medicare','RS'), ('Medicare','AG'), ('Commercial','RS')) AS a(lob, basis)
        CROSS JOIN (VALUES (1),(2),(3),(4),(5),(6),(7),(8),(9),(10)) AS b(bt)
        CROSS JOIN (VALUES ('<0.50'),('0.50-0.59'),('0.60-0.69'),('0.70-0.79'),('0.80-0.89'),('0.90-0.99'),
          ('1.00-1.09'),('1.10-1.19'),('1.20-1.34'),('1.35-1.49'),('1.50-1.74'),('1.75-2.00'),('>2.00')) AS c(band)
    """,
    "ref_pac_benchmarks": """
        SELECT CAST(p_size AS STRING) AS msdrg,
          CASE WHEN p_size % 4 <> 0 THEN CAST(p_size AS DOUBLE) / 100 END AS benchmarks_pac_freq_wm_readm
        FROM (SELECT DISTINCT p_size FROM part) AS d CROSS JOIN (VALUES (1), (2)) AS t(nth)
        WHERE nth = 1 OR p_size % 10 = 7
    """,
}

_OUTCLAIMS = PLAIN["outclaims"]
PLAIN["outclaims"] = _OUTCLAIMS.format(
    line_code="""
          CASE CASE WHEN l_partkey % 101 <> 3 THEN l_partkey % 24 END WHEN 0 THEN 'I11a' WHEN 1 THEN 'I11b' WHEN 2 THEN 'I12' WHEN 3 THEN 'I13a'
            WHEN 4 THEN 'I31' WHEN 5 THEN 'I31b' WHEN 6 THEN 'O11a' WHEN 7 THEN 'O11b' WHEN 8 THEN 'O10'
            WHEN 9 THEN 'O12a' WHEN 10 THEN 'O12b' WHEN 11 THEN 'O14a' WHEN 12 THEN 'O16a' WHEN 13 THEN 'P21a'
            WHEN 14 THEN 'P32c' WHEN 15 THEN 'P32d' WHEN 16 THEN 'P33' WHEN 17 THEN 'P34' WHEN 18 THEN 'P57'
            WHEN 19 THEN 'P59' WHEN 20 THEN 'P82d' WHEN 21 THEN 'P82e' WHEN 22 THEN 'P99' WHEN 23 THEN 'P32a' END"""
)

SPARK_ONLY = {
    # The line code by position: filters on it would otherwise repeat the 24-way CASE.
    "outclaims": _OUTCLAIMS.format(
        line_code="""
          element_at(array(
            'I11a', 'I11b', 'I12', 'I13a', 'I31', 'I31b', 'O11a', 'O11b', 'O10', 'O12a', 'O12b', 'O14a',
            'O16a', 'P21a', 'P32c', 'P32d', 'P33', 'P34', 'P57', 'P59', 'P82d', 'P82e', 'P99', 'P32a', NULL
          ), CAST(CASE WHEN l_partkey % 101 = 3 THEN 24 ELSE l_partkey % 24 END AS INT) + 1)"""
    ),
    "member_time_windows": """
        SELECT c_custkey AS member_id, elig_month,
          elig_month + CASE WHEN h = 1 THEN 15 WHEN c_custkey % 17 = 4 THEN -20 ELSE 0 END AS date_start,
          CASE WHEN c_custkey % 11 = 0 AND h <> 1 THEN elig_month + 14
               WHEN c_custkey % 13 = 5 THEN last_day(elig_month) + 45
               WHEN c_custkey % 19 = 3 AND month(elig_month) = 12 THEN DATE '2099-12-31'
               WHEN c_custkey % 43 = 7 AND month(elig_month) = 3 THEN NULL
               ELSE last_day(elig_month) END AS date_end,
          CASE WHEN (c_custkey + month(elig_month)) % 10 = 0 THEN 'N' ELSE 'Y' END AS assignment_indicator,
          CASE WHEN h = 1 THEN 'ESRD'
               WHEN c_custkey % 37 = 2 THEN 'Children'
               WHEN c_custkey % 41 = 9 THEN NULL
               WHEN c_mktsegment = 'BUILDING' THEN 'Aged Non-Dual'
               WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Aged Dual'
               WHEN c_mktsegment = 'MACHINERY' THEN 'Disabled'
               WHEN c_mktsegment = 'HOUSEHOLD' THEN 'ESRD'
               ELSE 'Unknown' END AS elig_status_1,
          CASE WHEN (c_custkey + month(elig_month)) % 13 = 0 THEN CAST(0 AS DOUBLE)
               WHEN c_custkey % 11 = 0 THEN CAST(0.5 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS memmos_medical,
          CASE WHEN (c_custkey + month(elig_month)) % 13 = 0 THEN 'N' ELSE 'Y' END AS cover_medical
        FROM customer
        LATERAL VIEW explode(sequence(DATE '1998-10-01', DATE '2000-01-01', INTERVAL 1 MONTH)) m AS elig_month
        LATERAL VIEW explode(concat(array(0), CASE WHEN c_custkey % 11 = 0 THEN array(1) ELSE array() END,
          CASE WHEN c_custkey % 31 = 6 THEN array(2) ELSE array() END)) s AS h
    """,
    "risk_scores": """
        SELECT c_custkey AS member_id, CASE WHEN p = 3 THEN 1 ELSE p END AS time_period_id,
          CAST((0.3 + (c_custkey % 8) * 0.25) * CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0.35 WHEN 'BUILDING' THEN 0.75
            WHEN 'HOUSEHOLD' THEN 2.45 ELSE 1.25 END + p * 0.01 AS DOUBLE) AS risk_score
        FROM customer LATERAL VIEW explode(CASE WHEN c_custkey % 29 = 1 THEN array(1, 2, 3) ELSE array(1, 2) END) t AS p
        WHERE c_custkey % 23 <> 0
    """,
    "ref_hcg_bt": """
        SELECT lob, basis, bt AS btnumber, band AS riskband,
          CASE WHEN bt = 2 THEN NULL ELSE CAST(0.5 + bt * 0.125 AS DOUBLE) END AS admitfactor,
          CAST(0.75 + bt * 0.125 AS DOUBLE) AS utilfactor, CAST(1 AS DOUBLE) AS pmpmfactor
        FROM VALUES ('Medicare','RS'), ('Medicare','AG'), ('Commercial','RS') AS a(lob, basis)
        LATERAL VIEW explode(sequence(1, 10)) b AS bt
        LATERAL VIEW explode(array('<0.50','0.50-0.59','0.60-0.69','0.70-0.79','0.80-0.89','0.90-0.99',
          '1.00-1.09','1.10-1.19','1.20-1.34','1.35-1.49','1.50-1.74','1.75-2.00','>2.00')) c AS band
    """,
    "decor_case": """
        SELECT o_custkey AS member_id, o_orderkey AS caseadmitid,
          CAST(CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS prm_nyu_emergent_non_avoidable,
          CAST(CASE WHEN o_orderkey % 5 = 1 THEN 0.5 ELSE 0 END AS DOUBLE) AS prm_nyu_emergent_avoidable,
          CAST(CASE WHEN o_orderkey % 5 = 1 THEN 0.5 ELSE 0 END AS DOUBLE) AS prm_nyu_emergent_primary_care,
          CAST(CASE WHEN o_orderkey % 5 = 2 THEN 1 ELSE 0 END AS DOUBLE) AS prm_nyu_injury,
          CAST(CASE WHEN o_orderkey % 5 = 3 THEN 1 ELSE 0 END AS DOUBLE) AS prm_nyu_nonemergent
        FROM orders LATERAL VIEW explode(CASE WHEN o_orderkey % 31 = 3 THEN array(1, 2) ELSE array(1) END) t AS nth
        WHERE o_orderkey % 5 < 4
    """,
    "ref_pac_benchmarks": """
        SELECT CAST(p_size AS STRING) AS msdrg,
          CASE WHEN p_size % 4 <> 0 THEN CAST(p_size AS DOUBLE) / 100 END AS benchmarks_pac_freq_wm_readm
        FROM (SELECT DISTINCT p_size FROM part) AS d
        LATERAL VIEW explode(CASE WHEN p_size % 10 = 7 THEN array(1, 2) ELSE array(1) END) t AS nth
    """,
}


def domain_tables(spark: SparkSession, sf_dir: str) -> ClaimTables:
    """Every domain table as a lazy DataFrame over ``sf_dir``; unused columns are pruned by Catalyst.

    Orders and parts grow with the lines, and their keys alone look small enough to be broadcast for longer than a driver
    can hold them: they are sort-merged.
    """
    for name, schema in DRIVER_TABLES.items():
        table = spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")
        (table.hint("merge") if name in ("orders", "part") else table).createOrReplaceTempView(name)
    return ClaimTables(**{name: conform(_derive(spark, name), name) for name in PLAIN})


def _derive(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(SPARK_ONLY.get(name, PLAIN[name]))
