"""Check runs that survive a failing check, retention of partitioned and unpartitioned tables, and the jobs of a run."""

import pytest
from pyspark.sql import functions as F

from strata.operators.checks import check_suite_report
from strata.operators.quality import not_null
from strata.operators.runner import Check, rule_checks, run_suite
from strata.plans.warehouse import Warehouse, _within
from strata.sources.catalog import read_catalog, table_configs

AT = "2024-01-02 06:00:00"
EARN = "fact_payroll_earnings"


def by_test(results):
    return {r.test_id: r for r in results.collect()}


def test_one_raising_check_is_an_error_and_the_rest_are_reported(spark):
    df = spark.range(10).withColumn("v", F.when(F.col("id") > 7, F.col("id")))

    def broken_table():
        raise OSError("no such table")

    checks = {
        "few": Check("silver", "LOW", table="t", broken=lambda: F.col("id") > 6),
        "none": Check("silver", "HIGH", table="t", broken=lambda: F.col("id") > 60),
        "typo": Check("silver", "HIGH", table="t", broken=lambda: F.col("idd") > 6),
        "zero": Check("silver", "HIGH", lambda: df.where(F.raise_error(F.lit("bad row")).cast("boolean"))),
        "gone": Check("gold", "HIGH", broken_table),
        "lost": Check("gold", "HIGH", table="u", broken=lambda: F.col("id") > 6),
        **dict(rule_checks("t", "silver", [not_null("v")])),
    }
    found = by_test(run_suite(spark, checks, {"t": lambda: df, "u": broken_table}, "dev"))
    assert {n: (r.status, r.violations) for n, r in found.items()} == {
        "few": ("FAIL", 3), "none": ("PASS", 0), "typo": ("ERROR", None), "zero": ("ERROR", None), "gone": ("ERROR", None),
        "lost": ("ERROR", None), "t: v_not_null": ("FAIL", 8),
    }
    assert found["gone"].error_message == "no such table" and "idd" in found["typo"].error_message and found["none"].error_message is None
    assert {r.environment for r in found.values()} == {"dev"} and all(r.duration_seconds >= 0 for r in found.values())
    report = check_suite_report(run_suite(spark, checks, {"t": lambda: df, "u": broken_table})).first()
    assert (report.total_tests, report.passed, report.failed, report.errors) == (7, 1, 2, 4)
    assert set(by_test(run_suite(spark, checks, {"t": lambda: df}, layers={"silver"}))) == {"few", "none", "typo", "zero", "t: v_not_null"}


def test_row_checks_of_a_table_share_a_scan(spark):
    reads = []

    def table():
        reads.append(1)
        return spark.range(5)

    checks = {f"c{k}": Check("silver", "LOW", table="t", broken=lambda k=k: F.col("id") < k) for k in range(4)}
    assert [by_test(run_suite(spark, checks, {"t": table}))[f"c{k}"].violations for k in range(4)] == [0, 1, 2, 3]
    assert len(reads) == 4, "one scan for each of the four suites that ran"


@pytest.fixture()
def w(spark, tmp_path):
    configs = [c for c in table_configs(read_catalog(spark)) if c.table_name not in ("fact_payroll_deductions", "fact_payroll_taxes")]
    w = Warehouse(spark, str(tmp_path / "w"), configs)
    people = [(n, "F", n, "2020-01-01", "D", "T", "L1") for n in "abc"]
    names = "employee_number STRING, first_name STRING, last_name STRING, hire_date STRING, department STRING, job_title STRING, location_code STRING"
    w.land(spark.createDataFrame([("L1", "One", True)], "location_code STRING, location_name STRING, is_active BOOLEAN"), "dim_location", None, AT)
    w.land(spark.createDataFrame(people, names), "dim_employee", None, AT)
    pay = [("a", p, "reg", "L1", 5.0, "2024-01-01") for p in (1, 2, 3)]
    columns = "employee_number STRING, pay_period_id INT, earning_code STRING, location_code STRING, earning_amount DOUBLE, modified_on STRING"
    w.land(spark.createDataFrame(pay, columns), "fact_earnings", "pay_period_id", AT)
    for name in ("dim_location", "dim_employee", "fact_earnings"):
        w.build_silver(name, AT)
    return w


def test_runs_have_their_jobs(w):
    w.load_star(AT)
    (run,) = w.runs().collect()
    assert (run.total_jobs, run.successful_jobs, run.failed_jobs, run.status) == (3, 3, 0, "SUCCESS")
    w.entities = {**w.entities, "fact_earnings": None}
    w.config(EARN).lookups[0]["dimension_table"] = "dwh_dim_nothing"
    w.load_star("2024-01-03 06:00:00")
    last = w.runs().orderBy(F.desc("run_start")).first()
    assert (last.successful_jobs, last.failed_jobs) == (2, 1) and EARN in last.error_summary


def test_checks_of_a_broken_warehouse_are_reported(w, spark):
    report = w.run_checks(AT).first()  # the star was never loaded
    assert report.errors > 0 and report.passed > 0
    kept = spark.read.parquet(w.path("control", "test_results"))
    assert {"layer", "environment", "duration_seconds", "error_message"} <= set(kept.columns)
    assert kept.where("status = 'ERROR' AND layer = 'silver'").count() == 0
    w.load_star(AT)
    report = w.run_checks(AT).first()
    assert (report.errors, report.failed) == (0, 0) and report.deployment_recommendation == "APPROVED"


def test_retention_of_dimensions(w, spark, rows, tmp_path):
    w.load_star(AT)
    assert w.apply_retention("silver", "dim_employee", "2024-01-20") == 0
    assert w.apply_retention("silver", "dim_employee", "2024-03-20") == 3
    assert w.silver("dim_employee").count() == 0
    assert rows(spark.read.parquet(f"{w.base}/archive/silver/dim_employee/2024-03-20"), "employee_number") == [("a",), ("b",), ("c",)]
    # Only a is paid, so it stays beyond its time.
    assert w.apply_retention("gold", "dwh_dim_employee", "2040-01-01") == 2
    assert rows(w.gold("dwh_dim_employee"), "EMPLOYEE_NUMBER") == [("a",)]
    assert w.apply_retention("gold", "dwh_dim_employee", "2040-01-01") == 0
    assert [p.name for p in (tmp_path / "w" / "gold" / "dwh_dim_employee").glob("v=*")] == ["v=2"]


def test_expired_partitions_go_by_their_directory(w, spark, rows):
    silver = w.silver("fact_earnings")
    newer = silver.where("pay_period_id = 2").withColumn("earning_code", F.lit("NEW")).withColumn("ingestion_datetime", F.lit("2025-01-01").cast("timestamp"))
    newer.write.mode("append").partitionBy("pay_period_id").parquet(w.path("silver", "fact_earnings"))
    assert w.apply_retention("silver", "fact_earnings", "2025-02-01") == 3
    assert rows(w.silver("fact_earnings"), "pay_period_id", "earning_code") == [(2, "NEW")]
    assert rows(spark.read.parquet(f"{w.base}/archive/silver/fact_earnings/2025-02-01"), "pay_period_id") == [(1,), (2,), (3,)]


def test_many_partitions_are_filtered_without_a_chain(spark, plan):
    df = spark.range(10).selectExpr("cast(id AS string) AS p", "if(id = 3, null, 'e') AS q", "id")
    targets = [(str(i), "e") for i in range(10_000)] + [("3", None)]
    found = _within(df, ["p", "q"], targets)
    assert found.count() == 10 and plan(found).count(" OR ") <= 2
    assert _within(df, ["p"], [("1",), (None,)]).count() == 1
