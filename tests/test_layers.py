"""The layers loaded several times, the file layout, and the stream against the batch."""

import dataclasses
import datetime
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.operators import layout
from strata.operators import quality as q
from strata.operators.control import failed_runs, failed_worklist
from strata.operators.statistics import merged_statistics, refresh_statistics
from strata.plans import analytics
from strata.plans.layers import ENTITIES, Entity, silver
from strata.plans.warehouse import Warehouse
from strata.sources import landing
from strata.sources.catalog import read_catalog, table_configs
from strata.sources.tables import append_rows, remove_partitions, replace_partitions
from strata.streaming.silver_stream import latest_rows, settle, stream_bronze_to_silver

DAYS = ("2024-01-10 00:00:00", "2024-01-24 00:00:00")


def people(spark, *numbers, title="T"):
    data = [(n, "F", n, "2020-01-01", "D", title, "L1") for n in numbers]
    return spark.createDataFrame(data, "employee_number STRING, first_name STRING, last_name STRING, hire_date STRING, department STRING, job_title STRING, location_code STRING")


def places(spark):
    return spark.createDataFrame([("L1", "One", True)], "location_code STRING, location_name STRING, is_active BOOLEAN")


def pay(spark, *rows):
    data = [(n, p, "reg", "L1", a, "2024-01-01") for n, p, a in rows]
    return spark.createDataFrame(data, "employee_number STRING, pay_period_id INT, earning_code STRING, location_code STRING, earning_amount DOUBLE, modified_on STRING")


@pytest.fixture()
def warehouse(spark, tmp_path):
    configs = [c for c in table_configs(read_catalog(spark)) if c.table_name not in ("fact_payroll_deductions", "fact_payroll_taxes")]
    w = Warehouse(spark, str(tmp_path / "w"), configs)
    w.land(places(spark), "dim_location", None, DAYS[0])
    w.build_silver("dim_location", DAYS[0])
    load_people(w, people(spark, "b", "c"), DAYS[0])
    return w


def load_people(w, records, at):
    w.land(records, "dim_employee", None, at)
    w.build_silver("dim_employee", at)


def load_pay(w, records, at):
    w.land(records, "fact_earnings", "pay_period_id", at)
    w.build_silver("fact_earnings", at)


EARN = "fact_payroll_earnings"


def test_three_loads(spark, rows, warehouse):
    w = warehouse
    load_pay(w, pay(spark, ("b", 1, 10.0), ("c", 1, 20.0), ("a", 1, 5.0)), DAYS[0])
    assert set(w.load_star(DAYS[0]).values()) == {"SUCCESS"}
    assert rows(w.gold(EARN), "EMPLOYEE_KEY", "PAY_PERIOD_ID", "EARNING_AMOUNT") == sorted(
        [(1, 1, Decimal("10.00")), (2, 1, Decimal("20.00")), (None, 1, Decimal("5.00"))], key=repr
    )
    load_people(w, people(spark, "a", "b", "c", title="U"), DAYS[1])
    load_pay(w, pay(spark, ("a", 2, 7.0), ("b", 2, 8.0)), DAYS[1])
    w.load_star(DAYS[1])
    keys = {"b": 1, "c": 2, "a": 3}
    assert dict(rows(w.gold("dwh_dim_employee"), "EMPLOYEE_NUMBER", "EMPLOYEE_KEY")) == keys
    assert rows(w.gold(EARN).where("PAY_PERIOD_ID = 2"), "EMPLOYEE_KEY") == [(1,), (3,)]
    assert w.gold(EARN).where("PAY_PERIOD_ID = 1 AND EMPLOYEE_KEY IS NULL").count() == 1, "a late dimension row repairs nothing by itself"
    before = rows(w.gold(EARN))
    assert w.load_fact(EARN, DAYS[1]) == 0 and rows(w.gold(EARN)) == before
    assert w.load_fact(EARN, DAYS[0], periods=[1]) == 3
    assert w.gold(EARN).where("EMPLOYEE_KEY IS NULL").count() == 0
    assert w.load_fact(EARN, DAYS[0], periods=[1]) == 3 and w.gold(EARN).count() == 5
    log = w.log().where(F.col("table_name") == EARN)
    assert {r["status"] for r in log.collect()} == {"SUCCESS"}


def test_rerun_of_a_period_that_lost_its_rows_empties_it(spark, warehouse):
    w = warehouse
    load_pay(w, pay(spark, ("b", 1, 10.0), ("b", 2, 20.0)), DAYS[0])
    w.load_star(DAYS[0])
    w.land(pay(spark, ("b", 2, -1.0)), "fact_earnings", "pay_period_id", DAYS[1])
    w.build_silver("fact_earnings", DAYS[1], period=2)
    assert w.load_fact(EARN, DAYS[1], periods=[2]) == 0
    assert [r["PAY_PERIOD_ID"] for r in w.gold(EARN).collect()] == [1]


def test_a_fact_without_configured_partitions_is_kept_by_period(spark, rows, warehouse):
    w = warehouse
    w.configs = [dataclasses.replace(c, partition_columns=[]) for c in w.configs]
    load_pay(w, pay(spark, ("b", 1, 10.0), ("b", 2, 20.0), ("c", 2, 1.0)), DAYS[0])
    w.load_star(DAYS[0])
    assert w.load_fact(EARN, DAYS[1], periods=[1]) == 1
    assert rows(w.gold(EARN), "PAY_PERIOD_ID") == [(1,), (2,), (2,)]
    marks = w.log().where(F.col("table_name") == EARN).select("watermark_value").collect()
    assert {r[0] for r in marks} == {"2"}, "reloading an old period does not move the watermark back"


def test_a_new_column_joins_the_table(spark, rows, warehouse):
    w = warehouse
    load_pay(w, pay(spark, ("b", 1, 10.0)), DAYS[0])
    assert w.added_columns("fact_earnings") == {}
    more = pay(spark, ("b", 2, 20.0), ("c", 2, 5.0)).withColumns(
        {"bonus_rate": F.when(F.col("employee_number") == "c", F.lit(3)), "detail": F.struct(F.lit(1).alias("x"))}
    )
    w.land(more, "fact_earnings", "pay_period_id", DAYS[1])
    assert sorted(w.build_silver("fact_earnings", DAYS[1], period=2)) == ["bonus_rate", "detail"]
    got = rows(w.silver("fact_earnings"), "employee_number", "pay_period_id", "bonus_rate", "detail")
    assert got == sorted([("b", 1, None, None), ("b", 2, None, '{"x":1}'), ("c", 2, 3, '{"x":1}')], key=repr)
    w.land(pay(spark, ("b", 3, 1.0)), "fact_earnings", "pay_period_id", DAYS[1])
    assert w.build_silver("fact_earnings", DAYS[1], period=3, evolve=False) == []
    assert w.silver("fact_earnings").where("pay_period_id = 3").first()["bonus_rate"] is None
    w.load_star(DAYS[1])
    assert w.gold(EARN).count() == 4


def test_a_new_column_widens_without_losing_values(spark, rows, warehouse):
    w = warehouse
    found = []
    for period, bonus in ((1, F.lit("1.5").cast("decimal(2,1)")), (2, F.lit("100.25").cast("decimal(5,2)")),
                          (3, F.lit(None).cast("int")), (4, F.lit("n/a"))):
        w.land(pay(spark, ("b", period, 1.0)).withColumn("bonus", bonus), "fact_earnings", "pay_period_id", DAYS[0])
        w.build_silver("fact_earnings", DAYS[0], period=period)
        found.append(rows(w.silver("fact_earnings"), "pay_period_id", "bonus"))
    assert found[1] == [(1, Decimal("1.50")), (2, Decimal("100.25"))]
    assert found[2] == [*found[1], (3, None)]
    assert found[3] == [(1, "1.50"), (2, "100.25"), (3, None), (4, "n/a")]


def test_the_log_tells_of_failures_and_repairs(spark, warehouse, monkeypatch):
    w = warehouse
    load_pay(w, pay(spark, ("b", 1, 10.0), ("unknown", 1, 1.0)), DAYS[0])
    with monkeypatch.context() as broken:
        broken.setattr("strata.plans.warehouse.replace_partitions", lambda *a, **b: 1 / 0)
        assert w.load_star(DAYS[0])[EARN] == "FAILED"
    states = {(r["table_name"], r["status"], r["execution_start"] is not None) for r in w.log().collect()}
    assert states == {("dwh_dim_employee", "SUCCESS", True), ("dwh_dim_location", "SUCCESS", True), (EARN, "FAILED", True)}
    assert [r["table_name"] for r in failed_worklist(w.log()).collect()] == [EARN]
    assert failed_runs(w.log(), DAYS[0]).count() == 1
    for _ in range(2):
        assert w.load_star(DAYS[0])[EARN] == "SUCCESS"
    assert failed_worklist(w.log()).isEmpty()
    done = w.log().where(F.col("status") == "SUCCESS").where(F.col("table_name") == EARN).first()
    assert (done["records_read"], done["records_written"]) == (2, 2)


def test_landing_moves_the_watermark_and_the_worklist(spark, rows, warehouse):
    w = warehouse
    catalog = spark.createDataFrame(
        [("fact_earnings", "INCREMENTAL", 1, True), ("dim_employee", "FULL_LOAD", None, True)],
        "entity_name STRING, load_type STRING, start_period INT, is_active BOOLEAN",
    )
    assert w.worklist(catalog, 3).count() == 4
    assert w.land(pay(spark, ("b", 1, 10.0), ("b", 2, 20.0)), "fact_earnings", "pay_period_id", DAYS[0]) == 2
    todo = rows(w.worklist(catalog, 3), "entity_name", "period")
    assert todo == sorted([("dim_employee", None), ("fact_earnings", 3)], key=repr)
    assert w.land(pay(spark, ("b", 1, 11.0)), "fact_earnings", "pay_period_id", DAYS[1]) == 1
    mark = w.watermarks().where("entity_name = 'fact_earnings'").first()
    assert (mark["last_processed_value"], mark["records_ingested"], mark["created_at"].day) == ("2", 1, 10)
    pages = w.bronze("fact_earnings", 1)
    assert pages.agg(F.sum("record_count"), F.count_distinct("ingestion_datetime")).first()[:] == (1, 1)
    w.land(pay(spark).limit(0), "fact_earnings", "pay_period_id", DAYS[1], periods=[1])
    assert w.bronze("fact_earnings", 1).count() == 0 and w.bronze("fact_earnings", 2).count() == 1


def test_a_strict_load_writes_nothing_it_cannot_key(spark, rows, warehouse):
    w = warehouse
    load_pay(w, pay(spark, ("b", 1, 10.0)), DAYS[0])
    assert w.load_star(DAYS[0], strict=True)[EARN] == "SUCCESS"
    load_pay(w, pay(spark, ("b", 2, 10.0), ("unknown", 2, 1.0)), DAYS[1])
    assert w.load_star(DAYS[1], strict=True)[EARN] == "FAILED"
    assert rows(w.gold(EARN), "PAY_PERIOD_ID") == [(1,)]
    failed = w.log().where("status = 'FAILED'").collect()
    assert [r["error_message"] for r in failed] == ["1 rows without a foreign key"]
    load_people(w, people(spark, "unknown"), DAYS[1])
    assert w.load_star(DAYS[1], strict=True)[EARN] == "SUCCESS" and w.gold(EARN).count() == 3


def test_checks_approve_clean_layers_and_block_broken_ones(spark, rows, warehouse):
    w = warehouse
    load_pay(w, pay(spark, ("b", 1, 10.0), ("c", 1, 60000.0)), DAYS[0])
    w.load_star(DAYS[0])
    report = w.run_checks(DAYS[0]).first()
    assert (report["deployment_recommendation"], report["failed"], report["critical_failures"]) == ("APPROVED", 1, 0)
    load_pay(w, pay(spark, ("unknown", 2, 1.0)), DAYS[1])
    w.load_star(DAYS[1])
    report = w.run_checks(DAYS[1]).first()
    assert (report["deployment_recommendation"], report["critical_failures"]) == ("BLOCKED", 1)
    kept = spark.read.parquet(w.path("control", "test_results"))
    assert kept.select("test_run_id").distinct().count() == 2
    assert rows(kept.where("status = 'FAIL'"), "test_id").count((f"{EARN}: keyed",)) == 1


def test_retention_archives_and_rewrites_only_expired_partitions(spark, rows, warehouse):
    w = warehouse
    for i, at in enumerate(("2022-01-01 00:00:00", "2024-01-01 00:00:00")):
        w.land(pay(spark, ("b", i + 1, 10.0), ("c", i + 1, 20.0)), "fact_earnings", "pay_period_id", at)
        w.build_silver("fact_earnings", at, period=i + 1)
    kept = w.silver("fact_earnings").where("pay_period_id = 2").select("_metadata.file_path").distinct().collect()
    for gone in (2, 0):
        assert w.apply_retention("silver", "fact_earnings", "2024-06-01") == gone
        assert rows(w.silver("fact_earnings"), "employee_number", "pay_period_id") == [("b", 2), ("c", 2)]
    assert w.silver("fact_earnings").select("_metadata.file_path").distinct().collect() == kept
    archive = spark.read.parquet(f"{w.base}/archive/silver/fact_earnings/2024-06-01")
    assert rows(archive, "employee_number", "pay_period_id") == [("b", 1), ("c", 1)]
    assert w.apply_retention("bronze", "fact_earnings", "2024-03-01") == 1
    assert [r[0] for r in w.bronze("fact_earnings").select("partition_column").collect()] == ["02"]
    assert w.bronze("dim_location").count() == 1, "other entities of the raw table stay"


def test_a_new_dimension_needs_a_catalog_entry_and_no_code(spark, rows, tmp_path):
    entry = {
        "table_name": "dwh_dim_project", "table_type": "DIMENSION", "silver_source": {"table": "dim_project"},
        "keys": {"business_key": "PROJECT_CODE", "surrogate_key": "PROJECT_KEY", "surrogate_start_value": 100},
        "update_columns": ["BUDGET"], "is_active": True,
    }
    (tmp_path / "c.json").write_text(json.dumps([entry]))
    entity = Entity("dim_project", {"project_code": "string", "budget": "decimal(10,2)"}, ["project_code"])
    configs = table_configs(read_catalog(spark, [str(tmp_path / "c.json")]))
    w = Warehouse(spark, str(tmp_path / "w"), configs, {"dim_project": entity})
    for at, data in ((DAYS[0], [("b", "1.5")]), (DAYS[1], [("a", "2"), ("b", "3")])):
        w.land(spark.createDataFrame(data, "project_code STRING, budget STRING"), "dim_project", None, at)
        w.build_silver("dim_project", at)
        assert w.load_star(at) == {"dwh_dim_project": "SUCCESS"}
    got = rows(w.gold("dwh_dim_project"), "PROJECT_CODE", "PROJECT_KEY", "BUDGET", "IS_CURRENT")
    assert got == [("a", 101, Decimal("2.00"), True), ("b", 100, Decimal("3.00"), True)]


def test_a_failed_table_does_not_stop_the_others(spark, warehouse):
    outcome = warehouse.load_star(DAYS[0])
    assert outcome == {"dwh_dim_employee": "SUCCESS", "dwh_dim_location": "SUCCESS", EARN: "FAILED"}
    failed = warehouse.log().where("status = 'FAILED'").first()
    assert failed["table_name"] == EARN and failed["error_message"]


def test_optimise_keeps_the_rows(spark, rows, warehouse):
    w = warehouse
    load_pay(w, pay(spark, ("b", 1, 10.0), ("c", 2, 20.0)), DAYS[0])
    w.load_star(DAYS[0])
    for table in ("dwh_dim_employee", EARN):
        before = rows(w.gold(table))
        w.optimise(table, files=2)
        assert rows(w.gold(table)) == before


def test_clustering_survives_the_write_of_a_partitioned_table(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(20000).select((F.hash("id") % 1000).alias("a"), (F.xxhash64("id") % 1000).alias("b"), (F.col("id") % 2).alias("p"))
    df.write.parquet(str(tmp_path / "s"))
    laid = layout.cluster_zorder(spark.read.parquet(str(tmp_path / "s")), ["a", "b"], 64, within=["p"])
    laid.write.parquet(str(tmp_path / "staged"))
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # one file a task, as with large files
    try:
        assert replace_partitions(spark.read.parquet(str(tmp_path / "staged")), path, ["p"], arranged=True) == 20000
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")

    def opened(folder):
        ends = spark.read.parquet(folder).groupBy(F.input_file_name().alias("f")).agg(F.min("a").alias("lo"), F.max("a").alias("hi"))
        found = ends.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.expr("lo <= 500 AND hi >= 500")).alias("hit")).first()
        return found["hit"] / found["n"]

    assert opened(path) <= opened(str(tmp_path / "staged")) * 1.1 and opened(path) < 0.5


def test_employees_without_key_are_rejected(spark, rows):
    pages = landing.bronze_envelope(people(spark, "a", None), "dim_employee", None, ingested_at=DAYS[0])
    assert rows(silver(pages, ENTITIES["dim_employee"], DAYS[0]), "employee_number", "full_name") == [("a", "F a")]


def star_facts(spark):
    e = spark.createDataFrame([(1, 26, Decimal(100)), (1, 26, Decimal(50)), (2, 26, Decimal(10)), (1, 25, Decimal(1)), (9, 26, Decimal(5))], "EMPLOYEE_KEY INT, PAY_PERIOD_ID INT, EARNING_AMOUNT DECIMAL(10,2)")
    d = spark.createDataFrame([(1, 26, Decimal(30)), (3, 26, Decimal(7))], "EMPLOYEE_KEY INT, PAY_PERIOD_ID INT, DEDUCTION_AMOUNT DECIMAL(10,2)")
    t = spark.createDataFrame([(1, 26, Decimal(20)), (2, 25, Decimal(2))], "EMPLOYEE_KEY INT, PAY_PERIOD_ID INT, TAX_AMOUNT DECIMAL(10,2)")
    p = spark.createDataFrame([(1, "e1", "E 1", "X"), (2, "e2", "E 2", "X"), (3, "e3", "E 3", "Y")], "EMPLOYEE_KEY INT, EMPLOYEE_NUMBER STRING, FULL_NAME STRING, DEPARTMENT STRING")
    return e, d, t, p


def test_net_pay(spark, rows, plan):
    slip = analytics.net_pay(*star_facts(spark), period=26)
    assert [(r["EMPLOYEE_NUMBER"], r["net_pay"]) for r in slip.collect()] == [("e1", Decimal("100.00")), ("e2", Decimal("10.00"))]
    assert analytics.net_pay(*star_facts(spark)).count() == 3
    assert plan(slip).count("Exchange hashpartitioning") == 1


def test_department_and_period_reports(spark, rows):
    e, d, t, p = star_facts(spark)
    (row,) = analytics.ytd_by_department(e, p).collect()
    assert (row["employee_count"], row["ytd_earnings"], row["avg_amount_per_row"], row["avg_per_employee"]) == (2, Decimal(161), 40.25, 80.5)
    assert [r["total_earnings"] for r in analytics.period_earnings(e, p, 26).collect()] == [Decimal(150), Decimal(10)]
    totals = {r["PAY_PERIOD_ID"]: (r["row_count"], r["change_from_previous"]) for r in analytics.period_totals(e, "EARNING_AMOUNT").collect()}
    assert totals == {25: (1, None), 26: (4, Decimal(164))}
    wide = {r["PAY_PERIOD_ID"]: r for r in analytics.multi_fact(e, d, t).collect()}
    assert (wide[25]["deductions_total"], wide[25]["taxes_rows"], wide[26]["earnings_rows"]) == (None, 1, 4)


def test_star_reads_prune_partitions_and_columns(spark, plan, tmp_path):
    path = str(tmp_path / "f")
    e = star_facts(spark)[0].withColumn("UNUSED", F.lit("x"))
    replace_partitions(e, path, ["PAY_PERIOD_ID"])
    text = plan(analytics.period_earnings(spark.read.parquet(path), star_facts(spark)[3], 26))
    scan = next(line for line in text.splitlines() if "FileScan parquet" in line)
    assert "PartitionFilters: [isnotnull(PAY_PERIOD_ID" in scan and "UNUSED" not in scan
    point = plan(analytics.employee_period(spark.read.parquet(path), 1, 26))
    assert "PushedFilters: [IsNotNull(EMPLOYEE_KEY), EqualTo(EMPLOYEE_KEY,1)]" in point


def test_compaction(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    spark.range(1000).repartition(20).write.parquet(source)
    layout.compact_files(spark, source, target)
    stats = [layout.file_stats(spark, p).first() for p in (source, target)]
    assert [(s["file_count"], s["row_count"]) for s in stats] == [(20, 1000), (1, 1000)]


def test_compaction_keeps_partitions(spark, rows, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    df = spark.range(100).select("id", (F.col("id") % 2).cast("int").alias("p"))
    df.repartition(6).write.partitionBy("p").parquet(source)
    layout.compact_files(spark, source, target, partition_by=["p"])
    assert (tmp_path / "t" / "p=1").is_dir() and rows(spark.read.parquet(target), "id", "p") == rows(df)


def test_compact_one_partition(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(100).select("id", (F.col("id") % 2).alias("p"))
    for _ in range(3):
        append_rows(df.repartition(4), path, ["p"])
    assert layout.compact_partition(spark, path, ["p"], "p = 1", str(tmp_path / "stage")) == 150
    files = {p: layout.file_stats(spark, f"{path}/p={p}").first()["file_count"] for p in (0, 1)}
    assert files[1] == 1 and files[0] > 1 and spark.read.parquet(path).count() == 300
    large, bytes_a_file = str(tmp_path / "large"), 1 << 20
    spark.range(400000).select(F.xxhash64("id").alias("v"), F.lit(1).alias("p")).repartition(24).write.partitionBy("p").parquet(large)
    layout.compact_partition(spark, large, ["p"], "p = 1", str(tmp_path / "stage2"), bytes_a_file)
    sizes = [f.stat().st_size for f in (tmp_path / "large" / "p=1").glob("*.parquet")]
    assert len(sizes) < 24 and max(sizes) <= bytes_a_file * 1.25


@pytest.mark.parametrize("columns", [["a"], ["a", "s"], ["d", "a", "s"], ["a", "s", "d", "f"]])
def test_clustering_keeps_rows_and_skips_files(spark, tmp_path, columns):
    df = spark.range(4000).select(
        (F.hash("id") % 100).alias("a"), F.concat(F.lit("Name#"), F.lpad((F.col("id") % 97).cast("string"), 3, "0")).alias("s"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("d"), (F.col("id") % 7).cast("double").alias("f"),
    )
    path = str(tmp_path / "z")
    layout.cluster_zorder(df, columns, files=16).write.parquet(path)
    after = spark.read.parquet(path)
    assert after.count() == 4000 and after.exceptAll(df).count() == 0
    point = {"a": 7, "s": "Name#050"} if "s" in columns else {"a": 7}
    seen = layout.files_matching(after, point).first()
    assert seen["files_matched"] <= seen["files"] * 0.75


def test_clustering_splits_copies(spark):
    copies = spark.range(0, 8000, numPartitions=8).select(F.lit(1).alias("a"), F.lit("x").alias("b"))
    sizes = layout.cluster_zorder(copies, ["a"], files=4).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 8000 * 0.6
    with pytest.raises(ValueError):
        layout.cluster_zorder(copies, [])


def test_statistics(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS measured")
    spark.range(10).write.option("path", str(tmp_path / "m")).saveAsTable("measured")
    got = {r["info_name"]: r["info_value"] for r in layout.table_statistics(spark, "measured", ["id"]).collect()}
    assert got["max"] == "9" and got["num_nulls"] == "0"
    spark.sql("DROP TABLE measured")


def test_file_statistics_read_no_row(spark, plan, tmp_path):
    path = str(tmp_path / "f")
    spark.range(300).select("id", (F.col("id") % 3).alias("p")).repartition(2).write.partitionBy("p").parquet(path)
    found = layout.file_stats(spark, path)
    text = plan(found)
    assert "PushedAggregation: [COUNT(*)]" in text and "content" not in text
    row = found.first()
    sizes = [f.stat().st_size for f in (tmp_path / "f").rglob("*.parquet")]
    assert (row.file_count, row.size_bytes, row.row_count) == (len(sizes), sum(sizes), 300)
    assert layout.file_stats(spark, path, count_rows=False).first().row_count is None


def test_statistics_read_changed_folders_only(spark, tmp_path):
    path, store = str(tmp_path / "t"), str(tmp_path / "s")
    def part(p, low, high):
        return spark.range(low, high).select(F.nullif("id", F.lit(5)).alias("id"), F.lit(None).cast("double").alias("d"), F.lit(p).alias("p"))
    def read():
        return {r.column_name: r for r in merged_statistics(spark, store).collect()}
    replace_partitions(part("a b", 0, 100).union(part("x/y", 50, 200)).union(part("1%2", 0, 10)), path, ["p"])
    assert refresh_statistics(spark, path, store) == 3 and refresh_statistics(spark, path, store) == 0
    row = read()["id"]
    assert (row.row_count, row.num_nulls, row.min, row.max) == (260, 2, "0", "199") and abs(row.distinct_count - 199) <= 4
    assert (read()["d"].num_nulls, read()["d"].min, read()["d"].distinct_count, read()["p"].max) == (260, None, 0, "x/y")
    replace_partitions(part("x/y", 1000, 1001), path, ["p"])
    remove_partitions(spark, path, ["p"], [("1%2",)])
    assert refresh_statistics(spark, path, store) == 1
    assert (read()["id"].row_count, read()["id"].max) == (101, "1000")
    assert refresh_statistics(spark, path, store, ["id"]) == 2 and list(read()) == ["id"]


def sample_entity():
    return Entity(
        "fact_x", {"k": "string", "p": "int", "v": "int", "at": "timestamp"}, ["k", "p"], order=["at"],
        rules=lambda: [q.not_null("k"), q.in_period_range("p")], partition="p",
    )


X = "k STRING, p INT, v INT, at STRING"


@pytest.mark.parametrize("delay", [None, "10 days"])
def test_stream_equals_batch(spark, rows, tmp_path, delay):
    """Three landings: a newer version, a late older one, exact repeats, and rejects."""
    bronze, path, new, state = (str(tmp_path / n) for n in ("bronze", "silver", "new", "state"))
    entity = sample_entity()
    batches = [
        [("a", 1, 1, "2024-01-01"), ("b", 1, 1, "2024-01-01"), (None, 1, 1, "2024-01-01")],
        [("a", 1, 2, "2024-01-03"), ("c", 2, 1, "2024-01-02"), ("c", 30, 1, "2024-01-02")],
        [("a", 1, 9, "2024-01-02"), ("a", 1, 2, "2024-01-03"), ("d", 2, 1, "2024-01-03")],
    ]
    for i, batch in enumerate(batches):
        pages = landing.bronze_envelope(spark.createDataFrame(batch, X), "fact_x", "p", ingested_at=f"2024-02-0{i + 1}")
        append_rows(pages, bronze, landing.RAW_PARTITIONS)
        late = {"event_time": "at", "delay": delay} if delay else {}
        run = stream_bronze_to_silver(spark, bronze, Warehouse.RAW_SCHEMA, entity, new, state, **late)
        run.awaitTermination()
        if i == 0:
            settle(spark, entity, path, new)
    streamed = rows(latest_rows(spark, entity, path, new), "k", "p", "v")
    settle(spark, entity, path, new)
    assert rows(spark.read.parquet(path), "k", "p", "v") == streamed
    assert settle(spark, entity, path, new) == 0
    pages = spark.read.schema(Warehouse.RAW_SCHEMA).parquet(bronze)
    assert streamed == rows(silver(pages, entity, "2024-03-01"), "k", "p", "v")
    assert streamed == [("a", 1, 2), ("b", 1, 1), ("c", 2, 1), ("d", 2, 1)]


@pytest.mark.parametrize("delay", [None, "10 days"])
def test_streamed_table_equals_the_batch_table_with_new_columns(spark, rows, tmp_path, delay):
    """A column appears, then widens from whole numbers to text; a record is rejected and a page is broken."""
    entity = sample_entity()
    late = {"event_time": "at", "delay": delay} if delay else {}
    batches = [
        '[{"k":"a","p":1,"v":1,"at":"2024-01-01"},{"k":"b","p":2,"v":1,"at":"2024-01-01"},{"k":null,"p":1,"v":3,"at":"2024-01-01"}]',
        '[{"k":"a","p":1,"v":2,"at":"2024-01-03","bonus":7},{"k":"c","p":1,"v":"x","at":"2024-01-02","bonus":3}]',
        '[{"k":"c","p":1,"v":5,"at":"2024-01-02","bonus":9},{"k":"b","p":2,"v":9,"at":"2023-01-01"}]',
        '[{"k":"d","p":1,"v":2,"at":"2024-01-03","bonus":"none","extra":{"n":1}},{"k":"c","p":1,"v":5,"at":"2024-01-02","bonus":3}]',
        '[{"k":"d","p":1,"v":2',
    ]
    stream, batch = (Warehouse(spark, str(tmp_path / n), entities={"fact_x": entity}) for n in ("stream", "batch"))
    for i, payload in enumerate(batches):
        page = landing.bronze_envelope(spark.createDataFrame([("z", 1)], "k STRING, p INT"), "fact_x", "p", ingested_at="2024-02-01")
        page = page.withColumns({"payload_json": F.lit(payload), "record_count": F.lit(2), "ingestion_id": F.lit(f"page{i}")})
        for w in (stream, batch):
            append_rows(page, w.path("bronze", "extracts"), landing.RAW_PARTITIONS)
        stream.stream_silver("fact_x", "2024-03-01", **late).awaitTermination()
        if i in (0, 2, 4):
            assert stream.settle_silver("fact_x") > 0
            assert stream.settle_silver("fact_x") == 0
    batch.build_silver("fact_x", "2024-03-01")
    one, two = stream.silver("fact_x"), batch.silver("fact_x")
    assert {(f.name.lower(), f.dataType.simpleString()) for f in one.schema} == {(f.name.lower(), f.dataType.simpleString()) for f in two.schema}
    columns = sorted(one.columns)
    assert rows(one, *columns) == rows(two, *columns) and one.count() == 4
    lost = ["ingestion_id", "outcome", "reasons", "records", "partition_column"]
    assert rows(stream.rejects(), *lost) == rows(batch.rejects(), *lost) and stream.rejects().count() == 3


def test_settle_only_touches_the_periods_of_the_increments(spark, rows, tmp_path):
    path, new, entity = str(tmp_path / "t"), str(tmp_path / "n"), sample_entity()
    ddl = "k STRING, p INT, v INT, at TIMESTAMP, source_file_id STRING"
    day = datetime.datetime(2024, 1, 1)
    replace_partitions(spark.createDataFrame([("a", 1, 1, day, "f"), ("b", 2, 1, day, "f")], ddl), path, ["p"])
    kept = sorted(p.name for p in (tmp_path / "t" / "p=1").iterdir())
    fresh = spark.createDataFrame([("b", 2, 5, day + datetime.timedelta(1), "g")], ddl).withColumn("batch_id", F.lit(0))
    replace_partitions(fresh, new, ["batch_id", "p"])
    assert settle(spark, entity, path, new) == 1
    assert rows(spark.read.parquet(path), "k", "v") == [("a", 1), ("b", 5)]
    assert sorted(p.name for p in (tmp_path / "t" / "p=1").iterdir()) == kept
