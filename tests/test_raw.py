import json

import pytest
from pyspark.sql import functions as F

from strata.functions.expr import partition_value, pay_period, status_class
from strata.operators.typing import parse_payload
from strata.sources import landing, tables
from strata.sources.catalog import catalog_load, check_catalog, read_catalog, table_configs

AT = "2024-05-01 06:00:00"


def test_envelope_keeps_every_record_in_pages_of_the_given_size(spark):
    records = spark.range(1234).select("id", F.lit(3).alias("period"))
    pages = landing.bronze_envelope(records, "fact_x", "period", page_size=100, ingested_at=AT)
    found = pages.agg(F.sum("record_count"), F.max("record_count")).first()
    assert (found[0], found[1] <= 100) == (1234, True)
    back = parse_payload(pages, "id BIGINT, period INT", keep=["partition_column"])
    assert back.agg(F.count_distinct("id"), F.min("partition_column")).first()[:] == (1234, "03")


def test_envelope_spreads_copies_of_one_record(spark):
    """A record repeated many times over several input partitions does not meet in one slice."""
    copies = spark.range(0, 4000, numPartitions=8).select(F.lit("same").alias("name"), F.lit(1).alias("period"))
    pages = landing.bronze_envelope(copies, "fact_x", "period", page_size=5000, ingested_at=AT)
    sizes = [r["record_count"] for r in pages.select("record_count").collect()]
    assert sum(sizes) == 4000 and max(sizes) <= 1000


def test_envelope_reads_its_source_once_and_moves_it_once(spark, plan, tmp_path):
    spark.range(1000).select("id", F.lit(3).alias("period")).write.parquet(str(tmp_path / "r"))
    records = spark.read.parquet(str(tmp_path / "r"))
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    pages = landing.bronze_envelope(records, "fact_x", "period", ingested_at=AT)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before, "no job runs ahead"
    text = plan(pages)
    assert (text.count("FileScan"), text.count("Exchange")) == (1, 1)


def test_envelope_deals_large_partitions_over_slices(spark):
    records = spark.range(0, 1000, numPartitions=1).select("id", F.lit(3).alias("period"))
    pages = landing.bronze_envelope(records, "fact_x", "period", page_size=5000, ingested_at=AT, spread=4)
    sizes = [r["record_count"] for r in pages.select("record_count").collect()]
    assert len(sizes) == 4 and sum(sizes) == 1000 and max(sizes) < 400


def test_envelope_of_a_snapshot_and_of_nothing(spark):
    one = landing.bronze_envelope(spark.range(1), "dim_x", None, ingested_at=AT, endpoint="/x", status=200)
    row = one.first()
    assert (row["partition_column"], row["api_endpoint"], json.loads(row["payload_json"])) == ("FULL_LOAD", "/x", [{"id": 0}])
    assert landing.bronze_envelope(spark.range(0), "dim_x", None, ingested_at=AT).count() == 0


def test_partition_value(spark, rows):
    df = spark.createDataFrame([("FULL_LOAD", None), ("INCREMENTAL", 5), ("INCREMENTAL", 26), ("INCREMENTAL", 202601)], "k STRING, p INT")
    assert rows(df.select(partition_value("k", "p"))) == [("05",), ("202601",), ("26",), ("FULL_LOAD",)]
    with pytest.raises(Exception, match="unknown load type"):
        spark.createDataFrame([("DAILY", 1)], "k STRING, p INT").select(partition_value("k", "p")).collect()


def test_pay_period_bounds(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-12-31')) AS d")
    found = days.groupBy(pay_period("d").alias("p")).count().orderBy("p").collect()
    assert [r["p"] for r in found] == list(range(1, 27))
    assert {r["count"] for r in found[:-1]} == {14} and found[-1]["count"] == 16


def test_status_classes(spark, rows):
    df = spark.createDataFrame([(c,) for c in (200, 401, 404, 429, 500, 502, 503)], "c INT")
    got = dict(rows(df.select("c", status_class("c"))))
    assert got == {200: "OK", 401: "AUTH", 404: "FATAL", 429: "RATE_LIMIT", 500: "FATAL", 502: "FATAL", 503: "FATAL"}


def test_quota_counts_match_brute_force(spark, rows):
    seconds = [0, 0, 59, 60, 1800, 3599, 3600, 3601, 7199, 7200, 7260, 20000]
    calls = spark.createDataFrame([("a", s) for s in seconds] + [("b", 5)], "entity_name STRING, s INT").select(
        "entity_name", F.timestamp_seconds(F.lit(1704067200) + F.col("s")).alias("api_call_timestamp"), "s"
    )
    got = landing.api_quota_usage(calls, quota=4)
    found = {
        (r["entity_name"], int(r["sec"])): (r["calls"], r["calls_last_hour"], r["over_quota"])
        for r in got.withColumn("sec", F.unix_timestamp("api_call_timestamp") - 1704067200).collect()
    }
    for s in set(seconds):
        n = sum(1 for x in seconds if s - 3600 <= x <= s)
        assert found[("a", s)] == (seconds.count(s), n, n > 4), s
    assert found[("b", 5)] == (1, 1, False)


def test_replace_partitions_is_repeatable_and_empties_targets(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "p INT, v STRING")
    assert tables.replace_partitions(first, path, ["p"]) == 3
    again = spark.createDataFrame([(2, "x"), (2, "y")], "p INT, v STRING")
    for _ in range(2):
        assert tables.replace_partitions(again, path, ["p"], targets=[(2,), (3,), (9,)]) == 2
    assert rows(spark.read.parquet(path), "p", "v") == [(1, "a"), (2, "x"), (2, "y")]


def test_replace_partitions_with_text_and_null_values(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a b", 1), ("c=d", 2), (None, 3)], "p STRING, v INT")
    tables.replace_partitions(df, path, ["p"])
    tables.replace_partitions(df.limit(0), path, ["p"], targets=[("c=d",), (None,)])
    assert rows(spark.read.parquet(path), "p", "v") == [("a b", 1)]


def test_snapshot_can_be_computed_from_itself(spark, rows, tmp_path):
    base = str(tmp_path / "s")
    assert not tables.snapshot_exists(spark, base)
    tables.overwrite_snapshot(spark.range(2), base)
    tables.overwrite_snapshot(tables.read_snapshot(spark, base).withColumn("id", F.col("id") + 10), base, "zstd")
    assert rows(tables.read_snapshot(spark, base)) == [(10,), (11,)]
    with pytest.raises(FileNotFoundError):
        tables.read_snapshot(spark, str(tmp_path / "none"))


def test_raw_table_reads_prune_partitions(spark, plan, tmp_path):
    path = str(tmp_path / "raw")
    records = spark.range(40).select("id", (F.col("id") % 3 + 1).cast("int").alias("period"))
    tables.replace_partitions(landing.bronze_envelope(records, "fact_x", "period", ingested_at=AT), path, landing.RAW_PARTITIONS)
    bronze = spark.read.schema("payload_json STRING, record_count INT, partition_column STRING, entity_name STRING").parquet(path)
    one = landing.bronze_read_entity(bronze, "fact_x", 2)
    assert "PartitionFilters: [isnotnull(entity_name" in plan(one)
    assert one.agg(F.sum("record_count")).first()[0] == 13


def test_landing_read_keeps_the_file(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "p1.json").write_text('[{"x": 1},\n {"x": 2}]')
    (tmp_path / "p2.json").write_text('{"Data": [{"x": 3}]}')
    pages = landing.landing_read(spark, str(tmp_path))
    got = parse_payload(pages, "x INT", keep=["file_name"])
    assert sorted((r["file_name"], r["x"]) for r in got.collect()) == [("p1.json", 1), ("p1.json", 2), ("p2.json", 3)]


def test_catalog_tables(spark):
    control = catalog_load(read_catalog(spark), AT)
    names = [r["table_name"] for r in control["gold_catalog"].collect()]
    assert names[:2] == ["dwh_dim_employee", "dwh_dim_location"] and len(names) == 5
    updates = control["gold_update_columns"].where("table_name = 'dwh_dim_location'").orderBy("sort_order")
    assert [r["column_name"] for r in updates.collect()][:2] == ["LOCATION_NAME", "CITY"]
    clusters = control["gold_zorder_columns"].where("table_name = 'fact_payroll_taxes'").orderBy("sort_order")
    assert [r["column_name"] for r in clusters.collect()] == ["EMPLOYEE_KEY", "PAY_PERIOD_ID"]


def test_catalog_files_and_inactive_entries(spark, tmp_path):
    entries = [
        {"table_name": "d", "table_type": "DIMENSION", "silver_source": {"table": "s"}, "keys": {"business_key": "B"}, "is_active": True},
        {"table_name": "off", "table_type": "FACT", "silver_source": {"table": "s"}, "is_active": False},
    ]
    (tmp_path / "c.json").write_text(json.dumps(entries, indent=1))
    configs = table_configs(read_catalog(spark, [str(tmp_path)]))
    assert [(c.table_name, c.business_key, c.update_columns) for c in configs] == [("d", "B", [])]


def test_check_catalog_finds_unknown_columns(spark, rows):
    from strata.plans.layers import ENTITIES, GOLD_DIMENSIONS

    catalog = read_catalog(spark)
    known = [(e.name, c) for e in ENTITIES.values() for c in [*e.columns, "full_name", "employment_status", "total_earnings"]]
    known += [(t, f.split()[0]) for t, ddl in GOLD_DIMENSIONS.items() for f in ddl.split(",")]
    known += [(f"fact_payroll_{k}", c) for k in ("earnings", "deductions", "taxes") for c in ("EMPLOYEE_KEY", "PAY_PERIOD_ID")]
    columns = spark.createDataFrame(known, "table_name STRING, column_name STRING")
    assert check_catalog(catalog, columns).count() == 0
    fewer = columns.where("NOT (table_name = 'fact_taxes' AND column_name = 'tax_type')")
    assert rows(check_catalog(catalog, fewer)) == [("fact_taxes", "tax_type")]


def test_synthetic_employees_are_repeatable(spark, rows):
    one = landing.synthetic_employees(spark, 50, "2024-01-01")
    assert rows(one) == rows(landing.synthetic_employees(spark, 50, "2024-01-01"))
    assert rows(one) != rows(landing.synthetic_employees(spark, 50, "2024-01-01", seed=1))
    found = one.agg(F.min("EMPLOYEE_NUMBER"), F.min("SALARY") >= 40000, F.max("SALARY") <= 150000).first()
    assert found[:] == ("TEST00000", True, True)


def test_arranged_records_move_once_and_pages_lie_by_partition(spark, plan, tmp_path):
    records = spark.range(0, 9000, numPartitions=6).select("id", (F.col("id") % 9 + 1).cast("int").alias("p"))
    for entity, period in (("x", "p"), ("x", None), (F.concat(F.lit("e"), F.col("id") % 2), "p")):
        pages = landing.bronze_envelope(records, entity, period, ingested_at="2024-01-01", page_size=50, arranged=True)
        text = plan(pages)
        assert text.count("Exchange") == 1 and "rangepartitioning" in text
        where = F.spark_partition_id().alias("task")
        held = pages.select("partition_column", "entity_name", "record_count", where).groupBy("task").agg(
            F.count_distinct("partition_column", "entity_name").alias("parts"), F.sum("record_count").alias("records"))
        rows = held.collect()
        assert sum(r.records for r in rows) == 9000
        groups = pages.select("partition_column", "entity_name").distinct().count()
        # Ranges cut the partitions into one piece more for each further task.
        assert sum(r.parts for r in rows) <= groups + len(rows) - 1
        ids = pages.select(F.explode(F.from_json("payload_json", "array<struct<id: bigint>>")).alias("r")).select("r.id")
        assert ids.distinct().count() == 9000
