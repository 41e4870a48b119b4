"""Queries over the raw layer: landing, routing, sinks and the raw table's own questions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.typing import parse_payload
from strata.session import scratch_path
from strata.sources import landing
from strata.sources.catalog import catalog_load, check_catalog
from strata.sources.tables import append_rows, overwrite_snapshot, read_snapshot, replace_partitions
from strata.suite.registry import Layers, query
from strata.suite.samples import EARLY, FINAL, Samples

EVENT_FIELDS = "event_id BIGINT, happened_at STRING, user_id BIGINT, `value` DOUBLE, props STRING, event_type STRING, `day` INT"
RUN_1, RUN_2 = "2024-01-31 06:00:00", "2024-02-15 06:00:00"


def event_pages(s: Samples) -> DataFrame:
    """Raw rows of the events: all of them, and a second run with the larger ones."""
    records = s.event_records()
    entity = F.col("event_type")
    first = landing.bronze_envelope(records, entity, "day", ingested_at=RUN_1)
    large = records.where(F.col("value") >= 100)
    return first.unionByName(landing.bronze_envelope(large, entity, "day", ingested_at=RUN_2))


@query(
    "bronze_envelope",
    """SELECT 'fact_earnings' AS entity_name, lpad(CAST(pay_period_id AS VARCHAR), 2, '0') AS partition_column,
         count(*) AS records, count(*) AS payload_records, TRUE AS pages_in_size
       FROM earn_rec GROUP BY pay_period_id""",
)
def bronze_envelope(s: Samples, l: Layers) -> DataFrame:
    pages = landing.bronze_envelope(s.earnings_records(), "fact_earnings", "pay_period_id", ingested_at=RUN_1)
    return pages.groupBy("entity_name", "partition_column").agg(
        F.sum("record_count").alias("records"),
        F.sum(F.json_array_length("payload_json")).alias("payload_records"),
        (F.max("record_count") <= 500).alias("pages_in_size"),
    )


@query(
    "landing_read",
    "SELECT event_type, count(*) AS records, CAST(sum(day(ts)) AS BIGINT) AS days, TRUE AS from_files FROM events GROUP BY event_type",
)
def landing_read(s: Samples, l: Layers) -> DataFrame:
    path = scratch_path(s.spark, "landing")
    pages = landing.bronze_envelope(s.event_records(), F.col("event_type"), "day", ingested_at=RUN_1)
    pages.select("payload_json").write.option("maxRecordsPerFile", 1).text(path)
    records = parse_payload(
        landing.landing_read(s.spark, path), EVENT_FIELDS, keep=["api_endpoint", "file_name"]
    )
    return records.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum("day").alias("days"),
        F.bool_and(F.col("api_endpoint").endswith(F.col("file_name"))).alias("from_files"),
    )


@query(
    "partition_route",
    """SELECT event_type, CASE WHEN event_type = 'error' THEN 'FULL_LOAD' ELSE lpad(CAST(day(ts) AS VARCHAR), 2, '0') END
         AS partition_column, count(*) AS n
       FROM events GROUP BY ALL""",
)
def partition_route(s: Samples, l: Layers) -> DataFrame:
    catalog = s.entity_catalog().select(F.col("entity_name").alias("event_type"), "load_type")
    routed = landing.partition_route(s.event_records().join(catalog, "event_type"), "load_type", "day")
    return routed.groupBy("event_type", "partition_column").agg(F.count(F.lit(1)).alias("n"))


@query(
    "replace_partitions",
    """SELECT pay_period_id, count(*) AS n, CAST(sum(earning_amount) AS DECIMAL(20,2)) AS amount FROM earn_rec
       WHERE pay_period_id <> 25 AND (pay_period_id <> 26 OR hours >= 10) GROUP BY pay_period_id""",
)
def replace_partitions_(s: Samples, l: Layers) -> DataFrame:
    """All periods are written; then 25 and 26 run again, and 25 has no rows this time."""
    path = scratch_path(s.spark, "replace")
    records = s.earnings_records().select("pay_period_id", "earning_amount", "hours")
    replace_partitions(records, path, ["pay_period_id"])
    again = records.where("pay_period_id = 26 AND hours >= 10")
    for _ in range(2):
        replace_partitions(again, path, ["pay_period_id"], targets=[(25,), (26,)])
    return s.spark.read.parquet(path).groupBy("pay_period_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("earning_amount").alias("amount")
    )


@query(
    "append_fact",
    "SELECT pay_period_id, count(*) AS n, CAST(sum(tax_amount) AS DECIMAL(20,2)) AS amount FROM tax_rec GROUP BY pay_period_id",
)
def append_fact(s: Samples, l: Layers) -> DataFrame:
    path = scratch_path(s.spark, "append")
    records = s.taxes_records().select("pay_period_id", "tax_amount")
    for part in ("pay_period_id <= 20", "pay_period_id > 20"):
        append_rows(records.where(part), path, ["pay_period_id"])
    return s.spark.read.parquet(path).groupBy("pay_period_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("tax_amount").alias("amount")
    )


@query(
    "overwrite_snapshot",
    """SELECT f.employee_number, f.job_title, e.employee_number IS NULL AS is_new
       FROM emp_final f LEFT JOIN emp_early e ON e.employee_number = f.employee_number""",
)
def overwrite_snapshot_(s: Samples, l: Layers) -> DataFrame:
    """The second snapshot is computed from the first one while it replaces it."""
    base = scratch_path(s.spark, "snapshot")
    overwrite_snapshot(s.employees(EARLY).select("employee_number", "job_title", F.lit(True).alias("is_new")), base)
    known = read_snapshot(s.spark, base).select("employee_number", F.lit(False).alias("is_new"))
    fresh = s.employees(FINAL).select("employee_number", "job_title")
    both = fresh.join(known, "employee_number", "left").fillna(True, ["is_new"])
    overwrite_snapshot(both, base)
    return read_snapshot(s.spark, base)


@query(
    "bronze_read_entity",
    "SELECT '26' AS partition_column, count(*) AS records FROM earn_rec WHERE pay_period_id = 26",
)
def bronze_read_entity(s: Samples, l: Layers) -> DataFrame:
    rows = landing.bronze_read_entity(l.bronze("fact_earnings"), "fact_earnings", 26)
    return rows.groupBy("partition_column").agg(F.sum("record_count").alias("records"))


@query(
    "bronze_latest_snapshot",
    f"SELECT TIMESTAMP '{FINAL} 06:00:00' AS ingestion_datetime, count(*) AS records FROM emp_final",
)
def bronze_latest_snapshot(s: Samples, l: Layers) -> DataFrame:
    loads = [
        landing.bronze_envelope(s.employee_records(day), "dim_employee", None, ingested_at=f"{day} 06:00:00")
        for day in (FINAL, EARLY)
    ]
    newest = landing.bronze_latest_snapshot(loads[0].unionByName(loads[1]), "dim_employee")
    return newest.groupBy("ingestion_datetime").agg(F.sum("record_count").alias("records"))


@query(
    "bronze_runs_by_period",
    f"""SELECT lpad(CAST(day(ts) AS VARCHAR), 2, '0') AS period_id,
         CAST(1 + max(CASE WHEN value >= 100 THEN 1 ELSE 0 END) AS BIGINT) AS ingestion_runs,
         CASE WHEN max(value) >= 100 THEN TIMESTAMP '{RUN_2}' ELSE TIMESTAMP '{RUN_1}' END AS latest_ingestion
       FROM events GROUP BY day(ts)""",
)
def bronze_runs_by_period(s: Samples, l: Layers) -> DataFrame:
    return landing.bronze_runs_by_period(event_pages(s))


@query(
    "bronze_partition_sizes",
    """SELECT lpad(CAST(day(ts) AS VARCHAR), 2, '0') AS partition_column, event_type AS entity_name,
         count(*) + count(*) FILTER (WHERE value >= 100) AS total_records, TRUE AS has_rows
       FROM events GROUP BY day(ts), event_type""",
)
def bronze_partition_sizes(s: Samples, l: Layers) -> DataFrame:
    sizes = landing.bronze_partition_sizes(event_pages(s))
    return sizes.select("partition_column", "entity_name", "total_records", (F.col("row_count") > 0).alias("has_rows"))


@query(
    "bronze_data_age",
    """SELECT event_type AS entity_name, lpad(CAST(day(ts) AS VARCHAR), 2, '0') AS partition_column, min(ts) AS oldest_data,
         CAST(date_diff('day', CAST(min(ts) AS DATE), DATE '2024-04-15') AS INTEGER) AS age_days
       FROM events GROUP BY event_type, day(ts)
       HAVING date_diff('day', CAST(min(ts) AS DATE), DATE '2024-04-15') > 90""",
)
def bronze_data_age(s: Samples, l: Layers) -> DataFrame:
    landed = s.events().select(
        F.col("event_type").alias("entity_name"),
        F.lpad(F.dayofmonth("ts").cast("string"), 2, "0").alias("partition_column"),
        F.col("ts").alias("ingestion_datetime"),
    )
    return landing.bronze_data_age(landed, "2024-04-15")


def site_catalog(s: Samples) -> DataFrame:
    """A catalog with one table per site: its departments are the columns to update."""
    departments = s.employees().groupBy("location_code").agg(
        F.array_sort(F.collect_set("department")).alias("update_columns")
    )
    region = s.location_records().select("location_code", "region")
    return departments.join(region, "location_code").select(
        F.col("location_code").alias("table_name"),
        F.lit("DIMENSION").alias("table_type"),
        F.concat(F.lit("Site in "), F.col("region")).alias("description"),
        F.struct(
            F.lit("silver").alias("lakehouse"), F.lit("sens").alias("schema"), F.col("location_code").alias("table")
        ).alias("silver_source"),
        F.struct(F.col("location_code").alias("table")).alias("gold_target"),
        F.struct(
            F.lit(None).cast("string").alias("business_key"), F.lit("K").alias("surrogate_key"), F.lit(1).alias("surrogate_start_value")
        ).alias("keys"),
        "update_columns",
        F.slice("update_columns", 1, 2).alias("zorder_columns"),
        F.struct(F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("type")).alias("watermark"),
        F.array().cast("array<struct<business_key_column:string>>").alias("dimension_lookups"),
        F.array().cast("array<struct<source:string>>").alias("fact_columns"),
        F.struct(F.lit(False).alias("enabled"), F.array().cast("array<string>").alias("columns")).alias("partitioning"),
        (F.col("region") != "AFRICA").alias("is_active"),
    )


_SITES = """SELECT location_code AS table_name, department AS column_name,
    CAST(row_number() OVER (PARTITION BY location_code ORDER BY department) AS INTEGER) AS sort_order
  FROM (SELECT DISTINCT location_code, department FROM emp_final)"""


@query(
    "catalog_load",
    f"""SELECT table_name, column_name, sort_order, 'update' AS kind FROM ({_SITES})
         WHERE table_name NOT IN (SELECT location_code FROM loc WHERE region = 'AFRICA')
       UNION ALL SELECT table_name, column_name, sort_order, 'cluster' FROM ({_SITES})
         WHERE sort_order <= 2 AND table_name NOT IN (SELECT location_code FROM loc WHERE region = 'AFRICA')""",
)
def catalog_load_(s: Samples, l: Layers) -> DataFrame:
    """The column lists of the active sites; the packaged catalog is read by the unit tests."""
    control = catalog_load(site_catalog(s), RUN_1)
    listed = {"update": control["gold_update_columns"], "cluster": control["gold_zorder_columns"]}
    sides = [
        df.join(control["gold_catalog"].select("table_name"), "table_name", "left_semi").select(
            "table_name", "column_name", "sort_order", F.lit(kind).alias("kind")
        )
        for kind, df in listed.items()
    ]
    return sides[0].unionByName(sides[1])


@query(
    "check_catalog",
    """SELECT DISTINCT location_code AS table_name, lower(department) AS column_name FROM emp_final
       EXCEPT SELECT location_code, lower(department) FROM emp_final WHERE termination_date IS NOT NULL
       UNION ALL SELECT table_name, column_name FROM (SELECT location_code AS table_name, department AS column_name,
         row_number() OVER (PARTITION BY location_code ORDER BY department) AS r
         FROM (SELECT DISTINCT location_code, department FROM emp_final)) WHERE r <= 2""",
)
def check_catalog_(s: Samples, l: Layers) -> DataFrame:
    """Departments listed in the catalog of sites, against those some employee has left."""
    left = s.employees().where("termination_date IS NOT NULL").select(
        F.col("location_code").alias("table_name"), F.lower("department").alias("column_name")
    )
    return check_catalog(site_catalog(s), left.distinct())


@query(
    "api_status_summary",
    """SELECT event_type AS entity_name, CASE event_id % 4 WHEN 0 THEN 'OK' WHEN 1 THEN 'AUTH' WHEN 2 THEN 'RATE_LIMIT'
         ELSE 'FATAL' END AS status_class, count(*) AS calls
       FROM events GROUP BY ALL""",
)
def api_status_summary(s: Samples, l: Layers) -> DataFrame:
    return landing.api_status_summary(s.api_calls())


@query(
    "api_quota_usage",
    """SELECT entity_name, api_call_timestamp, count(*) AS calls, CAST(max(n) AS BIGINT) AS calls_last_hour,
         max(n) > 5 AS over_quota
       FROM (SELECT event_type AS entity_name, ts AS api_call_timestamp, count(*) OVER (PARTITION BY event_type
               ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS n FROM events)
       GROUP BY entity_name, api_call_timestamp""",
)
def api_quota_usage(s: Samples, l: Layers) -> DataFrame:
    return landing.api_quota_usage(s.api_calls(), quota=5)
