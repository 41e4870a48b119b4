"""Queries over the star loads: keys, merges, history, facts, watermarks and run logs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import control, star
from strata.operators.quality import employee_standardise
from strata.operators.skew import lookup_join
from strata.operators.typing import map_dimension_columns
from strata.plans.layers import empty_dimension, gold_dimension, gold_fact
from strata.session import local_rows, scratch_path, stored
from strata.sources.tables import append_rows
from strata.suite.registry import STAR, Layers, query
from strata.suite.samples import EARLY, FINAL, LOADED_AT, Samples

TRACKED = ["FULL_NAME", "DEPARTMENT", "JOB_TITLE", "TERMINATION_DATE"]


def snapshot(s: Samples, day: str) -> DataFrame:
    """Employees as the dimension load sees them."""
    return map_dimension_columns(employee_standardise(s.employee_records(day), day))


@query("assign_surrogate_keys", "SELECT bk AS EMPLOYEE_NUMBER, sk AS EMPLOYEE_KEY FROM emp_keys")
def assign_surrogate_keys(s: Samples, l: Layers) -> DataFrame:
    none = empty_dimension(s.spark, "dwh_dim_employee")
    first = star.assign_surrogate_keys(none, snapshot(s, EARLY), "EMPLOYEE_NUMBER", "EMPLOYEE_KEY")
    more = star.assign_surrogate_keys(first, snapshot(s, FINAL), "EMPLOYEE_NUMBER", "EMPLOYEE_KEY")
    return first.unionByName(more)


@query(
    "merge_dimension_scd1",
    f"""SELECT * REPLACE (CAST(CREATED_AT - INTERVAL 6 HOUR AS TIMESTAMP) AS CREATED_AT,
         CAST(UPDATED_AT - INTERVAL 6 HOUR AS TIMESTAMP) AS UPDATED_AT) FROM gold_emp""",
)
def merge_dimension_scd1(s: Samples, l: Layers) -> DataFrame:
    """Two loads and a repeat of the second, which must change nothing."""
    config = l.warehouse.config("dwh_dim_employee")
    state = empty_dimension(s.spark, "dwh_dim_employee")
    for day in (EARLY, FINAL, FINAL):
        merged = star.merge_dimension_scd1(
            state, snapshot(s, day), config.business_key, config.surrogate_key, config.update_columns, day
        )
        state = stored(merged, "merge")
    return state


@query("gold_dim_employee", "SELECT * FROM gold_emp")
def gold_dim_employee(s: Samples, l: Layers) -> DataFrame:
    early, config = l.early_dimension("dwh_dim_employee"), l.warehouse.config("dwh_dim_employee")
    return gold_dimension(early, l.silver("dim_employee"), config, f"{FINAL} 06:00:00")


@query("gold_dim_location", "SELECT * FROM gold_loc")
def gold_dim_location(s: Samples, l: Layers) -> DataFrame:
    early, config = l.early_dimension("dwh_dim_location"), l.warehouse.config("dwh_dim_location")
    return gold_dimension(early, l.silver("dim_location"), config, f"{FINAL} 06:00:00")


@query(
    "high_watermark",
    """SELECT table_name, max(CAST(watermark_value AS INTEGER)) AS last_value FROM exec_log
       WHERE status = 'SUCCESS' GROUP BY table_name""",
)
def high_watermark(s: Samples, l: Layers) -> DataFrame:
    return control.high_watermark(s.execution_log())


@query(
    "incremental_filter",
    "SELECT pay_period_id, count(*) AS n, CAST(sum(tax_amount) AS DECIMAL(20,2)) AS amount FROM silver_tax WHERE pay_period_id > 20 GROUP BY ALL",
)
def incremental_filter(s: Samples, l: Layers) -> DataFrame:
    fresh = star.incremental_filter(l.silver("fact_taxes"), "pay_period_id", "20", "int")
    return fresh.groupBy("pay_period_id").agg(F.count(F.lit(1)).alias("n"), F.sum("tax_amount").alias("amount"))


@query(
    "next_watermark",
    """SELECT event_type AS entity_name, 'int' AS watermark_type, CAST(max(day(ts)) + 1 AS VARCHAR) AS next_value
       FROM events GROUP BY ALL
       UNION ALL
       SELECT event_type, 'date', strftime(max(ts) + INTERVAL 1 DAY, '%Y-%m-%d') FROM events GROUP BY ALL
       UNION ALL
       SELECT event_type, 'timestamp', strftime(date_trunc('second', max(ts)) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S')
       FROM events GROUP BY ALL""",
)
def next_watermark(s: Samples, l: Layers) -> DataFrame:
    last = s.events().groupBy(F.col("event_type").alias("entity_name")).agg(
        F.max(F.dayofmonth("ts")).cast("string").alias("int"),
        F.max(F.to_date("ts")).cast("string").alias("date"),
        F.max(F.date_trunc("second", "ts")).cast("string").alias("timestamp"),
    )
    marks = last.unpivot(["entity_name"], ["int", "date", "timestamp"], "watermark_type", "last_processed_value")
    return control.next_watermark(marks).drop("last_processed_value")


@query(
    "watermark_upsert",
    f"""SELECT n.entity_name, 'hcm_api' AS source_system, 'day' AS watermark_column, 'int' AS watermark_type,
         n.last_processed_value, TIMESTAMP '{LOADED_AT}' AS last_ingestion_time, n.records_ingested, TRUE AS is_active,
         CASE WHEN o.entity_name IS NULL THEN TIMESTAMP '{LOADED_AT}' ELSE o.last_ingestion_time END AS created_at,
         TIMESTAMP '{LOADED_AT}' AS updated_at
       FROM marks n LEFT JOIN marks_20 o ON o.entity_name = n.entity_name AND o.entity_name <> 'view'""",
)
def watermark_upsert(s: Samples, l: Layers) -> DataFrame:
    known = s.watermarks(before_day=20).where("entity_name <> 'view'")
    return control.watermark_upsert(known, s.watermarks(), LOADED_AT)


@query(
    "period_worklist",
    """SELECT event_type AS entity_name, 'INCREMENTAL' AS load_type, CAST(p AS INTEGER) AS period,
         lpad(CAST(p AS VARCHAR), 2, '0') AS partition_column
       FROM (SELECT event_type, CAST(last_processed_value AS INTEGER) AS last
             FROM (SELECT entity_name AS event_type, last_processed_value FROM marks_20)),
         range(1, 27) r(p)
       WHERE event_type <> 'error' AND p > last
       UNION ALL SELECT 'error', 'FULL_LOAD', NULL, 'FULL_LOAD'""",
)
def period_worklist(s: Samples, l: Layers) -> DataFrame:
    return control.period_worklist(s.entity_catalog(), s.watermarks(before_day=20), 26)


@query(
    "fk_lookup",
    """SELECT EMPLOYEE_KEY, LOCATION_KEY, employee_number, location_code, pay_period_id, earning_code, earning_amount
       FROM late_earn""",
)
def fk_lookup(s: Samples, l: Layers) -> DataFrame:
    """Keys from the early dimension: employees hired later stay without one."""
    config = l.warehouse.config("fact_payroll_earnings")
    dims = {"dwh_dim_employee": l.early_dimension("dwh_dim_employee"), "dwh_dim_location": l.gold("dwh_dim_location")}
    keyed = star.fk_lookup(l.silver("fact_earnings"), dims, config.lookups)
    return keyed.select(
        "EMPLOYEE_KEY", "LOCATION_KEY", "employee_number", "location_code", "pay_period_id", "earning_code", "earning_amount"
    )


def _gold_fact(name: str, view: str) -> None:
    @query(f"gold_{name}", f"SELECT * FROM {view}")
    def run(s: Samples, l: Layers) -> DataFrame:
        """The two increments as one table: periods up to the first watermark, then the rest."""
        config = l.warehouse.config(STAR[name])
        dims = {t: l.gold(t) for t in ("dwh_dim_employee", "dwh_dim_location")}
        rows = l.silver(name)
        first = gold_fact(rows.where("pay_period_id <= 20"), dims, config, LOADED_AT)
        return first.unionByName(gold_fact(rows, dims, config, LOADED_AT, last=20))


for _name, _view in (("fact_earnings", "gold_earn"), ("fact_deductions", "gold_ded"), ("fact_taxes", "gold_tax")):
    _gold_fact(_name, _view)


@query(
    "execution_log_append",
    """SELECT execution_id, table_name, execution_start, execution_end, watermark_value, records_written, status,
         error_message FROM exec_log""",
)
def execution_log_append(s: Samples, l: Layers) -> DataFrame:
    """Start and end events appended to a log table, and the state of each execution read from it."""
    path = scratch_path(s.spark, "log")
    runs = s.execution_log()
    events = {
        "RUNNING": runs.withColumns(
            {
                "status": F.lit("RUNNING"), "created_at": F.col("execution_start"),
                "execution_end": F.lit(None).cast("timestamp_ntz"), "watermark_value": F.lit(None).cast("string"),
                "records_written": F.lit(0).cast("long"), "error_message": F.lit(None).cast("string"),
            }
        ),
        "ENDED": runs.withColumns(
            {"created_at": F.col("execution_end"), "execution_start": F.lit(None).cast("timestamp_ntz")}
        ),
    }
    for event in events.values():
        append_rows(event, path)
    state = control.execution_state(s.spark.read.parquet(path))
    return state.drop("records_read", "created_at")


@query(
    "failed_worklist",
    """SELECT table_name, day, execution_id, execution_start, watermark_value, error_message
       FROM (SELECT *, CAST(watermark_value AS INTEGER) AS day FROM exec_log
             QUALIFY row_number() OVER (PARTITION BY table_name, watermark_value
               ORDER BY execution_start DESC, execution_id DESC) = 1)
       WHERE status = 'FAILED'""",
)
def failed_worklist(s: Samples, l: Layers) -> DataFrame:
    log = s.execution_log().withColumn("day", F.col("watermark_value").cast("int"))
    return control.failed_worklist(log, ["table_name", "day"])


@query(
    "orchestrator_rollup",
    """SELECT orchestrator_run_id, min(job_start) AS run_start, max(job_end) AS run_end, CAST(count(*) AS INTEGER) AS total_jobs,
         CAST(count(*) FILTER (WHERE status = 'SUCCESS') AS INTEGER) AS successful_jobs,
         CAST(count(*) FILTER (WHERE status = 'FAILED') AS INTEGER) AS failed_jobs,
         string_agg(CASE WHEN status = 'FAILED' THEN job_name || ': ' || error_message END, '; ' ORDER BY job_name) AS error_summary,
         CASE WHEN count(*) FILTER (WHERE status = 'FAILED') = 0 THEN 'SUCCESS'
              WHEN count(*) FILTER (WHERE status = 'SUCCESS') = 0 THEN 'FAILED' ELSE 'PARTIAL' END AS status
       FROM (SELECT * FROM jobs QUALIFY row_number() OVER (PARTITION BY orchestrator_run_id, job_name
               ORDER BY job_start DESC, job_end DESC) = 1)
       GROUP BY orchestrator_run_id""",
)
def orchestrator_rollup(s: Samples, l: Layers) -> DataFrame:
    return control.orchestrator_rollup(s.job_log())


@query(
    "snapshot_change_feed",
    """SELECT f.employee_number AS EMPLOYEE_NUMBER, CASE WHEN e.employee_number IS NULL THEN 'insert' ELSE 'update' END AS change_type,
         e.job_title AS before_JOB_TITLE, f.job_title AS after_JOB_TITLE,
         e.termination_date AS before_TERMINATION_DATE, f.termination_date AS after_TERMINATION_DATE
       FROM emp_final f LEFT JOIN emp_early e ON e.employee_number = f.employee_number
       WHERE e.employee_number IS NULL OR e.job_title <> f.job_title
         OR e.termination_date IS DISTINCT FROM f.termination_date""",
)
def snapshot_change_feed(s: Samples, l: Layers) -> DataFrame:
    return star.snapshot_change_feed(
        l.early_dimension("dwh_dim_employee"), l.gold("dwh_dim_employee"), "EMPLOYEE_NUMBER",
        ["JOB_TITLE", "TERMINATION_DATE"],
    )


def history(s: Samples) -> DataFrame:
    """The dimension's history over the two snapshots."""
    state = local_rows(
        s.spark, [], "EMPLOYEE_NUMBER STRING, FULL_NAME STRING, DEPARTMENT STRING, JOB_TITLE STRING, TERMINATION_DATE DATE, "
        "EFFECTIVE_FROM DATE, EFFECTIVE_TO DATE, IS_CURRENT BOOLEAN"
    )
    for day in (EARLY, FINAL):
        state = star.merge_dimension_scd2(state, snapshot(s, day), "EMPLOYEE_NUMBER", TRACKED, day)
    return state


_STATE = "employee_number AS EMPLOYEE_NUMBER, full_name AS FULL_NAME, department AS DEPARTMENT, job_title AS JOB_TITLE, termination_date AS TERMINATION_DATE"
_CHANGED = """SELECT f.employee_number FROM emp_final f JOIN emp_early e ON e.employee_number = f.employee_number
  WHERE e.job_title <> f.job_title OR e.termination_date IS DISTINCT FROM f.termination_date"""


@query(
    "merge_dimension_scd2",
    f"""SELECT {_STATE}, DATE '{EARLY}' AS EFFECTIVE_FROM,
         CASE WHEN employee_number IN ({_CHANGED}) THEN DATE '{FINAL}' ELSE DATE '9999-12-31' END AS EFFECTIVE_TO,
         employee_number NOT IN ({_CHANGED}) AS IS_CURRENT FROM emp_early
       UNION ALL
       SELECT {_STATE}, DATE '{FINAL}', DATE '9999-12-31', TRUE FROM emp_final
       WHERE employee_number IN ({_CHANGED}) OR employee_number NOT IN (SELECT employee_number FROM emp_early)""",
)
def merge_dimension_scd2(s: Samples, l: Layers) -> DataFrame:
    return history(s)


@query(
    "dim_as_of",
    """SELECT e.job_title AS JOB_TITLE, count(*) AS rows, CAST(sum(earning_amount) AS DECIMAL(20,2)) AS amount
       FROM silver_earn s LEFT JOIN emp_early e ON e.employee_number = s.employee_number GROUP BY e.job_title""",
)
def dim_as_of(s: Samples, l: Layers) -> DataFrame:
    """Earnings by the job title employees held in 1998."""
    then = star.dim_as_of(history(s), "1998-06-30")
    titled = lookup_join(l.silver("fact_earnings"), then, [("employee_number", "EMPLOYEE_NUMBER")], ["JOB_TITLE"])
    return titled.groupBy("JOB_TITLE").agg(F.count(F.lit(1)).alias("rows"), F.sum("earning_amount").alias("amount"))
