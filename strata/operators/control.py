"""Watermarks, worklists and run logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions.expr import FULL_LOAD, partition_value, share, typed
from strata.operators.quality import dedup_latest
from strata.operators.skew import previous_value

EXECUTION_LOG = """
  execution_id STRING, table_name STRING, execution_start TIMESTAMP, execution_end TIMESTAMP,
  watermark_column STRING, watermark_value STRING, records_read BIGINT, records_written BIGINT,
  status STRING, error_message STRING, created_at TIMESTAMP
"""
WATERMARKS = """
  source_system STRING, entity_name STRING, watermark_column STRING, watermark_type STRING,
  last_processed_value STRING, last_ingestion_time TIMESTAMP, records_ingested BIGINT, is_active BOOLEAN,
  created_at TIMESTAMP, updated_at TIMESTAMP
"""
# Minutes allowed for a run, and the minutes at which it is reported as slow.
SLA_MINUTES = 70
WARN_MINUTES = 60


def high_watermark(log: DataFrame, kind: str = "int") -> DataFrame:
    """Highest value per table over its successful runs, compared as ``kind`` and not as text."""
    return (
        log.where(F.col("status") == "SUCCESS")
        .groupBy("table_name")
        .agg(F.max(typed("watermark_value", kind)).alias("last_value"))
    )


def last_watermark(log: DataFrame, table: str, kind: str = "int"):
    """The watermark of one table as a Python value, or None before its first success."""
    row = high_watermark(log.where(F.col("table_name") == table), kind).first()
    return row["last_value"] if row else None


def next_watermark(marks: DataFrame, kind: str = "watermark_type", value: str = "last_processed_value") -> DataFrame:
    """The value that follows: plus one, plus one hour, or plus one day, as text."""
    step = (
        F.when(F.col(kind) == "int", (typed(value, "int") + 1).cast("string"))
        .when(F.col(kind) == "timestamp", (typed(value, "timestamp") + F.expr("INTERVAL 1 HOUR")).cast("string"))
        .when(F.col(kind) == "date", F.date_add(typed(value, "date"), 1).cast("string"))
        .otherwise(F.raise_error(F.concat(F.lit("unknown watermark type: "), F.coalesce(kind, F.lit("NULL")))))
    )
    return marks.withColumn("next_value", step)


def watermark_upsert(marks: DataFrame, updates: DataFrame, as_of: str) -> DataFrame:
    """Watermark table after ``updates``, one row per (source_system, entity_name).

    ``updates`` holds the keys, watermark_column, watermark_type, last_processed_value and
    records_ingested. A first row is complete and active; an existing row keeps its creation time.
    """
    keys = ["source_system", "entity_name"]
    at = F.lit(as_of).cast("timestamp")
    fresh = updates.select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        *[
            F.col(c).alias(f"__{c}")
            for c in ("watermark_column", "watermark_type", "last_processed_value", "records_ingested")
        ],
    )
    both = marks.join(fresh, [F.col(k) == F.col(f"__{k}") for k in keys], "full_outer")
    new = F.col("__entity_name").isNotNull()
    first = F.col("entity_name").isNull()
    return both.select(
        F.coalesce("source_system", "__source_system").alias("source_system"),
        F.coalesce("entity_name", "__entity_name").alias("entity_name"),
        F.when(first, F.col("__watermark_column")).otherwise(F.col("watermark_column")).alias("watermark_column"),
        F.when(first, F.col("__watermark_type")).otherwise(F.col("watermark_type")).alias("watermark_type"),
        F.when(new, F.col("__last_processed_value"))
        .otherwise(F.col("last_processed_value"))
        .alias("last_processed_value"),
        F.when(new, at).otherwise(F.col("last_ingestion_time")).alias("last_ingestion_time"),
        F.when(new, F.col("__records_ingested")).otherwise(F.col("records_ingested")).alias("records_ingested"),
        F.when(first, F.lit(True)).otherwise(F.col("is_active")).alias("is_active"),
        F.when(first, at).otherwise(F.col("created_at")).alias("created_at"),
        F.when(new, at).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def period_worklist(catalog: DataFrame, marks: DataFrame, current: int) -> DataFrame:
    """(entity, period, partition) still to load: one row per open period, one for a snapshot."""
    active = marks.where("is_active").select(
        F.col("entity_name").alias("__entity"), typed("last_processed_value", "int").alias("__last")
    )
    known = catalog.where("is_active").join(active, F.col("entity_name") == F.col("__entity"), "left")
    last = F.coalesce("__last", F.col("start_period") - 1, F.lit(0))
    full = F.col("load_type") == FULL_LOAD
    # sequence() would count down once nothing is left, hence the test before it.
    periods = F.when(full, F.array(F.lit(None).cast("int"))).when(
        last < current, F.sequence((last + 1).cast("int"), F.lit(current))
    )
    return (
        known.where(full | (last < current))
        .select("entity_name", "load_type", F.explode(periods).alias("period"))
        .withColumn("partition_column", partition_value("load_type", "period"))
    )


def execution_log_append(
    spark, execution_id: str, table: str, at: str, status: str = "RUNNING", **values: object
) -> DataFrame:
    """One log event, to be appended. A run has a RUNNING event and a final one.

    A FAILED event carries its start, since a run may fail before it was logged as running.
    """
    row = {
        "execution_id": execution_id,
        "table_name": table,
        "status": status,
        "records_read": 0,
        "records_written": 0,
        "execution_start": at if status in ("RUNNING", "FAILED") else None,
        "execution_end": None if status == "RUNNING" else at,
        "created_at": at,
        **values,
    }
    fields = StructType.fromDDL(EXECUTION_LOG).fields
    return spark.range(1).select(*[F.lit(row.get(f.name)).cast(f.dataType).alias(f.name) for f in fields])


def execution_state(events: DataFrame) -> DataFrame:
    """One row per execution from its events: the latest status, with the start of the first event."""
    rest = [c for c in events.columns if c not in ("execution_id", "execution_start")]
    final = F.col("status") != "RUNNING"
    state = events.groupBy("execution_id").agg(
        F.min("execution_start").alias("execution_start"),
        F.max_by(F.struct(*rest), F.struct(final, "created_at", *rest)).alias("__latest"),
    )
    return state.select("execution_id", "execution_start", "__latest.*").select(*events.columns)


def failed_worklist(log: DataFrame, keys: Sequence[str] = ("table_name",)) -> DataFrame:
    """Tables whose last run failed, with the watermark to resume from.

    Of runs with one start the last is that with the greatest id; the ids of ``Warehouse`` begin with
    the number of the attempt.
    """
    latest = dedup_latest(log, keys, ["execution_start", "execution_id"])
    return latest.where(F.col("status") == "FAILED").select(
        *keys, "execution_id", "execution_start", "watermark_value", "error_message"
    )


def orchestrator_rollup(jobs: DataFrame) -> DataFrame:
    """Runs from their jobs: counts, status, and the errors of the failed jobs.

    A job restarted within a run counts with its last state, so a run holds at most one row for each
    job of the catalog and its error summary is as long as that.
    """
    latest = dedup_latest(jobs, ["orchestrator_run_id", "job_name"], ["job_start", "job_end"])
    failed = F.col("status") == "FAILED"
    error = F.when(failed, F.concat_ws(": ", "job_name", "error_message"))
    return (
        latest.groupBy("orchestrator_run_id")
        .agg(
            F.min("job_start").alias("run_start"),
            F.max("job_end").alias("run_end"),
            F.count(F.lit(1)).cast("int").alias("total_jobs"),
            F.count_if(F.col("status") == "SUCCESS").cast("int").alias("successful_jobs"),
            F.count_if(failed).cast("int").alias("failed_jobs"),
            F.count_if(F.col("status") == "RUNNING").cast("int").alias("__running"),
            F.nullif(F.array_join(F.array_sort(F.collect_list(error)), "; "), F.lit("")).alias("error_summary"),
        )
        .withColumn(
            "status",
            F.when(F.col("__running") > 0, "RUNNING")
            .when(F.col("failed_jobs") == 0, "SUCCESS")
            .when(F.col("successful_jobs") == 0, "FAILED")
            .otherwise("PARTIAL"),
        )
        .drop("__running")
    )


def failed_runs(log: DataFrame, as_of: str, days: int = 1) -> DataFrame:
    since = F.date_sub(F.lit(as_of).cast("date"), days)
    return log.where((F.col("execution_start") >= since) & (F.col("status") == "FAILED")).select(
        "execution_id", "table_name", "execution_start", "status", "error_message"
    )


def active_watermarks(marks: DataFrame) -> DataFrame:
    return marks.where("is_active").select(
        "entity_name", "last_processed_value", "last_ingestion_time", "records_ingested"
    ).orderBy("entity_name")


def run_metrics(jobs: DataFrame, sla: float = SLA_MINUTES, warn: float = WARN_MINUTES) -> DataFrame:
    """Duration, failure rate and highest period per layer and entity, with the SLA verdict."""
    minutes = F.timestamp_diff("SECOND", F.col("job_start"), F.col("job_end")) / 60
    base = jobs.groupBy("job_type", "job_name").agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
        F.sum(F.timestamp_diff("SECOND", F.col("job_start"), F.col("job_end"))).alias("total_seconds"),
        F.max(minutes).alias("max_minutes"),
        F.max("watermark").alias("watermark"),
    )
    verdict = F.when(F.col("max_minutes") > sla, "BREACH").when(F.col("max_minutes") > warn, "WARN").otherwise("OK")
    return base.withColumns({"failure_pct": share(F.col("failed"), F.col("runs")), "sla_status": verdict})


def watermark_lag(metrics: DataFrame, current: int) -> DataFrame:
    return metrics.withColumn("watermark_lag", F.lit(current) - F.col("watermark"))


def count_variance(
    log: DataFrame, job: str = "table_name", start: str = "execution_start", run: str = "execution_id",
    rows: str = "records_written", max_pct: float = 10.0,
) -> DataFrame:
    """Runs whose row count moved by more than ``max_pct`` percent from the job's previous run.

    A previous count of zero has no percentage; any change from it is reported.
    """
    slim = log.select(job, run, start, rows)
    seen = previous_value(slim, [job], [start, run], rows, "previous_rows")
    move = share(F.abs(F.col(rows) - F.col("previous_rows")), F.abs(F.col("previous_rows")))
    moved = F.coalesce(F.col("variance_pct") > max_pct, F.col(rows) != F.col("previous_rows"))
    return seen.withColumn("variance_pct", move).where(F.col("previous_rows").isNotNull() & moved)
