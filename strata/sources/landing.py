"""Raw landing: envelope rows, routing, and the questions asked of the raw table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.expr import FULL_LOAD, SOURCE_SYSTEM, partition_value, status_class
from strata.operators.skew import trailing_hour_counts

RAW_PARTITIONS = ["partition_column", "entity_name"]


def bronze_envelope(
    records: DataFrame,
    entity: str | Column,
    period_col: str | None,
    page_size: int = 500,
    *,
    ingested_at: str,
    run_id: str | None = None,
    endpoint: str | None = None,
    status: int = 200,
    spread: int = 1,
    arranged: bool = False,
) -> DataFrame:
    """Raw rows holding JSON arrays of at most ``page_size`` records each.

    ``entity`` is a name, or a column when the records mix entities. An entity without a period is
    a snapshot. The records of one (entity, period) are paged apart for each input partition, so they
    are read once and move once, and no task pages more of them than another one read. A slice follows
    from the partition a record is read from, which a retry reproduces and which also spreads copies of
    one record. It ends with a page that may not be full. Input in few, large partitions can be dealt
    over ``spread`` slices each, by content.

    ``arranged`` records move by ranges of partition, entity and slice instead of by hash. Pages of one
    partition then come out next to each other, and a writer need not move them a second time.
    """
    period = F.lit(FULL_LOAD) if period_col is None else partition_value(F.lit("INCREMENTAL"), period_col)
    name = F.lit(entity) if isinstance(entity, str) else entity
    fields = list(records.columns)
    keys = ["partition_column", "entity_name", "__slice"]
    slice_of = F.spark_partition_id()
    if spread > 1:
        slice_of = slice_of * spread + F.pmod(F.xxhash64(*fields), F.lit(spread))
    dealt = records.select(
        F.struct(*fields).alias("__record"), period.alias("partition_column"), name.alias("entity_name"), slice_of.alias("__slice")
    )
    if arranged:
        # Constants are left out: Spark drops them from the window's keys, and would then move the rows again.
        fixed = {"partition_column": period_col is None, "entity_name": isinstance(entity, str)}
        dealt = dealt.repartitionByRange(*[k for k in keys if not fixed.get(k)])
    # Taken after the move, since a hash of each record would go through the shuffle as it is.
    dealt = dealt.withColumn("__content", F.xxhash64(*[F.col("__record")[f] for f in fields]))
    position = F.row_number().over(Window.partitionBy(*keys).orderBy("__content"))
    pages = (
        dealt.withColumn("__page", F.floor((position - 1) / page_size))
        .groupBy(*keys, "__page")
        .agg(
            F.to_json(F.collect_list("__record"), {"ignoreNullFields": "true"}).alias("payload_json"),
            F.count(F.lit(1)).cast("int").alias("record_count"),
        )
    )
    at = F.lit(ingested_at).cast("timestamp")
    return pages.select(
        F.uuid().alias("ingestion_id"),
        "entity_name",
        "partition_column",
        "payload_json",
        "record_count",
        (F.lit(endpoint) if endpoint else F.concat(F.lit("/reports/"), "entity_name")).alias("api_endpoint"),
        F.lit(status).alias("api_http_status"),
        at.alias("api_call_timestamp"),
        at.alias("ingestion_datetime"),
        F.lit(SOURCE_SYSTEM).alias("source_system"),
        F.lit(run_id or f"run-{ingested_at}").alias("pipeline_run_id"),
        at.alias("created_at"),
    )


def landing_read(spark: SparkSession, path: str) -> DataFrame:
    """Landed page files, one row per file, with the file they came from."""
    pages = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    return pages.select(
        F.col("value").alias("payload_json"),
        F.col("_metadata.file_path").alias("api_endpoint"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_modification_time").alias("api_call_timestamp"),
    )


def partition_route(entities: DataFrame, load_type: str = "load_type", period: str = "period") -> DataFrame:
    return entities.withColumn("partition_column", partition_value(load_type, period))


def bronze_read_entity(bronze: DataFrame, entity: str, partition: str | int | None = None) -> DataFrame:
    """Rows of one entity, and of one partition when given. Both filters prune directories."""
    rows = bronze.where(F.col("entity_name") == entity)
    if partition is None:
        return rows
    value = partition if isinstance(partition, str) else f"{partition:02d}"
    return rows.where(F.col("partition_column") == value)


def bronze_latest_snapshot(bronze: DataFrame, entity: str) -> DataFrame:
    """All pages of the newest full load of an entity."""
    pages = bronze_read_entity(bronze, entity, FULL_LOAD)
    newest = pages.orderBy(F.desc("ingestion_datetime"), F.desc("pipeline_run_id")).limit(1)
    key = ["ingestion_datetime", "pipeline_run_id"]
    return pages.join(F.broadcast(newest.select(*key)), key, "left_semi")


def bronze_runs_by_period(bronze: DataFrame, entity: str | None = None) -> DataFrame:
    rows = bronze.where(F.col("partition_column") != FULL_LOAD)
    if entity is not None:
        rows = rows.where(F.col("entity_name") == entity)
    # A run lands many pages of a period, so runs are counted by their id.
    return rows.groupBy(F.col("partition_column").alias("period_id")).agg(
        F.countDistinct("pipeline_run_id").alias("ingestion_runs"),
        F.max("ingestion_datetime").alias("latest_ingestion"),
    )


def bronze_partition_sizes(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy(*RAW_PARTITIONS).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("record_count").alias("total_records")
    )


def bronze_data_age(bronze: DataFrame, as_of: str, max_days: int = 90) -> DataFrame:
    oldest = bronze.groupBy("entity_name", "partition_column").agg(
        F.min("ingestion_datetime").alias("oldest_data")
    )
    age = F.datediff(F.lit(as_of).cast("date"), F.col("oldest_data"))
    return oldest.withColumn("age_days", age).where(F.col("age_days") > max_days)


def api_status_summary(calls: DataFrame, status: str = "api_http_status") -> DataFrame:
    """Calls per entity and error class, where an HTTP client would have branched."""
    return calls.groupBy("entity_name", status_class(status).alias("status_class")).agg(
        F.count(F.lit(1)).alias("calls")
    )


def api_quota_usage(
    calls: DataFrame, keys: Sequence[str] = ("entity_name",), ts: str = "api_call_timestamp", quota: int = 48
) -> DataFrame:
    """Calls of the trailing hour at every call instant, and whether they exceed the quota."""
    counted = trailing_hour_counts(calls, keys, ts, "calls_last_hour")
    return counted.withColumn("over_quota", F.col("calls_last_hour") > quota)


# The departments of generated employees.
DEPARTMENTS = ["Engineering", "Sales", "HR"]
FIRST_NAMES = ["Ada", "Bo", "Chen", "Dana", "Eli", "Fay", "Gus", "Hana", "Ivo", "Jo"]
LAST_NAMES = ["Abel", "Berg", "Cole", "Diaz", "Egan", "Fox", "Gray", "Hale", "Ito", "Jain"]


def synthetic_employees(spark: SparkSession, count: int, as_of: str, seed: int = 0) -> DataFrame:
    """``count`` employees for tests, the same for the same seed: no real person's data is needed."""
    def draw(label: str, n: int) -> Column:
        return F.pmod(F.xxhash64(F.col("id"), F.lit(label), F.lit(seed)), F.lit(n)).cast("int")

    def pick(label: str, names: list[str]) -> Column:
        return F.element_at(F.array(*[F.lit(n) for n in names]), draw(label, len(names)) + 1)

    return spark.range(count).select(
        F.format_string("TEST%05d", "id").alias("EMPLOYEE_NUMBER"),
        pick("first", FIRST_NAMES).alias("FIRST_NAME"),
        pick("last", LAST_NAMES).alias("LAST_NAME"),
        F.date_sub(F.lit(as_of).cast("date"), draw("hire", 5 * 365)).alias("HIRE_DATE"),
        pick("department", DEPARTMENTS).alias("DEPARTMENT"),
        (F.lit(40000) + draw("salary", 110001)).alias("SALARY"),
    )
