"""Queries over file layout, table statistics and the streaming load."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import layout
from strata.operators import quality as q
from strata.operators.statistics import merged_statistics, refresh_statistics
from strata.plans.layers import Entity
from strata.plans.warehouse import Warehouse
from strata.session import scratch_path
from strata.sources import landing
from strata.sources.tables import replace_partitions
from strata.streaming.silver_stream import settle, stream_bronze_to_silver
from strata.suite.registry import Layers, query
from strata.suite.samples import Samples

SMALL_FILES = 40


def scattered(s: Samples) -> str:
    """Line items in many small files, each holding a slice of every key range."""
    path = scratch_path(s.spark, "scattered")
    lines = s.table("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_extendedprice")
    lines.repartition(SMALL_FILES).write.parquet(path)
    return path


@query("file_stats", f"SELECT count(*) AS row_count, {SMALL_FILES}::BIGINT AS file_count, TRUE AS sizes_known FROM lineitem")
def file_stats(s: Samples, l: Layers) -> DataFrame:
    stats = layout.file_stats(s.spark, scattered(s))
    known = (F.col("size_bytes") > 0) & (F.col("avg_file_bytes") > 0)
    return stats.select("row_count", "file_count", known.alias("sizes_known"))


@query(
    "compact_files",
    "SELECT count(*) AS row_count, CAST(sum(CAST(l_extendedprice AS DECIMAL(10,2))) AS DECIMAL(20,2)) AS amount, TRUE AS fewer_files FROM lineitem",
)
def compact_files(s: Samples, l: Layers) -> DataFrame:
    source, target = scattered(s), scratch_path(s.spark, "compact")
    layout.compact_files(s.spark, source, target)
    after = s.spark.read.parquet(target)
    files = layout.file_stats(s.spark, target).select("row_count", (F.col("file_count") < SMALL_FILES).alias("fewer_files"))
    amount = after.agg(F.sum(F.col("l_extendedprice").cast("decimal(10,2)")).alias("amount")).scalar()
    return files.withColumn("amount", amount)


@query(
    "compact_partition",
    "SELECT pay_period_id, count(*) AS n, CAST(sum(tax_amount) AS DECIMAL(20,2)) AS amount FROM tax_rec GROUP BY pay_period_id",
)
def compact_partition(s: Samples, l: Layers) -> DataFrame:
    path = scratch_path(s.spark, "parts")
    records = s.taxes_records().select("pay_period_id", "employee_number", "tax_amount")
    replace_partitions(records, path, ["pay_period_id"])
    layout.compact_partition(
        s.spark, path, ["pay_period_id"], "pay_period_id IN (25, 26)", scratch_path(s.spark, "parts-staging")
    )
    return s.spark.read.parquet(path).groupBy("pay_period_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("tax_amount").alias("amount")
    )


@query(
    "cluster_zorder",
    "SELECT count(*) AS row_count, TRUE AS skips_files, CAST(sum(CAST(l_extendedprice AS DECIMAL(10,2))) AS DECIMAL(20,2)) AS amount FROM lineitem",
)
def cluster_zorder(s: Samples, l: Layers) -> DataFrame:
    """Clustered by two columns, a lookup on both can skip files that it had to open before."""
    before = s.spark.read.parquet(scattered(s))
    path = scratch_path(s.spark, "zorder")
    layout.cluster_zorder(before, ["l_orderkey", "l_suppkey"], files=SMALL_FILES).write.parquet(path)
    after = s.spark.read.parquet(path)
    point = before.select(
        F.percentile_approx("l_orderkey", 0.5).alias("l_orderkey"), F.percentile_approx("l_suppkey", 0.5).alias("l_suppkey")
    ).first().asDict()
    old, new = layout.files_matching(before, point), layout.files_matching(after, point)
    fewer = new.select("files_matched").scalar() * 2 < old.select("files_matched").scalar()
    totals = after.agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(F.col("l_extendedprice").cast("decimal(10,2)")).alias("amount")
    )
    return totals.withColumn("skips_files", fewer)


MEASURED = ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate"]
_READ = "(SELECT count(DISTINCT year(o_orderdate)) FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01')"


@query(
    "table_statistics",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS num_nulls, CAST(min({c}) AS VARCHAR) AS min,
          CAST(max({c}) AS VARCHAR) AS max, TRUE AS distinct_close, {_READ} AS folders_read FROM orders"""
        for c in MEASURED
    ),
)
def table_statistics(s: Samples, l: Layers) -> DataFrame:
    """Orders by year, measured before and after the last years arrive: only these are read the second time."""
    path, store = scratch_path(s.spark, "measured"), scratch_path(s.spark, "measures")
    orders = s.table("orders").select(*MEASURED).withColumn("order_year", F.year("o_orderdate"))
    replace_partitions(orders.where("order_year < 2000"), path, ["order_year"])
    refresh_statistics(s.spark, path, store, MEASURED)
    replace_partitions(orders.where("order_year >= 2000"), path, ["order_year"])
    read = refresh_statistics(s.spark, path, store, MEASURED)
    exact = s.spark.read.parquet(path).agg(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.count_distinct(c).alias("exact")) for c in MEASURED
    ]).alias("all")).select(F.inline("all"))
    close = F.abs(F.col("distinct_count") - F.col("exact")) <= F.col("exact") * 0.04
    found = merged_statistics(s.spark, store).join(exact, "column_name")
    return found.select("column_name", "row_count", "num_nulls", "min", "max", close.alias("distinct_close"),
                        F.lit(read).cast("long").alias("folders_read"))


@query(
    "fact_year_partition",
    """SELECT CAST(year(l_shipdate) AS INTEGER) AS pay_year, pay_period_id, count(*) AS n FROM pay_lines GROUP BY ALL""",
)
def fact_year_partition(s: Samples, l: Layers) -> DataFrame:
    """Partitioned by year and period, so a new year's first period leaves last year's in place."""
    path = scratch_path(s.spark, "years")
    records = s.earnings_records().withColumn("pay_year", F.year("modified_on"))
    parts = ["pay_year", "pay_period_id"]
    replace_partitions(records.where("pay_year < 2001"), path, parts)
    for _ in range(2):
        replace_partitions(records.where("pay_year >= 2001"), path, parts)
    return s.spark.read.parquet(path).groupBy(*parts).agg(F.count(F.lit(1)).alias("n"))


def click_entity() -> Entity:
    return Entity(
        "click",
        {"event_id": "long", "user_id": "long", "value": "double", "happened_at": "timestamp", "day": "int"},
        ["user_id", "day"],
        order=["happened_at"],
        rules=lambda: [q.not_null("user_id"), q.in_period_range("day")],
        partition="day",
    )


@query(
    "stream_bronze_to_silver",
    """SELECT user_id, CAST(day(ts) AS INTEGER) AS day, event_id, value FROM events
       WHERE event_type = 'click' AND day(ts) BETWEEN 1 AND 26
       QUALIFY row_number() OVER (PARTITION BY user_id, day(ts) ORDER BY ts DESC, event_id DESC) = 1""",
)
def stream_bronze_to_silver_(s: Samples, l: Layers) -> DataFrame:
    """Clicks landed as raw pages, streamed in several micro-batches: the last one per user and day."""
    spark, entity = s.spark, click_entity()
    raw = scratch_path(spark, "stream-raw")
    pages = landing.bronze_envelope(s.event_records(), F.col("event_type"), "day", ingested_at="2024-01-31 06:00:00")
    replace_partitions(pages, raw, landing.RAW_PARTITIONS)
    increments, table = scratch_path(spark, "stream-new"), scratch_path(spark, "stream-silver")
    query_ = stream_bronze_to_silver(
        spark, raw, Warehouse.RAW_SCHEMA, entity, increments, scratch_path(spark, "stream-state"), max_files=50
    )
    query_.awaitTermination()
    settle(spark, entity, table, increments)
    return spark.read.parquet(table).select("user_id", "day", "event_id", "value")
