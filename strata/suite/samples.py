"""Payroll records, call logs and run logs derived from the shared test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.expr import pay_period
from strata.operators.skew import lookup_joins

EARLY = "1996-01-01"  # the day of the first load: employees hired later are unknown to it
FINAL = "2001-12-31"  # after every order and shipment
LOADED_AT = "2001-12-31 06:00:00"


class Samples:
    """Derived inputs of one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    # ---- payroll -----------------------------------------------------------------------------

    def employees(self, known_on: str = FINAL) -> DataFrame:
        """Customers as employees, from the orders known on that day; no order, no employee."""
        orders = self.table("orders").where(F.col("o_orderdate") <= F.lit(known_on).cast("timestamp_ntz"))
        career = orders.groupBy("o_custkey").agg(
            F.min("o_orderdate").cast("date").alias("hire_date"),
            F.max("o_orderdate").cast("date").alias("last_day"),
            F.count(F.lit(1)).alias("orders"),
        )
        nation = self.table("nation").select("n_nationkey", "n_name")
        people = self.table("customer").join(career, F.col("c_custkey") == F.col("o_custkey"))
        placed = people.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        digits = F.col("c_custkey")
        job = F.when(F.col("orders") >= 10, "LEAD").when(F.col("orders") >= 5, "SENIOR").otherwise("JUNIOR")
        return placed.select(
            F.col("c_name").alias("employee_number"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
            "hire_date",
            F.when(F.col("c_acctbal") < 0, F.col("last_day")).alias("termination_date"),
            F.col("c_mktsegment").alias("department"),
            job.alias("job_title"),
            F.col("n_name").alias("location_code"),
            F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@"),
                     F.lower("c_mktsegment"), F.lit(".example.com")).alias("email"),
            F.concat((200 + F.col("c_nationkey")).cast("string"), F.lit("-555-"), _digits(digits, 4)).alias("phone"),
            F.concat(_digits(digits % 899 + 100, 3), F.lit("-"), _digits(digits % 89 + 10, 2), F.lit("-"),
                     _digits(digits, 4)).alias("ssn"),
            F.col("c_acctbal").cast("decimal(10,2)").alias("salary"),
        )

    def employee_records(self, known_on: str = FINAL) -> DataFrame:
        return self.employees(known_on).drop("ssn", "salary")

    def location_records(self) -> DataFrame:
        region = self.table("region")
        nation = self.table("nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        return nation.select(
            F.col("n_name").alias("location_code"),
            F.concat(F.lit("Site "), F.col("n_name")).alias("location_name"),
            F.concat(F.lit("City "), F.col("n_nationkey").cast("string")).alias("city"),
            F.concat(F.lit("S"), F.col("n_regionkey").cast("string")).alias("state"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("region"),
            F.lit(True).alias("is_active"),
        )

    def _lines(self, *extra: str, rated: bool = False) -> DataFrame:
        """Lines with the employee and site they belong to, and if ``rated`` with the price of their part."""
        columns = ["l_orderkey", "l_suppkey", "l_linenumber", "l_shipdate", *extra]
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        sites = (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .select("s_suppkey", F.col("n_name").alias("location_code"))
        )
        lookups = [
            (orders, [("l_orderkey", "o_orderkey")], ["o_custkey"]), (sites, [("l_suppkey", "s_suppkey")], ["location_code"])
        ]
        if rated:
            parts = self.table("part").select("p_partkey", "p_retailprice")
            lookups.append((parts, [("l_partkey", "p_partkey")], ["p_retailprice"]))
        # All at once, since each alone would look for its frequent keys in what those before it joined.
        placed = lookup_joins(self.table("lineitem").select(*columns), lookups)
        return placed.where(F.col("o_custkey").isNotNull()).withColumns(
            {
                "employee_number": F.concat(F.lit("Customer#"), _digits(F.col("o_custkey"), 9)),
                "pay_period_id": pay_period(F.col("l_shipdate")),
                "modified_on": F.col("l_shipdate").cast("date"),
            }
        )

    def earnings_records(self) -> DataFrame:
        rated = self._lines("l_partkey", "l_returnflag", "l_extendedprice", "l_quantity", rated=True)
        code = F.when(F.col("l_linenumber") % 2 == 0, F.lower("l_returnflag")).otherwise(F.col("l_returnflag"))
        return rated.select(
            "employee_number",
            "pay_period_id",
            code.alias("earning_code"),
            "location_code",
            F.concat(F.lit("Earning "), F.col("l_returnflag")).alias("earning_description"),
            F.col("l_extendedprice").cast("decimal(10,2)").alias("earning_amount"),
            F.col("l_quantity").cast("decimal(5,2)").alias("hours"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("rate"),
            "modified_on",
        )

    def deductions_records(self) -> DataFrame:
        return self._lines("l_linestatus", "l_extendedprice", "l_discount").select(
            "employee_number",
            "pay_period_id",
            F.col("l_linestatus").alias("deduction_code"),
            "location_code",
            F.concat(F.lit("Deduction "), F.col("l_linestatus")).alias("deduction_description"),
            _part_of("l_extendedprice", "l_discount").alias("deduction_amount"),
            "modified_on",
        )

    def taxes_records(self) -> DataFrame:
        kinds = F.array(F.lit("FEDERAL"), F.lit("STATE"), F.lit("LOCAL"))
        return self._lines("l_linestatus", "l_extendedprice", "l_tax").select(
            "employee_number",
            "pay_period_id",
            F.col("l_linestatus").alias("tax_code"),
            "location_code",
            F.concat(F.lit("Tax "), F.col("l_linestatus")).alias("tax_description"),
            _part_of("l_extendedprice", "l_tax").alias("tax_amount"),
            F.element_at(kinds, (F.col("l_suppkey") % 3 + 1).cast("int")).alias("tax_type"),
            "modified_on",
        )

    def records(self, entity: str) -> DataFrame:
        return {
            "fact_earnings": self.earnings_records,
            "fact_deductions": self.deductions_records,
            "fact_taxes": self.taxes_records,
            "dim_employee": self.employee_records,
            "dim_location": self.location_records,
        }[entity]()

    # ---- events ------------------------------------------------------------------------------

    def events(self) -> DataFrame:
        return self.table("events")

    def event_records(self) -> DataFrame:
        """Events as raw records of the entity ``event_type`` and the period day of month."""
        return self.events().select(
            "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("happened_at"), "user_id",
            "value", "props", "event_type", F.dayofmonth("ts").alias("day"),
        )

    def api_calls(self) -> DataFrame:
        statuses = F.array(*[F.lit(s) for s in (200, 401, 429, 500)])
        return self.events().select(
            "event_id",
            F.col("event_type").alias("entity_name"),
            F.col("ts").alias("api_call_timestamp"),
            F.element_at(statuses, (F.col("event_id") % 4 + 1).cast("int")).alias("api_http_status"),
        )

    def execution_log(self) -> DataFrame:
        """One execution per event; a call answered with a server error is a failed execution."""
        failed = F.col("event_id") % 4 == 3
        return self.events().select(
            F.lpad(F.col("event_id").cast("string"), 12, "0").alias("execution_id"),
            F.col("event_type").alias("table_name"),
            F.col("ts").alias("execution_start"),
            (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.floor("value").cast("decimal(18,6)")))
            .alias("execution_end"),
            F.dayofmonth("ts").cast("string").alias("watermark_value"),
            F.floor("value").cast("long").alias("records_read"),
            F.floor("value").cast("long").alias("records_written"),
            F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
            F.when(failed, F.concat(F.lit("HTTP 500 for user "), F.col("user_id").cast("string"))).alias("error_message"),
        )

    def job_log(self) -> DataFrame:
        """The executions as jobs of one run per day."""
        log = self.execution_log()
        kinds = F.create_map(*[F.lit(x) for kv in JOB_TYPES.items() for x in kv])
        return log.select(
            F.date_format("execution_start", "yyyy-MM-dd").alias("orchestrator_run_id"),
            F.col("table_name").alias("job_name"),
            F.coalesce(kinds[F.col("table_name")], F.lit("GOLD_FACT")).alias("job_type"),
            F.col("execution_start").alias("job_start"),
            F.col("execution_end").alias("job_end"),
            F.col("records_written").alias("records_processed"),
            F.col("watermark_value").cast("int").alias("watermark"),
            "status",
            "error_message",
        )

    def watermarks(self, before_day: int | None = None) -> DataFrame:
        """Watermark rows of the raw entities: the highest day each one has reached."""
        events = self.events()
        if before_day is not None:
            events = events.where(F.dayofmonth("ts") < before_day)
        return events.groupBy(F.col("event_type").alias("entity_name")).agg(
            F.max(F.dayofmonth("ts")).cast("string").alias("last_processed_value"),
            F.count(F.lit(1)).alias("records_ingested"),
            F.max("ts").cast("timestamp").alias("last_ingestion_time"),
        ).select(
            F.lit("hcm_api").alias("source_system"),
            "entity_name",
            F.lit("day").alias("watermark_column"),
            F.lit("int").alias("watermark_type"),
            "last_processed_value",
            "last_ingestion_time",
            "records_ingested",
            F.lit(True).alias("is_active"),
            F.col("last_ingestion_time").alias("created_at"),
            F.col("last_ingestion_time").alias("updated_at"),
        )

    def entity_catalog(self) -> DataFrame:
        """The raw entities of the events: one of them is loaded as a snapshot."""
        return self.events().select(F.col("event_type").alias("entity_name")).distinct().select(
            "entity_name",
            F.when(F.col("entity_name") == "error", "FULL_LOAD").otherwise("INCREMENTAL").alias("load_type"),
            F.lit(1).alias("start_period"),
            F.lit(True).alias("is_active"),
        )


# The kind of job each event type stands for.
JOB_TYPES = {"click": "BRONZE", "view": "SILVER", "purchase": "GOLD_DIM", "error": "GOLD_FACT"}


def _digits(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _part_of(amount: str, rate: str) -> Column:
    # Each factor becomes a decimal first, so the product is exact in any engine.
    return (F.col(amount).cast("decimal(10,2)") * F.col(rate).cast("decimal(4,2)")).cast("decimal(10,2)")
