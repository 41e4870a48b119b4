"""Queries over the data checks, on inputs where some of them find something.

The raw records repeat keys, the early dimension lacks later employees, and amounts exceed the limit,
so most checks return violations; the clean cases are unit tests.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import checks
from strata.operators.runner import Check, run_suite
from strata.operators.skew import lookup_join
from strata.operators.star import assign_surrogate_keys, fk_lookup
from strata.plans.layers import ENTITIES, gold_fact
from strata.session import scratch_path
from strata.sources.tables import remove_partitions, replace_partitions
from strata.suite.raw import event_pages
from strata.suite.registry import FIRST_LOAD_UPTO, Layers, query
from strata.suite.samples import EARLY, LOADED_AT, Samples

GRAIN = ["employee_number", "pay_period_id", "earning_code"]


def late_facts(l: Layers) -> DataFrame:
    """Earnings keyed while only the early dimension was known."""
    config = l.warehouse.config("fact_payroll_earnings")
    dims = {"dwh_dim_employee": l.early_dimension("dwh_dim_employee"), "dwh_dim_location": l.gold("dwh_dim_location")}
    return gold_fact(l.silver("fact_earnings"), dims, config, LOADED_AT)


@query(
    "check_bronze_completeness",
    """SELECT event_type AS entity_name, lpad(CAST(day(ts) AS VARCHAR), 2, '0') AS partition_column,
         count(*) + count(*) FILTER (WHERE value >= 100) AS landed_records, count(*) AS source_records
       FROM events GROUP BY event_type, day(ts) HAVING count(*) FILTER (WHERE value >= 100) > 0""",
)
def check_bronze_completeness(s: Samples, l: Layers) -> DataFrame:
    """The second run landed the larger events again, so their partitions hold too many records."""
    source = s.event_records().select(
        F.col("event_type").alias("entity_name"), F.lpad(F.col("day").cast("string"), 2, "0").alias("partition_column")
    )
    return checks.check_bronze_completeness(event_pages(s), source, ["entity_name", "partition_column"])


@query(
    "check_partition_strategy",
    """SELECT event_type AS entity_name, count(DISTINCT day(ts)) AS partition_count, count(DISTINCT day(ts)) AS wrong_partitions
       FROM events WHERE event_type = 'error' GROUP BY ALL""",
)
def check_partition_strategy(s: Samples, l: Layers) -> DataFrame:
    return checks.check_partition_strategy(event_pages(s), s.entity_catalog())


@query(
    "check_watermark_advanced",
    """SELECT o.event_type AS entity_name, CAST(before_day AS VARCHAR) AS before_value, CAST(after_day AS VARCHAR) AS after_value
       FROM (SELECT event_type, max(day(ts)) AS before_day FROM events GROUP BY ALL) o
       JOIN (SELECT event_type, max(day(ts)) AS after_day FROM events WHERE value >= 100 GROUP BY ALL) n USING (event_type)
       WHERE after_day <= before_day""",
)
def check_watermark_advanced(s: Samples, l: Layers) -> DataFrame:
    def marks(df: DataFrame) -> DataFrame:
        return df.groupBy(F.col("event_type").alias("entity_name")).agg(
            F.max(F.dayofmonth("ts")).cast("string").alias("last_processed_value")
        )

    return checks.check_watermark_advanced(marks(s.events()), marks(s.events().where("value >= 100")))


@query("check_schema")
def check_schema(s: Samples, l: Layers) -> DataFrame:
    """The raw table against the typed declaration: dates and amounts are still strings or doubles there."""
    expected = ", ".join(f"{c} {k}" for c, k in ENTITIES["fact_earnings"].columns.items())
    lines = s.table("lineitem").select(
        F.col("l_orderkey").alias("employee_number"),
        F.col("l_returnflag").alias("earning_code"),
        F.col("l_extendedprice").alias("earning_amount"),
    )
    return checks.check_schema(lines, expected)


@query(
    "check_nulls",
    """SELECT 'dim_employee' AS table_name, 'termination_date' AS column_name, count(*) AS null_count
       FROM emp_final WHERE termination_date IS NULL""",
)
def check_nulls(s: Samples, l: Layers) -> DataFrame:
    return checks.check_nulls(
        l.silver("dim_employee"), ["employee_number", "first_name", "last_name", "termination_date"], "dim_employee"
    )


@query(
    "check_amount_rule",
    """SELECT employee_number, pay_period_id, earning_code, earning_amount, 'TOO_HIGH' AS violation FROM silver_earn
       WHERE earning_amount > 75000 AND employee_number NOT IN (SELECT employee_number FROM emp_final WHERE job_title = 'LEAD')""",
)
def check_amount_rule(s: Samples, l: Layers) -> DataFrame:
    leads = l.silver("dim_employee").where("job_title = 'LEAD'").select("employee_number")
    return checks.check_amount_rule(
        l.silver("fact_earnings"), "earning_amount", GRAIN, 75000, leads, "employee_number"
    )


@query(
    "check_duplicates",
    """SELECT employee_number, pay_period_id, earning_code, count(*) AS dup_count FROM earn_rec
       GROUP BY employee_number, pay_period_id, earning_code HAVING count(*) > 1""",
)
def check_duplicates(s: Samples, l: Layers) -> DataFrame:
    return checks.check_duplicates(s.earnings_records(), GRAIN)


@query(
    "check_reconciliation",
    """SELECT bronze_count, silver_count, (bronze_count - silver_count) * 100.0::DOUBLE / bronze_count AS loss_pct, 'LOST' AS status
       FROM (SELECT (SELECT count(*) FROM earn_rec) AS bronze_count, (SELECT count(*) FROM silver_earn) AS silver_count)""",
)
def check_reconciliation(s: Samples, l: Layers) -> DataFrame:
    return checks.check_reconciliation(l.bronze("fact_earnings"), l.silver("fact_earnings"))


@query(
    "check_layer_reconciliation",
    """SELECT pay_period_id AS period, count(*) AS silver_rows, NULL::BIGINT AS gold_rows, CAST(sum(earning_amount) AS DECIMAL(20,2)) AS silver_amount,
         NULL::DECIMAL(20,2) AS gold_amount
       FROM silver_earn WHERE pay_period_id > 20 GROUP BY ALL""",
)
def check_layer_reconciliation(s: Samples, l: Layers) -> DataFrame:
    """Compared while the star table stands at period 20."""
    first = l.first_load()
    return checks.check_layer_reconciliation(
        first.silver("fact_earnings"), first.gold("fact_payroll_earnings"), ("pay_period_id", "PAY_PERIOD_ID"), ("earning_amount", "EARNING_AMOUNT")
    )


@query(
    "check_key_stability",
    """SELECT bk AS EMPLOYEE_NUMBER, sk AS before_key, CAST(r AS INTEGER) AS after_key
       FROM emp_keys JOIN (SELECT employee_number, row_number() OVER (ORDER BY employee_number) AS r FROM emp_final)
         ON employee_number = bk
       WHERE sk <> r AND bk IN (SELECT employee_number FROM emp_early)""",
)
def check_key_stability(s: Samples, l: Layers) -> DataFrame:
    """Keys after an overwrite that numbers the whole snapshot again, against the keys before it."""
    early = l.early_dimension("dwh_dim_employee")
    rebuilt = assign_surrogate_keys(early.limit(0), l.gold("dwh_dim_employee"), "EMPLOYEE_NUMBER", "EMPLOYEE_KEY")
    return checks.check_key_stability(early, rebuilt, "EMPLOYEE_NUMBER", "EMPLOYEE_KEY")


@query(
    "check_key_uniqueness",
    """SELECT 'LOCATION_CODE' AS key_column, location_code AS key_value, count(*) AS dup_count FROM emp_final
       GROUP BY location_code HAVING count(*) > 1""",
)
def check_key_uniqueness(s: Samples, l: Layers) -> DataFrame:
    return checks.check_key_uniqueness(l.gold("dwh_dim_employee"), ["EMPLOYEE_KEY", "EMPLOYEE_NUMBER", "LOCATION_CODE"])


@query(
    "check_null_fk",
    """SELECT pay_period_id AS PAY_PERIOD_ID, count(*) AS orphan_records, count(*) AS null_EMPLOYEE_KEY,
         0::BIGINT AS null_LOCATION_KEY
       FROM late_earn WHERE EMPLOYEE_KEY IS NULL GROUP BY pay_period_id""",
)
def check_null_fk(s: Samples, l: Layers) -> DataFrame:
    return checks.check_null_fk(late_facts(l), ["EMPLOYEE_KEY", "LOCATION_KEY"])


_LATE = "EMPLOYEE_KEY NOT IN (SELECT sk FROM emp_keys WHERE bk IN (SELECT employee_number FROM emp_early))"


@query(
    "check_orphans",
    f"""SELECT EMPLOYEE_KEY, PAY_PERIOD_ID, count(*) AS orphan_count FROM gold_earn WHERE {_LATE}
       GROUP BY EMPLOYEE_KEY, PAY_PERIOD_ID""",
)
def check_orphans(s: Samples, l: Layers) -> DataFrame:
    return checks.check_orphans(
        l.gold("fact_payroll_earnings"), l.early_dimension("dwh_dim_employee"), "EMPLOYEE_KEY", "PAY_PERIOD_ID"
    )


@query(
    "check_orphan_pct",
    f"""SELECT 'fact_payroll_earnings' AS fact_table, count(*) AS total_records, count(*) FILTER (WHERE {_LATE}) AS orphan_records,
         count(*) FILTER (WHERE {_LATE}) * 100::DOUBLE / count(*) AS orphan_pct
       FROM gold_earn""",
)
def check_orphan_pct(s: Samples, l: Layers) -> DataFrame:
    return checks.check_orphan_pct(
        l.gold("fact_payroll_earnings"), l.early_dimension("dwh_dim_employee"), "EMPLOYEE_KEY", "fact_payroll_earnings"
    )


@query("check_orphans_anti", f"SELECT EMPLOYEE_KEY, PAY_PERIOD_ID, EARNING_CODE, EARNING_AMOUNT FROM gold_earn WHERE {_LATE}")
def check_orphans_anti(s: Samples, l: Layers) -> DataFrame:
    orphans = checks.check_orphans_anti(
        l.gold("fact_payroll_earnings"), l.early_dimension("dwh_dim_employee"), "EMPLOYEE_KEY"
    )
    return orphans.select("EMPLOYEE_KEY", "PAY_PERIOD_ID", "EARNING_CODE", "EARNING_AMOUNT")


@query(
    "check_idempotent",
    """SELECT pay_period_id, earning_code, CAST(sum(earning_amount) AS DECIMAL(20,2)) AS total, count(*) AS rows, 'first' AS run FROM earn_std
       WHERE (pay_period_id, earning_code) IN (SELECT (pay_period_id, earning_code) FROM silver_earn) GROUP BY ALL
       UNION ALL
       SELECT pay_period_id, earning_code, sum(earning_amount), count(*), 'second' FROM silver_earn GROUP BY ALL""",
)
def check_idempotent(s: Samples, l: Layers) -> DataFrame:
    """A load without deduplication, repeated with it: the two runs must not pass as equal."""
    first = s.earnings_records().withColumn("earning_code", F.upper("earning_code"))
    return checks.check_idempotent(
        first, l.silver("fact_earnings"), ["pay_period_id", "earning_code"], "earning_amount"
    )


@query(
    "check_period_checksum",
    """SELECT pay_period_id, CAST(sum(earning_amount * 100) AS BIGINT) AS before_checksum, count(*) AS before_rows,
         a.checksum AS after_checksum, a.n AS after_rows
       FROM earn_rec JOIN (SELECT pay_period_id, CAST(sum(earning_amount * 100) AS BIGINT) AS checksum, count(*) AS n
                           FROM silver_earn GROUP BY ALL) a USING (pay_period_id)
       GROUP BY pay_period_id, a.checksum, a.n HAVING count(*) <> a.n""",
)
def check_period_checksum(s: Samples, l: Layers) -> DataFrame:
    return checks.check_period_checksum(
        s.earnings_records(), l.silver("fact_earnings"), "pay_period_id", "earning_amount"
    )


@query(
    "check_fact_grain",
    """SELECT employee_number, pay_period_id, deduction_code, count(*) AS dup_count FROM ded_rec
       GROUP BY employee_number, pay_period_id, deduction_code HAVING count(*) > 1""",
)
def check_fact_grain(s: Samples, l: Layers) -> DataFrame:
    return checks.check_fact_grain(s.deductions_records(), ENTITIES["fact_deductions"].keys)


@query("check_star_columns")
def check_star_columns(s: Samples, l: Layers) -> DataFrame:
    """A fact enriched with a descriptive attribute is no longer only keys and measures."""
    config = l.warehouse.config("fact_payroll_earnings")
    dims = {"dwh_dim_employee": l.gold("dwh_dim_employee"), "dwh_dim_location": l.gold("dwh_dim_location")}
    return checks.check_star_columns(fk_lookup(l.silver("fact_earnings"), dims, config.lookups), config.columns)


@query(
    "check_fact_totals",
    """SELECT 'earnings' AS fact, (SELECT sum(earning_amount) FROM earn_rec) AS silver_total,
         (SELECT sum(EARNING_AMOUNT) FROM gold_earn) AS gold_total""",
)
def check_fact_totals(s: Samples, l: Layers) -> DataFrame:
    """Taxes agree between the layers; earnings are compared before deduplication and do not."""
    return checks.check_fact_totals(
        {
            "earnings": (s.earnings_records(), "earning_amount", l.gold("fact_payroll_earnings"), "EARNING_AMOUNT"),
            "taxes": (l.silver("fact_taxes"), "tax_amount", l.gold("fact_payroll_taxes"), "TAX_AMOUNT"),
        }
    )


@query(
    "check_dim_current",
    "SELECT employee_number AS EMPLOYEE_NUMBER, 2::BIGINT AS current_rows FROM emp_early",
)
def check_dim_current(s: Samples, l: Layers) -> DataFrame:
    """Two loads appended instead of merged leave two current rows for every early employee."""
    both = l.early_dimension("dwh_dim_employee").unionByName(l.gold("dwh_dim_employee"))
    return checks.check_dim_current(both, "EMPLOYEE_NUMBER")


@query(
    "check_lineage",
    """SELECT 'star_without_typed' AS "break", count(*) AS rows FROM gold_earn WHERE PAY_PERIOD_ID > 20
       UNION ALL SELECT 'typed_without_raw', count(*) FROM silver_earn WHERE pay_period_id = 26""",
)
def check_lineage(s: Samples, l: Layers) -> DataFrame:
    """Traced twice over whole tables: after the raw pages of period 26 were purged, and after the typed
    periods above 20 were. Both tables are copies that lost these partitions."""
    typed, raw = l.silver("fact_earnings"), l.bronze("fact_earnings")
    spark = typed.sparkSession
    pages, rows = scratch_path(spark, "purged-raw"), scratch_path(spark, "purged-typed")
    # Files of a partition are read together, so the copies need not be shuffled to be written.
    replace_partitions(raw.select("ingestion_id", "partition_column"), pages, ["partition_column"], arranged=True)
    remove_partitions(spark, pages, ["partition_column"], [("26",)])
    replace_partitions(typed, rows, ["pay_period_id"], arranged=True)
    remove_partitions(spark, rows, ["pay_period_id"], [(p,) for p in range(FIRST_LOAD_UPTO + 1, 27)])
    dim = l.gold("dwh_dim_employee").select("EMPLOYEE_KEY", "EMPLOYEE_NUMBER")
    gold = lookup_join(l.gold("fact_payroll_earnings"), dim, [("EMPLOYEE_KEY", "EMPLOYEE_KEY")], ["EMPLOYEE_NUMBER"])
    keys = {"employee_number": "EMPLOYEE_NUMBER", "pay_period_id": "PAY_PERIOD_ID", "earning_code": "EARNING_CODE"}
    no_raw = checks.check_lineage(gold, typed, spark.read.parquet(pages), keys)
    return no_raw.unionByName(checks.check_lineage(gold, spark.read.parquet(rows), raw, keys))


@query(
    "check_e2e_counts",
    """SELECT (SELECT count(*) FROM earn_rec WHERE pay_period_id = 26) AS bronze_count,
         (SELECT count(*) FROM silver_earn WHERE pay_period_id = 26) AS silver_count, 0::BIGINT AS gold_count""",
)
def check_e2e_counts(s: Samples, l: Layers) -> DataFrame:
    """The last period before its star load."""
    first = l.first_load()
    return checks.check_pipeline_counts(
        first.bronze("fact_earnings", 26), first.silver("fact_earnings").where("pay_period_id = 26"),
        first.gold("fact_payroll_earnings").where("PAY_PERIOD_ID = 26"),
    )


@query(
    "layer_health",
    """SELECT 'Silver' AS layer, count(*) AS record_count, 'PASS' AS status FROM silver_earn WHERE pay_period_id = 26
       UNION ALL SELECT 'Gold', count(*), 'PASS' FROM gold_earn WHERE PAY_PERIOD_ID = 26
       UNION ALL SELECT 'Bronze', count(*), 'PASS' FROM earn_rec WHERE pay_period_id = 26
       UNION ALL SELECT 'Test period', 0, 'FAIL'""",
)
def layer_health(s: Samples, l: Layers) -> DataFrame:
    silver, gold = l.silver("fact_earnings"), l.gold("fact_payroll_earnings")
    return checks.layer_health(
        {
            "Bronze": l.bronze("fact_earnings", 26),
            "Silver": silver.where("pay_period_id = 26"),
            "Gold": gold.where("PAY_PERIOD_ID = 26"),
            "Test period": gold.where("PAY_PERIOD_ID = 99"),
        }
    )


@query(
    "check_suite_report",
    """SELECT 6::BIGINT AS total_tests, 3::BIGINT AS passed, 3::BIGINT AS failed, 0::BIGINT AS errors,
         1::BIGINT AS critical_failures, 50.0::DOUBLE AS pass_rate, 'BLOCKED' AS deployment_recommendation""",
)
def check_suite_report(s: Samples, l: Layers) -> DataFrame:
    silver, gold, dim = l.silver("fact_earnings"), l.gold("fact_payroll_earnings"), l.gold("dwh_dim_employee")
    results = checks.check_results(
        {
            "duplicates": ("HIGH", checks.check_duplicates(silver, GRAIN)),
            "orphans": ("HIGH", checks.check_orphans(gold, dim, "EMPLOYEE_KEY", "PAY_PERIOD_ID")),
            "unique keys": ("HIGH", checks.check_key_uniqueness(dim, ["EMPLOYEE_KEY", "EMPLOYEE_NUMBER"])),
            "reconciliation": ("HIGH", checks.check_reconciliation(l.bronze("fact_earnings"), silver)),
            "amounts": ("MEDIUM", checks.check_amount_rule(silver, "earning_amount", GRAIN)),
            "nulls": ("LOW", checks.check_nulls(dim, ["TERMINATION_DATE"])),
        }
    )
    return checks.check_suite_report(results)


@query(
    "check_suite_results",
    """SELECT 'amounts' AS test_id, 'silver' AS layer, 'test' AS environment, 'MEDIUM' AS criticality, count(*) AS violations,
         CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END AS status, FALSE AS has_error
       FROM silver_earn WHERE earning_amount <= 0 OR earning_amount > 50000
       UNION ALL SELECT 'late', 'silver', 'test', 'LOW', count(*), CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END, FALSE
       FROM silver_earn WHERE pay_period_id > 20
       UNION ALL SELECT 'no such column', 'silver', 'test', 'HIGH', NULL, 'ERROR', TRUE
       UNION ALL SELECT 'no such table', 'gold', 'test', 'HIGH', NULL, 'ERROR', TRUE
       UNION ALL SELECT 'unique', 'silver', 'test', 'HIGH', 0, 'PASS', FALSE""",
)
def check_suite_results(s: Samples, l: Layers) -> DataFrame:
    """A suite in which two checks can't run: they are reported, and so are the others."""
    silver = l.silver("fact_earnings")
    found = run_suite(s.spark, {
        "amounts": Check("silver", "MEDIUM", table="earnings", broken=lambda: checks.odd_amount("earning_amount").isNotNull()),
        "late": Check("silver", "LOW", table="earnings", broken=lambda: F.col("pay_period_id") > 20),
        "no such column": Check("silver", "HIGH", table="earnings", broken=lambda: F.col("gross_amount") > 0),
        "no such table": Check("gold", "HIGH", lambda: s.spark.read.parquet(l.warehouse.path("gold", "fact_bonuses"))),
        "unique": Check("silver", "HIGH", lambda: checks.check_duplicates(silver, GRAIN)),
    }, {"earnings": lambda: silver})
    return found.select("test_id", "layer", "environment", "criticality", "violations", "status",
                        F.coalesce(F.length("error_message") > 0, F.lit(False)).alias("error")).select(
        "test_id", "layer", "environment", "criticality", "violations", "status", (F.col("error") & (F.col("status") == "ERROR")).alias("has_error"))


_SCORES = f"""SELECT count(*) AS n, count(*) FILTER (WHERE earning_amount IS NOT NULL) AS complete,
    count(DISTINCT (employee_number, pay_period_id, earning_code)) AS keys,
    count(*) FILTER (WHERE earning_amount BETWEEN 0 AND 50000) AS valid,
    count(*) FILTER (WHERE lower(earning_code) = lower(right(earning_description, 1))) AS consistent,
    count(*) FILTER (WHERE modified_on >= DATE '{EARLY}') AS timely
  FROM earn_rec"""


@query(
    "quality_scorecard",
    f"""SELECT dimension, target, good * 100::DOUBLE / n AS actual,
         CASE WHEN good * 100::DOUBLE / n >= target THEN 'PASS' ELSE 'FAIL' END AS status
       FROM (SELECT n, unnest(['completeness', 'uniqueness', 'validity', 'consistency', 'timeliness']) AS dimension,
               unnest([99.5, 100, 100, 100, 90]::DOUBLE[]) AS target,
               unnest([complete, keys, valid, consistent, timely]) AS good FROM ({_SCORES}))""",
)
def quality_scorecard(s: Samples, l: Layers) -> DataFrame:
    return checks.quality_scorecard(
        s.earnings_records(),
        GRAIN,
        required=["employee_number", "pay_period_id", "earning_amount"],
        valid=F.col("earning_amount").between(0, checks.MAX_AMOUNT),
        consistent=F.lower("earning_code") == F.lower(F.right(F.col("earning_description"), F.lit(1))),
        timely=F.col("modified_on") >= F.lit(EARLY).cast("date"),
        targets={"timeliness": 90.0},
    )
