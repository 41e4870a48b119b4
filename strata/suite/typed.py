"""Queries over the typed layer: parsing, casting, schema changes, rules and the five entities."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.expr import SOURCE_SYSTEM
from strata.operators import quality as q
from strata.operators import typing as t
from strata.operators.governance import PII_PATTERNS
from strata.operators.outcomes import OUTCOMES, reject_summary
from strata.plans.layers import ENTITIES, flagged_records
from strata.plans.layers import silver as silver_table
from strata.plans.warehouse import Warehouse
from strata.session import local_rows, scratch_path, small_tasks, staged
from strata.sources.landing import RAW_PARTITIONS, bronze_envelope
from strata.sources.tables import replace_partitions
from strata.suite.raw import EVENT_FIELDS, RUN_1, event_pages
from strata.suite.registry import Layers, query
from strata.suite.samples import EARLY, FINAL, LOADED_AT, Samples

TECHNICAL = ["source_file_id", "ingestion_datetime", "processed_datetime", "pipeline_run_id", "source_system"]


@query("infer_payload_schema")
def infer_payload_schema(s: Samples, l: Layers) -> DataFrame:
    found = t.infer_payload_schema(event_pages(s))
    rows = [(f.name, f.dataType.simpleString()) for f in found.fields]
    return local_rows(s.spark, rows, "column_name STRING, data_type STRING")


@query(
    "parse_payload",
    f"""SELECT event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS happened_at,
         TIMESTAMP '{RUN_1}' AS ingestion_datetime
       FROM events
       UNION ALL
       SELECT event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), TIMESTAMP '2024-02-15 06:00:00'
       FROM events WHERE value >= 100""",
)
def parse_payload(s: Samples, l: Layers) -> DataFrame:
    return t.parse_payload(event_pages(s), EVENT_FIELDS, keep=["ingestion_datetime"]).drop("day")


@query(
    "flatten_struct",
    """SELECT event_type, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS detail_inner_k, count(*) AS n
       FROM events GROUP BY ALL""",
)
def flatten_struct(s: Samples, l: Layers) -> DataFrame:
    nested = s.events().select(
        "event_type", F.struct(F.from_json("props", "k BIGINT").alias("inner"), "user_id").alias("detail")
    )
    return t.flatten_struct(nested).groupBy("event_type", "detail_inner_k").agg(F.count(F.lit(1)).alias("n"))


@query(
    "typed_cast",
    """SELECT p_partkey, TRY_CAST(p_brand AS INTEGER) AS brand_no, CAST(p_size AS INTEGER) AS size_no,
         CAST(p_retailprice AS DECIMAL(10,2)) AS price, CAST(NULL AS DATE) AS made_on, 2 AS lost
       FROM part""",
)
def typed_cast(s: Samples, l: Layers) -> DataFrame:
    texts = s.table("part").select(
        "p_partkey",
        F.col("p_brand").alias("brand_no"),
        F.col("p_size").cast("string").alias("size_no"),
        F.col("p_retailprice").cast("string").alias("price"),
        F.col("p_type").alias("made_on"),
    )
    types = {"brand_no": "int", "size_no": "int", "price": "decimal(10,2)", "made_on": "date"}
    return t.typed_cast(texts, types, errors="lost")


@query("detect_new_columns")
def detect_new_columns(s: Samples, l: Layers) -> DataFrame:
    """Employees extracted with two more columns, against the columns of the typed table."""
    pages = bronze_envelope(s.employees(), "dim_employee", None, ingested_at=LOADED_AT)
    typed = l.silver("dim_employee").schema
    new = t.detect_new_columns(t.infer_payload_schema(pages), typed)
    return local_rows(s.spark, new, "column_name STRING, data_type STRING")


@query(
    "evolve_append",
    """SELECT department, count(*) AS n, count(email) AS with_email, count(phone) AS with_phone
       FROM (SELECT department, NULL AS email, NULL AS phone FROM emp_early
             UNION ALL SELECT department, email, phone FROM emp_final)
       GROUP BY department""",
)
def evolve_append(s: Samples, l: Layers) -> DataFrame:
    table = s.employee_records(EARLY).drop("email", "phone")
    return t.evolve_append(table, s.employee_records(FINAL)).groupBy("department").agg(
        F.count(F.lit(1)).alias("n"), F.count("email").alias("with_email"), F.count("phone").alias("with_phone")
    )


@query(
    "payload_key_check",
    """SELECT event_type AS entity_name, CASE WHEN value >= 100 THEN 'ResponseStatus' WHEN value >= 10 THEN 'Paging,ResponseStatus'
         ELSE 'Data,Paging,ResponseStatus' END AS missing, count(*) AS n
       FROM events WHERE value < 300 GROUP BY ALL""",
)
def payload_key_check(s: Samples, l: Layers) -> DataFrame:
    value = F.col("value")
    parts = F.struct(
        F.when(value >= 10, F.array("props")).alias("Data"),
        F.when(value >= 100, F.lit(1)).alias("Paging"),
        F.when(value >= 300, F.lit("OK")).alias("ResponseStatus"),
    )
    raw = s.events().select(
        F.col("event_id").cast("string").alias("ingestion_id"),
        F.col("event_type").alias("entity_name"),
        F.to_json(parts).alias("payload_json"),
    )
    missing = t.payload_key_check(raw).withColumn("missing", F.array_join("missing_keys", ","))
    return missing.groupBy("entity_name", "missing").agg(F.count(F.lit(1)).alias("n"))


@query(
    "map_fact_columns",
    """SELECT employee_number, PAY_PERIOD_ID, EARNING_CODE, CAST(sum(EARNING_AMOUNT) AS DECIMAL(20,2)) AS amount, CAST(sum(HOURS) AS DECIMAL(15,2)) AS hours
       FROM earn_std GROUP BY employee_number, PAY_PERIOD_ID, EARNING_CODE""",
)
def map_fact_columns(s: Samples, l: Layers) -> DataFrame:
    config = l.warehouse.config("fact_payroll_earnings")
    mapped = t.map_fact_columns(
        q.earnings_standardise(s.earnings_records()), config.columns, keep=["employee_number"]
    )
    return mapped.groupBy("employee_number", F.col("PAY_PERIOD_ID").alias("pay_period_id"),
                          F.col("EARNING_CODE").alias("earning_code")).agg(
        F.sum("EARNING_AMOUNT").alias("amount"), F.sum("HOURS").alias("hours")
    )


@query(
    "map_dimension_columns",
    """SELECT location_code AS LOCATION_CODE, location_name AS LOCATION_NAME, city AS CITY, state AS STATE,
         country AS COUNTRY, region AS REGION, is_active AS IS_ACTIVE FROM loc""",
)
def map_dimension_columns(s: Samples, l: Layers) -> DataFrame:
    return t.map_dimension_columns(s.location_records())


@query("rule_not_null", "SELECT employee_number, termination_date FROM emp_final WHERE termination_date IS NOT NULL")
def rule_not_null(s: Samples, l: Layers) -> DataFrame:
    return q.rule_not_null(s.employees().select("employee_number", "termination_date"), "termination_date")


@query("rule_non_negative", "SELECT employee_number, salary FROM emp_final WHERE salary >= 0")
def rule_non_negative(s: Samples, l: Layers) -> DataFrame:
    return q.rule_non_negative(s.employees().select("employee_number", "salary"), "salary")


@query(
    "rule_period_range",
    "SELECT event_type, CAST(day(ts) AS INTEGER) AS day, count(*) AS n FROM events WHERE day(ts) BETWEEN 1 AND 26 GROUP BY ALL",
)
def rule_period_range(s: Samples, l: Layers) -> DataFrame:
    valid = q.rule_period_range(s.event_records(), "day")
    return valid.groupBy("event_type", "day").agg(F.count(F.lit(1)).alias("n"))


@query(
    "rule_pattern",
    rf"SELECT doc_id, lang FROM documents WHERE regexp_matches(text, '{PII_PATTERNS['EMAIL']}')",
)
def rule_pattern(s: Samples, l: Layers) -> DataFrame:
    return q.rule_pattern(s.table("documents"), "text", PII_PATTERNS["EMAIL"]).select("doc_id", "lang")


_EVENT_RULES = """SELECT event_type, concat_ws(',', CASE WHEN day(ts) > 26 THEN 'day_in_range' END,
         CASE WHEN value > 100 THEN 'value_plausible' END, CASE WHEN user_id < 5 THEN 'user_known' END) AS failed
       FROM events"""


@query("split_rejects", f"SELECT event_type, failed, count(*) AS n FROM ({_EVENT_RULES}) GROUP BY ALL")
def split_rejects(s: Samples, l: Layers) -> DataFrame:
    rules = [
        q.in_period_range("day"),
        q.Rule("value_plausible", F.col("value") <= 100),
        q.Rule("user_known", F.col("user_id") >= 5),
    ]
    good, rejected = q.split_rejects(s.event_records(), rules)
    both = good.select("event_type", F.lit("").alias("failed")).unionByName(
        rejected.select("event_type", F.array_join("failed_rules", ",").alias("failed"))
    )
    return both.groupBy("event_type", "failed").agg(F.count(F.lit(1)).alias("n"))


@query(
    "dedup_latest",
    """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
         ORDER BY l_shipdate DESC, l_partkey DESC, l_quantity DESC, l_suppkey DESC) = 1""",
)
def dedup_latest(s: Samples, l: Layers) -> DataFrame:
    lines = s.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity"
    )
    return q.dedup_latest(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query(
    "earnings_standardise",
    """SELECT earning_code, location_code, count(*) AS n, CAST(sum(earning_amount) AS DECIMAL(20,2)) AS amount, CAST(sum(total_earnings) AS DECIMAL(20,2)) AS total
       FROM earn_std GROUP BY earning_code, location_code""",
)
def earnings_standardise(s: Samples, l: Layers) -> DataFrame:
    return q.earnings_standardise(s.earnings_records()).groupBy("earning_code", "location_code").agg(
        F.count(F.lit(1)).alias("n"), F.sum("earning_amount").alias("amount"), F.sum("total_earnings").alias("total")
    )


_AT_EARLY = f"CASE WHEN termination_date IS NOT NULL THEN 'TERMINATED' WHEN hire_date > DATE '{EARLY}' THEN 'FUTURE_HIRE' ELSE 'ACTIVE' END"


@query(
    "employee_standardise",
    f"SELECT employee_number, full_name, {_AT_EARLY} AS employment_status FROM emp_final",
)
def employee_standardise(s: Samples, l: Layers) -> DataFrame:
    return q.employee_standardise(s.employees(), EARLY).select("employee_number", "full_name", "employment_status")


@query(
    "default_nulls",
    """SELECT coalesce(termination_date, DATE '9999-12-31') AS termination_date, count(*) AS n
       FROM emp_final GROUP BY ALL""",
)
def default_nulls(s: Samples, l: Layers) -> DataFrame:
    filled = q.default_nulls(s.employees(), {"termination_date": "9999-12-31", "no_such_column": 0})
    return filled.groupBy("termination_date").agg(F.count(F.lit(1)).alias("n"))


@query(
    "add_audit_columns",
    f"""SELECT event_type, '{SOURCE_SYSTEM}' AS source_system, 'run-7' AS pipeline_run_id,
         TIMESTAMP '{LOADED_AT}' AS processed_datetime, TIMESTAMP '{LOADED_AT}' AS ingestion_datetime, count(*) AS n
       FROM events GROUP BY event_type""",
)
def add_audit_columns(s: Samples, l: Layers) -> DataFrame:
    audited = q.add_audit_columns(s.events(), "run-7", LOADED_AT)
    return audited.groupBy(
        "event_type", "source_system", "pipeline_run_id", "processed_datetime", "ingestion_datetime"
    ).agg(F.count(F.lit(1)).alias("n"))


def _silver_fact(name: str, view: str) -> None:
    columns = [c for c in ENTITIES[name].columns] + (["total_earnings"] if name == "fact_earnings" else [])

    @query(f"silver_{name}", f"SELECT {', '.join(columns)} FROM {view}")
    def run(s: Samples, l: Layers) -> DataFrame:
        return silver_table(l.bronze(name), ENTITIES[name], LOADED_AT).drop(*TECHNICAL)


for _name, _view in (("fact_earnings", "silver_earn"), ("fact_deductions", "silver_ded"), ("fact_taxes", "silver_tax")):
    _silver_fact(_name, _view)


@query(
    "silver_dim_employee",
    f"""SELECT employee_number, first_name, last_name, full_name, hire_date, termination_date, department, job_title,
         location_code, email, phone, TRUE AS is_current, {_AT_EARLY} AS employment_status FROM emp_final""",
)
def silver_dim_employee(s: Samples, l: Layers) -> DataFrame:
    return silver_table(l.bronze("dim_employee"), ENTITIES["dim_employee"], EARLY).drop(*TECHNICAL)


@query("silver_dim_location", "SELECT * FROM loc")
def silver_dim_location(s: Samples, l: Layers) -> DataFrame:
    return silver_table(l.bronze("dim_location"), ENTITIES["dim_location"], EARLY).drop(*TECHNICAL)


@query(
    "silver_outcomes",
    """SELECT 'unreadable' AS outcome, 'unreadable_page' AS reason, count(*) AS records FROM earn_odd WHERE outcome = 'unreadable' HAVING count(*) > 0
       UNION ALL SELECT 'rejected', 'earning_amount_non_negative', count(*) FROM earn_odd WHERE outcome = 'rejected' HAVING count(*) > 0
       UNION ALL SELECT outcome, 'hours_cast', count(*) FROM earn_odd WHERE outcome IN ('rejected', 'lost_cast') AND hours > 45 GROUP BY outcome
       UNION ALL SELECT 'account', 'landed', count(*) FROM earn_odd
       UNION ALL SELECT 'account', o, count(outcome) FROM (SELECT unnest(['good', 'lost_cast', 'rejected', 'unreadable']) AS o) LEFT JOIN earn_odd ON outcome = o GROUP BY o
       UNION ALL SELECT 'account', 'rows_written', count(*) FROM (SELECT DISTINCT employee_number, pay_period_id, upper(earning_code) FROM earn_odd
         WHERE outcome IN ('good', 'lost_cast'))
       UNION ALL SELECT 'account', 'missing', 0""",
)
def silver_outcomes(s: Samples, l: Layers) -> DataFrame:
    """A load of earnings with hours in words, negative amounts and a period whose pages are cut off."""
    hours, amount = F.col("hours"), F.col("earning_amount")
    refused = (F.col("pay_period_id") == 13) & (F.upper("earning_code") == "N")
    records = s.earnings_records().withColumns({
        "hours": F.when(hours > 45, F.lit("many")).otherwise(hours.cast("string")),
        "earning_amount": F.when(refused, -amount).otherwise(amount),
    })
    cut = F.expr("substring(payload_json, 1, length(payload_json) - 1)")
    w = Warehouse(s.spark, scratch_path(s.spark, "outcomes"))
    with small_tasks(s.spark), staged(records, "records") as kept:
        pages = bronze_envelope(kept, "fact_earnings", "pay_period_id", ingested_at=LOADED_AT, arranged=True)
        pages = pages.withColumn("payload_json", F.when(F.col("partition_column") == "26", cut).otherwise(F.col("payload_json")))
        replace_partitions(pages, w.path("bronze", "extracts"), RAW_PARTITIONS, arranged=True)
    w.build_silver("fact_earnings", LOADED_AT, evolve=False)
    account = w.load_accounts().withColumn("missing", F.col("landed") - sum((F.col(c) for c in OUTCOMES[1:]), F.col(OUTCOMES[0])))
    counts = account.unpivot([], ["landed", *OUTCOMES, "rows_written", "missing"], "reason", "records")
    return reject_summary(w.rejects()).drop("entity_name").unionByName(counts.withColumn("outcome", F.lit("account")))


@query(
    "silver_quality_metrics",
    """SELECT 'fact_earnings' AS entity_name, (SELECT count(*) FROM earn_rec) AS rows_read, 0::BIGINT AS rows_rejected,
         (SELECT count(*) FROM silver_earn) AS rows_after_dedup, 0 AS new_columns""",
)
def silver_quality_metrics(s: Samples, l: Layers) -> DataFrame:
    entity = ENTITIES["fact_earnings"]
    flagged = flagged_records(l.bronze(entity.name), entity, LOADED_AT)
    new = t.detect_new_columns(flagged.schema, l.silver(entity.name).schema)
    known = [n for n, _ in new if n != "failed_rules"]
    return q.silver_quality_metrics(flagged, entity.keys, entity.name, len(known)).drop("duration_seconds")
