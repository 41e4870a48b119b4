"""The typed and star loads, composed from the operators and driven by entity and catalog metadata."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from strata.operators import outcomes as o
from strata.operators import quality as q
from strata.operators.star import fk_lookup, incremental_filter, merge_dimension_scd1
from strata.operators.typing import (
    RAW_COLUMNS,
    common_type,
    detect_new_columns,
    infer_payload_schema,
    map_dimension_columns,
    map_fact_columns,
    parse_payload,
    typed_cast,
)
from strata.session import local_rows
from strata.sources.catalog import TableConfig


# Rows of a range, which a task sorts in memory, and of the sample that tells of frequent keys.
RANGE_ROWS = 200_000
SAMPLE_ROWS = 100_000


@dataclass(frozen=True)
class Entity:
    """A typed table: the columns of its records, its key, its rules and its derived columns."""

    name: str
    columns: Mapping[str, str]
    keys: list[str]
    order: list[str] = field(default_factory=lambda: ["ingestion_datetime"])
    rules: Callable[[], list[q.Rule]] = list
    derive: Callable[[DataFrame, str], DataFrame] = lambda df, as_of: df
    partition: str | None = None

    @property
    def as_strings(self) -> str:
        return ", ".join(f"`{c}` STRING" for c in self.columns)


def _fact(name: str, code: str, columns: Mapping[str, str], derive=None) -> Entity:
    amount = code.replace("_code", "_amount")
    return Entity(
        name=f"fact_{name}",
        columns={
            "employee_number": "string",
            "pay_period_id": "int",
            code: "string",
            "location_code": "string",
            **columns,
            "modified_on": "date",
        },
        keys=["employee_number", "pay_period_id", code],
        order=["ingestion_datetime", "modified_on"],
        rules=lambda: [q.not_null("employee_number"), q.non_negative(amount), q.in_period_range("pay_period_id")],
        derive=derive or (lambda df, as_of: df.withColumn(code, F.upper(code))),
        partition="pay_period_id",
    )


# The typed columns of the five entities.
ENTITIES = {
    e.name: e
    for e in (
        _fact(
            "earnings",
            "earning_code",
            {
                "earning_description": "string",
                "earning_amount": "decimal(10,2)",
                "hours": "decimal(5,2)",
                "rate": "decimal(10,2)",
            },
            lambda df, as_of: q.earnings_standardise(df),
        ),
        _fact(
            "deductions",
            "deduction_code",
            {"deduction_description": "string", "deduction_amount": "decimal(10,2)"},
        ),
        _fact(
            "taxes",
            "tax_code",
            {"tax_description": "string", "tax_amount": "decimal(10,2)", "tax_type": "string"},
        ),
        Entity(
            "dim_employee",
            {
                "employee_number": "string",
                "first_name": "string",
                "last_name": "string",
                "hire_date": "date",
                "termination_date": "date",
                "department": "string",
                "job_title": "string",
                "location_code": "string",
                "email": "string",
                "phone": "string",
            },
            ["employee_number"],
            rules=lambda: [q.not_null("employee_number")],
            derive=lambda df, as_of: q.employee_standardise(df, as_of).withColumn("is_current", F.lit(True)),
        ),
        Entity(
            "dim_location",
            {
                "location_code": "string",
                "location_name": "string",
                "city": "string",
                "state": "string",
                "country": "string",
                "region": "string",
                "is_active": "boolean",
            },
            ["location_code"],
            rules=lambda: [q.not_null("location_code")],
        ),
    )
}

# The star dimensions' columns.
GOLD_DIMENSIONS = {
    "dwh_dim_employee": """
      EMPLOYEE_KEY INT, EMPLOYEE_NUMBER STRING, FIRST_NAME STRING, LAST_NAME STRING, FULL_NAME STRING,
      HIRE_DATE DATE, TERMINATION_DATE DATE, EMPLOYMENT_STATUS STRING, DEPARTMENT STRING,
      JOB_TITLE STRING, LOCATION_CODE STRING, EMAIL STRING, PHONE STRING, EFFECTIVE_DATE DATE,
      IS_CURRENT BOOLEAN, CREATED_AT TIMESTAMP, UPDATED_AT TIMESTAMP""",
    "dwh_dim_location": """
      LOCATION_KEY INT, LOCATION_CODE STRING, LOCATION_NAME STRING, CITY STRING, STATE STRING,
      COUNTRY STRING, REGION STRING, IS_ACTIVE BOOLEAN, CREATED_AT TIMESTAMP, UPDATED_AT TIMESTAMP""",
}


def extra_columns(bronze: DataFrame, entity: Entity, added: Mapping[str, str]) -> dict[str, str]:
    """Columns beyond the declared ones: those ``added`` before and those of the payloads, each with a
    type that holds the values of both. Nested values stay JSON text; a column of nulls tells no type.

    Every payload counts: a column that only one record carries is found.
    """
    declared = StructType([StructField(c, StringType()) for c in entity.columns])
    names, types = {c.lower(): c for c in added}, dict(added)
    for column, kind in detect_new_columns(infer_payload_schema(bronze), declared):
        name = names.setdefault(column.lower(), column)
        if kind == "void":
            types.setdefault(name, "string")
            continue
        plain = "string" if kind.startswith(("struct", "array", "map", "variant")) else kind
        types[name] = common_type(types.get(name, plain), plain)
    return types


def widened(entity: Entity, extra: Mapping[str, str]) -> Entity:
    """The entity with further columns; declared types stay."""
    new = {c: kind for c, kind in extra.items() if c not in entity.columns}
    return replace(entity, columns={**entity.columns, **new})


def typed_records(bronze: DataFrame, entity: Entity, errors: str | None = None) -> DataFrame:
    """One typed row per record of the entity's raw rows, before any rule."""
    records = parse_payload(bronze, entity.as_strings)
    typed = typed_cast(records, entity.columns, errors)
    return typed.withColumnRenamed("ingestion_id", "source_file_id")


def flagged_records(bronze: DataFrame, entity: Entity, as_of: str) -> DataFrame:
    """Standardised records with the rules each one fails. Standardising first lets codes that differ
    only in case meet in one key."""
    return q.flag_rejects(entity.derive(typed_records(bronze, entity), as_of), entity.rules())


def judged_records(bronze: DataFrame, entity: Entity, as_of: str) -> DataFrame:
    """Every record of the raw rows, typed and standardised, with its outcome and reasons; an unreadable
    page is one row. The payloads are parsed once for all outcomes."""
    pages = o.read_pages(bronze, entity.as_strings, RAW_COLUMNS)
    typed = typed_cast(pages, entity.columns)
    typed = typed.withColumn("__lost", o.lost_casts(typed, entity.columns))
    renamed = typed.withColumnRenamed("ingestion_id", "source_file_id")
    return o.judge(entity.derive(renamed, as_of), entity.rules())


def typed_table(
    judged: DataFrame, entity: Entity, as_of: str, run_id: str = "silver", ranges: int | None = None
) -> DataFrame:
    """The typed table from judged records: of those that are loaded, the newest row per key.

    With ``ranges`` the rows move once, by ranges of partition and key: a task then finds all rows of its
    keys, and holds few partitions, so that a writer need not move them a second time.
    """
    good, keys = o.loaded(judged), entity.keys
    if ranges is not None:
        keys = [entity.partition, *[k for k in keys if k != entity.partition]]
        good = good.repartitionByRange(ranges, *keys)
    return q.add_audit_columns(q.dedup_latest(good, keys, entity.order), run_id, as_of)


def key_ranges(judged: DataFrame, entity: Entity, rows: int) -> int | None:
    """How many ranges the ``rows`` that are loaded are cut into by ``typed_table``.

    None if the entity's partition is no part of its key, or if one key would make a range several times
    as large as the others, going by a sample: its rows are then cut to one in each task before they move.
    """
    if entity.partition not in entity.keys:
        return None
    ranges = max(1, math.ceil(rows / RANGE_ROWS))
    if ranges > 1:
        some = o.loaded(judged).select(*entity.keys).sample(min(1.0, SAMPLE_ROWS / rows), seed=0)
        per_key = some.groupBy(*entity.keys).agg(F.count(F.lit(1)).alias("n"))
        most, seen = per_key.agg(F.max("n"), F.sum("n")).first()
        if seen and most * ranges > 4 * seen:
            return None
    return ranges


def silver(bronze: DataFrame, entity: Entity, as_of: str, run_id: str = "silver") -> DataFrame:
    """The typed table of an entity from its raw rows: one valid, newest row per key."""
    good = flagged_records(bronze, entity, as_of).where(F.size("failed_rules") == 0).drop("failed_rules")
    return q.add_audit_columns(q.dedup_latest(good, entity.keys, entity.order), run_id, as_of)


def empty_dimension(
    spark: SparkSession, table: str, config: TableConfig | None = None, typed_schema: StructType | None = None
) -> DataFrame:
    """A star dimension without rows. One that is not declared here takes its keys and update columns
    from the catalog and their types from the typed table."""
    if table in GOLD_DIMENSIONS:
        return local_rows(spark, [], GOLD_DIMENSIONS[table])
    types = {f.name.upper(): f.dataType for f in typed_schema.fields}
    wanted = [c for c in [config.business_key, *config.update_columns] if c in types]
    audit = StructType.fromDDL("IS_CURRENT BOOLEAN, CREATED_AT TIMESTAMP, UPDATED_AT TIMESTAMP").fields
    fields = [StructField(config.surrogate_key, IntegerType()), *[StructField(c, types[c]) for c in wanted]]
    return local_rows(spark, [], StructType([*fields, *[f for f in audit if f.name not in wanted]]))


def gold_dimension(target: DataFrame, typed_rows: DataFrame, config: TableConfig, as_of: str) -> DataFrame:
    """New state of a star dimension after the typed snapshot."""
    names = [c for c in target.columns if c not in (config.surrogate_key, "CREATED_AT", "UPDATED_AT", "IS_CURRENT")]
    source = map_dimension_columns(typed_rows, names)
    return merge_dimension_scd1(
        target, source, config.business_key, config.surrogate_key, config.update_columns, as_of, config.surrogate_start
    )


def gold_fact(
    typed_rows: DataFrame,
    dims: Mapping[str, DataFrame],
    config: TableConfig,
    as_of: str,
    last: object | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Star rows for the typed rows after the watermark, with their foreign keys."""
    fresh = incremental_filter(typed_rows, config.watermark_column, last, config.watermark_type)
    keyed = fk_lookup(fresh, dims, config.lookups, max_bytes)
    mapped = map_fact_columns(keyed, config.columns, keep=[x["surrogate_key_column"] for x in config.lookups])
    return mapped.withColumn("LOAD_DATETIME", F.lit(as_of).cast("timestamp"))
