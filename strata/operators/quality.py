"""Quality rules as data, deduplication, and the derived columns of the typed layer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.expr import PERIODS_PER_YEAR, SOURCE_SYSTEM, with_tie_breaks


@dataclass(frozen=True)
class Rule:
    """A predicate rows must satisfy. NULL counts as not satisfied."""

    name: str
    predicate: Column


def not_null(column: str) -> Rule:
    return Rule(f"{column}_not_null", F.col(column).isNotNull())


def non_negative(column: str) -> Rule:
    return Rule(f"{column}_non_negative", F.col(column) >= 0)


def in_period_range(column: str, first: int = 1, last: int = PERIODS_PER_YEAR) -> Rule:
    return Rule(f"{column}_in_range", F.col(column).between(first, last))


def matches(column: str, pattern: str) -> Rule:
    return Rule(f"{column}_matches", F.col(column).rlike(pattern))


def keep_valid(df: DataFrame, *rules: Rule) -> DataFrame:
    for rule in rules:
        df = df.where(rule.predicate)
    return df


def rule_not_null(df: DataFrame, column: str) -> DataFrame:
    return keep_valid(df, not_null(column))


def rule_non_negative(df: DataFrame, column: str) -> DataFrame:
    return keep_valid(df, non_negative(column))


def rule_period_range(df: DataFrame, column: str, first: int = 1, last: int = PERIODS_PER_YEAR) -> DataFrame:
    return keep_valid(df, in_period_range(column, first, last))


def rule_pattern(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return keep_valid(df, matches(column, pattern))


def named_where(tests: Sequence[tuple[str, Column]]) -> Column:
    """The names of the tests that hold. A row for which none does costs no array: the function that drops
    the NULLs of one is interpreted, which took longer than the tests."""
    none = F.array().cast("array<string>")
    if not tests:
        return none
    found = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests]))
    return F.when(reduce(Column.__or__, [test for _, test in tests]), found).otherwise(none)


def flag_rejects(df: DataFrame, rules: Sequence[Rule], into: str = "failed_rules") -> DataFrame:
    """Every row with the names of the rules it fails, in one pass."""
    return df.withColumn(into, named_where([(r.name, ~F.coalesce(r.predicate, F.lit(False))) for r in rules]))


def split_rejects(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with ``failed_rules``); together they are the input."""
    flagged = flag_rejects(df, rules)
    good = flagged.where(F.size("failed_rules") == 0).drop("failed_rules")
    return good, flagged.where(F.size("failed_rules") > 0)


def dedup_latest(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """The newest row per key by ``order_cols`` descending; ties go to the greatest other columns.

    Spark limits each key to one row before the shuffle, so a key with very many versions costs one
    row per task.
    """
    newest = Window.partitionBy(*keys).orderBy(*with_tie_breaks(df.columns, order_cols, keys))
    return df.withColumn("__rank", F.row_number().over(newest)).where("__rank = 1").drop("__rank")


def earnings_standardise(df: DataFrame) -> DataFrame:
    """Upper-case codes; total = hours times rate where both are known, else the amount."""
    worked = F.col("hours").isNotNull() & F.col("rate").isNotNull()
    total = F.when(worked, F.col("hours") * F.col("rate")).otherwise(F.col("earning_amount"))
    return df.withColumns(
        {"earning_code": F.upper("earning_code"), "total_earnings": total.cast("decimal(10,2)")}
    )


def employee_standardise(df: DataFrame, as_of: str) -> DataFrame:
    """Full name, and the employment status on the day ``as_of``."""
    today = F.lit(as_of).cast("date")
    status = (
        F.when(F.col("termination_date").isNotNull(), "TERMINATED")
        .when(F.col("hire_date") > today, "FUTURE_HIRE")
        .otherwise("ACTIVE")
    )
    return df.withColumns(
        {"full_name": F.concat_ws(" ", "first_name", "last_name"), "employment_status": status}
    )


def default_nulls(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """NULLs replaced by the configured value, cast to the column's type."""
    known = {c: v for c, v in defaults.items() if c in df.columns}
    return df.withColumns({c: F.coalesce(c, F.lit(v).cast(df.schema[c].dataType)) for c, v in known.items()})


def add_audit_columns(df: DataFrame, run_id: str, processed_at: str, source: str = SOURCE_SYSTEM) -> DataFrame:
    """Lineage columns; an ingestion time already present is kept."""
    at = F.lit(processed_at).cast("timestamp")
    audit = {"source_system": F.lit(source), "processed_datetime": at, "pipeline_run_id": F.lit(run_id)}
    if "ingestion_datetime" not in df.columns:
        audit["ingestion_datetime"] = at
    return df.withColumns(audit)


def silver_quality_metrics(
    flagged: DataFrame, keys: Sequence[str], entity: str, new_columns: int, seconds: Column | float | None = None
) -> DataFrame:
    """Rows read, rejected and kept of one entity, from the frame ``flag_rejects`` returns.

    Rows are first counted per key, so the distinct count costs one row per key.
    """
    good = F.size("failed_rules") == 0
    per_key = flagged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(good).alias("good")
    )
    return per_key.agg(
        F.lit(entity).alias("entity_name"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_read"),
        F.coalesce(F.sum(F.col("rows") - F.col("good")), F.lit(0)).alias("rows_rejected"),
        F.count_if(F.col("good") > 0).alias("rows_after_dedup"),
        F.lit(new_columns).alias("new_columns"),
        (seconds if isinstance(seconds, Column) else F.lit(seconds).cast("double")).alias("duration_seconds"),
    )
