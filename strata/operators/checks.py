"""Data checks. Each returns its violations as rows; no rows means the check passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.expr import FULL_LOAD, share, typed
from strata.operators.skew import flag_join
from strata.session import local_rows

# The largest plausible bi-weekly amount, and the tolerated loss between layers.
MAX_AMOUNT = 50000
MAX_LOSS_PCT = 5.0
# Quality targets in percent; a dimension passes at or above its target.
QUALITY_TARGETS = {"completeness": 99.5, "uniqueness": 100.0, "validity": 100.0, "consistency": 100.0, "timeliness": 100.0}
AUDIT_COLUMNS = ["LOAD_DATETIME", "INGESTION_DATETIME", "SOURCE_SYSTEM", "PIPELINE_RUN_ID"]


# ---- raw layer -------------------------------------------------------------------------------


def check_bronze_completeness(bronze: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose landed record count differs from the source's. Raw rows are pages, so records are summed."""
    none = F.lit(0).cast("long")
    landed = bronze.select(*keys, F.col("record_count").cast("long").alias("landed"), none.alias("sent"))
    sent = source.select(*keys, none.alias("landed"), F.lit(1).cast("long").alias("sent"))
    both = landed.unionByName(sent).groupBy(*keys)  # grouping, unlike a join, matches NULL keys
    counted = both.agg(F.sum("landed").alias("landed_records"), F.sum("sent").alias("source_records"))
    return counted.fillna(0, ["landed_records", "source_records"]).where("landed_records <> source_records")


def check_partition_strategy(bronze: DataFrame, catalog: DataFrame) -> DataFrame:
    """Snapshot entities stored in other partitions than the one sentinel."""
    full = catalog.where(F.col("load_type") == FULL_LOAD).select("entity_name")
    used = bronze.select("entity_name", "partition_column").distinct()
    return (
        used.join(full, "entity_name", "left_semi")
        .groupBy("entity_name")
        .agg(
            F.count(F.lit(1)).alias("partition_count"),
            F.count_if(F.col("partition_column") != FULL_LOAD).alias("wrong_partitions"),
        )
        .where((F.col("partition_count") != 1) | (F.col("wrong_partitions") > 0))
    )


def check_watermark_advanced(before: DataFrame, after: DataFrame, kind: str = "int") -> DataFrame:
    """Entities whose watermark did not move forward. Values compare by type; a missing one fails."""
    old = before.select("entity_name", F.col("last_processed_value").alias("before_value"))
    new = after.select("entity_name", F.col("last_processed_value").alias("after_value"))
    ahead = typed("after_value", kind) > typed("before_value", kind)
    return old.join(new, "entity_name", "left").where(~F.coalesce(ahead, F.lit(False)))


# ---- typed layer -----------------------------------------------------------------------------


def check_schema(df: DataFrame, expected: T.StructType | str) -> DataFrame:
    """Expected columns that are missing or have another type. Compares metadata only."""
    wanted = T.StructType.fromDDL(expected) if isinstance(expected, str) else expected
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wrong = [
        (f.name, f.dataType.simpleString(), actual.get(f.name))
        for f in wanted.fields
        if actual.get(f.name) != f.dataType.simpleString()
    ]
    return local_rows(df.sparkSession, wrong, "column_name STRING, expected STRING, actual STRING")


def check_nulls(df: DataFrame, columns: Sequence[str], table: str | None = None) -> DataFrame:
    """NULLs per critical column, counted for all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.unpivot([], list(columns), "column_name", "null_count").where("null_count > 0")
    return long if table is None else long.select(F.lit(table).alias("table_name"), "column_name", "null_count")


def check_amount_rule(
    df: DataFrame,
    amount: str,
    keys: Sequence[str],
    max_amount: float = MAX_AMOUNT,
    exceptions: DataFrame | None = None,
    exception_key: str | None = None,
) -> DataFrame:
    """Amounts that are negative, zero or above the limit, outside the documented exceptions."""
    odd = df.select(*keys, amount, odd_amount(amount, max_amount).alias("violation")).where(F.col("violation").isNotNull())
    if exceptions is None:
        return odd
    key = exception_key or keys[0]
    flagged = flag_join(odd, exceptions, [(key, key)], "__excepted")
    return flagged.where(~F.col("__excepted")).drop("__excepted")


def odd_amount(amount: str, max_amount: float = MAX_AMOUNT) -> Column:
    """What is odd about an amount; NULL if nothing is, or if it is missing."""
    value = F.col(amount)
    return F.when(value < 0, "NEGATIVE").when(value == 0, "ZERO").when(value > max_amount, "TOO_HIGH")


def check_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("dup_count")).where("dup_count > 1")


def reconciliation(raw: DataFrame, typed_rows: DataFrame, max_loss_pct: float = MAX_LOSS_PCT) -> DataFrame:
    """Record counts of the raw and the typed layer, the loss in percent, and the verdict.

    The typed layer may hold fewer records, because of rejects and duplicates, but never more.
    """
    sides = raw.agg(
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("bronze"), F.lit(0).cast("long").alias("silver")
    ).unionByName(
        typed_rows.agg(F.lit(0).cast("long").alias("bronze"), F.count(F.lit(1)).alias("silver"))
    )
    totals = sides.agg(F.sum("bronze").alias("bronze_count"), F.sum("silver").alias("silver_count"))
    loss = F.coalesce(share(F.col("bronze_count") - F.col("silver_count"), F.col("bronze_count")), F.lit(0.0))
    verdict = (
        F.when(F.col("silver_count") > F.col("bronze_count"), "GAINED")
        .when(F.col("loss_pct") >= max_loss_pct, "LOST")
        .otherwise("PASS")
    )
    return totals.withColumn("loss_pct", loss).withColumn("status", verdict)


def check_reconciliation(raw: DataFrame, typed_rows: DataFrame, max_loss_pct: float = MAX_LOSS_PCT) -> DataFrame:
    return reconciliation(raw, typed_rows, max_loss_pct).where("status <> 'PASS'")


# ---- star layer ------------------------------------------------------------------------------


def check_layer_reconciliation(
    typed_rows: DataFrame, star_rows: DataFrame, period: tuple[str, str], amount: tuple[str, str]
) -> DataFrame:
    """Periods whose row count or amount differs between the typed and the star fact."""
    silver = typed_rows.groupBy(F.col(period[0]).alias("period")).agg(
        F.count(F.lit(1)).alias("silver_rows"), F.sum(amount[0]).alias("silver_amount")
    )
    gold = star_rows.groupBy(F.col(period[1]).alias("__period")).agg(
        F.count(F.lit(1)).alias("gold_rows"), F.sum(amount[1]).alias("gold_amount")
    )
    both = silver.join(gold, F.col("period").eqNullSafe(F.col("__period")), "full_outer")
    same = F.col("silver_rows").eqNullSafe(F.col("gold_rows")) & F.col("silver_amount").eqNullSafe(
        F.col("gold_amount")
    )
    return both.where(~same).select(
        F.coalesce("period", "__period").alias("period"), "silver_rows", "gold_rows", "silver_amount", "gold_amount"
    )


def check_key_stability(before: DataFrame, after: DataFrame, bk: str, sk: str) -> DataFrame:
    """Business keys whose surrogate key changed between two states of a dimension."""
    old = before.select(bk, F.col(sk).alias("before_key"))
    new = after.select(bk, F.col(sk).alias("after_key"))
    return old.join(new, bk).where(~F.col("before_key").eqNullSafe(F.col("after_key")))


def check_key_uniqueness(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Values that occur more than once, for each column that should be unique."""
    found = [
        dim.groupBy(F.col(k).cast("string").alias("key_value"))
        .agg(F.count(F.lit(1)).alias("dup_count"))
        .where("dup_count > 1")
        .select(F.lit(k).alias("key_column"), "key_value", "dup_count")
        for k in keys
    ]
    return reduce(DataFrame.unionByName, found)


def check_null_fk(facts: DataFrame, fks: Sequence[str], group: Sequence[str] = ("PAY_PERIOD_ID",)) -> DataFrame:
    """NULL foreign keys per group, with one count per key column."""
    any_null = reduce(Column.__or__, [F.col(k).isNull() for k in fks])
    return (
        facts.where(any_null)
        .groupBy(*group)
        .agg(
            F.count(F.lit(1)).alias("orphan_records"),
            *[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in fks],
        )
    )


def check_orphans(
    facts: DataFrame, dim: DataFrame, fk: str, period: str, dim_key: str | None = None
) -> DataFrame:
    """Foreign keys without a dimension row, by key and period. A NULL key is an orphan too.

    Facts are counted per key and period first, so a frequent key is joined once per period.
    """
    counted = facts.groupBy(fk, period).agg(F.count(F.lit(1)).alias("orphan_count"))
    flagged = flag_join(counted, dim, [(fk, dim_key or fk)], "__known")
    return flagged.where(~F.col("__known")).select(fk, period, "orphan_count")


def check_orphan_pct(facts: DataFrame, dim: DataFrame, fk: str, table: str, dim_key: str | None = None) -> DataFrame:
    """Total, orphaned and percentage of a fact table's rows; no row when nothing is orphaned."""
    counted = facts.groupBy(fk).agg(F.count(F.lit(1)).alias("__n"))
    flagged = flag_join(counted, dim, [(fk, dim_key or fk)], "__known")
    lost = F.coalesce(F.sum(F.when(~F.col("__known"), F.col("__n")).otherwise(0)), F.lit(0))
    return (
        flagged.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("total_records"), lost.alias("orphan_records"))
        .where("orphan_records > 0")
        .select(
            F.lit(table).alias("fact_table"),
            "total_records",
            "orphan_records",
            share(F.col("orphan_records"), F.col("total_records")).alias("orphan_pct"),
        )
    )


def check_orphans_anti(facts: DataFrame, dim: DataFrame, fk: str, dim_key: str | None = None) -> DataFrame:
    """The orphaned fact rows themselves, every one of them."""
    flagged = flag_join(facts, dim, [(fk, dim_key or fk)], "__known")
    return flagged.where(~F.col("__known")).drop("__known")


def check_idempotent(first: DataFrame, second: DataFrame, keys: Sequence[str], amount: str) -> DataFrame:
    """Groups whose sum or row count differs between two runs of the same load."""
    def summed(df: DataFrame) -> DataFrame:
        return df.groupBy(*keys).agg(F.sum(amount).alias("total"), F.count(F.lit(1)).alias("rows"))

    a, b = summed(first), summed(second)
    only_a = a.exceptAll(b).withColumn("run", F.lit("first"))
    return only_a.unionByName(b.exceptAll(a).withColumn("run", F.lit("second")))


def period_checksums(facts: DataFrame, period: str, amount: str) -> DataFrame:
    """Sum in cents and row count per period."""
    cents = (F.col(amount) * 100).cast("long")
    return facts.groupBy(period).agg(F.sum(cents).alias("checksum"), F.count(F.lit(1)).alias("row_count"))


def check_period_checksum(before: DataFrame, after: DataFrame, period: str, amount: str) -> DataFrame:
    """Periods of ``before`` that are missing or different in ``after``."""
    old = period_checksums(before, period, amount).select(
        period, F.col("checksum").alias("before_checksum"), F.col("row_count").alias("before_rows")
    )
    new = period_checksums(after, period, amount).select(
        period, F.col("checksum").alias("after_checksum"), F.col("row_count").alias("after_rows")
    )
    same = F.col("before_checksum").eqNullSafe(F.col("after_checksum")) & F.col("before_rows").eqNullSafe(
        F.col("after_rows")
    )
    new = new.withColumnRenamed(period, "__period")
    return old.join(new, F.col(period).eqNullSafe(F.col("__period")), "left").where(~same).drop("__period")


def check_fact_grain(facts: DataFrame, grain: Sequence[str]) -> DataFrame:
    return check_duplicates(facts, grain)


def check_star_columns(
    facts: DataFrame, columns: Sequence[Mapping], audit: Sequence[str] = tuple(AUDIT_COLUMNS)
) -> DataFrame:
    """Fact columns that are neither keys, configured dimensions or measures, nor audit columns."""
    allowed = {c["target"] for c in columns if c.get("is_degenerate_dim") or c.get("is_measure")} | set(audit)
    odd = [(c,) for c in facts.columns if c not in allowed and not c.endswith("_KEY")]
    return local_rows(facts.sparkSession, odd, "column_name STRING")


def check_fact_totals(pairs: Mapping[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Facts whose total differs between the typed and the star table: (typed, column, star, column)."""
    sides = []
    zero = F.lit(0).cast("decimal(38,2)")
    for name, (silver, s_col, gold, g_col) in pairs.items():
        for df, c, into in ((silver, s_col, "silver_total"), (gold, g_col, "gold_total")):
            total = df.agg(F.coalesce(F.sum(c).cast("decimal(38,2)"), zero).alias("t"))
            sides.append(
                total.select(
                    F.lit(name).alias("fact"),
                    *[(F.col("t") if into == side else zero).alias(side) for side in ("silver_total", "gold_total")],
                )
            )
    both = reduce(DataFrame.unionByName, sides)
    return (
        both.groupBy("fact")
        .agg(F.sum("silver_total").alias("silver_total"), F.sum("gold_total").alias("gold_total"))
        .where("silver_total <> gold_total")
    )


def check_dim_current(dim: DataFrame, bk: str, flag: str = "IS_CURRENT") -> DataFrame:
    """Business keys that do not have exactly one current row."""
    return dim.groupBy(bk).agg(F.count_if(F.col(flag)).alias("current_rows")).where("current_rows <> 1")


def check_lineage(
    star_rows: DataFrame, typed_rows: DataFrame, raw: DataFrame, star_keys: Mapping[str, str], run_id: str = "source_file_id"
) -> DataFrame:
    """Typed rows behind no raw page, and star rows behind no typed row, counted by break.

    ``star_keys`` maps the typed key columns to their star names; both sides join on them.
    """
    pages = raw.select(F.col("ingestion_id").alias(run_id)).distinct()
    per_page = typed_rows.groupBy(run_id).agg(F.count(F.lit(1)).alias("__n"))
    no_raw = per_page.join(pages, run_id, "left_anti").agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"))
    keys = list(star_keys)
    traced = star_rows.groupBy(*[F.col(g).alias(s) for s, g in star_keys.items()]).agg(F.count(F.lit(1)).alias("__n"))
    no_typed = traced.join(typed_rows.select(*keys).distinct(), keys, "left_anti").agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("rows")
    )
    return (
        no_raw.select(F.lit("typed_without_raw").alias("break"), "rows")
        .unionByName(no_typed.select(F.lit("star_without_typed").alias("break"), "rows"))
        .where("rows > 0")
    )


# ---- across layers ---------------------------------------------------------------------------


def layer_counts(raw: DataFrame, typed_rows: DataFrame, star_rows: DataFrame) -> DataFrame:
    """Records of one batch in each layer, on one row."""
    sides = [
        raw.agg(F.coalesce(F.sum("record_count"), F.lit(0)).cast("long").alias("n")).withColumn("layer", F.lit("b")),
        typed_rows.agg(F.count(F.lit(1)).alias("n")).withColumn("layer", F.lit("s")),
        star_rows.agg(F.count(F.lit(1)).alias("n")).withColumn("layer", F.lit("g")),
    ]
    def pick(layer: str) -> Column:
        return F.sum(F.when(F.col("layer") == layer, F.col("n")).otherwise(0))

    return reduce(DataFrame.unionByName, sides).agg(
        pick("b").alias("bronze_count"), pick("s").alias("silver_count"), pick("g").alias("gold_count")
    )


def check_pipeline_counts(raw: DataFrame, typed_rows: DataFrame, star_rows: DataFrame) -> DataFrame:
    """The batch's counts when it did not reach every layer or star and typed counts differ."""
    return layer_counts(raw, typed_rows, star_rows).where(
        "bronze_count = 0 OR silver_count = 0 OR gold_count <> silver_count"
    )


def layer_health(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Records per layer with PASS where there are any. Raw pages count by their ``record_count``."""
    counted = [
        df.agg(_records(df).cast("long").alias("record_count")).select(F.lit(name).alias("layer"), "record_count")
        for name, df in layers.items()
    ]
    status = F.when(F.col("record_count") > 0, "PASS").otherwise("FAIL")
    return reduce(DataFrame.unionByName, counted).withColumn("status", status)


def _records(df: DataFrame) -> Column:
    if "record_count" in df.columns:
        return F.coalesce(F.sum("record_count"), F.lit(0))
    return F.count(F.lit(1))


def check_results(checks: Mapping[str, tuple[str, DataFrame]]) -> DataFrame:
    """One row per check: its criticality, the number of violations, and PASS or FAIL."""
    rows = [
        violations.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(test).alias("test_id"), F.lit(criticality).alias("criticality"), "violations"
        )
        for test, (criticality, violations) in checks.items()
    ]
    status = F.when(F.col("violations") == 0, "PASS").otherwise("FAIL")
    return reduce(DataFrame.unionByName, rows).withColumn("status", status)


def check_suite_report(results: DataFrame) -> DataFrame:
    """Totals over check results. A failed HIGH check blocks; a check in ERROR could not run."""
    report = results.agg(
        F.count(F.lit(1)).alias("total_tests"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
        F.count_if(F.col("status") == "ERROR").alias("errors"),
        F.count_if((F.col("status") == "FAIL") & (F.col("criticality") == "HIGH")).alias("critical_failures"),
    )
    verdict = F.when(F.col("critical_failures") == 0, "APPROVED").otherwise("BLOCKED")
    rate = F.round(F.coalesce(share(F.col("passed"), F.col("total_tests")), F.lit(0.0)), 2)
    return report.withColumns({"pass_rate": rate, "deployment_recommendation": verdict})


def quality_scorecard(
    df: DataFrame,
    keys: Sequence[str],
    required: Sequence[str],
    valid: Column,
    consistent: Column,
    timely: Column,
    targets: Mapping[str, float] | None = None,
) -> DataFrame:
    """Actual share against the target for each quality dimension.

    Rows are counted per key first: the number of keys over the number of rows is the uniqueness.
    """
    goals = {**QUALITY_TARGETS, **(targets or {})}
    complete = reduce(Column.__and__, [F.col(c).isNotNull() for c in required])
    tests = {"completeness": complete, "validity": valid, "consistency": consistent, "timeliness": timely}
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(t).alias(name) for name, t in tests.items()]
    )
    totals = per_key.agg(
        F.sum("rows").alias("rows"),
        F.count(F.lit(1)).alias("uniqueness"),
        *[F.sum(name).alias(name) for name in tests],
    )
    dims = ["completeness", "uniqueness", "validity", "consistency", "timeliness"]
    long = totals.unpivot(["rows"], dims, "dimension", "good")
    goal = F.create_map(*[F.lit(x) for d in dims for x in (d, float(goals[d]))])
    scored = long.select(
        "dimension",
        goal[F.col("dimension")].alias("target"),
        share(F.col("good"), F.col("rows")).alias("actual"),
    )
    return scored.withColumn("status", F.when(F.col("actual") >= F.col("target"), "PASS").otherwise("FAIL"))
