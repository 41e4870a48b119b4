"""Dimension merges, surrogate keys, history and fact enrichment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.skew import lookup_joins, number_rows
from strata.session import stored

# Fixed value: the end of an open history row.
OPEN_END = "9999-12-31"


def assign_surrogate_keys(
    target: DataFrame, source: DataFrame, bk: str, sk: str, start: int = 1
) -> DataFrame:
    """(bk, sk) for the business keys of ``source`` that ``target`` lacks.

    Keys continue after the highest existing one in business-key order, so they are dense and the
    same on every run. NULL business keys get no key.
    """
    new = (
        source.select(bk)
        .where(F.col(bk).isNotNull())
        .distinct()
        .join(target.select(bk), bk, "left_anti")
    )
    highest = target.agg(F.max(sk)).first()[0]
    numbered = number_rows(new, [bk], sk, start if highest is None else max(highest + 1, start))
    return numbered.withColumn(sk, F.col(sk).cast("int"))


def one_per_key(source: DataFrame, bk: str) -> DataFrame:
    """``source`` grouped by its key; a key with two rows stops the job instead of doubling a row."""
    rest = [c for c in source.columns if c != bk]
    grouped = source.groupBy(bk).agg(F.count(F.lit(1)).alias("__n"), F.first(F.struct(*rest)).alias("__row"))
    message = F.concat(F.lit(f"duplicate {bk} in the merge source: "), F.col(bk))
    checked = F.when(F.col("__n") > 1, F.raise_error(message).cast(grouped.schema["__row"].dataType)).otherwise(
        F.col("__row")
    )
    return grouped.select(bk, checked.alias("__row")).select(bk, "__row.*")


def merge_dimension_scd1(
    target: DataFrame,
    source: DataFrame,
    bk: str,
    sk: str,
    update_cols: Sequence[str],
    as_of: str,
    start: int = 1,
) -> DataFrame:
    """New state of a dimension after an upsert from ``source``.

    A matched row keeps its key and takes the source's ``update_cols``, also where they are NULL;
    it counts as updated only if one of them differs. An unmatched source row is inserted with the
    next key. Rows the source does not mention stay. Source rows without a business key are left
    out; they belong to the rejects.
    """
    src = one_per_key(source.where(F.col(bk).isNotNull()), bk)
    updates = [c for c in update_cols if c in src.columns]
    s_cols = src.select(
        F.col(bk).alias("__bk"),
        *[F.col(c).alias(f"__s_{c}") for c in src.columns if c != bk],
    )
    joined = target.join(s_cols, F.col(bk) == F.col("__bk"), "full_outer")
    # Kept, so that the join runs once for both kinds of row; the new ones alone are numbered.
    both = stored(joined.withColumn("__new", F.col(bk).isNull() & F.col("__bk").isNotNull()), "merge", ["__new"])
    highest = both.agg(F.max(sk)).first()[0]
    first = start if highest is None else max(highest + 1, start)
    fresh = number_rows(both.where("__new").drop(sk), ["__bk"], sk, first)
    both = both.where("not __new").unionByName(fresh)
    matched = F.col(bk).isNotNull() & F.col("__bk").isNotNull()
    inserted = F.col("__new")
    differs = F.lit(False)
    for c in updates:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"__s_{c}"))
    changed = matched & differs
    at = F.lit(as_of).cast("timestamp")
    fixed = {"CREATED_AT": at, "UPDATED_AT": at, "IS_CURRENT": F.lit(True), "EFFECTIVE_DATE": F.to_date(at)}
    out = []
    for field in target.schema.fields:
        c = field.name
        if c == bk:
            value = F.coalesce(c, "__bk")
        elif c == sk:
            value = F.col(c)
        elif c == "UPDATED_AT":
            value = F.when(changed | inserted, at).otherwise(F.col(c))
        elif c in fixed and f"__s_{c}" not in s_cols.columns:
            value = F.when(inserted, fixed[c]).otherwise(F.col(c))
        elif f"__s_{c}" in s_cols.columns:
            take = (changed | inserted) if c in updates else inserted
            value = F.when(take, F.col(f"__s_{c}")).otherwise(F.col(c))
        else:
            value = F.col(c)
        out.append(value.cast(field.dataType).alias(c))
    return both.select(*out)


def merge_dimension_scd2(
    history: DataFrame, source: DataFrame, bk: str, tracked: Sequence[str], as_of: str
) -> DataFrame:
    """History after the snapshot ``source``: changed rows are closed on ``as_of``, new states opened.

    ``history`` holds bk, the tracked columns, EFFECTIVE_FROM, EFFECTIVE_TO and IS_CURRENT; a state is
    valid from EFFECTIVE_FROM inclusive to EFFECTIVE_TO exclusive. Keys absent from the snapshot keep
    their open row.
    """
    day, end = F.lit(as_of).cast("date"), F.lit(OPEN_END).cast("date")
    snapshot = one_per_key(source.where(F.col(bk).isNotNull()).select(bk, *tracked), bk)
    fresh = snapshot.select(F.col(bk).alias("__bk"), *[F.col(c).alias(f"__s_{c}") for c in tracked])
    current = history.where("IS_CURRENT")
    differs = F.lit(False)
    for c in tracked:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"__s_{c}"))
    both = current.join(fresh, F.col(bk) == F.col("__bk"), "full_outer")
    states = F.when(F.col(bk).isNull(), F.array(F.lit("open"))).when(
        F.col("__bk").isNotNull() & differs, F.array(F.lit("close"), F.lit("open"))
    ).otherwise(F.array(F.lit("keep")))
    rows = both.withColumn("__state", F.explode(states))
    opened = F.col("__state") == "open"
    moved = rows.select(
        F.coalesce(bk, "__bk").alias(bk),
        *[F.when(opened, F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c) for c in tracked],
        F.when(opened, day).otherwise(F.col("EFFECTIVE_FROM")).alias("EFFECTIVE_FROM"),
        F.when(F.col("__state") == "close", day).otherwise(end).alias("EFFECTIVE_TO"),
        (F.col("__state") != "close").alias("IS_CURRENT"),
    )
    closed = history.where(~F.col("IS_CURRENT")).select(*moved.columns)
    return closed.unionByName(moved)


def dim_as_of(history: DataFrame, day: str) -> DataFrame:
    """The state of every key that was valid on ``day``."""
    at = F.lit(day).cast("date")
    return history.where((F.col("EFFECTIVE_FROM") <= at) & (F.col("EFFECTIVE_TO") > at))


def snapshot_change_feed(before: DataFrame, after: DataFrame, bk: str, compared: Sequence[str]) -> DataFrame:
    """Inserted, updated and deleted rows between two snapshots, with old and new values."""
    old = before.select(F.col(bk).alias("__o"), *[F.col(c).alias(f"before_{c}") for c in compared])
    new = after.select(F.col(bk).alias("__n"), *[F.col(c).alias(f"after_{c}") for c in compared])
    differs = F.lit(False)
    for c in compared:
        differs = differs | ~F.col(f"before_{c}").eqNullSafe(F.col(f"after_{c}"))
    change = (
        F.when(F.col("__o").isNull(), "insert")
        .when(F.col("__n").isNull(), "delete")
        .when(differs, "update")
    )
    return (
        old.join(new, F.col("__o") == F.col("__n"), "full_outer")
        .select(
            F.coalesce("__o", "__n").alias(bk),
            change.alias("change_type"),
            *[F.col(f"{side}_{c}") for c in compared for side in ("before", "after")],
        )
        .where(F.col("change_type").isNotNull())
    )


def fk_lookup(
    facts: DataFrame,
    dims: Mapping[str, DataFrame],
    lookups: Sequence[Mapping],
    max_bytes: int | None = None,
) -> DataFrame:
    """Facts with the surrogate key of every configured dimension; an unknown member gives NULL.

    Only the two key columns of a dimension are used. A lookup configured as ``inner`` drops the
    facts without a member.
    """
    wanted = []
    for lookup in lookups:
        source = lookup["business_key_column"]
        bk = lookup.get("dimension_key_column") or source.upper()
        wanted.append((dims[lookup["dimension_table"]], [(source, bk)], [lookup["surrogate_key_column"]]))
    keyed = lookup_joins(facts, wanted, max_bytes)
    for lookup in lookups:
        if lookup.get("join_type", "left") == "inner":
            keyed = keyed.where(F.col(lookup["surrogate_key_column"]).isNotNull())
    return keyed


def incremental_filter(df: DataFrame, column: str, last: object | None, kind: str = "int") -> DataFrame:
    """Rows after the watermark; without a watermark all rows. The literal reaches the scan."""
    if kind not in ("int", "timestamp", "date"):
        raise ValueError(f"unknown watermark type: {kind}")
    if last is None:
        return df
    return df.where(F.col(column) > F.lit(last).cast(df.schema[column].dataType))
