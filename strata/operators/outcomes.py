"""What becomes of every landed record: good, cast with a loss, rejected by a rule, or on a page that can't be read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.quality import Rule, flag_rejects, named_where
from strata.operators.typing import record_array

GOOD, LOST_CAST, REJECTED, UNREADABLE = "good", "lost_cast", "rejected", "unreadable"
OUTCOMES = (GOOD, LOST_CAST, REJECTED, UNREADABLE)
# Typed rows: of a lost cast the value is gone, and the row stays.
LOADED = (GOOD, LOST_CAST)

REJECTS = """ingestion_id STRING, ingestion_datetime TIMESTAMP, outcome STRING, reasons ARRAY<STRING>, records BIGINT,
  content STRING, partition_column STRING, entity_name STRING"""


def read_pages(
    bronze: DataFrame, schema: T.StructType | str, keep: Sequence[str], payload: str = "payload_json"
) -> DataFrame:
    """One row per record of a readable page, and one per page that can't be read.

    Beside the columns of ``keep`` and of the record: ``__read`` (whether the page was), ``__stands_for``
    (1, or the records that the envelope counts on an unreadable page), ``__record`` (the record as it was
    read) or ``__text`` (the payload of an unreadable page), and ``__partition``. A page is readable if its payload is an array, or an object that
    holds one under ``Data``, and every element of it is found again by the schema. A page without
    payload is readable if it counts no record.
    """
    record = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    array = record_array(payload)
    pages = bronze.select(
        *keep, F.col("partition_column").alias("__partition"), F.col(payload).alias("__payload"),
        F.coalesce(F.col("record_count"), F.lit(0)).cast("long").alias("__count"),
        F.json_array_length(array).alias("__length"), F.from_json(array, T.ArrayType(record)).alias("__found"),
    )
    read = F.coalesce(F.size("__found") == F.col("__length"), F.lit(False))
    empty = F.col("__payload").isNull() & (F.col("__count") == 0)
    none = F.array().cast(T.ArrayType(record))
    one = F.array(F.lit(None).cast(record))
    was_read = F.col("__read")
    # Named before the explode, since a column computed after it would carry the whole page along with every
    # record. Outer, since Spark filters an inner one by its array first, and would parse the page again for that.
    named = pages.withColumn("__read", read).select(
        *keep, "__partition", "__read", F.when(was_read, F.lit(1)).otherwise(F.col("__count")).cast("long").alias("__stands_for"),
        F.when(~was_read, F.col("__payload")).alias("__text"),
        F.when(was_read, F.col("__found")).when(empty, none).otherwise(one).alias("__listed"),
    )
    record_of = F.posexplode_outer("__listed").alias("__place", "__record")
    rows = named.select(*keep, "__partition", "__read", "__stands_for", "__text", record_of).where("__place IS NOT NULL")
    return rows.select(*keep, "__partition", "__read", "__stands_for", "__text", "__record", "__record.*")


def lost_casts(df: DataFrame, types: Mapping[str, str], record: str = "__record") -> Column:
    """The columns of a row whose value was lost in the cast to its declared type: ``df`` has the typed
    columns, and beside them the ``record`` as text. What is text stays as it is."""
    return named_where([
        (f"{c}_cast", F.col(record)[c].isNotNull() & F.col(c).isNull())
        for c, t in types.items() if c in df.columns and t.lower() != "string"
    ])


def judge(df: DataFrame, rules: Sequence[Rule], lost: str = "__lost") -> DataFrame:
    """Typed rows of ``read_pages`` with ``__outcome`` and ``__reasons``; the column ``lost`` is used up.

    One outcome holds for each row: unreadable before rejected, rejected before a lost cast. A rejected
    row names its lost casts too, since a loss may be why the rule fails. The text of a good row is
    dropped.
    """
    flagged = flag_rejects(df, rules, "__failed")
    outcome = (
        F.when(~F.col("__read"), UNREADABLE).when(F.size("__failed") > 0, REJECTED)
        .when(F.size(lost) > 0, LOST_CAST).otherwise(GOOD)
    )
    reasons = F.when(F.col("__read"), F.concat("__failed", lost)).otherwise(F.array(F.lit("unreadable_page")))
    named = flagged.withColumns({"__reasons": reasons, "__outcome": outcome})
    # Written out only for these: to make text of every record took as long as to read it.
    text = F.when(F.col("__read"), F.to_json("__record")).otherwise(F.col("__text"))
    content = F.when(F.col("__outcome") != GOOD, text)
    return named.withColumn("__content", content).drop("__failed", "__read", "__record", "__text", lost)


def outcome_counts() -> list[Column]:
    """Aggregates for an observation: records of each outcome, and unreadable pages."""
    counts = [F.coalesce(F.sum(F.when(F.col("__outcome") == o, F.col("__stands_for"))), F.lit(0)).alias(o) for o in OUTCOMES]
    return [*counts, F.count_if(F.col("__outcome") == UNREADABLE).alias("unreadable_pages")]


def loaded(judged: DataFrame) -> DataFrame:
    """The rows that go into the typed table, without what only the outcome needs."""
    rows = judged.where(F.col("__outcome").isin(*LOADED))
    return rows.drop("__outcome", "__reasons", "__stands_for", "__content", "__partition")


def rejects(judged: DataFrame, entity: str) -> DataFrame:
    """The rows that were lost in whole or part, in one form for all entities, with their reasons and text."""
    return judged.where(F.col("__outcome") != GOOD).select(
        F.col("source_file_id").alias("ingestion_id"), "ingestion_datetime", F.col("__outcome").alias("outcome"),
        F.col("__reasons").alias("reasons"), F.col("__stands_for").alias("records"), F.col("__content").alias("content"),
        F.col("__partition").alias("partition_column"), F.lit(entity).alias("entity_name"),
    )


def reject_summary(rows: DataFrame) -> DataFrame:
    """Records per entity, outcome and reason. A record with several reasons counts under each of them."""
    each = rows.select("entity_name", "outcome", "records", F.explode("reasons").alias("reason"))
    return each.groupBy("entity_name", "outcome", "reason").agg(F.sum("records").alias("records"))


def check_accounted(accounts: DataFrame) -> DataFrame:
    """Loads whose outcomes do not add up to the records that landed, with the difference."""
    found = sum((F.col(o) for o in OUTCOMES[1:]), F.col(OUTCOMES[0]))
    return accounts.withColumn("missing", F.col("landed") - found).where(F.col("missing") != 0)
