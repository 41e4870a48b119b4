"""Catalog JSON as control tables, and the typed configuration the loads are driven by."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from strata.session import local_rows

CONFIG = Path(__file__).resolve().parent.parent / "config"

CATALOG_SCHEMA = """
  table_name STRING, table_type STRING, description STRING, grain STRING,
  silver_source STRUCT<lakehouse: STRING, `schema`: STRING, `table`: STRING>,
  gold_target STRUCT<lakehouse: STRING, `schema`: STRING, `table`: STRING>,
  keys STRUCT<business_key: STRING, surrogate_key: STRING, surrogate_start_value: INT>,
  update_columns ARRAY<STRING>, zorder_columns ARRAY<STRING>,
  watermark STRUCT<`column`: STRING, `type`: STRING>,
  dimension_lookups ARRAY<STRUCT<dimension_table: STRING, business_key_column: STRING,
    surrogate_key_column: STRING, join_type: STRING>>,
  fact_columns ARRAY<STRUCT<source: STRING, target: STRING, `type`: STRING,
    is_degenerate_dim: BOOLEAN, is_measure: BOOLEAN>>,
  partitioning STRUCT<enabled: BOOLEAN, columns: ARRAY<STRING>>,
  load_strategy STRING, is_active BOOLEAN
"""


@dataclass(frozen=True)
class TableConfig:
    """One catalog row as the loads use it."""

    table_name: str
    table_type: str
    source: str
    business_key: str | None = None
    surrogate_key: str | None = None
    surrogate_start: int = 1
    watermark_column: str | None = None
    watermark_type: str | None = None
    update_columns: list[str] = field(default_factory=list)
    zorder_columns: list[str] = field(default_factory=list)
    partition_columns: list[str] = field(default_factory=list)
    lookups: list[dict] = field(default_factory=list)
    columns: list[dict] = field(default_factory=list)


def read_catalog(spark: SparkSession, paths: list[str] | None = None) -> DataFrame:
    """Catalog entries as they are nested in the JSON files."""
    if paths:
        return spark.read.schema(CATALOG_SCHEMA).option("multiLine", True).json(paths)
    # The packaged files lie with the driver's code, not where executors could read them.
    packaged = [((CONFIG / name).read_text(),) for name in ("dimensions.json", "facts.json")]
    texts = local_rows(spark, packaged, "value STRING")
    return texts.select(F.inline(F.from_json("value", ArrayType(StructType.fromDDL(CATALOG_SCHEMA)))))


def catalog_load(catalog: DataFrame, as_of: str) -> dict[str, DataFrame]:
    """The three control tables: tables to load, update columns and clustering columns.

    Only active entries remain. ``load_order`` puts dimensions before the facts that look them up.
    """
    active = catalog.where("is_active")
    at = F.lit(as_of).cast("timestamp")
    tables = active.select(
        "table_name",
        "table_type",
        F.col("silver_source.table").alias("silver_table_name"),
        F.col("silver_source.lakehouse").alias("silver_lakehouse"),
        F.col("silver_source.schema").alias("silver_schema"),
        "description",
        F.col("keys.business_key").alias("business_key"),
        F.col("keys.surrogate_key").alias("surrogate_key_name"),
        F.col("keys.surrogate_start_value").alias("surrogate_start_value"),
        F.col("watermark.column").alias("watermark_column"),
        F.col("watermark.type").alias("watermark_type"),
        F.when(F.col("partitioning.enabled"), F.concat_ws(",", "partitioning.columns")).alias("partition_columns"),
        F.concat_ws(",", "zorder_columns").alias("zorder_columns"),
        F.when(F.col("table_type") == "DIMENSION", 0).otherwise(1).alias("load_order"),
        "is_active",
        at.alias("created_at"),
        at.alias("updated_at"),
    )
    return {
        "gold_catalog": tables.orderBy("load_order", "table_name"),
        "gold_update_columns": _listed(active, "update_columns", as_of),
        "gold_zorder_columns": _listed(active, "zorder_columns", as_of),
    }


def _listed(active: DataFrame, column: str, as_of: str) -> DataFrame:
    at = F.lit(as_of).cast("timestamp")
    return active.select("table_name", F.posexplode(column).alias("pos", "column_name")).select(
        "table_name",
        "column_name",
        (F.col("pos") + 1).alias("sort_order"),
        F.lit(True).alias("is_active"),
        at.alias("created_at"),
        at.alias("updated_at"),
    )


def table_configs(catalog: DataFrame) -> list[TableConfig]:
    """Active entries on the driver, dimensions first. The catalog has one row per table."""
    rows = catalog.where("is_active").collect()
    out = []
    for row in rows:
        r = row.asDict(recursive=True)
        keys, mark, parts = r["keys"] or {}, r["watermark"] or {}, r["partitioning"] or {}
        out.append(
            TableConfig(
                table_name=r["table_name"],
                table_type=r["table_type"],
                source=r["silver_source"]["table"],
                business_key=keys.get("business_key"),
                surrogate_key=keys.get("surrogate_key"),
                surrogate_start=keys.get("surrogate_start_value") or 1,
                watermark_column=mark.get("column"),
                watermark_type=mark.get("type"),
                update_columns=r["update_columns"] or [],
                zorder_columns=r["zorder_columns"] or [],
                partition_columns=(parts.get("columns") or []) if parts.get("enabled") else [],
                lookups=r["dimension_lookups"] or [],
                columns=r["fact_columns"] or [],
            )
        )
    return sorted(out, key=lambda c: (c.table_type != "DIMENSION", c.table_name))


def check_catalog(catalog: DataFrame, columns: DataFrame) -> DataFrame:
    """Catalog references to columns that do not exist.

    ``columns`` holds (table_name, column_name) of the typed and star tables that exist.
    """
    source = F.col("silver_source.table")
    refs = [
        catalog.select(source.alias("table_name"), F.lower("keys.business_key").alias("column_name")),
        catalog.select(source.alias("table_name"), F.explode(F.transform("update_columns", F.lower)).alias("column_name")),
        catalog.select(source.alias("table_name"), F.col("watermark.column").alias("column_name")),
        catalog.select(source.alias("table_name"), F.explode("fact_columns.source").alias("column_name")),
        catalog.select(
            source.alias("table_name"), F.explode("dimension_lookups.business_key_column").alias("column_name")
        ),
        catalog.select(
            F.col("gold_target.table").alias("table_name"), F.explode("zorder_columns").alias("column_name")
        ),
    ]
    wanted = refs[0]
    for ref in refs[1:]:
        wanted = wanted.unionByName(ref)
    return (
        wanted.where(F.col("column_name").isNotNull())
        .distinct()
        .join(columns, ["table_name", "column_name"], "left_anti")
    )
