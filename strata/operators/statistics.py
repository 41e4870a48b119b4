"""Column statistics that are kept per folder of a table, so that only changed folders are read again."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.layout import listed
from strata.session import released, stored
from strata.sources.tables import overwrite_snapshot, read_snapshot, snapshot_exists

SKETCH_BITS = 14  # 2^14 registers: a relative error of about 0.8 percent
UNORDERED = (T.MapType, T.ArrayType, T.StructType, T.VariantType)


def _statistic(field: T.StructField) -> Column:
    """Least and greatest value, NULLs and a sketch of the distinct values of a column; sketches merge."""
    value = F.col(f"`{field.name}`")
    sketched = value.cast("long") if isinstance(field.dataType, T.IntegralType) else value.cast("string")
    return F.struct(
        F.min(value).alias("min"), F.max(value).alias("max"), F.count_if(value.isNull()).alias("nulls"),
        F.hll_sketch_agg(sketched, F.lit(SKETCH_BITS)).alias("sketch"),
    ).alias(f"s_{field.name}")


def folder_statistics(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per folder of files behind ``df``: its rows, and ``s_<column>`` for each column that has an order."""
    fields = [f for f in df.schema.fields if (not columns or f.name in columns) and not isinstance(f.dataType, UNORDERED)]
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    return df.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("n_rows"), *[_statistic(f) for f in fields])


def refresh_statistics(
    spark: SparkSession, path: str, store: str, columns: Sequence[str] | None = None, schema: T.StructType | None = None
) -> int:
    """Bring the statistics in ``store`` up to the state of the Parquet table at ``path``.

    A folder is read if its files (names, sizes, times) differ from those of the last refresh, or if other
    columns are asked for; folders that are gone are dropped. Returns how many folders were read. ``schema``
    is that of the table, where files of different age differ.
    """
    table = spark.read.option("basePath", path)
    table = table.schema(schema or table.parquet(path).schema)
    now = listed(spark, path).groupBy("folder").agg(F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("files"))
    now = stored(now, "folders")
    wanted = folder_statistics(table.parquet(path), columns).schema
    known = read_snapshot(spark, store) if snapshot_exists(spark, store) else None
    if known is not None and _types(known.drop("files").schema) != _types(wanted):
        known = None
    held = None if known is None else now.join(known, ["folder", "files"])
    stale = now if held is None else now.join(held.select("folder"), "folder", "left_anti")
    # One name per folder that changed: as small as the directory listing.
    folders = [unquote(r["folder"]) for r in stale.select("folder").collect()]
    found = held
    if folders:
        fresh = folder_statistics(table.parquet(*folders), columns).join(now, "folder")
        found = fresh if held is None else fresh.unionByName(held)
    if found is not None:
        overwrite_snapshot(found, store)
    released(now)
    return len(folders)


def _types(schema: T.StructType) -> set[tuple[str, str]]:
    return {(f.name, f.dataType.simpleString()) for f in schema}


def merged_statistics(spark: SparkSession, store: str) -> DataFrame:
    """One row per column, from the stored statistics: rows, NULLs, least and greatest value as text, and
    about how many distinct values there are."""
    kept = read_snapshot(spark, store)
    names = [c for c in kept.columns if c.startswith("s_")]
    each = [
        F.struct(
            F.lit(c[2:]).alias("column_name"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum(F.col(f"`{c}`.nulls")), F.lit(0)).alias("num_nulls"),
            F.min(F.col(f"`{c}`.min")).cast("string").alias("min"), F.max(F.col(f"`{c}`.max")).cast("string").alias("max"),
            F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(F.col(f"`{c}`.sketch"))), F.lit(0)).alias("distinct_count"),
        )
        for c in names
    ]
    return kept.agg(F.array(*each).alias("all")).select(F.inline("all"))
