"""File layout: compaction, clustering and statistics."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.tables import replace_partitions

# Fixed value: target size of a data file.
TARGET_FILE_BYTES = 128 * 1024 * 1024
LEAST_BITS, DEFAULT_BITS, MOST_BITS = 6, 10, 16
SAMPLED = 8
LISTED_BYTES = 1 << 37  # of the files that one task lists
SPLITTER_CHARS = 256


def file_stats(spark: SparkSession, path: str, count_rows: bool = True) -> DataFrame:
    """Number of Parquet files below ``path``, their total and average size, and their rows.

    No row is read: sizes come from the listing, and rows from the footers. Without ``count_rows`` the
    footers are left alone too, and the number of rows is NULL.
    """
    session = _footers(spark)
    files = listed(session, path).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.lit(None).cast("long").alias("rows")
    )
    if count_rows:
        rows = session.read.schema("`__none` INT").parquet(path).agg(F.count(F.lit(1)).alias("rows"))
        none = F.lit(None).cast("long")
        files = files.unionByName(rows.select(none.alias("files"), none.alias("bytes"), "rows"))
    n, size = F.sum("files"), F.coalesce(F.sum("bytes"), F.lit(0))
    return files.agg(
        n.alias("file_count"), size.alias("size_bytes"), F.try_divide(size, n).alias("avg_file_bytes"),
        F.sum("rows").alias("row_count"),
    )


def listed(session: SparkSession, path: str) -> DataFrame:
    """One row per Parquet file below ``path``: path, folder, length and modification time. Contents stay unread."""
    files = session.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    where = F.col("_metadata.file_path")
    return files.load(path).select(
        where.alias("path"), F.regexp_replace(where, "/[^/]*$", "").alias("folder"), "length", "modificationTime"
    )


def _footers(spark: SparkSession) -> SparkSession:
    """A session that lists many files per task and counts Parquet rows by their footers."""
    session = _packing(spark, LISTED_BYTES)
    sources = session.conf.get("spark.sql.sources.useV1SourceList").split(",")
    session.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in sources if s != "parquet"))
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def compact_files(
    spark: SparkSession,
    source: str,
    target: str,
    target_bytes: int = TARGET_FILE_BYTES,
    condition: str | None = None,
    partition_by: Sequence[str] = (),
) -> str:
    """Rewrite the table at ``source`` into ``target`` with files of about ``target_bytes``.

    The scan itself packs small files into read tasks of that size and each task writes one file, or
    one for each partition it reads, so no row is shuffled. ``target`` must differ from ``source``.
    """
    rows = _packing(spark, target_bytes).read.parquet(source)
    if condition:
        rows = rows.where(condition)
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(target)
    return target


def compact_partition(
    spark: SparkSession, path: str, cols: Sequence[str], condition: str, staging: str, target_bytes: int = TARGET_FILE_BYTES
) -> int:
    """Compact the partitions of ``path`` that ``condition`` selects, in place, through ``staging``.

    Neither step shuffles: the scan packs files up to ``target_bytes``, and each task writes one file
    for each partition it reads.
    """
    compact_files(spark, path, staging, target_bytes, condition)
    return replace_partitions(_packing(spark, target_bytes).read.parquet(staging), path, cols, arranged=True)


def _packing(spark: SparkSession, target_bytes: int) -> SparkSession:
    """A session whose scans read up to ``target_bytes`` of files per task."""
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    session.conf.set("spark.sql.files.openCostInBytes", "0")
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    return session


def cluster_zorder(
    df: DataFrame, columns: Sequence[str], files: int | None = None, within: Sequence[str] = ()
) -> DataFrame:
    """Rows laid out along a Z-order curve over 1 to 4 columns, ready to be written.

    Rows of a table with partitions are laid out ``within`` each: the curve starts anew in the next one.

    Each column is cut into ranges of about equal row counts, more than there are files, and the bits of
    the range numbers are interleaved. A range is told by comparing the value itself, of whatever type,
    with splitters from a sample of its values, so the order is that of the column and one odd value
    moves no other. Ties on the curve are split by the row's content and the partition it came from, so
    one frequent value, or copies of one row, cannot fill a single file.
    """
    if not 1 <= len(columns) <= 4:
        raise ValueError("cluster by one to four columns")
    bits = range_bits(files, len(columns))
    cuts = splitters(df, columns, bits)
    z = _interleave([range_number(F.col(c), df.schema[c].dataType, cuts[c]) for c in columns], bits)
    spread = F.xxhash64(*df.columns) + F.spark_partition_id()
    keyed = df.withColumns({"__z": z, "__spread": spread})
    # Without a number of files adaptive execution sizes the partitions.
    along = [*within, "__z", "__spread"]
    ranged = keyed.repartitionByRange(files, *along) if files else keyed.repartitionByRange(*along)
    return (
        ranged.sortWithinPartitions(*within, "__z", *columns)
        .drop("__z", "__spread")
    )


def range_bits(files: int | None, columns: int) -> int:
    """Bits of a column's range number: four ranges a file where one column has to tell all files apart."""
    wanted = (files - 1).bit_length() + 2 if files else DEFAULT_BITS
    return max(LEAST_BITS, min(wanted, MOST_BITS, 62 // columns))


def splitters(df: DataFrame, columns: Sequence[str], bits: int) -> dict[str, str]:
    """For each column the ascending values between its ranges, as a JSON array of texts.

    They are taken at equal distances from a sorted sample of ``SAMPLED`` values a range in expectation.
    A long text is cut, which leaves it a valid splitter.
    """
    rows = df.count()
    wanted = SAMPLED << bits
    sample = df.select(*columns)
    if rows > wanted:
        sample = sample.sample(wanted / rows, seed=bits)
    picked = []
    for c in columns:
        value = F.substring(c, 1, SPLITTER_CHARS) if isinstance(df.schema[c].dataType, T.StringType) else F.col(c)
        ordered = F.sort_array(F.collect_list(value))
        at = F.transform(F.sequence(F.lit(1), F.lit((1 << bits) - 1)), lambda i: F.floor(i * F.size("v") / (1 << bits)).cast("int"))
        picked.append((c, ordered, at))
    values = sample.agg(*[ordered.alias(f"v{k}") for k, (_, ordered, _) in enumerate(picked)])
    found = {}
    for k, (c, _, at) in enumerate(picked):
        one = values.select(F.col(f"v{k}").alias("v")).where(F.size("v") > 0)
        texts = F.transform(at, lambda i: F.element_at("v", i + 1))
        row = one.select(F.to_json(F.array_distinct(texts).cast("array<string>")).alias("cuts")).first()
        found[c] = row["cuts"] if row else "[]"
    return found


def range_number(value: Column, kind: T.DataType, cuts: str) -> Column:
    """How many of the ascending ``cuts`` are below the value, by binary search; 0 for NULL."""
    n = len(json.loads(cuts))
    if n == 0:
        return F.lit(0)
    # Foldable, so the plan holds the array as one constant.
    bounds = F.from_json(F.lit(cuts), "array<string>").cast(T.ArrayType(kind))
    strides = F.array(*[F.lit(1 << b) for b in reversed(range(n.bit_length()))])

    def step(found: Column, stride: Column) -> Column:
        ahead = found + stride
        below = (ahead <= n) & (F.get(bounds, ahead - 1) < value)
        return F.when(below, ahead).otherwise(found)

    return F.when(value.isNull(), F.lit(0)).otherwise(F.aggregate(strides, F.lit(0), step))


def _interleave(ranges: Sequence[Column], bits: int) -> Column:
    n = len(ranges)
    each = [
        F.shiftleft(F.shiftright(r, bit).bitwiseAND(F.lit(1)).cast("long"), bit * n + i)
        for bit in range(bits)
        for i, r in enumerate(ranges)
    ]
    return reduce(Column.bitwiseOR, each)


def files_matching(df: DataFrame, point: dict) -> DataFrame:
    """How many files a lookup must open, judged by each file's smallest and largest values."""
    cols = list(point)
    per_file = df.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        *[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("lo", F.min), ("hi", F.max))]
    )
    hit = reduce(
        Column.__and__, [F.lit(v).between(F.col(f"lo_{c}"), F.col(f"hi_{c}")) for c, v in point.items()]
    )
    return per_file.agg(F.count(F.lit(1)).alias("files"), F.count_if(hit).alias("files_matched"))


def table_statistics(spark: SparkSession, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Compute statistics of a catalog table for the optimizer and return what the catalog recorded for each column.

    That reads the whole table; ``statistics.refresh_statistics`` reads what changed.
    """
    what = f"FOR COLUMNS {', '.join(columns)}" if columns else "FOR ALL COLUMNS"
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS {what}")
    names = columns or spark.table(table).columns
    rows = None
    for name in names:
        described = spark.sql(f"DESCRIBE EXTENDED {table} {name}").where(
            F.col("info_name").isin("min", "max", "num_nulls", "distinct_count")
        )
        one = described.select(F.lit(name).alias("column_name"), "info_name", "info_value")
        rows = one if rows is None else rows.unionByName(one)
    return rows
