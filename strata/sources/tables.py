"""Parquet sinks: partition replacement, append, and snapshots switched by a pointer."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.session import COMPRESSION, FIRST_LOOK, file_system, small_tasks, tidy_shuffles

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# A reader holds the rows of a row group, up to 4,096, at once, and a task reads no less than one. By default a
# group of raw pages has thousands of rows and some 300 MB of text.
ROW_GROUP_BYTES = 8 * 1024 * 1024


def replace_partitions(
    df: DataFrame,
    path: str,
    cols: Sequence[str],
    targets: Iterable[Sequence] | None = None,
    compression: str = COMPRESSION,
    arranged: bool = False,
) -> int:
    """Overwrite exactly the partitions of ``df``, and empty the ``targets`` it has no rows for.

    Returns the rows written. Running it again with the same rows gives the same table. The rows
    must not be read from ``path``: store them elsewhere first. Without ``targets`` the partitions
    present in ``df`` are the ones replaced.

    Rows are first brought together by partition, so that a task does not write a small file into
    every directory; adaptive execution splits a partition that is large and merges small ones. What ``df``
    still has to compute runs in small tasks. Rows that are ``arranged`` already, clustered or packed to a size, are written as they are.
    """
    spark = df.sparkSession
    if not arranged:
        df = df.hint("rebalance", *[F.col(c) for c in cols])
    seen = Observation()
    labels = F.array(*[F.coalesce(F.col(c).cast("string"), F.lit(NULL_PARTITION)) for c in cols])
    # One label per partition directory, so the observed set is as small as the directory listing.
    observed = df.observe(seen, F.collect_set(labels).alias("parts"), F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols)
    writer = writer.options(**FIRST_LOOK).option("parquet.block.size", ROW_GROUP_BYTES)
    writer = writer.option("compression", compression)
    with small_tasks(spark):
        writer.parquet(path)
    metrics = seen.get
    written = {tuple(p) for p in metrics["parts"] or []}
    empty = [t for t in targets or [] if tuple(NULL_PARTITION if v is None else str(v) for v in t) not in written]
    remove_partitions(spark, path, cols, empty)
    return metrics["rows"]


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def overwrite_snapshot(df: DataFrame, base: str, compression: str = COMPRESSION) -> str:
    """Write a new version of a table next to the old one, then point the table at it.

    The old version stays readable during the write, so ``df`` may be computed from it. Returns the
    folder of the new version.
    """
    spark = df.sparkSession
    version = (_current_version(spark, base) or 0) + 1
    folder = f"{base.rstrip('/')}/v={version}"
    with tidy_shuffles(spark):
        df.write.mode("overwrite").option("compression", compression).parquet(folder)
    _set_version(spark, base, version)
    return folder


def snapshot_exists(spark: SparkSession, base: str) -> bool:
    return _current_version(spark, base) is not None


def snapshot_folder(spark: SparkSession, base: str) -> str:
    version = _current_version(spark, base)
    if version is None:
        raise FileNotFoundError(f"no snapshot at {base}")
    return f"{base.rstrip('/')}/v={version}"


def read_snapshot(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(snapshot_folder(spark, base))


def vacuum_snapshots(spark: SparkSession, base: str) -> int:
    """Remove all versions but the current one, which may hold rows that had to go. Returns how many went."""
    current, gone = _current_version(spark, base), 0
    fs, where = file_system(spark, base)
    for status in fs.listStatus(where) if current is not None else []:
        name = status.getPath().getName()
        if name.startswith("v=") and name != f"v={current}":
            fs.delete(status.getPath(), True)
            gone += 1
    return gone


def remove_partitions(spark: SparkSession, path: str, cols: Sequence[str], targets: Iterable[Sequence]) -> None:
    """Remove whole partitions by their directories; nothing is read."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for target in targets:
        label = [NULL_PARTITION if v is None else str(v) for v in target]
        folder = "/".join(f"{c}={escape(v)}" for c, v in zip(cols, label, strict=True))
        remove_path(spark, f"{path.rstrip('/')}/{folder}")


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, where = file_system(spark, path)
    return fs.exists(where)


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """A small text next to a table, such as its schema."""
    fs, where = file_system(spark, path)
    out = fs.create(where, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def read_note(spark: SparkSession, path: str) -> str | None:
    fs, where = file_system(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def remove_path(spark: SparkSession, path: str) -> None:
    fs, where = file_system(spark, path)
    if fs.exists(where):
        fs.delete(where, True)


def _current_version(spark: SparkSession, base: str) -> int | None:
    """Highest version whose marker was created; a version without marker was never finished."""
    fs, where = file_system(spark, f"{base.rstrip('/')}/_versions")
    if not fs.exists(where):
        return None
    names = [status.getPath().getName() for status in fs.listStatus(where)]
    return max((int(n) for n in names if n.isdigit()), default=None)


def _set_version(spark: SparkSession, base: str, version: int) -> None:
    fs, where = file_system(spark, f"{base.rstrip('/')}/_versions/{version}")
    fs.create(where, True).close()
