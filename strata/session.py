"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Bytes, as stored, that a task of a load reads: of a file, and of a shuffle. Sorted in memory, the rows of typed
# records and pages take some ten times that.
TASK_BYTES = 8 * 1024 * 1024
TASK_SIZES = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
# Spark broadcasts a table by the size of its files, of which a hash table is some twenty times as large, in every
# executor and until the driver collects garbage. Lookups measure their tables and ask for a broadcast themselves.
BROADCAST_FILE_BYTES = 256 * 1024
AUTO_BROADCAST = "spark.sql.autoBroadcastJoinThreshold"
# Files that a task may hold open at once. With fewer folders than that, rows are not sorted before they are written.
OPEN_FILES = 8
OPEN = "spark.sql.maxConcurrentOutputFileWriters"
# Rows after which a writer first looks at the size of a page. By default that is after 100, which of raw pages with
# 500 records each are some 10 MB, buffered and then compressed outside of the heap as one.
FIRST_LOOK = {"parquet.page.size.row.check.min": "8"}
# Raw pages and typed rows repeat themselves, and take about half of what Spark's default leaves of them.
COMPRESSION = "zstd"


# Where ``stored`` wrote the tables that are still referred to.
_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def build_session(app: str = "strata", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; entries of ``conf`` override them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_rows(spark: SparkSession, rows: Iterable[Sequence], schema: StructType | str) -> DataFrame:
    """A few rows of the driver as a table. They are literals of the plan: ``createDataFrame`` would send them
    through Python workers, which then stay in every executor."""
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    made = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, kind.fields, strict=True)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*made).cast(ArrayType(kind))))


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path in its terms."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def scratch_root(spark: SparkSession) -> str:
    """Folder that the driver and every executor can reach, for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may fall back to a folder
    of this machine, because there the driver is the only executor.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        current = context.getCheckpointDir()
        if current:
            return current
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="strata-")
        context.setCheckpointDir(folder)
    elif not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the scratch folder that no other run uses."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def _set(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Within the block the session has these settings, and then its own again."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def tidy_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within the block, a query's shuffle files go when the query ends, not when the driver collects garbage."""
    with _set(spark, {TIDY: "true"}):
        yield


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Within the block, a task reads no more than ``TASK_BYTES`` where Spark cuts the input by size.

    What a task sorts or groups is held in memory as long as there is any, so memory follows from the
    input of a task. Only tables of small files are broadcast unasked. A session that asks for smaller
    tasks or broadcasts keeps them. Shuffle files go with the query that made them (``tidy_shuffles``).
    """
    as_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    sizes = {key: f"{min(TASK_BYTES, as_bytes(spark.conf.get(key)))}b" for key in TASK_SIZES}
    if not (own := spark.conf.get(AUTO_BROADCAST)).startswith("-"):
        sizes[AUTO_BROADCAST] = f"{min(BROADCAST_FILE_BYTES, as_bytes(own))}b"
    with _set(spark, {**sizes, TIDY: "true"}):
        yield


def stored(
    df: DataFrame, label: str, partition_by: list[str] | None = None, row_group_bytes: int | None = None
) -> DataFrame:
    """Write ``df`` to the scratch folder and return the table read back, with its lineage cut.

    The table takes the place of the shuffle files behind it, which go at once. ``released`` removes it.
    Rows with long texts ask for small row groups, of which a reader holds one at a time. Rows for a few
    folders go to a file each as they come.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    with _set(spark, {TIDY: "true", OPEN: str(OPEN_FILES)}):
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if row_group_bytes:
            writer = writer.options(compression=COMPRESSION, **FIRST_LOOK).option("parquet.block.size", row_group_bytes)
        writer.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _paths[table] = path
    return table


def released(*tables: DataFrame) -> None:
    """Remove tables that ``stored`` returned. Nothing that is still to be computed may read them."""
    for table in tables:
        fs, where = file_system(table.sparkSession, _paths.pop(table))
        fs.delete(where, True)


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` written to the scratch folder, for a table that is computed from what it replaces, or for what
    would else be computed twice or hold shuffle files through a second shuffle.

    The copy is removed once the block is left.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    with tidy_shuffles(spark):
        df.write.option("compression", COMPRESSION).parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        fs, where = file_system(spark, path)
        fs.delete(where, True)
