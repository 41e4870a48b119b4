"""What loads keep in an executor, and on its disk, besides the rows they work on."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators import skew
from strata.plans.layers import ENTITIES, empty_dimension, judged_records, key_ranges, typed_table
from strata.session import local_rows, stored
from strata.sources.catalog import read_catalog
from strata.sources.landing import bronze_envelope
from strata.sources.tables import overwrite_snapshot, replace_partitions


def test_local_rows_need_no_python_worker(spark):
    kinds = "a BIGINT, b STRING, c TIMESTAMP, d ARRAY<STRING>"
    at = dt.datetime(2024, 1, 1, 6)
    rows = local_rows(spark, [(1, "x", at, ["p"]), (None, None, None, None)], kinds)
    assert [tuple(r) for r in rows.collect()] == [(1, "x", at, ["p"]), (None, None, None, None)]
    empty = local_rows(spark, [], kinds)
    assert empty.collect() == [] and empty.schema == rows.schema == StructType.fromDDL(kinds)
    for frame in (rows, read_catalog(spark), empty_dimension(spark, "dwh_dim_location")):
        assert "ExistingRDD" not in frame._jdf.queryExecution().toString()


def test_pages_of_wide_rows_stay_small(spark, tmp_path):
    path = str(tmp_path / "wide")
    wide = spark.range(0, 60, 1, 1).select(F.lit(1).alias("p"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 3_000).alias("text"))
    replace_partitions(wide, path, ["p"])
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = []
    for file in (tmp_path / "wide").rglob("*.parquet"):
        where = jvm.org.apache.hadoop.fs.Path(str(file))
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(where, conf))
        for group in reader.getRowGroups():
            found.append((group.getTotalByteSize(), reader.readOffsetIndex(group.getColumns()[0]).getPageCount()))
        reader.close()
    # 60 rows of 192 kB are 11 MB: a page holds 1 MB and what eight rows have beyond, and by default all.
    assert sum(size for size, _ in found) > 11_000_000
    assert all(size <= pages * 2_700_000 for size, pages in found)
    assert spark.read.parquet(path).count() == 60


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_loads_leave_no_shuffle_files_and_compress_their_tables(spark, tmp_path):
    before = shuffle_files(spark)
    rows = spark.range(0, 2000, 1, 3).withColumn("p", F.col("id") % 5)
    replace_partitions(rows, str(tmp_path / "table"), ["p"])
    overwrite_snapshot(rows.groupBy("p").count(), str(tmp_path / "snapshot"))
    assert not shuffle_files(spark) - before
    for table in ("table", "snapshot"):
        files = [f.name for f in (tmp_path / table).rglob("*.parquet")]
        assert files and all(name.endswith(".zstd.parquet") for name in files)


def earnings(spark, n, one_key=0):
    """``n`` typed records of as many employees, and ``one_key`` more of the first."""
    ids = spark.range(0, n + one_key, 1, 4).withColumn("employee", F.when(F.col("id") < n, F.col("id")).otherwise(0))
    made = ids.select(
        F.concat(F.lit("e"), "employee").alias("employee_number"), (F.col("employee") % 26 + 1).cast("int").alias("pay_period_id"),
        F.lit("reg").alias("earning_code"), F.lit("L1").alias("location_code"), F.lit("x").alias("earning_description"),
        F.when(F.col("id") % 1000 == 999, F.lit(-1)).otherwise(F.col("id") % 90).alias("earning_amount"),
        F.lit(8).alias("hours"), F.lit(2).alias("rate"), F.lit("2024-01-01").alias("modified_on"),
    )
    entity = ENTITIES["fact_earnings"]
    pages = bronze_envelope(made, entity.name, "pay_period_id", ingested_at="2024-01-02 00:00:00")
    return stored(judged_records(pages, entity, "2024-01-02"), "judged", ["__outcome"])


def test_typed_rows_move_once_and_stand_by_partition(spark, rows, plan, tmp_path):
    entity, judged = ENTITIES["fact_earnings"], earnings(spark, 3000, 50)
    once = typed_table(judged, entity, "2024-01-02", ranges=6)
    assert plan(once).count("Exchange") == 1 and "Exchange rangepartitioning" in plan(once)
    assert rows(once, *entity.columns) == rows(typed_table(judged, entity, "2024-01-02"), *entity.columns)
    replace_partitions(once, str(tmp_path / "t"), ["pay_period_id"], arranged=True)
    # Six ranges over 26 folders: a file for each folder and border.
    assert len(list((tmp_path / "t").rglob("*.parquet"))) <= 26 + 5


def test_a_frequent_key_is_cut_down_before_it_moves(spark, monkeypatch):
    monkeypatch.setattr("strata.plans.layers.RANGE_ROWS", 100)
    entity = ENTITIES["fact_earnings"]
    assert key_ranges(earnings(spark, 2000), entity, 2000) == 20
    assert key_ranges(earnings(spark, 1000, 1000), entity, 2000) is None
    assert key_ranges(earnings(spark, 10), ENTITIES["dim_employee"], 10) is None


def test_only_records_that_are_kept_apart_are_written_out(spark, rows):
    judged = earnings(spark, 2000)
    assert judged.where("__outcome = 'good' and __content is not null").count() == 0
    lost = judged.where("__outcome <> 'good'").select("__content", F.concat_ws(",", "__reasons").alias("why"))
    assert lost.count() == 2 and {r["why"] for r in lost.collect()} == {"earning_amount_non_negative"}
    assert all('"earning_amount":"-1"' in r["__content"] for r in lost.collect())
    pages = spark.range(1).select(
        F.lit("i").alias("ingestion_id"), F.current_timestamp().alias("ingestion_datetime"), F.lit("01").alias("partition_column"),
        F.col("id").cast("string").alias("payload_json"), F.lit(1).alias("record_count"),
    )
    text = judged_records(pages, ENTITIES["fact_earnings"], "2024-01-02")._jdf.queryExecution().optimizedPlan().toString()
    # Text of a record is made under its outcome, and nowhere before that is known.
    assert all("= good)" in line for line in text.splitlines() if "StructsToJson" in line)
    assert "StructsToJson" in text


def test_joins_without_frequent_keys_carry_nothing_for_them(spark, rows, plan):
    left = spark.range(0, 4000, 1, 4).select(F.when(F.col("id") % 7 > 0, F.col("id")).alias("k"), "id")
    right = spark.range(0, 4000).select("id", (F.col("id") * 2).alias("v"))
    joined = skew.lookup_join(left, right, [("k", "id")], ["v"], max_bytes=0)
    assert "__hot" not in plan(joined) and "__salt" in plan(joined)
    assert rows(joined) == sorted([(i if i % 7 else None, i, 2 * i if i % 7 else None) for i in range(4000)], key=repr)
