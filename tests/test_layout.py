"""Clustering by ranks of the values themselves."""

import pytest
from pyspark.sql import functions as F

from strata.operators import layout


def ranked(df, column, files):
    bits = layout.range_bits(files, 1)
    cuts = layout.splitters(df, [column], bits)[column]
    return df.withColumn("r", layout.range_number(F.col(column), df.schema[column].dataType, cuts))


KINDS = {
    "text": "concat('Customer#', lpad(cast(id AS string), 9, '0'))",
    "day": "date_add(DATE '1990-01-01', cast(id AS int))",
    "moment": "timestamp_micros(id * 977)",
    "money": "cast(id / 7 AS decimal(18,4))",
    "number": "cast(id - 25000 AS double) / 3",
    "large": "id + 1152921504606846976",
}


@pytest.mark.parametrize("kind", KINDS)
def test_ranks_keep_the_order_and_are_even(spark, kind):
    df = spark.range(50_000).withColumn("v", F.expr(KINDS[kind]))
    got = ranked(df, "v", 64).agg(F.count_distinct("r").alias("ranges"), F.corr("r", "id").alias("c")).first()
    assert got.ranges == 256 and got.c > 0.999
    broken = ranked(df, "v", 64).groupBy("r").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count("*").alias("n"))
    rows = broken.orderBy("r").collect()
    assert all(x.b < y.a for x, y in zip(rows, rows[1:])) and max(x.n for x in rows) < 4 * 50_000 / 256


def test_one_odd_text_moves_no_other(spark):
    df = spark.range(50_000).select("id", F.expr(KINDS["text"]).alias("v"))
    odd = df.union(spark.createDataFrame([(-1, "~" * 1000), (-2, ""), (-3, None)], "id long, v string"))
    plain, with_odd = (ranked(x, "v", 64).where("id >= 0").agg(F.count_distinct("r")).first()[0] for x in (df, odd))
    assert plain == 256 and with_odd >= 250
    assert ranked(odd, "v", 64).where("v IS NULL").first()["r"] == 0


def test_a_thousand_files_are_told_apart(spark, tmp_path):
    df = spark.range(50_000).select(F.expr(KINDS["text"]).alias("v"), F.rand(1).alias("x"))
    path = str(tmp_path / "t")
    layout.cluster_zorder(df.orderBy("x"), ["v"], files=1000).write.parquet(path)
    met = layout.files_matching(spark.read.parquet(path), {"v": "Customer#000023456"}).first()
    assert met.files >= 900 and met.files_matched <= 2


def test_empty_null_and_constant_columns(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert layout.cluster_zorder(empty, ["a", "b"], files=2).count() == 0
    flat = spark.range(100).select(F.lit(None).cast("string").alias("a"), F.lit(5).alias("b"), "id")
    assert layout.cluster_zorder(flat, ["a", "b"], files=2).count() == 100
