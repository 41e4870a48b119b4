import datetime

import pytest
from pyspark.sql import functions as F

from strata.operators import control, star
from strata.operators.skew import flag_join, hot_keys, lookup_join, lookup_joins, number_rows, previous_value

TARGET = "SK INT, BK STRING, A STRING, IS_CURRENT BOOLEAN, CREATED_AT TIMESTAMP, UPDATED_AT TIMESTAMP"


def source(spark, *pairs):
    return spark.createDataFrame(list(pairs), "BK STRING, A STRING")


def merge(spark, target, src, day, update=("A",)):
    merged = star.merge_dimension_scd1(target, src, "BK", "SK", list(update), day)
    return spark.createDataFrame(merged.collect(), merged.schema)


def test_merge_keeps_keys_over_three_loads(spark, rows):
    none = spark.createDataFrame([], TARGET)
    one = merge(spark, none, source(spark, ("b", "1"), ("d", "1"), (None, "9")), "2024-01-01")
    assert rows(one, "BK", "SK") == [("b", 1), ("d", 2)]
    two = merge(spark, one, source(spark, ("a", "2"), ("b", None), ("d", "1"), ("c", "2")), "2024-02-01")
    assert rows(two, "BK", "SK", "A") == [("a", 3, "2"), ("b", 1, None), ("c", 4, "2"), ("d", 2, "1")]
    stamps = {r["BK"]: (r["CREATED_AT"].month, r["UPDATED_AT"].month) for r in two.collect()}
    assert stamps == {"a": (2, 2), "b": (1, 2), "c": (2, 2), "d": (1, 1)}
    again = merge(spark, two, source(spark, ("a", "2"), ("b", None), ("c", "2")), "2024-03-01")
    assert rows(again) == rows(two)
    assert all(r["IS_CURRENT"] for r in again.collect())


def test_merge_updates_only_listed_columns(spark, rows):
    none = spark.createDataFrame([], TARGET)
    one = merge(spark, none, source(spark, ("b", "1")), "2024-01-01")
    assert rows(merge(spark, one, source(spark, ("b", "2")), "2024-02-01", update=()), "A") == [("1",)]


def test_duplicate_business_keys_stop_the_merge(spark):
    with pytest.raises(Exception, match="duplicate BK"):
        merge(spark, spark.createDataFrame([], TARGET), source(spark, ("b", "1"), ("b", "2")), "2024-01-01")


def test_keys_start_at_the_configured_value(spark, rows):
    none = spark.createDataFrame([], "BK STRING, SK INT")
    assert rows(star.assign_surrogate_keys(none, source(spark, ("b", "1"), ("a", "1")), "BK", "SK", 100)) == [("a", 100), ("b", 101)]


def test_numbering_is_dense_ordered_and_uses_many_partitions(spark, plan):
    df = spark.range(5000).select(F.concat(F.lit("k"), F.lpad(F.hash("id").cast("string"), 12, "0")).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one range
    try:
        numbered = number_rows(df, ["k"], "n")
        got = [r["n"] for r in numbered.orderBy("k").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == list(range(1, 5001))
    # Rows stay in the ranges that were checkpointed: only their counts, by range, move again.
    assert "hashpartitioning(__p" not in plan(numbered) and "Exchange rangepartitioning" not in plan(numbered)
    assert numbered.select(F.spark_partition_id()).distinct().count() > 1
    heavy = [line for line in plan(numbered).splitlines() if "SinglePartition" in line]
    assert len(heavy) == 1, "only the sizes of the partitions may meet in one task"


def test_scd2_and_as_of(spark, rows):
    h = spark.createDataFrame([], "BK STRING, A STRING, EFFECTIVE_FROM DATE, EFFECTIVE_TO DATE, IS_CURRENT BOOLEAN")
    loads = [("2024-01-01", [("a", "1"), ("b", "1")]), ("2024-02-01", [("a", "2"), ("c", None)]), ("2024-03-01", [("a", "2"), ("c", "3")])]
    for day, pairs in loads:
        h = star.merge_dimension_scd2(h, source(spark, *pairs), "BK", ["A"], day)
    d = datetime.date
    end = d(9999, 12, 31)
    assert rows(h) == sorted([
        ("a", "1", d(2024, 1, 1), d(2024, 2, 1), False), ("a", "2", d(2024, 2, 1), end, True),
        ("b", "1", d(2024, 1, 1), end, True), ("c", None, d(2024, 2, 1), d(2024, 3, 1), False), ("c", "3", d(2024, 3, 1), end, True),
    ], key=repr)
    assert rows(star.dim_as_of(h, "2024-02-01"), "BK", "A") == sorted([("a", "2"), ("b", "1"), ("c", None)], key=repr)
    assert rows(star.dim_as_of(h, "2024-01-31"), "BK", "A") == [("a", "1"), ("b", "1")]
    assert rows(star.merge_dimension_scd2(h, source(spark, ("a", "2")), "BK", ["A"], "2024-04-01")) == rows(h)


def test_change_feed(spark, rows):
    before, after = source(spark, ("a", "1"), ("b", None), ("c", "1")), source(spark, ("a", "2"), ("b", None), ("d", "1"))
    feed = star.snapshot_change_feed(before, after, "BK", ["A"])
    assert rows(feed) == [("a", "update", "1", "2"), ("c", "delete", "1", None), ("d", "insert", None, "1")]


def skewed_facts(spark):
    """A third of the rows hold one known key, a third one unknown key, a few no key."""
    key = (
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "lost").when(F.col("id") % 50 == 2, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 40).cast("string")))
    )
    return spark.range(0, 3000, numPartitions=4).select("id", key.alias("code"))


def members(spark):
    names = [("hot", 0)] + [(f"k{i}", i + 1) for i in range(30)]
    return spark.createDataFrame(names, "CODE STRING, SK INT")


def test_lookup_gives_the_same_rows_broadcast_and_shuffled(spark, rows):
    facts, dim = skewed_facts(spark), members(spark)
    small = lookup_join(facts, dim, [("code", "CODE")], ["SK"])
    large = lookup_join(facts, dim, [("code", "CODE")], ["SK"], max_bytes=0)
    assert rows(small) == rows(large) and large.count() == 3000
    want = {r["CODE"]: r["SK"] for r in dim.collect()}
    assert all(r["SK"] == want.get(r["code"]) for r in large.collect())


def test_hot_keys_are_found_without_shuffling_keys(spark, rows, plan):
    keys = skewed_facts(spark).select(F.col("code").alias("a"), F.lit(7).alias("b")).where("a IS NOT NULL")
    found = hot_keys(keys, [["a", "b"]], 8)[0]
    assert rows(found) == [("hot", 7), ("lost", 7)]
    # The sketches are kept, one row a group of partitions, and no key was shuffled for them.
    assert "ReadSchema: struct<top0" in plan(found) and "hashpartitioning(key" not in plan(found)
    assert rows(hot_keys(keys.limit(0), [["a", "b"]], 8)[0]) == []


def test_shuffled_lookup_spreads_hot_keys(spark, plan):
    """No shuffle partition of the facts may hold a third of them, whether the hot key is known or not."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        joined = lookup_join(skewed_facts(spark), members(spark), [("code", "CODE")], ["SK"], max_bytes=0)
        assert "hashpartitioning(__l0" in plan(joined) and "__salt" in plan(joined).split("hashpartitioning(__l0")[1][:40]
        sizes = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert sizes < 600
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_small_lookup_broadcasts_and_does_not_shuffle_facts(spark, plan):
    text = plan(lookup_join(skewed_facts(spark), members(spark), [("code", "CODE")], ["SK"]))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_lookup_on_two_keys_and_flags(spark, rows):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a")], "x INT, y STRING")
    right = spark.createDataFrame([(1, "a", 10)], "p INT, q STRING, v INT")
    for size in (None, 0):
        got = lookup_join(left, right, [("x", "p"), ("y", "q")], ["v"], size)
        assert rows(got) == sorted([(1, "a", 10), (1, "b", None), (None, "a", None)], key=repr)
        flags = flag_join(left, right, [("y", "q")], "known", size)
        assert rows(flags, "y", "known") == [("a", True), ("a", True), ("b", False)]


def test_fk_lookup_follows_the_configuration(spark, rows):
    lookups = [{"dimension_table": "d", "business_key_column": "code", "surrogate_key_column": "SK", "join_type": "left"}]
    facts = spark.createDataFrame([("hot",), ("none",), (None,)], "code STRING")
    assert rows(star.fk_lookup(facts, {"d": members(spark)}, lookups)) == sorted([("hot", 0), ("none", None), (None, None)], key=repr)
    inner = [{**lookups[0], "join_type": "inner"}]
    assert rows(star.fk_lookup(facts, {"d": members(spark)}, inner)) == [("hot", 0)]


def test_previous_value_crosses_ranges(spark, rows):
    data = [("a", 1, 10), ("a", 5, 20), ("a", 31, 30), ("a", 65, None), ("a", 66, 40), ("b", 2, 1)]
    df = spark.createDataFrame(data, "k STRING, t INT, v INT")
    got = previous_value(df, ["k"], ["t"], "v", "prev")
    assert rows(got, "k", "t", "prev") == sorted(
        [("a", 1, None), ("a", 5, 10), ("a", 31, 20), ("a", 65, 30), ("a", 66, None), ("b", 2, None)], key=repr
    )


def test_previous_value_splits_a_long_key(spark):
    """One key with all rows is cut over several tasks and still sees every neighbour."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(2000).select(F.lit("k").alias("k"), "id", (F.col("id") * 2).alias("v"))
        got = previous_value(df, ["k"], ["id"], "v", "prev")
        assert got.where("id > 0 AND (prev IS NULL OR prev <> v - 2)").count() == 0
        assert got.where("prev IS NULL").count() == 1 and got.count() == 2000
        assert got.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_incremental_filter_reaches_the_scan(spark, plan, tmp_path):
    path = str(tmp_path / "f")
    spark.range(100).select("id", (F.col("id") % 26 + 1).cast("int").alias("p")).write.partitionBy("p").parquet(path)
    fresh = star.incremental_filter(spark.read.parquet(path), "p", "24")
    assert "PartitionFilters: [isnotnull(p" in plan(fresh) and fresh.count() == 6
    assert star.incremental_filter(fresh, "p", None).count() == 6
    with pytest.raises(ValueError):
        star.incremental_filter(fresh, "p", 1, "text")
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-05')) AS d")
    assert star.incremental_filter(days, "d", "2024-01-03", "date").count() == 2


def log(spark, *events):
    rows = [(f"x{i}", *e) for i, e in enumerate(events)]
    return spark.createDataFrame(rows, "execution_id STRING, table_name STRING, watermark_value STRING, status STRING, error_message STRING, at INT").select(
        "*", F.timestamp_seconds("at").alias("execution_start")
    )


def test_watermarks_compare_by_type(spark, rows):
    events = log(spark, ("t", "9", "SUCCESS", None, 1), ("t", "26", "SUCCESS", None, 2), ("t", "27", "FAILED", "e", 3), ("u", "x", "SUCCESS", None, 4))
    assert rows(control.high_watermark(events)) == sorted([("t", 26), ("u", None)], key=repr)
    assert control.last_watermark(events, "t") == 26 and control.last_watermark(events, "v") is None


def test_next_watermark(spark, rows):
    marks = spark.createDataFrame([("int", "25"), ("date", "2024-02-28"), ("timestamp", "2024-12-31 23:30:00"), ("int", "bad")], "watermark_type STRING, last_processed_value STRING")
    got = rows(control.next_watermark(marks), "last_processed_value", "next_value")
    assert got == [("2024-02-28", "2024-02-29"), ("2024-12-31 23:30:00", "2025-01-01 00:30:00"), ("25", "26"), ("bad", None)]
    with pytest.raises(Exception, match="unknown watermark type"):
        control.next_watermark(spark.createDataFrame([("text", "1")], marks.schema)).collect()


def test_watermark_upsert(spark):
    update = spark.createDataFrame([("s", "e", "p", "int", "5", 10)], "source_system STRING, entity_name STRING, watermark_column STRING, watermark_type STRING, last_processed_value STRING, records_ingested BIGINT")
    first = control.watermark_upsert(spark.createDataFrame([], "source_system STRING, entity_name STRING, watermark_column STRING, watermark_type STRING, last_processed_value STRING, last_ingestion_time TIMESTAMP, records_ingested BIGINT, is_active BOOLEAN, created_at TIMESTAMP, updated_at TIMESTAMP"), update, "2024-01-01")
    assert all(v is not None for v in first.first()) and first.first()["is_active"]
    again = control.watermark_upsert(first, update.withColumn("last_processed_value", F.lit("6")), "2024-02-01").collect()
    assert [(r["last_processed_value"], r["created_at"].month, r["updated_at"].month) for r in again] == [("6", 1, 2)]


def test_worklist_stops_at_the_current_period(spark, rows):
    catalog = spark.createDataFrame(
        [("done", "INCREMENTAL", 1, True), ("open", "INCREMENTAL", 1, True), ("new", "INCREMENTAL", 25, True), ("dim", "FULL_LOAD", None, True), ("off", "INCREMENTAL", 1, False)],
        "entity_name STRING, load_type STRING, start_period INT, is_active BOOLEAN",
    )
    marks = spark.createDataFrame([("done", "26", True), ("open", "24", True)], "entity_name STRING, last_processed_value STRING, is_active BOOLEAN")
    got = rows(control.period_worklist(catalog, marks, 26), "entity_name", "period", "partition_column")
    assert got == sorted([("dim", None, "FULL_LOAD"), ("new", 25, "25"), ("new", 26, "26"), ("open", 25, "25"), ("open", 26, "26")], key=repr)


def test_execution_log_state(spark):
    events = [
        control.execution_log_append(spark, "r1", "t", "2024-01-01 00:00:00"),
        control.execution_log_append(spark, "r1", "t", "2024-01-01 00:00:00", "SUCCESS", watermark_value="26", records_written=5),
        control.execution_log_append(spark, "r2", "t", "2024-01-02 00:00:00"),
    ]
    state = {r["execution_id"]: r for r in control.execution_state(events[0].unionByName(events[1]).unionByName(events[2])).collect()}
    assert (state["r1"]["status"], state["r1"]["watermark_value"], state["r1"]["records_written"]) == ("SUCCESS", "26", 5)
    assert state["r1"]["execution_start"] is not None and state["r2"]["status"] == "RUNNING"


def test_failed_worklist_ignores_repaired_tables(spark, rows):
    events = log(spark, ("t", "1", "FAILED", "e", 1), ("t", "1", "SUCCESS", None, 2), ("u", "4", "SUCCESS", None, 1), ("u", "5", "FAILED", "boom", 3))
    assert rows(control.failed_worklist(events), "table_name", "watermark_value", "error_message") == [("u", "5", "boom")]


def test_rollup_statuses(spark, rows):
    jobs = spark.createDataFrame(
        [("r1", "a", 1, 2, "SUCCESS", None), ("r1", "b", 1, 3, "FAILED", "x"), ("r2", "a", 1, 2, "FAILED", "y"), ("r3", "a", 1, 2, "FAILED", "z"),
         ("r3", "a", 3, 4, "SUCCESS", None), ("r4", "a", 1, None, "RUNNING", None)],
        "orchestrator_run_id STRING, job_name STRING, job_start INT, job_end INT, status STRING, error_message STRING",
    )
    got = rows(control.orchestrator_rollup(jobs), "orchestrator_run_id", "status", "total_jobs", "failed_jobs", "error_summary")
    assert got == [("r1", "PARTIAL", 2, 1, "b: x"), ("r2", "FAILED", 1, 1, "a: y"), ("r3", "SUCCESS", 1, 0, None), ("r4", "RUNNING", 1, 0, None)]


def test_count_variance(spark, rows):
    events = spark.createDataFrame([("t", f"x{i}", i * 3000, n) for i, n in enumerate([100, 105, 130, 0, 5, 5])], "table_name STRING, execution_id STRING, s INT, records_written BIGINT")
    got = control.count_variance(events.withColumn("execution_start", F.timestamp_seconds("s")))
    assert rows(got, "execution_id", "previous_rows") == [("x2", 105), ("x3", 130), ("x4", 0)]


def shuffles(spark, work):
    """How many shuffles ``work`` makes."""
    counter = spark.sparkContext._jsc.sc()
    before = counter.newShuffleId()
    work()
    return counter.newShuffleId() - before - 1


def test_numbering_moves_rows_once(spark):
    df = spark.range(10_000).select(F.xxhash64("id").alias("k"))
    # One for the ranges, two for the counts of the ranges and the window over them.
    assert shuffles(spark, lambda: number_rows(df, ["k"], "n").write.format("noop").mode("overwrite").save()) <= 3
    got = number_rows(df, ["k"], "n", 5).orderBy("k").collect()
    assert [r.n for r in got] == list(range(5, 10_005)) and number_rows(df.limit(0), ["k"], "n").count() == 0


def test_merge_joins_once_and_numbers_the_new_rows_alone(spark):
    schema = "K INT, BK STRING, V INT, CREATED_AT TIMESTAMP, UPDATED_AT TIMESTAMP"
    target = spark.createDataFrame([], schema)
    first = spark.range(0, 3000, 3).selectExpr("cast(id AS string) AS BK", "1 AS V")
    one = star.merge_dimension_scd1(target, first, "BK", "K", ["V"], "2024-01-01")
    assert sorted(r.K for r in one.collect()) == list(range(1, 1001))
    second = spark.range(0, 3000, 2).selectExpr("cast(id AS string) AS BK", "2 AS V")
    after = star.merge_dimension_scd1(one, second, "BK", "K", ["V"], "2024-01-02")
    rows = {r.BK: r for r in after.collect()}
    kept = {r.BK: r.K for r in one.collect()}
    assert len(rows) == 2000 and all(rows[b].K == k for b, k in kept.items())
    new = sorted(b for b in rows if b not in kept)
    assert [rows[b].K for b in new] == list(range(1001, 2001))
    assert all(rows[b].V == (2 if int(b) % 2 == 0 else 1) for b in rows)
    again = star.merge_dimension_scd1(after, second, "BK", "K", ["V"], "2024-01-03")
    assert again.where("UPDATED_AT >= '2024-01-03'").count() == 0 and again.count() == 2000


def test_frequent_keys_of_all_lookups(spark, tmp_path):
    path = str(tmp_path / "f")
    spark.range(20_000).selectExpr("if(id % 3 = 0, 7, id) AS a", "if(id % 3 = 1, 'x', cast(id AS string)) AS b", "id").write.parquet(path)
    facts = spark.read.parquet(path)
    found = hot_keys(facts, [["a"], ["b"]], 8)
    assert [tuple(map(tuple, f.collect())) for f in found] == [((7,),), (("x",),)]
    one = spark.range(0, 20_000).selectExpr("id AS A", "id * 2 AS AK")
    two = spark.range(0, 20_000, 2).selectExpr("cast(id AS string) AS B", "id + 1 AS BK").union(spark.sql("SELECT 'x', -1"))
    lookups = [(one, [("a", "A")], ["AK"]), (two, [("b", "B")], ["BK"])]
    large = lookup_joins(facts, lookups, max_bytes=0)
    small = lookup_joins(facts, lookups)
    assert sorted(map(tuple, large.collect()), key=repr) == sorted(map(tuple, small.collect()), key=repr)


def test_lookups_without_frequent_or_known_keys(spark):
    facts = spark.createDataFrame([(None, None), (1, "u"), (2, None)], "a int, b string")
    dim = spark.createDataFrame([(1, 10)], "A int, AK int")
    none = spark.createDataFrame([], "B string, BK int")
    got = lookup_joins(facts, [(dim, [("a", "A")], ["AK"]), (none, [("b", "B")], ["BK"])], max_bytes=0)
    assert sorted(map(tuple, got.collect()), key=repr) == [(1, "u", 10, None), (2, None, None, None), (None, None, None, None)]
