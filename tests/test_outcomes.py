"""What becomes of landed records: the account of a load, and what is kept of the lost ones."""

import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from strata import session
from strata.operators.outcomes import check_accounted, read_pages, reject_summary
from strata.operators.skew import lookup_join
from strata.plans.layers import ENTITIES, judged_records
from strata.plans.warehouse import Warehouse
from strata.sources.landing import RAW_PARTITIONS
from strata.sources.tables import replace_partitions

AT = "2024-01-02 06:00:00"


def record(n, period, amount="5", hours="1", **more):
    return {"employee_number": n, "pay_period_id": period, "earning_code": "a", "earning_amount": amount, "hours": hours, **more}


def land(w, *pages):
    """Raw pages as (period, payload, record_count)."""
    columns = "partition_column STRING, payload_json STRING, record_count INT"
    rows = w.spark.createDataFrame([(f"{p:02d}", text, n) for p, text, n in pages], columns)
    given = {"partition_column", "payload_json", "record_count"}
    schema = w.spark.createDataFrame([], Warehouse.RAW_SCHEMA).schema
    fixed = {"entity_name": F.lit("fact_earnings"), "ingestion_id": F.uuid(), "ingestion_datetime": F.lit(AT).cast("timestamp")}
    rest = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in given and f.name not in fixed}
    replace_partitions(rows.withColumns({**rest, **fixed}).select(schema.names), w.path("bronze", "extracts"), RAW_PARTITIONS)


@pytest.fixture()
def w(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "w"))


GOOD_PAGE = json.dumps([record("p", 1), record("q", 1), record("p", 1, "7")])
ODD_PAGE = json.dumps({"Data": [record("p", 2, "-1"), record(None, 2), record("q", 2, hours="two"), record("r", 99, hours="x"), record("s", 2)]})


def test_every_record_has_one_outcome(w, rows):
    land(w, (1, GOOD_PAGE, 3), (2, ODD_PAGE, 5), (3, GOOD_PAGE[:-1], 3), (4, None, 2), (4, None, 0), (4, "[]", 0), (5, "7", 1))
    w.build_silver("fact_earnings", AT)
    account = w.load_accounts().first().asDict()
    counts = {k: account[k] for k in ("landed", "good", "lost_cast", "rejected", "unreadable", "unreadable_pages", "rows_written")}
    assert counts == {"landed": 14, "good": 4, "lost_cast": 1, "rejected": 3, "unreadable": 6, "unreadable_pages": 3, "rows_written": 4}
    assert check_accounted(w.load_accounts()).count() == 0
    assert rows(w.silver("fact_earnings"), "employee_number", "pay_period_id", "hours") == rows(
        w.spark.sql("SELECT * FROM VALUES ('p', 1, 1bd), ('q', 1, 1bd), ('q', 2, null), ('s', 2, 1bd) AS t(a, b, c)")
        .select("a", "b", F.col("c").cast("decimal(5,2)"))
    )
    found = {(r.reason, r.outcome): r.records for r in reject_summary(w.rejects()).collect()}
    assert found == {
        ("unreadable_page", "unreadable"): 6, ("earning_amount_non_negative", "rejected"): 1, ("employee_number_not_null", "rejected"): 1,
        ("pay_period_id_in_range", "rejected"): 1, ("hours_cast", "rejected"): 1, ("hours_cast", "lost_cast"): 1,
    }
    texts = {r.content for r in w.rejects().where("outcome = 'unreadable'").collect()}
    assert texts == {GOOD_PAGE[:-1], None, "7"}
    assert json.loads(w.rejects().where("outcome = 'lost_cast'").first()["content"])["hours"] == "two"


def test_mended_pages_leave_no_rejects(w):
    land(w, (1, GOOD_PAGE[:-1], 3), (2, ODD_PAGE, 5))
    w.build_silver("fact_earnings", AT)
    land(w, (1, GOOD_PAGE, 3))
    w.build_silver("fact_earnings", AT, period=1)
    assert {r.partition_column for r in w.rejects().select("partition_column").collect()} == {"02"}
    assert [r.good for r in w.load_accounts().orderBy("landed").collect()] == [3, 1]
    assert check_accounted(w.load_accounts().withColumn("landed", F.col("landed") + 1)).count() == 2


def test_clean_loads_write_no_rejects(w):
    land(w, (1, GOOD_PAGE, 3))
    w.build_silver("fact_earnings", AT)
    assert w.rejects().count() == 0 and w.load_accounts().first()["unreadable_pages"] == 0


def test_payload_columns_may_have_any_name(w):
    land(w, (1, json.dumps([record("p", 1, content="c", outcome="o", lost=3)]), 1))
    assert sorted(w.build_silver("fact_earnings", AT)) == ["content", "lost", "outcome"]
    assert w.silver("fact_earnings").select("content", "outcome", "lost").first() == ("c", "o", 3)


def test_payloads_are_parsed_in_one_scan(w, plan):
    land(w, (1, GOOD_PAGE, 3))
    judged = judged_records(w.bronze("fact_earnings"), ENTITIES["fact_earnings"], AT)
    assert plan(judged).count("FileScan") == 1 and "Exchange" not in plan(judged)
    assert read_pages(w.bronze("fact_earnings"), "employee_number STRING", ["ingestion_id"]).count() == 3


def test_records_do_not_carry_their_page_along(w, plan):
    land(w, (1, GOOD_PAGE, 3))
    text = plan(judged_records(w.bronze("fact_earnings"), ENTITIES["fact_earnings"], AT))
    explode = next(line for line in text.splitlines() if "Generate" in line)
    assert "payload" not in explode and "__found" not in explode and text.count("from_json(") == 1


def test_pages_are_written_in_small_row_groups(w, tmp_path):
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(200)), lambda i: F.sha2(F.concat(F.col("id"), i), 512)), "")
    pages = w.spark.range(2400, numPartitions=1).select(text.alias("payload_json"), F.lit("01").alias("partition_column"))
    replace_partitions(pages, str(tmp_path / "pages"), ["partition_column"])
    files = list((tmp_path / "pages").rglob("*.parquet"))
    groups = [g for f in files for g in map(pq.ParquetFile(f).metadata.row_group, range(pq.ParquetFile(f).metadata.num_row_groups))]
    assert sum(g.num_rows for g in groups) == 2400 and max(g.total_byte_size for g in groups) < 24e6


def test_loads_read_and_write_in_small_tasks(spark, w, monkeypatch):
    writes, write = [], DataFrameWriter.parquet

    def parquet(writer, path, *args, **options):
        writes.append((path, *[spark.conf.get(key) for key in session.TASK_SIZES], spark.conf.get(session.OPEN)))
        return write(writer, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    monkeypatch.setattr(session, "TASK_BYTES", 4096)
    sizes = [spark.conf.get(key) for key in session.TASK_SIZES]
    open_files = spark.conf.get(session.OPEN)
    records = spark.range(20000).selectExpr(
        "concat('p', id) AS employee_number", "1 AS pay_period_id", "'a' AS earning_code", "id % 7 - 1 AS earning_amount")
    w.land(records, "fact_earnings", "pay_period_id", AT)
    w.build_silver("fact_earnings", AT, evolve=False)
    loads = [x for x in writes if "/bronze/" in x[0] or "/silver/" in x[0] or "/judged-" in x[0]]
    assert len(loads) == 4 and all(x[1:3] == ("4096b", "4096b") for x in loads)
    assert [x[3] for x in writes if "/judged-" in x[0]] == [str(session.OPEN_FILES)]
    assert [spark.conf.get(key) for key in session.TASK_SIZES] == sizes and spark.conf.get(session.OPEN) == open_files
    assert w.silver("fact_earnings").count() == 20000 - w.rejects().count() == 20000 - 2858


def test_small_tasks_cut_files_and_keep_smaller_sizes(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(200000).selectExpr("id", "sha2(string(id), 256) AS h").coalesce(1).write.option("parquet.block.size", 65536).parquet(path)
    monkeypatch.setattr(session, "TASK_BYTES", 256 * 1024)
    whole = spark.read.parquet(path).rdd.getNumPartitions()
    with session.small_tasks(spark):
        assert spark.read.parquet(path).rdd.getNumPartitions() > 4 * whole
        monkeypatch.setattr(session, "TASK_BYTES", 1024 * 1024)
        with session.small_tasks(spark):
            assert spark.conf.get(session.TASK_SIZES[0]) == f"{256 * 1024}b"


def test_partitions_are_replaced_in_small_tasks(spark, tmp_path, monkeypatch):
    source = str(tmp_path / "source")
    spark.range(100000).selectExpr("id", "sha2(string(id), 256) AS h", "1 AS p").coalesce(1).write.option("parquet.block.size", 65536).parquet(source)
    monkeypatch.setattr(session, "TASK_BYTES", 1024 * 1024)
    assert spark.read.parquet(source).rdd.getNumPartitions() < 5
    assert replace_partitions(spark.read.parquet(source), str(tmp_path / "t"), ["p"], arranged=True) == 100000
    assert len(list((tmp_path / "t").rglob("*.parquet"))) > 5


def test_large_tables_are_not_broadcast_by_their_file_size(spark, plan, tmp_path):
    for name, n in (("facts", 400_000), ("people", 200_000)):
        spark.range(n).selectExpr("id AS k", f"id AS {name}").write.parquet(str(tmp_path / name))
    facts, people = (spark.read.parquet(str(tmp_path / name)) for name in ("facts", "people"))
    found = lookup_join(facts, people, [("k", "k")], ["people"], max_bytes=1024)
    assert "SortMergeJoin" in plan(found)
    assert found.agg({"people": "count"}).first()[0] == 200_000
    joined = facts.join(people, "k")
    assert "BroadcastHashJoin" in plan(joined)
    before = spark.conf.get(session.AUTO_BROADCAST)
    with session.small_tasks(spark):
        assert "SortMergeJoin" in plan(facts.join(people, "k"))
        assert all(int(spark.conf.get(key)[:-1]) <= 8 << 20 for key in session.TASK_SIZES)
    assert spark.conf.get(session.AUTO_BROADCAST) == before
