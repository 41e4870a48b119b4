import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.operators import quality as q
from strata.operators import typing as t
from strata.plans.layers import ENTITIES, silver


def raw(spark, *payloads):
    data = [(f"i{n}", p) for n, p in enumerate(payloads)]
    return spark.createDataFrame(data, "ingestion_id STRING, payload_json STRING").withColumns(
        {"ingestion_datetime": F.lit("2024-01-01").cast("timestamp"), "entity_name": F.lit("x")}
    )


def test_parse_accepts_both_forms_and_lists_unreadable_payloads(spark, rows):
    bronze = raw(spark, '[{"a": 1}, {"a": 2}]', '{"Data": [{"a": 3}], "Paging": {}}', "not json", "[]", None)
    assert rows(t.parse_payload(bronze, "a INT", keep=["ingestion_id"])) == [("i0", 1), ("i0", 2), ("i1", 3)]
    assert rows(t.unreadable_payloads(bronze), "ingestion_id") == [("i2",)]


def test_infer_schema_merges_all_payloads(spark):
    bronze = raw(spark, '[{"a": 1}]', '{"Data": [{"a": 2.5, "b": "x"}]}', "not json", '[{"c": {"d": true}}]')
    found = t.infer_payload_schema(bronze)
    assert {f.name for f in found.fields} == {"a", "b", "c"}
    assert found["c"].dataType.simpleString() == "struct<d:boolean>"
    assert {f.name for f in t.infer_payload_schema(bronze, n=1).fields} == {"a"}
    assert t.infer_payload_schema(bronze.limit(0)).fields == []


def test_flatten(spark, rows):
    df = spark.sql("SELECT 1 AS id, named_struct('b', named_struct('c', 2), 'l', array(named_struct('z', 3), named_struct('z', 4))) AS a")
    flat = t.flatten_struct(df)
    assert flat.columns == ["id", "a_b_c", "a_l_z"] and rows(flat) == [(1, 2, 3), (1, 2, 4)]
    kept = t.flatten_struct(spark.sql("SELECT array() AS a, 1 AS i"))
    assert rows(kept) == [(None, 1)]


def test_cast_counts_lost_values(spark, rows):
    df = spark.createDataFrame([("12", "2024-02-30"), ("x", "2024-02-01"), (None, None)], "n STRING, d STRING")
    got = rows(t.typed_cast(df, {"n": "int", "d": "date"}, errors="lost"))
    assert got == sorted([(12, None, 1), (None, datetime.date(2024, 2, 1), 1), (None, None, 0)], key=repr)


def test_new_columns_are_added_and_old_rows_hold_null(spark, rows):
    table = spark.createDataFrame([(1, Decimal("2.50"))], "id INT, amount DECIMAL(10,2)")
    incoming = spark.createDataFrame([("7", 2, "n")], "amount STRING, ID INT, extra STRING")
    assert t.detect_new_columns(incoming.schema, table.schema) == [("extra", "string")]
    assert rows(t.evolve_append(table, incoming)) == [(1, Decimal("2.50"), None), (2, Decimal("7.00"), "n")]


def test_common_types_hold_both():
    assert t.common_type("bigint", "bigint") == "bigint"
    assert t.common_type("decimal(2,1)", "decimal(5,2)") == "decimal(5,2)"
    assert t.common_type("bigint", "decimal(3,2)") == "decimal(21,2)"
    assert t.common_type("decimal(38,0)", "decimal(3,2)") == "string"
    assert t.common_type("double", "bigint") == "double"
    assert t.common_type("boolean", "bigint") == t.common_type("string", "double") == "string"


def test_evolve_catalog_table(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS evolving")
    spark.range(1).write.option("path", str(tmp_path / "e")).saveAsTable("evolving")
    assert t.evolve_table(spark, "evolving", spark.sql("SELECT 1L AS id, 'a' AS b").schema) == ["b"]
    assert spark.table("evolving").columns == ["id", "b"]
    assert t.evolve_table(spark, "evolving", spark.table("evolving").schema) == []
    spark.sql("DROP TABLE evolving")


def test_payload_keys(spark, rows):
    bronze = raw(spark, '{"Data": [], "Paging": {}, "ResponseStatus": {}}', '{"Data": []}', "[]")
    got = rows(t.payload_key_check(bronze), "ingestion_id", "missing_keys")
    assert got == [("i1", ["Paging", "ResponseStatus"]), ("i2", ["Data", "Paging", "ResponseStatus"])]


DEFECTS = [
    ("e1", "1", "reg", "10.00"), ("e1", "1", "REG", "11.00"), (None, "1", "REG", "10"), ("e2", "0", "REG", "10"),
    ("e2", "27", "REG", "10"), ("e2", None, "REG", "10"), ("e3", "2", "OT", "-1"), ("e3", "2", "OT", None),
    ("e4", "26", "OT", "0"), ("e5", "3", "OT", "abc"),
]


def defects(spark):
    return spark.createDataFrame(DEFECTS, "employee_number STRING, pay_period_id STRING, earning_code STRING, earning_amount STRING")


def test_rules_split_without_losing_rows(spark, rows):
    typed = t.typed_cast(defects(spark), {"pay_period_id": "int", "earning_amount": "decimal(10,2)"})
    rules = [q.not_null("employee_number"), q.non_negative("earning_amount"), q.in_period_range("pay_period_id")]
    good, bad = q.split_rejects(typed, rules)
    assert good.count() + bad.count() == len(DEFECTS)
    assert rows(good, "employee_number") == [("e1",), ("e1",), ("e4",)]
    failed = {r["employee_number"]: r["failed_rules"] for r in bad.collect()}
    assert failed["e5"] == ["earning_amount_non_negative"] and failed[None] == ["employee_number_not_null"]
    assert q.split_rejects(typed, [])[0].count() == len(DEFECTS)


def test_single_rules(spark):
    df = t.typed_cast(defects(spark), {"pay_period_id": "int", "earning_amount": "decimal(10,2)"})
    assert q.rule_not_null(df, "employee_number").count() == 9
    assert q.rule_non_negative(df, "earning_amount").count() == 7
    assert q.rule_period_range(df, "pay_period_id").count() == 7
    assert q.rule_pattern(df, "earning_code", "^[A-Z]+$").count() == 9


def test_dedup_breaks_ties_by_content_and_limits_before_the_shuffle(spark, rows, plan):
    data = [("k", 1, "a"), ("k", 2, "a"), ("k", 2, "b"), ("k", 2, None), ("j", None, "z")]
    df = spark.createDataFrame(data, "k STRING, at INT, v STRING")
    latest = q.dedup_latest(df, ["k"], ["at"])
    assert rows(latest) == [("j", None, "z"), ("k", 2, "b")]
    assert rows(q.dedup_latest(df.orderBy(F.desc("v")), ["k"], ["at"])) == rows(latest)
    text = plan(latest)
    assert text.count("WindowGroupLimit") == 2 and text.rindex("WindowGroupLimit") > text.index("Exchange hashpartitioning")


def test_random_ids_never_decide_a_tie(spark):
    df = spark.createDataFrame([("k", 1, "a", "zz"), ("k", 1, "b", "aa")], "k STRING, at INT, v STRING, source_file_id STRING")
    assert q.dedup_latest(df, ["k"], ["at"]).first()["v"] == "b"


def test_standardise(spark, rows):
    df = spark.createDataFrame(
        [("reg", Decimal(2), Decimal(3), Decimal(9)), ("ot", None, Decimal(3), Decimal(9))], "earning_code STRING, hours DECIMAL(5,2), rate DECIMAL(10,2), earning_amount DECIMAL(10,2)"
    )
    got = rows(q.earnings_standardise(df), "earning_code", "total_earnings")
    assert got == [("OT", Decimal("9.00")), ("REG", Decimal("6.00"))]
    people = spark.sql(
        "SELECT * FROM VALUES ('A', 'B', DATE'2020-01-01', NULL), ('C', NULL, DATE'2030-01-01', NULL), "
        "('D', 'E', DATE'2030-01-01', DATE'2031-01-01') AS t(first_name, last_name, hire_date, termination_date)"
    )
    assert rows(q.employee_standardise(people, "2024-01-01"), "full_name", "employment_status") == [
        ("A B", "ACTIVE"), ("C", "FUTURE_HIRE"), ("D E", "TERMINATED")
    ]


def test_defaults_and_audit(spark, rows):
    df = spark.createDataFrame([(None, 1), ("x", None)], "a STRING, b INT")
    assert rows(q.default_nulls(df, {"a": "none", "b": 0, "c": 1})) == [("none", 1), ("x", 0)]
    audited = q.add_audit_columns(df, "r1", "2024-01-01")
    assert set(audited.columns) >= {"source_system", "ingestion_datetime", "processed_datetime", "pipeline_run_id"}
    kept = q.add_audit_columns(df.withColumn("ingestion_datetime", F.lit(1)), "r1", "2024-01-01")
    assert dict(kept.dtypes)["ingestion_datetime"] == "int"


def test_silver_joins_codes_that_differ_in_case(spark):
    payload = """[{"employee_number": "e1", "pay_period_id": 1, "earning_code": "reg", "earning_amount": 10, "modified_on": "2024-01-01"},
      {"employee_number": "e1", "pay_period_id": 1, "earning_code": "REG", "earning_amount": 12, "modified_on": "2024-01-02"},
      {"employee_number": "e1", "pay_period_id": 30, "earning_code": "REG", "earning_amount": 12, "modified_on": "2024-01-02"}]"""
    got = silver(raw(spark, payload), ENTITIES["fact_earnings"], "2024-01-03").collect()
    assert [(r["earning_code"], r["earning_amount"], r["source_file_id"]) for r in got] == [("REG", Decimal("12.00"), "i0")]


def test_quality_metrics(spark):
    typed = t.typed_cast(defects(spark), {"pay_period_id": "int", "earning_amount": "decimal(10,2)"})
    typed = typed.withColumn("earning_code", F.upper("earning_code"))
    flagged = q.flag_rejects(typed, [q.not_null("employee_number"), q.non_negative("earning_amount")])
    row = q.silver_quality_metrics(flagged, ["employee_number", "pay_period_id", "earning_code"], "x", 0, 1.5).first()
    assert (row["rows_read"], row["rows_rejected"], row["rows_after_dedup"], row["duration_seconds"]) == (10, 4, 5, 1.5)


def test_unknown_watermark_type(spark):
    from strata.functions.expr import typed

    with pytest.raises(ValueError):
        typed("x", "float")
