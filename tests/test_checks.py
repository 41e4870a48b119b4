"""Each check on clean data, where it finds nothing, and on a seeded defect, where it does."""

from decimal import Decimal

from pyspark.sql import functions as F

from strata.operators import checks as c

FACT = "EMPLOYEE_KEY INT, LOCATION_KEY INT, PAY_PERIOD_ID INT, CODE STRING, AMOUNT DECIMAL(10,2)"
CLEAN = [(1, 1, 25, "A", Decimal("10.00")), (2, 1, 25, "A", Decimal("20.00")), (1, 1, 26, "A", Decimal("30.00"))]


def facts(spark, *more):
    return spark.createDataFrame([*CLEAN, *more], FACT)


def dim(spark, *keys):
    return spark.createDataFrame([(k, f"e{k}", True) for k in keys], "EMPLOYEE_KEY INT, NUMBER STRING, IS_CURRENT BOOLEAN")


def raw(spark, *pages):
    return spark.createDataFrame(list(pages), "ingestion_id STRING, entity_name STRING, partition_column STRING, record_count INT")


def test_raw_checks(spark, rows):
    source = spark.createDataFrame([("f", "01")] * 3, "entity_name STRING, partition_column STRING")
    keys = ["entity_name", "partition_column"]
    assert c.check_bronze_completeness(raw(spark, ("a", "f", "01", 2), ("b", "f", "01", 1)), source, keys).count() == 0
    short = c.check_bronze_completeness(raw(spark, ("a", "f", "01", 2), ("c", "g", "02", 1)), source, keys)
    assert rows(short) == [("f", "01", 2, 3), ("g", "02", 1, 0)]
    catalog = spark.createDataFrame([("d", "FULL_LOAD"), ("f", "INCREMENTAL")], "entity_name STRING, load_type STRING")
    pages = [("a", "d", "FULL_LOAD", 1), ("b", "f", "01", 1), ("c", "f", "02", 1)]
    assert c.check_partition_strategy(raw(spark, *pages), catalog).count() == 0
    assert rows(c.check_partition_strategy(raw(spark, *pages, ("e", "d", "07", 1)), catalog)) == [("d", 2, 1)]
    assert rows(c.check_partition_strategy(raw(spark, ("e", "d", "07", 1)), catalog)) == [("d", 1, 1)]


def test_watermark_must_advance_as_a_number(spark, rows):
    def marks(*pairs):
        return spark.createDataFrame(list(pairs), "entity_name STRING, last_processed_value STRING")

    before = marks(("up", "9"), ("same", "9"), ("gone", "1"))
    found = c.check_watermark_advanced(before, marks(("up", "26"), ("same", "9")))
    assert rows(found) == sorted([("gone", "1", None), ("same", "9", "9")], key=repr)


def test_schema_and_nulls(spark, rows):
    df = facts(spark)
    assert c.check_schema(df, FACT).count() == 0
    assert rows(c.check_schema(df, "AMOUNT DECIMAL(18,2), OTHER INT")) == sorted(
        [("AMOUNT", "decimal(18,2)", "decimal(10,2)"), ("OTHER", "int", None)], key=repr
    )
    assert c.check_nulls(df, df.columns).count() == 0
    holes = facts(spark, (None, 1, None, "A", None), (None, 1, 1, "A", None))
    assert rows(c.check_nulls(holes, df.columns, "t")) == [("t", "AMOUNT", 2), ("t", "EMPLOYEE_KEY", 2), ("t", "PAY_PERIOD_ID", 1)]


def test_amounts(spark, rows):
    odd = facts(spark, (3, 1, 1, "A", Decimal(-1)), (4, 1, 1, "A", Decimal(0)), (5, 1, 1, "A", Decimal(50001)), (6, 1, 1, "A", Decimal(75001)))
    assert c.check_amount_rule(facts(spark), "AMOUNT", ["EMPLOYEE_KEY"]).count() == 0
    got = rows(c.check_amount_rule(odd, "AMOUNT", ["EMPLOYEE_KEY"]), "EMPLOYEE_KEY", "violation")
    assert got == [(3, "NEGATIVE"), (4, "ZERO"), (5, "TOO_HIGH"), (6, "TOO_HIGH")]
    allowed = spark.createDataFrame([(6,)], "EMPLOYEE_KEY INT")
    got = rows(c.check_amount_rule(odd, "AMOUNT", ["EMPLOYEE_KEY"], 75000, allowed), "EMPLOYEE_KEY")
    assert got == [(3,), (4,)]


def test_duplicates_and_grain(spark, rows):
    grain = ["EMPLOYEE_KEY", "PAY_PERIOD_ID", "CODE"]
    assert c.check_duplicates(facts(spark), grain).count() == 0
    assert rows(c.check_fact_grain(facts(spark, CLEAN[0]), grain)) == [(1, 25, "A", 2)]


def test_reconciliation(spark):
    pages = raw(spark, ("a", "f", "25", 60), ("b", "f", "26", 40))
    verdicts = {n: c.reconciliation(pages, spark.range(n)).first()["status"] for n in (101, 100, 96, 95, 0)}
    assert verdicts == {101: "GAINED", 100: "PASS", 96: "PASS", 95: "LOST", 0: "LOST"}
    assert c.check_reconciliation(pages, spark.range(97)).count() == 0
    assert c.check_reconciliation(pages, spark.range(9)).first()["loss_pct"] == 91.0
    assert c.reconciliation(raw(spark, ("a", "f", "25", 0)), spark.range(0)).first()["status"] == "PASS"


def test_layer_reconciliation_and_totals(spark, rows):
    silver, gold = facts(spark), facts(spark)
    pair, amount = ("PAY_PERIOD_ID", "PAY_PERIOD_ID"), ("AMOUNT", "AMOUNT")
    assert c.check_layer_reconciliation(silver, gold, pair, amount).count() == 0
    found = c.check_layer_reconciliation(silver, gold.where("PAY_PERIOD_ID = 25 AND EMPLOYEE_KEY = 1"), pair, amount)
    assert rows(found, "period", "silver_rows", "gold_rows") == sorted([(25, 2, 1), (26, 1, None)], key=repr)
    assert c.check_fact_totals({"x": (silver, "AMOUNT", gold, "AMOUNT")}).count() == 0
    found = c.check_fact_totals({"x": (silver, "AMOUNT", gold.limit(0), "AMOUNT"), "y": (silver, "AMOUNT", gold, "AMOUNT")})
    assert rows(found) == [("x", Decimal("60.00"), Decimal("0.00"))]


def test_key_checks(spark, rows):
    before, after = dim(spark, 1, 2), dim(spark, 1, 2, 3)
    assert c.check_key_stability(before, after, "NUMBER", "EMPLOYEE_KEY").count() == 0
    moved = after.withColumn("EMPLOYEE_KEY", F.col("EMPLOYEE_KEY") * 2 - 1)
    assert rows(c.check_key_stability(before, moved, "NUMBER", "EMPLOYEE_KEY")) == [("e2", 2, 3)]
    assert c.check_key_uniqueness(after, ["EMPLOYEE_KEY", "NUMBER"]).count() == 0
    assert rows(c.check_key_uniqueness(dim(spark, 1, 1), ["EMPLOYEE_KEY", "NUMBER"])) == [("EMPLOYEE_KEY", "1", 2), ("NUMBER", "e1", 2)]
    assert c.check_dim_current(after, "NUMBER").count() == 0
    assert rows(c.check_dim_current(dim(spark, 1, 1, 2), "NUMBER")) == [("e1", 2)]
    assert rows(c.check_dim_current(dim(spark, 1).withColumn("IS_CURRENT", F.lit(False)), "NUMBER")) == [("e1", 0)]


def test_foreign_keys(spark, rows):
    whole, d = facts(spark), dim(spark, 1, 2)
    torn = facts(spark, (None, 1, 25, "B", None), (9, None, 25, "B", None), (9, 1, 25, "C", None))
    assert c.check_null_fk(whole, ["EMPLOYEE_KEY", "LOCATION_KEY"]).count() == 0
    assert rows(c.check_null_fk(torn, ["EMPLOYEE_KEY", "LOCATION_KEY"])) == [(25, 2, 1, 1)]
    assert c.check_orphans(whole, d, "EMPLOYEE_KEY", "PAY_PERIOD_ID").count() == 0
    assert rows(c.check_orphans(torn, d, "EMPLOYEE_KEY", "PAY_PERIOD_ID")) == sorted([(9, 25, 2), (None, 25, 1)], key=repr)
    assert c.check_orphan_pct(whole, d, "EMPLOYEE_KEY", "f").count() == 0
    assert rows(c.check_orphan_pct(torn, d, "EMPLOYEE_KEY", "f")) == [("f", 6, 3, 50.0)]
    assert c.check_orphans_anti(whole, d, "EMPLOYEE_KEY").count() == 0
    assert c.check_orphans_anti(torn, d, "EMPLOYEE_KEY").count() == 3


def test_runs_and_periods(spark, rows):
    a, b = facts(spark), facts(spark, (1, 1, 26, "B", Decimal("1.00")))
    assert c.check_idempotent(a, facts(spark), ["EMPLOYEE_KEY"], "AMOUNT").count() == 0
    assert rows(c.check_idempotent(a, b, ["EMPLOYEE_KEY"], "AMOUNT"), "EMPLOYEE_KEY", "run") == [(1, "first"), (1, "second")]
    assert c.check_period_checksum(a.where("PAY_PERIOD_ID = 25"), b, "PAY_PERIOD_ID", "AMOUNT").count() == 0
    assert rows(c.check_period_checksum(a, b, "PAY_PERIOD_ID", "AMOUNT")) == [(26, 3000, 1, 3100, 2)]


def test_star_columns(spark, rows):
    config = [{"target": "PAY_PERIOD_ID", "is_degenerate_dim": True}, {"target": "CODE", "is_degenerate_dim": True}, {"target": "AMOUNT", "is_measure": True}]
    assert c.check_star_columns(facts(spark).withColumn("LOAD_DATETIME", F.lit(1)), config).count() == 0
    assert rows(c.check_star_columns(facts(spark).withColumn("FULL_NAME", F.lit(1)), config)) == [("FULL_NAME",)]


def test_lineage(spark, rows):
    pages = raw(spark, ("p1", "f", "25", 2))
    typed = spark.createDataFrame([("e1", 25, "p1"), ("e2", 25, "p1")], "n STRING, p INT, source_file_id STRING")
    gold = spark.createDataFrame([("e1", 25), ("e2", 25)], "N STRING, P INT")
    keys = {"n": "N", "p": "P"}
    assert c.check_lineage(gold, typed, pages, keys).count() == 0
    lost = c.check_lineage(gold, typed.where("n = 'e1'").withColumn("source_file_id", F.lit("p9")), pages, keys)
    assert rows(lost) == [("star_without_typed", 1), ("typed_without_raw", 1)]


def test_layer_counts(spark, rows):
    pages, typed = raw(spark, ("a", "f", "26", 3)), spark.range(3)
    assert c.check_pipeline_counts(pages, typed, spark.range(3)).count() == 0
    assert rows(c.check_pipeline_counts(pages, typed, spark.range(2))) == [(3, 3, 2)]
    assert c.check_pipeline_counts(pages.limit(0), typed, typed).count() == 1
    assert rows(c.layer_health({"a": typed, "b": spark.range(0), "raw": pages})) == [("a", 3, "PASS"), ("b", 0, "FAIL"), ("raw", 3, "PASS")]


def test_report_blocks_on_critical_failures_only(spark):
    none, some = spark.range(0), spark.range(2)
    results = c.check_results({"t1": ("HIGH", none), "t2": ("LOW", some), "t3": ("MEDIUM", none)})
    report = c.check_suite_report(results).first()
    assert (report["total_tests"], report["passed"], report["failed"], report["pass_rate"]) == (3, 2, 1, 66.67)
    assert report["deployment_recommendation"] == "APPROVED"
    blocked = c.check_suite_report(c.check_results({"t1": ("HIGH", some)})).first()
    assert (blocked["critical_failures"], blocked["deployment_recommendation"]) == (1, "BLOCKED")
    assert c.check_suite_report(results.limit(0)).first()["pass_rate"] == 0.0


def test_scorecard(spark):
    df = facts(spark, CLEAN[0])
    scores = c.quality_scorecard(
        df, ["EMPLOYEE_KEY", "PAY_PERIOD_ID", "CODE"], ["AMOUNT"], F.col("AMOUNT") > 0, F.col("CODE") == "A", F.col("PAY_PERIOD_ID") > 25
    )
    got = {r["dimension"]: (r["actual"], r["status"]) for r in scores.collect()}
    assert got["uniqueness"] == (75.0, "FAIL") and got["completeness"] == (100.0, "PASS") and got["timeliness"] == (25.0, "FAIL")


def test_registered_checks_read_whole_tables(spark):
    from strata.suite import checking

    class Stand:
        """Layers with a star row too few in period 26, a typed row of period 3 without its page and a star row of period 4 without its typed row."""

        def first_load(self):
            return self

        def bronze(self, entity, partition=None):
            pages = spark.createDataFrame([("p25", "25", 1), ("p26", "26", 3)], "ingestion_id string, partition_column string, record_count long")
            return pages.where(f"partition_column = '{partition}'") if partition else pages

        def silver(self, entity):
            rows = [("e1", 3, "A", 1.0, "lost"), *[(f"e{i}", 26, "A", 1.0, "p26") for i in (1, 2, 3)]]
            return spark.createDataFrame(
                rows, "employee_number string, pay_period_id int, earning_code string, earning_amount double, source_file_id string")

        def gold(self, table):
            if table == "dwh_dim_employee":
                return spark.createDataFrame([(i, f"e{i}") for i in (1, 2, 3)], "EMPLOYEE_KEY int, EMPLOYEE_NUMBER string")
            return spark.createDataFrame(
                [(1, 3, "A", 1.0), (1, 4, "A", 1.0), (1, 26, "A", 1.0), (2, 26, "A", 1.0)],
                "EMPLOYEE_KEY int, PAY_PERIOD_ID int, EARNING_CODE string, EARNING_AMOUNT double")

    counts = checking.check_e2e_counts(None, Stand()).first()
    assert (counts.bronze_count, counts.silver_count, counts.gold_count) == (3, 3, 2)
    differ = {r.period: (r.silver_rows, r.gold_rows) for r in checking.check_layer_reconciliation(None, Stand()).collect()}
    assert differ[26] == (3, 2)
    found = sorted((r["break"], r.rows) for r in checking.check_lineage(None, Stand()).collect())
    assert found == [("star_without_typed", 1), ("star_without_typed", 3), ("typed_without_raw", 1), ("typed_without_raw", 4)]
