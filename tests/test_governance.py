import pytest
from pyspark.sql import functions as F

from strata.functions.expr import mask_email, mask_phone, mask_ssn
from strata.operators import governance as g

STAFF = "employee_email STRING, department STRING, ssn STRING, email STRING, phone STRING, salary INT"


@pytest.fixture()
def staff(spark):
    return spark.createDataFrame(
        [("a@x", "D1", "123-45-6789", "a@x.org", "(555) 123-4567", 1), ("b@x", "D1", None, "nobody", "555-1", 2), ("c@x", "D2", "9", None, None, 3)],
        STAFF,
    )


def table(spark, ddl, *rows):
    return spark.createDataFrame(list(rows), ddl)


def test_own_rows_or_all_for_admins(spark, staff, rows):
    admins = table(spark, "email STRING", ("boss@x",), ("boss@x",))
    assert rows(g.rls_self_or_admin(staff, admins, "a@x"), "employee_email") == [("a@x",)]
    assert g.rls_self_or_admin(staff, admins, "boss@x").count() == 3
    assert g.rls_self_or_admin(staff, admins, "other@x").count() == 0
    assert g.rls_self_or_admin(staff, admins).count() == 0  # the session's own user


def test_roles_and_departments(spark, staff, rows):
    departments = table(spark, "dept STRING, manager_email STRING", ("D2", "a@x"), ("D2", "a@x"), ("D1", "z@x"))

    def seen(user, *roles):
        held = table(spark, "role STRING, email STRING", *[(r, user) for r in roles], ("PayrollManagers", "boss@x"))
        return [r[0] for r in rows(g.rls_role_department(staff, held, departments, user), "employee_email")]

    assert seen("a@x") == ["a@x"], "managing a department without the role shows nothing more"
    assert seen("a@x", "DepartmentManagers") == ["a@x", "c@x"]
    assert seen("b@x", "DepartmentManagers") == ["b@x"]
    assert seen("boss@x") == ["a@x", "b@x", "c@x"]


def test_column_rules(spark, staff, rows):
    masked = g.cls_conditional(staff, F.col("department") == "D2", {"ssn": g.HIDDEN_SSN}, ["salary"])
    assert rows(masked, "employee_email", "ssn", "salary") == [("a@x", "***-**-****", None), ("b@x", "***-**-****", None), ("c@x", "9", 3)]
    assert "ssn" not in g.cls_exclude(staff, ["ssn", "salary"]).columns


def test_masks(spark, staff, rows):
    got = rows(g.mask_columns(staff), "employee_email", "ssn", "email", "phone", "salary")
    assert got[0] == ("a@x", "***-**-6789", "****@x.org", "(555) ***-****", None)
    assert got[1][2:] == ("****@", "(555) ***-****", None) and got[1][1] is None
    assert rows(g.mask_columns(staff, True), "ssn") == rows(staff, "ssn")
    row = staff.limit(1).select(mask_ssn("ssn", F.lit(None).cast("boolean")), mask_email("email", F.lit(True)), mask_phone("phone")).first()
    assert row[:2] == ("***-**-6789", "a@x.org")


def test_sql_masks(spark, staff, rows):
    g.register_mask_functions(spark)
    got = rows(staff.selectExpr("mask_ssn(ssn, department = 'D2')", "mask_email(email, false)"))
    assert ("***-**-6789", "****@x.org") in got and ("9", None) in got


def test_pii_scan_and_tags(spark, rows):
    docs = table(spark, "id INT, body STRING, lang STRING", (1, "write to a.b@mail.example.org", "en"), (2, "call 555-123-4567 or 555.123.4567", "en"), (3, "no 123-45-6789 here\n" + "x" * 10000 + " c@d.io", None))
    scan = g.pii_scan(docs, "docs")
    assert rows(scan) == [("docs", "body", "EMAIL", 2, 3), ("docs", "body", "PHONE", 1, 3), ("docs", "body", "SSN", 1, 3)]
    tags = g.classification_tags(scan, {"docs": 90})
    assert rows(tags, "pii_type", "sensitivity", "retention_days")[-1] == ("SSN", "HighlyConfidential", 90)
    assert g.pii_scan(spark.range(3), "n").count() == 0


def test_retention_splits_the_table(spark, rows):
    df = spark.sql("SELECT * FROM VALUES (1, DATE'2024-01-01'), (2, DATE'2024-04-01'), (3, NULL) AS t(id, d)")
    kept, gone = g.retention_purge(df, "d", "2024-06-30", 90), g.archive_expired(df, "d", "2024-06-30", 90)
    assert rows(kept, "id") == [(2,), (3,)] and rows(gone, "id") == [(1,)]


def test_subject_requests(spark, staff, rows):
    who = table(spark, "e STRING", ("a@x",), ("a@x",), ("zz",))
    found = g.subject_access({"staff": (staff, "employee_email"), "copy": (staff, "employee_email")}, who, "e")
    assert rows(found, "table_name", "subject") == [("copy", "a@x"), ("staff", "a@x")]
    assert rows(g.subject_erasure(staff, who, "employee_email", "e"), "employee_email") == [("b@x",), ("c@x",)]
    blank = g.subject_erasure(staff, who, "employee_email", "e", ["ssn", "salary"])
    assert rows(blank, "employee_email", "salary") == sorted([("a@x", None), ("b@x", 2), ("c@x", 3)], key=repr)


def test_audit_and_access_review(spark, rows):
    data = [("u1", "t", "2024-01-01"), ("u2", "t", "2024-06-01"), *[("u3", "t", "2024-06-02")] * 60]
    log = table(spark, "user_email STRING, table_name STRING, d STRING", *data).withColumn("accessed_at", F.col("d").cast("timestamp"))
    got = rows(g.audit_summary(log, "2024-06-10"), "user_email", "activity")
    assert got == [("u1", "INACTIVE"), ("u2", "NORMAL"), ("u3", "UNUSUAL")]
    access = table(spark, "user_email STRING, role STRING, d STRING", ("a", "Admin", "2024-01-01"), ("b", "Viewer", "2024-01-01"), ("c", "Member", "2024-06-01"))
    review = g.access_review(access.withColumn("last_access_date", F.col("d").cast("date")), "2024-06-10")
    assert rows(review, "user_email", "days_since_access") == [("a", 161)]
