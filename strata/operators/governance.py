"""Row filters, column masks, classification, retention and subject requests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.expr import hide, mask_email, mask_phone, mask_ssn
from strata.operators.skew import flag_join
from strata.session import local_rows

# Days each layer keeps its rows, and typed dimensions.
RETENTION_DAYS = {"bronze": 90, "silver": 365, "silver_dim": 30, "gold": 2555}
# Fixed value: whether expired rows are archived before they go.
ARCHIVE_FIRST = {"bronze": False, "silver": True, "silver_dim": True, "gold": True}
# Fixed value: what hides a sensitive identifier completely.
HIDDEN_SSN = "***-**-****"
# How personal data looks in text. They test for presence, so an address needs only its
# last character before the @; a longer head would be tried again from every place of a long word.
PII_PATTERNS = {
    "EMAIL": r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2}",
    "SSN": r"\b\d{3}-\d{2}-\d{4}\b",
    "PHONE": r"(\(\d{3}\) ?|\b\d{3}[-. ])\d{3}[-. ]\d{4}\b",
}
# Sensitivity of each kind of personal data.
SENSITIVITY = {"SSN": "HighlyConfidential", "EMAIL": "Confidential", "PHONE": "Confidential"}


def user_column(user: str | None) -> Column:
    return F.current_user() if user is None else F.lit(user)


def rls_self_or_admin(df: DataFrame, admins: DataFrame, user: str | None = None, email: str = "employee_email") -> DataFrame:
    """A user's own rows; all rows for a user listed in ``admins(email)``."""
    who = user_column(user)
    is_admin = admins.where(F.col("email") == who).agg(F.count(F.lit(1)) > 0).scalar()
    return df.where((F.col(email) == who) | is_admin)


def rls_role_department(
    df: DataFrame,
    roles: DataFrame,
    departments: DataFrame,
    user: str | None = None,
    email: str = "employee_email",
    department: str = "department",
    all_role: str = "PayrollManagers",
    department_role: str = "DepartmentManagers",
) -> DataFrame:
    """Own rows, all rows for ``all_role``, and one's departments for ``department_role``.

    Membership is a table ``roles(role, email)`` and management ``departments(dept, manager_email)``.
    """
    who = user_column(user)
    mine = roles.where(F.col("email") == who)
    sees_all = mine.agg(F.count_if(F.col("role") == all_role) > 0).scalar()
    sees_some = mine.agg(F.count_if(F.col("role") == department_role) > 0).scalar()
    managed = departments.where(F.col("manager_email") == who).select("dept")
    flagged = flag_join(df, managed, [(department, "dept")], "__managed")
    allowed = (F.col(email) == who) | sees_all | (sees_some & F.col("__managed"))
    return flagged.where(allowed).select(*df.columns)


def cls_conditional(
    df: DataFrame, show: Column | bool, masked: Mapping[str, str], hidden: Sequence[str] = ()
) -> DataFrame:
    """Columns replaced by a fixed text, or by NULL, unless ``show`` holds."""
    flag = show if isinstance(show, Column) else F.lit(show)
    out = {c: F.when(flag, F.col(c)).otherwise(F.lit(text)) for c, text in masked.items()}
    out.update({c: hide(c, flag) for c in hidden})
    return df.withColumns(out)


def cls_exclude(df: DataFrame, sensitive: Sequence[str]) -> DataFrame:
    return df.drop(*sensitive)


def mask_columns(df: DataFrame, show: Column | bool = False) -> DataFrame:
    """SSN to its last four digits, e-mail to its domain, phone to its area code, salary to NULL."""
    masks = {"ssn": mask_ssn, "email": mask_email, "phone": mask_phone, "salary": hide}
    return df.withColumns({c: mask(c, show) for c, mask in masks.items() if c in df.columns})


def register_mask_functions(spark: SparkSession) -> None:
    """SQL functions ``mask_ssn(value, show_all)`` and ``mask_email(value, show_all)`` for views."""
    bodies = {
        "mask_ssn": "concat('***-**-', right(value, 4))",
        "mask_email": "concat('****@', split_part(value, '@', 2))",
    }
    for name, body in bodies.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(value STRING, show_all BOOLEAN) RETURNS STRING "
            f"RETURN CASE WHEN show_all THEN value ELSE {body} END"
        )


def pii_scan(df: DataFrame, table: str, patterns: Mapping[str, str] | None = None) -> DataFrame:
    """(table, column, kind, matching rows, rows) for string columns that hold personal data.

    Every value of every string column is tested, whole, in one pass.
    """
    kinds = patterns or PII_PATTERNS
    columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    tests = {f"{c}|{k}": F.count_if(F.col(c).rlike(p)) for c in columns for k, p in kinds.items()}
    if not tests:
        return local_rows(
            df.sparkSession, [], "table_name STRING, column_name STRING, pii_type STRING, matching_rows BIGINT, total_rows BIGINT"
        )
    counts = df.agg(F.count(F.lit(1)).alias("total_rows"), *[t.alias(n) for n, t in tests.items()])
    long = counts.unpivot(["total_rows"], list(tests), "__what", "matching_rows")
    return long.where("matching_rows > 0").select(
        F.lit(table).alias("table_name"),
        F.substring_index("__what", "|", 1).alias("column_name"),
        F.substring_index("__what", "|", -1).alias("pii_type"),
        "matching_rows",
        "total_rows",
    )


def classification_tags(scan: DataFrame, retention: Mapping[str, int], compliance: str = "GDPR") -> DataFrame:
    """Classification table from scan results: sensitivity, kind and retention days of each column."""
    kinds = F.create_map(*[F.lit(x) for kv in SENSITIVITY.items() for x in kv])
    days = F.create_map(*[F.lit(x) for kv in retention.items() for x in kv])
    return scan.select(
        "table_name",
        "column_name",
        "pii_type",
        F.coalesce(kinds[F.col("pii_type")], F.lit("Internal")).alias("sensitivity"),
        F.lit(True).alias("contains_pii"),
        days[F.col("table_name")].alias("retention_days"),
        F.lit(compliance).alias("compliance_tags"),
    )


def retention_cutoff(as_of: str, days: int) -> Column:
    """The first day that is kept."""
    return F.date_sub(F.lit(as_of).cast("date"), days)


def retention_purge(df: DataFrame, column: str, as_of: str, days: int) -> DataFrame:
    """Rows within retention. A row without a date is kept: its age is unknown."""
    return df.where(F.col(column).isNull() | (F.col(column) >= retention_cutoff(as_of, days)))


def archive_expired(df: DataFrame, column: str, as_of: str, days: int) -> DataFrame:
    """The rows ``retention_purge`` drops, to be written elsewhere first."""
    return df.where(F.col(column) < retention_cutoff(as_of, days))


def subject_access(tables: Mapping[str, tuple[DataFrame, str]], subjects: DataFrame, key: str) -> DataFrame:
    """Every row about the subjects: (table_name, subject, record as JSON)."""
    out = None
    for name, (df, column) in tables.items():
        rows = flag_join(df, subjects, [(column, key)], "__subject").where("__subject").select(
            F.lit(name).alias("table_name"),
            F.col(column).alias("subject"),
            F.to_json(F.struct(*df.columns)).alias("record"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def subject_erasure(
    df: DataFrame, subjects: DataFrame, column: str, key: str, blank: Sequence[str] | None = None
) -> DataFrame:
    """Without the subjects' rows; or, with ``blank``, with those columns emptied in their rows."""
    flagged = flag_join(df, subjects, [(column, key)], "__subject")
    if blank is None:
        return flagged.where(~F.col("__subject")).drop("__subject")
    return flagged.withColumns({c: F.when(~F.col("__subject"), F.col(c)) for c in blank}).drop("__subject")


def audit_summary(
    log: DataFrame, as_of: str, idle_days: int = 90, usual_per_day: float = 50.0,
    user: str = "user_email", table: str = "table_name", ts: str = "accessed_at",
) -> DataFrame:
    """Accesses per user and table, marking inactive users and unusually busy ones."""
    base = log.groupBy(user, table).agg(
        F.count(F.lit(1)).alias("accesses"), F.min(ts).alias("first_access"), F.max(ts).alias("last_access")
    )
    idle = F.datediff(F.lit(as_of).cast("date"), F.col("last_access"))
    span = F.datediff("last_access", "first_access") + 1
    return base.withColumn("idle_days", idle).withColumn(
        "activity",
        F.when(F.col("idle_days") > idle_days, "INACTIVE")
        .when(F.col("accesses") > usual_per_day * span, "UNUSUAL")
        .otherwise("NORMAL"),
    )


def access_review(
    log: DataFrame, as_of: str, days: int = 90, roles: Sequence[str] = ("Admin", "Member")
) -> DataFrame:
    """Privileged accounts that were not used for more than ``days``."""
    idle = F.datediff(F.lit(as_of).cast("date"), F.col("last_access_date"))
    return log.where(F.col("role").isin(list(roles))).withColumn("days_since_access", idle).where(
        F.col("days_since_access") > days
    )
