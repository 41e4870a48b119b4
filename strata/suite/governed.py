"""Queries over row filters, masks, classification, retention and subject requests."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import governance as g
from strata.operators.skew import lookup_join
from strata.session import stored
from strata.suite.registry import Layers, query
from strata.suite.samples import FINAL, Samples

PEOPLE = ["employee_number", "full_name", "department", "hire_date"]
_OWN = "(SELECT min(email) FROM emp_final WHERE department = 'FURNITURE')"


def secured(s: Samples, l: Layers) -> DataFrame:
    """Earnings with the e-mail and department of their employee, as the secure views see them."""
    people = s.employees().select("employee_number", F.col("email").alias("employee_email"), "department")
    facts = l.silver("fact_earnings").select("employee_number", "pay_period_id", "earning_code")
    on = [("employee_number", "employee_number")]
    return lookup_join(facts, people, on, ["employee_email", "department"]).where("employee_email IS NOT NULL")


def someone(s: Samples) -> str:
    return s.employees().where("department = 'FURNITURE'").agg(F.min("email")).first()[0]


_SECURED = """SELECT s.employee_number, pay_period_id, earning_code, email AS employee_email, department
  FROM silver_earn s JOIN emp_final USING (employee_number)"""


@query(
    "rls_self_or_admin",
    f"""SELECT 'self' AS seen_as, count(*) AS n, count(DISTINCT employee_email) AS people FROM ({_SECURED}) WHERE employee_email = {_OWN}
       UNION ALL SELECT 'admin', count(*), count(DISTINCT employee_email) FROM ({_SECURED})""",
)
def rls_self_or_admin(s: Samples, l: Layers) -> DataFrame:
    """One employee's view, and the view of an administrator (employees with the title LEAD)."""
    admins = s.employees().where("job_title = 'LEAD' AND department <> 'FURNITURE'").select("email")
    boss = admins.agg(F.max("email")).first()[0]
    held, out = stored(secured(s, l), "secured"), None
    for seen_as, user in (("self", someone(s)), ("admin", boss)):
        rows = g.rls_self_or_admin(held, admins, user)
        view = rows.groupBy("employee_email").agg(F.count(F.lit(1)).alias("n")).agg(
            F.lit(seen_as).alias("seen_as"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("people")
        )
        out = view if out is None else out.unionByName(view)
    return out


@query(
    "rls_role_department",
    f"""SELECT 'employee' AS seen_as, department, count(*) AS n FROM ({_SECURED}) WHERE employee_email = {_OWN} GROUP BY ALL
       UNION ALL SELECT 'payroll', department, count(*) FROM ({_SECURED}) GROUP BY ALL
       UNION ALL SELECT 'manager', department, count(*) FROM ({_SECURED}) WHERE department IN ('BUILDING', 'MACHINERY')
         OR employee_email = {_OWN} GROUP BY ALL""",
)
def rls_role_department(s: Samples, l: Layers) -> DataFrame:
    user = someone(s)
    segments = s.table("customer").select(F.col("c_mktsegment").alias("dept")).distinct()
    managed = segments.where("dept IN ('BUILDING', 'MACHINERY')").withColumn("manager_email", F.lit(user))
    held, out = stored(secured(s, l), "secured"), None
    for seen_as, role in (("employee", "Employees"), ("payroll", "PayrollManagers"), ("manager", "DepartmentManagers")):
        roles = s.employees().select(F.lit(role).alias("role"), "email").where(F.col("email") == user)
        rows = g.rls_role_department(held, roles, managed, user)
        view = rows.groupBy("department").agg(F.count(F.lit(1)).alias("n")).withColumn("seen_as", F.lit(seen_as))
        out = view if out is None else out.unionByName(view)
    return out


def staff(s: Samples) -> DataFrame:
    return s.employees().withColumn("full_name", F.concat_ws(" ", "first_name", "last_name")).select(
        *PEOPLE, "ssn", "salary", "email", "phone"
    )


@query(
    "cls_conditional",
    """SELECT employee_number, full_name, department, hire_date, email, phone,
         CASE WHEN department = 'BUILDING' THEN ssn ELSE '***-**-****' END AS ssn,
         CASE WHEN department = 'BUILDING' THEN salary END AS salary FROM emp_final""",
)
def cls_conditional(s: Samples, l: Layers) -> DataFrame:
    return g.cls_conditional(staff(s), F.col("department") == "BUILDING", {"ssn": g.HIDDEN_SSN}, ["salary"])


@query("cls_exclude", "SELECT employee_number, full_name, department, hire_date, email, phone FROM emp_final")
def cls_exclude(s: Samples, l: Layers) -> DataFrame:
    return g.cls_exclude(staff(s), ["ssn", "salary"])


@query(
    "mask_columns",
    """SELECT employee_number, full_name, department, hire_date, '***-**-' || right(ssn, 4) AS ssn,
         '****@' || split_part(email, '@', 2) AS email, CAST(NULL AS DECIMAL(10,2)) AS salary,
         '(' || substring(phone, 1, 3) || ') ***-****' AS phone FROM emp_final""",
)
def mask_columns(s: Samples, l: Layers) -> DataFrame:
    return g.mask_columns(staff(s))


@query(
    "mask_functions",
    """SELECT employee_number, CASE WHEN department = 'BUILDING' THEN ssn ELSE '***-**-' || right(ssn, 4) END AS ssn,
         '****@' || split_part(email, '@', 2) AS email FROM emp_final""",
)
def mask_functions(s: Samples, l: Layers) -> DataFrame:
    g.register_mask_functions(s.spark)
    return staff(s).selectExpr(
        "employee_number", "mask_ssn(ssn, department = 'BUILDING') AS ssn", "mask_email(email, false) AS email"
    )


def _pii_sql(column: str, kind: str) -> str:
    return f"""SELECT 'documents' AS table_name, '{column}' AS column_name, '{kind}' AS pii_type,
      count(*) FILTER (WHERE regexp_matches({column}, '{g.PII_PATTERNS[kind]}')) AS matching_rows, count(*) AS total_rows FROM documents"""


_PII = " UNION ALL ".join(_pii_sql(c, k) for c in ("text", "lang", "source") for k in g.PII_PATTERNS)


@query("pii_scan", f"SELECT * FROM ({_PII}) WHERE matching_rows > 0")
def pii_scan(s: Samples, l: Layers) -> DataFrame:
    return g.pii_scan(s.table("documents"), "documents")


@query(
    "classification_tags",
    f"""SELECT table_name, column_name, pii_type, CASE pii_type WHEN 'SSN' THEN 'HighlyConfidential' ELSE 'Confidential' END
         AS sensitivity, TRUE AS contains_pii, 365 AS retention_days, 'GDPR' AS compliance_tags
       FROM ({_PII}) WHERE matching_rows > 0""",
)
def classification_tags(s: Samples, l: Layers) -> DataFrame:
    return g.classification_tags(g.pii_scan(s.table("documents"), "documents"), {"documents": 365})


_CUT = f"DATE '{FINAL}' - INTERVAL {g.RETENTION_DAYS['silver']} DAY"


@query(
    "retention_purge",
    f"SELECT pay_period_id, count(*) AS n, CAST(sum(earning_amount) AS DECIMAL(20,2)) AS amount FROM silver_earn WHERE modified_on >= {_CUT} GROUP BY ALL",
)
def retention_purge(s: Samples, l: Layers) -> DataFrame:
    kept = g.retention_purge(l.silver("fact_earnings"), "modified_on", FINAL, g.RETENTION_DAYS["silver"])
    return kept.groupBy("pay_period_id").agg(F.count(F.lit(1)).alias("n"), F.sum("earning_amount").alias("amount"))


@query(
    "archive_expired",
    f"SELECT pay_period_id, count(*) AS n, CAST(sum(earning_amount) AS DECIMAL(20,2)) AS amount FROM silver_earn WHERE modified_on < {_CUT} GROUP BY ALL",
)
def archive_expired(s: Samples, l: Layers) -> DataFrame:
    gone = g.archive_expired(l.silver("fact_earnings"), "modified_on", FINAL, g.RETENTION_DAYS["silver"])
    return gone.groupBy("pay_period_id").agg(F.count(F.lit(1)).alias("n"), F.sum("earning_amount").alias("amount"))


def leavers(s: Samples) -> DataFrame:
    """The persons who ask: employees who left."""
    return s.employees().where("termination_date IS NOT NULL").select("employee_number")


_LEFT = "SELECT employee_number FROM emp_final WHERE termination_date IS NOT NULL"


@query(
    "subject_access",
    f"""SELECT 'dim_employee' AS table_name, employee_number AS subject, 1::BIGINT AS records, TRUE AS complete FROM emp_final
         WHERE employee_number IN ({_LEFT})
       UNION ALL SELECT 'fact_earnings', employee_number, count(*), TRUE FROM silver_earn
         WHERE employee_number IN ({_LEFT}) GROUP BY employee_number""",
)
def subject_access(s: Samples, l: Layers) -> DataFrame:
    tables = {
        "dim_employee": (l.silver("dim_employee"), "employee_number"),
        "fact_earnings": (l.silver("fact_earnings"), "employee_number"),
    }
    rows = g.subject_access(tables, leavers(s), "employee_number")
    own = F.get_json_object("record", "$.employee_number") == F.col("subject")
    return rows.groupBy("table_name", "subject").agg(
        F.count(F.lit(1)).alias("records"), F.bool_and(own).alias("complete")
    )


@query(
    "subject_erasure",
    f"""SELECT 'erased' AS kind, employee_number, email, phone FROM emp_final WHERE employee_number NOT IN ({_LEFT})
       UNION ALL SELECT 'blanked', employee_number, CASE WHEN employee_number NOT IN ({_LEFT}) THEN email END,
         CASE WHEN employee_number NOT IN ({_LEFT}) THEN phone END FROM emp_final""",
)
def subject_erasure(s: Samples, l: Layers) -> DataFrame:
    people = s.employees().select("employee_number", "email", "phone")
    erased = g.subject_erasure(people, leavers(s), "employee_number", "employee_number")
    blanked = g.subject_erasure(people, leavers(s), "employee_number", "employee_number", ["email", "phone"])
    return erased.withColumn("kind", F.lit("erased")).unionByName(blanked.withColumn("kind", F.lit("blanked")))


@query(
    "audit_summary",
    """SELECT user_email, table_name, accesses, first_access, last_access, idle_days,
         CASE WHEN idle_days > 90 THEN 'INACTIVE'
              WHEN accesses > 0.5 * (date_diff('day', CAST(first_access AS DATE), CAST(last_access AS DATE)) + 1) THEN 'UNUSUAL'
              ELSE 'NORMAL' END AS activity
       FROM (SELECT 'user' || CAST(user_id AS VARCHAR) AS user_email, event_type AS table_name, count(*) AS accesses,
               min(ts) AS first_access, max(ts) AS last_access,
               CAST(date_diff('day', CAST(max(ts) AS DATE), DATE '2024-04-25') AS INTEGER) AS idle_days
             FROM events GROUP BY user_id, event_type)""",
)
def audit_summary(s: Samples, l: Layers) -> DataFrame:
    log = s.events().select(
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("user_email"),
        F.col("event_type").alias("table_name"), F.col("ts").alias("accessed_at"),
    )
    return g.audit_summary(log, "2024-04-25", usual_per_day=0.5)
