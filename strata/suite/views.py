"""The samples and layers once more, as SQL views for the comparison engine."""

from strata.suite.registry import VIEWS
from strata.suite.samples import EARLY, FINAL, LOADED_AT


def _employees(day: str) -> str:
    return f"""
  SELECT c_name AS employee_number, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
    hire_date, CASE WHEN c_acctbal < 0 THEN last_day END AS termination_date, c_mktsegment AS department,
    CASE WHEN orders >= 10 THEN 'LEAD' WHEN orders >= 5 THEN 'SENIOR' ELSE 'JUNIOR' END AS job_title,
    n_name AS location_code,
    lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.example.com' AS email,
    CAST(200 + c_nationkey AS VARCHAR) || '-555-' || lpad(CAST(c_custkey AS VARCHAR), 4, '0') AS phone,
    lpad(CAST(c_custkey % 899 + 100 AS VARCHAR), 3, '0') || '-' || lpad(CAST(c_custkey % 89 + 10 AS VARCHAR), 2, '0')
      || '-' || lpad(CAST(c_custkey AS VARCHAR), 4, '0') AS ssn,
    CAST(c_acctbal AS DECIMAL(10,2)) AS salary,
    split_part(c_name, '#', 1) || ' ' || split_part(c_name, '#', 2) AS full_name,
    CASE WHEN c_acctbal < 0 THEN 'TERMINATED' WHEN hire_date > DATE '{day}' THEN 'FUTURE_HIRE' ELSE 'ACTIVE' END
      AS employment_status
  FROM customer
  JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS hire_date, CAST(max(o_orderdate) AS DATE) AS last_day,
          count(*) AS orders
        FROM orders WHERE o_orderdate <= TIMESTAMP '{day} 00:00:00' GROUP BY o_custkey) ON o_custkey = c_custkey
  JOIN nation ON n_nationkey = c_nationkey"""


VIEWS["emp_early"] = _employees(EARLY)
VIEWS["emp_final"] = _employees(FINAL)
VIEWS["loc"] = """
  SELECT n_name AS location_code, 'Site ' || n_name AS location_name, 'City ' || CAST(n_nationkey AS VARCHAR) AS city,
    'S' || CAST(n_regionkey AS VARCHAR) AS state, n_name AS country, r_name AS region, TRUE AS is_active
  FROM nation JOIN region ON n_regionkey = r_regionkey"""
VIEWS["pay_lines"] = """
  SELECT lineitem.*, 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS employee_number,
    CAST(least(26, floor((dayofyear(l_shipdate) - 1) / 14) + 1) AS INTEGER) AS pay_period_id,
    CAST(l_shipdate AS DATE) AS modified_on, n_name AS location_code,
    CAST(p_retailprice AS DECIMAL(10,2)) AS rate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"""
VIEWS["earn_rec"] = """
  SELECT employee_number, pay_period_id,
    CASE WHEN l_linenumber % 2 = 0 THEN lower(l_returnflag) ELSE l_returnflag END AS earning_code, location_code,
    'Earning ' || l_returnflag AS earning_description, CAST(l_extendedprice AS DECIMAL(10,2)) AS earning_amount,
    CAST(l_quantity AS DECIMAL(5,2)) AS hours, rate, modified_on
  FROM pay_lines"""
VIEWS["ded_rec"] = """
  SELECT employee_number, pay_period_id, l_linestatus AS deduction_code, location_code,
    'Deduction ' || l_linestatus AS deduction_description,
    CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(10,2)) AS deduction_amount,
    modified_on
  FROM pay_lines"""
VIEWS["tax_rec"] = """
  SELECT employee_number, pay_period_id, l_linestatus AS tax_code, location_code, 'Tax ' || l_linestatus AS tax_description,
    CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(10,2)) AS tax_amount,
    CASE l_suppkey % 3 WHEN 0 THEN 'FEDERAL' WHEN 1 THEN 'STATE' ELSE 'LOCAL' END AS tax_type, modified_on
  FROM pay_lines"""
VIEWS["earn_odd"] = """
  SELECT *, CASE WHEN pay_period_id = 26 THEN 'unreadable' WHEN pay_period_id = 13 AND upper(earning_code) = 'N' THEN 'rejected'
    WHEN hours > 45 THEN 'lost_cast' ELSE 'good' END AS outcome
  FROM earn_rec"""
VIEWS["earn_std"] = """
  SELECT * REPLACE (upper(earning_code) AS earning_code),
    CAST(CASE WHEN hours IS NOT NULL AND rate IS NOT NULL THEN hours * rate ELSE earning_amount END AS DECIMAL(10,2))
      AS total_earnings
  FROM earn_rec"""
VIEWS["silver_earn"] = """
  SELECT * FROM earn_std WHERE employee_number IS NOT NULL AND earning_amount >= 0 AND pay_period_id BETWEEN 1 AND 26
  QUALIFY row_number() OVER (PARTITION BY employee_number, pay_period_id, earning_code
    ORDER BY modified_on DESC, earning_amount DESC, earning_description DESC, hours DESC, location_code DESC, rate DESC,
      total_earnings DESC) = 1"""
VIEWS["silver_ded"] = """
  SELECT * FROM ded_rec WHERE employee_number IS NOT NULL AND deduction_amount >= 0 AND pay_period_id BETWEEN 1 AND 26
  QUALIFY row_number() OVER (PARTITION BY employee_number, pay_period_id, deduction_code
    ORDER BY modified_on DESC, deduction_amount DESC, deduction_description DESC, location_code DESC) = 1"""
VIEWS["silver_tax"] = """
  SELECT * FROM tax_rec WHERE employee_number IS NOT NULL AND tax_amount >= 0 AND pay_period_id BETWEEN 1 AND 26
  QUALIFY row_number() OVER (PARTITION BY employee_number, pay_period_id, tax_code
    ORDER BY modified_on DESC, location_code DESC, tax_amount DESC, tax_description DESC, tax_type DESC) = 1"""
VIEWS["emp_keys"] = f"""
  SELECT employee_number AS bk, CAST(row_number() OVER (ORDER BY employee_number) AS INTEGER) AS sk,
    DATE '{EARLY}' AS effective_date
  FROM emp_early
  UNION ALL
  SELECT employee_number, CAST((SELECT count(*) FROM emp_early) + row_number() OVER (ORDER BY employee_number) AS INTEGER),
    DATE '{FINAL}'
  FROM emp_final WHERE employee_number NOT IN (SELECT employee_number FROM emp_early)"""
VIEWS["loc_keys"] = """
  SELECT location_code AS bk, CAST(row_number() OVER (ORDER BY location_code) AS INTEGER) AS sk FROM loc"""
VIEWS["gold_emp"] = f"""
  SELECT sk AS EMPLOYEE_KEY, f.employee_number AS EMPLOYEE_NUMBER, f.first_name AS FIRST_NAME, f.last_name AS LAST_NAME,
    f.full_name AS FULL_NAME, f.hire_date AS HIRE_DATE, f.termination_date AS TERMINATION_DATE,
    f.employment_status AS EMPLOYMENT_STATUS, f.department AS DEPARTMENT, f.job_title AS JOB_TITLE,
    f.location_code AS LOCATION_CODE, f.email AS EMAIL, f.phone AS PHONE, effective_date AS EFFECTIVE_DATE,
    TRUE AS IS_CURRENT, CAST(effective_date AS TIMESTAMP) + INTERVAL 6 HOUR AS CREATED_AT,
    CASE WHEN e.employee_number IS NULL
           OR f.termination_date IS DISTINCT FROM e.termination_date OR f.job_title IS DISTINCT FROM e.job_title
           OR f.employment_status IS DISTINCT FROM e.employment_status
         THEN TIMESTAMP '{FINAL} 06:00:00' ELSE TIMESTAMP '{EARLY} 06:00:00' END AS UPDATED_AT
  FROM emp_final f JOIN emp_keys ON bk = f.employee_number LEFT JOIN emp_early e ON e.employee_number = f.employee_number"""
VIEWS["gold_loc"] = f"""
  SELECT sk AS LOCATION_KEY, location_code AS LOCATION_CODE, location_name AS LOCATION_NAME, city AS CITY, state AS STATE,
    country AS COUNTRY, region AS REGION, is_active AS IS_ACTIVE, TIMESTAMP '{EARLY} 06:00:00' AS CREATED_AT,
    TIMESTAMP '{EARLY} 06:00:00' AS UPDATED_AT
  FROM loc JOIN loc_keys ON bk = location_code"""
_KEYS = """LEFT JOIN emp_keys e ON e.bk = s.employee_number LEFT JOIN loc_keys l ON l.bk = s.location_code"""
VIEWS["gold_earn"] = f"""
  SELECT e.sk AS EMPLOYEE_KEY, l.sk AS LOCATION_KEY, pay_period_id AS PAY_PERIOD_ID, earning_code AS EARNING_CODE,
    earning_description AS EARNING_DESCRIPTION, earning_amount AS EARNING_AMOUNT, hours AS HOURS, rate AS RATE,
    total_earnings AS TOTAL_EARNINGS, pay_period_id AS SOURCE_PERIOD_ID, TIMESTAMP '{LOADED_AT}' AS LOAD_DATETIME
  FROM silver_earn s {_KEYS}"""
VIEWS["gold_ded"] = f"""
  SELECT e.sk AS EMPLOYEE_KEY, l.sk AS LOCATION_KEY, pay_period_id AS PAY_PERIOD_ID, deduction_code AS DEDUCTION_CODE,
    deduction_description AS DEDUCTION_DESCRIPTION, deduction_amount AS DEDUCTION_AMOUNT,
    TIMESTAMP '{LOADED_AT}' AS LOAD_DATETIME
  FROM silver_ded s {_KEYS}"""
VIEWS["gold_tax"] = f"""
  SELECT e.sk AS EMPLOYEE_KEY, l.sk AS LOCATION_KEY, pay_period_id AS PAY_PERIOD_ID, tax_code AS TAX_CODE,
    tax_description AS TAX_DESCRIPTION, tax_type AS TAX_TYPE, tax_amount AS TAX_AMOUNT,
    TIMESTAMP '{LOADED_AT}' AS LOAD_DATETIME
  FROM silver_tax s {_KEYS}"""
# Facts keyed while only the early dimension was known: later employees have no key.
VIEWS["late_earn"] = """
  SELECT CASE WHEN a.employee_number IS NOT NULL THEN e.sk END AS EMPLOYEE_KEY, l.sk AS LOCATION_KEY, s.*
  FROM silver_earn s LEFT JOIN emp_keys e ON e.bk = s.employee_number LEFT JOIN loc_keys l ON l.bk = s.location_code
  LEFT JOIN emp_early a ON a.employee_number = s.employee_number"""
VIEWS["exec_log"] = """
  SELECT lpad(CAST(event_id AS VARCHAR), 12, '0') AS execution_id, event_type AS table_name, ts AS execution_start,
    ts + to_seconds(CAST(floor(value) AS BIGINT)) AS execution_end, CAST(day(ts) AS VARCHAR) AS watermark_value,
    CAST(floor(value) AS BIGINT) AS records_written, CASE WHEN event_id % 4 = 3 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    CASE WHEN event_id % 4 = 3 THEN 'HTTP 500 for user ' || CAST(user_id AS VARCHAR) END AS error_message
  FROM events"""
VIEWS["jobs"] = """
  SELECT strftime(execution_start, '%Y-%m-%d') AS orchestrator_run_id, table_name AS job_name,
    CASE table_name WHEN 'click' THEN 'BRONZE' WHEN 'view' THEN 'SILVER' WHEN 'purchase' THEN 'GOLD_DIM'
      ELSE 'GOLD_FACT' END AS job_type, execution_start AS job_start, execution_end AS job_end,
    records_written AS records_processed, CAST(watermark_value AS INTEGER) AS watermark, status, error_message
  FROM exec_log"""
VIEWS["marks"] = """
  SELECT event_type AS entity_name, CAST(max(day(ts)) AS VARCHAR) AS last_processed_value, count(*) AS records_ingested,
    max(ts) AS last_ingestion_time
  FROM events GROUP BY event_type"""
VIEWS["marks_20"] = """
  SELECT event_type AS entity_name, CAST(max(day(ts)) AS VARCHAR) AS last_processed_value, count(*) AS records_ingested,
    max(ts) AS last_ingestion_time
  FROM events WHERE day(ts) < 20 GROUP BY event_type"""
