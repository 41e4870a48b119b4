"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The sentinel partition of a snapshot entity, the pay periods of a year, the source name.
FULL_LOAD = "FULL_LOAD"
INCREMENTAL = "INCREMENTAL"
PERIODS_PER_YEAR = 26
SOURCE_SYSTEM = "hcm_api"


def pay_period(day: Column | str) -> Column:
    """Two-week period of the year, 1 to 26; the last one takes the remaining days."""
    return F.least(F.lit(PERIODS_PER_YEAR), F.floor((F.dayofyear(day) - 1) / 14) + 1).cast("int")


def partition_value(load_type: Column | str, period: Column | str) -> Column:
    """Partition of a raw row: the sentinel for snapshots, the two-digit period otherwise."""
    kind = F.col(load_type) if isinstance(load_type, str) else load_type
    number = (F.col(period) if isinstance(period, str) else period).cast("string")
    padded = F.when(F.length(number) < 2, F.lpad(number, 2, "0")).otherwise(number)
    return (
        F.when(kind == FULL_LOAD, F.lit(FULL_LOAD))
        .when(kind == INCREMENTAL, padded)
        .otherwise(F.raise_error(F.concat(F.lit("unknown load type: "), F.coalesce(kind, F.lit("NULL")))))
    )


def status_class(status: Column | str) -> Column:
    """Error class of an HTTP status."""
    code = F.col(status) if isinstance(status, str) else status
    # Which status belongs to which class.
    return (
        F.when(code == 401, "AUTH")
        .when(code == 429, "RATE_LIMIT")
        .when(code.isin(404, 500, 502, 503), "FATAL")
        .otherwise("OK")
    )


def descending(columns: Iterable[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


TECHNICAL_COLUMNS = ["ingestion_id", "source_file_id", "pipeline_run_id", "processed_datetime"]


def with_tie_breaks(columns: Sequence[str], order: Sequence[str], keys: Sequence[str]) -> list[Column]:
    """``order`` then every other column by name, all descending: a total order up to equal rows.

    Random ids come last, so that they never decide between rows of different content.
    """
    rest = [c for c in columns if c not in order and c not in keys]
    return descending([*order, *sorted(rest, key=lambda c: (c in TECHNICAL_COLUMNS, c))])


def typed(value: Column | str, kind: str) -> Column:
    """A watermark string as its declared type; an unreadable value becomes NULL."""
    if kind not in ("int", "timestamp", "date"):
        raise ValueError(f"unknown watermark type: {kind}")
    return (F.col(value) if isinstance(value, str) else value).try_cast(kind)


def share(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent as a double; NULL when there is nothing to divide by."""
    return F.try_divide(part.cast("double") * 100, whole.cast("double"))


def mask_ssn(ssn: Column | str, show: Column | bool = False) -> Column:
    value = F.col(ssn) if isinstance(ssn, str) else ssn
    return F.when(_flag(show), value).otherwise(F.concat(F.lit("***-**-"), F.right(value, F.lit(4))))


def mask_email(email: Column | str, show: Column | bool = False) -> Column:
    """Keeps the domain. A value without ``@`` shows nothing after the mask."""
    value = F.col(email) if isinstance(email, str) else email
    domain = F.split_part(value, F.lit("@"), F.lit(2))
    return F.when(_flag(show), value).otherwise(F.concat(F.lit("****@"), domain))


def mask_phone(phone: Column | str, show: Column | bool = False) -> Column:
    value = F.col(phone) if isinstance(phone, str) else phone
    area = F.substring(F.regexp_replace(value, "[^0-9]", ""), 1, 3)
    return F.when(_flag(show), value).otherwise(F.concat(F.lit("("), area, F.lit(") ***-****")))


def hide(column: Column | str, show: Column | bool = False) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.when(_flag(show), value)


def _flag(show: Column | bool) -> Column:
    return F.coalesce(show, F.lit(False)) if isinstance(show, Column) else F.lit(show)
