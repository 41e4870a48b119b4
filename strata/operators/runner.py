"""Runs a suite of checks: each by itself, so that one that can't run is reported and stops no other."""

from __future__ import annotations

import time
from collections.abc import Callable, Collection, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import local_rows

CHECK_RESULTS = """test_id STRING, layer STRING, environment STRING, status STRING, criticality STRING, violations BIGINT,
  duration_seconds DOUBLE, error_message STRING"""
MESSAGE_CHARS = 2000


@dataclass(frozen=True)
class Check:
    """A check of a layer, with what happens if it fails: HIGH blocks.

    ``violations`` gives the violating rows. A check that looks at each row by itself may instead name
    the ``table`` and give ``broken``, true for a violating row; such checks of one table share a scan.
    Both are called when the check runs, so a missing table is an error of that check alone.
    """

    layer: str
    criticality: str
    violations: Callable[[], DataFrame] | None = None
    table: str | None = None
    broken: Callable[[], Column] | None = None


def run_suite(
    spark: SparkSession,
    checks: Mapping[str, Check],
    tables: Mapping[str, Callable[[], DataFrame]] | None = None,
    environment: str = "test",
    layers: Collection[str] | None = None,
) -> DataFrame:
    """One row per check of the wanted ``layers`` (all by default): PASS, FAIL with the number of
    violations, or ERROR with the message. The duration of a shared scan counts for each of its checks."""
    wanted = {name: c for name, c in checks.items() if layers is None or c.layer in layers}
    shared: dict[str, list[str]] = {}
    for name, c in wanted.items():
        if c.broken is not None:
            shared.setdefault(c.table, []).append(name)
    outcome: dict[str, tuple] = {}
    for table, names in shared.items():
        outcome |= _row_checks(names, wanted, tables[table])
    for name, c in wanted.items():
        if name not in outcome:
            outcome[name] = _guarded(lambda c=c: c.violations().count())
    rows = [(name, c.layer, environment, outcome[name][0], c.criticality, *outcome[name][1:]) for name, c in wanted.items()]
    return local_rows(spark, rows, CHECK_RESULTS)


def _row_checks(names: list[str], checks: Mapping[str, Check], table: Callable[[], DataFrame]) -> dict[str, tuple]:
    """Counts for the row checks of one table in one scan; if that fails, one by one, to find which."""
    started = time.monotonic()
    try:
        counts = _counted(names, checks, table)
    except Exception:
        return {name: _guarded(lambda n=name: _counted([n], checks, table)[0]) for name in names}
    seconds = time.monotonic() - started
    return {name: _verdict(n, seconds) for name, n in zip(names, counts, strict=True)}


def _counted(names: list[str], checks: Mapping[str, Check], table: Callable[[], DataFrame]) -> list[int]:
    row = table().agg(*[F.count_if(checks[n].broken()).alias(f"n{i}") for i, n in enumerate(names)]).first()
    return list(row)


def _guarded(count: Callable[[], int]) -> tuple:
    started = time.monotonic()
    try:
        n = count()
    except Exception as error:  # whatever a check raises is its result
        return "ERROR", None, time.monotonic() - started, (str(error) or type(error).__name__)[:MESSAGE_CHARS]
    return _verdict(n, time.monotonic() - started)


def _verdict(violations: int, seconds: float) -> tuple:
    if violations:
        return "FAIL", violations, seconds, f"{violations} violations"
    return "PASS", 0, seconds, None


def rule_checks(table: str, layer: str, rules: Collection, criticality: str = "HIGH") -> Iterator[tuple[str, Check]]:
    """A named row check for each quality rule of a table; a NULL verdict violates a rule."""
    for rule in rules:
        yield f"{table}: {rule.name}", Check(
            layer, criticality, table=table, broken=lambda r=rule: ~F.coalesce(r.predicate, F.lit(False))
        )
