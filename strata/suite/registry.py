"""Queries and their SQL counterparts, and the layers they read."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.plans.warehouse import Warehouse
from strata.session import scratch_path, small_tasks, staged
from strata.suite.samples import EARLY, FINAL, LOADED_AT, Samples

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VIEWS: dict[str, str] = {}

FIRST_LOAD_UPTO = 20  # the last period of the first incremental fact load
STAR = {
    "fact_earnings": "fact_payroll_earnings",
    "fact_deductions": "fact_payroll_deductions",
    "fact_taxes": "fact_payroll_taxes",
}


class Layers:
    """The warehouse of one data directory; each table is loaded when a query first needs it.

    Employees are loaded twice, as known on EARLY and on FINAL. Facts are loaded in two increments, each
    up to a period of ``loads``.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, loads: tuple[int | None, ...] = (FIRST_LOAD_UPTO, None)):
        self.samples = Samples(spark, sf_dir)
        self.spark = spark
        self.warehouse = Warehouse(spark, scratch_path(spark, "layers"))
        self._sf_dir, self._loads = sf_dir, loads
        self._first: Layers | None = None
        self._done: set[str] = set()

    def _once(self, step: str, work: Callable[[], object]) -> None:
        """Run a load step unless it has run; one that raises is tried again by the next query."""
        if step not in self._done:
            work()
            self._done.add(step)

    def _dimensions(self) -> None:
        self._once("locations", lambda: self._load(self.samples.location_records(), "dim_location", "dwh_dim_location", EARLY))
        for day in (EARLY, FINAL):
            self._once(f"employees {day}", lambda d=day: self._load(
                self.samples.employee_records(d), "dim_employee", "dwh_dim_employee", d))

    def _load(self, records: DataFrame, entity: str, table: str, day: str) -> None:
        at = f"{day} 06:00:00"
        self.warehouse.land(records, entity, None, at)
        self.warehouse.build_silver(entity, at)
        self.warehouse.load_dimension(table, at)

    def bronze(self, entity: str, partition: str | int | None = None) -> DataFrame:
        if entity.startswith("dim"):
            self._dimensions()
        else:
            self._once(f"land {entity}", lambda: self._land(entity))
        return self.warehouse.bronze(entity, partition)

    def _land(self, entity: str) -> None:
        # Written before they are landed: landing reads its source twice, and would keep the shuffles of its joins.
        with small_tasks(self.spark), staged(self.samples.records(entity), "records") as records:
            self.warehouse.land(records, entity, "pay_period_id", LOADED_AT)

    def silver(self, entity: str) -> DataFrame:
        self.bronze(entity)
        if entity.startswith("fact"):
            self._once(f"silver {entity}", lambda: self.warehouse.build_silver(entity, LOADED_AT))
        return self.warehouse.silver(entity)

    def gold(self, table: str) -> DataFrame:
        self._dimensions()
        if table.startswith("fact"):
            self.silver(next(s for s, g in STAR.items() if g == table))
            for upto in self._loads:
                self._once(f"gold {table} {upto}", lambda u=upto: self.warehouse.load_fact(table, LOADED_AT, upto=u))
        return self.warehouse.gold(table)

    def first_load(self) -> "Layers":
        """A second warehouse, whose facts stand after their first load."""
        if self._first is None:
            self._first = Layers(self.spark, self._sf_dir, (FIRST_LOAD_UPTO,))
        return self._first

    def early_dimension(self, table: str) -> DataFrame:
        """The dimension after its first load: later employees are missing from it."""
        self._dimensions()
        return self.spark.read.parquet(f"{self.warehouse.path('gold', table)}/v=1")

    def star(self) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        facts = [self.gold(STAR[f]) for f in ("fact_earnings", "fact_deductions", "fact_taxes")]
        return (*facts, self.gold("dwh_dim_employee"))


_LAYERS: dict[tuple[str, str], Layers] = {}


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _LAYERS:
        _LAYERS[key] = Layers(spark, sf_dir.rstrip("/"))
    return _LAYERS[key]


def query(name: str, sql: str | None = None):
    """Register ``fn(samples, layers)`` and the SQL that must give the same rows.

    Without SQL the query is checked by its rows only.
    """

    def register(fn: Callable[[Samples, Layers], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            held = layers(spark, sf_dir)
            return fn(held.samples, held)

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return register


def with_views(sql: str) -> str:
    """``sql`` with the definitions of the sample views it names, in dependency order."""
    needed: list[str] = []

    def add(text: str) -> None:
        for name, body in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                add(body)
                if name not in needed:
                    needed.append(name)

    add(sql)
    if not needed:
        return sql.strip()
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in needed) + "\n" + sql.strip()
