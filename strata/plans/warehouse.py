"""The three layers as Parquet tables below one folder, loaded by catalog and watermark."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from strata.functions.expr import FULL_LOAD, SOURCE_SYSTEM, typed
from strata.operators.checks import (
    check_duplicates,
    check_key_uniqueness,
    check_layer_reconciliation,
    check_null_fk,
    check_orphan_pct,
    check_suite_report,
    odd_amount,
)
from strata.operators.control import (
    EXECUTION_LOG,
    WATERMARKS,
    execution_log_append,
    execution_state,
    last_watermark,
    orchestrator_rollup,
    period_worklist,
    watermark_upsert,
)
from strata.operators.governance import ARCHIVE_FIRST, RETENTION_DAYS, archive_expired, retention_cutoff, retention_purge
from strata.operators.layout import cluster_zorder
from strata.operators.outcomes import GOOD, LOST_CAST, OUTCOMES, REJECTS, check_accounted, outcome_counts, rejects
from strata.operators.runner import Check, rule_checks, run_suite
from strata.operators.skew import flag_join
from strata.operators.star import incremental_filter
from strata.plans.layers import (
    ENTITIES,
    Entity,
    empty_dimension,
    extra_columns,
    gold_dimension,
    gold_fact,
    judged_records,
    key_ranges,
    typed_table,
    widened,
)
from strata.session import local_rows, released, small_tasks, staged, stored
from strata.sources.catalog import TableConfig, read_catalog, table_configs
from strata.sources.landing import RAW_PARTITIONS, bronze_envelope, bronze_read_entity
from strata.sources.tables import (
    ROW_GROUP_BYTES,
    append_rows,
    overwrite_snapshot,
    path_exists,
    read_note,
    read_snapshot,
    remove_partitions,
    replace_partitions,
    snapshot_exists,
    snapshot_folder,
    vacuum_snapshots,
    write_note,
)
from strata.streaming.silver_stream import clear_rejects, settle, stream_bronze_to_silver, streamed_rejects


JOB_RUNS = """orchestrator_run_id STRING, job_name STRING, job_start TIMESTAMP, job_end TIMESTAMP, status STRING,
  error_message STRING"""
LOAD_ACCOUNTS = """entity_name STRING, partition STRING, loaded_at TIMESTAMP, landed BIGINT, good BIGINT, lost_cast BIGINT,
  rejected BIGINT, unreadable BIGINT, unreadable_pages BIGINT, rows_written BIGINT, new_columns INT, duration_seconds DOUBLE"""


class QualityError(RuntimeError):
    """A strict load found rows it must not write."""


class Warehouse:
    """Loads and reads the layers. Every write goes through the sinks of ``strata.sources.tables``."""

    RAW_SCHEMA = """ingestion_id STRING, payload_json STRING, record_count INT, api_endpoint STRING,
      api_http_status INT, api_call_timestamp TIMESTAMP, ingestion_datetime TIMESTAMP,
      source_system STRING, pipeline_run_id STRING, created_at TIMESTAMP,
      partition_column STRING, entity_name STRING"""

    def __init__(
        self,
        spark: SparkSession,
        base: str,
        configs: list[TableConfig] | None = None,
        entities: Mapping[str, Entity] | None = None,
    ):
        """``configs`` and ``entities`` default to the packaged catalog and typed tables; further
        tables need an entry in each and no code."""
        self.spark = spark
        self.base = base.rstrip("/")
        self.configs = configs or table_configs(read_catalog(spark))
        self.entities = entities or ENTITIES

    def path(self, layer: str, table: str) -> str:
        return f"{self.base}/{layer}/{table}"

    # ---- raw ---------------------------------------------------------------------------------

    def land(
        self,
        records: DataFrame,
        entity: str,
        period_col: str | None,
        at: str,
        run_id: str | None = None,
        periods: Iterable[int] | None = None,
    ) -> int:
        """Land records, replacing the (partition, entity) pairs they belong to. Returns their number.

        ``periods`` names the periods that were extracted; one without records is emptied. The
        watermark of a periodic entity moves after the write, and never back.
        """
        seen = Observation()
        rows = bronze_envelope(records, entity, period_col, ingested_at=at, run_id=run_id, arranged=True).observe(
            seen,
            F.coalesce(F.sum("record_count"), F.lit(0)).alias("records"),
            F.max(F.expr("try_cast(partition_column AS INT)")).alias("period"),
        )
        targets = None if periods is None else [(f"{p:02d}", entity) for p in periods]
        replace_partitions(rows, self.path("bronze", "extracts"), RAW_PARTITIONS, targets, arranged=True)
        landed = seen.get
        if landed["period"] is not None:
            self._move_watermark(entity, period_col, landed["period"], landed["records"], at)
        return landed["records"]

    def watermarks(self) -> DataFrame:
        base = self.path("control", "ingestion_watermarks")
        if not snapshot_exists(self.spark, base):
            return local_rows(self.spark, [], WATERMARKS)
        return read_snapshot(self.spark, base)

    def worklist(self, catalog: DataFrame, current: int) -> DataFrame:
        """What to extract next: the periods of each entity after its watermark, and the snapshots."""
        return period_worklist(catalog, self.watermarks(), current)

    def _move_watermark(self, entity: str, column: str, period: int, records: int, at: str) -> None:
        known = self.watermarks()
        last = known.where(F.col("entity_name") == entity).select(F.max(typed("last_processed_value", "int"))).first()[0]
        update = self.spark.range(1).select(
            F.lit(SOURCE_SYSTEM).alias("source_system"),
            F.lit(entity).alias("entity_name"),
            F.lit(column).alias("watermark_column"),
            F.lit("int").alias("watermark_type"),
            F.lit(str(max(period, last or period))).alias("last_processed_value"),
            F.lit(records).cast("long").alias("records_ingested"),
        )
        overwrite_snapshot(watermark_upsert(known, update, at), self.path("control", "ingestion_watermarks"))

    def bronze(self, entity: str | None = None, partition: str | int | None = None) -> DataFrame:
        # Partition values such as 01 must stay text, so the types are stated and not inferred.
        rows = (
            self.spark.read.option("basePath", self.path("bronze", "extracts"))
            .schema(self.RAW_SCHEMA)
            .parquet(self.path("bronze", "extracts"))
        )
        return rows if entity is None else bronze_read_entity(rows, entity, partition)

    # ---- typed -------------------------------------------------------------------------------

    def build_silver(self, name: str, as_of: str, period: int | None = None, evolve: bool = True) -> list[str]:
        """Rebuild a typed table from its raw rows, or one period of a fact.

        With ``evolve`` columns that appear in the payloads are added to the table, and their names
        returned; rows written before hold NULL in them. Such a column takes a wider type when later
        values need one, and the rows written before are rewritten with it. Looking for columns reads
        the payloads once more, so leave it out where the source's columns are fixed.

        Records that a rule rejects, values that do not fit their type and pages that can't be read are
        kept with their reasons (``rejects``), and each load adds its counts to ``load_accounts``.
        """
        with small_tasks(self.spark):
            return self._build_silver(name, as_of, period, evolve)

    def _build_silver(self, name: str, as_of: str, period: int | None, evolve: bool) -> list[str]:
        started = time.monotonic()
        entity = self.entities[name]
        partition = FULL_LOAD if entity.partition is None else period
        raw = self.bronze(name, partition)
        added = self.added_columns(name)
        extra = extra_columns(raw, entity, added) if evolve else added
        wide, seen = widened(entity, extra), Observation()
        # Parsed once: one job writes all records by outcome and counts them, the rest reads that.
        records = judged_records(raw, wide, as_of).observe(seen, *outcome_counts())
        judged = stored(records, "judged", ["__outcome"], ROW_GROUP_BYTES)
        found = seen.get
        ranges = key_ranges(judged, wide, found[GOOD] + found[LOST_CAST])
        rows = typed_table(judged, wide, as_of, ranges=ranges)
        wider = {c: kind for c, kind in extra.items() if c in added and kind != added[c]}
        if wider and entity.partition is not None:
            self._widen(name, wider, extra)
        if entity.partition is None:
            overwrite_snapshot(rows, self.path("silver", name))
            written = None
        else:
            targets = None if period is None else [(period,)]
            written = replace_partitions(rows, self.path("silver", name), [entity.partition], targets, arranged=ranges is not None)
        self._store_schema(name, rows, extra)
        self._keep_rejects(name, judged, raw, found)
        new = [c for c in extra if c not in added]
        self._keep_account(name, raw, partition, as_of, found, written, len(new), time.monotonic() - started)
        released(judged)
        return new

    def stream_silver(self, name: str, as_of: str, **options: object) -> StreamingQuery:
        """Start typing the pages that landed since the last call; ``settle_silver`` merges them.

        The table then equals what ``build_silver`` makes of the same pages, as long as no raw partition
        was replaced by one with fewer keys: the stream never takes a key back.
        """
        return stream_bronze_to_silver(
            self.spark, self.path("bronze", "extracts"), self.RAW_SCHEMA, self.entities[name], self._new_rows(name),
            self.path("control", f"streams/{name}"), as_of=as_of, **options,
        )

    def settle_silver(self, name: str) -> int:
        """Merge what streams typed into the table, and their rejects into ``rejects``. Returns the rows written.

        Rejects replace those of the same pages, so a settling that failed can be repeated.
        """
        new = self._new_rows(name)
        written = settle(self.spark, self.entities[name], self.path("silver", name), new, self._schema_note(name))
        lost = streamed_rejects(self.spark, new)
        if lost is not None:
            pages = lost.select("ingestion_id").distinct()
            kept = flag_join(self.rejects(), pages, [("ingestion_id", "ingestion_id")], "__again")
            with staged(kept.where("not __again").drop("__again").unionByName(lost), "rejects") as rows:
                replace_partitions(rows, self.path("silver", "_rejects"), ["entity_name", "partition_column"])
            clear_rejects(self.spark, new)
        return written

    def _new_rows(self, name: str) -> str:
        return self.path("silver", f"_new/{name}")

    def _keep_rejects(self, name: str, judged: DataFrame, raw: DataFrame, counts: Mapping[str, int]) -> None:
        """Replace what earlier loads of the same raw partitions rejected by what this one does."""
        path = self.path("silver", "_rejects")
        any_now = counts["unreadable_pages"] or any(counts[o] for o in OUTCOMES if o != GOOD)
        if not any_now and not path_exists(self.spark, path):
            return
        # One row per partition directory of the raw rows that were read.
        read = [(name, r[0]) for r in raw.select("partition_column").distinct().collect()]
        replace_partitions(rejects(judged, name), path, ["entity_name", "partition_column"], read)

    def rejects(self) -> DataFrame:
        """Rejected records, lost casts and unreadable pages of the last load of each raw partition."""
        path = self.path("silver", "_rejects")
        if not path_exists(self.spark, path):
            return local_rows(self.spark, [], REJECTS)
        return self.spark.read.schema(REJECTS).parquet(path)

    def _keep_account(
        self, name: str, raw: DataFrame, partition: str | int | None, as_of: str, counts: Mapping[str, int],
        written: int | None, new_columns: int, seconds: float,
    ) -> None:
        landed = raw.agg(F.coalesce(F.sum("record_count"), F.lit(0))).first()[0]
        if written is None:
            written = self.silver(name).count()
        values = (
            name, None if partition is None else str(partition), as_of, landed, *[counts[o] for o in OUTCOMES],
            counts["unreadable_pages"], written, new_columns, seconds,
        )
        row = local_rows(self.spark, [values], LOAD_ACCOUNTS.replace("loaded_at TIMESTAMP", "loaded_at STRING"))
        append_rows(row.withColumn("loaded_at", F.col("loaded_at").cast("timestamp")), self.path("control", "load_accounts"))

    def load_accounts(self) -> DataFrame:
        """One row per typed load: records that landed, what became of them, and the rows after deduplication."""
        path = self.path("control", "load_accounts")
        if not path_exists(self.spark, path):
            return local_rows(self.spark, [], LOAD_ACCOUNTS)
        return self.spark.read.schema(LOAD_ACCOUNTS).parquet(path)

    def _widen(self, name: str, wider: dict[str, str], extra: dict[str, str]) -> None:
        """Rewrite a partitioned typed table with wider types of some of its columns."""
        rows = self.silver(name).withColumns({c: F.col(c).cast(kind) for c, kind in wider.items()})
        with staged(rows, name) as kept:
            replace_partitions(kept, self.path("silver", name), [self.entities[name].partition])
        self._store_schema(name, rows, extra)

    def silver(self, name: str) -> DataFrame:
        # The stored schema, because files written before a column was added lack it.
        reader = self.spark.read.schema(self._stored_schema(name))
        if self.entities[name].partition is None:
            return reader.parquet(snapshot_folder(self.spark, self.path("silver", name)))
        return reader.parquet(self.path("silver", name))

    def added_columns(self, name: str) -> dict[str, str]:
        """Columns the typed table gained beyond the declared ones, with their types."""
        note = read_note(self.spark, self._schema_note(name))
        return json.loads(note)["added"] if note else {}

    def _stored_schema(self, name: str) -> StructType:
        note = read_note(self.spark, self._schema_note(name))
        if note is None:
            raise FileNotFoundError(f"typed table {name} was not built yet")
        return StructType.fromJson(json.loads(note)["schema"])

    def _store_schema(self, name: str, rows: DataFrame, added: dict[str, str]) -> None:
        note = {"schema": rows.schema.jsonValue(), "added": added}
        write_note(self.spark, self._schema_note(name), json.dumps(note))

    def _schema_note(self, name: str) -> str:
        return self.path("control", f"schemas/{name}.json")

    # ---- star --------------------------------------------------------------------------------

    def config(self, table: str) -> TableConfig:
        return next(c for c in self.configs if c.table_name == table)

    def load_dimension(self, table: str, as_of: str) -> None:
        config, base = self.config(table), self.path("gold", table)
        with self._execution(table, as_of) as run:
            self._append_log(run, table, as_of)
            source = self.silver(config.source)
            if snapshot_exists(self.spark, base):
                target = read_snapshot(self.spark, base)
            else:
                target = empty_dimension(self.spark, table, config, source.schema)
            overwrite_snapshot(gold_dimension(target, source, config, as_of), base)
            counts = {"records_read": source.count(), "records_written": read_snapshot(self.spark, base).count()}
            self._append_log(run, table, as_of, "SUCCESS", **counts)

    def load_fact(
        self,
        table: str,
        as_of: str,
        periods: Iterable[int] | None = None,
        upto: int | None = None,
        strict: bool = False,
    ) -> int:
        """Load the periods after the watermark, or reload the given ones. Returns the rows written.

        The log entry follows the write: after a crash in between, the same periods load again and
        give the same partitions. A ``strict`` load writes nothing and leaves the watermark when a
        row lacks a foreign key; otherwise such rows are loaded for the checks to report.
        """
        with self._execution(table, as_of) as run:
            return self._load_fact(run, table, as_of, periods, upto, strict)

    def _load_fact(
        self, run: str, table: str, as_of: str, periods: Iterable[int] | None, upto: int | None, strict: bool
    ) -> int:
        config = self.config(table)
        column = config.watermark_column
        typed_rows = self.silver(config.source)
        if periods is not None:
            wanted = sorted(periods)
            typed_rows, last = typed_rows.where(F.col(column).isin(wanted)), None
        else:
            wanted, last = None, last_watermark(self.log_events(), table, config.watermark_type)
        if upto is not None:
            typed_rows = typed_rows.where(F.col(column) <= upto)
        dims = {x["dimension_table"]: self.gold(x["dimension_table"]) for x in config.lookups}
        fresh = incremental_filter(typed_rows, column, last, config.watermark_type)
        loaded, read = fresh.agg(F.max(column), F.count(F.lit(1))).first()
        if loaded is None and wanted is None:
            return 0
        self._append_log(run, table, as_of)
        rows = gold_fact(typed_rows, dims, config, as_of, last)
        if strict:
            broken = check_null_fk(rows, [x["surrogate_key_column"] for x in config.lookups], _partitions(config))
            bad = broken.agg(F.sum("orphan_records")).first()[0]
            if bad:
                raise QualityError(f"{bad} rows without a foreign key")
        targets = None if wanted is None else [(p,) for p in wanted]
        written = replace_partitions(rows, self.path("gold", table), _partitions(config), targets)
        known = last_watermark(self.log_events(), table, config.watermark_type)
        mark = max((m for m in (known, loaded) if m is not None), default=None)
        self._append_log(
            run, table, as_of, "SUCCESS", watermark_column=column,
            watermark_value=None if mark is None else str(mark), records_read=read, records_written=written,
        )
        return written

    def gold(self, table: str) -> DataFrame:
        if self.config(table).table_type == "DIMENSION":
            return read_snapshot(self.spark, self.path("gold", table))
        return self.spark.read.parquet(self.path("gold", table))

    def load_star(self, as_of: str, strict: bool = False) -> dict[str, str]:
        """All active tables, dimensions first. A table that fails does not stop the others."""
        outcome, run = {}, uuid.uuid4().hex
        for config in self.configs:
            def load(c=config) -> None:
                if c.table_type == "DIMENSION":
                    self.load_dimension(c.table_name, as_of)
                else:
                    self.load_fact(c.table_name, as_of, strict=strict)

            started = time.monotonic()
            outcome[config.table_name], error = self._attempt(load)
            job = (run, config.table_name, as_of, time.monotonic() - started, outcome[config.table_name], error)
            self._append_job(*job)
        return outcome

    def _append_job(self, run: str, job: str, as_of: str, seconds: float, status: str, error: str | None) -> None:
        start = F.lit(as_of).cast("timestamp")
        row = self.spark.range(1).select(
            F.lit(run).alias("orchestrator_run_id"), F.lit(job).alias("job_name"), start.alias("job_start"),
            (start + F.make_dt_interval(secs=F.lit(round(seconds, 3)))).alias("job_end"), F.lit(status).alias("status"),
            F.lit(error).cast("string").alias("error_message"),
        )
        append_rows(row, self.path("control", "job_runs"))

    def jobs(self) -> DataFrame:
        """One row per table and run of ``load_star``, for ``orchestrator_rollup``; it starts at the run's instant."""
        path = self.path("control", "job_runs")
        if not path_exists(self.spark, path):
            return local_rows(self.spark, [], JOB_RUNS)
        return self.spark.read.schema(JOB_RUNS).parquet(path)

    def runs(self) -> DataFrame:
        """One row per run of ``load_star``."""
        return orchestrator_rollup(self.jobs())

    def optimise(self, table: str, files: int | None = None) -> None:
        """Rewrite a star table clustered by its configured columns."""
        config = self.config(table)
        if config.table_type == "DIMENSION":
            rows = cluster_zorder(self.gold(table), config.zorder_columns, files)
            overwrite_snapshot(rows, self.path("gold", table))
        else:
            rows = cluster_zorder(self.gold(table), config.zorder_columns, files, _partitions(config))
            # Staged, because a table must not be read by the job that overwrites it.
            with staged(rows, table) as clustered:
                replace_partitions(clustered, self.path("gold", table), _partitions(config), arranged=True)

    # ---- checks ------------------------------------------------------------------------------

    def checks(self) -> tuple[dict[str, Check], dict[str, Callable[[], DataFrame]]]:
        """The checks of all configured tables, and the tables that their row checks read."""
        found: dict[str, Check] = {}
        tables: dict[str, Callable[[], DataFrame]] = {}
        for c in self.configs:
            table, source, entity = c.table_name, c.source, self.entities[c.source]
            tables[table], tables[source] = lambda t=table: self.gold(t), lambda t=source: self.silver(t)
            rows, typed_rows = tables[table], tables[source]
            found[f"{source}: unique"] = Check("silver", "HIGH", lambda r=typed_rows, k=entity.keys: check_duplicates(r(), k))
            found |= dict(rule_checks(source, "silver", entity.rules()))
            if c.table_type == "DIMENSION":
                keys = [c.surrogate_key, c.business_key]
                found[f"{table}: unique"] = Check("gold", "HIGH", lambda r=rows, k=keys: check_key_uniqueness(r(), k))
                continue
            keys = [x["surrogate_key_column"] for x in c.lookups]
            found[f"{table}: keyed"] = Check(
                "gold", "HIGH", table=table, broken=lambda k=keys: reduce(Column.__or__, [F.col(x).isNull() for x in k])
            )
            for x in c.lookups:
                fk, dim = x["surrogate_key_column"], x["dimension_table"]
                found[f"{table}: {fk}"] = Check("gold", "HIGH", lambda r=rows, fk=fk, d=dim, t=table: check_orphan_pct(
                    r().where(F.col(fk).isNotNull()), self.gold(d), fk, t))
            measure = next(m for m in c.columns if m.get("is_measure"))
            on, of = (c.watermark_column, _partitions(c)[0]), (measure["source"], measure["target"])
            found[f"{table}: reconciled"] = Check("gold", "HIGH", lambda s=typed_rows, r=rows, on=on, of=of: (
                check_layer_reconciliation(s(), r(), on, of)))
            found[f"{source}: amounts"] = Check(
                "silver", "MEDIUM", table=source, broken=lambda m=measure["source"]: odd_amount(m).isNotNull()
            )
        found["typed loads: accounted"] = Check("silver", "HIGH", lambda: check_accounted(self.load_accounts()))
        return found, tables

    def run_checks(self, as_of: str, environment: str = "test", layers: Iterable[str] | None = None) -> DataFrame:
        """Check every configured table, keep the results in the control layer, and return the report.

        A check that can't run is kept as an ERROR with its message, and the others run all the same.
        """
        found, tables = self.checks()
        run, path = uuid.uuid4().hex, self.path("control", "test_results")
        results = run_suite(self.spark, found, tables, environment, None if layers is None else set(layers))
        append_rows(results.withColumns({"test_run_id": F.lit(run), "recorded_at": F.lit(as_of).cast("timestamp")}), path)
        return check_suite_report(self.spark.read.parquet(path).where(F.col("test_run_id") == run))

    # ---- lifecycle ---------------------------------------------------------------------------

    def apply_retention(self, layer: str, table: str, as_of: str, days: int | None = None) -> int:
        """Remove a table's rows past the layer's retention. Returns how many went.

        Where the layer keeps an archive they are written there first, below the day of the run, so
        that a repeated run overwrites its own copy. Partitions of which all rows expired go by their
        directory; only those with both kinds of row are rewritten. A dimension gets a new snapshot,
        and the older ones go; star members that a fact refers to stay, whatever their age.
        """
        parts, column, path, kind = self._kept_by(layer, table)
        keep = RETENTION_DAYS[kind] if days is None else days
        rows = self.bronze(table) if layer == "bronze" else self.silver(table) if layer == "silver" else self.gold(table)
        if parts is None:
            return self._expire_snapshot(layer, table, rows, column, as_of, keep, ARCHIVE_FIRST[kind])
        old = F.coalesce(F.col(column) < retention_cutoff(as_of, keep), F.lit(False))
        # One row per partition directory: as small as the directory listing.
        counted = rows.groupBy(*parts).agg(F.count_if(old).alias("gone"), F.count(F.lit(1)).alias("all")).where("gone > 0")
        counts = counted.collect()
        if not counts:
            return 0
        whole = [tuple(r[p] for p in parts) for r in counts if r["gone"] == r["all"]]
        part = [tuple(r[p] for p in parts) for r in counts if r["gone"] < r["all"]]
        if ARCHIVE_FIRST[kind]:
            expired = archive_expired(_within(rows, parts, whole + part), column, as_of, keep)
            replace_partitions(expired, f"{self.base}/archive/{path}/{as_of[:10]}", parts)
        if part:
            with staged(retention_purge(_within(rows, parts, part), column, as_of, keep), table) as kept:
                replace_partitions(kept, f"{self.base}/{path}", parts, part)
        remove_partitions(self.spark, f"{self.base}/{path}", parts, whole)
        return sum(r["gone"] for r in counts)

    def _kept_by(self, layer: str, table: str) -> tuple[list[str] | None, str, str, str]:
        """Partition columns (none for a snapshot), date column, folder and retention class of a table."""
        if layer == "bronze":
            return RAW_PARTITIONS, "ingestion_datetime", "bronze/extracts", "bronze"
        if layer == "silver":
            partition = self.entities[table].partition
            if partition is None:
                return None, "ingestion_datetime", f"silver/{table}", "silver_dim"
            return [partition], "ingestion_datetime", f"silver/{table}", "silver"
        if self.config(table).table_type == "DIMENSION":
            return None, "UPDATED_AT", f"gold/{table}", "gold"
        return _partitions(self.config(table)), "LOAD_DATETIME", f"gold/{table}", "gold"

    def _expire_snapshot(
        self, layer: str, table: str, rows: DataFrame, column: str, as_of: str, keep: int, archive: bool
    ) -> int:
        base, flag = self.path(layer, table), "__needed"
        rows = rows.withColumn(flag, F.lit(False))
        if layer == "gold":
            for c in self.configs:
                for x in c.lookups:
                    if x["dimension_table"] == table and path_exists(self.spark, self.path("gold", c.table_name)):
                        key, used = self.config(table).surrogate_key, self.gold(c.table_name)
                        marked = flag_join(rows, used, [(key, x["surrogate_key_column"])], "__used")
                        rows = marked.withColumn(flag, F.col(flag) | F.col("__used")).drop("__used")
        old = ~F.col(flag) & F.coalesce(F.col(column) < retention_cutoff(as_of, keep), F.lit(False))
        judged = stored(rows.withColumn("__old", old).drop(flag), "retention", ["__old"])
        expired = judged.where("__old").drop("__old")
        gone = expired.count()
        if gone:
            if archive:
                expired.write.mode("overwrite").parquet(f"{self.base}/archive/{layer}/{table}/{as_of[:10]}")
            overwrite_snapshot(judged.where("not __old").drop("__old"), base)
            vacuum_snapshots(self.spark, base)
        released(judged)
        return gone

    # ---- log ---------------------------------------------------------------------------------

    def log_events(self) -> DataFrame:
        path = self.path("control", "execution_log")
        if not path_exists(self.spark, path):
            return local_rows(self.spark, [], EXECUTION_LOG)
        return self.spark.read.schema(EXECUTION_LOG).parquet(path)

    def log(self) -> DataFrame:
        """One row per execution."""
        return execution_state(self.log_events())

    def _append_log(self, run: str, table: str, at: str, status: str = "RUNNING", **values: object) -> None:
        event = execution_log_append(self.spark, run, table, at, status, **values)
        append_rows(event, self.path("control", "execution_log"))

    @contextmanager
    def _execution(self, table: str, as_of: str) -> Iterator[str]:
        """The id of a new execution, which runs in small tasks. Should the block raise, that is logged as its failure.

        The id begins with the number of the table's attempts, so that those of one instant are in order.
        """
        before = self.log_events().where(F.col("table_name") == table).agg(F.count_distinct("execution_id")).first()[0]
        run = f"{before + 1:08d}-{uuid.uuid4().hex}"
        try:
            with small_tasks(self.spark):
                yield run
        except Exception as error:
            self._append_log(run, table, as_of, "FAILED", error_message=str(error)[:2000])
            raise

    @staticmethod
    def _attempt(load: Callable[[], None]) -> tuple[str, str | None]:
        try:
            load()
        except Exception as error:  # logged by the load itself; one table's failure must not stop the rest
            return "FAILED", str(error)[:2000]
        return "SUCCESS", None


def _within(rows: DataFrame, cols: list[str], targets: list[tuple]) -> DataFrame:
    """The rows of the named partitions. Lists prune the scan by column; the join picks the exact ones."""
    for i, c in enumerate(cols):
        values = {t[i] for t in targets}
        wanted = F.col(c).isin([v for v in values if v is not None])
        rows = rows.where(wanted | F.col(c).isNull() if None in values else wanted)
    if len(cols) == 1:
        return rows
    names = [f"__t{i}" for i in range(len(cols))]
    kinds = ", ".join(f"{n} {rows.schema[c].dataType.simpleString()}" for n, c in zip(names, cols, strict=True))
    listed = F.broadcast(rows.sparkSession.createDataFrame(targets, kinds))  # as many rows as directories
    same = [F.col(c).eqNullSafe(F.col(n)) for n, c in zip(names, cols, strict=True)]
    return rows.join(listed, reduce(Column.__and__, same), "left_semi")


def _partitions(config: TableConfig) -> list[str]:
    """Partition columns of a fact. Without configured ones it is kept by its watermark column, since
    a period can only be replaced as a whole where it is a partition."""
    if config.partition_columns:
        return config.partition_columns
    return [next(c["target"] for c in config.columns if c["source"] == config.watermark_column)]
