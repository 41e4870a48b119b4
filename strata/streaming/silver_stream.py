"""Raw pages to a typed table as a stream."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructType

from strata.functions.expr import descending
from strata.operators import outcomes as o
from strata.operators import quality as q
from strata.operators.typing import common_type, record_array
from strata.plans.layers import Entity, extra_columns, judged_records, widened
from strata.session import released, staged, stored
from strata.sources.tables import (
    ROW_GROUP_BYTES,
    overwrite_snapshot,
    path_exists,
    read_note,
    read_snapshot,
    remove_path,
    replace_partitions,
    snapshot_exists,
    write_note,
)

BATCH = "batch_id"


def stream_bronze_to_silver(
    spark: SparkSession,
    bronze_path: str,
    bronze_schema: str,
    entity: Entity,
    increments: str,
    checkpoint: str,
    event_time: str | None = None,
    delay: str | None = None,
    max_files: int = 100,
    as_of: str | None = None,
    evolve: bool = True,
) -> StreamingQuery:
    """Start a query that types new raw pages into ``increments``, one folder per micro-batch.

    A micro-batch writes the newest row of each of its keys and nothing else, so its cost follows
    the new data and not the size of the table. Repeating a batch after a failure overwrites its own
    folder. ``latest_rows`` reads the table with its increments; ``settle`` merges them into it. With
    ``as_of`` the rows get the audit columns of a batch load, and the table equals that of a batch.

    With ``evolve`` columns that appear in the payloads of a micro-batch are added. Increments hold them
    as text, and the type that fits all values so far is noted beside them, so that a wider type in a
    later batch rewrites nothing. Records that are rejected, values that are lost in a cast and pages that
    can't be read are kept beside the increments (``streamed_rejects``).

    With ``event_time`` and ``delay`` exact repeats of a record within that delay are dropped in the
    stream. Rows later than the delay are dropped then too, so give it only where lateness is bounded.
    """
    pages = (
        spark.readStream.schema(bronze_schema)
        .option("maxFilesPerTrigger", max_files)
        .parquet(bronze_path)
        .where(F.col("entity_name") == entity.name)
    )
    once = bool(event_time and delay)
    if once:
        pages = (
            _single_records(pages)
            .withColumn("__at", F.get_json_object("payload_json", f"$[0].{event_time}").try_cast("timestamp"))
            .withWatermark("__at", delay)
            .dropDuplicatesWithinWatermark(["payload_json"])
            .drop("__at")
        )

    def write(batch: DataFrame, batch_id: int) -> None:
        # The state of the stream is gone through once, however often the batch is read.
        raw = stored(batch, "micro-batch") if once else batch
        known = _note(spark, _note_of(increments))["added"]
        extra = extra_columns(raw, entity, known) if evolve else known
        text = widened(entity, dict.fromkeys(extra, "string"))
        judged = stored(judged_records(raw, text, as_of or ""), "judged", ["__outcome"], ROW_GROUP_BYTES)
        good = o.loaded(judged)
        # Text does not tell which of several tied rows is the greatest once it is typed, so all stay.
        rows = _newest_ties(good, entity) if extra else q.dedup_latest(good, entity.keys, entity.order)
        if as_of:
            rows = q.add_audit_columns(rows, "silver", as_of)
        _write_note(spark, _note_of(increments), rows.schema, extra)
        replace_partitions(rows.withColumn(BATCH, F.lit(batch_id)), increments, [BATCH, *_parts(entity)])
        refused = o.rejects(judged, entity.name).withColumn(BATCH, F.lit(batch_id))
        replace_partitions(refused, _rejects_of(increments), [BATCH])
        released(judged, *([raw] if once else []))

    return (
        pages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _single_records(pages: DataFrame) -> DataFrame:
    """Pages of one record each. A page that can't be read stays as it is."""
    listed = F.from_json(record_array("payload_json"), "array<string>")
    each = pages.withColumn("__record", F.explode_outer(listed))
    one = F.col("__record").isNotNull()
    return each.withColumns({
        "payload_json": F.when(one, F.concat(F.lit("["), "__record", F.lit("]"))).otherwise(F.col("payload_json")),
        "record_count": F.when(one, F.lit(1)).otherwise(F.col("record_count")),
    }).drop("__record")


def _newest_ties(df: DataFrame, entity: Entity) -> DataFrame:
    """Every distinct row that is the newest of its key."""
    newest = Window.partitionBy(*entity.keys).orderBy(*descending(entity.order))
    return df.distinct().withColumn("__rank", F.rank().over(newest)).where("__rank = 1").drop("__rank")


def _parts(entity: Entity) -> list[str]:
    return [] if entity.partition is None else [entity.partition]


def _note_of(path: str) -> str:
    return f"{path.rstrip('/')}/_schema.json"  # readers of the table pass over it


def _rejects_of(increments: str) -> str:
    return f"{increments.rstrip('/')}-rejects"


def _note(spark: SparkSession, path: str) -> dict:
    text = read_note(spark, path)
    return json.loads(text) if text else {"schema": None, "added": {}}


def _write_note(spark: SparkSession, path: str, schema: StructType, added: Mapping[str, str]) -> None:
    write_note(spark, path, json.dumps({"schema": schema.jsonValue(), "added": dict(added)}))


def _read(spark: SparkSession, path: str, schema: dict | None, *parts: str) -> DataFrame:
    """A table by its noted schema, because files written before a column was added lack it."""
    if schema is None:
        return spark.read.parquet(path)
    known = StructType.fromJson(schema)
    for part in parts:
        known = known.add(part, IntegerType())
    return spark.read.schema(known).parquet(path)


def added_types(known: Mapping[str, str], new: Mapping[str, str]) -> dict[str, str]:
    """Types that hold the added columns of both; names compare without case."""
    names, types = {c.lower(): c for c in known}, dict(known)
    for column, kind in new.items():
        name = names.get(column.lower(), column)
        types[name] = common_type(types.get(name, kind), kind)
    return types


def latest_rows(
    spark: SparkSession, entity: Entity, table: str, increments: str, only: list | None = None, note: str | None = None
) -> DataFrame:
    """The newest row of every key in the table and its increments. Older rows change nothing,
    however late they arrived. ``only`` names the partitions to read; the key contains them. ``note`` is
    where the table's schema is noted, if not beside it."""
    known, new = _note(spark, note or _note_of(table)), _note(spark, _note_of(increments))
    types = added_types(known["added"], new["added"])
    parts = []
    if entity.partition is None and snapshot_exists(spark, table):
        parts.append(read_snapshot(spark, table))
    elif entity.partition is not None and path_exists(spark, table):
        parts.append(_read(spark, table, known["schema"]))
    if path_exists(spark, increments):
        parts.append(_read(spark, increments, new["schema"], BATCH).drop(BATCH))
    parts = [p.withColumns({c: F.col(c).try_cast(kind) for c, kind in types.items() if c in p.columns}) for p in parts]
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    if only is not None:
        rows = rows.where(F.col(entity.partition).isin(only))
    return q.dedup_latest(rows, entity.keys, entity.order)


def settle(spark: SparkSession, entity: Entity, table: str, increments: str, note: str | None = None) -> int:
    """Merge finished increments into the partitions they touch, then remove them. Run it while no
    stream writes. A crash before the removal is harmless: the same rows merge again.

    Of rows that tie in key and order, the one kept is that which its types at this time make the greatest.
    An added column that takes a wider type makes the other partitions be rewritten as well. A table
    without partitions gets a new snapshot. Rejects stay where ``streamed_rejects`` finds them.
    """
    if not path_exists(spark, increments):
        return 0
    note = note or _note_of(table)
    known, new = _note(spark, note), _note(spark, _note_of(increments))
    types, touched = added_types(known["added"], new["added"]), None
    if entity.partition is not None and all(types[c] == kind for c, kind in known["added"].items()):
        # One value per partition directory: as small as the directory listing.
        found = _read(spark, increments, new["schema"], BATCH).select(entity.partition).distinct().collect()
        touched = [row[0] for row in found]
    latest = latest_rows(spark, entity, table, increments, touched, note)
    if entity.partition is None:
        overwrite_snapshot(latest, table)
        written = read_snapshot(spark, table).count()
    else:
        with staged(latest, "settle") as rows:
            written = replace_partitions(rows, table, [entity.partition])
    _write_note(spark, note, latest.schema, types)
    remove_path(spark, increments)
    return written


def streamed_rejects(spark: SparkSession, increments: str) -> DataFrame | None:
    """What the micro-batches lost in whole or part, in the form of ``outcomes.rejects``; None if there is nothing."""
    path = _rejects_of(increments)
    return spark.read.schema(f"{o.REJECTS}, {BATCH} INT").parquet(path).drop(BATCH) if path_exists(spark, path) else None


def clear_rejects(spark: SparkSession, increments: str) -> None:
    remove_path(spark, _rejects_of(increments))
