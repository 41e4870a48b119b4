"""JSON payloads to typed columns, and columns that appear later."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE_KEYS = ["Data", "Paging", "ResponseStatus"]
RAW_COLUMNS = ["ingestion_id", "ingestion_datetime"]


def infer_payload_schema(bronze: DataFrame, n: int | None = None, payload: str = "payload_json") -> T.StructType:
    """Record schema seen in the payloads: all of them, or the first ``n`` in id order.

    The aggregate merges schemas on the executors; only the resulting type reaches the driver.
    """
    rows = bronze if n is None else bronze.orderBy("ingestion_id").limit(n)
    variant = F.try_parse_json(record_array(payload))
    found = rows.agg(F.schema_of_variant_agg(variant).alias("s")).first()["s"]
    ddl = (found or "VOID").replace("OBJECT<", "STRUCT<")
    if not ddl.startswith("ARRAY<STRUCT<"):
        return T.StructType([])
    kind = T._parse_datatype_string(ddl)
    return kind.elementType


def parse_payload(
    bronze: DataFrame,
    schema: T.StructType | str,
    keep: Sequence[str] = RAW_COLUMNS,
    payload: str = "payload_json",
) -> DataFrame:
    """One row per record, with the ingestion columns of its page.

    A payload is an array of records, or an object holding that array under ``Data``. Rows whose
    payload is not JSON yield no record; ``unreadable_payloads`` lists them.
    """
    record = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    records = F.from_json(record_array(payload), T.ArrayType(record))
    return bronze.select(*keep, F.inline(records))


def unreadable_payloads(bronze: DataFrame, payload: str = "payload_json") -> DataFrame:
    top = F.json_array_length(record_array(payload))
    return bronze.where(F.col(payload).isNotNull() & top.isNull())


def record_array(payload: str) -> Column:
    """The JSON text of the records, whichever of the two payload forms is given."""
    text = F.col(payload)
    return F.when(F.ltrim(text).startswith("{"), F.get_json_object(text, "$.Data")).otherwise(text)


def flatten_struct(df: DataFrame, explode_arrays: bool = True, separator: str = "_") -> DataFrame:
    """Nested structs as flat columns named by their path; array elements as rows."""
    while True:
        nested = [f for f in df.schema.fields if isinstance(f.dataType, T.StructType)]
        arrays = [f for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
        if nested:
            df = df.select(*[c for f in df.schema.fields for c in _leaves(f, separator)])
        elif arrays and explode_arrays:
            name = arrays[0].name
            df = df.select(*[F.explode_outer(c).alias(c) if c == name else F.col(c) for c in df.columns])
        else:
            return df


def _leaves(column: T.StructField, separator: str) -> list[Column]:
    if not isinstance(column.dataType, T.StructType):
        return [F.col(f"`{column.name}`")]
    return [
        F.col(f"`{column.name}`.`{inner.name}`").alias(f"{column.name}{separator}{inner.name}")
        for inner in column.dataType.fields
    ]


def typed_cast(df: DataFrame, types: Mapping[str, str], errors: str | None = None) -> DataFrame:
    """Columns cast to their declared types; values that do not fit become NULL.

    With ``errors`` a column of that name counts the values of the row lost in the cast.
    """
    casts = {c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns}
    out = df.select(*[casts[c].alias(c) if c in casts else F.col(c) for c in df.columns])
    if errors is None:
        return out
    lost = F.lit(0)
    for c, cast in casts.items():
        lost = lost + (F.col(c).isNotNull() & cast.isNull()).cast("int")
    return df.select(
        *[casts[c].alias(c) if c in casts else F.col(c) for c in df.columns], lost.alias(errors)
    )


def detect_new_columns(incoming: T.StructType, existing: T.StructType) -> list[tuple[str, str]]:
    """Names and types present in ``incoming`` only. Names compare without case, as Spark resolves them."""
    known = {f.name.lower() for f in existing.fields}
    return [(f.name, f.dataType.simpleString()) for f in incoming.fields if f.name.lower() not in known]


def common_type(one: str, two: str) -> str:
    """The type that holds the values of both: wider numbers where there are any, else text.

    Whole numbers and decimals keep every digit; beyond 38 digits, as with other mixtures, that is text.
    """
    if one == two:
        return one
    kinds = [T._parse_datatype_string(kind) for kind in (one, two)]
    exact = [
        k if isinstance(k, T.DecimalType) else T.DecimalType(19, 0) if isinstance(k, T.LongType) else None for k in kinds
    ]
    if all(exact):
        scale = max(k.scale for k in exact)
        digits = max(k.precision - k.scale for k in exact) + scale
        return f"decimal({digits},{scale})" if digits <= 38 else "string"
    if any(isinstance(k, T.DoubleType) for k in kinds) and any(exact):
        return "double"
    return "string"


def evolve_append(table: DataFrame, incoming: DataFrame) -> DataFrame:
    """Both row sets with the union of their columns; older rows hold NULL in the new ones."""
    new = [name for name, _ in detect_new_columns(incoming.schema, table.schema)]
    shared = [f for f in table.schema.fields if f.name.lower() in {c.lower() for c in incoming.columns}]
    aligned = incoming.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in shared], *[F.col(c) for c in new]
    )
    return table.unionByName(aligned, allowMissingColumns=True)


def evolve_table(spark, table: str, incoming: T.StructType) -> list[str]:
    """Add the columns that ``incoming`` has and the catalog table lacks; returns their names."""
    new = detect_new_columns(incoming, spark.table(table).schema)
    if new:
        columns = ", ".join(f"`{name}` {kind}" for name, kind in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    return [name for name, _ in new]


def payload_key_check(
    bronze: DataFrame, required: Sequence[str] = tuple(ENVELOPE_KEYS), payload: str = "payload_json"
) -> DataFrame:
    """Raw rows whose payload object lacks one of the ``required`` top-level keys."""
    wanted = F.array(*[F.lit(k) for k in required])
    present = F.coalesce(F.json_object_keys(payload), F.array().cast("array<string>"))
    return (
        bronze.withColumn("missing_keys", F.array_except(wanted, present))
        .where(F.size("missing_keys") > 0)
        .select("ingestion_id", "entity_name", "missing_keys")
    )


def map_fact_columns(df: DataFrame, columns: Sequence[Mapping], keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` followed by every configured column under its target name and type."""
    return df.select(*keep, *[F.col(c["source"]).cast(c["type"]).alias(c["target"]) for c in columns])


def map_dimension_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Typed names to star names. ``columns`` selects by star name; a column absent from ``df`` is left out."""
    by_star = {c.upper(): c for c in df.columns}
    wanted = [c for c in (columns or list(by_star)) if c in by_star]
    return df.select(*[F.col(by_star[c]).alias(c) for c in wanted])
