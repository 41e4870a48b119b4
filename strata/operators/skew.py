"""Building blocks that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import scratch_root, stored

BROADCAST_BYTES = 64 * 1024 * 1024
MAX_HOT_KEYS = 2000
SKETCH_GROUPS = 64


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def data_bytes(df: DataFrame) -> int:
    """Bytes held by ``df``: string lengths are summed, other columns count 16 bytes a row."""
    width = F.lit(0).cast("long")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) + 16
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.octet_length(F.to_json(F.struct(field.name)))
        else:
            width = width + 16
    return df.agg(F.sum(width).alias("n")).first()["n"] or 0


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    return data_bytes(df) <= (BROADCAST_BYTES if max_bytes is None else max_bytes)


def hot_keys(rows: DataFrame, keys: Sequence[Sequence[str]], share: int) -> list[DataFrame]:
    """For each list of key columns, the keys that may hold more than one ``share``-th of its rows.

    Sketches of frequent items, one for each list, read every row once and shuffle no key. They are
    taken per group of input partitions: a key above the share overall is above it in at least one
    group. A key missed or named too much changes where rows travel and never the result.
    """
    named = [
        F.when(_all_present(columns), F.to_json(F.struct(*columns))).alias(f"key{i}") for i, columns in enumerate(keys)
    ]
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("group")
    sketches = rows.select(*named, group).groupBy("group").agg(
        *[F.expr(f"approx_top_k(key{i}, {share}, {8 * share})").alias(f"top{i}") for i in range(len(keys))],
        *[F.count(f"key{i}").alias(f"n{i}") for i in range(len(keys))],
    )
    sketches = stored(sketches, "sketches")  # a few rows; else each list would read the rows again
    found = []
    for i, columns in enumerate(keys):
        frequent = sketches.select(F.col(f"n{i}").alias("n"), F.inline(f"top{i}")).where("item is not null")
        kept = frequent.where(F.col("count") * share > F.col("n"))
        found.append(kept.select(F.from_json("item", rows.select(*columns).schema).alias("k")).select("k.*").distinct())
    return found


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    add: Sequence[str],
    max_bytes: int | None = None,
    hot: DataFrame | None = None,
    fits: bool | None = None,
) -> DataFrame:
    """Left join that adds the ``add`` columns of ``right``, whose key is unique.

    ``on`` pairs a left column with a right column. When the needed columns of ``right`` measure at
    most ``max_bytes`` they are broadcast and ``left`` is not shuffled. Otherwise both sides shuffle
    on the key, with the hot keys taken out: their rows are matched against a broadcast of those few
    keys, and are spread by a salt through the shuffle of the others.

    A caller that knows may give the ``hot`` keys of ``left``, under its column names, and whether
    ``right`` ``fits`` a broadcast; neither is then looked for.
    """
    r_keys = [f"__r{i}" for i in range(len(on))]
    slim = _slim(right, on, add)
    added = [F.col(f"__a_{c}").alias(c) for c in add]
    kept = [F.col(c) for c in left.columns]
    condition = _keys_equal([lc for lc, _ in on], r_keys)
    if fits_broadcast(slim, max_bytes) if fits is None else fits:
        return left.join(F.broadcast(slim), condition, "left").select(*kept, *added)

    width = shuffle_width(left)
    if hot is None:
        hot = stored(hot_keys(left, [[lc for lc, _ in on]], min(width, MAX_HOT_KEYS))[0], "hot")
    alone = ~_all_present([lc for lc, _ in on])
    marked, any_hot = left, not hot.isEmpty()
    if any_hot:  # else nothing but the rows themselves goes through the shuffle
        hot = hot.toDF(*r_keys)
        # A hot key without a match is hot as well, so the hot keys lead and the match may be missing.
        found = slim.join(F.broadcast(hot), r_keys, "left_semi")
        hot_rows = hot.join(F.broadcast(found), r_keys, "left").select(
            *[F.col(k).alias(f"__h{i}") for i, k in enumerate(r_keys)],
            *[F.col(f"__a_{c}").alias(f"__b_{c}") for c in add],
            F.lit(True).alias("__hot"),
        )
        h_keys = [f"__h{i}" for i in range(len(on))]
        marked = left.join(F.broadcast(hot_rows), _keys_equal([lc for lc, _ in on], h_keys), "left")
        alone = F.col("__hot").isNotNull() | alone
    spread = F.when(alone, F.pmod(F.xxhash64(*left.columns) + F.spark_partition_id(), F.lit(width)) + 1)
    marked = marked.withColumn("__salt", F.coalesce(spread, F.lit(0)).cast("int"))
    for i, (lc, _) in enumerate(on):
        marked = marked.withColumn(f"__l{i}", F.when(F.col("__salt") == 0, F.col(lc)))
    # Always 0. A literal would be folded out of the join keys, and the salt would not spread anything.
    cold = slim.withColumn("__rsalt", F.pmod(F.xxhash64(*r_keys), F.lit(1)).cast("int"))
    # Spark would judge the table by its files and may broadcast what was just measured as too large for it.
    cold = cold.hint("merge")
    joined = marked.join(
        cold,
        _keys_equal([f"__l{i}" for i in range(len(on))], r_keys)
        & (F.col("__salt") == F.col("__rsalt")),
        "left",
    )
    if not any_hot:
        return joined.select(*kept, *added)
    picked = [
        F.when(F.col("__hot").isNotNull(), F.col(f"__b_{c}")).otherwise(F.col(f"__a_{c}")).alias(c)
        for c in add
    ]
    return joined.select(*kept, *picked)


def lookup_joins(
    left: DataFrame,
    lookups: Sequence[tuple[DataFrame, Sequence[tuple[str, str]], Sequence[str]]],
    max_bytes: int | None = None,
) -> DataFrame:
    """``lookup_join`` with several tables, each as (right, on, add), whose keys are all columns of ``left``.

    The frequent keys of all tables that are too large to broadcast come from one pass over ``left``
    as it is, before any join: so k tables read it twice and not k + 1 times.
    """
    fits = [fits_broadcast(_slim(right, on, add), max_bytes) for right, on, add in lookups]
    large = [i for i, small in enumerate(fits) if not small]
    hot: dict[int, DataFrame] = {}
    if large:
        keys = [[lc for lc, _ in lookups[i][1]] for i in large]
        hot = dict(zip(large, hot_keys(left, keys, min(shuffle_width(left), MAX_HOT_KEYS)), strict=True))
    for i, (right, on, add) in enumerate(lookups):
        left = lookup_join(left, right, on, add, hot=hot.get(i), fits=fits[i])
    return left


def _slim(right: DataFrame, on: Sequence[tuple[str, str]], add: Sequence[str]) -> DataFrame:
    """What a lookup needs of its table."""
    r_keys = [f"__r{i}" for i in range(len(on))]
    return right.select(
        *[F.col(r).alias(k) for (_, r), k in zip(on, r_keys, strict=True)],
        *[F.col(c).alias(f"__a_{c}") for c in add],
    ).where(_all_present(r_keys))


def flag_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    flag: str,
    max_bytes: int | None = None,
) -> DataFrame:
    """``left`` with a boolean column telling whether its key occurs in ``right``."""
    keys = right.select(*[F.col(r) for _, r in on]).distinct().withColumn("__there", F.lit(True))
    out = lookup_join(left, keys, on, ["__there"], max_bytes)
    return out.withColumn(flag, F.coalesce("__there", F.lit(False))).drop("__there")


def _ranged(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows range partitioned along ``order``, with the partition of each row frozen in ``__part``.

    The checkpoint keeps a later loss of an executor from moving a row to another partition.
    """
    scratch_root(df.sparkSession)
    return df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()).checkpoint()


def number_rows(df: DataFrame, order: Sequence[str], name: str, start: int | Column = 1) -> DataFrame:
    """Dense numbers in the order of unique ``order`` columns, without a single-partition sort.

    A row's number is its place within its range plus the row counts of the ranges before. Range and
    place are frozen by a checkpoint of the sorted ranges, so the rows move once. Only the counts meet
    in one task.
    """
    scratch_root(df.sparkSession)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # Spark numbers the rows of a partition one by one, below 33 bits, with the partition above.
    placed = ranged.withColumn("__at", F.monotonically_increasing_id()).checkpoint()
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    first = start if isinstance(start, Column) else F.lit(start)
    return (
        placed.withColumn("__p", part)
        .join(F.broadcast(offsets), "__p")
        .withColumn(name, F.col("__before") + place + first)
        .drop("__p", "__at", "__before")
    )


def previous_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """``lag(value)`` per key along ``order``, for keys too long for one task.

    Rows are cut into ranges along key and order, and the window stays inside a range. The first row
    of a key in a range takes the key's last value of an earlier range, found on one row per both.
    """
    ranged = _ranged(df, [*keys, *order])
    parts = [*keys, "__part"]
    last = ranged.groupBy(*parts).agg(F.max_by(F.struct(value), F.struct(*order)).alias("__last"))
    carried = last.select(
        *[F.col(k).alias(f"__c_{k}") for k in parts],
        F.lag("__last").over(Window.partitionBy(*keys).orderBy("__part")).alias("__carry"),
    )
    inside = Window.partitionBy(*parts).orderBy(*order)
    return (
        ranged.withColumn("__pos", F.row_number().over(inside))
        .withColumn("__lag", F.lag(value).over(inside))
        .join(carried, _keys_same(parts, [f"__c_{k}" for k in parts]), "left")
        .withColumn(name, F.when(F.col("__pos") == 1, F.col(f"__carry.{value}")).otherwise(F.col("__lag")))
        .select(*df.columns, name)
    )


def trailing_hour_counts(df: DataFrame, keys: Sequence[str], ts: str, name: str) -> DataFrame:
    """One row per key and instant: how many rows fall in the hour up to and including it.

    Equal instants are counted before any shuffle. The hour is the minute of the instant up to it,
    the 59 whole minutes before, and the end of the minute sixty minutes earlier, so no window
    holds more than two minutes of instants or one aggregated row per minute.
    """
    minute = F.date_trunc("minute", ts)
    calls = df.groupBy(*keys, ts).agg(F.count(F.lit(1)).alias("calls"))
    per_minute = calls.groupBy(*keys, minute.alias("__minute")).agg(F.sum("calls").alias("__n"))
    epoch_minute = F.unix_timestamp(F.col("__minute").cast("timestamp")) / 60
    whole = Window.partitionBy(*keys).orderBy(epoch_minute.cast("long")).rangeBetween(-59, -1)
    minutes = per_minute.select(
        *[F.col(k).alias(f"__m_{k}") for k in keys],
        F.col("__minute").alias("__m_minute"),
        F.coalesce(F.sum("__n").over(whole), F.lit(0)).alias("__whole"),
    )
    hour = F.expr("INTERVAL 1 HOUR")
    both = calls.select(*keys, ts, "calls", F.lit(1).alias("__own")).unionByName(
        calls.select(*keys, (F.col(ts) + hour).alias(ts), "calls", F.lit(0).alias("__own"))
    ).withColumn("__minute", minute)
    inside = Window.partitionBy(*keys, "__minute").orderBy(ts)
    own = F.when(F.col("__own") == 1, F.col("calls")).otherwise(0)
    late = F.when(F.col("__own") == 0, F.col("calls")).otherwise(0)
    head = F.sum(own).over(inside.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    tail = F.sum(late).over(inside.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    edges = both.withColumn("__edge", head + tail).where(F.col("__own") == 1)
    parts = [*keys, "__minute"]
    return edges.join(minutes, _keys_same(parts, [f"__m_{k}" for k in keys] + ["__m_minute"])).select(
        *keys, ts, "calls", (F.col("__edge") + F.col("__whole")).alias(name)
    )


def _all_present(columns: Sequence[str]) -> Column:
    test = F.lit(True)
    for c in columns:
        test = test & F.col(c).isNotNull()
    return test


def _keys_equal(left: Sequence[str], right: Sequence[str]) -> Column:
    test = F.lit(True)
    for a, b in zip(left, right, strict=True):
        test = test & (F.col(a) == F.col(b))
    return test


def _keys_same(left: Sequence[str], right: Sequence[str]) -> Column:
    """As ``_keys_equal``, but NULL is a key like any other."""
    test = F.lit(True)
    for a, b in zip(left, right, strict=True):
        test = test & F.col(a).eqNullSafe(F.col(b))
    return test
