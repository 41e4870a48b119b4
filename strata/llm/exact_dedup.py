"""Exact deduplication by recipes of content-defined chunks.

A text, with A to Z in lower case, is cut where a rolling hash of the last 32 bytes has its low bits
zero, so equal stretches are cut alike wherever they stand. Its recipe is the list of its chunks'
identifiers. An identifier is a hash of the chunk that has been verified: of every identifier that
occurs more than once, the least and the greatest chunk are compared, byte by byte; if they differ
anywhere, identifiers are made again with a wider hash and verified again. So equal recipes mean
equal texts, and a recipe is all that has to meet: chunk bytes move once, those of repeated
identifiers only while the list of these can be broadcast, and each at most once per task, because
least and greatest combine before the shuffle. A group of copies is likewise counted before it moves.

Of equal texts the row with the largest id stays; of rows that also share the id, one, by content of
the other columns. Null ids are smaller than any id. A null text equals the empty text. An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.text import free_name, lower_az, map_rows, text_bytes
from strata.operators.skew import fits_broadcast, flag_join, lookup_join
from strata.session import stored

LEAST, MEAN_BITS, MOST = 1024, 12, 32_768
GEAR = np.random.default_rng(7).integers(0, 1 << 32, 256, np.uint32)


def chunks(text: bytes, least: int = LEAST, bits: int = MEAN_BITS, most: int = MOST) -> Iterator[bytes]:
    """``text`` in chunks of ``least`` to ``most`` bytes; the last may be shorter."""
    if len(text) > least:
        rolling = GEAR[np.frombuffer(text, np.uint8)]
        for step in (1, 2, 4, 8, 16):
            ahead = rolling.copy()
            ahead[step:] += rolling[:-step] << np.uint32(step)
            rolling = ahead
        places = np.flatnonzero((rolling >> np.uint32(32 - bits)) == 0) + 1
        start = 0
        while len(text) - start > least:
            k = np.searchsorted(places, start + least)
            end = min(int(places[k]) if k < len(places) else len(text), start + most, len(text))
            yield text[start:end]
            start = end
        if start == len(text):
            return
        text = text[start:]
    yield text


def narrow(chunk: bytes) -> bytes:
    import xxhash

    return xxhash.xxh3_64_digest(chunk)


def wide(chunk: bytes) -> bytes:
    return hashlib.sha256(chunk).digest()


def recipes(docs: DataFrame, name=narrow, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_sha256 of the normalised text, and recipe (array of binary), by row of ``docs``."""

    def work():
        def one(key, data):
            data = data.lower()
            return key, hashlib.sha256(data).hexdigest(), [name(c) for c in chunks(data)]

        return one

    return map_rows(
        docs.select(id, text_bytes(text)), "doc_id bigint, text_sha256 string, recipe array<binary>", work
    )


def unverified(docs: DataFrame, made: DataFrame, name=narrow, text: str = "text") -> bool:
    """Whether some identifier stands for two different chunks."""

    def work():
        return lambda data: ((name(c), c) for c in chunks(data.lower()))

    repeated = made.select(F.explode("recipe").alias("id")).groupBy("id").count().where("count > 1").select("id")
    repeated = stored(repeated, "chunks")
    found = map_rows(docs.select(text_bytes(text)), "id binary, chunk binary", work, many=True)
    if fits_broadcast(repeated):
        found = found.join(F.broadcast(repeated), "id", "left_semi")
    ends = found.groupBy("id").agg(F.min("chunk").alias("least"), F.max("chunk").alias("greatest"))
    return not ends.where("least <> greatest").isEmpty()


def equal_texts(
    docs: DataFrame, id: str = "doc_id", text: str = "text", hashes=(narrow, wide)
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_sha256, keep_id, group_size, kept, and tied.

    ``tied`` is how many rows of the group have keep_id.
    """
    for name in hashes:
        made = stored(recipes(docs, name, id, text), "recipes")
        if not unverified(docs, made, name, text):
            break
    else:
        raise RuntimeError("no hash tells the chunks apart")
    rows = made.groupBy("recipe", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.first("text_sha256").alias("text_sha256"))
    groups = rows.groupBy("recipe").agg(
        F.max(F.struct("doc_id", "n")).alias("top"), F.sum("n").alias("group_size"),
        F.first("text_sha256").alias("group_sha256"),
    ).select("group_sha256", F.col("top.doc_id").alias("keep_id"), "group_size", F.col("top.n").alias("tied"))
    slim = made.select("doc_id", "text_sha256")
    found = lookup_join(slim, stored(groups, "groups"), [("text_sha256", "group_sha256")], ["keep_id", "group_size", "tied"])
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def drop_equal(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts."""
    found = stored(equal_texts(docs, id, text), "equal")
    sha, key = free_name(docs, "dedup_sha"), free_name(docs, "dedup_id")
    flag, turn = free_name(docs, "dedup_flag"), free_name(docs, "dedup_turn")
    named = docs.select(
        "*", F.sha2(lower_az(F.coalesce(F.col(text), F.lit(""))), 256).alias(sha),
        F.coalesce(F.col(id).cast("string"), F.lit("n")).alias(key),
    )
    gone = found.where("not kept").select(
        F.col("text_sha256").alias(sha), F.coalesce(F.col("doc_id").cast("string"), F.lit("n")).alias(key)
    )
    left = flag_join(named, gone, [(sha, sha), (key, key)], flag).where(~F.col(flag))
    if not found.where("kept and tied > 1").isEmpty():
        order = Window.partitionBy(sha, key).orderBy(F.xxhash64(*docs.columns))
        left = left.withColumn(turn, F.row_number().over(order)).where(F.col(turn) == 1)
    return left.select(*docs.columns)
