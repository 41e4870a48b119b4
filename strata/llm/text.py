"""Words and shingles of whole texts, and the frame through which Python reads them in Arrow batches."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

WORD = r"[^\x20\x09-\x0D]+"
OUT_BYTES = 8 << 20
BATCH_BYTES = 8 << 20
SPARK_BATCH = "67108864b"  # Spark's default

# A word's bytes are hashed in steps of eight; longer words than this one by one.
LONG_WORD = 256
GAP = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], "<u8")
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def words(text: bytes) -> list[bytes]:
    """Matches of WORD in UTF-8 text: ``bytes.split`` cuts at exactly the six characters WORD excludes."""
    return text.split()


def text_bytes(name: str = "text") -> Column:
    """The text as UTF-8 bytes; a null text is empty."""
    return F.coalesce(F.col(name).cast("binary"), F.lit(b""))


def lower_az(column: Column) -> Column:
    """Lower case for A to Z only."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers."""
    y = x >> np.uint64(30)
    y ^= x
    y *= M1
    y ^= y >> np.uint64(27)
    y *= M2
    y ^= y >> np.uint64(31)
    return y


def distinct(x: np.ndarray) -> np.ndarray:
    """The distinct values, in order."""
    found = np.sort(x)
    return found[np.r_[True, found[1:] != found[:-1]]] if len(found) else found


class WordHashes:
    """64-bit hashes of words, kept while they fit a bounded table."""

    def __init__(self, most: int = 200_000):
        import xxhash

        self._one, self._known, self._most = xxhash.xxh3_64_intdigest, {}, most

    def __call__(self, found: list[bytes]) -> np.ndarray:
        known = self._known
        if len(known) > self._most:
            known.clear()
        for word in set(found).difference(known):
            known[word] = self._one(word)
        return np.fromiter(map(known.__getitem__, found), np.uint64, len(found))


def word_spans(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of UTF-8 text starts and ends, in bytes."""
    edges = np.flatnonzero(np.diff(GAP[np.frombuffer(text, np.uint8)], prepend=True, append=True))
    return edges[::2], edges[1::2]


def word_hashes(text: bytes, spans: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """64-bit hashes of the words of UTF-8 text, A to Z in lower case, all words at once."""
    lower = text.lower()
    padded = np.frombuffer(lower + bytes(8), np.uint8)
    starts, ends = word_spans(text) if spans is None else spans
    sizes = ends - starts
    eight = np.ndarray(len(lower) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place
    total = mixed(mixed(sizes.astype(np.uint64)) ^ (eight[starts] & FIRST_BYTES[np.minimum(sizes, 8)]))
    rest, at = np.flatnonzero((sizes > 8) & (sizes <= LONG_WORD)), 8
    while len(rest):
        part = eight[starts[rest] + at] & FIRST_BYTES[np.minimum(sizes[rest] - at, 8)]
        total[rest] = mixed(total[rest] * M1 ^ part)
        at += 8
        rest = rest[sizes[rest] > at]
    for k in np.flatnonzero(sizes > LONG_WORD).tolist():
        import xxhash

        total[k] = xxhash.xxh3_64_intdigest(lower[starts[k] : starts[k] + sizes[k]])
    return total


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash for each run of ``width`` words; of fewer words, one for the whole sequence."""
    n = len(hashes)
    if n == 0:
        return hashes
    if n < width:
        total = np.array([n], np.uint64)
        for k in range(n):
            total = mixed(total * M1 + hashes[k : k + 1])
        return total
    total = mixed(hashes[: n - width + 1] + np.uint64(width))
    for k in range(1, width):
        total = mixed(total * M1 + hashes[k : n - width + 1 + k])
    return total


def importable(df: DataFrame) -> DataFrame:
    """``df``, once Python workers that share this machine's folders find this package where the driver did.

    Elsewhere it has to be installed, like any library that tasks import. Texts go to Python in batches
    of ``BATCH_BYTES``, unless the session has set a size of its own, so a worker's memory stays small.
    """
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if df.sparkSession.conf.get(size) == SPARK_BATCH:
        df.sparkSession.conf.set(size, str(BATCH_BYTES))
    environment, root = df.sparkSession.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, root])
    return df


def rows_of(batches: Iterator[pa.RecordBatch], step: int = 64) -> Iterator[tuple]:
    """The rows of Arrow batches as Python values, a few at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            yield from zip(*(c.to_pylist() for c in batch.slice(start, step).columns), strict=True)


def map_rows(
    df: DataFrame, schema: str, work: Callable[[], Callable[..., tuple | Iterator[tuple] | None]], many: bool = False
) -> DataFrame:
    """Rows of ``df``, in order, through a function of their values.

    ``work`` is called once a task and returns the function. The function gets one row's values and
    returns one row, or yields rows if ``many``. Rows leave in batches of bounded size.
    """

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        each = work()
        for row in rows:
            if many:
                yield from each(*row)
            else:
                yield each(*row)

    return map_task(df, schema, run)


def map_task(df: DataFrame, schema: str, run: Callable[[Iterator[tuple]], Iterator[tuple]]) -> DataFrame:
    """The rows of each task of ``df``, in order, through a generator that sees them all; out in batches of bounded size."""
    target = StructType.fromDDL(schema)

    def batches_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, held, size = to_arrow_schema(target), [], 0
        for out in run(rows_of(batches)):
            held.append(out)
            size += 32 + sum(len(v) * 4 for v in out if isinstance(v, (bytes, str, list, np.ndarray)))
            if size > OUT_BYTES:
                yield as_batch(held, arrow)
                held, size = [], 0
        if held:
            yield as_batch(held, arrow)

    return importable(df).mapInArrow(batches_out, target)


def as_batch(rows: Sequence[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [
        pa.ListArray.from_arrays(
            pa.array(np.cumsum([0, *map(len, values)]), pa.int32()),
            pa.array(np.concatenate(values) if values else [], field.type.value_type),
        )
        if pa.types.is_list(field.type) and values and isinstance(values[0], np.ndarray)
        else pa.array(values, field.type)
        for field, values in zip(schema, map(list, zip(*rows, strict=True)), strict=True)
    ]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def row_batch(key: np.ndarray, head: np.ndarray, member: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (key, head, member)], ["key", "head", "member"])
