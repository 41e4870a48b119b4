"""Fill-in-middle transformation over a Roaring-style set of cut places.

A text is a row of units: runs of A to Z and a to z, and every other code point by itself. The places
between units, with both ends, are kept as a set of code-point offsets in containers of 2**16
offsets. A container is an array of offsets, a bitmap or a list of runs, whichever is smallest; the
cardinalities before each container add up, so the k-th place is found by one search over the
containers and one select inside the container. Two places, taken from a hash of the id, cut a text
into prefix, middle and suffix.

Every row is transformed by itself, from its whole text. A null text is empty, an empty text or one
that holds a marker stays plain. A null id is hashed as the empty string; repeated rows get the same
result. An empty table gives no rows. Other columns of the table are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.text import map_rows

MARKERS = ("<P>", "<S>", "<M>")
SPAN = 1 << 16
BITMAP_BYTES = SPAN // 8


class ArrayContainer:
    """Offsets as they are, two bytes each."""

    def __init__(self, low: np.ndarray):
        self._low = low.astype(np.uint16)

    @staticmethod
    def bytes_for(low: np.ndarray) -> int:
        return 2 * len(low)

    def select(self, k: int) -> int:
        return int(self._low[k])


class RunContainer:
    """First offset and cumulative length of each run of neighbouring offsets."""

    def __init__(self, low: np.ndarray):
        first = np.flatnonzero(np.diff(low, prepend=-2) != 1)
        self._first, self._before = low[first].astype(np.uint16), first.astype(np.uint16)

    @staticmethod
    def bytes_for(low: np.ndarray) -> int:
        return 4 * int(np.count_nonzero(np.diff(low, prepend=-2) != 1))

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self._before, k, side="right")) - 1
        return int(self._first[run]) + k - int(self._before[run])


class BitmapContainer:
    """One bit for each offset of the container."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(SPAN, np.uint8)
        bits[low] = 1
        self._bytes = np.packbits(bits, bitorder="little")

    @staticmethod
    def bytes_for(low: np.ndarray) -> int:
        return BITMAP_BYTES

    def select(self, k: int) -> int:
        upto = np.cumsum(np.bitwise_count(self._bytes), dtype=np.uint32)
        byte = int(np.searchsorted(upto, k, side="right"))
        before = int(upto[byte - 1]) if byte else 0
        return 8 * byte + int(np.flatnonzero(np.unpackbits(self._bytes[byte : byte + 1], bitorder="little"))[k - before])


KINDS = (ArrayContainer, RunContainer, BitmapContainer)


class OffsetSet:
    """A set of offsets with select, from their sorted array."""

    def __init__(self, offsets: np.ndarray):
        high = offsets >> 16
        starts = np.flatnonzero(np.diff(high, prepend=-1))
        self._high = high[starts]
        self._upto = np.append(starts[1:], len(offsets))
        self._containers = [
            min(KINDS, key=lambda kind: kind.bytes_for(low))(low)
            for low in np.split(offsets & (SPAN - 1), starts[1:])
        ]

    def __len__(self) -> int:
        return int(self._upto[-1])

    def kinds(self) -> list[type]:
        return [type(c) for c in self._containers]

    def select(self, k: int) -> int:
        """The k-th least offset, from 0."""
        at = int(np.searchsorted(self._upto, k, side="right"))
        before = int(self._upto[at - 1]) if at else 0
        return (int(self._high[at]) << 16) + self._containers[at].select(k - before)


def unit_places(text: str) -> np.ndarray:
    """The code-point offsets at which a unit starts or ends: 0, the length, and all between units."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    folded = points | np.uint32(32)
    letter = (folded >= ord("a")) & (folded <= ord("z"))
    between = np.flatnonzero(~(letter[1:] & letter[:-1])) + 1
    return np.concatenate(([0], between, [len(points)] if len(points) else [])).astype(np.int64)


def draws(seed: int, key: object) -> list[int]:
    """Four unsigned 32-bit numbers from the id."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def transform(
    docs: DataFrame, id: str = "doc_id", text: str = "text", seed: int = 1, percent: int = 90, spm_percent: int = 20,
    markers: tuple[str, str, str] = MARKERS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n (units), form, prefix_chars, middle_chars and output.

    ``percent`` of the texts are cut, ``spm_percent`` of these with the suffix first; the others and
    those that hold a marker stay plain.
    """
    p, s, m = markers

    def work():
        def one(key, body):
            body = body or ""
            places = OffsetSet(unit_places(body))
            n = len(places) - 1
            h1, h2, h3, h4 = draws(seed, key)
            if not body or h3 % 100 >= percent or any(marker in body for marker in markers):
                return key, n, "plain", None, None, body
            first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
            a, b = places.select(first), places.select(second)
            prefix, middle, suffix = body[:a], body[a:b], body[b:]
            if h4 % 100 < spm_percent:
                return key, n, "spm", a, b - a, f"{s}{suffix}{p}{prefix}{m}{middle}"
            return key, n, "psm", a, b - a, f"{p}{prefix}{s}{suffix}{m}{middle}"

        return one

    key = docs.schema[id].dataType.simpleString()
    schema = f"doc_id {key}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    return map_rows(docs.select(id, text), schema, work)


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text before the transformation, from its output and form alone.

    A cut text holds no marker, and none can arise where a part meets a marker, because markers start
    with their only ``<``; so the first place of each marker is where it was put in.
    """
    p, s, m = markers

    def parts(lead: str, inner: str) -> tuple[Column, Column, Column]:
        """What stands between ``lead`` and ``inner``, between ``inner`` and the middle's marker, and after that."""
        second, third = F.instr(output, inner), F.instr(output, m)
        begin = len(lead) + 1
        return (
            F.substring(output, F.lit(begin), second - begin),
            F.substring(output, second + len(inner), third - second - len(inner)),
            F.substring(output, third + len(m), F.char_length(output)),
        )

    prefix, suffix, middle = parts(p, s)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(s, p)
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
