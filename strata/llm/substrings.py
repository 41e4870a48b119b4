"""Byte strings of a minimum length that occur twice, found on Burrows-Wheeler transforms.

Texts are bytes; a string counts as repeated if it starts anywhere else, in another text or the same.
Every window of ``length`` bytes has an anchor: of the grams of ``gram`` bytes in it, that with the
least hash, the first of equals. Equal windows have their anchors at the same place, so they meet
under the gram's key. An anchor stands for the windows that have it, and what these cover is its context.

* A key that occurs once settles its windows as not repeated; a key with one context, met at several
  places, settles all of them as repeated. Copies thus cost an aggregation and no comparison.
* Of the keys that are left, the distinct contexts are compared: the suffixes of a batch are sorted by
  their first ``length`` bytes, and from their transform the places where common prefixes end are
  derived breadth-first, one backward step at a time, by increasing common prefix, until ``length``.
  Suffixes that no such place parts share ``length`` bytes. They count if they start at two places.
* A key with more than ``most`` contexts is split instead: windows whose anchors are nearly as far in
  have a longer core in common, whose hash is the new key. Again keys are settled by one place or one
  content, compared, or split; at the last, the core is the window itself.

Keys are hashes, which only bring contexts together. Equal contexts are told by 128-bit hashes, and
are the only thing that is taken as equal without comparing bytes.

A null text is empty. Rows with equal texts are texts that start elsewhere, also if their ids are
equal. Ids are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.text import M1, map_rows, map_task, mixed, text_bytes
from strata.operators.skew import lookup_join, shuffle_width
from strata.session import released, stored

LENGTH, GRAM = 400, 64
MOST = 1024
PARTS = 8
BATCH_BYTES = 1 << 20
BROADCAST = 16 << 20
SYMBOL = np.random.default_rng(13).integers(0, 1 << 64, 256, np.uint64)


def windowed(values: np.ndarray, width: int, join) -> np.ndarray:
    """``join`` over each run of ``width`` values, by doubling; ``join(a, b, size)`` gets the earlier run of ``size`` first."""
    whole, done, size, held = None, 0, 1, values
    while True:
        if width & size:
            whole = held if whole is None else join(whole[: len(held) - done], held[done:], size)
            done += size
        if done == width:
            return whole
        held = join(held[:-size], held[size:], size)
        size *= 2


def rolling(data: bytes, gram: int) -> np.ndarray:
    """A 64-bit hash of each run of ``gram`` bytes."""

    def join(first, second, size):
        return first * np.uint64(pow(int(M1), size, 1 << 64)) + second

    return mixed(windowed(SYMBOL[np.frombuffer(data, np.uint8)], gram, join))


def anchors(data: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The anchors of ``data`` in order: their places, their keys, and the first and last window of each.

    The windows that share an anchor follow one another, because the anchors of later windows are later.
    """
    keys = rolling(data, gram)
    ranked = (keys >> np.uint64(32) << np.uint64(32)) | np.arange(len(keys), dtype=np.uint64)
    least = windowed(ranked, length - gram + 1, lambda a, b, size: np.minimum(a, b))
    places = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.diff(places, prepend=-1))
    places = places[first]
    return places, keys[places], first, np.append(first[1:], len(least)) - 1


def halves(data: bytes) -> tuple[int, int]:
    import xxhash

    return tuple(np.frombuffer(xxhash.xxh3_128_digest(data), np.int64))


def anchor_rows(classes: DataFrame, length: int, gram: int) -> DataFrame:
    """cid, pos, key, c1 and c2 (the context's hash), before and after (bytes of the context around pos)."""

    def work():
        def one(cid, data):
            places, keys, first, last = anchors(data, length, gram)
            before, after = places - first, last + length - places
            contexts = [halves(b"%d:" % b + data[p - b : p + a]) for p, b, a in zip(places.tolist(), before.tolist(), after.tolist())]
            c = np.array(contexts, np.int64).reshape(-1, 2)
            return cid, places.astype(np.int32), keys.view(np.int64), c[:, 0], c[:, 1], before.astype(np.int16), after.astype(np.int16)

        return one

    schema = (
        "cid bigint, pos array<int>, key array<bigint>, c1 array<bigint>, c2 array<bigint>, "
        "before array<smallint>, after array<smallint>"
    )
    found = map_rows(classes.select("cid", "data"), schema, work)
    return found.select("cid", F.inline(F.arrays_zip("pos", "key", "c1", "c2", "before", "after")))


def packing(symbols: np.ndarray, depth: int) -> tuple[int, int]:
    """How many symbols, at most ``depth``, are compared at once, as one number, and the bits of each."""
    bits = max(int(symbols.max()).bit_length(), 1)
    return min(62 // bits, depth), bits


def suffix_order(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffixes of ``symbols`` sorted by their first ``depth`` symbols at least, the place of each in
    that order, and in that order the first symbols of each as one number.

    The longer prefixes come from shorter ones: a round sorts, among suffixes that are still equal, by
    the rank of what follows the part compared so far.
    """
    n, (packed, bits) = len(symbols), packing(symbols, depth)
    key = np.zeros(n, np.int64)
    for k in range(packed):
        key = (key << bits) | np.roll(symbols, -k)
    order = np.argsort(key).astype(np.int32)
    led = key[order]
    first = np.flatnonzero(np.diff(led, prepend=-1))
    rank = np.empty(n, np.int32)
    rank[order] = np.repeat(first, np.diff(np.append(first, n)))
    slots = np.flatnonzero(np.repeat(np.diff(np.append(first, n)) > 1, np.diff(np.append(first, n))))
    done = packed
    while done < depth and len(slots):
        open_ = order[slots]
        after = open_ + done
        key = rank[open_].astype(np.int64) * n + rank[np.where(after < n, after, after - n)]
        by = np.argsort(key, kind="stable")
        open_, key = open_[by], key[by]
        order[slots] = open_
        first = np.flatnonzero(np.diff(key, prepend=-1))
        sizes = np.diff(np.append(first, len(key)))
        rank[open_] = np.repeat(slots[first], sizes)
        slots = slots[np.repeat(sizes > 1, sizes)]
        done *= 2
    place = np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    return order, place, led


def ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the intervals [low, high), and which interval each is of."""
    sizes = high - low
    owner = np.repeat(np.arange(len(low)), sizes)
    return np.arange(len(owner)) + np.repeat(low - np.append(0, np.cumsum(sizes)[:-1]), sizes), owner


def parted(symbols: np.ndarray, order: np.ndarray, place: np.ndarray, packed_keys: np.ndarray, length: int) -> np.ndarray:
    """Whether each suffix in ``order`` shares fewer than ``length`` symbols with the one before it.

    Interval expansion: the suffixes that start with a string are an interval. Stepping back from those
    of an interval by one symbol gives the intervals of the strings longer by one. Where the end of one
    is not yet known as a boundary, the common prefix there is the length of the string before the
    step, and the interval takes part in the next step. So boundaries come by increasing common prefix.
    The shortest ones are told from the first symbols of the suffixes, compared as one number.
    """
    n, (packed, bits) = len(symbols), packing(symbols, length)
    led = symbols[order]
    back = place[order - 1].astype(np.int64)  # where the suffix longer by one stands; its first symbol is the transform's
    known = np.ones(n + 1, bool)
    differs = packed_keys[1:] ^ packed_keys[:-1]
    known[1:n] = differs != 0
    low = np.flatnonzero(known[:n])
    high = np.append(low[1:], n)
    # The boundaries of the step before the first one: all but the last symbol of the string are shared there.
    latest = np.zeros(n + 1, bool)
    latest[1:n] = (differs != 0) & (differs >> bits == 0)
    low, high = low[latest[high]], high[latest[high]]
    for _ in range(length - packed):
        if not len(low):
            break
        at, owner = ranges(low, high)
        to = back[at]
        if len(at) > len(low):
            by = np.argsort(owner * n + to)
            to, owner = to[by], owner[by]
            new = np.ones(len(to), bool)
            new[1:] = (np.diff(to) != 1) | (np.diff(owner) != 0) | (led[to[1:]] != led[to[:-1]])
            first = np.flatnonzero(new)
            low, high = to[first], to[np.append(first[1:], len(to)) - 1] + 1
        else:  # intervals of one suffix each
            low, high = to, to + 1
        fresh = ~known[high]
        low, high = low[fresh], high[fresh]
        known[high] = True
    return known[:n]


def repeated_starts(texts: list[bytes], places: np.ndarray, sure: np.ndarray, length: int) -> np.ndarray:
    """Which positions of the joined ``texts`` start a string of ``length`` bytes that starts at two places.

    A text is followed by one position of its own end. ``places`` numbers where each text stands: equal
    numbers at equal distances are one place. What a ``sure`` text holds counts as two places.
    """
    sizes = np.array([len(t) + 1 for t in texts])
    ends = np.cumsum(sizes) - 1
    symbols = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int64) + len(texts)
    symbols[ends] = np.arange(len(texts))
    order, place, packed_keys = suffix_order(symbols, length)
    first = np.flatnonzero(parted(symbols, order, place, packed_keys, length))
    start = ends - sizes + 1
    stands = np.arange(len(symbols)) + np.repeat(places - start, sizes)
    stands, doubled = stands[order], np.repeat(sure, sizes)[order]
    twice = (np.minimum.reduceat(stands, first) < np.maximum.reduceat(stands, first)) | np.logical_or.reduceat(doubled, first)
    groups = np.diff(np.append(first, len(symbols)))
    out = np.zeros(len(symbols), bool)
    out[order] = np.repeat(twice & (groups > 1), groups)
    return out


def covered(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """The maximal runs that strings of ``length`` from the sorted ``starts`` cover."""
    if not len(starts):
        return []
    first = np.flatnonzero(np.diff(starts, prepend=starts[0] - length - 1) > length)
    last = np.append(first[1:], len(starts)) - 1
    return list(zip(starts[first].tolist(), (starts[last] + length).tolist(), strict=True))


def compared(length: int, batch_bytes: int = BATCH_BYTES):
    """Turns contexts, those of a key one after another, into (c1, c2, spans): repeated runs, from the anchor."""

    def run(batch: list[tuple]) -> Iterator[tuple]:
        texts, sure = [row[6] for row in batch], np.array([row[7] for row in batch])
        _, document = np.unique([row[3] for row in batch], return_inverse=True)
        places = (document.astype(np.int64) << 32) + [row[4] - row[5] for row in batch]
        found = repeated_starts(texts, places, sure, length)
        at = 0
        for (_, c1, c2, _, _, before, data, doubled) in batch:
            if not doubled:
                starts = np.flatnonzero(found[at : at + len(data)])
                if len(starts):
                    yield c1, c2, [{"from": a - before, "to": b - before} for a, b in covered(starts, length)]
            at += len(data) + 1

    def groups(rows: Iterator[tuple]) -> Iterator[tuple]:
        batch, size, key = [], 0, None
        for row in rows:
            if size >= batch_bytes and row[0] != key:
                yield from run(batch)
                batch, size = [], 0
            batch.append(row)
            size, key = size + len(row[6]), row[0]
        if batch:
            yield from run(batch)

    return groups


SPANS = "spans array<struct<from: int, to: int>>"
UNIT = ("key", "c1", "c2", "cid", "pos", "before", "data", "sure")


def compare(units: DataFrame, length: int) -> DataFrame:
    """(c1, c2, spans) of units whose keys have a bounded number of contexts each."""
    ready = units.select(*UNIT).repartition(shuffle_width(units), "key").sortWithinPartitions("key")
    return map_task(ready, f"c1 bigint, c2 bigint, {SPANS}", compared(length))


def split(units: DataFrame, length: int) -> DataFrame:
    """The windows of each unit, whose anchors are lo to hi bytes in, as ``PARTS`` units, without their bytes.

    at (lo of the unit), lo, hi, from and to (what the windows cover, from the anchor), and f1 and f2,
    the hash of that. The key is the hash of the core that all windows of the part have in common.
    """

    def work():
        import xxhash

        def each(c1, c2, before, data, sure, lo, hi):
            step = -(-(hi - lo + 1) // PARTS)
            after = len(data) - before
            for low in range(lo, hi + 1, step):
                high = min(low + step - 1, hi)
                # Some window starts low to high bytes before the anchor and ends inside the data.
                if max(low, length - after) > min(high, before):
                    continue
                core = data[before - low : before - high + length]
                ahead, behind = min(before, high), min(after, length - low)
                f1, f2 = halves(b"%d:" % ahead + data[before - ahead : before + behind])
                name = np.uint64(xxhash.xxh3_64_intdigest(core, seed=low)).view(np.int64)
                yield int(name), c1, c2, sure, lo, low, high, -ahead, behind, int(f1), int(f2)

        return each

    schema = (
        "key bigint, c1 bigint, c2 bigint, sure boolean, at int, lo int, hi int, `from` int, `to` int, f1 bigint, f2 bigint"
    )
    return map_rows(units.select("c1", "c2", "before", "data", "sure", "lo", "hi"), schema, work, many=True)


def one_of(*columns: str):
    """Whether the columns hold one value each, in an aggregation."""
    test = F.lit(True)
    for c in columns:
        test = test & (F.min(c) == F.max(c))
    return test


def settle(units: DataFrame, length: int, most: int) -> DataFrame:
    """(c1, c2, spans) of the repeated strings in ``units``.

    Each round splits the units of the keys that are still too large; ``PARTS`` to the power of three is
    more than the windows of a context, so after three rounds a part is a window, and its keys are settled.
    """
    found = []
    while True:
        # At most one key for each ``most`` units.
        busy = stored(units.groupBy("key").count().where(F.col("count") > most).select("key"), "busy")
        found.append(stored(compare(units.join(F.broadcast(busy), "key", "left_anti"), length), "compared"))
        if busy.isEmpty():
            released(busy, units)
            break
        large = stored(units.join(F.broadcast(busy), "key", "left_semi"), "large")
        released(busy, units)
        parts = stored(split(large, length), "parts")
        keys = parts.groupBy("key").agg(F.count(F.lit(1)).alias("n"), one_of("f1", "f2").alias("uniform")).where("n > 1")
        keys = stored(keys.select(F.col("key").alias("k"), "uniform"), "keys")
        met = stored(lookup_join(parts, keys, [("key", "k")], ["uniform"], BROADCAST).where("uniform is not null"), "met")
        released(parts, keys)
        whole = F.array(F.struct("from", "to"))
        found.append(stored(met.where("uniform and not sure").select("c1", "c2", whole.alias("spans")), "compared"))
        bodies = large.select("c1", "c2", F.col("lo").alias("at"), "cid", "pos", F.col("before").alias("lead"), "data")
        left = met.where("not uniform").join(bodies, ["c1", "c2", "at"]).select(
            "key", "c1", "c2", "cid", "pos", (-F.col("from")).alias("before"),
            F.substring("data", F.col("lead") + F.col("from") + 1, F.col("to") - F.col("from")).alias("data"), "sure", "lo", "hi",
        )
        units = stored(left, "units")
        released(met, large)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def cut_out(data, places):
    """Contexts, as the bytes of their texts: one row for each place in an array."""

    def work():
        def each(cid, body, wanted):
            for w in wanted:
                yield w["key"], w["c1"], w["c2"], cid, w["pos"], w["before"], body[w["pos"] - w["before"] : w["pos"] + w["after"]], w["sure"]

        return each

    schema = "key bigint, c1 bigint, c2 bigint, cid bigint, pos int, before int, data binary, sure boolean"
    return map_rows(data.join(places, "cid").select("cid", "data", "places"), schema, work, many=True)


def merged(spans: list) -> list[tuple[int, int]]:
    """The union of spans as maximal runs."""
    out: list[list[int]] = []
    for span in sorted((s["from"], s["to"]) for s in spans):
        if out and span[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], span[1])
        else:
            out.append(list(span))
    return [tuple(s) for s in out]


def repeated_spans(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """One row per distinct text with repeated bytes: text_sha256, and spans, the maximal runs of them (from, to)."""
    body = text_bytes(text)
    texts = docs.where(F.octet_length(body) >= length).groupBy(body.alias("data")).agg(F.count(F.lit(1)).alias("copies"))
    classes = stored(texts.select(F.monotonically_increasing_id().alias("cid"), "data", "copies"), "texts")
    rows = stored(anchor_rows(classes, length, gram), "anchors")
    keys = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), one_of("c1", "c2").alias("uniform")).where("n > 1")
    keys = stored(keys.select(F.col("key").alias("k"), "uniform"), "keys")
    met = stored(lookup_join(rows, keys, [("key", "k")], ["uniform"], BROADCAST).where("uniform is not null"), "met")
    released(rows, keys)
    span = F.struct((-F.col("before")).cast("int").alias("from"), F.col("after").cast("int").alias("to"))
    mixed_rows = met.where("not uniform")
    contexts = mixed_rows.groupBy("key", "c1", "c2").agg(
        F.min(F.struct("cid", "pos", "before", "after")).alias("at"), (F.count(F.lit(1)) > 1).alias("sure")
    )
    contexts = stored(contexts.select("key", "c1", "c2", "at.*", "sure"), "contexts")
    places = contexts.groupBy("cid").agg(F.collect_list(F.struct("key", "c1", "c2", "pos", "before", "after", "sure")).alias("places"))
    units = cut_out(classes, places).withColumn("lo", F.lit(0)).withColumn("hi", F.lit(length - gram))
    units = stored(units, "units")
    found = settle(units, length, most)
    sure = contexts.where(F.col("sure") & (F.col("before") + F.col("after") >= length)).select("c1", "c2", F.array(span).alias("spans"))
    found = found.unionByName(sure).groupBy("c1", "c2").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    found = stored(found.select(F.col("c1").alias("d1"), F.col("c2").alias("d2"), "spans"), "found")
    joined = lookup_join(mixed_rows, found, [("c1", "d1"), ("c2", "d2")], ["spans"], BROADCAST)
    each = joined.where("spans is not null").select("cid", "pos", F.explode("spans").alias("span"))
    each = each.union(met.where(F.col("uniform") & (F.col("before") + F.col("after") >= length)).select("cid", "pos", span.alias("span")))
    moved = F.struct((F.col("pos") + F.col("span.from")).alias("from"), (F.col("pos") + F.col("span.to")).alias("to"))
    per_text = each.groupBy("cid").agg(F.collect_list(moved).alias("spans"))
    whole = F.struct(F.lit(0).alias("from"), F.octet_length("data").cast("int").alias("to"))
    alone = map_rows(per_text, f"cid bigint, {SPANS}", lambda: lambda cid, spans: (cid, [{"from": a, "to": b} for a, b in merged(spans)]))
    all_of = classes.select("cid", F.sha2("data", 256).alias("text_sha256"), F.when(F.col("copies") > 1, F.array(whole)).alias("whole"))
    out = all_of.join(alone, "cid", "left").select("text_sha256", F.coalesce("whole", "spans").alias("spans")).where("spans is not null")
    out = stored(out, "spans")
    released(met, contexts, found, classes)
    return out


def without_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, most: int = MOST
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, spans (maximal runs of repeated bytes) and kept (the other bytes)."""
    found = repeated_spans(docs, text, length, gram, most)
    data = docs.select(F.col(id).alias("doc_id"), text_bytes(text).alias("data"))
    named = data.withColumn("sha", F.sha2("data", 256))
    joined = lookup_join(named, found, [("sha", "text_sha256")], ["spans"])
    spans = F.coalesce("spans", F.array().cast("array<struct<from: int, to: int>>"))
    joined = joined.select("doc_id", "data", spans.alias("spans"))
    ends = F.concat(F.array(F.lit(0)), F.transform("spans", lambda s: s["to"]))
    starts = F.concat(F.transform("spans", lambda s: s["from"]), F.array(F.octet_length("data").cast("int")))
    gaps = F.zip_with(ends, starts, lambda a, b: F.substring("data", a + 1, b - a))
    kept = F.aggregate(gaps, F.lit(b""), lambda total, gap: F.concat(total, gap))
    return joined.select("doc_id", F.octet_length("data").cast("long").alias("n_bytes"), "spans", kept.alias("kept"))
