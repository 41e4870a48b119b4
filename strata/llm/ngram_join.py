"""N-gram Jaccard self-join: universe partition, pigeonhole, one-deletion neighbourhoods, exact check.

A text's set is that of its distinct word shingles. Two sets of sizes a and b have Jaccard similarity
of p percent or more only if they differ in at most (100 - p)(a + b) / (100 + p) shingles. Sets of one
size band, and of the next, are cut into the same m segments by a hash of each shingle. Let d be the
most by which two of them may differ.

* **Exact segments.** With m = d + 1 + spare segments, similar sets share ``1 + spare`` whole segments.
  So a set may leave up to ``spare`` segments out, and it leaves out those that cost most: empty ones,
  and those whose content measures as frequent. A pair is found if either of the two has left out
  no more than that, since a content that one leaves out for its frequency the other leaves out too.
* **One-deletion neighbourhoods.** A segment indexed whole and also without each one of its shingles
  finds partners that differ by one in it, and counts double. Sets of bands with d below ``SMALL_GAP``
  use m = (d + 2) // 2 such segments: their segments would be too short otherwise. Sets of other bands
  that have too many empty segments get back the missing count from one-deletion segments; if even that
  falls short, they keep the empty ones, which only sets in the same case do.
* **Allocation by cost.** Sets that have to leave out too much, because a passage of many texts spoils
  many of their segments, are cut once more: all shingles of costly contents go to one segment, and
  the others to 2d + 1, of which a set needs d + 1 that it keeps. Sets that have fewer, since most of
  their shingles are in frequent contents, are cut a third time, into (d + 2) // 2 one-deletion segments.

The cost of a content is the number of pairs of sets with it that are not yet in one component.
Candidates are therefore made in steps: first each set with the first set of its key's group (already
within a batch, before the shuffle, so a frequent key is not one row per set); those are checked, and
only members of groups that still hold several components are paired, up to ``PAIRS`` per member but for
one-deletion segments, whose members are compared by sizes and parities where they meet.
A group of copies thus costs one pair per member and key, never all pairs, and no link between
components is lost. Every candidate is checked exactly, on the words of both texts. Texts with one
set travel once, as their representative.

Defined results: without words, or with a null text, a set is empty and linked with nothing. Rows of
equal sets are linked, whatever their ids; null ids count as larger than any id, and a component of
null ids only has a null id. An empty table gives no rows.
"""

from __future__ import annotations

import bisect
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.links import components
from strata.llm.text import WORD, distinct, free_name, importable, map_rows, mixed, row_batch, rows_of, shingle_hashes, text_bytes, word_hashes, words
from strata.operators.skew import flag_join, lookup_join
from strata.session import released, stored

WIDTH, PERCENT = 4, 85
SMALL_GAP = 4
SPARE = 0.04
PAIRS = 32
EXACT, SHORTER, LEFT_OUT = 0, 1, 2
KIND = 60  # bit at which a row's kind starts, above the set's number
PARITY, DELETING = 1, 2  # lowest bits of a key: the band's parity; whether its band has one-deletion segments only
SALT_A, SALT_B = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
BATCH_KEYS = 400_000
PARITY_BITS = 512
SHORT_OF_SEGMENTS = -1


class Bands:
    """Size bands, and for each the segments of the pairs whose smaller set lies in it."""

    def __init__(self, percent: int = PERCENT):
        self.percent, self.starts = percent, [1]
        while self.starts[-1] < 1 << 31:
            self.starts.append(max(self.starts[-1] + 1, self.starts[-1] * 100 // percent + 1))

    def of(self, size: int) -> int:
        return bisect.bisect_right(self.starts, size) - 1

    def gap(self, band: int) -> int:
        """The most shingles by which two similar sets differ, the smaller one in ``band``."""
        small = self.starts[band + 1] - 1
        large = small * 100 // self.percent
        return (100 - self.percent) * (small + large) // (100 + self.percent)

    def plan(self, band: int) -> tuple[int, int, int]:
        """Segments, gap, and how many segments a set may leave out; -1 for one-deletion segments."""
        gap = self.gap(band)
        if gap < SMALL_GAP:
            return (gap + 2) // 2, gap, -1
        spare = 1 + int(SPARE * gap)
        return gap + 1 + spare, gap, spare


@functools.lru_cache(maxsize=256)
def segment_salts(band: int, segments: int) -> tuple[np.uint64, np.ndarray]:
    """A number for the band, and one for each of its segments."""
    salt = np.uint64(mixed(np.array([band + 1], np.uint64))[0])
    return salt, mixed(np.arange(segments, dtype=np.uint64) + salt)


class Cut:
    """A set of shingle hashes cut into the segments of a band: the key of each one that is not empty.

    Shingles in ``common`` are in segment 0, and no others then.
    """

    def __init__(self, found: np.ndarray, band: int, segments: int, deleting: bool = False, common: np.ndarray | None = None):
        self.segments, (salt, self.salts) = segments, segment_salts(band, segments)
        self.low = np.uint64((band & 1) * PARITY + deleting * DELETING)
        spread = mixed(found ^ salt)
        part = (spread >> np.uint64(32)).astype(np.int64)
        if common is None:
            part %= segments
        else:
            part = np.where(np.isin(found, common), 0, 1 + part % (segments - 1))
        self.found, self.part, self.inner = found, part, mixed(spread ^ SALT_A)
        sizes, sums = np.bincount(part, minlength=segments), np.zeros(segments, np.uint64)
        np.add.at(sums, part, self.inner)
        self.held = np.flatnonzero(sizes)
        self.sizes, self.sums = sizes[self.held], sums[self.held]
        self.owner = (np.cumsum(sizes > 0) - 1)[part]
        self.whole = self.key(self.held, self.sums)

    def key(self, of: np.ndarray, content: np.ndarray) -> np.ndarray:
        made = mixed(content ^ self.salts[of])
        return (made & ~np.uint64(PARITY | DELETING)) | self.low

    def without_one(self) -> np.ndarray:
        """The key of each segment without each one of its shingles."""
        return self.key(self.part, self.sums[self.owner] - self.inner)

    def nothing(self) -> np.ndarray:
        """The keys of the empty segments."""
        empty = np.flatnonzero(np.bincount(self.held, minlength=self.segments) == 0)
        return self.key(empty, np.zeros(len(empty), np.uint64))

    def among(self, keys: set[int] | None) -> np.ndarray:
        """Which segments' keys are among ``keys``."""
        if not keys:
            return np.zeros(len(self.whole), bool)
        return np.fromiter((k in keys for k in self.whole.view(np.int64).tolist()), bool, len(self.whole))

    def left_out(self, out: np.ndarray) -> int:
        return self.segments - len(self.held) + int(out.sum())


def cuts_of(found: np.ndarray, bands: Bands) -> Iterator[tuple[int, Cut, int, int]]:
    """(band, cut, gap, spare) of a set under its own band and the one below, but for bands of equal sets only."""
    own = bands.of(len(found))
    for band in {own, max(0, own - 1)}:
        segments, gap, spare = bands.plan(band)
        if gap:  # otherwise only equal sets, which are one set here
            yield band, Cut(found, band, segments, spare < 0), gap, spare


def set_keys(found: np.ndarray, bands: Bands) -> Iterator[tuple[np.ndarray, int]]:
    """Keys of a set of shingle hashes under its own band and the one below, with their kind."""
    for _, cut, _, spare in cuts_of(found, bands):
        if spare >= 0 and cut.left_out(cut.among(None)) <= spare:
            yield cut.whole, EXACT
        else:
            yield from deleted_keys(cut, spare)


def deleted_keys(cut: Cut, spare: int) -> Iterator[tuple[np.ndarray, int]]:
    """Keys with one-deletion segments; with a ``spare`` from 0 the empty segments are left out."""
    yield cut.without_one(), SHORTER
    nothing = cut.nothing()
    if spare < 0:
        yield np.concatenate([cut.whole, nothing]), EXACT
        return
    yield cut.whole, EXACT
    yield nothing, LEFT_OUT
    if len(nothing) - spare > int((cut.sizes > 1).sum()):
        yield nothing, EXACT


def hard_cuts(found: np.ndarray, bands: Bands, costly: set[int]) -> Iterator[tuple[int, Cut, int, int, np.ndarray]]:
    """(band, cut, gap, spare, out) of the bands in which a set has to leave out more than it may.

    ``costly`` holds contents that were measured as frequent, and ``out`` tells which segments have one.
    """
    for band, cut, gap, spare in cuts_of(found, bands):
        if spare >= 0 and cut.left_out(out := cut.among(costly)) > spare:
            yield band, cut, gap, spare, out


def allocated(found: np.ndarray, band: int, gap: int, common: np.ndarray) -> Cut:
    """The cut of a hard set: frequent shingles in a segment of their own, the others in twice as many as pairs may differ in."""
    return Cut(found, band, 2 * (gap + 1), common=common)


def hard_keys(
    found: np.ndarray, bands: Bands, costly: set[int], common: np.ndarray, again: set[int] | None = None
) -> Iterator[tuple[np.ndarray, int]]:
    """Keys of a set in its hard bands, with their kind: of its segments by frequency, or with ``again``, the
    contents that are frequent among these as well, the one-deletion keys of bands that leave out too much even so."""
    for band, _, gap, _, _ in hard_cuts(found, bands, costly):
        anew = allocated(found, band, gap, common)
        if again is None:
            yield anew.whole, EXACT
        elif anew.left_out(anew.among(again)) > anew.segments - gap - 1:
            yield from deleted_keys(Cut(found, band, (gap + 2) // 2, deleting=True), -1)


def met(kind: int, other: int) -> bool:
    """Whether rows of one key pair up, by their kinds."""
    return {kind, other} in ({EXACT}, {EXACT, SHORTER}, {SHORTER, LEFT_OUT})


def sets_of(docs: DataFrame, id: str, text: str, width: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, two independent 64-bit sums over the set, and its parity, by row of ``docs``.

    The parity tells for each of PARITY_BITS slots whether an odd number of shingles hashes to it.
    """

    def work():
        def one(key, mark, data):
            found = distinct(shingle_hashes(word_hashes(data), width))
            sums = [int(mixed(found ^ salt).sum(dtype=np.uint64).view(np.int64)) for salt in (SALT_A, SALT_B)]
            odd = np.bincount((mixed(found ^ SALT_A) >> np.uint64(8)).astype(np.int64) % PARITY_BITS, minlength=PARITY_BITS) & 1
            return key, mark, len(found), *sums, np.packbits(odd.astype(np.uint8)).view(np.int64)

        return one

    return map_rows(
        docs.select(id, F.xxhash64(text_bytes(text)), text_bytes(text)),
        "doc_id bigint, text_hash bigint, n_shingles bigint, sum_a bigint, sum_b bigint, parity array<bigint>", work,
    )


ROWS = "key bigint, head bigint, member bigint"


def known_of(costly: list | None, common: list | None = None, *again: list | None) -> tuple:
    """The columns of a hard set as ``hard_keys`` takes them."""
    return set(costly or ()), np.array(common or (), np.int64).view(np.uint64), *(set(keys or ()) for keys in again)


def index_rows(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(key, head, member) of the sets of ``texts`` (set, data[, costly, common[, again]]).

    Within a batch, rows of a key are led by its first whole segment: ``head`` is then that row and
    differs from ``member`` in the others. ``member`` is the set's number with the kind above it. A set
    that has to leave out too many empty segments gives a row with the head SHORT_OF_SEGMENTS as well.
    """
    columns = [c for c in ("set", "data", "costly", "common", "again") if c in texts.columns]
    hard = "costly" in columns

    def led(keys, members):
        key, member = np.concatenate(keys).view(np.int64), np.concatenate(members)
        order = np.lexsort((member, key))
        key, member = key[order], member[order]
        new = np.r_[True, key[1:] != key[:-1]]
        head = member[np.flatnonzero(new)][np.cumsum(new) - 1]
        return row_batch(key, np.where(head >> KIND == EXACT, head, member), member)

    def run(batches):
        bands = Bands(percent)
        keys, members, short, size = [], [], [], 0
        for number, data, *known in rows_of(batches):
            found = distinct(shingle_hashes(word_hashes(data), width))
            for made, kind in hard_keys(found, bands, *known_of(*known)) if hard else set_keys(found, bands):
                keys.append(made)
                members.append(np.full(len(made), number | kind << KIND, np.int64))
                size += len(made)
                if kind == LEFT_OUT and not hard:
                    short.append(number)
            if size > BATCH_KEYS:
                yield led(keys, members)
                keys, members, size = [], [], 0
        if size:
            yield led(keys, members)
        if short:
            number = np.unique(np.array(short, np.int64))
            yield row_batch(number, np.full(len(number), SHORT_OF_SEGMENTS), number)

    return importable(texts).select(*columns).mapInArrow(run, ROWS)


def grouped(rows: DataFrame) -> DataFrame:
    """(key, head, member) for every row but the first of each key that several sets have.

    Rows that lead a batch meet by key and are read in order, so memory holds one row and not a
    group; the others are spread evenly and pass. Keys without a whole segment are left out: two
    shortened segments that are equal prove nothing.
    """

    def run(batches):
        last, lead = None, 0
        for batch in batches:
            key, head, member = (c.to_numpy() for c in batch.columns)
            passing = head != member
            if passing.any():
                yield row_batch(key[passing], head[passing], member[passing])
                key, member = key[~passing], member[~passing]
            if not len(key):
                continue
            new = np.r_[last is None or key[0] != last, key[1:] != key[:-1]]
            heads = np.r_[lead, member[new]][np.cumsum(new)]
            last, lead = key[-1], heads[-1]
            keep = ~new & (heads >> KIND == EXACT)
            if keep.any():
                yield row_batch(key[keep], heads[keep], member[keep])

    leads = F.col("head") == F.col("member")
    met = importable(rows).repartition(F.when(leads, F.col("key")).otherwise(F.xxhash64("key", "member")))
    return met.sortWithinPartitions("key", "member").mapInArrow(run, ROWS)


def number_of(column: str):
    return F.col(column).bitwiseAND(F.lit((1 << KIND) - 1))


def exactly_similar(left: list[bytes], right: list[bytes], width: int, percent: int) -> bool:
    """Whether the shingle sets of two word lists are similar, by the words themselves."""
    if min(len(left), len(right)) < width:
        return left == right
    x, y = ({tuple(found[k : k + width]) for k in range(len(found) - width + 1)} for found in (left, right))
    both = len(x & y)
    return 100 * both >= percent * (len(x) + len(y) - both)


def similar(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) of sets whose texts are similar.

    Rows come by ``a``, whose hashes are kept from row to row. Equal shingles have equal hashes, so a pair
    that fails by its hashes fails; the others are compared by their words.
    """

    def work():
        last = (None, None)

        def one(a, b, left, right):
            nonlocal last
            if a != last[0]:
                last = (a, distinct(shingle_hashes(word_hashes(left), width)))
            x, y = last[1], distinct(shingle_hashes(word_hashes(right), width))
            if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                return
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= percent * (len(x) + len(y) - both):
                if exactly_similar(words(left.lower()), words(right.lower()), width, percent):
                    yield a, b

        return one

    left = texts.select(F.col("set").alias("a"), F.col("data").alias("left"))
    right = texts.select(F.col("set").alias("b"), F.col("data").alias("right"))
    met = pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right")
    return map_rows(met, "a bigint, b bigint", work, many=True)


def sketches(classes: DataFrame) -> DataFrame:
    """(set, seen): size and parity of each set."""
    return classes.select("set", F.struct("n_shingles", "parity").alias("seen"))


def may_be_similar(one: str, two: str, percent: int) -> Column:
    """Whether two sets may be similar by their sizes and parities.

    A slot whose parity differs holds a shingle that only one of the two has, so slots that differ are
    no more than the shingles that differ. That drops no similar pair, and keeps texts from moving.
    """
    n, m = F.col(f"{one}.n_shingles"), F.col(f"{two}.n_shingles")
    differ = F.lit(0)
    for k in range(PARITY_BITS // 64):
        differ = differ + F.bit_count(F.col(f"{one}.parity")[k].bitwiseXOR(F.col(f"{two}.parity")[k]))
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (differ * (100 + percent) <= (n + m) * (100 - percent))


def sized(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The distinct pairs that may be similar by the sizes and parities of their sets."""
    found = pairs.distinct()
    for side in ("a", "b"):
        found = lookup_join(found.withColumnRenamed("seen", "seen_a"), sketches(classes), [(side, "set")], ["seen"])
    return found.where(may_be_similar("seen_a", "seen", percent)).select("a", "b")


def roots_of(links: DataFrame) -> DataFrame:
    return stored(components(links).select(F.col("node").alias("set"), "root"), "roots")


def matched(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose texts are similar, as a table. Only texts of sets in ``pairs`` move."""
    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct(), "candidates")
    wanted = stored(flag_join(texts, ids, [("set", "set")], "wanted").where("wanted").drop("wanted"), "candidate-texts")
    links = stored(similar(pairs, wanted, width, percent), "links")
    released(ids, wanted)
    return links


def apart(rows: DataFrame, links: DataFrame, most: int) -> DataFrame:
    """(key, set, kind, root) of the ``rows`` (key, member) whose key has several components and more than ``most`` rows, as a table."""
    roots = roots_of(links)
    placed = lookup_join(rows.withColumn("set", number_of("member")), roots, [("set", "set")], ["root"])
    placed = placed.select("key", "set", F.shiftright("member", KIND).alias("kind"), F.coalesce("root", "set").alias("root"))
    several = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n"))
    several = stored(several.where((F.col("low") != F.col("high")) & (F.col("n") > most)).select("key"), "several")
    placed = stored(flag_join(placed, several, [("key", "key")], "there").where("there").drop("there"), "placed")
    released(roots, several)
    return placed


def settled(
    groups: DataFrame, links: DataFrame | None, done: DataFrame | None, used: list[DataFrame],
    texts: DataFrame, classes: DataFrame, width: int, percent: int,
) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Links by what the keys of ``groups`` (key, head, member) share, but for costly keys.

    Gives all links so far, all pairs that were checked, and (key, set, kind, root) of the costly keys whose
    sets are still in several components; None if no key has several. ``used`` takes the tables behind these.
    """
    star = groups.select(number_of("head").alias("a"), number_of("member").alias("b")).where("a <> b")
    star = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    star = star if done is None else star.join(done, ["a", "b"], "left_anti")
    star = stored(sized(star, classes, percent), "star")
    found = matched(star, texts, width, percent)
    links, done = (found, star) if links is None else (links.union(found), done.union(star))
    # What is left: members of one key that are in several components.
    members = groups.select("key", "member").union(groups.select("key", F.col("head").alias("member"))).distinct()
    placed = apart(members, links, 2)
    used += [star, placed]
    if placed.isEmpty():
        return links, done, None
    by_root = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    n, squares = F.sum("n"), F.sum(F.col("n") * F.col("n"))
    priced = by_root.groupBy("key").agg(((n * n - squares) / 2 > n * PAIRS).alias("frequent"))
    costly = F.col("frequent") & (F.col("key").bitwiseAND(F.lit(DELETING)) == 0)
    priced = stored(placed.join(priced.select("key", costly.alias("costly")), "key"), "priced")
    used.append(priced)
    links = links.union(checked(priced.where("not costly"), texts, classes, done, width, percent))
    return links, done, priced.where("costly").drop("costly")


def joined_sets(texts: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) between sets that give the components of all similar pairs."""
    found = stored(grouped(index_rows(texts, width, percent)), "groups")
    used = [found]
    groups = found.where(F.col("head") != SHORT_OF_SEGMENTS)
    links, done, dear = settled(groups, None, None, used, texts, classes, width, percent)
    if dear is not None and not dear.isEmpty():
        short = found.where(F.col("head") == SHORT_OF_SEGMENTS).select(F.col("member").alias("set")).distinct()
        links = hard_links(dear, short, links, done, used, texts, classes, width, percent)
    released(*used)
    return links


def hard_links(
    dear: DataFrame, short: DataFrame, links: DataFrame, done: DataFrame, used: list[DataFrame],
    texts: DataFrame, classes: DataFrame, width: int, percent: int,
) -> DataFrame:
    """``links`` and those between sets that have to leave out more than they may, because of costly keys.

    Any other set finds its partners by what it keeps. These are cut once more by frequency: the shingles
    of costly contents share one segment, so they spoil one and not many. Only sets that leave out too
    much of this cut too are cut into one-deletion segments, half as many and twice as long as those of
    the first, which leave nothing out. Each cut is settled before the next one pairs what is still apart.
    """
    over = dear.where(F.col("kind") == EXACT).select("set", "key").union(short.select("set", F.lit(None).cast("long")))
    over = stored(over.groupBy("set").agg(F.collect_set("key").alias("costly")), "hard")
    hard = stored(lookup_join(texts, over, [("set", "set")], ["costly"]).where("costly is not null"), "hard-texts")
    frequent = stored(shingles_of(hard, width, percent, in_costly=True).select("shingle").distinct(), "frequent")
    common = flag_join(shingles_of(hard, width, percent), frequent, [("shingle", "shingle")], "common").where("common")
    common = stored(common.groupBy("set").agg(F.collect_list("shingle").alias("common")), "common")
    allocated_sets = stored(lookup_join(hard, common, [("set", "set")], ["common"]), "allocated")
    released(over, hard, frequent, common)
    groups = stored(grouped(index_rows(allocated_sets, width, percent)), "hard-groups")
    links, done, dear = settled(groups, links, done, used, texts, classes, width, percent)
    again = F.lit(None).cast("array<bigint>")
    left = allocated_sets.withColumn("again", again)
    if dear is not None:
        keys = stored(dear.groupBy("set").agg(F.collect_set("key").alias("again")), "again")
        left = lookup_join(allocated_sets, keys, [("set", "set")], ["again"])
    rows = stored(grouped(index_rows(left, width, percent)), "hard-index")
    links, *_ = settled(rows, links, done, used, texts, classes, width, percent)
    released(groups, allocated_sets, rows)
    return links


def shingles_of(hard: DataFrame, width: int, percent: int, in_costly: bool = False) -> DataFrame:
    """(set, shingle) of the sets of ``hard`` that have a hard band; with ``in_costly``, those of costly contents there."""

    def work():
        bands = Bands(percent)

        def one(number, data, costly):
            found = distinct(shingle_hashes(word_hashes(data), width))
            held = [cut.found[out[cut.owner]] if in_costly else found for _, cut, _, _, out in hard_cuts(found, bands, set(costly))]
            if held:
                for shingle in np.unique(np.concatenate(held)).view(np.int64).tolist():
                    yield number, shingle

        return one

    return map_rows(hard.select("set", "data", "costly"), "set bigint, shingle bigint", work, many=True)


def paired(placed: DataFrame, percent: int | None = None) -> DataFrame:
    """Pairs of members of one key that are in different components, as their kinds allow.

    One of each such pair is outside of the key's largest component. So those outside meet all, and
    the members of a large group of copies never meet each other. With ``percent``, members carry what
    ``sketches`` gives, and pairs that cannot be similar are dropped where they meet.
    """
    sizes = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("n", "root")).alias("largest"))
    outside = placed.join(largest.select("key", F.col("largest.root").alias("most")), "key").where("root <> most")
    carried = ["kind", "root"] if percent is None else ["kind", "root", "seen"]
    one = outside.select("key", F.col("set").alias("a"), *[F.col(c).alias(f"{c}_a") for c in carried])
    two = placed.select("key", F.col("set").alias("b"), *[F.col(c).alias(f"{c}_b") for c in carried])
    meet = F.lit(False)
    for x in (EXACT, SHORTER, LEFT_OUT):
        for y in (EXACT, SHORTER, LEFT_OUT):
            if met(x, y):
                meet = meet | ((F.col("kind_a") == x) & (F.col("kind_b") == y))
    if percent is not None:
        meet = meet & may_be_similar("seen_a", "seen_b", percent)
    found = one.join(two, "key").where(meet & (F.col("root_a") != F.col("root_b")))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def checked(placed: DataFrame, texts: DataFrame, classes: DataFrame, done: DataFrame, width: int, percent: int) -> DataFrame:
    """The similar pairs among members of one key in different components that are not in ``done``."""
    seen = stored(lookup_join(placed, sketches(classes), [("set", "set")], ["seen"]), "seen")
    left = stored(paired(seen, percent).join(done, ["a", "b"], "left_anti"), "pairs")
    released(seen)
    links = matched(left, texts, width, percent)
    released(left)
    return links


def near_classes(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_shingles, component_id (the least id linked to
    it), and component, a number for it. An empty set has its own id and no number.
    """
    rows = stored(sets_of(docs, id, text, width), "sets")
    full = rows.where("n_shingles > 0")
    sums = ["n_shingles", "sum_a", "sum_b"]
    classes = full.groupBy(*sums).agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.min("doc_id").alias("least"),
                                       F.first("parity").alias("parity"))
    classes = stored(classes.withColumn("set", F.monotonically_increasing_id()), "classes")
    numbers = classes.select(F.col("first.doc_id").alias("doc_id"), F.col("first.text_hash").alias("text_hash"), "set")
    keyed = docs.select(F.col(id).alias("doc_id"), F.xxhash64(text_bytes(text)).alias("text_hash"), text_bytes(text).alias("data"))
    null_safe = F.coalesce(F.col("doc_id").cast("string"), F.lit("n"))
    texts = lookup_join(
        keyed.withColumn("row", null_safe), numbers.withColumn("row", null_safe),
        [("row", "row"), ("text_hash", "text_hash")], ["set"],
    ).where("set is not null").select("set", "data")
    texts = stored(texts, "set-texts")  # read up to eight times
    links = joined_sets(texts, classes, width, percent)
    released(texts)
    roots = roots_of(links)
    placed = lookup_join(classes.select(*sums, "set", "least"), roots, [("set", "set")], ["root"])
    placed = stored(placed.withColumn("root", F.coalesce("root", "set")), "placed")
    ids = stored(placed.groupBy("root").agg(F.min("least").alias("component_id")), "ids")
    named = stored(lookup_join(placed, ids, [("root", "root")], ["component_id"]), "named")
    released(classes, roots, placed, ids)
    found = lookup_join(rows, named, [(c, c) for c in sums], ["root", "component_id"])
    return found.select(
        "doc_id", "text_hash", "n_shingles", F.col("root").alias("component"),
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def keep_first(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """``docs`` with one row of each component: that of its least id, and of several, one by content."""
    found = stored(near_classes(docs, id, text, width, percent), "near")
    mark, key, flag, turn = (free_name(docs, f"near_{c}") for c in ("hash", "id", "flag", "turn"))
    named = docs.select(
        "*", F.xxhash64(text_bytes(text)).alias(mark), F.coalesce(F.col(id).cast("string"), F.lit("n")).alias(key)
    )
    own = F.coalesce(F.col("doc_id").cast("string"), F.lit("n")).alias(key)
    first = F.col("component").isNull() | F.col("doc_id").eqNullSafe(F.col("component_id"))
    gone = found.where(~first).select(F.col("text_hash").alias(mark), own)
    several = found.where(first & F.col("component").isNotNull())  # rows that share the least id, or have none
    tied = not several.groupBy("component").count().where("count > 1").isEmpty()
    if tied:
        chosen = several.groupBy("component").agg(F.min("text_hash").alias("chosen"))
        others = several.join(chosen, "component").where("text_hash <> chosen")
        gone = gone.union(others.select(F.col("text_hash").alias(mark), own))
    left = flag_join(named, stored(gone, "gone"), [(mark, mark), (key, key)], flag).where(~F.col(flag))
    if tied:
        order = Window.partitionBy(mark, key).orderBy(F.xxhash64(*docs.columns))
        empty = ~F.coalesce(F.col(text).rlike(WORD), F.lit(False))
        left = left.withColumn(turn, F.row_number().over(order)).where((F.col(turn) == 1) | empty)
    return left.select(*docs.columns)
