"""Spelling variants: words one code point apart, met in a trie over letter-group counts.

A word's levels are its length and then its count of each letter group. Inserting a code point raises
the length and at most one count by one; replacing one raises one count and lowers one. So the near
words of a word lie on the paths that spend a surplus of one and a deficit of one along its own
levels: a depth-first search follows the counts that are there, spends the budget where a count
differs, and verifies the words of the leaves that it reaches. Of two words of one length, that with
the lesser count at the first difference searches (surplus first, deficit after it), and the shorter
searches the longer, so every pair is met once.

The trie is cut: nodes with more than ``most`` words below them are open, and are known to all tasks;
the subtree below every other child is one group of rows. Each word is sent to its own subtree as an
entry, and as a search, with the budget that it has left, to every subtree that the search reaches
through the open nodes. ``most`` is the larger of ``SUBTREE`` and a ``NODES``-th of the words, so each
level has at most ``NODES`` open nodes, whatever the number of words. A full path that more than
``most`` words share is dealt over pieces, each of which all searches visit; a subtree with very many
searches has its entries in several places and its searches dealt over them. So no group has to be in
one task as a whole, and nothing is left out.

Null texts and texts without words give nothing, a null id is hashed as the empty string, repeated
rows count again, an empty table gives no rows. Other columns of the table are not read.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.text import lower_az, map_rows, map_task
from strata.operators.skew import shuffle_width
from strata.session import released, stored

RUN = "[A-Za-zÀ-ÿ]"
# Frequent letters come with rare ones, so the counts of a group vary. All other code points are the last group; the
# length implies its count, so it has no level, and a full path may be reached with budget left for it.
GROUPS = ("ej", "aq", "ix", "oz", "nk", "tv", "sw", "ry", "lb", "dg", "up", "hm")
DEPTH = 1 + len(GROUPS)
SUBTREE, NODES = 16_384, 20_000
SEARCHES = 1 << 20
BUCKET = 16
TOGETHER = 20_000
EDGE = 3
LEVEL = {letter: k for k, letters in enumerate(GROUPS, start=1) for letter in letters}
_DRAWN = random.Random(11)
WEIGHTS = {chr(c): _DRAWN.getrandbits(40) for c in (*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100))}
ANY_OTHER = _DRAWN.getrandbits(40)
APART = {a - b for a in (*WEIGHTS.values(), ANY_OTHER) for b in (*WEIGHTS.values(), ANY_OTHER, 0)}
ENTRY = -1
# Budget left, as (surplus, deficit): both, deficit only, surplus only, none.
BOTH, DEFICIT, SURPLUS, NONE = 3, 1, 2, 0

Path = tuple[int, ...]


def word_counts(
    docs: DataFrame, id: str = "doc_id", text: str = "text", least_length: int = 7, least_count: int = 2, drop: int = 31
) -> DataFrame:
    """word and n: how often each run of letters, A to Z in lower case, occurs in all texts.

    A run loses one code point, chosen by a hash of id and run, where ``drop`` divides the hash
    (0: never). Words shorter than ``least_length`` or rarer than ``least_count`` are not returned.
    """
    # A shorter run can't give a word, and the greedy run of at least that length is still a maximal one.
    found = F.regexp_extract_all(F.col(text), F.lit(f"{RUN}{{{least_length},}}"), F.lit(0))
    runs = docs.select(F.coalesce(F.col(id).cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    runs = runs.select("id", lower_az(F.col("run")).alias("run"))
    if drop:
        length = F.char_length("run")
        hashed = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
        at = F.pmod(hashed, length).cast("int")
        shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, length))
        word = F.when(hashed % drop == 0, shorter).otherwise(F.col("run"))
    else:
        word = F.col("run")
    words = runs.select(word.alias("word")).where(F.char_length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def levels(word: Column) -> list[Column]:
    """The length of a word and its counts of the letter groups."""
    length = F.char_length(word)
    return [length, *[length - F.char_length(F.translate(word, letters, "")) for letters in GROUPS]]


def levels_of(word: str) -> Path:
    """``levels`` in a task."""
    counts = [0] * (DEPTH + 1)
    for letter in word:
        counts[LEVEL.get(letter, DEPTH)] += 1
    return (len(word), *counts[1:DEPTH])


def weight_of(word: str) -> int:
    """The sum of the letters' weights: those of near words differ by a weight, or by the difference of two."""
    return sum([WEIGHTS.get(letter, ANY_OTHER) for letter in word])


def open_nodes(words: DataFrame, subtree: int = SUBTREE, nodes: int = NODES) -> tuple[dict[Path, int], int]:
    """The paths of the trie's nodes with more than ``most`` words below, with their number of words; and ``most``."""
    total = words.count()
    most = max(subtree, total // nodes)
    found: dict[Path, int] = {(): total} if total > most else {}
    level, spark = list(found), words.sparkSession
    for depth in range(1, DEPTH + 1):
        if not level:
            break
        columns = [c.alias(f"c{k}") for k, c in enumerate(levels(F.col("word"))[:depth])]
        rows = words.select(*columns)
        if depth > 1:
            above = [f"c{k}" for k in range(depth - 1)]
            kept = spark.createDataFrame(level, ", ".join(f"{c} int" for c in above))
            rows = rows.join(F.broadcast(kept), above, "left_semi")  # at most ``nodes`` rows
        counts = rows.groupBy(*[f"c{k}" for k in range(depth)]).count().where(F.col("count") > most)
        below = {tuple(r)[:-1]: r["count"] for r in counts.collect()}
        found |= below
        level = list(below)
    return found, most


def steps(budget: int, count: int) -> tuple[tuple[int, int], ...]:
    """The counts that a search may go on with at a node, with the budget left after each."""
    if budget == BOTH:
        return (count, BOTH), (count + 1, DEFICIT)
    if budget == DEFICIT:
        return (count, DEFICIT), (count - 1, NONE)
    if budget == SURPLUS:
        return (count, SURPLUS), (count + 1, NONE)
    return ((count, NONE),)


def start(length: int) -> tuple[tuple[int, int], ...]:
    """As ``steps`` for the first level: words of the same length, and those one longer."""
    return (length, BOTH), (length + 1, SURPLUS)


def routes(counts: Path, opened: dict[Path, int]) -> Iterator[tuple[Path, int]]:
    """The closed nodes, and full open paths, that a search from the root reaches, with the budget left."""
    stack: list[tuple[Path, int]] = [((), BOTH)]
    while stack:
        path, budget = stack.pop()
        depth = len(path)
        if depth == DEPTH or path not in opened:
            yield path, budget
            continue
        for count, left in start(counts[0]) if depth == 0 else steps(budget, counts[depth]):
            if count >= 0:
                stack.append(((*path, count), left))


def routed(words: DataFrame, opened: dict[Path, int], most: int) -> DataFrame:
    """Rows (subtree, piece, role, word, n): each word as an entry of its subtree and as the searches it makes."""
    deepest = max(map(len, opened), default=-1) + 1

    def reached(counts: Path) -> tuple[str, int, list[tuple[str, int, int]]]:
        """The own subtree and its pieces, and (subtree, piece, budget) of each search."""
        own = 0
        while own < DEPTH and counts[:own] in opened:
            own += 1
        searches = [
            (",".join(map(str, path)), piece, budget)
            for path, budget in routes(counts, opened)
            for piece in range(pieces(path))
        ]
        return ",".join(map(str, counts[:own])), pieces(counts[:own]), searches

    def pieces(path: Path) -> int:
        return -(-opened[path] // most) if path in opened else 1

    def work():
        known: dict[Path, tuple] = {}

        def each(word, n):
            # Words that agree on the open levels make the same searches.
            counts = levels_of(word)[:deepest]
            if counts not in known:
                if len(known) > 50_000:
                    known.clear()
                known[counts] = reached(counts)
            subtree, parts, searches = known[counts]
            yield subtree, zlib.crc32(word.encode()) % parts, ENTRY, word, n
            for place, piece, budget in searches:
                yield place, piece, budget, word, n

        return each

    return map_rows(words.select("word", "n"), "subtree string, piece int, role int, word string, n bigint", work, many=True)


def dealt(rows: DataFrame, searches: int = SEARCHES) -> DataFrame:
    """``rows`` with a salt: entries of a subtree with very many searches stand in several places, its searches in one each."""
    place = ["subtree", "piece"]
    busy = rows.where(F.col("role") != ENTRY).groupBy(*place).count().where(F.col("count") > searches)
    # At most one row for each ``searches`` rows of the table.
    busy = busy.select(*place, F.ceil(F.col("count") / searches).cast("int").alias("places"))
    found = rows.join(F.broadcast(busy), place, "left").withColumn("places", F.coalesce("places", F.lit(1)))
    one = F.array(F.pmod(F.xxhash64("word"), F.col("places")).cast("int"))
    every = F.sequence(F.lit(0), F.col("places") - 1)
    return found.withColumn("salt", F.explode(F.when(F.col("role") == ENTRY, every).otherwise(one))).drop("places")


def one_apart(a: str, b: str) -> bool:
    """Whether ``b``, as long as ``a`` or one longer, differs from it by exactly one code point."""
    longer = len(b) - len(a)
    half = len(a) // 2
    if a[:half] != b[:half] and a[half + 1 - longer :] != b[half + 1 :] and a[half:] != b[half + longer :]:
        return False
    low, high = 0, len(a)  # the length of the common prefix
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return a != b and a[low + 1 - longer :] == b[low + 1 :]


Row = tuple[Path, int, str, str, str, int]


def row_of(word: str, n: int) -> Row:
    """A word with all that tells it from others: levels, weight, both ends."""
    return levels_of(word), weight_of(word), word[:EDGE], word[-EDGE:], word, n


def arranged(rows: list[Row], depth: int) -> list[Row] | dict:
    """The trie of ``rows`` from a level on: below each count what has it; few rows stay a list."""
    if len(rows) <= BUCKET or depth == DEPTH:
        return rows
    return {count: arranged(some, depth + 1) for count, some in by_count(rows, depth).items()}


def by_count(rows: list[Row], depth: int) -> dict[int, list[Row]]:
    below: dict[int, list[Row]] = {}
    for row in rows:
        below.setdefault(row[0][depth], []).append(row)
    return below


def met(searches: list[Row] | dict, entries: list[Row] | dict, depth: int, budget: int) -> Iterator[tuple[list[Row], list[Row], int]]:
    """The leaves of searches and entries that depth-first search brings together, with the budget left.

    Searches go down as a trie of their own, so what many have in common is gone through once.
    """
    stack = [(searches, entries, depth, budget)]
    while stack:
        some, node, at, left = stack.pop()
        if type(node) is list:
            if type(some) is dict:
                stack.extend((below, node, at, left) for below in some.values())
            else:
                yield some, node, left
            continue
        for count, below in (some if type(some) is dict else by_count(some, at)).items():
            for other, after in start(count) if at == 0 else steps(left, count):
                if other in node:
                    stack.append((below, node[other], at + 1, after))


def near_rows(searches: list[Row], entries: list[Row] | dict, depth: int, budget: int) -> Iterator[tuple[str, int, str, int]]:
    """Pairs one code point apart of searches that have ``budget`` left and the entries of a subtree.

    The words of two leaves are told apart by their weights, which stand for the counts of all single
    letters, and by their ends, before they are verified.
    """
    for some, leaf, left in met(arranged(searches, depth), entries, depth, budget):
        for _, weight, head, tail, word, n in some:
            found = [row for row in leaf if row[1] - weight in APART]
            if not found:
                continue
            length = len(word)
            for _, _, first, last, other, other_n in found:
                # One place can't touch both ends, unless the words are short.
                if first != head and last != tail and length > 2 * EDGE:
                    continue
                longer = len(other) - length
                # Words that differ below this leaf, or in no count, search each other: one of them is enough.
                if (longer == 1 or longer == 0 and (left != BOTH or word < other)) and one_apart(word, other):
                    yield word, n, other, other_n


def searched(rows: Iterator[tuple]) -> Iterator[tuple[str, int, str, int]]:
    """Turns the rows of a task, each group's entries before its searches, into pairs."""
    group, entries, tree, depth = None, [], None, 0
    waiting: dict[int, list[Row]] = {}

    def gone_through() -> Iterator[tuple[str, int, str, int]]:
        for budget, searches in waiting.items():
            yield from near_rows(searches, tree, depth, budget)
        waiting.clear()

    for subtree, piece, salt, role, word, n in rows:
        if (subtree, piece, salt) != group:
            yield from gone_through()
            group, entries, tree = (subtree, piece, salt), [], None
            depth = subtree.count(",") + 1 if subtree else 0
        if role == ENTRY:
            entries.append(row_of(word, n))
        elif entries:
            if tree is None:
                tree = arranged(entries, depth)
            some = waiting.setdefault(role, [])
            some.append(row_of(word, n))
            if len(some) == TOGETHER:
                yield from gone_through()
    yield from gone_through()


def near_pairs(words: DataFrame, subtree: int = SUBTREE, nodes: int = NODES, searches: int = SEARCHES) -> DataFrame:
    """Rows (a, a_n, b, b_n): every two of ``words`` (word, n) that are one code point apart, once."""
    opened, most = open_nodes(words, subtree, nodes)
    rows = stored(routed(words, opened, most), "searches")
    place = ["subtree", "piece", "salt"]
    grouped = dealt(rows, searches).select(*place, "role", "word", "n")
    grouped = grouped.repartition(shuffle_width(words), *place).sortWithinPartitions(*place, "role")
    pairs = stored(map_task(grouped, "a string, a_n bigint, b string, b_n bigint", searched), "near")
    released(rows)
    return pairs


def roots(forms: DataFrame) -> DataFrame:
    """word and root, where the forms (word, form) lead in the end.

    A form is at least ten times as frequent as its word, so no chain has more than 19 steps, and each
    round doubles the steps taken. At most the words one code point apart from a form share it as a key.
    """
    chain = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = chain.select(F.col("word").alias("at"), F.col("root").alias("next"))
        moved = chain.join(ahead, F.col("root") == F.col("at"), "left")
        further = stored(moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on")), "roots")
        released(chain)
        chain = further.drop("on")
        if further.where("on").isEmpty():
            return chain
        chain = further


def variants(words: DataFrame, times: int = 10, **limits: int) -> DataFrame:
    """One row per word of ``words`` (word, n): word, n, n_near, form, form_n and root.

    The form is the near word with the largest n, the smallest of them by code points, if its n is at
    least ``times`` that of the word, else null; the root is the last of the forms that follow.
    """
    words = stored(words, "words")
    pairs = near_pairs(words, **limits)
    near = pairs.select(F.col("a").alias("word"), F.struct((-F.col("b_n")).alias("n"), F.col("b").alias("word")).alias("near")).union(
        pairs.select(F.col("b").alias("word"), F.struct((-F.col("a_n")).alias("n"), F.col("a").alias("word")).alias("near"))
    )
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("near").alias("best"))
    found = words.join(best, "word", "left")
    formed = F.col("n") * times <= -F.col("best.n")
    found = found.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, F.col("best.word")).alias("form"),
        F.when(formed, -F.col("best.n")).alias("form_n"),
    )
    found = stored(found, "forms")
    released(pairs, words)
    ends = roots(found.where("form is not null").select("word", "form"))
    return found.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
