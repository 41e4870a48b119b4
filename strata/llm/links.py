"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import released, stored

ROUNDS = 60
# A task of a round handles as many links at least, but a few tasks share the smallest tables.
LINKS_PER_TASK = 100_000
FEWEST_TASKS = 8


def _hung(pairs: DataFrame) -> DataFrame:
    """(node, least) pairs of the least node among each node and its neighbours in ``pairs`` (node, other)."""
    return pairs.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("least"))


def _packed(df: DataFrame, links: int) -> DataFrame:
    """``df`` in no more partitions than that many links need. Nothing moves: a task reads several small partitions,
    since a round over few links would spend its time on starting tasks."""
    tasks = max(FEWEST_TASKS, -(-links // LINKS_PER_TASK))
    return df.coalesce(tasks) if tasks < int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def components(links: DataFrame) -> DataFrame:
    """One row per node of ``links`` (a, b): node, and root, the least node that links reach from it.

    Alternating rounds hang each node's larger neighbours, then its smaller ones and itself, below
    the least node it sees, until every component is a star; that takes rounds in the order of the
    logarithm of its size. A node with very many links is summed before the shuffle, and the join back
    splits it. Each round is a table, so a lost executor costs one round; the table before it goes.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = stored(edges, "edges")
    before, n = None, edges.count()
    for _ in range(ROUNDS):
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        large = both.where("other > node").join(_hung(both), "node").select(F.col("other").alias("a"), F.col("least").alias("b"))
        large = _packed(_packed(large.where("a <> b"), n).distinct(), n)
        down = large.select(F.col("a").alias("node"), F.col("b").alias("other"))
        least = _hung(down)
        small = down.join(least, "node").select(F.col("other").alias("a"), F.col("least").alias("b"))
        next_edges = small.union(least.select(F.col("node").alias("a"), F.col("least").alias("b"))).where("a <> b")
        next_edges = stored(_packed(_packed(next_edges, n).distinct(), n), "edges")
        released(edges)
        edges = next_edges
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.crc32(F.concat_ws(",", "a", "b")))).first()
        if state == before:
            break
        before, n = state, state[0]
    else:
        raise RuntimeError(f"components still change after {ROUNDS} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
