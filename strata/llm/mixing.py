"""Mixing sources to target weights, with DataFrame operations only.

Sizes are words. They are summed per source; the sources' targets and repetition rates follow from
the sums, and every document is emitted floor(rate) times, plus once more if a coin that its own
content seeds falls below the fraction of the rate. No row waits for another, so a source with a
third of all rows costs nothing extra: sums combine before the shuffle, and the rates come back by a
lookup that broadcasts up to a measured size and salts hot keys beyond it.

Defined results: a null or empty text has size 0 and follows its source's rate. A null source is a
source of its own, the last one. Equal rows share one coin. An empty table gives an empty mix. A
source without words has target 0 and leaves the mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.text import WORD, free_name
from strata.operators.skew import lookup_join, number_rows
from strata.session import scratch_root

WEIGHTS = (3, 1, 2)
COIN = 1 << 53


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A key that is never null: null has one no string has."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """Targets of ``sizes`` (key, source, source_size, one row each): columns key, source_size, target.

    Sources in code point order, null last, take the weights in turn and share ``share`` times all
    sizes. A target above ``most`` times its source stops there and the others take the excess by
    weight. That ends where every target is the smaller of its cap and of level * weight, and the
    level is found from running sums along cap / weight: with the sources before one held at their
    caps, the rest has the level (budget - caps) / weights, and the greatest such level that its own
    source's cap allows is the one. The running sums go by ranges; only one row per range meets.
    """
    ranked = number_rows(sizes.withColumn("last", F.col("source").isNull()), ["last", "source"], "rank", 0)
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    capped = ranked.select("key", "source_size", turn.alias("weight"), (F.col("source_size") * most).alias("cap"))
    ranged = (
        capped.withColumn("ratio", F.col("cap") / F.col("weight"))
        .repartitionByRange("ratio", "key")
        .withColumn("part", F.spark_partition_id())
        .checkpoint()
    )
    sums = [F.sum("cap").alias("caps"), F.sum("weight").alias("weights")]
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("part").agg(*sums)
    before = parts.select("part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_0") for c in ("caps", "weights")])
    all_of = ranged.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    inside = Window.partitionBy("part").orderBy("ratio", "key").rowsBetween(Window.unboundedPreceding, -1)
    here = {"caps": F.sum("cap").over(inside), "weights": F.sum("weight").over(inside)}
    placed = ranged.join(F.broadcast(before), "part").select(
        "ratio", *[(F.col(f"{c}_0") + F.coalesce(here[c], F.lit(0))).alias(c) for c in here]
    )
    budget = share * (all_of["size"] or 0)
    level = (F.lit(budget) - F.col("caps")) / (F.lit(all_of["weight"] or 0) - F.col("weights"))
    found = placed.select("ratio", level.alias("level")).where("level <= ratio").agg(F.max("level")).first()[0]
    target = F.col("cap") if found is None else F.least("cap", F.col("weight") * F.lit(found))
    return ranged.select("key", "source_size", target.cast("double").alias("target"))


def mixing_plan(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 42,
    id: str = "doc_id", text: str = "text", source: str = "source",
) -> tuple[DataFrame, str]:
    """``docs`` with one more column, a struct of size, source_size, target and copies; and its name."""
    scratch_root(docs.sparkSession)
    plan, key = free_name(docs, "mix_plan"), free_name(docs, "mix_key")
    size, planned, wanted = (free_name(docs, f"mix_{c}") for c in ("size", "source_size", "target"))
    sized = docs.select("*", source_key(F.col(source)).alias(key), word_count(F.col(text)).alias(size))
    sums = sized.groupBy(F.col(key).alias("key"), F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    targets = source_targets(sums, weights, share, most)
    rates = targets.select("key", F.col("source_size").alias(planned), F.col("target").alias(wanted))
    found = lookup_join(sized, rates, [(key, "key")], [planned, wanted])
    rate = F.when(F.col(planned) > 0, F.col(wanted) / F.col(planned)).otherwise(0.0)
    drawn = F.xxhash64(F.lit(seed), F.col(id), F.col(key), F.xxhash64(text))
    coin = F.pmod(drawn, F.lit(COIN)) / F.lit(float(COIN))
    copies = F.floor(rate) + F.when(coin < rate - F.floor(rate), 1).otherwise(0)
    row = F.struct(
        F.col(size).alias("size"), F.col(planned).alias("source_size"), F.col(wanted).alias("target"),
        copies.cast("int").alias("copies"),
    )
    return found.select(*docs.columns, row.alias(plan)), plan


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix: rows of ``docs``, each as often as its copies."""
    planned, plan = mixing_plan(docs, **options)
    turn = free_name(planned, "mix_turn")
    return planned.select(
        *docs.columns, F.explode(F.array_repeat(F.lit(0), F.col(f"{plan}.copies"))).alias(turn)
    ).drop(turn)
