"""Quality rules whose thresholds adapt to language and source.

Every text gives integer measures. Their distributions are sketched per language and source as counts
of values cut to their leading ``BITS`` bits: a quantile is off by at most one part in 2^(BITS-1), and
sketches merge by adding counts, in any order with one result. Merging gives the language's and the
whole corpus's sketch, which stand in where a source has fewer than ``fewest`` texts. A text fails
where a measure leaves its fence, the quartiles widened by ``reach`` spreads; the least spread of each
measure keeps sources of very even texts from rejecting harmless ones.

Sketches combine before the shuffle, so a hot source is a few thousand counts; the fences come back
by a lookup that broadcasts up to a measured size and salts hot keys beyond it.

Defined results: a null or empty text has no words and fails the base rule. Null languages and
sources are groups of their own. Repeated rows get one verdict. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.text import free_name, importable, text_bytes, words
from strata.operators.skew import lookup_join
from strata.session import stored

BITS = 6
FEWEST = 100
REACH = 3.0
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct", "n_upper")
STATS = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])

# Measure: numerator, factor, denominator, the tails that fail, least spread.
MEASURES = {
    "word_length": ("word_chars", 100, "n_words", "both", 50),
    "symbols": ("n_symbols", 1000, "n_words", "high", 50),
    "dup_lines": ("n_dup_lines", 1000, "n_lines", "high", 150),
    "repeats": ("n_repeat_words", 1000, "n_words", "high", 120),
    "distinct": ("n_distinct", 1000, "n_words", "low", 120),
    "upper": ("n_upper", 1000, "word_chars", "high", 60),
}


def counts_of(text: bytes) -> tuple[int, ...]:
    """The COUNTS of one text."""
    found = words(text)
    n = len(found)
    if not n:
        return (0,) * len(COUNTS)
    code = np.frombuffer(text, np.uint8)
    chars = len(text) - sum(map(text.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))) - int(((code & 0xC0) == 0x80).sum())
    lines = [line for line in text.split(b"\n") if line.strip()]
    number = {word: i for i, word in enumerate(dict.fromkeys(found))}
    ids = np.fromiter(map(number.__getitem__, found), np.int64, n)
    return (
        n, chars, len(text) - len(text.translate(None, SYMBOLS)), len(lines), len(lines) - len(set(lines)),
        repeated_words(ids, len(number)), len(number), int(((code >= 65) & (code <= 90)).sum()),
    )


def repeated_words(ids: np.ndarray, distinct: int) -> int:
    """Words inside a run of three words that occurs twice or more."""
    n = len(ids)
    if n < 3:
        return 0
    pair = ids[:-1] * distinct + ids[1:]
    if distinct >= 1 << 21:
        pair = np.unique(pair, return_inverse=True)[1]
    _, at, times = np.unique(pair[:-1] * distinct + ids[2:], return_inverse=True, return_counts=True)
    twice = times[at] > 1
    inside = np.zeros(n, bool)
    for shift in range(3):
        inside[shift : n - 2 + shift] |= twice
    return int(inside.sum())


@F.arrow_udf(STATS)
def text_counts(texts: pa.Array) -> pa.Array:
    rows = [counts_of(text) for text in texts.to_pylist()]
    columns = zip(*rows, strict=True) if rows else [()] * len(COUNTS)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], list(COUNTS))


def measure(name: str, stats: str) -> Column:
    above, factor, below, _, _ = MEASURES[name]
    top, bottom = F.col(f"{stats}.{above}"), F.col(f"{stats}.{below}")
    return F.when(bottom > 0, F.floor(top * factor / bottom)).otherwise(0).cast("long")


def leading_bits(value: Column) -> Column:
    cut = F.greatest(F.lit(0), F.length(F.bin(value)) - BITS)
    return F.call_function("shiftleft", F.call_function("shiftright", value, cut), cut)


def quartiles(sketch: DataFrame, group: list[str], name: str) -> DataFrame:
    """Quartiles and number of texts of each measure, from the sketches of a group merged."""
    merged = sketch.groupBy(*group, "measure", "value").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*group, "measure")
    ranked = merged.select(
        *group, "measure", "value",
        F.sum("n").over(whole.orderBy("value")).alias("upto"), F.sum("n").over(whole).alias("total"),
    )
    reached = [F.min(F.when(F.col("upto") * 4 >= F.col("total") * k, F.col("value"))).alias(f"q{k}") for k in (1, 3)]
    found = ranked.groupBy(*group, "measure").agg(*reached, F.first("total").alias("total"))
    return found.select(*group, "measure", F.struct("q1", "q3", "total").alias(name))


def fences(sketch: DataFrame, fewest: int, reach: float) -> DataFrame:
    """One row per language and source of ``sketch`` (lang, source, measure, value, n), with a struct
    of low and high for each measure, from the smallest group that has ``fewest`` texts."""
    own = quartiles(sketch, ["lang", "source"], "own")
    wider = quartiles(sketch, ["lang"], "wider")
    widest = quartiles(sketch, [], "widest")  # one row a measure
    chosen = own.join(wider, ["lang", "measure"]).join(F.broadcast(widest), "measure").select(
        "lang", "source", "measure",
        F.when(F.col("own.total") >= fewest, F.col("own"))
        .when(F.col("wider.total") >= fewest, F.col("wider"))
        .otherwise(F.col("widest")).alias("q"),
    )
    spread = F.col("q.q3") - F.col("q.q1")
    limits = []
    for name, (_, _, _, tails, least) in MEASURES.items():
        margin = F.greatest(spread, F.lit(least)) * reach
        limits.append(F.max(F.when(F.col("measure") == name, F.struct(
            (F.lit(None).cast("double") if tails == "high" else F.col("q.q1") - margin).alias("low"),
            (F.lit(None).cast("double") if tails == "low" else F.col("q.q3") + margin).alias("high"),
        ))).alias(name))
    return chosen.groupBy("lang", "source").agg(*limits)


def group_key(name: str) -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col(name)), F.lit("n"))


def sketch_of(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The sketches: lang and source keys, measure, value, n."""
    counted = importable(docs).select(
        group_key(lang).alias("lang"), group_key(source).alias("source"), text_counts(text_bytes(text)).alias("stats")
    )
    values = F.array(*[
        F.struct(F.lit(name).alias("measure"), leading_bits(measure(name, "stats")).alias("value")) for name in MEASURES
    ])
    return (
        counted.select("lang", "source", F.inline(values))
        .groupBy("lang", "source", "measure", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def judged(
    docs: DataFrame, fewest: int = FEWEST, reach: float = REACH, text: str = "text", lang: str = "lang",
    source: str = "source",
) -> tuple[DataFrame, str]:
    """``docs`` with one more column, a struct of the COUNTS, base_failed and kept; and its name."""
    limits = fences(stored(sketch_of(docs, text, lang, source), "sketch"), fewest, reach)
    keys = [free_name(docs, f"rule_{k}") for k in ("lang", "source")]
    named = {m: free_name(docs, f"rule_{m}") for m in MEASURES}
    verdict, stats = free_name(docs, "rule_verdict"), free_name(docs, "rule_stats")
    renamed = stored(limits.select(
        F.col("lang").alias(keys[0]), F.col("source").alias(keys[1]), *[F.col(m).alias(c) for m, c in named.items()]
    ), "fences")
    counted = docs.select(
        "*", group_key(lang).alias(keys[0]), group_key(source).alias(keys[1]), text_counts(text_bytes(text)).alias(stats)
    )
    found = lookup_join(counted, renamed, [(k, k) for k in keys], list(named.values()))
    words_, repeats = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    base = (words_ < 50) | (repeats * 100 > words_ * 50)
    inside = F.lit(True)
    for name, column in named.items():
        value = measure(name, stats)
        inside = inside & F.coalesce(value >= F.col(f"{column}.low"), F.lit(True))
        inside = inside & F.coalesce(value <= F.col(f"{column}.high"), F.lit(True))
    row = F.struct(*[F.col(f"{stats}.{c}").alias(c) for c in COUNTS], base.alias("base_failed"), (~base & inside).alias("kept"))
    return found.select(*docs.columns, row.alias(verdict)), verdict


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep."""
    rows, verdict = judged(docs, **options)
    return rows.where(F.col(f"{verdict}.kept")).select(*docs.columns)
