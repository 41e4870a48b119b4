"""A factorisation machine that scores the quality of whole texts.

A text's features are its distinct words, hashed, with weights that make them of unit length, and
one-hot bins of structure statistics and of its length as metadata. The score of features x is

    sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]),

so the pairwise interactions of all features cost time linear in their number. The parameters are
learnt by AdaGrad from at most ``SAMPLE`` labelled rows, chosen by a hash of their id; rows held out
are never among them. The model is a few megabytes whatever the data, and is broadcast; each text is
scored by itself, so no key can be hot and a lost task scores its rows again.

Defined results: a null or empty text has the bins of zero words and gets their score. Without
labelled rows of both kinds every score is the share of good ones, or 0.5. Labels without a quality
or a document are left out. Repeated rows get the same score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.quality_rules import counts_of
from strata.llm.text import WordHashes, map_rows, text_bytes, words

SAMPLE = 8000
WORD_SLOTS = 1 << 16
RANK = 8
EPOCHS = 6
BATCH = 64
RATE = 0.08
DECAY = 1e-4
SEED = 11
BINS = 24
PER_MILLE = (("n_symbols", "n_words"), ("n_dup_lines", "n_lines"), ("n_repeat_words", "n_words"),
             ("n_distinct", "n_words"), ("n_upper", "word_chars"))
POSITIONS = {"n_words": 0, "word_chars": 1, "n_symbols": 2, "n_lines": 3, "n_dup_lines": 4, "n_repeat_words": 5,
             "n_distinct": 6, "n_upper": 7}
SLOTS = WORD_SLOTS + BINS * (len(PER_MILLE) + 4)


def held_out(id: Column) -> Column:
    return F.crc32(id.cast("string")) % 4 == 2


def features(text: bytes, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of the features of one text."""
    counts = counts_of(text)
    distinct = list(set(words(text)))
    slots, times = np.unique(hashes(distinct) % np.uint64(WORD_SLOTS), return_counts=True)
    values = times / max(1.0, float(np.sqrt((times * times).sum())))
    bins = []
    for above, below in PER_MILLE:
        share = counts[POSITIONS[above]] / max(1, counts[POSITIONS[below]])
        bins.append(min(BINS - 1, int(np.sqrt(share) * 20)))
    n, chars = counts[0], counts[1]
    bins += [min(BINS - 1, n.bit_length()), min(BINS - 1, int(2 * chars / max(1, n))),
             min(BINS - 1, counts[3].bit_length()), min(BINS - 1, len(text).bit_length())]
    own = WORD_SLOTS + np.arange(len(bins)) * BINS + np.array(bins)
    return np.r_[slots.astype(np.int64), own], np.r_[values, np.ones(len(bins))].astype(np.float32)


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def score(self, slots: np.ndarray, values: np.ndarray) -> float:
        held = self.factors[slots]
        sums, squares = values @ held, (values * values) @ (held * held)
        raw = self.bias + float(values @ self.linear[slots]) + 0.5 * float((sums * sums - squares).sum())
        return float(1 / (1 + np.exp(-np.clip(raw, -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Machine:
    """The machine of these features and labels, in rounds over batches in a seeded order."""
    rng = np.random.default_rng(SEED)
    share = float(labels.mean()) if len(labels) else 0.5
    bias = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    model = Machine(bias, np.zeros(SLOTS, np.float32), rng.normal(0, 0.02, (SLOTS, RANK)).astype(np.float32))
    if not 0 < share < 1:
        model.factors[:] = 0
        return model
    seen_linear, seen_factors, seen_bias = np.full(SLOTS, 1e-4, np.float32), np.full((SLOTS, RANK), 1e-4, np.float32), 1e-4
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), BATCH):
            chosen = order[start : start + BATCH]
            slots = np.concatenate([rows[i][0] for i in chosen])
            values = np.concatenate([rows[i][1] for i in chosen])
            begins = np.cumsum([0, *[len(rows[i][0]) for i in chosen]])
            row = np.repeat(np.arange(len(chosen)), np.diff(begins))
            held = model.factors[slots]
            weighted = held * values[:, None]
            sums = np.add.reduceat(weighted, begins[:-1])
            raw = (
                model.bias + np.add.reduceat(values * model.linear[slots], begins[:-1])
                + 0.5 * (sums * sums - np.add.reduceat(weighted * weighted, begins[:-1])).sum(1)
            )
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[chosen]) / len(chosen)
            pull = (error[row] * values).astype(np.float32)
            at, where = np.unique(slots, return_inverse=True)
            linear = np.bincount(where, pull, len(at)).astype(np.float32) + DECAY * model.linear[at]
            steps = pull[:, None] * (sums[row] - weighted)
            factors = np.stack([np.bincount(where, steps[:, f], len(at)) for f in range(RANK)], 1) + DECAY * model.factors[at]
            seen_linear[at] += linear * linear
            seen_factors[at] += factors * factors
            seen_bias += float(error.sum()) ** 2
            model.linear[at] -= RATE * linear / np.sqrt(seen_linear[at])
            model.factors[at] -= RATE * 0.5 * factors / np.sqrt(seen_factors[at])
            model.bias -= RATE * float(error.sum()) / np.sqrt(seen_bias)
    return model


def learn(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Machine:
    """Fit on at most ``sample`` rows that are labelled and not held out, chosen by a hash of their ids.

    Repeated documents and labels count as often as they come, within the same bound.
    """
    known = labels.select(F.col(id).alias("doc_id"), F.col("quality").cast("double").alias("quality"))
    known = known.where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id", "quality").limit(sample)  # the documented bound

    def work():
        hashes = WordHashes()
        return lambda key, quality, data: (key, quality, *features(data, hashes))

    texts = docs.select(F.col(id).alias("doc_id"), text_bytes(text).alias("data"))
    chosen = texts.join(F.broadcast(known), "doc_id").select("doc_id", "quality", "data")
    made = map_rows(chosen, "doc_id bigint, quality double, slots array<bigint>, vals array<float>", work)
    turn = [F.xxhash64(F.lit(SEED), "doc_id"), "doc_id", "quality", F.xxhash64("slots")]
    found = made.orderBy(*turn).limit(sample).orderBy(*turn[1:]).toArrow()
    rows = [(np.array(s, np.int64), np.array(v, np.float32)) for s, v in zip(
        found["slots"].to_pylist(), found["vals"].to_pylist(), strict=True)]
    return fit(rows, np.array(found["quality"].to_pylist(), np.float64))


def scored(docs: DataFrame, model: Machine, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work():
        hashes, machine = WordHashes(), shared.value
        return lambda key, data: (key, machine.score(*features(data, hashes)))

    return map_rows(docs.select(id, text_bytes(text)), f"`{id}` bigint, score double", work)
