"""What single operators and the stages of the pipeline return, row by row, against plain Python."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from strata.llm import bpe, mixing, quality_fm, sharding
from strata.llm.queries import QUERIES, RANKS

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def rows(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "source").collect()


def size_of(text):
    return len(WORD.findall((text or "").encode()))


def expected_targets(rows):
    """Targets of the sources, by resharing what the capped ones leave until none is above its cap."""
    sizes = Counter()
    for r in rows:
        sizes[r.source] += size_of(r.text)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, fixed = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}, {}
    while True:
        free = [s for s in names if s not in fixed]
        left = 1.5 * sum(sizes.values()) - sum(fixed.values())
        target = fixed | {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if target[s] > 2 * sizes[s]]
        if not over:
            return sizes, target
        fixed |= {s: 2.0 * sizes[s] for s in over}


def assert_mixed(rows, taken):
    """``taken`` words of each row are whole copies, as many as its source's rate says, and near the targets in sum."""
    sizes, target = expected_targets(rows)
    by_source, spread = Counter(), Counter()
    for r, words in zip(rows, taken, strict=True):
        rate, size = target[r.source] / sizes[r.source] if sizes[r.source] else 0.0, size_of(r.text)
        whole = math.floor(rate + 1e-9)
        assert not size or words in (whole * size, (whole + 1) * size)
        by_source[r.source] += words
        spread[r.source] += size * size * (rate - whole) * (1 - rate + whole)
    for s in sizes:
        assert abs(by_source[s] - target[s]) <= 4 * math.sqrt(max(0.0, spread[s])) + 1


def test_mix_takes_whole_copies_near_the_targets_of_ordered_sources(spark, rows):
    found = {r.doc_id: r for r in QUERIES["op1_mixing"](spark, SMALL).collect()}
    sizes, target = expected_targets(rows)
    assert {r.doc_id: found[r.doc_id].target for r in rows} == pytest.approx({r.doc_id: target[r.source] for r in rows})
    assert all(found[r.doc_id].source_size == sizes[r.source] for r in rows)
    assert_mixed(rows, [found[r.doc_id].taken for r in rows])


def test_mix_of_odd_rows(spark, odd_docs):
    plan, name = mixing.mixing_plan(odd_docs)
    found = plan.select("doc_id", "text", "source", f"{name}.*").collect()
    assert len(found) == odd_docs.count()
    assert_mixed(found, [r["size"] * r["copies"] for r in found])
    copies = defaultdict(set)
    for r in found:
        copies[r.doc_id, r.text, r.source].add(r["copies"])
    assert all(len(c) == 1 for c in copies.values()), "repeated rows are copied alike"


def assert_sharded(found, texts, shards):
    """Texts that are equal share a shard (a null is no text), slots are gapless, and bytes are as near as the largest group allows."""
    where, bytes_of, slots, groups = defaultdict(set), Counter(), defaultdict(list), Counter()
    for r, text in zip(found, texts, strict=True):
        data = (text or "").encode()
        assert r["size"] == len(data) + 1
        where[text].add(r["shard"])
        bytes_of[r["shard"]] += r["size"]
        groups[text] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(len(s) == 1 for s in where.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    loads = [bytes_of[k] for k in range(shards)]
    assert max(loads) - min(loads) <= max(groups.values())


def test_shards_of_all_documents(spark, rows):
    text = {r.doc_id: r.text for r in rows}
    found = QUERIES["op9_sharding"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in found) == sorted(text)
    assert_sharded(found, [text[r.doc_id] for r in found], 16)


def test_shards_of_copies_and_a_hot_text(spark):
    texts = ["same text " * 20] * 40 + [f"text {i} " * (i % 7 + 1) for i in range(300)] + [None, "", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = sharding.shard(docs, 4).collect()
    assert_sharded(found, [texts[r.doc_id] for r in found], 4)


def test_classifier_keeps_its_bound_and_ignores_held_out_labels(spark):
    docs = spark.createDataFrame([(i % 40, f"{'good' if i % 2 else 'bad'} words {i % 40} here") for i in range(400)], "doc_id long, text string")
    labels = spark.range(40).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    held = quality_fm.held_out(F.col("doc_id"))
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    seen = []
    fit, quality_fm.fit = quality_fm.fit, lambda rows, found: seen.append(len(rows)) or fit(rows, found)
    try:
        one, two = quality_fm.learn(docs, labels, sample=50), quality_fm.learn(docs, flipped, sample=50)
    finally:
        quality_fm.fit = fit
    assert seen == [50, 50] and one.bias == two.bias and (one.linear == two.linear).all()


def components(rows, width, percent):
    """The number of each text's component, by comparing all pairs of shingle sets."""
    sets = []
    for r in rows:
        found = WORD.findall((r.text or "").encode().lower())
        sets.append({tuple(found[k : k + width]) for k in range(max(1, len(found) - width + 1))} if found else set())
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for k in range(i):
            both = len(x & sets[k])
            if both and 100 * both >= percent * (len(x) + len(sets[k]) - both):
                root[top(i)] = top(k)
    return [top(i) for i in range(len(rows))]


@pytest.mark.parametrize("table", ["small", "odd"])
def test_each_stage_of_the_pipeline(spark, odd_docs, table):
    """Every stage's rows follow from those of the stage before; copies, near copies and ties are planted."""
    import corpus_pipeline

    stage = dict(corpus_pipeline.STAGES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "ngram_join", "mixing", "bpe"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet") if table == "small" else odd_docs
    good = docs if table == "odd" else stage["quality_rules"](spark, docs, SMALL)
    if table == "small":
        verdict = {r.doc_id for r in QUERIES["op2_quality_rules"](spark, SMALL).where("kept").collect()}
        assert sorted(r.doc_id for r in good.collect()) == sorted(verdict)
        more = good.where("doc_id % 3 = 0").withColumn("doc_id", F.col("doc_id") + 100_000)
        near = good.where("doc_id % 5 = 0").withColumns({"doc_id": F.col("doc_id") + 200_000, "text": F.concat("text", F.lit(" one more"))})
        good = good.union(more).union(near.select(good.columns))
    one = stage["exact_dedup"](spark, good, SMALL)
    before, kept = good.collect(), one.collect()
    best = {}
    for r in before:
        key = (r.text or "").encode().lower()
        best[key] = max(best.get(key, -1), -1 if r.doc_id is None else r.doc_id)
    assert Counter((r.text or "").encode().lower() for r in kept) == Counter(list(best))
    assert all(best[(r.text or "").encode().lower()] == (-1 if r.doc_id is None else r.doc_id) for r in kept)
    two = stage["ngram_join"](spark, one, SMALL)
    groups = defaultdict(list)
    for r, c in zip(kept, components(kept, 5, 80), strict=True):
        groups[c].append(math.inf if r.doc_id is None else r.doc_id)
    left = two.collect()
    assert sorted(math.inf if r.doc_id is None else r.doc_id for r in left) == sorted(min(g) for g in groups.values())
    assert table == "odd" or len(left) < len(kept) < len(before)
    three = stage["mixing"](spark, two, SMALL)
    times = Counter((r.doc_id, r.text) for r in three.collect())
    assert set(times) <= {(r.doc_id, r.text) for r in left}
    assert_mixed(left, [times[r.doc_id, r.text] * size_of(r.text) for r in left])
    assert one.columns == two.columns == three.columns == docs.columns
    last = stage["bpe"](spark, three, SMALL).collect()
    known = bpe.encoding(public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    assert isinstance(known, tiktoken.Encoding)
    text, counted = {r.doc_id: r.text or "" for r in left}, Counter(r.doc_id for r in last)
    assert counted == Counter({i: n for (i, _), n in times.items() if n})
    for r in last:
        ids = known.encode_ordinary(text[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
