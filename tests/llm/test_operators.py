"""The text operators against brute force, on odd rows, empty tables and the smallest shared tables."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import bpe, exact_dedup, mixing, ngram_join, passages, pii, quality_fm, quality_rules, sharding, token_files
from strata.llm.queries import QUERIES, RANKS
from strata.session import scratch_path

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def by_id(spark, name):
    return {r.doc_id: r for r in QUERIES[name](spark, SMALL).collect()}


def test_mix_reaches_targets_and_stays_within_caps(spark, texts):
    found = by_id(spark, "op1_mixing")
    sizes = {i: len(WORD.findall((t or "").encode())) for i, t in texts.items()}
    assert {i: r.size for i, r in found.items()} == sizes
    assert all(r.taken in (0, r.size, 2 * r.size) for r in found.values())
    assert abs(sum({(r.source_size, r.target): r.target for r in found.values()}.values()) / sum(sizes.values()) - 1.5) < 1e-9
    assert by_id(spark, "op1_mixing") == found


@pytest.mark.parametrize("sizes", [[5, 50, 500, 5], [1, 1, 1], [1000, 1, 1, 1, 1], [0, 7]])
def test_targets_equal_repeated_resharing(spark, sizes):
    rows = [(f"s{i}", f"{i}", s) for i, s in enumerate(sizes)]
    found = mixing.source_targets(spark.createDataFrame(rows, "key string, source string, source_size long"), (3, 1, 2), 1.5, 2.0)
    weight, fixed = [(3, 1, 2)[i % 3] for i in range(len(sizes))], {}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        left = 1.5 * sum(sizes) - sum(fixed.values())
        target = fixed | {i: left * weight[i] / sum(weight[k] for k in free) for i in free}
        over = [i for i in free if target[i] > 2 * sizes[i]]
        if not over:
            break
        fixed |= {i: 2.0 * sizes[i] for i in over}
    assert {r.key: r.target for r in found.collect()} == pytest.approx({f"s{i}": t for i, t in target.items()})


def test_base_measures(spark, texts):
    found = by_id(spark, "op2_quality_rules")
    for i, text in texts.items():
        data = (text or "").encode()
        w = WORD.findall(data)
        lines = [x for x in data.split(b"\n") if WORD.search(x)]
        times, inside = Counter(zip(w, w[1:], w[2:])), set()
        for k, run in enumerate(zip(w, w[1:], w[2:])):
            inside |= {k, k + 1, k + 2} if times[run] > 1 else set()
        r = found[i]
        assert (r.n_words, r.word_chars) == (len(w), sum(len(x.decode()) for x in w))
        assert (r.n_symbols, r.n_dup_lines) == (len(re.findall(rb"[#*$%&|<>]", data)), len(lines) - len(set(lines)))
        assert r.n_repeat_words == len(inside) and r.base_failed == (len(w) < 50 or 100 * len(inside) > 50 * len(w))
        assert not (r.base_failed and r.kept)


def test_classifier_on_held_out_rows(spark):
    found = by_id(spark, "op3_quality_fm")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    held = [i for i in labels if found[i].held_out]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in found.items())
    assert sum(found[i].predicted == labels[i] for i in held) >= 0.8 * len(held)


def test_interactions_by_sums_equal_pairs():
    rng = np.random.default_rng(1)
    model = quality_fm.Machine(0.1, rng.normal(size=9), rng.normal(size=(9, 3)))
    slots, values = np.array([0, 3, 4, 8]), rng.normal(size=4)
    pairs = sum(values[a] * values[b] * model.factors[slots[a]] @ model.factors[slots[b]] for a in range(4) for b in range(a))
    raw = 0.1 + values @ model.linear[slots] + pairs
    assert model.score(slots, values) == pytest.approx(1 / (1 + np.exp(-raw)))


def test_passages_find_exact_and_near_copies(spark):
    line = [f"word{i}" for i in range(60)]
    near = [*line[:30], "other", *line[31:]]
    rows = [(i, f"own{i} " * 3 + f"start {i}\n" + " ".join(near if i % 3 else line) + f"\nend {i} here") for i in range(9)]
    rows += [(90, " ".join(f"lone{i}" for i in range(80))), (91, None), (None, "")]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in found) == list(range(9))
    assert [r.doc_id for r in found if not r.removed] == [0]
    assert len({r.cluster for r in found}) == 1 and {r.n_words for r in found} == {60}


def shared_runs(texts, size=51):
    """The places of words that stand in a run of ``size`` words that another text has as well."""
    split = {i: [w.lower() for w in WORD.findall((t or "").encode())] for i, t in texts.items()}
    where = defaultdict(set)
    for i, found in split.items():
        for k in range(len(found) - size + 1):
            where[tuple(found[k : k + size])].add((i, k))
    inside = defaultdict(set)
    for places in where.values():
        if len({i for i, _ in places}) > 1:
            for i, k in places:
                inside[i].update(range(k, k + size))
    return inside


def words_within(text, spans):
    """The places of the words of ``text`` that stand within one of ``spans`` of code points."""
    at = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text or "")]
    return {k for k, (a, b) in enumerate(at) if any(s <= a and b <= e for s, e in spans)}


def test_passages_inside_longer_lines(spark):
    def own(i, n):
        return " ".join(f"é{i}_{k}" for k in range(n))

    shared = [f"Word{k}" for k in range(70)]
    rows = [(1, f"{own(1, 200)} {' '.join(shared)} {own(11, 300)}"), (2, f"{own(2, 9)} {' '.join(shared).upper()} {own(12, 9)}"),
            (3, f"{own(3, 40)} {' '.join(shared[:30])}\n{' '.join(shared[30:])} {own(13, 40)}\n{own(23, 7)}"),
            (6, f"{' '.join(shared[:48])}\nWord48 word49 word50 {own(6, 30)}"),
            (4, f"{own(4, 40)} {' '.join(shared[:50])} {own(14, 40)}"), (5, own(5, 400))]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.n_words, r.removed) for r in found} == {(1, 70, False), (2, 70, True), (3, 70, True), (6, 51, True)}
    assert len(found) == 4 and len({r.cluster for r in found}) == 1
    for r in found:
        assert " ".join(dict(rows)[r.doc_id][r.start : r.end].split()).lower() == " ".join(shared[: r.n_words]).lower()


def test_passages_are_judged_by_their_parts(spark):
    def line(name, n=30):
        return " ".join(f"{name}{k}" for k in range(n))

    rows = [(1, "\n".join([line("a"), line("b")])), (2, "\n".join([line("a"), line("b"), line("c"), line("d")])),
            (3, "\n".join([line("own3"), line("c"), line("d")])), (4, "\n".join([line("d"), line("own4"), line("a")]))]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    text = dict(rows)
    assert {(r.doc_id, text[r.doc_id][r.start : r.end].split("\n")[0][:2], r.n_words, r.removed) for r in found} == {
        (1, "a0", 60, False), (2, "a0", 60, True), (2, "c0", 60, False), (3, "c0", 60, True)}
    assert len(found) == 4 and len({r.cluster for r in found}) == 2


def test_passages_of_short_lines(spark):
    menu = [f"dish{k} price{k}" for k in range(45)]
    other = [*menu[:22], "dish22 none", *menu[23:]]
    long = [" ".join(f"{name}{k}" for k in range(n)) for name, n in (("a", 25), ("b", 24))]
    rows = [(1, "own1 text that stands before it\n" + "\n".join(menu)), (2, "\n".join(other) + "\nown2 text that stands after it"),
            (3, f"own3 line\n{long[0]}\none two\n{long[1]}"), (4, f"{long[0]}\none 2\n{long[1]}\nown4 line")]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.n_words, r.removed) for r in found} == {(1, 90, False), (2, 90, True), (3, 27, False), (3, 24, False), (4, 27, True), (4, 24, True)}


def test_passages_hold_all_shared_runs(spark, texts):
    found = defaultdict(list)
    for r in QUERIES["op4_passages"](spark, SMALL).collect():
        found[r.doc_id].append((r.start, r.end))
    for i, inside in shared_runs(texts).items():
        missed = inside - words_within(texts[i], found[i])
        assert all(not missed.issuperset(range(k, k + passages.LEAST_WORDS)) for k in missed), i


def test_token_files_round_trip(spark, texts):
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found, start = by_id(spark, "op5_token_files"), 0
    for i in sorted(texts):
        ids = np.array([*known.encode(texts[i] or "", add_special_tokens=False).ids, 0], "<u4")
        assert (found[i].start, found[i].n_tokens, found[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab1.,'é  \n\t\x1c", max_size=60))
def test_words_give_the_ids_of_the_text(text):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert token_files.encoder_of(path)(text, 0).tolist() == [*whole, 0]


@pytest.mark.parametrize("text", ["<|endoftext|>", "a b<|endoftext|> c d", "x <|endoftext|>\n y", "<|endoftext", "<|endoftext|><|endoftext|> z"])
def test_special_tokens_are_those_of_the_library(text):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert token_files.encoder_of(path)(text, 0).tolist() == [*whole, 0]
    assert ("|>" in text) == (50256 in whole)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab1.,'é  \n\t", max_size=80))
def test_pieces_give_the_ids_of_the_text(text):
    known = bpe.encoding(public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    assert [i for p in bpe.pieces(text, 8) for i in known.encode_ordinary(p)] == known.encode_ordinary(text)


def test_bpe_digests(spark, texts):
    import tiktoken

    with open(public_tokenizers.path(RANKS), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i, r in by_id(spark, "op10_bpe").items():
        ids = known.encode_ordinary(texts[i] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((texts[i] or "").encode()).hexdigest()


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab1.@- ", max_size=30))
def test_addresses_equal_the_pattern(text):
    assert [s[:2] for s in pii.emails(text)] == [m.span() for m in EMAIL.finditer(text)]


def test_personal_data(spark):
    usual = [(i, f"call me at +1 (375) 555-4{100 + i} or a{i}@b.example.com from 10.1.2.{i} ok\nthen 4207051279108084 ends") for i in range(60)]
    odd = [(100, "dial (375) 555-4393 now"), (101, "nothing 12 of 1999 here"), (102, None), (103, "4" * 5000)]
    docs = spark.createDataFrame(usual + odd, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find(docs, pii.train(docs)).collect()}
    assert [b.split(":")[0] for b in found[5].base] == ["phone", "email", "ip", "card"]
    assert found[100].base == [] and found[100].spans == "phone:5:19"
    assert [found[i].spans for i in (101, 102, 103)] == ["", "", ""]


@pytest.fixture(scope="module")
def half_field(spark):
    """A field that saw the documents of even ids only."""
    return pii.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").where("doc_id % 2 = 0"))


def test_dense_lines_are_read_whole(half_field):
    """Sixty numbers without a country code on one line."""
    line = ", ".join(f"({200 + i}) 555-{1000 + 7 * i}" for i in range(60))
    assert [line[s:e] for s, e, _ in pii.all_spans(line, half_field)[1]] == line.split(", ")


@pytest.mark.parametrize("text", ["lists 1 2 3 4 5 6 7 8", "on 2024-01-02 and 12.05.2021 10:22:33", "pages 12, 13, 14, 15", "in 1999, 2001", "v 1.2.3", "sum 1,234,567.89"])
def test_other_numbers_are_left_alone(half_field, text):
    assert pii.all_spans(text, half_field)[1] == []


def slow_base_spans(text):
    """The contract's patterns as they are written, by backtracking."""
    found = [(m.start(), m.end(), "email") for m in EMAIL.finditer(text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        twice = [d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9) for k, d in enumerate(reversed(digits))]
        if 14 <= len(digits) <= 19 and sum(twice) % 10 == 0:
            found.append((m.start(), m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], pii.KINDS.index(s[2])))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["4207051279108084", "4207 0512 7910 8084", "10.1.2.3", "256.1", ".9", "+1", " ", "(", ")-", "555", "0100", "@", "b.c", "é", "\n"]), max_size=9).map("".join))
def test_base_spans_equal_the_patterns(text):
    assert pii.base_spans(text) == slow_base_spans(text)


def test_rewritten_spans_of_held_out_texts_are_found(spark, half_field):
    """At least nine of ten spans of each kind, written as the base patterns don't match, in texts the field never saw."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = docs.where("text rlike '[0-9@]' and doc_id % 2 = 1").collect()
    found, total = recall(half_field, [r.text for r in rows])
    assert total and all(found[k] >= 0.9 * total[k] for k in total), (found, total)


def recall(field, texts):
    found, total = Counter(), Counter()
    for text in texts:
        for start, end, kind in pii.base_spans(text):
            for other in pii.variants(text[start:end], kind):
                low, high = text.rfind("\n", 0, start) + 1, (text + "\n").find("\n", end)
                changed, at = text[low:start] + other + text[end:high], start - low
                if any(s < at + len(other) and at < e for s, e, _ in pii.base_spans(changed)):
                    continue
                total[kind] += 1
                found[kind] += (at, at + len(other), kind) in pii.all_spans(changed, field)[1]
    return found, total


def test_recipes_tell_texts_apart_whatever_the_hash(spark, odd_docs):
    weak = lambda chunk: bytes([len(chunk) % 2])
    for hashes in ((exact_dedup.narrow, exact_dedup.wide), (weak, exact_dedup.wide)):
        found = exact_dedup.equal_texts(odd_docs, hashes=hashes).collect()
        groups = defaultdict(list)
        for r in odd_docs.collect():
            groups[hashlib.sha256((r.text or "").encode().lower()).hexdigest()].append(r.doc_id)
        assert len(found) == sum(map(len, groups.values()))
        for r in found:
            ids = groups[r.text_sha256]
            assert r.group_size == len(ids) and r.keep_id == max((i for i in ids if i is not None), default=None)
    kept = exact_dedup.drop_equal(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == len(groups)


def brute_components(rows, width, percent):
    sets = [frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()
            for w in (WORD.findall((t or "").encode().lower()) for _, t in rows)]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        least[find(k)].append(i)
    return [(i, len(sets[k]), min((x for x in least[find(k)] if x is not None), default=None)) for k, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("pairs", [ngram_join.PAIRS, 0])
def test_components_equal_brute_force(spark, rows, monkeypatch, pairs):
    """With no pairs allowed every frequent content is costly, so one-deletion segments have to find all."""
    monkeypatch.setattr(ngram_join, "PAIRS", pairs)
    rng = np.random.default_rng(3)
    docs, common = [], [f"c{i}" for i in range(25)]
    for i in range(150):
        kind = i % 5
        if kind < 2 and docs:
            w = docs[int(rng.integers(len(docs)))][1].split()
            for _ in range(int(rng.integers(0, 4))):
                w[int(rng.integers(len(w)))] = f"e{rng.integers(1000)}"
        else:
            w = [f"w{rng.integers(5000)}" for _ in range(int(rng.integers(1, 90)))] + (common if kind == 2 else [])
        docs.append((i, " ".join(w)))
    docs += [(900, None), (901, " "), (None, docs[3][1]), (3, docs[3][1])]
    found = ngram_join.near_classes(spark.createDataFrame(docs, "doc_id long, text string"))
    assert rows(found, "doc_id", "n_shingles", "component_id") == sorted(brute_components(docs, 4, 85), key=repr)


@settings(max_examples=150, deadline=None)
@given(st.integers(6, 400), st.integers(0, 40), st.integers(0, 2**31))
def test_similar_sets_share_a_key(size, change, seed):
    rng, bands = np.random.default_rng(seed), ngram_join.Bands()
    x = np.unique(rng.integers(0, 2**63, size + change, dtype=np.uint64))
    y = x[rng.permutation(len(x))[: size]]
    y.sort()
    if 100 * len(y) < 85 * len(x):
        return
    kinds = [[{int(k) for made, kind in ngram_join.set_keys(s, bands) if kind == which for k in made} for which in (0, 1)]
             for s in (x, y)]
    (whole, short), (other, shorter) = kinds
    assert len(x) == len(y) or whole & other or whole & shorter or short & other


@settings(max_examples=150, deadline=None)
@given(st.integers(30, 400), st.integers(0, 60), st.integers(0, 2**31), st.floats(0, 0.6), st.sampled_from([80, 85]))
def test_hard_sets_meet_by_one_of_three_cuts(size, change, seed, share, percent):
    """Whatever contents are costly, two similar sets share a key that neither leaves out, in the first cut, the second or the third."""
    rng, bands = np.random.default_rng(seed), ngram_join.Bands(percent)
    x = np.unique(rng.integers(0, 2**63, size + change, dtype=np.uint64))
    y = np.sort(x[rng.permutation(len(x))[:size]])
    if 100 * len(y) < percent * len(x) or len(x) == len(y):
        return
    first = [list(ngram_join.set_keys(s, bands)) for s in (x, y)]

    def some(made):
        return {k for keys, kind in made if kind == 0 for k in keys.view(np.int64).tolist() if k % 4 // 2 == 0 and rng.random() < share}

    costly = some(first[0]) | some(first[1])
    spoiled = [cut.found[out[cut.owner]] for s in (x, y) for _, cut, _, _, out in ngram_join.hard_cuts(s, bands, costly)]
    common = np.unique(np.concatenate([*spoiled, np.array([], np.uint64)]))
    second = [list(ngram_join.hard_keys(s, bands, costly, np.intersect1d(common, s))) for s in (x, y)]
    again = some(second[0]) | some(second[1])
    third = [list(ngram_join.hard_keys(s, bands, costly, np.intersect1d(common, s), again)) for s in (x, y)]

    def meet(made, without):
        one, two = ({(k, kind) for keys, kind in m for k in keys.view(np.int64).tolist() if k not in without} for m in made)
        return any((k, other) in two and ngram_join.met(kind, other) for k, kind in one for other in (0, 1, 2))

    assert meet(first, costly) or meet(second, again) or meet(third, ())


@pytest.mark.parametrize("percent, width, pairs", [(85, 4, 2), (80, 5, 2), (80, 5, 0)])
def test_texts_with_passages_of_many_texts_equal_brute_force(spark, rows, monkeypatch, percent, width, pairs):
    monkeypatch.setattr(ngram_join, "PAIRS", pairs)
    rng = np.random.default_rng(11)
    passages = [[f"p{k}_{i}" for i in range(60)] for k in range(3)]
    docs = []
    for i in range(160):
        if i % 4 == 3:
            w = docs[int(rng.integers(len(docs)))][1].split()
            for _ in range(int(rng.integers(0, 5))):
                w[int(rng.integers(len(w)))] = f"e{rng.integers(1000)}"
        else:
            w = [f"w{rng.integers(9000)}" for _ in range(int(rng.integers(5, 120)))]
            for k in range(i % 3 + 1):
                w += passages[k]
        docs.append((i, " ".join(w)))
    found = ngram_join.near_classes(spark.createDataFrame(docs, "doc_id long, text string"), width=width, percent=percent)
    assert rows(found, "doc_id", "n_shingles", "component_id") == sorted(brute_components(docs, width, percent), key=repr)


def test_differencing_beats_dealing():
    sizes = [int(s) for s in np.random.default_rng(2).pareto(1.5, 3000) * 1000 + 1]
    part = sharding.differencing(sizes, 16)
    loads = np.bincount(part, sizes, 16)
    assert loads.max() - loads.min() <= max(1, max(sizes) - sum(sizes) // 16, 50)


def test_shards_hold_groups_and_gapless_slots(spark, odd_docs):
    found = sharding.shard(odd_docs, shards=4).collect()
    texts = {(r.doc_id, zlib.crc32((r.text or "").encode())) for r in odd_docs.collect()}
    assert {(r.doc_id, r.text_crc32) for r in found} == texts
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    ranks, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    for docs in (odd_docs, no_docs):
        n = docs.count()
        assert mixing.mixing_plan(docs)[0].count() == n and mixing.mix(docs).columns == docs.columns
        assert quality_rules.judged(docs)[0].count() == n and quality_rules.keep_good(docs).columns == docs.columns
        assert ngram_join.near_classes(docs).count() == n and sharding.shard(docs).count() == n
        assert ngram_join.keep_first(docs).columns == docs.columns
        assert bpe.digests(docs, ranks, pattern).count() == n
        labels = spark.createDataFrame([(5, 1), (None, 0), (7, None)], "doc_id long, quality int")
        assert quality_fm.scored(docs, quality_fm.learn(docs, labels)).count() == n
        assert pii.find(docs, pii.train(docs)).count() == n
        passages.repeated_passages(docs).count()
        path = scratch_path(spark, "tokens")
        token_files.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"), 0)
        assert token_files.read_tokens(spark, path).count() == n
    kept = ngram_join.keep_first(odd_docs)
    brute = brute_components([(r.doc_id, r.text) for r in odd_docs.collect()], 4, 85)
    assert kept.where("text rlike '[a-zA-Z]'").count() == len({c for i, n, c in brute if n})


def test_pipeline_stages(spark, odd_docs):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SMALL)
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= ids and now, name
        assert name == "bpe" or docs.columns == before.columns, name
        ids = now
