"""Spelling variants, fill-in-middle and repeated substrings against brute force, on odd rows and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import fill_in_middle, spelling, substrings
from strata.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


# Spelling variants


def near_by_force(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def variants_by_force(counts):
    near = {w: [o for o in counts if near_by_force(w, o)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best and counts[best] >= 10 * counts[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (n, len(near[w]), form[w], counts.get(form[w]), root(w)) for w, n in counts.items()}


def collected(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


@given(st.text("abé", max_size=9), st.text("abé", max_size=9))
@settings(max_examples=300, deadline=None)
def test_one_apart(a, b):
    short, long = sorted((a, b), key=len)
    if len(long) - len(short) <= 1:
        assert spelling.one_apart(short, long) == near_by_force(a, b)


@pytest.mark.parametrize("limits", [{}, {"subtree": 3, "nodes": 10_000}, {"subtree": 3, "nodes": 10_000, "searches": 4}])
def test_variants_at_every_cut(spark, limits):
    """The same pairs whether the trie is one group or cut down to full paths, pieces and salted searches."""
    rng = random.Random(5)
    base = ["".join(rng.choices("abceé", k=rng.randint(1, 9))) for _ in range(60)]
    words = {w for b in base for w in (b, b[1:], b + "e", b[:2] + "b" + b[3:], b[::-1], "".join(sorted(b)))} - {""}
    words |= {"cf" * k + "fc" * (4 - k) for k in range(5)} | {"fcfcfcfc", "ccffccff", "ffccffcc", "漢字漢字漢字漢", "漢字漢字漢字", "漢字漢字字字漢"}
    words |= {"x" * 3000, "x" * 1500 + "y" + "x" * 1499, "x" * 3001}
    counts = {w: 10 ** rng.randint(0, 4) for w in sorted(words)}
    counts |= {"chainaaa": 100_000, "chainaab": 9_000, "chainabb": 900, "chainbbb": 80}
    found = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long"), **limits)
    assert collected(found) == variants_by_force(counts)
    assert collected(found)["chainbbb"][4] == "chainaaa"


def words_by_force(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def test_words_of_documents(spark, texts):
    found = QUERIES["op11_spelling"](spark, SMALL)
    assert {r.word: r.n for r in found.collect()} == words_by_force(texts)


def test_spelling_of_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    counts = words_by_force(rows)
    assert counts["epsilon"] > 1 and collected(spelling.variants(spelling.word_counts(odd_docs))) == variants_by_force(counts)
    assert collected(spelling.variants(spelling.word_counts(no_docs))) == {}


# Fill-in-middle


def cut_by_force(i, text):
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n, digest = len(units), hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return i, n, "plain", None, None, text
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 20:
        return i, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return i, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@given(st.sets(st.integers(0, 300_000), min_size=1, max_size=60), st.integers(0, 250_000), st.integers(0, 90_000), st.integers(1, 3))
@settings(max_examples=60, deadline=None)
def test_offset_set_selects(scattered, start, length, step):
    offsets = np.array(sorted(scattered | set(range(start, start + length, step))))
    held = fill_in_middle.OffsetSet(offsets)
    assert len(held) == len(offsets)
    for k in {0, len(offsets) - 1, *np.random.default_rng(0).integers(0, len(offsets), 40).tolist()}:
        assert held.select(k) == offsets[k]


def test_every_kind_of_container():
    even, dense, few = np.arange(0, 65_536, 2), np.arange(65_536, 120_000), np.array([131_072, 131_080])
    assert fill_in_middle.OffsetSet(np.concatenate((even, dense, few))).kinds() == [
        fill_in_middle.BitmapContainer, fill_in_middle.RunContainer, fill_in_middle.ArrayContainer
    ]


def test_transformation_of_documents(spark, texts, odd_docs, no_docs):
    odd = [(r.doc_id, r.text or "") for r in odd_docs.collect()]
    extra = [(100 + k, f"a<{m}>b c") for k, m in enumerate("PSMX")] + [(200, "<P" * 9 + "<S<M" * 9), (201, "日本語, ß𝄞!\r\n" * 30_000)]
    docs = spark.createDataFrame(texts + odd + extra, "doc_id long, text string")
    made = fill_in_middle.transform(docs)
    rows = sorted(map(tuple, made.collect()), key=repr)
    assert rows == sorted((cut_by_force(i, t) for i, t in texts + odd + extra), key=repr)
    assert {r[2] for r in rows} == {"plain", "psm", "spm"}
    back = made.withColumn("back", fill_in_middle.restored(made.output, made.form)).select("doc_id", "back")
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(texts + odd + extra, key=repr)
    assert fill_in_middle.transform(no_docs).collect() == []
    assert fill_in_middle.transform(odd_docs).count() == odd_docs.count()


# Repeated byte strings


def removed_by_force(texts, length):
    """For each text the bytes covered by a string of ``length`` bytes that starts at another place as well."""
    data = [(t or "").encode() for t in texts]
    times = Counter(d[p : p + length] for d in data for p in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for p in range(len(d) - length + 1):
            if times[d[p : p + length]] > 1:
                gone[p : p + length] = True
        edges = np.flatnonzero(np.diff(gone.astype(int), prepend=0, append=0)).tolist()
        out.append((len(d), list(zip(edges[::2], edges[1::2])), bytes(b for b, g in zip(d, gone) if not g)))
    return out


def removed(docs, *args):
    rows = substrings.without_repeats(docs, "doc_id", "text", *args).collect()
    return sorted((r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in rows)


@given(st.lists(st.text("abé", max_size=30), min_size=1, max_size=6), st.integers(2, 9))
@settings(max_examples=150, deadline=None)
def test_repeated_starts(texts, length):
    data = [t.encode() for t in texts]
    found = substrings.repeated_starts(data, np.arange(len(data), dtype=np.int64) << 32, np.zeros(len(data), bool), length)
    times = Counter(d[p : p + length] for d in data for p in range(len(d) - length + 1))
    want = [p + length <= len(d) and times[d[p : p + length]] > 1 for d in data for p in range(len(d) + 1)]
    assert found.tolist() == want


@pytest.mark.parametrize("most", [1024, 2])
def test_repeats_of_every_kind(spark, most):
    """Copies, edges inside texts, periods, overlaps in one text, and a passage that most texts share."""
    rng = random.Random(3)

    def prose(n):
        return "".join(rng.choices("abcdeé ", k=n))

    passage, copy = prose(60), prose(150)
    texts = [prose(rng.randint(0, 80)) + passage[: rng.randint(25, 60)] + prose(rng.randint(0, 80)) for _ in range(30)]
    texts += [copy, copy, copy[20:] + "!", copy[:90] + "?" + copy[91:], "ab" * 60, "x" * 100, "x" * 39, "x" * 40, "x" * 41, None, "", "e" + copy * 2]
    docs = spark.createDataFrame([(k % 7, t) for k, t in enumerate(texts)], "doc_id long, text string")
    assert removed(docs, 40, 16, most) == sorted(removed_by_force(texts, 40))


def test_repeats_of_documents(spark, texts, odd_docs, no_docs):
    found = {r.doc_id: r for r in QUERIES["op13_substrings"](spark, SMALL).collect()}
    for (i, _), (n, spans, kept) in zip(texts, removed_by_force([t for _, t in texts], 400)):
        r = found[i]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (n, sum(b - a for a, b in spans), len(spans))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()
    odd = [r.text for r in odd_docs.collect()]
    assert removed(odd_docs) == sorted(removed_by_force(odd, 400)) and removed(no_docs) == []
