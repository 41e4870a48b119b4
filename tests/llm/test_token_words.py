"""Words of letters go to the tokenizer's model as they are, with the ids that the library gives the text."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from strata.llm.token_files import Encoder, text_groups

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["ab", "Word", "é", "ß", "×", "ƀ", "ɏ", "'", "'s", "'ll", "_", "1", "²", " ", " ", "\n", "\t", "\r", " ", "\u0085",
         "\x1c", "　", "-", "…", "日", "́", "😀", "<|endoftext|>", "don't", "x,", "\x00"]


@pytest.fixture()
def encoder():
    return Encoder(PATH)


def test_plain_words_skip_the_pattern(encoder, monkeypatch):
    seen, encoded = [], encoder._encoded
    monkeypatch.setattr(encoder, "_encoded", lambda texts: seen.extend(texts) or encoded(texts))
    ids = encoder("one two, three.\nFour naïve lines (five) 6", 0)
    assert sorted(w for w in seen if w) == [" (five)", " 6", "one"]
    assert ids.tolist()[:-1] == Tokenizer.from_file(PATH).encode("one two, three.\nFour naïve lines (five) 6", add_special_tokens=False).ids


def test_ids_are_those_of_the_whole_text(encoder):
    rng, library = random.Random(3), Tokenizer.from_file(PATH)
    texts = ["", " ", "\n", "\na", " a\n", "a \nb", "a\n\nb", "a.\nb,", *("".join(rng.choices(PARTS, k=rng.randrange(1, 14))) for _ in range(20000))]
    for text, want in zip(texts, library.encode_batch_fast(texts, add_special_tokens=False), strict=True):
        assert encoder(text, 7).tolist() == [*want.ids, 7], repr(text)


def test_a_group_of_texts_asks_for_each_word_once(encoder, monkeypatch):
    asked, library = [], Tokenizer.from_file(PATH)
    monkeypatch.setattr(encoder._known, "_make", lambda word, make=encoder._ids: asked.append(word) or make(word))
    looked_up = []
    monkeypatch.setattr(type(encoder._known), "__getitem__", lambda known, w: looked_up.append(w) or dict.__getitem__(known, w), raising=False)
    texts = ["one two two\ntwo", "two one two", "", "x <|endoftext|> two", "a  two", "one"]
    got = [ids.tolist() for ids in encoder.many(texts, 7)]
    assert got == [[*library.encode(text, add_special_tokens=False).ids, 7] for text in texts]
    assert looked_up.count("two") <= 2 and asked.count("two") == 1  # once for the group, once for the text with two spaces
    assert list(encoder.many([], 7)) == [] and [list(x) for x in encoder.many(["a  b"], 7)] == [[*library.encode("a  b").ids, 7]]


def test_groups_give_the_ids_of_the_whole_texts(encoder):
    rng, library = random.Random(5), Tokenizer.from_file(PATH)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(0, 14))) for _ in range(20000)]
    for group in text_groups([(None, t) for t in texts], 3000):
        of = [text for _, text in group]
        for text, ids, want in zip(of, encoder.many(of, 7), library.encode_batch_fast(of, add_special_tokens=False), strict=True):
            assert ids.tolist() == [*want.ids, 7], repr(text)


def test_word_hashes_tell_words_apart_as_split_does():
    import random

    from strata.llm.text import word_hashes, words

    draw, seen = random.Random(1), {}
    parts = [b"a", b"B", b"b", b"\xc3\xa9", b"\x00", b"\xc2\xa0", b"\x1c", b".", b"z" * 30, b" ", b"\n", b"\t\r", b"\x0b", b"\x0c "]
    for n in range(2000):
        text = b"".join(draw.choice(parts) for _ in range(n % 60)) + b"q" * (n % 7 * 50)
        found = words(text.lower())
        hashes = word_hashes(text).tolist()
        assert len(hashes) == len(found)
        assert all(seen.setdefault(word, h) == h for word, h in zip(found, hashes))
    assert len(set(seen.values())) == len(seen)


def test_small_tables_of_links_take_few_tasks(spark):
    from strata.llm.links import FEWEST_TASKS, _packed

    many = spark.range(0, 1000, 1, 40)
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        assert _packed(many, 1000).rdd.getNumPartitions() == FEWEST_TASKS
        assert _packed(many, 10**9).rdd.getNumPartitions() == 40
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
