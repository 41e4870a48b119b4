"""Token ids in Parquet files that can be read in part.

One row per document, in ascending order of its id over all files. The ids are a list column with
dictionary encoding: a vocabulary fits the dictionary page, so an id takes its bits only. The other
columns ascend or are small and are written as deltas. Row groups and pages have bounded sizes, and
the writer adds column and offset indexes, so a reader of some documents or of the metadata alone
skips the pages of the rest.

Texts travel once, to ranges of their ids. Their number follows from the bytes of the texts, so a
file stays within ``FILE_BYTES``; rows of one id may lie in several files. A file can be written
again by any executor.

Defined results: a null or empty text has the end id only. A special token that the vocabulary adds
and a text spells out gets its id, as the library gives it. Null document ids come first. Rows that
are repeated are encoded as often; their order among themselves goes by content.
"""

from __future__ import annotations

import functools
import json
import math
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.text import importable, map_task
from strata.operators.skew import lookup_join

FILE_BYTES = 64 << 20
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10

SAFE = re.compile(r"(?<=\S) (?=\S)")
UNSAFE = re.compile(r"\s\s|\s\Z")
# A word of letters, after a line's end or else a space, and the marks that follow it up to the next white space.
PLAIN = re.compile(r"(\n?)([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+)([!-/:-@\[-`{-~]*)")
SHORT, MOST = 64, 350_000
# Characters of the texts that are encoded together, at least.
GROUP_CHARS = 4 << 20


def byte_letters() -> dict[int, str]:
    """The character by which byte-level BPE writes each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}


BYTE_LETTERS = byte_letters()


class Known(dict):
    """Ids by word; a word that is missing is taken from the older table or made."""

    def __init__(self, make: Callable[[str], bytes], older: dict[str, bytes]):
        self._make, self._older = make, older

    def __missing__(self, word: str) -> bytes:
        ids = self._older.get(word)
        if ids is None:
            ids = self._make(word)
        if len(word) <= SHORT:
            self[word] = ids
        return ids


class Encoder:
    """Ids of texts by the tokenizers library, word by word.

    Byte-level BPE merges inside the matches of its pattern only, and no match spans a space or a line's
    end between two other characters. So a text is the sum of its words, each with the character before
    it, and the library sees a word once as long as one of two bounded tables holds it; the older is dropped
    when the newer is full, and what is still in use moves over. The pattern cuts a word of letters and the
    marks after it in two, so these go to the library's model as they are; all other words go through
    its pattern. Tokens that were added to the vocabulary match before the pattern does and may hold
    spaces, so a text with one goes to the library whole.

    Texts are encoded in groups (``many``), whose words are cut and numbered by Arrow, so a table is asked
    once for each different word of a group.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        stated = json.loads(self._tokenizer.to_str())
        cut = stated["pre_tokenizer"] or {}
        self._bytewise = (
            stated["normalizer"] is None and cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut["add_prefix_space"]
        )
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values() if t.content]
        self._known = Known(self._ids, {})
        self._marks: dict[str, bytes] = {}

    def _encoded(self, texts: list[str]) -> list[bytes]:
        return [array("i", e.ids).tobytes() for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _merged(self, match: str) -> bytes:
        """Ids of one match of the pattern, whose space is written as in the vocabulary."""
        return array("i", [t.id for t in self._model.tokenize(match)]).tobytes()

    def _ids(self, word: str) -> bytes:
        """Ids of a word that stands after a space, unless it begins with a line's end."""
        short = self._bytewise and len(word) <= SHORT
        if short and word.isascii() and word.isalpha():
            return self._merged(BYTE_LETTERS[32] + word)
        plain = PLAIN.fullmatch(word) if short else None
        if plain is None:
            return self._encoded([word if word.startswith("\n") else f" {word}"])[0]
        line, letters, marks = plain.groups()
        if not line and marks and letters in self._known:
            return self._known[letters] + self._after(marks)
        shown = letters if letters.isascii() else letters.encode().decode("latin-1").translate(BYTE_LETTERS)
        ids = self._after(line) + self._merged(shown) if line else self._merged(BYTE_LETTERS[32] + shown)
        return ids + self._after(marks) if marks else ids

    def _after(self, marks: str) -> bytes:
        ids = self._marks.get(marks)
        if ids is None:
            ids = self._merged(marks.translate(BYTE_LETTERS))
            if len(self._marks) < MOST:
                self._marks[marks] = ids
        return ids

    def __call__(self, text: str, end: int) -> np.ndarray:
        if any(token in text for token in self._added):
            return np.frombuffer(self._encoded([text])[0] + array("i", [end]).tobytes(), np.int32)
        first, *rest = SAFE.split(text) if UNSAFE.search(text) else text.replace("\n", " \n").split(" ")
        if len(self._known) > MOST:
            self._known = Known(self._ids, dict(self._known))
        ids = b"".join([*self._encoded([first]), *map(self._known.__getitem__, rest), array("i", [end]).tobytes()])
        return np.frombuffer(ids, np.int32)


    def many(self, texts: list[str], end: int) -> Iterator[np.ndarray]:
        """The ids of each of ``texts``, as one call for each would give them."""
        apart = {i for i, t in enumerate(texts) if UNSAFE.search(t) or any(token in t for token in self._added)}
        plain = pa.array([t for i, t in enumerate(texts) if i not in apart], pa.large_string())
        if len(self._known) > MOST:
            self._known = Known(self._ids, dict(self._known))
        found = pc.split_pattern(pc.replace_substring(plain, "\n", " \n"), " ")
        bounds = found.offsets.to_numpy()
        numbered = found.values.dictionary_encode()
        # A text's first word stands after no space. It has an entry of its own behind those of the words, and
        # the end id has the last one.
        names = numbered.dictionary.to_numpy(zero_copy_only=False)
        firsts = found.values.take(pa.array(bounds[:-1])).to_pylist()
        entries = [*map(self._known.__getitem__, names), *(self._encoded(firsts) if firsts else []), array("i", [end]).tobytes()]
        codes = numbered.indices.to_numpy().copy()
        codes[bounds[:-1]] = np.arange(len(names), len(names) + len(firsts))
        codes = np.insert(codes, bounds[1:], len(entries) - 1)
        sizes = np.fromiter(map(len, entries), np.int64, len(entries)) // 4
        begins, lengths = (np.cumsum(sizes) - sizes)[codes], sizes[codes]
        stops = np.cumsum(lengths)
        at = np.repeat(begins - stops + lengths, lengths)
        at += np.arange(len(at))
        ids = np.frombuffer(b"".join(entries), np.int32)[at]
        ends = iter(np.split(ids, stops[bounds[1:] + np.arange(len(firsts))])[:-1])
        for i, text in enumerate(texts):
            yield self(text, end) if i in apart else next(ends)


def text_groups(rows: Iterable[tuple], chars: int) -> Iterator[list[tuple]]:
    """Rows (key, text) in groups whose texts have ``chars`` characters together, or are what is left."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1])
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


@functools.lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    """The encoder of a file; a worker keeps it, with its tables, from task to task."""
    return Encoder(path)


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end: int, id: str = "doc_id", text: str = "text",
    file_bytes: int = FILE_BYTES,
) -> None:
    """Encode ``docs`` and write the files below ``path``.

    Columns: the id, file_start (ids of the documents before it in its file), n_tokens, token_ids.
    """
    size = docs.agg(F.sum(F.octet_length(text) + 32)).first()[0] or 0
    ranged = (
        docs.select(F.col(id).cast("long").alias(id), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(max(1, math.ceil(size / file_bytes)), id, "tie")
        .sortWithinPartitions(id, "tie")
    )

    def run(rows):
        encoder, at = encoder_of(tokenizer), 0
        for group in text_groups(rows, GROUP_CHARS):
            for (key, _), ids in zip(group, encoder.many([data for _, data in group], end), strict=True):
                yield key, at, len(ids), ids
                at += len(ids)

    rows = map_task(
        ranged.select(id, "text"), f"`{id}` bigint, file_start bigint, n_tokens bigint, token_ids array<int>", run
    )
    writer = rows.write.option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", PAGE_BYTES)
    writer = writer.option("parquet.writer.version", "v2").option("compression", "zstd")
    for column in (id, "file_start", "n_tokens"):
        writer = writer.option(f"parquet.enable.dictionary#{column}", "false")
    writer.parquet(path)


def read_tokens(spark: SparkSession, path: str, id: str = "doc_id") -> DataFrame:
    """The documents of the files: id, start (ids before it in all files), n_tokens, token_ids.

    The files' sizes come from the metadata columns alone and are summed along the file names.
    """
    files = spark.read.parquet(path).withColumn("file", F.col("_metadata.file_name"))
    sizes = files.groupBy("file").agg(F.max(F.col("file_start") + F.col("n_tokens")).alias("size"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("file", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    return lookup_join(files, starts, [("file", "file")], ["before"]).select(
        id, (F.col("before") + F.col("file_start")).alias("start"), "n_tokens", "token_ids"
    )


def token_checksums(tokens: DataFrame, id: str = "doc_id") -> DataFrame:
    """``tokens`` with ids_crc32 in place of the ids: of their little-endian 32-bit numbers."""

    def run(batches):
        for batch in batches:
            key, start, n, ids = batch.columns
            values, bounds = ids.values.to_numpy().astype("<u4", copy=False), ids.offsets.to_numpy()
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in pairwise(bounds)]
            yield pa.RecordBatch.from_arrays([key, start, n, pa.array(sums, pa.int64())], [id, "start", "n_tokens", "ids_crc32"])

    return importable(tokens).select(id, "start", "n_tokens", "token_ids").mapInArrow(
        run, f"`{id}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
