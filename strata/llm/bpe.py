"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Texts longer than ``CUT`` characters are encoded in pieces, cut before a single space between two word
characters. The pattern never matches across such a place: a match that ends with a word character
ends there, and a space that a word character follows starts a new match. So pieces give the ids of
the whole text, and the library never holds more than one piece.

Defined results: a null or empty text has no ids and decodes to no bytes. Rows and other columns stay
as they are, repeated rows too.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.text import map_rows

CUT = 65_536
SAFE = re.compile(r"(?<=\w) (?=\w)")


@functools.lru_cache(maxsize=4)
def encoding(path: str, pattern: str):
    """The library's encoder for a rank file; loaded once a worker."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, cut: int = CUT) -> Iterator[str]:
    """``text`` in pieces of about ``cut`` characters that can be encoded one by one."""
    start = 0
    while len(text) - start > cut:
        place = SAFE.search(text, start + cut)
        if not place:
            break
        yield text[start : place.start()]
        start = place.start()
    yield text[start:]


def encode(docs: DataFrame, path: str, pattern: str, id: str = "doc_id", text: str = "text", cut: int = CUT) -> DataFrame:
    """One row per row of ``docs``: its id (long) and token_ids (array of int)."""

    def work():
        known = encoding(path, pattern)

        def one(key, data):
            found = [np.array(known.encode_ordinary(piece), np.int32) for piece in pieces(data, cut)]
            return key, np.concatenate(found) if len(found) > 1 else found[0]

        return one

    return map_rows(docs.select(id, F.coalesce(F.col(text), F.lit(""))), f"`{id}` bigint, token_ids array<int>", work)


def decode(tokens: DataFrame, path: str, pattern: str, id: str = "doc_id", ids: str = "token_ids") -> DataFrame:
    """One row per row of ``tokens``: its id, its token ids and the bytes they stand for.

    Bytes, as a token may end inside a character. A null list decodes to no bytes.
    """

    def work():
        known = encoding(path, pattern)
        return lambda key, found: (key, np.array(found or [], np.int32), known.decode_bytes(found or []))

    return map_rows(tokens.select(id, ids), f"`{id}` bigint, token_ids array<int>, data binary", work)


def digests(docs: DataFrame, path: str, pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256 (of decimal ids joined by commas) and decoded_sha256, by row of ``docs``."""
    found = decode(encode(docs, path, pattern, id, text), path, pattern, id)
    return found.select(
        id, F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )
