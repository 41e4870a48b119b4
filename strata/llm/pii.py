"""Personal data by a semi-Markov conditional random field over whole spans.

Base patterns find what is written in the usual way. The field adds spans that they miss, such as a
phone number without its country code or a card number with other separators.

A text is read around its digits and @ signs only, as an entity has to hold one: stretches of pieces
(runs of letters, of digits, single other characters). A candidate segment is a run of at most
``LONGEST`` pieces of plausible content; its score sums weights of features of the whole span and its
type: its shape, number of digits and groups, checksum, range of parts, separators, length, and the
characters around it. Dynamic programming over a stretch chooses boundaries and types jointly. The
weights maximise the conditional likelihood, by gradients from forward and backward sums, on at most
``STRETCHES`` stretches of about ``SAMPLE`` texts, both chosen by hash, where the base patterns label the
spans, and on variants of these spans that the base patterns don't match. Stretches stop at line ends and
are never cut: the dynamic program goes along them with a few bytes a piece, so time is linear in the
text, and every text is one row's work.

Defined results: a null or empty text has no spans. Spans of the field never overlap base spans.
Offsets are code points, the end exclusive. Without base spans to learn from, nothing is added.
"""

from __future__ import annotations

import bisect
import math
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.text import map_rows

Span = tuple[int, int, str]

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 1500
STRETCHES = 9000
EPOCHS = 5
RATE = 0.3
SEED = 5
LONGEST = 16
MARGIN = 40

# Numbers that are no personal data, for the field to learn from.
DECOYS = (
    "2024-05-17", "17.05.2021", "2021-05-17 10:22:33", "17.05.2021 10:22", "12, 13, 14, 15", "1,234,567.89", "3.14159265", "1999-2004",
    "1 2 3 4 5 6 7 8", "10:22:33.125", "12345678", "100 200 300 400", "2019 2020 2021",
)

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
DIGITS = frozenset("0123456789")
TRIGGER = re.compile(r"[0-9@]")
PIECE = re.compile(r"[A-Za-z]+|[0-9]+|.", re.S)


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """Matches of the address pattern, leftmost first: the longest local part before each @ that a domain follows."""
    end = 0
    for found in DOMAIN.finditer(text):
        start = found.start()
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < found.start():
            end = found.end()
            yield start, end, "email"


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns, by start, then by kind as listed."""
    found = list(emails(text))
    for m in IP.finditer(text):
        if all(len(p) < 20 and int(p) <= 255 for p in (q.lstrip("0") or "0" for q in m[0].split("."))):
            found.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), "card"))
    for m in PHONE.finditer(text):
        if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
            found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def windows(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of ``text`` around digits and @ signs that follow each other closely on a line."""
    start = end = None
    for found in TRIGGER.finditer(text):
        at = found.start()
        if start is not None and at - end < 6 and "\n" not in text[end:at]:
            end = at + 1
            continue
        if start is not None:
            yield around(text, start, end)
        start, end = at, at + 1
    if start is not None:
        yield around(text, start, end)


def around(text: str, start: int, end: int) -> tuple[int, int]:
    """``start`` to ``end`` with the rest of the words at its ends and a bracket or sign before it.

    An @ at an end may stand apart from the word next to it, which then belongs to the stretch.
    """
    low, high = max(0, start - MARGIN), min(len(text), end + MARGIN)
    before = text[low:start]
    word = before.rstrip(" ") if text[start] == "@" else before
    cut = max(word.rfind(c) for c in " \n\t")
    after = text[end:high]
    gap = len(after) - len(after.lstrip(" ")) if text[end - 1] == "@" else 0
    ends = [k for k in (after.find(c, gap) for c in " \n\t") if k >= 0]
    return low + cut + 1, end + (min(ends) if ends else len(after))


def shape(span: str) -> str:
    """The span with runs of letters as a and runs of digits as their number of digits, up to 5."""
    return "".join("a" if p[0].isascii() and p[0].isalpha() else str(min(5, len(p))) if p[0].isdigit() else p
                   for p in PIECE.findall(span))


def span_features(span: str, before: str, after: str) -> list[str]:
    digits = NOT_DIGIT.sub("", span)
    groups = [g for g in NOT_DIGIT.split(span) if g]
    seps = "".join(sorted(set(re.sub(r"[A-Za-z0-9]+", "", span))))
    quads = len(groups) == 4 and all(len(g) < 4 and int(g) < 256 for g in groups)
    out = ["bias", f"digits={min(len(digits), 20)}", f"groups={min(len(groups), 6)}", f"seps={seps}", f"len={min(len(span) // 4, 10)}",
           f"first={kind_of(span[0])}", f"last={kind_of(span[-1])}", f"before={kind_of(before)}", f"after={kind_of(after)}",
           f"at={span.count('@')}"]
    if len(span) <= 24 and "@" not in span:
        out.append(f"shape={shape(span)}")
    if "@" in span:
        local, _, host = span.partition("@")
        out += [f"host={host.count('.')}", f"local={bool(local)}", f"space={' ' in span}", f"tail={host[-1:].isalpha()}"]
    if 13 <= len(digits) <= 19:
        out.append(f"luhn={luhn(digits)}")
    if quads:
        out.append("quads")
    return out


def kind_of(character: str) -> str:
    if not character:
        return "end"
    return "a" if character.isalpha() else "0" if character.isdigit() else "_" if character.isspace() else character


def boundaries(text: str, start: int, end: int) -> array:
    """Where the pieces of a stretch begin and end."""
    return array("q", [start, *(m.end() for m in PIECE.finditer(text, start, end))])


def segments(text: str, bounds: Sequence[int], i: int) -> Iterator[tuple[int, str]]:
    """The segments (last boundary, span) from boundary ``i`` that an entity may fill.

    Segments start and end at words' edges: with a letter or digit, or a + or bracket that opens one.
    They hold seven digits or more, four groups of up to three digits with a dot in every gap, or an @
    between other characters.
    """
    first, last = text[bounds[i]], len(bounds) - 1
    if not (first.isascii() and first.isalnum() or first in "+("):
        return
    n, at, alpha, groups, short, dot = 0, 0, 0, 0, True, True
    for j in range(i, min(last, i + LONGEST)):
        character = text[bounds[j]]
        word = character.isascii() and character.isalnum()
        if character in DIGITS:
            size = bounds[j + 1] - bounds[j]
            n, groups, short, dot = n + size, groups + 1, short and size <= 3 and dot, False
        elif word:
            alpha += 1
        at += character == "@"
        dot |= character == "."
        if at > 1 or n > 20 or (character == " " and j + 1 < last and text[bounds[j + 1]] == " "):
            return
        enough = n >= 7 or groups == 4 and short and first in DIGITS
        if word and (at == 1 and j > i + 1 or enough and not alpha and not at):
            yield j + 1, text[bounds[i] : bounds[j + 1]]


def candidates(text: str, start: int, end: int) -> tuple[Sequence[int], list[tuple[int, int, str]]]:
    """Boundaries of the pieces of a stretch, and all its segments (first, last boundary, span)."""
    bounds = boundaries(text, start, end)
    return bounds, [(i, j, span) for i in range(len(bounds) - 1) for j, span in segments(text, bounds, i)]


class Field:
    """Weights by feature and type, and what is computed with them."""

    def __init__(self, weights: dict[str, float] | None = None):
        self.weights = defaultdict(float, weights or {})

    def scores(self, text: str, bounds: Sequence[int], i: int, j: int, span: str) -> Iterator[tuple[str, list[str], float]]:
        """Each type a segment may have, its features, and its score."""
        names = span_features(span, text[max(0, bounds[i] - 1) : bounds[i]], text[bounds[j] : bounds[j] + 1])
        for kind in ("email",) if "@" in span else KINDS[1:]:
            yield kind, names, sum(self.weights.get(f"{kind} {n}", 0.0) for n in names)

    def decode(self, text: str, start: int, end: int) -> list[Span]:
        """The best segmentation's entities. Of a piece of the stretch, its score and its way back are kept."""
        bounds = boundaries(text, start, end)
        n = len(bounds)
        best, back, kinds = array("d", [-math.inf]) * n, array("i", [0]) * n, bytearray(n)
        best[0] = 0.0
        for i in range(n - 1):
            for j, span in segments(text, bounds, i):
                for kind, _, score in self.scores(text, bounds, i, j, span):
                    if best[i] + score > best[j]:
                        best[j], back[j], kinds[j] = best[i] + score, i, KINDS.index(kind) + 1
            if best[i] >= best[i + 1]:  # the piece is no part of an entity
                best[i + 1], back[i + 1], kinds[i + 1] = best[i], i, 0
        spans, j = [], n - 1
        while j:
            i = back[j]
            if kinds[j]:
                spans.append((bounds[i], bounds[j], KINDS[kinds[j] - 1]))
            j = i
        return spans[::-1]

    def learn(self, text: str, start: int, end: int, gold: list[Span], seen: dict[str, float]) -> None:
        """One step along the gradient of the likelihood of ``gold`` in a stretch."""
        bounds, found = candidates(text, start, end)
        place = {b: k for k, b in enumerate(bounds)}
        right = {(place.get(s), place.get(e), kind) for s, e, kind in gold}
        scored = [(i, j, *one) for i, j, span in found for one in self.scores(text, bounds, i, j, span)]
        if not scored or not right <= {s[:3] for s in scored}:
            return
        ending, starting = defaultdict(list), defaultdict(list)
        for segment in scored:
            ending[segment[1]].append(segment)
            starting[segment[0]].append(segment)
        n = len(bounds)
        ahead, back = [0.0] * n, [0.0] * n
        for j in range(1, n):
            ahead[j] = log_sum([ahead[j - 1], *[ahead[s[0]] + s[4] for s in ending[j]]])
        for i in range(n - 2, -1, -1):
            back[i] = log_sum([back[i + 1], *[back[s[1]] + s[4] for s in starting[i]]])
        steps: dict[str, float] = defaultdict(float)
        for i, j, kind, names, score in scored:
            step = ((i, j, kind) in right) - math.exp(min(0.0, ahead[i] + score + back[j] - ahead[-1]))
            if abs(step) > 1e-4:
                for name in names:
                    steps[f"{kind} {name}"] += step
        for name, step in steps.items():
            seen[name] += step * step
            self.weights[name] += RATE * step / math.sqrt(seen[name])


def log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def variants(span: str, kind: str) -> list[str]:
    """Other ways to write a span, which the base patterns don't match."""
    if kind == "phone" and " " in span:
        short = span.split(" ", 1)[1]
        return [short, short.replace(" ", "-").replace("(", "").replace(")", "")]
    if kind == "card":
        digits = NOT_DIGIT.sub("", span)
        parts = [digits[k : k + 4] for k in range(0, len(digits), 4)]
        return [".".join(parts), "  ".join(parts).replace("  ", " / ")]
    if kind == "ip":
        return [span.replace(".", ". "), span.replace(".", "[.]"), span.replace(".", " . ")]
    if kind == "email":
        return [span.replace("@", " @ "), span.replace("@", " @")]
    return []


def examples(text: str) -> Iterator[tuple[str, int, int, list[Span]]]:
    """Stretches with their base spans, the same with a span written in another way, and with a decoy in its place."""
    spans = base_spans(text)
    for start, end in windows(text):
        own = [s for s in spans if start <= s[0] and s[1] <= end]
        yield text, start, end, own
        for s, e, kind in own:
            decoy = DECOYS[zlib.crc32(text[s:e].encode()) % len(DECOYS)]
            for other in [*variants(text[s:e], kind), decoy]:
                low, high = max(0, s - 60), e + 60
                changed = text[low:s] + other + text[e:high]
                span = (s - low, s - low + len(other), kind)
                for a, b in windows(changed):
                    if a <= span[0] and span[1] <= b:
                        named = [span] if other != decoy else []
                        kept = [(x - low, y - low, k) for x, y, k in own if y <= s and x - low >= a]
                        shift = len(other) - (e - s) - low
                        kept += [(x + shift, y + shift, k) for x, y, k in own if x >= e and y + shift <= b]
                        yield changed, a, b, sorted([*named, *kept])


def train(docs: DataFrame, text: str = "text", sample: int = SAMPLE, most: int = STRETCHES) -> Field:
    """A field fitted on at most ``most`` different stretches of at most ``sample`` texts with digits or an @.

    Texts and stretches are chosen by hashes of their content, so no place in a text is left out.
    """
    texts = docs.where(F.col(text).rlike("[0-9@]")).select(F.col(text).alias("text"))
    mark = F.xxhash64(F.lit(SEED), "text")
    some = max(1, texts.count() // sample)  # a hash keeps about the bound, before anything meets
    texts = texts.where(F.pmod(mark, F.lit(some)) == 0)
    chosen = texts.select(mark.alias("mark"), "text").orderBy("mark").limit(sample)
    near = F.regexp_extract_all("text", F.lit(r"([^\n]{0,100}(?:@|[0-9]{3})[^\n]{0,200})"), F.lit(1))
    parts = chosen.select(F.explode(near).alias("part")).distinct()
    turn = F.xxhash64(F.lit(SEED), "part")
    rows = parts.select("part", turn.alias("turn")).orderBy("turn", "part").limit(most).collect()
    field, seen = Field(), defaultdict(lambda: 1e-2)
    stretches = [e for row in rows for e in examples(row["part"])]
    for _ in range(EPOCHS):
        for example in stretches:
            field.learn(*example, seen)
    field.weights = defaultdict(float, {n: round(w, 6) for n, w in field.weights.items()})
    return field


def all_spans(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """Base spans, and those with the field's added where they don't overlap."""
    base = base_spans(text)
    starts, ends = [], []  # of base spans, overlapping ones merged
    for start, end, _ in base:
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    added = []
    for start, end in windows(text):
        for s, e, kind in field.decode(text, start, end):
            k = bisect.bisect_left(starts, e)
            if not k or ends[k - 1] <= s:
                added.append((s, e, kind))
    return base, sorted({*base, *added}, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find(docs: DataFrame, field: Field, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, base (array of kind:start:end), and spans, all of them, joined by commas."""
    shared = docs.sparkSession.sparkContext.broadcast(dict(field.weights))

    def work():
        held = Field(shared.value)

        def one(key, data):
            base, spans = all_spans(data, held)
            return key, [written([s]) for s in base], written(spans)

        return one

    return map_rows(
        docs.select(id, F.coalesce(F.col(text), F.lit(""))), f"`{id}` bigint, base array<string>, spans string", work
    )
