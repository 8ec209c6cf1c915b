"""Secret scans: fixed patterns, and values near credential words that would be costly to guess.

The guess cost of a value is the least, over all ways to cut it into segments, of the
sum of the segments' costs, in decimal digits. A segment is a known word, a date, a
block repeated three times or more, a walk over the keyboard or characters to be tried one by one. The
minimum is found by dynamic programming over the positions of the value. (Of a block repeated over
``EACH`` times, numbers of repeats between that and all of them are no segments.)
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import pieces, settled

# The base patterns, in the order in which spans with one start are listed.
BASE = {
    "assign": re.compile(
        r"(?ai:(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+))"
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]{24,}"),
}
KINDS = (*BASE, "guess")
SHORTEST = {"assign": 6, "access": 20, "hex": 24}

# A wider context: more words, and "is" or an arrow as well as a colon or an equals sign.
CONTEXT = re.compile(
    r"(?ai:(?:pass(?:word|wd|phrase|code|wort)?|pwd|secret|token|credentials?|(?:api|access|auth|private)[_-]?key)"
    r"[\"']?\s{0,8}(?::=|=>|->|[:=]|\bis\b)\s{0,8}([\"']?)([^\s\"'<>]+))"
)
HINTS = ("pass", "pwd", "secret", "token", "credential", "key")  # without one of these no context can match
COSTLY = 10.0  # decimal digits of guesses from which a value counts as a secret
PROSE = 4.0  # more of them are asked of a value of letters alone, which may be a rare word
DICTIONARY = 20_000  # words of the documents, commonest first, that a guesser would know: a bound, as a parameter

# Words that people choose, commonest first: an ordinary short list, tried before those of the documents.
WORDS = (
    "password secret admin welcome login master letmein monkey dragon sunshine princess football baseball shadow "
    "superman batman trustno hello freedom whatever summer winter spring autumn changeme default guest root test user "
    "qwerty love money star flower cookie orange banana purple silver golden tiger eagle hunter ranger killer pepper "
    "ginger jordan michael jennifer charlie thomas robert daniel andrew joshua jessica computer internet server "
    "database system oracle mysql example sample dummy placeholder token key access pass your here none null true "
    "false this that with from have the and for you are not but all can one out day get has him his how man new now"
).split()
KEYBOARD = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz")
# Year first, year last, and a year alone; looked for at every place.
DATES = [
    re.compile(rf"(?a:(?=({pattern})))")
    for pattern in (
        r"(?:19|20)\d\d(?P<sign>[-/._]?)(?:0[1-9]|1[0-2])(?P=sign)(?:0[1-9]|[12]\d|3[01])",
        r"(?:0[1-9]|[12]\d|3[01])(?P<sign>[-/._]?)(?:0[1-9]|1[0-2])(?P=sign)(?:19|20)\d\d",
        r"(?:19|20)\d\d",
    )
]
BLOCK = 8  # characters of the longest block whose repeats are looked for
EACH = 64  # repeats up to which every number of them is a segment; beyond, all there are
LEET = str.maketrans("013457@$!", "oieastasi")
REMEMBERED = 128  # characters of a value whose cost is kept for when it recurs
SEGMENT = math.log10(4)  # what it costs to know where another segment starts


def _alphabet(character: str) -> float:
    if character.isdigit():
        return 1.0
    return math.log10(26) if character.isascii() and character.isalpha() else math.log10(33)


class GuessCost:
    """Guess costs under a word list."""

    def __init__(self, words: Iterable[str] = WORDS):
        self.ranks = {}
        for rank, word in enumerate(words, 2):
            self.ranks.setdefault(word, math.log10(rank))
        self.longest = max(map(len, self.ranks), default=0)
        self._remembered = lru_cache(1 << 14)(self._of)

    def of(self, value: str) -> float:
        """The guess cost; short values recur and are remembered, long ones would fill the memory."""
        return self._remembered(value) if len(value) <= REMEMBERED else self._of(value)

    def _of(self, value: str) -> float:
        n, arriving = len(value), [[] for _ in range(len(value) + 1)]
        for start, stop, cost in self._segments(value):
            arriving[stop].append((start, cost))
        brute = [_alphabet(c) for c in value]
        known = [0.0] + [math.inf] * n  # best cost of a prefix that ends with a known segment
        tried = [math.inf] * (n + 1)  # and of one that ends with characters tried one by one
        for stop in range(1, n + 1):
            tried[stop] = min(tried[stop - 1], known[stop - 1] + SEGMENT) + brute[stop - 1]
            for start, cost in arriving[stop]:
                known[stop] = min(known[stop], min(known[start], tried[start]) + cost + SEGMENT)
        return min(known[n], tried[n])

    def _segments(self, value: str) -> Iterator[tuple[int, int, float]]:
        lower = value.lower() if len(value.lower()) == len(value) else value
        plain = lower.translate(LEET)
        for start in range(len(value)):
            for stop in range(start + 3, min(len(value), start + self.longest) + 1):
                for spelled, extra in ((lower, 0.0), (plain, 0.3)):
                    if (rank := self.ranks.get(spelled[start:stop])) is not None:
                        cased = 0.0 if value[start:stop] == lower[start:stop] else 0.5
                        yield start, stop, rank + extra + cased
        for pattern in DATES:
            for found in pattern.finditer(value):
                yield *found.span(1), 2.1 if len(found[1]) == 4 else 4.6
        yield from self._repeats(value)
        yield from self._walks(lower)

    @staticmethod
    def _repeats(value: str) -> Iterator[tuple[int, int, float]]:
        """Blocks that come three times or more in a row, from every place."""
        for size in range(1, min(BLOCK, len(value) // 3) + 1):
            like = 0  # characters from here on that equal those a block later
            for start in range(len(value) - size - 1, -1, -1):
                like = like + 1 if value[start] == value[start + size] else 0
                most = like // size + 1
                if most < 3:
                    continue
                block = sum(map(_alphabet, value[start : start + size]))
                for times in {*range(3, min(most, EACH) + 1), most}:
                    yield start, start + size * times, block + math.log10(times)

    @staticmethod
    def _walks(lower: str) -> Iterator[tuple[int, int, float]]:
        """Three keys or more in a row of the keyboard or the alphabet, from every place and of every length."""
        for row in KEYBOARD:
            for line in (row, row[::-1]):
                start = 0
                for i in range(1, len(lower) + 1):
                    if i == len(lower) or lower[i - 1] + lower[i] not in line:
                        for first in range(start, i - 2):
                            for stop in range(first + 3, i + 1):
                                yield first, stop, math.log10(60) + math.log10(stop - first)
                        start = i


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """The base spans as (start, kind's place, end): per kind leftmost and without overlap, failing ones dropped."""
    found, hinted = [], _hinted(text)
    for place, (kind, pattern) in enumerate(BASE.items()):
        if kind == "assign" and not hinted:
            continue
        for match in pattern.finditer(text):
            length = len(match[2]) if kind == "assign" else match.end() - match.start()
            if length >= SHORTEST[kind]:
                found.append((match.start(), place, match.end()))
    return sorted(found)


def guessed_spans(text: str, cost: GuessCost, costly: float = COSTLY) -> list[tuple[int, int, int]]:
    """Values in a credential context whose guess cost reaches ``costly``."""
    if not _hinted(text):
        return []
    return [
        (match.start(2), KINDS.index("guess"), match.end(2))
        for match in CONTEXT.finditer(text)
        if _costly((value := match[2].rstrip(".,;:)")), cost, costly)
    ]


def _hinted(text: str) -> bool:
    lower = text.lower()
    return any(map(lower.__contains__, HINTS))


def _costly(value: str, cost: GuessCost, costly: float) -> bool:
    return len(value) >= SHORTEST["assign"] and cost.of(value) >= costly + (PROSE if value.isalpha() else 0)


def common_words(docs: DataFrame, size: int = DICTIONARY) -> list[str]:
    """The commonest words of four to twenty letters a-z in the texts, counted over all of them, a text's words once.

    At most ``size``: words are put in classes by the logarithm of their count, and the classes from the
    highest down that together have no more words are taken whole. So the driver gets the sizes of some
    hundred classes and then the words, however many there are.
    """
    words = F.explode(F.array_distinct(F.split(F.lower("text"), "[^a-z]+"))).alias("word")
    counts = docs.select(words).where("length(word) BETWEEN 4 AND 20").groupBy("word").agg(F.count("*").alias("n"))
    counts = settled(counts.withColumn("class", F.floor(F.log2("n") * 8)), "words")
    lowest, taken = None, 0
    for row in counts.groupBy("class").agg(F.count("*").alias("size")).orderBy(F.desc("class")).collect():
        taken += row["size"]
        if taken > size:
            break
        lowest = row["class"]
    if lowest is None:
        return []
    found = counts.where(F.col("class") >= lowest).select("word", "n").collect()
    return [r["word"] for r in sorted(found, key=lambda r: (-r["n"], r["word"]))]


def _known(docs: DataFrame, words: Iterable[str] | None) -> tuple[str, ...]:
    return tuple(words) if words is not None else (*WORDS, *common_words(docs))


def written(spans: Iterable[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def scan(docs: DataFrame, words: Iterable[str] | None = None, costly: float = COSTLY) -> DataFrame:
    """The secrets of every document, one row each, in one pass without a shuffle.

    ``words`` are those a guesser tries, commonest first: by default ``WORDS`` and the documents' own
    ``common_words``, which are counted first.

    Positions count code points. A null text is an empty one; repeated rows are scanned
    each; an empty table gives no rows; other columns of ``docs`` are not read.
    """
    words = _known(docs, words)

    def run(batches):
        cost = GuessCost(words)
        for batch in pieces(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                guessed = guessed_spans(text or "", cost, costly) if text else []
                counts = [sum(kind == k for _, kind, _ in base) for k in range(3)]
                digest = hashlib.sha256(written(base).encode()).hexdigest()
                rows.append((*counts, digest, written({*base, *guessed})))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(),) * 3 + (pa.string(),) * 2)] if rows else [
                pa.array([], t) for t in (pa.int64(),) * 3 + (pa.string(),) * 2
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], NAMES)

    NAMES = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def redacted(
    docs: DataFrame, mask: str = "[secret]", costly: float = COSTLY, words: Iterable[str] | None = None
) -> DataFrame:
    """``docs`` with every secret span replaced by ``mask``; overlapping spans become one mask.

    Rows, their order of columns and the other columns stay; ``n_chars`` follows the text
    where there is such a column. A null text stays null.
    """

    place, words = docs.columns.index("text"), _known(docs, words)

    def run(batches):
        cost = GuessCost(words)
        for batch in pieces(batches, place):
            texts = [None if t is None else hidden(t, cost, mask, costly) for t in batch.column(place).to_pylist()]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def hidden(text: str, cost: GuessCost, mask: str = "[secret]", costly: float = COSTLY) -> str:
    spans = sorted((s, e) for s, _, e in {*base_spans(text), *guessed_spans(text, cost, costly)})
    out, done, i = [], 0, 0
    while i < len(spans):
        start, end = spans[i]
        while i < len(spans) and spans[i][0] < end:
            end = max(end, spans[i][1])
            i += 1
        out += [text[done:start], mask]
        done = end
    return "".join([*out, text[done:]])
