"""License scans: short notices found in texts, with a bounded number of edits.

A notice that may be ``k`` edits away is cut into ``k + 1`` pieces; one of them must occur
unchanged. Pieces are searched exactly; around each hit the ``regex`` module's bounded-error
matching checks the edits of the whole notice and gives its span.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tripweave.llm.common import pieces


@dataclass(frozen=True)
class Notice:
    """A notice in lower-case words with single spaces, its label and the edits allowed."""

    words: str
    label: str
    edits: int


# The phrases whose exact places are the base.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
NOTICES = (
    Notice("under the mit license", "mit", 2),
    Notice("apache license version 2", "apache-2", 2),
    Notice("creative commons attribution noncommercial", "cc-by-nc", 3),
    Notice("gnu general public license", "gpl", 2),
    Notice("gnu lesser general public license", "lgpl", 2),
    Notice("mozilla public license", "mpl", 2),
    Notice("redistribution and use in source and binary forms", "bsd", 4),
    Notice("permission is hereby granted free of charge", "mit", 4),
)

# Bytes of words stay, A-Z in lower case; every other byte becomes a space.
_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def normalized(text: bytes) -> tuple[bytes, int]:
    """The words of a text, each between single spaces, and their number."""
    words = text.translate(_WORDS).split()
    return b" " + b" ".join(words) + b" ", len(words)


def places(words: bytes, phrase: str) -> list[int]:
    """Numbers of the words at which a phrase starts."""
    sought, found, at, counted, spaces = f" {phrase} ".encode(), [], -1, 0, 0
    while (at := words.find(sought, at + 1)) >= 0:
        spaces += words.count(b" ", counted, at)
        counted = at
        found.append(spaces)
    return found


@lru_cache(64)
def _search(notice: Notice) -> tuple[list[bytes], regex.Pattern, list[int], regex.Pattern]:
    text, parts = notice.words, notice.edits + 1
    cuts = [len(text) * i // parts for i in range(parts + 1)]
    seeds = [text[a:b].encode() for a, b in zip(cuts, cuts[1:])]
    pattern = rf"(?<![^ ])(?:{regex.escape(text, special_only=True)}){{e<={notice.edits}}}(?![^ ])"
    return seeds, regex.compile(f"(?b){pattern}"), cuts[:-1], regex.compile(pattern)


def fuzzy(words: bytes, notices: tuple[Notice, ...] = NOTICES) -> list[tuple[str, int, int, int]]:
    """(label, first word, words, edits) of every place that is within a notice's edits; of overlapping ones the best."""
    found = []
    for notice in notices:
        seeds, best, offsets, first = _search(notice)
        windows = []
        for seed, offset in zip(seeds, offsets):
            at = -1
            while (at := words.find(seed, at + 1)) >= 0:
                # in bytes: an inserted character may take four
                reach = 4 * notice.edits + 2
                windows.append((max(0, at - offset - reach), at - offset + len(notice.words) + reach))
        counted = spaces = 0  # so far; windows and matches ascend, so each byte is counted once
        for start, stop in _joined(windows):
            start = _edge(words, start)
            piece = words[start : _edge(words, min(stop, len(words)))].decode("utf-8")
            spaces += words.count(b" ", counted, start)
            counted, inside, seen = start, 0, 0
            for match in _matches(first, best, piece, len(notice.words) + notice.edits):
                inside += piece.count(" ", seen, match.start())
                seen, word = match.start(), spaces + inside - 1
                found.append((notice.label, max(0, word), match[0].strip().count(" ") + 1, sum(match.fuzzy_counts)))
    return found


def _matches(first: regex.Pattern, best: regex.Pattern, piece: str, longest: int) -> list[regex.Match]:
    """All matches without overlap, in order.

    From the leftmost match on, the best of those that overlap it is taken, then what lies
    before that and behind it is searched; each search for the best sees few characters.
    """
    found, at = [], 0
    while rough := first.search(piece, at):
        start, stop = rough.start(), piece.find(" ", rough.end() + longest)
        stop, at = len(piece) if stop < 0 else stop, rough.end()
        own = []
        while match := best.search(piece, start, stop):
            if match.start() < rough.end():
                own.append(match)
            stop = match.start()
        if own:
            at = own[0].end()
        found += reversed(own)
    return found


def _edge(words: bytes, at: int) -> int:
    """The next place that starts a character."""
    while at < len(words) and words[at] & 0xC0 == 0x80:
        at += 1
    return at


def _joined(windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    joined: list[tuple[int, int]] = []
    for start, stop in sorted(windows):
        if joined and start <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(stop, joined[-1][1]))
        else:
            joined.append((start, stop))
    return joined


def judged(text: bytes, notices: tuple[Notice, ...] = NOTICES) -> tuple:
    words, count = normalized(text)
    base = [(place, label) for phrase, label in PHRASES.items() for place in places(words, phrase)]
    near = fuzzy(words, notices)
    starts = [place for place, _ in base]
    labels = {label for _, label in base}
    score = 1.0 if base else max((1 - edits / 10 for _, _, _, edits in near), default=0.0)
    return (
        count,
        len(base),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(labels)),
        ",".join(sorted(labels | {label for label, *_ in near})),
        score,
        ",".join(f"{label}:{first}:{length}:{edits}" for label, first, length, edits in sorted(near)),
    )


FIELDS = (
    ("n_words", pa.int64()),
    ("n_base", pa.int64()),
    ("first_word", pa.int64()),
    ("last_word", pa.int64()),
    ("base_labels", pa.string()),
    ("labels", pa.string()),
    ("score", pa.float64()),
    ("spans", pa.string()),
)


def scan(docs: DataFrame, notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """The license notices of every document, one row each, in one pass without a shuffle.

    ``spans`` lists label:first word:words:edits of every fuzzy match; ``score`` is 1 for a
    base phrase, less by a tenth per edit for the best other match, 0 without any. A null
    text is an empty one; repeated rows are scanned each; an empty table gives no rows.
    """

    def run(batches):
        for batch in pieces(batches):
            rows = [judged((text or "").encode(), notices) for text in batch.column(1).to_pylist()]
            columns = [pa.array([row[i] for row in rows], kind) for i, (_, kind) in enumerate(FIELDS)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *(n for n, _ in FIELDS)])

    return docs.select("doc_id", "text").mapInArrow(
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, spans string",
    )
