"""Language identification by rank-order profiles of character n-grams.

A profile is a language's most frequent n-grams in order. A document's own most frequent
n-grams are compared with each profile: an n-gram costs as many places as it is out of
place, one that the profile lacks costs the most. The language with the least sum wins.

n-grams have one to three characters of lower-case words padded with a space, held as
one integer of 21 bits a character, so nothing is hashed and any script works.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.common import pieces

PROFILE = 300  # n-grams of a profile: the feature of the method
UNKNOWN = "und"
SLICE = 1 << 20
HELD = 1 << 20  # n-grams that a task holds before it passes them on
SPACE = np.uint32(0x20)


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngrams(text: str) -> np.ndarray:
    """All n-grams of the words of a text, repeats included."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = _letters()[points]
    points = np.concatenate(([SPACE], np.where(letters, points, SPACE), [SPACE]))
    space = points == SPACE
    kept = np.ones(len(points), bool)
    kept[1:] = ~(space[1:] & space[:-1])
    a, space = points[kept].astype(np.int64), space[kept]
    if len(a) < 3:
        return np.zeros(0, np.int64)
    one = a[~space] << 42
    two = (a[:-1] << 42) | (a[1:] << 21)
    three = ((a[:-2] << 42) | (a[1:-1] << 21) | a[2:])[~space[1:-1]]
    return np.concatenate((one, two, three))


def counted(grams: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams in order, and how often each occurs (or the sum of its ``counts``)."""
    if counts is None:
        grams = np.sort(grams)
    else:
        order = np.argsort(grams, kind="stable")
        grams, counts = grams[order], counts[order]
    if not len(grams):
        return grams, np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
    sums = np.diff(np.append(first, len(grams))) if counts is None else np.add.reduceat(counts, first)
    return grams[first], sums


def tallied(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a whole text and their counts, a slice at a time.

    A slice goes on where the one before it ended, in the middle of a word too: the last two symbols are
    carried over, and only n-grams that end in the slice are its own.
    """
    text, parts, carried = text.lower(), [], np.array([SPACE])
    for at in range(0, len(text) + 1, SLICE):
        points = np.frombuffer(text[at : at + SLICE].encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols = np.where(_letters()[points], points, SPACE)
        if at + SLICE > len(text):
            symbols = np.append(symbols, SPACE)
        symbols = np.concatenate((carried, symbols))
        space = symbols == SPACE
        kept = np.ones(len(symbols), bool)
        kept[1:] = ~(space[1:] & space[:-1])
        symbols = symbols[kept]
        parts.append(counted(_ending_after(symbols.astype(np.int64), len(carried))))
        carried = symbols[-2:]
    return parts[0] if len(parts) == 1 else merged(parts)


def _ending_after(a: np.ndarray, first: int) -> np.ndarray:
    """The n-grams of a run of symbols that end at its place ``first`` or later."""
    word = a != SPACE
    one = a[first:][word[first:]] << 42
    two = ((a[:-1] << 42) | (a[1:] << 21))[first - 1 :]
    three = ((a[:-2] << 42) | (a[1:-1] << 21) | a[2:])
    return np.concatenate((one, two, three[max(0, first - 2) :][word[1:-1][max(0, first - 2) :]]))


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return counted(*(np.concatenate(x) for x in zip(*parts)))


def frequent(text: str, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams of a text, commonest first; ties go to the smaller n-gram."""
    distinct, counts = tallied(text)
    return distinct[np.argsort(-counts, kind="stable")[:size]]


def learn(docs: DataFrame, size: int = PROFILE) -> DataFrame:
    """``lang, ngram, place`` (from 0): the profiles of all languages in ``docs``, counted over all of its texts.

    Rows without a language or a text teach nothing. Every task adds up its own counts
    before they are shuffled, and no language is gathered in one task.
    """

    def run(batches):
        held = {}
        for batch in pieces(batches, limit=SLICE):
            langs, texts = (np.array(batch.column(i).to_pylist(), object) for i in (0, 1))
            for lang in dict.fromkeys(langs):
                own = tallied("\n".join(texts[langs == lang]))
                held[lang] = merged([held[lang], own]) if lang in held else own
            if sum(len(grams) for grams, _ in held.values()) > HELD:
                yield from _tables(held)
                held = {}
        yield from _tables(held)

    usable = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    counts = usable.mapInArrow(run, "lang string, ngram long, n long").groupBy("lang", "ngram").agg(F.sum("n").alias("n"))
    # compared as it is, so that every task drops all but the first ones before the shuffle
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "ngram"))
    first = counts.withColumn("rank", rank).where(F.col("rank") <= size)
    return first.select("lang", "ngram", (F.col("rank") - 1).alias("place"))


def _tables(held):
    for lang, (grams, counts) in held.items():
        columns = [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "ngram", "n"])


class Profiles:
    """Profiles in the form in which tasks use them: per language sorted n-grams and their places."""

    def __init__(self, rows, size: int = PROFILE):
        self.size, grouped = size, {}
        for lang, ngram, place in rows:
            grouped.setdefault(lang, []).append((ngram, place))
        self.langs = sorted(grouped)
        tables = [np.array(sorted(grouped[lang]), np.int64).reshape(-1, 2) for lang in self.langs]
        self.grams, self.places = [t[:, 0].copy() for t in tables], [t[:, 1].copy() for t in tables]

    def classify(self, text: str | None) -> tuple[str, float]:
        """The nearest language and how near it is (0 to 1); ties go to the first name."""
        own = frequent(text, self.size) if text else ()
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0
        ranks, costs = np.arange(len(own)), []
        for grams, places in zip(self.grams, self.places):
            at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
            costs.append(int(np.where(grams[at] == own, np.abs(places[at] - ranks), self.size).sum()))
        best = int(np.argmin(costs))
        return self.langs[best], 1 - costs[best] / (self.size * len(own))


def predict(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row, from its text alone, without a shuffle.

    ``und`` with score 0 where the text is null or has no letter (or nothing was learnt).
    ``profiles`` holds ``PROFILE`` rows for each language, which bounds what tasks receive.
    """

    def run(batches):
        for batch in pieces(batches):
            found = [profiles.classify(text) for text in batch.column(1).to_pylist()]
            columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(doc_id):
    """Documents never learnt from; a null id is not among them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
