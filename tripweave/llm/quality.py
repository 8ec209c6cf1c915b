"""Quality rules: how much more likely a text is under a trusted corpus than under the raw one.

Texts are hashed byte n-grams. Two multinomials over the buckets are counted, one over
trusted documents and one over all documents; a document's score is the mean logarithm of
their ratio over its n-grams. Ratios are whole numbers of 2**-20, so sums are exact and
every run judges every document alike. The threshold lies a margin below a low quantile of
the scores of trusted documents, so only texts clearly unlike them go.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import marks, pieces, settled, utf8, with_mark

GRAM = 4
BUCKETS = 1 << 15
SCALE = 1 << 20
BIN = 1 << 10
SCORED_BYTES = 2 << 20
LEVELS = 12  # sets of marks that tell trusted ids from others; 2 MB each, far fewer are needed
MISSED = 0.002  # share of trusted documents that may fall below the threshold
MARGIN = 0.25  # natural logarithm per n-gram by which the threshold lies below that share
SYMBOLS = "#*$%&|<>"  # fixed value
SPACES = " \t\n\v\f\r"  # fixed value: x20 and x09 to x0D


@dataclass(frozen=True)
class Model:
    """Scaled log ratio per bucket, and the scaled score from which a document is kept."""

    ratios: np.ndarray
    threshold: int


def _buckets(data: np.ndarray) -> np.ndarray:
    """The bucket of the n-gram that starts at each byte (but for the last ones)."""
    n = max(0, len(data) - GRAM + 1)
    gram = np.zeros(n, np.uint32)
    for i in range(GRAM):
        gram |= data[i : i + n].astype(np.uint32) << np.uint32(8 * i)
    return (gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKETS.bit_length() + 1)


def _inside(bounds: np.ndarray, n: int) -> np.ndarray:
    """Which n-grams lie within one row."""
    inside = np.ones(n, bool)
    for back in range(1, GRAM):
        at = bounds[1:-1] - back
        inside[at[(at >= 0) & (at < n)]] = False
    return inside


def counts(docs: DataFrame) -> DataFrame:
    """``bucket, raw, target`` over all of ``docs`` (``trusted`` boolean, ``text``); tasks add up before the shuffle."""

    def run(batches):
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in pieces(batches, limit=SCORED_BYTES):
            data, bounds = utf8(batch.column(1))
            own = _buckets(data)
            inside = _inside(bounds, len(own))
            total[0] += np.bincount(own[inside], minlength=BUCKETS)
            trusted = np.repeat(np.array(batch.column(0).to_pylist(), bool), np.diff(bounds))[: len(own)]
            total[1] += np.bincount(own[inside & trusted], minlength=BUCKETS)
        seen = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(seen), *(pa.array(t[seen]) for t in total)], ["bucket", "raw", "target"])

    tallied = docs.select("trusted", "text").mapInArrow(run, "bucket long, raw long, target long")
    return tallied.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def ratios(rows) -> np.ndarray:
    """Scaled logarithms of target over raw probability, smoothed by one count per bucket."""
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    for bucket, r, t in rows:
        raw[bucket] += r
        target[bucket] += t
    if target.sum() == BUCKETS:  # nothing trusted: no document is told from another
        return np.zeros(BUCKETS, np.int64)
    return np.round((np.log(target / target.sum()) - np.log(raw / raw.sum())) * SCALE).astype(np.int64)


def scores(data: np.ndarray, bounds: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """The scaled mean log ratio of every row; 0 for a row without an n-gram."""
    own = ratio[_buckets(data)]
    upto = np.concatenate(([0], np.cumsum(own)))
    starts, stops = bounds[:-1], np.maximum(bounds[:-1], bounds[1:] - GRAM + 1)
    return (upto[np.minimum(stops, len(own))] - upto[np.minimum(starts, len(own))]) // np.maximum(1, stops - starts)


def features(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    words = text.encode().split()
    word_chars = len(text) - sum(map(text.count, SPACES))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        seen, covered = {}, bytearray(len(words))
        for at, window in enumerate(windows):
            first = seen.setdefault(window, at)
            if first != at:
                covered[first : first + 3] = covered[at : at + 3] = b"\1\1\1"
        repeated = covered.count(1)
    return len(words), word_chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of all documents of quality 1."""
    return labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()


def told(docs: DataFrame, labels: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``trusted, text`` of every row of ``docs``; ids move, texts stay where they are.

    A set of marks holds all trusted ids, the next one the other ids that the first marks by chance, the next one
    the trusted ids that the second marks by chance, and so on, until no id is marked by chance: how many sets in a row
    mark an id then tells on which side it is. Ids that ``levels`` sets leave open are told by an exact join.
    """
    good = settled(trusted_ids(labels), "trusted_ids").withColumn("good", F.lit(True))
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct().join(good, "doc_id", "left")
    ids = settled(ids.select("doc_id", F.coalesce("good", F.lit(False)).alias("trusted")), "ids")
    held, others = ids.where("trusted").select("doc_id"), ids.where("NOT trusted").select("doc_id")
    rows = docs.select("doc_id", "text").withColumn("hits", F.when(F.col("doc_id").isNull(), 0))
    for level in range(levels):
        key = F.xxhash64(F.lit(level), "doc_id")
        marked = marks(held.select(key.alias("key")))
        rows = with_mark(rows, key, marked).withColumn("hits", F.when(F.col("hits").isNull() & ~F.col("mark"), level).otherwise(F.col("hits")))
        rows = rows.drop("mark")
        wrong = settled(with_mark(others, key, marked).where("mark").select("doc_id"), "wrong")
        held, others = wrong, held
        if wrong.isEmpty():
            return rows.select(F.expr("coalesce(hits, %d) %% 2 = 1" % (level + 1)).alias("trusted"), "text")
    open_rows = rows.where("hits IS NULL").join(good, "doc_id", "left").select(F.coalesce("good", F.lit(False)).alias("trusted"), "text")
    return rows.where("hits IS NOT NULL").select(F.expr("hits % 2 = 1").alias("trusted"), "text").unionByName(open_rows)


def fit(docs: DataFrame, labels: DataFrame, missed: float = MISSED, levels: int = LEVELS) -> Model:
    """Count both models over all of ``docs`` and all trusted ones, and place the threshold by all trusted ones.

    Only bounded tables reach the driver: the buckets and a histogram of scores.
    """
    marked = told(docs, labels, levels)
    ratio = ratios(counts(marked).collect())

    def run(batches):
        for batch in pieces(batches, 0, SCORED_BYTES):
            passed = batch.column(0)
            sound = np.array([not _failed(text) for text in passed.to_pylist()], bool)
            score = scores(*utf8(passed), ratio)[sound]
            yield pa.RecordBatch.from_arrays([pa.array(score // BIN)], ["bin"])

    histogram = marked.where("trusted").select("text").mapInArrow(run, "bin long").groupBy("bin").count().collect()
    return Model(ratio, _quantile(histogram, missed))


def _failed(text: str | None) -> bool:
    n_words, *_, repeated = features(text or "")
    return base_failed(n_words, repeated)


def _quantile(histogram, missed: float) -> int:
    total, below = sum(n for _, n in histogram), 0
    for at, n in sorted(histogram):
        below += n
        if below > missed * total:
            return at * BIN - round(MARGIN * SCALE)
    return -(2**62)


FIELDS = (
    ("n_words", pa.int64()),
    ("word_chars", pa.int64()),
    ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()),
    ("base_failed", pa.bool_()),
    ("kept", pa.bool_()),
    ("score", pa.float64()),
)


def judged(texts: pa.Array, model: Model) -> list[tuple]:
    found = []
    for text, score in zip(texts.to_pylist(), scores(*utf8(texts), model.ratios).tolist()):
        own = features(text or "")
        failed = base_failed(own[0], own[4])
        found.append((*own, failed, not failed and score >= model.threshold, score / SCALE))
    return found


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """Measures and verdict of every document, one row each, without a shuffle.

    A null text has no words and fails; repeated rows are judged alike; other columns are
    not read. With no trusted document every text that passes the base rules is kept.
    """

    def run(batches):
        for batch in pieces(batches, limit=SCORED_BYTES):
            rows = judged(batch.column(1), model)
            columns = [pa.array([row[i] for row in rows], kind) for i, (_, kind) in enumerate(FIELDS)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *(n for n, _ in FIELDS)])

    return docs.select("doc_id", "text").mapInArrow(
        run,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, score double",
    )


def kept(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""

    place = docs.columns.index("text")

    def run(batches):
        for batch in pieces(batches, place, SCORED_BYTES):
            rows = judged(batch.column(place), model)
            yield batch.filter(pa.array([row[6] for row in rows], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
