"""The pipeline's near-duplicate stage against all pairs."""

from __future__ import annotations

import random

import awkward
import corpus_pipeline as pipeline
import numpy as np
import pytest
from conftest import TINY
from pyspark.sql import functions as F

from tripweave.llm import alike, common, simhash
from tripweave.llm.common import shipped


def shingles_by_hand(text):
    """Runs of five words (A-Z lower, ASCII white space between), all words if there are fewer, none without words."""
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def edited(rng, n=60):
    """Ten texts of 200 words of which half is one passage, each in six versions of up to five edits."""
    shared = [f"s{rng.randrange(500)}" for _ in range(100)]
    texts = []
    for i in range(n):
        own = random.Random(i % 10)
        words = shared + [f"w{own.randrange(500)}" for _ in range(100)]
        for _ in range(i // 10):
            words[rng.randrange(len(words))] = "x"
        texts.append(" ".join(words))
    return texts


def alike_by_hand(texts):
    """The place of the first text of every group."""
    sets, root = [shingles_by_hand(t) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * (n := len(a & sets[j])) >= 4 * (len(a) + len(sets[j]) - n):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {find(i) for i in range(len(texts))}


def test_texts_alike_at_eight_tenths_go(spark):
    texts = edited(random.Random(6))
    staying = alike_by_hand(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = [r["doc_id"] for r in pipeline.drop_near_duplicates(spark, docs, TINY).collect()]
    assert sorted(kept) == sorted(staying) and len(kept) < len(texts)
    assert simhash.one_of_each(docs).count() > len(kept)  # two bits leave near copies


def versions(rng, n, words, least, most):
    """Versions of one text with some words replaced, most of them not alike at 0.8, many joined through others."""
    base = [f"w{rng.randrange(10_000)}" for _ in range(words)]
    texts = []
    for i in range(n):
        own = list(base)
        for place in rng.sample(range(words), rng.randint(least, most)):
            own[place] = f"x{i}.{place}"
        texts.append(" ".join(own))
    return texts


def kept(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return sorted(r["doc_id"] for r in simhash.one_of_each(docs, alike.grouped).collect())


@pytest.mark.parametrize("words, least, most", [(400, 3, 8), (300, 4, 6)])
@pytest.mark.parametrize("block", [40, 512])
def test_wide_groups_lose_no_link(spark, monkeypatch, words, least, most, block):
    """With blocks of 40 sets, pivots and blocks that meet blocks; with 512 sets, one matrix."""
    shipped(spark)
    monkeypatch.setattr(alike, "BLOCK", block)
    rng = random.Random(words)
    texts = versions(rng, 400, words, least, most) + versions(rng, 150, words, 0, 1) + edited(rng, 30)
    staying = sorted(alike_by_hand(texts))
    assert kept(spark, texts) == staying and 40 < len(staying) < len(texts) - 150


def test_similarity_is_exact():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 60))).astype("<u8") for _ in range(150)]
    sets += [np.arange(10_000, dtype="<u8"), np.arange(2_000, 10_000, dtype="<u8"), np.arange(2_001, 10_000, dtype="<u8"), sets[0][:0]]
    found = alike.alike_in(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            shared = len(np.intersect1d(a, b))
            assert found[i, j] == found[j, i] == (5 * shared >= 4 * max(1, len(a) + len(b) - shared))
    assert found[150, 151] and not found[150, 152]


def test_awkward_rows(spark):
    shipped(spark)
    docs = awkward.documents(spark)
    rows = sorted(awkward.texts_of(docs), key=lambda r: (r[0] is None, r[0] or 0))
    staying = [rows[i] for i in alike_by_hand([t for _, t in rows])]
    got = simhash.one_of_each(docs, alike.grouped)
    assert got.columns == docs.columns
    found = awkward.texts_of(got)
    # of rows that share an id, which comes first is a matter of the hash of their texts
    assert sorted(repr(i) for i, _ in found) == sorted(repr(i) for i, _ in staying)
    assert sorted(map(repr, map(shingles_by_hand, (t for _, t in found)))) == sorted(
        map(repr, map(shingles_by_hand, (t for _, t in staying)))
    )
    assert {r for r in map(repr, found)} <= {r for r in map(repr, rows)}
    assert simhash.one_of_each(awkward.empty(spark), alike.grouped).count() == 0


@pytest.mark.parametrize("size", [1 << 24, 1 << 16])
def test_marks_miss_nothing(spark, monkeypatch, size):
    shipped(spark)
    monkeypatch.setattr(common, "MARKS", size)
    keys = spark.range(-3000, 3000).select(F.xxhash64("id").alias("key"), "id")
    rows = common.with_mark(keys, F.col("key"), common.marks(keys.where("id % 3 = 0")))
    counts = {(r["marked"], r["mark"]): r["count"] for r in rows.groupBy((F.col("id") % 3 == 0).alias("marked"), "mark").count().collect()}
    assert (True, False) not in counts and counts[True, True] == 2000
    assert counts[False, False] > (3990 if size > 1 << 20 else 3500)
    assert common.with_mark(keys, F.col("key"), common.marks(keys.limit(0))).where("mark").count() == 0


def test_sets_meet_by_fingerprints_without_any_band(spark, monkeypatch):
    """Ball hashing alone brings near copies of long texts together, and what it brings is compared exactly."""
    rng = random.Random(12)
    texts = []
    for _ in range(5):
        words = [f"w{rng.randrange(50_000)}" for _ in range(2500)]
        texts += [" ".join(words), " ".join([*words[:-1], "other"]), " ".join([*words[:-1], "third"])]
    texts += ["", "   ", "a b c", "x y z"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    own = alike.sketched(docs)
    plain = own.withColumn("bands", F.array().cast("array<bigint>"))
    rows = {r["node"]: r["fp"] for r in own.collect()}
    met = {(r["u"], r["v"]) for r in alike.meetings(plain).collect()}
    assert met and all(v < u for u, v in met)
    # every pair within two bits is joined, if through others
    root = {n: n for n in rows}

    def find(n):
        return n if root[n] == n else find(root[n])

    for u, v in met:
        root[find(u)] = find(v)
        assert rows[u] is not None and bin((rows[u] ^ rows[v]) & (2**64 - 1)).count("1") <= simhash.RADIUS
    sound = [(n, fp) for n, fp in rows.items() if fp is not None]
    assert all(find(a) == find(b) for a, x in sound for b, y in sound if bin((x ^ y) & (2**64 - 1)).count("1") <= simhash.RADIUS)
    assert kept(spark, texts) == sorted(alike_by_hand(texts))
