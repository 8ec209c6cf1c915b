"""SimHash and suffix dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import awkward
import numpy as np
import pytest
import xxhash
from conftest import TINY
from pyspark.sql import functions as F

from tripweave.llm import queries, simhash, suffixes
from tripweave.llm.common import components, table

WORDS = ("alpha", "beta", "gamma", "d", "ee", "été")


def fingerprint_by_hand(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped_by_hand(rows):
    prints = [fingerprint_by_hand(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 2 and find(i) != find(j):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return Counter((doc_id, f"{p:016x}", least.get(find(i))) for i, ((doc_id, _), p) in enumerate(zip(rows, prints)))


def near_copies(rng, n=150):
    base = [" ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(400)) for _ in range(5)]
    texts = []
    for i in range(n):
        words = base[i % 5].split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = "x"
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("kind", ["given", "awkward", "near"])
def test_simhash(spark, kind):
    if kind == "given":
        docs = table(spark, TINY, "documents")
    else:
        docs = awkward.documents(spark, awkward.TEXTS if kind == "awkward" else near_copies(random.Random(1)))
    found = simhash.near_duplicates(docs).select("doc_id", simhash.hex_digits("fp"), "component_id")
    assert Counter(map(tuple, found.collect())) == grouped_by_hand(awkward.texts_of(docs))


def test_simhash_links_whatever_is_within_two_bits(spark):
    rng = np.random.default_rng(5)
    seeds = rng.integers(-(2**63), 2**63, 20)
    prints = {int(np.int64(s) ^ np.int64(sum(np.uint64(1) << np.uint64(b) for b in rng.integers(0, 64, 2)).view(np.int64))) for s in seeds for _ in range(12)}
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    joined = components(simhash.links(frame)).collect()
    got = {r["node"]: r["component"] for r in joined}
    apart = [p for p in prints if all(p == q or ((p ^ q) & (2**64 - 1)).bit_count() > 2 for q in prints)]
    assert set(got) == prints - set(apart)
    for p in got:
        for q in got:
            if ((p ^ q) & (2**64 - 1)).bit_count() <= 2:
                assert got[p] == got[q]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(5, 5), (2000, 2001), (2000, 2001)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert {n: got[n] for n in range(61)} == dict.fromkeys(range(61), 0)
    assert all(got[1000 + i] == 1000 for i in range(80)) and got[2001] == 2000
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_one_of_each(spark):
    docs = awkward.documents(spark)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    groups = {(p, c) for _, p, c in grouped_by_hand(awkward.texts_of(docs))}  # here a fingerprint is a group
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(c for _, c in groups)
    assert set(awkward.by_row(kept.withColumn("ids", F.hex("ids")))) <= set(awkward.by_row(docs.withColumn("ids", F.hex("ids"))))
    assert simhash.one_of_each(awkward.empty(spark)).count() == 0


def removed_by_hand(rows):
    rows = sorted((-(2**63) if i is None else i, (t or "").encode()) for i, t in rows)
    seen, out = {}, []
    for doc_id, text in rows:
        mark = bytearray(len(text))
        for at in range(len(text) - 99):
            window = text[at : at + 100]
            if window in seen:
                mark[at : at + 100] = b"\1" * 100
            else:
                seen[window] = 1
        kept = bytes(b for b, m in zip(text, mark) if not m)
        spans = sum(1 for at, m in enumerate(mark) if m and (at == 0 or not mark[at - 1]))
        out.append((None if doc_id == -(2**63) else doc_id, len(text), sum(mark), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def repeating(rng):
    rows = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 120)))) for i in range(60)]
    base = " ".join(rng.choice(WORDS) + str(rng.randrange(9)) for _ in range(120))
    rows += [(100 + i, base[: rng.randint(50, 400)] + str(i) + base[rng.randint(0, 50) : rng.randint(100, 500)]) for i in range(60)]
    return rows + [
        (300, "a" * 5000), (301, "ab" * 3000), (302, None), (303, ""), (None, base), (304, "a" * 99), (305, "a" * 100),
        (306, "b" + "a" * 101), (307, "日本語" * 60), (308, base * 3),
    ]


@pytest.mark.parametrize("kind", ["given", "made", "edited"])
def test_suffix_dedup(spark, kind):
    if kind == "given":
        rows = awkward.texts_of(table(spark, TINY, "documents"))
    elif kind == "made":
        rows = repeating(random.Random(2))
    else:
        rows = list(enumerate(near_copies(random.Random(3), 40)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, suffixes.measure(docs).collect())) == removed_by_hand(rows)


def test_suffix_dedup_over_many_small_batches(spark, monkeypatch):
    """Small batches and levels: what meets only across batches and levels is found all the same."""
    rng = random.Random(4)
    rows = repeating(rng)
    texts = [(i, 0, t) for i, t in rows if t and i is not None]
    family, gone = suffixes.Family(), 0
    entries = []
    for doc, part, text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        start, lead, count, key, extent = suffixes.runs(data, np.array([0, len(data)]))
        columns = (key.view(np.int64), extent.view(np.int64), np.full(len(start), doc), np.zeros(len(start), np.int32))
        entries.append(suffixes.Entries(*columns, suffixes.packed(start, lead, count, suffixes.ENTRY)))
    order = list(range(len(entries)))
    rng.shuffle(order)
    repeats = suffixes.Entries.joined([family.add(entries[i]) for i in order])
    together = suffixes.Entries.joined(entries).sorted()
    same, _ = suffixes.scanned(together)
    expected = Counter(zip(*(c[same].tolist() for c in together.columns[:5])))
    assert Counter(zip(*(c.tolist() for c in repeats.columns[:5]))) == expected
    sizes = [len(level) for level in family.levels]
    assert all(a >= 2 * b for a, b in zip(sizes[:-2], sizes[1:-1]))


def test_suffix_dedup_of_awkward_rows(spark):
    docs = awkward.documents(spark)
    rows = awkward.texts_of(docs)
    got = suffixes.measure(docs).collect()
    assert Counter((r["doc_id"], r["n_bytes"]) for r in got) == Counter((i, len((t or "").encode())) for i, t in rows)
    assert len({tuple(r) for r in got if r["doc_id"] == 5}) == 1  # equal rows of one id count once
    assert suffixes.measure(awkward.empty(spark)).count() == 0
    whole = {r["doc_id"]: bytes(r["kept"]) for r in suffixes.cut(spark.createDataFrame(rows[:9], "doc_id long, text string")).collect()}
    assert whole[4] == b"a" and whole[7] == "naïve café 日本語 😀".encode()


def test_registered(spark):
    assert set(queries.op8_simhash(spark, TINY).columns) == {"doc_id", "fingerprint", "component_id"}


def test_suffix_dedup_keeps_the_text_of_repeated_rows(spark):
    """Equal rows of one id are one document, in one batch and across batches."""
    rng = random.Random(9)
    rows = repeating(rng)
    again = [row for row in rows if row[0] is None or row[0] % 3 == 0]
    expected = removed_by_hand(rows)
    expected = Counter({row: n * (1 + (row[0] is None or row[0] % 3 == 0)) for row, n in expected.items()})
    alone = " ".join(f"only{rng.randrange(10**6)}" for _ in range(60))
    docs = spark.createDataFrame(rows + again + [(900, alone)] * 2, "doc_id long, text string")
    expected[(900, len(alone), 0, 0, hashlib.sha256(alone.encode()).hexdigest())] = 2
    for parts in (1, 7):
        assert Counter(map(tuple, suffixes.measure(docs.repartition(parts)).collect())) == expected
    kept = suffixes.cut(docs).where("doc_id = 900").collect()
    assert [bytes(r["kept"]).decode() for r in kept] == [alone] * 2
