"""Mixing against a loop over the tree, neighbours against brute force, and SQL for what has it."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import awkward
import compare
import numpy as np
import pytest
from conftest import TINY
from pyspark.sql import functions as F

from tripweave.llm import ann, mixing, queries
from tripweave.llm.common import table


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
@pytest.mark.parametrize("folder", [TINY, "/root/testdata/sf0.01"])
def test_query_matches_sql(spark, name, folder):
    assert compare.spark_side(spark, folder, name) == compare.oracle_side(compare.connect(folder), name)


def dealt(children, budget):
    """{name: (capacity, weight)} to {name: share}, one round after another."""
    given, open_ = {}, dict(children)
    while open_:
        left, weights = budget - sum(given.values()), sum(w for _, w in open_.values())
        full = {n: c for n, (c, w) in open_.items() if c * weights <= left * w}
        if not full:
            return given | {n: left * w // weights for n, (_, w) in open_.items()}
        given |= full
        open_ = {n: x for n, x in open_.items() if n not in full}
    return given


def test_shares_go_to_siblings_before_ancestors(spark):
    rows = [("a", "x", 10), ("a", "y", 1000), ("b", "x", 5), ("b", "y", 5), ("c", "x", 900)]
    frame = spark.createDataFrame(rows, "domain string, lang string, capacity long")
    budget = frame.withColumn("budget", F.lit(300).cast("long"))
    got = {(r["domain"], r["lang"]): r["share"] for r in mixing.shared(budget, ("domain",), "lang", {"x": 3}).collect()}
    for domain in "abc":
        children = {lang: (c, {"x": 3}.get(lang, 1)) for d, lang, c in rows if d == domain}
        assert {lang: got[domain, lang] for lang in children} == dealt(children, 300)
    assert got["a", "x"] == 10 and got["a", "y"] == 290  # a sibling takes what x cannot give


def test_mixture_by_hand(spark):
    recipe = mixing.Recipe(share=60, epochs=3, seed=5)
    tokens = [tuple(r) for r in mixing.tokens_of(table(spark, TINY, "documents")).collect()]
    own = defaultdict(int)
    for _, *leaf, n in tokens:
        own[tuple(leaf)] += n
    capacity = {leaf: 3 * n for leaf, n in own.items() if n}
    budget = sum(own.values()) * 60 // 100
    weights = (recipe.domains, recipe.languages, recipe.sources)

    def deal(prefix, budget):
        names = {leaf[len(prefix)] for leaf in capacity if leaf[: len(prefix)] == prefix}
        children = {
            n: (sum(c for leaf, c in capacity.items() if leaf[: len(prefix) + 1] == (*prefix, n)), weights[len(prefix)].get(n, 1))
            for n in names
        }
        for name, share in dealt(children, budget).items():
            yield from deal((*prefix, name), share) if len(prefix) < 2 else [((*prefix, name), share)]

    expected = Counter()
    for leaf, share in deal((), budget):
        docs = [(i, n) for i, *own_leaf, n in tokens if tuple(own_leaf) == leaf and n]
        for epoch in range(3):
            order = sorted(docs, key=lambda d: (int(hashlib.md5(f"5:{epoch}:{d[0]}".encode()).hexdigest()[:15], 16), d[0]))
            for doc_id, n in order:
                if share > 0:
                    expected[doc_id, *leaf, epoch, n, min(n, share)] += 1
                share -= n
    got = mixing.mixed(mixing.tokens_of(table(spark, TINY, "documents")), recipe).collect()
    assert Counter(map(tuple, got)) == expected


def test_mixing_awkward_rows(spark):
    docs = awkward.documents(spark)
    taken = mixing.mixed(mixing.tokens_of(docs)).collect()
    assert taken and all(0 < r["taken_tokens"] <= r["tokens"] for r in taken)
    assert mixing.mixed(mixing.tokens_of(awkward.empty(spark))).count() == 0
    everything = mixing.kept(docs, mixing.Recipe(share=100, epochs=1))
    words = [r for r in docs.collect() if any(c not in " \t\n\x0b\x0c\r" for c in r["text"] or "")]
    assert everything.columns == docs.columns and awkward.by_row(everything) == sorted(map(tuple, words), key=repr)
    assert mixing.kept(awkward.empty(spark), mixing.Recipe(epochs=1)).count() == 0


def test_kept_documents_are_the_taken_ones(spark):
    docs, recipe = table(spark, TINY, "documents"), mixing.Recipe(share=50, epochs=1)
    taken = sorted(r["doc_id"] for r in mixing.mixed(mixing.tokens_of(docs), recipe).collect())
    assert sorted(r["doc_id"] for r in mixing.kept(docs, recipe).collect()) == taken


def nearest_by_hand(rows, asked, k):
    rows = [(i, v) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, vector in {i: v for i, v in rows if i in asked}.items():
        scored = []
        for i, v in rows:
            if i != q and len(v) == len(vector):
                scored.append((-sum(float(a) * float(b) for a, b in zip(vector, v)), i))
        out[q] = sorted(scored)[:k]
    return out


def recall(got, expected):
    found = Counter()
    for r in got:
        found[r["query_id"], r["vec_id"]] += 1
    wanted = Counter((q, i) for q, own in expected.items() for _, i in own)
    return sum((found & wanted).values()) / max(1, sum(wanted.values()))


def checked(got, expected, k):
    by_query = defaultdict(list)
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by_query[r["query_id"]].append(r)
    assert {q for q, own in expected.items() if own} == set(by_query)
    for q, own in by_query.items():
        assert [r["rank"] for r in own] == list(range(1, len(own) + 1)) and len(own) == len(expected[q])
        order = [(-r["score"], r["vec_id"]) for r in own]
        assert order == sorted(order)


def test_neighbours_of_the_given_vectors(spark):
    vectors = table(spark, TINY, "embeddings", "vec_id", "embedding")
    rows = [tuple(r) for r in vectors.collect()]
    expected = nearest_by_hand(rows, {i for i, _ in rows if i % 20 == 0}, 20)
    got = queries.op4_nearest_neighbours(spark, TINY).collect()
    checked(got, expected, 20)
    assert recall(got, expected) >= 0.95
    exact = {(q, i): -s for q, own in expected.items() for s, i in own}
    assert all(r["score"] == pytest.approx(exact[r["query_id"], r["vec_id"]], abs=1e-12) for r in got if (r["query_id"], r["vec_id"]) in exact)


@pytest.mark.parametrize("norms", [False, True])
def test_neighbours_over_many_shards(spark, monkeypatch, norms):
    monkeypatch.setattr(ann, "SHARD_ROWS", 200)
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((12, 16))
    data = centres[rng.integers(0, 12, 3000)] + rng.standard_normal((3000, 16)) * 0.3
    if norms:
        data *= rng.uniform(0.2, 3, (3000, 1))
    data[:700] = data[0]  # a group of equal vectors
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest(frame, frame.where("vec_id % 50 = 0"), 10).collect()
    expected = nearest_by_hand(rows, set(range(0, 3000, 50)), 10)
    checked(got, expected, 10)
    assert recall(got, expected) >= 0.9
    of_equal = [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == 50), key=lambda r: r["rank"])]
    if not norms:
        assert len(of_equal) == 10


def test_neighbours_of_awkward_vectors(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [None, 1.0]),
        (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (None, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]), (9, [-1.0, 5.0]),
        (10, [1.0, 0.0]), (20, [0.5, 0.5]),
    ]
    made = [(*row, 1, 2, 3) for row in rows]
    frame = spark.createDataFrame(made, "vec_id long, embedding array<double>, cell int, shard int, rank int")
    got = ann.nearest(frame, frame).collect()
    expected = nearest_by_hand(rows, {i for i, _ in rows}, 20)
    checked(got, expected, 20)
    assert recall(got, expected) == 1
    assert ann.nearest(frame.limit(0), frame.limit(0)).count() == 0
