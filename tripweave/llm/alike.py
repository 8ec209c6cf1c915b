"""Near-duplicates by the Jaccard similarity of five-word shingles, for the pipeline's stage.

Every distinct shingle set has a SimHash fingerprint and is sketched by ``BANDS`` bands of ``ROWS`` minima. Sets
whose fingerprints meet by ball hashing (``simhash.links``) or that share a band, directly or through others, make
a neighbourhood; no link leaves it. In a neighbourhood
of up to ``BLOCK`` sets the similarity of all of them is counted exactly, in one matrix product. A
larger one is first thinned: every set is compared with one pivot, the least set it meets. What
the pivots join into the largest group need not be compared among itself; the rest, dealt
out in blocks, meets all blocks, so no similar pair of a neighbourhood is missed.

Texts stay where they are until neighbourhoods are known. Then those of one row for each set in a
neighbourhood move. Only links that join groups leave a block, never all pairs.

A null, empty or blank text has no shingles; all such texts are one group. Texts of fewer than
five words are alike only if their words are the same. Rows that repeat are members of one set. An
empty table has no groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import components, marks, pieces, settled, with_mark
from tripweave.llm.simhash import SEED, majority, shingles
from tripweave.llm.simhash import links as fingerprint_links

SHINGLE = 5
ALIKE = 0.8
BANDS = 40  # a pair at 0.8 shares a band with probability 0.9994
ROWS = 8
STEP = 1 << 10  # shingles whose minima are looked for together
BLOCK = 512  # sets compared with each other in one task
COLUMNS = 1 << 12  # shingles of a block multiplied at a time


@lru_cache(1)
def _factors() -> np.ndarray:
    return np.random.default_rng(20012).integers(0, 2**63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str | None) -> np.ndarray:
    """Hashes of the distinct five-word shingles of a text, in order."""
    return np.unique(shingles((text or "").encode(), SHINGLE))


def bands(hashes: np.ndarray) -> list[int]:
    """What a set is entered by: a hash of each band's place and minima; nothing for an empty set."""
    if not len(hashes):
        return []
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(hashes), STEP):
        own = hashes[at : at + STEP]
        np.minimum(least, (_factors()[:, None] * own[None, :]).min(axis=1), out=least)
    rows = least.reshape(BANDS, ROWS)
    return [int(np.uint64(xxhash.xxh64_intdigest(row.tobytes(), place)).view(np.int64)) for place, row in enumerate(rows)]


def node(hashes: np.ndarray) -> int:
    """The name of a set; texts of equal sets share it."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).view(np.int64))


def alike_in(sets: list[np.ndarray]) -> np.ndarray:
    """Which of some sets are alike, as a matrix; exact."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.zeros((len(sets), len(sets)), np.float32)  # counts below 2 ** 24 are exact
    met = count[column] > 1
    owner, column = owner[met], (np.cumsum(count > 1) - 1)[column[met]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        first, stop = np.searchsorted(column, [low, low + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[owner[first:stop], column[first:stop] - low] = 1
        shared += part @ part.T
    shared = shared.astype(np.float64)
    return shared >= ALIKE * np.maximum(1, sizes[:, None] + sizes[None, :] - shared)


def block_links(nodes: np.ndarray, sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Links that join the sets of a block which are alike, directly or through others of the block."""
    alike, new = alike_in(sets), np.ones(len(nodes), bool)
    for at in range(len(nodes)):
        if not new[at]:
            continue
        new[at], reached = False, [at]
        while reached:
            for other in np.flatnonzero(alike[reached.pop()] & new).tolist():
                new[other] = False
                reached.append(other)
                yield int(nodes[other]), int(nodes[at])


def sketched(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, node, fp, bands`` for every row, without a shuffle; a set without shingles has no ``fp``."""

    def run(batches):
        for batch in pieces(batches, 2):
            sets = [shingle_set(text) for text in batch.column(2).to_pylist()]
            nodes = pa.array([node(s) for s in sets], pa.int64())
            prints = pa.array([majority(s) if len(s) else None for s in sets], pa.int64())
            entered = pa.array([bands(s) for s in sets], pa.list_(pa.int64()))
            columns = [batch.column(0), batch.column(1), nodes, prints, entered]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "node", "fp", "bands"])

    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return texts.mapInArrow(run, "doc_id long, text_hash long, node long, fp long, bands array<long>")


def meetings(own: DataFrame) -> DataFrame:
    """``u, v``: sets that meet, in a band or by their fingerprints; ``v`` is the lesser one."""
    banded = _least_of(own.select("node", F.explode("bands").alias("key")))
    return banded.unionByName(_close(own.select("node", "fp").where("fp IS NOT NULL"))).distinct()


def _least_of(entered: DataFrame) -> DataFrame:
    """``u, v``: every set and the least set of each of its keys (``node, key``), where that is another."""
    ends = entered.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("greatest")).where("least < greatest")
    # written, so that the join has an exchange on either side and the engine can split a large band
    met = entered.join(settled(ends, "bands"), "key").where("node <> least")
    return met.select(F.col("node").alias("u"), F.col("least").alias("v"))


def _close(prints: DataFrame) -> DataFrame:
    """``u, v``: sets (``node, fp``) that have one fingerprint, or whose fingerprints meet by ball hashing."""
    least = settled(prints.groupBy("fp").agg(F.min("node").alias("node")), "prints")
    ends = [least.select(F.col("fp").alias(side), F.col("node").alias(f"{side}_node")) for side in "uv"]
    met = settled(fingerprint_links(least), "close").join(ends[0], "u").join(ends[1], "v")
    met = met.select(F.greatest("u_node", "v_node").alias("u"), F.least("u_node", "v_node").alias("v"))
    return _least_of(prints.select("node", F.col("fp").alias("key"))).unionByName(met)


def _tasks(frame: DataFrame) -> int:
    return max(int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)


def _compared(rows: DataFrame) -> DataFrame:
    """Links (``u, v``) within the rows (``block, node, text``) of each block."""

    def run(batches):
        block, nodes, sets = None, [], []
        for batch in batches:
            for name, own, text in zip(*(column.to_pylist() for column in batch.columns)):
                if name != block:
                    yield from _linked(nodes, sets)
                    block, nodes, sets = name, [], []
                nodes.append(own)
                sets.append(shingle_set(text))
        yield from _linked(nodes, sets)

    dealt = rows.select("block", "node", "text").repartition(_tasks(rows), "block").sortWithinPartitions("block")
    return dealt.mapInArrow(run, "u long, v long")


def _linked(nodes: list[int], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    found = list(block_links(np.array(nodes, np.int64), sets)) if len(nodes) > 1 else []
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(side, pa.int64()) for side in zip(*found)], ["u", "v"])


def _starred(rows: DataFrame, pivots: DataFrame) -> DataFrame:
    """Links of sets to their pivots (``node, pivot``). A pivot of many sets meets them in slices of a block's size."""
    many = pivots.groupBy("pivot").agg(F.count("*").alias("sets"))
    asked = pivots.join(settled(many, "pivots"), "pivot")
    asked = settled(asked.select("node", "pivot", _piece("node", F.ceil(F.col("sets") / BLOCK)).alias("slice")), "slices")
    key = F.struct("pivot", "slice").alias("block")
    others = rows.join(asked, "node").select(key, F.lit(1).alias("kind"), "node", "text")
    own = asked.select("pivot", "slice").distinct().join(rows.withColumnRenamed("node", "pivot"), "pivot")
    dealt = others.unionByName(own.select(key, F.lit(0).alias("kind"), F.col("pivot").alias("node"), "text"))

    def run(batches):
        pivot, least = None, None
        for batch in batches:
            found = []
            for kind, own, text in zip(*(column.to_pylist() for column in batch.columns)):
                if kind == 0:
                    pivot, least = own, shingle_set(text)
                elif alike_in([least, shingle_set(text)])[0, 1]:
                    found.append((own, pivot))
            columns = list(zip(*found)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(side, pa.int64()) for side in columns], ["u", "v"])

    dealt = dealt.repartition(_tasks(rows), "block").sortWithinPartitions("block", "kind").select("kind", "node", "text")
    return dealt.mapInArrow(run, "u long, v long")


def _piece(node: str, count: Column) -> Column:
    return F.pmod(F.xxhash64(F.col(node)), count.cast("long"))


def _rest(rows: DataFrame, joined: DataFrame) -> DataFrame:
    """``block, node, text``: what the pivots left apart, in blocks that meet all blocks of their neighbourhood."""
    told = rows.drop("text").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    told = settled(told, "apart")
    sizes = told.groupBy("hood", "component").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("hood").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"), F.max("n").alias("inside"), F.sum("n").alias("n")
    )
    largest = largest.where("inside < n").select(
        "hood",
        "main",
        F.ceil((F.col("n") - F.col("inside")) / BLOCK).alias("outer"),
        F.ceil(F.col("inside") / BLOCK).alias("inner"),
    )
    cut = told.join(settled(largest, "largest"), "hood")
    piece = F.when(F.col("component") == F.col("main"), F.col("outer") + _piece("node", F.col("inner")))
    cut = cut.withColumn("piece", piece.otherwise(_piece("node", F.col("outer"))))
    partners = F.when(F.col("piece") < F.col("outer"), F.col("outer") + F.col("inner")).otherwise(F.col("outer"))
    cut = cut.withColumn("partner", F.explode(F.sequence(F.lit(0).cast("long"), partners - 1)))
    block = F.struct("hood", F.least("piece", "partner").alias("one"), F.greatest("piece", "partner").alias("two"))
    return cut.select(block.alias("block"), "node").join(rows.select("node", "text"), "node")


def links(docs: DataFrame, own: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (``u, v``) that join all sets which are alike and meet in a band. ``sets`` names a row for each."""
    met = settled(meetings(own), "meetings")
    hoods = settled(components(met).withColumnRenamed("component", "hood"), "hoods")
    sizes = settled(hoods.groupBy("hood").agg(F.count("*").alias("sets")), "sizes")
    wanted = hoods.join(sizes, "hood").join(sets.select("node", "first.doc_id", "first.text_hash"), "node")
    wanted = settled(wanted.withColumnsRenamed({"doc_id": "id", "text_hash": "hash"}), "wanted")
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    marked = marks(wanted.select(F.xxhash64("id", "hash").alias("key")))
    texts = with_mark(texts, F.xxhash64("doc_id", "text_hash"), marked).where("mark").drop("mark")
    rows = texts.join(wanted, F.expr("doc_id <=> id AND text_hash = hash")).select("node", "hood", "sets", "text")
    rows = settled(rows.dropDuplicates(["node"]) if _repeated(sets) else rows, "compared")
    found = _compared(rows.where(F.col("sets") <= BLOCK).withColumn("block", F.col("hood")))
    large = rows.where(F.col("sets") > BLOCK).select("node", "hood", "text")
    if large.isEmpty():
        return found
    pivots = met.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("pivot")).join(large.select("node"), "node")
    starred = settled(_starred(large, settled(pivots, "stars")), "starred")
    return found.unionByName(starred).unionByName(_compared(_rest(large, components(starred))))


def _repeated(sets: DataFrame) -> bool:
    """Whether a row that stands for a set is there more than once, with its id and text."""
    return not sets.where("repeated").isEmpty()


def grouped(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, component`` for every row; a component is named by its smallest set."""
    own = settled(sketched(docs), "sketched")
    order = F.struct(F.isnull("doc_id").alias("nameless"), "doc_id", "text_hash")
    rows = own.groupBy("node", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    least = rows.groupBy("node").agg(F.min(F.struct(order.alias("order"), F.col("n"))).alias("least"))
    sets = settled(least.select("node", F.col("least.order").alias("first"), F.expr("least.n > 1 AS repeated")), "sets")
    joined = settled(components(links(docs, own, sets)), "joined")
    return own.select("doc_id", "text_hash", "node").join(joined, "node", "left").select(
        "doc_id", "text_hash", F.coalesce("component", "node").alias("component")
    )
