"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``2 r`` bits have a common variant within ``r``
bits of each. Every distinct fingerprint emits all its variants within half the radius;
fingerprints that meet in a variant are linked. A variant has at most as many
fingerprints as there are variants of one, whatever the data, since copies of a
fingerprint are merged first; within a variant neighbours are linked to each other, which
joins all of them without making all pairs.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.common import components, marks, pieces, settled, with_mark

SEED = 42
SHINGLE = 3
RADIUS = 2


def fingerprint(text: bytes) -> int:
    """The fingerprint of a text as a signed long."""
    hashes = shingles(text, SHINGLE)
    return majority(hashes) if len(hashes) else 0


def shingles(text: bytes, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, repeats included; of all words if there are fewer."""
    words = text.lower().split()  # for bytes: A-Z, and the six ASCII spaces
    if not words:
        return np.zeros(0, "<u8")
    joined = b" ".join(words)
    if len(words) < size:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        stops = np.cumsum(lengths + 1) - 1
        starts = stops - lengths
        spans = zip(starts[: len(words) - size + 1].tolist(), stops[size - 1 :].tolist())
        hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans]
    return np.array(hashes, "<u8")


def majority(hashes: np.ndarray) -> int:
    """Each bit that is set in over half of the hashes."""
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        octets = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, fp`` for every row, from its whole text, without a shuffle. A null text has no words."""

    def run(batches):
        for batch in pieces(batches, 2):
            found = [fingerprint((text or "").encode()) for text in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(found, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "fp"])

    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return texts.mapInArrow(run, "doc_id long, text_hash long, fp long")


def links(distinct: DataFrame) -> DataFrame:
    """Verified links (``u``, ``v``) that join all of the distinct ``fp`` within ``RADIUS`` bits of each other."""
    flipped = F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")
    variants = distinct.select("fp", F.explode(flipped).alias("variant"))
    neighbour = F.lag("fp").over(Window.partitionBy("variant").orderBy("fp"))
    met = variants.select("fp", neighbour.alias("other")).where("other IS NOT NULL")
    return met.where(F.bit_count(F.expr("fp ^ other")) <= RADIUS).select(F.col("fp").alias("u"), F.col("other").alias("v")).distinct()


def grouped(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, fp, component`` for every row; a component is named by its smallest fingerprint.

    Copies and repeated rows share a fingerprint, so a large group of them is one node;
    rows get their component by a join whose skew the engine splits.
    """
    own = settled(fingerprints(docs), "fingerprints")
    joined = components(links(own.select("fp").distinct())).withColumnRenamed("node", "fp")
    return own.join(joined, "fp", "left").select("doc_id", "text_hash", "fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, component_id`` for every row; the component's name is its smallest id.

    Rows without an id take part but name no component (one of such rows alone has a null name).
    """
    rows = settled(grouped(docs), "grouped")
    # written, so that the join has an exchange on either side and the engine can split a large component
    named = settled(rows.groupBy("component").agg(F.min("doc_id").alias("component_id")), "names")
    return rows.join(named, "component").select("doc_id", "fp", "component_id")


def hex_digits(column: str):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def one_of_each(docs: DataFrame, groups: Callable[[DataFrame], DataFrame] = grouped) -> DataFrame:
    """``docs`` with one row of every near-duplicate group: that of the smallest id.

    ``groups`` gives ``doc_id, text_hash, component`` for every row.

    Rows that repeat an id are ordered by a hash of their text, rows without an id come
    last; of equal rows one stays.
    """
    order = F.struct(F.isnull("doc_id").alias("nameless"), "doc_id", "text_hash")
    own = settled(groups(docs), "groups")
    counted = settled(own.groupBy("component", "doc_id", "text_hash").agg(F.count("*").alias("n")), "counted")
    first = counted.groupBy("component").agg(F.min(F.struct(order.alias("order"), F.col("n"))).alias("first"))
    staying = settled(
        first.select(
            F.col("first.order.doc_id").alias("first_id"),
            F.col("first.order.text_hash").alias("first_hash"),
            F.expr("first.n > 1 AS repeated"),
        ),
        "staying",
    )
    same = F.expr("doc_id <=> first_id AND text_hash = first_hash")
    # most rows stay, and are all there is of their kind: those that no mark concerns stay where they are
    going = counted.join(staying.where("NOT repeated"), same, "left_anti")
    key = F.xxhash64("doc_id", "text_hash")
    # a row travels as one struct, so that its columns may have any names
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"))
    rows = with_mark(rows, key, marks(going.select(key.alias("key"))))
    asked = rows.where("mark")
    kept = rows.where("NOT mark").unionByName(asked.join(staying.where("NOT repeated"), same, "left_semi"))
    if not staying.where("repeated").isEmpty():
        kept = kept.unionByName(
            asked.join(staying.where("repeated"), same, "left_semi").dropDuplicates(["doc_id", "text_hash"])
        )
    return kept.select("row.*")
