"""Hard negatives by exact integer inner products, scored by the Four-Russians method.

A component x counts as ``floor(256 x)``. Rows are packed once into blocks: the bits of equal
weight of eight components make a byte, so a block is a set of bit planes. For an anchor, each
group of eight components has a table of its 256 subset sums; a plane's share of the score is the
sum of the entries that its bytes point to, and the planes are added up by shifts (the highest with
a minus, as in two's complement). Scores are whole and exact.

Blocks stay where they are dealt; all anchors, a hundredth of the rows or whatever the caller asks
for, pass by every block, and only the best few of a block leave it. The rows of a block are ordered
by label, so the first pass (positives) scores an anchor with rows of its own label alone. The
second pass takes the negatives below each positive.

What takes part: rows with a label and a vector of finite components below ``LARGEST`` / 256 in
magnitude (so that no score of up to 16,384 components leaves a long). Vectors of another length are
not compared. A row without an id comes after all others in ties and is returned with a null id; it is
nobody's anchor. Rows that share the anchor's id are not others. Equal anchor rows count
once; other rows that are repeated each take a place. Anything empty gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.common import settled

SCALE = 256
LARGEST = 1 << 24
NAMELESS = 2**63 - 1  # stands for a null id
GROUP = 8
BLOCK_ROWS = 1 << 15
ANCHOR_ROWS = 256  # anchors that travel together
TOGETHER = 64  # anchors whose tables are looked up together, and
STRIP = 2048  # rows, so that tables and sums stay in a core's cache
BLOCK, ANCHORS = 0, 1


def scaled(vectors: DataFrame) -> DataFrame:
    """``id, label, parts`` (whole components) of the rows that take part."""
    sound = F.expr(f"forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs({SCALE}D * x) < {LARGEST - 1}D)")
    return vectors.where("label IS NOT NULL AND embedding IS NOT NULL").where(sound).select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(NAMELESS)).alias("id"),
        F.col("label").cast("long").alias("label"),
        F.expr(f"transform(embedding, x -> floor({SCALE}D * cast(x AS double)))").alias("parts"),
    )


def bit_planes(parts: np.ndarray) -> np.ndarray:
    """Bytes (plane, group, row) of whole numbers (row, component) in two's complement; the last plane is the sign's."""
    rows, dims = parts.shape
    groups = -(-dims // GROUP)
    padded = np.zeros((rows, groups * GROUP), np.int64)
    padded[:, :dims] = parts
    largest = max(int(padded.max(initial=0)), -int(padded.min(initial=0)) - 1)
    planes = largest.bit_length() + 1
    out = np.empty((planes, groups, rows), np.uint8)
    for plane in range(planes):
        bits = ((padded >> plane) & 1).astype(np.uint8).reshape(rows, groups, GROUP)
        out[plane] = np.packbits(bits, axis=2, bitorder="little")[:, :, 0].T
    return out


def subset_sums(anchors: np.ndarray, groups: int, kind: type) -> np.ndarray:
    """Sums (group, subset, anchor) of every subset of each group's components of the anchors."""
    padded = np.zeros((len(anchors), groups * GROUP), np.int64)
    padded[:, : anchors.shape[1]] = anchors
    out = np.zeros((groups, 1 << GROUP, len(anchors)), kind)
    for group in range(groups):
        for place in range(GROUP):
            out[group, 1 << place : 2 << place] = out[group, : 1 << place] + padded[:, group * GROUP + place].astype(kind)
    return out


def scores(planes: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """The inner products (row, anchor) of packed rows with anchors (anchor, component)."""
    depth, groups, rows = planes.shape
    bound = int(np.abs(anchors).sum(axis=1).max(initial=0)) << depth
    kind = np.int32 if bound < 2**31 else np.int64
    out = np.zeros((rows, len(anchors)), kind)
    if not groups or not len(anchors):
        return out
    sums = subset_sums(anchors, groups, kind)
    one, part = np.empty((2, STRIP, len(anchors)), kind)
    for at in range(0, rows, STRIP):
        total = out[at : at + STRIP]
        one, part = one[: len(total)], part[: len(total)]
        for plane in reversed(range(depth)):
            own = planes[plane, :, at : at + STRIP]
            np.take(sums[0], own[0], axis=0, out=part, mode="clip")
            for group in range(1, groups):
                np.take(sums[group], own[group], axis=0, out=one, mode="clip")
                part += one
            if plane == depth - 1:
                np.negative(part, out=total)
            else:
                total += total
                total += part
    return out


class Block:
    """Packed rows, ordered by label and id."""

    def __init__(self, dims: int, ids: bytes, labels: bytes, planes: bytes):
        self.dims, self.ids, self.labels = dims, np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        groups = -(-dims // GROUP)
        stored = np.frombuffer(planes, np.uint8)
        depth = len(stored) // max(1, groups * len(self.ids))
        self.planes = stored.reshape(depth, groups, len(self.ids))

    def positives(self, anchors: Anchors, wanted: int) -> Iterator[tuple[np.ndarray, ...]]:
        """(anchor, place, score, id) of the best rows of each anchor's own label. The place is settled later."""
        for label in np.unique(anchors.labels):
            first, stop = np.searchsorted(self.labels, [label, label + 1])
            if first == stop:
                continue
            own = np.flatnonzero(anchors.labels == label)
            for some in (own[i : i + TOGETHER] for i in range(0, len(own), TOGETHER)):
                found = scores(self.planes[:, :, first:stop], anchors.parts[some]).astype(np.int64)
                other = self.ids[first:stop, None] != anchors.ids[some][None, :]
                at, row, best = best_of(found, other, wanted)
                yield anchors.keys[some[at]], np.zeros(len(at), np.int64), best, self.ids[first:stop][row]

    def negatives(self, anchors: Anchors, wanted: int, share: int) -> Iterator[tuple[np.ndarray, ...]]:
        """(anchor, place of the positive, score, id) of the best rows of other labels in the window below each positive."""
        for some in (np.arange(i, min(i + TOGETHER, len(anchors.keys))) for i in range(0, len(anchors.keys), TOGETHER)):
            found = scores(self.planes, anchors.parts[some])
            for at, anchor in enumerate(some):
                tops = [(place, int(top)) for place, top in enumerate(anchors.tops[anchor]) if top >= 0]
                if not tops:
                    continue
                own = found[:, at]
                least = min(-(-share * top // 100) for _, top in tops)
                near = (own >= least) & (own <= max(top for _, top in tops)) & (self.labels != anchors.labels[anchor])
                rows = np.flatnonzero(near)
                rows = rows[np.lexsort((self.ids[rows], -own[rows].astype(np.int64)))]
                ordered = own[rows].astype(np.int64)
                for place, top in tops:
                    start = int(np.searchsorted(-ordered, -top))
                    taken = slice(start, start + wanted)
                    inside = ordered[taken] >= -(-share * top // 100)
                    best = ordered[taken][inside]
                    keys = np.full(len(best), anchors.keys[anchor])
                    yield keys, np.full(len(best), place), best, self.ids[rows[taken][inside]]


class Anchors:
    """Anchors that travel together; ``tops`` holds the scores of their positives, -1 where there is none."""

    def __init__(self, dims: int, keys: bytes, ids: bytes, labels: bytes, parts: bytes, tops: bytes | None):
        self.dims = dims
        self.keys, self.ids, self.labels = (np.frombuffer(x, np.int64) for x in (keys, ids, labels))
        self.parts = np.frombuffer(parts, np.int64).reshape(len(self.ids), dims)
        self.tops = np.frombuffer(tops, np.int64).reshape(len(self.ids), -1) if tops else None


def best_of(found: np.ndarray, other: np.ndarray, wanted: int) -> tuple[np.ndarray, ...]:
    """(column, row, value) of the largest allowed values of every column; ties go to the earlier row."""
    rows = len(found)
    found = np.where(other, found, np.iinfo(np.int64).min)
    if rows > wanted:
        other = other & (found >= np.partition(found, rows - wanted, axis=0)[rows - wanted])
    column, row = np.nonzero(other.T)
    value = found[row, column]
    order = np.lexsort((row, -value, column))
    column, row, value = column[order], row[order], value[order]
    kept = np.arange(len(column)) - np.searchsorted(column, column) < wanted
    return column[kept], row[kept], value[kept]


def _lists(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, numbers) for each length of the lists in a column."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    for dims in np.unique(lengths):
        rows = np.flatnonzero(lengths == dims)
        yield int(dims), rows, column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), dims)


PACKED = "kind int, key long, dims int, keys binary, ids binary, labels binary, numbers binary, tops binary"
PACKED_NAMES = [field.split()[0] for field in PACKED.split(", ")]


def _packed_row(kind: int, key: int, dims: int, *stored: np.ndarray | None) -> pa.RecordBatch:
    columns = [pa.array([kind], pa.int32()), pa.array([key], pa.int64()), pa.array([dims], pa.int32())]
    columns += [pa.array([None if x is None else np.ascontiguousarray(x).tobytes()], pa.binary()) for x in stored]
    return pa.RecordBatch.from_arrays(columns, PACKED_NAMES)


def _packing(batches, size: int, kind: int):
    """Rows gathered by length of vector into blocks of ``size`` or of anchors; the last of a task may be small."""
    from pyspark import TaskContext

    task, made, held = TaskContext.get().partitionId(), 0, {}

    def closed(dims, rows):
        nonlocal made
        ids, labels, parts, keys, tops = (None if x[0] is None else np.concatenate(x) for x in zip(*rows))
        made += 1
        if kind == ANCHORS:
            return _packed_row(kind, (task << 32) + made, dims, keys, ids, labels, parts, tops)
        order = np.lexsort((ids, labels))
        planes = bit_planes(parts[order])
        return _packed_row(kind, (task << 32) + made, dims, None, ids[order], labels[order], planes, None)

    for batch in batches:
        columns = dict(zip(batch.schema.names, batch.columns))
        for dims, rows, parts in _lists(columns["parts"]):
            own = [columns[c].to_numpy(zero_copy_only=False)[rows] if c in columns else None for c in ("id", "label", "key")]
            tops = None
            if "tops" in columns:
                tops = columns["tops"].take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
            for at in range(0, len(rows), size):
                cut = slice(at, at + size)
                waiting = held.setdefault(dims, [])
                waiting.append([None if x is None else x[cut] for x in (own[0], own[1], parts, own[2], tops)])
                if sum(len(x[0]) for x in waiting) >= size:
                    yield closed(dims, held.pop(dims))
    for dims, rows in held.items():
        yield closed(dims, rows)


def blocks(rows: DataFrame) -> DataFrame:
    """The rows of ``scaled``, packed without a shuffle."""
    return rows.mapInArrow(lambda batches: _packing(batches, BLOCK_ROWS, BLOCK), PACKED)


def travelling(anchors: DataFrame) -> DataFrame:
    return anchors.mapInArrow(lambda batches: _packing(batches, ANCHOR_ROWS, ANCHORS), PACKED)


def _met(stored: DataFrame, count: int, anchors: DataFrame, ask: str, wanted: int, share: int) -> DataFrame:
    """``anchor, place, score, id``: what every block offers to every anchor.

    Blocks are dealt to ``count`` slots by their keys and held slot by slot; the anchors of all slots pass by.
    """
    slots = F.pmod(F.xxhash64("key"), F.lit(count)).cast("int")
    dealt = stored.withColumn("slot", slots).unionByName(
        travelling(anchors).withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    )
    tasks = max(int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)

    def run(batches):
        slot, held = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                kind, _, dims, keys, ids, labels, numbers, tops, own = (column[row].as_py() for column in batch.columns)
                if own != slot:
                    slot, held = own, []
                if kind == BLOCK:
                    held.append(Block(dims, ids, labels, numbers))
                    continue
                passing = Anchors(dims, keys, ids, labels, numbers, tops)
                for block in held:
                    if block.dims == dims:
                        found = block.positives(passing, wanted) if ask == "positives" else block.negatives(passing, wanted, share)
                        parts = list(zip(*found))
                        if parts:
                            columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in parts]
                            yield pa.RecordBatch.from_arrays(columns, ["anchor", "place", "score", "id"])

    dealt = dealt.repartition(tasks, "slot").sortWithinPartitions("slot", "kind")
    return dealt.mapInArrow(run, "anchor long, place long, score long, id long")


def _first(found: DataFrame, keys: tuple[str, ...], wanted: int) -> DataFrame:
    """The best ``wanted`` rows of each key with their ``rank``; a task drops all but those before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted)


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, share: int = 80) -> DataFrame:
    """Hard negatives of ``anchors`` among ``vectors`` (both ``vec_id, label, embedding``).

    An anchor's positives are the ``positives`` best other rows of its label. For each of them the first
    ``negatives`` rows of other labels come back whose score lies between ``share`` percent of the
    positive's and the positive's: ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.
    """
    stored = settled(blocks(scaled(vectors)), "blocks")
    count = max(1, stored.count())
    asked = scaled(anchors).where(F.col("id") != NAMELESS).distinct()
    asked = settled(asked.withColumn("key", F.monotonically_increasing_id()), "anchors")
    found = _met(stored, count, asked, "positives", positives, share)
    best = _first(found, ("anchor",), positives).select("anchor", (F.col("rank") - 1).alias("place"), "score", "id")
    names = asked.select(F.col("key").alias("anchor"), F.col("id").alias("anchor_id"))
    best = settled(best.join(names, "anchor"), "positives")
    places = F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), lambda p: F.coalesce(F.try_element_at("scores", p), F.lit(-1)))
    tops = best.groupBy(F.col("anchor").alias("key")).agg(F.map_from_entries(F.collect_list(F.struct("place", "score"))).alias("scores"))
    hunting = asked.join(tops, "key").withColumn("tops", places.cast("array<bigint>")).drop("scores")
    below = _first(_met(stored, count, hunting, "negatives", negatives, share), ("anchor", "place"), negatives)
    told = best.select("anchor", "place", "anchor_id", F.col("id").alias("positive"), F.col("score").alias("positive_score"))
    return below.join(told, ["anchor", "place"]).select(
        "anchor_id",
        F.nullif("positive", F.lit(NAMELESS)).alias("positive_id"),
        "rank",
        F.nullif("id", F.lit(NAMELESS)).alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
