"""Exact removal of long repeated byte strings by a logarithmic family of sparse suffix indexes.

Two equal strings of ``LENGTH`` bytes contain the same anchor at the same place: the gram
of ``GRAM`` bytes with the least hash among all in the string. Only suffixes that start at
an anchor are indexed. Neighbouring windows of ``LENGTH`` bytes that share their anchor
form a run; a run is entered by the hash of its anchor (``key``) and of all bytes that its
windows cover (``extent``).

Runs are dealt out by key. Each batch of runs is sorted, not by the bytes of its suffixes but by
hashes of their first ``GRAM`` bytes and of their extents, which brings equal strings together all the
same, and is merge-scanned with the sorted levels that exist: entries of one key and extent are one long string, and
the later one is a repeat. What is new becomes a level; levels of equal size are merged, so
an entry is moved a logarithmic number of times. Where one key has several extents, repeats
may begin or end inside a run. The windows of such runs, few in number, go through the same
family in two finer steps, and the result is exact: first cells of up to ``CELL`` windows,
entered by the bytes that all of a cell's windows share, then, where those have several
extents, single windows. A cell carries the few bytes beside its core, so no text is read
for the last step.

A batch is reduced before the shuffle: repeats within it are settled, and of a key with many
extents only two represent it, since their windows are compared anyway. So a passage that a
third of all texts share sends a few rows a batch, and no task gathers it.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import FIRST_ID, pieces, settled, utf8

LENGTH = 100
GRAM = 32
SPAN = LENGTH - GRAM + 1  # grams in a window
CELL = 8  # windows of a cell; the bytes on either side of its core fit in a long
BLOCK = 1 << 18  # window starts looked at together
BATCH_BYTES = 16 << 20
BATCH_ROWS = 1 << 17
TASK_ROWS = 1 << 21  # entries that one family holds, about
REPEAT, COMPARE, ENTRY = 0, 1, 2  # a row removes bytes, has its windows compared, or is an entry to be indexed

# ``place`` holds a start, how far the anchor is behind it, a number of windows and what the row is.
ENTRIES = (("key", pa.int64()), ("extent", pa.int64()), ("doc", pa.int64()), ("part", pa.int64()), ("place", pa.int64()))
CELLS = (*ENTRIES, ("before", pa.int64()), ("after", pa.int64()))
KIND_BITS, COUNT_BITS, LEAD_BITS = 2, 21, 7
MOST_WINDOWS = (1 << COUNT_BITS) - 1


def ddl(fields) -> str:
    return ", ".join(f"{name} long" for name, _ in fields)


def packed(start, lead, count, kind):
    return (((start << LEAD_BITS | lead) << COUNT_BITS | count) << KIND_BITS) | kind


def unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    rest = place >> KIND_BITS
    lead = (rest >> COUNT_BITS) & ((1 << LEAD_BITS) - 1)
    return rest >> (COUNT_BITS + LEAD_BITS), lead, rest & MOST_WINDOWS, place & ((1 << KIND_BITS) - 1)


@lru_cache(1)
def _hashing() -> tuple[np.ndarray, ...]:
    """Random values of bytes for two hashes, an odd base, its powers and those of its inverse."""
    rng = np.random.default_rng(20011)
    values = rng.integers(0, 2**64, (2, 256), np.uint64)
    base = int(rng.integers(0, 2**63)) * 2 + 1
    inverse = pow(base, -1, 2**64)

    def powers(x: int) -> np.ndarray:
        table = np.ones(BLOCK + 2 * LENGTH + 1, np.uint64)
        done = 1
        while done < len(table):
            more = min(done, len(table) - done)
            table[done : done + more] = table[:more] * np.uint64(pow(x, done, 2**64))
            done += more
        return table

    return values[0], values[1], np.uint64(base), powers(base), powers(inverse)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    values, _, base, _, _ = _hashing()
    hashes, width = values[data], 1
    while width < GRAM:
        hashes = hashes[:-width] * np.uint64(pow(int(base), width, 2**64)) + hashes[width:]
        width *= 2
    return mixed(hashes)


def _prefix_hashes(data: np.ndarray, which: int) -> np.ndarray:
    _, _, _, powers, _ = _hashing()
    terms = _hashing()[which][data] * powers[: len(data)]
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))


def _strings(prefix: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hashes of the strings between places of one block."""
    return mixed((prefix[stops] - prefix[starts]) * _hashing()[4][starts] + (stops - starts).astype(np.uint64))


def hashed(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, which: int) -> np.ndarray:
    """Hashes of short strings of ``data``, given in the order of their starts (which may go back a little)."""
    out, at = np.zeros(len(starts), np.uint64), 0
    upto = np.maximum.accumulate(starts) if len(starts) else starts
    while at < len(starts):
        end = int(np.searchsorted(upto, upto[at] + BLOCK))
        base = int(starts[at:end].min())
        prefix = _prefix_hashes(data[base : int(stops[at:end].max())], which)
        out[at:end] = _strings(prefix, starts[at:end] - base, stops[at:end] - base)
        at = end
    return out


def _sliding_least(x: np.ndarray) -> np.ndarray:
    """The least of every ``SPAN`` neighbours."""
    width = 1
    while 2 * width <= SPAN:
        x, width = np.minimum(x[:-width], x[width:]), 2 * width
    return np.minimum(x[: len(x) - (SPAN - width)], x[SPAN - width :]) if SPAN > width else x


def _blocks(bounds: np.ndarray):
    """(start, stop) of window starts looked at together; cut between rows where rows are short enough."""
    row = 0
    while row + 1 < len(bounds):
        stop = int(np.searchsorted(bounds, bounds[row] + BLOCK, side="right")) - 1
        if stop > row:
            yield int(bounds[row]), int(bounds[stop])
            row = stop
        else:
            for start in range(int(bounds[row]), int(bounds[row + 1]), BLOCK):
                yield start, min(start + BLOCK, int(bounds[row + 1]))
            row += 1


def runs(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """All runs of a batch of rows: start (in the batch), anchor behind it, number of windows, key, extent."""
    found, low = [], np.uint64((1 << 20) - 1)
    for begin, end in _blocks(bounds):
        own = data[begin : end + LENGTH - 1]
        n = min(end - begin, len(own) - LENGTH + 1)
        if n <= 0:
            continue
        first_row, last_row = (int(x) for x in np.searchsorted(bounds, (begin, begin + n - 1), side="right") - 1)
        edges = np.clip(bounds[first_row : last_row + 2] - begin, 0, n)
        row = np.repeat(np.arange(first_row, last_row + 1), np.diff(edges))
        valid = np.arange(begin + LENGTH, begin + LENGTH + n) <= bounds[row + 1]
        hashes = _gram_hashes(own)
        anchors = _sliding_least((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64))[:n] & low
        change = np.ones(n, bool)
        change[1:] = (anchors[1:] != anchors[:-1]) | (row[1:] != row[:-1]) | (valid[1:] != valid[:-1])
        first = np.flatnonzero(change)
        count = np.diff(np.append(first, n))
        sound = valid[first]
        first, count = first[sound], count[sound]
        anchor = anchors[first].astype(np.int64)
        extent = _strings(_prefix_hashes(own, 1), first, first + count - 1 + LENGTH)
        found.append((first + begin, anchor - first, count, hashes[anchor], extent))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*found))


def cells(data: np.ndarray, start: np.ndarray, lead: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs cut on a grid around their anchors: which run, first window, windows, key, extent, bytes beside the core.

    A cell's core is what all windows of its grid square share. The bytes before and behind
    it, as far as the cell's own windows reach, are held from the core outwards.
    """
    farthest, nearest = lead, lead - count + 1  # distances from a window's start to the anchor
    squares = farthest // CELL - nearest // CELL + 1
    run = np.repeat(np.arange(len(start)), squares)
    square = np.repeat(farthest // CELL, squares) - (np.arange(len(run)) - np.repeat(np.cumsum(squares) - squares, squares))
    anchor = (start + lead)[run]
    first = np.maximum(start[run], anchor - square * CELL - CELL + 1)
    last = np.minimum((start + count - 1)[run], anchor - square * CELL)
    core, core_end = anchor - square * CELL, anchor - square * CELL - CELL + 1 + LENGTH
    before, after = np.zeros(len(run), np.int64), np.zeros(len(run), np.int64)
    for i in range(CELL - 1):
        here, there = core - 1 - i, core_end + i
        before |= np.where(here >= first, data[np.maximum(here, 0)], 0).astype(np.int64) << (8 * i)
        after |= np.where(there < last + LENGTH, data[np.minimum(there, len(data) - 1)], 0).astype(np.int64) << (8 * i)
    key, extent = hashed(data, core, core_end, 0), hashed(data, first, last + LENGTH, 1)
    return run, first, core - first, last - first + 1, key, extent, before, after


def windows_of(columns: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """The single windows of cells, from their columns alone: entries again.

    A window is told by its cell's core and by how many and which bytes it has on either side.
    """
    key, _, doc, part, place, before, after = columns
    start, lead, count, _ = unpacked(place)
    cell = np.repeat(np.arange(len(key)), count)
    nth = np.arange(len(cell)) - np.repeat(np.cumsum(count) - count, count)
    ahead = lead[cell] - nth  # bytes of the window before the core
    behind = CELL - 1 - ahead
    mask = (np.int64(1) << (8 * np.arange(CELL))) - 1
    left, right = before[cell] & mask[ahead], after[cell] & mask[behind]
    sides = mixed(left.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + ahead.astype(np.uint64)) + right.astype(np.uint64)
    one = mixed(key[cell].astype(np.uint64) ^ mixed(sides))
    # the core once more and both sides unmixed: equal only for equal windows of equal keys
    two = mixed(key[cell].astype(np.uint64) + mixed(right.astype(np.uint64) * np.uint64(0xA0761D6478BD642F) ^ left.astype(np.uint64)))
    return one.view(np.int64), two.view(np.int64), doc[cell], part[cell], packed(start[cell] + nth, 0, 1, ENTRY)


class Entries:
    """Columns of entries: key, extent, document, part, place, and whatever else belongs to them."""

    def __init__(self, *columns: np.ndarray):
        self.columns = columns

    def __len__(self) -> int:
        return len(self.columns[0])

    def taken(self, at: np.ndarray) -> Entries:
        return Entries(*(c[at] for c in self.columns))

    def sorted(self) -> Entries:
        """By key, then extent, document, part and place; each entry once, however many equal rows gave it."""
        key, extent, doc, part, place = self.columns[:5]
        order = np.argsort(key, kind="stable")
        tied = key[order][1:] == key[order][:-1]
        if tied.any():  # few keys occur twice, so the other columns are sorted among those only
            among = np.flatnonzero(np.append(tied, False) | np.append(False, tied))
            own = order[among]
            own = own[np.lexsort((place[own], part[own], doc[own], extent[own], key[own]))]
            order[among] = own
            again = np.zeros(len(own), bool)
            again[1:] = np.logical_and.reduce([c[own][1:] == c[own][:-1] for c in self.columns[:5]])
            order = np.delete(order, among[again])
        return self.taken(order)

    @staticmethod
    def joined(parts: list[Entries]) -> Entries:
        return Entries(*(np.concatenate(c) for c in zip(*(p.columns for p in parts))))


def scanned(entries: Entries) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted entries: which repeat an earlier one, and which keys have several extents."""
    key, extent = entries.columns[:2]
    same_key, same = np.zeros(len(key), bool), np.zeros(len(key), bool)
    same_key[1:] = key[1:] == key[:-1]
    same[1:] = same_key[1:] & (extent[1:] == extent[:-1])
    mixed_key = np.zeros(len(key), bool)
    if len(key):
        group = np.cumsum(~same_key) - 1
        several = np.zeros(group[-1] + 1, bool)
        several[group[same_key & ~same]] = True
        mixed_key = several[group]
    return same, mixed_key


class Family:
    """Levels of sorted entries, each at least twice as large as the next."""

    def __init__(self):
        self.levels: list[Entries] = []

    def add(self, batch: Entries) -> Entries:
        """Index a batch; gives the entries found to be repeats."""
        batch, own = self._scan(batch.sorted())
        repeats = [own]
        while self.levels and len(self.levels[-1]) < 2 * len(batch):
            batch, own = self._scan(Entries.joined([self.levels.pop(), batch]).sorted())
            repeats.append(own)
        for i, level in enumerate(self.levels):
            self.levels[i], batch, own = self._against(level, batch)
            repeats.append(own)
        self.levels.append(batch)
        return Entries.joined(repeats)

    @staticmethod
    def _scan(entries: Entries) -> tuple[Entries, Entries]:
        same, _ = scanned(entries)
        return entries.taken(~same), entries.taken(same)

    @classmethod
    def _against(cls, level: Entries, batch: Entries) -> tuple[Entries, Entries, Entries]:
        """Merge-scan of a level and a batch: the level, what is new in the batch, and the repeats.

        The first of equal entries stays, in the level, whichever side it came from.
        """
        shared = np.isin(batch.columns[0], level.columns[0])
        if not shared.any():
            return level, batch, batch.taken(shared)
        met = np.isin(level.columns[0], batch.columns[0][shared])
        left, repeats = cls._scan(Entries.joined([level.taken(met), batch.taken(shared)]).sorted())
        return Entries.joined([level.taken(~met), left]).sorted(), batch.taken(~shared), repeats

    def unsettled(self, like: Entries) -> Entries:
        """Entries of keys that have several extents."""
        everything = Entries.joined([like.taken(np.zeros(0, np.int64)), *self.levels]).sorted()
        return everything.taken(scanned(everything)[1])


def _batch(entries: Entries, fields, kinds: np.ndarray | int | None = None) -> pa.RecordBatch:
    columns = list(entries.columns)
    if kinds is not None:
        columns[4] = (columns[4] >> KIND_BITS << KIND_BITS) | kinds
    arrays = [pa.array(c.astype(t.to_pandas_dtype(), copy=False)) for c, (_, t) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def _stretches(repeats: Entries) -> Entries:
    """Repeats of one document whose windows follow each other become one row."""
    _, _, doc, part, place = repeats.columns[:5]
    order = np.lexsort((place, part, doc))
    repeats = repeats.taken(order)
    _, _, doc, part, place = repeats.columns[:5]
    if not len(place):
        return repeats
    start, _, count, kind = unpacked(place)
    apart = np.ones(len(place), bool)
    apart[1:] = (doc[1:] != doc[:-1]) | (part[1:] != part[:-1]) | (start[1:] != start[:-1] + count[:-1])
    total = np.cumsum(count)
    apart[1:] |= total[1:] // (MOST_WINDOWS // 2) != total[:-1] // (MOST_WINDOWS // 2)
    first = np.flatnonzero(apart)
    merged = repeats.taken(first)
    columns = list(merged.columns)
    columns[4] = packed(start[first], 0, np.add.reduceat(count, first), REPEAT)
    return Entries(*columns)


def reduced(entries: Entries, fields=ENTRIES) -> pa.RecordBatch:
    """What of a batch must meet other batches: its repeats are settled, and two entries stand for a key of many."""
    entries = entries.sorted()
    same, mixed_key = scanned(entries)
    key = entries.columns[0]
    kinds = np.where(same, REPEAT, ENTRY)
    among = np.flatnonzero(mixed_key & ~same)
    if len(among):
        starts = np.flatnonzero(np.concatenate(([True], key[among][1:] != key[among][:-1])))
        rank = np.arange(len(among)) - np.repeat(starts, np.diff(np.append(starts, len(among))))
        kinds[among[rank >= 2]] = COMPARE
    columns = list(entries.columns)
    columns[4] = (columns[4] >> KIND_BITS << KIND_BITS) | kinds
    entries = Entries(*columns)
    told = Entries.joined([entries.taken(kinds != REPEAT), _stretches(entries.taken(kinds == REPEAT))])
    return _batch(told, fields)


def _spread():
    """Where a row goes: entries by key; the others only pass through, so they are spread by place."""
    aside = F.col("place").bitwiseAND(3) != ENTRY
    return F.when(aside, F.xxhash64("doc", "part", "place")).otherwise(F.col("key"))


def indexed(rows: DataFrame, fields=ENTRIES, tasks: int = 0) -> DataFrame:
    """The same columns for repeats (``place`` counts), and for entries whose windows have to be compared.

    The entries are dealt to ``tasks`` families, or to as many as the session shuffles to if that is more.
    """

    def run(batches):
        family, waiting, like = Family(), [], None
        for batch in batches:
            entries = Entries(*(c.to_numpy(zero_copy_only=False) for c in batch.columns[: len(fields)]))
            kind = unpacked(entries.columns[4])[3]
            yield _batch(entries.taken(kind != ENTRY), fields)
            waiting.append(entries.taken(kind == ENTRY))
            like = waiting[-1]
            if sum(map(len, waiting)) >= BATCH_ROWS:
                yield _batch(_stretches(family.add(Entries.joined(waiting))), fields)
                waiting = []
        if waiting:
            yield _batch(_stretches(family.add(Entries.joined(waiting))), fields)
        if like is not None:
            yield _batch(family.unsettled(like), fields, COMPARE)

    enough = tasks <= int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(_spread()) if enough else rows.repartition(tasks, _spread())
    return dealt.mapInArrow(run, ddl(fields))


def _texts(docs: DataFrame) -> DataFrame:
    """``doc, part, text``: ids without nulls; ``part`` tells apart rows that repeat an id, 0 where none does."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST_ID))
    repeated = not docs.groupBy(doc.alias("doc")).count().where("count > 1").isEmpty()
    part = F.xxhash64("text") if repeated else F.lit(0).cast("long")
    return docs.select("doc_id", doc.alias("doc"), part.alias("part"), "text")


def _entry_rows(texts: DataFrame) -> DataFrame:
    def run(batches):
        for batch in pieces(batches, text=2, limit=BATCH_BYTES):
            data, bounds = utf8(batch.column(2))
            start, lead, count, key, extent = runs(data, bounds)
            row = np.searchsorted(bounds[1:], start, side="right")
            doc, part = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            place = packed(start - bounds[row], lead, count, ENTRY)
            yield reduced(Entries(key.view(np.int64), extent.view(np.int64), doc[row], part[row], place))

    return texts.select("doc", "part", "text").mapInArrow(run, ddl(ENTRIES))


def _cell_rows(texts: DataFrame, compared: DataFrame) -> DataFrame:
    def run(batches):
        for batch in pieces(batches, text=3, limit=BATCH_BYTES):
            data, bounds = utf8(batch.column(3))
            doc, part = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            places = batch.column(4)
            row = np.repeat(np.arange(len(doc)), places.value_lengths().to_numpy(zero_copy_only=False))
            start, lead, count, _ = unpacked(places.flatten().to_numpy(zero_copy_only=False))
            start = start + bounds[row]
            order = np.argsort(start, kind="stable")
            row, start, lead, count = (x[order] for x in (row, start, lead, count))
            run_, first, ahead, windows, key, extent, before, after = cells(data, start, lead, count)
            row = row[run_]
            place = packed(first - bounds[row], ahead, windows, ENTRY)
            entries = (key.view(np.int64), extent.view(np.int64), doc[row], part[row], place, before, after)
            yield reduced(Entries(*entries), CELLS)

    wanted = compared.groupBy("doc", "part").agg(F.collect_list("place").alias("places"))
    # doc_id is read so that this join and the last one share one exchange of the texts
    joined = texts.join(wanted, ["doc", "part"]).select("doc_id", "doc", "part", "text", "places")
    return joined.mapInArrow(run, ddl(CELLS))


def _window_rows(compared: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            columns = windows_of(tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns))
            yield reduced(Entries(*columns))

    return compared.select(*(name for name, _ in CELLS)).mapInArrow(run, ddl(ENTRIES))


def repeats(texts: DataFrame) -> DataFrame:
    """``doc, part, place`` of all runs, cells and windows that also start earlier."""
    kind = F.col("place").bitwiseAND(3)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = size // (GRAM * TASK_ROWS) + 1  # an anchor comes every ``GRAM`` bytes, about
    by_run = settled(indexed(_entry_rows(texts), tasks=tasks).select("doc", "part", "place"), "runs")
    by_cell = indexed(_cell_rows(texts, by_run.where(kind == COMPARE)), CELLS, tasks)
    by_window = indexed(_window_rows(by_cell.where(kind == COMPARE)), tasks=tasks)
    found = [step.where(kind == REPEAT).select("doc", "part", "place") for step in (by_run, by_cell, by_window)]
    return found[0].unionByName(found[1]).unionByName(found[2])


def removed(places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the maximal removed stretches of a text of ``n`` bytes."""
    start, _, count, _ = unpacked(np.sort(places))
    stop = np.maximum.accumulate(np.minimum(start + count - 1 + LENGTH, n)) if len(start) else start
    apart = np.concatenate(([True], start[1:] > stop[:-1])) if len(start) else np.zeros(0, bool)
    first = np.flatnonzero(apart)
    return start[first], stop[np.append(first[1:], len(start)) - 1] if len(first) else stop


def _cut(docs: DataFrame, give, schema: str) -> DataFrame:
    texts = _texts(docs)
    found = repeats(texts).groupBy("doc", "part").agg(F.collect_list("place").alias("places"))
    joined = texts.join(found, ["doc", "part"], "left").select("doc_id", "text", "places")

    def run(batches):
        for batch in pieces(batches, limit=BATCH_BYTES):
            data, bounds = utf8(batch.column(1))
            rows = []
            for row, places in enumerate(batch.column(2)):
                own = data[bounds[row] : bounds[row + 1]]
                at = places.values.to_numpy() if places.is_valid else np.zeros(0, np.int64)
                starts, stops = removed(at, len(own))
                edges = np.concatenate(([0], np.stack((starts, stops), 1).ravel(), [len(own)]))
                kept = b"".join(own[a:b].tobytes() for a, b in edges.reshape(-1, 2))
                rows.append(give(kept, len(own), int((stops - starts).sum()), len(starts)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(GIVEN[give]))],
                ["doc_id", *(name for name, _ in GIVEN[give])],
            )

    return joined.mapInArrow(run, schema)


def _measures(kept: bytes, n: int, n_removed: int, n_spans: int) -> tuple:
    return n, n_removed, n_spans, hashlib.sha256(kept).hexdigest()


def _remains(kept: bytes, n: int, n_removed: int, n_spans: int) -> tuple:
    return kept, n_removed


GIVEN = {
    _measures: (("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())),
    _remains: (("kept", pa.binary()), ("n_removed", pa.int64())),
}


def measure(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: bytes, removed bytes, maximal removed stretches, digest of what is left.

    The first of equal strings is the one in the smallest id, then the earliest start. A
    null id comes before all others. Rows that repeat an id are told apart by their text;
    equal rows of one id count as one document and get the same result, and of two texts
    of one id that of the smaller hash comes first. A null text is an empty one.
    """
    return _cut(docs, _measures, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cut(docs: DataFrame) -> DataFrame:
    """``doc_id, kept, n_removed``: the bytes of every row that are left (a cut may fall inside a character)."""
    return _cut(docs, _remains, "doc_id long, kept binary, n_removed long")
