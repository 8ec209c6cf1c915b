"""Alignment of two tokenizers over the same bytes, and how often their ids meet.

Both tokenizers encode a space and the text. Where a token of either ends at the same byte, the
text is cut into groups; every token of A in a group is linked to every token of B in it. Shared
ends, verified on the bytes, that come before tokens marked by a space are anchors: they cut a
document into short windows of token ids, mostly words. A window's groups follow from its ids
alone, so they are worked out once for each pair of id tuples of a chunk.

An id pair counts as many documents as hold it linked, over all documents. A chunk of documents
keeps its links by number and lists its distinct pairs; the pairs are added up over all chunks, and
each chunk gets the counts of its own pairs back. So no task holds more than one chunk (a few
megabytes of text, or one longer text) and the counts of its pairs, whatever the vocabularies.

A text that is null or empty, or whose tokens do not give back its bytes, has no tokens: zeros, and
an empty digest. Every row is a document, also where rows or ids repeat. An empty table gives an
empty result; further columns are left aside.
"""

from __future__ import annotations

import hashlib
import io
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.common import pieces, settled

CHUNK = 2 << 20  # bytes of text whose documents share a list of pairs
TOGETHER = 1 << 18  # characters given to a tokenizer at a time
SEGMENT = 1 << 16  # characters after which a longer text is cut where no token of either crosses
CUT = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")
LARGE = 1 << 12  # links of a group beyond which equal ones are counted and not listed
LAST = 2**31 - 1
# How byte-level vocabularies of this kind part a text, and the first character that is left to the
# tokenizers library, since later versions of Unicode may class it otherwise.
PARTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
UNSURE = "\u0250"


class Vocabulary:
    """The bytes of every id of a tokenizer, their number, and whether they begin with a space."""

    def __init__(self, entries: list[bytes]):
        self.entries = entries
        self.lengths = np.array([len(e) for e in entries], np.int64)
        self.spaced = np.array([e.startswith(b" ") for e in entries])

    def joined(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.entries.__getitem__, ids.tolist()))


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: itself if it can be seen, else one from 256 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + n): b for n, b in enumerate(hidden)}


class ByteLevel:
    """A byte-level tokenizer of the tokenizers library (A); texts come with their space before them."""

    def __init__(self, stored: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core
        from tokenizers import Tokenizer

        text = stored.decode()
        self.tokenizer = Tokenizer.from_str(text)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        alphabet, model = byte_alphabet(), json.loads(text)
        self.fast = _ranked(model, alphabet)
        entries = {i: bytes(alphabet[c] for c in entry) for entry, i in model["model"]["vocab"].items() if alphabet.keys() >= set(entry)}
        entries |= {x["id"]: x["content"].encode() for x in model["added_tokens"]}
        self.vocabulary = Vocabulary([entries.get(i, b"") for i in range(max(entries) + 1)])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        sure = [self.fast is not None and max(t, default="") < UNSURE for t in texts]
        slow = iter(self.tokenizer.encode_batch([" " + t for t, s in zip(texts, sure) if not s], add_special_tokens=False))
        found = (self.fast.encode_ordinary(" " + t) if s else next(slow).ids for t, s in zip(texts, sure))
        return [np.array(ids, np.int32) for ids in found]


def _ranked(model: dict, alphabet: dict[str, int]):
    """The same encoding by ranks, four times as fast; None unless ids grow with the order of merges and nothing is added."""
    import tiktoken

    vocab, parts = model["model"]["vocab"], model["pre_tokenizer"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
    plain = model["normalizer"] is None and parts == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    if not plain or [vocab["".join(m)] for m in merges] != list(range(len(alphabet), len(alphabet) + len(merges))):
        return None
    added = {x["content"] for x in model["added_tokens"]}
    ranks = {bytes(alphabet[c] for c in entry): i for entry, i in vocab.items() if entry not in added}
    return tiktoken.Encoding("ranked", pat_str=PARTS, mergeable_ranks=ranks, special_tokens={})


class Pieces:
    """A sentencepiece model (B), which adds the space itself."""

    def __init__(self, stored: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=stored)
        found = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        entries = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(found)
        ]
        self.vocabulary = Vocabulary(entries)
        # no piece holds a space after another character, so none crosses from word to word
        self.within_words = not any("▁" in p.lstrip("▁") for p in found)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int32) for ids in self.model.encode(texts, num_threads=1)]


@lru_cache(1)
def loaded(a: bytes, b: bytes) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(a), Pieces(b)


def segments(text: str, size: int = SEGMENT) -> list[str]:
    """A long text cut at single spaces between letters, where both tokenizers begin anew; the spaces are left out."""
    out, at = [], 0
    while len(text) - at > size and (found := CUT.search(text, at + size)):
        out.append(text[at : found.start()])
        at = found.end()
    return [*out, text[at:]]


def encoded(tokenizer: ByteLevel | Pieces, texts: list[list[str]]) -> list[np.ndarray]:
    """The ids of every text, given as segments."""
    flat, out, held, size = [s for own in texts for s in own], [], [], 0
    for segment in flat:
        held.append(segment)
        size += len(segment)
        if size >= TOGETHER:
            out += tokenizer.encode(held)
            held, size = [], 0
    out += tokenizer.encode(held) if held else []
    stops = np.cumsum([len(own) for own in texts]).tolist()
    return [np.concatenate(out[stop - len(own) : stop]) for own, stop in zip(texts, stops)]


class Alignments:
    """What the distinct windows of a chunk make of their ids, worked out once for each pair of id tuples.

    ``text`` of its groups, ``n_groups``, ``n_links``, and the linked ``pairs`` with their ``times`` (window
    by window, ``sizes`` of them; a pair may be listed more than once).
    """

    def __init__(self, a: np.ndarray, b: np.ndarray, a_counts: np.ndarray, b_counts: np.ndarray, lengths, names: list[str]):
        """The windows' ids one after another. Both sides of a window end at the same byte."""
        a_ends, b_ends = (np.cumsum(own[ids]) for own, ids in zip(lengths, (a, b)))
        a_stops, b_stops = shared_ends(a_ends, b_ends)
        a_sizes, b_sizes = np.diff(a_stops, prepend=0), np.diff(b_stops, prepend=0)
        a_from, b_from = a_stops - a_sizes, b_stops - b_sizes
        last = np.searchsorted(a_stops, np.cumsum(a_counts)) + 1  # groups up to the end of each window
        first = np.append(0, last[:-1])
        self.n_groups = last - first
        links = a_sizes * b_sizes
        self.n_links = np.add.reduceat(links, first)
        # a group's tokens of A, then those of B, each after the sign that parts it from the one before
        codes = np.empty(len(a) + len(b), np.int64)
        a_signs, b_signs = np.full(len(a), COMMA), np.full(len(b), COMMA)
        a_signs[a_from], b_signs[b_from] = SEMICOLON, BAR
        a_signs[a_from[first]] = NOTHING
        span = len(names) // 4
        codes[np.arange(len(a)) + np.repeat(b_from, a_sizes)] = a_signs * span + a
        codes[np.arange(len(b)) + np.repeat(a_stops, b_sizes)] = b_signs * span + b
        told = [names[c] for c in codes.tolist()]
        ends = np.cumsum(a_counts + b_counts).tolist()
        self.text = ["".join(told[i:j]) for i, j in zip([0, *ends], ends)]
        window = np.repeat(np.arange(len(last)), self.n_groups)
        small = np.flatnonzero(links <= LARGE)
        count = links[small]
        group = np.repeat(small, count)
        place = np.arange(len(group)) - np.repeat(np.cumsum(count) - count, count)
        left, right = a[a_from[group] + place // b_sizes[group]], b[b_from[group] + place % b_sizes[group]]
        owner, pairs = [window[group]], [left.astype(np.int64) << 32 | right]
        times = [np.ones(len(group), np.int64)]
        for large in np.flatnonzero(links > LARGE).tolist():
            sides = ((a, a_from, a_stops), (b, b_from, b_stops))
            (one, n), (two, m) = (np.unique(ids[i[large] : k[large]], return_counts=True) for ids, i, k in sides)
            pairs.append((one.astype(np.int64)[:, None] << 32 | two[None, :]).ravel())
            times.append((n[:, None] * m[None, :]).ravel())
            owner.append(np.full(len(one) * len(two), window[large]))
        owner, self.pairs, self.times = (np.concatenate(x) for x in (owner, pairs, times))
        if len(links) > len(small):
            order = np.argsort(owner, kind="stable")
            owner, self.pairs, self.times = owner[order], self.pairs[order], self.times[order]
        self.sizes = np.bincount(owner, minlength=len(last))


COMMA, SEMICOLON, BAR, NOTHING = range(4)


def names_of(size: int) -> list[str]:
    """Every id as text after each of the signs that can come before it."""
    return [f"{sign}{i}" for sign in (",", ";", "|", "") for i in range(size)]


def shared_ends(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of tokens of A and of B up to each byte at which both have a token's end."""
    place = np.minimum(np.searchsorted(b_ends, a_ends), len(b_ends) - 1)
    shared = np.flatnonzero(b_ends[place] == a_ends)
    return shared + 1, place[shared] + 1


def window_ends(a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray, stops: np.ndarray, spaced) -> tuple:
    """For every window the number of tokens of A and of B up to its end.

    ``stops`` are the bytes at which documents end: shared ends too, and windows end there.
    """
    a_stops, b_stops = shared_ends(a_ends, b_ends)
    after_a, after_b = (own[np.append(ids, 0)[at]] for own, ids, at in zip(spaced, (a, b), (a_stops, b_stops)))
    ends = (after_a & after_b) | np.isin(a_ends[a_stops - 1], stops, assume_unique=True)
    return a_stops[ends], b_stops[ends]


def part_of(ids: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Stretches of ``ids``, one after another."""
    return ids[np.arange(counts.sum()) + np.repeat(starts - (np.cumsum(counts) - counts), counts)]


def _mixed(ids: np.ndarray, starts: np.ndarray, counts: np.ndarray, factor: int) -> np.ndarray:
    """A hash of each window's ids in their order."""
    place = (np.arange(len(ids)) - np.repeat(starts, counts)).astype(np.uint64)
    value = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + place * np.uint64(factor)
    value ^= value >> np.uint64(31)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(29)
    return np.add.reduceat(value, starts)


def same_windows(a: np.ndarray, b: np.ndarray, a_stops: np.ndarray, b_stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first window of each kind, kind of each window). Windows are told apart by a hash, and then by their ids."""
    a_starts, b_starts = np.append(0, a_stops[:-1]), np.append(0, b_stops[:-1])
    a_counts, b_counts = a_stops - a_starts, b_stops - b_starts
    hashes = _mixed(a, a_starts, a_counts, 0xD6E8FEB86659FD93) * np.uint64(3) + _mixed(b, b_starts, b_counts, 0xA0761D6478BD642F)
    _, first, kind = np.unique(hashes, return_index=True, return_inverse=True)
    like = first[kind]
    equal = (a_counts == a_counts[like]).all() and (b_counts == b_counts[like]).all()
    for ids, starts, counts in ((a, a_starts, a_counts), (b, b_starts, b_counts)):
        equal = equal and (ids == ids[np.arange(len(ids)) + np.repeat(starts[like] - starts, counts)]).all()
    if not equal:  # two windows of one hash: by their ids
        known = {}
        kind = np.array(
            [
                known.setdefault((a[i:j].tobytes(), b[k:l].tobytes()), len(known))
                for i, j, k, l in zip(a_starts, a_stops, b_starts, b_stops)
            ]
        )
        _, first = np.unique(kind, return_index=True)
    return first, kind


class Aligner:
    """Aligns chunks of texts."""

    def __init__(self, a: bytes, b: bytes):
        self.a, self.b = loaded(a, b)
        self.spaced = (self.a.vocabulary.spaced, self.b.vocabulary.spaced)
        self.lengths = (self.a.vocabulary.lengths, self.b.vocabulary.lengths)
        self.names = names_of(max(map(len, self.lengths)))

    def tokens(self, texts: list[str | None], size: int = SEGMENT) -> list[tuple[np.ndarray, np.ndarray]]:
        """The ids of both for every text, none where either does not give the bytes back."""
        none = np.zeros(0, np.int32)
        cut = [(segments(t, size) if self.b.within_words else [t]) if t else [] for t in texts]
        given = [own for own in cut if own]
        both = zip(encoded(self.a, given), encoded(self.b, given))
        out = []
        for text in texts:
            a, b = next(both) if text else (none, none)
            whole = b" " + (text or "").encode()
            if self.a.vocabulary.joined(a) != whole or self.b.vocabulary.joined(b) != whole:
                a = b = none
            out.append((a, b))
        return out

    def chunk(self, texts: list[str | None]) -> tuple[dict[str, np.ndarray | list], np.ndarray, np.ndarray]:
        """Columns of the documents, the chunk's distinct pairs, and how many of its documents hold each."""
        ids = self.tokens(texts)
        n_a, n_b = (np.array([len(own[i]) for own in ids], np.int64) for i in (0, 1))
        columns = {"n_a": n_a, "n_b": n_b, "n_groups": np.zeros(len(ids), np.int64), "n_links": np.zeros(len(ids), np.int64)}
        columns |= {"groups_sha256": [""] * len(ids), "n_pairs": np.zeros(len(ids), np.int64)}
        columns |= {"steps": np.zeros(0, np.uint32), "times": np.zeros(0, np.uint32)}
        if not n_a.any():
            return columns, np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b = (np.concatenate([own[i] for own in ids]) for i in (0, 1))
        a_ends, b_ends = (np.cumsum(v.vocabulary.lengths[x]) for v, x in ((self.a, a), (self.b, b)))
        full = np.flatnonzero(n_a)
        a_stops, b_stops = window_ends(a, b, a_ends, b_ends, a_ends[np.cumsum(n_a)[full] - 1], self.spaced)
        first, kind = same_windows(a, b, a_stops, b_stops)
        a_counts, b_counts = np.diff(a_stops, prepend=0)[first], np.diff(b_stops, prepend=0)[first]
        sides = ((a, a_stops[first], a_counts), (b, b_stops[first], b_counts))
        known = Alignments(*(part_of(ids, stops - n, n) for ids, stops, n in sides), a_counts, b_counts, self.lengths, self.names)
        # the documents' windows: each document with tokens ends at a window's end
        last = np.searchsorted(a_stops, np.cumsum(n_a)[full]) + 1
        begin = np.append(0, last[:-1])
        for name in ("n_groups", "n_links"):
            columns[name][full] = np.add.reduceat(getattr(known, name)[kind], begin)
        told, listed = known.text, kind.tolist()
        for doc, i, j in zip(full.tolist(), begin.tolist(), last.tolist()):
            text = ";".join(map(told.__getitem__, listed[i:j]))
            columns["groups_sha256"][doc] = hashlib.sha256(text.encode()).hexdigest()
        doc, pair, times, pairs = _links(np.repeat(np.arange(len(full)), last - begin), kind, known)
        columns["n_pairs"][full] = np.bincount(doc, minlength=len(full))
        columns |= {"steps": np.diff(pair, prepend=0).astype(np.int32).view(np.uint32), "times": times}
        return columns, pairs, np.bincount(pair, minlength=len(pairs))


def _links(doc: np.ndarray, kind: np.ndarray, known: Alignments) -> tuple[np.ndarray, ...]:
    """(document, pair's number, times) for each pair that a document holds, by document; and the pairs by number."""
    windows, often = np.unique(doc * len(known.sizes) + kind, return_counts=True)
    doc, kind = np.divmod(windows, len(known.sizes))
    pairs, numbers = np.unique(known.pairs, return_inverse=True)
    count = known.sizes[kind]
    starts = (np.cumsum(known.sizes) - known.sizes)[kind]
    key = np.repeat(doc, count) * len(pairs) + part_of(numbers, starts, count)
    held, inverse = np.unique(key, return_inverse=True)
    total = np.bincount(inverse, weights=part_of(known.times, starts, count) * np.repeat(often, count)).astype(np.int64)
    doc, pair = np.divmod(held, len(pairs))
    return doc, pair, total, pairs


def _stored(frame: dict) -> bytes:
    """Columns of any lengths as compressed Arrow streams."""
    out = io.BytesIO()
    for name, values in frame.items():
        batch = pa.RecordBatch.from_arrays([values if isinstance(values, pa.Array) else pa.array(values)], [name])
        with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_batch(batch)
    return out.getvalue()


def _restored(stored: bytes) -> dict[str, pa.Array]:
    source, out = io.BytesIO(stored), {}
    while source.tell() < len(stored):
        table = pa.ipc.open_stream(source).read_all()
        out[table.schema.names[0]] = table.column(0).combine_chunks()
    return out


def chunks(docs: DataFrame, a: bytes, b: bytes) -> DataFrame:
    """``chunk, docs, pairs, seen``: documents aligned chunk by chunk, without a shuffle."""

    def run(batches):
        from pyspark import TaskContext

        aligner, chunk = Aligner(a, b), TaskContext.get().partitionId() << 32
        for batch in pieces(batches, 1, CHUNK):
            columns, pairs, seen = aligner.chunk(batch.column(1).to_pylist())
            row = [[chunk], [_stored({"doc_id": batch.column(0)} | columns)], [pairs], [seen]]
            kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds)], ["chunk", "docs", "pairs", "seen"])
            chunk += 1

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "chunk long, docs binary, pairs array<long>, seen array<long>"
    )


def pair_counts(listed: DataFrame) -> DataFrame:
    """``pair, n``: documents that hold each pair; below zero where no pair of the same id of A is in more."""
    counts = listed.groupBy("pair").agg(F.sum("seen").alias("n"))
    # an id of A has at most as many pairs as B has ids
    highest = F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))
    return counts.select("pair", F.when(F.col("n") == highest, -F.col("n")).otherwise(F.col("n")).alias("n"))


RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)
RESULT_NAMES = [field.split()[0] for field in RESULT.split(", ")]


def _judged(stored: bytes, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The documents of a chunk, given the counts of its pairs in order."""
    columns = _restored(stored)
    held, steps, times = (columns[c].to_numpy(zero_copy_only=False) for c in ("n_pairs", "steps", "times"))
    own = counts[np.cumsum(steps.view(np.int32), dtype=np.int64)]
    times = times.astype(np.int64)
    for name, values in (("n_best", times * (own < 0)), ("count_sum", times * np.abs(own))):
        running = np.append(0, np.cumsum(values))
        stops = np.cumsum(held)
        columns[name] = pa.array(running[stops] - running[stops - held], pa.int64())
    yield pa.RecordBatch.from_arrays([columns[c] for c in RESULT_NAMES], RESULT_NAMES)


def align(docs: DataFrame, a: bytes, b: bytes) -> DataFrame:
    """The alignment of every document (``doc_id, text``), told by its numbers and by a digest of its groups."""
    stored = settled(chunks(docs, a, b), "chunks")
    listed = stored.select("chunk", F.posexplode(F.arrays_zip("pairs", "seen")).alias("place", "told"))
    listed = listed.select("chunk", "place", F.col("told.pairs").alias("pair"), F.col("told.seen").alias("seen"))
    # written, so that the join has an exchange on either side and the engine can split a pair of many chunks
    counts = settled(pair_counts(listed), "counts")
    own = listed.join(counts, "pair").select("chunk", "place", "n", F.lit(None).cast("binary").alias("docs"))
    rows = own.unionByName(stored.select("chunk", F.lit(LAST).alias("place"), F.lit(None).cast("long").alias("n"), "docs"))

    def run(batches):
        held = []  # counts of the chunk at hand, in the order of its pairs
        for batch in batches:
            documents = batch.column(3)
            ends = np.flatnonzero(documents.is_valid().to_numpy(zero_copy_only=False))
            numbers, at = batch.column(2).fill_null(0).to_numpy(zero_copy_only=False), 0
            for end in ends.tolist():
                held.append(numbers[at:end])
                yield from _judged(documents[end].as_py(), np.concatenate(held))
                held, at = [], end + 1
            held.append(numbers[at:].copy())

    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return rows.repartition(tasks, "chunk").sortWithinPartitions("chunk", "place").mapInArrow(run, RESULT)
