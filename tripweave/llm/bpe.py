"""Byte-level BPE by a pair occurrence index.

The distinct words of a chunk are laid out as one linked sequence of symbols. Each pair
that has a merge rank is mapped to all its positions. Ranks that occur are taken in
ascending order: all occurrences of a pair are merged at once, the links around them
change, and only the pairs next to them enter new lists. Since a merge makes a symbol that
only later ranks contain, no rank has to be taken twice.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tripweave.llm.common import pieces

# Fixed value: how the byte-level tokenizer cuts texts into words, with white space as Unicode defines it.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
# The same for texts below U+02B0, where the classes are short enough to be spelt out (and run faster).
_L, _N, _W = "A-Za-zªµºÀ-ÖØ-öø-ʯ", "0-9²³¹¼-¾", r"\t-\r \x85\xa0"
LATIN = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{_L}]+| ?[{_N}]+| ?[^{_W}{_L}{_N}]+|[{_W}]+(?![^{_W}])|[{_W}]+")
BEYOND_LATIN = re.compile("[\u02b0-\U0010ffff]")
CHUNK = 4 << 20  # bytes of text whose new words are merged together
CACHED_WORDS = 200_000  # a task forgets its words beyond this many and encodes them again when they recur
SHIFT = np.int64(20)


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class PairIndexBpe:
    """Encodes and decodes as the stored byte-level BPE tokenizer does."""

    def __init__(self, stored: bytes):
        spec = json.loads(stored)
        model, pre = spec["model"], spec["pre_tokenizer"]
        plain = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or any(map(model.get, plain)):
            raise ValueError("only plain byte-level BPE without a normalizer is supported")
        vocabulary, letters = model["vocab"], _byte_letters()
        self.of_byte = np.array([vocabulary[letter] for letter in letters], np.int32)
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        left, right, made = (
            np.array([vocabulary[x] for x in side], np.int64)
            for side in ([p[0] for p in pairs], [p[1] for p in pairs], [p[0] + p[1] for p in pairs])
        )
        self.left, self.right, self.made = left, right, made
        codes = (left << SHIFT) | right
        self.order = np.argsort(codes, kind="stable")
        self.codes = codes[self.order]
        byte_of = {letter: b for b, letter in enumerate(letters)}
        self.text_of = {i: bytes(byte_of[c] for c in token) for token, i in vocabulary.items()}
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take in white space or need a word's border are not supported")
        self.text_of |= {i: content.encode() for content, i in added.items()}
        self.added = {content: np.array([i], "<u4").tobytes() for content, i in added.items()}
        names = "|".join(map(regex.escape, sorted(added, key=len, reverse=True)))
        self.borders = regex.compile(f"({names})") if added else None
        self.words = regex.compile(PATTERN)
        self.known: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        """The words of a text; an added token is a word of its own."""
        words = self.words if BEYOND_LATIN.search(text) else LATIN
        if self.borders is None or not any(map(text.__contains__, self.added)):
            return words.findall(text)
        parts = self.borders.split(text)
        return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else words.findall(part))]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        once: dict[str, str] = {}  # a word that recurs is held once, not once for each place
        split = [[once.setdefault(w, w) for w in self.split(text)] for text in texts]
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        self.known.update(self.added)
        fresh = [*once.keys() - self.known.keys()]
        self.known.update(zip(fresh, self.merge([w.encode() for w in fresh])))
        return [b"".join(map(self.known.__getitem__, words)) for words in split]

    def decode(self, ids: bytes) -> str:
        found = b"".join(map(self.text_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return found.decode("utf-8", "replace")

    def _ranks(self, symbols: np.ndarray, at: np.ndarray, after: np.ndarray) -> np.ndarray:
        """The rank of the pair that starts at each place, -1 without one."""
        codes = (symbols[at].astype(np.int64) << SHIFT) | symbols[after]
        found = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[found] == codes, self.order[found], -1)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word."""
        if not words:
            return []
        symbols = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        ends = np.cumsum([len(w) for w in words])
        after = np.arange(1, len(symbols) + 1, dtype=np.int32)
        after[ends - 1] = -1
        before = np.arange(-1, len(symbols) - 1, dtype=np.int32)
        before[ends[:-1]] = -1
        merged = np.zeros(len(symbols), bool)
        places: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(at: np.ndarray) -> None:
            """Enter the pairs that start at ``at`` into the lists of their ranks."""
            ranks = self._ranks(symbols, at, after[at])
            at, ranks = at[ranks >= 0], ranks[ranks >= 0]
            if not len(at):
                return
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for own, rank in zip(np.split(at, cuts), ranks[np.concatenate(([0], cuts))].tolist()):
                if rank not in places:
                    places[rank] = []
                    heapq.heappush(active, rank)
                places[rank].append(own)

        note(np.flatnonzero(after >= 0).astype(np.int32))
        while active:
            rank = heapq.heappop(active)
            lists = places.pop(rank)
            at = lists[0] if len(lists) == 1 else np.concatenate(lists)
            # a list may hold places whose pair has changed since, but none twice
            next_ = after[at]
            at = at[(next_ >= 0) & (symbols[at] == self.left[rank]) & (symbols[next_] == self.right[rank])]
            if self.left[rank] == self.right[rank]:
                at = self._apart(np.sort(at), after)
            if not len(at):
                continue
            gone = after[at]
            behind = after[gone]
            symbols[at], symbols[gone] = self.made[rank], -1
            after[at] = behind
            linked = behind >= 0
            before[behind[linked]] = at[linked]
            ahead = before[at]
            merged[at] = True
            ahead = ahead[ahead >= 0]
            note(np.concatenate((ahead[~merged[ahead]], at[linked])))
            merged[at] = False
        return self._cut(symbols, ends)

    @staticmethod
    def _apart(at: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Of pairs of one repeated symbol those that are merged: from the left, without overlap."""
        taken, last = [], -1
        for place, follower in zip(at.tolist(), after[at].tolist()):
            if place != last:
                taken.append(place)
                last = follower
            else:
                last = -1
        return np.array(taken, np.int32)

    @staticmethod
    def _cut(symbols: np.ndarray, ends: np.ndarray) -> list[bytes]:
        live = symbols >= 0
        upto = np.concatenate(([0], np.cumsum(live)[ends - 1])) * 4
        flat = symbols[live].astype("<u4").tobytes()
        bounds = upto.tolist()
        return [flat[a:b] for a, b in zip(bounds, bounds[1:])]


@lru_cache(2)
def _loaded(stored: bytes) -> PairIndexBpe:
    return PairIndexBpe(stored)


def encode(docs: DataFrame, tokenizer_json: bytes) -> DataFrame:
    """``doc_id, ids`` (binary, little-endian unsigned 32-bit) of every row, without a shuffle."""

    def run(batches):
        bpe = _loaded(tokenizer_json)
        for batch in pieces(batches, limit=CHUNK):
            ids = bpe.encode([text or "" for text in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def round_trip(docs: DataFrame, tokenizer_json: bytes) -> DataFrame:
    """Number and digest of every row's ids, and the digest of the text decoded from them.

    A null text is an empty one; repeated rows are encoded each; an empty table gives no rows.
    """

    def run(batches):
        bpe = _loaded(tokenizer_json)
        for batch in pieces(batches, limit=CHUNK):
            ids = bpe.encode([text or "" for text in batch.column(1).to_pylist()])
            columns = [
                pa.array([len(i) // 4 for i in ids], pa.int64()),
                pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                pa.array([hashlib.sha256(bpe.decode(i).encode()).hexdigest() for i in ids], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], NAMES)

    NAMES = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
