"""Alignment of two tokenizers against plain loops over the libraries' own tokens."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import awkward
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import TINY
from tokenizers import Tokenizer

from tripweave.llm import align, queries
from tripweave.llm.common import shipped, table


@pytest.fixture(scope="module")
def stored():
    return queries.tokenizer_json(), queries.piece_model()


@pytest.fixture(scope="module")
def tokens():
    """text -> (ids, bytes) of both, from the libraries alone."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    seen = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xAD)]
    letters = {chr(b): b for b in seen}
    letters |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in seen)}

    def both(text):
        ids = a.encode(" " + text, add_special_tokens=False).ids
        other = b.encode(text)
        left = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids]
        right = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in other]
        return list(zip(ids, left)), list(zip(other, right))

    return both


def groups_by_hand(text, tokens):
    """[(ids of A, ids of B)] of a text, nothing where the bytes do not come back."""
    if not text:
        return []
    a, b = tokens(text)
    whole = b" " + text.encode()
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return []
    ends = []
    for side in (a, b):
        stops, at = [], 0
        for i, entry in side:
            at += len(entry)
            stops.append((at, i))
        ends.append(stops)
    cuts = sorted({x for x, _ in ends[0]} & {x for x, _ in ends[1]})
    return [
        tuple([i for stop, i in side if low < stop <= high] for side in ends) for low, high in zip([0, *cuts], cuts)
    ] if len(cuts) < 3000 else _groups_of_long(ends, cuts)


def _groups_of_long(ends, cuts):
    places = [np.searchsorted([x for x, _ in side], cuts) + 1 for side in ends]
    out, at = [], (0, 0)
    for stop in zip(*places):
        out.append(tuple([i for _, i in side[low:high]] for side, low, high in zip(ends, at, stop)))
        at = stop
    return out


def aligned_by_hand(docs, tokens):
    linked, found = [], []
    for _, text in docs:
        groups = groups_by_hand(text, tokens)
        found.append(groups)
        linked.append(Counter((x, y) for a, b in groups for x in a for y in b))
    count = Counter(pair for own in linked for pair in own)
    highest = {}
    for (x, _), n in count.items():
        highest[x] = max(highest.get(x, 0), n)
    out = []
    for (doc_id, _), groups, own in zip(docs, found, linked):
        told = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append(
            (
                doc_id,
                sum(len(a) for a, _ in groups),
                sum(len(b) for _, b in groups),
                len(groups),
                sum(own.values()),
                sum(n for pair, n in own.items() if count[pair] == highest[pair[0]]),
                sum(n * count[pair] for pair, n in own.items()),
                hashlib.sha256(told.encode()).hexdigest() if groups else "",
            )
        )
    return Counter(out)


TEXTS = (
    "<|endoftext|> and <s> </s> <unk> are text <0x0A>",
    "two  spaces\tand tabs \r\n\n lines   ",
    "naïve café 日本語の文字 😀😀 é ▁ piece   space​ zero",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 9 + "=" * 500,
    "  leading",
    "ﬁligature ﬁ １２ full ｗｉｄｅ",
    "\x00\x01 control \x7f",
    "x",
)


def test_documents_by_hand(spark, stored, tokens):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, TINY, "documents").collect()]
    docs += [(10_000 + n, t) for n, t in enumerate(TEXTS)] + [(None, TEXTS[0]), (3, docs[3][1]), (None, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = Counter(map(tuple, align.align(frame, *stored).collect()))
    assert got == aligned_by_hand(docs, tokens)


def test_small_chunks_and_segments_change_nothing(spark, stored, tokens, monkeypatch):
    docs = [(n, t) for n, t in enumerate(TEXTS)] + [(100, " ".join(TEXTS)), (101, "lorem ipsum dolor sit " * 40)]
    shipped(spark)
    expected = aligned_by_hand(docs, tokens)
    by_id = {row[0]: row for row in expected}
    for size, large, fast in ((20, 1 << 12, True), (1 << 16, 3, True), (20, 3, False)):
        aligner = align.Aligner(*stored)
        with monkeypatch.context() as patched:
            patched.setattr(align.Aligner.tokens, "__defaults__", (size,))
            patched.setattr(align, "LARGE", large)
            if not fast:
                patched.setattr(aligner.a, "fast", None)
            columns, pairs, seen = aligner.chunk([t for _, t in docs])
        for place, (doc_id, _) in enumerate(docs):
            told = [columns[c][place] for c in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
            assert told == [*by_id[doc_id][1:5], by_id[doc_id][7]]
    monkeypatch.setattr(align, "CHUNK", 40)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert Counter(map(tuple, align.align(frame, *stored).collect())) == expected
    assert len(pairs) == len(set(pairs.tolist())) and seen.min() >= 1


def test_segments_are_cut_between_letters():
    rng = random.Random(5)
    text = "".join(rng.choice("ab  .9\n") for _ in range(5000))
    parts = align.segments(text, 30)
    assert len(parts) > 50 and " ".join(parts) == text
    assert all(p[0].isalpha() and q[-1].isalpha() for q, p in zip(parts, parts[1:]))


def test_ranks_encode_like_the_library(stored, tokens):
    tokenizer, rng = align.ByteLevel(stored[0]), random.Random(8)
    assert tokenizer.fast is not None
    sure = [chr(i) for i in range(ord(align.UNSURE))]
    texts = [f"{x}{c}{y}" for c in sure for x, y in (("", ""), ("a ", " b"), ("1", "'s"), ("  ", "  "), ("\n", "."))]
    texts += ["".join(rng.choice(sure + list(" \n'ae1.") * 40) for _ in range(30)) for _ in range(3000)]
    assert all(max(t) < align.UNSURE for t in texts)
    assert [ids.tolist() for ids in tokenizer.encode(texts)] == [[i for i, _ in tokens(t)[0]] for t in texts]


def test_windows_of_one_hash_are_told_apart(monkeypatch):
    a, b = np.array([5, 6, 5, 6, 7], np.int32), np.array([1, 2, 1, 2, 2], np.int32)
    stops = np.arange(1, 6)
    plain = align.same_windows(a, b, stops, stops)
    monkeypatch.setattr(align, "_mixed", lambda ids, starts, counts, factor: np.zeros(len(starts), np.uint64))
    first, kind = align.same_windows(a, b, stops, stops)
    assert len(first) == len(plain[0]) == 3 and kind.tolist() == [0, 1, 0, 1, 2] and first.tolist() == [0, 1, 4]


def test_awkward_rows(spark, stored, tokens):
    docs = awkward.documents(spark)
    expected = aligned_by_hand(awkward.texts_of(docs), tokens)
    assert Counter(map(tuple, align.align(docs, *stored).collect())) == expected
    assert align.align(awkward.empty(spark), *stored).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, align.align(nothing, *stored).collect())) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]
