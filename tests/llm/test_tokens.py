"""Chat formatting and BPE: round trips, and the library's own results."""

from __future__ import annotations

import hashlib
from collections import Counter

import awkward
import numpy as np
import pytest
from conftest import TINY
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tripweave.llm import bpe, chat, queries
from tripweave.llm.common import table

STORED = queries.tokenizer_json()
LIBRARY = Tokenizer.from_buffer(STORED)
BPE = bpe.PairIndexBpe(STORED)
PIECES = ("<turn>", "</turn>", "<body>", "\\", "<", "/", "turn>", "### Assistant:", "<|endoftext|>", "é😀", " ", "\n", "a")


def by_library(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    return len(ids), digest, hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_bpe_of_any_text(text):
    assert np.frombuffer(BPE.encode([text])[0], "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from((*PIECES, "aaaa", "'s", "'S", "1234", "½", "\x1c", "\x85", "　", "the", "ing", "!!!"))))
def test_bpe_of_awkward_texts(parts):
    text = "".join(parts)
    ids = BPE.encode([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    assert BPE.decode(ids) == text


def test_spelt_out_classes():
    import regex

    for name, spelt in (("L", bpe._L), ("N", bpe._N), ("White_Space", bpe._W)):
        for code in range(0x2B0):
            assert bool(regex.match(rf"\p{{{name}}}", chr(code))) == bool(regex.match(f"[{spelt}]", chr(code))), hex(code)


@pytest.mark.parametrize("make", [lambda s: table(s, TINY, "documents"), lambda s: awkward.documents(s)])
def test_round_trip(spark, make):
    docs = make(spark)
    got = bpe.round_trip(docs, STORED).collect()
    assert Counter(map(tuple, got)) == Counter((i, *by_library(t or "")) for i, t in awkward.texts_of(docs))
    assert bpe.round_trip(awkward.empty(spark), STORED).count() == 0


def test_ids(spark):
    rows = bpe.encode(table(spark, TINY, "documents").limit(5), STORED).collect()
    assert all(len(r["ids"]) % 4 == 0 for r in rows)


def test_words_are_forgotten_and_encoded_again(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    own = bpe.PairIndexBpe(STORED)
    for text in ("one two three four", "five six seven", "one two three", "aaaa aaa aa"):
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES)))
def test_escapes_are_reversible_and_hide_controls(parts):
    text = "".join(parts)
    assert chat.unescaped(chat.escaped(text)) == text
    assert not any(c in chat.escaped(text) for c in chat.CONTROLS)


def conversations(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "\\<turn> </turn> <body>"), (1, None, None, None),
        (2, 0, "assistant", ""), (3, 1, "assistant", "b"), (3, 1, "assistant", "a"), (3, 1, "assistant", "a"),
        (None, 0, "system", "x"), (None, 1, "assistant", "y<turn>"), (4, 0, "<turn>", "### Assistant: </turn>"),
        (5, 0, "assistant", "lang " * 50_000), (5, 2, "user", "日本語 😀"), (5, 1, "Assistant", "no"),
    ]
    made = [(*row, [1], [2], "x", b"y") for row in rows]
    return spark.createDataFrame(
        made, "conv_id long, turn long, role string, text string, ids array<int>, loss_mask array<int>, formatted string, learnt binary"
    )


def by_hand(rows):
    out = {}
    for conv_id, turn, role, text in rows:
        out.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))
    told = []
    for conv_id, turns in out.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        learnt = "".join(t for *_, r, t in turns if r == "assistant")
        shown = "".join(f"<turn>{chat.escaped(r)}<body>{chat.escaped(t)}</turn>" for *_, r, t in turns)
        told.append((conv_id, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learnt),
                     hashlib.sha256(learnt.encode()).hexdigest(), len(shown)))
    return Counter(told)


def test_chat_digests(spark):
    turns = conversations(spark)
    got = chat.digests(chat.format_turns(turns, STORED), STORED).collect()
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    assert Counter(map(tuple, got)) == by_hand(rows)
    assert chat.digests(chat.format_turns(turns.limit(0), STORED), STORED).count() == 0


def test_chat_tokens(spark):
    reserved = LIBRARY.get_vocab_size(with_added_tokens=True)
    for row in chat.format_turns(conversations(spark), STORED).collect():
        ids, mask = row["ids"], row["loss_mask"]
        assert len(ids) == len(mask) and [i - reserved for i in ids if i >= reserved] == [0, 1, 2]
        assert LIBRARY.decode([i for i in ids if i < reserved], skip_special_tokens=False) == "".join(
            row["formatted"].removeprefix("<turn>").removesuffix("</turn>").split("<body>", 1)
        )


def test_chat_conversation_of_the_query(spark):
    rows = {r["conv_id"]: r for r in queries.op2_chat_format(spark, TINY).collect()}
    assert rows[-7]["n_turns"] == 2 and rows[-7]["loss_chars"] == len(queries.ESCAPE_TEST)
    assert rows[-7]["loss_sha256"] == hashlib.sha256(queries.ESCAPE_TEST.encode()).hexdigest()
