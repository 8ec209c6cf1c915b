r"""Chat formatting at token level, and reading the result back.

A turn is ``<turn>``, its role, ``<body>``, its text and ``</turn>``. Role and text are
encoded by themselves, so no token spans a border, and the three control strings are
spliced in as reserved ids above the vocabulary. The loss mask is a running sum of +1
where an assistant's text starts and -1 where it ends.

A control string inside a role or text is broken by a backslash after its first
character, and every backslash is doubled, so the text can be restored.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import pieces

CONTROLS = ("<turn>", "<body>", "</turn>")
OPEN, BODY, CLOSE = range(3)
LOSS_ROLE = "assistant"
BATCH_BYTES = 1 << 20  # of text encoded together: the tokenizer keeps far more for each token than its id
TURNS = 512  # decoded together
_BREAKABLE = re.compile("|".join(f"(?<={re.escape(c[0])})(?={re.escape(c[1:])})" for c in CONTROLS))


def escaped(text: str) -> str:
    return _BREAKABLE.sub(r"\\", text.replace("\\", "\\\\"))


def unescaped(text: str) -> str:
    return re.sub(r"(?s)\\(.)", r"\1", text)


@lru_cache(4)
def _tokenizer(stored: bytes):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_buffer(stored)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.encode_special_tokens = True  # in a text they are ordinary characters
    return tokenizer, tokenizer.get_vocab_size(with_added_tokens=True)


def assemble(roles: list[str], texts: list[str], stored: bytes) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Ids and loss mask of each turn. All turns are laid out end to end and then cut apart."""
    tokenizer, reserved = _tokenizer(stored)
    encoded = tokenizer.encode_batch_fast([escaped(x) for pair in zip(roles, texts) for x in pair], add_special_tokens=False)
    segments = [np.array(e.ids, np.int32) for e in encoded]
    control = [np.array([reserved + c], np.int32) for c in range(len(CONTROLS))]
    spliced = [
        part
        for role, text in zip(segments[::2], segments[1::2])
        for part in (control[OPEN], role, control[BODY], text, control[CLOSE])
    ]
    ends = np.cumsum([len(part) for part in spliced])
    ids, starts = np.concatenate(spliced), ends - [len(part) for part in spliced]
    steps = np.zeros(len(ids) + 1, np.int32)
    learnt = 5 * np.flatnonzero([role == LOSS_ROLE for role in roles]) + 3
    np.add.at(steps, starts[learnt], 1)
    np.add.at(steps, ends[learnt], -1)
    mask = np.cumsum(steps[:-1]).astype(np.int8)
    cuts = ends[4::5][:-1]
    return np.split(ids, cuts), np.split(mask, cuts)


def format_turns(turns: DataFrame, tokenizer_json: bytes) -> DataFrame:
    """``conv_id, turn, role, text`` to ``conv_id, turn, ids, loss_mask, formatted`` per turn, without a shuffle.

    A null role or text is an empty one, and only the role ``assistant`` is learnt.
    Repeated rows are turns of their own; other columns are not read.
    """

    def run(batches):
        for batch in pieces(batches, text=3, limit=BATCH_BYTES):
            if batch.num_rows == 0:
                continue
            roles, texts = ([x or "" for x in batch.column(i).to_pylist()] for i in (2, 3))
            ids, masks = assemble(roles, texts, tokenizer_json)
            shown = [
                f"{CONTROLS[OPEN]}{escaped(r)}{CONTROLS[BODY]}{escaped(t)}{CONTROLS[CLOSE]}" for r, t in zip(roles, texts)
            ]
            columns = [pa.array(ids, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.int8())), pa.array(shown)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *columns], ["conv_id", "turn", "ids", "loss_mask", "formatted"]
            )

    return turns.select("conv_id", "turn", "role", "text").mapInArrow(
        run, "conv_id long, turn long, ids array<int>, loss_mask array<tinyint>, formatted string"
    )


def read_back(ids: list[np.ndarray], masks: list[np.ndarray], stored: bytes) -> list[list[str]]:
    """Roles, texts and learnt texts of turns, from their ids and masks alone."""
    tokenizer, reserved = _tokenizer(stored)
    parts = []
    for own, mask in zip(ids, masks):
        body = int(np.flatnonzero(own == reserved + BODY)[0])
        parts += [own[1:body].tolist(), own[body + 1 : -1].tolist(), own[mask.astype(bool)].tolist()]
    texts = [unescaped(t) for t in tokenizer.decode_batch(parts, skip_special_tokens=False)]
    return [texts[i::3] for i in range(3)]


def _split(lists: pa.Array) -> list[np.ndarray]:
    return np.split(lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lists.value_lengths().to_numpy())[:-1])


class _Digest:
    """What is told of one conversation; fed a turn at a time, its size does not depend on the turns."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, role: str, text: str, learnt: str, formatted: str) -> None:
        self.turns.update(f"{role}\n{text}\n".encode())
        self.loss.update(learnt.encode())
        self.n_turns += 1
        self.loss_chars += len(learnt)
        self.chars += len(formatted)

    def row(self, conv_id) -> tuple:
        return conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


DIGEST = (
    ("conv_id", pa.int64()),
    ("n_turns", pa.int64()),
    ("turns_sha256", pa.string()),
    ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()),
    ("formatted_chars", pa.int64()),
)


def digests(formatted: DataFrame, tokenizer_json: bytes) -> DataFrame:
    """One row per conversation, read back from formatted turns in the order of their numbers.

    The turns of a conversation are decoded before the shuffle and then pass through one
    task in order, for a digest is a sequence; that task keeps digest states and never the
    turns themselves. A null conv_id is a conversation of its own, a null turn comes first;
    turns with one number follow in the order of role and text.
    """

    def decode(batches):
        names = ["conv_id", "turn", "role", "said", "learnt", "shown"]
        for whole in batches:
            for at in range(0, whole.num_rows, TURNS):
                batch = whole.slice(at, TURNS)
                read = read_back(_split(batch.column(2)), _split(batch.column(3)), tokenizer_json)
                texts = [pa.array(column, pa.string()) for column in read]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *texts, batch.column(4)], names)

    def run(batches):
        current, digest = None, None
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5)))
            done = []
            for conv_id, own in groupby(rows, key=lambda row: row[0]):
                if digest is None or conv_id != current:
                    if digest is not None:
                        done.append(digest.row(current))
                    current, digest = conv_id, _Digest()
                for row in own:
                    digest.add(*row[1:])
            yield _rows(done)
        if digest is not None:
            yield _rows([digest.row(current)])

    def _rows(done):
        columns = [pa.array([row[i] for row in done], kind) for i, (_, kind) in enumerate(DIGEST)]
        return pa.RecordBatch.from_arrays(columns, [name for name, _ in DIGEST])

    read = formatted.select("conv_id", "turn", "ids", "loss_mask", "formatted").mapInArrow(
        decode, "conv_id long, turn long, role string, said string, learnt string, shown string"
    )
    ordered = read.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "said")
    return ordered.mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
