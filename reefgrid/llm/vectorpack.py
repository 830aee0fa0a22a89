"""Packing of training examples under limits on tokens, segments and loss-bearing tokens at once.

An example is a vector: its tokens, one segment, and the tokens that bear loss. A
sequence takes, of the examples at hand, the one whose vector has the largest
weighted dot product with the room left in every dimension; a dimension weighs as
much as the examples use of it. Where none fits whole, one is cut to fill the
sequence. Every task packs what it tokenises, in one pass and with bounded memory,
and hands on only the sequence it could not fill; those meet by the dozen in
rounds until one is left, which is cut at powers of two.
"""

from __future__ import annotations

import dataclasses
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reefgrid.llm.common import slices, stored, texts_of
from reefgrid.llm.packing import _tokens, tokenizer_path

#: Examples and tokens that a task chooses from (matters of memory only).
WINDOW, WINDOW_TOKENS = 1024, 4_000_000
#: Tasks whose unfilled sequences meet in one group of the next round.
MEETING = 64
END_ID = 2


@dataclasses.dataclass(frozen=True)
class Limits:
    """What a sequence may hold."""

    tokens: int = 4096
    segments: int = 512
    loss: int = 4096


@dataclasses.dataclass
class Item:
    """What is left of an example: ``ids`` from ``start`` on, the first ``prompt`` of which bear no loss."""

    doc: int | None
    total: int
    start: int
    prompt: int
    ids: bytes | memoryview

    @property
    def tokens(self) -> int:
        return len(self.ids) // 4

    @property
    def loss(self) -> int:
        return max(0, self.tokens - self.prompt)

    def parted(self, n: int) -> tuple[Item, Item]:
        """The first ``n`` tokens and the rest."""
        ids = memoryview(self.ids)
        return (dataclasses.replace(self, prompt=min(n, self.prompt), ids=ids[: 4 * n]),
                dataclasses.replace(self, start=self.start + n, prompt=max(0, self.prompt - n), ids=ids[4 * n :]))


class Packer:
    """Fills sequences from a window of examples."""

    _NONE = 1 << 60

    def __init__(self, limits: Limits, window: int = WINDOW, window_tokens: int = WINDOW_TOKENS):
        self.limits, self.most_tokens = limits, window_tokens
        self.items: list[Item | None] = [None] * window
        self.tokens, self.loss = np.full(window, self._NONE), np.zeros(window, np.int64)
        self.prompt = np.zeros(window, np.int64)
        self.free, self.held = list(range(window - 1, -1, -1)), 0
        self.waiting: deque[Item] = deque()
        self.seen = np.zeros(3)  # examples, and the tokens and loss-bearing tokens they have

    def add(self, item: Item) -> None:
        self.seen += (1, item.tokens, item.loss)
        self.waiting.append(item)
        self._load()

    def full(self) -> bool:
        return bool(self.waiting)

    def empty(self) -> bool:
        return not self.held and not self.waiting

    def _load(self) -> None:
        while self.waiting and self.free and (not self.held or self.held + self.waiting[0].tokens <= self.most_tokens):
            self._put(self.free.pop(), self.waiting.popleft())

    def _put(self, at: int, item: Item) -> None:
        self.items[at] = item
        self.tokens[at], self.loss[at], self.prompt[at] = item.tokens, item.loss, item.prompt
        self.held += item.tokens

    def _take(self, at: int, n: int) -> Item:
        """The first ``n`` tokens of the window's example ``at``; its rest stays in the window."""
        item = self.items[at]
        self.held -= item.tokens
        if n < item.tokens:
            item, rest = item.parted(n)
            self._put(at, rest)
        else:
            self.items[at], self.tokens[at], self.loss[at] = None, self._NONE, 0
            self.free.append(at)
            self._load()
        return item

    def _choose(self, room: int, segments: int, loss: int) -> tuple[int, int] | None:
        """The example that comes next, and how many of its tokens."""
        here = self.tokens < self._NONE
        if segments > 1:
            fits = (self.tokens <= room) & (self.loss <= loss)
            mean = self.seen / max(self.seen[0], 1)
            limits = self.limits
            score = (
                self.tokens * (mean[1] / limits.tokens * room / limits.tokens**2)
                + self.loss * (mean[2] / limits.loss * loss / limits.loss**2)
                + segments / limits.segments**3
            )
            at = int(np.where(fits, score, -1.0).argmax())
            if fits[at]:
                return at, int(self.tokens[at])
        # No example fits whole, or only one more may come: the one that fills most, of those the longest.
        part = np.where(here, np.minimum(np.minimum(self.tokens, room), self.prompt + loss), 0)
        most = int(part.max())
        if most <= 0:
            return None
        return int(np.where(part == most, np.where(here, self.tokens, 0), -1).argmax()), most

    def sequence(self, last: bool) -> tuple[list[Item], bool]:
        """The next sequence's pieces, and whether it is done; it is not if the examples came to an end before its limits.

        A sequence short of its limit on tokens, of the last examples of all or at another limit, is cut at
        a power of two, and the rest goes on.
        """
        limits, pieces = self.limits, []
        room, loss = limits.tokens, limits.loss
        while room and len(pieces) < limits.segments:
            chosen = self._choose(room, limits.segments - len(pieces), loss)
            if chosen is None:
                break
            piece = self._take(*chosen)
            pieces.append(piece)
            room, loss = room - piece.tokens, loss - piece.loss
        if room and not last and self.empty() and len(pieces) < limits.segments:
            return pieces, False
        if room:
            size = limits.tokens - room
            over = size - (1 << size.bit_length() - 1)
            while over:
                piece = pieces.pop()
                if piece.tokens > over:
                    kept, piece = piece.parted(piece.tokens - over)
                    pieces.append(kept)
                over -= piece.tokens
                self.waiting.appendleft(piece)
            self._load()
        return pieces, True


_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, segment int, loss long, "
    "ids binary, open boolean, prompt long, part long"
)
_KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(),
          pa.binary(), pa.bool_(), pa.int64(), pa.int64())
_NAMES = [c.split()[0] for c in _PIECES.split(", ")]


class _Out:
    """Rows of the sequences of one task or group."""

    def __init__(self, round_: int, part: int, with_ids: bool):
        self.base, self.part, self.with_ids = (round_ << 58) | (part << 32), part, with_ids
        self.rows: list[tuple] = []
        self.sequences = 0

    def put(self, pieces: list[Item], done: bool) -> None:
        offset = 0
        for n, p in enumerate(pieces):
            ids = bytes(p.ids)
            self.rows.append((
                p.doc, p.start, p.tokens, zlib.crc32(ids), p.total, self.base | self.sequences if done else None, offset if done else None,
                n, p.loss, ids if self.with_ids or not done else None, not done, p.prompt, self.part))
            offset += p.tokens
        self.sequences += 1

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * len(_KINDS), _KINDS)], _NAMES)


def _first_round(path: str, limits: Limits, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, packer = _tokens(path), Packer(limits)
        out = _Out(0, TaskContext.get().partitionId(), with_ids)
        end = end_id.to_bytes(4, "little")
        for batch in slices(batches, "text"):
            for doc, prompt, text in zip(batch.column(0).to_pylist(), texts_of(batch, "prompt"), texts_of(batch, "text")):
                ahead = tokens.of(prompt) if prompt else b""
                ids = ahead + tokens.of(text) + end
                packer.add(Item(doc, len(ids) // 4, 0, len(ahead) // 4, ids))
                while packer.full():
                    out.put(*packer.sequence(False))
            yield out.batch()
        while not packer.empty():
            out.put(*packer.sequence(False))
        yield out.batch()
    return run


def _next_round(round_: int, limits: Limits, last: bool, with_ids: bool):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        packer, out = Packer(limits), _Out(round_, key[0].as_py(), with_ids)
        for row in rows.sort_by([("part", "ascending"), ("segment", "ascending")]).to_pylist():
            packer.add(Item(row["doc_id"], row["doc_tokens"], row["start"], row["prompt"], row["ids"]))
            while packer.full():
                out.put(*packer.sequence(False))
        while not packer.empty():
            out.put(*packer.sequence(last))
        return pa.Table.from_batches([out.batch()])
    return run


def pack_examples(examples: DataFrame, limits: Limits = Limits(), path: str | None = None, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, segment, loss[, ids])`` of every piece.

    ``examples`` have ``doc_id`` and ``text``, and may have a ``prompt`` that goes
    before the text and bears no loss. An example is the ids of both and ``end_id``;
    ``ids`` are a piece's, as little-endian 32-bit numbers. A piece ``start``s so
    many ids into its example and stands at ``offset`` of its sequence, with
    ``segment`` pieces before it. No sequence exceeds a limit; its length is the
    limit on tokens or, where another limit or the end of all examples comes
    first, a power of two, so none is padded.

    Null and empty texts are the closing id alone, a null ``doc_id`` stays null,
    repeated rows are each packed, texts are taken whole and cut as often as
    needed. Other columns are ignored; an empty table gives no rows.
    """
    prompt = F.col("prompt") if "prompt" in examples.columns else F.lit(None).cast("string")
    rows = examples.select(F.col("doc_id").cast("long").alias("doc_id"), prompt.alias("prompt"), "text")
    done, round_ = [], 0
    packed = stored(rows.mapInArrow(_first_round(path or tokenizer_path(), limits, end_id, with_ids), _PIECES), "vectorpack-0")
    while True:
        done.append(packed.filter("NOT open"))
        unfilled = packed.filter("open")
        parts = unfilled.agg(F.max("part")).first()[0]
        if parts is None:
            break
        round_ += 1
        # A task hands on less than one sequence, so a group holds at most MEETING of them.
        groups = unfilled.withColumn("group", F.floor(F.col("part") / MEETING)).groupBy("group")
        packed = stored(groups.applyInArrow(_next_round(round_, limits, parts < MEETING, with_ids), _PIECES), f"vectorpack-{round_}")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(*_NAMES[:9], *(["ids"] if with_ids else []))


def instruction_examples(conversations: DataFrame) -> DataFrame:
    """``(doc_id, turn, prompt, text)``: each assistant's turn of a conversation after the turn before it.

    ``doc_id`` is the conversation's id. Of several rows for the turn before, the
    smallest text counts; a first turn has no prompt. Conversations are never
    gathered: turns meet by conversation and number.
    """
    before = conversations.filter("conv_id IS NOT NULL AND turn IS NOT NULL").groupBy(
        F.col("conv_id").alias("of"), (F.col("turn") + 1).alias("before")).agg(F.min("text").alias("prompt"))
    answers = conversations.filter("role = 'assistant'").select(F.col("conv_id").alias("doc_id"), "turn", "text")
    return answers.join(before, (F.col("doc_id") == F.col("of")) & (F.col("turn") == F.col("before")), "left").select("doc_id", "turn", "prompt", "text")
