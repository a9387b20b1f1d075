"""Packing into training sequences: vector bin packing by dot products.

Every example has a demand vector (tokens, segments, loss-bearing tokens) and every sequence the same limits.  A
sequence is filled by the example whose demand has the largest inner product with what the sequence has
left, both scaled by the limits, among those that fit in every dimension; once none fits, one is cut to fill
the rest.  Examples longer than a sequence give whole sequences first.

A task packs the rows it reads, with a pool of at most `POOL` examples by demand, so nothing is shuffled and memory is
bounded.  A sequence that another limit than that on tokens leaves partly filled, and a task's last one, is dealt out
into sequences whose lengths are powers of two, which need no padding.  A sequence id joins the task's partition and its own count, so a task that runs again gives the same ids.

Null text is an empty example of its end id alone.  Repeated rows are packed each on their own.  Loss-bearing tokens
are all tokens, unless a column names how many of the last tokens bear loss; null there counts as none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import released
from paperloom.llm.token_ids import Encoder, shared_encoder

LENGTH, SEGMENTS, POOL = 2048, 256, 2048
_PIECE = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
          ("offset", pa.int64()), ("loss_tokens", pa.int64()), ("ids", pa.binary())]


class Example:
    """A document's ids from `base` on; a pool keeps only what is still to be placed."""

    __slots__ = ("base", "doc_id", "ids", "loss_from", "tokens")

    def __init__(self, doc_id, ids, loss_from=0, base=0, tokens=None):
        self.doc_id, self.ids, self.loss_from, self.base = doc_id, ids, loss_from, base
        self.tokens = len(ids) if tokens is None else tokens

    def rest(self, start):
        return Example(self.doc_id, self.ids[start - self.base:].copy(), self.loss_from, start, self.tokens)

    def piece(self, start, n):
        return self.ids[start - self.base: start - self.base + n].astype("<u4").tobytes()


class Packer:
    """Packs examples as they come; `ready` holds finished pieces (example, start, length, sequence, offset)."""

    def __init__(self, limits: tuple[int, int, int], pool: int = POOL):
        self.limits = np.array(limits, np.int64)
        self.size, self.loss_limit = int(limits[0]), int(limits[2])
        self.most = pool
        self.pool: list = []  # (example, start, tokens, loss start)
        self.ready: list = []
        self.sequence = 0

    def _loss(self, start, tokens, loss_from):
        return max(0, start + tokens - max(start, loss_from))

    def add(self, example: Example) -> None:
        tokens, loss_from, start = example.tokens, example.loss_from, 0
        while tokens - start >= self.size and self._loss(start, self.size, loss_from) <= self.loss_limit:
            self._put(example, start, self.size, 0)
            self.sequence += 1
            start += self.size
        if start and tokens > start:
            example = example.rest(start)
        while tokens > start:
            n = min(tokens - start, self.size)
            while self._loss(start, n, loss_from) > self.loss_limit:
                n -= self._loss(start, n, loss_from) - self.loss_limit
            self.pool.append((example, start, n, loss_from))
            start += n
        if len(self.pool) >= self.most:
            self._pack(self.most // 4)

    def _put(self, example, start, length, offset):
        self.ready.append((example, start, length, self.sequence, offset))

    def _pack(self, keep: int) -> None:
        """Fill sequences until at most `keep` examples are left."""
        items = self.pool
        demand = np.array([(n, 1, self._loss(s, n, f)) for _, s, n, f in items], np.int64).reshape(-1, 3)
        scaled = demand / self.limits
        free = np.ones(len(items), bool)
        count = len(items)
        while count > keep:
            left, offset = self.limits.copy(), 0
            while True:
                fits = np.flatnonzero(free & (demand <= left).all(axis=1))
                if len(fits):
                    best = int(fits[np.argmax(scaled[fits] @ (left / self.limits))])
                    example, start, n, _ = items[best]
                    self._put(example, start, n, offset)
                    offset += n
                    left -= demand[best]
                    free[best] = False
                    count -= 1
                    if count or left[0] == 0:
                        if left[0] == 0 or left[1] == 0:
                            break
                        continue
                if count == 0:
                    break
                # None fits: cut the longest one that may be cut.
                rest = np.flatnonzero(free)
                best = int(rest[np.argmax(demand[rest, 0])])
                example, start, n, loss_from = items[best]
                part = min(int(left[0]), n)
                over = self._loss(start, part, loss_from) - int(left[2])
                part -= max(over, 0)
                if part <= 0 or left[1] == 0:
                    break
                self._put(example, start, part, offset)
                offset += part
                left -= (part, 1, self._loss(start, part, loss_from))
                if part == n:
                    free[best] = False
                    count -= 1
                else:
                    items[best] = (example, start + part, n - part, loss_from)
                    demand[best] = (n - part, 1, self._loss(start + part, n - part, loss_from))
                    scaled[best] = demand[best] / self.limits
                if left[0] == 0 or left[1] == 0 or count == 0:
                    break
            if offset < self.size:
                self._split(offset)
            self.sequence += 1
        self.pool = [items[k] for k in np.flatnonzero(free)]

    def _split(self, total: int) -> None:
        """Deal a partly filled sequence, the last one put, out into sequences of powers of two."""
        if total & (total - 1) == 0:
            return
        first = len(self.ready)
        while first and self.ready[first - 1][3] == self.sequence:
            first -= 1
        own = self.ready[first:]
        del self.ready[first:]
        room, offset = 1 << (total.bit_length() - 1), 0
        for example, start, n, _, _ in own:
            while n:
                part = min(n, room - offset)
                self._put(example, start, part, offset)
                start, n, offset, total = start + part, n - part, offset + part, total - part
                if offset == room and total:
                    self.sequence += 1
                    room, offset = 1 << (total.bit_length() - 1), 0

    def finish(self) -> None:
        self._pack(0)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, length: int = LENGTH, segments: int = SEGMENTS,
         loss_tokens: int | None = None, loss_column: str | None = None, keep_encoder: bool = True) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset, loss_tokens, ids) of docs (doc_id, text).

    `ids` are the piece's ids as little-endian unsigned 32-bit integers.  `loss_tokens` limits the loss-bearing
    tokens of a sequence; `loss_column` has how many tokens at the end of an example bear loss (all without it).
    With `keep_encoder` a worker process keeps tokenizer and learnt words for its next tasks; without, each task
    frees them, which suits a pipeline whose other stages use the same workers.
    """
    limits = (length, segments, length if loss_tokens is None else loss_tokens)
    if min(limits) < 1:
        raise ValueError("a sequence takes at least one token, one segment and one loss-bearing token")
    bears = F.col(loss_column).cast("long") if loss_column else F.lit(-1).cast("long")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                         F.coalesce(bears, F.lit(0)).alias("bears"))

    def run(batches):
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 33
        encoder, packer = (shared_encoder if keep_encoder else Encoder)(tokenizer_path), Packer(limits)

        def out():
            done, packer.ready = packer.ready, []
            for k in range(0, len(done), 2000):
                rows = []
                for own, start, n, sequence, offset in done[k: k + 2000]:
                    rows.append((own.doc_id, start, n, own.tokens, base + sequence, offset,
                                 max(0, start + n - max(start, own.loss_from)), own.piece(start, n)))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(zip(*rows), _PIECE)], [n for n, _ in _PIECE])

        for batch in batches:
            doc_ids, texts, bearing = (batch.column(i).to_pylist() for i in range(3))
            for k in range(0, len(texts), 250):
                for doc_id, ids, n in zip(doc_ids[k: k + 250], encoder.encode(texts[k: k + 250], end_id), bearing[k: k + 250]):
                    packer.add(Example(doc_id, ids, 0 if n < 0 else max(0, len(ids) - n)))
                yield from out()
        packer.finish()
        yield from out()

    return narrow.mapInArrow(released(run), "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, loss_tokens long, ids binary")
