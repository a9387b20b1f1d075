"""BPE encoding and decoding by content-defined chunks, with exact ids.

A rolling hash over a text's UTF-8 bytes cuts it into chunks where the hash's top bits are zero, so passages that documents
share have the same chunks inside, wherever they stand.  A worker encodes each distinct chunk once and takes its ids
again for every document that holds it, in all tasks that it runs: ids are kept by the chunk's 128-bit hash, in two
generations of bounded size, so what recurs stays and memory does not grow.

Chunks cut through words, so the ids around a join may be wrong.  Byte-level merges never reach across the place between
an ASCII mark, letter or digit and white space behind it: such places part what a join can change from what it cannot.
Around each join the text between the nearest two is encoded again, together with the piece before and the piece after
where no other join lies between.  The new ids have to agree with the old ones on these two pieces; then they replace the old ones.  If
they do not agree, the window is doubled and encoded again, at last up to the whole text.

Decoding joins the bytes of ids and reads them as UTF-8, as the tokenizer's own decoder does with special tokens kept.

No row is moved: a task encodes the rows that it reads, and one that runs again gives the same rows.  Null and
empty texts have no ids and decode to an empty text.  A text is encoded whole, one Arrow batch of bounded bytes at a time; memory grows
with the longest text.  Repeated rows, null and repeated ids do no harm; other columns are returned as they are, but
for those named n_tokens, ids and decoded, which are replaced.  An empty table gives an empty one.  Equal chunk hashes
are taken for equal chunks.
"""

from __future__ import annotations

import json
from functools import lru_cache
from hashlib import blake2b
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.token_ids import KEPT, Encoder, _byte_letters

#: Mean, least and largest bytes of a chunk; the mean is a power of two.
MEAN, LEAST, MOST = 1024, 256, 8192
#: Ids kept in each of the two generations of a worker's chunks.
KEPT_IDS = 6_000_000
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 13, 32]] = True
_MARK = np.zeros(256, bool)
_MARK[33:127] = True


@lru_cache(maxsize=1)
def _gear() -> np.ndarray:
    """A random 32-bit number for each byte, the same in every worker."""
    return np.random.Generator(np.random.PCG64(20_240_229)).integers(1 << 32, size=256, dtype=np.uint32)


def rolling(raw: np.ndarray) -> np.ndarray:
    """At each byte a hash of the 32 bytes that end there, by doubling the stretch covered."""
    value = _gear()[raw]
    for k in (1, 2, 4, 8, 16):
        ahead = value.copy()
        ahead[k:] += value[:-k] << np.uint32(k)
        value = ahead
    return value


def cuts(raw: np.ndarray, first: list[int], mean: int = MEAN, least: int = LEAST, most: int = MOST) -> list[list[int]]:
    """Ends of the chunks of each text in `raw`, texts starting at `first` (and the last ending at its last entry).

    A chunk has at least `least` bytes, unless it ends its text, and at most `most` and a few; it ends between characters.
    """
    marks = np.flatnonzero(rolling(raw) >> np.uint32(32 - (mean.bit_length() - 1)) == 0) + 1 if len(raw) else np.empty(0, np.int64)
    found = []
    for begin, end in zip(first, first[1:]):
        own, at = [], begin
        for mark in [*marks[np.searchsorted(marks, begin, "right"): np.searchsorted(marks, end)].tolist(), end]:
            while mark - at > most:
                at = _between(raw, at + most, end)
                own.append(at)
            if mark - at >= least or mark == end:
                mark = _between(raw, mark, end)
                if mark > at:
                    own.append(mark)
                    at = mark
        found.append(own)
    return found


def _between(raw, at, end):
    """The first place from `at` on that does not lie inside a character."""
    while at < end and raw[at] & 0xC0 == 0x80:
        at += 1
    return at


class Chunks:
    """Ids of chunks by hash, in two generations: what is found again in the older one moves to the younger."""

    def __init__(self, most: int = KEPT_IDS):
        self.most, self.young, self.old, self.size = most, {}, {}, 0
        self.encoded = self.reused = 0

    def get(self, key):
        ids = self.young.get(key)
        if ids is None:
            ids = self.old.get(key)
            if ids is not None:
                self.put(key, ids)
        return ids

    def put(self, key, ids):
        if self.size > self.most:
            self.old, self.young, self.size = self.young, {}, 0
        self.young[key] = ids
        self.size += len(ids) + 32


class Codec:
    """Encodes and decodes texts by a tokenizer file's byte-level merges."""

    def __init__(self, path: str, mean: int = MEAN, least: int = LEAST, most: int = MOST):
        self.encoder, self.chunks = Encoder(path, KEPT), Chunks()
        self.shape = (mean, least, most)
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        special = {t["id"]: t["content"].encode() for t in made["added_tokens"]}
        of_letter = {letter: byte for byte, letter in _byte_letters().items()}
        self.bytes = [b""] * (1 + max([*made["model"]["vocab"].values(), *special]))
        for token, number in made["model"]["vocab"].items():
            self.bytes[number] = special.get(number) or bytes(of_letter[c] for c in token)
        for number, content in special.items():
            self.bytes[number] = content
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) < 2:
            return b"".join(self.bytes[i] for i in ids.tolist())
        return b"".join(itemgetter(*ids.tolist())(self.bytes))

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text, as those of the tokenizer for the whole text."""
        together = b"".join(texts)
        raw = np.frombuffer(together, np.uint8)
        first = [0, *np.cumsum([len(t) for t in texts]).tolist()]
        ends = cuts(raw, first, *self.shape)
        own, new = [], {}
        for begin, marks in zip(first, ends):
            keys = []
            for end in marks:
                piece = together[begin:end]
                key = blake2b(piece, digest_size=16).digest()
                ids = self.chunks.get(key)
                if ids is None and key not in new:
                    new[key] = piece
                keys.append((key, ids))
                self.chunks.reused += ids is not None
                begin = end
            own.append(keys)
        made = dict(zip(new, self._plain(list(new.values()))))
        for key, ids in made.items():
            self.chunks.put(key, ids.astype(np.uint16 if len(self.bytes) <= 1 << 16 else np.uint32))
        self.chunks.encoded += len(made)
        joined = [np.concatenate([made[k] if ids is None else ids for k, ids in keys]).astype(np.uint32) if keys else np.empty(0, np.uint32)
                  for keys in own]
        return self._repaired(raw, first, ends, joined)

    def _plain(self, pieces: list[bytes]) -> list[np.ndarray]:
        return self.encoder.encode([p.decode("utf-8", "replace") for p in pieces], None)

    def _repaired(self, raw, first, ends, joined):
        """Ids with the windows around joins encoded again, until they agree with what stands beside them."""
        safe = np.flatnonzero(_MARK[raw[:-1]] & _SPACE[raw[1:]]) + 1 if len(raw) else np.empty(0, np.int64)
        # a window: text, outer start, start, end, outer end
        windows = []
        for k, (begin, end, marks) in enumerate(zip(first, first[1:], ends)):
            if len(marks) > 1:
                own = np.concatenate([[begin], safe[np.searchsorted(safe, begin, "right"): np.searchsorted(safe, end)], [end]])
                windows += [(k, *w) for w in _windows(own, np.array(marks[:-1]), 1)]
        out, wide = list(joined), 1
        while windows:
            found = self._plain([raw[w[1]: w[4]].tobytes() for w in windows])
            failed, done = set(), {}
            for window, ids in zip(windows, found):
                k, outer, start, end, after = window
                held = joined[k]
                if k not in done:
                    done[k] = (np.concatenate([[0], np.cumsum(self.lengths[held])]) + first[k], [])
                places = done[k][0]
                a, b, c, d = np.searchsorted(places, (outer, start, end, after))
                mine = np.concatenate([[0], np.cumsum(self.lengths[ids])]) + outer
                e, f = np.searchsorted(mine, (start, end))
                agreed = (places[[a, b, c, d]].tolist() == [outer, start, end, after] and mine[[e, f]].tolist() == [start, end]
                          and np.array_equal(ids[:e], held[a:b]) and np.array_equal(ids[f:], held[c:d]))
                if agreed:
                    done[k][1].append((b, c, ids[e:f]))
                else:
                    failed.add(k)
            for k, (_, changes) in done.items():
                if k in failed:
                    continue
                parts, at = [], 0
                for b, c, ids in changes:
                    parts += [joined[k][at:b], ids]
                    at = c
                out[k] = np.concatenate([*parts, joined[k][at:]]).astype(np.uint32)
            wide *= 2
            windows = []
            for k in sorted(failed):
                own = np.concatenate([[first[k]], safe[np.searchsorted(safe, first[k], "right"): np.searchsorted(safe, first[k + 1])], [first[k + 1]]])
                windows += [(k, *w) for w in _windows(own, np.array(ends[k][:-1]), wide)]
        return out


def _windows(places: np.ndarray, joins: np.ndarray, wide: int) -> list[tuple[int, int, int, int]]:
    """(outer start, start, end, outer end) around joins, `wide` pieces to each side, those that meet made one.

    The outer piece on each side is there to agree on; it is empty where another join or the text's end leaves no room.
    """
    before = np.searchsorted(places, joins, "right") - 1
    after = np.searchsorted(places, joins, "left")
    open_ = before != after
    before, after = np.maximum(before[open_] - wide + 1, 0), np.minimum(after[open_] + wide - 1, len(places) - 1)
    if not len(before):
        return []
    apart = np.flatnonzero(before[1:] > np.maximum.accumulate(after)[:-1])
    before = before[np.concatenate([[0], apart + 1])]
    after = np.maximum.accumulate(after)[np.concatenate([apart, [len(after) - 1]])]
    outer = np.maximum(before - 1, 0)
    outer = np.where(np.searchsorted(joins, places[outer], "left") < np.searchsorted(joins, places[before], "right"), before, outer)
    beyond = np.minimum(after + 1, len(places) - 1)
    beyond = np.where(np.searchsorted(joins, places[after], "left") < np.searchsorted(joins, places[beyond], "right"), after, beyond)
    return list(zip(*(places[x].tolist() for x in (outer, before, after, beyond))))


@lru_cache(maxsize=1)
def shared_codec(path: str) -> Codec:
    """One codec per worker process, so that chunks of one task serve the next."""
    return Codec(path)


def encode(docs: DataFrame, tokenizer_path: str, decoded: bool = False) -> DataFrame:
    """`docs` (text and any other columns) without text, with n_tokens and ids (little-endian unsigned 32-bit integers).

    With `decoded`, also the text that the ids decode to.  The tokenizer file has byte-level merges and no normaliser.
    """
    docs = docs.drop("n_tokens", "ids", "decoded")
    others = [c for c in docs.columns if c != "text"]
    packed = docs.select(F.struct(*others, F.lit(0).alias("_")).alias("own"), F.col("text").cast("string").cast("binary").alias("text"))

    def run(batches):
        codec = shared_codec(tokenizer_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 250):
                part = batch.slice(at, 250)
                coded = codec.encode([t or b"" for t in part.column(1).to_pylist()])
                columns = [part.column(0), pa.array([len(ids) for ids in coded], pa.int64()),
                           pa.array([ids.astype("<u4").tobytes() for ids in coded], pa.binary())]
                if decoded:
                    columns.append(pa.array([codec.decode(ids).decode("utf-8", "replace") for ids in coded], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["own", "n_tokens", "ids", "decoded"][: len(columns)])

    own = packed.schema["own"].dataType.simpleString()
    made = packed.mapInArrow(run, f"own {own}, n_tokens long, ids binary" + ", decoded string" * decoded)
    return made.select(*(F.col("own")[c].alias(c) for c in others), *made.columns[1:])


def decode(coded: DataFrame, tokenizer_path: str) -> DataFrame:
    """`coded` (ids and any other columns) without ids, with the text they decode to; null ids decode to an empty text."""
    coded = coded.drop("decoded")
    others = [c for c in coded.columns if c != "ids"]
    packed = coded.select(F.struct(*others, F.lit(0).alias("_")).alias("own"), "ids")

    def run(batches):
        codec = shared_codec(tokenizer_path)
        for batch in batches:
            texts = [codec.decode(np.frombuffer(ids or b"", "<u4")).decode("utf-8", "replace") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["own", "decoded"])

    made = packed.mapInArrow(run, f"own {packed.schema['own'].dataType.simpleString()}, decoded string")
    return made.select(*(F.col("own")[c].alias(c) for c in others), "decoded")
