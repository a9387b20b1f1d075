"""Token ids of whole texts by a public tokenizer file, each distinct piece of text encoded once per worker.

Both kinds of file used here cut a text before merging, and never between a character that is not blank and the
blanks after it.  So a text is cut there, and the ids of each distinct piece are looked up.  A word of Latin
letters, with the blank before it, is one unit of the merges, and so are the ASCII marks after it: these are cut apart
and a word goes to the merges directly.  A text with other white space or with a special token's marks is
encoded as a whole.  Ids are those of the tokenizer itself in every case.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain, repeat

import numpy as np

_L, _P, _END = "A-Za-zÀ-ÖØ-öø-ÿ", "!-/:-@\\[-`{-~", "(?=[ \\n\\t\\r]|\\Z)"
_PIECES = re.compile(
    rf" ?[{_L}]+(?=[{_P}]*(?:[ \n\t\r]|\Z))"  # a word with at most marks behind it
    rf"|[{_P}]+{_END}|\n(?=[{_L}]+[{_P}]*(?:[ \n\t\r]|\Z))"  # those marks; a line end before such a word
    r"|[ \n\t\r]*[^ \n\t\r]+|[ \n\t\r]+\Z")
_WORD = re.compile(rf" ?[{_L}]+").fullmatch
# White space besides blanks, tabs and line ends, and how a special token begins.
_WHOLE = ("<|", *(c for c in map(chr, range(0x10000)) if c.isspace() and c not in " \n\t\r"))
_TRIAL = ["The", " word", " Straße", "été", " ÑANDÚ", " A", "x", " naïveté"]
#: Pieces remembered before those seen but once are forgotten, by one task's encoder and by one that a worker
#: keeps; bounds a worker's memory.
REMEMBERED, KEPT = 300_000, 1_000_000


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level files write for each byte (fixed by the file format)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


class Encoder:
    def __init__(self, path: str, remembered: int | None = None):
        self._most = remembered
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._letters = _byte_letters()
        self._merge = self._tokenizer.model.tokenize
        self._lower = self._tokenizer.normalizer is not None
        self._blank = "" if self._lower else self._letters[32]
        self._direct = all(self._words([w]) == self._plain([w]) for w in _TRIAL)
        self._reset()

    def _reset(self):
        self._known: dict[str, int] = {}
        self._ids = np.empty(1 << 20, np.uint32)
        self._starts = np.zeros(1 << 18, np.int64)
        self._seen = np.zeros(1 << 18, np.int64)
        self._filled = 0

    def _forget(self):
        """Keep the pieces seen more than once, the most frequent ones at most half of what is remembered."""
        pieces, seen = list(self._known), self._seen[: len(self._known)]
        kept = np.flatnonzero(seen > 1)
        kept = np.sort(kept[np.argsort(-seen[kept], kind="stable")[: (self._most or REMEMBERED) // 2]])
        starts, lengths = self._starts[kept], self._starts[kept + 1] - self._starts[kept]
        ends = np.cumsum(lengths)
        ids = self._ids[np.arange(int(lengths.sum())) + np.repeat(starts - (ends - lengths), lengths)]
        counts = seen[kept] // 2
        self._reset()
        self._append([pieces[k] for k in kept.tolist()], ids, lengths)
        self._seen[: len(kept)] = counts

    def _append(self, pieces, flat, lengths):
        n = len(self._known)
        while len(self._starts) < n + len(pieces) + 1:
            self._starts = np.concatenate([self._starts, np.zeros_like(self._starts)])
            self._seen = np.concatenate([self._seen, np.zeros_like(self._seen)])
        while len(self._ids) < self._filled + len(flat):
            self._ids = np.concatenate([self._ids, np.empty_like(self._ids)])
        self._ids[self._filled: self._filled + len(flat)] = flat
        self._starts[n + 1: n + len(pieces) + 1] = self._filled + np.cumsum(lengths)
        self._filled += len(flat)
        self._known.update(zip(pieces, range(n, n + len(pieces))))

    def _words(self, words: list[str]) -> list[list[int]]:
        """Ids of words of Latin letters straight from the merges."""
        merge, letters, blank, out = self._merge, self._letters, self._blank, []
        for word in words:
            form = word[1:] if word[0] == " " else word
            if self._lower:
                form = form.lower()
            if not form.isascii():
                form = form.encode().decode("latin-1").translate(letters)
            out.append([t.id for t in merge(blank + form if word[0] == " " else form)])
        return out

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> None:
        for k in range(0, len(pieces), 8192):
            part = pieces[k: k + 8192]
            words = [x for x in part if _WORD(x)] if self._direct else []
            found = dict(zip(words, self._words(words)))
            others = [x for x in part if x not in found]
            found.update(zip(others, self._plain(others)))
            encoded = [found[x] for x in part]
            lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
            self._append(part, np.fromiter(chain.from_iterable(encoded), np.uint32, int(lengths.sum())), lengths)

    def encode(self, texts: list[str | None], end_id: int | None = 1) -> list[np.ndarray]:
        """Ids of each text (null: empty) with `end_id` appended."""
        tail = np.array([] if end_id is None else [end_id], np.uint32)
        if len(self._known) > (self._most or REMEMBERED):
            self._forget()
        out: list = [None] * len(texts)
        pieces, sizes, places = [], [], []
        for k, text in enumerate(texts):
            if not text:
                out[k] = tail
            elif any(c in text for c in _WHOLE):
                out[k] = np.concatenate([np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, np.uint32), tail])
            else:
                own = _PIECES.findall(text)
                pieces += own
                sizes.append(len(own))
                places.append(k)
        if not pieces:
            return out
        at = np.fromiter(map(self._known.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new = [pieces[i] for i in missing.tolist()]
            self._learn(list(dict.fromkeys(new)))
            at[missing] = [self._known[x] for x in new]
        found = np.bincount(at)
        self._seen[: len(found)] += found
        starts = self._starts[at]
        lengths = self._starts[at + 1] - starts
        ends = np.cumsum(lengths)
        ids = self._ids[np.arange(int(ends[-1])) + np.repeat(starts - (ends - lengths), lengths)]
        last = np.concatenate([[0], ends[np.cumsum(sizes) - 1]]).tolist()
        for j, k in enumerate(places):
            out[k] = np.concatenate([ids[last[j]: last[j + 1]], tail])
        return out


@lru_cache(maxsize=2)
def shared_encoder(path: str) -> Encoder:
    """One encoder per worker process, so that what a task has learnt serves the next."""
    return Encoder(path, KEPT)
