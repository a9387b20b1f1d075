"""Language identification by interpolated Kneser-Ney character models.

Training counts character `ORDER`-grams of every labelled text in Spark (map-side combined per batch) and turns them
into one model per language: absolute discounting with continuation counts below the highest order.  All models
share sorted key arrays, one per order, with a column of probabilities per language, so a text is scored against
all languages by one binary search per character and order needed.  The language with the lowest
length-normalised cross-entropy wins.

Symbols: every lower-cased letter of the training texts has a symbol of its own, and every run of other characters is
one blank.  Up to `SYMBOLS` different letters, a symbol is a byte and a 4-gram 32 bits; with more letters a symbol is a
UTF-16 unit and a 4-gram 64 bits (a letter beyond the basic plane is two symbols).  No n-gram is left out, whatever its
count: the driver holds 16 bytes for each (language, 4-gram), and the model a probability per distinct n-gram and language.

Calibration: per language, mean and standard deviation of the cross-entropy of the calibration texts under
their own language.  A text is rejected when it has no letter, or its entropy exceeds the mean by more than
`slack + width * deviation / sqrt(letters / 100)`, wide enough that the language's own texts, short or noisy, stay.

Null text or text without a letter, one of marks and digits too, gets `und`, score 0 and is rejected.  Without any labelled text the
model is empty and every text gets `und`.  Repeated rows are scored alike; columns besides id and text are not read.
"""

from __future__ import annotations

import sys
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import released

ORDER = 4
SYMBOLS = 200
DISCOUNT = 0.75
UNDETERMINED = "und"
_POINTS = sys.maxunicode + 1


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: its lower-case code point, and whether it is a letter or mark."""
    lower = np.arange(_POINTS, dtype=np.uint32)
    letter = np.zeros(_POINTS, bool)
    for point in range(_POINTS):
        if 0xD800 <= point < 0xE000:
            continue
        kind = unicodedata.category(chr(point))
        letter[point] = kind[0] == "L" or kind == "Mn"
        small = chr(point).lower()
        if len(small) == 1:
            lower[point] = ord(small)
    return lower, letter


@lru_cache(maxsize=1)
def _real_letters() -> np.ndarray:
    """For each code point whether it is a letter by itself: marks are not."""
    lower, letter = _letters()
    return letter & np.fromiter((unicodedata.category(chr(p))[0] == "L" if letter[p] else False for p in range(_POINTS)), bool, _POINTS)


def _codes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)


def symbol_table(seen: list[int]) -> np.ndarray:
    """Code point -> symbol: 0 for no letter, 1 for an unseen letter, 2... for the seen ones; of more than `SYMBOLS`
    seen ones, the lower-cased letters themselves."""
    lower, letter = _letters()
    if len(seen) > SYMBOLS:
        return np.where(letter, lower, np.uint32(0))
    own = np.ones(_POINTS, np.uint8)
    own[np.asarray(seen, np.int64)] = np.arange(2, 2 + len(seen), dtype=np.uint8)
    return np.where(letter, own[lower], 0).astype(np.uint8)


def _kind(table: np.ndarray) -> tuple[type, int]:
    """Integer type of the keys that a symbol table leads to, and bits of a symbol."""
    return (np.uint32, 8) if table.dtype == np.uint8 else (np.uint64, 16)


def _units(codes: np.ndarray) -> np.ndarray:
    """UTF-16 units of code points."""
    far = codes > 0xFFFF
    if not far.any():
        return codes
    at = np.cumsum(far + 1) - 1  # last unit of each
    out = np.empty(at[-1] + 1, np.uint32)
    out[at] = np.where(far, (codes - 0x10000 & 0x3FF) + 0xDC00, codes)
    out[at[far] - 1] = (codes[far] - 0x10000 >> 10) + 0xD800
    return out


def grams(text: str | None, table: np.ndarray) -> np.ndarray:
    """Keys of the ORDER-grams that end at each letter or blank after the first; runs of blanks count once."""
    kind, bits = _kind(table)
    points = _codes(text)
    codes = table[points]
    if not codes.any() or not (text.isascii() or _real_letters()[points].any()):  # marks alone are no letters
        return np.empty(0, kind)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    codes = codes[keep]
    if bits == 16:
        codes = _units(codes)
    padded = np.zeros(len(codes) + ORDER - 1, kind)
    padded[ORDER - 1:] = codes
    key = padded[: len(codes)].copy()
    for k in range(1, ORDER):
        key = (key << kind(bits)) | padded[k: k + len(codes)]
    return key


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, where = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(where, weights, minlength=len(distinct))


def _tail(keys: np.ndarray, order: int, bits: int) -> np.ndarray:
    """The last `order` symbols of keys."""
    return keys & keys.dtype.type((1 << bits * order) - 1)


def kneser_ney(keys: np.ndarray, counts: np.ndarray, uniform: float = 1 / 256) -> list[tuple[np.ndarray, np.ndarray]]:
    """Interpolated log2 probabilities of the seen n-grams of one language, for orders 1 to ORDER."""
    bits = keys.dtype.itemsize * 8 // ORDER
    levels = []
    for order in range(ORDER, 0, -1):
        if order == ORDER:
            levels.append((keys, counts.astype(float)))
        else:  # in how many different contexts the shorter gram was seen
            longer = levels[-1][0]
            levels.append(_summed(_tail(longer, order, bits), np.ones(len(longer))))
    levels.reverse()
    out, lower = [], None
    for order, (grams_, seen) in enumerate(levels, 1):
        context, where = np.unique(grams_ >> keys.dtype.type(bits), return_inverse=True)
        total, kinds = np.bincount(where, seen), np.bincount(where)
        share = np.maximum(seen - DISCOUNT, 0) / total[where]
        rest = DISCOUNT * kinds[where] / total[where]
        if order == 1:
            below = np.full(len(grams_), uniform)
        else:
            below = lower[1][np.searchsorted(lower[0], _tail(grams_, order - 1, bits))]
        lower = (grams_, share + rest * below, context, DISCOUNT * kinds / total)
        out.append(lower)
    return out


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray
    keys: list[np.ndarray]      # per order, sorted
    values: list[np.ndarray]    # per order, log2 probability: key x language
    contexts: list[np.ndarray]  # per order, sorted
    weights: list[np.ndarray]   # per order, log2 weight that a context leaves to shorter grams: context x language
    mean: np.ndarray | None = None
    deviation: np.ndarray | None = None
    uniform: float = 1 / 256    # probability below the lowest order

    def entropies(self, key: np.ndarray) -> np.ndarray:
        """Mean bits per symbol under each language."""
        total, left = np.zeros(len(self.languages)), key
        bits = _kind(self.table)[1]
        for order in range(ORDER, 0, -1):
            if not len(left):
                break
            part = _tail(left, order, bits) if order < ORDER else left
            place, hit = _find(self.keys[order - 1], part)
            total += self.values[order - 1][place[hit]].sum(axis=0)
            left, part = left[~hit], part[~hit]
            if len(part) and len(self.contexts[order - 1]):
                place, hit = _find(self.contexts[order - 1], part >> part.dtype.type(bits))
                total += self.weights[order - 1][place[hit]].sum(axis=0)
        total += np.log2(self.uniform) * len(left)
        return -total / max(len(key), 1)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return place, keys[place] == wanted


def build_model(counts: dict[str, tuple[np.ndarray, np.ndarray]], table_: np.ndarray) -> Model:
    """Model of each language's keys and their counts, in order of keys.

    A key of any language has a value for all of them: where a language has not seen it, the value is its
    shorter gram's probability times the weight that the language's context leaves to shorter grams.
    """
    languages = sorted(counts)
    kind, bits = _kind(table_)
    known = np.unique(np.concatenate([np.unique(_tail(counts[lang][0], 1, bits)) for lang in languages])) if languages else ()
    uniform = 1 / max(256, len(known) + 1)  # the seen symbols, and one for all others
    per = [kneser_ney(*counts[lang], uniform) for lang in languages]
    keys, values, contexts, weights, below = [], [], [], [], None
    for order in range(1, ORDER + 1):
        merged = np.unique(np.concatenate([levels[order - 1][0] for levels in per])) if per else np.empty(0, kind)
        table = np.empty((len(merged), len(languages)))
        seen = np.unique(np.concatenate([levels[order - 1][2] for levels in per])) if per else np.empty(0, kind)
        left = np.zeros((len(seen), len(languages)))
        for j, levels in enumerate(per):
            own, chance, context, rest = levels[order - 1]
            if order == 1:
                short = np.full(len(merged), uniform)
            else:
                short = 2.0 ** below[np.searchsorted(keys[-1], _tail(merged, order - 1, bits)), j]
            place, hit = _find(context, merged >> kind(bits))
            weight = np.where(hit, rest[place], 1.0)
            at, hit = _find(own, merged)
            table[:, j] = np.log2(np.where(hit, chance[at], weight * short))
            at, hit = _find(context, seen)
            left[:, j] = np.log2(np.where(hit, rest[at], 1.0))
        keys.append(merged)
        values.append(table)
        contexts.append(seen)
        weights.append(left)
        below = table
    return Model(languages, table_, keys, values, contexts, weights, uniform=uniform)


def _letter_counts(batches):
    lower, letter = _letters()
    for batch in batches:
        total = np.zeros(0, np.int64)
        for text in batch.column(0).to_pylist():
            codes = lower[_codes(text)]
            found = np.bincount(codes[letter[codes]]) if len(codes) else total[:0]
            if len(found) > len(total):
                found[: len(total)] += total
                total = found
            else:
                total[: len(found)] += found
        points = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(points, pa.int64()), pa.array(total[points], pa.int64())], ["point", "n"])


def train(labelled: DataFrame) -> Model:
    """Model of a DataFrame (lang, text): all its rows are counted, rows of null language left aside."""
    known = labelled.where("lang is not null").select("lang", F.col("text").cast("string").alias("text"))
    letters = (known.select("text").mapInArrow(released(_letter_counts), "point long, n long").groupBy("point").agg(F.sum("n").alias("n"))
               .orderBy(F.desc("n"), "point"))
    seen = [row.point for row in letters.collect()]  # no more than there are letters
    kind = _kind(symbol_table(seen))[0]

    def count(batches):
        table = symbol_table(seen)
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                parts = [grams(t, table) for g, t in zip(langs, texts) if g == lang]
                keys, counts = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.uint64).view(np.int64)), pa.array(counts, pa.int64())],
                    ["lang", "gram", "n"])

    def pack(batches):
        """The grams of each language in a batch as bytes, which the driver holds without an object per gram."""
        for batch in batches:
            langs, (keys, counts) = np.array(batch.column(0).to_pylist()), (batch.column(k).to_numpy() for k in (1, 2))
            own = [(lang, langs == lang) for lang in np.unique(langs).tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang for lang, _ in own], pa.string()), pa.array([keys[x].tobytes() for _, x in own], pa.binary()),
                 pa.array([counts[x].tobytes() for _, x in own], pa.binary())], ["lang", "grams", "counts"])

    counted = known.mapInArrow(released(count), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    parts = {}
    for row in counted.mapInArrow(released(pack), "lang string, grams binary, counts binary").collect():
        parts.setdefault(row.lang, []).append((row.grams, row.counts))
    tables = {}
    for lang in sorted(parts):
        grams_, counts = (np.frombuffer(b"".join(x), np.int64) for x in zip(*parts.pop(lang)))
        keys = grams_.view(np.uint64).astype(kind)
        order = np.argsort(keys)
        tables[lang] = keys[order], counts[order].astype(float)
    model = build_model(tables, symbol_table(seen))
    scored = score(known.select(F.lit(None).cast("long").alias("doc_id"), "text", F.col("lang").alias("own")), model)
    stats = {row.own: (row.m, row.s) for row in scored.where("lang_pred <> 'und' and lang_pred = own").groupBy("own").agg(
        F.avg("entropy").alias("m"), F.stddev_pop("entropy").alias("s")).collect()} if model.languages else {}
    model.mean = np.array([stats.get(lang, (8.0, 0.0))[0] for lang in model.languages])
    model.deviation = np.array([stats.get(lang, (8.0, 0.0))[1] for lang in model.languages])
    return model


def score(docs: DataFrame, model: Model, slack: float = 2.0, width: float = 8.0, keep_text: bool = False) -> DataFrame:
    """The columns of `docs`, the text only if `keep_text`, with lang_pred, score, entropy and rejected for each row.

    `docs` has a column text; the model travels as one broadcast.
    """
    docs = docs.drop("lang_pred", "score", "entropy", "rejected")
    others = [c for c in docs.columns if c != "text"]
    narrow = docs.select(F.col("text").cast("string").alias("text"), *others)
    first = 0 if keep_text else 1
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        known = shared.value
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                key = grams(text, known.table) if known.languages else ()
                if not len(key):
                    out.append((UNDETERMINED, 0.0, None, True))
                    continue
                bits = known.entropies(key)
                best = int(np.argmin(bits))
                reach = min(len(key), 40)
                sure = 1 / np.exp2(np.maximum((bits[best] - bits) * reach, -1000)).sum()
                most = np.inf
                if known.mean is not None:
                    most = known.mean[best] + slack + width * known.deviation[best] / np.sqrt(min(len(key), 100) / 100)
                out.append((known.languages[best], float(sure), float(bits[best]), bool(bits[best] > most)))
            cols = list(zip(*out)) if out else [[], [], [], []]
            made = [pa.array(list(c), k) for c, k in zip(cols, (pa.string(), pa.float64(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[first:], *made],
                                             [*["text", *others][first:], "lang_pred", "score", "entropy", "rejected"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[first:])
    return narrow.mapInArrow(released(run), f"{kinds}, lang_pred string, score double, entropy double, rejected boolean")
