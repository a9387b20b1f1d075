"""Suffix-array dedup by prefix-free parsing: remove every byte covered by a long string that also starts elsewhere.

Parse.  A rolling hash of `GRAM` bytes is taken at each byte.  Where it is the least of the `REACH + 1` hashes that
follow a window's start, it is that window's trigger; triggers depend on content alone, so equal windows have equal
triggers at equal distance.  The windows that share a trigger occurrence are consecutive, and the bytes they cover are a phrase: the
trigger's phrases overlap by less than a window, and no window lies outside one.

Order.  What a full suffix array of dictionary and parse would sort by, the string from a trigger on and the bytes before
it, is sorted here by fingerprints, since only equality over a whole window matters: by the `core` behind the
trigger that all its windows contain, then by the whole phrase.  In that order
  * a phrase alone with its core has no window that occurs elsewhere, and is done;
  * a phrase that occurs more than once is removed as a whole;
  * where a core has several different phrases, one occurrence of each of them (the dictionary) has its windows
    sorted, which finds the parts that different phrases share;
  * phrases of a core with very many of them are first cut into bands of `BAND` windows.  The bytes that all windows of a
    band contain are its core, so the same three steps are taken once more with cores that are more than twice as long.
Occurrences need no further work: only dictionary phrases are looked at window by window, whatever the repetition.  What
is found are runs of windows, at each step: no more than one for a band, however often a text recurs with small changes.
Equal fingerprints are taken for equal strings: 64 bits for a core, 64 more for a phrase in it, twice 64 for a window.

Texts are UTF-8 bytes; matches never cross documents.  Equal texts are found by their hashes first, and a task
parses each text once, so copies cost one row each.  Null text is empty; a text shorter than a window is kept whole.
Null or repeated doc_ids do no harm, as texts are told apart by hashes (64 bits, and 128 where a text is removed as
a copy).  Columns besides id and text are not read.  A text is parsed by segments, but its phrases are counted over all of
them.  Memory is bounded by one batch and, per text, by one segment and the phrases of the text (40 bytes each).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.common import Powers, mixed, released, staged

WINDOW, REACH, GRAM = 200, 120, 16
SEGMENT = 1 << 20
# Dictionary entries of one core that are compared together; those of a more crowded core are divided into bands first.
CROWD = 1000
BAND = 16
_one, _two = Powers(0x9E3779B97F4A7C15), Powers(0xD1342543DE82EF95)


class Parse:
    """Phrases of one segment: `first`..`last` are the starts of the windows of each trigger `at`."""

    def __init__(self, raw: np.ndarray, window: int, reach: int):
        values = raw.astype(np.uint64) + np.uint64(1)
        self.one, self.two = _one.sums(values), _two.sums(values)
        self.window = window
        grams = np.arange(len(raw) - window + reach + 1)
        key = mixed(_one.between(self.one, grams, grams + GRAM)) & np.uint64(0xFFFFFFFF00000000) | grams.astype(np.uint64)
        at = (_sliding_least(key, reach + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        self.first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        self.last = np.concatenate([self.first[1:], [len(at)]]) - 1
        self.at = at[self.first]
        self.core = mixed(_one.between(self.one, self.at, self.at + (window - reach)))
        phrase = _two.between(self.two, self.first, self.last + window)
        place = ((self.at - self.first) << 20 | (self.at - self.last) & 0xFFFFF).astype(np.uint64)
        self.phrase = mixed(phrase + mixed(place))

    def bands(self, own):
        """(core, phrase, first, last) of the bands of some phrases; they lie at fixed distances from the trigger, so that
        equal ones meet."""
        low, high = (self.at[own] - x[own] for x in (self.last, self.first))
        count = high // BAND - low // BAND + 1
        phrase = np.repeat(np.arange(len(own)), count)
        at, band = self.at[own][phrase], _ranges(low // BAND, count)
        first, last = at - np.minimum(band * BAND + BAND - 1, high[phrase]), at - np.maximum(band * BAND, low[phrase])
        near = at - band * BAND
        core = mixed(_one.between(self.one, near, near + self.window - BAND + 1) + mixed(band.astype(np.uint64)))
        place = ((near - first) << 20 | (near - last) & 0xFFFFF).astype(np.uint64)
        return core, mixed(_two.between(self.two, first, last + self.window) + mixed(place)), first, last


def _sliding_least(key: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` consecutive values."""
    n = len(key) - width + 1
    padded = np.full(-(-len(key) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(key)] = key
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1: width - 1 + n])


def segments(raw: np.ndarray, window: int, reach: int):
    """(offset, Parse) of pieces of a text.

    A piece ends with a whole phrase, so that pieces together hold the phrases of the whole text, each once.
    """
    offset, end = 0, len(raw) - window + 1
    size = max(SEGMENT, 2 * reach + 2)
    while offset < end:
        parse = Parse(raw[offset: offset + size + window - 1], window, reach)
        ahead = size
        if offset + size < end:  # windows that follow may belong to the last phrase
            ahead = int(parse.first[-1])
            parse.first, parse.last, parse.at, parse.core, parse.phrase = (
                x[:-1] for x in (parse.first, parse.last, parse.at, parse.core, parse.phrase))
        yield offset, parse
        offset += ahead


def phrase_table(raw: np.ndarray, window: int, reach: int):
    """(core, phrase, at, first, last) of all phrases of a text, whatever its segments."""
    parts = [(p.core, p.phrase, p.at + offset, p.first + offset, p.last + offset) for offset, p in segments(raw, window, reach)]
    return tuple(np.concatenate(x) for x in zip(*parts))


def _bytes(text):
    return np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)


def _signed(x):
    return pa.array(x.astype(np.uint64).view(np.int64), pa.int64())


def _rows(columns, names, kinds):
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)], names)


def phrases(texts: DataFrame, window: int, reach: int) -> DataFrame:
    """(core, phrase, mark, at): each distinct phrase of a text, once."""
    def run(batches):
        known = set()
        for batch in batches:
            parts = []
            for mark, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if mark in known or len(text) * 4 < window:
                    continue
                known.add(mark)
                raw = _bytes(text)
                if len(raw) < window:
                    continue
                core, phrase, at, _, _ = phrase_table(raw, window, reach)
                _, once = np.unique(phrase, return_index=True)
                parts.append((core[once], phrase[once], np.full(len(once), mark), at[once]))
            if parts:
                core, phrase, mark, at = (np.concatenate(x) for x in zip(*parts))
                yield _rows([_signed(core), _signed(phrase), mark, at], ["core", "phrase", "mark", "at"], [pa.int64()] * 4)

    return texts.select("mark", "text").mapInArrow(released(run), "core long, phrase long, mark long, at long")


_ENTRY = [("key", pa.int64()), ("phrase", pa.int64()), ("mark", pa.int64()), ("start", pa.int64()), ("windows", pa.int64()), ("string", pa.binary())]


def dictionary_entries(chosen: DataFrame, window: int, reach: int) -> DataFrame:
    """Of chosen phrases (mark, text, few, many): a row with core and string for those of a small core group, and for the
    others one for each band, whose core is what all its windows contain.  Bands alone have a phrase (the hash of their
    bytes).  Copies of a text are read once a task."""
    def run(batches):
        known = set()
        for batch in batches:
            for mark, text, few, many in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if mark in known:
                    continue
                known.add(mark)
                raw = _bytes(text)
                for offset, parse in segments(raw, window, reach):
                    at = parse.at + offset
                    own = np.flatnonzero(np.isin(at, np.array(few, np.int64)))
                    if len(own):
                        yield rows(mark, raw, parse.core[own], None, parse.first[own] + offset, parse.last[own] + offset)
                    own = np.flatnonzero(np.isin(at, np.array(many, np.int64)))
                    if len(own):
                        core, whole, first, last = parse.bands(own)
                        yield rows(mark, raw, core, whole, first + offset, last + offset)

    def rows(mark, raw, core, phrase, first, last):
        strings = [raw[f: e + window].tobytes() for f, e in zip(first.tolist(), last.tolist())]
        phrase = pa.nulls(len(first), pa.int64()) if phrase is None else _signed(phrase)
        return _rows([_signed(core), phrase, np.full(len(first), mark), first, last - first + 1, strings], [n for n, _ in _ENTRY], [k for _, k in _ENTRY])

    return (chosen.select("mark", "text", "few", "many")
            .mapInArrow(released(run), "key long, phrase long, mark long, start long, windows long, string binary"))


def _ranges(first, size):
    return np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())


def _same_in_dictionary(marks, starts, sizes, strings, window):
    """(mark, start, n) of the runs of windows that other entries hold as well."""
    raw = np.frombuffer(b"".join(strings), np.uint8)
    length = sizes + window - 1
    values = raw.astype(np.uint64) + np.uint64(1)
    one, two = _one.sums(values), _two.sums(values)
    at = _ranges(np.cumsum(length) - length, sizes)
    first, second = (p.between(s, at, at + window) for p, s in ((_one, one), (_two, two)))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = np.repeat(starts, sizes) + np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    order = np.lexsort((place, marks[owner], second, first))
    same = (first[order][1:] == first[order][:-1]) & (second[order][1:] == second[order][:-1])
    mark_, place_ = marks[owner][order], place[order]
    own = same & ((mark_[1:] != mark_[:-1]) | (place_[1:] != place_[:-1]))
    # Copies of a row stand next to each other: if one of them has another neighbour, so have all.
    hit = np.zeros(len(at), bool)
    hit[order[1:][own]] = True
    hit[order[:-1][own]] = True
    inside = np.concatenate([[False], hit, [False]])
    edge = np.concatenate([[True], owner[1:] != owner[:-1], [True]])
    begin = np.flatnonzero(hit & (edge[:-1] | ~inside[:-2]))
    end = np.flatnonzero(hit & (edge[1:] | ~inside[2:])) + 1
    return marks[owner[begin]], place[begin], end - begin


def shared_windows(entries: DataFrame, window: int) -> DataFrame:
    """(mark, start, n): runs of windows of dictionary entries that stand elsewhere too.

    Bands that recur are runs as they are; of each different band of a core one goes on to be compared.
    """
    names, kinds = ["mark", "start", "n"], [pa.int64()] * 3
    place = F.struct("mark", "start")
    bands = entries.where("phrase is not null")
    kinds_of = bands.groupBy("key", "phrase").agg(
        F.min(place).alias("least"), F.max(place).alias("most"), F.min_by(F.struct("mark", "start", "windows", "string"), place).alias("one"))
    again = (bands.select("key", "phrase", "mark", "start", F.col("windows").alias("n"))
             .join(kinds_of.where("least <> most").select("key", "phrase"), ["key", "phrase"], "left_semi").select("mark", "start", "n"))
    parts = ["key", "mark", "start", "windows", "string"]
    single = entries.where("phrase is null").select(*parts).unionByName(kinds_of.select("key", "one.*"))

    def run(batches):
        held, size, key = [], 0, None
        for batch in batches:
            keys = batch.column(0).to_numpy()
            borders = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)] if len(keys) else []
            for b, e in zip(borders, borders[1:]):
                if held and keys[b] != key and size > 300_000:
                    yield flush(held)
                    held, size = [], 0
                key = keys[b]
                held.append(batch.slice(b, e - b))
                size += int(held[-1].column(3).to_numpy().sum())
        if held:
            yield flush(held)

    def flush(held):
        together = pa.Table.from_batches(held).combine_chunks()
        marks, starts, sizes = (together.column(i).to_numpy() for i in (1, 2, 3))
        return _rows(_same_in_dictionary(marks, starts, sizes, together.column(4).to_pylist(), window), names, kinds)

    compared = (single.repartition("key").sortWithinPartitions("key")
                .mapInArrow(released(run), "mark long, start long, n long"))
    return compared.unionByName(again)


def removed_bytes(text: str | None, window: int, reach: int, whole: bool, phrase_at, runs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, span starts, span ends) from what was found elsewhere and what recurs within the text."""
    raw = _bytes(text)
    if len(raw) < window:
        return raw, np.empty(0, np.int64), np.empty(0, np.int64)
    if whole:
        return raw, np.zeros(1, np.int64), np.full(1, len(raw), np.int64)
    cover = np.zeros(len(raw) + 1, np.int32)
    found = np.array(phrase_at if phrase_at is not None else [], np.int64)
    _, phrase, at, first, last = phrase_table(raw, window, reach)
    _, which, times = np.unique(phrase, return_inverse=True, return_counts=True)
    hit = times > 1
    if len(found):
        hit[which[np.isin(at, found)]] = True
    own = hit[which]
    np.add.at(cover, first[own], 1)
    np.add.at(cover, last[own] + window, -1)
    if runs:
        begin, size = (np.array([r[k] for r in runs], np.int64) for k in ("start", "n"))
        np.add.at(cover, begin, 1)
        np.add.at(cover, begin + size + window - 1, -1)
    inside = np.concatenate([[False], np.cumsum(cover[:-1]) > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return raw, edges[0::2], edges[1::2]


def find_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs` (any columns with text) with n_bytes, spans (start, end of each maximal removed run) and kept (binary).

    Columns of `docs` with one of these names are replaced.
    """
    docs = docs.drop("n_bytes", "spans", "kept")
    others = [c for c in docs.columns if c != "text"]
    joined = _known_repeats(docs, window)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            sizes, spans, kept = [], [], []
            for raw, begin, end, left in _removed(batch, window):
                sizes.append(len(raw))
                spans.append([{"start": b, "end": e} for b, e in zip(begin.tolist(), end.tolist())])
                kept.append(left)
            yield _rows([batch.column(0), sizes, spans, kept], ["own", "n_bytes", "spans", "kept"], [None, pa.int64(), span, pa.binary()])

    own = joined.schema["own"].dataType.simpleString()
    return (joined.mapInArrow(released(run), f"own {own}, n_bytes long, spans array<struct<start: bigint, end: bigint>>, kept binary")
            .select(*(F.col("own")[c].alias(c) for c in others), "n_bytes", "spans", "kept"))


def _removed(batch, window):
    """(bytes, span starts, span ends, bytes kept) of the rows of `_known_repeats`."""
    for text, check, repeated, runs, same in zip(*(batch.column(i).to_pylist() for i in range(1, 6))):
        raw, begin, end = removed_bytes(text, window, window * REACH // WINDOW, bool(same) and check in same, repeated, runs)
        keep = zip(np.concatenate([[0], end]).tolist(), np.concatenate([begin, [len(raw)]]).tolist())
        yield raw, begin, end, b"".join(raw[b:e].tobytes() for b, e in keep)


def _known_repeats(docs: DataFrame, window: int) -> DataFrame:
    """(own, text, check, repeated, runs, copies) of all documents, `own` being the other columns."""
    reach = window * REACH // WINDOW
    if window - reach < GRAM:
        raise ValueError("windows are too short for the rolling hash")
    others = [c for c in docs.columns if c != "text"]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    marked = docs.select(F.struct(*others, F.lit(0).alias("_")).alias("own"), text.alias("text"), F.xxhash64(text).alias("mark"),
                         F.xxhash64(F.lit(1), text).alias("check"))
    texts = marked.select("mark", "text")

    copies = marked.groupBy("mark", "check").agg(F.count("*").alias("n")).where("n > 1")
    of_core, of_phrase = Window.partitionBy("core"), Window.partitionBy("core", "phrase")
    ordered = phrases(texts, window, reach).repartition("core")
    crowd = (ordered.withColumn("rows", F.count("*").over(of_core)).where("rows > 1")
             .withColumn("least", F.min("mark").over(of_phrase)).withColumn("most", F.max("mark").over(of_phrase))
             .withColumn("kinds", F.min("phrase").over(of_core) != F.max("phrase").over(of_core))
             .withColumn("repeated", F.col("least") != F.col("most"))
             .withColumn("entry", F.col("kinds") & (F.col("mark") == F.col("least")))
             .withColumn("entries", F.sum(F.col("entry").cast("int")).over(of_core))
             .where("repeated or entry"))

    def places(condition):
        return F.collect_set(F.when(condition, F.col("at")))

    flags = staged(crowd.groupBy("mark").agg(
        places(F.col("repeated")).alias("repeated"), places(F.col("entry") & (F.col("entries") <= CROWD)).alias("few"),
        places(F.col("entry") & (F.col("entries") > CROWD)).alias("many")), "phrases")
    chosen = texts.join(flags.where("size(few) + size(many) > 0").select("mark", "few", "many"), "mark")
    entries = staged(dictionary_entries(chosen, window, reach), "dictionary")
    shared = (shared_windows(entries, window)
              .groupBy("mark").agg(F.collect_set(F.struct("start", "n")).alias("runs")))
    nothing, no_runs = F.array().cast("array<bigint>"), F.array().cast("array<struct<start: bigint, n: bigint>>")
    known = (flags.select("mark", "repeated", no_runs.alias("runs"), nothing.alias("copies"))
             .unionByName(shared.select("mark", nothing.alias("repeated"), "runs", nothing.alias("copies")))
             .unionByName(copies.select("mark", nothing.alias("repeated"), no_runs.alias("runs"), F.array("check").alias("copies")))
             .groupBy("mark").agg(*(F.flatten(F.collect_list(c)).alias(c) for c in ("repeated", "runs", "copies"))))
    known = staged(known, "repeats")
    return marked.join(known, "mark", "left").select("own", "text", "check", "repeated", "runs", "copies")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs` with the repeated bytes cut out of the text; a character cut in part goes as a whole."""
    joined = _known_repeats(docs, window)

    def run(batches):
        for batch in batches:
            texts = [left.decode("utf-8", "ignore") for *_, left in _removed(batch, window)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["own", "text"])

    cut = joined.mapInArrow(released(run), f"own {joined.schema['own'].dataType.simpleString()}, text string")
    return cut.select(*(F.col("own")[c].alias(c) if c != "text" else F.col("text") for c in docs.columns))
