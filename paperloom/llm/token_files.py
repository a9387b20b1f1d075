"""Token-id files: canonical length-limited Huffman codes from global counts, decoded by one table in independent blocks.

Format.  A corpus is a folder of Parquet files whose rows are blocks (Parquet as the envelope gives task commits,
retries and any store that Spark can write); the code lies beside it as one table of code lengths.  A block can be
decoded alone:

    file_key, block   its place: range of doc_ids, block within the range
    cut               whether it holds one piece of a document of over `BLOCK_IDS` ids, else whole documents
    first             for a piece: ids of the document before it
    docs              (doc_id, number of ids, bytes of payload) of each document, in order
    n_ids             ids in the block
    checkpoints       bit offset within its document (little-endian unsigned 32 bits) of every 256th id
    payload           per document its code words, most significant bit first, filled up to a whole byte

Codes are canonical: code words of one length are consecutive in order of id, so lengths alone define them.  Lengths
are the best possible under `LIMIT` bits (package merge).  Decoding starts at all checkpoints at once and takes one
table look-up per id.

Ids are below `2**16`.  Null text is empty.  Rows of one doc_id follow one another in an order of their texts, null
doc_ids come first.  An empty table gives no blocks and no rows.  Columns besides doc_id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.common import scratch_path
from paperloom.llm.token_ids import shared_encoder

LIMIT = 18
CHECKPOINT = 256
BLOCK_IDS = 1 << 18
FILE_IDS = 1 << 23


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most `limit` bits for the symbols with a count; 0 for the others."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError("more symbols than code words")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    packages, marks = np.empty(0, np.int64), []
    for _ in range(limit):
        weights = np.concatenate([leaves, packages])
        place = np.argsort(weights, kind="stable")
        marks.append(place < len(leaves))
        merged = weights[place]
        even = len(merged) // 2 * 2
        packages = merged[0:even:2] + merged[1:even:2]
    taken = 2 * len(leaves) - 2
    own = np.zeros(len(leaves), np.int64)
    for mark in reversed(marks):
        chosen = int(mark[:taken].sum())
        own[:chosen] += 1
        taken = 2 * (taken - chosen)
    lengths[order] = own
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Code words, right-aligned, for code lengths."""
    codes = np.zeros(len(lengths), np.uint32)
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    own = lengths[order].astype(np.int64)
    steps = np.left_shift(np.int64(1), LIMIT - own)
    codes[order] = ((np.cumsum(steps) - steps) >> (LIMIT - own)).astype(np.uint32)
    return codes


def encode_ids(documents: list[np.ndarray], codes: np.ndarray, lengths: np.ndarray) -> list[tuple[bytes, bytes]]:
    """(payload, checkpoints) of each document."""
    if not documents:
        return []
    sizes = np.fromiter(map(len, documents), np.int64, len(documents))
    ids = np.concatenate(documents)
    length = lengths[ids].astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(length)])
    last = np.cumsum(sizes)
    first = last - sizes
    n_bytes = (ends[last] - ends[first] + 7) // 8
    byte_end = np.cumsum(n_bytes)
    byte_start = byte_end - n_bytes
    starts = ends[:-1] + np.repeat(byte_start * 8 - ends[first], sizes)
    value = codes[ids].astype(np.uint64) << (64 - length - (starts & 31)).astype(np.uint64)
    n_words = int(byte_end[-1]) // 4 + 3
    at = starts >> 5
    high = np.bincount(at, (value >> np.uint64(32)).astype(float), minlength=n_words)
    low = np.bincount(at + 1, (value & np.uint64(0xFFFFFFFF)).astype(float), minlength=n_words)
    packed = (high + low).astype(np.uint64).astype(">u4").tobytes()  # bits of different ids never overlap
    return [(packed[x:y], (starts[f:e:CHECKPOINT] - 8 * x).astype("<u4").tobytes())
            for x, y, f, e in zip(byte_start.tolist(), byte_end.tolist(), first.tolist(), last.tolist())]


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Id and code length for each possible next LIMIT bits."""
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    repeats = np.left_shift(np.int64(1), LIMIT - lengths[order].astype(np.int64))
    ids = np.zeros(1 << LIMIT, np.uint32)
    sizes = np.ones(1 << LIMIT, np.uint8)
    n = int(repeats.sum())
    ids[:n] = np.repeat(order, repeats)
    sizes[:n] = np.repeat(lengths[order], repeats)
    return ids, sizes


def decode_ids(payload: bytes, checkpoints: bytes, sizes: np.ndarray, n_bytes: np.ndarray, table) -> np.ndarray:
    """The ids of one block, its documents one after another; all stretches between checkpoints are decoded side by side."""
    if not sizes.sum():
        return np.empty(0, np.uint32)
    raw = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
    window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    lanes = -(-sizes // CHECKPOINT)
    left = np.full(int(lanes.sum()), CHECKPOINT, np.int64)
    full = sizes > 0
    left[np.cumsum(lanes)[full] - 1] = sizes[full] - (lanes[full] - 1) * CHECKPOINT
    to = np.cumsum(left) - left
    bit = np.frombuffer(checkpoints, "<u4").astype(np.int64) + np.repeat(8 * (np.cumsum(n_bytes) - n_bytes), lanes)
    order = np.argsort(-left, kind="stable")
    left, to, bit = left[order], to[order], bit[order]
    running = np.searchsorted(-left, -np.arange(int(left[0])), side="left")
    ids, lengths = table
    out = np.empty(int(sizes.sum()), np.uint32)
    for k, n in enumerate(running.tolist()):
        if n < len(bit):
            bit, to = bit[:n], to[:n]
        following = (window[bit >> 3] >> (32 - LIMIT - (bit & 7)).astype(np.uint32)) & np.uint32((1 << LIMIT) - 1)
        out[to + k] = ids[following]
        bit = bit + lengths[following]
    return out


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int = 1) -> DataFrame:
    """(doc_id, ids as little-endian unsigned 16-bit integers, counts) of docs (doc_id, text).

    Each task adds one row that has only `counts`: how often it has met each id, as 64-bit integers.
    """
    kinds = [("doc_id", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary())]

    def made(*columns):
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, (_, k) in zip(columns, kinds)], [n for n, _ in kinds])

    def run(batches):
        encoder, total = shared_encoder(tokenizer_path), np.zeros(1 << 16, np.int64)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for k in range(0, len(texts), 250):
                ids = [x.astype("<u2") for x in encoder.encode(texts[k: k + 250], end_id)]
                found = np.bincount(np.concatenate(ids))
                total[: len(found)] += found
                yield made(batch.column(0).slice(k, 250), [x.tobytes() for x in ids], pa.nulls(len(ids), pa.binary()))
        if total.any():
            yield made([None], [None], [total.tobytes()])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, ids binary, counts binary")


def _count(batches):
    """One row per id that occurs: the sum of the counts of several tasks."""
    total = np.zeros(1 << 16, np.int64)
    for batch in batches:
        for counts in batch.column(0).to_pylist():
            total += np.frombuffer(counts, np.int64)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["id", "n"])


_DOCS = pa.list_(pa.struct([("doc_id", pa.int64()), ("n", pa.int64()), ("n_bytes", pa.int64())]))
_BLOCK = [("file_key", pa.int32()), ("block", pa.int32()), ("cut", pa.bool_()), ("first", pa.int64()), ("docs", _DOCS),
          ("n_ids", pa.int64()), ("checkpoints", pa.binary()), ("payload", pa.binary())]


def write_corpus(ids: DataFrame, path: str, file_ids: int = FILE_IDS) -> None:
    """Write what `tokenize` gives as block files in ascending doc_id order under `path`, and the code under `path`-code.

    `ids` is read three times, so it should be a stored table.  Documents are coded before they are dealt out, so
    the shuffle carries code words.
    """
    spark = ids.sparkSession
    found = ids.where("counts is not null").select("counts").mapInArrow(_count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(1 << 16, np.int64)  # one row per id of the vocabulary at most
    for row in found:
        counts[row.id] = row.n
    lengths = code_lengths(counts)
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").coalesce(1).write.parquet(f"{path}-code")
    files = int(counts.sum()) // file_ids + 1
    bounds = ids.where("counts is null").agg(F.percentile_approx("doc_id", [k / files for k in range(1, files)], 20 * files).alias("b")).first()["b"] if files > 1 else []
    shared = spark.sparkContext.broadcast((canonical_codes(lengths), lengths, np.unique(np.array(bounds or [], np.int64))))

    def code(batches):
        codes, sizes, edges = shared.value
        for batch in batches:
            doc_ids = batch.column(0)
            arrays = [np.frombuffer(x.as_buffer(), "<u2") if x.as_buffer() else np.empty(0, np.uint16) for x in batch.column(1)]
            pieces = [(k, f, a[f: f + BLOCK_IDS]) for k, a in enumerate(arrays) for f in range(0, max(len(a), 1), BLOCK_IDS)]
            coded = encode_ids([x for _, _, x in pieces], codes, sizes)
            place = pa.array([k for k, _, _ in pieces], pa.int64())
            own = doc_ids.take(place)
            key = np.searchsorted(edges, own.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False), side="left")
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.int32()), own, pa.array([len(arrays[k]) > BLOCK_IDS for k, _, _ in pieces], pa.bool_()),
                 pa.array([xxhash.xxh64_intdigest(arrays[k].tobytes()) >> 1 for k, _, _ in pieces], pa.int64()),
                 pa.array([f for _, f, _ in pieces], pa.int64()), pa.array([len(x) for _, _, x in pieces], pa.int64()),
                 pa.array([c for _, c in coded], pa.binary()), pa.array([p for p, _ in coded], pa.binary())],
                ["file_key", "doc_id", "cut", "mark", "first", "n", "checkpoints", "payload"])

    def blocks(batches):
        key, block, held, size = None, 0, [], 0

        def made():
            docs = [{"doc_id": d, "n": n, "n_bytes": len(p)} for d, _, _, n, _, p in held]
            row = (key, block, held[0][1], held[0][2], docs, size, b"".join(x[4] for x in held), b"".join(x[5] for x in held))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, (_, t) in zip(row, _BLOCK)], [n for n, _ in _BLOCK])

        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(n)).to_pylist()
                       for n in ("file_key", "doc_id", "cut", "first", "n", "checkpoints", "payload")]
            for own, *row in zip(*columns):
                if held and (own != key or row[1] or held[0][1] or size + row[3] > BLOCK_IDS):
                    yield made()
                    held, size, block = [], 0, block + 1
                if own != key:
                    key, block = own, 0
                held.append(row)
                size += row[3]
        if held:
            yield made()

    kinds = "file_key int, block int, cut boolean, first long, docs array<struct<doc_id: bigint, n: bigint, n_bytes: bigint>>, n_ids long, checkpoints binary, payload binary"
    (ids.where("counts is null").select("doc_id", "ids").mapInArrow(code, "file_key int, doc_id long, cut boolean, mark long, first long, n long, checkpoints binary, payload binary")
     .repartition(files, "file_key").sortWithinPartitions("file_key", "doc_id", "mark", "first")
     .mapInArrow(blocks, kinds).write.option("compression", "uncompressed").parquet(path))


def read_corpus(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids as little-endian unsigned 32-bit integers) of the documents of a written corpus.

    `start` counts the ids of all documents before it.
    """
    lengths = np.frombuffer(bytes(spark.read.parquet(f"{path}-code").first()["lengths"]), np.uint8)
    shared = spark.sparkContext.broadcast(lengths)
    table = spark.read.parquet(path)
    # Where each range of doc_ids begins: one row per range.
    ordered = Window.orderBy("file_key").rowsBetween(Window.unboundedPreceding, -1)
    files = table.groupBy("file_key").agg(F.sum("n_ids").alias("n")).select(
        "file_key", F.coalesce(F.sum("n").over(ordered), F.lit(0)).alias("file_start"))
    within = Window.partitionBy("file_key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    places = (table.select("file_key", "block", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("before")).join(files, "file_key")
              .select(F.col("file_key").alias("of"), F.col("block").alias("nr"), (F.col("before") + F.col("file_start")).alias("start")))
    # A place is a few bytes per block of BLOCK_IDS ids.
    starts = spark.sparkContext.broadcast({(r["of"], r["nr"]): r["start"] for r in places.toLocalIterator()})

    def decode(batches):
        decoder = decoding_table(shared.value)
        for batch in batches:
            names = batch.schema.names
            for k in range(batch.num_rows):
                row = {n: batch.column(i)[k].as_py() for i, n in enumerate(names)}
                sizes = np.array([d["n"] for d in row["docs"]], np.int64)
                ids = decode_ids(row["payload"], row["checkpoints"], sizes, np.array([d["n_bytes"] for d in row["docs"]], np.int64), decoder)
                ends = np.cumsum(sizes)
                start = starts.value[row["file_key"], row["block"]]
                raw = ids.astype("<u4").tobytes()
                cells = [raw[4 * (e - n): 4 * e] for e, n in zip(ends.tolist(), sizes.tolist())]
                for f in range(0, len(cells), 500):
                    part = slice(f, f + 500)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([d["doc_id"] for d in row["docs"][part]], pa.int64()),
                         pa.array((ends - sizes)[part] + start, pa.int64()), pa.array(sizes[part], pa.int64()),
                         pa.array([row["first"]] * len(cells[part]), pa.int64()), pa.array(cells[part], pa.binary())],
                        ["doc_id", "start", "n_tokens", "first", "ids"])

    def decoded(rows):
        return rows.select([n for n, _ in _BLOCK]).mapInArrow(decode, "doc_id long, start long, n_tokens long, first long, ids binary")

    whole = decoded(table.where("not cut")).drop("first")
    pieces = decoded(table.where("cut"))
    long = (pieces.withColumn("start", F.col("start") - F.col("first")).groupBy("doc_id", "start").agg(
        F.sum("n_tokens").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("first", F.hex("ids").alias("x")))).alias("parts"))
        .select("doc_id", "start", "n_tokens", F.unhex(F.array_join(F.transform("parts", lambda p: p["x"]), "")).alias("ids")))
    return whole.unionByName(long)


def write_and_read(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Tokenize, write the block files in the shared folder, and read them back."""
    spark = docs.sparkSession
    ids, path = scratch_path(spark, "ids"), scratch_path(spark, "corpus")
    tokenize(docs, tokenizer_path).write.option("compression", "zstd").parquet(ids)
    write_corpus(spark.read.parquet(ids), path)
    return read_corpus(spark, path)
