"""Skip-gram word vectors with parameters in blocks.

Words are numbered by falling frequency and dealt into blocks in turn, so blocks are alike.  Pairs of words that stand near
each other are counted by cells (block of the one word, block of the other) and kept in coded files, one for each cell.  An
iteration first moves the contexts with the words at rest, then the words with the contexts at rest: a task moves rows of
one block, reading the blocks of the side at rest and its own cells one after another, and writes its rows once.  So no
parameter is shuffled, a task holds two blocks and one cell, and the driver holds nothing that grows with the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from paperloom.memory import released
from paperloom.operators.indexing import dense_index
from paperloom.operators.skew import lookup
from paperloom.operators.word_codes import TABLE_BYTES, TABLE_ROWS, WordTable, coded, word_counts
from paperloom.session import discard, run_tasks, scratch_path, staged
from paperloom.sources.storage import get_file, put_file

#: Bytes of a block of vectors, of a piece of a cell in a row; pairs sorted at a time, pairs of a cell (about, before equal
#: ones are added up), vectors in a batch.
BLOCK_BYTES, PIECE_BYTES, PAIRS, CELL_PAIRS, ROWS = 48 << 20, 256 << 10, 1 << 22, 1 << 24, 1 << 13
#: Rows moved at a time; of these, numbers in the rows whose pairs are multiplied together, and bytes
#: of what they are multiplied with.
TILE_ROWS, FEW_CELLS, SLICE_BYTES = 64, 2400, 512 << 10
#: What a pair on its own costs, in cells of a full product.
PAIR_COST = 24
#: Negative samples of a pair, samples of a block shared by the rows moved, the length of a step; how often an iteration moves each word and
#: each context at least.
NEGATIVES, SAMPLES, RATE, WORD_STEPS, CONTEXT_STEPS = 5, 256, 0.1, 8, 16

_PAIRS = "cell long, a binary, b binary, w binary"
_CODED = "cell long, data binary"


def word_ids(tokens: DataFrame, min_count: int, column: str = "tokens") -> DataFrame:
    """(token, cnt, id): words with `min_count` occurrences, numbered by falling counts; a stored table."""
    words = word_counts(tokens, column).filter((F.col("cnt") >= min_count) & F.col("token").isNotNull())
    ordered = staged(words.select("token", "cnt", (-F.col("cnt")).alias("_rare"), F.xxhash64("token").alias("_hash")), "words")
    return staged(dense_index(ordered, ["_rare", "_hash", "token"], "id").select("token", "cnt", "id"), "word-ids")


def _listing(table):
    """Token arrays -> for each the numbers of its listed words."""
    def run(batches):
        words, ids = table.value
        for batch in batches:
            names, place, lengths = coded(batch.column(0))
            found = np.append(words.places(names), -1)[place]
            at = np.flatnonzero(found >= 0)
            row = np.repeat(np.arange(len(lengths)), lengths)[at]
            offsets = np.append(0, np.cumsum(np.bincount(row, minlength=len(lengths)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids[found[at]]))], ["ids"])

    return released(run)


def id_lists(tokens: DataFrame, ids: DataFrame, column: str = "tokens") -> DataFrame:
    """(ids): for each row of `tokens` the numbers of its listed words, in their order.

    Words are looked up where rows are read; only a table of words too large for every task is joined.
    """
    size = ids.agg(F.count("*").alias("n"), F.sum(F.octet_length("token") + 32).alias("b")).first()
    if size.n <= TABLE_ROWS and (size.b or 0) <= TABLE_BYTES:
        held = ids.select("token", "id").toArrow()
        words = WordTable(held["token"].cast(pa.string()).combine_chunks())
        order = np.argsort(words.places(held["token"].cast(pa.string()).combine_chunks()))
        table = tokens.sparkSession.sparkContext.broadcast((words, held["id"].to_numpy()[order].astype(np.int32)))
        return tokens.select(column).mapInArrow(_listing(table), "ids array<int>")
    rows = staged(tokens.select(F.monotonically_increasing_id().alias("_row"), F.col(column).alias("tokens")), "rows")
    each = rows.select("_row", F.posexplode("tokens").alias("_pos", "token"))
    found = lookup(each, ids.select("token", F.col("id").cast("int").alias("id")), "token", ["_row", "_pos"])
    listed = found.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("_pos", "id"))).alias("_each"))
    return listed.select(F.transform("_each", lambda e: e["id"]).alias("ids"))


def _summed(key, weight):
    """Distinct keys, ascending, and the sums of their weights."""
    order = np.argsort(key, kind="stable")
    key, weight = key[order], weight[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(weight, first, dtype=np.int64) if len(first) else weight.astype(np.int64)


def _packed(values) -> bytes:
    """Whole numbers from 0, coded: their lowest bytes, next ones and so on, as far as any has them, compressed."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return len(values).to_bytes(8, "little") + width.to_bytes(1, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(data):
    n, width = int.from_bytes(data[:8], "little"), data[8]
    planes = np.frombuffer(pa.decompress(data[9:], n * width, codec="zstd"), np.uint8).reshape(width, n)
    values = np.zeros((n, 8), np.uint8)
    values[:, :width] = planes.T
    return values.view("<u8").ravel().astype(np.int64)


def pack_pairs(key, weight) -> bytes:
    """Pairs (ascending keys) and their weights as bytes."""
    first = _packed(np.diff(key, prepend=0))
    return len(first).to_bytes(8, "little") + first + _packed(weight)


def unpack_pairs(data):
    n = int.from_bytes(data[:8], "little")
    return np.cumsum(_unpacked(data[8:8 + n])), _unpacked(data[8 + n:])


def _pairs(window: int, words: int, blocks: int):
    """Lists of ids -> coded weights of pairs by cells, once for both orders.  Words at distance d weigh window - d + 1."""
    rows = -(-words // blocks)

    def cells(keys, weights):
        key, weight = _summed(np.concatenate(keys), np.concatenate(weights))
        a, b = np.divmod(key, words)
        turned = a % blocks > b % blocks
        a, b = np.where(turned, b, a), np.where(turned, a, b)
        cell, place = a % blocks * blocks + b % blocks, a // blocks * rows + b // blocks
        order = np.lexsort((place, cell))
        cell, place, weight = cell[order], place[order], weight[order]
        edges = np.r_[np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]), len(cell)]
        for s, e in zip(edges[:-1], edges[1:]):
            yield pa.RecordBatch.from_pydict({"cell": [int(cell[s])], "data": [pack_pairs(place[s:e], weight[s:e])]})

    def run(batches):
        keys, weights, held = [], [], 0
        for batch in batches:
            lists = batch.column(0)
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            row = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
            for d in range(1, window + 1):
                near = row[d:] == row[:-d]
                a, b = ids[:-d][near], ids[d:][near]
                keys.append(np.minimum(a, b) * words + np.maximum(a, b))
                weights.append(np.full(len(a), window - d + 1, np.int32))
                held += len(a)
                if held >= PAIRS:
                    yield from cells(keys, weights)
                    keys, weights, held = [], [], 0
        if held:
            yield from cells(keys, weights)

    return released(run)


def _joined_cells(window: int, rows: int, blocks: int):
    """Pieces of cells -> cells of both orders with each pair once, ascending by the first word."""
    def pieces(cell, a, b, w):
        for k in range(0, len(a), PIECE_BYTES // 8):
            part = slice(k, k + PIECE_BYTES // 8)
            yield pa.RecordBatch.from_pydict({
                "cell": [cell], "a": [a[part].astype(np.int32).tobytes()], "b": [b[part].astype(np.int32).tobytes()],
                "w": [(w[part] / window).astype(np.float32).tobytes()]})

    def run(batches):
        held = {}
        for batch in batches:
            for cell, data in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(cell, []).append(unpack_pairs(data))
        for cell in list(held):
            parts = held.pop(cell)
            key, weight = _summed(np.concatenate([k for k, _ in parts]), np.concatenate([w for _, w in parts]))
            a, b = np.divmod(key, rows)
            own, other = divmod(cell, blocks)
            if own == other:  # a word beside itself counts from both sides
                apart = a != b
                a, b, weight = np.r_[a, b[apart]], np.r_[b, a[apart]], np.r_[weight * np.where(apart, 1, 2), weight[apart]]
                order = np.lexsort((b, a))
                yield from pieces(own * blocks, a[order], b[order], weight[order])
                continue
            yield from pieces(own * blocks + (other - own) % blocks, a, b, weight)
            order = np.lexsort((a, b))
            yield from pieces(other * blocks + (own - other) % blocks, b[order], a[order], weight[order])

    return released(run)


def cells_of(lists: DataFrame, window: int, words: int, blocks: int) -> DataFrame:
    """(cell, a, b, w): rows of the two words in their blocks and weights, as arrays; the cell is block * blocks + shift."""
    parts = lists.mapInArrow(_pairs(window, words, blocks), _CODED)
    rows = -(-words // blocks)
    return parts.repartitionById(blocks * blocks, F.col("cell").cast("int")).mapInArrow(_joined_cells(window, rows, blocks), _PAIRS)


def _stored_cells(root: str, window: int, rows: int):
    """Writes each cell as a file of its own; a cell's rows stand together."""
    def run(batches):
        at, held = None, []

        def stored():
            a, b, w = (np.concatenate([np.frombuffer(r[k], kind) for r in held]) for k, kind in enumerate((np.int32, np.int32, np.float32)))
            put_file(f"{root}/pairs/{at}", pack_pairs(a.astype(np.int64) * rows + b, np.rint(w * window).astype(np.int64)))
            return pa.RecordBatch.from_pydict({"cell": [at]})

        for batch in batches:
            for cell, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if cell != at and held:
                    yield stored()
                    held = []
                at = cell
                held.append(row)
        if held:
            yield stored()

    return released(run)


def _stored_counts(root: str):
    """Writes the counts of each block's words as a file, in the order of their rows."""
    def run(batches):
        held = {}
        for batch in batches:
            block, row, cnt = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            for b in np.unique(block):
                held.setdefault(int(b), []).append((row[block == b], cnt[block == b]))
        for b in list(held):
            pieces = held.pop(b)
            cnt = np.concatenate([c for _, c in pieces])
            counts = np.empty(len(cnt), np.int64)
            counts[np.concatenate([r for r, _ in pieces])] = cnt
            put_file(f"{root}/counts/{b}", counts)
            yield pa.RecordBatch.from_pydict({"block": [b]})

    return released(run)


def _sigmoid(x):
    """In place."""
    np.negative(x, out=x)
    with np.errstate(over="ignore"):  # of far too small numbers the result is 0
        np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def dense_rows(to, rows: int) -> int:
    """So many of the first rows at rest have, with the `rows` moved, more pairs than their share of a full product costs."""
    if not len(to):
        return 0
    pairs = np.cumsum(np.bincount(to // TILE_ROWS))
    gain = pairs * PAIR_COST - np.arange(1, len(pairs) + 1) * (TILE_ROWS * rows)
    best = int(np.argmax(gain))
    return (best + 1) * TILE_ROWS if gain[best] > 0 else 0


def move(mine, squares, mass, other, odds, a, b, w, samples: int, random) -> None:
    """One step of the rows `mine`, in place, on pairs (a, b) of weight w, ascending by a, with the rows `other` at rest.

    A row is told from `samples` draws of `other` by `odds`, which weigh `mass` together and are shared by all rows, so they are a
    product of matrices.  So are the pairs of a few rows.  The step is along the gradient, and its length is adapted to each
    row's gradients so far, whose `squares` are summed.
    """
    if not len(mine) or not len(other):
        return
    odds = odds / odds.sum()
    if len(other) <= samples:
        drawn, times = np.arange(len(other)), odds
    else:
        drawn, n = np.unique(random.choice(len(other), samples, p=odds), return_counts=True)
        times = n / samples
    far, mass = other[drawn], mass.astype(np.float32)[:, None]
    scaled = far * -times.astype(np.float32)[:, None]
    width = mine.shape[1]
    ends = np.searchsorted(a, np.arange(0, len(mine) + 1))
    few, most = max(4, FEW_CELLS // width), max(64, SLICE_BYTES // (4 * width))
    for lo in range(0, len(mine), TILE_ROWS):
        hi = min(len(mine), lo + TILE_ROWS)
        rows = mine[lo:hi]
        grad = _sigmoid(rows @ far.T) @ scaled
        grad *= mass[lo:hi]
        at, to, weight = a[ends[lo]:ends[hi]] - lo, b[ends[lo]:ends[hi]], w[ends[lo]:ends[hi]]
        cut = min(len(other), dense_rows(to, hi - lo))
        if cut:  # most of these rows are frequent words, and have pairs with many of the rows moved
            inside = to < cut
            i, j = at[inside], to[inside]
            dots = rows @ other[:cut].T
            found = weight[inside] * (1 - _sigmoid(dots[i, j]))
            dots.fill(0)
            dots[i, j] = found
            grad += dots @ other[:cut]
            at, to, weight = at[~inside], to[~inside], weight[~inside]
        bounds = np.searchsorted(at, np.arange(0, hi - lo + few, few))
        for first, s, e in zip(range(0, hi - lo, few), bounds[:-1], bounds[1:]):
            for k in range(s, e, most):
                part = slice(k, min(e, k + most))
                i, near = at[part] - first, other[to[part]]
                each = np.arange(len(i))
                dots = rows[first:first + few] @ near.T
                found = weight[part] * (1 - _sigmoid(dots[i, each]))
                dots.fill(0)
                dots[i, each] = found
                grad[first:first + few] += dots @ near
        squares[lo:hi] += np.einsum("ij,ij->i", grad, grad) / width
        rows += (RATE / np.sqrt(np.maximum(squares[lo:hi], 1e-30)))[:, None] * grad


class Blocks:
    """Files of the parameters, counts and pairs of a training.

    Rows of a block are dealt in turn to `parts`; row r of part k of block b is word (r * parts + k) * blocks + b.  Parameters
    of a part are its vectors followed by the sums of squares of their gradients.
    """

    def __init__(self, root: str, width: int, blocks: int, parts: int, window: int, noise: float, seed: int):
        self.root, self.width, self.blocks, self.parts = root, width, blocks, parts
        self.window, self.noise, self.seed = window, noise, seed

    def counts(self, block: int):
        return np.frombuffer(get_file(f"{self.root}/counts/{block}") or b"", np.int64).astype(np.float64)

    def state(self, side: str, n: int, block: int, part: int):
        """(vectors, squares) of a part after n moves of its side; at first words lie at random, contexts at 0."""
        if n:
            data = np.frombuffer(get_file(f"{self.root}/{side}-{n}/{block}-{part}"), np.float32)
            rows = len(data) // (self.width + 1)
            return data[:rows * self.width].reshape(rows, self.width), data[rows * self.width:]
        rows = len(self.counts(block))
        if side == "context":
            vectors = np.zeros((rows, self.width), np.float32)
        else:
            vectors = (np.random.default_rng([self.seed, block]).random((rows, self.width), dtype=np.float32) - 0.5) / self.width
        vectors = vectors[part::self.parts]
        return vectors, np.zeros(len(vectors), np.float32)

    def keep(self, side: str, n: int, block: int, part: int, vectors, squares) -> None:
        put_file(f"{self.root}/{side}-{n}/{block}-{part}", np.r_[vectors.reshape(-1), squares])

    def vectors(self, side: str, n: int, block: int):
        parts = [self.state(side, n, block, k)[0] for k in range(self.parts)]
        if self.parts == 1:
            return parts[0]
        whole = np.empty((sum(map(len, parts)), self.width), np.float32)
        for k, part in enumerate(parts):
            whole[k::self.parts] = part
        return whole

    def pairs(self, cell: int, part: int):
        """(a, b, w): rows in the part, rows in the other block, weights."""
        data = get_file(f"{self.root}/pairs/{cell}")
        if data is None:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
        key, weight = unpack_pairs(data)
        a, b = np.divmod(key, max(1, len(self.counts(0))))
        if self.parts > 1:
            at = np.flatnonzero(a % self.parts == part)
            a, b, weight = a[at] // self.parts, b[at], weight[at]
        return a, b, (weight / self.window).astype(np.float32)

    def moved(self, side: str, mine, squares, block: int, part: int, times: int, steps: int, others, pairs, seed: list) -> None:
        """Move a part's rows over all blocks of the other side, `times` over, in `steps` steps a block."""
        own = self.counts(block)[part::self.parts]
        for turn in range(times * self.blocks):
            shift = turn % self.blocks
            of = (block + shift) % self.blocks
            other, cnt, (a, b, w) = others(of), self.counts(of), pairs(block * self.blocks + shift, part)
            odds = cnt if side == "context" else cnt ** 0.75
            mass = NEGATIVES * (self.window + 1) / self.noise * (own ** 0.75 if side == "context" else own)
            random = np.random.default_rng([*seed, block, turn])
            for k in range(steps):  # of the other block each step has some rows, and all of its pairs are in one step
                if steps == 1:
                    move(mine, squares, mass * odds.sum(), other, odds, a, b, w, SAMPLES, random)
                elif len(other) > k:
                    at = np.flatnonzero(b % steps == k)
                    some = np.ascontiguousarray(other[k::steps])
                    move(mine, squares, mass * odds[k::steps].sum(), some, odds[k::steps], a[at], b[at] // steps, w[at], -(-SAMPLES // steps), random)


def _moves(files: Blocks, side: str, n: int, steps: int, times: int):
    """Numbers of parts -> the same, when their rows are moved the n-th time."""
    def run(batches):
        for batch in batches:
            for number in batch.column(0).to_pylist():
                part, block = divmod(number, files.blocks)
                mine, squares = (x.copy() for x in files.state(side, n - 1, block, part))
                other, done = ("word", n - 1) if side == "context" else ("context", n)
                files.moved(side, mine, squares, block, part, times, steps, lambda of: files.vectors(other, done, of), files.pairs, [files.seed, n, side == "word"])
                files.keep(side, n, block, part, mine, squares)
                yield pa.RecordBatch.from_pydict({"id": [number]})

    return released(run)


def _all_moves(files: Blocks, iterations: int, times: int, steps: int):
    """`_moves` of all iterations for a vocabulary of one block, which one task holds."""
    def run(batches):
        for batch in batches:
            for number in batch.column(0).to_pylist():
                state = {side: [x.copy() for x in files.state(side, 0, 0, 0)] for side in ("word", "context")}
                cell = files.pairs(0, 0)
                for n, k, side in ((n, k, s) for n in range(iterations) for k in range(times) for s in ("context", "word")):
                    still = state["word" if side == "context" else "context"][0]
                    files.moved(side, *state[side], 0, 0, 1, steps[side], lambda of: still, lambda *of: cell, [files.seed, n, side == "word", k])
                files.keep("word", iterations, 0, 0, *state["word"])
                yield pa.RecordBatch.from_pydict({"id": [number]})

    return released(run)


def _named(files: Blocks, n: int):
    """(block, row, token) -> (word, vector)."""
    def run(batches):
        at, vectors = None, None
        for batch in batches:
            block, row = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for b in np.unique(block):
                if b != at:
                    at, vectors = b, files.vectors("word", n, int(b))
                here = np.flatnonzero(block == b)
                for k in range(0, len(here), ROWS):
                    some = here[k:k + ROWS]
                    ends = pa.array(np.arange(len(some) + 1, dtype=np.int32) * files.width)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(2).take(pa.array(some)), pa.ListArray.from_arrays(ends, pa.array(vectors[row[some]].reshape(-1)))], ["word", "vector"])

    return released(run)


def train(tokens: DataFrame, width: int, window: int, min_count: int, iterations: int, partitions: int, seed: int,
          column: str = "tokens") -> DataFrame:
    """(word, vector) of skip-gram with negative sampling, as a stored table.

    The vocabulary has `partitions` blocks, more if a block or a cell of pairs were large, fewer if it is small.
    """
    spark = tokens.sparkSession
    ids = word_ids(tokens, min_count, column)
    words, noise, total = ids.agg(F.count("*"), F.sum(F.col("cnt").cast("double") ** 0.75), F.sum("cnt")).first()
    if not words:
        raise ValueError(f"no word occurs {min_count} times")
    fine = max(partitions, -(-words * width * 4 // BLOCK_BYTES), int((2 * total * window / CELL_PAIRS) ** 0.5))
    blocks = max(1, min(fine, words // SAMPLES))
    tasks = spark.sparkContext.defaultParallelism
    parts = 1 if blocks == 1 else -(-2 * tasks // blocks)
    root = scratch_path(spark, "skipgram")
    files = Blocks(root, width, blocks, parts, window, noise, seed)
    rows = -(-words // blocks)

    run_tasks(cells_of(id_lists(tokens, ids, column), window, words, blocks).mapInArrow(_stored_cells(root, window, rows), "cell long"))
    place = ids.select((F.col("id") % blocks).alias("block"), F.expr(f"id div {blocks}").alias("row"), "cnt", "token")
    by_block = place.repartitionById(blocks, F.col("block").cast("int"))
    run_tasks(by_block.select("block", "row", "cnt").mapInArrow(_stored_counts(root), "block long"))
    times = -(-WORD_STEPS // blocks)
    steps = {"word": 1, "context": -(-CONTEXT_STEPS // (blocks * times))}
    if blocks == 1:
        run_tasks(spark.range(0, 1, 1, 1).mapInArrow(_all_moves(files, iterations, times, steps), "id long"))
    else:
        every = spark.range(0, blocks * parts, 1, blocks * parts)
        for n in range(1, iterations + 1):
            for side in ("context", "word"):
                run_tasks(every.mapInArrow(_moves(files, side, n, steps[side], times), "id long"))
                discard(spark, f"{root}/{side}-{n - 1}")
    vectors = staged(by_block.select("block", "row", "token").mapInArrow(_named(files, iterations), "word string, vector array<float>"), "word-vectors")
    discard(spark, root)
    return vectors
