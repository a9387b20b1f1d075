"""Packing and token files against the tokenizers library alone."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from paperloom.llm import packing, token_files
from paperloom.llm.queries import tokenizer
from paperloom.llm.token_ids import Encoder
from tests.llm.helpers import awkward, docs

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


@pytest.fixture(scope="module")
def plain():
    made = {f: Tokenizer.from_file(tokenizer(f)) for f in FILES}
    return lambda f, text: made[f].encode(text or "", add_special_tokens=False).ids + [1]


@pytest.fixture(scope="module")
def encoders():
    return {f: Encoder(tokenizer(f)) for f in FILES}


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aAb's 'll 12,.!\n\t\r\x1c\x85  éßñ漢́\U0001F600<|endoftext|>")), max_size=40))
def test_pieces_give_the_same_ids(encoders, plain, text):
    for f in FILES:
        assert encoders[f].encode([text])[0].tolist() == plain(f, text)


def test_pieces_table_starts_anew(plain, monkeypatch):
    monkeypatch.setattr("paperloom.llm.token_ids.REMEMBERED", 3)
    encoder = Encoder(tokenizer(FILES[0]))
    for text in ("a b c d", "e f g h", "a e i o"):
        assert encoder.encode([text, None, text])[2].tolist() == plain(FILES[0], text)


def test_packing(spark, plain):
    rows = [(k, t) for k, (_, t) in enumerate(awkward())]
    pieces = packing.pack(docs(spark, rows, clashing=True), tokenizer(FILES[0])).toPandas()
    for k, text in rows:
        ids, own = np.array(plain(FILES[0], text), "<u4"), pieces[pieces.doc_id == k].sort_values("start")
        assert b"".join(own.ids) == ids.tobytes() and own.start.tolist() == [0, *np.cumsum(own.length)[:-1]]
        assert set(own.doc_tokens) == {len(ids)}
    for _, own in pieces.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == [0, *np.cumsum(own.length)[:-1]]
        total = own.length.sum()
        assert total == 2048 or total & (total - 1) == 0  # no padding at all
    assert packing.pack(docs(spark, []), tokenizer(FILES[0])).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 150), st.integers(0, 150)), max_size=80))
def test_limits_hold_in_every_dimension(items):
    packer = packing.Packer((64, 4, 40), pool=16)
    for k, (n, loss) in enumerate(items):
        packer.add(packing.Example(k, np.arange(n), max(0, n - loss)))
    packer.finish()
    totals = {}
    placed = {k: [] for k in range(len(items))}
    for own, start, n, sequence, offset in packer.ready:
        t = totals.setdefault(sequence, [0, 0, 0])
        assert offset == t[0]
        t[0] += n
        t[1] += 1
        t[2] += max(0, start + n - max(start, own.loss_from))
        placed[own.doc_id].append((start, n))
        assert np.frombuffer(own.piece(start, n), "<u4").tolist() == list(range(start, start + n))
    assert all(a <= 64 and b <= 4 and c <= 40 for a, b, c in totals.values())
    assert all(a & (a - 1) == 0 for a, _, _ in totals.values())  # no padding, whichever limit ends a sequence
    for k, (n, _) in enumerate(items):
        at = 0
        for start, length in sorted(placed[k]):
            assert start == at
            at += length
        assert at == n


def test_short_examples_leave_no_padding():
    packer = packing.Packer((2048, 256, 2048))
    for k in range(5000):
        packer.add(packing.Example(k, np.arange(1 + k % 3)))
    packer.finish()
    totals = {}
    for _, _, n, sequence, _ in packer.ready:
        totals[sequence] = totals.get(sequence, 0) + n
    assert sum(totals.values()) == sum(1 + k % 3 for k in range(5000))
    assert all(t & (t - 1) == 0 and t <= 2048 for t in totals.values()) and len(totals) < 120


def test_limits_below_one_are_refused(spark):
    with pytest.raises(ValueError):
        packing.pack(docs(spark, [(1, "a")]), tokenizer(FILES[0]), loss_tokens=0)


def test_loss_column(spark):
    frame = docs(spark, [(1, "a b c d e f"), (2, "x y z")]).withColumn("bears", F.lit(2))
    pieces = packing.pack(frame, tokenizer(FILES[0]), loss_column="bears").toPandas()
    assert pieces.groupby("doc_id").loss_tokens.sum().to_dict() == {1: 2, 2: 2}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 400) | st.just(1), max_size=700), min_size=1, max_size=6))
def test_codes_round_trip(documents):
    arrays = [np.array(d, np.uint32) for d in documents]
    counts = np.bincount(np.concatenate(arrays).astype(np.int64), minlength=500)
    lengths = token_files.code_lengths(counts)
    coded = token_files.encode_ids(arrays, token_files.canonical_codes(lengths), lengths)
    back = token_files.decode_ids(b"".join(p for p, _ in coded), b"".join(c for _, c in coded), np.array([len(a) for a in arrays]),
                                  np.array([len(p) for p, _ in coded]), token_files.decoding_table(lengths))
    assert back.tolist() == np.concatenate(arrays).tolist()


def test_lengths_are_limited_and_best():
    fibonacci = [1, 1]
    while len(fibonacci) < 40:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    lengths = token_files.code_lengths(np.array(fibonacci))
    assert lengths.max() == token_files.LIMIT and np.isclose((2.0 ** -lengths.astype(float)).sum(), 1)
    counts = np.array([45, 13, 12, 16, 9, 5])  # without a binding limit: Huffman's cost
    assert (token_files.code_lengths(counts).astype(int) * counts).sum() == 224
    assert token_files.code_lengths(np.array([0, 7, 0])).tolist() == [0, 1, 0]


@pytest.mark.parametrize("block, file", [(1 << 18, 1 << 23), (300, 2000)])
def test_written_corpus(spark, plain, monkeypatch, block, file):
    monkeypatch.setattr(token_files, "BLOCK_IDS", block)
    rows = [(k, t) for k, (_, t) in enumerate(awkward())]
    ids = token_files.tokenize(docs(spark, rows, clashing=True), tokenizer(FILES[1]))
    path = token_files.scratch_path(spark, "corpus")
    token_files.write_corpus(ids, path, file)
    got = {r.doc_id: (r.start, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in token_files.read_corpus(spark, path).collect()}
    want, at = {}, 0
    for k, text in rows:
        own = plain(FILES[1], text)
        want[k] = (at, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        at += len(own)
    assert got == want


def test_null_and_repeated_ids(spark, plain):
    rows = awkward()
    out = token_files.write_and_read(docs(spark, rows), tokenizer(FILES[1])).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(i) for i, _ in rows)
    at = 0
    for row in sorted(out, key=lambda r: r.start):
        assert row.start == at
        at += row.n_tokens
    assert at == sum(len(plain(FILES[1], t)) for _, t in rows)
    assert token_files.write_and_read(docs(spark, []), tokenizer(FILES[1])).count() == 0
