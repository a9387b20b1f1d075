import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperloom.llm import chunked_tokens as ct
from paperloom.llm import queries as Q
from tests.llm.helpers import awkward, docs, sentence

PATH = Q.tokenizer("byte_bpe_50k.json")
PIECES = ["the", "Straße", " ", "  ", "\n", "\t", "\r\n", "'s", "'", "12", "345678", "<|endoftext|>", "<|", "|>", "é", "漢字", "\U0001F600", " ",
          "　", "\x0b", "\x1c", "...", "--", "don't", "I'll", "naïve", "x" * 40, "́", "a", "b"]


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids, lambda ids: tokenizer.decode(ids, skip_special_tokens=False)


@pytest.fixture(scope="module")
def small():
    return ct.Codec(PATH, mean=16, least=4, most=40)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=60).map("".join), max_size=4))
def test_ids_are_the_tokenizers_own(plain, small, texts):
    got = small.encode([t.encode() for t in texts])
    assert [ids.tolist() for ids in got] == [plain[0](t) for t in texts]
    assert [small.decode(ids).decode("utf-8", "replace") for ids in got] == [plain[1](ids.tolist()) for ids in got] == texts


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200))
def test_ids_of_any_text(plain, small, text):
    assert small.encode([text.encode()])[0].tolist() == plain[0](text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=30))
def test_decoding_any_ids(plain, small, ids):
    assert small.decode(np.array(ids, np.uint32)).decode("utf-8", "replace") == plain[1](ids)


def test_chunks_follow_content():
    rng = random.Random(3)
    text = sentence(rng, 8000).encode()
    marks = [ct.cuts(np.frombuffer(t, np.uint8), [0, len(t)])[0] for t in (text, b"other words ahead " * 30 + text)]
    chunks = [{t[a:b] for a, b in zip([0, *m], m)} for t, m in zip((text, b"other words ahead " * 30 + text), marks)]
    assert len(chunks[0] & chunks[1]) >= 0.9 * len(chunks[0])
    sizes = np.diff([0, *marks[0]])
    assert sizes[:-1].min() >= ct.LEAST and sizes.max() <= ct.MOST + 3 and marks[0][-1] == len(text)


def test_shared_chunks_are_encoded_once(plain):
    rng = random.Random(5)
    same = sentence(rng, 3000)
    codec = ct.Codec(PATH)
    texts = [f"{sentence(rng, 5)} {same} {k}" for k in range(40)]
    for k in range(0, 40, 8):
        got = codec.encode([t.encode() for t in texts[k: k + 8]])
        assert [g.tolist() for g in got] == [plain[0](t) for t in texts[k: k + 8]]
    assert codec.chunks.reused > 3 * codec.chunks.encoded


def test_what_recurs_outlives_a_generation():
    chunks = ct.Chunks(most=100)
    chunks.put("kept", [1] * 10)
    for k in range(100):
        chunks.put(k, [1] * 10)
        assert chunks.get("kept") is not None
    assert chunks.get(3) is None and len(chunks.young) + len(chunks.old) < 10


def test_windows_grow_until_they_agree(plain, monkeypatch):
    """Windows between places where merges do not stop disagree at first; none is taken before it agrees."""
    monkeypatch.setattr(ct, "_SPACE", np.ones(256, bool))
    codec = ct.Codec(PATH, mean=16, least=4, most=40)
    rng = random.Random(1)
    text = "".join(rng.choice(PIECES) for _ in range(300)) + sentence(rng, 200)
    ids = codec.encode([text.encode()])[0]
    assert codec.decode(ids).decode() == text


def test_query_on_awkward_rows(spark, tmp_path, plain):
    rows = awkward()
    docs(spark, rows, clashing=True).withColumn("ids", F.lit("x")).write.parquet(str(tmp_path / "documents.parquet"))
    got = Q.queries()["op11_chunked_tokens"](spark, str(tmp_path)).collect()
    want = []
    for doc_id, text in (r[:2] for r in rows):
        ids = plain[0](text or "")
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(plain[1](ids).encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_encode_then_decode(spark):
    frame = docs(spark, awkward(), clashing=True).withColumn("decoded", F.lit(1))
    back = ct.decode(ct.encode(frame, PATH), PATH)
    assert sorted((r.doc_id or 0, r.decoded) for r in back.collect()) == sorted((r[0] or 0, r[1] or "") for r in awkward())
    assert set(back.columns) == set(frame.columns) - {"text"} | {"n_tokens"}
    assert ct.encode(docs(spark, []), PATH, decoded=True).count() == 0
