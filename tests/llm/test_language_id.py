import math
import random

import numpy as np
import pytest

from paperloom.llm import language_id as lang
from paperloom.llm.queries import op10_language_id
from tests.llm.helpers import awkward, docs

SYLLABLES = {"aa": ["ka", "to", "mi", "ru"], "bb": ["strö", "ßen", "ung", "lich"], "cc": ["eau", "çon", "lle", "qué"]}


def text(rng, code, n):
    return " ".join("".join(rng.choice(SYLLABLES[code]) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(4)
    rows = [(k, text(rng, code, rng.randint(5, 60)), code) for k, code in enumerate(list(SYLLABLES) * 40)]
    return docs(spark, rows + [(900, "unlabelled", None), (901, None, "aa"), (902, "123 !!", "bb")])


@pytest.fixture(scope="module")
def model(labelled):
    return lang.train(labelled.select("lang", "text"))


def test_probabilities_sum_to_one(model):
    """For each context of the highest order, over all symbols: seen, or seen in a shorter context only, or never."""
    rng = np.random.default_rng(0)
    for context in rng.choice(model.contexts[-1], 20):
        keys = (np.uint32(context) << np.uint32(8)) | np.arange(256, dtype=np.uint32)
        for j in range(len(model.languages)):
            total = sum(2.0 ** -model.entropies(keys[k: k + 1])[j] for k in range(256))
            assert math.isclose(total, 1, rel_tol=1e-9)


def test_kneser_ney_by_hand():
    """Two trigrams in one context, as 4-grams of one language."""
    a, b, x = 2, 3, 4
    key = lambda *s: sum(v << 8 * (3 - k) for k, v in enumerate(s))
    keys, counts = np.array([key(x, x, a, a), key(x, x, a, b)], np.uint32), np.array([3.0, 1.0])
    levels = lang.kneser_ney(keys, counts)
    order4 = dict(zip(levels[3][0].tolist(), levels[3][1].tolist()))
    order3 = dict(zip(levels[2][0].tolist(), levels[2][1].tolist()))
    d = lang.DISCOUNT
    for k, n in zip(keys.tolist(), counts):
        assert math.isclose(order4[k], (n - d) / 4 + d * 2 / 4 * order3[k & 0xFFFFFF])
    assert math.isclose(order3[x << 16 | a << 8 | a], (1 - d) / 2 + d * 2 / 2 * dict(
        zip(levels[1][0].tolist(), levels[1][1].tolist()))[a << 8 | a])


def test_held_out_texts(spark, model):
    rng = random.Random(77)
    rows = [(k, text(rng, code, 12), code) for k, code in enumerate(list(SYLLABLES) * 30)]
    out = lang.score(docs(spark, rows, clashing=True), model).collect()
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.97
    assert not any(r.rejected for r in out) and all(0 <= r.score <= 1 for r in out)


def test_rejection(spark, model):
    out = {r.doc_id: r for r in lang.score(docs(spark, [(1, "zzqxj wvbpd hgfkx qqzzx jjwvk zzqxj pppq"), (2, None), (3, ""), (4, "12 34 .,"), (5, "kato miru")])
                                           .select("doc_id", "text"), model).collect()}
    assert out[1].rejected and out[1].lang_pred in SYLLABLES
    for k in (2, 3, 4):
        assert out[k].lang_pred == "und" and out[k].score == 0 and out[k].rejected
    assert out[5].lang_pred == "aa" and not out[5].rejected


def test_marks_alone_are_no_letters(spark, model):
    rows = [(1, "\u0301"), (2, "12 \u0308\u0301 34"), (3, "\u0301a"), (4, "\u4e00\u0301")]
    out = {r.doc_id: r for r in lang.score(docs(spark, rows).select("doc_id", "text"), model).collect()}
    assert [(out[k].lang_pred, out[k].score, out[k].rejected) for k in (1, 2)] == [("und", 0.0, True)] * 2
    assert out[3].lang_pred in SYLLABLES and out[4].lang_pred in SYLLABLES


def test_awkward_rows(spark, model):
    rows = awkward()
    out = lang.score(docs(spark, rows).select("doc_id", "text"), model)
    assert out.count() == len(rows)
    assert len({(r.lang_pred, r.score) for r in out.where("doc_id in (7, 8)").collect()}) == 1


def test_rare_scripts_are_told_apart(spark):
    """Two languages in rarer letters, one beyond the basic plane, next to 400 letters that are all more frequent."""
    rng = random.Random(6)
    common = [chr(0x4E00 + k) for k in range(400)]
    rare = {"dd": ["\u10d0\u10d1", "\u10d2\u10d3"], "ee": ["\u10d4\u10d5", "\u10d6\u10d7"],
            "ff": ["\U00010481\U00010482", "\U00010483"], "gg": ["\U00010491\U00010492", "\U00010493"]}
    make = lambda parts, n: " ".join("".join(rng.choice(parts) for _ in range(3)) for _ in range(n))
    rows = [(k, make(common, 400), "zz") for k in range(40)]
    rows += [(100 + k, make(rare[code], 10), code) for k, code in enumerate(list(rare) * 8)]
    model = lang.train(docs(spark, rows).select("lang", "text"))
    assert model.table.dtype == np.uint32
    asked = [(k, make(rare[code], 6), code) for k, code in enumerate(list(rare) * 5)]
    out = lang.score(docs(spark, asked), model).collect()
    assert all(r.lang == r.lang_pred and not r.rejected for r in out)
    for context in rng.sample(model.contexts[-1].tolist(), 5):  # the seen symbols and one for all others
        keys = np.array([context << 16 | int(x) for x in model.keys[0].tolist() + [0xFFFF]], np.uint64)
        for j in range(len(model.languages)):
            assert math.isclose(sum(2.0 ** -model.entropies(keys[k: k + 1])[j] for k in range(len(keys))), 1, rel_tol=1e-9)


def test_all_counts_are_kept(spark, monkeypatch):
    """A small language next to a large one keeps each of its n-grams, also where few fit a bound on both."""
    monkeypatch.setattr(lang, "MOST_NGRAMS", 50, raising=False)
    rng = random.Random(8)
    rows = [(k, text(rng, "aa", 60), "aa") for k in range(30)] + [(50, "strößen ungquälte vögel", "zz")]
    model = lang.train(docs(spark, rows).select("lang", "text"))
    assert model.languages == ["aa", "zz"]
    for _, own, _ in rows:
        assert lang._find(model.keys[-1], lang.grams(own, model.table))[1].all()


def test_no_labels(spark):
    empty = docs(spark, [])
    model = lang.train(empty.select("lang", "text"))
    assert [r.lang_pred for r in lang.score(docs(spark, [(1, "text")]).select("doc_id", "text"), model).collect()] == ["und"]
    assert lang.score(empty.select("doc_id", "text"), model).count() == 0


def test_query_learns_from_the_other_folds_only(spark, tmp_path):
    import zlib

    rng = random.Random(5)
    rows = []
    for k in range(200):
        held = zlib.crc32(str(k).encode()) % 3 == 1
        code = rng.choice(list(SYLLABLES))
        rows.append((k, text(rng, code, 20), "wrong" if held else code))
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    out = op10_language_id(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out if r.held_out} == {k for k, _, c in rows if c == "wrong"}
    assert all(r.lang_pred in SYLLABLES for r in out)
