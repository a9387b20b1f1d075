import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paperloom.llm import license_scan as scan
from tests.llm.helpers import awkward, docs


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for phrase, label in scan.BASE.items():
        own = phrase.split()
        for k in range(len(words) - len(own) + 1):
            if words[k:k + len(own)] == own:
                places.append(k)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("GNU general public Licence license Apache, MIT cc by CC-BY x é- lesser spdx identifier".split()), max_size=30))
def test_base_columns(words):
    text = " ".join(words)
    assert scan.scan_text(text, scan.automaton())[:5] == brute(text)


@pytest.mark.parametrize("text, ways", [
    ("MIT", [("mit",)]),
    ("MIT OR Apache-2.0", [("apache-2.0",), ("mit",)]),
    ("MIT and BSD-3-Clause or Zlib", [("bsd-3-clause", "mit"), ("zlib",)]),
    ("MIT AND (BSD-3-Clause OR Zlib)", [("bsd-3-clause", "mit"), ("mit", "zlib")]),
    ("GPL-2.0-only WITH Classpath-exception-2.0 OR MIT", [("gpl-2.0-only-with-classpath-exception-2.0",), ("mit",)]),
    ("(GPL-2.0+ OR MIT) AND CC0-1.0 */", [("cc0-1.0", "gpl-2.0+"), ("cc0-1.0", "mit")]),
    ("MIT OR", [("mit",)]), ("(MIT", []), ("OR MIT", []), ("", []), ("MIT) x", [("mit",)]),
])
def test_expressions(text, ways):
    assert scan.alternatives(scan.to_postfix(text)) == ways


@pytest.mark.parametrize("text, ways", [
    ("A WITH (B OR C)", [("a-with-b",), ("a-with-c",)]),
    ("A WITH (B AND C)", [("a-with-b-and-c",)]),
    ("(A OR D) WITH (B OR C AND E)", [("a-with-b",), ("a-with-c-and-e",), ("d-with-b",), ("d-with-c-and-e",)]),
    ("(A AND D) WITH (B OR C)", [("a-with-b", "d-with-b"), ("a-with-c", "d-with-c")]),
])
def test_several_exceptions(text, ways):
    assert scan.alternatives(scan.to_postfix(text)) == ways
    row = scan.scan_text(f"SPDX-License-Identifier: {text}", scan.automaton())
    assert row[5] == ",".join(sorted({x for way in ways for x in way})) and row[7] == [text]


def test_tags_add_labels():
    row = scan.scan_text("// SPDX-License-Identifier: MIT OR Apache-2.0\ncode under the Apache License", scan.automaton())
    assert row[4] == "apache" and row[5] == "apache,apache-2.0,mit" and row[6] == 1.0
    assert row[7] == ["MIT OR Apache-2.0"] and row[8] == [["apache-2.0", "mit"]]  # two ways to meet one expression


def test_awkward_rows(spark):
    rows = awkward() + [(20, "Released under the MIT License. GNU General Public License"), (21, "SPDX-License-Identifier: (MIT")]
    got = sorted(map(tuple, scan.scan_licenses(docs(spark, rows, clashing=True)).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()), key=str)
    assert got == sorted(((r[0], *brute(r[1])) for r in rows), key=str)
    assert scan.scan_licenses(docs(spark, [])).count() == 0
