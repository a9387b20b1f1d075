"""License scan: notice phrases and identifier tags by Aho-Corasick, licence expressions by a shunting yard.

Every document is reduced to its words (A-Z lower-cased, see `WORDS`).  One automaton over the words, joined by
single blanks, finds all notice phrases and all `SPDX-License-Identifier` tags in one pass.  The expression after
a tag is read from the raw text and evaluated: `with` binds closest, then `and`, then `or`, and the value is the
list of alternatives, each a set of licences that apply together.  Exceptions joined by `or` give an alternative each,
those joined by `and` are one name.

Null or empty text has no words and gives zero counts, null places and empty label strings.  Each row stands for
itself, so repeated rows give repeated results.  Columns besides the id and the text are not read.  Work is a
single scan without a shuffle, so hot sources cost nothing extra; memory is one Arrow batch, or one document.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

# Base phrases of the query contract and their labels (fixed values).
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further notice phrases that this operator knows, and what they suggest.
FURTHER = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "released into the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"
WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_TAG_TEXT = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]*)", re.I | re.A)
_PIECE = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.+:-]*")
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}
# Alternatives kept for one expression; an expression of the public list has a handful.  Beyond it the text of
# the expression is reported with the licences it names, without alternatives.
MOST_ALTERNATIVES = 256


def to_postfix(text: str) -> list[str]:
    """Postfix order of the longest well-formed licence expression that `text` begins with; [] if there is none."""
    output, stack, value_next, best = [], [], True, []
    for piece in _PIECE.findall(text):
        word = piece.lower()
        if value_next:
            if word == "(":
                stack.append(word)
            elif word == ")" or word in _PRECEDENCE:
                break
            else:
                output.append(word)
                value_next = False
        elif word in _PRECEDENCE:
            while stack and stack[-1] != "(" and _PRECEDENCE[stack[-1]] >= _PRECEDENCE[word]:
                output.append(stack.pop())
            stack.append(word)
            value_next = True
        elif word == ")":
            while stack and stack[-1] != "(":
                output.append(stack.pop())
            if not stack:
                break
            stack.pop()
        else:
            break
        if not value_next and "(" not in stack:
            best = output + stack[::-1]
    return best


def alternatives(postfix: list[str]) -> list[tuple[str, ...]]:
    """Sets of licences, any one of which satisfies the expression."""
    stack: list[set[frozenset[str]]] = []
    for item in postfix:
        if item not in _PRECEDENCE:
            stack.append({frozenset([item])})
            continue
        right, left = stack.pop(), stack.pop()
        if item == "or":
            stack.append(left | right)
        elif item == "and":
            stack.append({x | y for x in left for y in right})
        else:
            added = {"-and-".join(sorted(names)) for names in right}
            stack.append({frozenset(f"{x}-with-{names}" for x in one) for one in left for names in added})
        if len(stack[-1]) > MOST_ALTERNATIVES:
            return []
    return sorted(tuple(sorted(one)) for one in stack.pop()) if stack else []


def automaton() -> ahocorasick.Automaton:
    """Phrases stand between blanks, so that only whole words match."""
    made = ahocorasick.Automaton()
    for phrase, label in BASE.items():
        made.add_word(f" {phrase} ", (phrase.count(" ") + 1, label, True))
    for phrase, label in FURTHER.items():
        made.add_word(f" {phrase} ", (phrase.count(" ") + 1, label, False))
    made.add_word(f" {TAG} ", (3, "", False))
    made.make_automaton()
    return made


def scan_text(text: str | None, machine: ahocorasick.Automaton) -> tuple:
    """(n_words, n_base, first, last, base labels, labels, score, tags, alternatives)."""
    words = WORDS.findall((text or "").encode("utf-8", "replace").lower())
    joined = " " + b" ".join(words).decode("utf-8", "replace") + " "
    base, places, labels, tags, tagged = set(), [], set(), [], False
    done, blanks = 0, 0  # characters looked at, and blanks among them
    for end, (length, label, is_base) in machine.iter(joined):
        if is_base:
            blanks += joined.count(" ", done, end + 1)
            done = end + 1
            places.append(blanks - 1 - length)
            base.add(label)
        if label:
            labels.add(label)
        else:
            tagged = True
    choices = []
    if tagged:
        for found in _TAG_TEXT.finditer(text):
            postfix = to_postfix(found[1])
            if postfix:
                tags.append(found[1].strip())
                ways = alternatives(postfix)
                choices.append([" ".join(way) for way in ways])
                labels.update(x for way in ways for x in way)
                if not ways:
                    labels.update(x for x in postfix if x not in _PRECEDENCE)
    labels |= base
    score = 1.0 if tags else 0.9 if base else 0.6 if labels else 0.0
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), score, tags, choices)


_FIELDS = [
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("expressions", pa.list_(pa.string())), ("alternatives", pa.list_(pa.list_(pa.string()))),
]


def scan_licenses(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of `docs`: word count, phrase places, labels, expressions and their alternatives.

    `score` is 1 with an identifier tag, 0.9 with a base phrase, 0.6 with another notice phrase, else 0.
    """
    narrow = docs.select(docs[id_column].alias("doc_id"), docs[text_column].cast("string").alias("text"))

    def scan(batches):
        machine = automaton()
        for batch in batches:
            rows = [scan_text(text, machine) for text in batch.column(1).to_pylist()]
            columns = list(zip(*rows)) if rows else [[] for _ in _FIELDS]
            arrays = [pa.array(list(values), kind) for values, (_, kind) in zip(columns, _FIELDS)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", *(n for n, _ in _FIELDS)])

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(
        scan, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, expressions array<string>, alternatives array<array<string>>")
