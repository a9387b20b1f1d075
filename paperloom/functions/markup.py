"""Markup to text: a small per-document helper for Arrow workers.

Element trees cannot be walked with SQL functions, so this is the one place
where documents pass through Python.  It only reads one document; resolving and
counting citations over the corpus is done with joins
(`paperloom.operators.markup`).
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, functions as F

from paperloom import constants as C, schemas as S


@dataclass(frozen=True)
class MarkupRules:
    """Which elements hold text, which are dropped, which are replaced."""

    keep: tuple = C.TEXT_ELEMENTS
    fallback: tuple = C.FALLBACK_ELEMENTS
    drop: tuple = C.DROPPED_ELEMENTS
    replace: dict = field(default_factory=lambda: {C.MATH_ELEMENT: f" {C.MATH_WORD} "})
    cite: str = C.CITE_ELEMENT
    html: bool = False


class _HtmlTree(HTMLParser):
    """Feeds tolerant HTML events to a tree builder."""

    VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "wbr"}
    SELF_CLOSING = {"p", "li"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.builder, self.open = ET.TreeBuilder(), ["root"]
        self.builder.start("root", {})

    def handle_starttag(self, tag, attrs):
        if tag in self.SELF_CLOSING and tag in self.open:
            self.handle_endtag(tag)
        self.builder.start(tag, {k: v or "" for k, v in attrs})
        if tag in self.VOID:
            self.builder.end(tag)
        else:
            self.open.append(tag)

    def handle_endtag(self, tag):
        if tag in self.open[1:]:
            while True:
                last = self.open.pop()
                self.builder.end(last)
                if last == tag:
                    return

    def handle_data(self, data):
        self.builder.data(data)

    def tree(self, text):
        self.feed(text)
        self.close()
        while self.open:
            self.builder.end(self.open.pop())
        return self.builder.close()


def parse_tree(text: str, html: bool = False):
    """Element tree with name-space prefixes removed from the tags."""
    if html:
        return _HtmlTree().tree(text)
    # declared encodings do not apply to text that is already decoded
    root = ET.fromstring(re.sub(r"^\s*<\?xml[^>]*\?>", "", text))
    for node in root.iter():
        if isinstance(node.tag, str):
            node.tag = node.tag.rsplit("}", 1)[-1]
    return root


def outermost(root, names):
    """Elements of these names that lie in no other such element."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.tag in names:
            found.append(node)
        else:
            stack.extend(reversed(node))
    return found


def bibliography(root) -> list:
    """(position, key, label) of every item; the label is its `refnum` text."""
    items = []
    for pos, item in enumerate(n for n in root.iter("bibitem")):
        label = next((n for n in item.iter() if n is not item and n.get("role") == "refnum"), None)
        items.append((pos, item.get("key"), None if label is None else "".join(label.itertext())))
    return items


def cite_key(node):
    """Bibliography key of a citation: that of its first reference."""
    ref = next(node.iter("bibref"), None)
    return None if ref is None else ref.get("bibrefs")


def cite_effect(css_class, key, labels) -> tuple:
    """(action, text) of a citation: `keep`, `drop`, or `text` in its place."""
    if css_class == C.PARENTHETICAL_CLASS:
        return "drop", None
    if css_class not in C.TEXTUAL_CLASSES or key is None:
        return "keep", None
    if key not in labels:
        return "drop", None
    label = labels[key]
    if label is None or re.match(C.REFERENCE_NUMBER, label.strip()):
        return "keep", None
    return "text", label


def text_of(node, rules: MarkupRules, labels: dict) -> str:
    """Text below an element, in document order, with the rules applied."""
    out = []

    def walk(element):
        out.append(element.text or "")
        for child in element:
            action, text = "keep", None
            if child.tag in rules.drop or not isinstance(child.tag, str):
                action = "drop"
            elif child.tag in rules.replace:
                action, text = "text", rules.replace[child.tag]
            elif child.tag == rules.cite and child.get("class") is not None:
                action, text = cite_effect(child.get("class"), cite_key(child), labels)
            if action == "keep":
                walk(child)
            elif action == "text":
                out.append(text)
            out.append(child.tail or "")

    walk(node)
    return "".join(out)


def document_facts(text: str, rules: MarkupRules) -> tuple:
    """(text, citations, bibitems, error) of one document."""
    try:
        root = parse_tree(text, rules.html)
        items = bibliography(root)
        labels = {}
        for _, key, label in items:
            labels.setdefault(key, label)
        parts = outermost(root, rules.keep) or outermost(root, rules.fallback)
        cites = [
            (n.get("class"), cite_key(n))
            for part in parts for n in part.iter(rules.cite) if n.get("class") is not None
        ]
        body = "".join(text_of(part, rules, labels) for part in parts)
        return body, [(i, *c) for i, c in enumerate(cites)], items, None
    except Exception as problem:  # one bad document must not stop the job
        return None, [], [], f"{type(problem).__name__}: {problem}"


def markup_facts(xml, rules: MarkupRules = MarkupRules()) -> Column:
    """Struct (text, citations, bibitems, error) of a markup column."""
    @F.pandas_udf(S.MARKUP_FACTS)
    def facts(column: pd.Series) -> pd.DataFrame:
        rows = [document_facts(x, rules) if x is not None else (None, [], [], None) for x in column]
        frame = pd.DataFrame(rows, columns=S.MARKUP_FACTS.names)
        for name, fields in (("citations", ("pos", "class", "key")), ("bibitems", ("pos", "key", "label"))):
            frame[name] = [[dict(zip(fields, item)) for item in items] for items in frame[name]]
        return frame

    return facts(xml)


def markup_text(xml, rules: MarkupRules = MarkupRules()) -> Column:
    """Text of a markup column; null where it cannot be parsed."""
    @F.pandas_udf("string")
    def text(column: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else document_facts(x, rules)[0] for x in column], dtype=object)

    return text(xml)


def abstract_text(xml) -> Column:
    """Text of the abstract below the document root, its first formula removed.

    Null where there is no abstract.  Clean it with
    `paperloom.functions.text.clean_abstract`.
    """
    @F.pandas_udf("string")
    def text(column: pd.Series) -> pd.Series:
        return pd.Series([_abstract(x) for x in column], dtype=object)

    return text(xml)


def _abstract(source):
    if source is None:
        return None
    try:
        root = parse_tree(source)
    except ET.ParseError:
        return None
    found = root.find("abstract")
    if found is None:
        return None
    formula = next(found.iter(C.MATH_ELEMENT), None)
    if formula is not None:  # emptied rather than removed: the text after it stays
        formula.text = None
        formula[:] = []
    return "".join(found.itertext())


def register_markup_function(spark, name: str = "markup_text", rules: MarkupRules = MarkupRules()):
    """Register markup-to-text as a SQL scalar function."""
    @F.pandas_udf("string")
    def text(column: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else document_facts(x, rules)[0] for x in column], dtype=object)

    spark.udf.register(name, text)
    return text
