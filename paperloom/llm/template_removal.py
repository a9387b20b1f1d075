"""Main text of web pages: site template removal on hashed element subtrees.

A page is read once into blocks of text and the elements that hold them.  Every block element outside a declared
article, and every structural container (`div`, `section`, lists, tables) inside one, gets a hash of the tags and texts of
its subtree; Spark counts in how many different pages of a host each hash occurs.  Containers that occur in `MIN_PAGES` of them
are deleted, however many pages the host has; single paragraphs, headings and the like, which pages may share by chance or
by quoting, only if a share of `MIN_SHARE` of the host's pages holds them as well.  Where the page declares its article (`article`, `main` or role
main), the text is that element without the parts marked as menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles or reader comments, and without recurring containers; a paragraph that many articles quote stays.  Where
it declares none, the text is the body without marked parts and without the recurring subtrees.

Character references are decoded, white space inside a block becomes one blank, blocks are trimmed, empty ones
dropped, and the rest joined in page order by one line feed.  An inline element or a `br` ends no block
(`br` counts as white space).  An element that is never closed hides nothing but scripts and styles; a tag cut
off by the end of the page is no text.

Null or empty html gives an empty text.  A null url is a host of its own.  Pages of the same text count as one page for the
recurrence, so copies of an article never make it a template.  Repeated rows give repeated results; columns
besides id, url and html are not read.  Memory is one batch of pages; hot hosts are counted by partial
aggregation, and only pages whose text lies in counted subtrees are joined with counts.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import staged

# A subtree is template if at least so many different pages of its host hold it, and one that is no container only if
# they are this share of the host's pages.
MIN_PAGES, MIN_SHARE = 5, 0.2

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)(>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([A-Za-z_:][\w:.-]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b", re.S)
_SPLIT = re.compile(r"[^a-z]+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
_DROPPED = frozenset(
    "nav footer aside form script style textarea title noscript template iframe svg button select dialog menu "
    "object canvas head xmp noembed noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead title tr ul caption".split())
# Elements inside an article that may be template.
_CONTAINERS = frozenset("center details div dl ol section table ul".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion menu navbar navigation nav "
    "sidebar breadcrumb breadcrumbs cookie cookies consent gdpr notice notices popup modal newsletter subscribe "
    "comment comments disqus respond replies footer masthead social share sharing related recommended widget login "
    "signup pagination pager".split())
# What else a class name of several words may hold if one of its words is a mark: names of places, forms and numbers.
_LAYOUT = frozenset(
    "area article bar block blog body bottom box btn button buttons col column container content count entry form global group head "
    "header icon icons inner item items js label left line link links list main mobile module news outer page panel post "
    "primary reader readers region right root row secondary section site slot sticky story text title tools top unit user "
    "wrap wrapper".split())
# What a start tag closes, and the elements in which the open one stays.
_CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}


def _marked(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is one of the marked parts, and whether it has role main."""
    if tag in _DROPPED or tag == "header" and not in_article:
        return True, False
    main = False
    if attributes and "=" in attributes or "hidden" in attributes:
        for name, a, b, c, bare in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), (a or b or c).lower()
            if bare or name == "hidden" or name == "aria-hidden" and value == "true":
                return True, False
            if name == "role":
                main = value.strip() == "main"
                if value.strip() in _ROLES:
                    return True, False
            elif name in ("class", "id") and tag not in ("html", "body", "article", "main"):
                if _names_mark(value):
                    return True, False
            elif name in ("class", "id") and tag == "article" and _names_mark(value, frozenset({"comment", "comments", "reply"})):
                return True, False
    return False, main


def _names_mark(value: str, marks=_MARKS) -> bool:
    """Whether a class or id names a marked part: a mark alone, or with words of layout.  `notice-of-motion` does not."""
    for name in value.split():
        words = {w for w in _SPLIT.split(name) if w}
        if words & marks and words <= marks | _LAYOUT:
            return True
    return False


class Page:
    """Blocks of one page, and the elements that may be template.

    texts[i] belongs to element nodes[i]; element n has hash hashes[n] and lies in parents[n] (-1: none).
    If `declared`, the blocks are those of the article; elements outside it serve the count alone.
    """

    def __init__(self, source: str):
        self.hashes, self.parents = [], []
        self.declared = False
        inside, outside, inner, nodes = [], [], [], []
        pieces, stack, open_tags, unclosed = [], [], {}, set()
        hidden = articles = 0
        low = source.lower() if source.isascii() else None

        def flush():
            if not pieces:
                return
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text and not hidden:
                if articles:
                    inside.append(text)
                    inner.append(stack[-1][3])
                    if stack[-1][3] >= 0:
                        stack[-1][4].append(text)
                else:
                    outside.append(text)
                    nodes.append(stack[-1][3] if stack else -1)
                    if stack:
                        stack[-1][4].append(text)

        def pop():
            nonlocal hidden, articles
            tag, hides, root, node, parts, owns = stack.pop()
            open_tags[tag] -= 1
            hidden -= hides
            articles -= root
            if owns:
                digest = xxhash.xxh64_intdigest("\x1f".join([tag, *parts]).encode("utf-8", "replace"))
                self.hashes[node] = (digest & ~1 | (tag in _CONTAINERS)) - (1 << 63)  # odd: a container
                if stack and stack[-1][3] >= 0:
                    stack[-1][4].append(f"\x1e{digest:x}")

        def close(tags, barriers=()):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in tags:
                    while len(stack) > k:
                        pop()
                    return
                if stack[k][0] in barriers:
                    return

        def never_closed(tag, at):
            if tag in unclosed:
                return True
            found = (low.find(f"</{tag}", at) if low is not None
                     else (m.start() if (m := re.compile(f"</{tag}", re.I).search(source, at)) else -1))
            if found < 0:
                unclosed.add(tag)
            return found < 0

        at, end = 0, len(source)
        while at < end:
            opening = source.find("<", at)
            if opening < 0:
                opening = end
            if opening > at:
                text = source[at:opening]
                pieces.append(html.unescape(text) if "&" in text else text)
            if opening == end:
                break
            token = _TOKEN.match(source, opening)
            if token is None:
                pieces.append("<")
                at = opening + 1
                continue
            at = token.end()
            tag = token[2] or token[5]
            if tag is None or token[7] == "":
                continue
            tag, closing = tag.lower(), bool(token[1] or token[4])
            block = tag in _BLOCK
            if block:
                flush()
            elif tag == "br":
                pieces.append(" ")
            if closing:
                if open_tags.get(tag):
                    if hidden:
                        flush()  # what stands in a hidden inline element goes with it
                    close((tag,))
                continue
            attributes = token[3] or token[6] or ""
            if tag in _VOID:
                continue
            if block and open_tags.get("p"):
                close(("p",), ("td", "th", "table", "button"))
            if tag in _CLOSES and any(open_tags.get(x) for x in _CLOSES[tag][0]):
                close(*_CLOSES[tag])
            hides, main = _marked(tag, attributes, articles > 0)
            if tag in _RAW:
                if not never_closed(tag, at):
                    stop = source.find(">", re.compile(f"</{tag}", re.I).search(source, at).end())
                    at = end if stop < 0 else stop + 1
                elif tag in ("script", "style"):
                    at = end
                continue
            if hides and never_closed(tag, at):
                hides = False
            if hides and not block:
                flush()
            root = not hidden and not hides and (tag in ("article", "main") or main)
            self.declared |= root
            if not (block or hides or hidden):
                continue  # an inline element neither ends a block nor hides anything
            node, parts, owns = -1, [], False
            if not (hidden or hides):
                if block and (tag in _CONTAINERS and not root if articles else not root):
                    node, owns = len(self.hashes), True
                    self.hashes.append(0)
                    self.parents.append(stack[-1][3] if stack else -1)
                elif articles:  # what it holds belongs to the container around it, if there is one in the article
                    node, parts = stack[-1][3], stack[-1][4]
                    if node >= 0:
                        parts.append(f"\x1d{tag}")
            stack.append([tag, int(hides), int(root), node, parts, owns])
            open_tags[tag] = open_tags.get(tag, 0) + 1
            hidden += hides
            articles += root
        flush()
        while stack:
            pop()
        self.texts, self.nodes = (inside, inner) if self.declared else (outside, nodes)


    def text(self, templates=frozenset()) -> str:
        """The blocks but those below an element whose hash is among `templates`."""
        return joined(self.texts, self.nodes, self.hashes, self.parents, templates)


def joined(texts, nodes, hashes, parents, templates) -> str:
    if not nodes or not templates:
        return "\n".join(texts)
    gone = []
    for own, above in zip(hashes, parents):  # parents come first
        gone.append(own in templates or above >= 0 and gone[above])
    return "\n".join(text for text, node in zip(texts, nodes) if node < 0 or not gone[node])


_PARSED = ("declared boolean, texts array<string>, nodes array<int>, hashes array<long>, parents array<int>")


def _parse(batches):
    for batch in batches:
        rows = []
        for source in batch.column(batch.schema.get_field_index("html")).to_pylist():
            page = Page(source or "")
            rows.append((page.declared, page.texts, page.nodes, page.hashes, page.parents))
        made = list(zip(*rows)) if rows else [[], [], [], [], []]
        kinds = (pa.bool_(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()))
        kept = [batch.column(batch.schema.get_field_index(n)) for n in ("page_id", "url", "host", "key")]
        yield pa.RecordBatch.from_arrays(
            [*kept, *(pa.array(list(c), k) for c, k in zip(made, kinds))],
            ["page_id", "url", "host", "key", "declared", "texts", "nodes", "hashes", "parents"])


def _write(batches):
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("texts", "nodes", "hashes", "parents", "templates")]
        out = [joined(t, n, h, p, frozenset(x or ())) for t, n, h, p, x in zip(*columns)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["page_id", "url", "text"])


def host_of(url):
    """Lower-cased host of a url column; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))


def main_texts(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(page_id, url, text) for each row of `pages` (page_id, url, html)."""
    source = F.coalesce(F.col("html").cast("string"), F.lit(""))
    narrow = pages.select("page_id", F.col("url").cast("string").alias("url"), source.alias("html"),
                          host_of(F.col("url").cast("string")).alias("host"), F.xxhash64(source).alias("key"))
    kind = narrow.schema["page_id"].dataType.simpleString()
    parsed = staged(narrow.mapInArrow(_parse, f"page_id {kind}, url string, host string, key long, {_PARSED}"), "pages")
    different = parsed.select("host", F.xxhash64("texts").alias("same"), "hashes")
    frequent = (different.select("host", "same", F.explode("hashes").alias("hash")).distinct()
                .groupBy("host", "hash").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages))
    sizes = different.select("host", "same").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    container = F.pmod("hash", F.lit(2)) == 1
    recurring = (frequent.where(container).select("host", "hash")
                 .unionByName(frequent.where(~container).join(sizes, "host").where(F.col("n") >= min_share * F.col("pages")).select("host", "hash")))
    concerned = F.exists("nodes", lambda n: n >= 0)
    rest = parsed.where(concerned)
    hits = (rest.select("host", "key", F.explode("hashes").alias("hash")).distinct().join(recurring, ["host", "hash"])
            .groupBy("host", "key").agg(F.collect_list("hash").alias("templates")))
    cleaned = (rest.join(hits, ["host", "key"], "left").select("page_id", "url", "texts", "nodes", "hashes", "parents", "templates")
               .mapInArrow(_write, f"page_id {kind}, url string, text string"))
    whole = parsed.where(~concerned).select("page_id", "url", F.array_join("texts", "\n").alias("text"))
    return whole.unionByName(cleaned)
