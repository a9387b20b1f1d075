import pytest

from paperloom.llm import template_removal as html
from tests.llm.helpers import sentence

PAGES = "page_id long, url string, html string, text string, host string, key long"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y", 1) for i, u, h in rows], PAGES)


@pytest.mark.parametrize("source, want", [
    (None, ""), ("", ""), ("plain <b>text</b>  here", "plain text here"),
    ("<nav>menu</nav><article><h1> A\n&amp; B </h1><p>one<br>two<p>three <i>x</i>y</article><footer>f</footer>", "A & B\none two\nthree xy"),
    ("<article><p>a</p><div class='ad box'>buy</div><aside>s</aside><form>f</form><p>b", "a\nb"),
    ("<article><p>a</p><section id=comments><article><p>reader</p></article></section></article>", "a"),
    ("<body><script>if (a<b) '</p>'</script><style>p{}</style><p>a<!-- c --> b</p><p>1 < 2 &lt;b&gt; &copy;</p>", "a b\n1 < 2 <b> ©"),
    ("<header>top</header><main><header><h1>T</h1></header><p>x</main>", "T\nx"),
    ("<div hidden>no</div><div role=navigation>no</div><div role='main'>yes</div><p>out", "yes"),
    ("<nav>never closed<article><p>kept</article>", "kept"),
    ("<p>cut <b", "cut"), ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a\nb\nc\nd"),
    ("<p title='a > b'>q</p><p x=\"1>2\" y>r", "q\nr"), ("<ARTICLE><P>Case</P></ARTICLE>", "Case"),
    ("<span class=ad>no <span>x</span></span><p>yes", "yes"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    ("<p>never closed script<script>x = 1;", "never closed script"), ("</p></div>stray", "stray"),
])
def test_text_of_a_page(source, want):
    assert html.Page(source or "").text() == want


def test_words_in_class_names_are_no_marks():
    kept = ["<div class='related-work'>a</div>", "<p class='notice-of-motion'>b</p>", "<section id='comment-on-theorem'>c</section>",
            "<div class='social-science'>d</div>", "<p>e <math><mi>x</mi></math>"]
    gone = [f"<div class='{c}'>no</div>" for c in ("ad", "box ad-box", "site-nav", "cookie-notice", "comment-list", "share-buttons", "sidebar-right", "article-footer", "reader-comments")]
    assert html.Page("<article>" + "".join(kept + gone) + "</article>").text() == "a\nb\nc\nd\ne x"


def brute(rows, min_pages, min_share):
    """Texts of pages of <div>, <p> and text alone, by counting subtrees as they are written."""
    import collections
    import re

    def subtrees(source):
        out, stack = [], []
        for m in re.finditer(r"<(/?)(div|p)>", source):
            if not m[1]:
                stack.append(m.start())
            else:
                out.append(source[stack.pop(): m.end()])
        return out

    hosts, counts = collections.defaultdict(set), collections.defaultdict(set)
    text = lambda source: [x for x in re.split(r"</?(?:div|p)>", source) if x]
    for _, url, source in rows:
        host = url.split("/")[2]
        hosts[host].add(tuple(text(source)))
        for tree in subtrees(source):
            counts[host, tree].add(tuple(text(source)))
    out = {}
    for key, url, source in rows:
        host = url.split("/")[2]
        gone = {tree for tree in subtrees(source) if len(counts[host, tree]) >= min_pages and (
            tree.startswith("<div>") or len(counts[host, tree]) >= min_share * len(hosts[host]))}
        for tree in sorted(gone, key=len, reverse=True):
            source = source.replace(tree, "<p></p>")
        out[key] = "\n".join(text(source))
    return out


def test_counts_against_brute_force(spark):
    """Pages that declare no article, made of a few shared subtrees: what goes is what is counted."""
    import random

    rng = random.Random(11)
    rows = []
    for k in range(240):
        host = rng.choice("abbbcccccc")
        parts = [f"<p>own {k} {j}</p>" for j in range(rng.randrange(1, 4))]
        for j in range(12):
            if rng.random() < (j + 1) / 30:
                parts.insert(rng.randrange(len(parts) + 1), f"<p>line {j}</p>" if j % 2 else f"<div><p>box {j}</p><div><p>in {j}</p></div></div>")
        rows.append((k, f"http://{host}.org/{k}", "".join(parts)))
    got = {r.page_id: r.text for r in html.main_texts(pages(spark, rows)).collect()}
    want = brute(rows, html.MIN_PAGES, html.MIN_SHARE)
    assert got == want
    lines = [t for text in want.values() for t in text.split("\n")]
    assert any(t.startswith("line") for t in lines) and not any(t == "box 10" for t in lines)


def test_a_stock_sentence_on_a_few_pages_stays(spark):
    rows = [(k, f"http://a.org/{k}", f"<p>story {k}</p>" + ("<p>He was never seen again.</p>" if k < 9 else "")) for k in range(200)]
    out = {r.page_id: r.text for r in html.main_texts(pages(spark, rows)).collect()}
    assert all(out[k] == f"story {k}\nHe was never seen again." for k in range(9))


def test_recurring_subtrees_go(spark):
    import random

    rng = random.Random(2)
    rows = []
    for k in range(30):
        own = f"<p>{sentence(rng, 10)} {k}</p>"
        rows.append((k, f"http://a.org/{k}", f"<body><div><p>Welcome to our site</p><p>Call us</p></div>{own}<p>said once in a while</p></body>"
                     if k < 20 else f"<body><div><p>Welcome to our site</p><p>Call us</p></div>{own}</body>"))
    rows += [(100 + k, "http://b.org/", "<div><p>Welcome to our site</p></div><p>copied article</p>") for k in range(30)]
    rows += [(200 + k, f"http://c.org/{k}", f"<article><p>quoted line</p><p>{k}</p></article>") for k in range(30)]
    out = {r.page_id: r.text for r in html.main_texts(pages(spark, rows)).collect()}
    assert len(out) == 90
    assert all("Welcome" not in out[k] and "Call us" not in out[k] and out[k] for k in range(30))
    assert {out[100 + k] for k in range(30)} == {"Welcome to our site\ncopied article"}  # copies are one page
    assert all(out[200 + k] == f"quoted line\n{k}" for k in range(30))  # a declared article keeps what it quotes


def test_a_large_host_keeps_no_template(spark):
    """A notice on 12 of 200 pages of a host goes, in an article or not; wrappers never take the article along."""
    rows = []
    for k in range(200):
        notice = "<div><p>Members only</p><ul><li>Join</ul></div>" if k < 12 else ""
        own = f"<div><section><p>text {k}</p></section></div><p>quoted line</p>"
        rows.append((k, f"http://a.org/{k}", f"<div><main>{own}{notice}</main></div>" if k % 2 else f"{notice}<div><p>text {k}</p></div>"))
    rows += [(300 + k, f"http://b.org/{k}", f"<title>{k}</title><i>{k}</i><article><div><p>copied</p></div></article>") for k in range(9)]
    out = {r.page_id: r.text for r in html.main_texts(pages(spark, rows)).collect()}
    assert all(out[k] == (f"text {k}\nquoted line" if k % 2 else f"text {k}") for k in range(200))
    assert {out[300 + k] for k in range(9)} == {"copied"}


def test_awkward_rows(spark):
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    rows = [(1, None, "<p>a"), (None, "no url", None), (2, "http://H.org:80/x", "<p>a"), (2, "http://H.org:80/x", "<p>a"), (3, "http://h.org", deep),
            (4, "http://h.org", "<article>" + "<p>long text " * 20_000), (5, "http://h.org", "<" * 20_000), (6, "http://h.org", "<a '" * 5_000)]
    out = html.main_texts(pages(spark, rows)).collect()
    assert len(out) == len(rows)
    assert {r.page_id: r.text for r in out}[3] == "x" and [r.text for r in out if r.page_id == 2] == ["a", "a"]
    assert html.main_texts(pages(spark, [])).count() == 0
