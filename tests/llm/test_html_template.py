from collections import Counter

import pytest
from lateship.llm.html_template import MIN_CLASS, MIN_PAGES, Page, deduce_templates, extract, extract_main_text

CASES = [
    ("", ""), ("just text", "just text"), ("<p>a<p>b", "a\nb"), ("<article><h1>T</h1><p>x&nbsp;&amp; <b>y</b>\n z<br>w</article><footer>f</footer>", "T\nx & y z w"),
    ("<nav>m</nav><main><p>a</p><aside>s</aside><section class='comments'><p>c</p></section><p>b</p></main>", "a\nb"),
    ("<header>h</header><article><header><h2>t</h2></header>p</article>", "t\np"),
    ("<div class='ad'>x</div><div class=content><p>a</div>", "a"), ("<div id='cookie-notice'>x</div><p>a", "a"),
    ("<div class='page sidebar-left'><article>a</article></div>", "a"), ("<div class='article-comments'><p>x</p></div><p>y</p>", "y"),
    ("<script>var a='</p><p>no';</script><style>p{}</style><p>a", "a"), ("<p>1 < 2 &lt;3&gt; &#233;&#x1F642;", "1 < 2 <3> é🙂"),
    ("<p title='a>b'>c</p>", "c"), ("<!-- <p>no</p> --><p>a", "a"), ("<form><p>x</p></form><p>a</p>", "a"), ("<p>a<script>x", "a"),
    ("<ul><li>a<li>b</ul>", "a\nb"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a b\nc"), ("<article>  </article>", ""), ("<p hidden>x</p>y", "y"),
    ("<div class='header'>x</div><div class='lead adventure'>a</div>", "a"), ("<article><p>a</p><div class='ad'>x</div><p>b</p></article>", "a\nb"),
]


@pytest.mark.parametrize("source,want", CASES)
def test_one_page(source, want):
    assert extract(source, {}, set()) == want


def test_odd_markup_ends():
    for s in ("<p title=\"open>a<p>b", "<", "<<<", "</", "<a" * 3000, "<!--", "<div " + "x='" * 2000, "&#xFFFFFFFF;&bogus;", "<p>" * 5000 + "x"):
        Page(s)
        extract(s, {}, set())
    assert len(extract("<article>" + "<p>word " * 30_000, {}, set()).split("\n")) == 30_000


def plain(i, body):
    return (f"<html><body><div class='box'><span>Site name</span></div><div class='b2'>Top stories</div><div class='c'>{body}</div>"
            f"<div class='d'>Contact us {i % 1}</div><div class='e'>Terms</div></body></html>")


def test_template_text_is_furniture_without_named_regions(spark):
    rows = [(i, f"http://h{i % 2}.example/{i}", plain(i, "".join(f"<p>own {i} {k}</p>" for k in range(i % 4 + 1)))) for i in range(24)]
    rows += [(100, "http://h0.example/0", rows[0][2])] * 30          # copies do not make an article a template
    rows += [(200, "http://single.example/", plain(7, "<p>lone</p>")), (201, None, None), (202, "no url", "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, main_text string").repartition(3)
    got = extract_main_text(spark, df).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"page_id", "url", "main_text"}
    for r in got:
        if r.page_id < 24 or r.page_id == 100:
            i = r.page_id % 100
            assert r.main_text == "\n".join(f"own {i} {k}" for k in range(i % 4 + 1))
        elif r.page_id == 200:
            assert "lone" in r.main_text.split("\n")
        else:
            assert r.main_text == ""


def brute_template(sources):
    """Tokens of the valid classes of one host, from whole occurrence vectors."""
    pages = [list(Page(x).tokens()) for x in dict.fromkeys(sources)]
    vectors = {t: tuple(p.count(t) for p in pages) for p in pages for t in p}
    classes = {}
    for t, v in vectors.items():
        classes.setdefault(v, set()).add(t)
    valid = set()
    for v, ts in classes.items():
        if len(ts) < MIN_CLASS or sum(x > 0 for x in v) < MIN_PAGES:
            continue
        if max(v) == 1:
            orders = {tuple(t for t in p if t in ts) for p in pages} - {()}
            if len(orders) > 1:
                continue
        fixed = 2 * sum(x > 0 for x in v) >= len(pages)
        valid |= {t for t in ts if fixed or max(v) == 1 and not t & 1}
    return valid, {t for t in valid if max(vectors[t]) == 1}


def test_classes_match_brute_force(spark):
    def page(i):
        boxes = "".join(f"<div class='x{k}'>box {k}</div>" for k in ((0, 1, 2) if i % 2 else (2, 0, 1)))   # never in one order
        return plain(i, "<p>x%d</p>" % i * (i % 3 + 1)) + boxes + ("<ul class='u'><li>one</li><li>two</li></ul>" if i % 4 else "")

    sources = [page(i) for i in range(9)]
    pages = spark.createDataFrame([("h", x) for x in sources + sources[:3]], "host string, html string").repartition(4)
    t = deduce_templates(spark, pages).collect()
    valid, once = brute_template(sources)
    assert {r.token & (2**64 - 1) for r in t} == valid and {r.token & (2**64 - 1) for r in t if r.once} == once
    boxes = [t for t in Page(sources[0]).tokens() if t not in valid]
    assert len(boxes) >= 6      # the boxes and their texts


def neutral(source, names):
    """Markup without names, and its sections as plain boxes."""
    import re
    source = re.sub(r"\s(?:class|id|role)=(?:\"[^\"]*\"|'[^']*'|[^\s>]*)", "", source)
    return re.sub(rf"<(/?)(?:{names})\b", r"<\1div", source)


@pytest.mark.parametrize("names,least", [("article|main", 0.97), ("article|main|nav|footer|header|aside|section", 0.9)])
def test_slots_are_found_without_names(spark, names, least):
    """The template finds the article where neither tags nor classes name it."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html").collect()
    host = Counter(r.url.split("/")[2] for r in rows)
    rows = [r for r in rows if host[r.url.split("/")[2]] >= 4]
    df = spark.createDataFrame([(r.page_id, r.url, neutral(r.html, names)) for r in rows], "page_id long, url string, html string")
    found = {r.page_id: r.main_text for r in extract_main_text(spark, df).collect()}
    want = {r.page_id: extract(r.html, {}, set()) for r in rows}
    right = sum(found[k] == want[k] for k in want)
    alone = sum(extract(neutral(r.html, names), {}, set()) == want[r.page_id] for r in rows)
    assert right >= least * len(rows)
    if "nav" in names:
        assert alone < right                   # without the template the result is another


@pytest.mark.parametrize("unit", ["<![CDATA[", "<div>", "</section>", "<a x='", "<b y=\"z' ", "<", "<!--", "<script>", "<p>x", "<div x=\"a>\">", "</div><div>"])
def test_hostile_markup_takes_linear_time(unit):
    import time
    start = time.monotonic()
    extract("<article>a</article>" + unit * (2_000_000 // len(unit)) + "</p></div>" * 1000 + "'>\"", {}, set())
    assert time.monotonic() - start < 30


def test_empty(spark):
    assert extract_main_text(spark, spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_query_finds_the_articles(spark, sf_dir):
    import html
    import re
    from lateship.llm.queries import QUERIES
    src = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in QUERIES["op9_html_templates"](spark, sf_dir).collect():
        body = re.search(r"<article>(.*?)</article>", src[r.page_id], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", p))).split()) for p in re.split(r"</?(?:p|h1)>", body))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


NAMED_REGIONS = [
    ("<body class='has-sidebar'><p>a</p><p>b</p></body>", "a\nb"),
    ("<body><div class='layout no-sidebar'><p>own text</p><div class='menu'>m</div></div></body>", "own text"),
    ("<div class='post'><p>the post of the page</p></div><div id='comments'><article class='comment-body'>c</article></div>", "the post of the page"),
    ("<article>post</article><div id='comments'><article class='comment-body'>more words than the post</article></div>", "post"),
    ("<main><article>post</article><div id='comments'><article>more words than the post</article></div></main>", "post"),
    ("<div class='with-comments'><article>the post</article></div>", "the post"),
]


@pytest.mark.parametrize("source,want", NAMED_REGIONS)
def test_names_do_not_take_the_page_nor_bring_comments(source, want):
    assert extract(source, {}, set()) == want
