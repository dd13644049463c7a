"""Main text of web pages by equivalence-class template deduction.

1. Each page is parsed into elements and text blocks. A token is an element,
   known by its path, or a whole text with its path. Among like siblings a
   container (div, section, nav ...) is told apart by its place and their
   number, so markup without classes, and optional boxes, get roles of their
   own.
2. For each host and token, the occurrence vector over the host's distinct
   pages is folded into a signature (how many pages, how often in all, and the
   XOR of a hash of page and count), which tasks combine before the shuffle.
   Tokens with equal signatures have equal vectors: an equivalence class.
3. Large classes on several pages are checked on all pages: the tokens of a
   valid class stand in one order everywhere, and all have their place inside
   the same other class (or inside their own). Valid classes are thereby
   nested into the host's template.
4. The template cuts each page into slots: what stands between its tokens.
   For each element of the template the host's pages are summed up: how much
   of the enclosing element's text, links and fixed text apart, it holds.
   Fixed text is furniture, and so are slots of links; the article is the
   slot that most of the varying text goes to. From the root, an element that
   holds most of the text of the one around it is entered, and what stands in
   the last one is the main text.
5. Names in the markup (menus, notices, comments ...) take away regions, and
   an article or main element is preferred where the template leaves a choice.

A host with too few pages for a template is judged by the page alone.

No page set of a host is ever gathered: signatures and sums are pre-aggregated
in the tasks, and a host's template is bounded: containers on at least
``MIN_PAGES`` and one in a hundred of its pages, and texts on at least half. Templates reach the pages by a broadcast if they
are small, else by a join on the host.

Parsing is linear in the page's length: every search for an end goes forward
once, and open elements are counted by tag.
"""

from __future__ import annotations

import html as htmllib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from xxhash import xxh64_intdigest

from .components import dropped, saved
from .url_filter import url_host

#: A class is valid from so many tokens on so many of a host's pages.
MIN_CLASS = 3
MIN_PAGES = 3
#: ... and this share of them, so a host may have a hundred layouts, and its
#: template is no longer than a hundred pages' containers.
LEAST = 0.01
#: An element is entered if it holds this share of the text around it; less
#: suffices for an article or main element.
MOST = 0.6
HINTED = 0.2
#: Text on this share of a host's pages is furniture where no element stands out.
FIXED = 0.5
#: Template rows are broadcast up to this many (about 60 bytes each).
BROADCAST_TOKENS = 400_000
#: Entries of a task's table of partial sums before it is passed on.
TABLE = 200_000

#: HTML elements by how they are read.
RAW = frozenset("script style textarea title iframe noembed noframes xmp plaintext".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav "
                   "noscript ol optgroup option p pre search section select summary table tbody template tfoot thead "
                   "tr ul video audio canvas svg object button".split())
SPACED = frozenset("br td th".split())
#: Elements that repeat freely within text; the others are containers.
REPEATED = frozenset("p li dt dd tr h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption caption option hr".split())
#: Elements whose text is never main text.
FURNITURE = frozenset("head nav footer aside form script style textarea title iframe noembed noframes noscript template "
                      "select option button dialog menu svg object canvas video audio search".split())
#: Words in class, id or role that name furniture.
NAMED = re.compile(r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|adbox|adslot|banner|sponsor|sponsored|promo|promotion|cookie|"
                   r"cookies|consent|gdpr|notice|notices|alert|popup|modal|overlay|newsletter|subscribe|signup|nav|navbar|"
                   r"navigation|menu|menus|breadcrumb|breadcrumbs|sidebar|side|aside|widget|footer|header|masthead|topbar|toolbar|"
                   r"comment|comments|commentlist|respond|reply|replies|disqus|discussion|share|sharing|social|related|"
                   r"recommended|pagination|pager|login|search|skip|contentinfo|complementary|dialog)(?:[\s_\d-]|s?$)", re.I)
#: Those of them that name what readers wrote.
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comment|comments|commentlist|respond|reply|replies|disqus|discussion)(?:[\s_\d-]|s?$)", re.I)

_NAME = re.compile(r"[a-zA-Z][^\s/<>]*")
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
_STOP = re.compile(r"[<>\"']")
_RAW_END = {t: re.compile(rf"</{t}\s*>?", re.I) for t in RAW}


def _attrs(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(text)} if "=" in text or "hidden" in text else {}


class _Scanner:
    """Forward searches that never look twice for what is not there."""

    def __init__(self, source: str):
        self.source = source
        self.gone: set[str] = set()
        self.room = 4 * len(source) + 1000

    def find(self, what: str, at: int) -> int:
        if what in self.gone:
            return -1
        k = self.source.find(what, at)
        if k < 0:
            self.gone.add(what)
        return k

    def tag_end(self, at: int) -> int:
        """The place of the ``>`` that ends a tag whose name ends at ``at``
        (-1: none). A quote that is not closed, or a ``<``, ends it early.
        Searches that fail share a budget; beyond it quotes are not heeded."""
        begin = at
        while self.room > 0:
            m = _STOP.search(self.source, at)
            if m is None or m[0] == "<":
                self.room -= (m.start() if m else len(self.source)) - begin
                return -1
            if m[0] == ">":
                return m.start()
            k = self.find(m[0], m.end())
            at = k + 1 if k >= 0 else m.end()
        return self.find(">", begin)


class Element:
    __slots__ = ("tag", "name", "parent", "role", "place", "of", "out", "named", "comments", "article", "kids")

    def __init__(self, tag: str, name: str, parent: int):
        self.tag, self.name, self.parent = tag, name, parent
        self.kids: dict[str, int] = {}
        self.place = 0


def text_token(element: Element, text: str) -> int:
    return xxh64_intdigest(f"{element.role}:{text}") | 1


class Page:
    """One page as elements and text blocks.

    ``elements[0]`` is the page itself. ``blocks``: ``(element, text, linked
    characters, out)``; ``out`` is text in furniture. A name makes no
    furniture of the body, nor of a region that holds more than half of the
    page's text (unless an article stands outside it) or that wraps the article.
    """

    def __init__(self, source: str):
        root = Element("", "", -1)
        root.role, root.of, root.out, root.named, root.comments, root.article = 0, 1, False, False, False, False
        self.elements = [root]
        self.blocks: list[tuple[int, str, int, bool]] = []
        self.order: list[int] = []                # elements, and ~block for blocks, as they begin
        self._parse(source)
        self._roles()
        self._mark()

    def _parse(self, source: str) -> None:
        scan, elements = _Scanner(source), self.elements
        stack, count = [0], {}
        text: list[str] = []
        linked, in_link = 0, 0

        def flush() -> None:
            nonlocal linked
            if text:
                whole = " ".join(htmllib.unescape("".join(text)).split())
                text.clear()
                if whole:
                    self.order.append(~len(self.blocks))
                    self.blocks.append((stack[-1], whole, min(linked, len(whole)), False))
            linked = 0

        def close() -> None:
            flush()
            e = elements[stack.pop()]
            count[e.tag] -= 1

        at, end = 0, len(source)
        while at < end:
            k = scan.find("<", at)
            if k != at:
                stop = k if k >= 0 else end
                text.append(source[at:stop])
                if in_link:
                    linked += stop - at
                at = stop
                continue
            if source.startswith("<!--", at):
                k = scan.find("-->", at + 4)
                at = k + 3 if k >= 0 else end
                continue
            if source.startswith("<![CDATA[", at):
                k = scan.find("]]>", at + 9)
                if k >= 0:
                    text.append(htmllib.escape(source[at + 9:k]))
                    at = k + 3
                    continue
            if source.startswith(("<!", "<?"), at):
                k = scan.find(">", at + 2)
                at = k + 1 if k >= 0 else end
                continue
            closing = source.startswith("</", at)
            m = _NAME.match(source, at + 1 + closing)
            if m is None:
                text.append("&lt;")
                at += 1
                continue
            k = scan.tag_end(m.end())
            attributes = source[m.end():k] if k >= 0 else ""
            at = k + 1 if k >= 0 else m.end()
            tag = m[0].lower()
            if closing:
                if tag in SPACED:
                    text.append(" ")
                elif tag == "a":
                    in_link = max(0, in_link - 1)
                elif tag in BLOCKS:
                    flush()
                    if count.get(tag, 0):
                        while elements[stack[-1]].tag != tag:
                            close()
                        close()
                continue
            if tag in RAW:
                stop = None if f"</{tag}" in scan.gone else _RAW_END[tag].search(source, at)
                if stop is None:
                    scan.gone.add(f"</{tag}")
                at = stop.end() if stop else end
                continue
            if tag in SPACED:
                text.append(" ")
                continue
            if tag == "a":
                in_link += not attributes.rstrip().endswith("/")
            if tag not in BLOCKS:
                continue
            flush()
            top = elements[stack[-1]].tag
            if top == "p" or tag == top and tag in ("li", "dt", "dd", "option", "tr") or top in ("dt", "dd") and tag in ("dt", "dd"):
                close()
            if tag in VOID or attributes.rstrip().endswith("/") and tag == "svg":
                continue
            in_link = 0 if tag not in ("li", "p") else in_link
            self.order.append(len(elements))
            elements.append(self._element(tag, attributes, stack[-1]))
            stack.append(len(elements) - 1)
            count[tag] = count.get(tag, 0) + 1
        while len(stack) > 1:
            close()
        flush()

    def _element(self, tag: str, attributes: str, parent: int) -> Element:
        attrs = _attrs(attributes)
        name = f"{attrs.get('class', '')} {attrs.get('id', '')} {attrs.get('role', '')}".strip() if attrs else ""
        e, around = Element(tag, name, parent), self.elements[parent]
        begins = tag in ("article", "main") or attrs.get("role") in ("main", "article")
        e.out = around.out or tag in FURNITURE or "hidden" in attrs or tag == "header" and not around.article or attrs.get("aria-hidden") == "true"
        e.article = not e.out and (around.article or begins)
        e.named = bool(name) and not begins and not e.out and tag not in ("html", "body") and bool(NAMED.search(name))
        e.comments = e.named and bool(COMMENTS.search(name))
        if tag not in REPEATED:
            key = f"{tag}.{name}"
            around.kids[key] = e.place = around.kids.get(key, 0) + 1
        return e

    def _roles(self) -> None:
        """The hash of each element's path."""
        for e in self.elements[1:]:
            around = self.elements[e.parent]
            of = around.kids.get(f"{e.tag}.{e.name}", 0) if e.place else 0
            e.role = xxh64_intdigest(f"{around.role}/{e.tag}.{e.name}#{e.place}/{of}") & ~1

    def _mark(self) -> None:
        """Mark the blocks in named regions that are furniture."""
        n = len(self.elements)
        if not any(e.named for e in self.elements):
            self.blocks = [(k, t, x, self.elements[k].out) for k, t, x, _ in self.blocks]
            return
        size, article = [0] * n, [0] * n
        for k, text, _, _ in self.blocks:
            e = self.elements[k]
            if not e.out:
                size[k] += len(text)
                article[k] += len(text) if e.article else 0
        for k in range(n - 1, 0, -1):
            p = self.elements[k].parent
            size[p] += size[k]
            article[p] += article[k]
        away = [False] * n
        for k in range(1, n):
            e = self.elements[k]
            away[k] = away[e.parent]
            if e.named and not away[k]:
                within = self.elements[e.parent].article
                wraps = article[k] and not within and not e.comments
                away[k] = bool(not wraps and (2 * size[k] <= size[0] or (e.comments or not within) and article[0] > article[k]))
            if away[k]:
                e.article = False
        self.blocks = [(k, t, x, self.elements[k].out or away[k]) for k, t, x, _ in self.blocks]

    def tokens(self) -> Iterator[int]:
        """The tokens in page order: containers (even) and texts (odd)."""
        for k in self.order:
            if k < 0:
                yield text_token(self.elements[self.blocks[~k][0]], self.blocks[~k][1])
            elif self.elements[k].place:
                yield self.elements[k].role


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


class _Sums:
    """A task's table of partial sums by (host, token)."""

    def __init__(self, names: list[str], xor: tuple[int, ...] = ()):
        self.names, self.xor = names, xor
        self.table: dict[tuple[str, int], list[int]] = {}

    def add(self, host: str, token: int, *values: int) -> None:
        v = self.table.get((host, token))
        if v is None:
            self.table[host, token] = list(values)
        else:
            for i, x in enumerate(values):
                v[i] = v[i] ^ x if i in self.xor else v[i] + x

    def rows(self) -> pa.RecordBatch:
        cols = list(zip(*[(h, _signed(t), *[_signed(x) if i in self.xor else x for i, x in enumerate(v)])
                          for (h, t), v in self.table.items()])) or [()] * (2 + len(self.names))
        types = [pa.string()] + [pa.int64()] * (1 + len(self.names))
        self.table.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["host", "token", *self.names])


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial signatures: pages, sum and XOR of the vector, sum of first places."""
    sums = _Sums(["pages", "total", "vector", "places"], xor=(2,))
    for b in batches:
        for host, key, source in zip(*b.columns):
            host, key = host.as_py(), key.as_py()
            counts: dict[int, int] = {}
            first: dict[int, int] = {}
            for i, t in enumerate(Page(source.as_py() or "").tokens()):
                counts[t] = counts.get(t, 0) + 1
                first.setdefault(t, i)
            sums.add(host, 0, 1, 1, 0, 0)               # token 0 counts the pages
            for t, n in counts.items():
                sums.add(host, t, 1, n, xxh64_intdigest(f"{key}:{n}"), first[t])
            if len(sums.table) >= TABLE:
                yield sums.rows()
    yield sums.rows()


def page_shares(page: Page, once: dict[int, int], fixed: set[int]) -> list[tuple[int, int, int, int]]:
    """``(element, element around, text, text around)`` for the page and each
    of its elements whose role is in ``once``: the lengths of text that varies
    and is no link or furniture, in it and in the nearest such element around."""
    own = [0] * len(page.elements)
    for k, text, linked, out in page.blocks:
        if not out and 2 * linked <= len(text) and (not fixed or text_token(page.elements[k], text) not in fixed):
            own[k] += len(text)
    for k in range(len(own) - 1, 0, -1):
        own[page.elements[k].parent] += own[k]
    around = [0] * len(own)                              # the nearest element around that counts
    out = [(0, -1, own[0], own[0])]
    for k in range(1, len(own)):
        p = page.elements[k].parent
        around[k] = p if p == 0 or page.elements[p].role in once else around[p]
        if page.elements[k].role in once:
            out.append((k, around[k], own[k], own[around[k]]))
    return out


def _checks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each candidate token: how often it stands out of its class's order,
    the pages it was seen on, its parent's class, and its text and the text around."""
    sums = _Sums(["pages", "disorder", "parents", "parent", "held", "around"])
    known = _ByHost(lambda tokens: {t["token"] & ((1 << 64) - 1): t for t in tokens})
    for b in batches:
        for host, source, tokens in zip(*b.columns):
            host = host.as_py()
            of = known.get(host, tokens)
            if not of:
                continue
            page = Page(source.as_py() or "")
            last: dict[int, int] = {}
            for t in page.tokens():
                c = of.get(t)
                if c is not None and c["once"]:
                    if c["rank"] < last.get(c["klass"], -1):
                        sums.add(host, t, 0, 1, 0, 0, 0, 0)
                    last[c["klass"]] = max(c["rank"], last.get(c["klass"], -1))
            once = {t: 1 for t, c in of.items() if c["once"] and not t & 1}
            fixed = {t for t, c in of.items() if t & 1}
            for k, p, held, around in page_shares(page, once, fixed):
                if k:
                    e = page.elements[k]
                    mine, theirs = of[e.role]["klass"], of[page.elements[p].role]["klass"] if p else 0
                    outer = theirs if theirs != mine else 0   # the class around this one, if it is another
                    sums.add(host, e.role, 1, 0, 1 if outer else 0, outer & 0x7FFFFFFF, held, around)
            if len(sums.table) >= TABLE:
                yield sums.rows()
    yield sums.rows()


class _ByHost:
    """What a task has made of the lists of the hosts it met last."""

    def __init__(self, make, hosts: int = 64):
        self.make, self.hosts, self.kept = make, hosts, {}

    def get(self, host: str, tokens):
        if host not in self.kept:
            if len(self.kept) >= self.hosts:
                self.kept.clear()
            self.kept[host] = self.make(tokens.as_py() or [])
        return self.kept[host]


def _one_each(pages: DataFrame) -> DataFrame:
    return pages.groupBy("host", "key").agg(F.first("html").alias("html"))


def _lists(rows: DataFrame, *names: str) -> DataFrame:
    """One row a host: its rows as a list of structs."""
    return rows.groupBy(F.col("host").alias("__h")).agg(F.collect_list(F.struct(*names)).alias("tokens"))


def _with_lists(pages: DataFrame, rows: DataFrame, *names: str) -> DataFrame:
    lists = _lists(rows, *names)
    small = rows.count() <= BROADCAST_TOKENS
    return pages.join(F.broadcast(lists) if small else lists, F.col("host") == F.col("__h"), "left").drop("__h")


def deduce_templates(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """``(host, token, once, fixed, share)``: the tokens of each host's valid
    classes, as a saved table.

    ``pages(host, html)``. Copies of a page count once. Containers that stand
    once a page (``once``) on enough pages, and texts (and other containers)
    on at least half of them (``fixed``); ``share``: how much of the text of the element around
    it an element holds, over all its pages (null for texts).
    """
    longs = lambda *names: [StructField(n, LongType()) for n in names]
    distinct = pages.groupBy("host", F.xxhash64(F.coalesce("html", F.lit(""))).alias("key")).agg(F.count("*").alias("copies"))
    copies = saved(spark, distinct.where("copies > 1").select("host", "key"), "copies")
    keyed = pages.select("host", F.xxhash64(F.coalesce("html", F.lit(""))).alias("key"), "html")
    # Pages with copies are parsed once: only these few are shuffled.
    known = F.broadcast(copies) if copies.count() <= BROADCAST_TOKENS else copies
    unique = keyed.join(known, ["host", "key"], "left_anti").unionByName(_one_each(keyed.join(known, ["host", "key"], "left_semi")))
    shape = StructType([StructField("host", StringType()), *longs("token", "pages", "total", "vector", "places")])
    found = unique.mapInArrow(_signatures, shape).groupBy("host", "token").agg(
        F.sum("pages").alias("pages"), F.sum("total").alias("total"), F.bit_xor("vector").alias("vector"), F.sum("places").alias("places"))
    found = saved(spark, found.where(f"pages >= {MIN_PAGES}"), "signatures")
    size = found.where("token = 0").select("host", F.col("pages").alias("host_pages"))
    support = F.greatest(F.lit(float(MIN_PAGES)), F.col("host_pages") * LEAST)
    tokens = found.where("token <> 0").join(size, "host").where(F.col("pages") >= support)
    classes = tokens.groupBy("host", "vector", "pages", "total").agg(F.count("*").alias("size")).where(F.col("size") >= MIN_CLASS)
    # The order of a class: by mean place, which is the same pages for all its tokens.
    rank = (F.col("places") * 2 / F.col("pages")).cast("long")
    large = tokens.join(classes.drop("size"), ["host", "vector", "pages", "total"]).select(
        "host", "token", (F.col("pages") == F.col("total")).alias("once"), (F.col("pages") >= FIXED * F.col("host_pages")).alias("fixed"),
        F.xxhash64("vector", "pages", "total").alias("klass"), rank.alias("rank"))
    # Texts that fewer pages share are theirs (lines of copied articles, say), not the template's.
    container = F.col("token").bitwiseAND(F.lit(1)) == 0
    large = saved(spark, large.where(F.col("fixed") | F.col("once") & container), "classes")
    dropped(spark, found)

    shape = StructType([StructField("host", StringType()), *longs("token", "pages", "disorder", "parents", "parent", "held", "around")])
    looked = _with_lists(unique, large, "token", "once", "fixed", "klass", "rank").select("host", "html", "tokens").mapInArrow(_checks, shape)
    checked = saved(spark, looked.groupBy("host", "token").agg(*[F.sum(n).alias(n) for n in shape.names[2:]]), "checks")
    joined = large.join(checked, ["host", "token"], "left")
    # A class is nested if its outermost tokens stand in one other class: their
    # sums of parents are those of one parent.
    outer = joined.where("parents > 0").withColumn("inside", F.col("parent") / F.col("parents"))
    nested = (outer.groupBy("host", "klass").agg(F.min("inside").alias("lo"), F.max("inside").alias("hi"))
              .where(F.abs(F.col("hi") - F.col("lo")) > F.abs(F.col("hi")) * 1e-9).select("host", "klass"))
    disordered = joined.groupBy("host", "klass").agg(F.sum("disorder").alias("d")).where("d > 0").select("host", "klass")
    valid = joined.join(nested.union(disordered).distinct(), ["host", "klass"], "left_anti")
    share = F.when(F.col("around") > 0, F.col("held") / F.col("around"))
    out = saved(spark, valid.select("host", "token", "once", "fixed", share.alias("share")), "templates")
    dropped(spark, copies, large, checked)
    return out


def extract(source: str | None, template: dict[int, float | None], fixed: set[int]) -> str:
    """The main text of one page under its host's template.

    ``template``: role of each element that stands once a page -> its share of
    the text around it (over the host's pages); ``fixed``: the template's
    texts. Both may be empty (an unknown host): then the page's own shares
    decide, over all its containers.
    """
    page = Page(source or "")
    elements = page.elements
    known = bool(template)
    once = template if known else {e.role: None for e in elements[1:] if e.place}
    shares = page_shares(page, once, fixed)
    kids: dict[int, list[tuple[float, int]]] = {}
    for k, p, held, around in shares[1:]:
        share = template.get(elements[k].role) if known else None
        if share is None:
            share = held / around if around else 0.0
        kids.setdefault(p, []).append((share, -k))
    at = 0
    while at in kids:
        share, k = max(kids[at])
        hinted = [(s, x) for s, x in kids[at] if elements[-x].article and not elements[at].article and (s >= HINTED or not known and s > 0)]
        if hinted and (share < MOST or not known):
            share, k = max(hinted)
            share = MOST
        if share < MOST:
            break
        at = -k
    # An article or main element around or inside the slot is its better border.
    articles = [k for k, e in enumerate(elements) if e.article and not elements[e.parent].article]
    inside = [False] * len(elements)
    inside[at] = True
    for k in range(at + 1, len(elements)):
        inside[k] = inside[elements[k].parent]
    held = [k for k in articles if inside[k]]
    top = at
    while top and elements[top].article and elements[elements[top].parent].article:
        top = elements[top].parent
    main = {top} if elements[top].article and top else set(held) or {at}
    chosen = [False] * len(elements)
    for k in range(len(elements)):
        chosen[k] = k in main or k > 0 and chosen[elements[k].parent]
    named = any(elements[k].article for k in main)
    out = []
    for k, text, linked, away in page.blocks:
        if not chosen[k] or away:
            continue
        # Outside an article, text that the host's pages share and lists of links are furniture.
        if not named and (at == 0 or elements[at].tag in ("html", "body")) and (
                2 * linked > len(text) or fixed and text_token(elements[k], text) in fixed):
            continue
        out.append(text)
    return "\n".join(out)


def extract_main_text(spark: SparkSession, df: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``df`` without ``html_col``, with ``main_text`` (blocks joined by one
    newline, empty if there is none).

    Character references are decoded, white space inside a block becomes one
    space, and nothing is cut off.

    Defined results: a null page is an empty one; a null URL, or one without
    ``://``, belongs to the host with the empty name; a host with fewer than
    ``MIN_PAGES`` different pages has no template, and each of its pages is
    judged alone; repeated pages each give a row and count once in the
    template; an empty input gives an empty result; very long and hostile
    pages are parsed whole, in linear time; other columns pass through (a
    column named ``main_text`` is replaced).
    """
    kept = [c for c in df.columns if c not in (html_col, "main_text")]
    pages = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{html_col}`").alias("html"),
                      url_host(F.col(f"`{url_col}`")).alias("host"))
    templates = deduce_templates(spark, pages.select("host", "html"))
    out = _with_lists(pages, templates, "token", "once", "fixed", "share").select("row", "host", "html", "tokens")
    row = out.schema["row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(tokens: list[dict]) -> tuple[dict, set]:
            mask = (1 << 64) - 1
            return ({t["token"] & mask: t["share"] for t in tokens if t["once"] and t["share"] is not None},
                    {t["token"] & mask for t in tokens if t["token"] & 1})

        known = _ByHost(made)
        for b in batches:
            texts = [extract(source.as_py(), *known.get(host.as_py(), tokens)) for host, source, tokens in zip(*b.columns[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["row", "main_text"])

    return out.mapInArrow(run, StructType([row, StructField("main_text", StringType())])).select("row.*", "main_text")
