"""Main text of web pages with a site style tree (Yi, Liu and Li, 2003).

The DOMs of a host's pages are merged by the path of tags and classes. A node's
presentation importance is the entropy, over the pages that have it, of the
sequence of its children; its content importance is one minus the mean entropy
of the texts below it over the pages, less the share of its text that is links.
A branch that looks alike and says the same on all pages, or only links on - a
menu, a notice - has both near 0 and is cut out of every page. A few pages are
weak evidence: each node counts as if ``PRIOR_PAGES`` more had found it
important. Elements whose tag or role is page furniture have importance 0 on any
host. A class or id that names furniture, and a form, only speak against an
element: it stays if it holds most of its article's or page's text.

The tree is only counts by (host, path), built by grouped aggregation; no host's
pages come together in a task. Copies of a page count as one page: its texts say
the same because it is there again, not because the site repeats them. A page's
text is then read in its own task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.llm.common import Cuts, spare_name

PRIOR_PAGES = 2
CONTENT_WEIGHT = 0.5
LOW, LOW_IN_ARTICLE = 0.25, 0.1
DEPTH = 48
IN_ARTICLE = r"/(article|main)(\.[^/]*)?(/|$)"
#: Text outside articles wins if it is this many times as long; comments stay if they are this part of a page.
OUTWEIGHS, WHOLE_PAGE = 3, 0.9

# HTML element names by their part in the page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul caption".split())
HOLDERS = set("article body center div main section table tbody td th tr".split())
ENDS_P = BLOCKS - set("body html td th tr tbody thead tfoot caption".split())
FURNITURE = set(
    "head title script style noscript template nav footer aside button select option textarea input iframe "
    "svg math object canvas audio video map menu dialog datalist".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
# Words in class or id that name page furniture.
NAMES = set(
    "ad ads adbox adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies copyright disqus footer gdpr login masthead menu menus modal nav navbar navigation "
    "newsletter notice notices pager pagination popup promo promos promotion recommended related replies reply search "
    "share sharing sidebar sidebars signup skip social sponsor sponsored subscribe subscription toolbar topbar "
    "widget widgets".split())
HEADERS = set("header headers pageheader siteheader".split())
COMMENTS = set("comment comments reply replies".split())
#: An open element of the left kind ends when one of the right kind begins.
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
             "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
             "option": {"option"}}
#: An end tag or an implied end looks for its element no further up than here.
SCOPES = set("html body table td th article main section div nav aside footer header form ul ol dl".split())
#: By a tag that begins: the elements it ends and how far up they are looked for.
CLOSES = {tag: [(o, SCOPES - {"td", "th"} if o == "tr" else SCOPES - {o}) for o, by in CLOSED_BY.items() if tag in by]
          for tag in set().union(*CLOSED_BY.values())}
SPACE = re.compile(r"\s+")
UNFINISHED = re.compile(r"<[a-zA-Z/][^<>]*$")
NAME_PARTS = re.compile(r"[a-z]+|[0-9]+")


STAYS, NAMED, NAMED_COMMENTS, FURNITURE_ITSELF = range(4)


class Node:
    """An open element. ``named``: the innermost element at or above it whose
    name speaks against it, ``above``: that element's next one further up;
    ``article``: the outermost article round it. ``chars`` and ``inner``: text
    outside links below a named element or article, and its part in articles."""

    __slots__ = ("tag", "path", "depth", "furniture", "in_article", "in_main", "in_link", "children",
                 "named", "above", "article", "comments", "chars", "inner")

    def __init__(self, tag, path, depth, furniture, in_article, in_main, in_link=False):
        self.tag, self.path, self.depth, self.furniture, self.in_link = tag, path, depth, furniture, in_link
        self.in_article, self.in_main, self.children = in_article, in_main, []
        self.named = self.above = self.article = None
        self.comments, self.chars, self.inner = False, 0, 0


def judged(tag: str, attrs: dict[str, str | None], inside: bool) -> int:
    """What tag, role and names say of an element: ``FURNITURE_ITSELF`` has
    importance 0, the named kinds must outweigh their name. ``inside``: within an
    article or main element, where a header is the text's own."""
    if tag in FURNITURE or (tag == "header" and not inside) or "hidden" in attrs:
        return FURNITURE_ITSELF
    if not attrs:
        return NAMED if tag == "form" else STAYS
    if (attrs.get("aria-hidden") or "").lower() == "true" or (attrs.get("role") or "").lower() in ROLES:
        return FURNITURE_ITSELF
    if "display:none" in (attrs.get("style") or "").replace(" ", "").lower():
        return FURNITURE_ITSELF
    if tag in ("html", "body", "main"):
        return STAYS
    names = set(NAME_PARTS.findall(f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower()))
    if names & COMMENTS:
        return FURNITURE_ITSELF if tag == "article" else NAMED_COMMENTS
    if tag == "article":
        return STAYS
    return NAMED if tag == "form" or names & NAMES or (not inside and names & HEADERS) else STAYS


@lru_cache(4096)
def path_name(tag: str, classes: str | None) -> str:
    """An element's part of its path: tag and classes, long lists of them as a hash."""
    names = ".".join(sorted(set((classes or "").split()))).replace("/", "|")
    if len(names) > 80:
        names = f"{xxhash.xxh64_hexdigest(names)}"
    return f"{tag}.{names}" if names else tag


class Page(HTMLParser):
    """One page as blocks of text ``(node, text)`` in page order, the length of
    each one's text outside links, and the children of every path for the style
    tree."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        root = Node("", "", 0, False, False, False)
        self.stack, self.blocks, self.parts, self.at = [root], [], [], root
        self.styles: dict[str, list[Node]] = {}
        self.unlinked, self.plain = [], 0
        if html.rfind("<!--") > html.rfind("-->"):
            html += "-->"  # a comment that never ends
        self.feed(UNFINISHED.sub("", html))
        self.close()
        self.flush()
        self.weigh()

    def weigh(self) -> None:
        """Drop the blocks of named elements that don't outweigh their name: by
        most of their article's text, else by most of the page's and at least
        half of what articles and main elements hold. An element named after
        comments must hold the page's first text, too: it's round the page."""
        if not any(n.named for n, _ in self.blocks):
            return
        total = in_text = 0
        for (n, _), chars in zip(self.blocks, self.unlinked, strict=True):
            inner = chars if n.in_article or n.in_main else 0
            total, in_text, s = total + chars, in_text + inner, n.named
            if n.article:
                n.article.chars += chars
            while s:
                s.chars, s.inner, s = s.chars + chars, s.inner + inner, s.above

        opening, s = [], next((n.named for (n, _), chars in zip(self.blocks, self.unlinked, strict=True) if chars), None)
        while s:
            opening, s = [*opening, s], s.above

        def stays(n: Node) -> bool:
            s = n.named
            while s:
                least = WHOLE_PAGE if s.comments else 0.5
                if s.comments and s not in opening:
                    return False
                if s.chars <= least * (s.article.chars if s.article else total) or 2 * s.inner < (0 if s.article else in_text):
                    return False
                s = s.above
            return True

        kept = [stays(n) for n, _ in self.blocks]
        self.blocks = [x for x, k in zip(self.blocks, kept, strict=True) if k]
        self.unlinked = [x for x, k in zip(self.unlinked, kept, strict=True) if k]

    def flush(self) -> None:
        if not self.parts:
            return
        text = SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            self.blocks.append((self.at, text))
            self.unlinked.append(self.plain)
        self.parts, self.plain = [], 0

    def updatepos(self, i, j):
        return j  # nobody asks for line numbers

    def handle_starttag(self, tag, attrs):
        if tag == "br" and self.parts:
            self.parts.append(" ")
        if tag in BLOCKS:
            self.flush()
        if tag in ENDS_P:
            self.pop_to("p", SCOPES)
        for open_tag, scope in CLOSES.get(tag, ()):
            self.pop_to(open_tag, scope)
        top = self.stack[-1]
        given = dict(attrs)
        kind = judged(tag, given, top.in_article or top.in_main)
        furniture = top.furniture or kind == FURNITURE_ITSELF
        deep = top.depth >= DEPTH  # deeper elements count as part of their ancestor there
        path = top.path if deep else f"{top.path}/{path_name(tag, given.get('class'))}"
        node = Node(tag, path, top.depth + 1, furniture, not furniture and (top.in_article or tag == "article"),
                    not furniture and (top.in_main or tag == "main"), top.in_link or tag == "a")
        node.named, node.article = top.named, top.article or (node if tag == "article" else None)
        if kind in (NAMED, NAMED_COMMENTS):
            node.named, node.above, node.comments = node, top.named, kind == NAMED_COMMENTS
        if not deep:
            name = path[len(top.path):]
            if not top.children or top.children[-1] != name:  # runs count once
                top.children.append(name)
            self.styles.setdefault(path, []).append(node)
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag == "p" and not any(n.tag == "p" for n in self.stack):
            self.flush()
        if tag in BLOCKS:
            self.flush()
            self.pop_to(tag, set())
        else:
            self.pop_to(tag, BLOCKS)

    def pop_to(self, tag: str, scope: set[str]) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                if tag in BLOCKS:
                    self.flush()
                del self.stack[i:]
                return
            if self.stack[i].tag in scope:
                return

    def handle_data(self, data):
        node = self.stack[-1]
        if node.furniture:
            return
        if not self.parts:
            data = data.lstrip()
            if not data:
                return
            self.at = node  # a block belongs to the element of its first words
        self.parts.append(data)
        if not node.in_link:
            self.plain += len(data.strip())

    def handle_comment(self, data):
        pass

    def handle_decl(self, decl):
        pass

    def unknown_decl(self, data):
        pass


def site_counts(pages: DataFrame) -> DataFrame:
    """``host, path, kind, value, weight``, once a page each: that a page has the
    path (kind 0), a sequence of children there (1), a text directly there (2);
    and the length of its texts there (3, value 0 all of it, 1 outside links).
    ``weight`` is 1, or that length, over the page's copies (``pages`` holds ``copies``, null: 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for host, html, copies in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                page, seen = Page(html.as_py() or ""), set()
                for path, nodes in page.styles.items():
                    seen.add((path, 0, 0))
                    seen.update((path, 1, xxhash.xxh64_intdigest(" ".join(n.children)) >> 1) for n in nodes)
                seen.update((n.path, 2, xxhash.xxh64_intdigest(t) >> 1) for n, t in page.blocks)
                rows += [(host, *s, 1.0 / (copies or 1)) for s in seen]
                sizes: dict[str, list[int]] = {}
                for (n, t), plain in zip(page.blocks, page.unlinked, strict=True):
                    both = sizes.setdefault(n.path, [0, 0])
                    both[0], both[1] = both[0] + len(t), both[1] + plain
                rows += [(host, path, 3, v, chars / (copies or 1)) for path, both in sizes.items() for v, chars in enumerate(both)]
            if rows:
                host, path, kind, value, weight = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(host, pa.string()), pa.array(path, pa.string()), pa.array(kind, pa.int32()),
                     pa.array(value, pa.int64()), pa.array(weight, pa.float64())],
                    names=["host", "path", "kind", "value", "weight"])

    return pages.select("host", "html", "copies").mapInArrow(
        run, "host string, path string, kind int, value long, weight double")


def with_copies(sites: DataFrame, cuts: Cuts) -> DataFrame:
    """``host, html, copies``: how often a host has the page, null if once. Only
    hashes are grouped; the pages themselves move if many different ones have copies."""
    sites = sites.withColumn("hash", F.xxhash64("html")).withColumn("bytes", F.octet_length("html"))
    key = ["host", "hash", "bytes"]
    many = cuts.save(sites.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1"))
    return sites.join(many, key, "left").select("host", "html", "copies")


def importance(counts: DataFrame) -> DataFrame:
    """``host, path, pages, importance`` of the style tree's nodes."""
    # the weights of a page's copies add up to one
    n = counts.groupBy("host", "path", "kind", "value").agg(F.round(F.sum("weight")).cast("long").alias("n"))
    # each text also belongs to the nodes above it
    own = n.groupBy("host", "path").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("n"))).alias("pages"),
        F.sum(F.when(F.col("kind") == 1, F.col("n"))).alias("styles"),
        F.sum(F.when(F.col("kind") == 1, F.col("n") * F.log("n"))).alias("style_logs"),
        F.sum(F.when(F.col("kind") == 2, F.log("n"))).alias("text_logs"),
        F.count(F.when(F.col("kind") == 2, 1)).alias("texts"),
        F.sum(F.when((F.col("kind") == 3) & (F.col("value") == 0), F.col("n"))).alias("chars"),
        F.sum(F.when((F.col("kind") == 3) & (F.col("value") == 1), F.col("n"))).alias("plain"))
    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(2), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    spread = own.select("host", F.col("path").alias("leaf"), "pages", "styles", "style_logs", "text_logs", "texts",
                        "chars", "plain", F.explode(above).alias("path"))
    mine = F.col("leaf") == F.col("path")
    tree = spread.groupBy("host", "path").agg(
        F.max(F.when(mine, F.col("pages"))).alias("pages"), F.max(F.when(mine, F.col("styles"))).alias("styles"),
        F.max(F.when(mine, F.col("style_logs"))).alias("style_logs"), F.sum("text_logs").alias("text_logs"),
        F.sum("texts").alias("texts"), F.sum("chars").alias("chars"), F.sum("plain").alias("plain"))
    log_m = F.log(F.greatest(F.col("pages"), F.lit(2)))
    # entropy of children sequences with counts n out of s: log s - sum(n log n) / s, to base m
    look = (F.log("styles") - F.col("style_logs") / F.col("styles")) / log_m
    say = 1 - F.col("text_logs") / (F.col("texts") * log_m)
    between = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(c, F.lit(0.0))))
    # links are a page's own text inside an article only
    own_text = F.when(F.col("path").rlike(IN_ARTICLE) | (F.col("chars") == 0), 1.0).otherwise(F.col("plain") / F.col("chars"))
    found = (1 - CONTENT_WEIGHT) * between(look) + CONTENT_WEIGHT * between(F.when(F.col("texts") > 0, say * own_text))
    return tree.select("host", "path", "pages", F.when(F.col("pages") < 2, 1.0).otherwise(
        (found * F.col("pages") + PRIOR_PAGES) / (F.col("pages") + PRIOR_PAGES)).alias("importance"))


def host_of(url: Column) -> Column:
    """The host of a URL, lower case; '' if there is none."""
    return F.coalesce(F.lower(F.try_parse_url(url, F.lit("HOST"))), F.lit(""))


def main_text(html: str | None, low: set[str]) -> str:
    """The blocks left in a page, without furniture and low branches: those in
    its articles if it has any, else in its main element, else all. The branch
    with most of the page's text isn't cut for being low, unless an article or
    main element is left; where it is ``OUTWEIGHS`` times as long as they are and
    lies outside them, it stays beside them."""
    page = Page(html or "")
    is_low: dict[str, bool] = {}

    def cut(path: str) -> bool:
        if path not in is_low:
            is_low[path] = any(p in low for p in prefixes(path))
        return is_low[path]

    sized = list(zip(page.blocks, page.unlinked, strict=True))
    blocks = [x for x in sized if not cut(x[0][0].path)] if low else sized
    if len(blocks) < len(sized) and not any(n.in_article or n.in_main for (n, _), _ in blocks):
        blocks = without_low(sized, low, not blocks)
    for inside in ("in_article", "in_main"):
        own = [x for x in blocks if getattr(x[0][0], inside)]
        if own:
            rest = [x for x in blocks if not getattr(x[0][0], inside)]
            if sum(c for _, c in rest) > OUTWEIGHS * sum(c for _, c in own):
                branch, at = text_branch(rest)
                under = [x for x in rest if branch and (x[0][0].path + "/").startswith(branch[at] + "/")]
                if branch and sum(c for _, c in under) > OUTWEIGHS * sum(c for _, c in own):
                    stay = {id(x) for x in [*own, *under]}
                    own = [x for x in blocks if id(x) in stay]
            blocks = own
            break
    return "\n\n".join(t for (_, t), _ in blocks)


def text_branch(sized: list[tuple[tuple[Node, str], int]]) -> tuple[list[str], int]:
    """The paths down to the deepest branch with over half of the text outside
    links (a menu's text is links), and the place of the one that holds it:
    paragraphs and lists belong to the element round them. ``[], 0`` if none."""
    size: dict[str, int] = {}
    for (n, _), chars in sized:
        for p in prefixes(n.path):
            size[p] = size.get(p, 0) + chars
    half = sum(chars for _, chars in sized)
    most = [p for p, chars in size.items() if 2 * chars > half]
    if not most:
        return [], 0
    way = list(prefixes(max(most, key=len) + "/"))
    tags = [p.rsplit("/", 1)[1].split(".")[0] for p in way]
    at = len(way) - 1
    while at > 0 and tags[at] not in HOLDERS:
        at -= 1
    if tags[at] not in HOLDERS or tags[at] == "body":
        at = len(way) - 1
    return way, at


def without_low(sized: list[tuple[tuple[Node, str], int]], low: set[str], emptied: bool) -> list[tuple[tuple[Node, str], int]]:
    """The blocks outside low branches, and those of the branch that holds most
    of the page's text outside links. If that branch is low itself, or nothing
    else is left, nothing is cut inside it."""
    way, at = text_branch(sized)
    if not way:
        return [x for x in sized if not any(p in low for p in prefixes(x[0][0].path))]
    whole = way[at] + "/" if emptied or any(p in low for p in way[at:]) else None
    spared = set(way)

    def goes(path: str) -> bool:
        if whole and (path + "/").startswith(whole):
            return False
        return any(p in low and p not in spared for p in prefixes(path))

    return [x for x in sized if not goes(x[0][0].path)]


def prefixes(path: str) -> Iterator[str]:
    at = path.find("/", 1)
    while at > 0:
        yield path[:at]
        at = path.find("/", at + 1)
    yield path


def extract(pages: DataFrame, cuts: Cuts, url_col: str = "url", html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with ``out`` (string): the main text of each page.

    Null and empty pages give ''. Pages without a host (null or odd URL) and
    hosts of one page are cut by tags and names alone. Where most articles of a
    host are copies, nothing is cut inside them, and the branch with most of a
    page's text stays whatever its tag. A column already called ``out`` is
    replaced, all others pass through; one row per input row.
    """
    pages = pages.drop(out)
    sites = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html")).filter("host <> ''")
    tree = cuts.save(importance(site_counts(with_copies(sites, cuts))).filter(F.col("importance") < LOW))
    in_article = F.col("path").rlike(IN_ARTICLE)
    is_article = F.col("path").rlike(r"/(article|main)(\.[^/]*)?$")
    copied = tree.filter(is_article).select("host").distinct()
    low = tree.filter((~in_article & F.col("path").rlike("/body(\\.[^/]*)?/"))
                      | (in_article & ~is_article & (F.col("importance") < LOW_IN_ARTICLE)))
    low = low.join(copied.withColumn("copied", F.lit(True)), "host", "left").filter(
        ~(F.col("copied").isNotNull() & in_article))
    low = cuts.save(low.groupBy("host").agg(F.collect_set("path").alias("low")))  # the few branches a site repeats
    host, paths = spare_name(pages, "site_host_"), spare_name(pages, "low_paths_")
    joined = pages.withColumn(host, host_of(F.col(url_col))).join(
        low.select(F.col("host").alias(host), F.col("low").alias(paths)), host, "left").drop(host)
    schema = T.StructType([*pages.schema.fields, T.StructField(out, T.StringType())])
    html_at, last = pages.columns.index(html_col), len(pages.columns)
    joined = joined.select(*[joined[c] for c in pages.columns], paths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h.as_py(), set(p.as_py() or ()))
                     for h, p in zip(b.column(html_at), b.column(last), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:last], pa.array(texts, pa.string())], names=schema.names)

    return joined.mapInArrow(run, schema)
