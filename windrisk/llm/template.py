"""Main text of web pages by equivalence-class template deduction.

Tokens of a page are its start tags, told apart by their path of tags, classes and ids, and the text runs outside of articles. A token's
occurrence vector holds its count on every page of a host. Vectors are never built: a token's vector is
summed into one 64-bit number, the sum over pages of a hash of page and count, by grouped aggregates that a hot host does not crowd
into one task; pages with equal html count once. Tokens of a host with equal vectors form an equivalence class. A class is valid if
it has at least LEAST_TOKENS tokens on at least LEAST_PAGES pages and on half of the host's pages, with the same count wherever it occurs, and the token
that each of its tokens stands in belongs to a class on at least as many pages; so valid classes nest, and
the nested classes are the host's template. What the template does not fix are its slots.

Extraction: text runs of the template are dropped, other text falls into the slot of the innermost template tag around it. Slots inside
menus, footers, sidebars, notices, adverts, forms, scripts, styles and comments are dropped (by element, role, and landmark names in
class and id), and so are blocks outside of articles that are mostly links. A name counts only whole: each of its words must be a
landmark or a word of position or shape, so `site-footer` is one and `no-sidebar`, `has-comments` and `share-price` are not. If the main element
has text, slots outside of it go; if articles hold at least half of what is left, the rest of it goes. Text inside articles is never taken for template text, so pages
that copy each other keep it. Hosts with few pages have an empty template; their slots are judged in the same way.

Pages are scanned once from front to back, in time linear in their length whatever is left unclosed: a quote opens only after `=` and only if it
is closed further on, and a tag that does not end outside of quotes ends at the next `>`. Elements nested deeper than MAX_DEPTH count as
part of the one around them, as in browsers.

Defined results: NULL or empty html gives an empty text; an empty table gives none. A NULL url has the host of all pages without one. Repeated
rows get equal texts. Unclosed elements end where an enclosing one ends or, for paragraphs and list items, where the next begins. Without
any further `>`, the rest of a page is text. Ties do not occur: slots keep page order.
"""

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrisk.llm.common import stored, table

LEAST_TOKENS, LEAST_PAGES = 3, 3
BROADCAST_TOKENS = 500_000
MAX_DEPTH = 512
MAIN, ARTICLE = 1, 2  # bits of an element's level

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset",
         "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "legend", "li", "main",
         "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
DROPPED = {"aside", "button", "canvas", "dialog", "footer", "form", "head", "iframe", "menu", "nav", "noscript", "object", "option",
           "script", "select", "style", "svg", "template", "textarea", "title"}
RAW = {"script", "style", "textarea", "title", "iframe", "noscript", "template"}
ROLES = {"alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar", "navigation", "search"}
WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
         "consent", "cookie", "cookies", "discussion", "disqus", "footer", "gdpr", "hidden", "login", "menu", "modal", "nav", "navbar", "navigation",
         "newsletter", "notice", "notices", "notification", "overlay", "pager", "pagination", "popup", "promo", "promotion", "recommended",
         "related", "replies", "reply", "search", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe",
         "toolbar", "widget"}
OUTER_WORDS = {"header", "masthead", "topbar"}  # only outside of articles, which have headers of their own
# Words that leave a landmark name one: positions, shapes and sizes.
PLAIN_WORDS = {"", "area", "article", "bar", "block", "bottom", "box", "button", "buttons", "center", "column", "container", "content", "fixed",
               "form", "global", "group", "inner", "item", "items", "left", "link", "links", "list", "main", "mobile", "outer", "page", "panel",
               "post", "posts", "primary", "right", "row", "secondary", "section", "site", "slot", "thread", "top", "unit", "user", "wrap",
               "wrapper"}
CLOSES_P = BLOCK - {"body", "html"}
AGAIN = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
         "option": {"option"}}
LISTS = {"ul", "ol", "dl", "table", "article", "section", "div", "body", "main"}

_OPEN = re.compile(r"<(?:[!?]|(/?)([a-zA-Z][^\s/>]*+))")
_STOP = re.compile(r">|=\s*+([\"'])")
_ATTRIBUTE = re.compile(r"([^\s=/>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?")
_RAW_END = {tag: re.compile(rf"</{tag}\s*+>", re.I) for tag in RAW}
_CUT = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")


class _Element:
    __slots__ = ("tag", "key", "dropped", "level", "link")

    def __init__(self, tag, key, dropped, level, link):
        self.tag, self.key, self.dropped, self.level, self.link = tag, key, dropped, level, link


def _is_dropped(tag: str, attributes: dict, level: int) -> bool:
    if tag in DROPPED or (tag == "header" and level == 0):
        return True
    if attributes.get("role", "").lower() in ROLES or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if tag in ("html", "body", "main"):
        return False
    for name in (n for key in ("class", "id") for n in attributes.get(key, "").split()):
        words = {w.lower() for w in _CUT.split(name)}
        landmarks = words & WORDS if level else words & (WORDS | OUTER_WORDS)
        if landmarks and words - landmarks <= PLAIN_WORDS:
            return True
    return False


class _Scanner:
    """Tags and text runs of a page, in one pass; each kind of missing end is searched for once."""

    def __init__(self, source: str):
        self.source, self.quotes, self.unclosed = source, True, set()

    def tag_end(self, at: int) -> int:
        """Index of the `>` that ends the tag whose name ends at `at`, -1 if the page has no more."""
        source, k = self.source, at
        while self.quotes:
            stop = _STOP.search(source, k)
            if stop is None:
                self.quotes = False
            elif stop.group(1) is None:
                return stop.start()
            else:
                k, quote = stop.end(), stop.group(1)
                end = -1 if quote in self.unclosed else source.find(quote, k)
                if end < 0:
                    self.unclosed.add(quote)
                else:
                    k = end + 1
        return source.find(">", at)

    def parts(self, at: int = 0) -> Iterator[tuple[str, str, str, str, int]]:
        """(text before, "/" of an end tag, tag name, attributes, index after it); the name is empty for comments and at the end.

        The caller may send an index to go on from.
        """
        source, n = self.source, len(self.source)
        while at < n:
            found = _OPEN.search(source, at)
            if found is None:
                break
            start, (close, tag) = found.start(), found.groups()
            if source.startswith("<!--", start):
                end = source.find("-->", start + 4)
                end = n if end < 0 else end + 3
            else:
                end = (source.find(">", start) if tag is None else self.tag_end(found.end())) + 1
                if end == 0:
                    break
            moved = yield source[at:start], close or "", (tag or "").lower(), source[found.end():end - 1] if tag else "", end
            at = end if moved is None else moved
            if moved is not None:
                yield "", "", "", "", at
        if at < n:
            yield source[at:], "", "", "", n


def walk(source: str) -> Iterator[tuple]:
    """("tag", key, parent key) for start tags and ("text", text, element) for text; ("block",) where a block ends."""
    stack = [_Element("", 0, False, 0, False)]
    depths: dict[str, list[int]] = defaultdict(list)  # of the open elements of each tag
    lists = [0]  # depths of open elements that end the search for what a block closes
    parts = _Scanner(source).parts()

    def cut(depth: int) -> None:
        for element in stack[depth:]:
            depths[element.tag].pop()
        while lists[-1] >= depth:
            lists.pop()
        del stack[depth:]

    for text, close, tag, rest, at in parts:
        if text:
            yield "text", text, stack[-1]
        if not tag:
            continue
        if close:
            if tag in BLOCK:
                yield ("block",)
            if depths[tag]:
                cut(depths[tag][-1])
            continue
        if tag in BLOCK:
            yield ("block",)
            ends = AGAIN.get(tag, set()) | ({"p"} if tag in CLOSES_P else set())
            last = max((depths[end][-1] for end in ends if depths[end]), default=0)
            if last > lists[-1]:
                cut(last)
        parent = stack[-1]
        attributes = {}
        if rest and not rest.isspace():
            for attribute, a, b, c in _ATTRIBUTE.findall(rest):
                attributes.setdefault(attribute.lower(), a or b or c)
        name = re.sub(r"\d+", "", attributes.get("id", ""))
        key = xxhash.xxh3_64_intdigest(f"{parent.key}>{tag}.{attributes.get('class', '')}#{name}") >> 1
        yield "tag", key, parent.key
        if tag == "br":
            yield "text", " ", parent
        if tag in VOID or rest.endswith("/"):
            continue
        dropped = parent.dropped or _is_dropped(tag, attributes, parent.level)
        if tag == "body":
            dropped = False
        level = parent.level | (ARTICLE if tag == "article" else MAIN if tag == "main" or attributes.get("role") == "main" else 0)
        element = _Element(tag, key, dropped, level, parent.link or tag == "a")
        if tag in RAW:
            end = _RAW_END[tag].search(source, at)
            parts.send(end.end() if end else len(source))
        elif len(stack) < MAX_DEPTH:
            depths[tag].append(len(stack))
            if tag in LISTS:
                lists.append(len(stack))
            stack.append(element)


def text_key(text: str) -> int:
    return xxhash.xxh3_64_intdigest("text:" + " ".join(text.split())) >> 1


def page_tokens(source: str) -> list[tuple[int, int, int]]:
    """(token, token that it stands in, count) of a page."""
    counts: dict[int, list[int]] = {}
    for item in walk(source):
        if item[0] == "tag":
            counts.setdefault(item[1], [item[2], 0])[1] += 1
        elif item[0] == "text" and item[2].level < ARTICLE and not item[1].isspace():
            counts.setdefault(text_key(item[1]), [item[2].key, 0])[1] += 1
    return [(token, parent, n) for token, (parent, n) in counts.items()]


def extract(source: str, template: frozenset[int] | set[int] = frozenset()) -> list[tuple[int, str]]:
    """(slot, block) of the main text in page order; a slot is the key of the innermost template tag, 0 if there is none."""
    blocks: list[tuple[int, int, str]] = []
    held: list[str] = []
    slot, level, linked, size = 0, 0, 0, 0

    def close():
        nonlocal linked, size
        if held:
            block = " ".join(html.unescape("".join(held)).split())
            if block and (level >= ARTICLE or size == 0 or linked * 10 < size * 7):
                blocks.append((level, slot, block))
            held.clear()
        linked = size = 0

    inner = 0
    for item in walk(source):
        if item[0] == "block":
            close()
        elif item[0] == "tag":
            if item[1] in template:
                inner = item[1]
        elif not item[2].dropped:
            element = item[2]
            if element.level < ARTICLE and template and text_key(item[1]) in template:
                continue
            if held and element.level != level:
                close()
            held.append(item[1])
            slot, level = inner, element.level
            size += len(item[1])
            linked += len(item[1]) * element.link
    close()
    # Of the main element, if it has text; of articles, if they hold half of that or more.
    if any(level & MAIN for level, _, _ in blocks):
        blocks = [b for b in blocks if b[0] & MAIN]
    in_articles = sum(len(block) for level, _, block in blocks if level & ARTICLE)
    if in_articles and 2 * in_articles >= sum(len(block) for _, _, block in blocks):
        blocks = [b for b in blocks if b[0] & ARTICLE]
    return [(slot, block) for _, slot, block in blocks]


def host(url):
    """Host of a url column, lower-cased, without port; empty for NULL and for what is no url."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))


def templates(pages: DataFrame, url_col: str = "url", html_col: str = "html", least_tokens: int = LEAST_TOKENS,
              least_pages: int = LEAST_PAGES) -> DataFrame:
    """One row per token of a host's template: host, token, class (of equal vectors), inside (the class around it), pages."""
    source = pages.where(F.col(html_col).isNotNull()).select(host(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, columns = [], ([], [], [], [])
            for name, page in zip(batch.column("host").to_pylist(), batch.column("html")):
                page = page.as_py()
                digest = xxhash.xxh3_64_intdigest(page) >> 1
                found = page_tokens(page)
                hosts += [name] * len(found)
                for token, parent, n in found:
                    for column, value in zip(columns, (token, parent, n, digest)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), *[pa.array(c, pa.int64()) for c in columns]],
                                             names=["host", "token", "parent", "n", "page"])

    # Equal pages count once: the first grouping folds them, in the tasks as well.
    seen = source.mapInArrow(tokens, "host string, token long, parent long, n long, page long").groupBy("host", "token", "page").agg(
        F.max("n").alias("n"), F.min("parent").alias("parent"))
    vectors = stored(seen.groupBy("host", "token").agg(
        F.sum(F.xxhash64("page", "n").cast("decimal(38,0)")).alias("vector"), F.count("*").alias("pages"),
        F.min("n").alias("low"), F.max("n").alias("high"), F.min("parent").alias("parent")), "vectors")
    sizes = vectors.groupBy("host").agg(F.max("pages").alias("host_pages"))
    frequent = (vectors.where((F.col("pages") >= least_pages) & (F.col("low") == F.col("high"))).join(sizes, "host")
                .where(F.col("pages") * 2 >= F.col("host_pages"))
                .withColumn("class", F.xxhash64("vector", "pages")))
    large = frequent.groupBy("host", "class").agg(F.count("*").alias("tokens")).where(F.col("tokens") >= least_tokens).select("host", "class")
    valid = stored(frequent.join(large, ["host", "class"]).select("host", "token", "class", "parent", "pages"), "classes")
    outer = valid.select("host", F.col("token").alias("parent"), F.col("class").alias("inside"), F.col("pages").alias("outer_pages"))
    nested = valid.join(outer, ["host", "parent"], "left")
    return nested.where((F.col("parent") == 0) | (F.col("outer_pages") >= F.col("pages"))).select("host", "token", "class", "inside", "pages")


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: id, url, blocks (array of slot and text), text."""
    # A token of a template is on half of the host's pages, so a template has at most twice the tokens of a mean page.
    by_host = stored(templates(pages, url_col, html_col).groupBy(F.col("host").alias("t_host")).agg(F.collect_set("token").alias("template")),
                     "templates")
    tokens = by_host.agg(F.coalesce(F.sum(F.size("template") + 4), F.lit(0))).first()[0]
    side = F.broadcast(by_host) if tokens <= BROADCAST_TOKENS else by_host
    source = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    joined = source.join(side, host(F.col("url")) == F.col("t_host"), "left").select("id", "url", "html", "template")
    blocks = T.ArrayType(T.StructType([T.StructField("slot", T.LongType()), T.StructField("text", T.StringType())]))
    schema = T.StructType([source.schema["id"], T.StructField("url", T.StringType()), T.StructField("blocks", blocks)])
    kind = pa.list_(pa.struct([("slot", pa.int64()), ("text", pa.string())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, last, template = [], None, frozenset()
            for page, raw in zip(batch.column("html"), batch.column("template")):
                own = raw.values if raw.is_valid else None
                if own is None:
                    template = frozenset()
                elif last is None or not own.equals(last):
                    template = frozenset(own.to_pylist())
                last = own
                out.append([{"slot": s, "text": t} for s, t in extract(page.as_py() or "", template)])
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(out, kind)], names=["id", "url", "blocks"])

    return joined.mapInArrow(cut, schema).withColumn("text", F.array_join(F.col("blocks.text"), "\n"))


def op2_class_templates(spark, sf_dir):
    found = main_texts(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars"))
