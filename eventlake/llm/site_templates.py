"""Main text of web pages, with the removal of site templates.

Every page is read into a tree of elements. The subtrees of all its blocks are hashed, menus, notices, adverts and forms
included; Spark counts on how many different pages of a host each occurs. Pages differ if their articles do: copies of a page
count once. Subtrees on many pages of their host are its template and are deleted; elements that say what they are (menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles, reader comments) are deleted where the counts have not
found them. What is left of the article, or of the body where a page has none, is the text. An article's own headings and
paragraphs are never counted, and no subtree that holds an article or most of its prose is deleted: texts that a site prints
twice are still text.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import written

#: A template subtree is on at least this many pages and this share of the host's pages.
MIN_PAGES, MIN_SHARE = 5, 0.3
# Fixed values from the HTML standard: void elements, elements whose content is not markup, elements within a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements an unclosed paragraph, item or cell ends before.
ENDS = {
    "p": frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "option": frozenset(["option", "optgroup"]),
}
#: Furniture by element, role, and words in class or id; reader comments also where the element is an article.
FURNITURE = frozenset("nav header footer aside form button select menu dialog head object audio video canvas".split()) | RAW
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|disqus|replies|respond)(?:$|[\s_-])")
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advert(?:isement|ising)|sponsor(?:ed)?|promo(?:tion)?|banner|cookies?|consent|gdpr|notices?|popup|modal|overlay|newsletter|subscribe|"
    r"sidebar|side-bar|menu|nav(?:bar|igation)?|breadcrumbs?|header|footer|masthead|share|sharing|social|related|recommended|widget|pagination|pager|toolbar|skip-link)(?:$|[\s_-])"
)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre table figure figcaption dl".split())
#: Elements that may stand in a page's head; any other, and text, ends it.
IN_HEAD = frozenset("title meta link script style base noscript template".split())
FOREIGN, ARTICLES, OUTER = frozenset(["svg", "math"]), frozenset(["article", "main"]), frozenset(["#page", "html", "body", "article", "main"])
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""[\s/]*(?:([^\s/>=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"'][^\s>]*)?)?|=)""")
_PLAIN, _BY_CLASS, _BY_KIND = 0, 1, 2


class Element:
    __slots__ = ("children", "digest", "furniture", "holds_article", "name", "prose", "size")

    def __init__(self, name: str, furniture: int):
        self.name, self.furniture, self.children, self.digest, self.size, self.prose, self.holds_article = name, furniture, [], 0, 0, 0, False


def _furniture(name: str, attributes: list[tuple[str, str]]) -> int:
    if name in FURNITURE:
        return _BY_KIND
    found = _PLAIN
    for key, value in attributes:
        key = key.lower()
        if key not in ("class", "id", "role", "hidden", "aria-hidden"):
            continue
        value = entities.unescape(value.strip("\"'")).lower()
        if key in ("class", "id") and name not in ("html", "body", "main"):
            if COMMENTS.search(value):
                return _BY_KIND
            if name != "article" and MARKED.search(value):
                found = _BY_CLASS
        elif name not in OUTER and (key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value in ROLES):
            return _BY_KIND
    return found


def _start_tag(page: str, at: int) -> tuple[list[tuple[str, str]], bool, int]:
    """Attributes of a start tag after its name, whether it closes itself, and the place behind it.

    Quotes count after an equals sign only. A quote that is never closed does not hide the tag's end.
    """
    close = page.find(">", at)
    if '"' not in page[at:close] and "'" not in page[at:close]:
        rest = page[at:close]
        return _ATTRIBUTE.findall(rest) if "=" in rest or "idden" in rest.lower() else [], rest.endswith("/"), close + 1
    attributes, place = [], at
    while True:
        found = _ATTRIBUTE.match(page, place)
        if found is None or found.end() == place:
            break
        attributes.append((found[1] or "", found[2] or ""))
        place = found.end()
        if page[place : place + 1] in ("'", '"'):  # an open quote
            return attributes, False, close + 1
    end = page.find(">", place)
    if end < 0:
        return attributes, False, close + 1
    return attributes, page[place:end].rstrip().endswith("/"), end + 1


def parse(page: str) -> Element:
    """The tree of a page. Every start tag but of void elements opens an element; end tags close what they name, if it is
    open, and all inside. Texts are children too. The time grows with the page, whatever is left open in it."""
    root = Element("#page", _PLAIN)
    stack, blocks, by_class, opened = [root], [0], [], Counter()
    last_end, at, text_from = page.rfind(">"), 0, 0
    raw_ends: dict[str, int] = {}

    def cut(depth: int) -> None:
        for gone in stack[depth:]:
            opened[gone.name] -= 1
        del stack[depth:]
        while blocks[-1] >= depth:
            blocks.pop()
        while by_class and by_class[-1] >= depth:
            by_class.pop()

    def add_text(end: int) -> None:
        if end > text_from:
            text = entities.unescape(page[text_from:end])
            if stack[-1].name == "head" and text.strip():
                cut(len(stack) - 1)
            stack[-1].children.append(text)

    while True:
        at = page.find("<", at)
        if at < 0 or at > last_end and not page.startswith("<!--", at):
            break
        name = _NAME.match(page, at + 1)
        if name is None:
            if page[at + 1 : at + 2] not in ("!", "?", "/"):
                at += 1
                continue
            add_text(at)
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                at = text_from = len(page) if end < 0 else end + 3
                continue
            closing = _NAME.match(page, at + 2) if page[at + 1] == "/" else None
            end = page.find(">", at)
            at = text_from = end + 1
            if closing and opened[closing[0].lower()]:
                tag, depth = closing[0].lower(), len(stack) - 1
                while stack[depth].name != tag:
                    depth -= 1
                cut(depth)
            continue
        add_text(at)
        tag = name[0].lower()
        attributes, closed, at = _start_tag(page, name.end())
        text_from = at
        if stack[-1].name == "head" and tag not in IN_HEAD:
            cut(len(stack) - 1)
        # An unclosed paragraph and the like ends here, with the inline elements open in it.
        while blocks[-1] and tag in ENDS.get(stack[blocks[-1]].name, ()):
            cut(blocks[-1])
        element = Element(tag, _furniture(tag, attributes))
        stack[-1].children.append(element)
        if tag in ARTICLES and not element.furniture:
            for depth in by_class:  # what wraps an article is no furniture, whatever its class says
                stack[depth].furniture = _PLAIN
            by_class.clear()
        if tag in VOID or tag in FOREIGN and closed:
            continue
        if tag in RAW:
            if raw_ends.get(tag, 0) >= 0:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.IGNORECASE).search(page, at)
                raw_ends[tag] = end.end() if end else -1
            at = text_from = raw_ends[tag] if raw_ends[tag] >= 0 else len(page)
            continue
        if tag not in INLINE:
            blocks.append(len(stack))
        if element.furniture == _BY_CLASS:
            by_class.append(len(stack))
        opened[tag] += 1
        stack.append(element)
    add_text(len(page))
    return root


def _walk(root: Element) -> list[tuple[Element, bool]]:
    """All elements, parents first, and whether an article holds them."""
    out, todo = [], [(root, False)]
    while todo:
        element, inside = todo.pop()
        out.append((element, inside))
        inside = inside or element.name in ARTICLES
        todo.extend((c, inside) for c in element.children if isinstance(c, Element))
    return out


def hashed(root: Element) -> set[int]:
    """Gives each element the hash of its subtree, the length of its text and of that in paragraphs, headings and the like;
    returns the hashes of the blocks that may be template."""
    found = set()
    for element, inside in reversed(_walk(root)):
        parts = xxhash.xxh64(element.name)
        size, prose, holds = 0, 0, element.name in ARTICLES and not element.furniture
        for child in element.children:
            if isinstance(child, Element):
                parts.update(b"<%d>" % child.digest)
                size, prose, holds = size + child.size, prose + child.prose, holds or child.holds_article
            else:
                text = " ".join(child.split())
                parts.update(text.encode("utf-8", "surrogatepass"))
                size += len(text)
        element.digest, element.size, element.holds_article = parts.intdigest() >> 1, size, holds
        element.prose = size if element.name in PROSE else prose
        block = element.name not in INLINE and not (inside and element.name in PROSE)
        if block and size and element.name not in OUTER and not holds:
            found.add(element.digest)
    return found


class Extract(NamedTuple):
    text: str
    by_count: int
    by_rule: int


def extract(root: Element, template: frozenset[int] = frozenset()) -> Extract:
    """The text of the page's articles, else of its main element, else of its body; and how many subtrees of the page (none
    inside another) were deleted because the host repeats them, and by rule alone."""
    found = hashed(root) & template
    starts = _outermost(root, "article") or _outermost(root, "main") or [e for e, _ in _walk(root) if e.name == "body"][:1] or [root]
    prose = max(e.prose for e in starts)
    deleted, by_count, by_rule, todo = set(), 0, 0, [(root, False)]
    while todo:
        element, inside = todo.pop()
        inside = inside or element.name in ARTICLES
        kept = element.name in INLINE or inside and element.name in PROSE or element.name in OUTER or element.holds_article
        if element.digest in found and not kept and 2 * element.prose <= prose:
            deleted.add(id(element))
            by_count += 1
        elif element.furniture:
            deleted.add(id(element))
            by_rule += 1
        else:
            todo.extend((c, inside) for c in element.children if isinstance(c, Element))
    blocks: list[str] = []
    for start in starts:
        rest: list[Element | str] = [start]
        while rest:
            item = rest.pop()
            if isinstance(item, str):
                blocks.append(item)
            elif id(item) not in deleted:
                edge = " " if item.name not in INLINE else ""
                rest += [edge, *reversed(item.children), edge]
            elif item.name not in INLINE:
                blocks.append(" ")
        blocks.append(" ")
    return Extract(" ".join("".join(blocks).split()), by_count, by_rule)


def main_text(root: Element, template: frozenset[int] = frozenset()) -> str:
    return extract(root, template).text


def _outermost(root: Element, name: str) -> list[Element]:
    found, todo = [], [root]
    while todo:
        element = todo.pop()
        if element.name == name and not element.furniture:
            found.append(element)
        elif not element.furniture:
            todo.extend(c for c in reversed(element.children) if isinstance(c, Element))
    return found


def host_of(url: str = "url") -> Column:
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.lower(rest)


def templates(pages: DataFrame, *, html: str = "html", url: str = "url", min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """Written: host, and the hashes of its template subtrees. Pages of one host with the same text, found by the rules, count
    as one. Counts are combined before each shuffle, so a hot host's pages stay spread; its list is short, because a page
    holds few subtrees and each of the list is on ``min_share`` of the pages."""

    def subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents, lists = [], []
            for x in batch.column("html"):
                root = parse(x.as_py())
                contents.append(xxhash.xxh64_intdigest(extract(root).text.encode("utf-8", "surrogatepass")) >> 1)
                lists.append([-1, *hashed(root)])
            columns = [batch.column("host"), pa.array(contents, pa.int64()), pa.array(lists, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["host", "content", "digests"])

    rows = pages.select(host_of(url).alias("host"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    each = rows.mapInArrow(subtrees, "host string, content long, digests array<long>").select("host", "content", F.explode("digests").alias("digest"))
    often = each.distinct().groupBy("host", "digest").agg(F.count(F.lit(1)).alias("n"))
    often = written(often.where(F.col("n") >= min_pages), "subtrees")
    total = often.where("digest = -1").select("host", F.col("n").alias("pages"))
    return written(often.where("digest <> -1").join(total, "host").where(F.col("n") >= min_share * F.col("pages")).groupBy("host").agg(F.collect_list("digest").alias("template")), "templates")


def extracted(pages: DataFrame, *, key: str = "page_id", html: str = "html", url: str = "url", min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars, host, n_template (subtrees of the host's template), by_count
    and by_rule (subtrees deleted from this page).

    NULL or empty html gives the empty text; a NULL url belongs to the host ``''``. Repeated rows are pages of their own and
    count as one page of their host. An empty table gives no rows. A page of any length is read in one pass.
    """
    found = templates(pages, html=html, url=url, min_pages=min_pages, min_share=min_share)
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), host_of(url).alias("host"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    known = rows.join(found.withColumnRenamed("host", "_host"), F.col("host") == F.col("_host"), "left").drop("_host")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [frozenset(t.as_py() or ()) for t in batch.column("template")]
            out = [extract(parse(h.as_py()), t) for h, t in zip(batch.column("html"), sets, strict=True)]
            counts = [[len(x.text) for x in out], [len(t) for t in sets], [x.by_count for x in out], [x.by_rule for x in out]]
            size, template, by_count, by_rule = (pa.array(c, pa.int64()) for c in counts)
            columns = [batch.column("page_id"), batch.column("url"), pa.array([x.text for x in out], pa.string()), size, batch.column("host"), template, by_count, by_rule]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars", "host", "n_template", "by_count", "by_rule"])

    kind = pages.schema[key].dataType.simpleString()
    return known.mapInArrow(texts, f"page_id {kind}, url string, text string, n_chars long, host string, n_template long, by_count long, by_rule long")
