"""Main text of web pages, without what belongs to the site.

A site repeats its menus, footers and boxes on page after page. Every element's subtree (tag, texts and subtrees below it)
gets a hash; Spark counts for each host on how many different contents a hash stands, and subtrees that recur across
enough of them are the host's template and are deleted. What is left of the page's article is its text. Elements that say
themselves that they are no article (menus, forms, scripts, comment sections, ...) go whether they recur or not.

Counts move as three numbers a subtree; page sources do not move. A host's template is short however many pages the host
has: each of its subtrees stands on a fixed share of them.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelwatch.llm.common import pick, stage_table, utf8_slices

# Fixed values of HTML: elements without content, those whose content is no markup, and those that end a paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noframes noembed xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
# Elements, roles and words of class or id that mark what is not an article.
NOT_TEXT = frozenset(
    "nav footer aside form script style noscript template iframe noframes noembed object embed applet canvas svg math audio video button select textarea input datalist dialog menu head title search".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar tablist".split())
MARKS = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager header masthead footer sidebar aside ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner notice notices cookie cookies consent gdpr alert popup modal overlay newsletter subscribe subscription signup login search share sharing social widget skip".split()
)
READERS = frozenset("comment comments disqus respond replies related recommended".split())
#: An element that one of these starts ends an open element of the other list, up to the nearest of the last list.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select", "datalist")),
}

TAG = re.compile(r"""<(?:!--(?:.*?-->|.*)|[!?][^>]*>|/[^a-zA-Z>][^>]*>|</?>|(/?)([a-zA-Z][^\s/>]*)((?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)>)""", re.S)
MARKED = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

HOST = r"^.*?://([^/?#]*)"


def _says_no(tag: str, attributes: str, in_article: bool) -> int:
    """2 for an element that is never an article's text, 1 for one marked so that may still hold an article, else 0."""
    if tag in NOT_TEXT:
        return 2
    mark = 1 if tag == "header" and not in_article else 0
    for name, *values in MARKED.findall(attributes) if attributes else ():
        name, value = name.lower(), "".join(values).lower() if name.lower() not in ("class", "id") else "".join(values)
        if name == "role" and value in ROLES:
            return 2
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and HIDDEN.search(value):
            mark = 1
        if name in ("class", "id") and tag not in ("html", "body"):
            for part in value.split():
                words = [w.lower() for w in WORD.findall(part)]
                # "comment-list" or "siteFooter", but not "article-ad-free-text".
                for word in words[:1] + words[-1:]:
                    if word in READERS:
                        return 2
                    if word in MARKS and tag not in ("article", "main") and not (in_article and word in ("header", "masthead")):
                        mark = 1
    return mark


class Node:
    """An element: its parts are texts and elements in page order."""

    __slots__ = ("gone", "hash", "no", "parts", "tag", "within")

    def __init__(self, tag: str, no: int, within: bool):
        self.tag, self.no, self.within, self.parts, self.hash, self.gone = tag, no, within, [], 0, False


def parse(source: str) -> Node:
    """The page's tree. Unclosed and misnested elements end as in browsers, without their special cases for tables."""
    root = Node("#page", 0, False)
    stack, at, last = [root], 0, source.rfind(">") + 1
    while at < last:
        found = TAG.search(source, at, last)
        start = found.start() if found else last
        if start > at:
            stack[-1].parts.append(entities.unescape(source[at:start]))
        if not found:
            break
        at = found.end()
        closing, tag = found[1], found[2]
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in ("td", "th") and tag in ("p", "li", "div", "span", "b", "i", "a"):
                    break  # a cell is not left by such an end tag
        else:
            if tag in BLOCKS:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == "p":
                        del stack[i:]
                        break
                    if stack[i].tag in BLOCKS:
                        break
            if tag in CLOSES:
                ends, bounds = CLOSES[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in ends:
                        del stack[i:]
                        break
                    if stack[i].tag in bounds:
                        break
            within = stack[-1].within
            node = Node(tag, _says_no(tag, found[3], within), within or tag in ("article", "main") or 'role="main"' in found[3])
            stack[-1].parts.append(node)
            if tag in ("article", "main") and not any(n.no == 2 for n in [*stack, node]):
                for n in stack:  # "with-sidebar" round the whole page is no sidebar
                    n.no = 0
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(source, at)
                if tag in ("textarea", "title"):
                    node.parts.append(entities.unescape(source[at : end.start() if end else len(source)]))
                at = end.end() if end else len(source)
            elif tag not in VOID:
                stack.append(node)
    if at < len(source):  # text behind the last tag; a tag that the page's end cuts off is none
        tail = re.split(r"<[a-zA-Z/!?]", source[at:], maxsplit=1)[0]
        stack[-1].parts.append(entities.unescape(tail))
    return root


def _walk(root: Node) -> list[Node]:
    """All elements, those below before those above; pages can nest deeper than Python's stack."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [p for p in node.parts if isinstance(p, Node)]
    return order[::-1]


def _hash_subtrees(nodes: list[Node]) -> None:
    """A 63-bit hash for each subtree: of its tag, its texts in single spaces and the hashes below it."""
    for node in nodes:
        parts = [node.tag]
        for part in node.parts:
            if isinstance(part, Node):
                parts.append(f"\x01{part.hash}")
            elif text := " ".join(part.split()):
                parts.append(text)
        # The lowest bit says whether it stands in an article.
        node.hash = (xxhash.xxh3_64_intdigest("\x00".join(parts)) >> 2 << 1) | bool(node.within)


def _mark(nodes: list[Node], template: frozenset[int]) -> None:
    """Marks what goes: elements that are no text, the template's subtrees, and all below them."""
    for node in reversed(nodes):  # those above before those below
        for part in node.parts:
            if isinstance(part, Node):
                part.gone = node.gone or part.no > 0 or part.hash in template


def _blocks(node: Node) -> list[str]:
    """Texts of the blocks below an element, in page order, without what goes."""
    out, open_text, todo = [], [], [node]

    def close() -> None:
        if text := " ".join("".join(open_text).split()):
            out.append(text)
        open_text.clear()

    while todo:
        part = todo.pop()
        if part is None:
            close()
        elif isinstance(part, str):
            open_text.append(part)
        elif part.tag in BLOCKS:
            close()
            if not part.gone:
                todo += [None, *reversed(part.parts)]
        elif part.gone or part.tag in VOID:
            open_text.append(" ")
        else:
            todo += reversed(part.parts)
    close()
    return out


def content(root: Node) -> list[str]:
    """Blocks of a marked page's outermost articles; without any, of its main elements; without those, of the page."""
    for wanted in ("article", "main"):
        out, todo, found = [], [root], False
        while todo:
            node = todo.pop()
            if node.gone:
                continue
            if node.tag == wanted:
                found = True
                out += _blocks(node)
            else:
                todo += reversed([p for p in node.parts if isinstance(p, Node)])
        if found:
            return out
    return _blocks(root)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(site, content, subtrees): the hash of each page's content, and the distinct ones of its subtrees."""
    for batch in batches:
        for part in utf8_slices([batch], "html"):
            contents, subtrees = [], []
            for source in part.column("html").to_pylist():
                root = parse(source or "")
                nodes = _walk(root)
                _hash_subtrees(nodes)
                _mark(nodes, frozenset())
                contents.append(xxhash.xxh3_64_intdigest("\n".join(content(root))) >> 1)
                # What goes in any case needs no count.
                subtrees.append(sorted({n.hash for n in nodes[:-1] if not n.gone and n.parts and n.tag not in ("html", "body", "article", "main")}))
            yield pa.RecordBatch.from_pydict(
                {"site": part.column("site"), "content": pa.array(contents, pa.int64()), "subtrees": pa.array(subtrees, pa.list_(pa.int64()))}
            )


def templates(pages: DataFrame, *, least: int = 5, share: float = 0.5, least_inside: int = 20, share_inside: float = 0.9) -> DataFrame:
    """(site, template) of ``pages(site, html)``: the subtrees that recur across the site, a sorted array.

    Pages are counted by different contents, so that copies of one article do not make its paragraphs a template. A
    subtree outside articles belongs to it on ``least`` contents and ``share`` of the site's; one inside an article on
    ``least_inside`` and ``share_inside``, for articles do repeat passages, and no other part of a page may be cut.
    """
    parts = pages.where(F.col("site").isNotNull()).mapInArrow(_count, "site bigint, content bigint, subtrees array<bigint>")
    # One scan counts both; -1 stands for the page as such.
    seen = parts.select("site", "content", F.explode(F.concat("subtrees", F.array(F.lit(-1).cast("bigint")))).alias("hash")).distinct()
    inside = F.col("hash") % 2 == 1
    often = (F.col("hash") == -1) | (F.col("count") >= F.when(inside, least_inside).otherwise(least))
    counts = stage_table(seen.groupBy("site", "hash").count().where(often), "main-text-counts")  # else pages are parsed again
    sites = counts.where("hash = -1").select("site", F.col("count").alias("pages"))
    needs = F.when(inside, share_inside).otherwise(share) * F.col("pages")
    chosen = counts.where("hash <> -1").join(sites, "site").where(F.col("count") >= needs)
    return chosen.groupBy("site").agg(F.sort_array(F.collect_list("hash")).alias("template"))


def _texts(schema: T.StructType):
    names = schema.names

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in utf8_slices([batch], "html"):
                texts = []
                for source, template in zip(part.column("html").to_pylist(), part.column("template").to_pylist(), strict=True):
                    root = parse(source or "")
                    nodes = _walk(root)
                    if template:
                        _hash_subtrees(nodes)
                    _mark(nodes, frozenset(template or ()))
                    texts.append("\n\n".join(content(root)))
                columns = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return task


def extract(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", broadcast_rows: int = 100_000, **limits) -> DataFrame:
    """(page_id, url, text, n_chars) of every page; ``limits`` are those of ``templates``.

    text holds the blocks of the page's articles (else of its main element, else of the page), joined by an empty line.
    Headers inside an article stay, all other headers go. White space is what Python's ``str.split`` takes for it, and
    a line break inside a block is white space. n_chars counts code points.

    A null or empty page has an empty text. Pages without a host (null url, no ``://``) belong to no site and have no
    template. Rows that repeat, or share an id, come back as often as they came; they count once for the template. An
    empty table gives no rows. Other columns, whatever their names, are not looked at.
    """
    live = pick(pages, page_id=page_id, url=url, html=html)
    host = F.lower(F.regexp_extract("url", HOST, 1))
    live = live.withColumn("site", F.when(host != "", F.xxhash64(host)))
    found = templates(live.select("site", "html"), **limits)
    schema = T.StructType([*live.select("page_id", "url").schema, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    found = stage_table(found, "main-text-templates")
    size = found.agg(F.count("*").alias("sites"), F.sum(F.size("template")).alias("hashes")).first()
    if size["sites"] + (size["hashes"] or 0) <= broadcast_rows:  # 8 bytes each
        found = F.broadcast(found)
    return live.join(found, "site", "left").select("page_id", "url", "html", "template").mapInArrow(_texts(schema), schema)
