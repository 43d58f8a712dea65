"""Main text of web pages by removal of site templates.

Each page is read once into boxes (elements that can hold blocks), and every box gets the
hash of its subtree: name, class and id, the texts and the hashes of inner boxes. Spark
counts, for each host, the pages a hash stands on. A hash on at least ``LEAST_PAGES`` pages
and ``LEAST_SHARE`` of the host's pages, beside at least two different articles, is part of
the site's template, and the subtree is deleted from every page of that host. What names
itself as no article (navigation, footer, form, comments and the like) goes as well, so that
a page alone on its host is read too.

The box that holds the article is never a template, and neither are its lists and sections:
copies of an article on one host keep their text. It is the ``article`` or ``main`` element,
or else the box with most text outside links.
"""

from __future__ import annotations

import html as references
import re

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import map_texts, sized_side
from weirgate.llm.lines import host_of

LEAST_PAGES = 3
LEAST_SHARE = 0.002

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?/][^>a-zA-Z][^>]*>|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
# Content of these is never text.
RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "object", "svg", "math", "canvas", "select", "button", "noembed", "noframes"}
BOXES = {
    "body", "div", "section", "article", "main", "header", "footer", "nav", "aside", "form", "ul", "ol", "dl", "menu",
    "table", "figure", "fieldset", "dialog", "details", "center",
}
BLOCKS = BOXES | {
    "html", "head", "p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "tr", "td", "th", "thead", "tbody", "tfoot", "caption",
    "pre", "blockquote", "address", "hr", "figcaption", "hgroup", "legend", "summary", "option", "br",
}
# Inside the article these are the article's own.
CONTENT = {"section", "ul", "ol", "dl", "table", "figure", "header", "details", "center", "article"}
CHROME_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "fieldset", "header"}
CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar", "alertdialog"}
READERS = {"comment", "comments", "respond", "disqus"}
CHROME_WORDS = READERS | {
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "header", "masthead", "footer", "sidebar", "ad", "ads", "advert",
    "adverts", "advertisement", "banner", "promo", "sponsor", "sponsored", "cookie", "cookies", "consent", "notice", "popup", "modal",
    "newsletter", "subscribe", "signup", "login", "search", "social", "share", "sharing",
    "related", "widget", "toolbar", "pagination", "pager",
}


class _Box:
    __slots__ = ("tag", "parent", "chrome", "words", "parts", "hash", "prose", "main")

    def __init__(self, tag: str, parent: int, attributes: str) -> None:
        self.tag, self.parent, self.prose, self.hash = tag, parent, 0, 0
        named = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)} if "=" in attributes else {}
        label = f"{named.get('class', '')} {named.get('id', '')}".strip().lower()
        words = set(re.split(r"[\s_-]+", label)) if label else set()
        role = named.get("role", "").lower()
        hidden = re.search(r"(?:^|\s)hidden(?:$|[\s=/])", attributes) or "none" in named.get("style", "").replace(" ", "").partition("display:")[2][:4]
        self.chrome, self.words = bool(tag in CHROME_TAGS or role in CHROME_ROLES or hidden), words & CHROME_WORDS
        self.main = 2 if tag == "article" or named.get("itemprop") == "articleBody" else 1 if tag == "main" or role == "main" else 0
        self.parts = [f"{tag}|{label}"]


class Page:
    """Boxes of a page and its texts in order, each with the box it stands in."""

    def __init__(self, source: str) -> None:
        self.boxes = [_Box("html", -1, "")]
        self.texts: list[tuple[int, str]] = []
        self.open = [0]
        self.buffer: list[str] = []
        self.links = 0
        self._read(source)

    def _end_block(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            if text:
                at = self.open[-1]
                self.texts.append((at, text))
                box = self.boxes[at]
                box.parts.append(text)
                box.prose += max(0, len(text) - self.links)
            self.buffer = []
        self.links = 0

    def _close(self) -> None:
        box = self.boxes[self.open.pop()]
        box.hash = xxhash.xxh3_64_intdigest("\0".join(box.parts).encode("utf-8", "surrogatepass")) - (1 << 63)
        box.parts = None
        if box.parent >= 0:
            self.boxes[box.parent].parts.append(str(box.hash))

    def _read(self, source: str) -> None:
        at, linked = 0, False
        find = TOKEN.search
        while True:
            token = find(source, at)
            text = source[at : token.start() if token else len(source)]
            if text:
                text = references.unescape(text) if "&" in text else text
                self.buffer.append(text)
                if linked:
                    self.links += len(text)
            if token is None:
                break
            at = token.end()
            closing, tag, attributes = token.group(1, 2, 3) if token.group(2) else token.group(4, 5, 6)
            if tag is None:
                continue
            tag = tag.lower()
            if tag in BLOCKS:
                if tag == "br":
                    self.buffer.append(" ")
                    continue
                self._end_block()
                if tag not in BOXES:
                    continue
                if not closing:
                    if not attributes.endswith("/"):
                        self.boxes.append(_Box(tag, self.open[-1], attributes))
                        self.open.append(len(self.boxes) - 1)
                elif any(self.boxes[b].tag == tag for b in self.open):
                    while self.boxes[self.open[-1]].tag != tag:
                        self._close()
                    self._close()
            elif tag == "a":
                linked = not closing
            elif tag in RAW and not closing and not attributes.endswith("/"):
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE).search(source, at)
                # Without an end the rest belongs to it, but for elements that hold markup.
                at = end.end() if end else len(source) if tag in ("script", "style") else at
        self._end_block()
        while self.open:
            self._close()

    def _above(self, box: int) -> list[int]:
        out = []
        while box >= 0:
            out.append(box)
            box = self.boxes[box].parent
        return out

    def judged(self) -> tuple[list[dict], int]:
        """Texts with the hashes of the boxes around them that may be templates, and whether
        they are no part of the article; and the hash of the article."""
        boxes = self.boxes
        count = len(boxes)
        # A box is out if it or a box around it names itself as no article.
        out = [False] * count
        total = [b.prose for b in boxes]
        for i in range(count - 1, 0, -1):
            total[boxes[i].parent] += total[i]
        around_main = {a for i, b in enumerate(boxes) if b.main for a in self._above(i)}
        inside_main = [False] * count
        for i, b in enumerate(boxes):
            if b.parent >= 0:
                inside_main[i] = bool(boxes[b.parent].main) or inside_main[b.parent]
            # The headline of an article, and a wrapper of the page named after what else it holds.
            headline = inside_main[i] and (b.tag == "header" or b.words == {"header"})
            wrapper = b.tag == "body" or i in around_main and (b.tag in ("div", "form") or b.main)
            most = not around_main and 2 * total[i] > total[0] and (b.tag == "form" or not b.words & READERS)
            own = (b.chrome and b.tag != "form") or ((b.tag == "form" or b.words) and not wrapper and not most)
            out[i] = bool(own and not headline) or (b.parent >= 0 and out[b.parent])
        clean = sum(b.prose for i, b in enumerate(boxes) if not out[i])
        mains: list[int] = []
        for level, least in ((2, 0.5), (1, 0.5)):
            chosen = [i for i, b in enumerate(boxes) if b.main >= level and not out[i] and not any(boxes[a].main >= level for a in self._above(b.parent))]
            if chosen and sum(total[i] for i in chosen) >= least * clean:
                mains = chosen
                break
        scoped = bool(mains)
        if not mains:
            mains = [max((i for i in range(count) if not out[i]), key=lambda i: boxes[i].prose, default=0)]
        held = {a for m in mains for a in self._above(m)}
        inner = [False] * count
        for i, b in enumerate(boxes):
            inner[i] = i in mains or (b.parent >= 0 and inner[b.parent])
        around: list[list[int]] = [[] for _ in range(count)]
        for i, b in enumerate(boxes):
            above = around[b.parent] if b.parent >= 0 else []
            safe = i in held or (inner[i] and b.tag in CONTENT)
            around[i] = above if safe else [*above, b.hash]
        pieces: list[tuple[int, list[str]]] = []
        for i, text in self.texts:
            if pieces and pieces[-1][0] == i:
                pieces[-1][1].append(text)
            else:
                pieces.append((i, [text]))
        rows = [{"text": " ".join(t), "boxes": around[i], "chrome": out[i] or (scoped and not inner[i])} for i, t in pieces]
        article = "\0".join(t for i, t in self.texts if inner[i] and not out[i])
        return rows, xxhash.xxh3_64_intdigest(article.encode("utf-8", "surrogatepass")) - (1 << 63)


PIECES = "array<struct<text:string,boxes:array<bigint>,chrome:boolean>>"


def read_pages(pages: DataFrame, html: str, keep: list[str]) -> DataFrame:
    """``keep`` columns, the texts of each page with their boxes, and the article's hash."""

    def make():
        def compute(sources: list[str]) -> list[list]:
            read = [Page(s).judged() for s in sources]
            return [[r[0] for r in read], [r[1] for r in read]]

        return compute

    return map_texts(pages, html, make, f"_pieces {PIECES}, _article bigint", keep=keep)


def site_templates(read: DataFrame, hosts: DataFrame) -> DataFrame:
    """(host, hashes) of the subtrees that recur on a host; ``hosts`` has the host of every page.

    Pages without a host belong to no site. Counts are taken before the shuffle too, so a host
    with a third of all pages sends one row a task and subtree. A host's list is bounded: each
    of its hashes stands on ``LEAST_SHARE`` of its pages, so it holds no more than the mean
    number of boxes of a page / ``LEAST_SHARE``.
    """
    named = read.where(F.col("_host") != "")
    # Counted from the addresses: no page is read for it.
    boxes = F.array_distinct(F.flatten(F.transform("_pieces", lambda p: p["boxes"])))
    sizes = hosts.groupBy("_host").agg(F.count("*").alias("pages"))
    seen = named.select("_host", "_article", F.explode(boxes).alias("hash")).groupBy("_host", "hash").agg(
        F.count("*").alias("n"), F.min("_article").alias("low"), F.max("_article").alias("high")
    )
    often = seen.where((F.col("n") >= LEAST_PAGES) & (F.col("low") != F.col("high")))
    # One row a host: the smaller side of the join.
    many = often.join(sizes, "_host").where(F.col("n") >= LEAST_SHARE * F.col("pages"))
    return many.groupBy("_host").agg(F.collect_list("hash").alias("_templates"))


def main_text(
    pages: DataFrame, html: str = "html", url: str = "url", keep: list[str] | None = None, added: str = "text"
) -> DataFrame:
    """``keep`` columns and the main text of every page, from its whole source.

    Character references are decoded, white space inside a block becomes one space, blocks
    are joined in page order by one space. A null or empty source gives an empty text, a page
    without a host keeps what no markup names as chrome, repeated pages each give their row,
    and one page repeated makes no template, as it stands beside one article only. An empty
    table gives an empty one. Very long pages are read whole. Private columns carry the work,
    and a kept column named like the added one gives way to it.
    """
    kept = [c for c in (pages.columns if keep is None else keep) if c != added]
    names = {c: f"_w_{i}" for i, c in enumerate(kept)}
    plain = pages.select(
        *[F.col(f"`{c}`").alias(n) for c, n in names.items()],
        F.coalesce(host_of(F.col(f"`{url}`").cast("string")), F.lit("")).alias("_host"),
        F.col(f"`{html}`").alias("_html"),
    )
    read = read_pages(plain, "_html", keep=[*names.values(), "_host"])
    counted = read_pages(plain.select("_host", "_html"), "_html", keep=["_host"])
    templates = sized_side(site_templates(counted, plain), F.size("_templates") * 8 + F.length("_host"))
    left = F.filter("_pieces", lambda p: ~p["chrome"] & ~F.coalesce(F.arrays_overlap(p["boxes"], "_templates"), F.lit(False)))
    joined = read.join(templates, "_host", "left")
    return joined.select(
        *[F.col(n).alias(c) for c, n in names.items()],
        F.array_join(F.transform(left, lambda p: p["text"]), " ").alias(added),
    )
