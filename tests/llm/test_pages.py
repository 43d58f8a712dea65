"""Main text of pages against a plain reading of the given pages, and on pages made up here."""

from __future__ import annotations

import random
from html.parser import HTMLParser

import pytest

from weirgate.llm import pages
from weirgate.llm.queries import plans

SCHEMA = "page_id long, url string, html string, text string, n int, _host string"
BLOCKS = {"p", "h1", "article"}


class Plain(HTMLParser):
    """Texts between blocks inside the article; all that the given pages need."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks, self.now = False, [], ""

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.blocks.append(self.now)
            self.now = ""
        self.inside = self.inside or tag == "article"
        if tag == "br":
            self.now += " "

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.blocks.append(self.now)
            self.now = ""
        self.inside = self.inside and tag != "article"

    def handle_data(self, data):
        self.now += data if self.inside else ""


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_query_matches_plain_reading(spark, sf):
    given = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = plans.queries["op12_html_text"](spark, sf).collect()
    assert len(got) == len(given)
    for row in got:
        plain = Plain()
        plain.feed(given[row["page_id"]]["html"])
        plain.close()
        wanted = " ".join(" ".join(b.split()) for b in plain.blocks if b.split())
        assert (row["url"], row["text"], row["n_chars"]) == (given[row["page_id"]]["url"], wanted, len(wanted))


def page(*parts):
    return f"<html><head><title>t</title><style>x</style></head><body>{''.join(parts)}</body></html>"


def texts(spark, rows):
    df = spark.createDataFrame([(i, u, h, "old", 1, "mine") for i, (u, h) in enumerate(rows)], SCHEMA)
    found = pages.main_text(df)
    assert found.columns == ["page_id", "url", "html", "n", "_host", "text"]
    return [r["text"] for r in found.orderBy("page_id").collect()]


def test_templates_go_and_articles_stay(spark):
    rng = random.Random(1)
    bar = "<div class=x1><p>Top stories</p><ul><li>One<li>Two</ul></div>"
    article = "<div class=c><h2>Head</h2><p>Copied words of a long article that many pages of the site carry.</p></div>"
    rows, wanted = [], []
    for _ in range(12):
        word = f"w{rng.random()}"
        rows.append(("http://a.example/x", page(bar, f"<div class=c><p>Body {word} with enough words to be the longest.</p><ul><li>kept</ul></div>")))
        wanted.append(f"Body {word} with enough words to be the longest. kept")
    # Copies of an article stay, with the same bar and with other ones.
    rows += [("http://a.example/y", page(bar, article))] * 5 + [("http://a.example/z", page(f"<div><p>bar {i}</p></div>", article)) for i in range(3)]
    copied = "Head Copied words of a long article that many pages of the site carry."
    wanted += [copied] * 5 + [f"bar {i} {copied}" for i in range(3)]
    # Another host, twice only: no template there; nor for pages without a host.
    rows += [("http://b.example/", page(bar, f"<div class=c><p>Text {i} longer than the bar of the site is.</p></div>")) for i in range(2)]
    wanted += [f"Top stories One Two Text {i} longer than the bar of the site is." for i in range(2)]
    rows += [(None, page(bar, f"<div class=c><p>Text {i} longer than the bar of the site is.</p></div>")) for i in range(4)]
    wanted += [f"Top stories One Two Text {i} longer than the bar of the site is." for i in range(4)]
    assert texts(spark, rows) == wanted


def test_markup(spark):
    body = "<article><header><h1>Head &amp; line</h1></header><p>First&nbsp;<b>bo</b>ld\n text<br>more<p>Second <i>x</i>"
    cases = {
        page("<nav>Menu</nav><header>Site</header>", body, "<form>ask <input></form><section class='comments'><p>me too</p></section>"
             "</article><aside>side</aside><div id=cookie-notice>ok?</div><footer>&copy;</footer>"):
            "Head & line First bold text more Second x",
        page("<div class='page has-sidebar'><main><div><p>Long enough body here.</p></div></main><div class=sidebar>s</div></div>"): "Long enough body here.",
        page("<form id=aspnet><div><p>All of the page is in a form.</p></div></form>"): "All of the page is in a form.",
        "<p>no body, <!-- note --> 2 < 3 &lt;p&gt; &#233;&eacute;<script>if (a < b) '</p>'</script> end": "no body, 2 < 3 <p> éé end",
        page("<div hidden>no</div><p title='a > b'>yes</p><script>var t='<p>';"): "yes",
        page("<article><p>cut off in the mid"): "cut off in the mid",
        "": "",
        None: "",
        "plain text": "plain text",
        page("<p>" + "word " * 100_000 + "</p>"): ("word " * 100_000).strip(),
    }
    rows = [(f"http://h{i}.example/", h) for i, h in enumerate(cases)]
    assert texts(spark, rows) == list(cases.values())


def test_odd_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert pages.main_text(none).count() == 0
    same = [(1, "http://a.example/", page("<div><p>x y z</p></div>"), "t", 1, "h")] * 6 + [(None, None, None, None, None, None)]
    assert [r["text"] for r in pages.main_text(spark.createDataFrame(same, SCHEMA)).collect()].count("x y z") == 6
