import random
import re
from html.parser import HTMLParser

import pytest

from palimpsest.llm.html_text import (BLOCK, INLINE, NO_ARTICLE_NAMES, NO_ARTICLE_ROLES, SURGE, VOID, core, extract,
                                      lines_of, main_text)

LONG = "Some words of an article that is long enough to stand out from menus and notices around it. " * 2


@pytest.mark.parametrize("around", [
    "<nav><ul><li><a href=/a>Home</a></li></ul></nav>{}<footer>&copy; me</footer>",
    "<header>Site</header><div class='ad'>Buy this now. " + LONG + "</div>{}<div id=comments><p>" + LONG + "</p></div>",
    "<script>var a='<p>no</p>';</script><style>p{{}}</style><!-- <p>no</p> -->{}<form><input value='>'>Search</form>",
    "<aside>" + LONG + "</aside>{}<section class='related-posts'>" + LONG + "</section>",
    "<div role=navigation>Menu</div>{}<div class='cookie-notice'>" + LONG + "<button>OK</button></div>",
    "<ul class=mainNav><li>x</li></ul>{}<div hidden>" + LONG + "</div><p class=copyright>(c)</p>",
])
def test_only_the_article(around):
    article = f"<article><h1>Title &amp; more</h1><p>{LONG}</p><p>Short.</p><p>x<b>y</b>z<br>end</p></article>"
    page = f"<!DOCTYPE html><html><head><title>T</title></head><body>{around.format(article)}</body></html>"
    assert main_text(page) == f"Title & more {LONG.strip()} Short. xyz end"
    plain = around.format(f"<div><p>{LONG}</p><p>{LONG}</p></div>")
    assert main_text(f"<body>{plain}</body>") == f"{LONG.strip()} {LONG.strip()}"


def test_the_most_telling_element_counts():
    side = f"<div>Unmarked side text. {LONG}</div>"
    for holder in ("<div class='post-content'>{}</div>", "<div role='main'>{}</div>", "<main>{}</main>",
                   "<td id=storyBody>{}</td>", "<main><article>{}</article>" + side + "</main>",
                   "<div id=content><div role=main>{}</div>" + side + "</div>"):
        page = f"<body>{side}{holder.format(f'<h2>T</h2><p>{LONG}</p><p>End.</p>')}{side}</body>"
        assert main_text(page) == f"T {LONG.strip()} End."


def test_defined_cases():
    assert main_text(None) == main_text("") == main_text("<p></p>") == main_text("<script>x") == ""
    assert main_text("no markup, a < b &lt; c &nope; &#233;") == "no markup, a < b < c &nope; é"
    assert main_text("<article><p>one<p>two<div>three</article>four") == "one two three"
    assert main_text("<article>That it.</article>") == "That it."
    assert main_text("<p>" + "word " * 100_000) == ("word " * 100_000).strip()
    assert main_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert main_text("<a href=x>only a link</a>") == "only a link"
    assert main_text("<article><p>a\n\t b \x0b c&nbsp;d</p></article>") == "a b c d"


def test_an_element_never_closed_ends_with_its_parent():
    assert main_text(f"<body><div><div class=ad>buy</div><p>{LONG}</p></div></body>") == LONG.strip()
    assert main_text(f"<article><section><form>no</section><p>{LONG}</p></article>") == LONG.strip()


def test_what_is_hidden_inside_the_text_does_not_end_it():
    for between in ("<div class=advert>Buy</div>", "<script>x()</script>", "<div><aside>Buy</aside></div>",
                    "<div class=ad>Buy</div><script>x()</script>"):
        assert main_text(f"<body><div><p>{LONG}</p>{between}<p>The end.</p></div></body>") == f"{LONG.strip()} The end."
        assert main_text(f"<body><div>First.{between}{LONG}</div></body>") == f"First. {LONG.strip()}"
    assert main_text(f"<body><div><p>{LONG}</p></div><nav>x</nav><div><p>Other.</p></div></body>") == LONG.strip()


def test_surge_and_dive():
    assert core([0, 5, 0, 0, 0, 60, 50, 0, 40, 0, 0, 0, 3]) == [(3, 9)]
    assert core([0, 0, 7, 0]) == [(0, 3)] and core([]) == [] and core([0, 0]) == []
    assert [x[0] for x in lines_of("<p>a</p><p>b</p>")] == ["a", "b"]


def test_rows(spark):
    rows = [(1, "u", f"<article>{LONG}</article>", "clash"), (1, "u", f"<article>{LONG}</article>", "clash"),
            (2, None, None, "x"), (None, "v", "<p>", "y")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(tuple, extract(frame).collect()), key=str)
    assert got == sorted([(1, "u", LONG.strip()), (1, "u", LONG.strip()), (2, None, ""), (None, "v", "")], key=str)
    assert extract(frame.limit(0)).collect() == []


TEXT = "long text of the article body here " * 6


@pytest.mark.parametrize("markup,stays", [
    ('<p title="a hidden gem">KEEP</p>', True), ('<div class="share-price">KEEP</div>', True),
    ('<table class="search"><tr><td>KEEP</td></tr></table>', True), ('<p title="x>KEEP', True),
    ('<p data-hidden="1">KEEP</p>', True), ('<p style="visibility:visible">KEEP</p>', True),
    ('<p style="color:red; display : none">KEEP</p>', False), ("<p hidden>KEEP</p>", False),
    ('<p hidden="">KEEP</p>', False), ('<p style="VISIBILITY:hidden!important">KEEP</p>', False),
    ('<div class="share-buttons">KEEP</div>', False), ('<div class="adBox">KEEP</div>', False),
    ('<div class="post-comments">KEEP</div>', False), ('<div aria-hidden="true">KEEP</div>', False)])
def test_attributes_are_parsed_before_they_are_judged(markup, stays):
    found = main_text(f"<body><article><p>{TEXT}</p>{markup}<p>{TEXT}</p></article></body>")
    assert ("KEEP" in found) == stays and found.count(TEXT.strip()) == 2


def test_a_very_long_page():
    body = "".join(f"<p>paragraph {at} {TEXT}</p><div class=ad>buy {at}</div>" for at in range(5000))
    found = main_text(f"<nav>{'<a href=x>menu</a>' * 3000}</nav><main>{body}</main><footer>foot</footer>")
    assert found == " ".join(f"paragraph {at} {TEXT.strip()}" for at in range(5000))


class PlainArticle(HTMLParser):
    """The text inside article elements by the parser of Python: a second writing for pages whose
    markup is whole, with every element and class that is no article listed."""

    OUT = {"nav", "aside", "footer", "form", "script", "style", "noscript", "button", "iframe", "svg", "template", "select"}
    NAMES = set(NO_ARTICLE_NAMES)

    def __init__(self, inline):
        super().__init__()
        self.inline, self.open, self.parts, self.block = inline, [], [], []

    def flush(self):
        text = " ".join("".join(self.block).split())
        self.parts += [text] if text else []
        self.block = []

    def handle_starttag(self, tag, attrs):
        named = {key: value or "" for key, value in attrs}
        words = re.split(r"[\s_-]+", f"{named.get('class', '')} {named.get('id', '')}")
        gone = tag in self.OUT or tag == "article" and "comment" in named.get("class", "") or tag not in ("article", "body", "html", "main") and bool(
            self.NAMES & set(words)) or "hidden" in named or named.get("role") in NO_ARTICLE_ROLES
        if tag not in self.inline:
            self.flush()
        if tag not in VOID:
            self.open.append((tag, gone))

    def handle_endtag(self, tag):
        if tag not in self.inline:
            self.flush()
        if tag in [name for name, _ in self.open]:
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if any(name == "article" for name, _ in self.open) and not any(gone for _, gone in self.open):
            self.block.append(data)


def test_pages_with_an_article_against_a_second_writing(spark, sf):
    pages = [row.html for row in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    compared = 0
    for page in pages:
        if "<article" not in page:
            continue
        plain = PlainArticle(INLINE)
        plain.feed(page)
        plain.flush()
        compared += 1
        assert main_text(page) == " ".join(plain.parts)
    assert compared > 20


@pytest.mark.parametrize("seed", range(40))
def test_surge_and_dive_by_their_definition(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([0, 0, 0, 5, 30, 60, 200]) for _ in range(rng.randrange(1, 60))]
    sums = [sum(lengths[at:at + BLOCK]) for at in range(len(lengths))]
    threshold = min(SURGE, max(sums))
    kept = set()
    for at in range(len(lengths)):  # every line of a run of windows with text, one of which surges
        low = at
        while low >= 0 and sums[low]:
            low -= 1
        high = at
        while high < len(sums) and sums[high]:
            high += 1
        if sums[at] and max(sums[low + 1:high]) >= threshold:
            kept.add(at)
    assert {at for low, high in core(lengths) for at in range(low, high)} == (kept if threshold else set())
