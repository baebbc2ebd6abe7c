"""HTML extraction: the best run against brute force, and pages whose parts have no telling names."""

import itertools
import random
import time
from html.parser import HTMLParser

from apportion.llm import html
from apportion.llm.queries import op9_html

PROSE = "<p>" + "It was a long day and they walked to the river. " * 6 + "</p>"
TEXT = ("It was a long day and they walked to the river. " * 6).strip()
NONE = html.weights([])


def test_best_run_is_brute_force():
    rng = random.Random(5)
    for _ in range(300):
        x = [rng.choice([-3, -1, -0.5, 0.5, 1, 2]) for _ in range(rng.randrange(9))]
        sums = {(a, b): sum(x[a:b]) for a, b in itertools.combinations(range(len(x) + 1), 2)}
        best = max(sums.values(), default=0)
        a, b = html.region(x)
        assert (best <= 0 and (a, b) == (0, 0)) or sums[a, b] == best


def test_region_cuts_parts_without_names(monkeypatch):
    page = f"<html><body><div><div><a href='/a'>Home</a></div><div><a href='/b'>News</a></div></div><div>Buy one now</div>{PROSE}{PROSE}<div>Made by hand 2020</div></body></html>"
    assert html.main_text(page, NONE) == f"{TEXT}\n{TEXT}"
    monkeypatch.setattr(html, "region", lambda scores: (0, len(scores)))
    assert html.main_text(page, NONE) == f"Home\nNews\nBuy one now\n{TEXT}\n{TEXT}\nMade by hand 2020"


def test_labelled_pages_change_the_region():
    page = f"<div class='zed'>{'alpha beta gamma ' * 10}</div><div class='why'>{'delta epsilon zeta ' * 10}</div>"
    assert "alpha" in html.main_text(page, NONE)
    labelled = f"<body><div class='zed'>{'one two three four ' * 30}</div><article><div class='why'>{'five six seven eight ' * 30}</div></article></body>"
    w = html.weights([labelled] * 5)
    assert "alpha" not in html.main_text(page, w) and "delta" in html.main_text(page, w)


def test_attributes_that_only_look_hidden():
    for attribute in ("style='overflow:hidden'", "class='overflow-hidden'", "data-x='is hidden gem'", "title='The hidden cost'", "class='content with-sidebar'", "id='related-work'", "aria-hidden='false'", "aria-hidden='true'"):
        for tag in ("article", "main", "div", "section"):
            assert html.main_text(f"<body><{tag} {attribute}>{PROSE}</{tag}></body>", NONE) == TEXT, (tag, attribute)
    for attribute in ("hidden", "style='color:red; display : none'"):
        assert html.main_text(f"<body><div {attribute}>{PROSE}</div><p>{'seen ' * 30}</p></body>", NONE) == ("seen " * 30).strip()


def test_blanks_between_inline_elements():
    for inner, want in (("<b>Hello</b> <i>world</i>", "Hello world"), ("<a>one</a> <a>two</a>\n<em>three</em>", "one two three"), ("a<span aria-hidden=true>b</span>c", "abc"), ("x<b> </b>y<!-- -->z", "x yz"), ("x&nbsp;<b>y</b>", "x y")):
        assert html.main_text(f"<article>{PROSE}<p>{inner}</p>{PROSE}</article>", NONE) == f"{TEXT}\n{want}\n{TEXT}"


class Plain(HTMLParser):
    """Text of all blocks, by the standard library's parser."""

    def __init__(self):
        super().__init__()
        self.blocks, self.held = [], ""

    def end(self):
        self.blocks += [b] if (b := " ".join(self.held.split())) else []
        self.held = ""

    def handle_starttag(self, tag, attrs):
        self.held += " " if tag == "br" else ""
        if tag in html.BLOCK:
            self.end()

    def handle_endtag(self, tag):
        if tag in html.BLOCK:
            self.end()

    def handle_data(self, data):
        self.held += data


def test_text_of_random_nested_pages():
    """Everything within one <article> comes back, as a plain parser gives it."""
    rng = random.Random(11)

    def made(depth):
        kind = rng.random()
        if depth == 0 or kind < 0.4:
            return rng.choice(["word", " ", "\n", "two words", " lead", "trail ", "&amp;", "&#233;", "<br>", "<!-- no -->"])
        inner = "".join(made(depth - 1) for _ in range(rng.randrange(4)))
        tag = rng.choice(["b", "i", "em", "span", "a", "code"] if kind < 0.7 else ["div", "section", "blockquote", "ul"])
        inner = f"<li>{inner}</li>" if tag == "ul" else inner
        return f"<{tag}>{inner}</{tag}>"

    for _ in range(400):
        body = PROSE + "".join(made(4) for _ in range(6)) + PROSE
        plain = Plain()
        plain.feed(body)
        plain.end()
        assert html.main_text(f"<body><nav><a>Home</a></nav><article>{body}</article></body>", NONE) == "\n".join(plain.blocks), body


def test_edges_of_an_article_stay():
    side = "<nav><ul><li><a href='/'>Home</a></li></ul></nav>"
    for edge, want in (("<ul><li><a href='/x'>First link</a></li><li><a href='/y'>Second link</a></li></ul>", "First link\nSecond link"), ("<table><tr><td>1</td><td>2</td></tr></table>", "1\n2"), ("<div>By hand</div>", "By hand")):
        assert html.main_text(f"<body>{side}<article>{PROSE}{edge}</article><footer>Made 2020</footer></body>", NONE) == f"{TEXT}\n{want}"
        assert html.main_text(f"<body>{side}<article>{edge}{PROSE}</article><footer>Made 2020</footer></body>", NONE) == f"{want}\n{TEXT}"
    # Two articles are no evidence, and what is in doubt within one goes.
    assert html.main_text(f"<body><article>{PROSE}<div class='share'><a>Like</a></div></article></body>", NONE) == TEXT


def test_inner_advert_goes_and_page_in_form_stays():
    assert html.main_text(f"<article>{PROSE}<div class='ad'>Buy this now please</div><form><p>Your mail</p><input></form>{PROSE}</article>", NONE) == f"{TEXT}\n{TEXT}"
    assert html.main_text(f"<body><form action='/'>{PROSE}{PROSE}</form></body>", NONE) == f"{TEXT}\n{TEXT}"


def test_deep_and_long_pages_take_linear_time():
    began = time.time()
    html.main_text("<b>" * 50_000 + "</i>" * 50_000 + "<div>" * 2_000 + "word " * 100_000, NONE)
    assert time.time() - began < 20


def test_rows(spark):
    pages = spark.createDataFrame([(1, "u", f"<article>{PROSE}</article>"), (None, None, None), (1, "v", ""), (2, "w", f"<nav>x</nav><main>{PROSE}</main>")], "page_id long, text string, html string")
    got = html.extract(pages, html.fit(pages))
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in got.collect()) == [(0, "", 0), (1, "", 0), (1, TEXT, len(TEXT)), (2, TEXT, len(TEXT))]
    empty = pages.limit(0)
    assert html.extract(empty, html.fit(empty)).count() == 0


def test_query_keeps_each_rows_url(spark, tmp_path):
    rows = [(1, "u", f"<article>{PROSE}</article>"), (1, "v", None), (None, "w", f"<p>{'more ' * 40}</p>")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {(r["page_id"], r["url"]): r["text"] for r in op9_html(spark, str(tmp_path)).collect()}
    assert got == {(1, "u"): TEXT, (1, "v"): "", (None, "w"): ("more " * 40).strip()}
