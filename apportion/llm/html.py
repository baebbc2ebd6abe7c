"""Main text of web pages by the maximum-scoring subsequence of their tokens.

A page is a row of tokens: tags, and words with the element that holds them. Words of elements that mostly hold content
score above zero; tags, and words of other elements, below. The contiguous run of tokens with the greatest sum, found in
one linear scan, is the content region: what lies before and after it (menus, adverts, notices, footers, comments) goes
because its sum is below zero, whatever it is called.

Weights are log odds of lying inside or outside the content of labelled pages: pages that mark their content themselves,
with one <article> or <main>. They are counted on at most LABELLED pages drawn by hash, and added to prior counts that
stand for common usage. A weight belongs to a key, which is made of

    * the nearest block or named element, its name with its class, id and role;
    * for elements that are not made for prose (div, span, td, ...), whether the block is a short one;
    * whether an element around it is of a doubtful kind by common usage (menus, asides, forms, adverts, comments, ...).

A page's only <article> or <main> is evidence too: what it holds, elements in doubt aside, scores at least WITHIN a word, so
closing lists of links, tables and bylines stay with their article. It is no proof: the search still decides.

The search can't cut inside its run. There, elements of a doubtful kind whose words score below zero are left out, so they
interrupt a run at the cost of GAP at most; a kind whose words labelled pages hold in their content scores above zero and stays. A form around most of a page is no doubt.

Only what a browser doesn't show as text is never taken: scripts, styles, the head, controls, and what attributes hide
(`hidden`, display:none in `style`). Each block element makes a block of the region: its text with
character references decoded, each run of white space as one space, trimmed; blocks are joined in page order by a line
feed. A page is parsed within one row of one narrow pass.

Null and empty pages, and pages without content, have empty text. Ids may be null or repeated: rows are not joined.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, text_batches

LABELLED = 500
WITHIN, TAG_WITHIN = 0.5, -0.1
"""The least that a word and a tag within a page's only <article> or <main> score, in doubt aside."""
GAP = 2.0
"""What elements of a doubtful kind cost at most where they interrupt a run."""
SHORT = 12
"""A block of fewer words is a short one."""

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split())
CLOSES_P = BLOCK - {"body", "head", "html", "option", "optgroup", "td", "th", "tr", "caption", "tbody", "thead", "tfoot"}
CLOSES = {"li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}), "tr": ("tr td th", {"table"}), "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}), "option": ("option", {"select"})}

UNSEEN = frozenset("head script style template noscript button select textarea input iframe svg canvas object title".split())
"""Elements whose text a browser doesn't show as text of the page."""

# Common usage: elements, and words of class, id and role, that seldom hold content; elements that hold it.
DOUBTFUL = frozenset("nav menu aside dialog footer".split())
DOUBTFUL_NAMES = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs captcha comment comments commentlist consent contentinfo cookie cookies copyright disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pagination pager popup promo promoted recommended related reply replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar widget".split())
OWN = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
GOOD = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre dd dt figcaption article main".split())
LISTS = frozenset("ul ol li dl table thead tbody tr td th".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+(?:>|\Z))""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"?|'([^']*+)'?|([^\s>"'][^\s>]*+)))?|"[^"]*+"?|'[^']*+'?""")
_NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.IGNORECASE)


def _attributes(raw: str) -> dict[str, str]:
    """Values by lower-cased name, the first of a repeated name."""
    own: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(raw):
        if m[1]:
            own.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return own


def _parts(words: str) -> list[str]:
    return [w.lower() for w in re.split(r"[\s_-]+|(?<=[a-z])(?=[A-Z])", words) if w]


def _hidden(own: dict[str, str]) -> bool:
    return own.get("hidden", "false").lower() != "false" or bool(_NOT_SHOWN.search(own.get("style", "")))


def _doubtful_named(name: str, own: dict[str, str]) -> bool:
    """Whether a class, role or id has no other parts than DOUBTFUL_NAMES. A heading's id is made of its text, so it is left out."""
    words = " ".join(own.get(a, "") for a in ("class", "role", *(() if name in HEADINGS else ("id",)))).split()
    return any((parts := _parts(w)) and DOUBTFUL_NAMES.issuperset(parts) for w in words)


@dataclass(slots=True)
class Token:
    """A tag (no text) or a text. `own`: an <article> or <main> is around it; `doubt`: 2 if an element of a doubtful kind
    is, 1 if only a form is, else 0; `n`: how many words the text has."""

    key: str
    text: str
    shown: bool
    own: bool
    doubt: int
    n: int = 0


@dataclass(slots=True)
class _Open:
    name: str
    key: str
    shown: bool
    own: bool
    doubt: int


def tokens(page: str) -> list[Token]:
    """Tokens in page order. A tag's key is `<name` or `</name`; a text's that of its element, after `~` in doubt."""
    out: list[Token] = []
    root = _Open("", "", True, False, 0)
    stack: list[_Open] = []
    open_names: Counter = Counter()
    at = 0

    def text(raw: str) -> None:
        # White space alone is a text too, of no words, as it may part the words of two elements; not so where a block begins or ends.
        if raw and not (raw.isspace() and (not out or (not out[-1].text and out[-1].key.lstrip("</") in BLOCK))):
            top = stack[-1] if stack else root
            out.append(Token(top.key, raw, top.shown, top.own, top.doubt, len(raw.split())))

    def close(index: int) -> None:
        while len(stack) > index:
            e = stack.pop()
            open_names[e.name] -= 1
            out.append(Token("</" + e.name, "", e.shown, e.own, e.doubt))

    for m in _TOKEN.finditer(page):
        if m.start() < at:
            continue
        text(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name, attributes = m[2].lower(), m[3]
        if not m[0].endswith(">"):
            break  # the page ends within a tag
        if m[1]:
            if open_names[name] > 0:
                close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i].name == name))
            elif name == "p":
                top = stack[-1] if stack else root
                out.append(Token("</p", "", top.shown, top.own, top.doubt))
            continue
        if name in CLOSES_P or name in CLOSES:
            ends, scope = CLOSES.get(name, ("", set()))
            ends = set(ends.split()) | ({"p"} if name in CLOSES_P else set())
            i = len(stack) - 1 if any(open_names[e] > 0 for e in ends) else -1
            while i >= 0 and stack[i].name not in ends and stack[i].name not in scope and (stack[i].name not in BLOCK or stack[i].name in ("p", "li")):
                i -= 1
            if i >= 0:
                if stack[i].name in ends:
                    close(i)
        if name in OWN and stack and (stack[-1].doubt or not stack[-1].shown):
            # Content that a page marks is not part of an element left open before it.
            close(next(i for i, s in enumerate(stack) if s.doubt or not s.shown))
        held = _attributes(attributes)
        names = {n for a in ("class", "id", "role") for n in _parts(held.get(a, ""))}
        above = stack[-1] if stack else root
        own = above.own or name in OWN
        doubtful = name in DOUBTFUL or (name == "header" and not own) or (name not in OWN | {"html", "body"} and _doubtful_named(name, held))
        doubt = max(above.doubt, 2 if doubtful else 1 if name == "form" else 0)
        shown = above.shown and name not in UNSEEN and not _hidden(held)
        out.append(Token("<" + name, "", shown, above.own, doubt))
        if name in VOID or (attributes.rstrip(">").endswith("/") and name not in BLOCK):
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.IGNORECASE).search(page, at)
            at = len(page) if end is None else end.start()
            open_names[name] += 1
            stack.append(_Open(name, name, False, own, doubt))
            continue
        # Texts are counted by the nearest block or named element.
        key = ".".join([name, *sorted(names)]) if names or name in BLOCK or (name == "a" and above.key.split(".")[0] not in GOOD) else above.key or name
        open_names[name] += 1
        stack.append(_Open(name, key, shown, own, doubt))
    else:
        text(page[at:])
    _finish(out)
    return out


def _finish(found: list[Token]) -> None:
    """Marks texts in doubt and texts of short blocks in their keys, once the whole page is known."""
    texts = [t for t in found if t.text and t.shown]
    form = 2 * sum(t.n for t in texts if t.doubt == 1) > sum(t.n for t in texts)
    block: list[Token] = []

    def end():
        if sum(t.n for t in block) < SHORT:
            for t in block:
                if t.key.split(".")[0] not in GOOD | LISTS | {"a"}:
                    t.key += "/short"
        block.clear()

    for t in found:
        if t.text:
            if t.shown:
                block.append(t)
        elif t.key.lstrip("</") in BLOCK:
            end()
    end()
    for t in found:
        if t.doubt == 1 and form:
            t.doubt = 0
        if t.doubt and t.text:
            t.key = "~" + t.key


class Weights:
    """Log odds of keys, from counts inside and outside content."""

    def __init__(self, inside: dict[str, int], outside: dict[str, int]):
        self.inside, self.outside = inside, outside
        self.memo: dict[str, float] = {}

    def __call__(self, key: str) -> float:
        w = self.memo.get(key)
        if w is None:
            # Prior counts: words in doubt 1 to 8, of content elements 8 to 2, of lists and tables 3 to 1, links 1 to 4, other short blocks 2 to 3, others 4 to 3; tags 1 to 4, save those of content and lists, 1 to 2.
            name = key.lstrip("</").split(".")[0].split("/")[0]
            if key.startswith("<"):
                a, b = (1, 2) if name in GOOD | LISTS or name not in BLOCK else (1, 4)
            elif key.startswith("~"):
                a, b = (1, 8)
            else:
                a, b = (8, 2) if name in GOOD else (3, 1) if name in LISTS else (1, 4) if name == "a" else (2, 3) if key.endswith("/short") else (4, 3)
            w = math.log((self.inside.get(key, 0) + a) / (self.outside.get(key, 0) + b))
            w = max(-4.0, min(4.0, w)) if not key.startswith("<") else max(-4.0, min(-0.1, w))
            if len(self.memo) < 100_000:
                self.memo[key] = w
        return w

    def of(self, t: Token) -> float:
        if not t.shown:
            return 0.0 if t.text else -0.5
        return self(t.key) * (t.n if t.text else 1)


def weights(pages: list[str]) -> Weights:
    """Weights from the shown words and the tags of labelled pages."""
    inside, outside = Counter(), Counter()
    for page in pages:
        for t in tokens(page):
            if t.shown:
                (inside if t.own else outside)[t.key] += t.n if t.text else 1
    return Weights(dict(inside), dict(outside))


def region(scores: Iterable[float]) -> tuple[int, int]:
    """The contiguous run with the greatest sum, the shortest first one of equals; (0, 0) if no sum is above zero."""
    best, best_at, total, start = 0.0, (0, 0), 0.0, 0
    for i, x in enumerate(scores):
        total += x
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, best_at = total, (start, i + 1)
    return best_at


def _spans(found: list[Token]) -> list[list[int]]:
    """Runs of tokens of elements of a doubtful kind."""
    spans, span = [], []
    for i, t in enumerate(found):
        if t.doubt:
            span.append(i)
        elif span:
            spans.append(span)
            span = []
    return spans + [span] if span else spans


def scored(found: list[Token], w: Weights) -> tuple[list[float], list[list[int]]]:
    """Scores of the tokens, and the texts of each doubtful run that scores below zero; such a run costs GAP at most."""
    scores, doubtful = [w.of(t) for t in found], []
    if sum(not t.own and t.key.removeprefix("<") in OWN for t in found if not t.text) == 1:
        scores = [max(x, WITHIN * t.n if t.text else TAG_WITHIN) if t.own and t.shown and not t.doubt else x for x, t in zip(scores, found, strict=True)]
    for span in _spans(found):
        texts = [i for i in span if found[i].text and found[i].shown]
        if sum(scores[i] for i in texts) < 0:
            doubtful.append(texts)
            if sum(scores[i] for i in span) < -GAP:
                for i in span:
                    scores[i] = 0.0
                scores[span[0]] = -GAP
    return scores, doubtful


def _left_out(found: list[Token], scores: list[float], doubtful: list[list[int]], a: int, b: int) -> set[int]:
    """Doubtful texts in the run a to b that have content on both sides."""
    good = [i for i in range(a, b) if found[i].text and found[i].shown and scores[i] > 0]
    return {i for texts in doubtful for i in texts if good and good[0] < i < good[-1]}


def main_text(page: str, w: Weights) -> str:
    found = tokens(page)
    scores, doubtful = scored(found, w)
    a, b = region(scores)
    drop = _left_out(found, scores, doubtful, a, b)
    blocks, held = [], []

    def end():
        if block := " ".join(html.unescape("".join(held)).split()):
            blocks.append(block)
        held.clear()

    for i in range(a, b):
        t = found[i]
        if t.text:
            if t.shown and i not in drop:
                held.append(t.text)
        elif (name := t.key.lstrip("</")) in BLOCK:
            end()
        elif name == "br":
            held.append(" ")
    end()
    return "\n".join(blocks)


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", rows: int = LABELLED) -> Weights:
    """Weights from pages with exactly one <article> or <main>, at most `rows` of them, drawn by a hash of the page."""
    marks = F.size(F.split(F.col(html_col), r"(?i)<(?:article|main)[\s>]")) - 1
    own = pages.where(marks == 1).select(F.col(html_col).alias("html"))
    return weights([r["html"] for r in bounded_sample(own, rows, "html").collect()])


def extract(pages: DataFrame, w: Weights, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Rows (id, text, n_chars), one for each row of pages."""
    id_type = pages.select(id_col).schema[0]
    sent = pages.sparkSession.sparkContext.broadcast((w.inside, w.outside))

    def run(batches):
        own = Weights(*sent.value)
        for part, texts in text_batches(batches):
            out = [main_text(t, own) for t in texts]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=[id_col, "text", "n_chars"])

    return pages.select(id_col, F.col(html_col).alias("text")).mapInArrow(run, f"`{id_col}` {id_type.dataType.simpleString()}, text string, n_chars long")
