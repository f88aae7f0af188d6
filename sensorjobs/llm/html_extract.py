"""Main text of web pages from flat text blocks and a trained decision tree.

A page is cut at block tags into flat text blocks. Each block has its word count and link density,
those of the blocks before and after it, and what it stands in: the main part, an element that is
furniture by its tag, one that is by its name, a heading, a paragraph (also for both neighbours, and as
a share of the page's unlinked words), whether it stands outside a main part that holds a third of these words, how many of its words are
those of notices and offers, and whether it follows a heading of reader comments. A decision tree, trained here by Spark on
the small labelled table below, keeps or drops each block. Tags and names are features like the others: they decide only where the labelled pages say so.
Blocks join in page order.

Defined results
---------------
* null or empty html: empty text; pages without text: empty text; whole pages are read;
* broken markup: unclosed elements end with their parent, stray end tags are ignored, an unfinished
  tag or comment at the end of the page is no text; quotes count only right after an equals sign;
* hidden elements (``hidden``, ``display:none``) and what no browser shows as text are no text;
* repeated rows each get their own result; empty table: empty result;
* other columns are kept if named in ``keep``; those named like the operator's give way.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorjobs.llm.common import map_texts

#: Attributes: a quoted value begins right after the equals sign; other quotes are plain characters.
ATTRS = r"(?:[^>=]|=(?:\s*(?:\"[^\"]*\"|'[^']*'))?)*+"
#: A comment, raw-text element, declaration or tag.
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>script|style|textarea|title)\b{ATTRS}(?:>|\Z).*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>{ATTRS})(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)",
    re.S | re.I,
)
NAMED = re.compile(r"(?<![^\s\"'/])(class|id|role|style|hidden)(?![^\s=/])\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
#: Elements whose start or end begins a new block.
BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that are followed on a stack, since a name or tag of theirs may matter for what they enclose.
NEST = frozenset("article aside blockquote button details dialog div dl fieldset figure footer form header iframe li main math menu nav noscript object ol p section select span svg table td template th ul".split())
#: Elements of which another of the same name cannot stand inside: its start ends the open one.
SINGLE = frozenset("p li td th".split())
UNSEEN = frozenset("button iframe math noscript object select svg template".split())
PARAGRAPH = frozenset("blockquote caption dd dt figcaption li p pre td th".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN = frozenset(("article", "main"))
FURNITURE_TAGS = frozenset("nav footer header aside form menu dialog fieldset".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
#: Words of class and id names that hint at page furniture.
FURNITURE_WORDS = frozenset(
    "ad ads adv advert advertisement advertising sponsor sponsored promo promotion banner sidebar comment comments reply replies respond disqus nav navbar navigation menu breadcrumb breadcrumbs footer header masthead topbar cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended widget toolbar pagination pager search form copyright disclaimer outbrain taboola".split()
)
#: Words that, at the end of a name, say that it holds content, and words that negate the one after them.
CONTENT_WORDS = frozenset("article body content entry page post story text wrapper container layout".split())
WITHOUT_WORDS = frozenset("with without has no hide show".split())
#: Words of notices, offers and calls to act, in lower case.
CUE_WORDS = frozenset(
    "accept advertisement agree angebot anmelden anzeige buy cart cookie cookies copyright discount follow gratis kaufen newsletter offer offre oferta price privacy publicidad publicité purchase register rights reserved sale share shop sign sponsored subscribe subscription suscríbete terms abonnieren abonnez".split()
)
WORD = re.compile(r"[^\W\d_]+")
#: A heading of reader comments.
COMMENTS = re.compile(r"\W*(?:\d+\s+|reader\s+|leave\s+a\s+|post\s+a\s+|user\s+)?(?:comments?|repl(?:y|ies)|responses?|kommentare?|commentaires?|comentarios?)\W*(?:\d+\W*)?", re.I)
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "in_main", "tag", "name", "heading", "paragraph", "paragraph_before", "paragraph_after", "paragraph_share", "outside", "cues", "comments")


def is_furniture(name: str) -> bool:
    """Whether a class or id name hints at furniture: by one of its words, unless the word is negated or the name ends with a word of content."""
    words = [w.lower() for w in NAME_WORDS.findall(name)]
    if not words or words[-1] in CONTENT_WORDS:
        return False
    return any(w in FURNITURE_WORDS and (k == 0 or words[k - 1] not in WITHOUT_WORDS) for k, w in enumerate(words))


class Page:
    """Walks the markup of one page and gathers its blocks.

    ``names`` are the elements with a hinting name that enclose the current position. One that also
    encloses the main part (a ``main`` element, or the first heading with 50 words or more) is part of the layout.
    """

    def __init__(self, page: str) -> None:
        self.blocks: list[tuple[str, int, int, bool, int, tuple[int, ...], bool, bool]] = []
        self.parts: list[str] = []
        self.anchored: list[str] = []
        self.stack: list[tuple[str, tuple]] = []
        self.open: Counter = Counter()
        self.main = self.hidden = self.anchor = self.heading = self.paragraph = False
        self.tag = 0
        self.names: tuple[int, ...] = ()
        self.hints = 0
        self.layout: set[int] = set()
        self.first_headings: set[int] = set()
        at = 0
        for m in MARKUP.finditer(page):
            if m.start() > at:
                self._text(page[at : m.start()])
            at = m.end()
            if m["name"]:
                self._tag(m["name"].lower(), bool(m["end"]), m["attrs"] or "")
            elif m["raw"] and m["raw"].lower() in ("title", "textarea"):
                self._close()
        if at < len(page):
            self._text(page[at:])
        self._close()
        if self.first_headings:
            words = Counter()
            for b in self.blocks:
                for k in b[5]:
                    words[k] += b[1]
            self.layout |= {k for k in self.first_headings if words[k] >= 50}

    def _text(self, text: str) -> None:
        if not self.hidden:
            self.parts.append(text)
            if self.anchor:
                self.anchored.append(text)

    def _close(self) -> None:
        if self.parts:
            text = " ".join(entities.unescape("".join(self.parts)).split())
            if text:
                linked = len(entities.unescape(" ".join(self.anchored)).split())
                self.blocks.append((text, text.count(" ") + 1, linked, self.main, self.tag, self.names, self.heading, self.paragraph))
            self.parts.clear()
            self.anchored.clear()

    def _state(self) -> tuple:
        return self.main, self.tag, self.names, self.hidden, self.paragraph

    def _restore(self, k: int) -> None:
        """End the element at ``k`` of the stack and all inside it."""
        self.main, self.tag, self.names, self.hidden, self.paragraph = self.stack[k][1]
        for name, _ in self.stack[k:]:
            self.open[name] -= 1
        del self.stack[k:]

    def _tag(self, name: str, ends: bool, attrs: str) -> None:
        if name == "a":
            self.anchor = not ends
        if name in BLOCK:
            self._close()
            if name in HEADINGS:
                self.heading = not ends
                if name == "h1" and not ends and not self.main:
                    self.first_headings.update(self.names)
            elif name != "br":
                self.heading = False
            if not ends and name != "br" and self.stack and self.stack[-1][0] == "p":
                self._restore(len(self.stack) - 1)
        if name not in NEST:
            return
        if ends:
            if self.open[name]:
                k = len(self.stack) - 1
                while self.stack[k][0] != name:
                    k -= 1
                if self.stack[k][1][1:4] != self._state()[1:4]:
                    self._close()
                self._restore(k)
                if name != "span":
                    self.anchor = False
        elif not attrs.endswith("/"):
            if name in SINGLE and self.stack and self.stack[-1][0] == name:
                self._restore(len(self.stack) - 1)
            self.stack.append((name, self._state()))
            self.open[name] += 1
            self._enter(name, attrs)

    def _enter(self, name: str, attrs: str) -> None:
        main, tag, hint, hidden = name in MAIN, name in FURNITURE_TAGS, False, name in UNSEEN
        for m in NAMED.finditer(attrs) if attrs else ():
            key, value = m[1].lower(), (m[2] or "").strip("\"'")
            if key in ("class", "id"):
                hint = hint or any(is_furniture(n) for n in value.split())
            elif key == "role":
                main = main or value.lower() in ("main", "article")
                tag = tag or value.lower() in FURNITURE_ROLES
            elif key == "style":
                hidden = hidden or "display:none" in value.replace(" ", "").lower()
            else:
                hidden = hidden or value.lower() not in ("false", "until-found")
        if hint or hidden or tag:
            self._close()
        if main and name != "article":
            self.layout.update(self.names)
            self.tag = 0
        self.main = self.main or main
        if tag:
            self.tag = 1 if self.main else 2
        if hint:
            self.names = (*self.names, self.hints)
            self.hints += 1
        self.hidden = self.hidden or hidden
        if name != "span":
            self.paragraph = name in PARAGRAPH


def blocks_of(page: str) -> list[tuple[str, tuple[float, ...]]]:
    """The page's text blocks with their features, in order."""
    walked = Page(page)
    found = walked.blocks
    none = ("", 0, 0, False, 0, (), False, False)
    told, inside = Counter(), 0
    for b in found:
        if not b[6] and 2 * b[2] <= b[1]:
            told[b[7]] += b[1]
            inside += b[1] * b[3]
    whole = inside > 0 and 3 * inside >= told.total()
    share = told[True] / max(1, told.total())
    out, comments = [], False
    for k, b in enumerate(found):
        if b[6]:
            comments = COMMENTS.fullmatch(b[0]) is not None
        cues = sum(w.lower() in CUE_WORDS for w in WORD.findall(b[0])) / b[1]
        before, after = found[k - 1] if k else none, found[k + 1] if k + 1 < len(found) else none
        named = any(n not in walked.layout for n in b[5])
        near = [x for o in (before, after) for x in (float(o[1]), o[2] / max(1, o[1]))]
        out.append((b[0], (float(b[1]), b[2] / b[1], *near, float(b[3]), float(b[4]), float(named), float(b[6]), float(b[7]), float(before[7]), float(after[7]), share, float(whole and not b[3]), cues, float(comments))))
    return out


#: Marks at the first word of a labelled block.
GOOD, BAD = "\ue000", "\ue001"
#: Names of furniture in the labelled pages.
LABELLED_NAMES = ("ad", "promo-box", "sidebar", "comments", "site-footer", "cookieNotice", "newsletter", "share", "related-links", "nav", "topbar", "widget")


def labelled_page(rng: random.Random) -> str:
    """A page of which every block begins with its label. Only counts, tags and names matter, so all words are the same."""
    def words(mark: str, low: int, high: int, cues: float = 0.02) -> str:
        return mark + " ".join("price" if rng.random() < cues else "w" for _ in range(rng.randint(low, high)))

    def notice(low: int, high: int) -> str:
        """A notice or offer: some of its words say so."""
        return words(BAD, low, high, 0.3) + " buy"

    def linked(mark: str, low: int, high: int) -> str:
        return f"<a href=x>{words(mark, low, high)}</a>"

    def framed(inside: str, plain: bool) -> str:
        """Furniture in an element that says so by its tag or name; or, if ``plain``, in one that may not."""
        kind = rng.choice(("tag", "name", "name", "plain") if plain else ("tag", "name"))
        if kind == "tag":
            t = rng.choice(("nav", "footer", "aside", "header", "form"))
            return f"<{t}>{inside}</{t}>"
        return f"<div class='{rng.choice(LABELLED_NAMES)}'>{inside}</div>" if kind == "name" else f"<div>{inside}</div>"

    def furniture() -> str:
        kind = rng.randrange(5)
        if kind == 0:
            return framed("<ul>" + "".join(f"<li>{linked(BAD, 1, 4)}</li>" for _ in range(rng.randint(2, 8))) + "</ul>", True)
        if kind == 1:
            return framed(linked(BAD, 1, 3) + " | ".join(linked("", 1, 3) for _ in range(rng.randint(1, 6))), True)
        if kind == 2:
            return framed(words(BAD, 1, 6), True)
        if kind == 3:
            return framed(words(BAD, 3, 40), False) if rng.random() < 0.6 else f"<div>{notice(3, 40)}</div>"
        return framed("".join(f"<p>{words(BAD, 2, 40)}</p>" for _ in range(rng.randint(1, 3))), False)

    where = rng.choice(("article", "article", "main", "div", "div", "story"))
    style = rng.choice(("p", "p", "p", "div"))
    known = where in ("article", "main")

    def paragraph(first: bool, last: bool) -> str:
        low, high = rng.choice(((1, 7), (8, 30), (30, 120)))
        if style == "div" and not known and (first or last):
            low, high = 20, 120
        text = words(GOOD, low, high)
        if high > 7 and rng.random() < 0.2:
            text += " " + linked("", 1, 3) + " w w w w"
        if rng.random() < 0.1:
            text += f"<br>{words(GOOD, 4, 30)}"
        return f"<{style}>{text}</{style}>"

    def part() -> str:
        """What articles hold besides paragraphs and plain lists."""
        text, short = words(GOOD, 3, 40), words(GOOD, 1, 8)
        kind = rng.randrange(10)
        if kind == 0:
            return f"<figure><img src=x><figcaption>{words(GOOD, 1, 25)}</figcaption></figure>"
        if kind == 1:
            return f"<figcaption>{words(GOOD, 1, 25)}</figcaption>"
        if kind == 2:
            return f"<pre>{text}</pre>" if rng.random() < 0.5 else f"<pre><code>{text}</code></pre>"
        if kind == 3:
            return f"<details><summary>{short}</summary><p>{text}</p></details>"
        if kind == 4:
            return f"<blockquote>{text}</blockquote>" if rng.random() < 0.5 else f"<blockquote><p>{text}</p></blockquote>"
        if kind == 5:
            return "<table>" + "".join(f"<tr><td>{words(GOOD, 1, 4)}</td><td>{words(GOOD, 1, 4)}</td></tr>" for _ in range(rng.randint(1, 4))) + "</table>"
        if kind == 6:
            tag = rng.choice(("h2", "h3"))
            return f"<{tag}>{linked(GOOD, 1, 6) if rng.random() < 0.6 else short}</{tag}>"
        if kind == 7:
            items = [f"<li>{words(GOOD, 1, 12)}</li>" for _ in range(rng.randint(2, 5))]
            items[rng.randrange(len(items))] = f"<li>{linked(GOOD, 1, 5)}</li>"
            return f"<ul>{''.join(items)}</ul>"
        return f"<div>{words(GOOD, 3, 60, 0.01)}</div>"

    n = rng.randint(1, 8)
    inside = [paragraph(k == 0, k == n - 1) for k in range(n)]
    if not known and style == "p" and n == 1:
        inside = [f"<p>{words(GOOD, 20, 120)}</p>"]
    if rng.random() < 0.2:
        inside.insert(rng.randrange(n) + 1, "<ul>" + "".join(f"<li>{words(GOOD, 1, 9)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
    if known:
        if rng.random() < 0.3:
            inside.insert(rng.randrange(len(inside) + 1), f"<div class='{rng.choice(LABELLED_NAMES)}'>{words(BAD, 2, 40)}</div>")
        if rng.random() < 0.25:
            inside.insert(rng.randrange(len(inside) + 1), f"<div>{notice(3, 25)}</div>")
        for _ in range(rng.choice((0, 0, 1, 1, 2))):
            inside.insert(rng.randrange(len(inside) + 1), part())
        if rng.random() < 0.2:
            inside.append(f"<section class=comments>{''.join(f'<article><p>{words(BAD, 1, 40)}</p></article>' for _ in range(rng.randint(1, 4)))}</section>")
        if rng.random() < 0.2:
            tag = rng.choice(("p", "div"))
            inside.append(f"<h3>{BAD}{rng.choice(('3 Comments', 'Comments', 'Leave a reply'))}</h3>" + "".join(f"<{tag}>{words(BAD, 1, 40)}</{tag}>" for _ in range(rng.randint(1, 4))))
        if rng.random() < 0.2:
            inside.append(f"<footer>{words(BAD, 2, 12)}</footer>")
    if rng.random() < 0.3:
        inside.insert(rng.randrange(len(inside)) + 1, f"<p>{words(BAD, 2, 3)}: {linked('', 4, 9)}, {linked('', 4, 9)}</p>")
    if rng.random() < 0.7:
        title = f"<h1>{words(GOOD, 1, 12)}</h1>"
        inside.insert(0, f"<header>{title}</header>" if known and rng.random() < 0.3 else title)
    open_, close = {"div": ("<div>", "</div>"), "story": ("<div class='story-body'>", "</div>")}.get(where, (f"<{where}>", f"</{where}>"))
    # Where the page names its main part, what stands outside is furniture, whatever it looks like.
    plain = lambda: rng.choice((f"<div>{words(BAD, 3, 40)}</div>", f"<p>{words(BAD, 2, 40)}</p>")) if known and rng.random() < 0.4 else ""
    open_, close = plain() + open_, close + plain()
    page = "".join(furniture() for _ in range(rng.randint(0, 4))) + open_ + "".join(inside) + close + "".join(furniture() for _ in range(rng.randint(0, 4)))
    return f"<div class='layout sidebar-{rng.choice(('left', 'right'))}'>{page}</div>" if where == "main" and rng.random() < 0.3 else page


def labelled_blocks(pages: int = 800, seed: int = 1) -> list[tuple[float, ...]]:
    """The labelled table: feature rows with their label (1: main text) of the blocks of ``pages`` labelled pages."""
    rng = random.Random(seed)
    found = [b for _ in range(pages) for b in blocks_of(labelled_page(rng))]
    return [(*features, 1.0 if text[0] == GOOD else 0.0) for text, features in found]


def train(spark: SparkSession, depth: int = 10) -> tuple:
    """The decision tree as nested tuples (feature, threshold, low, high); leaves are booleans."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler

    table = spark.createDataFrame(labelled_blocks(), [*FEATURES, "label"]).coalesce(1)
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(table)
    model = DecisionTreeClassifier(maxDepth=depth, maxBins=64, minInstancesPerNode=2, minInfoGain=1e-4, seed=1).fit(rows)

    def walk(node) -> tuple | bool:
        if node.subtreeDepth() == 0:
            return node.prediction() > 0.5
        split = node.split()
        return (split.featureIndex(), split.threshold(), walk(node.leftChild()), walk(node.rightChild()))

    return walk(model._java_obj.rootNode())


def decide(tree, features: tuple[float, ...]) -> bool:
    """Follow the tree."""
    while not isinstance(tree, bool):
        k, threshold, low, high = tree
        tree = low if features[k] <= threshold else high
    return tree


def main_text(page: bytes | None, tree) -> str:
    """The page's main blocks, joined by spaces."""
    if not page:
        return ""
    return " ".join(text for text, features in blocks_of(page.decode("utf-8", "replace")) if decide(tree, features))


def extract(pages: DataFrame, keep: list[str], html: str = "html", tree=None) -> DataFrame:
    """``keep`` columns and ``text``, ``n_chars``; no shuffle. ``tree`` is trained here if not given."""
    tree = train(pages.sparkSession) if tree is None else tree

    def run(texts: list[bytes | None]) -> dict[str, list]:
        out = [main_text(t, tree) for t in texts]
        return {"text": out, "n_chars": [len(t) for t in out]}

    return map_texts(pages, [c for c in keep if c.lower() not in ("text", "n_chars")], html, run, "text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages, ["page_id", "url"]).select("page_id", "url", "text", "n_chars")
