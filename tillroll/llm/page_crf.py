"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is parsed into a tree of elements, unclosed ones included; each run of
text between two block borders is a leaf block. A block is described by its own
and its ancestors' tags, roles, classes and ids, and by its text (length, link
share, punctuation, marks such as a copyright sign). The chain labels all blocks
of a page together, content or not, and Viterbi decodes the best labelling.

The weights are fitted by maximum likelihood on labelled pages: a bounded number
that ``labelled_pages`` composes, with the usual page furniture around articles
under many markups, and ``bare_pages``, with little or no markup; their labels
are known because each block was written as one or the other.

Text: character references decoded, white space inside a block one space (a line
break element too), trimmed; content blocks in page order joined by a blank line.
Scripts, styles, templates, comments and markup are never text.

Defined results: a null or empty page, or one without content, has the empty
text; broken markup is parsed as far as it goes; repeated rows are extracted
each; an empty table gives an empty result; extra columns are ignored; pages are
read whole, whatever their length.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.llm.common import table

TRAINING_PAGES = 800
TRAINING_BARE_PAGES = 480

# Elements whose borders do not end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is not markup, up to their end tag.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("script style head title template noscript iframe object svg math xmp noembed noframes textarea select option audio video canvas".split())
# An element of the key's kind is closed when one of the values opens.
_PARAGRAPH_ENDS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
_ENDED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "option": frozenset(["option", "optgroup"]),
    "p": _PARAGRAPH_ENDS,
    "head": frozenset(["body"]) | _PARAGRAPH_ENDS,
}
_STOPS = frozenset("table ul ol dl select body html article section div main aside nav header footer form td th".split())

_MARKUP = re.compile(
    r"<!--.*?(?:--!?>|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_SPACE = re.compile(r"\s+")

# --- features ---------------------------------------------------------------------------

# Parts of class names, ids and roles, by what they say about a block.
NAMES = {
    "ad": "ad ads adv advert advertisement advertising adsense banner sponsor sponsored promo promotion promoted outbrain taboola dfp",
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc tabs toolbar topbar skip",
    "head": "header masthead logo branding sitename",
    "foot": "footer foot colophon copyright legal contentinfo bottom",
    "side": "sidebar side aside widget related recommended recommendations complementary more popular trending teaser rail secondary",
    "comment": "comment comments commentlist reply replies respond disqus discussion responses reader",
    "notice": "cookie cookies consent notice gdpr popup modal overlay dialog alert alertdialog warning message newsletter subscribe subscription signup paywall toast disclaimer",
    "share": "share sharing social follow tags tag meta byline author rating",
    "form": "form search searchbox login signin register input contact",
    "content": "content article post entry story main body text maintext articlebody postbody prose page",
    "hidden": "hidden invisible visuallyhidden screenreader sronly",
}
_NAMED = {word: name for name, words in NAMES.items() for word in words.split()}
_TAGS = "nav header footer aside form article main figure figcaption table ul ol section blockquote pre button label dialog details address menu fieldset a".split()
_OWN = "p h1 h2 h3 h4 h5 h6 li td th div body section article main blockquote pre dd dt figcaption span button label legend summary caption address header footer nav aside form root".split()
_TEXT = (
    ["bias"]
    + [f"words<{n}" for n in (2, 5, 10, 20, 40)]
    + ["long", "links>0", "links>0.5", "links>0.9", "ends", "no_ends", "commas", "copyright", "pipes", "upper", "digits", "furniture", "first", "last", "only"]
)
FEATURES = (
    [f"in:{t}" for t in _TAGS] + [f"named:{n}" for n in NAMES] + [f"own:{t}" for t in _OWN] + [f"text:{t}" for t in _TEXT] + ["in:article>header", "in:body>header"]
)
_INDEX = {name: i for i, name in enumerate(FEATURES)}
_FURNITURE = re.compile(
    r"all rights reserved|cookie|subscribe|newsletter|sign ?(?:in|up)|log ?in|privacy|terms of|read more|share (?:this|on)|"
    r"posted by|leave a (?:comment|reply)|advertisement|sponsored|follow us|powered by|related (?:articles|posts)|skip to",
    re.IGNORECASE,
)


@lru_cache(maxsize=4096)
def _names_of(words: str) -> frozenset[str]:
    parts = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", words).lower())
    joined = {a + b for a, b in zip(parts, parts[1:])}
    return frozenset(_NAMED[p] for p in {*parts, *joined} if p in _NAMED)


@lru_cache(maxsize=4096)
def _described(tag: str, attributes: str) -> tuple[frozenset[int], bool]:
    """What an element tells about the blocks below it, and whether it hides them."""
    found, hidden = set(), tag in UNSEEN
    if tag in _TAGS:
        found.add(_INDEX[f"in:{tag}"])
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id", "role"):
            found |= {_INDEX[f"named:{n}"] for n in _names_of(value)}
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            hidden = True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            hidden = True
    return frozenset(found), hidden


@dataclass(slots=True)
class Block:
    text: str
    linked: int  # characters inside links
    own: str
    above: frozenset[int]


def parse(page: str) -> list[Block]:
    """The leaf blocks of a page, in order."""
    nothing: frozenset[int] = frozenset()
    # tag, features from the root down to here, hidden
    stack: list[tuple[str, frozenset[int], bool]] = [("", nothing, False)]
    blocks: list[Block] = []
    parts: list[str] = []
    linked, links = 0, 0
    owner = stack[0]

    def border() -> None:
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip()
            if text:
                blocks.append(Block(text, linked, owner[0], owner[1]))
            parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked, owner
        if raw and not stack[-1][2]:
            text = entities.unescape(raw) if "&" in raw else raw
            if not parts:
                owner = next((e for e in reversed(stack) if e[0] not in INLINE), stack[0])
            parts.append(text)
            if links:
                linked += len(text.strip())

    def pop_to(n: int) -> None:
        nonlocal links
        while len(stack) > n:
            tag = stack.pop()[0]
            links -= tag == "a"

    at, end = 0, len(page)
    while at < end:
        m = _MARKUP.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, closing, attributes = tag.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        inline = tag in INLINE
        if not inline:
            border()
        if closing:
            for n in range(len(stack) - 1, 0, -1):
                if stack[n][0] == tag:
                    pop_to(n)
                    break
                # An inline end tag does not close the blocks around it.
                if inline and stack[n][0] not in INLINE:
                    break
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in VOID:
            continue
        if not inline:
            for n in range(len(stack) - 1, 0, -1):
                open_tag = stack[n][0]
                if tag in _ENDED_BY.get(open_tag, ()):
                    pop_to(n)
                    if open_tag != "td" and open_tag != "th":
                        break
                elif open_tag in _STOPS:
                    break
        here, hides = _described(tag, attributes)
        above, hidden = stack[-1][1], stack[-1][2] or hides
        if tag == "header":
            inside = _INDEX["in:article"] in above or _INDEX["in:main"] in above
            here = here | {_INDEX["in:article>header" if inside else "in:body>header"]}
        stack.append((tag, above | here if here - above else above, hidden))
        links += tag == "a"
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(page, at)
            at = close.start() if close else end
    border()
    return blocks


def block_features(blocks: list[Block]) -> list[list[int]]:
    out = []
    for n, b in enumerate(blocks):
        words = b.text.count(" ") + 1
        share = b.linked / len(b.text)
        f = set(b.above)
        if (b.own or "root") in _OWN:
            f.add(_INDEX[f"own:{b.own or 'root'}"])

        def say(name: str, holds: bool = True) -> None:
            if holds:
                f.add(_INDEX[f"text:{name}"])

        say("bias")
        for most in (2, 5, 10, 20, 40):
            say(f"words<{most}", words < most)
        say("long", words >= 40)
        say("links>0", share > 0)
        say("links>0.5", share > 0.5)
        say("links>0.9", share > 0.9)
        ends = b.text[-1] in ".!?…\"”»:;。"
        say("ends" if ends else "no_ends")
        say("commas", "," in b.text)
        say("copyright", "©" in b.text or "(c) " in b.text.lower())
        say("pipes", "|" in b.text or "·" in b.text or "»" in b.text[:-1])
        say("upper", b.text.isupper())
        say("digits", sum(c.isdigit() for c in b.text) * 4 > len(b.text))
        say("furniture", words < 40 and bool(_FURNITURE.search(b.text)))
        say("first", n == 0)
        say("last", n == len(blocks) - 1)
        say("only", len(blocks) == 1)
        out.append(sorted(f))
    return out


# --- the chain ------------------------------------------------------------------------------


@dataclass
class Chain:
    """Two labels, 0 furniture and 1 content: a weight per feature, and one per pair of labels."""

    weights: np.ndarray  # per feature, in favour of content
    steps: np.ndarray  # 2 x 2

    def decode(self, features: list[list[int]]) -> list[int]:
        """The most probable labelling (Viterbi). Of equally probable ones the one with less content."""
        score, back = np.zeros(2), []
        for n, f in enumerate(features):
            emit = np.array([0.0, self.weights[f].sum()])
            if n:
                ways = score[:, None] + self.steps
                back.append(ways.argmax(0))
                score = ways.max(0)
            score = score + emit
        if not features:
            return []
        labels = [int(score.argmax())]
        for step in reversed(back):
            labels.append(int(step[labels[-1]]))
        return labels[::-1]

    def extract(self, page: str | None) -> str:
        blocks = parse(page or "")
        labels = self.decode(block_features(blocks))
        return "\n\n".join(b.text for b, y in zip(blocks, labels) if y)


def fit_chain(pages: list[tuple[list[list[int]], list[int]]], rounds: int = 250, rate: float = 0.1, ridge: float = 0.02) -> Chain:
    """Maximum likelihood with a ridge, by gradients from the forward and backward sums."""
    longest = max(len(y) for _, y in pages)
    x = np.zeros((len(pages), longest, len(FEATURES)))
    y, there = np.zeros((len(pages), longest), int), np.zeros((len(pages), longest), bool)
    for p, (features, labels) in enumerate(pages):
        for n, (f, label) in enumerate(zip(features, labels)):
            x[p, n, f], y[p, n], there[p, n] = 1, label, True
    both = there[:, 1:]
    seen_steps = np.zeros((2, 2))
    np.add.at(seen_steps, (y[:, :-1][both], y[:, 1:][both]), 1)
    w, t = np.zeros(len(FEATURES)), np.zeros((2, 2))
    moments = [np.zeros_like(v) for v in (w, t, w, t)]

    def log_sum(a: np.ndarray, axis: int) -> np.ndarray:
        top = a.max(axis, keepdims=True)
        return (top + np.log(np.exp(a - top).sum(axis, keepdims=True))).squeeze(axis)

    for k in range(1, rounds + 1):
        emit = np.stack([np.zeros(there.shape), x @ w], -1)
        forward, backward = np.zeros_like(emit), np.zeros_like(emit)
        forward[:, 0] = emit[:, 0]
        for n in range(1, longest):
            moved = log_sum(forward[:, n - 1, :, None] + t, 1) + emit[:, n]
            forward[:, n] = np.where(there[:, n, None], moved, forward[:, n - 1])
        for n in range(longest - 2, -1, -1):
            moved = log_sum(t + (emit[:, n + 1] + backward[:, n + 1])[:, None, :], 2)
            backward[:, n] = np.where(there[:, n + 1, None], moved, 0)
        total = log_sum(forward[:, -1], 1)
        content = np.exp(forward[..., 1] + backward[..., 1] - total[:, None]) * there
        pairs = np.exp(
            forward[:, :-1, :, None] + t + (emit + backward)[:, 1:, None, :] - total[:, None, None, None]
        ) * both[..., None, None]
        slopes = [
            np.tensordot((y * there - content), x, 2) / len(pages) - ridge * w / 10,
            (seen_steps - pairs.sum((0, 1))) / len(pages) - ridge * t,
        ]
        for v, g, m, s in zip((w, t), slopes, moments[:2], moments[2:]):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            v += rate * (m / (1 - 0.9**k)) / (np.sqrt(s / (1 - 0.99**k)) + 1e-8)
    return Chain(w, t)


# --- labelled pages ----------------------------------------------------------------------------


class Writer:
    """Made-up words and sentences."""

    LETTERS = "etaoinshrdlucmfwypvbgk"

    def __init__(self, pick: random.Random):
        self.pick = pick

    def word(self) -> str:
        return "".join(self.pick.choice(self.LETTERS) for _ in range(self.pick.choice((2, 3, 4, 5, 6, 8))))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.pick.randint(low, high)))

    def sentence(self) -> str:
        text = self.words(3, 14)
        text = text.replace(" ", ", ", 1) if self.pick.random() < 0.3 else text
        return text.capitalize() + self.pick.choice("...!?")

    def prose(self, low: int = 1, high: int = 7) -> str:
        return " ".join(self.sentence() for _ in range(self.pick.randint(low, high)))


BARE_KINDS = ("paragraph", "plain", "breaks", "paragraphs", "linked", "furniture")


def bare_pages(n: int, seed: int = 1) -> list[tuple[str, str, list[str]]]:
    """Kind, page and main text blocks of pages with little or no markup, kinds in turn."""
    pick = random.Random(seed)
    w = Writer(pick)

    def link(text: str) -> str:
        return f"<a href='/{w.word()}'>{text}</a>"

    def furniture() -> str:
        return pick.choice((
            f"<nav>{link(w.words(1, 3))}</nav>",
            f"<nav><ul><li>{link(w.words(1, 2))}<li>{link(w.words(1, 2))}</ul></nav>",
            f"<div class='menu'>{link(w.words(1, 2))} | {link(w.words(1, 2))}</div>",
            f"<footer>&copy; {w.words(1, 3)}</footer>",
            f"<footer><p>{w.prose(1, 2)}</p></footer>",
            f"<div class='cookie-notice'><p>{w.prose(1, 2)}</p></div>",
            f"<aside><h3>{w.words(1, 3)}</h3><p>{w.prose(1, 2)}</p></aside>",
            f"<form><label>{w.words(1, 3)}</label><button>{w.word()}</button></form>",
        ))

    out = []
    for nth in range(n):
        kind = BARE_KINDS[nth % len(BARE_KINDS)]
        main = [w.prose() for _ in range(pick.choice((1, 2, 4)))]
        box = pick.choice(("article", "main", "div class='content'", "div id=main", "section class='post'"))
        if kind == "paragraph":
            main = [pick.choice((w.prose(), w.sentence(), w.words(1, 4)))]
            page = f"<{box}><p>{main[0]}</p></{box.split()[0]}>"
        elif kind == "plain":
            main = [" ".join(main)]
            page = main[0] if pick.random() < 0.6 else f"<html><body>{main[0]}</body></html>"
        elif kind == "breaks":
            lines = "<br><br>".join(main)
            main = [" ".join(main)]
            page = f"<{box}>{lines}</{box.split()[0]}>" if pick.random() < 0.6 else lines
        elif kind == "paragraphs":
            page = "".join(f"<p>{t}</p>" for t in main)
            page = f"<body>{page}</body>" if pick.random() < 0.5 else page
        elif kind == "linked":
            main = [w.words(2, 6).capitalize(), *main, pick.choice((w.sentence(), w.words(1, 5)))]
            pick.shuffle(main)
            whole = pick.randrange(len(main))
            page = "".join(f"<p>{link(t) if i == whole else t}</p>" for i, t in enumerate(main))
            page = f"<article>{page}</article>"
        else:
            main, page = [], furniture() + (furniture() if pick.random() < 0.5 else "")
        if kind in ("paragraph", "breaks", "linked") and pick.random() < 0.4 and page.startswith("<"):
            page = f"{furniture()}{page}" if pick.random() < 0.5 else f"{page}{furniture()}"
        out.append((kind, page, main))
    return out


def labelled_pages(n: int, seed: int = 1) -> list[tuple[str, list[str]]]:
    """Pages and the blocks that are their main text, composed from common page parts."""
    pick = random.Random(seed)
    writer = Writer(pick)
    word, words, sentence, prose = writer.word, writer.words, writer.sentence, writer.prose

    def classed(names: str) -> str:
        return f' {pick.choice(("class", "class", "id"))}="{pick.choice(names.split())}"' if names else ""

    def links(k: int) -> str:
        return "".join(f'<li><a href="/{word()}">{words(1, 3)}</a></li>' for _ in range(k))

    def box(tag: str, names: str, inside: str) -> str:
        return f"<{tag}{classed(names)}>{inside}</{tag}>"

    def menu() -> str:
        inside = f"<ul>{links(pick.randint(3, 8))}</ul>"
        return box("nav", "", inside) if pick.random() < 0.6 else box("div", "menu navbar nav breadcrumb main-nav pagination", inside)

    def top() -> str:
        title = pick.choice((f"<h1>{words(1, 4)}</h1>", f"<h1>{words(1, 3).capitalize()}</h1>", f"<a href='/'>{words(1, 2)}</a>", f"<p>{words(2, 6)}</p>"))
        return box("header", "", title + (menu() if pick.random() < 0.5 else "")) if pick.random() < 0.6 else box("div", "header masthead site-header logo topbar", title)

    def advert() -> str:
        return box(pick.choice(("div", "div", "aside", "section")), "ad ads advert banner sponsored promo ad-slot", pick.choice(("", "<p>")) + prose(1, 2))

    def notice() -> str:
        say = pick.choice((f"We use cookies. {sentence()}", prose(1, 2), f"Subscribe to our newsletter {words(1, 4)}"))
        return box("div", "cookie-banner notice consent popup newsletter modal alert", f"<p>{say}</p><button>{words(1, 2)}</button>")

    def side() -> str:
        inside = f"<h3>{words(1, 3)}</h3>" + (f"<ul>{links(4)}</ul>" if pick.random() < 0.5 else f"<p>{prose(1, 3)}</p>")
        return box("aside", "", inside) if pick.random() < 0.5 else box("div", "sidebar related widget side-column recommended", inside)

    def form() -> str:
        return f'<form{classed("search login signup contact-form")}><label>{words(1, 3)}</label><p>{sentence()}</p><button>{words(1, 2)}</button></form>'

    def comments() -> str:
        each = "".join(f'<{t}{classed("comment reply")}><b>{word()}</b><p>{prose(1, 4)}</p></{t}>' for t in [pick.choice(("div", "li", "article"))] * pick.randint(1, 5))
        return box(pick.choice(("section", "div", "ol")), "comments comment-list disqus_thread responses discussion", f"<h3>{words(1, 2)}</h3>{each}")

    def share() -> str:
        return box("div", "share social tags sharing post-meta", " ".join(f"<a href='#'>{word()}</a>" for _ in range(3)))

    def bottom() -> str:
        say = pick.choice((f"&copy; {word()}.example &middot; {prose(1, 2)}", f"© 2020 {words(1, 4)}. All rights reserved.", f"<p>{prose(1, 2)}</p>", f"<ul>{links(3)}</ul>"))
        return box("footer", "", say) if pick.random() < 0.7 else box("div", "footer site-footer colophon copyright legal", say)

    out = []
    for _ in range(n):
        main: list[str] = []

        def content(tag: str, text: str, close: bool = True) -> str:
            main.append(text)
            shown = text
            if pick.random() < 0.3:
                w = text.split(" ")
                k = pick.randrange(len(w))
                w[k] = pick.choice((f"<b>{w[k]}</b>", f"<a href='/x'>{w[k]}</a>", f"<em>{w[k]}</em>"))
                shown = " ".join(w)
            return f"<{tag}>{shown}" + (f"</{tag}>" if close else "")

        body = content("h1", words(2, 9).capitalize() + pick.choice(("", "."))) if pick.random() < 0.9 else ""
        if pick.random() < 0.25:
            body = f"<header>{body}</header>"
        for _ in range(pick.choice((1, 2, 3, 5, 8, 12))):
            r = pick.random()
            if r < 0.62:
                body += content("p", prose(), close=pick.random() < 0.85)
            elif r < 0.70:
                body += content("p", words(1, 3).capitalize() + ".")
            elif r < 0.76:
                body += content(pick.choice(("h2", "h3")), words(1, 6).capitalize())
            elif r < 0.81:
                body += "<ul>" + "".join(content("li", pick.choice((sentence(), words(1, 5)))) for _ in range(3)) + "</ul>"
            elif r < 0.84:
                body += content("blockquote", prose(1, 3))
            elif r < 0.87:
                body += "<table><tr>" + "".join(content("td", words(1, 3)) for _ in range(3)) + "</tr></table>"
            elif r < 0.91:
                body += advert()
            elif r < 0.94:
                body += share()
            elif r < 0.97:
                body += side()
            else:
                body += notice()
        if pick.random() < 0.2:
            body += pick.choice((comments, share, form))()
        r = pick.random()
        if r < 0.5:
            article = f"<article{classed('' if pick.random() < 0.6 else 'post entry story')}>{body}</article>"
        elif r < 0.65:
            article = f"<main>{body}</main>"
        elif r < 0.9:
            article = box("div", "content article-body post-content entry-content story main-text", body)
        else:
            article = f"<div>{body}</div>"
        before = "".join(f() for f in (top, top, menu, notice, advert, form) if pick.random() < 0.45)
        after = "".join(f() for f in (side, comments, advert, share, form, notice) if pick.random() < 0.35)
        if pick.random() < 0.25:
            article = f"<main>{article}{side()}</main>" if r < 0.5 else f'<div id="wrapper">{article}{side()}</div>'
        tail = bottom() if pick.random() < 0.85 else ""
        out.append((f"<html><head><title>{words(2, 6)}</title></head><body>{before}{article}{after}{tail}</body></html>", main))
    return out


@lru_cache(maxsize=1)
def trained() -> Chain:
    """The chain fitted on ``TRAINING_PAGES`` composed pages and ``TRAINING_BARE_PAGES`` bare ones."""
    pages = labelled_pages(TRAINING_PAGES) + [(page, main) for _, page, main in bare_pages(TRAINING_BARE_PAGES)]
    return fit_chain([labelled(page, main) for page, main in pages])


def labelled(page: str, main: list[str]) -> tuple[list[list[int]], list[int]]:
    """Features and labels of the blocks; ``main`` are content blocks in page order."""
    blocks, labels, nth = parse(page), [], 0
    for b in blocks:
        hit = nth < len(main) and b.text == main[nth]
        nth += hit
        labels.append(int(hit))
    return block_features(blocks), labels


def _extract(chain: Chain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [chain.extract(p.as_py()) for p in batch.column("_html")]
            kept = batch.select([n for n in batch.schema.names if n != "_html"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*kept.schema.names, "text", "n_chars"],
            )

    return run


def extract_text(pages: DataFrame, keep: list[str], html: str = "html", chain: Chain | None = None) -> DataFrame:
    """``keep``, text and n_chars (code points) of every page."""
    rows = pages.select(*keep, F.col(html).alias("_html"))
    fields = "".join(f"`{c}` {pages.schema[c].dataType.simpleString()}, " for c in keep)
    return rows.mapInArrow(_extract(chain or trained()), fields + "text STRING, n_chars BIGINT")


def op7_page_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"), ["page_id", "url"])
