"""Main text of web pages from flat text blocks.

A page becomes a flat list of text blocks. Each is described by its words, the share of them inside links, the same
of the block before and after it, and where it stands in the markup (inside the page's article, inside a part such as
navigation or a form, under a class or id name that speaks of adverts, comments and the like). A decision tree,
trained on a small labelled table of pages, keeps or drops it.

Defined results: a null or empty page has an empty text; unclosed and stray tags end with the part that holds them;
a page without tags is one block; null keys and repeated pages give a row each; further columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# fixed values: element names of HTML
_HIDDEN = {"script", "style", "noscript", "template", "head", "title", "svg", "iframe", "object", "select", "textarea", "math", "canvas"}
_RAW = {"script", "style", "textarea", "title", "iframe", "noscript"}
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_APART = {"nav": "menu", "menu": "menu", "header": "header", "footer": "footer", "aside": "side", "form": "form", "button": "form", "dialog": "notice", "fieldset": "form"}
_MAIN = {"article", "main"}
_HINTS = re.compile(
    r"(?:^|[-_\s])(?:ads?|adverts?|advertisement|banner|sponsor(?:ed)?|promo(?:tion)?|nav(?:bar|igation)?|menu|breadcrumbs?|"
    r"side(?:bar)?|widget|foot(?:er)?|head(?:er)?|masthead|comments?|replies|reply|discussion|disqus|cookies?|consent|"
    r"notice|alert|popup|modal|newsletter|subscribe|share|social|related|recommended|login|signup|search|legal|copyright)(?:$|[-_\s])"
)
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|</?[a-zA-Z](?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+>|<(?=[^a-zA-Z/!?])|[^<]+|<", re.S)
#: a tag with < in it, which may reach far; such searches may read this many times the page's length in all
_LOOSE, _REREAD = re.compile(r"</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*+>"), 4
_OPENS = re.compile(r"</?[a-zA-Z]")
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_SPACE = re.compile(r"\s+")

FEATURES = (
    "words", "link_share", "words_before", "link_share_before", "words_after", "link_share_after",
    "in_main", "page_has_main", "in_part", "hinted", "heading",
)


class _Frame:
    __slots__ = ("name", "hidden", "part", "hint", "main", "link")

    def __init__(self, name, hidden, part, hint, main, link):
        self.name, self.hidden, self.part, self.hint, self.main, self.link = name, hidden, part, hint, main, link


def _attributes(tag: str) -> tuple[bool, bool]:
    """Whether the tag hides its content, and whether its class, id or role speaks of a part beside the text."""
    hidden = hint = False
    body = tag[_NAME.match(tag).end() :]
    if "=" not in body and "hidden" not in body:
        return False, False
    for name, value in _ATTRIBUTE.findall(body):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            hidden = True
        elif name == "style":
            hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value))
        elif name == "role":
            hint |= value in _ROLES
        elif name in ("class", "id"):
            hint |= bool(_HINTS.search(value))
    return hidden, hint


def _tokens(page: str) -> Iterator[str]:
    """Tags, comments and texts of a page, in time that grows with its length, however malformed it is."""
    at, left = 0, _REREAD * len(page)
    while at < len(page):
        match = _TOKEN.match(page, at)
        if match.group() == "<" and left > 0 and _OPENS.match(page, at):
            loose = _LOOSE.match(page, at)
            left -= (loose.end() if loose else len(page)) - at
            match = loose or match
        yield match.group()
        at = match.end()


class _Open:
    """The open elements: a stack that knows its blocks, and the inline names open since the last one."""

    def __init__(self, root: _Frame):
        self.frames, self.names = [root], Counter()
        self.blocks: list[int] = [0]
        self.inline = [Counter()]

    def push(self, frame: _Frame) -> None:
        if frame.name in _INLINE:
            self.inline[-1][frame.name] += 1
        else:
            self.names[frame.name] += 1
            self.blocks.append(len(self.frames))
            self.inline.append(Counter())
        self.frames.append(frame)

    def pop(self) -> _Frame:
        frame = self.frames.pop()
        if frame.name in _INLINE:
            self.inline[-1][frame.name] -= 1
        else:
            self.names[frame.name] -= 1
            self.blocks.pop()
            self.inline.pop()
        return frame

    def end(self, name: str) -> None:
        """Close the last open element of a name. An inline end tag does not reach beyond the block it stands in, and
        one that nothing opened is dismissed at once."""
        if (self.inline[-1] if name in _INLINE else self.names)[name]:
            while self.pop().name != name:
                pass

    def end_before(self, name: str) -> None:
        """The next paragraph, list item or other block ends an open paragraph, a list item the one before it."""
        last = self.blocks[-1]
        if last and (self.frames[last].name == "p" or name == self.frames[last].name == "li"):
            while len(self.frames) > last:
                self.pop()


def blocks_of(page: str) -> list[tuple[str, int, bool, bool, bool, bool]]:
    """``(text, link words, in main, in part, hinted, heading)`` of the visible blocks, in page order."""
    out: list = []
    root = _Frame("", False, False, False, False, False)
    opened = _Open(root)
    stack = opened.frames
    pieces: list[str] = []
    linked: list[str] = []
    heading = False
    state = root

    def close():
        nonlocal heading
        text = _SPACE.sub(" ", "".join(pieces)).strip()
        if text:
            words = len("".join(linked).split())
            out.append((text, words, state.main, state.part, state.hint, heading))
        pieces.clear()
        linked.clear()
        heading = False

    skip = None
    for token in _tokens(page):
        if token[0] != "<" or len(token) == 1:
            top = stack[-1]
            if skip is None and not top.hidden:
                if not pieces:
                    state = top
                text = entities.unescape(token)
                pieces.append(text)
                if top.link:
                    linked.append(text)
            continue
        if token[1] in "!?":
            if token.startswith("<![CDATA[") and skip is None and not stack[-1].hidden:
                if not pieces:
                    state = stack[-1]
                pieces.append(token[9:-3] if token.endswith("]]>") else token[9:])
            continue
        name = _NAME.match(token).group(1).lower()
        if skip is not None:
            if token[1] != "/" or name != skip:
                continue
            skip = None
        if token[1] == "/":
            if name not in _INLINE:
                close()
            opened.end(name)
            continue
        if name not in _INLINE:
            close()
        if name in _VOID:
            continue
        if name not in _INLINE:
            opened.end_before(name)
        top = stack[-1]
        if name in ("h1", "h2", "h3", "h4", "h5", "h6"):
            heading = True
        hidden, hint = _attributes(token)
        if token.endswith("/>"):
            continue
        if name in _RAW:
            skip = name
        # a header inside the article belongs to it
        part = top.part or (name in _APART and not (name == "header" and top.main))
        main = top.main or name in _MAIN
        # a class word of the whole page, or of a wrapper around the article, says nothing of the article
        hint = (hint or top.hint) and name not in _MAIN and name not in ("html", "body")
        opened.push(_Frame(name, top.hidden or hidden or name in _HIDDEN, part, hint, main, top.link or name == "a"))
    close()
    return out


def features(blocks: list) -> np.ndarray:
    """One row of ``FEATURES`` per block."""
    rows = np.zeros((len(blocks), len(FEATURES)))
    if not blocks:
        return rows
    words = np.array([len(b[0].split()) for b in blocks], float)
    share = np.array([b[1] for b in blocks]) / np.maximum(words, 1)
    rows[:, 0], rows[:, 1] = words, share
    rows[1:, 2], rows[1:, 3] = words[:-1], share[:-1]
    rows[:-1, 4], rows[:-1, 5] = words[1:], share[1:]
    rows[:, 6] = [b[2] for b in blocks]
    rows[:, 7] = float(any(b[2] for b in blocks))
    rows[:, 8] = [b[3] for b in blocks]
    rows[:, 9] = [b[4] for b in blocks]
    rows[:, 10] = [b[5] for b in blocks]
    return rows


def grow(rows: np.ndarray, labels: np.ndarray, least: int = 2, depth: int = 8) -> tuple:
    """A decision tree by Gini impurity: ``(feature, threshold, low, high)`` or a label."""
    share = labels.mean()
    if share in (0.0, 1.0) or depth == 0 or len(labels) < 2 * least:
        return bool(share >= 0.5)
    best = None
    for f in range(rows.shape[1]):
        order = np.argsort(rows[:, f], kind="stable")
        values, ones = rows[order, f], np.cumsum(labels[order])
        n = np.arange(1, len(values) + 1)
        cut = np.flatnonzero((values[1:] > values[:-1]) & (n[:-1] >= least) & (len(values) - n[:-1] >= least))
        if not len(cut):
            continue
        left, right = n[cut], len(values) - n[cut]
        p, q = ones[cut] / left, (ones[-1] - ones[cut]) / right
        impurity = (left * p * (1 - p) + right * q * (1 - q)) / len(values)
        i = int(np.argmin(impurity))
        if best is None or impurity[i] < best[0] - 1e-12:
            best = (impurity[i], f, (values[cut[i]] + values[cut[i] + 1]) / 2)
    if best is None or best[0] >= share * (1 - share) - 1e-12:
        return bool(share >= 0.5)
    _, f, threshold = best
    low = rows[:, f] <= threshold
    return (f, threshold, grow(rows[low], labels[low], least, depth - 1), grow(rows[~low], labels[~low], least, depth - 1))


def decide(tree, rows: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(rows), tree)
    f, threshold, low, high = tree
    out = np.empty(len(rows), bool)
    left = rows[:, f] <= threshold
    out[left], out[~left] = decide(low, rows[left]), decide(high, rows[~left])
    return out


_LONG = "The river rose in the night and by morning the lower fields lay under water, so the farmers brought their animals up to the church."
_MID = "Nobody had seen the bridge so close to the flood before."
_LINKS = '<a href="/a">Home</a> <a href="/b">News</a> <a href="/c">Sport</a> <a href="/d">Weather</a>'
_CHROME = (
    f"0<nav>{_LINKS}</nav>", "0<nav><ul><li><a href='/x'>Start</a></li><li><a href='/y'>Contact us</a></li></ul></nav>",
    "0<header>The Daily Post, since 1901</header>", f"0<header>{_LINKS}</header>", "0<div class='ad'>Buy two pairs of boots and pay for one this week only in all our shops.</div>",
    "0<div class='ad'>Fresh bread.</div>", "0<div class='cookie-notice'>We use cookies to make this page better for you and for our partners.</div>",
    f"0<aside>{_MID} Read the other story.</aside>", f"0<aside>{_LINKS}</aside>", "0<form>Your name <input> Your message <button>Send it</button></form>",
    "0<footer>&copy; The Daily Post. All rights reserved.</footer>", f"0<footer>{_LONG}</footer>", "0<div id='sidebar'>Most read this week on our pages</div>",
    f"0<div class='comments'><p>{_LONG}</p><p>I agree.</p></div>", "0<section id='comment-list'><p>First!</p><p>What a strange story, thank you for it.</p></section>",
    f"0<div class='related'>{_LINKS}</div>", "0<div class='newsletter'>Subscribe to our letter</div>",
)
_PLAIN = (
    f"0<div>{_LINKS}</div>", "0<ul><li><a href='/x'>Start</a></li><li><a href='/y'>Contact us</a></li></ul>",
    "0<p><a href='/a'>Older stories</a> | <a href='/b'>Newer stories</a></p>", "0<table><tr><td><a href='/l'>Log in</a></td></tr></table>",
)
_LINKED = "1<p><a href='/whole'>The whole report on the water in the valley</a></p>"
_TEXT = (
    f"1<p>{_LONG}</p>", f"1<p>{_MID}</p>", "1<p>So it was.</p>", "1<h1>Water in the valley</h1>", "1<h2>The day after</h2>",
    f"1<p>{_LONG} <a href='/z'>The mill</a> stood empty.</p>", "1<ul><li>three boats</li><li>two carts</li></ul>", f"1<blockquote>{_MID}</blockquote>",
    "1<p>Go.</p>", f"1<p><b>{_MID}</b><br>{_LONG}</p>", "1<p>See <a href='/report'>the report</a>.</p>", "1<table><tr><td>June</td><td>12</td></tr></table>",
)


def labelled_pages() -> list[tuple[str, list[bool]]]:
    """The small labelled table: pages, and for each visible block whether it belongs to the main text.

    Every page is a row of labelled parts in a given frame: with an article, a main element, or neither.
    """
    pages = []
    frames = ("<article>{}</article>", "<main>{}</main>", "<div class='content'>{}</div>", "{}")
    for i in range(48):
        frame = frames[i % 4]
        bare = i % 4 >= 2
        top = [_CHROME[(i * 5 + k * 3) % len(_CHROME)] for k in range(3)]
        inner = [_TEXT[(i * 7 + k * 5) % len(_TEXT)] for k in range(6)]
        # without an element for the article, short lines are told by their neighbours
        inner = [p for p in inner if not bare or len(p) > 40]
        middle = [_CHROME[(i * 11 + 4) % len(_CHROME)]] if i % 3 == 0 else []
        bottom = [_CHROME[(i * 13 + k * 7 + 1) % len(_CHROME)] for k in range(3)]
        # a line that is one link belongs to an article, but to a bare page's menus
        linked = [_LINKED] if not bare and i % 2 else []
        body = inner[:3] + middle + inner[3:] + linked
        top.append(_PLAIN[i % len(_PLAIN)])
        bottom.insert(0, _PLAIN[(i + 1) % len(_PLAIN)])
        marks = [p[0] == "1" for part in (top, body, bottom) for p in part for _ in blocks_of(p[1:])]
        join = "".join
        pages.append((join(p[1:] for p in top) + frame.format(join(p[1:] for p in body)) + join(p[1:] for p in bottom), marks))
    return pages


def train() -> tuple:
    rows, marks = [], []
    for page, labels in labelled_pages():
        blocks = blocks_of(page)
        assert len(blocks) == len(labels), "a labelled part must keep its blocks inside a page"
        rows.append(features(blocks))
        marks.extend(labels)
    return grow(np.concatenate(rows), np.array(marks, float))


def main_text(page: str | None, tree: tuple) -> str:
    if not page:
        return ""
    blocks = blocks_of(page)
    if not blocks:
        return ""
    return " ".join(b[0] for b, keep in zip(blocks, decide(tree, features(blocks)), strict=True) if keep)


def extract(pages: DataFrame, html_column: str = "html", keys: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The given keys and ``text`` for every row of ``pages``."""
    tree = train()
    rows = pages.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{html_column}`").cast("string").alias("__html"))
    names = list(keys)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = pa.array([main_text(page, tree) for page in batch["__html"].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*[batch[k] for k in names], out], names=[*names, "text"])

    form = rows.select(*[F.col(f"`{k}`") for k in keys], F.col("__html").alias("text")).schema
    return rows.mapInArrow(texts, form)


def op8_page_text(spark, sf_dir: str) -> DataFrame:
    found = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
