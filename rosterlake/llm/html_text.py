"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its leaf blocks: stretches of text between block-level tags, each with the path
of open tags (names, classes and ids). A bidirectional LSTM in numpy reads one vector per block (hashed path,
hashed words, a few measures) over the whole page and labels every block as main text or not, so a label
depends on what stands before and after it.

The labeller is trained on the table's own pages: ``SAMPLE`` pages (the smallest hashes of page ids, a
documented bound) give the language material and the shapes. Labels are known by construction: the sampled
pages are labelled by their sectioning tags and the class words of ``OTHER_WORDS``, and for each sampled page variants are laid out in which articles,
menus, headers, footers, sidebars, notices, adverts, forms and comments use other tags, classes and places.
Texts of all parts come from the same pages, so words alone do not tell a label.
"""

from __future__ import annotations

import html
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SAMPLE, SAMPLE_CHARS, VARIANTS = 160, 100_000, 4
PATH_DIM, WORD_DIM, MEASURES, HIDDEN = 256, 32, 8, 20
ROUNDS, BATCH, RATE, SEED = 16, 32, 0.01, 7
DIM = PATH_DIM + WORD_DIM + MEASURES

# fixed values: HTML's void, hidden, inline and self-closing-by-sibling elements
VOID = set("area base br col embed hr img input link meta source track wbr".split())
HIDDEN_TAGS = "script|style|noscript|template|iframe|title|textarea"
#: Elements whose text is not shown; an open one ends with its parent.
HIDING = set("svg object canvas select".split())
HEAD_TAGS = set("base basefont bgsound link meta noscript script style template title".split())
MATH = set("math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub "
           "msubsup msup mtable mtd mtext mtr munder munderover semantics annotation annotation-xml".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q s samp small span "
             "strike strong sub sup time tt u var wbr br button".split()) | HIDING | MATH
CLOSED_BY = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
CLOSES_P = set("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
               "section table ul".split())
SCOPE = set("table td th ul ol div section article aside nav body form dl blockquote main".split())
HIDDEN_OPEN = re.compile(rf"<({HIDDEN_TAGS})(?=[\s/>])", re.I)
HIDDEN_CLOSE = {name: re.compile(rf"</{name}\s*>", re.I) for name in HIDDEN_TAGS.split("|")}
COMMENT_EMPTY, COMMENT_CLOSE = re.compile(r"-?>"), re.compile(r"--!?>")
TAG_OPEN, NAME_END, MARK = re.compile(r"</?(?=[a-zA-Z])"), re.compile(r"[\s/>]"), re.compile(r"[>\"']")
LONG_REFERENCE = re.compile(r"&#([0-9]{8,})")
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
SPLIT = re.compile(r"[^a-z]+")


def tokens(page: str) -> Iterator[tuple[int, int, str | None, bool, str]]:
    """Start, end, name, whether it closes, and attributes of every tag; the name is None for what holds no text.

    A ``<`` that never becomes a tag, because no ``>`` follows outside quotes, is text. How a scan from a quote or
    ``>`` on ends does not depend on where it came from, so it is noted for each of them once and a page of any form
    takes linear time.
    """
    marks: list[int] | None = None
    ends: dict[int, int] = {}
    name_end, shut = -1, page.rfind(">")

    def tag_end(start: int) -> int:
        place, passed = bisect_left(marks, start), []
        while place < len(marks) and place not in ends:
            passed.append(place)
            sign, at = page[marks[place]], marks[place]
            if sign == ">":
                ends[place] = at + 1
                break
            again = page.find(sign, at + 1)
            place = bisect_left(marks, again + 1) if again >= 0 else len(marks)
        end = ends.get(place, -1)
        for p in passed:
            ends[p] = end
        return end

    at = page.find("<")
    while at >= 0:
        end, name, closing, attributes = -1, None, False, ""
        if page.startswith("<!--", at):
            found = COMMENT_EMPTY.match(page, at + 4) or COMMENT_CLOSE.search(page, at + 4)
            end = found.end() if found else len(page)
        elif hidden := HIDDEN_OPEN.match(page, at):
            found = HIDDEN_CLOSE[hidden[1].lower()].search(page, hidden.end())
            end = found.end() if found else len(page)
        elif at < shut and (opened := TAG_OPEN.match(page, at)):
            if marks is None:
                marks = [m.start() for m in MARK.finditer(page)]
            if name_end < opened.end():
                name_end = NAME_END.search(page, opened.end()).start()  # the last > is still to come
            end = tag_end(name_end)
            if end >= 0:
                name, closing, attributes = page[opened.end():name_end].lower(), page[at + 1] == "/", page[name_end:end - 1]
        elif at < shut and page[at + 1] in "!?":
            end = page.index(">", at) + 1
        if end >= 0:
            yield at, end, name, closing, attributes
        at = page.find("<", max(end, at + 1))


class Place:
    """A path of open elements: its depth, last tag, a bit per slot of its tags and labels, and what its tags say."""
    __slots__ = ("depth", "last", "mask", "main", "other")

    def __init__(self, around: Place | None, words: list[str]) -> None:
        if around is None:
            self.depth, self.last, self.mask, self.main, self.other = 0, "none", 0, False, False
            return
        self.depth, self.last, self.mask = around.depth + 1, words[0], around.mask
        for w in words:
            self.mask |= 1 << slot(w, PATH_DIM)
        self.main = around.main or words[0] in MAIN_TAGS
        self.other = around.other or words[0] in OTHER_TAGS or not OTHER_WORDS.isdisjoint(words[1:])


class OpenElements:
    """The stack of open elements. A name, or the nearest scope, is found without a walk over the elements."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.places = [Place(None, [])]
        self.rows: dict[str, list[int]] = {}
        self.scopes: list[int] = []

    def push(self, name: str, place: Place) -> None:
        self.rows.setdefault(name, []).append(len(self.names))
        if name in SCOPE:
            self.scopes.append(len(self.names))
        self.names.append(name)
        self.places.append(place)

    def cut(self, size: int) -> None:
        while len(self.names) > size:
            self.rows[self.names.pop()].pop()
            self.places.pop()
        while self.scopes and self.scopes[-1] >= size:
            self.scopes.pop()

    def last(self, name: str) -> int:
        rows = self.rows.get(name)
        return rows[-1] if rows else -1

    def close_in_scope(self, names: set[str]) -> None:
        """Cuts the last element of these names, unless a scope was opened inside it."""
        row = max(map(self.last, names), default=-1)
        if row >= 0 and (not self.scopes or row >= self.scopes[-1]):
            self.cut(row)


class Block:
    __slots__ = ("place", "parts", "linked")

    def __init__(self, place: Place) -> None:
        self.place, self.parts, self.linked = place, [], 0


def decoded(piece: str) -> str:
    """Text with its character references decoded; a number beyond the last code point is U+FFFD, however long."""
    if "&" not in piece:
        return piece
    return html.unescape(LONG_REFERENCE.sub(lambda m: "&#" + ((m[1].lstrip("0") or "0") if len(m[1].lstrip("0")) < 8 else "1114112"), piece))


def blocks_of(page: str | None) -> list[tuple[str, Place, int]]:
    """Leaf blocks in page order: (text, place, characters inside links).

    References are decoded and white space becomes one space. Markup that never ends is treated as the HTML rules
    do: an open comment or script hides the rest, an unclosed paragraph ends at the next block, the head at the first
    tag or text that does not belong there, a drawing at the first block outside a foreignObject. Time is linear in
    the page, also where tags, quotes or elements stay open.
    """
    page = page or ""
    out: list[Block] = []
    stack = OpenElements()
    at, block = 0, None
    hidden = -1  # row of the outermost open element that hides its text

    def text(piece: str) -> None:
        nonlocal block
        if not piece or hidden >= 0:
            return
        piece = decoded(piece)
        if stack.names and stack.names[-1] == "head" and not piece.isspace():
            stack.cut(len(stack.names) - 1)
        if block is None:
            if piece.isspace():
                return
            block = Block(stack.places[-1])
            out.append(block)
        block.parts.append(piece)
        if stack.last("a") >= 0:
            block.linked += len(piece)

    for start, end, name, closing, attributes in tokens(page):
        text(page[at:start])
        at = end
        if name is None:
            continue
        if closing:
            row = stack.last(name)
            if row >= 0:
                if not 0 <= hidden <= row and (name not in INLINE or any(x not in INLINE for x in stack.names[row:])):
                    block = None
                stack.cut(row)
                hidden = hidden if hidden < row else -1
            elif hidden >= 0:
                continue
            elif name == "p" or name not in INLINE:
                block = None
            continue
        if name not in HEAD_TAGS and "head" in stack.names[:3]:
            stack.cut(stack.names.index("head"))
            hidden = hidden if hidden < len(stack.names) else -1
        if hidden >= 0 and stack.names[hidden] == "svg" and (name in CLOSES_P or name == "body") and stack.last("foreignobject") < hidden:
            stack.cut(hidden)
            hidden = -1
        stays = name not in VOID and not attributes.endswith("/")
        if hidden >= 0:
            if stays:
                stack.push(name, stack.places[-1])
            continue
        if name == "br":
            if block is not None:
                block.parts.append(" ")
            continue
        if name not in INLINE:
            block = None
            stack.close_in_scope(CLOSED_BY.get(name, set()) | ({"p"} if name in CLOSES_P else set()))
        if stays:
            hidden = len(stack.names) if name in HIDING else -1
            around = stack.places[-1]
            stack.push(name, Place(around, [name, *labels(attributes)]) if name not in INLINE or name == "a" else around)
    text(page[at:])
    found = []
    for b in out:
        value = " ".join("".join(b.parts).split())
        if value:
            found.append((value, b.place, b.linked))
    return found


def labels(attributes: str) -> list[str]:
    """Words of class, id and role attributes."""
    if "=" not in attributes:
        return []
    return [w for m in ATTRIBUTE.finditer(attributes) for w in SPLIT.split((m[2] or m[3] or m[4] or "").lower()) if w][:12]


# ---------------------------------------------------------------------------------- vectors
def slot(word: str, size: int) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % size


def vectors(blocks: list) -> np.ndarray:
    """One row per block: hashed path, hashed words (shares), measures. All words of a block count."""
    out = np.zeros((len(blocks), DIM), np.float32)
    hashes: list[int] = []
    lengths, measures, masks = [], [], []
    for text, place, linked in blocks:
        # every tag and label of the path, and the last tag apart
        masks.append((place.mask | 1 << slot("last " + place.last, PATH_DIM)).to_bytes(PATH_DIM // 8, "little"))
        words = text.encode("utf-8", "replace").split()
        hashes += map(zlib.crc32, words)
        lengths.append(len(words))
        n, count = len(text), len(words) or 1
        measures.append((n, linked / n, count, place.depth, text.count("."), text.count(",")))
    out[:, :PATH_DIM] = np.unpackbits(np.frombuffer(b"".join(masks), np.uint8), bitorder="little").reshape(-1, PATH_DIM)
    n, linked, count, depth, stops, commas = np.array(measures, np.float32).T
    owner = np.repeat(np.arange(len(blocks)), lengths)
    share = np.bincount(owner * WORD_DIM + np.array(hashes, np.int64) % WORD_DIM, minlength=len(blocks) * WORD_DIM)
    out[:, PATH_DIM:PATH_DIM + WORD_DIM] = share.reshape(-1, WORD_DIM) / count[:, None]
    out[:, PATH_DIM + WORD_DIM:] = np.stack([np.minimum(np.log1p(n) / 8, 2), linked, 1 / count, np.minimum(depth / 10, 2), stops / count,
                                             commas / count, np.arange(len(blocks)) / len(blocks), np.ones(len(blocks))], axis=1)
    return out


# ------------------------------------------------------------------------------------- model
def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (1 + np.tanh(np.float32(0.5) * x))


def new_weights(rng: np.random.Generator) -> dict[str, np.ndarray]:
    scale = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    out = {"out": scale(2 * HIDDEN, 1)[:, 0], "bias": np.zeros(1, np.float32)}
    for side in "fb":
        gate = np.zeros(4 * HIDDEN, np.float32)
        gate[HIDDEN:2 * HIDDEN] = 1  # forget gates start open
        out |= {f"{side}x": scale(DIM, 4 * HIDDEN) * 0.5, f"{side}h": scale(HIDDEN, 4 * HIDDEN), f"{side}b": gate}
    return out


def run_side(projected: np.ndarray, mask: np.ndarray, recurrent: np.ndarray):
    """States of one direction over (time, batch, 4 * hidden) inputs; masked steps keep the state."""
    steps, batch, _ = projected.shape
    h = np.zeros((batch, HIDDEN), np.float32)
    c = np.zeros((batch, HIDDEN), np.float32)
    states, cells, gates = (np.empty((steps, batch, k * HIDDEN), np.float32) for k in (1, 1, 4))
    for t in range(steps):
        z = projected[t] + h @ recurrent
        z[:, :3 * HIDDEN] = sigmoid(z[:, :3 * HIDDEN])
        z[:, 3 * HIDDEN:] = np.tanh(z[:, 3 * HIDDEN:])
        i, f, o, g = np.split(z, 4, axis=1)
        live = mask[t][:, None]
        c = np.where(live, f * c + i * g, c)
        h = np.where(live, o * np.tanh(c), h)
        states[t], cells[t], gates[t] = h, c, z
    return states, cells, gates


def back_side(grad: np.ndarray, states, cells, gates, mask, recurrent):
    """Gradients of the projected inputs and the recurrent weights for gradients of the states."""
    steps, batch, _ = grad.shape
    dh = np.zeros((batch, HIDDEN), np.float32)
    dc = np.zeros((batch, HIDDEN), np.float32)
    dz = np.zeros_like(gates)
    for t in range(steps - 1, -1, -1):
        live = mask[t][:, None]
        i, f, o, g = np.split(gates[t], 4, axis=1)
        before = cells[t - 1] if t else np.zeros_like(dc)
        squashed = np.tanh(cells[t])
        total = (grad[t] + dh) * live
        cell = dc * live + total * o * (1 - squashed**2)
        dz[t] = np.concatenate([cell * g * i * (1 - i), cell * before * f * (1 - f), total * squashed * o * (1 - o),
                                cell * i * (1 - g**2)], axis=1) * live
        dc = np.where(live, cell * f, dc)
        dh = np.where(live, dz[t] @ recurrent.T, dh)
    earlier = np.concatenate([np.zeros((1, batch, HIDDEN), np.float32), states[:-1]])
    return dz, np.tensordot(earlier, dz, axes=([0, 1], [0, 1]))


def padded(pages: list[np.ndarray]):
    """(time, batch, columns) array of pages of vectors, and the mask of real steps."""
    steps = max(len(p) for p in pages)
    out = np.zeros((steps, len(pages), pages[0].shape[1]), np.float32)
    mask = np.zeros((steps, len(pages)), bool)
    for b, p in enumerate(pages):
        out[:len(p), b], mask[:len(p), b] = p, True
    return out, mask


def last_states(projected: np.ndarray, mask: np.ndarray, recurrent: np.ndarray) -> np.ndarray:
    """The states of ``run_side`` alone, for labelling."""
    steps, batch, _ = projected.shape
    states = np.empty((steps, batch, HIDDEN), np.float32)
    h = np.zeros((batch, HIDDEN), np.float32)
    c = np.zeros((batch, HIDDEN), np.float32)
    for t in range(steps):
        z = projected[t] + h @ recurrent
        gate = sigmoid(z[:, :3 * HIDDEN])
        new = gate[:, HIDDEN:2 * HIDDEN] * c + gate[:, :HIDDEN] * np.tanh(z[:, 3 * HIDDEN:])
        out = gate[:, 2 * HIDDEN:] * np.tanh(new)
        if mask[t].all():
            c, h = new, out
        else:
            live = mask[t][:, None]
            c, h = np.where(live, new, c), np.where(live, out, h)
        states[t] = h
    return states


def both_sides(weights: dict, projected: dict, mask: np.ndarray):
    ahead = run_side(projected["f"], mask, weights["fh"])
    back = run_side(projected["b"][::-1], mask[::-1], weights["bh"])
    return ahead, back, np.concatenate([ahead[0], back[0][::-1]], axis=2)


def predict(weights: dict, pages: list[np.ndarray], group: int = 256) -> list[np.ndarray]:
    """Per page the probability of every block to be main text."""
    out: list[np.ndarray] = [np.empty(0, np.float32)] * len(pages)
    order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
    start = 0
    while start < len(order):
        # pages of like length share a batch; a very long page is on its own
        longest = 1.3 * len(pages[order[start]]) + 8
        stop = start + 1
        while stop < min(len(order), start + group) and len(pages[order[stop]]) <= longest:
            stop += 1
        some = order[start:stop]
        score = weights["bias"]
        for side in "fb":
            x, mask = padded([pages[i] @ weights[f"{side}x"] + weights[f"{side}b"] for i in some])
            flip = slice(None, None, 1 if side == "f" else -1)
            part = weights["out"][:HIDDEN] if side == "f" else weights["out"][HIDDEN:]
            score = score + last_states(x[flip], mask[flip], weights[f"{side}h"])[flip] @ part
        for b, i in enumerate(some):
            out[i] = sigmoid(score[:len(pages[i]), b])
        start = stop
    return out


def train(pages: list[np.ndarray], wanted: list[np.ndarray], rounds: int = ROUNDS, seed: int = SEED) -> dict[str, np.ndarray]:
    """Weights by backpropagation through time and Adam on cross entropy over the blocks."""
    rng = np.random.default_rng(seed)
    weights = new_weights(rng)
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
    batches = [order[s:s + BATCH] for s in range(0, len(order), BATCH)]
    step = 0
    for turn in range(rounds):
        for k in rng.permutation(len(batches)):
            x, mask = padded([pages[i] for i in batches[k]])
            y, _ = padded([wanted[i][:, None].astype(np.float32) for i in batches[k]])
            projected = {side: x @ weights[f"{side}x"] + weights[f"{side}b"] for side in "fb"}
            ahead, back, states = both_sides(weights, projected, mask)
            score = sigmoid(states @ weights["out"] + weights["bias"])
            error = np.where(mask, score - y[:, :, 0], 0) / mask.sum()
            grads = {"out": np.tensordot(states, error, axes=([0, 1], [0, 1])), "bias": error.sum(keepdims=True)[0]}
            ds = error[:, :, None] * weights["out"]
            for side, run, g, m, inputs in (("f", ahead, ds[:, :, :HIDDEN], mask, x), ("b", back, ds[::-1, :, HIDDEN:], mask[::-1], x[::-1])):
                dz, grads[f"{side}h"] = back_side(g, *run, m, weights[f"{side}h"])
                grads[f"{side}b"] = dz.sum(axis=(0, 1))
                grads[f"{side}x"] = np.tensordot(inputs, dz, axes=([0, 1], [0, 1]))
            step += 1
            rate = RATE * (1 - 0.9 * step / (rounds * len(batches)))
            for name, g in grads.items():
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.99 * second[name] + 0.01 * g * g
                weights[name] -= (rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return weights


# --------------------------------------------------------------------------- training material
# fixed values: common names of page parts
MAIN_NAMES = ["article", "main", 'div class="content"', 'div class="post-body"', 'div id="main-content"', 'section class="article-body"',
              'div class="entry-content"', 'div class="story"', 'div role="main"', "article class=\"post\""]
ASIDE_NAMES = {
    "nav": ["nav", 'div class="menu"', 'div class="navbar"', 'ul class="nav"', 'div class="breadcrumb"', 'div role="navigation"'],
    "header": ["header", 'div class="header"', 'div id="masthead"', 'div class="site-header"', 'div role="banner"'],
    "footer": ["footer", 'div class="footer"', 'div id="footer"', 'div class="copyright"', 'div role="contentinfo"'],
    "side": ["aside", 'div class="sidebar"', 'aside class="related"', 'div class="widget"', 'div class="related-posts"', 'div class="share"',
             'div class="social"', 'div class="newsletter"', 'div class="subscribe"'],
    "notice": ['div class="notice"', 'div class="cookie-notice"', 'div class="alert"', 'div id="cookie-banner"', 'div class="popup"', 'div class="consent"',
               'div class="modal"', 'div role="alert"', 'p class="notice"', 'p class="disclaimer"', 'section class="notice"'],
    "ad": ['div class="ad"', 'div class="ads"', 'div class="advert"', 'div class="sponsored"', 'aside class="ad"', 'div class="advertisement"',
           'div class="promo"', 'p class="ad"', 'section class="sponsor"', 'div class="banner"'],
    "form": ["form", 'form class="search"', 'form class="login"', 'div class="form"', 'form id="subscribe"'],
    "comments": ['div class="comments"', 'section class="comments"', 'div id="comments"', 'ol class="comment-list"', 'div class="comment"',
                 'section id="discussion"', 'div class="replies"', 'div class="reply"'],
}
MAIN_TAGS = {"article", "main"}
OTHER_TAGS = {"nav", "header", "footer", "aside", "form"}
OTHER_WORDS = {w for names in ASIDE_NAMES.values() for n in names for w in labels(" " + n.partition(" ")[2])} - {"site", "list", "posts", "id"}


def outline_labels(blocks: list) -> np.ndarray | None:
    """Labels of a page that marks its article; None if it does not."""
    inside = np.array([place.main for _, place, _ in blocks], bool)
    return inside & ~np.array([place.other for _, place, _ in blocks], bool) if inside.any() else None


def variant(content: list[str], spare: list[str], rng: np.random.Generator) -> tuple[str, list[bool]]:
    """A page laid out anew from block texts, and the label of each of its blocks."""
    out: list[str] = ["<html><body>"]
    wanted: list[bool] = []
    pick = lambda: html.escape(spare[int(rng.integers(len(spare)))])

    def part(kind: str) -> None:
        opening = ASIDE_NAMES[kind][int(rng.integers(len(ASIDE_NAMES[kind])))]
        n = int(rng.integers(1, 5))
        if opening.startswith("p "):
            body, n = pick(), 1
        elif kind == "nav":
            body = "".join(f"<li><a href='/'>{' '.join(pick().split()[:3])}</a></li>" for _ in range(n))
            body = body if opening.startswith("ul") else f"<ul>{body}</ul>"
        elif kind == "form":
            body = "".join(f"<p><label>{' '.join(pick().split()[:4])}</label><input name=q></p>" for _ in range(n))
        elif kind == "header":
            body = f"<h1>{' '.join(pick().split()[:5])}</h1>" + "".join(f"<p>{pick()}</p>" for _ in range(n - 1))
        elif opening.startswith("ol"):
            body = "".join(f"<li><p>{pick()}</p></li>" for _ in range(n))
        elif rng.random() < 0.3:
            body, n = pick(), 1
        else:
            tag = ["p", "p", "div", "li", "h3"][int(rng.integers(5))]
            body = "".join(f"<{tag}>{pick()}</{tag}>" for _ in range(n))
        wanted.extend([False] * n)
        out.append(f"<{opening}>{body}</{opening.split()[0]}>")

    def maybe(kinds: str, chance: float) -> None:
        for kind in kinds.split():
            if rng.random() < chance:
                part(kind)

    maybe("notice header nav notice ad", 0.5)
    maybe("side", 0.25)
    opening = MAIN_NAMES[int(rng.integers(len(MAIN_NAMES)))]
    wrapper = rng.random() < 0.3
    out.append("<div class=\"wrapper\">" if wrapper else "")
    out.append(f"<{opening}>")
    for i, block in enumerate(content):
        tag = "h1" if i == 0 and rng.random() < 0.8 else ["p", "p", "p", "p", "p", "div", "li", "h2", "blockquote", "td", "pre"][int(rng.integers(11))]
        before, after = {"li": ("<ul>", "</ul>"), "td": ("<table><tr>", "</tr></table>")}.get(tag, ("", ""))
        body = html.escape(block)
        if rng.random() < 0.1:
            body = f"<a href='/x'>{body}</a>"
        out.append(f"{before}<{tag}>{body}</{tag}>{after}")
        wanted.append(True)
        maybe("ad notice side form", 0.04)
    maybe("comments", 0.15)
    out.append(f"</{opening.split()[0]}>")
    maybe("side ad comments form notice", 0.35)
    out.append("</div>" if wrapper else "")
    maybe("footer nav", 0.6)
    return "".join(out) + "</body></html>", wanted


def material(pages: list[str], seed: int = SEED, variants: int = VARIANTS):
    """Training pages as (vectors, labels) from sampled pages and their variants."""
    rng = np.random.default_rng(seed)
    x, y = [], []
    parsed = [b for b in map(blocks_of, pages) if b]
    spare = [t for b in parsed for t, _, _ in b] or ["text"]
    for found in parsed:
        marked = outline_labels(found)
        if marked is not None:
            x.append(vectors(found))
            y.append(marked)
        content = [t for (t, _, _), ok in zip(found, marked if marked is not None else [True] * len(found)) if ok][:60] or ["text"]
        for _ in range(variants):
            page, wanted = variant(content[:int(rng.integers(1, len(content) + 1))], spare, rng)
            built = blocks_of(page)
            if len(built) == len(wanted):
                x.append(vectors(built))
                y.append(np.array(wanted))
    return x, y


def fit(pages: DataFrame, id_column: str = "page_id", html_column: str = "html") -> dict[str, np.ndarray] | None:
    """Weights from the bounded sample; None if no sampled page has a block.

    Pages are drawn by a hash of their id, about twice as many as wanted, so that what reaches the driver does not
    grow with the table; the smallest hashes of these are taken.
    """
    rows = pages.select(F.col(id_column).cast("string").alias("id"), F.col(html_column).cast("string").alias("html"))
    rank = F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(1 << 40))
    drawn = rows.where(rank < F.lit(int(min(1.0, 2 * SAMPLE / max(pages.count(), 1)) * (1 << 40))))
    sample = drawn.where(F.char_length("html").between(1, SAMPLE_CHARS)).orderBy(rank, "html").limit(SAMPLE)
    x, y = material([r.html for r in sample.collect()])
    return train(x, y) if x else None


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
            weights: dict[str, np.ndarray] | None = None) -> DataFrame:
    """A row per page: ``page_id``, ``url``, ``text`` (blocks of the main text joined by an empty line), ``n_chars``
    and ``n_blocks``. Null html, or a page without main text, gives an empty text. Null and repeated ids are kept."""
    common.prepare(pages.sparkSession)
    weights = weights or fit(pages, id_column, html_column) or new_weights(np.random.default_rng(SEED))
    carried = pages.sparkSession.sparkContext.broadcast(weights)  # a few hundred kB, fixed by the dimensions

    def label(frames):
        model = carried.value
        for frame in frames:
            found = [blocks_of(page) for page in frame["html"]]
            scores = predict(model, [vectors(b) if b else np.empty((0, DIM), np.float32) for b in found])
            kept = [[t for (t, _, _), s in zip(b, score) if s >= 0.5] for b, score in zip(found, scores)]
            texts = ["\n\n".join(k) for k in kept]
            yield pd.DataFrame({"id": frame["id"].to_list(), "url": frame["url"].to_list(), "text": texts, "n_chars": [len(t) for t in texts],
                                "n_blocks": [len(b) for b in found]})

    rows = pages.select(F.col(id_column).cast("string").alias("id"), F.col(url_column).cast("string").alias("url"),
                        F.col(html_column).cast("string").alias("html"))
    out = rows.mapInPandas(label, "id string, url string, text string, n_chars long, n_blocks int")
    return out.select(F.col("id").cast("long").alias("page_id"), "url", "text", "n_chars", "n_blocks")
