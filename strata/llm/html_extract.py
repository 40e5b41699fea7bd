"""Main text of web pages by a linear-chain conditional random field (operator 6).

A page is cut into leaf blocks: stretches of text between block-level tags.  A
block's features are its open elements (tags, and words of their class, id and
role), its text (length, share of link text, punctuation, digits, words of
notices) and its place, which needs no words: the plain text before and behind,
how much of the page's plain text its container holds, how many blocks share the
container, containers of the same make beside it.  A two-label chain (content or not) is trained in numpy on labelled
pages and decoded by Viterbi; content blocks are joined in page order.

Labelled pages: a bounded sample of the given pages whose semantic tags tell the
article (``<article>`` or ``<main>`` without what lies in navigation and the
like), and pages put together from the same blocks in other layouts (content
classes instead of tags, sidebars, notices, adverts, forms, comments inside and
outside the article), whose labels are known.  Half of both are read once more, or
instead, with classes, ids and roles removed and sectioning tags made ``div``s, so
that place and text count too.  Pages of the sample without such
tags are not used.  Where neither tags nor class words tell, a comment set like a
paragraph in the article's own container cannot be told from one, and stays.  Extraction itself has no bound on pages, blocks or length.

Of a skipped element everything is left out up to its end tag.  The inside of
script, style and other plain-text elements holds no tags, so their end is the
literal ``</name``.  Script and style that are never closed lose the rest of the
page, which is code and which browsers do not show either; any other element
that is never closed (for plain text: not before the next one of its name) loses
its start tag only, and what follows is read as page text."""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bounded_sample, mapped

TRAIN_PAGES, LAYOUTS, MOST_BLOCKS = 200, 300, 120
STEPS, RATE, PENALTY = 150, 0.1, 1e-3

#: HTML elements by their role here.
BREAKS = set("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
             "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol "
             "option p pre section select summary table tbody td tfoot th thead tr ul".split())
SKIPPED = set("script style noscript template textarea iframe svg math object canvas title".split())
PLAIN = set("script style noscript textarea iframe title".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
TAGS = sorted(BREAKS - {"html", "body"})
SECTIONS = set("article aside div footer form header main menu nav section".split())
LEAVES = set("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre label legend figcaption caption center hr ul ol dl".split())
GOOD = "article body content entry main post story text".split()
BAD = ("ad ads advert advertisement banner breadcrumb comment comments consent cookie copyright disclaimer footer form "
       "header login menu modal nav navbar navigation newsletter notice notification popup promo promoted related "
       "replies reply response share sidebar signup social sponsor sponsored subscribe tags toolbar widget").split()
#: Class words of other languages, read as the English ones.
ENGLISH = {"kommentar": "comment", "kommentare": "comments", "commentaire": "comment", "commentaires": "comments",
           "comentario": "comment", "comentarios": "comments", "commento": "comment", "commenti": "comments",
           "reacties": "comments", "leserbriefe": "comments", "anzeige": "ad", "anzeigen": "ads", "werbung": "advertisement",
           "publicite": "advertisement", "publicidad": "advertisement", "anuncio": "ad", "anuncios": "ads", "menue": "menu",
           "seitenleiste": "sidebar", "fusszeile": "footer", "kopfzeile": "header", "teilen": "share", "partager": "share",
           "compartir": "share", "artikel": "article", "inhalt": "content", "contenu": "content", "contenido": "content"}
NOTICE = re.compile(r"cookie|copyright|all rights reserved|©|privacy policy|terms of (?:use|service)|subscribe|"
                    r"sign up|log in", re.I)
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|"
                 r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>", re.S)
SAME = {t: re.compile(rf"<(/{'?' if t not in ('script', 'style') else ''}){t}(?![^\s/>])[^>]*>?", re.I) for t in PLAIN}
ATTRIBUTE = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORD = re.compile(r"[a-z]+")
DIGIT = re.compile(r"[0-9]")

NAMES = ([f"in:{t}" for t in TAGS] + [f"own:{t}" for t in TAGS] + [f"good:{w}" for w in GOOD]
         + [f"bad:{w}" for w in BAD]
         + ["any good", "any bad", "bad inside good", "bias", "links none", "links some", "links most", "links all",
            "length 1", "length 2", "length 3", "length 4", "length 5", "ends as sentence", "has digits",
            "mostly capitals", "notice"]
         + [f"{side} {k}" for side in ("place", "text before", "text behind", "container share", "container blocks",
                                       "container sentences") for k in range(1, 6)]
         + ["largest container", "inside largest", "before largest", "behind largest", "beside heading",
            "alike containers", "outside containers"])
INDEX = {name: i for i, name in enumerate(NAMES)}


@dataclass
class Block:
    text: str
    features: list[int]
    plain: int = 0                                      # characters outside links
    path: tuple[tuple[int, str], ...] = ()              # open elements: (number, tag)


def _words(attributes: str) -> list[str]:
    out = []
    for m in ATTRIBUTE.finditer(attributes):
        out += [ENGLISH.get(w, w) for w in WORD.findall((m[1] or m[2] or m[3] or "").lower())]
    return out


def _features(text: str, linked: int, stack: list[tuple[str, tuple[int, ...], bool, bool]]) -> list[int]:
    found = {INDEX["bias"]}
    good = bad = False
    for _, own, is_good, is_bad in stack:
        found.update(own)
        if is_bad and good:
            found.add(INDEX["bad inside good"])
        good, bad = good or is_good, bad or is_bad
    for tag, *_ in reversed(stack):
        if f"own:{tag}" in INDEX:
            found.add(INDEX[f"own:{tag}"])
            break
    if good:
        found.add(INDEX["any good"])
    if bad:
        found.add(INDEX["any bad"])
    n = len(text)
    share = linked / n
    found.add(INDEX["links none" if share == 0 else "links some" if share < 0.4 else
                    "links most" if share < 0.9 else "links all"])
    found.add(INDEX[f"length {1 + sum(n >= x for x in (12, 40, 100, 250))}"])
    if text[-1] in ".!?:;\"”»…":
        found.add(INDEX["ends as sentence"])
    if DIGIT.search(text):
        found.add(INDEX["has digits"])
    if sum(map(str.isupper, text)) * 2 > n:
        found.add(INDEX["mostly capitals"])
    if NOTICE.search(text):
        found.add(INDEX["notice"])
    return sorted(found)


def _level(x: float, *steps: float) -> int:
    return 1 + sum(x >= s for s in steps)


def _place(blocks: list[Block]) -> None:
    """Adds the features of a block's place on the page."""
    plain = np.array([b.plain for b in blocks])
    total = max(1, int(plain.sum()))
    chain = [[number for number, tag in b.path if tag not in LEAVES] for b in blocks]
    own = [c[-1] if c else -1 for c in chain]
    held: dict[int, list[int]] = {}                     # blocks of each container itself
    for i, c in enumerate(own):
        held.setdefault(c, []).append(i)
    prose = {c: sum(blocks[i].plain for i in members) for c, members in held.items()}
    sentences = {c: sum(blocks[i].text[-1] in ".!?:;\"”»…" for i in members) for c, members in held.items()}
    headed = {c for c, members in held.items() if any(b.path and b.path[-1][1] == "h1" for b in (blocks[i] for i in members))}
    alike: dict[tuple, set[int]] = {}                   # containers by what they stand in, their tag and their size
    make: dict[int, tuple] = {}
    for b, c in zip(blocks, chain, strict=True):
        if c:
            make[c[-1]] = (c[-2] if len(c) > 1 else -1, next(t for n, t in b.path if n == c[-1]), min(3, len(held[c[-1]])))
    for c, key in make.items():
        alike.setdefault(key, set()).add(c)
    top = max(prose, key=lambda c: (prose[c], -c))
    begin, end = held[top][0], held[top][-1]
    sums = np.r_[0, np.cumsum(plain)]
    for i, b in enumerate(blocks):
        c = own[i]
        before, behind = sums[i] - sums[max(0, i - 2)], sums[min(len(blocks), i + 3)] - sums[i + 1]
        found = [f"place {1 + 5 * i // len(blocks)}", f"text before {_level(before, 1, 60, 150, 400)}",
                 f"text behind {_level(behind, 1, 60, 150, 400)}",
                 f"container share {_level(prose[c] / total, 0.03, 0.15, 0.35, 0.6)}",
                 f"container blocks {_level(len(held[c]), 2, 3, 5, 9)}",
                 f"container sentences {_level(sentences[c] / len(held[c]), 0.01, 0.3, 0.6, 0.9)}"]
        if c == top:
            found.append("largest container")
        elif top in chain[i]:
            found.append("inside largest")
        if not begin <= i <= end:
            found.append("before largest" if i < begin else "behind largest")
        if c in headed:
            found.append("beside heading")
        if c in make and len(alike[make[c]]) > 1:
            found.append("alike containers")
        if c == -1:
            found.append("outside containers")
        b.features += [INDEX[f] for f in found]


_OPENED: dict[tuple[str, str], tuple] = {}


def _opened(tag: str, attributes: str) -> tuple[str, tuple[int, ...], bool, bool]:
    """What an open element adds to the features of the blocks inside."""
    key = (tag, attributes)
    if (got := _OPENED.get(key)) is None:
        words = set(_words(attributes)) if attributes else set()
        good, bad = words & set(GOOD), words & set(BAD)
        own = [INDEX[f"in:{tag}"]] if f"in:{tag}" in INDEX else []
        own += [INDEX[f"good:{w}"] for w in good] + [INDEX[f"bad:{w}"] for w in bad]
        got = tag, tuple(own), bool(good) or tag in ("article", "main"), \
            bool(bad) or tag in ("nav", "footer", "aside", "form")
        if len(_OPENED) < 20_000:
            _OPENED[key] = got
    return got


def _tokens(page: str) -> list[tuple[int, int, str, str, str]]:
    """(start, end, slash, tag, attributes) of each tag; a comment and a plain-text
    element up to its end tag have no tag name."""
    out, at = [], 0
    while at >= 0:
        start, at = at, -1
        for m in TAG.finditer(page, start):
            tag = (m[2] or "").lower()
            if tag in PLAIN and not m[1] and not m[3].endswith("/"):
                same = SAME[tag].search(page, m.end())
                if same and same[1]:
                    at = same.end()
                elif tag in ("script", "style"):
                    at = len(page)
                if at >= 0:
                    out.append((m.start(), at, "", "", tag))
                    break
            out.append((m.start(), m.end(), m[1] or "", tag, m[3] or ""))
    return out


def _ends(tokens: list[tuple[int, int, str, str, str]]) -> dict[int, int]:
    """The end tag of each skipped element with tags inside; unclosed ones have none."""
    out: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for i, (_, _, slash, tag, attributes) in enumerate(tokens):
        if tag not in SKIPPED or tag in PLAIN:
            continue
        if not slash and not attributes.endswith("/"):
            opened.setdefault(tag, []).append(i)
        elif slash and opened.get(tag):
            out[opened[tag].pop()] = i
    return out


def blocks_of(page: str) -> list[Block]:
    """Leaf blocks in page order; entities decoded, white space folded.  Unclosed,
    stray and wrongly nested tags are put up with: an end tag closes up to its
    start if that is open, a new paragraph closes an open one."""
    out: list[Block] = []
    stack: list[tuple] = []
    parts: list[str] = []
    path: list[tuple[int, str]] = []        # as stack: numbers and tags of the open elements
    linked, links = 0, 0

    def close():
        nonlocal linked
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            in_links = min(linked, len(text))
            out.append(Block(text, _features(text, in_links, stack), len(text) - in_links, tuple(path)))
        parts.clear()
        linked = 0

    tokens = _tokens(page)
    ends = _ends(tokens)
    at, skip_to = 0, -1
    for i, (start, end, slash, tag, attributes) in enumerate(tokens):
        if i <= skip_to:
            at = end
            continue
        if start > at:
            piece = page[at:start]
            parts.append(piece)
            if links:
                linked += len(piece.strip())
        at = end
        if not tag:
            if attributes:
                close()
        elif tag in SKIPPED:
            if not slash and not attributes.endswith("/"):
                close()
                skip_to = ends.get(i, i)
        elif tag == "a":
            links = 0 if slash else 1
        elif tag == "br":
            parts.append(" ")
        elif tag in BREAKS:
            close()
            links = 0
            if slash:
                for j in range(len(stack) - 1, -1, -1):
                    if stack[j][0] == tag:
                        del stack[j:], path[j:]
                        break
            else:
                again = tag in ("li", "dt", "dd", "option", "tr", "td", "th")
                if stack and (stack[-1][0] == "p" or again and stack[-1][0] == tag):
                    stack.pop()
                    path.pop()
                if tag not in VOID and not attributes.endswith("/"):
                    stack.append(_opened(tag, attributes))
                    path.append((i, tag))
    parts.append(page[at:])
    close()
    if out:
        _place(out)
    return out


_IN = {t: INDEX[f"in:{t}"] for t in TAGS}


_FORM = {_IN[t] for t in ("button", "select", "option")}


def semantic_labels(blocks: list[Block]) -> np.ndarray | None:
    """Labels that semantic tags give; None for a page without them."""
    inside = [bool({_IN["article"], _IN["main"]} & set(b.features)) for b in blocks]
    if not any(inside) or all(inside):
        return None
    off = {_IN[t] for t in ("nav", "footer", "aside", "form", "dialog", "button", "select")} | {INDEX["any bad"]}
    return np.array([y and not off & set(b.features) for y, b in zip(inside, blocks, strict=True)], int)


def layout(rng: random.Random, content: list[str], other: list[str]) -> str:
    """A page made of texts; those of its content start with the control character 2."""
    def some(a, b):
        return [rng.choice(other) for _ in range(rng.randint(a, b))]

    def tagged(tag, texts, mark=""):
        return "".join(f"<{tag}>{mark}{entities.escape(t)}</{tag}>" for t in texts)

    def links(texts):
        return "<ul>" + "".join(f'<li><a href="/x">{entities.escape(t[:24])}</a></li>' for t in texts) + "</ul>"

    head = rng.choice(['<header class="site-header">{}</header>', '<div id="header">{}</div>', "<header>{}</header>"])
    menu = rng.choice(["<nav>{}</nav>", '<div class="menu">{}</div>', '<div id="navigation">{}</div>'])
    side = rng.choice(["<aside>{}</aside>", '<div class="sidebar">{}</div>', '<div class="widget related">{}</div>'])
    note = rng.choice(['<div class="cookie-consent">{}</div>', '<div class="notice">{}</div>',
                       '<div role="dialog" class="popup">{}</div>'])
    ad = rng.choice(['<div class="ad">{}</div>', '<div class="advert banner">{}</div>',
                     '<div id="sponsored">{}</div>'])
    talk = rng.choice(['<section id="comments">{}</section>', '<div class="comments">{}</div>',
                       '<ol class="comment-list">{}</ol>'])
    foot = rng.choice(["<footer>{}</footer>", '<div id="footer">{}</div>', '<div class="footer copyright">{}</div>'])
    form = '<form action="/s"><label>{}</label><input name="q"><button>OK</button></form>'
    frame = rng.choice(["<article>{}</article>", "<main>{}</main>", '<main><article class="post">{}</article></main>',
                        '<div class="content">{}</div>', '<div id="main"><div class="post entry">{}</div></div>',
                        '<section class="article-body">{}</section>'])
    body = [tagged("h1", content[:1], "\x02")]
    if rng.random() < 0.4:
        body[0] = f"<header>{body[0]}</header>"
    for t in content[1:]:
        body.append(tagged(rng.choice(["p", "p", "p", "p", "h2", "li", "blockquote", "div"]), [t], "\x02"))
        if rng.random() < 0.08:
            body.append(rng.choice([ad, side, note, form]).format(tagged("p", some(1, 1))))
    comments = talk.format("".join(f'<div class="comment">{tagged("p", some(1, 2))}</div>' for _ in range(
        rng.randint(1, 5))))
    if rng.random() < 0.3:
        body.append(comments)
        comments = ""
    article = frame.format("".join(body))
    parts = [head.format(tagged("p", some(0, 1)) + links(some(0, 3))), menu.format(links(some(2, 8)))]
    if rng.random() < 0.5:
        parts.append(note.format(tagged("p", some(1, 2))))
    if rng.random() < 0.5:
        parts.append(ad.format(entities.escape(rng.choice(other))))
    parts.append(article)
    for chance, part in ((0.5, side.format(tagged("p", some(1, 3)) + links(some(0, 4)))),
                         (0.4, form.format("E-mail")), (0.6, comments), (0.3, ad.format(tagged("p", some(1, 1))))):
        if rng.random() < chance:
            parts.append(part)
    return "<html><body>" + "".join(parts) + foot.format(tagged("p", some(1, 2))) + "</body></html>"


def bare(page: str) -> str:
    """The page without classes, ids and roles, its sectioning tags made ``div``s."""
    out, at = [], 0
    for start, end, slash, tag, attributes in _tokens(page):
        if tag in BREAKS:
            out += [page[at:start], f"<{slash}{'div' if tag in SECTIONS else tag}{ATTRIBUTE.sub('', attributes)}>"]
            at = end
    return "".join(out) + page[at:]


@dataclass
class Chain:
    emit: np.ndarray      # (features, 2)
    move: np.ndarray      # (2, 2)
    start: np.ndarray     # (2,)


def _forward_backward(e: np.ndarray, mask: np.ndarray, chain: Chain):
    """Log partition sums, label and transition marginals of padded pages (n, t, 2)."""
    n, t, _ = e.shape
    alpha, beta = np.zeros_like(e), np.zeros_like(e)
    alpha[:, 0] = chain.start + e[:, 0]
    for i in range(1, t):
        nxt = np.logaddexp.reduce(alpha[:, i - 1, :, None] + chain.move, axis=1) + e[:, i]
        alpha[:, i] = np.where(mask[:, i, None], nxt, alpha[:, i - 1])
    for i in range(t - 2, -1, -1):
        prv = np.logaddexp.reduce(chain.move + (e[:, i + 1] + beta[:, i + 1])[:, None, :], axis=2)
        beta[:, i] = np.where(mask[:, i + 1, None], prv, 0)
    total = np.logaddexp.reduce(alpha[:, -1], axis=1)
    label = np.exp(alpha + beta - total[:, None, None]) * mask[:, :, None]
    pair = (alpha[:, :-1, :, None] + chain.move + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - total[:, None, None, None])
    return label, np.exp(np.minimum(pair, 0)) * mask[:, 1:, None, None]


def train(pages: list[tuple[list[Block], np.ndarray]]) -> Chain:
    """Maximum likelihood with a small penalty, by Adam over all pages."""
    t = max(len(b) for b, _ in pages)
    x = np.zeros((len(pages), t, len(NAMES)), np.float32)
    y, mask = np.zeros((len(pages), t), int), np.zeros((len(pages), t), bool)
    for i, (blocks, labels) in enumerate(pages):
        mask[i, :len(blocks)] = True
        y[i, :len(blocks)] = labels
        for j, b in enumerate(blocks):
            x[i, j, b.features] = 1
    true = np.eye(2)[y] * mask[:, :, None]
    true_pair = true[:, :-1, :, None] * true[:, 1:, None, :]
    chain = Chain(np.zeros((len(NAMES), 2)), np.zeros((2, 2)), np.zeros(2))
    params = [chain.emit, chain.move, chain.start]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    flat = x.reshape(-1, len(NAMES))
    for step in range(1, STEPS + 1):
        label, pair = _forward_backward((flat @ chain.emit.astype(np.float32)).reshape(*y.shape, 2).astype(float),
                                        mask, chain)
        grads = [flat.T @ (label - true).reshape(-1, 2), (pair - true_pair).sum((0, 1)),
                 (label[:, 0] - true[:, 0]).sum(0)]
        for p, g, m, v in zip(params, grads, first, second, strict=True):
            g = g / len(pages) + PENALTY * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return chain


def decode(chain: Chain, blocks: list[Block]) -> list[bool]:
    """Viterbi: the most likely labels of a page."""
    if not blocks:
        return []
    gain = (chain.emit[:, 1] - chain.emit[:, 0])
    (a, b), (c, d) = chain.move.tolist()
    s0, s1 = 0.0, 0.0
    back: list[tuple[int, int]] = []
    for i, block in enumerate(blocks):
        e = float(gain[block.features].sum())
        if i == 0:
            s0, s1 = float(chain.start[0]), float(chain.start[1]) + e
            continue
        from0, from1 = int(s1 + c > s0 + a), int(s1 + d > s0 + b)
        s0, s1 = max(s0 + a, s1 + c), max(s0 + b, s1 + d) + e
        back.append((from0, from1))
    at = int(s1 > s0)
    out = [at]
    for step in reversed(back):
        at = step[at]
        out.append(at)
    return [bool(z) for z in reversed(out)]


def main_text(chain: Chain, page: str) -> str:
    """The content blocks; what stands in a button or a choice is part of a form, whatever the chain says."""
    blocks = blocks_of(page)
    return "\n\n".join(b.text for b, y in zip(blocks, decode(chain, blocks), strict=True) if y and not _FORM & set(b.features))


def labelled(pages: list[str], seed: int = 11) -> list[tuple[list[Block], np.ndarray]]:
    """Training pages: those of ``pages`` whose tags tell, and layouts of their texts."""
    out, content, other = [], [], ["Home", "About us", "Contact", "Accept all cookies", "© All rights reserved."]
    for page in pages:
        blocks = blocks_of(page)
        labels = semantic_labels(blocks)
        if labels is None or len(blocks) > MOST_BLOCKS:
            continue
        out.append((blocks, labels))
        if len(out) % 2:
            plain = blocks_of(bare(page))
            if [b.text for b in plain] == [b.text for b in blocks]:
                out.append((plain, labels))
        content.append([b.text for b, y in zip(blocks, labels, strict=True) if y][:40])
        other += [b.text for b, y in zip(blocks, labels, strict=True) if not y][:10]
    content = [c for c in content if c] or [["A title", "A first paragraph of some words, long enough to be one.",
                                             "And a second one, which ends as sentences do."]]
    rng = random.Random(seed)
    texts = sorted({t for c in content for t in c})
    for _ in range(LAYOUTS):
        page = layout(rng, rng.choice(content), other + rng.sample(texts, min(len(texts), 40)))
        blocks = blocks_of(bare(page) if rng.random() < 0.5 else page)
        labels = np.array([b.text.startswith("\x02") for b in blocks], int)
        for b in blocks:
            b.text = b.text.removeprefix("\x02")
        if len(blocks) <= MOST_BLOCKS:
            out.append((blocks, labels))
    return out


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", train_pages: int = TRAIN_PAGES) -> Chain:
    """The chain of a bounded sample of the pages (smallest hashes of page_id);
    an empty sample leaves the layouts.

    Bounds of the fit: at most ``train_pages`` pages of at most 100,000 characters and ``MOST_BLOCKS`` blocks; a layout is
    made of at most 40 content and 10 other blocks of a page.  Extraction has no such bounds."""
    some = bounded_sample(pages.where(F.length(html_col).between(1, 100_000))
                          .select(F.col(id_col).cast("long").alias("k"), F.col(html_col).cast("string").alias("h")),
                          "k", train_pages).collect()
    return train(labelled([r["h"] for r in some]))


def extract(pages: DataFrame, chain: Chain, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` for each row.  A null or empty page, and
    one without content blocks, has the empty text.  Ids and urls are passed on
    as they are, null or repeated; other columns are ignored."""
    shared = pages.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                texts = [main_text(shared.value, t.as_py() or "") for t in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return mapped(pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                               F.col(html_col).cast("string").alias("html")), run,
                  "page_id long, url string, text string, n_chars long")
