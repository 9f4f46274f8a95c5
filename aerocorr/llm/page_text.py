"""Main text of web pages by tag-path ratios.

A page is cut into text blocks; a block's tag path is the chain of its open
elements.  Per path the length of text and the punctuation are added up and set
against the number of blocks and the part of the text inside links.  The two
ratios are smoothed along the page, multiplied, and paths above a share of the
page's mean are content; so are all blocks of the article or main element they
sit in, or without one the blocks that are not mostly links in the container
that holds them all (headings, short lines, lists).  Elements that are never
article text (navigation, forms, scripts ...) and containers whose class or id
says the same (adverts, comments, notices ...) are left out beforehand.

A page is worked on by one task in memory of a few times its size.  Defined
cases: null or empty html gives empty text; unclosed or misnested tags close
with their parents; a page without any content path falls back to its longest
one; repeated rows are extracted each.
"""

from __future__ import annotations

from html import unescape
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values
DROPPED = frozenset("""head script style noscript template iframe object embed svg math canvas audio video nav
header footer aside menu form button select option textarea input label dialog""".split())
RAW = frozenset("script style noscript textarea title iframe".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt
ruby s samp small span strike strong sub sup time tt u var wbr""".split())
NOISE = frozenset("""ad ads adbox adslot advert adverts advertisement advertising alert banner bottombar breadcrumb
breadcrumbs consent cookie cookies disclaimer disqus footer gdpr header masthead menu menubar modal nav navbar
navigation newsletter notice notices overlay pager pagination popup promo promoted promotion recommended related
replies reply respond share sharing sidebar sidenav signup social sponsor sponsored subscribe subscription tags
toast toolbar topbar topnav widget widgets""".split())
NOISE_PARTS = ("comment", "advert", "cookie", "sidebar", "newsletter")  # anywhere in a word of a class or id
HEADED = frozenset("article content entry post section title".split())  # their header belongs to the text
NOISE_ROLES = frozenset("banner navigation complementary contentinfo search form dialog alert menu".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = frozenset("""address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6
header hr main menu nav ol p pre section table ul""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PUNCTUATION = re.compile(r"[.,;:!?…。、，！？；：]")
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                 r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
NAMED = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]*))?""", re.I)
SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
SPACE = re.compile(r"\s+")
SHARE = 0.1  # of the mean score of the page's text, above which a path is content


def is_noise(tag: str, attributes: str) -> bool:
    if tag in DROPPED:
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    for name, value in NAMED.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "role" and value.lower() in NOISE_ROLES:
            return True
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name in ("class", "id"):
            plain = re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower()
            found = SPLIT.split(plain)
            noise = NOISE.intersection(found)
            if noise == {"header"} and (tag in HEADINGS or HEADED.intersection(found)):
                noise = set()
            if noise or any(part in x and x != "commentary" for x in found for part in NOISE_PARTS):
                return True
    return False


def blocks(page: str) -> list[tuple[tuple[str, ...], str, int]]:
    """(tag path, text, characters inside links) of the page's text blocks in
    order, without noise."""
    out, stack = [], []  # stack: (tag, noise or inside noise)
    pieces, linked, path = [], 0, ()

    def flush():
        nonlocal pieces, linked
        text = SPACE.sub(" ", unescape("".join(pieces))).strip()
        if text:
            out.append((path, text, linked))
        pieces, linked = [], 0

    def take(raw):
        nonlocal linked, path
        if not raw or (stack and stack[-1][1]):
            return
        if not pieces:
            path = tuple(t for t, _ in stack if t not in INLINE)
        pieces.append(raw)
        if any(t == "a" for t, _ in stack):
            linked += len(raw)

    def close(names):
        """Close the innermost element of ``names`` and what it holds."""
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                del stack[i:]
                return

    at, end = 0, len(page)
    while at < end:
        m = TAG.search(page, at)
        if not m:
            take(page[at:])
            break
        take(page[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "p" and not any(t == "p" for t, _ in stack):
                flush()
                continue
            if any(t == tag for t, _ in stack):
                if tag not in INLINE:
                    flush()
                    close({tag})
                elif next(t for t, _ in reversed(stack) if t == tag or t not in INLINE) == tag:
                    close({tag})  # an inline element never closes a block
            continue
        if tag == "br":
            take(" ")
            continue
        if tag not in INLINE:
            flush()
            if tag in ENDS_P and any(t == "p" for t, _ in stack):
                close({"p"})
            inner = next((t for t, _ in reversed(stack) if t not in INLINE), None)
            if inner in CLOSES.get(tag, ()) or (tag in HEADINGS and inner in HEADINGS):
                close({inner})
        if tag in VOID:
            continue
        noise = bool(stack and stack[-1][1]) or is_noise(tag, m[3] or "")
        if noise and not (stack and stack[-1][1]) and tag in INLINE:
            flush()
        if tag in RAW:
            stop = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            body, at = page[at:stop.start() if stop else end], stop.end() if stop else end
            if not noise and tag not in DROPPED and tag != "title":
                stack.append((tag, False))
                take(body)
                stack.pop()
            continue
        if not m[0].endswith("/>"):
            stack.append((tag, noise))
    flush()
    return out


def smooth(x: np.ndarray) -> np.ndarray:
    """Gaussian weights over two neighbours on each side."""
    kernel = np.exp(-0.5 * np.arange(-2, 3) ** 2)
    padded = np.convolve(x, kernel, "full")[2:len(x) + 2]
    return padded / np.convolve(np.ones(len(x)), kernel, "full")[2:len(x) + 2]


def content(found: list[tuple[tuple[str, ...], str, int]]) -> list[str]:
    """Texts of the content blocks."""
    if not found:
        return []
    length, marks, links, count = (defaultdict(float) for _ in range(4))
    for path, text, linked in found:
        length[path] += len(text)
        marks[path] += len(PUNCTUATION.findall(text))
        links[path] += min(linked, len(text))
        count[path] += 1
    text_ratio = {p: (length[p] - links[p]) / count[p] for p in length}
    mark_ratio = {p: (1 + marks[p]) / (count[p] + links[p] / 10) for p in length}
    order = [p for p, _, _ in found]
    fused = (smooth(np.array([text_ratio[p] for p in order]))
             * smooth(np.array([mark_ratio[p] for p in order])))
    score = defaultdict(list)
    for p, s in zip(order, fused):
        score[p].append(s)
    weight = np.array([len(t) for _, t, _ in found], dtype=float)
    bar = SHARE * float((fused * weight).sum() / weight.sum())
    chosen = {p for p in score if np.mean(score[p]) >= bar and links[p] < 0.5 * length[p]}
    if not chosen:
        chosen = {max(length, key=lambda p: (length[p], p))}
    # the container that holds all chosen paths takes its other blocks along; no chosen path is left out
    marked = next((p[:i + 1] for p in sorted(chosen) for i, t in enumerate(p) if t in ("article", "main")), None)
    if marked:
        return [text for path, text, _ in found if path in chosen or path[:len(marked)] == marked]
    low, high = min(chosen), max(chosen)
    depth = next((i for i, (x, y) in enumerate(zip(low, high)) if x != y), min(len(low), len(high)))
    root = low[:depth]
    if root and root[-1] not in ("article", "main", "section", "div", "td", "body"):
        root = root[:-1]
    return [text for path, text, linked in found
            if path[:len(root)] == root and (path in chosen or linked < 0.5 * len(text) or path[-1:] == ("h1",))]


def main_text(page: str | None) -> str:
    return "\n".join(content(blocks(page))) if page else ""


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars."""
    def run(batches):
        for b in batches:
            texts = [main_text(x.as_py()) for x in b.column("html")]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url").cast(pa.string()), pa.array(texts, pa.string())],
                ["page_id", "url", "text"])

    few = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return few.mapInArrow(run, "page_id long, url string, text string").withColumn(
        "n_chars", F.length("text").cast("long"))
