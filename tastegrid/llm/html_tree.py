"""Pages as trees of block elements, with features for each node.

A node is a block element; inline elements belong to the block around them.  The text between two
block boundaries is a segment of the innermost open block.  Scripts, styles, titles and the like
give no text; comments and declarations are skipped; a tag that never ends drops the rest of the page.
"""

from __future__ import annotations

import html
import re

import numpy as np

TAG_GROUPS = {
    "root": ("#root", "html", "body"), "article": ("article", "main"), "section": ("section",), "div": ("div", "center", "details", "hgroup"),
    "p": ("p",), "heading": ("h1", "h2", "h3", "h4", "h5", "h6"), "list": ("ul", "ol", "dl", "menu"), "item": ("li", "dd", "dt"),
    "table": ("table", "tr", "td", "th", "tbody", "thead", "tfoot", "caption"), "quote": ("blockquote", "pre", "figure", "figcaption", "address", "summary"),
    "nav": ("nav",), "header": ("header",), "footer": ("footer",), "aside": ("aside",),
    "form": ("form", "fieldset", "button", "select", "option", "label", "legend", "dialog"), "head": ("head", "svg", "object", "hr"),
}
HINTS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc sitemap skip",
    "top": "header masthead topbar banner head hero logo toolbar",
    "bottom": "footer foot copyright legal colophon disclaimer bottom",
    "side": "sidebar side aside related widget recommended recommendations trending popular rail more teaser complementary",
    "advert": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted adsense dfp",
    "notice": "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup paywall warning announcement",
    "comment": "comment comments reply replies respond discussion disqus thread feedback reviews",
    "share": "share sharing social tags meta byline tools print follow",
    "form": "form search login register contact poll survey",
    "hidden": "hidden invisible none offscreen",
    "article": "article content post entry story main body text prose page blog news",
}
_GROUP = {tag: group for group, tags in TAG_GROUPS.items() for tag in tags}
_HINT = {word: hint for hint, words in HINTS.items() for word in words.split()}
_RAW = frozenset("script style title textarea noscript iframe template xmp noembed noframes".split())
_ENDS_ITEM = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_ITEM_SCOPE = frozenset("ul ol dl table select menu".split())
_NEXT = re.compile(r"<(?:!--|(/?)([a-zA-Z][^\s/>]*)|[!?/])")
_TAG_END = re.compile(r"(?:[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+>")
_ATTRIBUTE = re.compile(r"([^\s=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

STATIC = [f"tag:{g}" for g in TAG_GROUPS] + [f"hint:{h}" for h in HINTS]
DYNAMIC = ["bias", "own", "own10", "own25", "sentences", "links", "mostly_links", "below", "share", "paragraphs", "no_text"]
_PLACE = {name: i for i, name in enumerate(STATIC)}
_static: dict[tuple[str, str], tuple[list[int], str | None]] = {}


def _static_features(tag: str, attributes: str) -> tuple[list[int], str | None]:
    """Indexes of the features that hold for a tag with these attributes, and the value of its ``data-y`` if any."""
    found = _static.get((tag, attributes))
    if found is None:
        on, label = {_PLACE[f"tag:{_GROUP[tag]}"]}, None
        for name, *values in _ATTRIBUTE.findall(attributes):
            value, name = "".join(values), name.lower()
            if name == "data-y":
                label = value
            elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value)):
                on.add(_PLACE["hint:hidden"])
            elif name in ("class", "id", "role"):
                on |= {_PLACE[f"hint:{_HINT[w]}"] for w in map(str.lower, _WORDS.findall(value)) if w in _HINT}
        if len(_static) > 100_000:
            _static.clear()
        found = _static[tag, attributes] = (sorted(on), label)
    return found


class Page:
    """``parent``, ``static`` (feature indexes) and ``label`` by node in page order; ``segments``: (node, text, characters in links).

    Labels are read from ``data-y`` if ``labelled``, which only pages made for fitting are; else all are 0.
    """

    def __init__(self, source: str, labelled: bool = True):
        self.labelled = labelled
        self.parent, self.static, self.label, self.tags = [-1], [[_PLACE["tag:root"]]], [0], ["#root"]
        self.segments: list[tuple[int, str, int]] = []
        self._read(source)

    def _read(self, source: str) -> None:
        stack, open_ = [0], {}
        pieces, linked, in_link = [], 0, False
        at, n = 0, len(source)
        lowered = None

        def flush():
            nonlocal pieces, linked
            if pieces:
                text = " ".join(html.unescape("".join(pieces)).split())
                if text:
                    self.segments.append((stack[-1], text, min(linked, len(text))))
                pieces, linked = [], 0

        def close():
            open_[self.tags[stack.pop()]] -= 1

        while at < n:
            mark = source.find("<", at)
            end = n if mark < 0 else mark
            if end > at:
                piece = source[at:end]
                pieces.append(piece)
                linked += len(piece) if in_link else 0
            if mark < 0:
                break
            found = _NEXT.match(source, mark)
            if not found:
                pieces.append("<")
                at = mark + 1
                continue
            if not found[2]:
                stop, skip = ("-->", 3) if found[0] == "<!--" else (">", 1)
                end = source.find(stop, mark + 2)
                at = n if end < 0 else end + skip
                continue
            tag, closing = found[2].lower(), bool(found[1])
            over = _TAG_END.match(source, found.end())
            if not over:
                break
            at = over.end()
            if tag in _RAW:
                if not closing:
                    lowered = source.lower() if lowered is None else lowered
                    same = lowered if len(lowered) == n else source
                    end = same.find(f"</{tag}", at)
                    if end < 0:
                        break
                    at = (same.find(">", end) + 1) or n
                continue
            if tag == "a":
                in_link = not closing
            elif tag in ("br", "wbr"):
                pieces.append(" ")
            elif tag in _GROUP:
                flush()
                if closing:
                    if open_.get(tag):
                        while self.tags[stack[-1]] != tag:
                            close()
                        close()
                    continue
                if self.tags[stack[-1]] == "p":
                    close()
                if tag in _ENDS_ITEM:
                    for depth in range(len(stack) - 1, 0, -1):
                        name = self.tags[stack[depth]]
                        if name in _ITEM_SCOPE:
                            break
                        if name in _ENDS_ITEM[tag]:
                            while len(stack) > depth:
                                close()
                            if tag != "tr":
                                break
                if tag == "hr":
                    continue
                static, label = _static_features(tag, source[found.end():at - 1])
                self.static.append(static)
                self.label.append(int(label) if self.labelled and label is not None else self.label[stack[-1]])
                self.parent.append(stack[-1])
                self.tags.append(tag)
                stack.append(len(self.tags) - 1)
                open_[tag] = open_.get(tag, 0) + 1
        flush()


def by_depth(parent: np.ndarray) -> list[np.ndarray]:
    """Nodes of each depth; parents come before children in ``parent``."""
    depth = np.zeros(len(parent), dtype=np.int64)
    listed = parent.tolist()
    level = [0] * len(listed)
    for i, p in enumerate(listed):
        if p >= 0:
            level[i] = level[p] + 1
    depth[:] = level
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)


def features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """Feature matrix, parents, nodes by depth and first node of each page, over all nodes of ``pages``."""
    sizes = np.array([len(p.parent) for p in pages])
    base = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    parent = np.concatenate([np.where(np.array(p.parent) < 0, -1, np.array(p.parent) + b) for p, b in zip(pages, base)])
    n = len(parent)
    matrix = np.zeros((n, len(STATIC) + len(DYNAMIC)), dtype=np.float32)
    static = [s for p in pages for s in p.static]
    matrix[np.repeat(np.arange(n), [len(s) for s in static]), np.concatenate(static)] = 1
    words, chars, linked, stops = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    held = [(node + b, text.count(" ") + 1, len(text), link, text.count(".") + text.count(",") + text.count("!") + text.count("?"))
            for p, b in zip(pages, base) for node, text, link in p.segments]
    if held:
        node, *values = np.array(held).T
        for target, value in zip((words, chars, linked, stops), values):
            np.add.at(target, node, value)
    paragraphs = np.zeros(n)
    is_p = np.flatnonzero(matrix[:, _PLACE["tag:p"]])
    np.add.at(paragraphs, parent[is_p], 1)
    below, all_chars, all_linked = words.copy(), chars.copy(), linked.copy()
    depths = by_depth(parent)
    for nodes in depths[:0:-1]:
        for total in (below, all_chars, all_linked):
            np.add.at(total, parent[nodes], total[nodes])
    links = np.minimum(all_linked / np.maximum(all_chars, 1), 1)
    whole = np.repeat(np.maximum(below[base], 1), sizes)
    dynamic = [np.ones(n), np.log1p(words), words >= 10, words >= 25, np.minimum(stops / np.maximum(words, 1), 0.5), links, links > 0.5,
               np.log1p(below), below / whole, np.log1p(paragraphs), below == 0]
    matrix[:, len(STATIC):] = np.stack(dynamic, axis=1)
    return matrix, parent, depths, base
