"""Main text of web pages by a tree-structured graphical model.

Every block element of a page is a node with two states, main text or not.  A node's potential comes
from its features (tag, words of its class and id, length, links, punctuation); a potential on each
parent-child edge says how states go together.  Sum-product messages pass from the leaves to the
root and back, which gives each node's marginal exactly; the text of a page is that of the nodes
whose marginal is above one half, in page order.

The potentials are learned from ``labelled_pages``: pages made from templates in which each part is
known to be article or not.  Node potentials are a logistic regression, edge potentials the
logarithm of how much more often two states meet than if they were independent.  The model is a few
dozen numbers; it is fitted on the driver from a fixed number of pages (``TRAINING_PAGES``) and sent along.

Edge cases: a null or empty page, or one without any article, has an empty text; markup that breaks
off is read as far as it goes; repeated rows are extracted each; nesting may have any depth.  Memory
is a fixed multiple of a batch of pages.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .html_tree import DYNAMIC, STATIC, Page, features

TRAINING_PAGES = 600
PAGES_PER_RUN = 200

# --- labelled pages ---------------------------------------------------------------------------


def _words(r: random.Random, n: int) -> str:
    """Invented words with punctuation of any density, none included."""
    words = ["".join(r.choice("bcdfghklmnprstvw") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(n)]
    every = r.choice([0, 2, 4, 7, 9, 14])
    if not every:
        return " ".join(words)
    for i in range(0, n, every):
        words[i] = words[i].capitalize()
        if i:
            words[i - 1] += r.choice(".,.,?")
    return " ".join(words) + "."


def _links(r: random.Random, n: int, item: str = "li") -> str:
    return "".join(f'<{item}><a href="/{i}">{_words(r, r.randint(1, 3))[:-1]}</a></{item}>' for i in range(n))


def _boilerplate(r: random.Random) -> str:
    """One part of a page that is no article."""
    kind = r.choice(["nav", "nav_div", "header", "footer", "footer_long", "aside", "side_div", "ad", "cookie", "form", "comments", "share", "related", "newsletter", "crumbs", "hidden", "search"])
    words = _words(r, r.randint(3, 40))
    return {
        "nav": f"<nav><ul>{_links(r, r.randint(3, 12))}</ul></nav>",
        "nav_div": f'<div {r.choice(["class=menu", "id=navigation", "class=c7"])}>{_links(r, r.randint(3, 12), r.choice(["li", "span", "div"]))}</div>',
        "header": f'<header{r.choice(["", " class=site-header"])}><div>{words[:30]}</div><a href="/">{words[:12]}</a></header>',
        "footer": f"<footer>&copy; {words}</footer>",
        "footer_long": f'<{r.choice(["footer", "div class=footer", "div id=bottom"])}><p>{words}</p><p>{_words(r, 30)} <a href=x>{words[:9]}</a></p></div>',
        "aside": f"<aside><h3>{words[:15]}</h3><p>{words}</p></aside>",
        "side_div": f'<div {r.choice(["class=sidebar", "id=side", "class=right-rail"])}><h4>{words[:15]}</h4><p>{words}</p><ul>{_links(r, 4)}</ul></div>',
        "ad": f'<div class="{r.choice(["ad", "ads", "ad-slot", "advert", "sponsored", "promo box"])}">{r.choice([words, f"<p>{words}</p>"])}</div>',
        "cookie": f'<div {r.choice(["class=cookie-notice", "id=consent", "role=alert", "class=notice"])}><p>{words}</p><button>{words[:6]}</button></div>',
        "form": f'<form action=x><label>{words[:9]}</label><input name=q><p>{words}</p><button>{words[:5]}</button></form>',
        "comments": f'<{(tag := r.choice(["section", "div"]))} {r.choice(["id=comments", "class=comments-area", "class=discussion"])}><h3>{words[:12]}</h3>'
                    + "".join(f'<{r.choice(["div", "li"])} class="{r.choice(["comment", "reply", "c"])}"><p>{_words(r, r.randint(4, 50))}</p></div>' for _ in range(r.randint(1, 4))) + f"</{tag}>",
        "share": f'<div class="{r.choice(["share", "social", "tags", "post-meta"])}">{_links(r, 3, "span")}</div>',
        "related": f'<div class="{r.choice(["related", "recommended", "more"])}"><h3>{words[:14]}</h3><ul>{_links(r, 4)}</ul></div>',
        "newsletter": f'<div class="{r.choice(["newsletter", "signup", "popup"])}"><h4>{words[:16]}</h4><p>{words}</p></div>',
        "hidden": f'<div {r.choice(["hidden", "style=display:none", "aria-hidden=true", "class=hidden"])}><p>{words}</p></div>',
        "search": f'<div {r.choice(["class=search", "id=login", "class=contact-form", "role=search"])}><p>{words[:30]}</p><input name=q></div>',
        "crumbs": f'<div class=breadcrumbs>{_links(r, 3, "span")}</div>',
    }[kind]


def _article_part(r: random.Random) -> str:
    kind = r.choice(["p"] * 10 + ["p_open"] * 2 + ["h2", "list", "quote", "pre", "table", "wrapped", "bare"])
    words = _words(r, r.choice([1, 2, 3, 6, 12, 25, 40, 60, 90]))
    return {
        "p": f"<p>{words}</p>", "p_open": f"<p><b>{words}<br>", "h2": f"<h2>{words[:25]}</h2>",
        "list": "<ul>" + "".join(f"<li>{_words(r, r.randint(1, 20))}</li>" for _ in range(r.randint(2, 5))) + "</ul>",
        "quote": f"<blockquote><p>{words}</p></blockquote>", "pre": f"<pre>{words}</pre>",
        "table": f"<table><tr><td>{words[:12]}<td>{_words(r, 4)}</tr></table>",
        "wrapped": f'<div{r.choice(["", " class=text", " class=c3"])}><p>{words}</p></div>',
        "bare": f'<p>{words} <a href="/x">{_words(r, 2)}</a> {_words(r, 9)}</p>',
    }[kind]


def labelled_page(r: random.Random) -> str:
    """A page in which ``data-y`` gives the state of an element and what is below it, unless told otherwise."""
    def part():
        text = _boilerplate(r)
        cut = text.index(">") if " " not in text[:text.index(">")] else text.index(" ")
        return f"{text[:cut]} data-y=0{text[cut:]}"

    inner = [f"<h1>{_words(r, r.randint(2, 9))}</h1>"] if r.random() < 0.8 else []
    if inner and r.random() < 0.15:
        inner = [f"<header>{inner[0]}</header>"]
    for _ in range(r.choice([1, 1, 2, 3, 5, 8, 14])):
        inner.append(_article_part(r))
        if r.random() < 0.08:
            inner.append(part())
    if r.random() < 0.15:
        inner.append(part())
    if sum(len(x) for x in inner) < 120 or r.random() < 0.5:
        tag, end = r.choice([("article", "article"), ("article", "article"), ("main", "main"), ("article class=post", "article")])
    else:
        tag, end = r.choice([("div id=content", "div"), ("div class=article-body", "div"), ("div class=post", "div"), ("section class=story", "section"), ("div", "div"), ("div class=c2", "div")])
    main = f"<{tag} data-y=1>{''.join(inner)}</{end}>"
    if r.random() < 0.2:
        main = f'<{r.choice(["div", "main", "div class=wrapper"])}>{part() if r.random() < 0.5 else ""}{main}{part() if r.random() < 0.5 else ""}</div>'
    before, after = [part() for _ in range(r.randint(0, 4))], [part() for _ in range(r.randint(0, 4))]
    return f"<!DOCTYPE html><html><head><title>x</title></head><body>{''.join(before)}{main}{''.join(after)}</body></html>"


def labelled_pages(n: int = TRAINING_PAGES, seed: int = 3) -> list[str]:
    r = random.Random(seed)
    return [labelled_page(r) for _ in range(n)]


# --- the model --------------------------------------------------------------------------------


def fit(pages: list[str], steps: int = 30, penalty: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the node features and the 2 x 2 edge potentials (parent, child)."""
    parsed = [Page(p) for p in pages]
    x, parent, _, _ = features(parsed)
    x = x.astype(np.float64)
    y = np.array([v for p in parsed for v in p.label], dtype=np.float64)
    w = np.zeros(x.shape[1])
    for _ in range(steps):  # Newton
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - penalty * w
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w)), gradient)
    inner = parent >= 0
    joint = np.ones((2, 2))
    np.add.at(joint, (y[parent[inner]].astype(int), y[inner].astype(int)), 1)
    joint /= joint.sum()
    return w, np.log(joint / np.outer(joint.sum(axis=1), joint.sum(axis=0)))


def marginals(unary: np.ndarray, parent: np.ndarray, depths: list[np.ndarray], edge: np.ndarray) -> np.ndarray:
    """Probability of state 1 at each node of a forest; ``unary`` holds log potentials of state 1 against 0."""
    belief = np.stack([np.zeros(len(unary)), unary], axis=1)
    sent = np.zeros_like(belief)
    for nodes in depths[:0:-1]:  # upward: what each node tells its parent
        sent[nodes] = np.logaddexp(belief[nodes, 0, None] + edge[:, 0], belief[nodes, 1, None] + edge[:, 1])
        np.add.at(belief, parent[nodes], sent[nodes])
    for nodes in depths[1:]:  # downward: the parent's belief without what the node itself said
        rest = belief[parent[nodes]] - sent[nodes]
        belief[nodes] += np.logaddexp(rest[:, 0, None] + edge[0], rest[:, 1, None] + edge[1])
        belief[nodes] -= belief[nodes].max(axis=1, keepdims=True)
    return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500)))


def extract(pages: list[str | None], model: tuple[np.ndarray, np.ndarray]) -> list[str]:
    """Main text of each page."""
    w, edge = model
    out = []
    for start in range(0, len(pages), PAGES_PER_RUN):
        parsed = [Page(p or "", labelled=False) for p in pages[start:start + PAGES_PER_RUN]]
        x, parent, depths, base = features(parsed)
        main = marginals(x @ w, parent, depths, edge) > 0.5
        out += ["\n".join(text for node, text, _ in p.segments if main[b + node]) for p, b in zip(parsed, base)]
    return out


def extract_main_text(pages: DataFrame, model: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row per row of ``pages``."""
    sent = pages.sparkSession.sparkContext.broadcast(model or fit(labelled_pages()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = extract(batch["html"].tolist(), sent.value)
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    # Ids travel as text: pandas has no exact 64-bit numbers beside nulls.
    found = pages.select(F.col("page_id").cast("long").cast("string"), "url", "html").mapInPandas(run, "page_id string, url string, text string, n_chars long")
    return found.withColumn("page_id", F.col("page_id").cast("long"))


def weights_by_name(model: tuple[np.ndarray, np.ndarray]) -> dict[str, float]:
    return dict(zip([*STATIC, *DYNAMIC], model[0].round(3).tolist()))
