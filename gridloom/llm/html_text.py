"""HTML extraction: gradient-boosted trees over DOM nodes, and hierarchical decoding.

Each element gets the log-odds that most of its text belongs to the article, from trees over its tag, its
attribute tokens (hashed words and pieces of words, with learned shares of the kinds of elements they stand
on), text, link and subtree density, depth and siblings. Decoding then chooses nodes to keep such that their
log-odds add up to the most while a dropped node drops all below it: no choice contradicts one above or below
it. Tokens and trees are trained in numpy on generated pages of many layouts, whose truth is known; nothing
of the pages to be judged is used in training.

Edge cases: a null or empty page has an empty text, so has one without an article. Unclosed and stray tags
are repaired as browsers mostly do; text outside all elements, before or after the body too, is judged as an
element's. A ``<`` that begins no tag is text, and so is all from a tag on that never ends. Text is never cut.
Repeated rows are extracted each for itself. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import dom
from .common import read, text_of


@dataclass(frozen=True)
class Settings:
    #: Generated pages that tokens are learned from, and those that trees are fitted on.
    named: int = 500
    pages: int = 500
    trees: int = 70
    depth: int = 4
    bins: int = 24
    rate: float = 0.2
    seed: int = 5


class Trees:
    """Boosted trees of one depth, for log-odds."""

    def __init__(self, how: Settings):
        self.how, self.splits, self.limits, self.leaves, self.base = how, [], [], [], 0.0

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> "Trees":
        how = self.how
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, how.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)])
        width = how.bins
        share = np.average(y, weights=weight)
        self.base = float(np.log(share / (1 - share)))
        z = np.full(len(y), self.base)
        for _ in range(how.trees):
            p = 1 / (1 + np.exp(-z))
            g, h = weight * (y - p), weight * p * (1 - p)
            node = np.zeros(len(y), int)
            split, limit = np.zeros(2**how.depth - 1, int), np.full(2**how.depth - 1, np.inf)
            for level in range(how.depth):
                n, base = 2**level, 2**level - 1
                best = np.zeros(n)
                for f in range(len(binned)):
                    key = (node - base) * width + binned[f]
                    gs = np.bincount(key, g, n * width).reshape(n, width).cumsum(1)
                    hs = np.bincount(key, h, n * width).reshape(n, width).cumsum(1)
                    gt, ht = gs[:, -1:], hs[:, -1:]
                    gain = gs**2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt**2 / (ht + 1)
                    gain[:, len(cuts[f]) :] = 0
                    at = gain.argmax(1)
                    better = gain[np.arange(n), at] > best + 1e-9
                    for i in np.flatnonzero(better):
                        best[i], split[base + i], limit[base + i] = gain[i, at[i]], f, cuts[f][at[i]]
                node = 2 * node + 1 + (x[np.arange(len(x)), split[node]] > limit[node])
            leaf = node - (2**how.depth - 1)
            value = how.rate * np.bincount(leaf, g, 2**how.depth) / (np.bincount(leaf, h, 2**how.depth) + 1)
            z += value[leaf]
            self.splits.append(split)
            self.limits.append(limit)
            self.leaves.append(value)
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        z, rows = np.full(len(x), self.base), np.arange(len(x))
        for split, limit, value in zip(self.splits, self.limits, self.leaves, strict=True):
            node = np.zeros(len(x), int)
            for _ in range(self.how.depth):
                node = 2 * node + 1 + (x[rows, split[node]] > limit[node])
            z += value[node - (2**self.how.depth - 1)]
        return z


def decode(page: dom.Page, z: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Which nodes to keep: the greatest sum of weighted log-odds with no kept node below a dropped one."""
    weight = 0.3 + np.minimum(own, 400) / 100
    gain = np.clip(z, -6, 6) * weight
    gain[0] = 0  # the root has no text of its own
    best = gain.copy()
    for i in range(len(best) - 1, 0, -1):
        if best[i] > 0:
            best[page.parents[i]] += best[i]
    kept = np.zeros(len(best), bool)
    kept[0] = True
    for i in range(1, len(best)):
        kept[i] = kept[page.parents[i]] and best[i] > 0
    return kept


def own_sizes(page: dom.Page) -> np.ndarray:
    out = np.zeros(len(page.tags))
    for node, _, run in page.runs:
        out[node] += len(run.strip())
    return out


#: Words that sites give to parts of a page, by the part: what the generated pages are named with.
NAMES = (
    "nav navbar navigation menu menubar mainmenu breadcrumb breadcrumbs toc pagination pager topnav submenu skip links sitemap tabs",
    "header masthead banner topbar branding logo hero titlebar pagehead sitehead tagline",
    "footer foot copyright legal colophon contentinfo imprint bottombar credits disclaimer",
    "sidebar side aside rail complementary widget widgets secondary panel column author bio box",
    "ad ads advert advertisement adslot adbox sponsor sponsored promo promoted promotion banner commercial dfp outbrain adsense",
    "cookie cookies consent notice alert popup modal newsletter subscribe gdpr overlay toast paywall signup message warning privacy",
    "comment comments reply replies disqus discussion respond feedback review reviews thread commentlist responses",
    "related share sharing social recommend recommended popular trending tags more teaser readnext similar latest suggestions",
    "form search login contact register subscribe-form input query newsletter-form searchbox",
    "article post entry story content main body text prose copy page document page-content richtext markdown",
)
KINDS = len(NAMES)
LABEL = 0xE010


class Layouts:
    """Generates pages of which it knows the article; article text stands in private-use brackets, kinds of elements in a mark."""

    ON, OFF = "\ue000", "\ue001"

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.words = ["".join(self.r.choice(("an", "the", "or", "ti", "ne", "ka", "lo", "mi", "su", "re", "é", "ß", "st")) for _ in range(self.r.choice((1, 2, 2, 3, 4)))) for _ in range(900)]

    @classmethod
    def clean(cls, source: str) -> str:
        """The page as a site would send it."""
        return re.sub(f' itemprop="[{chr(LABEL)}-{chr(LABEL + 15)}]"|[{cls.ON}{cls.OFF}]', "", source)

    def some(self, n: int) -> str:
        return " ".join(self.r.choice(self.words) for _ in range(n))

    def sentence(self) -> str:
        words = self.some(self.r.randint(1, 18)).split()
        if len(words) > 6 and self.r.random() < 0.5:
            words[3] += ","
        return " ".join(words).capitalize() + self.r.choice("....!?")

    def text(self, most: int) -> str:
        return " ".join(self.sentence() for _ in range(self.r.randint(1, most)))

    def name(self, kind: int) -> str:
        """A class for a kind of element, as sites make them."""
        r, word = self.r, self.r.choice(NAMES[kind].split())
        style = r.random()
        if style < 0.45:
            return word
        if style < 0.6:
            return f"{r.choice(('site', 'page', 'js', 'c', 'l', 'block', 'main', 'wp', 'top'))}-{word}"
        if style < 0.75:
            return f"{word}-{r.choice(('wrapper', 'inner', 'box', 'list', 'area', 'section', 'item', 'container', '2', 'block'))}"
        if style < 0.85:
            return f"{word}{r.choice(('Box', 'Area', 'List', 'Wrap', 'Container', 'Inner'))}"
        return f"{word}__{r.choice(('body', 'inner', 'item', 'title'))} {r.choice(('clearfix', 'row', 'col-md-4', 'is-open', 'mt-3', 'u-hidden'))}"

    def tag(self, names: str, inner: str, kind: int | None = None, chance: float = 0.8) -> str:
        r, name = self.r, self.r.choice(names.split())
        told = ""
        if kind is not None:
            named = r.random() < chance
            if named:
                told = f' {r.choice(("class", "class", "class", "id", "role"))}="{self.name(kind)}"'
            elif r.random() < 0.4:
                told = f' class="{r.choice(("css-", "sc-", "x"))}{r.randrange(1 << 24):x}"'
            if named or name not in ("div", "section", "p", "span", "ul", "ol", "li"):
                told += f' itemprop="{chr(LABEL + kind)}"'
        return f"<{name}{told}>{inner}</{name}>"

    def links(self, n: int) -> str:
        items = "".join(f'<li><a href="/{i}">{self.some(self.r.randint(1, 3))}</a>{self.r.choice(("</li>", ""))}' for i in range(n))
        return f"<ul>{items}</ul>" if self.r.random() < 0.7 else self.r.choice((" ", " | ", " &raquo; ", "<br>")).join(f'<a href="/{i}">{self.some(self.r.randint(1, 4))}</a>' for i in range(n))

    def clutter(self, kind: int) -> str:
        r = self.r
        if kind == 0:
            return self.tag("nav nav div ul menu", self.links(r.randint(2, 14)), 0)
        if kind == 1:
            return self.tag("header header div", r.choice(("", f"<h1>{self.some(3)}</h1>", f"<div>{self.some(2)}</div>", '<img src="logo.png" alt="logo">')) + f"<p>{self.some(r.randint(2, 9))}</p>" + r.choice(("", self.links(4))), 1)
        if kind == 2:
            return self.tag("footer footer div", f"&copy; {self.some(2)} &middot; {self.text(r.choice((1, 1, 2, 5)))}" + r.choice(("", self.links(5))), 2)
        if kind == 3:
            return self.tag("aside div section", f"<h3>{self.some(2)}</h3>" + r.choice((self.links(6), f"<p>{self.text(3)}</p>")), 3, 0.9)
        if kind == 4:
            return self.tag("div div section aside p span ins", r.choice((self.text(4), f"<p>{self.text(3)}</p>", f'<a href="/x">{self.text(1)}</a>', f"<small>{self.some(1)}</small><p>{self.text(2)}</p>")), 4, 1.0)
        if kind == 5:
            return self.tag("div div section dialog noscript", f"<p>{self.text(3)}</p>" + r.choice(("", "<button>OK</button>", self.links(2))), 5, 1.0)
        if kind == 6:
            one = lambda: self.tag("div li article p", r.choice(("", f"<b>{self.some(2)}</b> ", f"<cite>{self.some(1)}</cite><time>{r.randint(1, 28)}.{r.randint(1, 12)}.</time>")) + r.choice((f"<p>{self.text(5)}</p>", self.text(5))), 6, 0.6)
            inner = f"<h3>{self.some(1)}</h3>" + "".join(one() for _ in range(r.randint(1, 7)))
            return self.tag("section div ol", inner, 6, 1.0)
        if kind == 7:
            return self.tag("div section ul aside", f"<h4>{self.some(2)}</h4>" + r.choice((self.links(r.randint(3, 8)), "".join(f'<div><a href="/{i}">{self.text(1)}</a></div>' for i in range(r.randint(2, 6))))), 7, 0.9)
        return self.tag("form form div", f"<label>{self.some(2)}</label><input name='q'><select><option>{self.some(1)}<option>{self.some(1)}</select><button>{self.some(1)}</button>" + r.choice(("", f"<p>{self.text(1)}</p>")), 8, 0.7)

    def part(self) -> str:
        """One block of an article."""
        r = self.r
        mark = lambda x: self.ON + x + self.OFF
        kind = r.random()
        if kind < 0.6:
            body = mark(self.text(r.choice((1, 2, 5, 12))))
            if r.random() < 0.25:
                body += mark(f' <a href="/a">{self.some(2)}</a> {self.some(3)}.'.replace("<a", f"{self.OFF}<a").replace('">', f'">{self.ON}').replace("</a>", f"{self.OFF}</a>{self.ON}"))
            if r.random() < 0.15:
                inline = r.choice(("em", "strong", "b", "i", "span", "u", "mark", "sup", "code"))
                body += f" <{inline}>{mark(self.text(1))}</{inline}> {mark(self.text(1))}"
            if r.random() < 0.2:
                body += r.choice(("<br>", "<br/>\n", "<hr>")) + mark(self.text(2))
            return f"<p>{body}" + r.choice(("</p>", "</p>", ""))
        if kind < 0.68:
            return f"<div>{mark(self.text(4))}</div>"
        if kind < 0.76:
            level = r.choice("2223346")
            return f"<h{level}>{mark(self.some(r.randint(1, 7)))}</h{level}>"
        if kind < 0.83:
            outer = r.choice(("ul", "ol"))
            return f"<{outer}>" + "".join(f"<li>{mark(self.text(2))}" + r.choice(("</li>", "")) for _ in range(r.randint(1, 8))) + f"</{outer}>"
        if kind < 0.86:
            return "<dl>" + "".join(f"<dt>{mark(self.some(2))}<dd>{mark(self.sentence())}" for _ in range(r.randint(1, 5))) + "</dl>"
        if kind < 0.89:
            return f"<blockquote>{mark(self.text(3))}</blockquote>"
        if kind < 0.92:
            return "<table>" + "".join(f"<tr><td>{mark(self.some(1))}</td><td>{mark(self.some(2))}</td></tr>" for _ in range(r.randint(1, 6))) + "</table>"
        if kind < 0.94:
            return f"<pre>{mark(self.some(8))}</pre>" if r.random() < 0.5 else f"<figure><img src=x><figcaption>{mark(self.text(1))}</figcaption></figure>"
        if kind < 0.96:
            return f"<section><h3>{mark(self.some(3))}</h3><p>{mark(self.text(6))}</p></section>"
        if kind < 0.975:
            return f"<p>{mark(self.some(4))} <math><mi>{mark('x')}</mi><mo>{mark('=')}</mo><mn>{mark('2')}</mn></math> {mark(self.text(1))}</p>"
        return self.clutter(r.choice((4, 4, 7, 5)))

    def article(self) -> str:
        r, parts = self.r, []
        if r.random() < 0.85:
            parts.append(f"<h1>{self.ON}{self.some(r.randint(1, 9))}{self.OFF}</h1>")
        parts += [self.part() for _ in range(r.choice((1, 1, 2, 4, 8, 16, 30)))]
        body = "".join(parts)
        if r.random() < 0.3:
            body = self.tag("div section", body, 9, 0.7)
        return self.tag("article article article main div div section td", body, 9, 0.6)

    def page(self) -> str:
        r = self.r
        if r.random() < 0.04:  # a fragment, or just text
            text = f"{self.ON}{self.text(9)}{self.OFF}"
            return text if r.random() < 0.4 else "".join([text, *(self.part() for _ in range(4)), f"{self.ON}{self.text(3)}{self.OFF}"])
        top = [self.clutter(k) for k in (0, 1, 4, 5, 8) if r.random() < 0.5]
        side = [self.clutter(k) for k in (3, 7, 4) if r.random() < 0.3]
        end = [self.clutter(k) for k in (6, 7, 8, 3, 5) if r.random() < 0.35] + [self.clutter(2)] * (r.random() < 0.85)
        r.shuffle(top)
        middle = [self.article(), *side] if r.random() < 0.6 else [*side, self.article()]
        inner = "".join(middle)
        if r.random() < 0.35:
            inner = self.tag("main div div", inner, None if r.random() < 0.5 else 9, 0.7)
        if r.random() < 0.1:
            inner = f"<table><tr>{''.join(f'<td>{x}</td>' for x in middle)}</table>"
        if r.random() < 0.3:
            end.insert(0, inner)
            inner = self.tag("div", "".join(end))
            end = []
        lead = r.choice(("<!DOCTYPE html>", "", "<!-- page -->", "<?xml version='1.0'?>"))
        return f"{lead}<html><head><title>{self.some(4)}</title><style>p{{}}</style></head><body>{''.join(top)}{inner}{''.join(end)}" + r.choice(("</body></html>", ""))


@dataclass
class Extractor:
    """What extraction needs: learned attribute tokens, and trees."""

    learned: dom.Tokens
    trees: Trees


@lru_cache(2)
def trained(how: Settings = Settings()) -> Extractor:
    """Tokens and trees fitted on generated pages: tokens on the first part of them, trees on the rest."""
    layouts, xs, ys, ws = Layouts(how.seed), [], [], []
    learned = dom.Tokens(KINDS)
    for _ in range(how.named):
        page = dom.Page(layouts.page())
        for i in range(1, len(page.tags)):
            told = page.attributes[i]
            kind = ord(told[-1]) - LABEL if told and 0 <= ord(told[-1]) - LABEL < KINDS else KINDS
            learned.learn(page.tags[i], told[:-2] if kind < KINDS else told, kind)
    learned.finish()
    for _ in range(how.pages):
        page = dom.Page(layouts.page())
        page.attributes = [a[:-2] if a and 0 <= ord(a[-1]) - LABEL < KINDS else a for a in page.attributes]
        good, every = np.zeros(len(page.tags)), np.zeros(len(page.tags))
        for i, (node, block, run) in enumerate(page.runs):
            clean = run.replace(Layouts.ON, "").replace(Layouts.OFF, "")
            every[node] += len(clean.strip())
            good[node] += len(clean.strip()) * (Layouts.ON in run)
            page.runs[i] = (node, block, clean)
        own = every.copy()
        for i in range(len(good) - 1, 0, -1):
            good[page.parents[i]] += good[i]
            every[page.parents[i]] += every[i]
        use = every > 0
        use[0] = False
        xs.append(dom.features(page, learned)[use])
        ys.append((good > 0.5 * every)[use])
        ws.append((0.3 + np.minimum(own, 400) / 100)[use] / (0.3 + len(own) / 100))
    return Extractor(learned, Trees(how).fit(np.concatenate(xs), np.concatenate(ys).astype(float), np.concatenate(ws)))


def extract(sources: list[str], by: Extractor) -> list[str]:
    """The article texts of whole pages."""
    out: list[str] = []
    at = 0
    while at < len(sources):
        pages, nodes = [], 0
        while at < len(sources) and nodes < 4000:
            pages.append(dom.Page(sources[at]))
            nodes += len(pages[-1].tags)
            at += 1
        z = np.split(by.trees.predict(np.concatenate([dom.features(p, by.learned) for p in pages])), np.cumsum([len(p.tags) for p in pages])[:-1])
        out += [page.text(decode(page, odds, own_sizes(page))) for page, odds in zip(pages, z, strict=True)]
    return out


RESULT = "page_id long, url string, text string, n_chars long"


def extract_pages(pages: DataFrame, how: Settings = Settings()) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of pages (page_id, url, html)."""
    shared = pages.sparkSession.sparkContext.broadcast(trained(how))

    def run(batches):
        by = shared.value
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                texts = extract(text_of(part, "html").to_pylist(), by)
                yield pa.RecordBatch.from_arrays([part.column("page_id").cast(pa.int64()), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, RESULT)


def op7_html_extraction(spark, sf_dir):
    """Article texts of all pages."""
    return extract_pages(read(spark, sf_dir, "pages"))
