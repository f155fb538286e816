"""A forgiving HTML parser into flat node arrays, and features of the nodes. Time grows with the page's length only."""

from __future__ import annotations

import html
import re
import zlib

import numpy as np

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is code or a control's value, never text of the page.
RAW = frozenset("script style textarea title".split())
BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
#: An opening tag closes the nearest open one of these, unless one of SCOPE lies between.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "tbody", "thead"}}
SCOPE = frozenset("html body table ul ol dl div section article main aside nav header footer form td th blockquote select menu".split())
PARAGRAPH = frozenset(("p",))
OUTSIDE = {t: SCOPE - ends for t, ends in CLOSES.items()}
NAME = re.compile(r"/?[a-zA-Z][^\s/>]*+")
#: One attribute, or what stands between two; quotes count only around values.
ATTRIBUTE = re.compile(r"[\s/]*+(?:([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*+)))?+)?+")
END = {t: re.compile(rf"</{t}(?=[\s/>]|$)", re.I) for t in RAW}
TELLING = frozenset(("class", "id", "role", "itemprop", "aria-label"))
GROUPS = ("nav menu", "header hgroup", "footer", "aside", "main", "article", "section", "div center", "p", "h1 h2 h3 h4 h5 h6", "ul ol dl dir", "li dt dd", "a", "form button select label fieldset option legend", "table tbody thead tr td th tfoot", "blockquote", "figure figcaption", "pre code", "body html", "b i em strong span u small sub sup mark")
GROUP = {t: i for i, g in enumerate(GROUPS) for t in g.split()}
_POINTS = re.compile(r"[.,;:!?。，]")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+|[^\W\d_a-zA-Z]+")


class Page:
    """Nodes in page order: tag, parent, depth, attribute text; and text runs (node, block, text).

    Text outside all elements stands in an implied body.
    """

    def __init__(self, source: str):
        self.tags, self.parents, self.depths, self.attributes = ["#root"], [-1], [0], [""]
        self.runs: list[tuple[int, int, str]] = []
        self._stack = [0]
        #: Where in the stack each tag is open.
        self._open: dict[str, list[int]] = {}
        self._body = 0
        self._parse(source)

    def _push(self, tag: str, told: str = "") -> int:
        self.tags.append(tag)
        self.parents.append(self._stack[-1])
        self.depths.append(len(self._stack))
        self.attributes.append(told)
        self._open.setdefault(tag, []).append(len(self._stack))
        self._stack.append(len(self.tags) - 1)
        return self._stack[-1]

    def _pop(self, size: int) -> None:
        while len(self._stack) > size:
            self._open[self.tags[self._stack.pop()]].pop()

    def _say(self, block: int, text: str) -> None:
        node = self._stack[-1]
        if not node:
            if not text.strip():
                return
            if not self._body:
                self._body = self._push("body")
                self._pop(1)
            node = self._body
        self.runs.append((node, block, text))

    def _top(self, tags) -> int:
        return max((self._open[t][-1] for t in tags if self._open.get(t)), default=0)

    def _attributes(self, source: str, at: int) -> tuple[int, str]:
        """The place behind the tag's end, or -1 if it has none; and the values that tell what the element is."""
        told, n = [], len(source)
        while at < n and source[at] != ">":
            m = ATTRIBUTE.match(source, at)
            if m[1] and m[1].lower() in TELLING:
                told.append(m[2] or m[3] or m[4] or "")
            at = m.end()
        return (at + 1 if at < n else -1), " ".join(told)

    def _parse(self, source: str) -> None:
        block, at, n, head = 0, 0, len(source), False
        begin = 0  # of text that isn't said yet
        while at < n:
            at = source.find("<", at)
            if at < 0:
                break
            start = at
            if source.startswith("<!--", at):
                end = source.find("-->", at + 4)
                end = end + 3 if end >= 0 else n
                name = ""
            elif (m := NAME.match(source, at + 1)) is not None:
                end, told = self._attributes(source, m.end())
                if end < 0:  # no tag ends here or later
                    break
                name = m[0].lower()
            elif at + 1 < n and source[at + 1] in "!?/":
                end = source.find(">", at) + 1 or n
                name = ""
            else:
                at += 1
                continue
            if start > begin and not head:
                self._say(block, source[begin:start])
            begin = at = end
            if not name:
                continue
            if name[0] == "/":
                tag = name[1:]
                head = head and tag != "head"
                block += tag in BLOCK
                if tag not in ("body", "html") and self._open.get(tag):
                    self._pop(self._open[tag][-1])
                continue
            tag = name
            if tag in RAW:
                close = END[tag].search(source, at)
                end = source.find(">", close.end()) if close else -1
                begin = at = end + 1 if end >= 0 else n
                continue
            if tag == "head":
                head = True
                continue
            if tag in BLOCK:
                head = False
                block += 1
            if tag in VOID:
                continue
            ends = CLOSES.get(tag) or (PARAGRAPH if tag in BLOCK else None)
            while ends and (top := self._top(ends)) and top > self._top(OUTSIDE.get(tag, SCOPE)):
                self._pop(top)
                if tag not in ("tr", "tbody"):
                    break
            self._push(tag, told)
        if begin < n and not head:
            self._say(block, source[begin:])

    def text(self, kept: np.ndarray) -> str:
        """The text of kept nodes: white space single within blocks, blocks joined by one space."""
        blocks, last, part = [], None, []
        for node, block, run in self.runs:
            if kept[node]:
                if block != last:
                    blocks.append(part := [])
                    last = block
                part.append(run)
        done = (" ".join(html.unescape("".join(b)).split()) for b in blocks)
        return " ".join(x for x in done if x)


def tokens(tag: str, attribute: str) -> list[str]:
    """What an element's tag and attributes say: the tag, the words, and pieces of four letters of the words."""
    out = [f"<{tag}>"]
    for word in _TOKEN.findall(attribute):
        word = word.lower()
        out.append(word)
        if len(word) > 4:
            edged = f"^{word}$"
            out += [edged[i : i + 5] for i in range(len(edged) - 4)]
    return out


class Tokens:
    """Learned attribute tokens: for hashed tokens the shares of the kinds of elements that they were seen on."""

    def __init__(self, kinds: int, size: int = 1 << 13):
        self.counts, self.size, self.kinds = np.zeros((size, kinds + 1)), size, kinds
        self.known: dict[tuple[str, str], np.ndarray] = {}

    def spots(self, tag: str, attribute: str) -> list[int]:
        return [zlib.crc32(t.encode("utf-8", "surrogatepass")) % self.size for t in tokens(tag, attribute)]

    def learn(self, tag: str, attribute: str, kind: int) -> None:
        """kind: of the element that the attribute is on; the last one stands for all others."""
        for i in set(self.spots(tag, attribute)):
            self.counts[i, kind] += 1

    def finish(self, prior: float = 3.0) -> Tokens:
        share = self.counts.sum(0) / max(self.counts.sum(), 1)
        self.table = ((self.counts + prior * share) / (self.counts.sum(1, keepdims=True) + prior))[:, : self.kinds]
        return self

    def scores(self, tag: str, attribute: str) -> np.ndarray:
        """For each kind the greatest share of any token of the element."""
        found = self.known.get((tag, attribute))
        if found is None:
            found = self.table[self.spots(tag, attribute)].max(axis=0)
            if len(self.known) < 20_000:
                self.known[tag, attribute] = found
        return found


DENSITIES = 22


def features(page: Page, learned: Tokens) -> np.ndarray:
    """A row for each node: attribute tokens of itself and of its ancestors, densities, depth and siblings."""
    n = len(page.tags)
    parents = np.array(page.parents)
    own, points, linked, items, paras, count, words = (np.zeros(n) for _ in range(7))
    first = np.full(n, np.inf)
    at = 0
    inside = np.zeros(n, bool)
    flags, above = np.zeros((n, learned.kinds)), np.zeros((n, learned.kinds))
    for i in range(1, n):
        tag, p = page.tags[i], page.parents[i]
        inside[i] = inside[p] or tag == "a"
        np.maximum(above[p], flags[p], out=above[i])
        flags[i] = learned.scores(tag, page.attributes[i])
        items[i], paras[i] = tag == "li", tag == "p"
    for node, _, run in page.runs:
        size = len(run.strip())
        if size:
            own[node] += size
            points[node] += len(_POINTS.findall(run))
            words[node] += run.count(" ") + 1
            if inside[node]:
                linked[node] += size
            first[node] = min(first[node], at)
            at += size
    whole = own.copy()
    for i in range(n - 1, 0, -1):
        p = parents[i]
        for x in (whole, points, linked, items, paras, words):
            x[p] += x[i]
        count[p] += count[i] + 1
        first[p] = min(first[p], first[i])
    total = max(whole[0], 1)
    children = np.bincount(parents[1:], minlength=n) if n > 1 else np.zeros(n)
    place, before, after, seen, last = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n, int), np.full(n, -1)
    for i in range(1, n):
        p = parents[i]
        place[i], seen[p] = seen[p], seen[p] + 1
        if last[p] >= 0:
            before[i], after[last[p]] = whole[last[p]], whole[i]
        last[p] = i
    safe = np.maximum(whole, 1)
    up = np.maximum(parents, 0)
    group = np.array([GROUP.get(t, len(GROUPS)) for t in page.tags], float)
    columns = [
        np.log1p(whole), np.log1p(own), linked / safe, whole / (count + 1), np.array(page.depths, float), place / np.maximum(children[up], 1), children[up], np.log1p(paras), np.log1p(items),
        points / safe, words / (paras + items + 1), np.where(np.isfinite(first), first, at) / total, whole / total, (linked / safe)[up], (whole / total)[up], np.log1p(before), np.log1p(after), group, group[up], children, np.log1p(count), whole / np.maximum(whole[up], 1),
    ]
    return np.hstack([flags, above, np.stack(columns, axis=1)])
