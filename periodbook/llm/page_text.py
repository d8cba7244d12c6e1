"""Main text of web pages by nearest-URL page differencing.

A page is read as lines: the texts of its blocks, without markup, scripts, styles, menus, forms and
elements whose name, role, class or id says that they are no content (as a whole word, or put together from such
words and words of place; inside an article only as a whole word; headings never). End tags that HTML lets out are
implied; chrome that lacks its own end tag ends with its parent, or where an article or main element begins. Pages are paired within each
host with the page whose URL path is nearest: the neighbour in path order with the longer common
beginning (of the two neighbours; if they are equally near, the one with more lines in common; copies
of the page itself, however many and under whatever path, are passed over). The longest common
subsequence of the two pages' lines is template text and is deleted, inside the page's ``article`` or
``main`` element as well as outside it. Only paragraphs and headings inside that element stay
although the other page has them: they are text by the author's own mark.

Neighbours are sought among the distinct (host, path, lines), of which only hashes of the lines are
held. They are cut into ranges of about ``per_range`` by host and path, whatever host they are of; each
range is told the nearest other pages before and after it, so the cuts change no result.

Cases: null html is empty and gives empty text; null or unparsable URLs make a host of their own; a
page alone on its host keeps all its lines; repeated rows each give a row; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable, Iterator
from html import unescape

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodbook.llm.common import batches, hashes, keep, parts

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|noscript|template|textarea|svg|iframe)\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9-]*)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>|(?P<text>[^<]+|<)",
    re.IGNORECASE | re.DOTALL,
)
# HTML elements by their part in a page.
DROPPED = frozenset("head title nav footer aside form button select dialog menu object canvas audio video".split())
MAIN = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = HEADINGS | frozenset("p pre blockquote".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr br".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
OF_HEAD = frozenset("html head title meta link base".split())
# Which open elements a start tag ends, and up to which elements they are sought.
CELL = frozenset("td th caption table".split())
LISTS = frozenset("ul ol menu".split())
ENDS_P = HEADINGS | LISTS | MAIN | frozenset(
    "address aside blockquote center details dialog dir div dl fieldset figcaption figure footer form header hgroup hr nav p pre search section summary table".split()
)
ENDS = {
    "li": (frozenset(("li",)), LISTS),
    **dict.fromkeys(("dt", "dd"), (frozenset(("dt", "dd")), frozenset(("dl",)))),
    **dict.fromkeys(("td", "th"), (frozenset(("td", "th")), frozenset(("tr", "table")))),
    "tr": (frozenset(("tr", "td", "th")), frozenset(("table",))),
    **dict.fromkeys(("thead", "tbody", "tfoot"), (frozenset("thead tbody tfoot tr td th".split()), frozenset(("table",)))),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))),
}
OPTIONAL_END = frozenset("head p li dt dd td th tr thead tbody tfoot option".split())
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
CHROME = re.compile(
    r"ads?|advert\w*|banner|sponsor\w*|promo\w*|nav|navbar|navigation|menu|breadcrumbs?|sidebar|aside|footer|masthead|"
    r"comments?|replies|disqus|cookies?|consent|gdpr|notices?|newsletter|subscribe|signup|login|popup|modal|share|social|related|contentinfo|complementary|search"
)
# words that, beside one of those, say where or how it is shown
PLACE = re.compile(
    r"site|page|main|top|bottom|left|right|upper|lower|box|bar|block|list|wrapper?|container|section|area|links?|buttons?|icons?|items?|slot|widget|inner|outer|"
    r"primary|secondary|global|mobile|desktop|fixed|sticky|text|thread|form|reader|user|\d+"
)
SPACE = re.compile(r"\s+")


def _names_chrome(token: str, whole: bool) -> bool:
    """A class, id or role that is a word for chrome; unless ``whole``, also one put together from such words and words of place."""
    if CHROME.fullmatch(token):
        return True
    parts = [] if whole else [x for x in re.split("[-_]+", token) if x]
    return len(parts) > 1 and any(CHROME.fullmatch(x) for x in parts) and all(CHROME.fullmatch(x) or PLACE.fullmatch(x) for x in parts)


def _is_chrome(name: str, attrs: str, inside: bool) -> bool:
    if name in DROPPED or name == "header" and not inside:
        return True
    if name in MAIN or name in HEADINGS or name in ("body", "html") or "=" not in attrs:
        return False
    values = (next(filter(None, m.groups()[1:]), "").lower() for m in ATTRIBUTE.finditer(attrs))
    return any(_names_chrome(token, inside) for v in values for token in v.split())


class _Open:
    """The open elements. An element is hidden that is chrome, or inside one."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int]] = []  # name, and number of the chrome element it starts (-1: none)
        self.count: dict[str, int] = defaultdict(int)
        self.hiding: tuple[int, ...] = ()  # the chrome elements that are open
        self.names: list[str] = []  # of all chrome elements met
        self.ended: list[bool] = []  # which had an end tag
        self.broken: list[int | None] = []  # when an article or main element began inside

    def push(self, name: str, chrome: bool, now: int) -> None:
        number = -1
        if name in MAIN:
            for k in self.hiding:
                self.broken[k] = now if self.broken[k] is None else self.broken[k]
        if chrome:
            number = len(self.names)
            self.names.append(name)
            self.ended.append(False)
            self.broken.append(None)
            self.hiding = (*self.hiding, number)
        self.stack.append((name, number))
        self.count[name] += 1

    def cut(self, at: int) -> None:
        """The elements from ``at`` on end."""
        for name, number in self.stack[at:]:
            self.count[name] -= 1
            if number >= 0:
                self.hiding = self.hiding[:-1]
        del self.stack[at:]

    def seek(self, names: frozenset, bounds: frozenset, all_of: bool = False) -> int | None:
        """The place of the innermost open element of ``names`` (or the outermost one) inside ``bounds``."""
        found = None
        if any(self.count[n] for n in names):
            for i in range(len(self.stack) - 1, -1, -1):
                name = self.stack[i][0]
                if name in names:
                    found = i
                    if not all_of:
                        break
                elif name in bounds:
                    break
        return found

    def start(self, name: str) -> None:
        """End what a start tag ends by being there."""
        if self.count["head"] and name not in OF_HEAD:
            if (at := self.seek(frozenset(("head",)), frozenset())) is not None:
                self.cut(at)
        if name in ENDS_P and self.count["p"] and (at := self.seek(frozenset(("p",)), CELL)) is not None:
            self.cut(at)
        if name in ENDS and (at := self.seek(*ENDS[name], all_of=name not in ("li", "option"))) is not None:
            self.cut(at)

    def end(self, name: str) -> None:
        if not self.count[name] or name in ("body", "html"):
            return
        bounds = LISTS if name == "li" else frozenset() if name in CELL or name in ENDS else CELL
        for i in range(len(self.stack) - 1, -1, -1):
            open_, number = self.stack[i]
            if open_ == name:
                if number >= 0:
                    self.ended[number] = True
                self.cut(i)
                return
            if open_ in bounds or name in INLINE and open_ not in INLINE:
                return  # it ends nothing: the element it names lies outside

    def shows(self, hiding: tuple[int, ...], now: int) -> bool:
        """Whether text at ``now`` shows. Chrome without an end tag, where one is due, ends where an article begins."""
        return all(not self.ended[k] and self.names[k] not in OPTIONAL_END and self.broken[k] is not None and self.broken[k] <= now for k in hiding)


def lines(html: str | None) -> tuple[list[str], list[bool]]:
    """Texts of the page's blocks in order, and whether each is a paragraph or heading inside its article or main element."""
    open_ = _Open()
    # what the page says: texts with the chrome they are in, and None where a block begins or ends
    said: list[tuple | None] = []
    paragraph = False

    for now, m in enumerate(TOKEN.finditer(html or "")):
        if m.lastgroup == "text":
            text = m["text"]
            if open_.stack and open_.stack[-1][0] == "head" and not text.isspace():
                open_.cut(len(open_.stack) - 1)
            said.append((now, text, open_.hiding, paragraph and any(open_.count[x] for x in MAIN)))
            continue
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name == "br":
            said.append((now, " ", open_.hiding, paragraph and any(open_.count[x] for x in MAIN)))
        if name not in INLINE:
            said.append(None)
            if name not in VOID:
                paragraph = name in PARAGRAPHS and not m["close"]
        if m["close"]:
            open_.end(name)
            continue
        open_.start(name)
        if name in VOID or m["attrs"].endswith("/") and name not in MAIN:
            continue
        inside = any(open_.count[x] for x in MAIN)
        open_.push(name, name != "a" and _is_chrome(name, m["attrs"], inside), now)

    texts: list[str] = []
    fixed: list[bool] = []
    held: list[str] = []
    stays = False
    for x in [*said, None]:
        if x is None:
            if held:
                if text := SPACE.sub(" ", unescape("".join(held))).strip():
                    texts.append(text)
                    fixed.append(stays)
                held.clear()
        elif not x[2] or open_.shows(x[2], x[0]):
            held.append(x[1])
            stays = x[3]
    return texts, fixed


def common_lines(own: list[int], other: list[int]) -> set[int]:
    """Places in ``own`` that belong to a longest common subsequence with ``other``."""
    places: dict[int, list[int]] = defaultdict(list)
    for j in range(len(other) - 1, -1, -1):
        places[other[j]].append(j)
    ends: list[int] = []  # smallest end in other of a common subsequence of each length
    nodes: list[tuple] = []
    for i, line in enumerate(own):
        for j in places.get(line, ()):
            k = bisect_left(ends, j)
            node = (i, nodes[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                nodes.append(node)
            else:
                ends[k], nodes[k] = j, node
    found, node = set(), nodes[-1] if nodes else None
    while node:
        found.add(node[0])
        node = node[1]
    return found


def shared_beginning(a: str, b: str) -> int:
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def main_text(texts: list[str], fixed: list[bool], gone: Iterable[int]) -> str:
    """The lines that stay, joined; ``gone`` are the places of the template's lines."""
    template = set(gone)
    return "\n".join(t for k, (t, stays) in enumerate(zip(texts, fixed, strict=True)) if stays or k not in template)


def _digest(marks: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(marks.tobytes())


def edges(ranges: DataFrame) -> dict[int, tuple]:
    """For each range the last pages before it and the first ones after it, two with different lines on each side at most."""
    page = F.struct("host", "path", "digest", "marks")
    ends = ranges.groupBy("range").agg(F.min(page).alias("first"), F.max(page).alias("last"))
    known = ends.select("range", F.col("first.digest").alias("f"), F.col("last.digest").alias("l"))
    seconds = ranges.join(F.broadcast(known), "range").groupBy("range").agg(
        F.min(F.when(F.col("digest") != F.col("f"), page)).alias("first"), F.max(F.when(F.col("digest") != F.col("l"), page)).alias("last")
    )
    # bounded: one row per range
    one, two = ({r["range"]: r for r in x.collect()} for x in (ends, seconds))
    out: dict[int, list] = {k: [(), ()] for k in one}
    for side, name, order in ((0, "last", sorted(one)), (1, "first", sorted(one, reverse=True))):
        near: list = []
        for k in order:
            out[k][side] = tuple(near)
            own = [tuple(x[name]) for x in (one[k], two[k]) if x[name] is not None]
            near = (own + [x for x in near if x[2] != own[0][2]])[:2]
    return {k: tuple(v) for k, v in out.items()}


def templates(f: pd.DataFrame, before: tuple, after: tuple) -> list[list[int]]:
    """The places of the template lines of each page of a range in order (host, path, digest, marks)."""
    rows = list(zip(f["host"], f["path"], f["digest"], f["marks"], strict=True))

    def others(order: range, near: tuple) -> list:
        """The nearest page with other lines that comes earlier in ``order``, if it is of the same host."""
        found: list = [None] * len(rows)
        last, other = (*near, None, None)[:2]  # the page met last, and the nearest one with other lines than that
        for i in order:
            if last is not None and last[2] != rows[i][2]:
                other = last
            found[i] = other if other is not None and other[0] == rows[i][0] else None
            last = rows[i]
        return found

    out = []
    for row, a, b in zip(rows, others(range(len(rows)), before), others(range(len(rows) - 1, -1, -1), after), strict=True):
        own = list(row[3])
        near = [(shared_beginning(row[1], x[1]), common_lines(own, list(x[3]))) for x in (a, b) if x is not None]
        out.append(sorted(max(near, key=lambda x: (x[0], len(x[1])))[1]) if near else [])
    return out


def extract(pages: DataFrame, per_range: int = 20_000) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html)."""
    address = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)([^?#]*)", 1)
    path = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)([^?#]*)", 2)
    placed = pages.select("page_id", "url", "html", F.lower(address).alias("host"), path.alias("path"))

    def mark(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for a, b in batches(f["html"].tolist()):
                part = f.iloc[a:b]
                marks = [hashes(lines(h)[0]).view(np.int64) for h in part["html"]]
                yield pd.DataFrame({"host": part["host"], "path": part["path"], "digest": [_digest(m) for m in marks], "marks": marks})

    marked = placed.select("host", "path", "html").mapInPandas(mark, "host string, path string, digest binary, marks array<long>")
    distinct = marked.groupBy("host", "path", "digest").agg(F.first("marks").alias("marks"))
    ranges = distinct.repartitionByRange(parts(pages.count(), per_range), "host", "path", "digest")
    ranges = keep(ranges.withColumn("range", F.spark_partition_id()), "ranges")
    near = pages.sparkSession.sparkContext.broadcast(edges(ranges))

    def decide(f: pd.DataFrame) -> pd.DataFrame:
        # as Spark orders strings, by their bytes
        keys = [(h.encode("utf-8", "surrogatepass"), p.encode("utf-8", "surrogatepass"), d) for h, p, d in zip(f["host"], f["path"], f["digest"], strict=True)]
        f = f.iloc[sorted(range(len(f)), key=keys.__getitem__)]
        found = f[["host", "path", "digest"]].assign(gone=templates(f, *near.value[int(f["range"].iloc[0])]))
        return found[[len(g) > 0 for g in found["gone"]]]

    decided = ranges.groupBy("range").applyInPandas(decide, "host string, path string, digest binary, gone array<int>")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for a, b in batches(f["html"].tolist()):
                part = f.iloc[a:b]
                got = [lines(h) for h in part["html"]]
                yield part.drop(columns=["html"]).assign(texts=[t for t, _ in got], fixed=[x for _, x in got], digest=[_digest(hashes(t)) for t, _ in got])

    parsed = placed.mapInPandas(read, "page_id long, url string, host string, path string, texts array<string>, fixed array<boolean>, digest binary")
    joined = parsed.join(decided, ["host", "path", "digest"], "left").select("page_id", "url", "texts", "fixed", "gone")

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            texts = [main_text(t, x, () if g is None else g) for t, x, g in zip(f["texts"], f["fixed"], f["gone"], strict=True)]
            yield pd.DataFrame({"page_id": f["page_id"], "url": f["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    return joined.mapInPandas(write, "page_id long, url string, text string, n_chars long")
