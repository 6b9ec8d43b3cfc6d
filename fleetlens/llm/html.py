"""Main text of web pages by scoring the element tree.

Every paragraph gives points, for being one, for its length and for its commas, to the elements around it: all of them
to its parent, half to the grandparent, half of that to the next above and so on. An element's points are discounted by the share of its
text that is link text. The best container and those of its siblings that look like part of the article are kept; menus,
notices, comments and the like do not take part. Elements of some tags are left out wherever they stand; a form, or an
element that only a word of its class or id speaks against, is left out unless it holds the article.
"""

from __future__ import annotations

import bisect
import html as _html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from fleetlens.llm.text import slices

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)", re.S)
_ENDS = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe xmp".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var label".split())
_PARAGRAPHS = frozenset("p pre blockquote li dt dd td th caption figcaption h1 h2 h3 h4 h5 h6 address summary".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_DROPPED = frozenset(
    "head script style noscript template nav header footer aside button select textarea iframe object svg "
    "canvas audio video dialog menu title".split())
_DOUBTFUL = frozenset(("form", "fieldset"))
_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
# Words of class and id attributes that name something other than the article.
_UNLIKELY = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices alert popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs "
    "comment comments disqus reply replies respond discussion footer header masthead related recommended share "
    "sharing social newsletter subscribe subscription signup login search widget pagination pager toolbar skip "
    "copyright disclaimer hidden".split())
# Those of what often has more text than the article beside it.
_REMARKS = frozenset(
    "comment comments disqus reply replies respond discussion related recommended cookie cookies consent gdpr".split())
_NEVER_UNLIKELY = frozenset(("html", "body", "article", "main"))
_CLOSES = {  # an opening tag ends the open elements of these names, up to the nearest barrier
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "tr": (frozenset(("tr", "td", "th")), frozenset(("table",))),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "option": (frozenset(("option",)), frozenset(("select",))),
    "body": (frozenset(("head",)), frozenset(("html",))),
}
_MARKS = {"article": 1, "main": 2, "h1": 4}
_LIKELY_BONUS = {"article": 25.0, "main": 10.0}


def _attributes(text: str) -> dict[str, str]:
    return {m[0].lower(): m[1] or m[2] or m[3] for m in _ATTRIBUTE.findall(text)} if "=" in text or text.strip(" /") else {}


def _is_dropped(tag: str, attributes: dict[str, str]) -> bool:
    if tag in _DROPPED:
        return True
    if not attributes:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or attributes.get("role") in _ROLES:
        return tag not in ("html", "body")
    return "display:none" in attributes.get("style", "").replace(" ", "").lower()


def _doubt(tag: str, attributes: dict[str, str]) -> int:
    """0 without doubt, 1 for a form or an unlikely word, 2 for a word of _REMARKS."""
    words = re.split(r"[^a-z]+", f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()) if attributes else []
    if not _UNLIKELY.isdisjoint(words):
        remarks = not _REMARKS.isdisjoint(words)
        if tag not in _NEVER_UNLIKELY or tag == "article" and any("comment" in w for w in words):
            return 2 if remarks or tag == "article" else 1
    return 1 if tag in _DOUBTFUL else 0


def _block_points(block: str, link: int) -> float:
    points = 1.0 + block.count(",") + block.count("，") + min(len(block) / 100.0, 3.0)
    return points * (1.0 - min(1.0, link / len(block)))


class _TagEnds:
    """Where tags end: at the first ``>`` outside quotes. Every quote of a page is looked at once."""

    def __init__(self, page: str):
        self._marks = [(m.start(), m[0]) for m in _ENDS.finditer(page)]
        self._at = [at for at, _ in self._marks]
        # From the last mark back: where a tag ends that gets to this mark outside quotes, -1 if nowhere.
        self._end = [-1] * (len(self._marks) + 1)
        later = {'"': len(self._marks), "'": len(self._marks)}
        for k in range(len(self._marks) - 1, -1, -1):
            at, mark = self._marks[k]
            if mark == ">":
                self._end[k] = at
            else:
                closing = later[mark]
                self._end[k] = self._end[closing + 1] if closing < len(self._marks) else -1
                later[mark] = k

    def after(self, at: int) -> int:
        return self._end[bisect.bisect_left(self._at, at)]


class _Stack:
    """Open elements (tag, number), with the places of each tag and of the elements that are not inline."""

    def __init__(self):
        self.items: list[tuple[str, int]] = [("#root", 0)]
        self.places: dict[str, list[int]] = {}
        self.block_places = [0]

    def push(self, tag: str, number: int) -> None:
        self.places.setdefault(tag, []).append(len(self.items))
        if tag not in _INLINE:
            self.block_places.append(len(self.items))
        self.items.append((tag, number))

    def last(self, tags) -> int:
        """The place of the innermost open element of these tags, 0 if there is none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def cut(self, until: int) -> int:
        """Closes what is open from a place on; how many links were among it."""
        links = 0
        for tag, _ in self.items[until:]:
            if tag:
                self.places[tag].pop()
                links += tag == "a"
        del self.items[until:]
        while self.block_places[-1] >= until:
            self.block_places.pop()
        return links

    def forget(self, place: int) -> None:
        """Closes an inline element alone; what it was around stays open."""
        tag, number = self.items[place]
        self.places[tag].pop()
        self.items[place] = ("", number)


class _Tree:
    """Elements that are not dropped, and the blocks of text in page order.

    Doubtful elements are in the tree until ``leave_out``; without ``words`` class and id are not asked.
    """

    def __init__(self, words: bool = True):
        self.words, self.inline_dropped = words, False
        self.parents, self.tags = [-1], ["#root"]
        self.doubts: dict[int, int] = {}
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters of link text

    def parse(self, page: str) -> None:
        stack = _Stack()  # open elements that are not dropped
        ends = _TagEnds(page)
        dropped: list[str] = []  # open elements inside a dropped one, that one first
        within: Counter[str] = Counter()  # how many of each tag are in ``dropped``
        text: list[str] = []
        link = [0, 0]  # open links, characters inside links

        def flush():
            if text:
                block = " ".join("".join(text).split())
                if block:
                    self.blocks.append((stack.items[stack.block_places[-1]][1], block, link[1]))
                text.clear()
                link[1] = 0

        def add(raw: str):
            if raw and not dropped:
                raw = _html.unescape(raw) if "&" in raw else raw
                text.append(raw)
                if link[0]:
                    link[1] += len(raw)

        def close(until: int):
            flush()
            link[0] -= stack.cut(until)

        at = looked = 0
        while (found := _MARKUP.search(page, looked)) is not None:
            tag = found[2]
            if tag is None:
                add(page[at:found.start()])
                at = looked = found.end()
                continue
            end = ends.after(found.end())
            if end < 0:  # never closed, so it is text
                looked = found.start() + 1
                continue
            add(page[at:found.start()])
            at = looked = end + 1
            inner = page[found.end():end]
            tag, ending = tag.lower(), found[1] == "/"
            if dropped:
                if not ending:
                    if tag in _RAW:
                        at = looked = self._skip_raw(page, at, tag)
                    elif tag == "body":
                        dropped.clear()
                        within.clear()
                    elif tag not in _VOID and not inner.endswith("/"):
                        dropped.append(tag)
                        within[tag] += 1
                    continue
                if within[tag]:
                    while (name := dropped.pop()) != tag:
                        within[name] -= 1
                    within[tag] -= 1
                    continue
                # the end of something around the dropped element ends it as well
                if not stack.last((tag,)) or tag in _INLINE or tag == "p":
                    continue
                dropped.clear()
                within.clear()
            if ending:
                if tag == "br":
                    text.append(" ")
                    continue
                place = stack.last((tag,))
                if place and tag in _INLINE:
                    if stack.block_places[-1] < place:
                        link[0] -= tag == "a"
                        stack.forget(place)
                elif place:
                    close(place)
                continue
            if tag in _VOID:
                if tag in ("br", "hr"):
                    text.append(" ")
                    if tag == "hr":
                        flush()
                continue
            if tag in _INLINE and not inner:
                stack.push(tag, stack.items[-1][1])
                continue
            attributes = _attributes(inner)
            if tag not in _INLINE:
                self._imply(stack, tag, close)
                flush()
            if tag in _RAW:
                at = looked = self._skip_raw(page, at, tag)
                continue
            doubt = _doubt(tag, attributes) if self.words else 0
            if _is_dropped(tag, attributes) or doubt and (tag in _INLINE or inner.endswith("/")):
                if not inner.endswith("/"):
                    dropped.append(tag)
                    within[tag] += 1
                    self.inline_dropped |= bool(doubt)
                continue
            if tag in _INLINE:
                stack.push(tag, stack.items[-1][1])
                link[0] += tag == "a"
                continue
            if tag == "body" and self.doubts:
                open_doubt = next((k for k in stack.block_places if stack.items[k][1] in self.doubts), 0)
                if open_doubt:
                    close(open_doubt)
            self.parents.append(stack.items[-1][1])
            self.tags.append(tag)
            if doubt:
                self.doubts[len(self.tags) - 1] = doubt
            stack.push(tag, len(self.parents) - 1)
        add(page[at:])
        flush()

    @staticmethod
    def _skip_raw(page: str, at: int, tag: str) -> int:
        end = re.compile(rf"</{tag}[^>]*(?:>|\Z)", re.I).search(page, at)
        return end.end() if end else len(page)

    @staticmethod
    def _imply(stack: _Stack, tag: str, close) -> None:
        """Ends the paragraph or item that an opening block tag ends without saying so."""
        nearest = stack.block_places[-1]
        if stack.items[nearest][0] == "p":
            close(nearest)
        if tag in _CLOSES:
            ends, barriers = _CLOSES[tag]
            barrier = stack.last(barriers)
            while (place := stack.last(ends)) > barrier:
                close(place)
                if tag != "tr":
                    break

    def leave_out(self) -> None:
        """Takes away the blocks of doubtful elements, but for those that hold the article.

        An element holds the article if it has most of the page's points and no article or main element outside
        has a quarter as many, or if it alone has an article, main or h1 and no fewer points than what is outside. One
        of _REMARKS must have most of the points, and either hold a main or h1 alone, or there is next to nothing outside.
        Outside is what is in no doubtful element but those found to hold the article, outer ones first.
        """
        if not self.doubts:
            return
        count = len(self.tags)
        near, inside = [-1] * count, [False] * count  # nearest doubtful element, whether in an article or main
        for at in range(1, count):
            parent = self.parents[at]
            near[at] = at if at in self.doubts else near[parent]
            inside[at] = at not in self.doubts and (inside[parent] or self.tags[at] in ("article", "main"))
        own, marks, size = [0.0] * count, [0] * count, [0] * count
        direct, marked, signs = ({d: 0 for d in (-1, *self.doubts)} for _ in range(3))
        for element, block, link in self.blocks:
            size[element] += len(block)
            if self.tags[element] not in _HEADINGS:
                points = _block_points(block, link)
                own[element] += points
                direct[near[element]] += points
                marked[near[element]] += points if inside[element] else 0.0
        for at in range(count - 1, 0, -1):
            if size[at] and not self.doubts.get(at, 0) == 2:
                mark = _MARKS.get(self.tags[at], 0)
                marks[at] |= mark
                signs[near[at]] |= mark
            parent = self.parents[at]
            own[parent] += own[at]
            size[parent] += size[at]
            marks[parent] |= marks[at]
        total, rest, rest_marked, rest_signs = own[0], direct[-1], marked[-1], signs[-1]
        out = set()
        for at, doubt in self.doubts.items():
            if near[self.parents[at]] in out:
                out.add(at)
                continue
            most = 2 * own[at] > total
            holds = marks[at] and not rest_signs & (3 if marks[at] & 3 else 7)
            if doubt == 2:
                keep = most and (rest < 3.0 and not rest_signs or bool(holds and marks[at] & 6))
            else:
                keep = most and own[at] > 4 * rest_marked or bool(holds) and own[at] > 0 and own[at] >= rest
            if keep:
                rest, rest_marked, rest_signs = rest + direct[at], rest_marked + marked[at], rest_signs | signs[at]
            else:
                out.add(at)
        self.blocks = [b for b in self.blocks if near[b[0]] not in out]

    def points(self) -> list[float]:
        """Score of every element: what its own blocks give, and half the score of each of its children.

        A paragraph's points go to its parent. Children come after their parents, so one pass from the end does.
        """
        size, linked, points = ([0.0] * len(self.tags) for _ in range(3))
        for element, block, link in self.blocks:
            size[element] += len(block)
            linked[element] += link
            points[self.parents[element] if self.tags[element] in _PARAGRAPHS else element] += _block_points(block, link)
        for at in range(len(self.tags) - 1, 0, -1):
            parent = self.parents[at]
            points[parent] += points[at] / 2
            size[parent] += size[at]
            linked[parent] += linked[at]
        for at, tag in enumerate(self.tags):
            if points[at]:
                points[at] = (points[at] + _LIKELY_BONUS.get(tag, 0.0)) * (1.0 - min(1.0, linked[at] / max(1.0, size[at])))
        self._density = [l / s if s else 0.0 for l, s in zip(linked, size)]
        self._size = size
        return points

    def main_text(self) -> str:
        if not self.blocks:
            return ""
        points = self.points()
        best = max(range(len(points)), key=lambda k: (points[k], -k))
        # A piece of an article stands for the article.
        at = best
        while at > 0:
            if self.tags[at] in ("article", "main"):
                best = at
                break
            at = self.parents[at]
        kept = {best}
        if best > 0:
            least = 0.2 * points[best]
            for k in range(1, len(points)):
                if k == best or self.parents[k] != self.parents[best] or not self._size[k]:
                    continue
                tag, density = self.tags[k], self._density[k]
                if tag in _HEADINGS:
                    keep = self.tags[best] not in ("article", "main") and density < 0.5
                elif tag in _PARAGRAPHS:
                    keep = density < 0.25 and (self._size[k] > 80 or density == 0)
                else:
                    keep = points[k] >= least and (self.tags[best] not in ("article", "main") or tag == self.tags[best])
                if keep:
                    kept.add(k)
        inside = [False] * len(self.tags)
        for at, parent in enumerate(self.parents):
            inside[at] = at in kept or parent >= 0 and inside[parent]
        return "\n".join(block for element, block, _ in self.blocks if inside[element])


def main_text(page: str | None) -> str:
    """The article of one page: its blocks in page order, one per line; empty for null and for pages without text.

    Character references are decoded and white space inside a block becomes one space. A page without any container
    gives its text as it is. A page whose text is all in inline elements with unlikely words gives that text.
    """
    if not page:
        return ""
    tree = _Tree()
    tree.parse(page)
    tree.leave_out()
    if not tree.blocks and tree.inline_dropped:
        tree = _Tree(words=False)
        tree.parse(page)
    return tree.main_text()


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row; no shuffle, and a page is held by itself.

    Null ids and addresses stay null, repeated rows give equal rows, other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(page) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    source = pages.selectExpr(f"`{id_col}` AS page_id", f"`{url_col}` AS url", f"`{html_col}` AS html")
    id_type = source.schema["page_id"].dataType.simpleString()
    return source.mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars long")
