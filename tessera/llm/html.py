"""HTML extraction with consensus host paths.

A first pass scores each page's containers by the text that they hold outside links and side matter. Every page votes, with these scores,
for its best containers' paths (tags with their classes, numbers generalised). Spark adds the votes up by host and path, and
the path with most votes is the host's. A second pass extracts the main text again from what lies at that path; a page
of another layout falls back on its own best container. The container that wins may be a part of the article only, so the text
climbs from it: all of an enclosing article or main is taken, and of the other containers around it all parts that are not mostly
links. Beside the containers of a body lies much that no class names, so only headings, paragraphs and parts with a name of
article matter are taken there.

The votes are small rows that are added up before they are shuffled, so a host with any number of pages is no hot group. The
winning paths, a row a host, are counted and then broadcast, all of them or those of large hosts: pages of a large host never meet
in a task.

A page is read in one pass by the tokenizer rules of the HTML standard, in time and memory in proportion to its length.

Defined results: a null or empty page has an empty text; a page without containers is read as its body; a null URL
belongs to the host ''; equal votes go to the path of the greatest digest; a tag that the page ends in is dropped; repeated
rows vote once each; unclosed and stray tags are tolerated; long pages are read whole; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
import html as entities
import re
from array import array
from collections import Counter
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, cut

#: Elements by role. Fixed values of the HTML standard, and class names in common use for side matter.
_CONTAINERS = frozenset("article body center content div main section table tbody td tr".split())
_BLOCKS = _CONTAINERS | frozenset("address blockquote br caption dd details dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr li ol p pre summary tfoot th thead ul".split())
_SIDE = frozenset("aside button canvas dialog footer form head iframe input label menu nav noscript object option select svg template textarea title audio video math map".split())
_RAW = frozenset("script style noscript textarea title template iframe xmp".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SIDE_WORDS = frozenset(
    "ad ads adsense advert adverts alert advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright discussion disqus footer gdpr header hidden login masthead menu modal nav navbar navigation "
    "newsletter notice notices notification notifications outbrain overlay pagination paywall pager popup promo promotion recommend recommended related respond replies sharing share sidebar signup skip social sponsor sponsored sponsors subscribe subscription taboola teasers toolbar topbar trending widget widgets".split()
)
#: A tag to its ">": blanks and slashes, or names with values in quotes, in none, or without any. A quote that is never closed is a
#: character like others. Possessive, so that each character is read once.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+|(?=>)))?+)*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+)|(?=>)))?+""")
_COMMENT_END = re.compile("--!?>")
_CLOSE = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in _RAW}
#: Elements that end an open one of the same kind, whose end tag may be left out.
_ENDED_BY = {"p": _BLOCKS - {"br", "caption"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr", "tbody"}, "th": {"td", "th", "tr", "tbody"}, "tr": {"tr", "tbody"}, "option": {"option"}}
_WORD = re.compile(r"[a-zA-Z]+")
_NUMBER = re.compile(r"[0-9]+")
_HAVING = frozenset("with has no without".split())
_STORY = frozenset("article post entry story content section chapter".split())
#: Words beside those of side matter in the name of an element that holds nothing else.
_NEUTRAL = _STORY | frozenset(
    "area bar block body bottom box buttons card column container form global group icons inline inner item items left link links list main message mobile more page panel primary reader region right root row secondary site slot "
    "space text top trail unit user wrap wrapper".split()
)
#: Of the words of side matter, those that name it within an article (a header there is the article's), on a paragraph, and on a part of a line.
_IN_ARTICLE = _SIDE_WORDS - frozenset("header login search copyright discussion skip overlay respond".split())
_ON_PROSE = frozenset("ad ads adsense advert adverts advertisement advertising comment comments consent cookie cookies gdpr hidden newsletter notice notices outbrain promo promotion sponsor sponsored sponsors subscribe subscription taboola".split())
_IN_LINE = frozenset("ad ads advert adverts advertisement hidden outbrain sponsor sponsored sponsors taboola".split())
_INLINE = frozenset("a abbr b cite code em font i kbd mark q s samp small span strong sub sup time u var".split())
#: Containers so named hold an article.
_TOLD = frozenset("article post entry story".split())
#: Names of the parts of an article, and elements that hold running text or headings.
_PARTS = _STORY | frozenset("author body byline dateline deck dek headline intro introduction lead lede part standfirst subtitle summary text title".split())
_CREDITS = frozenset("author byline dateline headline".split())
_PROSE = frozenset("blockquote figcaption h1 h2 h3 h4 h5 h6 p pre".split())
_NEVER = frozenset("html body article main h1 h2 h3 h4 h5 h6".split())
_SIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert".split())
_TELLING = ("content", "article", "post", "entry", "story")
#: Containers a page votes for.
VOTES = 3
#: Hosts whose winners are broadcast whole, and the parts of all pages of which a large host holds one at least.
MAX_BROADCAST, LARGE = 1 << 18, 1 << 12
#: The share of links from which a part beside the winner is no article matter.
LINKED = 0.25


def _names_side(words: list[str], tag: str, inside: bool) -> bool:
    """Whether a class or id names side matter. Within an article all of its words have to ("ad-slot", not "share-price");
    elsewhere its first word ("ad-rotator") or its last ("main-nav"), but neither a layout that only has some
    ("content-with-sidebar") nor the head of an article ("post-header")."""
    if not words:
        return False
    if inside or tag in _INLINE:
        side = _IN_LINE if tag in _INLINE else _ON_PROSE if tag in _PROSE else _IN_ARTICLE
        return any(w in side for w in words) and all(w in side or w in _NEUTRAL for w in words)
    if words[0] in _SIDE_WORDS:
        return True
    return words[-1] in _SIDE_WORDS and not _HAVING & set(words) and not (words[-1] == "header" and words[0] in _STORY)


def _words(name: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name))]


def _role(tag: str, attrs: str, inside: bool) -> tuple[bool, str, bool]:
    """Whether an element is side matter, its step in a path, and whether it holds an article."""
    side = tag in _SIDE or (tag == "header" and not inside)
    values: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attrs):
        name = m[1].lower()
        if name in ("class", "id", "role", "hidden", "style"):
            values.setdefault(name, entities.unescape(m[2] or m[3] or m[4] or ""))
    classes = values.get("class", "").split()
    step = f"{tag}.{_NUMBER.sub('#', '.'.join(sorted(classes)))}" if classes else f"{tag}#{_NUMBER.sub('#', values['id'])}" if values.get("id") else tag
    names = [_words(name) for name in (*classes, *values.get("id", "").split())]
    side = side or "hidden" in values or values.get("role", "").lower() in _SIDE_ROLES or bool(re.search(r"display\s*:\s*none", values.get("style", ""), re.I))
    if not side and tag not in _NEVER:
        side = any(_names_side(words, tag, inside) for words in names)
    return side, step, tag in ("article", "main") or tag in ("div", "section") and any(_TOLD & set(words) for words in names)


_few_roles = lru_cache(1 << 12)(_role)


class Page:
    """Blocks of a page, each with the containers that it lies in. Of a container its parent, its step and a digest of its path are
    kept, so memory is in proportion to the page however deep its elements nest."""

    def __init__(self, html: str | None):
        self.paths = array("q")  # of each container
        self.parents = array("q")
        self.at = array("q")  # its step, a place in steps
        self.steps: list[str] = []
        self.blocks: list[tuple[int, str, int, str]] = []  # container, text, characters in links, element
        self._places: dict[str, int] = {}
        self._read(html or "")

    def _container(self, above: int, step: str) -> int:
        place = self._places.get(step)
        if place is None:
            place = self._places[step] = len(self.steps)
            self.steps.append(step)
        if above < 0:
            digest = 0
        else:
            digest = xxhash.xxh3_64_intdigest(step.encode("utf-8", "surrogatepass"), self.paths[above] & 0xFFFFFFFFFFFFFFFF)
        self.paths.append(digest - (1 << 64) if digest >> 63 else digest)
        self.parents.append(above)
        self.at.append(place)
        return len(self.paths) - 1

    def _read(self, html: str) -> None:
        """One pass by the tokenizer rules of the HTML standard, which read each character once."""
        self._container(-1, "")
        # the open elements: tag, container, whether side matter, whether one with an article
        tags, inner, sides, told = [""], array("q", [0]), bytearray(1), bytearray(1)
        opened: Counter[str] = Counter()
        parts: list[str] = []
        linked = side_depth = told_depth = 0
        in_link = False
        kind = ""
        pos, end = 0, len(html)
        cdata = True  # whether a CDATA section may end
        find = html.find

        def flush() -> None:
            nonlocal linked
            if parts:
                text = " ".join(entities.unescape("".join(parts)).split())
                if text:
                    self.blocks.append((inner[-1], text, min(linked, len(text)), kind))
                parts.clear()
            linked = 0

        def pop() -> str:
            nonlocal side_depth, told_depth
            tag = tags.pop()
            inner.pop()
            side_depth -= sides.pop()
            told_depth -= told.pop()
            opened[tag] -= 1
            return tag

        while pos < end:
            at = find("<", pos)
            after = html[at + 1 : at + 3] if at >= 0 else ""
            text_end = end if at < 0 else at
            if at >= 0 and not (after[:1].isalpha() and after[:1].isascii() or after[:1] in ("/", "!", "?") and after[:1]):
                text_end = at + 1  # a "<" of the text
            if text_end > pos:
                if not side_depth:
                    parts.append(html[pos:text_end])
                    if in_link:
                        linked += len(html[pos:text_end].strip())
                pos = text_end
                continue
            if not (after[0] not in "/!?" or after[0] == "/" and after[1:].isalpha() and after[1:].isascii()):
                if after == "!-" and html.startswith("<!--", at):
                    m = _COMMENT_END.search(html, at + 2)
                    pos = m.end() if m else end
                    continue
                if cdata and html.startswith("<![CDATA[", at):
                    close = find("]]>", at + 9)
                    if close >= 0:
                        if not side_depth:
                            parts.append(html[at + 9 : close].replace("&", "&amp;"))
                        pos = close + 3
                        continue
                    cdata = False
                close = find(">", at + 1)
                pos = close + 1 if close >= 0 else end
                continue
            m = _TAG.match(html, at)
            if m is None:
                break  # a tag that the page ends in
            pos = m.end()
            tag, attrs = m[2].lower(), m[3]
            if m[1]:
                if tag == "a":
                    in_link = False
                if tag in _BLOCKS and not side_depth:
                    flush()
                    kind = ""
                if opened[tag] > 0:
                    if not side_depth:
                        flush()
                    while pop() != tag:
                        pass
                continue
            if tag in _RAW:
                close = _CLOSE[tag].search(html, pos)
                pos = find(">", close.end()) + 1 if close else end
                if not pos:
                    pos = end
                continue
            while tag in _ENDED_BY.get(tags[-1], ()):
                if not side_depth:
                    flush()
                pop()
            alone = tag in _VOID or attrs.endswith("/")
            if tag == "a":
                in_link = not alone
            inside = told_depth > 0
            if attrs and not attrs.isspace():
                side, step, holds = _few_roles(tag, attrs, inside) if len(attrs) < 400 else _role(tag, attrs, inside)
            else:
                side, step, holds = tag in _SIDE or tag == "header" and not inside, tag, tag in ("article", "main")
            if (tag in _BLOCKS or side) and not side_depth:
                flush()
                if tag not in _VOID:
                    kind = "" if side else tag
            if alone:
                continue
            if side or tag in _CONTAINERS or side_depth and tag in _SIDE:
                new = tag in _CONTAINERS and not side and not side_depth
                tags.append(tag)
                inner.append(self._container(inner[-1], step) if new else inner[-1])
                sides.append(side)
                told.append(holds)
                side_depth += side
                told_depth += holds
                opened[tag] += 1
        if not side_depth:
            flush()

    def scores(self) -> array:
        """For each container the text in it outside links, less what lies in links, less a share for what lies deeper in one part:
        a container that only wraps another does not score higher than it."""
        n = len(self.paths)
        own, total = array("d", bytes(8 * n)), array("d", bytes(8 * n))
        for c, text, linked, _ in self.blocks:
            own[c] += len(text) - 2 * linked
        for c in range(n - 1, -1, -1):
            total[c] += own[c]
            if self.parents[c] >= 0:
                total[self.parents[c]] += total[c]
        bonus = [1.25 if _tag(step) in ("article", "main") or any(w in step for w in _TELLING) else 1.0 for step in self.steps]
        for c in range(n):
            # what lies in a container directly counts whole, what lies deeper by nine tenths
            total[c] = bonus[self.at[c]] * (own[c] + 0.9 * (total[c] - own[c]))
        return total

    def ranked(self) -> list[tuple[int, float]]:
        """The paths of the best containers, those at equal paths together."""
        by: dict[int, float] = {}
        for c, s in enumerate(self.scores()):
            if c and s > 0:
                by[self.paths[c]] = by.get(self.paths[c], 0.0) + s
        return heapq.nsmallest(VOTES, by.items(), key=lambda x: (-x[1], x[0]))

    def text(self, path: int | None) -> str:
        """The blocks at a path and the article matter around it, joined; of the page's own best path if it has none there."""
        if path is None or path not in self.paths:
            best = self.ranked()
            path = best[0][0] if best else 0
        n, parents, at = len(self.paths), self.parents, self.at
        whole = [_tag(step) in ("article", "main") for step in self.steps]
        names = [set(w.lower() for w in _WORD.findall(step.partition(".")[2] or step.partition("#")[2])) for step in self.steps]
        credits, partly = [bool(_CREDITS & x) for x in names], [bool(_PARTS & x) for x in names]
        around = bytearray(n)  # containers that hold a chosen one
        chars, links, prose = (array("q", bytes(8 * n)) for _ in range(3))
        for c, text, linked, kind in self.blocks:
            chars[c] += len(text)
            links[c] += linked
            prose[c] += len(text) if kind in _PROSE else 0
        own_chars, own_links = array("q", chars), array("q", links)
        for c in range(n - 1, 0, -1):
            around[parents[c]] |= around[c] or self.paths[c] == path
            chars[parents[c]] += chars[c]
            links[parents[c]] += links[c]
            prose[parents[c]] += prose[c]
        # IN: taken whole; ROUND: holds a chosen container; REST: beside one and mostly links, where only headlines count
        IN, ROUND, REST = 0, 1, 2
        state = bytearray([REST]) * n
        for c in range(n):
            above, step = parents[c], at[c]
            if self.paths[c] == path or (above >= 0 and state[above] == IN) or (around[c] and whole[step]):
                state[c] = IN
            elif around[c]:
                state[c] = ROUND
            elif state[above] == ROUND and (credits[step] or links[c] <= LINKED * chars[c] and (partly[step] or not self._is_root(above) or 2 * prose[c] > chars[c])):
                state[c] = IN
        out = []
        for c, text, linked, kind in self.blocks:
            few = own_links[c] <= LINKED * own_chars[c] or 2 * linked <= len(text)
            if state[c] == IN or (state[c] == ROUND and few and (kind in _PROSE or not self._is_root(c))) or (state[c] == REST and kind == "h1" and not linked):
                out.append(text)
        return "\n".join(out)

    def _is_root(self, c: int) -> bool:
        return c == 0 or self.parents[c] == 0 and _tag(self.steps[self.at[c]]) == "body"


def _tag(step: str) -> str:
    return re.split("[.#]", step, maxsplit=1)[0]


_VOTES = "host string, path long, score double, n long"


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path, n): the path (its digest) with most votes of each host, and the host's pages that voted, from pages (host, html)."""

    def vote(b: pa.RecordBatch) -> pa.RecordBatch | None:
        rows: dict[tuple[str, int], list] = {}
        for host, html in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
            ranked = Page(html).ranked()
            whole = sum(s for _, s in ranked) or 1.0
            for k, (path, s) in enumerate(ranked):
                row = rows.setdefault((host, path), [0.0, 0])
                row[0] += s / whole
                row[1] += k == 0
        if not rows:
            return None
        return pa.RecordBatch.from_arrays([pa.array([h for h, _ in rows], pa.string()), pa.array([p for _, p in rows], pa.int64()), pa.array([v[0] for v in rows.values()], pa.float64()), pa.array([v[1] for v in rows.values()], pa.int64())], ["host", "path", "score", "n"])

    votes = arrow_map(pages.select("host", "html"), vote, _VOTES).groupBy("host", "path").agg(F.round(F.sum("score"), 6).alias("score"), F.sum("n").alias("n"))
    return votes.groupBy("host").agg(F.max(F.struct("score", "path")).alias("best"), F.sum("n").alias("n")).select("host", F.col("best.path").alias("path"), "n")


def with_paths(hosted: DataFrame, winners: DataFrame) -> DataFrame:
    """Pages with their host's path. Up to MAX_BROADCAST hosts the winners are broadcast, some 100 MB at the most, and no page moves.
    Beyond that only the winners of large hosts are, those with a share of 1 / LARGE of the pages or more, so LARGE at the most;
    pages of the others are shuffled by host, and none of these groups is large."""
    one = winners.agg(F.count("*").alias("hosts"), F.sum("n").alias("pages")).first()
    if one["hosts"] <= MAX_BROADCAST:
        return hosted.join(F.broadcast(winners.drop("n")), "host", "left")
    large = F.broadcast(winners.where(F.col("n") * LARGE >= one["pages"]).drop("n"))
    small = winners.where(F.col("n") * LARGE < one["pages"]).drop("n")
    return hosted.join(large, "host").unionByName(hosted.join(large, "host", "left_anti").join(small, "host", "left"))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of pages (page_id, url, html)."""
    host = F.lower(F.coalesce(F.regexp_extract("url", "://([^/?#]*)", 1), F.lit("")))
    # no name of a host has over 253 characters: what is longer is told apart by its digest, so a row of a host is small
    host = F.when(F.length(host) <= 253, host).otherwise(F.sha2(host, 256))
    hosted = pages.select("page_id", "url", "html", host.alias("host"))

    def read(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = [Page(h).text(p) for h, p in zip(b.column("html").to_pylist(), b.column("path").to_pylist(), strict=True)]
        return pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    joined = with_paths(hosted, cut(host_paths(hosted), "host_paths")).select("page_id", "url", "html", "path")
    return arrow_map(joined, read, f"page_id {kind}, url string, text string, n_chars long")
