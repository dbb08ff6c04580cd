"""Main text of web pages: site templates are found by counting element subtrees over a host's pages, and removed.

A page is read into elements (end tags may be missing, as HTML allows). Every element's subtree, its tags and text without
attributes, has a hash. A subtree met on many pages of a host belongs to the host's template and is deleted wherever it
stands. Copies of an article do not make it a template: pages whose longest block is the same count as one.

Two more rules take what counting cannot know. If a page marks its article (``article``, ``main``), the text is
taken from there, and single paragraphs in it stay however often they occur. Menus, footers, forms, adverts, comments
and the like that bear these names as a tag, role, class or id go, also on hosts of few pages.

Pages are read twice, once for the counts and once for the text; only hashes are shuffled. What counts as recurring is a
share of the host's pages, so a host has at most ``1 / SHARE`` times as many recurring subtrees as a page has on average.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snowloom.session import materialize

# A template's subtree is on this share of a host's pages and on so many at least.
SHARE = 0.01
LEAST = 3
# Hashes of recurring subtrees that may be broadcast, 8 bytes each; beyond it they are joined by host.
BROADCAST_HASHES = 4_000_000
# The part of an element's text in links that makes it a menu.
LINKED = 0.8

# The elements of HTML by how they are read.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol optgroup option p pre search section select summary svg "
    "table tbody td template tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = BLOCKS - frozenset("body caption head html legend optgroup option select svg tbody td template tfoot th thead tr".split()) | {"hr"}
# What a start tag closes, and the elements beyond which it does not look.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
}
TABLE_PARTS = frozenset("table tbody thead tfoot tr td th caption".split())
# Tags, roles and parts of class names and ids of what is not an article.
NEVER = frozenset("aside button dialog dir footer head menu nav search select svg template".split())
SELDOM = frozenset("address details fieldset form header".split())
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split())
COMMENTS = frozenset("comment comments commentlist disqus reply replies respond responses related recommended".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs consent cookie cookies footer gdpr header "
    "login masthead menu modal nav navbar navigation newsletter notice notification pager pagination popup promo promotion "
    "register search share sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser toolbar widget".split()
)
# Elements that may be a template's inside an article; paragraphs and headings there never are.
CONTAINERS = frozenset("div dl figure form ol section table ul center fieldset details header address".split())
MENUS = frozenset("ul ol dl div section table center".split())

_TAG = re.compile(
    r"<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+))?+|=|[\"'])*+)>"
)
_ATTRIBUTE = re.compile(r"([^\s/>=\"']++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"'][^\s>]*+)))?+")
_TELLING = re.compile(r"class|id|role|hidden|style|itemprop", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")
_COMMENT_END = re.compile(r"--!?>")
_KEPT, _SOFT, _HARD, _ARTICLE = range(4)


def _mark(tag: str, attributes: str) -> int:
    """What an element says about itself: an article, certainly none, probably none, or nothing."""
    found = _HARD if tag in NEVER else _SOFT if tag in SELDOM else _ARTICLE if tag in ("article", "main") else _KEPT
    if not attributes or not _TELLING.search(attributes):
        return found
    values = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(attributes)}
    if "hidden" in values or re.search(r"display\s*:\s*none", values.get("style", "")):
        return _HARD
    names = {p for k in ("class", "id") for p in _PARTS.split(values.get(k, ""))}
    if names & COMMENTS:
        return _HARD
    if found == _HARD:
        return found
    role = values.get("role", "")
    if found == _ARTICLE or role in ("main", "article") or values.get("itemprop") == "articlebody":
        return _ARTICLE
    if role in ROLES or (tag not in ("html", "body") and names & NAMES):
        return _SOFT
    return found


class Page:
    """The elements of one page in document order, and its text as pieces, each of one element.

    Elements inside a line of text are not told apart, but for those that are marked as something to leave out.
    A piece whose text is null ends a block.
    """

    def __init__(self, source: str):
        self.tags, self.parents, self.marks = ["html"], [-1], [_KEPT]
        self.hashes: list[int] = [0]
        self.sizes, self.linked = [0], [0]
        self.pieces: list[tuple[int, str | None]] = []
        self._open, self._hashers, self._names = [0], [xxhash.xxh64(b"html")], {"html": 1}
        self._link, self._inner = False, []
        self._read(source)
        while len(self._open) > 1:
            self._pop()
        self.hashes[0] = self._hashers[0].intdigest()

    def _push(self, tag: str, mark: int) -> None:
        self.parents.append(self._open[-1])
        self._open.append(len(self.tags))
        self.tags.append(tag)
        self.marks.append(mark)
        self.hashes.append(0)
        self.sizes.append(0)
        self.linked.append(0)
        self._hashers.append(xxhash.xxh64(tag.encode()))
        self._names[tag] = self._names.get(tag, 0) + 1
        self._inner.append(0)

    def _pop(self) -> None:
        node, hasher = self._open.pop(), self._hashers.pop()
        self.hashes[node] = digest = hasher.intdigest()
        tag, above = self.tags[node], self._open[-1]
        self._names[tag] -= 1
        self._inner.pop()
        self._hashers[-1].update(b"\0" + digest.to_bytes(8, "little"))
        self.sizes[above] += self.sizes[node]
        self.linked[above] += self.linked[node]
        if tag in BLOCKS:
            self._break()

    def _break(self) -> None:
        if self.pieces and self.pieces[-1][1] is not None:
            self.pieces.append((self._open[-1], None))

    def _text(self, text: str) -> None:
        if not text:
            return
        if "&" in text:
            text = entities.unescape(text)
        node = self._open[-1]
        self.pieces.append((node, text))
        if words := text.split():
            plain = " ".join(words)
            self._hashers[-1].update(b"\1" + plain.encode("utf-8", "replace"))
            self.sizes[node] += len(plain)
            if self._link:
                self.linked[node] += len(plain)

    def _close(self, tags: frozenset | set, barriers: frozenset | set) -> bool:
        """Close the nearest open element of ``tags`` that no barrier hides."""
        if not any(self._names.get(t) for t in tags):
            return False
        for k in range(len(self._open) - 1, 0, -1):
            tag = self.tags[self._open[k]]
            if tag in tags:
                while len(self._open) > k:
                    self._pop()
                return True
            if tag in barriers:
                return False
        return False

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.pieces.append((self._open[-1], "\n"))
            return
        if tag in CLOSES_P and self._names.get("p"):
            self._close({"p"}, {"table", "td", "th", "caption", "template", "button", "svg"})
        if tag == "hr":
            self._break()
        if tag in VOID or tag == "html":
            return
        if tag == "a":
            self._link = "href" in attributes
        mark = _mark(tag, attributes)
        if tag not in BLOCKS:
            if mark in (_SOFT, _HARD):
                self._push(tag, mark)
            elif self.tags[self._open[-1]] == tag:
                self._inner[-1] += 1
            return
        if tag == "body" and self._names.get("body"):
            return
        if tag in CLOSES:
            targets, barriers = CLOSES[tag]
            while self._close(targets, barriers):
                pass
        elif tag in HEADINGS and self.tags[self._open[-1]] in HEADINGS:
            self._pop()
        if self._names.get("head") and tag in ("body", "div", "p", "article", "main", "section", "nav", "header"):
            self._close({"head"}, set())
        self._break()
        self._push(tag, mark)

    def _end(self, tag: str) -> None:
        if tag == "a":
            self._link = False
        if tag in ("html", "body") or tag in VOID:
            if tag == "br":
                self.pieces.append((self._open[-1], "\n"))
            return
        if tag not in BLOCKS:
            if self.tags[self._open[-1]] == tag:
                if self._inner[-1]:
                    self._inner[-1] -= 1
                else:
                    self._pop()
            return
        if tag in HEADINGS:
            self._close(HEADINGS, TABLE_PARTS)
        elif tag in TABLE_PARTS:
            self._close({tag}, {"table"} - {tag})
        elif tag == "li":
            self._close({"li"}, {"ul", "ol", "menu", "dir", *TABLE_PARTS})
        else:
            self._close({tag}, {"table", "td", "th", "caption", "template"} - {tag})
        self._break()

    def _read(self, source: str) -> None:
        at, n = 0, len(source)
        while at < n:
            begin = source.find("<", at)
            if begin < 0:
                self._text(source[at:])
                return
            if begin > at:
                self._text(source[at:begin])
            follows = source[begin + 1 : begin + 3]
            if follows[:1].isalpha() and follows[:1].isascii() or (follows[:1] == "/" and follows[1:].isalpha() and follows[1:].isascii()):
                met = _TAG.match(source, begin)
                if not met:
                    # The page ends inside this tag.
                    return
                at, tag = met.end(), met[2].lower()
                if met[1]:
                    self._end(tag)
                elif tag in RAW:
                    done = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(source, at)
                    if not done:
                        return
                    at = done.start()
                    close = _TAG.match(source, at)
                    if not close:
                        return
                    at = close.end()
                else:
                    self._start(tag, met[3])
            elif source.startswith("<!--", begin):
                if source.startswith(("<!-->", "<!--->"), begin):
                    at = source.index(">", begin) + 1
                    continue
                done = _COMMENT_END.search(source, begin + 4)
                if not done:
                    return
                at = done.end()
            elif follows[:1] in ("!", "?", "/") and len(follows) > 1:
                done = source.find(">", begin)
                if done < 0:
                    return
                at = done + 1
            else:
                self._text("<")
                at = begin + 1

    def _down(self, own: list[bool]) -> list[bool]:
        """Whether an element or any around it is set. Parents stand before their children."""
        out = list(own)
        for i, parent in enumerate(self.parents):
            if parent >= 0 and out[parent]:
                out[i] = True
        return out

    def articles(self) -> list[bool]:
        """Per element whether it lies in what the page marks as its article; none at all if there is no text in it."""
        gone = self._down([m == _HARD for m in self.marks])
        inside = self._down([m == _ARTICLE and not g for m, g in zip(self.marks, gone)])
        return inside if any(x and not g and self.sizes[i] for i, (x, g) in enumerate(zip(inside, gone))) else [False] * len(inside)

    def _around(self, inside: list[bool]) -> list[bool]:
        """Whether an element holds one of those set and is not one itself."""
        out = [False] * len(inside)
        for i in range(len(inside) - 1, 0, -1):
            out[self.parents[i]] |= inside[i] or out[i]
        return [x and not y for x, y in zip(out, inside)]

    def subtrees(self) -> tuple[int, set[int]]:
        """A hash of the page's longest block, and the hashes of all subtrees that could be a template's."""
        inside = self.articles()
        marked, around = any(inside), self._around(inside)
        found = {
            h
            for i, (h, x) in enumerate(zip(self.hashes, inside))
            if i and self.sizes[i] and not around[i] and self.marks[i] != _ARTICLE and self.tags[i] != "body" and (not x or self.tags[i] in CONTAINERS)
        }
        blocks = self.blocks([marked and not x for x in inside])
        return xxhash.xxh64_intdigest(max(blocks, key=len, default="").encode("utf-8", "replace")), found

    def blocks(self, gone: list[bool]) -> list[str]:
        """The blocks that have text outside the elements that are gone."""
        out, held = [], []
        for node, text in [*self.pieces, (0, None)]:
            if text is not None:
                if not gone[node]:
                    held.append(text)
            elif held:
                if block := " ".join("".join(held).split()):
                    out.append(block)
                held = []
        return out

    def text(self, recurring: set[int]) -> tuple[str, int]:
        """The main text, and the number of template subtrees deleted."""
        inside = self.articles()
        marked, around = any(inside), self._around(inside)
        outermost = [i for i, x in enumerate(inside) if x and not inside[self.parents[i]]] if marked else [0]
        whole = sum(self.sizes[i] for i in outermost)
        own, deleted = [], 0
        for i, tag in enumerate(self.tags):
            template = i > 0 and tag != "body" and self.sizes[i] > 0 and self.hashes[i] in recurring and not around[i]
            if template and inside[i]:
                template = tag in CONTAINERS and self.marks[i] != _ARTICLE and 2 * self.sizes[i] < whole
            deleted += template
            rest = self.marks[i] == _HARD
            if self.marks[i] == _SOFT and not around[i]:
                # The head of an article is a part of it; what holds most of a page is not beside the point.
                rest = not (tag == "header" and inside[i]) and (marked or 2 * self.sizes[i] < whole)
            if not marked and tag in MENUS and self.sizes[i] and self.linked[i] >= LINKED * self.sizes[i]:
                rest = True
            own.append(template or rest)
        gone = self._down(own)
        return "\n\n".join(self.blocks([g or (marked and not x) for g, x in zip(gone, inside)])), deleted


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(host, subtree, copy)`` of every page that has a host; subtree 0 stands for the page."""
    for batch in batches:
        hosts, subtrees, copies = [], [], []
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            copy, found = Page(source or "").subtrees()
            found.add(0)
            hosts += [host] * len(found)
            subtrees += found
            copies += [copy] * len(found)
        yield pa.record_batch(
            [pa.array(hosts, pa.string()), pa.array(np.array(subtrees, np.uint64).view(np.int64)), pa.array(np.array(copies, np.uint64).view(np.int64))],
            ["host", "subtree", "copy"],
        )


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, set[int]] = {}
    for batch in batches:
        lists = batch.column("recurring")
        offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
        hosts, texts, deleted = batch.column("host").to_pylist(), [], []
        if len(known) > 1000:
            known = {}
        for i, source in enumerate(batch.column("html").to_pylist()):
            host = hosts[i]
            if host is not None and host not in known:
                known[host] = set(flat[offsets[i] : offsets[i + 1]].tolist())
            text, n = Page(source or "").text(known.get(host) or set())
            texts.append(text.encode("utf-8", "replace"))
            deleted.append(n)
        yield pa.record_batch(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(deleted, pa.int64())],
            ["page_id", "url", "text", "n_deleted"],
        )


def host(url: Column) -> Column:
    """The host of an address in lower case, without user and port; null if it has none."""
    found = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(found != "", found)


def templates(pages: DataFrame) -> DataFrame:
    """``(host, recurring)``: the hashes of the subtrees that recur on the pages of each host, written to the shared folder.

    Pages are counted by their longest blocks. The count of a host and subtree is summed in every task, then by
    host, subtree and longest block, so a host with very many pages meets in no single task.
    """
    seen = pages.where("host is not null").select("host", "html").mapInArrow(_counted, "host string, subtree long, copy long")
    counts = seen.groupBy("host", "subtree").agg(F.countDistinct("copy").alias("n")).where(F.col("n") >= LEAST)
    counts = materialize(counts, "html-subtrees")
    totals = counts.where("subtree = 0").select("host", F.col("n").alias("pages"))
    often = counts.where("subtree <> 0").join(totals, "host").where(F.col("n") >= F.col("pages") * SHARE)
    return materialize(often.groupBy("host").agg(F.collect_list("subtree").alias("recurring")), "html-templates")


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_deleted)`` for every row of ``pages`` (needs ``page_id``, ``url``, ``html``).

    ``text`` has the blocks of the main text in page order, joined by two line feeds; white space inside a block is one
    blank, character references are decoded. ``n_deleted`` counts the template subtrees deleted. A null or empty page has an
    empty text; a page that ends inside a tag loses that tag; a page without a host (null or relative address) has
    no template; rows with the same page count as one page for a template and give a row each; other columns are left
    out, whatever their names; an empty table gives no rows. A page is held by one task.
    """
    ids = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = rows.withColumn("host", host(F.col("url")))
    found = templates(rows)
    hashes = found.agg(F.sum(F.size("recurring"))).first()[0] or 0
    side = F.broadcast(found) if hashes <= BROADCAST_HASHES else found
    joined = rows.join(side, "host", "left").select("page_id", "url", "html", "host", F.coalesce("recurring", F.array().cast("array<long>")).alias("recurring"))
    return joined.mapInArrow(_extracted, f"page_id {ids}, url string, text string, n_deleted long")
