"""Main text of web pages by two-pass block rules.

The first pass reads markup into blocks and decides them by where they stand (menus, footers, adverts and the like are
boilerplate), by link density, by length and by the density of stop words; article markup is one more vote.  Short
blocks, and long ones whose signs disagree, stay open.  The second pass gives open blocks the label of their nearest
decided neighbours.

Stop words are learned from the pages themselves: the most frequent words of long blocks with few links, as many as make
up ``COVERED`` of all words there.  On a page whose language they miss, density says nothing and length decides.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import settle

#: Blocks of at least so many characters are decided by their own text.
LONG = 70
#: Share of a block's characters inside links above which it is a menu.
LINKS = 0.5
#: Share of stop words above which long text is prose; on a page with less than half of it they tell nothing.
STOPS = 0.12
#: Share of all words that the learned stop words make up, and their greatest number.
COVERED, MOST_STOPS = 0.35, 1000
#: Different words that a worker counts before it passes them on.
WORDS_HELD = 200_000

# Element names, class words of boilerplate, and words that only say that something contains it.
RAW = frozenset("script style noscript template iframe object textarea title desc metadata annotation annotation-xml".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    """address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul""".split()
)
OUTSIDE = frozenset("nav footer aside form button select option label menu head dialog input".split())
HINTS = frozenset(
    """ad ads advert adverts advertisement banner breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright
    disqus footer gdpr hidden login masthead menu nav navbar navigation newsletter notice notices pagination pager popup promo
    promoted promotion related reply replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe
    subscription tags teaser toolbar topbar tracking widget""".split()
)
CONTAINERS = frozenset("area bar block body box button buttons container content form inner item items link links list panel section text wrap wrapper".split())
NEGATIONS = frozenset("has is no non not with without".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TAG = re.compile(r"""<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>(?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE = re.compile(r"<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>[^<>]*+)>")
_OTHER = re.compile(r"<[!?/][^>]*+>?")
_NAMED = re.compile(r"""(?:^|\s)(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=\s|/|$)""", re.I)
_PARTS = re.compile(r"[a-z]+")
_LETTERS = re.compile(r"[^\W\d_]+")


@dataclass(eq=False)
class Hint:
    """An element whose class or id names boilerplate; ``wrapper`` when an article, main part or first heading lies in it."""

    above: Hint | None
    wrapper: bool = False


@dataclass
class Block:
    text: str
    linked: int
    heading: bool
    listed: bool
    inside: bool
    outside: bool
    hint: Hint | None = None
    good: bool | None = None


@dataclass
class _Element:
    name: str
    outside: bool
    main: bool
    hint: Hint | None


def boilerplate(name: str) -> bool:
    """Does a class or id name boilerplate?  The whole name does, its last part, or its first before a word like "list"."""
    parts = _PARTS.findall(name.lower())
    if not parts or (len(parts) > 1 and parts[0] in NEGATIONS):
        return False
    return parts[-1] in HINTS or (parts[0] in HINTS and parts[-1] in CONTAINERS)


def _said(attrs: str) -> tuple[bool, bool, bool]:
    """(hidden, boilerplate by class or id, the page's main part) of an element's attributes."""
    hidden = hinted = main = False
    for name, value in _NAMED.findall(attrs):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            hidden = True
        elif name == "style":
            plain = value.replace(" ", "")
            hidden = hidden or "display:none" in plain or "visibility:hidden" in plain
        elif name == "role" and value == "main":
            main = True
        elif name != "aria-hidden":
            hinted = hinted or any(map(boilerplate, value.split()))
    return hidden, hinted, main


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order."""
    out: list[Block] = []
    parts: list[str] = []
    linked = 0
    stack: list[_Element] = []
    #: How many open elements there are of each name, and of each kind that a block asks for.
    names: Counter[str] = Counter()
    outside = main = headings = 0
    hint: Hint | None = None
    in_link, at, n = False, 0, len(page)

    def flush() -> None:
        nonlocal linked
        text = " ".join(_html.unescape("".join(parts)).split())
        if text:
            out.append(Block(text, linked, headings > 0, names["li"] > 0, main > 0, outside > 0, hint))
        parts.clear()
        linked = 0

    def close(k: int) -> None:
        nonlocal outside, main, headings, hint
        for x in stack[k:]:
            names[x.name] -= 1
            outside -= x.outside
            main -= x.main
            headings -= x.name in HEADINGS
        hint = stack[k].hint
        del stack[k:]

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            piece = page[at:lt]
            parts.append(piece)
            if in_link:
                linked += len(piece.strip())
        if lt == n:
            break
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        tag = _TAG.match(page, lt) or _LOOSE.match(page, lt)
        if tag is None:
            other = _OTHER.match(page, lt)
            if other is None:  # a bare less-than sign is text
                parts.append("<")
                at = lt + 1
            else:
                at = other.end()
            continue
        at = tag.end()
        name, attrs = tag["name"].lower(), tag["attrs"]
        if tag["end"]:
            if name in BLOCKS:
                flush()
            if name == "a":
                in_link = False
            for k in range(len(stack) - 1 if names[name] else -1, -1, -1):
                if stack[k].name == name:
                    close(k)
                    break
                if name not in BLOCKS and stack[k].name in BLOCKS:
                    break  # an inline end tag doesn't close blocks
            continue
        if name in RAW:
            if not attrs.endswith((" /", '"/', "'/")):
                end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else n
            continue
        if name in BLOCKS:
            flush()
            in_link = False
            if name in ("p", "li", "tr", "dt", "dd") or name in HEADINGS:
                # The same kind of element, or a paragraph, ends where this one starts.
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].name == name or stack[k].name == "p":
                        close(k)
                        break
                    if stack[k].name in BLOCKS:
                        break
        if name in ("br", "td", "th"):
            parts.append(" ")
        if name in VOID:
            continue
        if name == "a":
            in_link = True
            continue
        hidden, hinted, role = _said(attrs) if attrs else (False, False, False)
        hinted = hinted and name not in ("html", "body")
        is_main = (name in ("article", "main") or role) and not hinted
        if is_main or name == "h1":
            above = hint
            while above is not None and not above.wrapper:
                above.wrapper, above = True, above.above
        bad = hidden or name in OUTSIDE or (name == "header" and not main)
        if name in BLOCKS or bad or is_main or hinted:
            stack.append(_Element(name, bad, is_main, hint))
            names[name] += 1
            outside += bad
            main += is_main
            headings += name in HEADINGS
            if hinted:
                hint = Hint(hint)
    flush()
    return out


def _stop_share(text: str, stops: frozenset[str]) -> float:
    words = _LETTERS.findall(text.lower())
    return sum(map(stops.__contains__, words)) / len(words) if words else 0.0


def _hinted(hint: Hint | None, spare_wrappers: bool) -> bool:
    while hint is not None:
        if not (spare_wrappers and hint.wrapper):
            return True
        hint = hint.above
    return False


def decide(found: list[Block], stops: frozenset[str] = frozenset()) -> list[Block]:
    """The two passes; every block ends with a label.

    Hints are dropped for elements around the page's main part when nothing else on it is prose."""
    _label(found, stops, False)
    if not any(b.good for b in found) and any(b.hint is not None for b in found):
        _label(found, stops, True)
    return found


def _label(found: list[Block], stops: frozenset[str], spare_wrappers: bool) -> None:
    apart = [b.outside or _hinted(b.hint, spare_wrappers) for b in found]
    long = [len(b.text) >= LONG and b.linked <= LINKS * len(b.text) for b in found]
    density = [_stop_share(b.text, stops) if x and not out else 0.0 for b, x, out in zip(found, long, apart, strict=True)]
    told = max(density, default=0.0) >= STOPS / 2
    dense = [x and not out and (d >= STOPS or not told) for x, d, out in zip(long, density, apart, strict=True)]
    # Article markup counts when it holds most of the prose.
    within = sum(len(b.text) for b, x in zip(found, dense, strict=True) if x and b.inside)
    marked = any(b.inside and not out for b, out in zip(found, apart, strict=True)) and 2 * within >= sum(len(b.text) for b, x in zip(found, dense, strict=True) if x)
    for b, prose, is_long, out in zip(found, dense, long, apart, strict=True):
        inside = b.inside and marked
        b.good = None
        if out:
            b.good = False
        elif b.linked > LINKS * len(b.text) and (b.listed or not inside):
            b.good = False
        elif prose and (inside or not marked):
            b.good = True
        elif marked and not inside:
            b.good = None if prose else False
        elif is_long and not inside:
            b.good = False
    # Inside an article only its running text speaks for its short blocks, not adverts or link lists between them.
    voters = [k for k, b in enumerate(found) if b.good or (b.good is False and not (marked and b.inside) and not apart[k]) or (b.good is False and marked and not b.inside)]
    before: int | None = None
    at = 0
    for k, b in enumerate(found):
        while at < len(voters) and voters[at] < k:
            before, at = voters[at], at + 1
        if b.good is not None:
            continue
        after = voters[at] if at < len(voters) else None
        if marked and b.inside:
            # Neighbours outside the article say nothing about what is in it.
            near = [v for v in (before, after) if v is not None and found[v].inside]
        else:
            near = [v for v in (before, after) if v is not None]
        if not near:
            b.good = b.inside if marked else b.heading or not b.listed
        elif len(labels := {found[v].good for v in near}) == 1:
            b.good = labels.pop()
        else:
            left, right = k - before, after - k
            b.good = found[after].good if right < left or (right == left and b.heading) else found[before].good if left < right else b.inside


def main_text(page: str | None, stops: frozenset[str] = frozenset()) -> str:
    return "\n".join(b.text for b in decide(blocks(page), stops) if b.good) if page else ""


def learn_stop_words(pages: DataFrame, *, html_col: str = "html", covered: float = COVERED, most: int = MOST_STOPS) -> frozenset[str]:
    """The most frequent words of long blocks with few links on all pages, until they make up ``covered`` of the words there;
    ``most`` bounds what reaches the driver."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        counts: Counter[str] = Counter()

        def flush():
            rows = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return rows

        for batch in batches:
            for page in batch.column(0):
                for b in blocks(page.as_py() or ""):
                    if len(b.text) >= LONG and b.linked <= LINKS * len(b.text) and not b.outside and b.hint is None:
                        counts.update(_LETTERS.findall(b.text.lower()))
                if len(counts) > WORDS_HELD:
                    yield flush()
        yield flush()

    counts = pages.select(pages[html_col].cast("string").alias("html")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = settle(counts, "page_words")
    whole = counts.agg(F.sum("n")).first()[0] or 0
    out, held = [], 0
    for word, n in counts.orderBy(F.desc("n"), "word").limit(most).collect():
        if held >= covered * whole:
            break
        out.append(word)
        held += n
    return frozenset(out)


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", stops: frozenset[str] | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``; null and empty pages give empty text.

    Very long and deeply nested pages take time in proportion to their length.  ``stops``: stop words, learned from
    ``pages`` when not given.  Repeated rows each get a row."""
    stops = learn_stop_words(pages, html_col=html_col) if stops is None else stops

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [main_text(x.as_py(), stops) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string())], names=["page_id", "url", "text"])

    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), pages[html_col].cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))
