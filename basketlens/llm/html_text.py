"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped first: scripts, styles and comments go, block tags end a line, inline tags vanish, and
elements that are never article text (menus, forms, adverts and the like, by tag or by their class, id or
role) leave an empty line. A class that is such a name says more than one that only has such a word in it, and neither
takes the article away: an element stays if the page has no other text to speak of, or, with a
word only, if it holds two thirds of the page's text. Of every line its text length without link text is taken, and the
lengths of ``WIDTH`` lines at a time are summed. Text surges where a sum rises over ``SURGE``; it dives where
the sum falls to nothing. The lines between such points are the main text, with short stretches that lie between
the first surge and the last dive. Lines that only tags made are no lines. Where no block of a page is that dense,
the stretch with most text is taken. In a marked article (``article``, ``main``) links count as text and every
line weighs ``MARKED`` times as much, so that less of it makes a surge; sums decide there as elsewhere.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH, SURGE, MARKED = 3, 80, 2

#: Fixed by the markup language: elements whose content is never text of the page ...
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "canvas", "object", "title", "xmp", "noembed", "noframes"}
#: ... elements that surround an article ...
AROUND = {"head", "nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "fieldset"}
#: ... elements without content ...
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: ... and elements inside a line.
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q",
    "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
#: Words of a class, id or role that name what is not article text.
NAMES = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertisements", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie",
    "cookies", "disqus", "footer", "form", "gdpr", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "popup", "promo",
    "promotion", "related", "replies", "respond", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "subscription", "toolbar",
    "widget", "complementary", "contentinfo", "search", "dialog", "alert", "disclaimer", "login", "paywall", "recommended", "recommendations",
}
#: Those of them that also take away an element inside a line.
ADVERTS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertisements", "promo", "promotion", "sponsor", "sponsored", "share", "sharing"}
ARTICLE = {"article", "main"}
#: End tags that HTML lets one omit: what a start tag ends, and the elements beyond which it does not look for it.
CELLS, ROWS = {"td", "th"}, {"thead", "tbody", "tfoot"}
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}), "td": (CELLS, {"table", "tr"}), "th": (CELLS, {"table", "tr"}), "tr": (CELLS | {"tr"}, {"table"}),
    **{tag: (CELLS | ROWS | {"tr", "caption", "colgroup"}, {"table"}) for tag in ROWS}, "body": ({"head"}, {"html"}),
}
#: Start tags that end an open paragraph, and the elements that keep it open.
P_ENDS = {
    "address", "article", "aside", "blockquote", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2",
    "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "ul",
}
P_HELD = {"td", "th", "caption", "table", "button", "html"}
#: What may stand in a head; any other start tag ends it.
IN_HEAD = RAW | {"base", "link", "meta", "head"}
#: End tags do not reach beyond a table or a cell, but for those of its own parts; that of an item not beyond its list.
PARTS = CELLS | ROWS | {"tr", "table", "caption", "colgroup"}

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|</?([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.S)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
WORD = re.compile(r"[a-z]+")
#: Empty lines that separate an article from what stands beside it.
GAP = WIDTH + 1


class Lines:
    """Lines of a page, each with its text and its weight: the length of its text outside links, more in an article."""

    def __init__(self) -> None:
        self.texts: list[str] = []
        self.weights: list[int] = []
        self.parts: list[str] = []
        self.linked = 0

    def end(self, article: bool, gap: int = 0) -> None:
        text = " ".join(html.unescape("".join(self.parts)).split())
        if text:
            self.texts.append(text)
            self.weights.append(MARKED * len(text) if article else max(len(text) - self.linked, 0))
        self.parts, self.linked = [], 0
        for _ in range(gap):
            self.texts.append("")
            self.weights.append(0)


def is_around(tag: str, attributes: str, articles: int) -> bool:
    """Whether the tag alone, being hidden, or an advert's name inside a line says that an element is no article text."""
    if tag in AROUND:
        return not (tag == "header" and articles)
    if tag in INLINE:
        return any(ADVERTS.issuperset(WORD.findall(t)) for groups in NAMED.findall(attributes) for t in "".join(groups).lower().split() if WORD.search(t))
    return tag not in ("html", "body") and bool(attributes) and bool(HIDDEN.search(attributes))


def named_around(tag: str, attributes: str) -> int:
    """2 if a class, id or role of an element names what is no article text, 1 if one has such a word, else 0.

    Elements inside a line, and the page's main content by definition, are what they are whatever their names;
    an article is no article text only if that is its whole name.
    """
    if not attributes or tag in INLINE or tag in ("html", "body", "main"):
        return 0
    level = 0
    for groups in NAMED.findall(attributes):
        for token in "".join(groups).lower().split():
            words = WORD.findall(token)
            if words and NAMES.issuperset(words):
                return 2
            level = level or int(tag not in ARTICLE and not NAMES.isdisjoint(words))
    return level


def ended_by(tag: str, open_tags: list[str], counts: Counter[str]) -> int:
    """Of the open elements, how many stay open at this start tag. ``counts`` says how many are open of each tag."""
    keep = len(open_tags)
    if tag in P_ENDS and counts["p"]:
        for i in range(keep - 1, -1, -1):
            if open_tags[i] == "p":
                keep = i
                break
            if open_tags[i] in P_HELD:
                break
    if tag not in IN_HEAD and counts["head"]:
        keep = min(keep, open_tags.index("head"))
    ended, held = ENDS.get(tag, ((), ()))
    if not any(counts[t] for t in ended):
        return keep
    for i in range(keep - 1, -1, -1):
        if open_tags[i] in ended:
            keep = i
        elif open_tags[i] in held:
            break
    return keep


def closed_by(tag: str, open_tags: list[str], counts: Counter[str]) -> int:
    """Of the open elements, how many stay open at this end tag: all, if it is a stray one."""
    if not counts[tag]:
        return len(open_tags)
    for i in range(len(open_tags) - 1, -1, -1):
        if open_tags[i] == tag:
            return i
        if open_tags[i] in (("table",) if tag in PARTS else ("table", "td", "th", "caption")) or tag == "li" and open_tags[i] in ("ul", "ol", "menu"):
            if tag not in ("body", "html"):
                break
    return len(open_tags)


def page_lines(page: str, skipped: frozenset[int] = frozenset()) -> tuple[Lines, dict[int, tuple[int, int]], int]:
    """Lines of a page without the elements that start at the places in ``skipped``.

    Also returns, for the elements whose names tell that they may be no article text, their start with the level of
    the name and the length of their text outside links, and that length of the page. ``skip`` is the place of
    the skipped element among the open ones, if there is one.
    """
    lines, at, links, articles, seen = Lines(), 0, 0, 0, 0
    open_tags: list[str] = []
    counts: Counter[str] = Counter()
    marks: list[tuple[int, int, int] | None] = []  # of the open ones: start, level, text before
    named: dict[int, tuple[int, int]] = {}

    def opened(tag: str, mark: tuple[int, int, int] | None = None) -> None:
        open_tags.append(tag)
        counts[tag] += 1
        marks.append(mark)

    def ended(left: int) -> None:
        for start, level, before in filter(None, marks[left:]):
            named[start] = (level, seen - before)
        counts.subtract(open_tags[left:])
        del open_tags[left:], marks[left:]

    skip: int | None = None
    for token in TOKEN.finditer(page):
        if token.start() < at:
            continue
        if skip is None:
            piece = page[at : token.start()]
            lines.parts.append(piece)
            size = len(" ".join(piece.split()))
            lines.linked += size if links else 0
            seen += 0 if links else size
        at = token.end()
        tag = token[1]
        if tag is None:
            continue
        tag, closing, attributes = tag.lower(), page.startswith("</", token.start()), token[2]
        empty = tag in VOID or attributes.endswith("/") and tag not in INLINE
        if tag in RAW and not closing and not empty:
            end = re.compile(rf"</{re.escape(tag)}(?![a-z0-9-])[^>]*(?:>|$)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if closing and tag in INLINE and (skip is None or open_tags[skip] != tag):
            left = len(open_tags)  # inline elements are open ones only where they are skipped
        else:
            left = closed_by(tag, open_tags, counts) if closing else ended_by(tag, open_tags, counts)
        if left < len(open_tags):
            gone = 0  # articles that end; those inside a skipped element do not count
            if skip is None:
                gone = sum(t in ARTICLE for t in open_tags[left:])
                lines.end(bool(articles), GAP if gone else 0)
                links = 0
            elif left <= skip:
                gone = sum(t in ARTICLE for t in open_tags[left:skip])
                skip, links = None, 0
                if gone:
                    lines.end(bool(articles), GAP)
            articles -= gone
            ended(left)
        if skip is not None:
            if not closing and not empty and (tag not in INLINE or tag == open_tags[skip]):
                opened(tag)
        elif closing and tag not in INLINE:
            lines.end(bool(articles))
            links = 0
        elif tag == "a":
            links = 0 if closing else 1
        elif tag == "br":
            lines.parts.append(" ")
        elif closing:
            continue
        elif not empty and (token.start() in skipped or is_around(tag, attributes, articles)):
            lines.end(bool(articles), 1)
            skip = len(open_tags)
            opened(tag)
        elif tag not in INLINE:
            lines.end(bool(articles), GAP if tag in ARTICLE and not empty else tag == "hr")
            links = 0
            if not empty:
                articles += tag in ARTICLE
                level = named_around(tag, attributes)
                opened(tag, (token.start(), level, seen) if level else None)
    if skip is None and at < len(page):
        lines.parts.append(page[at:])
        seen += len(" ".join(page[at:].split()))
    lines.end(bool(articles))
    ended(0)
    return lines, named, seen


def article_lines(page: str) -> Lines:
    """Lines of a page without what its names tell to be no article text."""
    lines, named, total = page_lines(page)
    skipped = {start for start, (level, size) in named.items() if size < SURGE or 3 * size < 2 * total or level == 2 and total - size >= SURGE}
    return page_lines(page, frozenset(skipped))[0] if skipped else lines


def main_text(page: str) -> str:
    """The main text of one page, blocks joined by line ends."""
    lines = article_lines(page)
    weights = lines.weights
    sums, total = [], sum(weights[: WIDTH - 1])
    for i in range(len(weights)):  # text of the lines i to i + WIDTH - 1
        total += weights[i + WIDTH - 1] if i + WIDTH - 1 < len(weights) else 0
        sums.append(total)
        total -= weights[i]
    stretches, start = [], None
    for i, value in enumerate([*sums, 0]):
        if value and start is None:
            start = i  # the surge
        elif not value and start is not None:
            stretches.append((start, i, max(sums[start:i])))  # the dive
            start = None
    surged = [i for i, s in enumerate(stretches) if s[2] >= SURGE]
    chosen = stretches[surged[0] : surged[-1] + 1] if surged else []
    if not chosen and stretches:
        chosen = [max(stretches, key=lambda s: (sum(weights[s[0] : s[1]]), -s[0]))]
    return "\n".join(lines.texts[i] for low, high, _ in chosen for i in range(low, high) if lines.texts[i])


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html_column: str = "html") -> DataFrame:
    """Main text of every page from its whole html.

    Returns the key, the url, ``text`` (blocks joined by line ends, white space inside a block as single
    blanks; empty if there is none) and ``n_chars``. Null html is empty. Character references are decoded
    and broken markup is read as far as it goes. Null and repeated keys are rows like any other; extra
    columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py() or "") for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names)

    rows = pages.select(F.col(f"`{key}`").alias(key), F.col(f"`{url}`").alias(url), F.col(f"`{html_column}`").alias("_html"))
    names, kinds = [key, url, "text", "n_chars"], dict(rows.dtypes)
    return rows.mapInArrow(run, f"`{key}` {kinds[key]}, `{url}` {kinds[url]}, text string, n_chars bigint")
