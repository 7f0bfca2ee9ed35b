"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one for each block of text.  A line has the
length of its text.  It counts nothing in menus, headers, footers, sidebars,
notices, adverts, forms and reader comments, or outside the article on a page
that marks one; outside marked articles it counts nothing either where more than
half of it is links, unless it is a heading.  Lengths are summed over a window
that slides over the lines.  A stretch of text starts at the line where the sum
surges from nothing, ends at the last line before it dives back to nothing, and
is kept, with all that lies between, if the sum passes a threshold on the way; a
line or two at its ends that are mostly links, but not all, belong to it; a
window's height of them is a menu.  Lines that hold the regions above never stay.

On a page without a marked article the threshold is a share of the largest sum,
so stray short lines that stand by themselves go, while a short title goes with
the text that follows it.  On a page that marks one, the mark says what the text
is: any length above nothing counts, and the windows only bound it.

An element is such a region by its tag or role, by being hidden, or by a class
or id that names nothing else: each part of the name must be a word for a region
or one that says nothing by itself (ad, cookie-notice, site-footer, topNav,
mainmenu; but not search-results, related-work or notice-board).  An article
within comments or a sidebar is one of these; one within an open menu, header or
notice ends that, as it can't have been meant to hold it.  A form counts as a
form only while there is more text outside forms.

Character references are decoded, white space within a block becomes one space,
blocks are trimmed and joined by newlines in the page's order.  Unclosed and
crossed tags and pages cut off anywhere are fine: an unclosed control ends at
the next block, only an unclosed script, style or comment runs to the end.  A
page of any length is read whole, in time that follows its length.  Null html
counts as empty and gives an empty text; repeated rows give repeated rows;
columns besides those named are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import decoded, fresh, slices, text_bytes

#: Lines that a window sums.
WINDOW = 3
#: Of the largest window's sum, what makes a surge on a page that marks no article.
SHARE = 1 / 16

TOKEN = re.compile(
    r"<!--|<(?P<end>/?)(?P<name>[a-z][^\s>/]*+)(?P<attributes>(?:\"[^\"]*+\"|'[^']*+'|[^>\"'])*+)(?:>|\Z)"
    r"|<(?P<plain_end>/?)(?P<plain>[a-z][^\s>/]*+)(?P<rest>[^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)|(?P<text>[^<]++|<)",
    re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?", re.I)
HIDDEN = re.compile(r"display\s*:\s*none", re.I)
#: Elements without text of their own; an unclosed one of the first two runs to the page's end.
TO_END = frozenset(("script", "style"))
SKIPPED = TO_END | frozenset("noscript template svg math iframe object title select textarea".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form dialog menu button head".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
#: Words that name a region which is no article, and words that say nothing by themselves.
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising aside breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer"
    " gdpr login menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promotion related replies reply"
    " recent search share sharing sidebar signup skyscraper social sponsor sponsored subscribe toolbar trending".split()
)
#: Words and tags of regions that may hold articles of their own, such as comments and teasers.
HOLDERS = frozenset("aside comment comments disqus footer promo promotion recent related replies reply sidebar sponsor sponsored trending".split())
FILLER = frozenset(
    "area bar banner block body bottom box button buttons col column container content form global google header holder inner item items left"
    " links list main outer page panel popup posts primary right row secondary section side site slot stories sticky sub the thread top unit"
    " widget widgets wp wrap wrapper x".split()
)
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp small span strike strong sub"
    " sup time tt u var wbr".split()
)
VOID = frozenset("area base col embed hr img input link meta param source track wbr br".split())
ARTICLE = frozenset(("article", "main"))


def words_of(name: str) -> list[str]:
    """The words of a class name: parts, and known words that are written as one."""
    out = []
    for part in NAME_PARTS.findall(name):
        part = part.lower()
        cut = next((k for k in range(2, len(part) - 1) if part not in FILLER and {part[:k], part[k:]} <= BOILERPLATE_WORDS | FILLER), 0)
        out += [part] if part in BOILERPLATE_WORDS or not cut else [part[:cut], part[cut:]]
    return out


def region_of(value: str, inside: bool) -> str:
    """The word by which a class or id names a region that is no article, or nothing; a header is one outside articles."""
    for name in value.split():
        words = words_of(name)
        named = [w for w in words if w in BOILERPLATE_WORDS or w in ("header", "banner") and not inside]
        if named and all(w in BOILERPLATE_WORDS or w in FILLER for w in words):
            return next((w for w in named if w in HOLDERS), named[0])
    return ""


def boilerplate(name: str, attributes: str, inside: bool) -> str:
    """What makes an element no part of an article's text, or nothing; inside: an article is open, whose own header counts as text."""
    if name in BOILERPLATE_TAGS or name == "header" and not inside:
        return name
    for m in ATTRIBUTE.finditer(attributes) if attributes and not attributes.isspace() else ():
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        low = value.lower()
        if key == "hidden" or key == "aria-hidden" and low == "true" or key == "style" and HIDDEN.search(value):
            return "hidden"
        if key == "role" and low in BOILERPLATE_ROLES:
            return "aside" if low == "complementary" else low
        if key in ("class", "id") and (word := region_of(value, inside)):
            return word
    return ""


def lines_of(page: str, forms: bool = True) -> tuple[list[tuple[str, int, bool, bool]], bool, int]:
    """((text, characters within links, inside an article, heading) of each line, '' where only a region that is no text stood; whether an article is marked; characters in forms that went).

    forms: whether a form is a region that is no text.
    """
    lines: list[tuple[str, int, bool, bool]] = []
    parts: list[str] = []
    # name, why it is no text, whether it is a marked article
    open_tags: list[tuple[str, str, bool]] = []
    opened: Counter[str] = Counter()
    closers: dict[str, re.Pattern] = {}
    unclosed: set[str] = set()
    off = depth = linked = links = at = asked = 0
    marked = held = heading = False

    def flush() -> None:
        nonlocal links, held, heading
        text = " ".join("".join(parts).split())
        if text or held:
            lines.append((text, links, depth > 0, heading))
        parts.clear()
        links, held, heading = 0, False, False

    def close(down_to: int) -> None:
        nonlocal off, depth
        for name, why, article in open_tags[down_to:]:
            off -= bool(why)
            depth -= article
            opened[name] -= 1
        del open_tags[down_to:]

    while m := TOKEN.match(page, at):
        at = m.end()
        if text := m["text"]:
            if off:
                held = held or not text.isspace()
                asked += len(text.strip()) if off == 1 and opened["form"] and any(why == "form" for _, why, _ in open_tags) else 0
            else:
                text = html.unescape(text) if "&" in text else text
                parts.append(text)
                if linked:
                    links += len(text.strip())
            continue
        name = (m["name"] or m["plain"] or "").lower()
        if not name:
            if m[0] == "<!--":
                found = page.find("-->", at)
                at = len(page) if found < 0 else found + 3
            continue
        if name not in INLINE:
            flush()
        if m["end"] or m["plain_end"]:
            if name == "a":
                linked = 0
            if opened[name] > 0:
                close(next(k for k in range(len(open_tags) - 1, -1, -1) if open_tags[k][0] == name))
            continue
        if name in SKIPPED:
            if name not in unclosed:
                end = closers.setdefault(name, re.compile(rf"</{name}\s*+>", re.I)).search(page, at)
                if end:
                    at = end.end()
                else:
                    unclosed.add(name)
            if name in unclosed and name in TO_END:
                break
            continue
        if name in VOID:
            continue
        attributes = m["attributes"] or m["rest"] or ""
        if name == "a":
            linked = 1
        heading = heading or name in HEADINGS
        why = ""
        if name in ARTICLE or name == "body":
            if off and (name == "body" or not any(x[1] in HOLDERS for x in open_tags)):
                # no menu or notice holds an article: what is still open was never closed
                close(next(k for k, x in enumerate(open_tags) if x[1]))
            why = boilerplate(name, attributes, depth > 0) if name == "article" else ""
            why = why if why in HOLDERS else ""
        else:
            if name not in INLINE and open_tags:
                last = open_tags[-1][0]
                if last in ("p", "button", "head") or last == name == "li":
                    close(len(open_tags) - 1)
            why = "" if name == "form" and not forms else boilerplate(name, attributes, depth > 0)
        article = name in ARTICLE and not off and not why
        marked = marked or article
        if why or name not in INLINE:
            open_tags.append((name, why, article))
            opened[name] += 1
            off += bool(why)
            depth += article
    flush()
    return lines, marked, asked


def masses(lines: list[tuple[str, int, bool, bool]], marked: bool) -> list[int]:
    """What each line counts."""
    return [len(text) if inside or not marked and (heading or 2 * links <= len(text)) else 0 for text, links, inside, heading in lines]


def stretches(mass: list[int], window: int, least: float) -> list[tuple[int, int]]:
    """(surge, dive): from the first line of text to after the last one, of each run of windows of text whose largest sum is above the least."""
    found: list[tuple[int, int]] = []
    start, last, total, most = -1, -1, 0, 0
    for i, x in enumerate([*mass, *[0] * window]):
        total += x - (mass[i - window] if i >= window else 0)  # the sum of the window that ends here
        if not total and start >= 0:
            if most > least:
                found.append((start, last + 1))
            start, most = -1, 0
        if x:
            start, last = (i if start < 0 else start), i
        most = max(most, total)
    return found


def with_links(span: tuple[int, int], lines: list[tuple[str, int, bool, bool]], window: int) -> tuple[int, int]:
    """A stretch with the lines at its ends that say more than their links, if these are fewer than a window's height."""
    (a, b), n = span, len(lines)
    says = lambda k: 0 <= k < n and lines[k][1] < len(lines[k][0])
    before = next((k for k in range(window) if not says(a - 1 - k)), window)
    after = next((k for k in range(window) if not says(b + k)), window)
    return (a - before if before < window else a), (b + after if after < window else b)


def main_text(page: str, window: int = WINDOW, share: float = SHARE) -> str:
    """The main text of a page."""
    lines, marked, asked = lines_of(page)
    if asked > sum(len(x[0]) for x in lines):
        lines, marked, _ = lines_of(page, False)
    mass = masses(lines, marked)
    if marked:
        spans = stretches(mass, window, 0)
        return "\n".join(text for a, b in spans for text, _, inside, _ in lines[a:b] if text and inside)
    # no window's sum is below zero, so the largest one is that of some stretch
    most = max((sum(mass[i : i + window]) for i in range(len(mass))), default=0)
    kept, at = [], 0
    for a, b in (with_links(s, lines, window) for s in stretches(mass, window, share * most)):
        kept += [x[0] for x in lines[max(a, at) : b] if x[0]]
        at = b
    return "\n".join(kept)


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns to keep, then text and n_chars (code points) of each row."""
    own = fresh(pages, "_html")
    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep) + ", text string, n_chars bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, own):
            texts = [main_text(decoded(x)) for x in text_bytes(part.column(own))]
            columns = [*(part.column(k) for k in range(len(keep))), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "text", "n_chars"])

    return pages.select(*keep, F.col(html_col).alias(own)).mapInArrow(run, schema)
