"""HTML extraction by line-block distribution.

Markup is stripped to lines, one for each block of the page. Lines inside
menus, headers, footers, sidebars, adverts, notices, forms, scripts, styles
and reader comments are left out; of the others each weighs as much as its
text without links (in a marked article: as all of its text). Weights are
summed over sliding windows of lines. Main text begins where a sum surges above
the threshold and ends where it dives to nothing; text between such points is
kept, whole.

What stands around an article is told by elements, and by names in class, id
and role. Names only hint: where no text outside hinted elements surges, the
largest of these turns out to be a wrapper and counts like any other; inside an
article, names that can be a subject take away only what is no dense text.
All steps take time in proportion to the page.
"""

from __future__ import annotations

import heapq
import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from gridloom.llm.common import bounded_batches

#: Comments, CDATA, declarations; tags whose quoted values are closed as they should be; other tags, up to the next angle bracket.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>\"']++|\"[^\"]*+\"(?=[\s/>])|'[^']*+'(?=[\s/>]))*+)>|<(/?)([a-zA-Z][^\s/<>]*)([^<>]*+)(?:>|(?=<)|\Z)", re.S)
_ATTR = re.compile(r"(?:^|[\s\"'])(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
#: Text inside is no text of the page; the parser reads on at the end tag only.
RAW = frozenset("script style noscript template textarea title xmp iframe noembed noframes svg".split())
_RAW_END = re.compile(rf"</({'|'.join(sorted(RAW))})(?=[\s/>])", re.I)
#: Elements that hold no main text.
OUTSIDE = frozenset("nav footer aside form button select dialog head menu fieldset datalist".split())
#: Elements that end a line before and after them.
BLOCK = frozenset(
    "address article aside blockquote body br canvas caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose text is running text.
PROSE = frozenset("p blockquote pre dd figcaption".split())
#: Parts of a class, id or role name that mark text around the article.
AROUND = frozenset(
    "ad ads adsense adbox adslot alert alertdialog banner banners breadcrumb breadcrumbs comment commentlist comments complementary consent contentinfo cookie cookies copyright dialog disclaimer discussion disqus donate footer gdpr hidden masthead menu menubar menus modal nav navbar navbox navigation newsletter notice notices notification notifications outbrain overlay pager pagination paywall popup privacy promo promos promoted promotion promotions recommended related replies respond search share sharing sidebar sidebars signup skip social subscribe subscription taboola teaser teasers toolbar tooltip topbar widget widgets".split()
)
#: Those of them that a section of an article may have for its subject: inside one, its text decides.
SUBJECT = frozenset("alert complementary copyright disclaimer discussion donate notice notices privacy recommended related search skip social".split())
#: Parts that say nothing of what an element holds.
FORM = frozenset("area bar block body bottom box btn button buttons container count extra form group head icon inner item items js left link links list module outer panel post right section slot small sticky text thread title top unit user view wp".split())
#: Parts after which a name tells what the element has or lacks, not what it is.
ABOUT = frozenset("with without no not non has hide toggle layout grid row wrap wrapper".split())
#: Parts of names that mark content, and names of the article itself.
CONTENT = frozenset("content article main post entry story".split())
ARTICLE = frozenset("main article articlebody".split())


_IMPRINT = re.compile(r"©|\(c\)|copyright|all rights reserved", re.I)


class Line(NamedTuple):
    """A line of a page: its text, whether it is left out, its innermost hinted element (0: none), whether it is in an article, characters in links, whether it is a heading, or running text."""

    text: str
    out: bool
    hint: int
    article: bool
    links: int
    head: bool
    prose: bool


def _marks(attrs: str) -> tuple[list[str], bool]:
    """Names in class, id, role and itemprop, and whether the element is hidden."""
    words, hidden = [], False
    for name, *values in _ATTR.findall(attrs):
        value, name = "".join(values), name.lower()
        if name in ("class", "id", "role", "itemprop"):
            words += value.split()
        else:
            hidden |= name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and bool(_HIDDEN.search(value))
    return words, hidden


def _hinted(words: list[str], page_level: bool, inside: bool) -> tuple[bool, bool]:
    """Whether one of an element's names marks text around the article and no other one marks content; and whether that is sure whatever the text is like.

    Inside an article a name marks nothing that has a part of another meaning beside.
    """
    around = content = other = sure = False
    for word in words:
        parts = {p.lower() for p in _PART.findall(word)}
        found = {p for p in parts if p in AROUND or p.startswith(("advert", "sponsor")) or page_level and p == "header"}
        own = not parts & ABOUT and bool(found)
        around |= own
        sure |= own and bool(found - SUBJECT)
        other |= any(p not in found | FORM and not p.isdigit() for p in parts)
        content |= not own and bool(parts & CONTENT)
    return around and not content and not (inside and other and not sure), sure


def _tokens(page: str) -> list[re.Match]:
    """Tags, comments and declarations in order. What stands between the tags of scripts, styles and their like is no markup: the next token there is the end tag."""
    ends: dict[str, list[int]] = {}
    for m in _RAW_END.finditer(page):
        ends.setdefault(m[1].lower(), []).append(m.start())
    found, at = [], 0
    while m := _TOKEN.search(page, at):
        found.append(m)
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if tag in RAW and not (m[1] or m[4]) and not (m[3] or m[6] or "").rstrip().endswith("/"):
            own = ends.get(tag, [])
            k = bisect_left(own, at)
            if k < len(own):
                at = own[k]
    return found


def page_lines(page: str) -> tuple[list[Line], list[int], list[bool]]:
    """Each non-empty line of a page in order; of each hinted element the hinted one around it, and whether its names are sure.

    An element left out whose end tag is missing ends where an article, a main
    element or a footer begins, and at the end of its parent at the latest.
    """
    lines: list[Line] = []
    text: list[str] = []
    stack: list[tuple[str, bool, int, bool, int]] = []  # open elements: tag, left out, hint, article, the hint around
    open_at: dict[str, list[int]] = {}
    parents, sure = [0], [False]
    out = article = links = anchors = hint = 0
    head = prose = False
    loose: list[tuple[int, int]] = []  # elements left out or hinted, by the last end tag of their name
    closes: dict[str, list[int]] = {}
    tokens = _tokens(page)
    for m in tokens:
        if m[1] or m[4]:
            closes.setdefault((m[2] or m[5]).lower(), []).append(m.start())

    def flush() -> None:
        nonlocal links, head
        if text:
            line = " ".join(html.unescape("".join(text)).split())
            if line:
                lines.append(Line(line, out > 0, hint, article > 0, min(links, len(line)), head, prose))
            text.clear()
        links = 0

    def pop(to: int) -> None:
        nonlocal out, article, hint
        if any(o or h or a for _, o, h, a, _ in stack[to:]):
            flush()
        while len(stack) > to:
            tag, o, h, a, around = stack.pop()
            open_at[tag].pop()
            out -= o
            article -= a
            hint = around

    at, raw = 0, ""
    for m in tokens:
        if m.start() < at:
            continue
        if not raw and m.start() > at:
            piece = page[at : m.start()]
            text.append(piece)
            links += len(piece.strip()) if anchors > 0 else 0
        end_tag, tag, attrs = bool(m[1] or m[4]), (m[2] or m[5] or "").lower(), m[3] or m[6] or ""
        if raw:
            if end_tag and tag == raw:
                raw, at = "", m.end()
            continue
        at = m.end()
        if not tag:
            if m[0].startswith("<![CDATA["):
                text.append(html.escape(m[0][9:].removesuffix("]]>"), quote=False))
            continue
        if tag in BLOCK:
            flush()
            head = tag in HEADS and not end_tag
            prose = tag in PROSE and not end_tag or tag == "br" and prose
        if tag == "a":
            anchors = 0 if end_tag else 1
        if end_tag:
            if open_at.get(tag):
                pop(open_at[tag][-1])
            continue
        if tag in RAW:
            ends = closes.get(tag, [])
            if bisect_left(ends, m.end()) == len(ends):
                if tag in ("script", "style", "textarea", "xmp"):
                    at = len(page)  # as browsers do: the rest belongs to it
                    break
            elif not attrs.rstrip().endswith("/"):
                raw = tag
            continue
        if tag in VOID:
            continue
        words, hidden = _marks(attrs) if attrs.strip() else ([], False)
        is_article = tag in ("article", "main") or any(w.lower() in ARTICLE for w in words)
        if tag in ("article", "main", "footer"):  # ends what was left open
            first = None
            while loose and loose[0][0] <= m.start():
                k = heapq.heappop(loose)[1]
                if k < len(stack) and (stack[k][1] or stack[k][2]):
                    first = k if first is None else min(first, k)
            if first is not None:
                flush()
                pop(first)
        if tag in ("body", "html"):
            is_out = is_hint = is_article = certain = False
            if open_at.get("head"):
                pop(open_at["head"][0])
        else:
            is_out = hidden or tag in OUTSIDE or tag == "header" and not article
            is_hint, certain = _hinted(words, not article and not is_article, article > 0) if words and not is_out else (False, False)
        is_article &= not is_out and not is_hint
        if (is_out or is_hint or is_article) and tag not in BLOCK:
            flush()
        around = hint
        if is_hint:
            parents.append(hint)
            sure.append(certain)
            hint = len(parents) - 1
        if is_out or is_hint:
            heapq.heappush(loose, (closes[tag][-1] if tag in closes else -1, len(stack)))
        open_at.setdefault(tag, []).append(len(stack))
        stack.append((tag, is_out, hint if is_hint else 0, is_article, around))
        out += is_out
        article += is_article
    if at < len(page) and not raw:
        text.append(page[at:])
    flush()
    return lines, parents, sure


def spans(weights: list[int], window: int, surge: int) -> list[tuple[int, int]]:
    """Runs of lines between surge and dive points.

    Window k sums lines k to k + window - 1. A run surges at the first window
    above `surge` and goes back over the weighty lines right before it; it
    dives at the first window that sums to nothing.
    """
    n, out, i = len(weights), [], 0
    sums = [0] * (n + 1)
    total = 0
    for k in range(n - 1, -1, -1):
        total += weights[k] - (weights[k + window] if k + window < n else 0)
        sums[k] = total
    end = 0
    while i < n:
        if sums[i] <= surge:
            i += 1
            continue
        start = i
        while start < n and not weights[start]:
            start += 1
        while start > end and weights[start - 1]:
            start -= 1
        dive = max(i, start)
        while dive < n and sums[dive] > 0:
            dive += 1
        out.append((start, dive))
        end = i = dive
    return out


def _kept(lines: list[Line], window: int, surge: int) -> tuple[list[Line], bool]:
    """Of lines that are not left out those of the main text, and whether any of them surged.

    Short lines that only lines of links part from it belong to it: headings
    right before the first run, lines between two runs, and sentences and running text after the last.
    """
    if any(x.article for x in lines):
        lines = [x for x in lines if x.article]
        weights = [len(x.text) for x in lines]
    else:
        weights = [len(x.text) - x.links for x in lines]
    runs = spans(weights, window, surge)
    if not runs:
        return lines, False
    keep = [False] * len(lines)
    for (a, b), after in zip(runs, [*runs[1:], (runs[-1][1], 0)], strict=True):
        while b > a and not weights[b - 1]:  # the window that dives reaches over the end
            b -= 1
        keep[a:b] = [True] * (b - a)
        for k in range(b, after[0]):
            keep[k] = weights[k] > 0
    first = runs[0][0]
    for k in range(first - 1, -1, -1):
        if weights[k] and not lines[k].head:
            break
        keep[k] = weights[k] > 0
    for k in range(runs[-1][1], len(lines)):
        if weights[k] and lines[k].text[-1] not in ".!?…\"”’。！？" and (not lines[k].prose or _IMPRINT.search(lines[k].text)):
            break
        keep[k] = weights[k] > 0
    return [x for x, k in zip(lines, keep, strict=True) if k], True


def _cleared(lines: list[Line], parents: list[int], sure: list[bool], surge: int) -> list[Line]:
    """The lines without hints that are unsure where, inside an article, the element's own text is as dense as the article's: more than `surge` characters, most of them in no link."""
    own, text = [0] * len(parents), [0] * len(parents)
    for x in lines:
        if x.article and x.hint and not sure[x.hint]:
            own[x.hint] += len(x.text) - x.links
            text[x.hint] += len(x.text)
    clear = [0] * len(parents)  # of each element, the innermost hinted one that counts
    for k in range(1, len(parents)):
        dense = own[k] > surge and 3 * own[k] > 2 * text[k]
        clear[k] = clear[parents[k]] if dense else k
    return [x._replace(hint=clear[x.hint]) if clear[x.hint] != x.hint else x for x in lines]


def main_text(page: str | None, window: int = 3, surge: int = 80) -> str:
    """The main text of a page: its blocks joined by line feeds, empty if there is none.

    Where the page marks its article, only lines of it count. A run of text
    must surge above `surge` characters in `window` lines; where none does,
    hinted elements are taken for wrappers, the largest first, and at last all
    lines that are not left out are kept.
    """
    if not page:
        return ""
    lines, parents, sure = page_lines(page)
    lines = _cleared([x for x in lines if not x.out], parents, sure, surge)
    plain = [x for x in lines if not x.hint]
    found, surged = _kept(plain, window, surge)
    wrapped = sum(len(x.text) for x in lines if x.hint and x.article)
    if surged and (any(x.article for x in plain) or wrapped <= sum(len(x.text) - x.links for x in plain)):
        return "\n".join(x.text for x in found)
    size = [0] * len(parents)
    for x in lines:
        size[x.hint] += len(x.text) - x.links
    for k in range(len(parents) - 1, 0, -1):
        size[parents[k]] += size[k]
    order = sorted((k for k in range(1, len(parents)) if size[k] > surge), key=lambda k: (-size[k], k))  # an outer element comes before those in it

    def without(n: int) -> tuple[list[Line], bool]:
        """What is kept if the first n elements of the order are wrappers."""
        wrapper = [False] * len(parents)
        for k in order[:n]:
            wrapper[k] = True
        live = [False] * len(parents)
        for k in range(1, len(parents)):
            live[k] = live[parents[k]] or not wrapper[k]
        return _kept([x for x in lines if not live[x.hint]], window, surge)

    low, high = 0, 1
    while high < len(order) and not without(high)[1]:
        low, high = high, 2 * high
    high = min(high, len(order))
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if without(middle)[1] else (middle, high)
    again, surged = without(high)
    return "\n".join(x.text for x in (again if surged else found))


def extract(df: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", window: int = 3, surge: int = 80) -> DataFrame:
    """Columns key, url, text, n_chars (code points) of each row, main text taken from the whole page.

    Null and empty pages give empty text; null keys and repeated rows pass
    through one for one; an empty table gives none; other columns of the input
    are left out.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [main_text(x.as_py(), window, surge) for x in part.column(2)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())], ["key", "url", "text", "n_chars"])

    bounded_batches(df.sparkSession)
    rows = df.select(df[key].alias("key"), df[url].cast("string").alias("url"), df[page].cast("string").alias("html"))
    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInArrow(run, f"key {kind}, url string, text string, n_chars bigint")
    return out.select(out["key"].alias(key), out["url"].alias("url"), "text", "n_chars")
