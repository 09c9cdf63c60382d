"""Main text of a web page: the maximum-scoring run of words and tags.

A page is a sequence of words and tags. Words score positive, tags negative, by how often
they stand outside the article in labelled pages; words inside links score negative as well, and
a little so do words in elements whose class, id or role says boilerplate. An element that
is boilerplate by its name has no words and counts as one tag, unless it is wrapped around
the article. A container that is boilerplate by its class, id or role, such as an advert or
the comments, is passed over: it neither ends the run nor belongs to the text, wherever it
stands, as long as it is certain where it ends and it holds the lesser part of the words. One linear scan finds the contiguous run with the largest sum; its words are
the text. If marks leave a page without text, it is scanned without them.

Labels are pages with exactly one ``article`` element. Tags are counted inside and outside
of it by Spark, over a bounded sample of such pages; the weights are a table of at most as
many rows as there are known tag names.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# At most about so many pages are read for weights.
SAMPLE_PAGES = 2000
LEAST_PENALTY, PENALTY, MOST_PENALTY = 0.05, 0.6, 4.0
MOST_INLINE = 0.5  # tags inside a line, which articles have as well
UNSEEN_PENALTY = 0.1
LINK_WORD = -0.5
MARKED_WORD = -0.25
# An element around so much of a page without articles is a wrapper of its text.
WRAPPER_SHARE = 0.8

# --- fixed values: element and attribute names of HTML
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section summary table tbody td tfoot th thead title tr ul".split()
)
INLINE = frozenset("a abbr b bdi bdo br cite code data del em font i img ins kbd label mark q s small span strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that are no article text, unless they are wrapped around it.
NOISE = frozenset("aside button dialog footer form head header iframe menu nav noscript object option select svg template textarea".split())
# Less likely article text: a class, id or role all of whose parts are such words.
NOISE_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent contentinfo cookie "
    "cookies footer header masthead menu modal nav navbar navigation newsletter notice popup promo related reply "
    "search share sidebar social sponsor sponsored subscribe toolbar widget".split()
)
# In a class, id or role of several parts, the first or last of these says as much, given that
# what it holds reads like it.
HINTS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs consent cookie cookies menu nav navbar "
    "navigation newsletter popup promo related sidebar social sponsor sponsored subscribe".split()
)
COMMENTS = frozenset("comment comments discussion respond".split())
CONTAINERS = frozenset("div section ul ol dl table details figure".split())
FEW_WORDS = 40  # an element with fewer words, or half of them in links, reads like boilerplate
KEPT = frozenset("html body main article h1 h2 h3 h4 h5 h6".split())
ARTICLE = frozenset("article main".split())

# Elements whose ends follow from what contains them. All others, like b or form, may overlap.
NESTED = (BLOCKS | NOISE) - VOID - {"form"}
LISTS, ROWS = frozenset("ul ol menu dl".split()), frozenset("thead tbody tfoot".split())
# Without an end tag, an element of the first names ends where one of the second begins, in the same one of the third.
_SECTIONS = frozenset("article main section nav aside header footer blockquote table td th".split())
SIBLINGS: dict[str, tuple[frozenset[str], frozenset[str]]] = {
    "li": (frozenset({"li"}), LISTS | _SECTIONS),
    **dict.fromkeys(("dt", "dd"), (frozenset({"dt", "dd"}), LISTS | _SECTIONS)),
    **dict.fromkeys(("td", "th"), (frozenset({"td", "th"}), frozenset({"tr", "table"}))),
    "tr": (frozenset({"tr"}), frozenset({"table"})),
    **dict.fromkeys(ROWS, (ROWS | {"tr"}, frozenset({"table"}))),
    "option": (frozenset({"option"}), frozenset({"select"})),
    "optgroup": (frozenset({"option", "optgroup"}), frozenset({"select"})),
}
# Tags at which a missing end tag is no fault.
MAY_END = {
    "li": {"li", "ul", "ol", "menu"},
    **dict.fromkeys(("dt", "dd"), {"dt", "dd", "dl"}),
    **dict.fromkeys(("td", "th"), {"td", "th", "tr", "table"} | ROWS),
    "tr": {"tr", "table"} | ROWS,
    **dict.fromkeys(ROWS, {"table"} | ROWS),
    **dict.fromkeys(("option", "optgroup"), {"option", "optgroup", "select"}),
}
NO_P = BLOCKS - frozenset("html head body title legend option optgroup summary".split())
IN_HEAD = frozenset("base link meta noscript object script style template title".split())
# An end tag does not reach out of these.
BOUNDS = frozenset("article caption main object table td template th".split())
WHOLE = frozenset("article body head html main table".split())
CELLS = ROWS | {"caption", "td", "th", "tr"}
# An element that is never closed goes on over these only.
ITEMS = LISTS | frozenset("dd dt li optgroup option hr".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style)\b.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>])*?)(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([^\s"'=/>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PART = re.compile(r"[a-z]+")

# A token is (kind, name or text, marks): kinds are text, open and close, marks are bits.
TEXT, OPEN, CLOSE = 0, 1, 2
NOISY, MARKED, LINK, HINTED, COMMENT = 1, 2, 4, 8, 16


def tokens(page: str) -> list[tuple[int, str, int]]:
    """Text runs and tags in page order; comments, scripts, styles and declarations are left
    out, and so is a tag that the page ends within."""
    out, done = [], 0
    for m in _TOKEN.finditer(page):
        if m.start() > done:
            out.append((TEXT, page[done : m.start()], 0))
        done = m.end()
        if m[3]:
            name = m[3].lower()
            out.append((CLOSE, name, 0) if m[2] else (OPEN, name, _marks(name, m[4])))
    if done < len(page):
        out.append((TEXT, page[done:], 0))
    return out


def _marks(name: str, attributes: str) -> int:
    marks = NOISY if name in NOISE else 0
    for m in _ATTRIBUTE.finditer(attributes or ""):
        if name == "a" and m[1].lower() == "href":
            marks |= LINK
        if m[1].lower() in ("class", "id", "role") and name not in KEPT:
            for token in (m[2] or m[3] or m[4] or "").lower().split():
                parts = _PART.findall(token)
                if parts and NOISE_WORDS.issuperset(parts):
                    marks |= MARKED
                ends = {*parts[:1], *parts[-1:]}
                marks |= (HINTED if ends & HINTS else 0) | (COMMENT if ends & COMMENTS else 0)
    return marks


def _ends(found: list[tuple[int, str, int]]) -> tuple[dict[int, int], set[int], dict[int, int]]:
    """The last token of every element that ends; the elements of which that is certain, by an
    end tag or because none is needed there; and the end tags of links that hold blocks."""
    ends: dict[int, int] = {}
    sure: set[int] = set()
    links: dict[int, int] = {}
    stack: list[int] = []
    places: dict[str, list[int]] = {}
    loose: dict[str, list[tuple[int, int]]] = {}

    def last(names) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=-1)

    def end(place: int, i: int, by: str) -> None:
        listed = last(LISTS) >= 0
        while len(stack) > place:
            k = stack.pop()
            name = found[k][1]
            places[name].pop()
            ends[k] = i - 1
            if name in ("p", "head") or by in MAY_END.get(name, ()) and (listed or name not in ("li", "dt", "dd")):
                sure.add(k)

    link = None
    for i, (kind, name, marks) in enumerate(found):
        if kind == OPEN:
            if places.get("head") and name not in IN_HEAD:
                end(places["head"][-1], i, name)
            if name in NO_P and places.get("p") and places["p"][-1] > last(("button", "object", "table", "td", "template", "th")):
                end(places["p"][-1], i, name)
            if name in SIBLINGS:
                names, within = SIBLINGS[name]
                bound = last(within)
                old = [places[n][-1] for n in names if places.get(n) and places[n][-1] > bound]
                if old:
                    end(min(old), i, name)
            if name in NESTED:
                places.setdefault(name, []).append(len(stack))
                stack.append(i)
            elif name not in VOID:
                loose.setdefault(name, []).append((i, len(stack)))
            if name == "a":
                link = (i, len(stack), stack[-1] if stack else -1) if marks & LINK else None
        elif kind == CLOSE and name in NESTED:
            if places.get(name):
                place = places[name][-1]
                bounds = BOUNDS - {name} if name not in WHOLE | CELLS else {"table"} if name in CELLS else ()
                if last(bounds) < place:
                    k = stack[place]
                    end(place + 1, i, name)
                    end(place, i, name)
                    ends[k] = i
                    sure.add(k)
        elif kind == CLOSE:
            if name == "a" and link is not None:
                at, depth, parent = link
                if len(stack) >= depth and (stack[depth - 1] if depth else -1) == parent:
                    if len(stack) == depth or found[stack[-1]][1] in ("p", "li", "dt", "dd"):
                        links[at] = i
                link = None
            if loose.get(name):
                k, depth = loose[name].pop()
                if name not in INLINE or len(stack) >= depth and (not depth or stack[depth - 1] < k):
                    ends[k] = i
                    sure.add(k)
    end(0, len(found), "")
    return ends, sure, links


def _levels(found: list[tuple[int, str, int]], elements: dict[int, int], sure: set[int]) -> list[int]:
    """Per token: 3 in a container that is passed over, 2 in an element that is no article
    text, 1 where words score less, else 0.

    What is wrapped around all articles, around most of their words, or, on a page without
    an article or main element, around nearly all words, is neither; what holds fewer of
    them has level 1. So has what is never closed, up to the next block, or, by its name, up
    to one that is no list. The header of an article belongs to it."""
    blocks = [i for i, (kind, name, _) in enumerate(found) if kind != TEXT and name in BLOCKS]
    others = [i for i in blocks if found[i][0] == OPEN and found[i][1] not in ITEMS]
    starts = [i for i, (kind, name, _) in enumerate(found) if kind == OPEN and name in ARTICLE | {"body"}]
    articles = [i for i in starts if found[i][1] in ARTICLE]
    words, of_articles, linked, inside, last, link = [0], [0], [0], [], -1, False
    for i, (kind, value, marks) in enumerate(found):
        if kind == OPEN and value in ARTICLE:
            last = max(last, elements.get(i, len(found)))
        if kind != TEXT and value == "a":
            link = bool(marks & LINK)
        n = len(value.split()) if kind == TEXT else 0
        words.append(words[-1] + n)
        linked.append(linked[-1] + (n if link else 0))
        of_articles.append(of_articles[-1] + (n if i <= last else 0))
        inside.append(i <= last)

    def passed_over(i: int, end: int, marks: int) -> bool:
        held = words[end + 1] - words[i]
        whole = of_articles[-1] if inside[i] else words[-1]
        if bisect_right(starts, end) > bisect_right(starts, i) or 2 * held >= whole:
            return False
        reads_so = held < FEW_WORDS or 2 * (linked[end + 1] - linked[i]) >= held
        return bool(marks & (MARKED | COMMENT)) or reads_so

    out, ends = [], [-1, -1, -1, -1]
    for i, (kind, name, marks) in enumerate(found):
        if marks & (MARKED | HINTED | COMMENT) and name in CONTAINERS and i in sure and passed_over(i, elements[i], marks):
            ends[3] = max(ends[3], elements[i])
        elif marks & (NOISY | MARKED) and name not in VOID and not (name == "header" and inside[i]):
            level = 2 if marks & NOISY else 1
            end = elements.get(i, len(found) - 1)
            if i not in sure:
                stops = others if marks & NOISY else blocks
                k = bisect_right(stops, i)
                level, end = 1, min(end, stops[k] - 1 if k < len(stops) else end)
            held = bisect_right(articles, end) - bisect_right(articles, i)
            if bisect_right(starts, end) > bisect_right(starts, i):
                around = held == len(articles) or 2 * (of_articles[end + 1] - of_articles[i]) > of_articles[-1]
                level = 0 if around else 1
            elif not articles and words[end + 1] - words[i] >= WRAPPER_SHARE * words[-1]:
                level = 0
            ends[level] = max(ends[level], end)
        out.append(next((k for k in (3, 2, 1) if i <= ends[k]), 0))
    return out


def _best(found: list, level: list[int], links: dict[int, int], penalties: dict[str, float]) -> tuple[int, int]:
    """The token range with the largest sum. A link ends at the next anchor or block, unless
    its end tag closes it around whole blocks."""
    best, best_at, total, start, link, link_end = 0.0, (0, 0), 0.0, 0, False, -1
    for i, (kind, value, marks) in enumerate(found):
        if level[i] == 3 or level[i] == 2 and i and level[i - 1] == 2:
            continue
        if kind == TEXT:
            total += len(value.split()) * (LINK_WORD if link else MARKED_WORD if level[i] else 1.0)
        else:
            if value == "a" and level[i] < 2:
                link, link_end = bool(marks & LINK), links.get(i, -1)
            elif value in BLOCKS and i > link_end:
                link = False
            total -= penalties.get(value, UNSEEN_PENALTY)
        if total > best:
            best, best_at = total, (start, i + 1)
        if total <= 0:
            total, start = 0.0, i + 1
    return best_at


def main_text(page: str | None, penalties: dict[str, float]) -> str:
    """Blocks of the best region, one per line; empty for a page without words."""
    found = tokens(page or "")
    elements, sure, links = _ends(found)
    level = _levels(found, elements, sure)
    best_at = _best(found, level, links, penalties)
    if best_at == (0, 0) and {1, 3} & set(level):
        level = [x if x == 2 else 0 for x in level]
        best_at = _best(found, level, links, penalties)
    blocks: list[list[str]] = [[]]
    for i in range(*best_at):
        kind, value, _ = found[i]
        if kind != TEXT or level[i] == 3:
            value = value if kind != TEXT else "div"
            if value not in INLINE and blocks[-1]:
                blocks.append([])
            elif value == "br":
                blocks[-1].append(" ")
        elif level[i] < 2:
            blocks[-1].append(value)
    lines = (" ".join(html.unescape("".join(b)).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch, how often each tag stands inside and outside the article."""
    for batch in batches:
        inside, outside = Counter(), Counter()
        for page in batch.column(0).to_pylist():
            found = tokens(page or "")
            at = [i for i, (_, name, _) in enumerate(found) if name == "article"]
            if len(at) == 2:
                for i, (kind, name, _) in enumerate(found):
                    if kind != TEXT and (name in BLOCKS or name in INLINE or name in NOISE):
                        (inside if at[0] < i < at[1] else outside)[name] += 1
        names = sorted(inside | outside)
        yield pa.RecordBatch.from_pydict(
            {"tag": names, "n_in": [inside[n] for n in names], "n_out": [outside[n] for n in names]},
            pa.schema([("tag", pa.string()), ("n_in", pa.int64()), ("n_out", pa.int64())]),
        )


def learn(pages: DataFrame, html_col: str = "html") -> dict[str, float]:
    """Penalty of every known tag: the log odds of standing outside, within bounds. Without a
    labelled page every tag has the penalty of an unseen one."""
    share = SAMPLE_PAGES / max(1, pages.count())
    chosen = pages.select(html_col)
    if share < 1:
        chosen = chosen.where(F.xxhash64(html_col) < int(-(2**63) + share * 2**64))
    counts = chosen.mapInArrow(_count, "tag string, n_in long, n_out long")
    rows = counts.groupBy("tag").agg(F.sum("n_in").alias("n_in"), F.sum("n_out").alias("n_out")).collect()
    odds = {r["tag"]: math.log((r["n_out"] + 1) / (r["n_in"] + 1)) for r in rows}
    most = {t: MOST_INLINE if t in INLINE else MOST_PENALTY for t in odds}
    return {t: min(most[t], LEAST_PENALTY + PENALTY * max(0.0, x)) for t, x in odds.items()}


def extracted(page: Column, penalties: dict[str, float]) -> Column:
    @F.pandas_udf("string")
    def extract(part: pd.Series) -> pd.Series:
        return pd.Series([main_text(p, penalties) for p in part], dtype=object)

    return extract(page)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, ``text`` and ``n_chars``, from the whole html. Null and empty
    pages have an empty text; null ids and urls and repeated rows pass through; an empty
    table gives no rows; other columns are not read."""
    text = extracted(F.col(html_col), learn(pages, html_col))
    return pages.select(id_col, url_col, text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
