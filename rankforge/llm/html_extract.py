"""Main text of web pages by two-pass block rules.

The page is cut into blocks at block-level tags. What markup declares to be
something else than the article is bad: head, nav, footer, aside, forms,
scripts, hidden elements, elements whose class, id or role names an advert,
notice, comment and the like. Names that also stand on wrappers of a whole page
(sidebar, header, widget, search ...) are evidence only: such an element is
bad unless it holds more than half of the page's prose and ``WEIGHT`` times the
prose outside all such elements. An article or main element makes all outside
it bad unless the prose outside is more than ``WEIGHT`` times its text. Prose
means long blocks with few links and enough stop words.

First pass, per remaining block: many characters in links make it bad; a short
block is ambiguous; a longer one is good or bad by its share of stop words (in
an article or main element it is good); a character of a script without spaces
counts as a word. Second pass: a run of ambiguous blocks takes the label of the
nearest decided block before or after it (the good one at equal distance);
where nothing is decided they are good.

Edge cases: null or empty html gives an empty text; unclosed and crossing tags,
cut-off tags and character references are read as far as they go; an unclosed
button, select, svg and the like loses only its text up to the next tag; html
of any length is read whole; repeated rows are extracted each; an empty table
gives an empty table; columns named ``text``, ``n_chars`` and ``n_blocks`` are
replaced, all others kept.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

# Fixed values of HTML: elements by their role.
BLOCK = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody
td tfoot th thead title tr ul""".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea".split())
INSETS = set("svg iframe object canvas math select button audio video map".split())
DROPPED = set("head nav footer aside form fieldset dialog menu".split())
MAIN = {"article", "main"}

# Words in class, id and role that name something other than the article.
NAMES = set("""ad ads adv advert adverts advertisement advertising adsense breadcrumb breadcrumbs comment comments
commentlist complementary consent contentinfo cookie cookies copyright disclaimer disqus footer gdpr masthead newsletter
notice notices outbrain pagination pager promo promoted promotion replies reply respond signup skip sponsor sponsored
subscribe taboola""".split())
WRAPPERS = set("""alert banner login menu modal nav navbar navigation popup related search share sharing sidebar social
teaser toolbar topbar widget widgets""".split())
COMMENTS = {"comment", "comments", "commentlist", "disqus", "replies", "reply", "respond"}

# Frequent function words of the languages served, and characters of scripts without spaces.
STOP_WORDS = frozenset("""
a an and are as at be by for from has have he in is it of on or she that the this to was were which with you
aber als am auch auf aus das dem den der des die ein eine er es für im ist mit nicht sich sie sind und von war zu zum
al con de del el en es la las lo los no para pero por que se su sus un una y
au aux ce dans de des du elle en est et il la le les mais ne ou par pas pour que qui sa se son sur un une
alla che ci come con da dal dei del della di gli ha i il in le lo ma nel nella non per più si sono sul un una
ao com da do dos e em é foi mais na não no o os pela que se um uma
dat de een en het hij is maar met naar niet ook op te van voor was ze zijn
一 不 了 人 们 他 在 是 有 的 这 が た て で と に の は も を
""".split())

SHORT, LINKS, STOPS, WEIGHT = 70, 0.5, 0.12, 4
_DENSE = "\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff"
_WORD = re.compile(rf"[{_DENSE}]|[^\W{_DENSE}]+")

_TOKEN = re.compile(r"<!--|<!\[CDATA\[|<[!?]|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_ATTRS = re.compile(r"""\s*([^\s=>/"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?|[/"'=]""")
_NAME = re.compile(r"[a-z]+")


class Block(NamedTuple):
    text: str
    links: int  # characters in links
    dropped: bool  # by markup, for certain
    main: bool  # inside article or main
    wrapper: int  # innermost element around it with a wrapper's name, -1: none


def _tag_end(page: str, at: int) -> tuple[int, dict[str, str]]:
    """Place after a tag whose attributes start at ``at``, and its attributes."""
    attrs: dict[str, str] = {}
    while m := _ATTRS.match(page, at):
        if m[1]:
            attrs.setdefault(m[1].lower(), (m[2] or "").strip("\"'"))
        at = m.end()
    end = page.find(">", at)
    return (len(page) if end < 0 else end + 1), attrs


def _drops(tag: str, attrs: dict[str, str], in_main: bool) -> str:
    """Why an element is no part of the article: "", "comment", "other", or "wrapper" for a name that proves little."""
    if tag in ("html", "body"):
        return ""
    names = set(_NAME.findall(" ".join(attrs.get(k, "") for k in ("class", "id", "role")).lower())) if attrs else set()
    if names & COMMENTS:
        return "comment"
    if tag in MAIN:
        return ""
    style = attrs.get("style", "").replace(" ", "").lower()
    if tag in DROPPED or tag == "header" and not in_main or names & NAMES or "hidden" in attrs \
            or attrs.get("aria-hidden") == "true" or "display:none" in style:
        return "other"
    if names & WRAPPERS or not in_main and tag in ("div", "section", "ul") and "header" in names:
        return "wrapper"
    return ""


def blocks(page: str) -> tuple[list[Block], list[int]]:
    """Blocks in page order, and for each element with a wrapper's name, in
    page order, the one around it (-1: none)."""
    out: list[Block] = []
    around: list[int] = []
    parts: list[str] = []
    state = {"links": 0, "in_link": False}
    # open elements: tag, reason to drop, inside article or main, innermost wrapper
    stack: list[tuple[str, str, bool, int]] = []

    def text(raw: str) -> None:
        if raw:
            parts.append(raw)
            if state["in_link"]:
                state["links"] += len("".join(raw.split()))

    def flush() -> None:
        if parts:
            words = " ".join(html.unescape("".join(parts)).split())
            if words:
                _, why, main, wrapper = stack[-1] if stack else ("", "", False, -1)
                out.append(Block(words, state["links"], bool(why), main, wrapper))
            parts.clear()
        state["links"] = 0

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at:m.start()])
        if not m[2]:
            close = {"<!--": "-->", "<![CDATA[": "]]>"}.get(m[0], ">")
            end = page.find(close, m.end())
            at = n if end < 0 else end + len(close)
            continue
        closing, tag = m[1], m[2].lower()
        if closing:
            at = page.find(">", m.end()) + 1 or n
            attrs: dict[str, str] = {}
        else:
            at, attrs = _tag_end(page, m.end())
        if tag in RAW and not closing:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in INSETS and not closing:
            end = re.compile(rf"<(/?){tag}\b[^>]*>", re.I).search(page, at)
            if end and end[1]:
                at = end.end()
            else:  # not closed: what follows its own text is none of it
                at = page.find("<", at)
                at = n if at < 0 else at
            continue
        if tag == "a":
            state["in_link"] = not closing
        elif tag == "br":
            parts.append(" ")
        if tag in BLOCK:
            flush()
            state["in_link"] = False
        if tag in VOID or tag == "p":
            continue
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    if tag not in BLOCK:
                        flush()
                    del stack[i:]
                    break
            continue
        _, why, main, wrapper = stack[-1] if stack else ("", "", False, -1)
        own = _drops(tag, attrs, main)
        if tag not in BLOCK and (not own or why):
            continue
        if tag not in BLOCK:  # an inline element that is dropped ends the block
            flush()
        if own == "wrapper":
            around.append(wrapper)
            own, wrapper = "", len(around) - 1
        elif tag in MAIN and why != "comment" and not own:
            # an element that was not closed before does not swallow the article
            stack.append((tag, "", True, -1))
            continue
        stack.append((tag, why or own, main, wrapper))
    flush()
    return out, around


def _kept_wrappers(found: list[Block], prose: list[int], around: list[int]) -> list[bool]:
    """Which elements with a wrapper's name hold the article and stay."""
    held = [0] * len(around)  # prose whose innermost wrapper this is
    for b, size in zip(found, prose):
        if b.wrapper >= 0:
            held[b.wrapper] += size
    within = held[:]
    for i in range(len(around) - 1, -1, -1):
        if around[i] >= 0:
            within[around[i]] += within[i]
    free = [b for b in found if b.wrapper < 0 and not b.dropped]
    outside, total = sum(size for b, size in zip(found, prose) if b.wrapper < 0), sum(prose)
    kept = [False] * len(around)
    if any(b.main for b in free):
        return kept
    for i, outer in enumerate(around):
        if (outer < 0 or kept[outer]) and 2 * within[i] > total and within[i] > WEIGHT * outside:
            kept[i] = True
            outside += held[i]
    return kept


def main_blocks(page: str, stop_words: frozenset[str] = STOP_WORDS) -> tuple[list[str], int]:
    """Texts of the good blocks, and the number of all blocks."""
    found, around = blocks(page)
    linked = [b.links > LINKS * len(b.text.replace(" ", "")) for b in found]
    fluent = []
    for b, many in zip(found, linked):
        each = [] if b.dropped or many else _WORD.findall(b.text.lower())
        long = len(b.text) >= SHORT or 2 * len(each) >= SHORT
        fluent.append(sum(w in stop_words for w in each) >= STOPS * len(each) if long and each else None)
    prose = [len(b.text) if x else 0 for b, x in zip(found, fluent)]
    kept = _kept_wrappers(found, prose, around)
    bad = [b.dropped or b.wrapper >= 0 and not kept[b.wrapper] for b in found]
    region = sum(len(b.text) for b, x, many in zip(found, bad, linked) if b.main and not x and not many)
    beside = sum(size for b, x, size in zip(found, bad, prose) if not b.main and not x)
    has_main = any(b.main and not x for b, x in zip(found, bad)) and beside <= WEIGHT * region
    labels: list[bool | None] = []
    for b, x, many, good in zip(found, bad, linked, fluent):
        if x or has_main and not b.main or many:
            labels.append(False)
        else:
            labels.append(None if good is None else b.main or good)
    # blocks outside the region, and lists of links inside an article, say nothing about their neighbours
    speaks = [label is not None and not x and (label if b.main else not has_main)
              for label, b, x in zip(labels, found, bad)]
    far = len(found) + 1
    before, last, near = [], None, far
    for i in range(len(found)):
        if speaks[i]:
            last, near = labels[i], 0
        before.append((near, last))
        near += 1
    good, last, near = [False] * len(found), None, far
    for i in range(len(found) - 1, -1, -1):
        if labels[i] is None:
            (d, x), (e, y) = before[i], (near, last)
            near_label = x if y is None or x is not None and (d < e or d == e and x) else y
            good[i] = near_label is not False
        else:
            good[i] = bool(labels[i])
            if speaks[i]:
                last, near = labels[i], 0
        near += 1
    return [b.text for b, g in zip(found, good) if g], len(found)


def extract(pages: DataFrame, stop_words: frozenset[str] = STOP_WORDS) -> DataFrame:
    """``pages(html)`` plus ``text``, ``n_chars`` (code points) and ``n_blocks``.
    ``stop_words`` are lower-cased words, or single characters of scripts
    without spaces, of the languages that the pages are in."""
    new = [("text", "string"), ("n_chars", "long"), ("n_blocks", "long")]
    kept = [c for c in pages.columns if c not in dict(new) and c != "html"]
    schema = pages.select(*kept).schema
    for name, kind in new:
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                got = [main_blocks(p, stop_words) if p else ([], 0) for p in part.column("html").to_pylist()]
                texts = [" ".join(x) for x, _ in got]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), pa.array(texts, pa.string()),
                     pa.array(map(len, texts), pa.int64()), pa.array([n for _, n in got], pa.int64())],
                    names=[*kept, *dict(new)])

    return pages.select(*kept, "html").mapInArrow(run, schema)
