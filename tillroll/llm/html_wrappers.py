"""Operator 3: main text of web pages with wrappers inferred per host.

A page is read once into a balanced stream of tokens: opening and closing tags
(name and the letters of class, id and role) and texts.  Repetitions next to each
other inside a page become repeated groups.  Streams of one host are then aligned
one after another; every mismatch is resolved: different texts at one place become
a slot, a span that repeats its neighbour becomes a repeated group, any other span
an optional group.  The result is a union-free regular expression -- tags, slots,
``+`` and ``?`` groups, no alternatives -- that all its pages match: the wrapper.

Wrappers are folded in three steps (per Arrow batch, per host and salt, per host),
each a running alignment that holds one wrapper, so a host with a third of all
pages is no larger a group than any other.  Texts in wrappers are fingerprints.
Every page is aligned, however large.  Where the common form of two wrappers would be
much larger than both (and than ``MOST_ITEMS``), they are layouts of their own: a host has
a wrapper for each, and all its pages are in one.  In a host of several layouts a text that
one holds constant is constant only if more than half of the host's pages with texts at its
path hold it there.

Extraction: a text counts unless it lies in an element that is a menu, header,
footer, sidebar, notice, advert, form or comment by its tag, role or class words.
Names of a state (``has-sidebar``) say nothing about the element itself; a form or an
element muted by its words that holds most of the text of the page's articles (or else
of its other containers) is a layout around them and not muted.
Of what is left, the text of the best container of the page is taken: article,
main, an element named like an article, or else the body -- there the texts that
the wrapper holds constant and that stand at one path (of tags and their words) on at
least ``LEAST_PAGES`` pages are template and go.  Character references are decoded, white space in a block becomes one space,
blocks are joined by a line end.

Defined cases: a null page is empty and so is its text; urls without a host share
one wrapper but no template; unclosed, stray and cut-off tags are tolerated (a tag cut off at the end
is markup); repeated rows come back as often; an empty table gives an empty
result; long pages are read whole.
"""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import table, written

# Production parameters.
LEAST_PAGES = 3
MOST_ITEMS = 3000  # a wrapper may always grow to as many; above that, layouts that share little are kept apart
LONGEST_UNIT = 24  # tokens of a repeated group found inside a page
SALTS = 32

# What elements are.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td
    tfoot th thead title tr ul""".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MUTED_TAGS = frozenset("nav footer aside form menu dialog head button select input label".split())
MUTED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
MUTED_WORDS = frozenset(
    """ad ads advert adverts advertisement advertisements advertising advertorial alert aside banner breadcrumb breadcrumbs
    comment comments consent cookie cookies copyright disqus footer form gdpr header login masthead menu menus modal nav navbar
    navigation newsletter notice notices notification pager pagination paywall popup promo promoted promotion recommended
    related replies respond search share sharing sidebar signin signup social sponsor sponsored subscribe subscription toolbar
    topbar widget""".split()
)
MUTED_ARTICLES = frozenset("ad ads advert advertisement comment comments promo promoted related sponsored".split())
ARTICLE_WORDS = frozenset("article content entry post story".split())
STATE_WORDS = frozenset("has have with without no not is".split())  # names with these tell what is elsewhere
#: an opening tag ends an open element of these, up to the nearest of the others
ENDS = {
    "li": ("li", "ul ol menu dir"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "thead": ("tr td th", "table"),
    "tbody": ("thead tr td th", "table"),
    "tfoot": ("tbody tr td th", "table"),
    "option": ("option", "select"),
}
_ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS.items()}
_ENDS_P = BLOCKS - {"head", "html", "body", "title", "option", "optgroup", "caption", "legend"}

_ATTRIBUTES = r"""(?:[^>"']|"[^"]*"|'[^']*')*"""
TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)
    |<(script|style|noscript|template|textarea|iframe|title|svg|math|xmp|noembed|noframes|object|audio|video|canvas)(?=[\s/>]){_ATTRIBUTES}>
      (?:.*?</\1\s*>|.*\Z)
    |<(/?)([a-zA-Z][^\s/>]*)({_ATTRIBUTES})>
    |<(/?)([a-zA-Z][^\s/>]*)([^>]*)>
    |<[!?/][^>]*(?:>|\Z)
    |<[a-zA-Z][^>]*\Z""",
    re.S | re.I | re.X,
)
_NAMED = re.compile(r"""(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_LETTERS = re.compile("[a-z]+")

BODY, NAMED, ROLE, MAIN, ARTICLE = range(5)  # how good a container an element is


class Place:
    """An element on a path: how it is written in streams, whether its text is
    muted (1: except headings; ``own`` by itself, ``soft`` where a layout may be
    taken for it, ``hard`` if never lifted), the best container it lies in, and the
    characters inside it in containers from ``NAMED`` and from ``ROLE`` on."""

    __slots__ = ("above", "path", "tag", "symbol", "own", "soft", "hard", "muted", "container", "named", "main")

    def __init__(self, above: Place | None, tag: str, symbol: str, own: int, soft: bool, container: int):
        self.above, self.tag, self.symbol, self.own, self.soft = above, tag, symbol, own, soft
        self.path = xxhash.xxh64_intdigest(symbol, seed=above.path) if above else 0
        self.hard = above is not None and above.hard or (own == 2 and not soft)
        self.container = max(container, above.container) if above else container
        self.named = self.main = 0
        self.mute()

    def mute(self) -> None:
        muted, above = self.own, self.above
        if above is not None:
            if muted == 1 and above.container < NAMED:
                muted = 2  # a header outside the article
            muted = max(muted, above.muted)
        self.muted = 0 if muted == 1 and self.tag in HEADINGS else muted


@lru_cache(maxsize=4096)
def _element(tag: str, attributes: str) -> tuple[str, int, bool, int]:
    """(symbol, muted, soft, container) of an opening tag by itself."""
    words: set[str] = set()
    named: set[str] = set()  # without the names of a state
    role = ""
    container = ARTICLE if tag == "article" else MAIN if tag == "main" else BODY
    for name, value in _NAMED.findall(attributes):
        found = _LETTERS.findall(value.lower())
        if name.lower() == "role":
            role = found[0] if found else ""
        elif name.lower() == "itemprop":
            if "".join(found) == "articlebody":
                container = max(container, ROLE)
        else:
            words.update(found)
            for one in value.lower().split():
                parts = _LETTERS.findall(one)
                if len(parts) == 1 or not STATE_WORDS.intersection(parts):
                    named.update(parts)
    symbol = ".".join([tag, *sorted(words)])
    if role == "main":
        container = max(container, ROLE)
    if tag in ("html", "body", "main"):
        return symbol, 0, False, container
    if tag == "article":
        return symbol, 2 * bool(named & MUTED_ARTICLES), False, container
    if tag == "form":
        return symbol, 2, not named & MUTED_ARTICLES, container
    if tag in MUTED_TAGS or named & MUTED_ARTICLES or role in MUTED_ROLES:
        return symbol, 2, False, container
    muted = named & MUTED_WORDS
    if muted:
        return symbol, 1 if muted == {"header"} else 2, True, container
    if tag == "header":
        return symbol, 1, False, container
    if words & ARTICLE_WORDS and tag in ("div", "section", "td"):
        container = max(container, NAMED)
    return symbol, 0, False, container


def _lift(root: Place, places: list[Place]) -> None:
    """No longer mutes layouts: soft elements outside the containers that hold most
    of the containers' text.  ``places`` has parents before their children."""
    least, total = (ROLE, root.main) if root.main else (NAMED, root.named)
    lifted = False
    for p in places:
        inside = p.main if least == ROLE else p.named
        if p.soft and p.own and p.above.container < least and 2 * inside > total:
            p.own, lifted = 0, True
    if lifted:
        for p in places:
            p.mute()


def read_page(page: str) -> tuple[list[str], list[tuple[int, Place, str]]]:
    """(tokens, texts): the balanced stream, ``#`` for a text, and for every text
    its block, place and raw characters (a line break is a blank)."""
    root = Place(None, "", "", 0, False, BODY)
    stack, tokens, texts = [root], [], []
    places: list[Place] = []
    soft = False
    inside: dict[str, list[int]] = {}  # where the open elements of a tag stand in the stack

    def nearest(tags: Iterable[str]) -> int:
        return max((inside[t][-1] for t in tags if inside.get(t)), default=0)

    block = at = 0

    def text(raw: str) -> None:
        if raw.strip():
            tokens.append("#")
            place = stack[-1]
            texts.append((block, place, raw))
            if place.container and not place.hard:
                place.named += len(raw)
                place.main += len(raw) if place.container >= ROLE else 0
        elif texts and texts[-1][0] == block:
            texts.append((block, stack[-1], " "))

    def close(depth: int) -> None:
        nonlocal block
        while len(stack) > depth:
            place = stack.pop()
            stack[-1].named += place.named
            stack[-1].main += place.main
            inside[place.tag].pop()
            tokens.append(f"</{place.tag}>")
            block += place.tag in BLOCKS

    for m in TOKEN.finditer(page):
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        tag = m[3] or m[6]
        if not tag:
            continue
        tag = tag.lower()
        if m[2] or m[5]:
            if inside.get(tag):
                close(inside[tag][-1])
            elif tag == "p":
                block += 1
            continue
        if tag == "br":
            if texts and texts[-1][0] == block:
                texts.append((block, stack[-1], " "))
            continue
        if tag in VOID:
            block += tag == "hr"
            continue
        if tag in _ENDS_P and inside.get("p"):
            close(inside["p"][-1])
        if tag in _ENDS:
            ended, until = _ENDS[tag]
            if (k := nearest(ended)) > nearest(until):
                close(k)
        place = Place(stack[-1], tag, *_element(tag, m[4] or m[7] or ""))
        stack.append(place)
        places.append(place)
        soft = soft or place.soft
        inside.setdefault(tag, []).append(len(stack) - 1)
        tokens.append(f"<{place.symbol}>")
        block += tag in BLOCKS
    text(page[at:])
    close(1)
    if soft and root.named:
        _lift(root, places)
    return tokens, texts


def _clean(raw: str) -> str:
    return " ".join(html.unescape(raw).split())


def main_text(page: str, template: frozenset[str] = frozenset()) -> str:
    """The main text of a page; ``template`` has the fingerprints of texts that
    its host's wrapper holds constant.  A page of nothing but those keeps them."""
    _, texts = read_page(page)
    texts = [x for x in texts if not x[1].muted]
    level = max((p.container for _, p, raw in texts if raw != " "), default=BODY)
    if level == BODY and template:
        own = [x for x in texts if fingerprint(x[2]) not in template]
        texts = own if any(raw.strip() for _, _, raw in own) else texts
    out: list[str] = []
    held: list[str] = []
    last = -1
    for block, place, raw in texts:
        if place.container < level:
            continue
        if block != last and held:
            out.append(_clean("".join(held)))
            held = []
        held.append(raw)
        last = block
    out.append(_clean("".join(held)))
    return "\n".join(x for x in out if x)


def fingerprint(raw: str) -> str:
    return xxhash.xxh64_hexdigest(_clean(raw).encode())


# ---- wrappers ---------------------------------------------------------------
# Items: a tag is a string; a text ("#", x) where x is a fingerprint or None for a
# slot; a group ("+" or "?", items).


def _key(item) -> object:
    if isinstance(item, str):
        return item
    return "#" if item[0] == "#" else (item[0], tuple(_key(x) for x in item[1]))


def _balanced(keys: list) -> bool:
    depth = 0
    for k in keys:
        if isinstance(k, str) and k[0] == "<":
            depth += -1 if k[1] == "/" else 1
            if depth < 0:
                return False
    return depth == 0


def _same_shape(a, b):
    """Merge of two items with equal keys."""
    if isinstance(a, str):
        return a
    if a[0] == "#":
        return a if a[1] == b[1] else ("#", None)
    return (a[0], tuple(_same_shape(x, y) for x, y in zip(a[1], b[1], strict=True)))


def _fold_shapes(parts: list[list]) -> tuple:
    out = parts[0]
    for p in parts[1:]:
        out = [_same_shape(x, y) for x, y in zip(out, p, strict=True)]
    return tuple(out)


def collapse(items: list) -> list:
    """Turns repetitions next to each other into repeated groups, innermost first."""
    while True:
        keys = [_key(x) for x in items]
        out: list = []
        k, n, changed = 0, len(items), False
        while k < n:
            unit = 0
            for p in range(1, min(LONGEST_UNIT, (n - k) // 2) + 1):
                if keys[k] == keys[k + p] and keys[k : k + p] == keys[k + p : k + 2 * p] and _balanced(keys[k : k + p]):
                    unit = p
                    break
            if not unit:
                out.append(items[k])
                k += 1
                continue
            parts = []
            while keys[k : k + unit] == keys[k + len(parts) * unit : k + (len(parts) + 1) * unit]:
                parts.append(items[k + len(parts) * unit : k + (len(parts) + 1) * unit])
            group = _fold_shapes(parts)
            out.append(group[0] if unit == 1 and not isinstance(group[0], str) and group[0][0] == "+" else ("+", group))
            k += unit * len(parts)
            changed = True
        items = out
        if not changed:
            return items


def page_expression(page: str) -> list:
    return _expression(*read_page(page))


def _expression(tokens: list[str], texts: list[tuple[int, Place, str]]) -> list:
    raw = iter([t for _, _, t in texts if t != " "])
    return collapse([("#", fingerprint(next(raw))) if t == "#" else t for t in tokens])


def page_texts(texts: list[tuple[int, Place, str]]) -> set[tuple[int, str]]:
    """(path, fingerprint) of the texts of a page that can be template: neither muted
    nor in a container; and (path, "") once per path."""
    held = {(p.path, fingerprint(raw)) for _, p, raw in texts if raw.strip() and not p.muted and p.container == BODY}
    return held | {(path, "") for path, _ in held}


def _optional(span: list):
    return span[0] if len(span) == 1 and not isinstance(span[0], str) and span[0][0] == "?" else ("?", tuple(span))


def _put(out: list, span: list) -> None:
    """Adds a span that only one side has: as one more repetition of what stands
    before it, or as an optional group."""
    keys, n = [_key(x) for x in span], len(span)
    before = out[-1] if out else None
    if before is not None and not isinstance(before, str) and before[0] == "+" and [_key(x) for x in before[1]] == keys:
        out[-1] = ("+", tuple(_same_shape(x, y) for x, y in zip(before[1], span, strict=True)))
    elif len(out) >= n and _balanced(keys) and [_key(x) for x in out[-n:]] == keys:
        out[-n:] = [("+", tuple(_same_shape(x, y) for x, y in zip(out[-n:], span, strict=True)))]
    else:
        out.append(_optional(span))


def _anchors(a: list[int], b: list[int], n: int) -> list[tuple[int, int]]:
    """Places of spans of ``n`` keys that stand once in either list, as many as keep the order."""
    def once(x: list[int]) -> dict[tuple, int]:
        found: dict[tuple, int] = {}
        for k in range(len(x) - n + 1):
            span = tuple(x[k : k + n])
            found[span] = -1 if span in found else k
        return found

    there = once(b)
    pairs = [(i, there[x]) for x, i in once(a).items() if i >= 0 and there.get(x, -1) >= 0]
    ends: list[int] = []  # least end of an increasing run of each length
    last: list[int] = []
    before: list[int] = []
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(ends, j)
        before.append(last[at - 1] if at else -1)
        ends[at : at + 1], last[at : at + 1] = [j], [k]
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def _common_lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and each beginning of ``b``."""
    row = np.zeros(len(b) + 1, np.int64)
    for x in a.tolist():
        longer = row.copy()
        np.maximum(row[1:], row[:-1] + (b == x), out=longer[1:])
        row = np.maximum.accumulate(longer)
    return row


def _longest_common(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Places of a longest common subsequence, in memory that grows with the lists
    (Hirschberg: halves of ``a`` are given the beginning and the rest of ``b``)."""
    out, parts = [], [(0, len(a), 0, len(b))]
    while parts:
        i, j, s, e = parts.pop()
        if i == j or s == e:
            continue
        if j - i == 1:
            at = np.flatnonzero(b[s:e] == a[i])
            out += [(i, s + int(at[0]))] if len(at) else []
            continue
        m = (i + j) // 2
        k = s + int(np.argmax(_common_lengths(a[i:m], b[s:e]) + _common_lengths(a[m:j][::-1], b[s:e][::-1])[::-1]))
        parts += [(i, m, s, k), (m, j, k, e)]
    return sorted(out)


def _opcodes(ka: list, kb: list) -> list[tuple[str, int, int, int, int]]:
    """What differs between two lists of keys.  Long lists are cut at equal ends and at spans
    that stand once in both, and have a longest common subsequence in the gaps, so that time
    grows with the square of a gap instead of a page.  Memory grows with the lists."""
    if max(len(ka), len(kb)) <= MOST_ITEMS:
        return SequenceMatcher(None, ka, kb, autojunk=False).get_opcodes()
    number: dict[object, int] = {}
    a, b = ([number.setdefault(k, len(number)) for k in keys] for keys in (ka, kb))
    same: list[tuple[int, int, int]] = []  # (place in a, in b, length)
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        i, j, s, e = gaps.pop()
        k = 0
        while i + k < j and s + k < e and a[i + k] == b[s + k]:
            k += 1
        if k:
            same.append((i, s, k))
        i, s, k = i + k, s + k, 0
        while i < j - k and s < e - k and a[j - k - 1] == b[e - k - 1]:
            k += 1
        if k:
            same.append((j - k, e - k, k))
        j, e = j - k, e - k
        if i == j or s == e:
            continue
        cuts = next((c for n in (16, 4, 1) if (c := _anchors(a[i:j], b[s:e], n))), [])
        if not cuts:
            same += [(i + x, s + y, 1) for x, y in _longest_common(np.array(a[i:j]), np.array(b[s:e]))]
            continue
        places = [(i + x, s + y) for x, y in cuts]
        same += [(x, y, 1) for x, y in places]
        starts = [(i, s), *((x + 1, y + 1) for x, y in places)]
        gaps += [(x, u, y, v) for (x, y), (u, v) in zip(starts, [*places, (j, e)], strict=True) if x < u or y < v]
    out: list[tuple[str, int, int, int, int]] = []
    i = s = 0
    for x, y, n in [*sorted(same), (len(a), len(b), 0)]:
        if i < x or s < y:
            out.append(("replace" if i < x and s < y else "delete" if i < x else "insert", i, x, s, y))
        if n and out and out[-1][0] == "equal":
            out[-1] = ("equal", out[-1][1], x + n, out[-1][3], y + n)
        elif n:
            out.append(("equal", x, x + n, y, y + n))
        i, s = x + n, y + n
    return out


def align(a: list, b: list) -> list:
    """The wrapper of everything that the expressions a and b describe."""
    ka, kb = [_key(x) for x in a], [_key(x) for x in b]
    if ka == kb:
        return [_same_shape(x, y) for x, y in zip(a, b, strict=True)]
    out: list = []
    for op, i, j, s, e in _opcodes(ka, kb):
        left, right = list(a[i:j]), list(b[s:e])
        if op == "equal":
            out += [_same_shape(x, y) for x, y in zip(left, right, strict=True)]
        elif len(left) == len(right) == 1 and not isinstance(left[0], str) and not isinstance(right[0], str) and left[0][0] == right[0][0] != "#":
            out.append((left[0][0], tuple(align(list(left[0][1]), list(right[0][1])))))
        else:
            if left and right and _unwrapped(left) == _unwrapped(right):
                out.append(_merged_kinds(left, right))
                continue
            for span in (left, right):
                if span:
                    _put(out, span)
    return out


def _unwrapped(span: list) -> list:
    """Keys of a span, of its inside if it is one group."""
    if len(span) == 1 and not isinstance(span[0], str) and span[0][0] != "#":
        return [_key(x) for x in span[0][1]]
    return [_key(x) for x in span]


def _merged_kinds(left: list, right: list):
    """One group for spans that differ in being bare, repeated or optional only."""
    kinds, insides = set(), []
    for span in (left, right):
        if len(span) == 1 and not isinstance(span[0], str) and span[0][0] != "#":
            kinds.add(span[0][0])
            insides.append(span[0][1])
        else:
            insides.append(span)
    inside = tuple(_same_shape(x, y) for x, y in zip(*insides, strict=True))
    if kinds == {"+", "?"}:
        return ("?", (("+", inside),))
    return (kinds.pop(), inside)


def _size(items) -> int:
    return sum(1 if isinstance(x, str) or x[0] == "#" else 1 + _size(x[1]) for x in items)


def as_regex(items) -> str:
    """The wrapper as a regular expression over the concatenated tokens of a page."""
    out = []
    for x in items:
        if isinstance(x, str):
            out.append(re.escape(x))
        elif x[0] == "#":
            out.append("\\#")
        else:
            out.append(f"(?:{as_regex(x[1])}){x[0]}")
    return "".join(out)


def constants(items) -> list[str]:
    """Fingerprints of the texts that a wrapper holds constant."""
    out = []
    for x in items:
        if not isinstance(x, str):
            out += ([x[1]] if x[1] else []) if x[0] == "#" else constants(x[1])
    return out


def slots(items) -> int:
    return sum(0 if isinstance(x, str) else x[1] is None if x[0] == "#" else slots(x[1]) for x in items)


def _load(text: str) -> list:
    def back(x):
        if isinstance(x, str):
            return x
        return ("#", x[1]) if x[0] == "#" else (x[0], tuple(back(y) for y in x[1]))

    return [back(x) for x in json.loads(text)]


def _together(a: list, b: list) -> list | None:
    """The wrapper of two, or None where it is much larger than either."""
    merged = align(a, b)
    return merged if _size(merged) <= max(MOST_ITEMS, 5 * max(_size(a), _size(b)) // 4) else None


def _merge(a: str | None, b: str | None) -> str | None:
    """Two wrappers as text; None if they are layouts of their own."""
    if a is None or b is None:
        return None
    if a == b:
        return a
    merged = _together(_load(a), _load(b))
    return None if merged is None else json.dumps(merged)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1), F.lit("")))


_WRAPPER = "host string, salt long, pages long, wrapper string"
_READ = f"{_WRAPPER}, path long, text string"  # a wrapper, or the pages that hold a text at a path


def _batch_wrappers(pages: DataFrame) -> DataFrame:
    """A wrapper per host, layout and Arrow batch, and the pages of the batch that hold a
    text at a path."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[str, dict[object, tuple[int, list]]] = {}
            found: Counter[tuple[str, int, str]] = Counter()
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                tokens, texts = read_page(page.as_py())
                items = _expression(tokens, texts)
                found.update([(host, path, text) for path, text in page_texts(texts)] if host else [])
                shapes = held.setdefault(host, {})
                key = tuple(_key(x) for x in items)
                n, seen = shapes.get(key, (0, items))
                shapes[key] = (n + 1, items if not n else [_same_shape(x, y) for x, y in zip(seen, items, strict=True)])
            hosts, counts, wrappers = [], [], []
            for host, shapes in held.items():
                layouts: list[tuple[int, list]] = []
                for n, items in sorted(shapes.values(), key=lambda x: (-x[0], json.dumps(x[1]))):
                    for k, (m, out) in enumerate(layouts):
                        if (merged := _together(out, items)) is not None:
                            layouts[k] = (m + n, merged)
                            break
                    else:
                        layouts.append((n, items))
                hosts += [host] * len(layouts)
                counts += [n for n, _ in layouts]
                wrappers += [json.dumps(w) for _, w in layouts]
            salts = [xxhash.xxh32_intdigest(f"{batch.num_rows} {w}") % SALTS for w in wrappers]
            none = [None] * len(hosts)
            more = [None] * len(found)
            columns = (
                (hosts + [h for h, _, _ in found], pa.string()),
                (salts + more, pa.int64()),
                (counts + list(found.values()), pa.int64()),
                (wrappers + more, pa.string()),
                (none + [path - (1 << 63) for _, path, _ in found], pa.int64()),
                (none + [text for _, _, text in found], pa.string()),
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in columns], names=["host", "salt", "pages", "wrapper", "path", "text"]
            )

    return pages.select("host", "page").mapInArrow(run, _READ)


def _folded(wrappers: DataFrame, keys: list[str]) -> DataFrame:
    """Aligns the wrappers of each key, one after another, with the first layout they fit."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list[tuple] = []  # the layouts of a key
        done: list[tuple] = []

        def flush(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["host", "salt", "pages", "wrapper"]
            )

        for batch in batches:
            for host, salt, n, w in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now and now[0][:2] != (host, salt):
                    done += now
                    now = []
                for k, (*_, m, held) in enumerate(now):
                    if (merged := _merge(held, w)) is not None:
                        now[k] = (host, salt, m + n, merged)
                        break
                else:
                    now.append((host, salt, n, w))
            if len(done) > 512:
                yield flush(done)
                done = []
        yield flush(done + now)

    salt = F.col("salt") if "salt" in keys else F.lit(0).cast("long").alias("salt")
    rows = wrappers.select("host", salt, "pages", "wrapper").repartition(*keys).sortWithinPartitions("host", "salt", F.desc("pages"), "wrapper")
    return rows.mapInArrow(run, _WRAPPER)


def _read(pages: DataFrame, url: str, page: str) -> DataFrame:
    read = pages.select(host_of(F.col(url)).alias("host"), F.coalesce(F.col(page), F.lit("")).alias("page"))
    return written(_batch_wrappers(read), "html-batch-wrappers")


def _host_wrappers(read: DataFrame) -> DataFrame:
    """``host, pages, wrapper``: a row for each layout of a host."""
    some = read.filter("text is null")
    folded = _folded(written(_folded(some, ["host", "salt"]), "html-salted-wrappers"), ["host"])
    return folded.select("host", "pages", "wrapper")


def host_wrappers(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """``host, pages, wrapper`` (JSON; null where a host has several layouts, which have no common form)."""
    wrapper = F.when(F.count(F.lit(1)) == 1, F.max("wrapper")).alias("wrapper")
    return _host_wrappers(_read(pages, url, page)).groupBy("host").agg(F.sum("pages").alias("pages"), wrapper)


def _templates(read: DataFrame) -> DataFrame:
    """``host, template``: constant texts of hosts with enough pages that stand at one
    path on ``LEAST_PAGES`` of them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wrappers = [_load(w) for w in batch.column(1).to_pylist()]
            found, slotted = [sorted(set(constants(w))) for w in wrappers], [slots(w) > 0 for w in wrappers]
            columns = [batch.column(0), pa.array(found, pa.list_(pa.string())), pa.array(slotted, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "texts", "slotted"])

    wrappers = written(_host_wrappers(read).filter(F.col("host") != ""), "html-wrappers")
    hosts = wrappers.groupBy("host").agg(F.sum("pages").alias("of"), F.count(F.lit(1)).alias("layouts")).filter(F.col("of") >= LEAST_PAGES)
    constant = wrappers.select("host", "wrapper").mapInArrow(run, "host string, texts array<string>, slotted boolean")
    # Without a slot the pages of the one wrapper are copies of one page, not of a template.
    constant = constant.join(hosts.select("host", "layouts"), "host").filter("slotted or layouts > 1")
    constant = constant.select("host", "layouts", F.explode("texts").alias("text")).distinct()
    counts = read.filter("text is not null").groupBy("host", "path", "text").agg(F.sum("pages").alias("n"))
    counts = written(counts.filter(F.col("n") >= LEAST_PAGES), "html-texts")
    common = counts.filter("text <> ''")
    # What one layout holds constant is seldom contradicted by pages of the others.
    paths = counts.filter("text = ''").select("host", "path", F.col("n").alias("of"))
    held = common.join(paths, ["host", "path"]).groupBy("host", "text").agg(F.max(2 * F.col("n") > F.col("of")).alias("usual"))
    both = constant.join(held, ["host", "text"]).filter("layouts = 1 or usual")
    return both.groupBy("host").agg(F.sort_array(F.collect_set("text")).alias("template"))


def extract(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """``row`` (all columns but the page) and ``text``."""
    templates = written(_templates(_read(pages, url, page)), "html-templates")
    others = F.struct(*[F.col(f"`{c}`") for c in pages.columns if c != page])
    rows = pages.select(others.alias("row"), host_of(F.col(url)).alias("host"), F.coalesce(F.col(page), F.lit("")).alias("page"))
    joined = rows.join(templates.hint("merge"), "host", "left").select("row", "page", "template")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                out = [
                    main_text(p.as_py(), frozenset(t.as_py() or ())) for p, t in zip(part.column(1), part.column(2), strict=True)
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.string())], names=["row", "text"])

    return joined.mapInArrow(run, f"row {joined.schema['row'].dataType.simpleString()}, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))
