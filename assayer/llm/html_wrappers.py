"""Main text of HTML pages by wrappers inferred for each host.

Each page's stream of block tags and text slots is folded: a group that follows itself becomes
a repeated group. Equal streams of a host are counted before any is moved; the rest are
aligned one after the other, and where two differ, what only one has becomes an
optional group and differing repetitions a repeated one, never a choice between
alternatives. The result is the host's wrapper, a union-free regular expression. The
containers in it that hold text slots outside menus, forms and the like, in the order of how
much they hold, say where a page of that host has its main text.

Streams are aligned as they arrive, in salted groups first, so a host with a third of all
pages neither lands in one task nor has to be held; a wrapper is as long as a page's stream.

Defined results: a null or empty page has empty text; a page without a body, or cut off, is
read as far as it goes; pages with a null or odd address form one host; repeated rows get
equal rows; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import Batches, annotate, arrow_schema, in_rows

# The elements of HTML by their role here.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr audio button canvas embed "
    "iframe img input link map meta noscript object script select style svg template textarea "
    "video".split()
)
_RAW = frozenset("script style textarea title noscript template iframe xmp".split())
_NOISE_TAGS = frozenset(
    "head nav footer aside form script style noscript template iframe svg button select "
    "textarea title dialog menu object canvas audio video xmp".split()
)
_NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notices sidebar menu nav navbar navigation breadcrumb "
    "breadcrumbs footer comment comments respond disqus share sharing social related "
    "newsletter subscribe popup modal toolbar pagination pager skip".split()
)
_NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert menu menubar".split()
)
_MAIN_WORDS = frozenset("article content main post entry story".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[a-z]+")
# Decimal references with leading zeros, and those beyond all characters.
_ZEROS = re.compile(r"&#0+(?=[0-9])")
_BEYOND = re.compile(r"&#[0-9]{8,};?")
#: Class names that say what an element has or lacks, not what it is.
_MODIFIER = re.compile(r"(?:has|have|no|not|with|without|hide|show)[-_]")

#: Longest group of tokens that is folded, and how many parts a host's pages are dealt into.
LONGEST_GROUP = 16
SALTS = 16
#: Most bytes of wrappers that are broadcast; more are joined by shuffling.
BROADCAST_BYTES = 8 << 20

Event = tuple[str, str, str]


def events(page: str) -> Iterator[Event]:
    """``(kind, name, text or attributes)``; kind is ``open``, ``close`` or ``text``."""
    at = 0
    while at < len(page):
        m = _TOKEN.search(page, at)
        if not m:
            yield "text", "", page[at:]
            return
        if m.start() > at:
            yield "text", "", page[at : m.start()]
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue  # a comment or a declaration
        if m[1] or m[4]:
            yield "close", name, ""
            continue
        yield "open", name, m[3] or m[6] or ""
        if name in _RAW:
            end = re.compile(f"</{name}", re.IGNORECASE).search(page, at)
            at = end.start() if end else len(page)


def _labels(attributes: str) -> tuple[frozenset[str], str]:
    """Words of the class and id, and the role."""
    if "=" not in attributes:
        return frozenset(), ""
    words, role = set(), ""
    for key, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        if key.lower() == "role":
            role = value.strip()
        else:
            for one in value.split():
                if not _MODIFIER.match(one):
                    words |= set(_WORDS.findall(one))
    return frozenset(words), role


def _noise_by_words(name: str, words: frozenset[str]) -> bool:
    return name not in ("html", "body", "article", "main") and bool(words & _NOISE_WORDS)


def _symbol(name: str, words: frozenset[str], role: str, in_main: bool, spared: bool) -> str:
    """How an element counts: ``!`` for noise, ``*`` for the main part, else its name and, for
    what may contain the main part, its words. Words make no noise of a ``spared`` one."""
    if name in ("html", "body"):
        return name
    noise = name in _NOISE_TAGS or (name == "header" and not in_main)
    if name not in ("article", "main"):
        noise |= (_noise_by_words(name, words) and not spared) or role in _NOISE_ROLES
    if noise:
        return "!" + name
    if name in ("article", "main") or role == "main":
        return "*" + name
    if name in ("div", "section", "td") and words & _MAIN_WORDS:
        return name + "." + ".".join(sorted(words))
    return name


class Walk:
    """Reads a page with the stack of its open elements."""

    def __init__(self, spared: frozenset[int] | None = None) -> None:
        """``spared``: which opened elements, by number, are no noise by their words (all)."""
        self.spared = spared
        self.opened = 0
        self.stack: list[tuple[str, str]] = []
        self.noise = 0
        self.main = 0

    def open(self, name: str, attributes: str) -> str:
        words, role = _labels(attributes)
        spared = self.spared is None or self.opened in self.spared
        self.opened += 1
        symbol = _symbol(name, words, role, self.main > 0, spared)
        if name not in _VOID and not attributes.endswith("/"):
            self.stack.append((name, symbol))
            self._count(symbol, 1)
        return symbol

    def close(self, name: str) -> list[str]:
        """The symbols of the elements that end: up to the last open one of that name."""
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == name:
                ended = [s for _, s in self.stack[i:]]
                del self.stack[i:]
                for symbol in ended:
                    self._count(symbol, -1)
                return ended
        return []

    def _count(self, symbol: str, by: int) -> None:
        self.noise += by * symbol.startswith("!")
        self.main += by * symbol.startswith("*")


def _is_main(symbol: str) -> bool:
    return symbol.startswith("*") or "." in symbol


def spared(found: list[Event]) -> frozenset[int]:
    """The numbers of elements that are noise by their words, but around the main text: no
    container outside such elements has text, and they hold most of the page's text or its
    only marked main part."""
    walk, total, marked, held = Walk(), 0, 0, {}
    above: list[int | None] = []
    around: set[int] = set()
    mains: list[bool] = []
    for kind, name, value in found:
        if kind == "text":
            if walk.noise or not value.strip():
                continue
            outer = [i for i in above if i is not None]
            if not outer and any(mains):
                return frozenset()
            total += len(value.strip())
            for i in outer:
                held[i] += len(value.strip())
        elif kind == "open":
            depth, number = len(walk.stack), walk.opened
            symbol = walk.open(name, value)
            if len(walk.stack) > depth:
                noisy = _noise_by_words(name, _labels(value)[0])
                above.append(number if noisy else None)
                mains.append(_is_main(symbol))
                if noisy:
                    held[number] = 0
                if symbol.startswith("*") and not walk.noise and walk.main == 1:
                    marked += 1
                    around |= {i for i in above if i is not None}
        else:
            walk.close(name)
            del above[len(walk.stack) :], mains[len(walk.stack) :]
    return frozenset(i for i, n in held.items() if 2 * n > total or (marked == 1 and i in around))


def stream(page: str) -> list[str]:
    """Block elements and text slots of a page, noise elements as one token each."""
    found = list(events(page))
    walk, out = Walk(spared(found)), []
    for kind, name, value in found:
        if kind == "text":
            if not walk.noise and value.strip() and (not out or out[-1] != "#"):
                out.append("#")
        elif kind == "open":
            noisy = walk.noise
            symbol = walk.open(name, value)
            if not noisy and name not in _INLINE and name not in _VOID:
                out.append(symbol)
        else:
            before = walk.noise
            ended = walk.close(name)
            if name not in _INLINE and ended and not before:
                out.append("/" + ended[0].lstrip("!"))
    return out


def fold(tokens: list) -> list:
    """The sequence with every group that follows itself as one repeated group."""
    size = 1
    while size <= min(LONGEST_GROUP, len(tokens) // 2):
        out, i, changed = [], 0, False
        while i < len(tokens):
            unit = tokens[i : i + size]
            j = i + size
            while len(unit) == size and tokens[j : j + size] == unit:
                j += size
            if j > i + size and not (size == 1 and isinstance(unit[0], tuple)):
                out.append(("+", tuple(unit)))
                i, changed = j, True
            else:
                out.append(tokens[i])
                i += 1
        tokens = out
        size = 1 if changed and size > 1 else size + 1
    return tokens


def _bare(item: object) -> object:
    return _bare(item[1][0]) if _is(item, "?") and len(item[1]) == 1 else item


def _is(item: object, kind: str) -> bool:
    return isinstance(item, tuple) and item[0] == kind


def _repeat_at(items: list, unit: tuple) -> int:
    """How many items from the start are copies of ``unit``."""
    n = 0
    while tuple(items[n : n + len(unit)]) == unit:
        n += len(unit)
    return n


def _resolve(left: list, right: list) -> list:
    """A mismatch: repetitions of the same group become one, all else optional groups."""
    for a, b in ((left, right), (right, left)):
        for i, item in enumerate(a):
            if _is(item, "+"):
                for j in range(len(b)):
                    n = _repeat_at(b[j:], item[1])
                    if n:
                        return [
                            *align(a[:i], b[:j]), item, *align(a[i + 1 :], b[j + n :])
                        ]
    return [item if _is(item, "?") else ("?", (item,)) for item in [*left, *right]]


def align(left: list, right: list) -> list:
    """The least general sequence of this kind that matches what either matches."""
    if left == right:
        return left
    keys = [[_bare(x) for x in side] for side in (left, right)]
    out: list = []
    match = SequenceMatcher(a=[repr(k) for k in keys[0]], b=[repr(k) for k in keys[1]], autojunk=False)
    for op, a0, a1, b0, b1 in match.get_opcodes():
        if op == "equal":
            out += [
                x if _is(x, "?") else y if _is(y, "?") else x
                for x, y in zip(left[a0:a1], right[b0:b1])
            ]
        elif op == "replace":
            out += _resolve(left[a0:a1], right[b0:b1])
        else:
            out += _resolve(left[a0:a1] + right[b0:b1], [])
    return out


def as_text(wrapper: list) -> str:
    return json.dumps(wrapper)


def from_text(text: str) -> list:
    def tuples(item: object) -> object:
        if isinstance(item, list):
            return (item[0], tuple(tuples(x) for x in item[1]))
        return item

    return [tuples(x) for x in json.loads(text)]


def expression(wrapper: list) -> str:
    """The wrapper as a regular expression over tags, for people to read."""

    def show(item: object) -> str:
        if isinstance(item, tuple):
            return "(" + " ".join(map(show, item[1])) + ")" + item[0]
        return "#text" if item == "#" else f"<{item}>"

    return " ".join(map(show, wrapper))


def containers(wrapper: list) -> list[str]:
    """Symbols of elements that directly or indirectly hold text slots outside noise, in the
    order to look for the main text: marked main parts, then others by how much they hold."""
    held: dict[str, int] = {}
    stack: list[str] = []

    def visit(items: tuple | list, weight: int) -> None:
        for item in items:
            if isinstance(item, tuple):
                visit(item[1], weight * (4 if item[0] == "+" else 1))
            elif item == "#":
                for symbol in set(stack):
                    held[symbol] = held.get(symbol, 0) + weight
            elif item.startswith("/"):
                name = item[1:]
                if name in stack:
                    del stack[len(stack) - 1 - stack[::-1].index(name) :]
            else:
                stack.append(item)

    visit(wrapper, 1)
    known = [s for s in held if s.startswith("*") or "." in s]
    return sorted(known, key=lambda s: (not s.startswith("*"), -held[s], s)) + ["body"]


def _decoded(text: str) -> str:
    """The text with its character references decoded; numbers beyond all characters, however
    long, give the replacement character."""
    if "&#" in text:
        text = _BEYOND.sub("\ufffd", _ZEROS.sub("&#", text))
    return html.unescape(text)


def main_text(page: str, roots: list[str]) -> str:
    """Text of all outermost main containers among the ``roots``, in page order, else of the
    body, else of the whole page, without noise; blocks and white space are parted by one
    space. A container that only its words mark gives way to marked main parts inside it."""
    found = list(events(page))
    walk = Walk(spared(found))
    known = {root for root in roots if _is_main(root)}
    # Pieces of text with whether a marked part or the body is open and the other open
    # containers; the containers with a marked part inside.
    pieces: list[tuple[str, bool, bool, tuple[int, ...]]] = []
    above: list[int] = []
    wide: set[int] = set()
    for number, (kind, name, value) in enumerate(found):
        if kind == "text":
            if not walk.noise:
                symbols = [symbol for _, symbol in walk.stack]
                marked = any(s in known and s.startswith("*") for s in symbols)
                open_now = tuple(i for i in above if i >= 0)
                pieces.append((_decoded(value), marked, "body" in symbols, open_now))
                if marked and value.strip():
                    wide.update(open_now)
            continue
        if kind == "open":
            before = len(walk.stack)
            symbol = walk.open(name, value)
            if len(walk.stack) > before:
                other = symbol in known and not symbol.startswith("*")
                above.append(number if other and not walk.main else -1)
        else:
            walk.close(name)
            del above[len(walk.stack) :]
        if name not in _INLINE and pieces and pieces[-1][0] != " ":
            pieces.append((" ", True, True, ()))
    chosen = (
        lambda piece: piece[1] or any(i not in wide for i in piece[3]),
        lambda piece: piece[2],
        lambda piece: True,
    )
    for choose in chosen:
        text = " ".join("".join(piece[0] for piece in pieces if choose(piece)).split())
        if text:
            return text
    return ""


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def _aligned(streams: DataFrame, keys: list[str]) -> DataFrame:
    """The wrapper of each group of streams with the same keys, aligned as they arrive."""
    schema = ", ".join(f"{k} {dict(streams.dtypes)[k]}" for k in keys) + ", wrapper string"
    target = arrow_schema(schema)

    def wrappers(batches: Batches) -> Iterator[dict]:
        now, wrapper = None, []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(len(keys) + 1)]
            for *key, text in zip(*columns):
                if now is not None and key != now:
                    yield {**dict(zip(keys, now)), "wrapper": as_text(wrapper)}
                own = from_text(text)
                wrapper = own if key != now else fold(align(wrapper, own))
                now = key
        if now is not None:
            yield {**dict(zip(keys, now)), "wrapper": as_text(wrapper)}

    ordered = (
        streams.select(*keys, "wrapper")
        .repartition(*[F.col(k) for k in keys])
        .sortWithinPartitions(*keys, F.length("wrapper").desc(), "wrapper")
    )
    return ordered.mapInArrow(lambda batches: in_rows(wrappers(batches), target), schema)


def infer_wrappers(
    pages: DataFrame, url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``host, wrapper``: one union-free expression per host, from all its pages."""

    def make() -> Callable[[bytes], dict]:
        return lambda page: {"wrapper": as_text(fold(stream(page.decode("utf-8", "replace"))))}

    whole = pages.select(
        host_of(F.col(f"`{url_col}`")).alias("host"), F.col(f"`{html_col}`").alias("html")
    )
    streams = annotate(whole, "html", make, "wrapper string", ["host"]).distinct()
    salted = streams.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)).cast("int"))
    return _aligned(_aligned(salted, ["host", "salt"]), ["host"])


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``id, url, text``: the main text of every page."""
    wrappers = written(infer_wrappers(pages, url_col, html_col), "wrappers")

    def roots() -> Callable[[bytes], dict]:
        return lambda text: {"roots": containers(from_text(text.decode()))}

    found = annotate(wrappers, "wrapper", roots, "roots array<string>", ["host"])
    size = wrappers.agg(F.sum(F.length("wrapper") + F.length("host"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        found = F.broadcast(found)
    whole = pages.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{url_col}`").alias("url"),
        F.col(f"`{html_col}`").alias("html"),
        host_of(F.col(f"`{url_col}`")).alias("host"),
    )
    located = whole.join(found, "host", "left").select("id", "url", "html", "roots")
    schema = ", ".join(f"{n} {t}" for n, t in located.dtypes if n in ("id", "url")) + ", text string"
    target = arrow_schema(schema)

    def run(batches: Batches) -> Batches:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for key, url, page, own in zip(*[c.to_pylist() for c in batch.columns]):
                    yield {"id": key, "url": url, "text": main_text(page or "", own or ["body"])}

        return in_rows(rows(), target)

    return located.mapInArrow(run, schema)
