"""HTML extraction by union-free regular-expression inference.

Each page's tokens form nested streams. The streams of a host's pages are aligned one after another into a wrapper:
a union-free expression of elements that are required, optional (`?`) or repeated (`+`), with text slots that are
either one fixed text or differ. Where two streams do not match, the items before the next match become optional;
neighbours that are alike become one repeated item; texts that differ become a slot.

Tasks build wrappers of the pages at hand, and wrappers are aligned with wrappers in levels of a bounded fan-in, so no
task sees all pages of a host. Copies of a page count once for a host, as they say nothing of what its pages share.
A wrapper holds all that its pages have, rare items too, so its size follows what is distinct in them; wrappers of about as
many pages are aligned, so that time follows size. A role reaches the pages of a host once for each of their parts.

The wrapper decides by what it shows, however many pages it is of: text that differs from page to page is the evidence, so
one page alone has none. The main text is in the region with most of the differing text and most of all text, links aside:
the innermost container that is not repeated and has over half of both. Fixed text inside the region stays. Where there is
no such container, containers of fixed text alone before the first and after the last text that differs are left out. Names of elements break
ties: they widen the region to an article around it, choose it where the wrapper shows nothing or a page lacks its region,
and mark menus, asides, forms and the like, which are left out anywhere. A word in a class, an id or a role marks an element
only if the wrapper agrees: never html, body, article or main, nor what holds over half of all text (readers' comments only
if an article is inside). Where nothing marks an article, lists of links are dropped too. Each page is read by its host's
region and slots, which are all that is sent to the pages; where a drop leaves nothing, it is not done.

Null and empty pages have an empty text. Pages without a host share one wrapper. Rows that repeat are read alike, and
an empty table gives an empty result. Whole pages are read, broken or unclosed elements included, in linear time and
without recursion. An input column named as the text is replaced; others pass unchanged.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
import zlib
from collections import Counter
from collections.abc import Generator, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linemart.llm.shared import renamed, restored
from linemart.llm.url_filter import host_of

START = re.compile(r"<(?:/?[a-zA-Z]|[!?])")
#: A quote that is closed later is a string as a whole, and only another one stands alone: one way to read each tag.
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>|<[!?][^>]*+(?:>|$)", re.S)
#: Where all that closes a tag is in strings, its strings do not count; nor do those of any tag after so many such tags in a page.
PLAIN = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+(?:>|$)", re.S)
MOST_PLAIN = 64
ATTRIBUTE = re.compile(r"(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
#: Without one of these, attributes say nothing here.
TELLING = re.compile("id|class|role|itemprop|style", re.I)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe xmp noembed noframes svg math".split())
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
#: What an opening element closes, and where the search for it stops.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
CLOSES_P = BLOCKS - {"body", "html", "dd", "dt", "li", "tr", "td", "th", "tbody", "thead", "tfoot", "option", "title", "summary"}
#: Elements and words of classes, ids and roles that mark what is not main text, and what marks it.
DROP_ELEMENTS = set("nav aside form script style noscript template iframe svg math button select input textarea head title object canvas audio video dialog menu".split())
EDGE_ELEMENTS = {"header", "footer"}
DROP_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted promotion nav navbar navigation menu menus breadcrumb breadcrumbs "
    "sidebar aside widget widgets masthead comment comments discussion disqus reply replies respond share sharing social related recommended "
    "newsletter subscribe subscription signup cookie cookies consent gdpr notice notices alert popup modal overlay toolbar pagination pager "
    "copyright login search form banner contentinfo complementary".split()
)
EDGE_WORDS = {"header", "footer", "topbar"}
COMMENT_WORDS = set("comment comments discussion disqus reply replies respond".split())
#: Elements that may be the region, and those that no word marks.
CONTAINERS, LISTS, UNMARKED = set("div section article main td center".split()), set("ul ol dl table".split()), set("html body article main".split())
MAIN_WORDS = set("article content main post entry story text body articlebody".split())
FAN_IN = 64
#: Parts of each host's pages, and items of pages in a task after which it passes its wrappers on.
SPREAD, HELD_ITEMS = 16, 1_000_000
#: Pages from which on `without_rare` leaves items out.
LARGE = 256


@dataclass(slots=True)
class Item:
    """An element of a page or of a wrapper."""

    sig: str
    kids: list = field(default_factory=list)
    optional: bool = False
    repeated: bool = False
    pages: int = 1
    chars: int = 0  # of text inside, links included
    linked: int = 0  # of it in links
    fixed: int | None = None  # checksum of its own text if that never differed
    own: int = 0  # characters of its own text outside links

    def packed(self) -> list:
        """This and all inside in order of the page, each with the number of its kids."""
        out, left = [], [self]
        while left:
            x = left.pop()
            out.append([x.sig, int(x.optional), int(x.repeated), x.pages, x.chars, x.linked, x.fixed, x.own, len(x.kids)])
            left.extend(reversed(x.kids))
        return out

    @staticmethod
    def unpacked(rows: list) -> Item:
        top = Item("")
        open_items = [(top, 1)]
        for x in rows:
            while len(open_items[-1][0].kids) == open_items[-1][1]:
                open_items.pop()
            made = Item(x[0], [], bool(x[1]), bool(x[2]), *x[3:8])
            open_items[-1][0].kids.append(made)
            open_items.append((made, x[8]))
        return top.kids[0]


def stepped(work: Generator) -> Any:
    """The result of a generator that yields generators for their results: by a stack, so any depth will do."""
    stack, value = [work], None
    while stack:
        try:
            more = stack[-1].send(value)
        except StopIteration as end:
            stack.pop()
            value = end.value
        else:
            stack.append(more)
            value = None
    return value


def tokens(page: str) -> Generator[re.Match, int, None]:
    """Each token; the next search begins where the caller sends."""
    last, plain, at = page.rfind(">"), 0, 0
    while m := START.search(page, at):
        k = m.start()
        found = None
        if k < last or page[k + 1] in "!?":
            found = TOKEN.match(page, k) if plain < MOST_PLAIN else PLAIN.match(page, k)
            if not found:
                plain += 1
                found = PLAIN.match(page, k)
        if found:
            at = yield found
        else:
            at = k + 1


def signature(tag: str, attributes: str) -> str:
    """Element, id, classes and role; numbers in them do not count."""
    if not attributes or not TELLING.search(attributes):
        return tag
    found = {m[1].lower(): next((g for g in m.groups()[1:] if g is not None), "") for m in ATTRIBUTE.finditer(attributes)}
    words = " ".join(found.get(k, "") for k in ("id", "class", "role", "itemprop")).split()
    gone = re.search(r"(?:^|\s)hidden(?:\s|/|$)", attributes) or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", ""))
    return " ".join([tag, *(["!"] if gone else []), *(re.sub(r"\d+", "0", w) for w in words)])


def walk(page: str) -> Iterator[tuple[str, str]]:
    """("open", signature), ("close", ""), ("void", tag) and ("text", raw): balanced, with what html leaves out."""
    stack: list[str] = []
    held: Counter[str] = Counter()  # how often each is in the stack
    at, low = 0, None

    def close_to(k: int) -> Iterator[tuple[str, str]]:
        while len(stack) > k:
            held[stack.pop()] -= 1
            yield "close", ""

    def last(tag: str) -> int:
        return next(k for k in range(len(stack) - 1, -1, -1) if stack[k] == tag)

    found, begun = tokens(page), False

    def following() -> re.Match | None:
        nonlocal begun
        try:
            return found.send(at if begun else None)
        except StopIteration:
            return None
        finally:
            begun = True

    for m in iter(following, None):
        if m.start() > at:
            yield "text", page[at : m.start()]
        at = max(m.end(), at + 1)
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if held[tag]:
                yield from close_to(last(tag))
            continue
        if tag in VOID:
            yield "void", tag
            continue
        if tag in CLOSES_P and held["p"]:
            yield from close_to(last("p"))
        if tag in CLOSES and any(held[x] for x in CLOSES[tag][0]):
            ends, stops = CLOSES[tag]
            for k in range(len(stack) - 1, -1, -1):
                if stack[k] in stops:
                    break
                if stack[k] in ends:
                    yield from close_to(k)
                    if tag != "tr" or stack[-1:] != ["tr"]:
                        break
        if m[3].endswith("/") and tag in ("svg", "math"):
            continue
        yield "open", signature(tag, m[3])
        if tag in RAW:
            low = page.lower() if low is None else low
            end = low.find(f"</{tag}", at)
            if end < 0 or len(low) != len(page):
                again = re.compile(f"</{tag}", re.I).search(page, at)
                end = again.start() if again else len(page)
            if tag == "title":
                yield "text", page[at:end]
            at = end
            if end < len(page):
                at = (page.find(">", end) + 1) or len(page)
            yield "close", ""
            continue
        stack.append(tag)
        held[tag] += 1
    if at < len(page):
        yield "text", page[at:]
    yield from close_to(0)


def page_items(page: str) -> Item:
    """A page as a wrapper of itself: its elements, neighbours that are alike folded."""
    root = Item("")
    stack, linked = [root], 0
    for kind, x in walk(page):
        top = stack[-1]
        if kind == "open":
            made = Item(x)
            top.kids.append(made)
            stack.append(made)
            linked += x.split(" ", 1)[0] == "a"
        elif kind == "close":
            linked -= top.sig.split(" ", 1)[0] == "a"
            top.kids = fold(top.kids)
            stack.pop()
            stack[-1].chars += top.chars
            stack[-1].linked += top.linked
        elif kind == "text" and (t := x.strip()):
            top.fixed = zlib.crc32(t.encode("utf-8", "replace"), top.fixed or 0)
            top.chars += len(t)
            top.linked += len(t) * (linked > 0)
            top.own += len(t) * (linked == 0)
    root.kids = fold(root.kids)
    return root


def fold(kids: list[Item]) -> list[Item]:
    """Neighbours of one signature, alone or in groups of two or three, become repeated items."""
    return stepped(_fold(kids)) if len(kids) > 1 else kids


def joined(a: Item, b: Item) -> Item:
    """The wrapper of both: of one signature, their contents aligned."""
    return stepped(_joined(a, b))


def pushed(stack: list[Item], item: Item) -> None:
    """Puts an item on a stack of wrappers, each of more pages than the next: those of about as many are joined, so that a large one is not read again for each page."""
    stack.append(item)
    while len(stack) > 1 and stack[-1].pages >= stack[-2].pages:
        b = stack.pop()
        stack[-1] = joined(stack[-1], b)


def joined_up(stack: list[Item]) -> Item:
    """The wrapper of all on a stack."""
    while len(stack) > 1:
        b = stack.pop()
        stack[-1] = joined(stack[-1], b)
    return stack[0]


def _fold(kids: list[Item]) -> Generator:
    out: list[Item] = []
    for k in kids:
        out.append(k)
        for size in (1, 2, 3):
            if len(out) >= 2 * size and all(a.sig == b.sig for a, b in zip(out[-2 * size : -size], out[-size:], strict=True)):
                again = out[-size:]
                del out[-size:]
                for i in range(size):
                    pages = max(out[i - size].pages, again[i].pages)
                    out[i - size] = yield _joined(out[i - size], again[i])
                    out[i - size].repeated, out[i - size].pages = True, pages
                break
    return out


def _joined(a: Item, b: Item) -> Generator:
    kids = (yield _align(a.kids, b.kids)) if a.kids or b.kids else []
    return Item(
        a.sig, kids, a.optional or b.optional, a.repeated or b.repeated, a.pages + b.pages,
        a.chars + b.chars, a.linked + b.linked, a.fixed if a.fixed == b.fixed else -1, a.own + b.own,
    )


def _align(a: list[Item], b: list[Item]) -> Generator:
    """One stream from two. At a mismatch the nearer next match of either side is taken; what it skips is optional."""
    out: list[Item] = []
    i = j = 0
    where: list[dict[str, list[int]]] = [{}, {}]
    for side, items in zip(where, (a, b), strict=True):
        for k in range(len(items) - 1, -1, -1):
            side.setdefault(items[k].sig, []).append(k)  # the last first, so that the next one is at the end

    def after(side: dict[str, list[int]], sig: str, k: int) -> int | None:
        left = side.get(sig, [])
        while left and left[-1] < k:
            left.pop()
        return left[-1] if left else None

    def skip(x: Item) -> None:
        x.optional = True
        out.append(x)

    while i < len(a) and j < len(b):
        if a[i].sig == b[j].sig:
            out.append((yield _joined(a[i], b[j])))
            i, j = i + 1, j + 1
            continue
        in_b, in_a = after(where[1], a[i].sig, j), after(where[0], b[j].sig, i)
        if in_b is not None and (in_a is None or in_b - j <= in_a - i):
            while j < in_b:
                skip(b[j])
                j += 1
        elif in_a is not None:
            while i < in_a:
                skip(a[i])
                i += 1
        else:
            skip(a[i])
            skip(b[j])
            i, j = i + 1, j + 1
    for x in [*a[i:], *b[j:]]:
        skip(x)
    return (yield _fold(out))


def words_of(sig: str) -> set[str]:
    names = " ".join(sig.split(" ")[1:])
    return set(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", names).lower()))


def unwanted(sig: str, inside: bool) -> str:
    """Why an element is none of the main text by itself: "element", "word" or nothing. Headers inside an article are part of it."""
    tag = sig.split(" ", 1)[0]
    if tag in DROP_ELEMENTS or " !" in sig or tag == "footer" or tag == "header" and not inside:
        return "element"
    if tag in UNMARKED or " " not in sig:
        return ""
    words = words_of(sig)
    return "word" if words & DROP_WORDS or "footer" in words or words & EDGE_WORDS and not inside else ""


@lru_cache(1 << 15)
def below(path: bytes, sig: str) -> bytes:
    """The name of a path: one length at any depth."""
    return hashlib.blake2b(path + sig.encode("utf-8", "replace"), digest_size=16).digest()


def without_rare(wrapper: Item) -> Item:
    """The wrapper without items on under a hundredth of its pages, if it has many: a summary to look at. Roles come from whole wrappers."""
    if wrapper.pages >= LARGE:
        left = [wrapper]
        while left:
            x = left.pop()
            x.kids = [k for k in x.kids if k.pages * 100 >= wrapper.pages]
            left.extend(x.kids)
    return wrapper


def spared(wrapper: Item) -> set[bytes]:
    """Paths of elements that a word marks in vain: they hold over half of all text outside links."""
    own: dict[bytes, int] = Counter()
    words: dict[bytes, set[str]] = {}
    articles: set[bytes] = set()
    order: list[tuple[bytes, bytes]] = []
    left: list[tuple[Item, bytes, bool]] = [(wrapper, b"", False)]
    while left:
        x, path, seen = left.pop()
        own[path] += x.own
        for k in x.kids:
            if (why := unwanted(k.sig, seen)) == "element":
                continue
            here, tag = below(path, k.sig), k.sig.split(" ", 1)[0]
            if why:
                words[here] = words_of(k.sig)
            if tag in ("article", "main", "h1"):
                articles.add(here)
            order.append((here, path))
            left.append((k, here, seen or tag in ("article", "main")))
    for here, around in reversed(dict(order).items()):
        own[around] += own[here]
        if here in articles:
            articles.add(around)
    return {h for h, found in words.items() if own[h] * 2 > own[b""] and (h in articles or not found & COMMENT_WORDS)}


def roles(wrapper: Item) -> dict:
    """What to take: `regions`, by preference, as lists of paths, what to leave out of the page where there is none: `drop`, and `links` of lists; `menus` of a region that nothing marks; `spared` from words."""
    whole = spared(wrapper)
    marked: dict[str, list[bytes]] = {"article": [], "main": [], "marked": []}
    slots: dict[bytes, list] = {}  # by path, as an optional item may stand in several places: pages, and texts or None for what is no slot of one text
    links: set[bytes] = set()
    stay: set[bytes] = set()
    mass: dict[bytes, int] = Counter()  # of text that differs, outside links, in all of an element
    bulk: dict[bytes, int] = Counter()  # of all text outside links
    nodes: list[tuple[Item, bytes, bytes]] = []  # in order of the page, with their paths and those around them
    left: list[tuple[Item, bytes, bytes, frozenset[str], bool]] = [(k, below(b"", k.sig), b"", frozenset(), False) for k in reversed(wrapper.kids)]
    bulk[b""] = wrapper.own
    while left:
        k, here, around, seen, dense = left.pop()
        if (why := unwanted(k.sig, bool(seen))) and (why == "element" or here not in whole):
            continue
        tag = k.sig.split(" ", 1)[0]
        words = words_of(k.sig) if " " in k.sig else set()
        kind = "article" if tag == "article" else "main" if tag == "main" or "main" in words and "role" in k.sig else "marked" if words & MAIN_WORDS else None
        nodes.append((k, here, around))
        if tag not in ("html", "body"):
            slot = slots.setdefault(here, [0, set()])
            slot[0] += k.pages
            slot[1].add(None if k.kids or k.fixed in (None, -1) else k.fixed)
        linked = False
        if kind and kind not in seen:
            marked[kind].append(here)
        elif not seen and tag not in ("html", "body"):
            linked = k.chars > 0 and k.linked * 2 > k.chars and (tag in BLOCKS or dense)  # a link inside a sentence stays
            (links if linked else stay).add(here)
        now = seen | ({kind} if kind else set())
        left.extend((x, below(here, x.sig), here, now, linked) for x in reversed(k.kids))
    fixed = {path for path, (pages, texts) in slots.items() if pages * 10 >= wrapper.pages * 9 and len(texts) == 1 and None not in texts}
    differs = []
    for n, (k, here, _) in enumerate(nodes):
        bulk[here] += k.own
        if k.own and here not in fixed and (k.fixed == -1 or k.pages < wrapper.pages or k.repeated):
            mass[here] += k.own
            differs.append(n)
    for here, around in reversed({here: around for _, here, around in nodes}.items()):  # those inside come after
        mass[around] += mass[here]
        bulk[around] += bulk[here]
    tagged = [marked[k] for k in ("article", "main", "marked") if marked[k]]
    told = {"spared": sorted(whole), "links": sorted(links - stay)}
    if wrapper.pages < 2 or not mass[b""]:
        return {"regions": tagged, "drop": [], **told, "menus": []}
    inner: dict[bytes, list[tuple[Item, bytes]]] = {}
    for k, here, around in nodes:
        inner.setdefault(around, []).append((k, here))
    region, way = b"", [b""]
    while best := next(((k, here) for k, here in inner.get(region, []) if not k.repeated and k.sig.split(" ", 1)[0] in CONTAINERS | {"html", "body", "table", "tbody", "tr"} and mass[here] * 2 > mass[b""] and bulk[here] * 2 > bulk[b""]), None):
        if best[1] == region:
            break
        region = best[1]
        way.append(region)
    around = next((p for kind in ("article", "main", "marked") for p in way if p in marked[kind]), None)
    names = {here: k.sig for k, here, _ in nodes}
    if around is None:
        around = next((p for p in reversed(way[1:]) if names[p].split(" ", 1)[0] in CONTAINERS), None)
    regions = ([[around]] if around else []) + [t for t in tagged if t != [around]]
    between = {here for _, here, _ in nodes[differs[0] : differs[-1] + 1]}
    apart: set[bytes] = set()  # in a container without any text that differs
    for k, here, outer in nodes:
        if outer in apart or not mass[here] and k.sig.split(" ", 1)[0] in CONTAINERS | LISTS:
            apart.add(here)
    menus = (links - stay) | {here for k, here, _ in nodes if here in fixed and k.linked * 2 > k.chars}
    return {"regions": regions, "drop": sorted(fixed & apart - between), **told, "menus": sorted(menus) if around and around not in sum(tagged, []) else []}


def main_text(page: str, role: dict) -> str:
    """The main text of one page by its host's wrapper: of the first region with some, or of the page; with what is to drop only if all is."""
    regions = [set(r) for r in role["regions"]]
    drop, links, whole, menus = set(role["drop"]), set(role["links"]), set(role["spared"]), set(role["menus"])
    n = len(regions)
    texts: list[list[str]] = [[] for _ in range(n + 2)]  # of each region, of the page without what is to drop, and of the page
    buffers: list[list[str]] = [[] for _ in texts]
    paths, tags, inside, gone, kept = [b""], [""], [[False] * n], [False], [True]

    def end_block() -> None:
        for text, buffer in zip(texts, buffers, strict=True):
            if buffer:
                if t := " ".join(html.unescape("".join(buffer)).split()):
                    text.append(t)
                buffer.clear()

    for kind, x in walk(page):
        if kind == "open":
            path = below(paths[-1], x)
            now = [i or path in r for i, r in zip(inside[-1], regions, strict=True)]
            why = unwanted(x, any(now))
            paths.append(path), tags.append(x.split(" ", 1)[0]), inside.append(now)
            gone.append(gone[-1] or why == "element" or why == "word" and path not in whole)
            kept.append(kept[-1] and path not in drop and path not in links)
            if tags[-1] in BLOCKS:
                end_block()
        elif kind == "close":
            if tags[-1] in BLOCKS:
                end_block()
            paths.pop(), tags.pop(), inside.pop(), gone.pop(), kept.pop()
        elif kind == "void":
            if x == "hr":
                end_block()
            elif x == "br" and not gone[-1]:
                for buffer in buffers:
                    buffer.append(" ")
        elif not gone[-1]:
            for k in range(n):
                if inside[-1][k] and (k or paths[-1] not in menus):
                    buffers[k].append(x)
            if kept[-1]:
                buffers[n].append(x)
            buffers[-1].append(x)
    end_block()
    return next((" ".join(t) for t in texts if t), "")


def sent(role: dict) -> str:
    return json.dumps({k: [[p.hex() for p in r] for r in v] if k == "regions" else [p.hex() for p in v] for k, v in role.items()}, separators=(",", ":"))


def received(role: str) -> dict:
    return {k: [[bytes.fromhex(p) for p in r] for r in v] if k == "regions" else [bytes.fromhex(p) for p in v] for k, v in json.loads(role).items()}


def host_roles(pages: DataFrame, host_col: str = "host", html_col: str = "html") -> DataFrame:
    """(host, role): what each host's wrapper says of its pages, as JSON of a few paths."""
    own = pages.select(F.col(host_col).alias("host"), F.md5(F.coalesce(F.col(html_col), F.lit("")).cast("binary")).alias("digest"), F.col(html_col).alias("html"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [zlib.compress(json.dumps(page_items(x or "").packed(), separators=(",", ":")).encode()) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([bytes.fromhex(x) for x in b.column(1).to_pylist()], pa.binary()), pa.array(made, pa.binary())], names=["host", "digest", "page"])

    once = own.mapInArrow(parse, "host string, digest binary, page binary").groupBy("host", "digest").agg(F.first("page").alias("page"))
    once = once.select("host", "page", F.spark_partition_id().cast("long").alias("part"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[Item]] = {}
        part = items = 0

        def out() -> pa.RecordBatch:
            rows = [(h, part, json.dumps(joined_up(w).packed())) for h, w in held.items()]
            held.clear()
            cols = list(zip(*rows, strict=True)) or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string()), strict=True)], names=["host", "part", "wrapper"])

        for b in batches:
            for host, page, part in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):  # noqa: B007
                rows = json.loads(zlib.decompress(page))
                pushed(held.setdefault(host, []), Item.unpacked(rows))
                items += len(rows)
                if len(held) > 5000 or items > HELD_ITEMS:
                    yield out()
                    items = 0
        yield out()

    def merged(table: pa.Table) -> Item:
        stack: list[Item] = []
        for chunk in table.column("wrapper").chunks:
            for x in chunk:
                pushed(stack, Item.unpacked(json.loads(x.as_py())))
        return joined_up(stack)

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return pa.table({"host": pa.array([key[0].as_py()], pa.string()), "part": pa.array([key[1].as_py()], pa.int64()), "wrapper": pa.array([json.dumps(merged(table).packed())], pa.string())})

    def last(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return pa.table({"host": pa.array([key[0].as_py()], pa.string()), "role": pa.array([sent(roles(merged(table)))], pa.string())})

    schema = "host string, part long, wrapper string"
    made = once.mapInArrow(build, schema)
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while parts > FAN_IN:
        made = made.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("host", "part").applyInArrow(merge, schema)
        parts = -(-parts // FAN_IN)
    return made.groupBy("host").applyInArrow(last, "host string, role string")


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", text_col: str = "text") -> DataFrame:
    """pages with the main text in `text_col`.

    The pages of a host are dealt to SPREAD parts, each with one copy of the host's role before its pages, so no host is in
    one task alone and a role of any size is sent for parts, not for pages.
    """
    own, name = renamed(pages.drop(text_col))
    url, page = name[url_col], name[html_col]
    hosted = own.withColumn("_host", host_of(F.col(url))).withColumn("_part", F.pmod(F.xxhash64(url, page), F.lit(SPREAD)))
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long")))
    known = host_roles(hosted.select("_host", page), "_host", page).select(F.col("host").alias("_host"), parts.alias("_part"), F.col("role").alias("_role"))
    both = hosted.withColumn("_role", F.lit(None).cast("string")).unionByName(known, allowMissingColumns=True)
    dealt = both.repartition("_host", "_part").sortWithinPartitions("_host", "_part", F.col("_role").isNull())
    k, n = own.columns.index(page), len(own.columns)
    schema = own.withColumn("_text", F.lit("").cast("string")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        role: dict = {}
        for b in batches:
            roles_in = b.column(n + 2)
            texts = []
            for page, found in zip(b.column(k).to_pylist(), roles_in.to_pylist(), strict=True):
                if found is None:
                    texts.append(main_text(page or "", role))
                else:  # that of the rows that follow
                    role = received(found)
            rows = b.filter(roles_in.is_null())
            yield pa.RecordBatch.from_arrays([*rows.columns[:n], pa.array(texts, pa.string())], names=[*rows.schema.names[:n], "_text"])

    return dealt.mapInArrow(run, schema).select(*restored(name), F.col("_text").alias(text_col))
