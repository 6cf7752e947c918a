"""Main text of web pages by the maximum-scoring subsequence of words and tags."""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE = 2000                # labelled pages the weights are learned from, about
WITHIN = 0.02                # share of a negative score that counts inside a content element
PAST_CONTENT = 50.0          # what it costs to go past the end of one
KEYS = 5000                  # elements that get a weight of their own, the most frequent ones

# Names from the HTML standard (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav "
    "ol p pre search section summary table tbody td tfoot th thead title tr ul".split())
RAW = "script|style|noscript|template|textarea|iframe|svg|object|title|annotation|annotation-xml"
FOREIGN = frozenset({"svg", "math"})                      # "/>" ends these, unlike HTML's own
CONTENT = frozenset({"article", "main"})                  # what labels a page
#: Elements that hold no article text unless pages show it, and such words of class, id, role.
OUTSIDE_TAGS = frozenset("nav header footer aside form button select option label head menu dialog "
                         "search".split())
OUTSIDE_WORDS = frozenset(
    "nav header footer aside form ad ads adsense adslot advert adverts advertisement advertising "
    "alert banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus "
    "gdpr masthead menu modal navbar navigation newsletter notice pagination paywall popup promo "
    "promoted recommended related replies reply respond search share sharing sidebar signup "
    "sitemap skip social sponsor sponsored submenu subscribe toolbar topbar trending widget "
    "contentinfo complementary".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?!svg\b[^>]*/>)({RAW})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"""|<(/?)([a-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-z][^\s/>]*)([^>]*)>"""
    r"|<[!?/][^>]*>|([^<]+|<)", re.S | re.I)
_ENDED = re.compile(rf"(?:--|\]\]|</(?:{RAW})\s*)>\Z", re.I)
_NAME = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_WORD = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_CLOSES_P = BLOCK - {"html", "body", "head", "title"}
#: Elements whose names describe the whole page, and words that do so in other elements.
PAGE_TAGS = frozenset({"html", "body", "main"})
PAGE_WORDS = frozenset("main content article post entry story page wrapper container site app".split())
READER_WORDS = frozenset("comment comments disqus replies reply respond".split())
#: Words after which a name tells a state of the element, not what it is.
STATE_WORDS = frozenset("has no with without is js".split())
#: Elements of running text, in which only a whole name says that they are no text.
TEXT_TAGS = frozenset("p span em strong b i a li td h1 h2 h3 h4 h5 h6 blockquote pre".split())
MOST = 0.5                   # share of a page's words that no menu or form holds


def element_key(tag: str, attributes: str) -> str:
    """An element's tag with its class, id and role words."""
    if "=" not in attributes:
        return tag
    names = sorted({w.lower() for _, value in _NAME.findall(attributes)
                    for w in value.strip("\"'").split()})
    return ".".join([tag, *names])


def name_words(name: str) -> list[str]:
    """Words of a class, id or role, without those that tell a state, as in ``has-sidebar``."""
    words = [w.lower() for w in _WORD.findall(name)]
    return [w for i, w in enumerate(words) if not (i and words[i - 1] in STATE_WORDS)]


def default_weight(key: str) -> float:
    """Weight of an element that labelled pages do not show."""
    tag, *names = key.split(".")
    if tag in OUTSIDE_TAGS:
        return -2.0
    if tag in PAGE_TAGS:
        return 1.0
    if tag in TEXT_TAGS:
        words = set(names)
    else:
        words = {w for n in names for w in [n, *name_words(n)]}
    return -2.0 if words & OUTSIDE_WORDS else 1.0


def may_hold_page(key: str) -> bool:
    """Whether an element with a negative weight is the page itself if it holds most words.

    Forms around whole pages are, articles, and elements with a name of both kinds.
    """
    tag, *names = key.split(".")
    words = {w.lower() for n in names for w in _WORD.findall(n)}
    return not words & READER_WORDS and (tag in ("form", "article") or bool(words & PAGE_WORDS))


class Open:
    """An open element; ``weight`` is the least of its own and those around it."""

    __slots__ = ("tag", "key", "weight", "number", "content", "near", "suspect", "outer", "parent")

    def __init__(self, tag, key, weight, number, content, near, suspect, outer, parent):
        self.tag, self.key, self.weight, self.number = tag, key, weight, number
        self.content = content               # within an element labelled as content
        self.near = near                     # place in the stack of the nearest block or p
        self.suspect = suspect               # number of the nearest element that may hold the
        self.outer = outer                   # page, itself included, and of the one around that
        self.parent = parent                 # number of the element around it


class Scanner:
    """One pass over a page: text runs and tags with the elements they are in.

    The work is linear in the page, however many elements it leaves open.
    """

    def __init__(self, weights: dict[str, float] | None = None):
        self.weights = weights or {}

    def weight(self, key: str) -> float:
        found = self.weights.get(key)
        if found is None:
            found = default_weight(key)
            if len(self.weights) < 100_000:
                self.weights[key] = found
        return found

    def tokens(self, page: str, holders: frozenset = frozenset()) -> Iterator[
            tuple[str, str, Open | None]]:
        """(kind, text or tag, innermost open element); kinds are ``text``, ``open``, ``close``.

        Elements are numbered from 1 in page order.  ``holders`` are numbers of elements whose
        own weight does not count, because they hold the page.
        """
        stack: list[Open] = []
        opened: Counter = Counter()
        number = 0
        # what follows the last ">" has no tags
        limit = page.rfind(">") + 1
        unclosed = False                     # a comment or raw element goes on to the end
        for match in _TOKEN.finditer(page, 0, limit):
            text = match.group(8)
            if text is not None:
                yield "text", text, stack[-1] if stack else None
                continue
            closing, tag, attributes = match.group(2, 3, 4) if match.group(3) else (
                match.group(5, 6, 7))
            if not tag:
                unclosed = match.end() == limit and bool(
                    match.group(1) or match.group().startswith(("<!--", "<![CDATA["))) and (
                    not _ENDED.search(match.group()[-40:]))
                continue
            tag = tag.lower()
            if closing:
                if opened[tag]:
                    yield "close", tag, stack[-1]
                    while True:
                        gone = stack.pop()
                        opened[gone.tag] -= 1
                        if gone.tag == tag:
                            break
                elif tag in BLOCK:
                    yield "close", tag, stack[-1] if stack else None
                continue
            if tag in _CLOSES_P and stack and stack[-1].near >= 0 and (
                    stack[stack[-1].near].tag == "p"):
                for gone in stack[stack[-1].near:]:
                    opened[gone.tag] -= 1
                del stack[stack[-1].near:]
            if tag in FOREIGN and (attributes or "").rstrip().endswith("/"):
                continue
            top = stack[-1] if stack else None
            if tag in VOID:
                yield "open", tag, top
                continue
            key = element_key(tag, attributes or "")
            number += 1
            own = 4.0 if number in holders else self.weight(key)
            suspect = number if own < 0 and may_hold_page(key) else top.suspect if top else 0
            content = bool(top and top.content) or (
                tag in CONTENT and (number in holders or default_weight(key) > 0))
            near = len(stack) if tag == "p" or tag in BLOCK else top.near if top else -1
            stack.append(Open(tag, key, min(top.weight if top else 4.0, own), number, content,
                              near, suspect, top.suspect if top else 0,
                              top.number if top else 0))
            opened[tag] += 1
            yield "open", tag, stack[-1]
        if limit < len(page) and not unclosed:
            yield "text", page[limit:], stack[-1] if stack else None


def page_holders(tokens: list) -> frozenset:
    """Numbers of elements that hold more than half of a page's words, though their name or
    kind would have them left out."""
    total, held, outer = 0, Counter(), {}
    for kind, value, element in tokens:
        if kind == "text":
            n = len(value.split())
            total += n
            if element and element.suspect:
                held[element.suspect] += n
        elif kind == "open" and element and element.suspect == element.number:
            outer[element.number] = element.outer
    for number in sorted(outer, reverse=True):
        held[outer[number]] += held[number]
    return frozenset(n for n in outer if held[n] > MOST * total)


def count_labelled(page: str, counts: dict[str, list[int]]) -> None:
    """Add the words of each element, inside and outside a labelled content element.

    Words outside count against the outermost element around them that has no labelled
    content: a menu's words against the menu, not against the links and lists in it.
    """
    parents, keys, inside, outside = [0], [""], Counter(), Counter()
    for kind, text, element in Scanner().tokens(page):
        if kind == "open" and element and element.number == len(parents):
            parents.append(element.parent)
            keys.append(element.key)
        elif kind == "text":
            n = len(text.split())
            (inside if element and element.content else outside)[element.number if element else 0] += n
    labelled = set()
    for number in inside:
        while number and number not in labelled:
            labelled.add(number)
            number = parents[number]
    if not labelled:
        return
    words = [0] * len(parents)
    for number in range(len(parents) - 1, 0, -1):        # children have larger numbers
        words[number] += inside[number]
        words[parents[number]] += words[number]
    around: Counter = Counter()
    path: list[int] = []
    first = [0] * len(parents)
    for number in range(1, len(parents)):
        while path and path[-1] != parents[number]:
            around[keys[path.pop()]] -= 1
        # an element within another of the same key adds nothing to that one's words
        if words[number] and not around[keys[number]]:
            counts.setdefault(keys[number], [0, 0])[0] += words[number]
        around[keys[number]] += 1
        path.append(number)
        if number not in labelled:
            up = parents[number]
            first[number] = first[up] or number
            if outside[number]:
                counts.setdefault(keys[first[number]], [0, 0])[1] += outside[number]


def learn_weights(pages: DataFrame, page_id: str = "page_id", html: str = "html",
                  sample: int = SAMPLE, keys: int = KEYS) -> dict[str, float]:
    """Weights of elements: log odds of their words lying in a labelled article.

    Labelled are pages with an ``article`` or ``main`` element.  About ``sample`` pages, chosen by
    a hash of their id, and at most ``keys`` elements are used, so the model has a fixed size.
    """
    share = max(1, -(-pages.count() // sample))
    chosen = pages.where(F.pmod(F.xxhash64(F.col(f"`{page_id}`")), F.lit(share)) == 0).select(
        F.col(f"`{html}`").cast("string").alias("html"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}
        for batch in batches:
            for page in batch.column(0):
                count_labelled(page.as_py() or "", counts)
        yield pa.RecordBatch.from_pydict(
            {"key": list(counts), "inside": [c[0] for c in counts.values()],
             "outside": [c[1] for c in counts.values()]},
            pa.schema([("key", pa.string()), ("inside", pa.int64()), ("outside", pa.int64())]))

    found = (chosen.mapInArrow(count, "key string, inside long, outside long").groupBy("key")
             .agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
             .orderBy((F.col("inside") + F.col("outside")).desc(), "key").limit(keys).collect())
    weights = {}
    for key, inside, outside in found:
        prior = default_weight(key)             # counts as a few words already seen
        odds = (inside + (4 if prior > 0 else 1)) / (outside + (1 if prior > 0 else 8))
        weights[key] = max(-4.0, min(4.0, math.log(odds)))
    return weights


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous scores with the highest sum, the earliest of equal ones
    and the shortest from there; nothing if no sum is above zero."""
    best = total = 0.0
    start = first = last = 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best + 1e-9:
            best, first, last = total, start, i + 1
    return first, last


def main_text(page: str, scanner: Scanner) -> str:
    """Blocks of the best contiguous region, joined by a blank line.

    A word scores the weight of its element, which is positive where labelled pages have
    article text; a tag scores a little below zero, and as much below as its element's weight.
    Inside a labelled content element negative scores count little, so that a form between two
    paragraphs does not part them, and the end of that element counts much.  A linear scan keeps
    the region with the highest sum (the earliest of equal ones).  Words of a negative weight
    inside the region are left out.  A name or a form that would leave out most of the page's
    words is taken for that of the page: then it does not count.
    """
    read = list(scanner.tokens(page))
    holders = page_holders(read)
    if holders:
        read = list(scanner.tokens(page, holders))
    tokens: list = []                       # (score, text or None for the end of a block)
    for kind, value, element in read:
        weight = element.weight if element else 1.0
        loss = min(0.0, weight)
        if loss and element and element.content:
            loss *= WITHIN
        if kind == "text":
            words = len(value.split())
            tokens.append(((1.0 if weight > 0 else loss) * words, value if weight > 0 else ""))
        else:
            score = -0.01 + loss
            if kind == "close" and value in CONTENT:
                score -= PAST_CONTENT
            tokens.append((score, None if value in BLOCK else " " if value == "br" else ""))
    first, last = best_region([score for score, _ in tokens])
    blocks, part = [], []
    for _, text in [*tokens[first:last], (0, None)]:
        if text is None:
            block = " ".join(entities.unescape("".join(part)).split())
            if block:
                blocks.append(block)
            part = []
        else:
            part.append(text)
    return "\n\n".join(blocks)


def extract_main_text(pages: DataFrame, page_id: str = "page_id", html: str = "html",
                      weights: dict[str, float] | None = None,
                      output: str = "text") -> DataFrame:
    """``pages`` with the main text of each whole page in ``output``.

    All columns stay; one named like ``output`` is replaced.  A missing or empty page, and one
    without words in content elements, gives an empty text.  References to characters are
    decoded, white space within a block becomes one space, blocks stand in page order.  Pages
    are handled one by one, so equal ids and repeated rows do not matter.
    """
    learned = learn_weights(pages, page_id, html) if weights is None else weights
    names = [c for c in pages.columns if c != output or c == html]
    whole = pages.select(*[F.col(f"`{c}`") for c in names],
                         F.col(f"`{html}`").cast("string").alias(" page"))
    schema = T.StructType([f for f in whole.schema.fields if f.name != " page" and (
        f.name != output)] + [T.StructField(output, T.StringType())])
    stay = [i for i, n in enumerate(names) if n != output]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(dict(learned))
        for batch in batches:
            texts = [main_text(p.as_py() or "", scanner) for p in batch.column(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in stay], pa.array(texts, pa.string())], schema.names)

    return whole.mapInArrow(extract, schema)
