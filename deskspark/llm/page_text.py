"""Main text of web pages by differencing each page with its nearest neighbour on the same host.

Pages are ordered by host, path and id; of the pages before and after a page on its host, the one
whose path shares the longer beginning is nearest (ties: the one before). Both pages are taken
apart into text lines, one for each block element. The longest common subsequence of the lines is
what the host's template gives both pages, and those lines are deleted, with two exceptions: lines
inside an <article> or <main> are the page's own by the author's word (copies of an article must
not delete each other), and if every line is shared the pages are copies, which says nothing about
a template. Then lines go that markup names as something else: menus, headers, footers, sidebars,
notices, adverts, forms, comments, and whatever stands beside an <article> or <main>. A name that
only qualifies another word (social-history) needs the differencing to confirm it: such lines go if
they are shared. An <article> or <main> inside a form, and a <main> inside a named wrapper, count as
not beside; where nothing else is left, so do wrappers named after what they also hold.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskspark.llm.common import shuffle_width

#: Elements of HTML by what they mean here.
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "select summary table tbody td tfoot th thead title tr ul".split())
SILENT = frozenset("script style noscript template iframe object embed svg math canvas audio video title textarea".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ASIDE = frozenset("nav footer aside form menu dialog button select head".split())
WHOLE = frozenset("html body main".split())
OWN = frozenset("article main".split())
#: Words in class, id or role that name something beside the text.
NAMED = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments consent cookie "
    "cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices overlay pager "
    "pagination popup promo promoted related reply replies respond search share sharing sidebar signup social sponsor "
    "sponsored subscribe subscription tags toolbar widget widgets".split())
#: Those of them that layouts also give to an element around the whole page.
WRAPPING = frozenset("header modal newsletter notices overlay search share sharing sidebar social subscription tags toolbar widget widgets".split())
#: Words that before a name say what an element has, not what it is, and words that behind a name add nothing to it.
STATES = frozenset("has no with without".split())
PLACES = frozenset(
    "area bar block body bottom box btn button buttons card cards center column container content cta feed form group holder "
    "icons inline inner item items left link links list main message outer panel post posts right section slot space strip text "
    "title top unit wrap wrapper zone".split())
#: How sure it is that a line stands beside the text, in rising order.
NOT, PERHAPS, FORM, WRAPPER, BESIDE = range(5)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[a-zA-Z/][^>]*(?:>|\Z)", re.S)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")
_ENDS = {k: re.compile(rf"</{k}\s*>", re.I) for k in SILENT}


def named_aside(attributes: str) -> int:
    """How surely class, id or role name a menu, an advert or the like, or the element is hidden."""
    if not attributes:
        return NOT
    if _HIDDEN.search(attributes):
        return BESIDE
    level = NOT
    for name in (n for m in _NAMES.findall(attributes) for n in "".join(m).lower().split()):
        words = [w for w in _PARTS.split(name) if w and not w.isdigit()]
        found = NAMED.intersection(words)
        if not found or words[0] in STATES:
            continue
        if words[-1] not in NAMED and words[-1] not in PLACES:
            level = max(level, PERHAPS)
        else:
            level = max(level, WRAPPER if found <= WRAPPING else BESIDE)
    return level


def text_lines(page: str | None) -> list[tuple[str, bool, int]]:
    """(line, inside an article, how surely beside the text) for every block with text, in page order.

    Unclosed elements end with the element around them; a closing tag without an opening one is
    ignored. The content of scripts, styles and the like is no text.
    """
    lines: list[tuple[str, bool, int]] = []
    stack: list[tuple[str, bool, int]] = []
    own, beside = False, NOT
    buffer: list[str] = []
    page = page or ""

    def flush() -> None:
        if buffer:
            line = " ".join(html.unescape("".join(buffer)).split())
            buffer.clear()
            if line:
                lines.append((line, own, beside))

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            buffer.append(page[at:])
            break
        if m.start() > at:
            buffer.append(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                buffer.append(html.escape(m[0][9:].removesuffix("]]>")))
            continue
        name = m[2].lower()
        if not m[1] and name in SILENT:
            if name in BLOCKS:
                flush()
            if not m[3].endswith("/"):
                close = _ENDS[name].search(page, at)
                at = close.end() if close else end
            continue
        if name in BLOCKS or name in ASIDE:
            flush()
        if name in VOID:
            continue
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if stack[k][1:] != (own, beside):
                        flush()
                    own, beside = stack[k][1:]
                    del stack[k:]
                    break
        else:
            if name == "p" and stack and stack[-1][0] == "p":
                own, beside = stack.pop()[1:]
            stack.append((name, own, beside))
            level = named_aside(m[3]) if name not in WHOLE else NOT
            if name in ASIDE or name == "header" and not own:
                level = max(level, FORM if name == "form" else BESIDE)
            if name in OWN and beside <= (WRAPPER if name == "main" else FORM):
                beside = NOT
            if level > beside:
                flush()
            own, beside = own or name in OWN, max(beside, level)
    flush()
    return lines


def common_positions(a: list[int], b: list[int]) -> list[int]:
    """Positions in `a` of a longest common subsequence with `b`, in linear memory."""
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    x, y = a[low:len(a) - high], b[low:len(b) - high]
    middle: list[int] = []
    if x and y and not set(x).isdisjoint(y):
        if len(x) == 1:
            middle = [low]
        else:
            half = len(x) // 2
            fore, back = lengths(x[:half], y), lengths(x[half:][::-1], y[::-1])
            cut = max(range(len(y) + 1), key=lambda j: fore[j] + back[len(y) - j])
            middle = [low + k for k in common_positions(x[:half], y[:cut])]
            middle += [low + half + k for k in common_positions(x[half:], y[cut:])]
    return [*range(low), *middle, *range(len(a) - high, len(a))]


def lengths(a: list[int], b: list[int]) -> list[int]:
    """Length of the longest common subsequence of `a` and every beginning of `b`, a row of bits at a time."""
    places: dict[int, int] = {}
    for j, v in enumerate(b):
        places[v] = places.get(v, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for v in a:
        match = places.get(v, 0)
        kept = row & match
        row = (row + kept | row - kept) & full
    out, n = [0], 0
    for bit in bin(row | 1 << len(b))[3:][::-1]:
        n += bit == "0"
        out.append(n)
    return out


class Page:
    """A page's lines and where it stands."""

    def __init__(self, row: dict):
        self.row, self.lines = row, text_lines(row["html"])
        self.keys = [xxhash.xxh3_64_intdigest(x[0]) for x in self.lines]

    def same_site(self, other: Page | None) -> bool:
        return other is not None and self.row["host"] == other.row["host"] and self.keys != other.keys

    def shared_with(self, other: Page) -> int:
        return len(commonprefix([self.row["path"], other.row["path"]]))

    def main_text(self, before: Page | None, after: Page | None) -> tuple[str, int | None, int]:
        """The text, the id of the page compared with, and how many lines they share."""
        near = max((p for p in (before, after) if self.same_site(p)), key=self.shared_with, default=None)
        shared = set(common_positions(self.keys, near.keys)) if near else set()
        template = shared if len(shared) < len(self.keys) else set()
        plain = [k for k, (_, _, beside) in enumerate(self.lines) if beside == NOT or beside == PERHAPS and k not in shared]
        rest = [k for k, (_, _, beside) in enumerate(self.lines) if beside <= WRAPPER and k not in template]
        kept = ([k for k in plain if self.lines[k][1]] or [k for k in plain if k not in template]
                or [k for k in rest if self.lines[k][1]] or rest)
        return " ".join(self.lines[k][0] for k in kept), near.row["page_id"] if near else None, len(shared)


def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of the pages of a task, which come in order; guests only stand beside others."""
    before: Page | None = None
    page: Page | None = None
    out: list[tuple] = []

    def batch_of() -> pa.RecordBatch:
        page_id, url, text, near, shared = zip(*out)
        out.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(page_id, pa.int64()), pa.array(url, pa.string()), pa.array(text, pa.string()),
             pa.array([len(t) for t in text], pa.int64()), pa.array(near, pa.int64()), pa.array(shared, pa.int64())],
            names=["page_id", "url", "text", "n_chars", "near_page_id", "n_shared_lines"])

    def settle(after: Page | None) -> None:
        if page is not None and not page.row["guest"]:
            out.append((page.row["page_id"], page.row["url"], *page.main_text(before, after)))

    for batch in batches:
        for i in range(batch.num_rows):
            after = Page({c: batch.column(c)[i].as_py() for c in batch.schema.names})
            settle(after)
            before, page = page, after
            if len(out) >= 500:
                yield batch_of()
    settle(None)
    if out:
        yield batch_of()


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:(?:[a-zA-Z][\w+.-]*:)?//[^/?#]*)?([^?#]*)", 1)


#: Keys looked at, per range, to lay out ranges of equal size; they decide where work is done, not what comes out.
LAYOUT_KEYS, RANGES_PER_TASK = 20, 4
_SEPARATORS = "\x00\x01\x02"


def order_key(url: Column, page_id: Column, page: Column) -> Column:
    """A text that sorts pages by host, path and id, and copies of a row by content."""
    parts = [F.translate(host_of(url), _SEPARATORS, ""), F.translate(path_of(url), _SEPARATORS, ""),
             F.lpad(F.coalesce(page_id.cast("string"), F.lit("")), 20, "0"), F.hex(F.xxhash64(page))]
    return F.concat_ws("\x01", *parts)


def range_of(key: Column, cuts: list[str]) -> Column:
    """How many of the sorted `cuts` are not above the key, by halving."""
    if not cuts:
        return F.lit(0)
    listed = F.split(F.lit("\x02".join(cuts)), "\x02")
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))))

    def halve(low: Column, step: Column) -> Column:
        at = low + step
        return F.when((at <= len(cuts)) & (F.get(listed, at - 1) <= key), at).otherwise(low)

    return F.aggregate(steps, F.lit(0), halve)


def main_texts(pages: DataFrame, tasks: int | None = None) -> DataFrame:
    """page_id, url, text, n_chars, near_page_id, n_shared_lines of every row of `pages` (page_id, url, html).

    The sorted pages are cut into ranges by a number of sampled keys; each range also gets the
    pages just before and after it as guests, so that a page's neighbours do not depend on the
    cuts. NULL and empty pages give an empty text; a NULL url is a host of its own; pages of a
    host with one page, and copies, have no neighbour (NULL) and lose named lines only; repeated
    rows come out each; other columns are ignored; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    tasks = tasks or shuffle_width(spark)
    rows = pages.select(
        order_key(F.col("url"), F.col("page_id"), F.col("html")).alias("key"), host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"), "page_id", "url", "html")
    ranges = tasks * RANGES_PER_TASK
    looked_at = pages.select(F.xxhash64("page_id", "url").alias("h"), order_key(F.col("url"), F.col("page_id"), F.lit("")).alias("key"))
    sample = sorted({r.key for r in looked_at.orderBy("h", "key").limit(ranges * LAYOUT_KEYS).collect()})
    cuts = sample[len(sample) // ranges::max(1, len(sample) // ranges)]
    ranged = rows.withColumn("part", range_of(F.col("key"), cuts))
    ends = ranged.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last")).orderBy("part").collect()  # one a range
    lend = [(a.last, b.part) for a, b in zip(ends, ends[1:])] + [(b.first, a.part) for a, b in zip(ends, ends[1:])]
    places = spark.createDataFrame(lend, "key string, part int")
    guests = (rows.join(F.broadcast(places), "key").dropDuplicates(["key", "part"])
              .withColumn("guest", F.lit(True)))
    dealt = ranged.withColumn("guest", F.lit(False)).unionByName(guests)
    parts = dealt.repartition(tasks, "part").sortWithinPartitions("part", "key", "guest")
    return parts.select("guest", "host", "path", "page_id", "url", "html").mapInArrow(
        compared, "page_id long, url string, text string, n_chars long, near_page_id long, n_shared_lines long")
