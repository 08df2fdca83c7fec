"""Main text of web pages by consensus paths of their hosts (operator 1).

Each page's containers are scored by the text they hold outside boilerplate.  The path of the
best one, its tags with generalised classes, is the page's vote; votes are summed per host and
path in Spark.  The path with the most pages and every other one that several pages of the host
vote for, each a template, are kept; a page is extracted with the one of them that scores best on
it.  A page on which none of them matches, or its own best container scores far better than all
of them, uses that.

Kept: the blocks of the container in page order.  Left out: menus, headers (but the headings of
an article's own header), footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments, known by their tag, role or by words of their class and id.  Such an element that holds
most of the page's text outside links, and is named like main text too or leaves next to nothing
without it, is the main text after all and is kept; what is boilerplate inside it is not.

Other columns of the pages are ignored, clashing names included.  An empty table gives an empty
result.  A page of any length is read whole, in a few passes of linear time.  A null, empty or textless page has the empty text.  Pages without a host have no common template:
each uses its own best container.  Equal scores go to the smallest path.  Rows come out as often
as they come in.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Collection
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.llm.support import join_small, pinned, ship

#: Elements that hold blocks and may be a page's container.
CONTAINERS = frozenset("html body main article section div td center".split())
#: Elements that end a block of text, containers included.
BLOCKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre figure figcaption table thead tbody tfoot tr th caption hr "
    "address details summary header hgroup fieldset form nav aside footer menu dialog search".split()
)
#: Elements left out with all they hold.
DROPPED = frozenset(
    "head nav footer aside form button select menu dialog search header iframe object svg math canvas audio video "
    "noscript template datalist fieldset label".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ITEMS = ("li", "dt", "dd", "tr", "td", "th")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
#: Words of a class or id that mark what is not main text.
NOISE = frozenset(
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toolbar topbar masthead header footer "
    "sidebar sidebars aside widget widgets related recommended recommendations "
    "notice notices cookie cookies consent gdpr banner alert popup modal overlay newsletter subscribe signup paywall "
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored promo promos promotion "
    "comment comments commentlist disqus respond reply replies discussion "
    "form login search share sharing social skip hidden".split()
)
#: Words of a class or id that mark main text.
MAIN = frozenset("article content main post entry story body text".split())

#: Words of reader comments, which may well hold more text than the article.
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies discussion".split())
#: Elements never looked into again, whatever they hold.
EMPTY_OF_TEXT = frozenset("head select menu button iframe object svg math canvas audio video noscript template datalist".split())

#: A container marked as noise holds the main text if it has more than half of the page's text
#: outside links and this many times what is left without it.
OUTWEIGHS = 10
#: A page is extracted with its own best path if that scores this many times the best voted one.
FAR_BETTER = 4

#: A path that this many pages of a host vote for is one of its templates.
SEVERAL = 2

#: Containers nested deeper belong to the one at this depth.
DEEPEST = 48

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<raw>script|style|textarea|title|xmp)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^\"'<>])*+|[^<>]*)>",
    re.S | re.I,
)
_ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden|itemprop)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"[0-9a-f]*[0-9][0-9a-f]*")


class Node(NamedTuple):
    """An open element."""

    tag: str
    path: str
    dropped: int  # 2: with all it holds, 1: all but headings, 0: kept
    weight: float


def attributes(source: str) -> dict[str, str]:
    return {k.lower(): unescape(a or b or c) for k, a, b, c in _ATTR.findall(source)} if source.strip() else {}


def noise_words(attrs: dict[str, str]) -> set[str]:
    found: set[str] = set()
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
        words = [w.lower() for w in _WORDS.findall(name)]
        if words and words[0] not in ("has", "with", "no", "without", "is"):
            found |= NOISE.intersection(words)
    return found


def how_dropped(tag: str, attrs: dict[str, str], in_main: bool) -> int:
    """2 for boilerplate, 1 for the header of an article (its headings stay), 0 for the rest."""
    if tag in ("html", "body", "main", "article"):
        return 2 * ("hidden" in attrs)
    noise = noise_words(attrs)
    if in_main and (tag == "header" or noise and noise <= {"header", "masthead"}):
        return 1
    hidden = "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true"
    return 2 * bool(tag in DROPPED or hidden or noise or attrs.get("role", "").lower() in ROLES)


def general_path(parent: str, tag: str, attrs: dict[str, str]) -> str:
    """Path with the classes in order; runs with digits are generalised, the body's left out."""
    classes = [] if tag in ("html", "body") else sorted({_DIGITS.sub("#", c.lower()) for c in attrs.get("class", "").split()})
    return f"{parent}/{'.'.join([tag, *classes])}"


def weight_of(tag: str, attrs: dict[str, str]) -> float:
    if tag == "article" or attrs.get("itemprop", "").lower() == "articlebody":
        return 2.0
    if tag == "main" or attrs.get("role", "").lower() == "main":
        return 1.5
    words = {w.lower() for w in _WORDS.findall(f"{attrs.get('class', '')} {attrs.get('id', '')}")}
    return 1.5 if words & MAIN else 1.0 if tag in ("html", "body") else 1.1


class Suspect(NamedTuple):
    """An element left out for its tag, role or words, and the characters outside links it holds."""

    chars: int
    main: bool  # one of its names is of main text alone
    comments: bool


def suspect(attrs: dict[str, str]) -> Suspect:
    names = [{w.lower() for w in _WORDS.findall(name)} for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".split()]
    return Suspect(0, any(words and words <= MAIN for words in names), any(words & COMMENTS for words in names))


def misjudged(suspects: list[Suspect], all_chars: int, kept_chars: int) -> frozenset[int]:
    """The suspects that hold the main text: a word is one weight, the share of the text another."""
    return frozenset(
        k for k, s in enumerate(suspects)
        if 2 * s.chars > all_chars and (s.main or (kept_chars == 0 if s.comments else OUTWEIGHS * kept_chars < s.chars)))


class Block(NamedTuple):
    """A block of text, the serial numbers of its open containers, and its link characters."""

    text: str
    inside: tuple[int, ...]
    link: int


def parse(html: str) -> tuple[list[Block], list[Node]]:
    """Blocks of a page outside boilerplate in page order, and its containers.

    An element that looks like boilerplate but holds the main text is gone through again as kept.
    """
    spared: frozenset[int] = frozenset()
    while True:
        blocks, found, suspects, all_chars = walk(html, spared)
        more = spared | misjudged(suspects, all_chars, sum(len(b.text) - b.link for b in blocks))
        if more == spared:
            return blocks, found
        spared = more


def walk(html: str, spared: frozenset[int]) -> tuple[list[Block], list[Node], list[Suspect], int]:
    """Blocks and containers, what was left out, and the characters outside links of all that is text.

    Elements left out count in page order; those of the numbers ``spared`` are kept.
    """
    stack: list[Node] = []
    opened: list[int] = []  # serial numbers of open containers
    marks: list[int] = []  # for each stack entry its serial number, or -1
    tags: Counter[str] = Counter()  # of the stack
    out = [0, 0, 0]  # open elements by how they are dropped
    suspects: list[Suspect] = []
    since: list[tuple[int, int]] = []  # of each stack entry: its number as a suspect or -1, characters before it
    chars = no_text = 0  # characters outside links so far; open elements without text
    found: list[Node] = []
    blocks: list[Block] = []
    words: list[str] = []
    in_link = in_heading = False
    link_chars = 0

    def kept() -> bool:
        return not out[2] and (not out[1] or in_heading)

    def close_block():
        nonlocal link_chars
        if words:
            text = " ".join(unescape("".join(words)).split())
            if text:
                blocks.append(Block(text, tuple(opened), min(link_chars, len(text))))
            words.clear()
        link_chars = 0

    def pop():
        nonlocal no_text
        node, serial = stack.pop(), marks.pop()
        out[node.dropped] -= 1
        tags[node.tag] -= 1
        if serial >= 0:
            opened.pop()
        number, before = since.pop()
        no_text -= node.tag in EMPTY_OF_TEXT
        if number >= 0:
            suspects[number] = suspects[number]._replace(chars=chars - before)

    at, last = 0, html.rfind(">") + 1
    for m in _TOKEN.finditer(html, 0, last):
        if m.start() > at:
            if not in_link and not no_text:
                chars += len(" ".join(html[at : m.start()].split()))
            if kept():
                words.append(html[at : m.start()])
                link_chars += in_link * (m.start() - at)
        at = m.end()
        if not m["tag"]:
            if m[0].startswith("<![CDATA[") and kept():
                words.append(m[0][9:-3].replace("&", "&amp;"))
            continue
        tag, ends = m["tag"].lower(), bool(m["end"])
        if tag == "a":
            in_link = not ends
        elif tag == "br" and kept():
            words.append(" ")
        if tag in BLOCKS:
            close_block()
            in_heading = tag in HEADINGS and not ends
        if ends:
            if tags[tag] > 0:
                while stack[-1].tag != tag:
                    pop()
                pop()
            continue
        if tag in BLOCKS:  # an unclosed dropped paragraph, item or cell ends where the next block begins
            while stack and stack[-1].dropped and (stack[-1].tag == "p" or stack[-1].tag == tag and tag in ITEMS):
                pop()
        holds = tag in CONTAINERS
        attrs = attributes(m["attrs"])
        if tag in VOID or m["attrs"].endswith("/") and not holds or not (holds or tag in DROPPED or attrs):
            continue
        in_main = any(found[k].weight >= 1.5 for k in opened)
        drop, number = how_dropped(tag, attrs, in_main), -1
        if drop == 2 and tag not in EMPTY_OF_TEXT and "hidden" not in attrs and attrs.get("aria-hidden", "").lower() != "true":
            number = len(suspects)
            suspects.append(suspect(attrs))
            drop = 0 if number in spared else drop
        if not holds and not drop and number < 0:
            continue
        serial, path = -1, stack[-1].path if stack else ""
        if holds and not drop and not out[1] and not out[2] and len(opened) < DEEPEST:
            path = general_path(path, tag, attrs)
            serial = len(found)
            found.append(Node(tag, path, drop, weight_of(tag, attrs)))
            opened.append(serial)
        stack.append(Node(tag, path, drop, 0.0))
        marks.append(serial)
        since.append((number, chars))
        no_text += tag in EMPTY_OF_TEXT
        tags[tag] += 1
        out[drop] += 1
    chars += 0 if in_link or no_text else len(" ".join(html[at:].split()))
    if kept():
        words.append(html[at:])
    close_block()
    while stack:
        pop()
    return blocks, found, suspects, chars


def scored(blocks: list[Block], containers: list[Node]) -> dict[str, float]:
    """Score of each path: weight times the characters outside links of the blocks inside."""
    held = [0] * len(containers)
    for block in blocks:
        for serial in block.inside:
            held[serial] += len(block.text) - block.link
    scores: dict[str, float] = {}
    for node, n in zip(containers, held, strict=True):
        scores[node.path] = scores.get(node.path, 0.0) + node.weight * n
    return scores


def text_at(blocks: list[Block], containers: list[Node], paths: Collection[str] | None) -> str:
    """Blocks inside the containers of the path that scores best, among ``paths`` unless another is far better."""
    scores = scored(blocks, containers)
    voted = {p: scores[p] for p in paths or () if p in scores}
    if voted and FAR_BETTER * max(voted.values()) >= max(scores.values()):
        scores = voted
    path = min(scores, key=lambda p: (-scores[p], p)) if scores else None
    wanted = {k for k, n in enumerate(containers) if n.path == path}
    return "\n\n".join(b.text for b in blocks if path is None or not wanted.isdisjoint(b.inside))


def with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.withColumn("_host", host)


def host_votes(pages: DataFrame) -> DataFrame:
    """Voted paths per ``_host``: each page votes for its best path with the score it has there."""
    ship(pages.sparkSession)

    def run(batches):
        for batch in batches:
            hosts, paths, scores = [], [], []
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                marks = scored(*parse(html or ""))
                if marks:
                    best = min(marks, key=lambda p: (-marks[p], p))
                    hosts.append(host)
                    paths.append(best)
                    scores.append(marks[best])
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(scores, pa.float64())],
                names=["_host", "path", "score"])

    votes = pages.where("_host <> ''").select("_host", "html").mapInArrow(run, "_host string, path string, score double")
    sums = votes.groupBy("_host", "path").agg(F.count("*").alias("pages"), F.round(F.sum("score"), 3).alias("score"))
    first = F.min(F.struct((-F.col("pages")).alias("a"), (-F.col("score")).alias("b"), "path"))["path"]
    several = F.collect_set(F.when(F.col("pages") >= SEVERAL, F.col("path")))
    return sums.groupBy("_host").agg(F.array_sort(F.array_union(F.array(first), several)).alias("_paths"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    hosted = with_host(pages.select("page_id", "url", "html"))
    winners = pinned(host_votes(hosted), "host-paths")
    n = winners.agg(F.sum(F.size("_paths"))).first()[0] or 0
    joined = join_small(hosted, winners, ["_host"], "left", n)
    kinds = dict(pages.dtypes)

    def run(batches):
        for batch in batches:
            texts = [
                text_at(*parse(html or ""), paths)
                for html, paths in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return joined.select("page_id", "url", "html", "_paths").mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
