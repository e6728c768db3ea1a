"""Main text of web pages by a maximum-scoring subsequence.

A page is a row of words and tags. Words score positive and tags negative, with weights learned from
labelled pages; one linear scan finds the contiguous stretch of largest total, and the blocks in it are the
main text. Pages whose authors have marked their only article (an ``article`` element) are the labels: what
stands in it is content, what stands beside it is not.

Two kinds of weights are learned. A tag costs more the oftener it stands outside the article; the tags of
the article itself always do, so leaving an article is dear. An element is told by its name, by the words of
its ``class``, ``id`` and ``role``, and by the odds of these to stand in an article; only the outermost
elements beside an article are counted, since a list is no worse for standing in a menu. Words in elements
that speak against content (menus, adverts, forms, comments) score slightly negative and are left out of the
text wherever they stand. Names that the HTML standard or common usage gives a meaning have prior counts, so
the scan works without a single label.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql import types as T

from tidemark.llm.base import fields, query, renamed
from tidemark.queries.base import table

# At most so many labelled pages are learned from: those of the smallest hashes (and pages equal to them).
LABELLED = 2_000
# Names seen less often in them say nothing.
LEAST_SEEN = 5

# Element names of the HTML standard.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = "script|style|textarea|title|iframe|template|noscript|noembed|noframes|xmp|svg|math|object|canvas|audio|video|select|datalist"
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td "
    "tfoot th thead tr ul".split()
)
_WHOLE = frozenset("html body".split())
_BREAKING = frozenset("hr p".split())  # among tags without content, stray ones too
# An element that a like one ends, within the nearest of the others.
_ENDS = {
    "li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr", "table"),
    "th": ("tr", "table"), "option": ("optgroup",),
}
# Names that speak against content, and for it.
_AGAINST = frozenset(
    "nav footer aside form button dialog menu search header head label fieldset "
    ".ad .ads .adv .advert .adverts .advertisement .advertising .sponsor .sponsored .promo .promotion .banner .comment .comments .reply "
    ".replies .respond .disqus .sidebar .aside .rail .menu .nav .navbar .navigation .breadcrumb .breadcrumbs .footer .header .masthead "
    ".cookie .cookies .consent .gdpr .notice .notification .alert .popup .modal .overlay .subscribe .subscription .newsletter .signup .login "
    ".share .sharing .social .related .recommended .widget .toolbar .pagination .pager .skip .hidden .contentinfo .complementary .dialog "
    ".search .form".split()
)
_FOR = frozenset("article main h1 p .article .content .main .post .entry .story .body .text .articlebody".split())

# Possessive, and no part but a quoted value runs past the next "<": linear on any input.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + _RAW + r")(?=[\s/>])[^<>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/<>]*+)(?P<attributes>(?:[^'\"<>]++|\"[^\"]*+\"|'[^']*+'|['\"])*+)>"
    r"|<[!?/][^<>]*+>|<[a-z!?/][^<>]*+\Z|(?P<text>[^<]++|<)",
    re.I | re.S,
)
_NAMED = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?<![\w"'=-])hidden(?![\w-])""", re.I)
_PARTS = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

OPEN, CLOSE, TEXT, BREAK = range(4)


def signatures(name: str, attributes: str) -> tuple[str, ...]:
    """What an element is told by: its name, and ``.word`` for each word of its class, id and role."""
    if not attributes or attributes == "/":
        return (name,)
    words: dict[str, None] = {}
    for values in _NAMED.findall(attributes):
        words.update(dict.fromkeys(_PARTS.findall(_CAMEL.sub(" ", "".join(values)).lower())))
    if _HIDDEN.search(re.sub(r"\"[^\"]*\"|'[^']*'", '""', attributes)):
        words["hidden"] = None
    return (name, *("." + word for word in words))


def events(page: str) -> Iterator[tuple[int, str, tuple[str, ...]]]:
    """Openings and closings in balance, texts and line breaks of a page, in order.

    Comments, scripts, styles and the like are no part of it. A closing tag ends all that is still open in
    its element; one without an opening is ignored; a block ends an open paragraph.
    """
    stack: list[str] = []
    held: Counter = Counter()  # open elements by name, so that a stray closing tag costs no search

    def closed(name: str) -> Iterator[tuple[int, str, tuple[str, ...]]]:
        while True:
            last = stack.pop()
            held[last] -= 1
            yield CLOSE, last, ()
            if last == name:
                return

    for token in _TOKEN.finditer(page):
        kind = token.lastgroup
        if kind == "text":
            yield TEXT, token["text"], ()
        elif token["name"]:
            name = token["name"].lower()
            if token["end"]:
                if held[name]:
                    yield from closed(name)
                elif name == "p" or name == "br":
                    yield BREAK, name, ()
            elif name in _VOID:
                yield BREAK, name, ()
            else:
                if name in _BLOCKS and held["p"] and "p" in stack[-4:]:
                    yield from closed("p")
                if name in _ENDS and held[name]:
                    for last in reversed(stack):
                        if last in _ENDS[name]:
                            break
                        if last == name:
                            yield from closed(name)
                            break
                stack.append(name)
                held[name] += 1
                yield OPEN, name, signatures(name, token["attributes"])
    while stack:
        yield from closed(stack[0])


@dataclass
class Counts:
    """How often tags and elements stand in and beside the marked article of labelled pages."""

    found: Counter = field(default_factory=Counter)

    def learn(self, page: str) -> None:
        """Count a page that has exactly one article."""
        parts = list(events(page))
        if sum(kind == OPEN and name == "article" for kind, name, _ in parts) != 1:
            return
        inside = 0
        # Open elements outside the article: signatures, whether the article is in them, outer elements found so far.
        outer: list[list] = [[(), True, []]]
        for kind, name, told in parts:
            if kind == OPEN:
                if inside or name == "article":
                    if not inside:
                        for one in outer:
                            one[1] = True
                        self._tag(name, False)
                    else:
                        self._tag(name, True)
                        self._element(_within(told, True), True)
                    inside += 1
                else:
                    outer.append([told, False, []])
            elif kind == CLOSE:
                if inside:
                    inside -= 1
                    self._tag(name, inside > 0)
                else:
                    told, around, beside = outer.pop()
                    if around:
                        for one in beside:
                            self._beside(one)
                    else:
                        outer[-1][2].append(told)
        for one in outer[0][2]:
            self._beside(one)

    def _beside(self, told: tuple[str, ...]) -> None:
        self._element(told, False)
        if told[0] in _telling(told):
            self._tag(told[0], False)

    def _tag(self, name: str, content: bool) -> None:
        self.found["tag", name, content] += 1

    def _element(self, told: tuple[str, ...], content: bool) -> None:
        for name in _telling(told):
            self.found["element", name, content] += 1


def _telling(told: tuple[str, ...]) -> tuple[str, ...]:
    """The names that tell what an element is: not its own, where that is a common one beside others."""
    return told if len(told) == 1 or told[0] in _AGAINST or told[0] in _FOR else told[1:]


def _within(told: tuple[str, ...], article: bool) -> tuple[str, ...]:
    """A header in an article is its own, not the page's."""
    return tuple("article header" if article and name == "header" else name for name in told)


@dataclass(frozen=True)
class Weights:
    """Learned weights; without any, the prior ones."""

    tags: Mapping[str, float] = field(default_factory=dict)
    elements: Mapping[str, float] = field(default_factory=dict)

    @classmethod
    def of(cls, counted: Mapping[tuple[str, str, bool], int]) -> Weights:
        tags, elements = {}, {}
        for kind, name in sorted({key[:2] for key in counted}):
            content, other = counted.get((kind, name, True), 0), counted.get((kind, name, False), 0)
            if content + other < LEAST_SEEN:
                continue
            if kind == "tag":
                tags[name] = -0.2 - 4 * max(0.0, (other - content) / (content + other + 1))
            else:
                against, in_favour = (20, 1) if name in _AGAINST else (1, 5) if name in _FOR else (1, 1)
                elements[name] = math.log((content + in_favour) / (other + against))
        return cls(tags, elements)

    def tag(self, name: str) -> float:
        return self.tags.get(name, -4.2 if name == "article" else -0.2)

    def evidence(self, told: tuple[str, ...]) -> float:
        """How an element's names speak for content (positive) or against it, as a sum of log odds. A name
        in favour counts no more than a usual word against."""
        total = 0.0
        for name in _telling(told):
            odds = self.elements.get(name)
            if odds is None:
                odds = -3.0 if name in _AGAINST else 1.5 if name in _FOR else 0.0
            total += min(odds, 1.5)
        return total


def best_stretch(scores: list[float]) -> tuple[int, int]:
    """Start and end (exclusive) of the contiguous stretch of largest positive sum, the first of equal ones;
    an empty one where nothing is positive."""
    best, first, last = 0.0, 0, 0
    total, start = 0.0, 0
    for at, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, at
        total += score
        if total > best:
            best, first, last = total, start, at + 1
    return first, last


def _wrapping_forms(parts: list[tuple[int, str, tuple[str, ...]]]) -> set[int]:
    """Places of the openings of forms that hold most words of the page: they are no part of it."""
    words, opened, forms = 0, [], []
    for at, (kind, name, _) in enumerate(parts):
        if kind == TEXT:
            words += len(name.split())
        elif kind == OPEN and name == "form":
            opened.append((at, words))
        elif kind == CLOSE and name == "form":
            start, before = opened.pop()
            forms.append((start, words - before))
    return {start for start, held in forms if 2 * held > words}


def main_text(page: str | None, weights: Weights) -> str:
    """The main text of a page: blocks parted by an empty line, white space within a block as one space.

    A missing or empty page, and one without content, has the empty text. Nothing is cut off.
    """
    if not page:
        return ""
    parts = list(events(page))
    wrapping = _wrapping_forms(parts)
    scores: list[float] = []
    block_of: list[int] = []
    texts: list[str] = []  # empty at tags and in elements against content
    block = against = article = 0
    open_against: list[bool] = []
    for at, (kind, name, told) in enumerate(parts):
        said = ""
        if kind == TEXT:
            scores.append(len(name.split()) * (-0.1 if against else 1.0))
            said = "" if against else name
        elif kind == BREAK:
            block += name in _BREAKING
            scores.append(weights.tag(name))
            said = " " if name == "br" else ""
        else:
            block += name in _BLOCKS
            if kind == OPEN:
                speaks = not (name in _WHOLE or at in wrapping) and weights.evidence(_within(told, article > 0)) < -1
                open_against.append(speaks)
                against += speaks
                article += name == "article"
            else:
                speaks = open_against.pop()
                against -= speaks
                article -= name == "article"
            scores.append(-4.2 if speaks else weights.tag(name))
        if article and (against or speaks):
            scores[-1] = 0.0  # within a marked article a foreign element is passed over; elsewhere it parts
        texts.append(said)
        block_of.append(block)
    first, last = best_stretch(scores)
    if first == last:
        return ""
    while first and block_of[first - 1] == block_of[first]:
        first -= 1
    while last < len(scores) and block_of[last] == block_of[last - 1]:
        last += 1
    found, at = [], first
    while at < last:
        end = at
        while end < last and block_of[end] == block_of[at]:
            end += 1
        said = " ".join(entities.unescape("".join(texts[at:end])).split())
        if said:
            found.append(said)
        at = end
    return "\n\n".join(found)


def learn_weights(pages: DataFrame, labelled: int = LABELLED) -> Weights:
    """Weights from ``html`` rows with a marked article: the ``labelled`` of the smallest hashes, and what
    equals them. The counts are added up in Spark; names seen at least ``LEAST_SEEN`` times in the bounded
    sample come to the driver."""
    marked = pages.where(F.col("html").rlike(r"(?i)<article[\s>]")).select("html", F.xxhash64("html").alias("place"))
    places = marked.select("place").distinct().orderBy("place").limit(labelled)
    highest = places.agg(F.max("place")).first()[0]
    if highest is None:
        return Weights()
    schema = fields(kind="string", name="string", content="boolean", times="long")

    def counted(batches):
        counts = Counts()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                counts.learn(page)
        keys = list(counts.found)
        columns = [[key[k] for key in keys] for k in range(3)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.bool_()), pa.array(list(counts.found.values()), pa.int64())],
            names=schema.names,
        )

    sums = marked.where(F.col("place") <= highest).select("html").mapInArrow(counted, schema).groupBy("kind", "name").agg(
        F.sum(F.when(F.col("content"), F.col("times")).otherwise(0)).alias("content"), F.sum(F.when(F.col("content"), 0).otherwise(F.col("times"))).alias("other")
    )
    rows = sums.where(F.col("content") + F.col("other") >= LEAST_SEEN).collect()
    return Weights.of({(row.kind, row.name, content): row.content if content else row.other for row in rows for content in (True, False)})


def extract_text(pages: DataFrame, weights: Weights | None = None, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row; weights are learned from the pages unless given.

    A missing page has the empty text. Repeated rows stay; other columns do not matter; no pages give no rows.
    """
    rows = renamed(pages, page_id=id_column, url=url_column, html=html_column)
    learned = learn_weights(rows) if weights is None else weights

    @arrow_udf(T.StringType())
    def text(page: pa.Array) -> pa.Array:
        return pa.array([main_text(one, learned) for one in page.to_pylist()], pa.string())

    found = rows.select("page_id", "url", text("html").alias("text"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query()
def op12_html_text(spark, sf_dir):
    """The main text of all pages."""
    return extract_text(table(spark, sf_dir, "pages"))
