"""Main text of web pages by wrappers: union-free regular expressions inferred per host.

A page is a stream of tags and texts. Its elements are told apart by labels (tag, and the words of class, id, role and
itemprop without digits) and by the path of labels from the top; an element nested in one of the same label shares its path.

Learning. What stands inside an element is a sequence of labels. Neighbouring repeats of a unit (up to ``UNIT`` labels) fold
into a repeated group, ``(h2 p)+``. The sequences that one path has, on all pages of a host, are aligned one after the other:
labels both have stay, labels only one has become optional, ``(aside)?``, and repeats fold again. Texts of a path become a
fixed text (all the same) or a slot. Tasks align what they read and add up sizes; the tables of all tasks are summed by
host, path and expression, and the few expressions left are aligned in order. All pages count.

Using. A host's wrapper says which slots are the main text: those below article elements that are not themselves inside
unwanted elements; failing that, below main elements, elements named as articles or contents, article elements anywhere, and
last the deepest path that holds ``SHARE`` of the variable text outside links. Unwanted elements (menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles, reader comments) are known by tag or by a word of their label. A page
takes the first of these alternatives in which it has text. In the last alternative alone, fixed texts of hosts
with several pages and paths that are mostly links are no slots.

Inside a kept element no text is dropped or cut. Elements that are displayed inside a line (b, a, span, ...) don't end a
block, and a line break counts as white space.

Defined results: null or empty html gives empty text and 0. Pages without a host (null or odd url) share one wrapper.
Unclosed elements end where a sibling or their parent ends; an unclosed comment or script runs to the end of the page. Very long
pages and very deep nesting are read whole (paths end at ``DEPTH`` labels). Repeated rows get the same answer, and an empty table
an empty result. Other columns are not read.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill.sources.checkpoints import written

UNIT = 8
DEPTH = 64
SHARE = 0.8
HELD_PATHS = 50_000
#: Largest table of slots that is sent to every task; above it, pages and slots meet in a shuffled join.
BROADCAST_BYTES = 32 << 20

# Elements of HTML by the part they play.
INLINE = frozenset(
    "a abbr acronym audio b bdi bdo big br button canvas cite code data datalist del dfn em embed font i iframe img input ins kbd "
    "label map mark math meter nobr noscript object output picture progress q rb rp rt rtc ruby s samp script select small span "
    "strike strong style sub sup svg template textarea time tt u var video wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
IN_HEAD = frozenset("base link meta noscript script style template title".split())
UNWANTED_TAGS = frozenset(
    "aside audio button canvas dialog embed fieldset footer form frameset head iframe input menu nav noembed noframes noscript "
    "object script select style svg template textarea title video".split()
)
#: Elements that end an open element of the first kind, unless one of the last kind stands between.
ENDED_BY = {
    "li": ("li", ("ul", "ol", "menu")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table",)),
    "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")),
    "thead": ("tr td th thead tbody tfoot", ("table",)),
    "tbody": ("tr td th thead tbody tfoot", ("table",)),
    "tfoot": ("tr td th thead tbody tfoot", ("table",)),
    "option": ("option", ("select",)),
}
#: Words of a class, id or role that name something other than the article.
UNWANTED_WORDS = frozenset(
    "ad ads adslot adsense advert advertisement advertising alert banner breadcrumb breadcrumbs comment comments complementary "
    "consent contentinfo cookie cookies dialog discussion disqus footer gdpr login menu modal nav navbar navigation newsletter "
    "notice notification overlay pager pagination paywall popup promo promotion recommended related replies reply respond "
    "search share sharing sidebar signup social sponsor sponsored subscribe teaser toast toolbar tooltip trending widget".split()
)
HEADER_WORDS = frozenset("header masthead topbar".split())
ARTICLE_WORDS = frozenset("article articlebody entry post story".split())
CONTENT_WORDS = frozenset("content main".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)>?", re.DOTALL
)
NAMED = re.compile(r"""(?:^|[\s"'/])(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


def label_of(tag: str, attributes: str) -> str:
    """The tag and its names' words: ``div.post-body``."""
    words: dict[str, None] = {}
    if attributes:
        for _, value in NAMED.findall(attributes):
            for word in WORD.findall(value):
                words[word.lower()] = None
    return f"{tag}.{'-'.join(words)}" if words else tag


def _parts(label: str) -> tuple[str, frozenset[str]]:
    tag, _, words = label.partition(".")
    return tag, frozenset(words.split("-")) if words else frozenset()


def is_unwanted(label: str) -> bool:
    """Whether an element is something other than the article by its own label."""
    tag, words = _parts(label)
    if tag in ("html", "body"):
        return False
    return tag in UNWANTED_TAGS or bool(words & UNWANTED_WORDS)


def is_header(label: str) -> bool:
    tag, words = _parts(label)
    return tag == "header" or (tag not in ("html", "body") and bool(words & HEADER_WORDS))


class Page:
    """Elements and texts of a page, in order, without a tree of objects."""

    def __init__(self, source: str):
        #: Of each element: its path, and the labels of its children.
        self.paths: list[str] = [""]
        self.children: list[list[str]] = [[]]
        #: Of each text: its element, block, text, and whether it is in a link.
        self.texts: list[tuple[int, int, str, bool]] = []
        self._labels, self._depths = [""], [0]
        self._open: list[tuple[int, str]] = [(0, "")]
        self._counts: Counter = Counter()
        self._block = self._links = 0
        self._read(source)

    def _text(self, raw: str) -> None:
        if raw:
            self.texts.append((self._open[-1][0], self._block, html.unescape(raw), self._links > 0))

    def _push(self, tag: str, label: str) -> None:
        parent = self._open[-1][0]
        self.children[parent].append(label)
        if label == self._labels[parent] or self._depths[parent] >= DEPTH:
            self.paths.append(self.paths[parent])
            self._depths.append(self._depths[parent])
        else:
            self.paths.append(f"{self.paths[parent]}/{label}")
            self._depths.append(self._depths[parent] + 1)
        self._labels.append(label)
        self.children.append([])
        self._open.append((len(self.paths) - 1, tag))
        self._counts[tag] += 1

    def _pop(self, at: int) -> None:
        for _, tag in self._open[at:]:
            self._counts[tag] -= 1
        del self._open[at:]

    def _end(self, tags: tuple[str, ...], bounds: tuple[str, ...] = ()) -> bool:
        """Ends the innermost open element of these tags, and what is open in it."""
        if not any(self._counts[tag] for tag in tags):
            return False
        for at in range(len(self._open) - 1, 0, -1):
            tag = self._open[at][1]
            if tag in tags:
                self._pop(at)
                return True
            if tag in bounds:
                return False
        return False

    def _begin(self, tag: str, attributes: str) -> None:
        label = label_of(tag, attributes)
        if tag in INLINE:
            if tag == "br":
                self._text(" ")
            elif tag == "a":
                self._links = 1
            # Inside a line, only what is unwanted is an element of its own (and what looks like it inside).
            if tag not in VOID and (is_unwanted(label) or self._open[-1][1] == tag):
                self._push(tag, label)
            return
        self._block += 1
        if self._open[-1][1] == "head" and tag not in IN_HEAD:
            self._pop(len(self._open) - 1)
        if tag in ("html", "body") and self._counts[tag]:
            return
        self._end(("p",), ("article", "aside", "div", "li", "main", "section", "td"))
        if tag in ENDED_BY:
            ended, bounds = ENDED_BY[tag]
            while self._end(tuple(ended.split()), bounds):
                pass
        if tag not in VOID:
            self._push(tag, label)

    def _read(self, source: str) -> None:
        at = 0
        while True:
            found = TAG.search(source, at)
            if found is None:
                self._text(source[at:])
                return
            self._text(source[at : found.start()])
            at = found.end()
            tag = (found[2] or "").lower()
            if not tag:
                continue
            if not found[1]:
                if tag in RAW:
                    end = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|\\Z)[^>]*>?", re.IGNORECASE).search(source, at)
                    at = end.end() if end else len(source)
                    continue
                self._begin(tag, found[3])
            elif tag == "a" and self._open[-1][1] != "a":
                self._links = 0
            elif tag in INLINE:
                if self._open[-1][1] == tag:
                    self._pop(len(self._open) - 1)
                if tag == "a":
                    self._links = 0
            elif tag not in ("html", "body"):
                # Text behind the end of the body still belongs to it.
                self._block += 1
                self._end((tag,))


# Expressions: a list of items (unit, many, optional), a unit being a tuple of labels.
Item = tuple[tuple[str, ...], bool, bool]


def fold(items: list[Item]) -> list[Item]:
    """Neighbouring repeats of one unit, or of up to UNIT single items, as one repeated group."""
    out: list[Item] = []
    for item in items:
        if out and out[-1][0] == item[0]:
            unit, _, optional = out.pop()
            out.append((unit, True, optional and item[2]))
        else:
            out.append(item)
    for size in range(2, UNIT + 1):
        at = 0
        while at + 2 * size <= len(out):
            first, second = out[at : at + size], out[at + size : at + 2 * size]
            if any(len(unit) > 1 for unit, _, _ in first) or [x[0] for x in first] != [x[0] for x in second]:
                at += 1
                continue
            count = 2
            while [x[0] for x in out[at + count * size : at + (count + 1) * size]] == [x[0] for x in first]:
                count += 1
            group = tuple(unit[0] for unit, _, _ in first)
            optional = all(x[2] for x in out[at : at + count * size])
            out[at : at + count * size] = [(group, True, optional)]
            at += 1
    return out


def expression(labels: list[str]) -> list[Item]:
    return fold([((label,), False, False) for label in labels])


def align(left: list[Item], right: list[Item]) -> list[Item]:
    """The least expression of this form for both: common items stay, others become optional, repeats fold."""
    if left == right:
        return left
    matcher = SequenceMatcher(None, [item[0] for item in left], [item[0] for item in right], autojunk=False)
    out: list[Item] = []
    for kind, a, b, c, d in matcher.get_opcodes():
        if kind == "equal":
            out += [(x[0], x[1] or y[1], x[2] or y[2]) for x, y in zip(left[a:b], right[c:d], strict=True)]
        else:
            out += [(unit, many, True) for unit, many, _ in (*left[a:b], *right[c:d])]
    return fold(out)


def _packed(items: list[Item]) -> str:
    return json.dumps(items, separators=(",", ":"), ensure_ascii=False)


def _unpacked(text: str) -> list[Item]:
    return [(tuple(unit), many, optional) for unit, many, optional in json.loads(text)]


def _digest(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


class Learned:
    """What pages of a host have at one path."""

    __slots__ = ("chars", "high", "items", "link_chars", "low", "pages", "texts")

    def __init__(self):
        self.pages = self.texts = self.chars = self.link_chars = 0
        self.low = self.high = None
        self.items: list[Item] | None = None

    def add_text(self, text: str, linked: bool) -> None:
        self.texts += 1
        self.chars += len(text)
        self.link_chars += len(text) if linked else 0
        number = _digest(text)
        self.low = number if self.low is None else min(self.low, number)
        self.high = number if self.high is None else max(self.high, number)

    def add_children(self, labels: list[str]) -> None:
        items = expression(labels)
        self.items = items if self.items is None else align(self.items, items)


def learn_page(page: Page, paths: dict[str, Learned]) -> None:
    """Adds a page to the paths of its host."""
    for path, children in zip(page.paths, page.children, strict=True):
        paths.setdefault(path, Learned()).add_children(children)
    for path in set(page.paths):
        paths[path].pages += 1
    for element, _, text, linked in page.texts:
        text = " ".join(text.split())
        if text:
            paths[page.paths[element]].add_text(text, linked)


def _sources(column: pa.Array) -> Iterator[str]:
    """Html of a column, null as empty and bytes that are no UTF-8 replaced."""
    return ((source.as_py() or b"").decode("utf-8", "replace") for source in column.cast(pa.binary()))


LEARNED = "host string, path string, pages long, texts long, chars long, link_chars long, low long, high long, items string"


def learned(pages: DataFrame) -> DataFrame:
    """(host, path, pages, texts, chars, link_chars, low, high, items): what tasks learn, summed over equal expressions."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hosts: dict[str, dict[str, Learned]] = {}

        def rows() -> pa.RecordBatch:
            flat = [
                (host, path, x.pages, x.texts, x.chars, x.link_chars, x.low, x.high, _packed(x.items or []))
                for host, paths in sorted(hosts.items())
                for path, x in sorted(paths.items())
            ]
            types = [pa.string(), pa.string(), *[pa.int64()] * 6, pa.string()]
            names = ["host", "path", "pages", "texts", "chars", "link_chars", "low", "high", "items"]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*flat, strict=True), types, strict=True)], names)

        for batch in batches:
            for host, source in zip(batch.column("host").to_pylist(), _sources(batch.column("html")), strict=True):
                learn_page(Page(source), hosts.setdefault(host, {}))
                if sum(map(len, hosts.values())) > HELD_PATHS:
                    yield rows()
                    hosts = {}
        if hosts:
            yield rows()

    sums = [F.sum(name).alias(name) for name in ("pages", "texts", "chars", "link_chars")]
    found = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(learn, LEARNED)
    return found.groupBy("host", "path", "items").agg(*sums, F.min("low").alias("low"), F.max("high").alias("high"))


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.coalesce(found, F.lit("")))


class Wrapper:
    """A host's paths, each with its expression; texts are fixed or slots."""

    def __init__(self, paths: dict[str, Learned]):
        self.paths = paths
        self.pages = max((x.pages for x in paths.values()), default=0)

    def fixed(self, path: str) -> bool:
        """Whether all pages of the host have the same text here."""
        x = self.paths[path]
        return x.texts > 1 and x.pages > 1 and x.low == x.high

    def pattern(self, path: str = "") -> str:
        """The expression of a path, with those of the elements inside it."""
        x = self.paths[path]
        out = [] if not x.texts else ["'text'" if self.fixed(path) else "#"]
        own = path.rpartition("/")[2]
        for unit, many, optional in x.items or []:
            inner = []
            for label in unit:
                below = f"{path}/{label}"
                inside = self.pattern(below) if label != own and below in self.paths else ""
                inner.append(f"{label}[{inside}]" if inside else label)
            body = " ".join(inner)
            body = f"({body})" if len(unit) > 1 else body
            out.append(body + {(True, True): "*", (True, False): "+", (False, True): "?", (False, False): ""}[many, optional])
        return " ".join(out)

    def _slots(self, is_root: Callable[[str], bool], anywhere: bool = False) -> list[str]:
        """Paths with text below a root, without unwanted elements on the way; above it only if ``anywhere``."""
        found = []
        for path, x in sorted(self.paths.items()):
            rooted = False
            for label in path.split("/")[1:]:
                if rooted or not anywhere:
                    if is_unwanted(label) or (not rooted and is_header(label)):
                        rooted = False
                        break
                rooted = rooted or is_root(label)
            if rooted and x.texts:
                found.append(path)
        return found

    def _densest(self, variable: bool = True) -> list[str]:
        """Slots below the deepest path that holds most of the variable text outside links (of all, where none varies)."""
        mass: dict[str, int] = {}
        own: dict[str, int] = {}
        for path, x in self.paths.items():
            labels = path.split("/")[1:]
            if not x.texts or variable and self.fixed(path) or 2 * x.link_chars > x.chars:
                continue
            if any(is_unwanted(label) or is_header(label) for label in labels):
                continue
            own[path] = x.chars - x.link_chars
            for depth in range(len(labels) + 1):
                above = "/".join(["", *labels[:depth]]) if depth else ""
                mass[above] = mass.get(above, 0) + own[path]
        if not own and variable:
            return self._densest(variable=False)
        root = ""
        while True:
            inside = [path for path in mass if path.rpartition("/")[0] == root and path]
            best = max(inside, key=lambda path: (mass[path], path), default=None)
            if best is None or mass[best] < SHARE * mass.get(root, 0) or self._is_one(best):
                break
            root = best
        return sorted(path for path in own if path == root or path.startswith(f"{root}/") or not root)

    def _is_one(self, path: str) -> bool:
        """Whether a path stands for single blocks of text, which are no place for an article."""
        return path.rpartition("/")[2].partition(".")[0] in {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "pre", "blockquote"}

    def alternatives(self) -> list[list[str]]:
        """Slots of the main text, by the ways to find it."""

        def named(words: frozenset[str]) -> Callable[[str], bool]:
            return lambda label: bool(_parts(label)[1] & words) and _parts(label)[0] not in ("html", "body")

        found = [
            self._slots(lambda label: _parts(label)[0] == "article"),
            self._slots(lambda label: _parts(label)[0] == "main"),
            self._slots(named(ARTICLE_WORDS)),
            self._slots(named(CONTENT_WORDS)),
            self._slots(lambda label: _parts(label)[0] in ("article", "main"), anywhere=True),
            self._densest(),
        ]
        return [slots for slots in found if slots]


def _merged(rows: Iterator[dict]) -> Iterator[tuple[str, Wrapper]]:
    """Wrappers from rows that are sorted by host and path."""
    host, paths = None, {}
    for row in rows:
        if row["host"] != host:
            if paths:
                yield host, Wrapper(paths)
            host, paths = row["host"], {}
        x = paths.setdefault(row["path"], Learned())
        for name in ("pages", "texts", "chars", "link_chars"):
            setattr(x, name, getattr(x, name) + row[name])
        if row["low"] is not None:
            x.low = row["low"] if x.low is None else min(x.low, row["low"])
            x.high = row["high"] if x.high is None else max(x.high, row["high"])
        items = _unpacked(row["items"])
        x.items = items if x.items is None else align(x.items, items)
    if paths:
        yield host, Wrapper(paths)


def wrappers(pages: DataFrame) -> DataFrame:
    """Per host: its number of pages, its wrapper as an expression, and ``slots``, the alternatives of main text (as JSON)."""

    def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        for host, wrapper in _merged(rows):
            slots = json.dumps(wrapper.alternatives(), separators=(",", ":"), ensure_ascii=False)
            values = [[host], [wrapper.pages], [wrapper.pattern()], [slots]]
            types = [pa.string(), pa.int64(), pa.string(), pa.string()]
            arrays = [pa.array(value, kind) for value, kind in zip(values, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["host", "pages", "wrapper", "slots"])

    # One row per path and expression is left; hosts are dealt out whole.
    sorted_rows = learned(pages).repartition("host").sortWithinPartitions("host", "path", "items")
    return sorted_rows.mapInArrow(infer, "host string, pages long, wrapper string, slots string")


def main_text(page: Page, alternatives: list[frozenset[str]]) -> str:
    """The blocks of text in the first alternative's slots that this page has."""
    for slots in alternatives:
        blocks: dict[int, list[str]] = {}
        for element, block, text, _ in page.texts:
            if page.paths[element] in slots:
                blocks.setdefault(block, []).append(text)
        lines = [" ".join("".join(parts).split()) for parts in blocks.values()]
        lines = [line for line in lines if line]
        if lines:
            return "\n".join(lines)
    return ""


def extract(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The kept columns (page_id and url by default), text and n_chars."""
    keep = ["page_id", "url"] if keep is None else keep
    slots = written(wrappers(pages).select(F.col("host").alias("_host"), F.col("slots").alias("_slots")))
    size = slots.agg(F.sum(F.octet_length("_host") + F.octet_length("_slots"))).first()[0] or 0
    columns = [*[F.col(name) for name in keep], F.col("html").alias("_html"), host_of(F.col("url")).alias("_host")]
    # Either way the pages stay where they are, or are dealt by host in a join whose large partitions Spark splits.
    match = F.broadcast(slots) if size <= BROADCAST_BYTES else slots
    joined = pages.select(*columns).join(match, "_host", "left").drop("_host")
    schema = joined.select(*keep).schema.add("text", "string").add("n_chars", "long")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[frozenset[str]]] = {}
        for batch in batches:
            texts = []
            for source, slots in zip(_sources(batch.column("_html")), batch.column("_slots").to_pylist(), strict=True):
                if slots not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[slots] = [frozenset(paths) for paths in json.loads(slots or "[]")]
                texts.append(main_text(Page(source), known[slots]))
            arrays = [batch.column(name) for name in keep]
            arrays += [pa.array(texts, pa.string()), pa.array([len(text) for text in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())

    return joined.mapInArrow(read, schema)
