"""Main text of web pages: element roles and the host's repeated stretches.

A page is read into blocks (runs of text between block-level tags) with
the role their elements give them: *chrome* (menus, headers, footers,
asides, forms, adverts, notices, reader comments), *article* (inside
``article``), *main* (inside ``main``), or *open*.  Scripts, styles,
comments and the head are no text.  A class or id makes an element chrome
if its last word that says more than a place or a box is a listed one and
no word negates it.  On a page whose article and main elements all lie in
elements that are chrome by class or id only, those elements are not.

Every page's blocks, whatever their role, form its token stream, blocks
set apart by a mark.  A stretch of the host's streams is boilerplate if it
is a whole block or has at least ``LONG`` tokens, and occurs on enough
pages: ``SHARES`` of the host's pages, more for stretches inside an
article or main element.  Pages with equal main text count once, so copies
of an article do not remove each other; and where more than half of a
page's article or main text would go, it is a near copy and stays.  The
text is all blocks that are not chrome, less the boilerplate.

No suffix array is built.  The tokens under LCP intervals of depth
``LONG`` or more that reach the page count are those under ``LONG``-token
windows that reach it, so windows are counted by a digest of host and
tokens.  Only windows whose minimiser (the ``GRAM``-token run of least
digest in it) is on enough pages itself, and holds text on one, are
counted: a frequent window of text has such a minimiser, so none is lost.
Sets of keys go to the executors as bits, which let some others through;
counts and joins are exact.

A page is parsed once, into a table of its blocks, roles and keys.  Keys
of pages whose main text no other page has are summed at once, without a
distinct count; the others are made distinct by main text first.

White space inside a block becomes one blank, blocks are joined by a line
break, character references are decoded.  Null or empty html gives an
empty text, a null url the host "".  Rows are handled one by one; repeated
rows give repeated results; other columns pass through, and input columns
named ``text`` or ``n_chars`` are replaced.  Executors need this package on
their path (:func:`logsift.llm.common.ship`).
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, text_bytes, text_groups, written

#: Tokens that must repeat for a part of a block to count as boilerplate.
LONG = 24
#: Tokens of the runs that stand for a window.
GRAM = 8
#: (least pages, share of the host's pages) of boilerplate outside, and
#: inside, an article or main element.
SHARES = ((2, 0.1), (3, 0.25))
MARK = "\n"
_MARK = np.uint64(xxhash.xxh3_64_intdigest(MARK))
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

# HTML element names by what they mean for text.
RAW = frozenset("script style noscript template iframe textarea title svg math object".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table "
    "tbody td tfoot th thead tr ul".split()
)
CHROME = frozenset("nav footer aside form head menu button select dialog".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
CHROME_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo cookie cookies consent gdpr notice notices popup "
    "modal newsletter subscribe sidebar menu nav navbar navigation breadcrumb breadcrumbs header masthead footer comment comments disqus "
    "replies share sharing social login signup".split()
)
# Words of a class that say where or what kind of box an element is.
BOX_NAMES = frozenset(
    "container wrapper wrap inner outer box area block section list widget bar left right top bottom item items link links button buttons form slot unit icons body content main primary secondary".split()
)
NEGATING = frozenset("no not non without with has".split())
# A header of the site, not of a text.
SITE_NAMES = frozenset("site global top".split())
COMMENT_NAMES = frozenset("comment comments disqus replies".split())
ENDS_P = BLOCK - {"option", "optgroup", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "legend", "summary", "dd", "dt", "li", "head", "body", "html"}
SAME_ENDS = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


@dataclass
class Page:
    """Blocks of a page in order, each with its role."""

    blocks: list[tuple[str, str]] = field(default_factory=list)

    def text(self, role: str) -> str:
        return "\n".join([t for r, t in self.blocks if r == role])

    def main_role(self) -> str:
        roles = {r for r, _ in self.blocks}
        return next((r for r in ("article", "main") if r in roles), "open")

    def stream(self) -> list[str]:
        """Tokens of all blocks, a mark before each block."""
        return [w for _, t in self.blocks for w in (MARK, *t.split(" "))]

    def is_text(self) -> np.ndarray:
        """Mask of the stream's tokens that are not chrome."""
        return np.repeat([r != "chrome" for r, _ in self.blocks], [t.count(" ") + 2 for _, t in self.blocks]).astype(bool)


def _names_chrome(value: str) -> set[str]:
    """The listed words that the names of a class or id stand for."""
    found = set()
    for name in value.split():
        said = [w.lower() for w in _NAME.findall(name)]
        while len(said) > 1 and (said[-1] in BOX_NAMES or said[-1].isdigit()):
            said.pop()
        if not said or said[-1] not in CHROME_NAMES or NEGATING.intersection(said):
            continue
        if said[-1] != "header" or SITE_NAMES.issuperset(said[:-1]):
            found.add(said[-1])
    return found


def _is_chrome(tag: str, attrs: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is chrome by tag or role, and by class or id."""
    if tag in CHROME or (tag == "header" and not in_article):
        return True, False
    if not attrs or tag in ("html", "body"):
        return False, False
    listed = set()
    for name, value in _ATTR.findall(attrs):
        name, value = name.lower(), entities.unescape(value.strip("\"'"))
        if name == "role" and value.lower() in CHROME_ROLES and tag not in ("article", "main"):
            return True, False
        if name in ("class", "id"):
            listed |= _names_chrome(value)
    if tag in ("article", "main"):
        listed &= COMMENT_NAMES
    elif in_article:
        listed -= {"header", "masthead"}
    return False, bool(listed)


def read_page(source: str) -> Page:
    # element, inside chrome by tag, elements around that are chrome by name, role of text
    stack: list[tuple[str, bool, tuple[int, ...], str]] = []
    blocks: list[tuple[bool, tuple[int, ...], str, str]] = []
    mains: list[tuple[int, ...]] = []  # elements around each article or main that are chrome by name
    outside = (False, (), "open")
    run: list[str] = []
    place, n = 0, len(source)

    def close() -> None:
        if run:
            text = " ".join(entities.unescape("".join(run)).split())
            run.clear()
            if text:
                blocks.append((*(stack[-1][1:] if stack else outside), text))

    while place < n:
        m = _TAG.search(source, place)
        if m is None:
            run.append(source[place:])
            break
        if m.start() > place:
            run.append(source[place : m.start()])
        place = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag in BLOCK:
                close()
            at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if at is not None:
                after = stack[at - 1][1:] if at else outside
                if stack[-1][1:] != after:
                    close()
                del stack[at:]
            continue
        if tag in RAW:
            if not m[3].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, place)
                place = end.end() if end else n
            continue
        if tag in BLOCK:
            close()
        elif tag == "br":
            run.append(" ")
        if tag in VOID:
            continue
        ends = SAME_ENDS.get(tag, set()) | ({"p"} if tag in ENDS_P else set())
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in ends:
                del stack[k:]
                break
            if stack[k][0] in BLOCK:
                break
        chrome, named, role = stack[-1][1:] if stack else outside
        own, by_name = _is_chrome(tag, m[3], role in ("article", "main"))
        if own and not chrome or by_name:
            close()
        if by_name:
            named = (*named, place)
        if tag == "article":
            role = "article"
        elif role == "open" and (tag == "main" or "role" in m[3] and re.search(r"""role\s*=\s*["']?main""", m[3])):
            role = "main"
        if not (chrome or own) and not by_name and role != (stack[-1][3] if stack else "open"):
            mains.append(named)
        stack.append((tag, chrome or own, named, role))
    close()
    freed = set() if () in mains else {k for around in mains for k in around}
    return Page([("chrome" if chrome or not freed.issuperset(named) else role, text) for chrome, named, role, text in blocks])


def host_of(url: str | None) -> str:
    m = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def _digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)


class _Words(dict):
    """Digests of words.  Bounded: it keeps no more when large."""

    LIMIT = 300_000

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh3_64_intdigest(word.encode())
        if len(self) < self.LIMIT:
            self[word] = value
        return value


_words = _Words()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * _MIX
    return x ^ x >> np.uint64(29)


def _runs(x: np.ndarray, size: int, step: int = 1) -> np.ndarray:
    """Digest of ``size`` values, ``step`` apart, from each place."""
    n = len(x) - (size - 1) * step
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * _BASE + x[k * step : k * step + n]
    return _mixed(out)


def _least(x: np.ndarray, size: int) -> np.ndarray:
    """The least of ``size`` values from each place."""
    wide = 1
    while wide < size:
        more = min(wide, size - wide)
        x = np.minimum(x[:-more], x[more:])
        wide += more
    return x


class Stream:
    """Keys of a page's token stream on its host: of each block, of the
    window from each place, and of each window's minimiser."""

    def __init__(self, host: int, stream: list[str]):
        tokens = np.array([_words[w] for w in stream], np.uint64)
        host = np.uint64(host & 0xFFFFFFFFFFFFFFFF)
        self.size = len(tokens)
        self.starts = np.flatnonzero(tokens == _MARK)  # the blocks' marks
        self.stops = np.r_[self.starts[1:], self.size].astype(np.int64)
        whole = [xxhash.xxh3_64_intdigest(" ".join(stream[a:b]).encode()) for a, b in zip(self.starts.tolist(), self.stops.tolist(), strict=False)]
        self.blocks = _mixed(np.array(whole, np.uint64) ^ host).view(np.int64)
        grams = _runs(tokens, GRAM)
        self.windows = _mixed(_runs(grams, LONG // GRAM, GRAM) ^ host).view(np.int64)
        if len(self.windows):
            grams = _least(grams, LONG - GRAM + 1)
        self.minimisers = _mixed((grams + np.uint64(1)) ^ host).view(np.int64) if len(self.windows) else self.windows

    def covered(self, keys: np.ndarray) -> np.ndarray:
        """Mask of the tokens in blocks or windows with one of the keys."""
        edge = np.zeros(self.size + 1, np.int64)
        hit = np.isin(self.blocks, keys)
        np.add.at(edge, self.starts[hit], 1)
        np.add.at(edge, self.stops[hit], -1)
        at = np.flatnonzero(np.isin(self.windows, keys))
        np.add.at(edge, at, 1)
        np.add.at(edge, at + LONG, -1)
        return np.cumsum(edge)[:-1] > 0

    def of_text(self, text: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Masks of the blocks, and of ``windows``, that hold a place of ``text``."""
        before = np.r_[0, np.cumsum(text)]
        at = np.arange(len(windows))
        return before[self.stops] > before[self.starts], before[at + LONG] > before[at]


class _Filter:
    """Bits of a set of keys: a key without its bit is not in the set.  At
    most 64 MB; the executors put the bits of a word together."""

    def __init__(self, keys: DataFrame, column: str):
        n = keys.count()
        self.words = np.zeros(1 << min(max(10, (16 * n).bit_length() - 6), 23), np.int64)
        if n:
            word = F.shiftright(F.pmod(F.col(column), F.lit(64 * len(self.words))), 6)
            words = keys.groupBy(word.cast("int").alias("word")).agg(F.expr(f"bit_or(shiftleft(1L, cast(pmod({column}, 64) as int)))").alias("bits"))
            lists = [F.collect_list(c).alias(c) for c in ("word", "bits")]
            for at, bits in words.groupBy(F.spark_partition_id().alias("part")).agg(*lists).select("word", "bits").toLocalIterator():
                self.words[at] |= np.array(bits, np.int64)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        at = keys & (64 * len(self.words) - 1)
        return (self.words[at >> 6] >> (at & 63) & 1).astype(bool)


def _column(part: pa.RecordBatch, name: str) -> pa.Array:
    return part.column(part.schema.get_field_index(name))


READ = "page bigint, host bigint, main bigint, roles string, blocks string, keys array<bigint>, n_text int"


def read_pages(pages: DataFrame, keep: list[str]) -> DataFrame:
    """Each page read once, as (row, page, host, main, roles, blocks, keys,
    n_text): the columns to keep, a number of its own, digests of host and
    main text, the blocks (one a line) with the first letters of their
    roles, and the distinct keys of its blocks and minimisers, of which the
    first ``n_text`` hold text."""
    quoted = [F.col("`" + c.replace("`", "``") + "`") for c in keep]
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    source = pages.select(F.struct(*quoted).alias("row"), F.col("url").cast("string").alias("url"), html)
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.int32()]
    names = ["row", "page", "host", "main", "roles", "blocks", "keys", "n_text"]

    def read(url: str | None, raw: bytes) -> tuple:
        page, host = read_page(raw.decode()), _digest(host_of(url))
        s = Stream(host, page.stream())
        block, window = s.of_text(page.is_text(), s.minimisers)
        text = np.unique(np.r_[s.blocks[block], s.minimisers[window]])
        rest = np.setdiff1d(np.r_[s.blocks[~block], s.minimisers[~window]], text)
        roles = "".join([r[0] for r, _ in page.blocks])
        return host, _digest(page.text(page.main_role())), roles, "\n".join([t for _, t in page.blocks]), np.r_[text, rest], len(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for part in text_groups(batches, column="html"):
            found = [read(*p) for p in zip(_column(part, "url").to_pylist(), text_bytes(part, "html"), strict=True)]
            page = _mixed(np.arange(number, number + len(found), dtype=np.uint64)).view(np.int64)
            number += len(found)
            cols = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([_column(part, "row"), pa.array(page), *cols], names=names)

    row = T.StructType([source.schema["row"], *T.StructType.fromDDL(READ).fields])
    return source.mapInArrow(run, row)


def stored_page(roles: str, blocks: str) -> Page:
    names = {r[0]: r for r in ("chrome", "article", "main", "open")}
    return Page([(names[r], t) for r, t in zip(roles, blocks.split("\n"), strict=True)] if roles else [])


def _keys(read: DataFrame, twins: Broadcast, twin: bool) -> DataFrame:
    """(host, main, key, text): the stored keys of the pages whose main text
    has, or has not, a bit in ``twins``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            part = part.filter(pa.array(twins.value[_column(part, "main").to_numpy()] == twin))
            if part.num_rows:
                keys = _column(part, "keys")
                sizes = keys.value_lengths().to_numpy()
                at = pa.array(np.repeat(np.arange(len(sizes)), sizes))
                place = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                text = place < np.repeat(_column(part, "n_text").to_numpy(), sizes)
                cols = [_column(part, "host").take(at), _column(part, "main").take(at), keys.flatten(), pa.array(text)]
                yield pa.RecordBatch.from_arrays(cols, names=["host", "main", "key", "text"])

    return read.select("host", "main", "keys", "n_text").mapInArrow(run, "host bigint, main bigint, key bigint, text boolean")


def _windows(read: DataFrame, near: Broadcast, twins: Broadcast) -> DataFrame:
    """(page, host, main, key, text, window, twin): distinct windows with a
    minimiser in ``near``, and the blocks of text in it, of every page."""
    schema = "page bigint, host bigint, main bigint, key bigint, text boolean, window boolean, twin boolean"
    names = [c.split()[0] for c in schema.split(", ")]

    def of_page(host: int, page: Page) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        s = Stream(host, page.stream())
        block, window = s.of_text(page.is_text(), s.windows)
        blocks = np.unique(s.blocks[block])
        blocks = blocks[near.value[blocks]]
        hit = near.value[s.minimisers]
        text = np.unique(s.windows[hit & window])
        rest = np.setdiff1d(s.windows[hit & ~window], text)
        place = np.arange(len(blocks) + len(text) + len(rest))
        return np.r_[blocks, text, rest], place < len(blocks) + len(text), place >= len(blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_groups(batches, column="blocks"):
            keys = _column(part, "keys")
            sizes = keys.value_lengths().to_numpy()
            hits = np.r_[0, np.cumsum(near.value[keys.flatten().to_numpy()])]
            ends = np.cumsum(sizes)
            part = part.filter(pa.array(hits[ends] > hits[ends - sizes]))
            if not part.num_rows:
                continue
            pages = zip(*(_column(part, c).to_pylist() for c in ("host", "roles", "blocks")), strict=True)
            found = [of_page(host, stored_page(roles, blocks)) for host, roles, blocks in pages]
            at = pa.array(np.repeat(np.arange(len(found)), [len(k) for k, _, _ in found]))
            cols = [_column(part, c).take(at) for c in ("page", "host", "main")]
            flat = [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays([*cols, *flat, pa.array(twins.value[cols[2].to_numpy()])], names=names)

    return read.select("page", "host", "main", "roles", "blocks", "keys").mapInArrow(run, schema)


def _frequent(single: DataFrame, several: DataFrame, limits: DataFrame) -> DataFrame:
    """(key, inner): keys of text on enough pages of their host, and whether
    these are enough inside an article or main element too.  Rows of
    ``single`` count one by one, those of ``several`` once per main text."""
    names = ["host", "key", "text"]
    once = several.groupBy("key", "main").agg(F.min("host").alias("host"), F.bool_or("text").alias("text"))
    found = single.select(names).unionByName(once.select(names))
    counted = found.groupBy("key").agg(F.count("*").alias("n"), F.min("host").alias("host"), F.bool_or("text").alias("text"))
    enough = counted.filter((F.col("n") >= SHARES[0][0]) & F.col("text")).join(limits, "host").filter("n >= outside")
    return written(enough.select("key", (F.col("n") >= F.col("inside")).alias("inner")), "keys")


def boilerplate(read: DataFrame) -> DataFrame:
    """(page, keys, inner): the keys of the repeated blocks and windows in
    the text of each page that has any, and those that count inside an
    article or main element."""
    share = read.sparkSession.sparkContext.broadcast
    mains = written(read.groupBy("host", "main").count(), "mains")
    enough = [F.greatest(F.lit(n), F.ceil(F.col("pages") * part)).alias(name) for name, (n, part) in zip(("outside", "inside"), SHARES, strict=True)]
    limits = mains.groupBy("host").agg(F.count("*").alias("pages")).select("host", *enough)
    twins = share(_Filter(mains.filter("count > 1"), "main"))
    first = _frequent(_keys(read, twins, False), _keys(read, twins, True), limits)
    near = written(_windows(read, share(_Filter(first, "key")), twins), "windows")
    windows = near.filter("window")
    second = _frequent(windows.filter("not twin"), windows.filter("twin"), limits)
    hits = near.filter("text").select("page", "key").join(first.unionByName(second), "key")
    hits = hits.groupBy("page").agg(F.collect_list("key").alias("keys"), F.collect_list(F.when(F.col("inner"), F.col("key"))).alias("inner"))
    hits = written(hits, "hits")
    discard(mains, first, near, second)
    return hits


def extract(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``pages`` (url, html, ...) with ``text`` and ``n_chars``; ``keep``
    names the columns to pass through, all by default.  They are written
    beside the blocks, so without html the written table is small."""
    pages = pages.drop("text", "n_chars")
    read = written(read_pages(pages, pages.columns if keep is None else keep), "pages", codec="zstd")
    hits = boilerplate(read)
    known = pages.sparkSession.sparkContext.broadcast(_Filter(hits, "page"))
    stored = read.select("row", "page", "host", "roles", "blocks")
    out = T.StructType([read.schema["row"], T.StructField("text", T.StringType())])

    def some(batches: Iterator[pa.RecordBatch], hit: bool) -> Iterator[pa.RecordBatch]:
        for part in batches:
            yield part.filter(pa.array(known.value[_column(part, "page").to_numpy()] == hit))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_groups(batches, column="blocks"):
            names = [c for c in ("roles", "blocks", "host", "keys", "inner") if c in part.schema.names]
            texts = [main_text(stored_page(*p[:2]), *p[2:]) for p in zip(*(_column(part, c).to_pylist() for c in names), strict=True)]
            yield pa.RecordBatch.from_arrays([_column(part, "row"), pa.array(texts, pa.string())], names=["row", "text"])

    clean = stored.mapInArrow(lambda batches: cut(some(batches, False)), out)
    joined = stored.mapInArrow(lambda batches: some(batches, True), stored.schema).join(hits, "page", "left").mapInArrow(cut, out)
    return clean.unionByName(joined).select("row.*", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def main_text(page: Page, host: int, keys: list[int] | None = None, inner: list[int] | None = None) -> str:
    """The blocks that are not chrome less the boilerplate; ``host`` is the
    digest of the host, ``inner`` what counts inside an article or main element."""
    if not keys:
        return "\n".join([t for role, t in page.blocks if role != "chrome"])
    s = Stream(host, page.stream())
    hidden, strong = (s.covered(np.array(k or [], np.int64)) for k in (keys, inner))
    blocks, at, inside, lost = [], 0, 0, 0
    for role, t in page.blocks:
        words = t.split(" ")
        at += 1  # the mark
        cover = (hidden if role == "open" else strong)[at : at + len(words)]
        at += len(words)
        if role in ("article", "main"):
            inside += len(words)
            lost += int(cover.sum())
        if role != "chrome":
            blocks.append((role, words, cover.tolist()))
    whole = 2 * lost > inside  # a near copy
    out = [" ".join([w for w, x in zip(words, cover, strict=True) if not x or whole and role != "open"]) for role, words, cover in blocks]
    return "\n".join([b for b in out if b])
