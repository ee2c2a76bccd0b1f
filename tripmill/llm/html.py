"""Main text of web pages: passages that a host repeats are found with suffix arrays, markup is evidence beside them.

A page is cut into blocks, and markup says of each what it is: inside an article, marked as something else (menus, headers,
footers, sidebars, notices, adverts, forms, comments), or neither. Scripts, styles and markup are no text. The token streams
of all blocks of all pages of a host are joined, and a suffix array gives the long substrings that stand on several pages.
The verdict on a block comes from both: see ``judge``.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from tripmill.llm.common import OUT_ROWS, ship, written

#: A substring is boilerplate from so many tokens on, and if it stands on so many pages of a group of a host.
LEAST_TOKENS = 6
LEAST_PAGES = 3
#: Pages whose streams are joined in one suffix array; the pages of a large host are dealt among groups by a hash.
GROUP_PAGES = 256

# HTML elements by what they mean for the text.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset("nav header footer aside form noscript template svg math canvas object select button dialog menu head audio video map datalist".split())
ARTICLE = frozenset("article main".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS_PARAGRAPH = BLOCK - frozenset("body html option optgroup".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
# Parts of class and id names that mark what is not the article.
MARKS = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumb\w*|header|masthead|footer|sidebar\w*|aside|"
    r"widget\w*|cookie\w*|consent|gdpr|notice|notification|popup|modal|overlay|newsletter|subscri\w*|signup|login|share|sharing|social|"
    r"related|recommend\w*|comment\w*|disqus|replies|respond|discussion|reviews?|copyright|legal|disclaimer|pagination|pager|skip\w*|toolbar)(?:$|[\s_-])",
    re.I,
)
COMMENT = re.compile(r"(?:^|\s)(?:comments?|reply|replies|response)(?:$|\s)", re.I)
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/<>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'<>]+))")

#: What markup says of a block: inside an article; inside an article in a container that class names mark; marked; nothing.
IN_ARTICLE, IN_NAMED, MARKED, OPEN = "anmo"

Block = tuple[str, int, str]


def _kind(name: str, attributes: str) -> str:
    """drop, named (by its class or id alone), article, main or plain."""
    if name in DROPPED:
        return "drop"
    if attributes:
        found = {key.lower(): a or b or c for key, a, b, c in ATTRIBUTE.findall(attributes)}
        role = found.get("role", "").lower()
        if role in ROLES or re.search(r"(?:^|\s)hidden(?:\s|=|$)", attributes) or found.get("aria-hidden") == "true":
            return "drop"
        if role in ("main", "article") or found.get("itemprop") == "articleBody":
            return "main" if role == "main" else "article"
        if name not in ("body", "html", "article", "main") and MARKS.search(f"{found.get('class', '')} {found.get('id', '')}"):
            return "named"
    return name if name in ARTICLE else "plain"


def streams_of(page: str) -> list[Block]:
    """All blocks of a page in order: what markup says, the number of the article or marked container, and the text.

    An article inside an article, as readers' comments are marked, is not part of it. An article inside ``main`` is, unless
    its class names it a comment; the first one has the number of ``main``. What one marked container holds is one block, so
    that a menu of single words is a stream of tokens.
    """
    blocks: list[Block] = []
    parts: list[str] = []
    open_: list[tuple[str, str]] = []
    articles: list[tuple[str, int]] = []
    inner: set[int] = set()
    dropped = named = number = mark = 0

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if not text:
            return
        if dropped or named and not articles:
            blocks.append((MARKED, mark, text))
        elif articles:
            blocks.append((IN_NAMED if named else IN_ARTICLE, articles[-1][1], text))
        else:
            blocks.append((OPEN, 0, text))

    def leave(at: int) -> None:
        nonlocal dropped, named
        flush()
        for _, kind in open_[at:]:
            dropped -= kind == "drop"
            named -= kind == "named"
            if kind in ARTICLE:
                articles.pop()
        del open_[at:]

    def text(piece: str) -> None:
        if piece:
            parts.append(piece)

    position = 0
    while True:
        found = TAG.search(page, position)
        if found is None:
            text(page[position:])
            break
        text(page[position : found.start()])
        position = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if found[1]:
            at = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == name), None)
            if at is not None:
                if name in BLOCK or any(tag in BLOCK or kind != "plain" for tag, kind in open_[at:]):
                    leave(at)
                else:
                    del open_[at:]
            elif name in BLOCK:
                flush()
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(page, position)
            position = len(page) if end is None else (page.find(">", end.end()) + 1 or len(page))
            continue
        if name in ENDS_PARAGRAPH:
            at = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == "p"), None)
            if at is not None and not any(tag in BLOCK for tag, _ in open_[at + 1 :]):
                leave(at)
        if name in ("li", "dd", "dt", "tr", "td", "th", "option"):
            at = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] in (name, "ul", "ol", "dl", "table")), None)
            if at is not None and open_[at][0] == name:
                leave(at)
        if name == "br":
            text(" ")
        if name in BLOCK:
            flush()
        if name in VOID or found[3].endswith("/") and name not in BLOCK:
            continue
        kind = _kind(name, found[3])
        if kind in ARTICLE and articles:
            names = " ".join(a or b or c for key, a, b, c in ATTRIBUTE.findall(found[3]) if key.lower() in ("class", "id"))
            holds = "article" in (kind, name) and articles[-1][0] == "main" and not COMMENT.search(names)
            kind = "article" if holds else "drop" if name == "article" else "plain"
        if kind == "named" and articles:
            kind = "drop"
        if kind != "plain" and name not in BLOCK:
            flush()
        if kind in ARTICLE:
            number += 1
            outer = articles[-1][1] if articles and not dropped else number
            articles.append((kind, number if outer in inner else outer))
            if outer != number:
                inner.add(outer)
        elif kind != "plain" and not (dropped or named):
            number += 1
            mark = number
        dropped += kind == "drop"
        named += kind == "named"
        open_.append((name, kind))
    flush()
    joined: list[Block] = []
    for (kind, part), some in groupby(blocks, key=lambda block: block[:2]):
        joined += [(kind, part, " ".join(text for _, _, text in some))] if kind == MARKED else some
    return joined


def blocks_of(page: str) -> list[tuple[bool, str]]:
    """The blocks that markup does not rule out: whether an article element holds them, and their text."""
    return [(kind == IN_ARTICLE, text) for kind, _, text in streams_of(page) if kind in (IN_ARTICLE, OPEN)]


def suffix_array(ids: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by doubling the length that they are ranked by; only ties are sorted again."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    rank, at, values, length = np.empty(n, dtype=np.int64), np.arange(n), ids[order], 0
    while len(at):
        new = np.concatenate([[True], values[1:] != values[:-1]])
        rank[order[at]] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        at = at[~new | np.append(~new[1:], False)]
        length = max(2 * length, 1)
        tied = order[at]
        second = np.where(tied + length < n, rank[np.minimum(tied + length, n - 1)], -1)
        values = rank[tied] * (n + 1) + second + 1
        again = np.argsort(values, kind="stable")
        order[at], values = tied[again], values[again]
    return order


def covered(
    ids: np.ndarray, page: np.ndarray, least_tokens: int, least_pages: int, known: np.ndarray | None = None, votes: np.ndarray | None = None
) -> np.ndarray:
    """Tokens that lie in a substring of ``least_tokens`` or more that stands on ``least_pages`` or more pages.

    ``known`` marks starts of such substrings that are known to repeat elsewhere, ``votes`` the tokens whose pages count.

    Suffixes that agree in their first ``least_tokens`` tokens stand together in the suffix array.
    Negative tokens end blocks and agree with nothing.
    """
    n, cover = len(ids), np.zeros(len(ids) + 1, dtype=np.int64)
    if n < least_tokens:
        return cover[:-1] > 0
    order = suffix_array(ids)
    order = order[order <= n - least_tokens]
    windows = np.lib.stride_tricks.sliding_window_view(ids, least_tokens)[order]
    order, windows = order[(windows >= 0).all(axis=1)], windows[(windows >= 0).all(axis=1)]
    if not len(order):
        return cover[:-1] > 0
    run = np.concatenate([[0], np.cumsum((windows[1:] != windows[:-1]).any(axis=1))])
    counted = slice(None) if votes is None else votes[order]
    pairs = np.unique(run[counted] * (page.max() + 1) + page[order][counted])
    repeats = np.bincount(pairs // (page.max() + 1), minlength=run[-1] + 1) >= least_pages
    if known is not None:
        repeats[run[known[order]]] = True
    starts = order[repeats[run]]
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + least_tokens, -1)
    return np.cumsum(cover[:-1]) > 0


def windows_of(block: str, least_tokens: int) -> list[int]:
    """Hashes of all runs of ``least_tokens`` tokens of a block."""
    tokens = block.split(" ")
    return [xxhash.xxh64_intdigest(" ".join(tokens[i : i + least_tokens])) - (1 << 63) for i in range(len(tokens) - least_tokens + 1)]


def votes_of(blocks: list[Block]) -> list[bool]:
    """Whether the page counts where a run of a block is counted: all but the one article of a page, which may quote."""
    several = len({part for kind, part, _ in blocks if kind == IN_ARTICLE}) > 1
    return [several or kind != IN_ARTICLE for kind, _, _ in blocks]


def content_of(blocks: list[Block]) -> int:
    """What pages of the same text have in common, whatever is marked in them."""
    return xxhash.xxh64_intdigest("\n".join(text for kind, _, text in blocks if kind != MARKED)) - (1 << 63)


def verdict(blocks: list[Block], repeated: list[np.ndarray]) -> list[str]:
    """The blocks of the main text, where ``repeated`` marks the tokens of each block that the host repeats.

    Articles stay whole, quotations included. Of several articles, those that are mostly repeated are teasers and go, if
    they hold less than the others. Without an article, a container's class names are not believed if they leave nothing
    of the page: articles inside it stay unless they are mostly repeated. Otherwise the blocks that markup does not rule
    out lose their repeated runs.
    """
    kinds = {kind for kind, _, _ in blocks}
    held = IN_ARTICLE if IN_ARTICLE in kinds else IN_NAMED if OPEN not in kinds else OPEN
    if held == OPEN:
        left = []
        for (kind, _, text), out in zip(blocks, repeated, strict=True):
            if kind == OPEN and not out.all():
                left.append(" ".join(token for token, gone in zip(text.split(" "), out, strict=True) if not gone))
        return left
    sizes: dict[int, int] = {}
    shares: dict[int, int] = {}
    for (kind, part, _), out in zip(blocks, repeated, strict=True):
        if kind == held:
            sizes[part] = sizes.get(part, 0) + len(out)
            shares[part] = shares.get(part, 0) + int(np.count_nonzero(out))
    gone = {part for part, size in sizes.items() if 2 * shares[part] > size}
    if held == IN_ARTICLE and 2 * sum(sizes[part] for part in gone) >= sum(sizes.values()):
        gone = set()
    return [text for kind, part, text in blocks if kind == held and part not in gone]


def judge(
    pages: list[list[Block]], least_tokens: int = LEAST_TOKENS, least_pages: int = LEAST_PAGES, repeated: frozenset[int] = frozenset()
) -> list[list[str]]:
    """The blocks of the main text of each page, from one suffix array over all blocks of these pages and from markup.

    Pages of the same text count as one. ``repeated`` holds the hashes of windows that repeat on the whole host.
    """
    contents: dict[int, int] = {}
    counted = [contents.setdefault(content_of(blocks), len(contents)) for blocks in pages]
    owner = np.repeat(np.asarray(counted, dtype=np.int64), [len(blocks) for blocks in pages])
    votes = [vote for blocks in pages for vote in votes_of(blocks)]
    texts = pa.array([text for blocks in pages for _, _, text in blocks], pa.large_string())
    tokens = pc.split_pattern(texts, " ")
    sizes = pc.list_value_length(tokens).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    ends = np.cumsum(sizes) - 1
    ids = -1 - np.arange(sizes.sum())
    inside = np.ones(len(ids), dtype=bool)
    inside[ends] = False
    ids[inside] = tokens.flatten().dictionary_encode().indices.to_numpy()
    known = np.zeros(len(ids), dtype=bool)
    if repeated:
        starts: dict[str, list[bool]] = {}
        for i in np.flatnonzero(votes):
            text = texts[i].as_py()
            if text not in starts:
                starts[text] = [window in repeated for window in windows_of(text, least_tokens)]
            first = ends[i] + 1 - sizes[i]
            known[first : first + len(starts[text])] = starts[text]
    out = covered(ids, np.repeat(owner, sizes), least_tokens, least_pages, known, np.repeat(np.asarray(votes, dtype=bool), sizes))
    marks = iter([out[end + 1 - size : end] for end, size in zip(ends, sizes, strict=True)])
    return [verdict(blocks, [next(marks) for _ in blocks]) for blocks in pages]


def packed(blocks: list[Block]) -> bytes:
    """Blocks as compressed lines, as their texts hold no line feeds."""
    lines = "\n".join(f"{kind}{part} {text}" for kind, part, text in blocks).encode()
    return len(lines).to_bytes(8, "little") + pa.Codec("zstd").compress(lines, asbytes=True)


def unpacked(made: bytes) -> list[Block]:
    lines = pa.Codec("zstd").decompress(made[8:], int.from_bytes(made[:8], "little"), asbytes=True).decode()
    heads = [line.partition(" ") for line in lines.split("\n") if line]
    return [(head[0], int(head[1:]), text) for head, _, text in heads]


def host_of(url: str):
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^(?:[A-Za-z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def main_text(
    pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html",
    least_tokens: int = LEAST_TOKENS, least_pages: int = LEAST_PAGES, group_pages: int = GROUP_PAGES,
) -> DataFrame:
    """A row for each row of ``pages``: key, url, ``text`` (blocks joined by a line feed) and ``n_chars``.

    All blocks of all pages go through the suffix arrays of their host, which find the runs of ``least_tokens`` or more
    tokens that stand on ``least_pages`` or more pages of different text; ``verdict`` says what becomes of them. A page's
    only article has no vote, as it may quote; all else has, marked or not. The pages of a host are compared in groups of
    about ``group_pages``, dealt by a hash, so no host is gathered whole; votes on a host of several groups are counted
    beforehand. Null and empty pages have an empty text; null keys and urls are values like others, and repeated rows come
    out as often as they went in.
    """
    ship(pages.sparkSession)
    rows = pages.select(host_of(url).alias("host"), F.col(key).alias("key__"), F.col(url).alias("url__"), F.col(page).alias("page__"))
    # A host of several groups has over ``group_pages`` rows, so these are few.
    sizes = rows.groupBy("host").agg(F.ceil(F.count("*") / group_pages).alias("groups")).where("groups > 1")
    large = F.broadcast(written(sizes))
    dealt = F.pmod(F.xxhash64("key__", "url__", "page__"), F.coalesce("groups", F.lit(1).cast("long"))).alias("group")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["host", "group", "content", "window"]
        for batch in batches:
            for start in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(start, OUT_ROWS)
                at, contents, found = [], [], []
                for i, page in enumerate(part.column("page__")):
                    blocks = streams_of(page.as_py() or "")
                    voting = (text for (_, _, text), vote in zip(blocks, votes_of(blocks), strict=True) if vote)
                    mine = {window for text in voting for window in windows_of(text, least_tokens)}
                    found += mine
                    at += [i] * len(mine)
                    contents += [content_of(blocks)] * len(mine)
                place = [part.column(name).take(pa.array(at, pa.int64())) for name in names[:2]]
                yield pa.RecordBatch.from_arrays([*place, pa.array(contents, pa.int64()), pa.array(found, pa.int64())], names)

    # Only a host of several groups has windows that no group sees whole.
    spread = rows.join(large, "host").select("host", dealt, "page__")
    met = written(spread.mapInArrow(windows, "host string, group long, content long, window long"))
    often = met.select("host", "window", "content").distinct().groupBy("host", "window").count().where(F.col("count") >= least_pages)
    repeated = met.select("host", "group", "window").distinct().join(often.select("host", "window"), ["host", "window"])

    kinds = {field.name: field.dataType for field in rows.schema}
    ids = [StructField(name, kinds[name]) for name in ("key__", "url__")]
    names = ["host", "group", "key__", "url__", "blocks"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(start, OUT_ROWS)
                made = pa.array([packed(streams_of(page.as_py() or "")) for page in part.column("page__")], pa.binary())
                yield pa.RecordBatch.from_arrays([*[part.column(name) for name in names[:-1]], made], names)

    parsed = rows.join(large, "host", "left").select("host", dealt, "key__", "url__", "page__")
    fields = [StructField("host", StringType()), StructField("group", LongType()), *ids, StructField("blocks", BinaryType())]
    grouped = parsed.mapInArrow(cut, StructType(fields))
    out = StructType([*ids, StructField("text__", StringType())])

    def texts(group: pa.Table, repeats: pa.Table) -> pa.Table:
        often = frozenset(repeats.column("window").to_pylist())
        kept = judge([unpacked(made) for made in group.column("blocks").to_pylist()], least_tokens, least_pages, often)
        made = pa.array(["\n".join(blocks) for blocks in kept], pa.string())
        return pa.table([group.column("key__"), group.column("url__"), made], to_arrow_schema(out))

    cleaned = grouped.groupBy("host", "group").cogroup(repeated.groupBy("host", "group")).applyInArrow(texts, out)
    text = F.col("text__")
    return cleaned.select(F.col("key__").alias(key), F.col("url__").alias(url), text.alias("text"), F.length(text).cast("long").alias("n_chars"))
