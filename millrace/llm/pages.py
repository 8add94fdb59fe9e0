"""Operator 3: main text of web pages, by a suffix array over the token streams of each host.

A page is cut into blocks of text, in page order, with what their elements say about them: inside of the article,
furniture (menus, headers, footers, sidebars, notices, adverts, forms, comments of readers), or neither. Names of classes do
not make the article furniture, nor does an element by its class or a form what it holds, if the page has no other article. The
token streams of the pages, articles apart from all else, are put together by host; ``suffixes`` finds runs of ``WIDTH`` tokens or
more that distinct pages of a host share, across the blocks of a page. Tokens of such a run inside of a block go, and
blocks that runs cover from end to end. A block of fewer tokens that is no paragraph goes if it stands as a block on distinct pages.

Of a page with an article its blocks stay in page order, and whole: only those go that runs of ``LEAST_PAGES`` pages cover from end
to end, and short ones on as many pages and over half of a host's. An article of which runs cover a share of ``REPOST`` is a repost: it stays
whole, and no other article loses what only reposts share with it. Of other pages the unique runs of all blocks stay; furniture
that repeats nowhere goes by its elements. A token in a slice is half of its hash; windows also share the whole hash of ``GRAM`` tokens.

White space of a block becomes one space, character references are decoded, blocks are joined by one space.

Defined cases: null and empty html give an empty text; broken markup ends at the end of the page; pages without a
url belong to the empty host; rows that repeat a page_id are pages of their own, but equal rows count as one page
as to what repeats; other columns are left aside; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrays import mixed, prefix_sums, span_hashes, text_bytes, word_hashes, words
from millrace.llm.common import written
from millrace.llm.suffixes import repeated, runs

WIDTH = 6
#: Tokens whose hash deals windows out, and bytes of a token in a slice.
GRAM, ITEM = 2, 4
ARTICLE, OTHER, FURNITURE = 0, 1, 2
#: While a page is read: inside of an element that is furniture by its class, and an article in there.
NAMED_SO, HELD = 3, 4
#: An article of which repeats cover this share is a repost.
REPOST = 0.8
#: Pages that must hold a block of an article before it goes, as two may tell the same story.
LEAST_PAGES = 3

#: A quote that is never closed ends at the next ``>``.
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?=>|\Z)|[^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.DOTALL)
NAMED = re.compile(r"(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
GAPS = re.compile(r"\s+")

#: Elements whose content is never text of the page.
SILENT = frozenset("script style template noscript iframe object svg canvas math select option textarea button audio video title".split())
#: Elements that are furniture wherever they stand.
FURNISHING = frozenset("nav footer aside form menu dialog head".split())
MAIN = frozenset(("article", "main"))
#: Elements that do not end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr input".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An open element of the first kind ends when one of these starts or an element around it ends.
CLOSED_BY = {"p": frozenset("p div ul ol dl table h1 h2 h3 h4 h5 h6 section article aside nav footer header form blockquote pre main hr".split()), "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "tr": frozenset(("tr",)), "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr"))}
#: Words of class, id and role names that make an element furniture.
SIGNS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar footer masthead cookie cookies consent notice notices popup modal overlay newsletter subscribe subscription signup login share sharing "
    "social related recommended comment comments reply replies disqus widget toolbar pagination pager search contentinfo complementary".split()
)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def furniture(name: str, attributes: str, in_article: bool) -> int | None:
    """FURNITURE by the element, NAMED_SO by its class, id or role (or a form, which may hold a whole page), or None."""
    if name in FURNISHING or (name == "header" and not in_article):
        return NAMED_SO if name == "form" else FURNITURE
    if "=" not in attributes or name in ("html", "body") or (name in MAIN and not in_article):
        return None
    for m in NAMED.finditer(attributes):
        value = m[1] or m[2] or m[3] or ""
        # an article inside of one is a reader's comment or the like if a name says just that
        if any(part.lower() in SIGNS for part in (value.split() if name in MAIN else PARTS.findall(value))):
            return NAMED_SO
    return None


def blocks(source: str) -> list[tuple[int, str, bool]]:
    """(kind, text, whether it stands in a paragraph) of all blocks of a page with text, in page order."""
    out: list[tuple[int, str, bool]] = []
    held: list[str] = []
    open_: list[tuple[str, int]] = []  # element, kind of what it holds
    many: Counter[str] = Counter()  # how many of each are open, so that an end without a start walks nowhere
    kind, at = OTHER, 0

    def leave(depth: int) -> None:
        many.subtract(n for n, _ in open_[depth:])
        del open_[depth:]

    def close() -> None:
        if held:
            text = GAPS.sub(" ", html.unescape("".join(held))).strip()
            held.clear()
            if text:
                out.append((kind, text, many["p"] > 0))

    while m := TAG.search(source, at):
        if m.start() > at:
            held.append(source[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            if name in INLINE and name not in [n for n, _ in open_[-8:]]:
                continue
            if not many[name]:
                close()
                continue
            depth = len(open_) - 1
            while open_[depth][0] != name:
                depth -= 1
            if name not in INLINE or open_[depth][1] != kind or any(n not in INLINE for n, _ in open_[depth:]):
                close()
            leave(depth)
            kind = open_[-1][1] if open_ else OTHER
            continue
        if name in SILENT and not m[3].endswith("/"):
            if name not in INLINE:
                close() if name in ("title",) else None
            end = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(source, at)
            at = end.end() if end else len(source)
            continue
        if name == "br":
            held.append(" ")
            continue
        if name not in INLINE:
            close()
            while open_ and name in CLOSED_BY.get(open_[-1][0], ()):
                leave(len(open_) - 1)
            if many["p"] and name in CLOSED_BY["p"]:  # an open paragraph ends, with the inline elements left open in it
                for depth in range(len(open_) - 1, -1, -1):
                    if open_[depth][0] == "p":
                        leave(depth)
                        break
                    if open_[depth][0] not in INLINE:
                        break
            kind = open_[-1][1] if open_ else OTHER
        if name in VOID or m[3].endswith("/"):
            continue
        own = kind
        sign = furniture(name, m[3], kind in (ARTICLE, HELD))
        if sign is not None:
            own = FURNITURE if kind in (ARTICLE, HELD, FURNITURE) else sign
        elif name in MAIN and kind in (OTHER, NAMED_SO):
            own = ARTICLE if kind == OTHER else HELD
        if own != kind:
            close()
        open_.append((name, own))
        many[name] += 1
        kind = own
    held.append(source[at:])
    close()
    # an article inside of such an element is one of the page unless another stands outside
    last = {NAMED_SO: FURNITURE, HELD: FURNITURE if any(k == ARTICLE for k, *_ in out) else ARTICLE}
    return [(last.get(k, k), text, prose) for k, text, prose in out]


def _extracted(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
    arrays = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "text", "n_chars"])


def _blocks(pages: DataFrame) -> DataFrame:
    """(page_id, url, key, article), kinds and texts of the blocks that a page's text is made of: its articles, else all."""
    carried = ["page_id", "url", "key"]
    head = ", ".join(f"{c} {t}" for c, t in pages.dtypes if c in carried)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [blocks(s or "") for s in batch.column("html").to_pylist()]
            marked = [any(k == ARTICLE for k, *_ in f) for f in found]
            found = [[b for b in f if b[0] == ARTICLE] if m else f for f, m in zip(found, marked, strict=True)]
            kinds = pa.array([[k for k, *_ in f] for f in found], pa.list_(pa.int32()))
            texts = pa.array([[t for _, t, _ in f] for f in found], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carried], pa.array(marked), kinds, texts], names=[*carried, "article", "kinds", "texts"])

    return pages.select(*carried, "html").mapInArrow(work, f"{head}, article boolean, kinds array<int>, texts array<string>")


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each token of the texts, and the number of the first token of each."""
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    starts, ends, first = words(data, offsets)
    return (word_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)), first


def _streams(pages: DataFrame, width: int) -> DataFrame:
    """Runs of token windows of two streams of a page, with their tokens: its articles, and all else. Starts count the tokens of the stream.

    A block shorter than a window, if no paragraph, is one more window: the hash of its tokens, filled up. Its start is -1 - that of
    the block. For each stream of articles one row without a hash has the numbers of tokens of its blocks as the slice.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, prose, streams_of = [], [], []  # streams: 2 * page, and one more for its articles
            for i, source in enumerate(batch.column("html").to_pylist()):
                own = sorted(blocks(source or ""), key=lambda b: b[0] == ARTICLE)
                texts += [text for _, text, _ in own]
                prose += [p for *_, p in own]
                streams_of += [2 * i + (kind == ARTICLE) for kind, *_ in own]
            hashes, first = _tokens(texts)
            streams_of, sizes = np.array(streams_of, np.int64), np.diff(first)
            stream_first = first[np.searchsorted(streams_of, np.arange(2 * batch.num_rows + 1))]
            of, start, count, least = runs(hashes, stream_first, width, GRAM)
            tokens = (hashes >> np.uint64(32)).astype(">u4").tobytes()
            low, high = (stream_first[of] + start) * ITEM, (stream_first[of] + start + count + width - 1) * ITEM
            slices = [tokens[a:b] for a, b in zip(low.tolist(), high.tolist(), strict=True)]
            short = np.flatnonzero((sizes > 0) & (sizes < width) & ~np.array(prose, bool))
            units = span_hashes(prefix_sums(hashes), first[short], first[short + 1]) + sizes[short].astype(np.uint64)
            slices += [u.tobytes() + b"\xff" * (ITEM * width - 8) for u in units.astype(">u8")]
            stream = np.concatenate([of, streams_of[short]]).astype(np.int64)
            begin = np.concatenate([start, stream_first[streams_of[short]] - first[short] - 1]).astype(np.int64)
            some = np.unique(streams_of[streams_of % 2 == 1])
            bounds = np.searchsorted(streams_of, np.stack([some, some + 1]))
            slices += [sizes[a:b].astype(np.int64).tobytes() for a, b in bounds.T.tolist()]
            stream, begin = np.concatenate([stream, some]), np.concatenate([begin, np.zeros(len(some), np.int64)])
            host, key = batch.column("host_hash").to_numpy()[stream // 2], batch.column("key").to_numpy()[stream // 2]
            values = np.concatenate([least.view(np.uint64), mixed(units), np.zeros(len(some), np.uint64)])
            # one group per host, kind of stream and hash
            groups = mixed(values + mixed(host.view(np.uint64) + (stream % 2).astype(np.uint64))).view(np.int64)
            whole = np.arange(len(stream)) >= len(stream) - len(some)
            arrays = [pa.array(stream % 2 == 1), pa.array(groups, mask=whole), pa.array(host), pa.array(key), pa.array(begin), pa.array(slices, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["article", "hash", "host", "key", "start", "slice"])

    return pages.select("host_hash", "key", "html").mapInArrow(work, "article boolean, hash long, host long, key long, start long, slice binary")


def _covered(sizes: list[int], spans: list[tuple[int, int]], width: int) -> list[np.ndarray]:
    """Which tokens of each block (of so many tokens) go, by spans (first token, end) of repeated windows.

    These are tokens of windows inside of the block, or all if spans cover all of it. A first token of -1 - place stands for the
    block there.
    """
    ends = np.cumsum(sizes, dtype=np.int64)
    inside, across = np.zeros((2, int(ends[-1]) if len(sizes) else 0), bool)
    for a, b in spans:
        if a < 0:
            a, b = -1 - a, int(ends[np.searchsorted(ends, -1 - a, "right")])
        across[a:b] = True
        for i in range(int(np.searchsorted(ends, a, "right")), int(np.searchsorted(ends, b, "left")) + 1):
            low, high = max(a, int(ends[i]) - sizes[i]), min(b, int(ends[i]))
            if high - low >= width:
                inside[low:high] = True
    return [c if c.all() else i for i, c in zip(np.split(inside, ends[:-1]), np.split(across, ends[:-1]), strict=True)] if len(sizes) else []


def _text(kinds: list[int], texts: list[str], spans: list[tuple[int, int]], width: int) -> str:
    """What no span covers of the blocks that are no furniture; blocks of an article go whole or stay."""
    sizes = [len(text.encode().split()) for text in texts]  # white space of ASCII, as the streams count
    out = []
    for kind, text, gone in zip(kinds, texts, _covered(sizes, spans, width), strict=True):
        if kind == ARTICLE and not (len(gone) and gone.all()):
            out.append(text)
        if kind == OTHER:
            kept = [t for t, g in zip(filter(None, re.split("[\x09-\x0d\x20]+", text)), gone.tolist(), strict=True) if not g]
            if kept:
                out.append(" ".join(kept))
    return " ".join(out)


def _spans(runs_: DataFrame, width: int, least: int = 2) -> DataFrame:
    """Runs (hash, n, key, start, slice) to (key, spans): stretches of tokens that so many distinct pages hold."""
    marks = repeated(runs_.select("hash", "n", F.col("key").alias("rank"), "start", F.col("key").alias("owner"), "slice"), width, ITEM, later=False, owners=least)
    return marks.groupBy(F.col("owner").alias("key")).agg(F.collect_set(F.struct("start", (F.col("start") + F.col("windows") + width - 1).alias("stop"))).alias("spans"))


def _reposts(spans: DataFrame, sizes: DataFrame, width: int) -> DataFrame:
    """Keys of the pages whose articles (numbers of tokens of the blocks in slice) spans cover to the share of a repost."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for key, raw, own in zip(*[batch.column(c).to_pylist() for c in ("key", "slice", "spans")], strict=True):
                of = np.frombuffer(raw, np.int64).tolist()
                gone = _covered(of, [(s["start"], s["stop"]) for s in own if s["start"] >= 0], width)
                if sum(int(g.sum()) for g in gone) >= REPOST * sum(of):
                    found.append(key)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["key"])

    return sizes.select("key", "slice").join(spans, "key").mapInArrow(work, "key long").distinct()


def _common_units(units: DataFrame, sizes: DataFrame) -> DataFrame:
    """Of short blocks of articles (hash, host, key, start) those on ``LEAST_PAGES`` and over half of the host's that have an article."""
    pages_of = sizes.select("host", "key").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    seen = units.select("hash", "host", "key").distinct().groupBy("hash", "host").agg(F.count("*").alias("n_seen"))
    common = seen.filter(F.col("n_seen") >= LEAST_PAGES).join(pages_of, "host").filter("2 * n_seen > pages").select("hash")
    return units.join(common, "hash", "left_semi")


def extract(pages: DataFrame, width: int = WIDTH) -> DataFrame:
    """(page_id, url, html) to page_id, url, text, n_chars."""
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))
    keyed = pages.select("page_id", "url", "html", F.xxhash64(host).alias("host_hash"), F.xxhash64("page_id", "url", "html").alias("key"))
    streams = written(_streams(keyed, width), "pages-streams")
    again = streams.filter("hash is not null").groupBy("hash").agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
    met = written(streams.join(again.filter("low < high").select("hash", "n"), "hash"), "pages-runs")
    # what reposts share with an article is no reason to cut it
    sizes, inside = streams.filter("hash is null"), met.filter("article")
    first = written(_spans(inside.filter("start >= 0"), width), "pages-first")
    inside = inside.join(written(_reposts(first, sizes, width), "pages-reposts"), "key", "left_anti")
    inside = inside.filter("start >= 0").unionByName(_common_units(inside.filter("start < 0"), sizes))
    spans = _spans(met.filter("not article"), width).withColumn("article", F.lit(False)).unionByName(_spans(inside, width, LEAST_PAGES).withColumn("article", F.lit(True)))
    found = _blocks(keyed).join(written(spans, "pages-spans"), ["key", "article"], "left")
    kinds = dict(pages.dtypes)
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in ("kinds", "texts", "spans")], strict=True)
            texts = [_text(k, t, [(s["start"], s["stop"]) for s in spans or []], width) for k, t, spans in rows]
            yield _extracted(batch, texts)

    return found.select("page_id", "url", "kinds", "texts", "spans").mapInArrow(work, schema)
