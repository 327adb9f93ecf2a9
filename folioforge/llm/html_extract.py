"""Main text of pages: repeats found by a suffix array over each host, and page structure.

Pages are read as block token streams. The blocks outside of articles, and those in articles whose name leaves it
open what they are, are put together for each host (equal blocks once, with the least and greatest page). All their suffixes are
sorted by prefix doubling; neighbours from distinct pages with ``DEPTH`` words or more in common are
repeats, and so are shorter blocks that stand whole on several pages. Every page gets the repeats that its open blocks hold:
words that they cover go, unique runs stay.

Structure decides where repeats can't: menus, footers, adverts, forms and the like go, though seen once, and
where a page marks its article, that stays, though two pages share it, and what is outside goes.

A host of over ``SHARD`` words is split by content, so that it needs no task of its own: each window of DEPTH words belongs to
the least of its 4-word digests, and runs of windows that belong to one are a shard's texts. Equal windows meet in one shard, and
those shards have suffix arrays of their own.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .url_filter import parsed

DEPTH = 8
#: words of a host for which one suffix array is built; also about how many are sorted at once
SHARD = 1 << 13
#: hosts above SHARD up to this number are broadcast
FEW = 10_000
_GRAM = 4
_TAG = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_RAW = {"script", "style", "noscript", "template", "iframe", "svg", "textarea", "title", "object", "canvas", "math"}
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in _RAW}
_BLOCKS = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = {"hr"}
_DROPPED = {"nav", "footer", "aside", "form", "head", "menu", "dialog", "select", "button", "fieldset"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar"}
_NAMES = set(
    "nav navbar navigation menu sidebar footer ad ads advert adverts advertisement advertising adsense adbox sponsor sponsored sponsors promo promotion banner cookie cookies consent gdpr notice notices notification newsletter subscribe subscription signup popup modal overlay comment comments disqus respond replies related recommended recommendations share sharing social breadcrumb breadcrumbs pagination pager widget widgets toolbar masthead topbar copyright login searchbox".split()
)
#: words that add nothing to a name; with any other beside one of _NAMES, a name leaves open what it means
_PARTS = set("area aside bar block bottom box btn button buttons center column container content desktop element footer form fixed global group header holder home icon icons inner item items left link links list main mobile module outer page panel position post right row section site slot space tag text top unit wrap wrapper zone".split())
_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*")
#: what structure says of a block
KEPT, GONE, OPEN = range(3)
_HOLDERS = {"article", "main"}


def blocks(page: str) -> list[tuple[str, bool, int]]:
    """(text, in an article or main element, what structure says) of each block with text, in page order."""
    out: list[tuple[str, bool, int]] = []
    stack: list[tuple[str, bool, int]] = []
    text: list[str] = []
    inside, says = False, KEPT
    at, end = 0, len(page)

    def flush():
        if text:
            words = " ".join(entities.unescape("".join(text)).split())
            if words:
                out.append((words, inside, says))
            text.clear()

    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            text.append(page[at:])
            break
        if m.start() > at:
            text.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if name in _RAW:
            if not m[1]:
                found = _RAW_END[name].search(page, at)
                at = found.end() if found else end
            continue
        if name == "br":
            text.append(" ")
        elif name in _BLOCKS:
            flush()
            if m[1]:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        del stack[k:]
                        break
            elif name not in _VOID and not m[3].endswith("/"):
                if name == "p" or name in ("li", "tr", "td", "th", "dt", "dd", "option"):
                    # an open one of these ends where the next begins
                    if stack and stack[-1][0] in (name, "p"):
                        stack.pop()
                holds = inside or name in _HOLDERS
                own = GONE if name in _DROPPED or (name == "header" and not holds) else _named(name, m[3])
                stack.append((name, holds, GONE if GONE in (own, says) else max(own, says)))
            _, inside, says = stack[-1] if stack else ("", False, KEPT)
    flush()
    return out


def _named(tag: str, attributes: str) -> int:
    """Whether role, class, id or hiding mark an element as no part of the article, or leave it open."""
    if not attributes or tag in ("html", "body", "article", "main") and "comment" not in attributes:
        return KEPT
    says = KEPT
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id"):
            for each in value.split():
                parts = [x.lower() for x in _NAME.findall(each)]
                if any(x in _NAMES for x in parts):
                    if all(x in _NAMES or x in _PARTS or len(x) < 3 for x in parts):
                        return GONE
                    says = OPEN
        if name == "role" and value.lower() in _ROLES or name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return GONE
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return GONE
    return says


def _digest(host: str, words: list[str]) -> int:
    """A signed 64-bit digest of some words of a host."""
    return xxhash.xxh3_64_intdigest((host + "\0" + " ".join(words)).encode("utf-8", "surrogatepass")) - (1 << 63)


def suffixes(host: str, words: list[str]) -> list[int]:
    """Digests of a block's suffixes cut at DEPTH words; those too short only if the whole block is."""
    return [_digest(host, words[i : i + DEPTH]) for i in range(max(1, len(words) - DEPTH + 1))] if words else []


def open_blocks(page: str) -> list[str]:
    """Texts of the blocks that the host's repeats decide."""
    found = [b for b in blocks(page) if b[2] != GONE]
    marked = any(inside for _, inside, _ in found)
    return [t for t, inside, says in found if (inside and says == OPEN if marked else True)]


def _streams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, text, words, page) of blocks outside of articles, and of open ones inside, each once a page."""
    for batch in batches:
        rows = []
        for page, host, html in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            texts = {text for text, inside, says in blocks(html or "") if not inside or says == OPEN}
            rows += [(host, t, t.count(" ") + 1, page) for t in texts]
        yield _batch(rows, _TEXTS)


def _wanted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g, row) of the suffixes in a page's open blocks."""
    for batch in batches:
        rows = []
        for row, host, html in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            rows += [(g, row) for g in {g for t in open_blocks(html or "") for g in suffixes(host, t.split(" "))}]
        yield _batch(rows, _MARKS)


_TEXTS = pa.schema([("host", pa.string()), ("text", pa.string()), ("words", pa.int32()), ("page", pa.int64())])
_MARKS = pa.schema([("g", pa.int64()), ("row", pa.int64())])
_RUNS = pa.schema([("g", pa.int64()), ("host", pa.string()), ("text", pa.string()), ("least", pa.int64()), ("most", pa.int64())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def runs(host: str, words: list[str]) -> list[tuple[int, list[str]]]:
    """(shard, words): runs that hold each window of DEPTH words once, in the shard of its least 4-word digest."""
    if len(words) < DEPTH:
        return [(_digest(host, words), words)]
    grams = [_digest(host, words[i : i + _GRAM]) for i in range(len(words) - _GRAM + 1)]
    out, begin, last = [], 0, -1
    for i in range(len(words) - DEPTH + 1):
        at = min(range(i, i + DEPTH - _GRAM + 1), key=grams.__getitem__)
        if at != last and last >= 0:
            out.append((grams[last], words[begin : i - 1 + DEPTH]))
            begin = i
        last = at
    return [*out, (grams[last], words[begin:])]


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for host, text, least, most in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            rows += [(g, host, " ".join(run), least, most) for g, run in runs(host, text.split(" "))]
        yield _batch(rows, _RUNS)


def suffix_array(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions by the suffixes that start there, each cut at its text's end, and how many words each has in common with the one before."""
    n = len(words)
    at = np.arange(n)
    longest = int((ends - at).max(initial=0))
    levels = [np.unique(words, return_inverse=True)[1].astype(np.int64)]
    step = 1
    while step < longest:
        rank = levels[-1]
        follows = np.where(at + step < ends, rank[np.minimum(at + step, n - 1)] + 1, 0)
        levels.append(np.unique(rank * (n + 1) + follows, return_inverse=True)[1].astype(np.int64))
        step *= 2
    order = np.argsort(levels[-1], kind="stable")
    common = np.zeros(n, np.int64)
    x, y = order[:-1].copy(), order[1:].copy()
    x_end, y_end = ends[x], ends[y]
    for k in range(len(levels) - 1, -1, -1):
        fits = (x + (1 << k) <= x_end) & (y + (1 << k) <= y_end)
        same = fits & (levels[k][np.minimum(x, n - 1)] == levels[k][np.minimum(y, n - 1)])
        x[same] += 1 << k
        y[same] += 1 << k
        common[1:][same] += 1 << k
    return order, common


def repeats(rows: list[tuple[str, list[str], int, int]]) -> list[int]:
    """Digests of what repeats among texts (host, words, least page, greatest page): DEPTH words, or shorter texts whole."""
    ids: dict[tuple[str, str], int] = {}
    words = np.array([ids.setdefault((host, w), len(ids)) for host, ws, _, _ in rows for w in ws], np.int64)
    sizes = np.array([len(ws) for _, ws, _, _ in rows], np.int64)
    ends = np.cumsum(sizes)
    of = np.repeat(np.arange(len(rows)), sizes)
    order, common = suffix_array(words, ends[of])
    least, most = (np.array([r[i] for r in rows], np.int64)[of[order]] for i in (2, 3))
    first = np.flatnonzero(common < DEPTH)
    several = np.minimum.reduceat(least, first) < np.maximum.reduceat(most, first) if len(first) else np.zeros(0, bool)
    out = []
    for p in order[first[several]].tolist():
        host, ws, _, _ = rows[of[p]]
        i = p - int(ends[of[p]] - sizes[of[p]])
        if len(ws) - i >= DEPTH or i == 0:
            out.append(_digest(host, ws[i : i + DEPTH]))
    return out


def _repeats(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g) of what repeats, from texts by shard; whole shards are sorted, small ones together."""
    held, shard, size = [], None, 0
    for batch in batches:
        for g, host, text, least, most in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if g != shard and size >= SHARD:
                yield _batch([(x,) for x in repeats(held)], pa.schema([_MARKS.field("g")]))
                held, size = [], 0
            shard = g
            held.append((host, text.split(" "), least, most))
            size += len(held[-1][1])
    if held:
        yield _batch([(x,) for x in repeats(held)], pa.schema([_MARKS.field("g")]))


def main_text(page: str, host: str = "", repeated: frozenset[int] = frozenset()) -> str:
    """The article's blocks; without an article, all that structure leaves. Open blocks lose their repeated runs."""
    found = [b for b in blocks(page) if b[2] != GONE]
    marked = any(inside for _, inside, _ in found)
    out = []
    for text, inside, says in found:
        if marked and (not inside or says == KEPT):
            if inside:
                out.append(text)
            continue
        words = text.split(" ")
        covered = np.zeros(len(words), bool)
        if repeated:
            for i, g in enumerate(suffixes(host, words)):
                if g in repeated:
                    covered[i : i + DEPTH] = True
        left = " ".join(w for w, c in zip(words, covered, strict=True) if not c)
        if left:
            out.append(left)
    return "\n\n".join(out)


def _extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, htmls, marks = (batch.column(i).to_pylist() for i in (2, 3, 4))
        text = [main_text(x or "", h, frozenset(r or ())) for x, h, r in zip(htmls, hosts, marks, strict=True)]
        sizes = pa.array([len(t) for t in text], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each page: its main text, blocks joined by an empty line.

    Null or empty html: an empty text. Pages with a null url (or without a host) share the
    host ''. Pages under one page_id aren't distinct pages; a null page_id counts as one page. Repeated rows
    give repeated rows; other columns are ignored; no pages: an empty result.
    """
    kept = parsed(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")))
    kept = kept.withColumn("row", F.xxhash64("page_id", "url", "html"))
    streams = kept.select(F.coalesce("page_id", F.lit(-1)).alias("page"), "host", "html").mapInArrow(_streams, "host string, text string, words int, page long")
    texts = stored(streams.groupBy("host", "text").agg(F.min("page").alias("least"), F.max("page").alias("most"), F.first("words").alias("words")))
    large = stored(texts.groupBy("host").agg(F.sum("words").alias("all")).where(F.col("all") > SHARD).select("host"))
    large = F.broadcast(large) if large.count() <= FEW else large
    calm = texts.join(large, "host", "left_anti").select(F.xxhash64("host").alias("g"), "host", "text", "least", "most")
    cut = texts.join(large, "host", "left_semi").select("host", "text", "least", "most").mapInArrow(_cut, "g long, host string, text string, least long, most long")
    cut = cut.groupBy("g", "host", "text").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    dealt = calm.unionByName(cut).repartition("g").sortWithinPartitions("g", "host", "text")
    found = dealt.mapInArrow(_repeats, "g long").distinct()
    wanted = kept.select("row", "host", "html").mapInArrow(_wanted, "g long, row long")
    covered = wanted.join(found, "g").groupBy("row").agg(F.collect_set("g").alias("repeated"))
    schema = "page_id long, url string, text string, n_chars long"
    return kept.join(covered, "row", "left").select("page_id", "url", "host", "html", "repeated").mapInArrow(_extract, schema)
