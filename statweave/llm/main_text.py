"""Main text of HTML pages: block structure, then the host suffix array.

A page is cut into blocks of text; each lies in a content container (article,
main), in page furniture (menus, headers, footers, sidebars, notices, adverts,
forms, comments: by tag, role, class or id) or in the open.  Furniture never
counts, and a page with a content container is that container's blocks; the
parsed zones decide, not the raw html.

Boilerplate is what the host repeats, inside a container and in the open.  The
token streams of a host's pages, run on across block ends, are concatenated and
their suffixes sorted to a depth of ``RUN`` tokens; equal neighbours from
distinct pages are repeated substrings, and blocks of fewer tokens are compared
whole.  A shard is the pages of a host among ``SHARD_PAGES`` pages that a task
reads.  Most runs stand on one page only, so a task first hands on the leading
bits of its runs' hashes, sorted and as differences (one to three bytes a run):
bits that two pages may share make a bit map.  Only runs it lets pass become
rows, and these are aggregated, so a host of any size is compared whole, none is
gathered in one task, no text is shuffled for it and no repeat is lost.  What is
repeated is then looked up on the pages again, broadcast or, where it is large,
by joins.

A repeat is removed where it stands on ``MIN_TEXTS`` distinct texts of the
host.  A page is a text of its own if blocks that are not repeated hold
``OWN_SHARE`` of it; all other pages of the host, near copies among them, count
as one text together, so what only near copies share stays.  The container is
the check that follows: inside it a repeat must also stand on ``WIDE_SHARE`` of
the host's texts, and a container is never emptied.

Defined cases: null html is the empty page, its text empty; pages of equal
text count as one page, so a copied page is not its own boilerplate; truncated
pages end all open elements; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import broadcast_checked
from .url_reputation import host_of

RUN = 8  # tokens; a power of two
SHARD_PAGES, SHARD_CHARS = 2048, 4 << 20  # a shard ends at the first of these
SLICE_RUNS = 4 << 20  # hashes that are compared in one task, about
MAP_BITS = 27         # of the bit map that is broadcast, at most
BROADCAST_RUNS = 2 << 20
LOOK_PAGES = 1024  # pages whose tokens are in memory at once
MIN_TEXTS = 3
OWN_SHARE = 0.25
WIDE_SHARE = 0.25

# Fixed values of the HTML vocabulary.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math xmp noframes".split())
FURNITURE_TAGS = frozenset(
    "head nav footer aside button select dialog menu object applet audio video canvas "
    "datalist".split())  # a form is judged by what it holds
CONTENT_TAGS = frozenset(["article", "main"])
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
    "optgroup option p pre section summary table tbody tfoot thead tr ul caption head".split())
FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar "
    "toolbar".split())
FURNITURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs "
    "comment comments commentlist consent cookie cookies disqus footer footnav header masthead menu "
    "modal nav navbar navigation newsletter notice notices overlay paywall pagination pager popup "
    "promo promoted promotion related recommended respond sidebar sidenav social share sharing "
    "sponsor sponsored subscribe subscription toolbar topbar widget widgets login signup".split())
# A name of several words is furniture if its last word is (site-footer), unless
# the first one denies or only mentions it (no-comments, has-sidebar), or if a
# furniture word stands before words that only say which part it is (ad-slot).
MENTIONS = frozenset("no not non without has have with is can show hide enable disable free".split())
PARTS = frozenset(
    "area bar block box button container content form frame group inner item items left link links list "
    "nav outer panel placeholder right row section slot top bottom unit wrap wrapper".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
_NAME = re.compile(r"[a-z]+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}

# A form's own zone is a number below these until the page is read.
CONTENT, OPEN, FURNITURE = 2, 1, 0


def furniture_name(token: str) -> bool:
    """Whether a class or id names furniture."""
    words = _NAME.findall(token)
    if not words or FURNITURE_NAMES.isdisjoint(words):
        return False
    if words[0] in MENTIONS:
        return False
    return words[-1] in FURNITURE_NAMES or (words[0] in FURNITURE_NAMES and PARTS.issuperset(words[1:]))


def _zone(tag: str, attrs: str, inside: int, reopen: bool = False) -> int:
    if reopen and inside == FURNITURE and tag in CONTENT_TAGS:
        return CONTENT
    if inside == FURNITURE or tag in FURNITURE_TAGS:
        return FURNITURE
    if tag == "header" and inside != CONTENT:
        return FURNITURE
    named = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)} if attrs.strip() else {}
    if "hidden" in named or named.get("aria-hidden") == "true":
        return FURNITURE
    role = named.get("role", "").lower()
    if role in FURNITURE_ROLES:
        return FURNITURE
    names = f"{named.get('class', '')} {named.get('id', '')}".lower().split()
    if tag not in ("html", "body", *CONTENT_TAGS) and any(map(furniture_name, names)):
        return FURNITURE
    if tag in CONTENT_TAGS or role == "main" or named.get("itemprop") == "articleBody":
        return CONTENT
    return inside


def blocks(page: str) -> list[tuple[int, str]]:
    """(zone, text) of every block with text, in page order.

    A form goes unless it wraps the page: it holds a container, or more than
    half of the text.  A container inside furniture is furniture too (readers'
    comments are articles as well), unless the page has no other text."""
    found, lost = _blocks(page, False)
    return found if found or not lost else _blocks(page, True)[0]


def _blocks(page: str, reopen: bool) -> tuple[list[tuple[int, str]], bool]:
    """Blocks, and whether a container lay in furniture."""
    out: list[tuple[int, str]] = []
    forms, wrapping, lost = 0, set(), False
    parts: list[str] = []
    stack: list[tuple[str, int]] = []
    open_tags: Counter[str] = Counter()
    zone, at, n = OPEN, 0, len(page)

    def end_block() -> None:
        if parts:
            if zone != FURNITURE:
                text = " ".join(html.unescape("".join(parts)).split())
                if text:
                    out.append((zone, text))
            parts.clear()

    def close(tag: str) -> None:
        nonlocal zone
        while True:
            t, _ = stack.pop()
            open_tags[t] -= 1
            if t == tag:
                break
        zone = stack[-1][1] if stack else OPEN

    while at < n:
        low = page.find("<", at)
        if low < 0:
            parts.append(page[at:])
            break
        if low > at:
            parts.append(page[at:low])
        m = _TOKEN.match(page, low)
        if m is None:
            parts.append("<")
            at = low + 1
            continue
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag in BLOCKS:
                end_block()
            # An inline end tag never closes a block that is still open.
            if open_tags[tag] and (tag in BLOCKS or _inline_top(stack, tag)):
                if _zone_below(stack, tag) != zone:
                    end_block()
                close(tag)
            continue
        if tag in RAW:
            end = _RAW_END[tag].search(page, at)
            if not m[3].rstrip().endswith("/"):
                at = n if end is None else page.find(">", end.end()) + 1 or n
            continue
        if tag in ("br", "td", "th"):
            parts.append(" ")
        if tag in BLOCKS:
            end_block()
            if open_tags["p"] and _inline_top(stack, "p"):
                close("p")
        if tag in VOID or m[3].rstrip().endswith("/"):
            continue
        inner = _zone(tag, m[3], zone, reopen)
        if tag == "form" and inner == CONTENT:
            inner = FURNITURE
        elif tag == "form" and inner == OPEN:
            forms += 1
            inner = -forms
        if tag in CONTENT_TAGS:
            lost |= inner == FURNITURE
            if inner == CONTENT:
                wrapping.update(z for _, z in stack if z < 0)
        if inner != zone:
            end_block()
        stack.append((tag, inner))
        open_tags[tag] += 1
        zone = inner
    end_block()
    if forms:
        size: Counter[int] = Counter()
        for z, text in out:
            size[z] += len(text)
        wrapping.update(z for z in size if z < 0 and 2 * size[z] > size.total())
        out = [(OPEN if z < 0 else z, text) for z, text in out if z >= 0 or z in wrapping]
    return out, lost


def _zone_below(stack: list[tuple[str, int]], tag: str) -> int:
    """The zone once the innermost ``tag`` is closed."""
    for k in range(len(stack) - 1, -1, -1):
        if stack[k][0] == tag:
            return stack[k - 1][1] if k else OPEN
    return OPEN


def _inline_top(stack: list[tuple[str, int]], tag: str) -> bool:
    """Whether ``tag`` is open with only inline elements above it."""
    for t, _ in reversed(stack):
        if t == tag:
            return True
        if t in BLOCKS:
            return False
    return False


def _texts(pages: DataFrame) -> DataFrame:
    """page_id, url, host, blocks, inside: the blocks outside furniture, and
    whether each lies in a content container."""
    schema = "page_id long, url string, host string, blocks array<string>, inside array<boolean>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                found = [blocks(page) for page in part.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3],
                     pa.array([[t for _, t in f] for f in found], pa.list_(pa.string())),
                     pa.array([[z == CONTENT for z, _ in f] for f in found], pa.list_(pa.bool_()))],
                    names=["page_id", "url", "host", "blocks", "inside"])

    return pages.select(
        F.col("page_id").cast("long"), "url", host_of(F.col("url")).alias("host"),
        F.coalesce("html", F.lit("")).alias("html")).mapInArrow(run, schema)


def suffix_ranks(ids: np.ndarray, depth: int = RUN) -> np.ndarray:
    """Ranks of all suffixes of a token stream by their first ``depth``
    tokens (prefix doubling; depth a power of two): the suffix array is their
    argsort, and equal ranks share ``depth`` tokens."""
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    step = 1
    while step < depth:
        after = np.zeros_like(rank)
        after[:-step] = rank[step:] + 1
        rank = np.unique(rank * (len(rank) + 2) + after, return_inverse=True)[1]
        step *= 2
    return rank


def _page_words(texts: list[str]) -> list[list[str]]:
    return [t.split() for t in texts]


_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray, x: np.ndarray) -> np.ndarray:
    h = (h ^ x) * _PRIME
    return h ^ (h >> np.uint64(29))


class Stream:
    """Tokens of a batch of pages, run on across block ends: their numbers and
    hashes, the tokens of every block and where each block and page begins."""

    def __init__(self, blocks: pa.ListArray):
        words = pc.split_pattern(blocks.flatten(), " ")
        named = words.flatten().dictionary_encode()
        self.ids = named.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in named.dictionary.to_pylist()], np.uint64)
        self.hashes = hashes[self.ids]
        self.sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        self.block_start = np.r_[0, np.cumsum(self.sizes)]
        self.page_blocks = np.r_[0, np.cumsum(pc.list_value_length(blocks).to_numpy(zero_copy_only=False))]
        self.page_start = self.block_start[self.page_blocks]
        self.page = np.repeat(np.arange(len(blocks)), np.diff(self.page_start))

    def hash_at(self, starts: np.ndarray, length: int) -> np.ndarray:
        """Hash of the ``length`` words from each start."""
        h = np.full(len(starts), length, np.uint64)
        for j in range(length):
            h = _mixed(h, self.hashes[starts + j])
        return h.view(np.int64)

    def run_hashes(self, starts: np.ndarray) -> np.ndarray:
        """``hash_at`` of runs, reckoned for all tokens side by side."""
        k = max(len(self.hashes) - RUN + 1, 0)
        h = np.full(k, RUN, np.uint64)
        for j in range(RUN):
            h = _mixed(h, self.hashes[j:j + k])
        return h.view(np.int64)[starts]

    def run_starts(self) -> np.ndarray:
        """Where ``RUN`` tokens of one page begin."""
        at = np.arange(len(self.ids))
        return at[self.page_start[self.page + 1] - at >= RUN]

    def short(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, tokens, hash) of the blocks that are shorter than a run."""
        found = [(np.zeros(0, np.int64),) * 3]
        for n in range(1, RUN):
            at = self.block_start[:-1][self.sizes == n]
            found.append((at, np.full(len(at), n), self.hash_at(at, n)))
        return tuple(map(np.concatenate, zip(*found)))

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(page, at, tokens, hash) of every run and shorter block."""
        starts, (short, n, hashes) = self.run_starts(), self.short()
        at = np.r_[starts, short]
        page = self.page[at]
        return (page, at - self.page_start[page], np.r_[np.full(len(starts), RUN), n],
                np.r_[self.run_hashes(starts), hashes])


def _sites(hosts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every host, and whether there is one."""
    named = hosts.dictionary_encode()
    of = np.array([xxhash.xxh64_intdigest(h) for h in named.dictionary.to_pylist()] + [0], np.uint64)
    known = named.is_valid().to_numpy(zero_copy_only=False)
    return of[named.indices.fill_null(len(of) - 1).to_numpy(zero_copy_only=False)], known


def _shard_runs(shard: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``RUN``-token substrings and shorter whole blocks of a host's
    pages (host, uid, blocks) with the smallest and largest page that holds
    each: run, low, high."""
    stream = Stream(shard.column(2))
    uids = shard.column(1).to_numpy()
    n = len(stream.ids) + len(uids)
    ids_ = -1 - np.arange(n)  # a separator of its own ends every page
    ids_[np.arange(len(stream.ids)) + stream.page] = stream.ids
    starts, keys, pages = stream.run_starts(), np.zeros(n, np.int64), np.zeros(n, np.int64)
    at = starts + stream.page[starts]
    room = np.zeros(n, bool)
    keys[at], pages[at], room[at] = stream.run_hashes(starts), uids[stream.page[starts]], True
    runs, low, high = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if len(at):
        array = np.argsort(rank := suffix_ranks(ids_), kind="stable")
        array = array[room[array]]
        first = np.flatnonzero(np.r_[True, np.diff(rank[array]) != 0])
        runs.append(keys[array[first]])
        low.append(np.minimum.reduceat(pages[array], first))
        high.append(np.maximum.reduceat(pages[array], first))
    short, _, key = stream.short()
    if len(short):
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0])
        held = uids[stream.page[short[order]]]
        runs.append(key[order][first])
        low.append(np.minimum.reduceat(held, first))
        high.append(np.maximum.reduceat(held, first))
    return tuple(map(np.concatenate, (runs, low, high)))


def _shards(b: pa.RecordBatch, shard_pages: int) -> Iterator[pa.RecordBatch]:
    """The pages of each host among ``shard_pages`` pages of a batch (host,
    uid, blocks), fewer where these have over ``SHARD_CHARS`` characters."""
    at = 0
    while at < b.num_rows:
        part = b.slice(at, shard_pages)
        texts = part.column(2)
        ends = np.r_[0, np.cumsum(pc.utf8_length(texts.flatten()).to_numpy(zero_copy_only=False))][
            np.cumsum(pc.list_value_length(texts).to_numpy(zero_copy_only=False))]
        part = part.slice(0, max(1, int(np.searchsorted(ends, SHARD_CHARS))))
        at += part.num_rows
        for host in pc.unique(part.column(0)).drop_null():
            yield part.filter(pc.equal(part.column(0), host))


def _packed(values: np.ndarray) -> bytes:
    """Sorted numbers below 2**32 as compressed differences."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u4")
    return pa.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * n, "zstd", asbytes=True), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel(), dtype=np.uint64)


def _passes(bit_map: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys >> np.uint64(64 - (8 * len(bit_map)).bit_length() + 1)
    return (bit_map[at >> np.uint64(3)] >> (7 - (at & np.uint64(7))).astype(np.uint8) & 1).astype(bool)


def shared_bits(pages: DataFrame, shard_pages: int = SHARD_PAGES) -> np.ndarray:
    """A bit map by the leading bits of (host, run) hashes, packed: set where
    two pages may share a run, never clear where they do."""
    chars = pages.select(F.sum(F.aggregate("blocks", F.lit(0).cast("long"), lambda a, t: a + F.octet_length(t)))
                         ).first()[0] or 0
    # Runs are at most chars / 2; prose has about chars / 6.
    slices = max(4, (chars // 6 // SLICE_RUNS).bit_length())
    bits = min(max(20, (chars * 6).bit_length()), slices + 32)
    map_bits = min(bits, MAP_BITS)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [np.zeros(0, np.uint64)]
            for shard in _shards(b, shard_pages):
                run, low, high = _shard_runs(shard)
                key = _mixed(run.view(np.uint64), _sites(shard.column(0))[0][0])
                keys += [key, key[low < high]]  # twice: on two pages already
            found = np.sort(np.concatenate(keys) >> np.uint64(64 - bits))
            ends = np.searchsorted(found, np.arange(1, (1 << slices) + 1).astype(np.uint64) << np.uint64(bits - slices))
            low_bits = np.uint64((1 << (bits - slices)) - 1)
            rows = [(i, z - a, _packed(found[a:z] & low_bits))
                    for i, (a, z) in enumerate(zip(np.r_[0, ends[:-1]].tolist(), ends.tolist())) if z > a]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2] for r in rows], pa.binary())], names=["part", "n", "steps"])

    def compare(t: pa.Table) -> pa.Table:
        values = np.sort(np.concatenate([_unpacked(d, n) for d, n in zip(
            t.column("steps").to_pylist(), t.column("n").to_pylist())]))
        mark = np.zeros(1 << (map_bits - slices), bool)
        mark[values[1:][values[1:] == values[:-1]] >> np.uint64(bits - map_bits)] = True
        return pa.table({"part": pa.array([t.column("part")[0].as_py()], pa.int32()),
                         "bits": pa.array([np.packbits(mark).tobytes()], pa.binary())})

    got = pages.select("host", "uid", "blocks").mapInArrow(pack, "part int, n int, steps binary").groupBy(
        "part").applyInArrow(compare, "part int, bits binary").toArrow()
    out = np.zeros((1 << slices, 1 << (map_bits - slices - 3)), np.uint8)
    for part, data in zip(got.column("part").to_pylist(), got.column("bits").to_pylist()):
        out[part] = np.frombuffer(data, np.uint8)
    return out.ravel()


def _closed(bit_map: np.ndarray) -> tuple[int, bytes]:
    """The map as it is broadcast: mostly zeros, which take no room."""
    return len(bit_map), pa.compress(bit_map.tobytes(), "zstd", asbytes=True)


_OPEN: list = [None, None]  # the bytes and the map last opened in this worker


def _opened(bit_map) -> np.ndarray:
    size, data = bit_map.value
    if _OPEN[0] is not data:
        _OPEN[:] = data, np.frombuffer(pa.decompress(data, size, "zstd", asbytes=True), np.uint8)
    return _OPEN[1]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, LOOK_PAGES):
            yield b.slice(at, LOOK_PAGES)


def _passing(pages: DataFrame, bit_map, schema: str, rows) -> DataFrame:
    """Rows of the runs of (host, uid, blocks) that the broadcast map lets
    pass: ``rows`` makes arrays from (batch, page, at, tokens, run)."""
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = _opened(bit_map)
        for b in _parts(batches):
            page, at, n, runs = Stream(b.column(2)).runs()
            site, known = _sites(b.column(0))
            keep = _passes(bits, _mixed(runs.view(np.uint64), site[page])) & known[page]
            yield pa.RecordBatch.from_arrays(rows(b, page[keep], at[keep], n[keep], runs[keep]), names=names)
    return pages.select("host", "uid", "blocks").mapInArrow(run, schema)


def _exact_runs(pages: DataFrame, bit_map) -> DataFrame:
    def rows(b, page, at, n, runs):
        uid = b.column(1).to_numpy()[page]
        host = b.column(0).dictionary_encode()
        hosts = host.indices.fill_null(0).to_numpy(zero_copy_only=False)[page]
        order = np.lexsort((runs, hosts))
        hosts, runs, uid = hosts[order], runs[order], uid[order]
        first = np.flatnonzero(np.r_[True, (np.diff(hosts) != 0) | (np.diff(runs) != 0)][:len(runs)])
        return [host.dictionary.take(pa.array(hosts[first])), pa.array(runs[first]),
                pa.array(np.minimum.reduceat(uid, first) if len(first) else uid),
                pa.array(np.maximum.reduceat(uid, first) if len(first) else uid)]
    return _passing(pages, bit_map, "host string, run long, low long, high long", rows).groupBy("host", "run").agg(
        F.min("low").alias("low"), F.max("high").alias("high")).filter("low < high").select("host", "run")


def repeated_runs(pages: DataFrame, shard_pages: int = SHARD_PAGES) -> DataFrame:
    """(host, uid, blocks) -> (host, run): substrings of ``RUN`` tokens, and
    shorter whole blocks, that distinct pages of the host share."""
    return _exact_runs(pages, pages.sparkSession.sparkContext.broadcast(_closed(shared_bits(pages, shard_pages))))


def _staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder, compressed, and read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").option("parquet.page.size", str(8 << 20)).parquet(path)
    return df.sparkSession.read.parquet(path)


HITS = "array<struct<at:int,n:int,run:long,wide:boolean>>"


def with_hits(pages: DataFrame, bit_map, runs: DataFrame):
    """(pages, hits): rows with host, uid, blocks as their first columns, and a
    function from a batch of them to the places of the written ``runs`` (host,
    run, wide): where those of each page begin, at, n, run, wide.  Up to
    ``BROADCAST_RUNS`` runs are broadcast, more, which the map thins out first,
    are joined."""
    if runs.count() > BROADCAST_RUNS:
        def rows(b, page, at, n, run):
            return [b.column(0).take(pa.array(page)), b.column(1).take(pa.array(page)),
                    pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(run)]
        hits = _passing(pages, bit_map, "host string, uid long, at int, n int, run long", rows).join(
            runs, ["host", "run"]).groupBy("host", "uid").agg(
            F.collect_set(F.struct("at", "n", "run", "wide")).cast(HITS).alias("hits"))
        joined = pages.join(hits, ["host", "uid"], "left").select(*pages.columns, "hits")

        def given(b: pa.RecordBatch) -> tuple:
            hits = b.column(b.num_columns - 1)
            size = pc.fill_null(pc.list_value_length(hits), 0).to_numpy(zero_copy_only=False)
            return (np.r_[0, np.cumsum(size)], *(hits.flatten().field(i).to_numpy(zero_copy_only=False)
                                                 for i in range(4)))
        return joined, given
    t = runs.select("host", "run", "wide").toArrow().combine_chunks()
    keys = np.zeros(0, np.uint64)
    if t.num_rows:
        keys = _mixed(t.column(1).to_numpy().view(np.uint64), _sites(t.column(0).chunk(0))[0])
    order = np.argsort(keys)
    shared = pages.sparkSession.sparkContext.broadcast(
        (keys[order], t.column(2).to_numpy()[order].astype(bool)))

    def look(b: pa.RecordBatch) -> tuple:
        keys, wide = shared.value
        page, at, n, runs = Stream(b.column(2)).runs()
        site, known = _sites(b.column(0))
        key = _mixed(runs.view(np.uint64), site[page])
        # The map first: most runs are not repeated, and a look there is short.
        keep = np.flatnonzero(_passes(_opened(bit_map), key) & known[page])
        if len(keys):
            place = np.minimum(np.searchsorted(keys, key[keep]), len(keys) - 1)
            found = np.flatnonzero(keys[place] == key[keep])
        else:
            found = place = np.zeros(0, np.int64)
        found = found[np.argsort(page[keep[found]], kind="stable")]
        keep, place = keep[found], place[found]
        return (np.searchsorted(page[keep], np.arange(b.num_rows + 1)), at[keep], n[keep], runs[keep], wide[place])
    return pages, look


def _covered(sizes: list[int], covered_at: list[int], lengths: list[int] | None = None) -> np.ndarray:
    """Which tokens of blocks of these sizes go.  A run across a block end
    counts only for blocks that are covered whole, so that two passages that
    often follow each other do not take the first words of the next block."""
    tokens, at = np.asarray(sizes, np.int64), np.asarray(covered_at, np.int64)
    n = np.asarray(lengths, np.int64) if lengths else np.full(len(at), RUN)
    total, block = int(tokens.sum()), np.repeat(np.arange(len(tokens)), tokens)

    def marked(at: np.ndarray, n: np.ndarray) -> np.ndarray:
        ends = np.bincount(np.minimum(at + n, total), minlength=total + 1)
        return np.cumsum(np.bincount(at, minlength=total + 1) - ends)[:total] > 0
    if not len(at):
        return np.zeros(total, bool)
    within = block[at] == block[at + n - 1]
    whole = np.bincount(block, marked(at, n), len(tokens)) == tokens
    return marked(at[within], n[within]) | whole[block]


def unique_blocks(texts: list[str], covered_at: list[int], lengths: list[int] | None = None) -> list[str]:
    """Blocks without the tokens that a run starting at ``covered_at``
    covers."""
    out, base = [], 0
    words = _page_words(texts)
    gone = _covered([*map(len, words)], covered_at, lengths)
    for text, ws in zip(texts, words):
        g = gone[base:base + len(ws)]
        base += len(ws)
        if not g.any():
            out.append(text)
        elif not g.all():
            out.append(" ".join(w for w, x in zip(ws, g) if not x))
    return out


def has_own_text(sizes: list[int], covered_at: list[int], lengths: list[int]) -> bool:
    """Whether blocks with at most half their tokens repeated hold
    ``OWN_SHARE`` of a page's tokens."""
    tokens = np.asarray(sizes, np.int64)
    gone = np.bincount(np.repeat(np.arange(len(tokens)), tokens), _covered(sizes, covered_at, lengths), len(tokens))
    return bool(tokens[2 * gone <= tokens].sum() >= OWN_SHARE * tokens.sum())


def main_blocks(texts: list[str], inside: list[bool], covered: list[tuple[int, int, bool]]) -> list[str]:
    """The main text of a page; ``covered`` has (at, tokens, wide) of its
    boilerplate, of which only the wide reaches into a container."""
    if not covered:
        return [t for t, within in zip(texts, inside) if within] if any(inside) else texts
    if not any(inside):
        return unique_blocks(texts, [c[0] for c in covered], [c[1] for c in covered])
    words = _page_words(texts)
    wide = [c for c in covered if c[2]]
    gone = _covered([*map(len, words)], [c[0] for c in wide], [c[1] for c in wide])
    out, base = [], 0
    for text, ws, within in zip(texts, words, inside):
        g = gone[base:base + len(ws)]
        base += len(ws)
        if within and not g.all():
            out.append(" ".join(w for w, x in zip(ws, g) if not x) if g.any() else text)
    return out or [t for t, within in zip(texts, inside) if within]


def boilerplate(pages: DataFrame, bit_map) -> DataFrame:
    """(host, uid, blocks), equal texts under one uid -> (host, run, wide) of
    what the host repeats."""
    runs = _staged(_exact_runs(pages, bit_map).withColumn("wide", F.lit(False)), "repeated-runs")
    marked, look = with_hits(pages.select("host", "uid", "blocks"), bit_map, runs)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _parts(batches):
            first, places, n, runs, _ = look(b)
            own = [a == z or has_own_text([t.count(" ") + 1 for t in texts], places[a:z], n[a:z].tolist())
                   for texts, a, z in zip(b.column(2).to_pylist(), first, first[1:])]
            # One text for each page with text of its own, one for all others.
            text = pc.if_else(pa.array(own, pa.bool_()), b.column(1), pa.scalar(None, pa.int64()))
            at = pa.array(np.r_[np.arange(b.num_rows), np.repeat(np.arange(b.num_rows), np.diff(first))])
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), pa.concat_arrays([pa.nulls(b.num_rows, pa.int64()), pa.array(runs, pa.int64())]),
                 text.take(at)], names=["host", "run", "text"])
    # Texts of the host (run null), and those that a run stands on.
    counts = _staged(marked.mapInArrow(judge, "host string, run long, text long").distinct().groupBy(
        "host", "run").agg(F.count("*").alias("on")).filter(f"run is null or `on` >= {MIN_TEXTS}"), "run-texts")
    texts = counts.filter("run is null").select("host", F.col("on").alias("texts"))
    return _staged(counts.filter("run is not null").join(broadcast_checked(texts), "host").select(
        "host", "run", (F.col("on") >= WIDE_SHARE * F.col("texts")).alias("wide")), "boilerplate")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    parsed = _staged(_texts(pages).select("host", F.xxhash64("host", "blocks").alias("uid"), "blocks", "inside",
                                          "page_id", "url"), "page-blocks")
    bit_map = pages.sparkSession.sparkContext.broadcast(_closed(shared_bits(parsed)))
    marked, look = with_hits(parsed, bit_map, boilerplate(parsed, bit_map))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _parts(batches):
            first, *places = look(b)
            places = list(zip(*(places[i].tolist() for i in (0, 1, 3))))
            kept = [main_blocks(t, i, places[a:z]) for t, i, a, z in zip(
                b.column(2).to_pylist(), b.column(3).to_pylist(), first, first[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column(4), b.column(5), pa.array(["\n\n".join(k) for k in kept], pa.string())],
                names=["page_id", "url", "text"])
    return marked.mapInArrow(clean, "page_id long, url string, text string").select(
        "*", F.length("text").cast("long").alias("n_chars"))
