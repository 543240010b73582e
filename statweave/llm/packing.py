"""Cost-balanced packing of token sequences.

Every task tokenizes its own documents and packs what it has read, so nothing
is shuffled.  Full windows of ``capacity`` tokens become sequences at once;
the remainders wait in a buffer of ``buffer_docs`` pieces.  A full buffer is
packed in descending order of length: each piece goes to the sequence of
lowest estimated cost (``linear * n + quadratic * n^2`` per piece, the
attention of a document to itself) among those with room for it, and is cut
where none has room.  The sequences of a buffer hold exactly its tokens; only
the last buffer of a task can leave less than a full sequence over, which is
laid out as sequences of descending powers of two, so no sequence is padded.

Defined cases: a null text is the empty text and gives the end token alone;
an empty table gives no rows; repeated rows are packed once each; a null
doc_id is carried through.  ``sequence_id`` is unique over the table (task
number in the upper bits) and stable while the files are dealt out alike.
"""

from __future__ import annotations

import base64
import heapq
import math
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 1024
BUFFER_DOCS = 8192
# Relative cost of a token's own work and of attending to a token before it.
LINEAR, QUADRATIC = 1.0, 1.0 / CAPACITY
END_ID = 0
# Texts are tokenized word by word with a cache of at most so many words.
CACHE_WORDS = 400_000
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, cost double")


def byte_bpe(json_path: str, ranks_path: str, pattern: str) -> Callable[[list[str]], list]:
    """An encoder list of texts -> list of ``uint16`` arrays, equal to the
    ids of ``tokenizers`` for the vocabulary in ``json_path``.

    White space followed by a non-space never lies inside a token, so a text
    cut before single spaces is encoded word by word and words are cached.
    Texts where white space meets a following space, or that name a special
    token, are encoded whole by ``tokenizers``.  New words go through the same vocabulary's
    rank file, which is several times faster."""
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(json_path)
    special = list(whole.get_added_tokens_decoder().values())
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    words = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    odd = re.compile("|".join([r"\s ", r"\s\Z", *[re.escape(s.content) for s in special]]))
    tail = re.compile(r"([A-Za-z]+)([.,])")
    first: dict[str, bytes] = {}
    later: dict[str, bytes] = {}

    def ids(s: str) -> bytes:
        return np.array(words.encode_ordinary(s), np.uint16).tobytes()

    def word(w: str) -> bytes:
        m = tail.fullmatch(w)
        if m:
            head = later.get(m[1])
            if head is None:
                head = later[m[1]] = ids(" " + m[1])
            return head + ids(m[2])
        return ids(" " + w)

    def encode(texts: list[str]) -> list[np.ndarray]:
        out = []
        for t in texts:
            if odd.search(t):
                out.append(np.array(whole.encode(t, add_special_tokens=False).ids, np.uint16))
                continue
            if len(later) > CACHE_WORDS:
                later.clear()
                first.clear()
            ws = t.split(" ")
            head = first.get(ws[0])
            if head is None:
                head = first[ws[0]] = ids(ws[0])
            ws[0] = ""
            try:
                later[""] = b""
                found = b"".join([later[w] for w in ws])
            except KeyError:
                for w in ws:
                    if w not in later:
                        later[w] = word(w)
                found = b"".join([later[w] for w in ws])
            out.append(np.frombuffer(head + found, np.uint16))
        return out
    return encode


def public_byte_bpe() -> Callable[[list[str]], list]:
    """The 50k byte-level vocabulary of the installed public tokenizers."""
    import public_tokenizers as p
    return byte_bpe(p.path("byte_bpe_50k.json"), p.path("byte_bpe_50k.tiktoken"), p.PATTERN)


def attention_cost(n: int) -> float:
    return LINEAR * n + QUADRATIC * n * n


def assign(lengths: list[int], capacities: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Pack pieces into sequences whose capacities sum to at least the
    lengths: descending pieces, each to the cheapest sequence with room; where
    none has room, cut at the roomiest.  -> (piece, start, length, sequence, offset).

    Sequences lie in a heap by (cost, number) for each room left, and a tree
    over the rooms holds the cheapest of each range, so both are found exactly."""
    room, used, cost = list(capacities), [0] * len(capacities), [0.0] * len(capacities)
    size = 1 << max(room, default=0).bit_length()
    none = (math.inf, -1)
    heaps: dict[int, list[tuple[float, int]]] = {}
    for s, r in enumerate(room):
        heaps.setdefault(r, []).append((0.0, s))  # already in heap order
    tree = [none] * (2 * size)
    for r, h in heaps.items():
        if r:
            tree[size + r] = h[0]
    for k in range(size - 1, 0, -1):
        tree[k] = min(tree[2 * k], tree[2 * k + 1])

    def update(r: int) -> None:
        k = size + r
        tree[k] = heaps[r][0] if heaps[r] else none
        while k > 1:
            k >>= 1
            best = min(tree[2 * k], tree[2 * k + 1])
            if tree[k] == best:
                break
            tree[k] = best

    def cheapest(n: int) -> int:
        """Of the sequences with room for ``n``, or -1."""
        best, lo, hi = none, size + n, 2 * size
        while lo < hi:
            if lo & 1:
                best = min(best, tree[lo])
                lo += 1
            lo >>= 1
            hi >>= 1
        return best[1]

    def roomiest() -> int:
        k = 1
        while k < size:
            k = 2 * k + (tree[2 * k + 1] != none)
        return min(heaps[k - size], key=lambda x: x[1])[1]

    out = []
    todo = [(-n, i, 0) for i, n in enumerate(lengths) if n]
    heapq.heapify(todo)
    while todo:
        n, i, start = heapq.heappop(todo)
        n = -n
        got = cheapest(n) if n < size else -1
        if got < 0:
            got = roomiest()
        take, was = min(n, room[got]), room[got]
        out.append((i, start, take, got, used[got]))
        heap = heaps[was]
        if heap[0][1] == got:
            heapq.heappop(heap)
        else:
            heap.remove((cost[got], got))
            heapq.heapify(heap)
        update(was)
        used[got] += take
        room[got] -= take
        cost[got] += attention_cost(take)
        if room[got]:
            heapq.heappush(heaps.setdefault(room[got], []), (cost[got], got))
            update(room[got])
        if take < n:
            heapq.heappush(todo, (-(n - take), i, start + take))
    return out


def power_capacities(total: int, capacity: int, last: bool) -> tuple[list[int], int]:
    """Sequences for ``total`` tokens: full ones and, at the end of a task,
    descending powers of two for the rest; else the rest is left over."""
    full, rest = divmod(total, capacity)
    caps = [capacity] * full
    if last:
        caps += [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        rest = 0
    return caps, rest


class _Packer:
    """The packing state of one task."""

    def __init__(self, task: int, capacity: int, buffer_docs: int):
        self.next_id, self.capacity, self.buffer_docs = task << 36, capacity, buffer_docs
        self.buffer: list[tuple] = []  # (doc_id, start, doc_tokens, ids)
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        n, cap = len(ids), self.capacity
        for start in range(0, n - n % cap, cap):
            self._row(doc_id, start, ids[start:start + cap], n, self.next_id, 0)
            self.next_id += 1
        if n % cap:
            self.buffer.append((doc_id, n - n % cap, n, ids[n - n % cap:]))
        if len(self.buffer) >= self.buffer_docs:
            self.flush(last=False)

    def flush(self, last: bool) -> None:
        pieces = self.buffer
        caps, rest = power_capacities(sum(len(p[3]) for p in pieces), self.capacity, last)
        # What doesn't fill a sequence waits for the next buffer.
        order = sorted(range(len(pieces)), key=lambda i: len(pieces[i][3]))
        keep: list[tuple] = []
        cut: dict[int, int] = {}
        for i in order:
            if not rest:
                break
            d, start, n, ids = pieces[i]
            k = min(rest, len(ids))
            keep.append((d, start + len(ids) - k, n, ids[len(ids) - k:]))
            cut[i] = len(ids) - k
            rest -= k
        lengths = [cut.get(i, len(p[3])) for i, p in enumerate(pieces)]
        for i, start, take, s, offset in assign(lengths, caps):
            d, base, n, ids = pieces[i]
            self._row(d, base + start, ids[start:start + take], n, self.next_id + s, offset)
        self.next_id += len(caps)
        self.buffer = keep

    def _row(self, d, start, ids, n, seq, offset) -> None:
        self.rows.append((d, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), n,
                          seq, offset, attention_cost(len(ids))))

    def take_rows(self, schema: pa.Schema) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        cols = zip(*rows) if rows else [[] for _ in schema]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(cols, schema)], schema=schema)


def pack(docs: DataFrame, make_encoder: Callable[[], Callable] = public_byte_bpe,
         capacity: int = CAPACITY, buffer_docs: int = BUFFER_DOCS) -> DataFrame:
    """One row per piece: which ids of which document lie where.

    -> doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, cost."""
    schema = pa.schema([(n, pa.float64() if t == "double" else pa.int64())
                        for n, t in (c.strip().split(" ") for c in SCHEMA.split(","))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(make_encoder)
        packer = _Packer(TaskContext.get().partitionId(), capacity, buffer_docs)
        end = np.array([END_ID], np.uint16)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(1).to_pylist()
                for d, ids in zip(part.column(0).to_pylist(), encode(texts)):
                    packer.add(d, np.concatenate([ids, end]))
                if len(packer.rows) >= 4096:
                    yield packer.take_rows(schema)
        packer.flush(last=True)
        yield packer.take_rows(schema)

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, SCHEMA)


_ENCODERS: dict = {}


def _encoder(make: Callable[[], Callable]) -> Callable:
    """One encoder (and its cache) per Python worker and vocabulary."""
    key = (make.__module__, make.__qualname__)
    if key not in _ENCODERS:
        _ENCODERS[key] = make()
    return _ENCODERS[key]
