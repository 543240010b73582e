"""BPE encoding and decoding by speculation and verification.

Each word is first cut greedily into its longest known pieces.  A cut is the
exact BPE result if and only if every two neighbours are *compatible*: merging
their joined text would give the same two pieces.  All neighbours of all new
words of a batch are tested at once with array operations; only words with an
incompatible pair are merged step by step.

Failing words of usual length are merged side by side, one merge of each word a
step; long ones alone, with a heap.

The compatibility test runs the merges backwards.  Of two neighbouring pieces
the one made by the later merge is taken apart, down to the parts that touch
each other; the pieces are incompatible if, at any of these stages, the two
touching parts have a merge of their own that comes before the merge just
undone (of equal merges the one further left comes first).

Words are found per run of non-space characters, and runs are cached.  Runs of
plain characters are cut by a compiled pattern; texts with other characters
are normalised and cut by the vocabulary's own normaliser and splitter, so that
their Unicode tables apply.  The merging itself is always this module's.

Defined cases: a null or blank text has no ids and decodes to the empty text;
strings of special tokens inside a text become their ids, as the vocabulary
defines; rows are independent, so ties, repeated rows and null ids are carried
through; an empty table gives no rows.  Texts are read whole; a single word of
any length is merged with a heap, in n log n steps.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Runs of non-space characters kept by a worker, and characters of text whose
# ids are sent back at once.
CACHE_RUNS = 300_000
IDS_PER_BATCH = 500_000
HEAD = 3
# Places of a hash table of merges, as a power of two.
TABLE_BITS = 18
# Words up to this many characters are merged side by side in arrays.
SHORT = 64
SCHEMA = "doc_id long, ids array<int>, decoded string"

NEVER = np.iinfo(np.int64).max
# Characters on which Python's and the vocabulary's Unicode tables cannot
# differ: printable ASCII, common white space, Latin letters that are already
# composed (without the capital dotted I, whose lower case is two characters),
# general punctuation and the euro sign.
_OTHER = re.compile("[^ -~\t\n\rÀ-įı-ž‐-‧€]")
_WORD = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[^\W\d_]+|[0-9]|(?:[^\s\w]|_)+")


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself
    where it is printable, else the next unused character from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class WordBpe:
    """Encoder and decoder for a vocabulary file with end-of-word pieces."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab = dict(model["vocab"])
        size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.size = size
        self.pieces = [""] * size
        for piece, i in vocab.items():
            self.pieces[i] = piece
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for piece, i in self.special.items():
            self.pieces[i] = piece
        whole = Tokenizer.from_file(path)
        self.normalise = whole.normalizer.normalize_str
        self.split = whole.pre_tokenizer.pre_tokenize_str
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(
            self.special, key=len, reverse=True))) + ")") if self.special else None
        letters = _byte_letters()
        self.letters = {b: letters[b] for b in range(256)}

        # A piece's merge: its two parts and the merge's number (-1: none).
        self.left, self.right = np.arange(size), np.arange(size)
        self.rank = np.full(size, -1, np.int64)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for r, (a, b) in enumerate(model["merges"]):
            i, j, k = vocab[a], vocab[b], vocab[a + b]
            self.merges.setdefault((i, j), (r, k))
            if self.rank[k] < 0:
                self.left[k], self.right[k], self.rank[k] = i, j, r
        pairs = np.array([(i * size + j, r) for (i, j), (r, _) in self.merges.items()],
                         np.int64).reshape(-1, 2)
        self.made_by = np.zeros(len(model["merges"]) + 1, np.int64)
        self.made_by[pairs[:, 1]] = [k for _, k in self.merges.values()]
        self.tables = []
        multiplier = 0x9E3779B97F4A7C15
        while len(pairs):
            # Keys that find their place taken go into a table of their own.
            at = self._slot(pairs[:, 0], multiplier)
            table = np.full((1 << TABLE_BITS, 2), -1, np.int64)
            table[at] = pairs
            self.tables.append((multiplier, table[:, 0].copy(), table[:, 1].copy()))
            pairs = pairs[table[at, 0] != pairs[:, 0]]
            multiplier = (multiplier * 0xD1342543DE82EF95 + 2) % (1 << 64) | 1
        self._proposals(vocab)
        self.runs: dict[str, bytes] = {}

    @staticmethod
    def _slot(keys: np.ndarray, multiplier: int) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(multiplier)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def _proposals(self, vocab: dict[str, int]) -> None:
        """Pieces that may be proposed: those that merging their own text
        gives back, which needs compatible parts all the way down."""
        made = np.flatnonzero(self.rank >= 0)
        sound = np.ones(self.size, bool)
        sound[made] = ((self.rank[self.left[made]] < self.rank[made])
                       & (self.rank[self.right[made]] < self.rank[made])
                       & self.compatible(self.left[made], self.right[made], apart=True))
        while True:
            next_sound = sound & sound[self.left] & sound[self.right]
            if (next_sound == sound).all():
                break
            sound = next_sound
        self.inner, self.final = {}, {}
        cut = len(self.suffix)
        for piece, i in vocab.items():
            if sound[i]:
                if cut and piece.endswith(self.suffix) and len(piece) > cut:
                    self.final[piece[:-cut]] = i
                else:
                    self.inner[piece] = i
                    if not cut:
                        self.final[piece] = i
        self.longest = max(map(len, [*self.inner, *self.final]), default=0)
        # Lengths of the inner pieces by their first three characters, falling;
        # shorter pieces may follow any head.
        lengths: dict[str, set[int]] = {}
        for piece in self.inner:
            if len(piece) >= HEAD:
                lengths.setdefault(piece[:HEAD], set(range(1, HEAD))).add(len(piece))
        self.lengths = {h: sorted(ns, reverse=True) for h, ns in lengths.items()}

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * self.size + b
        out = np.full(key.size, NEVER)
        for multiplier, keys, ranks in self.tables:
            at = self._slot(key, multiplier)
            hit = keys[at] == key
            out[hit] = ranks[at[hit]]
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray, apart: bool = False) -> np.ndarray:
        """Whether merging the text of ``a`` and ``b`` gives just these two
        (``apart``: disregarding the merge of the two themselves)."""
        good = np.ones(len(a), bool)
        at, x, y = np.arange(len(a)), np.asarray(a), np.asarray(b)
        before = np.full(len(a), NEVER)  # twice the number of the merge undone last
        while at.size:
            r = self.pair_rank(x, y)
            joins = (r < NEVER // 2) & (2 * np.minimum(r, NEVER // 4) < before)
            if apart:
                joins[:] = False
                apart = False
            good[at[joins]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~joins & ((rx >= 0) | (ry >= 0))
            at, x, y, rx, ry = at[go], x[go], y[go], rx[go], ry[go]
            undo_x = rx > ry
            before = np.where(undo_x, 2 * rx, 2 * ry + 1)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return good

    def propose(self, word: str) -> list[int]:
        """Greedy longest pieces of a word; empty if some character has none."""
        inner, final, lengths, longest = self.inner, self.final, self.lengths, self.longest
        few = range(HEAD - 1, 0, -1)
        out, p, n = [], 0, len(word)
        while p < n:
            if n - p <= longest:
                got = final.get(word[p:])
                if got is not None:
                    out.append(got)
                    return out
            for k in lengths.get(word[p:p + HEAD], few):
                if p + k < n:
                    got = inner.get(word[p:p + k])
                    if got is not None:
                        break
            else:
                return []
            out.append(got)
            p += k
        return out

    def merge(self, word: str) -> list[int]:
        """Exact merging of one word, lowest merge first, leftmost of equals."""
        ids = self._letters_of(word)
        n = len(ids)
        after, ahead = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []

        def offer(k: int) -> None:
            pair = ids[k], ids[after[k]]
            if pair in self.merges:
                r, made = self.merges[pair]
                heapq.heappush(queue, (r, k, made, *pair))

        for k in range(n - 1):
            offer(k)
        while queue:
            _, k, new, a, b = heapq.heappop(queue)
            if ids[k] != a or after[k] >= n or ids[after[k]] != b:
                continue
            gone = after[k]
            ids[k], ids[gone] = new, -1
            after[k] = after[gone]
            if after[k] < n:
                ahead[after[k]] = k
            for j in (ahead[k], k):
                if j >= 0 and after[j] < n:
                    offer(j)
        return [i for i in ids if i >= 0]

    def _letters_of(self, word: str) -> list[int]:
        """Ids of the single characters; unknown characters fall out."""
        last = self.final.get(word[-1:], self.inner.get(word[-1:]))
        return [i for i in [*map(self.inner.get, word[:-1]), last] if i is not None]

    def merge_many(self, words: list[str]) -> list[list[int]]:
        """Exact merging of many words: in each step every word makes its
        lowest merge, the leftmost of equals."""
        cuts = [self._letters_of(w) for w in words]
        lengths = np.array([len(c) for c in cuts], np.int64)
        flat = np.array([i for c in cuts for i in c], np.int64)
        of = np.repeat(np.arange(len(words)), lengths)
        ranks = np.full(flat.size, NEVER)  # of a piece with the next one
        pair = np.flatnonzero(of[1:] == of[:-1])
        ranks[pair] = self.pair_rank(flat[pair], flat[pair + 1])
        done_ids, done_of = [], []
        while flat.size:
            first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            sizes = np.diff(np.r_[first, flat.size])
            low = np.minimum.reduceat(ranks, first)
            goes_on = np.repeat(low < NEVER, sizes)
            done_ids.append(flat[~goes_on])
            done_of.append(of[~goes_on])
            low = np.repeat(low, sizes)[goes_on]
            flat, of, ranks = flat[goes_on], of[goes_on], ranks[goes_on]
            if not flat.size:
                break
            at = np.flatnonzero(ranks == low)
            at = at[np.r_[True, of[at[1:]] != of[at[:-1]]]]
            flat[at] = self.made_by[ranks[at]]
            keep = np.ones(flat.size, bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            flat, of, ranks = flat[keep], of[keep], ranks[keep]
            # The new piece's ranks with its neighbours.
            for k in (place[at], place[at] - 1):
                k = k[k >= 0]
                inside = (k + 1 < flat.size)
                inside[inside] = of[k[inside]] == of[k[inside] + 1]
                ranks[k[~inside]] = NEVER
                k = k[inside]
                ranks[k] = self.pair_rank(flat[k], flat[k + 1])
        ids, of = np.concatenate(done_ids or [flat]), np.concatenate(done_of or [of])
        ids = ids[np.argsort(of, kind="stable")]
        ends = np.cumsum(np.bincount(of, minlength=len(words))).tolist()
        ids = ids.tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Byte-level words -> ids: propose, test all neighbours, merge the
        words that fail."""
        cuts = [self.propose(w) for w in words]
        flat = np.array([i for c in cuts for i in c], np.int64)
        of = np.repeat(np.arange(len(words)), np.array([len(c) for c in cuts], np.int64))
        pair = np.flatnonzero(of[1:] == of[:-1])
        bad = pair[~self.compatible(flat[pair], flat[pair + 1])]
        failed = sorted({*of[bad].tolist(), *(k for k, c in enumerate(cuts) if not c)})
        short = [k for k in failed if len(words[k]) <= SHORT]
        for k, c in zip(short, self.merge_many([words[k] for k in short])):
            cuts[k] = c
        for k in failed:
            if len(words[k]) > SHORT:
                cuts[k] = self.merge(words[k])
        return cuts

    def _words(self, run: str) -> list[str]:
        if run.isascii() and run:
            if run.isalpha():
                return [run]
            if run[-1] in ".," and run[:-1].isalpha():
                return [run[:-1], run[-1]]
        if _OTHER.search(run):
            return [w for w, _ in self.split(run)]
        found = _WORD.findall(run)
        if run.isascii():
            return found
        return ["".join([self.letters[b] for b in w.encode()]) for w in found]

    def _learn(self, runs: list[str]) -> None:
        words = [self._words(r) for r in runs]
        known: dict[str, int] = {}
        for ws in words:
            for w in ws:
                known.setdefault(w, len(known))
        packed = [array("i", c).tobytes() for c in self.encode_words(list(known))]
        for r, ws in zip(runs, words):
            self.runs[r] = b"".join([packed[known[w]] for w in ws])

    def _segment(self, text: str) -> list[str]:
        if not _OTHER.search(text):
            return text.lower().split()
        return self.normalise(text).split(" ")

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text."""
        parts = []  # per text: runs of characters, or the id of a special token
        for t in texts:
            if not t:
                parts.append([])
            elif self.at_special and self.at_special.search(t):
                parts.append([x for s in self.at_special.split(t) for x in (
                    [self.special[s]] if s in self.special else self._segment(s))])
            else:
                parts.append(self._segment(t))
        if len(self.runs) > CACHE_RUNS:
            self.runs.clear()
        runs = self.runs
        new = {r for p in parts for r in p if r not in runs and r.__class__ is str}
        if new:
            self._learn(list(new))
        out = []
        for p in parts:
            try:
                got = b"".join([runs[r] for r in p])
            except KeyError:  # a special token
                got = b"".join([runs[r] if r.__class__ is str else
                                np.array([r], np.int32).tobytes() for r in p])
            out.append(np.frombuffer(got, np.int32))
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The vocabulary has no decoder of its own: pieces, space-joined."""
        pieces = self.pieces
        return " ".join([pieces[i] for i in ids.tolist()])


def public_word_bpe() -> str:
    """Path of the 49k vocabulary of the installed public tokenizers."""
    import public_tokenizers as p
    return p.path("word_bpe_49k.json")


@functools.lru_cache(maxsize=2)
def worker_bpe(path: str) -> WordBpe:
    """One encoder a Python worker, with the runs that earlier tasks learned."""
    return WordBpe(path)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded) of every row of ``docs`` (doc_id, text); ``path``
    names a vocabulary file present on the executors (default: the installed
    public one).  One pass over the texts without a shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_bpe(path or public_word_bpe())
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1)
            # A slice at a time, so that what is sent back stays bounded
            # however long the texts are.
            start, held = 0, 0
            for end, n in enumerate(pa.compute.utf8_length(texts).fill_null(0).to_pylist(), 1):
                held += n
                if held < IDS_PER_BATCH and end < len(texts):
                    continue
                ids = bpe.encode(texts.slice(start, end - start).to_pylist())
                offsets = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(i) for i in ids], out=offsets[1:])
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.slice(start, end - start),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                     pa.array([bpe.decode(i) for i in ids], pa.string())],
                    names=["doc_id", "ids", "decoded"])
                start, held = end, 0
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Digest of ``encode``: number of ids, and SHA-256 of the ids in decimal
    and of the decoded text."""
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return encode(docs, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
