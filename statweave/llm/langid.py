"""Language identification by prediction by partial matching (PPM).

For every language a byte context tree of order 0 to 3 is learned and frozen.
A text's score in a language is its exact code length: at each byte the
longest context seen in that language predicts it, with PPM-C escape
probabilities (q / (T + q): q distinct of T symbols) down to shorter contexts
and at last to 1/256.  The language with the shortest code wins; the score
is its posterior probability under equal priors.

The trees are fitted on a bounded sample: about ``docs_per_lang`` whole
documents of each language, drawn by a hash (a documented parameter, not a
function of corpus size), at most ``max_nodes`` context-symbol nodes, the
most frequent ones.  Counting is a Spark aggregate; only the nodes reach the
driver.  Scoring reads every text whole, in Arrow batches, with table lookups
in numpy; documents are independent and nothing is shuffled.

Defined cases: null texts and texts without any letter are ``und`` with score
0; ties go to the language first in code point order; a corpus without
labelled documents makes every prediction ``und``; repeated rows are predicted
alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDER = 3
DOCS_PER_LANG = 1500
MAX_NODES = 1_500_000
PAD = "\n" * ORDER
WINDOW = 1 << 19
UND = "und"
# Contexts with a direct lookup table; others are found by binary search.
DENSE_CONTEXTS = 1 << 16


def _stream(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased UTF-8 bytes, each text after ``ORDER`` line ends, and the
    offsets of the texts."""
    low = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    a = pc.binary_join_element_wise(pa.scalar(PAD, pa.large_string()), low,
                                    pa.scalar("", pa.large_string()))
    if not len(a):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1]
    data = np.frombuffer(a.buffers()[2], np.uint8) if off[-1] else np.zeros(0, np.uint8)
    return data, off


def _gram_keys(data: np.ndarray, order: int) -> np.ndarray:
    """The order+1 last bytes at every position from ORDER on, as integers."""
    n = len(data) - ORDER
    key = np.zeros(max(n, 0), np.int64)
    for back in range(order, -1, -1):
        key = (key << 8) | data[ORDER - back:ORDER - back + n]
    return key


def _inside(off: np.ndarray) -> np.ndarray:
    """For positions from ORDER on: False at the padding of a next text."""
    ok = np.ones(max(int(off[-1]) - ORDER, 0), bool)
    for k in range(ORDER):
        ok[off[1:-1] - ORDER + k] = False
    return ok


def count_grams(sample: DataFrame) -> DataFrame:
    """(lang, text) -> (lang, order, gram, n) for orders 0 to 3."""
    schema = "lang string, order int, gram long, n long"
    out = pa.schema([("lang", pa.string()), ("order", pa.int32()), ("gram", pa.int64()),
                     ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang in sorted(set(b.column(0).to_pylist())):
                texts = b.column(1).filter(pc.equal(b.column(0), lang))
                for at in range(0, len(texts), 256):
                    data, off = _stream(texts.slice(at, 256))
                    ok = _inside(off)
                    for order in range(ORDER + 1):
                        keys, n = np.unique(_gram_keys(data, order)[ok], return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(keys), pa.string()),
                             pa.array(np.full(len(keys), order, np.int32)),
                             pa.array(keys), pa.array(n.astype(np.int64))], schema=out)

    return (sample.select("lang", "text").mapInArrow(run, schema)
            .groupBy("lang", "order", "gram").agg(F.sum("n").alias("n")))


def sample_of(labelled: DataFrame, key: str, docs_per_lang: int) -> DataFrame:
    """About ``docs_per_lang`` documents of each language by the hash of a
    key: one count per language, then a filter; no shuffle of texts."""
    buckets = 1 << 20
    counts = labelled.groupBy("lang").count().collect()  # one row per language
    share = F.lit(None).cast("double")
    for r in counts:
        share = F.when(F.col("lang") == r["lang"], F.lit(docs_per_lang / r["count"])).otherwise(share)
    return labelled.filter(F.pmod(F.xxhash64(key), F.lit(buckets)) < share * buckets)


class Model:
    """Frozen trees of all languages as sorted key tables."""

    def __init__(self, langs: list[str], grams: list[np.ndarray], costs: list[np.ndarray],
                 contexts: list[np.ndarray], escapes: list[np.ndarray]):
        self.langs, self.grams, self.costs = langs, grams, costs
        self.contexts, self.escapes = contexts, escapes
        self._dense = None

    @classmethod
    def from_counts(cls, rows: list[tuple[str, int, int, int]]) -> Model:
        """rows: (lang, order, gram, n)."""
        langs = sorted({r[0] for r in rows})
        m = cls(langs, [], [], [], [])
        code = {x: i for i, x in enumerate(langs)}
        lang = np.array([code[r[0]] for r in rows], np.int64)
        order, gram, n = (np.array([r[i] for r in rows], np.int64) for i in (1, 2, 3))
        for k in range(ORDER + 1):
            at = order == k
            keys, which = np.unique(gram[at], return_inverse=True)
            count = np.zeros((len(keys), len(langs)))
            count[which, lang[at]] = n[at]
            ctx, c_of = np.unique(keys >> 8, return_inverse=True)
            total = np.zeros((len(ctx), len(langs)))
            distinct = np.zeros((len(ctx), len(langs)))
            np.add.at(total, c_of, count)
            np.add.at(distinct, c_of, count > 0)
            whole = np.maximum(total + distinct, 1)
            with np.errstate(divide="ignore"):
                escape = np.where(total > 0, -np.log2(distinct / whole), 0.0)
                cost = -np.log2(count / whole[c_of])
            lower = m.cost(k - 1, keys & ((1 << 8 * k) - 1))
            m.grams.append(keys)
            m.contexts.append(ctx)
            m.escapes.append(escape)
            m.costs.append(np.where(count > 0, cost, escape[c_of] + lower))
        return m

    def cost(self, order: int, keys: np.ndarray) -> np.ndarray:
        """Code length in bits of each gram's last byte after the bytes
        before it, by language (keys x languages)."""
        if order < 0:
            return np.full((len(keys), len(self.langs)), 8.0)
        at, hit = _find(self.grams[order], keys)
        out = np.empty((len(keys), len(self.langs)))
        out[hit] = self.costs[order][at[hit]]
        miss = keys[~hit]
        if len(miss):
            c, seen = _find(self.contexts[order], miss >> 8)
            esc = np.zeros((len(miss), len(self.langs)))
            esc[seen] = self.escapes[order][c[seen]]
            out[~hit] = esc + self.cost(order - 1, miss & ((1 << 8 * order) - 1))
        return out

    def _tables(self):
        """Direct tables for the top order: 3-byte context -> number, number
        and byte -> gram.  Only a speed-up of ``cost``."""
        if self._dense is None:
            ctx, grams = self.contexts[ORDER], self.grams[ORDER]
            number = np.zeros(1 << 24, np.int32)
            number[ctx[:DENSE_CONTEXTS - 1]] = np.arange(1, min(len(ctx), DENSE_CONTEXTS - 1) + 1)
            gram_of = np.zeros((min(len(ctx), DENSE_CONTEXTS - 1) + 1) * 256, np.int32)
            slot = number[grams >> 8].astype(np.int64) * 256 + (grams & 255)
            known = slot >= 256
            gram_of[slot[known]] = np.flatnonzero(known) + 1
            costs = np.vstack([np.zeros((1, len(self.langs))), self.costs[ORDER]]).astype(np.float32)
            self._dense = number, gram_of, costs
        return self._dense

    def code_lengths(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Bits of every text in every language, and its bytes."""
        number, gram_of, costs = self._tables()
        data, off = _stream(texts)
        bits = np.zeros((len(off) - 1, len(self.langs)))
        # Windows of positions; a text longer than a window goes on in the next.
        for low in range(ORDER, len(data), WINDOW):
            high = min(low + WINDOW, len(data))
            part = data[low - ORDER:high].astype(np.int32)
            c = (part[:-3] << 16) | (part[1:-2] << 8) | part[2:-1]
            gram = gram_of[number[c] * 256 + part[3:]]
            cost = costs[gram]
            miss = np.flatnonzero(gram == 0)
            if len(miss):
                keys, which = np.unique((c[miss].astype(np.int64) << 8) | part[3:][miss],
                                        return_inverse=True)
                cost[miss] = self.cost(ORDER, keys)[which]
            first = np.searchsorted(off, low, "right") - 1
            last = np.searchsorted(off, high - 1, "right") - 1
            docs = np.arange(first, last + 1)
            start = np.maximum(off[docs] + ORDER, low) - low
            stop = np.minimum(off[docs + 1], high) - low
            full = start < stop
            if full.any():
                edges = np.column_stack([start[full], stop[full]]).ravel()
                inner = edges[:-1] if edges[-1] >= high - low else edges
                sums = np.add.reduceat(cost, inner, axis=0, dtype=np.float64)[::2]
                bits[docs[full]] += sums
        return bits, np.diff(off) - ORDER

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and bits a byte of every text."""
        letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False)
        letters = letters.to_numpy(zero_copy_only=False)
        if not self.langs:
            return [UND] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        bits, size = self.code_lengths(texts)
        best = bits.argmin(axis=1)
        low = bits[np.arange(len(best)), best]
        score = 1 / np.exp2(np.maximum(low[:, None] - bits, -1000)).sum(axis=1)
        names = [self.langs[i] if ok else UND for i, ok in zip(best, letters)]
        return names, np.where(letters, score, 0.0), low / np.maximum(size, 1)


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def fit(labelled: DataFrame, key: str = "doc_id", docs_per_lang: int = DOCS_PER_LANG,
        max_nodes: int = MAX_NODES) -> Model:
    """Learn from rows (key, lang, text); null languages are left out."""
    known = labelled.select(key, "lang", "text").filter("lang is not null and text is not null")
    nodes = count_grams(sample_of(known, key, docs_per_lang))
    top = nodes.orderBy("order", F.desc("n"), "lang", "gram").limit(max_nodes)
    t = top.toArrow()
    return Model.from_counts(list(zip(*(t.column(c).to_pylist() for c in (
        "lang", "order", "gram", "n"))))) if t.num_rows else Model([], [], [], [], [])


_LOADED: dict = {}


def _loaded(shared) -> Model:
    """The broadcast model, its direct tables built once per Python worker."""
    if shared.id not in _LOADED:
        _LOADED.clear()
        _LOADED[shared.id] = shared.value
    return _LOADED[shared.id]


class _Shared:
    """A broadcast with a name of its own, for the worker's cache."""

    def __init__(self, spark, model: Model):
        import uuid
        self.id, self.b = uuid.uuid4().hex, spark.sparkContext.broadcast(model)

    @property
    def value(self) -> Model:
        return self.b.value


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Input rows with text as ``text``; every other column is carried.
    Adds lang_pred, score."""
    shared = _Shared(docs.sparkSession, model)
    rest = [c for c in docs.columns if c != "text"]
    schema = docs.select(rest).schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _loaded(shared)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                names, score, _ = m.predict(part.column(part.num_columns - 1))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(len(rest))), pa.array(names, pa.string()),
                     pa.array(score)], names=[*rest, "lang_pred", "score"])

    return docs.select(*rest, "text").mapInArrow(run, schema)


def held_out(doc_id="doc_id"):
    """crc32 of the id as text, modulo 4, is 2; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4 == 2


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document."""
    model = fit(docs.filter(~held_out()))
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model)


def keep(docs: DataFrame, min_score: float = 0.5, max_bits: float = 6.0) -> DataFrame:
    """The documents whose language is recognised: not ``und``, score at
    least ``min_score`` and at most ``max_bits`` bits a byte (text that no
    learned language explains costs more).  Columns as in the input."""
    shared = _Shared(docs.sparkSession, fit(docs.select("doc_id", "lang", "text").filter(~held_out())))
    i = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _loaded(shared)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                names, score, bits = m.predict(part.column(i))
                ok = (np.array(names) != UND) & (score >= min_score) & (bits <= max_bits)
                yield part.filter(pa.array(ok))

    return docs.mapInArrow(run, docs.schema)
