"""Similarity score between two strings (X12) as a native Spark expression.

score = round-half-even(200 * LCS(a, b) / (len a + len b)): the indel-based
ratio (insertions and deletions cost 1, a substitution costs 2), 100 for
equal strings, 0 when one side is empty (T22). The LCS is computed bit-parallel
(``lcs_bits``): one string becomes position masks per character, kept in bigint
words, and each character of the other costs one add, and, or per word. It all
runs inside the JVM and is applied only to candidate pairs that passed the
lossless filters of ``operators.match``. ``lcs_length`` is the textbook dynamic
programme, kept for comparison.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let


def chars(s: Column) -> Column:
    return F.split(s, "")


def lcs_length(a: Column, b: Column) -> Column:
    ac, bc = chars(a), chars(b)
    lb = F.length(b)
    zeros = F.array_repeat(F.lit(0), lb + 1)

    def row(prev, ch):
        def step(cur, j):
            nxt = F.when(ch == F.element_at(bc, j), F.element_at(prev, j) + 1) \
                   .otherwise(F.greatest(F.element_at(prev, j + 1), F.element_at(cur, j)))
            return F.concat(cur, F.array(nxt))
        return F.aggregate(F.sequence(F.lit(1), lb), F.array(F.lit(0)), step)

    dp = F.aggregate(ac, zeros, row)
    return F.when((F.length(a) == 0) | (lb == 0), F.lit(0)).otherwise(F.element_at(dp, lb + 1))


# Bits of a word; two more are left, so that no sum of words overflows (ANSI
# arithmetic raises).
WORD = 62
_ONES = (1 << WORD) - 1


def position_masks(a: Column) -> Column:
    """Map from each character of ``a`` to its positions as bits of bigint
    words. Masks belong to one string: compute them once, before a join."""
    words = F.greatest(F.ceil(F.length(a) / F.lit(WORD)).cast("int"), F.lit(1))
    zero, bit = F.lit(0).cast("long"), F.lit(1).cast("long")

    def word(part: Column, ch: Column) -> Column:
        return F.aggregate(
            F.transform(part, lambda x, i: F.when(x == ch, F.call_function("shiftleft", bit, i))
                        .otherwise(zero)),
            zero, lambda acc, x: acc.bitwiseOR(x))

    def masks(ac: Column) -> Column:
        return let(F.transform(F.sequence(F.lit(0), words - 1), lambda w: F.slice(ac, w * WORD + 1, WORD)),
                   lambda parts: F.map_from_entries(F.transform(F.array_distinct(ac), lambda ch: F.struct(
                       ch, F.transform(parts, lambda part: word(part, ch))))))
    return let(chars(a), masks)


def lcs_bits(masks: Column, la: Column, b: Column) -> Column:
    """LCS length of the string behind ``masks`` (of length ``la``) and ``b``.

    The state has a 0 bit for each position where the LCS grows. A character
    with mask ``m`` turns word ``v`` into ``(v + (v & m)) | (v & ~m)``, the
    carry going on into the next word."""
    bc = chars(b)
    ones = F.lit(_ONES)
    words = F.greatest(F.ceil(la / F.lit(WORD)).cast("int"), F.lit(1))

    def next_word(v: Column, m: Column, carry: Column) -> tuple[Column, Column]:
        total = v + v.bitwiseAND(m) + carry
        return total, total.bitwiseOR(v.bitwiseAND(F.bitwise_not(m))).bitwiseAND(ones)

    def one(v: Column, ch: Column) -> Column:
        return let(F.element_at(F.try_element_at(masks, ch), 1), lambda m: F.when(
            m.isNull(), v).otherwise(next_word(v, m, F.lit(0).cast("long"))[1]))

    def many(v: Column, ch: Column) -> Column:
        def step(m: Column):
            def word(acc: Column, k: Column) -> Column:
                return let(F.element_at(v, k), lambda x: let(F.element_at(m, k), lambda y: let(
                    x + x.bitwiseAND(y) + acc["carry"], lambda total: F.struct(
                        F.concat(acc["out"], F.array(
                            total.bitwiseOR(x.bitwiseAND(F.bitwise_not(y))).bitwiseAND(ones))).alias("out"),
                        F.shiftright(total, WORD).alias("carry")))))
            return word
        start = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("long").alias("carry"))
        return let(F.try_element_at(masks, ch), lambda m: F.when(m.isNull(), v).otherwise(
            F.aggregate(F.sequence(F.lit(1), words), start, step(m))["out"]))

    zeros_one = F.lit(WORD) - F.bit_count(F.aggregate(bc, ones, one))
    zeros_many = F.lit(WORD) * words - F.aggregate(
        F.aggregate(bc, F.array_repeat(ones, words), many), F.lit(0),
        lambda acc, x: acc + F.bit_count(x))
    return (F.when((la == 0) | (F.length(b) == 0), F.lit(0))
             .when(words == 1, zeros_one).otherwise(zeros_many))


def ratio(a: Column, b: Column, lcs: Column | None = None) -> Column:
    l = lcs if lcs is not None else let(  # noqa: E741
        position_masks(a), lambda m: lcs_bits(m, F.length(a), b))
    s = F.length(a) + F.length(b)
    raw = F.bround(F.lit(200.0) * l / s, 0).cast("int")
    return (F.when(a == b, F.lit(100))
             .when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0))
             .otherwise(raw))


class PackedTexts:
    """Strings side by side in one long integer, a guard bit behind each: the
    recurrence of ``lcs_bits`` then runs on all of them at once, as the guard
    bits take up the carries."""

    def __init__(self, texts: Sequence[str]):
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths + 1)[:-1]]).astype(np.int64)
        self._size = int((self.lengths + 1).sum())
        places: dict[str, list[int]] = {}
        for t, at in zip(texts, self.starts.tolist()):
            for i, ch in enumerate(t, at):
                places.setdefault(ch, []).append(i)
        self._masks = {ch: self._bits(at) for ch, at in places.items()}
        self._ones = self._bits([i for at in places.values() for i in at])

    def _bits(self, at: list[int]) -> int:
        flags = np.zeros(self._size, np.uint8)
        flags[at] = 1
        return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")

    def lcs(self, text: str) -> np.ndarray:
        """LCS length of ``text`` with every string."""
        v, ones, masks = self._ones, self._ones, self._masks
        for ch in text:
            m = masks.get(ch)
            if m is not None:
                u = v & m
                v = ((v + u) | (v - u)) & ones
        found = np.frombuffer((ones ^ v).to_bytes(-(-self._size // 8), "little"), np.uint8)
        return np.add.reduceat(np.unpackbits(found, bitorder="little"), self.starts, dtype=np.int64)

    def ratio(self, text: str) -> np.ndarray:
        """``ratio`` of ``text`` with every string."""
        total = self.lengths + len(text)
        score = np.rint(200.0 * self.lcs(text) / np.maximum(total, 1)).astype(np.int32)
        score[total == 0] = 100                      # equal strings, both empty
        return score


def lcs_sql(a: str, b: str) -> str:
    """The same dynamic programme as DuckDB SQL (oracle side)."""
    return (f"list_reduce(string_split({a}, ''), lambda prev, ch: list_reduce(range(1, len({b}) + 1), "
            f"lambda cur, j: list_append(cur, CASE WHEN ch = {b}[j] THEN prev[j] + 1 "
            f"ELSE greatest(prev[j + 1], cur[j]) END), [0]), "
            f"list_transform(range(0, len({b}) + 1), lambda x: 0))[len({b}) + 1]")


def ratio_sql(a: str, b: str) -> str:
    return (f"CASE WHEN {a} = {b} THEN 100 WHEN len({a}) = 0 OR len({b}) = 0 THEN 0 "
            f"ELSE CAST(round_even(200.0 * ({lcs_sql(a, b)}) / (len({a}) + len({b})), 0) AS INTEGER) END")


def masks_sql(a: str) -> str:
    """DuckDB form of ``position_masks`` (oracle side): a map from character
    to its positions in 62-bit words."""
    words = f"greatest(CAST(ceil(len({a}) / {WORD}.0) AS INTEGER), 1)"
    return (f"map_from_entries(list_transform(list_distinct(string_split({a}, '')), lambda c: "
            f"{{'k': c, 'v': list_transform(range(0, {words}), lambda w: CAST(list_sum(list_transform("
            f"range(0, {WORD}), lambda i: CASE WHEN {a}[w * {WORD} + i + 1] = c "
            f"THEN CAST(1 AS BIGINT) << CAST(i AS BIGINT) ELSE 0 END)) AS BIGINT))}}))")


def lcs_bits_sql(masks: str, la: str, b: str) -> str:
    """DuckDB form of ``lcs_bits``; the state carries its overflow as a last
    element."""
    words = f"greatest(CAST(ceil({la} / {WORD}.0) AS INTEGER), 1)"
    total = "(v[k] + (v[k] & m[k]) + acc[len(acc)])"
    step = (f"list_reduce(range(1, {words} + 1), lambda acc, k: list_concat(acc[1:len(acc) - 1], "
            f"[({total} | (v[k] & ~m[k])) & {_ONES}, {total} >> {WORD}]), [CAST(0 AS BIGINT)])")
    step = step.replace("m[k]", f"{masks}[ch][k]")
    state = (f"list_reduce(string_split({b}, ''), lambda v, ch: CASE WHEN {masks}[ch] IS NULL THEN v "
             f"ELSE ({step})[1:{words}] END, list_transform(range(0, {words}), lambda x: {_ONES}))")
    one = (f"list_reduce(string_split({b}, ''), lambda v, ch: CASE WHEN {masks}[ch] IS NULL THEN v "
           f"ELSE ((v + (v & {masks}[ch][1])) | (v & ~{masks}[ch][1])) & {_ONES} END, CAST({_ONES} AS BIGINT))")
    return (f"CASE WHEN {la} = 0 OR len({b}) = 0 THEN 0 WHEN {la} <= {WORD} THEN {WORD} - bit_count({one}) "
            f"ELSE {WORD} * {words} - list_sum(list_transform({state}, lambda w: bit_count(w))) END")


def ratio_bits_sql(a: str, masks: str, b: str) -> str:
    """DuckDB form of ``ratio`` with the masks of ``a`` at hand."""
    return (f"CASE WHEN {a} = {b} THEN 100 WHEN len({a}) = 0 OR len({b}) = 0 THEN 0 "
            f"ELSE CAST(round_even(200.0 * ({lcs_bits_sql(masks, f'len({a})', b)}) / (len({a}) + len({b})), 0)"
            f" AS INTEGER) END")
