"""License scans by template markup.

A template is the wording of a notice with optional regions ``[[ ... ]]`` and
replaceable regions ``<<n>>`` (any 0 to n words).  It is compiled into a token
automaton; a text matches where the automaton accepts, that is where every
mandatory word stands exactly and nothing but optional or replaced words lies
between.  The base phrases are templates without such regions.

Every document is scanned in one pass over Arrow batches: ASCII letters are
lower-cased and every other ASCII character that is no digit parts words.
Templates whose rarest words do not occur in the text are left out before
the words are looked at one by one.

Defined cases: null texts have no words, no places, empty labels and score
0; repeated rows are scanned alike; texts of any length are scanned whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values: (label, template, base).
BASE = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)
NOTICES = (
    ("cc-by-notice", "[[this work is]] licensed under [[a]] [[creative commons]] cc by [[<<2>>]] 4 0"),
    ("cc-by-text", "licensed under a creative commons attribution [[<<3>>]] [[4 0]] international license"),
    ("gpl-notice", "licensed under the [[gnu]] general public license [[version <<1>>]]"),
    ("gpl-text", "this program is free software you can redistribute it and or modify it under the "
                 "terms of the gnu general public license as published by the free software "
                 "foundation [[either version <<3>> or at your option any later version]]"),
    ("reserved-notice", "copyright [[c]] <<12>> all rights reserved"),
    ("mit-notice", "[[released]] [[licensed]] [[distributed]] under the mit license"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of "
                 "this software and associated documentation files the software to deal in the "
                 "software without restriction including without limitation the rights to use "
                 "copy modify merge publish distribute sublicense and or sell copies of the "
                 "software and to permit persons to whom the software is furnished to do so "
                 "subject to the following conditions the above copyright notice and this "
                 "permission notice [[including the next paragraph]] shall be included in all "
                 "copies or substantial portions of the software"),
    ("apache-notice", "licensed under the apache license [[version 2 0]] [[the license]]"),
    ("bsd-text", "redistribution and use in source and binary forms with or without modification "
                 "are permitted provided that the following conditions are met [[1]] "
                 "redistributions of source code must retain the above copyright notice this "
                 "list of conditions and the following disclaimer"),
    ("isc-text", "permission to use copy modify and [[or]] distribute this software for any purpose "
                 "with or without fee is hereby granted provided that the above copyright notice "
                 "and this permission notice appear in all copies"),
    ("mpl-notice", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)

# One pass maps upper case to lower case and every parting byte to a space.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


@dataclass(frozen=True)
class Automaton:
    """States 0..n; ``steps[s]`` maps a word to the states after it, ``any_[s]``
    the states after any word, ``free[s]`` the states reached without one."""
    label: str
    steps: tuple
    any_: tuple
    free: tuple
    accept: int
    mandatory: tuple
    first: frozenset

    def closure(self, states: set[int]) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return seen

    def match(self, ws: list[bytes], at: int) -> int | None:
        """Words of the longest match that starts at word ``at``."""
        states, end, i = self.closure({0}), None, at
        while states:
            if self.accept in states:
                end = i
            if i >= len(ws):
                break
            after = set()
            for s in states:
                after.update(self.steps[s].get(ws[i], ()))
                after.update(self.any_[s])
            states = self.closure(after)
            i += 1
        return None if end is None or end == at else end - at


def compile_template(label: str, template: str) -> Automaton:
    steps, any_, free = [{}], [[]], [[]]
    mandatory: list[bytes] = []

    def state() -> int:
        steps.append({})
        any_.append([])
        free.append([])
        return len(steps) - 1

    now, opened = 0, []
    for token in re.findall(r"\[\[|\]\]|<<\d+>>|[^\s\[\]<>]+", template):
        if token == "[[":
            opened.append(now)
        elif token == "]]":
            free[opened.pop()].append(now)
        elif token.startswith("<<"):
            start = now
            for _ in range(int(token[2:-2])):
                nxt = state()
                any_[now].append(nxt)
                now = nxt
                free[start].append(now)
            # All numbers of replaced words end in one state.
            end = state()
            for s in range(start, end):
                if s == start or s in free[start]:
                    free[s].append(end)
            free[start] = [t for t in free[start] if t == end or t <= start]
            now = end
        else:
            nxt = state()
            steps[now].setdefault(token.encode(), []).append(nxt)
            now = nxt
            if not opened:
                mandatory.append(token.encode())
    if opened or not mandatory:
        raise ValueError(f"template {label}: unclosed region or no mandatory word")
    a = Automaton(label, tuple(steps), tuple(map(tuple, any_)), tuple(map(tuple, free)), now,
                  tuple(mandatory), frozenset())
    first = {w for s in a.closure({0}) for w in a.steps[s]}
    if any(a.any_[s] for s in a.closure({0})):
        raise ValueError(f"template {label} begins with a replaceable region")
    return Automaton(label, a.steps, a.any_, a.free, now, a.mandatory, frozenset(first))


def compile_all(base=BASE, notices=NOTICES) -> list[tuple[Automaton, bool]]:
    return [(compile_template(*t), True) for t in base] + [
        (compile_template(*t), False) for t in notices]


class Scanner:
    """All templates; a template is tried where its first words stand, and
    only in texts that hold its rare words."""

    def __init__(self, templates: list[tuple[Automaton, bool]]):
        self.templates = templates
        # The longest mandatory words stand for the rare ones.
        self.keys = [sorted(set(a.mandatory), key=lambda w: (-len(w), w))[:3] for a, _ in templates]

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int, int]]]:
        """Number of words, and (template, start, words) of every place."""
        folded = text.translate(_FOLD)
        ws = folded.split()
        live = [k for k, keys in enumerate(self.keys) if all(w in folded for w in keys)]
        if not live:
            return len(ws), []
        have = set(ws)
        live = [k for k in live if have.issuperset(self.templates[k][0].mandatory)]
        starts: dict[bytes, list[int]] = {}
        for k in live:
            for w in self.templates[k][0].first:
                starts.setdefault(w, []).append(k)
        found = []
        for at, w in enumerate(ws) if starts else ():
            for k in starts.get(w, ()):
                n = self.templates[k][0].match(ws, at)
                if n:
                    found.append((k, at, n))
        return len(ws), found


PLACES = "array<struct<label: string, base: boolean, start: long, length: long, mandatory: long>>"


def scan(docs: DataFrame, templates: list[tuple[Automaton, bool]] | None = None) -> DataFrame:
    """doc_id, n_words and every place of every template, in text order."""
    templates = templates or compile_all()
    place = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()),
                                ("length", pa.int64()), ("mandatory", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                n_words, places = [], []
                for t in part.column(1).cast(pa.binary()).to_pylist():
                    n, found = scanner.scan(t)
                    n_words.append(n)
                    places.append([
                        {"label": a.label, "base": base, "start": start, "length": length,
                         "mandatory": len(a.mandatory)}
                        for k, start, length in sorted(found, key=lambda x: (x[1], x[0]))
                        for a, base in [templates[k]]])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n_words, pa.int64()), pa.array(places, place)],
                    names=["doc_id", "n_words", "places"])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")
                       ).mapInArrow(run, f"doc_id long, n_words long, places {PLACES}")


def report(docs: DataFrame) -> DataFrame:
    """The digest of every document's places.

    ``score`` is m / (m + 1) of the longest mandatory wording matched (m
    words), 0 where nothing matches."""
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"])

    def joined(places):
        return F.array_join(F.array_sort(F.array_distinct(
            F.transform(places, lambda p: p["label"]))), ",")
    m = F.array_max(F.transform("places", lambda p: p["mandatory"]))
    return scan(docs).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("places")).alias("labels"),
        F.coalesce(m / (m + 1), F.lit(0.0)).alias("score"))
