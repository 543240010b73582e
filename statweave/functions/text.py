"""Text column functions. All are built-in Spark expressions (JVM side,
inside whole-stage codegen); the only Python work is building a translate
table once on the driver from ``unicodedata``."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..specs import REFERENCE_NAME_ALIASES, REFERENCE_STOP_TOKENS


def _ranges(cps: list[int]) -> str:
    """Code points as a regex class body of hex-escape ranges, in the
    ``\\x{HHHH}`` form that both Java and RE2 accept."""
    out, i = [], 0
    while i < len(cps):
        j = i
        while j + 1 < len(cps) and cps[j + 1] == cps[j] + 1:
            j += 1
        a, b = cps[i], cps[j]
        out.append(f"\\x{{{a:X}}}" if a == b else f"\\x{{{a:X}}}-\\x{{{b:X}}}")
        i = j + 1
    return "".join(out)


# Built by rule from Python's own character tables, so the Spark expressions
# agree with str.split()/str.strip()/str.isupper() and stay JVM-side.
WS_CHARS = "".join(chr(c) for c in range(0x3000 + 1) if chr(c).isspace())
WS_BODY = _ranges([ord(ch) for ch in WS_CHARS])
WS = f"[{WS_BODY}]"
UPPER_EXTRA_BODY = _ranges([c for c in range(0x20000)
                            if chr(c).isupper() and unicodedata.category(chr(c)) != "Lu"])


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``: lambda
    functions evaluate what they capture anew for every element, unless it is
    bound to a lambda variable itself."""
    return F.element_at(F.transform(F.array(value), body), 1)


def trim_ws(c: Column) -> Column:
    """``str.strip()``: all leading/trailing whitespace, not only spaces.
    A character-set trim, not a regex."""
    return F.trim(c, F.lit(WS_CHARS))


def first_token(c: Column, default: str = "Unknown") -> Column:
    """First whitespace token, ``default`` when NULL or blank."""
    return F.coalesce(F.nullif(F.regexp_extract(c, rf"\A{WS}*([^{WS_BODY}]+)", 1),
                               F.lit("")), F.lit(default))


UPPER_CLASS = rf"[^\p{{Lu}}{UPPER_EXTRA_BODY}]+"


def extract_uppercase(c: Column) -> Column:
    """Keep characters for which ``str.isupper()`` holds (category Lu plus the
    other upper-case characters such as circled capitals); NULL when none
    (X4). The missing sentinel is applied only at the sink."""
    return F.nullif(F.regexp_replace(c, UPPER_CLASS, ""), F.lit(""))


# Python's word class is letters, numbers and '_'; its space class is the
# Unicode whitespace above.
SANITIZE_CLASS = rf"[^\p{{L}}\p{{N}}_{WS_BODY}-]"


def sanitize_name(c: Column) -> Column:
    """Safe name: '/' -> '_', '%' -> 'percent', other non-word, non-space,
    non-hyphen characters -> '_', then strip (X9). The word class is spelled
    out (letters, numbers, '_') so it is Unicode-aware as in Python (T32)."""
    s = F.replace(F.replace(c, F.lit("/"), F.lit("_")), F.lit("%"), F.lit("percent"))
    s = F.regexp_replace(s, SANITIZE_CLASS, "_")
    return trim_ws(s)


@functools.lru_cache(maxsize=2)
def _accent_table(whitespace_to_space: bool = False) -> tuple[str, str]:
    """Translate table for NFD + drop of combining marks (category Mn):
    characters whose canonical decomposition is one base character plus
    marks map to that base character; free-standing marks are deleted (they
    sit at the end of ``from`` with no counterpart in ``to``). Optionally
    every whitespace character maps to a plain space. Built by rule from
    ``unicodedata`` (Hangul and other multi-letter decompositions are left
    alone)."""
    src, dst = [], []
    if whitespace_to_space:
        for ch in WS_CHARS:
            if ch != " ":
                src.append(ch)
                dst.append(" ")
    for cp in range(0xC0, 0x30000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        d = unicodedata.normalize("NFD", ch)
        if d == ch:
            continue
        base = "".join(x for x in d if unicodedata.category(x) != "Mn")
        if len(base) == 1 and base != ch:
            src.append(ch)
            dst.append(base)
    marks = [chr(cp) for cp in (*range(0x300, 0x30000), *range(0xE0100, 0xE01F0))
             if not 0xD800 <= cp <= 0xDFFF and unicodedata.category(chr(cp)) == "Mn"]
    return "".join(src + marks), "".join(dst)


def strip_accents(c: Column) -> Column:
    """NFD then drop combining marks (X6), as one ``translate``. 'Ø', 'Đ'
    have no decomposition and stay."""
    frm, to = _accent_table()
    return F.translate(c, frm, to)


def normalize_name(c: Column, stop_tokens: list[str] | None = None,
                   aliases: dict[str, str] | None = None) -> Column:
    """Strip accents, lower-case, split on whitespace, strip periods from
    each token, drop stop tokens, join with one space, map aliases (X6-X8).
    Tokens emptied by the period strip are kept, as in the reference.

    No regular expression: one ``translate`` (accents out, every whitespace
    to ' '), ``lower``, a split on the single space, and array functions."""
    stop = REFERENCE_STOP_TOKENS if stop_tokens is None else stop_tokens
    amap = REFERENCE_NAME_ALIASES if aliases is None else aliases
    frm, to = _accent_table(whitespace_to_space=True)
    low = F.lower(F.translate(c, frm, to))
    toks = F.filter(F.split(low, " "), lambda t: t != F.lit(""))
    toks = F.transform(toks, lambda t: F.trim(t, F.lit(".")))
    if stop:
        toks = F.filter(toks, lambda t: ~t.isin(*stop))
    joined = F.array_join(toks, " ")
    if not amap:
        return joined
    m = F.create_map(*[x for kv in amap.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return F.coalesce(F.try_element_at(m, joined), joined)


def join_or_none(arr: Column, sep: str = ", ", none: str = "None") -> Column:
    """``', '.join(x) or 'None'`` (X11)."""
    return F.coalesce(F.nullif(F.array_join(arr, sep), F.lit("")), F.lit(none))
