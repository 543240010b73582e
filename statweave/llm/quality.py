"""Quality rules: a threshold table compiled into one Spark projection.

The measures are native column expressions over the whole text; each rule is
a row of ``RULES`` (measure, lower bound, upper bound) and the verdict is the
conjunction of the bounds.  No user function, no shuffle: every document is
judged from its own row.

Defined cases: a null or blank text has no words, fails the length rule and
is not kept; ratios of an empty denominator are 0; a text of any length is
measured whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, rows_of

SYMBOLS = "[#*$%&|<>]"
UPPER = "[A-Z]"

# Very frequent words of the languages of the corpus.
STOP_WORDS = (
    "the of and to in is that it as was for with on are be by at this from have "
    "le la les de des du et un une que qui pour dans est sur en par pas au "
    "der die und das den von zu mit sich des auf für ist im dem ein eine nicht "
    "el los las y por con para se del una es no lo al su como").split()

# The threshold table: a document is kept when every measure lies within its
# bounds (None: open).
RULES: tuple[tuple[str, float | None, float | None], ...] = (
    ("n_words", 10, None),
    ("mean_word_length", 2.0, 12.0),
    ("symbols_per_word", None, 0.1),
    ("stop_word_share", 0.05, None),
    ("dup_line_share", None, 0.5),
    ("upper_share", None, 0.5),
)
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5


def words(text: Column) -> Column:
    """Maximal runs without ASCII white space, in order."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def _n_chars_of(text: Column, char_class: str) -> Column:
    """Characters of a class: pieces between them, less one."""
    return F.size(F.split(text, char_class)) - 1


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a.cast("double") / b).otherwise(F.lit(0.0))


def _covered(h: Column, width: int) -> Column:
    """Size of the union of the ``width``-word windows whose hash occurs
    twice or more: sort (hash, position), keep positions with an equal
    neighbour, then measure the union."""
    pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    def positions(p: Column) -> Column:
        same = F.filter(p, lambda s, k: (
            F.coalesce(F.get(p, k - 1)["h"] == s["h"], F.lit(False))
            | F.coalesce(F.get(p, k + 1)["h"] == s["h"], F.lit(False))))
        return F.array_sort(F.transform(same, lambda s: s["i"]))

    def union_of(q: Column) -> Column:
        steps = F.transform(q, lambda x, k: F.least(
            F.lit(width), F.coalesce(F.get(q, k + 1) - x, F.lit(width))))
        return F.aggregate(steps, F.lit(0), lambda acc, x: acc + x)
    return let(let(pairs, positions), union_of)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``_row`` (the input row) and ``m`` (the struct of its measures).

    ``n_repeat_words`` counts the words inside 5-word windows that occur
    twice or more in the text, first occurrences included.  Windows are
    compared by 64-bit hash; texts whose windows are all distinct (nearly all)
    stop there, the others take O(n log n)."""
    w = REPEAT_WINDOW
    d = rows_of(docs).select("_row", F.coalesce(F.col("_row")[text], F.lit("")).alias("t"))
    d = d.select("_row", "t", words(F.col("t")).alias("ws"), F.filter(
        F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("ls"))
    d = d.select("*", F.transform("ws", lambda x: F.xxhash64(x)).alias("wh"))
    d = d.select("*", F.slice(F.transform("wh", lambda x, i: F.xxhash64(
        x, *[F.get("wh", i + k) for k in range(1, w)])),
        F.lit(1), F.greatest(F.size("wh") - (w - 1), F.lit(0))).alias("h"))
    n, chars = F.size("ws"), F.length(F.array_join("ws", ""))
    dup = F.size("ls") - F.size(F.array_distinct("ls"))
    d = d.select(
        "_row", n.cast("long").alias("n_words"), chars.cast("long").alias("word_chars"),
        _n_chars_of(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"),
        dup.cast("long").alias("n_dup_lines"), F.size("ls").alias("n_lines"),
        F.when(F.size(F.array_distinct("h")) == F.size("h"), F.lit(0)).otherwise(
            _covered(F.col("h"), w)).cast("long").alias("n_repeat_words"),
        F.size(F.filter("ws", lambda x: F.lower(x).isin(STOP_WORDS))).alias("n_stops"),
        _n_chars_of(F.col("t"), UPPER).alias("n_upper"),
        # Not deterministic, so no filter above is pushed below and no
        # measure is ever computed twice.
        F.monotonically_increasing_id().alias("once"))
    return d.select("_row", F.struct(
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        _ratio(F.col("word_chars"), F.col("n_words")).alias("mean_word_length"),
        _ratio(F.col("n_symbols"), F.col("n_words")).alias("symbols_per_word"),
        _ratio(F.col("n_stops"), F.col("n_words")).alias("stop_word_share"),
        _ratio(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_share"),
        _ratio(F.col("n_upper"), F.col("word_chars")).alias("upper_share"),
        "once").alias("m"))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (
        100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def within(m: Column, rules=RULES) -> Column:
    """The threshold table as one boolean expression."""
    ok = F.lit(True)
    for name, low, high in rules:
        if low is not None:
            ok = ok & (m[name] >= low)
        if high is not None:
            ok = ok & (m[name] <= high)
    return ok


def judge(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """``_row`` (the input row), ``m`` (measures), ``base_failed``, ``kept``."""
    m = F.col("m")
    return measure(docs, text).select(
        "_row", "m", base_failed(m).alias("base_failed"),
        (~base_failed(m) & within(m, rules) & (m["once"] >= 0)).alias("kept"))


def report(docs: DataFrame, rules=RULES) -> DataFrame:
    """One row per document: its measures and the verdict."""
    d = judge(docs, rules=rules)
    return d.select(F.col("_row.doc_id").alias("doc_id"),
                    *[F.col(f"m.{c}").alias(c) for c in (
                        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                    "base_failed", "kept")


def keep(docs: DataFrame, rules=RULES) -> DataFrame:
    """The documents that pass, with the columns of the input."""
    return judge(docs, rules=rules).filter("kept").select("_row.*")
