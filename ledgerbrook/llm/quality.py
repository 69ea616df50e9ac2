"""Line-first quality rules, in Spark functions only.

Every line is judged by itself: navigation bars, symbol litter, shouting, stutter, boilerplate and
stubs without end punctuation are removed.  A document is then rejected when the base rules fail
(too few words, too many words in repeated windows) or when less than half of its word
characters are left.  Everything about a document is computed in its own row: no shuffle, no skew.

``null`` text is empty: no words, rejected by the base rule.  Very long texts cost time in
proportion to their length (windows are compared by sorting their fingerprints).  Repeated rows
are judged alike, an empty table gives an empty one, and further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base rules.
MIN_WORDS = 20
WINDOW = 8
MAX_REPEATED_PERCENT = 30
SYMBOLS = "#*$%&|<>"

# The line rules.
MIN_SEPARATORS = 3
SYMBOL_PERCENT = 8
SHOUT_PERCENT = 30
STUTTER_WORDS, STUTTER_PERCENT = 10, 20
STUB_WORDS = 4
KEEP_PERCENT = 50

# Phrases of boilerplate lines; the first letter is left out, as its case varies.
BOILERPLATE = [
    "ll rights reserved",
    "icensed under",
    "eleased under",
    "erms of use",
    "erms of service",
    "rivacy policy",
    "ookie policy",
    "lick here",
    "ubscribe to",
    "orem ipsum",
]

_BLANKS = " \t\n\x0b\f\r"
_SPLIT = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]"
_END = r"""[.!?:;"')\]}…。！？][\x20\x09-\x0D]*$"""


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(_BLANKS))
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPLIT))


def word_chars(text: Column) -> Column:
    return F.length(F.translate(text, _BLANKS, ""))


def symbols(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[{SYMBOLS}]"))


def duplicate_lines(lines: Column) -> Column:
    return let(
        F.filter(lines, lambda line: line.rlike(_WORD)),
        lambda kept: F.size(kept) - F.size(F.array_distinct(kept)),
    ).cast("bigint")


def _covered(windows: Column) -> Column:
    """Words inside windows whose fingerprint occurs twice or more."""
    ordered = F.array_sort(F.transform(windows, lambda h, at: F.struct(h.alias("h"), at.alias("at"))))

    def repeated(order: Column) -> Column:
        same = F.filter(
            order,
            lambda x, i: (x["h"] == F.get(order, i - 1)["h"]).eqNullSafe(True)
            | (x["h"] == F.get(order, i + 1)["h"]).eqNullSafe(True),
        )
        return F.array_sort(F.transform(same, lambda x: x["at"]))

    def total(starts: Column) -> Column:
        steps = F.transform(
            starts, lambda at, i: F.coalesce(F.least(F.lit(WINDOW), F.get(starts, i + 1) - at), F.lit(WINDOW))
        )
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda sum_, step: sum_ + step)

    return let(let(ordered, repeated), total)


def repeated_words(words_: Column) -> Column:
    """Words in ``WINDOW``-word windows found twice or more in the text.

    Windows are fingerprinted from words over stretches of four to eight words, and only
    texts with an equal pair of fingerprints are looked at further.
    """

    def join(*steps: int) -> Callable[[Column], Column]:
        return lambda names: F.transform(
            names, lambda h, i: F.xxhash64(h, *[F.get(names, i + step) for step in steps])
        )

    def judge(windows: Column) -> Column:
        return F.when(
            F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("bigint")
        ).otherwise(_covered(windows))

    names = F.transform(words_, lambda word: F.xxhash64(word))
    names = let(let(names, join(1, 2, 3)), join(4))
    windows = F.slice(names, 1, F.greatest(F.size(words_) - (WINDOW - 1), F.lit(0)))
    return F.when(F.size(words_) <= WINDOW, F.lit(0).cast("bigint")).otherwise(let(windows, judge))


def good_line(line: Column) -> Column:
    """Whether a line stays; blank lines do."""

    def judge(parts: Column) -> Column:
        n = F.size(parts)
        shouts = (F.length(line) - F.length(F.replace(line, F.lit("!!"), F.lit("")))) / 2
        failed = (
            (F.regexp_count(line, F.lit("[|»›•]")) >= MIN_SEPARATORS)
            | (100 * symbols(line) > SYMBOL_PERCENT * F.length(line))
            | (100 * shouts > SHOUT_PERCENT * n)
            | reduce(or_, [line.contains(phrase) for phrase in BOILERPLATE])
            | ((n >= STUTTER_WORDS) & (100 * F.size(F.array_distinct(parts)) < STUTTER_PERCENT * n))
            | ((n < STUB_WORDS) & ~line.rlike(_END))
        )
        return (n == 0) | ~failed

    return let(words(line), judge)


def judge(table: DataFrame, *, text: str = "text") -> DataFrame:
    """The table's columns with the measures, ``clean_text`` and the verdict ``kept``.

    Columns of the table that have the name of a measure are replaced.
    """
    raw = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    # Longer than any column's name, so that none clashes.
    mark = "_" * (1 + max(map(len, table.columns)))
    measures = {
        f"{mark}text": raw,
        f"{mark}words": words(raw),
        f"{mark}lines": F.split(raw, "\n"),
    }
    frame = table.select("*", *[column.alias(name) for name, column in measures.items()])
    # One row in, one row out: keeps the optimizer from computing the arrays once per use.
    frame = frame.withColumn(f"{mark}all", F.explode(F.array(F.struct(*measures)))).drop(*measures)
    body, parts, lines = (F.col(f"{mark}all.{mark}{name}") for name in ("text", "words", "lines"))
    frame = frame.withColumns(
        {
            "n_words": F.size(parts).cast("bigint"),
            "word_chars": word_chars(body).cast("bigint"),
            "n_symbols": symbols(body).cast("bigint"),
            "n_dup_lines": duplicate_lines(lines),
            "n_repeat_words": repeated_words(parts),
            "clean_text": F.array_join(F.filter(lines, good_line), "\n"),
        }
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    return (
        frame.withColumn("base_failed", failed)
        .withColumn("clean_chars", word_chars(F.col("clean_text")).cast("bigint"))
        .withColumn(
            "kept",
            ~F.col("base_failed") & (100 * F.col("clean_chars") >= KEEP_PERCENT * F.col("word_chars")),
        )
        .drop(f"{mark}all")
    )
