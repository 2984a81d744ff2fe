"""Line-first quality rules, in built-in functions only.

Every line is judged on its own: navigation (bars, arrows and the like between short items),
boilerplate (licence, cookie and copyright phrases), symbols instead of punctuation, shouting,
and short lines without an end of sentence. Lines that fail are removed; a document that loses
too much of its text is rejected. Two figures of the whole text reject it too: too few words,
and too many words in five-word windows that occur again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.texts import fresh, quoted

#: White space of the word rule: space, and tab to carriage return.
_SPACE = r"[\x20\x09-\x0D]+"
_SYMBOLS = r"[#*$%&|<>]"

#: Least words of a document; most words in repeated windows, in percent of its words.
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
WINDOW = 5
#: A document is rejected if less than this share of its word characters is left.
LEAST_LEFT = 0.3
#: Lines of at least so many words are judged for symbols and shouting.
_JUDGED_WORDS = 3
#: A line without end of sentence passes from this number of words on.
_LONG_LINE = 4

_BOILERPLATE = (
    r"(?i)licensed under|all rights reserved|copyright \(?c?\)?|terms of (use|service)"
    r"|privacy policy|cookies?\b|subscribe to|sign up for|click here|powered by|javascript"
)
# In lower case; a text that matches the pattern above holds one of them.
_PHRASES = (
    "licensed under",
    "all rights reserved",
    "copyright ",
    "terms of ",
    "privacy policy",
    "cookie",
    "subscribe to",
    "sign up for",
    "click here",
    "powered by",
    "javascript",
)
# Words that end in one of these runs, which stand where punctuation should.
_DECORATED = r"(##+|\*\*+|\$\$+|%%+|&&+|\|\|+|<<+|>>+|!!+|\?\?+)([\x20\x09-\x0D]|\z)"
_NAVIGATION = r"[\x20\x09-\x0D](\||»|›|>|·|•)([\x20\x09-\x0D]|\z)"
# Without one of these a line cannot match the two above; cheap to look for.
_RUNS = r"([#*$%&|<>!?])\1"
_BARS = "[|»›>·•]"
_SENTENCE_END = r"[.!?…:;\"'”»)。！？][\x20\x09-\x0D]*\z"
_WORD = r"[^\x20\x09-\x0D]+"

FIELDS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_lines_removed",
    "kept_chars",
    "base_failed",
    "kept",
    "cleaned",
)


def words(text: Column) -> Column:
    """Words of a text in order; none for the empty text."""
    return F.filter(F.split(text, _SPACE), lambda w: w != "")


def word_chars(text: Column) -> Column:
    """Code points that belong to words."""
    return F.length(F.regexp_replace(text, _SPACE, ""))


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` bound to a variable, so that it is computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _windows(tokens: Column, size: Column) -> Column:
    """A 64-bit hash of the words of every five-word window, in order."""
    count = F.greatest(size - (WINDOW - 1), F.lit(0))

    def shifted(hashes: Column) -> Column:
        parts = [F.slice(hashes, k + 1, count) for k in range(WINDOW)]
        return F.transform(F.arrays_zip(*parts), lambda w: F.xxhash64(w))

    return _let(F.transform(tokens, lambda w: F.xxhash64(w)), shifted)


def _covered(windows: Column) -> Column:
    """Words covered by windows that occur twice or more, the first included.

    Most texts repeat no window, and the number of distinct ones says so. Otherwise windows are
    sorted with their place, so equal ones are neighbours; the places of those are sorted again,
    and each covers the words up to the next, five at most.
    """
    placed = F.sort_array(
        F.transform(windows, lambda h, at: F.struct(h.alias("h"), at.alias("i")))
    )
    begin = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).alias("last"))

    def repeated(sorted_windows: Column) -> Column:
        marked = F.filter(
            sorted_windows,
            lambda w, at: (w["h"] == F.get(sorted_windows, at - 1)["h"])
            | (w["h"] == F.get(sorted_windows, at + 1)["h"]),
        )
        return F.aggregate(
            F.sort_array(F.transform(marked, lambda w: w["i"])),
            begin,
            lambda acc, at: F.struct(
                (acc["n"] + F.least(at - acc["last"], F.lit(WINDOW))).alias("n"), at.alias("last")
            ),
            lambda acc: acc["n"],
        )

    unique = F.size(F.array_distinct(windows)) == F.size(windows)
    return F.when(unique, F.lit(0)).otherwise(_let(placed, repeated)).cast("long")


def line_fails(line: Column, n: Column, phrases: Column) -> Column:
    """Whether a line of ``n`` words is navigation, boilerplate, symbols, shouting or a fragment.

    A line without words passes. ``phrases`` is false if no boilerplate phrase can be in the line.
    """
    navigation = line.rlike(_BARS) & (F.regexp_count(line, F.lit(_NAVIGATION)) * 5 >= n)
    decorated = line.rlike(_RUNS) & (F.regexp_count(line, F.lit(_DECORATED)) * 2 >= n)
    shouting = ~line.rlike(r"\p{Ll}") & line.rlike(r"\p{Lu}")
    fragment = (n < _LONG_LINE) & ~line.rlike(_SENTENCE_END)
    return (n > 0) & (
        fragment
        | ((n >= 2) & navigation)
        | ((n >= _JUDGED_WORDS) & (decorated | shouting))
        | (phrases & line.rlike(_BOILERPLATE))
    )


def _may_hold_phrases(text: Column) -> Column:
    """False only for texts that hold no boilerplate phrase, whatever its case."""
    lowered = F.lower(text)
    found = F.lit(False)
    for phrase in _PHRASES:
        found = found | F.contains(lowered, F.lit(phrase))
    return found


def judge(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the figures of every text, the verdict ``kept`` and the text ``cleaned``.

    Counts cover the whole text, before any line is removed: ``n_words``, ``word_chars``,
    ``n_symbols`` (of ``#*$%&|<>``), ``n_dup_lines`` (lines with a word that equal an earlier
    line) and ``n_repeat_words``. ``base_failed`` is true for fewer than ten words, or if more
    than a fifth of them repeat; ``kept`` is false then, and if less than three tenths of
    the word characters (``kept_chars``) are left after the failing lines (``n_lines_removed`` of
    ``n_lines`` lines with words) went. Lines without words stay in ``cleaned``.

    A null text counts as the empty text: all counts 0, ``base_failed``, not kept, ``cleaned``
    empty. Rows are not moved, so repeated rows stay and an empty table stays empty. Input
    columns named like an output column are replaced.
    """
    names = fresh(df, "text", "lines", "words", "n", "windows", "repeat", "judged", "found")
    whole, lines, tokens, count, windows, repeat, judged, found = names
    kept = [F.col(quoted(c)) for c in df.columns if c not in FIELDS]
    value = F.coalesce(F.col(quoted(text)).cast("string"), F.lit(""))
    full = F.filter(judged, lambda line: line["n"] > 0)
    left = F.filter(judged, lambda line: ~line["fails"])
    staged = (
        df.select(*kept, value.alias(whole))
        .withColumn(lines, F.split(F.col(whole), "\n"))
        .withColumn(tokens, words(F.col(whole)))
        .withColumn(count, F.size(tokens))
        .withColumn(windows, _windows(F.col(tokens), F.col(count)))
        .withColumn(repeat, _covered(F.col(windows)))
        .withColumn(
            judged,
            F.transform(
                lines,
                lambda line: F.struct(
                    line.alias("line"), F.regexp_count(line, F.lit(_WORD)).alias("n")
                ),
            ),
        )
        .withColumn(
            judged,
            _let(
                _may_hold_phrases(F.col(whole)),
                lambda phrases: F.transform(
                    judged,
                    lambda line: F.struct(
                        line["line"].alias("line"),
                        line["n"].alias("n"),
                        line_fails(line["line"], line["n"], phrases).alias("fails"),
                    ),
                ),
            ),
        )
        .withColumn(lines, F.transform(full, lambda line: line["line"]))
        .withColumn(windows, F.array_join(F.transform(left, lambda line: line["line"]), "\n"))
        .withColumn(found, F.size(F.filter(judged, lambda line: line["fails"])))
        .withColumn(tokens, F.length(F.array_join(tokens, "")))
    )
    n, chars, cleaned, removed = F.col(count).cast("long"), *map(F.col, (tokens, windows, found))
    kept_chars = F.when(removed == 0, chars).otherwise(word_chars(cleaned))
    base_failed = (n < LEAST_WORDS) | (100 * F.col(repeat) > MOST_REPEATED_PERCENT * n)
    values = {
        "n_words": n,
        "word_chars": chars.cast("long"),
        "n_symbols": F.regexp_count(whole, F.lit(_SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": F.col(repeat),
        "n_lines": F.size(lines).cast("long"),
        "n_lines_removed": removed.cast("long"),
        "kept_chars": kept_chars.cast("long"),
        "base_failed": base_failed,
        "cleaned": cleaned,
    }
    figures = F.struct(*[v.alias(f) for f, v in values.items()])
    kept_columns = [F.col(quoted(c)) for c in df.columns if c not in FIELDS]
    # A generator is the one step that filters on its output are not pushed through: pushed
    # down, every named step would be put into the condition again and again.
    one = staged.select(*kept_columns, F.inline_outer(F.array(figures)))
    enough = F.col("kept_chars") >= F.col("word_chars") * LEAST_LEFT
    judged_rows = one.withColumn("kept", ~F.col("base_failed") & enough)
    return judged_rows.select(*kept_columns, *FIELDS)
