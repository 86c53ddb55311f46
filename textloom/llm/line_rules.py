"""Quality rules that clean line by line first, in DataFrame functions only.

Every line is judged by rules on punctuation, navigation and boilerplate. Lines that
fail are removed; a document is rejected if the lines that stay hold too little of its
text. Measures of the whole text give base rules, which reject on their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
WINDOW_WORDS = 5
SYMBOLS = "#*$%&|<>"
#: Lower limits of the words of a text and of the share of its words that lines must keep.
LEAST_WORDS = 10
LEAST_SHARE = 0.5
MOST_REPEATED = 20
#: A line of navigation: at least this many separators, and as many as a third of its words.
SEPARATORS = 3
# Phrases of page furniture, in lower case.
BOILERPLATE = (
    "cookie policy", "accept cookies", "all rights reserved", "privacy policy", "terms of use", "terms of service",
    "click here", "read more", "sign up", "log in", "subscribe to our", "share on facebook", "share on twitter",
    "enable javascript", "javascript is disabled", "skip to content", "back to top", "powered by", "lorem ipsum",
)
#: A phrase fails lines of up to so many words: in longer ones it is a part of a sentence.
SHORT_LINE = 12
LETTER = "a-z\u00df-\u00f6\u00f8-\u00ff"
PHRASE = f"(^|[^{LETTER}])({'|'.join(BOILERPLATE)})([^{LETTER}]|$)"


def words(text: Column) -> Column:
    """Words of a text, in order; a null has none."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def repeated_words(word_list: Column, size: int = WINDOW_WORDS) -> Column:
    """Words inside windows of ``size`` words that the text has twice or more, first ones included.

    Windows are compared by a 64-bit hash of their words. Sorted with their places,
    equal windows are neighbours; the union of the repeated windows is then measured
    from place to place. All steps are linear but for the sort, and stay in one row.
    """
    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(hashes) - size + 1)
        return F.sort_array(F.transform(starts, lambda i: F.struct(
            F.xxhash64(F.slice(hashes, i, size)).alias("h"), i.alias("at"))))

    def repeated(ordered: Column) -> Column:
        def same(w: Column, i: Column) -> Column:
            return F.coalesce(F.get(ordered, i)["h"] == w["h"], F.lit(False))

        twins = F.filter(ordered, lambda w, i: same(w, i - 1) | same(w, i + 1))
        return F.sort_array(F.transform(twins, lambda w: w["at"]))

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, i: F.least(F.lit(size), F.coalesce(F.get(places, i + 1) - p,
                                                                                 F.lit(size))))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    hashed = F.transform(word_list, lambda w: F.xxhash64(w))
    counted = let(hashed, lambda h: let(windows(h), lambda o: let(repeated(o), covered)))
    return F.when(F.size(word_list) <= size, F.lit(0)).otherwise(counted).cast("long")


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def navigation(line: Column, n_words: Column) -> Column:
    """A row of links: separators between few words."""
    n = _count(line, "[|\u00bb\u203a\u2022]")
    return (n >= SEPARATORS) & (n * 3 >= n_words)


def bad_punctuation(line: Column, n_words: Column) -> Column:
    """A short line without an end mark, or marks and symbols on a third of the words or more."""
    short = (n_words < 3) & ~line.rlike(r"[.!?:;\u2026\"')\u00bb\u201d][\x20\x09-\x0D]*$")
    marks = _count(line, "[#*$%&<>]+|!!+")
    return short | ((marks >= 3) & (marks * 3 >= n_words))


def boilerplate(line: Column, n_words: Column) -> Column:
    """A short line that holds a phrase of page furniture, as words of its own."""
    return (n_words <= SHORT_LINE) & F.lower(line).rlike(PHRASE)


def kept_words(line: Column) -> Column:
    """Words of a line, 0 if the line fails."""
    return let(_count(line, WORD), lambda n: F.when(
        navigation(line, n) | bad_punctuation(line, n) | boilerplate(line, n), 0).otherwise(n))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def clean_text(text: Column) -> Column:
    """The lines that stay; empty lines stay too."""
    return F.array_join(F.filter(lines_of(text), lambda line: (kept_words(line) > 0) | (_count(line, WORD) == 0)), "\n")


def judge(docs: DataFrame) -> DataFrame:
    """Measures and verdict for each row of ``docs (doc_id, text)``; see the module for the rules.

    Null and empty texts have no words: all measures 0, base_failed, not kept.
    Repeated rows are judged alike, one row each; other columns are ignored; an empty
    table gives no rows. The job is narrow: nothing is shuffled.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("w", words(F.col("text")))
    word_lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(WORD))
    kept = F.aggregate(F.split("text", "\n", -1), F.lit(0), lambda total, line: total + kept_words(line))
    measured = rows.select(
        "doc_id", F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        _count(F.col("text"), "[#*$%&|<>]").cast("long").alias("n_symbols"),
        let(word_lines, lambda found: F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("w")).alias("n_repeat_words"), kept.cast("long").alias("n_kept_words"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return (measured.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("n_kept_words") >= LEAST_SHARE * F.col("n_words"))))
