"""Line-first cleaning: lines are judged one by one, and a document goes if too much of it fails.

Column expressions only; each row is judged by itself, so nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.barrier import computed_once
from .common import let, space_words, window_hashes

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
# share of a text's characters (in lines with a word) that may fail before the document goes
MAX_LOST = 0.3
# shares of a line's visible characters: marks that prose rarely has, and exclamation marks
MAX_MARKS, MAX_SHOUTS = 0.12, 0.08
# separators for each word, from which a line counts as navigation, and the fewest separators
NAVIGATION, MIN_SEPARATORS = 0.3, 2
# share of a line's words that may repeat the word before them
MAX_STUTTER = 0.3
# characters up to which a line may be boilerplate as a whole
BOILERPLATE_CHARS = 160
SYMBOLS = r"[#*$%&|<>]"
_MARKS = r"[#*$%&<>{}\[\]\\=_~^@+]"
_SEPARATORS = r"[|»›·•]"
_ANY_MARK = r"[#*$%&<>{}\[\]\\=_~^@+!|»›·•]"
_STUTTER = r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]+)(?= \1(?![^\x20\x09-\x0D]))"
BOILERPLATE = (r"(?i)\b(cookies?|javascript|privacy policy|terms of (use|service)|all rights reserved|lorem ipsum|"
               r"sign (in|up)|log ?in|subscribe|newsletter|click here|read more|share (this|on)|skip to content|"
               r"back to top|add to cart|powered by)\b")


def line_fails(line: Column) -> Column:
    """Whether a line is marks, shouting, stutter, navigation or boilerplate; false if it is blank.

    Most lines hold none of the marks, and then a single search settles the first three rules.
    """
    visible = F.char_length(F.regexp_replace(line, r"[\x20\x09-\x0D]+", ""))
    count = lambda pattern: F.char_length(line) - F.char_length(F.regexp_replace(line, pattern, ""))
    separators = count(_SEPARATORS)
    marked = line.rlike(_ANY_MARK) & (
        (count(_MARKS) > MAX_MARKS * visible)
        | (count("!") > MAX_SHOUTS * visible)
        | ((separators >= MIN_SEPARATORS) & (separators >= NAVIGATION * F.size(space_words(line)))))
    stutters = line.rlike(_STUTTER) & (
        F.size(F.regexp_extract_all(line, F.lit(_STUTTER), 1)) > MAX_STUTTER * F.size(space_words(line)))
    return marked | stutters | ((F.char_length(line) <= BOILERPLATE_CHARS) & line.rlike(BOILERPLATE))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a run of ``window`` words found twice or more, the first included.

    Only texts in which two windows share a hash are sorted, and there windows are compared word by word,
    so the count is exact.
    """
    n = F.size(words) - (window - 1)
    names = [f"w{k}" for k in range(window)]

    def both(a: Column, b: Column) -> Column:
        same = a["w0"] == b["w0"]
        for x in names[1:]:
            same = same & (a[x] == b[x])
        return F.when(same, F.array(a["at"], b["at"]))

    def covered(ordered: Column) -> Column:
        # in sorted order, a repeated window stands beside its copies
        pairs = F.zip_with(F.slice(ordered, 1, n - 1), F.slice(ordered, 2, n - 1), both)
        starts = F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))
        steps = let(starts, lambda s: F.zip_with(
            s, F.slice(s, 2, F.size(s)), lambda a, b: F.least(F.coalesce(b - a, F.lit(window)), F.lit(window))))
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    windows = F.sort_array(F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(
        *[F.get(words, i + (k - 1)).alias(x) for k, x in enumerate(names)], i.alias("at"))))
    hashes = window_hashes(F.transform(words, lambda w: F.xxhash64(w)), window)
    repeats = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(repeats, let(windows, covered)).otherwise(0)


def judged(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """Columns ``keep`` of ``docs`` with the counts, verdict and cleaned text of ``text``.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), lost (share of characters in
    failing lines, 0 if there are none), base_failed, kept (boolean) and clean_text, in which failing lines are
    gone. A missing text is judged like an empty one: no words, so it fails. Rows are independent: repeated
    rows get the same verdict, and other columns of ``docs`` are not looked at.
    """
    long = lambda c: c.cast("long")
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = rows.select("*", space_words(F.col("_text")).alias("_words"), F.split("_text", "\n").alias("_lines"))
    rows = rows.select(
        "*", F.filter("_lines", lambda x: ~line_fails(x)).alias("_good"),
        F.filter("_lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_worded"))
    chars = lambda lines: F.char_length(F.array_join(lines, ""))
    # a filter on the verdict must not write the counts out again and again
    rows = computed_once(
        rows, n_words=long(F.size("_words")), word_chars=long(F.char_length(F.array_join("_words", ""))),
        n_symbols=long(F.octet_length("_text") - F.octet_length(F.regexp_replace("_text", SYMBOLS, ""))),
        n_dup_lines=long(F.size("_worded") - F.size(F.array_distinct("_worded"))),
        n_repeat_words=long(repeated_words(F.col("_words"))),
        lost=F.coalesce(F.try_divide(chars("_lines") - chars("_good"), chars("_lines")), F.lit(0.0)),
        clean_text=F.array_join("_good", "\n")).drop("_text", "_words", "_lines", "_good", "_worded")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("lost") <= MAX_LOST))
