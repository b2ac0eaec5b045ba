"""Quality rules of texts: one table of thresholds, compiled into one projection of Spark columns.

:func:`measured` counts words, symbols, letters, stop words, lines and repeats of every whole text, :func:`verdict` compiles a
threshold table into a single column that lists the rules a row breaks. Both are plain columns: nothing is shuffled, a text is
judged in the task that reads it, and one text is all that has to fit in memory.

Words are maximal runs without ASCII white space, lines the parts between line feeds that hold a word. A word counts as repeated if
it stands in a window of five words that the text holds twice or more, wherever the copies stand, the first included. Windows are
told apart by a 64-bit hash: in a text of a million words two different windows are taken for equal with a chance of about 3e-8.

The base rule (``base_failed``): under ``BASE_WORDS`` words, or over ``BASE_REPEATED`` % of the words repeated. The table
``THRESHOLDS`` holds ratios; a ratio whose divisor is 0 breaks no rule. Rules that need blanks between words, or the stop words of the four
listed languages, say so in ``where``.

Defined results: a null or empty text has no words, all counts 0, and fails the base rule. Equal rows get equal verdicts, row by row.
An empty table gives no rows. Columns of the input that bear the name of a result column are replaced, others stay. The column lang may be
missing or null: then the stop-word rule doesn't apply.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra.llm.stopwords import ALL_STOP_WORDS, STOP_WORDS

BASE_WORDS = 10
BASE_REPEATED = 20
WINDOW = 5

# Character classes, as both Java and RE2 read them.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\x0c\r"
NO_SYMBOL, NO_CAPITAL = "[^#*$%&|<>]+", r"[^\p{Lu}]+"
LETTERS = r"\p{L}+"
BULLET = rf"^{BLANK}*[-*•‣◦]"
ELLIPSIS = rf"(\.\.\.|…){BLANK}*\z"
#: Thai, Lao, Burmese, Khmer, Japanese and Chinese have no blanks between words.
UNSPACED = r"[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{9FFF}]"
# End of fixed values.


@dataclass(frozen=True)
class Threshold:
    """A rule: ``over`` / ``per`` must lie from ``least`` to ``most`` for the rows ``where`` selects."""

    name: str
    over: str
    per: str
    least: float | None = None
    most: float | None = None
    where: str = "true"


THRESHOLDS = (
    Threshold("word_length", "word_chars", "n_words", least=2.0, most=15.0, where="NOT unspaced"),
    Threshold("symbols", "n_symbols", "n_words", most=0.1),
    Threshold("letters", "n_letters", "word_chars", least=0.4),
    Threshold("capitals", "n_capitals", "n_letters", most=0.5),
    Threshold("stop_words", "n_stop_words", "n_words", least=0.05, where="n_words >= 50 AND listed_lang"),
    Threshold("repeated_lines", "n_dup_lines", "n_lines", most=0.5),
    Threshold("repeated_lines_long", "n_dup_lines", "n_lines", most=0.3, where="n_lines >= 10"),
    Threshold("bullet_lines", "n_bullet_lines", "n_lines", most=0.9, where="n_lines >= 5"),
    Threshold("ellipsis_lines", "n_ellipsis_lines", "n_lines", most=0.3, where="n_lines >= 5"),
)

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_letters", "n_capitals", "n_stop_words",
    "n_lines", "n_dup_lines", "n_bullet_lines", "n_ellipsis_lines", "n_repeat_words",
)
RESULTS = (*COUNTS, "base_failed", "broken_rules", "kept")


def _without(text: Column, pattern: str) -> Column:
    """The code points of a text but for those that ``pattern`` covers."""
    return F.length(F.regexp_replace(text, pattern, ""))


def _matching(lines: Column, pattern: str) -> Column:
    return F.size(F.filter(lines, lambda line: line.rlike(pattern)))


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns ``COUNTS``, unspaced and listed_lang for every row's whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = F.btrim(text, F.lit(BLANKS))
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None)
    taken = {*RESULTS, "unspaced", "listed_lang"}
    split = docs.select(
        *(F.col(f"`{name}`") for name in docs.columns if name not in taken),
        F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"{BLANK}+")).alias("_words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)).alias("_lines"),
        _without(text, NO_SYMBOL).alias("n_symbols"),
        (F.length(text) - _without(text, LETTERS)).alias("n_letters"),
        _without(text, NO_CAPITAL).alias("n_capitals"),
        text.rlike(UNSPACED).alias("unspaced"),
        F.coalesce(lang.isin(sorted(STOP_WORDS)), F.lit(False)).alias("listed_lang"),
    )
    words, lines = F.col("_words"), F.col("_lines")
    counted = split.withColumns(
        {
            "n_words": F.size(words),
            "word_chars": F.length(F.array_join(words, "")),
            "n_stop_words": F.size(F.filter(words, lambda word: F.lower(word).isin(sorted(ALL_STOP_WORDS)))),
            "n_lines": F.size(lines),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_bullet_lines": _matching(lines, BULLET),
            "n_ellipsis_lines": _matching(lines, ELLIPSIS),
            "_windows": _windows(words),
        }
    )
    # most texts hold no window twice; only the others have theirs sorted
    windows = F.col("_windows")
    again = F.size(F.array_distinct(windows)) < F.size(windows)
    placed = F.sort_array(F.transform(windows, lambda window, at: F.struct(window.alias("window"), at.alias("at"))))
    ordered = counted.withColumn("_placed", F.when(again, placed)).drop("_words", "_lines", "_windows")
    covered = ordered.withColumn("n_repeat_words", _covered(F.col("_placed")))
    # one row out of one struct: a filter on a count stays above it, instead of copying all these expressions into the scan
    counts = F.struct(*(F.col(name).cast("long").alias(name) for name in COUNTS), "unspaced", "listed_lang")
    return covered.select(*(F.col(f"`{name}`") for name in docs.columns if name not in taken), F.inline(F.array(counts)))


def _windows(words: Column) -> Column:
    """A hash of every run of ``WINDOW`` words, by the place of its first word."""
    firsts = F.slice(words, 1, F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))
    return F.transform(firsts, lambda word, at: F.xxhash64(word, *(F.get(words, at + k) for k in range(1, WINDOW))))


def _covered(placed: Column) -> Column:
    """How many words stand in windows whose hash a neighbour in sorted order shares."""
    twin = F.filter(
        placed,
        lambda one, k: (F.get(placed, k + 1)["window"] == one["window"])
        | ((k > 0) & (F.get(placed, F.greatest(k - 1, F.lit(0)))["window"] == one["window"])),
    )
    places = F.sort_array(F.transform(twin, lambda one: one["at"]))
    start = F.struct(F.lit(0).alias("covered"), F.lit(-WINDOW).alias("last"))
    total = F.aggregate(
        places,
        start,
        lambda so_far, at: F.struct(
            (so_far["covered"] + F.least(F.lit(WINDOW), at - so_far["last"])).alias("covered"), at.alias("last")
        ),
        lambda so_far: so_far["covered"],
    )
    return F.coalesce(total, F.lit(0))


def verdict(thresholds: tuple[Threshold, ...] = THRESHOLDS) -> Column:
    """The names of the rules that a measured row breaks, in the order of the table, as one column."""
    broken = []
    for rule in thresholds:
        ratio = F.try_divide(F.col(rule.over), F.col(rule.per))
        outside = F.lit(False)
        if rule.least is not None:
            outside |= ratio < rule.least
        if rule.most is not None:
            outside |= ratio > rule.most
        broken.append(F.when(F.expr(rule.where) & outside, F.lit(rule.name)))
    return F.array_compact(F.array(*broken))


def judged(docs: DataFrame, thresholds: tuple[Threshold, ...] = THRESHOLDS) -> DataFrame:
    """``docs`` with all counts, base_failed, broken_rules (the thresholds' names) and kept."""
    base = (F.col("n_words") < BASE_WORDS) | (100 * F.col("n_repeat_words") > BASE_REPEATED * F.col("n_words"))
    rows = measured(docs).withColumns({"base_failed": base, "broken_rules": verdict(thresholds)})
    kept = ~F.col("base_failed") & (F.size("broken_rules") == 0)
    return rows.withColumn("kept", kept).drop("unspaced", "listed_lang")
