"""Quality rules: a table of thresholds compiled into one projection.

Counts of words, symbols, stop words and lines are Spark expressions over the text;
the rules compare ratios of them with bounds. No user function runs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARACTERS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that it was for on are with as be by this from or an at not "
    "der die das und ist von den mit zu des dem im nicht eine ein sich auf für als "
    "le la les et est une un du que qui dans pour pas sur au par en de "
    "el los las y una por con para se lo como del al"
).split()


@dataclass(frozen=True)
class Rule:
    """A ratio and the bounds it must keep; None leaves a side open."""

    name: str
    ratio: str
    least: float | None = None
    most: float | None = None

    def kept(self) -> Column:
        value = F.expr(self.ratio)
        bounds = F.lit(True)
        if self.least is not None:
            bounds = bounds & (value >= self.least)
        if self.most is not None:
            bounds = bounds & (value <= self.most)
        return F.coalesce(bounds, F.lit(False))


# Ratios are of the counts of `counts`, over at least one word and one line.
RULES = (
    Rule("length", "n_words", least=50),
    Rule("word_length", "word_chars / greatest(n_words, 1)", least=2, most=20),
    Rule("symbols", "n_symbols / greatest(n_words, 1)", most=0.1),
    Rule("stop_words", "n_stop_words / greatest(n_words, 1)", least=0.06),
    Rule("repeated_words", "n_repeat_words / greatest(n_words, 1)", most=0.5),
    Rule("repeated_lines", "n_dup_lines / greatest(n_lines, 1)", most=0.6),
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_lines")


def window_hashes(words: Column) -> Column:
    """64-bit hashes of the windows of three words of an array, in order."""
    starts = F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))
    return F.transform(starts, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))


def sorted_windows(hashes: Column) -> Column:
    """Hashes with their places, sorted; NULL where a hash set finds all distinct."""
    placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.sort_array(placed))


def covered_words(windows: Column) -> Column:
    """Places that windows equal to a neighbour cover, each counted once."""

    def place_if_repeated(window, i):
        same = (window["h"] == F.get(windows, i - 1)["h"]) | (window["h"] == F.get(windows, i + 1)["h"])
        return F.when(same, window["i"])

    places = F.array_compact(F.transform(windows, place_if_repeated))
    covered = F.flatten(F.transform(places, lambda i: F.array(i, i + 1, i + 2)))
    return F.coalesce(F.size(F.array_distinct(covered)), F.lit(0))


def counts(docs: DataFrame, keep: tuple[str, ...] | None = None) -> DataFrame:
    """The rows of `docs` with the counts that rules may use, as longs.

    Words are `[^\\x20\\x09-\\x0D]+`. A NULL text counts as an empty one: all counts
    are 0. Input columns named as a count are replaced.
    """
    keep = [c for c in keep or docs.columns if c not in (*COUNTS, "_t", "_words", "_lines", "_hashes", "_windows")]
    text = F.coalesce(F.col("text"), F.lit(""))
    # Each step is a projection of its own: an expression used in a lambda function
    # would be worked out anew for every element.
    with_words = docs.select(
        *keep,
        text.alias("_t"),
        F.filter(F.split(text, SPACES), lambda w: w != "").alias("_words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )
    with_hashes = with_words.withColumn("_hashes", window_hashes(F.col("_words")))
    with_windows = with_hashes.withColumn("_windows", sorted_windows(F.col("_hashes")))
    t, words, lines = F.col("_t"), F.col("_words"), F.col("_lines")
    measured = {
        "n_words": F.size(words),
        "word_chars": F.length(F.translate(t, SPACE_CHARACTERS, "")),
        "n_symbols": F.length(t) - F.length(F.translate(t, SYMBOLS, "")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": covered_words(F.col("_windows")),
        "n_stop_words": F.size(F.filter(words, lambda w: w.isin(*STOP_WORDS))),
        "n_lines": F.size(lines),
    }
    # A generated row keeps filters on the counts where they are; pushed down they
    # would work the counts out anew, step into step.
    row = F.struct(*(c.cast("long").alias(n) for n, c in measured.items()))
    return with_windows.select(*keep, F.inline(F.array(row)))


def judge(counted: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rows of `counts` with `failed`, the names of the rules that a row breaks."""
    broken = [F.when(~rule.kept(), F.lit(rule.name)) for rule in rules]
    return counted.withColumn("failed", F.array_compact(F.array(*broken)))


def base_failed() -> Column:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rows of `docs` that break no rule and don't fail the base."""
    kept = judge(counts(docs), rules).filter(~base_failed() & (F.size("failed") == 0))
    return kept.select(*docs.columns)
