"""Quality rules: a table of thresholds compiled into one projection of column expressions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import SPACES, words_of

SYMBOLS = "#*$%&|<>"

# Frequent function words of the four languages.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on",
    "or", "that", "the", "this", "to", "was", "were", "which", "with",
    "au", "avec", "dans", "de", "des", "du", "elle", "en", "est", "et", "la", "le", "les", "pas",
    "par", "pour", "que", "qui", "sur", "un", "une",
    "als", "auf", "das", "dem", "den", "der", "die", "ein", "eine", "für", "ist", "mit", "nicht",
    "sich", "und", "von", "zu",
    "al", "con", "del", "el", "las", "lo", "los", "no", "para", "se", "su", "una", "y",
)


class Rule(NamedTuple):
    """A document passes when ``numerator / denominator`` lies within the bounds."""

    name: str
    numerator: str
    denominator: str
    low: float
    high: float


RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbol_ratio", "n_symbols", "n_words", 0.0, 0.3),
    Rule("shout_ratio", "n_shouts", "n_words", 0.0, 0.3),
    Rule("stop_word_ratio", "n_stop_words", "n_words", 0.06, 1.0),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_lines", 0.0, 0.4),
)


def _long(column: Column) -> Column:
    return column.cast("long")


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts that the rules use, each a long.

    ``n_repeat_words`` is the number of words in three-word windows that occur twice or more in
    the text. Windows are sorted by their hash together with their position, so equal ones are
    neighbours; a long text costs n log n and nothing is shuffled.

    A null text counts as empty: all counts are zero. Rows are measured one by one, so repeated
    rows and ties stay as they are. Columns of ``docs`` with the names of the counts are replaced.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    helpers = docs.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in MEASURES],
        words_of(F.col(text)).alias("__q_words"),
        F.filter(F.split(body, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "").alias("__q_lines"),
        _long(F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).alias("n_symbols"),
        _long(F.length(body) - F.length(F.translate(body, "!", ""))).alias("n_shouts"),
        _long(F.length(F.translate(body, SPACES, ""))).alias("word_chars"),
    )
    words, count = F.col("__q_words"), F.size("__q_words")
    windows = helpers.withColumns({
        "n_words": _long(count),
        "n_lines": _long(F.size("__q_lines")),
        "n_dup_lines": _long(F.size("__q_lines") - F.size(F.array_distinct("__q_lines"))),
        "n_stop_words": _long(F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS)))),
        "__q_sorted": F.sort_array(F.transform(
            F.slice(words, 1, F.greatest(count - 2, F.lit(0))),
            lambda w, i: F.struct(
                F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("p")))),
    }).drop("__q_words", "__q_lines")
    ranked = F.col("__q_sorted")

    def same(x: Column, i: Column) -> Column:
        return F.coalesce(F.get(ranked, i).getField("h") == x.getField("h"), F.lit(False))

    starts = windows.withColumn("__q_starts", F.sort_array(F.transform(
        F.filter(ranked, lambda x, i: same(x, i - 1) | same(x, i + 1)),
        lambda x: x.getField("p")))).drop("__q_sorted")
    covered = F.transform("__q_starts", lambda p, i: F.least(
        F.lit(3), F.coalesce(F.get(F.col("__q_starts"), i + 1) - p, F.lit(3))))
    return starts.withColumn("n_repeat_words", F.aggregate(
        covered, F.lit(0).cast("long"), lambda total, n: total + n)).drop("__q_starts")


MEASURES = ("n_words", "n_lines", "word_chars", "n_symbols", "n_shouts", "n_dup_lines",
            "n_repeat_words", "n_stop_words")


def compiled(rules: tuple[Rule, ...] = RULES) -> dict[str, Column]:
    """Each rule's verdict as a column; a ratio with nothing below it is zero."""
    out = {}
    for rule in rules:
        ratio = F.coalesce(F.try_divide(F.col(rule.numerator), F.col(rule.denominator)), F.lit(0.0))
        out[rule.name] = ratio.between(rule.low, rule.high)
    return out


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES,
          min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """The counts, ``base_failed``, the names of the rules broken and ``kept``.

    ``base_failed``: fewer than ``min_words`` words, or more than ``max_repeat_percent`` of them in
    repeated windows. An empty or null text fails. An empty table gives an empty table.
    """
    base = ((F.col("n_words") < min_words)
            | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")))
    broken = F.array_compact(F.array(*[
        F.when(~passed, F.lit(name)) for name, passed in compiled(rules).items()]))
    return (measured(docs, text)
            .withColumns({"base_failed": base, "broken": broken})
            .withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0)))
