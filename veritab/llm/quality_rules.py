"""Quality rules as one projection (operator 6), DataFrame functions only.

``MEASURES`` names the counts of a text; ``RULES`` is the threshold table.
Both are compiled to column expressions of one projection: no shuffle, no
user function, and every text is judged alone.

Defined results: null or empty text has zero in every count and fails; a
repeated row gets an equal verdict; a text of any length is read whole; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import let

#: words of a window whose repetition counts
REPEAT_WINDOW = 5
_SPACE = r"[\x20\x09-\x0D]+"

#: frequent function words of the covered languages (fixed values)
STOP_WORDS = (
    "a an and as at be by for from have in is it of on or that the this to was were with "
    "au aux avec ce dans de des du en est et il la le les ne pas par pour que qui sur un une "
    "als am auch auf das dem den der des die ein eine er es für ist mit nicht sich sie und von zu "
    "al como con del el ella ha las lo los no para pero por se son su una y"
).split()


class Rule(NamedTuple):
    """A text passes if low <= numerator / denominator <= high, or if it has
    fewer words than the rule needs to tell anything."""
    name: str
    numerator: str
    denominator: str | None
    low: float | None
    high: float | None
    least_words: int = 0


#: the threshold table
RULES = (
    Rule("mean_word_chars", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols_per_word", "n_symbols", "n_words", None, 0.1),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 0.5),
    Rule("repeated_words", "n_repeat_words", "n_words", None, 0.2),
    Rule("stop_words", "n_stop_words", "n_words", 0.02, None, least_words=40),
    Rule("capitals", "n_capitals", "word_chars", None, 0.4),
    Rule("exclamations", "n_exclamations", "n_words", None, 0.3),
    Rule("list_lines", "n_list_lines", "n_lines", None, 0.9),
    Rule("open_lines", "n_open_lines", "n_lines", None, 0.3),
)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("bigint")


def _repeat_words(words: Column) -> Column:
    """Words inside 5-word windows that occur twice or more in a bound array of words.

    Windows are compared by 64-bit hash.  Texts without a repeated window stop
    at a distinct count; the others sort (hash, place), keep the places whose
    hash stands beside an equal one, and add up the union of their windows.
    """
    k = REPEAT_WINDOW
    none = F.lit(0).cast("bigint")

    def grams(hashes: Column) -> Column:
        return F.when(F.size(hashes) >= k, F.transform(
            F.sequence(F.lit(0), F.size(hashes) - k), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(k)])))

    def covered(placed: Column) -> Column:
        def twin(j: Column) -> Column:
            same = [F.get(placed, j + d)["g"] == F.get(placed, j)["g"] for d in (-1, 1)]
            return F.when(same[0] | same[1], F.get(placed, j)["i"])

        places = F.filter(F.transform(F.sequence(F.lit(0), F.size(placed) - 1), twin), lambda p: p.isNotNull())
        start = F.struct(F.lit(0).alias("end"), none.alias("sum"))
        return F.aggregate(
            F.sort_array(places), start,
            lambda a, p: F.struct((p + k).alias("end"),
                                  (a["sum"] + p + k - F.greatest(a["end"], p)).cast("bigint").alias("sum")),
            lambda a: a["sum"])

    def of(grams: Column) -> Column:
        placed = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(grams)) < F.size(grams), let(placed, covered)).otherwise(none)

    return F.coalesce(let(let(F.transform(words, lambda w: F.xxhash64(w)), grams), of), none)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and every count of its text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    cases = sorted({form for w in STOP_WORDS for form in (w, w.capitalize(), w.upper())})
    of_words = let(F.array_remove(F.split(text, _SPACE), ""), lambda words: F.struct(
        F.size(words).cast("bigint").alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
        _repeat_words(words).alias("n_repeat_words"),
        F.size(F.filter(words, lambda w: w.isin(cases))).cast("bigint").alias("n_stop_words")))
    of_lines = let(F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")), lambda lines: F.struct(
        F.size(lines).cast("bigint").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines")))
    counts = docs.select(
        F.col(id_col).alias("doc_id"), of_words.alias("w"), of_lines.alias("l"),
        _count(text, r"[#*$%&|<>]").alias("n_symbols"), _count(text, r"\p{Lu}").alias("n_capitals"),
        _count(text, r"!").alias("n_exclamations"),
        _count(text, r"(?dm)^[\x20\t]*(?:[-*•]|\d+[.)])[\x20\t]").alias("n_list_lines"),
        _count(text, r"(?dm)(?:\.\.\.|…)[\x20\t]*$").alias("n_open_lines"))
    return counts.select("doc_id", "w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words",
                         "l.n_lines", "w.n_stop_words", "n_capitals", "n_exclamations", "n_list_lines", "n_open_lines")


def passes(rules: tuple[Rule, ...] = RULES) -> Column:
    """The threshold table as one boolean expression (a zero denominator passes)."""
    def one(rule: Rule) -> Column:
        value = F.col(rule.numerator).cast("double")
        if rule.denominator:
            value = value / F.nullif(F.col(rule.denominator), F.lit(0))
        tests = [value >= rule.low] if rule.low is not None else []
        tests += [value <= rule.high] if rule.high is not None else []
        return (F.col("n_words") < rule.least_words) | F.coalesce(reduce(Column.__and__, tests), F.lit(True))

    return reduce(Column.__and__, [one(r) for r in rules])


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` of every text."""
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (measured(docs, id_col, text_col).withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & passes(rules)))
