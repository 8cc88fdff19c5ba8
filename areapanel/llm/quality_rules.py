"""Quality rules: a threshold table compiled into one Spark projection, without user functions."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import GAP, SPACES, words

# Common short function words of the languages the rules are meant for.
STOP_WORDS = """
a an and are as at be by for from he in is it of on or that the this to was were will with
auf aus bei das dem den der des die ein eine einer für ich im ist mit nicht sich sie und von zu
au aux avec ce dans de des du elle en est et il la le les ne ou par pas pour que qui se sur un une
al como con del el ella es las lo los más no o para pero por se su sus una y ya
""".split()

WINDOW = 5


class Rule(NamedTuple):
    """Keep a document while ``low <= 100 * numerator / denominator <= high``; an empty denominator passes."""

    name: str
    numerator: str
    denominator: str
    low: float | None
    high: float | None


#: The table the projection is compiled from; ratios are in hundredths.
RULES: tuple[Rule, ...] = (
    Rule("mean_word_chars", "word_chars", "n_words", 200.0, 1500.0),
    Rule("symbols_per_word", "n_symbols", "n_words", None, 10.0),
    Rule("bangs_per_word", "n_bangs", "n_words", None, 30.0),
    Rule("stop_words_per_word", "n_stop_words", "n_words", 2.0, None),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 60.0),
)


def _others(pattern: str, text: Column) -> Column:
    """How many characters are not matched by ``pattern``."""
    return F.char_length(F.regexp_replace(text, pattern, "")).cast("long")


def with_repeated_words(df: DataFrame, word_list: str, name: str, size: int = WINDOW) -> DataFrame:
    """Adds ``name``: words that lie in a window of ``size`` words found twice or more in the same list.

    Windows are compared by a 64-bit hash within one text. Sorting (hash, position) puts equal
    windows side by side; the sorted positions of the repeated ones are then merged. Only texts
    with a repeated window are sorted. Every step is a column of its own, used more than once by the
    next, so that Spark computes it once.
    """
    given = [F.col(f"`{c}`") for c in df.columns]
    count, hashes, ranked, places = F.size(word_list), F.col("_hashes"), F.col("_ranked"), F.col("_places")
    no_ints = F.array().cast("array<int>")
    marked = df.select(*given, F.transform(word_list, lambda w: F.xxhash64(w)).alias("_marks"))
    hashed = marked.select(
        *given,
        F.when(
            count >= size,
            F.transform(
                F.sequence(F.lit(0), F.greatest(count - size, F.lit(0))),
                lambda i: F.xxhash64(*[F.get("_marks", i + k) for k in range(size)]),
            ),
        )
        .otherwise(F.array().cast("array<bigint>"))
        .alias("_hashes"),
    )
    sorted_ = hashed.select(
        *given,
        F.when(
            F.size(F.array_distinct(hashes)) < F.size(hashes),
            F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias("_ranked"),
    )
    twins = F.zip_with(
        ranked,
        F.slice(ranked, F.lit(2), F.size(ranked)),
        lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])).otherwise(no_ints),
    )
    placed = sorted_.select(*given, F.when(ranked.isNotNull(), F.sort_array(F.array_distinct(F.flatten(twins)))).alias("_places"))
    steps = F.zip_with(places, F.slice(places, F.lit(2), F.size(places)), lambda p, q: F.least(F.lit(size), F.coalesce(q - p, F.lit(size))))
    covered = F.aggregate(steps, F.lit(0), lambda total, step: total + step)
    return placed.select(*given, F.coalesce(covered, F.lit(0)).cast("long").alias(name))


def counters(docs: DataFrame, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """doc_id and the counts the rules use."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    split = docs.select("doc_id", text.alias("_text"), words(text).alias("_words"), lines.alias("_lines"))
    split = with_repeated_words(split, "_words", "n_repeat_words")
    raw, word_list, line_list = F.col("_text"), F.col("_words"), F.col("_lines")
    plain = F.split(F.lower(raw), r"[\x20\x09-\x0D.,;:!?]+")
    return split.select(
        "doc_id",
        F.size(word_list).cast("long").alias("n_words"),
        _others(GAP, raw).alias("word_chars"),
        _others(r"[^#*$%&|<>]+", raw).alias("n_symbols"),
        (F.size(line_list) - F.size(F.array_distinct(line_list))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size(line_list).cast("long").alias("n_lines"),
        _others(r"[^!]+", raw).alias("n_bangs"),
        F.size(F.filter(plain, lambda w: w.isin(*stop_words))).cast("long").alias("n_stop_words"),
    )


def verdict(rules: Sequence[Rule] = RULES) -> Column:
    """The whole table as one Boolean column."""
    ok = F.lit(True)
    for rule in rules:
        over, under = F.col(rule.numerator) * 100, F.col(rule.denominator)
        for bound, holds in ((rule.low, "ge"), (rule.high, "le")):
            if bound is not None:
                limit = under * F.lit(float(bound))
                ok = ok & ((over >= limit) if holds == "ge" else (over <= limit))
    return ok


def quality_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """One row per document with its counts, ``base_failed`` and ``kept``.

    Ratios are compared multiplied out, so nothing is divided by zero. A null or empty text has no
    words and fails. Repeated rows are judged one by one; other columns are ignored. No shuffle.
    """
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        counters(docs, stop_words)
        .withColumn("base_failed", base)
        .withColumn("kept", ~F.col("base_failed") & verdict(rules))
    )
