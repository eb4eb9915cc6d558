"""Line-first cleaning with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Word separators, counted symbols, and phrases of site furniture.
WORD_BREAK = "[\\x20\\x09-\\x0D]+"
NOT_SYMBOL = "[^#*$%&|<>]+"
BOILERPLATE = ("(?i)cookie|privacy policy|terms of (use|service)|all rights reserved|javascript|lorem ipsum"
               "|log ?in to|sign up|subscribe (to|now)|skip to (main )?content|powered by|copyright (©|\\(c\\))")
SEPARATOR = "[|>»·•]"
#: A line fails above these; a document is rejected when it keeps less than ``LEAST_LEFT`` of its characters.
LINE_LIMITS = {"symbols": 0.06, "shouting": 0.6, "separators": 0.2, "few_words": 0.3}
MIN_WORDS, MAX_REPEATED, LEAST_LEFT = 10, 20, 0.5


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def count_of(text: Column, others: str) -> Column:
    """Characters left when ``others`` are taken out."""
    return F.length(F.regexp_replace(text, others, ""))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_BREAK), "")


def repeated_words(words: Column, n: int = 5) -> Column:
    """Words that lie in an ``n``-word window found twice or more in the text.

    Windows are compared by 64-bit hashes. Only a text that has repeats at all
    sorts its windows with their places; sorted places then cover at most
    ``n`` words each, and the gap to the next place if that is smaller.
    """
    def places(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(pairs, lambda p: F.sort_array(F.transform(
            F.filter(p, lambda x, k: (x["h"] == F.get(p, k - 1)["h"]) | (x["h"] == F.get(p, k + 1)["h"])), lambda x: x["i"])))

    def covered(at: Column) -> Column:
        return F.aggregate(F.transform(at, lambda x, k: F.least(F.lit(n), F.coalesce(F.get(at, k + 1) - x, F.lit(n)))),
                           F.lit(0).cast("long"), lambda a, x: a + x)

    # null-safe comparisons: the first and last window have one neighbour
    def count(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            let(places(hashes), covered))

    hashes = let(words, lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.xxhash64(F.slice(w, i, n))))
    return F.when(F.size(words) < n + 1, F.lit(0).cast("long")).otherwise(let(hashes, count))


def line_fails(line: Column) -> Column:
    """Why a line goes: ``symbols``, ``shouting``, ``navigation``, ``boilerplate``, ``monotone``; null: it stays.

    symbols: characters ``#*$%&<>`` and runs of ``!`` make up too much of it (or ``{``/``}`` in prose).
    shouting: nearly all of its letters are capitals, over five words or more.
    navigation: separators between its words. boilerplate: a phrase of site furniture.
    monotone: ten words or more, of which few differ.
    """
    def rules(words: Column) -> Column:
        chars = F.greatest(F.length(line), F.lit(1))
        n = F.size(words)
        symbols = count_of(line, "[^#*$%&<>{}]+") + F.length(F.regexp_replace(line, "[^!]+|(?<!!)!(?!!)", ""))
        letters = F.greatest(count_of(line, "\\P{L}+"), F.lit(1))
        separators = count_of(line, f"[^{SEPARATOR[1:]}+")
        return (F.when(symbols / chars > LINE_LIMITS["symbols"], "symbols")
                .when((n >= 5) & (count_of(line, "\\P{Lu}+") / letters > LINE_LIMITS["shouting"]), "shouting")
                .when((separators >= 2) & (separators / n > LINE_LIMITS["separators"]), "navigation")
                .when(line.rlike(BOILERPLATE), "boilerplate")
                .when((n >= 10) & (F.size(F.array_distinct(words)) / n < LINE_LIMITS["few_words"]), "monotone"))
    return let(words_of(line), rules)


def clean_lines(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, cleaned, share_left.

    Lines (split at ``\\n``) are judged first, by ``line_fails``; a repeat of an
    earlier line fails too. ``cleaned`` has the lines that stay. A document is
    kept when it passes the base rules and its cleaned lines hold at least half
    of its non-blank characters. Nulls count as empty texts, which fail the
    base rules (under ten words); repeated rows are judged alike; columns of the
    same names as these are replaced; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    blank = F.length(F.regexp_replace(text, WORD_BREAK, ""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    out = docs.withColumns({"__words": words_of(text), "__lines": lines})
    marked = F.transform(F.array_distinct(F.col("__lines")), lambda x: F.struct(x.alias("line"), line_fails(x).alias("why")))
    out = out.withColumns({
        "n_words": F.size("__words").cast("long"), "word_chars": blank.cast("long"),
        "n_symbols": count_of(text, NOT_SYMBOL).cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": repeated_words(F.col("__words")), "__marked": marked})
    out = out.withColumn("cleaned", F.array_join(F.transform(F.filter("__marked", lambda x: x["why"].isNull()), lambda x: x["line"]), "\n"))
    left = F.length(F.regexp_replace("cleaned", WORD_BREAK, "")) / F.greatest(F.col("word_chars"), F.lit(1))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    out = out.withColumns({"share_left": left, "base_failed": failed})
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("share_left") >= LEAST_LEFT)).drop("__words", "__lines", "__marked")
