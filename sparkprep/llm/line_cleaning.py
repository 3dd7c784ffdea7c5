"""Quality rules, line first: lines that fail a rule go, then texts that lose too much go.

A line with a word fails by the first of these rules that holds:

* ``navigation``: three words or more, a fifth of them bare separators
* ``symbols``: more than a tenth of its characters in words are among ``#*$%&|<>``
* ``boilerplate``: at most 40 words and a phrase of licence, cookie, account or sharing notices
* ``shouting``: three words or more, over six tenths of its letters upper case
* ``punctuation``: no end of a sentence in it

Lines without a word never fail and never count.  A text is rejected by the base rules (fewer than ten words, or over a
fifth of its words in repeated five-word windows) or if its failing lines hold over half of its characters in words.

Only DataFrame functions: each text is measured in its own row, nothing is shuffled.  Equal five-word windows of a text
are found by sorting their hashes, so long texts cost n log n.

Defined results: a null text counts as empty; it has no words, so it is rejected.  Rows that repeat are measured each on
its own, an empty table gives an empty table, and other columns of any name pass through :func:`clean` untouched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkprep.functions.scalar import col
from sparkprep.llm.frames import text_of

#: What separates words, and the characters that count as symbols.
WHITE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
#: Words of a window that counts as repeated.
WINDOW = 5
#: Bare separators of menus and paths.
SEPARATORS = ("|", "›", "»", ">", "•", "·", "::")
#: An end of a sentence, closing marks included.
SENTENCE_END = r"""[.!?…。！？]["'»”’)\]]*([\x20\x09-\x0D]|$)"""
BOILERPLATE = (
    "(^|[^a-z])(all rights reserved|copyright|licensed under|released under|terms of use|terms of service|privacy policy|cookie policy|"
    "use cookies|enable javascript|lorem ipsum|click here|sign in|sign up|log in|subscribe|newsletter|read more|share this|powered by|skip to)([^a-z]|$)"
)
BOILERPLATE_WORDS = 40
RULES = ("navigation", "symbols", "boilerplate", "shouting", "punctuation")
LEAST_WORDS = 10


def _let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` worked out once, even where ``fn`` names it inside a lambda."""
    return F.transform(F.array(value), fn)[0]


def _split(text: Column) -> Column:
    return F.filter(F.split(text, r"[ \t-\r]+"), lambda w: w != "")


def _chars_in_words(text: Column) -> Column:
    return F.length(F.translate(text, WHITE, ""))


def _symbols(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, SYMBOLS, ""))


def _lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def failing_rule(line: Column) -> Column:
    """The first rule that a line fails, null if it passes all."""

    def judge(words: Column) -> Column:
        n = F.size(words)
        bare = F.size(F.filter(words, lambda w: w.isin(*SEPARATORS)))
        letters, upper = F.regexp_count(line, F.lit(r"\p{L}")), F.regexp_count(line, F.lit(r"\p{Lu}"))
        failed = {
            "symbols": _symbols(line) * 10 > _chars_in_words(line),
            "navigation": (n >= 3) & (bare * 5 >= n),
            "boilerplate": (n <= BOILERPLATE_WORDS) & _lowered(line).rlike(BOILERPLATE),
            "shouting": (n >= 3) & (upper * 10 > letters * 6),
            "punctuation": ~line.rlike(SENTENCE_END),
        }
        rule = F.lit(None).cast("string")
        for name in reversed(RULES):
            rule = F.when(failed[name], F.lit(name)).otherwise(rule)
        return F.when(n > 0, rule)

    return _let(_split(line), judge)


def _repeated(words: Column) -> Column:
    """Words covered by five-word windows that occur twice or more."""
    hashed = F.when(
        F.size(words) >= WINDOW,
        F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda k: F.xxhash64(*[F.get(words, k + j) for j in range(WINDOW)])),
    ).otherwise(F.array().cast("array<bigint>"))

    def covered(places: Column) -> Column:
        return F.aggregate(
            F.transform(places, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW)))),
            F.lit(0).cast("bigint"),
            lambda total, x: total + x,
        )

    def of_sorted(s: Column) -> Column:
        twin = F.filter(s, lambda x, i: F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)))
        return _let(F.sort_array(F.transform(twin, lambda x: x["i"])), covered)

    def of_hashes(h: Column) -> Column:
        placed = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        # most texts repeat no window; those skip the sort
        return F.when(F.size(F.array_distinct(h)) < F.size(h), _let(F.sort_array(placed), of_sorted)).otherwise(F.lit(0).cast("bigint"))

    return _let(hashed, of_hashes)


def _facts(text: Column) -> Column:
    """One struct of all counts and verdicts of a text that isn't null."""

    def of_words(words: Column) -> Column:
        return F.struct(F.size(words).cast("long").alias("n_words"), _repeated(words).cast("long").alias("n_repeat_words"))

    def of_lines(lines: Column) -> Column:
        worded = F.filter(lines, lambda x: x.rlike(r"[^ \t-\r]"))
        dup = _let(worded, lambda w: F.size(w) - F.size(F.array_distinct(w)))
        judged = F.transform(lines, lambda x: F.struct(x.alias("line"), failing_rule(x).alias("rule")))
        return F.struct(dup.cast("long").alias("n_dup_lines"), judged.alias("lines"))

    return F.struct(
        _chars_in_words(text).cast("long").alias("word_chars"),
        _symbols(text).cast("long").alias("n_symbols"),
        _let(_split(text), of_words).alias("words"),
        _let(F.split(text, "\n"), of_lines).alias("judged"),
    )


def _measured(df: DataFrame, text_col: str) -> DataFrame:
    """``row``: the input row; ``f``: facts of its text; ``lost``: characters of its failing lines."""
    row = F.struct(*[col(c) for c in df.columns]).alias("row")
    # a generator, so that no later filter or projection works the facts out a second time
    found = df.select(row, F.explode(F.array(_facts(text_of(text_col)))).alias("f"))
    failing = F.filter(F.col("f.judged.lines"), lambda x: x["rule"].isNotNull())
    lost = F.aggregate(failing, F.lit(0).cast("bigint"), lambda n, x: n + _chars_in_words(x["line"]))
    found = found.select("row", "f", lost.alias("lost"))
    base = (F.col("f.words.n_words") < LEAST_WORDS) | (F.col("f.words.n_repeat_words") * 100 > F.col("f.words.n_words") * 20)
    kept = ~base & (F.col("lost") * 2 <= F.col("f.word_chars"))
    return found.select("row", "f", "lost", base.alias("base_failed"), kept.alias("kept"))


def _only(name: str) -> Callable[[Column], Column]:
    return lambda rule: F.when(rule == name, rule)


def line_quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``df``: id, counts, verdicts, ``lost_chars`` and ``failed``, the number of lines by rule."""
    found = _measured(df.select(col(id_col).alias("id"), text_of(text_col).alias("text")), "text")
    rules = F.col("f.judged.lines")["rule"]
    by_rule = F.struct(*[F.size(F.array_compact(F.transform(rules, _only(name)))).cast("long").alias(name) for name in RULES])
    return found.select(
        F.col("row.id").alias(id_col),
        F.col("f.words.n_words").alias("n_words"),
        F.col("f.word_chars").alias("word_chars"),
        F.col("f.n_symbols").alias("n_symbols"),
        F.col("f.judged.n_dup_lines").alias("n_dup_lines"),
        F.col("f.words.n_repeat_words").alias("n_repeat_words"),
        "base_failed",
        "kept",
        F.col("lost").alias("lost_chars"),
        by_rule.alias("failed"),
    )


def clean(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The texts that stay, without their failing lines; all columns of ``df``."""
    found = _measured(df, text_col).where("kept")
    left = F.transform(F.filter(F.col("f.judged.lines"), lambda x: x["rule"].isNull()), lambda x: x["line"])
    return found.select(*[F.array_join(left, "\n").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in df.columns])
