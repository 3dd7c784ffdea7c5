"""Repeated lines by overlapping windows of three lines.

Each run of three consecutive lines is hashed.  A window that occurs more than once in the corpus stays at its first
occurrence; the lines that its later occurrences cover are removed, overlapping windows merged.

Lines end at a line feed.  They are compared without blanks, tabs and carriage returns at their ends; blank lines are
no part of the sequence and always stay.  The first occurrence is the least by (id, hash of the text, line).  A text
with fewer than three lines that aren't blank has no window and stays as it is.  Null texts stay null.  Rows with the
same id and the same text are one document: they get the same text.  Null ids come first.  Other columns of any name pass
through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkprep.functions.scalar import col, free_names
from sparkprep.llm.frames import text_of
from sparkprep.session import materialise

#: Lines of a window.
WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _places(text: Column) -> Column:
    """``(number, line)`` of the lines that aren't blank."""
    numbered = F.transform(_lines(text), lambda x, i: F.struct(i.alias("i"), F.btrim(x, F.lit(" \t\r")).alias("line")))
    return F.filter(numbered, lambda p: p["line"] != "")


def covered_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, h, gone)``: the line numbers to remove, of the texts that lose lines; ``h`` is the hash of the text."""
    text = text_of(text_col)
    docs = df.select(col(id_col).alias("id"), F.xxhash64(text).alias("h"), _places(text).alias("p"))
    windows = docs.where(F.size("p") >= WINDOW).select(
        "id",
        "h",
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), F.size("p") - WINDOW),
                lambda k: F.struct(
                    *[F.col("p")[k + j]["i"].alias(f"i{j}") for j in range(WINDOW)],
                    F.xxhash64(*[F.col("p")[k + j]["line"] for j in range(WINDOW)]).alias("h1"),
                    F.xxhash64(F.lit(7), *[F.col("p")[k + j]["line"] for j in range(WINDOW)]).alias("h2"),
                ),
            )
        ).alias("k", "w"),
    )
    windows = materialise(windows.select("id", "h", "k", "w.*"), "windows")
    place = F.struct("id", "h", "k")
    repeated = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
    later = windows.join(repeated.select("h1", "h2", "first"), ["h1", "h2"]).where(place != F.col("first"))
    # all lines of one text, which is a row itself
    return later.groupBy("id", "h").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.array(*[f"i{j}" for j in range(WINDOW)]))))).alias("gone")
    )


def drop_repeated_lines(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", removed_col: str | None = None, drop_emptied: bool = False
) -> DataFrame:
    """``df`` with the text cut; ``removed_col`` adds the removed line numbers (from 0).

    ``drop_emptied`` leaves out texts that lost all of their lines.
    """
    of_id, of_text, cut_out = free_names(df.columns, "__id", "__h", "__gone")
    gone = covered_lines(df, id_col, text_col).select(F.col("id").alias(of_id), F.col("h").alias(of_text), F.col("gone").alias(cut_out))
    text = text_of(text_col)
    same = col(id_col).eqNullSafe(F.col(of_id)) & (F.xxhash64(text) == F.col(of_text))
    out = df.join(gone, same, "left")
    cut = F.array_join(_without(_lines(text), F.col(cut_out)), "\n")
    if drop_emptied:
        out = out.where(F.col(cut_out).isNull() | (F.btrim(cut, F.lit(" \t\r\n")) != ""))
    kept = [F.when(F.col(cut_out).isNull(), col(c)).otherwise(cut).alias(c) if c == text_col else col(c) for c in df.columns]
    if removed_col:
        kept.append(F.coalesce(cut_out, F.array().cast("array<int>")).alias(removed_col))
    return out.select(*kept)


def _without(lines: Column, gone: Column) -> Column:
    """``lines`` without the sorted places ``gone``: the stretches between them, each copied once."""

    def stretches(held: Column) -> Column:
        def one(k: Column) -> Column:
            start = F.coalesce(F.get(held["gone"], k - 1) + 1, F.lit(0))
            end = F.coalesce(F.get(held["gone"], k), F.size(held["lines"]))
            return F.slice(held["lines"], start + 1, end - start)

        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(held["gone"])), one))

    # bound once, so that the text isn't split again for each stretch
    return F.transform(F.array(F.struct(lines.alias("lines"), gone.alias("gone"))), stretches)[0]
