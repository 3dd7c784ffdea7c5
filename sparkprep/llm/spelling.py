"""Spelling variants: words one edit apart, found level by level in a distributed trie.

Words are counted over the whole corpus.  The trie of the words that count is a table of edges (node, character, child);
a node is the prefix it stands for.  Search states (word, rest of the word, node, edits) start at the root and are joined
with the edges of one level at a time: a state follows the next character of its word, or spends its one edit on a greater
character or on leaving one out.  A state whose child lies on the way to a single word is settled by one comparison, so the
levels end where words stop sharing prefixes.  States that end on a word with one edit are its neighbours, and it theirs:
a smaller character and one more are the same edits seen from the other word.  Equal characters in a row lose their last
one only, so no pair is found twice.

Words of ``LEVELS`` code points or more would need as many levels.  Pairs of such words are found by the hashes of each word
with one character left out (a rolling hash, so that a word of a million letters costs as many rows), then compared exactly.

A node that takes over ``1 / HOT`` of a level's states is joined by broadcast: there are fewer than ``HOT`` of them, with as
many edges as there are characters, at most 90.

Runs of letters are lower-cased (A to Z only); where 199 divides the crc32 of ``<doc_id>:<run>`` one code point is left out, as
the contract of the query has it (``DROP_EVERY``; 0 leaves all runs as they are).

Defined results: null texts and texts without letters have no words; a null id counts as the empty string.  Repeated rows count each.  An
empty table gives an empty table.  Other columns aren't read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sparkprep.functions.scalar import col
from sparkprep.llm.frames import text_of
from sparkprep.session import materialise, scratch_path

#: Fixed value: the letters of a run.
RUN = r"[A-Za-zÀ-ÿ]+"
#: One run in so many loses a code point.
DROP_EVERY = 199
#: Least code points and occurrences of a word, and how much more often its form must occur.
LEAST_LENGTH, LEAST_COUNT, FORM_RATIO = 6, 5, 5
#: Words of so many code points or more are compared with each other by hashes.
LEVELS = 48
#: A node with over 1 / HOT of a level's states is hot, if the level has LARGE states or more.
HOT, LARGE = 256, 100_000


def _lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_counts(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, drop_every: int = DROP_EVERY
) -> DataFrame:
    """``(word, n)`` of the words that count."""
    key = F.coalesce(col(id_col).cast("string"), F.lit(""))
    runs = df.select(key.alias("id"), F.explode(F.regexp_extract_all(text_of(text_col), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.length("run") >= least_length).select("id", _lowered(F.col("run")).alias("run"))
    word = F.col("run")
    if drop_every:
        h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
        at = (h % F.length("run")).cast("int")
        word = F.when(h % drop_every == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(word)
    counted = runs.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.length("word") >= least_length) & (F.col("n") >= least_count))


def trie_edges(words: DataFrame) -> DataFrame:
    """``(depth, node, ch, child, is_word, only, next)``: ``only`` is the word below a child that leads to one word."""
    steps = words.select("word", F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("depth"))
    at = F.col("depth")
    steps = steps.select(
        "word",
        "depth",
        F.substring("word", F.lit(1), at).alias("node"),
        F.substring("word", at + 1, F.lit(1)).alias("ch"),
        F.substring("word", at + 2, F.lit(1)).alias("after"),
    )
    edges = steps.groupBy("depth", "node", "ch").agg(
        F.max(F.col("after") == "").alias("is_word"),
        F.min("word").alias("least"),
        F.max("word").alias("most"),
        F.collect_set("after").alias("next"),  # at most one entry for each character there is
    )
    return edges.select(
        "depth",
        "node",
        "ch",
        F.concat("node", "ch").alias("child"),
        "is_word",
        F.when(F.col("least") == F.col("most"), F.col("least")).alias("only"),
        F.concat_ws("", "next").alias("next"),
    )


def _stepped(states: DataFrame, edges: DataFrame) -> DataFrame:
    """States one level down, and neighbours (``near``) that are settled on arrival."""
    first, second = F.substring("rest", 1, 1), F.substring("rest", 2, 1)
    rest1, rest2 = F.expr("substring(rest, 2)"), F.expr("substring(rest, 3)")
    fresh = F.col("edits") == 0
    arrived = states.join(edges, "node").where(fresh | (F.col("ch") == first))
    same = F.col("ch") == first

    def to(rest: Column, edits: int) -> Column:
        return F.struct(rest.alias("rest"), F.lit(edits).alias("edits"))

    moves = F.array_compact(
        F.array(
            F.when(same, F.struct(rest1.alias("rest"), F.col("edits").alias("edits"))),
            F.when(fresh & (F.col("ch") > first), to(rest1, 1)),  # a greater character
            F.when(fresh & ~same & (F.col("ch") == second), to(rest2, 1)),  # one left out
        )
    )
    moved = arrived.select("word", "child", "is_word", "only", "next", F.explode(moves).alias("m"))
    moved = moved.select("word", "child", "is_word", "only", "next", F.col("m.rest").alias("rest"), F.col("m.edits").alias("edits"))
    edited = F.col("edits") == 1
    near = (
        F.when(edited & F.col("only").isNotNull() & (F.concat("child", "rest") == F.col("only")), F.col("only"))
        .when(edited & F.col("only").isNull() & (F.col("rest") == "") & F.col("is_word"), F.col("child"))
        .when(~edited & F.col("is_word") & (F.length("rest") == 1), F.col("child"))  # its last character is one too many
    )
    # a child that leads to one word is settled; for a state without an edit that word is its own
    follows = ~edited | (F.instr(F.col("next"), F.substring("rest", 1, 1)) > 0)
    goes_on = F.col("only").isNull() & (F.col("rest") != "") & follows
    moved = moved.select("word", "rest", F.col("child").alias("node"), "edits", near.alias("near"), goes_on.alias("goes_on"))
    return moved.where(F.col("near").isNotNull() | F.col("goes_on"))


def _level(states: DataFrame, edges: DataFrame, total: int) -> DataFrame:
    hot = []
    if total >= LARGE:
        often = states.groupBy("node").count().where(F.col("count") * HOT > total)
        hot = [r.node for r in often.select("node").collect()]  # fewer than HOT
    if not hot:
        return _stepped(states, edges)
    is_hot = F.col("node").isin(hot)
    return _stepped(states.where(is_hot), F.broadcast(edges.where(is_hot))).unionByName(_stepped(states.where(~is_hot), edges.where(~is_hot)))


def _trie_neighbours(words: DataFrame) -> DataFrame:
    """``(word, near)``, each pair once, of words up to ``LEVELS`` code points."""
    spark = words.sparkSession
    path = scratch_path(spark, "trie")
    edges = trie_edges(words)
    edges.write.partitionBy("depth").parquet(path)
    edges = spark.read.schema(edges.schema).parquet(path)
    fields = "word string, rest string, node string, edits int"
    states = words.select("word", F.col("word").alias("rest"), F.lit("").alias("node"), F.lit(0).alias("edits"))
    total, depth = states.count(), 0
    found = spark.createDataFrame([], "word string, near string")
    while total:
        step = materialise(_level(states, edges.where(F.col("depth") == depth).drop("depth"), total), f"states{depth}")
        found = found.unionByName(step.where("near IS NOT NULL").select("word", "near"))
        states = step.where("goes_on").select(*[f.name for f in T.StructType.fromDDL(fields)])
        total, depth = states.count(), depth + 1
    return found


def _left_out(word: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``word`` without each of its code points, and the hash of ``word`` as the last; with the place left out (-1)."""
    x = np.frombuffer(word.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
    n = len(x)
    base = np.uint64(0x9E3779B97F4A7C15)
    power = np.ones(n + 1, dtype=np.uint64)
    power[1:] = np.multiply.accumulate(np.full(n, base, dtype=np.uint64))
    # the hash is the sum of x[i] * base ** i; what follows the place left out moves down by one power
    none = np.zeros(1, dtype=np.uint64)
    lower = np.concatenate((none, np.cumsum(x * power[:n])))
    moved = np.concatenate((none, np.cumsum(x[1:] * power[: n - 1])))
    without = lower[:n] + (moved[-1] - moved)
    return np.append(without, lower[-1]).astype(np.int64), np.append(np.arange(n), -1)


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point leads from ``a`` to ``b``."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    short, long = sorted((a, b), key=len)
    low, high = 0, len(short)
    while low < high:  # length of the common prefix
        m = (low + high + 1) // 2
        low, high = (m, high) if short[:m] == long[:m] else (low, m - 1)
    return short[low + (len(a) == len(b)) :] == long[low + 1 :]


def _long_neighbours(words: DataFrame) -> DataFrame:
    """``(word, near)``, each pair once, of words from ``LEVELS`` code points on."""
    key = T.StructType.fromDDL("word_key long, h long, place int, size int")

    def hashes(batches):
        for batch in batches:
            for k, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                h, place = _left_out(word)
                for at in range(0, len(h), 100_000):
                    part = slice(at, at + 100_000)
                    n = len(h[part])
                    columns = [np.full(n, k), h[part], place[part], np.full(n, len(word))]
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, to_arrow_schema(key), strict=True)], schema=to_arrow_schema(key))

    named = materialise(words.select(F.xxhash64("word").alias("word_key"), "word"), "long_words")
    keys = materialise(named.mapInArrow(hashes, key), "left_out")
    a = keys.select(F.col("word_key").alias("a"), "h", "place", "size")
    b = keys.select(F.col("word_key").alias("b"), "h", F.col("place").alias("b_place"), F.col("size").alias("b_size"))
    # replaced: both without the same place; one less: a word without a place is the other word
    replaced = a.where("place >= 0").join(b.withColumnsRenamed({"b_place": "place", "b_size": "size"}), ["h", "place", "size"]).where("a < b").select("a", "b")
    fewer = a.where("place >= 0").join(b.where("b_place = -1"), "h").where("size = b_size + 1").select("a", "b")
    pairs = replaced.unionByName(fewer).distinct()
    both = pairs.join(named.withColumnsRenamed({"word_key": "a", "word": "word"}), "a")
    both = both.join(named.withColumnsRenamed({"word_key": "b", "word": "near"}), "b").select("word", "near")
    target = T.StructType.fromDDL("word string, near string")

    def compared(batches):
        for batch in batches:
            keep = [one_edit(x, y) for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, type=pa.bool_())).cast(f.type) for c, f in zip(batch.columns, to_arrow_schema(target), strict=True)], schema=to_arrow_schema(target))

    return both.mapInArrow(compared, target)


def neighbours(words: DataFrame) -> DataFrame:
    """``(word, near)``, both ways, for distinct words that are exactly one edit apart."""
    long = words.where(F.length("word") >= LEVELS)
    found = _trie_neighbours(words.where(F.length("word") <= LEVELS).select("word"))
    if long.limit(2).count() == 2:
        # pairs of words that both have LEVELS code points are found in the trie too
        found = found.unionByName(_long_neighbours(long.select("word")).where((F.length("word") > LEVELS) | (F.length("near") > LEVELS)))
    return found.unionByName(found.select(F.col("near").alias("word"), F.col("word").alias("near")))


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of the words that have a form.  A form occurs ``FORM_RATIO`` times as often, so chains are short."""
    step = forms.select(F.col("word").alias("root"), F.col("form").alias("next"))
    roots = forms.select("word", F.col("form").alias("root"))
    while True:
        moved = roots.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = materialise(moved, "roots")
        roots = moved.select("word", "root")
        if moved.where("moved").limit(1).count() == 0:
            return roots


def variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = FORM_RATIO, **counting) -> DataFrame:
    """One row for each word: ``n``, ``n_near``, its ``form``, ``form_n`` and the ``root`` that its forms lead to."""
    words = materialise(word_counts(df, id_col, text_col, **counting), "words")
    near = neighbours(words).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    # the least of (-n, word) is the most frequent, ties by code points
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("best"))
    joined = words.join(best, "word", "left")
    strong = -F.col("best.minus") >= F.col("n") * ratio
    found = materialise(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(strong, F.col("best.near")).alias("form"),
            F.when(strong, -F.col("best.minus")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(found.where("form IS NOT NULL").select("word", "form"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
