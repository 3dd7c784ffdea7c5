"""Brute force and edge cases of hard negatives, line-first rules and spelling variants."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkprep.llm import hard_negatives, line_cleaning, spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def mined(rows, positives=5, negatives=5, low=80, high=100, scale=256):
    """Brute force over ``(id, label, vector)``."""
    use = []
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        use.append((i, label, [math.floor(scale * x) for x in v]))
    out = []
    for a, label, v in use:
        if a % 10:
            continue
        met = [(-sum(x * y for x, y in zip(v, w, strict=True)), i, m == label) for i, m, w in use if i != a and len(w) == len(v)]
        for s, i, same in sorted(x for x in met if x[2])[:positives]:
            fits = sorted((t, j) for t, j, m in met if not m and low * -s <= 100 * -t <= high * -s)[:negatives]
            out += [(a, i, rank, j, -s, -t) for rank, (t, j) in enumerate(fits, 1)]
    return sorted(out)


def found(df, **options):
    got = hard_negatives.hard_negatives(df, F.col("id") % 10 == 0, **options)
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got.collect())


VECTORS = "vec_id long, embedding array<double>, label int, page int, tile string, probe long, windows int, part int"


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "PAGE", 40)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 5)
    monkeypatch.setattr(hard_negatives, "BOUNDS", 4)
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((4, 6))
    rows = [(i, int(rng.integers(0, 3)), (centres[i % 4] + 0.3 * rng.standard_normal(6)).round(2).tolist()) for i in range(260)]
    # a third of the rows are one vector: ties, and more rows than a page holds
    rows += [(1000 + i, i % 3, rows[3][2]) for i in range(130)]
    rows += [(2000, None, [1.0] * 6), (2010, 1, None), (2020, 1, [math.nan] * 6), (2030, 1, [1.0, None]), (2040, 1, [1.0, 2.0]), (2041, 1, [1.0, 2.0])]
    rows += [(2042, 2, [1.0, 1.9]), (None, 1, [1.0] * 6), (2050, 1, []), (2051, 1, []), (2052, 2, []), (30, rows[30][1], rows[30][2])]
    df = spark.createDataFrame([(i, v, m, 0, "t", 1, 2, 3) for i, m, v in rows], VECTORS)
    assert found(df) == mined(rows)
    assert found(df, positives=2, negatives=3, low=-50, high=90, scale=10) == mined(rows, 2, 3, -50, 90, 10)
    assert found(df.where("false")) == []
    assert found(df.where("vec_id % 10 <> 0")) == []


def test_boxes_bound_exactly_and_big_products_stay_whole():
    rng = np.random.default_rng(1)
    x = rng.integers(-(2**40), 2**40, (200, 5))
    q = rng.integers(-(2**20), 2**20, (3, 5))
    least, most = hard_negatives._bounds(x.min(0)[None], x.max(0)[None], q)
    exact = [[sum(int(a) * int(b) for a, b in zip(r, p, strict=True)) for p in x] for r in q]
    assert hard_negatives._dot(q, x).tolist() == exact
    assert all(least[i, 0] <= min(exact[i]) and max(exact[i]) <= most[i, 0] for i in range(3))


def test_the_tree_passes_over_boxes(monkeypatch):
    """A search in well parted data scores a small part of the rows."""
    scored = []
    plain = hard_negatives._dot
    monkeypatch.setattr(hard_negatives, "_dot", lambda a, b: scored.append(len(b)) or plain(a, b))
    rng = np.random.default_rng(2)
    vecs = np.repeat(rng.integers(-200, 200, (64, 4)), 64, axis=0) + rng.integers(0, 3, (4096, 4))
    tree = hard_negatives.Tree(np.arange(4096), np.zeros(4096, dtype=np.int64), vecs)
    scored.clear()
    got = tree.search(-1, 0, vecs[5], True, [(None, None, None)], 5)[0]
    exact = sorted(zip((-(vecs @ vecs[5])).tolist(), range(4096), strict=True))[:5]
    assert [(-s, i) for s, i in got] == exact and sum(scored) < 1500


DOCS = "doc_id long, text string, row string, f int, lost int, kept int, base_failed int"


def repeat_words(words):
    runs = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    hit = {k + j for k in range(len(words) - 4) if runs[tuple(words[k : k + 5])] > 1 for j in range(5)}
    return len(hit)


def test_counts_of_lines_equal_plain_python(spark):
    rng = random.Random(3)
    bits = ["a", "b.", "c", "##", "|", "\t", "\n", " ", "  ", "é!", "x\x0by", "\n\n", "ÀB", "$", " z", "\r\n"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(60))) for _ in range(300)] + ["", None, "a " * 3000, "\n" * 50, "w" * 100_000]
    texts += [" ".join(rng.choice("abcdefgh") for _ in range(200)) for _ in range(20)]
    rows = [(i, t, "r", 1, 2, 3, 4) for i, t in enumerate(texts)] + [(0, texts[0], "r", 1, 2, 3, 4), (None, "null id.", "r", 1, 2, 3, 4)]
    got = line_cleaning.line_quality(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    for r in got:
        t = "null id." if r.doc_id is None else texts[r.doc_id] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        again = repeat_words(words)
        base = len(words) < 10 or 100 * again > 20 * len(words)
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), again, base)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        assert r.kept == (not base and 2 * r.lost_chars <= r.word_chars)
        assert sum(r.failed) <= len(lines)


@pytest.mark.parametrize(
    "line, rule",
    [
        ("A plain sentence that ends.", None),
        ("He said: “It ends here.”", None),
        ("Home | News | Sport | About", "navigation"),
        ("Home › News › Sport.", "navigation"),
        ("All rights reserved.", "boilerplate"),
        ("Licensed under the Apache License, Version 2.0.", "boilerplate"),
        ("BUY THIS NOW!! TODAY ONLY!", "shouting"),
        ("wo### rd$$$ an%%% other.", "symbols"),
        ("no end of a sentence", "punctuation"),
        ("The NATO treaty was signed. It held", None),
        ("", None),
        (" \t ", None),
    ],
)
def test_rules_of_a_line(spark, line, rule):
    assert spark.createDataFrame([(line,)], "t string").select(line_cleaning.failing_rule(F.col("t")).alias("r")).first().r == rule


def test_cleaning_keeps_rows_and_columns(spark):
    good = "It is a fine day in the old town. All of them went out to see it."
    rows = [(1, f"{good}\nHome | News | Sport\n\n{good[::-1]} and so on."), (2, "A | B | C | D | E | F | G | H | I | J"), (3, None), (None, good), (1, good)]
    docs = spark.createDataFrame([(i, t, f"r{i}", 7, 8, 9, 10) for i, t in rows], DOCS)
    out = line_cleaning.clean(docs)
    assert out.columns == docs.columns
    got = sorted((r.doc_id or 0, r.text, r.row, r.f, r.lost, r.kept, r.base_failed) for r in out.collect())
    assert got == sorted([(1, f"{good}\n\n{good[::-1]} and so on.", "r1", 7, 8, 9, 10), (0, good, "rNone", 7, 8, 9, 10), (1, good, "r1", 7, 8, 9, 10)])
    assert line_cleaning.clean(docs.where("false")).count() == 0
    assert line_cleaning.line_quality(docs.where("false")).count() == 0
    plan = line_cleaning.line_quality(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def spelled(rows, drop=199):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % drop == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near, holes = defaultdict(set), defaultdict(set)
    for w in words:
        for k in range(len(w)):
            holes[k, w[:k], w[k + 1 :]].add(w)
            if (d := w[:k] + w[k + 1 :]) in words:
                near[w].add(d)
                near[d].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {w: min(near[w], key=lambda x: (-words[x], x)) if near[w] else None for w in words}
    form = {w: f if f and words[f] >= 5 * words[w] else None for w, f in form.items()}
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words.get(form[w]))
    return out


def test_variants_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(spelling, "LARGE", 50)  # hot nodes too
    monkeypatch.setattr(spelling, "HOT", 8)
    monkeypatch.setattr(spelling, "LEVELS", 12)
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abé", k=rng.randrange(5, 9))) for _ in range(300)] + ["Prefix" + "".join(rng.choices("xyz", k=3)) for _ in range(20)]
    long = "q" * 60
    # long words: a replaced, a missing and an added letter at the border of the levels, and a very long one
    vocabulary += [long, long[:-1], long[:30] + "z" + long[31:], "m" * 11, "m" * 12, "m" * 13, "m" * 5 + "n" + "m" * 6, "k" * 3000, "k" * 1500 + "j" + "k" * 1500]
    rows = [(i, " ".join(rng.choices(vocabulary, k=400)) + "× UPPER 123") for i in range(30)]
    rows += [(100 + i, (" " + long) * 30) for i in range(5)] + [(None, "wordsy " * 9), (300, "chainss " * 5 + "chains " * 30 + "chainz " * 200), (200, None), (201, ""), (0, rows[0][1])]
    df = spark.createDataFrame([(i, t, "w", 1, "n", 2) for i, t in rows], "doc_id long, text string, word string, n int, node string, h int")
    got = spelling.variants(df).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == spelled(rows)
    assert len(got) == len({r.word for r in got}) and any(r.root != r.form for r in got if r.form)
    assert spelling.variants(df.where("false")).count() == 0


def test_one_edit():
    rng = random.Random(5)
    for _ in range(3000):
        a, b = ("".join(rng.choices("ab", k=rng.randrange(6))) for _ in range(2))
        edits = {a[:i] + c + a[i + 1 :] for i in range(len(a)) for c in "ab"} | {a[:i] + a[i + 1 :] for i in range(len(a))}
        edits |= {a[:i] + c + a[i:] for i in range(len(a) + 1) for c in "ab"}
        assert spelling.one_edit(a, b) == (b in edits - {a})
    h, place = spelling._left_out("abcab")
    assert place.tolist() == [0, 1, 2, 3, 4, -1]
    assert [spelling._left_out("abcab"[:i] + "abcab"[i + 1 :])[0][-1] for i in range(5)] == h[:5].tolist()


def test_words_of_a_regular_shape_have_hashes_of_their_own():
    from sparkprep.llm.text import SPACED, words

    a, b = "a", "b"
    for _ in range(10):  # Thue-Morse words, which any polynomial modulo a power of two confuses
        a, b = a + b, b + a
    texts = [a, b, a + b, b + a, "a" * 8, "a" * 16, "a" * 15, "\0" * 3, "\0" * 4, "x" * 8 + "y" * 8, "y" * 8 + "x" * 8]
    w = words(texts, SPACED)
    assert len(w.hash) == len(set(w.hash.tolist())) == len(texts)
    assert (words(texts[::-1], SPACED).hash[::-1] == w.hash).all()


def test_vectors_that_share_a_chained_hash_do_not_link(spark):
    from sparkprep.llm import embedding_dedup

    rows = [(1, [1.0, 0.5]), (2, [-28.428571428571427, -40.77132564411774]), (3, [2.0, 1.0]), (4, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {r.vec_id: r.n_links for r in embedding_dedup.near_vectors(df).collect()} == {1: 2, 2: 0, 3: 2, 4: 2}
    exact = embedding_dedup.near_vectors(df, threshold=1.0).collect()
    assert {r.vec_id: r.n_links for r in exact}[2] == 0


def test_long_runs_cost_their_length_once():
    import time

    from sparkprep.llm import pii

    start = time.perf_counter()
    for text in ("a" * 10**6 + " 1", "7" * 10**6 + " 1.2", "a.b" * 300_000 + " 1 @", "x" * 10**6 + "@" + "y" * 10**6 + " 5"):
        pii.field(text, pii.base_spans(text))
    assert time.perf_counter() - start < 10


def test_many_repeated_lines_cost_their_number_once(spark):
    import time

    from sparkprep.llm import line_dedup

    lines = "\n".join(f"line {i} of a long list" for i in range(60_000))
    df = spark.createDataFrame([(1, lines, "g"), (2, lines + "\nend", "g"), (3, "x\n" + lines, "g")], "doc_id long, text string, gone string")
    start = time.perf_counter()
    out = {r.doc_id: r for r in line_dedup.drop_repeated_lines(df).collect()}
    assert out[1].text == lines and (out[2].text, out[3].text) == ("end", "x") and out[2].gone == "g"
    assert time.perf_counter() - start < 60


def test_the_loss_is_read_under_the_mask():
    from sparkprep.llm import chat

    made = chat.format_one([("user", "a question?"), ("assistant", "an answer: </s> é🙂"), ("user", "x"), ("assistant", "y")])
    read = lambda mask: chat.masked_text(made["formatted"], mask, made["token_start"], made["token_end"])
    assert read(made["loss_mask"]) == "an answer: </s> é🙂y"
    assert read([False] * len(made["tokens"])) == ""
    first = made["loss_mask"].index(True)
    assert read([m and k != first for k, m in enumerate(made["loss_mask"])]) != "an answer: </s> é🙂y"


def test_clashing_columns_come_back(spark):
    from sparkprep.llm import decontaminate, line_dedup, mixing, near_dedup, toxicity

    names = "gone __id __h __gone __s __at __part __toxic_text __bench_text toxic_score toxic_evidence bench_matches row s at p i slot h part key found".split()
    schema = "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names)
    rows = [(i, " ".join(f"w{i * 100 + k}" for k in range(30)) + ".", f"s{i % 2}", *[f"{n}{i}" for n in names]) for i in range(20)]
    df = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(i, int(i < 5)) for i in range(20)], "doc_id long, toxic int")
    bench = spark.createDataFrame([(1, rows[3][1])], "item_id long, text string")
    want = {r[0]: r for r in rows}
    for out in (
        line_dedup.drop_repeated_lines(df),
        toxicity.drop_toxic(df, labels, threshold=1.1),
        near_dedup.drop_near_duplicates(df),
        decontaminate.drop_contaminated(df, bench),
        mixing.mix(df).drop(*mixing.ADDED),
    ):
        assert out.columns == df.columns
        assert all(tuple(r) == want[r.doc_id] for r in out.collect())
    assert decontaminate.drop_contaminated(df, bench).count() == 19


def test_executors_need_no_copy_of_the_library(tmp_path):
    """The library lies on the driver's path only; Python workers start in a folder without it."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    repo = Path(__file__).resolve().parent.parent.parent
    script = f"""
import sys
sys.path.insert(0, {str(repo)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
from pyspark.sql import functions as F
from sparkprep.llm import decontaminate, hard_negatives, mixing, near_dedup, spelling, toxicity
def absent(frames):
    import importlib.util
    for f in frames:
        yield f.assign(id=int(importlib.util.find_spec("sparkprep") is not None))
assert spark.range(4).mapInPandas(absent, "id long").agg(F.max("id")).first()[0] == 0
docs = spark.createDataFrame([(i, " ".join(f"w{{i * 100 + k}}" for k in range(30)) + (" vile" if i < 9 else "")) for i in range(40)], "doc_id long, text string")
labels = spark.createDataFrame([(i, int(i < 9)) for i in range(40)], "doc_id long, toxic int")
assert toxicity.scores(docs, labels).count() == 40
bench = docs.where("doc_id = 20").withColumnRenamed("doc_id", "item_id")
found = decontaminate.benchmark_matches(docs, bench).where(F.size("bench_matches") > 0)
assert 20 in [r.doc_id for r in found.collect()]
assert near_dedup.near_duplicates(docs).count() == 40
vectors = spark.createDataFrame([(i, i % 2, [float(i % 7), 1.0]) for i in range(60)], "vec_id long, label int, embedding array<double>")
assert hard_negatives.hard_negatives(vectors, F.col("id") % 20 == 0).count() > 0
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=400)
    assert done.returncode == 0, done.stderr[-2000:]
