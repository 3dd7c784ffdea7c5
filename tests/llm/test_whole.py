"""The resampling weights and the whole pipeline against plain versions that share none of their steps."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from sparkprep.llm import quality
from sparkprep.llm.text import GOLDEN, WORD_PUNCT, mix, words


def sentence(rng, n, vocabulary=3000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def _plain_grams(text):
    code = [words([w], WORD_PUNCT).hash[0] for w in re.findall(r"[a-z0-9]+", text or "")]
    two = [mix(a.reshape(1) * np.uint64(3) + mix(b.reshape(1) + GOLDEN))[0] for a, b in zip(code, code[1:])]
    return [int(c) % quality.BUCKETS for c in [*code, *two]]


def test_resampling_weights_equal_a_plain_version(spark):
    rng = random.Random(12)
    rows = [(i, sentence(rng, rng.randrange(1, 40), 60) if i % 3 else sentence(rng, 30, 20)) for i in range(150)]
    rows += [(900, ""), (901, None), (None, rows[4][1]), (4, rows[4][1])]
    target = set(range(0, 60, 3))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ids = spark.createDataFrame([(i,) for i in sorted(target)] + [(None,), (3,)], "doc_id long")
    got = quality.resample(docs, ids, fraction=0.3).collect()

    grams = [_plain_grams(t) for _, t in rows]
    raw, good = Counter(), Counter()
    for (i, _), g in zip(rows, grams, strict=True):
        raw.update(g)
        if i in target:
            good.update(g)
    base = lambda b: (raw[b] + 0.5) / (sum(raw.values()) + 0.5 * quality.BUCKETS)
    ratio = lambda b: math.log((good[b] + 1000 * base(b)) / (sum(good.values()) + 1000) / base(b))
    want = [(i, round(100 * sum(map(ratio, g)) / len(g), 6) if g else -100.0, len(g)) for (i, _), g in zip(rows, grams, strict=True)]
    assert sorted([(r.doc_id, round(r.log_weight, 6), r.n_grams) for r in got], key=repr) == sorted(want, key=repr)

    # the noise is standard Gumbel, the largest keys are selected
    noise = [r.key - r.log_weight for r in got]
    assert np.mean(noise) == pytest.approx(0.577, abs=0.4) and np.std(noise) == pytest.approx(1.28, abs=0.4)
    order = sorted((r.key for r in got), reverse=True)
    assert {r.key for r in got if r.selected} == set(order[: math.ceil(0.3 * len(rows))])


def _plain_lines(docs):
    """Three-line windows that occurred before are cut; what loses all lines goes."""
    seen, out = {}, {}
    for i in sorted(docs):
        lines = (docs[i] or "").split("\n")
        full = [(k, x.strip(" \t\r")) for k, x in enumerate(lines) if x.strip(" \t\r")]
        gone = set()
        for k in range(len(full) - 2):
            window = tuple(x for _, x in full[k : k + 3])
            if window in seen:
                gone |= {n for n, _ in full[k : k + 3]}
            seen.setdefault(window, i)
        kept = [x for k, x in enumerate(lines) if k not in gone]
        if not gone:
            out[i] = docs[i]
        elif any(x.strip(" \t\r") for x in kept):
            out[i] = "\n".join(kept)
    return out


def _plain_near(docs):
    """The least id of each group whose five-word shingles overlap by 0.8 or more."""
    bags = {i: Counter(zip(*[(t or "").split()[k:] for k in range(5)])) for i, t in docs.items()}
    bags = {i: b or Counter([tuple((docs[i] or "").split())] if docs[i] else []) for i, b in bags.items()}
    parent = {i: i for i in docs}

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for a in docs:
        for b in docs:
            if a < b and bags[a] and bags[b] and sum((bags[a] & bags[b]).values()) >= 0.8 * sum((bags[a] | bags[b]).values()):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: t for i, t in docs.items() if root(i) == i}


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(21)
    text = {}
    for i in range(400):
        lines = [sentence(rng, 12) for _ in range(6)]
        text[i] = "\n".join([*lines[:3], "vile nasty vile " + lines[3], *lines[4:]] if i % 4 == 0 else lines)
    passage = "\n".join(sentence(rng, 14) for _ in range(4))
    for i in range(500, 506):
        text[i] = f"{sentence(rng, 12)}\n{passage}\n\n{sentence(rng, 12)}\n{sentence(rng, 12)}"
    # a copy of all lines, and copies on a line of its own that the line stage can't cut
    text[510] = text[1]
    for i in range(520, 526):
        text[i] = sentence(rng, 160)
        text[i + 10], text[i + 20] = text[i], " ".join([*text[i].split()[:-2], "other", "end"])
    items = [(i, sentence(rng, 40, 9000)) for i in range(5)]
    for i in range(5):
        text[600 + i] = f"{sentence(rng, 120)} {items[i][1].upper()} {sentence(rng, 90)}"
    text[700], text[701] = "", None
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, t, "en", "hot" if i % 3 else f"s{i % 2}", len(t or "")) for i, t in text.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i % 4 == 0)) for i in range(400)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, text, [t for _, t in items]


def test_each_stage_equals_its_plain_version(spark, corpus):
    folder, text, items = corpus
    plain = [
        lambda d: {i: t for i, t in d.items() if "vile" not in (t or "")},
        _plain_lines,
        _plain_near,
        lambda d: {i: t for i, t in d.items() if not any(x in (t or "").lower() for x in items)},
    ]
    docs, want = spark.read.parquet(f"{folder}/documents.parquet"), dict(text)
    left = [len(want)]
    for (name, stage), step in zip(corpus_pipeline.STAGES[:-1], plain, strict=True):
        docs, want = stage(spark, docs, folder).cache(), step(want)
        got = {r.doc_id: r.text for r in docs.collect()}
        assert sorted(got) == sorted(want), name
        assert {i: t for i, t in got.items() if t != want[i]} == {}, name
        left.append(len(want))
    # every stage found what was planted for it
    assert left == [len(text), len(text) - 100, len(text) - 101, len(text) - 113, len(text) - 118]
    mixed = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id: r.text for r in mixed} == want
