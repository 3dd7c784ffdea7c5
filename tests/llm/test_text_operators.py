"""Edge cases and brute-force comparisons of the text operators on small tables."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from sparkprep.llm import chat, decontaminate, embedding_dedup, line_dedup, mixing, near_dedup, pii, quality, token_counts, toxicity
from sparkprep.llm.graph import components
from sparkprep.llm.text import ALNUM, SPACED, shingles, words

DOCS = "doc_id long, text string, source string, id string, rep int"


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def test_words_are_those_of_a_regex():
    texts = ["", "a b  c\n", "Été über-x a", " b a", "x" * 5000]
    for table, pattern in ((SPACED, r"[^ \t\n\r\v\f]+"), (ALNUM, r"[^\W_]+")):
        w = words(texts, table)
        flat = [m for t in texts for m in re.findall(pattern, t)]
        assert len(flat) == len(w.hash)
        assert len(set(flat)) == len(set(w.hash.tolist()))
        assert np.diff(w.first).tolist() == [len(re.findall(pattern, t)) for t in texts]


def test_shingles_of_short_texts():
    code, doc = shingles(words(["", "a b", "a b", "a b c d e f"], SPACED), 5)
    assert doc.tolist() == [1, 2, 3, 3] and code[0] == code[1]


def test_components_of_a_chain_and_nothing(spark):
    got = components(spark.createDataFrame([(i, i + 1) for i in range(20)] + [(50, 51), (7, 7)], "a long, b long"))
    assert {(r.id, r.component) for r in got.collect()} == {(i, 0) for i in range(21)} | {(50, 50), (51, 50)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((30, 16))
    rows = [(i, (base[i % 30] + 0.15 * rng.standard_normal(16)).tolist(), 0) for i in range(240)]
    rows += [(1000 + i, rows[3][1], 1) for i in range(40)]
    odd = [(2000, None, 0), (2001, [0.0] * 16, 0), (2002, [math.nan] * 16, 0), (2003, [], 0), (2004, [1.0, None], 0), (2005, [1.0, 2.0], 0), (None, [1.0], 0)]
    got = embedding_dedup.near_vectors(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, n int")).collect()
    assert len(got) == len(rows) + len(odd)
    x = np.array([r[1] for r in rows])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = u @ u.T >= 0.95
    ids = [r[0] for r in rows]
    label = list(range(len(rows)))
    for i, j in zip(*np.nonzero(hit), strict=True):
        a, b = sorted((label[i], label[j]))
        label = [a if z == b else z for z in label]
    least = {c: min(ids[i] for i in range(len(ids)) if label[i] == c) for c in set(label)}
    found = {r.vec_id: r for r in got}
    for i, v in enumerate(ids):
        assert (found[v].n_links, found[v].component_id) == (hit[i].sum() - 1, least[label[i]])
    for v in range(2000, 2006):
        assert (found[v].n_links, found[v].component_id, found[v].kept) == (0, v, True)
    assert not found[None].kept
    assert embedding_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_signatures_estimate_the_weighted_index():
    rng = random.Random(3)
    errors, spread = [], 0.0
    for _ in range(12):
        a = [f"w{rng.randrange(40)}" for _ in range(300)]
        b = [w if rng.random() < 0.8 else f"z{rng.randrange(9)}" for w in a]
        doc, code, count = near_dedup.multisets([" ".join(a), " ".join(b)], 1)
        ca, cb = Counter(a), Counter(b)
        true = sum((ca & cb).values()) / sum((ca | cb).values())
        assert abs(near_dedup.similarity(" ".join(a), " ".join(b), 1) - true) < 1e-12
        s = near_dedup.signatures(doc, code, count, 2, 2000)
        errors.append((s[0] == s[1]).mean() - true)
        spread += true * (1 - true) / 2000
    assert abs(sum(errors)) < 5 * math.sqrt(spread)


def _classes(texts, threshold=0.8):
    ids = sorted(texts)
    label = {i: i for i in ids}
    for i in ids:
        for j in ids:
            if i < j and near_dedup.similarity(texts[i], texts[j]) >= threshold and label[i] != label[j]:
                a, b = sorted((label[i], label[j]))
                label = {k: a if v == b else v for k, v in label.items()}
    return label


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(1)
    texts, n = {}, 0
    for _ in range(6):
        base = sentence(rng, 120).split()
        for _ in range(15):
            w = list(base)
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = f"q{rng.randrange(999)}"
            texts[n], n = " ".join(w), n + 1
    texts |= {n: "few words", n + 1: "Few words", n + 2: "", n + 3: "", n + 4: texts[0]}
    rows = [(i, t, "s", "x", 1) for i, t in texts.items()] + [(n + 5, None, "s", "x", 1), (None, texts[0], "s", "x", 1), (5, texts[5], "s", "x", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    got = near_dedup.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    want = _classes(texts) | {n + 5: n + 5}
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == want
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(want.values()) | {None}
    assert near_dedup.near_duplicates(docs.where("false")).count() == 0


def test_a_link_between_two_members_that_the_least_one_misses(spark):
    rng = random.Random(9)
    base = sentence(rng, 100).split()
    far = [f"p{k}" if k % 23 == 3 else w for k, w in enumerate(base)]  # too far from base
    close = list(far)
    close[50] = "other"
    texts = {0: " ".join(base), 1: " ".join(far), 2: " ".join(close)}
    got = near_dedup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    assert {r.doc_id: r.class_id for r in got.collect()} == _classes(texts)


def test_line_windows(spark):
    rows = [
        (1, "a\nb\nc\nd\nx"),
        (2, "q\na\nb \n\nc\nd\ny"),
        (3, "a\nb"),
        (4, None),
        (5, ""),
        (6, "r\nr\nr\nr\nr"),
        (None, "a\nb\nc"),
    ]
    docs = spark.createDataFrame([(i, t, "s", "i", 0) for i, t in rows], DOCS)
    got = line_dedup.drop_repeated_lines(docs, removed_col="gone")
    assert got.columns == [*docs.columns, "gone"]
    found = {r.doc_id: (r.text, r.gone) for r in got.collect()}
    # null ids come first, so their window is the first occurrence
    assert found[None] == ("a\nb\nc", [])
    # its window "b c d" occurs here first, so "d" stays
    assert found[1] == ("d\nx", [0, 1, 2])
    assert found[2] == ("q\n\ny", [1, 2, 4, 5])
    assert found[3] == ("a\nb", []) and found[4] == (None, []) and found[5] == ("", [])
    assert found[6] == ("r", [1, 2, 3, 4])
    copies = docs.where("doc_id = 1").unionByName(docs.where("doc_id = 1").selectExpr("2L AS doc_id", "text", "source", "id", "rep"))
    assert {r.doc_id for r in line_dedup.drop_repeated_lines(copies, drop_emptied=True).collect()} == {1}
    assert line_dedup.drop_repeated_lines(docs.where("false")).count() == 0


@pytest.mark.parametrize("repeat", [True, False])
def test_mix_stays_within_one_block(spark, repeat):
    rows = [(i, f"t{i}", s, "i", 0) for s, n in (("a", 400), ("b", 160), (None, 80)) for i in range(n)]
    docs = spark.createDataFrame(rows, DOCS)
    weights = {"a": 0.5, "b": 0.3, None: 0.2}
    got = mixing.mix(docs, weights, block=4, repeat=repeat).collect()
    if not repeat:
        assert sorted((r.source or "", r.doc_id) for r in got) == sorted((s or "", i) for i, _, s, _, _ in rows)
    slots = {}
    for r in got:
        assert slots.setdefault(r.mix_slot, r.source) == r.source
        assert r.mix_release <= r.mix_slot < r.mix_due
    sent, full = Counter(), min(n / 4 / w for n, w in ((400, 0.5), (160, 0.3), (80, 0.2)))
    for t in range(int(full) if not repeat else max(slots) + 1):
        sent[slots[t]] += 1
        assert all(abs(sent[s] - (t + 1) * w) < 1 for s, w in weights.items())
    assert {(r.source, r.doc_id) for r in got} == {(s, i) for i, _, s, _, _ in rows}
    assert mixing.mix(docs.where("false"), weights).count() == 0
    assert mixing.mix(docs, {"a": 1.0}, repeat=False).count() == len(rows)


def test_mix_of_many_sources_and_a_hot_one(spark):
    cases = [
        {f"s{i}": 0.5 for i in range(300)} | {"hot": 850.0},
        {f"s{i}": 0.5 for i in range(600)} | {f"t{i}": 5.0 for i in range(140)},
        {f"s{i}": 1.0 for i in range(1001)},
        {f"s{i}": 1.0 for i in range(1001)} | {"hot": 999.0},
    ]
    for weights in cases:
        sizes = spark.createDataFrame([(f"={s}", 1) for s in weights], "s string, n long")
        slots, total = mixing.slots_for(sizes, weights), sum(weights.values())
        p = {r.s[1:]: r.p for r in mixing.shares_of(sizes, weights, slots).collect()}
        assert sum(p.values()) == slots and all(abs(p[s] - slots * w / total) < 1 <= p[s] for s, w in weights.items())
    # below one share of the longest period: lifted, and the others share the loss
    weights = {f"s{i}": 1e-9 for i in range(900)} | {"a": 2.0, "b": 1.0}
    sizes = spark.createDataFrame([(f"={s}", 1) for s in weights], "s string, n long")
    p = {r.s[1:]: r.p for r in mixing.shares_of(sizes, weights, 1000).collect()}
    assert sum(p.values()) == 1000 and min(p.values()) == 1 and 1.9 < p["a"] / p["b"] < 2.1
    rows = [(i, f"t{i}", f"s{i}", "i", 0) for i in range(1001)] + [(2000 + i, "t", "hot", "i", 0) for i in range(400)]
    got = mixing.mix(spark.createDataFrame(rows, DOCS), cases[3], block=1, repeat=False).collect()
    assert sorted(r.doc_id for r in got) == [r[0] for r in rows]
    assert len({r.mix_slot for r in got}) == len(got) and all(r.mix_release <= r.mix_slot < r.mix_due for r in got)
    hot = sorted(r.mix_slot for r in got if r.source == "hot")
    assert all(abs(k - t * 999 / 2000) <= 1 for k, t in enumerate(hot))


def test_chat_round_trip_of_hostile_texts(spark):
    rng = random.Random(2)
    bits = ["<|end|>\n", "<|assistant|>\n", "\\", "\n", "é", "<", "|>", "<|", "</s>", "[INST]", " ok", "🙂", "<|conv|>"]
    for _ in range(300):
        turns = [(rng.choice(["user", "assistant", "", "<|"]), "".join(rng.choices(bits, k=rng.randrange(6)))) for _ in range(rng.randrange(1, 5))]
        made = chat.format_one(turns)
        assert chat.parse(made["formatted"]) == turns
        said = "".join(chat.unescape(made["formatted"][s:e]) for s, e in zip(made["loss_start"], made["loss_end"], strict=True))
        assert said == "".join(t for r, t in turns if r == "assistant")
        assert any(made["loss_mask"]) == bool(said)
    rows = [(1, 1, "assistant", None), (1, 0, "user", "hi"), (2, 0, None, "x"), (None, 0, "user", "y")]
    got = chat.read_back(chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    found = {r.conv_id: r for r in got.collect()}
    assert found[1].turns_sha256 == hashlib.sha256(b"user\nhi\nassistant\n\n").hexdigest()
    assert (found[1].n_turns, found[1].loss_chars, found[2].n_turns, found[None].n_turns) == (2, 0, 1, 1)


def test_token_counts_are_those_of_the_whole_text(spark):
    rows = [(1, "hello world\nsecond line é🙂\n"), (2, None), (3, "x" * 3000), (1, "again")]
    got = token_counts.token_counts(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 4
    for r in got:
        assert sum(r.section_tokens) == r.n_tokens
    by = {(r.doc_id, len(r.section_start)): r for r in got}
    text = rows[0][1]
    ids, starts = token_counts.token_starts(text)
    assert by[(1, 3)].n_tokens == len(ids)
    for s, e, n in zip(by[(1, 3)].section_start, [*by[(1, 3)].section_start[1:], len(text) + 1], by[(1, 3)].section_tokens, strict=True):
        assert n == sum(s <= c < e for c in starts)
    assert by[(2, 1)].n_tokens == 0
    two = token_counts.token_counts(spark.createDataFrame([(1, "a b", "c")], "doc_id long, t string, u string"), field_cols=("t", "u")).first()
    assert two.section_field == [0, 1] and sum(two.section_tokens) == two.n_tokens


def test_base_spans_equal_plain_patterns():
    rng = random.Random(4)
    bits = ["a.b", "@", "x-1", ".com", " ", "+", "1234", "(", ") ", "555-", "99.", "255", "4111 1111 1111 1111", "é", ".", "12", "300."]
    for _ in range(3000):
        t = "".join(rng.choices(bits, k=rng.randrange(14)))
        want = sorted((m.start(), k, m.end()) for k, kind in enumerate(pii.KINDS) for m in re.finditer(pii.BASE[kind], t) if pii._passes(kind, m[0]))
        assert pii.base_spans(t) == [(s, pii.KINDS[k], e) for s, k, e in want]


def test_distant_mentions_share_their_label(spark):
    rng = random.Random(6)
    rows = [(i, f"{sentence(rng, 20)} +1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)} {sentence(rng, 30)} a{i}@mail.org 10.0.0.{i}") for i in range(60)]
    rows += [(100, "call +1 (212) 555-0187 now " + sentence(rng, 60) + " or (212) 555-0187 later"), (101, None), (102, "")]
    got = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [x.kind for x in got[100].base] == ["phone"]
    assert [x.kind for x in got[100].found] == ["phone", "phone"]
    assert got[101].found == [] and got[102].found == []
    assert all(set(map(tuple, r.base)) <= set(map(tuple, r.found)) for r in got.values())


def test_evidence_reaches_the_last_of_many_repeats():
    n, labels = 60, len(pii.KINDS) + 1
    link = np.full((labels, labels), -4.0) + 8.0 * np.eye(labels)
    w = pii.Weights(np.zeros((pii._FEATURES, labels)), np.zeros((labels, labels)), link)
    known = np.zeros(n, dtype=np.int64)
    known[0] = 4
    f = pii.Field([(i, i + 1) for i in range(n)], np.zeros((n, pii._FEATURES)), known, [], [(i, i + 1) for i in range(n - 1)])
    step = np.exp(link) / np.exp(link).sum(axis=1, keepdims=True)
    got = pii.marginals(f, w)
    for i in range(n):
        assert np.allclose(got[i], np.linalg.matrix_power(step, i)[4], atol=1e-3)


def test_copies_do_not_move_the_field(spark):
    texts = [f"call +1 (555) {200 + i}-{1000 + i} or 555{200 + i}{1000 + i}, mail a{i}@b.com" for i in range(40)] + ["no. 12-34-56-78 and 10.0.0.1"]
    once = pii.fit(spark.createDataFrame([(t,) for t in texts], "text string"))
    hot = pii.fit(spark.createDataFrame([(t,) for t in texts + texts[-1:] * 3000], "text string"))
    for a, b in zip(once, hot, strict=True):
        assert np.allclose(a, b, rtol=0, atol=1e-12)


def test_messages_are_exact_on_a_chain():
    rng = np.random.default_rng(0)
    labels = len(pii.KINDS) + 1
    w = pii.Weights(rng.standard_normal((pii._FEATURES, labels)), rng.standard_normal((labels, labels)), rng.standard_normal((labels, labels)))
    f = pii.Field([(0, 1), (2, 3), (4, 5)], rng.standard_normal((3, pii._FEATURES)), np.array([0, 0, 2]), [(0, 1)], [(1, 2)])
    node = np.exp(f.features @ w.node)
    joint = np.einsum("a,b,c,ab,bc->abc", node[0], node[1], np.eye(labels)[2], np.exp(w.chain), np.exp(w.skip))
    joint /= joint.sum()
    p = pii.marginals(f, w, 200)
    assert np.allclose(p[0], joint.sum((1, 2)), atol=1e-4) and np.allclose(p[1], joint.sum((0, 2)), atol=1e-4)


def test_nearest_examples_equal_brute_force():
    rng = np.random.default_rng(8)
    vectors = []
    for _ in range(300):
        t = np.sort(rng.choice(40, rng.integers(0, 6), replace=False))
        x = rng.random(len(t)) + 0.1
        vectors.append((t.astype(np.int64), x / np.sqrt(x @ x) if len(t) else x))
    index = toxicity.Index(vectors, rng.integers(0, 2, 300), list(range(300)), 40, block=16)
    dense = np.zeros((300, 40))
    for i, (t, x) in enumerate(index.vectors):
        dense[i, t] = x
    for q in (dense[5], dense[77], dense[150], np.zeros(40)):
        t = np.flatnonzero(q)
        place, cosine = index.nearest(t, q[t], 7)
        full = np.round(dense @ q, 9)
        order = [i for i in np.lexsort((np.arange(300), -full)) if full[i] > 0][:7]
        assert place.tolist() == order and np.allclose(cosine, full[order])


def test_toxicity_on_planted_words(spark):
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        docs.append((i, sentence(rng, 60, 3000) + (" vile nasty vile" if bad else ""), "s", "x", 0))
        labels.append((i, 1, int(bad)))
    docs += [(1000, None, "s", "x", 0), (1001, "", "s", "x", 0), (None, "vile nasty vile " + sentence(rng, 50), "s", "x", 0)]
    table = spark.createDataFrame(docs, DOCS)
    known = spark.createDataFrame(labels + [(3, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.scores(table, known).collect()
    assert len(got) == len(docs)
    held = {r.doc_id for r in table.where(toxicity.held_out()).select("doc_id").collect()}
    assert held and None not in held
    for r in got:
        if r.doc_id in held and r.doc_id < 400:
            assert (r.toxic_score >= 0.7) == (r.doc_id % 4 == 0)
    kept = toxicity.drop_toxic(table, known)
    assert kept.columns == table.columns and {1000, 1001} <= {r.doc_id for r in kept.collect()}
    assert toxicity.scores(table, known.where("false")).where("toxic_score > 0").count() == 0
    assert toxicity.scores(table.where("false"), known).count() == 0


def test_benchmark_items_are_found(spark):
    rng = random.Random(7)
    items = [(i, sentence(rng, 30, 5000) + ". " + sentence(rng, 8, 5000) + ".") for i in range(12)] + [(50, ""), (51, None), (52, sentence(rng, 150, 5000))]
    plain = lambda: sentence(rng, 150, 5000)
    docs = [(i, plain(), "s", "x", 0) for i in range(60)]
    docs += [(100 + i, f"{plain()} {items[i][1].upper()} {plain()}", "s", "x", 0) for i in range(6)]
    half = items[7][1].split()
    half[3] = half[9] = "changed"
    docs += [(200, f"{plain()} {' '.join(half)} {plain()}", "s", "x", 0), (201, None, "s", "x", 0), (202, f"{plain()} {items[14][1]}", "s", "x", 0)]
    table = spark.createDataFrame(docs, DOCS)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: {m.item_id for m in r.bench_matches} for r in decontaminate.benchmark_matches(table, bench).collect()}
    want = {100 + i: {i} for i in range(6)} | {200: {7}, 202: {52}}
    assert {k: v for k, v in got.items() if v} == want
    kept = decontaminate.drop_contaminated(table, bench)
    assert kept.columns == table.columns and kept.count() == len(docs) - len(want)
    assert decontaminate.drop_contaminated(table, bench.where("false")).count() == len(docs)
    assert decontaminate.benchmark_matches(table.where("false"), bench).count() == 0


def test_latent_space_is_fitted_on_every_passage(spark, monkeypatch):
    """The space of many small texts, some copied, some long, is that of a dense matrix of all their passages."""
    rng = random.Random(31)
    bench = [(i, sentence(rng, 40, 300)) for i in range(4)]
    texts = [sentence(rng, rng.randrange(0, 40), 300) for _ in range(4500)] + [sentence(rng, 32 * k + 7 * j, 300) for k in range(12) for j in range(3)]
    texts += texts[:50] * 3 + [None, ""]
    made = []
    fit = decontaminate._space
    monkeypatch.setattr(decontaminate, "_space", lambda *a: made.append(fit(*a)) or made[-1])
    rows, items = spark.createDataFrame(enumerate(texts), "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    assert decontaminate.benchmark_matches(rows, items, rank=6).count() == len(texts)

    place = {w: decontaminate._hashes(w)[0] for _, t in bench for w in t.lower().replace(".", " ").split()}
    order = {w: k for k, w in enumerate(sorted(place, key=place.get))}
    split = lambda t: [order.get(w, -1) for w in (t or "").lower().replace(".", " ").split()]
    count = lambda ws: np.bincount([w for w in ws if w >= 0], minlength=len(order))
    pieces = [[count(w[a : a + 32]) for a in range(0, len(w), 32)] for w in map(split, texts)]
    flat = np.array([p for ps in pieces for p in ps])
    df = (flat > 0).sum(axis=0)
    idf = np.where(df > 0.1 * len(flat), 0, np.log((len(flat) + 1) / (df + 1)))
    of = dict(zip([t or "" for t in texts], pieces, strict=True))
    a = np.array([p for ps in of.values() for p in ([x + y for x, y in zip(ps[:-1], ps[1:], strict=True)] or ps)]) * idf
    b = np.array([count(split(t)) for _, t in bench]) * idf
    q = np.random.default_rng(0).standard_normal((len(order), 6))
    for _ in range(2):
        docs, own = a.T @ (a @ q), b.T @ (b @ q)
        q = np.linalg.qr(docs + np.linalg.norm(docs) / np.linalg.norm(own) * own)[0]
    (space,) = made
    got = np.linalg.qr(np.divide(space.terms, idf[:, None], where=idf[:, None] != 0, out=np.zeros_like(q)))[0]
    assert idf.any() and np.abs(got @ got.T - q @ q.T).max() < 1e-3


def test_items_among_heavier_words_are_candidates(spark):
    """Words of the item are in many texts; those around it are rare ones of other items, so that the cosine is small."""
    rng = random.Random(5)
    often, rare = [f"o{k}" for k in range(60)], [f"r{k}" for k in range(400)]
    bench = [(0, " ".join(rng.sample(often, 14)))] + [(1 + i, " ".join(rare[40 * i : 40 * i + 40])) for i in range(10)]
    docs = [(i, " ".join(f"x{rng.randrange(9000)}" for _ in range(28)) + " " + " ".join(rng.sample(often, 4))) for i in range(400)]
    planted = [" ".join(rng.sample(rare, 40)) + f" {bench[0][1]} " + " ".join(rng.sample(rare, 40)) for _ in range(4)]
    docs += [(1000 + i, t) for i, t in enumerate(planted)]
    got = decontaminate.benchmark_matches(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    )
    assert {r.doc_id: {m.item_id for m in r.bench_matches} for r in got.collect() if r.bench_matches} == {1000 + i: {0} for i in range(4)}


def test_pipeline_fits_its_benchmark_stage_on_every_text(spark, tmp_path, monkeypatch):
    import corpus_pipeline

    rng = random.Random(9)
    bench = [(i, sentence(rng, 30, 500)) for i in range(5)]
    docs = [(i, sentence(rng, 30, 500), "s", "x", 0) for i in range(4400)]
    docs += [(5000 + i, docs[i][1], "s", "x", 0) for i in range(100)] + [(6000 + i, f"before {t} after", "s", "x", 0) for i, t in bench]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    seen = []
    fit = decontaminate._space
    monkeypatch.setattr(decontaminate, "_space", lambda passages, *a: seen.append(passages.count()) or fit(passages, *a))
    kept = corpus_pipeline.benchmark_filter(spark, spark.createDataFrame(docs, DOCS), str(tmp_path))
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {d[0] for d in docs if d[0] < 6000}
    # a text of 30 words is one passage
    assert seen == [len({d[1] for d in docs})]


def test_items_that_copies_make_common_are_found(spark):
    rng = random.Random(21)
    bench = [(i, sentence(rng, 36, 900)) for i in range(6)] + [(6, sentence(rng, 8, 900)), (7, sentence(rng, 70, 900))]
    copied = sentence(rng, 12, 900) + " " + bench[0][1] + " " + sentence(rng, 12, 900)
    rows = [(i, sentence(rng, 60, 900)) for i in range(200)]
    # a third of the rows are copies; one passage is shared by texts that differ; both also stand in texts of their own
    rows += [(1000 + i, copied) for i in range(150)]
    shared = [(2000 + i, f"{sentence(rng, 7 + i % 40, 900)} {bench[1][1]} {sentence(rng, 40, 900)}") for i in range(100)]
    rows += shared + [(3000, f"{sentence(rng, 300, 900)} {bench[0][1]} {sentence(rng, 300, 900)}")]
    rows += [(3001, f"{sentence(rng, 300, 900)} {bench[6][1]} {sentence(rng, 300, 900)}"), (3002, f"{sentence(rng, 45, 900)} {bench[7][1]}")]
    got = decontaminate.benchmark_matches(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    )
    want = {1000 + i: {0} for i in range(150)} | {i: {1} for i, _ in shared} | {3000: {0}, 3001: {6}, 3002: {7}}
    assert {r.doc_id: {m.item_id for m in r.bench_matches} for r in got.collect() if r.bench_matches} == want


def test_candidates_are_compared_by_vocabulary_words(monkeypatch):
    """Words outside the benchmark can't be on a common subsequence, so the check doesn't visit them."""
    rng = random.Random(41)
    item = [f"b{k}" for k in range(40)]
    body = decontaminate._hashes(" ".join(item))
    vocabulary = np.unique(body)
    place = np.searchsorted(vocabulary, body)
    segments = np.zeros((1, len(vocabulary)), dtype=np.float32)
    segments[0, place] = 1 / 40**0.5
    none = decontaminate.Faint(np.zeros(0, dtype=int), np.zeros(0, dtype=int), np.zeros((0, 0), dtype=np.float32), np.zeros(0, dtype=int))
    first, length = np.zeros(1, dtype=int), np.full(1, 40**0.5, dtype=np.float32)
    space = decontaminate.Space(np.eye(len(vocabulary), dtype=np.float32), segments, length, first, first, none)
    around = lambda n: " ".join(f"x{rng.randrange(9000)}" for _ in range(n))
    texts = [f"{around(n)} {' '.join(item)} {around(90)}" for n in (0, 20, 70, 200)] + ["", around(300), f"{around(50)} {' '.join(item[:20])} {around(50)}"]
    seen = []
    full = decontaminate.lcs
    monkeypatch.setattr(decontaminate, "lcs", lambda a, b: seen.append(len(b)) or full(a, b))
    (found,) = decontaminate._matcher([(space, [decontaminate.Item(3, body, 40)])], vocabulary, np.ones(len(vocabulary), dtype=bool), 0.5)(texts)
    assert [[(m["item_id"], m["coverage"]) for m in f] for f in found] == [[(3, 1.0)]] * 4 + [[]] * 3
    assert seen and max(seen) <= len(item)


def test_vocabulary_lookup_and_power_step_match_plain_versions():
    rng = np.random.default_rng(8)
    for n in (1, 2, 7, 3000):
        words = rng.integers(0, 2**64, n, dtype=np.uint64)
        # many with the same leading bits, and both ends of the range
        words = np.unique(np.concatenate([words, (words[: n // 2] >> np.uint64(40)) << np.uint64(40), words[:5] + np.arange(len(words[:5]), dtype=np.uint64)]))
        words = np.unique(np.concatenate([words, np.array([0, 2**64 - 1], dtype=np.uint64)])) if n > 2 else words
        asked = np.concatenate([words, rng.integers(0, 2**64, 500, dtype=np.uint64), words + np.uint64(1), np.array([0, 2**64 - 1], dtype=np.uint64)])
        of = {w: k for k, w in enumerate(words.tolist())}
        assert decontaminate._lookup(words).places(asked).tolist() == [of.get(w, -1) for w in asked.tolist()]
    # vocabularies on both sides of 2^16 words; texts of no, one and many pieces, some pieces without words
    for n in (50, 70_000):
        doc = np.repeat(np.arange(40), rng.integers(0, 6, 40))
        size = rng.integers(0, 9, len(doc))
        term = rng.integers(0, n, size.sum())
        weighted = rng.standard_normal((n, 3)).astype(np.float32)
        pieces = np.zeros((len(doc), n), dtype=np.float32)
        np.add.at(pieces, (np.repeat(np.arange(len(doc)), size), term), 1)
        a = np.array([x for d in range(40) for own in [pieces[doc == d]] for x in (own[:-1] + own[1:] if len(own) > 1 else own)])
        for block in (1, 3, 2048):
            state = np.zeros_like(weighted)
            decontaminate._spread(state, term, size, doc, weighted, block)
            assert np.allclose(state, a.T @ (a @ weighted), atol=1e-3)


def test_longest_common_subsequence():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = rng.integers(0, 6, rng.integers(1, 20)), rng.integers(0, 6, rng.integers(0, 25))
        t = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
        for i in range(len(a)):
            for j in range(len(b)):
                t[i + 1, j + 1] = t[i, j] + 1 if a[i] == b[j] else max(t[i, j + 1], t[i + 1, j])
        assert decontaminate.lcs(a, b).sum() == t[-1, -1] == decontaminate.lcs_length(a.tolist(), b.tolist())


def test_resampling_prefers_the_target(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(f"g{rng.randrange(30)}" for _ in range(50)) if i % 2 else " ".join(f"b{rng.randrange(30)}" for _ in range(50))) for i in range(200)]
    rows += [(500, None), (501, ""), (None, "g1 g2"), (1, rows[1][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    good = spark.createDataFrame([(i,) for i in range(1, 120, 2)], "doc_id long")
    got = quality.resample(docs, good, fraction=0.4).collect()
    assert len(got) == len(rows) and 82 <= sum(r.selected for r in got) <= 83
    assert sum(r.selected for r in got if r.doc_id is not None and r.doc_id % 2) >= 75
    assert quality.resample(docs.where("false"), good).count() == 0


def test_kth_largest_is_exact(spark):
    values = [1.0] * 50 + [1.0 + 1e-15] * 3 + [float(i) for i in range(100)] + [1e300]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 2, 50, 101, 120, len(values)):
        assert quality.kth_largest(df, "v", k, bins=8) == sorted(values, reverse=True)[k - 1]
