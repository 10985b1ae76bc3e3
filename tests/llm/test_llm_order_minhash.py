import random
from functools import lru_cache

import numpy as np
import pandas as pd
import pytest

from bvengine.llm import order_minhash as O
from llm.helpers import documents, prose


def words(text):
    return O.WORD.findall((text or "").lower())


def labelled(ws, k=O.K):
    grams = [tuple(ws[i : i + k]) for i in range(max(1, len(ws) - k + 1))] if ws else []
    seen, out = {}, []
    for g in grams:
        out.append((g, seen.get(g, 0)))
        seen[g] = seen.get(g, 0) + 1
    return out


def similarity(a, b):
    """By the plain table of longest common subsequences."""
    x, y = labelled(words(a)), labelled(words(b))
    if not x or not y:
        return 0.0
    row = [0] * (len(y) + 1)
    for g in x:
        last, new = 0, [0]
        for j, h in enumerate(y, 1):
            new.append(row[j - 1] + 1 if g == h else max(row[j], new[-1]))
        row = new
    return row[-1] / (len(x) + len(y) - row[-1])


def groups(rows, t=O.THRESHOLD):
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sim = lru_cache(None)(similarity)
    for i in range(len(rows)):
        for j in range(i):
            a, b = rows[i][1], rows[j][1]
            if words(a) and words(b) and (words(a) == words(b) or abs(len(a) - len(b)) < 0.4 * len(a) and sim(a, b) >= t):
                parent[find(i)] = find(j)
    out = {}
    for i in range(len(rows)):
        out.setdefault(find(i), []).append(rows[i][0])
    return sorted((sorted(map(str, g)) for g in out.values()))


def edited(text, n, seed):
    r, ws = random.Random(seed), text.split()
    for _ in range(n):
        i, what = r.randrange(len(ws)), r.random()
        if what < 0.5:
            ws[i] = "edit" + str(r.randrange(99))
        elif what < 0.75 and len(ws) > 8:
            del ws[i]
        else:
            ws.insert(i, "new" + str(r.randrange(99)))
    return " ".join(ws)


def corpus():
    rows, i = [], 0
    passage = " ".join(prose(777, 60))
    for d in range(45):
        text = " ".join(prose(d, 40 + 5 * d))
        for k in range(d % 4):
            rows.append((i, edited(text, k * (1 + len(text.split()) // 120), d * 9 + k)))
            i += 1
    rows += [(1000 + k, " ".join(prose(5000 + k, 90)) + " " + passage) for k in range(25)]  # a shared passage is no copy
    hot = " ".join(prose(42, 100))
    rows += [(2000 + k, edited(hot, 1, k)) for k in range(40)]
    rows += [(3000, None), (3001, ""), (3002, "!!!"), (3003, "one"), (3004, "One!"), (3005, "a b c d e"), (3006, "a b c d e f"), (3007, "same " * 50), (3008, "same " * 49), (3009, "same " * 20)]
    return rows


def test_groups_against_brute_force(spark):
    rows = corpus()
    got = O.classes(documents(spark, rows).repartition(4)).collect()
    assert len(got) == len(rows)
    found = {}
    for r in got:
        found.setdefault(r["class_id"], []).append(str(r["doc_id"]))
        assert r["kept"] == (r["doc_id"] == r["class_id"])
    assert sorted(map(sorted, found.values())) == groups(rows)
    assert all(r["class_size"] == len(found[r["class_id"]]) for r in got)
    assert all(min(map(int, g)) == c for c, g in found.items())


@pytest.mark.parametrize("seed", range(40))
def test_alignment_against_the_plain_table(seed):
    r = random.Random(seed)
    a = " ".join(prose(seed, r.choice([3, 5, 9, 40, 200])))
    b = edited(a, r.randrange(6), seed)
    if r.random() < 0.3:
        ws = b.split()
        b = " ".join(ws[len(ws) // 2 :] + ws[: len(ws) // 2])
    table = O.Words()
    x, y = (O.kmers(O.words_of(t, table)) for t in (a, b))
    assert len(set(x.tolist())) == len(x)
    want, got = similarity(a, b), O.aligned(x, y)
    assert got == pytest.approx(want) if want >= O.THRESHOLD else got < O.THRESHOLD
    assert O.aligned(x, y) == O.aligned(y, x)


@pytest.mark.parametrize("seed", range(30))
def test_the_bound_excludes_no_link(seed):
    r = random.Random(seed)
    texts = [" ".join(prose(s, r.choice([6, 30, 150, 700]))) for s in range(3)]
    texts += [edited(t, r.randrange(9), k) for k in range(8) for t in texts]
    table = O.Words()
    h = [O.kmers(O.words_of(t, table)) for t in texts]
    group = pd.DataFrame({"class": range(len(h)), "part": range(len(h)), "n": map(len, h), "bins": [O.bins(x).tobytes() for x in h]})
    both = pd.concat([group.assign(left=True), group.assign(left=False)])
    got = set(map(tuple, O.open_pairs(O.THRESHOLD)(both).itertuples(index=False)))
    want = {(i, j) for j in range(len(h)) for i in range(j) if O.aligned(h[i], h[j]) >= O.THRESHOLD}
    assert want <= got and len(got) < 0.8 * len(h) * (len(h) - 1) / 2
    assert (O.folded(O.bins(h[0]), 16) == np.bitwise_xor.reduce(O.bins(h[0]).reshape(-1, 16))).all()


def test_sketch_sees_order_and_repetition():
    table = O.Words()
    a = O.kmers(O.words_of(" ".join(prose(1, 300)), table))
    assert (O.sketch(a) == O.sketch(a.copy())).all() and len(O.sketch(a)) == O.BANDS
    half = np.concatenate([a[150:], a[:150]])  # the same k-mers in another order
    assert (O.sketch(a) == O.sketch(half)).sum() < 4
    hits = [(O.sketch(a) == O.sketch(O.kmers(O.words_of(edited(" ".join(prose(1, 300)), 3, s), table)))).any() for s in range(50)]
    assert all(hits)


def test_bands_find_near_copies_without_the_exact_search():
    """Measured recall of the bands alone on pairs above 60 k-mers, by the similarity of the plain table."""
    found = {True: 0, False: 0}
    for seed in range(400):
        a = " ".join(prose(seed, 80 + seed % 120))
        b = edited(a, 1 + seed % 5, seed)
        if min(len(labelled(words(a))), len(labelled(words(b)))) <= 60 or similarity(a, b) < O.THRESHOLD:
            continue
        table = O.Words()
        keys = [set(O.sketch(O.kmers(O.words_of(x, table))).tolist()) for x in (a, b)]
        found[bool(keys[0] & keys[1])] += 1
    assert found[True] > 150 and found[True] / sum(found.values()) >= 0.98, found


def test_every_text_with_words_has_band_keys(spark):
    docs = documents(spark, [(i, " ".join(prose(i, n))) for i, n in enumerate((1, 4, 5, 12, 60, 300))] + [(9, None), (10, "")])
    got = {r["doc_id"]: r["keys"] for r in O.sequences(docs, O.BANDS, O.PICKS).collect()}
    assert all(len(got[i]) == O.BANDS for i in range(6)) and got[9] is None and got[10] is None


def test_edges(spark):
    docs = documents(spark, [(None, "a b c d e f g"), (4, "a b c d e f g"), (4, "a b c d e f g"), (None, "z"), (None, None)])
    got = sorted((str(r["doc_id"]), str(r["class_id"]), r["class_size"], r["kept"]) for r in O.classes(docs).collect())
    assert got == [("4", "4", 3, True)] * 2 + [("None", "4", 3, False), ("None", "None", 1, True), ("None", "None", 1, True)]
    assert O.classes(docs.limit(0)).count() == 0
    kept = O.keep_first(documents(spark, corpus()[:40]))
    assert kept.columns == documents(spark, []).columns
    long = " ".join(prose(9, 40_000))
    pair = O.classes(documents(spark, [(1, long), (2, edited(long, 40, 1))])).collect()
    assert {r["class_id"] for r in pair} == {1}


def short_texts():
    """Texts of 5 to 40 words, each with copies of one or two edits, and one line that most of them share."""
    rows, line = [], " ".join(prose(31, 9))
    for d in range(150):
        text = " ".join(prose(9000 + d, 5 + d % 36)) + (" " + line if d % 3 == 0 else "")
        ws = text.split()
        copies = [text, text + " more", " ".join(ws[:-1] + ["other"]), "first " + text, edited(text, 1, d), edited(text, 2, d)]
        rows += [(10 * d + k, t) for k, t in enumerate(copies)]
    return rows


def test_short_texts_against_brute_force(spark):
    rows = short_texts()
    found = {}
    for r in O.classes(documents(spark, rows).repartition(4)).collect():
        found.setdefault(r["class_id"], []).append(str(r["doc_id"]))
    assert sorted(map(sorted, found.values())) == groups(rows)


@pytest.mark.parametrize("common", [False, True])
def test_every_short_pair_shares_a_prefix_key(common):
    table = O.Words()
    h = [O.kmers(O.words_of(t, table)) for _, t in short_texts()]
    grams, counts = np.unique(np.concatenate(h), return_counts=True) if common else (np.empty(0, np.uint64), np.empty(0, np.int64))
    keys = [set(O.prefix(x, grams, counts).tolist()) for x in h]
    linked = [(i, j) for i in range(len(h)) for j in range(i) if O.aligned(h[i], h[j]) >= O.THRESHOLD]
    assert len(linked) > 150 and all(keys[i] & keys[j] for i, j in linked)
    for n in range(1, O.SHORT + 1):  # the least overlap that can do, with the longest partner
        for m in range(n, int(n / O.THRESHOLD + 1e-9) + 1):
            least = int(np.ceil(O.THRESHOLD * (n + m) / (1 + O.THRESHOLD) - 1e-9))
            take = [x - int(np.ceil(O.THRESHOLD * x - 1e-9)) + 1 for x in (n, m)]
            assert take[0] >= n - least + 1 and take[1] >= m - least + 1
