"""Repeated passages against brute force over all windows."""

import re
from collections import defaultdict

import numpy as np
import pytest

from bvengine.llm import substring_dedup as S

from .helpers import documents, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    words = [WORD.findall(t or "") for _, t in rows]
    ids = [float("inf") if i is None else i for i, _ in rows]
    first = defaultdict(lambda: float("inf"))
    for i, w in zip(ids, words, strict=True):
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first[key], i)
    out = []
    for (i, _), order, w in zip(rows, ids, words, strict=True):
        gone = {k + j for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < order for j in range(window)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def corpus():
    r = np.random.default_rng(5)
    common, line = prose(1, 40), prose(2, 13)
    rows = []
    for i in range(160):
        w = prose(100 + i, int(r.integers(5, 90)))
        if i % 3 == 0:  # a passage of a third of the rows, cut at different places
            a, b = sorted(r.integers(0, 41, 2))
            w[len(w) // 2 : len(w) // 2] = common[a:b]
        if i % 5 == 0:
            w += line
        if i % 7 == 0:  # a passage repeated inside one document only
            w += prose(900 + i, 20) * 3
        if i % 11 == 5:  # near copy
            w = rows[-3][1].split() + ["other"] if rows[-3][1] else w
        if i % 13 == 4:  # five shared words, then others: a chance anchor
            w += common[10:15] + prose(2000 + i, 10) + common[10:15]
        rows.append((i * 2, " ".join(w)))
    rows += [(11, None), (13, ""), (15, " \t\n"), (17, " ".join(line)), (19, " ".join(line[:12])), (21, " ".join(line) + " " + "\n\n".join(line))]
    rows += [(4, " ".join(common)), (4, " ".join(common)), (4, " ".join(prose(77, 60))), (None, " ".join(common)), (None, " ".join(prose(78, 40)))]
    rows += [(500, " ".join(prose(78, 40))), (501, " ".join(common * 8)), (502, " ".join(["x"] * 60)), (503, " ".join(["x"] * 200))]
    return rows


@pytest.mark.parametrize(("window", "gram", "dealt", "rows"), [(13, 5, 1 << 18, 8), (13, 5, 64, 2), (4, 2, 100, 3), (5, 5, 1 << 18, 1)])
def test_against_brute_force(spark, monkeypatch, window, gram, dealt, rows):
    monkeypatch.setattr(S, "ROWS", rows)
    data = corpus()
    got = S.remove_repeats(documents(spark, data).repartition(3), window, gram, dealt).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in got], key=str) == brute(data, window)
    for r in got:
        assert sum(b - a for a, b in r.spans) == r.n_removed
        assert all(x[1] < y[0] for x, y in zip(r.spans, r.spans[1:]))


def test_long_text(spark):
    long = prose(3, 60_000)
    data = [(1, " ".join(long[:30_000])), (2, " ".join(long)), (3, " ".join(long[:200] + ["cut"] + long[200:20_000] + ["cut"] + long[40_000:])), (4, "a " * 50_000), (5, "a " * 50_001)]
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in S.remove_repeats(documents(spark, data)).collect())
    assert got == brute(data, 13)


def test_empty(spark):
    assert S.remove_repeats(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        S.remove_repeats(documents(spark, []), window=4, gram=5)


def test_longest_match_is_the_longest():
    r = np.random.default_rng(8)
    ref = S.Reference([r.integers(0, 3, 60), r.integers(0, 3, 40)], 4)
    text = ref.code(r.integers(0, 4, 50))
    data = text.astype(">u4").tobytes()
    for at in range(50):
        want = max(next((k for k in range(50 - at) if s + k >= len(ref.codes) or ref.codes[s + k] != text[at + k]), 50 - at) for s in range(len(ref.codes)))
        assert ref.longest(data, text, at) == want
