"""Alignments against byte-by-byte ownership of the tokens."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from bvengine.llm import token_alignment as A

from .helpers import documents, prose

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_tokens(text):
    """(ids, bytes of each) of both tokenizers, straight from the libraries."""
    t = Tokenizer.from_file(PATH_A)
    t.encode_special_tokens = True
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(b): b for b in printable}
    chars |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}
    a = t.encode(" " + text, add_special_tokens=False).ids
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH_B)
    b = sp.encode(text)
    bytes_b = []
    for i in b:
        p = sp.id_to_piece(i)
        bytes_b.append(bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode())
    return a, [bytes(chars[c] for c in t.id_to_token(i)) for i in a], b, bytes_b


def brute(rows):
    per = []
    for doc_id, text in rows:
        a, xa, b, xb = byte_tokens(text) if text else ([], [], [], [])
        whole = (" " + (text or "")).encode()
        if not text or b"".join(xa) != whole or b"".join(xb) != whole:
            per.append((doc_id, 0, 0, 0, Counter(), ""))
            continue
        own_a = [k for k, x in enumerate(xa) for _ in x]
        own_b = [k for k, x in enumerate(xb) for _ in x]
        links = Counter((a[i], b[j]) for i, j in set(zip(own_a, own_b, strict=True)))
        groups, at = [], 0
        for k in range(len(whole)):
            if k + 1 == len(whole) or own_a[k] != own_a[k + 1] and own_b[k] != own_b[k + 1]:
                ga, gb = sorted(set(own_a[at : k + 1])), sorted(set(own_b[at : k + 1]))
                groups.append(",".join(str(a[i]) for i in ga) + "|" + ",".join(str(b[i]) for i in gb))
                at = k + 1
        per.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    counts = Counter(pair for x in per for pair in x[4])
    top = defaultdict(int)
    for (a, _), n in counts.items():
        top[a] = max(top[a], n)
    return sorted(
        ((i, na, nb, ng, sum(l.values()), sum(n for p, n in l.items() if counts[p] == top[p[0]]), sum(n * counts[p] for p, n in l.items()), d) for i, na, nb, ng, l, d in per),
        key=str,
    )


TEXTS = [
    "Plain words, and some more of them.", "  two blanks", "tabs\tand\nlines\r\n\n", "naïve café — “quotes” 漢字 🙂🙂", "▁ a block", "a b　c ", "<|endoftext|> and <s> </s> <unk> <0x41>",
    "x" * 500, " " * 40, "\n" * 30, "1234567890 " * 20, "word " * 300, "é ​ zero", "\x01\x02 \x7f", "ﬁ ligature ½", "a", " ", "ÿĀ", "\U0010ffff퟿",
]


def columns(rows):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows), key=str)


@pytest.mark.parametrize("block", [1, 2000, 4 << 20])
def test_against_brute_force(spark, block):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, " ".join(prose(i, 30))) for i in range(20)]
    rows += [(3, None), (3, ""), (None, TEXTS[0]), (None, TEXTS[0]), (100, " ".join(prose(1, 400)))]
    got = columns(A.report(documents(spark, rows).repartition(3), PATH_A, PATH_B, block).collect())
    assert got == brute(rows)


def test_long_text(spark):
    rows = [(1, " ".join(prose(1, 40_000))), (2, "a" * 5_000 + "\n" * 120_000 + "b")]
    got = columns(A.report(documents(spark, rows), PATH_A, PATH_B).collect())
    assert got == brute(rows)


def test_alignments_give_the_groups_back(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(90, None), (91, "")]
    for r in A.alignments(documents(spark, rows), PATH_A, PATH_B).collect():
        a, b = A.bytes_a(PATH_A)[0], A.bytes_b(PATH_B)[0]
        at = (0, 0)
        for end in zip(r.end_a, r.end_b, strict=True):
            assert b"".join(a[i] for i in r.ids_a[at[0] : end[0]]) == b"".join(b[i] for i in r.ids_b[at[1] : end[1]])
            at = end
        assert at == (len(r.ids_a), len(r.ids_b))


def test_empty(spark):
    assert A.report(documents(spark, []), PATH_A, PATH_B).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(1, 400), min_size=1), st.sets(st.integers(1, 400), min_size=1))
def test_gallop(a, b):
    a, b = np.array(sorted(a)), np.array(sorted(b))
    assert A.gallop(a, b).tolist() == np.searchsorted(b, a).tolist()
