"""Alignments without a Python object per token: ids as arrays, bytes compared and groups written in stretches."""

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bvengine.llm import token_alignment as A

from .helpers import prose

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["<|endoftext|> x", "\0\U0010ffff\0 is plain text", "a\tb", "two  blanks ", "naïve 漢字 🙂", "\n" * 50, "x" * 300]


@pytest.mark.parametrize("text", [*ODD, " ".join(prose(5, 30_000))])
def test_ids_and_ends(text):
    ids_a, ids_b, ends_a, ends_b = A.encode(PATH_A, PATH_B, text)
    assert ids_a.tolist() == A.plain_tokenizer(PATH_A).encode(" " + text, add_special_tokens=False).ids
    assert ids_b.tolist() == A.pieces(PATH_B).encode(text)
    for ids, ends, table in ((ids_a, ends_a, A.bytes_a(PATH_A)), (ids_b, ends_b, A.bytes_b(PATH_B))):
        assert b"".join(table[0][i] for i in ids) == (" " + text).encode()
        assert ends.tolist() == np.cumsum(table[1][ids]).tolist()


def test_every_byte_is_compared(monkeypatch):
    monkeypatch.setattr(A, "STRETCH", 3)
    text = "some words, and more of them — 漢字 to the last byte"
    ids = np.array(A.pieces(PATH_B).encode(text))
    whole = np.frombuffer((" " + text).encode(), np.uint8)
    assert A.ends_in(whole, ids, A.bytes_b, PATH_B)[-1] == len(whole)
    assert A.ends_in(whole[:-1], ids, A.bytes_b, PATH_B) is None and A.ends_in(whole, ids[:-1], A.bytes_b, PATH_B) is None
    assert A.ends_in(whole, ids[:0], A.bytes_b, PATH_B) is None
    for k in range(len(whole)):
        other = whole.copy()
        other[k] ^= 1
        assert A.ends_in(other, ids, A.bytes_b, PATH_B) is None


def test_texts_not_given_back_have_no_tokens():
    assert A.encode(PATH_A, PATH_B, "▁ a block") is None
    assert A.encode(PATH_A, PATH_B, None) is None and A.encode(PATH_A, PATH_B, "") is None


ids = st.lists(st.integers(0, 200_000), min_size=1, max_size=4)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(ids, ids), min_size=1, max_size=8))
def test_groups_as_written(groups):
    a, b = (np.array([i for g in groups for i in g[side]]) for side in (0, 1))
    ends_a, ends_b = (np.cumsum([len(g[side]) for g in groups]) for side in (0, 1))
    want = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
    assert A.groups_text(a, b, ends_a, ends_b) == want.encode()
