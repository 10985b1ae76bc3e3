import hashlib
import struct

import public_tokenizers
import pytest

from bvengine.llm import bpe
from llm.helpers import documents, prose

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def whole(text):
    ids = bpe.encoder(RANKS).encode_ordinary(text or "")
    return len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


TEXTS = [
    None, "", "a", " ", "\n\n  \n", "don't we'll they've 's", "naïve café übergroß " * 9, "x" * 500, " " * 300 + "end", "end" + " " * 300,
    "12345 " * 60, "中文字符没有空格" * 40, "a,b;c" * 70, "<|endoftext|> not special", "🙂🙃" * 50, "ab \t\r\n  cd" * 30, "tail'", "we'" + "r" * 90,
    " ".join(prose(1, 400)), ("word" * 30 + " ") * 12, " x y " * 40, "\x1c\x1d a \x85b" * 25,
]


@pytest.mark.parametrize(("chunk", "overlap"), [(16, 4), (32, 8), (64, 32), (97, 13), (1 << 16, 1 << 10)])
def test_chunks_give_the_ids_of_the_whole_text(spark, chunk, overlap):
    docs = documents(spark, list(enumerate(TEXTS))).repartition(3)
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.encode_documents(docs, RANKS, chunk, overlap).collect()}
    assert got == {i: whole(t) for i, t in enumerate(TEXTS)}


def test_edges(spark):
    docs = documents(spark, [(None, "one two"), (None, None), (1 << 60, "big id"), (3, "same"), (3, "same")])
    got = bpe.encode_documents(docs, RANKS)
    assert got.schema["doc_id"].dataType.simpleString() == "bigint"
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"]) for r in got.collect()) == [
        (False, 3, 1), (False, 3, 1), (False, 1 << 60, 2), (True, 0, 0), (True, 0, 2),
    ]
    assert bpe.encode_documents(docs.limit(0), RANKS).count() == 0
    with pytest.raises(ValueError):
        bpe.encode_documents(docs, RANKS, 8, 9)


SPACES = [" ", "\n", " \n", "\t", "\xa0", "\u2003\n", "\r\n"]
AROUND = [("", ""), ("a", "b"), ("", "'s 12"), ("don't ", "!"), ("\x1c", "\x1d"), ("a", "\x1cb")]


@pytest.mark.parametrize("space", SPACES)
def test_cut_runs_give_the_ids_of_the_whole_text(space, monkeypatch):
    import re

    monkeypatch.setattr(bpe, "LONG_SPACE", 6)
    monkeypatch.setattr(bpe, "LONG_RUN", re.compile(bpe.LONG_RUN.pattern.replace("100000", "6")))
    for n in range(3, 12):
        for a, b in AROUND:
            text = (a + space * n + b) * 3
            assert bpe.encode(RANKS, text) == struct.pack(f"<{len(bpe.encoder(RANKS).encode_ordinary(text))}I", *bpe.encoder(RANKS).encode_ordinary(text))


def test_runs_beyond_the_matcher(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [" " * 2_000_000, "a" + "\n" * 2_000_000 + "b", "word " * 9 + " \n" * 1_000_000 + "end", "x" * 1_200_000]
    got = {r["doc_id"]: r for r in bpe.encode_documents(documents(spark, list(enumerate(texts))), RANKS).collect()}
    for i, text in enumerate(texts):
        ids = t.encode(text, add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(ids) and got[i]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
