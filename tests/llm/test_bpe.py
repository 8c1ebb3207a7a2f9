from __future__ import annotations

import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import bpe

ALPHABET = "ab 'stré\n\t<|endoftext|>😀日本語١٢3　\x00\x85\x1c²½_"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.vocabulary())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(ALPHABET, max_size=20), st.just("<|endoftext|>"), st.text(max_size=20))).map("".join))
def test_same_as_library(text):
    library = Tokenizer.from_file(bpe.vocabulary()) if not hasattr(test_same_as_library, "t") else test_same_as_library.t
    test_same_as_library.t = library
    c = bpe.codec(bpe.vocabulary())
    want = library.encode(text, add_special_tokens=False).ids
    assert c.encode(text) == want
    assert c.decode(want) == library.decode(want, skip_special_tokens=False) == text


@pytest.mark.parametrize("word", ["a" * 5000, "ab" * 700, "é" * 600, "thereisaword" * 90])
def test_long_words(library, word):
    assert bpe.codec(bpe.vocabulary()).encode(word) == library.encode(word, add_special_tokens=False).ids


def test_table(spark, library):
    rows = [(1, "The cat<|endoftext|> sat.", "x"), (2, None, "x"), (3, "", "x"), (3, "dup", "y"), (4, "x" * 50_000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = {(r.doc_id, r.n_tokens): r for r in bpe.encode_documents(df).collect()}
    for doc_id, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        r = out[doc_id, len(ids)]
        assert r.ids == ids and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.encode_documents(df.limit(0)).count() == 0


@pytest.mark.parametrize("part, value", [("normalizer", {"type": "Lowercase"}), ("pre_tokenizer", {"type": "ByteLevel", "add_prefix_space": True, "use_regex": True}), ("pre_tokenizer", {"type": "Whitespace"}), ("added_tokens", [{"id": 0, "content": "x", "lstrip": True}])])
def test_other_files_are_refused(tmp_path, part, value):
    with open(bpe.vocabulary(), encoding="utf-8") as f:
        spec = json.load(f)
    bpe.unsupported(spec)
    (tmp_path / "v.json").write_text(json.dumps(spec | {part: value}))
    with pytest.raises(ValueError, match=part):
        bpe.BytePairCodec(str(tmp_path / "v.json"))
    spec["model"]["ignore_merges"] = True
    with pytest.raises(ValueError, match="model"):
        bpe.unsupported(spec)
