from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tableloom.llm import bpe
from llm.conftest import ODD_TEXTS

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.load_vocabulary(PATH))


def test_random_texts_as_the_library(library, codec):
    r = random.Random(1)
    letters = ["abcdefghij", "aaab", "the in on er", "éèñ漢字 🙂", "  \n\t　", "0123456789", "'s't <|endoftext|>", "\x1c\x85\xa0²½"]
    for i in range(4000):
        text = "".join(r.choice(r.choice(letters)) for _ in range(r.randint(0, 60))) + "<|endoftext|>" * (i % 50 == 0)
        ids = np.frombuffer(codec.encode(text), "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert codec.decode(codec.encode(text)) == library.decode(ids, skip_special_tokens=False) == text


def test_splits_as_the_library_for_all_sorts_of_characters(library, codec):
    for c in [*range(0x3000), *range(0x3000, 0x110000, 97)]:
        if 0xD800 <= c < 0xE000:
            continue
        text = f"a{chr(c)}b1{chr(c)}2 {chr(c)}"
        pieces = [p for part, _ in codec.parts(text) for p in part]
        assert pieces == [text[slice(*span)] for _, span in library.pre_tokenizer.pre_tokenize_str(text)], hex(c)


def test_long_runs_stay_linear(codec, library):
    for text in ("a" * 60_000, "ab" * 30_000, " " * 20_000):
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_odd_rows_and_an_empty_table(documents, library):
    rows = bpe.encode_decode(documents(ODD_TEXTS), PATH).select("row.doc_id", "row.text", "row.score", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert len(rows) == len(ODD_TEXTS)
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256, r.score) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), 7)
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert bpe.encode_decode(documents([]), PATH).count() == 0
