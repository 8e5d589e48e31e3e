import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wakeline.llm.bpe import bpe_encode, bpe_round_trip, codec
from wakeline.llm.queries import op4_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def same(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    got = codec(PATH).encode(text)
    assert got.tolist() == ids
    assert codec(PATH).decode(got).decode() == library.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(library, text):
    same(library, text)


def test_hard_texts(library):
    rng = random.Random(6)
    letters = "abcdefg ABİC'sSt're123  \x1c\x85 <>|/w ÀÉéßÜñ日本Σςσİıá éſKﬁ​　\n\t!!...—“”😀👍🏽ักکि٠½²Ⅷ"
    for _ in range(500):
        same(library, "".join(rng.choice(letters) for _ in range(rng.randint(0, 50))))
    marks = "aAbSs'’.,!_-1é\u0301ÉİıΣσ|$<> l"
    for _ in range(3000):
        same(library, "".join(rng.choice(marks) for _ in range(rng.randint(1, 12))))
    for text in ("a" * 3000, "ab" * 900, "hello <|endoftext|> world<|startoftext|>x", "'S'T don't we'LL", "", "the of and " * 200, "lololololol" * 30):
        same(library, text)


def test_tables(spark, odd, none):
    rows = bpe_round_trip(odd, PATH).collect()
    assert len(rows) == odd.count()
    assert [len(r.ids) for r in rows if r.doc_id in (2, 3, 4)] == [0, 0, 0]
    assert {r.decoded for r in rows if r.doc_id == 8} == {"one</w>"}
    assert bpe_encode(none, PATH).count() == 0


def test_digests(spark, library, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    for r in op4_bpe(spark, sf).collect():
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
