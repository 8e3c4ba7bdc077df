import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from hazecast.llm.byte_bpe import PerfectHash, Vocabulary, decode, digests, encode, encoded_documents, encoder


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.read(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


@given(st.lists(st.binary(min_size=1, max_size=12), unique=True, min_size=1, max_size=400))
@settings(deadline=None, max_examples=60)
def test_every_key_has_a_slot_of_its_own(keys):
    lookup, slots = PerfectHash.build(keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))
    assert lookup.slots(keys).tolist() == slots.tolist()
    assert set(lookup.slots([b"other", b""]).tolist()) <= set(range(len(keys)))


# blanks of all kinds beside letters, digits and signs
texts = st.one_of(st.text(max_size=300), st.text(alphabet="ab é1.,'s\n\t\x00\x1c\xa0\u2003\u3000", max_size=80))


@given(texts)
@settings(deadline=None, max_examples=200)
def test_ids_are_those_of_the_library(vocabulary, reference, text):
    ids = np.frombuffer(encoder(vocabulary)([text])[0], "<u4").tolist()
    assert ids == reference.encode_ordinary(text)
    assert b"".join(vocabulary.tokens[i] for i in ids).decode() == text


def test_long_pretokens_and_a_full_memo(vocabulary, reference):
    run = encoder(vocabulary, memo=3)
    texts = ["ab" * 20_000, "x" * 5000 + " " * 3000, "<|endoftext|> it's", "one two three four five"]
    for text in texts * 2:
        assert np.frombuffer(run([text])[0], "<u4").tolist() == reference.encode_ordinary(text)


def test_query_columns_against_the_library(spark, odd, odd_rows, vocabulary, reference):
    got = sorted(map(tuple, digests(odd, vocabulary).collect()), key=str)
    want = []
    for row in odd_rows:
        ids = reference.encode_ordinary(row[1] or "")
        packed = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        want.append((row[0], len(ids), packed, hashlib.sha256((row[1] or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_columns_stay_and_round_trip(odd, none, vocabulary):
    out = encoded_documents(odd, vocabulary)
    assert out.columns == [*odd.columns, "ids", "n_tokens", "round_trip"]
    assert out.where("not round_trip").count() == 0 and out.count() == odd.count()
    assert digests(none, vocabulary).count() == 0
    assert "decoded" in decode(encode(none, vocabulary), vocabulary).columns


def test_null_ids_decode_to_null(spark, vocabulary):
    df = spark.createDataFrame([(None,), (b"",)], "ids binary")
    assert [r.decoded for r in decode(df, vocabulary).collect()] == [None, b""]
