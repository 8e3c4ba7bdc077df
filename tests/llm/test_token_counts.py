import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from hazecast.llm import token_counts as module
from hazecast.llm.token_counts import Tokenizer, fill, stored_counts, token_counts
from hazecast.session import new_folder


def expected(name, text):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        return len(sentencepiece.SentencePieceProcessor(model_file=path).encode(text))
    return len(tokenizers.Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_are_those_of_the_library(spark, odd, odd_rows, name):
    got = token_counts(odd, Tokenizer(public_tokenizers.path(name)), new_folder(spark, "counts"), limit=100)
    want = []
    for row in odd_rows:
        n = expected(name, row[1] or "")
        want.append((row[0], len((row[1] or "").encode()), n, n > 100))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_only_missing_texts_are_encoded_and_appended(spark):
    tokenizer, cache = Tokenizer(public_tokenizers.path("byte_bpe_50k.json")), new_folder(spark, "counts")
    first = spark.createDataFrame([(1, "one"), (2, "two"), (3, "one"), (4, None)], "doc_id long, text string")
    assert {r.doc_id: r.n_tokens for r in token_counts(first, tokenizer, cache).collect()} == {1: 1, 2: 1, 3: 1, 4: 0}
    assert stored_counts(spark, cache, tokenizer).count() == 3
    # a false count shows that the cache is believed
    known = stored_counts(spark, cache, tokenizer).selectExpr("digest", "n_tokens + 90 AS n_tokens")
    other = new_folder(spark, "counts")
    from pyspark.sql import functions as F

    known.select(F.lit(tokenizer.digest).alias("tokenizer"), "digest", "n_tokens").write.parquet(other)
    second = spark.createDataFrame([(1, "one"), (9, "a new text <|endoftext|>")], "doc_id long, text string")
    assert {r.doc_id: r.n_tokens for r in token_counts(second, tokenizer, other).collect()} == {1: 91, 9: expected("byte_bpe_50k.json", "a new text <|endoftext|>")}
    assert spark.read.parquet(other).count() == 4


def test_versions_have_their_own_counts(spark):
    cache = new_folder(spark, "counts")
    docs = spark.createDataFrame([(1, "Überall words")], "doc_id long, text string")
    for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"):
        (row,) = token_counts(docs, Tokenizer(public_tokenizers.path(name)), cache).collect()
        assert row.n_tokens == expected(name, "Überall words")
    assert spark.read.parquet(cache).count() == 2


def test_an_empty_table(spark, none):
    assert token_counts(none, Tokenizer(public_tokenizers.path("byte_bpe_50k.json")), new_folder(spark, "counts")).count() == 0


@pytest.fixture(scope="module")
def counter():
    tokenizer = Tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    assert tokenizer.apart() and not Tokenizer(public_tokenizers.path("word_bpe_49k.json")).apart()
    return tokenizer.counter(), tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


pieces = ["<|endoftext|>", " ", "  ", "\n", "word", "Don't", ".", "é,", "1", "\xa0", "\u2003", "\x1c", "\x00", "\u3000", "!?", "<|", "x;"]
texts = st.lists(st.sampled_from(pieces), max_size=20).map("".join)


@given(st.lists(st.one_of(texts, st.text(max_size=60)), min_size=1, max_size=5))
@settings(deadline=None, max_examples=300)
def test_counts_by_units(counter, some):
    count, library = counter
    assert count(pa.array(some)).tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in some]


def test_a_full_memo_and_a_long_text(counter, monkeypatch):
    monkeypatch.setattr(module, "MEMO", 3)
    _, library = counter
    count = Tokenizer(public_tokenizers.path("byte_bpe_50k.json")).counter()
    some = ["one two three four", "ab" * 50_000 + " " * 9000, " ".join(f"word{i % 999}," for i in range(60_000))]
    for text in some * 2:
        assert count(pa.array([text])).tolist() == [len(library.encode(text, add_special_tokens=False).ids)]


def test_a_second_run_finds_what_the_first_stored(spark, odd, odd_rows):
    tokenizer, cache = Tokenizer(public_tokenizers.path("byte_bpe_50k.json")), new_folder(spark, "counts")
    fill(odd.where("doc_id % 3 = 0"), tokenizer, cache)
    before = {bytes(r.digest) for r in spark.read.parquet(cache).collect()}
    assert token_counts(odd, tokenizer, cache).count() == len(odd_rows)
    after = [bytes(r.digest) for r in spark.read.parquet(cache).collect()]
    assert before < set(after) and len(after) == len(set(after)) == len({r[1] or "" for r in odd_rows})
