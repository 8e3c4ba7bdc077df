"""Token counts through a cache of digests.

The cache is a Parquet table (tokenizer, digest, n_tokens). Documents are joined to it by the
digest of their text and that of the tokenizer's version; only distinct texts that it lacks are
encoded, and their counts are appended. A text is a cache key as the library gets it: these
tokenizers' own normalisers run inside the library, so nothing is folded before the digest.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazecast.llm.common import slices, text_digest, units
from hazecast.session import stored

SCHEMA = "tokenizer binary, digest binary, n_tokens long"


class Tokenizer:
    """A tokenizer file; its content and its library's version make up its digest."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            self.model = file.read()
        self.pieces = path.endswith(".model")
        if self.pieces:
            import sentencepiece as library
        else:
            import tokenizers as library
        self.digest = hashlib.sha256(f"{library.__name__} {library.__version__} ".encode() + self.model).digest()[:16]

    def apart(self) -> bool:
        """Whether the tokenizer splits before a space between other characters whatever stands around it:
        the byte-level pattern does, if nothing is normalised and no added token holds a blank or a mark."""
        if self.pieces:
            return False
        made = json.loads(self.model)
        split, added = made["pre_tokenizer"] or {}, made["added_tokens"]
        plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        return bool(plain) and made["normalizer"] is None and not any(
            t["lstrip"] or t["rstrip"] or t["single_word"] or not t["content"].isascii() or set(t["content"]) & set(BLANKS + MARKS) for t in added
        )

    def counter(self):
        """Function from an array of texts to their numbers of tokens, without added special tokens."""
        if self.pieces:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_proto=self.model)
            return lambda texts: np.array([len(ids) for ids in model.encode(texts.to_pylist(), num_threads=1)], np.int64)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import tokenizers

        model = tokenizers.Tokenizer.from_buffer(self.model)
        model.no_truncation()
        model.no_padding()

        def encoded(texts: list[str]) -> list[int]:
            return [len(e) for e in model.encode_batch_fast(texts, add_special_tokens=False)]

        return _by_units(encoded) if self.apart() else lambda texts: np.array(encoded(texts.to_pylist()), np.int64)


BLANKS = " \t\n\x0b\x0c\r"
MARKS = ".,;:!?"
MARKED = frozenset(MARKS)
MEMO = 400_000  # units a task remembers before it starts anew


def _by_units(encoded):
    """Counts of texts as sums over their units; the library gets every unit that isn't remembered once."""
    known: dict[str, int] = {}

    def count(texts: pa.Array) -> np.ndarray:
        if len(known) > MEMO:
            known.clear()
        names, at, offsets = units(texts)
        unknown = [u for u in names if u not in known]
        # a mark behind a letter is split off as well, so that a word with one is no new word
        marked = {u: u[:-1] for u in unknown if u[-1:] in MARKED and u[-2:-1].isascii() and u[-2:-1].isalpha()}
        new = list({marked.get(u, u) for u in unknown}.union(u[-1] for u in marked).difference(known))
        known.update(zip(new, encoded(new), strict=True))
        known.update((u, known[word] + known[u[-1]]) for u, word in marked.items())
        sums = np.append(0, np.cumsum(np.fromiter(map(known.__getitem__, names), np.int64, len(names))[at]))
        return sums[offsets[1:]] - sums[offsets[:-1]]

    return count


def stored_counts(spark, cache: str, tokenizer: Tokenizer) -> DataFrame:
    """(digest, n_tokens) that the cache holds for this version; a cache that isn't there is empty."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "digest binary, n_tokens long")
    known = spark.read.schema(SCHEMA).parquet(cache).where(F.col("tokenizer") == F.lit(tokenizer.digest))
    # two runs may have appended the same text
    return known.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _encoded(texts: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    model = texts.sparkSession.sparkContext.broadcast(tokenizer)  # a file of fixed size

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = model.value.counter()
        for batch in batches:
            yield pa.array(np.concatenate([np.zeros(0, np.int64), *map(run, slices(batch))]))

    return texts.select("digest", count("text").alias("n_tokens"))


def fill(docs: DataFrame, tokenizer: Tokenizer, cache: str) -> None:
    """Append the counts of the distinct texts of ``docs`` that ``cache`` lacks for this tokenizer."""
    known = stored_counts(docs.sparkSession, cache, tokenizer)
    text = F.coalesce("text", F.lit(""))
    missing = docs.select(text_digest().alias("digest"), text.alias("text")).join(known, "digest", "left_anti")
    distinct = missing.groupBy("digest").agg(F.any_value("text").alias("text"))
    new = _encoded(distinct, tokenizer).select(F.lit(tokenizer.digest).alias("tokenizer"), "digest", "n_tokens")
    new.write.mode("append").parquet(cache)


def token_counts(docs: DataFrame, tokenizer: Tokenizer, cache: str, limit: int = 512) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit.

    A null text counts as empty (0 tokens). Texts are encoded whole, each distinct one once, and
    not at all if ``cache`` (a folder all executors share) has its count; new counts are appended
    to it. Repeated rows and rows without doc_id each get a row.
    """
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    rows = stored(docs.select("doc_id", size.alias("n_bytes"), text_digest().alias("digest")), "digests")
    fill(docs, tokenizer, cache)
    counted = rows.join(stored_counts(docs.sparkSession, cache, tokenizer), "digest")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
