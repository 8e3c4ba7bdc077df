"""Language identification by n-gram filters that hold a bit for each language.

One Bloom filter serves all languages: every position holds a mask with a bit per language. The
masks at an n-gram's positions, combined by AND, name all languages that contain it. A text's
votes are the bits set over its n-grams, language by language, less what false positives explain.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazecast.llm.common import chunks, held_out, texts_of

GRAMS = (2, 3, 4)  # characters of an n-gram; words are set between blanks
SAMPLE = 3000  # documents of each language that the filter is fitted on
SHARE = 5e-5  # of a language's n-grams that one must make up to be held
RATIO = 4.0  # times that its share must exceed the least one among languages that have it
SLOTS = 1 << 20
HASHES = 3
SPREAD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93]


def _letters() -> np.ndarray:
    """Code point -> its lower-case letter, or 0."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            table[c] = ord(chr(c).lower()[0])
    return table


def ngrams(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of letters, and the text each is from. Runs of other characters are one blank."""
    points = np.frombuffer("\n".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    owner = np.concatenate([[0], np.repeat(np.arange(len(texts)), lengths)])
    symbols = letters[points]
    keep = symbols > 0
    keep[1:] |= keep[:-1].copy()  # the first of each run of blanks
    keep[0] = True
    symbols, owner = symbols[keep].astype(np.uint64), owner[keep]
    found, owners = [], []
    for n in GRAMS:
        if len(symbols) < n:
            continue
        size = len(symbols) - n + 1
        value, inside = np.full(size, n, np.uint64), np.ones(size, bool)
        for i in range(n):
            part = symbols[i : i + size]
            value = (value ^ part) * np.uint64(SPREAD[i])
            if 0 < i < n - 1:
                inside &= part > 0  # a blank may stand at either end only
        inside &= (symbols[:size] > 0) | (symbols[1 : size + 1] > 0) if n > 1 else symbols[:size] > 0
        found.append(value[inside])
        owners.append(owner[n - 1 :][inside] if n > 1 else owner[inside])
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes = np.concatenate(found)
    hashes ^= hashes >> np.uint64(31)
    return hashes, np.concatenate(owners)


@dataclass
class Filter:
    """Masks by position, and for each language its rate of hits on its own texts and of false ones.

    The size is fixed by ``SLOTS`` (8 bytes each), so it is broadcast.
    """

    languages: list[str]  # at most 64
    masks: np.ndarray
    false_rate: np.ndarray
    own_rate: np.ndarray

    def votes(self, hashes: np.ndarray) -> np.ndarray:
        """Masks of the languages that contain each n-gram."""
        mask = self.masks[_slot(hashes, 0, len(self.masks))]
        for k in range(1, HASHES):
            mask = mask & self.masks[_slot(hashes, k, len(self.masks))]
        return mask

    def shares(self, hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """Per text and language: share of n-grams it contains, freed of false positives, as a
        part of the share that texts of that language show."""
        mask = self.votes(hashes)
        total = np.maximum(np.bincount(owner, minlength=n), 1)
        columns = []
        for i in range(len(self.languages)):
            hit = (mask >> np.uint64(i)) & np.uint64(1)
            seen = np.bincount(owner, weights=hit, minlength=n) / total
            true = np.maximum(seen - self.false_rate[i], 0) / (1 - self.false_rate[i])
            columns.append(true / max(self.own_rate[i], 1e-9))
        return np.stack(columns, axis=1) if columns else np.zeros((n, 0))


def _slot(hashes: np.ndarray, k: int, size: int) -> np.ndarray:
    mixed = (hashes + np.uint64(k + 1)) * np.uint64(SPREAD[k])
    return ((mixed >> np.uint64(24)) % np.uint64(size)).astype(np.int64)


def fit(docs: DataFrame, sample: int = SAMPLE, slots: int = SLOTS, share: float = SHARE, ratio: float = RATIO) -> Filter:
    """Filter from the text and language of rows that aren't held out.

    Fitted on at most ``sample`` documents of each language, those of least digest, so that
    reruns agree. An n-gram is held for a language if it makes up ``share`` of its n-grams there and
    is not ``ratio`` times rarer than where it is most frequent. Null languages teach nothing; without
    any labelled row the filter has no languages. More than 64 languages are refused.
    """
    known = docs.where(~held_out() & F.col("lang").isNotNull()).select("lang", F.coalesce("text", F.lit("")).alias("text"))
    known = known.select("lang", F.xxhash64("text").alias("place"), "text")
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).limit(65).collect()}
    if len(counts) > 64:
        raise ValueError("the filter has bits for 64 languages")
    if not counts:
        return Filter([], np.zeros(1, np.uint64), np.zeros(0), np.zeros(0))
    # a cut by digest takes about ``sample`` rows a language without sorting any
    cut = F.lit(None).cast("long")
    for lang, n in sorted(counts.items()):
        limit = min(-(1 << 63) + int(min(1.0, sample / n) * (1 << 64)), (1 << 63) - 1)
        cut = F.when(F.col("lang") == lang, F.lit(limit)).otherwise(cut)
    letters = known.sparkSession.sparkContext.broadcast(_letters())
    languages = sorted(counts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist())
            for lang in sorted(set(langs.tolist())):
                own = batch.column(1).filter(pa.array(langs == lang))
                for some in chunks(texts_of(own)):
                    grams, times = np.unique(ngrams(some, letters.value)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(times.astype(np.int64))],
                        ["lang", "gram", "n"],
                    )

    taken = known.where(F.col("place") <= cut).select("lang", "text")
    grams = taken.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = {r.lang: r.n for r in grams.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    total = F.lit(None).cast("double")
    for lang, n in sorted(totals.items()):
        total = F.when(F.col("lang") == lang, F.lit(float(n))).otherwise(total)
    shares = grams.withColumn("share", F.col("n") / total).where(F.col("share") >= share)  # 1 / share a language at most
    rows = shares.select("lang", "gram", "share").toPandas()
    best = rows.groupby("gram")["share"].transform("max")
    rows = rows[rows["share"] * ratio >= best]
    masks = np.zeros(slots, np.uint64)
    for i, lang in enumerate(languages):
        held = rows.loc[rows["lang"] == lang, "gram"].to_numpy().astype(np.int64).view(np.uint64)
        for k in range(HASHES):
            masks[_slot(held, k, slots)] |= np.uint64(1 << i)
    bits = [(masks >> np.uint64(i)) & np.uint64(1) for i in range(len(languages))]
    false_rate = np.array([float(b.mean()) ** HASHES for b in bits])
    own_rate = np.array([rows.loc[rows["lang"] == lang, "share"].sum() for lang in languages])
    return Filter(languages, masks, false_rate, own_rate)


def predict(text: Column, model: Filter, spark) -> Column:
    """Struct (lang, score): the language of a text, and its part of all languages' shares.

    A null text, or one without a letter, is ``und`` with score 0; so is one that shares no
    n-gram with any language. Of equal languages the first by name wins.
    """
    shared, letters = spark.sparkContext.broadcast(model), spark.sparkContext.broadcast(_letters())
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("lang string, score double")
    def decide(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held = shared.value
        for batch in batches:
            out = []
            for some in chunks(texts_of(batch)):
                shares = held.shares(*ngrams(some, letters.value), len(some))
                for own in shares:
                    best = int(own.argmax()) if len(own) else 0
                    if len(own) and own[best] > 0:
                        out.append({"lang": held.languages[best], "score": float(own[best] / own.sum())})
                    else:
                        out.append({"lang": None, "score": 0.0})
            yield pa.array(out, kind)

    return decide(text)


def identified(docs: DataFrame, model: Filter) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    A text with letters but no known n-gram takes the first learned language with score 0.
    """
    found = docs.select(
        "doc_id",
        held_out().alias("held_out"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"),
        predict(F.col("text"), model, docs.sparkSession).alias("p"),
    )
    first = F.lit(model.languages[0] if model.languages else "und")
    lang = F.when(F.col("letters"), F.coalesce("p.lang", first)).otherwise("und")
    score = F.when(F.col("letters"), F.col("p.score")).otherwise(0.0)
    return found.select("doc_id", "held_out", lang.alias("lang_pred"), score.alias("score"))
