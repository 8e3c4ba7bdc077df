"""Toxicity of texts, also of disguised ones: restore words by a noisy channel, then score them.

A word that holds digits or symbols, stretched letters or single spaced letters is taken as the
noisy form of an unknown word. Its lattice has for each character what may have been meant: the
letter itself, the letters a digit or symbol stands for, or nothing (a separator, one more of a
stretched letter). Viterbi search over states of two letters finds the path that a character
trigram model of the whole corpus and the channel's costs like best. Every other word has a single
path and is left alone.

The score sums the log odds of the most telling restored words, learned from labelled documents for
words and for their beginnings, and a logistic fit turns the sum into a probability. What counts is
in how many ways a word is used, that is, between which other words: copies of a document and
passages that many share prove no more than one.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazecast.llm.common import chunks, fresh, held_out, texts_of
from hazecast.session import stored

# fixed values: letters that digits and symbols stand for
MEANT = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i", "µ": "u",
}
EDGES = ".,;:!?%&#*|\"'`()[]{}<>/\\~^_=+-…«»“”‘’$@€£¡¿"
# log costs of the channel: a sign for a letter, a separator, one more of a stretched letter (three in a
# row at least), one of a double letter, a letter that means nothing
REPLACED, DROPPED, STRETCHED, DOUBLED, LOST = -1.0, -1.0, -0.5, -8.0, -25.0

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)])) + "œ"
KINDS = len(LETTERS) + 1  # 0 stands for all other characters
PRIOR = 5.0

SPACED = re.compile(r"(?<!\S)(?:\S[ .\-_*]){3,}\S(?!\S)")
NOISY = re.compile(r"[^\W\d_][^\w\s]|[^\w\s][^\W\d_]|\d[^\W\d_]|[^\W\d_]\d|_|(\w)\1\1")

SAMPLE = 10_000  # labelled documents that the words are learned from
TERMS = 20_000  # words and beginnings kept
SUPPORT = 5  # different uses in toxic documents that a term must have
ODDS = math.log(8)
BEGINNINGS = (4, 5, 6)
TELLING = 3  # words of a text that its evidence is the sum of
MEMO = 60_000


def _classes() -> np.ndarray:
    table = np.zeros(0x110000, np.int32)
    for i, letter in enumerate(LETTERS, 1):
        table[ord(letter)] = i
        if len(letter.upper()) == 1:
            table[ord(letter.upper())] = i
    return table


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Letter trigrams of all texts, counted map-side; KINDS ** 3 numbers whatever the corpus."""
    classes = docs.sparkSession.sparkContext.broadcast(_classes())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(KINDS**3, np.int64)
        for batch in batches:
            for some in chunks(texts_of(batch.column(0))):
                points = np.frombuffer("\n".join(["", "", *some, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
                kind = classes.value[points]
                total += np.bincount((kind[:-2] * KINDS + kind[1:-1]) * KINDS + kind[2:], minlength=KINDS**3)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["code", "n"])

    rows = docs.select("text").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(KINDS**3)
    counts[rows["code"].to_numpy(np.int64)] = rows["n"].to_numpy(float)
    return counts.reshape(KINDS, KINDS, KINDS)


@dataclass
class Restorer:
    """Log probability of a letter after two others, and the Viterbi search over lattices."""

    log: np.ndarray

    @classmethod
    def from_counts(cls, three: np.ndarray) -> Restorer:
        two, one = three.sum(0), three.sum((0, 1))
        p1 = (one + 1) / (one.sum() + KINDS)
        p2 = (two + PRIOR * p1) / (two.sum(1, keepdims=True) + PRIOR)
        p3 = (three + PRIOR * p2) / (three.sum(2, keepdims=True) + PRIOR)
        return cls(np.log(p3))

    def __post_init__(self):
        self.reach = 2 * float(-self.log.min())
        self.flat = self.log.ravel().tolist()

    def restored(self, noisy: str) -> str:
        """The likeliest word behind a noisy form. The empty path wins only if nothing is a letter.

        Letters of other scripts stand for themselves. Search drops a state only if it can't win any
        more: with the same choices (or, where it drops one more of its last letter, by taking that
        letter) the best state becomes the same state within two letters, each of which costs it at
        most the least log probability. So time grows with the length alone.
        """
        flat = self.flat
        # a state: classes of the last two letters, and whether there is a letter at all
        states: dict[tuple[int, int, bool], tuple[float, tuple]] = {(0, 0, False): (0.0, ())}
        for i, char in enumerate(noisy):
            stretched = STRETCHED if char * 3 in noisy[max(0, i - 2) : i + 3] else DOUBLED
            letter = LETTERS.find(char) + 1
            options = [(letter, char, 0.0)] if letter or char.isalpha() else [(LETTERS.index(m) + 1, m, REPLACED) for m in MEANT.get(char, "")]
            dropped = LOST if letter or char.isalnum() else DROPPED
            after: dict[tuple[int, int, bool], tuple[float, tuple]] = {}
            for (a, b, any_), (score, path) in states.items():
                at = (a * KINDS + b) * KINDS
                found = [((b, x, True), score + cost + flat[at + x], (own, path)) for x, own, cost in options]
                found.append(((a, b, any_), score + (stretched if letter and letter == b else dropped), path))
                for state, total, own in found:
                    if state not in after or total > after[state][0]:
                        after[state] = total, own
            best = max((total for (_, _, any_), (total, _) in after.items() if any_), default=-math.inf) - self.reach
            states = {s: v for s, v in after.items() if v[0] >= best}
        _, path = max(
            ((score + flat[(a * KINDS + b) * KINDS], path) for (a, b, _), (score, path) in states.items()), key=lambda x: (bool(x[1]), x[0])
        )
        letters = []
        while path:
            letter, path = path
            letters.append(letter)
        return "".join(reversed(letters))

    def word(self, token: str) -> str:
        """A lower-case token without its edges; restored if it is noisy and has a letter."""
        bare = token.rstrip(EDGES).lstrip(EDGES.replace("$", "").replace("@", "")) or token.strip(EDGES)
        if NOISY.search(bare):
            return self.restored(bare) or bare
        return bare

    def sequence(self, tokens: Iterable[str], memo: dict[str, str]) -> list[str]:
        if len(memo) > MEMO:
            memo.clear()
        found = []
        for token in tokens:
            word = memo.get(token)
            if word is None:
                word = memo[token] = self.word(token)
            found.append(word)
        return found

    def joined(self, text: str) -> str:
        """A lower-case text in which spaced letters are restored to words."""
        return SPACED.sub(lambda m: self.restored(re.sub(r"[ .\-_*]", "", m[0]) or m[0]), text)

    def words(self, text: str, memo: dict[str, str]) -> set[str]:
        """Distinct restored words of a text, spaced ones joined."""
        return set(self.sequence(set(self.joined(text.lower()).split()), memo))

    def uses(self, text: str, memo: dict[str, str]) -> set[tuple[str, int]]:
        """Restored words with a hash of the words beside them, each such use once."""
        own = self.sequence(self.joined(text.lower()).split(), memo)
        beside = zip(["", *own], [*own[1:], ""], strict=False)
        return {(w, xxhash.xxh64_intdigest(f"{a} {b}") - (1 << 63)) for w, (a, b) in zip(own, beside, strict=False)}


def terms(word: str) -> list[str]:
    """What is learned of a word: itself, and its beginnings."""
    return [word] + [f"{word[:n]}*" for n in BEGINNINGS if len(word) >= n]


@dataclass
class Model:
    """Restorer, log odds of at most TERMS terms, and the logistic fit (all of bounded size)."""

    restorer: Restorer
    odds: dict[str, float]
    bias: float
    slope: float

    def evidence(self, words: set[str], memo: dict[str, float]) -> float:
        """Sum of the log odds of the most telling words, ``TELLING`` at most; 0 if none is known."""
        if len(memo) > MEMO:
            memo.clear()
        found = []
        for word in words:
            value = memo.get(word)
            if value is None:
                value = memo[word] = max((self.odds.get(t, 0.0) for t in terms(word)), default=0.0)
            if value:
                found.append(value)
        return sum(sorted(found)[-TELLING:])

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, self.bias + self.slope * evidence))))


def _logistic(evidence: np.ndarray, toxic: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Weighted logistic fit with a weak pull towards the log odds themselves: Newton steps, halved
    until they lower the loss."""
    x = np.column_stack((np.ones(len(evidence)), evidence))
    start, ridge = np.array([-3.0, 1.0]), 0.01

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((n * (np.logaddexp(0, z) - toxic * z)).sum() + ridge / 2 * ((w - start) ** 2).sum())

    w = start
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        gradient = x.T @ (n * (toxic - p)) - ridge * (w - start)
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(2)
        step, now = np.linalg.solve(hessian, gradient), loss(w)
        while loss(w + step) > now and np.abs(step).max() > 1e-9:
            step = step / 2
        w = w + step
        if np.abs(step).max() <= 1e-9:
            break
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, top: int = TERMS) -> Model:
    """Character model of all texts, and terms learned from labelled rows that aren't held out.

    At most ``sample`` labelled documents (about; those of least digest) are looked at, ``top``
    terms kept. Labels that are null teach nothing; a document with several labels is learned from
    once each. Without toxic or clean rows no term is known, and every text scores low.
    """
    spark = docs.sparkSession
    restorer = Restorer.from_counts(trigram_counts(docs))
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.col("toxic").cast("int"))
    marked = marked.where(~held_out())
    n = marked.count()
    place = F.xxhash64(F.lit(11), F.col("doc_id"))
    limit = min(-(1 << 63) + int(min(1.0, sample / max(1, n)) * (1 << 64)), (1 << 63) - 1)
    # some ``sample`` rows of two numbers each: a bounded side
    chosen = F.broadcast(marked.where(place <= limit))
    learned = stored(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id").select("toxic", "text"), "labelled")
    shared = spark.sparkContext.broadcast(restorer)

    def use(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, str] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, 100):
                some = batch.slice(start, 100)
                seen = {0: set(), 1: set()}
                for toxic, text in zip(some.column(0).to_pylist(), texts_of(some.column(1)), strict=True):
                    seen[int(toxic == 1)] |= shared.value.uses(text, memo)
                for toxic, pairs in seen.items():
                    words, beside = zip(*pairs, strict=True) if pairs else ((), ())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(words, pa.string()), pa.array(beside, pa.int64()), pa.array([toxic] * len(words), pa.int32())],
                        ["word", "beside", "toxic"],
                    )

    uses = learned.mapInArrow(use, "word string, beside long, toxic int").distinct()
    totals = {r.toxic: r["count"] for r in uses.groupBy("toxic").count().collect()}
    ones, zeros = totals.get(1, 0), totals.get(0, 0)
    if not ones or not zeros:
        return Model(restorer, {}, -3.0, 1.0)
    word = F.col("word")
    begun = [F.when(F.length(word) >= n, F.concat(F.substring(word, 1, n), F.lit("*"))) for n in BEGINNINGS]
    counted = uses.groupBy("word").agg(
        F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")
    ).select(F.explode(F.array_compact(F.array(word, *begun))).alias("term"), "a", "b")
    seen = counted.groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    weight = F.log((F.col("a") + 0.5) / (ones + 1)) - F.log((F.col("b") + 0.5) / (zeros + 1))
    kept = seen.where(F.col("a") >= SUPPORT).select("term", "a", weight.alias("odds")).where(F.col("odds") >= ODDS)
    best = kept.orderBy((F.col("odds") * F.sqrt("a")).desc(), "term").limit(top).collect()
    model = Model(restorer, {r.term: r.odds for r in best}, -3.0, 1.0)
    # the fit needs counts by rounded evidence only
    points = learned.select((F.col("toxic") == 1).alias("toxic"), F.round(_evidence(F.col("text"), model, spark), 1).alias("x"))
    table = points.groupBy("x").agg(F.avg(F.col("toxic").cast("int")).alias("toxic"), F.count("*").alias("n")).toPandas()
    model.bias, model.slope = _logistic(*(table[c].to_numpy(float) for c in ("x", "toxic", "n")))
    return model


def _evidence(text: Column, model: Model, spark) -> Column:
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def evidence(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words, odds = {}, {}
        for texts in batches:
            held = shared.value
            yield pa.array([held.evidence(held.restorer.words(t, words), odds) for t in texts_of(texts)], pa.float64())

    return evidence(text)


def _score(evidence: Column, model: Model) -> Column:
    return 1 / (1 + F.exp(-(F.lit(model.bias) + F.lit(model.slope) * evidence)))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Null and empty texts have no words and score as such. Rows without doc_id aren't held out.
    """
    found = docs.select("doc_id", held_out().alias("held_out"), _evidence(F.col("text"), model, docs.sparkSession).alias("_e"))
    found = found.withColumn("score", _score(F.col("_e"), model)).drop("_e")
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def clean(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that score below ``limit``."""
    (name,) = fresh(docs, "_evidence")
    found = docs.withColumn(name, _evidence(F.col("text"), model, docs.sparkSession))
    return found.where(_score(F.col(name), model) < limit).drop(name)
