"""Quality rules whose thresholds come from the data: quantile sketches per language and source.

The sketch of a metric is a table of counts over logarithmic bins (relative error ``ERROR``).
Sketches merge by adding counts, whatever the order, so reruns agree and the sketch of a language
or of the whole corpus is the sum of those of its groups. A group with too few documents to
judge by takes the thresholds of its language, then those of all.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazecast.llm.common import columns, fresh, replaced, row_key, texts_of
from hazecast.session import stored

ERROR = 0.01
LEAST = 200  # documents a group needs for thresholds of its own
REACH = 4.0  # interquartile ranges between a quartile and its fence
WINDOW = 5
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\r\x0b\x0c"
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]

#: Metric: (dividend, divisor, least range that counts as spread, whether small values fail too).
#: REACH times the least range of ``repeat_ratio`` lies below the fixed cutoff of 20 %, so that its fence can reject.
METRICS = {
    "word_length": ("word_chars", "n_words", 0.5, True),
    "symbol_ratio": ("n_symbols", "n_words", 0.05, False),
    "dup_line_ratio": ("n_dup_lines", "n_lines", 0.02, False),
    "repeat_ratio": ("n_repeat_words", "n_words", 0.01, False),
}


def _value(metric: str) -> Column:
    """Null where the text has nothing to divide by."""
    above, below, _, _ = METRICS[metric]
    return F.when(F.col(below) > 0, F.col(above) / F.col(below))


def _repeat_words(words: list[bytes]) -> int:
    """Words that stand in a window which occurs twice or more."""
    windows = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    total, covered = 0, 0
    for i, window in enumerate(windows):
        if times[window] > 1:
            total += i + WINDOW - max(covered, i)
            covered = i + WINDOW
    return total


def text_stats(text: str) -> tuple[int, ...]:
    words = text.encode().split()
    seen, repeated, lines = set(), 0, 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            lines += 1
            repeated += line in seen
            seen.add(line)
    chars = len(text) - sum(map(text.count, BLANKS))
    return len(words), chars, sum(map(text.count, SYMBOLS)), repeated, _repeat_words(words), lines


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the base figures of every text (null: none) and ``base_failed``."""
    kind = pa.struct([(s, pa.int64()) for s in STATS])
    (struct,) = fresh(docs, "_stats")

    @F.arrow_udf(", ".join(f"{s} long" for s in STATS))
    def stats(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([dict(zip(STATS, text_stats(t), strict=True)) for t in texts_of(texts)], kind)

    found = docs.withColumn(struct, stats(F.col(f"`{text}`")))
    full = replaced(found, {s: F.col(f"`{struct}`.{s}") for s in STATS}).drop(struct)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return replaced(full, {"base_failed": failed})


def sketches(stats: DataFrame, error: float = ERROR) -> DataFrame:
    """(lang, source, metric, bin, n): mergeable sketches of the metrics; bin null holds the zeros."""
    values = [F.struct(F.lit(m).alias("metric"), _value(m).alias("value")) for m in METRICS]
    long = stats.select("lang", "source", F.explode(F.array(*values)).alias("m")).select("lang", "source", "m.*")
    base = math.log((1 + error) / (1 - error))
    place = F.when(F.col("value") > 0, F.ceil(F.log("value") / base))
    return long.where(F.col("value").isNotNull()).groupBy("lang", "source", "metric", place.alias("bin")).agg(F.count("*").alias("n"))


def _fences(sketch: DataFrame, by: list[str], error: float, reach: float, least: int) -> DataFrame:
    """Lower and upper fence of each metric for the groups of ``by``, as a map per group."""
    merged = sketch.groupBy(*by, "metric", "bin").agg(F.sum("n").alias("n"))
    order = Window.partitionBy(*by, "metric").orderBy(F.col("bin").asc_nulls_first())
    whole = Window.partitionBy(*by, "metric")
    base = math.log((1 + error) / (1 - error))
    value = F.when(F.col("bin").isNull(), 0.0).otherwise(F.exp(F.col("bin") * base) * (1 - error))
    ranked = merged.select(*by, "metric", value.alias("value"), F.sum("n").over(order).alias("upto"), F.sum("n").over(whole).alias("all"))

    def quantile(share: float) -> Column:
        return F.min(F.when(F.col("upto") >= share * F.col("all"), F.col("value")))

    quartiles = ranked.groupBy(*by, "metric").agg(
        quantile(0.25).alias("q1"), quantile(0.75).alias("q3"), F.first("all").alias("all")
    )
    spread = F.lit(None).cast("double")
    for metric, (_, _, floor, _) in METRICS.items():
        spread = F.when(F.col("metric") == metric, F.greatest(F.col("q3") - F.col("q1"), F.lit(floor))).otherwise(spread)
    fences = F.struct((F.col("q1") - reach * spread).alias("low"), (F.col("q3") + reach * spread).alias("high"))
    sure = quartiles.where(F.col("all") >= least) if by else quartiles
    return sure.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("metric", fences))).alias("fences"))


def thresholds(stats: DataFrame, error: float = ERROR, reach: float = REACH, least: int = LEAST) -> DataFrame:
    """(lang, source, fences): fences by metric for every group, its own or those of a wider one."""
    sketch = stored(sketches(stats, error), "sketches")
    groups = sketch.select("lang", "source").distinct()
    own = _fences(sketch, ["lang", "source"], error, reach, least).withColumnsRenamed({"fences": "own", "lang": "l", "source": "s"})
    wide = _fences(sketch, ["lang"], error, reach, least).withColumnsRenamed({"fences": "wide", "lang": "w"})
    every = _fences(sketch, [], error, reach, least).withColumnRenamed("fences", "every")
    both = groups.lang.eqNullSafe(F.col("l")) & groups.source.eqNullSafe(F.col("s"))
    found = groups.join(own, both, "left").join(wide, groups.lang.eqNullSafe(F.col("w")), "left").join(F.broadcast(every))
    return found.select("lang", "source", F.coalesce("own", "wide", "every").alias("fences"))


def judged(docs: DataFrame, error: float = ERROR, reach: float = REACH, least: int = LEAST) -> DataFrame:
    """One row per row of ``docs``: doc_id, the base figures, base_failed, kept, and ``broken``
    (the metrics outside their fences).

    ``kept`` is false if the base rules fail, else true unless a metric lies outside its fences.
    Only documents that pass the base rules shape the fences; a missing language or source is a
    group like any other. A null text has no words and fails. Repeated rows each count.
    """
    stats = stored(measured(docs.select("doc_id", "lang", "source", "text")).drop("text"), "stats")
    fit = stats.where(~F.col("base_failed"))
    fences = thresholds(fit, error, reach, least).withColumnsRenamed({"lang": "_l", "source": "_s"})
    same = F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s"))
    broken = []
    for metric, (_, _, _, both) in METRICS.items():
        value, fence = _value(metric), F.col("fences")[metric]
        out = value > fence.high
        broken.append(F.when((out | (value < fence.low)) if both else out, F.lit(metric)))
    outside = F.array_compact(F.array(*broken))
    kept = ~F.col("base_failed") & (F.size("broken") == 0)
    figures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return stats.join(fences, same, "left").withColumn("broken", outside).select("doc_id", *figures, "base_failed", kept.alias("kept"), "broken")


def filtered(docs: DataFrame, **settings) -> DataFrame:
    """Rows of ``docs`` that the rules keep; rows are told apart by doc_id and text."""
    (row,) = fresh(docs, "_row")
    keyed = docs.withColumn(row, row_key("doc_id", "text", "lang", "source"))
    verdicts = judged(keyed.select(F.col(row).alias("doc_id"), "lang", "source", "text"), **settings)
    good = verdicts.where("kept").select(F.col("doc_id").alias(row))
    return keyed.join(good, row, "left_semi").select(columns(docs))
