"""Mix sources to target weights by systematic sampling, with DataFrame functions only.

Targets: the total size of all documents is shared by weight; a source takes at most ``most``
times its own size and what it leaves is shared again among the others, until none is above.
That is one level of size per weight for all sources that aren't full, found in a few rounds of
one aggregation each.

Documents: each has the same expected copies, target / size of its source. Along the documents
of a source, ordered by size, the expected copies are summed from one random offset on, and a
document is taken once for each whole number its own share crosses. Neighbours in that order are
alike in size, so the words taken come close to the target. A running sum over a whole source
would put a large source into one task: rows are cut into ranges of (source, size) instead, each
range counts its rows, and a range starts where those before it end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazecast.llm.common import WORD, columns, fresh, row_key
from hazecast.session import stored

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3.0
SEED = 7
ROUNDS = 200  # a round fills at least one more kind of source, or is the last


def size_of(text: str = "text") -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """Add ``weight`` and ``target`` to rows of (source, source_size).

    Weights repeat along the sources by code point, null last. Sources of size 0 have target 0.
    """
    placed = stored(_ranked(sources, [F.col("source").asc_nulls_last()], "place"), "sources")
    index = (F.pmod(F.col("place") - 1, len(weights)) + 1).cast("int")
    placed = placed.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), index))
    total = placed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    room = F.col("source_size") * most
    level = 0.0
    for _ in range(ROUNDS):
        full = room <= level * F.col("weight")
        left, open_weight = placed.agg(
            F.lit(float(total)) - F.coalesce(F.sum(F.when(full, room)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        if not open_weight or left / open_weight <= level:
            break
        level = left / open_weight
    else:
        raise RuntimeError("the targets did not settle")
    return placed.withColumn("target", F.least(room, level * F.col("weight")).cast("double"))


def _ranked(df: DataFrame, order: list[Column], into: str, within: str | None = None, count: str | None = None) -> DataFrame:
    """Position of every row, from 1, in ``order`` (that of its last row where a row counts for
    several), over all rows or those of one value of ``within``; no task sees more than a range."""
    ranged = stored(df.repartitionByRange(*order).withColumn("_slot", F.spark_partition_id()), "ranges")
    by = ["_slot", within] if within else ["_slot"]
    one = F.col(count) if count else F.lit(1)
    sums = ranged.groupBy(*by).agg(F.sum(one).alias("_own"))
    before = Window.partitionBy(*by[1:]).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("_start", F.coalesce(F.sum("_own").over(before), F.lit(0))).drop("_own")
    same = F.col("_slot") == F.col("_s")
    if within:
        same = same & F.col(within).eqNullSafe(F.col("_w"))
        starts = starts.withColumnRenamed(within, "_w")
    joined = ranged.join(starts.withColumnRenamed("_slot", "_s"), same)
    inside = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return joined.withColumn(into, (F.col("_start") + F.sum(one).over(inside)).cast("long")).drop("_slot", "_s", "_w", "_start")


def offset(source: Column, seed: int = SEED) -> Column:
    """One number in [0, 1) for each source and seed, the same in every run."""
    digest = F.md5(F.concat(F.lit(f"{seed} "), F.coalesce(source, F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


def mixed(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: int = SEED, also: str = "n") -> DataFrame:
    """Add source_size, target, ``upto`` (rows of the source up to here), ``rate`` and ``offset`` to
    rows of (doc_id, source, size, n): n equal rows each, put in order by size, doc_id and ``also``.
    """
    sizes = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = source_targets(sizes, weights, most).withColumnRenamed("source", "_source")
    order = [F.col(c).asc_nulls_last() for c in ("source", "size", "doc_id", also)]
    ranked = _ranked(rows, order, "upto", "source", "n")
    joined = ranked.join(targets, F.col("source").eqNullSafe(F.col("_source")))
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(most))).otherwise(0.0)
    return joined.withColumn("rate", rate).withColumn("offset", offset(F.col("source"), seed)).drop("_source", "place", "weight")


def _crossed(upto: Column) -> Column:
    return F.floor(F.col("offset") + F.col("rate") * upto).cast("long")


def taken_words(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target (its source's), copies, taken.

    ``taken`` is copies * size; copies never exceed ``most`` rounded up. Documents without words
    have size 0 and may be taken, for nothing; a source of such documents alone has target 0.
    Null sources are one source, the last. Equal rows are counted as one on the way and each get
    a row; rows without doc_id too. An empty table gives no rows.
    """
    one = docs.select("doc_id", "source", size_of().alias("size"))
    rows = one.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n"))
    each = mixed(rows, weights, most, seed).withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    upto = F.col("upto") - F.col("n") + F.col("k")
    copies = _crossed(upto) - _crossed(upto - 1)
    return each.select(
        "doc_id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken")
    )


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: int = SEED) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken (0 times: gone)."""
    row, copies, turn = fresh(docs, "_row", "_copies", "_turn")
    keyed = docs.withColumn(row, row_key(*columns(docs)))
    own = keyed.select(F.col(row).alias("row"), "doc_id", "source", size_of().alias("size"))
    rows = own.groupBy("row", "doc_id", "source", "size").agg(F.count("*").alias("n"))
    drawn = mixed(rows, weights, most, seed, "row")
    crossed = _crossed(F.col("upto")) - _crossed(F.col("upto") - F.col("n"))
    drawn = drawn.select(F.col("row").alias(row), "n", crossed.alias(copies)).where(F.col(copies) > 0)
    # equal rows are drawn together, and one of them brings the copies of all
    some = keyed.join(drawn.where("n = 1").select(row, copies), row)
    many = keyed.join(drawn.where("n > 1").select(row, copies), row).dropDuplicates([row])
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))).alias(turn)
    return some.union(many).select(*columns(docs), again).select(columns(docs))
