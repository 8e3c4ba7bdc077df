"""Near-duplicates by SimHash fingerprints, found with pigeonring filters.

A fingerprint of 64 bits is cut into a ring of ``max_distance + 1`` segments. If two fingerprints
differ in at most ``max_distance`` bits, some segment begins a chain in which the differences of
the first k segments together never exceed k * max_distance / segments, for every k: its first
segment is equal, and its second differs in at most one bit, so that one half of that is equal
too. The first segment with one such half (32 bits of 64) is the key that candidates share; the
budgets of the whole chain are checked next, and all bits last.

Keys that too many different fingerprints share (a large family of near copies) are not paired.
Their fingerprints are linked through every fingerprint one bit away instead: two of them differ
in at most two bits exactly if they have such a neighbour (or themselves) in common, and one has
65 of those at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazecast.llm.common import columns, fresh, row_key, texts_of
from hazecast.llm.components import components
from hazecast.session import stored

SEED = 42
BLOCK = 1 << 15  # shingles counted at a time
CROWD = 64  # different fingerprints under one key that are still compared in pairs


def shingles(text: bytes, width: int) -> list[bytes]:
    """Windows of ``width`` words, A-Z lowered, joined by spaces; a shorter text is one window."""
    words = text.lower().split()  # on bytes, both know ASCII only
    joined = b" ".join(words)
    if len(words) <= width:
        return [joined] if words else []
    ends = list(accumulate(len(w) + 1 for w in words))
    return [joined[s : e - 1] for s, e in zip([0, *ends], ends[width - 1 :], strict=False)]


def simhash(text: bytes, width: int) -> int:
    """Signed 64 bits: 1 where over half the shingle hashes have a 1; no words: 0."""
    parts = shingles(text, width)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(parts), BLOCK):
        block = b"".join([xxhash.xxh64_digest(p, SEED) for p in parts[i : i + BLOCK]])
        ones += np.unpackbits(np.frombuffer(block, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(parts)).view(">i8")[0])


def fingerprint(text: Column, width: int = 3) -> Column:
    """SimHash of a text as a signed long; null counts as empty, whose fingerprint is 0."""

    @F.arrow_udf("long")
    def hashed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([simhash(t.encode(), width) for t in texts_of(texts)], pa.int64())

    return hashed(text)


def as_hex(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def _ring(max_distance: int) -> list[tuple[int, int]]:
    """(shift, width) of the segments, as even as 64 bits allow."""
    n = max_distance + 1
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _cut(bits: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(bits, shift).bitwiseAND((1 << width) - 1)


def _keys(max_distance: int) -> Column:
    """All keys of ``bits``: the segment that begins a chain with either half of the next one."""
    ring, keys = _ring(max_distance), []
    for i, (shift, width) in enumerate(ring):
        at, long = ring[(i + 1) % len(ring)]
        halves = [(at, long // 2), (at + long // 2, long - long // 2)]
        for h, (begin, size) in enumerate(halves):
            first, second = _cut(F.col("bits"), shift, width), _cut(F.col("bits"), begin, size)
            keys.append(F.struct(F.lit(2 * i + h).alias("at"), F.shiftleft(first, 16).bitwiseOR(second).alias("value")))
    return F.array(*keys)


def _within(a: Column, b: Column, start: Column, max_distance: int) -> Column:
    """The chain from segment ``start`` keeps its budgets, and all bits together too."""
    ring = _ring(max_distance)
    n, differ = len(ring), a.bitwiseXOR(b)
    ok = F.bit_count(differ) <= max_distance
    for i in range(n):
        total, kept = F.lit(0), F.lit(True)
        for k in range(n):
            shift, width = ring[(i + k) % n]
            total = total + F.bit_count(_cut(differ, shift, width))
            kept = kept & (total <= (k + 1) * max_distance // n)
        ok = F.when(start == i, kept & ok).otherwise(ok)
    return ok


def links(prints: DataFrame, max_distance: int = 2, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) between different fingerprints ``bits``, enough to connect all that lie within
    ``max_distance`` (0, 1 or 2) bits: every such pair outside crowded keys, and inside them the
    links through common neighbours. ``prints`` must hold each value of ``bits`` once.
    """
    if max_distance not in (0, 1, 2):
        raise ValueError("max_distance must be 0, 1 or 2")
    if max_distance == 0:
        return prints.select(F.col("bits").alias("a"), F.col("bits").alias("b")).limit(0)
    keyed = prints.select("bits", F.explode(_keys(max_distance)).alias("key")).select("bits", "key.at", "key.value")
    shared = keyed.groupBy("at", "value").agg(F.count("*").alias("n")).where("n > 1")
    keyed = stored(keyed.join(shared, ["at", "value"]), "ring")
    groups = keyed.where(F.col("n") <= crowd).groupBy("at", "value").agg(F.collect_list("bits").alias("own"))
    start = F.shiftright(F.col("at"), 1)
    pairs = groups.select(
        F.explode(
            F.flatten(
                F.transform(
                    "own",
                    lambda a: F.transform(
                        F.filter("own", lambda b: (b > a) & _within(a, b, start, max_distance)),
                        lambda b: F.struct(a.alias("a"), b.alias("b")),
                    ),
                )
            )
        ).alias("pair")
    ).select("pair.a", "pair.b")
    crowded = keyed.where(F.col("n") > crowd).select("bits").distinct()
    return pairs.union(_through_neighbours(crowded, max_distance)).distinct()


def _through_neighbours(prints: DataFrame, max_distance: int) -> DataFrame:
    near = F.array(F.col("bits"), *[F.col("bits").bitwiseXOR((1 << i) - (1 << 64) * (i == 63)) for i in range(64)])
    hubs = prints.select("bits", F.explode(near).alias("hub")).groupBy("hub").agg(F.collect_set("bits").alias("own"))
    hubs = hubs.where(F.size("own") > 1)  # 65 fingerprints at most have a hub
    if max_distance == 2:
        return hubs.select(F.array_min("own").alias("a"), F.explode("own").alias("b")).where("a <> b")
    return hubs.where(F.array_contains("own", F.col("hub"))).select(F.col("hub").alias("a"), F.explode("own").alias("b")).where("a <> b")


def near_duplicates(docs: DataFrame, width: int = 3, max_distance: int = 2, crowd: int = CROWD) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint, component_id (the smallest doc_id that links reach).

    Documents with equal fingerprints are one node, so copies are never paired; texts without
    words (null, empty, blank) share fingerprint 0 and link like any other. Repeated rows each
    get a row. Rows without doc_id are nodes too, but don't name a component unless no row of it
    has an id: then component_id is null. An empty table gives no rows.
    """
    signed = stored(docs.select("doc_id", fingerprint(F.col("text"), width).alias("bits")), "fingerprints")
    return named(signed, max_distance, crowd).select("doc_id", as_hex(F.col("bits")).alias("fingerprint"), "component_id")


def named(signed: DataFrame, max_distance: int, crowd: int = CROWD) -> DataFrame:
    """Add ``component_id`` to rows that have ``bits`` and ``doc_id``."""
    prints = stored(signed.groupBy("bits").agg(F.min("doc_id").alias("first")), "prints")
    roots = components(links(prints, max_distance, crowd), "a", "b")
    placed = stored(
        prints.join(roots.withColumnRenamed("node", "bits"), "bits", "left").withColumn("root", F.coalesce("root", "bits")),
        "placed",
    )
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    names = placed.join(least, "root").select("bits", "component_id")
    return signed.join(names, "bits")


def one_of_each(docs: DataFrame, width: int = 3, max_distance: int = 2) -> DataFrame:
    """Rows of ``docs`` without near-duplicates: one row of each component stays, whole.

    It is the row of the smallest doc_id; of repeated ids, that of the smallest text digest; rows
    without id come last. Of fully equal rows one stays.
    """
    (row,) = fresh(docs, "_row")
    rows = docs.withColumn(row, row_key("doc_id", "text"))
    signed = stored(rows.select(row, "doc_id", fingerprint(F.col("text"), width).alias("bits")), "fingerprints")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", row)
    prints = stored(signed.groupBy("bits").agg(F.min(rank).alias("first")), "prints")
    roots = components(links(prints, max_distance), "a", "b")
    placed = prints.join(roots.withColumnRenamed("node", "bits"), "bits", "left").withColumn("root", F.coalesce("root", "bits"))
    stays = placed.groupBy("root").agg(F.min("first").alias("first")).select(f"first.{row}")
    return rows.join(stays, row, "left_semi").dropDuplicates([row]).select(columns(docs))
