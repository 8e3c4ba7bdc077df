"""Near-duplicate vectors by a pivot-permutation index.

A vector is described by the few reference points (pivots) nearest to it, in order. The index is
inverted: two vectors are candidates if their lists share at least ``shared`` pivots, so each
vector stands in one posting list for every set of that many of its pivots. Within a posting list
cosines are computed in double precision, block by block; a pair found in several lists counts in
one of them, that of the smallest pivots the two share.

Equal vectors are one entry. Long posting lists (a dense family) are cut into blocks, and every
two blocks meet in a task of their own, so no task holds more than two.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazecast.llm.components import components
from hazecast.session import stored

SAMPLE = 4096  # different vectors that the pivots are chosen from
PIVOTS = 256  # vectors of the sample that serve as reference points
APART = 0.8  # cosine that no two pivots exceed: inside a dense family, their order would be chance
NEAREST = 8
SHARED = 4
BLOCK = 512


def usable(vector: Column) -> Column:
    """Vectors that can link: not null, not zero, all components finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce(vector.isNotNull() & ~bad & some, F.lit(False))


def fit(vectors: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Pivots by number of components, at unit length; labels play no part.

    Chosen from the ``sample`` different vectors of least hash, in that order, each one that is
    not too close to those before it, until there are ``pivots``.
    """
    place = F.xxhash64("embedding")
    rows = vectors.select("embedding", place.alias("place")).distinct().orderBy("place").limit(sample).collect()
    chosen = {}
    for d in sorted({len(r.embedding) for r in rows}):
        unit = _unit(np.array([r.embedding for r in rows if len(r.embedding) == d], float))
        kept = np.zeros((0, d))
        for row in unit:
            if len(kept) < pivots and not (kept @ row > APART).any():
                kept = np.vstack((kept, row))
        chosen[d] = kept
    return chosen


def _unit(rows: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled first, so that huge or tiny components don't overflow."""
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def permutations(vector: Column, pivots: dict[int, np.ndarray], nearest: int, spark) -> Column:
    """Numbers of the nearest pivots of a vector, nearest first. Sizes that the sample lacks get
    fixed random pivots."""
    held = spark.sparkContext.broadcast(pivots)

    @F.arrow_udf("array<int>")
    def order(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out: list = [None] * len(batch)
            sizes = batch.value_lengths().to_numpy(zero_copy_only=False)
            flat = batch.flatten().to_numpy(zero_copy_only=False).astype(float)
            ends = np.cumsum(sizes)
            for d in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == d)
                points = held.value.get(d)
                if points is None or len(points) < nearest:
                    points = _unit(np.random.default_rng(d).normal(size=(PIVOTS, d)))
                rows = _unit(flat[(ends[own] - d)[:, None] + np.arange(d)])
                near = np.argsort(-(rows @ points.T), axis=1, kind="stable")[:, :nearest]
                for i, ids in zip(own.tolist(), near.tolist(), strict=True):
                    out[i] = ids
            yield pa.array(out, pa.list_(pa.int32()))

    return order(vector)


def _postings(nearest: int, shared: int) -> Column:
    """A key for each set of ``shared`` of the pivots in ``near`` (ascending): 12 bits a pivot."""
    near = [F.col("near")[i].cast("long") for i in range(nearest)]
    keys = []
    for chosen in combinations(range(nearest), shared):
        key = F.lit(0).cast("long")
        for i in chosen:
            key = F.shiftleft(key, 12).bitwiseOR(near[i])
        keys.append(key)
    return F.array(*keys)


def _linked(rows: list[dict], least: float, shared: int) -> Iterator[tuple[int, int, int]]:
    """(node, rows linked to it, its root among them) within one task's part of a posting list."""
    nodes = [r["node"] for r in rows]
    unit = _unit(np.array([r["embedding"] for r in rows], float))
    blocks, n = np.array([r["block"] for r in rows]), np.array([r["n"] for r in rows])
    near = np.array([r["near"] for r in rows])
    first, last = rows[0]["low"], rows[0]["high"]
    a, b = np.flatnonzero(blocks == first), np.flatnonzero(blocks == last)
    i, j = np.nonzero(unit[a] @ unit[b].T >= least)
    i, j = a[i], b[j]
    if first == last:
        i, j = i[i < j], j[i < j]
    # the pair counts in the list of the smallest pivots that both have
    common = (near[i][:, :, None] == near[j][:, None, :]).any(2)
    rank = np.cumsum(common, axis=1)
    chosen = common & (rank <= shared)
    key = np.zeros(len(i), np.int64)
    for column in range(near.shape[1]):
        key = np.where(chosen[:, column], key << 12 | near[i, column], key)
    own = key == rows[0]["key"]
    i, j = i[own], j[own]
    links = np.bincount(i, n[j], len(rows)) + np.bincount(j, n[i], len(rows))
    parent = list(range(len(rows)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(i.tolist(), j.tolist(), strict=True):
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    for x in np.flatnonzero(links).tolist():
        yield nodes[x], int(links[x]), nodes[find(x)]


def near_duplicates(
    vectors: DataFrame,
    least: float = 0.98,
    pivots: int = PIVOTS,
    nearest: int = NEAREST,
    shared: int = SHARED,
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Rows link if their labels are equal and not null, their vectors have the same number of
    components and a cosine of at least ``least``. Null and zero vectors, and those with null or
    non-finite components, link with nothing; each is its own component. Repeated rows are copies
    that link with each other. Pairs of which no ``shared`` pivots agree are missed. A component
    takes the smallest vec_id of its rows; without any id it is null, and nothing of it is kept.
    """
    spark = vectors.sparkSession
    good = usable(F.col("embedding")) & F.col("label").isNotNull()
    names = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2")]
    rows = vectors.select("vec_id", "label", "embedding", good.alias("good"), *names)
    entries = rows.where("good").groupBy("label", "h1", "h2").agg(
        F.min("vec_id").alias("first"), F.count("*").alias("n"), F.any_value("embedding").alias("embedding")
    )
    entries = entries.withColumn("node", F.coalesce("first", F.xxhash64("label", "h1", "h2")))
    entries = stored(entries, "entries")
    near = F.array_sort(permutations(F.col("embedding"), fit(entries, pivots), nearest, spark))
    index = stored(entries.select("label", "node", "n", "embedding", F.size("embedding").alias("size"), near.alias("near")), "index")
    nearest = min(nearest, PIVOTS)
    postings = index.select("label", "size", "node", F.explode(_postings(nearest, shared)).alias("key"))
    lists = postings.groupBy("label", "size", "key").agg(F.count("*").alias("length")).where("length > 1")
    postings = stored(postings.join(lists, ["label", "size", "key"]), "postings")
    blocks = F.ceil(F.col("length") / block)
    placed = postings.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    other = F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1))
    placed = placed.withColumn("other", other).select(
        "label", "size", "key", "node", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    task = ["label", "size", "key", "low", "high"]
    full = placed.join(index.select("node", "n", "embedding", "near"), "node")
    names = [*task, "node", "block", "n", "embedding", "near"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if held and any(row[t] != held[0][t] for t in task):
                    out += _linked(held, least, shared)
                    held = []
                held.append(row)
            yield _found(out)
        if held:
            yield _found(list(_linked(held, least, shared)))

    dealt = full.select(*names).repartition(*task).sortWithinPartitions(*task)
    found = stored(dealt.mapInArrow(compare, "node long, links long, root long"), "links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found, "node", "root")
    joined = entries.join(counts, "node", "left").join(roots, "node", "left")
    placed = stored(
        joined.select("label", "h1", "h2", "first", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "node").alias("root")),
        "placed",
    )
    least_id = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    placed = placed.join(least_id, "root").select("label", "h1", "h2", "n_links", "component_id")
    linked = rows.where("good").select("vec_id", "label", "h1", "h2").join(placed, ["label", "h1", "h2"])
    alone = rows.where(~F.col("good")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    both = linked.select("vec_id", "n_links", "component_id").union(alone)
    return both.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _found(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "links", "root"])
