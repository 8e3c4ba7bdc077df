"""Regression forests of all groups (stations, or stations and folds) at once.

Splits of nodes with more than ``small`` rows are chosen from histograms. Of nodes with more than ``middle`` rows every
level is one pass over the rows where they lie and one aggregation keyed (group, tree, node, feature, bin), whatever the
number of groups; the rows of a node below that meet in one task, which splits it on. A node with at most ``small`` rows
is finished there exactly, with every value a candidate, and many such nodes grow side by side; a group that is small
from the start skips the histograms and grows a block of trees per task. The number of jobs depends on the size of the
largest group only. The driver holds a few numbers for each node and bin of the groups with more than ``middle`` rows.

The model is a table of pieces: a split of a large node, or the arrays of a finished subtree. Rows are routed
through the pieces of their group in slices of bounded size: pieces are sent once a slice, and rows
stream behind them. To the slices of a group with large nodes go its splits only; the routed rows then meet
the one subtree of their node, so neither a group's rows nor the whole model ever lie in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazecast.models.evaluate import regression_metrics
from hazecast.models.folds import SPLITS, with_blocks
from hazecast.operators.layout import Series
from hazecast.schemas import FEATURES, TARGET
from hazecast.session import stored

SMALL = 20_000
MIDDLE = 500_000  # rows of a node that one task splits on
BINS = 128
CELLS = 2_000_000  # sums a task holds at once
WORK = 200_000  # rows whose trees grow side by side
BLOCK = 13  # trees a task grows from the same rows
SLICE = 50_000  # rows scored behind one copy of the pieces
ROUTE = 200_000  # rows routed behind one copy of the splits
REFIT = 0

PIECES = T.StructType(
    [
        T.StructField("tree", T.IntegerType()),
        T.StructField("node", T.LongType()),
        T.StructField("feature", T.ArrayType(T.IntegerType())),
        T.StructField("threshold", T.ArrayType(T.DoubleType())),
        T.StructField("left", T.ArrayType(T.IntegerType())),
        T.StructField("value", T.ArrayType(T.DoubleType())),
    ]
)
PIECE = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PIECES)
# chances that a row is drawn 0, 1, 2, ... times when n rows are drawn from n
_DRAWS = np.cumsum([np.exp(-1.0) / f for f in (1, 1, 2, 6, 24, 120, 720, 5040)])


def _mixed(values: np.ndarray, tree: int) -> np.ndarray:
    """Uniform numbers in [0, 1) from row hashes, another set for every tree."""
    with np.errstate(over="ignore"):
        x = values.view(np.uint64) + np.uint64(tree + 1) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53)


def draws(ids: np.ndarray, tree: int, bootstrap: bool) -> np.ndarray:
    """How often each row is in the sample of a tree; the same wherever the row lies."""
    if not bootstrap:
        return np.ones(len(ids))
    return np.searchsorted(_DRAWS, _mixed(ids, tree), "right").astype(float)


Trees = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def grown(x: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int) -> tuple[list[int], list[float], list[int], list[float]]:
    """Feature, threshold, left child and mean of every node of one tree; the right child follows the left.

    Of equally good splits the first feature and the lowest value win. A node is a leaf (feature -1) at
    ``depth``, with one value of y, or if no feature has two values.
    """
    drawn = w > 0
    if not drawn.any():
        return [-1], [0.0], [-1], [0.0]
    _, trees = grown_together(x[drawn], y[drawn], w[drawn], np.array([drawn.sum()]), np.array([depth]))
    return tuple(c.tolist() for c in trees)


def grown_together(x: np.ndarray, y: np.ndarray, w: np.ndarray, sizes: np.ndarray, depths: np.ndarray) -> tuple[np.ndarray, Trees]:
    """:func:`grown` for each stretch of ``sizes`` rows, none empty or of weight 0: where the nodes of each tree
    begin, and the trees one after another.

    All nodes of a level are split at once, and each by its own rows alone: a tree is the same whatever grows beside it.
    """
    p, even = x.shape[1], bool((w == 1).all())
    columns = np.column_stack((x.T, np.full(p, np.nan)))  # one row more, of no weight and above or below none, fills nodes up
    w = np.append(w, 0.0)
    root, most, made = np.arange(len(sizes)), np.array(depths), np.ones(len(sizes), np.int64)
    own = np.repeat(root, sizes)
    order = np.stack([np.lexsort((c, own)) for c in x.T])  # rows of each node, by each feature
    levels = []
    while len(root):
        begin = np.cumsum(sizes) - sizes
        rows, node = order[0], np.repeat(np.arange(len(root)), sizes)
        weight, ys = w[rows], y[rows]
        total = np.add.reduceat(weight, begin)
        mean = np.add.reduceat(weight * ys, begin) / total
        centred = np.zeros(len(w))  # centred: nothing cancels
        centred[rows] = weight * (ys - mean[node])
        open_ = (most > 0) & (sizes > 1) & (np.minimum.reduceat(ys, begin) != np.maximum.reduceat(ys, begin))
        feature, threshold, left = np.full(len(root), -1), np.zeros(len(root)), np.full(len(root), -1)
        at = np.flatnonzero(open_)
        kind = np.ceil(np.log2(sizes[at])).astype(int)
        filled = np.column_stack((order, np.full(p, len(y))))
        for k in np.unique(kind):  # nodes of about one size side by side
            some = at[kind == k]
            feature[some], threshold[some] = _cuts(columns, None if even else w, centred, filled, begin[some], sizes[some], total[some])
        cut = np.flatnonzero(feature >= 0)
        first = np.searchsorted(root[cut], root[cut])
        left[cut] = made[root[cut]] + 2 * (np.arange(len(cut)) - first)
        np.add.at(made, root[cut], 2)
        levels.append((root, feature, threshold, left, mean))
        stays = feature[node] >= 0
        if not stays.all():
            order, rows, node = order[:, stays], rows[stays], node[stays]
        if not len(cut):
            break
        place = np.empty(len(feature), np.int64)
        place[cut] = np.arange(len(cut))
        node = place[node]
        low = np.zeros(len(y), bool)
        low[rows] = columns[feature[cut][node], rows] <= threshold[cut][node]
        size = sizes[cut]
        begin = np.cumsum(size) - size
        lows = np.add.reduceat(low[rows].astype(np.int64), begin)
        sides = np.empty_like(order)
        ahead = np.arange(len(rows)) < (begin + lows)[node]  # the places of the left child's rows
        for j in range(p):
            goes = low[order[j]]
            sides[j][ahead], sides[j][~ahead] = order[j][goes], order[j][~goes]
        order = sides
        sizes = np.column_stack((lows, size - lows)).ravel()
        root, most = np.repeat(root[cut], 2), np.repeat(most[cut] - 1, 2)
    roots, *trees = (np.concatenate(c) for c in zip(*levels, strict=True))
    by_root = np.argsort(roots, kind="stable")
    return np.searchsorted(roots[by_root], np.arange(len(made) + 1)), tuple(c[by_root] for c in trees)


def _cuts(
    columns: np.ndarray, w: np.ndarray | None, centred: np.ndarray, order: np.ndarray, begin: np.ndarray, sizes: np.ndarray, total: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Feature (-1 where there is none) and threshold of the best split of each node; no ``w``, all weigh 1."""
    step = np.arange(sizes.max())
    at = np.where(step < sizes[:, None], begin[:, None] + step, order.shape[1] - 1)
    best, where, cuts = np.full(len(sizes), -1.0), np.full(len(sizes), -1), np.zeros(len(sizes))
    every = np.arange(len(sizes))
    with np.errstate(divide="ignore", invalid="ignore"):
        if w is None:
            n = step[1:].astype(float)
            share = 1 / n + 1 / (total[:, None] - n)
        for j, column in enumerate(columns):
            rows = order[j][at]
            values = column[rows]
            if w is not None:
                n = np.cumsum(w[rows], axis=1)[:, :-1]
                share = 1 / n + 1 / (total[:, None] - n)
            s = np.cumsum(centred[rows], axis=1)[:, :-1]
            gain = np.where(values[:, 1:] > values[:, :-1], s * s * share, -1.0)
            i = gain.argmax(axis=1)
            found = gain[every, i]
            better = (found > best) | (np.isnan(found) & ~np.isnan(best))
            a, b = values[every, i], values[every, i + 1]
            middle = (a + b) / 2
            best[better], where[better], cuts[better] = found[better], j, np.where(middle < b, middle, a)[better]
    return where, cuts


def descended(bins: np.ndarray, y: np.ndarray, w: np.ndarray, node: int, depth: int, small: int) -> tuple[list[tuple], list[tuple]]:
    """The large nodes below ``node`` as (node, feature, bin, mean), split by histograms, feature -1 for a leaf, and
    the small ones as (node, their rows); ``depth`` is what is left below ``node``."""
    made, ended, now = [], [], [(node, np.flatnonzero(w > 0))]
    while now:
        below = []
        for node, rows in now:
            if len(rows) <= small and node > 1:  # a group is large by all its rows, drawn or not
                ended.append((node, rows))
                continue
            weight, wy = w[rows], w[rows] * y[rows]
            total, whole = weight.sum(), wy.sum()
            best, feature, bin_ = 0.0, -1, 0
            for j in range(bins.shape[1] if depth else 0):
                of = bins[rows, j]
                n, m, s = (np.cumsum(np.bincount(of, v, BINS)) for v in (None, weight, wy))
                s = s - m * (whole / total)
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where((n > 0) & (n < len(rows)), s * s * (1 / m + 1 / (total - m)), -1.0)
                if gain.max() > best:
                    best, feature, bin_ = gain.max(), j, int(gain.argmax())
            made.append((node, feature, bin_, whole / total))
            if feature >= 0:
                goes = bins[rows, feature] <= bin_
                below += [(2 * node, rows[goes]), (2 * node + 1, rows[~goes])]
        now, depth = below, depth - 1
    return made, ended


def walked(piece: tuple[np.ndarray, ...], x: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """Value of the leaf that each row ends in, from the first node or the row's own ``start``."""
    feature, threshold, left, value = piece
    at = np.zeros(len(x), np.int64) if start is None else start.copy()
    while len(open_ := np.flatnonzero(feature[at] >= 0)):
        node = at[open_]
        at[open_] = left[node] + (x[open_, feature[node]] > threshold[node])
    return value[at]


class Pieces:
    """The pieces of one group, by tree: splits of large nodes, and finished subtrees."""

    def __init__(self) -> None:
        self.splits: dict[int, list[tuple[int, int, float]]] = {}
        self.subtrees: dict[tuple[int, int], tuple[np.ndarray, ...]] = {}
        self.open: dict[tuple[int, int], int] = {}

    def add(self, row: dict) -> None:
        tree, node = row["tree"], row["node"]
        if not _filled(row["feature"]):
            self.open[tree, node] = len(self.open)
        elif not _filled(row["left"]):
            self.splits.setdefault(tree, []).append((node, row["feature"][0], row["threshold"][0]))
        else:
            self.subtrees[tree, node] = tuple(np.asarray(row[c]) for c in ("feature", "threshold", "left", "value"))

    def add_all(self, rows: pa.RecordBatch) -> None:
        kinds = [f.name for f in PIECES if isinstance(f.dataType, T.ArrayType)]
        lists = {c: _lists(rows.column(c)) for c in kinds}
        for i, (tree, node) in enumerate(zip(rows.column("tree").to_pylist(), rows.column("node").to_pylist(), strict=True)):
            self.add({"tree": tree, "node": node, **{c: own[i] for c, own in lists.items()}})

    def routed(self, tree: int, x: np.ndarray) -> np.ndarray:
        """The node below all splits that each row comes to."""
        at = np.ones(len(x), np.int64)
        if own := sorted(self.splits.get(tree, ())):
            nodes, feature, threshold = (np.array(c) for c in zip(*own, strict=True))
            while True:
                place = np.minimum(np.searchsorted(nodes, at), len(nodes) - 1)
                open_ = np.flatnonzero(nodes[place] == at)
                if not len(open_):
                    break
                k = place[open_]
                at[open_] = 2 * at[open_] + (x[open_, feature[k]] > threshold[k])
        return at

    def predicted(self, x: np.ndarray) -> np.ndarray:
        """Mean over the trees; nan if the group has none."""
        trees = sorted({tree for tree, _ in self.subtrees})
        total = np.zeros(len(x))
        for tree in trees:
            at = self.routed(tree, x)
            for node in np.unique(at):
                rows = at == node
                total[rows] += walked(self.subtrees[tree, int(node)], x[rows])
        return total / len(trees) if trees else np.full(len(x), np.nan)


def predicted_together(held: list[Pieces], sizes: list[int], x: np.ndarray) -> np.ndarray:
    """:meth:`Pieces.predicted` for one stretch of rows after another, each by its own pieces, which are whole trees."""
    trees, total = [sorted(h.subtrees) for h in held], np.zeros(len(x))
    many, sizes = np.array([len(t) for t in trees]), np.array(sizes)
    for k in range(many.max(initial=0)):
        own = np.flatnonzero(many > k)
        pieces = [held[i].subtrees[trees[i][k]] for i in own]
        lengths = np.array([len(f) for f, *_ in pieces])
        begin = np.cumsum(lengths) - lengths
        feature, threshold, left, value = (np.concatenate(c) for c in zip(*pieces, strict=True))
        rows = np.flatnonzero(np.repeat(many > k, sizes))
        joined = feature, threshold, left + np.repeat(begin, lengths), value
        total[rows] += walked(joined, x[rows], np.repeat(begin, sizes[own]))
    with np.errstate(invalid="ignore"):
        return total / np.where(many, many, np.nan).repeat(sizes)


def _group(df: DataFrame, by: list[str]) -> Column:
    """One text for each group, never null."""
    if len(by) == 1 and df.schema[by[0]].dataType == T.StringType():
        return F.coalesce(F.concat(F.lit("="), by[0]), F.lit(""))
    return F.to_json(F.struct(*by))


def _filled(values: list | np.ndarray | None) -> bool:
    return values is not None and len(values) > 0


def _lists(column: pa.Array) -> list[np.ndarray]:
    ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))
    return np.split(column.flatten().to_numpy(zero_copy_only=False), ends[:-1])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _stretches(*columns: pa.Array) -> np.ndarray:
    """Where stretches of equal rows begin, and the end."""
    n = len(columns[0])
    changed = [pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy(zero_copy_only=False) for c in columns]
    return np.concatenate(([0], np.flatnonzero(reduce(np.logical_or, changed)) + 1, [n]))


def _by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.RecordBatch]]:
    for batch in batches:
        found = batch.column("_g").dictionary_encode()
        codes, names = found.indices.to_numpy(), found.dictionary.to_pylist()
        for k, group in enumerate(names):
            yield group, batch if len(names) == 1 else batch.take(pa.array(np.flatnonzero(codes == k)))


Use = Callable[[list[tuple[Pieces, pa.RecordBatch]]], Iterator[pa.RecordBatch]]


def _behind_pieces(rows: DataFrame, sizes: DataFrame, pieces: DataFrame, use: Use, schema: T.StructType | str, most: int = SLICE) -> DataFrame:
    """``use`` on the rows, with ``x``, of each slice of a group behind the group's pieces, for several slices at a time.
    A group has as many slices as ``most`` rows a slice ask for."""
    kept = [c for c in rows.columns if c != "_g"]
    many = F.broadcast(sizes.where(F.col("n") > most).select("_g", F.ceil(F.col("n") / most).cast("long").alias("_slices")))  # one row for more than ``most``
    slices = F.coalesce("_slices", F.lit(1).cast("long"))
    # empty arrays, never null ones: each null in an array column costs Arrow's writer a pass over its batch
    empty = [_blank(f.dataType).alias(f.name) for f in PIECES]
    rows = rows.join(many, "_g", "left")
    body = rows.select("_g", F.pmod(F.xxhash64("x"), slices).alias("_slice"), F.lit(1).alias("_kind"), *empty, *[F.col(f"`{c}`") for c in kept])
    nothing = [_blank(rows.schema[c].dataType).alias(c) for c in kept]
    sent = [F.coalesce(f.name, _blank(f.dataType)).alias(f.name) for f in PIECES]
    every = F.explode(F.sequence(F.lit(0).cast("long"), slices - 1)).alias("_slice")
    heads = pieces.join(many, "_g", "left").select("_g", every, F.lit(0).alias("_kind"), *sent, *nothing)
    order = ["_g", "_slice", "_kind"]
    together = heads.union(body).repartition("_g", "_slice").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, Pieces()
        for batch in batches:
            if not batch.num_rows:
                continue
            edges, parts = _stretches(*(batch.column(c) for c in order)).tolist(), []
            for a, b in zip(edges, edges[1:], strict=False):
                group, slice_, kind = (batch.column(c)[a].as_py() for c in order)
                if (group, slice_) != now:
                    now, held = (group, slice_), Pieces()
                part = batch.slice(a, b - a)
                if kind:
                    parts.append((held, part.select(["_g", "_slice", *kept])))
                else:
                    held.add_all(part.select(PIECES.names))
            if parts:
                yield from use(parts)

    return together.mapInArrow(run, schema)


def _total(rows: str | Column, field: str) -> Column:
    """Sum of a field of an array of structs, in its order."""
    return F.aggregate(rows, F.lit(0).cast("long" if field == "n" else "double"), lambda acc, r: acc + r[field])


def _best_splits(sums: DataFrame) -> DataFrame:
    """(_g, tree, node, feature, bin, mean, sides) of the best split of each node, with (node, n, mean) of its
    children; feature and sides are null where there is none. A feature has BINS bins at most."""
    key = ["_g", "tree", "node"]
    own = F.array_sort(F.collect_list(F.struct("bin", "n", "w", "wy"))).alias("bins")
    # each feature's bins hold all rows of the node: no second reading of the sums
    totals = [_total("bins", c).alias(f"all_{c}") for c in ("n", "w", "wy")]
    lists = sums.groupBy(*key, "feature").agg(own).select("*", *totals)
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("w"), F.lit(0.0).alias("wy"), F.lit(-1.0).alias("gain"), F.lit(-1).alias("bin"), F.lit(0).cast("long").alias("left_n"), F.lit(0.0).alias("left_w"), F.lit(0.0).alias("left_wy"))

    def step(acc, b):
        n, w, wy = acc["n"] + b["n"], acc["w"] + b["w"], acc["wy"] + b["wy"]
        s = wy - w * F.col("all_wy") / F.col("all_w")
        gain = F.when(n < F.col("all_n"), s * s * (1 / w + 1 / (F.col("all_w") - w))).otherwise(-1.0)
        better = gain > acc["gain"]
        return F.struct(
            n.alias("n"), w.alias("w"), wy.alias("wy"), F.when(better, gain).otherwise(acc["gain"]).alias("gain"),
            F.when(better, b["bin"]).otherwise(acc["bin"]).alias("bin"),
            *[F.when(better, v).otherwise(acc[f"left_{c}"]).alias(f"left_{c}") for c, v in (("n", n), ("w", w), ("wy", wy))],
        )

    each = lists.withColumn("best", F.aggregate("bins", zero, step))
    chosen = F.struct(F.col("best.gain").alias("gain"), (-F.col("feature")).alias("first"), "best", "all_n", "all_w", "all_wy")
    found = each.groupBy(*key).agg(F.max(chosen).alias("c"))
    split, n, w, wy = F.col("c.gain") > 0, F.col("c.best.left_n"), F.col("c.best.left_w"), F.col("c.best.left_wy")
    left = F.struct((2 * F.col("node")).alias("node"), n.alias("n"), F.try_divide(wy, w).alias("mean"))
    right = F.struct(
        (2 * F.col("node") + 1).alias("node"), (F.col("c.all_n") - n).alias("n"), F.try_divide(F.col("c.all_wy") - wy, F.col("c.all_w") - w).alias("mean")
    )
    mean = (F.col("c.all_wy") / F.col("c.all_w")).alias("mean")
    return found.select(*key, F.when(split, -F.col("c.first")).alias("feature"), F.col("c.best.bin").alias("bin"), mean, F.when(split, F.array(left, right)).alias("sides"))


def _nothing(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _blank(kind: T.DataType) -> Column:
    return (F.array() if isinstance(kind, T.ArrayType) else F.lit(None)).cast(kind)


Edges = dict[str, list[np.ndarray]]


def _edges(rows: DataFrame, p: int) -> Edges:
    """Upper ends of the bins of each feature, by group."""
    shares = [i / BINS for i in range(1, BINS)]
    cuts = [F.array_distinct(F.percentile_approx(F.col("x")[j], shares, 20 * BINS)).alias(f"e{j}") for j in range(p)]
    return {r[0]: [np.array(e) for e in r[1:]] for r in rows.groupBy("_g").agg(*cuts).collect()}


def own_edges(x: np.ndarray) -> list[np.ndarray]:
    """The same from all rows of a group."""
    ranks = np.ceil(np.arange(1, BINS) * len(x) / BINS).astype(int) - 1
    return [np.unique(np.sort(c)[ranks]) for c in x.T]


def _bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)])


def _histograms(rows: DataFrame, edges: Edges, tops: dict[str, Pieces], nodes: list[tuple[str, int, int]], p: int, bootstrap: bool) -> DataFrame:
    """(_g, tree, node, feature, bin, n, w, wy) of some (group, tree, node), by one reading of the rows."""
    wanted: dict[str, dict[int, list[int]]] = {}
    for group, tree, node in sorted(nodes):
        wanted.setdefault(group, {}).setdefault(tree, []).append(node)
    tops, edges = {g: tops[g] for g in wanted}, {g: edges[g] for g in wanted}

    def told(group: str, sums: np.ndarray) -> pa.RecordBatch:
        code = np.flatnonzero(sums[0])
        own = [(t, n) for t, some in wanted[group].items() for n in some]
        tree, node = np.array(own, np.int64)[code // (p * BINS)].T
        return pa.RecordBatch.from_arrays(
            [pa.array([group] * len(code), pa.string()), pa.array(tree.astype(np.int32)), pa.array(node), pa.array((code // BINS % p).astype(np.int32)),
             pa.array((code % BINS).astype(np.int32)), pa.array(sums[0][code].astype(np.int64)), pa.array(sums[1][code]), pa.array(sums[2][code])],
            ["_g", "tree", "node", "feature", "bin", "n", "w", "wy"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for group, batch in _by_group(batches):
            if group not in wanted:
                continue
            if group not in sums:
                sums[group] = np.zeros((3, p * BINS * sum(map(len, wanted[group].values()))))
            x, y, ids, begin = _matrix(batch.column("x"), p), batch.column("y").to_numpy(), batch.column("id").to_numpy(), 0
            bins = _bins(x, edges[group])
            for tree, own in wanted[group].items():
                at, w = tops[group].routed(tree, x), draws(ids, tree, bootstrap)
                place = np.minimum(np.searchsorted(own, at), len(own) - 1)
                in_ = np.flatnonzero((np.array(own)[place] == at) & (w > 0))
                code = ((place[in_, None] * p + np.arange(p)) * BINS + bins[in_]).ravel()
                size = len(own) * p * BINS
                for k, v in enumerate((np.ones(len(in_)), w[in_], w[in_] * y[in_])):
                    sums[group][k, begin : begin + size] += np.bincount(code, np.repeat(v, p), size)
                begin += size
        for group, own in sums.items():
            yield told(group, own)

    schema = "_g string, tree int, node long, feature int, bin int, n long, w double, wy double"
    sums = rows.select("_g", "x", "y", "id").mapInArrow(run, schema)
    return sums.groupBy("_g", "tree", "node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in ("n", "w", "wy")])


def _top(rows: DataFrame, edges: Edges, p: int, trees: int, depth: int, middle: int, bootstrap: bool) -> tuple[dict[str, Pieces], list[tuple]]:
    """Splits of the nodes with more than ``middle`` rows, by group, and the pieces they make: (_g, tree, node, feature,
    threshold, mean), feature -1 for a leaf, which stays open in the former."""
    tops, made = {g: Pieces() for g in edges}, []
    now = [(g, t, 1) for g in edges for t in range(trees)]
    most = max(1, CELLS // (p * BINS))
    for level in range(max(depth, 1)):
        found = [r for k in range(0, len(now), most) for r in _best_splits(_histograms(rows, edges, tops, now[k : k + most], p, bootstrap)).collect()]
        large = []
        for r in found:
            group, held = r["_g"], tops[r["_g"]]
            if r.feature is None or not depth:
                made.append((group, r.tree, r.node, -1, 0.0, r.mean))
                held.open[r.tree, r.node] = len(held.open)
                continue
            cut = float(edges[group][r.feature][r.bin])
            made.append((group, r.tree, r.node, r.feature, cut, r.mean))
            held.splits.setdefault(r.tree, []).append((r.node, r.feature, cut))
            large += [(group, r.tree, s.node, s.mean) for s in r.sides if s.n > middle]
        if level == depth - 1:  # large leaves are never gathered
            for group, tree, node, mean in large:
                made.append((group, tree, node, -1, 0.0, mean))
                tops[group].open[tree, node] = len(tops[group].open)
        now = [s[:3] for s in large]
        if not now:
            break
    return tops, made


def _to_units(rows: DataFrame, tops: dict[str, Pieces], p: int, trees: int, bootstrap: bool) -> DataFrame:
    """Rows of groups with a top, for every tree that draws them, with the node that they come to."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, batch in _by_group(batches):
            x, ids = _matrix(batch.column("x"), p), batch.column("id").to_numpy()
            for tree in range(trees):
                at = tops[group].routed(tree, x)
                leaves = [n for t, n in tops[group].open if t == tree]
                take = np.flatnonzero((draws(ids, tree, bootstrap) > 0) & ~np.isin(at, leaves))
                own = batch.take(pa.array(take))
                added = [pa.array(np.full(len(take), tree, np.int32)), pa.array(np.full(len(take), tree + 1, np.int32)), pa.array(at[take])]
                yield pa.RecordBatch.from_arrays([*(own.column(c) for c in names), *added], [*names, "first", "stop", "node"])

    told = [T.StructField("first", T.IntegerType()), T.StructField("stop", T.IntegerType()), T.StructField("node", T.LongType())]
    return rows.mapInArrow(run, T.StructType([*rows.schema, *told]))


def _grown(units: DataFrame, edges: Edges, p: int, depth: int, small: int, bootstrap: bool) -> DataFrame:
    """Pieces of the trees from ``first`` to before ``stop``, below the nodes of ``units``."""
    by = units.schema["by"].dataType
    told = T.StructType([T.StructField("by", by), *PIECES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, enough = [], 0, WORK
        for batch in chain(batches, [None]):
            if batch is not None:
                held.append(batch)
                n += batch.num_rows
            if not n or (batch is not None and n < enough):
                continue
            table = pa.Table.from_batches(held)
            ends = _stretches(*(_whole(table, c) for c in ("_g", "first", "node")))
            if batch is not None:  # rows of the last unit may follow
                ends = ends[:-1]
            if len(ends) > 1:
                yield from trees_of(table.slice(0, ends[-1]), ends)
            held, n = table.slice(ends[-1]).to_batches(), n - int(ends[-1])
            enough = max(WORK, 2 * n)

    def trees_of(table: pa.Table, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        x, y, ids = _matrix(_whole(table, "x"), p), _whole(table, "y").to_numpy(), _whole(table, "id").to_numpy()
        order = np.lexsort((y, ids, np.repeat(np.arange(len(ends) - 1), np.diff(ends))))  # sums don't depend on the order of arrival
        x, y, ids = x[order], y[order], ids[order]
        groups, first, stop, nodes = (_whole(table, c).take(pa.array(ends[:-1])).to_pylist() for c in ("_g", "first", "stop", "node"))
        names = _whole(table, "by")
        found, many, splits = [], 0, []
        for a, b, group, begin, end, node in zip(ends[:-1].tolist(), ends[1:].tolist(), groups, first, stop, nodes, strict=True):
            cuts = edges.get(group) or (own_edges(x[a:b]) if b - a > small else None)
            bins = _bins(x[a:b], cuts) if b - a > small else None
            for tree in range(begin, end):
                w = draws(ids[a:b], tree, bootstrap)
                if not w.any():  # no row of a tiny group was drawn: all are taken
                    w[:] = 1.0
                ended = [(node, np.flatnonzero(w > 0))]
                if bins is not None:
                    made, ended = descended(bins, y[a:b], w, node, depth - _level(node), small)
                    splits += [(a, tree, at, j, float(cuts[j][k]) if j >= 0 else 0.0, mean) for at, j, k, mean in made]
                for at, rows in ended:
                    found.append((a, tree, at, rows + a, w[rows]))
                    many += len(rows)
                if many >= WORK:
                    yield finished(names, found, x, y)
                    found, many = [], 0
        if found:
            yield finished(names, found, x, y)
        if splits:
            at, *made = zip(*splits, strict=True)
            yield pa.RecordBatch.from_arrays([names.take(pa.array(at)), *_split_pieces(*made)], told.names)

    def finished(names: pa.Array, found: list[tuple], x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
        at, tree, node, rows, weights = zip(*found, strict=True)
        sizes, every = np.array([len(r) for r in rows]), np.concatenate(rows)
        begins, trees = grown_together(x[every], y[every], np.concatenate(weights), sizes, np.array([depth - _level(n) for n in node]))
        offsets, kinds = pa.array(begins.astype(np.int32)), (np.int32, float, np.int32, float)
        lists = [pa.ListArray.from_arrays(offsets, pa.array(c.astype(k))) for c, k in zip(trees, kinds, strict=True)]
        return pa.RecordBatch.from_arrays([names.take(pa.array(at)), pa.array(tree, pa.int32()), pa.array(node, pa.int64()), *lists], told.names)

    together = units.repartition("_g", "first", "node").sortWithinPartitions("_g", "first", "node")
    return together.mapInArrow(run, told)


def _split_pieces(tree: tuple, node: tuple, feature: tuple, threshold: tuple, mean: tuple) -> list[pa.Array]:
    """PIECES of splits, and of leaves, whose feature is -1."""
    left = pa.array([[-1] if f < 0 else None for f in feature], pa.list_(pa.int32()))
    lists = [pa.array([[v] for v in c], pa.list_(k)) for c, k in ((feature, pa.int32()), (threshold, pa.float64()), (mean, pa.float64()))]
    return [pa.array(tree, pa.int32()), pa.array(node, pa.int64()), *lists[:2], left, lists[2]]


def _whole(table: pa.Table, name: str) -> pa.Array:
    return pa.concat_arrays(table.column(name).chunks)


def _level(node: int) -> int:
    return node.bit_length() - 1


def fit_forest(
    df: DataFrame,
    features: list[str] = FEATURES,
    target: str = TARGET,
    series: Series = Series(),
    *,
    by: list[str] | None = None,
    trees: int = 100,
    depth: int = 30,
    bootstrap: bool = True,
    small: int = SMALL,
    middle: int = MIDDLE,
    seed: int = 42,
) -> DataFrame:
    """Pieces of the forests of all groups ``by`` (the station if omitted), fitted on complete rows.

    Draws are hashes of station, time, tree and ``seed``: they don't depend on partitioning. A group of one
    row is a single leaf; rows without station, time, target or a feature are left out; no rows, no pieces.
    """
    by, p, middle = by or [series.key], len(features), max(small, middle)
    numbers = [F.col(c).cast("double") for c in (*features, target)]
    usable = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*by, series.time, *features, target)])
    row_id = F.xxhash64(F.lit(seed), series.key, series.time)
    # rows hand the columns ``by`` on to the pieces, which never meet a table of the groups
    rows = df.where(usable).select(_group(df, by).alias("_g"), F.struct(*by).alias("by"), F.array(*numbers[:-1]).alias("x"), numbers[-1].alias("y"), row_id.alias("id"))
    rows = stored(rows, "rows")
    sizes = rows.groupBy("_g", "by").agg(F.count("*").alias("n"))
    large = sizes.where(F.col("n") > middle).select("_g", "by").collect()  # one row for more than ``middle``
    first = F.explode(F.sequence(F.lit(0), F.lit(trees - 1), F.lit(BLOCK))).alias("first")
    spark, edges, units = df.sparkSession, {}, rows
    if large:
        named = spark.createDataFrame(large, rows.select("_g", "by").schema)
        units = rows.join(F.broadcast(named.select("_g")), "_g", "left_anti")
    units = units.select("*", first).select("*", F.least(F.col("first") + BLOCK, F.lit(trees)).alias("stop"), F.lit(1).cast("long").alias("node"))
    if large:
        rows = stored(rows.join(F.broadcast(named.select("_g")), "_g"), "large")
        edges = _edges(rows, p)
        tops, made = _top(rows, edges, p, trees, depth, middle, bootstrap)
        units = units.union(_to_units(rows, tops, p, trees, bootstrap))
    pieces = stored(_grown(units, edges, p, depth, small, bootstrap), "forest")
    if large:
        group, *rest = zip(*made, strict=True)
        names = {r["_g"]: r["by"] for r in large}
        columns = [[names[g] for g in group], *(c.to_pylist() for c in _split_pieces(*rest))]
        pieces = pieces.union(spark.createDataFrame(list(zip(*columns, strict=True)), pieces.schema))
    return pieces.select("by.*", *PIECES.names)


def score_forest(
    df: DataFrame,
    pieces: DataFrame,
    features: list[str] = FEATURES,
    series: Series = Series(),
    *,
    by: list[str] | None = None,
    name: str = "random_forest_pred",
) -> DataFrame:
    """All rows of ``df`` with the mean prediction of their group's trees; null where the row is incomplete or its
    group has no forest. One plan whatever the groups: rows are shuffled once, beside a count of each group. Where
    a forest has large nodes, its rows are shuffled to their nodes; with several trees its distinct rows, each tree apart."""
    by, p = by or [series.key], len(features)
    filled = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features])
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in features])
    fields = [f for f in df.schema if f.name != name]
    # as one column, the frame's own cannot clash with those used here
    whole = F.struct(*[F.col(f"`{f.name}`") for f in fields]).alias("row")
    rows = df.select(_group(df, by).alias("_g"), whole, filled.alias("x"), complete.alias("complete"))
    sizes = df.groupBy(_group(df, by).alias("_g")).agg(F.count("*").alias("n"))
    trained = pieces.select(_group(pieces, by).alias("_g"), *PIECES.names)
    schema = T.StructType([*fields, T.StructField(name, T.DoubleType())])

    def predict(parts: list[tuple[Pieces, pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
        held, batches = zip(*parts, strict=True)
        table = pa.Table.from_batches(batches)
        found = predicted_together(held, [b.num_rows for b in batches], _matrix(_whole(table, "x"), p))
        known = _whole(table, "complete").to_numpy(zero_copy_only=False) & ~np.isnan(found)
        yield pa.RecordBatch.from_arrays([*_whole(table, "row").flatten(), pa.array(found, mask=~known)], schema.names)

    names = [F.col(f"`{f.name}`") for f in fields]
    deep = trained.groupBy("_g").agg(F.bool_or(F.col("left").isNull()).alias("deep"), (F.min("tree") == F.max("tree")).alias("lone"))
    deep = deep.where("deep").select("_g", "lone")
    kinds = deep.agg(F.count("*"), F.bool_and("lone")).first()
    if not kinds[0]:
        return _behind_pieces(rows, sizes, trained, predict, schema).select(*names, name)
    # a group with splits has a model of the size of its rows: each row is sent to its nodes instead
    deep = F.broadcast(deep)
    marked = rows.join(deep, "_g", "left")
    below = F.col("lone").isNotNull() & F.col("complete")
    near, far = (marked.where(part).drop("lone") for part in (~below, below))
    shallow, own = trained.join(deep, "_g", "left_anti"), trained.join(deep.drop("lone"), "_g")
    if kinds[1]:  # a row of a single tree has one node: it goes there whole
        there = stored(_at_nodes(far, sizes, own, p), "routed")
        held = sizes.union(there.groupBy("_g").agg(F.count("*").alias("n")))
        pieces = shallow.union(_subtrees(own))
        return _behind_pieces(near.union(there), held, pieces, predict, schema).select(*names, name)
    found = _deep_predictions(far.select("_g", "x").distinct(), sizes, own, p)
    far = far.join(found, ["_g", "x"], "left").select("row.*", F.col("_pred").alias(name))
    return _behind_pieces(near, sizes, shallow, predict, schema).select(*names, name).union(far)


def _light(pieces: DataFrame) -> DataFrame:
    """Pieces of groups with splits, of the subtrees no more than where they begin."""
    arrays = [F.when(F.col("left").isNull(), F.col(f.name)).alias(f.name) for f in PIECES[2:]]
    return pieces.select("_g", "tree", "node", *arrays)


def _subtrees(pieces: DataFrame) -> DataFrame:
    """The subtrees, each as the tree of its own group."""
    return pieces.where(F.col("left").isNotNull()).select(_place().alias("_g"), *PIECES.names)


def _at_nodes(rows: DataFrame, sizes: DataFrame, pieces: DataFrame, p: int) -> DataFrame:
    """Rows of groups with one tree, with the place of their node as group."""
    names = rows.columns

    def route(parts: list[tuple[Pieces, pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
        for held, batch in parts:
            (tree,), group = {t for t, _ in held.open}, batch.column("_g")[0].as_py()
            nodes, place = np.unique(held.routed(tree, _matrix(batch.column("x"), p)), return_inverse=True)
            places = pa.array([f"{tree}/{node}/{group}" for node in nodes.tolist()]).take(pa.array(place))
            yield pa.RecordBatch.from_arrays([places if c == "_g" else batch.column(c) for c in names], names)

    return _behind_pieces(rows, sizes, _light(pieces), route, rows.schema, ROUTE)


def _place() -> Column:
    return F.concat_ws("/", "tree", "node", "_g")


def _deep_predictions(rows: DataFrame, sizes: DataFrame, pieces: DataFrame, p: int) -> DataFrame:
    """(_g, x, _pred) of distinct rows (_g, x): routed by the splits, then each valued by the subtrees of its nodes."""
    def route(parts: list[tuple[Pieces, pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
        for held, batch in parts:
            x = _matrix(batch.column("x"), p)
            for tree in sorted({t for t, _ in held.open}):
                columns = [batch.column("_g"), batch.column("x"), pa.array(np.full(len(x), tree, np.int32)), pa.array(held.routed(tree, x))]
                yield pa.RecordBatch.from_arrays(columns, ["_g", "x", "tree", "node"])

    routed = _behind_pieces(rows, sizes, _light(pieces), route, "_g string, x array<double>, tree int, node long", ROUTE)
    routed = stored(routed.select(_place().alias("_at"), "*"), "routed").withColumnsRenamed({"_g": "group", "_at": "_g"})
    held = routed.groupBy("_g").agg(F.count("*").alias("n"))

    def value(parts: list[tuple[Pieces, pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
        held, batches = zip(*parts, strict=True)
        table = pa.Table.from_batches(batches)
        values = pa.array(predicted_together(held, [b.num_rows for b in batches], _matrix(_whole(table, "x"), p)))
        yield pa.RecordBatch.from_arrays([*(_whole(table, c) for c in ("group", "x", "in_tree")), values], ["_g", "x", "tree", "value"])

    body = routed.select("_g", "group", "x", F.col("tree").alias("in_tree"))
    valued = _behind_pieces(body, held, _subtrees(pieces), value, "_g string, x array<double>, tree int, value double")
    each = F.array_sort(F.collect_list(F.struct("tree", "value")))  # summed in the order of the trees
    return valued.groupBy("_g", "x").agg((_total(each, "value") / F.count("*")).alias("_pred"))


def cross_validated_forest(
    df: DataFrame,
    features: list[str] = FEATURES,
    target: str = TARGET,
    series: Series = Series(),
    *,
    splits: int = SPLITS,
    model: str = "random_forest",
    **settings,
) -> tuple[DataFrame, DataFrame]:
    """Pieces of every station's refit, and metrics per (station, model, fold). All folds of all stations are
    fitted together: a row is in the training set of every later fold and of the refit."""
    key = series.key
    complete = df.select(key, series.time, *features, target).dropna()
    blocked = stored(with_blocks(complete, series, splits), "blocks")
    later = F.array(*[F.when(F.col("block") < k, F.lit(k)) for k in range(1, splits + 1)], F.lit(REFIT))
    training = blocked.withColumn("fold", F.explode(F.array_compact(later)))
    pieces = fit_forest(training, features, target, series, by=[key, "fold"], **settings)
    tests = blocked.where(F.col("block") > 0).withColumnRenamed("block", "fold")
    scored = score_forest(tests, pieces, features, series, by=[key, "fold"], name="pred")
    metrics = regression_metrics(scored.withColumn("model", F.lit(model)), [key, "model", "fold"], target=target)
    return pieces.where(F.col("fold") == REFIT).drop("fold"), metrics
