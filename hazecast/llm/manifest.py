"""Merkle manifest of a dataset: one tree per source, one root over the sources, a proof per document.

Leaves are digests of rows, in order of doc_id within their source. Every three neighbours become a
node, level by level, until one node, the subroot, is left; the subroots form a tree of their own. The
levels are stored as node rows linked to their parents, each with the digests that stand left and right of
it in its run. A recursive query then climbs from every leaf along the links: each step appends a row
with the siblings met and folds a leaf's digest, tampered or not, one level up. A folded root that
equals the stored one proves the leaf.

All leaves end at the same few nodes. A node that many leaves pass is therefore stored in copies, one for
some ``SPREAD`` leaves, and a leaf passes one of them: no key of the climb's join is met by more rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazecast.llm.common import bucketed
from hazecast.llm.mixing import _ranked
from hazecast.session import stored

RUN = 3
SPREAD = 729
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = 0  # the tree of subroots; sources are trees from 1 on

RUNS = "tree long, n long, pos long, leaves long, digests array<binary>, sizes array<long>"
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"

CLIMB = """
WITH RECURSIVE climb (tree, pos, step, at_tree, at_level, at_pos, at_copy, folded, siblings, leaf, doc_id) AS (
  SELECT tree, pos, 0, at_tree, at_level, at_pos, 0L, folded, CAST(NULL AS BINARY), leaf, doc_id FROM {leaves}
  UNION ALL
  SELECT c.tree, c.pos, c.step + 1, n.up_tree, n.up_level, n.up_pos, pmod(c.pos, n.up_copies),
         unhex(sha2(lower(concat(hex(n.before), hex(c.folded), hex(n.after))), 256)), concat(n.before, n.after),
         CAST(NULL AS BINARY), CAST(NULL AS BIGINT)
  FROM climb c JOIN {nodes} n ON c.at_tree = n.tree AND c.at_level = n.level AND c.at_pos = n.pos AND c.at_copy = n.copy
)
SELECT tree, pos, step, folded, siblings, leaf, doc_id FROM climb
"""


def _digest(hexed: Column) -> Column:
    return F.unhex(F.sha2(hexed, 256))


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def leaf_digest(values: dict[str, Column]) -> Column:
    """Digest of a row: every field as its size in bytes and its value, ``-`` for null."""
    told = []
    for value in values.values():
        text = value.cast("string")
        told.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return _digest(F.concat(*told))


def tampered_text() -> Column:
    """The text without its line feeds where crc32 of doc_id is even; rows without doc_id are left alone."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def _leaves(docs: DataFrame, found: Column) -> DataFrame:
    """(tree, n, pos, source, doc_id, leaf, folded): rows in place; n leaves in the tree. ``found`` is the
    text that the check meets."""
    stored_fields = {c: F.col(c) for c in FIELDS}
    rows = docs.select("source", "doc_id", leaf_digest(stored_fields).alias("leaf"), leaf_digest(stored_fields | {"text": found}).alias("folded"))
    order = [F.col(c).asc_nulls_first() for c in ("source", "doc_id", "leaf")]
    placed = stored(_ranked(rows, order, "place", "source"), "leaves")
    sources = placed.groupBy("source").agg(F.count("*").alias("n"))
    sources = stored(_ranked(sources, [F.col("source").asc_nulls_first()], "tree"), "sources").withColumnRenamed("source", "_source")
    joined = placed.join(sources, F.col("source").eqNullSafe(F.col("_source")))
    return stored(joined.select("tree", "n", (F.col("place") - 1).alias("pos"), "doc_id", "leaf", "folded"), "placed")


def _joined(digests: Column) -> Column:
    return F.aggregate(digests, F.lit(b""), lambda a, b: F.concat(a, b))


def _node_rows(runs: DataFrame, level: int) -> DataFrame:
    """Rows of the children in ``runs``, in as many copies as leaves need that pass them."""
    many = F.posexplode("digests").alias("k", "digest")
    # above the last run of a source stands the tree of subroots
    last = (F.lit(RUN ** (level + 1)) >= F.col("n")) & (F.col("tree") != TOP)
    rows = runs.select(
        "tree",
        F.lit(level).alias("level"),
        (F.col("pos") * RUN).alias("first"),
        "digests",
        F.when(last, TOP).otherwise(F.col("tree")).alias("up_tree"),
        F.when(last, 0).otherwise(level + 1).alias("up_level"),
        F.when(last, F.col("tree") - 1).otherwise(F.col("pos")).alias("up_pos"),
        _copies(F.col("leaves")).alias("up_copies"),
        F.col("sizes"),
        many,
    )
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.element_at("sizes", F.col("k") + 1) - 1)).alias("copy")
    before = _joined(F.slice("digests", F.lit(1), F.col("k")))
    after = _joined(F.slice("digests", F.col("k") + 2, F.lit(RUN)))
    return rows.select(
        "tree", "level", (F.col("first") + F.col("k")).alias("pos"), copy, "up_tree", "up_level", "up_pos", "up_copies",
        before.alias("before"), after.alias("after"),
    )


def _copies(leaves: Column) -> Column:
    return F.ceil(leaves / SPREAD).cast("long")


def _built(level: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """Node rows of all levels of the trees in ``level`` (tree, n, pos, leaves, digest), whose largest has
    ``most`` leaves, and the last node (tree, leaves, digest) of every tree."""
    nodes, tops, k = [], [], 0
    while True:
        tops.append(level.where(F.col("n") <= RUN**k).select("tree", "leaves", "digest"))
        if RUN**k >= most:
            break
        child = F.array_sort(F.collect_list(F.struct("pos", "digest", _copies(F.col("leaves")).alias("copies"))))
        runs = level.where(F.col("n") > RUN**k).groupBy("tree", "n", F.floor(F.col("pos") / RUN).cast("long").alias("up"))
        runs = runs.agg(child.alias("children"), F.sum("leaves").alias("leaves"))
        runs = stored(
            runs.select("tree", "n", F.col("up").alias("pos"), "leaves", F.col("children.digest").alias("digests"), F.col("children.copies").alias("sizes")),
            f"runs-{k}",
        )
        nodes.append(_node_rows(runs, k))
        # the last level of one tree may be far below that of another
        level = runs.select("tree", "n", "pos", "leaves", _digest(_hex(_joined(F.col("digests")))).alias("digest"))
        k += 1
    out = tops[0]
    for own in tops[1:]:
        out = out.union(own)
    return nodes, stored(out, "tops")


def _climbed(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """(tree, pos, steps) of each leaf. The recursion has no row limit: it ends above the roots."""
    spark = leaves.sparkSession
    before = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        climb = spark.sql(CLIMB, leaves=leaves, nodes=nodes)
        steps = F.array_sort(F.collect_list(F.struct("step", "folded", "siblings", "leaf", "doc_id")))
        return stored(climb.groupBy("tree", "pos").agg(steps.alias("steps")), "climb")
    finally:
        spark.conf.set(ROW_LIMIT, before)


def proofs(docs: DataFrame, found: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof (siblings, level by level, as hex
    text), folded_root, verified. ``found``: the text that is checked against the manifest, ``text`` if omitted.

    Sources are trees, null first; leaves ascend by doc_id, null first, and equal ids by digest. Repeated
    rows are leaves of their own, each with its proof. The only document of a source is its subroot, and the
    only source the root; a proof may thus be empty. A null field differs from an empty one. Extra columns
    don't count; no documents, no rows.
    """
    spark = docs.sparkSession
    leaves = _leaves(docs, F.col("text") if found is None else found)
    most, sources = leaves.agg(F.max("n"), F.max("tree")).first()
    level = leaves.select("tree", "n", "pos", F.lit(1).cast("long").alias("leaves"), F.col("leaf").alias("digest"))
    nodes, subroots = _built(level, most or 0)
    top = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(sources).cast("long").alias("n"), (F.col("tree") - 1).alias("pos"), "leaves", "digest")
    upper, root = _built(top, sources or 0)
    root = root.first()
    root = bytes(root["digest"]).hex() if root else None
    alone = F.col("n") == 1
    starts = leaves.select(
        "tree", "pos", "doc_id", "leaf", "folded",
        F.when(alone, TOP).otherwise(F.col("tree")).alias("at_tree"),
        F.lit(0).alias("at_level"),
        F.when(alone, F.col("tree") - 1).otherwise(F.col("pos")).alias("at_pos"),
    )
    rows = reduce(DataFrame.union, nodes + upper) if nodes + upper else _node_rows(spark.createDataFrame([], RUNS), 0)
    # one exchange for all steps: every one of them joins the buckets where they lie
    whole = _climbed(starts, bucketed(rows, "nodes", "tree", "level", "pos", "copy"))
    met = F.filter("steps.siblings", lambda s: s.isNotNull())
    told = whole.select(
        "tree",
        F.element_at("steps", 1)["doc_id"].alias("doc_id"),
        _hex(F.element_at("steps", 1)["leaf"]).alias("leaf"),
        _hex(_joined(met)).alias("proof"),
        _hex(F.element_at("steps", -1)["folded"]).alias("folded_root"),
    )
    subroot = subroots.select("tree", _hex(F.col("digest")).alias("subroot"))
    out = told.join(subroot, "tree").withColumn("root", F.lit(root).cast("string"))
    return out.select("doc_id", "leaf", "subroot", "root", "proof", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
