"""Line dedup over a growing corpus: levelled sorted runs of line hashes, DataFrame functions only.

A run holds (hash, owner) for every line key that a batch of documents was the first to bring; the
owner is the least document of that batch with the key. Runs are bucketed and sorted by hash, so a
new batch shuffles its own keys alone and is merge-joined with the runs where they lie. Keys
that no run knows (the anti-join) become the batch's own run; lines of a known key, or of a key whose
owner is another document of the batch, are dropped. ``fan`` runs of a level are merged into one of
the next, so there are at most ``fan - 1`` runs a level and every key is rewritten once a level.

Runs are folders named by level and batches. A batch added again after a crash finds its own keys
with their owners, so its result is the same; what a merged run covers is not read any more.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructType

from hazecast.llm.common import fresh, opened_buckets, replaced
from hazecast.session import new_folder, stored

LEAST = 10  # code points of a key
BATCHES = 6
FAN = 3

BLANKS = " \t\n\x0b\x0c\r"  # fixed value: stripped at both ends of a line
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LAST_ID = (1 << 63) - 1
SCHEMA = StructType().add("hash", BinaryType()).add("owner", LongType())


def lines_of(text: str = "text") -> Column:
    """The lines of a text; a missing or empty one has one empty line."""
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """A line without blanks around it, A to Z in lower case."""
    bare = F.btrim(line, F.lit(BLANKS))
    ascii_only = F.octet_length(bare) == F.length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def document(doc_id: str = "doc_id") -> Column:
    """Rows without id are one document, after all others (as one with the greatest id would be)."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID))


def _mark(text: str = "text") -> Column:
    """Tells rows of one id apart by their texts."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def keyed_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(id, mark, pos, hash) of every line whose key has ``least`` code points: 128 bits a key."""
    each = docs.select(document().alias("id"), _mark().alias("mark"), F.posexplode(lines_of()).alias("pos", "line"))
    keyed = each.select("id", "mark", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.length("key") >= least).select("id", "mark", "pos", F.unhex(F.md5("key")).alias("hash"))


@dataclass
class Runs:
    """The runs below ``folder``; those of an earlier session are found by their names."""

    spark: SparkSession
    folder: str
    buckets: int
    fan: int = FAN
    tables: dict[tuple[int, int, int], DataFrame] = field(default_factory=dict)  # (level, first, last batch)

    def __post_init__(self) -> None:
        if self.fan < 2:
            raise ValueError("fan must be 2 at least")
        found = []
        if self._files().exists(self._path(self.folder)):
            for status in self._files().listStatus(self._path(self.folder)):
                name = re.fullmatch(r"level(\d+)-(\d+)-(\d+)", status.getPath().getName())
                if name and self._files().exists(self._path(f"{status.getPath()}/_SUCCESS")):
                    found.append(tuple(map(int, name.groups())))
        for run in found:
            if not any(o[0] > run[0] and o[1] <= run[1] and run[2] <= o[2] for o in found):
                self.tables[run] = self._table(run)

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def _files(self):
        return self._path(self.folder).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _at(self, run: tuple[int, int, int]) -> str:
        return f"{self.folder}/level{run[0]}-{run[1]}-{run[2]}"

    def _table(self, run: tuple[int, int, int], rows: DataFrame | None = None) -> DataFrame:
        return opened_buckets(self.spark, self._at(run), SCHEMA, ["hash"], self.buckets, rows)

    def met(self, keys: DataFrame) -> DataFrame:
        """``keys`` (one row a hash) with the owner that a run has for them, else null: one merge join a run,
        for which only ``keys`` is shuffled."""
        for i, run in enumerate(self.tables.values()):
            keys = keys.join(run.withColumnRenamed("owner", f"owner{i}").hint("merge"), "hash", "left")
        owners = [F.col(f"owner{i}") for i in range(len(self.tables))]  # no hash stands in two runs
        return keys.select("hash", "first", "last", F.coalesce(F.lit(None).cast("long"), *owners).alias("owner"))

    def add(self, batch: int, rows: DataFrame) -> None:
        """Store the new keys of a batch, then merge full levels."""
        run = (0, batch, batch)
        self.tables[run] = self._table(run, rows)
        level = 0
        while len(own := sorted(r for r in self.tables if r[0] == level)) >= self.fan:
            merged = (level + 1, own[0][1], max(r[2] for r in own))
            rows = self.tables[own[0]]
            for run in own[1:]:
                rows = rows.union(self.tables[run])
            self.tables[merged] = self._table(merged, rows.repartition(self.buckets, "hash"))
            for run in own:
                del self.tables[run]
                self._files().delete(self._path(self._at(run)), True)
            level += 1

    def covers(self, batch: int) -> bool:
        return any(first <= batch <= last for _, first, last in self.tables)


def repeated_lines(lines: DataFrame, runs: Runs, batch: int) -> DataFrame:
    """(id, mark, pos) of the lines to drop from a batch of ``keyed_lines``; its new keys join the runs.

    Batches that come later keep none of the lines that earlier ones hold, whatever their ids.
    """
    keys = lines.groupBy("hash").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    met = stored(runs.met(keys), "keys")
    if not runs.covers(batch):
        runs.add(batch, met.where("owner IS NULL").select("hash", F.col("first").alias("owner")))
    shared = met.where("owner IS NOT NULL OR first < last").select("hash", F.coalesce("owner", "first").alias("owner"))
    return stored(lines.join(shared, "hash").where("id <> owner").select("id", "mark", "pos"), "drops")


def _cuts(docs: DataFrame, batches: int) -> list[int]:
    """Ids that cut the rows into batches of about the same number of rows."""
    shares = [i / batches for i in range(1, batches)]
    found = docs.agg(F.percentile_approx(document(), shares, 10_000)).first()[0] if shares else None
    return sorted(set(found or []))


def all_repeated_lines(docs: DataFrame, batches: int = BATCHES, fan: int = FAN, least: int = LEAST) -> DataFrame:
    """(id, mark, pos) of the lines that ``docs`` loses, taken as batches of ascending ids."""
    spark = docs.sparkSession
    cuts = _cuts(docs, batches)
    batch = sum((F.when(F.col("id") > c, 1).otherwise(0) for c in cuts), F.lit(0))
    lines = stored(keyed_lines(docs, least).withColumn("batch", batch), "lines", "batch")
    runs = Runs(spark, new_folder(spark, "runs"), int(spark.conf.get("spark.sql.shuffle.partitions")), fan)
    out = None
    for i in range(len(cuts) + 1):
        own = repeated_lines(lines.where(F.col("batch") == i).drop("batch"), runs, i)
        out = own if out is None else out.union(own)
    return out


def _kept(lines: str, drops: str) -> Column:
    """The text of the lines that stand between the dropped ones."""
    begin = F.concat(F.array(F.lit(0)), F.transform(drops, lambda d: d + 1))
    end = F.concat(F.col(drops), F.array(F.size(lines)))
    pieces = F.zip_with(begin, end, lambda b, e: F.slice(lines, b + 1, e - b))
    return F.array_join(F.flatten(pieces), "\n")


def _cleaned(docs: DataFrame, batches: int, fan: int, least: int) -> tuple[DataFrame, str, str, str]:
    """``docs`` with its lines, the positions to drop (null: none) and the text that stays."""
    lines, drops, kept, own, mark = fresh(docs, "_lines", "_drops", "_kept", "_own", "_mark")
    gone = all_repeated_lines(docs, batches, fan, least).groupBy(F.col("id").alias(own), F.col("mark").alias(mark))
    gone = gone.agg(F.array_sort(F.collect_set("pos")).alias(drops))  # repeated rows send their lines several times
    joined = docs.withColumns({own: document(), mark: _mark()}).join(gone, [own, mark], "left")
    joined = joined.withColumn(lines, lines_of())
    text = F.when(F.col(drops).isNull(), F.coalesce(F.col("text"), F.lit(""))).otherwise(_kept(lines, drops))
    return joined.withColumn(kept, text), lines, drops, kept


def deduplicated(docs: DataFrame, batches: int = BATCHES, fan: int = FAN, least: int = LEAST) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped, kept (the text that stays).

    A line's key is the line without blanks at its ends, A-Z in lower case. All lines of a key of ``least``
    code points or more that two documents hold go, except those of the document with the least id.
    A document keeps its own repetitions; rows that share an id are one document. Rows without
    id are one document after all others. A missing or empty text is one empty line and stays as it is;
    a document may lose all its lines and is then empty. Repeated rows lose the same lines each. An
    empty table gives no rows; other columns are ignored, whatever their names.
    """
    rows, lines, drops, kept = _cleaned(docs.select("doc_id", "text"), batches, fan, least)
    dropped = F.coalesce(F.size(drops), F.lit(0))
    return rows.select(
        "doc_id",
        F.size(lines).cast("long").alias("n_lines"),
        F.when(F.col(drops).isNull(), 0).otherwise(dropped).cast("long").alias("n_dropped"),
        F.col(kept).alias("kept"),
    )


def without_repeated_lines(docs: DataFrame, batches: int = BATCHES, fan: int = FAN, least: int = LEAST) -> DataFrame:
    """``docs`` with the repeated lines gone from ``text`` and ``n_chars`` counted anew; all rows stay, and a
    missing text stays missing."""
    rows, _, _, kept = _cleaned(docs, batches, fan, least)
    text = F.when(F.col("text").isNotNull(), F.col(kept))
    new = {c: v for c, v in {"text": text, "n_chars": F.length(text).cast("long")}.items() if c in docs.columns}
    return replaced(rows, new).select(*[F.col(f"`{c}`") for c in docs.columns])
