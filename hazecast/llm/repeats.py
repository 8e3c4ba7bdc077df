"""Long repeated byte strings, removed wherever they occur, by a column-wise BWT with common prefixes.

Two equal strings of ``length`` bytes have the same minimal ``gram`` (by hash) at the same
distance, so only strings with the same such anchor need comparing. A map over all texts finds
the anchors: each rules a run of neighbouring starts. Anchors found in one place alone are
dropped; for the others the bytes that their run covers are cut out (a segment) and sent to the
anchor's task. There the transform is built column by column over all segments at once: they are
aligned at their anchors, and each round inserts one symbol of every segment, from the last
column to the first, moving the order of the suffixes by one stable partition and the common
prefixes by range minima. As equal strings start in the same column, a round needs the order of
its own column only, and reads the columns in sequence; a suffix that shares ``length`` bytes
with a neighbour in the order starts a repeated string.

Anchors of too many places (a passage in a large share of all texts) are not sent to one task:
equal segments are counted first, and what differs is counted string by string, both by 128-bit
hashes that are aggregated before they are shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazecast.llm.common import fresh, text_digest, texts_of
from hazecast.session import new_folder, stored

LENGTH = 400
GRAM = 128
BLOCK = 1 << 20  # starts of a text that are looked at together
CROWD = 5000  # places of an anchor that one task still compares, some 3 MB
ABSENT = 0  # symbol of a column outside a segment; bytes are 1 to 256
ANCHORS = "digest binary, anchor long, pos int, lo int, hi int"


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2 ** 64."""
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 1 << 64)
    both = []
    for b in (base, inverse):
        steps = np.full(n, b, np.uint64)
        steps[0] = 1
        both.append(np.cumprod(steps))
    return both[0], both[1]


def anchors(text: bytes, length: int, gram: int, values: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor, its position, first and last start it rules, hash of the segment) of all strings
    of ``length`` bytes.

    ``values`` maps bytes to random 64-bit numbers. Of equal hashes the leftmost is the anchor.
    """
    window = length - gram + 1
    low = np.uint64(0xFFFFFFFF)
    power, inverse = _powers(BLOCK + length)
    for base in range(0, len(text) - length + 1, BLOCK):
        symbols = np.frombuffer(text, np.uint8, min(len(text) - base, BLOCK + length - 1), base)
        n = len(symbols)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[symbols] * power[:n], out=sums[1:])
        hashes = (sums[gram:] - sums[:-gram]) * inverse[: n - gram + 1]
        hashes ^= hashes >> np.uint64(32)
        hashes *= np.uint64(0xD6E8FEB86659FD93)
        hashes ^= hashes >> np.uint64(29)
        least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        size = 1
        while 2 * size <= window:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if rest := window - size:
            least = np.minimum(least[:-rest], least[rest:])
        at = (least & low).astype(np.int64)
        last = np.flatnonzero(np.append(at[1:] != at[:-1], True))
        first = np.append(0, last[:-1] + 1)
        own = at[last]
        segment = (sums[last + length] - sums[first]) * inverse[first]
        yield hashes[own].view(np.int64), own + base, first + base, last + base, segment


def within_text(parts: list[tuple[np.ndarray, ...]], length: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Anchors of one text, each segment once, and the spans (begin, stop) of the segments it
    holds several times. A text that goes in circles would send the same segment many times."""
    anchor, pos, lo, hi, segment = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((hi - lo, segment, anchor))
    same = np.all([c[order][1:] == c[order][:-1] for c in (anchor, segment, hi - lo)], axis=0)
    if not same.any():
        return [anchor, pos, lo, hi], np.zeros((0, 2), np.int64)
    again = np.append(False, same) | np.append(same, False)
    covered = np.sort(order[again])  # in the order of the text
    begin, stop = lo[covered], hi[covered] + length
    apart = np.append(True, begin[1:] > stop[:-1])
    spans = np.column_stack((begin[apart], stop[np.append(apart[1:], True)]))
    once = np.sort(order[np.append(True, ~same)])
    return [c[once] for c in (anchor, pos, lo, hi)], spans


def repeated_starts(groups: np.ndarray, segments: list[bytes], before: np.ndarray, length: int, window: int) -> np.ndarray:
    """Starts (segment, column) of strings of ``length`` bytes found in two segments of a group.

    ``groups`` ascends; ``before`` is the distance from a segment's begin to its anchor, which
    stands in column ``window - 1`` for all. Returns booleans, ``window`` columns a segment.
    """
    m, columns = len(segments), window - 1 + length
    sizes = np.fromiter(map(len, segments), np.int64, m)
    ends = np.cumsum(sizes)
    flat = np.frombuffer(b"".join(segments), np.uint8).astype(np.int16) + 1
    table = np.full(m * columns, ABSENT, np.int16)
    begins = np.arange(m) * columns + window - 1 - before
    table[np.arange(len(flat)) + np.repeat(begins - (ends - sizes), sizes)] = flat
    table = np.ascontiguousarray(table.reshape(m, columns).T)
    group = np.unique(groups, return_inverse=True)[1].astype(np.int64) * 512
    order, common = np.arange(m), np.zeros(m + 1, np.int64)  # common[i]: with the suffix before i
    hits = np.zeros((m, window), bool)
    for column in range(columns - 1, -1, -1):
        symbol = table[column][order]
        key = group + symbol
        moved = np.argsort(key, kind="stable") if (key[1:] < key[:-1]).any() else None
        if moved is None:
            same = np.append(False, key[1:] == key[:-1])
            least = common[:m].copy()
        else:
            key, symbol, order = key[moved], symbol[moved], order[moved]
            same = np.append(False, key[1:] == key[:-1])
            least = common[moved]
            jumps = np.flatnonzero(same[1:] & (moved[1:] != moved[:-1] + 1)) + 1
            if len(jumps):  # the least common prefix of all that stood between
                pairs = np.column_stack((moved[jumps - 1] + 1, moved[jumps] + 1)).ravel()
                least[jumps] = np.minimum.reduceat(common, pairs)[::2]
        common[:m] = np.where(same & (symbol != ABSENT), least + 1, 0)
        if column < window:
            long = common[:m] >= length
            long[:-1] |= long[1:].copy()
            hits[order[long], column] = True
    return hits


def _spans(batch: pa.Table, length: int, window: int) -> pa.RecordBatch:
    """Byte spans that repeated strings cover, from segments sorted by anchor."""
    pos, lo = (batch.column(c).to_numpy() for c in ("pos", "lo"))
    hits = repeated_starts(batch.column("anchor").to_numpy(), batch.column("segment").to_pylist(), pos - lo, length, window)
    edge = np.diff(np.pad(hits, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, begin = np.nonzero(edge == 1)
    end = np.nonzero(edge == -1)[1]  # runs of a row never overlap: both come in the same order
    shift = pos[row] - (window - 1)
    digests = batch.column("digest").combine_chunks().take(pa.array(row))
    return pa.RecordBatch.from_arrays(
        [digests, pa.array((begin + shift).astype(np.int32)), pa.array((end - 1 + length + shift).astype(np.int32))],
        ["digest", "begin", "stop"],
    )


def _place(at: str) -> Column:
    return F.xxhash64("digest", at)


def _repeated(df: DataFrame, *keys: str) -> DataFrame:
    """Keys found in two places at least, with ``n`` rows and the ``first`` place."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("n"), F.min("place").alias("first"), F.max("place").alias("last"))
    return counted.where("first < last").drop("last")


def _bytes(text: str, begin: Column, size: Column) -> Column:
    return F.col(text).cast("binary").substr(begin + 1, size)


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(digest, text, copies), bucketed by digest so that later joins don't shuffle the texts."""
    spark = docs.sparkSession
    texts = docs.groupBy(text_digest().alias("digest")).agg(
        F.any_value(F.coalesce("text", F.lit(""))).alias("text"), F.count("*").alias("copies")
    )
    name = f"texts_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts.write.bucketBy(buckets, "digest").option("path", new_folder(spark, "texts")).format("parquet").saveAsTable(name)
    return spark.table(name)


def repeated_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """(digest, spans): the byte spans of each distinct text covered by strings that repeat.

    Spans overlap and have no order. A text with copies repeats as a whole.
    """
    if not 0 < gram <= length:
        raise ValueError("gram must lie between 1 and length")
    window = length - gram + 1
    values = np.random.default_rng(length).integers(0, 1 << 64, 256, np.uint64)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, texts = batch.column(0), batch.column(1)
            for start in range(0, len(digests), 500):
                parts, row = [], []
                for i, text in enumerate(texts_of(texts.slice(start, 500)), start):
                    own, spans = within_text(list(anchors(text.encode(), length, gram, values)), length)
                    # a span stands in a row without anchor
                    begin, stop = spans.T
                    parts.append([np.append(own[0], begin * 0), np.append(own[1], begin * 0 - 1), np.append(own[2], begin), np.append(own[3], stop)])
                    row.append(np.full(len(parts[-1][0]), i))
                columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [digests.take(pa.array(np.concatenate(row))), pa.array(columns[0], mask=columns[1] < 0)]
                    + [pa.array(c.astype(np.int32)) for c in columns[1:]],
                    ["digest", "anchor", "pos", "lo", "hi"],
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            some = pa.Table.from_batches([batch])
            held = some if held is None else pa.concat_tables([held, some])
            anchor = held.column("anchor").to_numpy()
            cut = int(np.searchsorted(anchor, anchor[-1])) if len(anchor) else 0
            if cut:  # the last anchor may go on in the next batch
                yield _spans(held.slice(0, cut), length, window)
                held = held.slice(cut).combine_chunks()
        if held is not None and held.num_rows:
            yield _spans(held, length, window)

    long = F.octet_length("text") >= length
    found = stored(texts.where(long).select("digest", "text").mapInArrow(find, ANCHORS).withColumn("place", _place("pos")), "anchors")
    placed = found.where(F.col("anchor").isNotNull())
    runs = stored(placed.join(_repeated(placed, "anchor").select("anchor", "n"), "anchor"), "runs")
    run = F.struct("anchor", "n", "pos", "lo", "hi")
    cut = texts.join(runs.groupBy("digest").agg(F.collect_list(run).alias("runs")), "digest").select(
        "digest",
        F.explode(
            F.transform("runs", lambda r: F.struct(r.alias("run"), _bytes("text", r.lo, r.hi - r.lo + length).alias("segment")))
        ).alias("cut"),
    )
    segments = cut.select("digest", "cut.run.*", "cut.segment")
    near = segments.where(F.col("n") <= crowd).repartition("anchor").sortWithinPartitions("anchor")
    spans = near.select("anchor", "digest", "pos", "lo", "segment").mapInArrow(compare, "digest binary, begin int, stop int")
    copies = texts.where(long & (F.col("copies") > 1)).select("digest", F.lit(0).alias("begin"), F.octet_length("text").alias("stop"))
    circles = found.where(F.col("anchor").isNull()).select("digest", F.col("lo").alias("begin"), F.col("hi").alias("stop"))
    spans = spans.union(copies).union(circles)
    crowded = segments.where(F.col("n") > crowd)
    if not runs.where(F.col("n") > crowd).isEmpty():
        spans = spans.union(_crowded_spans(stored(crowded.drop("n"), "crowded"), length))
    return spans.groupBy("digest").agg(F.collect_list(F.struct("begin", "stop")).alias("spans"))


def _hashes(value: Column) -> list[Column]:
    return [F.xxhash64(value).alias("h1"), F.xxhash64(F.lit(1), value).alias("h2")]


def _crowded_spans(segments: DataFrame, length: int) -> DataFrame:
    """Spans of segments whose anchors have very many places."""
    keys = ["anchor", "off", "h1", "h2"]
    whole = segments.withColumn("place", _place("lo")).select("*", (F.col("pos") - F.col("lo")).alias("off"), *_hashes(F.col("segment")))
    classes = whole.groupBy(*keys).agg(F.min("place").alias("first"), F.max("place").alias("last"))
    placed = whole.join(classes, keys)
    equal = placed.where("first < last").select("digest", F.col("lo").alias("begin"), (F.col("hi") + length).alias("stop"))
    own = placed.where("place = first").select("digest", "anchor", "pos", "lo", "segment")
    starts = F.sequence(F.lit(0), F.octet_length("segment") - length)
    strings = own.select(
        "digest",
        "anchor",
        "pos",
        F.explode(
            F.transform(
                starts,
                lambda i: F.struct(
                    (F.col("lo") + i).alias("begin"), *_hashes(F.col("segment").substr(i + 1, F.lit(length)))
                ),
            )
        ).alias("string"),
    ).select("digest", "anchor", (F.col("pos") - F.col("string.begin")).alias("off"), "string.*")
    strings = stored(strings.withColumn("place", _place("begin")), "strings")
    again = strings.join(_repeated(strings, *keys).select(*keys), keys)
    return equal.union(again.select("digest", "begin", (F.col("begin") + length).alias("stop")))


def _without(text: bytes, spans: list[dict] | None) -> tuple[bytes, int]:
    """The text without its spans, and the number of maximal runs removed."""
    kept, at, runs = [], 0, 0
    for begin, stop in sorted((s["begin"], s["stop"]) for s in spans or ()):
        if begin > at or not runs:
            kept.append(text[at:begin])
            runs += 1
            at = stop
        else:
            at = max(at, stop)
    kept.append(text[at:])
    return b"".join(kept), runs


def cleaned_texts(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """(digest, n_bytes, kept, n_spans) of every distinct text; ``kept`` holds the bytes that stay."""
    texts = distinct_texts(docs)
    spans = repeated_spans(texts, length, gram, crowd)
    kind = pa.struct([("kept", pa.binary()), ("n_spans", pa.int64())])

    @F.arrow_udf("kept binary, n_spans long")
    def cleaned(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in batches:
            pairs = (_without(t.encode(), s.as_py()) for t, s in zip(texts_of(texts), spans, strict=True))
            yield pa.array([{"kept": kept, "n_spans": n} for kept, n in pairs], kind)

    joined = texts.join(spans, "digest", "left").select("digest", "text", cleaned("text", "spans").alias("clean"))
    return joined.select("digest", F.octet_length("text").cast("long").alias("n_bytes"), "clean.*")


def removed_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept (binary).

    Every byte covered by a string of ``length`` bytes that also starts elsewhere, in the same
    text or another, is removed, the first occurrence included; strings never cross texts and are
    judged on the input. A null text counts as empty; texts shorter than ``length`` lose nothing;
    repeated rows count as copies of each other. Rows without doc_id stay.
    """
    clean = cleaned_texts(docs, length, gram, crowd)
    rows = docs.select("doc_id", text_digest().alias("digest"))
    removed = F.col("n_bytes") - F.octet_length("kept")
    return rows.join(clean, "digest").select("doc_id", "n_bytes", removed.alias("n_removed"), "n_spans", "kept")


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """``docs`` with the repeated bytes gone from ``text`` and ``n_chars`` counted anew.

    Every row stays, if need be with an empty text (so do nulls). Characters that a cut splits go
    as well.
    """

    @F.arrow_udf("string")
    def whole_characters(values: pa.Array) -> pa.Array:
        return pa.array([v.as_py().decode(errors="ignore") for v in values], pa.string())

    digest, kept, missing = fresh(docs, "_digest", "_kept", "_missing")
    clean = cleaned_texts(docs, length, gram, crowd).select(
        F.col("digest").alias(digest), whole_characters("kept").alias(kept)
    )
    rows = docs.withColumns({digest: text_digest(), missing: F.col("text").isNull()}).drop("text")
    text = F.when(~F.col(missing), F.col(kept))
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    joined = rows.join(clean, digest)
    return joined.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])
