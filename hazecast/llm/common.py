"""Table access, word rules and helpers the corpus operators share."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hazecast.session import new_folder

# fixed values: a word is a run of bytes other than these
SPACES = "\\x20\\x09-\\x0D"
WORD = f"[^{SPACES}]+"
WORDS = re.compile(WORD)

#: Characters of text that a task turns into arrays at a time.
CHUNK = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows no label is learned from. A row without id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def text_digest(text: str = "text") -> Column:
    """128 bits that name a text; a missing text counts as empty."""
    return F.substring(F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)), 1, 16)


def texts_of(values: pa.Array) -> Iterator[str]:
    """Texts one by one, so that a batch of long ones isn't held twice; null reads as empty. Memory that
    earlier batches took goes back to the system."""
    pa.default_memory_pool().release_unused()
    for value in values:
        yield value.as_py() or ""


def chunks(texts: Iterator[str], size: int = CHUNK) -> Iterator[list[str]]:
    """Lists of whole texts of some ``size`` characters together; one long text may exceed it."""
    held, n = [], 0
    for text in texts:
        held.append(text)
        n += len(text) + 1
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


# fixed value: what Python and Unicode take for white space, as a class of RE2
_WHITE = "\\t-\\r\\x1c- \\x85\\xa0\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
_UNCLEAN = f"(?:^|[{_WHITE}])\\x20|\\x20(?:$|[{_WHITE}])|\\x00"
_APART = re.compile(r"(?<=\S)(?= \S)").split


def slices(texts: pa.Array, size: int = 4 * CHUNK) -> Iterator[pa.Array]:
    """Whole texts of some ``size`` bytes together, null as empty; one long text may exceed it."""
    texts = pc.fill_null(texts, "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield texts.slice(start, stop - start)
        start = stop
    pa.default_memory_pool().release_unused()


def units(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Texts cut before every single space between two other characters that aren't blank: the distinct
    units, the unit at each place, and where each text begins and the last one ends.

    Tokenizers that split before such a space anyway may take units one by one, each distinct one once.
    """
    cut = pc.split_pattern(pc.replace_substring(texts, " ", "\x00 "), "\x00")
    unclean = pc.match_substring_regex(texts, _UNCLEAN)
    if pc.any(unclean).as_py():
        rest = iter([_APART(t) for t in texts.filter(unclean).to_pylist()])
        cut = pa.array([next(rest) if odd else own for odd, own in zip(unclean.to_pylist(), cut.to_pylist(), strict=True)], pa.list_(pa.string()))
    offsets = cut.offsets.to_numpy()
    each = cut.flatten().dictionary_encode()
    return each.dictionary.to_pylist(), each.indices.to_numpy(), offsets - offsets[0]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` doesn't have, for values used on the way."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def columns(df: DataFrame) -> list[Column]:
    """All columns, also those with dots in their names."""
    return [F.col(f"`{c}`") for c in df.columns]


def row_key(*values: Column | str) -> Column:
    """128 bits that name a row by some of its values."""
    return F.substring(F.unhex(F.sha2(F.to_json(F.struct(*values)).cast("binary"), 256)), 1, 16)


def bucketed(df: DataFrame, name: str, *keys: str, buckets: int | None = None) -> DataFrame:
    """Write a table once below the shared folder, bucketed by ``keys``, so that later joins on them don't
    shuffle it again. By default there are as many buckets as a shuffle has partitions."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = new_folder(spark, name)
    opened_buckets(spark, folder, df.schema, keys, buckets, df.repartition(buckets, *keys))
    return opened_buckets(spark, folder, df.schema, keys, buckets)


def opened_buckets(
    spark: SparkSession, folder: str, schema: StructType, keys: Iterable[str], buckets: int, rows: DataFrame | None = None
) -> DataFrame:
    """The bucketed files below ``folder``, after writing ``rows`` to them if given. The catalog knows the
    table only while it is opened; the files stay."""
    name = f"opened_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = ", ".join(keys)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{folder}'")
    try:
        if rows is not None:
            rows.select(schema.names).write.insertInto(name, overwrite=True)
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def replaced(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add ``columns``; a column of ``df`` with the same name (in any case) gives way."""
    new = {c.lower() for c in columns}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in new], *[v.alias(c) for c, v in columns.items()])
