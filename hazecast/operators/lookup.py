"""Join of a per-station table to station rows, safe for hot stations and long station lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazecast.session import settle

BROADCAST_BYTES = 32 << 20  # of the rows written as JSON text
SALTS = 64  # tasks that one hot key is divided over; raise it with the size of the largest key


def lookup(
    df: DataFrame,
    small: DataFrame,
    on: list[str],
    *,
    how: str = "left",
    spread: list[str] | None = None,
    max_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
    stored: bool = False,
) -> DataFrame:
    """Attach the columns of ``small`` (one row per ``on``) to every row of ``df``.

    ``small`` is computed once and kept in the shared folder, unless the caller says it is
    ``stored`` already. Up to ``max_bytes``, measured there, it is broadcast. Beyond that both
    sides are shuffled with a salt taken from the ``spread`` columns, which divides the rows of
    one hot key over ``salts`` tasks; ``small`` is copied once per salt.
    """
    small = small if stored else settle(small)
    columns = df.columns + [c for c in small.columns if c not in on]
    if fits_broadcast(small, max_bytes):
        joined = df.join(F.broadcast(small), on, how)
    else:
        joined = salted_join(df, small, on, how=how, spread=spread, salts=salts)
    return joined.select(*columns)


def fits_broadcast(small: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the rows of ``small``, written as text, stay within ``max_bytes``."""
    size = F.length(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))
    return (small.agg(F.sum(size)).first()[0] or 0) <= max_bytes


def salted_join(
    df: DataFrame,
    small: DataFrame,
    on: list[str],
    *,
    how: str = "left",
    spread: list[str] | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Equi-join with the key spread over salts; each row meets exactly one copy of its match."""
    spread = spread or [c for c in df.columns if c not in on]
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return df.withColumn("_salt", salt).join(copies, [*on, "_salt"], how).drop("_salt")
