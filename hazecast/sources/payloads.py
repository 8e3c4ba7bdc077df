"""Sensor payloads: one record holds an array per variable; rows come out.

A payload that lacks a variable gives nulls for it. One without a readable time axis, or with an
array of another length, is bad: ``bad="fail"`` stops the job and says which, ``bad="skip"``
leaves it out, and :func:`rejected_payloads` lists those left out with the reason. A single time
that cannot be read is a null date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazecast.functions.columns import parsed_time
from hazecast.schemas import READINGS, hourly_json

HOUR = "yyyy-MM-dd'T'HH:mm"
SET_BACK = 3600  # seconds by which clocks are set back in autumn
REASON = "_reason"


def typed_payload_rows(
    payloads: DataFrame, variables: list[str] = READINGS, keep: list[str] | None = None, *, bad: str = "fail"
) -> DataFrame:
    """Rows of payloads given as start, end (exclusive), interval in epoch seconds, and arrays."""
    return _rows(_typed(payloads, variables, keep or ["city"]), variables, bad)


def json_payload_rows(
    payloads: DataFrame,
    variables: list[str],
    text: str = "payload",
    keep: list[str] | None = None,
    *,
    zone: str | None = None,
    bad: str = "fail",
) -> DataFrame:
    """Rows of JSON payloads whose ``hourly`` object holds ``time`` and an array per variable.

    Times are read as UTC. With ``zone`` they are local to it: ``date`` is then the instant, and
    ``local_date`` the time as given (without zone), from which calendar parts come out local.
    Where clocks are set back by an hour, a time that a payload holds twice is first the earlier,
    then the later instant; one that it holds once is the earlier.
    """
    return _rows(_json(payloads, variables, text, keep or ["city"], zone), variables, bad, zone)


def read_json_payloads(
    spark, path: str, variables: list[str], *, city: str | None = None, zone: str | None = None, bad: str = "fail"
) -> DataFrame:
    """Rows of JSON payload files, one object per file, with their path as ``source``.

    ``city`` is a pattern whose first group finds the station in the path, for example
    ``([^/]+)\\.json$``; the rows then have a ``city`` too.
    """
    raw = spark.read.text(path, wholetext=True).select(F.col("value").alias("payload"), F.col("_metadata.file_path").alias("source"))
    keep = ["source"]
    if city:
        found = F.url_decode(F.regexp_extract("source", city, 1))
        raw, keep = raw.withColumn("city", F.when(found != "", found)), ["source", "city"]
    return json_payload_rows(raw, variables, keep=keep, zone=zone, bad=bad)


def rejected_payloads(
    payloads: DataFrame, variables: list[str], text: str | None = None, keep: list[str] | None = None
) -> DataFrame:
    """Kept columns and ``reason`` of bad payloads: typed ones, or JSON in the column ``text``."""
    keep = keep or ["city"]
    read = _json(payloads, variables, text, keep, None) if text else _typed(payloads, variables, keep)
    return read.where(F.col(REASON).isNotNull()).select(*keep, F.col(REASON).alias("reason"))


def _typed(payloads: DataFrame, variables: list[str], keep: list[str]) -> DataFrame:
    seconds = F.when(F.col("end") > F.col("start"), F.sequence(F.col("start"), F.col("end") - F.col("interval"), F.col("interval")))
    known = F.col("start").isNotNull() & F.col("end").isNotNull() & (F.col("interval") > 0)
    seconds = F.when(known, F.coalesce(seconds, F.array().cast("array<bigint>")))
    axis = F.transform(seconds, lambda s: F.timestamp_seconds(s))
    return _checked(payloads, axis, {v: F.col(v) for v in variables}, keep)


def _json(payloads: DataFrame, variables: list[str], text: str, keep: list[str], zone: str | None) -> DataFrame:
    parsed = payloads.withColumn("_p", F.from_json(text, hourly_json(variables)))
    axis = F.transform(F.col("_p.hourly.time"), lambda t: parsed_time(t, HOUR))
    if zone:
        axis = F.transform(axis, lambda t, i: _instant(t, i, axis, zone))
    return _checked(parsed, axis, {v: F.col(f"_p.hourly.{v}") for v in variables}, keep)


def _instant(wall: Column, i: Column, walls: Column, zone: str) -> Column:
    """Instant of the i-th local time; looks back only in the hour that clocks repeat."""
    early = F.to_utc_timestamp(wall, zone)
    late = F.timestamp_micros(F.unix_micros(early) + SET_BACK * 1_000_000)
    again = F.from_utc_timestamp(late, zone) == wall
    return F.when(again & (F.array_position(walls, wall) <= i), late).otherwise(early)


def _checked(payloads: DataFrame, axis: Column, arrays: dict[str, Column], keep: list[str]) -> DataFrame:
    """Kept columns, the time axis, arrays without gaps, and what is wrong (null: nothing)."""
    named = payloads.select(*keep, axis.alias("date"), *[a.alias(v) for v, a in arrays.items()])
    n = F.size("date")
    wrong = [F.when(F.col("date").isNull(), "no readable time axis")]
    wrong += [F.when(F.size(v) != n, f"{v} has another length than the time axis") for v in arrays]
    return named.withColumn(REASON, F.coalesce(*wrong)).withColumns(
        {v: F.coalesce(F.col(v), F.array_repeat(F.lit(None).cast(named.schema[v].dataType.elementType), n)) for v in arrays}
    )


def _rows(checked: DataFrame, variables: list[str], bad: str, zone: str | None = None) -> DataFrame:
    if bad not in ("fail", "skip"):
        raise ValueError("bad must be 'fail' or 'skip'")
    keep = [c for c in checked.columns if c not in ("date", REASON, *variables)]
    zipped = F.arrays_zip("date", *variables)
    if bad == "skip":
        checked = checked.where(F.col(REASON).isNull())
    else:
        which = F.concat_ws(" ", *[F.col(c).cast("string") for c in keep])
        zipped = F.when(F.col(REASON).isNull(), zipped).otherwise(
            F.raise_error(F.concat(F.lit("bad payload "), which, F.lit(": "), REASON))
        )
    local = [F.from_utc_timestamp("_r.date", zone).cast("timestamp_ntz").alias("local_date")] if zone else []
    return checked.select(*keep, F.explode(zipped).alias("_r")).select(
        "_r.date", *local, *[f"_r.{v}" for v in variables], *keep
    )
