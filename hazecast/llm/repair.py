"""Repair of conversations: turns aligned to the alternating grammar, cheapest edits first.

A repaired conversation reads ``(s?(ua)+)?`` by its role initials. Edits: keep a row (0), give it the
role that stands there (2), delete it (3, forced for blank and duplicate rows), insert an empty row of
user or assistant (2); a truncated row that stays adds 1. Of the cheapest edits the ASCII-least audit
(D, I, K, R in order) is taken.

Alignment is Wagner and Fischer's, of the rows to every feasible length of the alternating string: lengths
next to the number of rows first, each inside Ukkonen's band of the best cost found so far, which leaves out
cells that cannot end below it, and lengths for which no cell remains. Audits are traced back and compared.

A conversation may be as long as the table. Rows are therefore cut by range into pieces of at most
``PIECE`` rows, each aligned for every state of the grammar it may begin and end in; the pieces' best edits
are then joined in order. That is exact: costs add up, and of two audits of equal cost over the same rows
neither is a prefix of the other (one more insertion would cost more), so the least audit of a whole
consists of least audits of its parts. The repaired text is hashed row by row in a second pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazecast.session import stored

PIECE = 32

# fixed values: prices of the edits
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: The state after a role: nothing yet, system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
FAR = 1 << 60
PAIRS = ("su", "ua", "au")
BLANKS = " \t\n\x0b\x0c\r"

Row = tuple[str, bool, bool]  # role initial, must go, truncated
Best = dict[tuple[int, int], tuple[int, str]]  # (state before, state after) -> cost, audit


def pattern(first: str, length: int) -> str:
    """The alternating string of ``length`` role initials that begins with ``first``."""
    at = "sua".index(first)
    return (first + "".join("ua"[(at + i) % 2] for i in range(length - 1)))[:length]


def align(rows: list[Row], wanted: str, bound: int) -> tuple[int, str] | None:
    """Cheapest edits of ``rows`` into ``wanted`` with their least audit, or None if they cost over ``bound``.

    Cell (i, j) is the cost of turning the rows from i on into the string from j on, so that the audit
    is traced from the front, the least letter first.
    """
    n, m = len(rows), len(wanted)
    cost = [[FAR] * (m + 1) for _ in range(n + 1)]
    for i in range(n, -1, -1):
        # the rows before i cost at least what the difference of lengths forces
        low, high = max(0, i - bound // DELETE), min(m, i + bound // INSERT)
        own = cost[i]
        below = cost[i + 1] if i < n else None
        initial, gone, cut = rows[i] if i < n else ("", False, False)
        for j in range(high, low - 1, -1):
            before = (j - i) * INSERT if j > i else (i - j) * DELETE
            rest = (m - j) - (n - i)
            after = rest * INSERT if rest > 0 else -rest * DELETE
            if before + after > bound:
                continue
            if i == n:
                best = after
            else:
                best = below[j] + DELETE
                if j < m:
                    best = min(best, own[j + 1] + INSERT)
                    if not gone:
                        best = min(best, below[j + 1] + _stay(initial, wanted[j], cut))
            own[j] = best if best + before <= bound else FAR
    if cost[0][0] > bound:
        return None
    i = j = 0
    audit = []
    while i < n or j < m:
        left = cost[i][j]
        if i < n and left == cost[i + 1][j] + DELETE:
            audit.append("D")
            i += 1
        elif j < m and left == cost[i][j + 1] + INSERT:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if rows[i][0] == wanted[j] else "R")
            i, j = i + 1, j + 1
    return cost[0][0], "".join(audit)


def _stay(initial: str, wanted: str, cut: bool) -> int:
    if initial == wanted:
        return TRUNCATED * cut
    return FAR if wanted == "s" else REROLE + TRUNCATED * cut


def shortest(rows: list[Row], first: str, last: str) -> tuple[int, str] | None:
    """Cheapest edits over all strings that begin with ``first`` and end in ``last``; None if there are none.

    Lengths next to the number of rows come first; those whose difference alone costs more end the search.
    """
    n = len(rows)
    if first == "s" and not any(initial == "s" and not gone for initial, gone, _ in rows):
        return None  # a system row can only be kept
    best = None
    for step in range(n * 2 + 4):
        bound = best[0] if best else n * (DELETE + TRUNCATED) + 3 * INSERT  # above deleting all and inserting anew
        if min(INSERT, DELETE) * step > bound:
            break
        for length in {n - step, n + step}:
            if length > 0 and pattern(first, length)[-1] == last:
                found = align(rows, pattern(first, length), best[0] if best else bound)
                if found and (best is None or found < best):
                    best = found
    return best


def best_edits(rows: list[Row], whole: bool = False) -> Best:
    """Cheapest edits for all states to begin and end in; ``whole``: for a complete conversation only."""
    none = align(rows, "", DELETE * len(rows))
    if whole:
        return _least({(START, START): [none], (START, ASSISTANT): [shortest(rows, "u", "a"), shortest(rows, "s", "a")]})
    u, a, s = ({last: shortest(rows, first, last) for last in ("u", "a")} for first in ("u", "a", "s"))
    return _least(
        {
            (START, START): [none],
            (START, SYSTEM): [align(rows, "s", FAR - 1)],
            (START, USER): [u["u"], s["u"]],
            (START, ASSISTANT): [u["a"], s["a"]],
            (SYSTEM, SYSTEM): [none],
            (SYSTEM, USER): [u["u"]],
            (SYSTEM, ASSISTANT): [u["a"]],
            (USER, USER): [none, a["u"]],
            (USER, ASSISTANT): [a["a"]],
            (ASSISTANT, USER): [u["u"]],
            (ASSISTANT, ASSISTANT): [none, u["a"]],
        }
    )


def _least(found: dict[tuple[int, int], list[tuple[int, str] | None]]) -> Best:
    return {states: min(some) for states, edits in found.items() if (some := [e for e in edits if e])}


def joined(a: Best, b: Best) -> Best:
    """Best edits of two pieces that follow one another."""
    out: Best = {}
    for (start, middle), (cost, audit) in a.items():
        for (begin, end), (more, rest) in b.items():
            if begin == middle:
                found = (cost + more, audit + rest)
                out[start, end] = min(found, out.get((start, end), found))
    return out


def joined_all(pieces: list[Best]) -> Best:
    """Neighbours first, so that long audits are copied a few times only."""
    while len(pieces) > 1:
        pieces = [joined(*pieces[i : i + 2]) if i + 1 < len(pieces) else pieces[i] for i in range(0, len(pieces), 2)]
    return pieces[0]


def final(best: Best) -> tuple[int, str]:
    """The best of those that make a whole conversation."""
    return min(best[START, end] for end in (START, ASSISTANT) if (START, end) in best)


# ---- rows

ORDER = ["conv_id", "turn", "role", "text"]


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with the faults that crc32 of ``conv_id:turn`` deals out.

    Nulls read as one space, in that key as in role and text; conv_id and turn stay null.
    """
    fault = F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn")).cast("binary")) % 20
    told = rows.select("conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return told.where("fault <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("time")).drop("time")


def _sorted(df: DataFrame, *first: str) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in (ORDER[0], *first, *ORDER[1:])]


def _judged(rows: DataFrame) -> DataFrame:
    """Rows with ``digest`` of role and text, and ``seen``: an earlier turn of the conversation holds both.

    Equal rows of one turn stand side by side, so whoever reads them in order tells them apart.
    """
    digest = F.unhex(F.sha2(F.to_json(F.struct("role", "text")).cast("binary"), 256))
    place = F.struct(F.col("turn").isNotNull().alias("named"), "turn")  # nulls first
    kinds = [F.col("conv_id").cast("long"), F.col("turn").cast("long"), _text("role").alias("role"), _text("text").alias("text")]
    rows = stored(rows.select(*kinds).withColumns({"digest": digest, "place": place}), "turns")
    first = rows.groupBy(F.col("conv_id").alias("_c"), F.col("digest").alias("_d"))
    first = first.agg(F.min("place").alias("first"), F.max("place").alias("last")).where("first < last")
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("digest") == F.col("_d"))
    seen = F.coalesce(F.col("first") < F.col("place"), F.lit(False))
    return stored(rows.join(first, same, "left").select(*ORDER, "digest", seen.alias("seen")), "judged")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for start in range(0, batch.num_rows, 200):
            yield from batch.slice(start, 200).to_pylist()


FAULTS = ("blank", "duplicate", "truncated")
EDITS = "array<struct<start:int,end:int,cost:long,audit:string>>"
PART = f"conv_id long, part int, {', '.join(f'{c} long' for c in FAULTS)}, illegal long, first string, last string, best {EDITS}"
EDIT = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])


class _Part:
    """What one range of rows holds of a conversation; rows are aligned as soon as a piece is full."""

    def __init__(self, row: dict) -> None:
        self.conv_id, self.part, self.first, self.last = row["conv_id"], row["part"], row["initial"], row["initial"]
        self.faults = dict.fromkeys((*FAULTS, "illegal"), 0)
        self.rows: list[Row] = []
        self.pieces: list[Best] = []

    def add(self, initial: str, fault: str | None) -> None:
        if fault:
            self.faults[fault] += 1
        if len(self.rows) == PIECE:
            self.pieces.append(best_edits(self.rows))
            self.rows = []
        self.rows.append((initial, fault in ("blank", "duplicate"), fault == "truncated"))
        self.last = initial

    def told(self, whole: bool) -> dict:
        best = joined_all([*self.pieces, best_edits(self.rows, whole and not self.pieces)])
        edits = [{"start": s, "end": e, "cost": c, "audit": a} for (s, e), (c, a) in sorted(best.items())]
        return {"conv_id": self.conv_id, "part": self.part, **self.faults, "first": self.first, "last": self.last, "best": edits}


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation in a range of sorted rows."""
    schema = pa.schema(
        [("conv_id", pa.int64()), ("part", pa.int32()), *[(c, pa.int64()) for c in (*FAULTS, "illegal")]]
        + [("first", pa.string()), ("last", pa.string()), ("best", pa.list_(EDIT))]
    )
    out: list[dict] = []
    own, before, inner = None, None, False  # inner: an earlier conversation of this range came before
    for row in _rows(batches):
        now = (row["conv_id"], row["turn"], row["digest"])
        if own is None or own.conv_id != row["conv_id"]:
            if own:
                out.append(own.told(whole=inner))
                inner = True
            own, before = _Part(row), None
        else:
            own.faults["illegal"] += own.last + row["initial"] not in PAIRS
        if not row["ending"]:
            fault = "blank"
        elif row["seen"] or now == before:
            fault = "duplicate"
        else:
            fault = None if row["ending"] in ".!?" else "truncated"
        own.add(row["initial"], fault)
        before = now
        if len(out) == 1000:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if own:
        out.append(own.told(whole=False))  # it may go on in the next range
        yield pa.RecordBatch.from_pylist(out, schema)


def _audits(judged: DataFrame) -> DataFrame:
    """(conv_id, blank, duplicate, truncated, illegal, cost, audit) of judged rows."""

    @F.arrow_udf("cost long, audit string, illegal long")
    def put_together(values: pa.Array) -> pa.Array:
        out = []
        for value in values:
            parts = value.as_py()  # in the order of their ranges
            edges = sum(a["last"] + b["first"] not in PAIRS for a, b in zip(parts, parts[1:], strict=False))
            best = joined_all([{(x["start"], x["end"]): (x["cost"], x["audit"]) for x in p["best"]} for p in parts])
            cost, audit = final(best)
            out.append({"cost": cost, "audit": audit, "illegal": edges})
        return pa.array(out, pa.struct([("cost", pa.int64()), ("audit", pa.string()), ("illegal", pa.int64())]))

    ranged = judged.repartitionByRange(*_sorted(judged)).sortWithinPartitions(*_sorted(judged))
    initial, ending = F.substring("role", 1, 1), F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    rows = ranged.select("conv_id", "turn", "digest", "seen", initial.alias("initial"), ending.alias("ending"), F.spark_partition_id().alias("part"))
    sums = [F.sum(c).alias(c) for c in (*FAULTS, "illegal")]
    own = F.array_sort(F.collect_list(F.struct("part", "first", "last", "best"))).alias("parts")
    found = rows.mapInArrow(_parts, PART).groupBy("conv_id").agg(*sums, own).withColumn("whole", put_together("parts"))
    illegal = (F.col("illegal") + F.col("whole.illegal")).alias("illegal")
    return stored(found.select("conv_id", *FAULTS, illegal, "whole.cost", "whole.audit"), "audits")


def edited(rows: Iterator[dict], audit: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired conversation, from its rows in order."""
    left = len(audit) - audit.count("D")
    for edit in audit:
        row = {} if edit == "I" else next(rows)
        if edit != "D":
            left -= 1  # assistant stands at the end
            yield row["role"] if edit == "K" else ("assistant", "user")[left % 2], row.get("text", "")


def _with_audits(judged: DataFrame, audits: DataFrame) -> DataFrame:
    """Rows of each conversation in order behind a row with its audit, so that the audit is sent once."""
    none = {c: F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("text", "string"), ("audit", "string"))}
    heads = audits.select("conv_id", F.lit(0).alias("kind"), none["turn"], none["role"], none["text"], "audit")
    body = judged.select("conv_id", F.lit(1).alias("kind"), *ORDER[1:], none["audit"])
    return heads.union(body).repartition("conv_id").sortWithinPartitions(*_sorted(body, "kind"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    out: list[dict] = []
    rows = _rows(batches)
    for head in rows:  # the audit takes exactly the rows of its conversation
        digest, gap = hashlib.sha256(), ""
        for role, text in edited(rows, head["audit"]):
            digest.update(f"{gap}{role}:{text}".encode())
            gap = "\n"
        out.append({"conv_id": head["conv_id"], "repaired_sha256": digest.hexdigest()})
        if len(out) == 1000:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    yield pa.RecordBatch.from_pylist(out, schema)


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    out: list[dict] = []
    rows = _rows(batches)
    for head in rows:
        for turn, (role, text) in enumerate(edited(rows, head["audit"])):
            out.append({"conv_id": head["conv_id"], "turn": turn, "role": role, "text": text})
            if len(out) == 200:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
    yield pa.RecordBatch.from_pylist(out, schema)


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, turn, role, text), turns from 0."""
    judged = _judged(rows)
    return _with_audits(judged, _audits(judged)).mapInArrow(_turns, "conv_id long, turn long, role string, text string")


def report(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each conv_id of ``conversations``, from its ``rows`` (conv_id, turn, role, text): conv_id,
    gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are taken by turn, nulls first, then by role and text; a null role or text is one space. Rows
    without conv_id are one conversation. Each row's first fault counts: ``blank``, ``duplicate`` (role and text of an
    earlier row), ``truncated`` (no full stop, exclamation or question mark at its end). ``gaps``: turns
    missing between the least and the greatest one, 0 if all are null. ``illegal``: neighbours whose roles
    don't follow one another. A conversation without rows has zeros, an empty audit and the digest of
    nothing. Repeated rows are duplicates of each other; extra columns are ignored; no conversations, no rows.
    A conversation's audit is one value: memory grows by some ten bytes a row of the longest one.
    """
    judged = _judged(rows)
    audits = _audits(judged)
    digests = _with_audits(judged, audits).mapInArrow(_digests, "conv_id long, repaired_sha256 string")
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    gaps = judged.groupBy("conv_id").agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"))
    out = conversations.select(F.col("conv_id").cast("long")).distinct()
    for i, own in enumerate((gaps, audits, digests)):
        own = own.withColumnRenamed("conv_id", f"_{i}")
        out = out.join(own, F.col("conv_id").eqNullSafe(F.col(f"_{i}")), "left").drop(f"_{i}")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *FAULTS, "illegal", "cost")]
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))
