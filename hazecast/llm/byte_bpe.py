"""Byte-level BPE: encode texts to token ids and back, exactly as the rank file says.

Each pre-token (a match of the pattern) is looked up whole first: a minimal perfect hash over
the vocabulary gives the only slot it can have, and one comparison tells. What is not in the
vocabulary is merged from its bytes: neighbours are linked, a heap yields the pair of lowest
rank, leftmost first. Ids of pre-tokens met before come from a bounded memo. Encoding, decoding and what is made of
them are one pass over the texts, a megabyte at a time.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from hashlib import sha256
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazecast.llm.common import chunks, fresh, replaced, texts_of

MEMO = 200_000  # pre-tokens a task remembers before it starts anew
SPREAD, MIX, ALL = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, (1 << 64) - 1  # odd multipliers of the perfect hash


@dataclass
class PerfectHash:
    """Minimal perfect hash of byte strings: as many slots as keys, one slot each."""

    shifts: np.ndarray
    size: int

    @classmethod
    def build(cls, keys: list[bytes]) -> tuple[PerfectHash, np.ndarray]:
        """The hash and the slot of each key (keys must differ)."""
        size, n_buckets = len(keys), max(1, len(keys) // 3)
        hashes = [xxhash.xxh64_intdigest(k) for k in keys]
        shifts, slots, free = [0] * n_buckets, [0] * size, [True] * size
        members: dict[int, list[int]] = {}
        for i, h in enumerate(hashes):
            members.setdefault(h % n_buckets, []).append(i)
        groups = sorted(members.items(), key=lambda x: -len(x[1]))
        for bucket, own in groups:
            if len(own) == 1:
                break
            shift = 1
            while True:
                at = {((hashes[i] ^ (shift * SPREAD & ALL)) * MIX & ALL) >> 32 for i in own}
                at = {h % size for h in at}
                if len(at) == len(own) and all(free[x] for x in at):
                    break
                shift += 1
            shifts[bucket] = shift
            for i in own:
                slots[i] = (((hashes[i] ^ (shift * SPREAD & ALL)) * MIX & ALL) >> 32) % size
                free[slots[i]] = False
        left = (slot for slot, still in enumerate(free) if still)
        for bucket, own in groups:
            if len(own) == 1:  # a bucket of one key names its slot
                slots[own[0]] = slot = next(left)
                shifts[bucket] = -slot - 1
        return cls(np.array(shifts, np.int64), size), np.array(slots, np.int64)

    def slots(self, keys: list[bytes]) -> np.ndarray:
        """The only slot each string can have; strings outside the keys get one as well."""
        hashes = np.array([xxhash.xxh64_intdigest(k) for k in keys], dtype=np.uint64)
        shift = self.shifts[(hashes % np.uint64(len(self.shifts))).astype(np.int64)]
        mixed = (hashes ^ (np.maximum(shift, 0).astype(np.uint64) * np.uint64(SPREAD))) * np.uint64(MIX)
        moved = ((mixed >> np.uint64(32)) % np.uint64(self.size)).astype(np.int64)
        return np.where(shift < 0, -shift - 1, moved)


@dataclass
class Vocabulary:
    """Ranks, their perfect hash and the pattern; small and of fixed size, so it is broadcast."""

    tokens: list[bytes]  # by id; ids that the file leaves out are empty
    pattern: str
    lookup: PerfectHash
    by_slot: list[int]
    ranks: dict[bytes, int] = field(repr=False)
    pairs: list[int] = field(repr=False)  # rank of each pair of bytes, or -1

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        return _read(path, pattern)

    def ids(self, pieces: list[bytes]) -> list[list[int]]:
        """Token ids of each pre-token."""
        found = []
        for piece, slot in zip(pieces, self.lookup.slots(pieces).tolist() if pieces else [], strict=True):
            token = self.by_slot[slot]
            found.append([token] if self.tokens[token] == piece else self.merged(piece))
        return found

    def merged(self, piece: bytes) -> list[int]:
        """Merge a pre-token from its bytes; the lowest rank first, the leftmost among equals."""
        rank_of, end = self.ranks.get, len(piece)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        pairs = self.pairs
        ranks = [pairs[a << 8 | b] for a, b in zip(piece, piece[1:], strict=False)]  # of the pair that begins here
        ranks.append(-1)
        heap = [rank << 32 | i for i, rank in enumerate(ranks) if rank >= 0]
        heapify(heap)
        while heap:
            first = heappop(heap)
            left = first & 0xFFFFFFFF
            if ranks[left] != first >> 32:
                continue  # one of the two has grown meanwhile
            middle = after[left]
            after[left] = right = after[middle]
            ranks[middle] = ranks[left] = -1
            if right < end:
                before[right] = left
                if (rank := rank_of(piece[left : after[right]], -1)) >= 0:
                    ranks[left] = rank
                    heappush(heap, rank << 32 | left)
            if (previous := before[left]) >= 0:
                ranks[previous] = rank = rank_of(piece[previous:right], -1)
                if rank >= 0:
                    heappush(heap, rank << 32 | previous)
        ids, at = [], 0
        while at < end:
            ids.append(rank_of(piece[at : after[at]]))
            at = after[at]
        return ids


@lru_cache(maxsize=4)
def _read(path: str, pattern: str) -> Vocabulary:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    keys = list(ranks)
    lookup, slots = PerfectHash.build(keys)
    by_slot = [0] * len(keys)
    for key, slot in zip(keys, slots.tolist(), strict=True):
        by_slot[slot] = ranks[key]
    pairs = [ranks.get(bytes((a, b)), -1) for a in range(256) for b in range(256)]
    return Vocabulary(tokens, pattern, lookup, by_slot, ranks, pairs)


def encoder(vocabulary: Vocabulary, memo: int = MEMO):
    """Function from texts to their packed ids (unsigned 32 bits, little-endian)."""
    split = regex.compile(vocabulary.pattern).findall
    known: dict[str, bytes] = {}

    def encode(texts: list[str]) -> list[bytes]:
        if len(known) > memo:
            known.clear()
        pieces = [split(t) for t in texts]
        new = list(set().union(*pieces).difference(known))
        found = vocabulary.ids([p.encode() for p in new])
        packed, at = np.fromiter(chain.from_iterable(found), "<u4").tobytes(), 0
        for piece, ids in zip(new, found, strict=True):
            known[piece] = packed[at : (at := at + 4 * len(ids))]
        return [b"".join(map(known.__getitem__, own)) for own in pieces]

    return encode


def _decoded(vocabulary: Vocabulary, ids: bytes | pa.Buffer) -> bytes:
    """The bytes that packed ids stand for. An id outside the vocabulary fails."""
    return b"".join(map(vocabulary.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _shared(df: DataFrame, vocabulary: Vocabulary):
    return df.sparkSession.sparkContext.broadcast(vocabulary)


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", into: str = "ids") -> DataFrame:
    """Add the token ids of ``text``: binary, unsigned 32 bits little-endian, in order.

    Special tokens don't exist here: their strings are ordinary text. A null text counts as
    empty and has no ids. Texts of any length are encoded whole. All rows and columns stay; a
    column named like ``into`` is replaced.
    """
    shared = _shared(docs, vocabulary)

    @F.arrow_udf("binary")
    def packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = encoder(shared.value)
        for texts in batches:
            yield pa.array([p for some in chunks(texts_of(texts)) for p in run(some)], pa.binary())

    return replaced(docs, {into: packed(F.col(f"`{text}`"))})


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Add the bytes that packed ``ids`` stand for (null ids: null). An id outside the vocabulary fails."""
    shared = _shared(df, vocabulary)

    @F.arrow_udf("binary")
    def unpacked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for packs in batches:
            yield pa.array([_decoded(shared.value, p.as_buffer()) if p.is_valid else None for p in packs], pa.binary())

    return replaced(df, {into: unpacked(F.col(f"`{ids}`"))})


def n_tokens(ids: str = "ids") -> Column:
    return (F.octet_length(F.col(f"`{ids}`")) / 4).cast("long")


def _coded(texts: pa.Array, vocabulary: Vocabulary, run) -> Iterator[tuple[bytes, bytes, str]]:
    """Packed ids, the bytes they decode to, and the text they come from: one document at a time."""
    for some in chunks(texts_of(texts)):
        for text, ids in zip(some, run(some), strict=True):
            yield ids, _decoded(vocabulary, ids), text


def n_tokens(ids: str = "ids") -> Column:
    return (F.octet_length(F.col(f"`{ids}`")) / 4).cast("long")


def digests(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Per document: doc_id, n_tokens, and the digests of the ids and of the decoded bytes.

    Ids and bytes never leave the task that makes them."""
    shared = _shared(docs, vocabulary)
    kind = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = encoder(shared.value)
        for texts in batches:
            rows = [(len(ids) // 4, sha256(ids).hexdigest(), sha256(back).hexdigest()) for ids, back, _ in _coded(texts, shared.value, run)]
            yield pa.array(rows, kind)

    return docs.select("doc_id", digest("text").alias("coded")).select("doc_id", "coded.*")


def encoded_documents(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Every document with its packed ids, their number, and whether they decode to its text."""
    shared = _shared(docs, vocabulary)
    (coded,) = fresh(docs, "_coded")

    @F.arrow_udf("ids binary, same boolean")
    def checked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = encoder(shared.value)
        for texts in batches:
            ids, same = [], []
            for own, back, text in _coded(texts, shared.value, run):
                ids.append(own)
                same.append(back == text.encode())
            yield pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(same, pa.bool_())], ["ids", "same"])

    found = docs.withColumn(coded, checked("text"))
    ids, same = F.col(coded)["ids"], F.col(coded)["same"]
    return replaced(found, {"ids": ids, "n_tokens": (F.octet_length(ids) / 4).cast("long"), "round_trip": same}).drop(coded)
