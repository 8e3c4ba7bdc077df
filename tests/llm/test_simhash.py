import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from hazecast.llm.simhash import links, near_duplicates, one_of_each, simhash
from hazecast.llm.components import components


def slow_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@given(st.text(alphabet="aB é\n\x0b ", max_size=60))
@settings(deadline=None)
def test_fingerprint_by_definition(text):
    assert simhash(text.encode(), 3) % (1 << 64) == slow_simhash(text)


def test_documents_against_brute_force(odd, odd_rows, none):
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in near_duplicates(odd).collect()), key=str)
    prints = [slow_simhash(r[1] or "") for r in odd_rows]
    pairs = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    root = groups(range(len(prints)), pairs)
    least = {}
    for i, row in enumerate(odd_rows):
        if row[0] is not None:
            least[root[i]] = min(least.get(root[i], row[0]), row[0])
    want = [(r[0], f"{prints[i]:016x}", least.get(root[i])) for i, r in enumerate(odd_rows)]
    assert got == sorted(want, key=str)
    assert near_duplicates(none).count() == 0


@pytest.mark.parametrize(("crowd", "distance"), [(64, 2), (1, 2), (64, 1), (1, 1)])
def test_links_connect_all_close_fingerprints(spark, crowd, distance):
    """Families a bit or two around their heads, and pairs just beyond."""
    draw = np.random.default_rng(3)
    bits = set()
    for head in draw.integers(0, 1 << 64, 40, np.uint64).tolist():
        for n in (0, 1, 1, 2, 2, 3, 4):
            flips = draw.choice(64, n, replace=False).tolist()
            bits.add(head ^ sum(1 << f for f in flips))
    signed = [b - (1 << 64) * (b >> 63) for b in bits]
    prints = spark.createDataFrame([(b,) for b in signed], "bits long")
    found = [tuple(r) for r in links(prints, distance, crowd).collect()]
    close = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= distance]
    assert groups(signed, found) == groups(signed, close)
    if crowd == 64:
        assert {(min(p), max(p)) for p in found} == set(close)


def test_distance_is_checked(spark):
    with pytest.raises(ValueError, match="max_distance"):
        links(spark.createDataFrame([], "bits long"), 3)


def test_one_row_of_each_component_stays_whole(odd, odd_rows, none):
    rows = [tuple(r) for r in one_of_each(odd).collect()]
    assert set(rows) <= set(odd_rows)
    parts = {r.component_id for r in near_duplicates(odd).collect()}
    assert len(rows) == len(parts)
    assert {r[0] for r in rows} == parts
    assert one_of_each(none).columns == none.columns and one_of_each(none).count() == 0


@pytest.mark.parametrize("edges", [[(i, i + 1) for i in range(40)], [(0, i) for i in range(30)], [(5, 5), (9, 7), (7, 8)], []])
def test_components(spark, edges):
    got = {r.node: r.root for r in components(spark.createDataFrame([*edges, (None, 3)], "a long, b long"), "a", "b").collect()}
    assert got == groups({n for e in edges for n in e}, edges)
