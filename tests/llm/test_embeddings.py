import numpy as np
import pytest

from hazecast.llm.embeddings import fit, near_duplicates

SCHEMA = "vec_id long, embedding array<float>, label int, node string, n int"


def slow(rows, least=0.98):
    """Links and components by comparing all pairs."""

    def usable(v, label):
        return v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)

    linked = [[] for _ in rows]
    for i, (_, a, la) in enumerate(rows):
        for j, (_, b, lb) in enumerate(rows[:i]):
            if usable(a, la) and usable(b, lb) and la == lb and len(a) == len(b):
                x, y = np.array(a, np.float32).astype(float), np.array(b, np.float32).astype(float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                    linked[i].append(j)
                    linked[j].append(i)
    out = []
    for i, (own, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        first = min(ids) if ids else None
        out.append((own, len(linked[i]), first, own is not None and own == first))
    return sorted(out, key=str)


def family(draw, n, d=16, noise=0.03, label=1, first=0):
    head = draw.normal(size=d)
    return [(first + i, (head + noise * draw.normal(size=d)).tolist(), label) for i in range(n)]


@pytest.mark.parametrize("block", [512, 7])
def test_all_links_of_families_and_copies(spark, block):
    draw = np.random.default_rng(0)
    rows = []
    for k in range(12):
        rows += family(draw, int(draw.integers(1, 25)), noise=float(draw.uniform(0.005, 0.06)), label=k % 3, first=100 * k)
    rows += [(9000 + i, rows[3][1], rows[3][2]) for i in range(5)] + [(9100, rows[3][1], 77), (9101, rows[3][1], 77)]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], SCHEMA)
    got = sorted(map(tuple, near_duplicates(df, block=block).collect()), key=str)
    want = slow(rows)
    found, all_links = sum(r[1] for r in got), sum(r[1] for r in want)
    assert found >= 0.98 * all_links
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    if found == all_links:
        assert got == want


def test_vectors_that_link_with_nothing(spark):
    good = [0.1] * 8
    rows = [(1, None, 1), (2, [0.0] * 8, 1), (3, [0.0] * 8, 1), (4, [None, *good[1:]], 1), (5, [float("nan"), *good[1:]], 1), (6, [float("inf"), *good[1:]], 1)]
    rows += [(7, good, None), (8, good, None), (9, good, 1), (10, [0.2] * 8, 1), (11, [0.1] * 9, 1), (12, [], 1), (None, good, 1), (None, None, 1), (9, good, 1)]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], SCHEMA)
    assert sorted(map(tuple, near_duplicates(df).collect()), key=str) == slow(rows)
    assert near_duplicates(df.limit(0)).count() == 0


def test_pivots_lie_apart(spark):
    draw = np.random.default_rng(1)
    rows = family(draw, 300, noise=0.01) + family(draw, 100, noise=3.0, first=1000)
    pivots = fit(spark.createDataFrame([(*r, "x", 5) for r in rows], SCHEMA), pivots=40)[16]
    cosines = pivots @ pivots.T - np.eye(len(pivots))
    assert len(pivots) <= 40 and cosines.max() <= 0.8
    assert np.allclose(np.linalg.norm(pivots, axis=1), 1)


def test_recall_on_the_given_vectors(spark, small):
    """Noisy copies of the table's vectors, just inside the threshold."""
    draw = np.random.default_rng(2)
    given = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    near = []
    for i, v, label in given[:200]:
        v = np.array(v) / np.linalg.norm(v)
        side = draw.normal(size=len(v))
        side -= (side @ v) * v
        near.append((10_000 + i, (0.982 * v + np.sqrt(1 - 0.982**2) * side / np.linalg.norm(side)).tolist(), label))
    df = spark.createDataFrame([(*r, "x", 5) for r in given + near], SCHEMA)
    assert near_duplicates(df).where("vec_id >= 10000 AND n_links = 1").count() >= 0.9 * len(near)
