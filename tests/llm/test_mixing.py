import math

import pytest

from hazecast.llm.mixing import mix, size_of, source_targets, taken_words


def shares(sizes, weights=(5.0, 2.0, 1.0), most=3.0):
    """Targets by resharing what full sources leave, source by source."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        open_weight = sum(w for s, w in weight.items() if s not in full)
        targets = {s: most * sizes[s] if s in full else left * weight[s] / open_weight for s in sizes}
        above = {s for s in sizes if s not in full and targets[s] >= most * sizes[s]}
        if not above or above | full == set(sizes):
            return targets
        full |= above


@pytest.mark.parametrize(
    "sizes",
    [{"a": 100, "b": 5, "c": 900, None: 40}, {"a": 1, "b": 1, "c": 1000}, {"x": 0, "y": 10}, {"z": 7}, {"a": 10**6, "B": 1, "é": 2, "": 3}],
)
def test_targets_by_resharing(spark, sizes):
    rows = source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = shares(sizes)
    assert all(math.isclose(r.target, want[r.source], rel_tol=1e-12, abs_tol=1e-9) for r in rows)


def test_words(spark):
    texts = [None, "", " \t\n\x0b\x0c\r", "a b\nc", "  x y", " lead trail "]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(size_of()).collect()
    assert [r[0] for r in rows] == [0, 0, 0, 3, 2, 2]


def test_taken_words_come_near_their_targets(spark, odd_rows):
    rows = [(i, "w " * (1 + i * 7919 % 90), "ab"[i % 10 == 0] if i % 7 else None) for i in range(3000)]
    got = taken_words(spark.createDataFrame(rows, "doc_id long, text string, source string")).toPandas()
    assert len(got) == len(rows)
    assert (got.taken <= 3 * got["size"]).all() and (got.taken == got.copies * got["size"]).all()
    sums = got.groupby("source_size").agg({"taken": "sum", "target": "first", "size": "sum"})
    assert (abs(sums.taken - sums.target) <= 2 * 90).all()
    assert (sums["size"] == sums.index).all() and math.isclose(sums.target.sum(), got["size"].sum())


def test_reruns_partitions_and_odd_rows_agree(odd, odd_rows, none):
    first = sorted(map(tuple, taken_words(odd).collect()), key=str)
    assert first == sorted(map(tuple, taken_words(odd.repartition(5)).collect()), key=str)
    assert len(first) == len(odd_rows)
    assert taken_words(none).count() == 0 and mix(none).count() == 0


def test_the_mix_holds_the_copies(odd, odd_rows):
    out = [tuple(r) for r in mix(odd).collect()]
    assert set(out) <= set(odd_rows)
    copies = sum(r.copies for r in taken_words(odd).collect())
    assert abs(len(out) - copies) <= 2 * 4  # rows told apart by text may stand in another order
    assert mix(odd).columns == odd.columns


def test_a_large_source_is_cut_into_ranges(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "'same words here' AS text", "'one' AS source")
    got = taken_words(docs)
    assert got.agg({"taken": "sum"}).first()[0] == 60_000  # its own size is all there is
