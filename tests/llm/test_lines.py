import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hazecast.llm.lines import BLANKS, LAST_ID, Runs, all_repeated_lines, deduplicated, keyed_lines, line_key, repeated_lines, without_repeated_lines
from hazecast.session import new_folder

CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(BLANKS).translate(CAPITALS)


def slow(rows, least=10):
    """rows of (doc_id, text) -> (doc_id, n_lines, n_dropped, kept) each."""
    owner = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                i = LAST_ID if i is None else i
                owner[key(line)] = min(owner.get(key(line), i), i)
    out = []
    for i, text in rows:
        own = LAST_ID if i is None else i
        lines = (text or "").split("\n")
        kept = [x for x in lines if owner.get(key(x), own) == own]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def result(df):
    return sorted(map(tuple, df.select("doc_id", "n_lines", "n_dropped", "kept").collect()), key=str)


def test_keys(spark):
    lines = ["", " \t", "Ab CÉ\x0b", "\x0c\r\n x \r", "ÀÉß", "İI", "\x1cA\x1f", "\xa0A", "a" * 5000 + " " * 5000 + "B"]
    got = spark.createDataFrame([(x,) for x in lines], "line string").select(line_key(F.col("line"))).collect()
    assert [r[0] for r in got] == [key(x) for x in lines]


def test_odd_rows_against_brute_force(odd, odd_rows, none):
    want = sorted(slow([(r[0], r[1]) for r in odd_rows], 4), key=str)
    assert result(deduplicated(odd, batches=3, fan=2, least=4)) == want
    assert sum(r[2] for r in want) > 0
    assert deduplicated(none).count() == 0
    kept = without_repeated_lines(odd, least=4)
    assert kept.columns == odd.columns and kept.count() == len(odd_rows)
    assert kept.where("text IS NULL").count() == sum(r[1] is None for r in odd_rows)


lines = st.sampled_from(["alpha beta gamma", "ALPHA beta gamma ", "short", "", "other line of words", "\tother Line of words", "é" * 9, "é" * 10])
texts = st.one_of(st.none(), st.lists(lines, max_size=6).map("\n".join))


@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 12)), texts), max_size=25), st.integers(1, 5), st.integers(2, 3))
@settings(deadline=None, max_examples=6)
def test_any_batches_give_the_same(spark, rows, batches, fan):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(deduplicated(docs, batches, fan)) == sorted(slow(rows), key=str)


def test_a_long_text_and_a_line_that_all_share(spark):
    rows = [(i, f"the line that all documents share\nown line of {i}") for i in range(3000)]
    rows.append((3000, "\n".join(f"the line number {i % 40_000}" for i in range(50_000))))
    rows.append((3001, "\n".join(f"the LINE number {i}" if i % 2 else f"only here {i}" for i in range(50_000))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert result(deduplicated(docs)) == sorted(slow(rows), key=str)


def batches_of(spark, n):
    rows = [[(10 * b + i, f"line number {(b * 3 + i) % 11} of many") for i in range(4)] for b in range(n)]
    return rows, [keyed_lines(spark.createDataFrame(r, "doc_id long, text string")) for r in rows]


def test_levels_stay_few_and_survive_the_session(spark):
    rows, batches = batches_of(spark, 9)
    folder = new_folder(spark, "runs")
    for i, batch in enumerate(batches):
        # opened anew for every batch, as by another session
        runs = Runs(spark, folder, 4, fan=2)
        gone = {r.id for r in repeated_lines(batch, runs, i).collect()}
        earlier = {text for b in rows[:i] for _, text in b}
        assert gone == {d for d, text in rows[i] if text in earlier}
        levels = [r[0] for r in Runs(spark, folder, 4, fan=2).tables]
        assert len(levels) == len(set(levels))  # fan - 1 runs a level
    # a batch that runs again after a crash drops what it dropped before
    again = {r.id for r in repeated_lines(batches[5], Runs(spark, folder, 4, fan=2), 5).collect()}
    assert again == {d for d, text in rows[5] if text in {t for b in rows[:5] for _, t in b}}
    found = Runs(spark, folder, 4, fan=2)
    assert sum(t.count() for t in found.tables.values()) == 11
    assert all("run_" not in t.name for t in spark.catalog.listTables())


def test_runs_are_not_shuffled(spark):
    _, (one, two, three) = batches_of(spark, 3)
    runs = Runs(spark, new_folder(spark, "runs"), 8, fan=4)
    for i, batch in enumerate((one, two)):
        repeated_lines(batch, runs, i)
    keys = three.groupBy("hash").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    plan = runs.met(keys)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange hashpartitioning") == 1


def test_a_fan_of_one_is_refused(spark):
    with pytest.raises(ValueError):
        Runs(spark, "/tmp/none", 4, fan=1)


def test_nothing_to_drop(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert all_repeated_lines(docs).count() == 0
    assert result(deduplicated(docs)) == [(1, 1, 0, ""), (2, 1, 0, "")]
